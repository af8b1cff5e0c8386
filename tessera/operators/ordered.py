"""Order-dependent operators.

Rules followed here: no window without ``partitionBy`` over unbounded
data; global orders (ROC/PR prefix sums) are computed as a distributed
prefix sum over range partitions; top-k uses ``orderBy().limit(k)``
(TakeOrderedAndProject: k rows per partition, then a k × partitions
merge).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.joins import sized
from tessera.session import ensure_checkpoint_dir


# O-3
def top_k(df: DataFrame, measure: str | Column, k: int, tie_break: Sequence[str] = (),
          descending: bool = True, rank_col: str = "rank") -> DataFrame:
    """The k rows with the largest (smallest) ``measure``; ties by ``tie_break``.

    Adds a 1-based ``rank``.  The numbering window runs over the k kept
    rows only (bounded).
    """
    m = F.col(measure) if isinstance(measure, str) else measure
    order = [m.desc_nulls_last() if descending else m.asc_nulls_last()] + [F.col(c).asc() for c in tie_break]
    kept = df.orderBy(*order).limit(k)
    return kept.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))


# O-5
def arg_max(df: DataFrame, of: str, by: str, smallest_on_tie: bool = True) -> DataFrame:
    """Value of ``of`` at the maximum of ``by``; ties → smallest ``of``."""
    tie = -F.col(of) if smallest_on_tie else F.col(of)
    return df.agg(F.max_by(of, F.struct(F.col(by), tie)).alias(of), F.max(by).alias(by))


# W-1
def rolling_mean(df: DataFrame, key: Sequence[str], order: str, col: str, n: int, center: bool = True,
                 out: str | None = None) -> DataFrame:
    """Rolling mean over ``n`` rows, min 1 row; centred like pandas."""
    lo, hi = (-(n // 2), n - n // 2 - 1) if center else (-(n - 1), 0)
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(lo, hi)
    return df.withColumn(out or f"{col}_rolling", F.avg(col).over(w))


# W-2
def ffill(df: DataFrame, key: Sequence[str], order: str, col: str, default=None, out: str | None = None) -> DataFrame:
    """Forward fill within each series, then a constant for leading NULLs."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = F.last(col, ignorenulls=True).over(w)
    if default is not None:
        filled = F.coalesce(filled, F.lit(default))
    return df.withColumn(out or col, filled)


# W-3
def n_folds(n: int, train: int, test: int, step: int) -> int:
    return 0 if n < train + test else (n - train - test) // step + 1


def rolling_folds(df: DataFrame, key: Sequence[str], order: str, train: int, test: int, step: int) -> DataFrame:
    """Rolling-origin folds as rows: each row × each fold it belongs to.

    Row i (0-based in ``order``) is in fold f when f·step ≤ i <
    f·step + train + test; role is 'train' for the first ``train`` rows of
    the fold.  Rows are numbered per series (partitioned window), the
    series length is a grouped count joined back, and the fold list of a
    row is generated with ``sequence`` — no driver loop over folds.
    """
    key = list(key)
    w = Window.partitionBy(*key).orderBy(order)
    numbered = df.withColumn("_i", F.row_number().over(w) - 1)
    if key:
        j = numbered.join(df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")), key, "inner")
    else:
        j = numbered.withColumn("_n", df.agg(F.count(F.lit(1))).scalar())
    span = train + test
    nf = F.when(F.col("_n") >= span, F.floor((F.col("_n") - span) / step) + 1).otherwise(0)
    lo = F.greatest(F.lit(0), F.ceil((F.col("_i") - span + 1) / step))
    hi = F.least(nf - 1, F.floor(F.col("_i") / step))
    j = j.withColumn("_lo", lo.cast("int")).withColumn("_hi", hi.cast("int")).filter(F.col("_hi") >= F.col("_lo"))
    out = j.withColumn("fold", F.explode(F.sequence(F.col("_lo"), F.col("_hi"))))
    role = F.when(F.col("_i") < F.col("fold") * step + train, "train").otherwise("test")
    return out.withColumn("role", role).withColumnRenamed("_i", "row_index").drop("_n", "_lo", "_hi")


# W-5
def acf(df: DataFrame, key: Sequence[str], order: str, col: str, max_lag: int) -> DataFrame:
    """Autocorrelation r(l) = Σ (x_t − m)(x_{t+l} − m) / Σ (x_t − m)², l = 0..L.

    Lag pairs come from an equi-join of the numbered series with itself
    shifted by each lag (lags exploded on the small side of the join key
    ``(series, index)``), so no unpartitioned window is used.
    """
    key = list(key)
    w = Window.partitionBy(*key).orderBy(order)
    num = df.select(*key, F.col(col).cast("double").alias("_x"), (F.row_number().over(w) - 1).alias("_i"))
    if key:
        c = num.join(num.groupBy(*key).agg(F.avg("_x").alias("_m")), key, "inner")
    else:
        c = num.withColumn("_m", num.agg(F.avg("_x")).scalar())
    c = c.select(*key, "_i", (F.col("_x") - F.col("_m")).alias("_d"))
    denom = c.groupBy(*key).agg(F.sum(F.col("_d") * F.col("_d")).alias("_ss")) if key else \
        c.agg(F.sum(F.col("_d") * F.col("_d")).alias("_ss"))
    shifted = c.select(*key, F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("lag"),
                       "_i", F.col("_d").alias("_d2"))
    shifted = shifted.select(*key, "lag", (F.col("_i") - F.col("lag")).alias("_i"), "_d2")
    pairs = c.join(shifted, key + ["_i"], "inner")
    num_sum = pairs.groupBy(*key, "lag").agg(F.sum(F.col("_d") * F.col("_d2")).alias("_num"))
    res = num_sum.join(denom, key, "inner") if key else num_sum.withColumn("_ss", denom.select("_ss").scalar())
    return res.select(*key, "lag", F.try_divide(F.col("_num"), F.col("_ss")).alias("acf"))


# W-7
def running_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = (),
                   partitions: int | None = None) -> DataFrame:
    """Cumulative positives/negatives at each distinct score, descending (per group).

    Distributed prefix sum: rows are first reduced to one per (group,
    distinct score), range-partitioned by (group, score desc) and
    checkpointed (this fixes the partition of every score); totals per
    (group, partition) — at most groups × partitions rows — give offsets,
    and each partition adds its own running sum.  Output per score: pos,
    neg, tp (= positives with score ≥ s), fp.
    """
    by = list(by)
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    g = df.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("bigint").alias("neg"))
    r = g.repartitionByRange(parts, *[F.col(b) for b in by], F.col("score").desc()) \
        .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    totals = r.groupBy(*by, "_pid").agg(F.sum("pos").alias("_tp"), F.sum("neg").alias("_tn"))
    before = (Window.partitionBy(*by).orderBy("_pid") if by else Window.orderBy("_pid")).rowsBetween(
        Window.unboundedPreceding, -1)
    offs = totals.select(*by, "_pid", F.coalesce(F.sum("_tp").over(before), F.lit(0)).alias("_op"),
                         F.coalesce(F.sum("_tn").over(before), F.lit(0)).alias("_on"))
    within = Window.partitionBy("_pid", *by).orderBy(F.col("score").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return r.join(offs, by + ["_pid"]).select(
        *by, "score", "pos", "neg",
        (F.col("_op") + F.sum("pos").over(within)).cast("bigint").alias("tp"),
        (F.col("_on") + F.sum("neg").over(within)).cast("bigint").alias("fp"))


def distributed_rank(df: DataFrame, by: Sequence[str], order: Sequence[str], out: str = "_rank",
                     partitions: int | None = None) -> DataFrame:
    """1-based rank of each row within ``by`` in ``order`` (order must be unique).

    Rows are range-partitioned by (by, order) and checkpointed; counts per
    (group, partition) — a small table — give each partition its offset,
    and ``row_number`` runs inside (partition, group) only.  A group that
    holds a third of all rows is spread over many partitions.
    """
    by, order = list(by), list(order)
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    r = df.repartitionByRange(parts, *[F.col(c) for c in by + order]) \
        .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    cnt = r.groupBy(*by, "_pid").agg(F.count(F.lit(1)).alias("_pc"))
    before = (Window.partitionBy(*by) if by else Window).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = cnt.select(*by, "_pid", F.coalesce(F.sum("_pc").over(before), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_pid", *by).orderBy(*order)
    return r.join(offs, by + ["_pid"]).withColumn(out, F.col("_off") + F.row_number().over(w)) \
        .drop("_pid", "_off")


#: Rows that a prefix of a uniform hash holds on average.
PREFIX_ROWS = 1 << 18


def _with_prefix(df: DataFrame, by: Sequence[str], uniform: str, per_prefix: int) -> DataFrame:
    """Adds ``_k`` (the group as a struct, so that null equals null) and
    ``_prefix``, the part of [0, 1) that the hash lies in; on average a part
    holds ``per_prefix`` of all rows."""
    parts = F.greatest(F.lit(1), F.ceil(df.agg(F.count(F.lit(1))).scalar() / F.lit(float(per_prefix))))
    return df.withColumns({"_k": F.struct(F.lit(0).alias("_"), *by), "_prefix": F.floor(F.col(uniform) * parts).cast("bigint")})


def _offsets(rows: DataFrame) -> DataFrame:
    """``_k, _prefix, _pc, _off``: rows of a group in a prefix and before it."""
    counts = rows.groupBy("_k", "_prefix").agg(F.count(F.lit(1)).alias("_pc"))
    before = Window.partitionBy("_k").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_off", F.coalesce(F.sum("_pc").over(before), F.lit(0)))


def hash_rank(df: DataFrame, by: Sequence[str], uniform: str, id_col: str, out: str = "_rank",
              per_prefix: int = PREFIX_ROWS) -> DataFrame:
    """1-based rank of each row within ``by`` in the order of a uniform hash
    (column ``uniform`` in [0, 1)) and its id.

    The hash deals the rows evenly, so its prefixes are the ranges: rows are
    counted per (group, prefix) map-side, running sums over these counts are
    the offsets, and ``row_number`` runs inside a (group, prefix), on whose
    partitioning the offsets are joined.  One shuffle of the rows, no sampling
    of ranges and no checkpoint; a group that holds a third of all rows is
    spread over its many prefixes.
    """
    rows = _with_prefix(df, by, uniform, per_prefix)
    inside = Window.partitionBy("_k", "_prefix").orderBy(uniform, id_col)
    ranked = rows.withColumn(out, F.row_number().over(inside)).join(_offsets(rows).drop("_pc"), ["_k", "_prefix"])
    return ranked.withColumn(out, (F.col("_off") + F.col(out)).cast("bigint")).drop("_k", "_prefix", "_off")


def hash_cuts(df: DataFrame, by: str, uniform: str, id_col: str, cuts: DataFrame, per_prefix: int = PREFIX_ROWS) -> DataFrame:
    """The (hash, id) of the rows at wanted ranks of each group.

    ``cuts`` has columns ``_by`` (the group), ``_cut`` (a name) and ``_at``
    (a 1-based rank).  Returns ``_by, _cut, _u, _id``.  Rows are counted per
    (group, prefix of the hash); only the rows of the prefixes in which a
    wanted rank lies are ranked, all others are never moved."""
    slim = _with_prefix(df.select(F.col(by).alias("_by"), F.col(uniform).alias("_u"), F.col(id_col).alias("_id")), ["_by"], "_u", per_prefix)
    wanted = cuts.select(F.struct(F.lit(0).alias("_"), "_by").alias("_k"), "_cut", "_at")
    holding = _offsets(slim).join(wanted, "_k").filter((F.col("_at") > F.col("_off")) & (F.col("_at") <= F.col("_off") + F.col("_pc")))
    holding = sized(holding.select("_k", "_prefix", "_cut", (F.col("_at") - F.col("_off")).alias("_nth")))
    inside = Window.partitionBy("_k", "_cut").orderBy("_u", "_id")
    near = slim.join(holding, ["_k", "_prefix"]).withColumn("_rn", F.row_number().over(inside))
    return near.filter(F.col("_rn") == F.col("_nth")).select("_by", "_cut", "_u", "_id")


# W-8
def cum_variance(ratios: Sequence[float]) -> list[float]:
    """Cumulative explained variance of k components (k values, driver-side)."""
    out, s = [], 0.0
    for r in ratios:
        s += float(r)
        out.append(s)
    return out


# W-9
def residuals(df: DataFrame, actual: str = "y", predicted: str = "yhat", out: str = "residual") -> DataFrame:
    """actual − predicted; rows with NULL, NaN or ±inf residual dropped."""
    r = F.col(actual).cast("double") - F.col(predicted).cast("double")
    d = df.withColumn(out, r)
    c = F.col(out)
    return d.filter(c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))

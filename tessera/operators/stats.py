"""Aggregations and descriptive statistics.

Many statistics of one table are computed in ONE aggregation (one scan,
partial aggregation per executor) and reshaped afterwards, never one
job per column.  Exact quantiles are selected by refined bins: only
counts per bin are shuffled, never values (``exact_quantiles``).  Global totals used as denominators are scalar
subqueries (``DataFrame.scalar()``), not cross joins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalars import round_nudged
from tessera.operators.joins import sized
from tessera.session import held

_G = "_g"


def _grouped(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Group keys; a constant key stands in for "no grouping", so that
    per-group side tables are joined on a key instead of cross joined."""
    by = list(by)
    if by:
        return df, by
    return df.withColumn(_G, F.lit(0)), [_G]


def _attach(df: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """Attach per-group side values (one row per group) to every row.

    Without grouping the side has one row: its columns become scalar
    subqueries.  With grouping it is a plain join.
    """
    if keys == [_G]:
        return df.withColumns({c: side.select(c).scalar() for c in side.columns if c != _G})
    return df.join(side, keys)


def _cols(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    if cols:
        return list(cols)
    numeric = ("int", "bigint", "smallint", "tinyint", "double", "float")
    return [f.name for f in df.schema.fields
            if f.dataType.simpleString() in numeric or f.dataType.simpleString().startswith("decimal")]


def _long(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Unpivot numeric ``cols`` to (by…, column, value) as DOUBLE, NULLs dropped."""
    by = list(by)
    casted = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    return casted.unpivot(by, list(cols), "column", value).filter(F.col(value).isNotNull())


# A-7 / A-8 / A-9
def value_counts(df: DataFrame, cols: Sequence[str] | str, normalize: bool = False, by_label: bool = False) -> DataFrame:
    """Counts of each value (combination), NULLs dropped, sorted by count desc;
    with ``by_label`` (O-2) by the values, descending."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    g = df.dropna(how="any", subset=cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        total = g.agg(F.sum("count")).scalar()
        g = g.withColumn("share", F.col("count") / total)
    return g.orderBy(*[F.desc(c) for c in cols]) if by_label else g.orderBy(F.desc("count"), *cols)


# A-6
def mode_min(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent non-NULL value; ties → smallest; all NULL → NULL.

    Two steps with bounded state: counts per (group, value) with map-side
    combine, then ``min(struct(-count, value))`` per group — one struct of
    state however many distinct values a group has (Spark's ``mode``
    aggregate would keep them all in one map).
    """
    by = list(by)
    counts = df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("_c"))
    best = F.min(F.struct((-F.col("_c")).alias("_k"), F.col(col).alias("_v")))["_v"].alias(col)
    # a global aggregate is one row, NULL when every value is NULL
    return counts.groupBy(*by).agg(best) if by else counts.agg(best)


def modes(df: DataFrame, cols: Sequence[str]) -> dict:
    """Modes of several columns from one job, ties to the smallest value.

    Every row becomes one struct per column, in which only that column's
    field is set, so values are counted and compared in their own type
    (numbers as numbers, dates as dates); per column the bounded
    ``min(struct(-count, value))`` is kept.  Returns {column: value};
    NULL-only columns are left out.
    """
    cols = list(cols)
    types = {f.name: f.dataType for f in df.schema.fields}
    fields = [f"_v{i}" for i in range(len(cols))]
    one = [F.struct(F.lit(i).alias("_col"), *[(F.col(c) if j == i else F.lit(None).cast(types[c])).alias(fields[j]) for j, c in enumerate(cols)])
           for i in range(len(cols))]
    long = df.select(F.explode(F.array(*one)).alias("r")).select("r.*").filter(F.coalesce(*[F.col(f).cast("string") for f in fields]).isNotNull())
    best = (long.groupBy("_col", *fields).agg(F.count(F.lit(1)).alias("_c"))
            .groupBy("_col").agg(F.min(F.struct((-F.col("_c")).alias("_k"), *fields)).alias("_b")))
    return {cols[r["_col"]]: r["_b"][fields[r["_col"]]] for r in best.collect()}  # one row per column


#: Bins of a selection: per e-fold of a value's size at first, then equal parts of a bin that holds a wanted rank.
FIRST_BINS, PARTS = 64, 65536


def _first_bin(v: Column) -> Column:
    """A number that never falls as the value grows: sign and logarithm of its
    size, with places of their own for 0, infinities and NaN (the greatest)."""
    size = F.floor(F.log(F.abs(v)) * FIRST_BINS) + 100_000  # positive for every size that a double has
    return (F.when(F.isnan(v), F.lit(10_000_001)).when(F.abs(v) == float("inf"), F.signum(v) * 10_000_000)
            .when(v == 0, F.lit(0)).otherwise(F.signum(v) * size)).cast("int")


def _holding(bins: DataFrame, within: Sequence[str], rank: Column, start: Column) -> DataFrame:
    """The bins whose ranks, counted on from ``start`` in bin order, hold the
    wanted ``rank``; adds ``_before`` (ranks below the bin)."""
    w = Window.partitionBy(*within).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    b = bins.withColumn("_before", start + F.coalesce(F.sum("_c").over(w), F.lit(0)))
    return b.filter((rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_c")))


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                    partitions: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy/pandas default, P8).

    Output: (by…, column, prob, value).  Selection by refined bins: one scan
    counts the values of every column into bins, with each bin's least and
    greatest value; only these counts are shuffled.  A bin that holds a wanted
    rank is done where the rank is its first or last, or all its values are
    equal; the others are cut into ``PARTS`` equal parts and counted by another
    scan of the rows that fall into them.  The first bins are 1/64 of an
    e-fold wide, so five scans reach the last bit of any double, and two or
    three are usual.  No value is shuffled or written as a row, whatever its
    column's distribution; a window runs over one group's bins.
    ``partitions`` is not needed any more.
    """
    keys = list(by) + ["column"]
    long = _long(df, cols, by)
    stats = [F.count(F.lit(1)).alias("_c"), F.min("value").alias("_mn"), F.max("value").alias("_mx")]
    bins = long.groupBy(*keys, _first_bin(F.col("value")).alias("_bin")).agg(*stats)
    ends = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.lit(s).alias("side")) for p in probs for s in ("lo", "hi")])).alias("t")
    wide = bins.withColumn("_h", (F.sum("_c").over(Window.partitionBy(*keys)) - 1)).select(*keys, "_bin", "_c", "_mn", "_mx", "_h", ends)
    place = F.col("_h") * F.col("t.prob")
    rank = F.when(F.col("t.side") == "lo", F.floor(place)).otherwise(F.ceil(place)).cast("bigint")
    wide = wide.select(*keys, "_bin", "_c", "_mn", "_mx", "t.prob", "t.side", rank.alias("_rank"), (place - F.floor(place)).alias("_frac"))
    hits = held(_holding(wide, [*keys, "prob", "side"], F.col("_rank"), F.lit(0)))
    carried = [*keys, "prob", "side", "_rank", "_frac"]
    last = F.col("_before") + F.col("_c") - 1
    settled = (F.col("_mn") == F.col("_mx")) | (F.col("_rank") == F.col("_before")) | (F.col("_rank") == last)
    value = F.when(F.col("_rank") == F.col("_before"), F.col("_mn")).otherwise(F.col("_mx")).alias("value")
    done = hits.filter(settled).select(*carried, value)
    while True:
        todo = hits.filter(~settled).select(*carried, F.col("_mn").alias("_lo"), F.col("_mx").alias("_hi"), F.col("_before").alias("_start"))
        if todo.isEmpty():
            break
        inside = long.join(sized(todo.select(*keys, "_lo", "_hi").distinct()), keys).filter(F.col("value").between(F.col("_lo"), F.col("_hi")))
        part = F.floor((F.col("value") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * PARTS).cast("int")
        bins = inside.groupBy(*keys, "_lo", part.alias("_bin")).agg(*stats)
        wide = bins.join(todo.drop("_hi"), [*keys, "_lo"])
        hits = held(_holding(wide, [*keys, "_lo", "prob", "side"], F.col("_rank"), F.col("_start")))
        done = done.unionByName(hits.filter(settled).select(*carried, value))
    pivoted = done.groupBy(*keys, "prob").agg(
        F.max("_frac").alias("_frac"), F.max(F.when(F.col("side") == "lo", F.col("value"))).alias("_lo"),
        F.max(F.when(F.col("side") == "hi", F.col("value"))).alias("_hi"))
    return pivoted.select(*keys, "prob", F.when(F.col("_lo") == F.col("_hi"), F.col("_lo"))
                          .otherwise(F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")).alias("value"))


# A-10
def describe(df: DataFrame, cols: Sequence[str] | None = None, digits: int | None = 2,
             by: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 %, max per numeric column.

    Moments come from one aggregation over the unpivoted columns; the
    three quartiles from ``exact_quantiles``.  Long output, one row per
    (by…, column).
    """
    cols = _cols(df, cols)
    by = list(by)
    keys = by + ["column"]
    lg = _long(df, cols, by)
    mom = lg.groupBy(*keys).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], by)
    qw = q.groupBy(*keys).agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
                                for p, n in [(0.25, "p25"), (0.5, "p50"), (0.75, "p75")]])
    out = mom.join(qw, keys, "left")
    stats = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    if digits is not None:
        out = out.select(*keys, "count", *[round_nudged(s, digits).alias(s) for s in stats])
    return out.select(*keys, "count", *stats)


# A-11 / V-11
def null_profile(df: DataFrame, cols: Sequence[str] | None = None, keep_positive: bool = True) -> DataFrame:
    """NULL (and NaN) count and percent per column, from one aggregation."""
    cols = list(cols or df.columns)
    exprs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        dt = df.schema[c].dataType.simpleString()
        isnull = F.col(c).isNull() | (F.isnan(c) if dt in ("double", "float") else F.lit(False))
        exprs.append(F.sum(F.when(isnull, 1).otherwise(0)).cast("bigint").alias(f"_{i}"))
    one = df.agg(*exprs)
    rows = one.select("_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("null_count")) for i, c in enumerate(cols)
    ])).alias("r")).select("r.column", "r.null_count",
                           F.when(F.col("_n") > 0, F.lit(100.0) * F.col("r.null_count") / F.col("_n"))
                           .otherwise(F.lit(0.0)).alias("null_percent"))
    return rows.filter(F.col("null_count") > 0) if keep_positive else rows


# A-12
def skew_expr(c: str) -> Column:
    """Bias-adjusted sample skewness (pandas ``skew``), P6."""
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def skew(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    lg = _long(df, cols, by)
    return lg.groupBy(*by, "column").agg(skew_expr("value").alias("skew"))


# A-13
def mean_median(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    g, keys = _grouped(df, by)
    mom = g.groupBy(*keys).agg(F.avg(F.col(col).cast("double")).alias("mean"))
    med = exact_quantiles(g, [col], [0.5], keys).select(*keys, F.col("value").alias("median"))
    if not by:
        return mom.select("mean", med.select("median").scalar().alias("median"))
    return mom.join(med, keys, "left")


# A-14
def col_extremes(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Min and max of every numeric column (as DOUBLE), one aggregation."""
    cols = _cols(df, cols)
    one = df.agg(*[F.min(F.col(c).cast("double")).alias(f"_mn{i}") for i, c in enumerate(cols)],
                 *[F.max(F.col(c).cast("double")).alias(f"_mx{i}") for i, c in enumerate(cols)])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_mn{i}").alias("min"), F.col(f"_mx{i}").alias("max"))
        for i, c in enumerate(cols)])).alias("r")).select("r.*")


# A-15 / A-16
def corr_guarded(x: str, y: str) -> Column:
    """Pearson correlation over pairs where both are non-NULL; constant → NULL."""
    xm = F.when(F.col(y).isNotNull(), F.col(x).cast("double"))
    ym = F.when(F.col(x).isNotNull(), F.col(y).cast("double"))
    return F.try_divide(F.covar_pop(xm, ym), F.stddev_pop(xm) * F.stddev_pop(ym))


class _CoMoments:
    """Counts, means and co-moments of every pair of a left and a right column
    over the rows where neither is NULL, as (left, right) arrays.  A batch is a
    few matrix products; batches are merged by the pairwise update."""

    def __init__(self, left: int, right: int) -> None:
        shape = (left, right)
        self.n, self.c = np.zeros(shape), np.zeros(shape)
        self.mean, self.square = [np.zeros(shape), np.zeros(shape)], [np.zeros(shape), np.zeros(shape)]
        self.low, self.high = [np.full(shape, np.inf)] * 2, [np.full(shape, -np.inf)] * 2

    @staticmethod
    def _extremes(x: np.ndarray, has: np.ndarray, other: np.ndarray, worst: float, least: np.ufunc) -> np.ndarray:
        """(columns of x, columns of the other side): the least (largest) value where both are there."""
        x = np.where(has, x, worst)
        out = np.repeat(least.reduce(x, 0)[:, None], other.shape[1], 1)
        for j in np.flatnonzero(~other.all(0)):
            out[:, j] = least.reduce(x[other[:, j]], 0, initial=worst)
        return out

    def add(self, x: np.ndarray, y: np.ndarray, has_x: np.ndarray, has_y: np.ndarray) -> None:
        """``x`` (rows, left) and ``y`` (rows, right) with masks of what isn't NULL."""
        mx, my = has_x.astype(np.float64), has_y.astype(np.float64)
        # around a value of the column, so that large offsets don't cancel digits
        shift_x, shift_y = (v[h.argmax(0), np.arange(v.shape[1])] * h.any(0) for v, h in ((x, has_x), (y, has_y)))
        zx, zy = np.where(has_x, x - shift_x, 0.0), np.where(has_y, y - shift_y, 0.0)
        n = mx.T @ my
        some = np.maximum(n, 1)
        sum_x, sum_y = zx.T @ my, mx.T @ zy
        c = zx.T @ zy - sum_x * sum_y / some
        mean = [shift_x[:, None] + sum_x / some, shift_y[None, :] + sum_y / some]
        square = [(zx * zx).T @ my - sum_x * sum_x / some, mx.T @ (zy * zy) - sum_y * sum_y / some]
        total = self.n + n
        weight = self.n * n / np.maximum(total, 1)
        delta = [m - old for m, old in zip(mean, self.mean)]
        self.c += c + delta[0] * delta[1] * weight
        self.square = [s + t + d * d * weight for s, t, d in zip(self.square, square, delta)]
        self.mean = [m + d * n / np.maximum(total, 1) for m, d in zip(self.mean, delta)]
        self.n = total
        for at, worst, least in ((self.low, np.inf, np.minimum), (self.high, -np.inf, np.maximum)):
            at[:] = [least(at[0], self._extremes(x, has_x, has_y, worst, least)), least(at[1], self._extremes(y, has_y, has_x, worst, least).T)]


def _corr_pairs(df: DataFrame, pairs_list: Sequence[tuple[str, str]], digits: int) -> DataFrame:
    """(col_a, col_b, corr) for the given column pairs, guarded.

    Every task adds up the co-moments of all its rows (``_CoMoments``) and
    gives one row per pair; these are merged around the pair's overall means.
    No row is repeated per column or pair.  A side that has one value only, or
    no common rows, gives NULL; NaN makes the correlations of its column NaN;
    an empty table gives no rows."""
    left, right = (list(dict.fromkeys(side)) for side in zip(*pairs_list)) if pairs_list else ([], [])
    li, ri = ([side.index(c) for c in names] for side, names in zip((left, right), zip(*pairs_list))) if pairs_list else ([], [])
    cols = list(dict.fromkeys(left + right))
    at_left, at_right = [cols.index(c) for c in left], [cols.index(c) for c in right]
    names = ["n", "c", "mean_a", "mean_b", "square_a", "square_b", "low_a", "low_b", "high_a", "high_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = _CoMoments(len(left), len(right))
        rows = 0
        for batch in batches:
            if not batch.num_rows or not cols:
                continue
            rows += batch.num_rows
            has = np.stack([v.is_valid().to_numpy(zero_copy_only=False) for v in batch.columns], 1)
            x = np.stack([v.fill_null(0.0).to_numpy(zero_copy_only=False) for v in batch.columns], 1)
            acc.add(x[:, at_left], x[:, at_right], has[:, at_left], has[:, at_right])
        if rows:
            found = [acc.n, acc.c, *acc.mean, *acc.square, *acc.low, *acc.high]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(li)), pa.int32()), *(pa.array(v[li, ri]) for v in found)], names=["pair", *names])

    tasks = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).mapInArrow(run, "pair int, " + ", ".join(f"{n} double" for n in names))
    whole = Window.partitionBy("pair")
    for s in ("a", "b"):
        tasks = tasks.withColumn(f"off_{s}", F.col(f"mean_{s}") - F.try_divide(F.sum(F.col("n") * F.col(f"mean_{s}")).over(whole), F.sum("n").over(whole)))
    out = tasks.groupBy("pair").agg(
        F.sum(F.col("c") + F.col("n") * F.col("off_a") * F.col("off_b")).alias("c"),
        *[F.sum(F.col(f"square_{s}") + F.col("n") * F.col(f"off_{s}") * F.col(f"off_{s}")).alias(f"square_{s}") for s in ("a", "b")],
        *[(F.min(f"low_{s}") < F.max(f"high_{s}")).alias(f"varies_{s}") for s in ("a", "b")])
    corr = F.when(F.col("varies_a") & F.col("varies_b"), F.try_divide(F.col("c"), F.sqrt("square_a") * F.sqrt("square_b")))
    pair = F.get(F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b")) for a, b in pairs_list]), F.col("pair")) if pairs_list else F.lit(None).cast("struct<col_a:string,col_b:string>")
    return out.select(pair.alias("p"), round_nudged(corr, digits).alias("corr")).select("p.col_a", "p.col_b", "corr")


def corr_with(df: DataFrame, target: str, cols: Sequence[str] | None = None, include_target: bool = False,
              digits: int = 6) -> DataFrame:
    """Correlation of every numeric column with ``target``, sorted desc.

    One pass adds up the co-moments of all columns with the target (see ``_corr_pairs``).
    """
    cols = [c for c in _cols(df, cols) if include_target or c != target]
    out = _corr_pairs(df, [(c, target) for c in cols], digits).select(F.col("col_a").alias("column"), "corr")
    return out.orderBy(F.desc_nulls_last("corr"), "column")


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Full matrix in long form (col_a, col_b, corr); the upper triangle is
    computed once and mirrored."""
    cols = list(cols)
    upper = _corr_pairs(df, [(a, b) for i, a in enumerate(cols) for b in cols[i:]], digits)
    lower = upper.filter(F.col("col_a") != F.col("col_b")).select(
        F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr")
    return upper.unionByName(lower)


def top_corr(df: DataFrame, target: str, k: int, cols: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """A-17: the k columns with the largest |corr| with target (target excluded, P18), and their submatrix."""
    cw = corr_with(df, target, cols, digits=digits)
    top = cw.orderBy(F.desc_nulls_last(F.abs("corr")), "column").limit(k)
    names = [r["column"] for r in top.select("column").collect()]  # k names (bounded)
    return corr_matrix(df, names + [target], digits)


# A-18
def rate_by_flags(df: DataFrame, flags: Sequence[str], outcome: str, digits: int = 2) -> DataFrame:
    """Mean outcome without (flag = 0) / with (flag = 1) each flag, ratio, sorted by ratio desc."""
    lg = df.select(F.col(outcome).cast("double").alias("_y"), *flags).unpivot(
        ["_y"], list(flags), "flag", "_v").filter(F.col("_v").isNotNull())
    g = lg.groupBy("flag").agg(
        F.avg(F.when(F.col("_v") == 0, F.col("_y"))).alias("without"),
        F.avg(F.when(F.col("_v") == 1, F.col("_y"))).alias("with"))
    return g.withColumn("with_vs_without", round_nudged(F.try_divide(F.col("with"), F.col("without")), digits)) \
        .orderBy(F.desc_nulls_last("with_vs_without"), "flag")


# A-21
def box_stats(df: DataFrame, col: str | Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Five-number summary per group with 1.5·IQR whiskers and outlier count;
    for a list of columns one row per group and ``column``, all in one pass."""
    cols = [col] if isinstance(col, str) else list(col)
    keys = [*by, "column"]
    q = exact_quantiles(df, cols, [0.0, 0.25, 0.5, 0.75, 1.0], by)
    w = q.groupBy(*keys).agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in
                               [(0.0, "min"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1.0, "max")]])
    iqr = F.col("q3") - F.col("q1")
    w = sized(w.withColumns({"_lo": F.col("q1") - 1.5 * iqr, "_hi": F.col("q3") + 1.5 * iqr}))
    v = F.col("value")
    j = _long(df, cols, by).join(w.select(*keys, "_lo", "_hi"), keys)
    inside = (v >= F.col("_lo")) & (v <= F.col("_hi"))
    wh = j.groupBy(*keys).agg(F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
                              F.sum(F.when(inside, 0).otherwise(1)).cast("bigint").alias("n_outliers"))
    out = w.drop("_lo", "_hi").join(wh, keys)
    return out.drop("column") if isinstance(col, str) else out


# A-22
def histogram(df: DataFrame, col: str, bins: int = 60, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between min and max; the top edge falls in the last bin.

    min/max are one aggregation (per group, a small side table); every row
    gets its bin from ``width_bucket``; bin counts are a grouped count.
    Empty bins are kept (0) so the output has ``bins`` rows per group.
    """
    g, keys = _grouped(df, by)
    v = F.col(col).cast("double")
    rng = g.groupBy(*keys).agg(F.min(v).alias("_mn"), F.max(v).alias("_mx"))
    rows = _attach(g.select(*keys, v.alias("_v")).filter(F.col("_v").isNotNull()), rng, keys)
    # bin = floor(bins·(v − min)/(max − min)) + 1, the top edge folded into the last bin
    b = F.when(F.col("_mx") == F.col("_mn"), F.lit(1)).otherwise(F.least(
        F.floor(F.lit(float(bins)) * (F.col("_v") - F.col("_mn")) / (F.col("_mx") - F.col("_mn"))) + 1, F.lit(bins)))
    counts = rows.groupBy(*keys, b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select(*keys, "_mn", "_mx", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    width = (F.col("_mx") - F.col("_mn")) / bins
    out = grid.join(counts, keys + ["bin"], "left").select(
        *keys, "bin", (F.col("_mn") + (F.col("bin") - 1) * width).alias("bin_start"),
        (F.col("_mn") + F.col("bin") * width).alias("bin_end"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))
    return out if by else out.drop(_G)


# A-23
def kde_grid(df: DataFrame, col: str | Sequence[str], by: Sequence[str] = (), grid: int = 100, digits: int = 9) -> DataFrame:
    """Gaussian kernel density on a grid per group (Scott's bandwidth); for a
    list of columns one curve per group and ``column``.

    Count, spread and ends of every curve come from one aggregation.  A second
    scan adds a row's kernel to one sum per grid point, map-side, so a task
    holds and sends ``grid`` numbers per curve: no row is copied per point and
    no value is shuffled.
    """
    cols = [col] if isinstance(col, str) else list(col)
    keys = [*by, "column"]
    long = _long(df, cols, by)
    v = F.col("value")
    st = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp(v).alias("_sd"), F.min(v).alias("_mn"), F.max(v).alias("_mx"))
    st = sized(st.withColumn("_bw", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))))
    at = lambda p: F.col("_mn") + (F.col("_mx") - F.col("_mn")) * p / F.lit(grid - 1)
    z = lambda p: F.try_divide(at(F.lit(p)) - v, F.col("_bw"))
    sums = long.join(st, keys).groupBy(*keys, "_n", "_bw", "_mn", "_mx").agg(*[F.sum(F.exp(-0.5 * z(p) * z(p))).alias(f"_s{p}") for p in range(grid)])
    curve = sums.select(*keys, "_n", "_bw", "_mn", "_mx", F.posexplode(F.array(*[f"_s{p}" for p in range(grid)])).alias("point", "_s"))
    out = curve.select(*keys, "point", round_nudged(at(F.col("point")), digits).alias("x"), round_nudged(
        F.try_divide(F.col("_s"), F.col("_n") * F.col("_bw") * F.lit(math.sqrt(2 * math.pi))), digits).alias("density"))
    return out.drop("column") if isinstance(col, str) else out


# A-25
def cooccurrence(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows where both flags are 1, total rows, and the conditional share."""
    both = F.col(a).cast("int").bitwiseAND(F.col(b).cast("int"))
    return df.agg(F.sum(both).cast("bigint").alias("both"), F.sum(F.col(a).cast("int")).cast("bigint").alias(f"n_{a}"),
                  F.count(F.lit(1)).alias("n_rows")).withColumn(
        "share_given_" + a, F.try_divide(F.col("both"), F.col(f"n_{a}")))


# A-26 / S3
def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table: one count(*) aggregation per table, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def profile_schema(df: DataFrame) -> DataFrame:
    """Column, type and non-NULL count (one aggregation)."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    one = df.agg(*[F.count(F.col(c)).alias(f"_{i}") for i, c in enumerate(df.columns)])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(types[c]).alias("type"),
                 F.col(f"_{i}").alias("non_null")) for i, c in enumerate(df.columns)])).alias("r")).select("r.*")

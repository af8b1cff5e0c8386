"""Data-quality checks and suites.

Every check returns rows of one result schema (``RESULT_SCHEMA``).  A
suite fuses all row-level checks of a table into ONE aggregation pass
(one scan, partial aggregation on every executor); key checks add one
grouped aggregation per distinct key set and referential checks one
anti join each.  Metadata checks (column position and type) read only
the schema.  Results are small DataFrames (one row per check); only
``on_fail="raise"`` brings them to the driver, and they are bounded by
the number of checks, not by the data.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_SCHEMA = T.StructType([
    T.StructField("check", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("element_count", T.LongType()),
    T.StructField("missing_count", T.LongType()),
    T.StructField("unexpected_count", T.LongType()),
    T.StructField("unexpected_percent", T.DoubleType()),
    T.StructField("success", T.BooleanType()),
])
RESULT_COLUMNS = [f.name for f in RESULT_SCHEMA.fields]


class DataQualityError(AssertionError):
    pass


# ---------------------------------------------------------------- check specs

@dataclass(frozen=True)
class NotNull:                      # V-2
    column: str
    name: str = "not_null"


@dataclass(frozen=True)
class Between:                      # V-7 (NULLs are "missing", not unexpected)
    column: str
    lo: float | None
    hi: float | None
    name: str = "values_between"


@dataclass(frozen=True)
class Unique:                       # V-1 / V-3 (compound when several columns)
    columns: tuple[str, ...]
    name: str = "unique"


@dataclass(frozen=True)
class Relationship:                 # V-4
    column: str
    ref: DataFrame = field(hash=False, compare=False)
    ref_column: str = ""
    name: str = "relationships"


@dataclass(frozen=True)
class ColumnExists:                 # V-5
    column: str
    index: int | None = None
    name: str = "column_exists"


@dataclass(frozen=True)
class ColumnType:                   # V-6
    column: str
    type_name: str
    name: str = "column_type"


def _row_level_exprs(checks) -> tuple[list[Column], list[tuple]]:
    """Aggregate expressions for all row-level checks, fused."""
    exprs = [F.count(F.lit(1)).alias("_n")]
    meta = []
    for i, c in enumerate(checks):
        col = F.col(c.column)
        miss = F.sum(F.when(col.isNull(), 1).otherwise(0)).cast("bigint")
        if isinstance(c, NotNull):
            bad = miss
        else:
            cond = F.lit(False)
            if c.lo is not None:
                cond = cond | (col < F.lit(c.lo))
            if c.hi is not None:
                cond = cond | (col > F.lit(c.hi))
            bad = F.sum(F.when(col.isNotNull() & cond, 1).otherwise(0)).cast("bigint")
        exprs += [miss.alias(f"_m{i}"), bad.alias(f"_u{i}")]
        meta.append((c.name, c.column, i, isinstance(c, NotNull)))
    return exprs, meta


def _row_level(df: DataFrame, checks) -> DataFrame | None:
    if not checks:
        return None
    exprs, meta = _row_level_exprs(checks)
    one = df.agg(*exprs)
    rows = []
    for name, column, i, is_nn in meta:
        n, m, u = F.col("_n"), F.col(f"_m{i}"), F.col(f"_u{i}")
        # not_null: denominator is all rows; between: non-missing rows
        denom = n if is_nn else (n - m)
        rows.append(F.struct(
            F.lit(name).alias("check"), F.lit(column).alias("column"), n.alias("element_count"),
            m.alias("missing_count"), u.alias("unexpected_count"),
            F.when(denom > 0, F.lit(100.0) * u / denom).otherwise(F.lit(0.0)).alias("unexpected_percent"),
            (u == 0).alias("success")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _result_cols(name: str, column: str) -> list[Column]:
    n, u = F.col("_n"), F.col("_u")
    return [F.lit(name).alias("check"), F.lit(column).alias("column"),
            n.alias("element_count"), F.col("_m").alias("missing_count"), u.alias("unexpected_count"),
            F.when(n > 0, F.lit(100.0) * u / n).otherwise(F.lit(0.0)).alias("unexpected_percent"),
            (u == 0).alias("success")]


def unique_check(df: DataFrame, columns: Sequence[str], name: str | None = None) -> DataFrame:
    """V-1/V-3: unexpected = surplus rows (rows beyond the first per key).

    Keys with a NULL part are ignored, as in SQL ``unique`` tests.  One
    grouped aggregation (partial counts per executor) and a global sum.
    """
    cols = list(columns)
    name = name or ("unique" if len(cols) == 1 else "compound_unique")
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    per_key = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c")).withColumn("_null", any_null)
    summary = per_key.agg(
        F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("_n"),
        F.coalesce(F.sum(F.when(F.col("_null"), F.col("_c")).otherwise(0)), F.lit(0)).cast("bigint").alias("_m"),
        F.coalesce(F.sum(F.when(~F.col("_null"), F.col("_c") - 1).otherwise(0)), F.lit(0)).cast("bigint").alias("_u"))
    return summary.select(*_result_cols(name, ",".join(cols)))


def key_checks(df: DataFrame, key: Sequence[str], not_null: Sequence[str] = (),
               name: str | None = None) -> DataFrame:
    """Uniqueness of ``key`` plus not-null checks of key columns, in ONE pass.

    The grouped count per key already tells, for every key column, how
    many rows have it NULL (NULL is a group value), so the not-null checks
    of key columns need no second scan.  Rows: the not-null checks, then
    the (compound) unique check.
    """
    cols = list(key)
    extra = [c for c in not_null if c not in cols]
    if extra:
        raise ValueError(f"not-null columns {extra} are not key columns; use run_suite")
    name = name or ("unique" if len(cols) == 1 else "compound_unique")
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    per_key = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c")).withColumn("_null", any_null)
    aggs = [F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("_n"),
            F.coalesce(F.sum(F.when(F.col("_null"), F.col("_c")).otherwise(0)), F.lit(0)).cast("bigint").alias("_m"),
            F.coalesce(F.sum(F.when(~F.col("_null"), F.col("_c") - 1).otherwise(0)), F.lit(0)).cast("bigint")
            .alias("_u")]
    for i, c in enumerate(not_null):
        aggs.append(F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("_c")).otherwise(0)), F.lit(0))
                    .cast("bigint").alias(f"_nn{i}"))
    one = per_key.agg(*aggs)
    n = F.col("_n")
    rows = []
    for i, c in enumerate(not_null):
        u = F.col(f"_nn{i}")
        rows.append(F.struct(F.lit("not_null").alias("check"), F.lit(c).alias("column"), n.alias("element_count"),
                             u.alias("missing_count"), u.alias("unexpected_count"),
                             F.when(n > 0, F.lit(100.0) * u / n).otherwise(F.lit(0.0)).alias("unexpected_percent"),
                             (u == 0).alias("success")))
    u = F.col("_u")
    rows.append(F.struct(F.lit(name).alias("check"), F.lit(",".join(cols)).alias("column"), n.alias("element_count"),
                         F.col("_m").alias("missing_count"), u.alias("unexpected_count"),
                         F.when(n > 0, F.lit(100.0) * u / n).otherwise(F.lit(0.0)).alias("unexpected_percent"),
                         (u == 0).alias("success")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def relationship_check(df: DataFrame, column: str, ref: DataFrame, ref_column: str,
                       name: str = "relationships") -> DataFrame:
    """V-4: non-NULL keys of ``df`` missing from ``ref``.

    ``ref`` is reduced to its distinct keys first; the left join then adds
    at most one match per row, and one aggregation counts the misses.
    """
    keys = df.select(F.col(column).alias("_k"))
    refk = ref.select(F.col(ref_column).alias("_k")).distinct().withColumn("_hit", F.lit(1))
    summary = keys.join(refk, "_k", "left").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.when(F.col("_k").isNull(), 1).otherwise(0)).cast("bigint").alias("_m"),
        F.sum(F.when(F.col("_k").isNotNull() & F.col("_hit").isNull(), 1).otherwise(0)).cast("bigint").alias("_u"))
    return summary.select(*_result_cols(name, f"{column}->{ref_column}"))


def reference_checks(refs: Sequence[tuple[str, DataFrame, str, DataFrame, str]], name: str = "relationships") -> DataFrame:
    """V-4 for many references (table name, table, column, referenced table,
    its column) at once: ``table_name`` and the result columns.

    All references to one dimension are one aggregation and no join: every
    referencing column's keys, tagged with their reference, and the
    dimension's own keys are counted per key map-side, so a hot key is one row
    of a task; a key that the dimension doesn't count is an orphan of every
    tag that does.  A table is scanned once for all its columns.
    """
    dims: dict[tuple[int, str], list[int]] = {}
    for i, (_, _, _, ref, ref_column) in enumerate(refs):
        dims.setdefault((id(ref), ref_column), []).append(i)
    out = None
    for (_, ref_column), own in dims.items():
        ref = refs[own[0]][3]
        kinds = {refs[i][1].schema[refs[i][2]].dataType.simpleString() for i in own} | {ref.schema[ref_column].dataType.simpleString()}
        key = lambda c: (F.col(c) if len(kinds) == 1 else F.col(c).cast("string")).alias("_k")  # noqa: B023, E731
        tables: dict[int, list[int]] = {}
        for i in own:
            tables.setdefault(id(refs[i][1]), []).append(i)
        rows = ref.select(F.lit(-1).alias("_t"), key(ref_column))
        for same in tables.values():
            tagged = F.explode(F.array(*[F.struct(F.lit(i).alias("_t"), key(refs[i][2])) for i in same])).alias("r")
            rows = rows.unionByName(refs[same[0]][1].select(tagged).select("r._t", "r._k"))
        per_key = rows.groupBy("_k").agg(F.max(F.col("_t") == -1).alias("_known"), F.max(F.col("_t") >= 0).alias("_used"),
                                         *[F.sum((F.col("_t") == i).cast("bigint")).alias(f"_c{i}") for i in own]).filter("_used")
        total = lambda c, when: F.coalesce(F.sum(F.when(when, F.col(c)).otherwise(0)), F.lit(0)).cast("bigint")
        one = per_key.agg(*[x for i in own for x in (
            total(f"_c{i}", F.lit(True)).alias(f"_n{i}"), total(f"_c{i}", F.col("_k").isNull()).alias(f"_m{i}"),
            total(f"_c{i}", F.col("_k").isNotNull() & ~F.col("_known")).alias(f"_u{i}"))])
        results = one.select(F.explode(F.array(*[
            F.struct(F.lit(refs[i][0]).alias("table_name"), F.lit(f"{refs[i][2]}->{ref_column}").alias("column"),
                     F.col(f"_n{i}").alias("_n"), F.col(f"_m{i}").alias("_m"), F.col(f"_u{i}").alias("_u")) for i in own])).alias("r")).select("r.*")
        part = results.select("table_name", F.lit(name).alias("check"), "column", *[c for c in _result_cols(name, "")[2:]])
        out = part if out is None else out.unionByName(part)
    return out


def _metadata_rows(df: DataFrame, checks) -> list[tuple]:
    rows = []
    for c in checks:
        if isinstance(c, ColumnExists):
            ok = c.column in df.columns and (c.index is None or df.columns.index(c.column) == c.index)
        else:
            ok = c.column in df.columns and df.schema[c.column].dataType.simpleString() == c.type_name
        rows.append((c.name, c.column, None, None, 0 if ok else 1, 0.0 if ok else 100.0, ok))
    return rows


def column_exists(df: DataFrame, column: str, index: int | None = None) -> bool:
    """V-5 (metadata only)."""
    return _metadata_rows(df, [ColumnExists(column, index)])[0][-1]


def column_type(df: DataFrame, column: str, type_name: str) -> bool:
    """V-6 (metadata only): Spark simple type name, e.g. 'string', 'bigint'."""
    return _metadata_rows(df, [ColumnType(column, type_name)])[0][-1]


def run_suite(df: DataFrame, checks: Sequence, on_fail: str = "report", spark: SparkSession | None = None) -> DataFrame:
    """V-8: evaluate checks; row-level ones fused into one pass.

    ``on_fail="raise"`` raises ``DataQualityError`` when any check fails
    (P23: the default only reports).
    """
    spark = spark or df.sparkSession
    row_level = [c for c in checks if isinstance(c, (NotNull, Between))]
    parts = []
    fused = _row_level(df, row_level)
    if fused is not None:
        parts.append(fused)
    for c in checks:
        if isinstance(c, Unique):
            parts.append(unique_check(df, c.columns))
        elif isinstance(c, Relationship):
            parts.append(relationship_check(df, c.column, c.ref, c.ref_column))
    meta = [c for c in checks if isinstance(c, (ColumnExists, ColumnType))]
    if meta:
        parts.append(spark.createDataFrame(_metadata_rows(df, meta), RESULT_SCHEMA))
    if not parts:
        return spark.createDataFrame([], RESULT_SCHEMA)
    out = parts[0].select(*RESULT_COLUMNS)
    for p in parts[1:]:
        out = out.unionByName(p.select(*RESULT_COLUMNS))
    if on_fail == "raise":
        failed = [r["check"] + ":" + r["column"] for r in out.filter(~F.col("success")).collect()]
        if failed:
            raise DataQualityError(f"failed checks: {failed}")
    return out


def suite_statistics(results: DataFrame) -> DataFrame:
    """V-8 statistics: evaluated, successful, unsuccessful, success percent."""
    return results.agg(
        F.count(F.lit(1)).alias("evaluated_expectations"),
        F.sum(F.col("success").cast("int")).cast("bigint").alias("successful_expectations"),
        F.sum((~F.col("success")).cast("int")).cast("bigint").alias("unsuccessful_expectations"),
        (F.lit(100.0) * F.sum(F.col("success").cast("int")) / F.count(F.lit(1))).alias("success_percent"),
        F.min(F.col("success").cast("int")).cast("boolean").alias("success"))


def between_details(df: DataFrame, column: str, lo: float | None, hi: float | None, k: int = 20) -> DataFrame:
    """V-7 with the details of a validation report in one row.

    Counts plus the ``k`` most frequent unexpected values with their counts
    (ties by value).  The value list is a bounded top-k (``k`` is the
    report's feature); the counts are over the whole table.
    """
    col = F.col(column)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (col < F.lit(lo))
    if hi is not None:
        bad = bad | (col > F.lit(hi))
    bad = col.isNotNull() & bad
    stats = df.agg(
        F.count(F.lit(1)).alias("element_count"),
        F.sum(F.when(col.isNull(), 1).otherwise(0)).cast("bigint").alias("missing_count"),
        F.sum(F.when(bad, 1).otherwise(0)).cast("bigint").alias("unexpected_count"))
    # top-k unexpected values: TakeOrderedAndProject keeps k rows per
    # partition, so at most k × partitions rows reach the final merge
    top = (df.filter(bad).groupBy(col.alias("value")).agg(F.count(F.lit(1)).alias("count"))
           .orderBy(F.desc("count"), "value").limit(k)
           .agg(F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("neg"), "value", "count")))
                .alias("_top")))
    both = stats.withColumn("_top", top.select("_top").scalar())
    return both.select(
        F.lit(column).alias("column"), "element_count", "missing_count", "unexpected_count",
        F.when(F.col("element_count") > 0, F.lit(100.0) * F.col("unexpected_count") / F.col("element_count"))
        .otherwise(F.lit(0.0)).alias("unexpected_percent"),
        F.when((F.col("element_count") - F.col("missing_count")) > 0,
               F.lit(100.0) * F.col("unexpected_count") / (F.col("element_count") - F.col("missing_count")))
        .otherwise(F.lit(0.0)).alias("unexpected_percent_nonmissing"),
        F.transform("_top", lambda s: s["value"]).alias("partial_unexpected_list"),
        F.transform("_top", lambda s: s["count"]).alias("partial_unexpected_counts"),
        (F.col("unexpected_count") == 0).alias("success"))


def one_to_one(df: DataFrame, key: str, values: Sequence[str] | str) -> DataFrame:
    """V-9: rows whose key maps to more than one value in any value column.

    ``max(v) > min(v)`` ⇔ more than one distinct non-NULL value, so the
    per-key test is a fully map-side-combinable aggregation (a key holding
    a third of the rows is pre-aggregated on every executor).  Offending
    keys are semi-joined back; result sorted by key.
    """
    values = [values] if isinstance(values, str) else list(values)
    per_key = df.groupBy(key).agg(*[(F.max(v) > F.min(v)).alias(f"_x{i}") for i, v in enumerate(values)])
    multi = F.lit(False)
    for i in range(len(values)):
        multi = multi | F.coalesce(F.col(f"_x{i}"), F.lit(False))
    bad = per_key.filter(multi).select(key)
    return df.join(bad, key, "left_semi").orderBy(key, *values)


def keys_with_many(df: DataFrame, key: str, column: str, n: int = 1) -> DataFrame:
    """V-10 / A-24: keys with more than ``n`` distinct non-NULL values of ``column``."""
    if n == 1:
        per_key = df.groupBy(key).agg((F.max(column) > F.min(column)).alias("_many"))
        return per_key.filter(F.col("_many")).select(key)
    per_key = df.groupBy(key).agg(F.countDistinct(column).alias("_nd"))
    return per_key.filter(F.col("_nd") > n).select(key)


def count_keys_with_many(df: DataFrame, key: str, column: str, n: int = 1) -> DataFrame:
    return keys_with_many(df, key, column, n).agg(F.count(F.lit(1)).alias("n_keys"))


def rows_all_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """V-12 / P-12: rows in which every listed column is NULL."""
    cols = list(cols or df.columns)
    return df.filter(F.coalesce(*[F.col(c) for c in cols]).isNull())


def drop_all_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="all", subset=list(cols) if cols else None)


@dataclass
class Step:
    name: str
    run: Callable[[], object]


class PipelineError(RuntimeError):
    pass


def run_pipeline(steps: Sequence[Step]) -> list[tuple[str, str]]:
    """V-13 / T-20 gate: run steps in order; the first failure stops the rest."""
    report = []
    for i, s in enumerate(steps):
        try:
            s.run()
            report.append((s.name, "ok"))
        except Exception as e:  # noqa: BLE001 — re-raised with the report
            report.append((s.name, f"failed: {type(e).__name__}: {e}"))
            report.extend((t.name, "skipped") for t in steps[i + 1:])
            raise PipelineError(report) from e
    return report

"""Sources and sinks.

Readers declare schemas where the layout is known (CSV inference costs
an extra pass and is for exploration only); writers replace whole
tables, the unit the original daily job works with.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# S1
def jdbc_options(url: str, table: str, partition_col: str | None = None, lower: int | None = None,
                 upper: int | None = None, num_partitions: int | None = None, fetch_size: int = 10_000,
                 properties: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of one partitioned JDBC table read.

    With ``partition_col`` and bounds, Spark issues ``num_partitions``
    range queries in parallel instead of one full-table cursor.
    """
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_col is not None:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("partitioned read needs lower, upper and num_partitions")
        opts.update({"partitionColumn": partition_col, "lowerBound": str(lower), "upperBound": str(upper),
                     "numPartitions": str(num_partitions)})
    opts.update(dict(properties or {}))
    return opts


def read_jdbc_schema(spark: SparkSession, url: str, schema: str, tables: Sequence[str],
                     partitioning: Mapping[str, tuple[str, int, int, int]] | None = None,
                     properties: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Full-table extract of every table of one database schema (lazy readers).

    ``partitioning[table] = (column, lower, upper, num_partitions)``.
    """
    out = {}
    for t in tables:
        part = (partitioning or {}).get(t)
        opts = jdbc_options(url, f"{schema}.{t}", *(part or (None, None, None, None)), properties=properties)
        out[f"{schema}-{t}"] = spark.read.format("jdbc").options(**opts).load()
    return out


# S2
def flatten_structs(df: DataFrame, max_depth: int = 1, sep: str = "_") -> DataFrame:
    """Replace struct columns by their fields (``parent_child``), ``max_depth`` levels."""
    for _ in range(max_depth):
        structs = [f for f in df.schema.fields if isinstance(f.dataType, T.StructType)]
        if not structs:
            break
        cols = []
        for f in df.schema.fields:
            if isinstance(f.dataType, T.StructType):
                cols += [F.col(f"`{f.name}`.`{c.name}`").alias(f"{f.name}{sep}{c.name}") for c in f.dataType.fields]
            else:
                cols.append(F.col(f"`{f.name}`"))
        df = df.select(*cols)
    return df


def raw_table_name(stream_name: str) -> str:
    """``schema-table`` → ``schema_table``."""
    return stream_name.replace("-", "_")


def land_raw(df: DataFrame, name: str, target: str | None = None, max_depth: int = 1) -> DataFrame:
    """Flatten and (when ``target`` is given) replace the raw table; returns the landed frame."""
    flat = flatten_structs(df, max_depth)
    if target is not None:
        write_table(flat, raw_table_name(name), path=f"{target}/{raw_table_name(name)}")
    return flat


# S3
def ingest(tables: Mapping[str, DataFrame], target: str) -> list[tuple[str, int, float]]:
    """Land every table and report (table, rows, seconds).

    Rows are counted while writing (``Observation``), not by a second scan.
    The report is one small tuple per table.
    """
    report = []
    for name, df in tables.items():
        obs = Observation(f"ingest_{raw_table_name(name)}")
        t0 = time.time()
        land_raw(df.observe(obs, F.count(F.lit(1)).alias("rows")), name, target)
        report.append((raw_table_name(name), int(obs.get["rows"]), round(time.time() - t0, 3)))
    return report


def ingest_metrics(spark: SparkSession, report: Sequence[tuple[str, int, float]]) -> DataFrame:
    schema = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("n_rows", T.LongType()),
                           T.StructField("seconds", T.DoubleType())])
    return spark.createDataFrame(list(report), schema)


# S4
def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, header: bool = True,
             multiline: bool = False) -> DataFrame:
    r = spark.read.option("header", header).option("quote", '"').option("escape", '"')
    if multiline:
        r = r.option("multiLine", True)
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", True).csv(path)


# S5
def csv_line_audit(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Physical lines vs logical CSV records (quoted embedded newlines)."""
    physical = spark.read.text(path).count()
    logical = read_csv(spark, path, schema=None, header=header, multiline=True).count() + (1 if header else 0)
    return spark.createDataFrame([(physical, logical, physical - logical)],
                                 "physical_lines bigint, logical_rows bigint, diff bigint")


# S6
def clean_newlines(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Every \\n and \\r inside a string field becomes one space."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    target = set(cols or strings)
    return df.select(*[F.translate(F.col(c), "\r\n", "  ").alias(c) if c in target else F.col(c)
                       for c in df.columns])


def write_csv(df: DataFrame, path: str, quote_all: bool = True) -> None:
    df.write.mode("overwrite").option("header", True).option("quoteAll", quote_all).option("escape", '"').csv(path)


# S8
def write_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite",
                partition_by: Sequence[str] | None = None) -> None:
    """Replace a table: a catalog table, or a Parquet folder when ``path`` is given."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path is not None:
        w.parquet(path)
    else:
        w.saveAsTable(name)


# S9
def materialize(df: DataFrame, name: str, kind: str = "view", path: str | None = None) -> DataFrame:
    """A model as a temp view (tests) or a written table (jobs); the
    returned frame reads the materialised result, so later steps start
    from it instead of recomputing the lineage."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    write_table(df, name, path)
    return df.sparkSession.read.parquet(path) if path else df.sparkSession.table(name)


# S10
def load_seed(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Seed CSV with header; every column as text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return read_csv(spark, path, schema=schema, header=True)


# S13
def write_results(results: DataFrame, path: str) -> None:
    results.coalesce(1).write.mode("overwrite").json(path)


# S14
def preview(df: DataFrame, n: int = 5, order: Sequence[str] | str | None = None) -> DataFrame:
    """First ``n`` rows in a stated order (deterministic, unlike ``head``)."""
    order = [order] if isinstance(order, str) else list(order or df.columns[:1])
    return df.orderBy(*order).limit(n)

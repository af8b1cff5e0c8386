"""Registered queries: profiling statistics (A-7..A-26) and the survey jobs (T-16..T-19)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators import quality as Q
from tessera.operators import stats as ST
from tessera.plans import survey as SV
from tessera.plans.q_star import pct_sql
from tessera.plans.registry import query
from tessera.sources import fixtures as X
from tessera.sources.catalog import BASE_TABLES, Sources

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _t(spark, sf_dir):
    return Sources.parquet_dir(spark, sf_dir)


def rnd(expr: str, d: int) -> str:
    return f"ROUND(({expr}) + 1e-9, {d})"


@query("value_counts", """
SELECT o_orderpriority, COUNT(*) AS count FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority""")
def q_value_counts(spark, sf_dir):
    return ST.value_counts(_t(spark, sf_dir).orders, "o_orderpriority")


@query("value_counts_share", """
SELECT l_returnflag, COUNT(*) AS count, CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () AS share
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag""")
def q_value_counts_share(spark, sf_dir):
    return ST.value_counts(_t(spark, sf_dir).lineitem, "l_returnflag", normalize=True)


@query("value_counts_combo", """
SELECT o_orderstatus, o_orderpriority, COUNT(*) AS count FROM orders
WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY o_orderstatus, o_orderpriority""")
def q_value_counts_combo(spark, sf_dir):
    return ST.value_counts(_t(spark, sf_dir).orders, ["o_orderstatus", "o_orderpriority"])


def describe_sql(src: str, cols: list[str], by: str | None = None, digits: int = 2) -> str:
    parts = []
    for c in cols:
        g = f"{by}, " if by else ""
        parts.append(f"""
SELECT {g}'{c}' AS "column", COUNT(v) AS count, {rnd('AVG(v)', digits)} AS mean, {rnd('STDDEV_SAMP(v)', digits)} AS std,
  {rnd('MIN(v)', digits)} AS min, {rnd('quantile_cont(v, 0.25)', digits)} AS p25,
  {rnd('quantile_cont(v, 0.5)', digits)} AS p50, {rnd('quantile_cont(v, 0.75)', digits)} AS p75,
  {rnd('MAX(v)', digits)} AS max
FROM (SELECT {g}CAST({c} AS DOUBLE) AS v FROM {src} WHERE {c} IS NOT NULL) z {f'GROUP BY {by}' if by else ''}""")
    return "\nUNION ALL ".join(parts)


@query("describe", describe_sql("lineitem", LI_NUM))
def q_describe(spark, sf_dir):
    return ST.describe(_t(spark, sf_dir).lineitem, LI_NUM, digits=2)


NULL_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
             "c_empty", "c_const"]


@query("null_profile", "\nUNION ALL ".join(
    f"""
SELECT '{c}' AS "column", CAST(SUM(CASE WHEN {c} IS NULL {'OR isnan(' + c + ')' if c in ('o_totalprice', 'c_empty', 'c_const') else ''} THEN 1 ELSE 0 END) AS BIGINT) AS null_count,
  {pct_sql(f"SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)", 'COUNT(*)')} AS null_percent
FROM x_nulls HAVING SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) > 0""" for c in NULL_COLS))
def q_null_profile(spark, sf_dir):
    return ST.null_profile(X.x_nulls(_t(spark, sf_dir)), NULL_COLS)


@query("skew", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {rnd(f'skewness(CAST({c} AS DOUBLE))', 6)} AS skew FROM lineitem"
    for c in ["l_extendedprice", "l_quantity"]))
def q_skew(spark, sf_dir):
    r = ST.skew(_t(spark, sf_dir).lineitem, ["l_extendedprice", "l_quantity"])
    return r.select("column", S.round_nudged("skew", 6).alias("skew"))


@query("mean_median", """
SELECT l_returnflag, AVG(CAST(l_quantity AS DOUBLE)) AS mean, quantile_cont(CAST(l_quantity AS DOUBLE), 0.5) AS median
FROM lineitem GROUP BY l_returnflag""")
def q_mean_median(spark, sf_dir):
    return ST.mean_median(_t(spark, sf_dir).lineitem, "l_quantity", ["l_returnflag"])


@query("mean_median_global", """
SELECT AVG(CAST(o_totalprice AS DOUBLE)) AS mean, quantile_cont(CAST(o_totalprice AS DOUBLE), 0.5) AS median
FROM orders""")
def q_mean_median_global(spark, sf_dir):
    return ST.mean_median(_t(spark, sf_dir).orders, "o_totalprice")


@query("col_extremes", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", MIN(CAST({c} AS DOUBLE)) AS min, MAX(CAST({c} AS DOUBLE)) AS max FROM lineitem"
    for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"] + LI_NUM))
def q_col_extremes(spark, sf_dir):
    return ST.col_extremes(_t(spark, sf_dir).lineitem,
                           ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"] + LI_NUM)


def corr_sql(x: str, y: str) -> str:
    xm = f"CASE WHEN {y} IS NOT NULL THEN CAST({x} AS DOUBLE) END"
    ym = f"CASE WHEN {x} IS NOT NULL THEN CAST({y} AS DOUBLE) END"
    den = f"(stddev_pop({xm}) * stddev_pop({ym}))"
    return rnd(f"CASE WHEN {den} = 0 THEN NULL ELSE covar_pop({xm}, {ym}) / {den} END", 6)


@query("corr_with", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {corr_sql(c, 'l_extendedprice')} AS corr FROM lineitem"
    for c in ["l_quantity", "l_discount", "l_tax", "l_linenumber"]))
def q_corr_with(spark, sf_dir):
    return ST.corr_with(_t(spark, sf_dir).lineitem, "l_extendedprice",
                        ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_extendedprice"])


@query("corr_with_nulls", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {corr_sql(c, 'o_totalprice')} AS corr FROM x_nulls"
    for c in ["o_orderkey", "o_custkey", "c_empty", "c_const"]))
def q_corr_with_nulls(spark, sf_dir):
    return ST.corr_with(X.x_nulls(_t(spark, sf_dir)), "o_totalprice",
                        ["o_orderkey", "o_custkey", "c_empty", "c_const", "o_totalprice"])


def _matrix_sql(cols):
    parts = []
    for i, a in enumerate(cols):
        for b in cols:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {corr_sql(a, b)} AS corr FROM lineitem")
    return "\nUNION ALL ".join(parts)


@query("corr_matrix", _matrix_sql(LI_NUM))
def q_corr_matrix(spark, sf_dir):
    return ST.corr_matrix(_t(spark, sf_dir).lineitem, LI_NUM)


@query("top_corr", """
WITH cw AS (""" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS c, {corr_sql(c, 'l_extendedprice')} AS corr FROM lineitem"
    for c in ["l_quantity", "l_discount", "l_tax", "l_linenumber"]) + """),
top AS (SELECT c FROM cw ORDER BY abs(corr) DESC NULLS LAST, c LIMIT 2),
names AS (SELECT c FROM top UNION ALL SELECT 'l_extendedprice'),
m AS (""" + _matrix_sql(["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_extendedprice"]) + """)
SELECT m.* FROM m WHERE col_a IN (SELECT c FROM names) AND col_b IN (SELECT c FROM names)""")
def q_top_corr(spark, sf_dir):
    return ST.top_corr(_t(spark, sf_dir).lineitem, "l_extendedprice", 2,
                       ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_extendedprice"])


def _recode_sql(f: str) -> str:
    return f"CAST(CASE WHEN {f} = 1 THEN 1 WHEN {f} = 2 THEN 0 WHEN {f} IN (97, 98, 99) THEN NULL ELSE {f} END AS INTEGER)"


SURVEY_CLEAN_SQL = f"""
SELECT age, sex, {', '.join(_recode_sql(f) + ' AS ' + f for f in SV.FLAG_COLS)},
  CAST(CASE WHEN clasiffication_final IN (1, 2, 3) THEN 1 ELSE 0 END AS INTEGER) AS positive,
  CAST(CASE WHEN date_died IS NULL OR date_died = '9999-99-99' THEN 0 ELSE 1 END AS INTEGER) AS died
FROM x_survey
WHERE NOT ({' AND '.join(f'({_recode_sql(f)}) IS NULL' for f in SV.FLAG_COLS)})"""
SURVEY = {"s_survey": SURVEY_CLEAN_SQL,
          "s_pos": "SELECT * FROM s_survey WHERE positive = 1"}


def _clean(spark, sf_dir):
    return SV.survey_clean(X.x_survey(_t(spark, sf_dir)))


@query("survey_clean", "SELECT * FROM s_survey", extra=SURVEY)
def q_survey_clean(spark, sf_dir):
    return _clean(spark, sf_dir)


@query("dq_rows_all_null", f"""
SELECT {', '.join(_recode_sql(f) + ' AS ' + f for f in SV.FLAG_COLS)}, age FROM x_survey
WHERE {' AND '.join(f'({_recode_sql(f)}) IS NULL' for f in SV.FLAG_COLS)}""")
def q_dq_rows_all_null(spark, sf_dir):
    s = X.x_survey(_t(spark, sf_dir))
    rec = s.select(*[S.recode(f, SV.BOOL_RECODE).cast("int").alias(f) for f in SV.FLAG_COLS], "age")
    return Q.rows_all_null(rec, SV.FLAG_COLS)


@query("survey_age_profile", """
WITH both_ AS (SELECT 'positive' AS cohort, age FROM s_pos UNION ALL SELECT 'died' AS cohort, age FROM s_pos WHERE died = 1)
SELECT d.*, s.skew FROM (""" + describe_sql("both_", ["age"], by="cohort") + """) d
JOIN (SELECT cohort, 'age' AS "column", """ + rnd("skewness(CAST(age AS DOUBLE))", 3) + """ AS skew
      FROM both_ GROUP BY cohort) s ON d.cohort = s.cohort AND d."column" = s."column" """, extra=SURVEY)
def q_survey_age_profile(spark, sf_dir):
    return SV.age_profile(_clean(spark, sf_dir))


@query("survey_age_histogram", """
WITH b AS (SELECT 'positive' AS cohort, CAST(age AS DOUBLE) AS v FROM s_pos
           UNION ALL SELECT 'died' AS cohort, CAST(age AS DOUBLE) AS v FROM s_pos WHERE died = 1),
r AS (SELECT cohort, MIN(v) AS mn, MAX(v) AS mx FROM b WHERE v IS NOT NULL GROUP BY cohort),
c AS (SELECT b.cohort, CAST(CASE WHEN mx = mn THEN 1
             ELSE LEAST(FLOOR(CAST(60.0 AS DOUBLE) * (v - mn) / (mx - mn)) + 1, 60) END AS INTEGER) AS bin,
        COUNT(*) AS cnt
      FROM b JOIN r ON b.cohort = r.cohort WHERE v IS NOT NULL GROUP BY 1, 2),
g AS (SELECT cohort, mn, mx, CAST(unnest(range(1, 61)) AS INTEGER) AS bin FROM r)
SELECT g.cohort, g.bin, mn + (g.bin - 1) * ((mx - mn) / 60) AS bin_start, mn + g.bin * ((mx - mn) / 60) AS bin_end,
  CAST(COALESCE(c.cnt, 0) AS BIGINT) AS count
FROM g LEFT JOIN c ON g.cohort = c.cohort AND g.bin = c.bin""", extra=SURVEY)
def q_survey_age_histogram(spark, sf_dir):
    return SV.age_histogram(_clean(spark, sf_dir))


RATES_SQL = " UNION ALL ".join(f"""
SELECT '{f}' AS flag, AVG(CASE WHEN {f} = 0 THEN CAST(died AS DOUBLE) END) AS "without",
  AVG(CASE WHEN {f} = 1 THEN CAST(died AS DOUBLE) END) AS "with" FROM s_pos WHERE {f} IS NOT NULL""" for f in SV.FLAG_COLS)


@query("rate_by_flags", f"""
SELECT flag, "without", "with", {rnd('CASE WHEN "without" = 0 THEN NULL ELSE "with" / "without" END', 2)} AS with_vs_without
FROM ({RATES_SQL}) r""", extra=SURVEY)
def q_rate_by_flags(spark, sf_dir):
    return SV.comorbidity_rates(_clean(spark, sf_dir))


@query("rate_by_flags_long", f"""
SELECT flag, 'Without' AS status, "without" AS death_rate FROM ({RATES_SQL}) a
UNION ALL SELECT flag, 'With' AS status, "with" AS death_rate FROM ({RATES_SQL}) b""", extra=SURVEY)
def q_rate_by_flags_long(spark, sf_dir):
    return SV.comorbidity_rates_long(_clean(spark, sf_dir))


@query("survey_missing", " UNION ALL ".join(f"""
SELECT '{f}' AS "column", CAST(SUM(CASE WHEN {f} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count,
  {pct_sql(f"SUM(CASE WHEN {f} IS NULL THEN 1 ELSE 0 END)", 'COUNT(*)')} AS null_percent FROM s_pos""" for f in SV.FLAG_COLS),
       extra=SURVEY)
def q_survey_missing(spark, sf_dir):
    return SV.missing_report(_clean(spark, sf_dir))


def _mode_sql(f: str) -> str:
    return (f"(SELECT {f} FROM s_pos WHERE {f} IS NOT NULL GROUP BY {f} "
            f"ORDER BY COUNT(*) DESC, {f} LIMIT 1)")


@query("survey_impute", f"""
WITH miss AS ({' UNION ALL '.join(f"SELECT '{f}' AS c, 100.0 * SUM(CASE WHEN {f} IS NULL THEN 1 ELSE 0 END) / COUNT(*) AS p FROM s_pos" for f in SV.FLAG_COLS)})
SELECT age, sex, {', '.join(f"CASE WHEN (SELECT p FROM miss WHERE c = '{f}') <= 10.0 THEN COALESCE({f}, {_mode_sql(f)}) ELSE {f} END AS {f}" for f in SV.FLAG_COLS)},
  positive, died
FROM s_pos""", extra=SURVEY)
def q_survey_impute(spark, sf_dir):
    return SV.impute_low_missing(_clean(spark, sf_dir))


@query("box_stats", """
WITH q AS (SELECT l_returnflag, MIN(v) AS min, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3, MAX(v) AS max
           FROM (SELECT l_returnflag, CAST(l_extendedprice AS DOUBLE) AS v FROM lineitem) z GROUP BY l_returnflag)
SELECT q.*, MIN(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_low,
  MAX(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_high,
  CAST(SUM(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers
FROM q JOIN (SELECT l_returnflag, CAST(l_extendedprice AS DOUBLE) AS v FROM lineitem) l USING (l_returnflag)
GROUP BY ALL""")
def q_box_stats(spark, sf_dir):
    return ST.box_stats(_t(spark, sf_dir).lineitem, "l_extendedprice", ["l_returnflag"])


@query("histogram", """
WITH r AS (SELECT MIN(CAST(l_extendedprice AS DOUBLE)) AS mn, MAX(CAST(l_extendedprice AS DOUBLE)) AS mx FROM lineitem),
c AS (SELECT CAST(CASE WHEN mx = mn THEN 1 ELSE LEAST(FLOOR(CAST(60.0 AS DOUBLE) * (CAST(l_extendedprice AS DOUBLE) - mn) / (mx - mn)) + 1, 60) END AS INTEGER) AS bin,
        COUNT(*) AS cnt FROM lineitem, r WHERE l_extendedprice IS NOT NULL GROUP BY 1),
g AS (SELECT CAST(unnest(range(1, 61)) AS INTEGER) AS bin)
SELECT g.bin, mn + (g.bin - 1) * ((mx - mn) / 60) AS bin_start, mn + g.bin * ((mx - mn) / 60) AS bin_end,
  CAST(COALESCE(c.cnt, 0) AS BIGINT) AS count
FROM g CROSS JOIN r LEFT JOIN c ON g.bin = c.bin""")
def q_histogram(spark, sf_dir):
    return ST.histogram(_t(spark, sf_dir).lineitem, "l_extendedprice", 60)


@query("kde_grid", """
WITH b AS (UNPIVOT (SELECT * EXCLUDE (id) FROM x_fraud) ON COLUMNS(* EXCLUDE (Class)) INTO NAME "column" VALUE v),
st AS (SELECT Class, "column", COUNT(*) AS n, STDDEV_SAMP(v) * POW(CAST(COUNT(*) AS DOUBLE), -0.2) AS bw, MIN(v) AS mn, MAX(v) AS mx
       FROM b GROUP BY Class, "column"),
pts AS (SELECT Class, "column", n, bw, p AS point, mn + (mx - mn) * p / 49 AS x
        FROM st, (SELECT CAST(unnest(range(0, 50)) AS INTEGER) AS p) g)
SELECT pts.Class, pts."column", pts.point, ROUND(x + 1e-9, 9) AS x,
  ROUND(SUM(exp(-0.5 * ((x - v) / bw) * ((x - v) / bw))) / (n * bw * 2.5066282746310002) + 1e-9, 9) AS density
FROM pts JOIN b ON pts.Class = b.Class AND pts."column" = b."column" GROUP BY pts.Class, pts."column", pts.point, x, n, bw""")
def q_kde_grid(spark, sf_dir):
    f = X.x_fraud(_t(spark, sf_dir))
    return ST.kde_grid(f, [c for c in f.columns if c not in ("id", "Class")], ["Class"], grid=50)


@query("value_counts_by_label", """
SELECT o_orderstatus, COUNT(*) AS count FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY o_orderstatus""")
def q_value_counts_by_label(spark, sf_dir):
    """O-2: counts in descending order of the label."""
    return ST.value_counts(_t(spark, sf_dir).orders, "o_orderstatus", by_label=True)


@query("cooccurrence", """
SELECT CAST(SUM(snap_A & has_event) AS BIGINT) AS "both", CAST(SUM(snap_A) AS BIGINT) AS n_snap_A,
  COUNT(*) AS n_rows, CASE WHEN SUM(snap_A) = 0 THEN NULL ELSE SUM(snap_A & has_event) / SUM(snap_A) END AS share_given_snap_A
FROM (SELECT snap_A, CASE WHEN event_name_1 IS NOT NULL THEN 1 ELSE 0 END AS has_event FROM x_calendar) c""")
def q_cooccurrence(spark, sf_dir):
    cal = X.x_calendar(_t(spark, sf_dir)).withColumn("has_event", F.when(F.col("event_name_1").isNotNull(), 1).otherwise(0))
    return ST.cooccurrence(cal, "snap_A", "has_event")


@query("row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in BASE_TABLES))
def q_row_counts(spark, sf_dir):
    t = _t(spark, sf_dir)
    return ST.row_counts({n: t[n] for n in BASE_TABLES})


@query("row_reduce", f"""
SELECT {', '.join(_recode_sql(f) + ' AS ' + f for f in SV.FLAG_COLS)},
  GREATEST({', '.join(_recode_sql(f) for f in SV.FLAG_COLS)}) AS row_max,
  COALESCE({', '.join(_recode_sql(f) for f in SV.FLAG_COLS)}) IS NOT NULL AS any_not_null
FROM x_survey""")
def q_row_reduce(spark, sf_dir):
    s = X.x_survey(_t(spark, sf_dir))
    rec = s.select(*[S.recode(f, SV.BOOL_RECODE).cast("int").alias(f) for f in SV.FLAG_COLS])
    return rec.select("*", S.row_max(SV.FLAG_COLS).alias("row_max"),
                      S.row_any_not_null(SV.FLAG_COLS).alias("any_not_null"))


ORDERS_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]


@query("profile_schema", " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", '{t}' AS type, COUNT({c}) AS non_null FROM orders"
    for i, (c, t) in enumerate(ORDERS_TYPES)))
def q_profile_schema(spark, sf_dir):
    return ST.profile_schema(_t(spark, sf_dir).orders)

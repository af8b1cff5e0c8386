"""Registered queries: classifier metrics (L-6, L-9..L-16) and the model operators (L-1..L-8)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.functions.scalars import round_nudged
from tessera.operators import classify as C
from tessera.operators import metrics as M
from tessera.plans.registry import query
from tessera.sources import fixtures as X
from tessera.sources.catalog import Sources

THRESHOLD = 0.05
FEATS = [f"v{i}" for i in range(64)]


def _scores(spark, sf_dir):
    return X.x_scores(Sources.parquet_dir(spark, sf_dir))


def _scores_split(spark, sf_dir):
    li = Sources.parquet_dir(spark, sf_dir).lineitem
    return li.select(
        F.col("l_discount").alias("score"), F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        F.when(F.col("l_orderkey") % 5 == 0, "test").when(F.col("l_orderkey") % 5 == 1, "valid")
        .otherwise("train").alias("split"))


CURVE = {
    "s_g": "SELECT score, SUM(label) AS pos, SUM(1 - label) AS neg FROM x_scores GROUP BY score",
    "s_c": """
SELECT score, pos, neg, SUM(pos) OVER (ORDER BY score DESC) AS tp, SUM(neg) OVER (ORDER BY score DESC) AS fp,
  (SELECT SUM(pos) FROM s_g) AS P, (SELECT SUM(neg) FROM s_g) AS N FROM s_g""",
    "s_pr": """
SELECT score AS threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / P AS recall FROM s_c""",
}


@query("roc_curve", "SELECT score AS threshold, CAST(fp AS DOUBLE) / N AS fpr, CAST(tp AS DOUBLE) / P AS tpr FROM s_c",
       extra=CURVE)
def q_roc_curve(spark, sf_dir):
    return M.roc_curve(_scores(spark, sf_dir))


@query("auc", """
SELECT ROUND(SUM((CAST(neg AS DOUBLE) / N) * (2 * tp - pos) / (2 * P)) + 1e-9, 9) AS auc FROM s_c""", extra=CURVE)
def q_auc(spark, sf_dir):
    return M.auc(_scores(spark, sf_dir)).select(round_nudged("auc", 9).alias("auc"))


@query("pr_curve", "SELECT * FROM s_pr", extra=CURVE)
def q_pr_curve(spark, sf_dir):
    return M.pr_curve(_scores(spark, sf_dir))


@query("average_precision", """
SELECT ROUND(SUM((CAST(pos AS DOUBLE) / P) * (CAST(tp AS DOUBLE) / (tp + fp))) + 1e-9, 9) AS average_precision
FROM s_c""", extra=CURVE)
def q_average_precision(spark, sf_dir):
    return M.average_precision(_scores(spark, sf_dir)).select(
        round_nudged("average_precision", 9).alias("average_precision"))


THRESH_SQL = "SELECT *, 2 * precision * recall / (precision + recall + 1e-8) AS f1 FROM s_pr"


@query("threshold_table", THRESH_SQL, extra=CURVE)
def q_threshold_table(spark, sf_dir):
    return M.threshold_table(_scores(spark, sf_dir))


@query("best_threshold", f"SELECT arg_max(threshold, (f1, -threshold)) AS threshold, MAX(f1) AS f1 FROM ({THRESH_SQL}) t",
       extra=CURVE)
def q_best_threshold(spark, sf_dir):
    return M.best_threshold(_scores(spark, sf_dir))


def _bm_sql(src: str, by: str | None) -> str:
    g = f"{by}, " if by else ""
    return f"""
SELECT {g}tp, fp, fn, tn,
  ROUND(CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) + 1e-9, 6) AS accuracy,
  ROUND(COALESCE(CASE WHEN tp + fp = 0 THEN NULL ELSE CAST(tp AS DOUBLE) / (tp + fp) END, 0.0) + 1e-9, 6) AS precision,
  ROUND(COALESCE(CASE WHEN tp + fn = 0 THEN NULL ELSE CAST(tp AS DOUBLE) / (tp + fn) END, 0.0) + 1e-9, 6) AS recall,
  ROUND(COALESCE(CASE WHEN 2 * tp + fp + fn = 0 THEN NULL ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END, 0.0) + 1e-9, 6) AS f1
FROM (SELECT {g}
  CAST(SUM(CASE WHEN score >= {THRESHOLD} AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
  CAST(SUM(CASE WHEN score >= {THRESHOLD} AND label <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(SUM(CASE WHEN score < {THRESHOLD} AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(SUM(CASE WHEN score < {THRESHOLD} AND label <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn
  FROM {src} {f'GROUP BY {by}' if by else ''}) c"""


@query("binary_metrics", _bm_sql("x_scores", None))
def q_binary_metrics(spark, sf_dir):
    return M.binary_metrics(_scores(spark, sf_dir), THRESHOLD)


@query("confusion", f"""
SELECT label AS actual, CAST(SUM(CASE WHEN score < {THRESHOLD} THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS pred_0,
  CAST(SUM(CASE WHEN score >= {THRESHOLD} THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS pred_1
FROM x_scores GROUP BY label""")
def q_confusion(spark, sf_dir):
    return M.confusion(_scores(spark, sf_dir), THRESHOLD)


SPLIT_SQL = """
SELECT l_discount AS score, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
  CASE WHEN l_orderkey % 5 = 0 THEN 'test' WHEN l_orderkey % 5 = 1 THEN 'valid' ELSE 'train' END AS split FROM lineitem"""


def _report_sql(src: str, bm: str) -> str:
    """The metric rows of every split of ``src``, and the AUC gap valid − test."""
    return f"""
g AS (SELECT split, score, SUM(label) AS pos, SUM(1 - label) AS neg FROM {src} GROUP BY split, score),
c AS (SELECT split, pos, neg, SUM(pos) OVER (PARTITION BY split ORDER BY score DESC) AS tp,
        SUM(pos) OVER (PARTITION BY split) AS P, SUM(neg) OVER (PARTITION BY split) AS N FROM g),
a AS (SELECT split, SUM((CAST(neg AS DOUBLE) / N) * (2 * tp - pos) / (2 * P)) AS auc FROM c GROUP BY split),
report AS (
SELECT split, 'accuracy' AS metric, ROUND(CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) + 1e-9, 6) AS value FROM {bm}
UNION ALL SELECT split, 'precision', ROUND(CAST(tp AS DOUBLE) / (tp + fp) + 1e-9, 6) FROM {bm}
UNION ALL SELECT split, 'recall', ROUND(CAST(tp AS DOUBLE) / (tp + fn) + 1e-9, 6) FROM {bm}
UNION ALL SELECT split, 'f1', ROUND(CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) + 1e-9, 6) FROM {bm}
UNION ALL SELECT split, 'auc', ROUND(auc + 1e-9, 6) FROM a
UNION ALL SELECT 'valid-test', 'auc_gap', ROUND(MAX(auc) FILTER (split = 'valid') - MAX(auc) FILTER (split = 'test') + 1e-9, 6) FROM a)"""


@query("evaluate", f"""
WITH s AS ({SPLIT_SQL}),
bm AS ({_bm_sql('s', 'split')}),{_report_sql('s', 'bm')}
SELECT * FROM report""")
def q_evaluate(spark, sf_dir):
    return M.evaluate(_scores_split(spark, sf_dir), "split", THRESHOLD)


@query("evaluate_at_best", f"""
WITH s AS (SELECT * FROM ({SPLIT_SQL}) z WHERE split IN ('valid', 'test')),
v AS (SELECT score, SUM(label) AS pos, COUNT(*) AS n FROM s WHERE split = 'valid' GROUP BY score),
cum AS (SELECT score, SUM(pos) OVER w AS tp, SUM(n) OVER w AS taken, SUM(pos) OVER () AS P FROM v WINDOW w AS (ORDER BY score DESC)),
pr AS (SELECT score, CAST(tp AS DOUBLE) / taken AS p, CAST(tp AS DOUBLE) / P AS r FROM cum),
best AS (SELECT score AS threshold FROM pr ORDER BY 2 * p * r / (p + r + 1e-8) DESC, score LIMIT 1),
hit AS (SELECT split, label, score >= threshold AS pred FROM s, best),
bm AS (SELECT split, COUNT(*) FILTER (pred AND label = 1) AS tp, COUNT(*) FILTER (pred AND label = 0) AS fp,
         COUNT(*) FILTER (NOT pred AND label = 1) AS fn, COUNT(*) FILTER (NOT pred AND label = 0) AS tn FROM hit GROUP BY split),{_report_sql('s', 'bm')}
SELECT * FROM report UNION ALL SELECT 'valid', 'threshold', CAST(threshold AS DOUBLE) FROM best""")
def q_evaluate_at_best(spark, sf_dir):
    return M.evaluate_at_best(_scores_split(spark, sf_dir), "split")


def _fraud(spark, sf_dir):
    return X.x_fraud(Sources.parquet_dir(spark, sf_dir))


@query("balanced_weights", """
SELECT Class, n_c, CAST(SUM(n_c) OVER () AS DOUBLE) / (COUNT(*) OVER () * n_c) AS weight
FROM (SELECT Class, COUNT(*) AS n_c FROM x_fraud GROUP BY Class) c""")
def q_balanced_weights(spark, sf_dir):
    return M.balanced_weights(_fraud(spark, sf_dir), "Class")


@query("class_profile", """
WITH b AS (UNPIVOT (SELECT * EXCLUDE (id) FROM x_fraud) ON COLUMNS(* EXCLUDE (Class)) INTO NAME "column" VALUE v),
q AS (SELECT Class, "column", MIN(v) AS min, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
        quantile_cont(v, 0.75) AS q3, MAX(v) AS max FROM b GROUP BY Class, "column"),
bx AS (SELECT q.*, MIN(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_low,
         MAX(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_high,
         CAST(SUM(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers
       FROM q JOIN b USING (Class, "column") GROUP BY ALL),
cnt AS (SELECT Class, COUNT(*) AS n FROM x_fraud GROUP BY Class)
SELECT cnt.Class, cnt.n, CAST(cnt.n AS DOUBLE) / (SELECT COUNT(*) FROM x_fraud) AS share, bx."column", bx.min, bx.q1, bx.median, bx.q3, bx.max,
  bx.whisker_low, bx.whisker_high, bx.n_outliers FROM cnt JOIN bx USING (Class)""")
def q_class_profile(spark, sf_dir):
    return C.class_profile(_fraud(spark, sf_dir), "Class", FEATS)


# ---- model operators: not SQL-expressible; checked by row counts here and by property tests

def _split(spark, sf_dir):
    return C.stratified_split(_fraud(spark, sf_dir), "Class", "id", seed=42)


def uniform_sql(ident: str, seed: int = 42, salt: int = 0) -> str:
    """The draw of ``hash_uniform`` in SQL."""
    return f"CAST(CAST('0x' || substr(md5('{seed}:{salt}:' || {ident}), 1, 13) AS BIGINT) AS DOUBLE) / {2 ** 52}.0::DOUBLE"


SPLIT_ROWS = {"s_split": f"""
SELECT * EXCLUDE (place, n_test, n_rest), CASE WHEN place <= n_test THEN 'test' WHEN place <= n_test + CAST(ROUND(n_rest * 0.2) AS BIGINT) THEN 'valid' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY Class ORDER BY {uniform_sql('id')}, id) AS place,
        CAST(ROUND(COUNT(*) OVER (PARTITION BY Class) * 0.2) AS BIGINT) AS n_test,
        COUNT(*) OVER (PARTITION BY Class) - CAST(ROUND(COUNT(*) OVER (PARTITION BY Class) * 0.2) AS BIGINT) AS n_rest FROM x_fraud) z"""}


@query("stratified_split", "SELECT id, Class, split FROM s_split", extra=SPLIT_ROWS)
def q_stratified_split(spark, sf_dir):
    return _split(spark, sf_dir).select("id", "Class", "split")


@query("stratified_split_sizes", "SELECT Class, split, COUNT(*) AS n FROM s_split GROUP BY Class, split", extra=SPLIT_ROWS)
def q_stratified_split_sizes(spark, sf_dir):
    return _split(spark, sf_dir).groupBy("Class", "split").agg(F.count(F.lit(1)).alias("n"))


@query("stratified_folds", f"""
SELECT id, Class, CAST((row_number() OVER (PARTITION BY Class ORDER BY {uniform_sql('id', salt=7)}, id) - 1) % 3 AS INTEGER) AS fold
FROM s_split WHERE split = 'train'""", extra=SPLIT_ROWS)
def q_stratified_folds(spark, sf_dir):
    train = _split(spark, sf_dir).filter(F.col("split") == "train")
    return C.stratified_folds(train, "Class", "id", 3).select("id", "Class", F.col("_fold").alias("fold"))


@query("smote")
def q_smote(spark, sf_dir):
    # The fixture's minority share (~11 %) is above the original ratio 0.1,
    # which would add no rows; 0.5 exercises the oversampling.
    train = _split(spark, sf_dir).filter(F.col("split") == "train").drop("split")
    return C.smote(train, "Class", FEATS, "id", ratio=0.5, k=5, seed=42)


def _scaled(spark, sf_dir):
    s = _split(spark, sf_dir)
    tr, va, te = (s.filter(F.col("split") == x) for x in ("train", "valid", "test"))
    return C.robust_scale(tr, va, te, features=FEATS)


def _robust_sql() -> str:
    quartiles = ", ".join(f"quantile_cont({c}, 0.25) AS {c}_low, quantile_cont({c}, 0.5) AS {c}_mid, quantile_cont({c}, 0.75) AS {c}_high" for c in FEATS)
    scaled = ", ".join(f"ROUND(({c} - {c}_mid) / CASE WHEN {c}_high = {c}_low THEN 1 ELSE {c}_high - {c}_low END + 1e-9, 6)" for c in FEATS)
    return f"WITH q AS (SELECT {quartiles} FROM s_split WHERE split = 'train') SELECT id, Class, [{scaled}] AS scaled FROM s_split, q WHERE split = 'train'"


@query("robust_scale", _robust_sql(), extra=SPLIT_ROWS)
def q_robust_scale(spark, sf_dir):
    tr, va, te = _scaled(spark, sf_dir)
    return tr.select("id", "Class", F.transform(vector_to_array("scaled"), lambda x: F.round(x + F.lit(1e-9), 6)).alias("scaled"))


@query("pca_variance")
def q_pca_variance(spark, sf_dir):
    tr, va, te = _scaled(spark, sf_dir)
    (ptr, pva), k, cum = C.pca_variance(tr, va, variance=0.99)
    return ptr.select("id", "Class", vector_to_array("pca").alias("pca"))


@query("pca_curve")
def q_pca_curve(spark, sf_dir):
    """W-8: cumulative share of the variance by number of components."""
    tr, _, _ = _scaled(spark, sf_dir)
    _, _, shares = C.pca_variance(tr, variance=0.99)
    return spark.createDataFrame([(i + 1, c) for i, c in enumerate(shares)], "component int, cumulative double")


@query("rf_fit")
def q_rf_fit(spark, sf_dir):
    tr, va, te = _scaled(spark, sf_dir)
    model = C.rf_fit(tr, "scaled", "Class", num_trees=150, seed=42)
    return C.positive_probability(model, va).select("id", "Class", "score")


@query("random_search")
def q_random_search(spark, sf_dir):
    tr, va, te = _scaled(spark, sf_dir)
    tr = M.with_balanced_weights(tr, "Class")  # class_weight='balanced'
    cv = C.random_search(tr, "scaled", "Class", n_iter=20, folds=3, seed=42, id_col="id", weight_col="weight")
    return C.positive_probability(cv.bestModel, va).select("id", "Class", "score")


@query("isolation_forest")
def q_isolation_forest(spark, sf_dir):
    s = _split(spark, sf_dir)
    tr = s.filter(F.col("split") == "train")
    model = C.isolation_forest(tr, FEATS, "id", n_trees=100, sample=256, contamination=0.1, seed=42)
    return model.flag(s).select("id", "Class", "split", "outlier")


@query("class_top_corr", """
WITH long AS (UNPIVOT (SELECT * EXCLUDE (id), id FROM x_fraud) ON COLUMNS(* EXCLUDE (id)) INTO NAME col VALUE val),
cw AS (
  SELECT l.col AS c, ROUND(CASE WHEN stddev_pop(l.val) * stddev_pop(t.val) = 0 THEN NULL
                           ELSE covar_pop(l.val, t.val) / (stddev_pop(l.val) * stddev_pop(t.val)) END + 1e-9, 6) AS corr
  FROM long l JOIN long t ON l.id = t.id AND t.col = 'Class' WHERE l.col <> 'Class' GROUP BY l.col),
top AS (SELECT c FROM cw ORDER BY abs(corr) DESC NULLS LAST, c LIMIT 10),
names AS (SELECT c FROM top UNION ALL SELECT 'Class'),
pairs AS (SELECT a.col AS col_a, b.col AS col_b, CAST(a.val AS DOUBLE) AS x, CAST(b.val AS DOUBLE) AS y
          FROM long a JOIN long b ON a.id = b.id
          WHERE a.col IN (SELECT c FROM names) AND b.col IN (SELECT c FROM names))
SELECT col_a, col_b, ROUND(CASE WHEN stddev_pop(x) * stddev_pop(y) = 0 THEN NULL
                           ELSE covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) END + 1e-9, 6) AS corr
FROM pairs GROUP BY col_a, col_b""")
def q_class_top_corr(spark, sf_dir):
    """A-17 / L-16: the 10 features most correlated with the class (|corr|), and their matrix."""
    from tessera.operators import stats as ST
    return ST.top_corr(_fraud(spark, sf_dir), "Class", 10, FEATS + ["Class"])

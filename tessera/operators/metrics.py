"""Binary-classifier evaluation.

Curves and areas come from one distributed prefix sum over distinct
scores (``ordered.running_counts``).  With tp/fp the cumulative counts
at a score and pos/neg the counts *at* that score, the previous curve
point is (tp − pos, fp − neg), so the trapezoid AUC and the average
precision are plain sums — no lag window over a global order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import round_nudged
from tessera.operators.ordered import running_counts

F1_EPS = 1e-8  # the original adds 1e-8 to the F1 denominator


def _curve(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    by = list(by)
    rc = running_counts(df, score, label, by)
    if not by:
        p = rc.agg(F.sum("pos")).scalar()
        n = rc.agg(F.sum("neg")).scalar()
        return rc.withColumns({"P": p, "N": n})
    totals = rc.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return rc.join(totals, by)


# L-10
def roc_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score; (0, 0) is implicit."""
    c = _curve(df, score, label)
    return c.select(F.col("score").alias("threshold"),
                    F.try_divide(F.col("fp"), F.col("N")).alias("fpr"),
                    F.try_divide(F.col("tp"), F.col("P")).alias("tpr"))


def auc(df: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """Trapezoid ROC AUC over distinct thresholds (a tie block is one step), per group."""
    c = _curve(df, score, label, by)
    term = (F.col("neg") / F.col("N")) * (2 * F.col("tp") - F.col("pos")) / (2 * F.col("P"))
    return c.groupBy(*by).agg(F.sum(term).alias("auc"))


# L-11
def pr_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    c = _curve(df, score, label)
    return c.select(F.col("score").alias("threshold"),
                    F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                    F.try_divide(F.col("tp"), F.col("P")).alias("recall"))


def average_precision(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """AP = Σ (R_i − R_{i−1}) · P_i over descending thresholds."""
    c = _curve(df, score, label)
    term = (F.col("pos") / F.col("P")) * (F.col("tp") / (F.col("tp") + F.col("fp")))
    return c.agg(F.sum(term).alias("average_precision"))


# L-12
def threshold_table(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    c = pr_curve(df, score, label)
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F.lit(F1_EPS))
    return c.withColumn("f1", f1)


# L-13 / O-5
def best_threshold(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Threshold with the largest F1; ties → the smallest threshold."""
    t = threshold_table(df, score, label)
    return t.agg(F.max_by("threshold", F.struct(F.col("f1"), -F.col("threshold"))).alias("threshold"),
                 F.max("f1").alias("f1"))


# L-9
def binary_metrics(df: DataFrame, threshold: float | Column, score: str = "score", label: str = "label",
                   by: Sequence[str] = (), digits: int | None = 6) -> DataFrame:
    """Accuracy, precision, recall and F1 at ``score >= threshold`` (one aggregation)."""
    pred = F.col(score) >= F.lit(threshold)
    y = F.col(label) == 1
    agg = df.groupBy(*by).agg(
        F.sum(F.when(pred & y, 1).otherwise(0)).cast("bigint").alias("tp"),
        F.sum(F.when(pred & ~y, 1).otherwise(0)).cast("bigint").alias("fp"),
        F.sum(F.when(~pred & y, 1).otherwise(0)).cast("bigint").alias("fn"),
        F.sum(F.when(~pred & ~y, 1).otherwise(0)).cast("bigint").alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))
    acc = F.try_divide(tp + tn, tp + fp + fn + tn)
    out = {"accuracy": acc, "precision": prec, "recall": rec, "f1": f1}
    if digits is not None:
        out = {k: round_nudged(v, digits) for k, v in out.items()}
    return agg.withColumns(out)


# L-14
def confusion(df: DataFrame, threshold: float, score: str = "score", label: str = "label") -> DataFrame:
    """Row-normalised confusion matrix: share of each predicted class per actual class."""
    pred = F.when(F.col(score) >= F.lit(threshold), 1).otherwise(0)
    g = (df.withColumn("_pred", pred).groupBy(F.col(label).alias("actual"))
         .pivot("_pred", [0, 1]).count().fillna(0, subset=["0", "1"]))
    tot = F.col("0") + F.col("1")
    return g.select("actual", (F.col("0") / tot).alias("pred_0"), (F.col("1") / tot).alias("pred_1"))


# L-6
def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Class weight n / (k · n_c) per class (k = number of classes)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    n = counts.agg(F.sum("n_c")).scalar()
    k = counts.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", n / (k * F.col("n_c")))


def with_balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Attach the class weight to every row (one row per class)."""
    w = balanced_weights(df, label).select(label, F.col("weight").alias(out))
    return df.join(w, label, "left")


# L-15
def evaluate(df: DataFrame, split: str, threshold: float = 0.5, score: str = "score", label: str = "label",
             digits: int = 6, gap: tuple[str, str] | None = ("valid", "test")) -> DataFrame:
    """Metric report (split, metric, value) for every split, plus a row
    (``valid-test``, auc_gap) with the AUC of the first split of ``gap`` less
    that of the second (NULL where one is missing)."""
    bm = binary_metrics(df, threshold, score, label, by=[split], digits=None)
    long = bm.select(split, F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in ["accuracy", "precision", "recall", "f1"]])).alias("r")).select(split, "r.metric", "r.value")
    a = auc(df, score, label, by=[split]).select(split, F.lit("auc").alias("metric"), F.col("auc").alias("value"))
    out = long.unionByName(a)
    if gap:
        of = lambda s: F.max(F.when(F.col(split) == s, F.col("value")))
        out = out.unionByName(a.agg((of(gap[0]) - of(gap[1])).alias("value")).select(F.lit("-".join(gap)).alias(split), F.lit("auc_gap").alias("metric"), "value"))
    return out.withColumn("value", round_nudged("value", digits))


def evaluate_at_best(df: DataFrame, split: str, chosen_on: str = "valid", judged_on: str = "test", score: str = "score",
                     label: str = "label", digits: int = 6) -> DataFrame:
    """L-13: the threshold with the best F1 on ``chosen_on``, applied to that
    split and to ``judged_on``: their metric report, and the threshold itself
    as a row.  The threshold is a scalar subquery, not a driver round trip."""
    best = best_threshold(df.filter(F.col(split) == chosen_on), score, label)
    both = df.filter(F.col(split).isin(chosen_on, judged_on))
    report = evaluate(both, split, best.select("threshold").scalar(), score, label, digits, (chosen_on, judged_on))
    return report.unionByName(best.select(F.lit(chosen_on).alias(split), F.lit("threshold").alias("metric"), F.col("threshold").cast("double").alias("value")))

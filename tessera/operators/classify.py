"""Imbalanced binary classification on ``pyspark.ml``.

Randomness is replaced by seeded hashes of row ids (md5), so a
result does not depend on partitioning or on task retries.  Exact global
ranks come from counts per prefix of the hash (``hash_rank``, ``hash_cuts``),
never from a window over one unpartitioned group.
"""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import forest
from tessera.operators.joins import sized
from tessera.operators.ordered import distributed_rank, hash_cuts, hash_rank  # noqa: F401 (distributed_rank: for callers)
from tessera.operators.stats import exact_quantiles
from tessera.session import ensure_checkpoint_dir, held

def hash_uniform(*cols: Column | str, seed: int = 42, salt: int = 0) -> Column:
    """Deterministic uniform [0, 1) from the first 52 bits of an md5 of
    ``seed:salt:values``: any engine that has md5 draws the same."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(str(salt)), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


# L-1
def stratified_split(df: DataFrame, label: str, id_col: str, test: float = 0.2, valid: float = 0.2,
                     seed: int = 42, out: str = "split") -> DataFrame:
    """Exact per-class shares: test = round(n_c·test), valid = round((n_c − test_c)·valid).

    Rows are ordered within their class by a seeded hash of the id.  Only the
    two cuts of a class are looked for (``hash_cuts``: counts per prefix of the
    hash, ranks within the prefix that holds a cut); every row is then decided
    where it stands, by comparing its hash and id with its class's cuts, so
    its features are never moved.  Default 64/16/20 like the original
    two-stage split.
    """
    h = df.withColumn("_u", hash_uniform(id_col, seed=seed))
    n = df.groupBy(F.col(label).alias("_by")).agg(F.count(F.lit(1)).alias("_n"))
    n = n.withColumn("_nt", F.round(F.col("_n") * test).cast("bigint"))
    n = n.withColumn("_nv", F.round((F.col("_n") - F.col("_nt")) * valid).cast("bigint"))
    wanted = n.select("_by", F.explode(F.array(F.struct(F.lit("test").alias("_cut"), F.col("_nt").alias("_at")),
                                               F.struct(F.lit("valid").alias("_cut"), (F.col("_nt") + F.col("_nv")).alias("_at")))).alias("c")).select("_by", "c._cut", "c._at")
    cuts = sized(hash_cuts(h, label, "_u", id_col, wanted).groupBy("_by").agg(
        *[F.max(F.when(F.col("_cut") == c, F.struct("_u", "_id"))).alias(f"_{c}") for c in ("test", "valid")]))
    j = h.join(cuts, F.col(label).eqNullSafe(F.col("_by")), "left")
    here = F.struct(F.col("_u"), F.col(id_col).alias("_id"))
    s = F.when(here <= F.col("_test"), "test").when(here <= F.col("_valid"), "valid").otherwise("train")
    return j.withColumn(out, s).drop("_u", "_by", "_test", "_valid")


# ---------------------------------------------------------------- neighbours

KNN_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("nbr_id", T.LongType()),
                           T.StructField("dist", T.DoubleType())])


def _block_knn(k: int, chunk: int = 1024):
    """Per (query block, reference block): the k nearest references of each
    query; queries are processed ``chunk`` at a time so the distance matrix
    held in memory is at most chunk × block_rows."""
    def fn(key, q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if q.empty or r.empty:
            return pd.DataFrame({"id": [], "nbr_id": [], "dist": []})
        rx = np.stack(r["rvec"].to_numpy())
        ri = r["rid"].to_numpy()
        rn = (rx * rx).sum(1)
        kk = min(k, rx.shape[0])
        out_id, out_nbr, out_d = [], [], []
        qall = np.stack(q["vec"].to_numpy())
        qids = q["id"].to_numpy()
        for s in range(0, qall.shape[0], chunk):
            qx, qi = qall[s:s + chunk], qids[s:s + chunk]
            d2 = np.maximum((qx * qx).sum(1)[:, None] + rn[None, :] - 2.0 * qx @ rx.T, 0.0)
            d2[qi[:, None] == ri[None, :]] = np.inf  # a point is not its own neighbour
            idx = np.argpartition(d2, kk - 1, axis=1)[:, :kk] if kk < rx.shape[0] else np.tile(
                np.arange(rx.shape[0]), (qx.shape[0], 1))
            rows = np.repeat(np.arange(qx.shape[0]), idx.shape[1])
            cols = idx.ravel()
            dist = np.sqrt(d2[rows, cols])
            ok = np.isfinite(dist)
            out_id.append(qi[rows][ok])
            out_nbr.append(ri[cols][ok])
            out_d.append(dist[ok])
        return pd.DataFrame({"id": np.concatenate(out_id), "nbr_id": np.concatenate(out_nbr),
                             "dist": np.concatenate(out_d)})
    return fn


def knn_exact(points: DataFrame, id_col: str, vec_col: str, k: int, block_rows: int = 16384,
              queries: DataFrame | None = None) -> DataFrame:
    """Exact k nearest neighbours (Euclidean) of ``queries`` (default: all
    points) among ``points``.

    Both sides are cut into blocks of ``block_rows``; every (query block,
    reference block) pair is one cogrouped ``applyInPandas`` task that
    keeps the k best per query (numpy), and the per-block candidates
    (k × blocks per point, bounded) are merged with a grouped top-k.
    No row pair is materialised as a DataFrame row.  Work is quadratic in
    the number of points, as any exact search is.
    """
    n = points.count()
    b = max(1, math.ceil(n / block_rows))
    p = points.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"),
                      (F.abs(F.xxhash64(id_col)) % b).cast("int").alias("_blk"))
    qsrc = p if queries is None else queries.select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"),
        (F.abs(F.xxhash64(id_col)) % b).cast("int").alias("_blk"))
    q = qsrc.select("id", "vec", F.col("_blk").alias("_qb"),
                    F.explode(F.sequence(F.lit(0), F.lit(b - 1))).alias("_rb"))
    r = p.select(F.col("id").alias("rid"), F.col("vec").alias("rvec"), F.col("_blk").alias("_rb"),
                 F.explode(F.sequence(F.lit(0), F.lit(b - 1))).alias("_qb"))
    cand = q.groupBy("_qb", "_rb").cogroup(r.groupBy("_qb", "_rb")).applyInPandas(_block_knn(k), KNN_SCHEMA)
    return top_k_per_key(cand, "id", "dist", k, tie="nbr_id")


def top_k_per_key(df: DataFrame, key: str, by: str, k: int, tie: str) -> DataFrame:
    """Keep the k smallest ``by`` per key; adds 0-based ``nbr_rank``."""
    w = Window.partitionBy(key).orderBy(F.col(by), F.col(tie))
    return df.withColumn("nbr_rank", F.row_number().over(w) - 1).filter(F.col("nbr_rank") < k)


# L-2
def smote(train: DataFrame, label: str, features: Sequence[str], id_col: str, ratio: float = 0.1, k: int = 5,
          seed: int = 42) -> DataFrame:
    """Oversample the minority class (label 1) by interpolation to ``ratio`` × majority.

    Synthetic sample s: base = minority point #(hash(s) mod n_min), one of
    its k nearest minority neighbours chosen by hash, step u ∈ [0,1) by
    hash: x = base + u·(neighbour − base).  Neighbours are exact, and sought
    only for the base points that are drawn.  Output = train rows + synthetic rows (``synthetic`` = 1, ids negative).
    """
    features = list(features)
    counts = {r[0]: r[1] for r in train.groupBy(label).count().collect()}  # two classes
    n_min, n_maj = counts.get(1, 0), counts.get(0, 0)
    n_new = int(ratio * n_maj) - n_min
    base = train.withColumn("synthetic", F.lit(0))
    if n_new <= 0 or n_min < 2:
        return base
    mino = train.filter(F.col(label) == 1).select(
        F.col(id_col).cast("long").alias("id"), *features,
        F.array(*[F.col(c).cast("double") for c in features]).alias("vec"))
    idx = hash_rank(mino.select("id").withColumn("_u", hash_uniform("id", seed=seed)), [], "_u", "id", out="_idx").select("id", (F.col("_idx") - 1).alias("_idx"))
    syn = train.sparkSession.range(n_new).select(
        F.col("id").alias("sid"),
        (F.abs(F.xxhash64("id", F.lit(seed), F.lit(1))) % n_min).alias("_idx"),
        hash_uniform("id", seed=seed, salt=2).alias("_pick"),
        hash_uniform("id", seed=seed, salt=3).alias("_step"))
    syn = syn.join(idx, "_idx")
    nn = knn_exact(mino, "id", "vec", k, queries=mino.join(syn.select("id").distinct(), "id", "left_semi"))
    syn = syn.join(nn.groupBy("id").agg(F.count(F.lit(1)).alias("_kk")), "id")
    syn = syn.withColumn("nbr_rank", F.floor(F.col("_pick") * F.col("_kk")).cast("int"))
    syn = syn.join(nn.select("id", "nbr_id", "nbr_rank"), ["id", "nbr_rank"])
    b = mino.select("id", *[F.col(c).alias(f"_b_{c}") for c in features])
    nb = mino.select(F.col("id").alias("nbr_id"), *[F.col(c).alias(f"_n_{c}") for c in features])
    syn = syn.join(b, "id").join(nb, "nbr_id")
    new_rows = syn.select(
        (-(F.col("sid") + 1)).cast(train.schema[id_col].dataType).alias(id_col),
        *[(F.col(f"_b_{c}") + F.col("_step") * (F.col(f"_n_{c}") - F.col(f"_b_{c}"))).cast(
            train.schema[c].dataType).alias(c) for c in features],
        F.lit(1).cast(train.schema[label].dataType).alias(label),
        F.lit(1).alias("synthetic"), F.col("id").alias("_base_id"), F.col("nbr_id").alias("_nbr_id"))
    others = [c for c in train.columns if c not in features + [label, id_col]]
    new_rows = new_rows.select(*[F.lit(None).cast(train.schema[c].dataType).alias(c) for c in others],
                               id_col, *features, label, "synthetic", "_base_id", "_nbr_id")
    base = base.withColumn("_base_id", F.lit(None).cast("long")).withColumn("_nbr_id", F.lit(None).cast("long"))
    return base.unionByName(new_rows)


# ---------------------------------------------------------------- scaling / projection / models

def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


# L-3
def robust_scale(train: DataFrame, *others: DataFrame, features: Sequence[str], out: str = "scaled"):
    """(x − median) / IQR with exact quartiles of ``train``; a feature whose IQR
    is 0 is only centred.  Three numbers per feature reach the driver."""
    quartiles = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(train, list(features), [0.25, 0.5, 0.75]).collect()}
    scaled = []
    for c in features:
        spread = quartiles[c, 0.75] - quartiles[c, 0.25]
        scaled.append((F.col(c).cast("double") - F.lit(quartiles[c, 0.5])) / F.lit(spread if spread else 1.0))
    res = [df.withColumn(out, array_to_vector(F.array(*scaled))) for df in (train, *others)]
    return res if others else res[0]


# L-4
def pca_variance(train: DataFrame, *others: DataFrame, input_col: str = "scaled", variance: float = 0.99,
                 out: str = "pca"):
    """PCA keeping the fewest components with cumulative explained variance ≥ ``variance``.

    Features are centred first (Spark's PCA projects uncentred data).
    One full fit gives the explained variances (p values); the projection
    keeps the first k columns of the full projection.
    """
    centre = StandardScaler(inputCol=input_col, outputCol="_c", withMean=True, withStd=False).fit(train)
    tr = centre.transform(train)
    p = len(tr.select("_c").first()[0])
    model = PCA(k=p, inputCol="_c", outputCol="_pfull").fit(tr)
    cum = np.cumsum(model.explainedVariance.toArray())
    k = int(np.searchsorted(cum, variance - 1e-12) + 1)
    k = min(k, p)

    def proj(df):
        d = model.transform(centre.transform(df))
        return d.withColumn(out, array_to_vector(F.slice(vector_to_array("_pfull"), 1, k))).drop("_c", "_pfull")
    res = [proj(train)] + [proj(o) for o in others]
    return (res if others else res[0]), k, [float(x) for x in cum]


# L-5
def rf_fit(train: DataFrame, features_col: str, label: str, num_trees: int = 150, seed: int = 42,
           weight_col: str | None = None, max_depth: int | None = None, **params):
    """Random forest; unlimited depth (``None``) like the original maps to Spark's maximum.
    Beyond ``forest.MLLIB_ROWS`` rows the trees are grown in tasks and stay in a table."""
    rf = _forest(train.sparkSession, featuresCol=features_col, labelCol=label, numTrees=num_trees, seed=seed,
                 maxDepth=_spark_value("maxDepth", max_depth), **params)
    if weight_col:
        rf = rf.setWeightCol(weight_col)
    if forest.grows(rf, train):
        rows = held(forest.training_rows(train, rf))
        if rows.count() > forest.MLLIB_ROWS:
            return forest.fit(rows, rf)
    return rf.fit(_packed(train))


def _forest(spark, **params) -> RandomForestClassifier:
    """A forest learner that keeps the node of every row and tree: without it
    each level sends all trees to the tasks and walks every row from the root."""
    ensure_checkpoint_dir(spark)  # the nodes' lineage is cut there
    return RandomForestClassifier(**({"cacheNodeIds": True} | params))


def _packed(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` in at most as many partitions as there are cores, or as it takes
    at ``rows`` rows each.  A forest makes statistics of every node in every
    partition, also where it has no row of the node, so more partitions make a
    level dearer, and by the number of nodes.  Nothing is shuffled."""
    most = max(1, df.sparkSession.sparkContext.defaultParallelism)
    if rows:
        most = min(most, max(1, math.ceil(df.count() / rows)))
    return df.coalesce(most)


def positive_probability(model, df: DataFrame, out: str = "score") -> DataFrame:
    """Probability of class 1.  A fitted forest holds its training summary, and
    with it the session, which can't be sent to tasks once it has observed a
    metric or set a job tag; a copy has the trees alone."""
    return model.copy().transform(df).withColumn(out, vector_to_array("probability")[1])


# L-7
# The random-search space of the original (trees, depth with
# None = unlimited, minimum samples per leaf, features per split).
PARAM_SPACE = {
    "numTrees": [100, 150, 200, 300],
    "maxDepth": [None, 10, 20, 30, 50],
    "minInstancesPerNode": [1, 2, 4],
    "featureSubsetStrategy": ["sqrt", "log2"],
}
#: Training rows for which a fit of the search takes one more partition; its fits run beside each other.
SEARCH_ROWS = 8192
SPARK_MAX_DEPTH = 30  # Spark's tree depth limit: unlimited and deeper settings map to it


def _spark_value(param: str, v):
    if param == "maxDepth":
        return SPARK_MAX_DEPTH if v is None else min(v, SPARK_MAX_DEPTH)
    return v


def stratified_folds(df: DataFrame, label: str, id_col: str, folds: int, seed: int = 42, out: str = "_fold") -> DataFrame:
    """Fold of every row: its rank within its class, in hash order of the id,
    modulo ``folds``; so each class is spread evenly to within one row."""
    ranked = hash_rank(df.withColumn("_u", hash_uniform(id_col, seed=seed, salt=7)), [label], "_u", id_col)
    return ranked.withColumn(out, F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int")).drop("_u", "_rank")


def random_search(train: DataFrame, features_col: str, label: str, n_iter: int = 20, folds: int = 3,
                  seed: int = 42, id_col: str | None = None, weight_col: str | None = None,
                  parallelism: int = 8, space: Mapping[str, Sequence] = PARAM_SPACE):
    """Random search over ``space`` with stratified k-fold CV and F1 of class 1.

    Parameter maps are drawn on the driver (n_iter small dicts); folds are
    ranks within each class (``stratified_folds``).  Every (map, fold) is fitted
    and judged on its own, at least ``parallelism`` of them at a time; each reads
    the written rows, so they spread over the executors instead of gathering
    where a cached fold is.  Beyond ``forest.MLLIB_ROWS`` rows the trees of all
    maps and folds are grown in tasks, those that maps share once (``forest.search``).
    """
    rng = random.Random(seed)
    rf = _forest(train.sparkSession, featuresCol=features_col, labelCol=label, seed=seed)
    if weight_col:
        rf = rf.setWeightCol(weight_col)
    # distinct draws without replacement from the grid, like a randomized search
    grid_size = 1
    for k, v in space.items():
        grid_size *= len({_spark_value(k, x) for x in v})
    maps, seen = [], set()
    while len(maps) < min(n_iter, grid_size):
        # values that Spark cannot tell apart are one value, before draws are compared
        draw = tuple((k, _spark_value(k, rng.choice(list(v)))) for k, v in space.items())
        if draw in seen:
            continue
        seen.add(draw)
        maps.append({getattr(rf, k): v for k, v in draw})
    # every (map, fold) fit reads the same training rows: cut the lineage once
    # (written once) instead of recomputing split and scaling per fit
    cols = [features_col, label] + ([weight_col] if weight_col else [])
    kept = held(stratified_folds(train, label, id_col or features_col, folds, seed).select(*cols, "_fold"))
    data = _packed(kept, SEARCH_ROWS)
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0)
    parts = [(data.filter(F.col("_fold") != f), data.filter(F.col("_fold") == f)) for f in range(folds)]
    for f, (fit, judge) in enumerate(parts):
        if fit.isEmpty() or judge.isEmpty():
            raise ValueError(f"fold {f} leaves no rows to train or to judge")
    forests = [rf.copy(m) for m in maps]
    if all(forest.grows(x, kept) and x.getMaxBins() == rf.getMaxBins() for x in forests) and kept.count() > forest.MLLIB_ROWS:
        rows = forest.training_rows(kept, rf, "_fold")
        metrics = forest.search(rows, forests, folds)
        average = metrics.mean(axis=1)
        return CrossValidatorModel(forest.fit(rows, forests[int(average.argmax())]), [float(x) for x in average],
                                   stdMetrics=[float(x) for x in metrics.std(axis=1)])

    def metric(job: tuple[int, int]) -> float:
        fit, judge = parts[job[1]]
        return ev.evaluate(rf.fit(fit, maps[job[0]]).copy().transform(judge))

    jobs = [(m, f) for m in range(len(maps)) for f in range(folds)]
    with ThreadPool(min(len(jobs), max(parallelism, train.sparkSession.sparkContext.defaultParallelism))) as pool:
        metrics = np.reshape(pool.map(inheritable_thread_target(train.sparkSession)(metric), jobs, chunksize=1), (len(maps), folds))
    average = metrics.mean(axis=1)
    return CrossValidatorModel(rf.fit(data, maps[int(average.argmax())]), [float(x) for x in average],
                               stdMetrics=[float(x) for x in metrics.std(axis=1)])


# ---------------------------------------------------------------- isolation forest (L-8)

TREE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("split", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("size", T.LongType())])


def _c(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _grow(seed: int, max_depth: int):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = np.stack(pdf["vec"].to_numpy())
        rs = np.random.default_rng(seed * 1_000_003 + tree)
        nodes = []

        def build(idx, depth):
            nid = len(nodes)
            nodes.append(None)
            sub = x[idx]
            if depth >= max_depth or len(idx) <= 1:
                nodes[nid] = (tree, nid, -1, 0.0, -1, -1, len(idx))
                return nid
            lo, hi = sub.min(0), sub.max(0)
            cand = np.flatnonzero(hi > lo)
            if cand.size == 0:
                nodes[nid] = (tree, nid, -1, 0.0, -1, -1, len(idx))
                return nid
            f = int(rs.choice(cand))
            s = float(rs.uniform(lo[f], hi[f]))
            left = idx[sub[:, f] < s]
            right = idx[sub[:, f] >= s]
            li = build(left, depth + 1)
            ri = build(right, depth + 1)
            nodes[nid] = (tree, nid, f, s, li, ri, len(idx))
            return nid

        build(np.arange(x.shape[0]), 0)
        return pd.DataFrame(nodes, columns=[f.name for f in TREE_SCHEMA.fields])
    return fn


class IsolationForestModel:
    """Trees (≤ n_trees × 2·sample nodes, bounded) and the anomaly-score threshold."""

    def __init__(self, trees: pd.DataFrame, sample: int, features: Sequence[str]):
        self.trees = trees
        self.sample = sample
        self.features = list(features)
        self.threshold = None

    def _arrays(self):
        t = self.trees.sort_values(["tree", "node"])
        out = []
        for _, g in t.groupby("tree"):
            out.append((g["feature"].to_numpy(), g["split"].to_numpy(), g["left"].to_numpy(),
                        g["right"].to_numpy(), g["size"].to_numpy()))
        return out

    def score(self, df: DataFrame, out: str = "anomaly_score") -> DataFrame:
        arrays = self._arrays()
        cn = _c(self.sample)
        leaf_adj = np.vectorize(_c)

        @F.pandas_udf("double")
        def score_udf(v: pd.Series) -> pd.Series:
            x = np.stack(v.to_numpy())
            total = np.zeros(x.shape[0])
            for feat, split, left, right, size in arrays:
                node = np.zeros(x.shape[0], dtype=np.int64)
                depth = np.zeros(x.shape[0])
                active = feat[node] >= 0
                while active.any():
                    f = feat[node[active]]
                    go_left = x[active, f] < split[node[active]]
                    node[active] = np.where(go_left, left[node[active]], right[node[active]])
                    depth[active] += 1
                    active = feat[node] >= 0
                total += depth + leaf_adj(size[node].astype(float))
            return pd.Series(np.power(2.0, -(total / len(arrays)) / cn))

        vec = F.array(*[F.col(c).cast("double") for c in self.features])
        return df.withColumn(out, score_udf(vec))

    def flag(self, df: DataFrame, out: str = "outlier") -> DataFrame:
        s = self.score(df, "_s")
        return s.withColumn(out, (F.col("_s") > F.lit(self.threshold)).cast("int")).drop("_s")


def isolation_forest(train: DataFrame, features: Sequence[str], id_col: str, n_trees: int = 100,
                     sample: int = 256, contamination: float = 0.1, seed: int = 42) -> IsolationForestModel:
    """Fit isolation trees on seeded ~min(``sample``, n)-row subsamples, grouped by tree id.

    One rule at every size: a row is drawn by each tree with probability
    min(1, sample/n), independently by hash; the trees that draw it are
    filtered out of the tree numbers inside the row, and only these are
    exploded, so about n_trees·sample rows are shuffled.  A tree's group
    holds about min(sample, n) rows (one ``applyInPandas`` task per tree).  The tree table is small and is
    shipped inside the scoring UDF.  Threshold = (1 − contamination)
    quantile of the training scores (exact, distributed).
    """
    features = list(features)
    n = train.count()
    vec = F.array(*[F.col(c).cast("double") for c in features])
    share = F.lit(min(1.0, sample / max(n, 1)))
    drawn = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: hash_uniform(F.col("_id"), t, seed=seed, salt=11) < share)
    picked = train.select(F.col(id_col).alias("_id"), vec.alias("vec")).select("vec", F.explode(drawn).alias("tree"))
    sample = min(sample, n)
    depth = int(math.ceil(math.log2(max(sample, 2))))
    trees = picked.groupBy("tree").applyInPandas(_grow(seed, depth), TREE_SCHEMA).toPandas()  # bounded table
    model = IsolationForestModel(trees, sample, features)
    scored = held(model.score(train, "_s").select("_s"))  # scored once, scanned by every refinement
    q = exact_quantiles(scored, ["_s"], [1.0 - contamination])
    model.threshold = q.select("value").first()[0]
    return model


# L-16
def class_profile(df: DataFrame, label: str, col: str | Sequence[str]) -> DataFrame:
    """Share of each class and the five-number summary of ``col`` per class
    (of each ``column`` of a list)."""
    from tessera.operators.stats import box_stats
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    counts = counts.withColumn("share", F.col("n") / total)
    return counts.join(box_stats(df, col, [label]), label)

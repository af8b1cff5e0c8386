"""Random forests for more rows than MLlib grows well.

MLlib splits the nodes of all trees a level at a time: every partition makes
and shuffles statistics of every node, and the driver holds the whole forest.
Trees of unlimited depth grow with the rows, and so do both.  Here the rows are
binned once, one byte a value, and every task takes all binned rows and grows
trees of its own, level by level, by MLlib's rules: thresholds at equal
weights, Poisson bootstrap, a feature subset per node, Gini gain, minimum rows
per child, leaves that predict the same joined.  The trees stay in a table, one
row each, and the scores come from blocks of rows and trees that meet in tasks.
The driver gets thresholds and counts, never rows or nodes.

Draws are seeded by the tree, and rows are put in an order of their own first,
so a forest depends neither on partitions nor on the number of tasks.  A
tree's draws are made level by level, so a shallower forest is a deeper one cut
off, and a smaller forest is the first trees of a larger one: a search grows
what its settings share once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import held

#: Training rows up to which MLlib fits a forest; its cost per row grows with the depth of the trees.
MLLIB_ROWS = 4096
#: Trees of one partial sum of votes.  The sums are added in the order of the trees, whatever the tasks.
BLOCK_TREES = 25
#: Rows that meet a block of trees in one scoring task.
BLOCK_ROWS = 65_536
#: Nodes whose histograms are made at a time.
BLOCK_NODES = 4096
#: Nodes and rows, by features, that are looked at in one go.
SIDE_BY_SIDE_NODES, SIDE_BY_SIDE_ROWS = 1024, 1 << 16
SUBSETS = {"all": lambda p: p, "sqrt": lambda p: math.ceil(math.sqrt(p)), "log2": lambda p: max(1, math.ceil(math.log2(p))),
           "onethird": lambda p: max(1, math.ceil(p / 3))}
#: What trees are grown with here; a learner with other settings is MLlib's.
FIXED = {"impurity": "gini", "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0, "subsamplingRate": 1.0, "leafCol": ""}
PACKED = "bins binary, label binary, weight binary, fold binary"
TREES = "tree int, feature binary, bin binary, left binary, share binary"


class Tree(NamedTuple):
    """Nodes level by level; a split's children are ``left`` and ``left`` + 1."""
    feature: np.ndarray  # -1: no split
    bin: np.ndarray      # rows with a bin up to this go left
    left: np.ndarray
    stats: np.ndarray    # weight of every class
    levels: np.ndarray   # where each level begins, and the end


class Settings(NamedTuple):
    trees: int
    depth: int
    min_rows: int
    subset: str
    seed: int
    bootstrap: bool

    @classmethod
    def of(cls, rf: RandomForestClassifier) -> Settings:
        subset = rf.getFeatureSubsetStrategy()
        subset = ("all" if rf.getNumTrees() == 1 else "sqrt") if subset == "auto" else subset
        return cls(rf.getNumTrees(), rf.getMaxDepth(), rf.getMinInstancesPerNode(), subset, rf.getSeed() % 2**64, rf.getBootstrap())


def grows(rf: RandomForestClassifier, train: DataFrame) -> bool:
    """Whether forests of these settings and columns are grown here."""
    plain = [rf.getFeaturesCol(), rf.getLabelCol()]
    return (all(rf.getOrDefault(k) == v for k, v in FIXED.items()) and not rf.isDefined("thresholds") and rf.getMaxBins() <= 256
            and rf.getFeatureSubsetStrategy() in {"auto", *SUBSETS} and not any("ml_attr" in train.schema[c].metadata for c in plain))


# ---------------------------------------------------------------- rows

def training_rows(train: DataFrame, rf: RandomForestClassifier, fold_col: str | None = None) -> DataFrame:
    """Features, label, weight and fold of ``train``."""
    weight = F.col(rf.getWeightCol()).cast("double") if rf.isDefined("weightCol") else F.lit(None).cast("double")
    return train.select(vector_to_array(rf.getFeaturesCol()).alias("x"), F.col(rf.getLabelCol()).cast("double").alias("label"), weight.alias("weight"),
                        (F.col(fold_col).cast("int") if fold_col else F.lit(0)).alias("fold"))


def _matrix(column: pa.Array) -> np.ndarray:
    """A batch of equally long arrays as rows of doubles."""
    if column.null_count:
        raise ValueError("a row has no features")
    flat = column.flatten()
    if flat.null_count or len(flat) % len(column):
        raise ValueError("rows differ in the number of features")
    return np.asarray(flat).reshape(len(column), -1)


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    if batch.column(name).null_count:
        raise ValueError(f"a row has no {name}")
    return np.asarray(batch.column(name))


def split_points(values: np.ndarray, weight: np.ndarray | None, most: int) -> np.ndarray:
    """At most ``most`` thresholds of a feature: halfway between all its distinct
    values, or between those that come nearest to equal weights of rows."""
    if weight is None:
        found, total = np.unique(values, return_counts=True)
        total = total.astype(float)
    else:
        order = np.lexsort((weight, values))
        found, at = np.unique(values[order], return_index=True)
        total = np.add.reduceat(weight[order], at)
    halves = found[:-1] / 2 + found[1:] / 2 if np.abs(found[[0, -1]]).max() > 1e300 else (found[:-1] + found[1:]) / 2
    if len(halves) <= most:
        return halves
    upto = np.cumsum(total)
    middle, stride, points, at = (upto[:-1] + upto[1:]) / 2, upto[-1] / (most + 1), [], 0
    for i in range(1, most + 1):
        at = max(at, int(np.searchsorted(middle, i * stride, side="right")))
        if at == len(halves):
            break
        points.append(halves[at])
        at += 1
    return np.array(points)


def thresholds(rows: DataFrame, weighted: bool, most: int) -> list[np.ndarray]:
    """Thresholds of every feature, from all rows: a feature's values meet in one task."""
    def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("x"))
            if not np.isfinite(x).all():
                raise ValueError("features must be finite numbers")
            weight = _numbers(b, "weight").tobytes() if weighted else None
            yield pa.RecordBatch.from_pydict({"feature": pa.array(range(x.shape[1]), pa.int32()), "x": [np.ascontiguousarray(c).tobytes() for c in x.T],
                                              "weight": pa.array([weight] * x.shape[1], pa.binary())})

    def points(t: pa.Table) -> pa.Table:
        values = np.frombuffer(b"".join(t.column("x").to_pylist()))
        weight = np.frombuffer(b"".join(t.column("weight").to_pylist())) if weighted else None
        return pa.table({"feature": t.column("feature")[:1], "points": pa.array([split_points(values, weight, most).tobytes()], pa.binary())})

    found = rows.select("x", "weight").mapInArrow(columns, "feature int, x binary, weight binary").groupBy("feature").applyInArrow(points, "feature int, points binary").collect()
    return [np.frombuffer(r["points"]) for r in sorted(found, key=lambda r: r["feature"])]


def binned(x: np.ndarray, points: Sequence[np.ndarray]) -> np.ndarray:
    """Number of thresholds below every value; a value that is no number is above all."""
    if x.shape[1] != len(points):
        raise ValueError(f"{x.shape[1]} features instead of {len(points)}")
    out = np.empty(x.shape, np.uint8)
    for i, p in enumerate(points):
        out[:, i] = np.searchsorted(p, x[:, i], side="left")
    return out


def _packed_rows(rows: DataFrame, weighted: bool, points: Sequence[np.ndarray]) -> DataFrame:
    """Binned rows, a row of bytes per batch."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            label = _numbers(b, "label")
            if not ((label >= 0) & (label % 1 == 0)).all():
                raise ValueError("classes must be 0, 1, ...")
            weight = _numbers(b, "weight") if weighted else None
            if weighted and not (weight >= 0).all():
                raise ValueError("weights must be at least 0")
            yield pa.RecordBatch.from_pydict({"bins": [binned(_matrix(b.column("x")), points).tobytes()], "label": [label.astype(np.int32).tobytes()],
                                              "weight": pa.array([weight.tobytes() if weighted else None], pa.binary()),
                                              "fold": [_numbers(b, "fold").astype(np.int32).tobytes()]})
    return held(rows.mapInArrow(pack, PACKED))


def _unpacked(batches: Sequence[pa.RecordBatch], p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray]:
    """Bins, labels, weights and folds of all rows, in an order that only the first three decide."""
    def joined(name: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(v.as_buffer() for b in batches for v in b.column(name) if v.is_valid), kind)
    bins, label, weight, fold = joined("bins", np.uint8).reshape(-1, p), joined("label", np.int32), joined("weight", np.float64), joined("fold", np.int32)
    weight = weight if len(weight) else None
    key = label.astype(np.uint64)
    odd = np.random.default_rng(0).integers(1, 2**63, p + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for i in range(p):
        key = (key ^ bins[:, i]) * odd[i]
        key ^= key >> np.uint64(29)
    if weight is not None:
        key = (key ^ weight.view(np.uint64)) * odd[p]
        key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    return bins[order], label[order].astype(np.intp), None if weight is None else weight[order], fold[order]


def _dealt(packed: DataFrame, units: Sequence, p: int, work, schema: str, beside: int = 1) -> DataFrame:
    """``work(rows, units)`` in tasks that each have all rows and every so manieth
    unit; ``beside`` such calls share the cores."""
    groups = min(len(units), math.ceil(4 * packed.sparkSession.sparkContext.defaultParallelism / beside))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[int, list[pa.RecordBatch]] = {}
        for b in batches:
            numbers = np.asarray(b.column("_group"))
            found = np.unique(numbers)
            for g in found:
                of.setdefault(int(g), []).append(b if len(found) == 1 else b.filter(pa.array(numbers == g)))
        for g in sorted(of):
            yield from work(_unpacked(of.pop(g), p), units[g::groups])

    copies = packed.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return copies.repartitionById(groups, "_group").mapInArrow(run, schema)


# ---------------------------------------------------------------- trees

def _gini(stats: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Gini impurity; the classes are the first axis."""
    out = np.ones_like(total)
    for c in stats:
        share = c / total
        out -= share * share
    return out


def _best_splits(places, node, label, w, times, features, stats, impurity, width, min_rows, read):
    """Best split of nodes: gain, feature and bin.  ``places`` are where the rows
    begin in ``read``, the bins in one line; ``features`` are rows of one feature per node."""
    m, classes = features.shape[1], stats.shape[1]
    total = stats.sum(1)[:, None]
    gain, feature, split = np.full(m, -np.inf), np.zeros(m, np.int32), np.zeros(m, np.uint8)
    every = np.arange(m)
    step = max(1, min(len(features), SIDE_BY_SIDE_NODES // m, SIDE_BY_SIDE_ROWS // max(1, len(node))))
    for j in range(0, len(features), step):
        some = features[j:j + step]
        k = len(some)
        b = read.take(places + some.take(node, axis=1)) + (np.arange(k) * (m * width))[:, None]
        b += node * width
        at = (b + label * (k * m * width)).ravel()
        upto = np.bincount(at, np.broadcast_to(w, b.shape).ravel(), classes * k * m * width).reshape(classes, k, m, width).cumsum(3)
        left = upto[..., :-1]
        right = upto[..., -1:] - left
        nl, nr = left.sum(0), right.sum(0)
        if times is None:
            rl, rr = nl, nr
        else:
            raw = np.bincount(b.ravel(), np.broadcast_to(times, b.shape).ravel(), k * m * width).reshape(k, m, width).cumsum(2)
            rl = raw[..., :-1]
            rr = raw[..., -1:] - rl
        g = impurity[:, None] - (nl / total) * _gini(left, nl) - (nr / total) * _gini(right, nr)
        g[(rl < min_rows) | (rr < min_rows) | (nl <= 0) | (nr <= 0)] = -np.inf
        at = g.argmax(2)
        g = np.take_along_axis(g, at[..., None], 2)[..., 0]
        first = g.argmax(0)
        g = g[first, every]
        better = g > gain
        gain[better], feature[better], split[better] = g[better], some[first, every][better], at[first, every][better]
    return gain, feature, split


def grow(bins: np.ndarray, label: np.ndarray, weight: np.ndarray | None, times: np.ndarray, classes: int, subset: int, min_rows: int,
         max_depth: int, width: int, rng: np.random.Generator) -> Tree:
    """One tree from rows of ``bins`` (below ``width``) that count ``times`` times."""
    p = bins.shape[1]
    drawn = np.flatnonzero(times)
    read, label, times = bins[drawn].ravel(), label[drawn], times[drawn].astype(float)
    w = times if weight is None else times * weight[drawn]
    places, node = np.arange(len(drawn)) * p, np.zeros(len(drawn), np.intp)
    stats, raw = np.bincount(label, w, classes)[None], np.array([times.sum()])
    parts, levels, nodes = [], [0], 0
    with np.errstate(divide="ignore", invalid="ignore"):
        for depth in range(max_depth + 1):
            m = len(stats)
            feature, split, left = np.full(m, -1, np.int32), np.zeros(m, np.uint8), np.zeros(m, np.int32)
            impurity = _gini(stats.T, stats.sum(1))
            tried = np.flatnonzero(raw >= 2 * min_rows) if depth < max_depth else np.empty(0, np.intp)
            if depth:
                tried = tried[np.abs(impurity[tried]) >= np.finfo(float).eps]
            rank = np.full(m, -1)
            rank[tried] = np.arange(len(tried))
            kept = np.flatnonzero(rank.take(node) >= 0)
            places, node, w, times, label = places[kept], node[kept], w[kept], times[kept], label[kept]
            place = rank.take(node)
            for s in range(0, len(tried), BLOCK_NODES):
                some = tried[s:s + BLOCK_NODES]
                if subset < p:
                    features = rng.random((len(some), p), np.float32).argpartition(subset - 1, axis=1)[:, :subset].T.copy()
                else:
                    features = np.broadcast_to(np.arange(p)[:, None], (p, len(some)))
                in_ = slice(None) if len(tried) <= BLOCK_NODES else np.flatnonzero((place >= s) & (place < s + BLOCK_NODES))
                at = place[in_] - s
                gain, f, b = _best_splits(places[in_], at, label[in_], w[in_], None if weight is None else times[in_], features, stats[some], impurity[some],
                                          width, min_rows, read)
                good = gain > 0
                feature[some[good]], split[some[good]] = f[good], b[good]
            parent = np.flatnonzero(feature >= 0)
            left[parent] = nodes + m + 2 * np.arange(len(parent))
            parts.append((feature, split, left, stats))
            nodes += m
            levels.append(nodes)
            if not len(parent):
                break
            rank = np.full(m, -1)
            rank[parent] = np.arange(len(parent))
            kept = np.flatnonzero(rank.take(node) >= 0)
            places, node, w, times, label = places[kept], node[kept], w[kept], times[kept], label[kept]
            node = 2 * rank.take(node) + (read.take(places + feature.take(node)) > split.take(node))
            m = 2 * len(parent)
            stats = np.bincount(node * classes + label, w, m * classes).reshape(m, classes)
            raw = stats.sum(1) if weight is None else np.bincount(node, times, m)
    return Tree(*[np.concatenate([x[i] for x in parts]) for i in range(4)], np.array(levels))


def ends(tree: Tree, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The tree cut off at ``depth``, with leaves that predict the same joined: for every node
    of ``tree`` the leaf or node of the cut tree that its rows come to, and which nodes are leaves."""
    says = tree.stats.argmax(1)
    leaf = tree.feature < 0
    levels = tree.levels
    for d in range(min(depth, len(levels) - 2), -1, -1):
        at = np.arange(levels[d], levels[d + 1])
        if d == depth:
            leaf[at] = True
        else:
            at = at[~leaf[at]]
            a = tree.left[at]
            leaf[at[leaf[a] & leaf[a + 1] & (says[a] == says[a + 1])]] = True
    to = np.arange(len(leaf))
    for d in range(len(levels) - 2):
        at = np.arange(levels[d], levels[d + 1])
        at = at[tree.feature[at] >= 0]
        at = at[leaf[to[at]]]
        to[tree.left[at]] = to[tree.left[at] + 1] = to[at]
    return to, leaf


def pruned(tree: Tree, depth: int) -> Tree:
    """The tree cut off at ``depth`` alone; its levels aren't kept."""
    to, leaf = ends(tree, depth)
    kept = np.flatnonzero(to == np.arange(len(to)))
    new = np.full(len(to) + 1, -1, np.int32)
    new[kept] = np.arange(len(kept))
    leaf = leaf[kept]
    return Tree(np.where(leaf, -1, tree.feature[kept]).astype(np.int32), tree.bin[kept], np.where(leaf, 0, new[tree.left[kept]]).astype(np.int32),
                tree.stats[kept], np.empty(0, np.int64))


def shares(stats: np.ndarray) -> np.ndarray:
    total = stats.sum(1, keepdims=True)
    return np.divide(stats, total, out=np.zeros_like(stats), where=total != 0)


def walk(bins: np.ndarray, feature: np.ndarray, split: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The leaf that every row comes to."""
    read, p = bins.ravel(), bins.shape[1]
    at, live = np.zeros(len(bins), np.intp), np.arange(len(bins))
    while len(live):
        a = at[live]
        f = feature.take(a)
        inner = np.flatnonzero(f >= 0)
        live, a, f = live[inner], a[inner], f[inner]
        at[live] = left.take(a) + (read.take(live * p + f) > split.take(a))
    return at


def _tree(rows, s: Settings, tree: int, classes: int, width: int) -> Tree:
    bins, label, weight = rows
    times = np.random.default_rng([s.seed, tree]).poisson(1.0, len(bins)) if s.bootstrap else np.ones(len(bins))
    return grow(bins, label, weight, times, classes, SUBSETS[s.subset](bins.shape[1]), s.min_rows, s.depth, width, np.random.default_rng([s.seed, tree, 1]))


# ---------------------------------------------------------------- forests

class BinnedRows(NamedTuple):
    """What forests are grown from."""
    packed: DataFrame
    points: list[np.ndarray]
    classes: int

    @property
    def width(self) -> int:
        return max(len(p) for p in self.points) + 1

    @classmethod
    def of(cls, rows: DataFrame, rf: RandomForestClassifier, but: int | None = None) -> BinnedRows:
        """All rows, by thresholds from those outside the fold ``but``."""
        taken = rows if but is None else rows.filter(F.col("fold") != but)
        seen = taken.agg(F.count(F.lit(1)).alias("n"), F.max("label").alias("most")).first()
        if seen["most"] is None or seen["most"] < 1:
            raise ValueError("a forest needs two classes")
        weighted = rf.isDefined("weightCol")
        points = thresholds(taken, weighted, min(rf.getMaxBins(), seen["n"]) - 1)
        return cls(_packed_rows(rows, weighted, points), points, int(seen["most"]) + 1)


def fit(rows: DataFrame, rf: RandomForestClassifier) -> ForestModel:
    """The forest of ``rf`` over ``training_rows``."""
    data = BinnedRows.of(rows, rf)
    s, classes, width = Settings.of(rf), data.classes, data.width

    def work(rows, units) -> Iterator[pa.RecordBatch]:
        for tree in units:
            t = pruned(_tree(rows[:3], s, tree, classes, width), s.depth)
            yield pa.RecordBatch.from_pydict({"tree": pa.array([tree], pa.int32()), "feature": [t.feature.tobytes()], "bin": [t.bin.tobytes()],
                                              "left": [t.left.tobytes()], "share": [shares(t.stats).tobytes()]})

    trees = held(_dealt(data.packed, range(s.trees), len(data.points), work, TREES))
    return ForestModel(trees, data.points, classes, s.trees, {k: rf.getOrDefault(k) for k in ("featuresCol", "rawPredictionCol", "probabilityCol", "predictionCol")})


class ForestModel(Model):
    """A forest in a table, one row a tree; it never comes to the driver."""

    def __init__(self, trees: DataFrame, points: list[np.ndarray], classes: int, num_trees: int, columns: dict[str, str]):
        super().__init__()
        self.trees, self.points, self.numClasses, self.numFeatures, self.getNumTrees, self.columns = trees, points, classes, len(points), num_trees, columns

    @property
    def totalNumNodes(self) -> int:
        return self.trees.agg(F.sum(F.length("bin"))).first()[0]

    def _transform(self, df: DataFrame) -> DataFrame:
        """``df`` (computed once) with raw prediction, probability and prediction as MLlib's."""
        rows = held(df.withColumn("_row", F.monotonically_increasing_id()))
        points, p, classes = self.points, self.numFeatures, self.numClasses
        blocks = max(1, math.ceil(rows.count() / BLOCK_ROWS))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    yield pa.RecordBatch.from_pydict({"chunk": b.column("_row")[:1], "rows": [np.asarray(b.column("_row")).tobytes()], "bins": [binned(_matrix(b.column("x")), points).tobytes()]})

        def score(r: pa.Table, t: pa.Table) -> pa.Table:
            ids = [np.frombuffer(x, np.int64) for x in r.column("rows").to_pylist()]
            bins = np.frombuffer(b"".join(r.column("bins").to_pylist()), np.uint8).reshape(-1, p)
            votes = np.zeros((len(bins), classes))
            for x in sorted(t.to_pylist(), key=lambda x: x["tree"]) if len(bins) else []:
                share = np.frombuffer(x["share"]).reshape(-1, classes)
                votes += share[walk(bins, np.frombuffer(x["feature"], np.int32), np.frombuffer(x["bin"], np.uint8), np.frombuffer(x["left"], np.int32))]
            parts = np.split(votes, np.cumsum([len(i) for i in ids])[:-1]) if ids else []
            return pa.table({"chunk": r.column("chunk"), "block": pa.array(t.column("_trees").to_pylist()[:1] * len(ids), pa.int32()), "rows": pa.array([i.tobytes() for i in ids], pa.binary()),
                             "votes": pa.array([v.tobytes() for v in parts], pa.binary())})

        def add(t: pa.Table) -> pa.Table:
            parts = sorted(zip(t.column("block").to_pylist(), t.column("votes").to_pylist(), strict=True))
            votes = sum(np.frombuffer(v).reshape(-1, classes) for _, v in parts)
            ids = np.frombuffer(t.column("rows")[0].as_py(), np.int64)
            return pa.table({"_row": ids, "_votes": pa.ListArray.from_arrays(np.arange(0, votes.size + 1, classes, np.int32), votes.ravel())})

        some = rows.select("_row", vector_to_array(self.columns["featuresCol"]).alias("x")).mapInArrow(pack, "chunk long, rows binary, bins binary")
        some = held(some.withColumn("_rows", F.pmod(F.xxhash64("chunk"), F.lit(blocks)).cast("int")))
        last = (self.getNumTrees - 1) // BLOCK_TREES
        some = some.withColumn("_trees", F.explode(F.sequence(F.lit(0), F.lit(last))))
        trees = self.trees.withColumn("_trees", F.floor(F.col("tree") / BLOCK_TREES).cast("int")).withColumn("_rows", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        keys = ["_trees", "_rows"]
        parts = some.groupBy(*keys).cogroup(trees.groupBy(*keys)).applyInArrow(score, "chunk long, block int, rows binary, votes binary")
        votes = parts.groupBy("chunk").applyInArrow(add, "_row long, _votes array<double>")
        total = F.aggregate("_votes", F.lit(0.0), lambda a, v: a + v)
        out = rows.join(votes, "_row").withColumn(self.columns["rawPredictionCol"], array_to_vector("_votes"))
        out = out.withColumn(self.columns["probabilityCol"], array_to_vector(F.transform("_votes", lambda v: F.coalesce(F.try_divide(v, total), v))))
        out = out.withColumn(self.columns["predictionCol"], (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double"))
        return out.select(*[c for c in df.columns], *[self.columns[c] for c in ("rawPredictionCol", "probabilityCol", "predictionCol") if self.columns[c]])


# ---------------------------------------------------------------- search

def search(rows: DataFrame, forests: Sequence[RandomForestClassifier], folds: int) -> np.ndarray:
    """F1 of class 1 of every forest and fold.  Forests that differ only in depth and
    number of trees share their trees, grown once to the greatest depth."""
    settings = [Settings.of(rf) for rf in forests]
    alike: dict[Settings, list[int]] = {}
    for i, s in enumerate(settings):
        alike.setdefault(s._replace(trees=0, depth=0), []).append(i)
    units = [(some, first) for some in alike.values() for first in range(0, max(settings[i].trees for i in some), BLOCK_TREES)]

    def judged(fold: int) -> DataFrame:
        data = BinnedRows.of(rows, forests[0], fold)
        classes, width = data.classes, data.width

        def work(all_rows, units) -> Iterator[pa.RecordBatch]:
            bins, label, weight, of = all_rows
            judge, rest = of == fold, of != fold
            train = bins[rest], label[rest], None if weight is None else weight[rest]
            bins, label = bins[judge], label[judge]
            for some, first in units:
                votes = {i: np.zeros((len(bins), classes)) for i in some if settings[i].trees > first}
                for tree in range(first, min(first + BLOCK_TREES, max(settings[i].trees for i in some))):
                    now = [i for i in votes if settings[i].trees > tree]
                    t = _tree(train, max((settings[i] for i in now), key=lambda s: s.depth), tree, classes, width)
                    at, share = walk(bins, t.feature, t.bin, t.left), shares(t.stats)
                    for depth in {settings[i].depth for i in now}:
                        vote = share[ends(t, depth)[0][at]]
                        for i in now:
                            if settings[i].depth == depth:
                                votes[i] += vote
                for i, v in votes.items():
                    yield pa.RecordBatch.from_pydict({"forest": pa.array([i], pa.int32()), "first": pa.array([first], pa.int32()), "votes": [v.tobytes()],
                                                      "label": [label.astype(np.int32).tobytes()]})

        def judge(t: pa.Table) -> pa.Table:
            parts = sorted(zip(t.column("first").to_pylist(), t.column("votes").to_pylist(), strict=True))
            says = sum(np.frombuffer(v).reshape(-1, classes) for _, v in parts).argmax(1) == 1
            one = np.frombuffer(t.column("label")[0].as_py(), np.int32) == 1
            if not one.any():
                raise ValueError(f"fold {fold} has no row of class 1")
            hit = int((says & one).sum())
            precision, recall = hit / max(1, int(says.sum())), hit / int(one.sum())
            return pa.table({"forest": t.column("forest")[:1], "fold": pa.array([fold], pa.int32()), "f1": [2 * precision * recall / (precision + recall) if hit else 0.0]})

        parts = _dealt(data.packed, units, len(data.points), work, "forest int, first int, votes binary, label binary", folds)
        return parts.groupBy("forest").applyInArrow(judge, "forest int, fold int, f1 double")

    out = np.zeros((len(forests), folds))
    for r in reduce(DataFrame.unionAll, map(judged, range(folds))).collect():
        out[r["forest"], r["fold"]] = r["f1"]
    return out

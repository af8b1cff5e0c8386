"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word's input is the sum of its own embedding and the mean embedding of its
character 3- to 5-grams (both hashed).  Overlapping windows of words run
through a GRU in each direction; attention weighs the positions, a logistic
unit scores the window, and a document's score is its highest window's.

The network is trained in numpy, in one task, on a bounded, class-balanced
sample of labelled documents; as a label is a document's, each epoch trains on
every document's highest window so far and on one drawn at random.  Scoring is
one pass over all whole texts, without a shuffle.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.textnum import U, blocks, give_back, lower, mix, span_hash, utf8, words

#: Most labelled documents of each class that are trained on.
SAMPLE_PER_CLASS = 2000
#: Words of a window, words from one window to the next, units of each direction, size of an input, buckets of words and of character n-grams.
WINDOW, STRIDE, HIDDEN, WIDTH, WORD_BUCKETS, GRAM_BUCKETS = 32, 16, 10, 12, 1 << 14, 1 << 17
EPOCHS, BATCH, RATE = 7, 64, 0.01
#: A document is predicted toxic from this score on.
CUTOFF = 0.7

_GRAM = mix(np.arange(1, 6, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)


# -- inputs -------------------------------------------------------------------
class Words:
    """The distinct words of a block: their buckets, their n-grams (flat, with
    offsets), and for the block its words' places among them."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray) -> None:
        low = lower(buf)
        starts, ends, self.bounds = words(low, offsets)
        self.code, first, self.place = np.unique(span_hash(low, starts, ends), return_index=True, return_inverse=True)
        self.bucket = (self.code % U(WORD_BUCKETS)).astype(np.int64)
        starts, length = starts[first], ends[first] - starts[first]
        size = length + 2
        begin = np.cumsum(size) - size
        total = int(size.sum())
        owner = np.repeat(np.arange(len(size)), size)
        inner = np.arange(total) - begin[owner]
        marked = np.where(inner == 0, 1, np.where(inner == size[owner] - 1, 2, 0)).astype(np.uint8)
        letters = np.flatnonzero(marked == 0)
        marked[letters] = low[starts[owner[letters]] + inner[letters] - 1]
        owners, grams = [], []
        for n in (3, 4, 5):
            at = np.flatnonzero(inner + n <= size[owner])
            joint = np.full(len(at), U(n))
            for j in range(n):
                joint += marked[at + j].astype(U) * _GRAM[j]
            owners.append(owner[at])
            grams.append((mix(joint) % U(GRAM_BUCKETS)).astype(np.int32))
        owners, grams = np.concatenate(owners), np.concatenate(grams)
        order = np.argsort(owners, kind="stable")
        self.grams = grams[order]
        self.count = np.bincount(owners, minlength=len(size))
        self.begin = np.cumsum(self.count) - self.count

    @staticmethod
    def of_texts(buf: np.ndarray, offsets: np.ndarray) -> "Words":
        """The same for many texts, made block by block in less memory."""
        parts = [Words(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in blocks(offsets, 1 << 17)]
        if not parts:
            return Words(buf, offsets)
        out = Words.__new__(Words)
        out.code, first, where = np.unique(np.concatenate([p.code for p in parts]), return_index=True, return_inverse=True)
        shift = np.cumsum([0, *(len(p.code) for p in parts)])
        out.place = np.concatenate([where[a + p.place] for a, p in zip(shift, parts)])
        many = np.cumsum([0, *(len(p.place) for p in parts)])
        out.bounds = np.concatenate([[0], *(a + p.bounds[1:] for a, p in zip(many, parts))])
        out.bucket = (out.code % U(WORD_BUCKETS)).astype(np.int64)
        out.count = np.concatenate([p.count for p in parts])[first]
        grams = np.cumsum([0, *(len(p.grams) for p in parts)])
        begin = np.concatenate([a + p.begin for a, p in zip(grams, parts)])[first]
        out.begin = np.cumsum(out.count) - out.count
        flat = np.concatenate([p.grams for p in parts])
        parts.clear()
        at = np.repeat((begin - out.begin).astype(np.int32), out.count) + np.arange(int(out.count.sum()), dtype=np.int32)
        out.grams = flat[at]
        return out

    def inputs(self, net: dict[str, np.ndarray]) -> np.ndarray:
        """The input of every distinct word."""
        if not len(self.bucket):
            return np.zeros((0, WIDTH), np.float32)
        out = np.empty((len(self.bucket), WIDTH), np.float32)
        for a in range(0, len(self.bucket), 20_000):
            b = min(a + 20_000, len(self.bucket))
            low, high = self.begin[a], self.begin[b - 1] + self.count[b - 1]
            out[a:b] = net["word"][self.bucket[a:b]] + np.add.reduceat(net["gram"][self.grams[low:high]], self.begin[a:b] - low) / self.count[a:b, None]
        return out


def windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and document of every window; the last of a
    document ends with it, a document without words has one empty window."""
    n = np.diff(bounds)
    many = np.where(n > WINDOW, -(-(n - WINDOW) // STRIDE) + 1, 1)
    doc = np.repeat(np.arange(len(n)), many)
    turn = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    first = np.minimum(turn * STRIDE, np.maximum(n[doc] - WINDOW, 0))
    return bounds[:-1][doc] + first, np.minimum(n[doc], WINDOW), doc


# -- network ------------------------------------------------------------------
def new_network(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.RandomState(seed)
    draw = lambda *shape, scale: (rng.randn(*shape) * scale).astype(np.float32)
    net = {"word": draw(WORD_BUCKETS, WIDTH, scale=0.05), "gram": draw(GRAM_BUCKETS, WIDTH, scale=0.05),
           "attend": draw(2 * HIDDEN, scale=0.3), "out": draw(2 * HIDDEN, scale=0.3), "bias": np.zeros(1, np.float32)}
    for d in "fb":
        net |= {f"W{d}": draw(WIDTH, 3 * HIDDEN, scale=0.4), f"U{d}": draw(HIDDEN, 3 * HIDDEN, scale=0.3),
                f"b{d}": np.zeros(3 * HIDDEN, np.float32), f"c{d}": np.zeros(HIDDEN, np.float32)}
    return net


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _gru(p: np.ndarray, u: np.ndarray, c: np.ndarray, keep: list | None) -> np.ndarray:
    """States (steps, rows, units) for projected inputs p (steps, rows, 3·units)."""
    steps, rows, n = p.shape[0], p.shape[1], u.shape[0]
    h, out = np.zeros((rows, n), np.float32), np.empty((steps, rows, n), np.float32)
    for t in range(steps):
        g = h @ u
        zr = _sigmoid(p[t, :, :2 * n] + g[:, :2 * n])
        z, r, inner = zr[:, :n], zr[:, n:], g[:, 2 * n:] + c
        new = np.tanh(p[t, :, 2 * n:] + r * inner)
        if keep is not None:
            keep.append((h, z, r, inner, new))
        h = out[t] = new + z * (h - new)
    return out


def _gru_back(dout: np.ndarray, u: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of p, u and c."""
    steps, rows, n = dout.shape
    dp, du, dc, carry = np.empty((steps, rows, 3 * n), np.float32), np.zeros_like(u), np.zeros(n, np.float32), np.zeros((rows, n), np.float32)
    for t in reversed(range(steps)):
        h, z, r, inner, new = kept[t]
        dh = dout[t] + carry
        dnew = dh * (1 - z) * (1 - new * new)
        dz, dr = dh * (h - new) * z * (1 - z), dnew * inner * r * (1 - r)
        dp[t] = np.concatenate([dz, dr, dnew], 1)
        dg = np.concatenate([dz, dr, dnew * r], 1)
        du += h.T @ dg
        dc += (dnew * r).sum(0)
        carry = dh * z + dg @ u.T
    return dp, du, dc


def _sums_by(place: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of ``values`` by place, 0 to n - 1."""
    out = np.zeros((n, values.shape[1]), np.float32)
    if len(place):
        order = np.argsort(place, kind="stable")
        there, begin = np.unique(place[order], return_index=True)
        out[there] = np.add.reduceat(values[order], begin)
    return out


def _forward(net: dict, projected: dict[str, np.ndarray], at: np.ndarray, there: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Logits of windows.  ``projected`` holds each word's projected input by
    direction, its last row that of no word; ``at`` (steps, windows) are words,
    ``there`` says which exist."""
    states = []
    for d in "fb":
        p = projected[d][at if d == "f" else at[::-1]]
        kept = keep.setdefault(d, []) if keep is not None else None
        h = _gru(p, net[f"U{d}"], net[f"c{d}"], kept)
        states.append(h if d == "f" else h[::-1])
    h = np.concatenate(states, 2)
    e = np.where(there, h @ net["attend"], -1e9)
    a = np.exp(e - e.max(0))
    a /= a.sum(0)
    pooled = (a[:, :, None] * h).sum(0)
    if keep is not None:
        keep |= {"h": h, "a": a, "pooled": pooled}
    return pooled @ net["out"] + net["bias"][0]


def _project(net: dict, x: np.ndarray) -> dict[str, np.ndarray]:
    x = np.concatenate([x, np.zeros((1, WIDTH), np.float32)])
    return {d: x @ net[f"W{d}"] + net[f"b{d}"] for d in "fb"}


def _window_words(place: np.ndarray, none: int, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    step = np.arange(WINDOW)[:, None]
    there = step < size
    if not len(place):
        return np.full(there.shape, none), there
    return np.where(there, place[np.minimum(first + step, len(place) - 1)], none), there


def window_logits(net: dict, own: Words, first: np.ndarray, size: np.ndarray, most: int = 1024, block: int = 8192) -> np.ndarray:
    """Logits of windows in the order of their first words; only the words of
    ``block`` windows are projected at a time."""
    x = own.inputs(net)
    out = [np.zeros(0, np.float32)]
    for i in range(0, len(first), block):
        begin, many = first[i:i + block], size[i:i + block]
        low = int(begin[0])
        used, place = np.unique(own.place[low:int((begin + many).max())], return_inverse=True)
        projected = _project(net, x[used])
        for a in range(0, len(begin), most):
            out.append(_forward(net, projected, *_window_words(place, len(used), begin[a:a + most] - low, many[a:a + most])))
    return np.concatenate(out)


def gradients(net: dict, own: Words, first: np.ndarray, size: np.ndarray, label: np.ndarray) -> tuple[float, dict]:
    """Mean cross-entropy of some windows and its gradients; those of the
    embeddings are (rows, gradient) pairs."""
    at, there = _window_words(own.place, len(own.bucket), first, size)
    used, local = np.unique(at, return_inverse=True)
    local = local.reshape(at.shape)
    used = used[used < len(own.bucket)]
    slots = [np.arange(own.begin[w], own.begin[w] + own.count[w]) for w in used.tolist()]
    counts = own.count[used]
    flat = own.grams[np.concatenate(slots)] if slots else np.zeros(0, np.int64)
    x = net["word"][own.bucket[used]].astype(np.float32)
    if len(used):
        x = x + np.add.reduceat(net["gram"][flat], np.cumsum(counts) - counts) / counts[:, None]
    projected, keep = _project(net, x), {}
    logit = _forward(net, projected, local, there, keep)
    p = _sigmoid(logit)
    loss = float(-np.mean(label * np.log(p + 1e-7) + (1 - label) * np.log(1 - p + 1e-7)))
    d = ((p - label) / len(label)).astype(np.float32)
    g = {"bias": d.sum(keepdims=True), "out": keep["pooled"].T @ d}
    dpooled = d[:, None] * net["out"]
    h, a = keep["h"], keep["a"]
    da = (h * dpooled).sum(2)
    de = a * (da - (a * da).sum(0)) * there
    g["attend"] = np.tensordot(de, h, ([0, 1], [0, 1]))
    dh = a[:, :, None] * dpooled + de[:, :, None] * net["attend"]
    dx = np.zeros((len(used) + 1, WIDTH), np.float32)
    with_none = np.concatenate([x, np.zeros((1, WIDTH), np.float32)])
    for k, way in enumerate("fb"):
        part = np.ascontiguousarray(dh[:, :, k * HIDDEN:(k + 1) * HIDDEN][:: 1 if way == "f" else -1])
        dp, g[f"U{way}"], g[f"c{way}"] = _gru_back(part, net[f"U{way}"], keep[way])
        dp = dp[:: 1 if way == "f" else -1].reshape(-1, 3 * HIDDEN)
        per_word = _sums_by(local.reshape(-1), dp, len(used) + 1)
        g[f"b{way}"], g[f"W{way}"] = per_word.sum(0), with_none.T @ per_word
        dx += per_word @ net[f"W{way}"].T
    dx = dx[:-1]
    g["word"] = (own.bucket[used], dx)
    g["gram"] = (flat, np.repeat(dx / np.maximum(counts, 1)[:, None], counts, 0))
    return loss, g


class _Adam:
    def __init__(self, net: dict, rate: float) -> None:
        self.net, self.rate, self.turn = net, rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in net.items()} for _ in range(2))

    def step(self, grads: dict) -> None:
        self.turn += 1
        fix = self.rate * np.sqrt(1 - 0.999 ** self.turn) / (1 - 0.9 ** self.turn)
        for k, g in grads.items():
            if isinstance(g, tuple):  # only the rows that occur are moved
                rows, which = np.unique(g[0], return_inverse=True)
                g = _sums_by(which, g[1], len(rows))
            else:
                rows = slice(None)
            self.m[k][rows] = m = 0.9 * self.m[k][rows] + 0.1 * g
            self.v[k][rows] = v = 0.999 * self.v[k][rows] + 0.001 * g * g
            self.net[k][rows] -= fix * m / (np.sqrt(v) + 1e-7)


def train(texts: list[str], labels: list[int], seed: int = 7, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """A network for whole labelled texts."""
    net, rng = new_network(seed), np.random.RandomState(seed)
    label = np.array(labels, np.float32)
    if not texts:
        return net
    buf, offsets = utf8(pa.array(texts, pa.large_string()))
    own = Words.of_texts(buf, offsets)
    first, size, doc = windows(own.bounds)
    begin, many = np.searchsorted(doc, np.arange(len(texts))), np.bincount(doc, minlength=len(texts))
    adam = _Adam(net, RATE)
    drawn = lambda: begin + (rng.random_sample(len(texts)) * many).astype(np.int64)
    for epoch in range(epochs):
        if epoch:  # the highest of all windows
            top = np.lexsort((-window_logits(net, own, first, size), doc))[begin]
            chosen = np.concatenate([top, drawn()[label == 0]])
        else:
            chosen = np.concatenate([drawn(), drawn()])
        rng.shuffle(chosen)
        adam.rate = RATE * (1 - epoch / epochs * 0.7)
        for a in range(0, len(chosen), BATCH):
            w = chosen[a:a + BATCH]
            _, grads = gradients(net, own, first[w], size[w], label[doc[w]])
            adam.step(grads)
    if len(set(labels)) == 2:  # the cut-off goes midway between the classes' highest windows, where they are apart
        top = np.maximum.reduceat(window_logits(net, own, first, size), begin)
        clean, toxic = np.quantile(top[label == 0], 0.9995), np.quantile(top[label == 1], 0.01)
        if toxic > clean:
            net["bias"] = net["bias"] + np.float32(np.log(CUTOFF / (1 - CUTOFF)) - (clean + toxic) / 2)
    return net


def score_block(net: dict, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Score of every text of a block: its highest window's."""
    own = Words(buf, offsets)
    first, size, doc = windows(own.bounds)
    logit = window_logits(net, own, first, size)
    best = np.maximum.reduceat(logit, np.searchsorted(doc, np.arange(len(offsets) - 1))) if len(doc) else logit
    return 1 / (1 + np.exp(-np.clip(best.astype(np.float64), -40, 40)))


# -- on a table ---------------------------------------------------------------
def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (null: null)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """``doc_id, text, toxic`` of at most ``per_class`` labelled texts of each
    class, those with the smallest hash of their id: bounded, so their ids may
    be broadcast."""
    rows = (labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
            .withColumn("h", F.xxhash64("doc_id", F.lit(8))))
    chosen = [rows.where(F.col("toxic") == c).orderBy("h", "doc_id").limit(per_class) for c in (0, 1)]
    return docs.join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").select("doc_id", "text", "toxic")


def trained(sample: DataFrame) -> dict[str, np.ndarray]:
    """The network of a sample.  One task has all its rows, which are bounded;
    the driver only gets the network."""
    schema = pa.schema([("net", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted(row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "toxic"))))
        net = train([text for _, text, _ in found], [toxic for _, _, toxic in found])
        found.clear()
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)], pa.binary())], schema=schema)

    nets = sample.repartition(1).mapInArrow(run, "net binary").collect()
    return pickle.loads(nets[0].net) if nets else train([], [])


def score_toxicity(docs: DataFrame, net: dict[str, np.ndarray]) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every row.  A null text counts as
    empty; empty texts are scored like a window without words.  Ids may be
    null or repeated; other columns are ignored."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(net)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, offsets = utf8(b.column("text"))
            for i, j in blocks(offsets, 1 << 19):
                yield pa.RecordBatch.from_arrays([b.column("doc_id")[i:j], pa.array(score_block(shared.value, buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))], schema=schema)

    return rows.mapInArrow(run, "doc_id long, score double")


def reject_toxic(docs: DataFrame, net: dict[str, np.ndarray], cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``cutoff``, with all their
    columns: one pass without a shuffle.  Null and empty texts are scored like
    a window without words."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, offsets = utf8(b.column(place))
            for i, j in blocks(offsets, 1 << 19):
                clean = score_block(shared.value, buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) < cutoff
                yield b.slice(i, j - i).filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)


def fitted_network(docs: DataFrame, labels: DataFrame, folds: int | None = 3) -> dict[str, np.ndarray]:
    """Trains on labelled documents; with ``folds``, not on those whose fold is 1."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if folds:
        labels = labels.where(fold(F.col("doc_id"), folds) != 1)
    return trained(training_sample(docs, labels))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``; learns
    from labelled rows whose crc32 of the id, modulo 3, is not 1.  Labels that
    are null or not 0/1, of missing documents, or without an id don't count.
    Without labels the untrained network's scores are returned.  An empty
    table gives no rows."""
    out = score_toxicity(docs, fitted_network(docs, labels))
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"))

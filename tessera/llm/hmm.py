"""Hidden Markov language model.

The latent chain emits a word's class (a hash of its first and last bytes),
and the class emits the word by its corpus count, so that
P(text) = P(classes) · Π P(word | class) is a proper model of whole texts,
unseen words included.  Baum-Welch counts are summed over all partitions;
what the driver holds is a row per class.  The likelihood of a whole text is
the scaled forward recursion, done for runs of tokens at a time as products
of transfer matrices.

Word counts grow with the corpus and stay in a table.  A bounded number of
the most frequent words is broadcast; the tokens of all other words are
joined with the table, so every count is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.textnum import U, blocks, lower, mix, span_hash, utf8, words
from tessera.llm.toxicity import fold

#: Latent states, classes (the last is the end of a text), rounds of Baum-Welch, tokens of a run.
STATES, CLASSES, ROUNDS, RUN = 6, 1 << 13, 5, 128
#: Most words whose counts are broadcast (16 bytes each).
FREQUENT = 1 << 20
#: Code of the end of a text.
END = np.uint64(0x656E642D6F662D74)
_AFFIX = mix(np.arange(21, 27, dtype=U)) | U(1)


# -- tokens -------------------------------------------------------------------
def tokens(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code and class of every token of a block, and each text's offsets;
    every text ends with the end token."""
    low = lower(buf)
    starts, ends, bounds = words(low, offsets)
    code = span_hash(low, starts, ends)
    length = ends - starts
    shape = np.minimum(length, 6).astype(U)
    for j in range(3):
        shape += np.where(length > j, low[np.minimum(starts + j, max(len(low) - 1, 0))], 0).astype(U) * _AFFIX[j] if len(starts) else U(0)
    for j in range(2):
        shape += np.where(length > j, low[np.maximum(ends - 1 - j, 0)], 0).astype(U) * _AFFIX[3 + j] if len(starts) else U(0)
    kind = (mix(shape) % U(CLASSES - 1)).astype(np.int32)
    n = np.diff(bounds)
    at = np.arange(len(code)) + np.repeat(np.arange(len(n)), n)
    all_code, all_kind = np.full(len(code) + len(n), END), np.full(len(code) + len(n), CLASSES - 1, np.int32)
    all_code[at], all_kind[at] = code, kind
    return all_code, all_kind, bounds + np.arange(len(bounds))


# -- chain --------------------------------------------------------------------
class Chain:
    """``q``: the state before the first token; ``a``: transitions; ``b``:
    emissions (states, classes)."""

    def __init__(self, q: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        self.q, self.a, self.b, self.bt = q, a, b, np.ascontiguousarray(b.T)

    @staticmethod
    def first(share: np.ndarray, states: int, seed: int) -> "Chain":
        """Sticky transitions, and class shares disturbed at random by state."""
        rng = np.random.RandomState(seed)
        b = share * np.exp(rng.randn(states, len(share)))
        a = np.full((states, states), 0.1 / max(states - 1, 1))
        np.fill_diagonal(a, 0.9 if states > 1 else 1.0)
        return Chain(np.full(states, 1 / states), a, b / b.sum(1, keepdims=True))


def runs(bounds: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First token, length, text and turn of every run, the longest first."""
    n = np.diff(bounds)
    many = -(-n // run)
    text = np.repeat(np.arange(len(n)), many)
    turn = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    first, size = bounds[:-1][text] + turn * run, np.minimum(n[text] - turn * run, run)
    order = np.argsort(-size, kind="stable")
    return first[order], size[order], text[order], turn[order]


def log_likelihood(chain: Chain, kind: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Natural log probability of each text's classes."""
    k = len(chain.q)
    first, size, text, turn = runs(bounds)
    m = np.tile(np.eye(k), (len(first), 1, 1))
    scale = np.zeros(len(first))
    for t in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -t, "left"))  # runs longer than t
        step = (m[:n].reshape(-1, k) @ chain.a).reshape(n, k, k) * chain.bt[kind[first[:n] + t]][:, None, :]
        total = step.sum((1, 2))
        m[:n] = step / total[:, None, None]
        scale[:n] += np.log(total)
    out, state = np.zeros(len(bounds) - 1), np.tile(chain.q, (len(bounds) - 1, 1))
    order = np.lexsort((text, turn))
    for part in np.split(order, np.flatnonzero(np.diff(turn[order])) + 1) if len(order) else ():
        rows = text[part]
        now = np.einsum("ik,ikl->il", state[rows], m[part])
        total = now.sum(1)
        state[rows] = now / total[:, None]
        out[rows] += np.log(total) + scale[part]
    return out


def expected_counts(chain: Chain, kind: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, transitions and emissions (one Baum-Welch pass).
    Training sequences are runs of at most RUN tokens."""
    k = len(chain.q)
    first, size, _, _ = runs(bounds)
    q, a, b = np.zeros(k), np.zeros((k, k)), np.zeros((k, len(chain.bt)))
    if not len(first):
        return q, a, b
    steps = int(size[0])
    active = [int(np.searchsorted(-size, -t, "left")) for t in range(steps)]
    alpha, emit, scale = [], [], []
    now = np.tile(chain.q, (len(first), 1))
    for t in range(steps):
        n = active[t]
        e = chain.bt[kind[first[:n] + t]]
        now = (now[:n] @ chain.a) * e
        total = now.sum(1, keepdims=True)
        now = now / total
        alpha.append(now)
        emit.append(e)
        scale.append(total)
    seen, weight = [], []
    beta = np.ones((len(first), k))
    for t in reversed(range(steps)):
        n = active[t]
        gamma = alpha[t] * beta[:n]
        gamma /= gamma.sum(1, keepdims=True)
        seen.append(kind[first[:n] + t])
        weight.append(gamma)
        back = emit[t] * beta[:n] / scale[t]
        before = alpha[t - 1][:n] if t else np.tile(chain.q, (n, 1))
        a += chain.a * (before.T @ back)
        beta[:n] = back @ chain.a.T
        if not t:
            start = chain.q * beta[:n]
            q += (start / start.sum(1, keepdims=True)).sum(0)
    seen, weight = np.concatenate(seen), np.concatenate(weight)
    for s in range(k):
        b[s] = np.bincount(seen, weight[:, s], b.shape[1])
    return q, a, b


def reestimated(share: np.ndarray, q: np.ndarray, a: np.ndarray, b: np.ndarray) -> Chain:
    """A chain from expected counts, smoothed by the class shares."""
    q, a, b = q + 0.1, a + 0.1, b + 20 * share
    return Chain(q / q.sum(), a / a.sum(1, keepdims=True), b / b.sum(1, keepdims=True))


# -- on a table ---------------------------------------------------------------
def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    buf, offsets = utf8(batch.column("text"))
    for i, j in blocks(offsets):
        yield i, j, *tokens(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])


def word_counts(docs: DataFrame, most: int = 1 << 21) -> DataFrame:
    """``code, kind, c``: how often every token occurs.  A task adds up its
    own rows before they are shuffled, in arrays of at most about ``most`` words."""
    schema = pa.schema([("code", pa.int64()), ("kind", pa.int32()), ("c", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, kind, count = np.zeros(0, U), np.zeros(0, np.int32), np.zeros(0, np.int64)
        out = lambda: pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(kind), pa.array(count)], schema=schema)
        for batch in batches:
            for _, _, more, kinds, _ in _blocks(batch):
                new, first, times = np.unique(more, return_index=True, return_counts=True)
                both = np.concatenate([code, new])
                code, at, where = np.unique(both, return_index=True, return_inverse=True)
                count = np.bincount(where, np.concatenate([count, times])).astype(np.int64)
                kind = np.concatenate([kind, kinds[first]])[at]
                if len(code) > most:
                    yield out()
                    code, kind, count = code[:0], kind[:0], count[:0]
        yield out()

    return docs.mapInArrow(run, "code long, kind int, c long").groupBy("code").agg(F.min("kind").alias("kind"), F.sum("c").alias("c"))


def train_chain(docs: DataFrame, share: np.ndarray, states: int = STATES, rounds: int = ROUNDS, seed: int = 3) -> Chain:
    """Baum-Welch over all rows; each round is one scan whose tasks add up
    their expected counts, then a grouped sum with a row per class."""
    chain = Chain.first(share, states, seed)
    names = [f"e{s}" for s in range(states)]
    schema = pa.schema([("row", pa.int32()), *((n, pa.float64()) for n in names)])
    for _ in range(rounds):
        shared = docs.sparkSession.sparkContext.broadcast((chain.q, chain.a, chain.b))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = Chain(*shared.value)
            sums = [np.zeros_like(x) for x in shared.value]
            for batch in batches:
                for _, _, _, kind, bounds in _blocks(batch):
                    for total, more in zip(sums, expected_counts(own, kind, bounds)):
                        total += more
            table = np.concatenate([sums[2].T, sums[1], sums[0][None]])  # classes, then transitions, then starts
            seen = np.flatnonzero(table.sum(1))
            yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), *(pa.array(table[seen, s]) for s in range(states))], schema=schema)

        table = np.zeros((CLASSES + states + 1, states))
        for r in docs.mapInArrow(run, "row int, " + ", ".join(f"{n} double" for n in names)).groupBy("row").agg(*(F.sum(n).alias(n) for n in names)).collect():
            table[r[0]] = r[1:]
        chain = reestimated(share, table[-1], table[CLASSES:-1], table[:CLASSES].T)
    return chain


def _frequent(vocabulary: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes (sorted) and counts of the words above the least count at which
    no more than ``most`` words remain."""
    step = F.floor(F.log2("c") * 16)
    left, least = 0, None
    for r in sorted(vocabulary.groupBy(step.alias("step")).count().collect(), reverse=True):
        left += r["count"]
        if left > most:
            break
        least = r["step"]
    found = vocabulary.where(step >= F.lit(least)) if least is not None else vocabulary.limit(0)
    table = found.select("code", "c").toArrow()
    code, c = table.column("code").to_numpy().view(U), table.column("c").to_numpy()
    order = np.argsort(code)
    return code[order], c[order]


def hmm_scores(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS, frequent: int = FREQUENT) -> DataFrame:
    """Score every whole text; learn from those whose crc32 of the id, modulo
    5, is not 1.

    One row per input row: ``doc_id, held_out, n_tokens`` (words and one end),
    ``n_known`` (tokens that occur in training), ``train_tokens``,
    ``base_score`` (smoothed unigrams) and ``score`` (this model), both log10
    of the text's probability.  A null text counts as empty: the end only.  A
    null id is never held out.  Rows that repeat an id and text are one row of
    the result for each.  Without training rows every token is unknown and
    equally likely.  Other columns are ignored; an empty table gives no rows.
    """
    held = F.coalesce(fold(F.col("doc_id"), 5) == 1, F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("held_out", held)
    train = docs.where("not held_out").select("text")
    vocabulary = written(word_counts(train))
    counts, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in vocabulary.groupBy("kind").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        counts[r.kind], kinds[r.kind] = r.n, r.v
    total, distinct = int(counts.sum()), int(kinds.sum())
    share = (counts + 0.5) / (counts + 0.5).sum()
    chain = train_chain(train, share, states, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(((chain.q, chain.a, chain.b), np.log10(counts + 0.5 * (kinds + 1)), _frequent(vocabulary, frequent)))
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.string()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("seen", pa.float64()), ("model", pa.float64()), ("code", pa.int64()), ("times", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        parameters, within, (frequent_code, frequent_c) = shared.value
        own, split, serial = Chain(*parameters), TaskContext.get().partitionId(), 0
        for batch in batches:
            held = batch.column("held_out").to_numpy(zero_copy_only=False)
            for i, j, code, kind, bounds in _blocks(batch):
                n = j - i
                names = np.array([f"{split}:{serial + k}" for k in range(n)], object)
                serial += n
                text = np.repeat(np.arange(n), np.diff(bounds))
                distinct, where = np.unique(code, return_inverse=True)
                at = np.minimum(np.searchsorted(frequent_code, distinct), max(len(frequent_code) - 1, 0))
                hit = frequent_code[at] == distinct if len(frequent_code) else np.zeros(len(distinct), bool)
                log_c = np.where(hit, np.log10(np.where(hit, frequent_c[at], 0) + 0.5), 0.0) if len(frequent_code) else np.zeros(len(distinct))
                known = np.bincount(text, hit[where], n).astype(np.int64)
                seen = np.bincount(text, log_c[where], n)
                model = log_likelihood(own, kind, bounds) / np.log(10) - np.bincount(text, within[kind], n)
                rare = np.flatnonzero(~hit[where])
                pair, times = np.unique(np.stack([text[rare], where[rare]]), axis=1, return_counts=True) if len(rare) else (np.zeros((2, 0), np.int64), np.zeros(0, np.int64))
                ids = batch.column("doc_id")[i:j]
                none = lambda kind: pa.nulls(pair.shape[1], kind)
                yield pa.RecordBatch.from_arrays([ids, pa.array(names, pa.string()), pa.array(held[i:j]), pa.array(np.diff(bounds)), pa.array(known), pa.array(seen), pa.array(model), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], schema=schema)
                yield pa.RecordBatch.from_arrays([none(pa.int64()), pa.array(names[pair[0]], pa.string()), none(pa.bool_()), none(pa.int64()), none(pa.int64()), none(pa.float64()), none(pa.float64()), pa.array(distinct[pair[1]].view(np.int64)), pa.array(times)], schema=schema)

    parts = written(docs.mapInArrow(run, "doc_id long, row string, held_out boolean, n_tokens long, known long, seen double, model double, code long, times long"))
    # the tokens of all other words get their counts by a join
    rare = parts.where("code is not null").select("row", "code", "times").join(vocabulary.select("code", "c"), "code", "left")
    rare = rare.groupBy("row").agg(F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("known_rare"),
                                   F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("seen_rare"))
    whole = parts.where("code is null").join(rare, "row", "left")
    seen = F.col("seen") + F.coalesce("seen_rare", F.lit(0.0))
    return whole.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("known_rare", F.lit(0))).cast("long").alias("n_known"),
                        F.lit(total).cast("long").alias("train_tokens"),
                        (seen - F.col("n_tokens") * F.lit(float(np.log10(total + 0.5 * (distinct + 1))))).alias("base_score"),
                        (seen + F.col("model")).alias("score"))

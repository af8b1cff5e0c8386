"""Quality rules: counted base rules, then a log-likelihood ratio.

The n-grams (words and word pairs) of every text are hashed to buckets.  Two
multinomials over the buckets are counted, one over all documents and one
over the trusted ones; a document's score is the mean over its n-grams of
log(p_trusted / p_raw), and a fixed threshold decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.textnum import U, blocks, lower, mix, span_hash, utf8, window_hash, words

#: Buckets of the multinomials (what is broadcast: 8 bytes each), pseudo-count of a bucket, least mean log ratio of a kept document.
BUCKETS, SMOOTHING, LEAST_SCORE = 1 << 16, 0.5, -0.1

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])


def _owner(bounds: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def base_counts(buf: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counted features of a block of texts."""
    starts, ends, bounds = words(buf, offsets)
    n = len(offsets) - 1
    inside = np.zeros(len(buf) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1  # a word's end is never another's start: a space or a text's end lies between
    in_word = np.cumsum(inside[:-1]) > 0
    # words of adjacent texts may touch: both marks fall on one byte and cancel, and the byte is inside either way
    out = {"n_words": np.diff(bounds), "word_chars": _per_row(in_word & (buf & 0xC0 != 0x80), offsets), "n_symbols": _per_row(_SYMBOL[buf], offsets)}

    breaks = np.flatnonzero(buf == 10)
    first = np.concatenate([offsets[:-1], breaks + 1])
    last = np.concatenate([offsets[1:], breaks])
    first, last = np.sort(first, kind="stable"), np.sort(last, kind="stable")
    with_word = np.searchsorted(starts, last) > np.searchsorted(starts, first)
    first, last = first[with_word], last[with_word]
    row = np.searchsorted(offsets, first, "right") - 1
    key = mix(span_hash(buf, first, last) + row.astype(U) * U(0x9E3779B97F4A7C15))
    _, once = np.unique(key, return_index=True)
    out["n_dup_lines"] = np.bincount(row, minlength=n) - np.bincount(row[once], minlength=n)

    runs, run_bounds = window_hash(span_hash(buf, starts, ends), bounds, 3)
    owner = _owner(run_bounds)
    key = mix(runs + owner.astype(U) * U(0x9E3779B97F4A7C15))
    _, which, times = np.unique(key, return_inverse=True, return_counts=True)
    again = np.flatnonzero(times[which] > 1)
    at = bounds[owner[again]] + again - run_bounds[owner[again]]
    edge = np.zeros(len(starts) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, np.minimum(at + 3, len(starts)), -1)
    covered = np.cumsum(edge[:-1]) > 0
    out["n_repeat_words"] = _per_row(covered, bounds)
    return out


def _buckets(buf: np.ndarray, offsets: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word and word pair, and the row that it is in."""
    low = lower(buf)
    starts, ends, bounds = words(low, offsets)
    one = span_hash(low, starts, ends)
    row = _owner(bounds)
    pair = np.flatnonzero(row[1:] == row[:-1]) if len(row) else np.zeros(0, np.int64)
    two = mix(one[pair] * U(0x9E3779B97F4A7C15) + one[pair + 1]) if len(pair) else np.zeros(0, U)
    return (np.concatenate([one, two]) % U(n_buckets)).astype(np.int64), np.concatenate([row, row[pair]])


def bucket_counts(docs: DataFrame, trusted: DataFrame, n_buckets: int = BUCKETS) -> DataFrame:
    """``bucket, raw, trusted``: n-grams per bucket in all documents, and in
    those whose doc_id is in ``trusted``.  Every task counts its own rows into
    arrays; what is shuffled is a row for each of its buckets."""
    schema = pa.schema([("bucket", pa.int64()), ("raw", pa.int64()), ("trusted", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, n_buckets), np.int64)
        for b in batches:
            buf, offsets = utf8(b.column("text"))
            good = b.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
            for i, j in blocks(offsets):
                at, row = _buckets(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], n_buckets)
                counts[0] += np.bincount(at, minlength=n_buckets)
                counts[1] += np.bincount(at[good[i:j][row]], minlength=n_buckets)
        seen = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[0][seen]), pa.array(counts[1][seen])], schema=schema)

    good = trusted.select("doc_id").where("doc_id is not null").distinct().withColumn("trusted", F.lit(True))
    # a shuffle join at every size: the labels grow with the documents
    rows = docs.select("doc_id", "text").join(good.hint("merge"), "doc_id", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    return rows.mapInArrow(run, "bucket long, raw long, trusted long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))


def log_ratios(counts: DataFrame, n_buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> np.ndarray:
    """log(p_trusted / p_raw) per bucket; one number per bucket reaches the driver."""
    table = np.zeros((2, n_buckets))
    for r in counts.collect():
        table[:, r.bucket] = r.raw, r.trusted
    p = (table + smoothing) / (table.sum(1, keepdims=True) + smoothing * n_buckets)
    return np.log(p[1] / p[0])


_FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_rules(docs: DataFrame, trusted: DataFrame, least_score: float = LEAST_SCORE, n_buckets: int = BUCKETS) -> DataFrame:
    """One row per input row: ``doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, score``.

    ``base_failed``: under 50 words, or over half of the words in repeated
    3-word windows.  ``score`` is the mean log ratio (0 for a text without
    words, null never), ``kept`` is ``not base_failed and score >=
    least_score``.  A null text has no words.  Labels of ids that the table
    lacks, repeated labels and null ids in ``trusted`` don't count; rows that
    repeat an id are all counted.  Without any trusted document all ratios
    are those of the smoothed empty multinomial.  An empty table gives no
    rows; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(bucket_counts(docs, trusted, n_buckets), n_buckets))
    schema = pa.schema([("doc_id", pa.int64()), *((f, pa.int64()) for f in _FEATURES), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, offsets = utf8(b.column("text"))
            for i, j in blocks(offsets):
                part, local = buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                counts = base_counts(part, local)
                at, row = _buckets(part, local, n_buckets)
                grams = np.bincount(row, minlength=j - i)
                score = np.bincount(row, ratios.value[at], j - i) / np.maximum(grams, 1)
                yield pa.RecordBatch.from_arrays([b.column("doc_id")[i:j], *(pa.array(counts[f].astype(np.int64)) for f in _FEATURES), pa.array(score)], schema=schema)

    scored = docs.mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.select("doc_id", *_FEATURES, failed.alias("base_failed"), (~failed & (F.col("score") >= F.lit(least_score))).alias("kept"), "score")

"""Benchmark decontamination by Wu-Manber search.

Texts and items are brought to one form: their words in lower case with one
space before, between and after them, so that a window of words occurs in a
text exactly where its bytes do.  The windows are the patterns, in classes by
length; ``m`` is the least length of a class.  A table over hashed blocks of
bytes tells how far the search may move on: as far as the block lies from the
end of the first m bytes of any pattern, or past the block if no pattern holds
it there.  Many cursors, one per stretch of the text, move at once.  Where the
table says 0, the bucket of the block lists the lengths of the patterns that
end their first m bytes with it; the hash of that many bytes picks the
pattern, and a comparison of all its bytes confirms it.

Items are searched in shards of bounded size, one scan of the documents each,
so what a task holds does not grow with the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.textnum import U, blocks, lower, mix, span_hash, utf8

#: Words of a window, bytes of items searched in one scan, words of a piece of a long item.
WINDOW, SHARD_BYTES, PIECE = 10, 8 << 20, 4096
#: Least pattern length of each class and the bytes of its blocks; bits of a block's hash in the tables.
CLASSES, TABLE_BITS = ((24, 8), (8, 4), (3, 3)), 20
#: Bytes of text that one cursor looks through.
STRETCH = 512

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_SPACE = 0x20


# -- one form for texts and items -------------------------------------------------
def plain(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts as `` w1 w2 ... wn `` (a single space without words) one after
    the other, and their n+1 offsets.  Two spaces meet only between texts."""
    n = len(offsets) - 1
    framed = np.insert(lower(buf), np.concatenate([offsets[:-1], offsets[1:]]), _SPACE)
    inside = _WORD[framed]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    begin = offsets[:-1] + 2 * np.arange(n)
    keep[begin] = True
    places = np.concatenate([[0], np.cumsum(keep)])
    return np.where(inside, framed, _SPACE).astype(np.uint8)[keep], np.concatenate([places[begin], places[-1:]])


def _eight(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as one number."""
    return np.ndarray(len(buf), "<u8", np.concatenate([buf, np.zeros(8, np.uint8)]).tobytes(), strides=(1,))


def _masked(x: np.ndarray, size: int | np.ndarray) -> np.ndarray:
    """The first ``size`` (at most 8) of the eight bytes."""
    return x & (U(2**64 - 1) >> (U(8) * (U(8) - np.asarray(size).astype(U))))


def _same(text: np.ndarray, at: np.ndarray, other: np.ndarray, place: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether ``size`` bytes from ``at`` on equal those from ``place`` on;
    both are compared eight bytes at a time."""
    same = np.ones(len(at), bool)
    left = np.arange(len(at))
    for k in range(0, int(size.max(initial=0)), 8):
        left = left[(size[left] > k) & same[left]]
        part = np.minimum(size[left] - k, 8)
        same[left] = _masked(text[at[left] + k], part) == _masked(other[place[left] + k], part)
    return same


def pieces_of(benchmark: DataFrame, window: int = WINDOW, piece: int = PIECE) -> DataFrame:
    """``item_id, body``: items with words in the one form; long ones in
    pieces that overlap by a window less one word."""
    schema = pa.schema([("item_id", pa.string()), ("body", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, offsets = utf8(b.column("text"))
            for i, j in blocks(offsets):
                form, bounds = plain(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                spaces = np.flatnonzero(form == _SPACE)
                first = np.searchsorted(spaces, bounds)
                rows, bodies = [], []
                for k in range(j - i):
                    own = spaces[first[k]:first[k + 1]]
                    for low in range(0, max(len(own) - window, min(len(own) - 1, 1)), piece - window + 1):
                        rows.append(i + k)
                        bodies.append(form[own[low]:own[min(low + piece, len(own) - 1)] + 1].tobytes())
                yield pa.RecordBatch.from_arrays([b.column("item_id").take(pa.array(rows, pa.int64())), pa.array(bodies, pa.binary())], schema=schema)

    return benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, "item_id string, body binary")


# -- the tables of a shard ----------------------------------------------------------
class Patterns:
    """The distinct windows of some pieces of items, with their tables."""

    def __init__(self, items: list[str | None], bodies: pa.Array, window: int = WINDOW):
        form, bounds = utf8(bodies)
        spaces = np.flatnonzero(form == _SPACE)
        first = np.searchsorted(spaces, bounds)
        words = np.diff(first) - 1
        runs = np.where(words >= window, words - window + 1, np.minimum(words, 1))
        piece = np.repeat(np.arange(len(words)), runs)
        at = first[:-1][piece] + np.arange(len(piece)) - np.repeat(np.cumsum(runs) - runs, runs)
        count = np.minimum(words, window)[piece]
        low, high = spaces[at], spaces[at + count] + 1
        code, one, where = np.unique(span_hash(form, low, high), return_index=True, return_inverse=True)
        self.form, self.code = form, code
        self.place, self.size, self.words = low[one], (high - low)[one], count[one]
        # items of each pattern, as numbers into the sorted distinct ids; rows without an id have no item
        self.items = sorted({i for i in items if i is not None})
        number = {x: n for n, x in enumerate(self.items)}
        own = np.array([number.get(i, -1) for i in items], np.int64)[piece] if len(piece) else np.zeros(0, np.int64)
        pairs = np.unique(np.stack([where, own])[:, own >= 0], axis=1)
        self.item, self.item_bounds = pairs[1], np.searchsorted(pairs[0], np.arange(len(code) + 1))
        tops = [2**62, *(low for low, _ in CLASSES)]
        self.classes = [self._tables(np.flatnonzero((self.size >= low) & (self.size < high)), block) for (low, block), high in zip(CLASSES, tops)]

    def _tables(self, own: np.ndarray, block: int) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray] | None:
        """m, the block's bytes, the shift table, and the buckets: the lengths
        of the patterns whose first m bytes end with a block, by its hash."""
        if not len(own):
            return None
        m, eight = int(self.size[own].min()), _eight(self.form)
        shift = np.full(1 << TABLE_BITS, m - block + 1, np.int32)
        for o in range(m - block + 1):
            np.minimum.at(shift, _block_hash(eight[self.place[own] + o], block), m - block - o)
        entry = np.unique((_block_hash(eight[self.place[own] + m - block], block) << 32) | self.size[own])
        return m, block, shift, np.searchsorted(entry >> 32, np.arange((1 << TABLE_BITS) + 1)), entry & (2**32 - 1)

    def find(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in a text of the one form and the patterns that begin there."""
        eight, other, total = _eight(text), _eight(self.form), []
        for tables in self.classes:
            if tables is None or len(text) < tables[0]:
                continue
            m, block, shift, bucket, sizes = tables
            at = np.arange(0, len(text) - m + 1, STRETCH)
            end = np.minimum(at + STRETCH, len(text) - m + 1)
            places, hashes = [], []
            while len(at):
                code = _block_hash(eight[at + m - block], block)
                step = shift[code]
                stop = step == 0
                places.append(at[stop])
                hashes.append(code[stop])
                at = at + np.maximum(step, 1)
                on = at < end
                at, end = at[on], end[on]
            at, code = np.concatenate(places), np.concatenate(hashes)
            begin = text[at] == _SPACE
            at, code = at[begin], code[begin]
            many = bucket[code + 1] - bucket[code]
            size = sizes[np.repeat(bucket[code] - np.cumsum(many) + many, many) + np.arange(many.sum())]
            at = np.repeat(at, many)
            fits = at + size <= len(text)
            at, size = at[fits], size[fits]
            ends = text[at + size - 1] == _SPACE
            at, size = at[ends], size[ends]
            if not len(at):
                continue
            code = span_hash(text, at, at + size)
            which = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
            picked = (self.code[which] == code) & (self.size[which] == size)
            at, which = at[picked], which[picked]
            right = _same(eight, at, other, self.place[which], self.size[which])
            total.append((at[right], which[right]))
        return tuple(np.concatenate(x) for x in zip(*total)) if total else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _block_hash(eight: np.ndarray, block: int) -> np.ndarray:
    return (mix(_masked(eight, block)) >> U(64 - TABLE_BITS)).astype(np.int64)


# -- on a table -------------------------------------------------------------------
def _runs(covered: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of covered words of each document, as word numbers inside it, and
    how many runs a document has."""
    edge = np.zeros(len(covered) + 1, bool)
    edge[bounds] = True
    begin = covered & (np.concatenate([[True], ~covered[:-1]]) | edge[:-1])
    end = covered & (np.concatenate([~covered[1:], [True]]) | edge[1:])
    low, high = np.flatnonzero(begin), np.flatnonzero(end) + 1
    doc = np.searchsorted(bounds, low, "right") - 1
    return low - bounds[doc], high - bounds[doc], np.bincount(doc, minlength=len(bounds) - 1)


def _searched(docs: DataFrame, patterns: Patterns) -> DataFrame:
    """Every row with ``n_words``, the runs of hit words and the items found."""
    shared = docs.sparkSession.sparkContext.broadcast(patterns)
    keep = [c for c in docs.columns if c != "text"]
    kinds = {"doc_id": pa.int64(), "sha": pa.string()}
    run_type = pa.struct([("low", pa.int64()), ("high", pa.int64())])
    schema = pa.schema([*((c, kinds[c]) for c in keep), ("n_words", pa.int64()), ("runs", pa.list_(run_type)), ("items", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        names = pa.array(own.items, pa.string())
        lists = lambda counts, values: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)
        for b in batches:
            buf, offsets = utf8(b.column("text"))
            for i, j in blocks(offsets):
                n = j - i
                text, bounds = plain(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                starts = np.flatnonzero((text[:-1] == _SPACE) & (text[1:] != _SPACE)) + 1
                first = np.searchsorted(starts, bounds)
                at, which = own.find(text)
                word = np.searchsorted(starts, at)
                change = np.zeros(len(starts) + 1, np.int64)
                np.add.at(change, word, 1)
                np.add.at(change, word + own.words[which], -1)
                low, high, runs = _runs(np.cumsum(change)[:-1] > 0, first)
                seen = np.unique(np.stack([np.searchsorted(bounds, at, "right") - 1, which]), axis=1)
                many = own.item_bounds[seen[1] + 1] - own.item_bounds[seen[1]]
                item = own.item[np.repeat(own.item_bounds[seen[1]] - np.cumsum(many) + many, many) + np.arange(many.sum())]
                found = np.unique(np.stack([np.repeat(seen[0], many), item]), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c)[i:j] for c in keep), pa.array(np.diff(first)),
                     lists(runs, pa.StructArray.from_arrays([pa.array(low), pa.array(high)], fields=list(run_type))),
                     lists(np.bincount(found[0], minlength=n), names.take(pa.array(found[1])))], schema=schema)

    return docs.mapInArrow(run, ", ".join(f"{c} {'long' if c == 'doc_id' else 'string'}" for c in keep) + ", n_words long, runs array<struct<low:long,high:long>>, items array<string>")


def _covered(runs: Column) -> Column:
    """Words in the union of runs."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(F.array_sort(runs), start, lambda acc, r: F.struct(
        F.greatest(acc["end"], r["high"]).alias("end"),
        (acc["total"] + F.greatest(F.lit(0), r["high"] - F.greatest(acc["end"], r["low"]))).alias("total")), lambda acc: acc["total"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Find the benchmark's windows of ``window`` words (an item with fewer,
    but not none, is one window) in every whole text.  Words are runs of
    letters and digits of ASCII, A-Z lower-cased, and of all other characters
    beyond it.

    One row per input row: ``doc_id, n_words``; ``n_hit`` (words inside any
    occurrence); ``n_items`` (items with occurring windows); ``items`` (their
    ids as strings, sorted); ``items_sha256`` of those, comma-joined;
    ``contaminated`` (n_hit > 0).  A null text has no words; a null item has
    no windows; windows of an item without id hit words but count as no item;
    rows that repeat an item are one item.  Documents that share an id, or
    have none, each have their row.  Other columns are ignored; an empty
    benchmark hits nothing, an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    pieces = written(pieces_of(benchmark, window).distinct())
    total = pieces.agg(F.sum(F.length("body") + 24)).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    place = F.pmod(F.xxhash64("item_id", "body"), F.lit(shards))

    def patterns(shard: int) -> Patterns:
        table = pieces.where(place == shard).toArrow().combine_chunks()
        return Patterns(table.column("item_id").to_pylist(), pa.concat_arrays([*table.column("body").chunks, pa.array([], table.schema.field("body").type)]), window)

    if shards == 1:
        found = _searched(docs, patterns(0)).select("doc_id", "n_words", "runs", "items")
    else:  # rows with the same id and text have the same hits: they are told apart by both
        keyed = docs.withColumn("sha", F.sha2("text", 256))
        parts = [written(_searched(keyed, patterns(s)).where(F.lit(s == 0) | (F.size("runs") > 0))) for s in range(shards)]
        hits = reduce(DataFrame.union, (p.dropDuplicates(["doc_id", "sha"]) for p in parts[1:]))
        hits = hits.groupBy(F.col("doc_id").alias("hit_id"), F.col("sha").alias("hit_sha")).agg(
            F.flatten(F.collect_list("runs")).alias("more_runs"), F.flatten(F.collect_list("items")).alias("more_items"))
        joined = parts[0].join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("sha") == F.col("hit_sha")), "left")
        both = lambda a, b: F.when(F.col(b).isNull(), F.col(a)).otherwise(F.concat(a, b))
        found = joined.select("doc_id", "n_words", both("runs", "more_runs").alias("runs"), F.array_distinct(both("items", "more_items")).alias("items"))
    found = found.select("doc_id", "n_words", _covered(F.col("runs")).alias("n_hit"), F.array_sort("items").alias("items"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))

"""Alignment of two tokenizers over the same bytes, in Arrow tables.

A block of documents is two list columns of token ids.  Flattening them gives
one row per token with its document as parent index; the running sum of token
lengths, less the sum at which the document began, is the byte at which the
token ends.  A full outer hash join on (document, end) puts the ends of both
tokenizers on one line: a row is the stretch of bytes up to the next end of
either, so it lies in exactly one token of each, and rows and overlapping
pairs of tokens are the same thing.  Rows where both end close a group.

Pairs of ids are counted per task with a grouped table and added up by Spark.
In a second pass a document's pairs look their corpus-wide counts up: the most frequent
pairs, a bounded number, in memory, and all others by a join.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.hmm import _frequent
from tessera.llm.textnum import blocks, utf8

#: Pairs of ids whose counts every task holds; the others are joined.
FREQUENT = 1 << 20
#: Pairs a task adds up before it hands them on, and links looked up at once.
HELD, LINKS = 1 << 19, 1 << 18
#: Bytes of text encoded at once, and the longest run without a space (or of spaces) that the rank merger takes: its time grows with the square of a run.
TEXT, RUN = 1 << 18, 4096
#: A (document, end) key holds the end in its low bits; a text is under 2 GiB.
END_BITS = 32


#: Fixed value: how the byte-level files split text before their merges.
BYTE_LEVEL_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _longest_run(raw: bytes) -> int:
    """Bytes of the longest run of white space, or of anything else."""
    change = np.flatnonzero(np.diff(_SPACE[np.frombuffer(raw, np.uint8)], prepend=False, append=False))
    return max(int(np.diff(change, prepend=0, append=len(raw)).max(initial=0)), 0)


class Vocabularies:
    """Both tokenizers and the bytes of their tokens, from the files' contents.

    Where the merges of the byte-level file are in the order of the ids they
    make, as they are when it was trained in one go, merging the pair of the
    least id gives the same ids as its merge list, so the faster rank merger
    is used; texts with very long runs, and other files, go to the file's own
    tokenizer."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_buffer(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letter = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in printable)}
        byte = {c: b for b, c in letter.items()}
        size = self.a.get_vocab_size(with_added_tokens=True)
        names = [self.a.id_to_token(i) or "" for i in range(size)]
        a_bytes = [bytes(byte[c] for c in x) if all(c in byte for c in x) else x.encode() for x in names]
        self.a_bytes = pa.array(a_bytes, pa.binary())
        self.b_bytes = pa.array([bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                                 for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))], pa.binary())
        self.ranks = self._rank_merger(json.loads(byte_level), names, a_bytes)

    @staticmethod
    def _rank_merger(file: dict, names: list[str], a_bytes: list[bytes]):
        merges = [m.split(" ") if isinstance(m, str) else m for m in file["model"].get("merges", [])]
        added = {t["id"] for t in file.get("added_tokens", [])}
        splits = file.get("pre_tokenizer") or {}
        if (splits.get("type") != "ByteLevel" or splits.get("add_prefix_space") or not splits.get("use_regex", True) or file.get("normalizer")
                or any(len(x) != 1 for x in a_bytes[:256]) or [names[256 + k] for k in range(len(merges))] != ["".join(m) for m in merges] or added - {256 + len(merges)}):
            return None
        import tiktoken
        return tiktoken.Encoding("ids", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks={x: i for i, x in enumerate(a_bytes[:256 + len(merges)])}, special_tokens={})

    def _byte_level(self, texts: list[str], wanted: list[bytes]) -> pa.ListArray:
        ids = []
        for t, raw in zip(texts, wanted):
            fast = self.ranks is not None and _longest_run(raw) <= RUN
            ids.append(self.ranks.encode_to_numpy(t, disallowed_special=()) if fast else np.array(self.a.encode(t, add_special_tokens=False).ids, np.uint32))
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([np.zeros(0, np.uint32), *ids]).astype(np.int32)))

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids of both tokenizers for texts with their leading space."""
        wanted = [b" " + t.encode() for t in texts]
        a = self._byte_level([" " + t for t in texts], wanted)
        b = pa.array(self.b.encode(texts, num_threads=1), a.type)
        same = np.array([len(t) > 0 for t in texts], bool)
        for ids, table in ((a, self.a_bytes), (b, self.b_bytes)):
            bounds = ids.offsets.to_numpy()
            joined, places = utf8(table.take(ids.flatten()))
            joined, places = joined.tobytes(), places[bounds].tolist()
            same &= [joined[low:high] == w for low, high, w in zip(places, places[1:], wanted)]
        keep = pa.array(same)
        return tuple(pc.if_else(keep, x, pa.scalar([], a.type)) for x in (a, b))


# -- a block of documents -------------------------------------------------------
def token_ends(ids: pa.ListArray, length: pa.Array, name: str) -> pa.Table:
    """``key`` (document and byte end), number and id of every token."""
    flat, parent = pc.list_flatten(ids), pc.list_parent_indices(ids).cast(pa.int64())
    size = length.take(flat)
    running = pc.cumulative_sum(size)
    first = np.minimum(ids.offsets.to_numpy()[:-1] - ids.offsets.to_numpy()[0], max(len(flat) - 1, 0))
    before = pc.subtract(running, size).take(pa.array(first)) if len(flat) else pa.nulls(len(ids), pa.int64())
    end = pc.subtract(running, before.take(parent))
    key = pc.add(pc.shift_left(parent, pa.scalar(END_BITS, pa.int64())), end)
    return pa.table({"key": key, f"{name}_at": pa.array(np.arange(len(flat))), f"{name}_id": flat})


def links(a: pa.ListArray, b: pa.ListArray, a_length: pa.Array, b_length: pa.Array) -> pa.Table:
    """One row per pair of overlapping tokens, in order: ``doc, a_id, b_id``,
    and whether the token of either side ends there (``a_ends, b_ends``)."""
    t = token_ends(a, a_length, "a").join(token_ends(b, b_length, "b"), "key", join_type="full outer", use_threads=False).sort_by("key").combine_chunks()
    return pa.table({"doc": pc.shift_right(t["key"], pa.scalar(END_BITS, pa.int64())), "a_id": pc.fill_null_backward(t["a_id"]), "b_id": pc.fill_null_backward(t["b_id"]),
                     "a_ends": t["a_at"].is_valid(), "b_ends": t["b_at"].is_valid()})


def _written_ids(count: int, last: str) -> list[str]:
    return [f"{i}," for i in range(count)] + [f"{i}{last}" for i in range(count)]


def group_texts(a: pa.ListArray, b: pa.ListArray, table: pa.Table, pool: pa.Array, a_size: int) -> tuple[bytes, np.ndarray]:
    """The groups of all documents as one text, ``a1,a2|b1;`` for each group,
    and the documents' n+1 offsets into it.  ``pool`` holds every id written
    with either separator, those of A first."""
    a_ends, b_ends = (table[c].to_numpy().astype(bool) for c in ("a_ends", "b_ends"))
    both = a_ends & b_ends
    group = np.cumsum(both) - both
    groups = int(both.sum())
    sides = []
    for ids, ends, base, size in ((a, a_ends, 0, a_size), (b, b_ends, 2 * a_size, len(pool) // 2 - a_size)):
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        sides.append((base + flat + size * both[ends], group[ends]))
    n_a, n_b = (np.bincount(g, minlength=groups) for _, g in sides)
    order = np.empty(len(sides[0][0]) + len(sides[1][0]), np.int64)
    order[np.arange(len(sides[0][0])) + (np.cumsum(n_b) - n_b)[sides[0][1]]] = sides[0][0]
    order[np.arange(len(sides[1][0])) + np.cumsum(n_a)[sides[1][1]]] = sides[1][0]
    text, places = utf8(pool.take(pa.array(order)))
    bounds = np.concatenate([[0], np.cumsum([*(pc.list_value_length(a).to_numpy() + pc.list_value_length(b).to_numpy())])]).astype(np.int64)
    return text.tobytes(), places[bounds]


# -- on a table -------------------------------------------------------------------
def _coded(a_id: pa.Array, b_id: pa.Array, b_size: int) -> pa.Array:
    """One number for a pair of ids."""
    return pc.add(pc.multiply(a_id.cast(pa.int64()), b_size), b_id.cast(pa.int64()))


def _per_document(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def _packed(values: np.ndarray, counts: np.ndarray, kind: type) -> pa.Array:
    """Numbers of each document as bytes, which Spark moves without a look at
    every number."""
    bounds = np.concatenate([[0], np.cumsum(counts)]) * np.dtype(kind).itemsize
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(values.astype(kind).tobytes())])


def _unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a packed column, and the n+1 offsets of its rows."""
    buf, bounds = utf8(column)
    return np.frombuffer(buf.tobytes(), kind), bounds // np.dtype(kind).itemsize


def _id_kind(size: int) -> type:
    return np.uint16 if size <= 1 << 16 else np.uint32


def aligned(docs: DataFrame, byte_level: bytes, pieces: bytes) -> DataFrame:
    """One row per document: ``row`` (unique), ``doc_id``, the ids ``a`` and
    ``b``, which side ends at each link (``ends``: bit 0 A, bit 1 B), all three
    packed; the number and the digest of its groups.  Rows without ``row`` hold what a
    task counted: ``codes`` of pairs of ids and on how many links they are."""
    shared = docs.sparkSession.sparkContext.broadcast((byte_level, pieces))
    longs = pa.list_(pa.int64())
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("ends", pa.binary()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()),
                        ("codes", longs), ("times", longs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        both, serial = Vocabularies(*shared.value), TaskContext.get().partitionId() << 33
        lengths = [pc.binary_length(x).cast(pa.int64()) for x in (both.a_bytes, both.b_bytes)]
        a_size, b_size = map(len, lengths)
        pool = pa.array(_written_ids(a_size, "|") + _written_ids(b_size, ";"), pa.large_string())
        held = [pa.table({"code": pa.array([], pa.int64()), "c": pa.array([], pa.int64())})]

        def added_up() -> pa.Table:
            return pa.concat_tables(held).group_by("code", use_threads=False).aggregate([("c", "sum")]).rename_columns(["code", "c"]).combine_chunks()

        def counted(own: pa.Table) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.nulls(1, f.type) for f in list(schema)[:-2]), *(_per_document(pa.concat_arrays([*c.chunks, pa.array([], pa.int64())]), [len(own)]) for c in own.columns)], schema=schema)

        for batch in batches:
            _, offsets = utf8(batch.column("text"))
            for i, j in blocks(offsets, TEXT):
                a, b = both.encode([t or "" for t in batch.column("text")[i:j].to_pylist()])
                table = links(a, b, *lengths)
                doc, a_ends, b_ends = (table[c].to_numpy() for c in ("doc", "a_ends", "b_ends"))
                text, places = group_texts(a, b, table, pool, a_size)
                digests = [hashlib.sha256(text[low:high - 1]).hexdigest() if high > low else "" for low, high in zip(places.tolist(), places[1:].tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(serial, serial + j - i)), batch.column("doc_id")[i:j],
                    *(_packed(x.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(x).to_numpy(), _id_kind(n)) for x, n in ((a, a_size), (b, b_size))),
                    _packed(a_ends + 2 * b_ends.astype(np.uint8), np.bincount(doc, minlength=j - i), np.uint8),
                    pa.array(np.bincount(doc[a_ends & b_ends], minlength=j - i).astype(np.int64)), pa.array(digests, pa.string()), pa.nulls(j - i, longs), pa.nulls(j - i, longs)], schema=schema)
                serial += j - i
                more = pa.table({"code": _coded(table["a_id"], table["b_id"], b_size)}).group_by("code", use_threads=False).aggregate([([], "count_all")]).rename_columns(["code", "c"])
                held.append(more)
                if sum(map(len, held)) > HELD:
                    held[:] = [added_up()]
                    if len(held[0]) > HELD // 2:
                        yield counted(held[0])
                        held[0] = held[0].slice(0, 0)
        yield counted(added_up())

    return docs.mapInArrow(run, "row long, doc_id long, a binary, b binary, ends binary, n_groups long, groups_sha256 string, codes array<long>, times array<long>")


def _known_counts(rows: DataFrame, shared) -> DataFrame:
    """Per row its counts, what the frequent pairs contribute, and the codes
    and numbers of its other pairs."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                        ("best_known", pa.int64()), ("sum_known", pa.int64()), ("codes", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_size, b_size, code, c, best = shared.value
        for batch in batches:
            for i, j in blocks(utf8(batch.column("ends"))[1], LINKS):
                n, part = j - i, batch.slice(i, j - i)
                (a, a_bounds), (b, b_bounds), (ends, bounds) = (_unpacked(part.column(x), kind) for x, kind in (("a", _id_kind(a_size)), ("b", _id_kind(b_size)), ("ends", np.uint8)))
                in_a, in_b = (np.cumsum(bit, dtype=np.int64) - bit for bit in (ends & 1, ends >> 1))
                pair, where = np.unique(a[in_a].astype(np.int64) * b_size + b[in_b], return_inverse=True)
                at = np.minimum(np.searchsorted(code, pair), max(len(code) - 1, 0))
                hit = code[at] == pair if len(code) else np.zeros(len(pair), bool)
                count = np.where(hit, c[at], 0) if len(code) else np.zeros(len(pair), np.int64)
                totals = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[where])])[bounds]).astype(np.int64)
                doc, other = np.repeat(np.arange(n), np.diff(bounds)), ~hit[where]
                rare = pa.table({"doc": doc[other], "code": pair[where[other]]}).group_by(["doc", "code"], use_threads=False).aggregate([([], "count_all")]).sort_by("doc").combine_chunks()
                each = np.bincount(rare["doc"].to_numpy(), minlength=n)
                yield pa.RecordBatch.from_arrays([
                    part.column("row"), part.column("doc_id"), pa.array(np.diff(a_bounds)), pa.array(np.diff(b_bounds)), part.column("n_groups"),
                    pa.array(np.diff(bounds).astype(np.int64)), part.column("groups_sha256"), pa.array(totals((hit & (count == best[pair % b_size])).astype(np.int64))), pa.array(totals(count)),
                    *(_per_document(pa.concat_arrays([*x.cast(pa.int64()).chunks, pa.array([], pa.int64())]), each) for x in (rare["code"], rare["count_all"]))], schema=schema)

    return rows.select("row", "doc_id", "a", "b", "ends", "n_groups", "groups_sha256").mapInArrow(
        run, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, best_known long, sum_known long, codes array<long>, times array<long>")


def align(docs: DataFrame, byte_level: bytes, pieces: bytes, frequent: int = FREQUENT) -> DataFrame:
    """Align a byte-level BPE (A, the contents of its json file) with a
    sentencepiece model (B) over every whole text, led by one space.

    One row per input row: ``doc_id``; ``n_a``, ``n_b`` tokens; ``n_groups``
    (stretches between bytes where tokens of both end); ``n_links``
    (overlapping pairs of tokens); ``n_best`` (links whose pair of ids has the
    highest count that its B id has in the table, ties included);
    ``count_sum`` (of the pairs' counts over the links); ``groups_sha256`` of
    the groups' ids as text.  Texts that are null or empty, or that a
    tokenizer doesn't give back byte by byte, have no tokens: zeros and an
    empty digest.  Rows that repeat, or share an id, each have their row; a
    null id is an id like any other.  Other columns are ignored; an empty
    table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    both = Vocabularies(byte_level, pieces)
    a_size, b_size = len(both.a_bytes), len(both.b_bytes)
    found = written(aligned(docs, byte_level, pieces))
    rows = found.where("row is not null")
    unzipped = lambda df, *keep: df.select(*keep, F.explode(F.arrays_zip("codes", "times")).alias("x")).select(*keep, F.col("x.codes").alias("code"), F.col("x.times").alias("times"))
    counts = written(unzipped(found.where("row is null")).groupBy("code").agg(F.sum("times").alias("c")))
    # one row for each id of B: bounded by its vocabulary
    highest = counts.groupBy((F.col("code") % b_size).alias("b")).agg(F.max("c").alias("most"))
    best = np.zeros(b_size, np.int64)
    for r in highest.collect():
        best[r.b] = r.most
    code, c = _frequent(counts, frequent)
    shared = docs.sparkSession.sparkContext.broadcast((a_size, b_size, code.view(np.int64), c, best))
    known = written(_known_counts(rows, shared))
    # the counts of all other pairs come by a join
    top = counts.join(F.broadcast(highest), F.col("code") % b_size == F.col("b")).select("code", "c", (F.col("c") == F.col("most")).cast("long").alias("top"))
    rare = unzipped(known, "row").join(top, "code").groupBy("row").agg(F.sum(F.col("times") * F.col("c")).alias("sum_rare"), F.sum(F.col("times") * F.col("top")).alias("best_rare"))
    zero = F.lit(0).cast("long")
    return known.join(rare, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("best_known") + F.coalesce("best_rare", zero)).alias("n_best"),
        (F.col("sum_known") + F.coalesce("sum_rare", zero)).alias("count_sum"), "groups_sha256")

"""Suffix-array deduplication: repeated byte strings of a fixed least length.

Sorting the suffixes of a whole corpus would move every byte hundreds of
times.  Instead the suffix array is sparse: of every window of ``LENGTH``
bytes the place of its least ``GRAM``-byte hash is an anchor, so equal windows
have an anchor at the same place, and there are about 2/(LENGTH−GRAM) anchors
a byte.  Anchors whose gram occurs once cannot be in a repeat and stay where
they are.  The others are grouped by gram; in a group the suffixes that begin
at the anchors, and the reversed prefixes that end there, are put in order by
a deep-shallow sort, which also gives their common lengths.  An anchor's
repeats reach ``left`` bytes back and ``right`` bytes on, the most over all
other anchors that share left + right >= LENGTH bytes with it.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.textnum import _BYTE, _P, _P_INV, U, _powers, blocks, mix, utf8

#: Least length of a repeat, bytes of a gram, depth at which multikey quicksort hands over to blind tries.
LENGTH, GRAM, SHALLOW = 400, 32, 96


# -- anchors ------------------------------------------------------------------
def anchors(buf: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place in the row, and gram hash of every anchor of some texts: for
    each window of ``length`` bytes the leftmost least gram."""
    none = np.zeros(0, np.int64)
    n, wide = len(buf), length - gram + 1
    if n < length:
        return none, none, np.zeros(0, U)
    total = np.zeros(n + 1, U)
    np.cumsum(_BYTE[buf] * _powers("p", _P, n), out=total[1:])
    code = mix((total[gram:] - total[:-gram]) * _powers("i", _P_INV, n + 1)[:n - gram + 1])
    # hash above, place below: the least is the least hash, the leftmost of equal ones
    bits = U(max(20, int(n).bit_length()))
    ranked = (code >> bits << bits) | np.arange(len(code), dtype=U)
    m = -(-len(ranked) // wide) * wide
    padded = np.full(m, U(2**64 - 1))
    padded[:len(ranked)] = ranked
    ahead = np.minimum.accumulate(padded.reshape(-1, wide), 1).reshape(-1)
    behind = np.minimum.accumulate(padded.reshape(-1, wide)[:, ::-1], 1)[:, ::-1].reshape(-1)
    starts = len(ranked) - wide + 1
    best = np.minimum(behind[:starts], ahead[wide - 1:wide - 1 + starts])
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:starts]
    best = best[np.arange(starts) + length <= offsets[1:][row]]  # windows inside one text
    at = np.unique(best & ((U(1) << bits) - U(1))).astype(np.int64)
    row = np.searchsorted(offsets, at, "right") - 1
    return row, at - offsets[row], code[at]


# -- deep-shallow sorting -----------------------------------------------------
def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def _multikey(texts: list[bytes], items: list[int], depth: int) -> Iterator[list[int]]:
    """Multikey quicksort, eight bytes a step: groups in order, each of one
    item or of items that agree on SHALLOW bytes."""
    stack = [(items, depth)]
    while stack:
        items, depth = stack.pop()
        if len(items) < 2 or depth >= SHALLOW:
            yield items
            continue
        keys = [texts[i][depth:depth + 8] for i in items]
        pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
        parts: tuple[list[int], list[int], list[int]] = ([], [], [])
        for i, key in zip(items, keys):
            parts[(key >= pivot) + (key > pivot)].append(i)
        for part, deeper in ((parts[2], 0), (parts[1], 8), (parts[0], 0)):  # the last is taken first
            if part:
                stack.append((part, SHALLOW if deeper and len(pivot) < 8 else depth + deeper))


def _blind_trie(texts: list[bytes], items: list[int]) -> tuple[list[int], list[int]]:
    """Order of texts with a long common prefix, and the common length of
    each with the one before.  An inner node is ``[depth, children]`` and
    knows only the byte at its depth (-1: the text ends there); a leaf is the
    list of equal texts."""
    root: list | None = None

    def byte(text: bytes, depth: int) -> int:
        return text[depth] if depth < len(text) else -1

    for i in items:
        text = texts[i]
        if root is None:
            root = [None, [i]]
            continue
        node = root
        while node[0] is not None:  # blindly down to some leaf
            node = node[1].get(byte(text, node[0])) or next(iter(node[1].values()))
        other = texts[node[1][0]]
        same = common(text, other)
        if same == len(text) == len(other):
            node[1].append(i)
            continue
        above, node = None, root
        while node[0] is not None and node[0] < same:  # to where it really leaves
            above, node = node, node[1][byte(text, node[0])]
        if node[0] == same:
            node[1][byte(text, same)] = [None, [i]]
            continue
        fork = [same, {byte(other, same): node, byte(text, same): [None, [i]]}]
        if above is None:
            root = fork
        else:
            above[1][byte(text, above[0])] = fork
    order: list[int] = []
    lcp: list[int] = []
    stack = [(root, 0)]  # a node, and the depth at which it leaves what came before
    while stack:
        node, depth = stack.pop()
        if node[0] is None:
            for k, i in enumerate(node[1]):
                lcp.append(len(texts[i]) if k else depth)
                order.append(i)
            continue
        children = [node[1][b] for b in sorted(node[1])]
        stack.extend((c, node[0]) for c in reversed(children[1:]))
        stack.append((children[0], depth))
    return order, lcp


def deep_shallow(texts: list[bytes]) -> tuple[list[int], list[int]]:
    """Places of ``texts`` in byte order, and the common length of each with
    the one before (0 for the first)."""
    order: list[int] = []
    lcp: list[int] = []
    for group in _multikey(texts, list(range(len(texts))), 0):
        inner, shared = (group, [0]) if len(group) == 1 else _blind_trie(texts, group)
        shared[0] = common(texts[order[-1]], texts[inner[0]]) if order else 0
        order += inner
        lcp += shared
    return order, lcp


def _reach(order: list[int], lcp: list[int], other_rank: list[int], others: list[bytes], need: int) -> list[int]:
    """For each text the greatest common length a with another text for which
    a + (their common length in ``others``) >= need; -1 where there is none.

    Neighbours in ``order`` are joined from the longest common length down; a
    cluster keeps its members by their rank among ``others``, and only new
    neighbours there can reach further."""
    n = len(order)
    best = [-1] * n
    cluster: list[list] = [[(other_rank[i], i)] for i in order]
    owner = list(range(n))

    def find(x: int) -> int:
        while owner[x] != x:
            owner[x] = owner[owner[x]]
            x = owner[x]
        return x

    for k in sorted(range(1, n), key=lambda k: -lcp[k]):
        a, b = find(k - 1), find(k)
        if len(cluster[a]) < len(cluster[b]):
            a, b = b, a
        into, least = cluster[a], need - lcp[k]
        for entry in cluster[b]:
            at = bisect(into, entry)
            for rank, i in into[max(at - 1, 0):at + 1]:
                if (best[i] < 0 or best[entry[1]] < 0) and common(others[i], others[entry[1]]) >= least:
                    for x in (i, entry[1]):
                        best[x] = max(best[x], lcp[k])
            into.insert(at, entry)
        cluster[b], owner[b] = [], a
    return best


def reaches(left: list[bytes], right: list[bytes], length: int = LENGTH) -> list[tuple[int, int]]:
    """(bytes back, bytes on) that each anchor's repeats reach, (0, 0) without
    one.  ``left`` holds the reversed bytes before the anchors."""
    n = len(left)
    if n == 2:
        a, b = common(left[0], left[1]), common(right[0], right[1])
        return [(a, b) if a + b >= length else (0, 0)] * 2
    (lo, ll), (ro, rl) = deep_shallow(left), deep_shallow(right)
    lr, rr = [0] * n, [0] * n
    for k in range(n):
        lr[lo[k]] = rr[ro[k]] = k
    return [(a, b) if a >= 0 else (0, 0) for a, b in zip(_reach(lo, ll, rr, right, length), _reach(ro, rl, lr, left, length))]


# -- on a table ---------------------------------------------------------------
def _anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    schema = pa.schema([("sha", pa.binary()), ("place", pa.int32()), ("key", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, offsets = utf8(b.column("body"))
            for i, j in blocks(offsets):
                row, place, key = anchors(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], length, gram)
                yield pa.RecordBatch.from_arrays([b.column("sha").take(pa.array(i + row)), pa.array(place.astype(np.int32)), pa.array(key.view(np.int64))], schema=schema)

    return docs.mapInArrow(run, "sha binary, place int, key long")


def _contexts(work: DataFrame, length: int, gram: int) -> DataFrame:
    """``key, before, after, docs, places``: the bytes around the candidate
    anchors; equal contexts of a batch are one row."""
    schema = pa.schema([("key", pa.int64()), ("before", pa.binary()), ("after", pa.binary()), ("docs", pa.list_(pa.binary())), ("places", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in range(0, b.num_rows, 400):
                sub = b.slice(part, 400)
                found: dict[tuple[int, bytes, bytes], tuple[list, list]] = {}
                for doc, body, places, keys in zip(sub.column("sha").to_pylist(), sub.column("body").to_pylist(), sub.column("places").to_pylist(), sub.column("keys").to_pylist()):
                    for p, key in zip(places, keys):
                        one = found.setdefault((key, body[max(0, p - length + gram):p][::-1], body[p:p + length]), ([], []))
                        one[0].append(doc)
                        one[1].append(p)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                        ([k[0] for k in found], [k[1] for k in found], [k[2] for k in found], [v[0] for v in found.values()], [v[1] for v in found.values()]), schema.types)], schema=schema)

    return work.mapInArrow(run, "key long, before binary, after binary, docs array<binary>, places array<int>")


def _repeats(contexts: DataFrame, length: int) -> DataFrame:
    """``sha, low, high``: repeated bytes around each candidate anchor.
    Groups come sorted by key, so one is held at a time."""
    schema = pa.schema([("sha", pa.binary()), ("low", pa.int32()), ("high", pa.int32())])

    def close(group: list[tuple]) -> Iterator[tuple[bytes, int, int]]:
        if len(group) == 1 and len(group[0][2]) == 1:
            return
        reached = reaches([g[0] for g in group], [g[1] for g in group], length) if len(group) > 1 else [(0, 0)]
        for (before, after, docs, places), (a, b) in zip(group, reached):
            if len(docs) > 1 and len(before) + len(after) >= length:
                a, b = len(before), len(after)
            if a + b >= length:
                yield from ((d, p - a, p + b) for d, p in zip(docs, places))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, group, rows = None, [], []
        for b in batches:
            for key, *rest in zip(*(b.column(c).to_pylist() for c in ("key", "before", "after", "docs", "places"))):
                if key != current:
                    rows.extend(close(group) if group else ())
                    current, group = key, []
                group.append(tuple(rest))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                rows = []
        rows.extend(close(group) if group else ())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    parts = contexts.repartition("key").sortWithinPartitions("key")
    return parts.mapInArrow(run, "sha binary, low int, high int")


def _without(work: DataFrame) -> DataFrame:
    """``sha, n_removed, n_spans, kept`` of texts with their repeats."""
    schema = pa.schema([("sha", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, body, spans in zip(b.column("sha"), b.column("body"), b.column("spans")):
                body, kept, done, removed, runs, end = body.as_py(), [], 0, 0, 0, -1
                for low, high in sorted((s["low"], s["high"]) for s in spans.as_py()):
                    if low > end:
                        runs += 1
                        kept.append(body[done:low])
                        removed += high - low
                        done = end = high
                    elif high > end:
                        removed += high - end
                        done = end = high
                rows.append((doc.as_py(), removed, runs, b"".join(kept) + body[done:]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return work.mapInArrow(run, "sha binary, n_removed long, n_spans long, kept binary")


def substring_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that also
    starts anywhere else in the table (the same text included, overlaps
    count); strings don't cross texts and are judged on the input.

    One row per input row: ``doc_id, n_bytes, n_removed, n_spans`` (maximal
    removed runs) and ``kept_sha256`` of the remaining bytes.  Inside, a text
    is known by its digest, never by its id, so rows that share an id, or have
    none, are texts like any others, and a row that occurs twice is two copies.
    A null text counts as empty; texts under ``length`` bytes keep all.  Other
    columns are ignored; an empty table gives no rows.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("body")).withColumn("sha", F.unhex(F.sha2("body", 256)))
    slim = docs.select("doc_id", F.octet_length("body").cast("long").alias("n_bytes"), "sha")
    # equal whole texts: all go, and one of them stands for them against the others
    several = slim.where(F.col("n_bytes") >= length).groupBy("sha").agg(F.count("*").alias("n")).where("n > 1").select(F.col("sha").alias("copied"))

    long = docs.where(F.octet_length("body") >= length).select("sha", "body")
    found = written(_anchor_rows(long, length, gram).dropDuplicates(["sha", "place"]))
    again = found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    per_doc = found.join(again, "key").groupBy("sha").agg(F.collect_list(F.struct("place", "key")).alias("x"))
    # the copies of a text become one in each task, before its bytes are shuffled
    texts = long.groupBy("sha").agg(F.first("body").alias("body"))
    work = written(texts.join(per_doc, "sha").select("sha", "body", F.col("x.place").alias("places"), F.col("x.key").alias("keys")))

    spans = _repeats(_contexts(work, length, gram), length).groupBy("sha").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    edited = _without(work.select("sha", "body").join(spans, "sha")).select(F.col("sha").alias("edited"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

    out = slim.join(several, F.col("sha") == F.col("copied"), "left").join(edited, F.col("sha") == F.col("edited"), "left")
    gone = F.col("copied").isNotNull()
    whole = lambda a, b: F.when(gone, a).otherwise(b)
    return out.select("doc_id", "n_bytes",
                      whole(F.col("n_bytes"), F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
                      whole(F.lit(1), F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
                      whole(F.sha2(F.lit("").cast("binary"), 256), F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"))

"""Line deduplication by a segment-partition edit join.

Two lines are linked when their edit distance (in bytes, of the lines
without white space at the ends) is at most the threshold of the shorter
one.  A line of threshold t is split into t + 1 segments, of which an edit
script of t steps leaves one untouched: a linked line has that segment as a
substring, at a place within a few bytes.  Every line indexes its segments
and probes the substrings that a line of its own length or up to t bytes
shorter could have; lines that share such a key are verified with banded
bit-parallel edit distance, and linked lines form classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.components import crossed, linked_classes
from tessera.llm.textnum import _BYTE, _P, _P_INV, _SPACE, U, _powers, blocks, mix, utf8

#: Threshold by length in bytes: lines from the second length on allow 2 edits, from the first on 1; shorter ones must be equal.
ONE_EDIT, TWO_EDITS = 24, 48
LEADER_ROUNDS = 1
#: Longs of a line's sketch: parities of 64 byte buckets, then of 256 byte-pair buckets.
SKETCH = 5
#: Kinds of a key, as bits.
SEGMENT, PROBE = 1, 2


def threshold(length: np.ndarray) -> np.ndarray:
    return (length >= ONE_EDIT).astype(np.int64) + (length >= TWO_EDITS)


def edit_distance_within(a: bytes, b: bytes, most: int) -> bool:
    """Whether the edit distance is at most ``most``.

    Common ends are cut off; then a band of 2·most + 1 diagonals is run down
    the shorter text, its vertical differences held in the bits of two
    integers (Myers' recurrences, the band moving one row with each column)."""
    if len(a) > len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if n - m > most:
        return False
    if a == b:
        return True
    low = 0
    while low < m and a[low] == b[low]:
        low += 1
    while m > low and a[m - 1] == b[n - 1]:
        m, n = m - 1, n - 1
    a, b, m, n = a[low:m], b[low:n], m - low, n - low
    if not m:
        return n <= most
    places: dict[int, int] = {}
    for j, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << j
    band = (1 << 2 * most + 1) - 1
    vp, vn = band >> most << most, 0  # rows up to 0 are level, those below rise by one
    distance = min(most, m)
    top = 1 << 2 * most
    for i in range(1, n + 1):
        shift = i - most - 1  # the row below the band's lowest
        mask = places.get(b[i - 1], 0)
        x = (mask >> shift if shift >= 0 else mask << -shift) & band
        d0 = (((x & vp) + vp) ^ vp | x | vn) & band
        hp, hn = (vn | ~(d0 | vp)) & band, d0 & vp
        if i + most <= m:  # down the band's last diagonal
            distance += not d0 & top
        else:  # then along the last row
            row = 1 << (m - i + most)
            distance += bool(hp & row) - bool(hn & row)
        if distance > most + n - i + (m - min(m, i + most)):
            return False
        vp, vn = (hn | ~(d0 >> 1 | hp)) & band, d0 >> 1 & hp
    return distance <= most


# -- lines --------------------------------------------------------------------
def split_lines(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, number, start and end of every \\n-split line of some texts; start
    and end leave out white space at the line's ends."""
    breaks = np.flatnonzero(buf == 10)
    row_of_break = np.searchsorted(offsets, breaks, "right") - 1
    row = np.concatenate([np.arange(len(offsets) - 1), row_of_break])
    start = np.concatenate([offsets[:-1], breaks + 1])
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    last = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
    end = np.where(last, offsets[1:][row], np.append(start[1:] - 1, 0)) if len(row) else start
    number = np.arange(len(row)) - np.searchsorted(row, row)
    solid = np.flatnonzero(~_SPACE[buf])
    a, b = np.searchsorted(solid, start), np.searchsorted(solid, end)
    some = b > a
    if len(solid):
        start = np.where(some, solid[np.minimum(a, len(solid) - 1)], start)
        end = np.where(some, solid[np.maximum(b - 1, 0)] + 1, start)
    else:
        end = start
    return row, number, start, end


class Hashes:
    """Hashes of any byte spans of a block."""

    def __init__(self, buf: np.ndarray) -> None:
        self.total = np.zeros(len(buf) + 1, U)
        np.cumsum(_BYTE[buf] * _powers("p", _P, len(buf)), out=self.total[1:])
        self.back = _powers("i", _P_INV, len(buf) + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray, salt: np.ndarray | np.uint64 = U(0)) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.back[start] + (end - start).astype(U) + salt)


def line_ids(hashes: Hashes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return hashes(start, end, U(0x6C696E65)).view(np.int64)


def segment(length: np.ndarray, t: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of segment k (from 0) of t + 1 nearly equal ones; the later ones are the longer."""
    size = length // (t + 1)
    longer = length - size * (t + 1)  # so many at the end have a byte more
    first = k * size + np.maximum(k - (t + 1 - longer), 0)
    return first, size + (k >= t + 1 - longer)


def join_keys(hashes: Hashes, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(line places, keys) of the segments and of the probed substrings; the
    last two bits of a key are 1 for a segment, 2 for a probe and 3 for both,
    and what is above hashes the length of the shorter line, the segment's
    number and its bytes.  A line probes its own segments where they are."""
    length = end - start
    own = threshold(length)

    def keys(which: np.ndarray, at: np.ndarray, size: np.ndarray, l: np.ndarray, k: int, kind: int) -> tuple[np.ndarray, np.ndarray]:
        code = hashes(at, at + size, (l.astype(U) * U(8) + U(k)) * U(0xD1342543DE82EF95))
        return which, ((code & ~U(3)) | U(kind)).view(np.int64)

    for k in range(3):
        which = np.flatnonzero((own >= k) & (own > 0))
        first, size = segment(length[which], own[which], k)
        yield keys(which, start[which] + first, size, length[which], k, SEGMENT | PROBE)
        for less in range(3):
            l = length - less
            t = threshold(np.maximum(l, 0))
            which = np.flatnonzero((t >= less) & (t >= k) & (t > 0))
            first, size = segment(l[which], t[which], k)
            for move in range(-2, 3):
                if not less and not move:
                    continue
                # the segments before k can have shifted it by k, those after it by t - k off the shift by length
                fits = (abs(move) <= k) & (np.abs(move - less) <= t[which] - k) & (first + move >= 0) & (first + move + size <= length[which])
                if fits.any():
                    yield keys(which[fits], start[which[fits]] + first[fits] + move, size[fits], l[which[fits]], k, PROBE)


_LINE_KEYS = "key long, id long"


def _key_rows(docs: DataFrame) -> DataFrame:
    """``key, id`` of the lines, equal lines of a block once."""
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, offsets = utf8(b.column("text"))
            for i, j in blocks(offsets):
                part = buf[offsets[i]:offsets[j]]
                _, _, start, end = split_lines(part, offsets[i:j + 1] - offsets[i])
                hashes = Hashes(part)
                ids, once = np.unique(line_ids(hashes, start, end), return_index=True)
                for which, key in join_keys(hashes, start[once], end[once]):
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids[which])], schema=schema)

    return docs.select("text").mapInArrow(run, _LINE_KEYS)


def _shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, id, kind`` of the keys (rows ``key, id`` sorted by key) that
    several ids have, the kinds of an id in a batch together.  Of the key that
    ends a batch the rows are held, at most one a kind, until a second id shows."""
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("kind", pa.int32())])
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    shared_key = None  # the last key, if it is known to be shared
    for b in batches:
        if not b.num_rows:
            continue
        code, ids = (np.concatenate([h, b.column(c).to_numpy()]) for h, c in zip(held, ("key", "id")))
        key = code >> 2
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        shared = np.minimum.reduceat(ids, begin) < np.maximum.reduceat(ids, begin)
        shared[0] |= key[0] == shared_key
        keep = np.repeat(shared, np.diff(np.append(begin, len(key))))
        last = begin[-1]
        if shared[-1]:
            shared_key, held = key[-1], (code[:0], ids[:0])
        else:
            _, once = np.unique(code[last:], return_index=True)
            shared_key, held = None, (code[last:][once], ids[last:][once])
        key, ids, kind = key[keep], ids[keep], (code[keep] & 3).astype(np.int32)
        if len(key):
            order = np.lexsort((ids, key))
            key, ids, kind = key[order], ids[order], kind[order]
            first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])))
            yield pa.RecordBatch.from_arrays([pa.array(key[first]), pa.array(ids[first]), pa.array(np.bitwise_or.reduceat(kind, first))], schema=schema)


def _shared_keys(keys: DataFrame) -> DataFrame:
    """The rows whose key (but for the kind) several ids have.  Rows come
    sorted by one long, so this compares neighbours and holds one batch."""
    # the whole of a key's rows meet in one task, which only streams through them
    return keys.repartition(F.shiftright("key", 2)).sortWithinPartitions("key").mapInArrow(_shared_rows, "key long, id long, kind int")


def _line_rows(docs: DataFrame) -> DataFrame:
    """``place, digest, number, id`` of every line with a word."""
    schema = pa.schema([("place", pa.int64()), ("digest", pa.int64()), ("number", pa.int32()), ("id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, offsets = utf8(b.column("text"))
            for i, j in blocks(offsets):
                part = buf[offsets[i]:offsets[j]]
                row, number, start, end = split_lines(part, offsets[i:j + 1] - offsets[i])
                some = end > start
                owner = pa.array(i + row[some])
                yield pa.RecordBatch.from_arrays([b.column("place").take(owner), b.column("digest").take(owner), pa.array(number[some].astype(np.int32)), pa.array(line_ids(Hashes(part), start, end)[some])], schema=schema)

    return docs.select("place", "digest", "text").mapInArrow(run, "place long, digest long, number int, id long")


def _line_texts(docs: DataFrame) -> DataFrame:
    """``id, line`` (bytes) of the distinct lines of each block that can have links."""
    schema = pa.schema([("id", pa.int64()), ("line", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, offsets = utf8(b.column("text"))
            for i, j in blocks(offsets):
                part = buf[offsets[i]:offsets[j]]
                _, _, start, end = split_lines(part, offsets[i:j + 1] - offsets[i])
                ids, once = np.unique(line_ids(Hashes(part), start, end), return_index=True)
                long = end[once] - start[once] >= ONE_EDIT
                raw = part.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(ids[long]), pa.array([raw[a:z] for a, z in zip(start[once][long].tolist(), end[once][long].tolist())], pa.binary())], schema=schema)

    return docs.select("text").mapInArrow(run, "id long, line binary")


def sketches(lines: list[bytes]) -> np.ndarray:
    """(lines, SKETCH) longs: the parity of the number of bytes in each of 64
    buckets, and of byte pairs in each of 256.  An edit flips at most two
    of the first and four of the others."""
    out = np.zeros((len(lines), SKETCH), U)
    size = np.array([len(x) for x in lines], np.int64)
    buf = np.frombuffer(b"".join(lines), np.uint8).astype(U)
    if not len(buf):
        return out
    begin = np.cumsum(size) - size
    some = np.flatnonzero(size)
    out[some, 0] = np.bitwise_xor.reduceat(U(1) << (buf & U(63)), begin[some])
    pair = np.zeros(len(buf), U)
    pair[:-1] = (buf[:-1] * U(0x9E3779B1) + buf[1:] * U(0x85EBCA6B)) >> U(7) & U(255)
    bit = U(1) << (pair & U(63))
    bit[begin[some] + size[some] - 1] = U(0)  # the pair across two lines
    for w in range(4):
        out[some, 1 + w] = np.bitwise_xor.reduceat(np.where(pair >> U(6) == U(w), bit, U(0)), begin[some])
    return out


def _with_sketches(texts: DataFrame) -> DataFrame:
    names = [f"s{i}" for i in range(SKETCH)]
    schema = pa.schema([("id", pa.int64()), ("line", pa.binary()), ("size", pa.int32()), *((n, pa.int64()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 2000):
                part = b.slice(i, 2000)
                lines = part.column("line").to_pylist()
                made = sketches(lines).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("line"), pa.array([len(x) for x in lines], pa.int32()), *(pa.array(made[:, k].copy()) for k in range(SKETCH))], schema=schema)

    return texts.mapInArrow(run, "id long, line binary, size int, " + ", ".join(f"{n} long" for n in names))


def _may_be_near(a: str, b: str) -> Column:
    """Whether two lines' lengths and sketches allow two edits."""
    flips = [F.bit_count(F.col(f"s{i}{a}").bitwiseXOR(F.col(f"s{i}{b}"))) for i in range(SKETCH)]
    return (F.abs(F.col(f"size{a}") - F.col(f"size{b}")) <= 2) & (flips[0] <= 4) & (sum(flips[2:], flips[1]) <= 8)


_SLIM = ["size", *(f"s{i}" for i in range(SKETCH))]


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose lines are within the shorter one's threshold: lengths
    and sketches sort out first, then the texts decide."""
    schema = pa.schema([("comp_a", pa.int64()), ("comp_b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = b.column("line_a").to_pylist(), b.column("line_b").to_pylist()
            most = threshold(np.array([min(len(p), len(q)) for p, q in zip(x, y)], np.int64)).tolist()
            good = pa.array([edit_distance_within(p, q, t) for p, q, t in zip(x, y, most)], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(c).filter(good) for c in ("comp_a", "comp_b")], schema=schema)

    for side in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("id").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in _SLIM)), side)
    pairs = pairs.where(_may_be_near("_a", "_b")).select("a", "comp_a", "b", "comp_b")
    for side in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("id").alias(side), F.col("line").alias(f"line_{side}")), side)
    return pairs.select("comp_a", "comp_b", "line_a", "line_b").mapInArrow(run, "comp_a long, comp_b long")


def _probes(a: str, b: str) -> Column:
    """Whether the second side probes a segment of the first; of two lines that probe each other, once."""
    kind_a, kind_b = F.col(f"kind{a}"), F.col(f"kind{b}")
    return (kind_a.bitwiseAND(SEGMENT) > 0) & (kind_b.bitwiseAND(PROBE) > 0) & ((kind_a != kind_b) | (F.col(f"id{a}") < F.col(f"id{b}")))


def line_classes(docs: DataFrame) -> DataFrame:
    """``id, comp`` of the lines that share a key with another line; lines of
    one class have the same comp.  A line that isn't here is alone."""
    rows = written(_shared_keys(_key_rows(docs)))
    ids = rows.select("id").distinct()
    texts = written(_with_sketches(_line_texts(docs).join(ids, "id", "left_semi").dropDuplicates(["id"])))
    return linked_classes(
        rows, confirm=lambda pairs: _verified(pairs, texts), leader_rounds=LEADER_ROUNDS, leaders=1,
        compare=lambda rest: _verified(crossed(rest.join(texts.select("id", *_SLIM), "id"), lambda a, b: _probes(a, b) & _may_be_near(a, b)), texts))


#: Place of rows without an id, after all others.
LAST = 2**63 - 1


def row_key(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """``place`` and ``digest`` of a row, which tell it apart and put it in
    order: by doc_id (missing ones last), then by a hash of the text.  Rows
    equal in both are equal in id and text."""
    return F.coalesce(doc_id.cast("long"), F.lit(LAST)), F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text, place, digest``; a null text is empty."""
    place, digest = row_key(F.col("doc_id"), F.col("text"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), place.alias("place"), digest.alias("digest"))


def _decided(docs: DataFrame, units: DataFrame | None) -> DataFrame:
    """``place, digest, n_lines, dropped`` of every row of ``docs`` (see
    keyed), equal rows once; dropped is null where no line goes.

    Each step is written, so no plan holds more than a few joins: the driver
    plans a query anew after each of its stages, and what that takes grows
    with the whole plan."""
    row = ["place", "digest"]
    comp = line_classes(docs)
    lines = _line_rows(docs).join(comp, "id", "left").select(*row, "number", F.coalesce("comp", "id").alias("class"))
    if units is not None:
        lines = lines.join(units, row, "left").select(*row, "number", "class", "unit")
    lines = written(lines)
    per_row = lines.groupBy(*row).agg(F.count("*").alias("all_lines"))
    if units is not None:  # a unit stands before the rows of its doc_id that aren't in it
        lines = lines.select(*row, "number", "class", F.coalesce("unit", "place").alias("up"),
                             F.when(F.col("unit").isNotNull(), F.lit(-2**63)).otherwise(F.col("digest")).alias("ud"))
    else:
        lines = lines.withColumns({"up": F.col("place"), "ud": F.col("digest")})
    # from here on only lines of classes that occur more than once
    repeated = lines.groupBy("class").agg(F.count("*").alias("n"), F.min("up").alias("first_place")).where("n > 1").select("class", "first_place")
    lines = written(lines.join(repeated, "class"))
    first = lines.where("up = first_place").groupBy("class").agg(F.min("ud").alias("first_digest"))
    here = lines.groupBy("class", *row).agg(F.min("number").alias("first_here"))
    gone = lines.join(first, "class").join(here, ["class", *row]).where("number > first_here or up > first_place or ud > first_digest and up = first_place")
    found = written(gone.groupBy(*row).agg(F.sort_array(F.collect_set("number")).alias("dropped")))
    # rows that are equal in id and text have counted together
    equal = docs.groupBy(*row).agg(F.count("*").alias("rows"))
    return equal.join(per_row, row, "left").join(found, row, "left").select(
        *row, F.coalesce(F.expr("all_lines div rows"), F.lit(0)).cast("long").alias("n_lines"), "dropped")


def line_decisions(docs: DataFrame, units: DataFrame | None = None) -> DataFrame:
    """``doc_id, place, digest, n_lines, dropped``: the numbers (from 0,
    ascending) of the lines of each document that repeat an earlier line.

    A line repeats an earlier one when its class has a line before it, in the
    order of doc_id (rows without one last), then of the text's hash, and of
    the number in the text.  ``units`` (``place, digest, unit``) names the rows
    that stand at the place of a doc_id ``unit``, each once: rows of one unit
    are copies of each other, don't count as earlier, and lose what their unit
    loses.  n_lines counts lines with a word; others are never dropped.  A null
    text has no lines.  Rows that share an id and differ in text are documents
    of their own; rows equal in both don't repeat each other.  An empty table
    gives no rows.
    """
    docs = keyed(docs)
    return docs.select("doc_id", "place", "digest").join(_decided(docs, units), ["place", "digest"], "left").select(
        "doc_id", "place", "digest", "n_lines", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))


def line_dedup(docs: DataFrame, units: DataFrame | None = None, drop_emptied: bool = False) -> DataFrame:
    """The rows of ``docs`` with repeated lines cut out of ``text`` (see
    line_decisions) and ``n_chars``, if there, set to the new length.  A text
    that loses nothing is as it was, null included; all columns stay, and all
    rows but, with ``drop_emptied``, those that lose every line with a word."""
    # names that no column of the input has
    cuts = _decided(keyed(docs), units).where("dropped is not null").select(
        F.col("place").alias("__place"), F.col("digest").alias("__digest"), F.col("dropped").alias("__dropped"),
        (F.size("dropped") == F.col("n_lines")).alias("__emptied"))
    parts = F.split("text", "\n", -1)
    kept = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(F.col("__dropped"), i.cast("int"))), "\n")
    place, digest = row_key(F.col("doc_id"), F.col("text"))
    out = docs.join(cuts, (place == F.col("__place")) & (digest == F.col("__digest")), "left")
    if drop_emptied:
        out = out.where(~F.coalesce("__emptied", F.lit(False)))
    out = out.withColumn("text", F.when(F.col("__dropped").isNull(), F.col("text")).otherwise(kept))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__dropped").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)

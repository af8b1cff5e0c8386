"""MinHash near-deduplication by a multi-index Hamming join.

A document's signature is ``SYMBOLS`` min-hashes of ``BITS`` bits each.  It is
split into chunks of four symbols, and each chunk may hold one wrong symbol:
by the pigeonhole principle two signatures that differ in at most
2·chunks − 1 symbols have a chunk with at most one difference.  The allowed
errors of a chunk are enumerated by leaving out each of its symbols in turn,
so such a pair always shares a key.  Candidates are confirmed on the full
shingle sets.

Documents with equal sets are one node.  Keys shared by many nodes (a group
of thousands of near copies) give no pairs within the group: one round
pairs every node of a key with a few leaders of the key, and what is linked
becomes one component; only then the nodes of different components that are
left in a key are compared by their full sets, in cells of bounded size,
and none is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.components import cells, linked_classes
from tessera.llm.textnum import U, blocks, give_back, lower, mix, span_hash, span_identity, utf8, window_hash, words

#: Symbols of a signature, bits of a symbol, symbols of a chunk.
SYMBOLS, BITS, CHUNK = 32, 14, 4
#: Largest distance (in symbols) at which the multi-index guarantees a shared key: one error allowed in each chunk.
DISTANCE = 2 * (SYMBOLS // CHUNK) - 1
#: Rounds in which keys link their nodes to a leader before the pairs that are left are compared.
LEADER_ROUNDS = 1

#: Distinct shingles whose incidence is held as a matrix at once.
COLUMNS = 2048

_SEEDS = mix(np.arange(1, SYMBOLS + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of every text."""
    low = lower(buf)
    starts, ends, bounds = words(low, offsets)
    runs, run_bounds = window_hash(span_hash(low, starts, ends), bounds, k)
    return [np.unique(runs[a:b]) for a, b in zip(run_bounds[:-1].tolist(), run_bounds[1:].tolist())]


def _least(flat: np.ndarray, begin: np.ndarray, seeds: np.ndarray) -> Iterator[np.ndarray]:
    """For each seed the mixed least hash of every set."""
    for seed in seeds:
        yield mix(np.minimum.reduceat((flat ^ (seed >> U(7))) * seed, begin))


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, SYMBOLS) min-hash symbols; no set may be empty."""
    begin = np.cumsum([0, *map(len, sets[:-1])])
    return np.stack([x & U((1 << BITS) - 1) for x in _least(np.concatenate(sets), begin, _SEEDS[:SYMBOLS])], 1)


def _keys(signatures: np.ndarray) -> np.ndarray:
    """One key per chunk and symbol left out."""
    out = np.empty_like(signatures)
    weight = mix(np.arange(7, 7 + CHUNK, dtype=U)) | U(1)
    for c in range(0, SYMBOLS, CHUNK):
        parts = signatures[:, c:c + CHUNK] * weight
        for j in range(CHUNK):
            out[:, c + j] = mix(parts.sum(1, dtype=U) - parts[:, j] + mix(np.array([c + j + 1], U))[0])
    return out


def _lists(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(flat.view(np.int64)))


def sketch(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, n_shingles, h1, h2, keys``: (n_shingles, h1, h2) identifies
    the shingle set; there are no keys for a text without words."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, offsets = utf8(b.column("text"))
            for i, j in blocks(offsets):
                sets = shingle_sets(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k)
                size = np.array([len(s) for s in sets], np.int64)
                full = [s for s in sets if len(s)]
                identity = np.array([span_identity(s) for s in sets], U).reshape(len(sets), 2).view(np.int64)
                signatures = _signatures(full) if full else np.zeros((0, SYMBOLS), U)
                keys = _keys(signatures)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id")[i:j], pa.array(size), pa.array(identity[:, 0]), pa.array(identity[:, 1]),
                     _lists(keys.reshape(-1), (size > 0) * keys.shape[1])], schema=schema)

    return docs.mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long, keys array<long>")


def _full_sets(docs: DataFrame, k: int) -> DataFrame:
    """``id, n, shingles`` of documents (columns id, text) with words."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, offsets = utf8(b.column("text"))
            for i, j in blocks(offsets, 1 << 19):
                sets = shingle_sets(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k)
                some = np.flatnonzero([len(s) for s in sets])
                if len(some):
                    full = [sets[x] for x in some]
                    size = np.array([len(s) for s in full])
                    yield pa.RecordBatch.from_arrays([b.column("id")[i:j].take(pa.array(some)), pa.array(size), _lists(np.concatenate(full), size)], schema=schema)

    return docs.mapInArrow(run, "id long, n long, shingles array<long>")


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity, with the carried
    columns.  Sizes sort out first, then the full sets decide."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}")), side)
    pairs = pairs.where(_sizes_fit("n_a", "n_b", percent))
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("id").alias(side), F.col("shingles").alias(f"s_{side}")), side)
    common = F.size(F.array_intersect("s_a", "s_b"))
    return pairs.where(100 * common >= percent * (F.col("n_a") + F.col("n_b") - common)).drop("s_a", "s_b")


def shared_counts(flat: np.ndarray, size: np.ndarray) -> np.ndarray:
    """(sets, sets): how many elements two sets share; ``flat`` holds the sets
    one after the other.  The incidence of some distinct elements at a time is
    a matrix of zeros and ones, and its product with itself counts."""
    n = len(size)
    out = np.zeros((n, n), np.float32)  # whole numbers below 2^24
    distinct, place, times = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), size)
    several = np.cumsum(times > 1) - 1  # an element of one set is shared with none
    keep = times[place] > 1
    column, owner = several[place[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((n, int(column[b - 1]) - low + 1), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += part @ part.T
    return out


def _links_of_cells(rest: DataFrame, percent: int) -> DataFrame:
    """``comp_a, comp_b`` of the links between ids of different classes in a
    cell (rows ``key, low, high, part, id, comp, n, shingles``): every pair is
    decided by its full sets.  Cells come sorted, one is held at a time."""
    names = ["key", "low", "high"]
    schema = pa.schema([("comp_a", pa.int64()), ("comp_b", pa.int64())])

    def decided(cell: pa.RecordBatch) -> np.ndarray:
        comp, part, n = (cell.column(c).to_numpy() for c in ("comp", "part", "n"))
        if len(comp) < 2 or (comp == comp[0]).all():
            return np.zeros((2, 0), np.int64)
        common = shared_counts(cell.column("shingles").flatten().to_numpy(), n)
        near = 100 * common >= percent * (n[:, None] + n[None, :] - common)
        near &= comp[:, None] < comp[None, :]
        if cell.column("low")[0].as_py() != cell.column("high")[0].as_py():
            near &= part[:, None] != part[None, :]
        a, b = np.nonzero(near)
        return np.unique(np.stack([comp[a], comp[b]]), axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the cell that the next batch may go on with
        for b in batches:
            if not b.num_rows:
                continue
            code = np.stack([b.column(c).to_numpy() for c in names])
            cut = np.flatnonzero((code[:, 1:] != code[:, :-1]).any(0)) + 1
            bounds = [0, *cut.tolist(), b.num_rows]
            if held and [held[-1].column(c)[-1].as_py() for c in names] != code[:, 0].tolist():
                yield from out([held])
                held = []
            cells = [[*held, b.slice(0, bounds[1])], *([b.slice(x, y - x)] for x, y in zip(bounds[1:], bounds[2:]))]
            held = cells.pop()
            yield from out(cells)
        if held:
            yield from out([held])

    def out(cells: list[list[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
        found = [decided(pa.Table.from_batches(c).combine_chunks().to_batches()[0]) for c in cells]
        if found:
            links = np.unique(np.concatenate(found, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(links[0]), pa.array(links[1])], schema=schema)
        give_back()

    dealt = cells(rest).select(*names, "part", "id", "comp", "n", "shingles")
    return dealt.repartition(*names).sortWithinPartitions(*names).mapInArrow(run, "comp_a long, comp_b long")


def near_dedup(docs: DataFrame, k: int = 5, percent: int = 80, leader_rounds: int = LEADER_ROUNDS) -> DataFrame:
    """Classes of documents linked by 100·|A∩B| ≥ percent·|A∪B| on their sets
    of distinct k-word shingles (A-Z lower-cased; fewer words: the whole
    sequence is the one shingle).

    One row per input row: ``doc_id, n_shingles, component_id`` (smallest
    doc_id that links reach) and ``kept`` (doc_id = component_id).  A text
    that is null or has no words has an empty set and is linked with nothing.
    Rows that share a doc_id are one document for the links.  A null doc_id
    takes no part: its component is null and it is kept.  Other columns are
    ignored; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sketches = written(sketch(docs, k))
    # equal sets are one node, named by its smallest document
    nodes = (sketches.where("n_shingles > 0 and doc_id is not null").groupBy("n_shingles", "h1", "h2")
             .agg(F.min(F.struct("doc_id", "keys")).alias("x")))
    nodes = written(nodes.select("n_shingles", "h1", "h2", F.col("x.doc_id").alias("id"), F.col("x.keys").alias("keys")))

    rows = nodes.select("id", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("key")
    rows = written(rows.join(shared, "key"))
    texts = docs.withColumnRenamed("doc_id", "id").join(rows.select("id").distinct(), "id", "left_semi")
    sets = written(_full_sets(texts, k))
    label = linked_classes(rows, confirm=lambda pairs: _confirmed(pairs, sets, percent), leader_rounds=leader_rounds,
                           compare=lambda rest: _links_of_cells(rest.join(sets, "id"), percent))

    root = nodes.select("n_shingles", "h1", "h2", F.col("id").alias("node_id")).join(label, F.col("node_id") == F.col("id"), "left").select(
        "n_shingles", "h1", "h2", F.coalesce("comp", "node_id").alias("root"))
    out = sketches.select("doc_id", "n_shingles", "h1", "h2").join(root, ["n_shingles", "h1", "h2"], "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))

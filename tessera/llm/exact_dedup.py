"""Exact deduplication with Patricia-trie owners.

Full texts are inserted as byte strings into compressed radix tries, one
trie per (length, content hash) partition.  A terminal node stores the
owner of its text (the smallest or largest identifier) and the number of
copies.  It runs in two levels so that a text held by a third of all rows
never meets in one task: every input split first builds its own tries and
gives one row per distinct text; the split's owners are then shuffled by
(length, content hash) and merged in tries of the same kind, of which a
task holds one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written

#: Bytes of text that one task keeps in its tries before it spills a subtree.
TRIE_BYTES = 48 << 20


def _common(a: bytes, b: bytes, at: int) -> int:
    """Length of the longest common prefix of ``a`` and ``b[at:]``."""
    n = min(len(a), len(b) - at)
    if a[:n] == b[at:at + n]:
        return n
    low, high = 0, n  # a[:low] is common, a[:high] is not
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[at + low:at + mid]:
            low = mid
        else:
            high = mid
    return low


class PatriciaTrie:
    """Compressed radix trie over byte strings; each node is
    ``[label, children by first byte, payload or None]``."""

    def __init__(self) -> None:
        self.root: list = [b"", {}, None]
        self.bytes = 0

    def insert(self, key: bytes) -> list:
        """The terminal node of ``key``, made if it is new."""
        node, at = self.root, 0
        while at < len(key):
            child = node[1].get(key[at])
            if child is None:
                child = node[1][key[at]] = [key[at:], {}, None]
                self.bytes += len(key) - at + 200
                return child
            same = _common(child[0], key, at)
            if same < len(child[0]):
                upper = [child[0][:same], {child[0][same]: child}, None]
                child[0] = child[0][same:]
                node[1][key[at]] = child = upper
                self.bytes += 200
            node, at = child, at + same
        return node

    def terminals(self) -> Iterator[tuple[bytes, list]]:
        """Every stored byte string with its payload."""
        stack = [(b"", self.root)]
        while stack:
            prefix, node = stack.pop()
            text = prefix + node[0]
            if node[2] is not None:
                yield text, node[2]
            stack.extend((text, child) for child in node[1].values())


class Owners:
    """Tries by (length, content hash).  When they exceed ``most`` bytes the
    largest subtree, all tries of one hash byte, is spilled: its owners are
    given out as rows, which the next level merges like any others."""

    def __init__(self, keep: str, most: int) -> None:
        self.better, self.most, self.bytes = (max if keep == "largest" else min), most, 0
        self.subtrees: dict[int, dict[tuple[int, int], PatriciaTrie]] = {}
        self.sizes: dict[int, int] = {}

    def add(self, length: int, code: int, text: bytes, owner, n: int, member=None) -> None:
        tries = self.subtrees.setdefault(code & 255, {})
        trie = tries.setdefault((length, code), PatriciaTrie())
        before = trie.bytes
        node = trie.insert(text)
        if node[2] is None:
            node[2] = [owner, 0, []]
        payload = node[2]
        payload[0] = owner if payload[0] is None else payload[0] if owner is None else self.better(payload[0], owner)
        payload[1] += n
        payload[2].append(member)
        grown = trie.bytes - before + 100
        self.bytes += grown
        self.sizes[code & 255] = self.sizes.get(code & 255, 0) + grown

    def full(self) -> bool:
        return self.bytes > self.most

    def spill(self) -> Iterator[tuple]:
        """Give out and drop the largest subtree."""
        largest = max(self.sizes, key=self.sizes.get)
        self.bytes -= self.sizes.pop(largest)
        for (length, code), trie in self.subtrees.pop(largest).items():
            for text, payload in trie.terminals():
                yield length, code, text, payload

    def rest(self) -> Iterator[tuple]:
        while self.sizes:
            yield from self.spill()


_LOCAL = "doc_id long, text_sha256 string, length long, code long, owner long, owner_row string, n long, body binary"


def _split_owners(keep: str, most: int):
    schema = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("length", pa.int64()), ("code", pa.int64()), ("owner", pa.int64()),
                        ("owner_row", pa.string()), ("n", pa.int64()), ("body", pa.binary())])

    def emit(found: Iterator[tuple], split: list[str], serial: list[int]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for length, code, text, (owner, n, members) in found:
            serial[0] += 1
            name = f"{split[0]}:{serial[0]}"
            for k, (doc, sha) in enumerate(members):
                own = k == 0
                rows.append((doc, sha, length if own else None, code if own else None, owner if own else None, name, n if own else None, text if own else None))
            size += len(text) + 100 * len(members)
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        owners, split, serial = Owners(keep, most), [str(TaskContext.get().partitionId())], [0]
        for b in batches:
            for doc, text, length, code, sha in zip(*(b.column(c) for c in ("doc_id", "body", "length", "code", "text_sha256"))):
                owners.add(length.as_py(), code.as_py(), text.as_py(), doc.as_py(), 1, (doc.as_py(), sha.as_py()))
                while owners.full():
                    yield from emit(owners.spill(), split, serial)
        yield from emit(owners.rest(), split, serial)
    return run


def _merge_owners(keep: str):
    schema = pa.schema([("owner_row", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        current, owners = None, None

        def close():
            for _, _, _, (owner, n, members) in owners.rest():
                rows.extend((m, owner, n) for m in members)

        for b in batches:
            for length, code, text, owner, n, name in zip(*(b.column(c).to_pylist() for c in ("length", "code", "body", "owner", "n", "owner_row"))):
                if current != (length, code):
                    if owners:
                        close()
                    current, owners = (length, code), Owners(keep, TRIE_BYTES)
                owners.add(length, code, text, owner, n, name)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                rows.clear()
        if owners:
            close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    return run


def exact_dedup(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """Groups of documents whose texts are byte for byte equal.

    One row per input row: ``doc_id``, ``keep_id`` (the group's smallest or
    largest id, by ``keep``), ``group_size``, ``kept`` (this row's id is
    keep_id) and ``text_sha256``.  A null text counts as empty, so null and
    empty texts are one group.  A null id never wins against another id; a
    group of null ids only has a null keep_id and keeps nothing.  Rows that
    repeat an id are counted one by one (and kept alike).  Other columns are
    ignored, an empty table gives no rows.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), body.alias("body")).select(
        "doc_id", "body", F.octet_length("body").cast("long").alias("length"), F.xxhash64("body").alias("code"), F.sha2("body", 256).alias("text_sha256"))
    local = written(rows.mapInArrow(_split_owners(keep, trie_bytes), _LOCAL))
    merged = (local.where("length is not null").select("length", "code", "body", "owner", "n", "owner_row")
              .repartition("length", "code").sortWithinPartitions("length", "code")
              .mapInArrow(_merge_owners(keep), "owner_row string, keep_id long, group_size long"))
    return local.select("doc_id", "text_sha256", "owner_row").join(merged, "owner_row").select(
        "doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), "text_sha256")

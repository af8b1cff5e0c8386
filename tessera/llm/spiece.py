"""SentencePiece (BPE) encoding with source spans, and decoding.

A text is first normalised through the model's compiled character map by
longest prefix, which records for every normalised byte the source byte it
came from.  Pieces are then merged best score first, and every piece is
projected back to the bytes of the source.  No merge crosses a word mark,
so the merges are made once per distinct word of a batch, for all of them
at a time; a task keeps a bounded memory of words that it has seen.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.textnum import blocks, utf8

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # fixed values of the model format
NEVER = np.int32(2**31 - 1)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of every field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at:at + size]
        at += size


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 prefixes whose values
    point into a block of zero-ended replacements."""

    def __init__(self, blob: bytes) -> None:
        self.units, self.texts = np.zeros(0, np.uint32), b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units, self.texts = np.frombuffer(blob, "<u4", size // 4, 4), blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int]:
        """(replacement, source bytes) of the longest entry that begins at
        ``at``; the character itself where there is none."""
        units, best = self.units, None
        if len(units):
            def child(unit: int) -> int:
                return (unit >> 10) << ((unit & 512) >> 6)
            node = child(int(units[0]))
            for i in range(at, len(data)):
                node ^= data[i]
                unit = int(units[node])
                if unit & 0x800000FF != data[i]:
                    break
                node ^= child(unit)
                if unit >> 8 & 1:
                    best = (int(units[node]) & 0x7FFFFFFF, i + 1 - at)
        if best:
            return self.texts[best[0]:self.texts.index(b"\0", best[0])], best[1]
        first = data[at]
        n = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return data[at:at + n], n


class Model:
    """A BPE model read from the bytes of a model file."""

    def __init__(self, data: bytes) -> None:
        self.pieces: list[str] = []
        scores, kinds = [], []
        spec = {3: 1, 4: 1, 5: 1, 2: b""}  # of the normaliser: dummy prefix, extra spaces, escapes, map
        trainer = {3: 1, 35: 0, 24: 0}  # model type, byte fallback, mark as suffix
        for number, value in _fields(data):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for n, v in _fields(value):
                    if n == 1:
                        piece = v.decode()
                    elif n == 2:
                        (score,) = struct.unpack("<f", v)
                    elif n == 3:
                        kind = v
                self.pieces.append(piece)
                scores.append(score)
                kinds.append(kind)
            elif number in (2, 3):
                (trainer if number == 2 else spec).update(dict(_fields(value)))
        if trainer[3] != 2 or trainer[24] or not spec[5] or USER_DEFINED in kinds or UNUSED in kinds:
            raise ValueError("only BPE models with a word mark before words and without user-defined or unused pieces are read")
        self.dummy, self.squeeze, self.map = bool(spec[3]), bool(spec[4]), CharacterMap(spec[2])
        self.plain = not self.squeeze and not len(self.map.units)
        self.kinds = kinds
        self.unk = kinds.index(UNKNOWN)
        self.end = self.pieces.index("</s>") if "</s>" in self.pieces else None
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == BYTE} if trainer[35] else {}
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == NORMAL}
        # symbols: the normal pieces, and single characters that occur only inside longer pieces
        symbols = dict(self.ids)
        for p in self.ids:
            for c in p:
                symbols.setdefault(c, len(self.pieces) + len(symbols))
        self.symbols = symbols
        self.base = max(symbols.values(), default=0) + 2
        order = {s: r for r, s in enumerate(sorted(set(scores), reverse=True))}
        pairs = {}
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                a, b = symbols.get(p[:k]), symbols.get(p[k:])
                if a is not None and b is not None:
                    pairs[(a + 1) * self.base + b + 1] = (order[scores[i]], i)
        keys = np.array(sorted(pairs), np.int64)
        self.pair_keys = np.append(keys, np.int64(2**62))
        self.pair_rank = np.array([pairs[k][0] for k in keys.tolist()] + [NEVER], np.int32)
        self.pair_to = np.array([pairs[k][1] for k in keys.tolist()] + [-1], np.int32)
        self.pairs = pairs
        singles = sorted((ord(c), i) for c, i in symbols.items() if len(c) == 1)
        self.single_code = np.array([c for c, _ in singles] + [2**31 - 1], np.int64)
        self.single_id = np.array([i for _, i in singles] + [-1], np.int64)
        inner = {c for p in self.ids if len(p) > 1 for c in p}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            self.split = re.compile(r"(?s).+")  # a piece joins two words: texts are merged whole
        else:
            lone = "".join(map(re.escape, "".join(chr(c) for c in range(32) if chr(c) not in inner)))
            self.split = re.compile(f"{MARK}*[^{MARK}{lone}]+|{MARK}+|[{lone}]" if lone else f"{MARK}*[^{MARK}]+|{MARK}+")
        raw = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else p.replace(MARK, " ").encode() for p, k in zip(self.pieces, kinds)]
        self.raw = raw
        self.width = np.array([1 if k == BYTE else len(p.encode()) if k == NORMAL else 0 for p, k in zip(self.pieces, kinds)], np.int64)
        self.marks = np.array([p.count(MARK) if k == NORMAL else 0 for p, k in zip(self.pieces, kinds)], np.int64)

    # -- normalising -------------------------------------------------------
    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its bytes and its end, the
        source byte where what it came from begins (ends, for the end)."""
        data, out, source = text.encode(), [], []
        at, n = 0, len(data)
        last_space = self.squeeze
        parts = []
        while at < n:
            new, used = self.map.longest(data, at)
            parts.append((new, at))
            at += used
        if self.squeeze:  # leading, trailing and repeated spaces go
            kept = []
            for new, at in parts:
                if new == b"" or (new.strip(b" ") == b"" and last_space):
                    continue
                if last_space:
                    new = new.lstrip(b" ")
                new = re.sub(rb" +", b" ", new)
                kept.append((new, at))
                last_space = new.endswith(b" ")
            while kept and kept[-1][0].endswith(b" "):
                new, at = kept.pop()
                n = at
                if new[:-1].rstrip(b" "):
                    kept.append((new.rstrip(b" "), at))
            parts = kept
        if self.dummy and parts:
            out.append(MARK.encode())
            source += [parts[0][1]] * 3
        for new, at in parts:
            new = new.replace(b" ", MARK.encode())
            out.append(new)
            source += [at] * len(new)
        return b"".join(out).decode(), np.array([*source, n], np.int64)

    # -- merging -----------------------------------------------------------
    def _lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places in the pair table; the last place where there is no pair."""
        key = (a + 1) * self.base + b + 1
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[np.minimum(at, len(self.pair_keys) - 1)] == key, at, len(self.pair_keys) - 1)

    def merge_one(self, word: str) -> list[int]:
        """Ids of one word with a heap; the general way."""
        sym = [self.symbols.get(c, -1) for c in word]
        start, n = list(range(len(word))), len(word)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list = []

        def offer(i: int) -> None:
            j = nxt[i]
            if j < n and (hit := self.pairs.get((sym[i] + 1) * self.base + sym[j] + 1)):
                heapq.heappush(heap, (hit[0], i, sym[i], sym[j], hit[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, to = heapq.heappop(heap)
            j = nxt[i] if i < n else n
            if j >= n or sym[i] != a or sym[j] != b:
                continue
            sym[i], sym[j] = to, -2
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            offer(i)
            if prv[i] >= 0:
                offer(prv[i])
        out: list[int] = []
        i = 0
        while i < n:
            if 0 <= sym[i] < len(self.pieces):
                out.append(sym[i])
            elif self.bytes:
                out += [self.bytes[b] for b in word[start[i]:nxt[i]].encode()]
            else:
                out.append(self.unk)
            i = nxt[i]
        return out

    def merge_many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, count per word), all words merged a step at a time."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        length = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(length) - length
        place = np.searchsorted(self.single_code, codes)
        known = self.single_code[place] == codes
        sym_all = np.where(known, self.single_id[place], -1)
        odd = np.zeros(len(words), bool)  # with characters that aren't symbols, or long
        odd[np.repeat(np.arange(len(words)), length)[~known | (sym_all >= len(self.pieces))]] = True
        odd |= length > 64
        results: list = [None] * len(words)
        for w in np.flatnonzero(odd):
            results[w] = np.array(self.merge_one(words[w]), np.int64)
        for low, wide in ((0, 4), (4, 8), (8, 16), (16, 64)):
            which = np.flatnonzero(~odd & (length > low) & (length <= wide))
            for part in range(0, len(which), 50_000):
                rows = which[part:part + 50_000]
                flat, counts = self._merge_matrix(sym_all, begin[rows], length[rows], wide)
                ends = np.cumsum(counts)
                for w, a, b in zip(rows.tolist(), (ends - counts).tolist(), ends.tolist()):
                    results[w] = flat[a:b]
        counts = np.fromiter(map(len, results), np.int64, len(words))
        return np.concatenate(results) if results else np.zeros(0, np.int64), counts

    def _merge_matrix(self, codes: np.ndarray, begin: np.ndarray, length: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(begin)
        column = np.arange(wide)
        there = column < length[:, None]
        sym = np.where(there, codes[np.minimum(begin[:, None] + column, len(codes) - 1)], -2)
        nxt = np.tile(np.minimum(column + 1, wide), (n, 1))
        prv = np.tile(column - 1, (n, 1))
        rank = np.full((n, wide), NEVER, np.int32)
        to = np.full((n, wide), -1, np.int32)
        at = self._lookup(sym[:, :-1], sym[:, 1:])
        rank[:, :-1], to[:, :-1] = self.pair_rank[at], self.pair_to[at]
        active = np.arange(n)
        sym = np.concatenate([sym, np.full((n, 1), -2)], 1)  # what follows the last

        def renew(w: np.ndarray, i: np.ndarray) -> None:
            at = self._lookup(sym[w, i], sym[w, nxt[w, i]])
            rank[w, i], to[w, i] = self.pair_rank[at], self.pair_to[at]

        while len(active):
            best = rank[active].argmin(1)  # the leftmost of the best
            live = rank[active, best] != NEVER
            active, best = active[live], best[live]
            if not len(active):
                break
            right = nxt[active, best]
            sym[active, best] = to[active, best]
            sym[active, right] = -2
            rank[active, right] = NEVER
            after = nxt[active, right]
            nxt[active, best] = after
            more = after < wide
            prv[active[more], after[more]] = best[more]
            renew(active, best)
            before = prv[active, best]
            has = before >= 0
            renew(active[has], before[has])
        alive = sym[:, :wide] >= 0
        return sym[:, :wide][alive], alive.sum(1)

    # -- decoding ----------------------------------------------------------
    def decode(self, ids: list[int]) -> str:
        out, first = b"".join(map(self.raw.__getitem__, ids)), 0
        while first < len(ids) and self.kinds[ids[first]] == CONTROL:
            first += 1
        if first < len(ids) and (self.dummy or self.squeeze) and self.kinds[ids[first]] == NORMAL and self.pieces[ids[first]].startswith(MARK):
            out = out[1:]
        try:
            return out.decode()
        except UnicodeDecodeError:  # byte pieces that form no character: one replacement for each byte
            done, at = [], 0
            while at < len(out):
                try:
                    done.append(out[at:].decode())
                    break
                except UnicodeDecodeError as e:
                    done += [out[at:at + e.start].decode(), "�"]
                    at += e.start + 1
            return "".join(done)


class _Places(dict):
    """Word -> its place; a new word gets the next one and is noted."""

    def __init__(self, *known) -> None:
        super().__init__(*known)
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self)
        self.new.append(word)
        return place


class WordMemory:
    """Ids of the words that a task has seen, in flat arrays.  Beyond
    ``most`` words it keeps the half that came first, which holds the most
    frequent ones."""

    def __init__(self, model: Model, most: int = 150_000) -> None:
        self.model, self.most, self.place = model, most, _Places()
        self.flat, self.begin, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _forget(self) -> None:
        half = self.most // 2
        self.place = _Places(islice(self.place.items(), half))
        self.flat, self.begin, self.count = self.flat[:self.begin[half]].copy(), self.begin[:half].copy(), self.count[:half].copy()

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, count per word)."""
        if len(self.place) > self.most:
            self._forget()
        where = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        if self.place.new:
            flat, counts = self.model.merge_many(self.place.new)
            self.place.new = []
            self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(counts) - counts])
            self.flat, self.count = np.concatenate([self.flat, flat]), np.concatenate([self.count, counts])
        counts = self.count[where]
        total = np.cumsum(counts)
        return self.flat[np.repeat(self.begin[where] - total + counts, counts) + np.arange(total[-1] if len(total) else 0)], counts


def encode_texts(model: Model, memory: WordMemory, texts: list[str], end: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat ids, flat source ends, ids per text) of a few texts."""
    words: list[str] = []
    per_text = np.zeros(len(texts), np.int64)
    source: dict[int, np.ndarray] = {}
    for k, text in enumerate(texts):
        if not text:
            continue
        if model.plain and MARK not in text:
            text = (MARK if model.dummy else "") + text.replace(" ", MARK)
        else:
            text, source[k] = model.normalise(text)
        before = len(words)
        words += model.split.findall(text)
        per_text[k] = len(words) - before
    flat, counts = memory.ids(words)
    ends = np.cumsum(counts)
    cut = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)])]  # ids before each text
    width = model.width[flat]
    plain = np.cumsum(width - 2 * model.marks[flat])  # a mark's three bytes were one space
    extra = int(end and model.end is not None)
    size = np.diff(cut) + extra
    ids, spans = np.empty(size.sum(), np.int32), np.empty(size.sum(), np.int32)
    at = 0
    for k in range(len(texts)):
        a, b = cut[k], cut[k + 1]
        m = b - a
        ids[at:at + m] = flat[a:b]
        last = 0
        if m:
            if k in source:
                spans[at:at + m] = source[k][np.cumsum(width[a:b])]
            else:
                spans[at:at + m] = plain[a:b] - (plain[a - 1] if a else 0) - int(model.dummy)
            last = spans[at + m - 1]
        if extra:
            ids[at + m], spans[at + m] = model.end, last
        at += m + extra
    return ids, spans, size


_models: dict[bytes, Model] = {}


def _model(data: bytes) -> Model:
    if data not in _models:
        _models[data] = Model(data)
    return _models[data]


def encode(docs: DataFrame, model: bytes, end: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and source spans of every text.

    One row per input row: ``doc_id``, ``ids`` (array of int) and ``ends``
    (array of int, as long: the source byte where each piece ends; piece i
    covers the bytes from the end of piece i-1).  ``model`` is the content of
    a model file.  A null text counts as empty, which has the end id only.
    Ids may repeat or be null.  Other columns are ignored.
    """
    data = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _model(data.value)
        memory = WordMemory(own)
        for batch in batches:
            buf, offsets = utf8(batch.column("text"))
            raw = memoryview(buf)
            for i, j in blocks(offsets):
                texts = [str(raw[a:b], "utf-8") for a, b in zip(offsets[i:j].tolist(), offsets[i + 1:j + 1].tolist())]
                ids, spans, size = encode_texts(own, memory, texts, end)
                bounds = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[i:j], pa.ListArray.from_arrays(bounds, pa.array(ids)), pa.ListArray.from_arrays(bounds, pa.array(spans))], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, ends array<int>")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """The input's ``doc_id`` and ``ids`` with the decoded ``text``: marks
    become spaces, the first one goes, byte pieces become their characters,
    an unknown piece gives `` ⁇ `` and control pieces nothing.  Null ids count
    as none."""
    data = encoded.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _model(data.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                ids = part.column("ids")
                texts = [own.decode(x.values.to_numpy(zero_copy_only=False).tolist() if x.is_valid else []) for x in ids]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids.cast(schema.field("ids").type), pa.array(texts, pa.string())], schema=schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def token_digests(docs: DataFrame, model: bytes, with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text (and
    ``ids``)."""
    both = decode(encode(docs, model), model)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"), *(["ids"] if with_ids else []))

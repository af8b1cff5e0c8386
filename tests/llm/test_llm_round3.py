"""Whitening, tokenizer alignment and decontamination against brute force."""
import collections
import hashlib
import re
import string

import numpy as np
import pyarrow.parquet as pq
import public_tokenizers
import pytest

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
CLASHES = ["n", "row", "code", "x", "a", "b", "items", "runs", "sha", "total", "i", "j", "place", "dims", "best", "component"]


def with_clashes(rows, names, kinds):
    schema = T.StructType([*(T.StructField(c, k) for c, k in zip(names, kinds)), *(T.StructField(c, T.StringType()) for c in CLASHES)])
    return [(*r, *([None if k % 2 else "z"] * len(CLASHES))) for k, r in enumerate(rows)], schema


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, [(x is None, str(x)) for x in r[1:]]))


# -- whitening ------------------------------------------------------------------
def numpy_whitened(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100000
    n, total = len(x), x.sum(0)
    y = x - x.mean(0)
    value, vector = np.linalg.eigh(y.T @ y / n)
    value, vector = value[::-1], vector[:, ::-1]
    return y @ vector[:, :k] / np.sqrt(value[:k]), value[:k] / value.sum(), ((n * x - total) ** 2).sum(1)


@pytest.mark.parametrize("parts", [1, 7])
def test_whitening_equals_numpy(spark, parts):
    from tessera.llm.whitening import whiten
    table = pq.read_table(f"{SF}/embeddings.parquet").sort_by("vec_id")
    want, explained, deviation = numpy_whitened(table["embedding"].to_pylist())
    got = whiten(spark.read.parquet(f"{SF}/embeddings.parquet").repartition(parts)).toPandas().sort_values(["vec_id", "component"])
    mine = got.whitened.to_numpy().reshape(want.shape)
    assert np.abs(mine - want * np.sign((mine * want).sum(0))).max() < 1e-9
    assert np.allclose(got.explained.to_numpy().reshape(want.shape), explained, rtol=1e-9)
    assert [int(v) for v in got.deviation[::8]] == deviation.tolist()
    assert got.identity_error.max() < 1e-9 and set(got.n) == {len(want)} and got.component.tolist() == list(range(1, 9)) * len(want)


def test_whitening_edges(spark):
    from tessera.llm.whitening import whiten
    kinds = [T.LongType(), T.ArrayType(T.FloatType())]
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25, -1.0]), (2, [1.5, 0.0, 2.0]), (2, [1.5, 0.0, 2.0]), (None, [0.0, 1.0, 0.0]), (3, None), (4, [1.0, None, 2.0]), (5, [nan, 0.0, 0.0]), (6, [inf, 1.0, 1.0]),
            (7, []), (8, [1.0, 2.0]), (9, [0.1] * 20_000)]
    data, schema = with_clashes(rows, ["vec_id", "embedding"], kinds)
    table = spark.createDataFrame(data, schema).repartition(3)
    got = whiten(table).collect()
    assert sorted(str(r.vec_id) for r in got) == sorted(["1", "2", "2", "None"] * 3) and {r.n for r in got} == {4}
    want, explained, deviation = numpy_whitened([[0.5, 0.25, -1.0], [1.5, 0.0, 2.0], [1.5, 0.0, 2.0], [0.0, 1.0, 0.0]], 3)
    by = {(r.vec_id, r.component): r for r in got}
    assert int(by[1, 1].deviation) == deviation[0] and abs(by[1, 1].explained - explained[0]) < 1e-9
    assert abs(abs(by[None, 2].whitened) - abs(want[3, 1])) < 1e-9
    # three distinct points span a plane: the third component has no variance
    assert all(by[i, 3].whitened == 0 and by[i, 3].explained == 0 for i in (1, 2, None)) and got[0].identity_error < 1e-9
    assert whiten(table.limit(0)).collect() == [] and whiten(table.where("vec_id = 3")).collect() == []
    one = whiten(table.where("vec_id = 1")).collect()
    assert len(one) == 3 and all(r.whitened == 0 and r.deviation == 0 for r in one)
    huge = whiten(spark.createDataFrame([(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<float>")).collect()
    assert len(huge) == 6 and all(np.isfinite(r.whitened) for r in huge) and huge[0].identity_error < 1e-4


def test_eigenvectors_of_clusters():
    from tessera.llm.whitening import eigenvectors, exact_products
    q = np.linalg.qr(np.random.default_rng(1).normal(size=(40, 40)))[0]
    for values in (np.r_[np.ones(5), 1 + 1e-9 * np.arange(5), 2 * np.ones(10), np.arange(3, 23)], np.r_[np.linspace(1, 1 + 1e-6, 20), np.linspace(5, 5 + 1e-12, 20)],
                   np.r_[1e6, 1e-8 * np.arange(1, 40)]):
        a = (q * values) @ q.T
        a = (a + a.T) / 2
        value, x = eigenvectors(a)
        assert np.abs(x.T @ x - np.eye(40)).max() < 1e-17
        assert np.abs(a.astype(np.longdouble) @ x - x * value).max() < 1e-17 * np.abs(a).max() * 40
    x = np.array([[2.0**40, 3.0], [-(2.0**40), 1.0]])
    assert exact_products(x).tolist() == [[2**81, 2 * 2**40], [2 * 2**40, 10]]


# -- alignment ------------------------------------------------------------------
@pytest.fixture(scope="module")
def files():
    return [open(public_tokenizers.path(n), "rb").read() for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def aligned_by_hand(texts, files):
    from tessera.llm.alignment import Vocabularies
    both = Vocabularies(*files)
    a_bytes, b_bytes = both.a_bytes.to_pylist(), both.b_bytes.to_pylist()
    parts, counts = [], collections.Counter()
    for t in texts:
        want = (" " + (t or "")).encode()
        a, b = both.a.encode(" " + (t or ""), add_special_tokens=False).ids, both.b.encode(t or "")
        if not t or b"".join(a_bytes[i] for i in a) != want or b"".join(b_bytes[i] for i in b) != want:
            parts.append(None)
            continue
        i, j, a_end, b_end, pairs, groups, own = 0, 0, len(a_bytes[a[0]]), len(b_bytes[b[0]]), [], [], ([a[0]], [b[0]])
        while True:
            pairs.append((a[i], b[j]))
            both_end = a_end == b_end
            if both_end:
                groups.append(own)
                own = ([], [])
                if a_end == len(want):
                    break
            step_a, step_b = a_end <= b_end, b_end <= a_end
            if step_a:
                i += 1
                own[0].append(a[i])
            if step_b:
                j += 1
                own[1].append(b[j])
            a_end, b_end = a_end + step_a * len(a_bytes[a[i]]), b_end + step_b * len(b_bytes[b[j]])
        counts.update(pairs)
        parts.append((len(a), len(b), groups, pairs))
    best = collections.Counter()
    for (_, y), c in counts.items():
        best[y] = max(best[y], c)
    out = []
    for p in parts:
        if p is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in p[2])
        out.append((p[0], p[1], len(p[2]), len(p[3]), sum(counts[q] == best[q[1]] for q in p[3]), sum(counts[q] for q in p[3]), hashlib.sha256(text.encode()).hexdigest()))
    return out


ODD = [(1, None), (2, ""), (3, " "), (4, "  two  spaces \n\n\t"), (5, "<|endoftext|> </s> <s> <0x41> <unk>"), (6, "▁ kept apart ▁"), (7, "日本語 😀 é ß \x00 \x7f"), (8, "x" * 100_000),
       (9, " ".join(f"w{i % 97}" for i in range(30_000))), (9, "another text of the same id"), (None, "no id"), (9, "another text of the same id"), (10, " 　​")]


@pytest.mark.parametrize("frequent", [1 << 20, 300, 0])
def test_alignment_equals_walk(spark, files, frequent):
    from tessera.llm.alignment import align
    table = pq.read_table(f"{SF}/documents.parquet")
    rows = ODD + list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))
    data, schema = with_clashes(rows, ["doc_id", "text"], [T.LongType(), T.StringType()])
    got = align(spark.createDataFrame(data, schema).repartition(3), *files, frequent=frequent).collect()
    assert order(map(tuple, got)) == order((i, *w) for (i, _), w in zip(rows, aligned_by_hand([t for _, t in rows], files)))
    if not frequent:
        assert align(spark.createDataFrame([], schema), *files).collect() == []


# -- decontamination --------------------------------------------------------------
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def hits_by_hand(docs, bench):
    words = lambda t: WORD.findall((t or "").translate(LOWER))
    windows = {}
    for item, text in bench:
        w = words(text)
        k = min(10, len(w))
        for s in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[s:s + k]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, items = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for s in range(len(w) - k + 1):
                if (found := windows.get(tuple(w[s:s + k]))) is not None:
                    hit.update(range(s, s + k))
                    items |= found
        ids = sorted(str(i) for i in items if i is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


LONG_ITEM = " ".join(f"item{i % 7001}" for i in range(9000))
BENCH = [(100, "a"), (101, "The thin"), (None, "es the"), (102, None), (103, ""), (100, "of"), (104, "... !!"), (105, "é"), (106, "ñas 日本"), (107, "a b c a b c a b c a b c"), (108, LONG_ITEM), (108, LONG_ITEM)]
DOCS = [(1, "a a a"), (1, "x"), (None, "ñas 日本, the"), (7, None), (8, ""), (9, "A"), (10, "a b c a b c a b c a b c a b c"), (11, " a"), (12, "b c a"), (13, "é" * 5 + " é"),
        (10, "a b c a b c a b c a b c a b c"), (14, "Z" * 200_000), (15, ".".join(f"ITEM{i % 7001}" for i in range(4085, 4110))), (16, "es"), (17, "the"), (18, "start " + LONG_ITEM)]


@pytest.mark.parametrize("shard_bytes", [8 << 20, 2000])
def test_decontamination_equals_sets(spark, shard_bytes):
    from tessera.llm.decontamination import decontaminate
    tables = [list(zip(*(c.to_pylist() for c in pq.read_table(f"{SF}/{n}.parquet").select([k, "text"]).columns))) for n, k in (("documents", "doc_id"), ("benchmark", "item_id"))]
    docs, bench = DOCS + tables[0], tables[1] + (BENCH[:10] if shard_bytes < 8 << 20 else BENCH)
    d, b = (spark.createDataFrame(*with_clashes(rows, [key, "text"], [T.LongType(), T.StringType()])).repartition(3) for rows, key in ((docs, "doc_id"), (bench, "item_id")))
    got = decontaminate(d, b, shard_bytes=shard_bytes)
    assert order(map(tuple, got.drop("items").collect())) == order(hits_by_hand(docs, bench))
    if shard_bytes > 2000:
        assert not any(r.contaminated for r in decontaminate(d, b.limit(0)).collect()) and decontaminate(d.limit(0), b).count() == 0


def test_search_finds_every_place():
    """Few letters, so blocks repeat and shifts are short; every length class."""
    import pyarrow as pa
    from tessera.llm.decontamination import Patterns, plain
    rng = np.random.default_rng(5)
    say = lambda n: " ".join("".join(rng.choice(list("ab"), rng.integers(1, 4))) for _ in range(n))
    for window in (1, 2, 5, 12):
        items, texts = [say(int(rng.integers(1, 30))) for _ in range(30)], [say(int(rng.integers(0, 400))) for _ in range(20)]
        own = Patterns([str(i) for i in range(30)], pa.array([f" {t} ".encode() for t in items], pa.binary()), window)
        raw = [t.encode() for t in texts]
        form, bounds = plain(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
        assert [form[a:b].tobytes() for a, b in zip(bounds, bounds[1:])] == [f" {t} ".encode() if t else b" " for t in texts]
        whole, names = form.tobytes(), [own.form[p:p + s].tobytes() for p, s in zip(own.place, own.size)]
        want = {(m.start(), n) for n, name in enumerate(names) for m in re.finditer(b"(?=" + re.escape(name) + b")", whole)}
        assert set(zip(*(x.tolist() for x in own.find(form)))) == want


# -- links in cells ---------------------------------------------------------------
def test_links_of_many_parts(spark, monkeypatch):
    """A key with more ids than a part holds: all links found, each pair of parts in its own cell."""
    from pyspark.sql import functions as F
    from tessera.llm import components as C, near_dedup as N
    rng = np.random.default_rng(4)
    sets = [np.sort(rng.choice(60, int(rng.integers(5, 40)), replace=False)).astype(np.int64) * 1_000_003 for _ in range(120)]
    rows = [(k, i, i, len(s), s.tolist(), parts) for k, parts in ((1, 5), (2, 1)) for i, s in enumerate(sets) if k == 1 or i % 3 == 0]
    rest = spark.createDataFrame(rows, "key long, id long, comp long, n long, shingles array<long>, parts int")
    want = {(a, b) for a in range(120) for b in range(a + 1, 120) if 100 * len(set(sets[a]) & set(sets[b])) >= 50 * len(set(sets[a]) | set(sets[b]))}
    assert {tuple(r) for r in N._links_of_cells(rest, 50).collect()} == want
    monkeypatch.setattr(N, "COLUMNS", 7)
    flat, size = np.concatenate(sets), np.array([len(s) for s in sets])
    common = N.shared_counts(flat, size)
    assert all(common[a, b] == len(set(sets[a]) & set(sets[b])) for a in range(120) for b in range(120) if a != b)
    pairs = C.crossed(rest.where("key = 1"), lambda a, b: F.col(f"id{a}") < F.col(f"id{b}"))
    assert pairs.count() == 120 * 119 // 2


# -- toxicity on the given labels ---------------------------------------------------
def test_toxicity_of_held_out_documents(spark, sf="sf0.1", least=0.8, most=0.01):
    """Held-out recall at least, and share of clean documents flagged at most."""
    from tessera.llm.toxicity import toxicity
    read = lambda t: spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet")
    labels = read("labels")
    got = toxicity(read("documents").join(labels.select("doc_id"), "doc_id", "left_semi"), labels).join(labels, "doc_id").where("held_out").select("toxic", "predicted").collect()
    toxic, clean = ([r.predicted for r in got if r.toxic == c] for c in (1, 0))
    assert sum(toxic) >= least * len(toxic) and sum(clean) <= most * len(clean)


# -- repeated strings of rows that share an id ---------------------------------------
def test_substrings_of_shared_and_missing_ids(spark):
    from tessera.llm.substring_dedup import substring_dedup
    rng = np.random.default_rng(9)
    say = lambda n: "".join(rng.choice(list("abcdefgh ijé"), n))
    passage, other = say(589), say(450)
    rows = [(1, say(700)), (1, say(300) + passage + say(50)), (2, say(80) + passage + say(400)), (None, other + say(500)), (3, say(30) + other), (None, say(20) + other + "z"),
            (4, "same" * 200), (4, "same" * 200), (None, None), (5, ""), (None, "whole " * 100), (6, "whole " * 100), (7, "short"), (7, "short")]
    got = order(tuple(r) for r in substring_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    bodies = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(b[i:i + 400] for b in bodies for i in range(len(b) - 399))
    want = []
    for (doc, _), b in zip(rows, bodies):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 399):
            if seen[b[i:i + 400]] > 1:
                gone[i:i + 400] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(b) else 0
        want.append((doc, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    assert got == order(want)


# -- size of plans --------------------------------------------------------------------
def test_line_plans_stay_small(spark):
    """The driver plans a query anew after each stage: no plan may chain all steps."""
    from tessera.llm.line_dedup import keyed, line_decisions, line_dedup
    line = "a line of some thirty bytes, number "
    docs = spark.createDataFrame([(1, f"{line}1\n{line}1\nown"), (2, f"{line}2\nmine"), (3, f"{line}2\nmine")], "doc_id long, text string")
    units = keyed(docs).where("doc_id > 1").selectExpr("place", "digest", "2L as unit")
    for out, most in ((line_dedup(docs, units), 3), (line_decisions(docs, units), 3)):
        assert out._jdf.queryExecution().analyzed().toString().count("Join ") <= most
    assert [tuple(r) for r in line_dedup(docs, units).orderBy("doc_id").collect()] == [(1, f"{line}1\nown"), (2, "mine"), (3, "mine")]

"""The stages of the corpus pipeline, each against plain Python on its own input."""
import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def steps(spark):
    """Rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(P.STAGES):
        out.append(P.written(stage(spark, out[-1], SF)))
        assert k == len(P.STAGES) - 1 or out[-1].columns == docs.columns
    return [df.collect() for df in out]


def test_names_and_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "line dedup", "near-dedup", "mixing", "sentencepiece"] and P.ORACLE_SQL is None


def test_toxicity_only_drops(steps):
    assert set(steps[1]) <= set(steps[0]) and len(steps[1]) > 0.7 * len(steps[0])


def near_classes(rows):
    """doc_id of the first near copy (five words, 0.8) of every document, by brute force."""
    sets = {}
    for r in rows:
        w = WORDS.findall((r.text or "").translate({i: i + 32 for i in range(65, 91)}))
        sets[r.doc_id] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def test_lines(steps):
    """Brute force over all documents: the lines left are the first of their
    classes, whatever share of a document that cuts; near copies stand at the
    place of their first document; texts that lose every line go."""
    from tessera.llm.line_dedup import _SPACE, edit_distance_within, threshold
    blank, unit = bytes(b for b in range(256) if _SPACE[b]), near_classes(steps[1])
    lines = [(unit[r.doc_id], r.doc_id, x.strip(blank)) for r in sorted(steps[1], key=lambda r: r.doc_id) for x in (r.text or "").encode().split(b"\n")]
    distinct = sorted({x for *_, x in lines if x}, key=len)
    parent = list(range(len(distinct)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    limit = threshold(np.array([len(x) for x in distinct])).tolist()
    for a, x in enumerate(distinct):
        for b in range(a + 1, len(distinct)):
            if len(distinct[b]) - len(x) > limit[a]:
                break
            if edit_distance_within(x, distinct[b], limit[a]):
                parent[find(b)] = find(a)
    place = {x: k for k, x in enumerate(distinct)}
    first, here, want = {}, set(), defaultdict(list)
    for u, _, x in lines:
        if x:
            c = find(place[x])
            first[c] = min(first.get(c, u), u)
    for u, i, x in lines:
        if x and first[find(place[x])] == u and (i, find(place[x])) not in here:
            here.add((i, find(place[x])))
            want[i].append(x)
    words = {i for _, i, x in lines if x}
    got = {r.doc_id: [x.strip(blank) for x in (r.text or "").encode().split(b"\n")] for r in steps[2]}
    assert sum(len(v) for v in want.values()) < len(lines)
    assert {i: [x for x in v if x] for i, v in got.items()} == {r.doc_id: want[r.doc_id] for r in steps[1] if want[r.doc_id] or r.doc_id not in words}
    assert all(r.n_chars == len(r.text) for r in steps[2] if r.text is not None)


def test_copies_of_the_raw_table_go(steps):
    """Exact and near copies, found by brute force before any line is cut, are
    gone after the near-dedup stage, and no document is left without words by it."""
    unit, left = near_classes(steps[1]), {r.doc_id: r.text for r in steps[3]}
    copies = {i for i, u in unit.items() if i != u}
    assert copies and len(copies - set(left)) >= 0.9 * len(copies)
    had = {r.doc_id for r in steps[1] if WORDS.search(r.text or "")}
    assert all(WORDS.search(t) for i, t in left.items() if i in had)


def test_stages_of_odd_rows(spark):
    """Nulls in every column, clashing and repeated rows and ids, and empty tables."""
    kinds = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, unit string, comp long"
    long = " ".join(f"w{i % 5003}" for i in range(20_000))
    rows = [(1, "one two three four five six\nshared line here", None, None, None), (None, "no id at all\nshared line here", "x", "s", 3), (2, None, None, "s", None), (2, "", None, "s", 0),
            (3, long, "y", None, 1), (4, long + " end", "y", "t", 1), (5, "same id", None, "s", 7), (5, "another text", None, "s", 7), (5, "another text", None, "s", 7), (None, None, None, None, None)]
    docs = spark.createDataFrame([(*r, "z", None, "u", 1) for r in rows], kinds).repartition(3)
    for table, most in ((docs, len(rows)), (docs.limit(0), 0)):
        out = table
        for name, stage in P.STAGES[1:]:
            out = P.written(stage(spark, out, SF))
            assert name == "sentencepiece" or out.columns == table.columns
            if name == "near-dedup":
                found = [(r.doc_id, r.text) for r in out.collect()]
                assert len(found) == (most and most - 1) and (not most or (4, long + " end") not in found and (None, "no id at all") in [(i, (t or "").split("\n")[0]) for i, t in found])


def test_near_copies(steps):
    assert {r.doc_id for r in steps[3]} == {i for i, u in near_classes(steps[2]).items() if i == u}


def test_mix(steps):
    size, weight = defaultdict(int), {}
    words = {r.doc_id: len(WORDS.findall(r.text)) for r in steps[3]}
    for r in steps[3]:
        size[r.source] += words[r.doc_id]
    for k, s in enumerate(sorted(size, key=lambda s: (s is None, s or ""))):
        weight[s] = 1 + k % 3
    target, free = {}, set(size)
    while True:
        left = sum(size.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * size[s]}
        if not over:
            target |= share
            break
        target |= {s: 3 * size[s] for s in over}
        free -= over
    copies = Counter(r.doc_id for r in steps[4])
    for r in steps[3]:
        rate = target[r.source] / size[r.source] if size[r.source] else 0
        u = int(hashlib.md5(f"{P.SEED}:{r.doc_id}".encode()).hexdigest()[:8], 16) / 2**32
        assert copies[r.doc_id] == math.floor(rate) + (u < rate - math.floor(rate))


def test_tokens(steps):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in steps[4]}
    assert Counter(r.doc_id for r in steps[5]) == Counter(r.doc_id for r in steps[4])
    for r in steps[5]:
        want = sp.encode(texts[r.doc_id], add_eos=True)
        assert r.ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(want).encode()).hexdigest()

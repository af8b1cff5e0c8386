"""Operators against brute force on small inputs, and their inner parts alone."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from pyspark.sql import functions as F

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def lowered(text):
    return text.translate({i: i + 32 for i in range(65, 91)})


@pytest.fixture(scope="module")
def corpus(spark):
    """Texts with groups of near copies, copies, shared lines and junk."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))

    def changed(t, share):
        return " ".join(rng.choice(vocabulary) if rng.random() < share else w for w in t.split(" "))

    texts = []
    for _ in range(4):
        base = text(120)
        texts += [base] + [changed(base, rng.choice([0.005, 0.01, 0.02, 0.05])) for _ in range(25)]
    shared = text(40)
    texts += [f"{text(30)}\n{shared}\n{text(20)}" for _ in range(12)] + [text(rng.randint(1, 60)) for _ in range(40)]
    texts += [texts[3], texts[3], "a b c a b c a b c a b c", "# $ x\nx\nx\n | y"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return dict(rows), spark.createDataFrame(rows, "doc_id long, text string").repartition(4).cache()


def classes(ids, linked):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_dedup_equals_all_pairs(corpus, k, percent):
    from tessera.llm.near_dedup import near_dedup
    texts, docs = corpus
    sets = {}
    for i, t in texts.items():
        w = WORDS.findall(lowered(t))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = classes(sets, links)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup(docs, k, percent).collect()}
    assert got == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}


def test_near_signatures_within_the_distance_share_a_key():
    from tessera.llm import near_dedup as N
    rng = np.random.RandomState(1)
    one = rng.randint(0, 1 << N.BITS, (50, N.SYMBOLS)).astype(np.uint64)
    two = one.copy()
    for r in two:
        r[rng.choice(N.SYMBOLS, N.DISTANCE, replace=False)] ^= np.uint64(1)
    assert all(set(a) & set(b) for a, b in zip(N._keys(one).tolist(), N._keys(two).tolist()))


def test_components_of_paths_and_stars(spark):
    from tessera.llm.components import components
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (205, 203), (203, 204), (204, 205)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}, 204: 203, 205: 203}


def test_bloom_cascade_is_exact(spark):
    from tessera.llm.url_filter import bloom_cascade, in_cascade
    keys = spark.range(4000).select(F.concat(F.lit("host-"), "id").alias("key"), (F.pmod(F.xxhash64("id"), F.lit(10)) < 3).alias("listed"))
    levels = bloom_cascade(keys)
    assert len(levels) > 1
    assert keys.where(in_cascade(F.col("key"), levels) != F.col("listed")).isEmpty()


def test_mixing_targets_and_reruns(spark):
    from tessera.llm.mixing import capped_targets, mix_sources
    rows = [(i, f"s{i % 7}" if i % 11 else None, "w " * (1 + i % (5 + i % 7))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mix_sources(docs, [1, 2, 3], 3.0, 1).collect()
    assert sorted(got) == sorted(mix_sources(docs.repartition(7), [1, 2, 3], 3.0, 1).collect())
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) < 0.15 * own[0].target
    sizes = [("a", 10, 1), ("b", 1000, 2), ("c", 5, 3), ("d", 300, 1)]
    t = {r.source: r.target for r in capped_targets(spark.createDataFrame(sizes, "source string, source_size long, weight long"), 3.0).collect()}
    left = 1315 - 30 - 15
    assert t == pytest.approx({"a": 30.0, "c": 15.0, "b": left * 2 / 3, "d": left / 3})


def test_patricia_trie():
    from tessera.llm.exact_dedup import PatriciaTrie
    rng = random.Random(2)
    keys = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(500)]
    trie = PatriciaTrie()
    for k in keys:
        node = trie.insert(k)
        node[2] = (node[2] or 0) + 1
    assert dict(trie.terminals()) == Counter(keys)


def test_quality_counts(corpus):
    from tessera.llm.quality import quality_rules
    texts, docs = corpus
    got = {r.doc_id: r for r in quality_rules(docs, docs.where("doc_id < 60").select("doc_id"), least_score=-9.0).collect()}
    for i, t in texts.items():
        w = WORDS.findall(t)
        lines = [x for x in t.split("\n") if WORDS.search(x)]
        tri = [tuple(w[j:j + 3]) for j in range(len(w) - 2)]
        times = Counter(tri)
        covered = {j + d for j, x in enumerate(tri) if times[x] > 1 for d in range(3)}
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and r.kept == (not r.base_failed)


def test_hmm_recursion_and_training(corpus):
    from tessera.llm import hmm as H
    from tessera.llm.textnum import utf8
    texts, docs = corpus
    some = [texts[i] for i in sorted(texts)[:30]] + [""]
    _, kind, bounds = H.tokens(*utf8(pa.array(some)))
    share = (np.bincount(kind, minlength=H.CLASSES) + 0.5) / (len(kind) + 0.5 * H.CLASSES)
    chain, before = H.Chain.first(share, 3, 1), -math.inf
    for _ in range(4):
        got = H.log_likelihood(chain, kind, bounds)
        for a, b, total in zip(bounds[:-1], bounds[1:], got):
            state, want = chain.q, 0.0
            for c in kind[a:b]:
                state = (state @ chain.a) * chain.b[:, c]
                want += math.log(state.sum())
                state = state / state.sum()
            assert total == pytest.approx(want)
        assert got.sum() > before
        before = got.sum() - 1e-6 * abs(got.sum())
        q, a, b = H.expected_counts(chain, kind, bounds)
        assert b.sum() == pytest.approx(len(kind)) and a.sum() == pytest.approx(len(kind))
        chain = H.Chain(q / q.sum(), a / a.sum(1, keepdims=True), b / b.sum(1, keepdims=True) * (1 - 1e-6) + 1e-6 * share)


@pytest.mark.parametrize("frequent", [1 << 20, 20, 0])
def test_hmm_base_score(corpus, frequent):
    from tessera.llm.hmm import hmm_scores
    texts, docs = corpus
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    tok = {i: [*WORDS.findall(lowered(t)), "\n"] for i, t in texts.items()}
    c = Counter(w for i in tok if not held[i] for w in tok[i])
    n, v = sum(c.values()), len(c)
    for r in hmm_scores(docs, states=2, rounds=1, frequent=frequent).collect():
        want = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tok[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(tok[r.doc_id]), sum(c[w] > 0 for w in tok[r.doc_id]), n)
        assert r.base_score == pytest.approx(want) and r.score < 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, line, n, letters):
    out = bytearray(line)
    for _ in range(n):
        k, way = rng.randrange(len(out) + 1), rng.random()
        if way < 0.34:
            out.insert(k, rng.choice(letters))
        elif out and way < 0.67:
            del out[min(k, len(out) - 1)]
        elif out:
            out[min(k, len(out) - 1)] = rng.choice(letters)
    return bytes(out)


def test_banded_edit_distance():
    from tessera.llm.line_dedup import edit_distance_within
    rng = random.Random(3)
    for _ in range(5000):
        a = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9)))
        b = edited(rng, a, rng.randint(0, 4), b"abc")
        assert all(edit_distance_within(a, b, t) == (distance(a, b) <= t) for t in range(4))


def test_line_classes_equal_all_pairs(spark):
    from tessera.llm.line_dedup import line_decisions, threshold
    rng = random.Random(4)
    base = [bytes(rng.choice(b"abcdefgh ") for _ in range(rng.choice([5, 23, 24, 30, 47, 48, 60, 90]))) for _ in range(25)]
    lines = [edited(rng, rng.choice(base), rng.randint(0, 4), b"xyz ") for _ in range(400)]
    docs = [(i, b"\n".join(rng.choice(lines) for _ in range(rng.randint(0, 9))).decode()) for i in range(80)]
    all_lines = [(i, k, x.strip()) for i, t in docs for k, x in enumerate(t.encode().split(b"\n")) if x.strip()]
    distinct = sorted({x for _, _, x in all_lines})
    links = [(a, b) for a in range(len(distinct)) for b in range(a + 1, len(distinct))
             if abs(len(distinct[a]) - len(distinct[b])) <= 2
             and distance(distinct[a], distinct[b]) <= int(threshold(np.array([min(len(distinct[a]), len(distinct[b]))]))[0])]
    root = classes(range(len(distinct)), links)
    seen, want = set(), defaultdict(list)
    for i, k, x in sorted(all_lines):
        c = root[distinct.index(x)]
        if c in seen:
            want[i].append(k)
        seen.add(c)
    got = {r.doc_id: r.dropped for r in line_decisions(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert got == {i: want[i] for i, _ in docs}


def test_shared_keys_over_batch_edges():
    from tessera.llm.line_dedup import _shared_rows
    rng = random.Random(14)
    for turn in range(300):
        rows = [(rng.randint(-2, 2), rng.randint(0, 3), rng.randint(1, 3)) for _ in range(rng.randint(0, 14))]
        want = {}
        for k, i, kind in rows:
            if len({i for key, i, _ in rows if key == k}) > 1:
                want[k, i] = want.get((k, i), 0) | kind
        sent = sorted(((k << 2 | kind, i) for k, i, kind in rows), key=lambda r: (r[0], rng.random()))
        for size in (1, 2, 3, 20):
            batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*sent[a:a + size])], names=["key", "id"]) for a in range(0, len(sent), size)]
            got = {}
            for k, i, kind in (tuple(r.values()) for b in _shared_rows(iter(batches)) for r in b.to_pylist()):
                got[k, i] = got.get((k, i), 0) | kind
            assert got == want


def test_toxicity_gradients():
    from tessera.llm import toxicity as X
    from tessera.llm.textnum import utf8
    net = {k: v.astype(np.float64) for k, v in X.new_network(3).items()}
    own = X.Words(*utf8(pa.array(["some words here and there", "a stupid idiot " * 15, "one"])))
    first, size, doc = X.windows(own.bounds)
    label = (doc == 1).astype(np.float64)
    _, grads = X.gradients(net, own, first, size, label)
    for name in ("Wf", "Ub", "cf", "bb", "attend", "out", "bias", "word", "gram"):
        g = grads[name]
        at = (int(g[0][0]), 2) if isinstance(g, tuple) else tuple(s // 2 for s in g.shape)
        want = sum(v[2] for r, v in zip(*g) if r == at[0]) if isinstance(g, tuple) else g[at]
        loss = []
        for step in (1e-3, -1e-3):
            moved = {k: v.copy() for k, v in net.items()}
            moved[name][at] += step
            loss.append(X.gradients(moved, own, first, size, label)[0])
        assert want == pytest.approx((loss[0] - loss[1]) / 2e-3, rel=0.05, abs=2e-5)


def test_toxicity_learns(spark):
    from tessera.llm.toxicity import toxicity
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    rows = []
    for i in range(1200):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(5, 120))]
        if i % 3 == 0:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), "toxq" + rng.choice(vocabulary) if i % 2 else "idiot")
        rows.append((i, " ".join(w), int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity(docs.select("doc_id", "text"), docs.select("doc_id", "toxic")).join(docs, "doc_id").where("held_out").collect()
    right = [r.predicted == r.toxic for r in got]
    assert len(got) > 300 and sum(right) >= 0.93 * len(got), sum(right) / len(got)


def test_toxicity_training_sees_every_window(monkeypatch):
    """Each pass of the training, that of the cut-off included, scores all
    windows of all texts, however long one is."""
    from tessera.llm import toxicity as T
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["ab", "cd", "ef", "gh"]) for _ in range(n)) for n in (2000, 40, 5, 0, 700, 300)]
    looked, scored = [], T.window_logits
    monkeypatch.setattr(T, "window_logits", lambda net, own, first, size, **more: looked.append((first, size)) or scored(net, own, first, size, **more))
    T.train(texts, [0, 1, 0, 1, 1, 0], epochs=3)
    buf, offsets = T.utf8(pa.array(texts, pa.large_string()))
    own = T.Words(buf, offsets)
    first, size, _ = T.windows(own.bounds)
    assert len(looked) == 3 and all(np.array_equal(f, first) and np.array_equal(s, size) for f, s in looked)
    net = T.new_network(3)
    assert np.allclose(scored(net, own, first, size), scored(net, own, first, size, most=7, block=20), atol=1e-5)


def test_toxicity_sample_size(spark):
    """2,000 labelled texts of each class are learned from."""
    from tessera.llm.toxicity import training_sample
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    sample = training_sample(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")))
    assert {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()} == {0: 2000, 1: 2000}


def test_deep_shallow_order():
    from tessera.llm.substring_dedup import common, deep_shallow
    rng = random.Random(7)
    stem = bytes(rng.choice(b"ab") for _ in range(300))
    texts = [stem[:rng.randint(0, 300)] + bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(0, 12))) for _ in range(400)]
    order, lcp = deep_shallow(texts)
    assert [texts[i] for i in order] == sorted(texts)
    assert lcp == [0] + [common(texts[a], texts[b]) for a, b in zip(order, order[1:])]


def test_substring_dedup_equals_all_windows(spark):
    from tessera.llm.substring_dedup import substring_dedup
    rng = random.Random(8)
    length, gram = 24, 6
    raw = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    passages = [raw(n) for n in (20, 30, 45, 80)]
    texts = [raw(rng.randint(0, 90)) + rng.choice(passages) + raw(rng.randint(0, 60)) for _ in range(120)] + ["ab" * 40, "a" * 23, "é" * 30]
    texts += texts[:3]
    data = [t.encode() for t in texts]
    times = Counter(b[k:k + length] for b in data for k in range(len(b) - length + 1))
    got = {r.doc_id: r for r in substring_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), length, gram).collect()}
    for i, b in enumerate(data):
        gone = set()
        for k in range(len(b) - length + 1):
            if times[b[k:k + length]] > 1:
                gone.update(range(k, k + length))
        spans = sum(k - 1 not in gone for k in gone)
        kept = bytes(x for k, x in enumerate(b) if k not in gone)
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(b), len(gone), spans, hashlib.sha256(kept).hexdigest())


def test_sentencepiece_equals_the_library(spark):
    from tessera.llm.spiece import Model, WordMemory, decode, encode, encode_texts
    path = public_tokenizers.path("piece_bpe_32k.model")
    data, sp = open(path, "rb").read(), sentencepiece.SentencePieceProcessor(model_file=path)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    encoded = encode(docs, data)
    for r in decode(encoded, data).withColumnRenamed("text", "decoded").join(docs, "doc_id").join(encoded.select("doc_id", "ends"), "doc_id").collect():
        assert r.ids == sp.encode(r.text, add_eos=True) and r.decoded == sp.decode(r.ids)
        raw = r.text.encode()
        assert b"".join(raw[a:b] for a, b in zip([0, *r.ends], r.ends)) == raw
    model = Model(data)
    odd = ["", " ", "  a  b ", "a▁b ▁▁ c", "日本😀\x00x", "aaaa" * 100, "x" * 5000, "<0x0A> </s>", "\t a\r\n", "-----" * 50 + " " * 40]
    ids, ends, size = encode_texts(model, WordMemory(model, most=3), odd, True)
    at = 0
    for text, n in zip(odd, size):
        assert ids[at:at + n].tolist() == sp.encode(text, add_eos=True) and ends[at + n - 1] == len(text.encode())
        at += n
    rng = random.Random(9)
    for _ in range(300):
        some = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32000), 1, 2, 0, 29871]) for _ in range(6)]
        assert model.decode(some) == sp.decode(some)


def test_character_map_longest_prefix():
    from tessera.llm.spiece import CharacterMap
    # fixed values: a hand-made double array for the keys "a" -> 0 and "ab" -> 2 over the block "x\0yz\0"
    import struct
    units = [0] * 512
    units[0] = 256 << 10
    child_a = 256 ^ 0x61
    units[child_a] = ((300 ^ child_a) << 10) | 0x61 | 1 << 8
    units[300] = 0 | 1 << 31
    child_b = 300 ^ 0x62
    units[child_b] = ((400 ^ child_b) << 10) | 0x62 | 1 << 8
    units[400] = 2 | 1 << 31
    blob = struct.pack("<I", 4 * 512) + struct.pack("<512I", *units) + b"x\0yz\0"
    m = CharacterMap(blob)
    assert m.longest(b"abc", 0) == (b"yz", 2) and m.longest(b"ac", 0) == (b"x", 1) and m.longest("é".encode(), 0) == ("é".encode(), 2)


def test_line_sketches_never_rule_out_near_lines():
    from tessera.llm.line_dedup import sketches
    rng = random.Random(11)
    for _ in range(400):
        a = bytes(rng.choice(b"abcde fgh") for _ in range(rng.randint(20, 80)))
        x, y = sketches([a, edited(rng, a, 2, b"xyz a")])
        flips = [bin(int(p) ^ int(q)).count("1") for p, q in zip(x, y)]
        assert flips[0] <= 4 and sum(flips[1:]) <= 8

"""Nulls in any column, empty and very long texts, ties, repeated rows, empty
tables, and extra columns whose names clash with the operators' own."""
import hashlib

import public_tokenizers
import pytest
import sentencepiece

from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG_WORD, LONG_TEXT = "x" * 300_000, " ".join(f"w{i % 977} and" for i in range(30_000))
TEXTS = [(1, "One two three four five six."), (2, None), (3, ""), (4, " \n\t \r\n "), (5, LONG_WORD), (6, LONG_TEXT), (7, "One two three four five six."),
         (8, "é ß ñ 日本語 😀 ▁▁ \x00 tab\there"), (8, "é ß ñ 日本語 😀 ▁▁ \x00 tab\there"), (None, "no id here at all"), (9, LONG_TEXT)]
CLASHES = ["id", "key", "keys", "comp", "n", "score", "size", "target", "body", "code", "place", "h1", "kept", "copies", "row", "number", "dropped", "cut_id", "owner", "spans"]


@pytest.fixture(scope="module")
def docs(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), *(T.StructField(c, T.StringType()) for c in CLASHES)])
    rows = [(i, t, None, None if k % 3 == 0 else f"s{k % 3}", None if t is None else len(t), *([None if k % 2 else "z"] * len(CLASHES))) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, None, 1), (6, 0, None), (None, 1, 1), (99, 1, 1), (7, 1, 1), (7, 1, 1)], "doc_id long, quality int, toxic int")


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


def test_near_dedup(docs):
    from tessera.llm.near_dedup import near_dedup
    got = by_id(near_dedup(docs, 3, 85))
    assert sum(map(len, got.values())) == len(TEXTS)
    assert {got[i][0].component_id for i in (1, 7)} == {1} and {got[i][0].component_id for i in (6, 9)} == {6}
    assert [got[i][0].n_shingles for i in (1, 2, 3, 4, 5)] == [4, 0, 0, 0, 1]
    assert all(got[i][0].kept for i in (1, 2, 3, 4, 5, 6, 8, None)) and not got[7][0].kept and got[None][0].component_id is None
    assert near_dedup(docs.limit(0)).count() == 0


def test_url_filter(spark):
    from tessera.llm.url_filter import RULES, url_filter
    urls = [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.NET/en/x?y#z"), (5, "http://a.net"), (6, "http://spam.org"), (6, "http://spam.org"),
            (None, "http://x.org/fr/1"), (7, "x://" + "a" * 100_000 + ".com/" + "b" * 100_000), (8, "a://b://c/d"), (9, "h://ok.com#f://x/y")]
    pages = spark.createDataFrame([(i, u, None, "z", 0) for i, u in urls], "page_id long, url string, html string, key string, listed int")
    got = url_filter(pages, RULES, F.col("key").contains("spam")).collect()
    one = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert len(got) == len(urls)
    assert one[1] == one[2] == one[3] == ("", "", None, "allow")
    assert one[4] == ("a.example.net", "/en/x", "example.net/en/", "allow") and one[5] == ("a.net", "", None, "allow")
    assert one[6] == ("spam.org", "", None, "block") and one[None] == ("x.org", "/fr/1", "org/fr/", "allow")
    assert one[8] == ("b:", "//c/d", None, "allow") and one[9] == ("ok.com", "", None, "allow")
    assert url_filter(pages.limit(0), RULES, F.lit(True)).count() == 0


def test_mixing(docs):
    from tessera.llm.mixing import mix_sources, mixed_documents
    rows = mix_sources(docs, [1, 2, 3], 3.0, 5).collect()
    assert len(rows) == len(TEXTS) and sum(r["size"] for r in rows if r.text is None) == 0
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows) and len({r.target for r in rows if r.source is None}) == 1
    mixed = mixed_documents(docs, [1, 2, 3], 3.0, 5)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in rows)
    assert mix_sources(docs.limit(0), [1], 3.0).count() == 0
    assert all(r.taken == 0 for r in mix_sources(docs.where("doc_id in (2, 3, 4)"), [1, 2], 3.0).collect())


def test_exact_dedup(docs):
    from tessera.llm.exact_dedup import exact_dedup
    for spill in (48 << 20, 1000):
        got = by_id(exact_dedup(docs, "largest", trie_bytes=spill))
        assert (got[2][0].keep_id, got[2][0].group_size, got[2][0].kept) == (3, 2, False)
        assert [(r.keep_id, r.group_size, r.kept) for r in got[8]] == [(8, 2, True)] * 2
        assert got[1][0].keep_id == 7 and got[6][0].keep_id == 9 and got[None][0].keep_id is not None or got[None][0].group_size == 1
        assert got[5][0].text_sha256 == hashlib.sha256(LONG_WORD.encode()).hexdigest()
    assert {r.keep_id for r in by_id(exact_dedup(docs))[7]} == {1}
    assert exact_dedup(docs.limit(0)).count() == 0


def test_quality(docs, labels):
    from tessera.llm.quality import quality_rules
    got = by_id(quality_rules(docs, labels.where("quality = 1")))
    assert sum(map(len, got.values())) == len(TEXTS) and all(r.score is not None for rs in got.values() for r in rs)
    assert [got[i][0].n_words for i in (2, 3, 4, 5, 6)] == [0, 0, 0, 1, 60_000] and got[5][0].word_chars == 300_000
    assert got[6][0].base_failed and not got[6][0].kept
    assert quality_rules(docs.limit(0), labels).count() == 0 and quality_rules(docs, labels.limit(0)).count() == len(TEXTS)


def test_hmm(docs):
    from tessera.llm.hmm import hmm_scores
    got = by_id(hmm_scores(docs, rounds=1))
    assert sum(map(len, got.values())) == len(TEXTS) and got[2][0].n_tokens == got[4][0].n_tokens == 1 and got[6][0].n_tokens == 60_001
    assert got[None][0].held_out is False and all(r.score < 0 for rs in got.values() for r in rs)
    assert hmm_scores(docs.limit(0), rounds=1).count() == 0
    from tessera.llm.toxicity import fold
    held = docs.where(fold(F.col("doc_id"), 5) == 1)  # nothing to learn from
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in hmm_scores(held, rounds=1).collect())


def test_line_dedup(docs):
    from tessera.llm.line_dedup import line_decisions, line_dedup
    got = by_id(line_decisions(docs))
    assert sum(map(len, got.values())) == len(TEXTS)
    assert (got[7][0].n_lines, got[7][0].dropped) == (1, [0]) and got[1][0].dropped == [] and got[9][0].dropped == [0]
    assert [got[i][0].n_lines for i in (2, 3, 4)] == [0, 0, 0] and got[None][0].dropped == []
    cut = line_dedup(docs)
    assert cut.columns == docs.columns
    texts = by_id(cut)
    assert texts[7][0].text == "" and texts[7][0].n_chars == 0 and texts[2][0].text is None and texts[5][0].text == LONG_WORD and texts[4][0].text == TEXTS[3][1]
    assert 7 not in by_id(line_dedup(docs, drop_emptied=True)) and {1, 2, 3, 4, 5, 6, 8, None} <= set(by_id(line_dedup(docs, drop_emptied=True)))
    assert line_decisions(docs.limit(0)).count() == 0


def test_lines_of_rows_that_share_an_id(spark):
    from tessera.llm.line_dedup import keyed, line_decisions, line_dedup
    rows = [(1, "repeat\nalpha"), (2, "repeat\nbeta"), (2, "a unique line that nobody else has at all\ngamma"), (None, "repeat\ndelta\ndelta"), (None, "epsilon\nrepeat"), (-5, "repeat\nzeta"),
            (3, "twice\nrepeat"), (3, "twice\nrepeat"), (4, "alpha\nown words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    texts = sorted(((r.doc_id, r.text) for r in line_dedup(docs).collect()), key=str)
    assert texts == sorted([(1, "alpha"), (2, "beta"), (2, "a unique line that nobody else has at all\ngamma"), (None, "delta"), (None, "epsilon"), (-5, "repeat\nzeta"),
                            (3, "twice"), (3, "twice"), (4, "own words")], key=str)
    assert sorted((r.doc_id or 0, r.n_lines) for r in line_decisions(docs).collect()) == [(-5, 2), (0, 2), (0, 3), (1, 2), (2, 2), (2, 2), (3, 2), (3, 2), (4, 2)]
    # rows of a unit don't repeat each other and stand at its place: here 1 and 4 stand at 1, before 2, but after -5
    units = keyed(docs).where("doc_id in (1, 4)").select("place", "digest", F.lit(1).cast("long").alias("unit"))
    assert sorted(r.text for r in line_dedup(docs, units).where("doc_id in (1, 4)").collect()) == ["alpha", "alpha\nown words"]


def test_toxicity(docs, labels):
    from tessera.llm.toxicity import new_network, reject_toxic, toxicity
    got = by_id(toxicity(docs, labels))
    assert sum(map(len, got.values())) == len(TEXTS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for rs in got.values() for r in rs)
    assert got[2][0].score == got[3][0].score == got[4][0].score and got[None][0].held_out is False
    assert toxicity(docs, labels.limit(0)).count() == len(TEXTS) and toxicity(docs.limit(0), labels).count() == 0
    kept = reject_toxic(docs, new_network(1), cutoff=1.1)
    assert kept.columns == docs.columns and kept.count() == len(TEXTS) and reject_toxic(docs, new_network(1), cutoff=0.0).count() == 0


def test_substring_dedup(docs):
    from tessera.llm.substring_dedup import substring_dedup
    got = by_id(substring_dedup(docs))
    assert sum(map(len, got.values())) == len(TEXTS)
    assert [(got[i][0].n_bytes, got[i][0].n_removed, got[i][0].n_spans) for i in (2, 4)] == [(0, 0, 0), (len(TEXTS[3][1]), 0, 0)]
    assert (got[5][0].n_removed, got[5][0].n_spans) == (300_000, 1)  # its own windows overlap
    assert all(got[i][0].n_removed == len(LONG_TEXT) for i in (6, 9)) and got[None][0].n_removed == 0
    assert got[1][0].kept_sha256 == hashlib.sha256(TEXTS[0][1].encode()).hexdigest()
    assert substring_dedup(docs.limit(0)).count() == 0


def test_sentencepiece(docs):
    from tessera.llm.spiece import decode, encode, token_digests
    path = public_tokenizers.path("piece_bpe_32k.model")
    model, sp = open(path, "rb").read(), sentencepiece.SentencePieceProcessor(model_file=path)
    for r in encode(docs, model).join(docs.select("doc_id", "text"), "doc_id").collect():
        assert r.ids == sp.encode(r.text or "", add_eos=True) and r.ends[-1] == len((r.text or "").encode())
    got = by_id(token_digests(docs, model))
    assert got[2][0].n_tokens == got[3][0].n_tokens == 1 and len(got[8]) == 2
    assert got[6][0].decoded_sha256 == hashlib.sha256(LONG_TEXT.encode()).hexdigest()
    assert encode(docs.limit(0), model).count() == 0 and decode(encode(docs.limit(0), model), model).count() == 0

"""The corpus pipeline: raw documents to token ids, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but
the last return the columns of documents.  ``run`` writes what each stage
returns as Parquet into the cluster's shared folder and reads it back, so a
lost executor costs at most the stage that is running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import table, written
from tessera.llm.line_dedup import keyed, line_dedup
from tessera.llm.mixing import mixed_documents
from tessera.llm.near_dedup import near_dedup
from tessera.llm.spiece import token_digests
from tessera.llm.toxicity import fitted_network, reject_toxic

#: Source weights by code point order, repeating; times that a source may be repeated; seed of the draw.
WEIGHTS, REPEATS, SEED = [1, 2, 3], 3.0, 17


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose highest window reaches the cut-off go."""
    return reject_toxic(docs, fitted_network(docs, table(spark, sf_dir, "labels")))


def copy_units(docs: DataFrame) -> DataFrame:
    """``place, digest, unit`` of the rows of every class of near copies (five
    words, similarity 0.8): the unit is the class's smallest doc_id.  Rows without an id, or whose id other rows have too, stand for
    themselves."""
    classes = near_dedup(docs, k=5, percent=80).where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), F.min("component_id").alias("component_id")).where("n = 1")
    several = classes.groupBy("component_id").agg(F.count("*").alias("members")).where("members > 1").select("component_id")
    members = written(classes.join(several, "component_id").select(F.col("doc_id").alias("member"), "component_id"))
    return keyed(docs).join(members, F.col("doc_id") == F.col("member")).select("place", "digest", F.col("component_id").alias("unit"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line but for a few edits are cut out.

    Copies of a document are left to the next stage: they aren't earlier
    places for each other, and lose only what their first document loses, so
    they stay copies.  A text that loses its last word here has nothing of its
    own and goes; one that never had a word stays."""
    return line_dedup(docs, copy_units(docs), drop_emptied=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies (five words, similarity 0.8) the document
    with the smallest id stays.  Texts without words, null ones included, are
    copies of nothing."""
    gone = near_dedup(docs, k=5, percent=80).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target of its source asks for.  Null
    sources are a source of their own, null texts have no words."""
    return mixed_documents(docs, WEIGHTS, REPEATS, SEED)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of ids and decoded text; a
    null text counts as empty."""
    import public_tokenizers
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return token_digests(docs, f.read(), with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", drop_near_copies),
    ("mixing", mix),
    ("sentencepiece", tokenise),
]

#: A neural network, edit distances and a tokenizer can't be said in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; an empty table gives no rows."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

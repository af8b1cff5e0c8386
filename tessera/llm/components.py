"""Connected components of a graph held in a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tessera.llm.common import written

#: Leaders of a key in a leader round.
LEADERS = 4
#: Ids of a part of a key; the ids of a larger key are compared part by part, each pair of parts in a cell of its own.
PART = 256


def _observed(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, written, and a fingerprint of them that costs no job of its own."""
    seen = Observation()
    code = F.xxhash64("u", "v")
    out = written(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(code).alias("x"), F.sum(F.shiftright(code, 24)).alias("s")))
    return out, (seen.get["n"], seen.get["x"], seen.get["s"])


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``u``, ``v``) that
    isn't its component's smallest; the smallest node is the root.

    Alternating large-star and small-star steps: each is a grouped minimum
    joined back, so no component is ever gathered; the number of rounds grows
    with the logarithm of the longest path.  A round is one job, and the last
    one changes nothing.  Self-loops and repeated edges don't matter, nulls
    must not occur, an empty graph gives no rows."""
    e, mark = _observed(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while mark[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before = mark
        e, mark = _observed(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        if mark == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _open_keys(now: DataFrame, *more: Column) -> DataFrame:
    """The keys that ids of different classes have."""
    return now.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), *more).where("low < high").drop("low", "high")


def cells(rest: DataFrame) -> DataFrame:
    """The rows of open keys, dealt out for comparison: ``part`` is the id's
    part of its key, and a row is in every cell (``low`` <= ``high``) of its
    part with any other; a cell has at most about two parts' rows."""
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    rest = rest.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rest.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")}).drop("other", "parts")


def crossed(rest: DataFrame, cross: Callable[[str, str], Column]) -> DataFrame:
    """The pairs (``a, comp_a, b, comp_b``) of ids of different classes in a
    cell that fulfil ``cross`` (the names of the columns of both sides end in
    the given suffixes); the ids of two parts meet in one cell."""
    dealt = cells(rest)
    left, right = (dealt.select(*(F.col(c).alias(f"{c}_{s}") for c in dealt.columns)) for s in ("a", "b"))
    same = (F.col("key_a") == F.col("key_b")) & (F.col("low_a") == F.col("low_b")) & (F.col("high_a") == F.col("high_b"))
    meet = (F.col("low_a") == F.col("high_a")) | (F.col("part_a") != F.col("part_b"))
    return left.join(right, same & meet & (F.col("comp_a") != F.col("comp_b")) & cross("_a", "_b")).select(
        F.col("id_a").alias("a"), "comp_a", F.col("id_b").alias("b"), "comp_b").distinct()


def linked_classes(rows: DataFrame, confirm: Callable[[DataFrame], DataFrame], compare: Callable[[DataFrame], DataFrame], leader_rounds: int,
                   leaders: int = LEADERS) -> DataFrame:
    """``id, comp`` for every id of ``rows`` (columns ``key``, ``id``, and others):
    classes of the links among ids that share a key; comp is the smallest id.

    A key held by thousands of ids gives no pairs within the group.  In each
    leader round every id of a key is paired with some leaders of the
    key, unless they are in one class already: the id that shares the most keys
    with others, which is the middle of a group of copies, and others drawn by
    a hash of the id, so that the keys of a group have the same.  ``confirm``
    gives the classes (``comp_a, comp_b``) of those of the pairs (``a, comp_a,
    b, comp_b``) that are links.  Then whatever is still apart is compared:
    ``compare`` gets the rows of the keys whose ids are of different classes
    (with ``comp`` and ``parts``, in how many parts to compare the key's ids)
    and gives the classes of all links among them.  So no link between
    classes is left out.  From round to round only the rows of keys that are
    still open are carried on."""
    shared = rows.join(rows.groupBy("key").agg(F.count("*").alias("n")), "key").groupBy("id").agg(F.sum("n").alias("support"))
    label = written(shared.withColumn("comp", F.col("id")))
    now = rows.join(label, "id")
    for turn in range(leader_rounds + 1):
        if turn < leader_rounds:
            first = [F.min(F.struct(F.xxhash64("id", F.lit(turn * leaders + i)) if i else -F.col("support"), "id", "comp")) for i in range(leaders)]
            opened = _open_keys(now, F.array(*first).alias("leaders"))
            led = now.join(opened, "key").select("id", "comp", F.explode("leaders").alias("x"))
            links = confirm(led.where("comp <> x.comp").select(F.col("id").alias("a"), F.col("comp").alias("comp_a"), F.col("x.id").alias("b"), F.col("x.comp").alias("comp_b")).distinct())
        else:
            opened = _open_keys(now, F.ceil(F.count("*") / PART).cast("int").alias("parts"))
            links = compare(now.drop("support").join(opened, "key"))
        links, (found, *_) = _observed(links.select(F.col("comp_a").alias("u"), F.col("comp_b").alias("v")).distinct())
        if not found:
            continue
        root = components(links)
        label = written(label.join(root, label["comp"] == root["node"], "left").select("id", "support", F.coalesce("root", "comp").alias("comp")))
        if turn < leader_rounds:
            now = written(now.drop("comp", "support").join(opened.select("key"), "key", "left_semi").join(label, "id"))
    return label.select("id", "comp")

"""Mixing sources to target weights, as DataFrame functions only.

Token counts are aggregated per source; capped targets are a water level
over the sources in order of where their cap is reached; every document is
then given ``floor(rate)`` times and once more by a seeded draw with the
fraction as its probability.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, unit_hash


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(weights: list[int]) -> Column:
    """Weights by code point order of ``source`` (null last), repeating."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return F.get(F.lit(weights).cast("array<bigint>"), F.pmod(place, F.lit(len(weights))).cast("int"))


def capped_targets(sources: DataFrame, cap: float) -> DataFrame:
    """Targets that share the sum of ``source_size`` by ``weight``, none above
    ``cap`` times its source's size, the excess reshared by weight.

    One row per source, so one sorted window: with sources in the order of
    cap·size/weight, the first k are at their cap, and the others share what
    is left by weight, for the smallest k at which none of these is above."""
    caps = sources.withColumn("most", F.col("source_size") * F.lit(cap)).withColumn("at", F.col("most") / F.col("weight"))
    order = Window.orderBy("at", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    levels = caps.withColumn("level", level)
    # the water level is the first at which this source's share is below its cap
    water = F.min(F.when(F.col("level") <= F.col("at"), F.struct(F.col("at").alias("at"), F.col("level").alias("level")))).over(everything)
    return levels.withColumn("water", water["level"]).select(
        "source", "source_size", F.least(F.col("most"), F.coalesce(F.col("water"), F.lit(0.0)) * F.col("weight")).alias("target"))


def copies(size: Column, source_size: Column, target: Column, doc_id: Column, seed: int) -> Column:
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    return (F.floor(rate) + (unit_hash(doc_id, seed) < rate - F.floor(rate)).cast("long")).cast("long")


def mix_sources(docs: DataFrame, weights: list[int], cap: float = 3.0, seed: int = 0) -> DataFrame:
    """The input's rows with ``size, source_size, target, copies, taken``.

    ``size`` is the number of words of ``text`` (null: 0), ``source_size`` and
    ``target`` are the source's, ``copies`` says how often the mix takes the
    row and ``taken`` how many words that gives.  Rows with a null source are
    one source, the last.  A source without words has target 0 and its rows
    are not taken.  The draw depends on doc_id and seed only: reruns agree,
    rows that repeat a doc_id are drawn alike, a null doc_id counts as one
    value.  An empty table gives an empty result.  Columns of these names in
    the input are replaced.
    """
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    sized = docs.select(*kept, n_words(F.col("text")).alias("size"))
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = capped_targets(per_source.withColumn("weight", cycled_weights(weights)), cap)
    targets = targets.withColumnRenamed("source", "mix_source")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("mix_source")))
    n = copies(F.col("size"), F.col("source_size"), F.col("target"), F.col("doc_id"), seed)
    return joined.withColumn("copies", n).withColumn("taken", F.col("copies") * F.col("size")).select(
        *kept, "size", "source_size", "target", "copies", "taken")


def mixed_documents(docs: DataFrame, weights: list[int], cap: float = 3.0, seed: int = 0) -> DataFrame:
    """The mix itself: every row ``copies`` times, with the input's columns as they are."""
    whole = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("whole_row"))
    return (mix_sources(whole, weights, cap, seed)
            .select("whole_row", F.explode(F.expr("array_repeat(0, cast(copies as int))")).alias("turn")).select("whole_row.*"))

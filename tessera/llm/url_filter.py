"""URL filters: suffix/prefix rules, then a Bloom filter cascade.

All of it is DataFrame functions.  A cascade stores a listed set of keys
exactly, relative to a known universe of keys: level 1 is a Bloom filter of
the listed keys; level 2 encodes the unlisted keys of the universe that pass
level 1; level 3 the listed keys that pass level 2; and so on until nobody
passes wrongly.  A key is listed when the first level that it fails is an
even one.  Judging a row is a few bit tests on constants: no join, no
shuffle, and no error for any key of the universe.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut

#: Bits for each key of a level, hash functions, and the most bytes that all levels may have.
BITS_PER_KEY, HASHES, MOST_BYTES, MOST_LEVELS = 8, 4, 64 << 20, 40


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL.  Host: after the first ``://`` up to ``/``,
    ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``,
    ``#`` or the end.  A null URL, or one without ``://``, has both empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    # (?s): a line end is an ordinary character of a URL
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def first_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null where none fits.
    ``rules`` holds (verdict, ``host/path``); a rule fits its host and all
    subdomains when the path starts with the rule's."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is tested first
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


@dataclass
class Level:
    bits: int
    seed: int
    words: list[int]


def _positions(key: Column, seed: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed * 64 + i)), F.lit(bits)) for i in range(HASHES)]


def _passes(key: Column, level: Level) -> Column:
    words = F.array(*[F.lit(w) for w in level.words]) if len(level.words) < 2 else F.lit(level.words).cast("array<bigint>")
    out = F.lit(True)
    for p in _positions(key, level.seed, level.bits):
        word = F.get(words, F.floor(p / F.lit(64)).cast("int"))
        out = out & (F.shiftrightunsigned(word, 0).bitwiseAND(_bit(p)) != F.lit(0))
    return out


def _bit(position: Column) -> Column:
    """1 << (position mod 64), from a constant table."""
    table = F.lit([1 << i if i < 63 else -(1 << 63) for i in range(64)]).cast("array<bigint>")
    return F.get(table, F.pmod(position, F.lit(64)).cast("int"))


def _level(keys: DataFrame, n: int, seed: int) -> Level:
    """A Bloom filter of ``keys`` (column ``key``): bits are OR-ed per word in
    a grouped aggregation; what reaches the driver is the filter itself."""
    bits = max(64, 64 * -(-n * BITS_PER_KEY // 64))
    if bits // 8 > MOST_BYTES:
        raise ValueError(f"the cascade needs over {MOST_BYTES} bytes; filter on a coarser key")
    position = F.explode(F.array(*_positions(F.col("key"), seed, bits)))
    set_words = (keys.select(position.alias("p")).groupBy(F.floor(F.col("p") / 64).cast("int").alias("w"))
                 .agg(F.bit_or(_bit(F.col("p"))).alias("b")).collect())
    words = [0] * (bits // 64)
    for r in set_words:
        words[r.w] = r.b
    return Level(bits, seed, words)


def bloom_cascade(universe: DataFrame, listed: str = "listed") -> list[Level]:
    """Levels for a universe of distinct keys (columns ``key`` and boolean
    ``listed``).  Null keys are left out; an empty universe has no level."""
    rest = cut(universe.where("key is not null").select("key", F.col(listed).alias("listed")))
    levels: list[Level] = []
    encode = True  # whether the next level encodes listed keys
    while len(levels) < MOST_LEVELS:
        n = rest.where(F.col("listed") == F.lit(encode)).count()
        if not n:
            return levels
        level = _level(rest.where(F.col("listed") == F.lit(encode)), n, len(levels))
        levels.append(level)
        if sum(x.bits // 8 for x in levels) > MOST_BYTES:
            raise ValueError(f"the cascade needs over {MOST_BYTES} bytes; filter on a coarser key")
        # what it encodes stays, and the others that pass it must be told apart by the next
        rest = cut(rest.where((F.col("listed") == F.lit(encode)) | _passes(F.col("key"), level)))
        encode = not encode
    raise ValueError("the cascade didn't end; are keys both listed and not?")


def in_cascade(key: Column, levels: list[Level]) -> Column:
    """Whether a key of the universe is listed; a null key isn't."""
    out = F.lit(len(levels) % 2 == 1)  # passes all levels
    for k in reversed(range(len(levels))):
        out = F.when(~_passes(key, levels[k]), F.lit(k % 2 == 1)).otherwise(out)
    return F.coalesce(key.isNotNull() & out, F.lit(False))


#: Rules of the production filter, and the labels of listed hosts.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
LISTED_LABELS = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]


def url_filter(pages: DataFrame, rules: list[tuple[str, str]], listed: Column, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Judge every row's URL.

    Returns ``page_id, host, path, rule, verdict``: the longest rule that
    fits decides; without one, the cascade blocks the hosts for which the
    condition ``listed`` (on a column ``key``, the host) holds, and allows the
    rest.  The key universe is the distinct hosts of the table.  Null URLs and
    URLs without ``://`` have an empty host and path, fit no rule and are
    allowed unless the empty host is listed.  Repeated rows are judged alike;
    an empty table gives no rows; other columns are ignored.
    """
    host, path = url_parts(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    universe = rows.select(F.col("host").alias("key")).distinct().withColumn("listed", F.coalesce(listed, F.lit(False)))
    levels = bloom_cascade(universe)
    rule, verdict = first_rule(F.col("host"), F.col("path"), rules)
    method = F.when(in_cascade(F.col("host"), levels), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"))

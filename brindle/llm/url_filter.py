"""Exact membership of URLs in rule lists by a cascade of Bloom filters, in DataFrame functions only.

The first filter holds the listed keys. Keys of the corpus that it takes for listed by mistake are found by one scan of
the corpus's complete key universe and held by a second filter; listed keys that the second one takes for mistakes are
held by a third, and so on until a level makes no mistake. A lookup goes down the levels until one says no, and the
number of that level tells whether the key is listed. For keys of the universe this is exact, and it needs no join;
only building a cascade joins, with the listed keys, the few keys that the first filter lets through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut

#: 64-bit words of one filter (4 MB): some two million listed keys. Longer lists are cut into parts by a hash, each with a cascade of its own.
MOST_WORDS = 1 << 19


@dataclass
class Level:
    seed: int
    hashes: int
    bits: int
    words: list[int] = field(repr=False)

    def holds(self, key: Column) -> Column:
        """May the key be one that this filter holds?"""
        words, out = F.lit(self.words), None
        for at in positions(key, self):
            bit = F.get(words, F.floor(at / 64).cast("int")).bitwiseAND(_one_shifted(at)) != 0
            out = bit if out is None else out & bit
        return out


def _one_shifted(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))


def positions(key: Column, level: Level) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level.seed), F.lit(i)), F.lit(level.bits).cast("long")) for i in range(level.hashes)]


@dataclass
class Cascade:
    levels: list[Level]

    def member(self, key: Column) -> Column:
        """Is the key listed? Exact for every key of the universe."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels), 0, -1):
            out = F.when(~self.levels[i - 1].holds(key), F.lit(i % 2 == 0)).otherwise(out)
        return out


@dataclass
class Parts:
    """Cascades of the keys of each remainder of a hash."""

    cascades: list[Cascade]

    def member(self, key: Column) -> Column:
        """Is the key listed? Exact for every key of the universe."""
        out = F.lit(False)
        for i, cascade in enumerate(self.cascades):
            out = F.when(_part(key, len(self.cascades)) == i, cascade.member(key)).otherwise(out)
        return out


def _part(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(parts))


def _filled(keys: DataFrame, n: int, chance: float, number: int) -> Level:
    """A filter of n keys that is wrong about others with the given chance. Its words, O(n), come to the driver."""
    hashes = _hashes(chance)
    bits = 64 * _words(n, hashes)
    level = Level(1_000_003 * number, hashes, bits, [0] * (bits // 64))
    at = keys.select(F.explode(F.array(*positions(F.col("key"), level))).alias("at"))
    for word, value in at.groupBy(F.expr("at div 64").alias("word")).agg(F.bit_or(_one_shifted(F.col("at"))).alias("value")).collect():
        level.words[word] = value
    return level


def _hashes(chance: float) -> int:
    return max(1, round(math.log2(1 / chance)))


def _words(n: int, hashes: int) -> int:
    return max(1, math.ceil(max(1, n) * hashes / math.log(2) / 64))


def build(listed: DataFrame, universe: DataFrame) -> Cascade | Parts:
    """listed, universe: `key` string; repeated and null keys don't matter. The universe may hold listed keys, and need not be distinct.

    The first filter's rate of mistakes is set so that about as many keys pass by mistake as are listed; with one half
    for all others, a cascade takes O(n log(universe / n)) bits for n listed keys, whatever the size of the corpus. The
    universe is read twice (to count and to test its keys) and never shuffled as a whole. A list too long for a filter of
    MOST_WORDS is cut into parts, and the universe is read once more for each. The words become part of the plan of
    whatever asks `member`: some bytes for each listed key.
    """
    listed = cut(listed.where("key IS NOT NULL").distinct())
    n = listed.count()
    if n == 0:
        return Cascade([])
    size = universe.agg(F.approx_count_distinct("key")).head()[0]
    chance = min(0.5, n * math.sqrt(0.5) / max(size, 1))
    if (parts := -(-_words(n, _hashes(chance)) // MOST_WORDS)) > 1:
        parts += 1 + parts // 8  # parts aren't quite even
        return Parts([_cascade(listed.where(_part(F.col("key"), parts) == i), universe.where(_part(F.col("key"), parts) == i), chance) for i in range(parts)])
    return _cascade(listed, universe, chance)


def _cascade(listed: DataFrame, universe: DataFrame, chance: float) -> Cascade:
    n = listed.count()
    if n == 0:
        return Cascade([])
    levels = [_filled(listed, n, chance, 1)]
    wrong = cut(universe.where(F.col("key").isNotNull() & levels[0].holds(F.col("key"))).distinct().join(listed, "key", "left_anti"))
    held, others = wrong, listed
    while (n := held.count()) > 0:
        levels.append(_filled(held, n, 0.5, len(levels) + 1))
        held, others = cut(others.where(levels[-1].holds(F.col("key")))), held
    return Cascade(levels)


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, with A to Z in lower case. Empty for a null url and one without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end. Empty for a null url and one without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2), F.lit(""))


def candidates(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """Every key by which a rule could fit: each ending of the host of up to so many labels, with each beginning of the path of a length that rules have."""
    ends = [F.substring_index(host, ".", -n) for n in range(1, labels + 1)]
    return F.flatten(F.transform(F.array(*ends), lambda end: F.transform(F.lit(lengths), lambda n: F.concat(end, F.substring(path, F.lit(1), n)))))


def judge(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Judges every url by rules (key, verdict), where a key is a host and the beginning of a path, like `example.com/en/`.

    A rule fits its host and all subdomains if the path starts with the rule's. The longest rule that fits wins; of two
    as long, the one that is later in the order of strings. Returns id_col, `host`, `path`, `rule` string (null if none
    fits) and `verdict` string (then `default`: no list names the url). Null and malformed urls have an empty host and
    path, and fit no rule. Repeated rows are judged each; other columns are not read. No rules, or an empty table, are
    no special case. A key may have one verdict only.

    One cascade tells which candidate keys are rules, over all candidate keys of all pages; a second one tells, among
    the rules, those to block. Pages are neither joined nor shuffled. The rules are on the driver to begin with.
    """
    spark: SparkSession = pages.sparkSession
    verdicts = dict(rules)
    if len(verdicts) != len(set(rules)) or not all("/" in k for k in verdicts):
        raise ValueError("each rule needs a host, a path from / on and one verdict")
    split = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    if not verdicts:
        return split.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    labels = max(k.partition("/")[0].count(".") + 1 for k in verdicts)
    lengths = sorted({len(k) - k.index("/") for k in verdicts})
    keys = candidates(F.col("host"), F.col("path"), labels, lengths)
    both = spark.range(1).select(F.inline(F.array(*(F.struct(F.lit(k).alias("key"), F.lit(v).alias("verdict")) for k, v in verdicts.items()))))
    ruled = build(both.select("key"), split.select(F.explode(keys).alias("key")))
    blocked = build(both.where("verdict = 'block'").select("key"), both.select("key"))
    fitting = F.filter(keys, lambda key: ruled.member(key) & (F.col("host") != ""))
    best = F.array_max(F.transform(fitting, lambda key: F.struct(F.length(key).alias("n"), key.alias("key"))))["key"]
    found = split.select("*", best.alias("rule"))
    verdict = F.when(F.col("rule").isNull(), F.lit(default)).when(blocked.member(F.col("rule")), F.lit("block")).otherwise(F.lit("allow"))
    return found.select(id_col, "host", "path", "rule", verdict.alias("verdict"))

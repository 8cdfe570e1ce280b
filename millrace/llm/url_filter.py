"""URL filter: path rules first, then a list of domains held in a Bloom filter cascade.

The first level holds the listed keys. Every key of the corpus is known, so the keys that
level accepts wrongly are known too: they form the second level, the listed keys *it* accepts
the third, and so on until a level accepts nothing wrongly. The level at which a key is first
refused then tells exactly whether the key is listed. Judging a URL takes no join.

Keys are hosts and their parent domains; a host is blocked if one of them is listed.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.tables import ascii_lower, stored

#: Bits of one level that are sent to the tasks as a constant (1 MiB). A longer list is
#: looked up by a join instead.
MAX_BITS = 1 << 23
FIRST_BITS_PER_KEY = 10
FIRST_HASHES = 7
LATER_BITS_PER_KEY = 3
LATER_HASHES = 2


@dataclass(frozen=True)
class Level:
    salt: int
    bits: int
    hashes: int
    words: tuple[int, ...]

    def accepts(self, key: Column) -> Column:
        """True for every key the level was built from, and for some others."""
        words = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")
        found = F.lit(True)
        for position in _positions(key, self.salt, self.bits, self.hashes):
            word = F.element_at(words, (F.floor(position / 64) + 1).cast("int"))
            found = found & (F.getbit(word, (position % 64).cast("int")) == 1)
        return found


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def contains(self, key: Column) -> Column:
        """Exact for the listed keys and for every key of the universe."""
        verdict = F.lit(len(self.levels) % 2 == 1)
        for number in reversed(range(len(self.levels))):
            refused = F.lit(number % 2 == 1)
            verdict = F.when(self.levels[number].accepts(key), verdict).otherwise(refused)
        return verdict


def _positions(key: Column, salt: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(1000 * salt + i)), F.lit(bits)) for i in range(hashes)]


def _level(keys: DataFrame, n: int, salt: int) -> Level | None:
    """A filter of ``n`` keys, or None if it would exceed ``MAX_BITS``."""
    per_key = FIRST_BITS_PER_KEY if salt == 0 else LATER_BITS_PER_KEY
    hashes = FIRST_HASHES if salt == 0 else LATER_HASHES
    bits = 64 * math.ceil(max(n, 8) * per_key / 64)
    if bits > MAX_BITS:
        return None
    position = F.explode(F.array(*_positions(F.col("key"), salt, bits, hashes)))
    rows = (
        keys.select(position.alias("position"))
        .groupBy(F.floor(F.col("position") / 64).alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("position") % 64).cast("int"))).alias("bits"))
        .collect()  # at most MAX_BITS / 64 rows
    )
    words = [0] * (bits // 64)
    for row in rows:
        words[row["word"]] = row["bits"]
    return Level(salt, bits, hashes, tuple(words))


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade | None:
    """The cascade of ``listed`` over ``universe`` (both: one column ``key``).

    None if a level would exceed ``MAX_BITS``. Null keys are ignored, repeated keys count
    once. An empty list gives a cascade that contains nothing.
    """
    listed = listed.where("key IS NOT NULL").distinct()
    others = universe.where("key IS NOT NULL").distinct().join(listed, "key", "left_anti")
    sides = [listed, stored(others, "url-keys")]
    levels: list[Level] = []
    wrong, other = sides
    while n := wrong.count():
        level = _level(wrong, n, len(levels))
        if level is None:
            return None
        levels.append(level)
        wrong, other = other.where(level.accepts(F.col("key"))), wrong
    return Cascade(tuple(levels))


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without ``://``."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def domains(host: Column) -> Column:
    """The host and each parent domain, the host first."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def first_rule(rules: list[tuple[str, str]], host: Column, path: Column) -> Column:
    """The longest ``(action, rule)`` that fits, as a struct; null if none does.

    A rule is a host, ``/`` and the rest of a path. It fits the host and its subdomains when
    the path starts with the rule's path. Of equally long rules the first listed wins.
    """
    chosen = F.lit(None).cast("struct<action:string,rule:string>")
    for action, rule in sorted(reversed(rules), key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        value = F.struct(F.lit(action).alias("action"), F.lit(rule).alias("rule"))
        chosen = F.when(fits, value).otherwise(chosen)
    return chosen


def filter_urls(
    pages: DataFrame, url: str, listed: DataFrame, rules: list[tuple[str, str]]
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (allow or block) added.

    Columns of these names that the input already has are replaced. A null url, or one
    without ``://``, has an empty host and path and is allowed. Repeated rows are each judged.
    """
    parts = pages.withColumns({"host": F.coalesce(host(F.col(url)), F.lit("")), "path": F.coalesce(path(F.col(url)), F.lit(""))})
    universe = parts.select("host").distinct().select(F.explode(domains(F.col("host"))).alias("key"))
    rule = first_rule(rules, F.col("host"), F.col("path"))
    cascade = build_cascade(listed, universe)
    if cascade is None:
        is_listed, judged = _by_join(parts, listed)
    else:
        is_listed = F.exists(domains(F.col("host")), cascade.contains)
        judged = parts
    return (
        judged.withColumn("__rule", rule)
        .withColumns(
            {
                "rule": F.col("__rule.rule"),
                "verdict": F.coalesce(F.col("__rule.action"), F.when(is_listed, "block").otherwise("allow")),
            }
        )
        .drop("__rule", "__listed")
    )


def _by_join(parts: DataFrame, listed: DataFrame) -> tuple[Column, DataFrame]:
    """Beyond ``MAX_BITS``: the hosts that are listed, found and brought back by joins."""
    hosts = parts.select("host").distinct()
    hits = (
        hosts.select("host", F.explode(domains(F.col("host"))).alias("key"))
        .join(listed.distinct(), "key", "left_semi")
        .select("host", F.lit(True).alias("__listed"))
        .distinct()
    )
    return F.coalesce(F.col("__listed"), F.lit(False)), parts.join(hits, "host", "left")


def keys_from_list(spark: SparkSession, keys: list[str]) -> DataFrame:
    """A list given in code as a table of keys."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(k) for k in keys])).alias("key"))

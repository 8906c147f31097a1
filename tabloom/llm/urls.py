"""URL rules by cascades of Bloom filters, in DataFrame operations only.

A cascade gives exact membership of a list over a known universe of keys. Its first filter encodes
the listed keys; the next one the keys of the universe that the first lets through wrongly; the
next one the listed keys which that one holds wrongly; and so on until nothing is left. A key
belongs to the list if the number of filters it passes in a row is odd. All filters are sized by
the list, not by the corpus, so they travel inside the expression and pages are judged in one pass
without a join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.sources.shared import stored

#: (host, path, verdict) of the rules of the registered query.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


@dataclass(frozen=True)
class Filter:
    words: np.ndarray
    bits: int
    hashes: int
    level: int

    def positions(self, key: Column) -> list[Column]:
        seeds = range(self.hashes)
        return [F.pmod(F.xxhash64(key, F.lit(self.level * 64 + k)), F.lit(self.bits).cast("long")) for k in seeds]

    def passes(self, key: Column) -> Column:
        words, found = F.lit(self.words), F.lit(True)
        for at in self.positions(key):
            word = F.get(words, (at / 64).cast("int"))
            found = found & (F.getbit(word, (at % 64).cast("int")) == 1)
        return found


def bloom_filter(keys: DataFrame, n: int, error: float, level: int) -> Filter:
    """A filter over ``key``; its words, about 1.44 * log2(1 / error) bits a key, are combined by
    bitwise or before and after the shuffle."""
    hashes = max(1, round(math.log2(1 / error)))
    bits = 64 * math.ceil(max(64, n * hashes / math.log(2)) / 64)
    empty = Filter(np.zeros(bits // 64, np.int64), bits, hashes, level)
    at = keys.select(F.explode(F.array(*empty.positions(F.col("key")))).alias("at"))
    rows = at.groupBy((F.col("at") / 64).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
    for word, value in rows.collect():
        empty.words[word] = value
    return empty


def cascade(listed: DataFrame, universe: DataFrame, most: int = 64) -> list[Filter]:
    """Filters for the ``key`` values of ``listed`` within those of ``universe``.

    The first error rate follows the ratio of both sizes, so that the keys let through wrongly are
    about as many as the listed ones whatever the corpus; later rates are one half."""
    both = listed.select("key", F.lit(1).alias("own")).unionByName(universe.select("key", F.lit(0).alias("own")))
    marked = stored(both.where("key is not null").groupBy("key").agg(F.max("own").alias("own")), "keys")
    inside, outside = marked.where("own = 1").select("key"), marked.where("own = 0").select("key")
    n, others = inside.count(), outside.count()
    filters: list[Filter] = []
    error = min(0.5, max(1e-9, n / max(others, 1) / math.sqrt(2)))
    while n and len(filters) < most:
        filters.append(bloom_filter(inside, n, error, len(filters)))
        wrong = stored(outside.where(filters[-1].passes(F.col("key"))), "keys")
        n, error, inside, outside = wrong.count(), 0.5, wrong, inside
    if n:
        raise ValueError("the cascade did not end")
    return filters


def member(filters: list[Filter], key: Column) -> Column:
    """Whether a key of the universe is listed: an odd number of filters passed in a row."""
    inside = F.lit(len(filters) % 2 == 1)
    for level in reversed(range(len(filters))):
        inside = F.when(filters[level].passes(key), inside).otherwise(F.lit(level % 2 == 1))
    return inside


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A to Z in lower case) and path of a url; empty for null and without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every rule that could fit: the host and its parent domains with the path's beginnings of the
    lengths that rules have."""
    labels = F.split(host, r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    fitting = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(path))
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(fitting, lambda n: F.concat(h, F.substring(path, F.lit(1), n)))))
    return F.when((host != "") & (F.size(fitting) > 0), keys).otherwise(F.array().cast("array<string>"))


def judged(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` for every page.

    ``rules`` has ``host``, ``path`` (starting with ``/``) and ``verdict`` (allow or block). The
    longest fitting rule wins, then the greater one; a rule listed with both verdicts blocks. Where
    none fits, or the url is null or has no ``://``, the page is allowed, as it is on no block
    list. Repeated pages stay; other columns are left behind; empty tables work.
    """
    keys = stored(rules.select(F.concat("host", "path").alias("key"), F.length("path").alias("n"), "verdict").where("key is not null"), "rules")
    lengths = [r[0] for r in keys.select("n").distinct().orderBy("n").collect()]  # at most as many as the longest path has signs
    host, path = split_url(F.col("url"))
    own = pages.select("page_id", host.alias("host"), path.alias("path"))
    if not lengths:
        return own.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    fitting = candidate_keys(F.col("host"), F.col("path"), lengths)
    universe = stored(own.select("host", "path").distinct().select(F.explode(fitting).alias("key")).distinct(), "universe")
    blocked, allowed = (cascade(keys.where(F.col("verdict") == v), universe) for v in ("block", "allow"))
    found = F.filter(fitting, lambda k: member(blocked, k) | member(allowed, k))
    best = F.array_max(F.transform(found, lambda k: F.struct(F.length(k).alias("n"), k.alias("key"))))["key"]
    rule = own.select("page_id", "host", "path", best.alias("rule"))
    verdict = F.when(F.col("rule").isNotNull() & member(blocked, F.col("rule")), "block").otherwise("allow")
    return rule.select("page_id", "host", "path", "rule", verdict.alias("verdict"))

"""URL rules through a Bloom filter cascade.

A rule (host, path) fits a url if the url's host is the rule's or a subdomain, and its path starts with the rule's.
A url can therefore only match its own *candidate keys*: suffixes of its host with prefixes of its path, prefixes of the
lengths that occur in rules. All candidate keys of the corpus are the key universe. Level 1 of the cascade is a Bloom
filter of the listed keys, level 2 one of the universe's keys that level 1 takes wrongly, level 3 one of the listed keys
that level 2 takes, and so on until nothing is wrong. The number of levels a key passes then says exactly, for every key
of the universe, whether it is listed: urls are judged in one map pass, without a join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.llm.grams import mix
from flowguard.llm.registry import query, table
from flowguard.llm.tables import Stored

U = np.uint64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_LEVELS = 64
MAX_RULES = 5_000_000  # rules are held by driver and workers; their filters are then a few dozen MB


@dataclass
class Level:
    bits: np.ndarray
    hashes: int
    number: int

    def passes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ok = np.ones(a.shape, bool)
        for at in positions(a, b, self.number, self.hashes, len(self.bits) * 8):
            ok &= (self.bits[(at >> U(3)).astype(np.int64)] >> (at & U(7)).astype(np.uint8)) & 1 == 1
        return ok


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def listed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Exact for keys of the universe the cascade was built over."""
        out = np.zeros(a.shape, bool)
        alive = np.ones(a.shape, bool)
        for k, level in enumerate(self.levels):
            alive &= level.passes(a, b)
            out[alive] = k % 2 == 0
        return out


def positions(a, b, level: int, hashes: int, size: int):
    """Bit positions of keys given by two 64-bit hashes; every level draws its own."""
    x, y = mix(a + mix(np.array([level + 1], U))), mix(b ^ U(level + 1)) | U(1)
    for i in range(hashes):
        yield mix(x + U(i) * y) % U(size)


def make_level(a: np.ndarray, b: np.ndarray, number: int, rate: float) -> Level:
    """A filter of the given keys that takes other keys with probability ``rate``."""
    size = max(64, math.ceil(len(a) * -math.log(rate) / math.log(2) ** 2))
    hashes = max(1, round(-math.log2(rate)))
    bits = np.zeros((size + 7) // 8, np.uint8)
    for at in positions(a, b, number, hashes, len(bits) * 8):
        np.bitwise_or.at(bits, (at >> U(3)).astype(np.int64), (1 << (at & U(7)).astype(np.int64)).astype(np.uint8))
    return Level(bits, hashes, number)


def with_parts(df: DataFrame, url: str) -> DataFrame:
    """(_row, _host, _path): all columns as one struct, so that none can clash, and the parts of the url column; both are
    empty if it is null or has no ``://``."""
    df = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    spelled = F.col("_row")[url]
    at = F.instr(spelled, "://")
    rest = F.when(at > 0, F.substring(spelled, at + 3, F.length(spelled))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return df.withColumn("_host", host).withColumn("_path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def candidate_keys(lengths: list[int]) -> Column:
    """Host suffixes with path prefixes, the longest keys first; among equally long ones the longest host first."""
    labels = F.split(F.col("_host"), r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")
    )
    # ``cut``: a host longer than a rule's is fine, a path shorter than the rule's is not.
    prefixes = F.filter(F.array(*[F.struct(F.lit(n).alias("n"), F.substring("_path", 1, n).alias("p")) for n in lengths] or [
        F.struct(F.lit(0).alias("n"), F.lit("").alias("p"))]), lambda x: F.length(x["p"]) == x["n"])
    keys = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda x: F.struct(
        (-(F.length(h) + x["n"])).alias("order"), (-F.length(h)).alias("host"), F.concat(h, F.lit("\u0000"), x["p"]).alias("key")))))
    return F.transform(F.array_sort(F.array_distinct(keys)), lambda x: x["key"])


def key_hashes(key: Column) -> tuple[Column, Column]:
    """128 bits of two unrelated hashes: keys that agree in one do not for that reason agree in the other."""
    return F.xxhash64(key), F.conv(F.substring(F.md5(key), 1, 16), 16, -10).cast("long")


def build_cascade(universe: DataFrame, listed: DataFrame) -> Cascade:
    """Cascade over a frame of universe keys (a, b) for the listed ones (a, b), both distinct.

    Level 1 is sized so that about 0.7 times as many other keys as listed ones slip through it, so all later levels
    together need bits in proportion to the list, not to the corpus. Their keys, at most a few times the list, come to
    the driver; the universe itself is filtered where it lies.
    """
    inside = np.array([(r[0], r[1]) for r in listed.collect()], np.int64).reshape(-1, 2).view(U)
    cascade = Cascade()
    if not len(inside):
        return cascade
    others = max(1, universe.count() - len(inside))
    first = min(0.5, len(inside) * math.sqrt(0.5) / others)
    cascade.levels.append(make_level(inside[:, 0], inside[:, 1], 0, first))
    level = universe.sparkSession.sparkContext.broadcast(cascade.levels[0])

    def slipped(batches):
        for frame in batches:
            yield frame[level.value.passes(frame["a"].to_numpy().view(U), frame["b"].to_numpy().view(U))]

    wrong = universe.mapInPandas(slipped, "a long, b long").join(listed, ["a", "b"], "left_anti")
    outside = np.array([(r[0], r[1]) for r in wrong.collect()], np.int64).reshape(-1, 2).view(U)
    enter, other = outside, inside
    while len(enter):
        if len(cascade.levels) >= MAX_LEVELS:
            raise ValueError("two different keys have equal hashes")
        made = make_level(enter[:, 0], enter[:, 1], len(cascade.levels), 0.5)
        cascade.levels.append(made)
        enter, other = other[made.passes(other[:, 0], other[:, 1])], enter
    return cascade


def judge_urls(
    df: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", default: str = "allow"
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row; columns already called so are replaced.

    ``rules`` are (action, host, path) with action ``block`` or ``allow``, at most ``MAX_RULES`` of them. The longest
    fitting key wins (host and path length together, then the longer host); a key in both lists is blocked. Where no
    rule fits, ``rule`` is null and the verdict is ``default``: the cascade has then shown that no key of the url is
    listed. A url that is null, empty or has no ``://`` has an empty host and path and fits rules with neither.
    """
    spark = df.sparkSession
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the limit is {MAX_RULES}")
    rows = with_parts(df.drop("host", "path", "rule", "verdict"), url)
    spoken = {}
    for action, host, path in rules:
        if action not in ("allow", "block"):
            raise ValueError(f"unknown action {action}")
        key = f"{host.translate(str.maketrans(UPPER, LOWER))}\0{path}"
        spoken[key] = "block" if "block" in (action, spoken.get(key)) else "allow"
    lengths = sorted({len(key.partition("\0")[2]) for key in spoken})
    a, b = key_hashes(F.col("key"))
    universe = Stored(
        rows.select(F.explode(candidate_keys(lengths)).alias("key")).select(a.alias("a"), b.alias("b")).distinct(), "keys"
    )
    frame = pd.DataFrame({"key": list(spoken), "action": list(spoken.values())}, dtype=str)
    hashed = spark.createDataFrame(frame, "key string, action string").select("action", a.alias("a"), b.alias("b"))
    found = {
        action: build_cascade(universe.df, hashed.filter(F.col("action") == action).select("a", "b"))
        for action in ("block", "allow")
    }
    universe.drop()
    shared = spark.sparkContext.broadcast(found)

    @F.pandas_udf("struct<at int, action string>")
    def first_listed(left: pd.Series, right: pd.Series) -> pd.DataFrame:
        sizes = np.array([len(x) for x in left], np.int64)
        if not sizes.sum():
            return pd.DataFrame({"at": [None] * len(left), "action": [None] * len(left)})
        x, y = (np.concatenate(list(s)).astype(np.int64).view(U) for s in (left, right))
        block, allow = (shared.value[k].listed(x, y) for k in ("block", "allow"))
        hit = np.flatnonzero(block | allow)
        row = np.repeat(np.arange(len(sizes)), sizes)[hit]
        start = np.cumsum(sizes) - sizes
        first = np.full(len(sizes), -1)
        first[row[::-1]] = hit[::-1]  # the earliest hit of a row is written last
        have = first >= 0
        out = pd.DataFrame({"at": pd.array([None] * len(sizes), "Int32"), "action": [None] * len(sizes)})
        out.loc[have, "at"] = (first - start)[have]
        out.loc[have, "action"] = np.where(block[first[have]], "block", "allow")
        return out

    keyed = rows.withColumn("_keys", candidate_keys(lengths))
    seen = keyed.withColumn(
        "_hit", first_listed(F.transform("_keys", lambda k: key_hashes(k)[0]), F.transform("_keys", lambda k: key_hashes(k)[1]))
    )
    own = [F.col("_row")[c].alias(c) for c in df.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    return seen.select(
        *own, F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.replace(F.get("_keys", F.col("_hit.at")), F.lit("\u0000"), F.lit("")).alias("rule"),
        F.coalesce("_hit.action", F.lit(default)).alias("verdict"),
    )


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

OP7_SQL = """
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(action, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (SELECT page_id, arg_max(h || p, length(h) + length(p)) AS rule, arg_max(action, length(h) + length(p)) AS verdict
    FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (page_id)
"""


@query("op7_bloom_cascade", OP7_SQL)
def op7_bloom_cascade(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages").select("page_id", "url"), RULES).drop("url")

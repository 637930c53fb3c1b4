"""URL rules by a sort-merge range join.

The canonical key of a host is its labels reversed, each followed by a zero
byte (``www.example.com`` -> ``com 0 example 0 www 0``), so a rule's host and all
its subdomains are the keys that start with the rule's key: an interval.  URLs
and rules are dealt into ranges of the key, sorted, and swept once; a stack
holds the rules whose intervals enclose the current key, the innermost on top.

Range bounds come from a bounded sample of URL keys, and a hash of the URL
breaks ties, so a host with a third of all URLs spreads over many ranges.  A
rule goes to every range that its interval overlaps.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import lower_ascii, shuffle_partitions

SAMPLE_PER_RANGE = 64
RANGES_PER_PARTITION = 4
MAX_RANGES = 40_000

#: The rules of query op5.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    labels = F.reverse(F.split(host, r"\."))
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(labels, "\x00"), F.lit("\x00")))


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, action string")


class _Open:
    """The rules of one host that are open in the sweep."""

    __slots__ = ("key", "host", "paths")

    def __init__(self, key: str, host: str):
        self.key, self.host, self.paths = key, host, {}

    def best(self, host: str, path: str) -> tuple[int, str, str] | None:
        if host != self.host and not host.endswith("." + self.host):
            return None
        for n in sorted({len(p) for p in self.paths}, reverse=True):
            if n <= len(path) and (action := self.paths.get(path[:n])) is not None:
                return len(self.host) + n, self.host + path[:n], action
        return None


def _sweep(default: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, stack = None, []
        for b in batches:
            out = []
            for pid, key, kind, host, path, action, page in zip(
                    b["pid"], b["key"], b["kind"], b["host"], b["path"], b["action"], b["page_id"], strict=True):
                if pid != part:
                    part, stack = pid, []
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1].key != key:
                        stack.append(_Open(key, host))
                    # of rules that repeat a host and a path, block wins
                    if stack[-1].paths.get(path) != "block":
                        stack[-1].paths[path] = action
                    continue
                fits = [f for o in stack if (f := o.best(host, path))]
                top = max(fits, key=lambda f: f[0], default=None)
                out.append((page, host, path, top[1] if top else None, top[2] if top else default))
            yield pd.DataFrame(out, columns=["page_id", "host", "path", "rule", "verdict"])
    return run


def judge(urls: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict)``, one row per URL.

    * The rule with the longest host and path wins; where none fits, rule is
      NULL and the verdict ``default``.  NULL URLs have empty host and path.
    * Rules with a NULL or empty host fit nothing; a NULL path is empty and fits
      every path; of rules with equal host and path, block wins.
    * Repeated URLs are judged one by one; an empty table gives no rows.
    """
    spark = urls.sparkSession
    pages = urls.select(F.col(id_col).cast("string").alias("page_id"), host_of(F.col(url_col)).alias("host"),
                        path_of(F.col(url_col)).alias("path"))
    pages = pages.select("*", host_key(F.col("host")).alias("key"), F.xxhash64("page_id", "path").alias("salt"))
    ranges = min(MAX_RANGES, RANGES_PER_PARTITION * shuffle_partitions(spark))
    rate = min(1.0, SAMPLE_PER_RANGE * ranges / max(1, urls.count()))
    sampled = pages.filter(F.pmod(F.xxhash64("salt"), F.lit(1 << 30)) < int((1 << 30) * rate)).select("key", "salt").distinct().collect()
    sampled = sorted((r.key, r.salt) for r in sampled)
    bounds = sorted({sampled[len(sampled) * i // ranges] for i in range(1, ranges)}) if sampled else []

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(pid=[bisect_right(bounds, x) for x in zip(b["key"], b["salt"], strict=True)])

    def cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low = -(1 << 63)
        for b in batches:
            after = [k[:-1] + "\x01" for k in b["key"]]
            b = b.assign(pid=[list(range(bisect_right(bounds, (k, low)), bisect_left(bounds, (a, low)) + 1))
                              for k, a in zip(b["key"], after, strict=True)])
            yield b.explode("pid").astype({"pid": "int64"})

    cols = "page_id string, host string, path string, key string, salt long, kind int, action string"
    rows = pages.select("page_id", "host", "path", "key", "salt", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("action"))
    laws = (rules.filter("host is not null and host <> '' and action is not null")
            .select(lower_ascii(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "action").distinct()
            .select(F.lit(None).cast("string").alias("page_id"), "host", "path", host_key(F.col("host")).alias("key"),
                    F.lit(0).cast("long").alias("salt"), F.lit(0).alias("kind"), "action"))
    both = rows.mapInPandas(place, cols + ", pid long").unionByName(laws.mapInPandas(cover, cols + ", pid long"))
    dealt = both.repartitionByRange(shuffle_partitions(spark), "pid").sortWithinPartitions("pid", "key", "kind")
    return dealt.select("pid", "key", "kind", "host", "path", "action", "page_id").mapInPandas(
        _sweep(default), "page_id string, host string, path string, rule string, verdict string").withColumn(
        "page_id", F.col("page_id").cast("long"))


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(h, q, action) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                           ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (
  SELECT p.page_id, p.host, p.path, arg_max(h || q, length(h || q)) AS rule, arg_max(action, length(h || q)) AS action
  FROM p LEFT JOIN r ON (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, q) GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM best
"""

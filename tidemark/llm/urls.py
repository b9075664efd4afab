"""URL filters: rules become intervals of reversed-host keys, and one sorted sweep keeps a stack of those it is inside."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, cut

#: The rules of the contract as verdict, host and path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Ends the host in a key; below all characters that a path can start with.
HOST_END = "\x01"
#: Keys that are gathered to place the bounds of the ranges, whatever the size of the table.
SAMPLE = 4096
LAST_CHARACTER = "\U0010ffff" * 4


def rules_table(spark: SparkSession, rules: tuple = RULES) -> DataFrame:
    literal = F.array(*[F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules])
    return spark.range(1).select(F.inline(literal))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty without ://."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(has, F.translate(host, UPPER, LOWER)).otherwise(F.lit("")), F.when(has, path).otherwise(F.lit(""))


def _key(host: Column, path: Column) -> Column:
    """Labels of the host from the last to the first, then the path."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(HOST_END), path)


def _bounds(keys: DataFrame, ranges: int) -> list[str]:
    """Keys that part all keys into ranges of about the same size, from a sample of bounded size."""
    n = keys.count()
    if n == 0 or ranges < 2:
        return []
    picked = keys.where(F.pmod(F.xxhash64("key"), F.lit(max(1, n // SAMPLE))) == 0)
    sample = sorted(r[0] for r in picked.select("key").collect())
    return sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []


def _sweep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rules and URLs in order of their keys: a rule is pushed where its interval opens and popped where it has closed."""
    stack: list[tuple[str, str, str]] = []
    part = None
    for frame in frames:
        found = []
        for number, key, is_url, suffix, path, rule, verdict in frame.itertuples(index=False, name=None):
            if number != part:
                part, stack = number, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not is_url:
                stack.append((key, rule, verdict))
            elif stack:
                found.append((suffix, path, stack[-1][1], stack[-1][2]))
        yield pd.DataFrame(found, columns=["suffix", "path", "rule", "verdict"])


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", ranges: int | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict for every row of pages.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest one wins, of two alike the
    verdict that sorts last (block). Without a rule the verdict is the default. Null and malformed URLs have an empty host
    and path. Repeated rows and null ids give a row each. pages needs page_id and url, no other column is read.

    Every URL gets a key for its host and for each domain above it that some rule names, so that a rule is an interval of
    keys that start with its own. A domain and path that many URLs have is one key. Keys are dealt out by range, and a rule
    whose interval reaches over several ranges goes to each; what a key met is then joined back to its URLs. An empty table
    gives an empty one.
    """
    spark = pages.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = url_parts(F.col("url"))
    parsed = pages.select("page_id", "url").select("page_id", "url", host.alias("host"), path.alias("path"))
    distinct = parsed.groupBy("host", "path").agg(F.count("*").alias("n"))
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    rule_rows = rules.groupBy(F.translate("host", UPPER, LOWER).alias("host"), "path").agg(F.max("verdict").alias("verdict"))
    rule_rows = rule_rows.select("host", "path", "verdict", F.concat("host", "path").alias("rule"), _key(F.col("host"), F.col("path")).alias("key"))
    named = rule_rows.select(F.col("host").alias("suffix")).distinct()
    urls = cut(distinct.where(F.col("host") != "").select("host", "path", F.explode(above).alias("suffix")).join(named, "suffix"))
    keys = cut(urls.select("suffix", "path").distinct().withColumn("key", _key(F.col("suffix"), F.col("path"))))
    bounds = _bounds(keys.select("key"), ranges)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: bisect_right(bounds, k)).astype("int32")

    @F.pandas_udf("array<int>")
    def ranges_of(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: list(range(bisect_right(bounds, k), bisect_right(bounds, k + LAST_CHARACTER) + 1)))

    no_text = F.lit(None).cast("string")
    url_events = keys.select(range_of("key").alias("part"), "key", F.lit(True).alias("is_url"), "suffix", "path", no_text.alias("rule"), no_text.alias("verdict"))
    rule_events = rule_rows.select(F.explode(ranges_of("key")).alias("part"), "key", F.lit(False).alias("is_url"), no_text.alias("suffix"), no_text.alias("path"), "rule", "verdict")
    dealt = url_events.unionByName(rule_events).repartitionByRange(max(1, len(bounds) + 1), "part")
    hits = dealt.sortWithinPartitions("part", "key", "is_url").mapInPandas(_sweep, "suffix string, path string, rule string, verdict string")
    best = urls.join(hits, ["suffix", "path"]).groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "verdict")).alias("best"))
    return parsed.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )

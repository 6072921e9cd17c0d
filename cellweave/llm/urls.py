"""Allow and block rules for URLs.

Each URL is expanded into every suffix of its host, whole labels at a time, with those prefixes of its path that are as long as
some rule's path. Expressions meet rules by an equi-join on a short prefix of their digest; the whole digest confirms, and
the longest rule that fits decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm import tables

PREFIX_HEX = 8  # 32 bits
UNMATCHED = "allow"
_PARTS = r"(?s)^.*?://([^/?#]*+)([^?#]*+)"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; empty for null or without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _keyed(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("_digest", F.sha2(F.encode(text, "UTF-8"), 256)).withColumn("_prefix", F.substring("_digest", 1, PREFIX_HEX))


def judge(pages: DataFrame, rules: DataFrame, unmatched: str = UNMATCHED) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages`` (page_id, url).

    ``rules`` are (host, path, verdict). A rule fits its host and all subdomains if the path starts with the rule's. Of several
    that fit the longest rule text wins; of equally long ones the greatest text, of equal texts ``block``. Rules with nulls are
    not used. Null urls and urls without ``://`` have empty host and path and fit no rule with a host. Repeated rows come back
    as often as they came. Equal urls are judged once.
    """
    rules = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").select(
        F.concat("host", "path").alias("rule"), F.concat_ws("\n", "host", "path").alias("_text"), F.length("path").alias("_length"), "verdict"
    )
    rules = rules.groupBy("rule", "_text", "_length").agg(F.max("verdict").alias("verdict"))  # "block" is greater than "allow"
    # distinct lengths are at most as many as the longest rule path has characters
    lengths = sorted(x[0] for x in rules.select("_length").distinct().collect())
    rows = pages.select(F.col("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("_url"))
    urls = rows.select("_url").distinct().select("_url", host(F.col("_url")).alias("host"), path(F.col("_url")).alias("path"))
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    fitting = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("path"))
    texts = F.flatten(F.transform(suffixes, lambda h: F.transform(
        fitting, lambda n: F.concat_ws("\n", h, F.substring("path", F.lit(1), n))
    )))
    expressions = _keyed(urls.select("_url", F.explode(F.array_distinct(texts)).alias("_expression")), "_expression")
    keyed = _keyed(rules, "_text").select("_prefix", F.col("_digest").alias("_whole"), "rule", "verdict")
    keyed = tables.small_side(keyed, 512)
    best = (
        expressions.join(keyed, "_prefix").where("_digest = _whole")
        .groupBy("_url").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("_best"))
    )
    judged = urls.join(best, "_url", "left").select(
        "_url", "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(unmatched)).alias("verdict")
    )
    return rows.join(judged, "_url").select("page_id", "host", "path", "rule", "verdict")

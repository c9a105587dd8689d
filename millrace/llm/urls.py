"""URL filter: host-suffix and path-prefix rules found through short digest prefixes.

Every URL is expanded into the (host suffix, path prefix) expressions that a rule could have, these are joined
with the rules on the first four bytes of their digest, and the full digest confirms the rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ascii_lower

MAX_BROADCAST_RULES = 100_000  # about 20 MB; longer lists are joined by a shuffle


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``(action, host, path)`` triples as a rule table."""
    return spark.createDataFrame(list(rules), "action string, rule_host string, rule_path string")


def prepared(rules: DataFrame) -> DataFrame:
    """Rules with digests and the sizes of their parts. Equal rules count once; of different actions, block wins."""
    return (
        rules.where("rule_host IS NOT NULL AND rule_path IS NOT NULL AND rule_host <> ''")
        .groupBy(ascii_lower(F.col("rule_host")).alias("rule_host"), "rule_path")
        .agg(F.max("action").alias("action"))
        .select(
            "rule_host",
            "rule_path",
            "action",
            _digest(F.col("rule_host"), F.col("rule_path")).alias("rule_digest"),
            F.size(F.split("rule_host", r"\.")).alias("labels"),
            F.length("rule_path").alias("chars"),
        )
    )


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _short(digest: Column) -> Column:
    return F.substring(digest, 1, 8)


def filter_urls(urls: DataFrame, rules: DataFrame, key: str, url: str = "url", default: str = "allow") -> DataFrame:
    """``(key, host, path, rule, verdict)`` for every row of ``urls``.

    A rule fits its host and all subdomains of it if the path of the URL starts with the rule's. The longest rule
    (host and path together, then host) wins, and its action is the verdict; ``default`` is that of URLs without
    a rule. Null URLs and URLs without ``://`` have an empty host and path and no rule. Rows are judged one by
    one: repeated keys stay, null keys too, and other columns of ``urls`` are not read. An empty rule table
    leaves every URL to the default.

    Only suffixes with as many labels, and prefixes with as many characters, as some rule has are expanded.
    """
    known = prepared(rules)
    shape = known.agg(
        F.count("*").alias("n"), F.collect_set("labels").alias("labels"), F.collect_set("chars").alias("chars")
    ).first()
    rows = urls.select(
        F.col(key), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"),
        F.monotonically_increasing_id().alias("_row"),
    )
    if not shape["n"]:
        return rows.select(key, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    parts = F.split("host", r"\.")
    counts = F.array(*[F.lit(n) for n in sorted(shape["labels"])])
    sizes = F.array(*[F.lit(n) for n in sorted(shape["chars"])])
    suffixes = F.transform(
        F.filter(counts, lambda n: n <= F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."),
    )
    prefixes = F.transform(F.filter(sizes, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    digests = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: _digest(h, p))))
    found = known.select(
        _short(F.col("rule_digest")).alias("_short"),
        "rule_digest",
        F.struct(
            F.length(F.concat("rule_host", "rule_path")).alias("size"),
            F.length("rule_host").alias("host_size"),
            F.col("action"),
            F.concat("rule_host", "rule_path").alias("rule"),
        ).alias("_fit"),
    )
    if shape["n"] <= MAX_BROADCAST_RULES:
        found = F.broadcast(found)
    expanded = rows.select("*", F.explode_outer(digests).alias("_digest"))
    joined = expanded.join(
        found, (_short(F.col("_digest")) == F.col("_short")) & (F.col("_digest") == F.col("rule_digest")), "left"
    )
    best = joined.groupBy("_row").agg(
        F.first(key).alias(key), F.first("host").alias("host"), F.first("path").alias("path"), F.max("_fit").alias("_fit")
    )
    return best.select(
        key, "host", "path", F.col("_fit.rule").alias("rule"), F.coalesce("_fit.action", F.lit(default)).alias("verdict")
    )

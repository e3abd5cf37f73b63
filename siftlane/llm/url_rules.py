"""URL rules by hashed host-suffix / path-prefix expressions (operator 7).

Every distinct URL is expanded into the expressions ``<host suffix><path
prefix>`` that a rule could name; an equi-join on a short hash prefix finds
candidate rules, the full SHA-256 digest confirms them and the longest rule
wins.  Host suffixes are cut at label boundaries; path prefixes have the
lengths that occur among the rules, so any rule path matches as a plain string
prefix.  A URL has (labels x distinct rule path lengths) expressions, whatever
the number of rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

#: Bytes of the digest that the join uses.
SHORT_BYTES = 4
#: Verdict of a URL that no rule fits.
DEFAULT_VERDICT = "allow"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffixes(host: Column, labels: list[int]) -> Column:
    """The last n labels of a host, for each n given that it has."""
    has = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    return F.array_compact(F.array(*(F.when(has >= n, F.substring_index(host, ".", -n)) for n in labels)))


def judge_urls(df: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """``df`` with ``host, path, rule, verdict``.

    ``rules`` has ``action`` (allow or block), ``host`` and ``path``; a rule
    fits its host and all subdomains when the URL's path starts with the
    rule's.  The longest rule (host and path together) wins; of equally long
    ones the longer host, then ``block``.  A null URL, and one without
    ``://``, has an empty host and path and fits no rule but one of empty host
    and path.  Rules with a null part are ignored; an empty rule table gives
    every URL the default.  Columns of ``df`` named like the four new ones are
    replaced, all others kept.  URLs are judged once per distinct value, so a
    hot URL is pre-aggregated; the join back onto the rows is left to the
    adaptive skew join.
    """
    key = "__url_key"
    rules = rules.where("action is not null and host is not null and path is not null").select(
        "action", ascii_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path")
    )
    # a handful of integers: only host suffixes and path prefixes as long as those of some rule can fit
    lengths = sorted(r[0] for r in rules.select(F.length("rule_path")).distinct().collect())
    labels = sorted(r[0] for r in rules.select(F.size(F.split("rule_host", r"\.", -1))).distinct().collect())
    rules = rules.select(
        "action",
        F.concat("rule_host", "rule_path").alias("rule"),
        F.length("rule_host").alias("rule_host_len"),
        F.sha2(F.concat_ws("\n", "rule_host", "rule_path"), 256).alias("rule_digest"),
    ).withColumn("short", F.substring("rule_digest", 1, 2 * SHORT_BYTES))

    df = df.drop("host", "path", "rule", "verdict").withColumn(key, F.coalesce(F.col(url), F.lit("")))
    urls = df.select(key).distinct().select(key, url_host(F.col(key)).alias("host"), url_path(F.col(key)).alias("path"))
    if lengths:
        expressions = urls.select(
            key, "path", F.explode(host_suffixes(F.col("host"), labels)).alias("suffix")
        ).select(
            key, "path", "suffix", F.explode(F.array(*map(F.lit, lengths))).alias("n")
        ).where(F.col("n") <= F.length("path")).select(
            key, F.sha2(F.concat_ws("\n", "suffix", F.expr("left(path, n)")), 256).alias("digest")
        ).withColumn("short", F.substring("digest", 1, 2 * SHORT_BYTES))
        best = (
            expressions.join(rules, "short")
            .where(F.col("digest") == F.col("rule_digest"))
            .groupBy(key)
            .agg(F.max(F.struct(F.length("rule").alias("n"), "rule_host_len", "action", "rule")).alias("hit"))
            .select(key, F.col("hit.rule").alias("rule"), F.col("hit.action").alias("action"))
        )
    else:
        best = urls.select(key, F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("action"))
    verdicts = urls.join(best, key, "left").select(key, "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict"))
    return df.join(verdicts, key, "left").drop(key)

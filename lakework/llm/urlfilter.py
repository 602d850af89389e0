"""URL filters by host-suffix and path-prefix expressions.

Each distinct URL is expanded into the expressions that a rule could equal, the
expressions are equi-joined with the rules on a short hash prefix, candidates
are confirmed by their full digests, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakework.llm.common import fresh, small_or_plain, staged

#: The rules of the registered query: (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path.  Null, or no ``://``: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", hash_prefix: int = 8, max_broadcast_rules: int = 50_000, max_broadcast_urls: int = 20_000) -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    A rule fits its host and all subdomains of it, if the path starts with the
    rule's path.  The longest rule (host and path together) wins; of two as long,
    ``block`` does.  Without a rule, ``rule`` is null and the verdict is
    ``default``.  Rules with a null or empty host fit nothing.  A URL that is null
    or has no ``://`` has an empty host and path.  Repeated pages each get their row.

    Only expressions that some rule could equal are made: path prefixes of the
    rules' lengths, host suffixes of the rules' numbers of labels.  So a URL of a
    thousand dots costs no more than another, and prefixes match exactly as strings.

    URLs with a rule are staged and joined back: broadcast if they are few and short,
    else shuffled, where very common URLs are split; a null URL is dealt by its row.
    """
    names = {n: fresh(pages, n) for n in ("host", "path", "rule", "verdict", "best_u", "best_verdict")}
    rules = rules.where("host is not null and host <> '' and path is not null").select(
        F.translate("host", _UPPER, _LOWER).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict")
    )
    # two sets of small integers: how many labels and how many characters rules have
    shape = rules.agg(F.collect_set(F.size(F.split("r_host", r"\."))).alias("labels"), F.collect_set(F.length("r_path")).alias("lengths"), F.count(F.lit(1)).alias("n")).first()
    labels, lengths = sorted(shape.labels) or [1], sorted(shape.lengths) or [0]
    digest = lambda host, path: F.sha2(F.concat(host, F.lit("\n"), path), 256)

    host, path = url_parts(F.col("u"))
    urls = pages.select(F.col(url).cast("string").alias("u")).distinct().select("u", host.alias("host"), path.alias("path"))
    parts = F.split("host", r"\.")
    n = F.size(parts)
    hosts = F.filter(F.transform(F.array(*map(F.lit, labels)), lambda k: F.when(k <= n, F.concat_ws(".", F.slice(parts, n - k + 1, k)))), lambda x: x.isNotNull())
    paths = F.filter(F.transform(F.array(*map(F.lit, lengths)), lambda k: F.when(k <= F.length("path"), F.substring(F.col("path"), F.lit(1), k))), lambda x: x.isNotNull())
    expressions = urls.where("host <> ''").select("u", F.explode(hosts).alias("h"), paths.alias("ps")).select("u", "h", F.explode("ps").alias("p"))
    expressions = expressions.select("u", digest(F.col("h"), F.col("p")).alias("d")).withColumn("short", F.substring("d", 1, hash_prefix))

    table = rules.withColumn("r_digest", digest(F.col("r_host"), F.col("r_path"))).withColumn("r_short", F.substring("r_digest", 1, hash_prefix))
    table = small_or_plain(table, max_broadcast_rules, "r_host", "r_path", "r_verdict", "r_digest")
    hits = expressions.join(table, F.col("short") == F.col("r_short")).where(F.col("d") == F.col("r_digest"))
    rule = F.concat("r_host", "r_path")
    best = hits.groupBy("u").agg(F.max(F.struct(F.length(rule).alias("n"), (F.col("r_verdict") == "block").alias("b"), rule.alias("rule"), F.col("r_verdict").alias("verdict"))).alias("best"))
    best = best.select(F.col("u").alias(names["best_u"]), F.col("best.rule").alias(names["rule"]), F.col("best.verdict").alias(names["best_verdict"]))
    best = small_or_plain(staged(best, "urls"), max_broadcast_urls, names["best_u"], names["rule"], bytes_=4 << 20)

    # only URLs with a rule come back; hosts and paths are plain expressions of the row
    host, path = url_parts(F.col(f"`{url}`").cast("string"))
    # a null's stand-in has no ://, so it equals no URL that has a rule
    key = F.coalesce(F.col(f"`{url}`").cast("string"), F.concat(F.lit("\n"), F.xxhash64(*(f"`{f.name}`" for f in pages.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString())).cast("string")))
    joined = pages.join(best, key == F.col(names["best_u"]), "left")
    columns = [pages[f"`{c}`"] for c in pages.columns]
    return joined.select(*columns, host.alias(names["host"]), path.alias(names["path"]), F.col(names["rule"]), F.coalesce(names["best_verdict"], F.lit(default)).alias(names["verdict"]))

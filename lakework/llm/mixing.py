"""Mixing sources to target weights by Poisson replication.

Every document is repeated as often as a Poisson variable says whose mean is
its source's target repetition rate.  The variable inverts the distribution at
a uniform number hashed from the document's id, so the same corpus always gives
the same sample, whatever the partitions.  Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakework.llm.common import fresh, staged

#: 52 bits of a hash are a double exactly.
_BITS = 52


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 13 hex digits of the MD5 of ``seed:key``; a null key hashes as ``null``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, _BITS // 4), 16, 10).cast("double") / F.lit(float(1 << _BITS))


def poisson_cdf(rate: Column) -> Column:
    """The cumulative Poisson probabilities of 0, 1, ... as an array; empty for a rate of 0.

    It ends at ``rate + 9 * sqrt(rate) + 20``, beyond which less than 2**-52 remains.
    Terms come from logarithms, so large rates don't underflow.
    """
    ks = F.sequence(F.lit(0), F.ceil(rate + 9 * F.sqrt(rate) + 20).cast("int"))
    start = F.struct(F.lit(0.0).alias("log_term"), F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("cdf"))

    def step(s, k):
        log_term = F.when(k == 0, -rate).otherwise(s["log_term"] + F.ln(rate) - F.ln(F.greatest(k, F.lit(1)).cast("double")))
        total = s["sum"] + F.exp(log_term)
        return F.struct(log_term.alias("log_term"), total.alias("sum"), F.array_append(s["cdf"], total).alias("cdf"))

    return F.when(rate > 0, F.aggregate(ks, start, step, lambda s: s["cdf"])).otherwise(F.array().cast("array<double>"))


def poisson(u: Column, cdf: Column) -> Column:
    """The least k whose cumulative probability exceeds ``u``; 0 for a null or empty array."""
    return F.coalesce(F.size(F.filter(cdf, lambda c: c <= u)), F.lit(0))


def target_rates(docs: DataFrame, weights: dict[str, float] | None = None, source: str = "source", temperature: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """(source, n_docs, rate): mean repetitions that bring each source to its target share of documents.

    ``weights`` are relative targets; a source without one gets none.  Without
    ``weights`` the targets are the sources' sizes to the power ``temperature``: 1
    leaves the mixture as it is, 0 makes all sources equal.  The result has
    ``epochs`` times as many documents on average as ``docs``.  A null source is a
    source of its own.
    """
    sizes = docs.groupBy(F.col(source).cast("string").alias("source")).agg(F.count(F.lit(1)).alias("n_docs"))
    if weights is None:
        weight = F.pow(F.col("n_docs").cast("double"), F.lit(float(temperature)))
    else:
        if any(w < 0 or not math.isfinite(w) for w in weights.values()):
            raise ValueError("weights must be finite and not negative")
        table = F.create_map(*(F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1])))) if weights else None
        weight = F.coalesce(F.try_element_at(table, F.col("source")), F.lit(0.0)) if weights else F.lit(0.0)
    sizes = sizes.withColumn("weight", weight)
    # one row: an aggregate without keys over one row per source
    totals = sizes.agg(F.sum("n_docs").alias("all_docs"), F.sum("weight").alias("all_weight"))
    rate = F.col("weight") / F.col("all_weight") * F.col("all_docs") * F.lit(float(epochs)) / F.col("n_docs")
    return sizes.join(F.broadcast(totals), F.lit(True)).select("source", "n_docs", F.when(F.col("all_weight") > 0, rate).otherwise(0.0).alias("rate"))


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    source: str = "source",
    doc_id: str = "doc_id",
    temperature: float = 0.5,
    epochs: float = 1.0,
    seed: str = "mix",
    max_broadcast_numbers: int = 1_000_000,
    details: bool = True,
) -> DataFrame:
    """``docs`` with each row repeated by its Poisson count, shuffled globally.

    With ``details``: also ``copy`` (from 0), ``copies``, ``rate`` and
    ``shuffle_key``, under other names if ``docs`` has those.  Rows with the same
    id get the same count; a null id hashes as ``null:`` and a hash of the whole row, so
    rows without ids have counts and places of their own.  Texts of any length are only
    moved.  An empty table gives an empty result.

    A copy's place is a hash of (id, copy): partitions by it are even, whatever the
    sources' sizes, and each is in its order.  Unlike a range sort, that reads the
    documents once.  Distributions are computed once a source; they are broadcast if
    they are under ``max_broadcast_numbers`` numbers together, else joined by a shuffle.
    Rows that repeat one id have one place; they are dealt by the partition that they
    come from as well, so that no task gets all of them.
    """
    names = {n: fresh(docs, n) for n in ("copy", "copies", "rate", "shuffle_key")}
    rates = target_rates(docs, weights, source, temperature, epochs)
    rates = staged(rates.select(F.col("source").alias("_mix_source"), F.col("rate").alias("_mix_rate"), poisson_cdf(F.col("rate")).alias("_mix_cdf")), "rates")
    numbers = rates.agg(F.sum(F.size("_mix_cdf") + 8)).first()[0] or 0
    rates = F.broadcast(rates) if numbers <= max_broadcast_numbers else rates
    columns = [f"`{c}`" for c in docs.columns]
    hashed = [f"`{f.name}`" for f in docs.schema if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    whole = F.xxhash64(*hashed).cast("string")
    row = docs.select(F.struct(*columns).alias("row"), F.col(source).cast("string").alias("s"), F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("null:"), whole)).alias("d"))
    counted = row.join(rates, F.col("s").eqNullSafe(F.col("_mix_source")), "left").withColumn("n", poisson(uniform(F.col("d"), seed), F.col("_mix_cdf")))
    copies = counted.where("n > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    key = F.md5(F.concat(F.lit(f"{seed}-order:"), F.col("d"), F.lit(":"), F.col("copy").cast("string")))
    shuffled = copies.drop("_mix_cdf").withColumns({"k": key, "from": F.spark_partition_id()}).repartition("k", "from").sortWithinPartitions("k")
    own = [F.col("row")[c].alias(c) for c in docs.columns]
    if not details:
        return shuffled.select(*own)
    return shuffled.select(*own, F.col("copy").alias(names["copy"]), F.col("n").alias(names["copies"]), F.col("_mix_rate").alias(names["rate"]), F.col("k").alias(names["shuffle_key"]))

"""Mixing sources to target weights by Poisson replication.

A source of size ``s`` (characters) that should make up the share ``w`` of a corpus as large as the input gets the
mean repetition rate ``w * total / s``. Each document's count is a Poisson variable of that mean, by inversion of a
uniform number that an MD5 of seed and id gives: the same document gets the same count in every run and on every
machine. Means over ``PART`` are drawn as a sum of equal parts, so that the table to invert stays short. Documents
are repeated by their counts and ordered by a second hash of id and replica, which shuffles them globally.

Statistics are one row per source; they are broadcast only up to ``BROADCAST_SOURCES`` rows, and joined by shuffle
beyond. A null source is a source of its own, apart from the empty one. Documents of sources that the weights don't
name, and of sources without a character, get none. Rows with a null id are hashed by their text; repeated rows get
equal counts and lie together. Null texts have size 0. An empty table gives an empty one. Other columns pass
through; ``replica`` and ``shuffle_key`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, let, staged

SEED, TEMPERATURE = 20, 0.5
PART = 64.0
BROADCAST_SOURCES = 10_000
KEY, BITS = "__source", 52


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _hashed(*parts: Column) -> Column:
    """The first 52 bits of an MD5, as a whole number."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, BITS // 4), 16, 10).cast("bigint")


def _table(mean: Column) -> Column:
    """The cumulative probabilities of a Poisson variable of a mean up to PART, until they stay below 1 by rounding only."""
    last = (mean + 12 * F.sqrt(mean) + 30).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))

    def step(a: Column, k: Column) -> Column:
        p = a["p"] * mean / k
        return F.struct(p.alias("p"), F.array_append(a["c"], F.element_at(a["c"], -1) + p).alias("c"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda a: a["c"])


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """(``__source``, ``rate``) per source. Without weights, a share is in proportion to the size to the power of the temperature."""
    sizes = staged(docs.groupBy(_key(F.col("source")).alias(KEY)).agg(F.sum(F.length(F.coalesce("text", F.lit("")))).cast("double").alias("size")), "source-sizes", 8)
    if weights is None:
        wanted = sizes.withColumn("weight", F.pow("size", F.lit(temperature)))
    else:
        named = F.map_from_arrays(F.array(*[F.lit("" if k is None else f"={k}") for k in weights]), F.array(*[F.lit(float(v)) for v in weights.values()]))
        wanted = sizes.withColumn("weight", F.coalesce(F.try_element_at(named, F.col(KEY)), F.lit(0.0)))
    total = wanted.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    if not (total["size"] and total["weight"]):
        return wanted.select(KEY, F.lit(0.0).alias("rate"))
    rate = F.when(F.col("size") > 0, F.col("weight") / F.lit(total["weight"]) * F.lit(total["size"]) / F.col("size")).otherwise(F.lit(0.0))
    return wanted.select(KEY, rate.alias("rate"))


def replicated(docs: DataFrame, weights: dict[str | None, float] | None = None, seed: int = SEED, temperature: float = TEMPERATURE) -> DataFrame:
    """``docs``, each row repeated by its count, with ``replica`` (from 1) and ``shuffle_key``, in the order of that key."""
    key, parts, table, n = (fresh(c, docs.columns) for c in (KEY, "__parts", "__table", "__n"))
    of = rates(docs, weights, temperature).withColumnRenamed(KEY, key)
    of = of.withColumn(parts, F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int")).withColumn(table, _table(F.col("rate") / F.col(parts))).select(key, parts, table)
    own = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    uniform = lambda j: (_hashed(F.lit(str(seed)), j.cast("string"), own) + 0.5) / 2.0**BITS
    draw = lambda j: let(uniform(j), lambda u: F.size(F.filter(table, lambda c: c <= u)))
    count = F.aggregate(F.transform(F.sequence(F.lit(1), F.col(parts)), draw), F.lit(0), lambda a, x: a + x)
    columns = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("replica", "shuffle_key")]
    few = of.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    counted = docs.select(*columns, _key(F.col("source")).alias(key)).join(F.broadcast(of) if few else of, key).withColumn(n, count)
    each = counted.filter(F.col(n) > 0).select(*columns, F.explode(F.sequence(F.lit(1), F.col(n))).alias("replica"))
    return each.withColumn("shuffle_key", _hashed(F.lit(str(seed)), F.lit("order"), own, F.col("replica").cast("string"))).orderBy("shuffle_key", "doc_id", "replica")

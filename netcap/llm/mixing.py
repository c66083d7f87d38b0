"""Operator 3 - mixing sources to target weights by Poisson replication.

A source with target share w, of a mix with ``total`` expected rows, gives
each of its n documents a mean repetition rate w * total / n. The number of
copies of a document is the inverse of the Poisson distribution with that
mean at a uniform number hashed from (seed, doc_id): it needs no state, and a
task that runs again gives the same copies. Rates above ``MAX_RATE`` are drawn as a
sum of equal, independent parts (a sum of Poisson counts is Poisson), so the
distribution table has a fixed length and no mass is cut off. Copies
are then shuffled globally by a 60-bit hash of (seed, doc_id, copy).

``mix`` returns the chosen copies with their place in the global order;
``mix_documents`` the documents themselves, repeated and in shuffled order.
Sources are counted with map-side aggregation; the documents join the rates on
source, the small side having one row per source, and a hot source is
split by AQE. Places are counted per shard of the hash range and offset by
the shards before, in two levels (shards of a block, blocks), so that no task sorts
everything. Rates and shard sizes are written once: both are used several times.

Default target: shares proportional to n ** ``ALPHA`` (0.5 lifts small
sources), and as many expected rows as there are documents.

Defined results: a null source is a source of its own; a null doc_id is
hashed as an empty id; rows with the same doc_id and source get equal counts and
hashes, ties in the order then being equal rows. A source without a weight in
given weights gets none. Empty text and empty tables need no special case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from netcap.llm.common import hex_long, hex_unit, written

SEED = 42
ALPHA = 0.5
MAX_RATE = 16.0          # mean of one Poisson draw; larger rates are summed draws
CDF_LENGTH = 96          # at mean 16 the mass beyond is under 2 ** -52
ROWS_PER_SHARD = 16384   # expected rows of one shard of the global order
SHARDS_PER_BLOCK = 4096  # a block of shards is some 67 million rows
HASH_BITS = 60


def source_rates(docs: DataFrame, weights: dict | None = None, total: float | None = None,
                 alpha: float = ALPHA) -> DataFrame:
    """source, n, rate: one row per source; ``total`` expected rows in all."""
    n = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        w = F.pow(F.col("n").cast("double"), F.lit(alpha))
    else:
        pairs = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        w = F.coalesce(F.create_map(*pairs)[F.col("source")], F.lit(0.0)) if pairs else F.lit(0.0)
    n = n.withColumn("w", w)
    sums = n.agg(F.sum("w").alias("w"), F.sum("n").alias("n"))
    rows = F.lit(float(total)) if total is not None else sums.select("n").scalar().cast("double")
    return n.select("source", "n", F.try_divide(
        F.col("w") * rows, sums.select("w").scalar() * F.col("n")).alias("rate"))


def poisson_cdf(mean: Column) -> Column:
    """P(X <= k) for k = 0 .. CDF_LENGTH - 1 as an array."""
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), F.array(first).alias("cdf"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(CDF_LENGTH - 1)), start,
        lambda acc, k: F.struct(
            (acc["p"] * mean / k).alias("p"),
            F.array_append(acc["cdf"], F.element_at(acc["cdf"], -1) + acc["p"] * mean / k)
            .alias("cdf")),
        lambda acc: acc["cdf"])


def _copies(docs: DataFrame, rates: DataFrame, seed: int) -> DataFrame:
    """``docs`` (with columns ``doc_id``, ``source``, others kept) by copy."""
    rates = (rates.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / MAX_RATE)))
             .withColumn("cdf", poisson_cdf(F.col("rate") / F.col("parts")))
             .withColumnRenamed("source", "rate_source"))
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))

    def uniform(j):
        return hex_unit(F.md5(F.concat_ws(":", F.lit(str(seed)), id_text, j.cast("string"))))

    joined = docs.join(rates, F.col("source").eqNullSafe(F.col("rate_source")))
    # Uniforms first: inside the inner function they would be hashed per table entry.
    uniforms = F.transform(F.sequence(F.lit(1).cast("long"), F.col("parts")), uniform)
    drawn = joined.withColumn("copies", F.aggregate(
        uniforms, F.lit(0), lambda a, u: a + F.size(F.filter("cdf", lambda c: c <= u)))).drop(
            "cdf", "parts", "rate_source", "n")
    key = hex_long(F.md5(F.concat_ws(":", F.lit(f"{seed}s"), id_text, F.col("copy").cast("string"))),
                   HASH_BITS // 4)
    return (drawn.filter(F.col("copies") > 0)
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .withColumn("shuffle_key", key))


def _shard(rates: DataFrame) -> Column:
    expected = rates.agg(F.coalesce(F.sum(F.col("rate") * F.col("n")), F.lit(0.0))).scalar()
    shards = F.greatest(F.lit(1), F.ceil(expected / ROWS_PER_SHARD)).cast("long")
    width = F.lit(1 << HASH_BITS).cast("long")
    return F.floor(F.col("shuffle_key") / F.ceil(width / shards)).cast("long")


def mix(docs: DataFrame, weights: dict | None = None, total: float | None = None,
        seed: int = SEED, alpha: float = ALPHA) -> DataFrame:
    """doc_id, source, rate, copies, copy (from 1), shuffle_key, place (from 0)."""
    spark, docs = docs.sparkSession, docs.select("doc_id", "source")
    rates = written(spark, source_rates(docs, weights, total, alpha), "op3-rates")
    chosen = _copies(docs, rates, seed).withColumn("shard", _shard(rates))
    sizes = written(spark, chosen.groupBy("shard").agg(F.count("*").alias("size")), "op3-shards")
    sizes = sizes.withColumn("block", F.floor(F.col("shard") / SHARDS_PER_BLOCK))
    before = sizes.select("block", "shard", (F.sum("size").over(
        Window.partitionBy("block").orderBy("shard")) - F.col("size")).alias("in_block"))
    # One row per block goes through one task.
    blocks = sizes.groupBy("block").agg(F.sum("size").alias("size"))
    blocks = blocks.select("block", (F.sum("size").over(Window.orderBy("block"))
                                     - F.col("size")).alias("before_block"))
    before = before.join(blocks, "block").select(
        "shard", (F.col("before_block") + F.col("in_block")).alias("before"))
    ranked = chosen.withColumn("r", F.row_number().over(
        Window.partitionBy("shard").orderBy("shuffle_key", "doc_id", "copy", "source")))
    return ranked.join(before, "shard").select(
        "doc_id", "source", "rate", "copies", "copy", "shuffle_key",
        (F.col("before") + F.col("r") - 1).alias("place"))


def mix_documents(docs: DataFrame, weights: dict | None = None, total: float | None = None,
                  seed: int = SEED, alpha: float = ALPHA) -> DataFrame:
    """The documents, all their columns, once per copy, in shuffled order: the
    partitions follow the hash, and so do the rows in each."""
    names = docs.columns
    own = [c for c in names if c not in ("doc_id", "source")]
    # Other columns travel as one struct, so that their names can't clash.
    packed = docs.select("doc_id", "source", F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in own])
                         .alias("rest"))
    rates = source_rates(packed.select("source"), weights, total, alpha)
    chosen = (_copies(packed, rates, seed).repartitionByRange("shuffle_key")
              .sortWithinPartitions("shuffle_key", "doc_id", "copy"))
    return chosen.select(*[F.col(c) if c in ("doc_id", "source") else F.col(f"rest.`{c}`")
                           for c in names])

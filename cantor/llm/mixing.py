"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate: target weight times the wanted size over the size there is. A uniform
number from a hash of seed and document id is put through the inverse Poisson distribution of that mean (a mean over
MOST_MEAN is the sum of equal smaller ones, each with a number of its own, which is Poisson again); the document is exploded by the count, and the copies are dealt over all partitions by a hash and sorted by it.

Native: only DataFrame functions. The rate table has a row per source. Up to MAX_BROADCAST sources it is
broadcast; beyond that it is joined by shuffle, where adaptive execution splits a hot source.

Defined results: null sources form a source of their own; null texts count 0 characters, and a source without a
character has rate 1. Rows with the same id draw the same count. A null id hashes as the text 'null'. An empty
table gives an empty result. Columns of the input that bear the name of a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import materialize

SEED = 17
MAX_BROADCAST = 10_000
#: Rates are kept in millionths, so that every engine sees the same numbers.
UNIT = 1_000_000
#: The largest mean of one draw, as exp(-mean) runs out of digits.
MOST_MEAN = 30


def uniform(text: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a text's MD5."""
    return F.conv(F.substring(F.md5(text.cast("string")), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def rates(docs: DataFrame, weights: dict[str, float] | None = None, budget: float = 1.0, source: str = "source", text: str = "text") -> DataFrame:
    """A row per source: its mean repetition rate in millionths and the steps of its distribution.

    weights: target weight by source; a source that isn't named gets 0. None: the square root of its size, which
    lifts small sources. budget: wanted size as a multiple of the size there is.
    """
    sizes = docs.groupBy(F.col(source).alias("_source")).agg(F.sum(F.coalesce(F.length(text), F.lit(0)).cast("long")).alias("_size"))
    if weights is None:
        wanted = F.sqrt(F.col("_size").cast("double"))
    else:
        pairs = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        wanted = F.coalesce(F.create_map(*pairs)[F.col("_source")], F.lit(0.0)) if pairs else F.lit(0.0)
    sizes = materialize(sizes.withColumn("_wanted", wanted), "sources")  # a row per source; read twice
    total = sizes.agg(F.sum("_size").alias("n"), F.sum("_wanted").alias("w")).first()
    scale = budget * (total["n"] or 0) / (total["w"] or 1.0)
    rate = F.when(F.col("_size") == 0, UNIT).otherwise(F.round(F.lit(scale) * F.col("_wanted") / F.col("_size") * UNIT)).cast("long")
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate_ppm") / (UNIT * MOST_MEAN))).cast("long")
    mean = F.col("rate_ppm").cast("double") / UNIT / F.col("_draws")
    steps = F.ceil(F.col("_mean") + 12 * F.sqrt("_mean") + 20).cast("int")
    first = F.exp(-F.col("_mean"))
    grow = lambda a, k: F.struct((a["p"] * F.col("_mean") / k).alias("p"), (a["c"] + a["p"] * F.col("_mean") / k).alias("c"), F.concat(a["all"], F.array(a["c"] + a["p"] * F.col("_mean") / k)).alias("all"))
    table = sizes.withColumn("rate_ppm", rate).withColumn("_draws", draws).withColumn("_mean", mean)
    cdf = F.aggregate(F.sequence(F.lit(1), steps), F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("all")), grow, lambda a: a["all"])
    return table.select("_source", "rate_ppm", "_draws", cdf.alias("_cdf"))


def replicate(docs: DataFrame, weights: dict[str, float] | None = None, budget: float = 1.0, seed: int = SEED, key: str = "doc_id", source: str = "source", text: str = "text", shuffle: bool = True) -> DataFrame:
    """The input's rows, each repeated by its Poisson count, with rate_ppm, copies, copy and shuffle_key."""
    table = rates(docs, weights, budget, source, text)
    if table.count() <= MAX_BROADCAST:
        table = F.broadcast(table)
    else:
        table = table.hint("shuffle_merge")
    new = ("rate_ppm", "copies", "copy", "shuffle_key")
    columns = [F.col(c) for c in docs.columns if c not in new]
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    below = lambda u: F.size(F.filter("_cdf", lambda c: c <= u)).cast("long")
    joined = docs.select(*columns).join(table, F.col(source).eqNullSafe(F.col("_source"))).withColumn("_u", uniform(name))
    more = lambda n, j: n + below(uniform(F.concat_ws(":", name, j.cast("string"))))
    further = F.when(F.col("_draws") > 1, F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(F.lit(1), F.col("_draws") - 1)), F.lit(0).cast("long"), more)).otherwise(0)
    counted = joined.withColumn("copies", below(F.col("_u")) + further).where("copies > 0")
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    place = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"{seed}s"), F.coalesce(F.col(key).cast("string"), F.lit("null")), F.col("copy").cast("string"))), 1, 15), 16, 10).cast("long")
    result = copies.withColumn("shuffle_key", place).drop("_source", "_draws", "_cdf", "_u")
    if not shuffle:
        return result
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return result.repartition(parts, "shuffle_key").sortWithinPartitions("shuffle_key")

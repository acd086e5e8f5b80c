"""Mixing sources to target weights by Poisson replication.

Each source has a mean repetition rate = its target share of the mixture's characters over its own characters. A
document's number of copies is the inverse of the Poisson distribution with that mean at a uniform number hashed
from the seed and the document's id, whatever the mean, so it is the same on every run and for every partitioning. Copies are exploded
and dealt to random places of the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexledger.llm.common import partitions, row_of, small_side, written

#: Target share of a source without an explicit weight: its characters to this power, then normalised.
TEMPERATURE = 0.5
SEED = "mix-1"
#: Values from this one on have an accurate logarithm of their factorial in closed form.
STIRLING_FROM = 64


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an md5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


def log_factorial(n: Column) -> Column:
    """Stirling's series; from STIRLING_FROM on as accurate as a double."""
    return n * F.log(n) - n + 0.5 * F.log(2 * F.pi() * n) + 1 / (12 * n) - 1 / (360 * n**3) + 1 / (1260 * n**5)


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, epochs: float = 1.0, temperature: float = TEMPERATURE) -> DataFrame:
    """(source, chars, rate, low, cdf): a row per source. cdf: the Poisson distribution function from ``low`` on, where
    that lies so far below the rate that what is left out has no weight in a double; its length grows with the root
    of the rate.

    Explicit weights need not sum to 1; sources missing from them get none of the mixture. Null is a source of its
    own, with None as its key, and so is the empty string. A source without characters has no share of the mixture; it
    gets rate 1 unless weights leave it out. Weights that are negative, or that give a corpus with characters none of
    them, are an error.
    """
    if weights is not None and (min(weights.values(), default=0.0) < 0 or not any(weights.values())):
        raise ValueError("weights must not be negative, and one of them must be more than 0")
    chars = docs.groupBy("source").agg(F.sum(F.length(F.coalesce("text", F.lit(""))).cast("double")).alias("chars"))
    if weights is None:
        weight, listed = F.pow(F.col("chars"), F.lit(temperature)), F.lit(True)
    else:
        named = [x for k, v in weights.items() if k is not None for x in (F.lit(k), F.lit(float(v)))]
        given = F.try_element_at(F.create_map(*named), F.col("source")) if named else F.lit(None).cast("double")
        given = F.when(F.col("source").isNull(), F.lit(weights.get(None))).otherwise(given).cast("double")
        weight, listed = F.when(F.col("chars") == 0, 0.0).otherwise(F.coalesce(given, F.lit(0.0))), given.isNotNull()
    shares = written(chars.withColumns({"weight": weight, "listed": listed}), "source-sizes")
    total = shares.agg(F.sum("chars").alias("chars"), F.sum("weight").alias("weight")).first()
    if total["chars"] and not total["weight"]:
        raise ValueError("no source with characters has a weight")
    per_weight = epochs * (total["chars"] or 0.0) / (total["weight"] or 1.0)
    bare = F.when(F.col("listed"), 1.0).otherwise(0.0)
    out = shares.select("source", "chars", F.when(F.col("chars") == 0, bare).otherwise(F.lit(per_weight) * F.col("weight") / F.col("chars")).alias("rate"))
    rate, reach = F.col("rate"), 12 * F.sqrt("rate") + 20
    out = out.withColumn("low", F.when(rate - reach < STIRLING_FROM, F.lit(0)).otherwise(F.floor(rate - reach)).cast("int"))
    low = F.col("low").cast("double")
    first = F.when(F.col("low") == 0, F.exp(-rate)).otherwise(F.exp(low * F.log(rate) - rate - log_factorial(low)))
    start = F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("cdf"))

    def step(acc: Column, i: Column) -> Column:
        p = acc["p"] * rate / i
        return F.struct(p.alias("p"), (acc["c"] + p).alias("c"), F.array_append(acc["cdf"], acc["c"] + p).alias("cdf"))

    top = F.ceil(rate + reach).cast("int")
    return out.withColumn("cdf", F.aggregate(F.sequence(F.col("low") + 1, top), start, step)["cdf"])


def replicated(docs: DataFrame, weights: dict[str | None, float] | None = None, epochs: float = 1.0, temperature: float = TEMPERATURE, seed: str = SEED) -> DataFrame:
    """(row, copy, shuffle_key): each row of docs, as a struct, as often as it is drawn; in random order within and
    over partitions."""
    spark = docs.sparkSession
    per_source = small_side(written(rates(docs, weights, epochs, temperature), "rates").select(F.col("source").alias("of"), "low", "cdf"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    drawn = docs.select(row_of(docs).alias("row"), key.alias("key")).withColumn("u", uniform(F.lit(seed), F.lit("1"), F.col("key")))
    drawn = drawn.join(per_source, F.col("row.source").eqNullSafe(F.col("of"))).withColumn("n", F.col("low") + F.size(F.filter("cdf", lambda c: c <= F.col("u"))))
    each = drawn.where("n > 0").select("row", "key", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    place = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.lit("place"), F.col("key"), F.col("copy").cast("string"))), 1, 15), 16, 10).cast("bigint")
    n = partitions(spark)
    slot = F.floor(F.col("shuffle_key") / F.lit(2.0**60) * n).cast("int")
    out = each.select("row", "copy", place.alias("shuffle_key"))
    return out.repartitionById(n, F.least(slot, F.lit(n - 1))).sortWithinPartitions("shuffle_key")


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, epochs: float = 1.0, temperature: float = TEMPERATURE, seed: str = SEED) -> DataFrame:
    """The mixture: docs' columns plus ``copy`` (from 1) and ``shuffle_key``, in random order within and over partitions.

    Rows with equal doc_id (or, where that is null, equal text) draw the same number. Null text is kept and weighs
    nothing. Empty table: no rows. Columns named copy or shuffle_key in the input are replaced; other columns are
    carried along, whatever their names.
    """
    return replicated(docs.drop("copy", "shuffle_key"), weights, epochs, temperature, seed).select("row.*", "copy", "shuffle_key")

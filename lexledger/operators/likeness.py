"""Names at most a few edits apart, without comparing all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Length of the grams, and the most edits that names may be apart.
Q, MOST = 2, 3
_PAD = "\x00"


def _grams(name: Column) -> Column:
    """The grams of a padded name; the n-th of equal ones is another gram than the first."""
    padded = F.concat(F.lit(_PAD * (Q - 1)), name, F.lit(_PAD * (Q - 1)))
    all_ = F.transform(F.sequence(F.lit(1), F.length(padded) - (Q - 1)), lambda i: F.substring(padded, i, F.lit(Q)))
    return F.transform(all_, lambda g, i: F.concat(g, F.size(F.filter(F.slice(all_, F.lit(1), i + 1), lambda x: x == g)).cast("string")))


def _shortened(name: Column, most: int) -> Column:
    """A short name and all that is left of it after up to ``most`` deletions."""
    out = F.array(name)
    for _ in range(most):
        cut = F.flatten(F.transform(out, lambda s: F.transform(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))), lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))))))
        out = F.array_distinct(F.concat(out, cut))
    return out


def alike(left: DataFrame, right: DataFrame, most: int = MOST) -> DataFrame:
    """(left_name, right_name, distance): all pairs of different-side names (columns ``name``) at most ``most`` edits
    apart, equal ones included; each pair of names once, however often they occur. Null names are like nothing.

    Names within k edits share at least (length of the longer + Q - 1 - k * Q) of their grams. So if the k * Q + 1 rarest
    grams of each are taken, two of them are equal; these are joined, with lengths that fit, and the pairs verified.
    Where that bound is no use, since both names are shorter than it needs, names are joined by what is left of them
    after k deletions. Rare grams are no hot keys, and repeated names are one.
    """
    if not 0 <= most <= MOST:
        raise ValueError(f"most must be between 0 and {MOST}")
    prefix, short = most * Q + 1, (most - 1) * Q + 1
    sides = [df.select("name").where("name IS NOT NULL").distinct().withColumn("side", F.lit(k)) for k, df in enumerate((left, right))]
    names = sides[0].unionByName(sides[1]).withColumn("n", F.length("name"))
    grams = names.select("side", "name", "n", F.explode(_grams(F.col("name"))).alias("gram"))
    counts = grams.groupBy("gram").agg(F.count("*").alias("c"))
    ranked = grams.join(counts, "gram").withColumn("r", F.row_number().over(Window.partitionBy("side", "name").orderBy("c", "gram"))).where(F.col("r") <= prefix)
    less = names.where(F.col("n") <= short).select("side", "name", "n", F.explode(_shortened(F.col("name"), most)).alias("gram"))

    def met(keys: DataFrame) -> DataFrame:
        a, b = (keys.where(F.col("side") == k).select("gram", F.col("name").alias(f"{s}_name"), F.col("n").alias(f"{s}_n")) for k, s in ((0, "left"), (1, "right")))
        return a.join(b, "gram").where(F.abs(F.col("left_n") - F.col("right_n")) <= most).select("left_name", "right_name")

    pairs = met(ranked).unionByName(met(less)).distinct()
    return pairs.withColumn("distance", F.levenshtein("left_name", "right_name", most)).where("distance >= 0")

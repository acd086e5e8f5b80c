"""Document fingerprints: mergeable bottom-k sketches of word-shingle hashes, in built-in functions only.

A sketch is the sorted array of the k smallest 48-bit hashes of a text's distinct five-word shingles (lower case,
words split at ASCII white space; a text of fewer words is one shingle; no words: the empty sketch). Sketches of
parts merge into the sketch of the whole. Null text counts as empty. Equal texts have equal sketches.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Retained hashes. A likeness j is estimated with standard error sqrt(j(1-j)/K), and exactly below K shingles.
K = 128
SHINGLE_WORDS = 5
HASH_BITS = 48
_BLANKS = r" \t\n\x0B\f\r"


def words(text: Column) -> Column:
    """Lower-case words; an empty array for null or blank text."""
    trimmed = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), rf"^[{_BLANKS}]+|[{_BLANKS}]+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{_BLANKS}]+"))


def sketch(word_array: Column, k: int = K) -> Column:
    """Bottom-k sketch (array<bigint>) of an array of words."""
    n = F.size(word_array)
    starts = F.sequence(F.lit(1), F.greatest(n - (SHINGLE_WORDS - 1), F.lit(1)))
    hashes = F.transform(starts, lambda i: F.shiftrightunsigned(F.xxhash64(F.slice(word_array, i, SHINGLE_WORDS)), 64 - HASH_BITS))
    return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.slice(F.sort_array(F.array_distinct(hashes)), 1, k))


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness: the share of the union's sketch that both hold. Two empty sets: 1; one empty: 0."""
    union = merged(a, b, k)
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(F.array_intersect(union, a), b)) / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit((k - 1) * 2.0**HASH_BITS) / F.greatest(F.element_at(a, -1), F.lit(1)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds, at most 1. An empty a: 1."""
    shared = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def merge_by(df: DataFrame, keys: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group of rows. The k smallest are picked before the shuffle too, so a hot group stays bounded."""
    hashes = df.select(*keys, F.explode_outer(column).alias("_h")).distinct()
    ranked = hashes.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.asc_nulls_last("_h")))).where(F.col("_r") <= k)
    return ranked.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(column))


def encoded(a: Column) -> Column:
    """The sketch as text: base64 of its hashes, six bytes each."""
    packed = F.unhex(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), HASH_BITS // 4, "0")), ""))
    return F.translate(F.base64(packed), "\r\n", "")


def decoded(text: Column) -> Column:
    """The sketch of a text made by encoded()."""
    digits = F.hex(F.unbase64(text))
    n = HASH_BITS // 4
    one = lambda i: F.conv(F.substring(digits, i * n + 1, n), 16, 10).cast("bigint")
    return F.when(F.length(digits) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.length(digits) / n - 1, F.lit(0)).cast("int")), one)
    )


def with_next(df: DataFrame, key: str, carried: list[str], buckets: int) -> DataFrame:
    """df plus ``_bucket``, ``_ghost``: rows dealt to key ranges, each range followed by a copy (ghost) of the row
    that comes next in descending key order, so that a window inside a range sees every row's successor; after the
    last row comes the first. Rows move once. The range bounds (at most ``buckets`` numbers) and one key per range
    are all that the driver or a broadcast gets.
    """
    probs = [i / buckets for i in range(1, buckets)]
    bounds = sorted({float(x) for x in (df.agg(F.percentile_approx(key, probs, 10 * buckets)).first()[0] or [])}) or [0.0]
    splits = [float("-inf"), *bounds, float("inf")]
    place = Bucketizer(splits=splits, inputCol="_place", outputCol="_slot")
    ranged = lambda x: place.transform(x.withColumn("_place", F.coalesce(F.col(key).cast("double"), F.lit(float("-inf"))))).withColumn("_bucket", F.col("_slot").cast("int")).drop("_place", "_slot")
    heads = ranged(df.select(key)).groupBy("_bucket").agg(F.max(key).alias("_head"))
    around = Window.orderBy(F.col("_bucket"))  # one row per range
    last = F.last("_bucket").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    first = F.first("_bucket").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("_head", F.when(F.col("_bucket") == last, first).otherwise(F.lead("_bucket").over(around)).alias("_before"))
    dealt = ranged(df.select(key, *carried)).join(F.broadcast(heads), F.col(key).eqNullSafe(F.col("_head")), "left")
    own = F.struct(F.col("_bucket").alias("b"), F.lit(0).alias("g"))
    to = F.when(F.col("_before").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("_before").alias("b"), F.lit(1).alias("g"))))
    return dealt.withColumn("_to", F.explode(to)).select(key, *carried, F.col("_to.b").alias("_bucket"), F.col("_to.g").alias("_ghost"))


def edit_report(docs: DataFrame, k: int = K) -> DataFrame:
    """For each document its fingerprint, that of its edited text (the last half of its code points replaced by the
    first as many of the next document in descending doc_id order) and the likenesses to the edited text and to the
    next document. One output row per input row.

    Null text: empty. Rows with equal doc_id follow each other in text order; null ids come last. A single row is
    its own successor. Columns besides doc_id and text are ignored. Empty table: no rows.
    """
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("_bucket").orderBy("_ghost", F.desc_nulls_last("doc_id"), "text")
    rows = with_next(base, "doc_id", ["text"], n).withColumn("next_text", F.lead("text").over(order))
    chars = F.length("text")
    half = F.floor(chars / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), chars - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    rows = rows.select("doc_id", "text", "_bucket", "_ghost", chars.cast("long").alias("n_chars"), edited.alias("edited"))
    rows = rows.select("*", words(F.col("text")).alias("w"), words(F.col("edited")).alias("ew"))
    rows = rows.select("doc_id", "text", "_bucket", "_ghost", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("w"), k).alias("s"), F.when(F.col("_ghost") == 0, sketch(F.col("ew"), k)).alias("es"))
    rows = rows.withColumn("ns", F.lead("s").over(order)).where("_ghost = 0")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        encoded(F.col("s")).alias("fingerprint"), encoded(F.col("es")).alias("edited_fingerprint"),
        resemblance(F.col("s"), F.col("es"), k).alias("near_edited"), resemblance(F.col("s"), F.col("ns"), k).alias("near_next"),
        distinct_shingles(F.col("s"), k).alias("n_shingles"), containment(F.col("s"), F.col("es"), k).alias("contained_in_edited"),
    )

"""From raw documents to packed training batches: language ID, near-dedup, suffix-array dedup, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexledger.llm import language, minhash, mixing, packing, suffixes
from lexledger.llm.common import keeping, table, written

#: Documents that share this percent of their shingles are near duplicates to the pipeline.
NEAR_PERCENT = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin; a missing lang becomes the predicted one.

    Null and empty texts, and those without a letter, go. Repeated rows stay as often as they occur. Equal sizes: no
    margin, so the document goes. No rows with a text and a lang: nothing is known, so everything goes. Columns of
    docs keep their names and values, also score and lang_pred. Empty table: no rows.
    """
    model = language.fit(docs)

    def known(own: DataFrame) -> DataFrame:
        found = language.identify(own, model).where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= language.MARGIN))
        return found.withColumn("lang", F.coalesce("lang", "lang_pred"))

    return keeping(docs, ("lang_pred", "score"), known)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, the one with the smallest doc_id.

    Documents without words, and those without a doc_id, are linked with nothing and stay. Of rows with equal doc_id
    and text one stays, in an order by a hash of all columns. Other columns are carried along. Empty table: no rows.
    """
    return minhash.without_near_duplicates(docs, percent=NEAR_PERCENT)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated byte strings, n_chars counted anew; those of which nothing is left go.

    Null text becomes empty and stays; repeated rows are copies of each other and go if they are long enough. Columns
    of docs keep their names and values, also those named as the operator's results. Empty table: no rows.
    """

    def cut(own: DataFrame) -> DataFrame:
        left = suffixes.repeated_bytes(own, with_text=True).where("n_bytes = 0 OR text <> ''")
        return left.withColumn("n_chars", F.length("text").cast("long"))

    return keeping(docs, ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"), cut)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, in random order.

    Null is a source of its own. Rows with equal doc_id (or equal text where that is null) are drawn equally often.
    Columns of docs keep their names and values, also copy and shuffle_key. Empty table: no rows.
    """
    return mixing.replicated(docs).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in length buckets and token-budget batches: a row for each piece, none dropped.

    Null and empty texts are one empty piece; repeated rows and null ids are packed as often as they occur; other
    columns are not used. Empty table: no rows.
    """
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_dedup),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: zstandard and the hash functions of several stages have no counterpart in SQL; tests hold the stages against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

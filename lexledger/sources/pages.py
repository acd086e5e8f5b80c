"""Pages of specification documents: checksums, text, lines, table rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexledger.functions import text as t

PAGE = "path string, page_number int, text string, tables array<array<array<string>>>"


def files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, checksum_sha256, content) of a folder's documents."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return found.select("path", F.sha2("content", 256).alias("checksum_sha256"), "content")


def decoded(documents: DataFrame, decoder: Callable[[bytes], list[tuple[str, list]]]) -> DataFrame:
    """(path, page_number, text, tables): documents decoded on executors by a function from bytes to pages of
    (text, tables). No decoder is built in."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = [(path, k, text, tables) for path, content in zip(pdf["path"], pdf["content"], strict=True) for k, (text, tables) in enumerate(decoder(bytes(content)), 1)]
            yield pd.DataFrame(rows, columns=["path", "page_number", "text", "tables"])

    return documents.select("path", "content").mapInPandas(run, PAGE)


def lines(pages: DataFrame, doc: str = "path") -> DataFrame:
    """(doc, line_no, line) in the order of pages; a page has fewer than 2^32 lines."""
    each = pages.select(F.col(doc).alias("doc"), "page_number", F.posexplode(t.lines(F.col("text"))).alias("n", "line"))
    return each.select("doc", (F.col("page_number").cast("long") * F.lit(1 << 32) + F.col("n")).alias("line_no"), "line")


def table_rows(pages: DataFrame, doc: str = "path") -> DataFrame:
    """(doc, page, table_no, row_no, c0..c5) of the pages' tables."""
    tables = pages.select(F.col(doc).alias("doc"), F.col("page_number").alias("page"), F.posexplode("tables").alias("table_no", "tbl"))
    rows = tables.select("doc", "page", "table_no", F.posexplode("tbl").alias("row_no", "r"))
    return rows.select("doc", "page", "table_no", "row_no", *[F.coalesce(F.try_element_at("r", F.lit(k + 1)), F.lit("")).alias(f"c{k}") for k in range(6)])


def outline(pages: DataFrame) -> DataFrame:
    """Pages with their headings and examples."""
    return pages.withColumns({"headings": t.headings(F.col("text")), "examples": t.examples(F.col("text"))})

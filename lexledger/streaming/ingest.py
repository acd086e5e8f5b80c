"""Continuous ingestion of new specification documents, each content once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def documents(spark: SparkSession, folder: str, pattern: str = "*.pdf", per_trigger: int = 1000) -> DataFrame:
    """(path, checksum_sha256, content) of files as they arrive."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", pattern).option("maxFilesPerTrigger", per_trigger).load(folder)
    return files.select("path", F.sha2("content", 256).alias("checksum_sha256"), "content", F.col("modificationTime").alias("ts"))


def ingest(stream: DataFrame, registry: str, checkpoint: str, handle: Callable[[DataFrame], None]) -> StreamingQuery:
    """Hands every document whose checksum is not in the registry (a Parquet folder) to ``handle``, then registers
    it. A repeated batch finds its checksums registered. A job that dies between the two hands the batch on again
    after its restart: ``handle`` sees every document at least once, and should be idempotent as the store is."""

    def step(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates(["checksum_sha256"])
        known = spark.read.schema("checksum_sha256 string, path string").parquet(registry)
        new = new.join(known.select("checksum_sha256"), "checksum_sha256", "left_anti").persist()
        if not new.isEmpty():
            handle(new)
            new.select("checksum_sha256", "path").write.mode("append").parquet(registry)
        new.unpersist()

    spark = stream.sparkSession
    spark.createDataFrame([], "checksum_sha256 string, path string").write.mode("append").parquet(registry)
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Cutting the lineage of a table that later steps read several times, and the folder for what is written meanwhile."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders of local sessions without a checkpoint folder, by application.
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application below spark.checkpoint.dir, which all executors share. A local session without that
    setting gets a temporary folder; on a cluster its lack is an error, as nothing else outlives an executor."""
    context = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", "") or context.getCheckpointDir()
    if not where:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set")
        where = _LOCAL[context.applicationId] = _LOCAL.get(context.applicationId) or tempfile.mkdtemp(prefix="lexledger-")
    return f"{where.rstrip('/')}/lexledger-{context.applicationId}"


def settled(df: DataFrame) -> DataFrame:
    """df with its plan cut off: written to the shared folder and read back, so that a lost executor changes nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that a task sorts at a time.
ROWS_OF_TASK = 500_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df dealt out by keys to tasks of some ROWS_OF_TASK rows each, so that the memory of a task grows neither with the
    input nor with fewer partitions of the session. rows: how many there are, at most."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_OF_TASK)), *keys)

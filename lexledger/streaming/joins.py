"""Versions and the runs that follow them, joined as two streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexledger.streaming.replay import partitions_for, settings

VERSIONS = "document_version_id long, owner long, created_at timestamp"
RUNS = "run_id long, owner long, started_at timestamp"


def with_runs(versions: DataFrame, runs: DataFrame, within: str, late: str) -> DataFrame:
    """(document_version_id, owner, created_at, run_id, started_at): every version with each run that its owner started
    from its creation up to ``within`` later, or with nulls if there is none. Repeated runs count once.

    versions: document_version_id, owner, created_at. runs: run_id, owner, started_at. Both may be streams; ``late`` is
    how long rows of either may come out of order. A version's runs are given as soon as both have come; that it has
    none is known, and given, when both watermarks have passed its last moment. Until then rows are kept as state, no
    longer. Versions and runs without an owner or a time match nothing: versions without a time are left out.
    """
    v = versions.where("created_at IS NOT NULL").select("document_version_id", "owner", F.col("created_at").cast("timestamp").alias("created_at")).withWatermark("created_at", late)
    r = runs.where("started_at IS NOT NULL AND owner IS NOT NULL").select("run_id", F.col("owner").alias("run_owner"), F.col("started_at").cast("timestamp").alias("started_at")).withWatermark("started_at", late)
    r = r.dropDuplicatesWithinWatermark(["run_id"]) if runs.isStreaming else r.dropDuplicates(["run_id"])
    after = F.expr(f"owner = run_owner AND started_at >= created_at AND started_at <= created_at + INTERVAL {within}")
    return v.join(r, after, "left_outer").select("document_version_id", "owner", "created_at", "run_id", "started_at")


def replayed(arrivals: list[tuple[DataFrame, DataFrame]], within: str, late: str, folder: str) -> DataFrame:
    """What the streams give when tables of versions and runs arrive one after the other, the stream being started on
    each and continued from its checkpoint."""
    spark = arrivals[0][0].sparkSession
    n = partitions_for(spark, sum(rows.count() for pair in arrivals for rows in pair))
    with settings(spark, spark__sql__shuffle__partitions=n):
        for pair in arrivals:
            sides = []
            for rows, ddl, name in zip(pair, (VERSIONS, RUNS), ("versions", "runs"), strict=True):
                columns = [x.split() for x in ddl.split(", ")]
                rows.select(*[F.col(c).cast(kind).alias(c) for c, kind in columns]).write.mode("append").parquet(f"{folder}/{name}")
                sides.append(spark.readStream.schema(ddl).parquet(f"{folder}/{name}"))
            out = with_runs(*sides, within, late).writeStream.format("parquet").option("path", f"{folder}/joined").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
            out.start().awaitTermination()
    return spark.read.schema("document_version_id long, owner long, created_at timestamp, run_id long, started_at timestamp").parquet(f"{folder}/joined")

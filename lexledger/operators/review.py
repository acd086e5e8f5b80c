"""Review queue, release gate and run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexledger.operators.lineage import settled


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df with 1, 2, ... in a global order: rows are numbered inside ranges, and only the ranges' counts meet."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = df.repartitionByRange(n, *order).withColumn("_p", F.spark_partition_id())
    ranged = settled(ranged)  # the ranges are drawn once: counts and rows must see the same
    counts = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    before = counts.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    at = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return ranged.join(F.broadcast(before), "_p").withColumn(name, at + F.col("_before")).drop("_p", "_before")


def queue(issues: DataFrame, changes: DataFrame) -> DataFrame:
    """(item_id, risk_level, source): all issues, and all changes but those of low risk; the index in a change's id
    counts every change."""
    of_issues = issues.select(F.concat_ws(":", F.lit("validation"), "code", F.coalesce("field_code", F.lit("global"))).alias("item_id"), F.when(F.col("severity") == "error", "high").otherwise("medium").alias("risk_level"), F.lit("validation").alias("source"))
    indexed = numbered(changes, ["branch", "field_code"], "index").where("risk_level <> 'low'")
    of_changes = indexed.select(F.concat_ws(":", F.lit("diff"), F.col("index").cast("string"), "field_code").alias("item_id"), "risk_level", F.lit("diff").alias("source"))
    return of_issues.unionByName(of_changes)


def release_gate(items: DataFrame, issues: DataFrame, enabled: bool = True) -> DataFrame:
    """One row: publishable only if enabled and there is neither an item nor an issue."""
    n = items.agg(F.count("*").alias("review_items")).crossJoin(F.broadcast(issues.agg(F.count("*").alias("issues"))))
    return n.select("review_items", "issues", (F.lit(enabled) & (F.col("review_items") == 0) & (F.col("issues") == 0)).alias("publish"))


def policy_gate(changes: DataFrame, confidence: DataFrame, evidence: DataFrame, least: float = 0.8) -> DataFrame:
    """(field_code, reason): changes that a release policy holds back: high risk, low confidence, no evidence."""
    known = changes.join(confidence, "field_code", "left").join(evidence.select("field_code", F.lit(True).alias("_seen")).distinct(), "field_code", "left")
    reasons = F.array_compact(F.array(F.when(F.col("risk_level") == "high", "high_risk"), F.when(F.coalesce("confidence", F.lit(0.0)) < least, "low_confidence"), F.when(F.col("_seen").isNull(), "no_evidence")))
    return known.select("field_code", F.explode(reasons).alias("reason"))


def run_metrics(**tables: DataFrame) -> DataFrame:
    """(metric, value): the number of rows of each table."""
    out = None
    for name, df in sorted(tables.items()):
        one = df.agg(F.count("*").alias("value")).select(F.lit(name).alias("metric"), "value")
        out = one if out is None else out.unionByName(one)
    return out

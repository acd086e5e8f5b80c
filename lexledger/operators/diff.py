"""Field-level difference of two catalog versions, with risks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexledger.operators.likeness import alike

#: Attributes that are compared; a difference in the first group that has one names the change.
CARDINALITY = ("occurrence_min", "occurrence_max")
TYPE = ("data_type",)
PATHS = ("invoice_path", "credit_note_path")
CONSTRAINTS = ("min_char_length", "max_char_length", "min_decimal_scale", "max_decimal_scale")
GROUPS = (("cardinality_changed", "high", CARDINALITY), ("data_type_changed", "high", TYPE), ("path_changed", "medium", PATHS), ("constraint_changed", "high", CONSTRAINTS), ("metadata_changed", "low", ("field_name",)))


def last_wins(fields: DataFrame, key: str = "field_code", order: str = "ord") -> DataFrame:
    """Of rows with the same key the last in order."""
    return fields.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where("_r = 1").drop("_r")


def _differs(columns: tuple[str, ...]) -> Column:
    test = F.lit(False)
    for c in columns:
        test = test | ~F.col(f"p.{c}").eqNullSafe(F.col(f"c.{c}"))
    return test


def field_changes(published: DataFrame, candidate: DataFrame) -> DataFrame:
    """(field_code, change_type, risk_level, branch): one full outer join; branch orders added, removed, changed."""
    p, c = last_wins(published).alias("p"), last_wins(candidate).alias("c")
    both = p.join(c, F.col("p.field_code") == F.col("c.field_code"), "full_outer")
    added, removed = F.col("p.field_code").isNull(), F.col("c.field_code").isNull()
    required = lambda side: F.coalesce(F.col(f"{side}.occurrence_min"), F.lit(0)) > 0
    kind = F.when(added, "added").when(removed, "removed")
    risk = F.when(added, F.when(required("c"), "medium").otherwise("low")).when(removed, F.when(required("p"), "high").otherwise("medium"))
    for name, level, columns in GROUPS:
        kind, risk = kind.when(_differs(columns), name), risk.when(_differs(columns), level)
    branch = F.when(added, 1).when(removed, 2).otherwise(3)
    rows = both.select(F.coalesce("c.field_code", "p.field_code").alias("field_code"), kind.alias("change_type"), risk.alias("risk_level"), branch.alias("branch"))
    return rows.where("change_type IS NOT NULL")


def change_summary(changes: DataFrame) -> DataFrame:
    """One row: added, removed, changed."""
    return changes.agg(*[F.count_if(F.col("branch") == k).alias(n) for n, k in (("added", 1), ("removed", 2), ("changed", 3))])


def first_version_summary(candidate_fields: DataFrame, candidate_rules: DataFrame) -> DataFrame:
    """The summary where there is no baseline to compare with."""
    n = candidate_fields.agg(F.count("*").alias("candidate_field_count")).crossJoin(F.broadcast(candidate_rules.agg(F.count("*").alias("candidate_rule_count"))))
    return n.select(F.lit("none").alias("baseline"), "candidate_field_count", "candidate_rule_count")


def compared_codes(published: DataFrame, candidate: DataFrame) -> DataFrame:
    """(field_code, status): missing, extra or changed in any compared attribute."""
    return field_changes(published, candidate).select("field_code", F.when(F.col("branch") == 1, "extra").when(F.col("branch") == 2, "missing").otherwise("changed").alias("status"))


def rule_changes(published: DataFrame, candidate: DataFrame) -> DataFrame:
    """(rule_code, change_type, risk_level): added or removed rules, changed references (high) or wording (low)."""
    p, c = published.alias("p"), candidate.alias("c")
    both = p.join(c, F.col("p.rule_code") == F.col("c.rule_code"), "full_outer")
    kind = (
        F.when(F.col("p.rule_code").isNull(), "added").when(F.col("c.rule_code").isNull(), "removed")
        .when(~F.col("p.refs").eqNullSafe(F.col("c.refs")), "formula_changed").when(~F.col("p.expression_text").eqNullSafe(F.col("c.expression_text")), "wording_changed")
    )
    rows = both.select(F.coalesce("c.rule_code", "p.rule_code").alias("rule_code"), kind.alias("change_type")).where("change_type IS NOT NULL")
    return rows.withColumn("risk_level", F.when(F.col("change_type") == "wording_changed", "low").when(F.col("change_type") == "added", "medium").otherwise("high"))


def code_changes(published: DataFrame, candidate: DataFrame) -> DataFrame:
    """(code_list_name, code, change_type) of code list entries."""
    p, c = published.alias("p"), candidate.alias("c")
    both = p.join(c, (F.col("p.code_list_name") == F.col("c.code_list_name")) & (F.col("p.code") == F.col("c.code")), "full_outer")
    kind = F.when(F.col("p.code").isNull(), "added").when(F.col("c.code").isNull(), "removed").when(~F.col("p.label").eqNullSafe(F.col("c.label")), "label_changed")
    return both.select(F.coalesce("c.code_list_name", "p.code_list_name").alias("code_list_name"), F.coalesce("c.code", "p.code").alias("code"), kind.alias("change_type")).where("change_type IS NOT NULL")


def rename_suggestions(published: DataFrame, candidate: DataFrame, most: int = 3) -> DataFrame:
    """(old_code, new_code, distance): removed and added fields of the same type and path whose names are at most
    ``most`` edits apart; suggestions only, nothing is merged."""
    changes = field_changes(published, candidate)
    gone = last_wins(published).join(changes.where("branch = 2").select("field_code"), "field_code", "left_semi")
    new = last_wins(candidate).join(changes.where("branch = 1").select("field_code"), "field_code", "left_semi")
    a = gone.select(F.col("field_code").alias("old_code"), F.col("field_name").alias("old_name"), "data_type", "invoice_path")
    b = new.select(F.col("field_code").alias("new_code"), F.col("field_name").alias("new_name"), "data_type", "invoice_path")
    near = a.join(b, ["data_type", "invoice_path"]).withColumn("distance", F.levenshtein("old_name", "new_name", most))
    return near.where("distance >= 0").select("old_code", "new_code", "distance")


#: Keys that the removed fields of one name are spread over.
SPREAD = 16


def renamed_by_likeness(published: DataFrame, candidate: DataFrame, most: int = 3) -> DataFrame:
    """(old_code, new_code, distance): removed and added fields whose names are at most ``most`` edits apart, whatever
    their types and paths; suggestions only, nothing is merged.

    Fields of alike names all go with each other, so that the rows are many times their input: fields of one name are
    spread over SPREAD keys, and the join has as many tasks as the session gives a shuffle, however small its input."""
    changes = field_changes(published, candidate)
    of = lambda side, branch, code, name: last_wins(side).join(changes.where(F.col("branch") == branch).select("field_code"), "field_code", "left_semi").select(F.col("field_code").alias(code), F.col("field_name").alias(name))
    gone, new = of(published, 2, "old_code", "left_name"), of(candidate, 1, "new_code", "right_name")
    pairs = alike(gone.withColumnRenamed("left_name", "name"), new.withColumnRenamed("right_name", "name"), most)
    tasks = int(published.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    near = pairs.join(gone, "left_name").withColumn("_key", F.pmod(F.xxhash64("old_code"), F.lit(SPREAD))).repartition(tasks, "right_name", "_key")
    spread = new.withColumn("_key", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SPREAD - 1).cast("bigint"))))
    return near.join(spread.repartition(tasks, "right_name", "_key"), ["right_name", "_key"]).select("old_code", "new_code", "distance")

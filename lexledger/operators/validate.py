"""Checks of a whole catalog; every check gives rows (severity, code, field_code, subject)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexledger.functions import numbers


def _issues(rows: DataFrame, severity: str, code: str, field: str | None, subject: str) -> DataFrame:
    return rows.select(F.lit(severity).alias("severity"), F.lit(code).alias("code"), (F.col(field) if field else F.lit(None).cast("string")).alias("field_code"), F.col(subject).alias("subject"))


def duplicate_codes(fields: DataFrame) -> DataFrame:
    """Every occurrence of a code after its first."""
    seen = fields.withColumn("_r", F.row_number().over(Window.partitionBy("field_code").orderBy("ord")))
    return _issues(seen.where("_r > 1"), "error", "duplicate_field_code", "field_code", "field_code")


def missing_paths(fields: DataFrame) -> DataFrame:
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return _issues(fields.where((F.col("field_kind") == "atomic") & empty("invoice_path") & empty("credit_note_path")), "warning", "missing_field_path", "field_code", "field_code")


def missing_evidence(fields: DataFrame, evidence: DataFrame) -> DataFrame:
    return _issues(fields.join(evidence.select("field_code"), "field_code", "left_anti"), "warning", "missing_field_evidence", "field_code", "field_code")


def reversed_cardinality(fields: DataFrame) -> DataFrame:
    return _issues(fields.where(numbers.bounds_reversed(F.col("occurrence_min"), F.col("occurrence_max"))), "error", "invalid_cardinality", "field_code", "field_code")


def dangling_references(rules: DataFrame, fields: DataFrame) -> DataFrame:
    """Rules with references to unknown fields (groups excepted); subject: the rule and the references, in the rule's
    order (``pos``)."""
    unknown = rules.where(~F.col("ref").rlike("^(HR-)?BG-")).join(fields.select(F.col("field_code").alias("ref")).distinct(), "ref", "left_anti")
    per_rule = unknown.groupBy("rule_code").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "ref"))), lambda x: x["ref"]), ", ").alias("refs"))
    return _issues(per_rule.withColumn("subject", F.concat_ws(": ", "rule_code", "refs")), "warning", "dangling_rule_reference", None, "subject")


def rules_without_evidence(rules: DataFrame, evidence: DataFrame) -> DataFrame:
    return _issues(rules.select("rule_code").distinct().join(evidence.select("rule_code"), "rule_code", "left_anti"), "warning", "missing_rule_evidence", None, "rule_code")


def all_issues(fields: DataFrame, rules: DataFrame, field_evidence: DataFrame, rule_evidence: DataFrame) -> DataFrame:
    """All six checks. rules: rule_code, pos, ref; a rule without references is a row with a null ref."""
    found = (
        duplicate_codes(fields), missing_paths(fields), missing_evidence(fields, field_evidence), reversed_cardinality(fields), dangling_references(rules, fields),
        rules_without_evidence(rules, rule_evidence),
    )
    return reduce(DataFrame.unionByName, found)


#: Paths: a document, then elements with or without a prefix, at last maybe an attribute.
PATH = r"^/(Invoice|CreditNote)(/([A-Za-z][A-Za-z0-9]*:)?[A-Za-z][A-Za-z0-9_]*)*(/@[A-Za-z][A-Za-z0-9_:-]*)?$"


def odd_paths(fields: DataFrame) -> DataFrame:
    """Fields with a path that is none, or that leads into the other kind of document; subject: the path."""
    each = fields.select("field_code", F.expr("stack(2, 'Invoice', invoice_path, 'CreditNote', credit_note_path) AS (kind, path)")).where("coalesce(path, '') <> ''")
    bad = each.where(~F.col("path").rlike(PATH) | (F.regexp_extract("path", PATH, 1) != F.col("kind")))
    return _issues(bad, "warning", "odd_field_path", "field_code", "path")


def missing_columns(fields: DataFrame, required: tuple[str, ...] = ("field_name", "data_type", "occurrence_max")) -> DataFrame:
    """Fields without a required value; subject: the names of what is missing."""
    missing = F.array_compact(F.array(*[F.when(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == "", F.lit(c)) for c in required]))
    bad = fields.withColumn("_missing", F.array_join(missing, ", ")).where("_missing <> ''")
    return _issues(bad, "error", "missing_required_value", "field_code", "_missing")


def normal_code(code):
    """A code without blanks, in capitals: what entries of a code list are compared by."""
    return F.upper(F.regexp_replace(F.coalesce(code, F.lit("")), r"\s+", ""))


def colliding_codes(entries: DataFrame) -> DataFrame:
    """Entries of a code list whose codes are the same but for blanks and case; subject: the list and the codes, each
    spelling once. entries: code_list_name, code."""
    each = entries.where("code IS NOT NULL").select("code_list_name", "code").distinct()
    same = each.groupBy("code_list_name", normal_code(F.col("code")).alias("normal")).agg(F.array_sort(F.collect_list("code")).alias("codes")).where(F.size("codes") > 1)
    return _issues(same.withColumn("subject", F.concat_ws(": ", "code_list_name", F.array_join("codes", ", "))), "warning", "colliding_codes", None, "subject")


def extra_issues(fields: DataFrame, entries: DataFrame) -> DataFrame:
    """The three further checks of a catalog and its code lists."""
    return odd_paths(fields).unionByName(missing_columns(fields)).unionByName(colliding_codes(entries))

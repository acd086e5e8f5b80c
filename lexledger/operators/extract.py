"""From table rows and text lines of a specification to field and rule definitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexledger.functions import numbers
from lexledger.functions import text as t
from lexledger.operators import folds
from lexledger.operators.versions import first_of, missing_references

EXPLICIT_CONFIDENCE, RULE_CONFIDENCE, INFERRED_CONFIDENCE = 0.98, 0.95, 0.65
FALLBACK_NOTE = "Recovered from rule reference fallback."


def report_path(invoice: Column, credit_note: Column) -> Column:
    part = lambda label, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{label}: "), c))
    return F.concat_ws("\n", part("Invoice", invoice), part("CreditNote", credit_note))


def with_text(records: DataFrame, lines: DataFrame, doc: str = "doc") -> DataFrame:
    """Records with what the running text says of them: heading names, paths, rules, samples, value sets, lengths.

    The best blocks of all codes are found at once and joined, instead of a search of the lines for every field.
    """
    blocks = folds.described(lines, doc, records.select(doc, F.col("field_code").alias("code")).distinct())
    both = records.join(blocks.withColumnRenamed("code", "field_code"), [doc, "field_code"], "left")
    both = both.withColumns({c: F.coalesce(c, F.lit("")) for c in ("detail", "table_block")})
    marked = F.contains("detail", F.lit("Example of use:")) | F.contains("detail", F.lit("Business Rule"))
    heading = F.when(marked, t.or_null(t.heading_name(F.col("detail"), F.col("field_code"))))
    found = both.withColumn("_path", folds.path_text(F.col("table_block")))
    better = lambda new, old: F.coalesce(t.or_null(new), F.col(old))
    found = found.withColumns({"field_name": F.coalesce(heading, "field_name"), "invoice_path": better(t.invoice_path(F.col("_path")), "invoice_path"), "credit_note_path": better(t.credit_note_path(F.col("_path")), "credit_note_path")})
    found = found.withColumn("_report", report_path(F.col("invoice_path"), F.col("credit_note_path"))).withColumn("rules", folds.rules_of(F.col("detail")))
    found = found.withColumn("sample", t.example_value(F.col("detail"), F.col("_report")))
    repaired = lambda c: t.repaired_extension(F.col(c), F.col("_report"), F.col("sample"), F.col("detail"))
    found = found.withColumns({c: repaired(c) for c in ("invoice_path", "credit_note_path")})
    hints = F.concat_ws("\n", *[t.or_null(F.col(c)) for c in ("note", "remark", "detail")])
    found = found.withColumns({
        "value_set": t.value_set(F.col("note"), F.col("remark"), F.col("detail"), F.col("data_type")),
        "notes": t.interpretation(F.col("description"), F.col("note"), F.col("remark")),
        **numbers.constraints(F.col("data_type"), hints),
    })
    return found.drop("_path", "_report", "table_block")


def table_evidence(pages: Column, quote: Column) -> Column:
    """The quote, cited from at most three pages."""
    return F.transform(numbers.first_pages(pages), lambda p: F.struct(p.alias("page_number"), F.lit("table").alias("source_kind"), quote.alias("quote_text")))


def field_definitions(records: DataFrame) -> DataFrame:
    """Definitions: empty text becomes null, the cardinality is split, evidence quotes at most three pages."""
    evidence = table_evidence(F.col("pages"), t.quote(F.col("detail"), F.col("description"), F.col("field_name")))
    return records.select(
        "doc", "field_code", "field_name", F.lit("atomic").alias("field_kind"), *[t.or_null(F.col(c)).alias(c) for c in ("description", "data_type", "invoice_path", "credit_note_path", "remark", "sample", "notes")],
        numbers.cardinality_min(F.col("cardinality")).alias("occurrence_min"), numbers.cardinality_max(F.col("cardinality")).alias("occurrence_max"),
        t.value_set_refs(F.col("value_set")).alias("value_set_refs"), *[numbers.int_or_null(F.col(c)).alias(c) for c in ("min_char_length", "max_char_length", "min_decimal_scale", "max_decimal_scale")],
        F.lit("explicit").alias("origin"), F.lit(EXPLICIT_CONFIDENCE).alias("confidence"), evidence.alias("evidence"), F.col("record").alias("ord"),
    )


def rule_definitions(records: DataFrame) -> DataFrame:
    """Rules with a code, each code once: the first of a document's records and rules. A rule is quoted from its record's
    pages."""
    each = records.select("doc", "record", "pages", F.posexplode("rules").alias("pos", "expression_text")).withColumn("rule_code", t.rule_code(F.col("expression_text"))).where("rule_code <> ''")
    first = first_of(each, ["doc", "rule_code"], F.col("record"), F.col("pos"))
    return first.select("doc", "rule_code", t.classify_rule(F.col("expression_text")).alias("rule_type"), "expression_text", t.field_refs(F.col("expression_text")).alias("refs"), F.lit("error").alias("severity"), F.lit("explicit").alias("origin"), F.lit(RULE_CONFIDENCE).alias("confidence"), table_evidence(F.col("pages"), F.left(t.squash(F.col("expression_text")), F.lit(280))).alias("evidence"))


def fallback_fields(pages: DataFrame, rules: DataFrame, fields: DataFrame) -> DataFrame:
    """Fields that rules refer to and no table defines, described by the page that describes them best; of equally
    good pages the last.

    pages: page_number, text. rules: rule_code, ref. Codes are looked up among the codes that a page's lines begin
    with, an equi-join, since only those have blocks.
    """
    missing = missing_references(rules, fields).select(F.col("field_code").alias("code"))
    lines = pages.select(F.col("page_number").alias("doc"), F.posexplode(t.lines(F.col("text"))).alias("line_no", "line"))
    both = folds.described(lines, codes=missing)
    merged = F.concat_ws("\n", t.or_null(F.col("table_block")), t.or_null(F.col("detail")))
    best = first_of(both.withColumn("score", folds.fallback_score(merged)), ["code"], F.desc("score"), F.desc("doc"))
    name = F.coalesce(t.or_null(t.heading_name(F.col("detail"), F.col("code"))), t.or_null(t.heading_name(F.col("table_block"), F.col("code"))), F.col("code"))
    path = folds.path_text(F.col("table_block"))
    made = best.withColumns({"invoice_path": t.invoice_path(path), "credit_note_path": t.credit_note_path(path)})
    return made.select(
        F.col("code").alias("field_code"), t.inferred_name(name).alias("field_name"), t.or_null(F.col("invoice_path")).alias("invoice_path"), t.or_null(F.col("credit_note_path")).alias("credit_note_path"),
        t.or_null(t.example_value(F.col("detail"), report_path(F.col("invoice_path"), F.col("credit_note_path")))).alias("sample"), F.lit(FALLBACK_NOTE).alias("notes"),
        F.lit("inferred").alias("origin"), F.lit(INFERRED_CONFIDENCE).alias("confidence"), F.col("doc").alias("page_number"), "score",
    )

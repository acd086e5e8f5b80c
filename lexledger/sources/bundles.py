"""Bundles of a specification version as JSON: reading with defaults, flat tables, writing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexledger import schemas


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per bundle file. Lists that are missing are empty; the source path is not part of a bundle that is
    read back."""
    raw = spark.read.schema(schemas.BUNDLE).option("multiLine", True).option("mode", "FAILFAST").json(path)
    empty = lambda c: F.coalesce(c, F.array().cast(raw.schema[c].dataType)).alias(c)
    return raw.select(F.col("document").dropFields("source_path").alias("document"), empty("fields"), empty("rules"), empty("code_lists"))


def fields(bundles: DataFrame) -> DataFrame:
    """A row per field with the columns that diff and validation compare; ord is the place in the list."""
    each = bundles.select("document.jurisdiction", "document.tax_domain", "document.version_label", F.posexplode("fields").alias("ord", "f"))
    return each.select(
        "jurisdiction", "tax_domain", "version_label", "ord", "f.field_code", "f.field_name", F.coalesce("f.field_kind", F.lit("atomic")).alias("field_kind"), "f.data_type", "f.occurrence_min", "f.occurrence_max",
        F.col("f.paths.invoice").alias("invoice_path"), F.col("f.paths.credit_note").alias("credit_note_path"), F.col("f.paths.remark").alias("remark"), "f.constraints.min_char_length", "f.constraints.max_char_length",
        "f.constraints.min_decimal_scale", "f.constraints.max_decimal_scale", "f.constraints.format_hint", F.col("f.field_description").alias("description"), F.col("f.sample_value").alias("sample"),
        F.coalesce("f.value_set_refs", F.array().cast("array<string>")).alias("refs"), F.col("f.semantic_notes").alias("notes"), F.coalesce("f.origin", F.lit("explicit")).alias("origin"), "f.confidence", "f.evidence",
    )


def rule_refs(bundles: DataFrame) -> DataFrame:
    """(version_label, rule_code, ref): a row per reference."""
    each = bundles.select("document.version_label", F.explode("rules").alias("r"))
    return each.select("version_label", "r.rule_code", F.explode("r.referenced_fields").alias("ref"))


def evidence(field_rows: DataFrame) -> DataFrame:
    return field_rows.select("version_label", "field_code", F.posexplode("evidence").alias("id", "e")).select("version_label", "field_code", "id", "e.*")


def write(rows: DataFrame, path: str) -> None:
    """JSON lines that keep nulls."""
    rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def parsed(c, schema: str, fallback):
    """A JSON document of a known form, or the fallback where it is missing or of another form."""
    return F.coalesce(F.from_json(c, schema), fallback)


#: The parts of a bundle that is written as JSON lines, and their columns.
PARTS = {
    "document": "checksum_sha256 string, source_uri string, version_label string, jurisdiction string, tax_domain string, language_code string, issued_on date, effective_from date, effective_to date",
    "fields": f"{schemas.FIELD_ROW.partition(', ')[2]}, invoice_path string, credit_note_path string, remark string, evidence {schemas.EVIDENCE}",
    "rules": f"rule_code string, rule_type string, expression_text string, refs array<string>, severity string, origin string, confidence double, evidence {schemas.EVIDENCE}",
    "code_lists": f"code_list_name string, entries array<struct<code:string,label:string,description:string>>, origin string, confidence double, evidence {schemas.EVIDENCE}",
}


def write_parts(parts: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """A bundle as JSON lines, a folder for each part; a large catalog is written by many tasks."""
    places = {name: f"{folder.rstrip('/')}/{name}" for name in PARTS}
    for name, place in places.items():
        write(parts[name], place)
    return places


def read_parts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The parts of write_parts(); what they don't hold is null. Evidence is read without its ids."""
    return {name: spark.read.schema(ddl).option("mode", "FAILFAST").json(f"{folder.rstrip('/')}/{name}") for name, ddl in PARTS.items()}


def exists(spark: SparkSession, folder: str) -> bool:
    """Whether a bundle of parts is there."""
    try:
        spark.read.text(f"{folder.rstrip('/')}/fields")
    except AnalysisException as none:
        if none.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True

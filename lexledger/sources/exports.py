"""Catalog exports: CSV for spreadsheets, JSON lines, a short note."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexledger.operators.extract import report_path

#: Column titles of the CSV, in their order, and what they hold.
TITLES = (
    ("字段标识", "field_code"), ("字段描述", "description"), ("字段名称", "field_name"), ("数据类型", "data_type"), ("字段取值示例", "sample"), ("出现次数", "cardinality"), ("值集校验取值", "value_set"), ("字段含义解读", "notes"),
    ("报送税局字段层级", "report_path"), ("交叉校验规则", "rules"), ("最小字符长度", "min_char_length"), ("最大字符长度", "max_char_length"), ("最小小数位精度", "min_decimal_scale"), ("最大小数位精度", "max_decimal_scale"),
    ("来源文档", "source"), ("来源页码", "pages"),
)


def _titled(records: DataFrame, values: dict[str, Column], bare: Column) -> list[Column]:
    """A column for each title; what the records don't have is ``bare``."""
    known = lambda c: values[c] if c in values else F.col(c) if c in records.columns else bare
    return [known(c).alias(title) for title, c in TITLES]


def _has(records: DataFrame, *names: str) -> bool:
    return all(c in records.columns for c in names)


def csv_rows(records: DataFrame, source: str) -> DataFrame:
    """Field records (as extract.with_text gives them) as the 16 columns of the CSV, all text: paths with their labels,
    rules between bars, pages each once and sorted."""
    values = {"source": F.lit(source)}
    if _has(records, "invoice_path", "credit_note_path"):
        values["report_path"] = report_path(F.col("invoice_path"), F.col("credit_note_path"))
    if _has(records, "rules"):
        values["rules"] = F.array_join("rules", " | ")
    if _has(records, "pages"):
        values["pages"] = F.array_join(F.array_sort(F.array_distinct("pages")), ",")
    return records.select(*[F.coalesce(c.cast("string"), F.lit("")).alias(title) for c, (title, _) in zip(_titled(records, values, F.lit("")), TITLES, strict=True)])


def json_rows(records: DataFrame, source: str) -> DataFrame:
    """The same as nested rows: paths as a map of document kinds, rules and pages as lists, the remark beside the path."""
    values = {"source": F.lit(source)}
    if _has(records, "invoice_path", "credit_note_path"):
        values["report_path"] = F.struct(F.col("invoice_path").alias("Invoice"), F.col("credit_note_path").alias("CreditNote"))
    if _has(records, "pages"):
        values["pages"] = F.array_sort(F.array_distinct("pages"))
    titled = _titled(records, values, F.lit(None).cast("string"))
    at = [c for _, c in TITLES].index("report_path") + 1
    remark = F.col("remark") if _has(records, "remark") else F.lit(None).cast("string")
    return records.select(*titled[:at], remark.alias("Remark"), *titled[at:])


def csv(records: DataFrame, path: str, source: str = "") -> None:
    """UTF-8 with a byte order mark before the header of every file, fields in the order of their codes."""
    rows = csv_rows(records, source).orderBy(TITLES[0][0])
    rows.withColumnRenamed(TITLES[0][0], "\ufeff" + TITLES[0][0]).write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def json(records: DataFrame, path: str, source: str = "") -> None:
    json_rows(records, source).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def note(fields: DataFrame) -> str:
    """A line of Markdown for each number that a reader asks for first."""
    n = fields.agg(F.count("*").alias("n"), F.count_if(F.coalesce("sample", F.lit("")) != "").alias("s")).first()
    return f"# Field catalog\n\n- Fields: {n['n']}\n- With a sample value: {n['s']}\n"

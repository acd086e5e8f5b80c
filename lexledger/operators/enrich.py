"""Enrichment by an external model: which fields, in which batches, and how answers are merged."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexledger.functions import numbers
from lexledger.operators.contain import found_in
from lexledger.operators.review import numbered

SENTINEL = "Recovered from rule reference fallback."
#: Lower-case data types for which a format is worth asking.
FORMAT_TYPES = ("identifier", "date", "datetime", "time", "code", "amount", "quantity", "percentage", "boolean")


def notes_missing(c: Column) -> Column:
    text = F.trim(F.coalesce(c, F.lit("")))
    return (text == "") | (text == SENTINEL)


def sample_suspicious(sample: Column, origin: Column, name: Column) -> Column:
    """A sample of true or false where the field was inferred, or is a code on an invoice item."""
    logical = F.lower(F.trim(F.coalesce(sample, F.lit("")))).isin("true", "false")
    return logical & ((origin == "inferred") | F.endswith(F.lower(name), F.lit("code on invoice item")))


def _suspicious() -> Column:
    return sample_suspicious(F.col("sample"), F.col("origin"), F.col("field_name"))


def due(fields: DataFrame) -> DataFrame:
    """All fields worth asking about: inferred ones, missing notes, suspicious samples, missing formats."""
    missing, odd = notes_missing(F.col("notes")), _suspicious()
    wants_format = (F.coalesce("format_hint", F.lit("")) == "") & F.lower(F.coalesce("data_type", F.lit(""))).isin(*FORMAT_TYPES)
    return fields.where((F.col("field_kind") == "atomic") & ((F.col("origin") == "inferred") | missing | odd | wants_format))


def candidates(fields: DataFrame, most: int = 24) -> DataFrame:
    """The fields most in need: missing notes, then explicit ones, suspicious samples, low confidence, code."""
    missing, odd = notes_missing(F.col("notes")), _suspicious()
    return due(fields).orderBy(F.desc(missing), F.desc(F.col("origin") == "explicit"), F.desc(odd), "confidence", "field_code").limit(most)


def batched(fields: DataFrame, order: list[str], size: int = 8) -> DataFrame:
    """fields plus ``batch``: consecutive fields, ``size`` at a time."""
    return numbered(fields, order, "_at").withColumn("batch", F.floor((F.col("_at") - 1) / size).cast("int")).drop("_at")


_MERGED = "struct<notes:string,format_hint:string,sample:string,refs:array<string>,confidence:double>"


def merged(fields: DataFrame, updates: DataFrame) -> DataFrame:
    """Fields with their updates, one after the other by ``ord``: notes only where missing or inferred, hint and sample
    only where empty (or suspicious), references appended, the higher confidence. Updates of unknown codes are
    dropped; a field stays one row whatever the number of its updates."""
    names = ("notes", "format_hint", "sample", "refs", "confidence")
    u = updates.groupBy("field_code").agg(F.array_sort(F.collect_list(F.struct("ord", F.struct(*names).cast(_MERGED).alias("u")))).alias("updates"))
    has = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""

    def step(have: Column, entry: Column) -> Column:
        new = entry["u"]
        takes_notes = has(new["notes"]) & (notes_missing(have["notes"]) | (F.col("origin") == "inferred"))
        takes_sample = has(new["sample"]) & (~has(have["sample"]) | sample_suspicious(have["sample"], F.col("origin"), F.col("field_name")))
        return F.struct(
            F.when(takes_notes, F.trim(new["notes"])).otherwise(have["notes"]).alias("notes"),
            F.when(has(new["format_hint"]) & ~has(have["format_hint"]), F.trim(new["format_hint"])).otherwise(have["format_hint"]).alias("format_hint"),
            F.when(takes_sample, F.trim(new["sample"])).otherwise(have["sample"]).alias("sample"),
            numbers.appended(have["refs"], F.coalesce(new["refs"], F.array().cast("array<string>"))).alias("refs"),
            F.greatest(have["confidence"], new["confidence"]).alias("confidence"),
        ).cast(_MERGED)

    both = fields.join(u, "field_code", "left")
    after = F.when(F.col("updates").isNotNull(), F.aggregate("updates", F.struct(*names).cast(_MERGED), step))
    both = both.withColumn("after", after)
    kept = {"confidence": F.col("after.confidence").cast(fields.schema["confidence"].dataType)}
    return both.select(*[F.when(F.col("updates").isNull(), F.col(c)).otherwise(kept.get(c, F.col(f"after.{c}"))).alias(c) if c in names else F.col(c) for c in fields.columns])


def enriched(batches: DataFrame, client: Callable[[list[dict]], list[dict]], schema: str) -> DataFrame:
    """Updates that a client gives for each batch of fields. The client runs on executors and gets whole batches; a
    task that is run again asks again."""
    import pandas as pd

    names = [c.split()[0] for c in schema.split(",")]
    return batches.groupBy("batch").applyInPandas(lambda part: pd.DataFrame(client(part.to_dict("records")), columns=names), schema)


#: Fixed pattern: codes as they stand in a page, with or without the prefix of a country's extension.
CODE = r"(?:HR-)?[A-Z]{2}-\d{1,12}"


def evidence_pages(fields: DataFrame, pages: DataFrame, most: int = 3) -> DataFrame:
    """(field_code, page_number, place): the pages of a field's evidence in first-seen order; without evidence the
    pages that contain its code, in page order; without those page 1. At most ``most`` of them.

    fields: field_code, evidence (array of structs with page_number). A code is found wherever its text stands, also
    with more digits behind it: pages give all codes that theirs contain, which are joined with the fields'. Codes of
    another form are found by one reading of the pages for all of them.
    """
    cited = fields.select("field_code", F.array_distinct(F.transform(F.coalesce("evidence", F.array()), lambda e: e["page_number"])).alias("cited")) if "evidence" in fields.columns else fields.select("field_code", F.array().cast("array<int>").alias("cited"))
    open_ = cited.where(F.size("cited") == 0).select("field_code").distinct()
    usual = F.col("field_code").rlike(f"^{CODE}$")
    shown = pages.select("page_number", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(rf"(?=({CODE}))"), F.lit(1)))).alias("code"))
    digits = F.length(F.substring_index("code", "-", -1))
    shorter = F.transform(F.sequence(F.lit(0), digits - 1), lambda k: F.expr("code").substr(F.lit(1), F.length("code") - k))
    within = shown.select("page_number", F.explode(shorter).alias("field_code")).distinct()
    hits = within.join(open_.where(usual), "field_code").select("page_number", "field_code")
    odd = open_.where(~usual)
    hits = hits.unionByName(found_in(pages, odd, "page_number", pattern="field_code"))
    found = hits.groupBy("field_code").agg(F.array_sort(F.collect_set("page_number")).alias("found"))
    chosen = F.when(F.size("cited") > 0, F.col("cited")).otherwise(F.coalesce("found", F.array(F.lit(1))))
    return cited.join(found, "field_code", "left").select("field_code", F.posexplode(F.slice(chosen, 1, most)).alias("place", "page_number"))


#: What a model is told with every batch.
INSTRUCTIONS = (
    "Use only the supplied source excerpts.",
    "Return updates only when the excerpts support them directly.",
    "Do not invent code lists, examples, or formatting hints.",
    "Keep semantic_notes concise and business-facing.",
    "Preserve existing values by returning null or an empty list when no improvement is justified.",
)


def prompts(batches: DataFrame, pages: DataFrame, document: dict[str, str]) -> DataFrame:
    """(batch, prompt): one JSON request for each batch of fields, with excerpts of their pages around their codes."""
    from lexledger.functions import text as t

    where = evidence_pages(batches, pages).join(pages, "page_number")
    excerpts = where.groupBy("field_code").agg(F.array_sort(F.collect_list(F.struct("place", "page_number", t.excerpt(F.col("text"), F.col("field_code")).alias("excerpt")))).alias("x"))
    shown = F.struct(
        "field_code", "field_name", "data_type", F.when(~_suspicious(), F.col("sample")).alias("sample_value"), F.when(~notes_missing(F.col("notes")), F.col("notes")).alias("semantic_notes"), "origin", "confidence",
    )
    sources = F.transform(F.coalesce("x", F.array().cast("array<struct<place:int,page_number:int,excerpt:string>>")), lambda s: F.struct(s["page_number"].alias("page_number"), s["excerpt"].alias("excerpt")))
    each = batches.join(excerpts, "field_code", "left").select("batch", F.struct(F.col("field_code").alias("k"), F.struct(shown.alias("field"), sources.alias("source_excerpts")).alias("f")).alias("f"))
    per_batch = each.groupBy("batch").agg(F.transform(F.array_sort(F.collect_list("f"), lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0)), lambda s: s["f"]).alias("fields"))
    head = F.struct(*[F.lit(document.get(k)).alias(k) for k in ("jurisdiction", "tax_domain", "language_code", "version_label")])
    body = F.struct(head.alias("document"), F.array(*map(F.lit, INSTRUCTIONS)).alias("instructions"), "fields")
    return per_batch.select("batch", F.to_json(body, {"ignoreNullFields": "false"}).alias("prompt"))


def with_evidence(fields: DataFrame, cited: DataFrame, pages: DataFrame) -> DataFrame:
    """Fields with the first two pages that a model cited as evidence, each quote once, after what they had.

    fields: field_code, evidence. cited: field_code, page_numbers.
    """
    from lexledger.functions import text as t

    wanted = cited.select("field_code", F.posexplode(F.slice("page_numbers", 1, 2)).alias("place", "page_number")).join(pages, "page_number")
    quote = F.left(t.excerpt(F.col("text"), F.col("field_code")), F.lit(280))
    new = wanted.groupBy("field_code").agg(F.array_sort(F.collect_list(F.struct("place", F.struct("page_number", F.lit("llm_page_excerpt").alias("source_kind"), quote.alias("quote_text")).alias("e")))).alias("n"))
    added = F.transform(F.coalesce("n", F.array().cast("array<struct<place:int,e:struct<page_number:int,source_kind:string,quote_text:string>>>")), lambda s: s["e"])
    merged_ = F.concat("evidence", F.array_except(F.array_distinct(added), F.col("evidence")))
    return fields.join(new, "field_code", "left").withColumn("evidence", merged_).drop("n")

"""One update run: pages to a validated, compared and possibly published catalog version."""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexledger.operators import diff, extract, folds, review, validate, versions
from lexledger.operators.lineage import settled as _settled
from lexledger.sources import bundles, pages
from lexledger.sources.store import Store


Extracted = tuple[DataFrame, DataFrame, DataFrame]


def extracted(found: DataFrame) -> Extracted:
    """(fields, rules, code lists) of decoded pages, fields that only rules know of included. One document's pages."""
    records = _settled(extract.with_text(_settled(folds.table_records(pages.table_rows(found))), pages.lines(found)))
    fields, rules = _settled(extract.field_definitions(records)), _settled(extract.rule_definitions(records))
    lists = _settled(versions.code_list_definitions(fields))
    refs = rules.select("rule_code", F.explode("refs").alias("ref"))
    more = extract.fallback_fields(found.select("page_number", "text"), refs, fields.select("field_code"))
    quoted = F.array(F.struct("page_number", F.lit("paragraph").alias("source_kind"), "field_name"))
    more = more.withColumn("evidence", quoted.cast("array<struct<page_number:int,source_kind:string,quote_text:string>>")).drop("page_number", "score")
    return fields.unionByName(more.withColumns({"field_kind": F.lit("atomic"), "ord": F.lit(1 << 40)}), allowMissingColumns=True), rules, lists


@dataclass
class Steps:
    """Replaceable steps, each a function of DataFrames; publish gets the bundle's parts and the run's folder and
    returns the place of what it wrote."""

    parse: Callable[[DataFrame, Callable], DataFrame] = pages.decoded
    extract: Callable[[DataFrame], Extracted] = extracted
    enrich: Callable[[DataFrame, DataFrame], DataFrame] = lambda fields, pages: fields
    validate: Callable[[DataFrame, DataFrame, DataFrame, DataFrame], DataFrame] = validate.all_issues
    compare: Callable[[DataFrame, DataFrame], DataFrame] = diff.field_changes
    review: Callable[[DataFrame, DataFrame], DataFrame] = review.queue
    publish: Callable[[dict[str, DataFrame], str], str] = lambda parts, folder: bundles.write_parts(parts, f"{folder}/published_bundle")["fields"].rpartition("/")[0]
    publish_when_clean: bool = False


@dataclass
class Result:
    fields: DataFrame
    rules: DataFrame
    code_lists: DataFrame
    issues: DataFrame
    changes: DataFrame
    items: DataFrame
    summary: dict = field(default_factory=dict)
    published: bool = False
    version_id: int | None = None
    folders: dict[str, str] = field(default_factory=dict)


def run(found: DataFrame, published: DataFrame | None, steps: Steps | None = None) -> Result:
    """Extract, enrich, validate, compare and queue. Without a published version there is nothing to compare: no
    changes, and a summary of another kind."""
    steps = steps or Steps()
    fields, rules, lists = steps.extract(found)
    fields = _settled(steps.enrich(fields, found.select("page_number", "text")))
    refs = rules.select("rule_code", F.posexplode_outer("refs").alias("pos", "ref"))
    cited = lambda df, key: df.where(F.size("evidence") > 0).select(key)
    issues = _settled(steps.validate(fields, refs, cited(fields, "field_code"), cited(rules, "rule_code")))
    changes = steps.compare(fields.limit(0) if published is None else published, fields)
    changes = _settled(changes.limit(0) if published is None else changes)
    items = _settled(steps.review(issues, changes))
    summary = diff.first_version_summary(fields, rules) if published is None else diff.change_summary(changes)
    result = Result(fields, rules, lists, issues, changes, items, summary.first().asDict())
    result.published = steps.publish_when_clean and items.isEmpty() and issues.isEmpty()
    return result


def parts_of(result: Result, document: dict) -> dict[str, DataFrame]:
    """The run's catalog as the parts of a bundle."""
    spark = result.fields.sparkSession
    names = [c.split()[0] for c in bundles.PARTS["document"].split(", ")]
    row = spark.range(1).select(*[F.lit(document.get(c)).cast("string").alias(c) for c in names])
    return {"document": row, "fields": result.fields, "rules": result.rules, "code_lists": result.code_lists}


def save(result: Result, folder: str, document: dict | None = None) -> dict[str, str]:
    """The run's artifacts as JSON lines: the candidate bundle with its document, issues, the diff (a header row with
    its summary, and its changes), review items. The summary of the run follows when all else is done."""
    spark, document = result.fields.sparkSession, document or {}
    bundles.write_parts(parts_of(result, document), f"{folder}/candidate_bundle")
    header = {"base_version_label": document.get("base_version_label"), "candidate_version_label": document.get("version_label"), "summary": result.summary}
    spark.createDataFrame([(json.dumps(header, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/version_diff/header")
    bundles.write(result.changes, f"{folder}/version_diff/changes")
    bundles.write(result.issues, f"{folder}/validation_issues")
    bundles.write(result.items, f"{folder}/review_items")
    return {name: f"{folder}/{name}" for name in ("candidate_bundle", "validation_issues", "version_diff", "review_items")}


def save_summary(result: Result, folder: str) -> str:
    """One line of JSON: the bundle's place, counts, the diff's summary, what was published and stored."""
    row = {
        "bundle_path": result.folders.get("candidate_bundle"), "validation_issue_count": result.issues.count(), "review_item_count": result.items.count(), "diff_summary": result.summary,
        "published_bundle_written": result.published, "database": result.version_id and {"document_version_id": result.version_id, "artifact_count": len(result.folders)},
    }
    spark = result.fields.sparkSession
    spark.createDataFrame([(json.dumps(row, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/run_summary")
    return f"{folder}/run_summary"


def baseline_fields(spark: SparkSession, place: str) -> DataFrame:
    """The fields to compare with: of a bundle file, or of a folder of parts."""
    return bundles.read_parts(spark, place)["fields"] if bundles.exists(spark, place) else bundles.fields(bundles.read(spark, place))


def execute(spark: SparkSession, source: str, decoder, document: dict, out: str, store: Store | None = None, steps: Steps | None = None, baseline: str | None = None) -> Result:
    """A whole run over one document; the baseline is a bundle (a file or a folder of parts) or else the store's latest
    published version."""
    if baseline and store and document.get("use_store_baseline"):
        raise ValueError("a baseline comes from a file or from the store, not from both")
    steps = steps or Steps()
    files = pages.files(spark, source)
    document = {"source_path": source} | document | {"checksum_sha256": files.first()["checksum_sha256"], "source_uri": source}
    found = _settled(steps.parse(files, decoder))
    published = None
    if baseline:
        published = baseline_fields(spark, baseline)
    elif store:
        latest = store.latest_fields(document["jurisdiction"], document["tax_domain"])
        published = None if latest.isEmpty() else latest
    result = run(found, published, steps)
    result.folders = save(result, out, document)
    if result.published:
        result.folders["published_bundle"] = steps.publish(parts_of(result, document), out)
    if store:
        result.version_id = store.persist(
            document["checksum_sha256"], document, result.fields, result.rules, result.code_lists, result.issues, result.changes, result.items, artifacts=result.folders, published=result.published,
        )
        if result.published:
            store.publish(result.version_id, "automatic", "no issues, no review items", result.folders["published_bundle"])
    result.folders["run_summary"] = save_summary(result, out)
    return result


def main(arguments: list[str] | None = None) -> None:
    """Command line over pages that were decoded before: a folder of JSON lines with path, page_number, text, tables."""
    ask = argparse.ArgumentParser(prog="python -m lexledger.runtime", description=main.__doc__)
    for name in ("--pages", "--jurisdiction", "--tax-domain", "--version-label", "--outdir"):
        ask.add_argument(name, required=True)
    ask.add_argument("--language-code", default="en")
    ask.add_argument("--published-bundle", help="a bundle file to compare with")
    ask.add_argument("--auto-publish", action="store_true")
    got = ask.parse_args(arguments)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    published = baseline_fields(spark, got.published_bundle) if got.published_bundle else None
    steps = Steps(publish_when_clean=got.auto_publish)
    result = run(spark.read.schema(pages.PAGE).json(got.pages), published, steps)
    document = {"jurisdiction": got.jurisdiction, "tax_domain": got.tax_domain, "version_label": got.version_label, "language_code": got.language_code}
    result.folders = save(result, got.outdir, document)
    if result.published:
        result.folders["published_bundle"] = steps.publish(parts_of(result, document), got.outdir)
    result.folders["run_summary"] = save_summary(result, got.outdir)
    for name, place in result.folders.items():
        print(name, place)
    print("published", result.published)


if __name__ == "__main__":
    main()

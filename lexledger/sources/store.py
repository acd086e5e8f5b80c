"""The version store: Parquet tables below one folder, partitioned by version.

A version's rows are one partition of each table. Storing it again replaces these partitions by Spark's dynamic
partition overwrite and leaves every other file as it is. Every partition also has a row of nulls, which readers leave
out, so that the partition of a version without rows in a table is replaced as well. Versions are partitioned by jurisdiction and domain, in which they are
looked up. Runs and decisions are appended.

Spark has no transaction over several tables. A version is therefore marked as ``storing`` before its partitions are
written and gets its status last: readers of published versions never see half of one, and a run that died is repaired
by running it again. Writers of different versions do not disturb each other, but for the row of their domain's
versions: a domain has one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexledger import schemas
from lexledger.operators import versions
from lexledger.operators.lineage import settled
from lexledger.sources import bundles

TABLES_AT_A_TIME = 6
BY_VERSION, BY_DOMAIN = ["document_version_id"], ["jurisdiction", "tax_domain"]
#: Of each table its columns, a column that no row lacks, and what it is partitioned by.
TABLES: dict[str, tuple[str, str, list[str]]] = {
    "version": (schemas.VERSION, "document_version_id", BY_DOMAIN), "run": (schemas.RUN, "run_id", []), "decision": (schemas.DECISION, "document_version_id", []),
    "field": (schemas.FIELD_ROW, "field_code", BY_VERSION), "path": (schemas.PATH_ROW, "field_code", BY_VERSION), "citation": (schemas.CITATION, "field_code", BY_VERSION),
    "rule": (schemas.RULE_ROW, "rule_code", BY_VERSION), "rule_link": (schemas.RULE_LINK, "rule_code", BY_VERSION), "rule_citation": (schemas.RULE_CITATION, "rule_code", BY_VERSION),
    "code_list": (schemas.CODE_LIST_ROW, "code_list_name", BY_VERSION), "code_entry": (schemas.CODE_ENTRY, "code_list_name", BY_VERSION), "code_list_citation": (schemas.CODE_LIST_CITATION, "code_list_name", BY_VERSION),
    "issue": (schemas.ISSUE, "code", BY_VERSION), "change": (schemas.CHANGE, "field_code", BY_VERSION), "diff": (schemas.DIFF, "diff_id", BY_VERSION), "queue_item": (schemas.QUEUE_ITEM, "item_id", BY_VERSION),
    "artifact": (schemas.ARTIFACT, "bundle_type", BY_VERSION), "baseline": (schemas.BASELINE, "document_version_id", []),
}
_EVIDENCE = "array<struct<id:bigint,page_number:int,section_title:string,source_kind:string,quote_text:string>>"


def shaped(name: str, df: DataFrame) -> DataFrame:
    """df with the columns of a table, missing ones null."""
    fields = T.StructType.fromDDL(TABLES[name][0]).fields
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def citations(owners: DataFrame, *keys: str) -> DataFrame:
    """A row for each different piece of evidence of each owner: keys, id (its first place in the list), and what it
    says. Evidence that names no section or kind has none."""
    if "evidence" not in owners.columns:
        return owners.limit(0).select(*keys).withColumn("id", F.lit(None).cast("bigint"))
    each = owners.select(*keys, F.posexplode("evidence").alias("id", "e"))
    known = [f.name for f in each.schema["e"].dataType]
    said = ("page_number", "section_title", "source_kind", "quote_text")
    each = each.select(*keys, "id", *[(F.col(f"e.{c}") if c in known else F.lit(None).cast("string")).alias(c) for c in said])
    return each.groupBy(*keys, *said).agg(F.min("id").alias("id"))


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, name: str, *places: str) -> DataFrame:
        ddl, present, _ = TABLES[name]
        schema = T.StructType.fromDDL(ddl)
        try:
            rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*(places or (f"{self.root}/{name}",)))
        except AnalysisException as none:
            if none.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
        return rows.where(F.col(present).isNotNull()).select(*schema.names)

    def table(self, name: str) -> DataFrame:
        """All rows of a table. Conditions on what it is partitioned by prune files."""
        return self._read(name)

    def of(self, name: str, document_version_id: int) -> DataFrame:
        """A version's rows; no other partition is even listed."""
        return self._read(name, f"{self.root}/{name}/document_version_id={document_version_id}")

    def append(self, name: str, rows: DataFrame) -> None:
        shaped(name, rows).write.mode("append").parquet(f"{self.root}/{name}")

    def replace(self, name: str, rows: DataFrame, keys: DataFrame) -> None:
        """Replace the partitions of ``keys`` (distinct values of the table's partition columns) by ``rows``, which has
        no others. A hot partition is written by several tasks."""
        _, _, by = TABLES[name]
        out = shaped(name, rows).unionByName(shaped(name, keys.select(*by)))
        out.hint("rebalance", *by).write.partitionBy(*by).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{self.root}/{name}")

    def save_snapshots(self, ids: DataFrame, snapshot: dict[str, DataFrame]) -> None:
        """Replace what is stored for all versions of ``ids`` (document_version_id) by the tables of a snapshot, each
        with its document_version_id; tables that it doesn't name stay. Tables are written side by side: most of them
        are short jobs."""
        with ThreadPoolExecutor(TABLES_AT_A_TIME) as pool:
            for done in [pool.submit(inheritable_thread_target(self.spark)(self.replace), name, rows, ids) for name, rows in snapshot.items()]:
                done.result()

    def load_snapshots(self, ids: DataFrame | None = None) -> dict[str, DataFrame]:
        """(fields, rules, code_lists) of all versions, or of those of ``ids``, put together again."""
        return assembled(self.table if ids is None else lambda name: self.table(name).join(ids, BY_VERSION, "left_semi"))

    def persist(
        self, checksum: str, document: dict, fields: DataFrame, rules: DataFrame, code_lists: DataFrame, issues: DataFrame, changes: DataFrame, items: DataFrame, stage: str = "extract",
        artifacts: dict[str, str] | None = None, published: bool = False,
    ) -> int:
        """Store one version under (checksum, label): its snapshot replaces what was stored for it, its status goes
        back to candidate, and a run is appended. Of fields with one code the last is stored, of rules the first by
        text; references to unknown fields and empty paths are not; a remark is stored with a path only. The diff is
        pending while items wait for a review. artifacts: the place of each kind of file that the run wrote. Another
        document whose id is the same by chance is refused.
        """
        spark = self.spark
        key = F.pmod(F.xxhash64(F.lit(checksum), F.lit(document["version_label"])), F.lit(2**62))
        vid = spark.range(1).select(key.alias("k")).first()["k"]
        one = lambda **columns: spark.range(1).select(*[c.alias(n) for n, c in columns.items()])
        known = self.table("version")
        before = known.where(F.col("document_version_id") == vid).first()
        if before and (before["checksum_sha256"], before["version_label"]) != (checksum, document["version_label"]):
            raise ValueError(f"version {vid} belongs to another document")
        created = F.lit(before["created_at"]).cast("timestamp") if before else F.current_timestamp()
        values = {c: F.lit(document.get(c)) for c in ("version_label", "jurisdiction", "tax_domain", "language_code", "issued_on", "effective_from", "effective_to")}
        version = settled(one(document_version_id=F.lit(vid), checksum_sha256=F.lit(checksum), source_uri=F.lit(document.get("source_path")), **values, created_at=created, published_at=F.lit(None)))
        base = known.where((F.col("jurisdiction") == document.get("jurisdiction")) & (F.col("tax_domain") == document.get("tax_domain")) & (F.col("version_label") == document.get("base_version_label")))
        base = base.orderBy(F.desc("created_at")).first()
        self._put_version(version.withColumn("status", F.lit("storing")))

        waiting, counts = items.count(), {r["change_type"]: r["count"] for r in changes.groupBy("change_type").count().collect()}
        diff_id = uuid.uuid4().hex
        diff = one(diff_id=F.lit(diff_id), base_version_id=F.lit(base["document_version_id"] if base else None).cast("bigint"), candidate_version_id=F.lit(vid), status=F.lit("pending_review" if waiting else "auto_approved"), summary=F.lit(json.dumps(counts, sort_keys=True)), created_at=F.current_timestamp())
        files = spark.createDataFrame([(k, "published" if k == "published_bundle" else "draft", v) for k, v in (artifacts or {}).items()], "bundle_type string, bundle_status string, artifact_uri string").withColumn("created_at", F.current_timestamp())
        snapshot = rows_of(fields, rules, code_lists) | {
            "issue": issues, "change": changes.withColumn("auto_approved", F.col("risk_level") == "low"), "artifact": files, "diff": diff,
            "queue_item": items.withColumns({"diff_id": F.lit(diff_id), "status": F.lit("pending"), "created_at": F.current_timestamp()}),
        }
        this = one(document_version_id=F.lit(vid))
        self.save_snapshots(this, {name: df.withColumn("document_version_id", F.lit(vid)) for name, df in snapshot.items()})
        metrics = {
            "field_count": self.of("field", vid).count(), "rule_count": self.of("rule", vid).count(), "code_list_count": self.of("code_list", vid).count(), "validation_issue_count": self.of("issue", vid).count(),
            "review_item_count": waiting, "citation_count": self.of("citation", vid).count(), "artifact_count": len(artifacts or {}), "published": published, "diff_summary": counts,
        }
        self.append("run", one(run_id=F.lit(uuid.uuid4().hex), document_version_id=F.lit(vid), stage=F.lit(stage), started_at=F.current_timestamp(), metrics=F.lit(json.dumps(metrics, sort_keys=True))))
        self._put_version(version.withColumn("status", F.lit("candidate")))
        return vid

    def _put_version(self, rows: DataFrame) -> None:
        """Replace the rows of some versions; the other versions of their domains are written again with them."""
        new = settled(shaped("version", rows))
        same = [F.col(f"v.{c}").eqNullSafe(F.col(f"n.{c}")) for c in BY_DOMAIN]
        others = self.table("version").alias("v").join(F.broadcast(new.select(*BY_DOMAIN).distinct()).alias("n"), same, "left_semi").join(new.select("document_version_id"), "document_version_id", "left_anti")
        self.replace("version", others.unionByName(new), new.select(*BY_DOMAIN).distinct())

    def publish(self, document_version_id: int, reviewer: str, comment: str = "", bundle_uri: str | None = None, bundle_checksum: str | None = None) -> None:
        """Publish a version whatever its issues: its diffs are published, their queue items resolved, each diff gets
        an approval, and its bundle is registered. Versions published before stay so; each call adds decisions. Only
        this version's partitions change."""
        ids = self.spark.createDataFrame([(document_version_id,)], "document_version_id bigint")
        diffs = self.of("diff", document_version_id)
        decisions = versions.decisions_of(diffs, ids, reviewer, comment).withColumn("decided_at", F.current_timestamp())
        self.append("decision", decisions)
        changed = {"queue_item": versions.items_resolved(self.of("queue_item", document_version_id), diffs, ids), "diff": versions.diffs_published(diffs, ids)}
        if bundle_uri:
            row = ids.withColumns({"bundle_type": F.lit("published_bundle"), "bundle_status": F.lit("published"), "artifact_uri": F.lit(bundle_uri), "checksum_sha256": F.lit(bundle_checksum), "created_at": F.current_timestamp()})
            changed["artifact"] = versions.upserted(self.of("artifact", document_version_id), shaped("artifact", row), ["document_version_id", "bundle_type", "bundle_status"])
        self.save_snapshots(ids, {name: settled(df) for name, df in changed.items()})
        known = self.table("version").where(F.col("document_version_id") == document_version_id)
        self._put_version(versions.published_now(known, ids, F.current_timestamp()))

    def latest_fields(self, jurisdiction: str, tax_domain: str) -> DataFrame:
        """Fields of the latest published version, paths put back."""
        known = self.table("version").where((F.col("jurisdiction") == jurisdiction) & (F.col("tax_domain") == tax_domain))
        latest = versions.latest_published(known).first()
        return self._fields(latest["document_version_id"] if latest else None)

    def promote(self, document_version_id: int, profile: str) -> None:
        """Make a published version the baseline that runs of a profile in its domain are compared with, from now on.
        Promotions are appended, so what was the baseline before can be read."""
        row = self.table("version").where((F.col("document_version_id") == document_version_id) & (F.col("status") == "published"))
        if row.isEmpty():
            raise LookupError(f"version {document_version_id} is not published")
        self.append("baseline", settled(row.select(*BY_DOMAIN, "document_version_id").withColumns({"profile": F.lit(profile), "promoted_at": F.current_timestamp()})))

    def baseline_fields(self, jurisdiction: str, tax_domain: str, profile: str) -> DataFrame:
        """Fields of the last version that was promoted for a profile, paths put back; none without one."""
        known = self.table("baseline").where((F.col("jurisdiction") == jurisdiction) & (F.col("tax_domain") == tax_domain) & (F.col("profile") == profile))
        last = known.orderBy(F.desc("promoted_at"), F.desc("document_version_id")).first()
        return self._fields(last["document_version_id"] if last else None)

    def _fields(self, document_version_id: int | None) -> DataFrame:
        of = (lambda name: self.table(name).limit(0)) if document_version_id is None else (lambda name: self.of(name, document_version_id))
        return of("field").join(versions.paths_of(of("path"), "document_version_id"), ["document_version_id", "field_code"], "left")

    def summary(self, document_version_id: int) -> DataFrame:
        """One row: the version with its latest run, its latest diff, the sorted types of its artifacts and the counter
        of each kind of row; no row if it is not stored."""
        version = self.table("version").where(F.col("document_version_id") == document_version_id)
        runs = self.table("run").where(F.col("document_version_id") == document_version_id)
        found = versions.listed(version, runs, self.of("artifact", document_version_id), self.of("diff", document_version_id).drop("document_version_id"), 1)
        for name in ("field", "rule", "code_list", "issue", "change", "queue_item"):
            found = found.crossJoin(self.of(name, document_version_id).agg(F.count("*").alias(f"{name}_count")))  # two single rows
        return found

    def bundle(self, document_version_id: int) -> dict[str, DataFrame]:
        """A stored version as it was: its document row, its fields with paths and evidence, its rules with references
        and evidence, its code lists with entries and evidence. A version whose storing has not ended is an error."""
        document = self.table("version").where(F.col("document_version_id") == document_version_id)
        row = document.first()
        if row is None or row["status"] == "storing":
            raise LookupError(f"version {document_version_id} is {'not stored' if row is None else 'being stored'}")
        return {"document": document, **assembled(lambda name: self.of(name, document_version_id))}

    def materialise(self, document_version_id: int, folder: str) -> dict[str, str]:
        """Write a stored version's bundle as parts below ``folder``."""
        return bundles.write_parts(self.bundle(document_version_id), folder)

    def published_bundle(self, document_version_id: int, folder: str) -> str:
        """The place of a version's published bundle: the registered one if it is there, else a copy of the registered
        candidate beside it, else what the store gives back, written below ``folder``."""
        places = {r["bundle_type"]: r["artifact_uri"] for r in self.of("artifact", document_version_id).collect()}
        there = lambda place: place if place and bundles.exists(self.spark, place) else None
        if there(places.get("published_bundle")):
            return places["published_bundle"]
        if candidate := there(places.get("candidate_bundle")):
            target = f"{candidate.rstrip('/').rpartition('/')[0]}/published_bundle"
            bundles.write_parts(bundles.read_parts(self.spark, candidate), target)
            return target
        target = f"{folder.rstrip('/')}/{document_version_id}/published_bundle"
        self.materialise(document_version_id, target)
        return target


def rows_of(fields: DataFrame, rules: DataFrame, code_lists: DataFrame, *keys: str) -> dict[str, DataFrame]:
    """The rows of a catalog (or of several, told apart by ``keys``) in the tables of the store."""
    if "value_set_refs" not in fields.columns and "refs" in fields.columns:
        fields = fields.withColumnRenamed("refs", "value_set_refs")
    stored = versions.first_of(fields, [*keys, "field_code"], F.desc("ord"))
    rules = versions.first_of(rules, [*keys, "rule_code"], F.col("expression_text"))
    links = rules.select(*keys, "rule_code", F.explode(F.array_distinct("refs")).alias("ref")).join(stored.select(*keys, F.col("field_code").alias("ref")), [*keys, "ref"], "left_semi")
    written = F.to_json(F.struct(F.coalesce("refs", F.array().cast("array<string>")).alias("referenced_fields")))
    entries = code_lists.select(*keys, "code_list_name", F.posexplode("entries").alias("position", "e"))
    entry = [f.name for f in entries.schema["e"].dataType]
    entries = entries.select(*keys, "code_list_name", (F.col("position") + 1).alias("position"), *[F.col(f"e.{c}") for c in ("code", "label", "description") if c in entry])
    entries = versions.first_of(entries, [*keys, "code_list_name", "code"], F.desc("position"))  # the last label of a code
    return {
        "field": stored, "path": versions.path_rows(stored, *keys), "citation": citations(stored, *keys, "field_code"), "rule": rules.withColumn("normalized_expression", written), "rule_link": links,
        "rule_citation": citations(rules, *keys, "rule_code"), "code_list": code_lists.select(*keys, *[c for c in ("code_list_name", "origin", "confidence") if c in code_lists.columns]), "code_entry": entries,
        "code_list_citation": citations(code_lists, *keys, "code_list_name"),
    }


def assembled(table: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    """Fields with paths and evidence, rules with references and evidence, code lists with entries and evidence."""
    by = BY_VERSION
    fields = table("field").join(versions.paths_of(table("path"), *by), [*by, "field_code"], "left")
    return {
        "fields": _with_evidence(fields, table("citation"), *by, "field_code"),
        "rules": _with_evidence(versions.with_references(table("rule"), table("rule_link"), *by), table("rule_citation"), *by, "rule_code"),
        "code_lists": _with_evidence(versions.with_entries(table("code_list"), table("code_entry"), *by), table("code_list_citation"), *by, "code_list_name"),
    }


def _with_evidence(owners: DataFrame, cited: DataFrame, *keys: str) -> DataFrame:
    """owners with their evidence in the order of pages."""
    said = F.array_sort(F.collect_list(F.struct("page_number", "id", "section_title", "source_kind", "quote_text")))
    each = cited.groupBy(*keys).agg(F.transform(said, lambda e: F.struct(e["id"].alias("id"), *[e[c].alias(c) for c in ("page_number", "section_title", "source_kind", "quote_text")])).alias("evidence"))
    return owners.join(each, list(keys), "left").withColumn("evidence", F.coalesce("evidence", F.array().cast(_EVIDENCE)))

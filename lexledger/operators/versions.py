"""Read models over stored versions, and their state changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Height of the tree of days: 2 ** HEIGHT days hold the years 1 to 9999, the range of a Spark date.
HEIGHT = 22

#: Days from the first one of the year 1 to 1970.
DAY_ONE = 719162


def first_of(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key. The planner drops later rows before the shuffle as well."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def latest_published(versions: DataFrame) -> DataFrame:
    """Of each jurisdiction and domain the published version in force last: by effective or else issue date, then creation."""
    order = (F.coalesce("effective_from", "issued_on").desc_nulls_last(), F.desc("created_at"), F.desc("document_version_id"))
    return first_of(versions.where("status = 'published'"), ["jurisdiction", "tax_domain"], *order)


def by_label(versions: DataFrame, label: str) -> DataFrame:
    return first_of(versions.where(F.col("version_label") == label), ["jurisdiction", "tax_domain"], F.desc("created_at"), F.desc("document_version_id"))


def _leaf(day: str) -> Column:
    return F.unix_date(F.col(day).cast("date")).cast("long") + DAY_ONE + 2**HEIGHT


def in_force(versions: DataFrame, dates: DataFrame) -> DataFrame:
    """For each (jurisdiction, tax_domain, on_date) the published version whose period holds the date: its id and
    effective_from, the latest start first, then the largest id. Periods are of whole days; one that ends before it
    starts holds none.

    Days are the leaves of a binary tree. A period is cut into at most two nodes a level and each node keeps its best
    version, so a date looks into HEIGHT + 1 nodes, however many versions its domain has.
    """
    keys = ["jurisdiction", "tax_domain"]
    some = versions.where("status = 'published' AND effective_from IS NOT NULL")
    low, high = _leaf("effective_from"), F.coalesce(_leaf("effective_to") + 1, F.lit(2 ** (HEIGHT + 1)))
    nodes = F.expr(
        f"""filter(flatten(transform(transform(sequence(0, {HEIGHT}),
              k -> struct(shiftright(low + shiftleft(1L, k) - 1, k) AS l, shiftright(high, k) AS r)),
              x -> array(CASE WHEN x.l < x.r AND x.l % 2 = 1 THEN x.l END, CASE WHEN x.l < x.r AND x.r % 2 = 1 THEN x.r - 1 END))),
              n -> n IS NOT NULL)"""
    )
    best = F.max(F.struct("effective_from", "document_version_id")).alias("best")
    cut = some.select(*keys, "effective_from", "document_version_id", low.alias("low"), high.alias("high"))
    cut = cut.select(*keys, "effective_from", "document_version_id", F.explode(nodes).alias("node"))
    above = F.array(*(F.shiftright(_leaf("on_date"), level) for level in range(HEIGHT + 1)))
    asked = dates.where("on_date IS NOT NULL").select(*keys, "on_date", F.explode(above).alias("node"))
    held = asked.join(cut.groupBy(*keys, "node").agg(best), [*keys, "node"])
    return held.groupBy(*keys, "on_date").agg(F.max("best").alias("best")).select(*keys, "on_date", "best.*")


def artifact_map(artifacts: DataFrame) -> DataFrame:
    """(document_version_id, bundle_type, artifact_uri): of each type the last that has a place."""
    some = artifacts.where("artifact_uri IS NOT NULL AND artifact_uri <> ''")
    return some.groupBy("document_version_id", "bundle_type").agg(F.max(F.struct("created_at", "id", "artifact_uri"))["artifact_uri"].alias("artifact_uri"))


def listed(versions: DataFrame, runs: DataFrame, artifacts: DataFrame, diffs: DataFrame, most: int = 20) -> DataFrame:
    """Versions with their latest run, their latest diff and the sorted types of their artifacts, the most recent
    first, at most ``most`` of them. The page is cut before the joins, so that the rest is only looked up for it."""
    if not 1 <= most <= 100:
        raise ValueError("most must be between 1 and 100")
    recent = F.coalesce("published_at", "created_at").desc_nulls_last()
    page = versions.orderBy(recent, F.desc("document_version_id")).limit(most)
    wanted = F.broadcast(page.select("document_version_id"))  # at most 100 rows
    last = first_of(runs.join(wanted, "document_version_id", "left_semi"), ["document_version_id"], F.desc("started_at"), F.desc("run_id"))
    diff = first_of(diffs.join(wanted, F.col("candidate_version_id") == F.col("document_version_id"), "left_semi"), ["candidate_version_id"], F.desc("created_at"), F.desc("diff_id"))
    diff = diff.select(F.col("candidate_version_id").alias("document_version_id"), F.col("summary").alias("diff_summary"))
    types = artifacts.join(wanted, "document_version_id", "left_semi").groupBy("document_version_id").agg(F.array_sort(F.collect_set("bundle_type")).alias("types"))
    return (
        page.join(last.select("document_version_id", "run_id", "stage", "metrics"), "document_version_id", "left").join(diff, "document_version_id", "left").join(types, "document_version_id", "left")
        .withColumn("types", F.coalesce("types", F.array().cast("array<string>")))
    )


def published_now(versions: DataFrame, version_ids: DataFrame, at: Column) -> DataFrame:
    """The version table after publishing the given ids. Others keep their status, also those published before."""
    hit = version_ids.select("document_version_id", F.lit(True).alias("_hit")).distinct()
    marked = versions.join(hit, "document_version_id", "left")
    return marked.withColumn("status", F.when(F.col("_hit"), "published").otherwise(F.col("status"))).withColumn("published_at", F.when(F.col("_hit"), at).otherwise(F.col("published_at"))).drop("_hit")


def upserted(table: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """The table with changed rows in place of those with the same keys, and new ones added."""
    return table.join(changes.select(*keys), keys, "left_anti").unionByName(changes)


def snapshot_replaced(table: DataFrame, snapshot: DataFrame, key: str = "document_version_id") -> DataFrame:
    """The table with all rows of the snapshot's versions replaced by the snapshot."""
    return table.join(snapshot.select(key).distinct(), key, "left_anti").unionByName(snapshot)


def nested_fields(fields: DataFrame, paths: DataFrame, evidence: DataFrame) -> DataFrame:
    """Fields with the map of their paths and their evidence in (page, id) order."""
    by_kind = lambda kind: F.max(F.when(F.col("doc_kind") == kind, F.col("path_text")))
    p = paths.groupBy("field_code").agg(by_kind("invoice").alias("invoice"), by_kind("credit_note").alias("credit_note"))
    e = evidence.groupBy("field_code").agg(F.array_sort(F.collect_list(F.struct("page_number", "id", "source_kind", "quote_text"))).alias("evidence"))
    return fields.join(p, "field_code", "left").join(e, "field_code", "left")


def rule_references(rules: DataFrame, fields: DataFrame) -> DataFrame:
    """(rule_code, refs): sorted references to known fields."""
    known = rules.join(fields.select(F.col("field_code").alias("ref")).distinct(), "ref")
    return known.groupBy("rule_code").agg(F.array_sort(F.collect_set("ref")).alias("refs"))


def missing_references(rules: DataFrame, fields: DataFrame) -> DataFrame:
    """Codes of fields that rules refer to and nothing defines."""
    refs = rules.where(F.col("ref").rlike("^(HR-)?BT-")).select("ref").distinct()
    return refs.join(fields.select(F.col("field_code").alias("ref")), "ref", "left_anti").select(F.col("ref").alias("field_code"))


def code_lists(refs: DataFrame, *keys: str) -> DataFrame:
    """(keys, code_list_name, code, label, position): entries of each reference, a code's first label wins, in first-seen
    order.

    refs: keys, record_ord, pos, ref. Every reference name of a record gets all other values of that record as entries.
    """
    from lexledger.functions import text as t

    keys = list(keys)
    named = refs.where(t.is_reference_name(F.col("ref"))).select(*keys, "record_ord", F.col("ref").alias("code_list_name")).distinct()
    entries = refs.where(~t.is_reference_name(F.col("ref"))).select(*keys, "record_ord", "pos", t.entry_code(F.col("ref")).alias("code"), t.entry_label(F.col("ref")).alias("label")).where("code <> ''")
    first = first_of(named.join(entries, [*keys, "record_ord"]), [*keys, "code_list_name", "code"], F.col("record_ord"), F.col("pos"))
    return first.select(*keys, "code_list_name", "code", "label", F.row_number().over(Window.partitionBy(*keys, "code_list_name").orderBy("record_ord", "pos")).alias("position"))


def code_list_definitions(fields: DataFrame, *keys: str) -> DataFrame:
    """(keys, code_list_name, entries, origin, confidence, evidence) of all lists that fields' value sets name, those
    without entries included. The evidence is that of the first field that names the list.

    fields: keys, ord, value_set_refs, evidence.
    """
    from lexledger.functions import text as t

    keys = list(keys)
    refs = fields.select(*keys, F.col("ord").alias("record_ord"), F.posexplode("value_set_refs").alias("pos", "ref"))
    entries = code_lists(refs, *keys).withColumn("description", F.lit(None).cast("string"))
    named = fields.select(*keys, "ord", "evidence", F.posexplode("value_set_refs").alias("pos", "code_list_name")).where(t.is_reference_name(F.col("code_list_name")))
    first = first_of(named, [*keys, "code_list_name"], F.col("ord"), F.col("pos")).select(*keys, "code_list_name", "evidence", F.lit("explicit").alias("origin"), F.lit(0.9).alias("confidence"))
    return with_entries(first, entries, *keys)


def path_rows(fields: DataFrame, *keys: str) -> DataFrame:
    """(keys, field_code, remark, doc_kind, path_text): a row for each path that is not empty."""
    each = fields.select(*keys, "field_code", "remark", F.expr("stack(2, 'invoice', invoice_path, 'credit_note', credit_note_path) AS (doc_kind, path_text)"))
    return each.where("path_text IS NOT NULL AND path_text <> ''")


def paths_of(rows: DataFrame, *keys: str) -> DataFrame:
    """Path rows put together again: invoice_path, credit_note_path and remark of each field."""
    kind = lambda name: F.max(F.when(F.col("doc_kind") == name, F.col("path_text")))
    return rows.groupBy(*keys, "field_code").agg(kind("invoice").alias("invoice_path"), kind("credit_note").alias("credit_note_path"), F.max("remark").alias("remark"))


def latest_diffs(diffs: DataFrame, versions: DataFrame) -> DataFrame:
    """Of each candidate its latest diff, with the labels of both versions; the base may be missing, a diff whose
    candidate is not stored is left out."""
    label = lambda name: versions.select(F.col("document_version_id").alias(f"{name}_version_id"), F.col("version_label").alias(f"{name}_version_label"))
    last = first_of(diffs, ["candidate_version_id"], F.desc("created_at"), F.desc("diff_id"))
    return last.join(label("base"), "base_version_id", "left").join(label("candidate"), "candidate_version_id")


def review_payload(diffs: DataFrame, items: DataFrame) -> DataFrame:
    """(candidate_version_id, position, item_id, risk_level): the queue of each candidate, over all its diffs, in the
    order in which items were made."""
    of = items.join(diffs.select("diff_id", "candidate_version_id"), "diff_id")
    order = Window.partitionBy("candidate_version_id").orderBy("created_at", "id")
    return of.select("candidate_version_id", F.row_number().over(order).alias("position"), "item_id", "risk_level")


def diffs_published(diffs: DataFrame, version_ids: DataFrame) -> DataFrame:
    """The diffs after publishing the given versions: those with one of them as candidate are published."""
    hit = version_ids.select(F.col("document_version_id").alias("candidate_version_id"), F.lit(True).alias("_hit")).distinct()
    return diffs.join(hit, "candidate_version_id", "left").withColumn("status", F.when(F.col("_hit"), "published").otherwise(F.col("status"))).drop("_hit")


def items_resolved(items: DataFrame, diffs: DataFrame, version_ids: DataFrame) -> DataFrame:
    """The queue after publishing the given versions: items of their diffs are resolved."""
    ids = version_ids.select(F.col("document_version_id").alias("candidate_version_id"))
    hit = diffs.join(ids, "candidate_version_id", "left_semi").select("diff_id", F.lit(True).alias("_hit")).distinct()
    return items.join(hit, "diff_id", "left").withColumn("status", F.when(F.col("_hit"), "resolved").otherwise(F.col("status"))).drop("_hit")


def decisions_of(diffs: DataFrame, version_ids: DataFrame, reviewer: str, comment: str) -> DataFrame:
    """An approval for each diff of the given versions."""
    ids = version_ids.select(F.col("document_version_id").alias("candidate_version_id"))
    some = diffs.join(ids, "candidate_version_id", "left_semi")
    return some.select("diff_id", F.col("candidate_version_id").alias("document_version_id"), F.lit("approve").alias("decision"), F.lit(reviewer).alias("reviewer"), F.lit(comment).alias("comment"))


def with_references(rules: DataFrame, refs: DataFrame, *keys: str) -> DataFrame:
    """Rules with their sorted references."""
    keys = (*keys, "rule_code")
    r = refs.groupBy(*keys).agg(F.array_sort(F.collect_set("ref")).alias("refs"))
    return rules.join(r, list(keys), "left").withColumn("refs", F.coalesce("refs", F.array().cast("array<string>")))


def nested_rules(rules: DataFrame, refs: DataFrame, citations: DataFrame, *keys: str) -> DataFrame:
    """Rules with their sorted references and their evidence in (page, id) order."""
    e = citations.groupBy(*keys, "rule_code").agg(F.array_sort(F.collect_list(F.struct("page_number", "id", "source_kind", "quote_text"))).alias("evidence"))
    return with_references(rules, refs, *keys).join(e, [*keys, "rule_code"], "left")


def with_entries(lists: DataFrame, entries: DataFrame, *keys: str) -> DataFrame:
    """Code lists with their entries by position; a list without entries has none."""
    keys = (*keys, "code_list_name")
    said = [c for c in ("position", "code", "label", "description") if c in entries.columns]
    e = entries.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*said))).alias("entries"))
    return lists.join(e, list(keys), "left").withColumn("entries", F.coalesce("entries", F.array().cast(e.schema["entries"].dataType)))


def with_fallback(summary: DataFrame, artifacts: DataFrame, stored_items: DataFrame, stored_diffs: DataFrame) -> DataFrame:
    """Versions with what their artifacts say of review and diff; where the review artifact is missing or empty the
    stored queue counts, where the diff artifact is missing the latest stored diff.

    artifacts: document_version_id, bundle_type, payload. The others: document_version_id and review or diff.
    """
    of = lambda kind, name: artifacts.where(F.col("bundle_type") == kind).select("document_version_id", F.col("payload").alias(name))
    some = summary.join(of("review_items", "own_review"), "document_version_id", "left").join(of("version_diff", "own_diff"), "document_version_id", "left")
    some = some.join(stored_items, "document_version_id", "left").join(stored_diffs, "document_version_id", "left")
    own = F.when(F.coalesce("own_review", F.lit("[]")) != "[]", F.col("own_review"))
    return some.select(*summary.columns, F.coalesce(own, "review", F.lit("[]")).alias("review"), F.coalesce("own_diff", "diff").alias("diff"))

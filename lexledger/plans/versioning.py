"""Queries over stored versions: read models, joins, state changes, metrics over time."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexledger.functions import numbers
from lexledger.operators import enrich, versions
from lexledger.operators.contain import found_in
from lexledger.operators.lineage import shared_folder
from lexledger.plans.registering import registrar
from lexledger.sources.store import Store
from lexledger.streaming import metrics

QUERIES, ORACLES, query, _ = registrar()


def _first(keys: str, order: str) -> str:
    return f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


@query("SELECT jurisdiction, tax_domain, document_version_id, version_label FROM {versions} WHERE status = 'published' " + _first("jurisdiction, tax_domain", "coalesce(effective_from, issued_on) DESC NULLS LAST, created_at DESC, document_version_id DESC"))
def latest_published(v):
    return versions.latest_published(v["versions"]).select("jurisdiction", "tax_domain", "document_version_id", "version_label")


@query("SELECT jurisdiction, tax_domain, document_version_id FROM {versions} WHERE version_label = '1-URGENT' " + _first("jurisdiction, tax_domain", "created_at DESC, document_version_id DESC"))
def version_by_label(v):
    return versions.by_label(v["versions"], "1-URGENT").select("jurisdiction", "tax_domain", "document_version_id")


@query("SELECT jurisdiction, tax_domain, document_version_id, created_at FROM {versions} WHERE status = 'candidate' AND jurisdiction = 5 ORDER BY coalesce(published_at, created_at) DESC NULLS LAST, document_version_id DESC LIMIT 100")
def recent_candidates(v):
    some = v["versions"].where("status = 'candidate' AND jurisdiction = 5")
    return some.orderBy(F.coalesce("published_at", "created_at").desc_nulls_last(), F.desc("document_version_id")).limit(100).select("jurisdiction", "tax_domain", "document_version_id", "created_at")


@query(f"""WITH page AS (SELECT * FROM {{versions}} ORDER BY coalesce(published_at, created_at) DESC NULLS LAST, document_version_id DESC LIMIT 100),
  r AS (SELECT * FROM {{runs}} {_first("document_version_id", "started_at DESC, run_id DESC")}),
  a AS (SELECT document_version_id, string_agg(bundle_type, ',' ORDER BY bundle_type) AS types FROM (SELECT DISTINCT document_version_id, bundle_type FROM {{artifacts}}) GROUP BY 1),
  d AS (SELECT * FROM {{diffs}} {_first("candidate_version_id", "created_at DESC, diff_id DESC")})
  SELECT page.document_version_id, page.status, r.run_id, r.stage, d.summary AS diff_summary, coalesce(a.types, '') AS types, coalesce(try_cast(json_extract_string(r.metrics, '$.k') AS INT), 0) AS counter
  FROM page LEFT JOIN r USING (document_version_id) LEFT JOIN a USING (document_version_id) LEFT JOIN d ON d.candidate_version_id = page.document_version_id""")
def list_versions(v):
    page = versions.listed(v["versions"], v["runs"], v["artifacts"], v["diffs"], most=100)
    return page.select("document_version_id", "status", "run_id", "stage", "diff_summary", F.array_join("types", ",").alias("types"), numbers.json_counter(F.col("metrics"), "k").alias("counter"))


@query("SELECT document_version_id, bundle_type, artifact_uri FROM {artifacts} WHERE artifact_uri IS NOT NULL AND artifact_uri <> '' " + _first("document_version_id, bundle_type", "created_at DESC, id DESC, artifact_uri DESC"))
def artifact_map(v):
    return versions.artifact_map(v["artifacts"])


@query("SELECT document_version_id, run_id, stage FROM {runs} " + _first("document_version_id", "started_at DESC, run_id DESC"))
def latest_run(v):
    return versions.first_of(v["runs"], ["document_version_id"], F.desc("started_at"), F.desc("run_id")).select("document_version_id", "run_id", "stage")


@query("""WITH d AS (SELECT DISTINCT c_nationkey AS jurisdiction, c_mktsegment AS tax_domain, date_trunc('month', o_orderdate) AS on_date FROM orders JOIN customer ON o_custkey = c_custkey)
  SELECT d.jurisdiction, d.tax_domain, d.on_date, v.document_version_id FROM d JOIN {versions} v ON d.jurisdiction = v.jurisdiction AND d.tax_domain = v.tax_domain
  WHERE status = 'published' AND effective_from <= on_date AND (effective_to IS NULL OR on_date <= effective_to) """ + _first("d.jurisdiction, d.tax_domain, d.on_date", "effective_from DESC, document_version_id DESC"))
def effective_bundle(v):
    dates = v["orders"].join(v["customer"], F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").alias("jurisdiction"), F.col("c_mktsegment").alias("tax_domain"), F.date_trunc("month", "o_orderdate").alias("on_date")).distinct()
    return versions.in_force(v["versions"], dates).select("jurisdiction", "tax_domain", "on_date", "document_version_id")


@query("""SELECT f.field_code, f.invoice_path AS invoice, f.credit_note_path AS credit_note, coalesce(e.quotes, '') AS quotes FROM {base_fields} f LEFT JOIN (
    SELECT field_code, string_agg(concat(page_number, '/', id, '/', source_kind, '/', quote_text), ';' ORDER BY page_number, id, source_kind, quote_text) AS quotes FROM {all_evidence} GROUP BY field_code) e USING (field_code)""")
def bundle_fields_nested(v):
    fields = v["base_fields"]
    paths = fields.select("field_code", F.expr("stack(2, 'invoice', invoice_path, 'credit_note', credit_note_path) AS (doc_kind, path_text)")).where("path_text IS NOT NULL")
    nested = versions.nested_fields(fields.select("field_code"), paths, v["all_evidence"])
    one = lambda e: F.concat_ws("/", e["page_number"].cast("string"), e["id"].cast("string"), e["source_kind"], e["quote_text"])
    return nested.select("field_code", "invoice", "credit_note", F.coalesce(F.array_join(F.transform("evidence", one), ";"), F.lit("")).alias("quotes"))


@query("SELECT rule_code, string_agg(ref, ',' ORDER BY ref) AS refs FROM {rules} WHERE ref IN (SELECT field_code FROM {cand_fields}) GROUP BY rule_code")
def rule_refs(v):
    return versions.rule_references(v["rules"], v["cand_fields"]).select("rule_code", F.array_join("refs", ",").alias("refs"))


@query("SELECT DISTINCT ref AS field_code FROM {rules} WHERE ref NOT IN (SELECT field_code FROM {cand_fields})")
def missing_ref_fields(v):
    return versions.missing_references(v["rules"], v["cand_fields"])


_REFS = """SELECT r_regionkey AS record_ord, 0 AS pos, concat('ISO ', r_name) AS ref FROM {region}
  UNION ALL SELECT n_regionkey, n_nationkey + 1, concat(n_nationkey % 7, ' - ', n_name) FROM {nation} UNION ALL SELECT n_nationkey % 2, 100 + n_nationkey, 'EACT' FROM {nation}"""


@query(f"""WITH refs AS ({_REFS}), n AS (SELECT DISTINCT record_ord, ref AS code_list_name FROM refs WHERE ref LIKE 'ISO%' OR ref LIKE 'EACT%'),
  e AS (SELECT record_ord, pos, split_part(ref, ' - ', 1) AS code, split_part(ref, ' - ', 2) AS label FROM refs WHERE ref LIKE '% - %'),
  f AS (SELECT code_list_name, code, label, record_ord, pos FROM n JOIN e USING (record_ord) {_first("code_list_name, code", "record_ord, pos")})
  SELECT code_list_name, code, label, CAST(row_number() OVER (PARTITION BY code_list_name ORDER BY record_ord, pos) AS INT) AS position FROM f""")
def code_lists(v):
    return versions.code_lists(v.spark.sql(_REFS, region=v["region"], nation=v["nation"]))


@query("""SELECT document_version_id, CASE WHEN document_version_id % 97 = 0 THEN 'published' ELSE status END AS status,
  CASE WHEN document_version_id % 97 = 0 THEN TIMESTAMP '2030-01-01 00:00:00' ELSE published_at END AS published_at FROM {versions}""")
def publish_transition(v):
    ids = v["versions"].where("document_version_id % 97 = 0")
    return versions.published_now(v["versions"], ids, F.lit("2030-01-01 00:00:00").cast("timestamp")).select("document_version_id", "status", "published_at")


@query("SELECT field_code, field_name FROM {pub_fields} WHERE field_code NOT IN (SELECT field_code FROM {cand_fields}) UNION ALL SELECT field_code, field_name FROM {cand_fields}")
def upsert_state(v):
    two = lambda name: v[name].select("field_code", "field_name")
    return versions.upserted(two("pub_fields"), two("cand_fields"), ["field_code"])


_CITES = "SELECT DISTINCT l_suppkey AS document_version_id, concat('BT-', l_partkey) AS field_code FROM {lineitem}"
_NEWER = "SELECT DISTINCT l_suppkey AS document_version_id, concat('BT-', l_partkey, l_returnflag) AS field_code FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey WHERE s_acctbal < 0"


@query(f"WITH a AS ({_CITES}), b AS ({_NEWER}) SELECT * FROM a WHERE document_version_id NOT IN (SELECT document_version_id FROM b) UNION ALL SELECT * FROM b")
def snapshot_replace(v):
    """All stored citations; suppliers in debt are versions whose snapshot is stored anew."""
    return versions.snapshot_replaced(v.spark.sql(_CITES, lineitem=v["lineitem"]), v.spark.sql(_NEWER, lineitem=v["lineitem"], supplier=v["supplier"]))


_STORED_CITES = "SELECT DISTINCT l_suppkey AS document_version_id, concat('BT-', l_partkey) AS field_code, CAST(l_linenumber AS INT) AS page_number, l_returnflag AS source_kind, l_linestatus AS quote_text FROM {lineitem}"
_STORED_AGAIN = "SELECT DISTINCT l_suppkey AS document_version_id, concat('BT-', l_partkey, l_returnflag) AS field_code, CAST(l_linenumber AS INT) AS page_number, l_returnflag AS source_kind, l_linestatus AS quote_text FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey WHERE s_acctbal < 0 AND l_quantity > 25"


@query(f"WITH a AS ({_STORED_CITES}), b AS ({_STORED_AGAIN}) SELECT * FROM a WHERE document_version_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) UNION ALL SELECT * FROM b")
def stored_citations(v):
    """A store of all suppliers as versions, of which those in debt are stored anew: their partitions only are replaced."""
    store = Store(v.spark, f"{shared_folder(v.spark)}/citations-{uuid.uuid4().hex}")
    ids = v["supplier"].select(F.col("s_suppkey").alias("document_version_id"), "s_acctbal")
    store.save_snapshots(ids, {"citation": v.spark.sql(_STORED_CITES, lineitem=v["lineitem"])})
    store.save_snapshots(ids.where("s_acctbal < 0"), {"citation": v.spark.sql(_STORED_AGAIN, lineitem=v["lineitem"], supplier=v["supplier"])})
    return store.table("citation").drop("id", "section_title")


@query("""WITH d AS (SELECT * FROM {diffs} QUALIFY row_number() OVER (PARTITION BY candidate_version_id ORDER BY created_at DESC, diff_id DESC) = 1)
  SELECT d.diff_id, d.candidate_version_id, d.summary, b.version_label AS base_version_label, c.version_label AS candidate_version_label
  FROM d LEFT JOIN {versions} b ON b.document_version_id = d.base_version_id JOIN {versions} c ON c.document_version_id = d.candidate_version_id""")
def latest_diff(v):
    return versions.latest_diffs(v["diffs"], v["versions"]).select("diff_id", "candidate_version_id", "summary", "base_version_label", "candidate_version_label")


@query("""SELECT candidate_version_id, CAST(row_number() OVER (PARTITION BY candidate_version_id ORDER BY i.created_at, i.id) AS INT) AS position, item_id, risk_level
  FROM {queue_items} i JOIN {diffs} d USING (diff_id)""")
def review_payload(v):
    return versions.review_payload(v["diffs"], v["queue_items"])


_OUT = "(SELECT document_version_id FROM {versions} WHERE status = 'candidate' AND effective_to IS NOT NULL)"


@query(f"""SELECT 'diff' AS kind, diff_id AS id, CASE WHEN candidate_version_id IN {_OUT} THEN 'published' ELSE status END AS status FROM {{diffs}}
  UNION ALL SELECT 'item', id, CASE WHEN diff_id IN (SELECT diff_id FROM {{diffs}} WHERE candidate_version_id IN {_OUT}) THEN 'resolved' ELSE status END FROM {{queue_items}}
  UNION ALL SELECT 'decision', diff_id, 'approve' FROM {{diffs}} WHERE candidate_version_id IN {_OUT}
  UNION ALL SELECT 'bundle', document_version_id, 'published' FROM {_OUT} o""")
def publish_effects(v):
    """What publishing all candidates that have an end changes: diffs, queue items, decisions, bundles."""
    ids = v["versions"].where("status = 'candidate' AND effective_to IS NOT NULL").select("document_version_id")
    row = lambda df, kind, id_, status: df.select(F.lit(kind).alias("kind"), F.col(id_).alias("id"), (F.lit(status) if status else F.col("status")).alias("status"))
    parts = (
        row(versions.diffs_published(v["diffs"], ids), "diff", "diff_id", None), row(versions.items_resolved(v["queue_items"], v["diffs"], ids), "item", "id", None),
        row(versions.decisions_of(v["diffs"], ids, "me", ""), "decision", "diff_id", "approve"), row(ids, "bundle", "document_version_id", "published"),
    )
    return reduce(DataFrame.unionByName, parts)


@query("""SELECT r.rule_code, r.expression_text, coalesce(f.refs, '') AS refs, coalesce(e.quotes, '') AS quotes FROM (SELECT concat('BR-', o_orderkey) AS rule_code, expression_text FROM {rule_text}) r
  LEFT JOIN (SELECT rule_code, string_agg(ref, ',' ORDER BY ref) AS refs FROM {rules} WHERE ref IN (SELECT field_code FROM {base_fields}) GROUP BY rule_code) f USING (rule_code)
  LEFT JOIN (SELECT rule_code, string_agg(concat(page_number, '/', id, '/', source_kind, '/', quote_text), ';' ORDER BY page_number, id, source_kind, quote_text) AS quotes FROM {rule_evidence} GROUP BY rule_code) e USING (rule_code)""")
def rule_citations(v):
    """All rules with their references to known fields and their evidence."""
    rules = v["rule_text"].select(F.concat(F.lit("BR-"), F.col("o_orderkey").cast("string")).alias("rule_code"), "expression_text")
    refs = v["rules"].join(v["base_fields"].select(F.col("field_code").alias("ref")), "ref", "left_semi")
    nested = versions.nested_rules(rules, refs, v["rule_evidence"])
    one = lambda e: F.concat_ws("/", e["page_number"].cast("string"), e["id"].cast("string"), e["source_kind"], e["quote_text"])
    return nested.select("rule_code", "expression_text", F.array_join("refs", ",").alias("refs"), F.coalesce(F.array_join(F.transform("evidence", one), ";"), F.lit("")).alias("quotes"))


_LISTS = "SELECT r_name AS code_list_name FROM {region} UNION SELECT c_mktsegment FROM {customer}"


@query(f"""SELECT code_list_name, coalesce(e.entries, '') AS entries FROM ({_LISTS}) LEFT JOIN (SELECT code_list_name, string_agg(concat(ord, '=', code, '=', label), ';' ORDER BY ord) AS entries
  FROM {{code_entries}} GROUP BY code_list_name) e USING (code_list_name)""")
def code_list_rows(v):
    """Code lists with their entries; segments are lists without any."""
    entries = v["code_entries"].withColumnRenamed("ord", "position")
    nested = versions.with_entries(v.spark.sql(_LISTS, region=v["region"], customer=v["customer"]), entries)
    one = lambda e: F.concat_ws("=", e["position"].cast("string"), e["code"], e["label"])
    return nested.select("code_list_name", F.array_join(F.transform("entries", one), ";").alias("entries"))


_PAYLOADS = """SELECT o_orderkey AS document_version_id, 'review_items' AS bundle_type, CASE WHEN o_orderkey % 3 = 0 THEN '[]' ELSE concat('["', o_custkey, '"]') END AS payload FROM {orders} WHERE o_orderpriority <> '1-URGENT'
  UNION ALL SELECT o_orderkey, 'version_diff', concat('["of", "', o_custkey, '"]') FROM {orders} WHERE o_orderpriority <> '2-HIGH'"""


@query(f"""WITH p AS ({_PAYLOADS}),
  i AS (SELECT candidate_version_id, string_agg(item_id, ',' ORDER BY i.created_at, i.id) AS review FROM {{queue_items}} i JOIN {{diffs}} d USING (diff_id) GROUP BY 1),
  d AS (SELECT candidate_version_id, summary FROM {{diffs}} {_first("candidate_version_id", "created_at DESC, diff_id DESC")})
  SELECT v.document_version_id, v.status, coalesce(nullif(a.payload, '[]'), i.review, '[]') AS review, coalesce(b.payload, d.summary) AS diff FROM {{versions}} v
  LEFT JOIN p a ON a.document_version_id = v.document_version_id AND a.bundle_type = 'review_items' LEFT JOIN p b ON b.document_version_id = v.document_version_id AND b.bundle_type = 'version_diff'
  LEFT JOIN i ON i.candidate_version_id = v.document_version_id LEFT JOIN d ON d.candidate_version_id = v.document_version_id""")
def version_record(v):
    """Every version's record: its artifacts, or else what the store has."""
    payload = versions.review_payload(v["diffs"], v["queue_items"])
    queue = payload.groupBy(F.col("candidate_version_id").alias("document_version_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "item_id"))), lambda x: x["item_id"]), ",").alias("review"))
    last = versions.latest_diffs(v["diffs"], v["versions"]).select(F.col("candidate_version_id").alias("document_version_id"), F.col("summary").alias("diff"))
    return versions.with_fallback(v["versions"].select("document_version_id", "status"), v.spark.sql(_PAYLOADS, orders=v["orders"]), queue, last)


@query("SELECT field_code, page_number, source_kind, quote_text, CAST(min(id) AS BIGINT) AS first_id FROM {all_evidence} GROUP BY ALL")
def citation_dedup(v):
    return v["all_evidence"].groupBy("field_code", "page_number", "source_kind", "quote_text").agg(F.min("id").alias("first_id"))


@query("""WITH t AS (SELECT document_version_id, max(coalesce(effective_from, created_at)) AS newest FROM {versions} WHERE status <> 'draft' GROUP BY 1)
  SELECT r.stage, CAST(count(*) AS BIGINT) AS runs FROM {runs} r WHERE EXISTS (SELECT 1 FROM t WHERE t.document_version_id = r.document_version_id) GROUP BY r.stage""")
def runs_of_released(v):
    some = v["versions"].where("status <> 'draft'").select("document_version_id")
    return v["runs"].join(some, "document_version_id", "left_semi").groupBy("stage").agg(F.count("*").alias("runs"))


_MISSING = "(trim(coalesce(notes, '')) = '' OR trim(notes) = 'Recovered from rule reference fallback.')"
_ODD = "(origin = 'inferred' AND lower(trim(coalesce(sample, ''))) IN ('true', 'false'))"
_DUE = f"""due AS (SELECT *, {_MISSING} AS m, {_ODD} AS o FROM {{notes_fields}} WHERE field_kind = 'atomic' AND (origin = 'inferred' OR {_MISSING} OR {_ODD}
    OR (coalesce(format_hint, '') = '' AND lower(data_type) IN ('identifier', 'date', 'datetime', 'time', 'code', 'amount', 'quantity', 'percentage', 'boolean')))),
  top AS (SELECT * FROM due ORDER BY m DESC, (origin = 'explicit') DESC, o DESC, confidence, field_code LIMIT 24)"""


@query(f"WITH {_DUE} SELECT field_code, confidence FROM top")
def llm_candidates(v):
    return enrich.candidates(v["notes_fields"]).select("field_code", "confidence")


@query(f"WITH {_DUE} SELECT field_code, CAST(floor((row_number() OVER (ORDER BY confidence, field_code) - 1) / 8) AS INT) AS batch FROM due")
def llm_batches(v):
    return enrich.batched(enrich.due(v["notes_fields"]), ["confidence", "field_code"]).select("field_code", "batch")


_UPDATES = """SELECT field_code, CASE WHEN confidence > 0.6 THEN ' new notes ' END AS notes, 'hint ' AS format_hint, CASE WHEN confidence < 0.9 THEN ' smp' END AS sample, confidence + CAST(0.1 AS DOUBLE) AS confidence, field_name, 1 AS ord
  FROM {notes_fields} WHERE confidence <> 0.75 UNION ALL SELECT field_code, 'second notes', 'second hint', 'second', CAST(0.7 AS DOUBLE), 'more', 2 FROM {notes_fields} WHERE sample = ''
  UNION ALL SELECT 'BT-unknown', 'x', 'x', 'x', CAST(1.0 AS DOUBLE), 'x', 1"""


def _applied(table: str, ord_: int) -> str:
    """SQL of fields after the updates of one place in the order."""
    return f"""SELECT f.* EXCLUDE (notes, format_hint, sample, confidence, refs),
    CASE WHEN trim(coalesce(u.notes, '')) <> '' AND (trim(coalesce(f.notes, '')) = '' OR trim(f.notes) = 'Recovered from rule reference fallback.' OR f.origin = 'inferred') THEN trim(u.notes) ELSE f.notes END AS notes,
    CASE WHEN coalesce(u.format_hint, '') <> '' AND trim(coalesce(f.format_hint, '')) = '' THEN trim(u.format_hint) ELSE f.format_hint END AS format_hint,
    CASE WHEN coalesce(u.sample, '') <> '' AND (trim(coalesce(f.sample, '')) = '' OR (f.origin = 'inferred' AND lower(trim(coalesce(f.sample, ''))) IN ('true', 'false'))) THEN trim(u.sample) ELSE f.sample END AS sample,
    greatest(f.confidence, coalesce(u.confidence, f.confidence)) AS confidence, CASE WHEN u.field_name IS NULL OR list_contains(f.refs, trim(u.field_name)) THEN f.refs ELSE list_append(f.refs, trim(u.field_name)) END AS refs
  FROM {table} f LEFT JOIN (SELECT * FROM u WHERE ord = {ord_}) u ON f.field_code = u.field_code"""


@query(f"""WITH u AS ({_UPDATES}), f AS (SELECT *, ['a', 'a'] AS refs FROM {{notes_fields}}), g AS ({_applied("f", 1)}), h AS ({_applied("g", 2)})
  SELECT field_code, notes, format_hint, sample, array_to_string(refs, ';') AS refs, confidence FROM h""")
def llm_apply(v):
    updates = v.spark.sql(_UPDATES, notes_fields=v["notes_fields"]).withColumn("refs", F.array(F.lit("a"), F.lit(" "), F.col("field_name"))).drop("field_name")
    fields = v["notes_fields"].withColumn("refs", F.array(F.lit("a"), F.lit("a")))
    return enrich.merged(fields, updates).select("field_code", "notes", "format_hint", "sample", F.array_join("refs", ";").alias("refs"), "confidence")


@query("""SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, CAST(count(*) AS BIGINT) AS runs, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def tumbling_metrics(v):
    return metrics.tumbling(v["events"], "1 hour").withColumn("total", F.round("total", 4))


@query("""SELECT time_bucket(INTERVAL '1 hour', ts) - o * INTERVAL '1 hour' AS window_start, event_type, CAST(count(*) AS BIGINT) AS runs FROM events, (VALUES (0), (1)) x(o) GROUP BY 1, 2""")
def sliding_metrics(v):
    return metrics.sliding(v["events"], "2 hours", "1 hour")


@query("""WITH m AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '2 hours' THEN 0 ELSE 1 END AS n FROM events),
  s AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM m)
  SELECT user_id, min(ts) AS session_start, CAST(count(*) AS BIGINT) AS runs FROM s GROUP BY user_id, sid""")
def session_metrics(v):
    return metrics.sessions(v["events"], "2 hours")


@query("""WITH pages AS (SELECT doc_id, text FROM documents), codes AS (SELECT DISTINCT lower(n_name) AS code FROM nation UNION ALL SELECT * FROM (VALUES ('license'), ('rights'), ('idiot'), ('http')) c(code))
  SELECT code, doc_id FROM codes JOIN pages ON contains(lower(text), code)""")
def page_containment(v):
    codes = v["nation"].select(F.lower("n_name").alias("code")).distinct().unionAll(v.spark.createDataFrame([("license",), ("rights",), ("idiot",), ("http",)], "code string"))
    return found_in(v["documents"].select("doc_id", F.lower("text").alias("text")), codes, "doc_id", pattern="code").select("code", "doc_id")


_TERMS = "SELECT DISTINCT p_name AS term FROM {part} UNION SELECT DISTINCT lower(word) FROM (SELECT explode(split(text, ' ')) AS word FROM {benchmark}) WHERE length(word) > 3"


@query("""WITH terms AS (SELECT DISTINCT p_name AS term FROM part UNION SELECT DISTINCT lower(word) FROM (SELECT unnest(string_split(text, ' ')) AS word FROM benchmark) WHERE length(word) > 3)
  SELECT doc_id, term FROM documents JOIN terms ON contains(lower(text), term)""")
def term_containment(v):
    """All names of parts and words of the benchmark that documents contain, wherever they stand."""
    terms = v.spark.sql(_TERMS, part=v["part"], benchmark=v["benchmark"])
    return found_in(v["documents"].select("doc_id", F.lower("text").alias("text")), terms, "doc_id", pattern="term")


@query("""WITH o AS (SELECT *, CASE WHEN role = 'user' THEN 1 ELSE 0 END AS opens FROM conversations), g AS (SELECT *, sum(opens) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS record FROM o)
  SELECT conv_id, CAST(record AS BIGINT) AS record, CAST(count(*) AS BIGINT) AS turns, string_agg(text, ' ' ORDER BY turn) AS text FROM g WHERE record > 0 GROUP BY conv_id, record""")
def continuation_fold(v):
    from lexledger.operators.folds import continuation_groups

    rows = continuation_groups(v["conversations"], ["conv_id"], ["turn"], F.col("role") == "user").where("record > 0")
    return rows.groupBy("conv_id", "record").agg(F.count("*").alias("turns"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"]), " ").alias("text"))

"""Validation, diff, review and release queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexledger.operators import diff, profiles, review, validate, versions
from lexledger.operators.likeness import alike
from lexledger.operators.lineage import settled
from lexledger.plans.registering import registrar

QUERIES, ORACLES, query, _ = registrar()

_PAIRS = """
  c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY field_code ORDER BY ord DESC) AS rn FROM {%s}) WHERE rn = 1),
  p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY field_code ORDER BY ord DESC) AS rn FROM {pub_fields}) WHERE rn = 1),
  changes AS (SELECT * FROM (
    SELECT coalesce(c.field_code, p.field_code) AS field_code,
      CASE WHEN p.field_code IS NULL THEN 1 WHEN c.field_code IS NULL THEN 2 ELSE 3 END AS branch,
      CASE WHEN p.field_code IS NULL THEN 'added' WHEN c.field_code IS NULL THEN 'removed'
        WHEN p.occurrence_min IS DISTINCT FROM c.occurrence_min OR p.occurrence_max IS DISTINCT FROM c.occurrence_max THEN 'cardinality_changed'
        WHEN p.data_type IS DISTINCT FROM c.data_type THEN 'data_type_changed'
        WHEN p.invoice_path IS DISTINCT FROM c.invoice_path OR p.credit_note_path IS DISTINCT FROM c.credit_note_path THEN 'path_changed'
        WHEN p.min_char_length IS DISTINCT FROM c.min_char_length OR p.max_char_length IS DISTINCT FROM c.max_char_length
          OR p.min_decimal_scale IS DISTINCT FROM c.min_decimal_scale OR p.max_decimal_scale IS DISTINCT FROM c.max_decimal_scale THEN 'constraint_changed'
        WHEN p.field_name IS DISTINCT FROM c.field_name THEN 'metadata_changed' END AS change_type,
      CASE WHEN p.field_code IS NULL THEN CASE WHEN coalesce(c.occurrence_min, 0) > 0 THEN 'medium' ELSE 'low' END
        WHEN c.field_code IS NULL THEN CASE WHEN coalesce(p.occurrence_min, 0) > 0 THEN 'high' ELSE 'medium' END
        WHEN p.occurrence_min IS DISTINCT FROM c.occurrence_min OR p.occurrence_max IS DISTINCT FROM c.occurrence_max
          OR p.data_type IS DISTINCT FROM c.data_type THEN 'high'
        WHEN p.invoice_path IS DISTINCT FROM c.invoice_path OR p.credit_note_path IS DISTINCT FROM c.credit_note_path THEN 'medium'
        WHEN p.min_char_length IS DISTINCT FROM c.min_char_length OR p.max_char_length IS DISTINCT FROM c.max_char_length
          OR p.min_decimal_scale IS DISTINCT FROM c.min_decimal_scale OR p.max_decimal_scale IS DISTINCT FROM c.max_decimal_scale THEN 'high'
        ELSE 'low' END AS risk_level
    FROM p FULL OUTER JOIN c ON p.field_code = c.field_code) x WHERE change_type IS NOT NULL)"""
_CHANGES = _PAIRS % "cand_fields"
_ISSUES = """
  issues AS (
    SELECT 'error' AS severity, 'duplicate_field_code' AS code, field_code, field_code AS subject
      FROM (SELECT *, row_number() OVER (PARTITION BY field_code ORDER BY ord) AS n FROM {dup_fields}) d WHERE n > 1
    UNION ALL SELECT 'warning', 'missing_field_path', field_code, field_code FROM {dup_fields}
      WHERE field_kind = 'atomic' AND coalesce(invoice_path, '') = '' AND coalesce(credit_note_path, '') = ''
    UNION ALL SELECT 'warning', 'missing_field_evidence', field_code, field_code FROM {dup_fields} f
      WHERE NOT EXISTS (SELECT 1 FROM {evidence} e WHERE e.field_code = f.field_code)
    UNION ALL SELECT 'error', 'invalid_cardinality', field_code, field_code FROM {dup_fields} WHERE try_cast(occurrence_max AS INT) < occurrence_min
    UNION ALL SELECT 'warning', 'dangling_rule_reference', NULL, concat(rule_code, ': ', string_agg(ref, ', ' ORDER BY pos, ref)) FROM {rules}
      WHERE ref NOT IN (SELECT field_code FROM {dup_fields}) GROUP BY rule_code
    UNION ALL SELECT DISTINCT 'warning', 'missing_rule_evidence', NULL, rule_code FROM {rules} r WHERE NOT EXISTS (SELECT 1 FROM {rule_evidence} e WHERE e.rule_code = r.rule_code))"""
_QUEUE = """
  numbered AS (SELECT *, row_number() OVER (ORDER BY branch, field_code) AS i FROM changes),
  items AS (
    SELECT concat('validation:', code, ':', coalesce(field_code, 'global')) AS item_id, CASE severity WHEN 'error' THEN 'high' ELSE 'medium' END AS risk_level, 'validation' AS source FROM issues
    UNION ALL SELECT concat('diff:', i, ':', field_code), risk_level, 'diff' FROM numbered WHERE risk_level <> 'low')"""


def _issue_sql(code: str) -> str:
    return f"WITH {_ISSUES} SELECT * FROM issues WHERE code = '{code}'"


@query(f"WITH {_CHANGES} SELECT field_code, change_type, risk_level FROM changes")
def version_diff(v):
    return diff.field_changes(v["pub_fields"], v["cand_fields"]).drop("branch")


@query(f"WITH {_CHANGES} SELECT count(*) FILTER (branch = 1) AS added, count(*) FILTER (branch = 2) AS removed, count(*) FILTER (branch = 3) AS changed FROM changes")
def version_diff_summary(v):
    return diff.change_summary(diff.field_changes(v["pub_fields"], v["cand_fields"]))


@query("SELECT 'none' AS baseline, (SELECT count(*) FROM {cand_fields}) AS candidate_field_count, (SELECT count(*) FROM {rules}) AS candidate_rule_count")
def version_diff_no_baseline(v):
    return diff.first_version_summary(v["cand_fields"], v["rules"])


@query(f"WITH {_PAIRS % 'dup_fields'} SELECT field_code, change_type, risk_level FROM changes")
def diff_last_duplicate_wins(v):
    return diff.field_changes(v["pub_fields"], v["dup_fields"]).drop("branch")


@query(f"WITH {_CHANGES} SELECT field_code, CASE branch WHEN 1 THEN 'extra' WHEN 2 THEN 'missing' ELSE 'changed' END AS status FROM changes")
def catalog_compare(v):
    return diff.compared_codes(v["pub_fields"], v["cand_fields"])


@query(_issue_sql("duplicate_field_code"))
def validate_duplicates(v):
    return validate.duplicate_codes(v["dup_fields"])


@query(_issue_sql("missing_field_path"))
def validate_missing_path(v):
    return validate.missing_paths(v["dup_fields"])


@query(_issue_sql("missing_field_evidence"))
def validate_missing_evidence(v):
    return validate.missing_evidence(v["dup_fields"], v["evidence"])


@query(_issue_sql("invalid_cardinality"))
def validate_cardinality(v):
    return validate.reversed_cardinality(v["dup_fields"])


@query(_issue_sql("dangling_rule_reference"))
def validate_dangling_refs(v):
    return validate.dangling_references(v["rules"], v["dup_fields"])


@query(_issue_sql("missing_rule_evidence"))
def validate_rule_evidence(v):
    return validate.rules_without_evidence(v["rules"], v["rule_evidence"])


def _issues(v):
    return validate.all_issues(v["dup_fields"], v["rules"], v["evidence"], v["rule_evidence"])


@query(f"WITH {_ISSUES} SELECT * FROM issues")
def validate_all(v):
    return _issues(v)


@query(f"WITH {_ISSUES}, {_CHANGES}, {_QUEUE} SELECT * FROM items")
def review_queue(v):
    return review.queue(_issues(v), diff.field_changes(v["pub_fields"], v["cand_fields"]))


@query(f"WITH {_ISSUES}, {_CHANGES}, {_QUEUE}, n AS (SELECT (SELECT count(*) FROM items) AS review_items, (SELECT count(*) FROM issues) AS issues) SELECT *, review_items = 0 AND n.issues = 0 AS publish FROM n")
def auto_publish_gate(v):
    issues = settled(_issues(v))
    return review.release_gate(review.queue(issues, diff.field_changes(v["pub_fields"], v["cand_fields"])), issues)


@query(f"""WITH {_CHANGES}, conf AS (SELECT concat('BT-', l_partkey) AS field_code, max(1 - l_discount) AS confidence FROM lineitem GROUP BY 1)
  SELECT c.field_code, reason FROM changes c LEFT JOIN conf USING (field_code),
    (VALUES ('high_risk'), ('low_confidence'), ('no_evidence')) r(reason)
  WHERE CASE reason WHEN 'high_risk' THEN risk_level = 'high' WHEN 'low_confidence' THEN coalesce(confidence, 0) < 0.99
    ELSE c.field_code NOT IN (SELECT field_code FROM {{evidence}}) END""".replace("{{", "{").replace("}}", "}"))
def release_policy(v):
    confidence = v["lineitem"].groupBy(F.concat(F.lit("BT-"), F.col("l_partkey").cast("string")).alias("field_code")).agg(F.max(1 - F.col("l_discount")).alias("confidence"))
    return review.policy_gate(diff.field_changes(v["pub_fields"], v["cand_fields"]), confidence, v["evidence"], least=0.99)


@query(f"""WITH {_ISSUES}, {_CHANGES}, {_QUEUE} SELECT 'fields' AS metric, count(*) AS value FROM {{dup_fields}} UNION ALL SELECT 'issues', count(*) FROM issues
  UNION ALL SELECT 'review_items', count(*) FROM items UNION ALL SELECT 'rules', count(*) FROM {{rules}} UNION ALL SELECT 'citations', count(*) FROM {{evidence}}""")
def run_metrics(v):
    issues = settled(_issues(v))
    return review.run_metrics(fields=v["dup_fields"], rules=v["rules"], citations=v["evidence"], issues=issues, review_items=review.queue(issues, diff.field_changes(v["pub_fields"], v["cand_fields"])))


_RULE_CUTS = """
  r AS (SELECT rule_code, string_agg(ref, ',' ORDER BY ref) AS refs, CAST(sum(length(ref)) AS BIGINT) AS n FROM {rules} GROUP BY rule_code),
  p AS (SELECT rule_code, refs, concat('text ', n) AS expression_text FROM r WHERE n % 7 <> 0),
  c AS (SELECT rule_code, CASE WHEN n % 5 = 0 THEN concat(refs, ',BT-0') ELSE refs END AS refs, concat('text ', CASE WHEN n % 3 = 0 THEN n + 1 ELSE n END) AS expression_text FROM r WHERE n % 11 <> 0)"""


@query(f"""WITH {_RULE_CUTS}, x AS (SELECT coalesce(c.rule_code, p.rule_code) AS rule_code, CASE WHEN p.rule_code IS NULL THEN 'added' WHEN c.rule_code IS NULL THEN 'removed'
    WHEN p.refs <> c.refs THEN 'formula_changed' WHEN p.expression_text <> c.expression_text THEN 'wording_changed' END AS change_type FROM p FULL OUTER JOIN c ON p.rule_code = c.rule_code)
  SELECT *, CASE change_type WHEN 'wording_changed' THEN 'low' WHEN 'added' THEN 'medium' ELSE 'high' END AS risk_level FROM x WHERE change_type IS NOT NULL""")
def rule_diff(v):
    r = v["rules"].groupBy("rule_code").agg(F.array_join(F.array_sort(F.collect_list("ref")), ",").alias("refs"), F.sum(F.length("ref")).alias("n"))
    text = lambda n: F.concat(F.lit("text "), n.cast("string")).alias("expression_text")
    n = F.col("n")
    old = r.where(n % 7 != 0).select("rule_code", "refs", text(n))
    new = r.where(n % 11 != 0).select("rule_code", F.when(n % 5 == 0, F.concat("refs", F.lit(",BT-0"))).otherwise(F.col("refs")).alias("refs"), text(F.when(n % 3 == 0, n + 1).otherwise(n)))
    return diff.rule_changes(old, new)


@query("""WITH p AS (SELECT * FROM {code_entries} WHERE ord % 7 <> 0), c AS (SELECT code_list_name, code, CASE WHEN ord % 5 = 0 THEN lower(label) ELSE label END AS label FROM {code_entries} WHERE ord % 6 <> 0),
  x AS (SELECT coalesce(c.code_list_name, p.code_list_name) AS code_list_name, coalesce(c.code, p.code) AS code, CASE WHEN p.code IS NULL THEN 'added' WHEN c.code IS NULL THEN 'removed' WHEN p.label <> c.label THEN 'label_changed' END AS change_type
    FROM p FULL OUTER JOIN c ON p.code_list_name = c.code_list_name AND p.code = c.code) SELECT * FROM x WHERE change_type IS NOT NULL""")
def code_list_diff(v):
    e = v["code_entries"]
    new = e.where("ord % 6 <> 0").withColumn("label", F.when(F.col("ord") % 5 == 0, F.lower("label")).otherwise(F.col("label")))
    return diff.code_changes(e.where("ord % 7 <> 0"), new)


@query(f"""WITH {_CHANGES}, a AS (SELECT p.* FROM p JOIN changes USING (field_code) WHERE branch = 2), b AS (SELECT c.* FROM c JOIN changes USING (field_code) WHERE branch = 1)
  SELECT a.field_code AS old_code, b.field_code AS new_code, CAST(levenshtein(a.field_name, b.field_name) AS INT) AS distance FROM a JOIN b ON a.data_type = b.data_type AND a.invoice_path = b.invoice_path
  WHERE levenshtein(a.field_name, b.field_name) <= 8""")
def rename_suggestions(v):
    return diff.rename_suggestions(v["pub_fields"], v["cand_fields"], most=8)


def _named(view: str) -> str:
    """A catalog whose names tell its fields apart, with slips in those of the published one."""
    name = "concat(field_name, ' ', data_type)"
    return f"SELECT * EXCLUDE (field_name), {name if view == 'cand_fields' else f"replace({name}, 'ECONOMY', 'ECNOMY')"} AS field_name FROM {{{view}}}"


@query(f"""WITH {_CHANGES}, o AS ({_named("pub_fields")}), n AS ({_named("cand_fields")}), a AS (SELECT o.* FROM o JOIN changes USING (field_code) WHERE branch = 2), b AS (SELECT n.* FROM n JOIN changes USING (field_code) WHERE branch = 1)
  SELECT a.field_code AS old_code, b.field_code AS new_code, CAST(levenshtein(a.field_name, b.field_name) AS INT) AS distance FROM a JOIN b ON levenshtein(a.field_name, b.field_name) <= 3""")
def renames_by_likeness(v):
    """Fields that may have been renamed, of whatever type and path."""
    some = {name: v.spark.sql(_named(name).replace("EXCLUDE", "EXCEPT"), **{name: v[name]}) for name in ("pub_fields", "cand_fields")}
    return diff.renamed_by_likeness(some["pub_fields"], some["cand_fields"])


@query("""WITH w AS (SELECT DISTINCT name FROM (SELECT regexp_replace(lower(unnest(string_split(text, ' '))), '[^a-z]', '', 'g') AS name FROM benchmark) WHERE name <> ''), p AS (SELECT DISTINCT name FROM w UNION SELECT p_name FROM part)
  SELECT w.name AS left_name, p.name AS right_name, CAST(levenshtein(w.name, p.name) AS INT) AS distance FROM w JOIN p ON levenshtein(w.name, p.name) <= 2""")
def alike_names(v):
    """Words of the benchmark, and the words or names of parts that are at most two edits away."""
    words = v["benchmark"].select(F.explode(F.split("text", " ")).alias("word")).select(F.regexp_replace(F.lower("word"), "[^a-z]", "").alias("name")).where("name <> ''")
    return alike(words, words.unionByName(v["part"].select(F.col("p_name").alias("name"))), 2)


_RECORDS = """SELECT CASE WHEN ord % 37 = 0 THEN concat('BG-', ord) ELSE field_code END AS field_code, CASE WHEN ord % 41 = 0 THEN '' WHEN ord % 43 = 0 THEN concat(field_name, ' ........ 5') ELSE field_name END AS field_name,
  CASE WHEN ord % 3 = 0 THEN '' ELSE data_type END AS description, CASE WHEN ord % 47 = 0 THEN 'BR-1' ELSE invoice_path END AS invoice_path, credit_note_path FROM {cand_fields}"""


def _records(v):
    return v.spark.sql(_RECORDS, cand_fields=v["cand_fields"])


@query(f"""WITH r AS ({_RECORDS}) SELECT count(*) AS record_count, avg((field_name = '')::INT::DOUBLE) AS empty_name_ratio, avg((description = '')::INT::DOUBLE) AS empty_description_ratio,
  avg((field_code LIKE 'BG-%')::INT::DOUBLE) AS group_id_ratio, avg((field_name LIKE '%.....%')::INT::DOUBLE) AS leader_dots_name_ratio, avg((invoice_path LIKE 'BR-%')::INT::DOUBLE) AS report_path_rule_ratio,
  avg((NOT (coalesce(invoice_path, '') = '' AND coalesce(credit_note_path, '') = ''))::INT::DOUBLE) AS path_coverage_ratio FROM r""")
def quality_metrics(v):
    return profiles.quality_metrics(_records(v))


@query(f"""WITH r AS ({_RECORDS}), d AS (SELECT 'field_name_toc_noise' AS diagnostic, count(*) FILTER (field_name LIKE '%.....%') AS records FROM r UNION ALL SELECT 'group_ids_emitted_as_fields', count(*) FILTER (field_code LIKE 'BG-%') FROM r
  UNION ALL SELECT 'rule_ids_used_as_report_path', count(*) FILTER (invoice_path LIKE 'BR-%') FROM r UNION ALL SELECT 'missing_paths', count(*) FILTER (coalesce(invoice_path, '') = '' AND coalesce(credit_note_path, '') = '') FROM r
  UNION ALL SELECT 'missing_names', count(*) FILTER (field_name = '') FROM r UNION ALL SELECT 'missing_descriptions', count(*) FILTER (description = '') FROM r) SELECT * FROM d WHERE records > 0""")
def diagnostics(v):
    return profiles.diagnostics(_records(v))


@query("""WITH x AS (SELECT doc_id, source AS name, lower(text) AS t FROM documents), s AS (
    SELECT doc_id, 'alpha' AS profile_id, 3 * (contains(name, 'src1')::INT) + contains(t, 'the')::INT + contains(t, 'rights')::INT AS score FROM x
    UNION ALL SELECT doc_id, 'beta', 3 * (contains(name, 'src2')::INT) + contains(t, 'der ')::INT + contains(t, 'que ')::INT FROM x UNION ALL SELECT doc_id, 'gamma', contains(t, 'license')::INT * 1 FROM x)
  SELECT doc_id, profile_id, score FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, profile_id) = 1""")
def profile_routing(v):
    return profiles.routed(v["documents"].select("doc_id", F.col("source").alias("name"), "text"), [("alpha", ["src1"], ["the", "rights"]), ("beta", ["src2"], ["der ", "que "]), ("gamma", [], ["license"])])


@query("""SELECT field_code, unnest(list_filter([
    CASE WHEN occurrence_min > 0 THEN concat('`', field_code, '` IS NOT NULL') END, CASE WHEN max_char_length IS NOT NULL THEN concat('coalesce(length(`', field_code, '`), 0) <= ', max_char_length) END,
    CASE WHEN max_decimal_scale IS NOT NULL THEN concat('coalesce(length(substring_index(`', field_code, '`, ''.'', -1)) <= ', max_decimal_scale, ' OR NOT contains(`', field_code, '`, ''.''), true)') END], lambda x: x IS NOT NULL)) AS predicate
  FROM {cand_fields}""")
def generated_checks(v):
    return profiles.generated_checks(v["cand_fields"])


@query("""WITH o AS (SELECT * FROM (SELECT severity, code, field_code FROM {dup_fields} f, (VALUES ('error', 'invalid_cardinality')) x(severity, code) WHERE try_cast(occurrence_max AS INT) < occurrence_min)), n AS (SELECT * FROM o WHERE field_code NOT LIKE '%7')
  SELECT a.*, b.*, new_target < old_target AND new_issues <= old_issues AND new_errors <= old_errors AS accepted FROM
    (SELECT count(*) AS old_issues, count(*) FILTER (code = 'invalid_cardinality') AS old_target, count(*) FILTER (severity = 'error') AS old_errors FROM o) a,
    (SELECT count(*) AS new_issues, count(*) FILTER (code = 'invalid_cardinality') AS new_target, count(*) FILTER (severity = 'error') AS new_errors FROM n) b""")
def repair_comparison(v):
    before = validate.reversed_cardinality(v["dup_fields"])
    return profiles.repair_outcome(before, before.where("field_code NOT LIKE '%7'"), "invalid_cardinality")


@query("""SELECT field_code, replace(replace(invoice_path, 'Brand', 'brand'), '/Invoice/', '/inv/') AS path FROM {base_fields}""")
def replaced_paths(v):
    return v["base_fields"].select("field_code", profiles.replaced_paths(F.col("invoice_path"), [("Brand", "brand"), ("/Invoice/", "/inv/")]).alias("path"))


_STORED = """SELECT field_code, concat('see ', field_code) AS remark, CASE WHEN ord % 9 = 0 THEN NULL ELSE invoice_path END AS invoice_path, CASE WHEN ord % 2 = 0 THEN '' ELSE credit_note_path END AS credit_note_path FROM {base_fields}"""


@query(f"""WITH s AS ({_STORED}) SELECT field_code, nullif(invoice_path, '') AS invoice_path, nullif(credit_note_path, '') AS credit_note_path,
  CASE WHEN coalesce(invoice_path, '') <> '' OR coalesce(credit_note_path, '') <> '' THEN remark END AS remark FROM s""")
def roundtrip_loss(v):
    """What the store gives back of paths and remarks: a remark is kept with a path only."""
    fields = v.spark.sql(_STORED, base_fields=v["base_fields"])
    stored = versions.path_rows(fields)
    return fields.select("field_code").join(versions.paths_of(stored), "field_code", "left")


#: Patches of parser profiles: events set what their type says, with values of few kinds and spellings, and errors take
#: out what clicks have set.
_PATCHES = """SELECT user_id % 20 AS profile_id, event_id AS ord, CASE event_type WHEN 'error' THEN 'click' ELSE event_type END AS path, kind, CASE WHEN event_type = 'error' THEN NULL WHEN kind % 2 = 0 THEN concat(' ', kind, ' ') ELSE concat(chr(123), '"n": ', kind, chr(125)) END AS value
  FROM (SELECT *, CAST(floor(value / 130) AS INT) AS kind FROM {events}) x"""
_EFFECTS = f"""p AS (SELECT profile_id, ord, path, CASE WHEN value IS NULL THEN NULL WHEN kind % 2 = 0 THEN CAST(kind AS VARCHAR) ELSE concat(chr(123), '"n":', kind, chr(125)) END AS value FROM ({_PATCHES})),
  c AS (SELECT *, CASE WHEN value IS NULL THEN 0 ELSE CAST(('0x' || substr(md5(path || '=' || value), 1, 15)) AS BIGINT) END AS h FROM p),
  d AS (SELECT *, xor(h, coalesce(lag(h) OVER (PARTITION BY profile_id, path ORDER BY ord), 0)) AS change FROM c),
  e AS (SELECT *, bit_xor(change) OVER (PARTITION BY profile_id ORDER BY ord) AS content_hash, change <> 0 AS effective FROM d)"""


@query(f"WITH {_EFFECTS} SELECT profile_id, content_hash, min(ord) AS first_ord, count(*) AS uses FROM e WHERE effective GROUP BY profile_id, content_hash")
def profile_versions(v):
    """Versions of profiles under very many patches, of which those without effect make none."""
    return profiles.profile_versions(v.spark.sql(_PATCHES, events=v["events"]))


@query(f"""WITH {_EFFECTS}, l AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY profile_id, path ORDER BY ord DESC) = 1)
  SELECT profile_id, CAST(count(value) AS INT) AS paths, CAST(max(CASE WHEN path = 'view' THEN try_cast(value AS INT) END) AS INT) AS view, CAST(max(CASE WHEN path = 'view' THEN json_extract(value, '$.n')::INT END) AS INT) AS view_n FROM l GROUP BY profile_id""")
def profile_configs(v):
    """What profiles hold at last: how many paths, and what is at one of them."""
    got = profiles.current_profiles(v.spark.sql(_PATCHES, events=v["events"]))
    at = lambda path, kind: F.try_variant_get("config", path, kind)
    return got.select("profile_id", F.size(F.map_keys(F.from_json(F.to_json("config"), "map<string,string>"))).alias("paths"), at("$.view", "int").alias("view"), at("$.view.n", "int").alias("view_n"))


_ODD_FIELDS = """SELECT field_code, CASE WHEN ord % 53 = 0 THEN ' ' ELSE field_name END AS field_name, CASE WHEN ord % 59 = 0 THEN '' ELSE data_type END AS data_type, CASE occurrence_max WHEN '0' THEN NULL ELSE occurrence_max END AS occurrence_max,
  CASE ord % 7 WHEN 0 THEN replace(invoice_path, 'Brand#', 'cbc:Brand') WHEN 1 THEN '/Invoice/cac:A/cbc:ID/@schemeID' WHEN 2 THEN '/CreditNote/cbc:ID' ELSE invoice_path END AS invoice_path, CASE ord % 5 WHEN 0 THEN '/CreditNote/cbc:ID' WHEN 1 THEN 'cbc:ID' ELSE credit_note_path END AS credit_note_path
  FROM {cand_fields}"""
_ODD_ENTRIES = "SELECT c_mktsegment AS code_list_name, CASE c_custkey % 3 WHEN 0 THEN concat('c ', c_custkey % 97) WHEN 1 THEN concat('C', c_custkey % 97) ELSE concat('d', c_custkey) END AS code FROM {customer}"


@query(f"""WITH f AS ({_ODD_FIELDS}), p AS (SELECT field_code, 'Invoice' AS kind, invoice_path AS path FROM f UNION ALL SELECT field_code, 'CreditNote', credit_note_path FROM f),
  e AS (SELECT DISTINCT code_list_name, code FROM ({_ODD_ENTRIES}) x WHERE code IS NOT NULL)
  SELECT 'warning' AS severity, 'odd_field_path' AS code, field_code, path AS subject FROM p WHERE coalesce(path, '') <> '' AND NOT regexp_matches(path, concat('^/', kind, '(/([A-Za-z][A-Za-z0-9]*:)?[A-Za-z][A-Za-z0-9_]*)*(/@[A-Za-z][A-Za-z0-9_:-]*)?$'))
  UNION ALL SELECT 'error', 'missing_required_value', field_code, subject FROM (SELECT field_code, concat_ws(', ', CASE WHEN trim(field_name) = '' THEN 'field_name' END, CASE WHEN coalesce(trim(data_type), '') = '' THEN 'data_type' END, CASE WHEN coalesce(occurrence_max, '') = '' THEN 'occurrence_max' END) AS subject FROM f) WHERE subject <> ''
  UNION ALL SELECT 'warning', 'colliding_codes', NULL, concat(code_list_name, ': ', string_agg(code, ', ' ORDER BY code)) FROM e GROUP BY code_list_name, upper(replace(code, ' ', '')) HAVING count(*) > 1""")
def validate_extra(v):
    """Paths that are none, missing values, and codes that differ in blanks and case only."""
    return validate.extra_issues(v.spark.sql(_ODD_FIELDS, cand_fields=v["cand_fields"]), v.spark.sql(_ODD_ENTRIES, customer=v["customer"]))

"""Catalog views over the driver's tables. Each is SQL that Spark and DuckDB read alike; {name} stands for a table
or another view."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = frozenset("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split())

VIEWS = {
    "base_fields": """
        SELECT concat('BT-', p_partkey) AS field_code, p_name AS field_name, 'atomic' AS field_kind, p_type AS data_type,
               CAST(p_size % 2 AS INT) AS occurrence_min,
               CASE p_size % 3 WHEN 0 THEN 'n' WHEN 1 THEN '1' ELSE '0' END AS occurrence_max,
               concat('/Invoice/', p_brand) AS invoice_path,
               CASE WHEN p_partkey % 3 = 0 THEN concat('/CreditNote/', p_brand) END AS credit_note_path,
               CAST(NULL AS INT) AS min_char_length, p_size AS max_char_length, CAST(NULL AS INT) AS min_decimal_scale,
               CASE WHEN p_partkey % 5 = 0 THEN 2 END AS max_decimal_scale, p_partkey AS ord
        FROM {part}""",
    "pub_fields": "SELECT * FROM {base_fields} WHERE ord % 11 <> 0",
    "cand_fields": """
        SELECT field_code, CASE WHEN ord % 7 = 1 THEN concat(field_name, ' v2') ELSE field_name END AS field_name, field_kind,
               CASE WHEN ord % 13 = 2 THEN 'Text' ELSE data_type END AS data_type,
               CASE WHEN ord % 17 = 3 THEN 1 - occurrence_min ELSE occurrence_min END AS occurrence_min, occurrence_max,
               CASE WHEN ord % 31 = 0 THEN '' WHEN ord % 19 = 4 THEN concat(invoice_path, '/x') ELSE invoice_path END AS invoice_path,
               credit_note_path, min_char_length, CASE WHEN ord % 23 = 5 THEN max_char_length + 1 ELSE max_char_length END AS max_char_length,
               min_decimal_scale, max_decimal_scale, ord
        FROM {base_fields} WHERE ord % 29 <> 0""",
    "dup_fields": """
        SELECT * FROM {cand_fields}
        UNION ALL SELECT field_code, concat(field_name, ' again'), field_kind, data_type, occurrence_min, occurrence_max, invoice_path, credit_note_path,
               min_char_length, max_char_length, min_decimal_scale, max_decimal_scale, ord + 1000000000 FROM {cand_fields} WHERE ord % 50 = 0""",
    "rules": "SELECT concat('BR-', l_orderkey) AS rule_code, concat('BT-', l_partkey) AS ref, min(l_linenumber) AS pos FROM {lineitem} GROUP BY l_orderkey, l_partkey",
    "rule_text": """
        SELECT o_orderkey, concat(CASE o_orderkey % 3 WHEN 0 THEN 'HR-BR-' ELSE 'BR-' END, o_orderkey, ' ',
               CASE o_orderkey % 9 WHEN 0 THEN 'Total = sum of BT-12 and BT-7' WHEN 1 THEN 'BT-1 and HR-BT-2 are mutually exclusive'
                 WHEN 2 THEN 'If BT-5 is given, BG-3 is required' WHEN 3 THEN 'BT-9 must be equal to BT-10' WHEN 4 THEN 'BT-4 must have a value'
                 WHEN 5 THEN 'use the code list of BT-3' WHEN 6 THEN 'two decimal places in BT-6' WHEN 7 THEN 'plain words' ELSE 'BT-8 multiplied by BT-8' END) AS expression_text
        FROM {orders}""",
    "evidence": """
        SELECT DISTINCT concat('BT-', l_partkey) AS field_code, l_linenumber AS page_number, l_orderkey AS id, l_returnflag AS source_kind, l_linestatus AS quote_text
        FROM {lineitem} WHERE l_returnflag = 'R' AND l_quantity > 45""",
    # all evidence: every line of every order
    "all_evidence": """
        SELECT DISTINCT concat('BT-', l_partkey) AS field_code, l_linenumber AS page_number, l_orderkey AS id, l_returnflag AS source_kind, l_linestatus AS quote_text
        FROM {lineitem}""",
    "rule_evidence": """
        SELECT DISTINCT concat('BR-', l_orderkey) AS rule_code, l_linenumber AS page_number, l_partkey AS id, l_returnflag AS source_kind, l_linestatus AS quote_text
        FROM {lineitem} WHERE l_returnflag <> 'N'""",
    "diffs": """
        SELECT l_orderkey * 10 + l_linenumber AS diff_id, l_orderkey AS candidate_version_id, CASE WHEN l_linenumber > 1 THEN l_orderkey - l_linenumber END AS base_version_id,
               CASE min(l_linestatus) WHEN 'F' THEN 'auto_approved' ELSE 'pending_review' END AS status, min(l_shipdate) AS created_at, concat('changed: ', CAST(max(l_quantity) AS INT)) AS summary
        FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "queue_items": """
        SELECT (l_orderkey * 10 + l_linenumber) * 1000000000 + l_partkey AS id, l_orderkey * 10 + 1 + l_linenumber % 2 AS diff_id, concat('diff:', l_linenumber, ':BT-', l_partkey) AS item_id,
               CASE max(l_returnflag) WHEN 'R' THEN 'high' ELSE 'medium' END AS risk_level, 'pending' AS status, min(l_shipdate) AS created_at
        FROM {lineitem} GROUP BY l_orderkey, l_linenumber, l_partkey""",
    "versions": """
        SELECT o_orderkey AS document_version_id, c_nationkey AS jurisdiction, c_mktsegment AS tax_domain, o_orderpriority AS version_label,
               CASE o_orderstatus WHEN 'F' THEN 'published' WHEN 'O' THEN 'candidate' ELSE 'draft' END AS status,
               CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate END AS effective_from,
               CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate + INTERVAL '400' DAY END AS effective_to, o_orderdate AS issued_on, o_orderdate AS created_at,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS published_at
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "runs": "SELECT event_id AS run_id, user_id AS document_version_id, event_type AS stage, ts AS started_at, props AS metrics FROM {events}",
    "artifacts": """
        SELECT l_orderkey AS document_version_id, l_shipmode_kind AS bundle_type, uri AS artifact_uri, l_shipdate AS created_at, id FROM (
          SELECT DISTINCT l_orderkey, concat(l_returnflag, l_linestatus) AS l_shipmode_kind,
                 CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '' ELSE concat('/out/', l_partkey) END AS uri, l_shipdate, l_partkey * 10 + l_linenumber AS id FROM {lineitem}) x""",
    # documents as specifications: frequent words of each language stand for what marks fields, rules, paths and samples
    "spec_text": """
        SELECT doc_id AS doc, concat('BT-', doc_id, ' Entry of ', source, CASE WHEN doc_id % 3 = 0 THEN ' ........ 12' ELSE '' END, chr(10),
          replace(replace(replace(replace(replace(replace(replace(replace(replace(text, '. ', concat('.', chr(10), 'BT-', doc_id % 90 * 11, ' ')),
            ' de ', concat(chr(10), 'Business Rule', chr(10), 'BR-', doc_id % 7, ' BT-5 must have ')), ' the ', concat(chr(10), 'Business Rule', chr(10), 'HR-BR-', doc_id % 7, ' total = BT-8 ')),
            ' la ', concat(chr(10), 'Example of use:', chr(10), '<cbc:ID> ', doc_id, ' </cbc:ID><hrextac:Right>', doc_id, '</hrextac:Right>', chr(10))), ' and ', concat(chr(10), 'Example of use:', chr(10), '<cbc:Name>', source, '</cbc:Name>', chr(10), '17', chr(10))),
            ' le ', concat(chr(10), '/Invoice/cac:A/', chr(10), 'cbc:ID', chr(10))), ' of ', concat(chr(10), '/CreditNote/cbc:', chr(10), 'Name', chr(10), 'maximum of 20 characters ')),
            ' in ', concat(chr(10), 'BT-2 ')), ' und ', concat(chr(10), 'HR-BT-5 Mark', chr(10), '380 - Commercial', chr(10), doc_id % 5, ' - Kind of ', source, chr(10), '• two', chr(10), 'HR-BT-5', chr(10)))) AS text
        FROM {documents}""",
    "spec_rows": """
        SELECT doc_id AS doc, 1 AS page, 1 AS table_no, 1 AS row_no, 'ID' AS c0, 'Business term' AS c1, 'Description' AS c2, 'Note on use' AS c3, 'Type' AS c4, 'Card.' AS c5 FROM {documents}
        UNION ALL SELECT doc_id, 1, 1, 2, concat(' BT-', doc_id), 'Invoice number', 'A unique', 'Note  a', CASE doc_id % 4 WHEN 0 THEN ' At' WHEN 1 THEN 'Unit  price' WHEN 2 THEN 'Amount' ELSE 'Boolean (true)' END, '1..1' FROM {documents}
        UNION ALL SELECT doc_id, 1, 1, 3, '', '(continued)', lang, '', '', '' FROM {documents}
        UNION ALL SELECT doc_id, 1, 1, 4, '', 'UBL Invoice Path', '', '', '', 'Remark' FROM {documents}
        UNION ALL SELECT doc_id, 1, 1, 5, '', concat('/Invoice/cbc:ID', chr(10), '/CreditNote/cbc:ID'), '', '', '', concat('R', doc_id % 10) FROM {documents}
        UNION ALL SELECT doc_id, 1, 2, 1, 'BT-9', 'no header', 'ignored', '', '', '' FROM {documents}
        UNION ALL SELECT doc_id, 2, 1, 1, 'ID', 'Business term', 'Description', 'Note on use', 'Type', 'Card.' FROM {documents}
        UNION ALL SELECT doc_id, 2, 1, 2, '', '', 'text tail', NULL, '', '0..1' FROM {documents}
        UNION ALL SELECT doc_id, 2, 1, 3, concat('BT-', doc_id % 90 * 11), source, 'd', '', '', '' FROM {documents}
        UNION ALL SELECT doc_id, 2, 1, 4, 'BG-2', 'Group', 'grp', '', 'Date', '' FROM {documents}
        UNION ALL SELECT doc_id, 3, 1, 1, 'ID', CASE WHEN doc_id % 7 = 0 THEN 'Term' ELSE 'Business term' END, '', '', '', '' FROM {documents}
        UNION ALL SELECT doc_id, 3, 1, 2, 'HR-BT-5', 'Mark', '', 'ISO 4217', 'Code', '0..n' FROM {documents}
        UNION ALL SELECT doc_id, 3, 1, 3, '', '/Invoice/ext:Ext/hrextac:Wrong', '', '', '', '' FROM {documents}""",
    "notes_fields": """
        SELECT concat('BT-', d.doc_id) AS field_code, concat('field ', d.doc_id) AS field_name, 'atomic' AS field_kind,
               CASE d.doc_id % 3 WHEN 0 THEN 'Amount' WHEN 1 THEN 'Text' ELSE 'Code' END AS data_type,
               CASE WHEN quality = 1 THEN 'explicit' ELSE 'inferred' END AS origin, CASE WHEN d.doc_id % 4 = 0 THEN '' ELSE text END AS notes,
               CASE d.doc_id % 5 WHEN 0 THEN 'true' WHEN 1 THEN '' ELSE 'abc' END AS sample, CASE WHEN d.doc_id % 2 = 0 THEN 'x' END AS format_hint,
               CAST(0.5 + (d.doc_id % 50) / 100.0 AS DOUBLE) AS confidence
        FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id""",
    "code_entries": "SELECT r_name AS code_list_name, CAST(n_nationkey AS STRING) AS code, n_name AS label, n_nationkey AS ord FROM {nation} JOIN {region} ON n_regionkey = r_regionkey",
}


def needed(name: str, seen: list[str] | None = None) -> list[str]:
    """The views that a view is built on, in the order in which to define them, itself last."""
    seen = [] if seen is None else seen
    for inner in re.findall(r"\{(\w+)\}", VIEWS[name]):
        if inner in VIEWS:
            needed(inner, seen)
    if name not in seen:
        seen.append(name)
    return seen


def duck(sql: str) -> str:
    """DuckDB SQL with the views that it names in {braces} put before it."""
    order: list[str] = []
    for name in dict.fromkeys(re.findall(r"\{(\w+)\}", sql)):
        if name in VIEWS:
            needed(name, order)
    plain = lambda text: re.sub(r"\{(\w+)\}", r"\1", text)
    views = ",\n".join(f"{name} AS ({plain(VIEWS[name])})" for name in order)
    body = plain(sql).strip()
    if not views:
        return body
    return f"WITH {views}, {body[5:]}" if body[:5].upper() == "WITH " else f"WITH {views} {body}"


class Views:
    """The views, and the tables below them, as DataFrames of one input folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self.spark.sql(VIEWS[name], **{inner: self[inner] for inner in set(re.findall(r"\{(\w+)\}", VIEWS[name]))})

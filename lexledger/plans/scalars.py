"""Queries of the scalar functions, over the driver's tables and small fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexledger.functions import numbers
from lexledger.functions import text as t
from lexledger.plans.registering import registrar

QUERIES, ORACLES, query, _ = registrar()


@query("SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS squashed FROM documents")
def squash_ws(v):
    return v["documents"].select("doc_id", t.squash(F.col("text")).alias("squashed"))


@query("SELECT p_partkey, CASE x WHEN 'At' THEN 'Code' WHEN 'Unit price' THEN 'Unit price amount' ELSE x END AS data_type FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'At' WHEN 1 THEN 'Unit price' ELSE p_type END AS x FROM part)")
def normalize_type(v):
    raw = F.when(F.col("p_partkey") % 4 == 0, " At ").when(F.col("p_partkey") % 4 == 1, "Unit  price").otherwise(F.col("p_type"))
    return v["part"].select("p_partkey", t.normal_type(raw).alias("data_type"))


_CARDS = "SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN '1..1' WHEN 1 THEN '0..n' WHEN 2 THEN '1..' WHEN 3 THEN '..n' WHEN 4 THEN 'a..b' WHEN 5 THEN '1' ELSE concat(p_size, '..', p_size + 1) END AS c FROM {part}"


@query(f"""SELECT p_partkey, CASE WHEN contains(c, '..') AND regexp_full_match(split_part(c, '..', 1), '[0-9]+') THEN split_part(c, '..', 1)::INT END AS low,
  CASE WHEN contains(c, '..') THEN nullif(split_part(c, '..', 2), '') END AS high FROM ({_CARDS})""")
def parse_cardinality(v):
    return v.spark.sql(_CARDS, part=v["part"]).select("p_partkey", numbers.cardinality_min(F.col("c")).alias("low"), numbers.cardinality_max(F.col("c")).alias("high"))


_INTS = "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN ' 5' WHEN 2 THEN concat(p_size) ELSE '-3' END AS c FROM {part}"


@query(f"SELECT p_partkey, CASE WHEN regexp_full_match(c, '[0-9]+') THEN c::INT END AS n FROM ({_INTS})")
def to_int_or_none(v):
    return v.spark.sql(_INTS, part=v["part"]).select("p_partkey", numbers.int_or_null(F.col("c")).alias("n"))


_SETS = "SELECT p_partkey, concat(' ', p_brand, '; Remark: ', p_name, ';;', p_type, ' ; ', p_name) AS s FROM {part}"


@query(f"SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(s, ';'), lambda x: trim(x)), lambda x: x <> '' AND NOT starts_with(x, 'Remark:')), '|') AS refs FROM ({_SETS})")
def value_set_refs(v):
    return v.spark.sql(_SETS, part=v["part"]).select("p_partkey", F.array_join(t.value_set_refs(F.col("s")), "|").alias("refs"))


_NOTES = "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_name END AS d, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_type END AS n, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_brand END AS r FROM {part}"


@query(f"SELECT p_partkey, trim(concat_ws(' ', nullif(d, ''), nullif(n, ''), CASE WHEN r <> '' THEN concat('Remark: ', r) END)) AS notes FROM ({_NOTES})")
def interpretation(v):
    return v.spark.sql(_NOTES, part=v["part"]).select("p_partkey", t.interpretation(F.col("d"), F.col("n"), F.col("r")).alias("notes"))


@query("SELECT doc_id, left(trim(regexp_replace(coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END, ''), source), '\\s+', ' ', 'g')), 280) AS quote FROM documents")
def quote_text(v):
    return v["documents"].select("doc_id", t.quote(F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("text")), F.col("source")).alias("quote"))


@query("""SELECT doc_id, CASE WHEN k = 0 THEN left(f, 700) ELSE substring(f, greatest(k - 241, 0) + 1, least(k - 1 + 5 + 620, length(f)) - greatest(k - 241, 0)) END AS excerpt
  FROM (SELECT doc_id, f, strpos(f, ' the ') AS k FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS f FROM documents))""")
def excerpt_window(v):
    return v["documents"].select("doc_id", t.excerpt(F.col("text"), F.lit(" the ")).alias("excerpt"))


@query("SELECT field_code FROM {base_fields} WHERE contains(lower(concat_ws(' ', field_code, field_name, data_type, occurrence_max, invoice_path)), 'brand#1')")
def field_search(v):
    return v["base_fields"].where(t.matches_search(F.lit(" Brand#1 "), *map(F.col, ("field_code", "field_name", "data_type", "occurrence_max", "invoice_path")))).select("field_code")


_FLAGS = "SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN ' TRUE ' WHEN 1 THEN 'on' WHEN 2 THEN '1' WHEN 3 THEN 'Yes' WHEN 4 THEN 'off' END AS f FROM {part}"


@query(f"SELECT p_partkey, coalesce(lower(trim(f)) IN ('1', 'true', 'on', 'yes'), false) AS flag FROM ({_FLAGS})")
def truthy(v):
    return v.spark.sql(_FLAGS, part=v["part"]).select("p_partkey", t.truthy(F.col("f")).alias("flag"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS at FROM orders")
def iso_dates(v):
    return v["orders"].select("o_orderkey", numbers.iso_date(F.col("o_orderdate")).alias("day"), numbers.iso_timestamp(F.col("o_orderdate")).alias("at"))


@query("SELECT doc_id, sha256(text) AS checksum FROM documents")
def sha256_doc(v):
    return v["documents"].select("doc_id", F.sha2("text", 256).alias("checksum"))


@query("SELECT field_code, concat(coalesce(occurrence_min::VARCHAR, ''), '..', occurrence_max) AS label FROM {base_fields}")
def cardinality_label(v):
    return v["base_fields"].select("field_code", numbers.cardinality_label(F.col("occurrence_min"), F.col("occurrence_max")).alias("label"))


@query("SELECT o_orderkey, regexp_replace(lower(concat(o_orderpriority, ' ', o_orderstatus)), '[^a-z0-9_-]', '-', 'g') AS class FROM orders")
def status_class(v):
    return v["orders"].select("o_orderkey", t.status_class(F.concat_ws(" ", "o_orderpriority", "o_orderstatus")).alias("class"))


@query("SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;') AS escaped FROM pages")
def html_escape(v):
    return v["pages"].select("page_id", t.html_escaped(F.col("html")).alias("escaped"))


@query("SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.k') AS INT), 0) AS k FROM events")
def json_counter(v):
    return v["events"].select("event_id", numbers.json_counter(F.col("props"), "k").alias("k"))


@query("""SELECT o_orderkey, CASE WHEN contains(expression_text, '=') OR contains(l, 'sum of') OR contains(l, 'multiplied by') THEN 'arithmetic' WHEN contains(l, 'mutually exclusive') OR contains(l, 'must not both') THEN 'exclusive'
    WHEN starts_with(l, 'if ') OR contains(l, ' if ') THEN 'dependency' WHEN contains(l, 'equal to') THEN 'equality' WHEN contains(l, 'must contain') OR contains(l, 'must have') OR contains(l, 'must be provided') THEN 'presence'
    WHEN contains(l, 'code list') OR contains(l, 'list are used') OR contains(l, 'values from table') THEN 'code_list' WHEN contains(l, 'format') OR contains(l, 'decimal places') OR contains(l, 'whitespace characters') THEN 'format' ELSE 'other' END AS rule_type
  FROM (SELECT *, lower(expression_text) AS l FROM {rule_text})""")
def classify_rule(v):
    return v["rule_text"].select("o_orderkey", t.classify_rule(F.col("expression_text")).alias("rule_type"))


@query(r"""SELECT o_orderkey, regexp_extract(expression_text, '^((?:HR-)?BR(?:-[A-Z]+)?-\d+)\b', 1) AS rule_code,
  array_to_string(list_sort(list_distinct(regexp_extract_all(expression_text, '\b(?:HR-)?(?:BT|BG)-\d+\b'))), ',') AS refs FROM {rule_text}""")
def rule_code_refs(v):
    return v["rule_text"].select("o_orderkey", t.rule_code(F.col("expression_text")).alias("rule_code"), F.array_join(t.field_refs(F.col("expression_text")), ",").alias("refs"))


_PATHS = """SELECT ord, concat(CASE ord % 4 WHEN 0 THEN '/invoice/cac:A/ ' WHEN 1 THEN '/Invoice/cac:B/' WHEN 2 THEN '' ELSE 'x ' END, CASE WHEN ord % 4 < 2 THEN 'cbc:ID' ELSE '' END,
  CASE ord % 3 WHEN 0 THEN ' /CreditNote/ext:HRFISK20dana/cbc:Amt' WHEN 1 THEN '/creditnote/cbc:Amt/@currencyID' ELSE '' END) AS path FROM {base_fields}"""
_CLEAN = "replace(replace(replace(replace(regexp_replace(path, '\\s+', '', 'g'), 'HRFISK20dana', 'HRFISK20Data'), 'HRFISK20data', 'HRFISK20Data'), '/invoice/', '/Invoice/'), '/creditnote/', '/CreditNote/')"
_SPLIT = f"SELECT ord, cleaned, regexp_extract(cleaned, '(/Invoice/.*?)(?:/CreditNote/|$)', 1) AS invoice, regexp_extract(cleaned, '(/CreditNote/.*)$', 1) AS credit_note FROM (SELECT ord, {_CLEAN} AS cleaned FROM ({_PATHS}))"


@query(f"SELECT ord, cleaned FROM ({_SPLIT})")
def clean_path(v):
    return v.spark.sql(_PATHS, base_fields=v["base_fields"]).select("ord", t.clean_path(F.col("path")).alias("cleaned"))


@query(f"SELECT ord, invoice, credit_note FROM ({_SPLIT})")
def split_paths(v):
    return v.spark.sql(_PATHS, base_fields=v["base_fields"]).select("ord", t.invoice_path(F.col("path")).alias("invoice"), t.credit_note_path(F.col("path")).alias("credit_note"))


@query(f"""SELECT ord, CASE WHEN contains(s, ':') THEN split_part(s, ':', -1) ELSE s END AS tag, attribute FROM (SELECT ord, regexp_extract(p, '/@([A-Za-z0-9_:-]+)$', 1) AS attribute, coalesce(CASE WHEN regexp_matches(p, '/@[A-Za-z0-9_:-]+$') THEN split_part(p, '/', -2) ELSE split_part(p, '/', -1) END, '') AS s
  FROM (SELECT ord, coalesce(nullif(invoice, ''), credit_note) AS p FROM ({_SPLIT})))""")
def path_token(v):
    return v.spark.sql(_PATHS, base_fields=v["base_fields"]).select("ord", t.path_tag(F.col("path")).alias("tag"), t.path_attribute(F.col("path")).alias("attribute"))


@query("SELECT page_id, array_to_string(list_slice(regexp_extract_all(html, '<[^>]+>.*?</[^>]+>', 0, 's'), 1, 20), chr(10)) AS examples FROM pages")
def html_examples(v):
    return v["pages"].select("page_id", F.array_join(t.examples(F.col("html")), "\n").alias("examples"))


_HEADED = "SELECT doc_id, concat('BT-', doc_id, ' head', chr(10), 'no BT-1', chr(10), replace(text, '. ', concat('.', chr(10), 'BT-7 ')), chr(10), ' HR-BR-7: x', chr(10), 'TB-2y') AS text FROM {documents}"


@query(rf"SELECT doc_id, array_to_string(list_slice(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: regexp_matches(x, '^(?:HR-)?(?:BT|BG|BR|TB)-\d+\b')), 1, 50), '|') AS headings FROM ({_HEADED})")
def html_headings(v):
    return v.spark.sql(_HEADED, documents=v["documents"]).select("doc_id", F.array_join(t.headings(F.col("text")), "|").alias("headings"))


@query("SELECT doc_id, CAST(i - 1 AS INT) AS line_no, string_split(text, chr(10))[i] AS line FROM (SELECT doc_id, text, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM documents)")
def document_lines(v):
    return v["documents"].select("doc_id", F.posexplode(t.lines(F.col("text"))).alias("line_no", "line"))


@query("SELECT l_partkey, array_to_string(list_slice(list_sort(list_distinct(list(l_linenumber))), 1, 3), ',') AS pages FROM lineitem GROUP BY l_partkey")
def first_pages(v):
    return v["lineitem"].groupBy("l_partkey").agg(F.array_join(numbers.first_pages(F.collect_list("l_linenumber")), ",").alias("pages"))


_HINTS = """SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'Text' WHEN 1 THEN 'Date' WHEN 2 THEN 'Time' WHEN 3 THEN 'Boolean (true)' WHEN 4 THEN 'Amount' ELSE 'Unit price amount' END AS data_type,
  concat(CASE p_size % 3 WHEN 0 THEN concat('Maximum of ', p_size, ' characters; ') ELSE '' END, CASE p_size % 5 WHEN 0 THEN concat('last ', p_size % 4, ' to ', p_size, ' digits ') ELSE '' END,
    CASE p_partkey % 7 WHEN 0 THEN 'Format YYYY-MM-DD' WHEN 1 THEN 'format hh:mm:ss' WHEN 2 THEN 'use yyyy-MM-d.d' WHEN 3 THEN 'rounded to two decimal places' WHEN 4 THEN 'written to 2 decimal places; multiple decimals' ELSE p_name END) AS hint FROM {part}"""
LIMITS = ("min_char_length", "max_char_length", "min_decimal_scale", "max_decimal_scale")


def limits_sql(source: str, text: str) -> str:
    """source plus the four limits that the column ``text`` and data_type give."""
    return rf"""SELECT * EXCLUDE (digits, top, dated, timed, two, several, bottom_, top_, scale_), CASE WHEN top_ <> '' THEN bottom_ WHEN data_type = 'Date' THEN '10' WHEN data_type = 'Time' THEN '8' WHEN starts_with(data_type, 'Boolean') THEN '4' ELSE bottom_ END AS min_char_length,
        CASE WHEN top_ <> '' THEN top_ WHEN data_type = 'Date' THEN '10' WHEN data_type = 'Time' THEN '8' WHEN starts_with(data_type, 'Boolean') THEN '5' ELSE '' END AS max_char_length,
        scale_ AS min_decimal_scale, CASE WHEN scale_ = '' AND data_type = 'Amount' THEN '2' ELSE scale_ END AS max_decimal_scale
      FROM (SELECT *, coalesce(nullif(digits, ''), CASE WHEN dated THEN '10' WHEN timed THEN '8' ELSE '' END) AS bottom_, coalesce(nullif(top, ''), CASE WHEN dated THEN '10' WHEN timed THEN '8' ELSE '' END) AS top_,
          CASE WHEN two AND NOT several THEN '2' ELSE '' END AS scale_
        FROM (SELECT *, regexp_extract({text}, '(?i)last (\d+) to \d+ digits', 1) AS digits, CASE WHEN digits <> '' THEN regexp_extract({text}, '(?i)last \d+ to (\d+) digits', 1) ELSE regexp_extract({text}, '(?i)maximum of (\d+) characters', 1) END AS top,
            regexp_matches({text}, '(?i)format\s+yyyy[-/]mm[-/]dd') OR contains({text}, 'yyyy-MM-d.d') AS dated, regexp_matches({text}, '(?i)format\s+hh:mm:ss') AS timed,
            regexp_matches({text}, '(?i)(?:written to|rounded to)\s+(?:2|two)\s+decimal places') AS two, regexp_matches({text}, '(?i)multiple decimals') AS several FROM {source}))"""


@query(f"SELECT p_partkey, {', '.join(LIMITS)} FROM ({limits_sql(f'({_HINTS})', 'hint')})")
def infer_constraints(v):
    cases = v.spark.sql(_HINTS, part=v["part"])
    return cases.withColumns(numbers.constraints(F.col("data_type"), F.col("hint"))).select("p_partkey", *LIMITS)

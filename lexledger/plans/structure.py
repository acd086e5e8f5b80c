"""Queries of the ordered folds and of whole extraction. Documents stand in for specifications (views spec_text and
spec_rows); the SQL works on windows of lines where the operators fold."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexledger.functions import text as t
from lexledger.operators import extract, folds, versions
from lexledger.operators.lineage import settled, shared_folder
from lexledger.plans.registering import registrar
from lexledger.plans.scalars import LIMITS, limits_sql
from lexledger.sources.store import Store, rows_of

QUERIES, ORACLES, query, SOURCES = registrar()

_H, _R = t.HEADING, t.RULE


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _squash(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def _lines_of(source: str, column: str) -> str:
    """The rows of source for each stripped line of a column, with its number i from 1."""
    return f"SELECT * EXCLUDE parts, {_strip('parts[i]')} AS line FROM (SELECT *, unnest(generate_series(1, len(parts))) AS i FROM (SELECT * EXCLUDE {column}, string_split({column}, chr(10)) AS parts FROM {source}))"


def _count(what: str) -> str:
    return f"(len(block) - len(replace(block, '{what}', ''))) // {len(what)}"


_DOTS = r"CASE WHEN regexp_matches(split_part(block, chr(10), 1), '\.{5,}') THEN 3 ELSE 0 END"
_HAS_PATH = r"regexp_matches(block, '(?:^|\n)(?:/Invoice|/invoice|/CreditNote)')"
_DETAIL = f"CAST(3 * ({_count('Business Rule')}) + 2 * ({_count('Example of use:')}) - {_DOTS} - CASE WHEN {_HAS_PATH} THEN 2 ELSE 0 END AS INT)"
_TABLE = f"CASE WHEN {_HAS_PATH} THEN 5 ELSE 0 END + CASE WHEN contains(block, 'Example of use:') THEN 1 ELSE 0 END - CASE WHEN contains(block, 'Business Rule') THEN 2 ELSE 0 END - {_DOTS}"


def _best(score: str) -> str:
    return f"SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY doc, code ORDER BY score DESC, start) AS r FROM (SELECT *, {score} AS score FROM blocks)) WHERE r = 1"


#: lines, blocks of lines, and of each code the block that tells most and the one that shows paths
_BLOCKS = rf"""
  lines AS ({_lines_of('{spec_text}', 'text')}),
  heads AS (SELECT *, regexp_extract(line, '{_H}') AS code FROM lines WHERE regexp_matches(line, '{_H}')),
  starts AS (SELECT a.doc, a.code, a.i AS start, min(b.i) AS stop FROM heads a LEFT JOIN heads b ON a.doc = b.doc AND b.i > a.i AND NOT (b.code = a.code AND starts_with(b.line, concat(b.code, ' ')))
    WHERE starts_with(a.line, concat(a.code, ' ')) GROUP BY a.doc, a.code, a.i),
  blocks AS (SELECT s.doc, s.code, s.start - 1 AS start, string_agg(l.line, chr(10) ORDER BY l.i) AS block FROM starts s JOIN lines l ON l.doc = s.doc AND l.i >= s.start AND (s.stop IS NULL OR l.i < s.stop)
    WHERE NOT regexp_full_match(l.line, '\d+') GROUP BY s.doc, s.code, s.start),
  detail AS ({_best(_DETAIL)}), shows AS ({_best(_TABLE)})"""

#: rules (doc, code, pos, rule) of the telling blocks
_RULES = rf"""
  told AS ({_lines_of('(SELECT doc, code, block FROM detail)', 'block')}),
  counted AS (SELECT *, regexp_matches(line, '{_H}') AS head, sum(CASE WHEN regexp_matches(line, '{_H}') THEN 1 ELSE 0 END) OVER (PARTITION BY doc, code ORDER BY i) AS heads FROM told),
  closed AS (SELECT *, max(CASE WHEN heads > 1 OR starts_with(line, 'Example of use:') THEN 1 ELSE 0 END) OVER (PARTITION BY doc, code ORDER BY i) AS after FROM counted),
  live AS (SELECT doc, code, i, line, regexp_matches(line, '{_R}') AS opens, lag(line) OVER (PARTITION BY doc, code ORDER BY i) AS before FROM closed WHERE after = 0 AND NOT head AND NOT starts_with(line, '<')),
  grouped AS (SELECT *, sum(CASE WHEN opens OR line IN ('', 'Business Rule', 'Description') OR (before LIKE '%.' AND NOT regexp_matches(line, '^[a-z(]')) THEN 1 ELSE 0 END) OVER (PARTITION BY doc, code ORDER BY i) AS g FROM live),
  every_rule AS (SELECT doc, code, min(i) AS place, {_squash("string_agg(line, ' ' ORDER BY i)")} AS rule FROM grouped GROUP BY doc, code, g HAVING bool_or(opens)),
  rules_of AS (SELECT doc, code, CAST(row_number() OVER (PARTITION BY doc, code ORDER BY min(place)) - 1 AS INT) AS pos, rule FROM every_rule GROUP BY doc, code, rule)"""

_CLEAN = r"replace(replace(replace(replace(regexp_replace(path, '\s+', '', 'g'), 'HRFISK20dana', 'HRFISK20Data'), 'HRFISK20data', 'HRFISK20Data'), '/invoice/', '/Invoice/'), '/creditnote/', '/CreditNote/')"
_SPLIT = f"regexp_extract({_CLEAN}, '(/Invoice/.*?)(?:/CreditNote/|$)', 1) AS invoice, regexp_extract({_CLEAN}, '(/CreditNote/.*)$', 1) AS credit_note"
#: paths (doc, code, invoice, credit_note) of the blocks that show them
_PATHS = rf"""
  shown AS ({_lines_of('(SELECT doc, code, block FROM shows)', 'block')}),
  kinds AS (SELECT *, regexp_matches(line, '^(?:/Invoice|/invoice|/CreditNote)') AS p, line NOT IN ('', 'Business Rule', 'Description', 'Example of use:') AND NOT contains(line, ' ') AND NOT regexp_matches(line, '{_H}|{_R}|^(?:<|ID|UBL|Remark|Table)') AS goes_on FROM shown),
  runs_of AS (SELECT *, sum(CASE WHEN p OR NOT goes_on THEN 1 ELSE 0 END) OVER (PARTITION BY doc, code ORDER BY i) AS g FROM kinds),
  paths AS (SELECT doc, code, {_SPLIT} FROM (SELECT doc, code, coalesce(string_agg(line, '' ORDER BY i) FILTER (kept), '') AS path FROM (SELECT *, bool_or(p) OVER (PARTITION BY doc, code, g) AS kept FROM runs_of) GROUP BY doc, code))"""


def _sampled(source: str) -> str:
    """source (with block and path) plus its sample."""
    return rf"""SELECT * EXCLUDE (shows_, invoice_, credit_, p_, attribute_, tag_), coalesce(nullif(CASE WHEN attribute_ <> '' THEN {_strip("regexp_extract(shows_, concat(attribute_, '=\"([^\"]+)\"'), 1)")} END, ''),
        nullif(CASE WHEN tag_ <> '' THEN {_squash(r"regexp_extract(shows_, concat('(?s)<(?:[A-Za-z0-9_]+:)?', tag_, '(?:\s[^>]*)?>\s*([^<\n]+?)\s*</(?:[A-Za-z0-9_]+:)?', tag_, '>'), 1)")} END, ''),
        list_filter(list_transform(regexp_extract_all(shows_, '>\s*([^<\n]+?)\s*<', 1), lambda x: {_squash('x')}), lambda x: x NOT IN ('', '...', '…'))[1], '') AS sample
      FROM (SELECT *, regexp_extract(p_, '/@([A-Za-z0-9_:-]+)$', 1) AS attribute_, split_part(coalesce(split_part(p_, '/', CASE WHEN attribute_ <> '' THEN -2 ELSE -1 END), ''), ':', -1) AS tag_
        FROM (SELECT *, replace(regexp_replace(CASE WHEN contains(block, 'Example of use:') THEN substring(block, strpos(block, 'Example of use:') + 15) ELSE block END, '(?m)^\d+$', '', 'g'), '…', '') AS shows_,
            {_SPLIT.replace('AS invoice', 'AS invoice_').replace('AS credit_note', 'AS credit_')}, coalesce(nullif(invoice_, ''), credit_) AS p_ FROM {source}))"""


def _repaired(path: str, report: str, block: str) -> str:
    """A path whose last hrextac: name is that of the only element of the block that holds the sample."""
    pattern = lambda at: rf"regexp_extract_all({block}, concat('(?s)<\s*hrextac:([A-Za-z0-9]+)[^>]*>\s*\Q', sample, '\E\s*</\s*hrextac:([A-Za-z0-9]+)\s*>'), {at})"
    names = f"list_distinct(list_transform(list_filter(generate_series(1, len({pattern(1)})), lambda k: {pattern(1)}[k] = {pattern(2)}[k]), lambda k: {pattern(1)}[k]))"
    return f"CASE WHEN contains({report}, 'hrextac:') AND sample <> '' AND len({names}) = 1 THEN regexp_replace({path}, 'hrextac:[^/]+$', concat('hrextac:', {names}[1])) ELSE {path} END"


_AT = "ORDER BY page, table_no, row_no"
#: field records of the tables
_RECORDS = rf"""
  cells AS (SELECT doc, page, table_no, row_no, {', '.join(f"{_strip(f"coalesce(c{k}, '')")} AS c{k}" for k in range(6))} FROM {{spec_rows}}),
  headed AS (SELECT *, bool_or(c0 = 'ID' AND c1 = 'Business term' AND n <= 5) OVER (PARTITION BY doc, page, table_no) AS headed FROM (SELECT *, row_number() OVER (PARTITION BY doc, page, table_no ORDER BY row_no) AS n FROM cells)),
  opened AS (SELECT *, regexp_matches(c0, '{t.FIELD_ID}') AS o, NOT o AND starts_with(c1, '/') AS p, sum(CASE WHEN regexp_matches(c0, '{t.FIELD_ID}') THEN 1 ELSE 0 END) OVER (PARTITION BY doc {_AT}) AS record
    FROM headed WHERE headed AND NOT (c0 = 'ID' AND c1 = 'Business term') AND c1 NOT IN ('UBL Invoice Path', 'UBL CreditNote Path (Approval)') AND concat(c0, c1, c2, c3, c4, c5) <> ''),
  split AS (SELECT * EXCLUDE path, {_SPLIT} FROM (SELECT *, c1 AS path FROM opened WHERE record > 0)),
  records AS (SELECT doc, CAST(record AS INT) AS record, max(c0) FILTER (o) AS field_code,
      {', '.join(_squash(f"coalesce(string_agg(c{k}, ' ' {_AT}) FILTER (NOT p AND c{k} <> ''), '')") + f' AS {name}' for k, name in ((1, 'field_name'), (2, 'description'), (3, 'note')))},
      CASE {_squash(f"coalesce(first(c4 {_AT}) FILTER (NOT p AND c4 <> ''), '')")} WHEN 'At' THEN 'Code' WHEN 'Unit price' THEN 'Unit price amount' ELSE {_squash(f"coalesce(first(c4 {_AT}) FILTER (NOT p AND c4 <> ''), '')")} END AS data_type,
      {_squash(f"coalesce(first(c5 {_AT}) FILTER (NOT p AND c5 <> ''), '')")} AS cardinality, coalesce(last(invoice {_AT}) FILTER (p AND invoice <> ''), '') AS invoice_path, coalesce(last(credit_note {_AT}) FILTER (p AND credit_note <> ''), '') AS credit_note_path,
      {_squash(f"coalesce(string_agg(c5, ' ' {_AT}) FILTER (p AND c5 <> ''), '')")} AS remark, list(page {_AT}) AS pages FROM split GROUP BY doc, record)"""
_RECORD_COLUMNS = ("doc", "record", "field_code", "field_name", "description", "note", "data_type", "cardinality", "invoice_path", "credit_note_path", "remark", "pages")


def spec_lines(v):
    return v["spec_text"].select("doc", F.posexplode(t.lines(F.col("text"))).alias("line_no", "line"))


def _best_blocks(v, kind):
    return folds.best_blocks(spec_lines(v)).where(F.col("kind") == kind)


@query(f"WITH {_RECORDS} SELECT * REPLACE (array_to_string(pages, ',') AS pages) FROM records")
def table_fold(v):
    return folds.table_records(v["spec_rows"]).withColumn("pages", F.array_join("pages", ",")).withColumn("record", F.col("record").cast("int")).select(*_RECORD_COLUMNS)


_SHIFT = "(doc + page) % 6"
#: The tables of specifications with full headers in other words, and their columns moved on by a number that depends on
#: document and page.
_MOVED = f"""SELECT doc, page, table_no, row_no, {', '.join(f"CASE {_SHIFT} {' '.join(f'WHEN {s} THEN {f"n{(k + s) % 6}"}' for s in range(6))} END AS c{k}" for k in range(6))} FROM (
  SELECT *, CASE WHEN c0 = 'ID' AND c1 = 'Business term' THEN ' id ' ELSE c0 END AS n0, CASE WHEN c0 = 'ID' AND c1 = 'Business term' THEN 'NAME' ELSE c1 END AS n1, CASE WHEN c0 = 'ID' THEN 'Meaning' ELSE c2 END AS n2,
    CASE WHEN c0 = 'ID' THEN 'Use' ELSE c3 END AS n3, CASE WHEN c0 = 'ID' THEN 'Semantic type' ELSE c4 END AS n4, CASE WHEN c0 = 'ID' THEN 'Cardinality' ELSE c5 END AS n5 FROM {{spec_rows}}) x"""
_OTHER_NAMES = {"field_id": ["ID", "No."], "business_term": ["Name"], "description": ["Meaning"], "note_on_use": ["Use"], "data_type": ["Semantic type"], "cardinality": ["Card.", "Cardinality"]}


@query(f"WITH {_RECORDS} SELECT * REPLACE (array_to_string(pages, ',') AS pages) FROM records")
def headed_tables(v):
    """The records of tables whose columns stand in another order on every page, under other names."""
    found = folds.table_records(folds.by_header(v.spark.sql(_MOVED, spec_rows=v["spec_rows"]), _OTHER_NAMES))
    return found.withColumn("pages", F.array_join("pages", ",")).withColumn("record", F.col("record").cast("int")).select(*_RECORD_COLUMNS)


#: All events as the tables of one document: a page for forty of them, each with a header.
_LEDGER = """SELECT 1 AS doc, CAST(floor(event_id / 40) AS INT) AS page, 1 AS table_no, CAST(event_id % 40 + 2 AS INT) AS row_no, CASE event_type WHEN 'signup' THEN concat('BT-', event_id) ELSE '' END AS c0,
    CASE event_type WHEN 'error' THEN '' ELSE event_type END AS c1, props AS c2, '' AS c3, CASE event_type WHEN 'click' THEN 'At' ELSE '' END AS c4, '' AS c5 FROM {events}
  UNION ALL SELECT DISTINCT 1, CAST(floor(event_id / 40) AS INT), 1, 1, 'ID', 'Business term', 'Description', '', '', '' FROM {events}"""


@query(f"WITH {_RECORDS.replace('{spec_rows}', f'({_LEDGER})')} SELECT * REPLACE (array_to_string(pages, ',') AS pages) FROM records")
def one_long_document(v):
    """Records of one document whose tables run over very many pages."""
    found = folds.table_records(v.spark.sql(_LEDGER, events=v["events"]))
    return found.withColumn("pages", F.array_join("pages", ",")).withColumn("record", F.col("record").cast("int")).select(*_RECORD_COLUMNS)


@query(f"WITH {_BLOCKS} SELECT doc, code, start, score, block FROM detail")
def detail_blocks(v):
    return _best_blocks(v, "detail").select("doc", "code", "start", "score", "block")


@query(f"WITH {_BLOCKS} SELECT doc, code, start, score, block FROM shows")
def table_blocks(v):
    return _best_blocks(v, "table").select("doc", "code", "start", "score", "block")


@query(f"WITH {_BLOCKS}, {_RULES} SELECT doc, code, pos, rule FROM rules_of")
def extract_rules(v):
    return _best_blocks(v, "detail").select("doc", "code", F.posexplode(folds.rules_of(F.col("block"))).alias("pos", "rule"))


@query(f"WITH {_BLOCKS}, {_PATHS} SELECT doc, code, invoice, credit_note FROM paths")
def path_fragments(v):
    joined = _best_blocks(v, "table").withColumn("path", folds.path_text(F.col("block")))
    return joined.select("doc", "code", t.invoice_path(F.col("path")).alias("invoice"), t.credit_note_path(F.col("path")).alias("credit_note"))


_SHOWN = """SELECT page_id, CASE WHEN page_id % 2 = 0 THEN replace(html, '<article', concat('Example of use:', chr(10), page_id, chr(10), '<article')) ELSE html END AS block,
  CASE page_id % 5 WHEN 0 THEN '/Invoice/cbc:title' WHEN 1 THEN '/Invoice/cbc:a/@href' WHEN 2 THEN '' WHEN 3 THEN concat('Invoice: /Invoice/cac:x/cbc:h1', chr(10), 'CreditNote: /CreditNote/cbc:p') ELSE '/CreditNote/cbc:li' END AS path FROM {pages}"""


@query(f"SELECT page_id, sample FROM ({_sampled(f'({_SHOWN})')})")
def example_value(v):
    return v.spark.sql(_SHOWN, pages=v["pages"]).select("page_id", t.example_value(F.col("block"), F.col("path")).alias("sample"))


_EXTENDED = """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '/Invoice/cbc:ID' ELSE '/Invoice/ext:E/hrextac:Wrong' END AS path, CASE WHEN p_partkey % 9 = 0 THEN '' ELSE CAST(p_size % 7 AS STRING) END AS sample,
  concat('<hrextac:T', p_size, '> ', p_size % 7, ' </hrextac:T', p_size, '> <hrextac:U a="1">', p_size % 5, '</ hrextac:U> <hrextac:V>', p_size % 7, '</hrextac:W> <hrextac:T', p_size, '>', p_size % 3, '</hrextac:T', p_size, '>') AS block FROM {part}"""


@query(f"SELECT p_partkey, {_repaired('path', 'path', 'block')} AS path FROM ({_EXTENDED})")
def extension_repair(v):
    fixed = t.repaired_extension(F.col("path"), F.concat(F.lit("Invoice: "), F.col("path")), F.col("sample"), F.col("block"))
    return v.spark.sql(_EXTENDED, part=v["part"]).select("p_partkey", fixed.alias("path"))


_SET_SOURCES = """SELECT doc, CASE doc % 5 WHEN 0 THEN 'Use untdid 1001 or ISO 4217' WHEN 1 THEN '' WHEN 2 THEN 'True | false' WHEN 3 THEN 'EACT' ELSE 'ISO 11649:2009, HR-TB-2' END AS note,
  CASE doc % 3 WHEN 0 THEN '' ELSE concat('R  ', doc) END AS remark, text AS block, CASE doc % 7 WHEN 0 THEN 'Boolean (true)' ELSE 'Code' END AS data_type FROM {spec_text}"""
_LISTED = rf"list_transform(list_filter(list_transform(string_split(block, chr(10)), lambda x: {_strip('x')}), lambda x: x <> '' AND NOT starts_with(x, '<') AND NOT regexp_matches(x, '{_R}') AND regexp_matches(x, '^[•\-]\s*|^\d{{1,4}}\s*[–-]\s*')), lambda x: {_squash(r"regexp_replace(x, '^[•\- ]+', '')")})"
_KNOWN = ", ".join(f"CASE WHEN contains(low, '{r.lower()}') THEN '{r}' END" for r in t.REFERENCES)


def _valued(source: str) -> str:
    """source (with note, remark, block and data_type) plus its value_set."""
    return f"""SELECT * EXCLUDE (every, low), array_to_string(list_filter(every, lambda x, k: list_position(every, x) = k), '; ') AS value_set FROM (
  SELECT *, list_filter(list_concat([CASE WHEN contains(low, 'true | false') OR starts_with(lower(data_type), 'boolean') THEN 'true|false' END, {_KNOWN}], {_LISTED}, [CASE WHEN remark <> '' THEN concat('Remark: ', {_squash('remark')}) END]), lambda x: x IS NOT NULL AND x <> '') AS every
  FROM (SELECT *, lower(concat_ws(chr(10), note, remark, block, data_type)) AS low FROM {source}))"""


@query(f"SELECT doc, value_set FROM ({_valued(f'({_SET_SOURCES})')})")
def value_set(v):
    return v.spark.sql(_SET_SOURCES, spec_text=v["spec_text"]).select("doc", t.value_set(F.col("note"), F.col("remark"), F.col("block"), F.col("data_type")).alias("value_set"))


_NAMED = "SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN ' - ' WHEN doc_id % 3 = 0 THEN text ELSE replace(replace(text, '. ', ' The '), ', ', ' Description ') END AS raw FROM {documents}"


def _name(x: str, otherwise: str) -> str:
    cut = " ".join(f"WHEN contains({_squash(x)}, '{end}') THEN trim(split_part({_squash(x)}, '{end}', 1))" for end in t.NAME_ENDS)
    return f"coalesce(nullif(trim(left(CASE {cut} ELSE {_squash(x)} END, 120), ' -:'), ''), {otherwise})"


@query(f"SELECT doc_id, {_name('raw', 'raw')} AS name FROM ({_NAMED})")
def infer_name(v):
    return v.spark.sql(_NAMED, documents=v["documents"]).select("doc_id", t.inferred_name(F.col("raw")).alias("name"))


_ANSWERS = "SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN concat('```json', chr(10), text, chr(10), '```') WHEN 1 THEN concat('``` ', text, '```', chr(10)) ELSE concat('  ', text, chr(10)) END AS raw FROM {conversations}"


@query(rf"SELECT conv_id, turn, trim(regexp_replace(regexp_replace({_strip('raw')}, '^```(?:json)?\s*', ''), '\s*```$', '')) AS answer FROM ({_ANSWERS})")
def response_cleanup(v):
    return v.spark.sql(_ANSWERS, conversations=v["conversations"]).select("conv_id", "turn", t.response_json(F.col("raw")).alias("answer"))


@query("SELECT conv_id, turn, concat('BT-', turn) AS field_code, text AS notes FROM conversations")
def answer_updates(v):
    """Updates out of model answers that come as a text, or as parts of several kinds, in a fence."""
    key = F.when(F.col("turn") % 2 == 0, F.lit("updates")).otherwise(F.lit("field_updates"))
    one = F.struct(F.concat(F.lit("BT-"), F.col("turn").cast("string")).alias("field_code"), F.col("text").alias("notes"))
    body = F.to_json(F.map_from_arrays(F.array(key), F.array(F.array(one))), {"ignoreNullFields": "false"})
    fenced = F.concat(F.lit("```json\n"), body, F.lit("\n```"))
    whole = F.to_json(F.array(fenced))
    object_ = lambda **c: F.to_json(F.struct(*[x.alias(k) for k, x in c.items()]))
    split = F.concat(F.lit('["```json",'), object_(text=body), F.lit(','), object_(type=F.lit("text"), content=F.lit("```")), F.lit(',{"type":"image","content":"x"},"",7]'))
    content = F.when(F.col("turn") % 3 == 0, whole).when(F.col("turn") % 3 == 1, F.substring(whole, F.lit(2), F.length(whole) - 2)).otherwise(split)
    found = v["conversations"].select("conv_id", "turn", F.explode(t.field_updates(F.parse_json(content), "struct<field_code:string,notes:string>")).alias("u"))
    return found.select("conv_id", "turn", "u.*")


def _heading(block: str) -> str:
    first = _strip(f"split_part({block}, chr(10), 1)")
    return f"CASE WHEN starts_with({first}, concat(code, ' ')) THEN {_squash(f'substring({first}, length(code) + 2)')} END"


def _report(invoice: str, credit_note: str) -> str:
    return f"concat_ws(chr(10), 'Invoice: ' || nullif({invoice}, ''), 'CreditNote: ' || nullif({credit_note}, ''))"


def _one_if(*what: str) -> str:
    return "CASE WHEN " + " OR ".join(f"contains(merged, '{w}')" for w in what) + " THEN 1 ELSE 0 END"


_PAGES = f"""
  missing AS (SELECT DISTINCT ref AS code FROM {{rules}} WHERE regexp_matches(ref, '^(?:HR-)?BT-') AND ref NOT IN (SELECT field_code FROM {{pub_fields}})),
  merged AS (SELECT d.doc, d.code, trim(s.block) AS shown_block, trim(d.block) AS told_block, concat_ws(chr(10), nullif(trim(s.block), ''), nullif(trim(d.block), '')) AS merged FROM detail d JOIN shows s ON d.doc = s.doc AND d.code = s.code WHERE d.code IN (SELECT code FROM missing)),
  scored AS (SELECT *, 5 * {_one_if('Example of use:')} + 4 * {_one_if('Business Rule')} + 4 * {_one_if('/Invoice/', '/CreditNote/')} + 3 * {_one_if('<cbc:', '<cac:')}
      - 6 * CASE WHEN regexp_matches(split_part(merged, chr(10), 1), '\\.{{5,}}') THEN 1 ELSE 0 END - 2 * CASE WHEN length(merged) < 120 THEN 1 ELSE 0 END AS score FROM merged),
  chosen AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY code ORDER BY score DESC, doc DESC) = 1),
  pathed AS (SELECT c.*, p.invoice, p.credit_note, told_block AS block, {_report('p.invoice', 'p.credit_note')} AS path, coalesce(nullif({_heading('told_block').replace('code', 'c.code')}, ''), nullif({_heading('shown_block').replace('code', 'c.code')}, ''), c.code) AS name FROM chosen c JOIN paths p ON c.doc = p.doc AND c.code = p.code)"""


@query(f"""WITH {_BLOCKS}, {_PATHS}, {_PAGES} SELECT code AS field_code, {_name('name', 'name')} AS field_name, nullif(invoice, '') AS invoice_path, nullif(credit_note, '') AS credit_note_path,
  nullif(sample, '') AS sample, doc AS page_number, score FROM ({_sampled('pathed')})""")
def fallback_fields(v):
    pages = v["spec_text"].select(F.col("doc").alias("page_number"), "text")
    found = extract.fallback_fields(pages, v["rules"], v["pub_fields"])
    return found.select("field_code", "field_name", "invoice_path", "credit_note_path", "sample", "page_number", "score")


_DEFINED_COLUMNS = ("doc", "record", "field_code", "field_name", "data_type", "occurrence_min", "occurrence_max", "invoice_path", "credit_note_path", "sample", "min_char_length", "max_char_length", "min_decimal_scale", "max_decimal_scale", "notes", "pages")
_WITH_TEXT = f"""
  joined AS (SELECT r.*, r.field_code AS code, coalesce(trim(d.block), '') AS block, coalesce(nullif(p.invoice, ''), r.invoice_path) AS inv, coalesce(nullif(p.credit_note, ''), r.credit_note_path) AS cre, {_report('inv', 'cre')} AS path
    FROM records r LEFT JOIN detail d ON r.doc = d.doc AND r.field_code = d.code LEFT JOIN paths p ON r.doc = p.doc AND r.field_code = p.code),
  sampled AS ({_sampled('joined')}),
  hinted AS (SELECT *, concat_ws(chr(10), nullif(note, ''), nullif(remark, ''), nullif(block, '')) AS hints FROM sampled),
  limited AS ({limits_sql('hinted', 'hints')})"""


def _extracted(v):
    return extract.with_text(settled(folds.table_records(v["spec_rows"])), spec_lines(v))


@query(f"""WITH {_RECORDS}, {_BLOCKS}, {_PATHS}, {_WITH_TEXT} SELECT doc, record, field_code, CASE WHEN contains(block, 'Example of use:') OR contains(block, 'Business Rule') THEN coalesce(nullif({_heading('block')}, ''), field_name) ELSE field_name END AS field_name,
  nullif(data_type, '') AS data_type, CASE WHEN contains(cardinality, '..') THEN try_cast(split_part(cardinality, '..', 1) AS INT) END AS occurrence_min, CASE WHEN contains(cardinality, '..') THEN nullif(split_part(cardinality, '..', 2), '') END AS occurrence_max,
  nullif({_repaired('inv', 'path', 'block')}, '') AS invoice_path, nullif({_repaired('cre', 'path', 'block')}, '') AS credit_note_path, nullif(sample, '') AS sample, {', '.join(f'try_cast({c} AS INT) AS {c}' for c in LIMITS)},
  nullif(trim(concat_ws(' ', nullif(description, ''), nullif(note, ''), 'Remark: ' || nullif(remark, ''))), '') AS notes, array_to_string(list_slice(list_sort(list_distinct(pages)), 1, 3), ',') AS pages FROM limited""")
def extract_fields(v):
    found = extract.field_definitions(_extracted(v)).withColumn("record", F.col("ord").cast("int"))
    return found.withColumn("pages", F.array_join(F.transform("evidence", lambda e: e["page_number"].cast("string")), ",")).select(*_DEFINED_COLUMNS)


_CLASSES = " ".join("WHEN " + " OR ".join([f"contains(lower(rule), '{m}')" for m in marks] + {"arithmetic": ["contains(rule, '=')"], "dependency": ["starts_with(lower(rule), 'if ')"]}.get(name, [])) + f" THEN '{name}'" for name, marks in t.RULE_CLASSES)


@query(rf"""WITH {_RECORDS}, {_BLOCKS}, {_RULES}, coded AS (SELECT q.doc, record, pos, rule, regexp_extract(rule, '{_R}') AS rule_code FROM records r JOIN rules_of q ON r.doc = q.doc AND r.field_code = q.code)
  SELECT doc, rule_code, CASE {_CLASSES} ELSE 'other' END AS rule_type, rule AS expression_text, array_to_string(list_sort(list_distinct(regexp_extract_all(rule, '{t.FIELD_REF}'))), ',') AS refs, 'error' AS severity
  FROM coded WHERE rule_code <> '' QUALIFY row_number() OVER (PARTITION BY doc, rule_code ORDER BY record, pos) = 1""")
def extract_rule_definitions(v):
    return extract.rule_definitions(_extracted(v)).select("doc", "rule_code", "rule_type", "expression_text", F.array_join("refs", ",").alias("refs"), "severity")


#: Catalogs: the specifications of a source together, a version for each source; of a code's definitions the last counts.
_CATALOGS = "SELECT DISTINCT source, dense_rank() OVER (ORDER BY source) AS document_version_id FROM {documents}"
_OF_DOC = f"SELECT doc_id AS doc, CAST(document_version_id AS BIGINT) AS document_version_id FROM {{documents}} d JOIN ({_CATALOGS}) s ON d.source = s.source"
_KEPT = "QUALIFY row_number() OVER (PARTITION BY document_version_id, field_code ORDER BY doc DESC, record DESC) = 1"


def _catalog(v) -> tuple:
    """(ids, fields, rules, code lists) of all catalogs, each row with its document_version_id."""
    # sources are numbered after they have been told apart, not over all documents in one task
    sources = v["documents"].select("source").distinct().withColumn("document_version_id", F.dense_rank().over(Window.orderBy(F.asc_nulls_last("source"))).cast("bigint"))
    of_doc = settled(v["documents"].select(F.col("doc_id").alias("doc"), "source").join(sources, "source").select("doc", "document_version_id"))
    records = settled(_extracted(v).join(of_doc, "doc"))
    place = F.col("doc").cast("bigint") * F.lit(1 << 24) + F.col("record")  # a document has fewer records than that
    found = extract.field_definitions(records).join(of_doc, "doc").withColumn("record", F.col("ord"))
    fields = settled(found.withColumn("ord", place))
    rules = extract.rule_definitions(records).join(of_doc, "doc")
    lists = versions.code_list_definitions(fields, "document_version_id")
    return of_doc.select("document_version_id").distinct(), fields, rules, lists


def _stored(v, *tables: str) -> dict:
    """The catalogs after they have been stored and loaded: what went through the named tables."""
    ids, fields, rules, lists = _catalog(v)
    store = Store(v.spark, f"{shared_folder(v.spark)}/catalogs-{uuid.uuid4().hex}")
    rows = rows_of(fields, rules, lists, "document_version_id")
    store.save_snapshots(ids, {name: rows[name] for name in tables})
    return store.load_snapshots()


_FIELD_COLUMNS = tuple(c for c in _DEFINED_COLUMNS if c not in ("doc", "record", "pages"))


@query(f"""SELECT document_version_id, {', '.join(_FIELD_COLUMNS)}, pages FROM ({SOURCES["extract_fields"]}) f JOIN ({_OF_DOC}) USING (doc) {_KEPT}""")
def stored_fields(v):
    """Fields of all catalogs as the store gives them back, paths and evidence with them."""
    got = _stored(v, "field", "path", "citation")["fields"]
    pages = F.array_join(F.transform("evidence", lambda e: e["page_number"].cast("string")), ",")
    return got.select("document_version_id", *_FIELD_COLUMNS, pages.alias("pages"))


@query(f"""SELECT document_version_id, rule_code, rule_type, expression_text, concat('{{"referenced_fields":', CASE WHEN refs = '' THEN '[]' ELSE concat('["', replace(refs, ',', '","'), '"]') END, '}}') AS normalized_expression, severity,
    coalesce((SELECT string_agg(DISTINCT field_code, ',' ORDER BY field_code) FROM ({SOURCES["extract_fields"]}) f JOIN ({_OF_DOC}) o ON f.doc = o.doc WHERE o.document_version_id = r.document_version_id AND list_contains(string_split(r.refs, ','), field_code)), '') AS refs
  FROM (SELECT * FROM ({SOURCES["extract_rule_definitions"]}) x JOIN ({_OF_DOC}) USING (doc) QUALIFY row_number() OVER (PARTITION BY document_version_id, rule_code ORDER BY expression_text) = 1) r""")
def stored_rules(v):
    """Rules of all catalogs as the store gives them back, with references to fields that their catalog knows."""
    got = _stored(v, "rule", "rule_link", "rule_citation")["rules"]
    return got.select("document_version_id", "rule_code", "rule_type", "expression_text", "normalized_expression", "severity", F.array_join("refs", ",").alias("refs"))


@query(rf"""WITH {_RECORDS}, {_BLOCKS}, {_PATHS}, {_WITH_TEXT}, valued AS ({_valued('hinted')}),
  refs AS (SELECT document_version_id, doc, record, unnest(generate_series(1, len(parts))) AS pos, unnest(parts) AS ref
    FROM (SELECT document_version_id, doc, record, list_filter(list_transform(string_split(value_set, ';'), lambda x: {_strip('x')}), lambda x: x <> '' AND NOT starts_with(x, 'Remark:')) AS parts FROM valued JOIN ({_OF_DOC}) USING (doc))),
  named AS (SELECT DISTINCT document_version_id, doc, record, ref AS code_list_name FROM refs WHERE regexp_matches(ref, '{t.REFERENCE_NAME}')),
  entries AS (SELECT *, trim(regexp_extract(ref, '^([^-–]+?)\s*[–-]\s*(.+)$', 1)) AS code, trim(regexp_extract(ref, '^([^-–]+?)\s*[–-]\s*(.+)$', 2)) AS label FROM refs WHERE NOT regexp_matches(ref, '{t.REFERENCE_NAME}') AND regexp_matches(ref, '^([^-–]+?)\s*[–-]\s*(.+)$')),
  one AS (SELECT document_version_id, code_list_name, code, label, doc, record, pos FROM named JOIN entries USING (document_version_id, doc, record) QUALIFY row_number() OVER (PARTITION BY document_version_id, code_list_name, code ORDER BY doc, record, pos) = 1)
  SELECT l.document_version_id, l.code_list_name, coalesce(string_agg(code || '=' || label, ';' ORDER BY o.doc, o.record, o.pos), '') AS entries
  FROM (SELECT DISTINCT document_version_id, code_list_name FROM named) l LEFT JOIN one o ON o.document_version_id = l.document_version_id AND o.code_list_name = l.code_list_name GROUP BY 1, 2""")
def stored_code_lists(v):
    """Code lists of all catalogs as the store gives them back."""
    got = _stored(v, "code_list", "code_entry", "code_list_citation")["code_lists"]
    return got.select("document_version_id", "code_list_name", F.array_join(F.transform("entries", lambda e: F.concat_ws("=", e["code"], e["label"])), ";").alias("entries"))

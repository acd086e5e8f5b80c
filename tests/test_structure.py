"""The folds and whole extraction over small specifications with results worked out by hand."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from lexledger.functions import numbers
from lexledger.functions import text as t
from lexledger.operators import extract, folds, lineage

HEADER = ("ID", "Business term", "Description", "Note on use", "Type", "Card.")
#: page, table_no, row_no, six cells
TABLE_ROWS = [
    (1, 1, 1, *HEADER), (1, 1, 2, "BT-1", "Invoice number", "A unique", "Note a", "Identifier", "1..1"), (1, 1, 3, "", "(continued)", "identification", "", "", ""),
    (1, 1, 4, "", "UBL Invoice Path", "", "", "", "Remark"), (1, 1, 5, "", "/Invoice/cbc:ID\n/CreditNote/cbc:ID", "", "", "", "R1"), (1, 2, 1, "x", "y", "table without header: ignored", "", "", ""),
    (2, 1, 1, *HEADER), (2, 1, 2, "", "", "text tail", "", "", "0..1"), (2, 1, 3, "BG-2", "Group", "grp", "", "", ""), (2, 1, 4, "HR-BT-5", "Mark", "d", "", "At", "0..n"),
]
ROW_SCHEMA = "doc int, page int, table_no int, row_no int, c0 string, c1 string, c2 string, c3 string, c4 string, c5 string"
LINES = ["BT-1 Invoice number ........ 12", "BT-2 Date ........ 13", "BT-1 Invoice number", "Business Rule", "BR-1 x", "17", "BT-1 more", "BT-2 Date", "/Invoice/cbc:IssueDate"]
RULE_LINES = ["BT-1 Invoice number", "Business Rule", "Description", "BR-1 The invoice shall have", "a number.", "Next sentence not part.", "BR-2 Two", "BR-1 The invoice shall have a number.", "Example of use:", "BR-9 hidden"]
PATH_LINES = ["BT-2 Date", "/Invoice/cac:A/", "cbc:IssueDate", "/CreditNote/cbc:IssueDate", "not a path"]
CONSTRAINT_CASES = [
    ("Text", "maximum of 20 characters", "", "20", "", ""), ("Text", "Maximum of 20 characters; last 2 to 4 digits", "2", "4", "", ""), ("Date", "", "10", "10", "", ""), ("Date", "maximum of 8 characters", "", "8", "", ""),
    ("Text", "Format YYYY-MM-DD", "10", "10", "", ""), ("Text", "maximum of 8 characters, format hh:mm:ss", "8", "8", "", ""), ("Text", "use yyyy-MM-d.d", "10", "10", "", ""), ("Time", "", "8", "8", "", ""), ("Boolean (true)", "", "4", "5", "", ""),
    ("Amount", "", "", "", "", "2"), ("Amount", "rounded to two decimal places", "", "", "2", "2"), ("Amount", "rounded to 2 decimal places; multiple decimals", "", "", "", "2"), ("Unit price amount", "multiple decimals", "", "", "", ""),
]
RECORDS = [
    ("BT-1", "Invoice number (continued) Group", "A unique identification text tail grp", "Note a", "Identifier", "1..1", "/Invoice/cbc:ID", "/CreditNote/cbc:ID", "R1", "1,1,1,2,2"),
    ("HR-BT-5", "Mark", "d", "", "Code", "0..n", "", "", "", "2"),
]
RECORD_COLUMNS = ("field_code", "field_name", "description", "note", "data_type", "cardinality", "invoice_path", "credit_note_path", "remark", "pages")
SHOWN = "BT-1 x\nExample of use:\n<cbc:ID>  380 </cbc:ID>\n<cbc:Name>z</cbc:Name>"
TWO_PATHS = "Invoice: /Invoice/cbc:ID\nCreditNote: /CreditNote/cbc:ID"
PAGES = [
    (1, "BT-7 Tax point ..... 9\nBT-8 Other"), (2, "BT-7 Tax point date The seller\nBusiness Rule\nBR-7 BT-7 must have a value\nExample of use:\n<cbc:TaxPointDate>2020-01-01</cbc:TaxPointDate>\n/Invoice/cbc:TaxPointDate"),
    (3, "BT-7 Tax point date The seller\nBusiness Rule\nBR-7 BT-7 must have a value\nExample of use:\n<cbc:TaxPointDate>2021-02-02</cbc:TaxPointDate>\n/Invoice/cbc:TaxPointDate"),
]
SPECIFICATION = [
    "BT-1 Invoice number ........ 12", "BT-1 Invoice number", "Business Rule", "BR-1 BT-1 must have a value. See BT-9", "and BT-3.", "Example of use:", "<cbc:ID>33445566</cbc:ID>", "maximum of 20 characters",
    "HR-BT-5 Mark", "/Invoice/ext:Ext/hrextac:Wrong",
]
DEFINED = [
    ("BT-1", "Invoice number", "Identifier", 1, "1", "/Invoice/cbc:ID", "/CreditNote/cbc:ID", "33445566", None, 20, "A unique identification text tail grp Note a Remark: R1", "1,2"),
    ("HR-BT-5", "Mark", "Code", 0, "n", "/Invoice/ext:Ext/hrextac:Wrong", None, None, None, None, "d", "2"),
]
DEFINED_COLUMNS = ("field_code", "field_name", "data_type", "occurrence_min", "occurrence_max", "invoice_path", "credit_note_path", "sample", "min_char_length", "max_char_length", "notes", "pages")


def table_rows(spark):
    return spark.createDataFrame([(1, *r) for r in TABLE_ROWS], ROW_SCHEMA)


def lines(spark, some=LINES):
    return spark.createDataFrame([(1, i + 1, x) for i, x in enumerate(some)], "doc int, line_no int, line string")


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def one(spark, schema, *row):
    return spark.createDataFrame([row], schema)


def test_table_rows_become_records(spark):
    found = folds.table_records(table_rows(spark)).withColumn("pages", F.array_join("pages", ","))
    assert rows_of(found, *RECORD_COLUMNS) == RECORDS


def test_best_blocks(spark):
    told = [("BT-1", 3, 3, "BT-1 Invoice number\nBusiness Rule\nBR-1 x\nBT-1 more"), ("BT-2", 8, -2, "BT-2 Date\n/Invoice/cbc:IssueDate")]
    shows = [("BT-1", 7, 0, "BT-1 more"), ("BT-2", 8, 5, "BT-2 Date\n/Invoice/cbc:IssueDate")]
    found = folds.best_blocks(lines(spark))
    assert rows_of(found.where("kind = 'detail'"), "code", "start", "score", "block") == told
    assert rows_of(found.where("kind = 'table'"), "code", "start", "score", "block") == shows
    assert rows_of(folds.described(lines(spark)), "code", "detail", "table_block") == [(a[0], a[3], b[3]) for a, b in zip(told, shows)]
    assert {r.code for r in folds.best_blocks(lines(spark), codes=spark.createDataFrame([("BT-2",)], "code string")).collect()} == {"BT-2"}


def test_best_blocks_equal_brute_force(spark):
    rng = random.Random(11)
    parts = ["BT-1 x", "BT-1 y .......... 4", "BT-1", "BT-2 z", "HR-BT-3 q", "Business Rule", "a Business Rule Business Rule", "Example of use:", "/Invoice/cbc:ID", "/CreditNote/x", "12", "words", ""]
    texts = {doc: [rng.choice(parts) for _ in range(rng.randrange(60))] for doc in range(40)}
    want = {}
    for doc, every in texts.items():
        head = [re.match(t.HEADING, x) for x in every]
        for at, x in enumerate(every):
            if not head[at] or not x.startswith(head[at].group() + " "):
                continue
            code = head[at].group()
            stop = next((k for k in range(at + 1, len(every)) if head[k] and not every[k].startswith(code + " ")), len(every))
            block = [y for y in every[at:stop] if not y.isdigit()]
            text, path = "\n".join(block), any(y.startswith(("/Invoice", "/CreditNote")) for y in block)
            dots = 3 * ("....." in block[0])
            detail = 3 * text.count("Business Rule") + 2 * text.count("Example of use:") - dots - 2 * path
            table = 5 * path + ("Example of use:" in text) - 2 * ("Business Rule" in text) - dots
            for kind, score in (("detail", detail), ("table", table)):
                best = want.get((doc, code, kind))
                if best is None or score > best[1]:
                    want[doc, code, kind] = (at, score, text)
    df = spark.createDataFrame([(d, k, x) for d, every in texts.items() for k, x in enumerate(every)], "doc int, line_no int, line string")
    assert {(r.doc, r.code, r.kind): (r.start, r.score, r.block) for r in folds.best_blocks(df).collect()} == want


def test_many_headings_in_a_row_are_linear(spark):
    n = 100_000
    df = spark.range(n).selectExpr("1 AS doc", "id AS line_no", "CASE WHEN id = 60000 THEN 'BT-1 the one' WHEN id = 60001 THEN 'Business Rule' ELSE 'BT-1 again' END AS line")
    began = time.perf_counter()
    got = {r.kind: (r.start, r.score, r.block.count("\n")) for r in folds.best_blocks(df).collect()}
    assert got == {"detail": (0, 3, n - 1), "table": (60002, 0, n - 60003)} and time.perf_counter() - began < 60


def test_lines_are_read_once_and_numbered_without_their_text(spark):
    df = spark.range(3000).selectExpr("id % 3 AS doc", "(id div 1000 << 32) + id AS line_no", "CASE WHEN id % 100 < 3 THEN concat('BT-', id % 3, ' of page') WHEN id % 100 = 9 THEN 'Business Rule' ELSE concat('\u2003text ', id, ' ') END AS line")
    found = folds.best_blocks(df)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Range (" not in plan  # the lines have been taken apart, once
    assert not re.search(r"\bline#", plan[plan.index("Window") :].partition("Relation")[0])  # what windows sort has no text
    got = {(r.doc, r.kind): (r.start, r.score, r.block) for r in found.collect()}
    for doc in range(3):  # one island, over three pages
        mine = [((k // 1000 << 32) + k, f"BT-{doc} of page" if k % 100 < 3 else "Business Rule" if k % 100 == 9 else f"text {k}") for k in range(3000) if k % 3 == doc]
        first = next(n for n, x in mine if x.startswith("BT-"))
        rules = lambda at: sum(x == "Business Rule" for n, x in mine if n >= at)  # noqa: E731, B023
        shown = next((n for n, x in mine if x.startswith("BT-") and not rules(n)), None)
        table = (shown, 0) if shown is not None else (first, -2)
        assert got[doc, "detail"] == (first, 3 * rules(first), "\n".join(x for n, x in mine if n >= first))
        assert got[doc, "table"] == (*table, "\n".join(x for n, x in mine if n >= table[0]))


def test_columns_are_found_by_headers(spark):
    order = [5, 2, 0, 4, 1, 3]  # and a column more
    moved = [(p, n, r, *[cells[k] for k in order], "extra") for p, n, r, *cells in TABLE_ROWS]
    rows = spark.createDataFrame([(1, *r) for r in moved], "doc int, page int, table_no int, row_no int, " + ", ".join(f"c{k} string" for k in range(7)))
    found = folds.table_records(folds.by_header(rows, cells=tuple(f"c{k}" for k in range(7)))).withColumn("pages", F.array_join("pages", ","))
    assert rows_of(found, *RECORD_COLUMNS) == RECORDS
    bare = rows.where("page = 1 AND table_no = 2")
    assert [(r.c0, r.c1) for r in folds.by_header(bare, cells=tuple(f"c{k}" for k in range(7))).collect()] == [(r.c0, r.c1) for r in bare.collect()]


def test_one_long_document_is_folded_in_segments(spark):
    n = 200_000
    rows = spark.range(n).selectExpr("1 AS doc", "id div 60000 AS page", "1 AS table_no", "id % 60000 AS row_no", "CASE WHEN id % 60000 = 3 THEN 'ID' WHEN id % 7 = 0 THEN concat('BT-', id) ELSE '' END AS c0",
                                     "CASE WHEN id % 60000 = 3 THEN 'Business term' ELSE concat('n', id) END AS c1", *[f"'' AS c{k}" for k in range(2, 6)])
    found = folds.table_records(rows)
    got = {r.record: (r.field_code, r.field_name) for r in found.select("record", "field_code", "field_name").collect()}
    want, open_ = {}, []
    for k in range(n):
        if k % 60000 == 3:
            continue
        if k % 7 == 0:
            open_ = [f"BT-{k}", []]
            want[len(want) + 1] = open_
        open_[1].append(f"n{k}")
    assert got == {r: (code, " ".join(names)) for r, (code, names) in want.items()}
    lines_ = spark.range(n).selectExpr("1 AS doc", "id AS line_no", "CASE WHEN id % 50000 = 7 THEN concat('BT-', id, ' x') WHEN id % 50000 = 9 THEN concat('BT-', id - 2, ' y') ELSE 'z' END AS line")
    ends = {r.island: (r.a, r.b) for r in folds.islands(lines_).groupBy("island").agg(F.min("line_no").alias("a"), F.max("line_no").alias("b")).collect()}
    assert ends == {k: (max(0, k * 50000 - 49993), min(n, k * 50000 + 7) - 1) for k in range(5)}
    for df in (found, folds.islands(lines_)):  # no window over rows is by document alone
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert all("_segment" in w for w in re.findall(r"windowspecdefinition\(.*", plan) if "_n#" not in w and "_last#" not in w and "_r#" not in w and "row_number" not in w)


def test_rules_and_paths_of_a_block(spark):
    rules = one(spark, "block string", "\n".join(RULE_LINES)).select(folds.rules_of(F.col("block"))).first()[0]
    assert rules == ["BR-1 The invoice shall have a number.", "BR-2 Two"]
    joined = folds.path_text(F.col("block"))
    paths = one(spark, "block string", "\n".join(PATH_LINES)).select(t.invoice_path(joined), t.credit_note_path(joined)).first()
    assert tuple(paths) == ("/Invoice/cac:A/cbc:IssueDate", "/CreditNote/cbc:IssueDate")


@pytest.mark.parametrize("block, path, want", [(SHOWN, "/Invoice/cbc:Name", "z"), (SHOWN, TWO_PATHS, "380"), ('<cbc:Amt currencyID="EUR">5</cbc:Amt>', "/Invoice/cbc:Amt/@currencyID", "EUR"), ("no tags", "", "")])
def test_example_value(spark, block, path, want):
    assert one(spark, "block string, path string", block, path).select(t.example_value(F.col("block"), F.col("path"))).first()[0] == want


@pytest.mark.parametrize("path, sample, want", [("/Invoice/hrextac:Wrong", "5", "/Invoice/hrextac:Right"), ("/Invoice/hrextac:Wrong", "7", "/Invoice/hrextac:Wrong"), ("/Invoice/cbc:ID", "5", "/Invoice/cbc:ID")])
def test_extension_repair(spark, path, sample, want):
    block = F.lit("<hrextac:Right>5</hrextac:Right> <hrextac:Other>6</hrextac:Other>")
    fixed = t.repaired_extension(F.col("path"), F.concat(F.lit("Invoice: "), F.col("path")), F.col("sample"), block)
    assert one(spark, "path string, sample string", path, sample).select(fixed).first()[0] == want


def test_value_sets_names_and_answers(spark):
    rows = [("Use UNTDID 1001", "R", "BT-3 Type\n380 – Commercial invoice\n• bullet; two", "Code"), ("", "", "", "Boolean (true)"), ("", "", "BR-1 - rule\n<x>", "Text")]
    made = spark.createDataFrame(rows, "note string, remark string, block string, data_type string").select(t.value_set(*map(F.col, ("note", "remark", "block", "data_type"))))
    assert rows_of(made, "*") == [("",), ("UNTDID 1001; 380 – Commercial invoice; bullet; two; Remark: R",), ("true|false",)]
    for raw, name in (("Payment code The seller must", "Payment code"), ("A The B Description c", "A The B"), ("x" * 130, "x" * 120), (" - ", " - ")):
        assert one(spark, "raw string", raw).select(t.inferred_name(F.col("raw"))).first()[0] == name
    for raw, answer in (('```json\n{"updates": []}\n```', '{"updates": []}'), (" [1] ", "[1]")):
        assert one(spark, "raw string", raw).select(t.response_json(F.col("raw"))).first()[0] == answer


def test_constraints(spark):
    made = spark.createDataFrame([c[:2] for c in CONSTRAINT_CASES], "data_type string, hint string")
    limits = numbers.constraints(F.col("data_type"), F.col("hint"))
    assert rows_of(made.withColumns(limits), "data_type", "hint", *limits) == sorted(CONSTRAINT_CASES, key=repr)


def test_fields_that_only_rules_name(spark):
    pages = spark.createDataFrame(PAGES, "page_number int, text string")
    rules = spark.createDataFrame([("BR-7", "BT-7"), ("BR-7", "BT-1"), ("BR-8", "BG-4"), ("BR-8", "BT-99")], "rule_code string, ref string")
    found = extract.fallback_fields(pages, rules, spark.createDataFrame([("BT-1",)], "field_code string"))
    assert rows_of(found, "field_code", "field_name", "invoice_path", "credit_note_path", "sample", "page_number", "score") == [("BT-7", "Tax point date", "/Invoice/cbc:TaxPointDate", None, "2021-02-02", 3, 16)]


def test_whole_extraction(spark):
    records = extract.with_text(folds.table_records(table_rows(spark)), lines(spark, SPECIFICATION))
    fields = extract.field_definitions(records).withColumn("pages", F.array_join(F.transform("evidence", lambda e: e["page_number"].cast("string")), ","))
    assert rows_of(fields, *DEFINED_COLUMNS) == DEFINED
    rules = extract.rule_definitions(records).withColumn("refs", F.array_join("refs", ","))
    assert rows_of(rules, "rule_code", "rule_type", "expression_text", "refs", "severity") == [("BR-1", "presence", "BR-1 BT-1 must have a value. See BT-9 and BT-3.", "BT-1,BT-3,BT-9", "error")]
    assert extract.with_text(folds.table_records(table_rows(spark)), lines(spark, [])).count() == 2


@pytest.mark.parametrize("content, want", [
    ('"plain"', "plain"), ('["a", {"text": "b"}, {"type": "text", "content": "c"}, {"type": "x", "content": "no"}, "", {"text": 5}, null, 7]', "a\nb\nc"), ("[]", ""), ('{"a":1}', '{"a":1}'), ("5", "5"),
])
def test_answers_of_parts(spark, content, want):
    assert one(spark, "c string", content).select(t.response_text(F.parse_json("c"))).first()[0] == want


@pytest.mark.parametrize("answer, want", [
    ('{"updates":[{"a":1}]}', [1]), ('```json\n{"field_updates":[{"a":2}],"updates":[{"a":1}]}\n```', [2]), ("no json", None), ('{"other":[]}', None), ('{"updates":[]}', []),
])
def test_updates_of_answers(spark, answer, want):
    got = one(spark, "c string", answer).select(t.field_updates(F.parse_json(F.to_json(F.array("c"))), "struct<a:int>")).first()[0]
    assert (got if got is None else [u.a for u in got]) == want


def test_a_text_is_searched_once_for_each_hint(spark):
    found = one(spark, "kind string, text string", "Date", "maximum of 7 characters").select(*[c.alias(n) for n, c in numbers.constraints(F.col("kind"), F.col("text")).items()])
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.count("maximum of (") <= len(found.columns) and tuple(found.first()) == ("", "7", "", "")


def test_rows_of_records_are_made_once(spark):
    """What makes the rows is not repeated where they are read."""
    made = spark.range(4).selectExpr("id DIV 4 AS doc", "1 AS page", "1 AS table_no", "CAST(id AS INT) AS row_no", "CASE id WHEN 0 THEN 'ID' ELSE concat('BT-', reverse(CAST(id AS STRING))) END AS c0", "IF(id = 0, 'Business term', 'name') AS c1", "'' AS c2", "'' AS c3", "'' AS c4", "'' AS c5")
    found = folds.table_records(made)
    assert "reverse(" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.field_code for r in found.collect()) == ["BT-1", "BT-2", "BT-3"]


def test_blocks_are_put_together_in_tasks_of_bounded_rows(spark, monkeypatch):
    """However few partitions the session has for a shuffle; codes are looked up when their headings have been summed up."""
    made = spark.range(400).selectExpr("id % 40 AS doc", "CAST(id DIV 40 AS INT) AS line_no", "concat('BT-', id DIV 40 % 3, ' heading ', id) AS line")
    codes = spark.createDataFrame([("BT-2",)], "code string")
    want = rows_of(folds.best_blocks(made, codes=codes), "doc", "code", "kind", "start", "score", "block")
    monkeypatch.setattr(lineage, "ROWS_OF_TASK", 20)
    found = folds.best_blocks(made, codes=codes)
    assert found.rdd.getNumPartitions() == 20
    assert rows_of(found, "doc", "code", "kind", "start", "score", "block") == want and len(want) == 80

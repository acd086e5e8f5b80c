"""Whole runs, prompts, profiles."""

import json

from pyspark.sql import functions as F

from lexledger import runtime
from lexledger.operators import enrich, profiles, versions
from lexledger.sources.store import Store
from tests import test_structure as structure


def page_rows():
    tables = {}
    for page, table, _, *cells in structure.TABLE_ROWS:
        tables.setdefault(page, {}).setdefault(table, []).append(cells)
    text = "\n".join(structure.SPECIFICATION)
    return [(text if p == 1 else "BT-9 Buyer reference The buyer\nBusiness Rule\nExample of use:\n<cbc:Ref>77</cbc:Ref>", list(t.values())) for p, t in sorted(tables.items())]


def test_a_run_from_files_to_a_published_version(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/spec.pdf").write_bytes(b"any")
    rows = page_rows()
    document = {"jurisdiction": "HR", "tax_domain": "einvoice", "language_code": "en", "version_label": "v1"}
    store = Store(spark, str(tmp_path / "store"))
    first = runtime.execute(spark, str(tmp_path / "in"), lambda _: rows, document, str(tmp_path / "out1"), store)
    got = {r["field_code"]: (r["origin"], r["field_name"], r["sample"]) for r in first.fields.collect()}
    assert got == {"BT-1": ("explicit", "Invoice number", "33445566"), "HR-BT-5": ("explicit", "Mark", None), "BT-9": ("inferred", "Buyer reference", "77")}
    assert {(r["code"], r["field_code"]) for r in first.issues.collect()} == {("dangling_rule_reference", None), ("missing_field_path", "BT-9")}
    assert first.changes.count() == 0 and not first.published
    store.publish(first.version_id, "me")
    changed = [(text, [[c if c != "Note a" else "Note b" for c in row] for row in t] if not isinstance(t[0][0], list) else [[[c if c != "1..1" else "0..1" for c in row] for row in tbl] for tbl in t]) for text, t in rows]
    second = runtime.execute(spark, str(tmp_path / "in"), lambda _: changed, document | {"version_label": "v2"}, str(tmp_path / "out2"), store)
    assert {(r["field_code"], r["change_type"]) for r in second.changes.collect()} == {("BT-1", "cardinality_changed")}
    assert second.version_id != first.version_id and store.table("version").count() == 2
    read = lambda place: [json.loads(r["value"]) for r in spark.read.text(place).collect()]
    assert read(f"{second.folders['version_diff']}/changes")[0]["risk_level"] == "high"
    assert read(f"{second.folders['version_diff']}/header")[0]["summary"] == {"added": 0, "removed": 0, "changed": 1}
    assert read(f"{first.folders['version_diff']}/header")[0]["summary"]["baseline"] == "none"
    assert read(second.folders["run_summary"])[0]["database"]["document_version_id"] == second.version_id
    stored = store.bundle(first.version_id)
    assert {r["rule_code"]: (r["refs"], [e["page_number"] for e in r["evidence"]]) for r in stored["rules"].collect()} == {r["rule_code"]: ([x for x in r["refs"] if x in got], [e["page_number"] for e in r["evidence"]]) for r in first.rules.collect()}
    assert first.rules.count() > 0 and first.code_lists.count() == stored["code_lists"].count()
    kept = {r["field_code"]: (r["description"], r["notes"], r["value_set_refs"], r["sample"], r["remark"]) for r in stored["fields"].collect()}
    assert kept == {r["field_code"]: (r["description"], r["notes"], r["value_set_refs"], r["sample"], r["remark"] if r["invoice_path"] or r["credit_note_path"] else None) for r in first.fields.collect()}


def test_steps_are_replaceable(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/spec.pdf").write_bytes(b"any")
    fields = spark.createDataFrame([("BT-1", "Name", "atomic", 1, "1", "/Invoice/x", None, [(1, "table", "q")], 1)], "field_code string, field_name string, field_kind string, occurrence_min int, occurrence_max string, invoice_path string, credit_note_path string, evidence array<struct<page_number:int,source_kind:string,quote_text:string>>, ord long")
    fields = fields.withColumns({c: F.lit(None).cast("string") for c in ("data_type", "remark", "min_char_length", "max_char_length", "min_decimal_scale", "max_decimal_scale", "description", "sample", "notes", "origin")} | {"value_set_refs": F.array(F.lit("ISO 1"), F.lit("A - a")), "confidence": F.lit(0.5)})
    rules = spark.createDataFrame([], "rule_code string, rule_type string, expression_text string, refs array<string>, severity string, origin string, confidence double, evidence array<struct<page_number:int,source_kind:string,quote_text:string>>")
    called = []
    steps = runtime.Steps(
        parse=lambda files, decoder: called.append("parse") or files.select("path", F.lit(1).alias("page_number"), F.lit("x").alias("text"), F.array().cast("array<array<array<string>>>").alias("tables")),
        extract=lambda found: called.append("extract") or (fields, rules, versions.code_list_definitions(fields)), publish=lambda parts, folder: called.append("publish") or f"{folder}/mine", publish_when_clean=True,
    )
    store = Store(spark, str(tmp_path / "store"))
    got = runtime.execute(spark, str(tmp_path / "in"), None, {"jurisdiction": "HR", "tax_domain": "e", "version_label": "v"}, str(tmp_path / "out"), store, steps)
    assert called == ["parse", "extract", "publish"] and not got.published or got.folders["published_bundle"].endswith("/mine")
    assert [[(e["code"], e["label"]) for e in r["entries"]] for r in store.bundle(got.version_id)["code_lists"].collect()] == [[("A", "a")]]


def test_command_line(spark, tmp_path, capsys):
    rows = [("x.pdf", k + 1, text, tables) for k, (text, tables) in enumerate(page_rows())]
    spark.createDataFrame(rows, "path string, page_number int, text string, tables array<array<array<string>>>").write.json(str(tmp_path / "pages"))
    runtime.main(["--pages", str(tmp_path / "pages"), "--jurisdiction", "HR", "--tax-domain", "e", "--version-label", "v", "--outdir", str(tmp_path / "out"), "--auto-publish"])
    assert "published False" in capsys.readouterr().out


def test_prompts_show_excerpts_and_hide_doubtful_values(spark):
    fields = spark.createDataFrame(
        [("BT-1", "Name", "Text", "true", "", "inferred", 0.5, [{"page_number": 2}, {"page_number": 9}]), ("BT-2", "Other", "Code", "x", "note", "explicit", 0.9, [])],
        "field_code string, field_name string, data_type string, sample string, notes string, origin string, confidence double, evidence array<struct<page_number:int>>",
    )
    pages = spark.createDataFrame([(1, "a BT-22 b"), (2, "x " * 300 + "BT-1" + " y" * 700)], "page_number int, text string")
    got = json.loads(enrich.prompts(enrich.batched(fields, ["field_code"]), pages, {"jurisdiction": "HR"}).first()["prompt"])
    one, two = got["fields"]
    assert got["document"]["jurisdiction"] == "HR" and len(got["instructions"]) == 5
    assert one["field"]["sample_value"] is None and one["field"]["semantic_notes"] is None and two["field"]["sample_value"] == "x"
    assert [(e["page_number"], len(e["excerpt"])) for e in one["source_excerpts"]] == [(2, 864)]
    assert [e["page_number"] for e in two["source_excerpts"]] == [1]  # BT-2 is found in BT-22


def test_evidence_is_added_once(spark):
    kind = "array<struct<page_number:int,source_kind:string,quote_text:string>>"
    fields = spark.createDataFrame([("BT-1", [(1, "llm_page_excerpt", "BT-1 here")])], f"field_code string, evidence {kind}")
    cited = spark.createDataFrame([("BT-1", [1, 2, 3])], "field_code string, page_numbers array<int>")
    pages = spark.createDataFrame([(1, "BT-1  here"), (2, "see BT-1"), (3, "BT-1 third")], "page_number int, text string")
    row = enrich.with_evidence(fields, cited, pages).first()
    assert [tuple(e) for e in row["evidence"]] == [(1, "llm_page_excerpt", "BT-1 here"), (2, "llm_page_excerpt", "see BT-1")]


def test_profiles(spark):
    df = spark.createDataFrame([("BT-1 x ..... 3\nBusiness Rule\nBusiness Rule\n/Invoice/a", "Maximum of 7")], "block string, hint string")
    score = profiles.block_score(F.col("block"), {"contains:Business Rule": 3, r"first_line_regex:\.{5,}": -3, "line_startswith_path": -2})
    rules = [{"regex": "(?i)maximum", "set": {"max_char_length": "7"}}, {"regex": "of", "set_if_empty": {"max_char_length": "9", "min_char_length": "1"}}]
    row = df.select(score.alias("s"), profiles.canonical_header(F.lit(" Card. "), {"cardinality": ["card."]}).alias("h"), *[c.alias(n) for n, c in profiles.rule_constraints(F.col("hint"), rules).items()]).first()
    assert (row.s, row.h, row.max_char_length, row.min_char_length) == (1, "cardinality", "7", "1")
    issues = lambda *codes: spark.createDataFrame([(c, "BT-1", "warning") for c in codes] or [], "code string, field_code string, severity string")
    assert profiles.repair_outcome(issues("a", "b"), issues("b"), "a").first()["accepted"]
    assert not profiles.repair_outcome(issues("a", "b"), issues("a", "b"), "a").first()["accepted"]


def test_generated_checks_run(spark):
    fields = spark.createDataFrame([("BT-1", 1, 2, 3, 2), ("BT-2", 0, None, None, None)], "field_code string, occurrence_min int, min_char_length int, max_char_length int, max_decimal_scale int")
    checks = [r["predicate"] for r in profiles.generated_checks(fields).collect()]
    invoices = spark.createDataFrame([("abc",), (None,), ("x",), ("long one",), ("1.5",), ("1.255",)], "`BT-1` string")
    assert [r[0] for r in invoices.where(" AND ".join(f"({c})" for c in checks)).collect()] == ["abc", "1.5"]


def test_patches_without_effect_make_no_version(spark):
    rows = [("a", 1, "x", "1"), ("a", 2, "x", " 1 "), ("a", 3, "y", '{"q": 1, "p": [2]}'), ("a", 4, "y", '{"p":[2],"q":1}'), ("a", 5, "x", None), ("a", 6, "x", "1"), ("a", 7, "z", "no json"), ("b", 1, 'o"dd', "null"), ("c", 1, "x", None)]
    patches = spark.createDataFrame(rows, "profile_id string, ord int, path string, value string").repartition(3)
    effects = {(r.profile_id, r.ord): (r.content_hash, r.effective) for r in profiles.patch_effects(patches).collect()}
    assert {k for k, (_, e) in effects.items() if e} == {("a", 1), ("a", 3), ("a", 5), ("a", 6), ("b", 1)}
    assert effects["a", 6][0] == effects["a", 4][0] == effects["a", 7][0] and effects["c", 1][0] == 0
    found = {(r.profile_id, r.first_ord): r.uses for r in profiles.profile_versions(patches).collect()}
    assert found == {("a", 1): 1, ("a", 3): 2, ("a", 5): 1, ("b", 1): 1}
    got = {r.profile_id: json.loads(r.c) for r in profiles.current_profiles(patches).select("profile_id", F.to_json("config").alias("c")).collect()}
    assert got == {"a": {"x": 1, "y": {"p": [2], "q": 1}}, "b": {'o"dd': None}, "c": {}}

"""Rule texts as formulas and conditions."""

import json

import pytest

from lexledger.operators import rulechecks

TEXTS = {
    "BR-1 BT-1 = sum of BT-3, BT-2 and HR-BT-4": ("sum", "BT-1", ["BT-2", "BT-3", "HR-BT-4"]), "BT-1 must be equal to the sum of BT-2 + BT-3": ("sum", "BT-1", ["BT-2", "BT-3"]),
    "Total = sum of BT-12 and BT-7": None, "BT-1 = BT-3 multiplied by BT-2": ("product", "BT-1", ["BT-2", "BT-3"]), "BT-8 multiplied by BT-8": None,
    "If BT-5 is given, BG-3 is required": None, "If BT-5 is given, BT-3 is required": ("dependency", "BT-5", ["BT-3"]), "when BT-5 is provided then BT-3 must have a value": ("dependency", "BT-5", ["BT-3"]),
    "HR-BT-2 and BT-1 are mutually exclusive": ("exclusive", "BT-1", ["HR-BT-2"]), "BT-9 must be equal to BT-10": ("equal", "BT-10", ["BT-9"]), "BT-10 = BT-9": ("equal", "BT-10", ["BT-9"]),
    "BT-4 must have a value": ("presence", "BT-4", []), "TWO decimal places in BT-6": ("decimals", "BT-6", ["2"]), "at most 3 decimal places in BT-6": ("decimals", "BT-6", ["3"]), "plain words": None, "": None, None: None,
}


def test_wordings_have_one_form(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    got = {r.text: r.form for r in df.select("text", rulechecks.normal_form(df.text).alias("form")).collect()}
    assert {t: f and tuple(json.loads(f)[c] for c in ("kind", "target", "args")) for t, f in got.items()} == TEXTS


def test_conditions(spark):
    invoices = spark.createDataFrame([(1, 5.0, 2.0, 3.0), (2, 5.0, 2.0, None), (3, None, None, 3.0), (4, 6.004, 2.0, 3.0), (5, 2.0, 2.0, 1.0)], "id int, `BT-1` double, `BT-2` double, `BT-3` double")
    rules = spark.createDataFrame([("A", "BT-1 = sum of BT-2 and BT-3"), ("B", "If BT-1 is given, BT-3 is required"), ("C", "BT-2 and BT-3 are mutually exclusive"), ("D", "BT-1 must be equal to BT-2"), ("E", "BT-2 must have a value"), ("F", "two decimal places in BT-1"), ("G", "BT-1 = BT-2 multiplied by BT-3"), ("H", "no formula"), ("B", "zz BT-9 must have a value")], "rule_code string, expression_text string")
    conditions = rulechecks.compiled(rules)
    assert [c for c, _ in conditions] == list("ABCDEFG")  # of the two texts of B the one with the smaller form
    got = {}
    for r in rulechecks.violations(invoices, conditions, "id").collect():
        got.setdefault(r.id, "")
        got[r.id] += r.rule_code
    assert {k: "".join(sorted(v)) for k, v in got.items()} == {1: "CDG", 2: "ABD", 3: "E", 4: "ACDFG", 5: "AC"}
    assert rulechecks.violations(invoices, [], "id").count() == 0


def test_too_many_rules_are_refused(spark, monkeypatch):
    monkeypatch.setattr(rulechecks, "MOST_RULES", 2)
    rules = spark.createDataFrame([(str(k), f"BT-{k} must have a value") for k in range(3)], "rule_code string, expression_text string")
    with pytest.raises(ValueError, match="more than"):
        rulechecks.compiled(rules)

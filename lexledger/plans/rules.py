"""Queries of rules as formulas."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexledger.operators import rulechecks
from lexledger.plans.registering import registrar

QUERIES, ORACLES, query, _ = registrar()

#: Rule texts of all orders in two wordings; what changes from one to the other depends on the order.
_TEXTS = """SELECT concat('BR-', o_orderkey) AS rule_code, o_orderkey % 8 AS k, concat('BT-', o_orderkey % 5 + 21) AS a, concat('BT-', o_custkey % 5 + 6) AS b, concat('HR-BT-', o_orderkey % 3 + 11) AS c, o_custkey % 4 AS how FROM {orders}"""


def _text(words: dict[int, str]) -> str:
    return "CASE k " + " ".join(f"WHEN {k} THEN concat({', '.join(x if x in 'abc' else f"'{x}'" for x in w.split('|'))})" for k, w in words.items()) + " ELSE 'plain words' END"


_OLD = _text({0: "a| = sum of |b| and |c", 1: "a| = |b| multiplied by |c", 2: "If |a| is given, |b| is required", 3: "a| and |b| are mutually exclusive", 4: "a| must be equal to |b", 5: "a| must have a value", 6: "two decimal places in |a"})
_NEW = _text({0: "The amount |a| shall equal the sum of |c| + |b", 1: "a| is |c| multiplied by |b", 2: "when |a| is provided then |b| must be given", 3: "b| and |a| must not both be given", 4: "b| shall equal |a", 5: "a| is mandatory", 6: "at most 2 decimal places in |a"})
_BOTH = f"""SELECT rule_code, k, a, b, c, how, {_OLD} AS old_text, CASE how WHEN 0 THEN {_OLD} WHEN 1 THEN {_NEW} WHEN 2 THEN replace({_NEW}, a, 'BT-99') ELSE {_NEW} END AS new_text FROM ({_TEXTS}) x"""

_FORM = """CASE k WHEN 0 THEN concat('sum ', {a}, ' ', {b}, ',', {c}) WHEN 1 THEN concat('product ', {a}, ' ', {b}, ',', {c}) WHEN 2 THEN concat('dependency ', {a}, ' ', {b}) WHEN 3 THEN concat('exclusive ', least({a}, {b}), ' ', greatest({a}, {b}))
  WHEN 4 THEN concat('equal ', least({a}, {b}), ' ', greatest({a}, {b})) WHEN 5 THEN concat('presence ', {a}, ' ') WHEN 6 THEN concat('decimals ', {a}, ' 2') ELSE 'none' END"""


def _changed(a: str) -> str:
    return _FORM.replace("{a}", a).replace("{b}", "b").replace("{c}", "c")


_FORM_BOTH = f"SELECT *, {_changed('a')} AS old_form, {_changed("CASE WHEN how = 2 THEN 'BT-99' ELSE a END")} AS new_form FROM ({_BOTH}) y"


@query(f"SELECT rule_code, old_form, new_form FROM ({_FORM_BOTH})")
def rule_formulas(v):
    """The formulas of all rules in both wordings."""
    show = lambda c: F.coalesce(F.concat_ws(" ", rulechecks.formula(F.col(c))["kind"], rulechecks.formula(F.col(c))["target"], F.array_join(rulechecks.formula(F.col(c))["args"], ",")), F.lit("none"))
    found = v.spark.sql(_BOTH, orders=v["orders"])
    some = lambda c: F.when(rulechecks.formula(F.col(c)).isNull(), "none").otherwise(show(c))
    return found.select("rule_code", some("old_text").alias("old_form"), some("new_text").alias("new_form"))


@query(f"""WITH f AS (SELECT * FROM ({_FORM_BOTH})), x AS (SELECT rule_code, CASE WHEN how = 3 AND k < 2 THEN 'removed' WHEN how = 3 AND k > 5 THEN 'added' WHEN old_form <> new_form THEN 'formula_changed' WHEN old_text <> new_text THEN 'wording_changed' END AS change_type FROM f)
  SELECT *, CASE change_type WHEN 'wording_changed' THEN 'low' WHEN 'added' THEN 'medium' ELSE 'high' END AS risk_level FROM x WHERE change_type IS NOT NULL""")
def formula_diff(v):
    """Rules added, removed, with another formula, or only put in other words."""
    both = v.spark.sql(_BOTH, orders=v["orders"])
    side = lambda c, gone: both.where(f"NOT (how = 3 AND {gone})").select("rule_code", F.col(c).alias("expression_text"))
    return rulechecks.formula_changes(side("old_text", "k > 5"), side("new_text", "k < 2"))


_INVOICES = """SELECT l_orderkey AS invoice, count(*) AS `BT-1`, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS `BT-2`, count(CASE WHEN l_returnflag <> 'R' THEN 1 END) AS `BT-3`, min(CASE WHEN l_returnflag = 'R' THEN l_linenumber END) AS `BT-4`,
    max(CASE WHEN l_linestatus = 'F' THEN l_linenumber END) AS `BT-5`, CAST(min(l_discount) * 25 AS DECIMAL(12,3)) AS `BT-6` FROM {lineitem} GROUP BY l_orderkey"""
_CHECKS = """SELECT concat('BR-', n_nationkey) AS rule_code, CASE n_nationkey % 8 WHEN 0 THEN 'BT-1 = sum of BT-2 and BT-3' WHEN 1 THEN 'BT-2 must be equal to BT-3' WHEN 2 THEN 'If BT-4 is given, BT-5 is required' WHEN 3 THEN 'BT-4 and BT-5 are mutually exclusive'
    WHEN 4 THEN 'BT-5 must have a value' WHEN 5 THEN 'two decimal places in BT-6' WHEN 6 THEN 'BT-1 = BT-2 multiplied by BT-3' ELSE 'plain words' END AS expression_text, n_nationkey % 8 AS k FROM {nation}"""


@query(f"""WITH i AS ({_INVOICES.replace('`', '"')}), r AS ({_CHECKS}) SELECT invoice, rule_code FROM i JOIN r ON CASE k WHEN 0 THEN "BT-1" <> "BT-2" + "BT-3" WHEN 1 THEN "BT-2" <> "BT-3" WHEN 2 THEN "BT-4" IS NOT NULL AND "BT-5" IS NULL WHEN 3 THEN "BT-4" IS NOT NULL AND "BT-5" IS NOT NULL
  WHEN 4 THEN "BT-5" IS NULL WHEN 5 THEN "BT-6" <> round("BT-6", 2) WHEN 6 THEN "BT-1" <> "BT-2" * "BT-3" ELSE false END""")
def rule_violations(v):
    """The rules that the invoices of all orders break."""
    invoices = v.spark.sql(_INVOICES, lineitem=v["lineitem"])
    return rulechecks.violations(invoices, rulechecks.compiled(v.spark.sql(_CHECKS, nation=v["nation"])), "invoice")

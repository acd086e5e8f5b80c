"""Rule texts as formulas: a normal form that does not depend on the wording, and checks that run over invoice rows."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CODE = r"((?:HR-)?BT-\d+)"
_LIST = r"((?:HR-)?BT-\d+(?:(?:\s*,\s*|\s+and\s+|\s*,\s*and\s+|\s*\+\s*)(?:HR-)?BT-\d+)*)"
_GIVEN = r"(?:\s+(?:is|are))?\s+(?:given|provided|present|required|mandatory|filled in)"
#: Kinds of formulas, the first that fits counts: (kind, pattern, whether the second group may come in any order). The
#: first group is what the formula is about, the second what it depends on.
GRAMMAR = (
    ("sum", rf"{_CODE}\s*(?:=|(?:must |shall )?(?:be |is )?(?:equal to|equals?)|is)\s*(?:the )?sum of\s+{_LIST}", True),
    ("product", rf"{_CODE}\s*(?:=|(?:must |shall )?(?:be )?(?:equal to|equals?)|is)\s*((?:HR-)?BT-\d+\s+multiplied by\s+(?:HR-)?BT-\d+)", True),
    ("dependency", rf"(?:if|when)\s+{_CODE}{_GIVEN}\s*,?\s*(?:then\s+)?{_CODE}(?:\s+(?:must|shall)\s+(?:be|have))?(?:\s+(?:is|are))?\s+(?:given|provided|present|required|mandatory|filled in|a value)", False),
    ("exclusive", rf"{_CODE}\s+and\s+{_CODE}\s+(?:are\s+mutually exclusive|(?:must|shall) not both be (?:given|provided|present))", True),
    ("equal", rf"{_CODE}\s+(?:(?:must|shall)\s+(?:be\s+)?(?:equal to|equals?)|=)\s+{_CODE}", True),
    ("presence", rf"{_CODE}\s+(?:(?:must|shall)\s+(?:have a value|be provided|be given|be present|be filled in)|is mandatory)()", False),
    ("decimals", rf"(?:at most )?(one|two|three|four|\d)\s+decimal places in\s+{_CODE}", False),
)
#: Kinds in which both sides play the same part.
_SYMMETRIC = ("exclusive", "equal")
_NUMBERS = {"one": "1", "two": "2", "three": "3", "four": "4"}

FORMULA = "struct<kind:string,target:string,args:array<string>>"


def formula(text: Column) -> Column:
    """(kind, target, args) of a rule's text, null if it is none of the grammar's: codes in any order where order means
    nothing, so that texts of one meaning have one form."""
    out = F.lit(None).cast(FORMULA)
    for kind, pattern, any_order in reversed(GRAMMAR):
        pattern = rf"(?i){pattern}"
        one, other = F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2)
        codes = F.regexp_extract_all(other, F.lit(_CODE), F.lit(1))
        if kind == "decimals":
            n = reduce(lambda c, x: F.when(F.lower(one) == x[0], x[1]).otherwise(c), _NUMBERS.items(), F.lower(one))
            made = F.struct(F.lit(kind).alias("kind"), other.alias("target"), F.array(n).alias("args"))
        elif kind in _SYMMETRIC:
            both = F.array_sort(F.concat(F.array(one), codes))
            made = F.struct(F.lit(kind).alias("kind"), both[0].alias("target"), F.slice(both, 2, 1).alias("args"))
        else:
            made = F.struct(F.lit(kind).alias("kind"), one.alias("target"), (F.array_sort(codes) if any_order else codes).alias("args"))
        out = F.when(text.rlike(pattern), made.cast(FORMULA)).otherwise(out)
    return out


def normal_form(text: Column) -> Column:
    """The formula as JSON; null for other texts."""
    return F.to_json(formula(text))


def condition(kind: str, target: str, args: list[str]) -> str:
    """The Spark SQL condition that a formula puts on a row with a column for each code. What is not given (null) breaks
    only rules that ask for it."""
    c = lambda code: f"`{code}`"
    t, rest = c(target), [c(a) for a in args]
    if kind == "sum":
        return f"{t} IS NULL OR {t} = " + " + ".join(f"coalesce({x}, 0)" for x in rest)
    if kind == "product":
        return f"coalesce({t} = {' * '.join(rest)}, true)"
    if kind == "dependency":
        return f"{t} IS NULL OR {rest[0]} IS NOT NULL"
    if kind == "exclusive":
        return f"{t} IS NULL OR {rest[0]} IS NULL"
    if kind == "equal":
        return f"coalesce({t} = {rest[0]}, true)"
    if kind == "presence":
        return f"{t} IS NOT NULL"
    if kind == "decimals":
        return f"coalesce({t} = round({t}, {args[0]}), true)"
    raise ValueError(f"unknown kind {kind}")


#: Rules of a catalog that become conditions of one plan.
MOST_RULES = 2000


def compiled(rules: DataFrame) -> list[tuple[str, str]]:
    """(rule_code, condition) of the rules (rule_code, expression_text) that are formulas, by code; of texts of one code
    that with the smallest form. More than MOST_RULES of them are an error: a catalog has some hundreds."""
    forms = rules.select("rule_code", normal_form(F.col("expression_text")).alias("form")).where("form IS NOT NULL").groupBy("rule_code").agg(F.min("form").alias("form"))
    found = forms.orderBy("rule_code").limit(MOST_RULES + 1).collect()
    if len(found) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    return [(r["rule_code"], condition(f["kind"], f["target"], f["args"])) for r in found for f in (json.loads(r["form"]),)]


def violations(invoices: DataFrame, rules: list[tuple[str, str]], key: str) -> DataFrame:
    """(key, rule_code): the rules that each invoice breaks, in one pass over the invoices. Rules on codes that invoices
    have no column for are an error of the plan."""
    broken = F.array_compact(F.array(*[F.when(~F.expr(c), F.lit(code)) for code, c in rules])) if rules else F.array().cast("array<string>")
    return invoices.select(key, F.explode(broken).alias("rule_code"))


def formula_changes(published: DataFrame, candidate: DataFrame) -> DataFrame:
    """(rule_code, change_type, risk_level): rules added (medium) or removed (high), whose formula has changed (high) or
    only the words of it (low). Texts that are no formulas are compared as texts.

    published, candidate: rule_code, expression_text.
    """
    side = lambda df, p: df.select("rule_code", F.col("expression_text").alias(f"{p}_text"), F.coalesce(normal_form(F.col("expression_text")), F.col("expression_text")).alias(f"{p}_form"))
    both = side(published, "old").join(side(candidate, "new"), "rule_code", "full_outer")
    kind = F.when(F.col("old_form").isNull(), "added").when(F.col("new_form").isNull(), "removed").when(F.col("old_form") != F.col("new_form"), "formula_changed").when(F.col("old_text") != F.col("new_text"), "wording_changed")
    found = both.select("rule_code", kind.alias("change_type")).where("change_type IS NOT NULL")
    return found.withColumn("risk_level", F.when(F.col("change_type") == "wording_changed", "low").when(F.col("change_type") == "added", "medium").otherwise("high"))

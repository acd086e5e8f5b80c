"""Parser profiles and structural quality of extracted catalogs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexledger.operators.folds import canonical_header  # noqa: F401  (a profile's aliases name columns)
from lexledger.operators.versions import first_of


def routed(docs: DataFrame, profiles: list[tuple[str, list[str], list[str]]]) -> DataFrame:
    """(doc_id, profile_id, score): the profile with most hits in a document's name and text; none without a hit.

    profiles: (id, name hints, text hints), a short list that becomes part of the plan.
    """
    hits = lambda column, hints: F.size(F.filter(F.array(*map(F.lit, hints)), lambda h: F.contains(F.lower(column), F.lower(h)))) if hints else F.lit(0)
    scored = docs.select("doc_id", F.explode(F.array(*[F.struct(F.lit(p).alias("profile_id"), (3 * hits(F.col("name"), names) + hits(F.col("text"), texts)).alias("score")) for p, names, texts in profiles])).alias("s")).select("doc_id", "s.*")
    return first_of(scored.where("score > 0"), ["doc_id"], F.desc("score"), F.col("profile_id"))


def quality_metrics(fields: DataFrame) -> DataFrame:
    """One row of ratios over all records."""
    share = lambda test: F.coalesce(F.avg(test.cast("double")), F.lit(0.0))
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return fields.agg(
        F.count("*").alias("record_count"), share(empty("field_name")).alias("empty_name_ratio"), share(empty("description")).alias("empty_description_ratio"),
        share(F.col("field_code").rlike("^(HR-)?BG-")).alias("group_id_ratio"), share(F.coalesce(F.col("field_name").rlike(r"\.{5,}"), F.lit(False))).alias("leader_dots_name_ratio"),
        share(F.coalesce(F.col("invoice_path").rlike("^(HR-)?BR-"), F.lit(False))).alias("report_path_rule_ratio"), share(~(empty("invoice_path") & empty("credit_note_path"))).alias("path_coverage_ratio"),
    )


def diagnostics(fields: DataFrame) -> DataFrame:
    """(diagnostic, records): structural faults that occur."""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    tests = {
        "field_name_toc_noise": F.coalesce(F.col("field_name").rlike(r"\.{5,}"), F.lit(False)),
        "group_ids_emitted_as_fields": F.col("field_code").rlike("^(HR-)?BG-"),
        "rule_ids_used_as_report_path": F.coalesce(F.col("invoice_path").rlike("^(HR-)?BR-"), F.lit(False)),
        "missing_paths": empty("invoice_path") & empty("credit_note_path"),
        "missing_names": empty("field_name"),
        "missing_descriptions": empty("description"),
    }
    counted = fields.agg(F.when(F.count("*") == 0, 1).otherwise(0).cast("long").alias("missing_output"), *[F.count_if(v).alias(k) for k, v in tests.items()])
    return counted.select(F.expr("stack(7, " + ", ".join(f"'{k}', {k}" for k in ("missing_output", *tests)) + ") AS (diagnostic, records)")).where("records > 0")


def replaced_paths(c, rules: list[tuple[str, str]]):
    """Ordered literal replacements of a profile."""
    return reduce(lambda x, r: F.replace(x, F.lit(r[0]), F.lit(r[1])), rules, c)


#: Columns that a table of fields may have.
HEADER_KEYS = ("field_id", "business_term", "description", "note_on_use", "data_type", "cardinality", "invoice_path", "credit_note_path", "remark")


def block_score(block, signals: dict[str, int]):
    """Sum of the weights of a profile's signals: contains:<text> for each occurrence, first_line_regex:<pattern>,
    line_startswith_path."""
    score = F.lit(0)
    for name, weight in signals.items():
        kind, _, what = name.partition(":")
        if kind == "contains":
            score = score + weight * (F.size(F.split(block, rf"\Q{what}\E")) - 1)
        elif kind == "first_line_regex":
            score = score + F.when(F.substring_index(block, "\n", 1).rlike(what), weight).otherwise(0)
        elif kind == "line_startswith_path":
            score = score + F.when(F.exists(F.split(block, "\n"), lambda x: x.rlike("^(/Invoice|/invoice|/CreditNote)")), weight).otherwise(0)
        else:
            raise ValueError(f"unknown signal {name}")
    return score


def rule_constraints(text, rules: list[dict], names: tuple[str, ...] = ("min_char_length", "max_char_length", "min_decimal_scale", "max_decimal_scale", "format_hint")):
    """Ordered regex rules of a profile: ``set`` overwrites, ``set_if_empty`` fills in."""
    out = {n: F.lit("") for n in names}
    for rule in rules:
        hit = text.rlike(rule["regex"])
        for n, v in rule.get("set", {}).items():
            out[n] = F.when(hit, v).otherwise(out[n])
        for n, v in rule.get("set_if_empty", {}).items():
            out[n] = F.when(hit & (out[n] == ""), v).otherwise(out[n])
    return out


def repair_outcome(before: DataFrame, after: DataFrame, target: str) -> DataFrame:
    """One row: does a repaired profile fix its target without new issues? before, after: code, field_code, severity."""
    counts = lambda df, name: df.agg(F.count("*").alias(f"{name}_issues"), F.count_if(F.col("code") == target).alias(f"{name}_target"), F.count_if(F.col("severity") == "error").alias(f"{name}_errors"))
    both = counts(before, "old").crossJoin(F.broadcast(counts(after, "new")))  # a row each
    return both.withColumn("accepted", (F.col("new_target") < F.col("old_target")) & (F.col("new_issues") <= F.col("old_issues")) & (F.col("new_errors") <= F.col("old_errors")))


def generated_checks(fields: DataFrame) -> DataFrame:
    """(field_code, predicate): Spark SQL conditions that invoices must meet, from cardinalities and constraints."""
    c = F.concat(F.lit("`"), F.col("field_code"), F.lit("`"))
    tests = F.array_compact(
        F.array(
            F.when(F.col("occurrence_min") > 0, F.concat(c, F.lit(" IS NOT NULL"))),
            F.when(F.col("max_char_length").isNotNull(), F.concat(F.lit("coalesce(length("), c, F.lit("), 0) <= "), F.col("max_char_length").cast("string"))),
            F.when(F.col("min_char_length").isNotNull(), F.concat(F.lit("coalesce(length("), c, F.lit(") >= "), F.col("min_char_length").cast("string"), F.lit(", true)"))),
            F.when(F.col("max_decimal_scale").isNotNull(), F.concat(F.lit("coalesce(length(substring_index("), c, F.lit(", '.', -1)) <= "), F.col("max_decimal_scale").cast("string"), F.lit(" OR NOT contains("), c, F.lit(", '.'), true)"))),
        )
    )
    return fields.select("field_code", F.explode(tests).alias("predicate"))


def _entry_hash(path: Column, value: Column) -> Column:
    """60 bits of what a profile holds at a path; 0 for nothing."""
    return F.when(value.isNull(), F.lit(0).cast("bigint")).otherwise(F.conv(F.substring(F.md5(F.concat_ws("=", path, value)), 1, 15), 16, 10).cast("bigint"))


def patch_effects(patches: DataFrame) -> DataFrame:
    """(profile_id, ord, path, value, content_hash, effective): what every patch makes of its profile.

    patches: profile_id, ord, path, value; value is JSON, null (or no JSON) removes the path. Values are compared as
    VARIANTs, so that their spelling does not matter. A profile's content is known by the exclusive or of the hashes of
    what it holds, which a patch changes by what it puts in and what it takes out, so no content is put together for a
    patch. ``effective``: whether the content differs from that before; patches without effect make no version.
    Patches of a profile apply in the order of ``ord`` (then path and value).
    """
    value = F.to_json(F.try_parse_json("value"))
    order = ("ord", "path", "value")
    given = patches.select("profile_id", "ord", "path", value.alias("value"))
    before = F.lag("value").over(Window.partitionBy("profile_id", "path").orderBy(*order))
    change = given.withColumn("_change", _entry_hash(F.col("path"), F.col("value")).bitwiseXOR(_entry_hash(F.col("path"), before)))
    upto = Window.partitionBy("profile_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return change.withColumn("content_hash", F.bit_xor("_change").over(upto)).withColumn("effective", F.col("_change") != 0).drop("_change")


def profile_versions(patches: DataFrame) -> DataFrame:
    """(profile_id, content_hash, first_ord, uses): the versions of each profile. A version is a content, so one that
    comes back is the version that it was; uses: how many effective patches led to it."""
    found = patch_effects(patches).where("effective")
    return found.groupBy("profile_id", "content_hash").agg(F.min("ord").alias("first_ord"), F.count("*").alias("uses"))


def current_profiles(patches: DataFrame) -> DataFrame:
    """(profile_id, config): what each profile holds after all patches, as a VARIANT object by path; profiles that hold
    nothing are empty objects."""
    value = F.to_json(F.try_parse_json("value"))
    last = patches.groupBy("profile_id", "path").agg(F.max(F.struct("ord", F.coalesce(value, F.lit("")).alias("v")))["v"].alias("v"))
    quoted = F.concat(F.to_json(F.array("path")).substr(F.lit(2), F.length(F.to_json(F.array("path"))) - 2), F.lit(":"), F.col("v"))
    per = last.groupBy("profile_id").agg(F.array_sort(F.collect_list(F.when(F.col("v") != "", quoted))).alias("entries"))
    return per.select("profile_id", F.parse_json(F.concat(F.lit("{"), F.array_join("entries", ","), F.lit("}"))).alias("config"))

"""Text functions as Spark columns. White space and digits follow Unicode, as (?U) asks Java to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Renamed data types, path corrections in their order, code-list references in their order.
TYPE_NAMES = (("At", "Code"), ("Unit price", "Unit price amount"))
PATH_CORRECTIONS = (("HRFISK20dana", "HRFISK20Data"), ("HRFISK20data", "HRFISK20Data"), ("/invoice/", "/Invoice/"), ("/creditnote/", "/CreditNote/"))
REFERENCES = ("UNTDID 1001", "UNTDID 2005", "UNTDID 5305", "UNTDID 5153", "UNTDID 7143", "ISO 4217", "ISO 3166-1", "ISO 11649:2009", "EACT", "HRTB-2", "HR-TB-2")
#: Fixed patterns of codes.
FIELD_ID = r"^(?:HR-)?BT-\d+$"
HEADING = r"^(?:HR-)?(?:BT|BG)-\d+\b"
RULE = r"^(?:HR-)?BR(?:-[A-Z]+)?-\d+\b"
ANY_HEADING = r"^(?:HR-)?(?:BT|BG|BR|TB)-\d+\b"
FIELD_REF = r"\b(?:HR-)?(?:BT|BG)-\d+\b"
REFERENCE_NAME = r"^(?:UNTDID|ISO|EACT|HR-TB-2|HRTB-2)"
#: Where an inferred name ends; the first of the list that occurs.
NAME_ENDS = (" Example of use", " Business Rule", " Description", " The ", " At ")
#: Rule classes with what their texts contain, in order.
RULE_CLASSES = (
    ("arithmetic", ("sum of", "multiplied by")),
    ("exclusive", ("mutually exclusive", "must not both")),
    ("dependency", (" if ",)),
    ("equality", ("equal to",)),
    ("presence", ("must contain", "must have", "must be provided")),
    ("code_list", ("code list", "list are used", "values from table")),
    ("format", ("format", "decimal places", "whitespace characters")),
)


def or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def squash(c: Column) -> Column:
    """Runs of white space become one blank; none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


#: What (?U)\s matches: Unicode's white space.
WHITE = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def stripped(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE))


def normal_type(c: Column) -> Column:
    named = squash(c)
    out = named
    for was, now in TYPE_NAMES:
        out = F.when(named == was, now).otherwise(out)
    return out


def clean_path(c: Column, corrections: tuple = PATH_CORRECTIONS) -> Column:
    out = F.regexp_replace(c, r"(?U)\s+", "")
    for was, now in corrections:
        out = F.replace(out, F.lit(was), F.lit(now))
    return out


def invoice_path(c: Column) -> Column:
    return F.regexp_extract(clean_path(c), r"(/Invoice/.*?)(?=/CreditNote/|$)", 1)


def credit_note_path(c: Column) -> Column:
    return F.regexp_extract(clean_path(c), r"(/CreditNote/.*)$", 1)


def path_tag(c: Column) -> Column:
    """The last element's name without its prefix; of a path to an attribute, its element's."""
    primary = F.coalesce(or_null(invoice_path(c)), credit_note_path(c))
    steps = F.split(primary, "/")
    step = F.when(path_attribute(c) != "", F.try_element_at(steps, F.lit(-2))).otherwise(F.try_element_at(steps, F.lit(-1)))
    return F.substring_index(F.coalesce(step, F.lit("")), ":", -1)


def path_attribute(c: Column) -> Column:
    primary = F.coalesce(or_null(invoice_path(c)), credit_note_path(c))
    return F.regexp_extract(primary, r"/@([A-Za-z0-9_:-]+)$", 1)


def classify_rule(c: Column) -> Column:
    low = F.lower(c)
    out = F.lit("other")
    for name, marks in reversed(RULE_CLASSES):
        test = F.lit(False)
        for m in marks:
            test = test | F.contains(low, F.lit(m))
        if name == "arithmetic":
            test = test | F.contains(c, F.lit("="))
        if name == "dependency":
            test = test | F.startswith(low, F.lit("if "))
        out = F.when(test, name).otherwise(out)
    return out


def rule_code(c: Column) -> Column:
    return F.regexp_extract(c, rf"({RULE})", 1)


def field_refs(c: Column) -> Column:
    """Referenced codes, sorted, each once."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(FIELD_REF), F.lit(0))))


def value_set_refs(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, ";"), stripped), lambda x: (x != "") & ~F.startswith(x, F.lit("Remark:")))


def interpretation(description: Column, note: Column, remark: Column) -> Column:
    return F.trim(F.concat_ws(" ", or_null(description), or_null(note), F.when(F.coalesce(remark, F.lit("")) != "", F.concat(F.lit("Remark: "), remark))))


def quote(*candidates: Column, length: int = 280) -> Column:
    """The first candidate with text, on one line, at most ``length`` characters."""
    return F.left(squash(F.coalesce(*map(or_null, candidates), F.lit(""))), F.lit(length))


def excerpt(text: Column, anchor: Column) -> Column:
    """Text around the anchor: 240 characters before, 620 after its end; without it the first 700."""
    flat = squash(text)
    at = F.instr(flat, anchor)
    start = F.greatest(at - 1 - 240, F.lit(0))
    end = F.least(at - 1 + F.length(anchor) + 620, F.length(flat))
    return F.when(at == 0, F.left(flat, F.lit(700))).otherwise(F.substring(flat, start + 1, end - start))


def matches_search(query: Column, *columns: Column) -> Column:
    """Case-insensitive search of a query in several columns joined by blanks."""
    return F.contains(F.lower(F.concat_ws(" ", *columns)), F.lower(F.trim(query)))


def lines(c: Column) -> Column:
    return F.split(c, "\n")


def headings(text: Column, most: int = 50) -> Column:
    return F.slice(F.filter(F.transform(lines(text), stripped), lambda x: x.rlike(ANY_HEADING)), 1, most)


def examples(text: Column, most: int = 20) -> Column:
    return F.slice(F.regexp_extract_all(text, F.lit(r"(?s)<[^>]+>.*?</[^>]+>"), F.lit(0)), 1, most)


def html_escaped(c: Column) -> Column:
    for was, now in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(was), F.lit(now))
    return c


def status_class(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9_-]", "-")


def truthy(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)).isin("1", "true", "on", "yes"), F.lit(False))


def entry_code(c: Column) -> Column:
    return F.trim(F.regexp_extract(c, r"^([^-–]+?)\s*[–-]\s*(.+)$", 1))


def entry_label(c: Column) -> Column:
    return F.trim(F.regexp_extract(c, r"^([^-–]+?)\s*[–-]\s*(.+)$", 2))


def is_reference_name(c: Column) -> Column:
    return c.rlike(REFERENCE_NAME)


def heading_name(block: Column, code: Column) -> Column:
    first = stripped(F.substring_index(block, "\n", 1))
    return F.when(F.startswith(first, F.concat(code, F.lit(" "))), squash(F.substring(first, F.length(code) + 2, F.length(first)))).otherwise("")


def inferred_name(c: Column) -> Column:
    flat = squash(c)
    cut = flat
    for mark in reversed(NAME_ENDS):
        cut = F.when(F.contains(flat, F.lit(mark)), F.trim(F.substring_index(flat, mark, 1))).otherwise(cut)
    return F.coalesce(or_null(F.btrim(F.left(cut, F.lit(120)), F.lit(" -:"))), c)


def _literal(c: Column) -> Column:
    return F.concat(F.lit(r"\Q"), c, F.lit(r"\E"))


def example_value(block: Column, path: Column) -> Column:
    """The sample value that a block shows for a path: its attribute, its element, or the first text in a tag."""
    shown = F.when(F.contains(block, F.lit("Example of use:")), F.substring(block, F.instr(block, F.lit("Example of use:")) + 15, F.length(block))).otherwise(block)
    shown = F.replace(F.regexp_replace(shown, r"(?m)^\d+$", ""), F.lit("…"), F.lit(""))
    tag, attribute = path_tag(path), path_attribute(path)
    name = F.concat(F.lit(r"(?:[A-Za-z0-9_]+:)?"), _literal(tag))
    by_attribute = F.when(attribute != "", stripped(F.call_function("regexp_extract", shown, F.concat(_literal(attribute), F.lit('="([^"]+)"')), F.lit(1))))
    by_tag = F.when(tag != "", squash(F.call_function("regexp_extract", shown, F.concat(F.lit("(?s)<"), name, F.lit(r"(?:\s[^>]*)?>\s*([^<\n]+?)\s*</"), name, F.lit(">")), F.lit(1))))
    any_text = F.try_element_at(F.filter(F.transform(F.regexp_extract_all(shown, F.lit(r">\s*([^<\n]+?)\s*<"), F.lit(1)), squash), lambda v: ~v.isin("", "...", "…")), F.lit(1))
    return F.coalesce(or_null(by_attribute), or_null(by_tag), any_text, F.lit(""))


def repaired_extension(path: Column, report: Column, sample: Column, block: Column) -> Column:
    """The last hrextac: token becomes the only hrextac: element of the block that holds the sample value."""
    found = F.array_distinct(F.regexp_extract_all(block, F.concat(F.lit(r"(?s)<\s*hrextac:([A-Za-z0-9]+)[^>]*>\s*"), _literal(sample), F.lit(r"\s*</\s*hrextac:\1\s*>")), F.lit(1)))
    usable = F.contains(report, F.lit("hrextac:")) & (F.coalesce(sample, F.lit("")) != "") & (F.size(found) == 1)
    fixed = F.regexp_replace(path, F.lit(r"hrextac:[^/]+$"), F.concat(F.lit("hrextac:"), F.element_at(found, 1)))
    return F.when(usable & path.rlike(r"hrextac:[^/]+$"), fixed).otherwise(path)


def value_set(note: Column, remark: Column, block: Column, data_type: Column) -> Column:
    """Known values of a field: booleans, references, listed values, remark; in this order, each once, joined by '; '."""
    text = F.concat_ws("\n", *map(or_null, (note, remark, block, data_type)))
    low = F.lower(text)
    known = [F.when(F.contains(low, F.lit("true | false")) | F.startswith(F.lower(data_type), F.lit("boolean")), F.lit("true|false"))]
    known += [F.when(F.contains(low, F.lit(r.lower())), F.lit(r)) for r in REFERENCES]
    listed = F.filter(F.transform(lines(block), stripped), lambda x: (x != "") & ~F.startswith(x, F.lit("<")) & ~x.rlike(RULE) & x.rlike(r"^[•\-]\s*|^\d{1,4}\s*[–-]\s*"))
    listed = F.transform(listed, lambda x: squash(F.regexp_replace(x, r"^[•\- ]+", "")))
    remarks = F.when(F.coalesce(remark, F.lit("")) != "", squash(F.concat(F.lit("Remark: "), remark)))
    every = F.array_compact(F.concat(F.array(*known), listed, F.array(remarks)))
    return F.array_join(F.array_distinct(F.filter(every, lambda x: x != "")), "; ")


def response_json(c: Column) -> Column:
    """A model's answer without its code fence."""
    return F.trim(F.regexp_replace(F.regexp_replace(stripped(c), r"^```(?:json)?\s*", ""), r"\s*```$", ""))


def _string_at(v: Column, path: str) -> Column:
    """What a VARIANT holds at a path if that is a string."""
    found = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(v, path, "string"))


def response_text(content: Column) -> Column:
    """A model's answer as one text. content: VARIANT; a string, or a list of parts: strings, objects with a text, or of
    type text with a content. Parts of other kinds and empty ones are left out, the rest joined by line ends; anything
    else is taken as its JSON."""
    kind = lambda p: F.when(_string_at(p, "$.type") == "text", _string_at(p, "$.content"))
    part = lambda p: F.coalesce(_string_at(p, "$"), _string_at(p, "$.text"), kind(p), F.lit(""))
    parts = F.filter(F.transform(F.try_variant_get(content, "$", "array<variant>"), part), lambda x: x != "")
    return F.coalesce(_string_at(content, "$"), F.array_join(parts, "\n"), F.to_json(content))


def field_updates(content: Column, schema: str) -> Column:
    """The updates of a model's answer (see response_text), an array of ``schema``: what stands under field_updates, or
    else under updates. Null if the answer is no JSON or has neither."""
    answer = F.try_parse_json(response_json(response_text(content)))
    at = lambda name: F.try_variant_get(answer, f"$.{name}", f"array<{schema}>")
    has = F.try_variant_get(answer, "$.field_updates", "variant").isNotNull()
    return F.when(has, at("field_updates")).otherwise(at("updates"))

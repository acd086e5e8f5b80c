"""Ordered folds over rows and lines: continuation rows, blocks of lines, rules and path fragments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexledger.functions import text as t
from lexledger.operators.lineage import dealt, settled

_CELLS = ("c0", "c1", "c2", "c3", "c4", "c5")
_SKIPPED = ("UBL Invoice Path", "UBL CreditNote Path (Approval)")


def canonical_header(c: Column, aliases: dict[str, list[str]]) -> Column:
    """The column that a header cell names, by a profile's aliases; null for others."""
    pairs = [x for key, names in aliases.items() for n in names for x in (F.lit(n.lower()), F.lit(key))]
    return F.try_element_at(F.create_map(*pairs), F.lower(F.trim(c))) if pairs else F.lit(None).cast("string")


def continuation_groups(rows: DataFrame, keys: list[str], order: list[str], opens: Column) -> DataFrame:
    """rows plus ``record``: how many opening rows come up to each row within its keys; 0 before the first."""
    return rows.withColumn("record", F.sum(opens.cast("int")).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


#: Rows of a table, or lines, that are scanned together are those that agree in all but so many low bits of their number.
SEGMENT_BITS = 14


def scanned(rows: DataFrame, keys: list[str], segment: Column, order: list[str], opens: Column, name: str = "record") -> DataFrame:
    """continuation_groups() in two levels: rows are counted inside segments, and a segment starts from what those before
    it have counted, so that a long document is not one task.

    segment: a column whose order goes with the rows' order; only one row for each segment is gathered by keys.
    """
    cut = rows.withColumns({"_segment": segment, "_opens": F.coalesce(opens, F.lit(False)).cast("long")})
    counts = cut.groupBy(*keys, "_segment").agg(F.sum("_opens").alias("_n"))
    before = counts.select(*keys, "_segment", F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    own = F.sum("_opens").over(Window.partitionBy(*keys, "_segment").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return cut.join(before, [*keys, "_segment"]).withColumn(name, F.col("_before") + own).drop("_segment", "_opens", "_before")


#: What the columns of table_records() are called in its header, in their order.
HEADER = ("ID", "Business term", "Description", "Note on use", "Type", "Card.")
#: Names of the same columns in other documents' headers, by the keys that profiles use for them.
ALIASES = {"field_id": ["ID"], "business_term": ["Business term"], "description": ["Description"], "note_on_use": ["Note on use"], "data_type": ["Type"], "cardinality": ["Card."]}


def by_header(rows: DataFrame, aliases: dict[str, list[str]] = ALIASES, doc: str = "doc", cells: tuple[str, ...] = _CELLS) -> DataFrame:
    """rows with the cells of each table in the order of table_records(), c0..c5, whatever their order and number in
    the document: a table's columns are named by the first of its first five rows that names a field id and a business
    term, in any of their aliases. Columns that it doesn't name are left out, those that are missing are empty. Tables
    without such a row stay as they are.

    aliases: names of a column by key, one for each of HEADER in their order; cells: the columns of rows.
    """
    place, keys = [doc, "page", "table_no"], list(aliases)
    named = F.transform(F.array(*[F.coalesce(c, F.lit("")) for c in cells]), lambda c: canonical_header(t.stripped(c), aliases))
    is_head = F.array_contains("_named", keys[0]) & F.array_contains("_named", keys[1])
    first = rows.select(*place, "row_no", named.alias("_named")).withColumn("_r", F.row_number().over(Window.partitionBy(*place).orderBy("row_no"))).where("_r <= 5")
    heads = first.where(is_head).groupBy(*place).agg(F.min_by("_named", "row_no").alias("_columns"))
    both = rows.withColumn("_named", named).join(heads, place, "left")
    every = F.array(*[F.coalesce(c, F.lit("")) for c in cells])

    def cell(k: int) -> Column:
        at = F.array_position("_columns", keys[k])
        found = F.when(is_head, F.lit(HEADER[k])).when(at > 0, F.element_at(every, at.cast("int"))).otherwise(F.lit(""))
        return F.when(F.col("_columns").isNull(), F.col(cells[k]) if k < len(cells) else F.lit("")).otherwise(found).alias(_CELLS[k])

    return both.select(*place, "row_no", *[cell(k) for k in range(len(HEADER))])


def table_records(rows: DataFrame, doc: str = "doc") -> DataFrame:
    """Field records of specification tables: a row with a field id opens a record, the rows after it continue it,
    over tables and pages.

    rows: doc, page, table_no, row_no, c0..c5; doc is not null. Only tables with a header (ID, Business term) in their
    first five rows count. Rows are made once and scanned table by table, long tables in segments; a record's rows are
    gathered.
    """
    # read twice below; settled, since conditions on cells would repeat what makes them
    cells = settled(rows.select(doc, "page", "table_no", "row_no", *[t.stripped(F.coalesce(c, F.lit(""))).alias(c) for c in _CELLS]))
    head = (F.col("c0") == "ID") & (F.col("c1") == "Business term")
    place = [doc, "page", "table_no"]
    # the first rows of each table are all that moves for this
    first = cells.select(*place, "row_no", head.alias("_head")).withColumn("_r", F.row_number().over(Window.partitionBy(*place).orderBy("row_no"))).where("_r <= 5")
    kept = cells.where(~head & ~F.col("c1").isin(*_SKIPPED) & (F.concat(*_CELLS) != "")).join(first.where("_head").select(*place).distinct(), place, "left_semi")
    segment = F.struct("page", "table_no", F.shiftright("row_no", SEGMENT_BITS).alias("part"))
    opened = scanned(kept, [doc], segment, ["page", "table_no", "row_no"], F.col("c0").rlike(t.FIELD_ID)).where("record > 0")
    opens, path = F.col("c0").rlike(t.FIELD_ID), ~F.col("c0").rlike(t.FIELD_ID) & F.startswith("c1", F.lit("/"))
    more = ~opens & ~path
    marked = opened.select("*", opens.alias("o"), path.alias("p"), F.struct("page", "table_no", "row_no").alias("at"), t.invoice_path(F.col("c1")).alias("ip"), t.credit_note_path(F.col("c1")).alias("cp"))

    def joined(cell: str, when: Column) -> Column:
        parts = F.array_sort(F.collect_list(F.when(when & (F.col(cell) != ""), F.struct("at", F.col(cell).alias("x")))))
        return t.squash(F.array_join(F.transform(parts, lambda s: s["x"]), " "))

    def latest(cell: str) -> Column:
        value = F.when(F.col("p") & (F.col(cell) != ""), F.struct("at", F.col(cell).alias("x")))
        return F.coalesce(F.max(value)["x"], F.lit(""))

    def earliest(cell: str) -> Column:
        value = F.when((F.col("o") | more) & (F.col(cell) != ""), F.struct("at", F.col(cell).alias("x")))
        return F.coalesce(F.min(value)["x"], F.lit(""))

    pages = F.transform(F.array_sort(F.collect_list(F.struct("at", "page"))), lambda s: s["page"])
    return marked.groupBy(doc, "record").agg(
        F.max(F.when(F.col("o"), F.col("c0"))).alias("field_code"), joined("c1", F.col("o") | more).alias("field_name"),
        joined("c2", F.col("o") | more).alias("description"), joined("c3", F.col("o") | more).alias("note"),
        t.normal_type(earliest("c4")).alias("data_type"), t.squash(earliest("c5")).alias("cardinality"),
        latest("ip").alias("invoice_path"), latest("cp").alias("credit_note_path"), joined("c5", F.col("p")).alias("remark"), pages.alias("pages"),
    )


def _count(c: Column, what: str) -> Column:
    return F.size(F.split(c, rf"\Q{what}\E")) - 1


def _any_line(block: Column, test) -> Column:
    return F.exists(t.lines(block), test)


def _is_path(x: Column) -> Column:
    return F.startswith(x, F.lit("/Invoice")) | F.startswith(x, F.lit("/invoice")) | F.startswith(x, F.lit("/CreditNote"))


_DOTS = r"\.{5,}"
#: Scores of a block as (counted phrases, points if any line is a path, points if its first line has leader dots,
#: whether a phrase counts once only). A phrase stands in one line, so a block's score is known from sums over its lines.
SCORES = {"detail": ({"Business Rule": 3, "Example of use:": 2}, -2, -3, False), "table": ({"Business Rule": -2, "Example of use:": 1}, 5, -3, True)}
_PHRASES = sorted({p for counted, *_ in SCORES.values() for p in counted})


def fallback_score(block: Column) -> Column:
    """How well a page's blocks describe a field that no table defines."""
    has = lambda *what: F.greatest(*[F.contains(block, F.lit(w)).cast("int") for w in what], F.lit(0))
    dots = F.substring_index(block, "\n", 1).rlike(r"\.{5,}").cast("int")
    return 5 * has("Example of use:") + 4 * has("Business Rule") + 4 * has("/Invoice/", "/CreditNote/") + 3 * has("<cbc:", "<cac:") - 6 * dots - 2 * (F.length(block) < 120).cast("int")


def _marked(lines: DataFrame, doc: str) -> DataFrame:
    """Lines, stripped, with what their blocks are told by: ``code``, ``opens``, ``key`` (what a run of headings of one
    code has in common; null for other lines), and what they add to a block's scores."""
    begins = lambda *what: reduce(Column.__or__, [F.startswith("line", F.lit(w)) for w in what])
    # patterns are tried where a cheap test doesn't rule them out
    code = F.when(begins("BT-", "BG-", "HR-B"), t.or_null(F.regexp_extract("line", rf"({t.HEADING})", 1)))
    # a heading without a blank after its code ends other codes' blocks and its own, but starts none
    marked = lines.select(doc, "line_no", t.stripped("line").alias("line")).withColumn("code", code).withColumn("opens", F.col("code").isNotNull() & F.startswith("line", F.concat("code", F.lit(" "))))
    key = F.when(F.col("code").isNotNull(), F.when(F.col("opens"), F.col("code")).otherwise(F.concat(F.lit("\x00"), F.col("line_no").cast("string"))))
    marked = marked.withColumns({"key": key, "body": ~(F.left("line", F.lit(1)).between("0", "9") & F.col("line").rlike(r"^\d+$")), "dots": F.col("opens") & F.col("line").rlike(_DOTS)})
    return marked.withColumns({f"n{k}": F.when(F.contains("line", F.lit(p)), _count(F.col("line"), p)).otherwise(0) for k, p in enumerate(_PHRASES)} | {"shows": _is_path(F.col("line")).cast("int")})


def _numbered(marked: DataFrame, doc: str, rows: int | None = None) -> DataFrame:
    """marked plus ``island`` and ``changed``: whether an island begins there. rows: how many there are, at most, if that
    is known."""
    marked = marked.withColumn("_segment", F.shiftright("line_no", SEGMENT_BITS))
    if rows is not None:
        marked = dealt(marked, rows, doc, "_segment")
    # the last key of each segment is carried over to those after it
    ends = marked.groupBy(doc, "_segment").agg(F.max_by("key", F.when(F.col("key").isNotNull(), F.col("line_no"))).alias("_last"))
    carried = ends.select(doc, "_segment", F.last("_last", ignorenulls=True).over(Window.partitionBy(doc).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    order = Window.partitionBy(doc, "_segment").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.last("key", ignorenulls=True).over(order), F.col("_carried"))
    changed = marked.join(carried, [doc, "_segment"]).withColumn("changed", F.col("key").isNotNull() & ~F.col("key").eqNullSafe(before)).drop("_carried")
    return scanned(changed, [doc], F.col("_segment"), ["line_no"], F.col("changed"), "island")


def islands(lines: DataFrame, doc: str = "doc") -> DataFrame:
    """(doc, line_no, line, code, opens, island): lines, stripped, with the run of headings of one code that they
    belong to. A block starts at a line that ``opens`` (it begins with a code and a blank) and ends where its island
    does, at the next heading of another code. lines: doc, line_no, line."""
    return _numbered(_marked(lines, doc), doc).select(doc, "line_no", "line", "code", "opens", "island")


def block_scores(cut: DataFrame, doc: str = "doc", rows: int | None = None) -> DataFrame:
    """(doc, island, code, start, detail, table): the scores of every block, from sums over the lines that follow its
    start, without any block being put together. cut: the numbered lines; those that add nothing may be missing. rows:
    how many there are, at most, if that is known."""
    # sums up to the end of the island, taken from there, since Spark sums a frame anew that shrinks from its start
    rest = Window.partitionBy(doc, "island").orderBy(F.desc("line_no")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = cut.where("island > 0")
    if rows is not None:
        known = dealt(known, rows, doc, "island")
    known = known.withColumns({f"n{k}": F.sum(f"n{k}").over(rest) for k in range(len(_PHRASES))} | {"shows": F.max("shows").over(rest)})

    def score(counted: dict[str, int], path: int, dots: int, once: bool) -> Column:
        total = F.when(F.col("shows") > 0, path).otherwise(0) + F.when(F.col("dots"), dots).otherwise(0)
        for k, p in enumerate(_PHRASES):
            total = total + counted[p] * (F.least(F.col(f"n{k}"), F.lit(1)) if once else F.col(f"n{k}"))
        return total.cast("int")

    return known.where("opens").select(doc, "island", "code", F.col("line_no").alias("start"), *[score(*how).alias(name) for name, how in SCORES.items()])


#: Lines that are looked up together when blocks are put together: those that agree in all but so many low bits.
CHUNK_BITS = 8


def best_blocks(lines: DataFrame, doc: str = "doc", codes: DataFrame | None = None) -> DataFrame:
    """(doc, code, kind, start, score, block): of each code the block with the highest score of each kind, the first of
    equals; digit-only lines are left out. codes: only these (doc, code) or (code) are wanted.

    Blocks are chosen by their scores, and only the chosen ones are put together: the work is linear in the lines,
    however many headings of a code follow each other. Lines are taken apart once and settled; what is numbered and
    summed are marks without text, of headings and of lines that count. Text moves once, to be cut into blocks chunk by
    chunk, and once more as the chunks of the chosen blocks. Each of these steps has tasks of a bounded number of rows.
    """
    marked = settled(_marked(lines, doc).where("line_no IS NOT NULL"))
    rows = marked.count()
    marks = marked.where("key IS NOT NULL OR shows > 0 OR " + " OR ".join(f"n{k} > 0" for k in range(len(_PHRASES))))
    cut = settled(_numbered(marks.drop("line", "body"), doc, rows).drop("key"))
    scored = dealt(block_scores(cut, doc, rows), rows, doc, "code")
    best = [F.max(F.struct(F.col(kind).alias("score"), (-F.col("start")).alias("first"), "island")).alias(kind) for kind in SCORES]
    per = scored.groupBy(doc, "code").agg(*best)
    if codes is not None:  # not before: all headings of a frequent code would meet in one task
        per = per.join(codes, [c for c in (doc, "code") if c in codes.columns], "left_semi")
    chosen = per.select(doc, "code", F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), f"{kind}.score", (-F.col(f"{kind}.first")).alias("start"), f"{kind}.island") for kind in SCORES])).alias("x")).select(doc, "code", "x.*")
    ends = cut.where("changed").select(doc, (F.col("island") - 1).alias("island"), F.col("line_no").alias("stop"))
    chosen = chosen.join(ends, [doc, "island"], "left").drop("island")

    chunk = F.shiftright("line_no", CHUNK_BITS).alias("_chunk")
    within = (F.col("_chunk") >= F.shiftright("start", CHUNK_BITS)) & (F.col("stop").isNull() | (F.col("_chunk") <= F.shiftright("stop", CHUNK_BITS)))
    places = chosen.join(marked.select(doc, chunk).distinct(), doc).where(within)
    body = dealt(marked.where("body").select(doc, chunk, "line_no", "line"), rows, doc, "_chunk")
    block = [doc, "code", "kind", "start", "score"]
    inside = body.join(places, [doc, "_chunk"]).where("line_no >= start AND (stop IS NULL OR line_no < stop)")
    parts = inside.groupBy(doc, "_chunk", *block[1:]).agg(_in_order("line_no", "line").alias("_part"))
    # dealt by what described() groups by as well
    return dealt(parts, rows, doc, "code").groupBy(*block).agg(_in_order("_chunk", "_part").alias("block"))


def _in_order(place: str, what: str) -> Column:
    """The strings of a group as lines, in order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(place, what))), lambda s: s[what]), "\n")


def described(lines: DataFrame, doc: str = "doc", codes: DataFrame | None = None) -> DataFrame:
    """(doc, code, detail, table_block): of each code the block that tells most and the one that shows its path."""
    of = lambda kind: F.trim(F.max(F.when(F.col("kind") == kind, F.col("block"))))
    return best_blocks(lines, doc, codes).groupBy(doc, "code").agg(of("detail").alias("detail"), of("table").alias("table_block"))


def rules_of(block: Column) -> Column:
    """Rule texts of a block, in order, each once: a state machine over its lines."""
    state = F.struct(F.lit("").alias("cur"), F.lit(False).alias("started"), F.lit(False).alias("done"), F.array().cast("array<string>").alias("out"))

    def put(s: Column) -> Column:
        return F.when(s["cur"] != "", F.concat(s["out"], F.array(t.squash(s["cur"])))).otherwise(s["out"])

    def to(cur: Column, started: Column, done: Column, out: Column) -> Column:
        return F.struct(cur.alias("cur"), started.alias("started"), done.alias("done"), out.alias("out"))

    def step(s: Column, line: Column) -> Column:
        none, yes = F.lit(""), F.lit(True)
        closes = F.rtrim(s["cur"]).endswith(".") & ~line.rlike(r"^[a-z(]")
        return (
            F.when(s["done"], s)
            .when((line == "") | line.isin("Business Rule", "Description"), to(none, s["started"], s["done"], put(s)))
            .when(line.rlike(t.HEADING) & ~s["started"], to(s["cur"], yes, s["done"], s["out"]))
            .when(line.rlike(t.HEADING) | F.startswith(line, F.lit("Example of use:")), to(none, s["started"], yes, put(s)))
            .when(line.rlike(t.RULE), to(line, s["started"], s["done"], put(s)))
            .when((s["cur"] != "") & ~F.startswith(line, F.lit("<")) & closes, to(none, s["started"], s["done"], put(s)))
            .when((s["cur"] != "") & ~F.startswith(line, F.lit("<")), to(F.concat(s["cur"], F.lit(" "), line), s["started"], s["done"], s["out"]))
            .otherwise(s)
        )

    return F.array_distinct(F.aggregate(F.transform(t.lines(block), t.stripped), state, step, put))


def path_text(block: Column) -> Column:
    """The path lines of a block with the fragments that continue them, joined."""
    state = F.struct(F.lit("").alias("cur"), F.lit("").alias("out"))

    def to(cur: Column, out: Column) -> Column:
        return F.struct(cur.alias("cur"), out.alias("out"))

    def step(s: Column, line: Column) -> Column:
        goes_on = (s["cur"] != "") & (line != "") & ~line.isin("Business Rule", "Description", "Example of use:") & ~line.rlike(t.HEADING) & ~line.rlike(t.RULE)
        goes_on = goes_on & ~F.contains(line, F.lit(" ")) & ~line.rlike("^(<|ID|UBL|Remark|Table)")
        return F.when(_is_path(line), to(line, F.concat(s["out"], s["cur"]))).when(goes_on, to(F.concat(s["cur"], line), s["out"])).otherwise(to(F.lit(""), F.concat(s["out"], s["cur"])))

    return F.aggregate(F.transform(t.lines(block), t.stripped), state, step, lambda s: F.concat(s["out"], s["cur"]))

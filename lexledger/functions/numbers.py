"""Numbers, dates, JSON counters and arrays as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexledger.functions.text import or_null, stripped


def int_or_null(c: Column) -> Column:
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("int"))


def cardinality_min(c: Column) -> Column:
    text = stripped(c)
    return F.when(F.contains(text, F.lit("..")), int_or_null(F.substring_index(text, "..", 1)))


def cardinality_max(c: Column) -> Column:
    """Right of the first '..', as text; a number loses leading zeros."""
    text = stripped(c)
    right = F.substring(text, F.instr(text, F.lit("..")) + 2, F.length(text))
    return F.when(F.contains(text, F.lit("..")), or_null(F.coalesce(int_or_null(right).cast("string"), right)))


def cardinality_label(low: Column, high: Column) -> Column:
    return F.concat(F.coalesce(low.cast("string"), F.lit("")), F.when(low.isNotNull() | high.isNotNull(), "..").otherwise(""), F.coalesce(high, F.lit("")))


def bounds_reversed(low: Column, high: Column) -> Column:
    return F.coalesce(int_or_null(high) < low, F.lit(False))


def json_counter(doc: Column, key: str) -> Column:
    return F.coalesce(F.get_json_object(doc, f"$.{key}").try_cast("int"), F.lit(0))


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def iso_timestamp(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


def first_pages(pages: Column, most: int = 3) -> Column:
    """Sorted distinct pages, the first three; page 1 where there are none."""
    found = F.slice(F.array_sort(F.array_distinct(F.coalesce(pages, F.array().cast("array<int>")))), 1, most)
    return F.when(F.size(found) == 0, F.array(F.lit(1))).otherwise(found)


def appended(have: Column, more: Column) -> Column:
    """``have`` as it is, then what ``more`` adds to it: stripped, not empty, each once."""
    clean = F.array_distinct(F.filter(F.transform(more, stripped), lambda x: x != ""))
    return F.concat(have, F.array_except(clean, have))


#: Fixed patterns of length and scale hints, case-insensitive.
MAXIMUM = r"(?i)maximum of (\d+) characters"
LAST_DIGITS = r"(?i)last (\d+) to (\d+) digits"
DATE_FORMAT = r"(?i)format\s+yyyy[-/]mm[-/]dd"
TIME_FORMAT = r"(?i)format\s+hh:mm:ss"
TWO_DECIMALS = r"(?i)(written to|rounded to)\s+(2|two)\s+decimal places"
MULTIPLE_DECIMALS = r"(?i)multiple decimals"


def constraints(data_type: Column, text: Column) -> dict[str, Column]:
    """min_char_length, max_char_length, min_decimal_scale, max_decimal_scale (as text, '' unknown). Later hints
    overwrite or fill in as the order below says. The text is searched once for each hint: what follows from them reads
    a row of what was found."""
    hints = F.struct(
        data_type.alias("data_type"), F.regexp_extract(text, MAXIMUM, 1).alias("maximum"), F.regexp_extract(text, LAST_DIGITS, 1).alias("digits"), F.regexp_extract(text, LAST_DIGITS, 2).alias("last"),
        (text.rlike(DATE_FORMAT) | F.contains(text, F.lit("yyyy-MM-d.d"))).alias("date"), text.rlike(TIME_FORMAT).alias("time"), text.rlike(TWO_DECIMALS).alias("two"), text.rlike(MULTIPLE_DECIMALS).alias("several"),
    )
    limits = F.element_at(F.transform(F.array(hints), _limits), 1)
    return {name: limits[name] for name in ("min_char_length", "max_char_length", "min_decimal_scale", "max_decimal_scale")}


def _limits(found: Column) -> Column:
    """What follows from the hints that a text was found to hold."""
    data_type, low, high, scale_low, scale_high = found["data_type"], *[F.lit("")] * 4

    def fill(have: Column, when: Column, value: str) -> Column:
        return F.when(when & (have == ""), value).otherwise(have)

    high = F.when(found["maximum"] != "", found["maximum"]).otherwise(high)
    low = F.when(found["digits"] != "", found["digits"]).otherwise(low)
    high = F.when(found["digits"] != "", found["last"]).otherwise(high)
    low, high = fill(low, found["date"], "10"), fill(high, found["date"], "10")
    low, high = fill(low, found["time"], "8"), fill(high, found["time"], "8")
    scale_low, scale_high = F.when(found["two"], "2").otherwise(scale_low), F.when(found["two"], "2").otherwise(scale_high)
    scale_low, scale_high = F.when(found["several"], "").otherwise(scale_low), F.when(found["several"], "").otherwise(scale_high)
    for kind, a, b in ((data_type == "Date", "10", "10"), (data_type == "Time", "8", "8"), (F.startswith(data_type, F.lit("Boolean")), "4", "5")):
        open_ = kind & (high == "")
        low, high = F.when(open_, a).otherwise(low), F.when(open_, b).otherwise(high)
    scale_high = fill(scale_high, data_type == "Amount", "2")
    return F.struct(low.alias("min_char_length"), high.alias("max_char_length"), scale_low.alias("min_decimal_scale"), scale_high.alias("max_decimal_scale"))

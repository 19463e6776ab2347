"""Scalar cleaning as column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Text that stands for a missing value after a CSV round trip.
MISSING = ("nan", "None")
#: The characters that Unicode has as white space.
WHITE_SPACE = "\t\n\v\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd", "M/d/yyyy", "MMM yyyy", "MMM-yyyy", "d-MMM-yyyy", "yyyyMMdd")


def stripped(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.trim(c.cast("string"), F.lit(WHITE_SPACE))


def clean_key(c: Column, lower: bool = False) -> Column:
    """A text key: stripped, missing values empty, in lower case if asked."""
    text = F.coalesce(stripped(c), F.lit(""))
    text = F.when(text.isin(*MISSING), "").otherwise(text)
    return F.lower(text) if lower else text


def normalize_code(c: Column) -> Column:
    """A product code in upper case without spaces, one ITEM or PROD prefix and leading underscores."""
    text = F.replace(F.upper(stripped(c)), F.lit(" "), F.lit(""))
    return F.coalesce(F.regexp_replace(text, "^(ITEM|PROD)?_*", ""), F.lit(""))


def double_or_null(c: Column) -> Column:
    """A number, or null for text that is none and for NaN."""
    number = c.try_cast("double")
    return F.when(~F.isnan(number), number)


def zero_number(c: Column) -> Column:
    return F.coalesce(double_or_null(c), F.lit(0.0))


def currency_number(c: Column) -> Column:
    """A number that may be written with dollar signs and thousands commas; null for anything else."""
    text = stripped(c)
    return double_or_null(F.regexp_replace(F.when(~text.isin("", *MISSING), text), r"[$,]", ""))


def parse_month(c: Column) -> Column:
    """A date from date text, or from a serial day counted from 1899-12-30; null if it is neither.

    Digits alone (with or without a fraction) are serial days: a date parser would take them for years.
    """
    text = stripped(c)
    serial = F.date_add(F.lit("1899-12-30").cast("date"), F.floor(text.try_cast("double")).cast("int"))
    parsed = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in DATE_FORMATS])
    return F.when(text.rlike(r"^\d{1,6}(\.\d+)?$"), serial).otherwise(parsed)


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def split_list(c: Column, trim: bool = False) -> Column:
    """Values of a list field: split at the first of | ; and line feed that occurs. Blanks inside stay unless trim."""
    text = F.replace(c.cast("string"), F.lit("\r"), F.lit(""))
    text = stripped(text) if trim else text
    split = reduce(lambda rest, d: F.when(F.contains(text, F.lit(d)), F.split(text, "\\" + d if d == "|" else d)).otherwise(rest), ("\n", ";", "|"), F.array(text))
    values = F.transform(split, stripped) if trim else F.transform(split, lambda x: F.when(F.contains(x, F.lit("\n")), F.regexp_replace(x, "\n+$", "")).otherwise(x))
    return F.coalesce(F.filter(values, lambda x: x != ""), F.array().cast("array<string>"))


def whole_number(c: Column) -> Column:
    """Text of a number, cut to its whole part; null if it is none."""
    number = double_or_null(stripped(c))
    return F.when(F.abs(number) < 2**31, F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).cast("int"))


def order_struct(columns: tuple[str, ...]) -> Column:
    """The seven parts of a seasonal order; null unless all are numbers."""
    names = ("p", "d", "q", "seas_p", "seas_d", "seas_q", "s")
    parts = [whole_number(F.col(c)) for c in columns]
    complete = reduce(Column.__and__, [p.isNotNull() for p in parts])
    return F.when(complete, F.struct(*[p.alias(n) for p, n in zip(parts, names, strict=True)]))


def lag_map(c: Column) -> Column:
    """A lag specification, as 3 or default:2|EU:4, as a map from business unit to months; bad parts are left out."""

    def entry(part: Column) -> Column:
        both = F.split(part, ":", 2)
        named = F.size(both) == 2
        return F.struct(F.when(named, stripped(both[0])).otherwise("default").alias("key"), whole_number(F.when(named, both[1]).otherwise(part)).alias("value"))

    entries = F.filter(F.transform(split_list(c, trim=True), entry), lambda e: (e["key"] != "") & e["value"].isNotNull())
    # The last entry of a key counts.
    last = F.aggregate(entries, F.array().cast("array<struct<key:string,value:int>>"), lambda acc, e: F.concat(F.filter(acc, lambda x: x["key"] != e["key"]), F.array(e)))
    return F.map_from_entries(last)


def lag_for(lags: Column, bu: Column) -> Column:
    """Months of a lag map for a business unit: its own entry, else the default, else the nameless one, else 0."""
    return F.coalesce(F.try_element_at(lags, F.coalesce(stripped(bu), F.lit(""))), F.try_element_at(lags, F.lit("default")), F.try_element_at(lags, F.lit("")), F.lit(0))


def series_label(group: Column, bu: Column) -> Column:
    return F.when(F.coalesce(bu, F.lit("")) != "", F.concat_ws("__", group, bu)).otherwise(group)


def two_digits(c: Column) -> Column:
    """Half-even rounding for reports; values that are not finite are null."""
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(1e300)), F.bround(c, 2))


def clipped(c: Column, on: bool = True) -> Column:
    return F.greatest(c, F.lit(0.0)) if on else c

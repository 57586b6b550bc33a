"""Date/time scalars as ``Column -> Column`` functions (session time zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text patterns of the sources.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ssxxx"          # 2024-06-01T00:00:00+00:00
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"    # 2024-06-01T00:00:00.123000+00:00
DAY_MONTH_YEAR = "d MMM yyyy"                      # 01 Jun 2024 / 1 jun 2024
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
ZONE_HOURS = {"ut": 0, "utc": 0, "gmt": 0, "z": 0, "ast": -4, "adt": -3, "est": -5, "edt": -4, "cst": -6, "cdt": -5,
              "mst": -7, "mdt": -6, "pst": -8, "pdt": -7}
CENTURY_TURN = 69                                  # years of two digits from here on are of the 1900s

# A mail date after its comments are gone: weekday, day, month, year, hour, minute, second, offset, zone name.
_MAIL_DATE = (r"(?i)^(?:[a-z]+\s*,\s*|(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\s+)?(\d{1,2})(?:\s+|-)([a-z]+)\.?(?:\s+|-)(\d{2}|\d{4})"
              r"\s+(\d{1,2})[:.](\d{2})(?:[:.](\d{2}))?(?:\s*([+-]\d{4})|\s+([a-z]+))?$")
# The C library's order (Jun 1 12:00:00 2024) and a month before its day (Jun 1, 2024 12:00).
_CLOCK_FIRST = r"(?i)^((?:[a-z]+\s*,?\s+)?)([a-z]{3,9})\s+(\d{1,2})\s+(\d{1,2}:\d{2}(?::\d{2})?)\s+(\d{4})$"
_MONTH_FIRST = r"(?i)^((?:[a-z]+\s*,?\s+)?)([a-z]{3,9})\.?\s+(\d{1,2})\s*,?\s+(\d{2}|\d{4})\s+(?=\d{1,2}[:.])"


def ms_to_timestamp(ms: Column) -> Column:
    """Epoch milliseconds -> UTC timestamp (milliseconds kept)."""
    return F.timestamp_millis(ms)


def seconds_to_date(s: Column) -> Column:
    return F.to_date(F.timestamp_seconds(s))


def ms_to_date(ms: Column) -> Column:
    return F.to_date(F.timestamp_millis(ms))


def timestamp_to_ms(ts: Column) -> Column:
    return F.unix_millis(ts)


def iso_from_ms(ms: Column) -> Column:
    """Epoch ms -> ISO-8601 text with offset; a 6-digit fraction only when it is not zero."""
    ts = F.timestamp_millis(ms)
    return F.when(F.pmod(ms, F.lit(1000)) == 0, F.date_format(ts, ISO_SECONDS)) \
        .otherwise(F.date_format(ts, ISO_MICROS))


def iso_to_utc_date(text: Column) -> Column:
    """ISO timestamp (``Z`` or offset accepted) converted to UTC, then the date; null when bad."""
    return F.to_date(F.try_to_timestamp(text))


def iso_wall_date(text: Column) -> Column:
    """Wall-clock date of an ISO timestamp (zone replaced, not converted); null when not a timestamp."""
    return F.when(F.try_to_timestamp(text).isNotNull(), F.try_to_date(F.substring(text, 1, 10)))


def leading_date(text: Column) -> Column:
    """Date from the first ten characters; null when they are not a date."""
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def day_month_year(text: Column) -> Column:
    """Lenient ``d MMM yyyy`` (``1``/``01``, any case); null when bad."""
    return F.try_to_date(F.trim(text), DAY_MONTH_YEAR)


def without_comments(text: Column) -> Column:
    """``text`` with each parenthesised comment, nested ones included, as one space; a backslash
    quotes the character after it.  A comment that is not closed goes on to the end."""
    tokens = F.regexp_extract_all(text, F.lit(r"\\.|[()]|[^()\\]+|\\"), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("kept"))

    def step(state: Column, token: Column) -> Column:
        depth, kept = state["depth"], state["kept"]
        inside = F.greatest(depth + F.when(token == "(", 1).when(token == ")", -1).otherwise(0), F.lit(0))
        seen = F.when((depth == 0) & (token == "("), " ").when((depth == 0) & (token != ")"), token).otherwise("")
        return F.struct(inside.alias("depth"), F.concat(kept, seen).alias("kept"))

    return F.when(F.contains(text, F.lit("(")), F.aggregate(tokens, start, step, lambda s: s["kept"])).otherwise(text)


def _lookup(table: dict[str, int], key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for entry in table.items() for x in entry)), key)


def mail_date(text: Column) -> Column:
    """The timestamp of an RFC-822 date and its common relatives; null when it is none.

    Comments go, the weekday is optional and not compared with the date, months may be written out and
    seconds left out.  Years of two digits are 1969 to 2068.  Zones are offsets under a day or names of
    ``ZONE_HOURS`` (whatever the season); another name, or none, is UTC.
    """
    tidy = F.trim(F.regexp_replace(without_comments(text), r"\s+", " "))
    tidy = F.regexp_replace(F.regexp_replace(tidy, _CLOCK_FIRST, "$1$3 $2 $5 $4"), _MONTH_FIRST, "$1$3 $2 $4 ")
    parts = F.when(tidy.rlike(_MAIL_DATE), F.split(F.lower(F.regexp_replace(tidy, _MAIL_DATE, "$1|$2|$3|$4|$5|$6|$7|$8")), "[|]"))
    months = {name: k for k, month in enumerate(MONTHS, 1) for name in (month, month[:3])}

    def build(p: Column) -> Column:
        number = lambda k: p[k].try_cast("int")
        year = number(2) + F.when(F.length(p[2]) == 4, 0).when(number(2) >= CENTURY_TURN, 1900).otherwise(2000)
        offset = F.coalesce(F.substring(p[6], 2, 2).try_cast("int") * 60 + F.substring(p[6], 4, 2).try_cast("int"), F.lit(0))
        offset = F.when(p[6].startswith("-"), -offset).when(p[6] != "", offset).otherwise(F.coalesce(_lookup(ZONE_HOURS, p[7]), F.lit(0)) * 60)
        second = F.when(p[5] == "", F.lit(0)).otherwise(number(5))
        local = F.try_make_timestamp(year, _lookup(months, p[1]), number(0), number(3), number(4), second.cast("decimal(16,6)"))
        return F.when((second < 60) & (F.abs(offset) < 24 * 60), local - F.make_dt_interval(mins=offset))

    return F.transform(F.array(parts), lambda p: F.when(p.isNotNull(), build(p)))[0]


def rfc822_timestamp(text: Column) -> Column:
    """RFC-822 date (see ``mail_date``), else ISO-8601, else null.  No zone = UTC."""
    iso = F.try_to_timestamp(F.regexp_replace(F.trim(text), "Z$", "+00:00"))
    return F.when(F.coalesce(F.length(F.trim(text)), F.lit(0)) > 0, F.coalesce(mail_date(text), iso))


def date_to_midnight(d: Column) -> Column:
    """Date -> midnight UTC timestamp."""
    return d.cast("timestamp")
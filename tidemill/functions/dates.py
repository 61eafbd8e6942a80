"""Date parsing and normalisation expressions (all JVM-side, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The strict month-first format of the cleaning step.
STRICT_FORMAT = "M/d/yyyy"


def parse_date(c: Column, fmt: str = STRICT_FORMAT) -> Column:
    """Fixed-format parse; anything that does not match (incl. 2-digit years) is NULL."""
    s = F.trim(c.cast("string"))
    ok = s.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$") if fmt == STRICT_FORMAT else F.lit(True)
    return F.when(ok, F.try_to_date(s, fmt))


# Accepted layouts of the multi-format normaliser, tried in this order
# after '.' and '-' separators are rewritten to '/': month first, then day first,
# then year first.
NORMALIZE_FORMATS = ["M/d/yyyy", "d/M/yyyy", "yyyy/M/d"]
TWO_DIGIT_YEAR_FORMATS = ["M/d/yy", "d/M/yy"]


# Layouts with month names (after commas and points become spaces), and the compact one.
NAMED_FORMATS = ["MMM d yyyy", "MMMM d yyyy", "d MMM yyyy", "d MMMM yyyy", "yyyy MMM d", "yyyy MMMM d"]
COMPACT_FORMAT = "yyyyMMdd"

# date, time of day, optional am/pm, optional offset from UTC
_WITH_TIME = (r"^(.*\d)(?:[ T]|, )(\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?)(?: ?([AaPp])\.?[Mm]\.?)?"
              r" ?(Z|UTC|GMT|[+-]\d{2}(?::?\d{2})?)?$")
_DAY = 86_400_000_000


def _time_part(c: Column, group: int) -> Column:
    return F.regexp_extract(F.trim(c.cast("string")), _WITH_TIME, group)


def time_of_day(c: Column) -> Column:
    """Microseconds after midnight of a text's time part as it is written (12-hour times with
    AM or PM too); NULL without one."""
    part, half = _time_part(c, 2), F.lower(_time_part(c, 3))
    hms = F.split(part, ":")

    def number(i):
        return F.coalesce(F.try_element_at(hms, F.lit(i)).try_cast("decimal(12,6)"), F.lit(0))
    hour = F.when(half == "", number(1)).when(number(1).between(1, 12), number(1) % 12 + F.when(half == "p", 12).otherwise(0))
    return F.when(part != "", ((hour * 3600 + number(2) * 60 + number(3)) * 1_000_000).cast("bigint"))


def utc_offset(c: Column) -> Column:
    """Microseconds that a text's written offset lies ahead of UTC; 0 without one."""
    zone = _time_part(c, 4)
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    digits = F.regexp_replace(zone, "[^0-9]", "")
    hours = F.coalesce(F.substring(digits, 1, 2).try_cast("int"), F.lit(0))
    minutes = F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))
    return (sign * (hours * 3600 + minutes * 60)).cast("bigint") * 1_000_000


def normalize_date(c: Column, fmt: str | None = None) -> Column:
    """Multi-format date normaliser: the day as written.

    Typed dates pass through.  Text is trimmed, a time part is dropped (``normalize_timestamp``
    reads it), separators ``.``/``-`` become ``/``; then month-first, day-first and year-first
    layouts are tried; 2-digit years come after them, then month names in English (short or full)
    and the compact layout.  A value none of them accepts is NULL.  ``fmt`` (a Spark pattern)
    replaces all of that.
    """
    if fmt:
        return F.try_to_timestamp(c.cast("string"), F.lit(fmt)).cast("date")
    text = F.regexp_replace(F.trim(c.cast("string")), _WITH_TIME, "$1")
    s = F.regexp_replace(text, r"[.\-]", "/")
    four = s.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$") | s.rlike(r"^\d{4}/\d{1,2}/\d{1,2}$")
    two = s.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$")
    tries = [F.when(four, F.try_to_date(s, f)) for f in NORMALIZE_FORMATS]
    short = F.coalesce(*[F.when(two, F.try_to_date(s, f)) for f in TWO_DIGIT_YEAR_FORMATS])
    # two-digit years pivot like POSIX strptime: 00-68 -> 20xx, 69-99 -> 19xx
    tries.append(F.when(F.year(short) >= 2069, F.add_months(short, -1200)).otherwise(short))
    words = F.initcap(F.trim(F.regexp_replace(F.regexp_replace(text, r"(?<=\d)(st|nd|rd|th)\b", ""), r"[\s,./\-]+", " ")))
    named = words.rlike(r"^([A-Z][a-z]{2,8} \d{1,2} \d{4}|\d{1,2} [A-Z][a-z]{2,8} \d{4}|\d{4} [A-Z][a-z]{2,8} \d{1,2})$")
    tries += [F.when(named, F.try_to_date(words, f)) for f in NAMED_FORMATS]
    tries.append(F.when(text.rlike(r"^(1[6-9]|2[0-2])\d{6}$"), F.try_to_date(text, COMPACT_FORMAT)))
    return F.coalesce(*tries)


def normalize_timestamp(c: Column, fmt: str | None = None) -> Column:
    """``normalize_date`` with the time of day: a timestamp, whose written offset (if any) is taken
    off, so it is UTC; midnight without a time.  A time that does not exist gives NULL."""
    if fmt:
        return F.try_to_timestamp(c.cast("string"), F.lit(fmt))
    time = time_of_day(c)
    micros = F.unix_date(normalize_date(c)).cast("bigint") * _DAY + F.coalesce(time, F.lit(0)) - utc_offset(c)
    return F.when((_time_part(c, 2) == "") | (time < _DAY), F.timestamp_micros(micros))


def normalize_date_sql(c: str) -> str:
    """The same rules in DuckDB SQL (oracle side)."""
    s = (f"regexp_replace(regexp_replace(trim(CAST({c} AS VARCHAR)), "
         f"'^(\\S+)[ T]\\d{{1,2}}:\\d{{2}}(:\\d{{2}}(\\.\\d+)?)?Z?$', '\\1'), '[.\\-]', '/', 'g')")
    four = f"(regexp_full_match({s}, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') OR regexp_full_match({s}, '\\d{{4}}/\\d{{1,2}}/\\d{{1,2}}'))"
    two = f"regexp_full_match({s}, '\\d{{1,2}}/\\d{{1,2}}/\\d{{2}}')"
    fmts = {"M/d/yyyy": "%m/%d/%Y", "d/M/yyyy": "%d/%m/%Y", "yyyy/M/d": "%Y/%m/%d",
            "M/d/yy": "%m/%d/%y", "d/M/yy": "%d/%m/%y"}
    parts = [f"CASE WHEN {four} THEN CAST(try_strptime({s}, '{fmts[f]}') AS DATE) END" for f in NORMALIZE_FORMATS]
    parts += [f"CASE WHEN {two} THEN CAST(try_strptime({s}, '{fmts[f]}') AS DATE) END" for f in TWO_DIGIT_YEAR_FORMATS]
    return f"COALESCE({', '.join(parts)})"

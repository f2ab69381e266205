"""Time stamps and durations.

Log stamps carry no zone, so they are TIMESTAMP_NTZ throughout. Durations are
whole microseconds (bigint): exact to add up and cheap to aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sorterlog.functions.fields import as_column, drop_quotes, strip

MICROS = 1_000_000


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a time stamp with or without zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, as_column(ts).cast("timestamp_ntz"))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", as_column(start), as_column(end)) / F.lit(float(MICROS))


_STAMP_PARTS = r"(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)(\d{1,6})\z"
_ISO = r"$1-$2-$3 $4:$5:$6.$7"


def parse_stamp(c: Column | str) -> Column:
    """'yymmddHHMMSS' plus 1 to 6 fraction digits; anything else is null. Years from 69 on are 19xx."""
    digits = F.regexp_extract(as_column(c), r"\A[0-9]{13,18}\z", 0)
    old = F.regexp_replace(digits, r"\A(?=69|[7-9])" + _STAMP_PARTS, "19" + _ISO)
    return F.regexp_replace(old, r"\A" + _STAMP_PARTS, "20" + _ISO).try_cast("timestamp_ntz")


def parse_stamp_without_blanks(c: Column | str) -> Column:
    """Stamp after removal of blanks."""
    return parse_stamp(F.replace(as_column(c), F.lit(" "), F.lit("")))


def parse_stamp_parts(c: Column | str) -> Column:
    """Stamp in three blank-separated parts; null when a part is missing."""
    parts = F.split(as_column(c), " ")
    return parse_stamp(F.concat(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.get(parts, F.lit(2))))


def parse_stamp_lenient(c: Column | str) -> Column:
    """Stamp whose missing digits count as zeros: 'yymmdd HHMMSS mmm'.

    The text is filled to 15 characters on the right, its parts to 6, 6 and 3.
    """
    text = strip(c)
    filled = F.when(F.length(text) < 15, F.rpad(text, 15, "0")).otherwise(text)
    parts = F.split(filled, r"\s+")

    def part(i: int, width: int) -> Column:
        return F.rpad(F.coalesce(F.get(parts, F.lit(i)), F.lit("0")), width, "0")

    digits = F.regexp_extract(F.concat(part(0, 6), part(1, 6), part(2, 3)), r"\A[0-9]{15}\z", 0)
    # The century is always 20xx here, also for years from 69 on.
    return F.regexp_replace(digits, r"\A" + _STAMP_PARTS, "20" + _ISO).try_cast("timestamp_ntz")


def time_label(start: Column | str, end: Column | str) -> Column:
    """'HHMM-HHMMAM' label of a window."""
    start, end = as_column(start), as_column(end)
    return F.concat(
        F.date_format(start, "HHmm"), F.lit("-"), F.date_format(end, "HHmm"),
        F.when(F.hour(end) < 12, F.lit("AM")).otherwise(F.lit("PM")),
    )


_CLOCK = r"[+-]?[0-9]+:[0-9]{1,2}:[0-9]{1,2}(?:\.[0-9]{1,9})?"
_DURATION = rf"\A(?:-?[0-9]+ days?,? ?)?(?:{_CLOCK})?\z"


def clean_duration(c: Column | str) -> Column:
    """Remove the spreadsheet guard (=" and quotes) around a duration."""
    return drop_quotes(F.replace(as_column(c), F.lit('="'), F.lit("")))


def parse_duration(c: Column | str, strict: bool = False) -> Column:
    """'H:MM:SS[.f]' or 'N days HH:MM:SS' to microseconds.

    Null and empty texts are null. Unreadable texts are null too, or fail the
    job with `strict`.
    """
    text = strip(c)
    clock = F.regexp_substr(text, F.lit(rf"{_CLOCK}$"))
    days = F.when(text.contains("day"), F.substring_index(text, " ", 1).try_cast("bigint"))
    sign = F.when(clock.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    units = F.split(F.btrim(clock, F.lit("+-")), ":")
    whole = (F.get(units, F.lit(0)).try_cast("bigint") * 60 + F.get(units, F.lit(1)).try_cast("bigint")) * (60 * MICROS)
    fraction = (F.get(units, F.lit(2)).try_cast("decimal(18,9)") * MICROS).cast("bigint")
    value = F.coalesce(days, F.lit(0)) * (24 * 3600 * MICROS) + F.coalesce(sign * (whole + fraction), F.lit(0))
    readable = text.rlike(_DURATION) & (text != "")
    bad = F.raise_error(F.concat(F.lit("unreadable duration: "), text)).cast("bigint") if strict else F.lit(None).cast("bigint")
    return F.when(text.isNull() | text.isin("", "NaT"), F.lit(None).cast("bigint")).when(readable, value).otherwise(bad)


def format_duration(us: Column | str) -> Column:
    """Microseconds as 'HH:MM:SS', cut to whole seconds, hours unbounded, null as ''."""
    us = as_column(us).cast("double")
    total = F.when(us < 0, F.ceil(us / MICROS)).otherwise(F.floor(us / MICROS)).cast("bigint")
    second = F.pmod(total, F.lit(60))
    minute = F.pmod((total - second) / 60, F.lit(60)).cast("bigint")
    hour = ((total - F.pmod(total, F.lit(3600))) / 3600).cast("bigint")
    return F.when(us.isNull(), F.lit("")).otherwise(F.format_string("%02d:%02d:%02d", hour, minute, second))

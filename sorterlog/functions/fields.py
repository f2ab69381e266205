"""Scalar expressions for single text fields. All are native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv

# All characters that count as whitespace in text, beyond ASCII too.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scrub(c: Column | str) -> Column:
    """Remove every double quote and every whitespace character."""
    return F.translate(as_column(c), '"' + WHITESPACE, "")


def drop_quotes(c: Column | str) -> Column:
    """Remove double quotes only; whitespace stays."""
    return F.replace(as_column(c), F.lit('"'), F.lit(""))


def strip(c: Column | str) -> Column:
    """Trim all whitespace (not only blanks) from both ends."""
    return F.btrim(as_column(c), F.lit(WHITESPACE))


def strip_and_unquote(c: Column | str) -> Column:
    """Trim whitespace, then double quotes, from both ends."""
    return F.btrim(strip(c), F.lit('"'))


def blank_to_null(c: Column | str) -> Column:
    """Texts that stand for a missing value become null."""
    c = as_column(c)
    return F.when(~c.isin(fv.NA_TEXTS), c)


def to_int(c: Column | str) -> Column:
    """Text to bigint; integral decimals such as '5.0' count, anything else is null."""
    c = as_column(c).cast("string")
    number = c.try_cast("double")
    return F.coalesce(
        c.try_cast("bigint"),
        F.when(number == F.floor(number), number.try_cast("bigint")),
    )


def to_double(c: Column | str) -> Column:
    return as_column(c).try_cast("double")


def zero_pad(c: Column | str, width: int = 4) -> Column:
    """Integer id as text, padded with zeros to `width`; longer ids stay whole."""
    n = to_int(c)
    return F.when(n.isNotNull(), F.format_string(f"%0{width}d", n))


def device_id(part: Column | str, pattern: str) -> Column:
    """First match of a device pattern in a part name, null when there is none."""
    return F.regexp_substr(as_column(part), F.lit(pattern))


def carrier_number(part: Column | str) -> Column:
    """Digits after 'CA' as text, null when the part is no carrier."""
    digits = F.regexp_extract(as_column(part), "CA([0-9]+)", 1)
    return F.when(digits != "", digits)


def part_unit(part: Column | str) -> Column:
    """Part name without the plant prefix and without everything from '+' on."""
    return F.substring_index(F.replace(as_column(part), F.lit(fv.PART_PREFIX), F.lit("")), "+", 1)


def destination_label(own: Column | str, customer: Column | str) -> Column:
    """'own - customer', or own name alone where the customer name is missing."""
    own, customer = as_column(own), as_column(customer)
    return F.when(customer.isNotNull(), F.concat(own, F.lit(" - "), customer)).otherwise(own)


def is_no_read(barcode: Column | str) -> Column:
    """Barcode made of question marks only; null counts as False."""
    return F.coalesce(as_column(barcode).rlike(rf"\A(?:{fv.NO_READ_BARCODE})\z"), F.lit(False))


def is_multi_read(barcode: Column | str) -> Column:
    """Barcode made of nines only; null counts as False."""
    return F.coalesce(as_column(barcode).rlike(rf"\A(?:{fv.MULTI_READ_BARCODE})\z"), F.lit(False))


def contains(c: Column | str, text: str) -> Column:
    """Case-sensitive substring test; null counts as False."""
    return F.coalesce(as_column(c).contains(text), F.lit(False))


def normalised(c: Column | str) -> Column:
    return F.lower(strip(c))


def percent(part: Column, whole: Column, places: int) -> Column:
    """Share in percent, rounded half-even; null when there is no whole."""
    return F.bround(F.try_divide(part.cast("double"), whole.cast("double")) * 100, places)


def sort_reason(code: Column | str) -> Column:
    """Sort code to reason; unknown codes and null give null."""
    return _lookup(fv.SORT_REASONS, as_column(code).cast("int"))


def defect_category(reason: Column | str) -> Column:
    """Sort reason to defect category; reasons that are no defect give null."""
    return _lookup(fv.DEFECT_CATEGORIES, as_column(reason))


def induction_name(number: Column | str) -> Column:
    """Induction number to name; unknown and missing numbers share one label."""
    return F.coalesce(_lookup(fv.INDUCTION_NAMES, to_int(number).cast("int")), F.lit(fv.NO_INDUCTION_NAME))


def _lookup(table: dict, key: Column) -> Column:
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)

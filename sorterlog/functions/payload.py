"""Framed key:value payloads, '->{k:v,k:[a,b]}<', as native array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv
from sorterlog.functions.fields import as_column, strip

# An integer in list notation: no leading zeros, optional sign.
_INT = r"\s*[+-]?(?:0+|[1-9][0-9]*)\s*"
_INT_LIST = rf"^\[(?:{_INT}(?:,{_INT})*,?)?\s*\]$"
_QUOTED = r"\s*'[^']*'\s*"
_QUOTED_LIST = rf"^\[{_QUOTED}(?:,{_QUOTED})*,?\s*\]$"


def strip_frame(raw: Column | str) -> Column:
    """Remove a leading '->{' and a trailing '}<', each only where present."""
    start, end = rf"\A\Q{fv.FRAME_START}\E", rf"\Q{fv.FRAME_END}\E\z"
    return F.regexp_replace(F.regexp_replace(as_column(raw), start, ""), end, "")


# Every bracket is closed before the next one opens.
_FLAT = r"\A[^\[\]]*+(?:\[[^\[\]]*+\][^\[\]]*+)*+\z"
# A piece of such a text and the comma behind it; every character is looked at once.
_PIECE = r"((?:[^,\[\]]++|\[[^\[\]]*+\])*+),"


def split_pairs(text: Column | str, trim: bool = True) -> Column:
    """Split at commas outside square brackets.

    Payloads whose brackets are flat and balanced, which is nearly all of
    them, split with one regular expression inside generated code. Others go
    through a fold over the comma pieces that tracks the bracket depth.
    Without `trim`, pieces keep surrounding blanks; scrubbed text has none.
    """
    text = as_column(text)
    # One comma at the very end closes the last piece and opens none.
    flat = F.regexp_extract_all(F.concat(F.regexp_replace(text, r",\z", ""), F.lit(",")), F.lit(_PIECE), 1)
    pieces = F.when(text.rlike(_FLAT), flat).otherwise(_depth_split(text))
    pieces = F.transform(pieces, strip) if trim else pieces
    return F.when(text == "", F.array().cast("array<string>")).otherwise(pieces)


def _depth_split(text: Column) -> Column:
    start = F.struct(
        F.array().cast("array<string>").alias("done"),
        F.lit(None).cast("string").alias("open"),
        F.lit(0).alias("depth"),
    )

    def opened(piece: Column) -> Column:
        return F.length(piece) - F.length(F.replace(piece, F.lit("["), F.lit("")))

    def closed(piece: Column) -> Column:
        return F.length(piece) - F.length(F.replace(piece, F.lit("]"), F.lit("")))

    def step(acc: Column, piece: Column) -> Column:
        ends = acc["open"].isNotNull() & (acc["depth"] == 0)
        return F.struct(
            F.when(ends, F.array_append(acc["done"], acc["open"])).otherwise(acc["done"]).alias("done"),
            F.when(acc["open"].isNull() | (acc["depth"] == 0), piece)
            .otherwise(F.concat(acc["open"], F.lit(","), piece)).alias("open"),
            (acc["depth"] + opened(piece) - closed(piece)).alias("depth"),
        )

    def finish(acc: Column) -> Column:
        return F.when(acc["open"] == "", acc["done"]).otherwise(F.array_append(acc["done"], acc["open"]))

    return F.aggregate(F.split(text, ",", -1), start, step, finish)


def key_value_pieces(pieces: Column | str) -> Column:
    """Pieces with a colon, last piece first."""
    return F.filter(F.reverse(as_column(pieces)), lambda p: F.instr(p, ":") > 0)


def keys_of(pieces: Column | str, trim: bool = True) -> Column:
    """Text before the first colon of each piece."""
    return F.transform(as_column(pieces), lambda p: _trimmed(F.substring_index(p, ":", 1), trim))


def values_of(pieces: Column | str, trim: bool = True) -> Column:
    """Text after the first colon of each piece."""
    return F.transform(as_column(pieces), lambda p: _trimmed(F.substr(p, F.instr(p, ":") + 1), trim))


def labels_of(pieces: Column | str, trim: bool = True) -> Column:
    """Key of each piece with its colon, empty for pieces without a colon; places are those of the pieces."""

    def label(p: Column) -> Column:
        if not trim:
            return F.substr(p, F.lit(1), F.instr(p, ":"))
        return F.when(F.instr(p, ":") > 0, F.concat(strip(F.substring_index(p, ":", 1)), F.lit(":"))).otherwise(F.lit(""))

    return F.transform(as_column(pieces), label)


def labelled_value(labels: Column | str, pieces: Column | str, key: str, trim: bool = True) -> Column:
    """Value of one key from pieces in reverse order and their `labels_of`; a missing key is null."""
    # A missing key has position 0, and place -1 reads as null.
    piece = F.get(as_column(pieces), F.array_position(as_column(labels), F.lit(f"{key}:")).cast("int") - 1)
    return _trimmed(F.substr(piece, F.instr(piece, ":") + 1), trim)


def _trimmed(text: Column, trim: bool) -> Column:
    return strip(text) if trim else text


def value_of(keys: Column | str, values: Column | str, key: str) -> Column:
    """Value of one key; the last pair of a repeated key wins, a missing key is null."""
    # A missing key has position 0, and place -1 reads as null.
    return F.get(as_column(values), F.array_position(as_column(keys), F.lit(key)).cast("int") - 1)


def is_list(value: Column | str) -> Column:
    value = as_column(value)
    return value.startswith("[") & value.endswith("]")


def _items(value: Column) -> Column:
    """Pieces between the brackets; one trailing comma is allowed, '[]' has none."""
    body = F.regexp_replace(F.btrim(value, F.lit("[]")), r"[\s,]+$", "")
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, ","))


def int_list(value: Column | str) -> Column:
    """List notation to array<bigint>.

    Unreadable lists are empty; quoted words and values that are no list keep
    their place as null, so the length stays that of the list.
    """
    value = as_column(value)
    nulls = lambda _: F.lit(None).cast("bigint")
    return (
        F.when(~is_list(value) | value.isNull(), F.array(F.lit(None).cast("bigint")))
        .when(value.rlike(_INT_LIST), F.regexp_extract_all(value, F.lit("([+-]?[0-9]+)")).try_cast("array<bigint>"))
        .when(value.rlike(_QUOTED_LIST), F.transform(_items(value), nulls))
        .otherwise(F.array().cast("array<bigint>"))
    )


def text_list(value: Column | str) -> Column:
    """List notation to array<string>: quoted words or integers; a plain value is one element."""
    value = as_column(value)
    readable = value.rlike(_INT_LIST) | value.rlike(_QUOTED_LIST)
    return (
        F.when(~is_list(value) | value.isNull(), F.array(value))
        .when(readable, F.transform(_items(value), lambda x: F.btrim(strip(x), F.lit("'"))))
        .otherwise(F.array().cast("array<string>"))
    )


def first_text(value: Column | str) -> Column:
    """First list element as text; values that are no list stay as they are."""
    value = as_column(value)
    return F.when(is_list(value), strip(F.substring_index(F.btrim(value, F.lit("[]")), ",", 1))).otherwise(value)


def first_int(value: Column | str) -> Column:
    """First element of a readable integer list, else null."""
    value = as_column(value)
    first = F.regexp_extract(value, r"\A\[\s*([+-]?[0-9]+)", 1)
    return F.when(value.rlike(_INT_LIST) & (first != ""), first.try_cast("bigint"))


def first_literal(value: Column | str) -> Column:
    """First element as text: readable lists by element, '[]' unchanged, others textually."""
    value = as_column(value)
    readable = F.get(text_list(value), F.lit(0))
    return (
        F.when(~is_list(value), value)
        .when(value.rlike(r"^\[\s*\]$"), value)
        .otherwise(F.coalesce(first_int(value).cast("string"), readable, first_text(value)))
    )


def repair_pairs(text: Column | str) -> Column:
    """Turn 'key , 123' into 'key:123' after a comma and at the start."""
    fixed = F.regexp_replace(as_column(text), fv.PAIR_AFTER_COMMA, ",$1:$2")
    return F.regexp_replace(fixed, fv.PAIR_AT_START, "$1:$2")


def padded_to_longest(lists: dict[str, tuple[Column, Column]]) -> dict[str, Column]:
    """Arrays padded to the length of the longest of them.

    `lists` maps a name to (array, filler). Places beyond an array's own end
    take the filler; null elements inside it stay null. When all are empty
    each becomes one null.
    """
    sizes = [F.size(a) for a, _ in lists.values()]
    n = F.greatest(*sizes) if len(sizes) > 1 else sizes[0]
    return {
        name: F.concat(a, F.array_repeat(F.when(n > 0, fill), F.greatest(n, F.lit(1)) - F.size(a)))
        for name, (a, fill) in lists.items()
    }

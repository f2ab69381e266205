"""From log records to typed messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv
from sorterlog.functions import payload as pl
from sorterlog.functions.clock import parse_stamp
from sorterlog.functions.fields import scrub as scrub_text
from sorterlog.functions.fields import strip, to_int
from sorterlog.operators.columns import drop_quotes_all, scrub_all
from sorterlog.operators.sizing import broadcast_if_small
from sorterlog.sources.logs import ORDER, split_fields
from sorterlog.sources.staging import stage

DROPPED = "_dropped"
LISTS = ["requestedDestMCID", "sortCode", "requestedDestStatus"]


def records_of(logs: DataFrame, codes: str | Sequence[str] | None, scrub: bool = True) -> DataFrame:
    """Records of the given message codes with scrubbed fields and a typed time stamp.

    The code filter sits directly on the split fields, so only matching
    records are scrubbed and parsed further.
    """
    rows = logs
    if codes is not None:
        wanted = [codes] if isinstance(codes, str) else list(codes)
        rows = rows.where(scrub_text("messageCode").isin(wanted))
    rows = scrub_all(rows, fv.LOG_COLUMNS) if scrub else drop_quotes_all(rows)
    return rows.withColumn("timeStamp", parse_stamp("timeStamp")) if scrub else rows


def filter_counts(logs: DataFrame, code: str) -> DataFrame:
    """Records kept and dropped by a message code, one row."""
    kept = F.count_if(scrub_text("messageCode") == code)
    return logs.agg(kept.alias("kept"), (F.count(F.lit(1)) - kept).alias("dropped"))


def counted_records(lines: DataFrame, codes: str | Sequence[str], scrub: bool = True) -> tuple[DataFrame, dict[str, int]]:
    """Records of the given codes in a staged table, and counts of what the same pass read and left out.

    `lines` come from `read_lines`. Counted are `lines`, `blank` and `too_long` lines, `kept`
    and `dropped` records by code, and of the kept ones those with `bad_stamps`. The counts are
    gathered while the table is written, so the text is read once.
    """
    wanted = [codes] if isinstance(codes, str) else list(codes)
    n, scanned, chosen, stamped = F.lit(1), Observation("scan"), Observation("codes"), Observation("stamps")
    fields = F.size(F.split(F.replace("value", F.lit("\0"), F.lit("")), ";"))
    blank = (fields == 1) & (strip(F.replace("value", F.lit("\0"), F.lit(""))) == "")
    seen = lines.observe(scanned, F.count(n).alias("lines"), F.count_if(blank).alias("blank"), F.count_if(fields > len(fv.LOG_COLUMNS)).alias("too_long"))
    inside = F.coalesce(scrub_text("messageCode").isin(wanted), F.lit(False))
    records = split_fields(seen).observe(chosen, F.count_if(inside).alias("kept"), F.count_if(~inside).alias("dropped"))
    rows = records_of(records, codes, scrub)
    bad = F.col("timeStamp").isNull() if scrub else parse_stamp(F.replace("timeStamp", F.lit(" "), F.lit(""))).isNull()
    table = stage(rows.observe(stamped, F.count_if(bad).alias("bad_stamps")), "counted-records")
    return table, {**scanned.get, **chosen.get, **stamped.get}


def with_payload(records: DataFrame, keys: Sequence[str], raw: str = "rawMessage", repair: bool = False,
                 scrubbed: bool = True) -> DataFrame:
    """Replace the raw message by one string column per key.

    Keys are cut once per row; each key is then a position lookup, and only the piece found there is cut further.
    Keys that no later step uses are pruned by the optimizer. Text that is
    not `scrubbed` may hold blanks, which are trimmed around keys and values.
    """
    text = pl.strip_frame(raw)
    if repair:
        text = pl.repair_pairs(text)
    others = [c for c in records.columns if c != raw]
    return (
        records.select(*others, text.alias("_text"))
        .select(*others, F.reverse(pl.split_pairs("_text", trim=False)).alias("_pieces"))
        .select(*others, "_pieces", pl.labels_of("_pieces", not scrubbed).alias("_labels"))
        .select(*others, *[pl.labelled_value("_labels", "_pieces", k, not scrubbed).alias(k) for k in keys])
    )


def payload_keys(records: DataFrame, raw: str = "rawMessage") -> DataFrame:
    """All keys that occur in the payloads; use it to learn the keys of an unknown message."""
    pairs = pl.key_value_pieces(pl.split_pairs(pl.strip_frame(raw)))
    return records.select(F.explode(pl.keys_of(pairs)).alias("key")).distinct().orderBy("key")


def payload_profile(records: DataFrame, raw: str = "rawMessage", code: str = "messageCode") -> DataFrame:
    """What the payloads of each message code hold, for messages that are not known yet.

    One row per code, key and type of its values (`integer`, `decimal`, `list`,
    `empty`, `text`): how many messages have it, and their share of the code's messages.
    A key counts once per message, by its last value. One pass; what is shuffled is counts.
    """
    pairs = pl.key_value_pieces(pl.split_pairs(pl.strip_frame(raw)))
    cut = records.select(code, pairs.alias("_pairs")).select(code, pl.keys_of("_pairs").alias("_keys"), pl.values_of("_pairs").alias("_values"))
    entries = F.transform(F.array_distinct("_keys"), lambda k: F.struct(k.alias("key"), pl.value_of("_keys", "_values", k).alias("value")))
    message = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value")))  # stands for the message itself
    each = cut.select(code, F.explode(F.concat(message, F.coalesce(entries, F.slice(message, 1, 0)))).alias("_e")).select(code, "_e.*")
    value = F.col("value")
    kind = (
        F.when(F.col("key").isNull(), F.lit(None)).when(value.rlike(r"^-?[0-9]+$"), "integer").when(value.rlike(r"^-?[0-9]*\.[0-9]+$"), "decimal")
        .when(value.startswith("["), "list").when(value == "", "empty").otherwise("text")
    )
    counts = stage(each.groupBy(code, "key", kind.alias("type")).agg(F.count(F.lit(1)).alias("messages")), "payload-counts")
    totals = counts.where(F.col("key").isNull()).select(F.col(code).alias("_code"), F.col("messages").alias("_total"))
    shared = counts.where(F.col("key").isNotNull()).join(broadcast_if_small(totals), F.col(code).eqNullSafe(F.col("_code")))
    return shared.select(code, "key", "type", "messages", (F.col("messages") / F.col("_total")).alias("share"))


def explode_destinations(messages: DataFrame, mark: str | None = None) -> DataFrame:
    """One row per attempted destination.

    The three list fields are aligned to the longest (filler -1, 'Unused' for
    the status) and exploded in step. Rows in which any of them is the number
    -1 are dropped. Ids and codes are typed; what is no integer list is null
    there and stays readable in `<name>_raw`. `_ord` gains the list position.
    With `mark`, no row is dropped; those to drop are true in that column.
    """
    others = [c for c in messages.columns if c not in LISTS]
    minus = F.lit(-1).cast("bigint")
    statuses = F.when(pl.is_list("requestedDestStatus"), pl.text_list("requestedDestStatus")).otherwise(
        F.array(F.col("requestedDestStatus"))
    )
    named = [c for c in others if c != ORDER]
    base = [*named, *([ORDER] if ORDER in others else []), *[f"{c}_raw" for c in LISTS]]
    lists = messages.select(
        *others, *[F.col(c).alias(f"{c}_raw") for c in LISTS],
        pl.int_list("requestedDestMCID").alias("_mcids"), pl.int_list("sortCode").alias("_codes"),
        statuses.alias("_statuses"),
    )
    padded = pl.padded_to_longest({
        "requestedDestMCID": (F.col("_mcids"), minus),
        "sortCode": (F.col("_codes"), minus),
        "requestedDestStatus": (F.col("_statuses"), F.lit("Unused")),
    })
    zipped = lists.select(*base, *[c.alias(name) for name, c in padded.items()]).select(*base, F.arrays_zip(*LISTS).alias("_rows"))
    # The lists are never empty. The outer form keeps the optimizer from adding a
    # not-empty filter, which it would push down to the text with all the parsing in it.
    exploded = zipped.select(*base, F.posexplode_outer("_rows").alias("_place", "_row"))
    # A numeric -1 in the status list also drops the row; the text '-1' in quotes does not.
    numeric_status = (F.col("_row.requestedDestStatus") == "-1") & F.col("requestedDestStatus_raw").rlike(r"^\[[^'\"]*\]$")
    dropped = F.coalesce(F.col("_row.requestedDestMCID") == -1, F.lit(False)) \
        | F.coalesce(F.col("_row.sortCode") == -1, F.lit(False)) | F.coalesce(numeric_status, F.lit(False))
    order = [F.struct(F.col(f"{ORDER}.*"), F.col("_place").alias("place")).alias(ORDER)] if ORDER in others else []
    kept = exploded if mark else exploded.where(~dropped)
    return kept.select(
        *named, *[F.col(f"_row.{c}").alias(c) for c in LISTS], *[f"{c}_raw" for c in LISTS], *order,
        *([dropped.alias(mark)] if mark else []),
    )


def first_elements(messages: DataFrame, literal: bool = False) -> DataFrame:
    """First element of each list field; ids and codes become integers.

    With `literal`, only readable integer lists give an integer; text that
    merely looks like a number stays unmatched (null) as an id or code.
    """
    pick = pl.first_literal if literal else pl.first_text
    typed = {}
    for c in LISTS:
        typed[f"{c}_raw"] = pick(c)
    rows = messages.withColumns(typed)
    if literal:
        return rows.withColumns({
            "requestedDestMCID": pl.first_int("requestedDestMCID"), "sortCode": pl.first_int("sortCode"),
            "requestedDestStatus": F.col("requestedDestStatus_raw"),
        })
    return rows.withColumns({
        "requestedDestMCID": F.col("requestedDestMCID_raw"), "sortCode": to_int("sortCode_raw"),
        "requestedDestStatus": F.col("requestedDestStatus_raw"),
    })


def sort_report_messages(logs: DataFrame, keys: Sequence[str] = tuple(fv.SORT_REPORT_KEYS)) -> DataFrame:
    """Parsed sort reports, one row per message, list fields still as text."""
    return with_payload(records_of(logs, fv.SORT_REPORT_CODE), keys)


def staged_sort_reports(logs: DataFrame, columns: Sequence[str] | None = tuple(fv.SORT_REPORT_KEEP)) -> tuple[DataFrame, DataFrame]:
    """Sort reports parsed once into a staged table.

    Returns one row per message and one row per attempted destination, both
    reading the staged table. A message whose destinations are all dropped
    is still a message, so dropped rows are stored and marked.
    """
    marked = explode_destinations(sort_report_messages(logs), mark=DROPPED)
    if columns is not None:
        marked = marked.select(*columns, ORDER, DROPPED)
    table = stage(marked, "sort-reports")
    return table.where(F.col(f"{ORDER}.place") == 0), table.where(~F.col(DROPPED)).drop(DROPPED)

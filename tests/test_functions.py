"""Scalar expressions, one test per rule."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sorterlog.functions import clock, fields, payload
from sorterlog.plans.messages import with_payload


def test_scrub_and_quote_removal(one):
    assert one(['"a b"\t', None], fields.scrub("c")) == ["ab", None]
    assert one(['"a b"'], fields.drop_quotes("c")) == ["a b"]
    assert one([' "x" '], fields.strip_and_unquote("c")) == ["x"]
    assert one([" a b"], fields.scrub("c")) == ["ab"]


def test_frame_is_removed_only_where_present(one):
    assert one(["->{a:1}<", "->{a:1", "a:1}<", "a->{b}<c"], payload.strip_frame("c")) == ["a:1", "a:1", "a:1", "a->{b}<c"]


@pytest.mark.parametrize("text, pieces", [
    ("a:1,b:2", ["a:1", "b:2"]),
    ("c:[x,[y,z]]", ["c:[x,[y,z]]"]),
    ("c:[x,[y,z]],d:1", ["c:[x,[y,z]]", "d:1"]),
    ("a:1],b:2", ["a:1],b:2"]),
    ("a:[1,b:2", ["a:[1,b:2"]),
    ("a:1,,b:2,", ["a:1", "", "b:2"]),
    ("a,,", ["a", ""]),
    (",", [""]),
    ("", []),
    ("a:[1,2],b:[3],", ["a:[1,2]", "b:[3]"]),
    (" a : 1 , b ", ["a : 1", "b"]),
])
def test_split_outside_brackets(one, text, pieces):
    assert one([text], payload.split_pairs("c")) == [pieces]


def test_flat_and_nested_texts_split_alike(one):
    """The regular expression and the depth fold agree where both apply."""
    texts = ["a:1,b:[1,2],c:3", "x", "a:[],b:", "[a],[b]", "k:[1,2,3],l:[4],,m:"]
    assert one(texts, payload.split_pairs("c")) == one(texts, payload._depth_split(F.col("c")))


def test_long_payload_without_lists(one):
    text = ",".join(f"k{i}:{i}" for i in range(20_000))
    assert one([text], payload.split_pairs("c")) == [text.split(",")]


def test_null_payload_stays_null(one):
    assert one([None], payload.split_pairs("c")) == [None]


def pairs(text_column="c"):
    kept = payload.key_value_pieces(payload.split_pairs(text_column))
    return payload.keys_of(kept), payload.values_of(kept)


def test_last_pair_wins_and_first_colon_splits(one):
    k, v = pairs()
    texts = ["a:1,a:2", "a:12:30", "b:1", "a", "a :  x "]
    assert one(texts, payload.value_of(k, v, "a")) == ["2", "12:30", None, None, "x"]


@pytest.mark.parametrize("text, numbers", [
    ("[1,2]", [1, 2]), ("[-1, 0]", [-1, 0]), ("[1,2,]", [1, 2]), ("[]", []), ("[Used,FromAwcs]", []), ("[0159]", []),
    ("[1,,2]", []), ("[1.5]", []), ("['a','b']", [None, None]), ("5", [None]), (None, [None]), ("[000]", [0]),
])
def test_integer_lists(one, text, numbers):
    assert one([text], payload.int_list("c")) == [numbers]


def test_text_lists(one):
    texts = ["['a','b']", "[1,2]", "[Used,FromAwcs]", "Used", None]
    assert one(texts, payload.text_list("c")) == [["a", "b"], ["1", "2"], [], ["Used"], [None]]


def test_first_elements(one):
    texts = ["[159,76]", "[Used,FromAwcs]", "[]", "x", None, "[0159]"]
    assert one(texts, payload.first_text("c")) == ["159", "Used", "", "x", None, "0159"]
    assert one(texts, payload.first_literal("c")) == ["159", "Used", "[]", "x", None, "0159"]
    assert one(texts, payload.first_int("c")) == [159, None, None, None, None, None]


def test_repair_of_comma_pairs(one):
    texts = ["length , 12.5,width:3", "a:1, width , -4", "a:1,b:2"]
    assert one(texts, payload.repair_pairs("c")) == ["length:12.5,width:3", "a:1,width:-4", "a:1,b:2"]


def test_time_stamps(one):
    texts = ["250923153200123", "2509231532001", "bad", None, "251323153200123", "700101000000000"]
    assert one(texts, clock.parse_stamp("c")) == [
        datetime(2025, 9, 23, 15, 32, 0, 123000), datetime(2025, 9, 23, 15, 32, 0, 100000), None, None, None, datetime(1970, 1, 1),
    ]
    assert one(["250923 153200 123", "250923 153200"], clock.parse_stamp_parts("c")) == [datetime(2025, 9, 23, 15, 32, 0, 123000), None]
    assert one(["250923 153200 123"], clock.parse_stamp_without_blanks("c")) == [datetime(2025, 9, 23, 15, 32, 0, 123000)]


def test_lenient_time_stamps(one):
    texts = ["251119 084847 124", "251119 084847", "251119", "251119 0848 5", "259919 000000 000", None]
    got = one(texts, clock.parse_stamp_lenient("c"))
    assert got == [datetime(2025, 11, 19, 8, 48, 47, 124000), datetime(2025, 11, 19, 8, 48, 47),
                   datetime(2025, 11, 19), datetime(2025, 11, 19, 8, 48, 0, 500000), None, None]


def test_durations(one):
    texts = ['="00:01:02"', "1 days 02:03:04", "100:00:00", "", None, "0:00:01.5", "1:02", "x"]
    us = clock.parse_duration(clock.clean_duration("c"))
    assert one(texts, us) == [62_000_000, 93_784_000_000, 360_000_000_000, None, None, 1_500_000, None, None]
    assert one(texts, clock.format_duration(us)) == ["00:01:02", "26:03:04", "100:00:00", "", "", "00:00:01", "", ""]


def test_strict_durations_fail(one):
    with pytest.raises(Exception, match="unreadable duration"):
        one(["1:02"], clock.parse_duration("c", strict=True))


def test_device_and_part_names(one):
    assert one([" =CBS01.DBS008+S001-U01", "no device", None], fields.device_id("c", "DBS[0-9]+")) == ["DBS008", None, None]
    assert one(["=CBS01.CHU731+S001", "IU005"], fields.part_unit("c")) == ["CHU731", "IU005"]
    assert one(["CA12", "CA0007x", "none", None], fields.zero_pad(fields.carrier_number("c"))) == ["0012", "0007", None, None]


def test_ids_are_padded_but_never_cut(one):
    assert one(["7", "7.0", "12345", "x", None], fields.zero_pad("c")) == ["0007", "0007", "12345", None, None]


def test_barcode_classes(one):
    texts = ["???", "?a", "999", "99a", "", None, "?\n"]
    assert one(texts, fields.is_no_read("c")) == [True, False, False, False, False, False, False]
    assert one(texts, fields.is_multi_read("c")) == [False, False, True, False, False, False, False]


def test_codes_and_inductions(one):
    code = F.col("c").try_cast("bigint")
    assert one(["0", "11", "15", "99", None], fields.sort_reason(code)) == ["Success", "<reserved>", "<reserved>", None, None]
    assert one(["No_Read", "Gap_Error", "Success", None], fields.defect_category("c")) == ["Scan Defect", "MHE Defect", None, None]
    assert one(["0", "6", "101", "55", None], fields.induction_name("c")) == ["IU001", "IU007", "SPS002", "No Map Yet", "No Map Yet"]


def test_destination_label(spark):
    df = spark.createDataFrame([("CHU1", "A"), ("CHU2", None), (None, None)], "o string, a string")
    assert [r[0] for r in df.select(fields.destination_label("o", "a")).collect()] == ["CHU1 - A", "CHU2", None]


def test_missing_texts(one):
    assert one(["", "NA", "null", "x"], fields.blank_to_null("c")) == [None, None, None, "x"]


def test_scrub_removes_every_whitespace_character_without_a_regular_expression(spark, one):
    odd = [f'a{c}"b{c}' for c in fields.WHITESPACE] + ["", None, "​\U0001f600 x", '""']
    assert one(odd, fields.scrub("c")) == ["ab"] * len(fields.WHITESPACE) + ["", None, "​\U0001f600x", ""]
    plan = spark.range(1).select(fields.scrub(F.col("id").cast("string")))._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in plan


def test_payload_values_are_cut_only_for_wanted_keys(spark):
    texts = ["->{a:1,b:[x,y],a:2}<", "->{a,b:,c:d:e}<", "->{:z,a:}<", "", None, "->{ab:1,b :2, a : [1,a:9] }<", "->{b:1]x[,a:3}<"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, rawMessage string")
    for scrubbed, last in ((True, [None, None]), (False, ["[1,a:9]", "2"])):
        got = with_payload(df, ["a", "b"], scrubbed=scrubbed)
        found = [[r["a"], r["b"]] for r in got.orderBy("i").collect()]
        assert found == [["2", "[x,y]"], [None, ""], ["", None], [None, None], [None, None], last, ["3", "1]x["]]
    plan = with_payload(df, ["a", "b"])._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in plan and plan.count("transform(") == 1  # pieces are walked once for their keys

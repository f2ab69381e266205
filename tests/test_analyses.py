"""Whole analyses on rendered log files."""

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sorterlog.operators.fixes import EXPLANATION
from sorterlog.plans import alarm_reports, measurements, messages
from sorterlog.plans.destinations import bypass_spacing, s02_destinations
from sorterlog.plans.induction import induction_rate, single_line_rate
from sorterlog.plans.measurements import item_measurements
from sorterlog.plans.sort_report import s04_analysis, s04_barcode_analysis, s04_first_element_analysis
from sorterlog.sources.logs import ORDER, read_flat_export, read_log_monitor
from tests.conftest import rows

T0 = datetime(2025, 9, 23, 10, 0, 0)


def line(at, code, payload, seq=0):
    stamp = at if isinstance(at, str) else at.strftime("%y%m%d %H%M%S ") + f"{at.microsecond // 1000:03d}"
    return f'"{stamp}";"I";"SYS1";"10.0.0.1";"AWCS";"";"";"1";"MCC01";"{code}";"{seq:06d}";"->{{{payload}}}<"'


def sort_payload(item, index, barcode, mcids, codes, status="[Used]"):
    return (f"event:SORT,plcRecordNo:1,itemID:{item},indexNo:{index},locationAWCS:L1,barcodeAWCS:{barcode},actualDestMCID:1,"
            f"requestedDestMCID:{mcids},sortCode:{codes},requestedDestStatus:{status},comHost:h")


@pytest.fixture
def logs(spark, tmp_path):
    def write(lines, name="log.csv"):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        return read_log_monitor(spark, str(tmp_path / name))

    return write


@pytest.fixture
def mapping(spark):
    return spark.createDataFrame(
        [("159", "A-159", "CHU159", " JackPot ", 0), ("76", "A-76", "CHU076", None, 1), ("3005", "A-R", "CHU305", None, 2)],
        "IndexNo string, Amazon string, Beumer string, Jackpot string, _pos bigint")


SORT_LINES = [
    line(T0, 54177, sort_payload(1, "0007", "ABC", "[159,76]", "[5,0]", "[Used,FromAwcs]")),
    line(T0 + timedelta(minutes=1), 54177, sort_payload(2, "0008", "???", "[159,-1]", "[8,0]")),
    line(T0 + timedelta(minutes=2), 54177, sort_payload(3, "0007", "9999", "[76]", "[8]")),
    line(T0 + timedelta(minutes=3), 54177, sort_payload(3, "0009", "9999", "[3005]", "[0]")),
    line(T0 + timedelta(minutes=4), 54177, sort_payload(4, "0010", "XYZ", "[0159]", "[0]")),
    line(T0 + timedelta(minutes=5), 54163, sort_payload(5, "0011", "XYZ", "[159]", "[0]")),
    line(T0 + timedelta(minutes=6), 54177, sort_payload(6, "0012", "QQQ", "[159]", "[0]")),
    line(T0 + timedelta(minutes=50), 54177, sort_payload(7, "0013", "LATE", "[159]", "[0]")),
    line("bad", 54177, sort_payload(8, "0014", "NOTIME", "[159]", "[21]")),
]


@pytest.mark.parametrize("mcids, codes, status, expected", [
    ("[159,76]", "[5,0]", "[Used,FromAwcs]", [(159, 5, "Unused"), (76, 0, "Unused")]),
    ("[159,76]", "[0]", "[]", [(159, 0, "Unused")]),
    ("[159,-1]", "[0,0]", "[]", [(159, 0, "Unused")]),
    ("[0159]", "[0]", "[]", []),
    ("[]", "[]", "[]", [(None, None, None)]),
    ("159", "0", "Used", [(None, None, "Used")]),
    ("[159]", "[0]", "['Used']", [(159, 0, "Used")]),
    ("[159]", "[0]", "[-1]", []),
])
def test_list_payloads(logs, mcids, codes, status, expected):
    df = messages.explode_destinations(messages.sort_report_messages(logs([line(T0, 54177, sort_payload(1, "1", "B", mcids, codes, status))])))
    got = [tuple(r) for r in df.orderBy("_ord").select("requestedDestMCID", "sortCode", "requestedDestStatus").collect()]
    assert got == expected


def test_missing_list_key_is_one_null(logs):
    df = messages.explode_destinations(messages.sort_report_messages(logs([line(T0, 54177, "itemID:1,requestedDestMCID:[5,6],sortCode:[0,0]")])))
    assert rows(df.select("requestedDestMCID", "sortCode", "requestedDestStatus")) == [(5, 0, None), (6, 0, "Unused")]


def test_sort_report(logs, mapping):
    t = s04_analysis(logs(SORT_LINES), mapping)
    assert (t["start_ts"], t["end_ts"]) == (T0, T0 + timedelta(minutes=30))
    assert t["summary"].first().asDict() == {
        "S04_processed": 8, "package_processed": 4, "unique_packages": 4, "recirculation_packages": 1, "recirculation_records": 4}
    assert rows(t["scanner_metrics"]) == [("multi_read_packages", 1), ("no_read_packages", 1), ("normal_packages", 2), ("total_packages", 4)]
    assert rows(t["sort_counts"]) == [("Destination_Full", 1), ("No_Read", 2), ("Success", 1)]
    assert rows(t["reason_dest_summary"]) == [
        ("Destination_Full", "A-159", 1), ("No_Read", "A-159", 1), ("No_Read", "A-76", 1), ("Success", "A-159", 1)]
    pivot = {r["sortReason"]: (r["A-159"], r["A-76"]) for r in t["reason_dest_pivot"].collect()}
    assert pivot == {"Destination_Full": (1, 0), "No_Read": (1, 1), "Success": (1, 0)}
    assert rows(t["defect_metrics"]) == [("No Defect", 2, 50.0), ("Scan Defect", 2, 50.0)]
    assert rows(t["jackpot_metrics"]) == [("CHU159", "A-159", 1)] and t["jackpot_total"].first()[0] == 1
    assert t["scan_defects"].count() == 2 and t["window_data"].count() == 6


def test_full_window_keeps_rows_without_time(logs, mapping):
    t = s04_analysis(logs(SORT_LINES), mapping, full=True)
    assert t["summary"].first()["package_processed"] == 6
    assert "8_0" in {r[0] for r in t["window_data"].select("RealPackageID").collect()}


def test_correction_order(spark, logs, mapping):
    fixes = spark.createDataFrame([("7", "no label", 0), ("4444", "x", 1)], "id string, comment string, _pos bigint")
    lines = logs(SORT_LINES)
    late = s04_analysis(lines, mapping, fixes=fixes)
    early = s04_analysis(lines, mapping, fixes=fixes, relabel=True)
    assert rows(late["defect_metrics"]) == [("No Defect", 2, 50.0), ("Scan Defect", 2, 50.0)]
    assert rows(early["defect_metrics"]) == [("No Defect", 3, 75.0), ("Scan Defect", 1, 25.0)]
    fixed = late["window_data"].where(F.col(EXPLANATION) == "no label").first()
    assert fixed["sortCode"] == 0 and fixed["sortReason"] == "No_Read" and fixed["itemID"] == "3"
    assert late["scan_defects"].count() == 1
    assert rows(late["unapplied_ids"].select("id")) == [("4444",)]


def test_barcode_level_report(spark, logs, mapping):
    fixes = spark.createDataFrame([("7", "no label", 0)], "id string, comment string, _pos bigint")
    t = s04_barcode_analysis(logs(SORT_LINES), mapping, fixes=fixes, prune=True)
    assert t["scan_metrics"].first().asDict() == {"normal_packages": 2, "no_read_packages": 1, "multi_read_packages": 1, "total_packages": 4}
    assert rows(t["sort_counts"]) == [("Destination_Full", 1), ("No_Read", 1), ("Success", 4)]
    assert rows(t["defect_metrics"]) == [("No Defect", 5, 83.3333), ("Scan Defect", 1, 16.6667)]
    assert rows(t["target_success"]) == [(159, 1), (76, 2)]
    rep = t["barcode_repetition"].first()
    assert (rep["repeated_values"], rep["repeated_records"], rep["single_values"], rep["max_occurrences"]) == (2, 4, 2, 2)


def test_first_element_report(spark, logs):
    fixes = spark.createDataFrame([("8", "a", 0), ("8", "b", 1), ("77", "c", 2)], "id string, comment string, _pos bigint")
    lines = logs(SORT_LINES)
    t = s04_first_element_analysis(lines, fixes, T0, T0 + timedelta(minutes=10))
    assert rows(t["sort_counts"]) == [("Destination_Full", 1), ("No_Read", 1), ("Success", 5)]
    assert rows(t["outcomes"]) == [("No Defect", 6, 85.71), ("Scan Defect", 1, 14.29)]
    assert rows(t["defect_metrics"]) == [("Scan Defect", 1, 14.29)]
    assert rows(t["unapplied_ids"]) == [("0077",)]
    assert rows(t["scan_defect_codes"]) == [(8, 1)]
    noted = t["window_data"].where("indexNo = '0008'").first()
    assert noted["sortCode"] == 0 and noted[EXPLANATION] == "b"
    with pytest.raises(ValueError):
        s04_first_element_analysis(lines, start=T0 - timedelta(days=1))


def test_destination_requests(logs):
    lines = [line(T0 + timedelta(seconds=i), 54163, sort_payload(i, "1", b, m, "[0]"))
             for i, (b, m) in enumerate([("A", "[159,1]"), ("A", "[76]"), ("B", "159"), ("C", "[3005]"), ("B", "[1]")])]
    t = s02_destinations(logs(lines), prune=True)
    assert t["summary"].first().asDict() == {"total_processed": 3, "unique_packages": 3}
    assert rows(t["destination_counts"]) == [("159", 2), ("3005", 1)]
    assert rows(t["repeated_barcodes"]) == [("A", 2), ("B", 2)]


def test_bypass_spacing(spark, logs):
    dim = spark.createDataFrame([("1", "S01aa-S01ad", "X", None, 0), ("2", "other", "Y", None, 1)],
                                "IndexNo string, Amazon string, Beumer string, Jackpot string, _pos bigint")
    at = [0, 280, 560, 1500, 1500]
    lines = [line(T0 + timedelta(milliseconds=ms), 1, sort_payload(1, "1", "b", "[1]", "[0]")) for ms in at]
    lines += [line(T0, 1, sort_payload(1, "1", "b", "[2]", "[0]"))]
    t = bypass_spacing(logs(lines), dim)
    assert sorted(r["time_diff"] for r in t["distributions"].collect()) == [0.0, 0.28, 0.28, 0.94]
    s = t["stats"].first()
    assert (s["count"], s["min"], s["max"], s["median"]) == (4, 0.0, 0.94, 0.28) and s["mean"] == pytest.approx(0.375)
    assert [r["count"] for r in t["histogram"].orderBy("bin").collect()] == [3, 0, 0, 1]
    assert [r["time_diff"] for r in t["raw_data"].orderBy("_ord").collect()] == [None, 0.28, 0.28, 0.94, 0.0]


def test_induction_rate(logs):
    lines = [line(T0 + timedelta(seconds=i * 20), 54123, f"event:I,itemID:{i},inductionNo:{i % 2},carrierNo:{i}") for i in range(91)]
    t = induction_rate(logs(lines), prune=True)
    got = {r["line_name"]: r for r in t["rate_analysis"].collect()}
    assert got["IU001"]["n_items"] == 46 and got["IU001"]["pph_window"] == 92.0 and got["IU001"]["target_pph"] == 9119 / 4
    assert got["All Inductions"]["n_items"] == 91 and got["All Inductions"]["pph_window"] == 182.0
    assert rows(t["inductions"]) == [("IU001",), ("IU002",)]


def test_single_line_rate(spark, tmp_path):
    start = datetime(2025, 9, 17, 16, 0, 0)
    stamps = [(start + timedelta(seconds=s)).strftime("%y%m%d %H%M%S 000") for s in range(0, 1201, 4)] + ["bad"]
    (tmp_path / "f.csv").write_text("\n".join(f'"{s}";"I";"S"' for s in stamps))
    t = single_line_rate(read_flat_export(spark, str(tmp_path / "f.csv"), width=3), start)
    r = t["rate"].first()
    assert (r["n_items"], r["valid_rows"], r["invalid_rows"]) == (151, 301, 1)
    assert r["pph_window"] == pytest.approx(906.0) and r["pph_overall"] == pytest.approx(453.0)
    assert r["needed_items_for_pass"] == 409 and r["items_short"] == 258 and r["passed"] is False
    assert r["summary_line"] == "IU006;Measuring Point: MP1000605: Time 1600-1610PM; Total Inducted = 151"


def test_item_measurements(logs):
    lines = [line(T0, 50102, f"length , {100 + i},width:{i * 10},positionFront:{p},inductionNo:{4 + i % 2},noOfCarriers:1")
             for i, p in enumerate([0, 0, 0, 0, 0.4, 0.4, 1.0, 1.0, 15, 15])]
    t = item_measurements(logs(lines), slices=4)
    gaps = {r["inductionNo"]: r.asDict() for r in t["gap_counts"].collect()}
    assert gaps["IU005"]["0-0.4"] == 1 and gaps["IU005"]["0.4-0.8"] == 1 and gaps["IU005"][">10"] == 1 and "IU007" not in gaps
    prof = {r["column"]: r for r in t["numeric_profile"].collect()}
    assert prof["width"]["count"] == 10 and prof["width"]["p50"] == 45.0 and prof["width"]["max"] == 90.0
    assert t["threshold_counts"].first()["all_in"] == 10
    assert sum(r["count"] for r in t["gap_histogram"].collect()) == 8
    assert t["gap_quantiles"].first()["p50"] == pytest.approx(0.5)
    gaps = pd.Series([r["gap"] for r in t["gaps"].collect() for _ in range(r["_w"])])
    found = t["gap_description"].first()
    assert [found[c] for c in ("count", "mean", "std", "min", "p50", "max")] == pytest.approx(gaps.describe()[["count", "mean", "std", "min", "50%", "max"]].tolist())


def test_carrier_alarms(spark):
    df = spark.createDataFrame(
        [("CA1", "Disabled"), ("CA1", None), ("CA1", "x"), ("CA22", "Item on bellows is active"), ("Z", "x"), (None, "Disabled")],
        "`Part name` string, `Alarm text` string")
    t = alarm_reports.carrier_alarms(df)
    assert rows(t["by_part"]) == [("CA1", 3), ("CA22", 1), ("Z", 1)]
    assert rows(t["targeted_carriers"]) == [("0001", 1), ("0022", 1)]
    assert t["targeted_total"].first()[0] == 2 and t["total"].first()[0] == 6
    assert rows(t["text_shares"]) == [("Disabled", 2, 40.0), ("Item on bellows is active", 1, 20.0), ("x", 2, 40.0)]


def test_estop_summary_uses_its_group(spark):
    df = spark.createDataFrame([("ES102", "ES", "0:00:05"), ("ES102", "MCC", "0:00:07")], "`Part name` string, Group string, Duration string")
    report = alarm_reports.printable(alarm_reports.alarm_summary(df, "ES"), "ES")
    assert report.columns[0] == "ES Unit" and tuple(report.first()) == ("ES102", 1, "00:00:05", "00:00:05", "00:00:05")


def test_payload_keys_and_filter_counts(logs):
    df = logs(SORT_LINES)
    assert "itemID" in {r[0] for r in messages.payload_keys(messages.records_of(df, "54177")).collect()}
    assert tuple(messages.filter_counts(df, "54177").first()) == (8, 1)


def test_measures_are_parsed_without_the_other_fields(logs, monkeypatch):
    """Tables of the measures store only what they use; a table of every field is parsed once and then serves them too."""
    lines = [line(T0, 50102, f"inductionNo:5,length:{i},width:{i % 7},positionFront:{i * i},noOfCarriers:1") for i in range(40)]
    written, staged = [], measurements.stage

    def seen(table, name):
        written.append((name, set(table.columns)))
        return staged(table, name)

    monkeypatch.setattr(measurements, "stage", seen)
    narrow = item_measurements(logs(lines))
    assert written == []
    got = {n: rows(narrow[n]) for n in ("points", "threshold_counts", "numeric_profile", "gap_description", "gap_counts", "gap_histogram", "gap_quartiles")}
    parsed = [c for n, c in written if n.startswith("measure")]
    assert parsed == [{ORDER, "inductionNo", "length", "width", "positionFront", "noOfCarriers"}]
    written.clear()
    whole = item_measurements(logs(lines))
    assert {"timeStamp", "sequenceNo", "length"} <= set(whole["clean_data"].columns)
    assert {n: rows(whole[n]) for n in got} == got
    assert [n for n, _ in written if n.startswith("measure")] == ["measurements"]

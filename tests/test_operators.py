"""Operators against plain pandas on small random tables with one hot key."""

import collections
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sorterlog.operators import alarms as al
from sorterlog.operators import counts as ct
from sorterlog.operators import fixes as fx
from sorterlog.operators import lookup as lk
from sorterlog.operators import ordered
from sorterlog.operators import package_metrics as pm
from sorterlog.operators import quantiles as qu
from sorterlog.operators import rates as ra
from sorterlog.operators import spacing as sp
from sorterlog.operators.lookup import add_destinations, build_mapping
from sorterlog.operators.ordered import first_rows
from sorterlog.operators.sizing import broadcast_if_small
from sorterlog.operators.packages import assign_packages, assign_sessions, package_table
from sorterlog.operators.timewindow import resolve_window
from tests.conftest import rows

T0 = datetime(2025, 9, 23, 10, 0, 0)


def test_packages_of_the_worked_example(spark):
    data = [
        ("5001", T0, "???", 3005, 0), ("5001", T0 + timedelta(minutes=30), "??", 159, 8),
        ("5001", T0 + timedelta(minutes=60, milliseconds=1), "ABC", 159, 0),
        ("5002", T0 + timedelta(minutes=5), "9999", 76, 10), ("5003", T0 + timedelta(minutes=6), "99", 76, 0),
        ("5003", T0 + timedelta(minutes=7), "XYZ", 76, 0), ("5004", None, None, None, None), (None, T0, "A", 1, 1),
    ]
    df = spark.createDataFrame(
        [(*r, i) for i, r in enumerate(data)],
        "itemID string, timeStamp timestamp_ntz, barcodeAWCS string, requestedDestMCID bigint, sortCode bigint, _ord bigint")
    got = [(r["RealPackageID"], r["pkg_type"]) for r in assign_packages(df).orderBy("_ord").collect()]
    assert got == [("5001_0", "no_read"), ("5001_0", "no_read"), ("5001_1", "normal"), ("5002_0", "multi_read"),
                   ("5003_0", "normal"), ("5003_0", "normal"), ("5004_0", "normal"), (None, None)]
    packages = package_table(df)
    assert [tuple(r) for r in pm.scanner_metrics(packages).collect()] == [
        ("total_packages", 5), ("normal_packages", 3), ("no_read_packages", 1), ("multi_read_packages", 1)]
    assert pm.recirculation_count(packages).first()[0] == 1
    summary = pm.run_summary(df, packages).first()
    assert summary["recirculation_records"] == 4 and summary["package_processed"] == 5
    defects = {r[0]: (r[1], r[2]) for r in pm.defect_metrics(packages).collect()}
    assert defects == {"Scan Defect": (1, 20.0), "No Defect": (4, 80.0)}
    # 5001_0 loses its recirculation row and counts with its second row instead.
    assert rows(pm.sort_counts(packages)) == [("Multi_Label", 1), ("No_Read", 1), ("Success", 2)]


def random_records(n=4000, seed=1):
    """One key holds a third of the rows; many rows share an instant; some have no time."""
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 60, n))
    second = rng.integers(0, 400_000, n).astype(float)
    second[: n // 5] = 1234.0
    ts = [None if rng.random() < 0.02 else T0 + timedelta(seconds=float(s)) for s in second]
    return pd.DataFrame({"k": [f"i{x}" for x in key], "ts": ts, "ord": np.arange(n)})


def spark_records(spark, pdf):
    data = [(r.k, None if pd.isna(r.ts) else r.ts.to_pydatetime(), int(r.ord)) for r in pdf.itertuples()]
    return spark.createDataFrame(data, "k string, ts timestamp_ntz, ord bigint")


@pytest.mark.parametrize("gap", [0.5, 60, 1800])
def test_sessions_match_a_sorted_scan(spark, gap):
    pdf = random_records()
    pdf["ts"] = pd.to_datetime(pdf["ts"])
    s = pdf.sort_values(["k", "ts", "ord"], na_position="last")
    s["session"] = s.groupby("k")["ts"].diff().dt.total_seconds().gt(gap).groupby(s["k"]).cumsum().astype(int)
    want = dict(zip(s["ord"], s["session"]))
    got = {r["ord"]: r["session"] for r in assign_sessions(spark_records(spark, pdf), "k", "ts", gap).collect()}
    assert got == want


def test_interarrival_matches_a_sorted_scan(spark):
    pdf = random_records(seed=2)
    pdf["ts"] = pd.to_datetime(pdf["ts"])
    s = pdf.sort_values(["k", "ts", "ord"], na_position="last")
    s["d"] = s.groupby("k")["ts"].diff().dt.total_seconds()
    df = spark_records(spark, pdf)
    got = {r["ord"]: r["time_diff"] for r in sp.interarrival(df, "k", "ts", "ord").collect()}
    want = {o: None if pd.isna(d) else d for o, d in zip(s["ord"], s["d"])}
    assert got == want
    counts = sp.interarrival_counts(df, "k", "ts")
    clean = s.dropna(subset=["d"])
    expected = clean.groupby(["k", "d"]).size()
    assert {(r["k"], r["time_diff"]): r["_w"] for r in counts.collect()} == expected.to_dict()
    stats = {r["k"]: (r["count"], round(r["mean"], 6), r["min"], r["max"], r["median"])
             for r in sp.spacing_stats(counts, "k", slices=16).collect()}
    for k, g in clean.groupby("k")["d"]:
        v = sorted(g)
        assert stats[k] == (len(v), round(sum(v) / len(v), 6), v[0], v[-1], v[len(v) // 2])


def test_fixed_width_histogram_has_exact_edges(spark):
    rng = np.random.default_rng(3)
    values = [0.0, 0.28, 0.56, 0.84, 2.8, 14.0, 28.0] + [round(float(x), 2) for x in rng.random(300) * 40]
    values += [round(0.28 * i, 6) for i in range(1, 100)]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 0.0)], "k string, v double")
    got = sp.fixed_width_histogram(qu.value_counts_of(df, "v", ["k"]), "k", "v")
    micros = pd.Series([round(v * 1_000_000) for v in values])
    edges = [280_000 * i for i in range(int(micros.max()) // 280_000 + 2)]
    want = pd.cut(micros, bins=edges, include_lowest=True).value_counts(sort=False).sort_index()
    a = got.where("k = 'a'").orderBy("bin").collect()
    assert [r["count"] for r in a] == want.tolist()
    assert [r["bin_start"] for r in a][1:] == pytest.approx([e / 1_000_000 for e in edges[1:-1]])
    assert [(r["bin"], r["bin_start"], r["count"]) for r in got.where("k = 'b'").collect()] == [(0, -0.001, 1)]


def test_an_outlier_elsewhere_leaves_bins_unchanged(spark):
    values = [("A", round(0.28 * i, 2)) for i in range(2000)]
    seen = []
    for longest in (100.0, 28_001.0):
        df = spark.createDataFrame(values + [("B", longest)], "k string, v double")
        got = sp.fixed_width_histogram(qu.value_counts_of(df, "v", ["k"]), "k", "v")
        seen.append(rows(got.where("k = 'A'")))
        assert got.where("k = 'B'").agg(F.sum("count"), F.max("bin")).first() == (1, int(longest * 1_000_000) // 280_000)
    assert seen[0] == seen[1]


def test_heavy_weights_are_never_rows(spark):
    counts = spark.createDataFrame([("a", 0.0, 3_000_000_000), ("a", 0.5, 1)], "k string, time_diff double, _w bigint")
    assert [tuple(r) for r in sp.spacing_stats(counts, "k").collect()][0][1] == 3_000_000_001
    assert rows(sp.fixed_width_histogram(counts, "k").select("bin", "count")) == [(0, 3_000_000_000), (1, 1)]


def test_equal_width_histogram_matches_numpy(spark):
    rng = np.random.default_rng(4)
    values = [round(float(x), 1) for x in rng.normal(10, 3, 500)]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 5.0)], "k string, v double")
    got = sp.equal_width_histogram(qu.value_counts_of(df, "v", ["k"]), "k", "v", 50)
    assert [r["count"] for r in got.where("k = 'a'").orderBy("bin").collect()] == np.histogram(values, bins=50)[0].tolist()
    assert [r["count"] for r in got.where("k = 'b'").orderBy("bin").collect()] == np.histogram([5.0], bins=50)[0].tolist()


@pytest.mark.parametrize("slices", [1, 2, 7, 512, None])
def test_quantiles_match_pandas(spark, slices):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": rng.choice(["a", "b", "c"], 900, p=[0.9, 0.09, 0.01]), "v": rng.integers(0, 200, 900) / 7.0})
    df = spark.createDataFrame(list(pdf.itertuples(index=False, name=None)), "k string, v double")
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r["k"]: [r[n] for n in probs] for r in qu.quantiles(qu.value_counts_of(df, "v", ["k"]), "v", probs, ["k"], slices).collect()}
    for k, g in pdf.groupby("k")["v"]:
        assert got[k] == pytest.approx(g.quantile(list(probs.values())).tolist())
    assert qu.median(qu.value_counts_of(df, "v"), "v", slices).first()[0] == pytest.approx(pdf["v"].median())


def test_position_gaps_and_bins(spark):
    df = spark.createDataFrame([("a", v) for v in (0.0, 15.0, 0.0, 1.0, 0.4)] + [("b", 3.0), (None, 1.0)], "k string, p double")
    gaps = sp.position_gaps(df, "k", "p", slices=3)
    got = sorted((r["k"], round(r["gap"], 6), r["_w"]) for r in gaps.collect())
    assert got == [("a", 0.0, 1), ("a", 0.4, 1), ("a", 0.6, 1), ("a", 14.0, 1)]
    matrix = sp.bin_matrix(gaps, "k").first().asDict()
    assert matrix["0-0.4"] == 1 and matrix["0.4-0.8"] == 1 and matrix[">10"] == 1 and matrix["2-3"] == 0
    labels = spark.createDataFrame([(0.0,), (0.4,), (0.41,), (10.0,), (10.1,), (None,), (-1.0,)], "g double").select(sp.gap_bin("g"))
    assert [r[0] for r in labels.collect()] == [None, "0-0.4", "0.4-0.8", "5-10", ">10", None, None]


@pytest.mark.parametrize("factor, divisor", [(1, 1.0), (20, 10.0), (200, 1000.0)])
def test_auto_scale(spark, factor, divisor):
    df = spark.createDataFrame([("a", float(i * factor)) for i in range(1, 6)], "k string, p double")
    scaled = sp.auto_scale(sp.position_gaps(df, "k", "p"))
    assert {r["gap"] for r in scaled.collect()} == {factor / divisor}


def test_first_rows_keep_order_and_null_key(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", 4, 3), (None, 1, 4), (None, 0, 5)], "k string, o int, n int")
    assert rows(first_rows(df, ["k"], ["o", "n"]).select("k", "n")) == [("a", 3), (None, 5)]


def test_mapping_last_row_wins_and_recirculation_override(spark):
    dim = spark.createDataFrame(
        [("159", "A", "CHU1", None, 0), ("159", "B", "CHU2", "Jackpot", 1), ("3005", "R", "CHU3", " JackPot ", 2), ("x", "Y", "Z", None, 3)],
        "IndexNo string, Amazon string, Beumer string, Jackpot string, _pos bigint")
    mapping = build_mapping(dim)
    df = spark.createDataFrame([(159,), (3005,), (3999,), (4000,), (None,)], "requestedDestMCID bigint")
    plain = {r[0]: tuple(r)[1:] for r in add_destinations(df, mapping).collect()}
    assert plain[159] == ("B", "CHU2", "Jackpot") and plain[3005][0] == "R" and plain[3999] == (None, None, None)
    named = {r[0]: tuple(r)[1:] for r in add_destinations(df, mapping, recirculation=True).collect()}
    assert named[3005] == ("Recirculation", "Recirculation", " JackPot ") and named[3999] == ("Recirculation", "Recirculation", None)
    assert named[4000] == (None, None, None) and named[None] == (None, None, None)
    plan = add_destinations(df, mapping)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


FIXES = [("7", "no label", 0), ("7", "second", 1), ("7", None, 2), ("9999", "absent", 3), (None, "null id", 4)]


def fix_tables(spark):
    fixes = spark.createDataFrame(FIXES, "id string, comment string, _pos bigint")
    df = spark.createDataFrame(
        [("0007", 5, 0), ("0007", 8, 1), ("0008", 9, 2), ("0007", 10, 3), (None, 8, 4)], "indexNo string, sortCode bigint, _ord bigint")
    return df, fixes


def test_fix_by_occurrence(spark):
    df, fixes = fix_tables(spark)
    got = [tuple(r) for r in fx.fix_by_occurrence(df, fixes).orderBy("_ord").select("sortCode", fx.EXPLANATION).collect()]
    assert got == [(5, ""), (0, "no label"), (9, ""), (0, "second"), (8, "")]
    assert rows(fx.unapplied_ids(df, fixes).select("id")) == [("9999",)]


def test_fix_by_membership(spark):
    df, fixes = fix_tables(spark)
    got = [tuple(r) for r in fx.fix_by_membership(df, fixes).orderBy("_ord").select("sortCode", fx.EXPLANATION).collect()]
    assert got == [(0, ""), (0, ""), (9, ""), (0, ""), (8, "")]


@pytest.mark.parametrize("points", [7, 1_000_000])
def test_fix_of_an_id_listed_very_often(spark, monkeypatch, points):
    monkeypatch.setattr(ordered, "POINTS_PER_SLICE", points)
    fixes = spark.createDataFrame([("7", f"c{i}", i) for i in range(1500)] + [("8", "x", 1500)], "id string, comment string, _pos bigint")
    df = spark.createDataFrame([("0007", 8, i * 3) for i in range(2000)] + [("0008", 9, 1)], "indexNo string, sortCode bigint, _ord bigint")
    fixed = {r["_ord"]: (r["sortCode"], r[fx.EXPLANATION]) for r in fx.fix_by_occurrence(df, fixes).collect()}
    assert fixed == {i * 3: (0, f"c{i}") if i < 1500 else (8, "") for i in range(2000)} | {1: (0, "x")}
    plan = ordered.add_ordinal(df, "indexNo", "_ord", "k")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "row_number" in line and "Window" in line]
    assert windows and all("_slice" in w.split("windowspec")[-1] or "_slice" in w for w in windows)


def test_broadcast_needs_few_rows_and_few_bytes(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 10, "c string")
    hinted = [f(df)._jdf.queryExecution().logical().toString().startswith("ResolvedHint") or "UnresolvedHint" in f(df)._jdf.queryExecution().logical().toString()
              for f in (broadcast_if_small, lambda d: broadcast_if_small(d, max_rows=9), lambda d: broadcast_if_small(d, max_bytes=9999))]
    assert hinted == [True, False, False]


def test_windows(spark):
    data = [(T0 + timedelta(minutes=m), m) for m in range(0, 100, 10)] + [(None, -1)]
    df = spark.createDataFrame(data, "timeStamp timestamp_ntz, n int")
    pick = lambda w: sorted(r["n"] for r in w.rows.collect())
    assert pick(resolve_window(df)) == [0, 10, 20, 30]
    assert pick(resolve_window(df, full=True)) == [-1, *range(0, 100, 10)]
    early = resolve_window(df, T0 - timedelta(hours=1), T0 + timedelta(hours=9))
    assert (early.start, early.end) == (T0, T0 + timedelta(minutes=90)) and len(pick(early)) == 10
    late = resolve_window(df, T0 + timedelta(hours=5))
    assert pick(late) == [] and late.start == late.end == T0 + timedelta(hours=5)
    assert pick(resolve_window(df, T0 + timedelta(minutes=50), T0 + timedelta(minutes=40))) == []
    with pytest.raises(ValueError):
        resolve_window(df, T0 - timedelta(minutes=1), strict=True)
    with pytest.raises(ValueError):
        resolve_window(df.where("n = -1"))


@pytest.mark.parametrize("names, target", [
    (["IU001"], 2640.0), (["IU001", "IU002"], 9119 / 4), (["IU005"], 2820.0), (["IU005", "IU006"], 7351 / 3), (["SPS001"], 100.0),
    (["SPS001", "SPS002"], 100.0), (["IU001", "IU005"], (9119 / 4 + 7351 / 3) / 2), (["IU001", "SPS001"], (9119 / 4 + 7351 / 3) / 2),
    (["No Map Yet"], None), (["IU001", "No Map Yet"], 2640.0), ([], None),
])
def test_target_choice(spark, names, target):
    df = spark.createDataFrame([(n,) for n in names], "inductionNo string")
    assert ra.choose_target(df).first()[0] == target


def test_rate_case(spark):
    data = [("IU001", T0 + timedelta(seconds=1800 * i / 1199)) for i in range(1200)] + [("No Map Yet", T0)]
    df = spark.createDataFrame(data, "inductionNo string, timeStamp timestamp_ntz")
    table = {r["line_name"]: r for r in ra.with_total(ra.induction_rates(resolve_window(df))).collect()}
    one = table["IU001"]
    assert one["pph_window"] == pytest.approx(2400.0) and one["needed_items_for_pass"] == 1320 and one["items_short"] == 120
    assert one["passed"] is False and one["time_label"] == "1000-1030AM"
    assert one["recommendation"] == "Need +120 items in this 30.0 min window or reduce sec/bag to ≤ 1.36 (current 1.50)."
    total = table["All Inductions"]
    assert total["n_items"] == 1201 and total["target_pph"] == 5280.0 and total["passed"] is None


def test_rates_without_any_target_are_empty(spark):
    df = spark.createDataFrame([("No Map Yet", T0)], "inductionNo string, timeStamp timestamp_ntz")
    assert ra.with_total(ra.induction_rates(resolve_window(df))).count() == 0


def test_zero_length_window_has_rate_zero(spark):
    df = spark.createDataFrame([("IU001", T0)], "inductionNo string, timeStamp timestamp_ntz")
    r = ra.induction_rates(resolve_window(df)).first()
    assert r["pph_window"] == 0 and r["sec_per_bag_current"] == 0 and r["passed"] is False


def test_alarm_durations_and_fan_out(spark):
    alarms = spark.createDataFrame(
        [(" =CBS01.CHU008+S", '="00:01:02"'), (" =CBS01.CHU008+S", '="100:00:00"'), ("CHU009", None), ("no device", '="00:00:09"'), (None, "x")],
        "`Part name` string, Duration string")
    report = al.duration_report(al.duration_summary(al.device_durations(alarms, "CHU[0-9]+")))
    assert [tuple(r)[0:2] + tuple(r)[5:] for r in report.collect()] == [
        ("CHU008", 2, "100:01:02", "50:00:31", "100:00:00"), ("CHU009", 1, "00:00:00", "", "")]
    mapping = spark.createDataFrame([("CHU008", None, 0), ("CHU008", "B", 1), ("CHU008", "C", 2)], "Beumer string, Amazon string, _pos bigint")
    named = al.with_customer_names(al.duration_summary(al.device_durations(alarms, "CHU[0-9]+")), mapping)
    assert {r["device"]: (r["Amazon"], r["alarm_count"], r["total_us"]) for r in named.collect()} == {
        "CHU008": ("B", 6, 3 * 360_062_000_000), "CHU009": (None, 1, 0)}


def test_occurrence_report_with_separator(spark):
    occ = spark.createDataFrame(
        [("=CBS01.CHU731+S001", "Jam 1", "00:01", 3), ("=CBS01.CHU732+S001", "Stop", "00:02", 1), ("=CBS01.IU005+S001", "x", "00:03", 2),
         ("=CBS01.CHU740+S", None, "1", 1), ("=CBS01.CHU999+S", "Jam", "5", 9)],
        "Part string, Message string, Duration string, Occurrences int")
    mapping = spark.createDataFrame([("CHU731", "A-1", 0), ("CHU732", None, 1)], "Beumer string, Amazon string, _pos bigint")
    got = al.occurrence_report(occ, mapping, separator=True).select("section", "MappingString", "Occurrences", "Duration", "Part").collect()
    assert {tuple(r) for r in got} == {(1, "CHU731 - A-1", "3", "00:01", None), (1, None, "9", "5", None),
                                       (2, "---", "---", "---", None), (3, None, "2", "00:03", "IU005")}
    assert [r["section"] for r in got] == [1, 1, 2, 3]


def test_occurrence_report_spreads_jams_and_sorts_inductions(spark):
    occ = spark.createDataFrame(
        [(f"=CBS01.{'IU' if i % 3 == 0 else 'CHU'}{i % 7:03d}+S", f"Jam {i}", "1", i) for i in range(600)],
        "Part string, Message string, Duration string, Occurrences int").coalesce(1)
    mapping = spark.createDataFrame([("CHU001", f"A-{i}", i) for i in range(50)], "Beumer string, Amazon string, _pos bigint")
    got = al.occurrence_report(occ, mapping).select("*", F.spark_partition_id().alias("at")).collect()
    jams, inductions = [r for r in got if r["section"] == 1], [r for r in got if r["section"] == 3]
    named = sum(1 for i in range(600) if i % 3 and i % 7 == 1)
    assert len(jams) == 400 - named + 50 * named
    assert len({r["at"] for r in jams}) >= 4  # a sort of all rows leaves every jam to one task
    assert [r["section"] for r in got] == [1] * len(jams) + [3] * 200
    assert [r["Part"] for r in inductions] == sorted(f"IU{i % 7:03d}" for i in range(0, 600, 3))


def test_join_by_own_name_in_blocks_is_a_plain_join(spark, monkeypatch):
    rows_ = [(None if i % 11 == 0 else f"u{i % 7}", i, None if i % 5 == 0 else f"t{i % 3}") for i in range(700)] + [("u1", 1, "t1")] * 600
    df = spark.createDataFrame(rows_, "unit string, `n.o` int, more string").repartition(3)
    names = [("u1", f"A{i}", i) for i in range(150)] + [("u2", None, 200), ("u3", "B", 201), ("u3", "C", 202), ("u3", "C", 203), (None, "D", 204), ("u9", "E", 205)]
    mapping = spark.createDataFrame(names, "Beumer string, Amazon string, _pos bigint")
    for few in (True, False):
        monkeypatch.setattr(lk, "is_small", lambda d, few=few: few)
        for dedupe in (False, True):
            got = lk.join_by_own_name(df, mapping, "unit", dedupe)
            assert got.columns == ["unit", "n.o", "more", "Beumer", "Amazon"]
            known = {n[0]: n[:2] for n in names}.values() if dedupe else [n[:2] for n in names]
            want = [r + n for r in rows_ for n in ([k for k in known if k[0] == r[0] and r[0]] or [(None, None)])]
            assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want)
    assert lk.join_by_own_name(df.limit(0), mapping, "unit").count() == 0
    assert lk.join_by_own_name(df, mapping.limit(0), "unit").where("Beumer is null and Amazon is null").count() == len(rows_)


def test_jams_that_fan_out_are_stored_in_little_space(spark, tmp_path):
    occ = spark.createDataFrame([(f"=CBS01.CHU{i % 2:03d}+S", f"Jam {i}", str(i % 50), str(i)) for i in range(600)], "Part string, Message string, Duration string, Occurrences string")
    mapping = spark.createDataFrame([(f"CHU{i % 2:03d}", f"Customer {i:06d}", i) for i in range(4000)], "Beumer string, Amazon string, _pos bigint")
    al.occurrence_report(occ, mapping).select("MappingString", "Occurrences", "Duration").write.parquet(f"{tmp_path}/report")
    rows_ = spark.read.parquet(f"{tmp_path}/report").count()
    stored = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert rows_ == 1_200_000 and stored < 0.75 * rows_  # name after name for each jam takes 1.3 bytes a row or more


def test_counts_and_profiles(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 4.0), (None, None)], "t string, v double")
    assert rows(ct.group_size(df, "t")) == [("a", 2), ("b", 1)]
    assert rows(ct.group_size(df, "t", keep_null=True)) == [("a", 2), ("b", 1), (None, 1)]
    assert [tuple(r) for r in ct.shares(df, "t").collect()] == [("a", 2, 66.67), ("b", 1, 33.33)]
    assert tuple(ct.categorical_profile(df, ["t"]).first()) == ("t", 3, 2, "a", 2)
    p = ct.numeric_profile(df, ["v"]).first()
    want = pd.Series([1.0, 2.0, 4.0]).describe()
    assert [p["count"], p["mean"], p["std"], p["min"], p["p25"], p["p50"], p["p75"], p["max"]] == pytest.approx(want.tolist())
    assert tuple(ct.shape(df).first()) == (4, 3, 3)
    assert tuple(ct.distinct_counts(df).first()) == (2, 3)
    masks = ct.threshold_counts(spark.createDataFrame([(1, 1), (1, 500), (None, 1)], "a int, b int"), {"ab": ["a", "b"]}).first()
    assert tuple(masks) == (1, 1)


def test_seeded_sample_is_exact_and_repeatable(spark):
    df = spark.range(20000).toDF("n")
    a, b = (ct.seeded_sample(df, ["n"], 500, seed=7) for _ in range(2))
    assert a.count() == 500 and rows(a) == rows(b)
    whole = df.orderBy(F.md5(F.concat(F.lit("7|"), F.col("n").cast("string"))), "n").limit(500)
    assert rows(a) == rows(whole)
    assert ct.seeded_sample(df, ["n"], 30000).count() == 20000


def test_no_python_in_plans(spark):
    df = spark_records(spark, random_records(200))
    for q in (assign_sessions(df, "k", "ts"), sp.interarrival(df, "k", "ts", "ord"), sp.spacing_stats(sp.interarrival_counts(df, "k", "ts"), "k")):
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan and "CartesianProduct" not in plan

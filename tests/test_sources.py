"""Readers and writers on small files."""

import pytest
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv
from sorterlog.operators import columns as co
from sorterlog.operators.fixes import EXPLANATION, fix_by_occurrence
from sorterlog.operators.lookup import build_mapping
from sorterlog.sources import combine, logs, sinks, staging, tables
from tests.conftest import rows

LINE = '"250923 153200 123";"I";"SYS1";"10.0.0.1";"AWCS";"";"";"1";"MCC01";"54177";"{n}";"->{{a:1}}<"'


def test_log_monitor_edge_rows(spark, tmp_path):
    good = LINE.format(n=1)
    text = "\n".join([good, good + ";extra", "a;b; c", "", "   ", LINE.format(n=2).replace("SYS1", "SY\0S1"), "x;NA;;nan"])
    path = tmp_path / "log.csv"
    path.write_bytes(text.encode() + b"\nbad\xff;y\n")
    df = logs.read_log_monitor(spark, str(path))
    got = df.orderBy("_ord").collect()
    assert [r["timeStamp"] for r in got] == ['"250923 153200 123"', "a", '"250923 153200 123"', "x", "bad�"]
    assert got[1]["systemName"] == "c" and got[1]["rawMessage"] is None
    assert got[2]["systemName"] == '"SYS1"'
    assert (got[3]["flag"], got[3]["systemName"], got[3]["ipAddress"]) == (None, None, None)
    assert {r["source_file"] for r in got} == {"log.csv"}


def test_order_key_restores_file_order_over_many_splits(spark, tmp_path):
    path = tmp_path / "many.csv"
    path.write_text("\n".join(LINE.format(n=f"{i:06d}") for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = logs.read_log_monitor(spark, str(path))
        assert df.rdd.getNumPartitions() > 3
        seq = [r[0] for r in df.orderBy("_ord").select("sequenceNo").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seq == [f'"{i:06d}"' for i in range(3000)]


def test_fields_are_cut_once_per_line(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text(LINE.format(n=1))
    df = logs.read_log_monitor(spark, str(path)).where(F.col("messageCode") == '"54177"').select("rawMessage", "_ord")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1


def test_flat_export_takes_leading_names(spark, tmp_path):
    path = tmp_path / "flat.csv"
    path.write_text(' "250917 160001 278 " ;"I";"S"\n')
    df = logs.read_flat_export(spark, str(path), width=3)
    assert df.columns[-3:] == ["stamp_raw", "flag", "system"]
    assert df.first()["stamp_raw"] == "250917 160001 278 "


def test_alarm_history_skips_banner_and_header(spark, tmp_path):
    body = 'Part name;Group;Duration;Alarm text\nA;ES;"=""00:01:02""";x\nB;MCC;;"a;b"\n'
    (tmp_path / "one.csv").write_text("Filter: all\n" + body)
    (tmp_path / "two.csv").write_text("Filter: other\n" + body.replace("A;", "C;"))
    df = tables.read_alarm_history(spark, str(tmp_path))
    assert df.columns == ["Part name", "Group", "Duration", "Alarm text"]
    assert rows(df) == [("A", "ES", '="00:01:02"', "x"), ("B", "MCC", None, "a;b"), ("B", "MCC", None, "a;b"), ("C", "ES", '="00:01:02"', "x")]


def test_alarm_history_reads_each_file_by_its_own_header(spark, tmp_path):
    (tmp_path / "b.csv").write_text("Filter: all\nPart name;Group\nA;ES\nB;MCC\n")
    (tmp_path / "a.csv").write_text("Filter: x\nGroup;Alarm text;Part name\nMCC;Jam;C\n;;D;more\n")
    df = tables.read_alarm_history(spark, str(tmp_path))
    assert set(df.columns) == {"Part name", "Group", "Alarm text"}
    assert rows(df.select("Part name", "Group", "Alarm text")) == [("A", "ES", None), ("B", "MCC", None), ("C", "MCC", "Jam"), ("D", None, None)]


def test_positions_follow_the_file_names(spark, tmp_path):
    (tmp_path / "b.csv").write_text("id,comment\n" + "1,late\n" * 2000 + "7,second\n")
    (tmp_path / "a.csv").write_text("id,comment\n7,first\n")
    fixes = tables.read_fix_list(spark, str(tmp_path))
    assert [r["comment"] for r in fixes.where("id = '7'").orderBy("_pos").collect()] == ["first", "second"]
    df = spark.createDataFrame([("0007", 8, 5), ("0007", 8, 3)], "indexNo string, sortCode bigint, _ord bigint")
    fixed = {r["_ord"]: r[EXPLANATION] for r in fix_by_occurrence(df, fixes).collect()}
    assert fixed == {3: "first", 5: "second"}
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "b.csv").write_text("IndexNo,Amazon,Beumer,Jackpot\n" + "1,x,y,\n" * 500 + "159,last,B,\n")
    (tmp_path / "m" / "a.csv").write_text("IndexNo,Amazon,Beumer,Jackpot\n159,early,B,\n")
    dim = build_mapping(tables.read_mapping(spark, str(tmp_path / "m")))
    assert {r["IndexNo"]: r["Amazon"] for r in dim.collect()} == {1: "x", 159: "last"}


def test_mapping_is_text_and_trimmed(spark, tmp_path):
    (tmp_path / "m.csv").write_text("IndexNo,Amazon,Beumer,Jackpot\n 0159 ,A-1 ,CHU1, JackPot \n76,,CHU2,\n")
    df = tables.read_mapping(spark, str(tmp_path / "m.csv"))
    assert [tuple(r)[:4] for r in df.orderBy("_pos").collect()] == [("0159", "A-1", "CHU1", "JackPot"), ("76", None, "CHU2", None)]


def test_fix_list_takes_first_two_columns(spark, tmp_path):
    (tmp_path / "f.csv").write_text("id no,why,more\n7,no label,x\n,none,y\n")
    assert rows(tables.read_fix_list(spark, str(tmp_path / "f.csv")).select("id", "comment")) == [("7", "no label"), (None, "none")]


def test_combine_unions_columns(spark, tmp_path):
    (tmp_path / "a.log").write_text('x;y\n1;2\n3;"4;5"\n6;7;8\n9\n')
    (tmp_path / "b c.log").write_text("y;z\n10;11\n")
    (tmp_path / "a2.log").write_text("x;y\n12;13\n")
    (tmp_path / "skip.txt").write_text("q\n1\n")
    df = combine.combine_logs(spark, str(tmp_path))
    assert df.drop("_ord").columns == ["x", "y", "z", "source_file"]
    got = {tuple(r) for r in df.select("x", "y", "z", "source_file").collect()}
    assert {(a, b, c) for a, b, c, _ in got} == {
        ("1", "2", None), ("3", "4;5", None), ("9", None, None), (None, "10", "11"), ("12", "13", None)}
    assert {f for *_, f in got} == {"a.log", "a2.log", "b%20c.log"} or {f for *_, f in got} == {"a.log", "a2.log", "b c.log"}


def test_combine_without_files_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        combine.combine_logs(spark, str(tmp_path))


def test_csv_and_report_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, t string")
    sinks.write_csv(df.withColumn("l", F.array("n")), str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).columns == ["n", "t", "l"]
    paths = sinks.write_report({"one": df, "two": df.limit(1)}, str(tmp_path / "rep"))
    assert [spark.read.parquet(p).count() for p in paths] == [2, 1]


def test_one_folder_per_destination(spark, tmp_path):
    df = spark.createDataFrame([("A/B", 1), ("x" * 40, 2), ("A/B", 3), ("A_B", 4), ("x" * 40 + "y", 5), (None, 6)], "Amazon_Destination string, n int")
    sinks.write_per_destination(df, str(tmp_path / "d"))
    assert {p.name for p in (tmp_path / "d").iterdir() if p.is_dir()} == {"sheet=A%2FB", "sheet=A_B", "sheet=" + "x" * 40, "sheet=" + "x" * 40 + "y"}
    assert spark.read.parquet(str(tmp_path / "d")).count() == 5


def test_staging_uses_the_named_folder(spark, tmp_path, monkeypatch):
    # The real setting is fixed at session start, so the test names another one.
    monkeypatch.setattr(staging, "SETTING", "spark.test.staging")
    spark.conf.set("spark.test.staging", str(tmp_path))
    try:
        assert rows(staging.stage(spark.range(3).toDF("n"), "t")) == [(0,), (1,), (2,)]
        assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["t"]
    finally:
        spark.conf.unset("spark.test.staging")


def test_column_operators(spark):
    df = spark.createDataFrame(
        [("a", "x", None, "1", 1), ("b", "x", None, "2", 1), (None, None, None, "3.5", 1)], "p string, q string, n string, v string, k int")
    assert co.drop_constant_columns(df).columns == ["p", "n", "v"]
    assert co.drop_constant_columns(df, protect=["k"], all_null=True).columns == ["p", "v", "k"]
    assert co.drop_empty_columns(df).columns == ["p", "q", "v", "k"]
    typed = co.numeric_where_possible(df)
    assert [t for _, t in typed.dtypes] == ["string", "string", "double", "double", "int"]
    assert co.first_and_last(df, "k", "p").columns == ["k", "q", "n", "v", "p"]
    assert co.arrange_columns(df, {"q": "Q", "p": "P"}).columns == ["Q", "P"]
    with pytest.raises(ValueError):
        co.name_columns(df, fv.LOG_COLUMNS)
    assert co.name_columns_to_width(df, fv.FLAT_EXPORT_COLUMNS).columns == fv.FLAT_EXPORT_COLUMNS[:5]
    assert rows(co.to_int_columns(df.select("v"), ["v"])) == [(1,), (2,), (None,)]


def test_a_report_is_whole_or_refused(spark, tmp_path):
    df = spark.createDataFrame([(1, "a;\"x\""), (2, None)], "n int, t string")
    base = (tmp_path / "whole").as_uri()
    sinks.write_report({"b": df, "a": df.limit(1)}, base, fmt="csv")
    found = sinks.read_report(spark, base)
    assert list(found) == ["b", "a"] and sorted(tuple(r) for r in found["b"].collect()) == [("1", 'a;"x"'), ("2", None)]
    bad = df.select(F.raise_error(F.lit("no such table")).cast("string").alias("n"))
    with pytest.raises(Exception, match="no such table"):
        sinks.write_report({"a": df, "bad": bad}, (tmp_path / "part").as_uri())
    with pytest.raises(FileNotFoundError):
        sinks.read_report(spark, (tmp_path / "part").as_uri())
    with pytest.raises(Exception, match="no such table"):
        sinks.write_report({"b": df, "a": bad}, base, fmt="csv", mode="overwrite")
    with pytest.raises(FileNotFoundError):
        sinks.read_report(spark, base)
    assert sinks.write_report({}, base) == []


def test_busy_destinations_are_divided_and_small_ones_are_not(spark, tmp_path):
    df = spark.range(0, 30_000, 1, 16).select(F.when(F.col("id") % 3 > 0, "busy").otherwise(F.concat(F.lit("d"), F.col("id") % 30)).alias("Amazon_Destination"), "id")
    sinks.write_per_destination(df, str(tmp_path / "d"), rows_per_file=3000)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "d").iterdir() if p.is_dir()}
    assert files.pop("sheet=busy") >= 20_000 // 3000 and len(files) == 10 and set(files.values()) == {1}

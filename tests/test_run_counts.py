import gzip

from sorterlog.operators.counts import seeded_sample
from sorterlog.plans.messages import counted_records
from sorterlog.sources.combine import combine_logs, combine_report
from sorterlog.sources.headed import header_lines, numbered_lines
from sorterlog.sources.logs import read_lines
from sorterlog.sources.staging import new_folder, stage, unstage
from sorterlog.sources.tables import read_alarm_history


def test_counts_come_from_the_pass_that_writes_the_records(spark, tmp_path):
    record = ";".join(["{}", "I", "S", "ip", "A", "", "", "0", "M", "{}", "1", "->{{a:1}}<"])
    lines = [record.format("240101 000000 000", "54177"), record.format("bad", "54177"), record.format("240101 000000 000", "1"), record.format("x", "54177") + ";13", "", "  ", '"short";line']
    (tmp_path / "x.log").write_text("\n".join(lines) + "\n")
    table, counts = counted_records(read_lines(spark, f"file://{tmp_path}/x.log"), "54177")
    assert counts == {"lines": 7, "blank": 2, "too_long": 1, "kept": 2, "dropped": 2, "bad_stamps": 1}
    assert table.count() == 2
    (tmp_path / "none.log").write_text("")
    empty, counts = counted_records(read_lines(spark, f"file://{tmp_path}/none.log"), ["54177", "1"])
    assert empty.count() == 0 and counts["lines"] == counts["kept"] == counts["bad_stamps"] == 0


def test_every_file_is_reported(spark, tmp_path):
    (tmp_path / "a.log").write_text("\n\nid;kind\n1;x\n\nid;kind\n2;y;z\n3;w\n")
    (tmp_path / "b.log").write_text("")
    (tmp_path / "c.log").write_text("only;header\n")
    (tmp_path / "d.log.gz").write_bytes(gzip.compress(b"id;more\n7;q\n"))
    (tmp_path / "e.log.gz").write_bytes(b"this is no compressed stream")
    (tmp_path / "other.txt").write_text("id\n1\n")
    got = {r["file"]: (r["rows"], r["skipped"], r["status"]) for r in combine_report(spark, f"file://{tmp_path}", "*.log*").collect()}
    assert got == {"a.log": (2, 1, "read"), "b.log": (0, 0, "empty"), "c.log": (0, 0, "read"), "d.log.gz": (1, 0, "read"), "e.log.gz": (0, 0, "unreadable")}
    rows = combine_logs(spark, f"file://{tmp_path}", "*.log*").collect()
    assert len(rows) == sum(n for n, _, _ in got.values())


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan text")


def test_headers_are_found_in_one_pass(spark, tmp_path):
    for i, order in enumerate((["p", "q"], ["q", "p"], ["p", "q"])):
        (tmp_path / f"{i}.csv").write_text("\n" * i + "Banner; x\n\n" + ";".join(order) + "\n" + f"{i};a\n{i};b\n")
    (tmp_path / "short.csv").write_text("Banner\n")
    path = f"file://{tmp_path}/*.csv"
    found = header_lines(numbered_lines(spark, path), place=1)
    assert scans(found) == 1
    assert sorted(r["_header"] for r in found.collect()) == ["p;q", "p;q", "q;p"]
    table = read_alarm_history(spark, path)
    assert scans(table) == 1
    assert sorted((r["p"], r["q"]) for r in table.collect()) == [("0", "a"), ("0", "b"), ("2", "a"), ("2", "b"), ("a", "1"), ("b", "1")]


def test_sample_reads_its_input_once(spark):
    df = spark.range(1000).toDF("n")
    plan = seeded_sample(df, ["n"], 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "TakeOrderedAndProject" in plan


def test_staged_tables_can_be_dropped_early(spark):
    table = stage(spark.range(3).toDF("x"), "early")
    path = table.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    unstage(table, None, spark.range(1).toDF("x"))
    import os

    assert not os.path.exists(path)
    assert new_folder(spark, "x").startswith("file:")

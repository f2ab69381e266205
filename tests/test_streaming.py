from datetime import datetime

import pytest

from sorterlog.operators.packages import package_table
from sorterlog.plans.messages import explode_destinations, sort_report_messages
from sorterlog.sources.logs import read_log_monitor
from sorterlog.streaming import live

REPORT, REQUEST, INDUCTED = "54177", "54163", "54123"


def line(clock, code, **pairs):
    body = ",".join(f"{k}:{v}" for k, v in pairs.items())
    fields = [f"240301 {clock} 000", "I", "S", "ip", "A", "", "", "0", "M", code, "1", f"->{{{body}}}<"]
    return ";".join(f'"{f}"' for f in fields)


def report(clock, item, number, dest=159, code=0, barcode="B1"):
    return line(clock, REPORT, plcRecordNo=number, itemID=item, barcodeAWCS=barcode, requestedDestMCID=f"[{dest}]", sortCode=f"[{code}]")


class Folder:
    """A folder that files are dropped into, and a stream that works them off."""

    def __init__(self, spark, path, analysis):
        self.spark, self.path, self.analysis, self.drops = spark, path, analysis, 0
        (path / "logs").mkdir()

    def drop(self, *lines):
        self.drops += 1
        (self.path / "logs" / f"{self.drops}.log").write_text("\n".join(lines) + "\n")
        stream = self.analysis(live.stream_log_monitor(self.spark, f"file://{self.path}/logs"))
        return live.run_to_end(stream, f"file://{self.path}/sink", f"file://{self.path}/state")

    def rows(self):
        return self.spark.read.parquet(f"file://{self.path}/sink")


def test_packages_go_on_over_drops_and_late_records_are_counted(spark, tmp_path):
    folder = Folder(spark, tmp_path, live.live_packages)
    first = [report("100000", "A", 1, code=8, barcode="????"), report("100000", "B", 2), report("103000", "A", 3, dest=3001, barcode="????"), "junk", ""]
    metrics = folder.drop(*first)
    assert metrics["late"] == 0 and metrics["state_rows"] == 2 and folder.rows().isEmpty()
    # half an hour after the last record of A is still the same package, a second more is not
    folder.drop(report("110000", "A", 4, barcode="????"), report("113001", "A", 5), line("113002", REPORT, plcRecordNo=6), "240301 junk;x")
    late = folder.drop(report("100500", "B", 7), report("114000", "C", 8))
    assert late["late"] == 1
    folder.drop(report("235900", "Z", 9))
    got = {(r["itemID"], r["first_ts"]): r for r in folder.rows().collect()}
    a, b = got["A", datetime(2024, 3, 1, 10)], got["B", datetime(2024, 3, 1, 10)]
    assert (a["last_ts"], a["records"], a["pkg_type"], a["recirculates"], a["first_code"], a["first_mcid"]) == (datetime(2024, 3, 1, 11), 3, "no_read", True, 8, 159)
    assert (b["records"], b["recirculates"]) == (1, False)
    assert len(got) == 4  # A twice, B, C; Z is still open
    numbers = {(r["itemID"], r["first_ts"].hour): r["session"] for r in live.number_packages(folder.rows()).collect()}
    assert numbers["A", 10] == 0 and numbers["A", 11] == 1


def test_stream_equals_the_analysis_of_finished_files(spark, tmp_path):
    folder = Folder(spark, tmp_path, live.live_packages)
    lines = [report(f"{8 + n // 30:02d}{n * 7 % 60:02d}{n % 60:02d}", f"I{n % 5}", n, dest=2990 + n % 20, code=n % 3, barcode=("9999", "X")[n % 2]) for n in range(240)]
    folder.drop(*sorted(lines)[:120])
    folder.drop(*sorted(lines)[120:])
    folder.drop(line("235959", REPORT, itemID="end", requestedDestMCID="[1]", sortCode="[0]"))
    (tmp_path / "all.log").write_text("\n".join(lines))
    rows = explode_destinations(sort_report_messages(read_log_monitor(spark, f"file://{tmp_path}/all.log")))
    want = package_table(rows)
    columns = ["itemID", "session", "records", "pkg_type", "recirculates"]
    got = live.number_packages(folder.rows()).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*columns).collect()))


def test_rates_hold_only_open_windows(spark, tmp_path):
    folder = Folder(spark, tmp_path, live.live_rates)
    many = folder.drop(*[line(f"10{m:02d}00", INDUCTED, inductionNo=m % 2) for m in range(60)], line("104500", INDUCTED, inductionNo=99))
    assert many["state_rows"] == 5 - 2  # the first half hour is finished: two names in it, three in the second
    folder.drop(line("120000", INDUCTED, inductionNo=4))
    got = {(r["start_ts"].strftime("%H%M"), r["line_name"]): r for r in live.rated_windows(folder.rows()).collect()}
    assert {k: r["n_items"] for k, r in got.items()} == {("1000", "IU001"): 15, ("1000", "IU002"): 15, ("1030", "IU001"): 15, ("1030", "IU002"): 15, ("1030", "No Map Yet"): 1}
    assert got["1000", "IU001"]["pph_window"] == 30.0 and got["1000", "IU001"]["target_pph"] == pytest.approx(9119 / 4)


def test_first_requests_and_barcodes(spark, tmp_path):
    def request(clock, number, barcode, dest):
        pairs = {"plcRecordNo": number, **({"barcodeAWCS": barcode} if barcode else {}), "requestedDestMCID": f"[{dest}]"}
        return line(clock, REQUEST, **pairs)

    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    one, other = Folder(spark, tmp_path / "a", live.live_first_requests), Folder(spark, tmp_path / "b", live.live_barcodes)
    drops = [
        [request("100000", 2, "X", 7), request("100000", 10, "X", 8), request("100100", 3, None, 5), request("095900", 4, "Y", 1)],
        [request("104000", 5, "X", 9), request("104100", 6, None, 6)],
        [request("180000", 7, "X", 3)],
        [request("233000", 8, "Z", 3)],
    ]
    for drop in drops:
        one.drop(*drop)
        other.drop(*drop)
    got = sorted((r["barcodeAWCS"] or "", r["timeStamp"].hour, r["requestedDestMCID"], r["requests"]) for r in one.rows().collect())
    assert got == [("", 10, "5", 2), ("X", 10, "7", 3), ("X", 18, "3", 1), ("Y", 9, "1", 1)]
    assert sorted(r[0] or "" for r in other.rows().collect()) == ["", "X", "Y", "Z"]  # X is still known at 18:00, as the watermark has not got there

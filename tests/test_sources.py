"""Sources and sinks: report files round trip through CSV with the contract, snapshots by name, month windows."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tillroll.functions.dates import previous_month
from tillroll.plans import params as P
from tillroll.sources import contracts, sinks
from tillroll.sources import fixtures as fx
from tillroll.sources.tables import Tables, read_snapshot


def test_previous_month():
    assert previous_month("2025-09-03") == (dt.date(2025, 8, 1), dt.date(2025, 9, 1), "202508", "Aug")
    assert previous_month(dt.date(2025, 1, 15)) == (dt.date(2024, 12, 1), dt.date(2025, 1, 1), "202412", "Dec")


def test_report_csv_round_trip(spark, sf001):
    t = Tables(spark, sf001)
    report = fx.distributor_report(t, P.RECON_START, P.RECON_END)
    out = os.path.join(tempfile.mkdtemp(prefix="tillroll-io-"), "genba_report")
    sinks.write_csv(report, out)
    back = contracts.read_distributor_report(contracts.read_report_files(spark, out))
    direct = contracts.read_distributor_report(report)
    assert back.count() == direct.count() > 0
    assert back.exceptAll(direct.select(*back.columns)).count() == 0


def test_missing_report_path_raises(spark):
    with pytest.raises(AnalysisException):
        contracts.read_report_files(spark, "/nonexistent/report.csv").count()


def test_snapshot_by_name(spark, sf001):
    Tables(spark, sf001).orders.createOrReplaceTempView("orders_details_1998_07_stamp")
    assert read_snapshot(spark, "orders_details_1998_07_stamp").count() > 0


def test_latest_snapshot_not_after_the_month(spark):
    from tillroll.sources.tables import NoSnapshotError, latest_snapshot, snapshots

    for name in ("stock_2024_11_b", "stock_2024_11_a", "stock_2025_01_a", "stock_2025_02", "stock_2025_13_a", "stock_2025_01_a_old",
                 "stock_extra_2025_01_a", "stock_latest"):
        spark.range(1).select(F.lit(name).alias("name")).createOrReplaceTempView(name)
    assert [s[2] for s in snapshots(spark, "stock")] == ["stock_2024_11_a", "stock_2024_11_b", "stock_2025_01_a", "stock_2025_01_a_old",
                                                         "stock_2025_02"]
    assert latest_snapshot(spark, "stock", "2025-02-27") == "stock_2025_02"
    assert latest_snapshot(spark, "stock", dt.date(2024, 12, 31)) == "stock_2024_11_b"
    assert read_snapshot(spark, "stock", "2025-01-01").first()["name"] == "stock_2025_01_a_old"
    with pytest.raises(NoSnapshotError, match="stock_2024_11_a"):
        latest_snapshot(spark, "stock", "2024-10-01")
    with pytest.raises(NoSnapshotError):
        read_snapshot(spark, "no_such_stock", "2024-10-01")


def test_sheet_rows(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), None, 1.5), (None, "x", None)], "d date, s string, v double")
    rows = [tuple(r) for r in sinks.sheet_rows(df).collect()]
    assert rows == [("2024-01-02", "", "1.5"), ("", "x", "")]
    assert sinks.preview(df, 1).count() == 1


def test_sheet_lines_have_a_header_and_an_order(spark):
    rows = [(f"t{i}", i * 37 % 101, dt.date(2024, 1, 1) if i % 2 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "`Product title` string, total int, day date")
    got = sorted(tuple(r) for r in sinks.sheet_lines(df, [F.col("total").desc(), "`Product title`"]).collect())
    want = [(t, str(n), "2024-01-01" if d else "") for t, n, d in sorted(rows, key=lambda r: (-r[1], r[0]))]
    assert got == [(0, "Product title", "total", "day")] + [(i + 1, *w) for i, w in enumerate(want)]
    empty = sinks.sheet_lines(df.limit(0), ["total"]).collect()
    assert [tuple(r) for r in empty] == [(0, "Product title", "total", "day")]
    with pytest.raises(ValueError):
        sinks.sheet_lines(df.withColumnRenamed("total", "line"), ["line"])


def test_a_failed_write_leaves_the_report(spark):
    base = tempfile.mkdtemp(prefix="tillroll-rep-")
    df = spark.range(5).select(F.col("id").alias("v"))
    with pytest.raises(FileNotFoundError):
        sinks.read_report(spark, base, "Overall Comparison")
    first = sinks.replace_report(df, base, "Overall Comparison")
    broken = df.select(F.raise_error(F.lit("lost the warehouse")).cast("long").alias("v"))
    with pytest.raises(Exception, match="lost the warehouse"):
        sinks.replace_report(broken, base, "Overall Comparison")
    assert sinks.read_report(spark, base, "Overall Comparison").count() == 5
    second = sinks.replace_report(sinks.read_report(spark, base, "Overall Comparison").limit(2), base, "Overall Comparison", fmt="csv")
    assert first != second and sinks.read_report(spark, base, "Overall Comparison").count() == 2
    assert sinks.report_versions(spark, base, "Overall Comparison").count() == 2
    sinks.replace_report(df, base, "Another")
    assert sinks.read_report(spark, base, "Another").count() == 5


def test_sql_frame_binds_parameters(spark, sf001):
    from tillroll.sources.tables import sql_frame

    Tables(spark, sf001).orders.createOrReplaceTempView("shop_orders_io5")
    df = sql_frame(spark, "SELECT count(*) AS n FROM shop_orders_io5 WHERE o_orderdate >= :start AND o_orderdate < :end",
                   start=dt.date(1998, 7, 1), end=dt.date(1998, 8, 1))
    assert df.first()["n"] > 0


def test_jdbc_options_read_a_query_in_partitions():
    from tillroll.sources.tables import jdbc_options

    o = jdbc_options("jdbc:x", "SELECT * FROM t;", "id", 0, 100, 4, properties={"user": "u"})
    assert "query" not in o and o["dbtable"] == "(SELECT * FROM t) AS source_rows"
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"], o["user"]) == ("id", "0", "100", "4", "u")


def test_dates_as_partners_write_them(spark):
    cells = ["2025-07-31", "2025-07-31 10:11:12", "07/31/2025", "31/07/2025", "31 Jul 2025", "31.7.2025", "20250731", "n/a", None]
    df = spark.createDataFrame([(c,) for c in cells], "d string")
    got = [r[0] for r in df.select(contracts.lenient_date("d")).collect()]
    assert got == [dt.date(2025, 7, 31)] * 7 + [None, None]
    day_first = spark.createDataFrame([("03/04/2025",)], "d string").select(contracts.lenient_date("d", ("d/M/yyyy",)))
    assert day_first.first()[0] == dt.date(2025, 4, 3)


def test_single_file_is_bounded(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="tillroll-one-")
    sinks.write_csv(spark.range(10), f"{base}/a", single_file=True)
    assert len([f for f in os.listdir(f"{base}/a") if f.startswith("part-")]) == 1
    monkeypatch.setattr(sinks, "SINGLE_FILE_ROWS", 5)
    with pytest.raises(ValueError):
        sinks.write_csv(spark.range(10), f"{base}/b", single_file=True)

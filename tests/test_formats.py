"""Column formats of dates: decided from the whole column, per file, never cell by cell."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tillroll.sources import contracts, formats


def frame(spark, cells, name="d"):
    return spark.createDataFrame([(c,) for c in cells], f"{name} string")


def dates(df, *args, **kw):
    return [r[0] for r in formats.read_dates(df, ["d"], *args, **kw).collect()]


def test_shapes_group_patterns_that_can_be_confused():
    assert formats.shape("M/d/yyyy") == formats.shape("d/M/yyyy") != formats.shape("d.M.yyyy")
    assert formats.shape("yyyyMMdd") == formats.shape("ddMMyyyy") != formats.shape("yyyy/M/d")
    assert formats.shape("d MMM yyyy") != formats.shape("d M yyyy")


def test_a_day_first_column_is_read_day_first(spark):
    assert dates(frame(spark, ["03/04/2024", "25/04/2024"])) == [dt.date(2024, 4, 3), dt.date(2024, 4, 25)]
    assert dates(frame(spark, ["03/04/2024", "04/25/2024"])) == [dt.date(2024, 3, 4), dt.date(2024, 4, 25)]


def test_the_majority_decides_and_the_rest_is_lost_and_counted(spark):
    df = frame(spark, ["13/01/2024", "14/01/2024", "01/20/2024", "02/03/2024", "2024-05-06", "7 May 2024", "20240508", "n/a", " ", None])
    got = formats.read_dates(df, ["d"])
    assert [r[0] for r in got.collect()] == [dt.date(2024, 1, 13), dt.date(2024, 1, 14), None, dt.date(2024, 3, 2), dt.date(2024, 5, 6),
                                             dt.date(2024, 5, 7), dt.date(2024, 5, 8), None, None, None]
    assert [tuple(r) for r in formats.lost_cells(df, got, ["d"]).collect()] == [("d", 8, 2)]
    found = {r["shape"]: r for r in formats.column_formats(df, ["d"]).collect()}
    x = found[formats.shape("M/d/yyyy")]
    assert (x["pattern"], x["cells"], x["rival_cells"], x["conflicts"], x["filled"], x["decided"]) == ("d/M/yyyy", 3, 2, 1, 8, True)


def test_an_undecided_column_is_refused_or_takes_the_stated_order(spark):
    df = frame(spark, ["03/04/2024", "05/06/2024"])
    with pytest.raises(formats.AmbiguousDatesError, match="d"):
        formats.read_dates(df, ["d"], undecided="raise")
    assert dates(df) == [dt.date(2024, 3, 4), dt.date(2024, 5, 6)]
    assert dates(df, ("d/M/yyyy", "M/d/yyyy")) == [dt.date(2024, 4, 3), dt.date(2024, 6, 5)]
    same = frame(spark, ["03/03/2024", "11/11/2024"])  # both readings agree, so nothing is undecided
    assert dates(same, undecided="raise") == [dt.date(2024, 3, 3), dt.date(2024, 11, 11)]
    with pytest.raises(ValueError):
        formats.read_dates(df, ["d"], undecided="guess")


def test_each_file_has_its_own_format(spark):
    rows = [("a", "03/04/2024", "x"), ("a", "25/04/2024", "x"), ("b", "03/04/2024", "x"), ("b", "04/25/2024", "x"),
            (None, "03/04/2024", "x"), (None, "30/04/2024", "x"), ("empty", None, "x"), ("c", "01/02/2024", "x")]
    df = spark.createDataFrame(rows, "file string, d string, _formats string")
    got = formats.read_dates(df, ["d"], by="file")
    assert got.columns == df.columns
    want = {("a", 4, 3), ("a", 4, 25), ("b", 3, 4), ("b", 4, 25), (None, 4, 3), (None, 4, 30), ("empty", None, None), ("c", 1, 2)}
    assert {(r["file"], r["d"] and r["d"].month, r["d"] and r["d"].day) for r in got.collect()} == want
    with pytest.raises(formats.AmbiguousDatesError, match="of c"):
        formats.read_dates(df, ["d"], by="file", undecided="raise")


def test_random_columns_come_back_whole(spark):
    rnd = random.Random(1)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randrange(700)) for _ in range(300)]
    writers = {"us": "{0.month}/{0.day}/{0.year}", "eu": "{0.day}/{0.month}/{0.year}", "dot": "{0.day}.{0.month}.{0.year}", "iso": "{0}"}
    rows = [(f, w.format(d), str(d)) for d in days for f, w in writers.items()]
    df = spark.createDataFrame(rows, "file string, d string, want string")
    got = formats.read_dates(df, ["d"], by="file", undecided="raise")
    assert got.where(~F.col("d").eqNullSafe(F.to_date("want"))).count() == 0
    for name in writers:
        one = formats.read_dates(df.where(F.col("file") == name), ["d"])
        assert one.where(~F.col("d").eqNullSafe(F.to_date("want"))).count() == 0


def test_empty_tables_and_no_date_columns(spark):
    empty = frame(spark, [])
    assert dates(empty) == [] and dates(empty, undecided="raise") == []
    assert formats.read_dates(spark.createDataFrame([], "file string, d string"), ["d"], by="file").collect() == []
    assert formats.read_dates(empty, []).columns == ["d"]


def test_a_contract_types_the_day_first_report(spark):
    df = spark.createDataFrame([("03/04/2024", "1.5"), ("25/04/2024", "1,200.0")], "`When` string, `How much` string")
    rows = contracts.apply_contract(df, {"When": "sold", "How much": "amount"}, ["sold"], ["amount"]).collect()
    assert [r["sold"] for r in rows] == [dt.date(2024, 4, 3), dt.date(2024, 4, 25)]
    assert float(rows[0]["amount"]) == 1.5 and rows[1]["amount"] is None

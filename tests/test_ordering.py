"""Gapless positions of a range-sorted table."""

from collections import defaultdict

from pyspark.sql import functions as F

from tillroll.operators.ordering import positions


def test_positions_follow_the_order_in_every_group(spark):
    rows = [(g, i * 7 % 101, f"v{i}") for i in range(900) for g in ([None] if i % 3 else ["hot", "b"])]
    df = spark.createDataFrame(rows, "g string, k int, _part string")
    got = positions(df, [F.col("k").desc(), "_part"], ["g"], total="n").collect()
    want = defaultdict(list)
    for g, k, v in rows:
        want[g].append((-k, v))
    for g, members in want.items():
        mine = sorted((r["position"], -r["k"], r["_part"], r["n"]) for r in got if r["g"] == g)
        assert [(k, v) for _, k, v, _ in mine] == sorted(members)
        assert [p for p, _, _, _ in mine] == list(range(len(members)))
        assert {n for _, _, _, n in mine} == {len(members)}


def test_equal_rows_are_split_over_tasks_and_numbered_once(spark):
    df = spark.range(20_000).select(F.lit("same").alias("k"), F.lit(1).alias("x"))
    got = positions(df, ["k"], name="at")
    assert got.columns == ["k", "x", "at"]
    r = got.agg(F.min("at"), F.max("at"), F.count_distinct("at")).first()
    assert tuple(r) == (0, 19_999, 20_000)


def test_empty_table(spark):
    assert positions(spark.createDataFrame([], "a int"), ["a"], total="n").collect() == []

"""Window rewrites versus the reference's literal self joins, plus the register's edge cases."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators import journeys
from tests import selfjoin as literal

ORDER_SCHEMA = ("order_id long, user_id long, order_date date, order_month date, order_revenue_total long, "
                "order_margin_total long, units long, has_fv int, has_game int, has_dlc int, has_other int, "
                "order_type string")


def random_orders(spark, n=1500, users=40, days=60, seed=7):
    rnd = random.Random(seed)
    base = dt.date(2024, 1, 1)
    rows = []
    for oid in range(n):
        d = base + dt.timedelta(days=rnd.randrange(days))
        flags = [int(rnd.random() < p) for p in (0.4, 0.5, 0.2, 0.2)]
        rows.append((oid, rnd.randrange(users), d, d.replace(day=1), 0, 0, 1, *flags, "x"))
    return spark.createDataFrame(rows, ORDER_SCHEMA)


def test_followed_within_equals_range_self_join(spark):
    orders = random_orders(spark)
    for n in (3, 7, 30):
        win = journeys.order_journey_rows(orders, n).select(
            "user_id", "order_id", F.col("seq_g2fv_30d_count").alias("seq_g2fv"),
            F.col("seq_fv2g_30d_count").alias("seq_fv2g"))
        lit = literal.followed_within_selfjoin(orders, n)
        assert win.exceptAll(lit).count() == 0 and lit.exceptAll(win).count() == 0
        assert win.where("seq_g2fv = 1").count() > 0


def test_order_gaps_equal_lag(spark):
    orders = random_orders(spark, seed=11)
    win = journeys.order_journey_rows(orders, 7).select("user_id", "order_id",
                                                        F.col("days_since_prev_order").cast("int").alias("gap"))
    w = Window.partitionBy("user_id").orderBy("order_date", "order_id")
    ref = orders.select("user_id", "order_id",
                        F.datediff("order_date", F.lag("order_date").over(w)).alias("gap"))
    assert win.exceptAll(ref).count() == 0 and ref.exceptAll(win).count() == 0


def test_null_user_and_same_day(spark):
    rows = [
        (1, None, dt.date(2024, 1, 1), dt.date(2024, 1, 1), 0, 0, 1, 0, 1, 0, 0, "game"),
        (2, None, dt.date(2024, 1, 2), dt.date(2024, 1, 1), 0, 0, 1, 1, 0, 0, 0, "F"),
        (3, 5, dt.date(2024, 1, 3), dt.date(2024, 1, 1), 0, 0, 1, 0, 1, 0, 0, "game"),
        (4, 5, dt.date(2024, 1, 3), dt.date(2024, 1, 1), 0, 0, 1, 0, 1, 0, 0, "game"),
        (5, 5, dt.date(2024, 1, 5), dt.date(2024, 1, 1), 0, 0, 1, 1, 0, 0, 0, "F"),
    ]
    out = {r["order_id"]: r for r in journeys.order_journey_rows(spark.createDataFrame(rows, ORDER_SCHEMA), 7)
           .collect()}
    assert out[1]["days_since_prev_order"] is None and out[2]["days_since_prev_order"] is None
    assert out[1]["seq_g2fv_30d_count"] == 0  # null users never pair (S6)
    assert out[3]["days_since_prev_order"] is None and int(out[4]["days_since_prev_order"]) == 0
    assert int(out[5]["days_since_prev_order"]) == 2
    assert out[3]["seq_g2fv_30d_count"] == 1 and out[4]["seq_g2fv_30d_count"] == 1


def test_order_on_two_days_spreads_flag(spark):
    rows = [
        (1, 7, dt.date(2024, 1, 1), dt.date(2024, 1, 1), 0, 0, 1, 0, 1, 0, 0, "game"),
        (1, 7, dt.date(2024, 1, 20), dt.date(2024, 1, 1), 0, 0, 1, 0, 0, 0, 1, "Other"),
        (2, 7, dt.date(2024, 1, 3), dt.date(2024, 1, 1), 0, 0, 1, 1, 0, 0, 0, "F"),
    ]
    out = journeys.order_journey_rows(spark.createDataFrame(rows, ORDER_SCHEMA), 7).where("order_id = 1").collect()
    assert len(out) == 2 and all(r["seq_g2fv_30d_count"] == 1 for r in out)


TRANS_SCHEMA = "order_id long, user_id long, order_ts timestamp, order_date date, has_fv int, has_game int"


def random_transition_orders(spark, n=1200, users=30, seed=3):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for oid in range(n):
        t = base + dt.timedelta(minutes=rnd.randrange(60 * 24 * 20))
        rows.append((oid, rnd.randrange(users), t, t.date(), int(rnd.random() < 0.4), int(rnd.random() < 0.4)))
    return spark.createDataFrame(rows, TRANS_SCHEMA)


def test_next_flagged_equals_as_of_self_join(spark):
    orders = random_transition_orders(spark)
    win = journeys.next_flagged_orders(orders).where("kind = 'fv2game'") \
        .select("user_id", "source_order_id", "target_order_id")
    lit = literal.next_flagged_selfjoin(orders)
    assert win.count() > 100
    assert win.exceptAll(lit).count() == 0 and lit.exceptAll(win).count() == 0
    swapped = orders.select("order_id", "user_id", "order_ts", "order_date", F.col("has_game").alias("has_fv"),
                            F.col("has_fv").alias("has_game"))
    win2 = journeys.next_flagged_orders(orders).where("kind = 'game2fv'") \
        .select("user_id", "source_order_id", "target_order_id")
    lit2 = literal.next_flagged_selfjoin(swapped)
    assert win2.exceptAll(lit2).count() == 0 and lit2.exceptAll(win2).count() == 0


def test_mixed_basket_is_its_own_successor(spark):
    rows = [(1, 1, dt.datetime(2024, 1, 1, 10), dt.date(2024, 1, 1), 1, 1)]
    out = journeys.next_flagged_orders(spark.createDataFrame(rows, TRANS_SCHEMA)).collect()
    assert {(r["kind"], r["source_order_id"], r["target_order_id"]) for r in out} == {("fv2game", 1, 1),
                                                                                      ("game2fv", 1, 1)}


def test_null_product_name_has_zero_pairs(spark):
    edges = spark.createDataFrame([
        (1, 10, 11, None, "g", 2, "FV→Game"),
        (2, 20, 21, None, "g", 4, "FV→Game"),
        (1, 12, 13, "f", "g", 1, "FV→Game"),
        (3, 30, 31, "f", "g", 40, "FV→Game"),
    ], "user_id long, source_order_id long, target_order_id long, source_product string, target_product string, "
       "days_to_next int, direction string")
    out = {(r["source_product"], r["target_product"]): r for r in journeys.top_transitions(edges, 30, 50).collect()}
    assert out[(None, "g")]["order_pairs"] == 0 and out[(None, "g")]["users"] == 2
    assert out[(None, "g")]["avg_days_to_next"] == 3.0
    assert out[("f", "g")]["order_pairs"] == 1  # the 40-day edge is outside the window


def test_hot_user_window_input_is_bounded_by_days(spark):
    """A user with a third of all orders reaches the per-user window only as one row per day."""
    base = dt.date(2024, 1, 1)
    rows = []
    for oid in range(3000):
        hot = oid % 3 == 0
        user = 0 if hot else 1 + oid % 500
        d = base + dt.timedelta(days=oid % 10)
        rows.append((oid, user, d, d.replace(day=1), 0, 0, 1, oid % 2, 1 - oid % 2, 0, 0, "x"))
    orders = spark.createDataFrame(rows, ORDER_SCHEMA)
    prof = journeys.order_day_profile(orders, 7)
    assert prof.where("user_id = 0").count() == 10  # 1000 orders, 10 days
    # and the per-order answers still equal the literal self join
    win = journeys.order_journey_rows(orders, 7).select(
        "user_id", "order_id", F.col("seq_g2fv_30d_count").alias("seq_g2fv"),
        F.col("seq_fv2g_30d_count").alias("seq_fv2g"))
    lit = literal.followed_within_selfjoin(orders, 7)
    assert win.exceptAll(lit).count() == 0 and lit.exceptAll(win).count() == 0


def test_next_flagged_segments_do_not_change_result(spark):
    orders = random_transition_orders(spark, n=800, users=5, seed=9).cache()
    whole = journeys.next_flagged_orders(orders).collect()
    for size in (1, 7, 150, 170):  # users have about 160 orders each
        assert sorted(journeys.next_flagged_orders(orders, size).collect()) == sorted(whole)


def test_a_hot_hour_is_cut_into_segments(spark):
    """A third of all orders is one user's, all within one hour and half of them in one second; no segment exceeds its size."""
    rnd = random.Random(8)
    base = dt.datetime(2024, 1, 1, 12)
    rows = []
    for oid in range(6000):
        hot = oid % 3 == 0
        t = base + (dt.timedelta(seconds=rnd.choice([1800, rnd.randrange(3600)])) if hot else dt.timedelta(hours=rnd.randrange(2000)))
        rows.append((oid, 0 if hot else 1 + oid % 400, t, t.date(), int(rnd.random() < 0.02), int(rnd.random() < 0.02)))
    orders = spark.createDataFrame(rows, TRANS_SCHEMA).cache()
    got = journeys.next_flagged_orders(orders, 100).select("kind", "user_id", "source_order_id", "target_order_id")
    lit = literal.next_flagged_both(orders).select("kind", "user_id", "source_order_id", "target_order_id")
    assert sorted(got.collect()) == sorted(lit.collect()) and got.where("user_id = 0").count() > 50
    hot = journeys._filled_in_segments(orders.where("user_id = 0"), 100)
    plan = hot._jdf.queryExecution().analyzed().toString()
    assert "_cut" in plan and hot.count() == 2000
    placed = journeys.positions(orders.where("user_id = 0"), ["order_ts", "order_id"], ["user_id"])
    assert placed.groupBy(F.floor(F.col("position") / 100).alias("s")).count().agg(F.max("count")).first()[0] == 100


def test_large_baskets_are_paired_in_blocks(spark):
    """Two orders of hundreds of products, which make nearly all edges: equal rows, spread over the tasks."""
    names = [None] + [f"p{i}" for i in range(299)]
    lines = [(1, n, 1, 0) for n in names] + [(2, f"q{i}", 0, 1) for i in range(200)] + [
        (10 + i, f"p{i}", i % 2, 1 - i % 2) for i in range(60)] + [(1, "p1", 1, 0)]
    lines = spark.createDataFrame(lines, "order_id long, product_name string, is_fv int, is_game int").cache()
    day = dt.date(2024, 1, 1)
    pairs = [("fv2game", 5, 1, day, 2, day), ("game2fv", 5, 2, day, 1, day)] + [
        ("fv2game", 6, 11 + 2 * i, day, 10 + 2 * i, day) for i in range(20)] + [("fv2game", 7, 11, day, 2, day)]
    pairs = spark.createDataFrame(pairs, "kind string, user_id long, source_order_id long, source_date date, target_order_id long, "
                                         "target_date date").cache()
    plain = journeys.transition_edges(pairs, lines, "a", "b")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = journeys.transition_edges(pairs, lines, "a", "b", block=20)
        sizes = cut.groupBy(F.spark_partition_id()).count().orderBy(F.desc("count")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert plain.count() == 2 * 300 * 200 + 20 + 200
    assert plain.exceptAll(cut).isEmpty() and cut.exceptAll(plain).isEmpty()
    assert sizes[0]["count"] < 0.5 * plain.count()


def test_next_flagged_within_one_day_is_linear_and_exact(spark):
    """All orders of one user fall on one day; the answer is compared with a backward scan in plain Python."""
    import random
    import time

    def run(n):
        rnd = random.Random(n)
        rows = []
        for oid in range(n):
            t = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randrange(86_400))
            rows.append((oid, 7, t, t.date(), int(rnd.random() < 0.01), int(rnd.random() < 0.01)))
        df = spark.createDataFrame(rows, TRANS_SCHEMA).repartition(4).cache()
        df.count()
        began = time.time()
        got = {(r["kind"], r["source_order_id"]): r["target_order_id"] for r in journeys.next_flagged_orders(df, n // 3).collect()}
        took = time.time() - began
        want, game, fv = {}, None, None
        for oid, _, _, _, has_fv, has_game in sorted(rows, key=lambda r: (r[2], r[0]), reverse=True):
            game, fv = (oid if has_game else game), (oid if has_fv else fv)
            if has_fv and game is not None:
                want["fv2game", oid] = game
            if has_game and fv is not None:
                want["game2fv", oid] = fv
        assert got == want
        return took

    run(1000)
    small = run(10_000)
    assert run(40_000) < 4 * small + 3


def test_report_sort_splits_a_month(spark):
    rows = [(i, i % 50, dt.date(2024, 1, 1), "game") for i in range(4000)]
    df = spark.createDataFrame(rows, "order_id long, user_id long, order_month date, order_type string").selectExpr(
        "*", "cast(1 as decimal(18,2)) AS order_revenue_total", "cast(1 as decimal(18,2)) AS order_margin_total",
        "cast(null as decimal(18,0)) AS days_since_prev_order", "0 AS seq_g2fv_30d_count", "0 AS seq_fv2g_30d_count",
        "0 AS has_fv", "0 AS has_other", "0 AS has_dlc", "1 AS has_game", "order_month AS first_order_month")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = journeys.order_journey_report(df)
        sizes = [n for n in out.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect() if n]
        assert len(sizes) > 1 and max(sizes) < 3000
        got = [(r["user_id"], r["order_id"]) for r in out.collect()]
        assert got == sorted(got)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

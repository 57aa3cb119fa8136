import datetime as dt

from tillroll.operators import segments


def test_segment_rules_and_order_type(spark):
    lines = spark.createDataFrame([
        (1, 10, dt.datetime(2024, 1, 5), 1, 1, 100, 30, "COMPLETE"),   # flagship product
        (2, 10, dt.datetime(2024, 1, 6), 2, 1, 100, 30, "COMPLETE"),   # two types -> fans out
        (3, 11, dt.datetime(2024, 1, 6), 3, 1, 100, 30, "COMPLETE"),   # 'Game' capitalised: neither game nor Other
        (4, 11, dt.datetime(2024, 1, 7), 4, 1, 100, 30, "COMPLETE"),   # no collection, no type -> Unknown
        (5, 11, dt.datetime(2024, 1, 8), 5, 1, 100, 30, "COMPLETE"),   # collection row but not flagship -> Other
        (6, 11, dt.datetime(2024, 1, 9), 6, 1, 100, 30, "REFUNDED"),   # filtered by status
    ], "order_id long, user_id long, order_date timestamp, product_id long, units int, revenue_ex_vat long, "
       "margin long, status string")
    colls = spark.createDataFrame([(1, "Flag"), (1, "Other"), (5, "Catalogue")], "product_id long, collection string")
    prods = spark.createDataFrame([(1, "a", "game"), (2, "b", "game"), (2, "b", "dlc"), (3, "c", "Game"),
                                   (4, "d", None), (5, "e", None)],
                                  "product_id long, name string, product_type string")
    x = segments.journey_lines(lines, colls, prods, "Flag", "2024-01-01", "2024-02-01")
    seg = {(r["order_id"], r["segment_final"]) for r in x.collect()}
    assert (1, "Flag") in seg and (2, "game") in seg and (2, "dlc") in seg
    assert (3, "Game") in seg and (4, "Unknown") in seg and (5, "Other") in seg
    assert all(o != 6 for o, _ in seg)
    o = {r["order_id"]: r["order_type"] for r in segments.order_rollup(x, "Flag").collect()}
    assert o == {1: "Flag", 2: "Mixed", 3: "Unknown", 4: "Unknown", 5: "Other"}


def test_bare_numeric_rounds_totals(spark):
    lines = spark.createDataFrame([(1, 1, dt.datetime(2024, 1, 5), 1, 1, 150, 49, "COMPLETE")],
                                  "order_id long, user_id long, order_date timestamp, product_id long, units int, "
                                  "revenue_ex_vat long, margin long, status string")
    colls = spark.createDataFrame([(1, "X")], "product_id long, collection string")
    prods = spark.createDataFrame([(1, "a", "game")], "product_id long, name string, product_type string")
    x = segments.journey_lines(lines, colls, prods, "X", "2024-01-01", "2024-02-01")
    r = segments.order_rollup(x, "X").collect()[0]
    assert float(r["order_revenue_total"]) == 2.0 and float(r["order_margin_total"]) == 0.0
    r4 = segments.order_rollup(x, "X", bare_numeric="decimal(18,4)").collect()[0]
    assert float(r4["order_revenue_total"]) == 1.5 and float(r4["order_margin_total"]) == 0.49

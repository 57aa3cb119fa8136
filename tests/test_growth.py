"""What must not grow with the tables: rows of a bucket, scans of the order lines. Each test writes its own tables."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from tillroll.operators import reconcile
from tillroll.plans import params as P
from tillroll.plans import queries, reports
from tillroll.sources import fixtures as fx
from tillroll.sources import sinks, tables
from tillroll.sources.tables import Tables


@pytest.fixture(scope="module")
def sales_dir(spark):
    """Orders of three months with up to 7 lines; some order and product keys repeat, some cells are null."""
    out = tempfile.mkdtemp(prefix="tillroll-sales-")
    names = ["red widget", "hot rod", "blue gadget", "green gear", "small lamp"]
    part = [(k, names[k % 5], f"Brand#{k % 20}", ["LARGE TIN", "PROMO BRASS"][k % 2], k % 50) for k in range(1, 41)]
    orders = [(k, k % 30, "OFP"[k % 3], 100.0 + k, dt.datetime(1998, 6 + k % 3, 1 + k % 28)) for k in range(1, 121)]
    lines = [(k, 1 + (k * 3 + n) % 40 if n != 6 else None, k % 9, n, float(n), 10.0 * k + n, (k + n) % 10 / 100, n % 5 / 100,
              "RAN"[(k + n) % 3], "OF"[k % 2], dt.datetime(1998, 6 + (k + n) % 3, 1 + k % 28))
             for k in range(1, 121) for n in range(1, 2 + k % 7)]
    for name, rows, schema in (
            ("part", part + [part[4], part[9]], "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
            ("orders", orders + [orders[0], orders[1], (None, 1, "O", 5.0, dt.datetime(1998, 7, 5)), (500, 2, "F", 5.0, None)],
             "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp"),
            ("lineitem", lines + [lines[7], lines[30], (None, 1, 1, 1, 1.0, 5.0, 0.1, 0.0, "R", "O", dt.datetime(1998, 7, 5))],
             "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
             "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")):
        spark.createDataFrame(rows, schema).write.parquet(f"{out}/{name}.parquet")
    return out


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_buckets_grow_with_the_order_lines(spark, sales_dir, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_ROWS", 10, raising=False)
    kept = []
    monkeypatch.setattr(queries, "write_bucketed", lambda *a: kept.append(tables.write_bucketed(*a)) or kept[-1])
    found = _rows(queries.queries()["overcharge_from_buckets"](spark, sales_dir))
    sizes = [r["count"] for r in kept[0].groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) > 400 and max(sizes) <= 30  # 8 buckets have over 50 rows each
    assert found == _rows(queries.queries()["overcharge_by_title"](spark, sales_dir)) and len(found) == 5
    assert tables.bucket_count(81, 8) == 9 and tables.bucket_count(0) == 1
    assert tables.bucket_count(10 ** 15) == tables.MAX_BUCKETS


def test_kept_lines_are_shuffled_in_few_columns(spark, sales_dir, monkeypatch):
    """what is dealt to the buckets has the columns of lineitem and orders, whole rows are kept, and they aren't dealt again."""
    dealt, kept = [], []
    monkeypatch.setattr(queries, "write_bucketed", lambda *a: dealt.append(a[0]) or kept.append(tables.write_bucketed(*a)) or kept[-1])
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "12"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = queries.queries()["overcharge_from_buckets"](spark, sales_dir)
        plan = found._jdf.queryExecution().executedPlan().toString()
        above = plan[:plan.index("lines_by_iid_")].rsplit("SortMergeJoin", 1)[1]  # from the nearest join down to the kept lines
        assert "LeftSemi" in above.split("\n")[0] and "Exchange" not in above  # 8 buckets, 12 shuffle partitions
        t = Tables(spark, sales_dir)
        assert not [f for f in dealt[0].inputFiles() if "part.parquet/" in f] and len(dealt[0].columns) <= 15
        every = fx.order_details(t)
        assert kept[0].columns == every.columns and _rows(kept[0]) == _rows(every)
        assert 1 < len(kept[0].inputFiles()) <= queries.LINE_BUCKETS  # a bucket is one file
        assert _rows(found) == _rows(queries.queries()["overcharge_by_title"](spark, sales_dir))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_frequent_key_is_dealt_to_a_bucket_once(spark):
    """the distributor writes 'unknown' for many items."""
    big = spark.range(60).selectExpr("concat('i', id) AS iid", "id AS amount").union(spark.sql("SELECT 'unknown', 1L"))
    keys = spark.range(500).selectExpr("CASE WHEN id % 5 > 0 THEN 'unknown' WHEN id > 50 THEN concat('i', id) END AS iid")
    found = reconcile.reduce_to_keys(big, keys, "iid", 3)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert -1 < plan.find("RepartitionByExpression") < plan.find("Aggregate [iid")  # distinct below it
    assert _rows(found) == _rows(reconcile.reduce_to_keys(big, keys, "iid")) and found.count() == 2


def test_order_lines_are_joined_once_for_the_publisher(spark, sales_dir, monkeypatch):
    """the report and the own sales of a month come from one scan of the order lines."""
    _joined_once(spark, sales_dir, monkeypatch, "adjusted_comparison")


def _joined_once(spark, sales_dir, monkeypatch, name):
    plain = fx.order_details
    t = Tables(spark, sales_dir)
    v1 = name.endswith("_v1")
    apart = reports.PublisherReconciliation(
        fx.publisher_report(t, P.RECON_START, P.RECON_END, plain(t)), fx.shop_orders(t), fx.sales_lines(t), fx.products(t),
        fx.suppliers(t), as_of=P.RECON_AS_OF, partner_flag=P.PARTNER_FLAG, threshold=P.MATCH_THRESHOLD,
        promo_publisher=P.PROMO_PUBLISHER_V1 if v1 else P.PROMO_PUBLISHER, promo_supplier=P.PROMO_SUPPLIER,
        overrides=P.PUBLISHER_OVERRIDES, variant="v1" if v1 else "v2").adjusted()
    expected = _rows(sinks.sheet_rows(apart) if name == "sheet_rows" else queries.decimals_as_double(apart))
    for most in (fx.BROADCAST_ORDERS, 0):  # the month's orders broadcast, and shuffled
        monkeypatch.setattr(fx, "BROADCAST_ORDERS", most)
        joins = []
        monkeypatch.setattr(fx, "order_details", lambda *a: joins.append(1) or plain(*a))
        found = queries.queries()[name](spark, sales_dir)
        assert joins == [1]
        assert not [f for f in found.inputFiles() if "lineitem" in f]
        assert _rows(found) == expected and len(expected) > 10


def test_lines_of_all_times_are_not_shuffled_for_a_month(spark, sales_dir, monkeypatch):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(kept, ("-1", "false")):
            spark.conf.set(k, v)
        plans = []
        for most in (fx.BROADCAST_ORDERS, 0):
            monkeypatch.setattr(fx, "BROADCAST_ORDERS", most)
            t = Tables(spark, sales_dir)
            lines = fx.order_details(t, fx.month_orders(t, P.RECON_START, P.RECON_END))
            plans.append((lines._jdf.queryExecution().executedPlan().toString(), _rows(lines)))
        every = fx.order_details(t).where("order_date >= '1998-07-01' AND order_date < '1998-08-01'")
        assert "BroadcastHashJoin" in plans[0][0] and "Exchange hashpartitioning" not in plans[0][0]
        assert "SortMergeJoin" in plans[1][0]
        assert plans[0][1] == plans[1][1] == _rows(every) and len(plans[0][1]) > 100
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_order_lines_are_joined_once_for_the_first_script(spark, sales_dir, monkeypatch):
    """F3, and the blocking and names of the first script."""
    _joined_once(spark, sales_dir, monkeypatch, "adjusted_comparison_v1")


def test_order_lines_are_joined_once_for_the_sheet(spark, sales_dir, monkeypatch):
    """F4, every cell as text."""
    _joined_once(spark, sales_dir, monkeypatch, "sheet_rows")

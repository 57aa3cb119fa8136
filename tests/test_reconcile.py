import datetime as dt
from decimal import Decimal as D

import pytest

from tillroll.operators import reconcile
from tillroll.sources import contracts


def _report(spark, drop=None, qty="1", svc="n/a"):
    cols = list(contracts.DISTRIBUTOR_COLUMNS)
    vals = {c: "0" for c in cols}
    vals.update({"CTID": "12x1-7", "Product Title": "T", "Activation Qty": qty, "WSP Billing Currency": "1.50",
                 "Service Charge Billing Currency": svc, "Original Date of Sale": "2024-07-02",
                 "Date of Sale": "not a date", "Activation Currency": "USD"})
    if drop:
        cols.remove(drop)
    return spark.createDataFrame([tuple(vals[c] for c in cols)], ", ".join(f"`{c}` string" for c in cols))


def test_missing_column_raises(spark):
    with pytest.raises(contracts.MissingColumnsError, match="CTID"):
        contracts.read_distributor_report(_report(spark, drop="CTID"))


def test_lenient_typing_and_aggregate(spark):
    typed = contracts.read_distributor_report(_report(spark))
    r = typed.collect()[0]
    assert r["date_of_sale"] is None and r["service_charge_billing_currency"] is None
    assert r["original_date_of_sale"] == dt.date(2024, 7, 2)
    agg = reconcile.partner_aggregate(typed).collect()[0]
    assert agg["iid"] == "12x1" and agg["genba_reported_royalty"] == D("1.5")
    assert reconcile.partner_aggregate(contracts.read_distributor_report(_report(spark, qty="0"))).count() == 0


def test_trim_headers(spark):
    df = spark.createDataFrame([(1,)], "` Publisher Name ` int")
    assert contracts.trim_headers(df).columns == ["Publisher Name"]


def test_promo_adjustment_rules(spark):
    rep = spark.createDataFrame([
        ("Big Pub", "USD", D("10.000"), "i1", "Summer", "Sold"),   # our item has no promo -> adjusted to our royalty
        ("Big Pub", "USD", D("20.000"), "i2", "Summer", "Sold"),   # unknown item -> price becomes null (S21)
        ("Big Pub", "USD", D("30.000"), "i3", "", "Sold"),         # no promo in the report -> unchanged
        ("Big Pub", "USD", D("40.000"), None, "Summer", "Sold"),   # null reference matches a null iid (J20)
        ("Other", "USD", D("50.000"), "i1", "Summer", "Sold"),     # other publisher -> not selected
    ], "`Publisher Name` string, `Invoicing Currency` string, `Purchase Price In Invoicing Currency` decimal(20,3), "
       "`Client Order Reference` string, `Promotion Name` string, Status string")
    promo = spark.createDataFrame([("i1", None, D("7.00")), ("i3", "p", D("1.00")), (None, "", D("3.00"))],
                                  "iid string, promo_name string, royalties decimal(20,2)")
    out = {r["Client Order Reference"]: r for r in reconcile.promo_adjusted_detail(rep, promo, publisher="big pub")
           .collect()}
    assert len(out) == 4
    assert out["i1"]["Purchase Price In Invoicing Currency"] == D("7.000") and out["i1"]["Status"] == "Adjusted"
    assert out["i2"]["Purchase Price In Invoicing Currency"] is None and out["i2"]["Status"] == "Adjusted"
    assert out["i3"]["Status"] == "Sold" and out[None]["Purchase Price In Invoicing Currency"] == D("3.000")


def test_partner_totals_keep_currency_spellings(spark):
    rep = spark.createDataFrame([("P", " usd", D("1")), ("P", "USD", D("2")), ("P", None, D("4")), (None, "USD", D("8"))],
                                "`Publisher Name` string, `Invoicing Currency` string, "
                                "`Purchase Price In Invoicing Currency` decimal(10,2)")
    rows = sorted((r["Invoicing Currency"], float(r["Purchase Price In Invoicing Currency"]))
                  for r in reconcile.partner_totals(rep).collect())
    assert rows == [("USD", 1.0), ("USD", 2.0)]


def test_lines_in_buckets_are_joined_without_a_shuffle(spark):
    import tempfile

    from tillroll.sources.tables import write_bucketed

    lines = spark.range(5000).selectExpr("concat('i', id % 1700) AS iid", "id AS amount")
    keys = spark.range(40).selectExpr("concat('i', id * 50) AS iid")
    kept = write_bucketed(lines, "lines_by_iid_test", "iid", 6, tempfile.mkdtemp(prefix="tillroll-buckets-") + "/t")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = reconcile.reduce_to_keys(kept, keys, "iid")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        plain = reconcile.reduce_to_keys(lines, keys, "iid")
        side = plan[plan.index("SortMergeJoin"):].split("Scan parquet")[0]  # the path from the join down to the line table
        assert "Exchange" not in side and "Bucketed: true" in plan
        assert sorted(joined.collect()) == sorted(plain.collect()) and joined.count() == 100
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        spark.sql("DROP TABLE lines_by_iid_test")


def test_reduce_to_keys(spark):
    big = spark.createDataFrame([(f"i{i}", i) for i in range(100)], "iid string, v int")
    keys = spark.createDataFrame([("i1",), ("i5",), (None,), ("zz",)], "iid string")
    assert sorted(r["iid"] for r in reconcile.reduce_to_keys(big, keys, "iid").collect()) == ["i1", "i5"]


def test_lines_are_reduced_before_any_join(spark, sf001):
    from tillroll.plans import queries

    plan = queries.queries()["overcharge_detail"](spark, sf001)._jdf.queryExecution().optimizedPlan().toString()
    at = [i for i, x in enumerate(plan.split("\n")) if "LeftSemi" in x]
    others = [i for i, x in enumerate(plan.split("\n")) if "Join LeftOuter" in x]
    assert len(at) == 1 and at[0] > max(i for i in others if i < at[0]) and len([i for i in others if i < at[0]]) >= 5


def test_first_script_switches(spark):
    rep = spark.createDataFrame([
        ("Big Pub", "USD", D("10.000"), "i1", "Summer", "Sold"),
        ("Big Pub Games", "USD", D("20.000"), "i1", "Summer", "Sold"),
    ], "`Publisher Name` string, `Invoicing Currency` string, `Purchase Price In Invoicing Currency` decimal(20,3), "
       "`Client Order Reference` string, `Promotion Name` string, Status string")
    promo = spark.createDataFrame([("i1", None, D("7.00"))], "iid string, promo_name string, royalties decimal(20,2)")
    v2 = reconcile.promo_adjusted_detail(rep, promo, publisher="big pub")
    v1 = reconcile.promo_adjusted_detail(rep, promo, publisher="big pub", match="equals", keep_promo_name=True)
    assert v2.count() == 2 and v1.count() == 1 and "promo_name" in v1.columns and "promo_name" not in v2.columns

    comparison = spark.createDataFrame([("Big Pub", "USD", D("10.000"), D("9.00"), D("5.00")),
                                        ("Other", "USD", D("1.000"), D("1.00"), D("0.50"))],
                                       "`Publisher Name` string, `Invoicing Currency` string, "
                                       "`Purchase Price In Invoicing Currency` decimal(20,3), "
                                       "`Converted to GBP` decimal(20,2), royalties decimal(20,2)")
    with_fb = {r["Publisher Name"]: r["adjusted_difference"] for r in
               reconcile.adjusted_comparison(comparison, v1).collect()}
    no_fb = {r["Publisher Name"]: r["adjusted_difference"] for r in
             reconcile.adjusted_comparison(comparison, v1, fallback=False).collect()}
    assert with_fb == {"Big Pub": D("2.00"), "Other": D("0.50")}
    assert no_fb["Big Pub"] == D("2.00") and no_fb["Other"] is None


def test_royalty_totals_name_source(spark):
    od = spark.createDataFrame([(1, dt.datetime(2024, 7, 3), "COMPLETE", 250, "line name"),
                                (1, dt.datetime(2024, 7, 4), "CANCELLED", 999, "line name")],
                               "product_id long, order_date timestamp, status string, royalty long, supplier_name string")
    prods = spark.createDataFrame([(1, "s1")], "product_id long, supplier_id string")
    sups = spark.createDataFrame([("s1", "Supplier One", True)], "supplier_id string, supplier_name string, vaultn boolean")
    kw = dict(start="2024-07-01", end="2024-08-01")
    by_sup = reconcile.supplier_royalty_totals(od, prods, sups, partner_flag="vaultn", **kw).collect()
    by_line = reconcile.supplier_royalty_totals(od, prods, sups, name_from="line", partner_flag="vaultn", **kw).collect()
    assert [(r["supplier_name"], r["royalties"]) for r in by_sup] == [("Supplier One", D("2.50"))]
    assert [(r["supplier_name"], r["royalties"]) for r in by_line] == [("line name", D("2.50"))]


LINE_SCHEMA = ("iid string, product_name string, product_id long, royalty long, revenue_ex_vat_pf long, "
               "royalty_percentage decimal(6,2), order_date timestamp, status string, order_id long, currency string, "
               "bundle_name string, promo_name string, vat_rate decimal(4,2), transaction_fee int")


def test_distributor_terms_and_variances(spark):
    """S16 fan-out, S17 service charge as percent and as fraction, S18 old_order, S29 null CTID."""
    lines = spark.createDataFrame([
        ("10x1", "T", 1, 800, 1000, D("0.20"), dt.datetime(2024, 7, 2), "COMPLETE", 10, "USD", None, None, D("0.2"), 50),
        ("10x1", "T", 1, 800, 1000, D("0.20"), dt.datetime(2024, 7, 20), "COMPLETE", 11, "EUR", None, None, D("0.2"), 50),
    ], LINE_SCHEMA)
    products = spark.createDataFrame([(1, "s1")], "product_id long, supplier_id string")
    suppliers = spark.createDataFrame([("s1", "S", D("12.00"), True)],
                                      "supplier_id string, supplier_name string, genba_service_charge decimal(5,2), "
                                      "allows_transaction_fees boolean")
    discounts = spark.createDataFrame([], "product_id long, star_deal boolean, discount_percent decimal(5,2), "
                                          "self_funded_percent decimal(5,2), product_discount_self_fund_percent decimal(5,2)")
    stars = spark.createDataFrame([], "product_id long")
    terms = reconcile.order_line_terms(lines, products, suppliers, discounts, stars, start="2024-07-01", end="2024-08-01")
    t = terms.collect()[0]
    # (1 - 0.2) * 12 / 100 + 0.2 for the assumed royalty, (1 - 0.2) * 12 + 0.2 for the blended rate
    assert t["fanatical_assumed_royalty"] == D("10.00") * (D("0.8") * D("0.12") + D("0.2"))
    assert t["blended_rate"] == D("0.8") * D("12") + D("0.2")
    assert t["allowable_transaction_fee"] == D("0.50") and t["fanatical_reported_royalty"] == D("8.00")

    partner = spark.createDataFrame([
        ("10x1-7", "10x1", "T", "g1", dt.date(2024, 7, 4), "GB", "USD", D("1"), D("9.5")),
        (None, None, "U", "g2", dt.date(2024, 7, 4), "GB", "USD", D("1"), D("3.0")),
    ], "ctid_1 string, iid string, product_title string, genba_product_id string, original_date_of_sale date, "
       "country_sold string, genba_currency string, activation_qty decimal(10,2), genba_reported_royalty decimal(10,2)")
    detail = reconcile.overcharge_detail(partner, terms).collect()
    matched = sorted((r for r in detail if r["iid"] == "10x1"), key=lambda r: r["order_id"])
    assert len(matched) == 2  # S16: one partner row, two own lines
    assert [r["old_order"] for r in matched] == [True, False]  # S18: |Jul 4 - Jul 2| < 3, |Jul 4 - Jul 20| >= 3
    assert matched[0]["overcharge"] == D("1.50") and matched[0]["overcharge_after_transaction_fee_handling"] == D("1.00")
    assert matched[0]["currency_match"] is True and matched[1]["currency_match"] is False
    orphan = [r for r in detail if r["iid"] is None][0]  # S29: a null CTID matches nothing, stays null
    assert orphan["order_id"] is None and orphan["overcharge"] == D("3.00") and orphan["overcharge_perc"] is None
    totals = {r["product_title"]: r["Total Overcharge"] for r in reconcile.overcharge_by_title(
        reconcile.overcharge_detail(partner, terms)).collect()}
    assert totals == {"T": D("2.00"), "U": D("3.00")}  # the repeated partner amount inflates the total (S16)

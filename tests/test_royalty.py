import datetime as dt
from decimal import Decimal as D

from tillroll.operators import fx, royalty

SALES = ("order_id long, product_id long, order_date timestamp, status string, drivethrurpg boolean, supplier_name string, "
         "product_name string, promo_name string, bundle_name string, revenue_ex_vat_pf long, transaction_fee int, "
         "affiliate_commission decimal(4,2), affiliate_fee decimal(4,2), exclusivity_fee long, royalty_percentage "
         "decimal(6,2), fixed_royalty_currency string, first_refund timestamp, first_fraud timestamp, "
         "first_chargeback timestamp")
ORDERS = "order_date timestamp, currency string, local_price double, revenue_inc_vat double"


def _products(spark):
    return spark.createDataFrame([(1, None, "SKU-1"), (2, 978, "SKU-2")], "product_id long, isbn long, sku string")


def test_rate_fallback_and_missing_rate(spark):
    d1, d2, d3 = dt.datetime(2024, 7, 1), dt.datetime(2024, 7, 2), dt.datetime(2024, 7, 3)
    sales = spark.createDataFrame([
        (1, 1, d1, "COMPLETE", True, "S", "P", None, None, 1000, 100, D('0.5'), None, 50, D('0.1'), None, None, None, None),
        (2, 1, d2, "COMPLETE", True, "S", "P", None, None, 1000, None, None, None, 50, D('0.1'), None, None, None, None),
        (3, 2, d3, "COMPLETE", True, "S", "Q", None, "B", 2000, None, None, None, 100, D('0.1'), None, None, None, None),
    ], SALES)
    shop = spark.createDataFrame([(d1, "USD", 1.2, 1.0), (d1, "USD", 1.4, 1.0), (d2, "USD", 5.0, 0.0)], ORDERS)
    out = {r["name"]: r for r in royalty.royalty_statement(sales, _products(spark), shop, channel_col="drivethrurpg", start="2024-07-01",
                                                           end="2024-08-01", as_of="2024-07-01").collect()}
    p = out["P"]
    # day 1: rate 1.3; day 2: zero denominator -> null daily rate -> fallback (as-of day 1) 1.3
    assert p["qty"] == 2 and p["value"] == 26.0 and p["deductions"] == 1.95
    assert p["net"] == 24.05 and p["royalty"] == 1.3 and p["sku"] == "SKU-1" and not p["in_bundle"]
    q = out["Q\n in B"]
    assert q["value"] == 26.0 and q["sku"] == "978" and q["in_bundle"]


def test_no_rate_at_all_keeps_count(spark):
    d = dt.datetime(2024, 7, 5)
    sales = spark.createDataFrame([(1, 1, d, "COMPLETE", True, "S", "P", "X", None, 1000, None, None, None, 50, D("0.1"),
                                    None, None, None, None)], SALES)
    shop = spark.createDataFrame([], ORDERS)
    r = royalty.royalty_statement(sales, _products(spark), shop, channel_col="drivethrurpg", start="2024-07-01", end="2024-08-01",
                                  as_of="2024-07-01").collect()[0]
    assert r["qty"] == 1 and r["value"] is None and r["name"] == "P\n in X"


def test_refund_sign_table(spark):
    d = dt.datetime(2024, 6, 1)
    ev = dt.datetime(2024, 7, 10, 15, 0)
    sales = spark.createDataFrame([
        (1, 1, d, "REFUNDED", True, "S", "P", None, None, 1000, 100, None, None, 50, D('0.1'), None, ev, None, None),
        (2, 1, d, "REFUNDED", True, "S", "P", None, "B", 1000, 100, None, None, 50, D('0.0'), None, ev, None, None),
        (3, 1, d, "COMPLETE", True, "S", "P", None, None, 1000, 100, None, None, 50, D('0.1'), None, ev, None, None),
        (4, 1, d, "REFUNDED", True, "S", "P", None, None, 1000, 100, None, None, 50, D('0.1'), None,
         dt.datetime(2024, 8, 1), None, None),
    ], SALES)
    shop = spark.createDataFrame([(d, "USD", 2.0, 1.0)], ORDERS)
    notes = spark.createDataFrame([(1, dt.date(2024, 7, 20), "Partial refund of 1")], "order_id long, date date, note string")
    out = royalty.refund_statement(sales, _products(spark), shop, notes, channel_col="drivethrurpg", min_order_date="2024-01-01",
                                   event_from="2024-07-01", event_to="2024-07-31", as_of="2024-06-01").collect()
    assert len(out) == 1  # bundle with 0 royalty dropped, COMPLETE dropped, August event dropped
    r = out[0]
    assert r["qty"] == -1 and r["value"] == 20.0 and r["deductions"] == -2.0 and r["net"] == -18.0
    assert r["exclusivity_fee"] == -1.0 and r["drivethru_percentage"] == 0.05


def test_as_of_rate_pick(spark):
    rates = spark.createDataFrame([("EUR", dt.date(2024, 1, 1), 0.8), ("EUR", dt.date(2024, 3, 1), 0.9),
                                   ("EUR", dt.date(2024, 5, 1), 1.0)], "currency string, rate_date date, rate_to_gbp double")
    r = fx.as_of_rates(rates, "2024-04-15").collect()
    assert [(x["currency"], x["rate_to_gbp"]) for x in r] == [("EUR", 0.9)]


def test_net_is_rounded_on_its_own(spark):
    """net = round(sum value - sum deductions), so it can differ by a cent from value - deductions."""
    d = dt.datetime(2024, 7, 1)
    # value 2002 c x 0.25 = 5.005 -> 5.01; deductions 1 c x 0.25 = 0.0025 -> 0.00; net round(5.0025) = 5.00
    sales = spark.createDataFrame([(1, 1, d, "COMPLETE", True, "S", "P", None, None, 2002, 1, None, None, 0,
                                    D("0.1"), None, None, None, None)], SALES)
    shop = spark.createDataFrame([(d, "USD", 0.25, 1.0)], ORDERS)
    r = royalty.royalty_statement(sales, _products(spark), shop, channel_col="drivethrurpg", start="2024-07-01", end="2024-08-01",
                                  as_of="2024-07-01").collect()[0]
    assert (r["value"], r["deductions"], r["net"]) == (5.01, 0.0, 5.0)

"""Adapter views: the driver's TPC-H-like and event tables mapped onto the logical inputs of the reports.

The reports read order lines, products, collections, shop orders, notes, suppliers, discounts and partner reports. The
test data has none of these, so each view derives one from the given tables with plain column expressions; the same
definitions are written in DuckDB SQL in `tillroll.plans.oracle_sql` for the independent check. All views are lazy, save that
a month's orders are counted, and grow with the input tables.

The modulo expressions below assign fixture attributes (status, currency, channel flag, which products have a
collection row or a discount), as FIXTURES.md §2 prescribes; they do not sample rows. Every registered query runs over
all rows of the tables it reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.sources.tables import Tables

# Fixed values of the fixture mapping (label vocabularies of the reports' inputs).
SE_LABELS = {
    "view": "input-focused",
    "click": "input-changed",
    "signup": "suggestions-revealed",
    "purchase": "enter",
    "error": "click-search-icon",
}
PRODUCT_TYPES = {"STANDARD": "game", "LARGE": "game", "MEDIUM": "dlc", "PROMO": "Gift-Card", "SMALL": "book"}
ORDER_STATUS = {"O": "COMPLETE", "F": "REFUNDED", "P": "CANCELLED"}
CURRENCY_BY_KEY_MOD5 = ["USD", "USD", "EUR", "GBP", "AUD"]
FLAGSHIP_COLLECTION = "Flagship"
#: Most orders of a period that are broadcast to all order lines (some 50 bytes each); beyond it both are shuffled.
BROADCAST_ORDERS = 1_000_000


def _map(col: Column, mapping: dict) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr


def session_id(user: Column, ts: Column) -> Column:
    return (user * 100 + F.dayofmonth(ts)).cast("bigint")


# ---------------------------------------------------------------- events based views

def search_events(t: Tables) -> DataFrame:
    """silver_atomic_events: derived_tstamp, domain_sessionid, se_label."""
    e = t.events
    return e.select(
        e.ts.alias("derived_tstamp"),
        session_id(e.user_id, e.ts).cast("string").alias("domain_sessionid"),
        F.when((e.event_type == "error") & (e.user_id % 3 == 0), "click-view-all")
        .otherwise(_map(e.event_type, SE_LABELS)).alias("se_label"),
    )


def baskets(t: Tables) -> DataFrame:
    """order_details at line grain built from purchase events (one order per user and day)."""
    e = t.events.where(F.col("event_type") == "purchase")
    return e.select(
        session_id(e.user_id, e.ts).alias("order_id"),
        e.user_id,
        e.ts.alias("order_date"),
        F.get_json_object(e.props, "$.k").cast("int").cast("bigint").alias("product_id"),
        F.lit(1).alias("units"),
        F.round(e.value * 100).cast("bigint").alias("revenue_ex_vat"),
        F.round(e.value * 30).cast("bigint").alias("margin"),
        F.when(e.event_id % 10 != 0, "COMPLETE").otherwise("REFUNDED").alias("status"),
    )


def products(t: Tables) -> DataFrame:
    p = t.part
    kind = F.split(p.p_type, " ").getItem(0)
    return p.select(
        p.p_partkey.alias("product_id"),
        p.p_name.alias("name"),
        _map(kind, PRODUCT_TYPES).alias("product_type"),
        F.concat(F.lit("SKU-"), p.p_partkey.cast("string")).alias("sku"),
        F.when(p.p_size % 3 == 0, F.lit(9780000000000) + p.p_partkey).alias("isbn"),
        p.p_name.alias("supplier_id"),
    )


def product_collections(t: Tables) -> DataFrame:
    p = t.part.where(F.col("p_partkey") % 10 != 0)
    brand_no = F.substring(p.p_brand, 7, 3).cast("int")
    return p.select(
        p.p_partkey.alias("product_id"),
        F.when(brand_no <= 8, F.lit(FLAGSHIP_COLLECTION)).otherwise(F.lit("Catalogue")).alias("collection"),
    )


# ---------------------------------------------------------------- sales based views (P1 on sales, P3, P4, P6-P8)

def _currency(orderkey: Column) -> Column:
    m = orderkey % 5
    expr = None
    for i, c in enumerate(CURRENCY_BY_KEY_MOD5):
        expr = F.when(m == i, F.lit(c)) if expr is None else expr.when(m == i, F.lit(c))
    return expr


def order_lines(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Lineitem joined to orders, or to some `orders` of them (inner equi join on the order key), in those tables' own columns."""
    li = t.lineitem
    o = (t.orders if orders is None else orders).select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    return li.join(o, li.l_orderkey == o.o_orderkey)


def line_iid() -> Column:
    """The item id of a row of `order_lines`."""
    return F.concat(F.col("l_orderkey").cast("string"), F.lit("x"), F.col("l_linenumber").cast("string"))


def order_details(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Sales order lines of all orders, or of some `orders`."""
    return line_columns(order_lines(t, orders))


def line_columns(j: DataFrame) -> DataFrame:
    """The columns of order_details from rows of `order_lines`, which are half as wide."""
    rev = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100).cast("bigint")
    status = _map(F.col("o_orderstatus"), ORDER_STATUS)
    base = j.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("units"),
        rev.alias("revenue_ex_vat"),
        status.alias("status"),
        (F.col("l_suppkey") % 4 == 0).alias("drivethrurpg"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("bundle "), F.col("l_linestatus"))).alias("bundle_name"),
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("promo "), F.col("l_linenumber").cast("string")))
        .alias("promo_name"),
        F.when(F.col("l_linenumber") != 7, F.col("l_discount").cast("decimal(4,2)") * 5).alias("royalty_percentage"),
        F.when(F.col("l_linenumber") != 3, F.col("l_linenumber") * 10).alias("transaction_fee"),
        F.col("l_tax").cast("decimal(4,2)").alias("affiliate_commission"),
        F.when(F.col("l_linenumber") % 2 == 1, F.lit(0.01).cast("decimal(4,2)")).alias("affiliate_fee"),
        F.when(status == "REFUNDED", F.col("l_shipdate")).alias("first_refund"),
        F.when((status == "CANCELLED") & (F.col("l_linenumber") % 2 == 0),
               F.col("l_shipdate") + F.expr("INTERVAL 5 DAYS")).alias("first_fraud"),
        F.when((status == "CANCELLED") & (F.col("l_linenumber") % 3 == 0),
               F.col("l_shipdate") + F.expr("INTERVAL 2 DAYS")).alias("first_chargeback"),
        F.when(F.col("l_suppkey") % 10 == 0, F.lit("USD")).alias("fixed_royalty_currency"),
        line_iid().alias("iid"),
        _currency(F.col("l_orderkey")).alias("currency"),
        F.lit(0.2).cast("decimal(4,2)").alias("vat_rate"),
        F.col("l_shipdate").alias("ship_date"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_suppkey").alias("supp_key"),
        F.col("l_tax").alias("tax"),
    )
    return base.select(
        "*",
        F.col("revenue_ex_vat").alias("revenue_ex_vat_pf"),
        (F.round(F.col("revenue_ex_vat") * F.lit(0.3).cast("decimal(2,1)"))).cast("bigint").alias("margin"),
        F.coalesce(F.round(F.col("revenue_ex_vat") * F.col("royalty_percentage")).cast("bigint"), F.lit(0))
        .cast("bigint").alias("royalty"),
        F.round(F.col("revenue_ex_vat") * F.lit(0.05).cast("decimal(3,2)")).cast("bigint").alias("exclusivity_fee"),
    )


def month_orders(t: Tables, start: str, end: str) -> DataFrame:
    """The orders dated in [start, end). Runs a job that counts them: they are a small part of all orders, and up to
    BROADCAST_ORDERS are broadcast, so that the order lines of all times aren't shuffled for one month."""
    o = t.orders.where((F.col("o_orderdate") >= F.lit(start).cast("date")) & (F.col("o_orderdate") < F.lit(end).cast("date")))
    return F.broadcast(o) if o.count() <= BROADCAST_ORDERS else o


def sales_lines(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    """order_details, or some `lines` of it, joined to products for the supplier name and product name (the sales snapshot
    shape)."""
    od = order_details(t) if lines is None else lines
    p = products(t).select("product_id", F.col("name").alias("product_name"),
                           F.col("supplier_id").alias("supplier_name"))
    return od.join(p, "product_id", "left")


def shop_orders(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(
        o.o_orderdate.alias("order_date"),
        _currency(o.o_orderkey).alias("currency"),
        (o.o_totalprice * (1 + (o.o_orderkey % 7) / 100)).alias("local_price"),
        F.when(o.o_orderkey % 50 == 0, F.lit(0.0)).otherwise(o.o_totalprice).alias("revenue_inc_vat"),
    )


def notes(t: Tables) -> DataFrame:
    o = t.orders
    partial = o.where(o.o_orderstatus == "P").select(
        o.o_orderkey.alias("order_id"),
        F.date_add(F.to_date(o.o_orderdate), 20).alias("date"),
        F.concat(F.lit("Partial refund of "), o.o_orderkey.cast("string")).alias("note"),
    )
    other = o.select(
        o.o_orderkey.alias("order_id"),
        F.date_add(F.to_date(o.o_orderdate), 1).alias("date"),
        F.lit("Customer contacted").alias("note"),
    )
    return partial.unionByName(other)


def suppliers(t: Tables) -> DataFrame:
    names = t.part.select(F.col("p_name").alias("supplier_name")).distinct()
    n = F.length("supplier_name")
    return names.select(
        F.col("supplier_name").alias("supplier_id"),
        "supplier_name",
        (n % 4 != 0).alias("vaultn"),
        F.when(n % 7 != 0, (F.lit(10) + n % 5).cast("decimal(5,2)")).alias("genba_service_charge"),
        (n % 2 == 0).alias("allows_transaction_fees"),
    )


def product_discounts(t: Tables) -> DataFrame:
    p = t.part.where(F.col("p_partkey") % 3 == 0)
    return p.select(
        p.p_partkey.alias("product_id"),
        (p.p_partkey % 6 == 0).alias("star_deal"),
        (p.p_size % 50).cast("decimal(5,2)").alias("discount_percent"),
        (p.p_size % 10).cast("decimal(5,2)").alias("self_funded_percent"),
        (p.p_size % 20).cast("decimal(5,2)").alias("product_discount_self_fund_percent"),
    )


def star_deals(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_partkey") % 7 == 0).select(F.col("p_partkey").alias("product_id"))


# ---------------------------------------------------------------- partner reports (spreadsheet-shaped, all text)

def _month_lines(t: Tables, start: str, end: str, date_col: str, lines: DataFrame | None = None) -> DataFrame:
    if lines is None:
        lines = order_details(t, month_orders(t, start, end) if date_col == "order_date" else None)
    return lines.where((F.col(date_col) >= F.lit(start).cast("date")) & (F.col(date_col) < F.lit(end).cast("date")))


def _written_date(day: Column) -> Column:
    """A date as partners write it: ISO, month first, or with the month's name."""
    return F.when(F.col("line_number") % 3 == 0, F.date_format(day, "M/d/yyyy")).when(
        F.col("line_number") % 3 == 1, F.date_format(day, "d MMM yyyy")).otherwise(day.cast("string"))


def distributor_report(t: Tables, start: str, end: str) -> DataFrame:
    """Distributor's monthly activation report with its spreadsheet headers, every cell as text."""
    lines = _month_lines(t, start, end, "ship_date")
    names = t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("title"))
    x = lines.join(names, "product_id", "left")
    wsp = F.col("revenue_ex_vat") * F.lit(0.008).cast("decimal(4,3)")
    svc = F.when(F.col("tax") != 0, F.col("revenue_ex_vat") * F.lit(0.0005).cast("decimal(5,4)"))
    s = lambda c: c.cast("string")
    return x.select(
        s(F.to_date("ship_date")).alias("Date of Sale"),
        _written_date(F.date_add(F.to_date("order_date"), F.col("line_number") - 1)).alias("Original Date of Sale"),
        s(F.to_date("ship_date")).alias("Date Fulfilled"),
        F.concat(F.lit("guid-"), F.col("iid")).alias("Transaction GUID"),
        F.concat(F.when(F.col("line_number") == 6, F.lit("unknown")).otherwise(F.col("iid")), F.lit("-"),
                 s(F.col("supp_key"))).alias("CTID"),
        F.upper("title").alias("Publisher Name"),
        F.col("title").alias("Product Title"),
        F.concat(F.lit("SKU-"), s(F.col("product_id"))).alias("SKU"),
        s(F.col("product_id")).alias("Genba Product ID"),
        F.lit("GB").alias("Country Sold"),
        s(F.when(F.col("line_number") == 5, 0).otherwise(1)).alias("Activation Qty"),
        F.col("currency").alias("Activation Currency"),
        s(F.col("revenue_ex_vat") * F.lit(0.01).cast("decimal(3,2)")).alias("SRP Activation Currency"),
        F.lit("0").alias("Promotion %"),
        s(wsp).alias("WSP Activation Currency"),
        s(svc).alias("Service Charge Activation Currency"),
        F.lit("1.0").alias("Exchange Rate"),
        F.col("currency").alias("Billing Currency"),
        s(wsp).alias("WSP Billing Currency"),
        F.lit("0").alias("WSP VAT"),
        s(svc).alias("Service Charge Billing Currency"),
        F.lit("n/a").alias("Service Charge VAT"),
        s(wsp + F.coalesce(svc, F.lit(0))).alias("Grand Total"),
    )


def publisher_report(t: Tables, start: str, end: str, lines: DataFrame | None = None) -> DataFrame:
    """Publisher's monthly invoice report (spreadsheet headers, some with stray spaces, as delivered), of order_details or of
    `lines` that have at least its lines of the month."""
    lines = _month_lines(t, start, end, "order_date", lines)
    names = t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("title"))
    x = lines.join(names, "product_id", "left")
    # 'LARGE ' begins other suppliers' names too, so that blocking on the first characters changes the match
    pub = F.when(F.col("product_id") % 11 == 0, F.concat(F.lit("LARGE "), F.upper("title")))\
        .when(F.col("product_id") % 7 == 0, F.concat(F.upper("title"), F.lit(" Игры Ελλάς ＡＢ, Çà™")))\
        .when(F.col("product_id") % 2 == 0, F.concat(F.upper("title"), F.lit(" Ltd.")))\
        .otherwise(F.concat(F.upper("title"), F.lit(" & Co, GmbH")))
    m = F.col("line_number") % 3
    cur = F.when(m == 0, F.concat(F.lit(" "), F.lower("currency"))).when(m == 1, F.concat("currency", F.lit(" ")))\
        .otherwise(F.col("currency"))
    promo = F.when(F.col("line_number") % 2 == 1, F.lit("Summer")).when(F.col("line_number") % 4 == 0, F.lit(""))
    return x.select(
        pub.alias("Publisher Name "),
        cur.alias(" Invoicing Currency"),
        (F.col("revenue_ex_vat") * F.lit(0.007).cast("decimal(4,3)")).alias("Purchase Price In Invoicing Currency"),
        F.when(F.col("line_number") != 7, F.col("iid")).alias("Client Order Reference"),
        promo.alias("Promotion Name"),
        F.lit("Sold").alias("Status"),
    )


def partner_files(t: Tables, start: str, end: str) -> DataFrame:
    """A partner's order lines of a month in files of two offices, which write dates in their own ways: one month first, the
    other day first, some cells in ISO form or with the month's name, some empty or not dates at all."""
    x = _month_lines(t, start, end, "order_date")
    sale = F.date_add(F.to_date("order_date"), F.col("line_number") * 9)
    office = F.when(F.col("currency").isin("USD", "AUD"), "overseas.csv").otherwise("home.csv")
    abroad = F.col("currency").isin("USD", "AUD")
    written = (F.when(F.col("line_number") == 5, F.lit("n/a")).when(F.col("line_number") == 6, F.lit(" "))
               .when(F.col("line_number") == 2, sale.cast("string")).when(F.col("line_number") == 4, F.date_format(sale, "d MMM yyyy"))
               .when(abroad, F.date_format(sale, "M/d/yyyy")).otherwise(F.date_format(sale, "d/M/yyyy")))
    shipped = F.to_date("ship_date")
    return x.select(
        "iid", office.alias("file"), written.alias("sold"),
        F.when(abroad, F.date_format(shipped, "yyyyMMdd")).otherwise(F.date_format(shipped, "d.M.yyyy")).alias("shipped"))

"""Partner royalty and refund statements (P3, P4: A15-A17, J12-J15, F5, F9, F18, F30, PF10, PF16, PF17).

Money is exact decimal arithmetic: minor units times the decimal rate, summed, scaled by 0.01 and rounded once at
the end (half-up, as SQL ROUND), then handed out as double. Lines without any rate keep their count but add nothing
to the amounts (S13). Dimension joins are left to AQE (products grow with the catalogue); the rate table is
broadcast (bounded by the calendar, see `fx`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import as_date, between_dates, half_open
from tillroll.operators.fx import attach_rate

# The statement name separator, the partial-refund note prefix and the completed status.
NEWLINE_IN = "\n in "
PARTIAL_REFUND_PREFIX = "Partial refund of "
COMPLETE = "COMPLETE"


def statement_name(product_name: Column, promo: Column, bundle: Column) -> Column:
    """product name, plus '\\n in <promo or bundle>' when either is set (concat propagates null)."""
    return F.concat(product_name, F.coalesce(F.concat(F.lit(NEWLINE_IN), F.coalesce(promo, bundle)), F.lit("")))


def statement_sku(isbn: Column, sku: Column) -> Column:
    return F.coalesce(isbn.cast("string"), sku)


def _money_terms(rate: Column) -> dict[str, Column]:
    """Per-line terms in major currency units, before the 0.01 scaling of minor units."""
    fees = (F.coalesce(F.col("transaction_fee"), F.lit(0)).cast("decimal(20,0)") * F.lit(0.01).cast("decimal(3,2)")
            + F.coalesce(F.col("affiliate_commission"), F.lit(0)).cast("decimal(20,4)")
            + F.coalesce(F.col("affiliate_fee"), F.lit(0)).cast("decimal(20,4)"))
    return {
        "rev": F.col("revenue_ex_vat_pf").cast("decimal(18,0)") * rate,
        "ded": fees.cast("decimal(18,4)") * rate,
        "excl": F.col("exclusivity_fee").cast("decimal(18,0)") * rate,
    }


def _cents(s: Column) -> Column:
    """Minor to major units, exactly: x * 0.01 (a division would round at Spark's result scale)."""
    return s.cast("decimal(32,14)") * F.lit(0.01).cast("decimal(3,2)")


def _round2(c: Column) -> Column:
    return F.round(c, 2)


def _statement_aggs(sign: int) -> list[Column]:
    rate = F.col("rate")
    t = _money_terms(rate)
    value = _round2(_cents(F.sum(t["rev"])))
    ded = _round2(F.sum(t["ded"]).cast("decimal(32,14)"))
    net = _round2(_cents(F.sum(t["rev"])) - F.sum(t["ded"]).cast("decimal(32,14)"))
    excl = _round2(_cents(F.sum(t["excl"])))
    s = F.lit(sign)
    return [
        (F.count(F.lit(1)) * s).alias("qty"),
        value.alias("value"),  # S11: the refund statement keeps value positive
        (ded * s).alias("deductions"),
        (net * s).alias("net"),
        (excl * s).alias("exclusivity_fee"),
    ]


def royalty_statement(sales: DataFrame, products: DataFrame, shop_orders: DataFrame, *, start, end, as_of,
                      channel_col: str, currency: str = "USD", percentage: str = "0.05",
                      statuses=(COMPLETE,)) -> DataFrame:
    """Completed channel sales of the month per supplier, product and bundle/promo, converted with the day's
    implied rate (fallback: the as-of day's), with the exclusivity fee reported as the royalty (S14)."""
    lines = sales.where(F.col(channel_col).eqNullSafe(True) & F.col("status").isin(*statuses)
                        & half_open("order_date", start, end))
    p = products.select("product_id", "isbn", F.col("sku").alias("p_sku"))
    x = lines.join(p, "product_id")  # J12: inner, drops unmapped products
    x = attach_rate(x, shop_orders, currency, as_of)
    x = x.select("*", statement_sku(F.col("isbn"), F.col("p_sku")).alias("sku_out"),
                 statement_name(F.col("product_name"), F.col("promo_name"), F.col("bundle_name")).alias("name"),
                 F.col("bundle_name").isNotNull().alias("in_bundle"))
    keys = ["supplier_name", "sku_out", "promo_name", "bundle_name", "name", "in_bundle"]
    first = x.groupBy(*keys).agg(*_statement_aggs(1))
    # The second level has the same grain; it is kept as the reference's statement shape.
    second = first.groupBy("supplier_name", "sku_out", "name", "in_bundle", "bundle_name", "promo_name").agg(
        F.sum("qty").alias("qty"), F.sum("value").alias("value"), F.sum("deductions").alias("deductions"),
        F.sum("net").alias("net"), F.sum("exclusivity_fee").alias("royalty"))
    ordered = second.orderBy(F.col("supplier_name").asc_nulls_last(), F.coalesce("bundle_name", F.lit("")),
                             F.coalesce("promo_name", F.lit("")), F.col("name").asc_nulls_last())
    return ordered.select(
        "supplier_name", F.col("sku_out").alias("sku"), "name", F.col("qty").cast("bigint").alias("qty"),
        F.col("value").cast("double").alias("value"), F.col("deductions").cast("double").alias("deductions"),
        F.col("net").cast("double").alias("net"),
        F.lit(percentage).cast("decimal(10,4)").cast("double").alias("royalty_percentage"),
        F.col("royalty").cast("double").alias("royalty"), "in_bundle")


def first_partial_refunds(notes: DataFrame, prefix: str = PARTIAL_REFUND_PREFIX) -> DataFrame:
    """order_id -> MIN(date) of notes starting with the prefix (A7, PF16)."""
    return notes.where(F.col("note").startswith(prefix)).groupBy("order_id") \
        .agg(F.min("date").alias("first_partial_refund"))


def refund_statement(sales: DataFrame, products: DataFrame, shop_orders: DataFrame, notes: DataFrame, *,
                     min_order_date, event_from, event_to, as_of, channel_col: str, currency: str = "USD",
                     percentage: str = "0.05") -> DataFrame:
    """Non-completed channel lines whose first refund / fraud / chargeback / partial refund day falls in the
    inclusive window, sign-reversed except `value` (S11). Rate joined on the rate's own date (S10 corrected)."""
    lines = sales.where(F.col(channel_col).eqNullSafe(True) & (F.col("status") != COMPLETE)
                        & (F.col("order_date") >= as_date(min_order_date)))
    p = products.select("product_id", "isbn", F.col("sku").alias("p_sku"))
    x = lines.join(p, "product_id").join(first_partial_refunds(notes), "order_id", "left")
    event_day = F.least(F.to_date("first_refund"), F.to_date("first_fraud"), F.to_date("first_chargeback"),
                        F.to_date("first_partial_refund"))
    keep = (F.when(F.col("fixed_royalty_currency").isNotNull(), F.lit(True))
            .when(F.col("bundle_name").isNotNull() & (F.col("royalty_percentage") == 0), F.lit(False))
            .otherwise(F.lit(True)))
    x = x.where(between_dates(event_day, event_from, event_to) & keep)
    x = attach_rate(x, shop_orders, currency, as_of)
    x = x.select("*", statement_sku(F.col("isbn"), F.col("p_sku")).alias("sku_out"),
                 statement_name(F.col("product_name"), F.col("promo_name"), F.col("bundle_name")).alias("name"),
                 F.col("bundle_name").isNotNull().alias("in_bundle"))
    g = x.groupBy("supplier_name", "sku_out", "name", "in_bundle", "bundle_name", "product_name", "promo_name") \
        .agg(*_statement_aggs(-1))
    g = g.orderBy(F.coalesce("bundle_name", F.lit("")), F.col("product_name").asc_nulls_last())
    return g.select(
        "supplier_name", F.col("sku_out").alias("sku"), "name", F.col("qty").cast("bigint").alias("qty"),
        F.col("value").cast("double").alias("value"), F.col("deductions").cast("double").alias("deductions"),
        F.col("net").cast("double").alias("net"),
        F.lit(percentage).cast("decimal(10,4)").cast("double").alias("drivethru_percentage"),
        F.col("exclusivity_fee").cast("double").alias("exclusivity_fee"), "in_bundle")

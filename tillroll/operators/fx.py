"""Currency rates implied by shop orders, and their attachment to sales lines.

A daily rate table has one row per (calendar day, currency), so its size is bounded by the calendar times the number
of currencies, not by the order volume: it is safe to broadcast, and joining it costs no shuffle of the sales side.
The fallback ("today") rate is a single value per currency and is attached as a scalar subquery, so no join without
keys (and no nested-loop join) is planned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.dates import as_date


def _ratio(num: str, den: str) -> Column:
    """local / revenue with NULLIF(den, 0) (F7): a zero denominator gives null, not an ANSI error."""
    return F.col(num) / F.when(F.col(den) != 0, F.col(den))


def implied_daily_rate(shop_orders: DataFrame, currency: str | None = None, rate_scale: int = 10,
                       out: str = "conversion_to_publisher") -> DataFrame:
    """(order_date, currency) -> AVG(local_price / NULLIF(revenue_inc_vat, 0)).

    The average is held as decimal(6 + rate_scale, rate_scale), as a warehouse numeric division would, so money
    multiplied by it later stays exact (and inside Spark's 38-digit decimals without precision loss)."""
    o = shop_orders
    if currency is not None:
        o = o.where(F.col("currency") == currency)
    return o.groupBy(F.to_date("order_date").alias("rate_date"), "currency").agg(
        F.avg(_ratio("local_price", "revenue_inc_vat")).cast(f"decimal({6 + rate_scale},{rate_scale})").alias(out))


def fallback_rate(shop_orders: DataFrame, currency: str, as_of, rate_scale: int = 10) -> Column:
    """AVG implied rate of `currency` on the `as_of` day as a scalar subquery (A13, J14): always one value, null when
    there were no orders that day."""
    o = shop_orders.where((F.to_date("order_date") == as_date(as_of)) & (F.col("currency") == currency))
    agg = o.agg(F.avg(_ratio("local_price", "revenue_inc_vat")).cast(f"decimal({6 + rate_scale},{rate_scale})"))
    return agg.scalar()


def attach_rate(lines: DataFrame, shop_orders: DataFrame, currency: str, as_of, date_col: str = "order_date",
                rate_scale: int = 10) -> DataFrame:
    """Lines + `rate` = the day's implied rate of `currency`, else the as-of fallback (J13 with S10 corrected)."""
    daily = implied_daily_rate(shop_orders, currency, rate_scale).select("rate_date", "conversion_to_publisher")
    x = lines.join(F.broadcast(daily), F.to_date(lines[date_col]) == daily["rate_date"], "left")
    backup = fallback_rate(shop_orders, currency, as_of, rate_scale)
    return x.withColumn("rate", F.coalesce(F.col("conversion_to_publisher"), backup)) \
        .drop("rate_date", "conversion_to_publisher")


def rates_to_gbp(shop_orders: DataFrame, rate_scale: int = 6) -> DataFrame:
    """Monthly GBP rate table (currency, rate_date = month start, rate_to_gbp) derived from the shop orders:
    AVG(revenue_inc_vat / local_price) per currency and month; GBP is 1 (F25's rate source, re-aimed from a bundled
    rate library to a table). Bounded by months x currencies."""
    o = shop_orders.where(F.col("local_price") != 0)
    o = o.withColumn("currency", F.upper(F.trim("currency")))  # as the totals that are looked up (J22)
    t = o.groupBy("currency", F.trunc(F.to_date("order_date"), "MM").alias("rate_date")).agg(
        F.avg(F.col("revenue_inc_vat") / F.col("local_price")).alias("r"))
    rate = F.when(F.col("currency") == "GBP", F.lit(1)).otherwise(F.col("r"))
    return t.select("currency", "rate_date", rate.cast(f"decimal({8 + rate_scale},{rate_scale})").alias("rate_to_gbp"))


def as_of_rates(rates: DataFrame, as_of) -> DataFrame:
    """Latest rate per currency with rate_date <= as_of (F25 as-of pick): a `row_number` top-1 per currency, which
    Spark plans with a partial WindowGroupLimit, over a table bounded by months x currencies."""
    r = rates.where(F.col("rate_date") <= as_date(as_of))
    w = Window.partitionBy("currency").orderBy(F.col("rate_date").desc())
    return r.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("currency", "rate_to_gbp")

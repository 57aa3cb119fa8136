"""Product segments and order roll-ups.

Dimension joins (product flags, product types) are plain left joins: their size grows with the catalogue, not with a
proven bound, so no broadcast is forced; AQE turns them into broadcast hash joins at run time when the measured side is
under `spark.sql.adaptive.autoBroadcastJoinThreshold`, and keeps the shuffle join beyond it. Every aggregate here is
a `groupBy` with partial (map-side) aggregation, so a product or order holding a third of all lines is combined per
map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import minor_to_major

# Product types folded into "Other" (compared lower-cased), then the segment and order-type labels.
OTHER_TYPES = ("gift-card", "video", "comic", "voucher", "book", "audio", "software")
GAME, DLC, OTHER, UNKNOWN, MIXED = "game", "dlc", "Other", "Unknown", "Mixed"
COMPLETE = "COMPLETE"


def collection_flags(collections: DataFrame, flagship: str) -> DataFrame:
    """product_id, is_flagship: SUM(CASE collection = flagship) > 0 per product (A1)."""
    hit = F.when(F.col("collection") == flagship, 1).otherwise(0)
    return collections.groupBy("product_id").agg((F.sum(hit) > 0).alias("is_flagship"))


def product_types(products: DataFrame) -> DataFrame:
    """DISTINCT (product_id, product_type) (A2); a product with two types fans its lines out, as in the reference."""
    return products.select("product_id", "product_type").distinct()


def segment_expr(is_flagship: Column, product_type: Column, flagship_label: str) -> Column:
    """flagship beats product type, type beats 'Other' (known product without the flag), else 'Unknown'."""
    return (F.when(is_flagship.eqNullSafe(True), F.lit(flagship_label))
            .when(product_type.isNotNull(), product_type)
            .when(is_flagship.eqNullSafe(False), F.lit(OTHER))
            .otherwise(F.lit(UNKNOWN)))


def segment_group_expr(segment: Column, flagship_label: str, other_types=OTHER_TYPES) -> Column:
    """fold minor types into 'Other' case-insensitively; other values keep their case."""
    return (F.when(segment == flagship_label, F.lit(flagship_label))
            .when(F.lower(segment).isin(*other_types), F.lit(OTHER))
            .otherwise(segment))


def flag_expr(col: Column, value: str) -> Column:
    """0/1 from equality, null -> 0."""
    return F.when(col == value, 1).otherwise(0)


def classify_lines(lines: DataFrame, collections: DataFrame, products: DataFrame, flagship: str,
                   flagship_label: str | None = None, other_types=OTHER_TYPES) -> DataFrame:
    """Order lines with `segment_final` and `segment_group`."""
    label = flagship_label or flagship
    flags = collection_flags(collections, flagship)
    types = product_types(products)
    x = lines.join(flags, "product_id", "left").join(types, "product_id", "left")
    seg = segment_expr(F.col("is_flagship"), F.col("product_type"), label)
    x = x.withColumn("segment_final", seg)
    return x.withColumn("segment_group", segment_group_expr(F.col("segment_final"), label, other_types))


def journey_lines(order_details: DataFrame, collections: DataFrame, products: DataFrame, flagship: str,
                  start, end, status: str = COMPLETE, flagship_label: str | None = None) -> DataFrame:
    """P1 line CTE: completed lines in [start, end) with date, month, decimal money and segment (PF1, PF9, PF11)."""
    from tillroll.functions.dates import half_open, month_start

    od = order_details.where((F.col("status") == status) & half_open("order_date", start, end))
    od = od.select(
        "order_id", "user_id",
        F.to_date("order_date").alias("order_date"),
        month_start("order_date").alias("order_month"),
        "product_id", "units",
        minor_to_major("revenue_ex_vat").alias("revenue"),
        minor_to_major("margin").alias("margin"),
    )
    return classify_lines(od, collections, products, flagship, flagship_label)


def order_rollup(lines: DataFrame, flagship_label: str, bare_numeric: str = "decimal(18,0)") -> DataFrame:
    """One row per (order_id, user_id, order_date, order_month) with totals, 0/1 segment flags and order type.

    `bare_numeric` is the type of the reference's unqualified `::numeric` casts of the totals: decimal(18,0) is the
    warehouse's default (whole units, rounded); pass e.g. decimal(18,4) to keep the pence.
    """
    g = F.col("segment_group")
    has = {
        "has_fv": F.max(flag_expr(g, flagship_label)),
        "has_game": F.max(flag_expr(g, GAME)),
        "has_dlc": F.max(flag_expr(g, DLC)),
        "has_other": F.max(flag_expr(g, OTHER)),
    }
    o = lines.groupBy("order_id", "user_id", "order_date", "order_month").agg(
        F.sum("revenue").cast(bare_numeric).alias("order_revenue_total"),
        F.sum("margin").cast(bare_numeric).alias("order_margin_total"),
        F.sum("units").alias("units"),
        *[v.alias(k) for k, v in has.items()],
    )
    n = F.col("has_fv") + F.col("has_game") + F.col("has_dlc") + F.col("has_other")
    order_type = (F.when(n > 1, MIXED).when(F.col("has_fv") == 1, flagship_label)
                  .when(F.col("has_game") == 1, GAME).when(F.col("has_dlc") == 1, DLC)
                  .when(F.col("has_other") == 1, OTHER).otherwise(UNKNOWN))
    return o.withColumn("order_type", order_type)

"""Partner reconciliations (P6 distributor overcharge; P7/P8 publisher invoice comparison).

P6 joins the distributor's aggregated report to own order lines on the item id. The own side has no date filter
(S15): partner rows may match lines of any date. The join is a shuffle join on iid; only the partner's iids matter,
and Spark's runtime bloom filter (`spark.sql.optimizer.runtime.bloomFilter.enabled`) can prune the line side before
the shuffle. Divisions are done in double, like the reference's pandas columns; money sums stay decimal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import half_open
from tillroll.functions.money import cent

# The publisher report's columns and the comparison's added columns, the statuses counted and skipped,
# the labels written, and the home currency.
PUBLISHER, CURRENCY, PRICE = "Publisher Name", "Invoicing Currency", "Purchase Price In Invoicing Currency"
CONVERTED, ADJUSTED = "Converted to GBP", "Adjusted Purchase Price In Invoicing Currency"
ROYALTY_STATUSES = ("COMPLETE", "REFUNDED")
SKIPPED_STATUSES = ("CANCELLED", "INITIALISED")
STAR_DEAL, ADJUSTED_STATUS, HOME_CURRENCY = "Star Deal", "Adjusted", "GBP"

PARTNER_GROUP_KEYS = ["ctid_1", "iid", "product_title", "genba_product_id", "original_date_of_sale", "country_sold",
                      "activation_currency"]

# The detail report's headline columns, in the reference's order (PF8).
DETAIL_HEADLINE = [
    "ctid_1", "iid", "product_title", "genba_product_id", "product_id", "order_id", "activation_qty",
    "original_date_of_sale", "order_date", "status", "country_sold", "fanatical_currency", "genba_currency", "deal",
    "supplier_name", "genba_reported_royalty", "fanatical_reported_royalty", "overcharge",
    "overcharge_after_transaction_fee_handling", "overcharge_perc",
]


def _z(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def partner_aggregate(report: DataFrame) -> DataFrame:
    """Distributor report (typed, canonical names) -> one row per 7 keys, null keys kept (A20, F21, PF19).

    iid is the CTID's part before the first '-'; sums of all-null groups are 0 as in pandas (S19); groups whose
    activation quantity sums to 0 are dropped."""
    r = report.withColumn("iid", F.split_part(F.col("ctid_1"), F.lit("-"), F.lit(1)))
    agg = r.groupBy(*PARTNER_GROUP_KEYS).agg(
        _zsum("activation_qty").alias("activation_qty"),
        _zsum("wsp_billing_currency").alias("_wsp"),
        _zsum("service_charge_billing_currency").alias("_svc"),
    )
    agg = agg.where(F.col("activation_qty") > 0)
    return agg.select(
        *[c for c in PARTNER_GROUP_KEYS if c != "activation_currency"],
        F.col("activation_currency").alias("genba_currency"),
        "activation_qty",
        (F.col("_wsp") + F.col("_svc")).alias("genba_reported_royalty"),
    )


def _zsum(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def order_line_terms(order_details: DataFrame, products: DataFrame, suppliers: DataFrame, discounts: DataFrame,
                     star_deals: DataFrame, *, start, end, default_service_charge: str = "0.125") -> DataFrame:
    """Own order lines with the distributor terms (J16, F28, S17): left joins to product, supplier, discount and
    star deal, the discount joins gated by the order date in [start, end) inside the ON clause (lines outside the
    window are kept, unmatched)."""
    od = order_details.alias("a")
    p = products.select("product_id", "supplier_id").alias("p")
    s = suppliers.select("supplier_id", "supplier_name", "genba_service_charge", "allows_transaction_fees").alias("s")
    b = discounts.select("product_id", "star_deal", "discount_percent", "self_funded_percent",
                         "product_discount_self_fund_percent").alias("b")
    c = star_deals.select(F.col("product_id").alias("star_product_id")).alias("c")
    window = half_open(F.col("a.order_date"), start, end)
    x = (od.join(p, "product_id", "left").join(s, "supplier_id", "left")
         .join(b, (F.col("a.product_id") == F.col("b.product_id")) & window, "left")
         .join(c, (F.col("a.product_id") == F.col("c.star_product_id")) & window, "left"))
    rp = F.col("a.royalty_percentage")
    svc = F.col("genba_service_charge")
    dflt = F.lit(default_service_charge).cast("decimal(6,4)")
    deal = F.when(F.col("c.star_product_id").isNotNull() | F.col("b.star_deal").eqNullSafe(True), F.lit(STAR_DEAL)) \
        .otherwise(F.coalesce(F.col("a.bundle_name"), F.col("a.promo_name")))
    return x.select(
        F.col("a.iid").alias("iid"), F.col("a.product_name").alias("product_name"),
        F.col("a.product_id").alias("product_id"), F.lit(1).alias("sales"),
        (F.col("a.royalty").cast("decimal(20,0)") * cent()).alias("fanatical_reported_royalty"),
        (F.col("a.revenue_ex_vat_pf").cast("decimal(20,0)") * rp * cent()).alias("f_royalty_calc"),
        # narrow types first: Spark rounds a product wider than 38 digits to 6 decimals
        ((F.col("a.revenue_ex_vat_pf").cast("decimal(20,0)") * cent()).cast("decimal(20,2)")
         * ((1 - rp) * F.coalesce(svc * cent(), dflt) + rp).cast("decimal(16,8)")).alias("fanatical_assumed_royalty"),
        ((1 - rp) * F.coalesce(svc, dflt) + rp).alias("blended_rate"),
        rp.alias("royalty_percentage"), svc.alias("genba_service_charge"),
        F.to_date("a.order_date").alias("order_date"), F.col("a.status").alias("status"),
        F.col("a.order_id").alias("order_id"), F.col("a.currency").alias("fanatical_currency"),
        F.col("s.supplier_name").alias("supplier_name"), deal.alias("deal"),
        F.col("b.product_discount_self_fund_percent").alias("product_discount_self_fund_percent"),
        (F.col("b.discount_percent") - F.col("b.self_funded_percent")).alias("expected_discount"),
        F.col("a.vat_rate").alias("vat_rate"),
        F.coalesce(F.when(F.col("allows_transaction_fees"), F.col("a.transaction_fee").cast("decimal(20,0)") * cent()),
                   F.lit(0)).alias("allowable_transaction_fee"),
    )


def reduce_to_keys(big: DataFrame, keys: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    """Keep the rows of `big` whose `key` occurs in `keys`: a semi join. At run time Spark broadcasts the distinct keys if
    they are small and shuffles both sides otherwise. If `big` is kept in `buckets` by the key (`tables.write_bucketed`), the
    keys are dealt to as many: with fewer buckets than shuffle partitions Spark would deal `big` again."""
    wanted = keys.select(key).where(F.col(key).isNotNull()).distinct()
    return big.join(wanted.repartition(buckets, key) if buckets else wanted, key, "left_semi")


def match_counts(partner: DataFrame, lines: DataFrame) -> DataFrame:
    """S16 diagnostic: per partner row key (iid) how many own lines it matches; partner rows with 0 are unmatched, those
    with several fan out in the detail."""
    own = lines.groupBy("iid").agg(F.count("*").alias("match_count"))
    p = partner.groupBy("iid").agg(F.count("*").alias("partner_rows"))
    return p.join(own, "iid", "left").select("iid", "partner_rows", F.coalesce("match_count", F.lit(0)).alias("match_count"))


def overcharge_detail(partner: DataFrame, lines: DataFrame) -> DataFrame:
    """Partner rows left-joined to own lines on iid, with variance columns (J18, F16, F26, F27, PF8).

    The own side has no date filter (S15), so `lines` should be built from order lines already reduced to the partner's
    iids (`reduce_to_keys`, as `reports.distributor_overcharge` does). A partner row matching several lines repeats
    (S16); `old_order` is true when sale and order dates are less than 3 days apart (S18)."""
    x = partner.join(lines, "iid", "left")
    g, f = F.col("genba_reported_royalty"), F.col("fanatical_reported_royalty")
    gd, fd = g.cast("double"), f.cast("double")
    derived = {
        "overcharge": g - _z("fanatical_reported_royalty"),
        "overcharge_after_transaction_fee_handling": g - _z("allowable_transaction_fee") - _z(
            "fanatical_reported_royalty"),
        "overcharge_perc": (gd - fd) / F.when(fd != 0, fd) * 100,
        "missing_discount": 1 - fd / F.when(gd != 0, gd),
        "currency_match": F.coalesce(F.col("fanatical_currency") == F.col("genba_currency"), F.lit(False)),
        "rereported_order": F.lit(False),
        "old_order": F.coalesce(F.abs(F.datediff("original_date_of_sale", "order_date")) < 3, F.lit(False)),
    }
    x = x.withColumns(derived)
    rest = [c for c in x.columns if c not in DETAIL_HEADLINE]
    return x.select(*DETAIL_HEADLINE, *rest)


def overcharge_by_title(detail: DataFrame) -> DataFrame:
    """Total overcharge after fees per product title (null titles dropped), largest first."""
    d = detail.where(F.col("product_title").isNotNull())
    out = d.groupBy("product_title").agg(
        F.coalesce(F.sum("overcharge_after_transaction_fee_handling"), F.lit(0)).alias("Total Overcharge"))
    return out.orderBy(F.col("Total Overcharge").desc_nulls_last(), "product_title")


# ---------------------------------------------------------------- P7 / P8 publisher invoice comparison



def partner_totals(report: DataFrame, name: str = PUBLISHER, currency: str = CURRENCY,
                   amount: str = PRICE) -> DataFrame:
    """A21 + F20: sum per (publisher, currency) with null keys dropped and all-null sums as 0; the currency is
    trimmed and upper-cased only after grouping, so differently written codes stay separate rows (S20)."""
    r = report.where(F.col(name).isNotNull() & F.col(currency).isNotNull())
    g = r.groupBy(name, currency).agg(F.coalesce(F.sum(amount), F.lit(0)).alias(amount))
    return g.withColumn(currency, F.upper(F.trim(F.col(currency).cast("string"))))


def convert_to_gbp(totals: DataFrame, rates: DataFrame, currency: str = CURRENCY, amount: str = PRICE,
                   out: str = CONVERTED) -> DataFrame:
    """Amount x rate (GBP = 1), rounded half-even to 2 places as pandas does; unknown currency -> null.
    `rates` (currency, rate_to_gbp) has one row per currency, so it is broadcast."""
    r = rates.select(F.col("currency").alias("_ccy"), "rate_to_gbp")
    x = totals.join(F.broadcast(r), totals[currency] == r["_ccy"], "left")
    rate = F.when(F.col(currency) == HOME_CURRENCY, F.lit(1).cast("decimal(14,6)")).otherwise(F.col("rate_to_gbp"))
    # amount narrowed to decimal(22,4) so the product (scale 10) stays exact within 38 digits: a wider product would
    # be rounded by Spark before the half-even rounding to pence
    return x.withColumn(out, F.bround(F.col(amount).cast("decimal(22,4)") * rate, 2)).drop("_ccy", "rate_to_gbp")


def supplier_royalty_totals(order_details: DataFrame, products: DataFrame, suppliers: DataFrame, *, start, end,
                            statuses=ROYALTY_STATUSES, partner_flag: str,
                            name_from: str = "supplier") -> DataFrame:
    """Royalties (major units) per supplier flagged for the partner, lines of [start, end).

    `name_from="supplier"` groups by the supplier table's name (second script); `"line"` by the name stored on the
    order line (first script; its left joins are made inner by the flag filter)."""
    od = order_details.where(half_open("order_date", start, end) & F.col("status").isin(*statuses))
    od = od.select("product_id", "royalty", F.col("supplier_name").alias("_line_supplier")) if name_from == "line" \
        else od.select("product_id", "royalty")
    p = products.select("product_id", "supplier_id")
    s = suppliers.where(F.col(partner_flag).eqNullSafe(True)).select("supplier_id", "supplier_name")
    x = od.join(p, "product_id").join(s, "supplier_id")
    if name_from == "line":
        x = x.drop("supplier_name").withColumnRenamed("_line_supplier", "supplier_name")
    return x.groupBy("supplier_name").agg((F.sum(F.col("royalty").cast("decimal(20,0)")) * cent()).alias("royalties"))


def override_names(df: DataFrame, column: str, mapping: dict[str, str] | None) -> DataFrame:
    """PF24: replace known publisher spellings by name (never by row position)."""
    if not mapping:
        return df
    expr = F.col(column)
    for k, v in mapping.items():
        expr = F.when(F.col(column) == k, F.lit(v)).otherwise(expr)
    return df.withColumn(column, expr)


def publisher_comparison(report: DataFrame, rates: DataFrame, royalties: DataFrame, *, threshold: float = 90,
                         overrides: dict[str, str] | None = None, blocking: int | None = None) -> DataFrame:
    """Partner totals in GBP next to own royalties of the fuzzily matched supplier, and their difference."""
    from tillroll.operators.matching import fuzzy_join
    from tillroll.session import cut_lineage

    conv = convert_to_gbp(partner_totals(report), rates)
    conv = cut_lineage(override_names(conv, PUBLISHER, overrides))  # a row per publisher and currency, read twice
    m = fuzzy_join(conv, royalties, PUBLISHER, "supplier_name", threshold, blocking)
    return m.select(PUBLISHER, CURRENCY, PRICE, CONVERTED, "royalties",
                    F.bround(F.col(CONVERTED) - F.col("royalties"), 2).alias("Difference"))


def promo_item_royalties(order_details: DataFrame, *, supplier: str, start, end,
                         excluded=SKIPPED_STATUSES) -> DataFrame:
    """Royalties per (iid, status, promo_name, bundle_name) of one supplier's lines in [start, end)."""
    od = order_details.where(half_open("order_date", start, end) & ~F.col("status").isin(*excluded)
                             & (F.col("supplier_name") == supplier))
    return od.groupBy("iid", "status", "promo_name", "bundle_name").agg(
        (F.sum(F.col("royalty").cast("decimal(20,0)")) * cent()).alias("royalties"))


def promo_adjusted_detail(report: DataFrame, promo: DataFrame, *, publisher: str,
                          ref_col: str = "Client Order Reference", promo_col: str = "Promotion Name",
                          match: str = "contains", keep_promo_name: bool = False) -> DataFrame:
    """P8 detail (PF21, J20, PF22, PF23): the publisher's report rows; where the report names a promotion and our
    item has none, the price becomes our royalty (null when the item is unknown, S21) and Status 'Adjusted'.

    `match="contains"` selects the publisher case-insensitively by substring (second script), `"equals"` by the
    whole lower-cased name (first script, which also keeps our `promo_name` column: `keep_promo_name`)."""
    name = F.lower(F.col(PUBLISHER))
    hit = name.contains(publisher.lower()) if match == "contains" else (name == publisher.lower())
    sel = report.where(F.coalesce(hit, F.lit(False)))
    pr = promo.select(F.col("iid").alias("_iid"), F.col("promo_name").alias("_promo"), F.col("royalties").alias("_roy"))
    x = sel.join(pr, sel[ref_col].eqNullSafe(pr["_iid"]), "left")
    cond = (F.col(promo_col).isNotNull() & (F.col(promo_col) != "")
            & (F.col("_promo").isNull() | (F.col("_promo") == "")))
    x = x.withColumns({
        PRICE: F.when(cond, F.col("_roy")).otherwise(F.col(PRICE)),
        "Status": F.when(cond, F.lit(ADJUSTED_STATUS)).otherwise(F.col("Status")),
    })
    if keep_promo_name:
        return x.withColumnRenamed("_promo", "promo_name").drop("_iid", "_roy")
    return x.drop("_iid", "_promo", "_roy")


def adjusted_comparison(comparison: DataFrame, detail: DataFrame, fallback: bool = True) -> DataFrame:
    """P8 totals (A21, J21, F29): adjusted partner totals joined to the comparison on (publisher, currency as
    written in the report); adjusted_difference falls back to the converted price (second script) or is null
    where nothing was adjusted (`fallback=False`, first script)."""
    s = detail.where(F.col(PUBLISHER).isNotNull() & F.col(CURRENCY).isNotNull()) \
        .groupBy(PUBLISHER, CURRENCY).agg(F.coalesce(F.sum(PRICE), F.lit(0)).alias(ADJUSTED))
    x = comparison.join(s, [PUBLISHER, CURRENCY], "left")
    adjusted = F.coalesce(F.col(ADJUSTED), F.col(CONVERTED)) if fallback else F.col(ADJUSTED)
    return x.withColumn("adjusted_difference", F.bround(adjusted - F.col("royalties"), 2))

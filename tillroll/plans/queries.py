"""Registry of the queries checked by the driver: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables of `sf_dir` through the adapter views and runs one operator or one whole report
over all rows; the matching DuckDB SQL is in `tillroll.plans.oracle_sql`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tillroll.functions.dates import previous_month
from tillroll.functions.names import normalize_name
from tillroll.operators import funnel, journeys, matching, reconcile, royalty, segments
from tillroll.operators import fx as fxop
from tillroll.plans import params as P
from tillroll.plans import reports
from tillroll.session import cut_lineage
from tillroll.sources import contracts, formats, sinks
from tillroll.sources import fixtures as fx
from tillroll.sources.tables import Tables, bucket_count, read_snapshot, sql_frame, write_bucketed

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
#: Least buckets of the order lines kept by item id; large tables have more (`bucket_count`).
LINE_BUCKETS = 8


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- P5 search funnel

@register("search_funnel")
def q_search_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel.search_funnel(fx.search_events(Tables(spark, sf_dir)), period="month")


@register("search_funnel_daily")
def q_search_funnel_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel.search_funnel(fx.search_events(Tables(spark, sf_dir)), period="day")


# ---------------------------------------------------------------- P1 order journey and its building blocks


def _basket_orders(spark, sf_dir):
    t = Tables(spark, sf_dir)
    lines = segments.journey_lines(fx.baskets(t), fx.product_collections(t), fx.products(t), P.FLAGSHIP,
                                   P.BASKET_START, P.BASKET_END)
    return segments.order_rollup(lines, P.FLAGSHIP)


@register("collection_flags")
def q_collection_flags(spark, sf_dir):
    return segments.collection_flags(fx.product_collections(Tables(spark, sf_dir)), P.FLAGSHIP)


@register("segment_lines")
def q_segment_lines(spark, sf_dir):
    t = Tables(spark, sf_dir)
    x = segments.journey_lines(fx.baskets(t), fx.product_collections(t), fx.products(t), P.FLAGSHIP,
                               P.BASKET_START, P.BASKET_END)
    return x.select("order_id", "user_id", "order_date", "order_month", "product_id", "units",
                    F.col("revenue").cast("double").alias("revenue"), F.col("margin").cast("double").alias("margin"),
                    "segment_final", "segment_group")


@register("order_rollup")
def q_order_rollup(spark, sf_dir):
    o = _basket_orders(spark, sf_dir)
    return o.select("order_id", "user_id", "order_date", "order_month",
                    F.col("order_revenue_total").cast("double").alias("order_revenue_total"),
                    F.col("order_margin_total").cast("double").alias("order_margin_total"),
                    F.col("units").cast("bigint").alias("units"), "has_fv", "has_game", "has_dlc", "has_other",
                    "order_type")


@register("order_gaps")
def q_order_gaps(spark, sf_dir):
    rows = journeys.order_journey_rows(_basket_orders(spark, sf_dir), P.SEQ_WINDOW_DAYS, keep=[])
    return rows.select("user_id", "order_id", "order_date",
                       F.col("days_since_prev_order").cast("bigint").alias("days_since_prev_order"))


@register("followed_within")
def q_followed_within(spark, sf_dir):
    rows = journeys.order_journey_rows(_basket_orders(spark, sf_dir), P.SEQ_WINDOW_DAYS, keep=[])
    return rows.select("user_id", "order_id", "order_date", "seq_g2fv_30d_count", "seq_fv2g_30d_count")


@register("first_month_cohort")
def q_first_month_cohort(spark, sf_dir):
    t = Tables(spark, sf_dir)
    lines = segments.journey_lines(fx.order_details(t), fx.product_collections(t), fx.products(t), P.FLAGSHIP,
                                   P.SALES_JOURNEY_START, P.SALES_JOURNEY_END)
    rows = journeys.order_journey_rows(segments.order_rollup(lines, P.FLAGSHIP), P.SALES_SEQ_WINDOW_DAYS,
                                       keep=["order_month"])
    return rows.select("user_id", "order_id", "order_month", "first_order_month",
                       journeys.months_between_boundaries("first_order_month", "order_month")
                       .alias("months_since_first"))


@register("order_journey")
def q_order_journey(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return reports.order_journey(fx.baskets(t), fx.product_collections(t), fx.products(t), flagship=P.FLAGSHIP,
                                 start=P.BASKET_START, end=P.BASKET_END, window_days=P.SEQ_WINDOW_DAYS)


@register("order_journey_30d")
def q_order_journey_30d(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return reports.order_journey(fx.baskets(t), fx.product_collections(t), fx.products(t), flagship=P.FLAGSHIP,
                                 start=P.BASKET_START, end=P.BASKET_END, window_days=P.REFERENCE_WINDOW_DAYS)


@register("order_journey_sales")
def q_order_journey_sales(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return reports.order_journey(fx.order_details(t), fx.product_collections(t), fx.products(t),
                                 flagship=P.FLAGSHIP, start=P.SALES_JOURNEY_START, end=P.SALES_JOURNEY_END,
                                 window_days=P.SALES_SEQ_WINDOW_DAYS)


# ---------------------------------------------------------------- P2 product transitions

_P2 = dict(flagship=P.FLAGSHIP, start=P.BASKET_START, end=P.BASKET_END, launch=P.LAUNCH_DATE)


def _p2_inputs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return reports.transitions_inputs(fx.baskets(t), fx.product_collections(t), fx.products(t), **_P2)


@register("top_transitions_30d")
def q_top_transitions_30d(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return reports.product_transitions(fx.baskets(t), fx.product_collections(t), fx.products(t), flagship=P.FLAGSHIP,
                                       start=P.BASKET_START, end=P.BASKET_END, launch=P.LAUNCH_DATE,
                                       max_days=P.REFERENCE_WINDOW_DAYS, top_n=P.TOP_N)


@register("first_order_cohorts")
def q_first_order_cohorts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return reports.transition_cohorts(fx.baskets(t), fx.product_collections(t), fx.products(t), **_P2)[1]


@register("eligible_lines")
def q_eligible_lines(spark, sf_dir):
    t = Tables(spark, sf_dir)
    lines = journeys.transition_lines(fx.baskets(t), fx.product_collections(t), fx.products(t), P.FLAGSHIP,
                                      P.BASKET_START, P.BASKET_END)
    cohorts = journeys.first_order_cohorts(journeys.transition_orders(lines), P.LAUNCH_DATE)
    el = journeys.eligible_lines(lines, cohorts)
    return el.select("cohort_type", "user_id", "order_id", "order_date", "product_id", "product_name", "units",
                     F.col("price").cast("double").alias("price"), F.col("margin_amt").cast("double").alias("margin_amt"),
                     F.round(F.col("margin_pct"), 6).cast("double").alias("margin_pct"), "is_fv", "is_game")


@register("next_flagged_order")
def q_next_flagged_order(spark, sf_dir):
    _, orders = _p2_inputs(spark, sf_dir)
    return journeys.next_flagged_orders(orders)


@register("transition_edges")
def q_transition_edges(spark, sf_dir):
    lines, orders = _p2_inputs(spark, sf_dir)
    return journeys.transition_edges(journeys.next_flagged_orders(orders), lines, journeys.DIRECTION_FLAGSHIP_TO_GAME,
                                     journeys.DIRECTION_GAME_TO_FLAGSHIP)


@register("top_transitions")
def q_top_transitions(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return reports.product_transitions(fx.baskets(t), fx.product_collections(t), fx.products(t), flagship=P.FLAGSHIP,
                                       start=P.BASKET_START, end=P.BASKET_END, launch=P.LAUNCH_DATE,
                                       max_days=P.MAX_DAYS_TO_NEXT, top_n=P.TOP_N)


# ---------------------------------------------------------------- P3 / P4 fx and royalty statements


@register("implied_daily_rate")
def q_implied_daily_rate(spark, sf_dir):
    r = fxop.implied_daily_rate(fx.shop_orders(Tables(spark, sf_dir)))
    return r.select("rate_date", "currency", F.col("conversion_to_publisher").cast("double")
                    .alias("conversion_to_publisher"))


@register("first_partial_refunds")
def q_first_partial_refunds(spark, sf_dir):
    return royalty.first_partial_refunds(fx.notes(Tables(spark, sf_dir)))


@register("royalty_statement")
def q_royalty_statement(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return royalty.royalty_statement(fx.sales_lines(t), fx.products(t), fx.shop_orders(t), start=P.ROYALTY_START,
                                     end=P.ROYALTY_END, as_of=P.ROYALTY_AS_OF, channel_col=P.ROYALTY_CHANNEL,
                                     currency=P.ROYALTY_CURRENCY,
                                     percentage=P.ROYALTY_PERCENTAGE)


@register("refund_statement")
def q_refund_statement(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return royalty.refund_statement(fx.sales_lines(t), fx.products(t), fx.shop_orders(t), fx.notes(t),
                                    min_order_date=P.REFUND_MIN_ORDER_DATE, event_from=P.REFUND_EVENT_FROM,
                                    event_to=P.REFUND_EVENT_TO, as_of=P.ROYALTY_AS_OF,
                                    channel_col=P.ROYALTY_CHANNEL, currency=P.ROYALTY_CURRENCY, percentage=P.ROYALTY_PERCENTAGE)


# ---------------------------------------------------------------- P6 distributor reconciliation


def decimals_as_double(df: DataFrame) -> DataFrame:
    """Hand decimal results out as double (after all rounding happened in decimals)."""
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def _p6(spark, sf_dir):
    t = Tables(spark, sf_dir)
    report = fx.distributor_report(t, P.RECON_START, P.RECON_END)
    return t, report


@register("contract_rename")
def q_contract_rename(spark, sf_dir):
    _, report = _p6(spark, sf_dir)
    return decimals_as_double(contracts.read_distributor_report(report))


@register("previous_month_lines")
def q_previous_month_lines(spark, sf_dir):
    """IO10 + PF9: the order lines of the full month before the as-of date."""
    from tillroll.functions.dates import half_open

    start, end, _, _ = previous_month(P.RECON_AS_OF)
    od = fx.order_details(Tables(spark, sf_dir))
    return od.where(half_open("order_date", start, end)).select(
        "order_id", "iid", F.to_date("order_date").alias("order_date"), "status", "product_id")


@register("partner_aggregate")
def q_partner_aggregate(spark, sf_dir):
    _, report = _p6(spark, sf_dir)
    return decimals_as_double(reconcile.partner_aggregate(contracts.read_distributor_report(report)))


@register("order_line_terms")
def q_order_line_terms(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return decimals_as_double(reconcile.order_line_terms(
        fx.sales_lines(t), fx.products(t), fx.suppliers(t), fx.product_discounts(t), fx.star_deals(t),
        start=P.RECON_START, end=P.RECON_END))


@register("overcharge_detail")
def q_overcharge_detail(spark, sf_dir):
    t, report = _p6(spark, sf_dir)
    detail, _ = reports.distributor_overcharge(report, fx.sales_lines(t), fx.products(t), fx.suppliers(t),
                                               fx.product_discounts(t), fx.star_deals(t), start=P.RECON_START,
                                               end=P.RECON_END)
    return decimals_as_double(detail)


@register("overcharge_match_counts")
def q_overcharge_match_counts(spark, sf_dir):
    t, report = _p6(spark, sf_dir)
    partner = reconcile.partner_aggregate(contracts.read_distributor_report(report))
    return reconcile.match_counts(partner, reconcile.reduce_to_keys(fx.sales_lines(t), partner, "iid"))


@register("overcharge_by_title")
def q_overcharge_by_title(spark, sf_dir):
    t, report = _p6(spark, sf_dir)
    _, pivot = reports.distributor_overcharge(report, fx.sales_lines(t), fx.products(t), fx.suppliers(t),
                                              fx.product_discounts(t), fx.star_deals(t), start=P.RECON_START,
                                              end=P.RECON_END)
    return decimals_as_double(pivot)


@register("report_preview")
def q_report_preview(spark, sf_dir):
    """IO15/O8: the first rows of a sorted report."""
    t, report = _p6(spark, sf_dir)
    _, pivot = reports.distributor_overcharge(report, fx.sales_lines(t), fx.products(t), fx.suppliers(t),
                                              fx.product_discounts(t), fx.star_deals(t), start=P.RECON_START,
                                              end=P.RECON_END)
    return decimals_as_double(sinks.preview(pivot, P.PREVIEW_ROWS))


@register("overcharge_from_buckets")
def q_overcharge_from_buckets(spark, sf_dir):
    """The same report from order lines that are kept in buckets by item id."""
    import uuid

    t, report = _p6(spark, sf_dir)
    folder = _report_folder(spark)
    buckets = bucket_count(t.lineitem.count(), LINE_BUCKETS)  # an order line is a row of lineitem, counted from its footers
    kept = write_bucketed(fx.order_lines(t), f"order_lines_by_iid_{uuid.uuid4().hex}", "iid", buckets, f"{folder}/lines",
                          fx.line_iid(), fx.line_columns)
    # the products' names are joined to the kept lines, after these are cut to the partner's iids
    _, pivot = reports.distributor_overcharge(report, fx.sales_lines(t, kept), fx.products(t), fx.suppliers(t),
                                              fx.product_discounts(t), fx.star_deals(t), start=P.RECON_START,
                                              end=P.RECON_END, buckets=buckets)
    return decimals_as_double(pivot)


# ---------------------------------------------------------------- P7 / P8 publisher invoice comparison


#: What the publisher's report and the reconciliation read of an order line.
P7_COLUMNS = ["product_id", "order_date", "line_number", "iid", "currency", "revenue_ex_vat", "royalty", "status", "promo_name",
              "bundle_name"]


def _p7(spark, sf_dir, variant="v2"):
    """Runs a job: the month's order lines, of which both the report and the own sales are made, are joined from lineitem and
    orders once and checkpointed."""
    t = Tables(spark, sf_dir)
    month = cut_lineage(fx.order_details(t, fx.month_orders(t, P.RECON_START, P.RECON_END)).select(*P7_COLUMNS))
    report = fx.publisher_report(t, P.RECON_START, P.RECON_END, month)
    publisher = P.PROMO_PUBLISHER_V1 if variant == "v1" else P.PROMO_PUBLISHER
    return reports.PublisherReconciliation(report, fx.shop_orders(t), fx.sales_lines(t, month), fx.products(t),
                                            fx.suppliers(t), as_of=P.RECON_AS_OF, partner_flag=P.PARTNER_FLAG,
                                            promo_publisher=publisher,
                                            promo_supplier=P.PROMO_SUPPLIER, threshold=P.MATCH_THRESHOLD,
                                            overrides=P.PUBLISHER_OVERRIDES, variant=variant)


@register("normalize_names")
def q_normalize_names(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rep = contracts.trim_headers(fx.publisher_report(t, P.RECON_START, P.RECON_END))
    pubs = rep.select(F.col("Publisher Name").alias("name")).distinct()
    sups = fx.suppliers(t).select(F.col("supplier_name").alias("name"))
    names = pubs.unionByName(sups).distinct()
    return names.select("name", normalize_name("name").alias("name_norm"))


@register("currency_rates_as_of")
def q_currency_rates_as_of(spark, sf_dir):
    start = previous_month(P.RECON_AS_OF)[0]
    r = fxop.as_of_rates(fxop.rates_to_gbp(fx.shop_orders(Tables(spark, sf_dir))), start)
    return r.select("currency", F.col("rate_to_gbp").cast("double").alias("rate_to_gbp"))


@register("fuzzy_match")
def q_fuzzy_match(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rep = contracts.trim_headers(fx.publisher_report(t, P.RECON_START, P.RECON_END))
    sups = fx.suppliers(t)
    return matching.fuzzy_match_table(rep, sups, "Publisher Name", "supplier_name", P.MATCH_THRESHOLD)


@register("fuzzy_match_blocked")
def q_fuzzy_match_blocked(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rep = contracts.trim_headers(fx.publisher_report(t, P.RECON_START, P.RECON_END))
    return matching.fuzzy_match_table(rep, fx.suppliers(t), "Publisher Name", "supplier_name", P.MATCH_THRESHOLD,
                                      blocking=3)


@register("fuzzy_match_low")
def q_fuzzy_match_low(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rep = contracts.trim_headers(fx.publisher_report(t, P.RECON_START, P.RECON_END))
    return matching.fuzzy_match_table(rep, fx.suppliers(t), "Publisher Name", "supplier_name", P.LOW_MATCH_THRESHOLD)


def _p7_parts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    start, end, _, _ = previous_month(P.RECON_AS_OF)
    rep = contracts.trim_headers(fx.publisher_report(t, P.RECON_START, P.RECON_END))
    return t, rep, start, end


@register("partner_totals")
def q_partner_totals(spark, sf_dir):
    _, rep, _, _ = _p7_parts(spark, sf_dir)
    return decimals_as_double(reconcile.partner_totals(rep))


@register("converted_totals")
def q_converted_totals(spark, sf_dir):
    t, rep, start, _ = _p7_parts(spark, sf_dir)
    rates = fxop.as_of_rates(fxop.rates_to_gbp(fx.shop_orders(t)), start)
    conv = reconcile.override_names(reconcile.convert_to_gbp(reconcile.partner_totals(rep), rates),
                                    reconcile.PUBLISHER, P.PUBLISHER_OVERRIDES)
    return decimals_as_double(conv)


@register("supplier_royalty_totals")
def q_supplier_royalty_totals(spark, sf_dir):
    t, _, start, end = _p7_parts(spark, sf_dir)
    return decimals_as_double(reconcile.supplier_royalty_totals(fx.sales_lines(t), fx.products(t), fx.suppliers(t),
                                                                start=start, end=end, partner_flag=P.PARTNER_FLAG))


@register("promo_item_royalties")
def q_promo_item_royalties(spark, sf_dir):
    t, _, start, end = _p7_parts(spark, sf_dir)
    return decimals_as_double(reconcile.promo_item_royalties(fx.sales_lines(t), supplier=P.PROMO_SUPPLIER,
                                                             start=start, end=end))


@register("publisher_comparison")
def q_publisher_comparison(spark, sf_dir):
    return decimals_as_double(_p7(spark, sf_dir).comparison())


@register("promo_adjusted_detail")
def q_promo_adjusted_detail(spark, sf_dir):
    return decimals_as_double(_p7(spark, sf_dir).detail())


@register("adjusted_comparison")
def q_adjusted_comparison(spark, sf_dir):
    return decimals_as_double(_p7(spark, sf_dir).adjusted())


# ---------------------------------------------------------------- sinks


@register("promo_adjusted_detail_v1")
def q_promo_adjusted_detail_v1(spark, sf_dir):
    return decimals_as_double(_p7(spark, sf_dir, "v1").detail())


@register("adjusted_comparison_v1")
def q_adjusted_comparison_v1(spark, sf_dir):
    return decimals_as_double(_p7(spark, sf_dir, "v1").adjusted())


@register("sheet_rows")
def q_sheet_rows(spark, sf_dir):
    return sinks.sheet_rows(_p7(spark, sf_dir).adjusted())


# ---------------------------------------------------------------- scans and sinks, written and read back


def _report_folder(spark) -> str:
    import uuid

    from tillroll.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark)}/reports-{uuid.uuid4().hex}"


@register("snapshot_scan")
def q_snapshot_scan(spark, sf_dir):
    """IO2: of three month-stamped snapshots, the latest that is not after the as-of month, by its last load."""
    lines = fx.order_details(Tables(spark, sf_dir))
    name = "order_lines_snapshot"
    for stamp, kept in (("1998_06_b", F.lit(False)), ("1998_07_a", F.lit(False)), ("1998_07_b", F.lit(True)),
                        ("1998_08_a", F.lit(False)), ("1998_13_x", F.lit(False))):
        lines.where(kept).createOrReplaceTempView(f"{name}_{stamp}")
    return read_snapshot(spark, name, "1998-07-15").select("order_id", "iid", "product_id", "status", "line_number")


@register("sql_parameters")
def q_sql_parameters(spark, sf_dir):
    """IO3/IO5: a SQL text with bound parameters."""
    fx.order_details(Tables(spark, sf_dir)).createOrReplaceTempView("order_lines_by_sql")
    return sql_frame(spark, "SELECT status, count(*) AS n_lines FROM order_lines_by_sql WHERE order_date >= :since "
                            "AND order_date < :until GROUP BY status", since=P.RECON_START, until=P.RECON_END)


@register("report_files")
def q_report_files(spark, sf_dir):
    """IO12 + IO6 + IO9: the partner's report written as CSV and read back through its contract."""
    _, report = _p6(spark, sf_dir)
    folder = f"{_report_folder(spark)}/partner"
    sinks.write_csv(report, folder)
    return decimals_as_double(contracts.read_distributor_report(contracts.read_report_files(spark, folder)))


@register("replaced_report")
def q_replaced_report(spark, sf_dir):
    """IO14: a report written under its name, replaced by one made from its own last version, and read back by its name."""
    _, rep, _, _ = _p7_parts(spark, sf_dir)
    base, totals = _report_folder(spark), decimals_as_double(reconcile.partner_totals(rep))
    sinks.replace_report(totals.limit(0), base, "Partner totals")
    sinks.replace_report(sinks.read_report(spark, base, "Partner totals").unionByName(totals), base, "Partner totals")
    return sinks.read_report(spark, base, "Partner totals")


@register("sheet_lines")
def q_sheet_lines(spark, sf_dir):
    """IO13 + O5: the overcharge by title as lines of a sheet, the header first, then by total, descending."""
    t, report = _p6(spark, sf_dir)
    _, pivot = reports.distributor_overcharge(report, fx.sales_lines(t), fx.products(t), fx.suppliers(t),
                                              fx.product_discounts(t), fx.star_deals(t), start=P.RECON_START,
                                              end=P.RECON_END)
    title, total = pivot.columns
    return sinks.sheet_lines(pivot.select(title, F.col(f"`{total}`").cast("decimal(38,2)").alias(total)),
                             [F.col(f"`{total}`").desc_nulls_last(), F.col(f"`{title}`").asc_nulls_last()])


def _partner_files(spark, sf_dir):
    return fx.partner_files(Tables(spark, sf_dir), P.RECON_START, P.RECON_END)


@register("column_formats")
def q_column_formats(spark, sf_dir):
    """IO9/F32: how each file writes each date column, with the cells that tell it."""
    found = formats.column_formats(_partner_files(spark, sf_dir), ["sold", "shipped"], by="file")
    return found.select("source", "column", "shape", "pattern", "cells", "rival_cells", "conflicts", "filled", "decided")


@register("dates_by_file")
def q_dates_by_file(spark, sf_dir):
    """IO9/F32: both date columns of every row, each read as its file writes it."""
    return formats.read_dates(_partner_files(spark, sf_dir), ["sold", "shipped"], by="file")


@register("dates_of_one_office")
def q_dates_of_one_office(spark, sf_dir):
    """IO9/F32: the files of the office that writes the day first, read without their names."""
    home = _partner_files(spark, sf_dir).where("file = 'home.csv'").drop("file")
    return formats.read_dates(home, ["sold", "shipped"])


@register("lost_cells")
def q_lost_cells(spark, sf_dir):
    """IO9/F32: cells of the partner's report that typing could not read."""
    _, report = _p6(spark, sf_dir)
    named = report.withColumnsRenamed(contracts.DISTRIBUTOR_COLUMNS)
    typed = contracts.read_distributor_report(report)
    return formats.lost_cells(named, typed, [*contracts.DISTRIBUTOR_DATES, *contracts.DISTRIBUTOR_NUMERICS])


@register("sheet_rows_dates")
def q_sheet_rows_dates(spark, sf_dir):
    """IO13 + F31/X3: spreadsheet cells of a report with a date column."""
    _, report = _p6(spark, sf_dir)
    partner = reconcile.partner_aggregate(contracts.read_distributor_report(report))
    return sinks.sheet_rows(partner.select("ctid_1", "iid", "original_date_of_sale", "product_title"))


@register("top_transitions_ranked")
def q_top_transitions_ranked(spark, sf_dir):
    """The order of the transition report as a column."""
    lines, orders = _p2_inputs(spark, sf_dir)
    edges = journeys.transition_edges(journeys.next_flagged_orders(orders), lines, journeys.DIRECTION_FLAGSHIP_TO_GAME,
                                      journeys.DIRECTION_GAME_TO_FLAGSHIP)
    return journeys.top_transitions(edges, P.MAX_DAYS_TO_NEXT, P.TOP_N, rank="place")


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)

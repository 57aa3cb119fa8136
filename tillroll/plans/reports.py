"""The reports (composite operators P1-P8), each a chain of library operators over input DataFrames.

Inputs are DataFrames with the logical schemas of FIXTURES.md (order lines, products, collections, ...); every
brand name, date and threshold is an argument.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.operators import journeys, segments
from tillroll.session import cut_lineage


def order_journey(order_details: DataFrame, collections: DataFrame, products: DataFrame, *, flagship: str,
                  start, end, window_days: int = 30, flagship_label: str | None = None,
                  bare_numeric: str = "decimal(18,0)", sort: bool = True) -> DataFrame:
    """Per order, its type, gap to the previous order, both cross-sell flags and first-purchase cohort."""
    label = flagship_label or flagship
    lines = segments.journey_lines(order_details, collections, products, flagship, start, end,
                                   flagship_label=label)
    orders = segments.order_rollup(lines, label, bare_numeric)
    rows = journeys.order_journey_rows(orders, window_days, bare_numeric, keep=[
        "order_month", "order_type", "order_revenue_total", "order_margin_total"])
    return journeys.order_journey_report(rows, bare_numeric, sort)


def transition_cohorts(order_details: DataFrame, collections: DataFrame, products: DataFrame, *, flagship: str, start,
                       end, launch, flagship_label: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(lines, the two cohorts' users) of P2, lazily."""
    lines = journeys.transition_lines(order_details, collections, products, flagship, start, end, flagship_label)
    return lines, journeys.first_order_cohorts(journeys.transition_orders(lines), launch)


def transitions_inputs(order_details: DataFrame, collections: DataFrame, products: DataFrame, **kw):
    """Eligible lines and orders of the two cohorts (P2 up to `orders`). Runs a job: the eligible lines feed the forward
    fill and both sides of the edge join, so a reliable checkpoint (shared checkpoint folder) computes them once instead
    of re-reading and re-joining the order lines in every branch."""
    lines, cohorts = transition_cohorts(order_details, collections, products, **kw)
    needed = ["order_id", "user_id", "order_ts", "order_date", "product_name", "is_fv", "is_game"]
    el_lines = cut_lineage(lines.select(*needed).join(cohorts.select("user_id"), "user_id", "left_semi"))
    return el_lines, journeys.transition_orders(el_lines)


def product_transitions(order_details: DataFrame, collections: DataFrame, products: DataFrame, *, flagship: str,
                        start, end, launch, max_days: int = 30, top_n: int = 50,
                        directions: tuple[str, str] = (journeys.DIRECTION_FLAGSHIP_TO_GAME,
                                                       journeys.DIRECTION_GAME_TO_FLAGSHIP),
                        flagship_label: str | None = None) -> DataFrame:
    """Top-N product transitions flagship -> game and game -> flagship among the two first-order cohorts."""
    lines, orders = transitions_inputs(order_details, collections, products, flagship=flagship, start=start,
                                          end=end, launch=launch, flagship_label=flagship_label)
    pairs = journeys.next_flagged_orders(orders)
    edges = journeys.transition_edges(pairs, lines, *directions)
    return journeys.top_transitions(edges, max_days, top_n)


def distributor_overcharge(report: DataFrame, order_details: DataFrame, products: DataFrame, suppliers: DataFrame,
                           discounts: DataFrame, star_deals: DataFrame, *, start, end, buckets: int | None = None):
    """(detail rows, total overcharge per title) for a distributor report in spreadsheet form. `buckets`: those that the
    order lines are kept in by iid, if they are."""
    from tillroll.operators import reconcile
    from tillroll.sources.contracts import read_distributor_report

    partner = reconcile.partner_aggregate(read_distributor_report(report))
    # the whole order-line table is cut to the partner's iids before it is joined to anything
    own = reconcile.reduce_to_keys(order_details, partner, "iid", buckets)
    lines = reconcile.order_line_terms(own, products, suppliers, discounts, star_deals, start=start, end=end)
    detail = reconcile.overcharge_detail(partner, lines)
    return detail, reconcile.overcharge_by_title(detail)


class PublisherReconciliation:
    """P7 + P8 for the previous full month of `as_of`; each result is built only when it is asked for.

    variant "v2" is the second script (rate at the month start, supplier-table names, substring publisher filter,
    fallback to the converted price); "v1" is the first one (latest rate as of `as_of`, names stored on the order
    lines, 3-character blocking, whole-name publisher filter, our promo name kept, no fallback)."""

    def __init__(self, report: DataFrame, shop_orders: DataFrame, order_details: DataFrame, products: DataFrame,
                 suppliers: DataFrame, *, as_of, partner_flag: str, promo_publisher: str, promo_supplier: str,
                 threshold: float = 90, overrides: dict | None = None, blocking: int | None = None, variant: str = "v2"):
        from tillroll.functions.dates import previous_month
        from tillroll.sources.contracts import trim_headers

        self.v1 = variant == "v1"
        self.start, self.end, _, _ = previous_month(as_of)
        self.report, self.as_of = trim_headers(report), as_of
        self.shop_orders, self.order_details, self.products, self.suppliers = shop_orders, order_details, products, suppliers
        self.partner_flag, self.promo_publisher, self.promo_supplier = partner_flag, promo_publisher, promo_supplier
        self.threshold, self.overrides = threshold, overrides
        self.blocking = 3 if self.v1 and blocking is None else blocking

    def comparison(self) -> DataFrame:
        """P7. Runs jobs: the partner's totals and the suppliers' royalties (two small tables that the matching and the
        join back both read) and the distinct names are checkpointed."""
        from tillroll.operators import fx, reconcile

        rates = fx.as_of_rates(fx.rates_to_gbp(self.shop_orders), self.as_of if self.v1 else self.start)
        royalties = reconcile.supplier_royalty_totals(
            self.order_details, self.products, self.suppliers, start=self.start, end=self.end,
            partner_flag=self.partner_flag, name_from="line" if self.v1 else "supplier")
        return reconcile.publisher_comparison(self.report, rates, cut_lineage(royalties), threshold=self.threshold,
                                              overrides=self.overrides, blocking=self.blocking)

    def detail(self) -> DataFrame:
        """P8 rows, lazily."""
        from tillroll.operators import reconcile

        promo = reconcile.promo_item_royalties(self.order_details, supplier=self.promo_supplier, start=self.start, end=self.end)
        return reconcile.promo_adjusted_detail(self.report, promo, publisher=self.promo_publisher,
                                               match="equals" if self.v1 else "contains", keep_promo_name=self.v1)

    def adjusted(self) -> DataFrame:
        """P8 totals next to P7."""
        from tillroll.operators import reconcile

        return reconcile.adjusted_comparison(self.comparison(), self.detail(), fallback=not self.v1)

"""Benchmark: headline reports at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

plan runs, nothing is collected), median per query; "value" is the sum of the medians. The two window rewrites are
also timed in the reference's literal self-join form ("*_selfjoin"), which is reported under "baselines" and not
counted in the value.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

sys.path.insert(0, os.path.join(ROOT, "tests"))

import selfjoin as literal  # noqa: E402
from tillroll.plans import params as P, queries as Q  # noqa: E402
from tillroll.plans import reports  # noqa: E402
from tillroll.session import get_spark  # noqa: E402
from tillroll.sources import fixtures as fx  # noqa: E402
from tillroll.sources.tables import Tables  # noqa: E402
from tillroll.operators import journeys, segments  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

HEADLINE = [
    "search_funnel", "order_journey", "order_journey_sales", "top_transitions", "royalty_statement",
    "refund_statement", "overcharge_by_title", "overcharge_detail", "publisher_comparison", "adjusted_comparison",
    "followed_within", "next_flagged_order", "fuzzy_match",
]


def _time(df_fn, runs: int) -> float:
    df_fn().write.format("noop").mode("overwrite").save()  # warm-up
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        df_fn().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=cpus)
    qs = Q.queries()
    results = {}
    for name in HEADLINE:
        results[name] = round(_time(lambda n=name: qs[n](spark, sf_dir), runs), 3)

    t = Tables(spark, sf_dir)

    def basket_orders():
        lines = segments.journey_lines(fx.baskets(t), fx.product_collections(t), fx.products(t), P.FLAGSHIP,
                                       P.BASKET_START, P.BASKET_END)
        return segments.order_rollup(lines, P.FLAGSHIP)

    def transition_orders():
        _, orders = reports.transitions_inputs(fx.baskets(t), fx.product_collections(t), fx.products(t),
                                                  flagship=P.FLAGSHIP, start=P.BASKET_START, end=P.BASKET_END,
                                                  launch=P.LAUNCH_DATE)
        return orders

    def hot(df):
        """The same orders with every third user folded into one (derived from the tables): one user holds a third of
        all orders, the skew the design must survive."""
        return df.withColumn("user_id", F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))

    def hot_day(df):
        """The same, with all of that user's orders on one day (their times of day stay)."""
        on_day = F.to_timestamp_ntz(F.concat(F.lit("2024-01-01 "), F.date_format("order_ts", "HH:mm:ss")))
        first = F.col("user_id") == 0
        return hot(df).withColumns({"order_ts": F.when(first, on_day).otherwise(F.col("order_ts").cast("timestamp_ntz")),
                                    "order_date": F.when(first, F.to_date(on_day)).otherwise(F.col("order_date"))})

    def all_transition_orders():
        lines = journeys.transition_lines(fx.baskets(t), fx.product_collections(t), fx.products(t), P.FLAGSHIP,
                                          P.BASKET_START, P.BASKET_END)
        return journeys.transition_orders(lines)

    baselines = {
        "followed_within_hot_users_selfjoin": round(_time(
            lambda: literal.followed_within_selfjoin(hot(basket_orders()), P.SEQ_WINDOW_DAYS), runs), 3),
        "followed_within_hot_users_window": round(_time(
            lambda: journeys.order_journey_rows(hot(basket_orders()), P.SEQ_WINDOW_DAYS), runs), 3),
        "next_flagged_hot_users_selfjoin": round(_time(
            lambda: literal.next_flagged_both(hot(all_transition_orders())), runs), 3),
        "next_flagged_hot_day_selfjoin": round(_time(
            lambda: literal.next_flagged_both(hot_day(all_transition_orders())), runs), 3),
        "next_flagged_hot_day_window": round(_time(
            lambda: journeys.next_flagged_orders(hot_day(all_transition_orders())), runs), 3),
        "next_flagged_hot_users_window": round(_time(
            lambda: journeys.next_flagged_orders(hot(all_transition_orders())), runs), 3),
        "followed_within_selfjoin": round(_time(
            lambda: literal.followed_within_selfjoin(basket_orders(), P.SEQ_WINDOW_DAYS), runs), 3),
        "next_flagged_order_selfjoin": round(_time(
            lambda: literal.next_flagged_both(transition_orders()), runs), 3),
        "followed_within_window": round(_time(
            lambda: journeys.order_journey_rows(basket_orders(), P.SEQ_WINDOW_DAYS), runs), 3),
    }
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds", "value": round(sum(results.values()), 3), "unit": "sec",
        "queries": results, "baselines": baselines, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "runs": runs, "master": f"local[{cpus}]", "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

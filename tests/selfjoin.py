"""The reference's literal self-join forms of the two window rewrites, kept only as benchmark baselines.

`followed_within` (W2/W3) and `next_flagged_orders` (J9) are computed in the library with windows over a per-(user,
day) summary; these functions build the self join + ROW_NUMBER = 1 plans the reference writes, so `bench.py` can time
both on the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def followed_within_selfjoin(orders: DataFrame, window_days: int) -> DataFrame:
    """seq_g2fv / seq_fv2g per (user, order) by the range self join (quadratic per user)."""
    o1 = orders.alias("o1")
    o2 = orders.alias("o2")
    cond = ((F.col("o2.user_id") == F.col("o1.user_id")) & (F.col("o1.order_date") < F.col("o2.order_date"))
            & (F.col("o2.order_date") <= F.date_add(F.col("o1.order_date"), window_days)))
    pure_game = ((F.col("o1.has_game") == 1) & (F.col("o1.has_fv") == 0) & (F.col("o1.has_dlc") == 0)
                 & (F.col("o1.has_other") == 0))
    pure_fv = ((F.col("o1.has_fv") == 1) & (F.col("o1.has_game") == 0) & (F.col("o1.has_dlc") == 0)
               & (F.col("o1.has_other") == 0))
    w = Window.partitionBy("o1.user_id", "o1.order_id").orderBy(F.col("o2.order_date"), F.col("o2.order_id"))
    a = o1.join(o2, cond & pure_game & (F.col("o2.has_fv") == 1)) \
        .select(F.col("o1.user_id").alias("user_id"), F.col("o1.order_id").alias("order_id"),
                F.row_number().over(w).alias("rn")).where("rn = 1").select("user_id", "order_id",
                                                                           F.lit(1).alias("seq_g2fv"))
    b = o1.join(o2, cond & pure_fv & (F.col("o2.has_game") == 1)) \
        .select(F.col("o1.user_id").alias("user_id"), F.col("o1.order_id").alias("order_id"),
                F.row_number().over(w).alias("rn")).where("rn = 1").select("user_id", "order_id",
                                                                           F.lit(1).alias("seq_fv2g"))
    return orders.join(a, ["user_id", "order_id"], "left").join(b, ["user_id", "order_id"], "left") \
        .select("user_id", "order_id", F.coalesce("seq_g2fv", F.lit(0)).alias("seq_g2fv"),
                F.coalesce("seq_fv2g", F.lit(0)).alias("seq_fv2g"))


def next_flagged_selfjoin(orders: DataFrame) -> DataFrame:
    """Same-or-next game order after each flagship order by the `>=` self join + ROW_NUMBER = 1."""
    b = orders.where(F.col("has_fv") == 1).alias("b")
    ng = orders.where(F.col("has_game") == 1).alias("ng")
    pos_b = F.struct(F.col("b.order_ts"), F.col("b.order_id"))
    pos_n = F.struct(F.col("ng.order_ts"), F.col("ng.order_id"))
    j = b.join(ng, (F.col("ng.user_id") == F.col("b.user_id")) & (pos_n >= pos_b))
    w = Window.partitionBy("b.user_id", "b.order_id").orderBy(F.col("ng.order_ts"), F.col("ng.order_id"))
    return j.select(F.col("b.user_id").alias("user_id"), F.col("b.order_id").alias("source_order_id"),
                    F.col("ng.order_id").alias("target_order_id"), F.row_number().over(w).alias("rn")) \
        .where("rn = 1").drop("rn")


def next_flagged_both(orders: DataFrame) -> DataFrame:
    """Both directions, as `journeys.next_flagged_orders` returns them, by one self join each."""
    swapped = orders.select("order_id", "user_id", "order_ts", "order_date", F.col("has_game").alias("has_fv"),
                            F.col("has_fv").alias("has_game"))
    return next_flagged_selfjoin(orders).withColumn("kind", F.lit("fv2game")).unionByName(
        next_flagged_selfjoin(swapped).withColumn("kind", F.lit("game2fv")))

"""Customer journeys over orders (P1: W1-W4, J3-J5, A8; P2: W5-W8, J6-J11).

Scale design. The reference answers "previous order", "followed within N days" and "next flagged order" with self
joins per user, which are quadratic in a user's order count. Here they are windows, and the windows of the first two never
run over a user's raw orders: orders are first reduced to one row per (user, calendar day) with a partially aggregated
`groupBy`, and the per-user window runs over that summary. A user's window partition is therefore bounded by the
number of days in the report period, whatever the user's order volume, so a user (or a null user id) holding a third
of all orders is split across (user, day) keys by the shuffle and only its day summary meets in one task. The
per-order answer is attached back with one equi join on (user, day), whose right side is unique per key (AQE's skew
join splits a hot left key). "Next flagged order" needs the orders themselves: users with very many of them are cut into
segments of equal size by a range sort (`next_flagged_orders`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.dates import months_between_boundaries
from tillroll.operators.ordering import positions
from tillroll.session import cut_lineage

USER, DAY = "user_id", "order_date"

#: Most orders of one user in one window partition of the forward fill, and most products of a basket that are paired in one row.
SEGMENT_ORDERS, BASKET_BLOCK = 100_000, 1_000

# The transition report's cohort labels and its default direction labels.
COHORT_FLAGSHIP_FIRST = "FV_FIRST"
COHORT_GAME_THEN_FLAGSHIP = "GAME_THEN_FV"
DIRECTION_FLAGSHIP_TO_GAME = "FV→Game"
DIRECTION_GAME_TO_FLAGSHIP = "Game→FV"


def _pure(flag: str, others: list[str]) -> Column:
    cond = F.col(flag) == 1
    for o in others:
        cond = cond & (F.col(o) == 0)
    return cond


# ---------------------------------------------------------------- P1 building blocks

def order_day_profile(orders: DataFrame, window_days: int) -> DataFrame:
    """One row per (user_id, order_date) of an order roll-up (A3 output).

    Columns: first_order_id (smallest order id that day, the one whose LAG reaches the previous day),
    prev_order_date (LAG over distinct days), fv_ahead / game_ahead (1 if a flagship / game order falls in
    (day, day + window_days]), first_order_date (MIN over the user).
    """
    days = orders.groupBy(USER, DAY).agg(
        F.min("order_id").alias("first_order_id"),
        F.max("has_fv").alias("day_has_fv"),
        F.max("has_game").alias("day_has_game"),
    )
    # one ordering for all three (days are unique per user here), so Spark sorts each user's days once
    in_order = Window.partitionBy(USER).orderBy(F.unix_date(F.col(DAY)))
    ahead = in_order.rangeBetween(1, window_days)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return days.select(
        USER, DAY, "first_order_id",
        F.lag(DAY).over(in_order).alias("prev_order_date"),
        F.coalesce(F.max("day_has_fv").over(ahead), F.lit(0)).alias("fv_ahead"),
        F.coalesce(F.max("day_has_game").over(ahead), F.lit(0)).alias("game_ahead"),
        F.min(DAY).over(whole).alias("first_order_date"),
    )


def attach_day_profile(orders: DataFrame, profile: DataFrame) -> DataFrame:
    """Equi join (null-safe on user, as the reference's MIN window keeps null users together) on (user, day)."""
    p = profile.withColumnRenamed(USER, "_p_user").withColumnRenamed(DAY, "_p_day")
    cond = orders[USER].eqNullSafe(p["_p_user"]) & (orders[DAY] == p["_p_day"])
    return orders.join(p, cond, "left").drop("_p_user", "_p_day")


def order_gaps_expr() -> Column:
    """W1 on an order row with its day profile: days since the user's previous order (ties by order id).

    Null for the user's first order and for null users (the reference joins the gap back on user_id, S6)."""
    return (F.when(F.col(USER).isNull(), F.lit(None))
            .when(F.col("order_id") == F.col("first_order_id"), F.datediff(F.col(DAY), F.col("prev_order_date")))
            .otherwise(F.lit(0)))


def followed_within_exprs() -> dict[str, Column]:
    """W2/W3 on an order row with its day profile.

    seq_g2fv: a pure game order followed by any flagship order within the window; seq_fv2g: a pure flagship order
    followed by any game order. Null users never pair (the reference's self join drops them, S6)."""
    g2fv = _pure("has_game", ["has_fv", "has_dlc", "has_other"]) & (F.col("fv_ahead") == 1)
    fv2g = _pure("has_fv", ["has_other", "has_dlc", "has_game"]) & (F.col("game_ahead") == 1)
    ok = F.col(USER).isNotNull()
    return {
        "seq_g2fv": F.when(ok & g2fv, 1).otherwise(0),
        "seq_fv2g": F.when(ok & fv2g, 1).otherwise(0),
    }


def order_journey_rows(orders: DataFrame, window_days: int, bare_numeric: str = "decimal(18,0)",
                       materialize: bool = True, keep: list[str] | None = None) -> DataFrame:
    """Order rows (A3 grain) with days_since_prev_order, both sequence flags and first_order_month.

    The order roll-up feeds both the day profile and the join back, and Catalyst prunes the two branches
    differently, so they would not share an exchange: the roll-up (far smaller than the lines it comes from) is
    written once with a reliable checkpoint instead of scanning and aggregating the lines twice. `keep` names the
    roll-up's columns that the caller needs besides the keys and flags; no others are written."""
    if keep is not None:
        orders = orders.select(*dict.fromkeys([USER, "order_id", DAY, "has_fv", "has_game", "has_dlc", "has_other", *keep]))
    if materialize:
        orders = cut_lineage(orders)
    prof = order_day_profile(orders, window_days)
    x = attach_day_profile(orders, prof)
    flags = followed_within_exprs()
    x = x.select(
        *orders.columns,
        order_gaps_expr().cast(bare_numeric).alias("days_since_prev_order"),
        flags["seq_g2fv"].alias("seq_g2fv_row"),
        flags["seq_fv2g"].alias("seq_fv2g_row"),
        F.trunc("first_order_date", "MM").alias("first_order_month"),
    )
    # An order with lines on two days has two rows; the reference's join on (user, order) gives the flag to both.
    per_order = Window.partitionBy(USER, "order_id")
    return x.select(
        "*",
        F.max("seq_g2fv_row").over(per_order).cast("bigint").alias("seq_g2fv_30d_count"),  # a COUNT(*) of 0 or 1
        F.max("seq_fv2g_row").over(per_order).cast("bigint").alias("seq_fv2g_30d_count"),
    ).drop("seq_g2fv_row", "seq_fv2g_row")


def order_journey_report(rows: DataFrame, bare_numeric: str = "decimal(18,0)", sort: bool = True) -> DataFrame:
    """A8 + W4 + O1: one row per (order, user, month, type), newest month first, then by user and order, so that the
    range partitions of the sort split a month.

    The output has one row per order, so the final sort is a full range shuffle; `sort=False` skips it when the
    report is written to a table rather than read in order."""
    agg = rows.groupBy("order_id", USER, "order_month", "order_type").agg(
        F.count(F.lit(1)).alias("orders_count"),
        F.sum("order_revenue_total").cast("double").alias("revenue_total"),
        F.sum("order_margin_total").cast("double").alias("margin_total"),
        F.avg("days_since_prev_order").cast(bare_numeric).cast("double").alias("avg_days_between_orders"),
        F.sum("seq_g2fv_30d_count").cast("bigint").alias("seq_g2fv_30d_count"),
        F.sum("seq_fv2g_30d_count").cast("bigint").alias("seq_fv2g_30d_count"),
        *[F.when(F.sum(c) > 0, 1).otherwise(0).alias(c) for c in ("has_fv", "has_other", "has_dlc", "has_game")],
        F.min("first_order_month").alias("first_order_month"),
    )
    agg = agg.withColumn("months_since_first", months_between_boundaries("first_order_month", "order_month"))
    return agg.orderBy(F.col("order_month").desc(), USER, "order_id", "order_type") if sort else agg


# ---------------------------------------------------------------- P2 building blocks

def transition_lines(order_details: DataFrame, collections: DataFrame, products: DataFrame, flagship: str, start,
                     end, flagship_label: str | None = None) -> DataFrame:
    """P2 line CTE: lines in [start, end) with positive revenue and margin, product name, 0/1 flagship and game flags.

    No status filter here (S26). Unlike P1 the flag uses the unfolded segment, so 'Game' is not 'game' (S7)."""
    from tillroll.functions.dates import half_open
    from tillroll.functions.money import minor_to_major
    from tillroll.operators.segments import collection_flags, segment_expr

    label = flagship_label or flagship
    od = order_details.where(half_open("order_date", start, end) & (F.col("revenue_ex_vat") > 0)
                             & (F.col("margin") > 0))
    flags = collection_flags(collections, flagship)
    p = products.select("product_id", F.col("name").alias("product_name"), "product_type")
    x = od.join(flags, "product_id", "left").join(p, "product_id", "left")
    seg = segment_expr(F.col("is_flagship"), F.col("product_type"), label)
    price = minor_to_major("revenue_ex_vat")
    margin = minor_to_major("margin")
    return x.select(
        "order_id", USER,
        F.col("order_date").alias("order_ts"),  # kept as stored: no session time zone enters the day logic
        F.to_date("order_date").alias(DAY),
        "product_id", "product_name", "units",
        price.alias("price"), margin.alias("margin_amt"),
        F.when(price > 0, margin / price).alias("margin_pct"),  # F8: safe margin share
        F.when(seg == label, 1).otherwise(0).alias("is_fv"),
        F.when(seg == "game", 1).otherwise(0).alias("is_game"),
    )


def eligible_lines(lines: DataFrame, cohorts: DataFrame) -> DataFrame:
    """The cohorts' order lines with their cohort label (inner join on user; `cohorts` is one row per user)."""
    return lines.join(cohorts, USER)


def transition_orders(lines: DataFrame) -> DataFrame:
    """One row per (order_id, user_id): first line time and day, has_fv / has_game (BOOL_OR as MAX of 0/1, A6)."""
    return lines.groupBy("order_id", USER).agg(
        F.min("order_ts").alias("order_ts"),
        F.min(DAY).alias(DAY),
        F.max("is_fv").alias("has_fv"),
        F.max("is_game").alias("has_game"),
    )


def first_order_cohorts(orders: DataFrame, launch) -> DataFrame:
    """Users whose first order (by time, then order id) has a flagship line on/after launch
    (FV_FIRST), or was game-without-flagship and who later bought a flagship order on/after launch (GAME_THEN_FV).

    One partially aggregated `groupBy(user)`: MIN over a struct picks the first order, MAX finds the later purchase,
    so no per-user window or self join is needed."""
    from tillroll.functions.dates import as_date

    launch_d = as_date(launch)
    after = (F.col("has_fv") == 1) & (F.to_date("order_ts") >= launch_d)
    per_user = orders.where(F.col(USER).isNotNull()).groupBy(USER).agg(
        F.min(F.struct("order_ts", "order_id", "has_fv", "has_game")).alias("first"),
        F.max(F.when(after, 1).otherwise(0)).alias("fv_after_launch"),
    )
    first = F.col("first")
    cohort = (F.when((first["has_fv"] == 1) & (F.to_date(first["order_ts"]) >= launch_d), F.lit(COHORT_FLAGSHIP_FIRST))
              .when((first["has_game"] == 1) & (first["has_fv"] == 0) & (F.col("fv_after_launch") == 1),
                    F.lit(COHORT_GAME_THEN_FLAGSHIP)))
    return per_user.select(USER, cohort.alias("cohort_type")).where(F.col("cohort_type").isNotNull())


def _filled(orders: DataFrame, *segment: str) -> DataFrame:
    """Orders with the same-or-next game and flagship order (`_g`, `_f`) of the user, or of the user's segment. The window runs in
    descending order with a frame up to the current row, which Spark extends row by row; the mirrored frame (current row to
    the end) would be rescanned for every row."""
    pos = F.struct("order_ts", "order_id", DAY)
    to_here = Window.partitionBy(USER, *segment).orderBy(F.col("order_ts").desc(), F.col("order_id").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return orders.select(USER, "order_id", DAY, "has_fv", "has_game", *segment,
                         F.last(F.when(F.col("has_game") == 1, pos), ignorenulls=True).over(to_here).alias("_g"),
                         F.last(F.when(F.col("has_fv") == 1, pos), ignorenulls=True).over(to_here).alias("_f"))


def _filled_in_segments(orders: DataFrame, segment_orders: int) -> DataFrame:
    """As `_filled`, for users with very many orders: a prefix scan. A range sort numbers a user's orders from the latest on and
    cuts them into segments of `segment_orders`, whatever their times are; the fill runs inside each segment, and the first
    hit of the nearest later segment is carried over from a table with one row per segment."""
    placed = positions(orders, [F.col("order_ts").desc(), F.col("order_id").desc()], [USER], name="_at")
    cut = placed.withColumn("_cut", F.floor(F.col("_at") / segment_orders)).drop("_at")
    pos = F.struct("order_ts", "order_id", DAY)
    later = Window.partitionBy(USER).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    carried = cut.groupBy(USER, "_cut").agg(
        F.min(F.when(F.col("has_game") == 1, pos)).alias("_g"), F.min(F.when(F.col("has_fv") == 1, pos)).alias("_f")).select(
        F.col(USER).alias("_u"), F.col("_cut").alias("_c"), F.last("_g", ignorenulls=True).over(later).alias("_g_later"),
        F.last("_f", ignorenulls=True).over(later).alias("_f_later"))
    x = _filled(cut, "_cut").join(carried, (F.col(USER) == F.col("_u")) & (F.col("_cut") == F.col("_c")))
    return x.select(USER, "order_id", DAY, "has_fv", "has_game", F.coalesce("_g", "_g_later").alias("_g"),
                    F.coalesce("_f", "_f_later").alias("_f"))


def next_flagged_orders(orders: DataFrame, segment_orders: int = SEGMENT_ORDERS) -> DataFrame:
    """J9 for both directions in one pass: for every flagship order the same-or-next game order of the user, and for
    every game order the same-or-next flagship order (order = first line time, then order id; S27: a mixed basket is
    its own successor). Same rows as the reference's `seq >= seq` self join + ROW_NUMBER = 1.

    A user with at most `segment_orders` orders is one window partition. Users with more are found first by a partial
    aggregate (one job; they are few, as each has that many orders) and are scanned in segments of that size, so that
    neither a busy user nor a user's busy hour meets in one task. The result does not depend on `segment_orders`."""
    o = orders.where(F.col(USER).isNotNull()).select(USER, "order_id", "order_ts", DAY, "has_fv", "has_game")
    busy = cut_lineage(o.groupBy(USER).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > segment_orders).select(USER))
    if busy.isEmpty():
        x = _filled(o)
    else:
        many = cut_lineage(o.join(busy, USER, "left_semi"))  # read by the range sort's sample, too
        x = _filled(o.join(busy, USER, "left_anti")).unionByName(_filled_in_segments(many, segment_orders))

    def edge(kind: str, flag: str, nxt: str) -> Column:
        to = F.col(nxt)
        return F.when((F.col(flag) == 1) & to.isNotNull(), F.struct(
            F.lit(kind).alias("kind"), to["order_id"].alias("t"), to[DAY].alias("td")))

    e = x.select(USER, "order_id", DAY, F.explode(F.array(
        edge("fv2game", "has_fv", "_g"), edge("game2fv", "has_game", "_f"))).alias("e"))
    return e.where(F.col("e").isNotNull()).select(
        F.col("e.kind").alias("kind"), USER, F.col("order_id").alias("source_order_id"),
        F.col(DAY).alias("source_date"), F.col("e.t").alias("target_order_id"), F.col("e.td").alias("target_date"))


def _block_pairs(pairs: DataFrame, roles: DataFrame, large: DataFrame, block: int) -> DataFrame:
    """The edges of order pairs with a large basket, as _s/_t products: both baskets are cut into blocks by their products' hash, and
    each pair of blocks, two short lists, is dealt to a task of its own, which pairs them."""
    blocks = F.coalesce(F.ceil(F.col("_n") / block), F.lit(1)).cast("int")
    cut = roles.join(large, ["order_id", "role"], "left").withColumn(
        "_block", F.pmod(F.xxhash64("product_name"), blocks).cast("int"))
    packs = cut_lineage(cut.groupBy("order_id", "role", "_block").agg(
        F.collect_list(F.struct("product_name")).alias("_products")))

    def side(name: str) -> DataFrame:
        return packs.select(F.col("order_id").alias(f"_{name}"), F.col("role").alias(f"_{name}role"),
                            F.col("_block").alias(f"_{name}block"), F.col("_products").alias(f"_{name}products"))

    s, t = side("s"), side("t")
    x = pairs.join(s, (pairs.source_order_id == s._s) & (pairs._sr == s._srole)).join(
        t, (F.col("target_order_id") == t._t) & (F.col("_tr") == t._trole))
    x = x.repartition("kind", USER, "source_order_id", "target_order_id", "_sblock", "_tblock")
    x = x.withColumn("_x", F.explode("_sproducts")).withColumn("_y", F.explode("_tproducts"))
    return x.select(*pairs.columns, F.col("_x.product_name").alias("source_product"), F.col("_y.product_name").alias("target_product"))


def transition_edges(pairs: DataFrame, lines: DataFrame, fv_to_game: str, game_to_fv: str,
                     block: int = BASKET_BLOCK) -> DataFrame:
    """Product-to-product edges of each order pair (cross product of the two orders' distinct products).

    One (order, product, role) table serves both directions: role 'fv' for flagship lines, 'game' for game lines. Baskets
    with more than `block` products of a role are found first by a partial aggregate (one job); order pairs with such a
    basket are dealt over tasks in pairs of blocks, so that no task makes more than about `block` squared edges of one order
    pair at a time. The result does not depend on `block`."""
    roles = lines.select("order_id", "product_name", F.explode(F.array(
        F.when(F.col("is_fv") == 1, F.lit("fv")), F.when(F.col("is_game") == 1, F.lit("game")))).alias("role")) \
        .where(F.col("role").isNotNull()).distinct()
    large = cut_lineage(roles.groupBy("order_id", "role").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block))
    fv2g = F.col("kind") == "fv2game"
    p = pairs.withColumns({"_sr": F.when(fv2g, "fv").otherwise("game"), "_tr": F.when(fv2g, "game").otherwise("fv")})
    s = roles.select(F.col("order_id").alias("_s"), F.col("role").alias("_srole"),
                     F.col("product_name").alias("source_product"))
    t = roles.select(F.col("order_id").alias("_t"), F.col("role").alias("_trole"),
                     F.col("product_name").alias("target_product"))

    def joined(p: DataFrame) -> DataFrame:
        return p.join(s, (p.source_order_id == s._s) & (p._sr == s._srole)).join(
            t, (F.col("target_order_id") == t._t) & (F.col("_tr") == t._trole)).select(
            *p.columns, "source_product", "target_product")

    if large.isEmpty():
        e = joined(p)
    else:
        named = large.select("order_id", "role", F.lit(True).alias("_l"))
        a = named.toDF("_ao", "_ar", "_al")
        b = named.toDF("_bo", "_br", "_bl")
        marked = cut_lineage(p.join(a, (p.source_order_id == a._ao) & (p._sr == a._ar), "left").join(
            b, (F.col("target_order_id") == b._bo) & (F.col("_tr") == b._br), "left").select(
            *p.columns, (F.col("_al").isNotNull() | F.col("_bl").isNotNull()).alias("_large")))
        e = joined(marked.where(~F.col("_large")).drop("_large")).unionByName(
            _block_pairs(marked.where("_large").drop("_large"), roles, large, block))
    return e.select(USER, "source_order_id", "target_order_id", "source_product", "target_product",
                    F.datediff("target_date", "source_date").alias("days_to_next"),
                    F.when(fv2g, F.lit(fv_to_game)).otherwise(F.lit(game_to_fv)).alias("direction"))


def top_transitions(edges: DataFrame, max_days: int, top_n: int, rank: str | None = None) -> DataFrame:
    """Per (direction, source, target) distinct users, order pairs and mean days, top-N per
    direction by users then pairs (names as the last tie-break, S4); `rank` names a column for the place.

    Edges are unique per (direction, user, source order, products), so the reference's DISTINCT pair count equals
    the row count; a null product name never matches the USING join, so its pair count is 0 (S8). The top-N is a
    `row_number` filter, which Spark plans as a partial WindowGroupLimit before the shuffle."""
    from tillroll.functions.money import avg_half_up

    e = edges.where(F.col("days_to_next") <= max_days)
    agg = e.groupBy("direction", "source_product", "target_product").agg(
        F.count_distinct(USER).alias("users"),
        F.count(F.lit(1)).alias("_pairs"),
        avg_half_up("days_to_next", 2).alias("avg_days_to_next"),
    )
    pairs = F.when(F.col("source_product").isNull() | F.col("target_product").isNull(), F.lit(0)) \
        .otherwise(F.col("_pairs")).cast("bigint")
    agg = agg.select("direction", "source_product", "target_product", F.col("users").cast("bigint").alias("users"),
                     pairs.alias("order_pairs"), "avg_days_to_next")
    w = Window.partitionBy("direction").orderBy(F.col("users").desc(), F.col("order_pairs").desc(),
                                                F.col("source_product").asc_nulls_last(),
                                                F.col("target_product").asc_nulls_last())
    ranked = agg.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= top_n)
    ranked = ranked.orderBy("direction", "_rk")
    return ranked.withColumnRenamed("_rk", rank) if rank else ranked.drop("_rk")

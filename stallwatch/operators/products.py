"""Decision products over signal tables, at brand and category grain."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwatch.functions.columns import first_match, percent, read_bands, round_to

KEY = ["brand", "category_normalized"]
GENDER = [*KEY, "gender"]


def newest(signal: DataFrame, day: str = "snapshot_date") -> DataFrame:
    """Rows of the table's latest day; the day is one value."""
    return signal.join(F.broadcast(signal.agg(F.max(day).alias(day))), day, "left_semi")


def _full(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer chain; rows whose key holds a null stay apart, as equality never holds for them."""
    return reduce(lambda a, b: a.join(b, keys, "full"), frames)


def _n(name: str) -> Column:
    return F.coalesce(name, F.lit(0)).alias(name)


def _report(df: DataFrame, as_of: str) -> DataFrame:
    return df.withColumn("report_date", F.lit(as_of).cast("date"))


def price_elasticity(drops: DataFrame, stockouts: DataFrame, as_of: str, reads: tuple[float, float] = (15.0, 5.0)) -> DataFrame:
    cut = newest(drops).groupBy(*GENDER).agg(F.countDistinct("product_id").alias("products_with_drops"), round_to(F.avg("drop_pct")).alias("avg_drop_pct"), F.max("drop_pct").alias("max_drop_pct"))
    out = newest(stockouts).select(*GENDER, "stockout_events", F.col("products_affected").alias("products_stocking_out"), F.col("on_discount_pct").alias("pct_stockouts_while_discounted"))
    share = F.col("pct_stockouts_while_discounted")
    return _report(cut.join(out, GENDER).withColumn("elasticity_read", first_match([(share >= reads[0], "elastic"), (share < reads[1], "inelastic")], "moderate")), as_of)


def brand_health(drops: DataFrame, anchors: DataFrame, dead: DataFrame, restocks: DataFrame, escalations: DataFrame, as_of: str, weights: tuple[float, ...] = (50.0, 2.0, 3.0, 0.5)) -> DataFrame:
    frames = [
        newest(drops).groupBy(*KEY).agg(F.countDistinct("product_id").alias("products_dropping"), round_to(F.avg("drop_pct")).alias("avg_drop_pct")),
        anchors.groupBy(*KEY).agg(F.count("*").alias("anchor_inflation_events")),
        newest(dead).groupBy(*KEY).agg(F.countDistinct("product_id").alias("dead_stock_products"), round_to(F.avg("honest_discount_pct")).alias("avg_dead_discount_pct")),
        newest(restocks).select(*KEY, F.col("completion_rate_pct").alias("restock_completion_pct"), "median_restock_days"),
        newest(escalations).groupBy(*KEY).agg(F.countDistinct("product_id").alias("escalating_products")),
    ]
    rows = _full(frames, KEY).select(*KEY, _n("products_dropping"), "avg_drop_pct", _n("anchor_inflation_events"), _n("dead_stock_products"), "avg_dead_discount_pct", "restock_completion_pct", "median_restock_days", _n("escalating_products"))
    base, dead_w, up_w, back_w = weights
    score = base - dead_w * F.col("dead_stock_products") - up_w * F.col("escalating_products") + back_w * F.coalesce("restock_completion_pct", F.lit(50.0))
    return _report(rows.withColumn("health_score_0_100", F.greatest(F.lit(0), F.least(F.lit(100), F.floor(score + 0.5).cast("int")))), as_of)


def _size_demand(asymmetry: DataFrame, min_count: int) -> DataFrame:
    return asymmetry.groupBy(*KEY, "stocked_out_size").agg(F.count("*").alias("stockout_count"), F.countDistinct("product_id").alias("products_affected"), F.count_if(F.size("sizes_still_in_stock") > 0).alias("while_other_sizes_available")).where(F.col("stockout_count") >= min_count)


def _stockout_context(stockouts: DataFrame) -> DataFrame:
    """Brand and category context re-aggregated from counts, never from averages of percentages."""
    rows = newest(stockouts).groupBy(*KEY).agg(F.sum("stockout_events").alias("category_stockout_events"), F.sum("on_discount_events").alias("d"))
    return rows.select(*KEY, "category_stockout_events", percent(F.col("d"), F.col("category_stockout_events")).alias("category_pct_stockouts_while_discounted"))


def revealed_demand(stockouts: DataFrame, anomalies: DataFrame, asymmetry: DataFrame, as_of: str, min_count: int = 2) -> DataFrame:
    odd = newest(anomalies).groupBy(*KEY).agg(F.count("*").alias("category_price_anomalies"))
    rows = _size_demand(asymmetry, min_count).join(_stockout_context(stockouts), KEY, "left").join(odd, KEY, "left")
    rows = rows.withColumn("pct_size_specific_demand", percent(F.col("while_other_sizes_available"), F.col("stockout_count")))
    return _report(rows.withColumn("category_price_anomalies", F.coalesce("category_price_anomalies", F.lit(0))), as_of)


def _launches(launches: DataFrame, name: str) -> DataFrame:
    cents = F.sum(F.floor(F.col("launch_price") * 100.0 + 0.5).cast("long"))  # whole numbers: no matter in which order they are summed
    return launches.groupBy(*KEY).agg(F.count("*").alias(name), round_to(cents.cast("double") / F.count("launch_price") / 100.0).alias("avg_launch_price"))


def wallet_allocator(stockouts: DataFrame, launches: DataFrame, asymmetry: DataFrame, as_of: str, min_count: int = 2, proven: int = 5, active: int = 3) -> DataFrame:
    name = "new_skus_launched_in_category"
    rows = _size_demand(asymmetry, min_count).join(_launches(launches, name), KEY, "left").join(_stockout_context(stockouts), KEY, "left")
    n, new = F.col("stockout_count"), F.coalesce(name, F.lit(0))
    read = first_match([((n >= proven) & (new >= active), "strong"), (n >= proven, "opportunity")], "emerging")
    return _report(rows.select(*KEY, "stocked_out_size", "stockout_count", new.alias(name), "avg_launch_price", "category_pct_stockouts_while_discounted", read.alias("allocation_read")), as_of)


def market_entry(launches: DataFrame, delists: DataFrame, dead: DataFrame, as_of: str, band: int = 5) -> DataFrame:
    frames = [_launches(launches, "new_skus_launched"), delists.groupBy(*KEY).agg(F.count("*").alias("skus_delisted")), newest(dead).groupBy(*KEY).agg(F.countDistinct("product_id").alias("dead_stock_products"))]
    rows = _full(frames, KEY).select(*KEY, _n("new_skus_launched"), "avg_launch_price", _n("skus_delisted"), _n("dead_stock_products"))
    rows = rows.withColumn("net_catalogue_change", F.col("new_skus_launched") - F.col("skus_delisted"))
    return _report(rows.withColumn("trajectory", first_match([(F.col("net_catalogue_change") > band, "expanding"), (F.col("net_catalogue_change") < -band, "retreating")], "stable")), as_of)


def liquidation_calendar(escalations: DataFrame, dead: DataFrame, staircases: DataFrame, bursts: DataFrame, restocks: DataFrame, as_of: str, esc: int = 3, deads: tuple[int, int] = (3, 5), restock: int = 5) -> DataFrame:
    frames = [
        newest(escalations).groupBy(*KEY).agg(F.countDistinct("product_id").alias("escalating_products"), round_to(F.avg("last_depth_pct")).alias("avg_current_depth_pct")),
        newest(dead).groupBy(*KEY).agg(F.countDistinct("product_id").alias("dead_stock_products")),
        newest(staircases).groupBy(*KEY).agg(F.countDistinct("product_id").alias("staircase_products")),
        bursts.groupBy(*KEY).agg(F.sum("skus_dropped").alias("skus_in_discount_bursts")),
        restocks.groupBy(*KEY).agg(F.sum("variants_restocked").alias("variants_restocked_recently")),
    ]
    names = ("escalating_products", "dead_stock_products", "staircase_products", "skus_in_discount_bursts", "variants_restocked_recently")
    rows = _full(frames, KEY).select(*KEY, "avg_current_depth_pct", *map(_n, names))
    e, d, b = (F.col(c) for c in ("escalating_products", "dead_stock_products", "variants_restocked_recently"))
    return _report(rows.withColumn("distress_level", first_match([((e >= esc) & (d >= deads[0]) & (b < restock), "urgent"), ((e >= esc) | (d >= deads[1]), "watch")], "normal")), as_of)


def production_blueprint(asymmetry: DataFrame, dead: DataFrame, launches: DataFrame, delists: DataFrame, as_of: str, min_count: int = 2, strong: int = 5) -> DataFrame:
    rows = _size_demand(asymmetry, min_count).select(*KEY, "stocked_out_size", F.col("stockout_count").alias("undersupply_signal"))
    rows = rows.join(newest(dead).groupBy(*KEY).agg(F.count("*").alias("oversupply_signal_category")), KEY, "left").join(launches.groupBy(*KEY).agg(F.count("*").alias("new_skus_launched_category")), KEY, "left").join(delists.groupBy(*KEY).agg(F.count("*").alias("delisted_skus_category")), KEY, "left")
    rows = rows.select(*KEY, "stocked_out_size", "undersupply_signal", *map(_n, ("oversupply_signal_category", "new_skus_launched_category", "delisted_skus_category")))
    under, over = F.col("undersupply_signal"), F.col("oversupply_signal_category")
    return _report(rows.withColumn("production_signal", first_match([((under >= strong) & (over == 0), "increase production"), ((under >= strong) & (over > 0), "rebalance sizes")], "monitor")), as_of)


def depth_read(depth: Column) -> Column:
    return read_bands(depth, [(40.0, "deep"), (25.0, "mid"), (1.0, "light")], "full")

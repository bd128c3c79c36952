"""Product and variant signals. Every operator is a plan from frames and an explicit as_of date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallwatch.functions.columns import latest_per, percent, round_to, window_of
from stallwatch.operators.selection import exact_percentiles

WHO = ["product_id", "brand", "product_name", "category_normalized"]
PLACE = ["product_id", "brand", "product_name", "department", "category_normalized", "subcategory"]


def latest_day(snapshots: DataFrame) -> DataFrame:
    """Rows of each brand's own latest day, one per product. The latest day is a small aggregate per brand."""
    last = snapshots.groupBy("brand").agg(F.max("snapshot_date").alias("snapshot_date"))
    rows = snapshots.where("price > 0").join(last, ["brand", "snapshot_date"])
    return latest_per(rows, ["product_id"], [F.desc("recorded_at")])


def genuine_price_drop(snapshots: DataFrame, as_of: str, min_drop: float = 0.10) -> DataFrame:
    base, price = F.col("first_observed_price"), F.col("price")
    rows = latest_day(snapshots).where((base > 0) & (price < base) & ((base - price) / base >= min_drop))
    return rows.select(*WHO, "gender", "snapshot_date", price.alias("current_price"), base.alias("baseline_price"), round_to(100.0 * (base - price) / base).alias("drop_pct"))


def price_staircase(events: DataFrame, as_of: str, window_days: int = 21, min_steps: int = 3, strict: bool = False) -> DataFrame:
    """Products with several good steps down. strict counts only the longest unbroken run of them."""
    w = Window.partitionBy("product_id").orderBy("recorded_at", "event_id")
    rows = window_of(events, "event_date", as_of, window_days).withColumn("before", F.lag("price_after").over(w))
    rows = rows.withColumn("good", (F.col("direction") == "down") & (F.col("before").isNull() | (F.col("price_after") < F.col("before"))))
    keys = WHO + ["gender"]
    if strict:
        rows = rows.withColumn("run", F.sum((~F.col("good")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    at, good = F.struct("recorded_at", "event_id"), F.col("good")
    steps = rows.where(good).groupBy(*keys, *(["run"] if strict else [])).agg(
        F.count("*").cast("int").alias("step_count"), F.min_by("price_after", at).alias("first_price"), F.max_by("price_after", at).alias("last_price"), F.min("recorded_at").alias("first_step_at"), F.max("recorded_at").alias("last_step_at"),
    )
    if strict:
        steps = latest_per(steps, ["product_id"], [F.desc("step_count"), F.asc("run")])
    steps = steps.where((F.col("step_count") >= min_steps) & (F.col("last_price") < F.col("first_price")))
    descent = round_to(100.0 * (F.col("first_price") - F.col("last_price")) / F.col("first_price"))
    return steps.select(*keys, F.lit(as_of).cast("date").alias("snapshot_date"), "step_count", "first_price", "last_price", descent.alias("total_descent_pct"), "first_step_at", "last_step_at", F.datediff(F.to_date("last_step_at"), F.to_date("first_step_at")).alias("span_days"))


def anchor_inflation(snapshots: DataFrame, as_of: str, window_days: int = 90, price_step: float | None = None) -> DataFrame:
    """The published old price goes up while the price stays: the largest such rise per product and day.
    price_step compares prices on a grid, for sources whose prices carry noise."""
    price = F.floor(F.col("price") / price_step) * price_step if price_step else F.col("price")
    w = Window.partitionBy("product_id").orderBy("snapshot_date", "recorded_at")
    rows = window_of(snapshots, "snapshot_date", as_of, window_days).where("compare_at_price is not null").withColumn("actual", price.cast("double"))
    rows = rows.withColumns({"prev_compare_at": F.lag("compare_at_price").over(w), "prev_price": F.lag("actual").over(w)})
    rows = rows.where("prev_compare_at > 0 and compare_at_price > prev_compare_at and actual = prev_price")
    rise = round_to(100.0 * (F.col("compare_at_price") - F.col("prev_compare_at")) / F.col("prev_compare_at"))
    rows = rows.select(*PLACE, "prev_compare_at", F.col("compare_at_price").alias("new_compare_at"), F.col("actual").alias("actual_price"), rise.alias("anchor_inflation_pct"), "snapshot_date")
    return latest_per(rows, ["product_id", "snapshot_date"], [F.desc("anchor_inflation_pct"), F.desc("new_compare_at")])


def discount_recovery(events: DataFrame, as_of: str, window_days: int = 90) -> DataFrame:
    """A rise right after a cut that stays under the first price; the day's last recovery of a product."""
    w = Window.partitionBy("product_id").orderBy("recorded_at", "event_id")
    rows = window_of(events, "event_date", as_of, window_days).withColumns({"low_price": F.lag("price_after").over(w), "was": F.lag("direction").over(w)})
    rows = rows.where("direction = 'up' and was = 'down' and price_after > low_price and price_after < first_observed_price")
    rows = latest_per(rows, ["product_id", "event_date"], [F.desc("recorded_at"), F.desc("event_id")])
    base = F.col("first_observed_price")
    return rows.select(*PLACE, "first_observed_price", "low_price", F.col("price_after").alias("recovered_price"), round_to(100.0 * (base - F.col("price_after")) / base).alias("structural_reprice_pct"), F.col("event_date").alias("recovery_date"), F.col("event_date").alias("snapshot_date"))


def _price_history(snapshots: DataFrame, as_of: str, window_days: int, k: float) -> DataFrame:
    rows = window_of(snapshots, "snapshot_date", as_of, window_days).where("price > 0")
    past = rows.groupBy("product_id").agg(F.countDistinct("snapshot_date").cast("int").alias("days_observed"), F.percentile("price", F.array(*map(F.lit, (0.25, 0.5, 0.75)))).alias("q"), F.min("price").alias("lowest"))
    past = past.select("product_id", "days_observed", "lowest", *[round_to(F.col("q")[i], 4).alias(n) for i, n in enumerate(("q1_price", "median_price", "q3_price"))])
    past = past.withColumn("iqr", round_to(F.col("q3_price") - F.col("q1_price"), 4)).withColumn("lower_fence", round_to(F.col("q1_price") - k * F.col("iqr"), 4))
    return latest_day(rows).join(past, "product_id").where("iqr > 0 and price < lower_fence")


def price_anomaly(snapshots: DataFrame, as_of: str, window_days: int = 30, min_days: int = 14, k: float = 1.5, band_min: int = 3) -> DataFrame:
    """Latest prices under the lower fence of their own history; products of a brand that land on one price are a band."""
    rows = _price_history(snapshots, as_of, window_days, k).where(F.col("days_observed") >= min_days)
    size = F.count("*").over(Window.partitionBy("brand", "price")).cast("int")
    rows = rows.withColumn("band_move_size", size)
    return rows.select(*WHO, "gender", "snapshot_date", F.col("price").alias("current_price"), "median_price", "q1_price", "q3_price", "iqr", "lower_fence", round_to(100.0 * (F.col("price") - F.col("median_price")) / F.col("median_price")).alias("deviation_pct"), (F.col("price") <= F.col("lowest")).alias("is_lowest_ever"), "days_observed", F.lit(window_days).alias("window_days"), "band_move_size", (F.col("band_move_size") >= band_min).alias("is_band_move"))


def price_anomaly_suppressed(snapshots: DataFrame, as_of: str, window_days: int = 30, min_days: int = 14, k: float = 1.5) -> DataFrame:
    return _price_history(snapshots, as_of, window_days, k).where(F.col("days_observed") < min_days).agg(F.count("*").alias("suppressed"))


def _stockout_groups(stock: DataFrame, as_of: str, window_days: int) -> DataFrame:
    rows = window_of(stock, "event_date", as_of, window_days).where("witnessed and event_type = 'stockout'")
    keys = ["brand", F.coalesce("category_normalized", F.lit("uncategorized")).alias("category_normalized"), F.coalesce("gender", F.lit("unknown")).alias("gender")]
    return rows.groupBy(*keys).agg(
        F.count("*").alias("stockout_events"), F.countDistinct("variant_id").alias("variants_affected"), F.countDistinct("product_id").alias("products_affected"), F.count_if("was_on_discount").alias("on_discount_events"), F.countDistinct("event_date").alias("observed_days"),
    )


def variant_stockout(stock: DataFrame, as_of: str, window_days: int = 30, min_events: int = 3) -> DataFrame:
    rows = _stockout_groups(stock, as_of, window_days).where(F.col("stockout_events") >= min_events)
    return rows.withColumns({"snapshot_date": F.lit(as_of).cast("date"), "on_discount_pct": percent(F.col("on_discount_events"), F.col("stockout_events")), "window_days": F.lit(window_days)})


def variant_stockout_suppressed(stock: DataFrame, as_of: str, window_days: int = 30, min_events: int = 3) -> DataFrame:
    return _stockout_groups(stock, as_of, window_days).where(F.col("stockout_events") < min_events).agg(F.count("*").alias("suppressed"))


def _restock_groups(stock: DataFrame, as_of: str, window_days: int) -> tuple[DataFrame, DataFrame]:
    """The window's stock-outs with their restock_days, and their groups."""
    w = Window.partitionBy("variant_id").orderBy("recorded_at", "event_id")
    rows = stock.where("witnessed and event_type in ('stockout', 'restock')").withColumns({"next_type": F.lead("event_type").over(w), "next_at": F.lead("recorded_at").over(w)})
    rows = window_of(rows.where("event_type = 'stockout'"), "event_date", as_of, window_days)
    days = F.when(F.col("next_type") == "restock", (F.unix_timestamp("next_at") - F.unix_timestamp("recorded_at")) / 86400.0)
    keys = ["brand", "category_normalized"]
    rows = rows.select("brand", F.coalesce("category_normalized", F.lit("uncategorized")).alias("category_normalized"), "event_date", days.alias("restock_days"))
    return rows, rows.groupBy(*keys).agg(F.count("restock_days").alias("closed_pairs"), (F.count("*") - F.count("restock_days")).alias("open_stockouts"), F.min("restock_days").alias("fastest"), F.countDistinct("event_date").alias("observed_days"))


def variant_restock(stock: DataFrame, as_of: str, window_days: int = 30, min_closed: int = 5) -> DataFrame:
    """Time from stock-out to restock; open stock-outs are counted beside the medians, as they are censored."""
    pairs, groups = _restock_groups(stock, as_of, window_days)
    times = exact_percentiles(pairs, ["brand", "category_normalized"], "restock_days", [0.5, 0.25, 0.75]).select(F.col("brand").alias("__brand"), F.col("category_normalized").alias("__category"), "q")
    rows = groups.where(F.col("closed_pairs") >= min_closed).join(times, F.col("brand").eqNullSafe(F.col("__brand")) & (F.col("category_normalized") == F.col("__category")))
    names = ("median_restock_days", "p25_restock_days", "p75_restock_days")
    total = F.col("closed_pairs") + F.col("open_stockouts")
    return rows.select(F.lit(as_of).cast("date").alias("snapshot_date"), "brand", "category_normalized", "closed_pairs", "open_stockouts", percent(F.col("closed_pairs"), total).alias("completion_rate_pct"), *[round_to(F.col("q")[i]).alias(n) for i, n in enumerate(names)], round_to(F.col("fastest")).alias("fastest_restock_days"), "observed_days", F.lit(window_days).alias("window_days"))


def variant_restock_suppressed(stock: DataFrame, as_of: str, window_days: int = 30, min_closed: int = 5) -> DataFrame:
    return _restock_groups(stock, as_of, window_days)[1].where(F.col("closed_pairs") < min_closed).agg(F.count("*").alias("suppressed"))


def current_sizes(stock: DataFrame) -> DataFrame:
    """Each product's sizes and whether the last witnessed transition left them in stock."""
    at = F.struct("recorded_at", "event_id")
    rows = stock.where("witnessed").groupBy("product_id", "size").agg(F.max_by("event_type", at).alias("last_type"))
    return rows.select("product_id", "size", (F.col("last_type") == "restock").alias("is_in_stock"))


def dead_stock(snapshots: DataFrame, variants: DataFrame, as_of: str, min_discount: float = 40.0) -> DataFrame:
    """Deeply discounted on the brand's latest day, with every size still there."""
    full = variants.groupBy("product_id").agg(F.count("*").alias("variant_count"), F.count_if("is_in_stock").alias("in_stock_count")).where("variant_count = in_stock_count")
    rows = latest_day(snapshots).where(F.col("honest_discount_pct") >= min_discount)
    return rows.join(full, "product_id").select(*PLACE, "honest_discount_pct", "variant_count", "in_stock_count", "snapshot_date")


def size_asymmetry(stock: DataFrame, variants: DataFrame, as_of: str, window_days: int = 2) -> DataFrame:
    """A size sells out on discount while others of the product are in stock."""
    rows = window_of(stock, "event_date", as_of, window_days).where("witnessed and event_type = 'stockout' and was_on_discount and size is not null")
    rows = latest_per(rows, ["product_id", "size"], [F.desc("recorded_at"), F.asc_nulls_last("color"), F.desc("event_id")])
    others = variants.where("is_in_stock").groupBy("product_id").agg(F.array_sort(F.collect_set("size")).alias("sizes_still_in_stock"))
    return rows.join(others, "product_id").select(*PLACE, F.col("size").alias("stocked_out_size"), F.col("color").alias("stocked_out_color"), "sizes_still_in_stock", "event_date", F.lit(as_of).cast("date").alias("snapshot_date"))


def new_sku_launch(shelf: DataFrame, as_of: str, window_days: int = 90) -> DataFrame:
    """Products first seen in the window, but after the day on which their brand's watching began."""
    begun = shelf.groupBy("brand").agg(F.min("first_seen").alias("begun"))
    rows = window_of(shelf, "first_seen", as_of, window_days).join(begun, "brand").where("first_seen > begun")
    return rows.select(*PLACE, F.col("first_observed_price").alias("launch_price"), F.col("first_seen").alias("launch_date"), F.col("first_seen").alias("snapshot_date"))


def product_delisted(shelf: DataFrame, as_of: str, window_days: int = 90, stale_days: int = 14, mass_pct: float = 20.0, keep: list[tuple[str, str]] = ()) -> DataFrame:
    """Products not seen for stale_days. Days on which a brand loses over mass_pct of its catalogue are a fault of
    the source and left out, unless listed in ``keep``."""
    gone = shelf.where(F.col("last_seen") < F.date_sub(F.lit(as_of).cast("date"), stale_days))
    size = shelf.groupBy("brand").agg(F.count("*").alias("catalogue"))
    mass = gone.groupBy("brand", "last_seen").agg(F.count("*").alias("n")).join(size, "brand").where(100.0 * F.col("n") / F.col("catalogue") > mass_pct)
    for brand, day in keep:
        mass = mass.where(~((F.col("brand") == brand) & (F.col("last_seen") == F.lit(day).cast("date"))))
    rows = window_of(gone, "last_seen", as_of, window_days).join(mass.select("brand", "last_seen"), ["brand", "last_seen"], "left_anti")
    base, last = F.col("first_observed_price"), F.col("last_price")
    discount = F.when((base > 0) & (base >= last), round_to(100.0 * (base - last) / base))
    return rows.select(*PLACE, "first_observed_price", last.alias("final_price"), discount.alias("final_discount_pct"), F.col("last_seen").alias("delisted_date"), F.col("last_seen").alias("snapshot_date"))


def launch_to_first_discount(events: DataFrame, as_of: str, window_days: int = 90) -> DataFrame:
    first = events.where("direction = 'down'").groupBy(*PLACE, F.to_date("first_seen_at").alias("launch_date")).agg(F.min("event_date").alias("first_discount_date"))
    days = F.datediff("first_discount_date", "launch_date")
    rows = window_of(first, "launch_date", as_of, window_days).withColumn("days_to_first_discount", days).where("days_to_first_discount >= 0")
    return rows.withColumn("snapshot_date", F.col("first_discount_date"))


def discount_depth_escalation(events: DataFrame, as_of: str, window_days: int = 30, min_steps: int = 2) -> DataFrame:
    """Cuts that go deeper than every one before; equal depth is none."""
    w = Window.partitionBy("product_id").orderBy("recorded_at", "event_id")
    rows = window_of(events, "event_date", as_of, window_days).where("discount_pct > 0")
    rows = rows.withColumn("deepest", F.max("discount_pct").over(w.rowsBetween(Window.unboundedPreceding, -1))).where("deepest is null or discount_pct > deepest")
    at, keys = F.struct("recorded_at", "event_id"), WHO + ["gender"]
    steps = rows.groupBy(*keys).agg(
        F.count("*").cast("int").alias("escalation_count"), F.min_by("discount_pct", at).alias("first_depth_pct"), F.max_by("discount_pct", at).alias("last_depth_pct"), F.min("recorded_at").alias("first_step_at"), F.max("recorded_at").alias("last_step_at"),
    )
    steps = steps.where((F.col("escalation_count") >= min_steps) & (F.col("last_depth_pct") > F.col("first_depth_pct")))
    return steps.withColumns({"snapshot_date": F.lit(as_of).cast("date"), "span_days": F.datediff(F.to_date("last_step_at"), F.to_date("first_step_at"))})


def _subcategory() -> Column:
    return F.coalesce("subcategory", F.lit("(none)")).alias("subcategory")


def discount_velocity(events: DataFrame, as_of: str, window_days: int = 90, bucket: str = "6 hours", min_products: int = 15) -> DataFrame:
    """Bursts of cuts: products of a brand and category that fall within one bucket of time."""
    rows = window_of(events, "event_date", as_of, window_days).where("direction = 'down'")
    groups = rows.groupBy("brand", "category_normalized", _subcategory(), F.window("recorded_at", bucket).alias("w")).agg(F.min("department").alias("department"), F.countDistinct("product_id").alias("skus_dropped"))
    start = F.col("w.start")
    return groups.where(F.col("skus_dropped") >= min_products).select("brand", "department", "category_normalized", "subcategory", start.alias("window_start"), "skus_dropped", F.to_date(start).alias("snapshot_date"))


def restock_density(stock: DataFrame, as_of: str, window_days: int = 90) -> DataFrame:
    rows = window_of(stock, "event_date", as_of, window_days).where("witnessed and event_type = 'restock'")
    groups = rows.groupBy("brand", "category_normalized", _subcategory(), "color", F.col("event_date").alias("restock_date")).agg(F.min("department").alias("department"), F.count("*").alias("variants_restocked"), F.countDistinct("product_id").alias("products_affected"))
    return groups.withColumn("snapshot_date", F.col("restock_date"))


def flash_events(events: DataFrame, horizon: str = "24 hours") -> DataFrame:
    """Cuts that some rise of the same product follows within the horizon.

    Time is cut into bins of the horizon's length. A rise that counts lies in the cut's own bin or in the next, so rises
    stand in their own bin and in the one before. Within a product's bin, latest first, the least time of the rises so far is
    that of the next rise: one pass, and a product with very many events is dealt out by its bins.
    """
    micros, length = F.unix_micros("recorded_at"), int(horizon.split()[0]) * 3_600_000_000
    rows = events.withColumns({"__at": micros, "__bin": F.floor(micros / length)}).withColumn("__up", F.col("direction") == "up")
    rows = rows.withColumn("__own", F.explode(F.when(F.col("__up"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))))
    rows = rows.withColumn("__bin", F.when(F.col("__own"), F.col("__bin")).otherwise(F.col("__bin") - 1))
    later = Window.partitionBy("product_id", "__bin").orderBy(F.desc("__at")).rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__next", F.min(F.when(F.col("__up"), F.col("__at"))).over(later))
    return rows.where((F.col("direction") == "down") & (F.col("__next") < F.col("__at") + length)).select(*events.columns)


def flag_flash_sales(events: DataFrame, now: str, lookback_hours: int = 48, horizon: str = "24 hours") -> DataFrame:
    """Cuts of the last hours, not flagged yet, that are flash sales. What makes one so comes after it, so older events are not read."""
    recent = F.col("recorded_at") > F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {lookback_hours} HOURS")
    return flash_events(events.where(recent), horizon).where(~F.col("is_flash_sale"))


def intraday_flash_sale(events: DataFrame, as_of: str, window_days: int = 90, horizon: str = "24 hours") -> DataFrame:
    rows = window_of(flash_events(events, horizon), "event_date", as_of, window_days)
    return rows.groupBy(*WHO, F.col("event_date").alias("snapshot_date")).agg(F.count("*").alias("flash_events"), F.max("discount_pct").alias("deepest_pct"), F.min("recorded_at").alias("first_at"), F.max("recorded_at").alias("last_at"))

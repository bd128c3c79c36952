"""Brand, category and market signals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallwatch.functions.columns import first_match, percent, read_bands, round_to, window_of
from stallwatch.operators.selection import exact_percentiles
from stallwatch.operators.taxonomy import classify_size


def _day(as_of: str):
    return F.lit(as_of).cast("date").alias("snapshot_date")


def pricing_discipline(events: DataFrame, as_of: str, window_days: int = 90, min_events: int = 10, bounds: tuple[float, float] = (7.0, 13.0)) -> DataFrame:
    rows = window_of(events, "event_date", as_of, window_days).where("direction = 'down' and discount_pct > 0 and category_normalized <> 'uncategorized'")
    groups = rows.groupBy("brand", "category_normalized").agg(F.count("*").alias("discount_events"), F.avg("discount_pct").alias("a"), F.percentile("discount_pct", F.lit(0.5)).alias("m"), F.stddev_samp("discount_pct").alias("s")).where(F.col("discount_events") >= min_events)
    groups = groups.select("brand", "category_normalized", "discount_events", round_to(F.col("a"), 1).alias("avg_depth_pct"), round_to(F.col("m"), 1).alias("median_depth_pct"), round_to(F.col("s"), 1).alias("depth_stddev"))
    return groups.select("*", read_bands(F.col("depth_stddev"), [(bounds[0], "disciplined"), (bounds[1], "moderate")], "reactive", at_most=True).alias("discipline_read"), _day(as_of))


def first_mover(events: DataFrame, as_of: str, window_days: int = 90, min_days: int = 2, fast: int = 3) -> DataFrame:
    rows = window_of(events, "event_date", as_of, window_days).where("direction = 'down'")
    own = rows.groupBy("category_normalized", "brand").agg(F.countDistinct("event_date").alias("discount_days"), F.min("event_date").alias("first_discount_date"))
    first = own.groupBy("category_normalized").agg(F.min("first_discount_date").alias("category_first"))
    late = F.datediff("first_discount_date", "category_first")
    rows = own.where(F.col("discount_days") >= min_days).join(first, "category_normalized").withColumn("avg_days_after_category_first", late)
    read = first_match([(F.col("avg_days_after_category_first") == 0, "first mover"), (F.col("avg_days_after_category_first") <= fast, "fast follower")], "late follower")
    return rows.drop("category_first").select("*", read.alias("mover_read"), _day(as_of))


def trained_customer(events: DataFrame, as_of: str, window_days: int = 90, min_events: int = 50, min_span: int = 14, pct: float = 50.0, depths: tuple[float, float] = (20.0, 30.0)) -> DataFrame:
    rows = window_of(events, "event_date", as_of, window_days).where("direction = 'down' and discount_pct > 0")
    span = F.datediff(F.max("event_date"), F.min("event_date")) + 1
    rows = rows.groupBy("brand").agg(F.count("*").alias("discount_events"), F.countDistinct("event_date").alias("active_days"), span.alias("span_days"), F.avg("discount_pct").alias("a"), F.stddev_samp("discount_pct").alias("s"))
    rows = rows.where((F.col("discount_events") >= min_events) & (F.col("span_days") >= min_span))
    rows = rows.select("brand", "discount_events", "active_days", "span_days", percent(F.col("active_days"), F.col("span_days"), 1).alias("pct_days_discounting"), round_to(F.col("a"), 1).alias("avg_depth_pct"), round_to(F.col("s"), 1).alias("depth_consistency"))
    often, deep = F.col("pct_days_discounting") >= pct, F.col("avg_depth_pct")
    return rows.select("*", first_match([(often & (deep >= depths[1]), "high"), (often & (deep >= depths[0]), "elevated"), (often, "moderate")], "low").alias("risk_read"), _day(as_of))


def discount_honesty(events: DataFrame, as_of: str, window_days: int = 90, min_events: int = 10, fake: float = 0.01, gaps: tuple[float, float] = (0.05, 0.15)) -> DataFrame:
    """Claimed depth against the published old price, beside the genuine depth against the first price."""
    rows = window_of(events, "event_date", as_of, window_days).where("direction = 'down' and compare_at_price > price_after and first_observed_price > 0")
    claimed = (F.col("compare_at_price") - F.col("price_after")) / F.col("compare_at_price")
    genuine = F.greatest(F.lit(0.0), (F.col("first_observed_price") - F.col("price_after")) / F.col("first_observed_price"))
    rows = rows.select("brand", "category_normalized", claimed.alias("c"), genuine.alias("g"))
    rows = rows.groupBy("brand", "category_normalized").agg(F.count("*").alias("scored_events"), F.avg("c").alias("c"), F.avg("g").alias("g"), F.count_if(F.col("g") <= fake).alias("n")).where(F.col("scored_events") >= min_events)
    gap = round_to(F.col("c") - F.col("g"), 4)
    return rows.select("brand", "category_normalized", "scored_events", round_to(100 * F.col("c")).alias("avg_claimed_depth_pct"), round_to(100 * F.col("g")).alias("avg_genuine_depth_pct"), round_to(100 * gap).alias("manufactured_gap_pct"), percent(F.col("n"), F.col("scored_events")).alias("pct_pure_fake"), read_bands(gap, [(gaps[0], "honest"), (gaps[1], "inflated")], "manufactured", at_most=True).alias("honesty_read"), _day(as_of))


def market_velocity(stock: DataFrame, as_of: str, exclude: tuple[str, ...] = (), up: float = 1.15, down: float = 0.85) -> DataFrame:
    """Weekly stock-outs and restocks of the market. One row per week, so the week-on-week step is tiny."""
    rows = stock.where("witnessed and event_type in ('stockout', 'restock')").where(~F.col("brand").isin(*exclude))
    weeks = rows.groupBy(F.to_date(F.date_trunc("week", "recorded_at")).alias("week_start")).agg(F.count_if(F.col("event_type") == "stockout").alias("stockouts"), F.count_if(F.col("event_type") == "restock").alias("restocks"), F.countDistinct(F.when(F.col("event_type") == "stockout", F.col("variant_id"))).alias("variants_stocked_out"))
    before = weeks.select(F.date_add("week_start", 7).alias("week_start"), F.col("stockouts").alias("was"))
    weeks = weeks.join(before, "week_start", "left")
    ratio = F.col("stockouts") / F.nullif(F.col("was").cast("double"), F.lit(0.0))
    return weeks.select(
        "week_start", "stockouts", "restocks", "variants_stocked_out", round_to(F.col("stockouts") / F.nullif(F.col("restocks").cast("double"), F.lit(0.0))).alias("stockout_restock_ratio"), (F.col("stockouts") - F.col("was")).alias("wow_stockout_delta"),
        round_to(100.0 * (ratio - 1)).alias("wow_pct"), first_match([(F.col("was").isNull(), "baseline"), (ratio >= up, "accelerating"), (ratio <= down, "cooling")], "steady").alias("velocity_read"), _day(as_of),
    )


def replenishment_benchmark(stock: DataFrame, as_of: str, min_cycles: int = 30, fast: float = 0.7, slow: float = 1.3) -> DataFrame:
    w = Window.partitionBy("variant_id").orderBy("recorded_at", "event_id")
    rows = stock.where("witnessed and event_type in ('stockout', 'restock')").withColumns({"next_type": F.lead("event_type").over(w), "next_at": F.lead("recorded_at").over(w)})
    cycles = rows.where("event_type = 'stockout' and next_type = 'restock'").select("brand", ((F.unix_timestamp("next_at") - F.unix_timestamp("recorded_at")) / 86400.0).alias("days"))
    median = lambda keys: exact_percentiles(cycles, keys, "days", [0.5])
    market = median([]).select(round_to(F.col("q")[0]).alias("market_median_days"))
    own = median(["brand"]).where(F.col("n") >= min_cycles).select("brand", F.col("n").alias("cycles"), round_to(F.col("q")[0]).alias("median_replen_days"))
    ratio = round_to(F.col("median_replen_days") / F.nullif("market_median_days", F.lit(0.0)))
    rows = own.crossJoin(F.broadcast(market)).withColumn("vs_market_ratio", ratio)  # one row
    return rows.select("*", first_match([(F.col("vs_market_ratio") <= fast, "fast"), (F.col("vs_market_ratio") >= slow, "slow")], "typical").alias("replenishment_read"), _day(as_of))


def share_of_launch(shelf: DataFrame, as_of: str, window_days: int = 30, min_category: int = 20, reads: tuple[float, float] = (40.0, 20.0)) -> DataFrame:
    begun = shelf.groupBy("brand").agg(F.min("first_seen").alias("begun"))
    rows = window_of(shelf, "first_seen", as_of, window_days).join(begun, "brand").where("first_seen > begun")
    own = rows.groupBy("category_normalized", "brand").agg(F.count("*").alias("brand_launches"))
    every = own.groupBy("category_normalized").agg(F.sum("brand_launches").alias("category_launches")).where(F.col("category_launches") >= min_category)
    share = percent(F.col("brand_launches"), F.col("category_launches"), 1)
    return own.join(every, "category_normalized").withColumn("share_pct", share).select("*", read_bands(F.col("share_pct"), [(reads[0], "dominant"), (reads[1], "active")], "minor").alias("launch_read"), _day(as_of))


def size_demand_curve(stock: DataFrame, as_of: str, window_days: int = 90, min_brands: int = 3, min_events: int = 20, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Share of stock-outs by size among all of the size's system (letters, waists or numbers), those of sizes below the floors included.

    Numbers are read by the category where there is one; other systems and sizes in review are left out.
    """
    rows = window_of(stock, "event_date", as_of, window_days).where("witnessed and event_type = 'stockout'").where(~F.col("brand").isin(*exclude))
    category = F.col("category_normalized") if "category_normalized" in stock.columns else F.lit(None).cast("string")
    rows = rows.select("brand", classify_size(F.col("size"), category).alias("s")).where("s.size_status = 'classified' and s.size_system in ('letter', 'waist_numeric', 'eu_numeric')").select("brand", "s.size_system", "s.size_family")
    sizes = rows.groupBy("size_system", "size_family").agg(F.count("*").alias("stockouts"), F.countDistinct("brand").alias("brands")).where((F.col("brands") >= min_brands) & (F.col("stockouts") >= min_events))
    total = rows.groupBy("size_system").agg(F.count("*").alias("total"))
    return sizes.join(total, "size_system").select("size_system", "size_family", "stockouts", "brands", percent(F.col("stockouts"), F.col("total"), 1).alias("demand_share_pct"), _day(as_of))


def depth_bucket(depth):
    return read_bands(depth, [(40, "40+"), (30, "30-40"), (20, "20-30"), (10, "10-20")], "00-10")


def clear_rate_by_depth(snapshots: DataFrame, stock: DataFrame, as_of: str, window_days: int = 60, horizon: int = 21, min_products: int = 10) -> DataFrame:
    """Of products that reached a depth long enough ago to be judged, the share that sold out on discount within the horizon."""
    rows = window_of(snapshots, "snapshot_date", as_of, window_days).where("honest_discount_pct > 0")
    end = rows.agg(F.max("snapshot_date").alias("window_end"))
    w = Window.partitionBy("product_id").orderBy(F.desc("honest_discount_pct"), F.asc("snapshot_date"))
    deep = rows.withColumn("rn", F.row_number().over(w)).where("rn = 1").crossJoin(F.broadcast(end)).where(F.col("snapshot_date") <= F.date_sub("window_end", horizon))
    deep = deep.select("product_id", "category_normalized", "gender", depth_bucket(F.col("honest_discount_pct")).alias("depth_bucket"), F.col("snapshot_date").alias("reached"), "window_end")
    gone = stock.where("witnessed and event_type = 'stockout' and was_on_discount").select("product_id", "event_date")
    cleared = deep.join(gone, "product_id").where((F.col("event_date") >= F.col("reached")) & (F.col("event_date") <= F.date_add("reached", horizon))).select("product_id").distinct().withColumn("hit", F.lit(1))
    groups = deep.join(cleared, "product_id", "left").groupBy("category_normalized", "gender", "depth_bucket", F.col("window_end").alias("snapshot_date")).agg(F.count("*").alias("products"), F.count("hit").alias("cleared")).where(F.col("products") >= min_products)
    return groups.withColumn("clear_rate_pct", percent(F.col("cleared"), F.col("products"), 1))

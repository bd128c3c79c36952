"""Frames behind the weekly boards: demand, prices, verdicts, confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallwatch.functions.columns import first_match, latest_per, percent, read_bands, round_to, window_of
from stallwatch.operators.taxonomy import cell_color


def confidence(brands: Column, days: Column, events: Column) -> Column:
    return first_match([((brands >= 10) & (days >= 21) | (events >= 500), "confirmed"), ((brands >= 5) & (days >= 7) | (events >= 100), "directional")], "maturing")


def cell_tier(events: Column) -> Column:
    """Maturity of one cell by its own number of events, in the words of ``confidence``."""
    return read_bands(events, [(10, "confirmed"), (5, "directional")], "maturing")


def pct_reliable(events: Column, floor: int = 5) -> Column:
    """Whether a share rests on enough observations to be shown."""
    return F.coalesce(events, F.lit(0)) >= floor


def conf_level(brands: Column, products: Column, sellouts: Column, bounds: tuple = ((12, 500, 200), (8, 200, 50))) -> Column:
    """hi, md or lo: all three counts reach the bounds."""
    return first_match([((brands >= b) & (products >= p) & (sellouts >= s), level) for (b, p, s), level in zip(bounds, ("hi", "md"))], "lo")


def ci95(p: Column, n: Column, legacy: bool = False) -> Column:
    """Half-width of the 95 % interval of a share, in points; the share is kept off 0 and 1 unless legacy."""
    low = F.lit(0.5) / n
    q = p if legacy else F.greatest(low, F.least(1 - low, p))
    return F.when(n < 2, 0.0).otherwise(round_to(196.0 * F.sqrt(q * (1 - q) / n), 1))


def demand_grid(stock: DataFrame, cols: list[str], min_events: int, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Witnessed stock-outs per cell of any columns; rows with a null in one of them are left out. Colours are families, else canonical."""
    rows = stock.where("witnessed and event_type = 'stockout'").where(~F.col("brand").isin(*exclude))
    if "color" in cols:
        rows = rows.withColumn("color", cell_color(stock))
    cells = rows.dropna(subset=cols).groupBy(*cols).agg(F.countDistinct("brand").alias("brands"), F.countDistinct("product_id").alias("products"), F.count("*").alias("events")).where(F.col("events") >= min_events)
    return cells.withColumn("confidence", cell_tier(F.col("events")))


def market_undersupply(stock: DataFrame, blueprint: DataFrame, min_events: int = 5) -> DataFrame:
    cells = demand_grid(stock, ["category_normalized", "size"], min_events).where("size not in ('one_size', 'kids_age', '')")
    calls = blueprint.groupBy("category_normalized", F.col("stocked_out_size").alias("size")).agg(F.count_if(F.col("production_signal").startswith("increase production")).alias("increase_calls"))
    return cells.join(calls, ["category_normalized", "size"], "left").withColumn("increase_calls", F.coalesce("increase_calls", F.lit(0)))


def color_price(snapshots: DataFrame, variants: DataFrame, min_n: int = 25, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Median price by category and colour on the market's latest day, one price per product and colour.

    ``variants``: (product_id, color, color_family); those without a colour or with one outside the map are left out.
    """
    day = snapshots.agg(F.max("snapshot_date").alias("snapshot_date"))
    rows = snapshots.join(F.broadcast(day), "snapshot_date", "left_semi").where("price > 0").where(~F.col("brand").isin(*exclude))
    colors = variants.where("color <> ''").select("product_id", cell_color(variants).alias("color")).where("color <> 'other'").distinct()
    rows = latest_per(rows, ["product_id"], [F.desc("recorded_at")]).join(colors, "product_id")
    return rows.groupBy("category_normalized", "color").agg(F.count("*").alias("n"), round_to(F.percentile("price", F.lit(0.5))).alias("median_price")).where(F.col("n") >= min_n)


def demand_trend(stock: DataFrame, cols: list[str], weeks: int = 8, min_total: int = 20, min_weeks: int = 3) -> DataFrame:
    """Last half of a cell's weeks against its first half; weeks without events are not filled in."""
    rows = stock.where("witnessed and event_type = 'stockout'").withColumn("week", F.to_date(F.date_trunc("week", "recorded_at")))
    cells = rows.groupBy(*cols, "week").agg(F.count("*").alias("n"))
    back = Window.partitionBy(*cols).orderBy(F.desc("week"))
    cells = cells.withColumn("k", F.row_number().over(back)).where(F.col("k") <= weeks)
    cells = cells.withColumn("m", F.count("*").over(Window.partitionBy(*cols)))
    half = F.floor(F.col("m") / 2)
    out = cells.groupBy(*cols).agg(F.count("*").alias("weeks"), F.sum("n").alias("total"), F.sum(F.when(F.col("k") <= half, F.col("n")).otherwise(0)).alias("late"), F.sum(F.when(F.col("k") > F.col("m") - half, F.col("n")).otherwise(0)).alias("early"))
    out = out.where((F.col("weeks") >= min_weeks) & (F.col("total") >= min_total))
    ratio = round_to(F.col("late") / F.greatest(F.col("early"), F.lit(1)).cast("double"))
    return out.withColumn("ratio", ratio).withColumn("trend", first_match([(F.col("ratio") >= 1.15, "warming"), (F.col("ratio") <= 0.85, "cooling")], "steady"))


def bestseller_cells(weekly: DataFrame, cols: list[str], rank_max: int = 30, min_products: int = 1) -> DataFrame:
    last = weekly.agg(F.max("week_start").alias("week_start"))
    rows = weekly.join(F.broadcast(last), "week_start", "left_semi").where(F.col("rank_best") <= rank_max)
    return rows.groupBy(*cols).agg(F.countDistinct("product_id").alias("bestsellers")).where(F.col("bestsellers") >= min_products)


def order_verdicts(stock: DataFrame, weekly: DataFrame, min_events: int = 30, proven: int = 3, min_coverage: float = 0.5, exclude: tuple[str, ...] = ()) -> DataFrame:
    """What to order, by category and subcategory: demand cells, with whether bestsellers prove them and where they are heading.

    Only categories of whose demand the given share names its subcategory.
    """
    cols = ["category_normalized", "subcategory"]
    sold = stock.where("witnessed and event_type = 'stockout' and category_normalized not in ('uncategorized', '')").where(~F.col("brand").isin(*exclude))
    covered = sold.groupBy("category_normalized").agg((F.count_if(F.col("subcategory") != "") / F.count("*")).alias("coverage")).where(F.col("coverage") >= min_coverage)
    cells = demand_grid(stock, cols, min_events, exclude).where("subcategory <> ''").join(covered, "category_normalized")
    rows = cells.join(bestseller_cells(weekly, cols), cols, "left").join(demand_trend(stock, cols).select(*cols, "trend"), cols, "left")
    best, trend = F.coalesce("bestsellers", F.lit(0)), F.coalesce("trend", F.lit("steady"))
    sure = best >= proven
    score = F.col("events") * F.when(sure, 1.6).otherwise(1.0) * F.when(trend == "warming", 1.25).when(trend == "cooling", 0.7).otherwise(1.0)
    verdict = first_match([(sure & (trend != "cooling"), "STRONG BUY"), (sure | (trend == "warming"), "BUY")], "WATCH")
    why = F.concat_ws(",", F.lit("under-supplied"), F.when(sure, F.concat(F.lit("proven seller ("), best.cast("string"), F.lit(")"))), F.when(trend == "steady", "steady demand").otherwise(trend))
    return rows.select(*cols, "brands", "products", "events", "confidence", "coverage", verdict.alias("verdict"), round_to(score, 1).alias("score"), why.alias("why"))


def discount_verdicts(clear: DataFrame, distress: DataFrame, min_products: int = 20, clears: float = 15.0) -> DataFrame:
    """Does cutting prices clear stock, and is the category in distress?"""
    rate = clear.groupBy("category_normalized").agg(F.sum("products").alias("products"), F.sum("cleared").alias("cleared")).where(F.col("products") >= min_products).withColumn("clear_pct", percent(F.col("cleared"), F.col("products"), 1))
    rank = F.when(F.col("distress_level") == "urgent", 2).when(F.col("distress_level") == "watch", 1).otherwise(0)
    worst = distress.groupBy("category_normalized").agg(F.max(rank).alias("distress"))
    d, ok = F.coalesce("distress", F.lit(0)), F.col("clear_pct") >= clears
    verdict = first_match([((d > 0) & ok, "ACTIVE CLEARANCE"), (d > 0, "STICKY DISTRESS"), (ok, "HEALTHY MARKDOWN")], "FIRM")
    return rate.join(worst, "category_normalized", "left").select("category_normalized", "products", "cleared", "clear_pct", d.alias("distress"), verdict.alias("verdict"))


def stale_brands(df: DataFrame, day: str, lag: int = 2) -> DataFrame:
    own = df.groupBy("brand").agg(F.max(day).alias("last_day"))
    return own.crossJoin(F.broadcast(own.agg(F.max("last_day").alias("market_day")))).where(F.datediff("market_day", "last_day") > lag).select("brand", "last_day", F.datediff("market_day", "last_day").alias("days_behind"))


def price_ladder(snapshots: DataFrame, min_n: int = 40) -> DataFrame:
    day = snapshots.agg(F.max("snapshot_date").alias("snapshot_date"))
    rows = snapshots.join(F.broadcast(day), "snapshot_date", "left_semi").where("price > 0")
    q = rows.groupBy("category_normalized").agg(F.count("*").alias("n"), F.percentile("price", F.array(*map(F.lit, (0.25, 0.5, 0.75)))).alias("q")).where(F.col("n") >= min_n)
    q = q.select("category_normalized", "n", *[round_to(F.col("q")[i]).alias(c) for i, c in enumerate(("p25", "median", "p75"))])
    return q.withColumn("spread", round_to(F.col("p75") - F.col("p25")))


def reorder_chase(stockouts: DataFrame, restocks: DataFrame, top: int = 5) -> DataFrame:
    """Cells that sell out, come back seldom and slowly; a top-k report."""
    key = ["brand", "category_normalized"]
    rows = stockouts.groupBy(*key).agg(F.sum("stockout_events").alias("sellouts")).join(restocks.select(*key, "completion_rate_pct", "median_restock_days"), key, "left")
    score = F.col("sellouts") * (1 - F.coalesce("completion_rate_pct", F.lit(50.0)) / 100.0) * (1 + F.coalesce("median_restock_days", F.lit(3.0)) / 7.0)
    return rows.withColumn("chase", round_to(score)).orderBy(F.desc("chase"), *key).limit(top)


def brand_health_scorecard(replenishment: DataFrame, restocks: DataFrame, distress: DataFrame, dead: DataFrame, risk: DataFrame) -> DataFrame:
    """Stress flags of every brand that any of five signals knows."""
    frames = [
        replenishment.select("brand", (F.col("vs_market_ratio") >= 1.5).alias("slow")),
        restocks.groupBy("brand").agg((F.avg("completion_rate_pct") < 40).alias("absent")),
        distress.groupBy("brand").agg((F.sum("escalating_products") >= 20).alias("distressed")),
        dead.groupBy("brand").agg((F.count("*") >= 15).alias("dead")),
        risk.select("brand", (F.col("risk_read") == "high").alias("trained")),
    ]
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.join(f, "brand", "full")
    names = ("slow", "absent", "distressed", "dead", "trained")
    flags = sum(F.coalesce(F.col(c), F.lit(False)).cast("int") for c in names)
    return rows.select("brand", *[F.coalesce(c, F.lit(False)).alias(c) for c in names], flags.alias("flags"), read_bands(flags, [(3, "stress"), (2, "watch")], "healthy").alias("health"))


def underpricing(snapshots: DataFrame, as_of: str, days: int = 45, min_products: int = 15, min_brands: int = 4) -> DataFrame:
    """Brand medians of product medians against the market's, by category."""
    own = window_of(snapshots, "snapshot_date", as_of, days).where("price > 0").groupBy("product_id", "brand", "category_normalized").agg(F.percentile("price", F.lit(0.5)).alias("p"))
    brand = own.groupBy("brand", "category_normalized").agg(F.count("*").alias("products"), round_to(F.percentile("p", F.lit(0.5))).alias("brand_median")).where(F.col("products") >= min_products)
    market = brand.groupBy("category_normalized").agg(F.count("*").alias("brands"), round_to(F.percentile("brand_median", F.lit(0.5))).alias("market_median")).where(F.col("brands") >= min_brands)
    gap = percent(F.col("brand_median") - F.col("market_median"), F.col("market_median"), 1)
    return brand.join(market, "category_normalized").withColumn("gap_pct", gap).withColumn("read", first_match([(F.col("gap_pct") < -45, "verify"), (F.col("gap_pct") <= -15, "actionable")], "in line"))


def discount_leaders(movers: DataFrame, top: int = 10) -> DataFrame:
    rows = movers.where(F.col("mover_read").contains("first mover")).groupBy("category_normalized").agg(F.countDistinct("brand").alias("leaders"))
    return rows.orderBy(F.desc("leaders"), "category_normalized").limit(top)


def clear_curve_summary(clear: DataFrame) -> DataFrame:
    return clear.agg(F.count("*").alias("cells"), percent(F.count_if(F.col("cleared") == 0), F.count("*"), 1).alias("zero_cells_pct"), F.sum("cleared").alias("cleared"), F.sum("products").alias("products"))


def action_board(stock: DataFrame, as_of: str, days: int = 21, min_sellouts: int = 20) -> DataFrame:
    rows = window_of(stock, "event_date", as_of, days).where("witnessed")
    out, back = F.col("event_type") == "stockout", F.col("event_type") == "restock"
    cells = rows.groupBy("category_normalized", "subcategory").agg(F.count_if(out).alias("sellouts"), F.count_if(back).alias("restocks"), F.countDistinct(F.when(out, F.col("product_id"))).alias("products"), F.countDistinct(F.when(out, F.col("brand"))).alias("brands"))
    return cells.where(F.col("sellouts") > min_sellouts).withColumn("gap_ratio", round_to(F.col("sellouts") / F.greatest(F.col("restocks"), F.lit(1)).cast("double")))


def bestseller_persistence(ranks: DataFrame, min_products: int = 5) -> DataFrame:
    """Weeks on the list per product; the average is over listing rows, so long-listed products weigh more."""
    weeks = ranks.groupBy("product_id").agg(F.countDistinct(F.date_trunc("week", "snapshot_date")).alias("weeks"))
    rows = ranks.join(weeks, "product_id")
    out = rows.groupBy("category_normalized").agg(F.countDistinct("product_id").alias("products"), round_to(F.sum("weeks") / F.count("*").cast("double"), 1).alias("avg_weeks")).where(F.col("products") > min_products)
    return out.withColumn("read", read_bands(F.col("avg_weeks"), [(6, "strong"), (3, "medium")], "weak"))


def bestseller_trend(ranks: DataFrame) -> DataFrame:
    return ranks.groupBy("category_normalized", F.to_date(F.date_trunc("week", "snapshot_date")).alias("week_start")).agg(F.countDistinct("product_id").alias("products"))


def latest_price(snapshots: DataFrame, as_of: str, days: int = 8) -> DataFrame:
    rows = window_of(snapshots, "snapshot_date", as_of, days)
    return rows.groupBy("product_id", "brand", "category_normalized", "subcategory", "first_observed_price").agg(F.max_by("price", "snapshot_date").alias("price"))


def price_band(price: Column) -> Column:
    return read_bands(price, [(1000, "1000+"), (700, "700-999"), (500, "500-699"), (300, "300-499")], "under 300")


def price_band_sellthrough(prices: DataFrame, stock: DataFrame, as_of: str, days: int = 21, min_products: int = 15) -> DataFrame:
    gone = window_of(stock, "event_date", as_of, days).where("witnessed and event_type = 'stockout'").select("product_id").distinct().withColumn("hit", F.lit(1))
    rows = prices.join(gone, "product_id", "left").groupBy("category_normalized", price_band(F.col("price")).alias("band")).agg(F.count("*").alias("products"), F.count("hit").alias("sold_out")).where(F.col("products") > min_products)
    return rows.withColumn("rate_pct", percent(F.col("sold_out"), F.col("products"), 1))


def speed_to_sell(stock: DataFrame, min_products: int = 15) -> DataFrame:
    first = stock.where("witnessed and event_type = 'stockout'").groupBy("product_id", "category_normalized", "first_seen_at").agg(F.min("recorded_at").alias("sold_at"))
    days = F.floor((F.unix_timestamp("sold_at") - F.unix_timestamp("first_seen_at")) / 86400)
    return first.withColumn("days", days.cast("double")).groupBy("category_normalized").agg(F.count("*").alias("products"), round_to(F.percentile("days", F.lit(0.5)), 1).alias("median_days")).where(F.col("products") > min_products)


def demand_index(stock: DataFrame, as_of: str, days: int = 21) -> DataFrame:
    rows = window_of(stock, "event_date", as_of, days).where("witnessed")
    out = rows.where("event_type = 'stockout'").select("category_normalized", "product_id").distinct()
    still = out.join(rows.where("event_type = 'restock'").select("product_id").distinct(), "product_id", "left_anti").groupBy("category_normalized").agg(F.count("*").alias("still_out"))
    return out.groupBy("category_normalized").agg(F.count("*").alias("sold_out")).join(still, "category_normalized", "left").withColumn("still_out", F.coalesce("still_out", F.lit(0)))


def ratios(stock: DataFrame, col: str, top: int) -> DataFrame:
    """Shares of stock-outs by size or colour, the top few of every cell in one pass."""
    cells = stock.where("witnessed and event_type = 'stockout'").groupBy("category_normalized", "subcategory", col).agg(F.count("*").alias("events"))
    total = cells.groupBy("category_normalized", "subcategory").agg(F.sum("events").alias("total"))
    best = latest_per(cells, ["category_normalized", "subcategory"], [F.desc("events"), F.asc(col)]) if top == 1 else None
    w = Window.partitionBy("category_normalized", "subcategory").orderBy(F.desc("events"), F.asc(col))
    best = best or cells.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top).drop("place")
    return best.join(total, ["category_normalized", "subcategory"]).select("category_normalized", "subcategory", col, "events", percent(F.col("events"), F.col("total"), 1).alias("share_pct"))


def price_movements(events: DataFrame, as_of: str, days: int = 7, min_changes: int = 50) -> DataFrame:
    """Changes of the last days against as many before."""
    now = F.col("event_date") > F.date_sub(F.lit(as_of).cast("date"), days)
    rows = window_of(events, "event_date", as_of, 2 * days)
    out = rows.groupBy("category_normalized").agg(F.count_if(now).alias("changes"), F.count_if(now & (F.col("direction") == "up")).alias("ups"), F.count_if(now & (F.col("direction") == "down")).alias("downs"), F.count_if(~now).alias("changes_before"))
    return out.where(F.col("changes") > min_changes)


def sellthrough_by_depth(prices: DataFrame, stock: DataFrame, as_of: str, days: int = 21, min_products: int = 10) -> DataFrame:
    base, price = F.col("first_observed_price"), F.col("price")
    depth = F.when(base > price, 100.0 * (base - price) / base).otherwise(0.0)
    gone = window_of(stock, "event_date", as_of, days).where("witnessed and event_type = 'stockout'").select("product_id").distinct().withColumn("hit", F.lit(1))
    rows = prices.withColumn("depth", read_bands(depth, [(40.0, "40+"), (25.0, "25-39"), (1.0, "1-24")], "full")).join(gone, "product_id", "left")
    out = rows.groupBy("category_normalized", "depth").agg(F.count("*").alias("products"), F.count("hit").alias("sold_out")).where(F.col("products") > min_products)
    return out.withColumns({"rate_pct": percent(F.col("sold_out"), F.col("products"), 1), "ci95": ci95(F.col("sold_out") / F.col("products").cast("double"), F.col("products"))})


def age_discount_matrix(prices: DataFrame, products: DataFrame, as_of: str) -> DataFrame:
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("first_seen_at"))
    base, price = F.col("first_observed_price"), F.col("price")
    depth = F.when(base > price, 100.0 * (base - price) / base).otherwise(0.0)
    rows = prices.join(products.select("product_id", "first_seen_at"), "product_id")
    rows = rows.select(read_bands(age, [(61, "60+"), (31, "31-60"), (15, "15-30")], "0-14").alias("age"), read_bands(depth, [(40.0, "40+"), (30.0, "30-39"), (20.0, "20-29"), (1.0, "1-19")], "full").alias("depth"))
    return rows.groupBy("age", "depth").agg(F.count("*").alias("products")).withColumn("heat", read_bands(F.col("products"), [(40, "hot"), (15, "warm")], "cool"))


def brand_activity(launches: DataFrame, events: DataFrame, stock: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Each fact is counted per brand before the join, so nothing multiplies."""
    new = window_of(launches, "first_seen", as_of, days).groupBy("brand").agg(F.countDistinct("product_id").alias("launches"))
    moves = window_of(events, "event_date", as_of, days).groupBy("brand").agg(F.count("*").alias("price_changes"))
    trade = window_of(stock, "event_date", as_of, days).where("witnessed").groupBy("brand").agg(F.count_if(F.col("event_type") == "stockout").alias("sellouts"), F.count_if(F.col("event_type") == "restock").alias("restocks"))
    names = ("launches", "price_changes", "sellouts", "restocks")
    rows = new.join(moves, "brand", "full").join(trade, "brand", "full").select("brand", *[F.coalesce(c, F.lit(0)).alias(c) for c in names])
    busy = (F.col("launches") > 0) | (F.col("restocks") >= F.col("sellouts"))
    return rows.withColumn("posture", first_match([(busy & (F.col("price_changes") >= 50), "attack"), (busy, "manage"), (F.col("price_changes") > 0, "defend")], "sleep"))


def market_temperature(stock: DataFrame, as_of: str, weeks: int = 4) -> DataFrame:
    """The last complete weeks, newest to oldest, with sellouts per restock."""
    this_week = F.date_trunc("week", F.lit(as_of).cast("timestamp"))
    rows = stock.where("witnessed and event_type in ('stockout', 'restock')").withColumn("week", F.date_trunc("week", "recorded_at"))
    rows = rows.where((F.col("week") < this_week) & (F.col("week") >= this_week - F.expr(f"INTERVAL {7 * weeks} DAYS")))
    out = rows.groupBy(F.to_date("week").alias("week_start")).agg(F.count_if(F.col("event_type") == "stockout").alias("sellouts"), F.count_if(F.col("event_type") == "restock").alias("restocks"))
    return out.withColumn("ratio", round_to(F.col("sellouts") / F.greatest(F.col("restocks"), F.lit(1)).cast("double")))


def live_deals(events: DataFrame, top: int = 3) -> DataFrame:
    """Each product's newest cut, the newest few of all; a top-k report."""
    rows = latest_per(events.where("direction = 'down'"), ["product_id"], [F.desc("recorded_at"), F.desc("event_id")])
    return rows.orderBy(F.desc("recorded_at"), F.desc("event_id")).limit(top).select("product_id", "brand", "price_after", "discount_pct", "recorded_at")


def stock_board(by_depth: DataFrame) -> DataFrame:
    """The depth at which a category sells best, among those that hold a fifth of its sell-outs, and what to do."""
    total = by_depth.groupBy("category_normalized").agg(F.sum("sold_out").alias("volume"), F.max("rate_pct").alias("best_rate"), F.sum("products").alias("products"))
    fit = by_depth.where((F.col("products") >= 5)).join(total.select("category_normalized", "volume"), "category_normalized").where(F.col("sold_out") >= 0.2 * F.col("volume"))
    best = fit.groupBy("category_normalized").agg(F.max_by("depth", F.struct("rate_pct", "depth")).alias("best_depth"), F.max("rate_pct").alias("rate_pct"))
    rows = total.join(best, "category_normalized", "left")
    verdict = first_match([(F.col("products") < 50, "hold"), (F.col("best_rate") < 12, "stop"), (F.col("best_depth") == "full", "raise"), (F.col("best_depth") == "1-24", "light"), (F.col("best_depth").isNotNull(), "deep")], "hold")
    return rows.select("category_normalized", "products", "volume", "best_depth", "rate_pct", verdict.alias("verdict"))

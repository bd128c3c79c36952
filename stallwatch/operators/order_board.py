"""The order board: what to make per category and subcategory, with the frames it is put together from."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallwatch.functions.columns import exact_mean, first_match, percent, round_to, window_of
from stallwatch.operators.boards import ci95, conf_level, price_band

CELL = ["category_normalized", "subcategory"]


def _sold_out(stock: DataFrame, as_of: str, days: int) -> DataFrame:
    return window_of(stock, "event_date", as_of, days).where("witnessed and event_type = 'stockout'")


def size_skew(asymmetry: DataFrame, top: int = 3) -> DataFrame:
    """Sizes that sell out first; a top-k report."""
    return asymmetry.groupBy("stocked_out_size").agg(F.count("*").alias("cases")).orderBy(F.desc("cases"), "stocked_out_size").limit(top)


def clearance_wave(bursts: DataFrame, top: int = 1) -> DataFrame:
    """The largest burst of cuts; a top-k report."""
    cols = ["brand", "category_normalized", "subcategory", "window_start", "skus_dropped"]
    return bursts.select(*cols).orderBy(F.desc("skus_dropped"), *cols[:4]).limit(top)


def launch_dominance(shares: DataFrame, top: int = 5) -> DataFrame:
    return shares.select("category_normalized", "brand", "share_pct", "launch_read").orderBy(F.desc("share_pct"), "category_normalized", "brand").limit(top)


def earliest_movers(movers: DataFrame, top: int = 5) -> DataFrame:
    cols = ["category_normalized", "brand", "avg_days_after_category_first", "mover_read"]
    return movers.select(*cols).orderBy("avg_days_after_category_first", "category_normalized", "brand").limit(top)


def fake_discount_flags(honesty: DataFrame, min_gap: float = 5.0, top: int = 5) -> DataFrame:
    """Brands that advertise far deeper cuts than they make; a top-k report."""
    cols = ["brand", "category_normalized", "avg_claimed_depth_pct", "avg_genuine_depth_pct", "manufactured_gap_pct"]
    return honesty.where(F.col("manufactured_gap_pct") > min_gap).select(*cols).orderBy(F.desc("manufactured_gap_pct"), "brand", "category_normalized").limit(top)


def brand_stockouts(stock: DataFrame, as_of: str, days: int = 21) -> DataFrame:
    return _sold_out(stock, as_of, days).groupBy(*CELL, "brand").agg(F.count("*").alias("stockouts"))


def confidence_inputs(prices: DataFrame, stock: DataFrame, as_of: str, days: int = 21, bounds: tuple = ((12, 500, 200), (8, 200, 50))) -> DataFrame:
    """Brands, products and sold-out products per cell, with the level and interval that they support."""
    gone = _sold_out(stock, as_of, days).select("product_id").distinct().withColumn("hit", F.lit(1))
    rows = prices.join(gone, "product_id", "left").groupBy(*CELL).agg(F.countDistinct("brand").alias("brands"), F.count("*").alias("products"), F.count("hit").alias("with_sellout"))
    level = conf_level(F.col("brands"), F.col("products"), F.col("with_sellout"), bounds)
    share = F.col("with_sellout") / F.col("products").cast("double")
    return rows.withColumns({"level": level, "ci": ci95(share, F.col("products")), "ci_unclamped": ci95(share, F.col("products"), legacy=True)})


def brand_prices(prices: DataFrame, min_products: int = 5) -> DataFrame:
    rows = prices.groupBy(*CELL, "brand").agg(F.count("*").alias("products"), round_to(F.percentile("price", F.lit(0.5))).alias("median_price"))
    return rows.where(F.col("products") > min_products)


def launches_by_brand(shelf: DataFrame, as_of: str, days: int = 7, min_launches: int = 10) -> DataFrame:
    """Products first seen in the last days and in as many before."""
    now = F.col("first_seen") > F.date_sub(F.lit(as_of).cast("date"), days)
    rows = window_of(shelf, "first_seen", as_of, 2 * days).groupBy("brand").agg(F.count_if(now).alias("this_week"), F.count_if(~now).alias("last_week"))
    return rows.where((F.col("this_week") > min_launches) | (F.col("last_week") > min_launches))


def distress(escalations: DataFrame, min_rows: int = 5) -> DataFrame:
    """Escalating cuts per cell and brand, with their average depth to one place, half up; depths have at most six decimals."""
    rows = escalations.groupBy(*CELL, "brand").agg(F.count("*").alias("escalating"), exact_mean(F.col("last_depth_pct"), 1).alias("avg_depth"))
    return rows.where(F.col("escalating") > min_rows)


def distress_products(escalations: DataFrame, cells: DataFrame, min_share: float = 0.25, min_products: int = 20, worst: int = 8) -> DataFrame:
    """Cells to avoid: a real share of their products escalates. The worst few by share, as the list is read by people."""
    rows = escalations.groupBy(*CELL).agg(F.countDistinct("product_id").alias("escalating_products")).join(cells.select(*CELL, "products"), CELL)
    rows = rows.where((F.col("escalating_products") >= min_share * F.col("products")) & (F.col("escalating_products") >= min_products))
    return rows.withColumn("share_pct", percent(F.col("escalating_products"), F.col("products"), 1)).orderBy(F.desc("share_pct"), *CELL).limit(worst)


def _best_band(prices: DataFrame, stock: DataFrame, as_of: str, days: int, min_products: int, min_volume: float) -> DataFrame:
    """The price band that sells best among those with enough of the cell's volume; where none has, among all."""
    gone = _sold_out(stock, as_of, days).select("product_id").distinct().withColumn("hit", F.lit(1))
    bands = prices.join(gone, "product_id", "left").groupBy(*CELL, price_band(F.col("price")).alias("band")).agg(F.count("*").alias("n"), F.count("hit").alias("sold")).where(F.col("n") > min_products)
    bands = bands.withColumn("rate_pct", percent(F.col("sold"), F.col("n"), 1)).withColumn("volume", F.sum("sold").over(Window.partitionBy(*CELL)))
    bands = bands.withColumn("backed", (F.col("volume") > 0) & (F.col("sold") >= min_volume * F.col("volume")))
    best = F.max(F.struct("backed", "rate_pct", "n", "band", "sold")).alias("b")
    return bands.groupBy(*CELL).agg(best).select(*CELL, F.col("b.band").alias("best_band"), F.col("b.rate_pct").alias("best_rate"), F.col("b.n").alias("best_n"), F.col("b.sold").alias("best_sold"), F.col("b.backed").alias("backed"))


def _listing(ranks: DataFrame) -> DataFrame:
    """Average weeks on the list (over listing rows) and how the number of listed products moved, per cell."""
    weeks = ranks.groupBy("product_id").agg(F.countDistinct(F.date_trunc("week", "snapshot_date")).alias("weeks"))
    stay = ranks.join(weeks, "product_id").groupBy(*CELL).agg(round_to(F.sum("weeks") / F.count("*").cast("double"), 1).alias("avg_weeks"))
    listed = ranks.groupBy(*CELL, F.date_trunc("week", "snapshot_date").alias("week")).agg(F.countDistinct("product_id").alias("n"))
    ends = listed.groupBy(*CELL).agg(F.min_by("n", "week").alias("first"), F.max_by("n", "week").alias("last"))
    return stay.join(ends.select(*CELL, round_to(100.0 * (F.col("last") - F.col("first")) / F.col("first").cast("double"), 0).alias("trend_pct")), CELL)


def order_board(stock: DataFrame, prices: DataFrame, ranks: DataFrame, avoid: DataFrame, as_of: str, days: int = 21, min_sellouts: int = 20, min_products: int = 15, min_volume: float = 0.2, cell_bounds: tuple = ((12, 500, 200), (8, 200, 50)), band_bounds: tuple = ((200, 50), (60, 15))) -> DataFrame:
    """One row per cell that sells out, with the best price band, how sure that is, and a verdict.

    Sell-through of the best band decides; time on the bestseller list and slow restocking support it. The level of
    confidence is the lower of the cell's and the band's, and one less than high where the band lacks volume.
    """
    trade = window_of(stock, "event_date", as_of, days).where("witnessed").groupBy(*CELL).agg(F.count_if(F.col("event_type") == "stockout").alias("sellouts"), F.count_if(F.col("event_type") == "restock").alias("restocks"))
    trade = trade.where(F.col("sellouts") > min_sellouts).withColumn("gap_ratio", round_to(F.col("sellouts") / F.greatest(F.col("restocks"), F.lit(1)).cast("double"), 1))
    rows = trade.join(confidence_inputs(prices, stock, as_of, days, cell_bounds).select(*CELL, "brands", "products", "level"), CELL, "left").join(_best_band(prices, stock, as_of, days, min_products, min_volume), CELL, "left").join(_listing(ranks), CELL, "left")
    rows = rows.join(avoid.select(*CELL, F.lit(True).alias("in_distress")), CELL, "left")
    zero = {c: F.coalesce(c, F.lit(v)) for c, v in (("best_rate", 0.0), ("best_n", 0), ("best_sold", 0), ("backed", False), ("avg_weeks", 0.0), ("trend_pct", 0.0), ("in_distress", False), ("level", "lo"), ("brands", 0), ("products", 0))}
    rows = rows.withColumns(zero)

    cell = F.when(F.col("level") == "hi", 2).when(F.col("level") == "md", 1).otherwise(0)
    band = first_match([((F.col("best_n") >= n) & (F.col("best_sold") >= sold), step) for (n, sold), step in zip(band_bounds, (2, 1))], 0)
    sure = F.least(cell, band, F.when(F.col("backed"), 2).otherwise(1))
    rows = rows.withColumn("confidence", first_match([(sure == 2, "hi"), (sure == 1, "md")], "lo"))

    rate, weeks, gap, known = F.col("best_rate"), F.col("avg_weeks"), F.col("gap_ratio"), F.col("confidence") != "lo"
    verdict = first_match(
        [
            (F.col("in_distress") | (rate < 15), "avoid"),
            (known & (rate >= 20) & (weeks >= 6.5) & (gap >= 2.0), "go"),
            (known & (weeks >= 5.0) & (F.col("trend_pct") >= -10) & (gap >= 1.5), "buy"),
            (known & (weeks >= 4.0) & (gap >= 1.2), "buy"),
        ],
        "watch",
    )
    return rows.select(*CELL, "sellouts", "restocks", "gap_ratio", "brands", "products", "best_band", "best_rate", "best_n", ci95(rate / 100.0, F.greatest(F.col("best_n"), F.lit(1))).alias("best_ci"), "backed", "avg_weeks", "trend_pct", "in_distress", "confidence", verdict.alias("verdict"))


def supply_gaps(board: DataFrame, opening: float = 2.0, least: float = 1.2) -> DataFrame:
    rows = board.where((F.col("verdict") != "avoid") & (F.col("gap_ratio") >= least))
    return rows.select(*CELL, "sellouts", "restocks", "gap_ratio", F.when(F.col("gap_ratio") >= opening, "OPEN").otherwise("NARROWING").alias("gap"))


def cross_conflicts(board: DataFrame, stocks: DataFrame) -> DataFrame:
    """Cells to make by one board in categories that the other says to stop: shown, not settled."""
    stop = stocks.where("verdict = 'stop'").select("category_normalized")
    return board.where(F.col("verdict").isin("go", "buy")).join(stop, "category_normalized", "left_semi").select(*CELL, "verdict")


def price_moves(events: DataFrame, as_of: str, days: int = 7, min_changes: int = 50) -> DataFrame:
    """Changes of the last days per brand and category, with the average cut."""
    rows = window_of(events, "event_date", as_of, days)
    cut = F.when(F.col("direction") == "down", 100.0 * (1 - F.col("price_after") / F.col("price_before")))
    out = rows.groupBy("brand", "category_normalized").agg(F.count("*").alias("changes"), F.count_if(F.col("direction") == "up").alias("increases"), F.count_if(F.col("direction") == "down").alias("decreases"), round_to(F.avg(cut), 1).alias("avg_cut_pct"))
    return out.where(F.col("changes") > min_changes)


def weekly_diff(launches: DataFrame, moves: DataFrame, weeks: DataFrame, min_launches: int = 30, min_moves: int = 50, shift: float = 25.0) -> DataFrame:
    """What changed: (kind, brand, category, now, before). Launch swings, one-sided price moves, and the market's heat."""
    this, last = F.col("this_week"), F.col("last_week")
    kind = first_match([((this >= min_launches) & (last == 0), "launches_back"), ((this >= min_launches) & (this >= 2 * last), "launches_up"), ((last >= min_launches) & (this <= 0.4 * last), "launches_down")])
    none = F.lit(None).cast("string")
    swings = launches.select(kind.alias("kind"), "brand", none.alias("category_normalized"), this.cast("double").alias("now"), last.cast("double").alias("before"))
    up, down, n = F.col("increases"), F.col("decreases"), F.col("changes")
    side = first_match([((up >= 0.9 * n) & (up >= min_moves), "prices_up"), ((down >= 0.9 * n) & (down >= min_moves), "prices_down")])
    sided = moves.select(side.alias("kind"), "brand", "category_normalized", up.cast("double").alias("now"), down.cast("double").alias("before"))
    ends = weeks.agg(F.max_by("ratio", "week_start").alias("now"), F.min_by("ratio", "week_start").alias("before"))  # a few weeks
    change = 100.0 * (F.col("now") - F.col("before")) / F.nullif(F.col("before"), F.lit(0.0))
    heat = ends.select(first_match([(change > shift, "market_heating"), (change < -shift, "market_cooling")]).alias("kind"), none.alias("brand"), none.alias("category_normalized"), "now", "before")
    return swings.unionByName(sided).unionByName(heat).where("kind is not null")

"""Board and rollup queries over the shop tables, with their SQL twins."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallwatch.operators import boards as B
from stallwatch.operators import market as M
from stallwatch.operators import rollups as R
from stallwatch.operators import signals as S
from stallwatch.operators.lake import replace_days
from stallwatch.plans.base_sql import AS_OF as D
from stallwatch.plans.base_sql import pct, r, twin
from stallwatch.plans.market_catalog import SQL as MARKET
from stallwatch.plans.products_catalog import SQL as PRODUCT
from stallwatch.plans.products_catalog import QUERIES as PRODUCTS
from stallwatch.plans.products_catalog import Signals
from stallwatch.plans.signals_catalog import SQL as SIGNAL
from stallwatch.plans.signals_catalog import _in
from stallwatch.sources.shared import shared_folder
from stallwatch.sources.shop import AS_OF, CATALOGUE_AS_OF, Shop


def _ranks(s: Shop) -> DataFrame:
    w = Window.partitionBy("brand", "snapshot_date").orderBy(F.desc("price"), "product_id")
    return s.snapshots.withColumn("rank", F.row_number().over(w)).where("rank <= 150").select("product_id", "brand", "category_normalized", "subcategory", "rank", "snapshot_date")


def _weekly(s: Shop) -> DataFrame:
    return R.weekly_bestseller_summary(_ranks(s))


def _clear(s: Shop) -> DataFrame:
    return M.clear_rate_by_depth(s.snapshots, s.stock_events, AS_OF, horizon=7, min_products=3)


def _colored(df: DataFrame) -> DataFrame:
    """Raw colours as shops write them, one per product; every fourth product has a family already."""
    raw = F.array(*map(F.lit, ("Navy blue", " Off White", "burgundy", "Khaki", "اسود", "zq 7", "")))
    return df.withColumns({"color": F.element_at(raw, (F.col("product_id") % 7 + 1).cast("int")), "color_family": F.when(F.col("product_id") % 4 == 0, "metallic")})


def _tagged(df: DataFrame) -> DataFrame:
    """Some products without a subcategory: most of one category, few of the others."""
    gone = F.when(F.col("category_normalized") == "promo", F.col("product_id") % 4 > 0).otherwise(F.col("product_id") % 7 == 0)
    return df.withColumn("subcategory", F.when(F.col("product_id") % 11 == 0, "").when(~gone, F.col("subcategory")))


def _ranked_cells(s: Shop) -> DataFrame:
    return _weekly(s).join(_tagged(s.catalogue).select("product_id", "subcategory"), "product_id")


CAT = ["category_normalized"]
def _refreshed(s: Shop):
    """The weekly table after an earlier run that saw the days up to the 24th, and one of today that builds the last weeks anew."""
    root = f"{shared_folder(s.spark)}/stallwatch/weeks-{uuid.uuid4().hex}"

    def build(first, last, seen="2024-12-31"):
        within = lambda df, day: df.where(F.col(day).between(F.lit(first), F.lit(last)) & (F.col(day) <= seen))
        return R.weekly_product_summary(within(s.snapshots, "snapshot_date"), within(s.price_events, "event_date"), within(s.stock_events, "event_date"))

    replace_days(build(date(2023, 12, 1), date(2024, 2, 1), seen="2024-01-24"), root, "week_start")
    R.refresh_weeks(s.spark, build, root, AS_OF)
    columns = build(date(2024, 1, 1), date(2024, 1, 7)).schema
    return s.spark.read.schema(columns).parquet(root)


QUERIES = {
    "i01_demand_grid": lambda s: B.demand_grid(_colored(s.stock_events), ["category_normalized", "subcategory", "color"], 5, ("Brand#11",)),
    "i02_market_undersupply": lambda s: B.market_undersupply(s.stock_events, PRODUCTS["p02_production_blueprint"](Signals(s))),
    "i03_color_price": lambda s: B.color_price(s.snapshots, _colored(s.catalogue), 5),
    "i04_demand_trend": lambda s: B.demand_trend(s.stock_events, CAT),
    "i05_bestsellers": lambda s: B.bestseller_cells(_weekly(s), CAT, rank_max=3),
    "i06_order_verdicts": lambda s: B.order_verdicts(_tagged(s.stock_events), _ranked_cells(s), 10),
    "i07_discount_verdicts": lambda s: B.discount_verdicts(_clear(s), PRODUCTS["p12_liquidation_calendar"](Signals(s)), min_products=5),
    "i08_confidence": lambda s: s.stock_events.where("witnessed").groupBy("category_normalized", "gender").agg(F.countDistinct("brand").alias("brands"), F.countDistinct("event_date").alias("days"), F.count("*").alias("events")).select("*", B.confidence(F.col("brands"), F.col("days"), F.col("events")).alias("confidence"), B.cell_tier(F.col("events")).alias("tier"), B.pct_reliable(F.col("events")).alias("reliable"), B.ci95(F.col("days") / F.lit(31.0), F.lit(31)).alias("ci")),
    "i10_stale_brands": lambda s: B.stale_brands(s.stock_events.where("event_type = 'restock'"), "event_date", 0),
    "i11_price_ladder": lambda s: B.price_ladder(s.snapshots, 10),
    "i12_reorder_chase": lambda s: B.reorder_chase(S.variant_stockout(s.stock_events, AS_OF), S.variant_restock(s.stock_events, AS_OF)),
    "i14_brand_health_scorecard": lambda s: B.brand_health_scorecard(M.replenishment_benchmark(s.stock_events, AS_OF), S.variant_restock(s.stock_events, AS_OF), PRODUCTS["p12_liquidation_calendar"](Signals(s)), S.dead_stock(s.snapshots, S.current_sizes(s.stock_events), AS_OF, 10.0), M.trained_customer(s.price_events, AS_OF)),
    "i15_underpricing": lambda s: B.underpricing(s.snapshots, AS_OF, min_products=2, min_brands=3),
    "i17_discount_leaders": lambda s: B.discount_leaders(M.first_mover(s.price_events, AS_OF)),
    "i18_clear_curve_summary": lambda s: B.clear_curve_summary(_clear(s)),
    "i19_action_board": lambda s: B.action_board(s.stock_events, AS_OF),
    "i20_bestseller_persistence": lambda s: B.bestseller_persistence(_ranks(s)),
    "i21_bestseller_trend": lambda s: B.bestseller_trend(_ranks(s)),
    "i22_latest_price": lambda s: B.latest_price(s.snapshots, AS_OF),
    "i23_price_band_sellthrough": lambda s: B.price_band_sellthrough(B.latest_price(s.snapshots, AS_OF), s.stock_events, AS_OF, min_products=2),
    "i24_speed_to_sell": lambda s: B.speed_to_sell(s.stock_events),
    "i25_demand_index": lambda s: B.demand_index(s.stock_events, AS_OF),
    "i32_price_movements": lambda s: B.price_movements(s.price_events, AS_OF),
    "i33_size_ratios": lambda s: B.ratios(s.stock_events, "size", 3),
    "i34_color_ratios": lambda s: B.ratios(s.stock_events, "color", 5),
    "i39_sellthrough_by_depth": lambda s: B.sellthrough_by_depth(B.latest_price(s.snapshots, AS_OF), s.stock_events, AS_OF, min_products=2),
    "i40_age_discount_matrix": lambda s: B.age_discount_matrix(B.latest_price(s.snapshots, AS_OF), s.products, AS_OF),
    "i41_brand_activity": lambda s: B.brand_activity(s.shelf.withColumn("first_seen", F.date_add("first_seen", 10400)), s.price_events, s.stock_events, AS_OF),
    "i42_market_temperature": lambda s: B.market_temperature(s.stock_events, AS_OF),
    "i43_stock_board": lambda s: B.stock_board(B.sellthrough_by_depth(B.latest_price(s.snapshots, AS_OF), s.stock_events, AS_OF, min_products=2)),
    "i46_live_deals": lambda s: B.live_deals(s.price_events),
    "h01_weekly_product_summary": lambda s: R.weekly_product_summary(s.snapshots, s.price_events, s.stock_events),
    "h04_refreshed_weeks": _refreshed,
    "h02_weekly_variant_exception": lambda s: R.weekly_variant_exception(s.stock_events, s.observations.select(F.col("product_id").alias("variant_id"), "product_id", "recorded_at", "price").join(s.catalogue.select("product_id"), "product_id", "left_semi")),
    "h03_weekly_bestseller_summary": _weekly,
    "h05_purge_rolled_up": lambda s: R.purge_rolled_up(_ranks(s), _weekly(s).where("week_start <> DATE'2024-01-01'"), AS_OF),
}

_RANKS = "SELECT product_id, brand, category_normalized, subcategory, rank, snapshot_date FROM (SELECT *, CAST(row_number() OVER (PARTITION BY brand, snapshot_date ORDER BY price DESC, product_id) AS INTEGER) AS rank FROM snapshots) WHERE rank <= 150"
_WEEKLY = f"""SELECT * EXCLUDE prev, CASE WHEN date_diff('day', prev.w, week_start) = 7 THEN prev.c - rank_close END AS rank_change_vs_prev_week FROM (SELECT *, lag({{'w': week_start, 'c': rank_close}}) OVER (PARTITION BY product_id ORDER BY week_start) AS prev FROM (
    SELECT product_id, brand, category_normalized, CAST(date_trunc('week', snapshot_date) AS DATE) AS week_start, min(rank) AS rank_best, max(rank) AS rank_worst, {r('sum(rank)::DOUBLE / count(*)', 1)} AS rank_avg, arg_max(rank, snapshot_date) AS rank_close, count(*) AS sample_days FROM ranks GROUP BY 1, 2, 3, 4))"""
_TREND = """SELECT category_normalized, weeks, total, late, early, ratio, CASE WHEN ratio >= 1.15::DOUBLE THEN 'warming' WHEN ratio <= 0.85::DOUBLE THEN 'cooling' ELSE 'steady' END AS trend FROM (SELECT *, """ + r("late / greatest(early, 1)::DOUBLE") + """ AS ratio FROM (
    SELECT category_normalized, count(*) AS weeks, CAST(sum(n) AS BIGINT) AS total, CAST(sum(CASE WHEN k <= m // 2 THEN n ELSE 0 END) AS BIGINT) AS late, CAST(sum(CASE WHEN k > m - m // 2 THEN n ELSE 0 END) AS BIGINT) AS early FROM (SELECT *, count(*) OVER (PARTITION BY category_normalized) AS m FROM (SELECT *, row_number() OVER (PARTITION BY category_normalized ORDER BY week DESC) AS k FROM (
    SELECT category_normalized, date_trunc('week', recorded_at) AS week, count(*) AS n FROM stock_events WHERE witnessed AND event_type = 'stockout' GROUP BY ALL)) WHERE k <= 8) GROUP BY ALL) WHERE weeks >= 3 AND total >= 20)"""
_GRID = "SELECT {0}, count(DISTINCT brand) AS brands, count(DISTINCT product_id) AS products, count(*) AS events, CASE WHEN count(*) >= 10 THEN 'confirmed' WHEN count(*) >= 5 THEN 'directional' ELSE 'maturing' END AS confidence FROM stock_events WHERE witnessed AND event_type = 'stockout' {1} GROUP BY {0} HAVING count(*) >= {2}"
_CELL = "category_normalized, subcategory"
_BEST = "SELECT category_normalized, count(DISTINCT product_id) AS bestsellers FROM weekly WHERE week_start = (SELECT max(week_start) FROM weekly) AND rank_best <= {} GROUP BY ALL"
_COLORED = "SELECT * REPLACE (CASE WHEN product_id % 4 = 0 THEN 'metallic' ELSE ['navy', 'white', 'red', 'olive', 'black', 'other', 'other'][product_id % 7 + 1] END AS color) FROM stock_events"
_TAG = "CASE WHEN product_id % 11 = 0 THEN '' WHEN category_normalized = 'promo' AND product_id % 4 > 0 OR category_normalized <> 'promo' AND product_id % 7 = 0 THEN NULL ELSE subcategory END"
_PRICE = f"SELECT product_id, brand, category_normalized, subcategory, first_observed_price, arg_max(price, snapshot_date) AS price FROM snapshots WHERE {_in('snapshot_date', 8)} GROUP BY 1, 2, 3, 4, 5"
_GONE = f"SELECT DISTINCT product_id, 1 AS hit FROM stock_events WHERE witnessed AND event_type = 'stockout' AND {_in('event_date', 21)}"
_DEPTH = "CASE WHEN first_observed_price > price THEN 100::DOUBLE * (first_observed_price - price) / first_observed_price ELSE 0 END"
_BYDEPTH = f"""SELECT * EXCLUDE q, {pct('sold_out', 'products', 1)} AS rate_pct, CASE WHEN products < 2 THEN 0 ELSE {r('196::DOUBLE * sqrt(q * (1 - q) / products)', 1)} END AS ci95 FROM (SELECT *, greatest(0.5::DOUBLE / products, least(1 - 0.5::DOUBLE / products, sold_out / products::DOUBLE)) AS q FROM (
    SELECT category_normalized, CASE WHEN d >= 40 THEN '40+' WHEN d >= 25 THEN '25-39' WHEN d >= 1 THEN '1-24' ELSE 'full' END AS depth, count(*) AS products, count(hit) AS sold_out FROM (SELECT *, {_DEPTH} AS d FROM prices LEFT JOIN gone USING (product_id)) GROUP BY 1, 2 HAVING count(*) > 2))"""


def _ratio(col: str, top: int) -> str:
    return twin(f"SELECT category_normalized, subcategory, {col}, events, {pct('events', 'total', 1)} AS share_pct FROM (SELECT *, sum(events) OVER (PARTITION BY category_normalized, subcategory) AS total, row_number() OVER (PARTITION BY category_normalized, subcategory ORDER BY events DESC, {col}) AS place FROM (SELECT category_normalized, subcategory, {col}, count(*) AS events FROM stock_events WHERE witnessed AND event_type = 'stockout' GROUP BY 1, 2, 3)) WHERE place <= {top}")


SQL = {
    "i01_demand_grid": twin(_GRID.format("category_normalized, subcategory, color", "AND brand <> 'Brand#11'", 5).replace("stock_events", "colored"), colored=_COLORED),
    "i02_market_undersupply": twin(f"SELECT g.*, coalesce(c, 0) AS increase_calls FROM ({_GRID.format('category_normalized, size', '', 5)}) g LEFT JOIN (SELECT category_normalized, stocked_out_size AS size, count(*) FILTER (production_signal LIKE 'increase production%') AS c FROM ({PRODUCT['p02_production_blueprint']}) GROUP BY 1, 2) USING (category_normalized, size)"),
    "i03_color_price": twin(f"""SELECT category_normalized, color, count(*) AS n, {r('quantile_cont(price, 0.5)')} AS median_price FROM (SELECT category_normalized, price, CASE WHEN product_id % 4 = 0 THEN 'metallic' ELSE ['navy', 'white', 'red', 'olive', 'black', NULL, NULL][product_id % 7 + 1] END AS color
        FROM snapshots WHERE snapshot_date = (SELECT max(snapshot_date) FROM snapshots) AND price > 0 AND product_id % 7 <> 6) WHERE color IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 5"""),
    "i04_demand_trend": twin(_TREND),
    "i05_bestsellers": twin(_BEST.format(3), ranks=_RANKS, weekly=_WEEKLY),
    "i06_order_verdicts": twin(f"""SELECT category_normalized, subcategory, brands, products, events, confidence, coverage, CASE WHEN sure AND t <> 'cooling' THEN 'STRONG BUY' WHEN sure OR t = 'warming' THEN 'BUY' ELSE 'WATCH' END AS verdict,
        {r("events * CASE WHEN sure THEN 1.6::DOUBLE ELSE 1 END * CASE t WHEN 'warming' THEN 1.25::DOUBLE WHEN 'cooling' THEN 0.7::DOUBLE ELSE 1 END", 1)} AS score, concat_ws(',', 'under-supplied', CASE WHEN sure THEN 'proven seller (' || b || ')' END, CASE t WHEN 'steady' THEN 'steady demand' ELSE t END) AS why
        FROM (SELECT g.*, coverage, coalesce(bestsellers, 0) AS b, coalesce(bestsellers, 0) >= 3 AS sure, coalesce(trend, 'steady') AS t FROM ({_GRID.format(_CELL, '', 10).replace('stock_events', 'tagged')}) g
            JOIN (SELECT category_normalized, count(*) FILTER (subcategory <> '') / count(*)::DOUBLE AS coverage FROM tagged WHERE witnessed AND event_type = 'stockout' GROUP BY 1) USING (category_normalized)
            LEFT JOIN ({_BEST.format(30).replace('category_normalized', _CELL).replace('FROM weekly WHERE week', 'FROM ranked WHERE week')}) USING ({_CELL}) LEFT JOIN ({_TREND.replace('category_normalized', _CELL).replace('stock_events', 'tagged')}) USING ({_CELL}) WHERE coverage >= 0.5::DOUBLE AND subcategory <> '')""",
        ranks=_RANKS, weekly=_WEEKLY, tagged=f"SELECT * REPLACE ({_TAG} AS subcategory) FROM stock_events", ranked=f"SELECT w.*, {_TAG} AS subcategory FROM weekly w JOIN (SELECT product_id, subcategory FROM catalogue) USING (product_id)"),
    "i07_discount_verdicts": f"""SELECT category_normalized, products, cleared, clear_pct, coalesce(x, 0) AS distress, CASE WHEN coalesce(x, 0) > 0 AND clear_pct >= 15 THEN 'ACTIVE CLEARANCE' WHEN coalesce(x, 0) > 0 THEN 'STICKY DISTRESS' WHEN clear_pct >= 15 THEN 'HEALTHY MARKDOWN' ELSE 'FIRM' END AS verdict FROM (
        SELECT category_normalized, CAST(sum(products) AS BIGINT) AS products, CAST(sum(cleared) AS BIGINT) AS cleared, {pct('sum(cleared)', 'sum(products)', 1)} AS clear_pct FROM ({MARKET['l2_clear_rate_by_depth']}) GROUP BY 1 HAVING sum(products) >= 5) LEFT JOIN (SELECT category_normalized, max(CASE distress_level WHEN 'urgent' THEN 2 WHEN 'watch' THEN 1 ELSE 0 END) AS x FROM ({PRODUCT['p12_liquidation_calendar']}) GROUP BY 1) USING (category_normalized)""",
    "i08_confidence": twin(f"""SELECT *, CASE WHEN brands >= 10 AND days >= 21 OR events >= 500 THEN 'confirmed' WHEN brands >= 5 AND days >= 7 OR events >= 100 THEN 'directional' ELSE 'maturing' END AS confidence, CASE WHEN events >= 10 THEN 'confirmed' WHEN events >= 5 THEN 'directional' ELSE 'maturing' END AS tier, events >= 5 AS reliable,
        {r('196::DOUBLE * sqrt(greatest(0.5::DOUBLE / 31, least(1 - 0.5::DOUBLE / 31, days / 31::DOUBLE)) * (1 - greatest(0.5::DOUBLE / 31, least(1 - 0.5::DOUBLE / 31, days / 31::DOUBLE))) / 31)', 1)} AS ci FROM (SELECT category_normalized, gender, count(DISTINCT brand) AS brands, count(DISTINCT event_date) AS days, count(*) AS events FROM stock_events WHERE witnessed GROUP BY 1, 2)"""),
    "i10_stale_brands": twin("SELECT brand, last_day, CAST(market_day - last_day AS INTEGER) AS days_behind FROM (SELECT brand, max(event_date) AS last_day, max(max(event_date)) OVER () AS market_day FROM stock_events WHERE event_type = 'restock' GROUP BY 1) WHERE market_day - last_day > 0"),
    "i11_price_ladder": twin(f"SELECT *, {r('p75 - p25')} AS spread FROM (SELECT category_normalized, count(*) AS n, {r('quantile_cont(price, 0.25)')} AS p25, {r('quantile_cont(price, 0.5)')} AS median, {r('quantile_cont(price, 0.75)')} AS p75 FROM snapshots WHERE snapshot_date = (SELECT max(snapshot_date) FROM snapshots) AND price > 0 GROUP BY 1 HAVING count(*) >= 10)"),
    "i12_reorder_chase": f"SELECT *, {r('sellouts * (1 - coalesce(completion_rate_pct, 50) / 100::DOUBLE) * (1 + coalesce(median_restock_days, 3) / 7::DOUBLE)')} AS chase FROM (SELECT brand, category_normalized, CAST(sum(stockout_events) AS BIGINT) AS sellouts FROM ({SIGNAL['l1_08_variant_stockout']}) GROUP BY 1, 2) LEFT JOIN (SELECT brand, category_normalized, completion_rate_pct, median_restock_days FROM ({SIGNAL['l1_09_variant_restock']})) USING (brand, category_normalized) ORDER BY chase DESC, brand, category_normalized LIMIT 5",
    "i14_brand_health_scorecard": f"""SELECT *, CASE WHEN flags >= 3 THEN 'stress' WHEN flags >= 2 THEN 'watch' ELSE 'healthy' END AS health FROM (SELECT *, CAST(slow AS INTEGER) + CAST(absent AS INTEGER) + CAST(distressed AS INTEGER) + CAST(dead AS INTEGER) + CAST(trained AS INTEGER) AS flags FROM (
        SELECT brand, coalesce(slow, false) AS slow, coalesce(absent, false) AS absent, coalesce(distressed, false) AS distressed, coalesce(dead, false) AS dead, coalesce(trained, false) AS trained FROM (SELECT brand, vs_market_ratio >= 1.5::DOUBLE AS slow FROM ({MARKET['l2_replenishment_benchmark']})) FULL JOIN (SELECT brand, avg(completion_rate_pct) < 40 AS absent FROM ({SIGNAL['l1_09_variant_restock']}) GROUP BY 1) USING (brand)
        FULL JOIN (SELECT brand, sum(escalating_products) >= 20 AS distressed FROM ({PRODUCT['p12_liquidation_calendar']}) GROUP BY 1) USING (brand) FULL JOIN (SELECT brand, count(*) >= 15 AS dead FROM ({SIGNAL['l1_10_dead_stock']}) GROUP BY 1) USING (brand) FULL JOIN (SELECT brand, risk_read = 'high' AS trained FROM ({MARKET['l2_trained_customer']})) USING (brand)))""",
    "i15_underpricing": twin(f"""SELECT *, CASE WHEN gap_pct < -45 THEN 'verify' WHEN gap_pct <= -15 THEN 'actionable' ELSE 'in line' END AS read FROM (SELECT *, {pct('brand_median - market_median', 'market_median', 1)} AS gap_pct FROM own JOIN (SELECT category_normalized, count(*) AS brands, {r('quantile_cont(brand_median, 0.5)')} AS market_median FROM own GROUP BY 1 HAVING count(*) >= 3) USING (category_normalized))""",
        own=f"SELECT brand, category_normalized, count(*) AS products, {r('quantile_cont(p, 0.5)')} AS brand_median FROM (SELECT product_id, brand, category_normalized, quantile_cont(price, 0.5) AS p FROM snapshots WHERE price > 0 AND {_in('snapshot_date', 45)} GROUP BY 1, 2, 3) GROUP BY 1, 2 HAVING count(*) >= 2"),
    "i17_discount_leaders": f"SELECT category_normalized, count(DISTINCT brand) AS leaders FROM ({MARKET['l2_first_mover']}) WHERE mover_read = 'first mover' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "i18_clear_curve_summary": f"SELECT count(*) AS cells, {pct('count(*) FILTER (cleared = 0)', 'count(*)', 1)} AS zero_cells_pct, CAST(sum(cleared) AS BIGINT) AS cleared, CAST(sum(products) AS BIGINT) AS products FROM ({MARKET['l2_clear_rate_by_depth']})",
    "i19_action_board": twin(f"SELECT *, {r('sellouts / greatest(restocks, 1)::DOUBLE')} AS gap_ratio FROM (SELECT category_normalized, subcategory, count(*) FILTER (event_type = 'stockout') AS sellouts, count(*) FILTER (event_type = 'restock') AS restocks, count(DISTINCT product_id) FILTER (event_type = 'stockout') AS products, count(DISTINCT brand) FILTER (event_type = 'stockout') AS brands FROM stock_events WHERE witnessed AND {_in('event_date', 21)} GROUP BY 1, 2) WHERE sellouts > 20"),
    "i20_bestseller_persistence": twin(f"SELECT *, CASE WHEN avg_weeks >= 6 THEN 'strong' WHEN avg_weeks >= 3 THEN 'medium' ELSE 'weak' END AS read FROM (SELECT category_normalized, count(DISTINCT product_id) AS products, {r('sum(weeks)::DOUBLE / count(*)', 1)} AS avg_weeks FROM ranks JOIN (SELECT product_id, count(DISTINCT date_trunc('week', snapshot_date)) AS weeks FROM ranks GROUP BY 1) USING (product_id) GROUP BY 1) WHERE products > 5", ranks=_RANKS),
    "i21_bestseller_trend": twin("SELECT category_normalized, CAST(date_trunc('week', snapshot_date) AS DATE) AS week_start, count(DISTINCT product_id) AS products FROM ranks GROUP BY 1, 2", ranks=_RANKS),
    "i22_latest_price": twin(_PRICE),
    "i23_price_band_sellthrough": twin(f"SELECT *, {pct('sold_out', 'products', 1)} AS rate_pct FROM (SELECT category_normalized, CASE WHEN price >= 1000 THEN '1000+' WHEN price >= 700 THEN '700-999' WHEN price >= 500 THEN '500-699' WHEN price >= 300 THEN '300-499' ELSE 'under 300' END AS band, count(*) AS products, count(hit) AS sold_out FROM prices LEFT JOIN gone USING (product_id) GROUP BY 1, 2) WHERE products > 2", prices=_PRICE, gone=_GONE),
    "i24_speed_to_sell": twin(f"SELECT category_normalized, count(*) AS products, {r('quantile_cont(d, 0.5)', 1)} AS median_days FROM (SELECT product_id, category_normalized, CAST(date_diff('second', first_seen_at, min(recorded_at)) // 86400 AS DOUBLE) AS d FROM stock_events WHERE witnessed AND event_type = 'stockout' GROUP BY product_id, category_normalized, first_seen_at) GROUP BY 1 HAVING count(*) > 15"),
    "i25_demand_index": twin("SELECT category_normalized, count(*) AS sold_out, count(*) FILTER (product_id NOT IN (SELECT product_id FROM w WHERE event_type = 'restock')) AS still_out FROM (SELECT DISTINCT category_normalized, product_id FROM w WHERE event_type = 'stockout') GROUP BY 1", w=f"SELECT * FROM stock_events WHERE witnessed AND {_in('event_date', 21)}"),
    "i32_price_movements": twin(f"SELECT category_normalized, count(*) FILTER (now) AS changes, count(*) FILTER (now AND direction = 'up') AS ups, count(*) FILTER (now AND direction = 'down') AS downs, count(*) FILTER (NOT now) AS changes_before FROM (SELECT *, event_date > {D} - 7 AS now FROM price_events WHERE {_in('event_date', 14)}) GROUP BY 1 HAVING count(*) FILTER (now) > 50"),
    "i33_size_ratios": _ratio("size", 3),
    "i34_color_ratios": _ratio("color", 5),
    "i39_sellthrough_by_depth": twin(_BYDEPTH, prices=_PRICE, gone=_GONE),
    "i40_age_discount_matrix": twin(f"""SELECT *, CASE WHEN products >= 40 THEN 'hot' WHEN products >= 15 THEN 'warm' ELSE 'cool' END AS heat FROM (SELECT CASE WHEN a >= 61 THEN '60+' WHEN a >= 31 THEN '31-60' WHEN a >= 15 THEN '15-30' ELSE '0-14' END AS age, CASE WHEN d >= 40 THEN '40+' WHEN d >= 30 THEN '30-39' WHEN d >= 20 THEN '20-29' WHEN d >= 1 THEN '1-19' ELSE 'full' END AS depth, count(*) AS products
        FROM (SELECT {D} - CAST(first_seen_at AS DATE) AS a, {_DEPTH.replace('first_observed_price', 'p.first_observed_price')} AS d FROM prices p JOIN products USING (product_id)) GROUP BY 1, 2)""", prices=_PRICE),
    "i41_brand_activity": twin(f"""SELECT *, CASE WHEN (launches > 0 OR restocks >= sellouts) AND price_changes >= 50 THEN 'attack' WHEN launches > 0 OR restocks >= sellouts THEN 'manage' WHEN price_changes > 0 THEN 'defend' ELSE 'sleep' END AS posture FROM (SELECT brand, coalesce(launches, 0) AS launches, coalesce(price_changes, 0) AS price_changes, coalesce(sellouts, 0) AS sellouts, coalesce(restocks, 0) AS restocks
        FROM (SELECT brand, count(DISTINCT product_id) AS launches FROM shelf WHERE {_in('first_seen + 10400', 7)} GROUP BY 1) FULL JOIN (SELECT brand, count(*) AS price_changes FROM price_events WHERE {_in('event_date', 7)} GROUP BY 1) USING (brand) FULL JOIN (SELECT brand, count(*) FILTER (event_type = 'stockout') AS sellouts, count(*) FILTER (event_type = 'restock') AS restocks FROM stock_events WHERE witnessed AND {_in('event_date', 7)} GROUP BY 1) USING (brand))"""),
    "i42_market_temperature": twin(f"SELECT *, {r('sellouts / greatest(restocks, 1)::DOUBLE')} AS ratio FROM (SELECT CAST(date_trunc('week', recorded_at) AS DATE) AS week_start, count(*) FILTER (event_type = 'stockout') AS sellouts, count(*) FILTER (event_type = 'restock') AS restocks FROM stock_events WHERE witnessed AND event_type IN ('stockout', 'restock') GROUP BY 1) WHERE week_start < date_trunc('week', {D}) AND week_start >= date_trunc('week', {D}) - INTERVAL 28 DAY"),
    "i43_stock_board": twin("""SELECT category_normalized, products, volume, best_depth, rate_pct, CASE WHEN products < 50 THEN 'hold' WHEN best_rate < 12 THEN 'stop' WHEN best_depth = 'full' THEN 'raise' WHEN best_depth = '1-24' THEN 'light' WHEN best_depth IS NOT NULL THEN 'deep' ELSE 'hold' END AS verdict FROM (SELECT category_normalized, CAST(sum(sold_out) AS BIGINT) AS volume, max(rate_pct) AS best_rate, CAST(sum(products) AS BIGINT) AS products FROM d GROUP BY 1)
        LEFT JOIN (SELECT category_normalized, arg_max(depth, (rate_pct, depth)) AS best_depth, max(rate_pct) AS rate_pct FROM (SELECT *, sum(sold_out) OVER (PARTITION BY category_normalized) AS v FROM d) WHERE products >= 5 AND sold_out >= 0.2::DOUBLE * v GROUP BY 1) USING (category_normalized)""", prices=_PRICE, gone=_GONE, d=_BYDEPTH),
    "i46_live_deals": twin("SELECT product_id, brand, price_after, discount_pct, recorded_at FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY recorded_at DESC, event_id DESC) AS rn FROM price_events WHERE direction = 'down') WHERE rn = 1 ORDER BY recorded_at DESC, event_id DESC LIMIT 3"),
    "h01_weekly_product_summary": twin(f"""SELECT p.*, coalesce(discount_event_count, 0) AS discount_event_count, max_discount_pct, coalesce(days_on_discount, 0) AS days_on_discount, coalesce(stockout_count, 0) AS stockout_count, coalesce(restock_count, 0) AS restock_count, CAST(week(week_start) AS INTEGER) AS iso_week, CAST(isoyear(week_start) AS INTEGER) AS iso_year FROM (
        SELECT product_id, brand, category_normalized, gender, first_observed_price, CAST(date_trunc('week', snapshot_date) AS DATE) AS week_start, {r('quantile_cont(price, 0.5)')} AS price_median, min(price) AS price_min, max(price) AS price_max, arg_min(price, snapshot_date) AS price_open, arg_max(price, snapshot_date) AS price_close, count(*) AS sample_days FROM snapshots GROUP BY 1, 2, 3, 4, 5, 6) p
        LEFT JOIN (SELECT product_id, CAST(date_trunc('week', recorded_at) AS DATE) AS week_start, count(*) AS discount_event_count, max(discount_pct) AS max_discount_pct, count(DISTINCT event_date) AS days_on_discount FROM price_events WHERE direction = 'down' AND discount_pct > 0 GROUP BY 1, 2) USING (product_id, week_start)
        LEFT JOIN (SELECT product_id, CAST(date_trunc('week', recorded_at) AS DATE) AS week_start, count(*) FILTER (event_type = 'stockout') AS stockout_count, count(*) FILTER (event_type = 'restock') AS restock_count FROM stock_events WHERE witnessed GROUP BY 1, 2) USING (product_id, week_start)"""),
    "h04_refreshed_weeks": "",
    "h02_weekly_variant_exception": twin("""SELECT *, price_max - price_min > 0.01::DOUBLE AS price_diverged FROM (SELECT product_id AS variant_id, product_id, CAST(date_trunc('week', recorded_at) AS DATE) AS week_start, count(*) FILTER (kind = 'error') AS stockout_count, count(*) FILTER (kind = 'signup') AS restock_count, min(price) AS price_min, max(price) AS price_max
        FROM (SELECT *, event_type AS kind FROM observations SEMI JOIN catalogue USING (product_id)) GROUP BY 1, 2, 3) WHERE stockout_count > 0 OR restock_count > 0 OR price_max - price_min > 0.01::DOUBLE"""),
    "h03_weekly_bestseller_summary": twin(_WEEKLY, ranks=_RANKS),
    "h05_purge_rolled_up": twin(f"SELECT * FROM ranks WHERE NOT (snapshot_date < {D} - 21 AND date_trunc('week', snapshot_date) <> DATE '2024-01-01')", ranks=_RANKS),
}


SQL["h04_refreshed_weeks"] = SQL["h01_weekly_product_summary"]


def queries() -> dict:
    return {name: (lambda spark, sf_dir, f=f: f(Shop(spark, sf_dir))) for name, f in QUERIES.items()}

"""Product queries over the shop tables: signals are built first, then joined. SQL twins nest the signals' twins."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from stallwatch.operators import products as P
from stallwatch.operators import signals as S
from stallwatch.plans.base_sql import AS_OF as D
from stallwatch.plans.base_sql import pct, r
from stallwatch.plans.signals_catalog import SQL as SIGNAL
from stallwatch.sources.shop import AS_OF, CATALOGUE_AS_OF, DELIST_AS_OF, Shop


class Signals:
    """The signals that products read, over one shop; each is planned when it is first read."""

    def __init__(self, shop: Shop):
        self.shop = shop

    @cached_property
    def sizes(self) -> DataFrame:
        return S.current_sizes(self.shop.stock_events)

    @cached_property
    def drops(self) -> DataFrame:
        return S.genuine_price_drop(self.shop.snapshots, AS_OF)

    @cached_property
    def anchors(self) -> DataFrame:
        return S.anchor_inflation(self.shop.snapshots, AS_OF, price_step=100.0)

    @cached_property
    def stockouts(self) -> DataFrame:
        return S.variant_stockout(self.shop.stock_events, AS_OF)

    @cached_property
    def restocks(self) -> DataFrame:
        return S.variant_restock(self.shop.stock_events, AS_OF)

    @cached_property
    def dead(self) -> DataFrame:
        return S.dead_stock(self.shop.snapshots, self.sizes, AS_OF, min_discount=10.0)

    @cached_property
    def escalations(self) -> DataFrame:
        return S.discount_depth_escalation(self.shop.price_events, AS_OF)

    @cached_property
    def staircases(self) -> DataFrame:
        return S.price_staircase(self.shop.price_events, AS_OF)

    @cached_property
    def anomalies(self) -> DataFrame:
        return S.price_anomaly(self.shop.snapshots, AS_OF)

    @cached_property
    def asymmetry(self) -> DataFrame:
        return S.size_asymmetry(self.shop.stock_events, self.sizes, AS_OF)

    @cached_property
    def launches(self) -> DataFrame:
        return S.new_sku_launch(self.shop.shelf, CATALOGUE_AS_OF)

    @cached_property
    def delists(self) -> DataFrame:
        return S.product_delisted(self.shop.shelf, DELIST_AS_OF)

    @cached_property
    def bursts(self) -> DataFrame:
        return S.discount_velocity(self.shop.price_events, AS_OF, min_products=2)

    @cached_property
    def density(self) -> DataFrame:
        return S.restock_density(self.shop.stock_events, AS_OF)


QUERIES = {
    "p01_price_elasticity": lambda g: P.price_elasticity(g.drops, g.stockouts, AS_OF),
    "p02_production_blueprint": lambda g: P.production_blueprint(g.asymmetry, g.dead, g.launches, g.delists, AS_OF, min_count=1),
    "p08_brand_health": lambda g: P.brand_health(g.drops, g.anchors, g.dead, g.restocks, g.escalations, AS_OF),
    "p09_revealed_demand": lambda g: P.revealed_demand(g.stockouts, g.anomalies, g.asymmetry, AS_OF, min_count=1),
    "p10_market_entry": lambda g: P.market_entry(g.launches, g.delists, g.dead, AS_OF),
    "p12_liquidation_calendar": lambda g: P.liquidation_calendar(g.escalations, g.dead, g.staircases, g.bursts, g.density, AS_OF),
    "p13_wallet_allocator": lambda g: P.wallet_allocator(g.stockouts, g.launches, g.asymmetry, AS_OF, min_count=1),
}

#: Frames that several signals of a product read: made once a run.
SETTLED = {name: ("products", "snapshots", "price_events", "stock_events") for name in ("p08_brand_health", "p12_liquidation_calendar")}

_NAMES = {"drops": "l1_01_genuine_price_drop", "anchors": "l1_04_anchor_inflation", "outs": "l1_08_variant_stockout", "backs": "l1_09_variant_restock", "dead": "l1_10_dead_stock", "esc": "l1_17_discount_depth_escalation", "stairs": "l1_03_price_staircase", "odd": "l1_07_price_anomaly", "asym": "l1_11_size_asymmetry", "launch": "l1_12_new_sku_launch", "gone": "l1_13_product_delisted", "bursts": "l1_22_discount_velocity", "density": "l1_24_restock_density"}
KEY = "brand, category_normalized"


def _with(names: str, body: str) -> str:
    return "WITH " + ", ".join(f"{n} AS MATERIALIZED ({SIGNAL[_NAMES[n]]})" for n in names.split()) + " " + body


def _new(name: str) -> str:
    return f"(SELECT * FROM {name} WHERE snapshot_date = (SELECT max(snapshot_date) FROM {name}))"


def _zero(*names: str) -> str:
    return ", ".join(f"coalesce({n}, 0) AS {n}" for n in names)


_DEMAND = f"SELECT {KEY}, stocked_out_size, count(*) AS stockout_count, count(DISTINCT product_id) AS products_affected, count(*) FILTER (len(sizes_still_in_stock) > 0) AS while_other_sizes_available FROM asym GROUP BY ALL"
_CONTEXT = f"SELECT {KEY}, CAST(sum(stockout_events) AS BIGINT) AS category_stockout_events, {pct('sum(on_discount_events)', 'sum(stockout_events)')} AS category_pct_stockouts_while_discounted FROM {_new('outs')} GROUP BY ALL"
_DEAD = f"SELECT {KEY}, count(DISTINCT product_id) AS dead_stock_products, {r('avg(honest_discount_pct)')} AS avg_dead_discount_pct FROM {_new('dead')} GROUP BY ALL"
_LAUNCH = f"SELECT {KEY}, count(*) AS n_new, {r('sum(CAST(floor(launch_price * 100::DOUBLE + 0.5) AS BIGINT))::DOUBLE / count(launch_price) / 100::DOUBLE')} AS avg_launch_price FROM launch GROUP BY ALL"
_GONE = f"SELECT {KEY}, count(*) AS n_gone FROM gone GROUP BY ALL"

SQL = {
    "p01_price_elasticity": _with("drops outs", f"""SELECT *, CASE WHEN pct_stockouts_while_discounted >= 15 THEN 'elastic' WHEN pct_stockouts_while_discounted < 5 THEN 'inelastic' ELSE 'moderate' END AS elasticity_read, {D} AS report_date FROM (SELECT {KEY}, gender, count(DISTINCT product_id) AS products_with_drops, {r('avg(drop_pct)')} AS avg_drop_pct, max(drop_pct) AS max_drop_pct FROM {_new('drops')} GROUP BY ALL)
        JOIN (SELECT {KEY}, gender, stockout_events, products_affected AS products_stocking_out, on_discount_pct AS pct_stockouts_while_discounted FROM {_new('outs')}) USING ({KEY}, gender)"""),
    "p02_production_blueprint": _with("asym dead launch gone", f"""SELECT *, CASE WHEN undersupply_signal >= 5 AND oversupply_signal_category = 0 THEN 'increase production' WHEN undersupply_signal >= 5 THEN 'rebalance sizes' ELSE 'monitor' END AS production_signal, {D} AS report_date FROM (
        SELECT {KEY}, stocked_out_size, stockout_count AS undersupply_signal, coalesce(n_dead, 0) AS oversupply_signal_category, coalesce(n_new, 0) AS new_skus_launched_category, coalesce(n_gone, 0) AS delisted_skus_category
        FROM ({_DEMAND}) LEFT JOIN (SELECT {KEY}, count(*) AS n_dead FROM {_new('dead')} GROUP BY ALL) USING ({KEY}) LEFT JOIN ({_LAUNCH}) USING ({KEY}) LEFT JOIN ({_GONE}) USING ({KEY}))"""),
    "p08_brand_health": _with("drops anchors dead backs esc", f"""SELECT *, CAST(greatest(0, least(100, floor(50 - 2 * dead_stock_products - 3 * escalating_products + 0.5::DOUBLE * coalesce(restock_completion_pct, 50) + 0.5::DOUBLE))) AS INTEGER) AS health_score_0_100, {D} AS report_date FROM (
        SELECT {KEY}, {_zero('products_dropping')}, avg_drop_pct, {_zero('anchor_inflation_events', 'dead_stock_products')}, avg_dead_discount_pct, restock_completion_pct, median_restock_days, {_zero('escalating_products')}
        FROM (SELECT {KEY}, count(DISTINCT product_id) AS products_dropping, {r('avg(drop_pct)')} AS avg_drop_pct FROM {_new('drops')} GROUP BY ALL) FULL JOIN (SELECT {KEY}, count(*) AS anchor_inflation_events FROM anchors GROUP BY ALL) USING ({KEY}) FULL JOIN ({_DEAD}) USING ({KEY})
        FULL JOIN (SELECT {KEY}, completion_rate_pct AS restock_completion_pct, median_restock_days FROM {_new('backs')}) USING ({KEY}) FULL JOIN (SELECT {KEY}, count(DISTINCT product_id) AS escalating_products FROM {_new('esc')} GROUP BY ALL) USING ({KEY}))"""),
    "p09_revealed_demand": _with("asym outs odd", f"""SELECT {KEY}, stocked_out_size, stockout_count, products_affected, while_other_sizes_available, {pct('while_other_sizes_available', 'stockout_count')} AS pct_size_specific_demand, category_stockout_events, category_pct_stockouts_while_discounted, coalesce(n_odd, 0) AS category_price_anomalies, {D} AS report_date
        FROM ({_DEMAND}) LEFT JOIN ({_CONTEXT}) USING ({KEY}) LEFT JOIN (SELECT {KEY}, count(*) AS n_odd FROM {_new('odd')} GROUP BY ALL) USING ({KEY})"""),
    "p10_market_entry": _with("launch gone dead", f"""SELECT *, CASE WHEN net_catalogue_change > 5 THEN 'expanding' WHEN net_catalogue_change < -5 THEN 'retreating' ELSE 'stable' END AS trajectory, {D} AS report_date FROM (SELECT {KEY}, coalesce(n_new, 0) AS new_skus_launched, avg_launch_price, coalesce(n_gone, 0) AS skus_delisted, {_zero('dead_stock_products')}, coalesce(n_new, 0) - coalesce(n_gone, 0) AS net_catalogue_change
        FROM ({_LAUNCH}) FULL JOIN ({_GONE}) USING ({KEY}) FULL JOIN ({_DEAD}) USING ({KEY}))"""),
    "p12_liquidation_calendar": _with("esc dead stairs bursts density", f"""SELECT *, CASE WHEN escalating_products >= 3 AND dead_stock_products >= 3 AND variants_restocked_recently < 5 THEN 'urgent' WHEN escalating_products >= 3 OR dead_stock_products >= 5 THEN 'watch' ELSE 'normal' END AS distress_level, {D} AS report_date FROM (
        SELECT {KEY}, avg_current_depth_pct, {_zero('escalating_products', 'dead_stock_products', 'staircase_products', 'skus_in_discount_bursts', 'variants_restocked_recently')}
        FROM (SELECT {KEY}, count(DISTINCT product_id) AS escalating_products, {r('avg(last_depth_pct)')} AS avg_current_depth_pct FROM {_new('esc')} GROUP BY ALL) FULL JOIN ({_DEAD}) USING ({KEY}) FULL JOIN (SELECT {KEY}, count(DISTINCT product_id) AS staircase_products FROM {_new('stairs')} GROUP BY ALL) USING ({KEY})
        FULL JOIN (SELECT {KEY}, CAST(sum(skus_dropped) AS BIGINT) AS skus_in_discount_bursts FROM bursts GROUP BY ALL) USING ({KEY}) FULL JOIN (SELECT {KEY}, CAST(sum(variants_restocked) AS BIGINT) AS variants_restocked_recently FROM density GROUP BY ALL) USING ({KEY}))"""),
    "p13_wallet_allocator": _with("asym launch outs", f"""SELECT {KEY}, stocked_out_size, stockout_count, coalesce(n_new, 0) AS new_skus_launched_in_category, avg_launch_price, category_pct_stockouts_while_discounted, CASE WHEN stockout_count >= 5 AND coalesce(n_new, 0) >= 3 THEN 'strong' WHEN stockout_count >= 5 THEN 'opportunity' ELSE 'emerging' END AS allocation_read, {D} AS report_date
        FROM ({_DEMAND}) LEFT JOIN ({_LAUNCH}) USING ({KEY}) LEFT JOIN ({_CONTEXT}) USING ({KEY})"""),
}


def queries() -> dict:
    return {name: (lambda spark, sf_dir, f=f, read=SETTLED.get(name, ()): f(Signals(Shop(spark, sf_dir).settle(*read)))) for name, f in QUERIES.items()}

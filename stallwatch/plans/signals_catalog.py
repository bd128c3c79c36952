"""Signal queries over the shop tables, each with its SQL twin."""

from __future__ import annotations

import uuid

from stallwatch.operators import signals as S
from stallwatch.operators.maintenance import Signal, run_signals
from stallwatch.plans.base_sql import AS_OF as D
from stallwatch.plans.base_sql import pct, r, twin
from stallwatch.sources.shared import shared_folder
from stallwatch.sources.shop import AS_OF, CATALOGUE_AS_OF, DELIST_AS_OF, Shop

LATEST = "SELECT * FROM (SELECT s.*, row_number() OVER (PARTITION BY product_id ORDER BY recorded_at DESC) AS rn FROM snapshots s JOIN (SELECT brand, max(snapshot_date) AS snapshot_date FROM snapshots GROUP BY 1) USING (brand, snapshot_date) WHERE price > 0) WHERE rn = 1"
WHO = "product_id, brand, product_name, category_normalized"
PLACE = "product_id, brand, product_name, department, category_normalized, subcategory"


def _in(day: str, days: int, as_of: str = D) -> str:
    return f"{day} > {as_of} - {days} AND {day} <= {as_of}"


def _run_log(s: Shop):
    """The log of a run: three signals in two waves over frames that are written once, one that waits for a signal that is off, one that fails."""
    root = f"{shared_folder(s.spark)}/stallwatch/run-{uuid.uuid4().hex}"
    s = s.settle("snapshots", "price_events")

    def broken():
        raise RuntimeError("no such source")

    signals = [
        Signal("l1_17", lambda: S.discount_depth_escalation(s.price_events, AS_OF), requires=["l1_01"]), Signal("l1_01", lambda: S.genuine_price_drop(s.snapshots, AS_OF)), Signal("l1_03", lambda: S.price_staircase(s.price_events, AS_OF)),
        Signal("off", broken, enabled=False), Signal("waits", broken, requires=["off"]), Signal("broken", broken), Signal("long", broken, min_days=400),
    ]
    run_signals(s.spark, signals, s.snapshots, f"{root}/tables", f"{root}/log", time_limit=1800)
    return s.spark.read.parquet(f"{root}/log").select("signal_id", "status", "reason", "rows_written")


QUERIES = {
    "r01_run_log": _run_log,
    "l1_01_genuine_price_drop": lambda s: S.genuine_price_drop(s.snapshots, AS_OF),
    "l1_02_intraday_flash_sale": lambda s: S.intraday_flash_sale(s.price_events, AS_OF),
    "l1_03_price_staircase": lambda s: S.price_staircase(s.price_events, AS_OF),
    "l1_03_price_staircase_strict": lambda s: S.price_staircase(s.price_events, AS_OF, strict=True),
    "l1_04_anchor_inflation": lambda s: S.anchor_inflation(s.snapshots, AS_OF, price_step=100.0),
    "l1_06_discount_recovery": lambda s: S.discount_recovery(s.price_events, AS_OF),
    "l1_07_price_anomaly": lambda s: S.price_anomaly(s.snapshots, AS_OF),
    "l1_07_price_anomaly_suppressed": lambda s: S.price_anomaly_suppressed(s.snapshots, AS_OF, min_days=30),
    "l1_08_variant_stockout": lambda s: S.variant_stockout(s.stock_events, AS_OF),
    "l1_08_variant_stockout_suppressed": lambda s: S.variant_stockout_suppressed(s.stock_events, AS_OF),
    "l1_09_variant_restock": lambda s: S.variant_restock(s.stock_events, AS_OF),
    "l1_09_variant_restock_suppressed": lambda s: S.variant_restock_suppressed(s.stock_events, AS_OF),
    "l1_10_dead_stock": lambda s: S.dead_stock(s.snapshots, S.current_sizes(s.stock_events), AS_OF, min_discount=10.0),
    "l1_11_size_asymmetry": lambda s: S.size_asymmetry(s.stock_events, S.current_sizes(s.stock_events), AS_OF),
    "l1_12_new_sku_launch": lambda s: S.new_sku_launch(s.shelf, CATALOGUE_AS_OF),
    "l1_13_product_delisted": lambda s: S.product_delisted(s.shelf, DELIST_AS_OF),
    "l1_14_launch_to_first_discount": lambda s: S.launch_to_first_discount(s.price_events, AS_OF),
    "l1_17_discount_depth_escalation": lambda s: S.discount_depth_escalation(s.price_events, AS_OF),
    "l1_22_discount_velocity": lambda s: S.discount_velocity(s.price_events, AS_OF, min_products=2),
    "l1_24_restock_density": lambda s: S.restock_density(s.stock_events, AS_OF),
}

_STEPS = f"""SELECT *, sum(CASE WHEN good THEN 0 ELSE 1 END) OVER (PARTITION BY product_id ORDER BY recorded_at, event_id ROWS UNBOUNDED PRECEDING) AS run FROM (
    SELECT *, direction = 'down' AND (before IS NULL OR price_after < before) AS good FROM (SELECT *, lag(price_after) OVER (PARTITION BY product_id ORDER BY recorded_at, event_id) AS before FROM price_events WHERE {_in('event_date', 21)}))"""


def _staircase(run: str) -> str:
    group = f"SELECT {WHO}, gender {run}, CAST(count(*) AS INTEGER) AS step_count, arg_min(price_after, (recorded_at, event_id)) AS first_price, arg_max(price_after, (recorded_at, event_id)) AS last_price, min(recorded_at) AS first_step_at, max(recorded_at) AS last_step_at FROM steps WHERE good GROUP BY ALL"
    if run:
        group = f"SELECT * EXCLUDE (run, rn) FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY step_count DESC, run) AS rn FROM ({group})) WHERE rn = 1"
    return twin(f"SELECT *, {D} AS snapshot_date, {r('100::DOUBLE * (first_price - last_price) / first_price')} AS total_descent_pct, CAST(date_diff('day', first_step_at, last_step_at) AS INTEGER) AS span_days FROM ({group}) WHERE step_count >= 3 AND last_price < first_price", steps=_STEPS)


_PAST = f"SELECT product_id, CAST(count(DISTINCT snapshot_date) AS INTEGER) AS days_observed, {r('quantile_cont(price, 0.25)', 4)} AS q1_price, {r('quantile_cont(price, 0.5)', 4)} AS median_price, {r('quantile_cont(price, 0.75)', 4)} AS q3_price, min(price) AS lowest FROM win GROUP BY 1"
_ANOMALY = {
    "win": f"SELECT * FROM snapshots WHERE price > 0 AND {_in('snapshot_date', 30)}",
    "latest": LATEST.replace("snapshots s", "win s").replace("FROM snapshots GROUP", "FROM win GROUP"),
    "past": _PAST,
    "fenced": f"SELECT *, {r('q1_price - 1.5::DOUBLE * iqr', 4)} AS lower_fence FROM (SELECT *, {r('q3_price - q1_price', 4)} AS iqr FROM past)",
    "flagged": "SELECT * FROM latest JOIN fenced USING (product_id) WHERE iqr > 0 AND price < lower_fence",
}
_OUT_GROUPS = f"""SELECT brand, coalesce(category_normalized, 'uncategorized') AS category_normalized, coalesce(gender, 'unknown') AS gender, count(*) AS stockout_events, count(DISTINCT variant_id) AS variants_affected, count(DISTINCT product_id) AS products_affected,
    count(*) FILTER (was_on_discount) AS on_discount_events, count(DISTINCT event_date) AS observed_days FROM stock_events WHERE witnessed AND event_type = 'stockout' AND {_in('event_date', 30)} GROUP BY 1, 2, 3"""
_NEXT = "SELECT *, lead(event_type) OVER w AS next_type, lead(recorded_at) OVER w AS next_at FROM stock_events WHERE witnessed AND event_type IN ('stockout', 'restock') WINDOW w AS (PARTITION BY variant_id ORDER BY recorded_at, event_id)"
_BACK_GROUPS = f"""SELECT brand, coalesce(category_normalized, 'uncategorized') AS category_normalized, count(d) AS closed_pairs, count(*) - count(d) AS open_stockouts, quantile_cont(d, 0.5) AS q50, quantile_cont(d, 0.25) AS q25, quantile_cont(d, 0.75) AS q75, min(d) AS fastest, count(DISTINCT event_date) AS observed_days
    FROM (SELECT *, CASE WHEN next_type = 'restock' THEN date_diff('second', recorded_at, next_at) / 86400::DOUBLE END AS d FROM pairs WHERE event_type = 'stockout' AND {_in('event_date', 30)}) GROUP BY 1, 2"""
_SIZES = "SELECT product_id, size, arg_max(event_type, (recorded_at, event_id)) = 'restock' AS is_in_stock FROM stock_events WHERE witnessed GROUP BY 1, 2"

SQL = {
    "l1_01_genuine_price_drop": twin(f"SELECT {WHO}, gender, snapshot_date, price AS current_price, first_observed_price AS baseline_price, {r('100::DOUBLE * (first_observed_price - price) / first_observed_price')} AS drop_pct FROM latest WHERE first_observed_price > 0 AND price < first_observed_price AND (first_observed_price - price) / first_observed_price >= 0.1::DOUBLE", latest=LATEST),
    "l1_02_intraday_flash_sale": twin(f"""SELECT {WHO}, event_date AS snapshot_date, count(*) AS flash_events, max(discount_pct) AS deepest_pct, min(recorded_at) AS first_at, max(recorded_at) AS last_at FROM price_events d
        WHERE direction = 'down' AND {_in('event_date', 90)} AND EXISTS (SELECT 1 FROM price_events u WHERE u.product_id = d.product_id AND u.direction = 'up' AND u.recorded_at > d.recorded_at AND u.recorded_at < d.recorded_at + INTERVAL 24 HOUR) GROUP BY ALL"""),
    "l1_03_price_staircase": _staircase(""),
    "l1_03_price_staircase_strict": _staircase(", run"),
    "l1_04_anchor_inflation": twin(f"""SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY product_id, snapshot_date ORDER BY anchor_inflation_pct DESC, new_compare_at DESC) AS rn FROM (
        SELECT {PLACE}, prev_compare_at, compare_at_price AS new_compare_at, actual AS actual_price, {r('100::DOUBLE * (compare_at_price - prev_compare_at) / prev_compare_at')} AS anchor_inflation_pct, snapshot_date FROM moved WHERE prev_compare_at > 0 AND compare_at_price > prev_compare_at AND actual = prev_price)) WHERE rn = 1""",
        moved=f"SELECT *, lag(compare_at_price) OVER w AS prev_compare_at, lag(actual) OVER w AS prev_price FROM (SELECT *, floor(price / 100::DOUBLE) * 100 AS actual FROM snapshots WHERE compare_at_price IS NOT NULL AND {_in('snapshot_date', 90)}) WINDOW w AS (PARTITION BY product_id ORDER BY snapshot_date, recorded_at)"),
    "l1_06_discount_recovery": twin(f"""SELECT {PLACE}, first_observed_price, low_price, price_after AS recovered_price, {r('100::DOUBLE * (first_observed_price - price_after) / first_observed_price')} AS structural_reprice_pct, event_date AS recovery_date, event_date AS snapshot_date FROM (
        SELECT *, row_number() OVER (PARTITION BY product_id, event_date ORDER BY recorded_at DESC, event_id DESC) AS rn FROM (SELECT *, lag(price_after) OVER w AS low_price, lag(direction) OVER w AS was FROM price_events WHERE {_in('event_date', 90)} WINDOW w AS (PARTITION BY product_id ORDER BY recorded_at, event_id))
        WHERE direction = 'up' AND was = 'down' AND price_after > low_price AND price_after < first_observed_price) WHERE rn = 1"""),
    "l1_07_price_anomaly": twin(f"""SELECT {WHO}, gender, snapshot_date, price AS current_price, median_price, q1_price, q3_price, iqr, lower_fence, {r('100::DOUBLE * (price - median_price) / median_price')} AS deviation_pct, price <= lowest AS is_lowest_ever, days_observed, 30 AS window_days, CAST(n AS INTEGER) AS band_move_size, n >= 3 AS is_band_move
        FROM (SELECT *, count(*) OVER (PARTITION BY brand, price) AS n FROM flagged WHERE days_observed >= 14)""", **_ANOMALY),
    "l1_07_price_anomaly_suppressed": twin("SELECT count(*) AS suppressed FROM flagged WHERE days_observed < 30", **_ANOMALY),
    "l1_08_variant_stockout": twin(f"SELECT *, {D} AS snapshot_date, {pct('on_discount_events', 'stockout_events')} AS on_discount_pct, 30 AS window_days FROM ({_OUT_GROUPS}) WHERE stockout_events >= 3"),
    "l1_08_variant_stockout_suppressed": twin(f"SELECT count(*) AS suppressed FROM ({_OUT_GROUPS}) WHERE stockout_events < 3"),
    "l1_09_variant_restock": twin(f"SELECT {D} AS snapshot_date, brand, category_normalized, closed_pairs, open_stockouts, {pct('closed_pairs', 'closed_pairs + open_stockouts')} AS completion_rate_pct, {r('q50')} AS median_restock_days, {r('q25')} AS p25_restock_days, {r('q75')} AS p75_restock_days, {r('fastest')} AS fastest_restock_days, observed_days, 30 AS window_days FROM ({_BACK_GROUPS}) WHERE closed_pairs >= 5", pairs=_NEXT),
    "l1_09_variant_restock_suppressed": twin(f"SELECT count(*) AS suppressed FROM ({_BACK_GROUPS}) WHERE closed_pairs < 5", pairs=_NEXT),
    "l1_10_dead_stock": twin(f"SELECT {PLACE}, honest_discount_pct, variant_count, in_stock_count, snapshot_date FROM latest JOIN (SELECT product_id, count(*) AS variant_count, count(*) FILTER (is_in_stock) AS in_stock_count FROM sizes GROUP BY 1) USING (product_id) WHERE honest_discount_pct >= 10 AND variant_count = in_stock_count", latest=LATEST, sizes=_SIZES),
    "l1_11_size_asymmetry": twin(f"""SELECT {PLACE}, size AS stocked_out_size, color AS stocked_out_color, sizes_still_in_stock, event_date, {D} AS snapshot_date FROM (SELECT *, row_number() OVER (PARTITION BY product_id, size ORDER BY recorded_at DESC, color NULLS LAST, event_id DESC) AS rn FROM stock_events WHERE witnessed AND event_type = 'stockout' AND was_on_discount AND {_in('event_date', 2)})
        JOIN (SELECT product_id, list_sort(list(DISTINCT size)) AS sizes_still_in_stock FROM sizes WHERE is_in_stock GROUP BY 1) USING (product_id) WHERE rn = 1""", sizes=_SIZES),
    "l1_12_new_sku_launch": twin(f"SELECT {PLACE}, first_observed_price AS launch_price, first_seen AS launch_date, first_seen AS snapshot_date FROM shelf JOIN (SELECT brand, min(first_seen) AS begun FROM shelf GROUP BY 1) USING (brand) WHERE first_seen > begun AND {_in('first_seen', 90, f'DATE {CATALOGUE_AS_OF!r}')}"),
    "l1_13_product_delisted": twin(f"""SELECT {PLACE}, first_observed_price, last_price AS final_price, CASE WHEN first_observed_price > 0 AND first_observed_price >= last_price THEN {r('100::DOUBLE * (first_observed_price - last_price) / first_observed_price')} END AS final_discount_pct, last_seen AS delisted_date, last_seen AS snapshot_date
        FROM gone g WHERE {_in('last_seen', 90, f'DATE {DELIST_AS_OF!r}')} AND NOT EXISTS (SELECT 1 FROM mass m WHERE m.brand = g.brand AND m.last_seen = g.last_seen)""",
        gone=f"SELECT * FROM shelf WHERE last_seen < DATE '{DELIST_AS_OF}' - 14", mass="SELECT brand, last_seen FROM (SELECT brand, last_seen, count(*) AS n FROM gone GROUP BY 1, 2) JOIN (SELECT brand, count(*) AS c FROM shelf GROUP BY 1) USING (brand) WHERE 100::DOUBLE * n / c > 20"),
    "l1_14_launch_to_first_discount": twin(f"SELECT *, first_discount_date AS snapshot_date FROM (SELECT {PLACE}, CAST(first_seen_at AS DATE) AS launch_date, min(event_date) AS first_discount_date, CAST(min(event_date) - CAST(first_seen_at AS DATE) AS INTEGER) AS days_to_first_discount FROM price_events WHERE direction = 'down' GROUP BY {PLACE}, first_seen_at) WHERE days_to_first_discount >= 0 AND {_in('launch_date', 90)}"),
    "l1_17_discount_depth_escalation": twin(f"""SELECT *, {D} AS snapshot_date, CAST(date_diff('day', first_step_at, last_step_at) AS INTEGER) AS span_days FROM (SELECT {WHO}, gender, CAST(count(*) AS INTEGER) AS escalation_count, arg_min(discount_pct, (recorded_at, event_id)) AS first_depth_pct, arg_max(discount_pct, (recorded_at, event_id)) AS last_depth_pct, min(recorded_at) AS first_step_at, max(recorded_at) AS last_step_at FROM (
        SELECT *, max(discount_pct) OVER (PARTITION BY product_id ORDER BY recorded_at, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS deepest FROM price_events WHERE discount_pct > 0 AND {_in('event_date', 30)}) WHERE deepest IS NULL OR discount_pct > deepest GROUP BY ALL) WHERE escalation_count >= 2 AND last_depth_pct > first_depth_pct"""),
    "l1_22_discount_velocity": twin(f"SELECT *, CAST(window_start AS DATE) AS snapshot_date FROM (SELECT brand, min(department) AS department, category_normalized, coalesce(subcategory, '(none)') AS subcategory, time_bucket(INTERVAL 6 HOUR, recorded_at) AS window_start, count(DISTINCT product_id) AS skus_dropped FROM price_events WHERE direction = 'down' AND {_in('event_date', 90)} GROUP BY 1, 3, 4, 5) WHERE skus_dropped >= 2"),
    "l1_24_restock_density": twin(f"SELECT brand, min(department) AS department, category_normalized, coalesce(subcategory, '(none)') AS subcategory, color, event_date AS restock_date, count(*) AS variants_restocked, count(DISTINCT product_id) AS products_affected, event_date AS snapshot_date FROM stock_events WHERE witnessed AND event_type = 'restock' AND {_in('event_date', 90)} GROUP BY 1, 3, 4, 5, 6"),
}


SQL["r01_run_log"] = " UNION ALL ".join(f"SELECT '{name}' AS signal_id, 'ok' AS status, NULL AS reason, count(*) AS rows_written FROM ({SQL[query]})" for name, query in (("l1_01", "l1_01_genuine_price_drop"), ("l1_03", "l1_03_price_staircase"), ("l1_17", "l1_17_discount_depth_escalation"))) + """
    UNION ALL SELECT 'off', 'skipped', 'disabled', 0 UNION ALL SELECT 'waits', 'skipped', 'needs off', 0 UNION ALL SELECT 'broken', 'failed', 'no such source', 0
    UNION ALL SELECT 'long', 'skipped', count(DISTINCT CAST(ts AS DATE)) || ' of 400 days', 0 FROM events JOIN part ON user_id = p_partkey"""


def queries() -> dict:
    return {name: (lambda spark, sf_dir, f=f: f(Shop(spark, sf_dir))) for name, f in QUERIES.items()}

"""The model's frames as DuckDB common table expressions, for the SQL twins."""

import re

AS_OF = "DATE '2024-01-31'"


def r(x: str, places: int = 2) -> str:
    scale = 10**places
    return f"(floor(({x}) * {scale}::DOUBLE + 0.5) / {scale}::DOUBLE)"


def pct(part: str, whole: str, places: int = 2) -> str:
    return r(f"100::DOUBLE * ({part}) / nullif(({whole})::DOUBLE, 0)", places)


FRAMES = {
    "observations": f"""SELECT event_id, user_id AS product_id, ts AS recorded_at, CAST(ts AS DATE) AS snapshot_date, {r('1000 - value')} AS price,
        CASE WHEN event_id % 3 <> 0 THEN {r('(11 + event_id % 4) * (1000 - value) / 10')} END AS compare_at_price, event_type FROM events""",
    "catalogue": """SELECT p_partkey AS product_id, p_brand AS brand, p_name AS product_name, lower(p_type) AS category_normalized, split_part(p_name, ' ', 2) AS subcategory,
        CASE p_size % 3 WHEN 0 THEN 'men' WHEN 1 THEN 'women' ELSE 'unisex' END AS gender, CASE WHEN p_size <= 10 THEN 'kids' ELSE 'adults' END AS department, p_size FROM part""",
    "products": """SELECT c.*, first_observed_price, first_seen_at, last_seen_at FROM catalogue c JOIN (SELECT product_id, arg_min(price, (recorded_at, event_id)) AS first_observed_price,
        min(recorded_at) AS first_seen_at, max(recorded_at) AS last_seen_at FROM observations GROUP BY 1) f USING (product_id)""",
    "snapshots": f"""SELECT d.*, p.* EXCLUDE (product_id), CASE WHEN first_observed_price > 0 AND first_observed_price >= price THEN {r('100::DOUBLE * (first_observed_price - price) / first_observed_price')} END AS honest_discount_pct,
        CASE WHEN compare_at_price > 0 AND compare_at_price >= price THEN {r('100::DOUBLE * (compare_at_price - price) / compare_at_price')} END AS brand_claimed_discount_pct
        FROM (SELECT product_id, snapshot_date, arg_max_null(price, (recorded_at, event_id)) AS price, arg_min_null(compare_at_price, (recorded_at, event_id)) AS compare_at_price, max(recorded_at) AS recorded_at FROM observations GROUP BY 1, 2) d
        JOIN products p USING (product_id)""",
    "price_events": f"""SELECT event_id, product_id, brand, product_name, category_normalized, subcategory, gender, department, price_before, price AS price_after, compare_at_price, first_observed_price,
        CASE WHEN price > price_before THEN 'up' ELSE 'down' END AS direction,
        CASE WHEN first_observed_price > 0 AND price < first_observed_price THEN {r('100::DOUBLE * (first_observed_price - price) / first_observed_price')} END AS discount_pct, recorded_at, snapshot_date AS event_date, first_seen_at
        FROM (SELECT *, lag(price) OVER (PARTITION BY product_id ORDER BY recorded_at, event_id) AS price_before FROM observations) JOIN products USING (product_id) WHERE abs(price - price_before) > 0.01""",
    "stock_events": """SELECT event_id, product_id AS variant_id, product_id, brand, product_name, category_normalized, subcategory, gender, department, ['S', 'M', 'L', 'XL'][event_id % 4 + 1] AS size, split_part(product_name, ' ', 1) AS color,
        CASE o.event_type WHEN 'error' THEN 'stockout' WHEN 'signup' THEN 'restock' ELSE 'delisted' END AS event_type, price AS price_at_event, price < first_observed_price AS was_on_discount, recorded_at, snapshot_date AS event_date,
        CASE WHEN o.event_type <> 'view' THEN true END AS witnessed, first_seen_at FROM observations o JOIN products USING (product_id) WHERE o.event_type IN ('error', 'signup', 'view')""",
    "shelf": """SELECT c.*, first_seen, last_seen, last_price, first_observed_price FROM catalogue c JOIN (SELECT l_partkey AS product_id, CAST(min(l_shipdate) AS DATE) AS first_seen, CAST(max(l_shipdate) AS DATE) AS last_seen,
        arg_max(l_extendedprice, (l_shipdate, l_extendedprice, l_quantity)) AS last_price, max(l_extendedprice) AS first_observed_price FROM lineitem GROUP BY 1) USING (product_id)""",
}


def twin(body: str, **ctes: str) -> str:
    """A statement with the frames that its text needs, then its own expressions, then the body."""
    text, names = " ".join([*ctes.values(), body]), []
    for name in reversed(FRAMES):
        if re.search(rf"\b{name}\b", text):
            names.append(name)
            text += " " + FRAMES[name]
    parts = [f"{n} AS ({FRAMES[n]})" for n in FRAMES if n in names] + [f"{n} AS ({q})" for n, q in ctes.items()]
    return f"WITH {', '.join(parts)} {body}"

"""Order-board, title-attribute and further check queries over the shop tables, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwatch.functions import rule_tables as R
from stallwatch.operators import boards as B
from stallwatch.operators import market as M
from stallwatch.operators import order_board as O
from stallwatch.operators import quality as Q
from stallwatch.operators import signals as S
from stallwatch.operators import taxonomy as T
from stallwatch.plans.base_sql import AS_OF as D
from stallwatch.plans.base_sql import pct, r, twin
from stallwatch.plans.boards_catalog import _BYDEPTH, _GONE, _PRICE, _RANKS, _ranks
from stallwatch.plans.boards_catalog import SQL as BOARD
from stallwatch.plans.capture_catalog import _variants, _written
from stallwatch.plans.market_catalog import SQL as MARKET
from stallwatch.plans.products_catalog import Signals
from stallwatch.plans.quality_catalog import FAMILY_OF, _chain
from stallwatch.plans.signals_catalog import SQL as SIGNAL
from stallwatch.plans.signals_catalog import _in
from stallwatch.sources.day_files import depth
from stallwatch.sources.shop import AS_OF, CATALOGUE_AS_OF, Shop

#: Bounds that fit the size of the test tables.
CELLS, BANDS = ((5, 8, 5), (3, 4, 3)), ((6, 4), (3, 2))


def _prices(s: Shop) -> DataFrame:
    return B.latest_price(s.snapshots, AS_OF)


def _escalations(s: Shop) -> DataFrame:
    return Signals(s).escalations.join(s.catalogue.select("product_id", "subcategory"), "product_id")


def _avoid(s: Shop) -> DataFrame:
    return O.distress_products(_escalations(s), O.confidence_inputs(_prices(s), s.stock_events, AS_OF), 0.5, 3)


def _board(s: Shop) -> DataFrame:
    return O.order_board(s.stock_events, _prices(s), _ranks(s), _avoid(s), AS_OF, min_sellouts=5, min_products=1, cell_bounds=CELLS, band_bounds=BANDS)


def _launches(s: Shop) -> DataFrame:
    return O.launches_by_brand(s.shelf, CATALOGUE_AS_OF, 30, 0)


def _moves(s: Shop) -> DataFrame:
    return O.price_moves(s.price_events, AS_OF, min_changes=20)


def _stock_board(s: Shop) -> DataFrame:
    return B.stock_board(B.sellthrough_by_depth(_prices(s), s.stock_events, AS_OF, min_products=2))


def _titles(s: Shop) -> DataFrame:
    """Texts as titles, filed under a category and a brand's strategy by number; the source stands for the raw category."""
    kinds = F.array(*map(F.lit, KINDS))
    return s.dealt("documents", "doc_id", "text", "source").select("*", F.element_at(kinds, (F.col("doc_id") % len(KINDS) + 1).cast("int")).alias("kind"), F.element_at(F.array(*map(F.lit, STRATEGIES)), (F.floor(F.col("doc_id") / len(KINDS)) % 4 + 1).cast("int")).alias("strategy"))


KINDS = ["shirts", "jeans", "dresses", "jackets", "underwear", "swimwear", "bags"]
STRATEGIES = ["tail", "scan", "dash", "end"]


def _attributes(s: Shop) -> DataFrame:
    kind, text = F.col("kind"), F.col("text")
    top, bottom = T.underwear_style(kind, text)
    found = T.attributes(
        sleeve=T.sleeve_length(kind, text, F.col("source")), fit=T.fit_cut(kind, text, F.col("source")), length=T.dress_length(kind, text), silhouette=T.dress_silhouette(kind, text), jacket=T.jacket_type(kind, text),
        top_style=top, bottom_style=bottom, swimwear=T.swimwear_style(kind, text), bag=T.bag_type(kind, text),
    )
    return _titles(s).select("doc_id", F.to_json(found).alias("attributes"))


def _foreign(names: dict[str, str]) -> "F.Column":
    """A colour name of another language for each product, in upper case and with a blank; one in so many is unknown."""
    known = F.array(*map(F.lit, [*names, "Mystery"]))
    return F.concat(F.lit(" "), F.upper(F.element_at(known, (F.col("product_id") % F.size(known) + 1).cast("int"))))


QUERIES = {
    "i13_size_skew": lambda s: O.size_skew(Signals(s).asymmetry),
    "i13_clearance_wave": lambda s: O.clearance_wave(Signals(s).bursts),
    "i16_launch_dominance": lambda s: O.launch_dominance(M.share_of_launch(s.shelf, CATALOGUE_AS_OF)),
    "i16_earliest_movers": lambda s: O.earliest_movers(M.first_mover(s.price_events, AS_OF)),
    "i16_fake_discount_flags": lambda s: O.fake_discount_flags(M.discount_honesty(s.price_events, AS_OF)),
    "i26_brand_stockouts": lambda s: O.brand_stockouts(s.stock_events, AS_OF),
    "i27_confidence_inputs": lambda s: O.confidence_inputs(_prices(s), s.stock_events, AS_OF, bounds=CELLS),
    "i28_brand_prices": lambda s: O.brand_prices(_prices(s), 0),
    "i31_launches_by_brand": _launches,
    "i32_price_moves_by_brand": _moves,
    "i35_distress": lambda s: O.distress(_escalations(s), 0),
    "i36_distress_products": _avoid,
    "i37_order_board": _board,
    "i38_supply_gaps": lambda s: O.supply_gaps(_board(s)),
    "i44_conflicts": lambda s: O.cross_conflicts(_board(s), _stock_board(s)),
    "i45_weekly_diff": lambda s: O.weekly_diff(_launches(s), _moves(s), B.market_temperature(s.stock_events, AS_OF), 3, 10, 5.0),
    "d03_breadcrumb_category": lambda s: s.dealt("documents", "doc_id", "lang", "source", "text").select("doc_id", T.breadcrumb_category(F.col("lang"), F.col("source"), F.col("text")).alias("category")),
    "d10_stamp_colors": lambda s: T.stamp_colors(s.catalogue.select("product_id", F.col("product_name").alias("color"), F.lit(None).cast("string").alias("color_family"), F.lit(None).cast("string").alias("color_shade")), T.seed_colors(s.catalogue.select(F.col("product_name").alias("color")), s.spark.createDataFrame([], "color_raw string"))).select("product_id", "color_family", "color_shade"),
    "d12_translate_color": lambda s: s.catalogue.select("product_id", *[T.translate_color(_foreign(names), language).alias(language) for language, names in (("ar", R.ARABIC_COLORS), ("tr", R.TURKISH_COLORS))]),
    "d13_color_from_title": lambda s: _titles(s).select("doc_id", T.color_from_title(F.col("strategy"), F.col("text")).alias("color")),
    "d22_attributes": _attributes,
    "d23_true_shirts": lambda s: T.true_shirts(s.table("documents").select("doc_id", F.lit("shirts").alias("category_normalized"), F.col("text").alias("product_name"))).select("doc_id"),
    "j03_discount_capture": lambda s: Q.discount_capture(s.snapshots.withColumn("compare_at_price", F.when(F.col("gender") == "men", F.col("compare_at_price"))), s.price_events, AS_OF, min_rows=20),
    "j04_signal_freshness": lambda s: Q.signal_freshness({"l1_01": (Signals(s).drops, "snapshot_date", 3), "l1_13": (Signals(s).delists, "snapshot_date", 22), "l1_24": (Signals(s).density, "snapshot_date", 3)}, s.table("events").select(F.lit("l1_13").alias("signal_id"), F.to_date("ts").alias("run_date"), F.lit("ok").alias("status")), AS_OF),
    "j05_bestseller_feed": lambda s: Q.bestseller_feed(_ranks(s), AS_OF),
    "j12_substrate": lambda s: Q.substrate(s.shelf.withColumn("is_active", F.col("last_seen") >= F.lit("2001-06-01").cast("date")), _variants(s)[0], s.snapshots),
    "j13_cold_depth": lambda s: depth(s.spark, {name: (_written(s, name, rows.select("product_id", day), day), day) for name, rows, day in (("price_snapshots", s.snapshots, "snapshot_date"), ("price_events", s.price_events, "event_date"), ("stockout_events", s.stock_events, "event_date"))}),
}


def _share(p: str, n: str) -> str:
    return f"greatest(0.5::DOUBLE / {n}, least(1 - 0.5::DOUBLE / {n}, {p}))"


def _ci(q: str, n: str) -> str:
    return f"CASE WHEN {n} < 2 THEN 0::DOUBLE ELSE {r(f'196::DOUBLE * sqrt({q} * (1 - {q}) / {n})', 1)} END"


_CELL = "category_normalized, subcategory"
_LEVEL = "CASE WHEN brands >= {} AND products >= {} AND with_sellout >= {} THEN 'hi' WHEN brands >= {} AND products >= {} AND with_sellout >= {} THEN 'md' ELSE 'lo' END AS level"
_INPUTS = f"SELECT {_CELL}, count(DISTINCT brand) AS brands, count(*) AS products, count(hit) AS with_sellout FROM prices LEFT JOIN gone USING (product_id) GROUP BY 1, 2"
_ESC = f"SELECT e.*, c.subcategory FROM ({SIGNAL['l1_17_discount_depth_escalation']}) e JOIN (SELECT p_partkey AS product_id, split_part(p_name, ' ', 2) AS subcategory FROM part) c USING (product_id)"
_AVOID = f"SELECT {_CELL}, escalating_products, products, {pct('escalating_products', 'products', 1)} AS share_pct FROM (SELECT {_CELL}, count(DISTINCT product_id) AS escalating_products FROM esc GROUP BY 1, 2) JOIN inputs USING ({_CELL}) WHERE escalating_products >= 0.5::DOUBLE * products AND escalating_products >= 3 ORDER BY share_pct DESC, 1, 2 LIMIT 8"
_BANDED = f"""SELECT {_CELL}, CASE WHEN price >= 1000 THEN '1000+' WHEN price >= 700 THEN '700-999' WHEN price >= 500 THEN '500-699' WHEN price >= 300 THEN '300-499' ELSE 'under 300' END AS band, count(*) AS n, count(hit) AS sold FROM prices LEFT JOIN gone USING (product_id) GROUP BY 1, 2, 3 HAVING count(*) > 1"""
_BEST = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_CELL} ORDER BY backed DESC, rate DESC, n DESC, band DESC) AS k FROM (SELECT *, {pct('sold', 'n', 1)} AS rate, v > 0 AND sold >= 0.2::DOUBLE * v AS backed FROM (SELECT *, sum(sold) OVER (PARTITION BY {_CELL}) AS v FROM banded))) WHERE k = 1"""
_LISTED = f"""SELECT a.*, {r('100::DOUBLE * (n_last - n_first) / n_first', 0)} AS trend FROM (SELECT {_CELL}, {r('sum(weeks)::DOUBLE / count(*)', 1)} AS avg_weeks FROM ranks JOIN (SELECT product_id, count(DISTINCT date_trunc('week', snapshot_date)) AS weeks FROM ranks GROUP BY 1) USING (product_id) GROUP BY 1, 2) a
    JOIN (SELECT {_CELL}, arg_min(n, week) AS n_first, arg_max(n, week) AS n_last FROM (SELECT {_CELL}, date_trunc('week', snapshot_date) AS week, count(DISTINCT product_id) AS n FROM ranks GROUP BY 1, 2, 3) GROUP BY 1, 2) USING ({_CELL})"""
_JOINED = f"""SELECT {_CELL}, sellouts, restocks, {r('sellouts / greatest(restocks, 1)::DOUBLE', 1)} AS gap_ratio, coalesce(i.brands, 0) AS brands, coalesce(i.products, 0) AS products, coalesce(i.level, 'lo') AS level, b.band AS best_band, coalesce(b.rate, 0::DOUBLE) AS best_rate, coalesce(b.n, 0) AS best_n, coalesce(b.sold, 0) AS best_sold, coalesce(b.backed, false) AS backed,
    coalesce(l.avg_weeks, 0::DOUBLE) AS avg_weeks, coalesce(l.trend, 0::DOUBLE) AS trend_pct, x.share_pct IS NOT NULL AS in_distress
    FROM (SELECT {_CELL}, count(*) FILTER (event_type = 'stockout') AS sellouts, count(*) FILTER (event_type = 'restock') AS restocks FROM stock_events WHERE witnessed AND {_in('event_date', 21)} GROUP BY 1, 2) t
    LEFT JOIN (SELECT *, {_LEVEL.format(*CELLS[0], *CELLS[1])} FROM inputs) i USING ({_CELL}) LEFT JOIN ({_BEST}) b USING ({_CELL}) LEFT JOIN ({_LISTED}) l USING ({_CELL}) LEFT JOIN avoid x USING ({_CELL}) WHERE sellouts > 5"""
_SURE = f"""least(CASE level WHEN 'hi' THEN 2 WHEN 'md' THEN 1 ELSE 0 END, CASE WHEN best_n >= {BANDS[0][0]} AND best_sold >= {BANDS[0][1]} THEN 2 WHEN best_n >= {BANDS[1][0]} AND best_sold >= {BANDS[1][1]} THEN 1 ELSE 0 END, CASE WHEN backed THEN 2 ELSE 1 END)"""
_ORDERS = f"""SELECT * EXCLUDE (level, best_sold), CASE WHEN in_distress OR best_rate < 15 THEN 'avoid' WHEN confidence <> 'lo' AND best_rate >= 20 AND avg_weeks >= 6.5::DOUBLE AND gap_ratio >= 2 THEN 'go' WHEN confidence <> 'lo' AND avg_weeks >= 5 AND trend_pct >= -10 AND gap_ratio >= 1.5::DOUBLE THEN 'buy' WHEN confidence <> 'lo' AND avg_weeks >= 4 AND gap_ratio >= 1.2::DOUBLE THEN 'buy' ELSE 'watch' END AS verdict
    FROM (SELECT *, {_ci(_share('best_rate / 100::DOUBLE', 'greatest(best_n, 1)'), 'greatest(best_n, 1)')} AS best_ci, CASE {_SURE} WHEN 2 THEN 'hi' WHEN 1 THEN 'md' ELSE 'lo' END AS confidence FROM joined)"""
_PARTS = {"prices": _PRICE, "gone": _GONE, "inputs": _INPUTS, "esc": _ESC, "avoid": _AVOID, "ranks": _RANKS, "banded": _BANDED, "joined": _JOINED, "orders_now": _ORDERS}
_LAUNCH = "SELECT brand, count(*) FILTER (now) AS this_week, count(*) FILTER (NOT now) AS last_week FROM (SELECT *, first_seen > DATE '1995-06-30' - 30 AS now FROM shelf WHERE first_seen > DATE '1995-06-30' - 60 AND first_seen <= DATE '1995-06-30') GROUP BY 1"
_MOVE = f"SELECT brand, category_normalized, count(*) AS changes, count(*) FILTER (direction = 'up') AS increases, count(*) FILTER (direction = 'down') AS decreases, {r('''avg(CASE WHEN direction = 'down' THEN 100::DOUBLE * (1 - price_after / price_before) END)''', 1)} AS avg_cut_pct FROM price_events WHERE {_in('event_date', 7)} GROUP BY 1, 2 HAVING count(*) > 20"


def _longest(text: str, phrases: dict[str, list[str]], spaced: bool = False) -> str:
    ordered = [(p.replace("-", " ") if spaced else p, label) for p, label in T.by_length(phrases)]
    return _chain(text, [([p], label) for p, label in ordered], "").replace("ELSE ''", "ELSE NULL")


def _colors(text: str, without: tuple[str, ...] = ()) -> str:
    names = [c for c in sorted(R.TITLE_COLORS, key=lambda x: -len(x)) if c not in without]
    return "CASE " + " ".join(f"WHEN contains({text}, '{c}') AND regexp_matches({text}, '(^|[^a-z]){c}([^a-z]|$)') THEN '{c}'" for c in names) + " END"


def _not_metal(text: str) -> str:
    metals = ", ".join(f"'{m}'" for m in R.METALS)
    return f"CASE WHEN ({_colors(text)}) IN ({metals}) AND contains(low, 'buckle') THEN {_colors(text, tuple(R.METALS))} ELSE {_colors(text)} END"


def _any(text: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


_ENDS = "CASE " + " ".join(f"WHEN whole = '{c}' OR ends_with(whole, ' {c}') OR ends_with(whole, '-{c}') THEN '{c}'" for c in sorted(R.TITLE_COLORS, key=lambda x: -len(x))) + " END"
_LIST = ", ".join(f"'{k}'" for k in KINDS)
_ATTRIBUTES = {
    "sleeve": f"CASE WHEN kind = 'shirts' THEN coalesce({_longest('low', R.SLEEVES)}, {_longest('lower(source)', R.SLEEVES)}) END",
    "fit": f"CASE WHEN kind = 'jeans' THEN coalesce({_longest('spaced', R.CUTS, True)}, {_longest('lower(source)', R.CUTS, True)}) END",
    "length": f"CASE WHEN kind = 'dresses' THEN {_longest('low', R.DRESS_LENGTHS)} END", "silhouette": f"CASE WHEN kind = 'dresses' THEN {_longest('low', R.DRESS_SHAPES)} END", "jacket": f"CASE WHEN kind = 'jackets' THEN {_longest('low', R.JACKETS)} END",
    "top_style": f"CASE WHEN kind = 'underwear' AND {_any('low', R.TOP_HINTS)} AND NOT {_any('low', R.BOTTOM_HINTS)} THEN {_longest('low', R.TOP_STYLES)} END",
    "bottom_style": f"CASE WHEN kind = 'underwear' AND {_any('low', R.BOTTOM_HINTS)} AND NOT {_any('low', R.TOP_HINTS)} THEN {_longest('low', R.BOTTOM_STYLES)} END",
    "swimwear": f"CASE WHEN kind = 'swimwear' THEN {_longest('low', R.SWIMWEAR)} END", "bag": f"CASE WHEN kind = 'bags' THEN {_longest('low', R.BAGS)} END",
}
_CATEGORY = {c: _chain(f"lower(coalesce({c}, ''))", [(w, n) for n, w in R.CATEGORIES.items()], "uncategorized") for c in ("lang", "source", "text")}
_COLOR_RAW = "lower(trim(product_name))"
# English names of the Arabic and Turkish colours in the order of the rule tables, written out, and of an unknown one.
_ARABIC = """string_split('black,black,white,white,off-white,off-white,grey,grey,grey,red,red,blue,blue,light blue,sky blue,petrol,navy,navy,green,green,olive,olive,yellow,yellow,pink,pink,rose,pink,purple,mauve,mauve,lilac,lavender,orange,apricot,brown,camel,camel,tan,taupe,beige,cream,cream,gold,gold,silver,silver,copper,turquoise,teal,burgundy,burgundy,burgundy,burgundy,maroon,khaki,khaki,fuchsia,coral,coral,mint,mint,multicolor,multicolor,printed,floral,mystery', ',')"""
_TURKISH = "string_split('black,white,grey,anthracite,red,burgundy,pink,fuchsia,coral,orange,yellow,ecru,beige,brown,khaki,green,petrol,turquoise,blue,navy,indigo,purple,plum,lilac,multicolor,mystery', ',')"

SQL = {
    "i13_size_skew": f"SELECT stocked_out_size, count(*) AS cases FROM ({SIGNAL['l1_11_size_asymmetry']}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3",
    "i13_clearance_wave": f"SELECT brand, category_normalized, subcategory, window_start, skus_dropped FROM ({SIGNAL['l1_22_discount_velocity']}) ORDER BY skus_dropped DESC, 1, 2, 3, 4 LIMIT 1",
    "i16_launch_dominance": f"SELECT category_normalized, brand, share_pct, launch_read FROM ({MARKET['l2_share_of_launch']}) ORDER BY share_pct DESC, 1, 2 LIMIT 5",
    "i16_earliest_movers": f"SELECT category_normalized, brand, avg_days_after_category_first, mover_read FROM ({MARKET['l2_first_mover']}) ORDER BY 3, 1, 2 LIMIT 5",
    "i16_fake_discount_flags": f"SELECT brand, category_normalized, avg_claimed_depth_pct, avg_genuine_depth_pct, manufactured_gap_pct FROM ({MARKET['l2_discount_honesty']}) WHERE manufactured_gap_pct > 5 ORDER BY 5 DESC, 1, 2 LIMIT 5",
    "i26_brand_stockouts": twin(f"SELECT {_CELL}, brand, count(*) AS stockouts FROM stock_events WHERE witnessed AND event_type = 'stockout' AND {_in('event_date', 21)} GROUP BY 1, 2, 3"),
    "i27_confidence_inputs": twin(f"SELECT *, {_LEVEL.format(*CELLS[0], *CELLS[1])}, {_ci(_share('(with_sellout / products::DOUBLE)', 'products'), 'products')} AS ci, {_ci('(with_sellout / products::DOUBLE)', 'products')} AS ci_unclamped FROM inputs", prices=_PRICE, gone=_GONE, inputs=_INPUTS),
    "i28_brand_prices": twin(f"SELECT {_CELL}, brand, count(*) AS products, {r('quantile_cont(price, 0.5)')} AS median_price FROM prices GROUP BY 1, 2, 3", prices=_PRICE),
    "i31_launches_by_brand": twin(_LAUNCH),
    "i32_price_moves_by_brand": twin(_MOVE),
    "i35_distress": twin(f"SELECT {_CELL}, brand, count(*) AS escalating, (2 * sum(CAST(round(last_depth_pct * 1000000) AS BIGINT)) + 100000 * count(last_depth_pct)) // (200000 * count(last_depth_pct)) / 10::DOUBLE AS avg_depth FROM esc GROUP BY 1, 2, 3", esc=_ESC),
    "i36_distress_products": twin("SELECT * FROM avoid", prices=_PRICE, gone=_GONE, inputs=_INPUTS, esc=_ESC, avoid=_AVOID),
    "i37_order_board": twin("SELECT * FROM orders_now", **_PARTS),
    "i38_supply_gaps": twin(f"SELECT {_CELL}, sellouts, restocks, gap_ratio, CASE WHEN gap_ratio >= 2 THEN 'OPEN' ELSE 'NARROWING' END AS gap FROM orders_now WHERE verdict <> 'avoid' AND gap_ratio >= 1.2::DOUBLE", **_PARTS),
    "i44_conflicts": twin(f"SELECT {_CELL}, verdict FROM orders_now WHERE verdict IN ('go', 'buy') AND category_normalized IN (SELECT category_normalized FROM ({BOARD['i43_stock_board']}) WHERE verdict = 'stop')", **_PARTS),
    "i45_weekly_diff": twin(f"""SELECT * FROM (SELECT CASE WHEN this_week >= 3 AND last_week = 0 THEN 'launches_back' WHEN this_week >= 3 AND this_week >= 2 * last_week THEN 'launches_up' WHEN last_week >= 3 AND this_week <= 0.4::DOUBLE * last_week THEN 'launches_down' END AS kind, brand, NULL::VARCHAR AS category_normalized, this_week::DOUBLE AS now, last_week::DOUBLE AS before FROM ({_LAUNCH})
        UNION ALL SELECT CASE WHEN increases >= 0.9::DOUBLE * changes AND increases >= 10 THEN 'prices_up' WHEN decreases >= 0.9::DOUBLE * changes AND decreases >= 10 THEN 'prices_down' END, brand, category_normalized, increases::DOUBLE, decreases::DOUBLE FROM ({_MOVE})
        UNION ALL SELECT CASE WHEN 100 * (n - b) / b > 5 THEN 'market_heating' WHEN 100 * (n - b) / b < -5 THEN 'market_cooling' END, NULL, NULL, n, b FROM (SELECT arg_max(ratio, week_start) AS n, arg_min(ratio, week_start) AS b FROM ({BOARD['i42_market_temperature']}))) WHERE kind IS NOT NULL"""),
    "d03_breadcrumb_category": f"SELECT doc_id, CASE WHEN s <> 'uncategorized' THEN s WHEN t <> 'uncategorized' THEN t ELSE l END AS category FROM (SELECT doc_id, {_CATEGORY['source']} AS s, {_CATEGORY['text']} AS t, {_CATEGORY['lang']} AS l FROM documents)",
    "d10_stamp_colors": twin(f"SELECT product_id, family AS color_family, CASE WHEN family IS NOT NULL THEN raw END AS color_shade FROM (SELECT product_id, raw, {FAMILY_OF.format('raw')} AS family FROM (SELECT product_id, {_COLOR_RAW} AS raw FROM catalogue))"),
    "d12_translate_color": twin(f"SELECT product_id, {_ARABIC}[product_id % 67 + 1] AS ar, {_TURKISH}[product_id % 26 + 1] AS tr FROM catalogue"),
    "d13_color_from_title": f"""SELECT doc_id, CASE strategy WHEN 'tail' THEN coalesce(CASE WHEN tail IN ({', '.join(f"'{c}'" for c in R.TITLE_COLORS)}) THEN tail END, {_colors('low')}) WHEN 'scan' THEN {_not_metal('cloth')} WHEN 'dash' THEN CASE WHEN contains(low, ' - ') AND length(dash) BETWEEN 1 AND 30 THEN dash END ELSE coalesce({_ENDS}, {_not_metal('low')}) END AS color
        FROM (SELECT *, trim(regexp_extract(low, '[-–—|]([^-–—|]*)\\z', 1)) AS tail, regexp_replace(regexp_replace(low, '\\b(raw\\s+)?denim\\b', ' ', 'g'), '\\bice\\b', ' ', 'g') AS cloth, trim(string_split(low, ' - ')[-1]) AS dash, trim(low) AS whole
        FROM (SELECT doc_id, lower(text) AS low, ['tail', 'scan', 'dash', 'end'][doc_id // {len(KINDS)} % 4 + 1] AS strategy FROM documents))""",
    "d22_attributes": f"""SELECT doc_id, '{{' || concat_ws(',', {', '.join(f"'\"{name}\":\"' || ({sql}) || '\"'" for name, sql in _ATTRIBUTES.items())}) || '}}' AS attributes
        FROM (SELECT *, trim(regexp_replace(low, '[^a-z0-9]+', ' ', 'g')) AS spaced FROM (SELECT doc_id, source, lower(text) AS low, [{_LIST}][doc_id % {len(KINDS)} + 1] AS kind FROM documents))""",
    "d23_true_shirts": "SELECT doc_id FROM documents WHERE NOT coalesce(regexp_matches(lower(text), 'sweatshirt|hoodie|hoody'), false)",
    "j03_discount_capture": twin(f"""SELECT brand, n_rows, discounted, days, moved, CASE WHEN discounted = 0 AND days >= 5 AND moved >= 10 THEN 'INFO' WHEN discounted = 0 AND days >= 5 THEN 'FAIL' ELSE 'OK' END AS status FROM (SELECT *, coalesce(m, 0) AS moved FROM (SELECT brand, count(*) AS n_rows, count(*) FILTER (gender = 'men' AND compare_at_price > 1.01::DOUBLE * price) AS discounted, count(DISTINCT snapshot_date) AS days FROM snapshots WHERE {_in('snapshot_date', 7)} GROUP BY 1 HAVING count(*) > 20)
        LEFT JOIN (SELECT brand, count(DISTINCT product_id) AS m FROM price_events WHERE {_in('event_date', 30)} GROUP BY 1) USING (brand))"""),
    "j04_signal_freshness": "SELECT *, CASE WHEN n_rows = 0 THEN 'WARN' WHEN days_old >= day_limit AND NOT coalesce(" + D + " - last_ok <= day_limit, false) THEN 'FAIL' ELSE 'OK' END AS status FROM (SELECT *, CAST(" + D + " - last_day AS INTEGER) AS days_old FROM (" + " UNION ALL ".join(f"SELECT '{name}' AS signal_id, max(snapshot_date) AS last_day, count(*) AS n_rows, {limit} AS day_limit FROM ({SIGNAL[query]})" for name, query, limit in (("l1_01", "l1_01_genuine_price_drop", 3), ("l1_13", "l1_13_product_delisted", 22), ("l1_24", "l1_24_restock_density", 3))) + ") LEFT JOIN (SELECT 'l1_13' AS signal_id, max(CAST(ts AS DATE)) AS last_ok FROM events) USING (signal_id))",
    "j05_bestseller_feed": twin(f"SELECT *, CASE WHEN brands < 0.5::DOUBLE * typical THEN 'FAIL' ELSE 'OK' END AS status FROM (SELECT count(DISTINCT brand) FILTER (snapshot_date >= {D} - 2) AS brands, (SELECT quantile_cont(n, 0.5) FROM (SELECT snapshot_date, count(DISTINCT brand) AS n FROM ranks WHERE snapshot_date >= {D} - 21 AND snapshot_date <= {D} GROUP BY 1)) AS typical FROM ranks WHERE snapshot_date <= {D})", ranks=_RANKS),
    "j12_substrate": twin(f"""SELECT 'products' AS measure, count(*)::DOUBLE AS value FROM shelf UNION ALL SELECT 'active_brands', count(DISTINCT brand) FILTER (last_seen >= DATE '2001-06-01') FROM shelf UNION ALL SELECT 'variants', count(*) FROM v UNION ALL SELECT 'delisted_in_stock', count(*) FILTER (last_ship < DATE '1995-06-01' AND flag <> 'R') FROM v UNION ALL SELECT 'missing_baseline', count(*) FILTER (base IS NULL) FROM v
        UNION ALL SELECT 'baseline_coverage_pct', {pct('count(base)', 'count(*)')} FROM v UNION ALL SELECT 'snapshots', count(*) FROM snapshots UNION ALL SELECT 'snapshot_brands', count(DISTINCT brand) FROM snapshots UNION ALL SELECT 'bad_prices', count(*) FILTER (price <= 0) FROM snapshots""",
        v="SELECT l_partkey, l_suppkey, max(CAST(l_shipdate AS DATE)) AS last_ship, arg_max(l_returnflag, (l_shipdate, l_extendedprice, l_quantity, l_returnflag)) AS flag, min(l_extendedprice) AS base FROM lineitem GROUP BY 1, 2"),
    "j13_cold_depth": twin(" UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(DISTINCT {c}) AS days, min({c}) AS earliest, max({c}) AS latest FROM {f}" for t, f, c in (("price_snapshots", "snapshots", "snapshot_date"), ("price_events", "price_events", "event_date"), ("stockout_events", "stock_events", "event_date")))),
}


def queries() -> dict:
    return {name: (lambda spark, sf_dir, f=f: f(Shop(spark, sf_dir))) for name, f in QUERIES.items()}

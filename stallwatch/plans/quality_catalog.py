"""Taxonomy and data-quality queries over the shop tables, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallwatch.functions import rule_tables as R
from stallwatch.functions.columns import round_to
from stallwatch.operators import quality as Q
from stallwatch.operators import taxonomy as T
from stallwatch.operators.lake import union_all
from stallwatch.plans.base_sql import AS_OF as D
from stallwatch.plans.base_sql import pct, r, twin
from stallwatch.sources.shop import AS_OF, Shop

#: Sizes as they come, made from part sizes: letters, numbers, ranges, ages, codes.
_RAW_SIZE = "CASE p_size % 8 WHEN 0 THEN 'xl' WHEN 1 THEN CAST(p_size AS {s}) WHEN 2 THEN 'N00' || CAST(p_size % 10 AS {s}) WHEN 3 THEN CAST(p_size AS {s}) || ' Y' WHEN 4 THEN '8-9' WHEN 5 THEN 'navy' WHEN 6 THEN '18 INCH' ELSE 'S-M' END"


def _sized(s: Shop):
    low = F.coalesce(T.subcategory(F.lit("jeans"), F.col("product_name")), F.lit("none"))
    category = F.when(F.col("p_size") % 3 == 0, "jeans").when(F.col("p_size") % 3 == 1, "dresses").otherwise("bags")
    return s.catalogue.select("product_id", "brand", category.alias("category_normalized"), F.expr(_RAW_SIZE.format(s="STRING")).alias("size"), low.alias("cut"))


def _lots(s: Shop):
    """Variants by part and supplier; when they were first and last shipped stands in for when they were delisted and last written."""
    first, last = F.to_date(F.min("l_shipdate")), F.to_date(F.max("l_shipdate"))
    base = F.min(F.when(F.col("l_quantity") > 10, F.col("l_extendedprice")))
    return s.table("lineitem").groupBy("l_suppkey", F.col("l_partkey").alias("product_id")).agg(base.alias("first_observed_price"), F.when(first < "1997-01-01", F.date_add(first, 365)).alias("delisted_at"), last.alias("last_updated_at"))


def _health(s: Shop):
    """Three tables against the runs of their signals: one failed, one was skipped, one has none."""
    runs = s.table("events").where("event_type in ('error', 'signup')").select(F.when(F.col("event_type") == "error", "snapshots").otherwise("stock_events").alias("signal_id"), F.when(F.col("event_type") == "error", "error").otherwise("skipped").alias("status"), (F.col("event_id") % 3).alias("rows_written"), F.col("ts").alias("run_at"))
    orphaned = s.stock_events.withColumn("brand", F.when(F.col("event_id") % 10 > 0, F.col("brand")))
    parts = [
        Q.table_health("snapshots", s.snapshots, "snapshot_date", AS_OF, ["compare_at_price", "honest_discount_pct"], 25, runs), Q.table_health("price_events", s.price_events, "event_date", "2024-02-02", ["discount_pct", "compare_at_price"], 100, runs),
        Q.table_health("stock_events", orphaned.withColumn("spare", F.when(F.col("price_at_event") < 0, 1)), "event_date", "2024-02-09", ["price_at_event", "spare"], None, runs), Q.table_health("delisted", orphaned.where("event_type = 'delisted'"), "event_date", AS_OF, ["price_at_event"], 25, runs),
    ]
    return union_all(parts)


def _rebased(s: Shop):
    return s.products.withColumn("first_observed_price", F.when(F.col("p_size") % 6 == 0, round_to(F.col("first_observed_price") * 1.1)).when(F.col("p_size") % 6 == 1, round_to(F.col("first_observed_price") * 0.9)).otherwise(F.col("first_observed_price")))


def _titled(s: Shop):
    """Titles of several categories, words of subcategories among them in every case form."""
    kinds = F.array(*map(F.lit, ("t-shirts", "shirts", "trousers", "jeans", "shorts", "dresses", "skirts", "sweaters", "hoodies", "bags")))
    words = F.array(*map(F.lit, ("Long-Sleeve", "FLANNEL", "cargo wide leg", "Mom fit", "denim", "Maxi", "minimal midi", "turtle neck", "zip")))
    at = lambda values, n: F.element_at(values, (F.col("product_id") % n + 1).cast("int"))
    return s.catalogue.select("product_id", at(kinds, 10).alias("category"), F.concat_ws(" ", "product_name", at(words, 9)).alias("title"))


def _shelved(s: Shop):
    """Products with a known subcategory or none, active or not, in categories written in several ways."""
    kinds = F.array(*map(F.lit, ("T-Shirts ", " jeans", "Dresses", "sweaters", "HOODIES", "bags")))
    words = F.array(*map(F.lit, ("print basic", "Mom flare", "MAXI", "zip", "wide mom", "v neck zip", "Long Sleeve", "Mom fit")))
    size, name = F.col("p_size"), F.element_at(words, (F.col("product_id") % 8 + 1).cast("int"))
    kind = F.element_at(kinds, (F.floor(F.col("product_id") / 8) % 6 + 1).cast("int"))
    known = F.when(size % 11 == 0, F.lit("known"))
    return s.catalogue.select("product_id", kind.alias("category_normalized"), F.concat_ws(" ", "product_name", name).alias("product_name"), known.alias("subcategory"), (size % 3 > 0).alias("is_active"))


QUERIES = {
    "d01_normalize_category": lambda s: s.dealt("documents", "doc_id", "text", "source").select("doc_id", T.normalize_category(F.col("text")).alias("category"), T.normalize_gender(F.col("text"), F.col("source"), ("src1", "src2")).alias("gender")),
    "d03_breadcrumb_gender": lambda s: s.catalogue.select("product_id", T.breadcrumb_gender(F.element_at(F.array(*map(F.lit, (" Man", "WOMAN", "children", "home", None))), (F.col("p_size") % 5 + 1).cast("int")), F.col("gender")).alias("gender")),
    "d04_rescue_category": lambda s: s.table("documents").select("doc_id", T.rescue_category(F.lit("uncategorized"), F.col("text"), F.col("source")).alias("category")),
    "d05_subcategory": lambda s: s.catalogue.select("product_id", T.subcategory(F.lit("jeans"), F.concat_ws(" ", "product_name", F.when(F.col("p_size") % 2 == 0, F.lit("Slim fit")).otherwise(F.lit("boot-cut"))), F.when(F.col("p_size") % 7 == 0, F.lit("known"))).alias("subcategory")),
    "d05_subcategories": lambda s: _titled(s).select("product_id", "category", T.subcategory(F.col("category"), F.col("title")).alias("subcategory")),
    "d05_fill_subcategories": lambda s: T.fill_subcategories(_shelved(s)).select("product_id", "is_active", "subcategory"),
    "d06_subcategory_progress": lambda s: T.subcategory_progress(s.catalogue.withColumn("subcategory", F.when(F.col("p_size") > 20, F.col("subcategory")))),
    "d07_classify_size": lambda s: T.apply_sizes(_sized(s).drop("cut"))[0],
    "d08_size_review_queue": lambda s: T.apply_sizes(_sized(s).drop("cut"))[1],
    "d09_seed_colors": lambda s: T.seed_colors(s.catalogue.select(F.col("product_name").alias("color")), s.spark.createDataFrame([("small ring",)], "color_raw string")),
    "d11_canonical_color": lambda s: s.dealt("documents", "doc_id", "text").select("doc_id", T.canonical_color(F.col("text")).alias("color")),
    "d24_drop_excluded": lambda s: T.drop_excluded(s.catalogue, s.spark.createDataFrame([("Brand#11", "all"), ("Brand#12", "stock")], "brand string, scope string"), "stock").select("product_id", "brand", "p_size"),
    "j01_freshness": lambda s: Q.freshness(s.stock_events, "event_date", AS_OF),
    "j02_volume_drop": lambda s: Q.volume_drop(s.snapshots, AS_OF),
    "j06_unclassified_events": lambda s: Q.unclassified_events(s.stock_events, AS_OF),
    "j07_integrity": lambda s: Q.integrity(s.snapshots, s.products.where("p_size > 5"), _lots(s)),
    "j08_event_liveness": lambda s: Q.event_liveness(s.price_events, AS_OF),
    "j09_frozen_prices": lambda s: Q.frozen_prices(s.snapshots, s.price_events, AS_OF, min_products=2, min_days=2),
    "j10_table_health": _health,
    "j14_baseline_immutability": lambda s: Q.baseline_immutability(s.snapshots, _rebased(s)),
    "j14_baseline_mismatches": lambda s: Q.baseline_mismatches(s.snapshots, _rebased(s)),
}


def _chain(text: str, rules: list[tuple[list[str], str]], default: str) -> str:
    whens = " ".join("WHEN " + " OR ".join(f"contains({text}, '{w}')" for w in words) + f" THEN '{name}'" for words, name in rules)
    return f"CASE {whens} ELSE '{default}' END"


_SIZES = f"SELECT product_id, brand, CASE p_size % 3 WHEN 0 THEN 'jeans' WHEN 1 THEN 'dresses' ELSE 'bags' END AS category_normalized, {_RAW_SIZE.format(s='VARCHAR')} AS size, p_size FROM catalogue"
_EU = ", ".join(f"'{k}': '{v}'" for k, v in R.EU_LETTERS.items())
_CLASSED = f"""SELECT *, CASE WHEN p_size % 8 = 0 THEN 'XL' WHEN p_size % 8 = 3 THEN replace(upper(size), ' ', '') WHEN p_size % 8 = 1 AND category_normalized = 'jeans' AND p_size BETWEEN 20 AND 60 THEN size WHEN p_size % 8 = 1 AND category_normalized = 'dresses' THEN MAP {{{_EU}}}[size] END AS size_family,
    CASE WHEN p_size % 8 = 0 THEN 'letter' WHEN p_size % 8 = 3 THEN 'kids_age' WHEN p_size % 8 = 1 AND category_normalized = 'jeans' AND p_size BETWEEN 20 AND 60 THEN 'waist_numeric' WHEN p_size % 8 = 1 AND category_normalized = 'dresses' AND MAP {{{_EU}}}[size] IS NOT NULL THEN 'eu_numeric' END AS size_system,
    CASE p_size % 8 WHEN 4 THEN 'bare_numeric_range_unclear_domain' WHEN 7 THEN 'dual_letter_range' WHEN 1 THEN CASE WHEN category_normalized = 'jeans' AND p_size BETWEEN 20 AND 60 THEN NULL WHEN category_normalized = 'dresses' THEN CASE WHEN MAP {{{_EU}}}[size] IS NULL THEN 'numeric_outside_eu_ladder_possible_kids' END ELSE 'unrecognized_pattern' END END AS reason FROM sized"""
_STATUS = "CASE WHEN size_family IS NOT NULL THEN 'classified' WHEN reason IS NOT NULL THEN 'review' ELSE 'excluded' END AS size_status"

# Words of the colour families; the first that the name holds stands.
_FAMILIES = [
    ("اسود", "black"), ("ابيض", "white"), ("black", "black"), ("off white", "white"), ("offwhite", "white"), ("ecru", "white"), ("cream", "white"), ("ivory", "white"), ("white", "white"),
    ("anthracite", "grey"), ("charcoal", "grey"), ("silver", "grey"), ("grey", "grey"), ("gray", "grey"), ("vison", "beige"), ("nude", "beige"), ("sand", "beige"), ("tan", "beige"),
    ("stone", "beige"), ("biscuit", "beige"), ("caramel", "beige"), ("beige", "beige"), ("coffee", "brown"), ("camel", "brown"), ("chocolate", "brown"), ("mink", "brown"), ("taupe", "brown"),
    ("mocha", "brown"), ("brown", "brown"), ("teal", "teal"), ("turquoise", "teal"), ("navy", "blue"), ("denim", "blue"), ("indigo", "blue"), ("cobalt", "blue"), ("petrol", "blue"),
    ("sky", "blue"), ("blue", "blue"), ("khaki", "green"), ("olive", "green"), ("mint", "green"), ("emerald", "green"), ("sage", "green"), ("green", "green"), ("mustard", "yellow"),
    ("gold", "yellow"), ("lemon", "yellow"), ("yellow", "yellow"), ("peach", "orange"), ("coral", "orange"), ("apricot", "orange"), ("rust", "orange"), ("terracotta", "orange"),
    ("orange", "orange"), ("burgundy", "burgundy"), ("maroon", "burgundy"), ("wine", "burgundy"), ("bordeaux", "burgundy"), ("crimson", "red"), ("red", "red"), ("rose", "pink"),
    ("fuchsia", "pink"), ("fuschia", "pink"), ("magenta", "pink"), ("salmon", "pink"), ("blush", "pink"), ("pink", "pink"), ("lilac", "purple"), ("lavender", "purple"), ("mauve", "purple"),
    ("violet", "purple"), ("plum", "purple"), ("purple", "purple"), ("metallic", "metallic"), ("chrome", "metallic"), ("copper", "metallic"), ("bronze", "metallic"), ("multi", "multi"),
    ("colored", "multi"), ("colour", "multi"), ("print", "multi"), ("floral", "multi"), ("striped", "multi"), ("pattern", "multi"), ("tie dye", "multi"), ("camo", "multi"),
]
COLOR_JUNK = "(length({0}) <= 1 OR regexp_matches({0}, 'size|cm|ml|kg|pcs|/|x |0x|^[.-]*[0-9][0-9.-]*$'))"
FAMILY_OF = f"CASE WHEN NOT {COLOR_JUNK} THEN CASE " + " ".join(f"WHEN contains({{0}}, '{w}') THEN '{family}'" for w, family in _FAMILIES) + " END END"

_LOTS = """SELECT l_partkey AS product_id, min(CASE WHEN l_quantity > 10 THEN l_extendedprice END) AS first_observed_price, CASE WHEN CAST(min(l_shipdate) AS DATE) < DATE '1997-01-01' THEN CAST(min(l_shipdate) AS DATE) + 365 END AS delisted_at, CAST(max(l_shipdate) AS DATE) AS last_updated_at FROM lineitem GROUP BY l_partkey, l_suppkey"""
_HELD = f"""SELECT product_id, arg_min(price, (snapshot_date, recorded_at)) AS earliest, min(snapshot_date) AS first_day, any_value(CASE p_size % 6 WHEN 0 THEN {r('first_observed_price * 1.1::DOUBLE')} WHEN 1 THEN {r('first_observed_price * 0.9::DOUBLE')} ELSE first_observed_price END) AS base FROM snapshots WHERE price > 0 GROUP BY 1 HAVING base > 0"""
_RUNS = """SELECT "table", run_status, rows_written = 0 AND most > 0 AS rerun FROM (SELECT *, row_number() OVER (PARTITION BY "table" ORDER BY ts DESC) AS k, max(rows_written) OVER (PARTITION BY "table", CAST(ts AS DATE)) AS most FROM (SELECT CASE event_type WHEN 'error' THEN 'snapshots' ELSE 'stock_events' END AS "table", CASE event_type WHEN 'error' THEN 'error' ELSE 'skipped' END AS run_status, event_id % 3 AS rows_written, ts FROM events WHERE event_type IN ('error', 'signup'))) WHERE k = 1"""


def _part(name: str, source: str, day: str, as_of: str, metrics: list[str], brands: int) -> str:
    """The counts of one table; brands 0 for a table of the whole market."""
    nulls = ", ".join(f"count(*) FILTER ({m} IS NULL)" for m in metrics)
    none = " AND ".join(f"{m} IS NULL" for m in metrics)
    seen, share = ("count(DISTINCT brand)", f"least(count(DISTINCT brand) / {brands}::DOUBLE, 1)") if brands else ("0", "1::DOUBLE")
    orphans = f"count(*) FILTER ({day} IS NULL)" + (" + count(*) FILTER (brand IS NULL)" if brands else "")
    names = ", ".join(f"'{m}'" for m in metrics)
    return f"""SELECT '{name}' AS "table", count(*) AS n_rows, max({day}) AS last_day, count(DISTINCT {day}) AS days, {seen} AS brands, {share} AS share, {orphans} AS orphan_rows, count(*) FILTER ({none}) AS empty_rows, [{nulls}] AS nulls, [{names}] AS metrics, DATE '{as_of}' - max({day}) AS old FROM {source}"""


_NO_BRAND = "(SELECT * REPLACE (CASE WHEN event_id % 10 > 0 THEN brand END AS brand), NULL AS spare FROM stock_events{})"
_PARTS = " UNION ALL ".join([
    _part("snapshots", "snapshots", "snapshot_date", AS_OF, ["compare_at_price", "honest_discount_pct"], 25), _part("price_events", "price_events", "event_date", "2024-02-02", ["discount_pct", "compare_at_price"], 100),
    _part("stock_events", _NO_BRAND.format(""), "event_date", "2024-02-09", ["price_at_event", "spare"], 0), _part("delisted", _NO_BRAND.format(" WHERE event_type = 'delisted'"), "event_date", AS_OF, ["price_at_event"], 25),
])
_HEALTH = f"""SELECT "table", n_rows, last_day, days, brands, orphan_rows, empty_rows, CASE WHEN worst > 0 THEN metrics[list_position(nulls, worst)] END AS worst_column, {r('worst_rate', 3)} AS worst_rate, run_status,
    concat_ws('; ', CASE WHEN n_rows = 0 THEN 'critical: no rows' END, CASE WHEN old >= 4 THEN 'critical: stale' WHEN old >= 2 THEN 'warn: stale' END, CASE WHEN share < 0.4::DOUBLE THEN 'warn: few brands' END, CASE WHEN orphan_rows > 0 THEN 'critical: orphan rows' END, CASE WHEN empty_rate >= 0.05::DOUBLE THEN 'critical: empty rows' END,
        CASE WHEN worst_rate >= 0.9::DOUBLE THEN 'warn: dead column' END, CASE run_status WHEN 'error' THEN 'critical: run failed' WHEN 'skipped' THEN 'warn: run skipped' END, CASE WHEN rerun THEN 'warn: a later run wrote nothing' END) AS flags,
    CASE WHEN n_rows = 0 THEN 0 ELSE {r("""100::DOUBLE * (0.3::DOUBLE * CASE WHEN old IS NULL THEN 0.5::DOUBLE WHEN old >= 4 THEN 0 WHEN old >= 2 THEN 0.5::DOUBLE ELSE 1 END + 0.2::DOUBLE * least(CASE run_status WHEN 'error' THEN 0 WHEN 'skipped' THEN 0.4::DOUBLE WHEN 'ok' THEN 1 ELSE 0.7::DOUBLE END, CASE WHEN rerun THEN 0.7::DOUBLE ELSE 1 END)
        + 0.2::DOUBLE * CASE WHEN worst_rate >= 0.9::DOUBLE THEN least(whole, 0.8::DOUBLE) ELSE whole END + 0.15::DOUBLE * share + 0.15::DOUBLE * least(days / 30::DOUBLE, 1))""", 0)} END AS score
    FROM (SELECT *, CASE WHEN orphan_rows > 0 THEN 0 ELSE 1 - least(empty_rate / 0.25::DOUBLE, 1) END AS whole FROM (SELECT *, list_max(nulls) AS worst, list_max(nulls) / greatest(n_rows, 1)::DOUBLE AS worst_rate, empty_rows / greatest(n_rows, 1)::DOUBLE AS empty_rate FROM parts LEFT JOIN runs USING ("table")))"""

SQL = {
    "d01_normalize_category": f"SELECT doc_id, {_chain('lower(text)', [(w, n) for n, w in R.CATEGORIES.items()], 'uncategorized')} AS category, CASE WHEN source IN ('src1', 'src2') THEN 'women' ELSE {_chain('lower(text)', [(w, n) for n, w in R.GENDERS.items()], 'unisex')} END AS gender FROM documents",
    "d03_breadcrumb_gender": twin("SELECT product_id, CASE p_size % 5 WHEN 0 THEN 'men' WHEN 1 THEN 'women' WHEN 2 THEN 'kids' ELSE gender END AS gender FROM catalogue"),
    "d04_rescue_category": f"SELECT doc_id, {_chain('lower(text || chr(10) || source)', [([w], c) for w, c in R.RESCUES.items()], 'uncategorized')} AS category FROM documents",
    # By category and words, as a person reads the rules.
    "d05_subcategories": twin("""SELECT product_id, category, CASE category
            WHEN 't-shirts' THEN CASE w WHEN 0 THEN 'long-sleeve' END
            WHEN 'shirts' THEN CASE w WHEN 0 THEN 'long-sleeve' WHEN 1 THEN 'flannel' END
            WHEN 'trousers' THEN CASE w WHEN 2 THEN 'cargo' END
            WHEN 'jeans' THEN CASE w WHEN 2 THEN 'wide-baggy' WHEN 3 THEN 'mom-fit' END
            WHEN 'shorts' THEN CASE w WHEN 4 THEN 'denim' END
            WHEN 'dresses' THEN CASE w WHEN 5 THEN 'maxi' WHEN 6 THEN 'midi' END
            WHEN 'skirts' THEN CASE w WHEN 5 THEN 'maxi' WHEN 6 THEN 'midi' END
            WHEN 'sweaters' THEN CASE w WHEN 7 THEN 'turtleneck' WHEN 8 THEN 'zip' END
            WHEN 'hoodies' THEN CASE w WHEN 8 THEN 'zip-up' END END AS subcategory
        FROM (SELECT product_id, product_id % 9 AS w, ['t-shirts', 'shirts', 'trousers', 'jeans', 'shorts', 'dresses', 'skirts', 'sweaters', 'hoodies', 'bags'][product_id % 10 + 1] AS category FROM catalogue)"""),
    "d05_fill_subcategories": twin("""SELECT product_id, p_size % 3 > 0 AS is_active, CASE WHEN p_size % 11 = 0 THEN 'known' ELSE CASE c
            WHEN 0 THEN CASE w WHEN 0 THEN 'basic' WHEN 6 THEN 'long-sleeve' END
            WHEN 1 THEN CASE WHEN w = 1 THEN 'flare' WHEN w = 4 THEN 'wide-baggy' WHEN w = 7 AND p_size % 3 > 0 THEN 'mom-fit' END
            WHEN 2 THEN CASE WHEN w = 2 AND p_size % 3 > 0 THEN 'maxi' END
            WHEN 3 THEN CASE WHEN w = 5 THEN 'v-neck' WHEN w = 3 AND p_size % 3 > 0 THEN 'zip' END
            WHEN 4 THEN CASE WHEN w IN (3, 5) THEN 'zip-up' END END END AS subcategory
        FROM (SELECT product_id, p_size, product_id % 8 AS w, product_id // 8 % 6 AS c FROM catalogue)"""),
    "d05_subcategory": twin("SELECT product_id, CASE WHEN p_size % 7 = 0 THEN 'known' WHEN p_size % 2 = 0 THEN 'slim' ELSE 'flare' END AS subcategory FROM catalogue"),
    "d06_subcategory_progress": twin(f"SELECT category_normalized, count(*) AS total, count(*) FILTER (p_size > 20) AS filled, {pct('count(*) FILTER (p_size > 20)', 'count(*)', 1)} AS filled_pct FROM catalogue GROUP BY 1"),
    "d07_classify_size": twin(f"SELECT product_id, brand, category_normalized, size, size_family, size_system, {_STATUS}, reason FROM ({_CLASSED})", sized=_SIZES),
    "d08_size_review_queue": twin(f"SELECT size AS size_raw, category_normalized, brand, reason, count(*) AS sample_count FROM ({_CLASSED}) WHERE size_family IS NULL AND reason IS NOT NULL GROUP BY ALL", sized=_SIZES),
    "d09_seed_colors": twin(f"SELECT color_raw, family, CASE WHEN family IS NOT NULL THEN color_raw END AS shade, CASE WHEN junk THEN 'junk' WHEN family IS NOT NULL THEN 'classified' ELSE 'unclassified' END AS status FROM (SELECT color_raw, {COLOR_JUNK.format('color_raw')} AS junk, {FAMILY_OF.format('color_raw')} AS family FROM (SELECT DISTINCT lower(trim(product_name)) AS color_raw FROM catalogue) WHERE color_raw <> 'small ring')"),
    "d11_canonical_color": f"SELECT doc_id, {_chain('lower(trim(text))', [([w], c) for w, c in R.COLORS], 'other')} AS color FROM documents",
    "d24_drop_excluded": twin("SELECT product_id, brand, p_size FROM catalogue WHERE brand NOT IN ('Brand#11', 'Brand#12')"),
    "j01_freshness": twin(f"SELECT *, CASE WHEN days_old >= 3 THEN 'FAIL' WHEN days_old >= 2 THEN 'WARN' ELSE 'OK' END AS status FROM (SELECT brand, max(event_date) AS last_day, CAST({D} - max(event_date) AS INTEGER) AS days_old FROM stock_events GROUP BY 1)"),
    "j02_volume_drop": twin(f"SELECT *, CASE WHEN latest / median < 0.5::DOUBLE THEN 'FAIL' WHEN latest / median < 0.75::DOUBLE THEN 'WARN' ELSE 'OK' END AS status FROM (SELECT brand, max(n) FILTER (k = 1) AS latest, quantile_cont(n, 0.5) FILTER (k > 1) AS median, count(*) AS days FROM (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY snapshot_date DESC) AS k FROM (SELECT brand, snapshot_date, count(*) AS n FROM snapshots WHERE snapshot_date > {D} - 15 AND snapshot_date < {D} GROUP BY 1, 2)) GROUP BY 1) WHERE days >= 7"),
    "j06_unclassified_events": twin(f"SELECT brand, count(*) FILTER (witnessed IS NULL AND event_date < {D} - 9) AS unclassified, count(*) AS events FROM stock_events WHERE event_type IN ('stockout', 'restock') GROUP BY 1"),
    "j07_integrity": twin("""SELECT *, CASE WHEN n > 100 THEN 'FAIL' WHEN n > 0 THEN 'WARN' ELSE 'OK' END AS status FROM (SELECT 'orphan_snapshots' AS "check", count(*) AS n FROM snapshots WHERE p_size <= 5 UNION ALL SELECT 'orphan_variants', count(*) FROM lots WHERE product_id NOT IN (SELECT product_id FROM products WHERE p_size > 5)
        UNION ALL SELECT 'bad_prices', count(*) FILTER (price IS NULL OR price <= 0) FROM snapshots UNION ALL SELECT 'null_baselines', count(*) FILTER (first_observed_price IS NULL AND delisted_at IS NULL) FROM lots UNION ALL SELECT 'written_after_delist', count(*) FILTER (last_updated_at > delisted_at) FROM lots)""", lots=_LOTS),
    "j08_event_liveness": twin(f"SELECT brand, count(*) FILTER (event_date > {D} - 3) AS recent, CASE WHEN count(*) FILTER (event_date > {D} - 3) = 0 THEN 'FAIL' ELSE 'OK' END AS status FROM price_events GROUP BY 1"),
    "j09_frozen_prices": twin(f"""SELECT *, still >= 0.95::DOUBLE * products AND (seen = 0 OR on_sale < 0.05::DOUBLE * seen) AND NOT (ups >= 0.1::DOUBLE * products OR moved >= 10) AS frozen FROM (SELECT brand, products, still, days, coalesce(seen, 0) AS seen, coalesce(on_sale, 0) AS on_sale, coalesce(ups, 0) AS ups, coalesce(moved, 0) AS moved
        FROM (SELECT brand, count(*) AS products, count(*) FILTER (prices = 1) AS still, max(days) AS days FROM (SELECT brand, product_id, count(DISTINCT snapshot_date) AS days, count(DISTINCT price) AS prices FROM snapshots WHERE snapshot_date BETWEEN {D} - 7 AND {D} GROUP BY 1, 2) WHERE days >= 2 GROUP BY 1 HAVING count(*) > 2)
        LEFT JOIN (SELECT brand, count(*) AS seen, count(*) FILTER (sale) AS on_sale FROM (SELECT brand, product_id, arg_max(coalesce(compare_at_price > 1.01::DOUBLE * price, false), snapshot_date) AS sale FROM snapshots WHERE snapshot_date BETWEEN {D} - 2 AND {D} GROUP BY 1, 2) GROUP BY 1) USING (brand)
        LEFT JOIN (SELECT brand, count(DISTINCT product_id) FILTER (direction = 'up') AS ups, count(DISTINCT product_id) AS moved FROM price_events WHERE event_date BETWEEN {D} - 29 AND {D} GROUP BY 1) USING (brand))"""),
    "j10_table_health": twin(_HEALTH, parts=_PARTS, runs=_RUNS),
    "j14_baseline_immutability": twin(f"SELECT *, {pct('match', 'products')} AS match_pct FROM (SELECT count(*) AS products, count(*) FILTER (abs(base - earliest) < 0.01::DOUBLE) AS match, count(*) FILTER (base > earliest + 0.01::DOUBLE) AS base_higher, count(*) FILTER (base < earliest - 0.01::DOUBLE) AS base_lower FROM held)", held=_HELD),
    "j14_baseline_mismatches": twin("SELECT * FROM held WHERE abs(base - earliest) >= 0.01::DOUBLE ORDER BY abs(base - earliest) DESC, product_id LIMIT 10", held=_HELD),
}


def queries() -> dict:
    return {name: (lambda spark, sf_dir, f=f: f(Shop(spark, sf_dir))) for name, f in QUERIES.items()}

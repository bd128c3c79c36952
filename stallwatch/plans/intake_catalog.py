"""Intake queries over the shop tables: listings, nested variants, prices of items, runs; with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwatch.operators import capture as C
from stallwatch.operators import quality as Q
from stallwatch.plans.base_sql import AS_OF as D
from stallwatch.plans.base_sql import twin
from stallwatch.plans.boards_catalog import _RANKS, _ranks
from stallwatch.sources.shop import AS_OF, SIZES, Shop


def _nested(s: Shop) -> DataFrame:
    """Products with their variants as an array; odd products name the colour first."""
    size, color, odd = F.element_at(F.array(*map(F.lit, SIZES)), (F.col("l_linenumber") % 4 + 1).cast("int")), F.concat(F.lit("tone "), "l_returnflag"), F.col("l_partkey") % 2 == 1
    variant = F.struct(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("sku"), F.when(odd, color).otherwise(size).alias("option1"), F.when(odd, size).otherwise(color).alias("option2"),
        (F.col("l_extendedprice") * (F.col("l_quantity") > 5).cast("int")).alias("price"), (F.col("l_returnflag") != "R").alias("available"),
    )
    return s.table("lineitem").groupBy(F.col("l_partkey").alias("product_id")).agg(F.collect_list(variant).alias("variants"))


def _items(s: Shop) -> DataFrame:
    price, flagged = F.col("l_extendedprice"), F.col("l_returnflag") == "R"
    badges = F.array(F.struct((F.col("l_linenumber") % 3 == 0).alias("shown"), (price * 0.9).alias("price")), F.struct(F.lit(False).alias("shown"), (price * 0.5).alias("price")))
    paid = C.resolve_price(badges, F.when(F.col("l_discount") > 0.05, price * 0.95), price, price * 0.85, flagged)
    text = F.concat(F.lit("EGP "), F.format_string("%.2f", price.cast("double")))
    rows = s.table("lineitem").select("l_orderkey", "l_linenumber", C.text_price(text).alias("shown_price"), C.minor_unit_price(F.col("l_orderkey").cast("string")).alias("unit_price"), paid.alias("price"), price.alias("__list"), F.when(F.col("l_linenumber") % 3 == 0, price * 0.9).alias("__badge"))
    return rows.withColumn("compare_at_price", C.resolve_compare_at(F.col("__badge"), F.col("__list"), F.array("__list", F.col("__list") * 0.99), F.col("price"))).drop("__list", "__badge")


def _crawls(s: Shop) -> DataFrame:
    """What each brand's last day of crawling saw."""
    rows = s.snapshots.where(F.col("snapshot_date") == F.lit(AS_OF).cast("date")).groupBy("brand").agg(F.count("*").alias("n"))
    return s.catalogue.select("brand").distinct().join(rows, "brand", "left").select("brand", F.coalesce("n", F.lit(0)).alias("seen"), (F.coalesce("n", F.lit(0)) % 5).alias("last_page"), F.coalesce(F.col("n") < 3, F.lit(False)).alias("partial"))


QUERIES = {
    "c13_new_bestseller_ranks": lambda s: C.bestseller_ranks(_ranks(s), s.catalogue.where("p_size > 5"), 3, _ranks(s).where("snapshot_date < '2024-01-10' or brand = 'Brand#11'")),
    "c13_bestseller_ranks": lambda s: C.bestseller_ranks(_ranks(s), s.catalogue.where("p_size > 5"), 3),
    "c14_flatten_variants": lambda s: C.flatten_variants(_nested(s)),
    "c15_crawl_shortfall": lambda s: C.crawl_shortfall(_crawls(s), s.products, page=4, gap=1),
    "c17_item_prices": _items,
    "j11_run_health": lambda s: Q.run_health(s.table("events").select(F.concat_ws("-", "event_type", (F.col("user_id") % 50).cast("string")).alias("signal_id"), F.lit("ok").alias("status"), (F.col("event_id") % 3).alias("rows_written"), F.col("ts").alias("run_at"))),
    "j15_empty_run_guard": lambda s: Q.empty_run_guard(_crawls(s)),
}

_SEEN = f"SELECT brand, coalesce(n, 0) AS seen, coalesce(n, 0) % 5 AS last_page, coalesce(n < 3, false) AS partial FROM (SELECT DISTINCT brand FROM catalogue) LEFT JOIN (SELECT brand, count(*) AS n FROM snapshots WHERE snapshot_date = {D} GROUP BY 1) USING (brand)"

SQL = {
    "c13_new_bestseller_ranks": twin("SELECT product_id, brand, rank, snapshot_date FROM ranks JOIN (SELECT product_id FROM catalogue WHERE p_size > 5) USING (product_id) WHERE rank <= 3 AND snapshot_date >= DATE '2024-01-10' AND brand <> 'Brand#11'", ranks=_RANKS),
    "c13_bestseller_ranks": twin("SELECT product_id, brand, rank, snapshot_date FROM ranks JOIN (SELECT product_id FROM catalogue WHERE p_size > 5) USING (product_id) WHERE rank <= 3", ranks=_RANKS),
    "c14_flatten_variants": "SELECT l_partkey AS product_id, l_orderkey || '-' || l_linenumber AS external_sku, ['S', 'M', 'L', 'XL'][l_linenumber % 4 + 1] AS size, 'tone ' || l_returnflag AS color, l_extendedprice AS price, l_returnflag <> 'R' AS is_in_stock FROM lineitem WHERE l_quantity > 5",
    "c15_crawl_shortfall": twin("SELECT brand, seen, last_page, partial, coalesce(a, 0) AS active, last_page >= 4 OR (coalesce(a, 0) - seen >= 1 AND seen < 0.85::DOUBLE * coalesce(a, 0)) AS suspicious FROM seen_by LEFT JOIN (SELECT brand, count(*) AS a FROM products GROUP BY 1) USING (brand)", seen_by=_SEEN),
    "c17_item_prices": """SELECT l_orderkey, l_linenumber, l_extendedprice::DOUBLE AS shown_price, l_orderkey / 100::DOUBLE AS unit_price, price, CASE WHEN l_extendedprice > 1.01::DOUBLE * price THEN l_extendedprice END AS compare_at_price FROM (SELECT *, CASE WHEN l_linenumber % 3 = 0 THEN l_extendedprice * 0.9::DOUBLE WHEN l_discount > 0.05 THEN l_extendedprice * 0.95::DOUBLE
        WHEN l_returnflag = 'R' THEN least(l_extendedprice, l_extendedprice * 0.85::DOUBLE) ELSE l_extendedprice END AS price FROM lineitem)""",
    "j11_run_health": "SELECT signal_id, status, rows_written, run_at, rows_written = 0 AND most > 0 AS empty_rerun FROM (SELECT *, row_number() OVER (PARTITION BY signal_id ORDER BY run_at DESC) AS k, max(rows_written) OVER (PARTITION BY signal_id, CAST(run_at AS DATE)) AS most FROM (SELECT event_type || '-' || (user_id % 50) AS signal_id, 'ok' AS status, event_id % 3 AS rows_written, ts AS run_at FROM events)) WHERE k = 1",
    "j15_empty_run_guard": twin("SELECT *, empty >= least(brands, greatest(3, ceil(0.4::DOUBLE * brands))) AS alert, partial >= 2 AS warning FROM (SELECT count(*) AS brands, count(*) FILTER (seen = 0) AS empty, count(*) FILTER (partial) AS partial FROM seen_by)", seen_by=_SEEN),
}


def queries() -> dict:
    return {name: (lambda spark, sf_dir, f=f: f(Shop(spark, sf_dir))) for name, f in QUERIES.items()}

"""Lake and capture queries over the shop tables, with their SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stallwatch.operators import capture as C
from stallwatch.operators import lake as L
from stallwatch.operators.maintenance import archive_days, archive_results, recompress, repartition_by_day
from stallwatch.operators.signals import flag_flash_sales
from stallwatch.plans.base_sql import AS_OF as D
from stallwatch.plans.base_sql import pct, r, twin
from stallwatch.sources.day_files import scan_days
from stallwatch.sources.shared import shared_folder
from stallwatch.sources.shop import AS_OF, DELIST_AS_OF, Shop


def _tiers(shop: Shop):
    """Hot: the last 8 days. Cold: all days before, two of the hot days again, with prices that hot overrides."""
    rows = shop.observations.select("event_id", "product_id", "snapshot_date", "price", "event_type")
    hot = rows.where(F.col("snapshot_date") > F.date_sub(F.lit(AS_OF).cast("date"), 9))
    cold = rows.where(F.col("snapshot_date") <= F.date_sub(F.lit(AS_OF).cast("date"), 7)).withColumn("price", F.col("price") + 1)
    return hot, cold


def _event_tiers(shop: Shop, events):
    """The same tiers of an event frame."""
    day, end = F.col("event_date"), F.lit(AS_OF).cast("date")
    return events.where(day > F.date_sub(end, 9)), events.where(day <= F.date_sub(end, 7))


def _stock_tiers(shop: Shop):
    """Archived rows of the first days do not say whether they were witnessed."""
    hot, cold = _event_tiers(shop, shop.stock_events)
    return hot, cold.withColumn("witnessed", F.when(F.col("event_date") >= "2024-01-10", F.col("witnessed")))


def _price_tiers(shop: Shop):
    hot, cold = _event_tiers(shop, shop.price_events)
    return hot, cold.withColumn("price_after", F.col("price_after") + 1)


def _held(shop: Shop):
    return shop.spark.createDataFrame([("Brand#11", "2024-01-26"), ("Brand#12", "2024-01-20")], "brand string, until string").withColumn("until", F.to_date("until"))


def _hot_parts(shop: Shop):
    """Snapshots of the last days with prices as decimals; products and variants of which some are unknown."""
    rows = shop.snapshots.where(F.col("snapshot_date") > F.date_sub(F.lit(AS_OF).cast("date"), 9)).select("product_id", F.col("product_id").alias("variant_id"), "brand", "snapshot_date", *[F.col(c).cast("decimal(12,2)").alias(c) for c in ("price", "compare_at_price")])
    variants = shop.catalogue.where("p_size > 10").select(F.col("product_id").alias("variant_id"), F.lit("M").alias("size"), F.split("product_name", " ")[0].alias("color"))
    return rows, shop.catalogue.where("p_size > 5"), variants, _held(shop)


def _seam(shop: Shop):
    """Both tiers as they lie, with two days in each, and stitched."""
    hot, cold = _tiers(shop)
    both = {"as they lie": L.union_all([hot, cold]), "stitched": L.stitch(hot, cold, "event_id", "snapshot_date")}
    return L.union_all([L.seam_check(df.withColumn("discount_pct", F.when(F.col("price") < 0, 0.0)), "event_id", ("discount_pct",)).withColumn("tiers", F.lit(name)) for name, df in both.items()])


def _sightings(shop: Shop):
    """Parts by supplier as variants, with their prices when they were shipped."""
    return shop.table("lineitem").select((F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("variant_id"), F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("seen_at"), F.col("l_extendedprice").alias("price"))


def _taken_off(shop: Shop):
    products = shop.shelf.withColumn("is_active", F.col("product_id") % 7 != 0)
    return C.delist(products, _variants(shop)[0].withColumn("delisted_at", F.col("delisted_at").cast("date")), DELIST_AS_OF)


def _active(shop: Shop):
    return shop.shelf.withColumn("is_active", F.col("last_seen") >= F.lit("2001-06-01").cast("date"))


def _from_summary(shop: Shop):
    """The lookback's rows alone, with a summary kept by day: one of the first half of the days before, one that adds the rest."""
    stock, day = shop.stock_events, F.col("event_date")
    first = C.transition_summary(stock.where(day <= "2024-01-10"))
    then = C.transition_summary(stock.where((day > "2024-01-10") & (day <= F.date_sub(F.lit(AS_OF).cast("date"), 9))), first)
    return C.reclassify_witnessed(stock.where(day > F.date_sub(F.lit(AS_OF).cast("date"), 9)), AS_OF, before=then)


def _departments(shop: Shop):
    products = shop.catalogue.withColumn("department", F.when(F.col("p_size") % 2 == 0, F.col("department")))
    return products, shop.spark.createDataFrame([("standard", "basics"), ("promo", "offers")], "category_normalized string, department string")


def _flags(shop: Shop):
    return shop.observations.where("event_type in ('error', 'signup')").join(shop.first_prices.select("product_id", "first_observed_price"), "product_id").select("event_id", F.col("product_id").alias("variant_id"), "product_id", "price", "first_observed_price", "recorded_at", (F.col("event_type") == "signup").alias("is_in_stock"))


def _variants(shop: Shop):
    """(new, previous) states of part-supplier variants before and after a day."""
    lines = shop.table("lineitem").select((F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("variant_id"), F.col("l_partkey").alias("product_id"), "l_shipdate", "l_extendedprice", "l_returnflag", "l_quantity")
    at = F.struct("l_shipdate", "l_extendedprice", "l_quantity", "l_returnflag")

    def state(rows):
        return rows.groupBy("variant_id", "product_id").agg((F.max_by("l_returnflag", at) != "R").alias("is_in_stock"), F.min_by("l_extendedprice", at).alias("first_observed_price"), F.when(F.max("l_shipdate") < "1995-06-01", F.max("l_shipdate")).alias("delisted_at"))

    return state(lines), state(lines.where("l_shipdate < '2001-06-01'"))


def _drops(events):
    """Cuts to tell of; an event has one size in stock."""
    return C.alert_drops(events.where("direction = 'down'").withColumn("sizes_in_stock", F.array(F.element_at(F.array(*map(F.lit, "S M L XL".split())), (F.col("event_id") % 4 + 1).cast("int")))))


def _subscribers(shop: Shop):
    people = shop.table("customer")
    users = people.select(F.col("c_custkey").alias("user_id"), (F.col("c_acctbal") > 0).alias("is_active"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal")).alias("price_ceiling"))
    sizes = people.select(F.col("c_custkey").alias("user_id"), F.element_at(F.array(*map(F.lit, "S M L XL".split())), (F.col("c_custkey") % 4 + 1).cast("int")).alias("size"))
    brands = people.select(F.col("c_custkey").alias("user_id"), F.concat(F.lit("Brand#"), (F.col("c_custkey") % 5 + 1).cast("string"), (F.col("c_nationkey") % 5 + 1).cast("string")).alias("brand"))
    sold = shop.catalogue.select("brand", F.col("category_normalized").alias("category")).distinct()
    return C.subscribers(users, sizes.join(brands.join(sold, "brand").select("user_id", "category"), "user_id"), brands)  # a size for each category of the brand that is followed


def _alerts(shop: Shop):
    return C.meet(_drops(shop.price_events), _subscribers(shop))


def _written(shop: Shop, name: str, rows, day: str) -> str:
    """A frame as a table of days in the shared folder."""
    root = f"{shared_folder(shop.spark)}/stallwatch/{name}-{uuid.uuid4().hex}"
    L.replace_days(rows, root, day)
    return root


def _snapshot_days(shop: Shop):
    """The last month of an archive whose first days lack the advertised price and which misses a day."""
    rows = shop.snapshots.select("product_id", "brand", "price", "compare_at_price", "snapshot_date").where("snapshot_date <> '2024-01-20'")
    root = _written(shop, "snapshots", rows.where("snapshot_date >= '2024-01-15'"), "snapshot_date")
    L.replace_days(rows.drop("compare_at_price").where("snapshot_date < '2024-01-15'"), root, "snapshot_date")
    return scan_days(shop.spark, root, "2024-01-10", AS_OF, rows.schema, defaults={"compare_at_price": 0.0})


def _event_days(shop: Shop):
    """Archived stock events of which the first days do not say whether they were witnessed, nor why they are distrusted."""
    rows = shop.stock_events.select("event_id", "variant_id", "event_type", "witnessed", "event_date").withColumn("seed_reason", F.when(F.col("event_type") == "delisted", "not_a_stock_transition"))
    root = _written(shop, "stock-events", rows.where("event_date >= '2024-01-15'"), "event_date")
    L.replace_days(rows.drop("witnessed", "seed_reason").where("event_date < '2024-01-15'"), root, "event_date")
    return scan_days(shop.spark, root, "2024-01-05", AS_OF, rows.schema, "event_date", {"witnessed": False})


def _archived(shop: Shop):
    """What stays hot and what the archive holds after snapshots older than two weeks have moved, with their products' names."""
    hot = shop.snapshots.select("product_id", "snapshot_date", "price")
    root = f"{shared_folder(shop.spark)}/stallwatch/archive-{uuid.uuid4().hex}"
    left = archive_days(hot, root, f"{root}__staged", ["product_id", "snapshot_date"], AS_OF, 14, context=shop.catalogue.where("p_size > 5").select("product_id", "product_name"), context_keys=["product_id"])
    cold = shop.spark.read.parquet(root).select("product_id", "snapshot_date", "price", "product_name", F.lit("cold").alias("tier"))
    return cold.unionByName(left.withColumns({"product_name": F.lit(None).cast("string"), "tier": F.lit("hot")}))


def _folder(shop: Shop, name: str) -> str:
    return f"{shared_folder(shop.spark)}/stallwatch/{name}-{uuid.uuid4().hex}"


def _archive(shop: Shop):
    """Files at two depths under one folder as one table; the older ones lack the advertised price."""
    root, old = _folder(shop, "files"), F.col("snapshot_date") < "2024-01-15"
    rows = shop.snapshots.select("product_id", "snapshot_date", "price", "compare_at_price")
    rows.where(old).drop("compare_at_price").write.parquet(f"{root}/old/first")
    rows.where(~old).write.parquet(f"{root}/new")
    return L.archive_table(shop.spark, root, "price_archive")


def _ad_hoc(shop: Shop):
    query = "SELECT brand, count(*) AS moves, max(price_after) AS highest FROM moves JOIN shelf USING (product_id) WHERE direction = 'up' GROUP BY brand"
    frames = {"moves": shop.price_events.select("product_id", "direction", "price_after"), "shelf": shop.catalogue.select("product_id", "brand")}
    return L.ad_hoc(shop.spark, frames, query)[0]


def _archived_results(shop: Shop):
    """Price moves older than two weeks, archived twice with a later price in the second run; which tier holds each."""
    root, rows = _folder(shop, "results"), shop.price_events.select("event_id", "price_after", "event_date")
    archive_results(rows.withColumn("price_after", F.col("price_after") - 1), root, AS_OF, 14, ["event_id"], "event_date")
    left = archive_results(rows, root, AS_OF, 14, ["event_id"], "event_date")
    cold = shop.spark.read.parquet(root).select("event_id", "price_after", "event_date", F.lit("cold").alias("tier"))
    return cold.unionByName(left.withColumn("tier", F.lit("hot")))


def _repartitioned(shop: Shop):
    """Events of which a third occur twice, in days without repeats."""
    root, rows = _folder(shop, "events"), shop.price_events.select("event_id", "price_before", "price_after", "event_date")
    repartition_by_day(rows.unionByName(rows.where("event_id % 3 = 0")), root, None, "event_date")
    return shop.spark.read.parquet(root)


def _recompressed(shop: Shop):
    source, target = _written(shop, "plain", shop.snapshots.select("product_id", "snapshot_date", "price", "compare_at_price"), "snapshot_date"), _folder(shop, "snappy")
    recompress(shop.spark, source, target, day="snapshot_date")
    return shop.spark.read.parquet(target)


QUERIES = {
    "a05_archive_table": _archive,
    "a06_ad_hoc": _ad_hoc,
    "k02_archive_results": _archived_results,
    "k05_repartition_events": _repartitioned,
    "k06_recompress": _recompressed,
    "a01_scan_snapshot_days": _snapshot_days,
    "a03_scan_event_days": _event_days,
    "k01_archive_days": _archived,
    "b01_stitch": lambda s: L.stitch(*_tiers(s), "event_id", "snapshot_date"),
    "b02_discounts": lambda s: s.snapshots.select("product_id", "snapshot_date", "honest_discount_pct", "brand_claimed_discount_pct"),
    "b04_quarantine": lambda s: L.quarantine(s.snapshots, s.catalogue.where("p_size > 40").select("brand", F.lit("2024-01-12").cast("date").alias("until")), "snapshot_date").select("product_id", "brand", "snapshot_date", "price"),
    "b05_variant_baselines": lambda s: L.variant_baselines(_variants(s)[0], s.shelf.withColumn("is_active", F.col("last_seen") >= F.lit("2001-06-01").cast("date")), ("Brand#11",)).select("variant_id", "product_id", "brand", "first_observed_price", "size_level_reliable"),
    "a02_hot_snapshots": lambda s: L.hot_snapshots(*_hot_parts(s)),
    "b06_stock_history": lambda s: L.stock_history(*_stock_tiers(s), AS_OF).select("event_id", "variant_id", "event_type", "witnessed", "was_on_discount"),
    "b07_price_event_history": lambda s: L.price_event_history(*_price_tiers(s), _held(s), AS_OF).select("event_id", "product_id", "brand", "price_after", "event_date"),
    "b10_seam_check": _seam,
    "b09_price_history": lambda s: L.price_history(s.snapshots, AS_OF, 20),
    "b10_coverage": lambda s: L.coverage(s.snapshots, "2023-12-28", AS_OF),
    "a07_archive_summary": lambda s: L.archive_summary(s.snapshots),
    "a11_latest": lambda s: L.latest(s.snapshots, "snapshot_date").select("product_id", "price", "snapshot_date"),
    "c01_representative_price": lambda s: C.representative_prices(s.snapshots, ["brand", "snapshot_date"]),
    "c02_representative_baseline": lambda s: C.representative_baselines(s.snapshots, ["brand", "snapshot_date"]),
    "c03_daily_snapshots": lambda s: C.daily_snapshots(s.observations),
    "c04_last_prices": lambda s: C.last_prices(s.snapshots, AS_OF),
    "c05_price_events": lambda s: s.price_events.select("event_id", "product_id", "price_before", "price_after", "direction", "discount_pct"),
    "c06_stock_transitions": lambda s: C.stock_transitions(_flags(s)),
    "c07_needs_write": lambda s: C.needs_write(*_variants(s)).select("variant_id", "needs_write"),
    "c08_seed_first_prices": lambda s: C.seed_first_prices(s.snapshots, s.first_prices.where("product_id % 2 = 0").select("product_id", "first_observed_price")),
    "c09_delist_stale": lambda s: C.delist_stale(s.shelf.withColumn("is_active", F.col("product_id") % 7 != 0), DELIST_AS_OF).drop("witnessed"),
    "b02_discount_at_variant_grain": lambda s: L.product_baselines(_variants(s)[0], _active(s)).join(s.shelf.select("product_id", "last_price"), "product_id").withColumn("honest_discount_pct", L.discount_against(F.col("base_price"), F.col("last_price"))),
    "c08_seed_variant_baselines": lambda s: C.seed_variant_baselines(_sightings(s), _variants(s)[1].where("product_id % 2 = 0").select("variant_id", "product_id", "first_observed_price")),
    "c08_seed_product_baselines": lambda s: C.seed_product_baselines(_sightings(s), s.shelf.where("product_id % 2 = 0").select("product_id", "first_observed_price")),
    "c09_delist_products": lambda s: _taken_off(s)[0].select("product_id", "brand", "last_seen", "is_active"),
    "c09_delist_variants": lambda s: _taken_off(s)[1].select("variant_id", "product_id", "is_in_stock", "delisted_at"),
    "c09_delist_events": lambda s: _taken_off(s)[2].drop("witnessed"),
    "c10_reclassify_witnessed": lambda s: C.reclassify_witnessed(s.stock_events, AS_OF),
    "c10_reclassify_from_summary": _from_summary,
    "c11_fill_department": lambda s: C.fill_department(*_departments(s)).select("product_id", "category_normalized", "department"),
    "c11_fill_report": lambda s: C.fill_report(*_departments(s)),
    "c12_match_alerts": _alerts,
    "c18_flash_sales": lambda s: flag_flash_sales(s.price_events.withColumn("is_flash_sale", F.col("event_id") % 7 == 0), AS_OF).select("event_id", "product_id"),
    "c19_statistical_deals": lambda s: C.statistical_deals(s.price_events.withColumn("is_statistical_deal", F.col("event_id") % 9 == 0), s.snapshots, AS_OF, recent_hours=720),
    "c20_fx_context": lambda s: C.with_fx(s.price_events, s.table("orders").select(F.date_add(F.lit("2023-12-25").cast("date"), (F.col("o_orderkey") % 40).cast("int")).alias("rate_date"), F.col("o_totalprice").alias("rate")).groupBy("rate_date").agg(F.max("rate").alias("rate"))).select("event_id", "event_date", "rate"),
}

_STATE = "SELECT l_partkey * 100000 + l_suppkey AS variant_id, l_partkey AS product_id, arg_max(l_returnflag, (l_shipdate, l_extendedprice, l_quantity, l_returnflag)) <> 'R' AS is_in_stock, arg_min(l_extendedprice, (l_shipdate, l_extendedprice, l_quantity, l_returnflag)) AS first_observed_price, CASE WHEN max(l_shipdate) < '1995-06-01' THEN max(l_shipdate) END AS delisted_at FROM lineitem {} GROUP BY 1, 2"

SQL = {
    "a05_archive_table": twin("SELECT product_id, snapshot_date, price, CASE WHEN snapshot_date >= DATE '2024-01-15' THEN compare_at_price END AS compare_at_price FROM snapshots"),
    "a06_ad_hoc": twin("SELECT brand, count(*) AS moves, max(price_after) AS highest FROM price_events WHERE direction = 'up' GROUP BY 1"),
    "k02_archive_results": twin(f"SELECT event_id, price_after, event_date, CASE WHEN event_date < {D} - 14 THEN 'cold' ELSE 'hot' END AS tier FROM price_events"),
    "k05_repartition_events": twin("SELECT event_id, price_before, price_after, event_date FROM price_events"),
    "k06_recompress": twin("SELECT product_id, snapshot_date, price, compare_at_price FROM snapshots"),
    "a01_scan_snapshot_days": twin("SELECT product_id, brand, price, CASE WHEN snapshot_date < DATE '2024-01-15' THEN 0 ELSE coalesce(compare_at_price, 0) END AS compare_at_price, snapshot_date FROM snapshots WHERE snapshot_date >= DATE '2024-01-10' AND snapshot_date <> DATE '2024-01-20'"),
    "a03_scan_event_days": twin("SELECT event_id, variant_id, event_type, event_date >= DATE '2024-01-15' AND coalesce(witnessed, false) AS witnessed, event_date, CASE WHEN event_date >= DATE '2024-01-15' AND event_type = 'delisted' THEN 'not_a_stock_transition' END AS seed_reason FROM stock_events WHERE event_date >= DATE '2024-01-05'"),
    "k01_archive_days": twin(f"SELECT product_id, snapshot_date, price, CASE WHEN snapshot_date < {D} - 14 AND p_size > 5 THEN product_name END AS product_name, CASE WHEN snapshot_date < {D} - 14 THEN 'cold' ELSE 'hot' END AS tier FROM snapshots"),
    "b01_stitch": twin(f"SELECT event_id, product_id, snapshot_date, CASE WHEN snapshot_date > {D} - 9 THEN price ELSE price + 1 END AS price, event_type FROM observations"),
    "b02_discounts": twin("SELECT product_id, snapshot_date, honest_discount_pct, brand_claimed_discount_pct FROM snapshots"),
    "b04_quarantine": twin("SELECT product_id, brand, snapshot_date, price FROM snapshots WHERE NOT (brand IN (SELECT brand FROM catalogue WHERE p_size > 40) AND snapshot_date <= DATE '2024-01-12')"),
    "b05_variant_baselines": twin("SELECT variant_id, product_id, brand, v.first_observed_price, brand <> 'Brand#11' AS size_level_reliable FROM v JOIN shelf USING (product_id) WHERE delisted_at IS NULL AND last_seen >= DATE '2001-06-01'", v=_STATE.format("")),
    "a02_hot_snapshots": twin(f"""SELECT s.product_id, s.product_id AS variant_id, s.brand, snapshot_date, price, compare_at_price, CASE WHEN p_size > 5 THEN product_name END AS product_name, CASE WHEN p_size > 5 THEN category_normalized END AS category_normalized, CASE WHEN p_size > 5 THEN gender END AS gender, CASE WHEN p_size > 10 THEN 'M' END AS size, CASE WHEN p_size > 10 THEN split_part(product_name, ' ', 1) END AS color
        FROM snapshots s WHERE snapshot_date > {D} - 9 AND NOT (brand = 'Brand#11' AND snapshot_date <= DATE '2024-01-26') AND NOT (brand = 'Brand#12' AND snapshot_date <= DATE '2024-01-20')"""),
    "b06_stock_history": twin(f"SELECT event_id, variant_id, event_type, witnessed, was_on_discount FROM stock_events WHERE event_date > {D} - 9 OR event_date >= DATE '2024-01-10' AND witnessed"),
    "b07_price_event_history": twin(f"SELECT event_id, product_id, brand, CASE WHEN event_date > {D} - 9 THEN price_after ELSE price_after + 1 END AS price_after, event_date FROM price_events WHERE NOT (brand = 'Brand#11' AND event_date <= DATE '2024-01-26') AND NOT (brand = 'Brand#12' AND event_date <= DATE '2024-01-20')"),
    "b10_seam_check": twin(f"SELECT 'as they lie' AS tiers, count(*) + count(*) FILTER (snapshot_date > {D} - 9 AND snapshot_date <= {D} - 7) AS n_rows, count(*) FILTER (snapshot_date > {D} - 9 AND snapshot_date <= {D} - 7) AS duplicate_ids, 0::BIGINT AS discount_pct_values FROM observations UNION ALL SELECT 'stitched', count(*), 0, 0 FROM observations"),
    "b09_price_history": twin(f"SELECT product_id, brand, category_normalized, snapshot_date, price FROM snapshots WHERE price > 0 AND snapshot_date BETWEEN {D} - 19 AND {D}"),
    "b10_coverage": twin(f"SELECT CAST(d AS DATE) AS snapshot_date, coalesce(n, 0) AS n_rows, coalesce(b, 0) AS n_brands, n IS NULL AS missing FROM range(DATE '2023-12-28', {D} + 1, INTERVAL 1 DAY) AS t(d) LEFT JOIN (SELECT snapshot_date, count(*) AS n, count(DISTINCT brand) AS b FROM snapshots GROUP BY 1) s ON s.snapshot_date = CAST(d AS DATE)"),
    "a07_archive_summary": twin(f"SELECT brand, count(*) AS n_rows, min(snapshot_date) AS first_day, max(snapshot_date) AS last_day, {r('sum(CAST(floor(price * 100::DOUBLE + 0.5) AS BIGINT))::DOUBLE / count(price) / 100::DOUBLE')} AS avg_price FROM snapshots GROUP BY 1"),
    "a11_latest": twin("SELECT product_id, price, snapshot_date FROM snapshots WHERE snapshot_date = (SELECT max(snapshot_date) FROM snapshots)"),
    "c01_representative_price": twin("SELECT brand, snapshot_date, list_sort(list(price) FILTER (price > 0))[len(list(price) FILTER (price > 0)) // 2 + 1] AS repr_price FROM snapshots GROUP BY 1, 2"),
    "c02_representative_baseline": twin("SELECT brand, snapshot_date, list_sort(list(first_observed_price) FILTER (first_observed_price > 0))[len(list(first_observed_price) FILTER (first_observed_price > 0)) // 2 + 1] AS repr_baseline FROM snapshots GROUP BY 1, 2"),
    "c03_daily_snapshots": twin("SELECT product_id, snapshot_date, arg_max_null(price, (recorded_at, event_id)) AS price, arg_min_null(compare_at_price, (recorded_at, event_id)) AS compare_at_price, count(*) AS sightings FROM observations GROUP BY 1, 2"),
    "c04_last_prices": twin(f"SELECT brand, product_id, snapshot_date, price FROM (SELECT *, max(snapshot_date) OVER (PARTITION BY brand) AS last FROM snapshots WHERE snapshot_date BETWEEN {D} - 14 AND {D}) WHERE snapshot_date = last"),
    "c05_price_events": twin("SELECT event_id, product_id, price_before, price_after, direction, discount_pct FROM price_events"),
    "c06_stock_transitions": twin(f"""SELECT event_id, product_id AS variant_id, product_id, CASE WHEN s THEN 'restock' ELSE 'stockout' END AS event_type, price AS price_at_event, CASE WHEN price < first_observed_price THEN {r('100::DOUBLE * (first_observed_price - price) / first_observed_price')} END AS discount_pct_at_event, price < first_observed_price AS was_on_discount, recorded_at, true AS witnessed
        FROM (SELECT *, lag(s) OVER (PARTITION BY product_id ORDER BY recorded_at, event_id) AS was FROM (SELECT *, event_type = 'signup' AS s FROM observations WHERE event_type IN ('error', 'signup')) JOIN (SELECT product_id, arg_min(price, (recorded_at, event_id)) AS first_observed_price FROM observations GROUP BY 1) USING (product_id)) WHERE was <> s"""),
    "c07_needs_write": twin("""SELECT p.variant_id IS NULL OR p.delisted_at IS NOT NULL OR n.is_in_stock IS DISTINCT FROM p.is_in_stock OR (n.first_observed_price IS NULL) <> (p.first_observed_price IS NULL) OR coalesce(abs(n.first_observed_price - p.first_observed_price) > 0.001::DOUBLE, false) AS needs_write, variant_id FROM n LEFT JOIN p USING (variant_id)""", n=_STATE.format(""), p=_STATE.format("WHERE l_shipdate < '2001-06-01'")),
    "c08_seed_first_prices": twin("SELECT product_id, coalesce(f, m) AS first_observed_price FROM (SELECT product_id, min(price) AS m FROM snapshots WHERE price > 0 GROUP BY 1) FULL JOIN (SELECT product_id, arg_min(price, (recorded_at, event_id)) AS f FROM observations WHERE product_id % 2 = 0 GROUP BY 1) USING (product_id)"),
    "c09_delist_stale": twin(f"SELECT product_id, brand, 'delisted' AS event_type, 'not_a_stock_transition' AS seed_reason, DATE '{DELIST_AS_OF}' AS event_date, last_seen FROM shelf WHERE last_seen < DATE '{DELIST_AS_OF}' - 14 AND product_id % 7 <> 0"),
    "c10_reclassify_witnessed": twin(f"""SELECT event_id, variant_id, event_type, CASE WHEN reason IS NOT NULL THEN false ELSE witnessed END AS witnessed, reason, event_date FROM (SELECT *, CASE WHEN event_date > {D} - 9 AND witnessed THEN CASE WHEN event_type = 'delisted' THEN NULL WHEN event_type = 'restock' AND before = 'delisted' THEN 'delist_cycle' WHEN event_type = 'restock' AND coalesce(had, 0) = 0 THEN 'orphan_restock' WHEN event_type = before THEN 'duplicate_transition' END END AS reason
        FROM (SELECT *, lag(event_type) OVER w AS before, max(CAST(event_type = 'stockout' AS INTEGER)) OVER (PARTITION BY variant_id ORDER BY recorded_at, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS had FROM stock_events WINDOW w AS (PARTITION BY variant_id ORDER BY recorded_at, event_id)))"""),
    "c10_reclassify_from_summary": "",
    "c11_fill_department": twin("SELECT product_id, category_normalized, CASE WHEN p_size % 2 = 0 THEN department WHEN category_normalized = 'standard' THEN 'basics' WHEN category_normalized = 'promo' THEN 'offers' END AS department FROM catalogue"),
    "c11_fill_report": twin("SELECT count(*) FILTER (category_normalized IN ('standard', 'promo')) AS filled, count(*) FILTER (category_normalized NOT IN ('standard', 'promo')) AS still_null FROM catalogue WHERE p_size % 2 <> 0"),
    "c12_match_alerts": twin("""SELECT DISTINCT c_custkey AS user_id, product_id, brand, category_normalized AS category, ['S', 'M', 'L', 'XL'][event_id % 4 + 1] AS size, price_after, discount_pct FROM price_events JOIN customer ON event_id % 4 = c_custkey % 4 AND brand = 'Brand#' || (c_custkey % 5 + 1) || (c_nationkey % 5 + 1)
        WHERE direction = 'down' AND round(discount_pct) >= 10 AND price_after < first_observed_price AND c_acctbal > 0 AND (c_custkey % 3 <> 0 OR price_after <= c_acctbal)"""),
    "c18_flash_sales": twin(f"SELECT event_id, product_id FROM price_events d WHERE direction = 'down' AND event_id % 7 <> 0 AND recorded_at > {D} - INTERVAL 48 HOUR AND EXISTS (SELECT 1 FROM price_events u WHERE u.product_id = d.product_id AND u.direction = 'up' AND u.recorded_at > d.recorded_at AND u.recorded_at < d.recorded_at + INTERVAL 24 HOUR)"),
    "c19_statistical_deals": twin(f"SELECT event_id, product_id, brand, price_after, q1, q3, event_date FROM price_events JOIN (SELECT product_id, p[len(p) // 4 + 1] AS q1, p[3 * len(p) // 4 + 1] AS q3 FROM (SELECT product_id, list_sort(list(price)) AS p FROM snapshots WHERE snapshot_date >= {D} - 30 AND snapshot_date <= {D} GROUP BY 1) WHERE len(p) >= 10) USING (product_id) WHERE direction = 'down' AND event_id % 9 <> 0 AND recorded_at > {D} - INTERVAL 720 HOUR AND (SELECT min(snapshot_date) FROM snapshots) <= {D} - 30 AND price_after < q1 - 1.5::DOUBLE * (q3 - q1)"),
    "c20_fx_context": twin("SELECT event_id, event_date, rate FROM price_events ASOF LEFT JOIN (SELECT DATE '2023-12-25' + CAST(o_orderkey % 40 AS INTEGER) AS rate_date, max(o_totalprice) AS rate FROM orders GROUP BY 1) x ON event_date >= rate_date"),
}


_LISTED = f"SELECT v.*, last_seen, brand, last_seen < DATE '{DELIST_AS_OF}' - 14 AND product_id % 7 <> 0 AS gone FROM v LEFT JOIN shelf USING (product_id)"
SQL |= {
    "b02_discount_at_variant_grain": twin(f"SELECT product_id, base_price, last_price, CASE WHEN base_price >= last_price THEN {r('100::DOUBLE * (base_price - last_price) / base_price')} END AS honest_discount_pct FROM (SELECT product_id, min(v.first_observed_price) AS base_price FROM v JOIN shelf USING (product_id) WHERE delisted_at IS NULL AND last_seen >= DATE '2001-06-01' AND v.first_observed_price > 0 GROUP BY 1) JOIN (SELECT product_id, last_price FROM shelf) USING (product_id)", v=_STATE.format("")),
    "c08_seed_variant_baselines": twin("SELECT variant_id, product_id, coalesce(k, f) AS first_observed_price FROM (SELECT l_partkey * 100000 + l_suppkey AS variant_id, l_partkey AS product_id, arg_min(l_extendedprice, (l_shipdate, l_extendedprice)) AS f FROM lineitem WHERE l_extendedprice > 0 GROUP BY 1, 2) LEFT JOIN (SELECT variant_id, first_observed_price AS k FROM p WHERE product_id % 2 = 0) USING (variant_id)", p=_STATE.format("WHERE l_shipdate < '2001-06-01'")),
    "c08_seed_product_baselines": twin("SELECT product_id, coalesce(CASE WHEN product_id % 2 = 0 THEN first_observed_price END, f) AS first_observed_price FROM (SELECT l_partkey AS product_id, min(l_extendedprice) AS f FROM lineitem JOIN (SELECT l_partkey AS k, min(l_shipdate) AS first FROM lineitem GROUP BY 1) ON k = l_partkey AND first = l_shipdate GROUP BY 1) JOIN (SELECT product_id, first_observed_price FROM shelf) USING (product_id)"),
    "c09_delist_products": twin(f"SELECT product_id, brand, last_seen, product_id % 7 <> 0 AND last_seen >= DATE '{DELIST_AS_OF}' - 14 AS is_active FROM shelf"),
    "c09_delist_variants": twin(f"SELECT variant_id, product_id, is_in_stock, CASE WHEN delisted_at IS NULL AND gone THEN DATE '{DELIST_AS_OF}' ELSE CAST(delisted_at AS DATE) END AS delisted_at FROM ({_LISTED})", v=_STATE.format("")),
    "c09_delist_events": twin(f"SELECT variant_id, product_id, brand, 'delisted' AS event_type, 'not_a_stock_transition' AS seed_reason, DATE '{DELIST_AS_OF}' AS event_date FROM ({_LISTED}) WHERE gone AND delisted_at IS NULL", v=_STATE.format("")),
}
SQL["c10_reclassify_from_summary"] = f"SELECT * FROM ({SQL['c10_reclassify_witnessed']}) WHERE event_date > {D} - 9"


def queries() -> dict:
    return {name: (lambda spark, sf_dir, f=f: f(Shop(spark, sf_dir))) for name, f in QUERIES.items()}

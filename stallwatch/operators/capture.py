"""Change capture: observed variant rows become snapshots, price events and stock events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallwatch.functions.columns import percent, round_to
from stallwatch.operators.selection import order_statistics


def representative_prices(variants: DataFrame, keys: list[str]) -> DataFrame:
    """Upper median of positive prices per key, not interpolated; null where a key has none."""
    return _upper_medians(variants, keys, "price", "repr_price")


def representative_baselines(variants: DataFrame, keys: list[str]) -> DataFrame:
    """The same of the variants' first observed prices."""
    return _upper_medians(variants, keys, "first_observed_price", "repr_baseline")


def _upper_medians(variants: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    good = variants.select(*keys, F.when(F.col(value) > 0, F.col(value)).alias("value"))
    found = order_statistics(good, keys, "value", lambda n: [F.floor(n / 2)]).select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("values")[0].alias(name))
    groups = variants.select(*keys).distinct()
    return groups.join(found, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left").select(*keys, name)


def daily_snapshots(observations: DataFrame) -> DataFrame:
    """Close-of-day price per product and day; the advertised price of the day's first observation."""
    at = F.struct("recorded_at", "event_id")
    return observations.groupBy("product_id", "snapshot_date").agg(F.max_by("price", at).alias("price"), F.min_by("compare_at_price", at).alias("compare_at_price"), F.count("*").alias("sightings"))


def last_prices(snapshots: DataFrame, as_of: str, lookback: int = 14) -> DataFrame:
    """Each brand's prices on its most recent day with data in the lookback; none beyond it."""
    day = F.lit(as_of).cast("date")
    rows = snapshots.where((F.col("snapshot_date") <= day) & (F.col("snapshot_date") >= F.date_sub(day, lookback)))
    return rows.join(rows.groupBy("brand").agg(F.max("snapshot_date").alias("snapshot_date")), ["brand", "snapshot_date"], "left_semi").select("brand", "product_id", "snapshot_date", "price")


def stock_transitions(observations: DataFrame) -> DataFrame:
    """A change of the stock flag of a variant; the first sighting emits nothing. Provisionally witnessed."""
    w = Window.partitionBy("variant_id").orderBy("recorded_at", "event_id")
    rows = observations.withColumn("was", F.lag("is_in_stock").over(w)).where("was is not null and was <> is_in_stock")
    base, price = F.col("first_observed_price"), F.col("price")
    return rows.select("event_id", "variant_id", "product_id", F.when(F.col("is_in_stock"), "restock").otherwise("stockout").alias("event_type"), price.alias("price_at_event"), F.when(price < base, round_to(100.0 * (base - price) / base)).alias("discount_pct_at_event"), (price < base).alias("was_on_discount"), "recorded_at", F.lit(True).alias("witnessed"))


def needs_write(new: DataFrame, previous: DataFrame) -> DataFrame:
    """Incoming variants with whether they differ enough to be written: unseen, delisted before, stock flag changed,
    or a baseline that appeared, vanished or moved by more than 0.001. Size and colour do not count."""
    old = previous.select("variant_id", F.col("is_in_stock").alias("old_stock"), F.col("first_observed_price").alias("old_base"), F.col("delisted_at").alias("old_delisted"), F.lit(True).alias("known"))
    rows = new.join(old, "variant_id", "left")
    base, was = F.col("first_observed_price"), F.col("old_base")
    moved = (base.isNull() != was.isNull()) | F.coalesce(F.abs(base - was) > 0.001, F.lit(False))
    write = F.col("known").isNull() | F.col("old_delisted").isNotNull() | ~F.col("is_in_stock").eqNullSafe(F.col("old_stock")) | moved
    return rows.select(*new.columns, write.alias("needs_write"))


def seed_first_prices(variants: DataFrame, known: DataFrame) -> DataFrame:
    """Product baselines: the one that is known, else the smallest positive variant price. Never overwritten."""
    first = variants.where("price > 0").groupBy("product_id").agg(F.min("price").alias("seen"))
    return first.join(known, "product_id", "full").select("product_id", F.coalesce("first_observed_price", "seen").alias("first_observed_price"))


def seed_variant_baselines(sightings: DataFrame, known: DataFrame) -> DataFrame:
    """Variant baselines: the one that is known, else the positive price at the variant's first sighting. Never overwritten.

    sightings: product_id, variant_id, seen_at, price. known: variant_id, product_id, first_observed_price. Of several first prices the smallest.
    """
    first = sightings.where("price > 0").groupBy("variant_id", "product_id").agg(F.min(F.struct("seen_at", "price"))["price"].alias("seen"))
    return first.join(known, ["variant_id", "product_id"], "full").select("variant_id", "product_id", F.coalesce("first_observed_price", "seen").alias("first_observed_price"))


def seed_product_baselines(sightings: DataFrame, known: DataFrame) -> DataFrame:
    """Product baselines: the one that is known, else the smallest positive price of its variants when it was first seen; variants
    that come later do not lower it."""
    at_once = sightings.where("price > 0").groupBy("product_id", "seen_at").agg(F.min("price").alias("least"))
    first = at_once.groupBy("product_id").agg(F.min_by("least", "seen_at").alias("seen"))
    return first.join(known, "product_id", "full").select("product_id", F.coalesce("first_observed_price", "seen").alias("first_observed_price"))


def delist(products: DataFrame, variants: DataFrame, as_of: str, days: int = 14) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Products, variants and events after products that were not seen for ``days`` are taken off.

    Such a product is not active any more; its variants that were listed get delisted_at, and one event each with witnessed null, as
    this is no stock transition. Their stock flags stay as they were last seen. A second run changes nothing.
    """
    day = F.lit(as_of).cast("date")
    stale = F.coalesce(F.col("is_active") & (F.col("last_seen") < F.date_sub(day, days)), F.lit(False))
    gone = products.where(stale).select("product_id", F.col("brand").alias("__brand"), F.lit(True).alias("__gone"))
    marked = variants.join(gone, "product_id", "left")
    now = F.col("__gone").isNotNull() & F.col("delisted_at").isNull()
    kind = variants.schema["delisted_at"].dataType
    listed = marked.withColumn("delisted_at", F.when(now, day.cast(kind)).otherwise(F.col("delisted_at"))).select(*variants.columns)
    events = marked.where(now).select("variant_id", "product_id", F.col("__brand").alias("brand"), F.lit("delisted").alias("event_type"), F.lit(None).cast("boolean").alias("witnessed"), F.lit("not_a_stock_transition").alias("seed_reason"), day.alias("event_date"))
    return products.withColumn("is_active", F.col("is_active") & ~stale), listed, events


def delist_stale(products: DataFrame, as_of: str, days: int = 14) -> DataFrame:
    """One delisted event per product that is_active and was not seen for ``days``; witnessed stays null.

    Products delisted before are not active any more, so a second run gives nothing for them.
    """
    day = F.lit(as_of).cast("date")
    rows = products.where(F.col("is_active") & (F.col("last_seen") < F.date_sub(day, days)))
    return rows.select("product_id", "brand", F.lit("delisted").alias("event_type"), F.lit(None).cast("boolean").alias("witnessed"), F.lit("not_a_stock_transition").alias("seed_reason"), day.alias("event_date"), "last_seen")


def transition_summary(stock: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """What later transitions must know of a variant's earlier ones: the last one's type, time and id, and whether any was a stock-out.

    Summaries of one stretch of days and of the days after it make up that of both: pass the former as ``before``.
    """
    kind = F.col("event_type")
    rows = stock.select("variant_id", "recorded_at", "event_id", "event_type", (kind == "stockout").alias("had_stockout"))
    rows = rows if before is None else rows.unionByName(before)
    last = F.max(F.struct("recorded_at", "event_id", "event_type"))
    out = rows.groupBy("variant_id").agg(last.alias("last"), F.max(F.coalesce("had_stockout", F.lit(False))).alias("had_stockout"))
    return out.select("variant_id", "last.recorded_at", "last.event_id", "last.event_type", "had_stockout")


def reclassify_witnessed(stock: DataFrame, as_of: str, lookback: int = 9, before: DataFrame | None = None) -> DataFrame:
    """Reasons to stop trusting a transition, judged on the variant's whole history: a restock without any earlier
    stock-out, one type twice in a row, or a restock right after a delisting. Only the lookback's rows change.

    before: the ``transition_summary`` of all days before those of ``stock``, which need hold no more than the lookback then.
    """
    w = Window.partitionBy("variant_id").orderBy("recorded_at", "event_id")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = stock.withColumn("__out", F.col("event_type") == "stockout").withColumn("__own", F.lit(True))
    if before is not None:
        rows = rows.unionByName(before.withColumnRenamed("had_stockout", "__out").withColumn("__own", F.lit(False)), allowMissingColumns=True)
    rows = rows.withColumns({"before": F.lag("event_type").over(w), "had_stockout": F.coalesce(F.max(F.col("__out")).over(earlier), F.lit(False))}).where("__own")
    kind = F.col("event_type")
    reason = F.when(kind == "delisted", None).when((kind == "restock") & (F.col("before") == "delisted"), "delist_cycle").when((kind == "restock") & ~F.col("had_stockout"), "orphan_restock").when(kind == F.col("before"), "duplicate_transition")
    recent = F.col("event_date") > F.date_sub(F.lit(as_of).cast("date"), lookback)
    reason = F.when(recent & F.col("witnessed"), reason)
    return rows.withColumn("reason", reason).select("event_id", "variant_id", "event_type", F.when(F.col("reason").isNotNull(), False).otherwise(F.col("witnessed")).alias("witnessed"), "reason", "event_date")


def fill_department(products: DataFrame, mapping: DataFrame) -> DataFrame:
    """Departments only where they are missing, from the category's mapping."""
    known = mapping.select("category_normalized", F.col("department").alias("__department"))
    return products.join(known, "category_normalized", "left").withColumn("department", F.coalesce("department", "__department")).drop("__department")


def fill_report(products: DataFrame, mapping: DataFrame) -> DataFrame:
    """How many departments the mapping fills, and how many stay null: one row."""
    rows = fill_department(products.withColumn("__before", F.col("department")), mapping)
    gone = F.col("department").isNull()
    return rows.agg(F.count_if(F.col("__before").isNull() & ~gone).alias("filled"), F.count_if(gone).alias("still_null"))


def subscribers(users: DataFrame, user_sizes: DataFrame, user_brands: DataFrame) -> DataFrame:
    """Whom to tell: one row per active user, brand, category and size, with the user's ceiling; where a user has several, the highest."""
    active = users.where("is_active").groupBy("user_id").agg(F.when(F.count_if(F.col("price_ceiling").isNull()) == 0, F.max("price_ceiling")).alias("price_ceiling"))
    return user_brands.select("user_id", "brand").distinct().join(active, "user_id").join(user_sizes.select("user_id", "category", "size").distinct(), "user_id")


def alert_drops(drops: DataFrame, min_discount: int = 10) -> DataFrame:
    """What to tell of: one row per product, size in stock, price and discount that is deep enough."""
    rows = drops.where((F.round("discount_pct") >= min_discount) & (F.col("price_after") < F.col("first_observed_price")))
    return rows.select("product_id", "brand", F.col("category_normalized").alias("category"), F.explode("sizes_in_stock").alias("size"), "price_after", "discount_pct").distinct()


def meet(drops: DataFrame, wanted: DataFrame, slices: int = 8, block: int = 256) -> DataFrame:
    """Every alert of ``alert_drops`` and ``subscribers``. No pair comes twice, as neither side holds a row twice, so the pairs, of
    which there are as many as drops times followers, are neither moved nor sorted. Brands, categories and sizes are few: followers
    are dealt into slices, each of which meets all drops of its kind, and the tasks are many however few bytes go in.

    The followers of a slice come in blocks, by their ceilings, and a block meets one drop after another: a drop's values stay the same
    over a block, and the same short run of users comes again and again. So a pair takes few bytes in a column format, and no more of
    them when drops and followers grow."""
    spark, keys = drops.sparkSession, ["brand", "category", "size", "__slice"]
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), slices * spark.sparkContext.defaultParallelism)
    people = wanted.withColumn("__slice", F.pmod(F.xxhash64("user_id"), F.lit(slices)).cast("int")).repartition(n, *keys)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("price_ceiling", "user_id")) - 1
    people = people.withColumn("__block", F.floor(place / block)).groupBy(*keys, "__block")
    blocks = people.agg(F.sort_array(F.collect_list(F.struct("price_ceiling", "user_id"))).alias("__people"), F.min("price_ceiling").alias("__least"))
    blocks = blocks.withColumn("__users", F.col("__people.user_id"))
    told = drops.withColumn("__slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).repartition(n, *keys)
    # Few blocks hold ceilings on both sides of a price; only these are looked through.
    able = F.filter("__people", lambda p: p["price_ceiling"].isNull() | (F.col("price_after") <= p["price_ceiling"]))["user_id"]
    whole = F.col("__least").isNull() | (F.col("price_after") <= F.col("__least"))
    rows = blocks.join(told.hint("merge"), keys).withColumn("__able", F.when(whole, F.col("__users")).otherwise(able))
    return rows.select(F.explode("__able").alias("user_id"), "product_id", "brand", "category", "size", "price_after", "discount_pct")


def match_alerts(drops: DataFrame, users: DataFrame, user_sizes: DataFrame, user_brands: DataFrame, min_discount: int = 10) -> DataFrame:
    """Active users to tell of a drop: the discount, their size in stock in that category, their ceiling, a brand they follow."""
    return meet(alert_drops(drops, min_discount), subscribers(users, user_sizes, user_brands))


def bestseller_ranks(listing: DataFrame, products: DataFrame, max_rank: int = 150, existing: DataFrame | None = None) -> DataFrame:
    """Positions of a brand-day's listing, products that are not known left out, and brand-days that ``existing`` ranks hold."""
    rows = listing.where(F.col("rank").between(1, max_rank)).join(products.select("product_id"), "product_id", "left_semi").select("product_id", "brand", "rank", "snapshot_date")
    return rows if existing is None else rows.join(existing.select("brand", "snapshot_date").distinct(), ["brand", "snapshot_date"], "left_anti").select(*rows.columns)


def flatten_variants(products: DataFrame) -> DataFrame:
    """Variants of nested products as rows: positive prices only, "default title" is no size, and the option
    that looks more like sizes (letters, or numbers 4 to 56) is the size."""
    token = r"(?i)^(xxs|xs|s|m|l|xl|xxl|xxxl|[2-5]xl|one size|os)$"

    def points(option: Column) -> Column:
        distinct = F.array_distinct(F.transform("variants", lambda v: option(v)))
        score = F.transform(distinct, lambda x: F.when(F.trim(x).rlike(token), 10).when(F.trim(x).rlike("^[0-9]{1,2}$") & F.trim(x).try_cast("int").between(4, 56), 5).otherwise(0))
        return F.aggregate(score, F.lit(0), lambda a, x: a + x) * 1000 + F.size(distinct)

    swapped = points(lambda v: v["option2"]) > points(lambda v: v["option1"])
    rows = products.withColumn("swapped", swapped).withColumn("v", F.explode("variants")).where("v.price > 0")
    size = F.when(F.col("swapped"), F.col("v.option2")).otherwise(F.col("v.option1"))
    color = F.when(F.col("swapped"), F.col("v.option1")).otherwise(F.col("v.option2"))
    return rows.select("product_id", F.col("v.sku").alias("external_sku"), F.when(F.lower(F.trim(size)) != "default title", size).alias("size"), color.alias("color"), F.col("v.price").alias("price"), F.col("v.available").alias("is_in_stock"))


def crawl_shortfall(log: DataFrame, catalogue: DataFrame, page: int = 250, gap: int = 50, share: float = 0.85) -> DataFrame:
    """Crawls that ended too soon: a full last page, or far fewer products than the active catalogue."""
    rows = log.join(catalogue.groupBy("brand").agg(F.count("*").alias("active")), "brand", "left").withColumn("active", F.coalesce("active", F.lit(0)))
    short = (F.col("active") - F.col("seen") >= gap) & (F.col("seen") < share * F.col("active"))
    return rows.withColumn("suspicious", (F.col("last_page") >= page) | short)


def minor_unit_price(text: Column, unit: int = 2) -> Column:
    return text.try_cast("long") / float(10**unit)


def text_price(text: Column) -> Column:
    return F.nullif(F.regexp_replace(text, r"[^0-9.]", ""), F.lit("")).try_cast("double")


def resolve_price(badges: Column, discounted: Column, full: Column, old: Column, flagged: Column) -> Column:
    """Lowest badge price that is shown, else the discounted one, else the smaller of full and old if flagged, else full."""
    shown = F.array_min(F.transform(F.filter(badges, lambda b: b["shown"] & (b["price"] > 0)), lambda b: b["price"]))
    return F.coalesce(shown, discounted, F.when(flagged, F.least(full, old)), full)


def resolve_compare_at(badge_price: Column, list_price: Column, prior: Column, price: Column) -> Column:
    """List price beside a badge, else the highest earlier price; only if clearly above the price."""
    found = F.when(badge_price.isNotNull(), list_price).otherwise(F.array_max(prior))
    return F.when(found > 1.01 * price, found)


def statistical_deals(events: DataFrame, snapshots: DataFrame, now: str, min_rows: int = 10, days: int = 30, recent_hours: int = 8, k: float = 1.5) -> DataFrame:
    """Cuts of the last hours, not flagged yet, under the fence of nearest-rank quartiles of the last month.

    Nothing while the snapshots reach back less than the month. The quartiles are not interpolated.
    """
    at = F.lit(now).cast("timestamp")
    day = F.to_date(at)
    past = snapshots.where((F.col("snapshot_date") >= F.date_sub(day, days)) & (F.col("snapshot_date") <= day)).groupBy("product_id").agg(F.array_sort(F.collect_list("price")).alias("p")).where(F.size("p") >= min_rows)
    n = F.size("p")
    past = past.select("product_id", F.element_at("p", (F.floor(n / 4) + 1).cast("int")).alias("q1"), F.element_at("p", (F.floor(3 * n / 4) + 1).cast("int")).alias("q3"))
    oldest = snapshots.agg(F.min("snapshot_date").alias("__oldest"))
    cuts = events.where((F.col("direction") == "down") & ~F.col("is_statistical_deal") & (F.col("recorded_at") > at - F.expr(f"INTERVAL {recent_hours} HOURS")))
    cuts = cuts.crossJoin(F.broadcast(oldest)).where(F.datediff(day, "__oldest") >= days)  # one row
    return cuts.join(past, "product_id").where(F.col("price_after") < F.col("q1") - k * (F.col("q3") - F.col("q1"))).select("event_id", "product_id", "brand", "price_after", "q1", "q3", "event_date")


def with_fx(events: DataFrame, rates: DataFrame) -> DataFrame:
    """The last rate on or before the event's day. Rates are one row per day; each distinct event day meets those before it.

    Both sides of that join are calendar days; the events themselves move once, by day.
    """
    days = events.select("event_date").distinct().join(rates, F.col("rate_date") <= F.col("event_date"), "left").groupBy("event_date").agg(F.max_by("rate", "rate_date").alias("rate"))
    return events.join(days, "event_date", "left")


def discount_share(events: DataFrame) -> DataFrame:
    return events.groupBy("brand").agg(F.count("*").alias("events"), percent(F.count_if(F.col("direction") == "down"), F.count("*")).alias("down_pct"))

"""Checks on landed data. Each returns rows with a status; nothing is fixed here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallwatch.functions.columns import first_match, percent, read_bands, round_to, window_of


def freshness(df: DataFrame, day: str, as_of: str) -> DataFrame:
    rows = df.groupBy("brand").agg(F.max(day).alias("last_day")).withColumn("days_old", F.datediff(F.lit(as_of).cast("date"), "last_day"))
    return rows.withColumn("status", read_bands(F.col("days_old"), [(3, "FAIL"), (2, "WARN")], "OK"))


def volume_drop(snapshots: DataFrame, as_of: str, days: int = 14, min_days: int = 7) -> DataFrame:
    """The latest complete day's rows against the median of the days before."""
    counts = window_of(snapshots, "snapshot_date", as_of, days + 1).where(F.col("snapshot_date") < F.lit(as_of).cast("date")).groupBy("brand", "snapshot_date").agg(F.count("*").alias("n"))
    w = Window.partitionBy("brand").orderBy(F.desc("snapshot_date"))
    counts = counts.withColumn("k", F.row_number().over(w))
    rows = counts.groupBy("brand").agg(F.max(F.when(F.col("k") == 1, F.col("n"))).alias("latest"), F.percentile(F.when(F.col("k") > 1, F.col("n")), F.lit(0.5)).alias("median"), F.count("*").alias("days")).where(F.col("days") >= min_days)
    ratio = F.col("latest") / F.col("median")
    return rows.withColumn("status", first_match([(ratio < 0.5, "FAIL"), (ratio < 0.75, "WARN")], "OK"))


def integrity(snapshots: DataFrame, products: DataFrame, variants: DataFrame, limit: int = 100) -> DataFrame:
    """Counts that must be zero: one row per check. A variant that is written after it was delisted should have lost the mark."""
    known = products.select("product_id")

    def orphans(df: DataFrame, check: str) -> DataFrame:
        return df.join(known, "product_id", "left_anti").agg(F.lit(check).alias("check"), F.count("*").alias("n"))

    def broken(df: DataFrame, **bad: Column) -> DataFrame:
        return df.agg(*[F.count_if(cond).alias(name) for name, cond in bad.items()]).unpivot([], list(bad), "check", "n")

    rows = orphans(snapshots, "orphan_snapshots").unionByName(orphans(variants, "orphan_variants"))
    rows = rows.unionByName(broken(snapshots, bad_prices=F.col("price").isNull() | (F.col("price") <= 0)))
    rows = rows.unionByName(broken(variants, null_baselines=F.col("first_observed_price").isNull() & F.col("delisted_at").isNull(), written_after_delist=F.col("last_updated_at") > F.col("delisted_at")))
    return rows.withColumn("status", first_match([(F.col("n") > limit, "FAIL"), (F.col("n") > 0, "WARN")], "OK"))


def unclassified_events(stock: DataFrame, as_of: str, days: int = 9) -> DataFrame:
    old = F.col("event_date") < F.date_sub(F.lit(as_of).cast("date"), days)
    return stock.where(F.col("event_type").isin("stockout", "restock")).groupBy("brand").agg(F.count_if(F.col("witnessed").isNull() & old).alias("unclassified"), F.count("*").alias("events"))


def event_liveness(events: DataFrame, as_of: str, days: int = 3) -> DataFrame:
    rows = events.groupBy("brand").agg(F.count_if(F.col("event_date") > F.date_sub(F.lit(as_of).cast("date"), days)).alias("recent"))
    return rows.withColumn("status", F.when(F.col("recent") == 0, "FAIL").otherwise("OK"))


def frozen_prices(snapshots: DataFrame, events: DataFrame, as_of: str, min_products: int = 500, min_days: int = 5, alive: int = 10) -> DataFrame:
    """Brands whose prices stand still for a week and that show no sale either.

    Not frozen: a tenth of the products rose within a month (a sale that ended), or some of them moved at all (quiet, not blind).
    """
    sale = F.coalesce(F.col("compare_at_price") > 1.01 * F.col("price"), F.lit(False))
    own = window_of(snapshots, "snapshot_date", as_of, 8).groupBy("brand", "product_id").agg(F.countDistinct("snapshot_date").alias("days"), F.countDistinct("price").alias("prices")).where(F.col("days") >= min_days)
    rows = own.groupBy("brand").agg(F.count("*").alias("products"), F.count_if(F.col("prices") == 1).alias("still"), F.max("days").alias("days")).where(F.col("products") > min_products)
    now = window_of(snapshots, "snapshot_date", as_of, 3).groupBy("brand", "product_id").agg(F.max_by(sale, "snapshot_date").alias("sale")).groupBy("brand").agg(F.count("*").alias("seen"), F.count_if("sale").alias("on_sale"))
    moves = window_of(events, "event_date", as_of, 30).groupBy("brand").agg(F.countDistinct(F.when(F.col("direction") == "up", F.col("product_id"))).alias("ups"), F.countDistinct("product_id").alias("moved"))
    counts = ("seen", "on_sale", "ups", "moved")
    rows = rows.join(now, "brand", "left").join(moves, "brand", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    n = F.col("products")
    quiet = (F.col("ups") >= 0.1 * n) | (F.col("moved") >= alive)
    return rows.withColumn("frozen", (F.col("still") >= 0.95 * n) & ((F.col("seen") == 0) | (F.col("on_sale") < 0.05 * F.col("seen"))) & ~quiet)


def table_health(name: str, df: DataFrame, day: str, as_of: str, metrics: list[str], expected_brands: int | None, runs: DataFrame, stale_at: int = 4) -> DataFrame:
    """Score and flags of a result table, from one pass over it and the latest run of the signal of its name.

    ``metrics``: the columns that carry its numbers, less those that are null by design. ``expected_brands``: None for a
    table of the whole market. A table without rows scores 0; one without a run counts 0.7 for it.
    """
    absent = [F.col(m).isNull() for m in metrics]
    every = absent[0]
    for a in absent[1:]:
        every = every & a
    orphan = F.count_if(F.col(day).isNull()) + (F.lit(0) if expected_brands is None else F.count_if(F.col("brand").isNull()))
    brands = F.lit(0).cast("long") if expected_brands is None else F.countDistinct("brand")
    row = df.agg(F.lit(name).alias("table"), F.count("*").alias("n_rows"), F.max(day).alias("last_day"), F.countDistinct(day).alias("days"), brands.alias("brands"), orphan.alias("orphan_rows"), F.count_if(every).alias("empty_rows"), F.array(*[F.count_if(a) for a in absent]).alias("nulls"))
    last = run_health(runs.where(F.col("signal_id") == name)).select(F.col("signal_id").alias("table"), F.col("status").alias("run_status"), "empty_rerun")
    row = row.join(last, "table", "left")  # one row each
    n, worst = F.greatest(F.col("n_rows"), F.lit(1)), F.array_max("nulls")
    dead = first_match([((F.col("nulls")[i] == worst) & (worst > 0), m) for i, m in enumerate(metrics)])
    row = row.withColumns({"empty_rate": F.col("empty_rows") / n, "worst_rate": worst / n, "worst_column": dead, "days_old": F.datediff(F.lit(as_of).cast("date"), "last_day"), "share": F.lit(1.0) if expected_brands is None else F.least(F.col("brands") / F.lit(float(expected_brands)), F.lit(1.0))})
    old, rerun = F.col("days_old"), F.coalesce("empty_rerun", F.lit(False))
    fresh = first_match([(old.isNull(), 0.5), (old >= stale_at, 0.0), (old >= max(2, stale_at - 2), 0.5)], 1.0)
    run = F.least(first_match([(F.col("run_status").isNull(), 0.7), (F.col("run_status") == "error", 0.0), (F.col("run_status") == "skipped", 0.4)], 1.0), F.when(rerun, 0.7).otherwise(1.0))
    whole = F.when(F.col("orphan_rows") > 0, 0.0).otherwise(1.0 - F.least(F.col("empty_rate") / 0.25, F.lit(1.0)))
    whole = F.when(F.col("worst_rate") >= 0.9, F.least(whole, F.lit(0.8))).otherwise(whole)
    score = 100.0 * (0.3 * fresh + 0.2 * run + 0.2 * whole + 0.15 * F.col("share") + 0.15 * F.least(F.col("days") / 30.0, F.lit(1.0)))
    flags = [
        (F.col("n_rows") == 0, "critical: no rows"), (old >= stale_at, "critical: stale"), ((old < stale_at) & (old >= max(2, stale_at - 2)), "warn: stale"), (F.col("share") < 0.4, "warn: few brands"), (F.col("orphan_rows") > 0, "critical: orphan rows"),
        (F.col("empty_rate") >= 0.05, "critical: empty rows"), (F.col("worst_rate") >= 0.9, "warn: dead column"), (F.col("run_status") == "error", "critical: run failed"), (F.col("run_status") == "skipped", "warn: run skipped"), (rerun, "warn: a later run wrote nothing"),
    ]
    return row.select(
        "table", "n_rows", "last_day", "days", "brands", "orphan_rows", "empty_rows", "worst_column", round_to(F.col("worst_rate"), 3).alias("worst_rate"), "run_status",
        F.concat_ws("; ", *[F.when(cond, text) for cond, text in flags]).alias("flags"), F.when(F.col("n_rows") == 0, 0.0).otherwise(round_to(score, 0)).alias("score"),
    )


def run_health(runs: DataFrame) -> DataFrame:
    """Each signal's latest run, and whether a later run of that day wrote nothing after one that did."""
    w = Window.partitionBy("signal_id").orderBy(F.desc("run_at"))
    day = Window.partitionBy("signal_id", F.to_date("run_at"))
    rows = runs.withColumns({"k": F.row_number().over(w), "most": F.max("rows_written").over(day)}).where("k = 1")
    return rows.select("signal_id", "status", "rows_written", "run_at", ((F.col("rows_written") == 0) & (F.col("most") > 0)).alias("empty_rerun"))


def _against_baseline(snapshots: DataFrame, variants: DataFrame) -> DataFrame:
    first = snapshots.where("price > 0").groupBy("product_id").agg(F.min_by("price", F.struct("snapshot_date", "recorded_at")).alias("earliest"), F.min("snapshot_date").alias("first_day"))
    base = variants.where("first_observed_price > 0").groupBy("product_id").agg(F.min("first_observed_price").alias("base"))
    return first.join(base, "product_id")


def baseline_immutability(snapshots: DataFrame, variants: DataFrame) -> DataFrame:
    """The earliest price of each product against its stored baseline."""
    base, seen = F.col("base"), F.col("earliest")
    row = _against_baseline(snapshots, variants).agg(F.count("*").alias("products"), F.count_if(F.abs(base - seen) < 0.01).alias("match"), F.count_if(base > seen + 0.01).alias("base_higher"), F.count_if(base < seen - 0.01).alias("base_lower"))
    return row.withColumn("match_pct", percent(F.col("match"), F.col("products")))


def baseline_mismatches(snapshots: DataFrame, variants: DataFrame, top: int = 10) -> DataFrame:
    """The products whose baseline is farthest from their earliest price."""
    gap = F.abs(F.col("base") - F.col("earliest"))
    return _against_baseline(snapshots, variants).where(gap >= 0.01).orderBy(F.desc(gap), "product_id").limit(top)


def empty_run_guard(crawls: DataFrame) -> DataFrame:
    """An alert if many brands of a run saw nothing."""
    row = crawls.agg(F.count("*").alias("brands"), F.count_if(F.col("seen") == 0).alias("empty"), F.count_if("partial").alias("partial"))
    bound = F.least(F.col("brands"), F.greatest(F.lit(3), F.ceil(0.4 * F.col("brands"))))
    return row.withColumns({"alert": F.col("empty") >= bound, "warning": F.col("partial") >= 2})


def discount_capture(snapshots: DataFrame, events: DataFrame, as_of: str, days: int = 7, min_rows: int = 500, min_days: int = 5, alive: int = 10) -> DataFrame:
    """Brands without one discounted row, though often seen; excused if enough of their products moved in a month."""
    sale = F.count_if(F.coalesce(F.col("compare_at_price") > 1.01 * F.col("price"), F.lit(False)))
    rows = window_of(snapshots, "snapshot_date", as_of, days).groupBy("brand").agg(F.count("*").alias("n_rows"), sale.alias("discounted"), F.countDistinct("snapshot_date").alias("days")).where(F.col("n_rows") > min_rows)
    moved = window_of(events, "event_date", as_of, 30).groupBy("brand").agg(F.countDistinct("product_id").alias("moved"))
    blind = (F.col("discounted") == 0) & (F.col("days") >= min_days)
    rows = rows.join(moved, "brand", "left").withColumn("moved", F.coalesce("moved", F.lit(0)))
    return rows.withColumn("status", first_match([(blind & (F.col("moved") >= alive), "INFO"), (blind, "FAIL")], "OK"))


def signal_freshness(tables: dict[str, tuple[DataFrame, str, int]], runs: DataFrame, as_of: str) -> DataFrame:
    """Last day of each result table (frame, day column, limit in days); a good run within the limit excuses an old one.

    ``runs``: (signal_id, run_date, status).
    """
    day = F.lit(as_of).cast("date")
    frames = [df.agg(F.lit(name).alias("signal_id"), F.max(c).alias("last_day"), F.count("*").alias("n_rows")).withColumn("day_limit", F.lit(limit)) for name, (df, c, limit) in tables.items()]
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.unionByName(f)
    good = runs.where("status = 'ok'").groupBy("signal_id").agg(F.max("run_date").alias("last_ok"))
    rows = rows.join(good, "signal_id", "left").withColumn("days_old", F.datediff(day, "last_day"))
    alive = F.coalesce(F.datediff(day, "last_ok") <= F.col("day_limit"), F.lit(False))
    return rows.withColumn("status", first_match([(F.col("n_rows") == 0, "WARN"), ((F.col("days_old") >= F.col("day_limit")) & ~alive, "FAIL")], "OK"))


def bestseller_feed(ranks: DataFrame, as_of: str, recent: int = 2, days: int = 21) -> DataFrame:
    """Brands of the last days against the typical number in a day: one row."""
    day = F.lit(as_of).cast("date")
    rows = ranks.where((F.col("snapshot_date") >= F.date_sub(day, days)) & (F.col("snapshot_date") <= day))
    now = rows.where(F.col("snapshot_date") >= F.date_sub(day, recent)).agg(F.countDistinct("brand").alias("brands"))
    typical = rows.groupBy("snapshot_date").agg(F.countDistinct("brand").alias("n")).agg(F.percentile("n", F.lit(0.5)).alias("typical"))
    out = now.crossJoin(F.broadcast(typical))  # one row each
    return out.withColumn("status", F.when(F.col("brands") < 0.5 * F.col("typical"), "FAIL").otherwise("OK"))


def substrate(products: DataFrame, variants: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Counts of the base tables and what must be zero in them: (measure, value)."""

    def long(df: DataFrame, **measures: Column) -> DataFrame:
        row = df.agg(*[m.cast("double").alias(n) for n, m in measures.items()])
        return row.unpivot([], list(measures), "measure", "value")

    missing = F.count_if(F.col("first_observed_price").isNull())
    return (
        long(products, products=F.count("*"), active_brands=F.countDistinct(F.when(F.col("is_active"), F.col("brand"))))
        .unionByName(long(variants, variants=F.count("*"), delisted_in_stock=F.count_if(F.col("delisted_at").isNotNull() & F.col("is_in_stock")), missing_baseline=missing, baseline_coverage_pct=percent(F.count("*") - missing, F.count("*"))))
        .unionByName(long(snapshots, snapshots=F.count("*"), snapshot_brands=F.countDistinct("brand"), bad_prices=F.count_if(F.col("price") <= 0)))
    )

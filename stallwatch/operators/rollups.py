"""Weekly rollups. A week starts on Monday; each week is rebuilt on its own."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwatch.functions.columns import round_to
from stallwatch.operators.lake import days_of, differing_days, read_days, replace_days
from stallwatch.sources.day_files import list_days
from stallwatch.sources.shared import remove


def _week(ts: str):
    return F.to_date(F.date_trunc("week", ts))


def weekly_product_summary(snapshots: DataFrame, events: DataFrame, stock: DataFrame) -> DataFrame:
    key = ["product_id", "week_start"]
    prices = snapshots.groupBy("product_id", "brand", "category_normalized", "gender", "first_observed_price", _week("snapshot_date").alias("week_start")).agg(
        round_to(F.percentile("price", F.lit(0.5))).alias("price_median"), F.min("price").alias("price_min"), F.max("price").alias("price_max"), F.min_by("price", "snapshot_date").alias("price_open"), F.max_by("price", "snapshot_date").alias("price_close"), F.count("*").alias("sample_days"),
    )
    cuts = events.where("direction = 'down' and discount_pct > 0").groupBy("product_id", _week("recorded_at").alias("week_start")).agg(F.count("*").alias("discount_event_count"), F.max("discount_pct").alias("max_discount_pct"), F.countDistinct("event_date").alias("days_on_discount"))
    trade = stock.where("witnessed").groupBy("product_id", _week("recorded_at").alias("week_start")).agg(F.count_if(F.col("event_type") == "stockout").alias("stockout_count"), F.count_if(F.col("event_type") == "restock").alias("restock_count"))
    counts = ("discount_event_count", "days_on_discount", "stockout_count", "restock_count")
    rows = prices.join(cuts, key, "left").join(trade, key, "left")
    return rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts}).withColumns({"iso_week": F.weekofyear("week_start"), "iso_year": F.year(F.date_add("week_start", 3))})


def weekly_variant_exception(stock: DataFrame, observed: DataFrame) -> DataFrame:
    """Variant weeks with transitions, or whose prices differ within the week. ``observed``: every price seen of a variant."""
    rows = stock.where("witnessed").select("variant_id", "product_id", "recorded_at", F.col("price_at_event").alias("price"), "event_type")
    rows = rows.unionByName(observed.select("variant_id", "product_id", "recorded_at", "price", F.lit(None).cast("string").alias("event_type")))
    weeks = rows.groupBy("variant_id", "product_id", _week("recorded_at").alias("week_start")).agg(F.count_if(F.col("event_type") == "stockout").alias("stockout_count"), F.count_if(F.col("event_type") == "restock").alias("restock_count"), F.min("price").alias("price_min"), F.max("price").alias("price_max"))
    return weeks.withColumn("price_diverged", F.col("price_max") - F.col("price_min") > 0.01).where("stockout_count > 0 or restock_count > 0 or price_diverged")


def weekly_bestseller_summary(ranks: DataFrame) -> DataFrame:
    rows = ranks.groupBy("product_id", "brand", "category_normalized", _week("snapshot_date").alias("week_start")).agg(F.min("rank").alias("rank_best"), F.max("rank").alias("rank_worst"), round_to(F.sum("rank") / F.count("*").cast("double"), 1).alias("rank_avg"), F.max_by("rank", "snapshot_date").alias("rank_close"), F.count("*").alias("sample_days"))
    before = rows.select("product_id", F.date_add("week_start", 7).alias("week_start"), F.col("rank_close").alias("was"))
    return rows.join(before, ["product_id", "week_start"], "left").withColumn("rank_change_vs_prev_week", F.col("was") - F.col("rank_close")).drop("was")


def pending_weeks(spark: SparkSession, as_of: str, window: int = 7) -> DataFrame:
    days = F.sequence(F.date_sub(F.lit(as_of).cast("date"), window), F.lit(as_of).cast("date"))
    return spark.range(1).select(F.explode(days).alias("day")).select(_week("day").alias("week_start")).distinct()


def purge_rolled_up(ranks: DataFrame, summary: DataFrame, as_of: str, keep_days: int = 21) -> DataFrame:
    """What stays: old ranks go only if their week is in the summary."""
    rows = ranks.withColumn("week_start", _week("snapshot_date"))
    old = rows.where(F.col("snapshot_date") < F.date_sub(F.lit(as_of).cast("date"), keep_days))
    done = old.join(summary.select("week_start").distinct(), "week_start", "left_semi").select("product_id", "snapshot_date")
    return ranks.join(done, ["product_id", "snapshot_date"], "left_anti")


def refresh_weeks(spark: SparkSession, build: Callable[[date, date], DataFrame], root: str, as_of: str, window: int = 7, week: str = "week_start") -> list[date]:
    """Builds the weeks that the last ``window`` days touch anew, each from all its days, and writes those that differ; returns these.

    build(first day, last day): the summary of the weeks between them, from its inputs' days of that range. The table is kept by week: no
    other week is read, and one whose rows are what they were, by the digest, keeps its files. A week whose rows are all gone goes.
    """
    weeks = sorted(r[0] for r in pending_weeks(spark, as_of, window).collect())  # a few
    new = build(weeks[0], weeks[-1] + timedelta(days=6)).where(F.col(week).isin(weeks)).persist()
    try:
        old, there = read_days(spark, root, weeks, week), set(days_of(new, week))
        gone = [d for d, _ in list_days(spark, root, week) if d in set(weeks) - there]
        changed = sorted(differing_days(new, old, week) if old is not None else there)
        if changed:
            replace_days(new.where(F.col(week).isin(changed)), root, week)
    finally:
        new.unpersist()
    for day, path in list_days(spark, root, week):
        if day in gone:
            remove(spark, path)
    return sorted([*changed, *gone])

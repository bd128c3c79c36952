"""Hot and cold tiers as one table: scans, stitching, quarantine, coverage, and partition sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stallwatch.functions.columns import latest_per, round_to
from stallwatch.sources.day_files import list_days


def stitch(hot: DataFrame, cold: DataFrame, id_col: str | list[str], day: str | None = None) -> DataFrame:
    """Both tiers; of a row that is in both, the hot one. An anti join keeps filters pushable into either scan.

    day: the column that says which day a row belongs to, the same in both tiers. The tiers then meet only from the first hot
    day on; the archive's older days pass without a join, and so without a shuffle.
    """
    keys = [id_col] if isinstance(id_col, str) else id_col
    if day is None:
        return cold.join(hot.select(*keys), keys, "left_anti").unionByName(hot, allowMissingColumns=True)
    older, seam = _seam(hot, cold, day)
    return older.unionByName(stitch(hot, seam, id_col), allowMissingColumns=True)


def _seam(hot: DataFrame, cold: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    """The archive before the first hot day, and from it on. One value is read for it."""
    first = hot.agg(F.min(day)).first()[0]
    bound = F.lit(first).cast("date")
    return (cold, cold.where(F.lit(False))) if first is None else (cold.where(F.col(day) < bound), cold.where(F.col(day) >= bound))


def between(df: DataFrame, day: str, end: str, days: int) -> DataFrame:
    """The window [end - days + 1, end]."""
    return df.where((F.col(day) >= F.date_sub(F.lit(end).cast("date"), days - 1)) & (F.col(day) <= F.lit(end).cast("date")))


def discount_against(base: Column, price: Column) -> Column:
    """Percent below base; null if base is missing, not positive, or under the price."""
    return F.when((base > 0) & (base >= price), round_to(100.0 * (base - price) / base))


def quarantine(df: DataFrame, rules: DataFrame, day: str) -> DataFrame:
    """Drops rows of a brand up to its bound (brand, until). One row per brand in the rules."""
    bound = rules.groupBy("brand").agg(F.max("until").alias("__until"))
    return df.join(bound, "brand", "left").where(F.col("__until").isNull() | (F.col(day) > F.col("__until"))).drop("__until")


def variant_baselines(variants: DataFrame, products: DataFrame, unreliable: tuple[str, ...] = ()) -> DataFrame:
    """Variants of active products that are not delisted; whether the brand's sizes can be relied on."""
    active = products.where("is_active").select("product_id", "brand")
    return variants.where("delisted_at is null").join(active, "product_id").withColumn("size_level_reliable", ~F.col("brand").isin(*unreliable))


def product_baselines(variants: DataFrame, products: DataFrame) -> DataFrame:
    """A product's base: the least positive first price of its listed variants, for active products."""
    listed = variant_baselines(variants, products).where("first_observed_price > 0")
    return listed.groupBy("product_id").agg(F.min("first_observed_price").alias("base_price"))


def price_history(snapshots: DataFrame, end: str, days: int = 45) -> DataFrame:
    return between(snapshots.where("price > 0"), "snapshot_date", end, days).select("product_id", "brand", "category_normalized", "snapshot_date", "price")


def tiered_price_history(hot: DataFrame, cold: DataFrame | None, end: str, days: int = 45) -> DataFrame:
    """Prices of both tiers, or of the hot one alone where there is no archive; ``source`` says which."""
    rows = price_history(hot, end, days) if cold is None else stitch(price_history(hot, end, days), price_history(cold, end, days), ["product_id", "snapshot_date"])
    return rows.withColumn("source", F.lit("hot" if cold is None else "hot+cold"))


def hot_snapshots(snapshots: DataFrame, products: DataFrame, variants: DataFrame, rules: DataFrame) -> DataFrame:
    """The whole hot tier with its products' and variants' context, less what is quarantined; rows without context stay."""
    about, own = products.select("product_id", "product_name", "category_normalized", "gender"), variants.select("variant_id", "size", "color")
    rows = quarantine(snapshots, rules, "snapshot_date").join(about, "product_id", "left").join(own, "variant_id", "left")
    return rows.withColumns({c: F.col(c).cast("double") for c in ("price", "compare_at_price")})


def _one_per_event(hot: DataFrame, cold: DataFrame, end: str, days: int) -> DataFrame:
    """Events of the window from both tiers, one row per id where the tiers overlap: a hot one if there is one.

    The day bound reaches both scans. Days before the first hot one are the archive's own, where an id stands once, as days are merged by
    it (``seam_check`` counts others); they are not shuffled.
    """
    hot, cold = between(hot, "event_date", end, days), between(cold, "event_date", end, days)
    older, seam = _seam(hot, cold, "event_date")
    tiers = hot.withColumn("__tier", F.lit(0)).unionByName(seam.withColumn("__tier", F.lit(1)), allowMissingColumns=True)
    return latest_per(tiers, ["event_id"], [F.asc("__tier")]).drop("__tier").unionByName(older, allowMissingColumns=True)


def stock_history(hot: DataFrame, cold: DataFrame, end: str, days: int = 90) -> DataFrame:
    """Stock events of both tiers that are witnessed or open. Archived rows that do not say so are taken as unwitnessed."""
    flag = F.coalesce("witnessed", F.lit(False)) if "witnessed" in cold.columns else F.lit(False)
    return _one_per_event(hot, cold.withColumn("witnessed", flag), end, days).where("witnessed is null or witnessed")


def price_event_history(hot: DataFrame, cold: DataFrame, rules: DataFrame, end: str, days: int = 90) -> DataFrame:
    """Price events of both tiers, less what is quarantined."""
    return quarantine(_one_per_event(hot, cold, end, days), rules, "event_date")


def coverage(df: DataFrame, start: str, end: str, day: str = "snapshot_date") -> DataFrame:
    """Rows and brands of every calendar day; days without rows have 0."""
    days = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias(day))
    seen = df.groupBy(day).agg(F.count("*").alias("n_rows"), F.countDistinct("brand").alias("n_brands"))
    return days.join(seen, day, "left").select(day, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_brands", F.lit(0)).alias("n_brands"), F.col("n_rows").isNull().alias("missing"))


def seam_check(df: DataFrame, id_col: str, dead: tuple[str, ...] = ()) -> DataFrame:
    """One row: rows, ids that occur more than once (none after stitching), and values in columns that should hold none."""
    ids = df.groupBy(id_col).agg(F.count("*").alias("n"), *[F.count(c).alias(c) for c in dead])
    total = [F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count_if(F.col("n") > 1).alias("duplicate_ids")]
    return ids.agg(*total, *[F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_values") for c in dead])


def days_available(df: DataFrame, day: str = "snapshot_date") -> int:
    """How many days of a frame have rows, a precondition of signals. Of a table kept by days, ``day_files.list_days`` tells without a scan."""
    return df.agg(F.countDistinct(day)).first()[0]


def archive_summary(df: DataFrame, day: str = "snapshot_date") -> DataFrame:
    cents = F.sum(F.floor(F.col("price") * 100.0 + 0.5).cast("long")).cast("double")
    return df.groupBy("brand").agg(F.count("*").alias("n_rows"), F.min(day).alias("first_day"), F.max(day).alias("last_day"), round_to(cents / F.count("price") / 100.0).alias("avg_price"))


def latest(df: DataFrame, day: str) -> DataFrame:
    return df.join(F.broadcast(df.agg(F.max(day).alias(day))), day, "left_semi")


def archive_table(spark: SparkSession, folder: str, name: str = "archive") -> DataFrame:
    """Every Parquet file under a folder as one table, at whatever depth, under a name for SQL; columns that a file lacks are null."""
    rows = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(folder)
    rows.createOrReplaceTempView(name)
    return rows


def ad_hoc(spark: SparkSession, frames: dict[str, DataFrame], query: str, max_rows: int = 500) -> tuple[DataFrame, bool]:
    """Runs a SELECT over named frames; at most max_rows rows, and whether there were more."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    rows = spark.sql(query).limit(max_rows + 1)
    found = rows.collect()  # max_rows and one at most
    return spark.createDataFrame(found[:max_rows], rows.schema), len(found) > max_rows


def replace_days(df: DataFrame, path: str, day: str = "snapshot_date", codec: str = "zstd") -> None:
    """Replaces exactly the days that df holds; an empty df changes nothing. Dealt out by day, so few files per day."""
    if day not in df.columns:
        raise ValueError(f"no column {day}")
    df.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", codec).partitionBy(day).parquet(path)


def row_digests(columns: list[str], types: dict[str, str]) -> list[Column]:
    """Three aggregates that say, whatever the order of rows, whether two tables hold the same rows: their number, and the xor and the
    sum of two hashes of each. Values are hashed with their places; a null is a value of its own. Maps are hashed by their sorted entries."""
    values = [F.array_sort(F.map_entries(c)) if types[c].startswith("map") else F.col(c) for c in sorted(columns)]
    gone = F.concat(F.lit(""), *[F.when(F.col(c).isNull(), "1").otherwise("0") for c in sorted(columns)])
    one, two = F.xxhash64(gone, *values), F.xxhash64(F.lit("again"), *values, gone)
    return [F.count(F.lit(1)).alias("n_rows"), F.bit_xor(one).alias("xor_digest"), F.sum(two.cast("decimal(38,0)")).cast("string").alias("sum_digest")]


def day_digests(df: DataFrame, day: str = "snapshot_date", columns: list[str] | None = None) -> DataFrame:
    """day, n_rows, xor_digest, sum_digest of each day: equal digests mean equal rows, in whatever order and files they lie."""
    columns = [c for c in columns or df.columns if c != day]
    return df.groupBy(day).agg(*row_digests(columns, dict(df.dtypes)))


def differing_days(want: DataFrame, have: DataFrame, day: str = "snapshot_date") -> list:
    """Days of ``want`` whose rows ``have`` does not hold just so. Both are compared in the columns of ``want``; one row a day comes back."""
    found = day_digests(have, day, want.columns).select(F.col(day).alias("__day"), *[F.col(c).alias(f"__{c}") for c in ("n_rows", "xor_digest", "sum_digest")])
    same = F.lit(True)
    for c in ("n_rows", "xor_digest", "sum_digest"):
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    rows = day_digests(want, day).join(found, F.col(day) == F.col("__day"), "left").where(~same)
    return [r[0] for r in rows.select(day).collect()]


def read_days(spark: SparkSession, root: str, days: list, day: str = "snapshot_date") -> DataFrame | None:
    """Some days of a table, None if it has none of them; no other day is opened. Columns that only some of their files have are kept."""
    paths = [p for d, p in list_days(spark, root, day) if d in set(days)]
    return spark.read.option("basePath", root).option("mergeSchema", True).parquet(*paths) if paths else None


def days_of(df: DataFrame, day: str) -> list:
    return [r[0] for r in df.select(day).where(F.col(day).isNotNull()).distinct().collect()]  # one row a day


def merge_days(incoming: DataFrame, path: str, id_col: str | list[str], staging: str, day: str = "snapshot_date") -> list:
    """Merges rows into their day partitions, incoming first; returns the days whose rows were found in the table just as merged.

    The merged days are written beside the table, which counts and digests them as they pass, read again and only then swapped
    in; the digest of each day is compared once more in the table. Only the days of ``incoming`` are read or written.
    """
    spark, keys = incoming.sparkSession, [id_col] if isinstance(id_col, str) else id_col
    days = days_of(incoming, day)
    existing = read_days(spark, path, days, day)
    merged = incoming if existing is None else existing.join(incoming.select(*keys), keys, "left_anti").unionByName(incoming, allowMissingColumns=True)
    merged = merged.where(F.col(day).isNotNull())
    if not days:
        return []
    passed, digests = Observation(), row_digests(merged.columns, dict(merged.dtypes))
    merged.observe(passed, *digests).write.mode("overwrite").parquet(staging)
    staged = spark.read.parquet(staging)
    if staged.agg(*digests).first().asDict() != passed.get:
        raise RuntimeError(f"{staging} does not hold the rows that were merged")
    replace_days(staged, path, day)
    bad = set(differing_days(staged, read_days(spark, path, days, day), day))
    return [d for d in days if d not in bad]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

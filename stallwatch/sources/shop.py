"""The retail model's frames over the TPC-H-like tables.

Events are observations of products (user_id is the product), parts are the catalogue. Prices fall where
event values rise, so a product's price varies; error, signup and view events are stock transitions.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stallwatch.functions.columns import round_to
from stallwatch.sources.shared import shared_folder

AS_OF = "2024-01-31"
CATALOGUE_AS_OF = "1995-06-30"
DELIST_AS_OF = "2001-11-05"
SIZES = ("S", "M", "L", "XL")


class Shop:
    """Lazy frames; every property is a plan, nothing runs here."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def dealt(self, name: str, *columns: str) -> DataFrame:
        """Columns of a table, dealt out evenly when it runs. For long ordered searches, which cost some 50 times what the move
        does: a scan hands out whole row groups, and a file may be a single one."""
        return self.table(name).select(*columns).hint("rebalance")

    def settle(self, *names: str) -> Shop:
        """Writes frames into the shared folder, once, and reads them from there: however many signals of a run read a frame,
        its sources are scanned once. Name frames before those that build on them. The folder is to be cleared after the run."""
        root = f"{shared_folder(self.spark)}/stallwatch/shop-{uuid.uuid4().hex}"
        for name in names:
            getattr(self, name).write.parquet(f"{root}/{name}")
            self.__dict__[name] = self.spark.read.parquet(f"{root}/{name}")
        return self

    @cached_property
    def observations(self) -> DataFrame:
        price = round_to(1000 - F.col("value"))
        claimed = round_to((11 + F.col("event_id") % 4) * (1000 - F.col("value")) / 10)
        return self.table("events").select(
            "event_id", F.col("user_id").alias("product_id"), F.col("ts").cast("timestamp").alias("recorded_at"), F.to_date("ts").alias("snapshot_date"), price.alias("price"),
            F.when(F.col("event_id") % 3 != 0, claimed).alias("compare_at_price"), "event_type",
        )

    @cached_property
    def catalogue(self) -> DataFrame:
        gender = F.element_at(F.array(F.lit("men"), F.lit("women"), F.lit("unisex")), (F.col("p_size") % 3 + 1).cast("int"))
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("brand"), F.col("p_name").alias("product_name"), F.lower("p_type").alias("category_normalized"),
            F.split("p_name", " ")[1].alias("subcategory"), gender.alias("gender"), F.when(F.col("p_size") <= 10, "kids").otherwise("adults").alias("department"), F.col("p_size").alias("p_size"),
        )

    @cached_property
    def first_prices(self) -> DataFrame:
        """The first observed price of each product; it never changes."""
        first = F.struct("recorded_at", "event_id")
        return self.observations.groupBy("product_id").agg(F.min_by("price", first).alias("first_observed_price"), F.min("recorded_at").alias("first_seen_at"), F.max("recorded_at").alias("last_seen_at"))

    @cached_property
    def products(self) -> DataFrame:
        return self.catalogue.join(self.first_prices, "product_id")

    @cached_property
    def snapshots(self) -> DataFrame:
        """One row per product and day: the day's last price and the first advertised one, with honest and claimed discounts."""
        last = F.struct("recorded_at", "event_id")
        days = self.observations.groupBy("product_id", "snapshot_date").agg(F.max_by("price", last).alias("price"), F.min_by("compare_at_price", last).alias("compare_at_price"), F.max("recorded_at").alias("recorded_at"))
        base, price, claimed = F.col("first_observed_price"), F.col("price"), F.col("compare_at_price")
        honest = F.when((base > 0) & (base >= price), round_to(100.0 * (base - price) / base))
        said = F.when((claimed > 0) & (claimed >= price), round_to(100.0 * (claimed - price) / claimed))
        return days.join(self.products, "product_id").withColumns({"honest_discount_pct": honest, "brand_claimed_discount_pct": said})

    @cached_property
    def price_events(self) -> DataFrame:
        """Price changes beyond 0.01; a first sighting is none."""
        w = Window.partitionBy("product_id").orderBy("recorded_at", "event_id")
        moved = self.observations.withColumn("price_before", F.lag("price").over(w)).where(F.abs(F.col("price") - F.col("price_before")) > 0.01)
        base, price = F.col("first_observed_price"), F.col("price")
        return moved.join(self.products, "product_id").select(
            "event_id", "product_id", "brand", "product_name", "category_normalized", "subcategory", "gender", "department", "price_before", F.col("price").alias("price_after"), "compare_at_price", "first_observed_price",
            F.when(F.col("price") > F.col("price_before"), "up").otherwise("down").alias("direction"),
            F.when((base > 0) & (price < base), round_to(100.0 * (base - price) / base)).alias("discount_pct"), "recorded_at", F.col("snapshot_date").alias("event_date"), "first_seen_at",
        )

    @cached_property
    def stock_events(self) -> DataFrame:
        """Stock transitions: witnessed ones, and delistings with witnessed null."""
        kind = F.create_map(*[F.lit(x) for x in ("error", "stockout", "signup", "restock", "view", "delisted")])[F.col("event_type")]
        rows = self.observations.withColumn("kind", kind).where("kind is not null").join(self.products, "product_id")
        size = F.element_at(F.array(*map(F.lit, SIZES)), (F.col("event_id") % 4 + 1).cast("int"))
        return rows.select(
            "event_id", F.col("product_id").alias("variant_id"), "product_id", "brand", "product_name", "category_normalized", "subcategory", "gender", "department", size.alias("size"),
            F.element_at(F.split("product_name", " "), 1).alias("color"), F.col("kind").alias("event_type"), F.col("price").alias("price_at_event"),
            (F.col("price") < F.col("first_observed_price")).alias("was_on_discount"), "recorded_at", F.col("snapshot_date").alias("event_date"), F.when(F.col("kind") != "delisted", True).alias("witnessed"), "first_seen_at",
        )

    @cached_property
    def shelf(self) -> DataFrame:
        """Catalogue timeline: when each part was first and last shipped."""
        seen = self.table("lineitem").groupBy(F.col("l_partkey").alias("product_id")).agg(F.to_date(F.min("l_shipdate")).alias("first_seen"), F.to_date(F.max("l_shipdate")).alias("last_seen"), F.max_by("l_extendedprice", F.struct("l_shipdate", "l_extendedprice", "l_quantity")).alias("last_price"), F.max("l_extendedprice").alias("first_observed_price"))
        return self.catalogue.join(seen, "product_id")

"""Change capture on streams: keyed state turns observations into price and stock events as they arrive.

State is Spark's own, one value per key in the RocksDB store with a changelog, so that a batch reads and writes the keys
that it holds and no others. A key's state goes by an event-time timer once it is old.
"""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stallwatch.sources.shared import remove

PRICE_EVENT = "product_id long, event_id long, recorded_at timestamp, price_before double, price_after double, direction string"
STOCK_EVENT = "variant_id long, event_id long, recorded_at timestamp, event_type string, reason string"
#: Keyed state in RocksDB; a batch uploads what it has changed.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_EPOCH = datetime(1970, 1, 1)


@contextmanager
def keyed_state(spark: SparkSession):
    """Streams that start in here keep keyed state; the session's own settings come back afterwards."""
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


class _Changes(StatefulProcessor):
    """Holds a key's new rows against its last one, in the order of their times and ids.

    Rows of a batch come in any order; they are kept as 25 bytes each until all of a key are there, so a key may hold much of a
    batch, and a batch is bounded by its trigger. Rows older than the key's last one meet each other only.
    """

    state_schema: str

    def __init__(self, ttl_days: int):
        self.ttl_millis = ttl_days * 86_400_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", self.state_schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        times, ids, values = array("q"), array("q"), array("d")
        for row in rows:
            times.append(row["micros"])
            ids.append(row["event_id"])
            values.append(row["value"])
        known = self.last.get() if self.last.exists() else None
        if known:
            times.append(known[0])
            ids.append(known[1])
            values.append(known[2])
        own = len(times) - 1 if known else -1
        # Of equal times and ids the known row comes first.
        order = sorted(range(len(times)), key=lambda i: (times[i], ids[i], i != own))
        yield from self.changes(key[0], order, own, times, ids, values, known)
        end = order[-1]
        self.last.update((times[end], ids[end], values[end], *self.extra))
        if not known:
            self.handle.registerTimer(times[end] // 1000 + self.ttl_millis)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """A key has one timer. Rows that came since it was set move it on."""
        if self.last.exists():
            due = self.last.get()[0] // 1000 + self.ttl_millis
            if due <= timerValues.getCurrentWatermarkInMs():
                self.last.clear()
            else:
                self.handle.registerTimer(due)
        yield from ()

    def close(self) -> None:
        pass


class PriceChanges(_Changes):
    state_schema = "micros long, event_id long, value double"
    extra = ()

    def __init__(self, ttl_days: int, min_change: float):
        super().__init__(ttl_days)
        self.min_change = min_change

    def changes(self, key, order, own, times, ids, values, known) -> Iterator[Row]:
        for before, i in zip(order, order[1:]):
            fresh = times[i] - times[before] <= 1000 * self.ttl_millis
            if i != own and fresh and abs(values[i] - values[before]) > self.min_change:
                yield Row(product_id=key, event_id=ids[i], recorded_at=_time(times[i]), price_before=values[before], price_after=values[i], direction="up" if values[i] > values[before] else "down")


class StockChanges(_Changes):
    state_schema = "micros long, event_id long, value double, had_stockout boolean"

    def changes(self, key, order, own, times, ids, values, known) -> Iterator[Row]:
        gone = order[0] == own and known[3]
        for before, i in zip(order, order[1:]):
            if i == own:
                gone = gone or known[3]
            elif values[i] != values[before]:
                back = values[i] == 1.0
                yield Row(variant_id=key, event_id=ids[i], recorded_at=_time(times[i]), event_type="restock" if back else "stockout", reason="orphan_restock" if back and not gone else None)
            gone = gone or (values[before] == 1.0 and values[i] == 0.0)
        self.extra = (bool(gone),)


def _time(micros: int) -> datetime:
    return (_EPOCH + timedelta(microseconds=micros)).replace(tzinfo=timezone.utc)


def _changes(observations: DataFrame, key: str, value: str, processor: StatefulProcessor, schema: str, late_days: int) -> DataFrame:
    rows = observations.where(F.col(value).isNotNull() & F.col(key).isNotNull() & F.col("recorded_at").isNotNull()).withWatermark("recorded_at", f"{24 * late_days} hours")
    rows = rows.select(key, "recorded_at", F.unix_micros("recorded_at").alias("micros"), F.coalesce("event_id", F.lit(0)).alias("event_id"), F.col(value).cast("double").alias("value"))
    return rows.groupBy(key).transformWithState(processor, outputStructType=schema, outputMode="append", timeMode="EventTime")


def price_changes(observations: DataFrame, ttl_days: int = 14, min_change: float = 0.01, late_days: int = 1) -> DataFrame:
    """A stream of price events: a row when a product's price moves by more than min_change. After ttl_days unseen a product starts anew.

    observations: a stream of product_id, event_id, recorded_at, price; rows without product, time or price are passed over. Rows
    that are late_days or more behind the latest of the batches before are dropped; one that is late by less, but older than the product's
    last, is held against other rows of its batch only. A product's state goes when it is ttl_days and late_days behind the latest row.
    """
    return _changes(observations, "product_id", "price", PriceChanges(ttl_days, min_change), PRICE_EVENT, late_days)


def stock_changes(observations: DataFrame, ttl_days: int = 400, late_days: int = 1) -> DataFrame:
    """A stream of stock events: a row per change of a variant's stock flag, with the reason to distrust it, which a restock before
    any stock-out has.

    observations: a stream of variant_id, event_id, recorded_at, is_in_stock; rows and state go as those of prices do.
    """
    return _changes(observations, "variant_id", "is_in_stock", StockChanges(ttl_days), STOCK_EVENT, late_days)


def capture(changes: DataFrame, folder: str) -> str:
    """Runs a stream of changes over what is there; returns where its events lie. folder is shared by all executors."""
    root, spark = f"{folder}/stream-{uuid.uuid4().hex}", changes.sparkSession
    with keyed_state(spark):
        query = changes.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    remove(spark, f"{root}/checkpoint")
    return f"{root}/out"


def stream_discount_bursts(events: DataFrame, bucket: str = "6 hours", late: str = "1 day") -> DataFrame:
    """Distinct products per bucket: duplicates go first within the watermark, then rows are counted."""
    rows = events.where("direction = 'down'").withWatermark("recorded_at", late)
    rows = rows.withColumn("w", F.window("recorded_at", bucket)).dropDuplicates(["brand", "category_normalized", "product_id", "w"])
    return rows.groupBy("w", "brand", "category_normalized").agg(F.count("*").alias("skus_dropped")).select("brand", "category_normalized", F.col("w.start").alias("window_start"), "skus_dropped")


def stream_dedupe(events: DataFrame, id_col: str, late: str = "2 days", time: str = "recorded_at") -> DataFrame:
    """Events delivered again within the watermark go."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([id_col])


def alert_batches(match, path: str):
    """A foreachBatch function: match(batch) picks what a batch of price events tells of. Each batch has a folder of its own
    under path, which a batch that runs again writes anew."""

    def write(batch: DataFrame, batch_id: int) -> None:
        match(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def day_sink(stream: DataFrame, path: str, checkpoint: str, day: str = "day", time: str = "recorded_at"):
    """Starts appending to day partitions."""
    return stream.withColumn(day, F.to_date(time)).writeStream.partitionBy(day).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_end(stream: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Runs a stream over what is there and returns what it wrote. folder is shared by all executors."""
    root = f"{folder}/stream-{uuid.uuid4().hex}"
    query = stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    remove(spark, f"{root}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{root}/out")

"""Change capture over several batches, with a restart from the checkpoint before each: state carries over, keys go when they are old."""

import datetime as dt
import os

import numpy as np
import pytest

from stallwatch.streaming import capture_streams as C

START = dt.datetime(2024, 1, 1)
PRICE = "product_id long, event_id long, recorded_at timestamp, price double"
STOCK = "variant_id long, event_id long, recorded_at timestamp, is_in_stock boolean"


def at(hours):
    return START + dt.timedelta(hours=int(hours))


def plain_prices(rows, ttl_days=14):
    last, out = {}, []
    for product, event, time, price in sorted((r for r in rows if r[3] is not None), key=lambda r: (r[2], r[1])):
        before, seen = last.get(product, (None, time))
        if before is not None and time - seen <= dt.timedelta(days=ttl_days) and abs(price - before) > 0.01:
            out.append((product, event, time, before, price, "up" if price > before else "down"))
        last[product] = price, time
    return sorted(out)


def plain_stock(rows):
    last, gone, out = {}, set(), []
    for variant, event, time, flag in sorted((r for r in rows if r[3] is not None), key=lambda r: (r[2], r[1])):
        if variant in last and flag != last[variant]:
            out.append((variant, event, time, "restock" if flag else "stockout", "orphan_restock" if flag and variant not in gone else None))
            if not flag:
                gone.add(variant)
        last[variant] = flag
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def drawn():
    """Observations of 30 products, one of which holds a third, with gaps, ties in time, missing and repeated values."""
    rng = np.random.default_rng(71)
    rows = []
    for i in range(900):
        product = 1 if i % 3 == 0 else int(rng.integers(2, 31))
        value = None if rng.random() < 0.05 else float(rng.integers(1, 4))
        rows.append((product, i, at(i // 2 * 2 + (1000 if i > 450 else 0)), value))
    return rows


class Feed:
    """A folder that a stream reads; each run is a query of its own that starts from the checkpoint of the one before."""

    def __init__(self, spark, root, schema, changes):
        self.spark, self.root, self.schema, self.changes, self.batches = spark, root, schema, changes, 0
        os.makedirs(f"{root}/in")

    def run(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(f"{self.root}/in")
        stream = self.changes(self.spark.readStream.schema(self.schema).parquet(f"{self.root}/in"))
        with C.keyed_state(self.spark):
            query = stream.writeStream.format("parquet").option("path", f"{self.root}/out").option("checkpointLocation", f"{self.root}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        return query

    def events(self):
        return [tuple(r) for r in self.spark.read.parquet(f"{self.root}/out").collect()]

    def state(self):
        rows = self.spark.read.format("statestore").option("stateVarName", "last").load(f"{self.root}/checkpoint")
        return {r["key"][0]: tuple(r["value"]) for r in rows.select("key", "value").collect()}


@pytest.mark.parametrize("cuts", [(), (10, 450, 451)])
def test_batches_equal_one_pass(spark, drawn, tmp_path, cuts):
    flags = [(p, e, t, None if v is None else v > 1) for p, e, t, v in drawn]
    for name, rows, schema, changes, plain in (("prices", drawn, PRICE, C.price_changes, plain_prices), ("stock", flags, STOCK, C.stock_changes, plain_stock)):
        feed, edges = Feed(spark, f"{tmp_path}/{name}", schema, changes), [0, *cuts, len(rows)]
        for lo, hi in zip(edges, edges[1:]):
            feed.run(rows[lo:hi][::-1])  # in any order
        got = feed.events()
        assert sorted(got, key=str) == sorted(plain(rows), key=str) and len(got) > 100


def test_old_keys_go_and_late_rows_meet_no_state(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), PRICE, lambda rows: C.price_changes(rows, ttl_days=2))
    feed.run([(1, 1, at(0), 5.0), (2, 2, at(90), 5.0), (3, 3, at(100), 5.0)])
    assert feed.events() == [] and set(feed.state()) == {2, 3}  # 1 is two days and a day behind the latest
    feed.run([(1, 4, at(101), 9.0), (2, 5, at(80), 9.0), (3, 6, at(101), 4.0)])
    assert [(r[0], *r[3:]) for r in feed.events()] == [(3, 5.0, 4.0, "down")]  # 2's row is late and meets no state
    assert {k: v[2] for k, v in feed.state().items()} == {1: 9.0, 2: 5.0, 3: 4.0}
    feed.run([(2, 7, at(60), 1.0), (2, 8, at(91), 6.0), (3, 9, at(180), 4.0)])  # 60 is behind the watermark
    assert sorted((r[0], *r[3:]) for r in feed.events()) == [(2, 5.0, 6.0, "up"), (3, 5.0, 4.0, "down")]
    assert set(feed.state()) == {3}


def test_had_stockout_is_kept(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), STOCK, C.stock_changes)
    feed.run([(1, 1, at(0), False), (1, 2, at(1), True), (2, 3, at(1), True)])
    feed.run([(1, 4, at(2), False), (2, 5, at(2), False)])
    feed.run([(1, 6, at(3), True), (2, 7, at(3), True)])
    got = sorted((r[0], r[1], r[3], r[4]) for r in feed.events())
    assert got == [(1, 2, "restock", "orphan_restock"), (1, 4, "stockout", None), (1, 6, "restock", None), (2, 5, "stockout", None), (2, 7, "restock", None)]
    assert {k: v[3] for k, v in feed.state().items()} == {1: True, 2: True}


def test_a_batch_costs_its_own_keys(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), PRICE, C.price_changes)

    def written():
        return {f"{d}/{f}": os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(f"{tmp_path}/checkpoint/state") for f in names if f.endswith((".changelog", ".delta", ".zip", ".sst"))}

    feed.run([(k, k, at(0), float(k % 7)) for k in range(20_000)])
    before = written()
    progress = feed.run([(k, 30_000 + k, at(5), 9.0) for k in range(50)]).lastProgress
    grown = sum(size - before.get(path, 0) for path, size in written().items() if before.get(path) != size)
    assert 0 < grown < sum(before.values()) / 20, (grown, sum(before.values()))
    assert len(feed.events()) == 50 and len(feed.state()) == 20_000
    assert "RocksDB" in str(progress["stateOperators"][0]["customMetrics"]) or any("rocksdb" in k for k in progress["stateOperators"][0]["customMetrics"])


def test_the_session_keeps_its_own_settings(spark):
    before = {k: spark.conf.get(k, None) for k in C.STATE_STORE}
    with C.keyed_state(spark):
        assert {k: spark.conf.get(k) for k in C.STATE_STORE} == C.STATE_STORE
    assert {k: spark.conf.get(k, None) for k in C.STATE_STORE} == before


def test_alerts_are_written_as_drops_and_subscribers(spark, sf, monkeypatch):
    from stallwatch.plans import streaming_catalog as S

    wrote = []
    batches = C.alert_batches
    monkeypatch.setattr(S.C, "alert_batches", lambda match, path: wrote.append(path) or batches(match, path))
    found = S.m04_stream_alerts(spark, sf)
    assert "user_id" not in spark.read.parquet(wrote[0]).columns and found.count() == found.distinct().count() > 0


def test_streamed_alerts_keep_a_drop_over_its_followers(spark):
    from pyspark.sql import functions as F

    from stallwatch.plans import streaming_catalog as S

    found = S.m04_stream_alerts(spark, "/root/testdata/sf0.01").withColumn("slice", F.pmod(F.xxhash64("user_id"), F.lit(8)))
    told = [tuple(r) for r in found.select("product_id", "brand", "category", "size", "price_after", "discount_pct", "slice").collect()]
    assert len(told) > 1000 and 1 + sum(a != b for a, b in zip(told, told[1:])) == len(set(told))

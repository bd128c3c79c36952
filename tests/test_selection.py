"""Order statistics against ``percentile`` and plain sorting."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallwatch.operators import capture
from stallwatch.operators.selection import exact_percentiles, order_statistics

SHARES = [0.0, 0.25, 0.5, 0.9, 1.0]


@pytest.fixture(scope="module")
def rows(spark):
    """Odd and even counts, ties, one value, far outliers, subnormal gaps, null values and a null key."""
    rng = np.random.default_rng(3)
    groups = {
        "odd": rng.normal(size=301), "even": rng.normal(size=300), "ties": rng.integers(0, 4, 500), "one": [7.5], "same": [2.0] * 40, "wide": [*rng.normal(size=50), 1e300, -1e300, 1.7e308, -1.7e308],
        "near": 1 + np.arange(60) * 2e-16, None: rng.exponential(size=77), "few": [3.0, 1.0], "days": rng.integers(0, 90 * 86400, 400) / 86400.0,
    }
    made = [(k, float(v)) for k, values in groups.items() for v in values] + [("none", None), ("odd", None)]
    return spark.createDataFrame(made, "k string, v double").repartition(6)


@pytest.mark.parametrize("buckets", [4096, 3])
def test_percentiles_bit_for_bit(rows, buckets):
    want = {r.k: (r.n, r.q) for r in rows.groupBy("k").agg(F.count("v").alias("n"), F.percentile("v", F.array(*map(F.lit, SHARES))).alias("q")).collect() if r.n}
    got = {r.k: (r.n, r.q) for r in exact_percentiles(rows, ["k"], "v", SHARES, buckets).collect()}
    assert got == want


def test_without_keys(rows):
    want = rows.agg(F.percentile("v", F.array(*map(F.lit, SHARES)))).first()[0]
    assert exact_percentiles(rows, [], "v", SHARES).first().q == want
    assert exact_percentiles(rows.limit(0), [], "v", SHARES).count() == 0


def test_ranks(rows):
    values = {}
    for r in rows.where("v is not null").collect():
        values.setdefault(r.k, []).append(r.v)
    got = {r.k: tuple(r["values"]) for r in order_statistics(rows, ["k"], "v", lambda n: [F.lit(0), F.floor(n / 2), n - 1]).collect()}
    assert got == {k: (min(v), sorted(v)[len(v) // 2], max(v)) for k, v in values.items()}


def test_a_large_group_is_narrowed_before_it_is_sorted(spark):
    """Two million different values of one group: the plan sorts single buckets, and builds no list or map of values but of the ranks found."""
    n = 2_000_001
    rows = spark.range(n).select(F.lit("a").alias("k"), (((F.col("id") * 7919) % n) / 3.0).alias("v"))
    found = exact_percentiles(rows, ["k"], "v", [0.25, 0.5])
    assert found.first().q == [(n - 1) / 4 / 3.0, (n - 1) / 2 / 3.0]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan and plan.count("collect_list(") == 1
    assert re.search(r"windowspecdefinition\([^)]*__bucket#\d+, __v", plan)


def test_medians_of_variants(spark):
    rows = spark.createDataFrame([("a", 1.0, 9.0), ("a", 2.0, None), ("a", 3.0, 8.0), ("a", 4.0, 0.0), ("b", -1.0, None), (None, 5.0, 1.0), ("b", None, None)], "brand string, price double, first_observed_price double")
    assert {tuple(r) for r in capture.representative_prices(rows, ["brand"]).collect()} == {("a", 3.0), ("b", None), (None, 5.0)}
    assert {tuple(r) for r in capture.representative_baselines(rows, ["brand"]).collect()} == {("a", 9.0), ("b", None), (None, 1.0)}

"""Exact order statistics of groups of any size.

Equal values are counted first, map-side. The range of each group's values is cut into buckets of equal width, whose
counts tell in which bucket each wanted rank lies; only the values of those buckets are put in order. No array or map of
a group's values is built, and no task needs a group's values together: what is sorted in one task is a bucket, and that
sort spills.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096


def _joined(rows: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on keys of which some may be null; without keys, ``other`` is one row."""
    if not keys:
        return rows.crossJoin(F.broadcast(other))
    theirs = other.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in other.columns if c not in keys])
    condition = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return rows.join(theirs, condition, how).drop(*[f"__{k}" for k in keys])


def order_statistics(rows: DataFrame, keys: list[str], value: str, ranks: Callable[[Column], list[Column]], buckets: int = BUCKETS) -> DataFrame:
    """keys, n, values: per group how many values it has, and those of the given ranks (from 0) in ascending order.

    ranks: from n to the wanted ranks, each 0 to n - 1. Null values do not count, and a group of only these has no row.
    Values are doubles; a group whose key is null is a group.
    """
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("__v")).agg(F.count("*").alias("__n"))
    whole = counted.groupBy(*keys).agg(F.sum("__n").alias("__total"), F.min("__v").alias("__min"), F.max("__v").alias("__max")).where("__total > 0")
    # From the halves, as a range may be wider than the largest double; where all values are equal there is one bucket.
    width = F.col("__max") / 2 - F.col("__min") / 2
    at = F.when(width > 0, F.floor((F.col("__v") / 2 - F.col("__min") / 2) / width * buckets)).otherwise(F.lit(0))
    filed = _joined(counted, whole, keys).withColumn("__bucket", F.least(F.coalesce(at, F.lit(0)), F.lit(buckets - 1)).cast("int"))

    sizes = filed.groupBy(*keys, "__bucket").agg(F.sum("__n").alias("__size"), F.max("__total").alias("__total"))
    before = F.coalesce(F.sum("__size").over(Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wanted = F.array_distinct(F.array(*[r.cast("long") for r in ranks(F.col("__total"))]))
    sizes = sizes.withColumn("__before", before)
    sizes = sizes.withColumn("__ranks", F.filter(wanted, lambda r: (r >= F.col("__before")) & (r < F.col("__before") + F.col("__size")))).where(F.size("__ranks") > 0)

    within = _joined(filed.drop("__total", "__min", "__max"), sizes.select(*keys, "__bucket", "__before", "__ranks", "__total"), [*keys, "__bucket"])
    upto = F.col("__before") + F.sum("__n").over(Window.partitionBy(*keys, "__bucket").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0))
    found = within.withColumn("__upto", upto)
    found = found.withColumn("__rank", F.explode(F.filter("__ranks", lambda r: (r >= F.col("__upto") - F.col("__n")) & (r < F.col("__upto")))))
    out = found.groupBy(*keys).agg(F.max("__total").alias("n"), F.map_from_entries(F.collect_list(F.struct("__rank", "__v"))).alias("__found")).where("n > 0")  # one a rank
    return out.select(*keys, "n", F.array(*[F.element_at("__found", r.cast("long")) for r in ranks(F.col("n"))]).alias("values"))


def exact_percentiles(rows: DataFrame, keys: list[str], value: str, shares: list[float], buckets: int = BUCKETS) -> DataFrame:
    """keys, n, q: per group the interpolated percentiles, bit for bit those of ``percentile``, but for groups of any size."""

    def at(n: Column, share: float) -> Column:
        return (n - 1).cast("double") * F.lit(float(share))

    found = order_statistics(rows, keys, value, lambda n: [f(at(n, s)) for s in shares for f in (F.floor, F.ceil)], buckets)

    def between(i: int, share: float) -> Column:
        low, high, place = F.col("values")[2 * i], F.col("values")[2 * i + 1], at(F.col("n"), share)
        return F.when(low == high, low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high)

    return found.select(*keys, "n", F.array(*[between(i, s) for i, s in enumerate(shares)]).alias("q"))

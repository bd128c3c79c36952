"""Column helpers shared by the retail operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def round_to(x: Column, places: int = 2) -> Column:
    """Half-up rounding on doubles, the same on every engine: floor(x * 10^n + 0.5) / 10^n."""
    scale = float(10**places)
    return F.floor(x * scale + 0.5).cast("double") / scale


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """100 * part / whole, null where the whole is 0 or null."""
    return round_to(100.0 * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), places)


def exact_mean(x: Column, places: int) -> Column:
    """Mean of values of up to six decimals, rounded half up: in whole millionths, so that neither the order of the rows nor
    a sum of doubles decides a tie."""
    unit, total, n = 10 ** (6 - places), F.sum(F.round(x * 1e6).cast("long")), F.count(x)
    twice, whole = 2 * total + n * unit, 2 * unit * F.nullif(n, F.lit(0))
    return ((twice - F.pmod(twice, whole)) / whole) / float(10**places)


def upper_median(values: Column) -> Column:
    """The upper of the two middle values of a positive array; not interpolated."""
    good = F.array_sort(F.filter(values, lambda v: v > 0))
    return F.when(F.size(good) > 0, F.element_at(good, (F.floor(F.size(good) / 2) + 1).cast("int")))


def first_match(rules: list[tuple[Column, object]], default: object = None) -> Column:
    """The value of the first rule that holds."""
    return F.coalesce(*[F.when(cond, F.lit(value)) for cond, value in rules], F.lit(default))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once a row however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def read_bands(x: Column, bands: list[tuple[float, str]], default: str, at_most: bool = False) -> Column:
    """The first label whose bound x reaches (or, with at_most, does not exceed)."""
    return first_match([((x <= b) if at_most else (x >= b), label) for b, label in bands], default)


def latest_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in the given order. Spark keeps one row per key before the shuffle too."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def window_of(df: DataFrame, day: str, as_of: str, days: int) -> DataFrame:
    """Rows of the ``days`` days before as_of: day > as_of - days and day <= as_of."""
    return df.where((F.col(day) > F.date_sub(F.lit(as_of).cast("date"), days)) & (F.col(day) <= F.lit(as_of).cast("date")))

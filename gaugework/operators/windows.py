"""Windows over ordered groups: dedupe, ranks, rolling, expanding and exponential means."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Enough digits that sums of measured values are exact, so engines agree to the last bit.
EXACT = "decimal(18,6)"


def first_by(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each group in a total order."""
    place = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(place)).where("__n = 1").drop("__n")


def top_k(df: DataFrame, keys: list[str], k: int, *order: Column | str, rank: str = "rank") -> DataFrame:
    """The first k rows of each group, with their place; Spark cuts each task to k before the exchange."""
    place = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(place)).where(F.col(rank) <= k)


def latest_of(df: DataFrame, keys: list[str], *by: str) -> DataFrame:
    """The row of greatest `by` of each group, by an aggregate that combines before the exchange."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("__r")).select(*keys, "__r.*")


def average_rank(keys: list[str], value: Column | str, descending: bool = False) -> Column:
    """Rank with ties at their mean place."""
    value = F.col(value) if isinstance(value, str) else value
    place = Window.partitionBy(*keys).orderBy(value.desc() if descending else value.asc())
    return F.rank().over(place) + (F.count("*").over(Window.partitionBy(*keys, value)) - 1) / F.lit(2.0)


def rolling_mean(keys: list[str], order: list[Column | str], value: str, rows: int, shift: int = 0) -> Column:
    """Mean of the non-null values of `rows` rows that end `shift` rows back; exact."""
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(rows - 1) - shift, -shift)
    total = F.sum(F.col(value).cast(EXACT)).over(frame).cast("double")
    return F.try_divide(total, F.count(value).over(frame))


def rolling_count(keys: list[str], order: list[Column | str], value: str, rows: int, shift: int = 0) -> Column:
    return F.count(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(rows - 1) - shift, -shift))


def expanding_mean(keys: list[str], order: list[Column | str], value: str) -> Column:
    """Mean of all non-null values up to the row."""
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.try_divide(F.sum(F.col(value).cast(EXACT)).over(frame).cast("double"), F.count(value).over(frame))


def recent_minus_before(keys: list[str], order: list[Column | str], value: str, rows: int = 3) -> tuple[Column, Column]:
    """Mean of the last `rows` rows and mean of all rows before them."""
    by = Window.partitionBy(*keys).orderBy(*order)
    now, before = by.rowsBetween(-(rows - 1), 0), by.rowsBetween(Window.unboundedPreceding, -rows)
    mean = lambda w: F.try_divide(F.sum(F.col(value).cast(EXACT)).over(w).cast("double"), F.count(value).over(w))
    return mean(now), mean(before)


#: Rows of one scale: 2^(n/halflife) stays far below the largest double.
BLOCK_HALVES = 500


def ewm_mean(df: DataFrame, keys: list[str], order: list[str], values: list[str], halflife: float, suffix: str = "_ewm") -> DataFrame:
    """Exponentially weighted means with adjusted weights, every row (null or not) a step of time.

    Weights grow as 2^(n/halflife) and would overflow in a long group, so rows
    are scaled within blocks of BLOCK_HALVES half-lives; what blocks before
    contribute is their last sum, scaled down, which is below the precision of a
    double from the second block back. A group within one block is one window.
    """
    place = Window.partitionBy(*keys).orderBy(*order)
    length = max(1, math.floor(BLOCK_HALVES * halflife))
    rows = df.withColumn("__n", F.row_number().over(place) - 1).withColumn("__k", F.floor(F.col("__n") / length))
    weight = F.pow(F.lit(2.0), (F.col("__n") - F.col("__k") * length) / F.lit(float(halflife)))
    upto = Window.partitionBy(*keys, "__k").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys).orderBy("__k").rangeBetween(-1, -1)
    for c in values:
        v = F.col(c).cast("double")
        w = F.when(v.isNotNull(), weight)
        scale = F.pow(F.lit(2.0), F.lit(-length / halflife))
        top = F.sum(v * weight).over(upto)
        below = F.sum(w).over(upto)
        carried_top = F.coalesce(F.sum(v * weight).over(whole) * scale, F.lit(0.0))
        carried_below = F.coalesce(F.sum(w).over(whole) * scale, F.lit(0.0))
        rows = rows.withColumn(f"{c}{suffix}", F.try_divide(F.coalesce(top, F.lit(0.0)) + carried_top, F.coalesce(below, F.lit(0.0)) + carried_below))
    return rows.drop("__n", "__k")

"""As-of joins: the last right row of the same keys at or before each left row.

Spark has no public as-of join, and an equality join with a time bound grows
with the product of the rows of a key. Both sides are instead united, dealt by
key and sorted by time, once, and a running last value carries the right row
forward: one shuffle, one sort, nothing quadratic.

A key may hold a large part of all rows. With `slice_of` (an expression over
the time column that never decreases, such as a year) keys are dealt by key and
slice; the last right row of each slice is a small table from a partial
aggregate, and it is carried into later slices by a window over those few rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    on: str,
    right_on: str | None = None,
    inclusive: bool = False,
    tie: list[str] | None = None,
    slice_of: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """left with `right_time` and the right side's other columns, null where nothing precedes.

    Strict by default: a right row at the same time does not count. Of right
    rows of equal key and time the greatest by `tie` wins. Null keys never match.
    """
    right_on = right_on or on
    payload = [c for c in right.columns if c not in by]
    carried = F.struct(F.col(right_on).alias("right_time"), *[F.col(c).alias(c) for c in payload if c != right_on])
    first = 0 if inclusive else 1
    tied = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(tie)]) if tie else F.lit(0)
    ours = left.select(*by, F.col(on).alias("__t"), F.lit(first ^ 1).alias("__side"), F.struct(*left.columns).alias("__left"))
    theirs = right.where(F.col(right_on).isNotNull()).select(*by, F.col(right_on).alias("__t"), F.lit(first).alias("__side"), carried.alias("__right"), tied.alias("__tie"))
    both = ours.unionByName(theirs, allowMissingColumns=True)
    keys = list(by)
    if slice_of is not None:
        both = both.withColumn("__slice", slice_of(F.col("__t")))
        keys = [*by, "__slice"]
    place = Window.partitionBy(*keys).orderBy("__t", "__side", "__tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("__found", F.last("__right", ignorenulls=True).over(place))
    if slice_of is not None:
        ends = both.where("__right IS NOT NULL").groupBy(*keys).agg(F.max_by("__right", F.struct("__t", "__tie")).alias("__end"))
        slices = both.select(*keys).distinct().join(ends, keys, "left")
        before = Window.partitionBy(*by).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
        carry = slices.withColumn("__carry", F.last("__end", ignorenulls=True).over(before)).select(*keys, "__carry")
        found = found.join(carry, keys, "left").withColumn("__found", F.coalesce("__found", "__carry"))
    known = F.lit(True)
    for c in by:
        known = known & F.col(c).isNotNull()
    return (
        found.where("__left IS NOT NULL")
        .withColumn("__found", F.when(known, F.col("__found")))
        .select("__left.*", F.col("__found.right_time").alias("right_time"), *[F.col(f"__found.{c}").alias(c if c not in left.columns else f"right_{c}") for c in payload if c != right_on])
    )

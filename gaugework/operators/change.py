"""Change detection and mirrors without a table format that can merge.

A diff is one full outer join on the keys; what it finds is written as whole
partitions, so only partitions with a change are rewritten.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ShrinkError(RuntimeError):
    """The source lost more rows than a sync may delete."""


def _differs(columns: list[str], ignore: list[str]) -> Column:
    tests = [~F.col(f"t.`{c}`").eqNullSafe(F.col(f"s.`{c}`")) for c in columns if c not in ignore]
    return reduce(lambda x, y: x | y, tests, F.lit(False))


def diff(target: DataFrame, source: DataFrame, keys: list[str], ignore: list[str] | None = None) -> DataFrame:
    """Source rows (target's for deletes) with `change`: insert, update, delete or same.

    Nulls compare as values; columns of `ignore` alone make no change.
    """
    values = [c for c in source.columns if c not in keys]
    t = target.select("*", F.lit(True).alias("__t")).alias("t")
    s = source.select("*", F.lit(True).alias("__s")).alias("s")
    on = reduce(lambda x, y: x & y, [F.col(f"t.`{k}`").eqNullSafe(F.col(f"s.`{k}`")) for k in keys])
    change = (
        F.when(F.col("__t").isNull(), F.lit("insert")).when(F.col("__s").isNull(), F.lit("delete")).when(_differs(values, ignore or []), F.lit("update")).otherwise(F.lit("same"))
    )
    return t.join(s, on, "full").select(
        *[F.when(F.col("__s").isNull(), F.col(f"t.`{c}`")).otherwise(F.col(f"s.`{c}`")).alias(c) for c in [*keys, *values]], change.alias("change")
    )


def merged(target: DataFrame, source: DataFrame, keys: list[str], ignore: list[str] | None = None, delete_missing: bool = True) -> DataFrame:
    """The target after the merge: unchanged rows keep their old values, ignored ones too."""
    values = [c for c in target.columns if c not in keys]
    t, s = target.select("*", F.lit(True).alias("__t")).alias("t"), source.select("*", F.lit(True).alias("__s")).alias("s")
    on = reduce(lambda x, y: x & y, [F.col(f"t.`{k}`").eqNullSafe(F.col(f"s.`{k}`")) for k in keys])
    keep_old = F.col("__s").isNull() | (F.col("__t").isNotNull() & ~_differs(values, ignore or []))
    out = t.join(s, on, "full")
    if delete_missing:
        out = out.where("__s IS NOT NULL")
    return out.select(*[F.when(keep_old, F.col(f"t.`{c}`")).otherwise(F.col(f"s.`{c}`")).alias(c) for c in target.columns])


def shrink_guard(target: DataFrame, source: DataFrame, keys: list[str], most: float = 0.2, may_be_empty: bool = False) -> None:
    """Raise if the source is empty or lacks more than a part of the target's rows."""
    rows = target.count()
    if not may_be_empty and source.limit(1).count() == 0:
        raise ShrinkError("the source is empty")
    if may_be_empty or not rows:
        return
    gone = target.join(source.select(*keys), keys, "left_anti").count()
    if gone > most * rows:
        raise ShrinkError(f"{gone} of {rows} rows would be deleted")


def changed_keys(changes: DataFrame, partition: list[str]) -> DataFrame:
    """Partitions that hold an insert, update or delete."""
    return changes.where("change <> 'same'").select(*partition).distinct()


def rebuilt(previous: DataFrame, recompute, changed: DataFrame, partition: list[str]) -> DataFrame:
    """previous with the changed partitions replaced by recompute(changed); nothing else is computed."""
    return previous.join(changed, partition, "left_anti").unionByName(recompute(changed))


def row_sums(columns: list[str]) -> list[Column]:
    """Aggregate expressions that differ for different bags of rows: their number, and the sums of two digests of each row.

    Sums, unlike exclusive ors, count a row that occurs twice. A row is written
    as JSON with its nulls, so no two rows look alike.
    """
    digest = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"}), 256)
    number = lambda at: F.sum(F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(20,0)"))
    return [F.count("*").cast("string"), *[F.coalesce(number(at).cast("string"), F.lit("0")) for at in (1, 16)]]


def fingerprint(df: DataFrame, *settings: str) -> Column:
    """Aggregate expression: a hash of all rows, in any order, and of settings."""
    return F.sha2(F.concat_ws("|", *row_sums(sorted(df.columns)), *[F.lit(s) for s in settings]), 256)

"""Joins beyond equality: first after, dense grids, steps of an index, existence flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_after(points: DataFrame, marks: DataFrame, by: list[str], at: str, mark: str, label: str, out: str) -> DataFrame:
    """Distinct (by, at) of points with the least label whose mark is strictly later.

    marks is a calendar, a few rows a group; points are made distinct first.
    """
    places = points.select(*by, at).distinct()
    found = places.join(marks.select(*by, mark, label), by).where(F.col(mark) > F.col(at))
    return found.groupBy(*by, at).agg(F.min(label).alias(out))


def dense(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Every row once for each value of a fixed domain: a grid without a cross join."""
    return df.withColumn(column, F.explode(F.array(*map(F.lit, values))))


def flagged(left: DataFrame, right: DataFrame, on: list[str], flag: str) -> DataFrame:
    """left with a boolean: some right row has the same keys."""
    marks = right.select(*on).distinct().withColumn(flag, F.lit(True))
    return left.join(marks, on, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def stepped(df: DataFrame, keys: list[str], index: str, steps: int, values: list[str], suffix: str = "_prev") -> DataFrame:
    """df with the values of the row whose index is `steps` less, null where there is none."""
    back = df.select(*keys, (F.col(index) + steps).alias(index), *[F.col(v).alias(f"{v}{suffix}") for v in values])
    return df.join(back, [*keys, index], "left")


def either(a: DataFrame, b: DataFrame, on: list[str], zero: list[str]) -> DataFrame:
    """Full outer join of two aggregates with missing counts as zero."""
    return a.join(b, on, "full").fillna(0, zero)


def in_domain(counts: DataFrame, domain: DataFrame, on: list[str], value: str) -> DataFrame:
    """Every member of the domain with its count, zero where none was counted."""
    return domain.select(*on).distinct().join(counts, on, "left").withColumn(value, F.coalesce(F.col(value), F.lit(0)))


def replaced_by(base: DataFrame, newer: DataFrame, on: list[str]) -> DataFrame:
    """Rows of newer, and those of base whose keys newer does not have."""
    return newer.unionByName(base.join(newer.select(*on).distinct(), on, "left_anti"), allowMissingColumns=True)


def safe_share(part: Column, whole: Column) -> Column:
    """part / whole where whole is positive."""
    return F.when(whole > 0, part / whole)

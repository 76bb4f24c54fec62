"""Expectations: named SQL rules that drop rows or are counted, never null."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = dict[str, str]

#: 1 to 64 letters, marks, blanks, points, apostrophes and hyphens.
PLAIN_NAME = r"^[\p{L}\p{M} .'-]{1,64}$"


def one_of(column: str, values: Iterable[str]) -> str:
    """Rule text: the column holds one of the values."""
    return f"{column} IN ({', '.join(repr(v) for v in sorted(values))})"


def all_known(columns: Iterable[str], values: Iterable[str]) -> str:
    values = list(values)
    return " AND ".join(f"coalesce({one_of(c, values)}, false)" for c in columns)


def plain_name(column: Column) -> Column:
    return F.coalesce(column.rlike(PLAIN_NAME), F.lit(False))


def holds(rule: str) -> Column:
    return F.coalesce(F.expr(rule), F.lit(False))


def keep_valid(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows for which every rule is true."""
    return df.where(F.coalesce(F.expr(" AND ".join(f"({r})" for r in rules.values())), F.lit(False))) if rules else df


def failure_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """One row: the number of rows that fail each rule, all in one pass."""
    return df.agg(*[F.count_if(~holds(r)).alias(name) for name, r in rules.items()])


def observed(df: DataFrame, rules: Rules, name: str) -> tuple[DataFrame, Observation]:
    """df and an observation that has the failure counts once df was written: no pass of its own."""
    seen = Observation(name)
    return df.observe(seen, *[F.count_if(~holds(r)).alias(k) for k, r in rules.items()]), seen

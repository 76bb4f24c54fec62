"""The driver's queries by name, with the SQL that must agree where there is one."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gaugework.session import importable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with its oracle if SQL has one."""

    def put(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            importable(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return put

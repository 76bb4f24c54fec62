"""What the corpus operators share: shared storage, lineage cuts and small column helpers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gaugework.session import importable, shared_dir, work_dir  # noqa: F401


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, and stays one term whatever the optimizer pushes through it."""
    return F.element_at(F.transform(F.array(value), body), 1)


BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """At most BATCH_ROWS rows in an Arrow batch, for the rest of the session: results are read lazily, so the setting must outlast the call. The default of 10,000 is for short rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone; other letters stay as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fresh_names(df: DataFrame, *stems: str) -> list[str]:
    """Column names that df does not have, whatever the case, so that extra columns of any name do no harm."""
    taken, names = {c.lower() for c in df.columns}, []
    for stem in stems:
        name = f"__{stem}"
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        names.append(name)
    return names


def tasks_for(spark: SparkSession) -> int:
    """Partitions that the session asks for in a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def observed(df: DataFrame, name: str, **aggs: Column) -> tuple[DataFrame, dict]:
    """The same, with aggregates of the rows that ride along with the write; a missing value is 0."""
    watch = Observation(name)
    table = materialize(df.observe(watch, *[agg.alias(k) for k, agg in aggs.items()]), name)
    found = watch.get
    return table, {k: found.get(k) or 0 for k in aggs}


#: A key is hot when it holds more than 1 / HOT of the rows, and more than PIECE of them; its rows are dealt in PIECES.
HOT, PIECE, PIECES = 1000, 1000, 256


def hot_keys(counts: DataFrame, key: Column, total: int, most: int, n: str = "n") -> list[int]:
    """Hot keys (64-bit numbers) of a table of counts by key: fewer than HOT, whatever the data; no job where `most` shows that there are none."""
    least = max(total // HOT, PIECE)
    return [r[0] for r in counts.where(F.col(n) > least).select(key).collect()] if most > least else []


def spread(rows: DataFrame, key: Column, hot: list[int], by: str, pieces: int = PIECES) -> DataFrame:
    """rows with `__salt`: the piece of a hot key that the hash of `by` deals a row to, 0 for others."""
    piece = F.when(key.isin(hot), F.pmod(F.xxhash64(by), F.lit(pieces))).otherwise(0) if hot else F.lit(0)
    return rows.withColumn("__salt", piece.cast("int"))


def copies(rows: DataFrame, key: Column, hot: list[int], pieces: int = PIECES) -> DataFrame:
    """rows once for each piece of their key, to be joined on key and `__salt`."""
    if not hot:
        return rows.withColumn("__salt", F.lit(0))
    every = F.sequence(F.lit(0), F.when(key.isin(hot), pieces - 1).otherwise(0))
    return rows.withColumn("__salt", F.explode(every))


_HELD: dict = {}


def held(kind: str | None = None, key: object = None, make: Callable[[], object] | None = None):
    """What a Python worker keeps between tasks: one thing at a time, made anew when another is asked for.

    Workers outlive queries and stages, and what each operator remembers is of no
    use to the next one; without a kind, all is let go.
    """
    if not kind or _HELD.get("key") != (kind, key):
        if _HELD:
            _HELD.clear()
            gc.collect()
            try:
                ctypes.CDLL(None).malloc_trim(0)  # freed memory goes back to the machine, where the C library can
            except (AttributeError, OSError):
                pass
        if kind and make:
            _HELD.update(key=(kind, key), value=make())
    return _HELD.get("value")

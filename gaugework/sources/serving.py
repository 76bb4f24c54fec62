"""Serving tables: publish in place, replace on a new schema, mirror, rename views, snapshot export."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugework.contract import typed_nulls
from gaugework.operators import change
from gaugework.sources.store import Store

#: Fixed values of the serving contract: tables and their keys.
KEYS = {
    "player_week": ["season", "week", "player_id"],
    "team_week": ["season", "week", "team"],
    "defense_vs_position": ["season", "week", "team", "position"],
    "projections": ["season", "week", "player_id"],
    "risers": ["season", "week", "player_id"],
    "backtest_metrics": ["scope", "position", "method"],
}
MAY_BE_EMPTY = {"risers"}
#: Table properties that a table format with Iceberg metadata would need; plain Parquet tables have none.
ICEBERG_PROPERTIES = {
    "delta.columnMapping.mode": "name",
    "delta.enableIcebergCompatV2": "true",
    "delta.universalFormat.enabledFormats": "iceberg",
    "delta.enableDeletionVectors": "false",
}


def identifier(*parts: str) -> str:
    for part in parts:
        if not re.fullmatch(r"[A-Za-z_]\w*", part, re.ASCII):
            raise ValueError(f"not an identifier: {part!r}")
    return ".".join(f"`{p}`" for p in parts)


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace a table and its schema."""
    typed_nulls(df).write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)


def publish(df: DataFrame, table: str) -> str:
    """Overwrite the rows of a table, which is created if missing and replaced only if its columns differ.

    A replacement is written under another name first and takes the table's name
    when it is whole.
    """
    spark, df = df.sparkSession, typed_nulls(df)
    name = identifier(*table.split("."))
    if not spark.catalog.tableExists(table):
        df.write.saveAsTable(table)
        return "created"
    if spark.table(table).columns == df.columns:
        df.write.insertInto(table, overwrite=True)
        return "overwritten"
    fresh = f"{table}__new"
    df.write.mode("overwrite").saveAsTable(fresh)
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {identifier(*fresh.split('.'))} RENAME TO {identifier(table.split('.')[-1])}")
    return "replaced"


@dataclass(frozen=True)
class Mirrored:
    """A table to mirror: its rows, its keys, and columns whose change alone is none."""

    source: DataFrame
    keys: list[str]
    ignore: tuple[str, ...] = ()
    may_be_empty: bool = False


def mirror_all(root: str, tables: dict[str, Mirrored], most: float = 0.2) -> None:
    """Make the Parquet folders below `root` equal to their sources, all or none, leaving unchanged rows as they were.

    Every merged table passes its guard and is written beside the old one before
    any is renamed; a failure while renaming puts back those that were. Old
    folders stay under another name until the next call.
    """
    if not tables:
        return
    spark = next(iter(tables.values())).source.sparkSession
    store, done = Store(spark, root), []
    for name, t in tables.items():
        path, fresh = store.at(name), store.at(f"_{name}.new")
        rows = t.source
        if store.exists(path):
            before = spark.read.parquet(path)
            change.shrink_guard(before, t.source, t.keys, most, t.may_be_empty)
            rows = change.merged(before, t.source, t.keys, list(t.ignore))
        elif not t.may_be_empty and t.source.limit(1).count() == 0:
            raise change.ShrinkError(f"the source of {name} is empty")
        rows.write.mode("overwrite").parquet(fresh)
    try:
        for name in tables:
            path, old = store.at(name), store.at(f"_{name}.old")
            store.remove(old)
            done.append((name, store.exists(path)))
            if done[-1][1]:
                store.move(path, old)
            store.move(store.at(f"_{name}.new"), path)
    except BaseException:
        for name, had in reversed(done):
            if had and store.exists(store.at(f"_{name}.old")):
                store.remove(store.at(name))
                store.move(store.at(f"_{name}.old"), store.at(name))
            elif not had:
                store.remove(store.at(name))
        raise


def mirror(target: str, source: DataFrame, keys: list[str], ignore: list[str] | None = None, most: float = 0.2, may_be_empty: bool = False) -> None:
    """The same for one folder."""
    root, _, name = target.rstrip("/").rpartition("/")
    mirror_all(root, {name: Mirrored(source, keys, tuple(ignore or ()), may_be_empty)}, most)


def renamed_view(spark: SparkSession, table: str, view: str, names: dict[str, str]) -> None:
    """A view of the table with columns under other names."""
    spark.table(table).select(*[F.col(c).alias(names.get(c, c)) for c in spark.table(table).columns]).createOrReplaceTempView(view)


def export_snapshot(tables: dict[str, DataFrame], allowed: dict[str, list[str]], blank: dict[str, list[str]], folder: str) -> dict:
    """A Parquet folder a table with its allowed columns, some as typed nulls, and a manifest that is written last."""
    manifest, spark = {}, None
    for name, columns in allowed.items():
        df = tables[name]
        spark, kinds = df.sparkSession, dict(df.dtypes)
        out = df.select(*[F.lit(None).cast(kinds[c]).alias(c) if c in blank.get(name, ()) else F.col(c) for c in columns])
        out.write.mode("overwrite").parquet(f"{folder}/{name}")
        manifest[name] = {"columns": columns, "blank": blank.get(name, []), "rows": spark.read.parquet(f"{folder}/{name}").count()}
    if spark is not None:
        Store(spark, folder).write(f"{folder}/manifest.json", iter([json.dumps(manifest, indent=1).encode()]))
    return manifest

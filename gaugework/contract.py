"""Typed contracts over loosely typed sources: casts that never raise, clean ids, code maps, DDL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = ("int", "bigint", "smallint")


def typed(name: str, kind: str, source: str | None = None) -> Column:
    """A column of the contract; what does not parse is null. Whole numbers may be written as 28013.0."""
    raw = F.col(f"`{source or name}`")
    raw = raw.try_cast("double") if kind in WHOLE else raw
    return raw.try_cast(kind).alias(name)


def typed_select(df: DataFrame, contract: dict[str, str], *extra: Column | str) -> DataFrame:
    """The contract's columns of df, and any others asked for."""
    return df.select(*[typed(n, k) for n, k in contract.items()], *extra)


def clean_id(name: str, source: str | None = None) -> Column:
    """An identifier without surrounding blanks; blank and NA are null."""
    value = F.trim(F.col(f"`{source or name}`").cast("string"))
    return F.nullif(F.nullif(value, F.lit("")), F.lit("NA")).alias(name)


def mapped(column: Column, codes: dict[str, str], keep: bool = True) -> Column:
    """The code's entry in a literal map; others stay as they are, or are null."""
    found = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])[column]
    return F.coalesce(found, column) if keep else found


def widened(df: DataFrame) -> DataFrame:
    """Whole numbers as doubles, so that files of several seasons share a schema."""
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.IntegralType) else F.col(f"`{f.name}`") for f in df.schema])


#: Column types of the serving contract, by Spark type.
SERVED = {
    T.BooleanType: "BOOLEAN",
    T.LongType: "NUMBER(19,0)",
    T.IntegerType: "NUMBER(10,0)",
    T.ShortType: "NUMBER(10,0)",
    T.ByteType: "NUMBER(10,0)",
    T.FloatType: "FLOAT",
    T.DoubleType: "FLOAT",
    T.DateType: "DATE",
    T.TimestampType: "TIMESTAMP_TZ",
    T.TimestampNTZType: "TIMESTAMP_NTZ",
    T.StringType: "VARCHAR",
}


def served_type(kind: T.DataType) -> str:
    if type(kind) not in SERVED:
        raise TypeError(f"no serving type for {kind.simpleString()}")
    return SERVED[type(kind)]


def create_table_ddl(table: str, schema: T.StructType, keys: list[str] | None = None) -> str:
    """CREATE TABLE text of the serving contract, one column a line."""
    lines = [f"    {f.name} {served_type(f.dataType)}{'' if f.name not in (keys or ()) else ' NOT NULL'}" for f in schema]
    if keys:
        lines.append(f"    PRIMARY KEY ({', '.join(keys)})")
    return f"CREATE TABLE IF NOT EXISTS {table} (\n" + ",\n".join(lines) + "\n)"


def stale(text: str, table: str, schema: T.StructType, keys: list[str] | None = None) -> bool:
    """Whether generated DDL text differs from what the schema gives now."""
    return " ".join(text.split()) != " ".join(create_table_ddl(table, schema, keys).split())


def typed_nulls(df: DataFrame) -> DataFrame:
    """Columns without a type as string, so that every sink can write them."""
    return df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, T.NullType) else F.col(f"`{f.name}`") for f in df.schema])

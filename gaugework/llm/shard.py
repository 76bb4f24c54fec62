"""Sharding by histogram sort: shards of nearly equal bytes from exact counts.

Every row has the key (hash of its text, hash of its id); in key order, shard
boundaries cut the running sum of bytes at equal parts. Rounds of exact counts
between probes find them (see `ranges`), together with boundaries that split a
shard into ranges of bounded size, so the rows are exchanged once, each range to
a task of its own, sorted there, and numbered with the exact number of rows
before.

Equal texts are neighbours in key order. A boundary that falls into a group of
equal texts moves to the nearer edge of the group where that is within `spare`
of a shard's size; only a larger group is cut.

Defined results: a null text has size 1 and sorts by a hash of its own; ids may
be of any type that can be hashed; rows of equal text and id are not parted and
stand in the order of a hash of all their columns, so rows that differ have
fixed slots; a text of any length is one row of one range; an empty table gives
an empty result. Columns named like an output are replaced. Jobs that find the
boundaries run when `shard` is called, before its result is used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.llm import ranges
from gaugework.llm.common import fresh_names, materialize, tasks_for

#: Parts of a shard's size: how far a boundary may lie from its target, and to spare a group of equal texts.
TOLERANCE, SPARE = 0.001, 0.01
RANGE_BYTES = ranges.RANGE_BYTES
ROW_BITS = (1 << 33) - 1


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def shard(
    docs: DataFrame, shards: int = 8, text: str = "text", doc_id: str = "doc_id", tolerance: float = TOLERANCE, spare: float = SPARE, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """docs with `size`, `shard` (0 to shards - 1) and `slot` (0, 1, ... within the shard, in key order)."""
    spark = docs.sparkSession
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("size", "shard", "slot")])
    h, d, place, row = fresh_names(docs, "h", "d", "range", "row")
    hashable = [f"`{f.name}`" for f in docs.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    keyed = docs.withColumns({h: F.xxhash64(F.col(text).cast("string")), d: F.xxhash64(doc_id), "size": size_of(F.col(text).cast("string"))})
    keys = materialize(keyed.select(F.col(h).alias("h"), F.col(d).alias("d"), "size"), "shard-keys")
    pieces = 1

    def cuts_of(total: int, rows: int) -> list[ranges.Cut]:
        nonlocal pieces
        pieces = max(1, math.ceil(total / shards / range_bytes), math.ceil(min(2 * tasks_for(spark), rows) / shards))
        count, part = shards * pieces, total // shards
        # Only shard boundaries need to be close; ranges inside a shard may differ by a quarter.
        loose = total // (4 * count)
        return [ranges.Cut(total * k // count, *((int(part * tolerance), int(part * spare)) if k % pieces == 0 else (loose, loose))) for k in range(1, count)]

    bounds, before = ranges.splitters(keys, cuts_of)
    rows_below = dict(zip(bounds, before))
    cuts = sorted(rows_below)
    heads = sorted((bounds[k * pieces - 1] for k in range(1, shards)) if bounds else [])
    # Of each range: its shard, and rows before it in that shard.
    table, number, base = [(0, 0)], 0, 0
    for cut in cuts:
        while number < len(heads) and heads[number] <= cut:
            number, base = number + 1, rows_below[cut]
        table.append((number, rows_below[cut] - base))
    shard_of, base_of = (F.split(F.lit(",".join(str(x[k]) for x in table)), ",").cast("array<bigint>") for k in (0, 1))
    dealt = ranges.deal(keyed, F.col(h), F.col(d), cuts).sortWithinPartitions(h, d, F.xxhash64(*hashable))
    # A row's place in its sorted partition; partitions are ranges.
    numbered = dealt.withColumn(row, F.monotonically_increasing_id()).withColumn(place, F.shiftright(row, 33).cast("int"))
    return numbered.withColumns(
        {"shard": F.get(shard_of, F.col(place)).cast("int"), "slot": F.col(row).bitwiseAND(F.lit(ROW_BITS)) + F.get(base_of, F.col(place))}
    ).drop(h, d, place, row)

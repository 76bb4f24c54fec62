"""Exact ranges of a sort key: histogram counts, refined probes, one exchange.

A key is a pair (h, d) of 64-bit numbers; rows of one h are a group. `splitters`
finds keys that cut the running sum of sizes at given targets. The first round
counts bytes and rows in a few cells a target; later rounds put probes only into
the cells of targets that no edge is close enough to. Probes stand at the edges
of groups while a cell holds several, so a group is cut only where neither of
its edges is within the target's room. Counts are exact and nothing is sampled,
so the same rows give the same cuts, whatever the partitions they come in.

The driver holds CELLS numbers a target for one round, and a target is a range
of RANGE_BYTES: 100 TB are 200,000 ranges. Bounds reach the tasks as two literal
arrays and are searched in the row.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOW = -(1 << 63)
SPAN = 1 << 64
RANGE_BYTES = 512 * 1024 * 1024
#: Cells a target in the first round, probes an open target in later ones.
CELLS, PROBES, MAX_ROUNDS = 4, 24, 64


@dataclass(frozen=True)
class Cut:
    """A running sum to cut at, and how far a cut may lie from it: anywhere, and to spare a group."""

    target: int
    room: int
    spare: int


def pack(h: int, d: int) -> int:
    """The key as one number of 128 bits."""
    return (h - LOW) * SPAN + (d - LOW)


def unpack(key: int) -> tuple[int, int]:
    return key // SPAN + LOW, key % SPAN + LOW


def _numbers(values: list[int]) -> Column:
    """A literal array that is one term of the plan, however long."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def interval(h: Column, d: Column, bounds: list[int]) -> Column:
    """How many bounds are at or below the key: binary search, inside the row."""
    if not bounds:
        return F.lit(0)
    pairs = [unpack(b) for b in bounds]
    hs, ds = _numbers([p[0] for p in pairs]), _numbers([p[1] for p in pairs])
    steps = F.array(*[F.lit(1 << k) for k in range(len(bounds).bit_length() - 1, -1, -1)])

    def onward(low: Column, step: Column) -> Column:
        at = low + step - 1
        a = F.get(hs, at)
        return F.when((low + step <= len(bounds)) & ((a < h) | (a == h) & (F.get(ds, at) <= d)), low + step).otherwise(low)

    return F.aggregate(steps, F.lit(0), onward)


def splitters(keys: DataFrame, cuts_of: Callable[[int, int], list[Cut]]) -> tuple[list[int], list[int]]:
    """Boundary keys, and the exact rows below each.

    keys: h, d, size. cuts_of(total size, rows) gives the cuts in ascending order.
    """
    ends = [F.min(F.struct("h", "d")).alias("lo"), F.max(F.struct("h", "d")).alias("hi")]
    edge = keys.agg(F.sum("size").alias("b"), F.count("*").alias("n"), *ends).first()
    if not edge["n"]:
        return [], []
    cuts = cuts_of(edge["b"], edge["n"])
    low, high = pack(*edge["lo"]), pack(*edge["hi"])
    done: list[tuple[int, int] | None] = [None] * len(cuts)
    descended = [False] * len(cuts)  # whether a cut is sought within a group, whose edges are too far
    first = max(PROBES, CELLS * (len(cuts) + 1))
    bounds = {max(low, _group(low + (high - low + 1) * k // first)) for k in range(first)}
    for _ in range(MAX_ROUNDS):
        cells = _count(keys, sorted(bounds), ends)
        reach = [c[2] for c in cells]
        bounds = set()
        for k, cut in enumerate(cuts):
            if done[k] is not None:
                continue
            begin_b, begin_n, end_b, end_n, lo, hi = cells[bisect_left(reach, cut.target)]
            below, above = cut.target - begin_b, end_b - cut.target
            one_group = lo // SPAN == hi // SPAN
            if min(below, above) <= (cut.spare if one_group and not descended[k] else cut.room) or lo == hi:
                # The nearer end of the cell; a cell of one key cannot be cut.
                done[k] = (lo, begin_n) if below <= above else (hi + 1, end_n)
            elif one_group:
                descended[k] = True
                bounds |= {lo + (hi - lo + 1) * j // PROBES for j in range(PROBES)} | {hi + 1}
            else:
                inside = {_group(lo + (hi - lo + 1) * j // PROBES) for j in range(1, PROBES)}
                bounds |= {b for b in inside if b > lo} | {lo, (lo // SPAN + 1) * SPAN, hi // SPAN * SPAN, hi + 1}
        if not bounds:
            found = [x for x in done if x is not None]
            return [x for x, _ in found], [n for _, n in found]
        bounds = {b for b in bounds if b < SPAN * SPAN}
    raise RuntimeError(f"no boundaries after {MAX_ROUNDS} rounds")


def _group(key: int) -> int:
    """The first key of a key's group."""
    return key // SPAN * SPAN


def _count(keys: DataFrame, bounds: list[int], ends: list[Column]) -> list[tuple[int, int, int, int, int, int]]:
    """Cells that hold rows: size and rows before and after each, its least and greatest key. One row a cell comes to the driver."""
    found = keys.groupBy(interval(F.col("h"), F.col("d"), bounds).alias("k")).agg(F.sum("size").alias("b"), F.count("*").alias("n"), *ends)
    table = found.select("k", "b", "n", "lo.*", F.col("hi.h").alias("h2"), F.col("hi.d").alias("d2")).toArrow()
    cells, b, n = [], 0, 0
    for _, size, rows, h, d, h2, d2 in sorted(zip(*(c.to_pylist() for c in table.columns))):
        cells.append((b, n, b + size, n + rows, pack(h, d), pack(h2, d2)))
        b, n = b + size, n + rows
    return cells


def even_cuts(total: int, rows: int, tasks: int, range_bytes: int = RANGE_BYTES) -> list[Cut]:
    """Cuts of about equal ranges, as many as bytes and tasks need, a quarter of a range off at most where keys allow."""
    count = min(max(math.ceil(total / range_bytes), tasks), rows)
    return [Cut(total * k // count, total // (4 * count), total // (4 * count)) for k in range(1, count)]


def deal(df: DataFrame, h: Column, d: Column, bounds: list[int]) -> DataFrame:
    """df with each range in a partition of its own, in the order of ranges: the one exchange."""
    return df.repartitionById(len(bounds) + 1, interval(h, d, bounds))

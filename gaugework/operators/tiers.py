"""Tiers: the best split of sorted values into few contiguous groups, exactly."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: League fixed values: starters of each position in a league of 12, flex depth, ranked pool.
LEAGUE = 12
STARTERS = {"QB": 1, "RB": 2, "WR": 3, "TE": 1}
FLEX_DEPTH = {"RB": 12, "WR": 12, "TE": 4}
POOL = {p: 2 * n * LEAGUE for p, n in STARTERS.items()}


def best_splits(values: np.ndarray, most: int) -> list[tuple[float, list[int]]]:
    """For 1, 2, ... groups: least sum of squares within groups, and where groups start.

    Row k of the programme is a vector operation over row k - 1; the first of
    equal starts is taken.
    """
    n = len(values)
    total, square = np.concatenate([[0.0], np.cumsum(values)]), np.concatenate([[0.0], np.cumsum(values * values)])
    i, j = np.meshgrid(np.arange(n), np.arange(1, n + 1), indexing="ij")
    size = np.maximum(j - i, 1)
    within = np.where(j > i, np.maximum(square[j] - square[i] - (total[j] - total[i]) ** 2 / size, 0.0), np.inf)
    cost, froms, out = within[0], [np.zeros(n, int)], []
    for k in range(1, most + 1):
        if k > 1:
            # cost[j - 1]: values[:j] in k - 1 groups; a last group starts at i >= k - 1.
            table = np.full((n, n), np.inf)
            table[1:] = cost[: n - 1, None] + within[1:]
            froms.append(table.argmin(0))
            cost = table.min(0)
        starts, end = [], n
        for level in range(k - 1, -1, -1):
            end = int(froms[level][end - 1])
            starts.append(end)
        out.append((float(cost[-1]), starts[::-1]))
    return out


def tier_numbers(values: list[float], explained: float = 0.9, most: int = 10) -> list[int]:
    """Tier (1 is best) of each value: the fewest groups that explain that part of the spread."""
    x = np.asarray(values, dtype=float)
    if not len(x):
        return []
    order = np.argsort(-x, kind="stable")
    ranked = x[order]
    spread = float(((ranked - ranked.mean()) ** 2).sum())
    starts = [0]
    if spread > 0:
        for cost, starts in best_splits(ranked, min(most, len(x))):
            if 1 - cost / spread >= explained:
                break
    tiers = np.empty(len(x), int)
    tiers[order] = np.searchsorted(starts, np.arange(len(x)), side="right")
    return tiers.tolist()


def add_tiers(df: DataFrame, keys: list[str], value: str, id_: str, out: str = "tier", pool: int | None = None, rank: str | None = None) -> DataFrame:
    """df with the tier of each ranked row of a group; a group is a position's pool, at most dozens of rows.

    With rank and pool only rows up to that place get a tier.
    """
    chosen = df.where(F.col(rank) <= pool) if pool and rank else df

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([value, id_], ascending=[False, True], kind="stable")
        return rows.assign(**{out: tier_numbers(rows[value].tolist())})[[*keys, id_, out]]

    kinds = dict(df.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in [*keys, id_]) + f", {out} long"
    tiers = chosen.where(F.col(value).isNotNull()).select(*keys, id_, value).groupBy(*keys).applyInPandas(run, schema)
    return df.join(tiers, [*keys, id_], "left")


def start_sit(position: Column, rank: Column) -> Column:
    """Start, Flex or Sit for a place at a position."""
    starters = F.coalesce(*[F.when(position == p, F.lit(n * LEAGUE)) for p, n in STARTERS.items()], F.lit(0))
    flex = F.coalesce(*[F.when(position == p, F.lit(n)) for p, n in FLEX_DEPTH.items()], F.lit(0))
    return F.when(rank <= starters, "Start").when(rank <= starters + flex, "Flex").otherwise("Sit")

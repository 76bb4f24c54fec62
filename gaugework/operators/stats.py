"""Error scorecards, rank correlation, scopes, bands and the paired bootstrap."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugework.operators.windows import EXACT, average_rank

LEAST_FOR_CORRELATION = 5


def correlation(x: str, y: str) -> Column:
    """Pearson correlation; null where either side is constant (plain corr raises there)."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def spearman(df: DataFrame, keys: list[str], x: str, y: str, least: int = LEAST_FOR_CORRELATION, out: str = "spearman") -> DataFrame:
    """Correlation of average ranks of each group; null below `least` rows or for a constant side.

    Ranks are halves, so their sums are exact and constant sides are found exactly.
    """
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = both.withColumn("__x", average_rank(keys, x)).withColumn("__y", average_rank(keys, y))
    n, sx, sy = F.count("*"), F.sum("__x"), F.sum("__y")
    sums = ranked.groupBy(*keys).agg(
        n.alias("n"), sx.alias("sx"), sy.alias("sy"), F.sum(F.col("__x") * F.col("__x")).alias("sxx"), F.sum(F.col("__y") * F.col("__y")).alias("syy"), F.sum(F.col("__x") * F.col("__y")).alias("sxy")
    )
    vx = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")
    r = (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / F.sqrt(vx * vy)
    return sums.withColumn(out, F.when((F.col("n") >= least) & (vx > 0) & (vy > 0), r)).select(*keys, "n", out)


def error_sums(df: DataFrame, keys: list[str], predicted: str, actual: str, low: str | None = None, high: str | None = None) -> DataFrame:
    """Additive sums, from which `error_rates` gives the scores of any union of groups."""
    e = F.col(predicted).cast(EXACT) - F.col(actual).cast(EXACT)
    aggs = [F.count(e).alias("n"), F.sum(F.abs(e)).alias("abs_error"), F.sum((e * e).cast("decimal(28,6)")).alias("sq_error"), F.sum(e).alias("error")]
    if low and high:
        aggs.append(F.count_if(F.col(actual).between(F.col(low), F.col(high))).alias("covered"))
    return df.groupBy(*keys).agg(*aggs)


def error_rates(sums: DataFrame, keys: list[str]) -> DataFrame:
    """mae, rmse, bias and interval coverage from error sums."""
    n = F.col("n")
    out = [
        F.try_divide(F.col("abs_error").cast("double"), n).alias("mae"),
        F.sqrt(F.try_divide(F.col("sq_error").cast("double"), n)).alias("rmse"),
        F.try_divide(F.col("error").cast("double"), n).alias("bias"),
    ]
    if "covered" in sums.columns:
        out.append(F.try_divide(F.col("covered").cast("double"), n).alias("interval_coverage"))
    return sums.select(*keys, "n", *out)


def scoped(df: DataFrame, scope: str, keys: list[str], aggs: list[Column], pooled: str = "all") -> DataFrame:
    """Each scope's groups and, in the same pass, those of all scopes together."""
    sets = [[scope, *keys], keys]
    return df.groupingSets(sets, scope, *keys).agg(F.grouping(scope).alias("__all"), *aggs).withColumn(
        scope, F.when(F.col("__all") == 1, F.lit(pooled)).otherwise(F.col(scope).cast("string"))
    ).drop("__all")


#: Slices of the value range that a hot group's values are numbered in.
SLICES = 1000


def quantiles(df: DataFrame, keys: list[str], value: str, at: list[float], out: str = "quantiles") -> DataFrame:
    """keys and an array of exact quantiles by linear interpolation, nulls not counted.

    Values are counted with partial aggregates, so a task meets distinct values,
    not rows; they are numbered inside slices of the value range, and a slice
    begins where those before it end, so no task sorts a whole hot group.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("__v")).agg(F.count("*").alias("__n"))
    ends = df.agg(F.min(F.col(value).cast("double")).alias("__low"), F.max(F.col(value).cast("double")).alias("__high"))  # one row
    part = F.try_divide(F.col("__v") - F.col("__low"), F.col("__high") - F.col("__low"))
    placed = counted.crossJoin(F.broadcast(ends)).withColumn("__s", F.coalesce(F.floor(part * SLICES), F.lit(0))).drop("__low", "__high")
    before = Window.partitionBy(*keys).orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    slices = placed.groupBy(*keys, "__s").agg(F.sum("__n").alias("__m")).withColumns({"__begin": F.coalesce(F.sum("__m").over(before), F.lit(0)), "__all": F.sum("__m").over(Window.partitionBy(*keys))})
    upto = Window.partitionBy(*keys, "__s").orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    on = F.col("a.__s") == F.col("b.__s")
    for test in same:
        on = on & test
    ranked = placed.withColumn("__end", F.sum("__n").over(upto)).alias("a").join(slices.alias("b"), on).select("a.*", "b.__begin", "b.__all")
    ranked = ranked.withColumns({"__last": F.col("__begin") + F.col("__end") - 1, "__first": F.col("__begin") + F.col("__end") - F.col("__n")})
    spot = lambda q: (F.col("__all") - 1) * F.lit(float(q))
    here = lambda rank: (F.col("__first") <= rank) & (rank <= F.col("__last"))
    aggs = []
    for k, q in enumerate(at):
        low = F.floor(spot(q))
        high = F.least(low + 1, F.col("__all") - 1)
        aggs += [F.max(F.when(here(low), F.col("__v"))).alias(f"l{k}"), F.max(F.when(here(high), F.col("__v"))).alias(f"h{k}"), F.max(spot(q) - low).alias(f"p{k}")]
    found = ranked.groupBy(*keys).agg(*aggs)
    between = lambda k: F.col(f"l{k}") + (F.col(f"h{k}") - F.col(f"l{k}")) * F.col(f"p{k}")
    return found.select(*keys, F.array(*[between(k) for k in range(len(at))]).alias(out))


def bands(df: DataFrame, keys: list[str], centre: str, residual: str, bins: int = 20, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """Quantiles of the residual by quantile bin of the centre: bin, its mean centre, low and high.

    Bins come from exact quantiles of each group, a row a group; the upper ends
    never fall from bin to bin.
    """
    marks = quantiles(df, keys, centre, [k / bins for k in range(1, bins)], "__marks")
    placed = df.join(marks, keys).withColumn("bin", F.size(F.filter("__marks", lambda m: m <= F.col(centre)))).drop("__marks")
    cells = placed.groupBy(*keys, "bin").agg(F.try_divide(F.sum(F.col(centre).cast(EXACT)).cast("double"), F.count(centre)).alias("centre"), F.count("*").alias("n"))
    ends = quantiles(placed, [*keys, "bin"], residual, [low, high], "__ends")
    cells = cells.join(ends, [*keys, "bin"], "left").select(*keys, "bin", "centre", F.get("__ends", 0).alias("low"), F.get("__ends", 1).alias("high"), "n")
    upto = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cells.withColumn("high", F.max("high").over(upto))


def interpolated(points: DataFrame, knots: DataFrame, keys: list[str], at: str, x: str, ys: list[str]) -> DataFrame:
    """points with each y between the knots of its group, flat beyond the ends.

    knots has a bounded row a group (bins), gathered into one array of the group.
    """
    lists = knots.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(x).alias("x"), *ys))).alias("__k"))
    rows = points.join(lists, keys, "left")
    below = F.filter("__k", lambda k: k["x"] <= F.col(at))
    rows = rows.withColumn("__a", F.get(F.col("__k"), F.size(below) - 1)).withColumn("__b", F.get(F.col("__k"), F.size(below)))
    for y in ys:
        a, b = F.col(f"__a.{y}"), F.col(f"__b.{y}")
        part = F.try_divide(F.col(at) - F.col("__a.x"), F.col("__b.x") - F.col("__a.x"))
        rows = rows.withColumn(y, F.when(F.col("__a").isNull(), b).when(F.col("__b").isNull(), a).otherwise(a + (b - a) * part))
    return rows.drop("__k", "__a", "__b")


def weighted_mean(value: str, weight: str) -> Column:
    return F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(F.when(F.col(value).isNotNull(), F.col(weight))))


def paired_bootstrap(
    cluster_sums: DataFrame, keys: list[str], a: str, b: str, n: str, resamples: int = 10_000, seed: int = 0, level: float = 0.95
) -> DataFrame:
    """Mean difference of two errors with a percentile interval, resampling whole clusters.

    cluster_sums has one row a cluster (a week): sums of either error and the
    count, so a group is as long as it has weeks, however many rows they had.
    """
    tail = (1 - level) / 2

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([c for c in rows.columns if c not in (*keys, a, b, n)] or [a, b, n], kind="stable")
        x, y, count = (rows[c].to_numpy(float) for c in (a, b, n))
        draws = np.random.default_rng(seed).multinomial(len(rows), np.full(len(rows), 1 / len(rows)), size=resamples)
        diffs = (draws @ (x - y)) / (draws @ count)
        head = {k: [rows[k].iloc[0]] for k in keys}
        low, high = np.percentile(diffs, [100 * tail, 100 * (1 - tail)])
        return pd.DataFrame(head | {"clusters": [len(rows)], "gap": [(x - y).sum() / count.sum()], "low": [low], "high": [high]})

    kinds = dict(cluster_sums.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", clusters long, gap double, low double, high double"
    return cluster_sums.groupBy(*keys).applyInPandas(run, schema)

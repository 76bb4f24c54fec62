"""Projection model: a regressor for each part of a stat line and position, with quantile bands.

Spark ML fits on the executors. Yardage has gradient-boosted trees; counts have a
Poisson regression with a log link, since Spark's trees have no Poisson loss.
The numbers differ from those of another library's trees and are not compared
with them; seasons are walked forward and refitted only if their inputs changed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.pipeline import Pipeline, PipelineModel
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugework.functions import scoring
from gaugework.operators import stats
from gaugework.operators.change import fingerprint
from gaugework.plans import contracts as c
from gaugework.plans.features import COMPONENTS, FEATURES, KEY, with_baselines

YARDS = {"passing_yards", "rushing_yards", "receiving_yards"}
PASSING = ("passing_yards", "passing_tds", "passing_interceptions")
RECEIVING = ("receptions", "receiving_yards", "receiving_tds")
SHARED = ("rushing_yards", "rushing_tds", "fumbles_lost", "two_point_conversions")
PARTS = {p: ((*PASSING, *SHARED) if p == "QB" else (*RECEIVING, *SHARED)) for p in c.POSITIONS}
FORMATS = {"ppr": "ppr", "half": "half", "std": "standard"}
BINS, LOW, HIGH, FOLDS = 20, 0.1, 0.9, 3
OUTPUTS = [f"proj_{x}" for x in COMPONENTS] + [f"proj_{f}" for f in FORMATS] + [f"{k}_{f}" for f in FORMATS for k in ("floor", "ceiling")]


def _numbers(rows: DataFrame, columns: list[str]) -> DataFrame:
    """rows with a double beside each of these columns, which keep their types."""
    return rows.withColumns({f"{f}__n": F.col(f).cast("double") for f in columns})


def fit_part(rows: DataFrame, part: str, features: list[str], rounds: int = 20, depth: int = 4) -> PipelineModel | None:
    """A model of one part, or None where it never happened."""
    usable = [f for f, n in rows.agg(*[F.count(f).alias(f) for f in features]).first().asDict().items() if n]
    if rows.where(F.col(part) != 0).limit(1).count() == 0:
        return None
    numbers, filled = [f"{f}__n" for f in usable], [f"{f}__x" for f in usable]
    stages = [Imputer(inputCols=numbers, outputCols=filled), VectorAssembler(inputCols=filled, outputCol="__raw"), StandardScaler(inputCol="__raw", outputCol="__v", withMean=True)]
    if part in YARDS:
        stages.append(GBTRegressor(featuresCol="__raw", labelCol=part, predictionCol="__p", maxIter=rounds, maxDepth=depth, seed=0))
    else:
        stages.append(GeneralizedLinearRegression(featuresCol="__v", labelCol=part, predictionCol="__p", family="poisson", link="log", regParam=1.0, maxIter=25))
    return Pipeline(stages=stages).fit(_numbers(rows, usable).withColumn(part, F.col(part).cast("double") if part in YARDS else F.greatest(F.col(part).cast("double"), F.lit(0.0))))


def line(rows: DataFrame, parts: dict[str, PipelineModel | None], features: list[str]) -> DataFrame:
    """rows with proj_ of every part; parts that are not modelled are zero, counts never below it."""
    out = _numbers(rows, features)
    for part in COMPONENTS:
        model = parts.get(part)
        if model is None:
            out = out.withColumn(f"proj_{part}", F.lit(0.0))
            continue
        keep = out.columns
        value = F.col("__p") if part in YARDS else F.greatest(F.col("__p"), F.lit(0.0))
        out = model.transform(out).select(*keep, value.alias(f"proj_{part}"))
    named = {x: F.col(f"proj_{x}") for x in COMPONENTS}
    return out.withColumns({f"proj_{f}": scoring.points(preset, stats=named) for f, preset in FORMATS.items()}).drop(*[f"{f}__n" for f in features])


def season_folds(rows: DataFrame, folds: int = FOLDS) -> DataFrame:
    """rows with a fold of whole seasons (weeks where there is one season), of nearly equal sizes.

    The groups, a few, are dealt largest first to the smallest fold.
    """
    by = "season" if rows.select("season").distinct().count() > 1 else "week"
    sizes = sorted(((r[by], r["n"]) for r in rows.groupBy(by).agg(F.count("*").alias("n")).collect()), key=lambda x: (-x[1], x[0]))  # one row a season
    load, fold = [0] * min(folds, len(sizes)), {}
    for group, n in sizes:
        k = load.index(min(load))
        load[k] += n
        fold[group] = k
    table = F.create_map(*[F.lit(x) for p in fold.items() for x in p])
    return rows.withColumn("fold", table[F.col(by)])


@dataclass
class Projector:
    """Fitted parts and bands by position."""

    features: list[str]
    parts: dict[str, dict[str, PipelineModel | None]] = field(default_factory=dict)
    bands: dict[str, DataFrame] = field(default_factory=dict)

    @classmethod
    def fit(cls, rows: DataFrame, features: list[str] | None = None, positions: Iterable[str] = c.POSITIONS, **settings) -> Projector:
        model = cls(list(features or FEATURES))
        for position in positions:
            mine = rows.where(F.col("position") == position).cache()
            if mine.limit(1).count() == 0:
                raise ValueError(f"no rows of {position} to fit on")
            fit_all = lambda r: {p: fit_part(r, p, model.features, **settings) for p in PARTS[position]}  # noqa: E731, B023
            model.parts[position] = fit_all(mine)
            folded = season_folds(mine)
            held = None
            for k in [r["fold"] for r in folded.select("fold").distinct().collect()]:  # at most FOLDS
                part = line(folded.where(F.col("fold") == k), fit_all(folded.where(F.col("fold") != k)), model.features)
                held = part if held is None else held.unionByName(part)
            model.bands[position] = band_knots(held, "proj_ppr", "fantasy_points_ppr").cache()
            model.bands[position].count()
            mine.unpersist()
        return model

    def predict(self, rows: DataFrame) -> DataFrame:
        """rows with the columns of OUTPUTS; floors and ceilings enclose the projection."""
        out = None
        for position, parts in self.parts.items():
            mine = line(rows.where(F.col("position") == position), parts, self.features).withColumn("__one", F.lit(1))
            mine = stats.interpolated(mine, self.bands[position].withColumn("__one", F.lit(1)), ["__one"], "proj_ppr", "centre", ["low", "high"]).drop("__one")
            for f in FORMATS:
                ratio = F.coalesce(_ratio(F.col(f"proj_{f}"), F.col("proj_ppr")), F.lit(1.0))
                mine = mine.withColumns({f"floor_{f}": F.least(F.col("low") * ratio, F.col(f"proj_{f}")), f"ceiling_{f}": F.greatest(F.col("high") * ratio, F.col(f"proj_{f}"))})
            mine = mine.drop("low", "high")
            out = mine if out is None else out.unionByName(mine)
        return out

    def save(self, spark: SparkSession, folder: str) -> None:
        """Write the parts and bands below a folder; a mark is written last, by which the model is whole."""
        for position, parts in self.parts.items():
            for part, fitted in parts.items():
                if fitted is not None:
                    fitted.write().overwrite().save(f"{folder}/{position}/{part}")
            self.bands[position].write.mode("overwrite").parquet(f"{folder}/{position}/_bands")
        layout = [(position, part, fitted is not None) for position, parts in self.parts.items() for part, fitted in parts.items()]
        spark.createDataFrame([(",".join(self.features),)], "features string").write.mode("overwrite").parquet(f"{folder}/_features")
        spark.createDataFrame(layout, "position string, part string, fitted boolean").write.mode("overwrite").parquet(f"{folder}/_done")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Projector:
        """A saved model, to predict with."""
        model = cls(spark.read.parquet(f"{folder}/_features").first()["features"].split(","))
        for r in spark.read.parquet(f"{folder}/_done").collect():  # a row a part
            model.parts.setdefault(r["position"], {})[r["part"]] = PipelineModel.load(f"{folder}/{r['position']}/{r['part']}") if r["fitted"] else None
            model.bands[r["position"]] = spark.read.parquet(f"{folder}/{r['position']}/_bands")
        return model


def _ratio(part, whole):
    return F.when(whole > 0, part / whole)


def band_knots(rows: DataFrame, projected: str, actual: str, bins: int = BINS) -> DataFrame:
    """Median projection and non-decreasing low and high quantiles of the actual, by quantile bin: at most `bins` rows."""
    marks = F.array_distinct(F.percentile(projected, F.array(*[F.lit(k / bins) for k in range(bins + 1)])))
    edges = rows.agg(marks.alias("edges"))
    at = F.least(F.greatest(F.size(F.filter("edges", lambda e: e <= F.col(projected))) - 1, F.lit(0)), F.greatest(F.size("edges") - 2, F.lit(0)))
    cells = rows.crossJoin(F.broadcast(edges)).withColumn("bin", at).groupBy("bin").agg(F.median(projected).alias("centre"), F.percentile(actual, F.lit(LOW)).alias("low"), F.percentile(actual, F.lit(HIGH)).alias("high"))
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # at most `bins` rows
    return cells.select("centre", F.max("low").over(upto).alias("low"), F.max("high").over(upto).alias("high"))


def walk_forward(rows: DataFrame, seasons: Iterable[int], before_week: dict[int, int] | None = None, stored: DataFrame | None = None, fit: Callable | None = None, **settings) -> DataFrame | None:
    """Projections of each season's finished weeks by a model of the seasons before it.

    A season's version has the fingerprint of what it is fitted on and what it
    projects; where stored rows have the same version they are taken instead.
    fit: what makes a model of past rows, Projector.fit unless another is given.
    """
    done, out = rows.where("is_final"), None
    inputs = list(dict.fromkeys([*KEY, "position", *FEATURES, *COMPONENTS, "fantasy_points_ppr"]))
    for season in sorted(set(seasons)):
        past, now = done.where(F.col("season") < season), done.where(F.col("season") == season)
        if before_week and season in before_week:
            now = now.where(F.col("week") < before_week[season])
        if not past.limit(1).count() or not now.limit(1).count():
            continue
        prints = [df.select(*inputs).agg(fingerprint(df.select(*inputs), repr(sorted(settings.items())), repr((BINS, FOLDS, PARTS))).alias("f")).first()["f"] for df in (past, now)]
        version = f"walk-forward-{season}-{prints[0][:6]}{prints[1][:6]}"
        mine = None
        if stored is not None:
            same = stored.where(F.col("model_version") == version).select(*KEY, *OUTPUTS)
            if same.count() == now.count() and now.join(same, KEY, "left_anti").limit(1).count() == 0:
                mine = now.join(same, KEY)
        if mine is None:
            mine = (fit or Projector.fit)(past, **settings).predict(now)
        part = with_baselines(mine).withColumns({"kind": F.lit("backtest"), "model_version": F.lit(version)})
        out = part if out is None else out.unionByName(part)
    return out

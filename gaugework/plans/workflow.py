"""The whole job, landing to serving, as a chain of steps over stored tables.

Each step reads tables that those before it have written and writes its own whole,
under another name first, so a step may be repeated after a failure and a
finished step is never half done. Nothing but a few numbers comes to the driver.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugework.operators.change import fingerprint
from gaugework.plans import contracts as c
from gaugework.plans import features as fx
from gaugework.plans import graph, marts, model
from gaugework.plans import projections as pj
from gaugework.sources import serving
from gaugework.sources.landing import Landing, Source, read_landing
from gaugework.sources.store import Store

log = logging.getLogger(__name__)
TEST_SEASONS = (2023, 2024, 2025)
#: Tables that are served; only risers may be empty, as they are out of season.
SERVED = ("player_week", "team_week", "defense_vs_position", "projections", "risers", "backtest_metrics")
#: A later run of the same data differs in these alone, which is no change.
STAMPS = ("generated_at",)


class Failed(RuntimeError):
    """A step that did not succeed in all its attempts."""


@dataclass
class Tables(Mapping):
    """Tables below a root, by name; a written one replaces the old when it is whole."""

    spark: SparkSession
    root: str

    @property
    def store(self) -> Store:
        return Store(self.spark, self.root)

    def __contains__(self, name: object) -> bool:
        return self.store.exists(self.store.at(str(name)))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self:
            raise KeyError(name)
        return self.spark.read.parquet(self.store.at(name))

    def __iter__(self):
        return iter(sorted({f.split("/")[0] for f in self.store.files(self.root)}))

    def __len__(self) -> int:
        return len(list(iter(self)))

    def put(self, name: str, df: DataFrame) -> DataFrame:
        fresh = self.store.fresh(name)
        df.write.parquet(fresh)
        self.store.remove(self.store.at(name))
        self.store.move(fresh, self.store.at(name))
        return self[name]


@dataclass
class Job:
    """What a run works on: a landing zone, tables, the serving folder, the moment, and how to fit."""

    spark: SparkSession
    landing: str
    root: str
    now: datetime
    sources: tuple[Source, ...] = ()
    fetch: Callable[[str], object] | None = None
    seasons: tuple[int, ...] = ()
    test_seasons: tuple[int, ...] = TEST_SEASONS
    settings: dict = field(default_factory=dict)

    @property
    def tables(self) -> Tables:
        return Tables(self.spark, f"{self.root}/tables")

    @property
    def moment(self):
        return F.lit(self.now).cast("timestamp")


def ingest(job: Job) -> None:
    """Land what is new."""
    if job.fetch is not None:
        Landing(job.spark, job.landing, job.fetch).ingest(job.sources, job.seasons, max(job.seasons))


def build(job: Job) -> None:
    """Silver and gold from the landing zone, each dataset once; datasets read what has been written."""
    bronze = {graph.bronze_name(k): v for k, v in read_landing(job.spark, job.landing, graph.LANDED).items()}
    built = dict(bronze)
    for name in graph.order():
        node = graph.GRAPH[name]
        built[name] = job.tables.put(name, graph.quality.keep_valid(node.build(*[built[i] for i in node.inputs]), c.DROP.get(name, {})))


def prepare(job: Job) -> None:
    """Feature rows of every finished week and of the next one; a row's features never depend on other rows."""
    t = job.tables
    week = job.tables.put("upcoming", pj.upcoming_week(t["team_week"]))
    weeks = t["team_week"].where("is_final").select("season", "week").unionByName(week)
    pool = fx.candidates(t, weeks)
    t.put("features", fx.with_actuals(fx.features(pool, t), t["player_week"]))


def train(job: Job) -> None:
    """The walk-forward backtest, refitted only where its inputs changed, its metrics, and the model of the next week."""
    t, limits = job.tables, {}
    for r in t["upcoming"].collect():  # one row at most
        limits[r["season"]] = r["week"]
    stored = t["backtest_rows"] if "backtest_rows" in t else None
    rows = model.walk_forward(t["features"], [*job.test_seasons, *limits], limits, stored, **job.settings)
    if rows is None:
        raise ValueError("no season could be projected")
    rows = t.put("backtest_rows", rows)
    t.put("backtest", pj.published(rows, "backtest", F.col("model_version"), job.moment))
    t.put("backtest_metrics", pj.evaluate(rows, t["ecr"], list(job.test_seasons)))
    if not limits:
        return
    past = _history(t["features"], *next(iter(limits.items())))
    version = past.agg(fingerprint(past.select(*fx.KEY, *fx.FEATURES, *fx.COMPONENTS), repr(sorted(job.settings.items()))).alias("f")).first()["f"][:12]
    at = f"{job.root}/models/{version}"
    if not Store(job.spark, job.root).exists(f"{at}/_done"):
        model.Projector.fit(past, **job.settings).save(job.spark, at)
    t.put("champion", job.spark.createDataFrame([(version, at)], "version string, path string"))


def _history(rows: DataFrame, season: int, week: int) -> DataFrame:
    return rows.where(F.col("is_final") & (fx.time_key() < season * 100 + week))


def score(job: Job) -> None:
    """Projections of the next week's games that have not begun; stored ones of games that have stay."""
    t = job.tables
    week = t["upcoming"]
    if week.isEmpty():
        return
    rows = t["features"].join(F.broadcast(week), ["season", "week"], "left_semi")  # one row
    pj.check_pool(rows, t["team_week"].join(F.broadcast(week), ["season", "week"], "left_semi"))
    version, path = t["champion"].first()
    fresh = pj.published(model.Projector.load(job.spark, path).predict(rows), "live", version, job.moment)
    t.put("live", pj.frozen(t["live"] if "live" in t else None, fresh, job.moment))


def publish(job: Job) -> None:
    """Served tables from the backtest and live rows, checked, and mirrored all or none."""
    t = job.tables
    t.put("projections", pj.assembled(t["backtest"], t["live"] if "live" in t else None, t["ecr"]))
    season = t["upcoming"].select("season", F.explode(F.sequence(F.lit(2), F.greatest("week", F.lit(2)))).alias("week"))
    t.put("risers", pj.risers(t["player_week"], season))
    if wrong := {k: n for k, n in marts.checks({name: t[name] for name in SERVED}).items() if n}:
        raise ValueError(f"rows break the marts' invariants: {wrong}")
    sources = {name: serving.Mirrored(t[name], serving.KEYS[name], tuple(x for x in STAMPS if x in t[name].columns), name in serving.MAY_BE_EMPTY) for name in SERVED}
    serving.mirror_all(f"{job.root}/served", sources)


STEPS: tuple[Callable[[Job], None], ...] = (ingest, build, prepare, train, score, publish)


def run(job: Job, steps: Iterable[Callable[[Job], None]] = STEPS, attempts: int = 2) -> list[tuple[str, int]]:
    """All steps in turn, each tried again if it fails; (step, attempts it took)."""
    done = []
    for step in steps:
        for attempt in range(1, attempts + 1):
            try:
                step(job)
                done.append((step.__name__, attempt))
                break
            except pj.ThinPool:
                raise
            except Exception as error:
                if attempt == attempts:
                    raise Failed(f"{step.__name__} failed {attempts} times") from error
                log.warning("%s failed, attempt %s", step.__name__, attempt, exc_info=True)
    return done

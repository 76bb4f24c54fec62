"""The whole job on the made-up league: landing files to served tables, twice."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugework.operators.change import ShrinkError
from gaugework.plans import contracts as c
from gaugework.plans import graph, model, workflow
from gaugework.plans import projections as pj
from gaugework.sources import serving
from tests.test_datasets import LAST, league


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    """Files as a landing zone has them: one a season, or one snapshot."""
    import pandas as pd

    raw, root = league(), tmp_path_factory.mktemp("landing")
    ids = {x[0][3:]: 1000 + k for k, x in enumerate(raw["players"])}
    frames = {
        "pbp": (raw["plays"], list(c.CONTRACTS["plays"])), "player_stats": (raw["box"], list(c.CONTRACTS["player_stats"])), "snap_counts": (raw["snaps"], list(c.CONTRACTS["snap_counts"])),
        "rosters": (raw["rosters"], ["gsis_id", "season", "week", "game_type", "team", "full_name", "position", "status", "years_exp", "rookie_year"]),
        "injuries": (raw["injuries"], ["gsis_id", "season", "game_type", "week", "team", "full_name", "position", "report_primary_injury", "report_status", "practice_status"]),
        "depth_charts": (raw["charts"], ["gsis_id", "season", "week", "game_type", "club_code", "formation", "depth_position", "full_name", "depth_team"]),
        "ff_opportunity": (raw["opportunity"], list(c.CONTRACTS["ff_opportunity"])), "schedules": (raw["games"], list(c.CONTRACTS["schedules"])),
        "players": ([(x[0], x[1], x[2], x[2], "P" + x[0], "2000-02-01", "2020", "1", "2", x[3]) for x in raw["players"]],
                    ["gsis_id", "display_name", "position", "position_group", "pfr_id", "birth_date", "rookie_season", "draft_round", "draft_pick", "latest_team"]),
        "player_ids": ([(str(v) + ".0", "00-" + k) for k, v in ids.items()], ["fantasypros_id", "gsis_id"]),
        "ecr": ([(n, str(ids[i]), *rest) for n, i, *rest in raw["ecr"]], ["player", "id", "pos", "team", "ecr", "sd", "best", "worst", "scrape_date", "season"]),
    }
    snapshots = {"schedules", "players", "player_ids"}
    for name, (rows, columns) in frames.items():
        df = pd.DataFrame(rows, columns=columns)
        parts = [("", df)] if name in snapshots else [(f"{int(s)}/", g) for s, g in df.groupby(df["season"].astype(float).astype(int))]
        for folder, part in parts:
            at = root / name / folder
            at.mkdir(parents=True, exist_ok=True)
            part = part.drop(columns=["season"]) if name == "ecr" else part
            part.to_parquet(at / f"{name}_{'0' * 12}.parquet", index=False, coerce_timestamps="us")
    return str(root)


class Fake(model.Projector):
    """A model that projects the last points; fitting and loading are counted."""

    fits: list = []

    @classmethod
    def fit(cls, rows, **_):
        cls.fits.append(1)
        return cls([])

    def save(self, spark, folder):
        spark.createDataFrame([(1,)], "k int").write.mode("overwrite").parquet(f"{folder}/_done")

    @classmethod
    def load(cls, spark, folder):
        return cls([])

    def predict(self, rows):
        base = F.coalesce(F.col("ppr_last3"), F.lit(1.0)).cast("double")
        return rows.withColumns({x: (base / 2 if x.startswith("floor") else base * 2 if x.startswith("ceiling") else base) for x in model.OUTPUTS})


def test_landing_to_serving_and_again(spark, landing, tmp_path, monkeypatch):
    monkeypatch.setattr(model, "Projector", Fake)
    job = workflow.Job(spark, landing, str(tmp_path / "job"), dt.datetime(2025, 9, 20), test_seasons=(2024,))
    assert workflow.run(job) == [(s.__name__, 1) for s in workflow.STEPS]
    fits = len(Fake.fits)
    served = {name: spark.read.parquet(f"{job.root}/served/{name}") for name in workflow.SERVED}
    for name, df in served.items():
        keys = serving.KEYS[name]
        assert df.count() > 0 and df.groupBy(*keys).count().where("count > 1").count() == 0, name
    rows = served["projections"]
    live = rows.where(f"season = {LAST[0]} AND week = {LAST[1]}")
    assert {r["kind"] for r in live.select("kind").distinct().collect()} == {"live"} and rows.where("kind = 'backtest'").count() > 0
    before, n_live = {tuple(r) for r in rows.drop("generated_at").collect()}, live.count()
    # The same data an hour later: nothing is fitted again, and rows that did not change keep their stamp.
    later = workflow.Job(spark, landing, job.root, dt.datetime(2025, 9, 20, 1), test_seasons=(2024,))
    workflow.run(later)
    assert len(Fake.fits) == fits
    again = spark.read.parquet(f"{job.root}/served/projections")
    assert {tuple(r) for r in again.drop("generated_at").collect()} == before
    assert {r["generated_at"] for r in again.select("generated_at").distinct().collect()} == {dt.datetime(2025, 9, 20)}
    # The upcoming week alone has the same features.
    t = job.tables
    assert t["features"].join(t["upcoming"], ["season", "week"], "left_semi").count() == n_live
    # A thin pool stops the job before anything is published.
    thin = t["features"].where(f"NOT (season = {LAST[0]} AND week = {LAST[1]} AND team = 'DET')")
    t.put("features", thin)
    with pytest.raises(pj.ThinPool, match="DET"):
        workflow.run(later, (workflow.score, workflow.publish))


def test_steps_are_tried_again(spark, tmp_path):
    job, calls = workflow.Job(spark, "", str(tmp_path), dt.datetime(2025, 9, 20)), []

    def flaky(job):
        calls.append(1)
        if len(calls) < 2:
            raise OSError("lost")

    def broken(job):
        raise OSError("gone")

    assert workflow.run(job, (flaky,)) == [("flaky", 2)]
    with pytest.raises(workflow.Failed, match="broken failed 2 times"):
        workflow.run(job, (broken,))


def test_mirrors_change_all_or_none(spark, tmp_path):
    rows = spark.createDataFrame([(k, "a") for k in range(10)], "k int, v string")
    root, one = str(tmp_path / "m"), lambda df: serving.Mirrored(df, ["k"])
    serving.mirror_all(root, {"a": one(rows), "b": one(rows)})
    with pytest.raises(ShrinkError):
        serving.mirror_all(root, {"a": one(rows.withColumn("v", F.lit("b"))), "b": one(rows.limit(1))})
    assert {r["v"] for r in spark.read.parquet(f"{root}/a").collect()} == {"a"}
    serving.mirror_all(root, {"a": one(rows.withColumn("v", F.lit("b"))), "b": one(rows)})
    assert {r["v"] for r in spark.read.parquet(f"{root}/a").collect()} == {"b"} and graph.LANDED


def test_saved_model_predicts_the_same(spark, tmp_path):
    rows = spark.range(120).select(
        F.lit("QB").alias("position"), (F.col("id") % 3 + 2022).cast("int").alias("season"), (F.col("id") % 10).cast("int").alias("week"), (F.col("id") % 17).cast("double").alias("x"),
        *[((F.col("id") * (k + 3)) % 7).cast("int").alias(p) for k, p in enumerate(model.PARTS["QB"])], ((F.col("id") * 5) % 31).cast("double").alias("fantasy_points_ppr"),
    )
    fitted = model.Projector.fit(rows, ["x"], positions=["QB"], rounds=2, depth=2)
    folder = str(tmp_path / "model")
    fitted.save(spark, folder)
    loaded = model.Projector.load(spark, folder)
    one, two = (sorted(tuple(r) for r in m.predict(rows).select("x", "proj_ppr", "floor_ppr", "ceiling_ppr").collect()) for m in (fitted, loaded))
    assert one == two

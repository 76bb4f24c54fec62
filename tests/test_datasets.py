"""Datasets, features, projections and marts on a small made-up league."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugework import quality
from gaugework.plans import contracts as c
from gaugework.plans import datasets as d
from gaugework.plans import features as f
from gaugework.plans import graph, marts, model
from gaugework.plans import projections as p

TEAMS = ["DET", "GB", "MIN", "CHI"]
SEASONS = (2023, 2024, 2025)
WEEKS = range(1, 6)
LAST = (2025, 5)  # not played yet


def league(seed=0):
    rng = np.random.default_rng(seed)
    games, plays, box, snaps, rosters, charts, injuries, opportunity, ecr = ([] for _ in range(9))
    players = [(f"00-{t}{pos}{k}", f"{pos}x {t.title()} {k}", pos, t) for t in TEAMS for pos, n in (("QB", 2), ("RB", 2), ("WR", 3), ("TE", 2)) for k in range(n)]
    for s in SEASONS:
        for w in WEEKS:
            sunday = dt.date(s, 9, 1) + dt.timedelta(days=(6 - dt.date(s, 9, 1).weekday()) % 7 + 7 * (w - 1))
            order = TEAMS if w % 2 else TEAMS[1:] + TEAMS[:1]
            done = (s, w) != LAST
            for home, away in ((order[0], order[1]), (order[2], order[3])):
                gid = f"{s}_{w:02d}_{away}_{home}"
                score = lambda: str(int(rng.integers(3, 40))) if done else None  # noqa: E731, B023
                games.append((gid, float(s), "REG", float(w), str(sunday), "13:00", away, home, score(), score(), float(rng.integers(-9, 9)), 44.5, "dome"))
                for team, other in ((home, away), (away, home)):
                    if not done:
                        continue
                    for k in range(30):
                        kind = ["pass", "run", "punt"][k % 3]
                        who = [x[0] for x in players if x[3] == team]
                        plays.append((gid, k + (100 if team == home else 0), s, "REG", w, team, other, kind, int(rng.integers(1, 5)), int(rng.integers(1, 99)), int(kind == "run"), int(kind == "pass"), int(k == 27), None,
                                      who[2] if kind == "run" else None, who[5] if kind == "pass" and k != 27 else None, who[0] if kind == "pass" else None, 7.0, 4, 0))
                    for pid, name, pos, t in players:
                        if t != team or (pid.endswith("2") and w % 3 == 0):
                            continue
                        rec, yards, td, car, ry = int(rng.integers(0, 9)), int(rng.integers(0, 120)), int(rng.integers(0, 2)), int(rng.integers(0, 20)), int(rng.integers(0, 90))
                        py, ptd, pint = (int(rng.integers(100, 400)), int(rng.integers(0, 4)), int(rng.integers(0, 3))) if pos == "QB" else (0, 0, 0)
                        std = yards * 0.1 + ry * 0.1 + td * 6 + py * 0.04 + ptd * 4 - pint * 2
                        box.append((pid, name, pos, pos, float(s), float(w), "REG", gid, team, other, 20.0, 30.0, float(py), float(ptd), float(pint), 1.0, 0.0, 200.0, 0.0, float(car), float(ry), 0.0, 0.0, 0.0,
                                    float(rec), float(rec + 2), float(yards), float(td), 0.0, float(yards + 10), 0.0, 0.0, std, std + rec))
                        snaps.append((gid, float(s), "REG", float(w), "P" + pid, name, pos, team, other, 40.0, 0.6))
                        opportunity.append((float(s), float(w), gid, pid, pos, float(rng.uniform(2, 20)), 0.5, 50.0))
            for pid, name, pos, team in players:
                rosters.append((pid, float(s), float(w), "REG", team, name, pos, "ACT", float(s - 2020), 2020.0))
                charts.append((pid, float(s), float(w), "REG", team, "Offense", pos, name, str(int(pid[-1]) + 1)))
                if pos != "QB" or rng.random() < 0.9:
                    ecr.append((name, pid[3:], pos, team, str(round(float(rng.uniform(1, 60)), 2)), "1", "1", "9", str(sunday - dt.timedelta(days=2)), str(s)))
            injuries.append((players[3][0], float(s), "REG", float(w), players[3][3], players[3][1], players[3][2], "Knee", "Out" if w == 3 else "Questionable", "Limited Participation in Practice"))
    return dict(games=games, plays=plays, box=box, snaps=snaps, rosters=rosters, charts=charts, injuries=injuries, opportunity=opportunity, ecr=ecr, players=players)


@pytest.fixture(scope="module")
def bronze(spark):
    raw = league()
    ids = {x[0][3:]: 1000 + k for k, x in enumerate(raw["players"])}

    def landed(rows, columns, by_season=True, schema=None):
        df = spark.createDataFrame(pd.DataFrame(rows, columns=columns)) if schema is None else spark.createDataFrame(rows, schema)
        folder = F.concat(F.lit("/land/x/"), F.col("season").cast("int").cast("string") if by_season else F.lit("all"), F.lit("/f.parquet"))
        return df.withColumns({"_ingested_at": F.lit("2025-10-01").cast("timestamp"), "_source_file": folder})

    box = [k for k in c.CONTRACTS["player_stats"]]
    games = landed(raw["games"], list(c.CONTRACTS["schedules"]))
    return {
        "bronze_plays": landed(raw["plays"], None, schema=", ".join(f"{k} {v}" for k, v in c.CONTRACTS["plays"].items())),
        "bronze_player_stats": landed(raw["box"], box),
        "bronze_snap_counts": landed(raw["snaps"], list(c.CONTRACTS["snap_counts"])),
        "bronze_rosters": landed(raw["rosters"], ["gsis_id", "season", "week", "game_type", "team", "full_name", "position", "status", "years_exp", "rookie_year"]),
        "bronze_injuries": landed(raw["injuries"], ["gsis_id", "season", "game_type", "week", "team", "full_name", "position", "report_primary_injury", "report_status", "practice_status"]),
        "bronze_depth_charts": landed(raw["charts"], ["gsis_id", "season", "week", "game_type", "club_code", "formation", "depth_position", "full_name", "depth_team"]),
        "bronze_ff_opportunity": landed(raw["opportunity"], list(c.CONTRACTS["ff_opportunity"])),
        "bronze_schedules": games.withColumn("_source_file", F.lit("/land/schedules/f.parquet")),
        "bronze_players": landed([(x[0], x[1], x[2], x[2], "P" + x[0], "2000-02-01", "2020", "1", "2", x[3]) for x in raw["players"]] + [("NA", "Nobody", "QB", "QB", "", None, None, None, None, None)],
                                 ["gsis_id", "display_name", "position", "position_group", "pfr_id", "birth_date", "rookie_season", "draft_round", "draft_pick", "latest_team"], by_season=False),
        "bronze_player_ids": landed([(str(v) + ".0", "00-" + k) for k, v in ids.items()] + [("1000", "NA")], ["fantasypros_id", "gsis_id"], by_season=False),
        "bronze_ecr": landed([(n, str(ids[i]), *rest) for n, i, *rest in raw["ecr"]], ["player", "id", "pos", "team", "ecr", "sd", "best", "worst", "scrape_date", "season"]),
    }


@pytest.fixture(scope="module")
def gold(spark, bronze, tmp_path_factory):
    root, out = tmp_path_factory.mktemp("gold"), {}
    for name, df in graph.build(bronze).items():
        df.write.parquet(str(root / name))
        out[name] = spark.read.parquet(str(root / name))
    return out


def test_graph_is_whole_and_ordered():
    names = graph.order()
    assert set(names) == set(graph.GRAPH) and len(names) == 15
    for n in graph.GRAPH.values():
        for i in n.inputs:
            assert i.startswith("bronze_") or names.index(i) < names.index(n.name)
    loop = {"a": graph.Node("a", ("b",), None, ""), "b": graph.Node("b", ("a",), None, "")}
    with pytest.raises(ValueError, match="itself"):
        graph.order(loop)
    assert {graph.bronze_name(x) for x in graph.LANDED} == {i for n in graph.GRAPH.values() for i in n.inputs if i.startswith("bronze_")}


def test_silver(gold):
    assert gold["players"].where("player_name = 'Nobody'").count() == 0
    assert gold["player_ids"].groupBy("fantasypros_id").count().where("count > 1").count() == 0
    game = gold["schedules"].orderBy("game_id").first()
    assert game["kickoff_at"].hour in (13, 17) and dict(gold["schedules"].dtypes)["home_score"] == "int"
    assert gold["snap_counts"].where("player_id IS NULL").count() == 0
    found = graph.warnings(gold)
    assert found["player_stats"]["known_teams"] == 0 and found["player_week"]["shares_are_fractions"] == 0


def test_moved_teams_and_snapshot_charts(spark):
    rows = [("2025-09-01T10:00:00Z", "OAK", "WR", "1", "2", "00-1", "A"), ("2025-09-01T10:00:00Z", "OAK", "WR", "1", "5", "00-2", "B"), ("2025-09-01T10:00:00Z", "OAK", "WR", "2", "3", "00-2", "B"),
            ("2025-09-08T10:00:00Z", "OAK", "WR", "1", "1", "00-2", "B"), ("2025-09-01T10:00:00Z", "OAK", "LB", "1", "1", "00-3", "C")]
    raw = spark.createDataFrame(rows, "dt string, team string, pos_abb string, pos_slot string, pos_rank string, gsis_id string, player_name string")
    raw = raw.withColumns({"_ingested_at": F.lit("2025-10-01").cast("timestamp"), "_source_file": F.lit("/l/depth_charts/2025/x.parquet")})
    charts = d.depth_charts(raw)
    got = sorted((str(r["published_at"])[:10], r["team"], r["player_id"], r["depth_rank"]) for r in charts.collect())
    assert got == [("2025-09-01", "LV", "00-1", 1), ("2025-09-01", "LV", "00-2", 1), ("2025-09-08", "LV", "00-2", 1)]
    games = spark.createDataFrame([("g1", 2025, "REG", 1, "LV", "GB", dt.datetime(2025, 9, 8, 10), 1.0, 40.0, None, None)], "game_id string, season int, game_type string, week int, home_team string, away_team string, kickoff_at timestamp, spread_line double, total_line double, home_score int, away_score int")
    week = d.depth_chart_week(charts, games).collect()
    assert {(r["player_id"], r["week"]) for r in week} == {("00-1", 1), ("00-2", 1)} and {str(r["published_at"])[:10] for r in week} == {"2025-09-01"}
    with pytest.raises(ValueError, match="format"):
        d.depth_charts(raw.drop("dt"))


def test_rankings_belong_to_the_week_ahead(spark):
    games = spark.createDataFrame([(2025, w, "REG", dt.date(2025, 10, 5) + dt.timedelta(days=7 * (w - 5))) for w in (5, 6)], "season int, week int, game_type string, gameday date")
    days = ["2025-10-02", "2025-10-06", "2025-10-10", "2025-12-30"]  # a Thursday, a Monday, a Friday, and one after the season
    raw = spark.createDataFrame([("A", "7", "QB", "GB", str(k + 1), "1", "1", "1", x) for k, x in enumerate(days)], "player string, id string, pos string, team string, ecr string, sd string, best string, worst string, scrape_date string")
    raw = raw.withColumns({"_ingested_at": F.lit("2025-10-01").cast("timestamp"), "_source_file": F.lit("/l/ecr/2025/x.parquet")})
    out = d.ecr(raw, games, spark.createDataFrame([(7, "00-7")], "fantasypros_id long, player_id string"))
    assert sorted((r["week"], str(r["scrape_date"]), r["ecr_rank"], r["player_id"]) for r in out.collect()) == [(5, "2025-10-02", 1, "00-7"), (6, "2025-10-10", 1, "00-7")]


def test_gold_keys_and_mirrored_lines(gold):
    for name, keys in (("player_week", f.KEY), ("team_week", ["season", "week", "team"]), ("defense_vs_position", ["season", "week", "team", "position"])):
        assert gold[name].groupBy(*keys).count().where("count > 1").count() == 0 and gold[name].count() > 0
    both = gold["team_week"].groupBy("game_id").agg(F.sum("team_spread").alias("s"), F.sum("implied_points").alias("i"), F.first("total_line").alias("t")).collect()
    assert all(r["s"] == 0 and r["i"] == pytest.approx(r["t"]) for r in both)
    assert gold["team_week"].where("is_final AND offensive_plays <> 20").count() == 0
    half = gold["player_week"].where("abs(fantasy_points_half * 2 - fantasy_points_ppr - fantasy_points_std) > 1e-9").count()
    assert half == 0


def test_defense_rolls_over_games_before_only(gold):
    rows = gold["defense_vs_position"].where("team = 'GB' AND position = 'WR'").orderBy("season", "week").collect()
    for k, r in enumerate(rows):
        prior = [x["ppr_allowed"] for x in rows[max(0, k - 6) : k]]
        assert r["games_l6"] == len(prior) and (r["ppr_allowed_l6"] == pytest.approx(np.mean(prior)) if prior else r["ppr_allowed_l6"] is None)


def feature_rows(gold, **changed):
    t = gold | changed
    return f.features(f.candidates(t), t).select(*dict.fromkeys([*f.KEY, "position", *f.FEATURES]))


def test_no_feature_sees_its_own_week_or_later(gold):
    """Scrambling all results from a week on leaves that week's features as they were, and changes later ones."""
    before = feature_rows(gold).cache()
    late = F.expr("season = 2025 AND week >= 3")
    scrambled = gold["player_week"].withColumns({x: F.when(late, F.lit(99.0)).otherwise(F.col(x)) for x in ("fantasy_points_ppr", "target_share", "expected_ppr")})
    after = feature_rows(gold, player_week=scrambled)
    same = "season < 2025 OR (season = 2025 AND week <= 3)"
    assert before.where(same).exceptAll(after.where(same)).count() == 0
    assert before.where("season = 2025 AND week = 4").exceptAll(after).count() > 0


def test_candidates(gold):
    pool = f.candidates(gold)
    assert pool.groupBy(*f.KEY).count().where("count > 1").count() == 0
    assert pool.where("report_status = 'Out'").count() == 0
    out = league()["injuries"][0][0]
    assert pool.where((F.col("player_id") == out) & (F.col("week") == 3)).count() == 0 and pool.where(F.col("player_id") == out).count() > 0
    p.check_pool(pool.where("season = 2025 AND week = 5"), gold["team_week"].where("season = 2025 AND week = 5"))
    with pytest.raises(p.ThinPool):
        p.check_pool(pool.where("season = 2025 AND week = 5 AND team <> 'GB'"), gold["team_week"].where("season = 2025 AND week = 5"))
    cover = p.coverage(pool, gold["player_week"]).first()
    assert 0.8 < cover["share_all"] <= 1


def test_states_equal_pandas(gold):
    rows = gold["player_week"].toPandas().sort_values(["player_id", "season", "week"])
    g = rows.groupby("player_id")["fantasy_points_ppr"]
    want = rows.assign(l3=g.rolling(3, min_periods=1).mean().reset_index(level=0, drop=True), e=g.ewm(halflife=3.0).mean().reset_index(level=0, drop=True))
    got = f.player_states(gold["player_week"]).toPandas().rename(columns={"state_season": "season", "state_week": "week"})
    both = want.merge(got, on=["player_id", "season", "week"])
    np.testing.assert_allclose(both.l3, both.ppr_last3)
    np.testing.assert_allclose(both.e, both.ewm_fantasy_points_ppr)


def test_risers(gold, spark):
    weeks = spark.createDataFrame([(2025, 5), (2024, 4)], "season int, week int")
    got = p.risers(gold["player_week"], weeks).toPandas()
    rows = gold["player_week"].toPandas()
    assert len(got) and (got.games_recent == 3).all()
    for r in got.head(12).itertuples():
        mine = rows[(rows.player_id == r.player_id) & (rows.season == r.season) & (rows.week < r.week)].sort_values("week").expected_ppr
        last = rows[(rows.player_id == r.player_id) & (rows.season == r.season - 1)].expected_ppr
        before = mine.iloc[:-3].mean() if len(mine) - 3 >= 2 else last.mean()
        assert r.expected_ppr_recent == pytest.approx(mine.iloc[-3:].mean()) and r.expected_ppr_before == pytest.approx(before)
    for _, g in got.groupby(["season", "week"]):
        assert sorted(g.riser_rank) == list(range(1, len(g) + 1))
    assert p.risers(gold["player_week"], weeks.limit(0)).count() == 0


@pytest.fixture(scope="module")
def frame(spark, gold, tmp_path_factory):
    """Features as a table, as jobs hand them on."""
    path = str(tmp_path_factory.mktemp("features") / "frame")
    f.with_actuals(f.features(f.candidates(gold), gold), gold["player_week"]).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def projected(spark, frame, tmp_path_factory):
    rows = frame
    names = ["week", "implied_points", "ppr_last3", "ewm_fantasy_points_ppr"]
    fit = model.Projector.fit(rows.where("season < 2025 AND is_final"), names, positions=["QB"], rounds=2, depth=2)
    out = f.with_baselines(fit.predict(rows.where("season = 2025 AND position = 'QB'")))
    path = str(tmp_path_factory.mktemp("projected") / "table")
    out.withColumns({"kind": F.lit("backtest"), "model_version": F.lit("v"), "generated_at": F.lit("2025-10-01").cast("timestamp"), "ecr_rank": F.lit(None).cast("long"), "is_home": F.col("is_home").cast("boolean")}).write.parquet(path)
    return spark.read.parquet(path)


def test_bands_enclose_projections(projected):
    for x in model.FORMATS:
        assert projected.where(f"NOT (floor_{x} <= proj_{x} AND proj_{x} <= ceiling_{x})").count() == 0
    assert projected.where("proj_ppr IS NULL").count() == 0 and projected.where("proj_passing_yards > 0").count() > 0


def test_freeze_assemble_and_marts(spark, gold, projected):
    now = F.lit("2025-09-20").cast("timestamp")
    live = p.frozen(None, projected, now)
    assert live.where(F.col("kickoff_at") <= now).count() == 0
    changed = projected.withColumn("proj_ppr", F.col("proj_ppr") + 1)
    later = p.frozen(projected, changed, now)
    assert later.count() == projected.count()
    moved = later.join(projected.select(*f.KEY, F.col("proj_ppr").alias("old")), f.KEY).withColumn("moved", F.col("proj_ppr") != F.col("old"))
    assert {(r["a"], r["moved"]) for r in moved.select((F.col("kickoff_at") > now).alias("a"), "moved").distinct().collect()} == {(True, True), (False, False)}
    out = p.assembled(projected, None, gold["ecr"]).cache()
    out.count()
    assert out.groupBy(*f.KEY).count().where("count > 1").count() == 0 and out.where("ecr_rank IS NOT NULL").count() > 0
    for x in model.FORMATS:
        assert out.where(f"tier_{x} IS NULL").count() == 0
    assert set(p.published(projected, "live", "v", now).columns) < set(out.columns)
    done = projected.where("is_final")
    metrics = p.evaluate(done, gold["ecr"], [2025]).cache()
    t = gold | {"projections": out, "risers": p.risers(gold["player_week"], gold["team_week"].select("season", "week")), "backtest_metrics": metrics}
    assert marts.checks(t) == {"floor_projection_ceiling": 0, "counts_match": 0, "unique_keys": 0, "one_upcoming_week": 0, "reconciles": 0}
    sheet = marts.cheat_sheet(t)
    assert {r["week"] for r in sheet.where("is_upcoming").select("week").distinct().collect()} == {5} and sheet.where("is_upcoming AND actual_ppr IS NOT NULL").count() == 0
    assert marts.risers(t).count() > 0 and marts.game_log(t).where("season = 2023").count() == 0 and marts.backtest_summary(t).where("method_label IS NULL").count() == 0
    card = marts.scorecard(t).toPandas()
    per = metrics.toPandas().set_index(["position", "method"])
    for (pos, m), g in card[card.method != "ecr"].groupby(["position", "method"]):
        assert g.abs_error_sum.sum() / g.n.sum() == pytest.approx(per.loc[(pos, m), "mae"])
    old = marts.results(t)
    touched = gold["player_week"].where("season = 2025 AND week = 2").withColumn("fantasy_points_ppr", F.lit(0.0))
    new = t | {"player_week": gold["player_week"].where("NOT (season = 2025 AND week = 2)").unionByName(touched)}
    assert sorted(map(str, marts.refresh_results(old, new, [touched]).collect())) == sorted(map(str, marts.results(new).collect()))
    assert marts.weekly_accuracy(old).count() > 0 and marts.latest_week(out).groupBy("player_id").count().where("count > 1").count() == 0
    own = p.rescored(out, {"preset": "half", "te_rec_premium": 0.5})
    assert own.where("NOT (floor_own <= proj_own AND proj_own <= ceiling_own)").count() == 0
    assert p.intervals(done, gold["ecr"], [2025], 200).where("low > gap OR gap > high").count() == 0
    week = p.upcoming_week(gold["team_week"]).first()
    assert (week["season"], week["week"]) == LAST


def test_walk_forward_reuses_what_did_not_change(frame, monkeypatch):
    rows = frame.where("position = 'QB'").cache()
    fits = []

    class Fake:
        @classmethod
        def fit(cls, past, **_):
            fits.append(1)
            return cls()

        def predict(self, now):
            return now.withColumns({x: F.lit(1.0) for x in model.OUTPUTS})

    monkeypatch.setattr(model, "Projector", Fake)
    first = model.walk_forward(rows, [2024, 2025], {2025: 4}).cache()
    assert len(fits) == 2 and first.where("season = 2025 AND week >= 4").count() == 0
    model.walk_forward(rows, [2024, 2025], {2025: 4}, stored=first)
    assert len(fits) == 2
    model.walk_forward(rows.withColumn("fantasy_points_ppr", F.when(F.col("season") == 2024, 0.0).otherwise(F.col("fantasy_points_ppr"))), [2024, 2025], {2025: 4}, stored=first)
    assert len(fits) == 4


def test_drop_rules_treat_null_as_failure(spark):
    df = spark.createDataFrame([(1, "REG"), (2, None)], "game_id int, season_type string")
    assert quality.keep_valid(df, {"a": "season_type IN ('REG')"}).count() == 1

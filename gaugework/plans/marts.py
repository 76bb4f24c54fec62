"""Staging views with keys, and marts: cheat sheet, risers, scorecard, game log, backtest summary, results."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.operators import change, stats
from gaugework.operators import windows as win
from gaugework.plans.features import KEY
from gaugework.plans.projections import pool_size

STAGED = {
    "player_week": ("player_week_key", KEY),
    "team_week": ("team_week_key", ["season", "week", "team"]),
    "defense_vs_position": ("defense_week_key", ["season", "week", "team", "position"]),
    "projections": ("projection_key", KEY),
    "risers": ("riser_key", KEY),
    "backtest_metrics": ("metric_key", ["scope", "position", "method"]),
}
LABELS = {"model": "Model", "last3": "Last 3 games average", "season_avg": "Season-to-date average", "ecr": "FantasyPros ECR"}
FORMATS = ("ppr", "half", "std")
#: Columns of the game log.
GAME_LOG = (
    "player_week_key", "season", "week", "player_id", "player_name", "position", "team", "opponent", "fantasy_points_ppr", "fantasy_points_half", "fantasy_points_std",
    "passing_yards", "passing_tds", "passing_interceptions", "rushing_yards", "rushing_tds", "receptions", "receiving_yards", "receiving_tds", "fumbles_lost",
    "two_point_conversions", "special_teams_tds", "targets", "carries", "snap_share", "target_share", "carry_share", "expected_ppr", "proj_ppr", "floor_ppr", "ceiling_ppr",
    "projection_kind",
)
SLACK, AGREE = 0.000001, 0.0001


def staging(name: str, df: DataFrame) -> DataFrame:
    """A serving table with its key as one column; a defense's sides are named as such."""
    key, columns = STAGED[name]
    out = df.select(F.concat_ws("-", *[F.col(x).cast("string") for x in columns]).alias(key), "*")
    return out.withColumnsRenamed({"team": "defense", "opponent": "offense"}) if name == "defense_vs_position" else out


def _finals(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["team_week"].select("game_id", "team", "is_final")


def _points(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["player_week"].select(*KEY, *[f"fantasy_points_{f}" for f in FORMATS])


def cheat_sheet(t: Mapping[str, DataFrame]) -> DataFrame:
    """The current season's projections with the next week marked, and what happened in finished games."""
    rows = staging("projections", t["projections"])
    season = F.broadcast(rows.agg(F.max("season").alias("season")))  # one row
    ahead = t["team_week"].where("NOT is_final").join(season, "season", "left_semi").groupBy("season").agg(F.min("week").alias("next_week"))
    rows = rows.join(season, "season", "left_semi").join(F.broadcast(ahead), "season", "left").join(_finals(t), ["game_id", "team"], "left").join(_points(t), KEY, "left")
    played = {f"actual_{f}": F.when(F.col("is_final"), F.coalesce(f"fantasy_points_{f}", F.lit(0.0))) for f in FORMATS}
    stats_ = [x for x in rows.columns if x.startswith("proj_") and x not in {f"proj_{f}" for f in FORMATS}]
    return rows.withColumns(played).select(
        "projection_key", "season", "week", F.coalesce(F.col("week") == F.col("next_week"), F.lit(False)).alias("is_upcoming"), F.col("is_final").alias("game_final"), "kind", "player_id", "player_name",
        "position", "team", "opponent", "is_home", F.concat(F.when(F.col("is_home"), "vs ").otherwise("@ "), F.col("opponent")).alias("matchup"), "kickoff_at", "implied_points", "team_spread", "depth_rank",
        F.coalesce("report_status", F.lit("None")).alias("injury_status"), F.col("report_primary_injury").alias("injury"), "opp_matchup_rank", "ecr_rank",
        *[f"{x}_{f}" for f in FORMATS for x in ("proj", "floor", "ceiling", "pos_rank", "tier", "start_sit")], *stats_, "baseline_last3", "baseline_season_avg", *played, "model_version", "generated_at",
    )


def risers(t: Mapping[str, DataFrame]) -> DataFrame:
    """The current season's risers beside their projection of the week."""
    season = F.broadcast(t["projections"].agg(F.max("season").alias("season")))
    sheet = cheat_sheet(t).select(*KEY, "proj_ppr", "pos_rank_ppr", "matchup")
    rows = staging("risers", t["risers"]).join(season, "season", "left_semi").join(sheet, KEY, "left")
    usage = [f"{m}_{p}" for m in ("expected_ppr", "snap_share", "target_share", "carry_share", "red_zone_share") for p in ("recent", "before", "change")]
    return rows.select("riser_key", *KEY, "player_name", "position", "team", "is_riser", "riser_rank", "baseline_basis", "games_recent", "games_earlier", *usage, "proj_ppr", "pos_rank_ppr", "matchup")


def game_log(t: Mapping[str, DataFrame]) -> DataFrame:
    """Results of this season and the last with the projection that was out for the game."""
    season = F.broadcast(t["projections"].agg(F.max("season").alias("__now")))
    out = t["projections"].select(*KEY, "proj_ppr", "floor_ppr", "ceiling_ppr", F.col("kind").alias("projection_kind"))
    rows = staging("player_week", t["player_week"]).crossJoin(season).where(F.col("season") >= F.col("__now") - 1).drop("__now")
    return rows.join(out, KEY, "left").select(*GAME_LOG)


def scorecard(t: Mapping[str, DataFrame]) -> DataFrame:
    """Additive error sums and rank correlation of each week, position and method over the experts' pool."""
    final = _finals(t).where("is_final").drop("is_final")
    rows = t["projections"].join(final, ["game_id", "team"], "left_semi").join(_points(t).select(*KEY, "fantasy_points_ppr"), KEY, "left")
    rows = rows.where(F.col("ecr_rank") <= pool_size(F.col("position"))).dropna(subset=["baseline_last3", "baseline_season_avg"]).withColumn("actual", F.coalesce("fantasy_points_ppr", F.lit(0.0)))
    inside = F.when(F.col("actual").between(F.col("floor_ppr"), F.col("ceiling_ppr")), 1).otherwise(0)
    entry = lambda m, v, i=None: F.struct(F.lit(m).alias("method"), v.cast("double").alias("prediction"), (F.lit(None) if i is None else i).cast("int").alias("inside"))
    entries = [entry("model", F.col("proj_ppr"), inside), entry("last3", F.col("baseline_last3")), entry("season_avg", F.col("baseline_season_avg")), entry("ecr", -F.col("ecr_rank"))]
    group = ["season", "week", "position", "method"]
    long = rows.select("season", "week", "position", "kind", "actual", F.explode(F.array(*entries)).alias("m")).select("season", "week", "position", "kind", "actual", "m.*")
    e = F.when(F.col("method") != "ecr", F.col("prediction") - F.col("actual"))
    sums = long.groupBy(*group).agg(
        F.max("kind").alias("kind"), F.count("*").alias("n"), F.sum(F.abs(e)).alias("abs_error_sum"), F.sum(e * e).alias("squared_error_sum"), F.sum(e).alias("error_sum"), F.avg(F.abs(e)).alias("mae"), F.sum("inside").alias("inside_count")
    )
    ranks = stats.spearman(long, group, "prediction", "actual").drop("n")
    return sums.join(ranks, group, "left").select(F.concat_ws("-", *[F.col(g).cast("string") for g in group]).alias("scorecard_key"), "*")


def backtest_summary(t: Mapping[str, DataFrame]) -> DataFrame:
    label = F.create_map(*[F.lit(x) for p in LABELS.items() for x in p])[F.col("method")]
    return staging("backtest_metrics", t["backtest_metrics"]).withColumn("method_label", label)


def results(t: Mapping[str, DataFrame], weeks: DataFrame | None = None) -> DataFrame:
    """Every projection of a finished game against what happened, for all weeks or only some."""
    rows = t["projections"]
    if weeks is not None:
        rows = rows.join(weeks, ["season", "week"], "left_semi")
    final = _finals(t).where("is_final").drop("is_final")
    rows = rows.join(final, ["game_id", "team"], "left_semi").join(t["player_week"].select(*KEY, "fantasy_points_ppr", F.lit(True).alias("__p")), KEY, "left")
    actual = F.coalesce("fantasy_points_ppr", F.lit(0.0))
    return rows.select(
        *KEY, "player_name", "position", "team", "kind", "proj_ppr", "floor_ppr", "ceiling_ppr", "baseline_last3", "baseline_season_avg", "ecr_rank", actual.alias("actual_ppr"),
        F.col("__p").isNotNull().alias("played"), (F.col("proj_ppr") - actual).alias("error"), actual.between(F.col("floor_ppr"), F.col("ceiling_ppr")).alias("inside_range"),
    )


def refresh_results(old: DataFrame, t: Mapping[str, DataFrame], changes: list[DataFrame]) -> DataFrame:
    """Results with only the weeks rebuilt that a change touched; the same as all of them rebuilt."""
    touched = changes[0].select("season", "week")
    for more in changes[1:]:
        touched = touched.union(more.select("season", "week"))
    return change.rebuilt(old, lambda weeks: results(t, weeks), touched.distinct(), ["season", "week"])


def weekly_accuracy(rows: DataFrame) -> DataFrame:
    """Errors of the model and the baselines by week and position, over the experts' pool."""
    pool = rows.where((F.col("ecr_rank") <= pool_size(F.col("position")))).dropna(subset=["baseline_last3", "baseline_season_avg"])
    gap = lambda x: F.avg(F.abs(F.col(x) - F.col("actual_ppr")))
    return pool.groupBy("season", "week", "position").agg(
        F.any_value("kind").alias("kind"), F.count("*").alias("players"), F.avg(F.abs("error")).alias("mae"), F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"), F.avg("error").alias("bias"),
        F.avg(F.col("inside_range").cast("int")).alias("interval_coverage"), gap("baseline_last3").alias("mae_last3"), gap("baseline_season_avg").alias("mae_season_avg"),
    )


def latest_week(rows: DataFrame) -> DataFrame:
    """Each player's newest row."""
    return win.first_by(rows, ["player_id"], F.desc("season"), F.desc("week"))


def broken(t: Mapping[str, DataFrame]) -> DataFrame:
    """Rows that break an invariant of the marts, as (check, row): there should be none.

    In every format floor <= projection <= ceiling; all four methods are scored
    on as many players in a week and position; keys are unique; at most one week
    is upcoming; and, where backtest metrics are given, the scorecard's sums give
    the same count, error and coverage.
    """
    sheet, card = cheat_sheet(t), scorecard(t)
    over = lambda a, b: F.col(a) > F.col(b) + SLACK
    disorder = F.lit(False)
    for f in FORMATS:
        disorder = disorder | over(f"floor_{f}", f"proj_{f}") | over(f"proj_{f}", f"ceiling_{f}")
    week = F.concat_ws("-", F.col("season").cast("string"), F.col("week").cast("string"))
    sizes = card.groupBy("season", "week", "position").agg(F.count_distinct("n").alias("k"), F.count("*").alias("methods")).where("k > 1 OR methods <> 4")
    repeated = sheet.groupBy("projection_key").agg(F.count("*").alias("k")).where("k > 1")
    ahead = sheet.where("is_upcoming").agg(F.count_distinct("week").alias("k")).where("k > 1")
    row = lambda check, df, key: df.select(F.lit(check).alias("check"), key.cast("string").alias("row"))
    parts = [
        row("floor_projection_ceiling", staging("projections", t["projections"]).where(disorder), F.col("projection_key")),
        row("counts_match", sizes, F.concat_ws("-", week, "position")),
        row("unique_keys", repeated, F.col("projection_key")),
        row("one_upcoming_week", ahead, F.col("k")),
    ]
    if "backtest_metrics" in t:
        group = ["scope", "position", "method"]
        sums = card.where("method <> 'ecr' AND kind = 'backtest'").groupBy(F.col("season").cast("string").alias("scope"), "position", "method").agg(
            F.sum("n").alias("sn"), (F.sum("abs_error_sum") / F.sum("n")).alias("smae"), (F.sum("inside_count") / F.sum("n")).alias("scov")
        )
        far = lambda a, b: F.abs(F.col(a) - F.col(b)) > AGREE
        off = backtest_summary(t).join(sums, group).where((F.col("n") != F.col("sn")) | far("mae", "smae") | (F.col("method") == "model") & far("interval_coverage", "scov"))
        parts.append(row("reconciles", off, F.col("metric_key")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def checks(t: Mapping[str, DataFrame]) -> dict[str, int]:
    """Number of rows that break each invariant; all should be zero."""
    found = {r["check"]: r["n"] for r in broken(t).groupBy("check").agg(F.count("*").alias("n")).collect()}  # a row a check
    names = ["floor_projection_ceiling", "counts_match", "unique_keys", "one_upcoming_week", *(["reconciles"] if "backtest_metrics" in t else [])]
    return {name: found.get(name, 0) for name in names}

"""Candidates and model features from what was known before kickoff, as lazy DataFrames.

History is attached with strict as-of joins on the time key season * 100 + week,
so no row can see its own week or a later one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugework.functions import scoring
from gaugework.operators import joins
from gaugework.operators import windows as win
from gaugework.operators.asof import asof_join
from gaugework.plans import contracts as c

KEY = ["season", "week", "player_id"]
#: Smoothed statistics and half-lives, and the projected parts of a stat line.
EWM_STATS = (
    "fantasy_points_ppr expected_ppr offense_snaps snap_share target_share carry_share air_yards_share red_zone_share targets carries receptions "
    "red_zone_targets red_zone_carries goal_line_carries attempts passing_yards passing_tds passing_interceptions rushing_yards rushing_tds "
    "receiving_yards receiving_tds fumbles_lost"
).split()
TEAM_STATS = "points_for offensive_plays pass_rate red_zone_plays".split()
PLAYER_HALFLIFE, TEAM_HALFLIFE, DEFENSE_GAMES = 3.0, 4.0, 6
COMPONENTS = [s for s in scoring.PRICED if s != "special_teams_tds"]
FEATURES = (
    "week depth_rank on_depth_chart injury_level practice_level is_home implied_points team_spread total_line games_played season_games "
    "games_missed_season missed_last_game season_ppr_mean prev_season_ppr_mean ppr_last1 ppr_last3"
).split() + [f"ewm_{s}" for s in EWM_STATS] + [f"team_ewm_{s}" for s in TEAM_STATS] + "opp_ppr_allowed_l6 opp_matchup_index rookie years_exp age".split()


def time_key() -> Column:
    return (F.col("season") * 100 + F.col("week")).cast("long")


def _before(left: DataFrame, right: DataFrame, by: list[str], inclusive: bool = False, tie: list[str] | None = None) -> DataFrame:
    return asof_join(left.withColumn("t", time_key()), right, by, "t", inclusive=inclusive, tie=tie).drop("t")


def game_order(teams: DataFrame) -> DataFrame:
    """Place of each game in its team's season, from 0."""
    place = Window.partitionBy("team", "season").orderBy("week")
    return teams.select("season", "week", "team", "game_id", (F.row_number().over(place) - 1).alias("game_index"))


def reports(injuries: DataFrame) -> DataFrame:
    """The most severe report of each player and regular week."""
    level = lambda name, codes: F.coalesce(F.create_map(*[F.lit(x) for p in codes.items() for x in p])[F.col(name)], F.lit(0))
    rows = injuries.where(F.col("game_type") == c.REGULAR).withColumns({"injury_level": level("report_status", c.INJURY), "practice_level": level("practice_status", c.PRACTICE)})
    first = win.first_by(rows, KEY, F.desc("injury_level"), F.desc("practice_level"), "report_status", "report_primary_injury")
    return first.select(*KEY, "report_status", "report_primary_injury", "injury_level", "practice_level")


def _recent(facts: DataFrame, order: DataFrame) -> DataFrame:
    """Who played in a team's two games before, at the position of the later one."""
    played = facts.select("season", "week", "team", "player_id", "position").join(order.drop("game_id"), ["season", "week", "team"])
    ahead = played.select("season", "team", "player_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("lag"), "position", "game_index").withColumn("game_index", F.col("game_index") + F.col("lag"))
    last = ahead.groupBy("season", "team", "game_index", "player_id").agg(F.min_by("position", "lag").alias("recent_position"))
    return last.join(order, ["season", "team", "game_index"]).select("season", "week", "team", "player_id", "recent_position")


def _listed(rosters: DataFrame) -> DataFrame:
    position = F.create_map(*[F.lit(x) for p in c.ROSTER.items() for x in p])[F.col("position")]
    rows = rosters.where(F.col("game_type") == c.REGULAR).withColumn("roster_position", position).where("roster_position IS NOT NULL")
    return rows.groupBy(*KEY).agg(F.min("roster_position").alias("roster_position"))


def candidates(t: dict[str, DataFrame], weeks: DataFrame | None = None) -> DataFrame:
    """Players to project for each game: on the chart or in the team's last two games, and not ruled out."""
    games = t["team_week"].select("season", "week", "game_id", "team", "opponent", "is_home", "kickoff_at", "implied_points", "team_spread", "total_line", "is_final")
    if weeks is not None:
        games = games.join(weeks.select("season", "week").distinct(), ["season", "week"], "left_semi")
    at = ["season", "week", "team", "player_id"]
    chart = t["depth_chart_week"].select(*at, F.col("player_name").alias("chart_name"), "depth_rank", F.col("position").alias("chart_position"))
    recent = _recent(t["player_week"], game_order(t["team_week"]))
    pool = chart.join(recent, at, "full").join(games, ["season", "week", "team"]).withColumn("on_depth_chart", F.col("depth_rank").isNotNull().cast("long"))
    known = t["players"].select("player_id", "player_name", "birth_date", "rookie_season")
    pool = pool.join(_listed(t["rosters"]), KEY, "left").join(known, "player_id", "left").join(reports(t["injuries"]), KEY, "left")
    pool = pool.withColumns(
        {
            "position": F.coalesce("roster_position", "chart_position", "recent_position"),
            "player_name": F.coalesce("player_name", "chart_name"),
            "injury_level": F.coalesce("injury_level", F.lit(0)).cast("long"),
            "practice_level": F.coalesce("practice_level", F.lit(0)).cast("long"),
        }
    ).where(F.col("position").isin(*c.POSITIONS) & (F.col("injury_level") < c.INJURY["Out"]))
    # Traded within the week: the better chart rank counts, then the team's name.
    one = win.first_by(pool, KEY, F.asc_nulls_last("depth_rank"), "team", "chart_position")
    return one.select(
        *KEY, "game_id", "player_name", "position", "team", "opponent", "is_home", "kickoff_at", "is_final", "implied_points", "team_spread", "total_line", "depth_rank",
        "on_depth_chart", "report_status", "report_primary_injury", "injury_level", "practice_level", "birth_date", "rookie_season",
    )


def player_states(facts: DataFrame) -> DataFrame:
    """Each player's form after each game."""
    order = ["season", "week"]
    rows = win.ewm_mean(facts, ["player_id"], order, list(EWM_STATS), PLAYER_HALFLIFE)
    by = Window.partitionBy("player_id").orderBy(*order)
    return rows.select(
        "player_id", time_key().alias("t"), F.col("season").alias("state_season"), F.col("week").alias("state_week"), F.col("team").alias("state_team"),
        F.row_number().over(by).alias("games_played"), F.col("fantasy_points_ppr").alias("ppr_last1"), win.rolling_mean(["player_id"], order, "fantasy_points_ppr", 3).alias("ppr_last3"),
        F.row_number().over(Window.partitionBy("player_id", "season").orderBy("week")).alias("season_games"),
        win.expanding_mean(["player_id", "season"], ["week"], "fantasy_points_ppr").alias("season_ppr_mean"), *[F.col(f"{s}_ewm").alias(f"ewm_{s}") for s in EWM_STATS],
    )


def season_means(facts: DataFrame) -> DataFrame:
    """Mean points of each season, keyed to the next one."""
    return facts.groupBy("player_id", (F.col("season") + 1).alias("season")).agg(F.avg("fantasy_points_ppr").alias("prev_season_ppr_mean"))


def team_states(teams: DataFrame) -> DataFrame:
    played = teams.where("is_final").withColumn("pass_rate", joins.safe_share(F.col("dropbacks"), F.col("offensive_plays")))
    rows = win.ewm_mean(played, ["team"], ["season", "week"], list(TEAM_STATS), TEAM_HALFLIFE)
    return rows.select("team", time_key().alias("t"), *[F.col(f"{s}_ewm").alias(f"team_ewm_{s}") for s in TEAM_STATS])


def matchups(defenses: DataFrame, weeks: DataFrame) -> DataFrame:
    """Points allowed over the last six games before each week, for every known defense, against the league, ranked with ties."""
    by = ["opponent", "position"]
    states = defenses.select(F.col("team").alias("opponent"), "position", time_key().alias("t"), win.rolling_mean(["team", "position"], ["season", "week"], "ppr_allowed", DEFENSE_GAMES).alias("opp_ppr_allowed_l6"))
    known = states.select(*by).distinct()
    # Weeks by defenses: a calendar times 32 teams by 4 positions.
    grid = weeks.select("season", "week").distinct().crossJoin(F.broadcast(known))
    rows = _before(grid, states, by).drop("right_time")
    league = Window.partitionBy("season", "week", "position")
    rank = F.rank().over(league.orderBy(F.desc_nulls_last("opp_ppr_allowed_l6")))
    return rows.withColumns(
        {
            "opp_matchup_index": F.try_divide(F.col("opp_ppr_allowed_l6"), F.avg("opp_ppr_allowed_l6").over(league)),
            "opp_matchup_rank": F.when(F.col("opp_ppr_allowed_l6").isNotNull(), rank),
        }
    )


def experience(rosters: DataFrame, rows: DataFrame) -> DataFrame:
    """Years of experience as listed in the same season, at or before the week."""
    listed = rosters.where("years_exp IS NOT NULL").select("player_id", time_key().alias("t"), F.col("season").alias("listed_season"), "years_exp")
    found = _before(rows.select(*KEY).distinct(), listed, ["player_id"], inclusive=True, tie=["years_exp"])
    return found.select(*KEY, F.when(F.col("listed_season") == F.col("season"), F.col("years_exp")).alias("years_exp"))


def features(pool: DataFrame, t: dict[str, DataFrame]) -> DataFrame:
    """Candidates with the columns of FEATURES and `opp_matchup_rank`."""
    rows = _before(pool, player_states(t["player_week"]), ["player_id"]).drop("right_time")
    same = F.coalesce(F.col("state_season") == F.col("season"), F.lit(False))
    rows = rows.withColumns(
        {
            "season_games": F.when(same, F.col("season_games")).otherwise(0),
            "season_ppr_mean": F.when(same, F.col("season_ppr_mean")),
            "games_played": F.coalesce("games_played", F.lit(0)),
        }
    )
    rows = rows.join(season_means(t["player_week"]), ["player_id", "season"], "left")
    order = game_order(t["team_week"]).drop("game_id")
    steps = joins.stepped(order, ["season", "team"], "game_index", 1, ["week"]).withColumnRenamed("week_prev", "previous_week")
    rows = rows.join(steps, ["season", "week", "team"], "left")
    played = same & F.coalesce(F.col("state_week") == F.col("previous_week"), F.lit(False))
    rows = rows.withColumns(
        {
            "games_missed_season": F.greatest(F.col("game_index") - F.col("season_games"), F.lit(0)),
            "missed_last_game": F.when(F.col("previous_week").isNotNull(), (~played).cast("double")),
        }
    )
    rows = _before(rows, team_states(t["team_week"]), ["team"]).drop("right_time")
    rows = rows.join(matchups(t["defense_vs_position"], pool), ["season", "week", "opponent", "position"], "left")
    rows = rows.join(experience(t["rosters"], pool), KEY, "left")
    start = F.make_date(F.col("season"), F.lit(9), F.lit(1))
    years = F.coalesce(F.col("years_exp"), F.col("season") - F.col("rookie_season")).cast("double")
    return rows.withColumns(
        {
            "years_exp": years,
            "rookie": F.coalesce(years == 0, F.lit(False)).cast("long"),
            "age": F.datediff(start, F.col("birth_date")) / F.lit(365.25),
            "is_home": F.col("is_home").cast("double"),
        }
    )


def with_baselines(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"baseline_last3": F.col("ppr_last3"), "baseline_season_avg": F.coalesce("season_ppr_mean", "prev_season_ppr_mean")})


def with_actuals(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """What a candidate did; one without a stat line scored zero."""
    stats = [*COMPONENTS, "fantasy_points_ppr"]
    return rows.join(facts.select(*KEY, *stats), KEY, "left").fillna(0, stats)

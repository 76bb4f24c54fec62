"""A made-up league over the driver's tables, as SQL that Spark and DuckDB both read.

Line items become plays of 24 teams of six players each over 17 weeks a year;
points are multiples of an eighth, so that sums are exact in any order. The
domain functions run on these frames, and their SQL begins with the same text.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugework.plans import contracts as c
from gaugework.plans.features import COMPONENTS
from gaugework.session import kept, table
from gaugework.sources.landing import SEEN_AT, SEEN_IN

_position = "CASE slot WHEN 0 THEN 'QB' WHEN 1 THEN 'RB' WHEN 2 THEN 'RB' WHEN 3 THEN 'WR' WHEN 4 THEN 'WR' ELSE 'TE' END"
_id = "concat('P', 100 + team * 6 + slot)"
_zero = lambda *names: ", ".join(f"0 AS {n}" for n in names)

#: Frames in the order in which one needs another.
FRAMES = {
    "seasons": "SELECT DISTINCT CAST(year(l_shipdate) AS INT) AS season FROM lineitem",
    "ends": "SELECT max(season) AS last FROM seasons",
    "fixtures": """SELECT season, CAST(week AS INT) AS week, CAST(k AS INT) AS k, CAST((2 * k + week) % 24 AS INT) AS h, CAST((2 * k + 1 + week) % 24 AS INT) AS a,
  (season < last OR week < 10) AS played FROM seasons CROSS JOIN range(1, 18) AS w(week) CROSS JOIN range(0, 12) AS g(k) CROSS JOIN ends""",
    "schedules": """SELECT concat(season, '_', week, '_', k) AS game_id, season, 'REG' AS game_type, week, make_date(season, 9, 3) + 7 * (week - 1) AS gameday,
  concat('T', 10 + a) AS away_team, concat('T', 10 + h) AS home_team, CASE WHEN played THEN CAST((a * 7 + week * 3 + season) % 41 AS INT) END AS away_score,
  CASE WHEN played THEN CAST((h * 7 + week * 3 + season) % 41 AS INT) END AS home_score, CAST((h * 5 + a * 3 + week) % 29 AS DOUBLE) / 2 - 7 AS spread_line,
  40 + CAST((h + a + week) % 16 AS DOUBLE) / 2 AS total_line, CAST(make_date(season, 9, 3) + 7 * (week - 1) AS TIMESTAMP) + INTERVAL '17' HOUR AS kickoff_at FROM fixtures""",
    "lines": """SELECT l_orderkey, l_linenumber, l_partkey, CAST(year(l_shipdate) AS INT) AS season, CAST(1 + l_partkey % 17 AS INT) AS week, CAST(l_suppkey % 24 AS INT) AS team,
  CAST(l_orderkey % 6 AS INT) AS slot, CAST(l_linenumber % 3 AS INT) AS kind, CAST(floor(l_quantity) AS INT) AS q, CAST((l_suppkey % 24 - (1 + l_partkey % 17) + 240) % 24 AS INT) AS side FROM lineitem""",
    "plays": f"""SELECT concat(season, '_', week, '_', CAST(floor(side / 2) AS INT)) AS game_id, l_orderkey * 10 + l_linenumber AS play_id, season, 'REG' AS season_type, week, team, slot, q, kind,
  concat('T', 10 + team) AS posteam, concat('T', 10 + CASE WHEN side % 2 = 0 THEN (team + 1) % 24 ELSE (team + 23) % 24 END) AS defteam,
  CASE kind WHEN 0 THEN 'pass' WHEN 1 THEN 'run' ELSE 'punt' END AS play_type, CAST(1 + l_partkey % 99 AS INT) AS yardline_100, CASE WHEN kind = 1 THEN 1 ELSE 0 END AS rush_attempt,
  CASE WHEN kind = 0 THEN 1 ELSE 0 END AS pass_attempt, CASE WHEN kind = 0 AND l_orderkey % 11 = 0 THEN 1 ELSE 0 END AS sack, CASE WHEN l_orderkey % 17 = 0 THEN 1 END AS two_point_attempt,
  CASE WHEN kind = 1 THEN {_id} END AS rusher_player_id, CASE WHEN kind = 0 AND l_orderkey % 11 <> 0 THEN {_id} END AS receiver_player_id
  FROM lines CROSS JOIN ends WHERE season < last OR week < 10""",
    "usage": """SELECT season, week, game_id, team, slot, posteam, defteam, CAST(sum(pass_attempt) AS INT) AS targets, CAST(sum(CASE WHEN kind = 0 AND q % 2 = 0 THEN 1 ELSE 0 END) AS INT) AS receptions,
  CAST(sum(CASE WHEN kind = 0 THEN q ELSE 0 END) AS INT) AS receiving_yards, CAST(sum(rush_attempt) AS INT) AS carries, CAST(sum(CASE WHEN kind = 1 THEN q ELSE 0 END) AS INT) AS rushing_yards,
  CAST(count(*) AS INT) AS snaps, CAST(sum(CASE WHEN q > 45 THEN 1 ELSE 0 END) AS INT) AS tds FROM plays GROUP BY season, week, game_id, team, slot, posteam, defteam""",
    "player_stats": f"""SELECT {_id} AS player_id, concat('Player ', 100 + team * 6 + slot) AS player_name, {_position} AS position, {_position} AS position_group, season, week, 'REG' AS season_type,
  game_id, posteam AS team, defteam AS opponent_team, targets, receptions, receiving_yards, receiving_yards + targets AS receiving_air_yards, carries, rushing_yards, tds AS receiving_tds,
  snaps % 3 AS rushing_fumbles_lost, {_zero("completions", "attempts", "passing_yards", "passing_tds", "passing_interceptions", "rushing_tds", "sack_fumbles_lost", "receiving_fumbles_lost", "passing_2pt_conversions", "rushing_2pt_conversions", "receiving_2pt_conversions", "special_teams_tds")},
  CAST(receiving_yards + rushing_yards AS DOUBLE) / 8 + 6 * tds AS fantasy_points, CAST(receiving_yards + rushing_yards AS DOUBLE) / 8 + 6 * tds + receptions AS fantasy_points_ppr FROM usage""",
    "snap_counts": f"SELECT game_id, {_id} AS player_id, snaps AS offense_snaps, CAST(1 + slot AS DOUBLE) / 8 AS offense_pct FROM usage WHERE snaps % 4 <> 3",
    "ff_opportunity": f"SELECT game_id, {_id} AS player_id, CAST(targets * 3 + carries AS DOUBLE) / 2 AS total_fantasy_points_exp FROM usage WHERE snaps % 5 <> 4",
    "roster": f"SELECT season, week, team, slot, {_id} AS player_id, {_position} AS position FROM seasons CROSS JOIN range(1, 18) AS w(week) CROSS JOIN range(0, 24) AS t(team) CROSS JOIN range(0, 6) AS s(slot)",
    "rosters": "SELECT season, CAST(week AS INT) AS week, 'REG' AS game_type, player_id, concat('T', 10 + team) AS team, position, CASE WHEN (team + week) % 3 <> 0 THEN CAST(slot AS INT) END AS years_exp FROM roster WHERE (team + slot + week) % 9 <> 0",
    "depth_charts": """SELECT season, CAST(week AS INT) AS week, 'REG' AS game_type, CAST(NULL AS TIMESTAMP) AS published_at, concat('T', 10 + team) AS team, player_id, concat('Player ', 100 + team * 6 + slot) AS player_name,
  position, CAST(1 + slot % 2 AS INT) AS depth_rank FROM roster CROSS JOIN ends WHERE season < last AND (season + week + team + slot) % 5 <> 0
UNION ALL SELECT season, CAST(NULL AS INT), CAST(NULL AS STRING), CAST(make_date(season, 9, 1) + CAST(7 * (week - 1) AS INT) AS TIMESTAMP) + INTERVAL '17' HOUR, concat('T', 10 + team), player_id,
  concat('Player ', 100 + team * 6 + slot), position, CAST(1 + slot % 2 AS INT) FROM roster CROSS JOIN ends WHERE season = last AND (week + team) % 3 <> 0 AND (week + slot) % 4 <> 0""",
    "injuries": """SELECT season, CAST(week AS INT) AS week, 'REG' AS game_type, player_id, CASE WHEN (team + week) % 2 = 0 THEN 'Out' WHEN slot < 4 THEN 'Questionable' END AS report_status, 'Knee' AS report_primary_injury,
  CASE WHEN slot % 2 = 0 THEN 'Limited Participation in Practice' END AS practice_status FROM roster WHERE (team * 5 + slot * 3 + week) % 8 = 0""",
    "players": "SELECT DISTINCT player_id, concat('Player ', 100 + team * 6 + slot) AS player_name, make_date(CAST(1990 + slot AS INT), CAST(1 + team % 12 AS INT), 15) AS birth_date, CAST(1990 + slot AS INT) AS rookie_season FROM roster WHERE team <> 23",
    "experts": """SELECT season, CAST(week AS INT) AS week, player_id, position, CAST((team * 13 + slot * 7 + week) % 97 AS DOUBLE) / 4 AS ecr,
  CAST(row_number() OVER (PARTITION BY season, week, position ORDER BY (team * 13 + slot * 7 + week) % 97, player_id) AS INT) AS ecr_rank FROM roster WHERE (team + slot) % 7 <> 0""",
}


def _projections() -> str:
    ours = ", ".join(f"CAST((team + slot + {k}) % 9 AS DOUBLE) AS proj_{x}" for k, x in enumerate(COMPONENTS))
    point = "CAST((team * 11 + slot * 17 + r.week * 5 + r.season) % 83 AS DOUBLE) / 4"
    bands = ", ".join(f"{point} * {m} AS proj_{f}, {point} * {m} / 2 AS floor_{f}, {point} * {m} * 2 AS ceiling_{f}" for f, m in (("ppr", "1"), ("half", "0.75"), ("std", "0.5")))
    return f"""SELECT r.season, CAST(r.week AS INT) AS week, f.game_id, f.kickoff_at, r.player_id, concat('Player ', 100 + team * 6 + slot) AS player_name, position, concat('T', 10 + team) AS team,
  CASE WHEN f.home_team = concat('T', 10 + team) THEN f.away_team ELSE f.home_team END AS opponent, f.home_team = concat('T', 10 + team) AS is_home, CAST(20 AS DOUBLE) AS implied_points,
  f.spread_line AS team_spread, f.total_line, CAST(1 + slot % 2 AS INT) AS depth_rank, CASE WHEN slot = 4 THEN 'Questionable' END AS report_status, CAST(NULL AS STRING) AS report_primary_injury,
  CAST(team AS BIGINT) AS opp_matchup_rank, {ours}, {bands}, CASE WHEN (team + r.week) % 5 <> 0 THEN {point} + 1 END AS baseline_last3, {point} - 1 AS baseline_season_avg, CAST(NULL AS BIGINT) AS ecr_rank,
  'backtest' AS kind, 'v1' AS model_version, CAST(make_date(r.season, 9, 1) AS TIMESTAMP) AS generated_at
  FROM roster r JOIN schedules f ON r.season = f.season AND r.week = f.week AND (f.home_team = concat('T', 10 + team) OR f.away_team = concat('T', 10 + team))"""


FRAMES["drafts"] = _projections()


def with_frames(sql: str, *made: tuple[str, str], duck: bool = True) -> str:
    """A query over the league's frames, and over others (name, SQL) that are made from them."""
    text = "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in [*FRAMES.items(), *made]) + "\n" + sql
    return text.replace("AS STRING)", "AS VARCHAR)") if duck else text


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the league's frames, made from the driver's tables once a session."""

    def make() -> DataFrame:
        used = [n for n in FRAMES if n in needed(name)]
        text = "WITH " + ", ".join(f"{n} AS ({FRAMES[n]})" for n in used) + f" SELECT * FROM {name}"
        return spark.sql(text.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, sf_dir, "lineitem"))

    return kept(spark, f"league {sf_dir} {name}", make)


def needed(name: str) -> set[str]:
    """A frame and those that it is made from."""
    found = {name}
    for other in FRAMES:
        if other not in found and re.search(rf"\b(?:FROM|JOIN) {other}\b", FRAMES[name]):
            found |= needed(other)
    return found


def frames(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [frame(spark, sf_dir, name) for name in names]


#: Years by which line items' dates are moved, so that their seasons are among those that silver reads.
LATER = 30


def _later(df: DataFrame) -> DataFrame:
    part = lambda k: F.split("game_id", "_")[k]
    moved = {"season": F.col("season") + LATER, "game_id": F.concat_ws("_", (part(0).cast("int") + LATER).cast("string"), part(1), part(2)), "gameday": F.add_months("gameday", 12 * LATER)}
    return df.withColumns({k: v for k, v in moved.items() if k in df.columns})


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The league as landing scans give it: loosely typed, with lineage, each season's file beside an older one that does not count."""
    names = {"plays": "plays", "player_stats": "player_stats", "snap_counts": "snap_counts", "rosters": "rosters", "injuries": "injuries", "ff_opportunity": "ff_opportunity", "schedules": "schedules", "players": "players"}
    raw, game = {}, lambda df: df.withColumns({"season": F.split("game_id", "_")[0], "week": F.split("game_id", "_")[1]})
    for name, source in names.items():
        df = _later(frame(spark, sf_dir, source))
        df = game(df) if name in ("snap_counts", "ff_opportunity") else df
        own = {"player_display_name": "player_name", "display_name": "player_name", "gsis_id": "player_id", "pfr_player_id": "player_id", "pfr_id": "player_id"}
        given = {"gametime": F.lit("13:00"), "game_type": F.lit("REG"), "season_type": F.lit("REG")}
        wanted = [*c.CONTRACTS[name], *(["gsis_id"] if name in ("players", "rosters", "injuries") else []), *(["pfr_id"] if name == "players" else [])]
        value = lambda col, df=df, given=given: F.col(col) if col in df.columns else F.col(own[col]) if own.get(col) in df.columns else given.get(col, F.lit(None))
        raw[name] = df.select(*[value(col).cast("string").alias(col) for col in wanted])
    roster = _later(frame(spark, sf_dir, "roster"))
    number = F.col("team") * 6 + F.col("slot")
    person = F.concat(F.lit("Player "), 100 + number)
    raw["depth_charts"] = roster.select(
        F.col("season").cast("double").alias("season"), F.col("week").cast("double").alias("week"), F.lit("REG").alias("game_type"), F.concat(F.lit("T"), 10 + F.col("team")).alias("club_code"),
        F.lit("Offense").alias("formation"), F.col("player_id").alias("gsis_id"), person.alias("full_name"), F.col("position").alias("depth_position"), (1 + F.col("slot") % 2).cast("string").alias("depth_team"),
    )
    raw["player_ids"] = roster.select((1000 + number).cast("string").alias("fantasypros_id"), F.col("player_id").alias("gsis_id")).distinct()
    raw["ecr"] = roster.select(
        person.alias("player"), (1000 + number).cast("string").alias("id"), F.col("position").alias("pos"), F.concat(F.lit("T"), 10 + F.col("team")).alias("team"),
        (((F.col("team") * 13 + F.col("slot") * 7 + F.col("week")) % 97).cast("double") / 4).cast("string").alias("ecr"), F.lit("1").alias("sd"), F.lit("1").alias("best"), F.lit("9").alias("worst"),
        F.date_add(F.make_date("season", F.lit(9), F.lit(1)), (5 * (F.col("week") - 1)).cast("int")).cast("string").alias("scrape_date"), "season",
    )
    out = {}
    for name, df in raw.items():
        season = F.concat(F.lit("/z/"), F.col("season").cast("int").cast("string"), F.lit("/b.parquet")) if "season" in df.columns and name != "schedules" else F.lit("/z/all/b.parquet")
        out[f"bronze_{name}"] = df.withColumns({SEEN_AT: F.lit("2025-02-01").cast("timestamp"), SEEN_IN: season})
    return out

"""Queries of the domain functions on the made-up league, with the SQL that must agree."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.plans import datasets as d
from gaugework.plans import features as fx
from gaugework.plans import graph, league, marts, model
from gaugework.plans import projections as pj
from gaugework.plans.league import frames, with_frames
from gaugework.plans.registry import query
from gaugework.session import kept
from gaugework.sources.landing import SEEN_AT, SEEN_IN

#: SQL of the facts, each made from the league's frames and those before it.
GAMES = (
    "team_games",
    """SELECT season, week, game_id, home_team AS team, away_team AS opponent, TRUE AS is_home, kickoff_at, spread_line AS team_spread, total_line, (total_line + spread_line) / 2 AS implied_points,
  home_score AS points_for, away_score AS points_against, home_score IS NOT NULL AND away_score IS NOT NULL AS is_final FROM schedules WHERE game_type = 'REG'
UNION ALL SELECT season, week, game_id, away_team, home_team, FALSE, kickoff_at, -spread_line, total_line, (total_line - spread_line) / 2, away_score, home_score,
  home_score IS NOT NULL AND away_score IS NOT NULL FROM schedules WHERE game_type = 'REG'""",
)
TEAM_WEEK = (
    "team_week",
    """SELECT g.*, offensive_plays, dropbacks, rush_attempts, red_zone_plays, team_targets, team_carries, team_air_yards, ppr_points_qb, ppr_points_rb, ppr_points_wr, ppr_points_te FROM team_games g
LEFT JOIN (SELECT game_id, posteam, count(*) AS offensive_plays, sum(pass_attempt)::BIGINT AS dropbacks, sum(rush_attempt)::BIGINT AS rush_attempts, count(*) FILTER (yardline_100 <= 20) AS red_zone_plays
  FROM plays WHERE play_type IN ('pass', 'run') AND coalesce(two_point_attempt, 0) = 0 GROUP BY ALL) v ON g.game_id = v.game_id AND g.team = v.posteam
LEFT JOIN (SELECT game_id, team, sum(targets)::BIGINT AS team_targets, sum(carries)::BIGINT AS team_carries, sum(receiving_air_yards)::BIGINT AS team_air_yards,
  sum(fantasy_points_ppr) FILTER (position_group = 'QB') AS ppr_points_qb, sum(fantasy_points_ppr) FILTER (position_group = 'RB') AS ppr_points_rb,
  sum(fantasy_points_ppr) FILTER (position_group = 'WR') AS ppr_points_wr, sum(fantasy_points_ppr) FILTER (position_group = 'TE') AS ppr_points_te
  FROM player_stats GROUP BY ALL) u ON g.game_id = u.game_id AND g.team = u.team""",
)
PLAYER_WEEK = (
    "player_week",
    """SELECT b.season, b.week, b.game_id, b.player_id, b.player_name, b.position_group AS position, b.team, coalesce(t.opponent, b.opponent_team) AS opponent, t.is_home, b.fantasy_points_ppr,
  (b.fantasy_points_ppr + b.fantasy_points) / 2 AS fantasy_points_half, b.fantasy_points AS fantasy_points_std, completions, attempts, passing_yards, passing_tds, passing_interceptions, carries, rushing_yards,
  rushing_tds, targets, receptions, receiving_yards, receiving_tds, sack_fumbles_lost + rushing_fumbles_lost + receiving_fumbles_lost AS fumbles_lost,
  passing_2pt_conversions + rushing_2pt_conversions + receiving_2pt_conversions AS two_point_conversions, special_teams_tds, offense_snaps, snap_share,
  CASE WHEN team_targets > 0 THEN targets / team_targets END AS target_share, CASE WHEN team_carries > 0 THEN carries / team_carries END AS carry_share, receiving_air_yards AS air_yards,
  CASE WHEN team_air_yards > 0 THEN receiving_air_yards / team_air_yards END AS air_yards_share, coalesce(red_zone_targets, 0) AS red_zone_targets, coalesce(red_zone_carries, 0) AS red_zone_carries,
  coalesce(goal_line_carries, 0) AS goal_line_carries,
  CASE WHEN red_zone_plays > 0 THEN (coalesce(red_zone_targets, 0) + coalesce(red_zone_carries, 0)) / red_zone_plays END AS red_zone_share, expected_ppr
FROM player_stats b LEFT JOIN team_week t ON b.game_id = t.game_id AND b.team = t.team
LEFT JOIN (SELECT game_id, player_id, max(offense_snaps) AS offense_snaps, max(offense_pct) AS snap_share FROM snap_counts GROUP BY ALL) s ON b.game_id = s.game_id AND b.player_id = s.player_id
LEFT JOIN (SELECT game_id, receiver_player_id AS player_id, count(*) FILTER (yardline_100 <= 20) AS red_zone_targets FROM plays
  WHERE coalesce(two_point_attempt, 0) = 0 AND pass_attempt = 1 AND sack = 0 AND receiver_player_id IS NOT NULL GROUP BY ALL) r ON b.game_id = r.game_id AND b.player_id = r.player_id
LEFT JOIN (SELECT game_id, rusher_player_id AS player_id, count(*) FILTER (yardline_100 <= 20) AS red_zone_carries, count(*) FILTER (yardline_100 <= 5) AS goal_line_carries FROM plays
  WHERE coalesce(two_point_attempt, 0) = 0 AND rush_attempt = 1 AND rusher_player_id IS NOT NULL GROUP BY ALL) c ON b.game_id = c.game_id AND b.player_id = c.player_id
LEFT JOIN (SELECT game_id, player_id, max(total_fantasy_points_exp) AS expected_ppr FROM ff_opportunity GROUP BY ALL) e ON b.game_id = e.game_id AND b.player_id = e.player_id""",
)
DEFENSE = (
    "defense_vs_position",
    """SELECT *, rank() OVER (PARTITION BY season, week, position ORDER BY ppr_allowed_l6 DESC NULLS LAST, team)::INT AS matchup_rank FROM (
SELECT g.season, g.week, g.game_id, g.team, g.opponent, p.position, coalesce(ppr_allowed, 0) AS ppr_allowed, coalesce(half_allowed, 0) AS half_allowed, coalesce(std_allowed, 0) AS std_allowed,
  coalesce(players, 0) AS players, avg(coalesce(ppr_allowed, 0)) OVER w AS ppr_allowed_l6, count(*) OVER w AS games_l6
FROM (SELECT * FROM team_week WHERE is_final) g CROSS JOIN (VALUES ('QB'), ('RB'), ('WR'), ('TE')) p(position)
LEFT JOIN (SELECT game_id, opponent AS team, position, sum(fantasy_points_ppr) AS ppr_allowed, sum(fantasy_points_half) AS half_allowed, sum(fantasy_points_std) AS std_allowed, count(*) AS players
  FROM player_week GROUP BY ALL) a ON g.game_id = a.game_id AND g.team = a.team AND p.position = a.position
WINDOW w AS (PARTITION BY g.team, p.position ORDER BY g.season, g.week ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING))""",
)
CHARTS = (
    "depth_chart_week",
    """SELECT c.season, c.week, g.game_id, c.team, c.player_id, c.player_name, c.position, c.depth_rank, c.published_at FROM depth_charts c JOIN team_games g ON c.season = g.season AND c.week = g.week AND c.team = g.team
WHERE c.game_type = 'REG' AND c.week IS NOT NULL
UNION ALL SELECT c.season, g.week, g.game_id, c.team, c.player_id, c.player_name, c.position, c.depth_rank, c.published_at FROM team_games g
JOIN (SELECT DISTINCT g2.game_id, g2.team, (SELECT max(x.published_at) FROM depth_charts x WHERE x.season = g2.season AND x.team = g2.team AND x.published_at < g2.kickoff_at) AS at FROM team_games g2) m
  ON g.game_id = m.game_id AND g.team = m.team JOIN depth_charts c ON c.season = g.season AND c.team = g.team AND c.published_at = m.at""",
)
SCRAPES = (
    "scrapes",
    """SELECT concat('Player ', 100 + team * 6 + slot) AS player, CAST(1000 + team * 6 + slot AS STRING) AS id, position AS pos, concat('T', 10 + team) AS team, CAST(CAST((team * 13 + slot * 7 + week) % 97 AS DOUBLE) / 4 AS STRING) AS ecr,
  '1' AS sd, '1' AS best, '9' AS worst, CAST(make_date(season, 9, 1) + CAST(5 * (week - 1) AS INT) AS STRING) AS scrape_date, season FROM roster""",
)
FACTS = (GAMES, TEAM_WEEK, PLAYER_WEEK, DEFENSE, CHARTS)


def tables(spark, sf_dir) -> dict:
    """The facts of the league, each written once a session and read by those after it."""
    games, plays, box, snaps, opportunity, charts = frames(spark, sf_dir, "schedules", "plays", "player_stats", "snap_counts", "ff_opportunity", "depth_charts")
    t, put = {}, lambda name, make: t.__setitem__(name, kept(spark, f"league {sf_dir} {name}", make))
    put("team_week", lambda: d.team_week(games, plays, box))
    put("player_week", lambda: d.player_week(box, snaps, plays, t["team_week"], opportunity))
    put("defense_vs_position", lambda: d.defense_vs_position(t["player_week"], t["team_week"]))
    put("depth_chart_week", lambda: d.depth_chart_week(charts, games))
    return t


@query(with_frames("SELECT * EXCLUDE (kickoff_at), epoch(kickoff_at)::BIGINT AS kickoff FROM team_games", GAMES))
def gold_team_games(spark, sf_dir):
    """A1: each game from either side, with its lines."""
    return d.team_games(league.frame(spark, sf_dir, "schedules")).withColumn("kickoff", F.unix_timestamp("kickoff_at")).drop("kickoff_at")


@query(with_frames("SELECT * EXCLUDE (kickoff_at) FROM team_week", GAMES, TEAM_WEEK))
def gold_team_week(spark, sf_dir):
    """A2: lines, volume and usage of each team's games."""
    return d.team_week(*frames(spark, sf_dir, "schedules", "plays", "player_stats")).drop("kickoff_at")


@query(with_frames("SELECT * FROM player_week", GAMES, TEAM_WEEK, PLAYER_WEEK))
def gold_player_week(spark, sf_dir):
    """A3: points and shares of each player's games."""
    return tables(spark, sf_dir)["player_week"]


@query(with_frames("SELECT * FROM defense_vs_position", GAMES, TEAM_WEEK, PLAYER_WEEK, DEFENSE))
def gold_defense(spark, sf_dir):
    """A4: points allowed, their mean over six games before, and the place by it."""
    return tables(spark, sf_dir)["defense_vs_position"]


@query(with_frames("SELECT * EXCLUDE (published_at), epoch(published_at)::BIGINT AS published FROM depth_chart_week", GAMES, CHARTS))
def gold_depth_chart_week(spark, sf_dir):
    """The chart of the week, or the last snapshot before kickoff."""
    charts, games = frames(spark, sf_dir, "depth_charts", "schedules")
    return d.depth_chart_week(charts, games).withColumn("published", F.unix_timestamp("published_at")).drop("published_at")


def _landed(df, season: str):
    """A frame as if read from the newest landed file of each season, beside an older one of which nothing counts."""
    new = df.withColumns({SEEN_AT: F.lit("2025-02-01").cast("timestamp"), SEEN_IN: F.concat(F.lit("/z/"), F.col(season).cast("string"), F.lit("/b.parquet"))})
    old = df.withColumns({SEEN_AT: F.lit("2025-01-01").cast("timestamp"), SEEN_IN: F.concat(F.lit("/z/"), F.col(season).cast("string"), F.lit("/a.parquet"))})
    return new.unionByName(old)


RAW_CHARTS = """SELECT season::INT AS season, week::INT AS week, CASE WHEN season < last THEN 'REG' END AS game_type, concat('T', 10 + team) AS team, player_id, concat('Player ', 100 + team * 6 + slot) AS player_name, position,
  (1 + slot % 2)::INT AS depth_rank, season < last AS weekly, slot FROM roster CROSS JOIN ends"""


@query(
    with_frames(
        """SELECT season, week, game_type, team, player_id, player_name, position, depth_rank, NULL::BIGINT AS published FROM raw WHERE weekly AND slot <> 2
UNION ALL SELECT season, NULL, NULL, team, player_id, player_name, position, dense_rank() OVER (PARTITION BY season, week, team, position ORDER BY slot)::INT,
  epoch(make_date(season, 9, 1) + (7 * (week - 1))::INT)::BIGINT + 43200 FROM raw WHERE NOT weekly AND slot <> 2""",
        ("raw", RAW_CHARTS),
    )
)
def silver_depth_charts(spark, sf_dir):
    """A5: weekly charts and dated snapshots in one shape; a second, worse listing of a player does not count."""
    roster, ends = frames(spark, sf_dir, "roster", "ends")
    rows = roster.crossJoin(F.broadcast(ends)).where("slot <> 2")  # ends is one row
    name, gsis = F.concat(F.lit("Player "), 100 + F.col("team") * 6 + F.col("slot")), F.concat(F.lit(" "), "player_id", F.lit(" "))
    old = rows.where("season < last").select(
        F.col("season").cast("double").alias("season"), F.col("week").cast("double").alias("week"), F.lit("REG").alias("game_type"), F.concat(F.lit("T"), 10 + F.col("team")).alias("club_code"),
        F.lit("Offense").alias("formation"), gsis.alias("gsis_id"), name.alias("full_name"), F.concat(F.lit(" "), "position").alias("depth_position"),
        F.explode(F.array((1 + F.col("slot") % 2).cast("string"), F.lit("3"))).alias("depth_team"),
    )
    dated = rows.where("season = last").select(
        F.col("season").cast("double").alias("season"), F.concat(F.make_date("season", F.lit(9), F.lit(1)) + (7 * (F.col("week") - 1)).cast("int"), F.lit("T12:00:00Z")).alias("dt"),
        F.concat(F.lit("T"), 10 + F.col("team")).alias("team"), gsis.alias("gsis_id"), name.alias("player_name"), F.col("position").alias("pos_abb"), F.lit("1").alias("pos_slot"), (10 * F.col("slot")).cast("string").alias("pos_rank"),
    )
    whole = F.col("season").cast("int")
    bronze = _landed(old.unionByName(dated, allowMissingColumns=True).withColumn("__s", whole), "__s").drop("__s")
    return d.depth_charts(bronze).withColumn("published", F.unix_timestamp("published_at")).drop("published_at")


@query(
    with_frames(
        """SELECT player AS player_name, pos AS position, team, ecr::DOUBLE AS ecr, day AS scrape_date, id::BIGINT AS fantasypros_id, season, week,
  row_number() OVER (PARTITION BY season, week, pos ORDER BY ecr::DOUBLE, id::BIGINT)::INT AS ecr_rank, CASE WHEN id::BIGINT % 7 <> 0 THEN concat('P', id::BIGINT - 900) END AS player_id FROM newest WHERE day = last_day""",
        SCRAPES,
        ("shifted", "SELECT season, week, gameday + CAST(k % 7 AS INT) AS gameday FROM (SELECT s.*, row_number() OVER (PARTITION BY season, week ORDER BY game_id) AS k FROM schedules s)"),
        ("sundays", "SELECT season, week, min(CASE WHEN dayofweek(gameday) = 0 THEN gameday END) AS sunday FROM shifted GROUP BY season, week"),
        ("placed", "SELECT s.*, scrape_date::DATE AS day, (SELECT min(x.week) FROM sundays x WHERE x.season = s.season AND x.sunday > s.scrape_date::DATE) AS week FROM scrapes s"),
        ("newest", "SELECT *, max(day) OVER (PARTITION BY season, week, pos) AS last_day FROM placed WHERE week IS NOT NULL"),
    )
)
def silver_ecr(spark, sf_dir):
    """Rankings of the first week whose Sunday is ahead; the last scrape of a week counts."""
    from pyspark.sql import Window

    roster, games = frames(spark, sf_dir, "roster", "schedules")
    number = F.col("team") * 6 + F.col("slot")
    raw = roster.select(
        F.concat(F.lit("Player "), 100 + number).alias("player"), (1000 + number).cast("string").alias("id"), F.col("position").alias("pos"), F.concat(F.lit("T"), 10 + F.col("team")).alias("team"),
        (((F.col("team") * 13 + F.col("slot") * 7 + F.col("week")) % 97).cast("double") / 4).cast("string").alias("ecr"), F.lit("1").alias("sd"), F.lit("1").alias("best"), F.lit("9").alias("worst"),
        (F.make_date("season", F.lit(9), F.lit(1)) + (5 * (F.col("week") - 1)).cast("int")).cast("string").alias("scrape_date"), "season",
    )
    place = F.row_number().over(Window.partitionBy("season", "week").orderBy("game_id"))
    shifted = games.withColumn("k", place).withColumn("gameday", F.date_add("gameday", F.col("k") % 7))
    ids = raw.select(F.col("id").cast("bigint").alias("fantasypros_id")).distinct().where("fantasypros_id % 7 <> 0").select("fantasypros_id", F.concat(F.lit("P"), F.col("fantasypros_id") - 900).alias("player_id"))
    return d.ecr(_landed(raw, "season").drop("season"), shifted, ids).drop("sd", "best", "worst")


# Candidates and features


ORDER = ("game_order", "SELECT season, week, team, game_id, row_number() OVER (PARTITION BY team, season ORDER BY week) - 1 AS game_index FROM team_week")
CANDIDATES = (
    "candidates",
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY season, week, player_id ORDER BY depth_rank NULLS LAST, team, chart_position) AS n FROM (
SELECT p.*, g.game_id, g.opponent, g.is_home, g.is_final, g.implied_points, coalesce(l.roster_position, p.chart_position, p.recent_position) AS position, coalesce(k.player_name, p.chart_name) AS player_name,
  k.birth_date, k.rookie_season, i.report_status, coalesce(i.injury_level, 0) AS injury_level, coalesce(i.practice_level, 0) AS practice_level, (p.depth_rank IS NOT NULL)::BIGINT AS on_depth_chart
FROM (SELECT coalesce(c.season, r.season) AS season, coalesce(c.week, r.week) AS week, coalesce(c.team, r.team) AS team, coalesce(c.player_id, r.player_id) AS player_id, c.player_name AS chart_name,
    c.depth_rank, c.position AS chart_position, r.recent_position FROM depth_chart_week c
  FULL JOIN (SELECT o.season, o.week, o.team, x.player_id, arg_min(x.position, o.game_index - b.game_index) AS recent_position FROM game_order o
    JOIN game_order b ON o.season = b.season AND o.team = b.team AND o.game_index - b.game_index IN (1, 2)
    JOIN player_week x ON x.season = b.season AND x.week = b.week AND x.team = b.team GROUP BY ALL) r
  ON c.season = r.season AND c.week = r.week AND c.team = r.team AND c.player_id = r.player_id) p
JOIN team_week g ON p.season = g.season AND p.week = g.week AND p.team = g.team
LEFT JOIN (SELECT season, week, player_id, min(position) AS roster_position FROM rosters GROUP BY ALL) l ON p.season = l.season AND p.week = l.week AND p.player_id = l.player_id
LEFT JOIN players k ON p.player_id = k.player_id
LEFT JOIN (SELECT *, CASE report_status WHEN 'Out' THEN 3 WHEN 'Questionable' THEN 1 ELSE 0 END AS injury_level, CASE WHEN practice_status IS NULL THEN 0 ELSE 1 END AS practice_level FROM injuries) i
  ON p.season = i.season AND p.week = i.week AND p.player_id = i.player_id) WHERE injury_level < 3) WHERE n = 1""",
)
POOL = (*FACTS, ORDER, CANDIDATES)
STATES = (
    "states",
    """SELECT player_id, season * 100 + week AS t, season AS state_season, week AS state_week, row_number() OVER p AS games_played, fantasy_points_ppr AS ppr_last1,
  avg(fantasy_points_ppr) OVER (PARTITION BY player_id ORDER BY season, week ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS ppr_last3, row_number() OVER s AS season_games,
  avg(fantasy_points_ppr) OVER (PARTITION BY player_id, season ORDER BY week ROWS UNBOUNDED PRECEDING) AS season_ppr_mean,
  round(sum(fantasy_points_ppr * pow(2.0, g / 3.0)) OVER p / sum(pow(2.0, g / 3.0)) OVER p, 6) AS ewm_fantasy_points_ppr,
  round(sum(snap_share * pow(2.0, g / 3.0)) OVER p / sum(CASE WHEN snap_share IS NOT NULL THEN pow(2.0, g / 3.0) END) OVER p, 6) AS ewm_snap_share
FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY season, week) - 1 AS g FROM player_week)
WINDOW p AS (PARTITION BY player_id ORDER BY season, week ROWS UNBOUNDED PRECEDING), s AS (PARTITION BY player_id, season ORDER BY week ROWS UNBOUNDED PRECEDING)""",
)
MATCHUPS = (
    "matchups",
    """SELECT *, opp_ppr_allowed_l6 / avg(opp_ppr_allowed_l6) OVER (PARTITION BY season, week, position) AS opp_matchup_index,
  CASE WHEN opp_ppr_allowed_l6 IS NOT NULL THEN rank() OVER (PARTITION BY season, week, position ORDER BY opp_ppr_allowed_l6 DESC NULLS LAST) END AS opp_matchup_rank FROM (
SELECT w.season, w.week, k.team AS opponent, k.position, s.l6 AS opp_ppr_allowed_l6 FROM (SELECT DISTINCT season, week, season * 100 + week AS t FROM candidates) w
CROSS JOIN (SELECT DISTINCT team, position FROM defense_vs_position) k
ASOF LEFT JOIN (SELECT team, position, season * 100 + week AS t, avg(ppr_allowed) OVER (PARTITION BY team, position ORDER BY season, week ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS l6 FROM defense_vs_position) s
  ON k.team = s.team AND k.position = s.position AND w.t > s.t)""",
)
FEATURES = (
    "features",
    """SELECT c.season, c.week, c.player_id, c.position, coalesce(s.games_played, 0) AS games_played, CASE WHEN s.state_season = c.season THEN s.season_games ELSE 0 END AS season_games,
  CASE WHEN s.state_season = c.season THEN s.season_ppr_mean END AS season_ppr_mean, s.ppr_last1, s.ppr_last3, m.prev AS prev_season_ppr_mean, s.ewm_fantasy_points_ppr,
  greatest(o.game_index - CASE WHEN s.state_season = c.season THEN s.season_games ELSE 0 END, 0) AS games_missed_season,
  CASE WHEN b.week IS NOT NULL THEN CASE WHEN s.state_season = c.season AND s.state_week = b.week THEN 0.0 ELSE 1.0 END END::DOUBLE AS missed_last_game,
  x.opp_ppr_allowed_l6, round(x.opp_matchup_index, 9) AS opp_matchup_index, x.opp_matchup_rank, coalesce(CASE WHEN e.season = c.season THEN e.years_exp END, c.season - c.rookie_season)::DOUBLE AS years_exp,
  (date_diff('day', c.birth_date, make_date(c.season, 9, 1)) / 365.25)::DOUBLE AS age, c.is_home::INT::DOUBLE AS is_home
FROM (SELECT *, season * 100 + week AS t FROM candidates) c
ASOF LEFT JOIN states s ON c.player_id = s.player_id AND c.t > s.t
ASOF LEFT JOIN (SELECT *, season * 100 + week AS t FROM rosters WHERE years_exp IS NOT NULL) e ON c.player_id = e.player_id AND c.t >= e.t
LEFT JOIN (SELECT player_id, season + 1 AS season, avg(fantasy_points_ppr) AS prev FROM player_week GROUP BY ALL) m ON c.player_id = m.player_id AND c.season = m.season
LEFT JOIN game_order o ON c.season = o.season AND c.week = o.week AND c.team = o.team
LEFT JOIN game_order b ON c.season = b.season AND c.team = b.team AND o.game_index = b.game_index + 1
LEFT JOIN matchups x ON c.season = x.season AND c.week = x.week AND c.opponent = x.opponent AND c.position = x.position""",
)


def known(spark, sf_dir) -> dict:
    """The facts and what else candidates and features need."""
    names = ("rosters", "players", "injuries")
    return tables(spark, sf_dir) | dict(zip(names, frames(spark, sf_dir, *names)))


@query(with_frames("SELECT season, week, player_id, game_id, player_name, position, team, opponent, is_home, is_final, depth_rank, on_depth_chart, report_status, injury_level, practice_level FROM candidates", *POOL))
def candidate_pool(spark, sf_dir):
    """Who is projected: on the chart or in the last two games, and not ruled out."""
    rows = fx.candidates(known(spark, sf_dir))
    return rows.select("season", "week", "player_id", "game_id", "player_name", "position", "team", "opponent", "is_home", "is_final", "depth_rank", "on_depth_chart", "report_status", "injury_level", "practice_level")


@query(with_frames("SELECT * EXCLUDE (t) FROM states", *FACTS[:3], STATES))
def player_states(spark, sf_dir):
    """Each player's form after each game."""
    rows = fx.player_states(tables(spark, sf_dir)["player_week"])
    kept = ["player_id", "state_season", "state_week", "games_played", "ppr_last1", "ppr_last3", "season_games", "season_ppr_mean"]
    return rows.select(*kept, *[F.round(f"ewm_{x}", 6).alias(f"ewm_{x}") for x in ("fantasy_points_ppr", "snap_share")])


@query(
    with_frames(
        """SELECT team, season, week, round(sum(points_for * w) OVER p / sum(CASE WHEN points_for IS NOT NULL THEN w END) OVER p, 6) AS team_ewm_points_for,
  round(sum(pass_rate * w) OVER p / sum(CASE WHEN pass_rate IS NOT NULL THEN w END) OVER p, 6) AS team_ewm_pass_rate
FROM (SELECT *, pow(2.0, (row_number() OVER (PARTITION BY team ORDER BY season, week) - 1) / 4.0) AS w, CASE WHEN offensive_plays > 0 THEN dropbacks / offensive_plays END AS pass_rate FROM team_week WHERE is_final)
WINDOW p AS (PARTITION BY team ORDER BY season, week ROWS UNBOUNDED PRECEDING)""",
        *FACTS[:2],
    )
)
def team_states(spark, sf_dir):
    """Each team's form after each game."""
    rows = fx.team_states(tables(spark, sf_dir)["team_week"])
    return rows.select("team", (F.col("t") / 100).cast("int").alias("season"), (F.col("t") % 100).cast("int").alias("week"), *[F.round(f"team_ewm_{x}", 6).alias(f"team_ewm_{x}") for x in ("points_for", "pass_rate")])


@query(with_frames("SELECT season, week, opponent, position, opp_ppr_allowed_l6, round(opp_matchup_index, 9) AS opp_matchup_index, opp_matchup_rank FROM matchups", *POOL, MATCHUPS))
def defense_matchups(spark, sf_dir):
    """Every known defense before every week, against the league, ranked with ties."""
    t = known(spark, sf_dir)
    rows = fx.matchups(t["defense_vs_position"], fx.candidates(t))
    return rows.select("season", "week", "opponent", "position", "opp_ppr_allowed_l6", F.round("opp_matchup_index", 9).alias("opp_matchup_index"), F.col("opp_matchup_rank").cast("long").alias("opp_matchup_rank"))


FEATURE_COLUMNS = (
    "season week player_id position games_played season_games season_ppr_mean ppr_last1 ppr_last3 prev_season_ppr_mean ewm_fantasy_points_ppr games_missed_season missed_last_game "
    "opp_ppr_allowed_l6 opp_matchup_index opp_matchup_rank years_exp age is_home"
).split()


def _features(spark, sf_dir):
    t = known(spark, sf_dir)
    rows = kept(spark, f"league {sf_dir} features", lambda: fx.features(fx.candidates(t), t))
    return t, rows.withColumns({"ewm_fantasy_points_ppr": F.round("ewm_fantasy_points_ppr", 6), "opp_matchup_index": F.round("opp_matchup_index", 9)})


@query(with_frames("SELECT * FROM features", *POOL, STATES, MATCHUPS, FEATURES))
def feature_frame(spark, sf_dir):
    """A10: what was known of each candidate before kickoff, by strict as-of joins."""
    return _features(spark, sf_dir)[1].select(*FEATURE_COLUMNS)


@query(
    with_frames(
        """SELECT f.season, f.week, f.player_id, f.ppr_last3 AS baseline_last3, coalesce(f.season_ppr_mean, f.prev_season_ppr_mean) AS baseline_season_avg, coalesce(w.fantasy_points_ppr, 0) AS fantasy_points_ppr,
  coalesce(w.receiving_yards, 0) AS receiving_yards FROM features f LEFT JOIN player_week w ON f.season = w.season AND f.week = w.week AND f.player_id = w.player_id""",
        *POOL,
        STATES,
        MATCHUPS,
        FEATURES,
    )
)
def baselines_and_actuals(spark, sf_dir):
    """Both baselines, and what a candidate did, zero without a stat line."""
    t, rows = _features(spark, sf_dir)
    return fx.with_actuals(fx.with_baselines(rows), t["player_week"]).select("season", "week", "player_id", "baseline_last3", "baseline_season_avg", "fantasy_points_ppr", "receiving_yards")


class LastThree:
    """A model that projects the mean of the last three games, and counts how often one was fitted."""

    fitted = 0

    def __init__(self, past, **_):
        LastThree.fitted += 1

    def predict(self, rows):
        return rows.withColumns({x: F.coalesce(F.col("ppr_last3"), F.lit(0.0)) for x in model.OUTPUTS})


@query(
    with_frames(
        """SELECT f.season, f.week, f.player_id, coalesce(f.ppr_last3, 0) AS proj_ppr, f.ppr_last3 AS baseline_last3, 'backtest' AS kind, 1 AS refits
FROM features f JOIN candidates c ON f.season = c.season AND f.week = c.week AND f.player_id = c.player_id CROSS JOIN ends WHERE c.is_final AND f.season >= last - 1 AND (f.season < last OR f.week < 7)""",
        *POOL,
        STATES,
        MATCHUPS,
        FEATURES,
    )
)
def walked_seasons(spark, sf_dir):
    """Each season's finished weeks by a model of those before; on a second run only the season whose inputs changed is fitted again."""
    t, rows = _features(spark, sf_dir)
    rows = fx.with_actuals(rows, t["player_week"])
    last = league.frame(spark, sf_dir, "ends").first()["last"]
    walk = lambda df, stored: model.walk_forward(df, [last - 1, last], {last: 7}, stored, fit=LastThree)
    first = kept(spark, f"league {sf_dir} walked", lambda: walk(rows, None))
    before = LastThree.fitted
    changed = rows.withColumn("snaps", F.lit(0)).withColumn("fantasy_points_ppr", F.when((F.col("season") == last) & (F.col("week") == 6), F.col("fantasy_points_ppr") + 1).otherwise(F.col("fantasy_points_ppr")))
    again = walk(changed, first)
    return again.select("season", "week", "player_id", "proj_ppr", "baseline_last3", "kind", F.lit(LastThree.fitted - before).alias("refits"))


@query(
    with_frames(
        """SELECT u.team, count(c.player_id) AS n FROM (SELECT * FROM team_week WHERE NOT is_final AND (season, week) IN (SELECT (season, week) FROM team_week WHERE NOT is_final ORDER BY season, week LIMIT 1)) u
LEFT JOIN candidates c ON u.season = c.season AND u.week = c.week AND u.team = c.team GROUP BY u.team""",
        *POOL,
    )
)
def upcoming_pool(spark, sf_dir):
    """Candidates of each team that plays in the next week, zero where there are none."""
    from gaugework.operators import joins

    t = known(spark, sf_dir)
    week = pj.upcoming_week(t["team_week"])
    pool = fx.candidates(t, week)
    return joins.in_domain(pool.groupBy("team").agg(F.count("*").alias("n")), t["team_week"].join(F.broadcast(week), ["season", "week"], "left_semi"), ["team"], "n")


@query(
    with_frames(
        """SELECT * FROM (VALUES ('whole', 'passes'), ('thin', 'ThinPool'), ('uncharted', 'ThinPool')) v(pool, outcome)"""
    )
)
def pool_gate(spark, sf_dir):
    """An upcoming week with too few candidates, or too few of them on a chart, is refused."""
    roster = league.frame(spark, sf_dir, "roster").where("week = 17").select("team", "slot", F.lit(1).alias("on_depth_chart"))
    seasons = roster.groupBy("team").agg(F.count("*").alias("n"))
    out = []
    for name, pool in (("whole", roster), ("thin", roster.where("team <> 3 OR slot > 4")), ("uncharted", roster.withColumn("on_depth_chart", F.when(F.col("slot") > 3, 0).otherwise(1)))):
        try:
            pj.check_pool(pool, seasons)
            out.append((name, "passes"))
        except pj.ThinPool:
            out.append((name, "ThinPool"))
    return spark.createDataFrame(out, "pool string, outcome string")


# Projections


START_SIT = """CASE WHEN r <= CASE position WHEN 'QB' THEN 12 WHEN 'RB' THEN 24 WHEN 'WR' THEN 36 ELSE 12 END THEN 'Start'
  WHEN r <= CASE position WHEN 'QB' THEN 12 WHEN 'RB' THEN 36 WHEN 'WR' THEN 48 ELSE 16 END THEN 'Flex' ELSE 'Sit' END"""


@query(
    with_frames(
        f"""SELECT season, week, player_id, r AS pos_rank_half, {START_SIT} AS start_sit_half, r <= CASE position WHEN 'QB' THEN 24 WHEN 'RB' THEN 48 WHEN 'WR' THEN 72 ELSE 24 END AS tiered
FROM (SELECT *, row_number() OVER (PARTITION BY season, week, position ORDER BY proj_half DESC, player_id) AS r FROM drafts)"""
    )
)
def ranked_projections(spark, sf_dir):
    """Place and label of each week and position; the pool's first rows have a tier."""
    rows = pj.ranked(league.frame(spark, sf_dir, "drafts"), ("half",))
    return rows.select("season", "week", "player_id", "pos_rank_half", "start_sit_half", F.col("tier_half").isNotNull().alias("tiered"))


SPLIT = ("halves", "SELECT d.*, last FROM drafts d CROSS JOIN ends WHERE season = last AND week IN (9, 10)")


@query(
    with_frames(
        """SELECT season, week, player_id, 'old' AS kind, proj_ppr FROM halves WHERE week = 9 OR team IN ('T10', 'T12', 'T14')
UNION ALL SELECT season, week, player_id, 'new', proj_ppr + 1 FROM halves WHERE week = 10 AND team NOT IN ('T10', 'T12', 'T14')""",
        SPLIT,
    )
)
def frozen_projections(spark, sf_dir):
    """Stored rows of games that began stay, others are replaced; other weeks stay."""
    drafts, ends = frames(spark, sf_dir, "drafts", "ends")
    rows = drafts.join(F.broadcast(ends), F.col("season") == F.col("last")).where("week IN (9, 10)").drop("last")
    begun = F.col("team").isin("T10", "T12", "T14") | (F.col("week") == 9)
    rows = rows.withColumn("kickoff_at", F.when(begun, F.lit("2000-01-01").cast("timestamp")).otherwise(F.lit("2100-01-01").cast("timestamp")))
    fresh = rows.where("week = 10").withColumns({"kind": F.lit("new"), "proj_ppr": F.col("proj_ppr") + 1})
    out = pj.frozen(rows.withColumn("kind", F.lit("old")), fresh, F.lit("2050-01-01").cast("timestamp"))
    return out.select("season", "week", "player_id", "kind", "proj_ppr")


@query(
    with_frames(
        f"""SELECT season, week, player_id, kind, ecr_rank, r AS pos_rank_ppr, {START_SIT} AS start_sit_ppr FROM (SELECT m.*, e.ecr_rank::BIGINT AS ecr_rank,
  row_number() OVER (PARTITION BY m.season, m.week, m.position ORDER BY proj_ppr DESC, m.player_id) AS r FROM mixed m
  LEFT JOIN experts e ON m.season = e.season AND m.week = e.week AND m.player_id = e.player_id AND m.position = e.position)""",
        (
            "mixed",
            """SELECT * EXCLUDE (kind, ecr_rank, last), 'backtest' AS kind FROM drafts CROSS JOIN ends WHERE season >= last - 1 AND NOT (season = last AND week >= 8)
UNION ALL SELECT * EXCLUDE (kind, ecr_rank, last), 'live' FROM drafts CROSS JOIN ends WHERE season = last AND week >= 8 AND team <> 'T20'""",
        ),
    )
)
def assembled_projections(spark, sf_dir):
    """Live weeks from live rows alone, others from the backtest; the experts' rank where positions agree."""
    drafts, ends, experts = frames(spark, sf_dir, "drafts", "ends", "experts")
    rows = drafts.join(F.broadcast(ends), F.col("season") >= F.col("last") - 1)
    live = rows.where("season = last AND week >= 8 AND team <> 'T20'").withColumn("kind", F.lit("live")).drop("last")
    return pj.assembled(rows.drop("last"), live, experts).select("season", "week", "player_id", "kind", "ecr_rank", "pos_rank_ppr", "start_sit_ppr")


USED = ("expected_ppr", "snap_share")
_sums = ", ".join(
    f"avg({m}) OVER (PARTITION BY player_id, season ORDER BY week ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS {m}_recent, "
    f"avg({m}) OVER (PARTITION BY player_id, season ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND 3 PRECEDING) AS {m}_earlier"
    for m in USED
)
_before = ", ".join(f"CASE WHEN games >= 5 THEN {m}_earlier ELSE {m}_last END AS {m}_before" for m in USED)


@query(
    with_frames(
        """SELECT *, expected_ppr_recent - expected_ppr_before AS expected_ppr_change, snap_share_recent - snap_share_before AS snap_share_change,
  coalesce(expected_ppr_recent - expected_ppr_before >= 2.5 AND expected_ppr_recent >= 5, FALSE) AS is_riser,
  row_number() OVER (PARTITION BY season, week ORDER BY round(expected_ppr_recent - expected_ppr_before, 9) DESC NULLS LAST, player_id) AS riser_rank FROM compared""",
        *FACTS[:3],
        ("usage_states", f"SELECT player_id, season, week, team, row_number() OVER (PARTITION BY player_id, season ORDER BY week) AS games, {_sums} FROM player_week"),
        (
            "compared",
            f"""SELECT t.season::BIGINT AS season, t.week::BIGINT AS week, t.player_id, s.team, s.games - 3 AS games_earlier, CASE WHEN games >= 5 THEN 'earlier games this season' ELSE 'last season' END AS baseline_basis,
  {", ".join(f"{m}_recent" for m in USED)}, {_before} FROM (SELECT DISTINCT player_id, p.season, w.week FROM player_week p JOIN (SELECT DISTINCT season, week FROM schedules) w ON p.season = w.season) t
ASOF JOIN usage_states s ON t.player_id = s.player_id AND t.season = s.season AND t.week > s.week
LEFT JOIN (SELECT player_id, season + 1 AS season, {", ".join(f"avg({m}) AS {m}_last" for m in USED)} FROM player_week GROUP BY ALL) l ON t.player_id = l.player_id AND t.season = l.season
WHERE s.games >= 3 AND (s.games >= 5 OR l.player_id IS NOT NULL)""",
        ),
    )
)
def usage_risers(spark, sf_dir):
    """Usage in the last three games before each week against what came before."""
    facts, games = tables(spark, sf_dir)["player_week"], league.frame(spark, sf_dir, "schedules")
    rows = pj.risers(facts, games.select("season", "week"))
    return rows.select("season", "week", "player_id", "team", "games_earlier", "baseline_basis", *[f"{m}_{p}" for m in USED for p in ("recent", "before", "change")], "is_riser", "riser_rank")


# Evaluation and marts


SERVED = (
    "served",
    """SELECT d.* EXCLUDE (ecr_rank), e.ecr_rank::BIGINT AS ecr_rank FROM drafts d LEFT JOIN experts e ON d.season = e.season AND d.week = e.week AND d.player_id = e.player_id""",
)
LONG = (
    "long",
    """SELECT s.season, s.week, s.position, s.kind, s.player_id, coalesce(w.fantasy_points_ppr, 0) AS actual, m.method,
  CASE m.method WHEN 'model' THEN proj_ppr WHEN 'last3' THEN baseline_last3 WHEN 'season_avg' THEN baseline_season_avg ELSE -ecr_rank END AS prediction,
  CASE WHEN m.method = 'model' THEN (coalesce(w.fantasy_points_ppr, 0) BETWEEN floor_ppr AND ceiling_ppr)::INT END AS inside
FROM served s JOIN team_week g ON s.game_id = g.game_id AND s.team = g.team AND g.is_final LEFT JOIN player_week w ON s.season = w.season AND s.week = w.week AND s.player_id = w.player_id
CROSS JOIN (VALUES ('model'), ('last3'), ('season_avg'), ('ecr')) m(method)
WHERE ecr_rank <= CASE s.position WHEN 'QB' THEN 24 WHEN 'RB' THEN 48 WHEN 'WR' THEN 72 ELSE 24 END AND baseline_last3 IS NOT NULL""",
)
RANKS = (
    "ranks",
    """SELECT season, week, position, method, CASE WHEN n >= 5 AND n * sxx > sx * sx AND n * syy > sy * sy THEN (n * sxy - sx * sy) / sqrt((n * sxx - sx * sx) * (n * syy - sy * sy)) END AS spearman
FROM (SELECT season, week, position, method, count(*) AS n, sum(x)::DOUBLE AS sx, sum(y)::DOUBLE AS sy, sum(x * x)::DOUBLE AS sxx, sum(y * y)::DOUBLE AS syy, sum(x * y)::DOUBLE AS sxy FROM (
  SELECT *, rank() OVER (PARTITION BY season, week, position, method ORDER BY prediction) + (count(*) OVER (PARTITION BY season, week, position, method, prediction) - 1) / 2.0 AS x,
    rank() OVER (PARTITION BY season, week, position, method ORDER BY actual) + (count(*) OVER (PARTITION BY season, week, position, method, actual) - 1) / 2.0 AS y FROM long) GROUP BY ALL)""",
)
CARD = (
    "card",
    """SELECT concat_ws('-', season, week, position, method) AS scorecard_key, * FROM (SELECT season, week, position, method, max(kind) AS kind, count(*) AS n,
  sum(abs(prediction - actual)) FILTER (method <> 'ecr') AS abs_error_sum, sum((prediction - actual) * (prediction - actual)) FILTER (method <> 'ecr') AS squared_error_sum,
  sum(prediction - actual) FILTER (method <> 'ecr') AS error_sum, sum(inside)::BIGINT AS inside_count FROM long GROUP BY ALL) JOIN ranks USING (season, week, position, method)""",
)
MARTS = (*FACTS[:3], SERVED)


def served(spark, sf_dir) -> dict:
    """The facts and the projections with the experts' rank and made-up places."""
    t = tables(spark, sf_dir)
    drafts, experts = frames(spark, sf_dir, "drafts", "experts")
    rows = pj.with_expert_rank(drafts, experts)
    made = {f"{k}_{f}": F.lit(v) for f in marts.FORMATS for k, v in (("pos_rank", 1), ("tier", 2), ("start_sit", "Start"))}
    return t | {"projections": rows.withColumns(made)}


@query(with_frames("SELECT scorecard_key, season, week, position, method, kind, n, abs_error_sum, squared_error_sum, error_sum, inside_count, round(spearman, 9) AS spearman FROM card", *MARTS, LONG, RANKS, CARD))
def mart_scorecard(spark, sf_dir):
    """Error sums and rank correlation of each week, position and method."""
    return marts.scorecard(served(spark, sf_dir)).withColumn("spearman", F.round("spearman", 9)).drop("mae")


@query(
    with_frames(
        """SELECT concat_ws('-', p.season, p.week, p.player_id) AS projection_key, p.season, p.week, coalesce(p.week = (SELECT min(week) FROM team_week WHERE NOT is_final AND season = last), FALSE) AS is_upcoming,
  g.is_final AS game_final, concat(CASE WHEN p.is_home THEN 'vs ' ELSE '@ ' END, p.opponent) AS matchup, coalesce(report_status, 'None') AS injury_status, ecr_rank, proj_half, 2 AS tier_half, proj_receptions,
  CASE WHEN g.is_final THEN coalesce(w.fantasy_points_half, 0) END AS actual_half, baseline_last3 FROM served p CROSS JOIN ends JOIN team_week g ON p.game_id = g.game_id AND p.team = g.team
LEFT JOIN player_week w ON p.season = w.season AND p.week = w.week AND p.player_id = w.player_id WHERE p.season = last""",
        *MARTS,
    )
)
def mart_cheat_sheet(spark, sf_dir):
    """This season's projections with the next week marked, and finished games' points."""
    rows = marts.cheat_sheet(served(spark, sf_dir))
    return rows.select("projection_key", "season", "week", "is_upcoming", "game_final", "matchup", "injury_status", "ecr_rank", "proj_half", "tier_half", "proj_receptions", "actual_half", "baseline_last3")


LOGGED = [c for c in marts.GAME_LOG if c not in ("player_week_key", "proj_ppr", "floor_ppr", "ceiling_ppr", "projection_kind")]


@query(
    with_frames(
        f"""SELECT concat_ws('-', w.season, w.week, w.player_id) AS player_week_key, {", ".join(f"w.{c}" for c in LOGGED)}, p.proj_ppr, p.floor_ppr, p.ceiling_ppr, p.kind AS projection_kind
FROM player_week w CROSS JOIN ends LEFT JOIN served p ON w.season = p.season AND w.week = p.week AND w.player_id = p.player_id WHERE w.season >= last - 1""",
        *MARTS,
    )
)
def mart_game_log(spark, sf_dir):
    """Results of two seasons with the projection of the game."""
    return marts.game_log(served(spark, sf_dir))


RESULTS = """SELECT p.season, p.week, p.player_id, p.player_name, p.position, p.team, kind, proj_ppr, floor_ppr, ceiling_ppr, baseline_last3, baseline_season_avg, ecr_rank, coalesce(w.fantasy_points_ppr, 0) AS actual_ppr,
  w.player_id IS NOT NULL AS played, proj_ppr - coalesce(w.fantasy_points_ppr, 0) AS error, coalesce(w.fantasy_points_ppr, 0) BETWEEN floor_ppr AND ceiling_ppr AS inside_range
FROM served p JOIN team_week g ON p.game_id = g.game_id AND p.team = g.team AND g.is_final LEFT JOIN player_week w ON p.season = w.season AND p.week = w.week AND p.player_id = w.player_id"""


@query(with_frames(RESULTS, *MARTS))
def full_refresh_results(spark, sf_dir):
    """Every projection of a finished game against what happened."""
    return marts.results(served(spark, sf_dir))


@query(with_frames(RESULTS, *MARTS))
def refreshed_results(spark, sf_dir):
    """Only weeks that a change touched are computed again; the same as all of them."""
    t = served(spark, sf_dir)
    stale = F.col("week") == 3
    old = marts.results(t).withColumn("error", F.when(stale, F.lit(-1.0)).otherwise(F.col("error")))
    changes = t["projections"].where(stale).select("season", "week")
    return marts.refresh_results(old, t, [changes, changes.limit(0)])


@query(
    with_frames(
        """SELECT season, week, position, any_value(kind) AS kind, count(*) AS players, sum(abs(error)) / count(*) AS mae, sum(error) / count(*) AS bias,
  sum(inside_range::INT) / count(*) AS interval_coverage, sum(abs(baseline_last3 - actual_ppr)) / count(*) AS mae_last3 FROM results
WHERE ecr_rank <= CASE position WHEN 'QB' THEN 24 WHEN 'RB' THEN 48 WHEN 'WR' THEN 72 ELSE 24 END AND baseline_last3 IS NOT NULL GROUP BY season, week, position""",
        *MARTS,
        ("results", RESULTS),
    )
)
def weekly_accuracy(spark, sf_dir):
    """Errors of the model and a baseline by week and position."""
    return marts.weekly_accuracy(marts.results(served(spark, sf_dir))).drop("rmse", "mae_season_avg")


@query(
    with_frames(
        """SELECT 'floor_projection_ceiling' AS "check", concat_ws('-', season, week, player_id) AS "row" FROM served WHERE team = 'T13' AND week = 5
UNION ALL SELECT 'unique_keys', concat_ws('-', season, week, player_id) FROM served CROSS JOIN ends WHERE season = last AND team = 'T15' AND week = 2
UNION ALL SELECT 'counts_match', concat_ws('-', season, week, position) FROM card GROUP BY season, week, position HAVING count(*) <> 4 OR count(DISTINCT n) > 1""",
        *MARTS,
        LONG,
        RANKS,
        CARD,
    )
)
def mart_checks(spark, sf_dir):
    """Rows that break an invariant: a floor above its projection in one format, and repeated keys."""
    t = served(spark, sf_dir)
    rows = t["projections"]
    last = F.broadcast(rows.agg(F.max("season").alias("__last")))
    rows = rows.withColumn("floor_std", F.when((F.col("team") == "T13") & (F.col("week") == 5), F.col("proj_std") + 0.5).otherwise(F.col("floor_std")))
    twice = rows.crossJoin(last).where((F.col("season") == F.col("__last")) & (F.col("team") == "T15") & (F.col("week") == 2)).drop("__last").withColumn("ecr_rank", F.lit(None).cast("long"))
    return marts.broken(t | {"projections": rows.unionByName(twice)})


@query(
    with_frames(
        """SELECT concat_ws('-', season::VARCHAR, position, 'model') AS metric_key, season::VARCHAR AS scope, position, 'model' AS method, 'Model' AS method_label, count(*) AS n FROM served GROUP BY season, position
UNION ALL SELECT concat_ws('-', season::VARCHAR, position, 'ecr'), season::VARCHAR, position, 'ecr', 'FantasyPros ECR', count(ecr_rank) FROM served GROUP BY season, position""",
        SERVED,
    )
)
def mart_backtest_summary(spark, sf_dir):
    """Metrics with their key and readable method names."""
    rows = served(spark, sf_dir)["projections"].groupBy(F.col("season").cast("string").alias("scope"), "position")
    one = lambda method, n: rows.agg(n.alias("n")).withColumn("method", F.lit(method))
    return marts.backtest_summary({"backtest_metrics": one("model", F.count("*")).unionByName(one("ecr", F.count("ecr_rank")))})


@query(
    with_frames(
        """SELECT concat_ws('-', season, week, team) AS key, opponent AS side FROM team_week
UNION ALL SELECT concat_ws('-', season, week, team, position), opponent FROM defense_vs_position""",
        *FACTS[:4],
    )
)
def staging_keys(spark, sf_dir):
    """Serving tables with one key column; a defense's sides are named as such."""
    t = tables(spark, sf_dir)
    teams = marts.staging("team_week", t["team_week"]).select(F.col("team_week_key").alias("key"), F.col("opponent").alias("side"))
    return teams.unionByName(marts.staging("defense_vs_position", t["defense_vs_position"]).select(F.col("defense_week_key").alias("key"), F.col("offense").alias("side")))


@query(
    with_frames(
        """SELECT season, week, player_id, round(own, 6) AS proj_own, row_number() OVER (PARTITION BY season, week, position ORDER BY round(own, 6) DESC, player_id) AS pos_rank_own FROM (
SELECT *, proj_rushing_yards * 0.5 + proj_receptions * 1.0 + (CASE WHEN position = 'TE' THEN proj_receptions * 0.5 ELSE 0 END) AS own FROM drafts)"""
    )
)
def rescored_sheet(spark, sf_dir):
    """A sheet under a league's own settings: points, then places anew."""
    off = dict.fromkeys(("pass_yd", "pass_td", "pass_int", "rush_td", "rec_yd", "rec_td", "fumble_lost", "two_pt"), 0.0)
    rows = pj.rescored(league.frame(spark, sf_dir, "drafts"), {"preset": "ppr", "rush_yd": 0.5, "te_rec_premium": 0.5} | off)
    return rows.select("season", "week", "player_id", F.round("proj_own", 6).alias("proj_own"), "pos_rank_own")


# The graph


@query(
    with_frames(
        """SELECT * FROM (SELECT 'players' AS dataset, count(*) AS n FROM players UNION ALL SELECT 'player_ids', count(DISTINCT player_id) FROM roster UNION ALL SELECT 'schedules', count(*) FROM schedules
UNION ALL SELECT 'plays', count(*) FROM plays UNION ALL SELECT 'player_stats', count(*) FROM player_stats UNION ALL SELECT 'snap_counts', count(*) FROM snap_counts UNION ALL SELECT 'rosters', count(*) FROM rosters
UNION ALL SELECT 'injuries', count(*) FROM injuries UNION ALL SELECT 'depth_charts', count(*) FROM roster UNION ALL SELECT 'ff_opportunity', count(*) FROM ff_opportunity
UNION ALL SELECT 'team_week', count(*) FROM team_week UNION ALL SELECT 'player_week', count(*) FROM player_week UNION ALL SELECT 'defense_vs_position', 4 * count(*) FROM team_week WHERE is_final
UNION ALL SELECT 'depth_chart_week', count(*) FROM roster)""",
        *FACTS[:3],
    )
)
def graph_counts(spark, sf_dir):
    """3.1: the whole graph from bronze to gold, every dataset built; rows of each (rankings, which no SQL here dates, aside)."""
    built = graph.build({name: df for name, df in league.bronze(spark, sf_dir).items()} | {})
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("dataset"), "n") for name, df in built.items() if name != "ecr"]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out

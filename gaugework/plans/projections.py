"""Published projections: rankings and tiers, live weeks frozen at kickoff, usage risers, evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugework.functions import scoring
from gaugework.operators import joins, stats, tiers
from gaugework.operators import windows as win
from gaugework.operators.asof import asof_join
from gaugework.plans.features import COMPONENTS, KEY, with_baselines
from gaugework.plans.model import FORMATS

USAGE = ("snap_share", "target_share", "carry_share", "red_zone_share", "expected_ppr")
RECENT, LEAST_EARLIER, LEAST_GAIN, LEAST_RECENT = 3, 2, 2.5, 5.0
METHODS = {"model": "proj_ppr", "last3": "baseline_last3", "season_avg": "baseline_season_avg"}


#: The published columns, in order; rankings follow them.
PUBLISHED = (
    "season week game_id kickoff_at player_id player_name position team opponent is_home implied_points team_spread total_line depth_rank report_status "
    "report_primary_injury opp_matchup_rank"
).split() + [f"proj_{x}" for x in COMPONENTS] + [f"{k}_{f}" for f in FORMATS for k in ("proj", "floor", "ceiling")] + "baseline_last3 baseline_season_avg ecr_rank kind model_version generated_at".split()


class ThinPool(RuntimeError):
    """The upcoming week has too few candidates to publish."""


def pool_size(position: Column) -> Column:
    return F.coalesce(*[F.when(position == p, F.lit(n)) for p, n in tiers.POOL.items()])


def upcoming_week(teams: DataFrame) -> DataFrame:
    """One row, season and week, of the latest season's first unfinished game; none if all are played."""
    latest = teams.agg(F.max("season").alias("season"))
    open_ = teams.where("NOT is_final").join(F.broadcast(latest), "season")
    return open_.agg(F.min(F.struct("season", "week")).alias("s")).where("s IS NOT NULL").select("s.*")


def ranked(rows: DataFrame, formats=tuple(FORMATS)) -> DataFrame:
    """Place, tier and start/sit label of each week and position, in each format."""
    group = ["season", "week", "position"]
    for f in formats:
        place = Window.partitionBy(*group).orderBy(F.desc(f"proj_{f}"), "player_id")
        rows = rows.withColumn(f"pos_rank_{f}", F.row_number().over(place).cast("long"))
        rows = rows.withColumn(f"start_sit_{f}", tiers.start_sit(F.col("position"), F.col(f"pos_rank_{f}")))
        pool = rows.where(F.col(f"pos_rank_{f}") <= pool_size(F.col("position")))
        found = tiers.add_tiers(pool.select(*group, "player_id", f"proj_{f}"), group, f"proj_{f}", "player_id", out=f"tier_{f}").drop(f"proj_{f}")
        rows = rows.join(found, [*group, "player_id"], "left")
    return rows


def published(rows: DataFrame, kind: str, version: Column | str, now: Column) -> DataFrame:
    """Model output in the published layout, without an expert rank yet."""
    rows = with_baselines(rows).withColumns({"kind": F.lit(kind), "model_version": version if isinstance(version, Column) else F.lit(version), "generated_at": now, "ecr_rank": F.lit(None).cast("long"), "is_home": F.col("is_home").cast("boolean")})
    return rows.select(*PUBLISHED)


def with_expert_rank(rows: DataFrame, ecr: DataFrame) -> DataFrame:
    """The expert rank where the player was ranked at the position that he is projected at."""
    rank = win.first_by(ecr.where("player_id IS NOT NULL").select(*KEY, F.col("position").alias("__p"), F.col("ecr_rank").cast("long").alias("__r")), KEY, "__r", "__p")
    return rows.drop("ecr_rank").join(rank, KEY, "left").withColumn("ecr_rank", F.when(F.col("__p") == F.col("position"), F.col("__r"))).drop("__p", "__r")


def frozen(stored: DataFrame | None, fresh: DataFrame, now: Column) -> DataFrame:
    """Stored rows of games that began, and fresh rows of games that did not; other weeks stay."""
    fresh = fresh.where(F.col("kickoff_at") > now)
    if stored is None:
        return fresh
    weeks = fresh.select("season", "week").distinct().withColumn("__w", F.lit(True))
    keep = stored.join(weeks, ["season", "week"], "left").where((F.col("kickoff_at") <= now) | F.col("__w").isNull()).drop("__w").select(*stored.columns)
    return joins.replaced_by(fresh, keep, KEY)


def assembled(backtest: DataFrame, live: DataFrame | None, ecr: DataFrame) -> DataFrame:
    """Live weeks from live rows alone, other weeks from the backtest; ranked."""
    rows = backtest if live is None else joins.replaced_by(backtest, live, ["season", "week"])
    return ranked(with_expert_rank(rows, ecr).select(*PUBLISHED))


def check_pool(pool: DataFrame, week: DataFrame, least: int = 8, charted: float = 0.8) -> None:
    """Raise unless each team that plays has enough candidates, most of them on a chart."""
    rows = joins.in_domain(pool.groupBy("team").agg(F.count("*").alias("n")), week, ["team"], "n")
    thin = [r["team"] for r in rows.where(F.col("n") < least).orderBy("team").collect()]  # at most 32 teams
    if thin:
        raise ThinPool(f"fewer than {least} candidates: {thin}")
    share = pool.agg(F.avg(F.col("on_depth_chart").cast("double")).alias("s")).first()["s"]
    if share is None or share < charted:
        raise ThinPool(f"only {share} of the candidates are on a chart")


def risers(facts: DataFrame, weeks: DataFrame) -> DataFrame:
    """Usage over a player's last three games before each week against earlier games, or last season's mean."""
    by, order = ["player_id", "season"], ["week"]
    sums = {}
    for m in USAGE:
        now, before = win.recent_minus_before(by, order, m, RECENT)
        sums |= {f"{m}_recent": now, f"{m}_earlier": before}
    states = facts.withColumns(sums).withColumn("games", F.row_number().over(Window.partitionBy(*by).orderBy("week")))
    states = states.select(*by, "week", "player_name", "position", "team", "games", *sums)
    targets = states.select(*by).distinct().join(F.broadcast(weeks.select("season", "week").distinct()), "season")
    rows = asof_join(targets, states, by, "week").where(F.col("games") >= RECENT).drop("right_time")
    last = facts.groupBy("player_id", (F.col("season") + 1).alias("season")).agg(*[F.avg(m).alias(f"{m}_last") for m in USAGE], F.lit(True).alias("has_last"))
    rows = rows.join(last, by, "left").withColumn("games_earlier", F.col("games") - RECENT)
    own = F.col("games_earlier") >= LEAST_EARLIER
    rows = rows.where(own | F.col("has_last"))
    for m in USAGE:
        rows = rows.withColumn(f"{m}_before", F.when(own, F.col(f"{m}_earlier")).otherwise(F.col(f"{m}_last"))).withColumn(f"{m}_change", F.col(f"{m}_recent") - F.col(f"{m}_before"))
    gain = F.coalesce((F.col("expected_ppr_change") >= LEAST_GAIN) & (F.col("expected_ppr_recent") >= LEAST_RECENT), F.lit(False))
    place = Window.partitionBy("season", "week").orderBy(F.desc_nulls_last(F.round("expected_ppr_change", 9)), "player_id")
    return rows.select(
        F.col("season").cast("long").alias("season"), F.col("week").cast("long").alias("week"), "player_id", "player_name", "position", "team", F.lit(RECENT).cast("long").alias("games_recent"),
        F.col("games_earlier").cast("long").alias("games_earlier"), F.when(own, "earlier games this season").otherwise("last season").alias("baseline_basis"),
        *[F.col(f"{m}_{p}") for m in USAGE for p in ("recent", "before", "change")], gain.alias("is_riser"), F.row_number().over(place).cast("long").alias("riser_rank"),
    )


def evaluation_pool(projected: DataFrame, ecr: DataFrame) -> DataFrame:
    """Rows in the experts' first N of their position that have a value by every method."""
    ranks = win.first_by(ecr.where("player_id IS NOT NULL").select(*KEY, F.col("position").alias("ecr_position"), "ecr", F.col("ecr_rank").alias("__rank")), KEY, "__rank", "ecr_position")
    rows = projected.drop("ecr", "ecr_rank").join(ranks, KEY).withColumnRenamed("__rank", "ecr_rank")
    rows = rows.where((F.col("ecr_position") == F.col("position")) & (F.col("ecr_rank") <= pool_size(F.col("position"))))
    return rows.dropna(subset=[*METHODS.values(), "ecr", "fantasy_points_ppr"])


def _by_method(pool: DataFrame, ecr_value: Column) -> DataFrame:
    """Pool rows once for each method, in one scan."""
    inside = F.col("fantasy_points_ppr").between(F.col("floor_ppr"), F.col("ceiling_ppr"))
    entries = [F.struct(F.lit(m).alias("method"), F.col(v).cast("double").alias("prediction"), (inside if m == "model" else F.lit(None)).cast("int").alias("inside")) for m, v in METHODS.items()]
    entries.append(F.struct(F.lit("ecr").alias("method"), ecr_value.cast("double").alias("prediction"), F.lit(None).cast("int").alias("inside")))
    return pool.select("season", "week", "position", "player_id", F.col("fantasy_points_ppr").alias("actual"), F.explode(F.array(*entries)).alias("m")).select("season", "week", "position", "player_id", "actual", "m.*")


def evaluate(projected: DataFrame, ecr: DataFrame, seasons: list[int]) -> DataFrame:
    """Metrics of each season, and of all together, by position and method; rank correlation is a mean over weeks."""
    pooled = f"{min(seasons)}-{max(seasons)}"
    sets = [F.col("season").cast("string")] + [F.lit(pooled)] * (len(set(seasons)) > 1)
    scoped = lambda df: df.withColumn("scope", F.explode(F.array(*sets)))
    pool = evaluation_pool(projected.where(F.col("season").isin(*seasons)), ecr)
    rows = _by_method(pool, -F.col("ecr"))
    weekly = stats.spearman(rows, ["season", "week", "position", "method"], "prediction", "actual")
    ranks = scoped(weekly).groupBy("scope", "position", "method").agg(F.avg("spearman").alias("spearman"), F.count("spearman").alias("weeks"))
    e = F.when(F.col("method") != "ecr", F.col("prediction") - F.col("actual"))
    errors = scoped(rows).groupBy("scope", "position", "method").agg(
        F.count("*").alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"), F.avg("inside").alias("interval_coverage")
    )
    weeks = projected.where(F.col("season").isin(*seasons)).select("season", "week").distinct()
    top = ecr.where((F.col("player_id").isNotNull()) & (F.col("ecr_rank") <= pool_size(F.col("position")))).join(weeks, ["season", "week"], "left_semi")
    found = scoped(joins.flagged(top, projected, KEY, "found")).groupBy("scope", "position").agg(F.avg(F.col("found").cast("double")).alias("pool_coverage"))
    out = errors.join(ranks, ["scope", "position", "method"], "left").join(found, ["scope", "position"], "left")
    return out.select("scope", "position", "method", "n", "weeks", "mae", "rmse", "bias", "spearman", "interval_coverage", "pool_coverage").orderBy("scope", "position", "method")


def intervals(projected: DataFrame, ecr: DataFrame, seasons: list[int], resamples: int = 10_000, seed: int = 0) -> DataFrame:
    """Bootstrap intervals of the model's error against each baseline, over weeks."""
    pool = evaluation_pool(projected.where(F.col("season").isin(*seasons)), ecr)
    err = lambda v: F.sum(F.abs(F.col(v).cast("double") - F.col("fantasy_points_ppr")))
    out = None
    for name, column in METHODS.items():
        if name == "model":
            continue
        sums = pool.groupBy("position", "season", "week").agg(err("proj_ppr").alias("a"), err(column).alias("b"), F.count("*").alias("n")).withColumn("comparison", F.lit(f"mae_model_minus_{name}"))
        part = stats.paired_bootstrap(sums, ["position", "comparison"], "a", "b", "n", resamples, seed)
        out = part if out is None else out.unionByName(part)
    return out


def coverage(pool: DataFrame, facts: DataFrame, least: float = 10.0) -> DataFrame:
    """Share of player-games that were candidates: of all, and of those with at least that many points."""
    played = facts.select(*KEY, "fantasy_points_ppr").join(pool.select("season", "week").distinct(), ["season", "week"], "left_semi")
    rows = joins.flagged(played, pool, KEY, "found")
    return rows.agg(F.count("*").alias("player_games"), F.avg(F.col("found").cast("double")).alias("share_all"), F.avg(F.when(F.col("fantasy_points_ppr") >= least, F.col("found").cast("double"))).alias("share_large"))


def rescored(rows: DataFrame, settings) -> DataFrame:
    """A week's sheet under a league's own settings: points, band scaled with them, place and tier anew."""
    named = {s: F.col(f"proj_{s}") for s in scoring.PRICED if f"proj_{s}" in rows.columns}
    own = scoring.points(settings, position=F.col("position"), stats=named)
    rows = rows.withColumn("proj_own", own)
    ratio = F.coalesce(joins.safe_share(F.col("proj_own"), F.col("proj_ppr")), F.lit(1.0))
    rows = rows.withColumns({"floor_own": F.least(F.col("floor_ppr") * ratio, F.col("proj_own")), "ceiling_own": F.greatest(F.col("ceiling_ppr") * ratio, F.col("proj_own"))})
    return ranked(rows, ("own",))

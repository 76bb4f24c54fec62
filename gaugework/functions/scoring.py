"""Points of a stat line under league settings, as a column and as a registered function."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the scoring contract: each stat and the setting that prices a unit of it.
PRICED = {
    "passing_yards": "pass_yd",
    "passing_tds": "pass_td",
    "passing_interceptions": "pass_int",
    "rushing_yards": "rush_yd",
    "rushing_tds": "rush_td",
    "receptions": "rec",
    "receiving_yards": "rec_yd",
    "receiving_tds": "rec_td",
    "fumbles_lost": "fumble_lost",
    "two_point_conversions": "two_pt",
    "special_teams_tds": "st_td",
}
#: Bonuses are paid in full from that many yards on.
BONUS = {
    "bonus_pass_300": ("passing_yards", 300),
    "bonus_pass_400": ("passing_yards", 400),
    "bonus_rush_100": ("rushing_yards", 100),
    "bonus_rush_200": ("rushing_yards", 200),
    "bonus_rec_100": ("receiving_yards", 100),
    "bonus_rec_200": ("receiving_yards", 200),
}
PREMIUM = "te_rec_premium"
BASE = {
    "pass_yd": 0.04, "pass_td": 4.0, "pass_int": -2.0, "rush_yd": 0.1, "rush_td": 6.0, "rec": 0.0, "rec_yd": 0.1, "rec_td": 6.0,
    "fumble_lost": -2.0, "two_pt": 2.0, "st_td": 6.0, PREMIUM: 0.0,
} | dict.fromkeys(BONUS, 0.0)
RECEPTION = {"standard": 0.0, "half": 0.5, "ppr": 1.0}


class UnknownSetting(ValueError):
    pass


def settings_of(scoring: Mapping | str | None = None) -> dict[str, float]:
    """All settings from a preset's name, or from overrides of a preset (ppr if none is named)."""
    chosen = {"preset": scoring} if isinstance(scoring, str) else dict(scoring or {})
    preset = str(chosen.pop("preset", None) or "ppr").lower()
    if preset not in RECEPTION:
        raise UnknownSetting(f"preset {preset!r} is none of {sorted(RECEPTION)}")
    if wrong := sorted(set(chosen) - set(BASE)):
        raise UnknownSetting(f"no such settings: {wrong}")
    return BASE | {"rec": RECEPTION[preset]} | {k: float(v) for k, v in chosen.items() if v is not None}


def points(scoring: Mapping | str | None = None, position: Column | None = None, stats: Mapping[str, Column] | None = None) -> Column:
    """Points as an expression over stat columns; missing values count as zero. Stays in generated code."""
    priced = settings_of(scoring)
    stat = lambda n: F.coalesce(F.nanvl((stats or {}).get(n, F.col(n) if stats is None else F.lit(None)).cast("double"), F.lit(0.0)), F.lit(0.0))
    total = F.lit(0.0)
    for name, setting in PRICED.items():
        if priced[setting]:
            total = total + stat(name) * F.lit(priced[setting])
    for setting, (name, yards) in BONUS.items():
        if priced[setting]:
            total = total + F.when(stat(name) >= yards, F.lit(priced[setting])).otherwise(F.lit(0.0))
    if position is not None and priced[PREMIUM]:
        total = total + F.when(position == "TE", stat("receptions") * F.lit(priced[PREMIUM])).otherwise(F.lit(0.0))
    return total


def points_of_map(stats: Column, scoring: Column) -> Column:
    """Points from two maps, the stats of a row and its own settings, as an expression; null if either is null."""
    known = F.array(*map(F.lit, BASE))
    wrong = F.array_except(F.map_keys(scoring), known)
    price = lambda s: F.coalesce(F.try_element_at(scoring, F.lit(s)), F.lit(BASE[s] if s != "rec" else RECEPTION["ppr"]))
    stat = lambda n: F.coalesce(F.nanvl(F.try_element_at(stats, F.lit(n)), F.lit(0.0)), F.lit(0.0))
    total = F.lit(0.0)
    for name, setting in PRICED.items():
        total = total + stat(name) * price(setting)
    for setting, (name, yards) in BONUS.items():
        total = total + F.when(stat(name) >= yards, price(setting)).otherwise(F.lit(0.0))
    checked = F.when(F.size(wrong) > 0, F.raise_error(F.concat(F.lit("no such settings: "), F.array_join(wrong, ", ")))).otherwise(F.lit(0.0))
    return F.when(stats.isNotNull() & scoring.isNotNull(), F.bround(total + checked.cast("double"), 4))


def register(spark: SparkSession, name: str = "fantasy_points") -> None:
    """A SQL function of two maps of doubles, by name, in terms of built-in functions only; as points_of_map."""
    default = BASE | {"rec": RECEPTION["ppr"]}
    price = lambda k: f"coalesce(try_element_at(scoring, '{k}'), {default[k]}D)"
    stat = lambda n: f"coalesce(nanvl(try_element_at(stats, '{n}'), 0D), 0D)"
    terms = [f"{stat(n)} * {price(k)}" for n, k in PRICED.items()]
    terms += [f"CASE WHEN {stat(n)} >= {yards} THEN {price(k)} ELSE 0D END" for k, (n, yards) in BONUS.items()]
    wrong = f"array_except(map_keys(scoring), array({', '.join(repr(k) for k in BASE)}))"
    terms.append(f"CASE WHEN size({wrong}) > 0 THEN CAST(raise_error(concat('no such settings: ', array_join({wrong}, ', '))) AS DOUBLE) ELSE 0D END")
    body = f"CASE WHEN stats IS NOT NULL AND scoring IS NOT NULL THEN bround({' + '.join(terms)}, 4) END"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(stats MAP<STRING, DOUBLE>, scoring MAP<STRING, DOUBLE>) RETURNS DOUBLE RETURN {body}")

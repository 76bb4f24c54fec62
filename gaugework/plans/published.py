"""The published datasets that a landing zone takes, as declared sources.

Fixed values: addresses, file stems, kept columns and kinds must be as their
publishers have them.
"""

from __future__ import annotations

from gaugework.plans.contracts import POSITIONS
from gaugework.sources.landing import History, Source

RELEASES = "https://github.com/nflverse/nflverse-data/releases/download"
EXPECTED = "https://github.com/ffverse/ffopportunity/releases/download/latest-data"
RANKINGS = "https://github.com/dynastyprocess/data/raw/master/files"

WEEKLY_RANKINGS = History(
    keep="ecr_type = 'wp' AND pos IN ({})".format(", ".join(f"'{p}'" for p in POSITIONS)),
    day="scrape_date",
    order=("scrape_date", "fp_page", "id"),
    columns=("fp_page", "page_type", "ecr_type", "player", "id", "pos", "team", "ecr", "sd", "best", "worst", "scrape_date"),
)

SOURCES = (
    # Plays are read by contract, and none of the contract's columns changes its type.
    Source("pbp", f"{RELEASES}/pbp/play_by_play_{{season}}.parquet", "play_by_play", widen=False),
    Source("player_stats", f"{RELEASES}/stats_player/stats_player_week_{{season}}.parquet", "stats_player_week"),
    Source("snap_counts", f"{RELEASES}/snap_counts/snap_counts_{{season}}.parquet", "snap_counts"),
    Source("rosters", f"{RELEASES}/weekly_rosters/roster_weekly_{{season}}.parquet", "roster_weekly"),
    Source("injuries", f"{RELEASES}/injuries/injuries_{{season}}.parquet", "injuries"),
    Source("depth_charts", f"{RELEASES}/depth_charts/depth_charts_{{season}}.parquet", "depth_charts"),
    Source("ff_opportunity", f"{EXPECTED}/ep_weekly_{{season}}.parquet", "ep_weekly"),
    Source("schedules", f"{RELEASES}/schedules/games.parquet", "games"),
    Source("players", f"{RELEASES}/players/players.parquet", "players"),
    Source("player_ids", f"{RANKINGS}/db_playerids.csv", "db_playerids", format="csv", required=False),
    Source("ecr", f"{RANKINGS}/db_fpecr.parquet", "fp_ecr_weekly", required=False, history=WEEKLY_RANKINGS),
)

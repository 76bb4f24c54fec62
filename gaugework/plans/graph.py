"""The declared graph of datasets and its runner: lazy, each dataset built once, cached only where it fans out."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame

from gaugework import quality
from gaugework.plans import contracts as c
from gaugework.plans import datasets as d

#: Bronze names of landed datasets; play-by-play has a name of its own.
LANDED = ("pbp", "player_stats", "snap_counts", "rosters", "injuries", "depth_charts", "ff_opportunity", "schedules", "players", "player_ids", "ecr")


@dataclass(frozen=True)
class Node:
    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    layer: str


def _node(layer: str, name: str, build: Callable[..., DataFrame], *inputs: str) -> Node:
    return Node(name, inputs, build, layer)


def bronze_name(dataset: str) -> str:
    return "bronze_plays" if dataset == "pbp" else f"bronze_{dataset}"


GRAPH = {
    n.name: n
    for n in (
        _node("silver", "players", partial(d.silver, "players"), "bronze_players"),
        _node("silver", "player_ids", d.player_ids, "bronze_player_ids"),
        _node("silver", "schedules", d.schedules, "bronze_schedules"),
        _node("silver", "plays", d.plays, "bronze_plays"),
        _node("silver", "player_stats", partial(d.silver, "player_stats"), "bronze_player_stats"),
        _node("silver", "snap_counts", d.snap_counts, "bronze_snap_counts", "players"),
        _node("silver", "rosters", partial(d.silver, "rosters"), "bronze_rosters"),
        _node("silver", "injuries", partial(d.silver, "injuries"), "bronze_injuries"),
        _node("silver", "depth_charts", d.depth_charts, "bronze_depth_charts"),
        _node("silver", "ff_opportunity", partial(d.silver, "ff_opportunity"), "bronze_ff_opportunity"),
        _node("silver", "ecr", d.ecr, "bronze_ecr", "schedules", "player_ids"),
        _node("gold", "team_week", d.team_week, "schedules", "plays", "player_stats"),
        _node("gold", "player_week", d.player_week, "player_stats", "snap_counts", "plays", "team_week", "ff_opportunity"),
        _node("gold", "defense_vs_position", d.defense_vs_position, "player_week", "team_week"),
        _node("gold", "depth_chart_week", d.depth_chart_week, "depth_charts", "schedules"),
    )
}


def order(graph: Mapping[str, Node] = GRAPH) -> list[str]:
    """Names so that inputs come first."""
    out: list[str] = []

    def visit(name: str, path: tuple[str, ...] = ()) -> None:
        if name in path:
            raise ValueError(f"{name} needs itself")
        if name in graph and name not in out:
            for i in graph[name].inputs:
                visit(i, (*path, name))
            out.append(name)

    for name in graph:
        visit(name)
    return out


def build(bronze: Mapping[str, DataFrame], graph: Mapping[str, Node] = GRAPH, cache: bool = False) -> dict[str, DataFrame]:
    """All datasets, lazily. Rows that fail a drop rule never reach another dataset."""
    uses = [i for n in graph.values() for i in n.inputs]
    built: dict[str, DataFrame] = dict(bronze)
    for name in order(graph):
        node = graph[name]
        df = quality.keep_valid(node.build(*[built[i] for i in node.inputs]), c.DROP.get(name, {}))
        built[name] = df.cache() if cache and uses.count(name) > 1 else df
    return {name: built[name] for name in order(graph)}


def warnings(datasets: Mapping[str, DataFrame]) -> dict[str, dict[str, int]]:
    """Failures of the warn rules of each dataset."""
    return {n: quality.failure_counts(datasets[n], rules).first().asDict() for n, rules in c.WARN.items() if n in datasets}

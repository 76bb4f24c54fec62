import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugework import contract, quality
from gaugework.functions import scoring, search
from gaugework.operators import change, joins, stats, tiers
from gaugework.operators import windows as win
from gaugework.operators.asof import asof_join


@pytest.mark.parametrize("inclusive", [False, True])
@pytest.mark.parametrize("sliced", [False, True])
def test_asof_equals_pandas_with_ties_and_nulls(spark, inclusive, sliced):
    rng = np.random.default_rng(7)
    left = pd.DataFrame({"k": rng.integers(0, 5, 200), "t": rng.integers(0, 60, 200), "i": range(200)})
    right = pd.DataFrame({"k": rng.integers(0, 5, 120), "t": rng.integers(0, 60, 120), "v": rng.normal(size=120)}).drop_duplicates(["k", "t"])
    right.loc[right.index[::4], "v"] = np.nan
    want = pd.merge_asof(left.sort_values("t"), right.assign(rt=right.t).sort_values("t"), on="t", by="k", allow_exact_matches=inclusive).set_index("i")
    r = spark.createDataFrame(right).withColumn("v", F.nanvl("v", F.lit(None)))
    out = asof_join(spark.createDataFrame(left), r, ["k"], "t", inclusive=inclusive, slice_of=(lambda t: F.floor(t / 10)) if sliced else None)
    got = {x["i"]: (x["v"], x["right_time"]) for x in out.collect()}
    assert len(got) == 200
    for i, row in want.iterrows():
        v, t = got[i]
        assert (t is None) == np.isnan(row.rt) and (t is None or t == row.rt)
        assert (v is None and np.isnan(row.v)) or v == row.v


def test_asof_null_keys_do_not_match_and_empty_right(spark):
    left = spark.createDataFrame([(None, 5), (1, 5)], "k int, t int")
    right = spark.createDataFrame([(None, 1, 9), (1, 1, 8)], "k int, t int, v int")
    assert sorted((r["k"] or 0, r["v"]) for r in asof_join(left, right, ["k"], "t").collect()) == [(0, None), (1, 8)]
    assert asof_join(left, right.limit(0), ["k"], "t").where("v IS NOT NULL").count() == 0


@pytest.mark.parametrize("halflife", [0.5, 3.0])
def test_ewm_equals_pandas_also_beyond_one_block(spark, halflife, monkeypatch):
    monkeypatch.setattr(win, "BLOCK_HALVES", 60)
    rng = np.random.default_rng(1)
    df = pd.DataFrame({"g": np.repeat([0, 1], 300), "n": np.tile(range(300), 2), "v": rng.normal(size=600)})
    df.loc[rng.random(600) < 0.25, "v"] = np.nan
    want = df.groupby("g")["v"].ewm(halflife=halflife).mean().reset_index(level=0, drop=True)
    rows = spark.createDataFrame(df).withColumn("v", F.nanvl("v", F.lit(None)))
    got = win.ewm_mean(rows, ["g"], ["n"], ["v"], halflife).orderBy("g", "n").toPandas()["v_ewm"]
    np.testing.assert_allclose(got.astype(float), want.to_numpy(), rtol=1e-9, equal_nan=True)


def test_rolling_equals_a_plain_loop(spark):
    values = [3.0, None, 5.0, 1.0, None, None, 2.0, 8.0]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "g string, n int, v double")
    got = [r["m"] for r in df.select("n", win.rolling_mean(["g"], ["n"], "v", 3, 1).alias("m")).orderBy("n").collect()]
    for i, g in enumerate(got):
        prior = [v for v in values[max(0, i - 3) : i] if v is not None]
        assert g == (pytest.approx(sum(prior) / len(prior)) if prior else None)


def test_spearman_equals_pandas_and_is_null_for_constants(spark):
    rng = np.random.default_rng(3)
    df = pd.DataFrame({"g": np.repeat([0, 1, 2], [30, 30, 4]), "x": rng.integers(0, 8, 64), "y": rng.normal(size=64)})
    df.loc[df.g == 1, "y"] = 2.0
    got = {r["g"]: r["spearman"] for r in stats.spearman(spark.createDataFrame(df), ["g"], "x", "y").collect()}
    a = df[df.g == 0]
    assert got[0] == pytest.approx(a.x.rank().corr(a.y.rank()))
    assert got[1] is None and got[2] is None


def test_bootstrap_is_zero_for_equal_methods_and_repeats(spark):
    rows = spark.createDataFrame([("QB", w, float(w), float(w), 3) for w in range(10)] + [("RB", w, float(w), w / 2, 3) for w in range(10)], "p string, w int, a double, b double, n int")
    one = {r["p"]: r for r in stats.paired_bootstrap(rows, ["p"], "a", "b", "n", 500).collect()}
    two = {r["p"]: r for r in stats.paired_bootstrap(rows, ["p"], "a", "b", "n", 500).collect()}
    assert one["QB"]["low"] == one["QB"]["high"] == one["QB"]["gap"] == 0
    assert one == two and one["RB"]["low"] < one["RB"]["gap"] < one["RB"]["high"]


def test_interpolation_equals_numpy(spark):
    knots = spark.createDataFrame([(1, 0.0, 1.0), (1, 2.0, 5.0), (1, 4.0, 6.0)], "g int, x double, y double")
    at = [-1.0, 0.0, 0.5, 2.0, 3.0, 9.0]
    got = stats.interpolated(spark.createDataFrame([(1, a) for a in at], "g int, a double"), knots, ["g"], "a", "x", ["y"]).orderBy("a")
    assert [r["y"] for r in got.collect()] == pytest.approx(list(np.interp(at, [0, 2, 4], [1, 5, 6])))


def test_scopes_pool_all(spark):
    df = spark.createDataFrame([(2023, "a", 1), (2024, "a", 2), (2024, "b", 3)], "s int, k string, v int")
    out = {(r["s"], r["k"]): r["t"] for r in stats.scoped(df, "s", ["k"], [F.sum("v").alias("t")]).collect()}
    assert out == {("2023", "a"): 1, ("2024", "a"): 2, ("2024", "b"): 3, ("all", "a"): 3, ("all", "b"): 3}


def brute_tiers(values, explained=0.9, most=10):
    from itertools import combinations

    x = sorted(values, reverse=True)
    n, total = len(x), sum((v - sum(x) / len(x)) ** 2 for v in x)
    sse = lambda g: sum((v - sum(g) / len(g)) ** 2 for v in g)
    for k in range(1, min(most, n) + 1):
        best = min((sum(sse(x[a:b]) for a, b in zip((0, *c), (*c, n))), c) for c in combinations(range(1, n), k - 1))
        if total == 0 or 1 - best[0] / total >= explained:
            return best[0]


@pytest.mark.parametrize("seed", range(8))
def test_tiers_are_optimal(seed):
    rng = np.random.default_rng(seed)
    values = np.round(rng.normal(size=9) * 10, 1).tolist()
    got = tiers.tier_numbers(values)
    groups = {t: [v for v, x in zip(values, got) if x == t] for t in set(got)}
    assert sum(sum((v - sum(g) / len(g)) ** 2 for v in g) for g in groups.values()) == pytest.approx(brute_tiers(values), abs=1e-6)
    order = [t for _, t in sorted(zip(values, got), key=lambda p: -p[0])]
    assert order == sorted(order)


def test_tiers_edge_cases(spark):
    assert tiers.tier_numbers([]) == [] and tiers.tier_numbers([5, 5, 5]) == [1, 1, 1]
    labels = spark.createDataFrame([("RB", r) for r in (24, 25, 36, 37)], "p string, r int").select(tiers.start_sit(F.col("p"), F.col("r")).alias("l"))
    assert [r["l"] for r in labels.collect()] == ["Start", "Flex", "Flex", "Sit"]


def test_diff_and_merge(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, None, 1), (3, "c", 1)], "k int, v string, g int")
    new = spark.createDataFrame([(1, "a", 2), (2, "b", 2), (4, None, 2)], "k int, v string, g int")
    assert {r["k"]: r["change"] for r in change.diff(old, new, ["k"], ["g"]).collect()} == {1: "same", 2: "update", 3: "delete", 4: "insert"}
    assert sorted(tuple(r) for r in change.merged(old, new, ["k"], ["g"]).collect()) == [(1, "a", 1), (2, "b", 2), (4, None, 2)]
    with pytest.raises(change.ShrinkError):
        change.shrink_guard(old, new.where("k = 1"), ["k"])
    with pytest.raises(change.ShrinkError):
        change.shrink_guard(old, new.limit(0), ["k"])
    change.shrink_guard(old, new.limit(0), ["k"], may_be_empty=True)


def test_fingerprint_ignores_order_and_sees_changes(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    one = lambda df, *s: df.agg(change.fingerprint(df, *s).alias("f")).first()["f"]
    assert one(a) == one(a.orderBy(F.desc("k"))) != one(a.where("k = 1"))
    assert one(a) != one(a, "other")


def test_contract(spark):
    df = spark.createDataFrame([("28013.0", " NA "), ("x", ""), (None, " a1 ")], "n string, i string")
    out = contract.typed_select(df, {"n": "int"}, contract.clean_id("i")).collect()
    assert [tuple(r) for r in out] == [(28013, None), (None, None), (None, "a1")]
    ddl = contract.create_table_ddl("t", df.schema, ["n"])
    assert "PRIMARY KEY (n)" in ddl and not contract.stale(ddl, "t", df.schema, ["n"]) and contract.stale(ddl, "t", df.schema)
    assert contract.widened(spark.range(1)).schema[0].dataType.simpleString() == "double"
    with pytest.raises(TypeError):
        contract.served_type(spark.createDataFrame([([1],)], "a array<int>").schema[0].dataType)


def test_code_map_keeps_unknown_and_null(spark):
    df = spark.createDataFrame([("OAK",), ("GB",), (None,)], "t string")
    assert [r[0] for r in df.select(contract.mapped(F.col("t"), {"OAK": "LV"})).collect()] == ["LV", "GB", None]


def test_rules(spark):
    df = spark.createDataFrame([("José O'Neil-Smith Jr.",), ("Kenneth Murray, Jr.",), (None,)], "n string")
    assert [r[0] for r in df.select(quality.plain_name(F.col("n"))).collect()] == [True, False, False]
    seen, obs = quality.observed(df, {"named": "n IS NOT NULL"}, "rules")
    seen.collect()
    assert obs.get == {"named": 1}


def test_points(spark):
    df = spark.createDataFrame([(6, 80, 1)], "receptions int, receiving_yards int, receiving_tds int")
    named = {c: F.col(c) for c in df.columns}
    got = df.select(*[scoring.points(p, stats=named).alias(p) for p in ("ppr", "half", "standard")]).first()
    assert tuple(got) == pytest.approx((20, 17, 14))
    with pytest.raises(scoring.UnknownSetting):
        scoring.settings_of({"pass_yds": 1})
    assert scoring.settings_of({"preset": "half", "pass_td": 6})["rec"] == 0.5


def test_points_function_of_maps(spark):
    scoring.register(spark)
    row = spark.sql("SELECT fantasy_points(map('rushing_yards', 100D, 'receptions', 2D), map('rec', 0.5D)) AS a, fantasy_points(NULL, map('rec', 1D)) AS b").first()
    assert row["a"] == pytest.approx(11.0) and row["b"] is None
    with pytest.raises(Exception, match="no such settings"):
        spark.sql("SELECT fantasy_points(map('receptions', 2D), map('recs', 0.5D)) AS a").collect()


NAMES = [
    ("1", "Christian McCaffrey", "RB", "SF"), ("2", "Amon-Ra St. Brown", "WR", "DET"), ("3", "Jaxon Smith-Njigba", "WR", "SEA"), ("4", "Kenneth Walker III", "RB", "SEA"),
    ("5", "Jared Goff", "QB", "DET"), ("6", "Dallas Goedert", "TE", "PHI"), ("7", "Dak Prescott", "QB", "DAL"), ("8", "José Núñez", "TE", "JAX"), ("9", "A.J. Brown", "WR", "PHI"),
]


@pytest.mark.parametrize(
    ("query", "first", "reason"),
    [("cmc", "1", "nickname"), ("arsb", "2", "initials"), ("kw3", "4", "initials"), ("mccaffery", "1", "close spelling"), ("jose nunez", "8", "exact"), ("lions wr", "2", "team / position"),
     ("jax", "3", "prefix"), ("dallas goedert", "6", "exact"), ("offic", None, None), ("ajb", "9", "initials"), ("smith", "3", "prefix")],
)
def test_search(spark, query, first, reason):
    names = spark.createDataFrame(NAMES, "player_id string, player_name string, position string, team string")
    found = search.search(names, query, limit=3).collect()
    assert (found[0]["player_id"], found[0]["reason"]) == (first, reason) if first else not found


def test_did_you_mean(spark):
    names = spark.createDataFrame(NAMES, "player_id string, player_name string, position string, team string")
    assert search.did_you_mean(names, "jarred gof") == "Jared Goff" and search.did_you_mean(names, "zzzz") is None


def test_first_after_is_strict(spark):
    marks = spark.createDataFrame([(1, 10, 1), (1, 17, 2)], "s int, m int, w int")
    points = spark.createDataFrame([(1, 8), (1, 10), (1, 17), (1, 8)], "s int, d int")
    assert sorted(tuple(r) for r in joins.first_after(points, marks, ["s"], "d", "m", "w", "week").collect()) == [(1, 8, 1), (1, 10, 2)]


def test_scratch_deletes_what_was_made_inside(spark, tmp_path):
    from pathlib import Path

    from gaugework import session

    with session.scratch(spark):
        inside = session.work_dir(spark, "x")
        spark.range(3).write.parquet(inside)
        assert spark.read.parquet(inside).count() == 3
    outside = session.work_dir(spark, "y")
    spark.range(3).write.parquet(outside)
    assert not Path(inside.removeprefix("file://")).exists() and spark.read.parquet(outside).count() == 3


def test_quantiles_equal_numpy(spark):
    import numpy as np

    from gaugework.operators import stats

    rng = np.random.default_rng(3)
    rows = [("a", float(x)) for x in rng.normal(0, 50, 700).round(1)] + [("b", 7.0)] * 5 + [("c", None), ("d", 1.5)] + [(None, float(k)) for k in range(9)]
    at = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["k"]: r["quantiles"] for r in stats.quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", at).collect()}
    for key in ("a", "b", "d", None):
        assert np.allclose(got[key], np.quantile([v for k, v in rows if k == key and v is not None], at))
    assert "c" not in got


def test_bootstrap_query_equals_plain_numpy(spark):
    import numpy as np

    from gaugework.plans import catalog

    sf = "/root/testdata/sf0.001"
    got = {r["o_orderpriority"]: r for r in catalog.QUERIES["bootstrap"](spark, sf).collect()}
    orders = spark.read.parquet(f"{sf}/orders.parquet").selectExpr("o_orderpriority p", "weekofyear(o_orderdate) w", "o_totalprice / 1000 a", "o_custkey / 10.0 b").toPandas().astype({"a": float, "b": float})
    for p, rows in orders.groupby("p"):
        weeks = rows.groupby("w").agg(a=("a", "sum"), b=("b", "sum"), n=("a", "size")).sort_index()
        rng = np.random.default_rng(0)
        draws = rng.multinomial(len(weeks), np.full(len(weeks), 1 / len(weeks)), size=10_000)
        gaps = np.array([((weeks.a - weeks.b) * d).sum() / (weeks.n * d).sum() for d in draws])
        want = ((weeks.a - weeks.b).sum() / weeks.n.sum(), *np.percentile(gaps, [2.5, 97.5]))
        assert np.allclose([got[p]["gap"], got[p]["low"], got[p]["high"]], want) and got[p]["clusters"] == len(weeks)


def test_tier_query_equals_best_split(spark):
    """The fewest contiguous tiers, by trying every split, whose spread explains nine tenths."""
    import itertools

    import numpy as np

    from gaugework.plans import catalog

    rows = catalog.QUERIES["tier_groups"](spark, "/root/testdata/sf0.001").toPandas()
    spread = lambda v: float(((v - v.mean()) ** 2).sum())
    for _, g in rows.groupby("o_orderpriority"):
        g = g.sort_values("rank")
        v = g["o_totalprice"].astype(float).to_numpy()
        for k in range(1, 5):
            best = min(itertools.combinations(range(1, len(v)), k - 1), key=lambda cut: sum(spread(x) for x in np.split(v, cut)))
            if 1 - sum(spread(x) for x in np.split(v, best)) / spread(v) >= 0.9:
                assert [len(x) for x in np.split(v, best)] == g.groupby("tier").size().tolist()
                break
        assert set(g["label"]) <= {"Start", "Flex", "Sit"}

import io
import urllib.error
from datetime import date

import pytest
from pyspark.sql import functions as F

from gaugework.operators.change import ShrinkError
from gaugework.sources import landing, serving
from gaugework.streaming import bronze


def published(spark, tmp_path, rows, schema="season int, v int"):
    out = str(tmp_path / f"pub{len(list(tmp_path.iterdir()))}")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(out)
    return next((tmp_path / out.rsplit("/", 1)[1]).glob("part-*")).read_bytes()


def http(code):
    return urllib.error.HTTPError("u", code, "", None, None)


def test_retries_server_errors_only():
    calls, waits = [], []

    def flaky(url):
        calls.append(url)
        if len(calls) < 3:
            raise http(503)
        return "ok"

    assert landing.open_url("u", opener=flaky, sleep=waits.append) == "ok" and waits == [5.0, 10.0]
    calls.clear()

    def gone(url):
        calls.append(url)
        raise http(404)

    with pytest.raises(urllib.error.HTTPError):
        landing.open_url("u", opener=gone, sleep=waits.append)
    assert len(calls) == 1


def test_seasons_of_a_day():
    assert [landing.filing_season(date(2025, m, 1)) for m in (2, 3, 9)] == [2024, 2025, 2025]
    assert [landing.refresh_season(date(2025, m, 1)) for m in (2, 3, 9)] == [2024, 2024, 2025]


def test_ingest_writes_new_content_only_and_latest_wins(spark, tmp_path):
    body = {2024: published(spark, tmp_path, [(2024, 1), (2024, 2)]), 2025: published(spark, tmp_path, [(2025, 1)])}
    wrong = {}

    def fetch(url):
        season = int(url[-4:])
        if season in wrong:
            raise http(wrong[season])
        return io.BytesIO(body[season])

    zone = landing.Landing(spark, tmp_path / "landing", fetch)
    source = landing.Source("stats", "u/{season}", "stats")
    actions = lambda: {r.season: r.action for r in zone.ingest([source], [2024, 2025], 2025)}
    assert actions() == {2024: "written", 2025: "written"}
    assert actions() == {2024: "skipped", 2025: "unchanged"}
    body[2025] = published(spark, tmp_path, [(2025, 7), (2025, 8)])
    assert actions() == {2024: "skipped", 2025: "written"}
    wrong[2025] = 404
    assert actions()[2025] == "not_published"
    wrong[2025] = 500
    with pytest.raises(urllib.error.HTTPError):
        actions()
    optional = landing.Source("stats", "u/{season}", "stats", required=False)
    assert zone.ingest([optional], [2025], 2025)[-1].action == "failed"
    raw = landing.read_landing(spark, str(tmp_path / "landing"), ["stats"])["stats"]
    assert raw.count() == 5 and dict(raw.dtypes)["v"] == "double"
    for window in (False, True):
        rows = landing.latest_landed(raw, window).select(landing.PART, "v").collect()
        assert sorted(tuple(r) for r in rows) == [("2024", 1.0), ("2024", 2.0), ("2025", 7.0), ("2025", 8.0)]
    with pytest.raises(FileNotFoundError):
        landing.read_landing(spark, str(tmp_path / "landing"), ["nothing"])


def test_failed_download_leaves_nothing(spark, tmp_path):
    class Broken(io.BytesIO):
        def read(self, *_):
            raise OSError("cut")

    zone = landing.Landing(spark, tmp_path / "z", lambda url: Broken())
    with pytest.raises(OSError, match="cut"):
        zone.ingest([landing.Source("a", "u", "a")], [2025], 2025)
    assert not [x for x in tmp_path.rglob("*") if x.is_file()] and zone.inventory() == {}


RANKED = landing.History("kind = 'wp'", "day", ("day", "id"), ("id", "day", "kind"))


def test_history_is_landed_by_season_and_value(spark, tmp_path):
    rows = [(1, "2025-02-01", "wp"), (2, "2025-09-05", "wp"), (2, "2025-09-05", "wp"), (3, "2025-09-06", "x")]
    file = lambda r: published(spark, tmp_path, r, "id int, day string, kind string")
    body = {"now": file(rows)}
    zone = landing.Landing(spark, tmp_path / "zone", lambda url: io.BytesIO(body["now"]))
    source = landing.Source("ranks", "u", "r", history=RANKED)
    actions = lambda: {r.season: r.action for r in zone.ingest([source], [2023, 2024, 2025], 2025)}
    assert actions() == {2023: "not_published", 2024: "written", 2025: "written"}
    body["now"] = file(rows[::-1])  # other bytes, same values
    assert actions() == {2023: "not_published", 2024: "unchanged", 2025: "unchanged"}
    body["now"] = file(rows[:2] + rows[3:])
    assert actions() == {2023: "not_published", 2024: "unchanged", 2025: "written"}
    raw = landing.latest_landed(landing.read_landing(spark, str(tmp_path / "zone"), ["ranks"])["ranks"])
    assert sorted((r["id"], r[landing.PART]) for r in raw.collect()) == [("1", "2024"), ("2", "2025")]


def test_content_hash_counts_equal_rows(spark):
    one = lambda rows: (d := spark.createDataFrame(rows, "a string, b string")).agg(landing.content_hash(d).alias("h")).first()["h"]
    x, y, q = ("x", None), ("y", None), ("q", "q")
    assert one([x, x, q]) != one([y, y, q]) and one([x, q, x]) == one([q, x, x]) and one([x, q]) != one([x, x, q])
    assert one([("x", None)]) != one([(None, "x")]) and one([("x", "null")]) != one([x]) and one([]) and len(one([x])) == 12


def test_declared_sources():
    from gaugework.plans import graph
    from gaugework.plans.published import SOURCES

    assert {s.name for s in SOURCES} == set(graph.LANDED)
    assert [s.name for s in SOURCES if not s.required] == ["player_ids", "ecr"] and [s.name for s in SOURCES if not s.widen] == ["pbp"]
    assert landing.plan(SOURCES[0], [2024, 2025], 2025, {("pbp", 2024): {"x"}}) == [(2024, False), (2025, True)]
    assert SOURCES[0].file_name(2024, "ab") == "pbp/2024/play_by_play_2024_ab.parquet" and SOURCES[7].file_name(None, "ab") == "schedules/games_ab.parquet"


def test_csv_strings_and_split(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,day,kind\n1,2025-02-01,wp\n2,2025-09-05,wp\n"",2025-09-06,NA\n')
    df = landing.read_strings(spark, str(path))
    assert [tuple(r) for r in df.orderBy("day").collect()] == [("1", "2025-02-01", "wp"), ("2", "2025-09-05", "wp"), (None, "2025-09-06", None)]
    landing.split_by_season(df, RANKED, str(tmp_path / "out"))
    assert {r["season"]: r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {2024: "1", 2025: "2"}


def test_publish_keeps_and_replaces(spark):
    spark.sql("DROP TABLE IF EXISTS served")
    a = spark.createDataFrame([(1, "a")], "k int, v string").withColumn("n", F.lit(None))
    assert serving.publish(a, "served") == "created" and serving.publish(a, "served") == "overwritten"
    assert serving.publish(a.drop("n"), "served") == "replaced" and spark.table("served").columns == ["k", "v"]
    serving.renamed_view(spark, "served", "served_view", {"v": "value"})
    assert spark.table("served_view").columns == ["k", "value"]
    serving.overwrite_table(a, "served")
    assert spark.table("served").columns == ["k", "v", "n"]
    with pytest.raises(ValueError, match="identifier"):
        serving.identifier("a; DROP")
    spark.sql("DROP TABLE served")


def test_mirror_and_export(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = [(i, "x", 1) for i in range(10)]
    first = spark.createDataFrame(rows, "k int, v string, g int")
    serving.mirror(target, first, ["k"], ["g"])
    serving.mirror(target, spark.createDataFrame([(i, "x" if i else "y", 2) for i in range(9)] + [(20, "z", 2)], first.schema), ["k"], ["g"])
    got = {r["k"]: (r["v"], r["g"]) for r in spark.read.parquet(target).collect()}
    assert got[0] == ("y", 2) and got[1] == ("x", 1) and got[20] == ("z", 2) and 9 not in got
    with pytest.raises(ShrinkError):
        serving.mirror(target, first.limit(2), ["k"])
    with pytest.raises(ShrinkError):
        serving.mirror(str(tmp_path / "none"), first.limit(0), ["k"])
    manifest = serving.export_snapshot({"t": first}, {"t": ["k", "g"]}, {"t": ["g"]}, str(tmp_path / "out"))
    assert manifest["t"]["rows"] == 10 and spark.read.parquet(str(tmp_path / "out/t")).where("g IS NOT NULL").count() == 0


def test_stream_is_exactly_once(spark, tmp_path):
    land, out, state = (str(tmp_path / x) for x in ("land", "bronze", "state"))
    a = spark.createDataFrame([(1, 2), (3, 4)], "season int, v int")
    a.write.parquet(land)
    for want in (2, 2):
        bronze.ingest_new_files(spark, land, a.schema, out, state)
        assert spark.read.parquet(out).count() == want
    a.write.mode("append").parquet(land)
    bronze.ingest_new_files(spark, land, a.schema, out, state)
    got = spark.read.parquet(out)
    assert got.count() == 4 and got.where("_source_file IS NULL").count() == 0


def test_incremental_partitions(spark, tmp_path):
    land, out, state = (str(tmp_path / x) for x in ("land", "out", "state"))
    schema = "season int, v int"
    seen = []

    def rebuild(keys):
        seen.append(sorted(r[0] for r in keys.collect()))
        rows = spark.read.schema(schema).parquet(land).join(keys, "season", "left_semi")
        bronze.overwrite_partitions(rows.groupBy("season").agg(F.sum("v").alias("v")), out, ["season"])

    spark.createDataFrame([(2024, 1), (2025, 2)], schema).write.parquet(land)
    frame = spark.read.parquet(land)
    bronze.rebuild_on_new_files(spark, land, frame.schema, state, ["season"], rebuild)
    spark.createDataFrame([(2025, 5)], schema).write.mode("append").parquet(land)
    bronze.rebuild_on_new_files(spark, land, frame.schema, state, ["season"], rebuild)
    bronze.rebuild_on_new_files(spark, land, frame.schema, state, ["season"], rebuild)
    assert seen == [[2024, 2025], [2025]]
    assert {r["season"]: r["v"] for r in spark.read.parquet(out).collect()} == {2024: 1, 2025: 7}


def test_windowed_counts(spark):
    rows = spark.createDataFrame([("2024-01-01 00:10:00",), ("2024-01-01 00:50:00",), ("2024-01-01 01:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    out = bronze.windowed(rows, "t", "1 hour", "10 minutes", [], F.count("*").alias("n"))
    assert sorted(r["n"] for r in out.collect()) == [1, 2]

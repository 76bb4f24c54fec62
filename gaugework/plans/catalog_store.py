"""Queries of landing, serving and change over files, with the SQL that must agree."""

from __future__ import annotations

import io
import urllib.error

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugework import contract
from gaugework.operators import change
from gaugework.plans.registry import query
from gaugework.session import table, work_dir
from gaugework.sources import landing, serving
from gaugework.sources.store import Store
from gaugework.streaming.bronze import ingest_new_files

YEARS = "(SELECT min(year(o_orderdate)) AS a FROM orders)"


def _published(spark: SparkSession, df: DataFrame, base: str, name: str) -> str:
    """One Parquet file as a publisher would have it; its path."""
    df.coalesce(1).write.parquet(f"{base}/{name}")
    return f"{base}/{name}/" + next(f for f in Store(spark, base).files(f"{base}/{name}") if f.endswith(".parquet"))


def _orders(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("y"), F.col("o_orderdate").cast("date").alias("day"))
    return rows, rows.agg(F.min("y").alias("a")).first()["a"]  # one row


@query("SELECT * FROM (VALUES (0, 0, 'written'), (0, 1, 'written'), (1, 0, 'skipped'), (1, 1, 'unchanged'), (2, 0, 'skipped'), (2, 1, 'written'), (3, 2, 'not_published')) v(run, season, action)")
def landing_runs(spark, sf_dir):
    """What each run of a landing does: missing parts and the current one, new content only."""
    rows, first = _orders(spark, sf_dir)
    base, years = work_dir(spark, "landing"), (first, first + 1)
    half = {y: _published(spark, rows.where(F.col("y") == y).where("o_orderkey % 2 = 0"), base, f"half-{y}") for y in years}
    whole = _published(spark, rows.where(F.col("y") == first + 1), base, "whole")
    published: dict = {}

    def fetch(url: str):
        if int(url) not in published:
            raise urllib.error.HTTPError(url, 404, "", None, None)
        return Store(spark, base).open(published[int(url)])

    zone, source, done = landing.Landing(spark, f"{base}/zone", fetch), landing.Source("orders", "{season}", "orders"), []
    for run, (state, wanted, current) in enumerate(((half, years, years[1]), (half, years, years[1]), (half | {years[1]: whole}, years, years[1]), ({}, [first + 2], first + 2))):
        published.clear()
        published.update(state)
        done += [(run, r.season - first, r.action) for r in zone.ingest([source], wanted, current)]
    return spark.createDataFrame(done, "run int, season int, action string")


@query(
    f"""SELECT o_orderkey::DOUBLE AS o_orderkey, o_custkey::DOUBLE AS o_custkey, o_orderstatus, year(o_orderdate)::VARCHAR AS part, TRUE AS lineage FROM orders CROSS JOIN {YEARS} y
WHERE year(o_orderdate) = a + 1 OR year(o_orderdate) = a AND o_orderkey % 2 = 0"""
)
def landed_latest(spark, sf_dir):
    """The newest file of each part with its lineage; whole numbers widened."""
    rows, first = _orders(spark, sf_dir)
    base = work_dir(spark, "latest")
    half = lambda y: rows.where(F.col("y") == y).where("o_orderkey % 2 = 0")
    parts = [(first, half(first)), (first + 1, half(first + 1)), (first + 1, rows.where(F.col("y") == first + 1))]
    for k, (season, df) in enumerate(parts):
        path = _published(spark, df, base, f"pub{k}")
        zone = landing.Landing(spark, f"{base}/zone", lambda url, path=path: Store(spark, base).open(path))
        zone.ingest([landing.Source("orders", "{season}", "orders")], [season], season)
    raw = landing.read_landing(spark, f"{base}/zone", ["orders"])["orders"]
    seen = F.col(landing.SEEN_AT).isNotNull() & F.col(landing.SEEN_IN).rlike(r"/orders_\d{4}_[0-9a-f]{12}\.parquet$")
    return landing.latest_landed(raw).select("o_orderkey", "o_custkey", "o_orderstatus", F.col(landing.PART).alias("part"), seen.alias("lineage"))


HISTORY = landing.History("o_orderstatus = 'F'", "day", ("day", "o_orderkey"), ("o_orderkey", "day"))


@query(
    f"""SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderdate::DATE::VARCHAR AS day, (year(o_orderdate) - (month(o_orderdate) < 3)::INT)::VARCHAR AS part, 'unchanged' AS again FROM orders CROSS JOIN {YEARS} y
WHERE o_orderstatus = 'F' AND year(o_orderdate) - (month(o_orderdate) < 3)::INT IN (a, a + 1)"""
)
def landed_history(spark, sf_dir):
    """One history filed by season and value; other bytes of the same values are unchanged."""
    rows, first = _orders(spark, sf_dir)
    base, wanted = work_dir(spark, "history"), [first, first + 1]
    files = [_published(spark, df, base, f"pub{k}") for k, df in enumerate((rows, rows.orderBy(F.desc("o_orderkey"))))]
    source, again = landing.Source("ranks", "u", "ranks", history=HISTORY), ""
    for path in files:
        zone = landing.Landing(spark, f"{base}/zone", lambda url, path=path: Store(spark, base).open(path))
        again = ",".join(sorted({r.action for r in zone.ingest([source], wanted, first + 1)}))
    raw = landing.read_landing(spark, f"{base}/zone", ["ranks"])["ranks"]
    return landing.latest_landed(raw).select("o_orderkey", "day", F.col(landing.PART).alias("part"), F.lit(again).alias("again"))


@query("SELECT * FROM (VALUES ('other order', TRUE), ('one row twice', FALSE), ('two pairs swapped', FALSE), ('a null moved', FALSE)) v(change, same)")
def value_hashes(spark, sf_dir):
    """S9, 2.7: a hash of the values of a table, in any order, that counts repeated rows."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.lit(None).cast("string").alias("note"))
    one = lambda df: df.agg(landing.content_hash(df).alias("h")).first()["h"]
    x, y = rows.where("c_custkey <= 10"), rows.where("c_custkey BETWEEN 11 AND 20")
    found = [
        ("other order", one(rows) == one(rows.orderBy(F.desc("c_custkey")))),
        ("one row twice", one(rows) == one(rows.unionByName(x.limit(1)))),
        ("two pairs swapped", one(rows.unionByName(x)) == one(rows.unionByName(y))),
        ("a null moved", one(rows) == one(rows.select("c_custkey", F.col("note").alias("c_name"), F.col("c_name").alias("note")))),
    ]
    return spark.createDataFrame(found, "change string, same boolean")


@query("SELECT c_custkey::VARCHAR AS c_custkey, CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 THEN c_name END AS c_name, c_mktsegment FROM customer")
def csv_strings(spark, sf_dir):
    """A CSV file as strings; empty and NA are null."""
    name = F.when(F.col("c_custkey") % 5 == 0, "NA").when(F.col("c_custkey") % 7 == 0, "").otherwise(F.col("c_name"))
    path = work_dir(spark, "csv")
    table(spark, sf_dir, "customer").select("c_custkey", name.alias("c_name"), "c_mktsegment").write.option("header", "true").csv(path)
    return landing.read_strings(spark, path)


@query("SELECT c_custkey::DOUBLE AS c_custkey, c_name, c_nationkey::DOUBLE AS c_nationkey, c_acctbal FROM customer")
def widened_numbers(spark, sf_dir):
    """Whole numbers as doubles, all else as it is."""
    return contract.widened(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal"))


@query("SELECT * FROM (VALUES ('flaky', 3, '5,10'), ('gone', 1, ''), ('down', 4, '5,10,20')) v(server, attempts, pauses)")
def fetch_attempts(spark, sf_dir):
    """Server errors are tried again with doubling pauses, the caller's are not."""
    out = []
    for server, errors in (("flaky", [503, 500]), ("gone", [404] * 9), ("down", [503] * 9)):
        left, calls, waits = list(errors), [], []

        def opener(url, left=left, calls=calls):
            calls.append(url)
            if left:
                raise urllib.error.HTTPError(url, left.pop(0), "", None, None)
            return io.BytesIO()

        try:
            landing.open_url("u", opener=opener, sleep=waits.append)
        except urllib.error.HTTPError:
            pass
        out.append((server, len(calls), ",".join(str(int(w)) for w in waits)))
    return spark.createDataFrame(out, "server string, attempts int, pauses string")


@query("SELECT c_custkey, c_name, c_acctbal, 'created,overwritten,replaced' AS steps FROM customer")
def published_table(spark, sf_dir):
    """A served table: created, its rows overwritten, replaced when its columns change."""
    name = "published_" + work_dir(spark, "t").rsplit("-", 1)[1]
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    steps = [serving.publish(df, name) for df in (rows.drop("c_acctbal").limit(5), rows.drop("c_acctbal"), rows)]
    return spark.table(name).withColumn("steps", F.lit(",".join(steps)))


def _old_and_new(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_mktsegment").alias("segment"))
    old = rows.where("c_custkey % 10 <> 3").withColumn("generated", F.lit(1))
    new = rows.where("c_custkey % 10 <> 7").withColumn("segment", F.when(F.col("c_custkey") % 10 == 5, F.lit("X")).otherwise(F.col("segment"))).withColumn("generated", F.lit(2))
    return old, new


@query(
    """SELECT c_custkey, c_name, CASE WHEN c_custkey % 10 = 5 THEN 'X' ELSE c_mktsegment END AS segment, CASE WHEN c_custkey % 10 IN (3, 5) THEN 2 ELSE 1 END AS generated FROM customer WHERE c_custkey % 10 <> 7"""
)
def mirrored_folder(spark, sf_dir):
    """A folder made equal to its source; a column that always changes is no change; a shrunken or failing source leaves all as it was."""
    old, new = _old_and_new(spark, sf_dir)
    root = work_dir(spark, "mirror")
    keys, ignore = ["c_custkey"], ("generated",)
    serving.mirror_all(root, {"a": serving.Mirrored(old, keys, ignore), "b": serving.Mirrored(old, keys, ignore)})
    serving.mirror_all(root, {"a": serving.Mirrored(new, keys, ignore), "b": serving.Mirrored(new, keys, ignore)})
    for bad in (new.limit(3), new.limit(0)):
        try:
            serving.mirror_all(root, {"a": serving.Mirrored(new.withColumn("segment", F.lit("lost")), keys), "b": serving.Mirrored(bad, keys)})
        except change.ShrinkError:
            continue
    return spark.read.parquet(f"{root}/a")


@query("SELECT * FROM (VALUES ('most gone', 'refused'), ('few gone', 'passes'), ('empty', 'refused'), ('empty allowed', 'passes')) v(source, outcome)")
def shrink_guard(spark, sf_dir):
    """An empty source, or one that would delete more than a fifth, is refused."""
    rows = table(spark, sf_dir, "customer").select("c_custkey")
    out = []
    for name, source, may in (("most gone", rows.where("c_custkey % 2 = 0"), False), ("few gone", rows.where("c_custkey % 10 <> 0"), False), ("empty", rows.limit(0), False), ("empty allowed", rows.limit(0), True)):
        try:
            change.shrink_guard(rows, source, ["c_custkey"], may_be_empty=may)
            out.append((name, "passes"))
        except change.ShrinkError:
            out.append((name, "refused"))
    return spark.createDataFrame(out, "source string, outcome string")


@query("SELECT n_nationkey AS id, n_name AS name, n_regionkey FROM nation")
def renamed_columns(spark, sf_dir):
    """A view of a table with columns under other names."""
    name = "named_" + work_dir(spark, "t").rsplit("-", 1)[1]
    serving.overwrite_table(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"), name)
    serving.renamed_view(spark, name, f"{name}_view", {"n_nationkey": "id", "n_name": "name"})
    return spark.table(f"{name}_view")


@query(
    """SELECT * FROM (VALUES ('o_orderkey', 'NUMBER(19,0)', TRUE), ('o_orderstatus', 'VARCHAR', FALSE), ('day', 'DATE', FALSE), ('price', 'FLOAT', FALSE), ('at', 'TIMESTAMP_TZ', FALSE),
('local', 'TIMESTAMP_NTZ', FALSE), ('small', 'NUMBER(10,0)', FALSE), ('yes', 'BOOLEAN', FALSE)) v(name, kind, key)"""
)
def served_types(spark, sf_dir):
    """The serving type of each column, as generated DDL has it, and that unchanged DDL is fresh."""
    import re

    now = F.lit("2024-01-01").cast("timestamp")
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("day"), F.col("o_totalprice").cast("double").alias("price"), now.alias("at"), now.cast("timestamp_ntz").alias("local"),
        F.lit(1).alias("small"), F.lit(True).alias("yes"),
    )
    text = contract.create_table_ddl("served", df.schema, ["o_orderkey"])
    if contract.stale(text, "served", df.schema, ["o_orderkey"]) or not contract.stale(text, "served", df.drop("yes").schema, ["o_orderkey"]):
        raise AssertionError("freshness of the DDL")
    found = re.findall(r"^ +(\w+) ([A-Z_]+(?:\([0-9,]+\))?)( NOT NULL)?,?$", text, re.M)
    return spark.createDataFrame([(n, k, bool(key)) for n, k, key in found if n != "PRIMARY"], "name string, kind string, key boolean")


@query("SELECT s_suppkey, NULL::VARCHAR AS s_name, s_nationkey, (SELECT count(*) FROM supplier) AS listed FROM supplier")
def exported_snapshot(spark, sf_dir):
    """Allowed columns, one blanked as a typed null, and the manifest's count."""
    folder = work_dir(spark, "export")
    manifest = serving.export_snapshot({"supplier": table(spark, sf_dir, "supplier")}, {"supplier": ["s_suppkey", "s_name", "s_nationkey"]}, {"supplier": ["s_name"]}, folder)
    return spark.read.parquet(f"{folder}/supplier").withColumn("listed", F.lit(manifest["supplier"]["rows"]).cast("long"))


@query("SELECT n_nationkey, n_name, NULL::VARCHAR AS note, 'string' AS kind FROM nation")
def typed_nulls(spark, sf_dir):
    """A small table through Arrow to the driver and back, a column without a type as string."""
    rows = contract.typed_nulls(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.lit(None).alias("note")))
    back = spark.createDataFrame(rows.toArrow())
    return back.withColumn("kind", F.lit(dict(back.dtypes)["note"]))


@query("SELECT event_id, event_type, TRUE AS lineage, 0 AS more FROM events")
def stream_lineage(spark, sf_dir):
    """Streamed rows with the file that they came from; a second run without new files adds nothing."""
    base = work_dir(spark, "stream")
    source = table(spark, sf_dir, "events").select("event_id", "event_type")
    source.write.parquet(f"{base}/land")
    for _ in range(2):
        ingest_new_files(spark, f"{base}/land", source.schema, f"{base}/bronze", f"{base}/state")
    bronze = spark.read.parquet(f"{base}/bronze")
    more = bronze.count() - source.count()
    lineage = F.col(landing.SEEN_AT).isNotNull() & F.col(landing.SEEN_IN).contains("/land/")
    return bronze.select("event_id", "event_type", lineage.alias("lineage"), F.lit(more).cast("int").alias("more"))

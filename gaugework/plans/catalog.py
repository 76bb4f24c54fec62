"""Queries on the driver's tables, one for each operator, with the SQL that must agree."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gaugework import contract, quality
from gaugework.functions import scoring, search
from gaugework.operators import change, joins, stats, tiers
from gaugework.operators import windows as win
from gaugework.operators.asof import asof_join
from gaugework.plans.registry import ORACLE, QUERIES, query  # noqa: F401
from gaugework.session import table, work_dir
from gaugework.streaming.bronze import ingest_new_files

@query("""
SELECT n_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,6)) * CAST(1 - l_discount AS DECIMAL(9,4))) AS DOUBLE) AS revenue,
       count(*) AS lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name ORDER BY n_name
""")
def nation_revenue(spark, sf_dir):
    """Three inner joins, an exact decimal sum and a count."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        (F.col("l_extendedprice").cast("decimal(18,6)") * (1 - F.col("l_discount")).cast("decimal(9,4)")).alias("amount"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(people, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(F.sum("amount").cast("double").alias("revenue"), F.count("*").alias("lines"))
        .orderBy("n_name")
    )


def events(spark, sf_dir, *columns):
    return table(spark, sf_dir, "events").select(*columns)


# Projection, filters, expectations


@query("""
SELECT event_id, TRY_CAST(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS INT) AS k, nullif(nullif(trim(event_type), ''), 'NA') AS kind FROM events
""")
def typed_contract(spark, sf_dir):
    """Casts that give null, whole numbers through double, clean ids."""
    rows = events(spark, sf_dir, "event_id", "event_type", F.get_json_object("props", "$.k").alias("k"))
    return contract.typed_select(rows, {"event_id": "bigint", "k": "int"}, contract.clean_id("kind", "event_type"))


@query("""
SELECT n_nationkey, CASE n_name WHEN 'NATION_0' THEN 'N0' WHEN 'FRANCE' THEN 'FR' WHEN 'GERMANY' THEN 'DE' ELSE n_name END AS code FROM nation
""")
def code_map(spark, sf_dir):
    """Codes through a literal map, others kept."""
    codes = {"NATION_0": "N0", "FRANCE": "FR", "GERMANY": "DE"}
    return table(spark, sf_dir, "nation").select("n_nationkey", contract.mapped(F.col("n_name"), codes).alias("code"))


@query("""
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus IN ('O', 'F') AND o_totalprice BETWEEN 1000 AND 200000
AND o_custkey IS NOT NULL AND o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderpriority <> '5-LOW'
""")
def range_filters(spark, sf_dir):
    """Pruned columns and filters that reach the scan."""
    rows = table(spark, sf_dir, "orders")
    keep = F.col("o_orderstatus").isin("O", "F") & F.col("o_totalprice").between(1000, 200000) & F.col("o_custkey").isNotNull()
    return rows.where(keep & (F.col("o_orderdate") >= F.lit("1995-01-01").cast("timestamp_ntz")) & (F.col("o_orderpriority") != "5-LOW")).select("o_orderkey", "o_orderdate")


EVENT_RULES = {
    "has_user": "user_id IS NOT NULL",
    "known_type": quality.one_of("event_type", ["purchase", "click", "view"]),
    "small_value": "value < 90",
}


@query("""
SELECT event_id, user_id, event_type FROM events WHERE coalesce(user_id IS NOT NULL AND event_type IN ('purchase', 'click', 'view') AND value < 90, false)
""")
def drop_rules(spark, sf_dir):
    """Rows that pass every rule; a null rule is a failure."""
    return quality.keep_valid(events(spark, sf_dir, "event_id", "user_id", "event_type", "value"), EVENT_RULES).drop("value")


@query("""
SELECT count(*) FILTER (WHERE NOT coalesce(user_id IS NOT NULL, false)) AS has_user,
  count(*) FILTER (WHERE NOT coalesce(event_type IN ('purchase', 'click', 'view'), false)) AS known_type,
  count(*) FILTER (WHERE NOT coalesce(value < 90, false)) AS small_value FROM events
""")
def warn_counts(spark, sf_dir):
    """Failures of each rule in one pass."""
    return quality.failure_counts(events(spark, sf_dir, "user_id", "event_type", "value"), EVENT_RULES)


@query(r"""
SELECT c_custkey, coalesce(regexp_full_match(c_name, '[\p{L}\p{M} .''-]{1,64}'), false) AS plain, c_mktsegment IN ('BUILDING', 'MACHINERY') AS known FROM customer
""")
def name_rules(spark, sf_dir):
    """Shape of names, membership."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey", quality.plain_name(F.col("c_name")).alias("plain"), quality.holds(quality.all_known(["c_mktsegment"], ["BUILDING", "MACHINERY"])).alias("known")
    )


@query("""
SELECT event_id, CASE event_type WHEN 'purchase' THEN 24 WHEN 'click' THEN 48 WHEN 'view' THEN 72 ELSE 0 END AS pool,
  coalesce(value > 50, false) AS large FROM events WHERE event_type = 'click' OR value > 10
""")
def case_labels(spark, sf_dir):
    """CASE labels, bound parameters, defaults of booleans."""
    events(spark, sf_dir, "event_id", "event_type", "value").createOrReplaceTempView("__case_events")
    return spark.sql(
        """SELECT event_id, CASE event_type WHEN 'purchase' THEN 24 WHEN 'click' THEN 48 WHEN 'view' THEN 72 ELSE 0 END AS pool,
        coalesce(value > :large, false) AS large FROM __case_events WHERE event_type = :kind OR value > :least""",
        args={"large": 50, "kind": "click", "least": 10},
    )


# Joins


@query("SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey")
def crosswalk_left(spark, sf_dir):
    """A left join to a crosswalk."""
    people = table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey", "c_name", "c_mktsegment")
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(people, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_name", "c_mktsegment")


@query("""
SELECT l_partkey, l_suppkey, l.n AS lines, r.n AS returned, s.n AS shipped FROM (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL) l
LEFT JOIN (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) r USING (l_partkey, l_suppkey)
LEFT JOIN (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL) s USING (l_partkey, l_suppkey)
""")
def chained_left(spark, sf_dir):
    """Left joins on two keys, one partitioning for all."""
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    keys = ["l_partkey", "l_suppkey"]
    every = rows.groupBy(*keys).agg(F.count("*").alias("lines"))
    returned = rows.where("l_returnflag = 'R'").groupBy(*keys).agg(F.count("*").alias("returned"))
    shipped = rows.where("l_linestatus = 'F'").groupBy(*keys).agg(F.count("*").alias("shipped"))
    return every.join(returned, keys, "left").join(shipped, keys, "left")


@query("""
SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(purchases, 0) AS purchases, coalesce(errors, 0) AS errors
FROM (SELECT user_id, count(*) AS purchases FROM events WHERE event_type = 'purchase' GROUP BY user_id) a
FULL JOIN (SELECT user_id, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY user_id) b ON a.user_id = b.user_id
""")
def full_outer_counts(spark, sf_dir):
    """Full outer join of two aggregates, zero where missing."""
    rows = events(spark, sf_dir, "user_id", "event_type")
    bought = rows.where("event_type = 'purchase'").groupBy("user_id").agg(F.count("*").alias("purchases"))
    failed = rows.where("event_type = 'error'").groupBy("user_id").agg(F.count("*").alias("errors"))
    return joins.either(bought, failed, ["user_id"], ["purchases", "errors"])


@query("""
WITH weeks AS (SELECT year(o_orderdate) AS y, weekofyear(o_orderdate)::INT AS week, min(CASE WHEN dayofweek(o_orderdate) = 0 THEN o_orderdate::DATE END) AS sunday FROM orders GROUP BY ALL),
days AS (SELECT DISTINCT year(l_shipdate) AS y, l_shipdate::DATE AS day FROM lineitem)
SELECT days.y::INT AS y, day, min(week) AS week FROM days JOIN weeks ON days.y = weeks.y WHERE sunday > day GROUP BY ALL
""")
def first_week_after(spark, sf_dir):
    """Conditional minimum by week, then the first week whose day is strictly later."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    weeks = orders.groupBy(F.year("day").alias("y"), F.weekofyear("day").alias("week")).agg(F.min(F.when(F.dayofweek("day") == 1, F.col("day"))).alias("sunday"))
    ships = table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("y"), F.col("l_shipdate").cast("date").alias("day"))
    return joins.first_after(ships, weeks, ["y"], "day", "sunday", "week", "week")


@query("""
WITH shots AS (SELECT DISTINCT user_id, ts FROM events WHERE event_type = 'view'),
near AS (SELECT p.event_id, max(s.ts) AS ts FROM events p JOIN shots s ON p.user_id = s.user_id AND s.ts < p.ts WHERE p.event_type = 'purchase' GROUP BY p.event_id)
SELECT near.event_id, near.ts AS view_at, v.event_id AS view_id FROM near JOIN events p ON near.event_id = p.event_id JOIN events v ON v.user_id = p.user_id AND v.ts = near.ts AND v.event_type = 'view'
""")
def snapshot_before(spark, sf_dir):
    """The latest snapshot strictly before, and all rows of that snapshot."""
    rows = events(spark, sf_dir, "event_id", "user_id", "event_type", "ts")
    views = rows.where("event_type = 'view'")
    taken = views.select("user_id", "ts").distinct()
    bought = rows.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    found = asof_join(bought, taken, ["user_id"], "ts").where("right_time IS NOT NULL").select("event_id", "user_id", F.col("right_time").alias("view_at"))
    members = views.select("user_id", F.col("ts").alias("view_at"), F.col("event_id").alias("view_id"))
    return found.join(members, ["user_id", "view_at"]).select("event_id", "view_at", "view_id")


def _asof_query(inclusive: bool):
    def run(spark, sf_dir):
        rows = events(spark, sf_dir, "event_id", "user_id", "event_type", "ts", "value")
        left = rows.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
        right = rows.where("event_type = 'click'" if not inclusive else "event_type IN ('click', 'purchase')").select("user_id", "ts", F.col("value").alias("clicked"), F.col("event_id").alias("click_id"))
        out = asof_join(left, right, ["user_id"], "ts", inclusive=inclusive, tie=["click_id"])
        return out.select("event_id", "user_id", "click_id", "clicked", F.col("right_time").alias("click_at"))

    return run


@query("""
SELECT l.event_id, l.user_id, r.event_id AS click_id, r.value AS clicked, r.ts AS click_at FROM (SELECT * FROM events WHERE event_type = 'purchase') l
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') r ON l.user_id = r.user_id AND l.ts > r.ts
""")
def asof_strict(spark, sf_dir):
    """The last row of the same key strictly before."""
    return _asof_query(False)(spark, sf_dir)


@query("""
SELECT l.event_id, l.user_id, r.event_id AS click_id, r.value AS clicked, r.ts AS click_at FROM (SELECT * FROM events WHERE event_type = 'purchase') l
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type IN ('click', 'purchase')) r ON l.user_id = r.user_id AND l.ts >= r.ts
""")
def asof_inclusive(spark, sf_dir):
    """The last row of the same key at or before."""
    return _asof_query(True)(spark, sf_dir)


@query("""
SELECT l.event_id, r.event_id AS error_id FROM (SELECT * FROM events WHERE event_type = 'purchase') l
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') r ON l.ts > r.ts
""")
def asof_one_hot_key(spark, sf_dir):
    """J7 where one key has all rows: dealt by day, carried from day to day."""
    rows = events(spark, sf_dir, "event_id", "event_type", "ts").withColumn("one", F.lit(1))
    left = rows.where("event_type = 'purchase'").select("event_id", "one", "ts")
    right = rows.where("event_type = 'error'").select("one", "ts", F.col("event_id").alias("error_id"))
    out = asof_join(left, right, ["one"], "ts", tie=["error_id"], slice_of=lambda t: t.cast("date"))
    return out.select("event_id", "error_id")


@query("""
WITH sides AS (SELECT l_orderkey, l_linenumber, c_nationkey AS team, s_nationkey AS opponent, true AS buys, l_quantity AS amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  UNION ALL SELECT l_orderkey, l_linenumber, s_nationkey, c_nationkey, false, -l_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)
SELECT * FROM sides
""")
def two_sides(spark, sf_dir):
    """One event as two rows, one a side, with the sign turned, in one scan."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    joined = (
        lines.join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    side = lambda a, b, yes, sign: F.struct(F.col(a).alias("team"), F.col(b).alias("opponent"), F.lit(yes).alias("buys"), (F.col("l_quantity") * sign).alias("amount"))
    return joined.select("l_orderkey", "l_linenumber", F.explode(F.array(side("c_nationkey", "s_nationkey", True, 1), side("s_nationkey", "c_nationkey", False, -1))).alias("s")).select("l_orderkey", "l_linenumber", "s.*")


@query("""
SELECT u.user_id, k AS event_type, coalesce(n, 0) AS n FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN (VALUES ('click'), ('error'), ('purchase')) AS q(k)
LEFT JOIN (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) e ON u.user_id = e.user_id AND e.event_type = k
""")
def dense_grid(spark, sf_dir):
    """Every key with every member of a domain, zero where nothing happened."""
    rows = events(spark, sf_dir, "user_id", "event_type")
    counts = rows.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    grid = joins.dense(rows.select("user_id").distinct(), "event_type", ["click", "error", "purchase"])
    return joins.in_domain(counts, grid, ["user_id", "event_type"], "n")


@query("SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'signup')")
def semi_join(spark, sf_dir):
    """Rows whose key occurs on the other side."""
    rows = events(spark, sf_dir, "event_id", "user_id", "event_type")
    return rows.join(rows.where("event_type = 'signup'").select("user_id"), "user_id", "left_semi").select("event_id", "user_id")


@query("SELECT event_id, user_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM events s WHERE s.user_id = e.user_id AND s.event_type = 'signup' AND s.value > 200)")
def anti_join(spark, sf_dir):
    """Rows whose key does not occur on the other side."""
    rows = events(spark, sf_dir, "event_id", "user_id", "event_type", "value")
    return rows.join(rows.where("event_type = 'signup' AND value > 200").select("user_id"), "user_id", "left_anti").select("event_id", "user_id")


@query("SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 150000) AS large FROM customer")
def existence_flag(spark, sf_dir):
    """A boolean instead of a join's rows."""
    big = table(spark, sf_dir, "orders").where("o_totalprice > 150000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.flagged(table(spark, sf_dir, "customer").select("c_custkey"), big, ["c_custkey"], "large")


@query("""
WITH g AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events)
SELECT a.user_id, a.event_id, a.i, b.value AS value_prev, c.value AS value_second FROM g a
LEFT JOIN g b ON a.user_id = b.user_id AND a.i = b.i + 1 LEFT JOIN g c ON a.user_id = c.user_id AND a.i = c.i + 2
""")
def lag_self_join(spark, sf_dir):
    """Rows one and two steps of a dense index back, in the one sort that numbers them."""
    place = Window.partitionBy("user_id").orderBy("ts", "event_id")
    back = {name: F.lag("value", k).over(place) for k, name in ((1, "value_prev"), (2, "value_second"))}
    return events(spark, sf_dir, "user_id", "event_id", "ts", "value").withColumns({"i": F.row_number().over(place), **back}).select("user_id", "event_id", "i", "value_prev", "value_second")


@query("""
WITH m AS (SELECT o_custkey, year(o_orderdate)::INT AS y, sum(o_totalprice::DECIMAL(18,6))::DOUBLE AS spent FROM orders GROUP BY ALL)
SELECT a.o_custkey, a.y, a.spent, b.spent AS spent_prev FROM m a LEFT JOIN m b ON a.o_custkey = b.o_custkey AND a.y = b.y + 1
""")
def season_shift(spark, sf_dir):
    """Last season's value, by shifting the season key."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), F.col("o_totalprice").cast("decimal(18,6)").alias("p"))
    sums = orders.groupBy("o_custkey", "y").agg(F.sum("p").cast("double").alias("spent"))
    return joins.stepped(sums, ["o_custkey"], "y", 1, ["spent"])


# Aggregates


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity::DECIMAL(18,6))::DOUBLE AS quantity, max(l_tax) AS most_tax, min(l_discount) AS least_discount,
  sum(l_quantity::DECIMAL(18,6))::DOUBLE / count(l_quantity) AS mean_quantity, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY ALL HAVING count(*) > 10
""")
def grouped_aggregates(spark, sf_dir):
    """Counts, sums, extremes and means by key, HAVING, distinct counts."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_tax", "l_discount", "l_suppkey")
    total = F.sum(F.col("l_quantity").cast(win.EXACT)).cast("double")
    return (
        rows.groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count("*").alias("n"), total.alias("quantity"), F.max("l_tax").alias("most_tax"), F.min("l_discount").alias("least_discount"),
            F.try_divide(total, F.count("l_quantity")).alias("mean_quantity"), F.count_distinct("l_suppkey").alias("suppliers"),
        )
        .where("n > 10")
    )


@query("""
SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS clicks, sum(value::DECIMAL(18,6)) FILTER (WHERE event_type = 'purchase')::DOUBLE AS bought,
  min(ts) FILTER (WHERE dayofweek(ts) = 0) AS first_sunday, count(*) FILTER (WHERE value <= 20) AS small FROM events GROUP BY user_id
""")
def conditional_agg(spark, sf_dir):
    """Counts, sums and minima under a condition; no match sums to null and counts zero."""
    rows = events(spark, sf_dir, "user_id", "event_type", "value", "ts")
    return rows.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.sum(F.when(F.col("event_type") == "purchase", F.col("value").cast(win.EXACT))).cast("double").alias("bought"),
        F.min(F.when(F.dayofweek("ts") == 1, F.col("ts"))).alias("first_sunday"),
        F.count_if(F.col("value") <= 20).alias("small"),
    )


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_landed(spark, sf_dir):
    """The newest of each group, by a combining aggregate."""
    rows = events(spark, sf_dir, "user_id", "event_type", "event_id", "value", "ts")
    return win.latest_of(rows, ["user_id"], "ts", "event_id").drop("ts")


@query("SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(spark, sf_dir):
    """Distinct rows."""
    return events(spark, sf_dir, "user_id", "event_type").distinct()


@query("SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC NULLS LAST, event_id) = 1")
def first_by_dedupe(spark, sf_dir):
    """The first of each group in a total order, nulls last."""
    rows = events(spark, sf_dir, "user_id", "event_type", "event_id", "value")
    return win.first_by(rows, ["user_id", "event_type"], F.desc_nulls_last("value"), "event_id").drop("value")


@query("""
WITH r AS (SELECT o_custkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_custkey, o_totalprice) - 1) / 2.0 AS x,
  rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) + (count(*) OVER (PARTITION BY o_custkey, o_orderdate) - 1) / 2.0 AS y FROM orders),
s AS (SELECT o_custkey, count(*) AS n, sum(x)::DOUBLE AS sx, sum(y)::DOUBLE AS sy, sum(x * x)::DOUBLE AS sxx, sum(y * y)::DOUBLE AS syy, sum(x * y)::DOUBLE AS sxy FROM r GROUP BY o_custkey)
SELECT o_custkey, n, CASE WHEN n >= 5 AND n * sxx - sx * sx > 0 AND n * syy - sy * sy > 0 THEN (n * sxy - sx * sy) / sqrt((n * sxx - sx * sx) * (n * syy - sy * sy)) END AS spearman FROM s
""")
def spearman_by_group(spark, sf_dir):
    """Correlation of average ranks; null for few rows or a constant side."""
    return stats.spearman(table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate"), ["o_custkey"], "o_totalprice", "o_orderdate")


@query("""
WITH e AS (SELECT l_returnflag AS method, (l_quantity * 1000)::DECIMAL(18,6) - l_extendedprice::DECIMAL(18,6) AS e, l_extendedprice BETWEEN l_quantity * 500 AND l_quantity * 1500 AS c FROM lineitem)
SELECT method, count(e) AS n, sum(abs(e))::DOUBLE / count(e) AS mae, sqrt(sum((e * e)::DECIMAL(28,6))::DOUBLE / count(e)) AS rmse, sum(e)::DOUBLE / count(e) AS bias,
  (count(*) FILTER (WHERE c))::DOUBLE / count(e) AS interval_coverage FROM e GROUP BY method
""")
def scorecard(spark, sf_dir):
    """Mean absolute error, root mean square, bias and coverage from additive sums."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("method"), "l_extendedprice", (F.col("l_quantity") * 1000).alias("q"), (F.col("l_quantity") * 500).alias("low"), (F.col("l_quantity") * 1500).alias("high"))
    return stats.error_rates(stats.error_sums(rows, ["method"], "q", "l_extendedprice", "low", "high"), ["method"])


@query("""
SELECT coalesce(y::VARCHAR, 'all') AS scope, o_orderpriority, n, total FROM (SELECT year(o_orderdate) AS y, o_orderpriority, count(*) AS n, sum(o_totalprice::DECIMAL(18,6))::DOUBLE AS total
FROM orders GROUP BY GROUPING SETS ((year(o_orderdate), o_orderpriority), (o_orderpriority)))
""")
def scopes(spark, sf_dir):
    """Each season and all of them, in one pass."""
    rows = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("scope"), "o_orderpriority", F.col("o_totalprice").cast(win.EXACT).alias("p"))
    return stats.scoped(rows, "scope", ["o_orderpriority"], [F.count("*").alias("n"), F.sum("p").cast("double").alias("total")])


@query("""
SELECT event_type, round(quantile_cont(value, 0.1), 6) AS low, round(quantile_cont(value, 0.5), 6) AS middle, round(quantile_cont(value, 0.9), 6) AS high FROM events GROUP BY event_type
""")
def quantiles(spark, sf_dir):
    """Linear quantiles by group, from counts of values."""
    found = stats.quantiles(events(spark, sf_dir, "event_type", "value"), ["event_type"], "value", [0.1, 0.5, 0.9])
    return found.select("event_type", *[F.round(F.get("quantiles", k), 6).alias(name) for k, name in enumerate(("low", "middle", "high"))])


@query("""
WITH k AS (SELECT event_type, list_sort([quantile_cont(value, 0.2), quantile_cont(value, 0.4), quantile_cont(value, 0.6), quantile_cont(value, 0.8)]) AS marks FROM events GROUP BY event_type),
p AS (SELECT e.event_type, value, event_id % 50 AS r, len(list_filter(marks, lambda m: m <= value)) AS bin FROM events e JOIN k ON e.event_type = k.event_type),
c AS (SELECT event_type, bin, sum(value::DECIMAL(18,6))::DOUBLE / count(value) AS centre, quantile_cont(r, 0.1)::DOUBLE AS low, quantile_cont(r, 0.9)::DOUBLE AS high, count(*) AS n FROM p GROUP BY ALL)
SELECT event_type, bin::INT AS bin, centre, round(low, 6) AS low, round(max(high) OVER (PARTITION BY event_type ORDER BY bin), 6) AS high, n FROM c
""")
def bands(spark, sf_dir):
    """Quantile bins with a low and a high that never falls."""
    rows = events(spark, sf_dir, "event_type", "value", (F.col("event_id") % 50).alias("r"))
    return stats.bands(rows, ["event_type"], "value", "r", bins=5).withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


@query("""
SELECT o_orderkey, o_totalprice = (SELECT max(o_totalprice) FROM orders) AS is_top FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) - INTERVAL 100 DAY FROM orders)
""")
def scalar_subquery(spark, sf_dir):
    """Comparisons with a one-row aggregate."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    ends = orders.agg(F.max("o_totalprice").alias("top"), F.max("o_orderdate").alias("last"))
    return orders.crossJoin(F.broadcast(ends)).where(F.col("o_orderdate") >= F.col("last") - F.expr("INTERVAL 100 DAY")).select("o_orderkey", (F.col("o_totalprice") == F.col("top")).alias("is_top"))


@query("""
SELECT user_id, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::BIGINT AS click, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::BIGINT AS error,
  sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)::BIGINT AS purchase FROM events GROUP BY user_id
""")
def pivot_methods(spark, sf_dir):
    """A pivot over stated values."""
    return events(spark, sf_dir, "user_id", "event_type").groupBy("user_id").pivot("event_type", ["click", "error", "purchase"]).agg(F.count("user_id")).fillna(0)


@query("""
SELECT n_regionkey AS k, sum(s * n)::DOUBLE / sum(n) AS w FROM
(SELECT n_regionkey, c_nationkey, count(*) AS n, sum(round(c_acctbal)::BIGINT) AS s FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL) GROUP BY n_regionkey
""")
def weighted_means(spark, sf_dir):
    """A mean of group values weighted by group size."""
    people = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    groups = people.groupBy("n_regionkey", "c_nationkey").agg(F.count("*").alias("n"), F.sum(F.round("c_acctbal").cast("long")).alias("s"))
    return groups.groupBy(F.col("n_regionkey").alias("k")).agg(stats.weighted_mean("s", "n").cast("double").alias("w"))


@query()
def bootstrap(spark, sf_dir):
    """Paired bootstrap over weeks; groups are a handful of weekly sums."""
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", F.weekofyear("o_orderdate").alias("week"), (F.col("o_totalprice") / 1000).alias("a"), (F.col("o_custkey") / 10.0).alias("b"))
    sums = rows.groupBy("o_orderpriority", "week").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.count("*").alias("n"))
    return stats.paired_bootstrap(sums, ["o_orderpriority"], "a", "b", "n", resamples=10_000)


# Windows


@query("""
SELECT event_id, sum(value::DECIMAL(18,6)) OVER w::DOUBLE / nullif(count(value) OVER w, 0) AS mean6, count(value) OVER w AS n6 FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)
""")
def rolling6_prior(spark, sf_dir):
    """Mean and count of the six rows before."""
    rows = events(spark, sf_dir, "event_id", "user_id", "ts", "value")
    return rows.select("event_id", win.rolling_mean(["user_id"], ["ts", "event_id"], "value", 6, 1).alias("mean6"), win.rolling_count(["user_id"], ["ts", "event_id"], "value", 6, 1).alias("n6"))


@query("""
SELECT event_id, sum(value::DECIMAL(18,6)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)::DOUBLE / least(3, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS last3,
  sum(value::DECIMAL(18,6)) OVER (PARTITION BY user_id, year(ts) ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::DOUBLE / row_number() OVER (PARTITION BY user_id, year(ts) ORDER BY ts, event_id) AS so_far,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seen FROM events
""")
def rolling3_expanding(spark, sf_dir):
    """Last three, season so far, running count."""
    rows = events(spark, sf_dir, "event_id", "user_id", "ts", "value", F.year("ts").alias("y"))
    return rows.select(
        "event_id", win.rolling_mean(["user_id"], ["ts", "event_id"], "value", 3).alias("last3"), win.expanding_mean(["user_id", "y"], ["ts", "event_id"], "value").alias("so_far"),
        (F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long") - 1).alias("seen"),
    )


@query("""
WITH r AS (SELECT event_id, user_id, CASE WHEN event_id % 4 <> 0 THEN value END AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS n FROM events),
s AS (SELECT event_id, sum(v * pow(2.0, n / 3.0)) OVER w AS a, sum(CASE WHEN v IS NOT NULL THEN pow(2.0, n / 3.0) END) OVER w AS b FROM r
  WINDOW w AS (PARTITION BY user_id ORDER BY n ROWS UNBOUNDED PRECEDING))
SELECT event_id, round(a / b, 6) AS v_ewm FROM s
""")
def ewm_hl3(spark, sf_dir):
    """Exponentially weighted mean, half-life of three rows; nulls take a step but no weight."""
    rows = events(spark, sf_dir, "event_id", "user_id", "ts", F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("v"))
    return win.ewm_mean(rows, ["user_id"], ["ts", "event_id"], ["v"], 3.0).select("event_id", F.round("v_ewm", 6).alias("v_ewm"))


@query("""
SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS slot,
  rank() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) AS ties, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) + (count(*) OVER (PARTITION BY o_custkey, o_orderstatus) - 1) / 2.0 AS mean_place FROM orders
""")
def ranks(spark, sf_dir):
    """Place, dense slot, ties at their least and at their mean place."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    by = Window.partitionBy("o_custkey")
    return rows.select(
        "o_orderkey", F.row_number().over(by.orderBy(F.desc("o_totalprice"), "o_orderkey")).alias("place"), F.dense_rank().over(by.orderBy("o_orderpriority")).alias("slot"),
        F.rank().over(by.orderBy("o_orderstatus")).alias("ties"), win.average_rank(["o_custkey"], "o_orderstatus").cast("double").alias("mean_place"),
    )


@query("""
SELECT event_id, sum(value::DECIMAL(18,6)) OVER a::DOUBLE / count(value) OVER a AS recent, sum(value::DECIMAL(18,6)) OVER b::DOUBLE / nullif(count(value) OVER b, 0) AS earlier,
  sum(value::DECIMAL(18,6)) OVER a::DOUBLE / count(value) OVER a - sum(value::DECIMAL(18,6)) OVER b::DOUBLE / nullif(count(value) OVER b, 0) AS change FROM events
WINDOW a AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), b AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 3 PRECEDING)
""")
def risers(spark, sf_dir):
    """The last three against all before."""
    rows = events(spark, sf_dir, "event_id", "user_id", "ts", "value")
    now, before = win.recent_minus_before(["user_id"], ["ts", "event_id"], "value")
    return rows.select("event_id", now.alias("recent"), before.alias("earlier")).withColumn("change", F.col("recent") - F.col("earlier"))


@query("""
SELECT event_id, value - avg_v AS against_league FROM (SELECT event_id, value, sum(value::DECIMAL(18,6)) OVER (PARTITION BY event_type)::DOUBLE / count(value) OVER (PARTITION BY event_type) AS avg_v FROM events)
""")
def group_transform(spark, sf_dir):
    """A group's mean beside its rows; joined from an aggregate, so a hot group is not gathered."""
    rows = events(spark, sf_dir, "event_id", "event_type", "value")
    means = rows.groupBy("event_type").agg(F.try_divide(F.sum(F.col("value").cast(win.EXACT)).cast("double"), F.count("value")).alias("m"))
    return rows.join(means, "event_type", "left").select("event_id", (F.col("value") - F.col("m")).alias("against_league"))


# Sort, limit, set operations


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3")
def topk_pool(spark, sf_dir):
    """O2: the first three of each group, cut in each task before the exchange."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return win.top_k(rows, ["o_custkey"], 3, F.desc("o_totalprice"), "o_orderkey").drop("rank")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top20(spark, sf_dir):
    """O1, O3: a sorted head."""
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("SELECT y, m FROM (SELECT year(l_shipdate)::INT AS y, month(l_shipdate)::INT AS m FROM lineitem WHERE l_linestatus = 'O') ORDER BY y, m LIMIT 1")
def first_pending(spark, sf_dir):
    """The first period that is still open, as the least of a struct."""
    open_ = table(spark, sf_dir, "lineitem").where("l_linestatus = 'O'").select(F.struct(F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m")).alias("s"))
    return open_.agg(F.min("s").alias("s")).select("s.*")


@query("""
SELECT event_id, 'value' AS method, value AS x FROM events UNION ALL SELECT event_id, 'user', user_id::DOUBLE FROM events UNION ALL SELECT event_id, 'id', event_id::DOUBLE FROM events
""")
def unpivot_methods(spark, sf_dir):
    """Columns as rows, in one scan."""
    rows = events(spark, sf_dir, "event_id", "value", F.col("user_id").cast("double").alias("user"), F.col("event_id").cast("double").alias("id"))
    return rows.unpivot(["event_id"], ["value", "user", "id"], "method", "x")


@query("SELECT user_id FROM events WHERE event_type = 'purchase' UNION SELECT user_id FROM events WHERE event_type = 'signup'")
def union_distinct(spark, sf_dir):
    """Union without repeats, as one filter and one distinct."""
    return events(spark, sf_dir, "user_id", "event_type").where(F.col("event_type").isin("purchase", "signup")).select("user_id").distinct()


# Scalar functions


@query(r"""
SELECT c_custkey, trim(lower(c_name)) AS low, regexp_extract(c_name, '(\d+)$', 1) AS digits, string_split(c_name, '#')[1] AS head, c_custkey::VARCHAR || '-' || c_mktsegment AS key,
  contains(c_name, '00') AS has, starts_with(c_name, 'Customer') AS starts FROM customer
""")
def string_functions(spark, sf_dir):
    """2.7: trim, extract, split, keys, containment."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.trim(F.lower("c_name")).alias("low"), F.regexp_extract("c_name", r"(\d+)$", 1).alias("digits"), F.split("c_name", "#")[0].alias("head"),
        F.concat_ws("-", "c_custkey", "c_mktsegment").alias("key"), F.contains("c_name", F.lit("00")).alias("has"), F.startswith("c_name", F.lit("Customer")).alias("starts"),
    )


@query("""
SELECT o_orderkey, (year(o_orderdate) - CASE WHEN month(o_orderdate) < 3 THEN 1 ELSE 0 END)::INT AS filed, (year(o_orderdate) - CASE WHEN month(o_orderdate) < 9 THEN 1 ELSE 0 END)::INT AS refreshed,
  datediff('day', o_orderdate::DATE, make_date(year(o_orderdate), 12, 31)) / 365.25 AS left_of_year,
  (timezone('America/New_York', o_orderdate::DATE::TIMESTAMP + INTERVAL 13 HOUR)::TIMESTAMPTZ AT TIME ZONE 'UTC') AS kickoff FROM orders
""")
def date_functions(spark, sf_dir):
    """2.7, Q5: seasons of a day, ages, wall-clock times of a zone as instants."""
    day = F.col("o_orderdate").cast("date")
    kickoff = F.make_timestamp(F.year(day), F.month(day), F.dayofmonth(day), F.lit(13), F.lit(0), F.lit(0), F.lit("America/New_York"))
    season = lambda m: F.year(day) - F.when(F.month(day) < m, 1).otherwise(0)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", season(3).alias("filed"), season(9).alias("refreshed"), (F.datediff(F.make_date(F.year(day), F.lit(12), F.lit(31)), day) / F.lit(365.25)).alias("left_of_year"),
        kickoff.cast("timestamp_ntz").alias("kickoff"),
    )


@query("""
SELECT l_orderkey, l_linenumber, floor(l_quantity / 7)::BIGINT AS sevens, abs(l_tax - 0.05) AS gap, greatest(0.0, least(1.0, l_quantity / 50)) AS share, sqrt(l_quantity) AS root, pow(l_quantity, 2) AS square,
  CASE WHEN l_tax > 0 THEN l_discount / l_tax END AS safe FROM lineitem
""")
def math_functions(spark, sf_dir):
    """2.7: absolute values, clipping, roots, powers, safe division."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.floor(F.col("l_quantity") / 7).alias("sevens"), F.abs(F.col("l_tax") - 0.05).alias("gap"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("l_quantity") / 50)).alias("share"), F.sqrt("l_quantity").alias("root"), F.pow("l_quantity", F.lit(2)).alias("square"),
        joins.safe_share(F.col("l_discount"), F.col("l_tax")).alias("safe"),
    )


@query("SELECT o_orderpriority, count(*) AS n, count(DISTINCT hash) AS texts FROM (SELECT o_orderpriority, md5(concat_ws('|', o_orderkey, o_custkey, o_orderstatus)) AS hash FROM orders) GROUP BY o_orderpriority")
def row_hashes(spark, sf_dir):
    """2.7: hashes of rows."""
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", F.md5(F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus").cast("binary")).alias("hash"))
    return rows.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.count_distinct("hash").alias("texts"))


# Change, scoring, domain operators


def _versions(spark, sf_dir):
    """Two versions of a table: some rows gone, some new, some changed, and a column that always changes."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", F.col("c_mktsegment").alias("segment"))
    old = rows.where("c_custkey % 10 <> 3").withColumn("generated", F.lit(1))
    new = rows.where("c_custkey % 10 <> 7").withColumn("segment", F.when(F.col("c_custkey") % 10 == 5, F.lit(None)).otherwise(F.col("segment"))).withColumn("generated", F.lit(2))
    return old, new


@query("""
SELECT change, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM (SELECT c_custkey, CASE WHEN c_custkey % 10 = 3 THEN 'insert' WHEN c_custkey % 10 = 7 THEN 'delete'
  WHEN c_custkey % 10 = 5 AND c_mktsegment IS NOT NULL THEN 'update' ELSE 'same' END AS change FROM customer) GROUP BY change
""")
def diff_changes(spark, sf_dir):
    """Kinds of change between two versions; one column does not count."""
    old, new = _versions(spark, sf_dir)
    return change.diff(old, new, ["c_custkey"], ignore=["generated"]).groupBy("change").agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))


@query("""
SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_custkey % 10 = 5 THEN NULL ELSE c_mktsegment END AS segment,
  CASE WHEN c_custkey % 10 = 3 OR (c_custkey % 10 = 5 AND c_mktsegment IS NOT NULL) THEN 2 ELSE 1 END AS generated FROM customer WHERE c_custkey % 10 <> 7
""")
def merge_mirror(spark, sf_dir):
    """The target after a merge that touches only changed rows and deletes missing ones."""
    old, new = _versions(spark, sf_dir)
    return change.merged(old, new, ["c_custkey"], ignore=["generated"])


@query("SELECT user_id, count(*) AS n, sum(value::DECIMAL(18,6))::DOUBLE AS total FROM events GROUP BY user_id")
def incremental_rebuild(spark, sf_dir):
    """Only keys with a change are computed again; the result is that of a full rebuild."""
    rows = events(spark, sf_dir, "event_id", "user_id", "value")
    total = lambda df: df.groupBy("user_id").agg(F.count("*").alias("n"), F.sum(F.col("value").cast(win.EXACT)).cast("double").alias("total"))
    before = total(rows.where("event_id % 97 <> 0"))
    touched = rows.where("event_id % 97 = 0").select("user_id").distinct()
    return change.rebuilt(before, lambda keys: total(rows.join(keys, "user_id", "left_semi")), touched, ["user_id"])


@query("""
SELECT l_orderkey, l_linenumber, 0.0 + l_quantity * 0.04 + l_tax * 4.0 + l_discount * -2.0 + (CASE WHEN l_quantity >= 300 THEN 3.0 ELSE 0.0 END) AS points FROM lineitem
""")
def custom_points(spark, sf_dir):
    """Points of a stat line under settings, as one expression."""
    rows = table(spark, sf_dir, "lineitem")
    named = {"passing_yards": F.col("l_quantity"), "passing_tds": F.col("l_tax"), "passing_interceptions": F.col("l_discount")}
    return rows.select("l_orderkey", "l_linenumber", scoring.points({"preset": "half", "bonus_pass_300": 3.0}, stats=named).alias("points"))


@query("""
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE floor(value) / 2 + (user_id % 3) * (CASE WHEN event_id % 2 = 0 THEN 1.0 ELSE 0.5 END) END::DOUBLE AS points FROM events
""")
def points_function(spark, sf_dir):
    """2.10, A15: per-row stats and settings as maps; null in, null out."""
    stat = F.when(F.col("event_id") % 5 != 0, F.create_map(F.lit("rushing_yards"), F.floor("value").cast("double"), F.lit("receptions"), (F.col("user_id") % 3).cast("double")))
    prices = F.create_map(F.lit("rec"), F.when(F.col("event_id") % 2 == 0, 1.0).otherwise(0.5), F.lit("rush_yd"), F.lit(0.5))
    return events(spark, sf_dir, "event_id", "user_id", "value").select("event_id", scoring.points_of_map(stat, prices).alias("points"))


@query()
def tier_groups(spark, sf_dir):
    """Best contiguous tiers of each group's first 24, with labels."""
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    ranked = win.top_k(orders, ["o_orderpriority"], 24, F.desc("o_totalprice"), "o_orderkey")
    tiered = tiers.add_tiers(ranked, ["o_orderpriority"], "o_totalprice", "o_orderkey")
    return tiered.withColumn("label", tiers.start_sit(F.lit("QB"), F.col("rank")))


@query("""
SELECT label, count(*) AS n FROM (SELECT CASE WHEN r <= 24 THEN 'Start' WHEN r <= 36 THEN 'Flex' ELSE 'Sit' END AS label FROM
(SELECT row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders)) GROUP BY label
""")
def start_sit(spark, sf_dir):
    """Labels by place."""
    # Labels depend on places alone, and places of n rows are 1 to n: counts suffice, no key is sorted.
    sizes = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    starters, flex = 2 * tiers.LEAGUE, 2 * tiers.LEAGUE + tiers.FLEX_DEPTH["RB"]
    upto = lambda k: F.least("n", F.lit(k))
    parts = [("Start", upto(starters)), ("Flex", upto(flex) - upto(starters)), ("Sit", F.col("n") - upto(flex))]
    labels = sizes.select(F.explode(F.array(*[F.struct(F.lit(name).alias("label"), n.alias("k")) for name, n in parts])).alias("p")).select("p.*")
    return labels.groupBy("label").agg(F.sum("k").alias("n")).where("n > 0")


@query("""
WITH p AS (SELECT c_custkey AS player_id, concat('Player ', c_custkey, CASE WHEN c_custkey % 5 = 0 THEN ' Jr.' ELSE '' END) AS player_name, ['QB', 'RB', 'WR', 'TE'][1 + c_custkey % 4] AS position,
  ['DET', 'GB', 'MIN'][1 + c_custkey % 3] AS team, c_acctbal FROM customer)
SELECT player_id, player_name, position, team, 80 + 0.5 * 6 + 0.0 AS score, 'prefix' AS reason FROM p WHERE team = 'DET' AND position = 'WR' ORDER BY c_acctbal DESC, player_name LIMIT 20
""")
def player_search(spark, sf_dir):
    """Names that match a query with a team and a position, best first, equal ones by relevance."""
    number = F.col("c_custkey")
    people = table(spark, sf_dir, "customer").select(
        number.alias("player_id"), F.concat(F.lit("Player "), number, F.when(number % 5 == 0, " Jr.").otherwise("")).alias("player_name"),
        F.element_at(F.array(*map(F.lit, ("QB", "RB", "WR", "TE"))), (number % 4 + 1).cast("int")).alias("position"),
        F.element_at(F.array(*map(F.lit, ("DET", "GB", "MIN"))), (number % 3 + 1).cast("int")).alias("team"), "c_acctbal",
    )
    return search.search(people, "player lions wr", F.col("c_acctbal"), 20).drop("c_acctbal")


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'st brown' WHEN c_custkey % 4 = 1 THEN 'harrison' WHEN c_custkey % 4 = 2 THEN 'walker' ELSE concat('customer', lpad(c_custkey::VARCHAR, 9, '0')) END AS surname,
  CASE c_custkey % 4 WHEN 0 THEN 'S' WHEN 1 THEN 'H' WHEN 2 THEN 'W' ELSE 'C' END AS letter FROM customer
""")
def surname_index(spark, sf_dir):
    """What names are filed under: a hyphen joins a first name, suffixes do not count, a single word is its own surname."""
    number = F.col("c_custkey") % 4
    name = F.when(number == 0, "Amon-Ra St. Brown").when(number == 1, "Marvin Harrison Jr.").when(number == 2, "Kenneth Walker III").otherwise(F.replace("c_name", F.lit("#"), F.lit("")))
    return table(spark, sf_dir, "customer").select("c_custkey", search.surname(name).alias("surname"), search.index_letter(name).alias("letter"))


@query("""
SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL
""")
def tumbling_windows(spark, sf_dir):
    """Beyond 2.9: counts by day windows, the batch form of the streamed operator."""
    rows = events(spark, sf_dir, "ts", "event_type")
    return rows.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), "event_type", "n")


@query("""
SELECT user_id, min(ts) AS started, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM
(SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > ts - INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s
""")
def session_windows(spark, sf_dir):
    """Beyond 2.9: sessions that end after six hours without an event."""
    rows = events(spark, sf_dir, "user_id", "ts")
    return rows.groupBy("user_id", F.session_window("ts", "6 hours")).agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("started"), "n")


@query("SELECT (SELECT count(*) FROM events) AS bronze, (SELECT count(*) FROM events) AS again")
def bronze_stream(spark, sf_dir):
    """A file stream into bronze; a second run finds nothing new."""
    # Landing, bronze and checkpoints lie beside each other on the shared store.
    base = work_dir(spark, "bronze")
    source = table(spark, sf_dir, "events")
    source.write.parquet(f"{base}/landing")
    counts = []
    for _ in range(2):
        ingest_new_files(spark, f"{base}/landing", source.schema, f"{base}/bronze", f"{base}/state")
        counts.append(spark.read.parquet(f"{base}/bronze").count())
    return spark.createDataFrame([tuple(counts)], "bronze long, again long")


from gaugework.plans import catalog_league, catalog_store  # noqa: E402, F401

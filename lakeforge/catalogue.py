"""The engine's queries over the driver tables, each beside its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .feeds import FEEDS
from .flows import FLOWS
from .models import MODELS
from .operators import loads, temporal, windows
from .products import PRODUCTS
from .reports import REPORTS
from .runs import RUNS
from .tables import TABLES


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def star_fact(spark, d):
    """Revenue by market segment and nation, with default keys for what is missing."""
    # Orders are summed by customer before they meet the dimensions.
    o = _t(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))
    c, n = _t(spark, d, "customer"), _t(spark, d, "nation")
    joined = o.join(c, o.o_custkey == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left")
    return joined.groupBy(F.coalesce("n_nationkey", F.lit(-1)).alias("nation_key"), F.coalesce("c_mktsegment", F.lit("unknown")).alias("segment")).agg(
        F.sum("n").alias("n_orders"), F.sum("total").cast("double").alias("total")
    )


def latest_order_per_customer(spark, d):
    o = _t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return windows.latest_per_key(o, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


def dedup_retain_one(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return windows.split_duplicates(li, ["l_orderkey", "l_linenumber"], "retain_one")[0]


def dedup_quarantine_all(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return windows.split_duplicates(li, ["l_orderkey", "l_linenumber"], "quarantine_all")[1]


def dominant_category(spark, d):
    o = _t(spark, d, "orders")
    return windows.dominant_category(o, "o_custkey", "o_orderpriority", F.col("o_totalprice").cast("decimal(18,2)")).withColumn("measure", F.col("measure").cast("double"))


def days_between_status(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = _t(spark, d, "events")
    return e.select("event_id", "user_id", "event_type", F.lag("event_type").over(w).alias("prev_type"), F.datediff("ts", F.lag("ts").over(w)).cast("long").alias("days"))


def asof_last_purchase(spark, d):
    e = _t(spark, d, "events").select("event_id", "user_id", "ts", "event_type").where("event_type IN ('view', 'purchase')")
    found = temporal.as_of_within(e, "user_id", "ts", F.col("event_type") == "purchase", "event_id", "purchase_id")
    return found.where("event_type = 'view'").select("event_id", "user_id", "purchase_id")


def temporal_versions(spark, d):
    e = _t(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    return temporal.versions(e, "user_id", "ts", "event_id").drop("ts")


def cdc_net_changes(spark, d):
    e = _t(spark, d, "events")
    op = F.when(F.col("event_type") == "error", "delete").when(F.col("event_type") == "signup", "insert").otherwise("update")
    return windows.net_changes(e.select("user_id", "event_id", "ts", op.alias("op")), ["user_id"], ["ts", "event_id"], "op").select("user_id", "event_id", "op", "is_deleted", "is_current")


def _halves(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return c.where("c_mktsegment <> 'BUILDING'"), c.where("c_mktsegment <> 'MACHINERY'").withColumn("c_mktsegment", F.lower("c_mktsegment"))


def _loaded(name):
    def query(spark, d):
        target, source = _halves(spark, d)
        return loads.load(name, target, source, ["c_custkey"])

    return query


def watermark_increment(spark, d):
    return _t(spark, d, "orders").where(F.col("o_orderdate") > F.lit("1998-01-01").cast("timestamp")).select("o_orderkey", "o_custkey")


def dq_reconciliation(spark, d):
    money = F.col("l_extendedprice").cast("decimal(18,2)")
    li = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(money).alias("lines"), F.count("*").alias("n_lines"))
    o = _t(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    both = o.join(li, o.o_orderkey == li.l_orderkey, "left")
    return both.select("o_orderkey", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce((F.col("lines") == F.col("price")).cast("int"), F.lit(0)).alias("dq_rule_001"))


def funnel_ratios(spark, d):
    def n(kind):
        return F.count_if(F.col("event_type") == kind)

    return _t(spark, d, "events").groupBy("user_id").agg(n("view").alias("views"), n("click").alias("clicks"), F.round(n("click") / F.nullif(n("view"), F.lit(0)), 6).alias("click_rate"))


def monthly_yoy(spark, d):
    """Orders by month beside those of the same month a year before: summed once, then a window over the months."""
    o = _t(spark, d, "orders").groupBy(F.year("o_orderdate").cast("long").alias("y"), F.month("o_orderdate").cast("long").alias("m")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("m").orderBy("y")
    return o.withColumn("prior_n", F.when(F.lag("y").over(w) == F.col("y") - 1, F.lag("n").over(w)))


def explode_delimited(spark, d):
    return _t(spark, d, "part").select("p_partkey", F.posexplode(F.split("p_type", " ")).alias("pos", "word")).select("p_partkey", F.col("pos").cast("long").alias("pos"), "word")


def union_distinct_keys(spark, d):
    return _t(spark, d, "orders").select(F.col("o_custkey").alias("custkey")).union(_t(spark, d, "customer").select("c_custkey")).distinct()


def _hot(spark, d):
    """Events, a third of which one user has."""
    return _t(spark, d, "events").withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 1).otherwise(F.col("user_id")).cast("long"))


def asof_hot_key(spark, d):
    """The last purchase before each view where one user has a third of all events: histories are cut into blocks of time."""
    e = _hot(spark, d).select("event_id", "user_id", "ts", "event_type").where("event_type IN ('view', 'purchase')")
    found = temporal.as_of_within(e, "user_id", "ts", F.col("event_type") == "purchase", "event_id", "purchase_id", blocks=16)
    return found.where("event_type = 'view'").select("event_id", "user_id", "purchase_id")


def versions_hot_key(spark, d):
    e = _hot(spark, d).select("user_id", "event_id", "event_type", "ts")
    return temporal.versions(e, "user_id", "ts", "event_id", blocks=16).drop("ts")


def dedup_hot_key(spark, d):
    """All rows of repeated keys where one key has a third of the rows: keys are summed first, rows of a repeated one are spread."""
    part = F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_partkey")).cast("long").alias("part")
    li = _t(spark, d, "lineitem").select(part, "l_suppkey", "l_orderkey", "l_linenumber")
    marked = windows.mark_duplicates(li, ["part", "l_suppkey"], "quarantine_all", salts=16)
    return marked.where("is_quarantined = 1").drop("is_quarantined")


_C = "SELECT c_custkey, c_name, c_mktsegment FROM customer"
_HOT = "(SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id, ts, event_type FROM events)"
_TARGET, _SOURCE = f"({_C} WHERE c_mktsegment <> 'BUILDING')", "(SELECT c_custkey, c_name, lower(c_mktsegment) AS c_mktsegment FROM customer WHERE c_mktsegment <> 'MACHINERY')"
_LI = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem"
_BY_KEY = f"SELECT * FROM {_SOURCE} UNION ALL SELECT * FROM {_TARGET} t WHERE t.c_custkey NOT IN (SELECT c_custkey FROM {_SOURCE})"

CATALOGUE: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "star_fact": (star_fact, "SELECT coalesce(n_nationkey, -1) AS nation_key, coalesce(c_mktsegment, 'unknown') AS segment, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2"),
    "latest_order_per_customer": (latest_order_per_customer, "SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"),
    "dedup_retain_one": (dedup_retain_one, f"{_LI} QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) = 1"),
    "dedup_quarantine_all": (dedup_quarantine_all, f"{_LI} QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1"),
    "dominant_category": (dominant_category, "SELECT o_custkey, o_orderpriority, CAST(m AS DOUBLE) AS measure FROM (SELECT o_custkey, o_orderpriority, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS m FROM orders GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY m DESC, o_orderpriority) = 1"),
    "days_between_status": (days_between_status, "SELECT event_id, user_id, event_type, lag(event_type) OVER w AS prev_type, date_diff('day', CAST(lag(ts) OVER w AS DATE), CAST(ts AS DATE)) AS days FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"),
    "asof_last_purchase": (asof_last_purchase, "SELECT v.event_id, v.user_id, (SELECT max_by(p.event_id, (p.ts, p.event_id)) FROM events p WHERE p.event_type = 'purchase' AND p.user_id = v.user_id AND p.ts <= v.ts) AS purchase_id FROM events v WHERE v.event_type = 'view'"),
    "temporal_versions": (temporal_versions, "SELECT user_id, event_id, event_type, ts AS valid_from, lead(ts) OVER w AS valid_to, CASE WHEN lead(ts) OVER w IS NULL THEN 1 ELSE 0 END AS is_current FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"),
    "cdc_net_changes": (cdc_net_changes, "SELECT user_id, event_id, CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'insert' ELSE 'update' END AS op, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_deleted, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS is_current FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"),
    "append": (_loaded("append"), f"SELECT * FROM {_TARGET} UNION ALL SELECT * FROM {_SOURCE}"),
    "append_new": (_loaded("append_new"), f"SELECT * FROM {_TARGET} UNION ALL SELECT * FROM {_SOURCE} s WHERE s.c_custkey NOT IN (SELECT c_custkey FROM {_TARGET})"),
    "overwrite_by_key": (_loaded("overwrite_by_key"), _BY_KEY),
    "merge": (_loaded("merge"), _BY_KEY),
    "watermark_increment": (watermark_increment, "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'"),
    "dq_reconciliation": (dq_reconciliation, "SELECT o_orderkey, coalesce(n_lines, 0) AS n_lines, CASE WHEN lines = CAST(o_totalprice AS DECIMAL(18,2)) THEN 1 ELSE 0 END AS dq_rule_001 FROM orders LEFT JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS lines, count(*) AS n_lines FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey"),
    "funnel_ratios": (funnel_ratios, "SELECT user_id, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'click') AS clicks, round(count(*) FILTER (event_type = 'click') / nullif(count(*) FILTER (event_type = 'view'), 0), 6) AS click_rate FROM events GROUP BY 1"),
    "monthly_yoy": (monthly_yoy, "WITH o AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1, 2) SELECT o.y, o.m, o.n, p.n AS prior_n FROM o LEFT JOIN o p ON p.y + 1 = o.y AND p.m = o.m"),
    "explode_delimited": (explode_delimited, "SELECT p_partkey, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS word FROM (SELECT p_partkey, string_split(p_type, ' ') AS w FROM part)"),
    "asof_hot_key": (asof_hot_key, f"SELECT event_id, user_id, purchase_id FROM (SELECT *, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_type, event_id) AS purchase_id FROM {_HOT} WHERE event_type IN ('view', 'purchase')) WHERE event_type = 'view'"),
    "versions_hot_key": (versions_hot_key, f"SELECT user_id, event_id, event_type, ts AS valid_from, lead(ts) OVER w AS valid_to, CASE WHEN lead(ts) OVER w IS NULL THEN 1 ELSE 0 END AS is_current FROM {_HOT} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"),
    "dedup_hot_key": (dedup_hot_key, "SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS part, l_suppkey, l_orderkey, l_linenumber FROM lineitem QUALIFY count(*) OVER (PARTITION BY CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END, l_suppkey) > 1"),
    "union_distinct_keys": (union_distinct_keys, "SELECT o_custkey AS custkey FROM orders UNION SELECT c_custkey FROM customer"),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, (f, _) in (CATALOGUE | MODELS | FLOWS | TABLES | PRODUCTS | RUNS | REPORTS | FEEDS).items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for k, (_, s) in (CATALOGUE | MODELS | FLOWS | TABLES | PRODUCTS | RUNS | REPORTS | FEEDS).items()}

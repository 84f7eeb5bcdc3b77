"""More queries over the driver tables: dimensional models, loads, quality, windows of time."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from . import functions as X
from . import plans, streaming
from .operators import governance, loads, quality, temporal, windows

#: Times of the two loads of scd2_two_batches.
FIRST, SECOND = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def _t(spark, d, name):
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def _ts(text):
    return F.lit(text).cast("timestamp")


def normalized_key_join(spark, d):
    """Customers find their nation by its name, typed in several ways; some are misspelt and find none."""
    n = _t(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    k = F.col("c_custkey")
    typed = F.when(k % 4 == 0, F.concat(F.lit("  "), F.lower("n_name"))).when(k % 4 == 1, F.concat(F.initcap("n_name"), F.lit(" "))).when(k % 4 == 2, F.col("n_name")).otherwise(F.concat(F.col("n_name"), F.lit("x")))
    c = _t(spark, d, "customer").join(n, F.col("c_nationkey") == n.n_nationkey).select("c_custkey", typed.alias("typed"))
    return c.join(n, X.norm_key(c.typed) == X.norm_key(n.n_name)).select("c_custkey", "n_nationkey", "n_name", "n_regionkey")


def composite_case_key_lookup(spark, d):
    p = _t(spark, d, "part").select("p_partkey", "p_size", F.when(F.col("p_size") < 10, "small").when(F.col("p_size") < 30, "middle").otherwise("large").alias("band"), F.substring("p_brand", 7, 1).alias("line"))
    dim = spark.sql("SELECT * FROM VALUES (1, 'small', '1'), (2, 'small', '2'), (3, 'middle', '1'), (4, 'middle', '3'), (5, 'large', '5') AS dim(size_key, band, line)")
    return p.join(dim, ["band", "line"], "left").select("p_partkey", X.default_key(F.col("size_key")).alias("size_key"))


def unified_quarantine_view(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return windows.mark_duplicates(li, ["l_orderkey", "l_linenumber"], "quarantine_all")


def prev_event_self_join(spark, d):
    e = _t(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    by = ["user_id"], ["ts", "event_id"]
    return windows.previous(windows.numbered(e, *by, "rcount"), *by, "event_type", "prev_type").select("event_id", "rcount", "prev_type")


def _signups(spark, d):
    e = _t(spark, d, "events").where("event_type = 'signup'").select("user_id", "event_id", "ts")
    return temporal.versions(e, "user_id", "ts", "event_id").select("user_id", F.col("event_id").alias("version_id"), "valid_from", "valid_to")


def temporal_dim_lookup(spark, d):
    facts = _t(spark, d, "events").where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return temporal.version_at(facts, _signups(spark, d), "user_id", "ts", "version_id", latest_if_none=False, blocks=16).select("event_id", "version_id")


def late_fact_fallback(spark, d):
    facts = _t(spark, d, "events").where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return temporal.version_at(facts, _signups(spark, d), "user_id", "ts", "version_id", latest_if_none=True).select("event_id", "version_id")


def _net(events):
    op = F.when(F.col("event_type") == "error", "delete").when(F.col("event_type") == "signup", "insert").otherwise("update")
    return windows.net_changes(events.select("user_id", "event_id", "ts", op.alias("op")), ["user_id"], ["ts", "event_id"], "op")


def cdc_apply(spark, d):
    """The changes of two halves applied one after the other; a deleted user keeps the last values before it."""
    e = _t(spark, d, "events")
    target = _net(e.where("event_id % 2 = 0")).select("user_id", "event_id", "is_deleted", "is_current")
    return loads.cdc_apply(target, _net(e.where("event_id % 2 = 1")).select("user_id", "event_id", "op"), ["user_id"], keep_unknown_deletes=True)


def _customers(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    changed = F.when(F.col("c_mktsegment") == "FURNITURE", F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    return c.where("c_mktsegment <> 'BUILDING'"), c.where("c_mktsegment <> 'MACHINERY'").withColumn("c_mktsegment", changed)


def merge_hash_guard(spark, d):
    def hashed(df, stamp):
        return df.withColumn("dl_rowhash", X.row_hash(["c_name", "c_mktsegment"])).withColumn("dl_createddateutc", F.lit(stamp))

    target, source = _customers(spark, d)
    return loads.merge_guarded(hashed(target, "first"), hashed(source, "second"), ["c_custkey"]).drop("dl_rowhash")


def scd2_two_batches(spark, d):
    target, source = _customers(spark, d)
    target = target.select("*", _ts(FIRST).alias("active_start"), F.lit(None).cast("timestamp").alias("active_end"), F.lit(1).alias("is_current"))
    return loads.scd2(target, source, ["c_custkey"], ["c_name", "c_mktsegment"], _ts(SECOND))


def source_deletions(spark, d):
    target, source = _customers(spark, d)
    return loads.capture_deletions(target, source, ["c_custkey"])


def type_two_identity_unknown(spark, d):
    n = plans.with_identity(_t(spark, d, "nation").select("n_nationkey", "n_name"), "nation_sk", ["n_nationkey"])
    return plans.with_unknown(n, {"nation_sk": -1, "n_nationkey": -1, "n_name": "unknown"})


def composite_watermark(spark, d):
    o = _t(spark, d, "orders").withColumn("updated", F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")))
    return o.agg(F.max(F.coalesce("updated", "o_orderdate")).alias("dl_watermark"))


def _rules():
    return {"discount": F.col("l_discount") <= 0.05, "status": F.col("l_linestatus").isin("O", "F"), "cross": (F.col("l_returnflag") != "R") | (F.col("l_linestatus") == "F")}


def dq_flags(spark, d):
    return quality.with_rules(_t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_linestatus", "l_returnflag"), _rules())


def dq_summary(spark, d):
    return quality.summary(_t(spark, d, "lineitem"), _rules())


def bucket_counts(spark, d):
    kind = X.decision_list([(F.col("value") < 10, "low"), (F.col("value") < 100, "middle")], "high")
    return _t(spark, d, "events").groupBy(F.hour("ts").cast("long").alias("hour"), kind.alias("bucket")).agg(F.count("*").alias("n"))


def customer_360(spark, d):
    o = _t(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.collect_set("o_orderpriority").alias("own"), F.max("o_orderdate").alias("last_order"))
    c = _t(spark, d, "customer")
    tier = X.decision_list([(F.col("n_orders") >= 20, "gold"), (F.col("n_orders") >= 10, "silver"), (F.col("n_orders") >= 1, "plain")], "none")
    return c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), F.when(F.col("own").isNotNull(), F.size("own")).cast("long").alias("n_priorities"), F.array_join(F.array_sort("own"), ", ").alias("priorities"), "last_order", tier.alias("tier"))


def in_force_book(spark, d):
    o = _t(spark, d, "orders").withColumn("ends", F.when(F.col("o_orderstatus") != "O", F.add_months("o_orderdate", 12).cast("timestamp")))
    day = _ts("1998-01-01")
    return o.where((F.col("o_orderdate") <= day) & (F.col("ends").isNull() | (F.col("ends") >= day))).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


def ytd_r12_prior(spark, d):
    at = F.col("o_orderdate")

    def n(lo, hi):
        return F.count_if((at >= _ts(lo)) & (at < _ts(hi)))

    o = _t(spark, d, "orders")
    return o.groupBy("o_orderstatus").agg(n("1998-01-01", "1998-07-01").alias("ytd"), n("1997-07-01", "1998-07-01").alias("r12"), n("1997-01-01", "1997-07-01").alias("prior_ytd"))


def status_decision_list(spark, d):
    s, p, v = F.col("o_orderstatus"), X.norm_key(F.col("o_orderpriority")), F.col("o_totalprice")
    rules = [((s == "F") & (v > 200000), "closed - large"), (s == "F", "closed"), ((s == "O") & p.isin("1-urgent", "2-high"), "open - hurry"), ((s == "O") & p.startswith("5"), "open - low"), (s == "O", "open")]
    return _t(spark, d, "orders").select("o_orderkey", X.decision_list(rules, "other").alias("status"))


def union_archive(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    live, archive = o.where(F.col("o_orderdate") >= _ts("1998-01-01")), o.where(F.col("o_orderdate") < _ts("1998-01-01"))
    return live.withColumn("origin", F.lit("live")).unionByName(archive.withColumn("origin", F.lit("archive")))


def json_props_extract(spark, d):
    props = F.from_json("props", "map<string,string>")
    return _t(spark, d, "events").select("event_id", props.getItem("k").cast("long").alias("k"))


def row_hash(spark, d):
    return _t(spark, d, "customer").select("c_custkey", X.row_hash(["c_name", "c_mktsegment"]).alias("dl_rowhash"))


def safe_columns_by_table(spark, d):
    """A catalogue of columns made of the parts: brands as tables, sizes as columns; a column with a dear part is closed, one without a level too."""
    level = F.when(F.max("p_retailprice") > 1500, "CD3").when(F.max("p_retailprice") > 1000, "CD2").when(F.max("p_retailprice") > 950, "CD1")
    catalog = _t(spark, d, "part").groupBy(F.col("p_brand").alias("table_name"), F.concat(F.lit("c"), F.lpad(F.col("p_size").cast("string"), 2, "0")).alias("column_name")).agg(level.alias("cd_level"))
    return governance.safe_columns(catalog).withColumn("columns", F.array_join("columns", ","))


def secured_rows(spark, d):
    return governance.secured(_t(spark, d, "customer"), ["c_custkey", "c_mktsegment"], "c_nationkey < 10")


def inline_status_hierarchy(spark, d):
    dim = spark.sql("SELECT * FROM VALUES ('O', 'open', 'active'), ('F', 'filled', 'done'), ('P', 'pending', 'active') AS v(code, l1, l0)")
    o = _t(spark, d, "orders")
    return o.join(dim, o.o_orderstatus == dim.code, "left").groupBy(F.coalesce("l0", F.lit("unknown")).alias("l0"), F.coalesce("l1", F.lit("unknown")).alias("l1")).agg(F.count("*").alias("n"))


def pivot_status(spark, d):
    return _t(spark, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1))).na.fill(0)


def first_value_per_user(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return _t(spark, d, "events").select("event_id", F.first("event_type").over(w).alias("first_type"))


def transform_steps(spark, d):
    """Three queries, each over the ones before."""
    sources = {n: (lambda own, n=n: own.read.parquet(f"{d.rstrip('/')}/{n}.parquet")) for n in ("orders", "customer")}
    steps = [
        ("spent", "SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY o_custkey"),
        ("joined", "SELECT c_mktsegment, total FROM customer LEFT JOIN spent ON c_custkey = o_custkey"),
        ("final", "SELECT c_mktsegment AS segment, count(*) AS n, CAST(sum(total) AS DOUBLE) AS total FROM joined GROUP BY c_mktsegment"),
    ]
    return plans.run_queries(spark, sources, steps)


def tumbling_events(spark, d):
    return streaming.windowed(_t(spark, d, "events"), "ts", "1 hour", by=["event_type"]).drop("window_end")


def sliding_events(spark, d):
    return streaming.windowed(_t(spark, d, "events"), "ts", "2 hours", "1 hour", by=["event_type"]).drop("window_end")


def sessionized_events(spark, d):
    return streaming.sessions(_t(spark, d, "events"), "ts", "30 minutes", ["user_id"])


_NET = "SELECT user_id, event_id, event_type = 'error' AS gone FROM events WHERE event_id % 2 = {} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
_C = "SELECT c_custkey, c_name, c_mktsegment FROM customer"
_T, _S = f"({_C} WHERE c_mktsegment <> 'BUILDING')", "(SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'FURNITURE' THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_mktsegment <> 'MACHINERY')"
_DIM = "(SELECT user_id, event_id AS version_id, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM events WHERE event_type = 'signup')"
_AT = f"SELECT f.event_id, {{}} AS version_id FROM events f LEFT JOIN {_DIM} v ON v.user_id = f.user_id AND f.ts >= v.valid_from AND (f.ts < v.valid_to OR v.valid_to IS NULL) LEFT JOIN (SELECT * FROM {_DIM} WHERE valid_to IS NULL) l ON l.user_id = f.user_id WHERE f.event_type = 'purchase'"
_FLAGS = {"discount": "l_discount <= 0.05", "status": "l_linestatus IN ('O', 'F')", "cross": "l_returnflag <> 'R' OR l_linestatus = 'F'"}

MODELS = {
    "normalized_key_join": (normalized_key_join, "SELECT c_custkey, n_nationkey, n_name, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 4 <> 3"),
    "composite_case_key_lookup": (composite_case_key_lookup, "SELECT p_partkey, coalesce(size_key, -1) AS size_key FROM part LEFT JOIN (VALUES (1, 'small', '1'), (2, 'small', '2'), (3, 'middle', '1'), (4, 'middle', '3'), (5, 'large', '5')) AS dim(size_key, band, line) ON line = substr(p_brand, 7, 1) AND band = CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'middle' ELSE 'large' END"),
    "unified_quarantine_view": (unified_quarantine_view, "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 THEN 1 ELSE 0 END AS is_quarantined FROM lineitem"),
    "prev_event_self_join": (prev_event_self_join, "SELECT event_id, row_number() OVER w AS rcount, lag(event_type) OVER w AS prev_type FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"),
    "temporal_dim_lookup": (temporal_dim_lookup, _AT.format("v.version_id")),
    "late_fact_fallback": (late_fact_fallback, _AT.format("coalesce(v.version_id, l.version_id)")),
    "cdc_apply": (cdc_apply, f"SELECT coalesce(t.user_id, c.user_id) AS user_id, CASE WHEN c.user_id IS NOT NULL AND (NOT c.gone OR t.user_id IS NULL) THEN c.event_id ELSE t.event_id END AS event_id, CASE WHEN coalesce(c.gone, t.gone) THEN 1 ELSE 0 END AS is_deleted, CASE WHEN coalesce(c.gone, t.gone) THEN 0 ELSE 1 END AS is_current FROM ({_NET.format(0)}) t FULL JOIN ({_NET.format(1)}) c ON t.user_id = c.user_id"),
    "merge_hash_guard": (merge_hash_guard, f"SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, coalesce(s.c_name, t.c_name) AS c_name, coalesce(s.c_mktsegment, t.c_mktsegment) AS c_mktsegment, CASE WHEN t.c_custkey IS NULL THEN 'second' ELSE 'first' END AS dl_createddateutc, CASE WHEN t.c_custkey IS NULL THEN 'I' WHEN s.c_mktsegment <> t.c_mktsegment THEN 'U' ELSE 'K' END AS dl_action FROM {_T} t FULL JOIN {_S} s ON t.c_custkey = s.c_custkey"),
    "scd2_two_batches": (scd2_two_batches, f"SELECT t.c_custkey, t.c_name, t.c_mktsegment, TIMESTAMP '{FIRST}' AS active_start, CASE WHEN s.c_mktsegment <> t.c_mktsegment THEN TIMESTAMP '{SECOND}' END AS active_end, CASE WHEN s.c_mktsegment <> t.c_mktsegment THEN 0 ELSE 1 END AS is_current FROM {_T} t LEFT JOIN {_S} s ON t.c_custkey = s.c_custkey UNION ALL SELECT s.c_custkey, s.c_name, s.c_mktsegment, TIMESTAMP '{SECOND}', NULL, 1 FROM {_S} s LEFT JOIN {_T} t ON t.c_custkey = s.c_custkey WHERE t.c_custkey IS NULL OR s.c_mktsegment <> t.c_mktsegment"),
    "source_deletions": (source_deletions, f"SELECT c_custkey FROM {_T} WHERE c_custkey NOT IN (SELECT c_custkey FROM {_S})"),
    "type_two_identity_unknown": (type_two_identity_unknown, "SELECT n_nationkey, n_name, row_number() OVER (ORDER BY n_nationkey) AS nation_sk FROM nation UNION ALL SELECT -1, 'unknown', -1"),
    "composite_watermark": (composite_watermark, "SELECT max(coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAYS END, o_orderdate)) AS dl_watermark FROM orders"),
    "dq_flags": (dq_flags, "SELECT l_orderkey, l_linenumber, l_partkey, l_discount, l_linestatus, l_returnflag, " + ", ".join(f"CASE WHEN {v} THEN 1 ELSE 0 END AS dq_{k}" for k, v in _FLAGS.items()) + " FROM lineitem"),
    "dq_summary": (dq_summary, "SELECT count(*) AS n_rows, " + ", ".join(f"count(*) FILTER (NOT coalesce({v}, false)) AS broken_{k}" for k, v in _FLAGS.items()) + " FROM lineitem"),
    "bucket_counts": (bucket_counts, "SELECT hour(ts) AS hour, CASE WHEN value < 10 THEN 'low' WHEN value < 100 THEN 'middle' ELSE 'high' END AS bucket, count(*) AS n FROM events GROUP BY 1, 2"),
    "customer_360": (customer_360, "SELECT c_custkey, coalesce(n_orders, 0) AS n_orders, n_priorities, priorities, last_order, CASE WHEN n_orders >= 20 THEN 'gold' WHEN n_orders >= 10 THEN 'silver' WHEN n_orders >= 1 THEN 'plain' ELSE 'none' END AS tier FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, count(DISTINCT o_orderpriority) AS n_priorities, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities, max(o_orderdate) AS last_order FROM orders GROUP BY 1) ON o_custkey = c_custkey"),
    "in_force_book": (in_force_book, "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01' AND (o_orderstatus = 'O' OR CAST(CAST(o_orderdate AS DATE) + INTERVAL 12 MONTHS AS TIMESTAMP) >= TIMESTAMP '1998-01-01') GROUP BY 1"),
    "ytd_r12_prior": (ytd_r12_prior, "SELECT o_orderstatus, count(*) FILTER (o_orderdate >= '1998-01-01' AND o_orderdate < '1998-07-01') AS ytd, count(*) FILTER (o_orderdate >= '1997-07-01' AND o_orderdate < '1998-07-01') AS r12, count(*) FILTER (o_orderdate >= '1997-01-01' AND o_orderdate < '1997-07-01') AS prior_ytd FROM orders GROUP BY 1"),
    "status_decision_list": (status_decision_list, "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 200000 THEN 'closed - large' WHEN o_orderstatus = 'F' THEN 'closed' WHEN o_orderstatus = 'O' AND lower(trim(o_orderpriority)) IN ('1-urgent', '2-high') THEN 'open - hurry' WHEN o_orderstatus = 'O' AND o_orderpriority LIKE '5%' THEN 'open - low' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'other' END AS status FROM orders"),
    "union_archive": (union_archive, "SELECT o_orderkey, o_custkey, o_orderdate, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'live' ELSE 'archive' END AS origin FROM orders"),
    "json_props_extract": (json_props_extract, "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"),
    "row_hash": (row_hash, "SELECT c_custkey, sha256('v' || replace(c_mktsegment, '|', '||') || '|:v' || replace(c_name, '|', '||')) AS dl_rowhash FROM customer"),
    "safe_columns_by_table": (safe_columns_by_table, "SELECT table_name, string_agg(column_name, ',' ORDER BY column_name) AS columns FROM (SELECT p_brand AS table_name, 'c' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS column_name, max(p_retailprice) AS m FROM part GROUP BY 1, 2) WHERE m > 950 AND m <= 1500 GROUP BY 1"),
    "secured_rows": (secured_rows, "SELECT c_custkey, c_mktsegment FROM customer WHERE c_nationkey < 10"),
    "inline_status_hierarchy": (inline_status_hierarchy, "SELECT coalesce(l0, 'unknown') AS l0, coalesce(l1, 'unknown') AS l1, count(*) AS n FROM orders LEFT JOIN (VALUES ('O', 'open', 'active'), ('F', 'filled', 'done'), ('P', 'pending', 'active')) AS v(code, l1, l0) ON o_orderstatus = code GROUP BY 1, 2"),
    "pivot_status": (pivot_status, 'SELECT o_orderpriority, count(*) FILTER (o_orderstatus = \'F\') AS "F", count(*) FILTER (o_orderstatus = \'O\') AS "O", count(*) FILTER (o_orderstatus = \'P\') AS "P" FROM orders GROUP BY 1'),
    "first_value_per_user": (first_value_per_user, "SELECT event_id, first_value(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS first_type FROM events"),
    "transform_steps": (transform_steps, "SELECT c_mktsegment AS segment, count(*) AS n, CAST(sum(total) AS DOUBLE) AS total FROM customer LEFT JOIN (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY 1) ON c_custkey = o_custkey GROUP BY 1"),
    "tumbling_events": (tumbling_events, "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2"),
    "sliding_events": (sliding_events, "SELECT time_bucket(INTERVAL 1 HOUR, ts) - back * INTERVAL 1 HOUR AS window_start, event_type, count(*) AS n FROM events CROSS JOIN (VALUES (0), (1)) AS v(back) GROUP BY 1, 2"),
    "sessionized_events": (sessionized_events, "SELECT min(ts) AS session_start, user_id, count(*) AS n FROM (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s"),
}

"""Queries that run through stored tables: loads of touched files, metrics, changes, layouts. Each stands beside its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from .operators import loads, windows
from .scratch import fresh_folder
from .store import TableStore, incremental

THEN, NOW = "2024-01-01 00:00:00", "2024-03-01 00:00:00"


def _t(spark, d, name):
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def _at(text):
    return F.lit(text).cast("timestamp")


def _store(spark) -> TableStore:
    return TableStore(spark, fresh_folder(spark, "tables"))


def _customers(spark, d):
    """A target without one segment, and a batch of those and of changed rows."""
    c = _t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    tools = F.when(F.col("c_mktsegment") == "MACHINERY", "TOOLS").otherwise(F.col("c_mktsegment"))
    return c.where("c_mktsegment <> 'BUILDING'"), c.where("c_mktsegment IN ('BUILDING', 'MACHINERY')").withColumn("c_mktsegment", tools)


def partitioned_overwrite(spark, d):
    """A table by nation, whose keys are strings such as 007, replaced once; its types stay."""
    store = _store(spark)
    c = _t(spark, d, "customer").select("c_custkey", F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("nation"), "c_acctbal")
    store.load("customer", "overwrite", c.where("c_acctbal < 0"), ["c_custkey"], partition_by=["nation"])
    store.load("customer", "overwrite", c, ["c_custkey"], partition_by=["nation"])
    return store.read("customer")


def restored_version(spark, d):
    store = _store(spark)
    target, batch = _customers(spark, d)
    store.load("customer", "overwrite", target, ["c_custkey"])
    store.load("customer", "merge", batch, ["c_custkey"])
    store.restore("customer", 0)
    return store.read("customer")


def stored_merge(spark, d):
    """A batch merged into a table laid out by its key: files without a key of the batch stay as they are."""
    store = _store(spark)
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    late = F.col("o_orderdate") >= _at("1998-01-01")
    store.load("orders", "overwrite", o.where(~late | (F.col("o_orderstatus") != "P")), ["o_orderkey"], cluster_by=["o_orderkey"])
    store.load("orders", "merge", o.where(late).withColumn("o_orderstatus", F.lower("o_orderstatus")), ["o_orderkey"], changed=["o_orderstatus"])
    return store.read("orders")


def stored_delete(spark, d):
    """UPDATE and DELETE of rows by a condition."""
    store = _store(spark)
    store.load("orders", "overwrite", _t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate"), ["o_orderkey"], cluster_by=["o_orderdate"])
    store.change_where("orders", F.col("o_orderdate") < F.lit("1995-01-01"), None, {"o_orderdate": (None, "1995-01-01")})
    store.change_where("orders", F.col("o_orderstatus") == "P", {"o_orderstatus": F.lit("pending")})
    return store.read("orders")


def _net(events):
    """The last change of each user; those of every twentieth user have no key."""
    op = F.when(F.col("event_type") == "error", "delete").otherwise("update")
    k = F.when(F.col("user_id") % 20 != 3, F.col("user_id")).alias("k")
    return windows.net_changes(events.select(k, "event_id", "ts", F.col("event_type").alias("h"), op.alias("op")), ["k"], ["ts", "event_id"], "op")


def _cdc(spark, d):
    e = _t(spark, d, "events")
    target = _net(e.where("event_id % 2 = 0")).select("k", "event_id", "h", "is_deleted", "is_current", _at(THEN).alias("modified"))
    return target, _net(e.where("event_id % 2 = 1")).select("k", "event_id", "h", "op")


def cdc_edges(spark, d):
    """Changes with a null key, deletes of unknown and of deleted keys, equal hashes, and the time of change."""
    return loads.cdc_apply(*_cdc(spark, d), ["k"], hash_column="h", modified="modified", now=_at(NOW))


def _history(spark, d):
    """A history of customers, some of whose rows are past or don't say, one without a key; and a full batch with changes."""
    c = _t(spark, d, "customer").select(F.when(F.col("c_custkey") != 1, F.col("c_custkey")).alias("k"), F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("of"))
    current = F.when(F.col("of") % 10 == 2, None).when(F.col("of") % 10 == 3, 0).otherwise(1)
    target = c.where("of % 10 <> 4").select("k", "segment", _at(THEN).alias("active_start"), F.lit(None).cast("timestamp").alias("active_end"), current.cast("int").alias("is_current"))
    changed = F.when(F.col("segment") == "FURNITURE", F.lower("segment")).otherwise(F.col("segment"))
    return target, c.where("of % 10 <> 5").select("k", changed.alias("segment"))


def scd2_edges(spark, d):
    target, batch = _history(spark, d)
    return loads.scd2(target, batch, ["k"], ["segment"], _at(NOW))


def load_metrics(spark, d):
    """What loads counted as they wrote: inserted, updated and deleted rows by table and version."""
    store = _store(spark)
    target, batch = _customers(spark, d)
    for table, strategy, options in (("merged", "merge", {"changed": ["c_mktsegment"]}), ("replaced", "overwrite_by_key", {}), ("added", "append_new", {})):
        store.load(table, "overwrite", target, ["c_custkey"])
        store.load(table, strategy, batch, ["c_custkey"], **options)
    changes = _cdc(spark, d)
    store.load("changed", "overwrite", changes[0], ["k"])
    store.load("changed", "cdc_apply", changes[1], ["k"], hash_column="h", modified="modified", now=_at(NOW))
    history = _history(spark, d)
    store.load("versions", "overwrite", history[0], ["k"])
    store.load("versions", "scd2", history[1], ["k"], columns=["segment"], now=_at(NOW))
    parts = [store.history(t).select(F.lit(t).alias("table_name"), "version", "operation", "rows", *[F.col("metrics").getItem(m).alias(m) for m in ("inserted", "updated", "deleted")]) for t in ("merged", "replaced", "added", "changed", "versions")]
    return reduce(lambda a, b: a.unionByName(b), parts)


def change_feed(spark, d):
    """What a merge and a delete changed since the first version."""
    store = _store(spark)
    target, batch = _customers(spark, d)
    store.load("customer", "overwrite", target, ["c_custkey"])
    store.load("customer", "merge", batch, ["c_custkey"])
    store.change_where("customer", F.col("c_custkey") % 5 == 0, None)
    return store.changes("customer", 0)


def incremental_source(spark, d):
    """Order values by customer, kept from what changed in orders: two batches, of which the second changes rows of the first."""
    store = _store(spark)
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))

    def changed(found):
        return found["orders"].select("o_orderkey", "o_custkey", "price", F.col("_change").alias("how"))

    def run():
        return incremental(store, "prices", ["orders"], changed, "prices", "merge", ["o_orderkey"])

    store.load("orders", "overwrite", o.where("o_orderkey % 3 <> 0"), ["o_orderkey"])
    run()
    store.load("orders", "merge", o.where("o_orderkey % 3 <> 1").withColumn("price", F.col("price") + F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(0)), ["o_orderkey"])
    run()
    run()  # nothing has changed since
    return store.read("prices").withColumn("price", F.col("price").cast("double"))


def clustered_range(spark, d):
    """A range of two columns through a table laid out by both; files beyond it aren't read."""
    store = _store(spark)
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    store.load("lineitem", "overwrite", li, [], cluster_by=["l_shipdate", "l_partkey"])
    return store.read("lineitem", ranges={"l_shipdate": ("1996-01-01", "1996-06-30"), "l_partkey": (100, 400)})


_C = "SELECT c_custkey, c_name, c_mktsegment FROM customer"
_TARGET = f"({_C} WHERE c_mktsegment <> 'BUILDING')"
_EVENTS = """SELECT k, event_id, h, h = 'error' AS gone FROM (SELECT CASE WHEN user_id % 20 <> 3 THEN user_id END AS k, event_id, ts, event_type AS h FROM events WHERE event_id % 2 = {})
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY ts DESC, event_id DESC) = 1"""
_SIDES = f"""t AS (SELECT *, true AS t FROM ({_EVENTS.format(0)})), c AS (SELECT *, true AS c FROM ({_EVENTS.format(1)})),
b AS (SELECT coalesce(t.k, c.k) AS k, CASE WHEN t IS NULL THEN 'I' WHEN c IS NULL THEN 'K' WHEN c.gone AND NOT t.gone THEN 'D' WHEN NOT c.gone AND (t.gone OR t.h <> c.h) THEN 'U' ELSE 'K' END AS what,
    t.event_id AS te, c.event_id AS ce, t.h AS th, c.h AS ch, coalesce(c.gone, t.gone) AS gone
    FROM t FULL JOIN c ON t.k IS NOT DISTINCT FROM c.k WHERE t IS NOT NULL OR NOT c.gone)"""
_PAST = f"""w AS (SELECT CASE WHEN c_custkey <> 1 THEN c_custkey END AS k, c_mktsegment AS segment, c_custkey AS o,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN lower(c_mktsegment) ELSE c_mktsegment END AS new FROM customer),
v AS (SELECT k, segment, TIMESTAMP '{THEN}' AS active_start, CASE WHEN o % 10 NOT IN (2, 3, 5) AND segment <> new THEN TIMESTAMP '{NOW}' END AS active_end,
        CASE WHEN o % 10 = 2 THEN NULL WHEN o % 10 = 3 THEN 0 WHEN o % 10 <> 5 AND segment <> new THEN 0 ELSE 1 END AS is_current, o, false AS fresh FROM w WHERE o % 10 <> 4
    UNION ALL SELECT k, new, TIMESTAMP '{NOW}', NULL, 1, o, true FROM w WHERE o % 10 <> 5 AND (o % 10 IN (2, 3, 4) OR segment <> new))"""

TABLES = {
    "partitioned_overwrite": (partitioned_overwrite, "SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS nation, c_acctbal FROM customer"),
    "restored_version": (restored_version, f"SELECT * FROM {_TARGET}"),
    "stored_merge": (stored_merge, "SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN lower(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus, o_orderdate FROM orders"),
    "stored_delete": (stored_delete, "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE o_orderstatus END AS o_orderstatus, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01'"),
    "cdc_edges": (
        cdc_edges,
        f"""WITH {_SIDES} SELECT k, CASE WHEN what IN ('I', 'U') THEN ce ELSE te END AS event_id, CASE WHEN what IN ('I', 'U') THEN ch ELSE th END AS h,
        CASE WHEN gone THEN 1 ELSE 0 END AS is_deleted, CASE WHEN gone THEN 0 ELSE 1 END AS is_current, CASE WHEN what = 'K' THEN TIMESTAMP '{THEN}' ELSE TIMESTAMP '{NOW}' END AS modified FROM b""",
    ),
    "scd2_edges": (scd2_edges, f"WITH {_PAST} SELECT k, segment, active_start, active_end, is_current FROM v"),
    "load_metrics": (
        load_metrics,
        f"""WITH {_SIDES}, {_PAST}, n AS (SELECT count(*) AS n, count(*) FILTER (c_mktsegment = 'BUILDING') AS new, count(*) FILTER (c_mktsegment = 'MACHINERY') AS old FROM customer),
        m AS (SELECT (SELECT count(*) FROM t) AS before, count(*) AS n, count(*) FILTER (what = 'I') AS i, count(*) FILTER (what = 'U') AS u, count(*) FILTER (what = 'D') AS d FROM b),
        h AS (SELECT count(*) AS n, count(*) FILTER (fresh) AS fresh, count(*) FILTER (NOT fresh AND active_end IS NOT NULL) AS ended FROM v)
        SELECT * FROM (SELECT unnest(['merged', 'replaced', 'added']) AS table_name, 0 AS version, 'overwrite' AS operation, n - new AS rows, n - new AS inserted, 0 AS updated, 0 AS deleted FROM n)
        UNION ALL SELECT 'merged', 1, 'merge', n, new, old, 0 FROM n UNION ALL SELECT 'replaced', 1, 'overwrite_by_key', n, new + old, 0, old FROM n
        UNION ALL SELECT 'added', 1, 'append_new', n, new, 0, 0 FROM n UNION ALL SELECT 'changed', 0, 'overwrite', before, before, 0, 0 FROM m
        UNION ALL SELECT 'changed', 1, 'cdc_apply', n, i, u, d FROM m UNION ALL SELECT 'versions', 0, 'overwrite', n - fresh, n - fresh, 0, 0 FROM h
        UNION ALL SELECT 'versions', 1, 'scd2', n, fresh, ended, 0 FROM h""",
    ),
    "change_feed": (
        change_feed,
        f"""SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'MACHINERY' AND c_custkey % 5 <> 0 THEN 'TOOLS' ELSE c_mktsegment END AS c_mktsegment,
        CASE WHEN c_custkey % 5 = 0 THEN 'delete' WHEN c_mktsegment = 'BUILDING' THEN 'insert' ELSE 'update' END AS _change FROM ({_C})
        WHERE CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment <> 'BUILDING' ELSE c_mktsegment IN ('BUILDING', 'MACHINERY') END""",
    ),
    "incremental_source": (
        incremental_source,
        """SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 3 <> 1 AND o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS price,
        CASE WHEN o_orderkey % 3 = 2 AND o_orderkey % 2 = 0 THEN 'update' ELSE 'insert' END AS how FROM orders""",
    ),
    "clustered_range": (clustered_range, "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-06-30' AND l_partkey BETWEEN 100 AND 400"),
}

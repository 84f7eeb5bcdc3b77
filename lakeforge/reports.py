"""Queries of decision lists, hierarchies, flows of events and permissions over the driver tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import functions as X
from .operators import governance, windows


def _t(spark, d, name):
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


STATUS = {"F": "closed", "O": "open", "P": "partly"}
PRIORITY = {"1-urgent": "now", "2-high": "soon", "3-medium": "planned", "4-not specified": "whenever", "5-low": "last"}
DEAR = 250_000


def transaction_types(spark, d):
    """A decision list of 32 branches: by state, priority and value, after two that come first; blanks and case don't count."""
    s, p, v = F.col("o_orderstatus"), X.norm_key(F.concat(F.lit(" "), F.col("o_orderpriority"))), F.col("o_totalprice")
    first = [(v < 0, "error"), ((v > 450_000) & (s == "P"), "review")]
    rules = [((s == a) & (p == b) & dear, f"{x} {y} {z}") for a, x in STATUS.items() for b, y in PRIORITY.items() for dear, z in ((v >= DEAR, "dear"), (F.lit(True), "cheap"))]
    return _t(spark, d, "orders").select("o_orderkey", X.decision_list(first + rules, "other").alias("kind"))


def hierarchy() -> list[tuple[str, str, str, str, str, str]]:
    """41 codes with five levels: each state, its priorities, and what these are worth."""
    rows = []
    for a, x in STATUS.items():
        for b, y in PRIORITY.items():
            rows += [(f"{a}{b[0]}{z[0]}", "order", "live" if a != "F" else "past", x, y, z) for z in ("dear", "cheap")]
        rows += [(f"{a}{n}", "order", "odd", x, f"reserved {n}", "none") for n in range(3)]
    return [*rows, ("X", "order", "odd", "unknown", "unknown", "none"), ("Y", "order", "odd", "error", "unknown", "none")]


def status_hierarchy(spark, d):
    """Orders counted by all levels of an inline relation; its codes without orders are there too."""
    names = ("code", "l0", "l1", "l2", "l3", "l4")
    dim = spark.createDataFrame(hierarchy(), ", ".join(f"{n} string" for n in names))
    code = F.concat("o_orderstatus", F.substring("o_orderpriority", 1, 1), F.when(F.col("o_totalprice") >= DEAR, "d").otherwise("c"))
    n = _t(spark, d, "orders").groupBy(code.alias("code")).agg(F.count("*").alias("n"))
    return F.broadcast(dim).join(n, "code", "left").select(*names, F.coalesce("n", F.lit(0)).alias("n"))


def flow_tracking(spark, d):
    """How often users go from one kind of event to the next, in how many microseconds on average, and where they end."""
    e = _t(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    steps = windows.previous(windows.previous(e, ["user_id"], ["ts", "event_id"], "event_type", "came_from"), ["user_id"], ["ts", "event_id"], "ts", "since")
    took = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("since").cast("timestamp"))
    return steps.withColumn("took", took).groupBy(F.coalesce("came_from", F.lit("start")).alias("came_from"), F.col("event_type").alias("went_to")).agg(
        F.count("*").alias("n"), F.count_distinct("user_id").alias("n_users"), F.expr("sum(took) div nullif(count(took), 0)").alias("mean_micros")
    )


def path_permissions(spark, d):
    """Pages that readers may see: hosts are open or closed, French pages are closed everywhere."""
    p = _t(spark, d, "pages").select("page_id", F.regexp_replace(F.regexp_replace("url", "^https?://", ""), "[?#].*$", "").alias("path"))
    host = F.split_part("path", F.lit("/"), F.lit(1))
    hosts = p.select(host.alias("host")).distinct()
    rules = hosts.select(F.lit("reader").alias("role"), F.col("host").alias("prefix"), (F.length("host") % 2 == 0).alias("allow"))
    rules = rules.unionByName(hosts.select(F.lit("all").alias("role"), F.concat("host", F.lit("/fr/")).alias("prefix"), F.lit(False).alias("allow")))
    rules = rules.unionByName(hosts.select(F.lit("writer").alias("role"), F.col("host").alias("prefix"), F.lit(False).alias("allow")))
    return governance.permitted(p, "path", rules, ["reader", "all"])


def role_sync(spark, d):
    """What changed in the open columns of tables between two states of a catalogue: brands as tables, sizes as columns."""

    def safe(rows):
        level = F.when(F.max("p_retailprice") > 1500, "CD3").otherwise("CD1")
        return governance.safe_columns(rows.groupBy(F.col("p_brand").alias("table_name"), F.col("p_size").cast("string").alias("column_name")).agg(level.alias("cd_level")))

    p = _t(spark, d, "part")
    return governance.role_changes(safe(p.where("p_partkey % 2 = 0 AND p_brand <> 'Brand#11'")), safe(p.where("p_brand <> 'Brand#12' AND (p_partkey % 2 = 0 OR p_brand < 'Brand#2')")))


_SAFE = "SELECT b AS table_name, list(s ORDER BY s) AS own FROM (SELECT p_brand AS b, CAST(p_size AS VARCHAR) AS s FROM part WHERE {} GROUP BY 1, 2 HAVING max(p_retailprice) <= 1500) GROUP BY 1"

REPORTS = {
    "transaction_types": (
        transaction_types,
        "SELECT o_orderkey, CASE WHEN o_totalprice < 0 THEN 'error' WHEN o_totalprice > 450000 AND o_orderstatus = 'P' THEN 'review' WHEN s IS NULL OR p IS NULL THEN 'other' "
        f"ELSE s || ' ' || p || CASE WHEN o_totalprice >= {DEAR} THEN ' dear' ELSE ' cheap' END END AS kind FROM (SELECT *, CASE o_orderstatus "
        + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATUS.items()) + " END AS s, CASE lower(o_orderpriority) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITY.items()) + " END AS p FROM orders)",
    ),
    "status_hierarchy": (
        status_hierarchy,
        f"SELECT code, l0, l1, l2, l3, l4, coalesce(n, 0) AS n FROM (VALUES {', '.join(map(str, hierarchy()))}) AS v(code, l0, l1, l2, l3, l4) "
        f"LEFT JOIN (SELECT o_orderstatus || substr(o_orderpriority, 1, 1) || CASE WHEN o_totalprice >= {DEAR} THEN 'd' ELSE 'c' END AS code, count(*) AS n FROM orders GROUP BY 1) USING (code)",
    ),
    "flow_tracking": (
        flow_tracking,
        """SELECT coalesce(came_from, 'start') AS came_from, event_type AS went_to, count(*) AS n, count(DISTINCT user_id) AS n_users,
        CAST(sum(epoch_us(ts) - epoch_us(since)) // nullif(count(since), 0) AS BIGINT) AS mean_micros
        FROM (SELECT *, lag(event_type) OVER w AS came_from, lag(ts) OVER w AS since FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) GROUP BY 1, 2""",
    ),
    "path_permissions": (
        path_permissions,
        """SELECT page_id, path, coalesce(length(split_part(path, '/', 1)) % 2 = 0 AND split_part(path, '/', 2) <> 'fr', false) AS is_permitted
        FROM (SELECT page_id, regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', '') AS path FROM pages)""",
    ),
    "role_sync": (
        role_sync,
        f"""WITH o AS ({_SAFE.format("p_partkey % 2 = 0 AND p_brand <> 'Brand#11'")}), n AS ({_SAFE.format("p_brand <> 'Brand#12' AND (p_partkey % 2 = 0 OR p_brand < 'Brand#2')")})
        SELECT coalesce(o.table_name, n.table_name) AS table_name, CASE WHEN o.own IS NULL THEN 'new' WHEN n.own IS NULL THEN 'removed' ELSE 'changed' END AS change
        FROM o FULL JOIN n ON o.table_name = n.table_name WHERE o.own IS DISTINCT FROM n.own""",
    ),
}

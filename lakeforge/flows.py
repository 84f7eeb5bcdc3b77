"""Queries of load, quality, audit and dimension flows over the driver tables, each beside its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from . import functions as X
from .operators import audit, loads, quality, windows

NOW = "2024-03-01 00:00:00"


def _t(spark, d, name):
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def _now():
    return F.lit(NOW).cast("timestamp")


# --- loads: the target lacks one market segment, the source has all customers, some changed, with a new column.


def _sides(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    target = c.where("c_mktsegment <> 'BUILDING'")
    source = c.withColumns({"c_mktsegment": F.when(F.col("c_mktsegment") == "MACHINERY", "TOOLS").otherwise(F.col("c_mktsegment")), "c_tier": F.length("c_name").cast("long")})
    return target, source


def merge_evolving(spark, d):
    """Merge by name; the source's new column is added, rows that the source hasn't keep what they had."""
    target, source = _sides(spark, d)
    return loads.load("merge", target.withColumn("c_note", F.lower("c_mktsegment")), source.where("c_custkey % 4 <> 0"), ["c_custkey"])


def merge_changed(spark, d):
    """Rows are updated only where the segment differs, so others keep a null in the new column."""
    return loads.load("merge", *_sides(spark, d), ["c_custkey"], changed=["c_mktsegment"])


def overwrite_load(spark, d):
    return loads.load("overwrite_load", *_sides(spark, d), ["c_custkey"])


def update_matched(spark, d):
    target, source = _sides(spark, d)
    return loads.load("update_matched", target, source.select("c_custkey", "c_mktsegment"), ["c_custkey"])


def update_where(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.lit("live").alias("state"))
    return loads.update_where(o, F.col("o_orderstatus") == "F", {"state": F.lit("closed")})


def scd2_synced(spark, d):
    """A plain table becomes a history and gets the source's new column, which is null in a third of its rows: these are unchanged unless the segment is."""
    target, source = _sides(spark, d)
    source = source.withColumn("c_tier", F.when(F.col("c_custkey") % 3 != 0, F.col("c_tier")))
    return loads.load("scd2_synced", target, source, ["c_custkey"], now=_now())


# --- quality


def _lines(spark, d):
    return _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


def quarantine_flow(spark, d):
    duplicates = windows.split_duplicates(_lines(spark, d), ["l_orderkey", "l_linenumber"], "retain_one")[1]
    return quality.quarantine_rows(duplicates, "lineitem", "retain_one", "run-1", _now())


def quarantine_log(spark, d):
    duplicates = windows.split_duplicates(_lines(spark, d), ["l_orderkey", "l_linenumber"], "quarantine_all")[1]
    return quality.quarantine_log(duplicates, ["l_orderkey", "l_linenumber"], "lineitem", "quarantine_all", "run-1")


def dedup_alert(spark, d):
    """Duplicate keys and rows of two tables, for a report."""
    parts = []
    for name, key in (("orders", "o_orderkey"), ("events", "user_id")):
        n = _t(spark, d, name).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
        parts.append(n.agg(F.count("*").alias("n_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows")).withColumn("table_name", F.lit(name)))
    return parts[0].unionByName(parts[1])


def expectation_gate(spark, d):
    """Rows that keep a rule table's active rules; the rules' columns are dropped again."""
    rules = spark.createDataFrame([("r1", "o_totalprice > 1000", 1), ("r2", "o_orderstatus IN ('O', 'F')", 1), ("r3", "false", 0)], "rule_id string, expression string, is_active int")
    marked = quality.with_rules(_t(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), quality.load_rules(rules))
    good = marked.where(" AND ".join(f"{c} = 1" for c in marked.columns if c.startswith("dq_")))
    return good.select(*X.without_prefix(good.columns, "dq_"))


# --- audit


def event_fold(spark, d):
    """Events as JSON messages of an ingestion log, folded by user and zone."""
    e = _t(spark, d, "events")
    status = X.decision_list([(F.col("event_type") == "error", "failed"), (F.col("event_type") == "view", "running")], "done")
    zone = F.when(F.col("event_type") != "click", F.concat(F.lit("zone"), (F.col("event_id") % 3).cast("string")))
    size = F.when(F.col("event_type") == "purchase", F.lit("unknown")).otherwise(F.col("event_id").cast("string"))
    message = F.to_json(F.struct(status.alias("status"), size.alias("size"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("started"), zone.alias("zone")))
    return audit.fold_events(e.select("user_id", message.alias("message")), ["user_id"], "message")


def metrics_by_operation(spark, d):
    o = _t(spark, d, "orders").select("o_orderstatus", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey").cast("long") + 1).alias("n_inserted"), F.col("o_custkey").cast("long").alias("n_updated"))
    return audit.by_operation(o, "o_orderstatus", ["n_inserted", "n_updated"])


def grouped_dictionaries(spark, d):
    return audit.dictionaries(_t(spark, d, "nation"), "n_regionkey", ["n_name"], "nations")


def zone_log_pending(spark, d):
    """Customers without an order are pending, the others have the status of their latest order."""
    c = _t(spark, d, "customer").select(F.col("c_custkey").alias("etl_id"))
    o = _t(spark, d, "orders").select(F.col("o_custkey").alias("etl_id"), F.col("o_orderstatus").alias("status"), "o_orderdate", "o_orderkey")
    log = windows.latest_per_key(o, ["etl_id"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]).select("etl_id", "status")
    return audit.pending_entries(c, log, ["etl_id"])


# --- dimensions and joins


def normalized_name_join(spark, d):
    """Orders find their customer by a name typed in another form."""
    c = _t(spark, d, "customer").select("c_custkey", "c_name")
    typed = _t(spark, d, "orders").select("o_orderkey", F.concat(F.lit(" customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.lit("  ")).alias("typed"))
    return typed.withColumn("k", X.norm_key(F.col("typed"))).join(c.withColumn("k", X.norm_key(F.col("c_name"))), "k").select("o_orderkey", "c_custkey")


def star_lookup_default_key(spark, d):
    """Line items with the keys of all their dimensions, -1 where one is missing."""
    li, o, c, n = _t(spark, d, "lineitem"), _t(spark, d, "orders"), _t(spark, d, "customer"), _t(spark, d, "nation")
    # The dimensions are joined first, so the fact is moved once.
    chain = o.join(c.join(n, c.c_nationkey == n.n_nationkey, "left"), o.o_custkey == c.c_custkey, "left")
    s = li.join(chain, li.l_orderkey == o.o_orderkey, "left")
    keys = {"order_key": "o_orderkey", "customer_key": "c_custkey", "nation_key": "n_nationkey", "region_key": "n_regionkey"}
    return s.select("l_orderkey", "l_linenumber", "l_partkey", *[X.default_key(F.col(v).cast("long")).alias(k) for k, v in keys.items()])


def redaction_coalesce(spark, d):
    """Live values count unless they are redacted or missing, then those of the archive, which are older, do; for each column by itself."""
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    kept = {"priority": F.when(F.col("o_orderpriority") == "1-URGENT", "REDACTED").otherwise(F.col("o_orderpriority")), "status": F.when(F.col("o_orderkey") % 3 == 0, "redacted ").otherwise(F.col("o_orderstatus"))}
    live = o.where("o_orderkey % 5 <> 0").select("o_orderkey", *[v.alias(k) for k, v in kept.items()])
    archive = o.where("o_orderkey % 7 <> 0").select(F.col("o_orderkey").alias("key"), F.concat(F.lit("old "), F.col("o_orderpriority")).alias("a_priority"), F.lower("o_orderstatus").alias("a_status"))
    both = live.join(archive, live.o_orderkey == archive.key, "full_outer")
    return both.select(F.coalesce("o_orderkey", "key").alias("o_orderkey"), *[X.unredacted(F.col(k), F.col(f"a_{k}")).alias(k) for k in kept])


def presence_flag(spark, d):
    has = _t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("there", F.lit(True))
    return _t(spark, d, "customer").join(has, "c_custkey", "left").select("c_custkey", F.when(F.col("there").isNotNull(), "Y").otherwise("N").alias("has_orders"))


def prefixed_union(spark, d):
    """Customers and suppliers as one kind of party, keys told apart by a prefix."""
    c = _t(spark, d, "customer").select(F.concat(F.lit("C-"), F.col("c_custkey").cast("string")).alias("party_key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    s = _t(spark, d, "supplier").select(F.concat(F.lit("S-"), F.col("s_suppkey").cast("string")).alias("party_key"), F.col("s_name").alias("name"))
    return c.unionByName(s, allowMissingColumns=True)


def entity_attribute_exists(spark, d):
    """Views of users who have a purchase of their own."""
    e = _t(spark, d, "events").select("event_id", "user_id", "event_type")
    return e.where("event_type = 'view'").join(e.where("event_type = 'purchase'").select("user_id"), "user_id", "left_semi").select("event_id", "user_id")


def min_not_null(spark, d):
    e = _t(spark, d, "events").select("user_id", F.when(F.col("event_type") == "purchase", F.col("ts")).alias("bought"))
    return e.where("bought IS NOT NULL").groupBy("user_id").agg(F.min("bought").alias("first_bought"))


def latest_renewal(spark, d):
    """Each customer's latest order that runs beyond the day, with its end."""
    o = _t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", F.add_months("o_orderdate", 12).cast("timestamp").alias("ends")).where(F.col("ends") > F.lit("1998-01-01").cast("timestamp"))
    return windows.latest_per_key(o, ["o_custkey"], [F.col("ends").desc(), F.col("o_orderkey").desc()])


def dominant_by_two(spark, d):
    """The priority with the largest sum for each customer; ties go to more orders, then to the smaller one."""
    s = _t(spark, d, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.floor(F.sum(F.col("o_totalprice").cast("decimal(18,2)")) / 100000).cast("long").alias("total"), F.count("*").alias("n"))
    return windows.latest_per_key(s, ["o_custkey"], [F.col("total").desc(), F.col("n").desc(), F.col("o_orderpriority").asc()])


def top_orders(spark, d):
    """The ten largest orders: a report."""
    return _t(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


def text_shapes(spark, d):
    """Padding, blanks, words and arrays of a text column."""
    p = _t(spark, d, "part")
    words = F.transform(F.split("p_type", " "), F.lower)
    return p.select(
        "p_partkey", F.lpad(F.col("p_size").cast("string"), 4, "0").alias("size_code"), X.strip_nbsp(F.concat(F.lit("\u00a0 "), F.replace(F.col("p_brand"), F.lit("#"), F.lit("\u00a0#")), F.lit(" \u00a0"))).alias("brand"),
        F.size(F.split("p_type", " ")).cast("long").alias("n_words"), F.array_join(words, "-").alias("slug"), F.array_contains(words, "steel").alias("is_steel"),
    )


def default_compare(spark, d):
    """A compare that takes missing for empty, and a filter of masters: orders whose base code is their own."""
    o = _t(spark, d, "orders").withColumns({"code": F.concat(F.lit("P"), F.col("o_orderkey")), "base": F.concat(F.lit("P"), F.col("o_orderkey") - F.col("o_orderkey") % 4)})
    o = o.withColumn("kind", F.when(F.col("o_orderstatus") != "P", F.concat(F.lit(" "), F.col("o_orderstatus"))))
    return o.where((F.coalesce(F.lower(F.trim("kind")), F.lit("")) != "f") & (F.col("code") == F.col("base"))).select("o_orderkey", "kind")


def column_order(spark, d):
    """Key columns in front, helper columns gone."""
    c = _t(spark, d, "customer").select("c_name", "c_mktsegment", "c_custkey", F.lit(1).alias("dq_x"))
    return c.select(*X.reordered(X.without_prefix(c.columns, "dq_"), ["c_custkey", "absent"]))


def soft_deletes(spark, d):
    """Customers that a full extract no longer has stay, marked as deleted; the others keep their rows."""
    target = _t(spark, d, "customer").select("c_custkey", "c_name")
    extract = _t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return loads.load("soft_delete", target, extract, ["c_custkey"], now=_now())


def folded_union(spark, d):
    """Names of many tables as one frame, folded from a list of them."""
    named = [_t(spark, d, t).select(F.lit(t).alias("kind"), F.col(c).alias("name")) for t, c in (("region", "r_name"), ("nation", "n_name"), ("supplier", "s_name"), ("customer", "c_name"))]
    return reduce(lambda a, b: a.unionByName(b), named)


def share_of_total(spark, d):
    """Each line's share of its part's quantity: sums of parts are joined back, so no part's lines meet in one task."""
    lines = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("double").alias("quantity"))
    total = lines.groupBy("l_partkey").agg(F.sum("quantity").alias("total"))
    return lines.join(total, "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey", "quantity", F.round(100 * F.col("quantity") / F.nullif("total", F.lit(0.0)), 4).alias("percent"))


def delimited_words(spark, d):
    """Words of a delimited text, blank ones left out, and how many there are."""
    typed = F.concat(F.lit(" ;"), F.replace(F.col("p_type"), F.lit(" "), F.lit(" ; ")), F.lit(";;"))
    words = F.filter(F.transform(F.split(typed, ";"), lambda w: F.trim(w)), lambda w: w != "")
    return _t(spark, d, "part").select("p_partkey", F.size(words).cast("long").alias("n_words"), F.explode(words).alias("word"))


def three_part_key(spark, d):
    """Lines find the line of the same order, part and supplier with a smaller number."""
    li = _t(spark, d, "lineitem").groupBy("l_orderkey", "l_partkey", "l_suppkey").agg(F.min("l_linenumber").cast("long").alias("first_line"))
    lines = _t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return lines.join(li, ["l_orderkey", "l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "first_line")


def absent_columns(spark, d):
    """Fields that documents have and their table lacks, with how many have them: what a schema sync would add."""
    e = _t(spark, d, "events")
    more = F.when(F.col("event_type") == "error", F.struct(F.lit(1).alias("code"), F.col("value").alias("value"))).otherwise(F.struct(F.lit(None).cast("int").alias("code"), F.col("value").alias("value")))
    document = F.map_concat(F.from_json("props", "map<string,string>"), F.from_json(F.to_json(more), "map<string,string>"))
    return X.absent_fields(e.select(document.alias("document")), "document", e.columns)


_C = "SELECT c_custkey, c_name, c_mktsegment FROM customer"
_TGT = f"({_C} WHERE c_mktsegment <> 'BUILDING')"
_SRC = "(SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'TOOLS' ELSE c_mktsegment END AS c_mktsegment, CAST(length(c_name) AS BIGINT) AS c_tier FROM customer)"
_DUP = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem"
_OLD = "SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS c FROM lineitem"

FLOWS = {
    "merge_evolving": (
        merge_evolving,
        f"SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey, coalesce(s.c_name, t.c_name) AS c_name, coalesce(s.c_mktsegment, t.c_mktsegment) AS c_mktsegment, lower(t.c_mktsegment) AS c_note, s.c_tier "
        f"FROM {_TGT} t FULL JOIN (SELECT * FROM {_SRC} WHERE c_custkey % 4 <> 0) s ON s.c_custkey = t.c_custkey",
    ),
    "merge_changed": (merge_changed, f"SELECT c_custkey, c_name, c_mktsegment, CASE WHEN c_mktsegment IN ('TOOLS', 'BUILDING') THEN c_tier END AS c_tier FROM {_SRC}"),
    "overwrite_load": (overwrite_load, f"SELECT * FROM {_SRC}"),
    "update_matched": (update_matched, f"SELECT t.c_custkey, t.c_name, s.c_mktsegment FROM {_TGT} t JOIN {_SRC} s USING (c_custkey)"),
    "update_where": (update_where, "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'live' END AS state FROM orders"),
    "scd2_synced": (
        scd2_synced,
        f"WITH o AS (SELECT *, c_custkey % 3 <> 0 OR c_mktsegment = 'MACHINERY' AS changed FROM {_TGT}) SELECT c_custkey, c_name, c_mktsegment, CAST(NULL AS BIGINT) AS c_tier, CAST(NULL AS TIMESTAMP) AS active_start, "
        f"CASE WHEN changed THEN TIMESTAMP '{NOW}' END AS active_end, CASE WHEN changed THEN 0 ELSE 1 END AS is_current FROM o "
        f"UNION ALL SELECT s.c_custkey, s.c_name, s.c_mktsegment, CASE WHEN s.c_custkey % 3 <> 0 THEN s.c_tier END, TIMESTAMP '{NOW}', NULL, 1 FROM {_SRC} s LEFT JOIN o USING (c_custkey) WHERE coalesce(changed, true)",
    ),
    "quarantine_flow": (
        quarantine_flow,
        f"SELECT *, 'lineitem' AS q_table, 'retain_one' AS q_type, 'run-1' AS q_run, TIMESTAMP '{NOW}' AS q_time FROM ({_DUP} "
        "QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) > 1)",
    ),
    "quarantine_log": (
        quarantine_log,
        f"SELECT 'lineitem' AS q_table, 'quarantine_all' AS q_type, 'run-1' AS q_run, count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys, 'l_orderkey~l_linenumber' AS key_columns FROM ({_OLD}) WHERE c > 1 HAVING count(*) > 0",
    ),
    "dedup_alert": (
        dedup_alert,
        "SELECT count(*) AS n_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, 'orders' AS table_name FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey) WHERE n > 1 "
        "UNION ALL SELECT count(*), CAST(coalesce(sum(n), 0) AS BIGINT), 'events' FROM (SELECT count(*) AS n FROM events GROUP BY user_id) WHERE n > 1",
    ),
    "expectation_gate": (expectation_gate, "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_totalprice > 1000 AND o_orderstatus IN ('O', 'F')"),
    "event_fold": (
        event_fold,
        "SELECT user_id, 'zone' || (event_id % 3) AS zone, min(ts) AS started, CAST(coalesce(sum(CASE WHEN event_type <> 'purchase' THEN event_id END), 0) AS BIGINT) AS bytes, count(*) AS n_events, "
        "CASE WHEN bool_or(event_type = 'error') THEN 'failed' WHEN bool_or(event_type = 'view') THEN 'running' ELSE 'done' END AS status FROM events WHERE event_type <> 'click' GROUP BY 1, 2",
    ),
    "metrics_by_operation": (
        metrics_by_operation,
        "SELECT o_orderstatus, count(*) AS n, CAST(coalesce(sum(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey + 1 END), 0) AS BIGINT) AS n_inserted, CAST(coalesce(sum(o_custkey), 0) AS BIGINT) AS n_updated FROM orders GROUP BY 1",
    ),
    "grouped_dictionaries": (grouped_dictionaries, "SELECT n_regionkey, string_agg('{\"n_name\":\"' || n_name || '\"}', ',' ORDER BY n_name) AS nations FROM nation GROUP BY 1"),
    "zone_log_pending": (
        zone_log_pending,
        "SELECT o_custkey AS etl_id, o_orderstatus AS status FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 "
        "UNION ALL SELECT c_custkey, 'pending' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
    ),
    "normalized_name_join": (normalized_name_join, "SELECT o_orderkey, c_custkey FROM orders JOIN customer ON lower(trim(c_name)) = 'customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')"),
    "star_lookup_default_key": (
        star_lookup_default_key,
        "SELECT l_orderkey, l_linenumber, l_partkey, CAST(coalesce(o_orderkey, -1) AS BIGINT) AS order_key, CAST(coalesce(c_custkey, -1) AS BIGINT) AS customer_key, CAST(coalesce(n_nationkey, -1) AS BIGINT) AS nation_key, CAST(coalesce(n_regionkey, -1) AS BIGINT) AS region_key "
        "FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey",
    ),
    "redaction_coalesce": (
        redaction_coalesce,
        "SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 AND o_orderpriority <> '1-URGENT' THEN o_orderpriority WHEN o_orderkey % 7 <> 0 THEN 'old ' || o_orderpriority END AS priority, "
        "CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 3 <> 0 THEN o_orderstatus WHEN o_orderkey % 7 <> 0 THEN lower(o_orderstatus) END AS status FROM orders WHERE o_orderkey % 5 <> 0 OR o_orderkey % 7 <> 0",
    ),
    "presence_flag": (presence_flag, "SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) THEN 'Y' ELSE 'N' END AS has_orders FROM customer"),
    "prefixed_union": (prefixed_union, "SELECT 'C-' || c_custkey AS party_key, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT 'S-' || s_suppkey, s_name, NULL FROM supplier"),
    "entity_attribute_exists": (entity_attribute_exists, "SELECT event_id, user_id FROM events WHERE event_type = 'view' AND user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase')"),
    "min_not_null": (min_not_null, "SELECT user_id, min(ts) AS first_bought FROM events WHERE event_type = 'purchase' GROUP BY 1"),
    "latest_renewal": (
        latest_renewal,
        "SELECT * FROM (SELECT o_custkey, o_orderkey, o_orderdate, CAST(CAST(o_orderdate AS DATE) + INTERVAL 12 MONTHS AS TIMESTAMP) AS ends FROM orders) WHERE ends > TIMESTAMP '1998-01-01' "
        "QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY ends DESC, o_orderkey DESC) = 1",
    ),
    "dominant_by_two": (
        dominant_by_two,
        "SELECT o_custkey, o_orderpriority, total, n FROM (SELECT o_custkey, o_orderpriority, CAST(floor(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 100000) AS BIGINT) AS total, count(*) AS n FROM orders GROUP BY 1, 2) "
        "QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY total DESC, n DESC, o_orderpriority) = 1",
    ),
    "top_orders": (top_orders, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"),
    "text_shapes": (
        text_shapes,
        "SELECT p_partkey, lpad(CAST(p_size AS VARCHAR), 4, '0') AS size_code, replace(p_brand, '#', ' #') AS brand, CAST(len(string_split(p_type, ' ')) AS BIGINT) AS n_words, replace(lower(p_type), ' ', '-') AS slug, list_contains(string_split(lower(p_type), ' '), 'steel') AS is_steel FROM part",
    ),
    "default_compare": (default_compare, "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN ' ' || o_orderstatus END AS kind FROM orders WHERE o_orderkey % 4 = 0 AND o_orderstatus <> 'F'"),
    "column_order": (column_order, "SELECT c_custkey, c_name, c_mktsegment FROM customer"),
    "soft_deletes": (
        soft_deletes,
        f"SELECT c_custkey, c_name, CASE WHEN gone THEN 1 ELSE 0 END AS is_deleted, CASE WHEN gone THEN TIMESTAMP '{NOW}' END AS deleted_at "
        "FROM (SELECT c_custkey, c_name, NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS gone FROM customer)",
    ),
    "folded_union": (
        folded_union,
        "SELECT 'region' AS kind, r_name AS name FROM region UNION ALL SELECT 'nation', n_name FROM nation "
        "UNION ALL SELECT 'supplier', s_name FROM supplier UNION ALL SELECT 'customer', c_name FROM customer",
    ),
    "share_of_total": (
        share_of_total,
        "SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS DOUBLE) AS quantity, "
        "round(100 * CAST(l_quantity AS DOUBLE) / nullif(sum(CAST(l_quantity AS DOUBLE)) OVER (PARTITION BY l_partkey), 0), 4) AS percent FROM lineitem",
    ),
    "delimited_words": (
        delimited_words,
        "SELECT p_partkey, CAST(len(w) AS BIGINT) AS n_words, unnest(w) AS word FROM (SELECT p_partkey, list_filter(string_split(p_type, ' '), lambda x: x <> '') AS w FROM part)",
    ),
    "three_part_key": (
        three_part_key,
        "SELECT l_orderkey, l_linenumber, CAST(min(l_linenumber) OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey) AS BIGINT) AS first_line FROM lineitem",
    ),
    "absent_columns": (absent_columns, "SELECT 'k' AS name, count(*) AS n FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL HAVING count(*) > 0 UNION ALL SELECT 'code', count(*) FROM events WHERE event_type = 'error' HAVING count(*) > 0"),
}

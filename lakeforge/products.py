"""Queries of rules, ingestion, dimensional models, privacy and specs over the driver tables, each beside its SQL."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from . import dimensional, incremental
from .ingestion import Run, ingest
from .operators import privacy, rules
from .plans import products, specs, with_identity, with_unknown
from .scratch import fresh_folder
from .store import TableStore

NOW, LATER = "2024-03-01 00:00:00", "2024-04-01 00:00:00"


def _t(spark, d, name):
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def _store(spark) -> TableStore:
    return TableStore(spark, fresh_folder(spark, "tables"))


def _run(etl_id="run-1"):
    return Run(etl_id, "sales", "daily", "shop", now=F.lit(NOW).cast("timestamp"))


# --- rules

#: A rule of each type for line items, and documents that are refused.
LINE_RULES = {
    "r01": {"type": "not_null", "kwargs": {"column": "ret"}},
    "r02": {"type": "between", "kwargs": {"column": "l_discount", "min": 0, "max": 0.05, "mostly": 0.5}, "meta": {"owner": "sales"}},
    "r03": {"type": "in_set", "kwargs": {"column": "l_linestatus", "values": ["O", "X"]}},
    "r04": {"type": "matches", "kwargs": {"column": "ret", "pattern": "^A"}},
    "r05": {"type": "length_between", "kwargs": {"column": "l_partkey", "min": 2, "max": 3}},
    "r06": {"type": "compare", "kwargs": {"left": "l_suppkey", "op": "<=", "right": "l_partkey"}},
    "r07": {"type": "unique", "kwargs": {"columns": ["l_orderkey", "l_linenumber"]}},
    "x01": {"type": "between", "kwargs": {"column": "no_such", "min": 1}},
    "x02": {"type": "between", "kwargs": {"column": "l_tax", "min": "low"}},
    "x03": {"type": "sideways", "kwargs": {}},
    "x04": {"kwargs": {"column": "l_tax"}},
    "x05": None,
}


def _lines(spark, d):
    li = _t(spark, d, "lineitem").withColumn("ret", F.nullif("l_returnflag", F.lit("N")))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_tax", "l_linestatus", "ret")


def _checked(spark, lines):
    texts = [(k, json.dumps(v) if v else "{not json") for k, v in LINE_RULES.items()]
    return rules.check(spark.createDataFrame(texts, "rule_id string, constraint string"), lines.columns)


def rule_master(spark, d):
    """All rule documents, with what is wrong with them or what they found in the line items."""
    lines = _lines(spark, d)
    checked = _checked(spark, lines)
    verdict = F.when(F.col("passed"), "passed").when(~F.col("passed"), "failed").otherwise("refused").alias("verdict")
    return checked.join(rules.results(lines, rules.compiled(checked)), "rule_id", "left").select("rule_id", "type", "problem", "n_rows", "n_broken", verdict)


def compiled_rules(spark, d):
    lines = _lines(spark, d)
    return rules.flags(lines, rules.compiled(_checked(spark, lines))).drop("l_discount", "l_tax", "l_linestatus", "ret")


def _order_rules(spark, columns):
    texts = [
        ("dear", json.dumps({"type": "between", "kwargs": {"column": "o_totalprice", "min": 1000, "max": 400000}})),
        ("state", json.dumps({"type": "in_set", "kwargs": {"column": "o_orderstatus", "values": ["F", "O"]}})),
    ]
    return rules.compiled(rules.check(spark.createDataFrame(texts, "rule_id string, constraint string"), columns))


def gated_load(spark, d):
    """Orders that keep the rules are loaded, the others are in quarantine with the rules they break; a second feed has too many and loads nothing."""
    store = _store(spark)
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    found = _order_rules(spark, o.columns)
    ingest(store, "orders", o, ["o_orderkey"], "merge", _run(), rules=found, most_broken=0.9)
    ingest(store, "shut", o, ["o_orderkey"], "merge", _run("run-2"), rules=found, most_broken=0.01, quarantine="merge")
    parts = [store.read(f"{t}_quarantined").select("o_orderkey", F.lit(t).alias("feed"), F.array_join("dq_broken", ",").alias("broken"), "ETL_ID", "Log_Status") for t in ("orders", "shut")]
    loaded = [store.read(t).select("o_orderkey", F.lit(t).alias("feed")) for t in ("orders", "shut") if store.exists(t)]
    out = parts[0].unionByName(parts[1])
    for rows in loaded:
        out = out.unionByName(rows, allowMissingColumns=True)
    return out


def _with_duplicates(spark, d):
    store = _store(spark)
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    metrics = ingest(store, "lines", li, ["l_orderkey", "l_linenumber"], "overwrite", _run(), duplicates="quarantine_all", external=True)
    return store, metrics


def quarantine_table(spark, d):
    """The stored quarantine of an external table: all rows of repeated keys with nine columns of where they come from."""
    store, _ = _with_duplicates(spark, d)
    return store.read("lines_quarantined").drop("dq_broken").withColumn("LoadDate", F.col("LoadDate").cast("string"))


def ingestion_log(spark, d):
    """The quarantine log's row of a run, beside the counts of its load."""
    store, m = _with_duplicates(spark, d)
    return store.read("quarantine_log").withColumn("log_date", F.col("log_date").cast("string")).withColumns({k: F.lit(v) for k, v in {"read": m.sourceDataCount, "inserts": m.inserts, "success": m.success}.items()})


# --- dimensional models


def dim_customer(spark, d):
    """Customers with nation and region as one dimension: keys by number, an unknown member."""
    c, n, r = _t(spark, d, "customer"), _t(spark, d, "nation"), _t(spark, d, "region")
    places = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
    rows = c.join(places, c.c_nationkey == places.n_nationkey, "left").select("c_custkey", F.upper(F.trim("c_mktsegment")).alias("segment"), "nation", "region")
    return with_unknown(with_identity(rows, "customer_key", ["c_custkey"]), {"customer_key": -1, "c_custkey": -1, **dict.fromkeys(("segment", "nation", "region"), "unknown")})


def fact_order_lines(spark, d):
    """Line items with their dimensions' keys: a date dimension in three roles, customers through orders, parts by a composite key; -1 where there is none."""
    model = dimensional.Model()

    @model.table("dates")
    def dates(own):
        return dimensional.date_dimension(own, "1993-01-01", "1997-12-31")

    @model.table("customers")
    def customers(own):
        return dim_customer(own, d).where("segment <> 'BUILDING'")

    @model.table("parts")
    def parts(own):
        return with_identity(_t(own, d, "part").where("p_size > 5"), "part_key", ["p_partkey"])

    @model.table("orders", ["customers"])
    def orders(own, customers):
        # The chain is joined before the fact is moved.
        o = _t(own, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return dimensional.star(o, [dimensional.Lookup("customers", customers, {"c_custkey": "o_custkey"}, {"customer_key": "customer_key"})])

    @model.table("fact", ["dates", "orders", "parts"])
    def fact(own, dates, orders, parts):
        li = _t(own, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", F.col("l_quantity").cast("decimal(18,2)").alias("quantity"))
        typed = parts.select(F.concat(F.lit("  "), F.lower("p_brand")).alias("brand"), "p_partkey", "part_key")
        brands = _t(own, d, "part").select("p_partkey", "p_brand")
        found = li.join(orders, li.l_orderkey == orders.o_orderkey, "left").join(brands, li.l_partkey == brands.p_partkey, "left")
        found = dimensional.star(found, [dimensional.Lookup("parts", typed, {"brand": "p_brand", "p_partkey": "l_partkey"}, {"part_key": "part_key"}, normalized=True)])
        roles = {"ordered": F.col("o_orderdate"), "shipped": F.col("l_shipdate"), "due": F.date_add("o_orderdate", 90)}
        keyed = dimensional.with_dates(found, dates, roles)
        customer = F.coalesce("customer_key", F.lit(dimensional.UNKNOWN)).alias("customer_key")
        return keyed.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "part_key", customer, *[f"{r}_date_key" for r in roles], F.col("quantity").cast("double").alias("quantity"))

    return model.build(spark)["fact"]


def self_service_cube(spark, d):
    """Orders and their value by any of status, priority and year."""
    o = _t(spark, d, "orders").select(F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").cast("long").alias("year"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    out = dimensional.cube(o, ["status", "priority", "year"], {"n_orders": F.count("*"), "value": F.sum("price")}, {"mean": F.col("value").cast("double") / F.col("n_orders")})
    return out.withColumn("value", F.col("value").cast("double"))


# --- privacy, specs, extraction

KEYS = {"k1": b"0123456789abcdef", "k2": b"fedcba9876543210"}


def masked_customer(spark, d):
    """Names by a keyed hash, segments masked, balances gone; nations go through encryption and back, and only with the right key."""
    c = _t(spark, d, "customer").withColumn("secret", F.col("c_nationkey").cast("string"))
    kept = privacy.protect(c, {"c_name": privacy.Policy("hash", key_id="k1"), "c_mktsegment": privacy.Policy("mask", 3), "c_acctbal": privacy.Policy("null"), "secret": privacy.Policy("encrypt", key_id="k2")}, KEYS)
    back = privacy.reveal(kept.withColumn("locked", F.col("secret")), {"secret": "int"}, KEYS)
    return privacy.reveal(back, {"locked": "int"}, {"k2": KEYS["k1"]}).select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "secret", "locked")


SPEC_QUERIES = [
    {"name": "spent", "sql": "WITH customer AS (SELECT o_custkey AS k, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM lake.sales.orders GROUP BY o_custkey) SELECT * FROM customer"},
    {"name": "named", "sql": "SELECT customer.c_custkey, 'lake.sales.orders' AS origin, total FROM lake.sales.customer LEFT JOIN spent ON k = customer.c_custkey -- lake.sales.none"},
]


def rewritten_spec(spark, d):
    """Queries over three-part names as a spec: sources found by the parser, names rewritten, the product built."""
    store = _store(spark)
    for t in ("orders", "customer"):
        store.load(f"lake.sales.{t}", "overwrite", _t(spark, d, t), [])
    target = {"lakehouse": "lake", "schema": "marts", "table": "spending", "load_strategy": "overwrite"}
    made = products.run_product(spark, specs.spec_of(spark, target, SPEC_QUERIES), store)
    return store.read(made.table).withColumn("total", F.col("total").cast("double"))


def product_versions(spark, d):
    """A type_two product of two runs with numbers for versions, an unknown member and an incremental source."""
    store = _store(spark)
    c = _t(spark, d, "customer").select("c_custkey", "c_mktsegment")
    spec = {
        "target": {"lakehouse": "lake", "schema": "marts", "table": "segment", "load_strategy": "type_two", "key_columns": ["c_custkey"], "identity": True, "unknown_record": True},
        "source": [{"name": "customer", "lakehouse": "lake", "schema": "sales", "table": "customer", "incremental": True}],
        "query": [{"name": "q", "sql": "SELECT c_custkey, c_mktsegment AS segment FROM customer"}],
    }
    store.load("lake.sales.customer", "overwrite", c.where("c_custkey % 4 <> 0"), ["c_custkey"])
    products.run_product(spark, spec, store, F.lit(NOW).cast("timestamp"))
    changed = c.where("c_custkey % 4 IN (0, 1)").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 4 == 1, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")))
    store.load("lake.sales.customer", "merge", changed, ["c_custkey"])
    for _ in range(2):  # the second run has nothing to do
        products.run_product(spark, spec, store, F.lit(LATER).cast("timestamp"))
    return store.read("lake.marts.segment")


def split_extract(spark, d):
    """Orders read in twelve parts: one value has a fifth of all rows, some have none."""
    odd = F.when(F.col("o_orderkey") % 5 == 0, 7).when(F.col("o_orderkey") % 50 != 3, F.col("o_custkey"))
    o = _t(spark, d, "orders").select("o_orderkey", odd.cast("long").alias("k"))
    return incremental.extract_parts(o, incremental.split_predicates(o, "k", 12)).drop("part")


_FLAG = {
    "r01": "l_returnflag <> 'N'", "r02": "l_discount BETWEEN 0 AND 0.05", "r03": "l_linestatus IN ('O', 'X')", "r04": "l_returnflag IN ('A', 'N')", "r05": "length(CAST(l_partkey AS VARCHAR)) BETWEEN 2 AND 3",
    "r06": "l_suppkey <= l_partkey", "r07": "count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1",
}
_FLAGS = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, " + ", ".join(f"CASE WHEN {v} THEN 1 ELSE 0 END AS dq_{k}" for k, v in _FLAG.items()) + " FROM lineitem"
_PROBLEM = {"x01": "unknown column no_such", "x02": "min is no number", "x03": "unknown type sideways", "x04": "no type", "x05": "not JSON"}
_TYPES = {k: (v or {}).get("type") for k, v in LINE_RULES.items()}


def _sql(value) -> str:
    return "NULL" if value is None else f"'{value}'"


_ODD = "CASE WHEN NOT o_totalprice BETWEEN 1000 AND 400000 THEN CASE WHEN o_orderstatus IN ('F', 'O') THEN 'dear' ELSE 'dear,state' END WHEN o_orderstatus NOT IN ('F', 'O') THEN 'state' END"
_DIM = """SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey, upper(trim(c_mktsegment)) AS segment, n_name AS nation, r_name AS region
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""
_KEY = "CASE WHEN {0} >= DATE '1993-01-01' AND {0} <= DATE '1997-12-31' THEN CAST(strftime({0}, '%Y%m%d') AS INT) ELSE -1 END"

PRODUCTS = {
    "rule_master": (
        rule_master,
        f"WITH f AS ({_FLAGS}), n AS (SELECT count(*) AS n_rows, [{', '.join(f'count(*) FILTER (dq_{k} = 0)' for k in _FLAG)}] AS broken FROM f) "
        + " UNION ALL ".join(
            f"SELECT '{k}' AS rule_id, {_sql(t)} AS type, {_sql(_PROBLEM.get(k))} AS problem, "
            + (f"n_rows, broken[{i + 1}] AS n_broken, CASE WHEN broken[{i + 1}] <= {0.5 if k == 'r02' else 0} * n_rows THEN 'passed' ELSE 'failed' END AS verdict FROM n" if k in _FLAG else "NULL, NULL, 'refused' FROM n")
            for i, (k, t) in enumerate(_TYPES.items())
        ),
    ),
    "compiled_rules": (compiled_rules, _FLAGS),
    "gated_load": (
        gated_load,
        f"WITH o AS (SELECT o_orderkey, {_ODD} AS broken FROM orders) SELECT o_orderkey, 'orders' AS feed, broken, CASE WHEN broken IS NOT NULL THEN 'run-1' END AS \"ETL_ID\", CASE WHEN broken IS NOT NULL THEN 'Quarantined' END AS \"Log_Status\" FROM o "
        "UNION ALL SELECT o_orderkey, 'shut', broken, 'run-2', 'Quarantined' FROM o WHERE broken IS NOT NULL",
    ),
    "quarantine_table": (
        quarantine_table,
        f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, TIMESTAMP '{NOW}' AS "Quarantined_Date_Time", 'run-1' AS "ETL_ID", 'Quarantined' AS "Log_Status", TIMESTAMP '{NOW}' AS "LoadDatetime",
        '{NOW[:10]}' AS "LoadDate", 'shop' AS source_system, false AS "Is_Deleted", TIMESTAMP '{NOW}' AS "ETL_Start_Date_Time", 'Failed' AS "DQ_Status", 'Duplicate' AS "Quarantine_Type"
        FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""",
    ),
    "ingestion_log": (
        ingestion_log,
        f"""SELECT 'sales' AS product_name, 'daily' AS feed_name, 'shop' AS source_system, 'lines' AS dataset_name, 'run-1' AS etl_id, count(*) FILTER (c > 1) AS total_rows, 'Duplicate' AS quarantine_type,
        'Standard' AS quarantine_level, '{NOW[:10]}' AS log_date, TIMESTAMP '{NOW}' AS log_datetime, 'l_orderkey~l_linenumber' AS primary_key_list, false AS is_notification_enabled,
        CAST(NULL AS TIMESTAMP) AS notification_datetime, count(*) AS read, count(*) FILTER (c = 1) AS inserts, true AS success
        FROM (SELECT count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS c FROM lineitem) HAVING count(*) FILTER (c > 1) > 0""",
    ),
    "dim_customer": (dim_customer, f"{_DIM} UNION ALL SELECT -1, -1, 'unknown', 'unknown', 'unknown'"),
    "fact_order_lines": (
        fact_order_lines,
        f"""WITH c AS ({_DIM}), p AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS part_key FROM part WHERE p_size > 5)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(part_key, -1) AS part_key, coalesce(customer_key, -1) AS customer_key, {_KEY.format("CAST(o_orderdate AS DATE)")} AS ordered_date_key,
        {_KEY.format("CAST(l_shipdate AS DATE)")} AS shipped_date_key, {_KEY.format("(CAST(o_orderdate AS DATE) + 90)")} AS due_date_key, CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS quantity
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN c ON o_custkey = c_custkey AND segment <> 'BUILDING' LEFT JOIN p ON p_partkey = l_partkey""",
    ),
    "self_service_cube": (
        self_service_cube,
        """SELECT status, priority, year, CAST(grouping(status, priority, year) AS BIGINT) AS grouping_id, count(*) AS n_orders, CAST(sum(price) AS DOUBLE) AS value,
        array_to_string(list_filter([CASE WHEN grouping(status) = 0 THEN 'status' END, CASE WHEN grouping(priority) = 0 THEN 'priority' END, CASE WHEN grouping(year) = 0 THEN 'year' END], lambda x: x IS NOT NULL), ',') AS chosen,
        CAST(sum(price) AS DOUBLE) / count(*) AS mean
        FROM (SELECT nullif(o_orderstatus, 'P') AS status, o_orderpriority AS priority, year(o_orderdate) AS year, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders) GROUP BY CUBE (status, priority, year)""",
    ),
    "masked_customer": (
        masked_customer,
        f"""SELECT c_custkey, sha256('{KEYS["k1"].decode()}' || c_name) AS c_name, repeat('*', length(c_mktsegment) - 3) || right(c_mktsegment, 3) AS c_mktsegment,
        CAST(NULL AS DOUBLE) AS c_acctbal, c_nationkey AS secret, CAST(NULL AS INT) AS locked FROM customer""",
    ),
    "rewritten_spec": (
        rewritten_spec,
        """SELECT c_custkey, 'lake.sales.orders' AS origin, CAST(total AS DOUBLE) AS total FROM customer
        LEFT JOIN (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
    ),
    "product_versions": (
        product_versions,
        f"""WITH c AS (SELECT c_custkey, c_mktsegment AS segment, c_custkey % 4 AS k FROM customer), a AS (SELECT *, row_number() OVER (ORDER BY c_custkey) AS segment_key FROM c WHERE k <> 0)
        SELECT c_custkey, segment, TIMESTAMP '{NOW}' AS active_start, CASE WHEN k = 1 THEN TIMESTAMP '{LATER}' END AS active_end, CASE WHEN k = 1 THEN 0 ELSE 1 END AS is_current, segment_key FROM a
        UNION ALL SELECT c_custkey, CASE WHEN k = 1 THEN lower(segment) ELSE segment END, TIMESTAMP '{LATER}', NULL, 1, (SELECT count(*) FROM a) + row_number() OVER (ORDER BY c_custkey) FROM c WHERE k IN (0, 1)
        UNION ALL SELECT NULL, 'unknown', NULL, NULL, NULL, -1""",
    ),
    "split_extract": (split_extract, "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 7 WHEN o_orderkey % 50 <> 3 THEN o_custkey END AS k FROM orders"),
}

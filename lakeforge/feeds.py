"""Queries that go through files, streams and extracts over the driver tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import functions as X
from . import incremental, runs, sources, streaming
from .operators import audit, quality
from .scratch import fresh_folder
from .store import TableStore


def _t(spark, d, name):
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


#: A feed's columns as a database calls them.
FEED = {"c_custkey": "bigint", "C Name!": "nvarchar(25)", "c_acctbal": "float", "c_nationkey": "tinyint", "c_mktsegment": "varchar(max)"}


def csv_feed(spark, d):
    """Customers as a delimited feed: written unless empty, read by a configuration with the database's types, cleaned names and only what is needed."""
    root = fresh_folder(spark, "feed")
    c = _t(spark, d, "customer").select("c_custkey", F.concat("c_name", F.lit(' "a|\nb"')).alias("C Name!"), "c_acctbal", "c_nationkey", "c_mktsegment")
    sources.write(c, f"{root}/customer", "csv", header="true", sep="|", quote='"', escape='"', nullValue="")
    assert not sources.write(c.limit(0), f"{root}/none", "csv", skip_empty=True)
    schema = ", ".join(f"`{n}` {X.source_type(kind)}" for n, kind in FEED.items())
    options = {"delimiter": "|", "header": "true", "multiline": "true", "escape": '"'}
    read = sources.read(spark, "csv", f"{root}/customer", options, schema, ["*", "_metadata.file_path IS NOT NULL AS from_file"])
    fresh = sources.modified_since(sources.read(spark, "csv", f"{root}/customer", options, schema), F.lit("2000-01-01").cast("timestamp")).count()
    named = read.select(*[F.col(f"`{c}`").alias(X.clean_name(c)) for c in read.columns])
    return named.drop("c_mktsegment").withColumns({"c_nationkey": F.col("c_nationkey").cast("int"), "n_fresh": F.lit(fresh)})


def streamed_events(spark, d):
    """Events as a stream of files: two drains of a folder that grows, each micro-batch through a chain of steps and a merge; a third has nothing to do."""
    store, root = TableStore(spark, fresh_folder(spark, "tables")), fresh_folder(spark, "stream")
    e = _t(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    schema = "event_id long, user_id long, event_type string, value double"
    for k in range(3):
        if k < 2:  # the second drop has the events of the first again, with new values
            part = e.where("event_id % 2 = 0") if k == 0 else e.where("event_id % 4 <> 0").withColumn("value", -F.col("value"))
            part.repartition(2).write.mode("append").parquet(f"{root}/in")
        stream = sources.read_stream(spark, "parquet", f"{root}/in", schema, {"maxFilesPerTrigger": "2"})
        chain = [lambda b: b.where("event_type <> 'error'"), lambda b: b.withColumn("event_type", F.upper("event_type"))]
        streaming.start(stream, store, "events", "merge", ["event_id"], f"{root}/checkpoint", "batch", chain, changed=["value"]).awaitTermination()
    return store.read("events")


def offline_extract(spark, d):
    """The extracts of a database over files of its tables: by a time mark with a filter, and net changes after a log position."""
    e = _t(spark, d, "events").select("event_id", "user_id", "ts", F.when(F.col("event_type") == "error", "delete").otherwise("update").alias("operation"), F.unhex(F.lpad(F.hex("event_id"), 16, "0")).alias("lsn"))
    half = e.agg(F.max("event_id")).first()[0] // 2
    config = {"table": "t", "ingestType": "watermark", "sourceWatermarkIdentifier": "ts", "filterExpression": "And operation = 'update'", "columns": ["event_id", "user_id"]}
    state = incremental.advance(e.where(F.col("event_id") <= half), "ts")
    later = incremental.extract_offline(e, config, state).select("event_id", "user_id", F.lit("by time").alias("how"), F.lit(0).alias("is_deleted"))
    lsn = incremental.advance(e.where(F.col("event_id") <= half), "lsn")["value"]
    net = incremental.net_changes_offline(e, ["user_id"], "lsn", lsn).select("event_id", "user_id", F.lit("by position").alias("how"), "is_deleted")
    first = incremental.extract_offline(e, {"table": "t", "ingestType": "cdc", "sourceWatermarkIdentifier": "lsn", "columns": ["event_id", "user_id"]}).select("event_id", "user_id", F.lit("first").alias("how"), F.lit(0).alias("is_deleted"))
    return later.unionByName(net).unionByName(first)


def row_counts(spark, d):
    """Verdicts on how many parts each brand has now and had before; brands that went, came and grew."""
    p = _t(spark, d, "part")
    now = p.where("p_size > 10 OR p_brand < 'Brand#2'").where("p_brand <> 'Brand#11'").groupBy("p_brand").agg(F.count("*").alias("now"))
    before = p.where("p_size > 10 AND p_brand <> 'Brand#12' AND (p_brand <> 'Brand#13' OR p_size > 40)").groupBy("p_brand").agg(F.count("*").alias("before"))
    return quality.row_count_verdicts(now.join(before, "p_brand", "full_outer"), "now", "before", least=5)


def open_zones(spark, d):
    """Zones of runs that didn't end well or haven't begun, from the stored log."""
    log = audit.ZoneLog(TableStore(spark, fresh_folder(spark, "tables")))
    users = _t(spark, d, "events").select("user_id").distinct()
    expected = users.select(F.concat(F.lit("r"), F.col("user_id")).alias("run_id"), F.col("user_id").alias("etl_id"), F.lit("shop").alias("product_name"), F.concat(F.lit("f"), F.col("user_id") % 2).alias("feed_name"))
    log.expect(expected, [("Raw", "Ingestion"), ("Shared", "Publish")])
    log.record(audit.messages(runs._messages(spark, d), "body").where("raw"))
    return log.rows(open_only=True).select("etl_id", "zone", "zone_status")


_HALF = "(SELECT max(event_id) // 2 FROM events)"

FEEDS = {
    "csv_feed": (csv_feed, "SELECT c_custkey, c_name || ' \"a|' || chr(10) || 'b\"' AS cname, c_acctbal, c_nationkey, true AS from_file, (SELECT count(*) FROM customer) AS n_fresh FROM customer"),
    "streamed_events": (
        streamed_events,
        "SELECT event_id, user_id, upper(event_type) AS event_type, CASE WHEN event_id % 4 <> 0 THEN -value ELSE value END AS value FROM events WHERE event_type <> 'error'",
    ),
    "offline_extract": (
        offline_extract,
        f"""SELECT event_id, user_id, 'by time' AS how, 0 AS is_deleted FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_id <= {_HALF}) AND event_type <> 'error'
        UNION ALL SELECT event_id, user_id, 'by position', CASE WHEN event_type = 'error' THEN 1 ELSE 0 END FROM (SELECT * FROM events WHERE event_id > {_HALF} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
        UNION ALL SELECT event_id, user_id, 'first', 0 FROM events""",
    ),
    "row_counts": (
        row_counts,
        """SELECT p_brand, nullif(n, 0) AS now, nullif(b, 0) AS before, CASE WHEN n < 5 THEN 'error' WHEN b > 0 AND n > 2 * b THEN 'warning' ELSE 'ok' END AS verdict
        FROM (SELECT p_brand, count(*) FILTER ((p_size > 10 OR p_brand < 'Brand#2') AND p_brand <> 'Brand#11') AS n,
        count(*) FILTER (p_size > 10 AND p_brand <> 'Brand#12' AND (p_brand <> 'Brand#13' OR p_size > 40)) AS b FROM part GROUP BY 1) WHERE n > 0 OR b > 0""",
    ),
    "open_zones": (
        open_zones,
        """WITH m AS (SELECT user_id, bool_or(event_type = 'error' OR (event_type = 'click' AND event_id % 7 = 0)) AS bad FROM events WHERE event_id % 3 = 0 AND event_id % 11 <> 10 GROUP BY 1),
        u AS (SELECT DISTINCT user_id FROM events) SELECT user_id AS etl_id, 'Raw' AS zone, CASE WHEN bad THEN 'Fail' ELSE 'Pending' END AS zone_status FROM u LEFT JOIN m USING (user_id) WHERE coalesce(bad, true)
        UNION ALL SELECT user_id, 'Shared', 'Pending' FROM u""",
    ),
}

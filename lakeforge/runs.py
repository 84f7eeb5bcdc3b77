"""Queries of run messages, zone logs and dataset catalogues over the driver tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import metadata
from .operators import audit
from .scratch import fresh_folder
from .store import TableStore


def _t(spark, d, name):
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def _messages(spark, d):
    """Events as messages of runs: raw copies, prepared loads, and some that are none."""
    e = _t(spark, d, "events")
    n, kind = F.col("event_id"), F.col("event_type")
    raw = n % 3 == 0
    iso, plain = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    detail = F.struct(F.when((kind == "click") & (n % 7 == 0), "Canceled").otherwise("Succeeded").alias("status"), iso.alias("start"))
    copied = F.struct(
        F.when(kind == "error", F.array(F.lit("no space"))).otherwise(F.array().cast("array<string>")).alias("errors"), F.array(detail).alias("executionDetails"), n.alias("dataRead"), (n * 2).alias("dataWritten"),
        F.when(n % 2 == 0, n % 100).alias("filesRead"), (n % 50).alias("rowsRead"), F.when(n % 2 == 0, n % 90).alias("filesWritten"), (n % 40).alias("rowsCopied"), (n / 4).alias("throughput"), (n % 60).alias("copyDuration"),
    )
    output = F.struct(plain.alias("zone_start_date_time"), F.when(n % 2 == 0, n).alias("total_rows_read"), F.when(n % 5 != 0, n - 1).alias("total_rows_written"), (n * 3).alias("total_data_written"))
    loaded = F.struct(F.when(kind == "error", "no key").alias("error_message"), output.alias("runOutput"))
    common = [
        F.concat(F.lit("r"), F.col("user_id")).alias("run_id"), F.col("user_id").cast("string").alias("etl_id"), F.lit("shop").alias("product_name"), F.concat(F.lit("f"), F.col("user_id") % 2).alias("feed_name"),
        F.lit("web").alias("source_system"), kind.alias("dataset_name"), F.when(raw, "Raw").when(n % 3 == 1, "Prepared").alias("zone"), F.lit("Transformation").alias("stage"),
    ]
    body = F.when(raw, F.to_json(F.struct(*common, iso.alias("zone_end_date_time"), copied.alias("metadata")))).otherwise(F.to_json(F.struct(*common, plain.alias("zone_end_date_time"), loaded.alias("metadata"))))
    return e.select(F.when(n % 11 == 10, F.lit("{broken")).otherwise(body).alias("body"))


def run_log(spark, d):
    """Messages as rows of the log of source ingestions; the text of metadata by its length."""
    rows = audit.ingestion_log(audit.messages(_messages(spark, d), "body"), F.lit("me"))
    return rows.withColumn("metadata", (F.length("metadata") > 10).cast("int"))


def stored_zone_log(spark, d):
    """The stored zone log: all users' runs are expected in three zones, then their messages are recorded."""
    log = audit.ZoneLog(TableStore(spark, fresh_folder(spark, "tables")))
    users = _t(spark, d, "events").select("user_id").distinct()
    runs = users.select(F.concat(F.lit("r"), F.col("user_id")).alias("run_id"), F.col("user_id").alias("etl_id"), F.lit("shop").alias("product_name"), F.concat(F.lit("f"), F.col("user_id") % 2).alias("feed_name"))
    log.expect(runs, [("Raw", "Ingestion"), ("Prepared", "Transformation"), ("Shared", "Publish")])
    log.record(audit.messages(_messages(spark, d), "body"))
    return log.rows()


def catalog_loader(spark, d):
    """Configuration documents, one a brand, in folders of which some are skipped; read back by their nested schema and merged twice into the catalogue."""
    store, root = TableStore(spark, fresh_folder(spark, "tables")), fresh_folder(spark, "documents")
    brands = _t(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n"), F.max("p_size").alias("size"), F.substring(F.max("p_brand"), 7, 1).alias("s"))
    text = F.to_json(
        F.struct(
            F.col("p_brand").alias("datasetName"), F.lit("database").alias("datasetTypeName"), F.when(F.col("s") != "2", F.concat(F.lit("db"), F.col("s"))).alias("databaseName"),
            F.when(F.col("s") != "3", F.struct(F.when(F.col("n") % 2 == 0, "full").otherwise("watermark").alias("ingestType"))).alias("sourceSystemProperties"),
            F.struct(F.concat(F.lit("load"), F.col("n")).alias("targetLoadType"), F.array(F.lit("k")).alias("primaryKeyList")).alias("curatedProperties"),
        ),
        {"pretty": "true"},
    )
    folder = F.when(F.col("s") == "4", "Watermark").otherwise("config")
    brands.select(F.concat(F.lit("b"), "s").alias("shortcut"), folder.alias("kind"), F.col("p_brand").alias("of"), text.alias("value")).write.partitionBy("shortcut", "kind", "of").text(root)
    for _ in range(2):
        metadata.load_datasets(store, root, skip=["kind=watermark"], pattern="*.txt")
    return store.read("catalog.datasets")


def dataset_configs(spark, d):
    """Configurations of brands, whose columns are the words of their parts' types; some are personal, some mark increments."""
    p = _t(spark, d, "part").select("p_brand", "p_size", "p_type")
    word = F.when(F.col("w") == "small", "UpdateOn").when((F.col("w") == "large") & (F.col("p_brand") > "Brand#3"), "EnteredOn").otherwise(F.col("w"))
    columns = p.select("p_brand", "p_size", F.explode(F.split(F.lower("p_type"), " ")).alias("w")).groupBy(F.col("p_brand").alias("dataset_name"), word.alias("column_name"))
    columns = columns.agg(F.min("p_size").alias("column_ordinal")).withColumn("column_data_type", F.when(F.col("column_name") == "medium", "geography").otherwise("varchar"))
    keys = p.groupBy(F.col("p_brand").alias("dataset_name")).agg(F.when(F.count("*") % 2 == 0, " a, b ,").alias("primary_key_list"))
    personal = columns.where("column_name IN ('promo', 'UpdateOn')").select("dataset_name", "column_name", F.when(F.col("dataset_name") < "Brand#2", 0).otherwise(1).alias("include_in_load"))
    c, join = F.col("config"), lambda x: F.array_join(x, "|")
    found = metadata.dataset_configs(columns, keys, personal, {"databaseName": "shop"})
    return found.select(
        "dataset_name", c["databaseName"].alias("database_name"), c["sourceSystemProperties"]["ingestType"].alias("ingest_type"), c["sourceSystemProperties"]["sourceWatermarkIdentifier"].alias("mark"),
        join(c["sourceSystemProperties"]["includeSpecificColumns"]).alias("selects"), c["curatedProperties"]["targetLoadType"].alias("load_type"), join(c["curatedProperties"]["primaryKeyList"]).alias("primary_keys"),
        join(c["curatedProperties"]["partitionKeyList"]).alias("partitions"),
    )


_M = """m AS (SELECT *, event_id % 3 = 0 AS raw, CASE event_id % 3 WHEN 0 THEN 'Raw' ELSE 'Prepared' END AS zone, event_type = 'error' OR (event_id % 3 = 0 AND event_type = 'click' AND event_id % 7 = 0) AS failed
    FROM (SELECT event_id, event_type, user_id, CASE WHEN event_id % 3 = 0 THEN ts ELSE date_trunc('second', ts) END AS ts FROM events) WHERE event_id % 3 <> 2 AND event_id % 11 <> 10)"""

RUNS = {
    "run_log": (
        run_log,
        f"""WITH {_M} SELECT 'r' || user_id AS run_id, 'shop' AS product_name, 'web' AS source_system, event_type AS dataset_name, 'f' || (user_id % 2) AS feed_name, 1 AS metadata, ts AS start_time, ts AS end_time,
        CASE WHEN raw THEN event_id WHEN event_id % 2 = 0 THEN event_id ELSE -1 END AS data_read, CASE WHEN raw THEN 2 * event_id WHEN event_id % 5 <> 0 THEN event_id - 1 ELSE -1 END AS data_written,
        CASE WHEN raw THEN CASE WHEN event_id % 2 = 0 THEN event_id % 100 ELSE event_id % 50 END END AS files_read, CASE WHEN raw THEN CASE WHEN event_id % 2 = 0 THEN event_id % 90 ELSE event_id % 40 END END AS files_written,
        CASE WHEN failed THEN 'Failed' ELSE 'Success' END AS status, CASE WHEN raw THEN event_id / 4 END AS throughput, CASE WHEN raw THEN event_id % 60 END AS copy_duration, 'me' AS inserted_by, 'me' AS modified_by, zone FROM m""",
    ),
    "stored_zone_log": (
        stored_zone_log,
        f"""WITH {_M}, g AS (SELECT user_id, zone, min_by(ts, ts) AS begun, max(ts) AS ended, bool_or(failed) AS bad, sum(CASE WHEN raw THEN 2 ELSE 3 END * event_id) AS bytes, count(*) FILTER (failed) AS errors FROM m GROUP BY 1, 2),
        z AS (SELECT user_id, unnest(['Raw', 'Prepared', 'Shared']) AS zone, unnest(['Ingestion', 'Transformation', 'Publish']) AS stage FROM (SELECT DISTINCT user_id FROM events))
        SELECT 'r' || user_id AS run_id, user_id AS etl_id, 'shop' AS product_name, 'f' || (user_id % 2) AS feed_name, zone, stage, coalesce(begun, TIMESTAMP '1900-01-01') AS zone_start_date_time, ended AS zone_end_date_time,
        CASE WHEN bad THEN 'Fail' WHEN bad IS NULL THEN 'Pending' ELSE 'Success' END AS zone_status, CASE WHEN bad THEN 0 ELSE CAST(bytes AS BIGINT) END AS total_data_storage, CAST(NULL AS INT) AS total_models_shared,
        CAST(NULL AS INT) AS total_retry_count, CAST(errors AS INT) AS total_error_count, CAST(NULL AS VARCHAR) AS invocation_id FROM z LEFT JOIN g USING (user_id, zone)""",
    ),
    "catalog_loader": (
        catalog_loader,
        """SELECT 'shortcut=b' || s AS shortcut_name, p_brand AS dataset_name, 'database' AS dataset_type_name, CASE WHEN s <> '2' THEN 'db' || s END AS database_name,
        CASE WHEN s <> '3' THEN CASE WHEN n % 2 = 0 THEN 'full' ELSE 'watermark' END END AS source_system_ingest_type, 'load' || n AS target_load_type
        FROM (SELECT p_brand, substr(p_brand, 7, 1) AS s, count(*) AS n FROM part GROUP BY 1, 2) WHERE s <> '4'""",
    ),
    "dataset_configs": (
        dataset_configs,
        """WITH w AS (SELECT p_brand AS b, p_size, unnest(string_split(lower(p_type), ' ')) AS w FROM part),
        c AS (SELECT b, CASE WHEN w = 'small' THEN 'UPDATEON' WHEN w = 'large' AND b > 'Brand#3' THEN 'ENTEREDON' ELSE upper(w) END AS c, min(p_size) AS o,
            CASE WHEN w = 'small' THEN 'UpdateOn' WHEN w = 'large' AND b > 'Brand#3' THEN 'EnteredOn' ELSE w END AS n FROM w GROUP BY ALL),
        k AS (SELECT * FROM c WHERE NOT (c IN ('PROMO', 'UPDATEON') AND b < 'Brand#2')),
        g AS (SELECT b, string_agg(CASE WHEN c = 'MEDIUM' THEN 'CAST(medium AS VARCHAR(255)) AS medium' ELSE c END, '|' ORDER BY o, n) AS own, bool_or(c = 'UPDATEON') AS u, bool_or(c = 'ENTEREDON') AS e FROM k GROUP BY b),
        p AS (SELECT p_brand AS b, count(*) % 2 = 0 AS keyed FROM part GROUP BY 1)
        SELECT b AS dataset_name, 'shop' AS database_name, CASE WHEN u OR e THEN 'watermark' ELSE 'full' END AS ingest_type,
        CASE WHEN u AND e THEN 'COALESCE(UPDATEON, ENTEREDON)' WHEN u THEN 'UPDATEON' WHEN e THEN 'ENTEREDON' END AS mark,
        own || CASE WHEN u THEN '|YEAR(UPDATEON) AS updateon_year|MONTH(UPDATEON) AS updateon_month' WHEN e THEN '|YEAR(ENTEREDON) AS enteredon_year|MONTH(ENTEREDON) AS enteredon_month' ELSE '' END AS selects,
        CASE WHEN keyed THEN 'merge' ELSE 'overwrite' END AS load_type, CASE WHEN keyed THEN 'a|b' ELSE '' END AS primary_keys,
        CASE WHEN u THEN 'updateon_year|updateon_month' WHEN e THEN 'enteredon_year|enteredon_month' END AS partitions FROM g JOIN p USING (b)""",
    ),
}

"""Zone logs, event folds and load metrics over audit rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import loads

#: Fields of an ingestion event's message.
EVENT = "struct<status: string, size: string, started: timestamp, zone: string>"


def pending_entries(expected: DataFrame, log: DataFrame, keys: list[str]) -> DataFrame:
    """The log with an entry ``pending`` for each expected key that it lacks."""
    return log.unionByName(loads._without(expected.select(*keys).distinct(), log, keys).withColumn("status", F.lit("pending")), allowMissingColumns=True)


def merge_status(log: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """The entries with the statuses and values that were seen since; unknown keys add nothing."""
    return loads.update_matched(log, seen, keys)


def entries(log: DataFrame, status: str, ids: Column | None = None) -> DataFrame:
    """Entries of a status, of those ids that the condition names."""
    return log.where((F.col("status") == status) & (F.lit(True) if ids is None else ids))


def fold_events(events: DataFrame, keys: list[str], message: str) -> DataFrame:
    """One row for each key and zone: first start, bytes (missing sizes count nothing), events and the worst status, from JSON messages."""
    # The zone alone is looked up first, so that a message is parsed once.
    m = events.where(F.get_json_object(message, "$.zone").isNotNull()).select(*keys, F.from_json(message, EVENT).alias("m"))
    worst = F.when(F.max((F.col("m.status") == "failed").cast("int")) == 1, "failed").when(F.max((F.col("m.status") == "running").cast("int")) == 1, "running").otherwise("done")
    return m.groupBy(*keys, F.col("m.zone").alias("zone")).agg(
        F.min("m.started").alias("started"), F.coalesce(F.sum(F.expr("try_cast(m.size AS bigint)")), F.lit(0)).alias("bytes"), F.count("*").alias("n_events"), worst.alias("status")
    )


def by_operation(history: DataFrame, operation: str, measures: list[str]) -> DataFrame:
    """Sums of the measures for each operation; missing measures count nothing."""
    return history.groupBy(operation).agg(F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in measures])


def dictionaries(df: DataFrame, by: str, fields: list[str], name: str) -> DataFrame:
    """The rows of each group as JSON objects in order; for small tables, as catalogues are."""
    return df.groupBy(by).agg(F.array_join(F.array_sort(F.collect_list(F.to_json(F.struct(*fields)))), ",").alias(name))


# --- run messages

#: The parts of a run's message that logs keep.
MESSAGE = (
    "run_id string, etl_id string, product_name string, feed_name string, source_system string, dataset_name string, zone string, stage string, zone_end_date_time string, "
    "metadata struct<errors: array<string>, error_message: string, executionDetails: array<struct<status: string, start: string, duration: long>>, "
    "dataRead: long, dataWritten: long, filesRead: int, filesWritten: int, rowsRead: int, rowsCopied: int, throughput: double, copyDuration: int, "
    "runOutput: struct<zone_start_date_time: string, zone_end_date_time: string, total_rows_read: long, total_rows_written: long, total_data_written: long, error_message: string>>"
)
FORMATS = ("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][X]", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss")
#: What a zone's start is while it hasn't begun.
NOT_BEGUN = "1900-01-01 00:00:00"
ZONE_KEYS = ["run_id", "etl_id", "zone", "stage"]
ZONE_LOG = (
    "run_id string, etl_id bigint, product_name string, feed_name string, zone string, stage string, zone_start_date_time timestamp, zone_end_date_time timestamp, zone_status string, "
    "total_data_storage bigint, total_models_shared int, total_retry_count int, total_error_count int, invocation_id string"
)


def _time(text: Column) -> Column:
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in FORMATS])


def messages(df: DataFrame, body: str) -> DataFrame:
    """Parsed messages ``m`` with ``raw`` (is it of the raw zone), ``failed``, ``started``, ``ended`` and the text of ``metadata``. What is no message is left out.

    A message of the raw zone failed if it has errors or was cancelled, one of the prepared zone if it names an error.
    """
    parsed = df.select(body, F.from_json(body, MESSAGE).alias("m"), F.get_json_object(body, "$.metadata").alias("metadata")).where("m.zone IS NOT NULL AND m.run_id IS NOT NULL")
    raw, first = F.col("m.zone") == "Raw", F.get("m.metadata.executionDetails", 0)
    broken = F.when(raw, (F.coalesce(F.size("m.metadata.errors"), F.lit(0)) > 0) | F.coalesce(first["status"] == "Canceled", F.lit(False)))
    broken = broken.otherwise(F.coalesce("m.metadata.error_message", "m.metadata.runOutput.error_message").isNotNull())
    return parsed.withColumns({
        "raw": raw, "failed": broken, "started": _time(F.when(raw, first["start"]).otherwise(F.col("m.metadata.runOutput.zone_start_date_time"))), "ended": _time(F.col("m.zone_end_date_time")),
    })


def ingestion_log(found: DataFrame, user: Column | None = None) -> DataFrame:
    """The 18 columns of the log of source ingestions, a row a message. A raw message counts files, or rows of a database; a prepared one rows, -1 where it doesn't say."""
    user = F.current_user() if user is None else user
    meta, raw = F.col("m.metadata"), F.col("raw")
    rows = {
        "data_read": F.when(raw, meta["dataRead"]).otherwise(F.coalesce(meta["runOutput"]["total_rows_read"], F.lit(-1))),
        "data_written": F.when(raw, meta["dataWritten"]).otherwise(F.coalesce(meta["runOutput"]["total_rows_written"], F.lit(-1))),
        "files_read": F.when(raw, F.coalesce(meta["filesRead"], meta["rowsRead"])), "files_written": F.when(raw, F.coalesce(meta["filesWritten"], meta["rowsCopied"])),
        "status": F.when(F.col("failed"), "Failed").otherwise("Success"), "throughput": F.when(raw, meta["throughput"]), "copy_duration": F.when(raw, meta["copyDuration"]),
        "inserted_by": user, "modified_by": user, "zone": F.col("m.zone"),
    }
    names = ("run_id", "product_name", "source_system", "dataset_name", "feed_name")
    return found.select(*[F.col(f"m.{n}").alias(n) for n in names], "metadata", F.col("started").alias("start_time"), F.col("ended").alias("end_time"), *[v.alias(k) for k, v in rows.items()])


def fold_zones(found: DataFrame) -> DataFrame:
    """One row for each run and zone, with the zone log's columns: the latest message's names and end, the earliest one's start, and whether any failed; bytes only of zones that didn't.

    Messages of equal ends are ordered by their text.
    """
    size = F.when(F.col("raw"), F.col("m.metadata.dataWritten")).otherwise(F.col("m.metadata.runOutput.total_data_written"))
    order = F.struct("ended", "metadata")
    last = F.struct("m.run_id", "m.product_name", "m.feed_name", "m.stage", "ended")
    grouped = found.groupBy(F.expr("try_cast(m.etl_id AS bigint)").alias("etl_id"), F.col("m.zone").alias("zone")).agg(
        F.max_by(last, order).alias("l"), F.min_by("started", order).alias("begun"), F.bool_or("failed").alias("bad"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"), F.count_if("failed").cast("int").alias("errors")
    )
    return grouped.select(
        F.col("l.run_id").alias("run_id"), "etl_id", F.col("l.product_name").alias("product_name"), F.col("l.feed_name").alias("feed_name"), "zone",
        F.when(F.col("zone") == "Raw", "Ingestion").otherwise(F.col("l.stage")).alias("stage"), F.coalesce("begun", F.lit(NOT_BEGUN).cast("timestamp")).alias("zone_start_date_time"),
        F.col("l.ended").alias("zone_end_date_time"), F.when(F.col("bad"), "Fail").otherwise("Success").alias("zone_status"), F.when(F.col("bad"), 0).otherwise(F.col("bytes")).alias("total_data_storage"),
        F.col("errors").alias("total_error_count"),
    )


def pending_zones(runs: DataFrame, stages: list[tuple[str, str]]) -> DataFrame:
    """The zone log's rows of runs (run_id, etl_id, product_name, feed_name) that are to go through stages (zone, stage)."""
    each = F.array(*[F.struct(F.lit(z).alias("zone"), F.lit(s).alias("stage")) for z, s in stages])
    rows = runs.select("run_id", "etl_id", "product_name", "feed_name", F.inline(each)).withColumns({"zone_start_date_time": F.lit(NOT_BEGUN).cast("timestamp"), "zone_status": F.lit("Pending")})
    kinds = {c.strip().split(" ")[0]: c.strip().split(" ")[1] for c in ZONE_LOG.split(",")}
    return rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()])


class ZoneLog:
    """The stored zone log: pending rows of runs, and what their messages said since."""

    def __init__(self, store, table: str = "audit.etl_zone_log"):
        self.store, self.table = store, table

    def expect(self, runs: DataFrame, stages: list[tuple[str, str]]) -> int:
        """Pending rows for runs that have none; what runs again is pending again."""
        rows = pending_zones(runs, stages)
        if not self.store.exists(self.table):
            return self.store.load(self.table, "append", rows, ZONE_KEYS)
        known = [c for c in rows.columns if c not in ("total_models_shared", "total_retry_count", "total_error_count")]
        return self.store.load(self.table, "merge", rows.select(*known), ZONE_KEYS)

    def record(self, found: DataFrame) -> int:
        """The zones of messages: known ones get their status, times and bytes, others are added."""
        return self.store.load(self.table, "merge", fold_zones(found), ZONE_KEYS)

    def rows(self, etl_id: int | None = None, open_only: bool = False) -> DataFrame:
        """Rows of a run or of all; with ``open_only`` those that didn't end well."""
        out = self.store.read(self.table) if etl_id is None else self.store.read(self.table, ranges={"etl_id": (etl_id, etl_id)})
        return out.where("NOT zone_status <=> 'Success'") if open_only else out

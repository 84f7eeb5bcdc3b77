"""Ingestion as one flow: duplicates and broken rows to quarantine, a gate, the load, and what was counted.

The source is read once: each row is classed, counted as it is written aside, and every
later step reads the part it needs.
"""

from __future__ import annotations

import datetime
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .operators import rules as R
from .operators import windows
from .store import TableStore

GOOD, DUPLICATE, BROKEN = 0, 1, 2
#: How broken rows join those in quarantine.
QUARANTINE = ("append", "merge")
LOG = "quarantine_log"


@dataclass
class Run:
    """Who loads what; goes into quarantine rows and logs."""

    etl_id: str
    product: str = ""
    feed: str = ""
    source_system: str = ""
    started: datetime.datetime | None = None
    #: The time that rows get; a fixed one makes a run repeatable.
    now: Column = field(default_factory=F.current_timestamp)


@dataclass
class Metrics:
    """What became of a run; ``success`` is false if the gate was shut or an error came."""

    eltId: str
    table: str
    startTime: str
    endTime: str = ""
    sourceDataCount: int = 0
    duplicates: int = 0
    broken: int = 0
    success: bool = False
    version: int | None = None
    inserts: int = 0
    updates: int = 0
    deletes: int = 0
    bytes: int = 0
    error: str = ""

    def as_dict(self) -> dict:
        return asdict(self)


def _stamp() -> str:
    return datetime.datetime.now(datetime.timezone.utc).isoformat()


def quarantined(rows: DataFrame, run: Run, external: bool = False) -> DataFrame:
    """Rows with the columns of a quarantine table; ``external`` tables have six more."""
    more = {"Quarantined_Date_Time": run.now, "ETL_ID": F.lit(run.etl_id), "Log_Status": F.lit("Quarantined")}
    if external:
        started = F.lit(run.started).cast("timestamp") if run.started else run.now
        more |= {
            "LoadDatetime": run.now, "LoadDate": run.now.cast("date"), "source_system": F.lit(run.source_system), "Is_Deleted": F.lit(False),
            "ETL_Start_Date_Time": started, "DQ_Status": F.lit("Failed"),
        }
    return rows.withColumns(more)


def log_rows(store: TableStore, table: str, kind: str, keys: list[str], n: int, run: Run) -> DataFrame:
    """A row for the quarantine log: what was put away by which run, and by which keys."""
    values = {
        "product_name": F.lit(run.product), "feed_name": F.lit(run.feed), "source_system": F.lit(run.source_system), "dataset_name": F.lit(table), "etl_id": F.lit(run.etl_id),
        "total_rows": F.lit(n).cast("long"), "quarantine_type": F.lit(kind), "quarantine_level": F.lit("Standard"), "log_date": run.now.cast("date"), "log_datetime": run.now,
        "primary_key_list": F.lit("~".join(keys)), "is_notification_enabled": F.lit(False), "notification_datetime": F.lit(None).cast("timestamp"),
    }
    return store.spark.range(1).select(*[v.alias(k) for k, v in values.items()])


def ingest(
    store: TableStore, table: str, source: DataFrame, keys: list[str], strategy: str, run: Run, duplicates: str | None = None, order: list[Column] | None = None,
    rules: list[R.Rule] = (), most_broken: float = 0.0, quarantine: str = "append", external: bool = False, **options,
) -> Metrics:
    """Load a source's good rows into ``table``; others go to ``<table>_quarantined``, with a row in the log.

    Duplicates are told apart first (``duplicates`` is a mode of ``windows.MODES``), rules judge
    the rest. With more than the share ``most_broken`` of the judged rows broken nothing is loaded.
    A rule fails with its own ``mostly``: such a rule breaks the load, but its rows only count where
    they fail. A run that is done again under the same etl_id changes nothing.
    """
    if quarantine not in QUARANTINE:
        raise ValueError(f"unknown quarantine strategy {quarantine!r}; one of {QUARANTINE}")
    found = Metrics(run.etl_id, table, _stamp())
    aside = f"{store.root}/{table}/aside/{uuid.uuid4().hex}"
    try:
        marked = windows.mark_duplicates(source, keys, duplicates, order, "__twice") if duplicates else source.withColumn("__twice", F.lit(0))
        judged = R.flags(marked, rules, "__dq_")
        broken = F.array_compact(F.array(*[F.when(F.col(f"`__dq_{r.rule_id}`") == 0, F.lit(r.rule_id)) for r in rules])) if rules else F.array().cast("array<string>")
        kind = F.when(F.col("__twice") == 1, DUPLICATE).when(F.size("dq_broken") > 0, BROKEN).otherwise(GOOD)
        classed = judged.withColumn("dq_broken", broken).withColumn("__class", kind)
        seen = Observation()
        fails = [F.count_if(F.array_contains("dq_broken", r.rule_id) & (F.col("__class") != DUPLICATE)).alias(f"f{i}") for i, r in enumerate(rules)]
        counted = classed.observe(seen, F.count("*").alias("n"), *[F.count_if(F.col("__class") == c).alias(f"c{c}") for c in (DUPLICATE, BROKEN)], *fails)
        rows = counted.select(*[F.col(f"`{c}`") for c in source.columns], "dq_broken", "__class")
        rows.write.partitionBy("__class").parquet(aside)
        n = seen.get
        found.sourceDataCount, found.duplicates, found.broken = n["n"], n[f"c{DUPLICATE}"], n[f"c{BROKEN}"]
        kept = store.spark.read.schema(rows.schema).parquet(aside)
        batch = f"{run.etl_id}/{{}}"
        for one, name, how in ((DUPLICATE, "Duplicate", "append"), (BROKEN, "Expectation", quarantine)):
            if count := n[f"c{one}"]:
                put = quarantined(kept.where(F.col("__class") == one).drop("__class"), run, external).withColumn("Quarantine_Type", F.lit(name))
                away = f"{table}_quarantined"
                store.load(away, how, put, keys, batch.format(f"{away}-{name}"))
                store.load(LOG, "append", log_rows(store, table, name, keys, count, run), [], batch.format(f"{table}-{name}"))
        judged_rows = n["n"] - n[f"c{DUPLICATE}"]
        rules_pass = all(n[f"f{i}"] <= (1 - r.mostly) * judged_rows for i, r in enumerate(rules) if "mostly" in r.kwargs)
        found.success = n[f"c{BROKEN}"] <= most_broken * judged_rows and rules_pass
        if found.success:
            found.version = store.load(table, strategy, kept.where(F.col("__class") == GOOD).drop("__class", "dq_broken"), keys, batch.format(table), **options)
            done = store.metrics(table, found.version)
            found.inserts, found.updates, found.deletes, found.bytes = (done.get(k, 0) for k in ("inserted", "updated", "deleted", "bytes"))
    except Exception as e:
        found.error, found.success = str(e).split("\n")[0], False
        raise
    finally:
        found.endTime = _stamp()
        store._fs(store._path(aside)).delete(store._path(aside), True)
    return found

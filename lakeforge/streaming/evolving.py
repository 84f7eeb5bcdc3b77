"""JSON streams whose fields change: a schema log beside the checkpoint, and nothing that is lost on the way."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..store import ConcurrentCommit, TableStore
from . import trigger

#: Where fields and values go that the schema has no place for; lines that aren't JSON objects go there whole.
RESCUED = "_rescued_data"
MODES = ("restart", "rescue", "none")


class SchemaChanged(RuntimeError):
    """A batch has fields that the schema didn't have; the log has them now, so a restart takes them."""


class SchemaLog:
    """Numbered schemas beside a checkpoint; the newest counts."""

    def __init__(self, store: TableStore, checkpoint: str):
        self.store, self.folder = store, f"{checkpoint.rstrip('/')}_schemas"

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.store._names(self.folder) if n.removesuffix(".json").isdigit())

    def read(self) -> T.StructType | None:
        known = self.versions()
        return T.StructType.fromJson(json.loads(self.store._text(f"{self.folder}/{known[-1]:020d}.json"))) if known else None

    def write(self, schema: T.StructType) -> None:
        known = self.versions()
        if not self.store._publish(f"{self.folder}/{known[-1] + 1 if known else 0:020d}.json", schema.json()):
            raise ConcurrentCommit(self.folder)


def parsed(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Lines as columns of the schema and RESCUED: a JSON object of what has no column or doesn't fit its column's type."""
    fields, typed = F.from_json(value, "map<string,string>"), F.from_json(value, schema)
    rows = lines.select(F.col(value).alias("__line"), fields.alias("__all"), typed.alias("__row"))
    broken = F.lit(False)

    def misfit(k: Column) -> Column:
        out = broken
        for f in schema:
            out = out | ((k == f.name) & F.col(f"__row.`{f.name}`").isNull())
        return out

    left = F.map_filter("__all", lambda k, v: v.isNotNull() & (~k.isin(*schema.names) | misfit(k)) if schema.names else v.isNotNull())
    rescued = F.when(F.col("__all").isNull(), F.col("__line")).when(F.size(left) > 0, F.to_json(left))
    return rows.where("__line IS NOT NULL AND trim(__line) <> ''").select(*[F.col(f"__row.`{f.name}`").alias(f.name) for f in schema], rescued.alias(RESCUED))


def unknown_fields(lines: DataFrame, schema: T.StructType, value: str = "value") -> T.StructType:
    """Fields that lines have and the schema hasn't, with types inferred from all their values."""
    keys = F.map_keys(F.map_filter(F.from_json(value, "map<string,string>"), lambda k, v: v.isNotNull()))
    new = sorted(r[0] for r in lines.select(F.explode(keys).alias("k")).where(~F.col("k").isin(*schema.names) if schema.names else F.lit(True)).distinct().collect())  # names of fields
    if not new:
        return T.StructType()
    spark = lines.sparkSession
    texts = getattr(lines.select(value).where(f"{value} IS NOT NULL")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    found = T.StructType.fromJson(json.loads(spark._jsparkSession.read().json(texts).schema().json()))
    return T.StructType([f for f in found if f.name in new])


def start_evolving(
    path: str, store: TableStore, table: str, strategy: str, keys: list[str], checkpoint: str, schema: T.StructType | str, mode: str = "restart", when: str = "availableNow",
    chain: list[Callable[[DataFrame], DataFrame]] = (), options: dict | None = None, **load,
) -> StreamingQuery:
    """Load JSON lines of a folder into a table as they come; ``load`` are options of the strategy.

    ``restart``: a batch with new fields widens the logged schema and stops the stream with
    SchemaChanged; started again it loads that batch with its new columns. ``rescue``: new fields
    stay in RESCUED. ``none``: they are left out. The schema given counts until the log has one.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; one of {MODES}")
    log = SchemaLog(store, checkpoint)
    if log.read() is None:
        log.write(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)
    lines = store.spark.readStream.format("text").options(**(options or {})).load(path)

    def one(batch: DataFrame, batch_id: int) -> None:
        own = TableStore(batch.sparkSession, store.root)
        known = log.read()
        if mode == "restart" and (new := unknown_fields(batch, known)).names:
            log.write(T.StructType([*known, *new]))
            raise SchemaChanged(f"new fields: {', '.join(new.names)}")
        rows = parsed(batch, known)
        rows = rows.drop(RESCUED) if mode == "none" else rows
        for step in chain:
            rows = step(rows)
        own.load(table, strategy, rows, keys, f"{checkpoint}#{batch_id}", **load)

    return lines.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(**trigger(when)).start()


def run_evolving(restarts: int = 5, **how) -> int:
    """Drain a folder, starting again after each change of the schema; the number of restarts. More changes than ``restarts`` raise."""
    for done in range(restarts + 1):
        try:
            start_evolving(**how).awaitTermination()
            return done
        except Exception as e:
            if "SchemaChanged" not in str(e) and not isinstance(e, SchemaChanged) or done == restarts:
                raise
    raise AssertionError

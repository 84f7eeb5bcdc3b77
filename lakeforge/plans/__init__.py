"""Transform specs: named sources, ordered queries, and a load of the last one."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import layout
from ..store import ConcurrentCommit, TableStore


def with_identity(df: DataFrame, name: str, order: list[str], start: int = 0, buckets: int = 64) -> DataFrame:
    """Consecutive ids above ``start`` in the order of the columns (nulls first), which must be total for fixed ids.

    Rows are cut into ranges of the first column at quantiles, counted by range, and numbered
    within their range; a range starts where the rows before it end. Only cuts and counts reach the
    driver, and equal values of the first column alone are sorted in one task.
    """
    number = layout.as_number(F.col(f"`{order[0]}`"), df.schema[order[0]].dataType)
    cuts = df.agg(F.percentile_approx(number, [k / buckets for k in range(1, buckets)], 10_000)).first()[0]
    ranged = df.withColumn("__range", layout.rank(number, sorted(set(cuts or []))))
    counts, before, at = {r[0]: r[1] for r in ranged.groupBy("__range").count().collect()}, [], start
    for k in range(buckets):
        before.append(at)
        at += counts.get(k, 0)
    within = F.row_number().over(Window.partitionBy("__range").orderBy(*order)).cast("long")
    return ranged.withColumn(name, within + F.get(F.array(*[F.lit(b).cast("long") for b in before]), F.col("__range"))).drop("__range")


def with_unknown(df: DataFrame, values: dict) -> DataFrame:
    """One more row, the unknown member; unnamed columns are null."""
    row = df.sparkSession.range(1).select(*[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema])
    return df.unionByName(row)


def run_queries(spark: SparkSession, sources: dict[str, Callable[[SparkSession], DataFrame]], steps: list[tuple[str, str]], drop: list[str] = ()) -> DataFrame:
    """The last step's frame. Each step sees the sources and all steps before; a session of its own keeps names apart."""
    if not steps:
        raise ValueError("a transform needs at least one query")
    own = spark.newSession()
    for name, source in sources.items():
        source(own).createOrReplaceTempView(name)
    for name, text in steps:
        out = own.sql(text)
        out.createOrReplaceTempView(name)
    return out.drop(*drop)


def run_spec(spark: SparkSession, spec: dict, store: TableStore) -> int:
    """Run a spec (a parsed YAML document) over the store's tables and commit its target."""
    target, how, keys = spec["target"], spec.get("load", "overwrite"), spec.get("keys", [])
    sources = {s.get("name", s["table"]): (lambda own, t=s["table"]: TableStore(own, store.root).read(t)) for s in spec.get("sources", [])}
    out = run_queries(spark, sources, [(q["name"], q["sql"]) for q in spec["queries"]], spec.get("drop", []))
    return TableStore(out.sparkSession, store.root).load(target, how, out, keys, spec.get("batch_id"), spec.get("partition_by"), **spec.get("options", {}))


#: Parts of messages of errors that go by themselves: a busy service, a lost connection, another writer.
TRANSIENT = ("429", "too many requests", "timed out", "timeout", "connection reset", "connection refused", "temporarily unavailable", "503")


def is_transient(error: BaseException) -> bool:
    """Whether doing it again may help."""
    return isinstance(error, ConcurrentCommit | TimeoutError | ConnectionError) or any(t in str(error).lower() for t in TRANSIENT)


def retried(action: Callable[[], object], retries: int = 3, wait: float = 60.0, most: float = 600.0) -> object:
    """The result of an action that is done again after transient errors, with growing waits; others are raised at once."""
    for done in range(retries + 1):
        try:
            return action()
        except Exception as e:
            if done == retries or not is_transient(e):
                raise
            time.sleep(min(most, wait * 2**done) * (0.5 + random.random() / 2))
    raise AssertionError


def run_groups(groups: list[list[Callable[[], object]]], workers: int = 4, retries: int = 0, wait: float = 0.0) -> list[list[object]]:
    """Groups one after another, the builds of a group side by side; transient errors are retried. An empty group is an error."""
    if any(not group for group in groups):
        raise ValueError("a load group needs at least one build")
    with ThreadPoolExecutor(workers) as pool:
        return [list(pool.map(lambda build: retried(build, retries, wait), group)) for group in groups]


def workers_for(spark: SparkSession, least: int = 1, most: int = 16, cores_each: int = 4) -> int:
    """Builds side by side that the cluster's cores can serve."""
    return max(least, min(most, spark.sparkContext.defaultParallelism // cores_each))

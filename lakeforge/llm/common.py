"""Shared plumbing of the corpus operators: shared folder, checkpoints, Arrow batches."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of text in an Arrow batch at most, in executors and in Python, and its bytes, where rows are long (one row may have more).
TEXT_BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bits of a Bloom filter: fixed, so its broadcast is bounded (BLOOM / 64 rows) whatever the data.
BLOOM = 1 << 25


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where it is unset, a local folder serves a local master; a cluster raises."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (found or f"file://{tempfile.gettempdir()}/checkpoints/lakeforge").rstrip("/")


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts lineage in a way that survives the loss of executors: the files
    are in the shared store, not in an executor's block manager.
    """
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    schema = df.schema
    df.write.parquet(path)
    back = spark.read.schema(schema).parquet(path)
    back.written_to = path  # for discard()
    return back


def discard(*frames: DataFrame) -> None:
    """Delete what ``materialize`` wrote for these frames; nothing that is still to be read may depend on them."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def bloom(hashes: DataFrame) -> DataFrame:
    """``word, mask``: a Bloom filter over the one column, 64-bit hashes. As it fills, more pass it; none that is in it fails."""
    name = f"`{hashes.columns[0]}`"
    bit = hashes.selectExpr(f"shiftright({name} & {BLOOM - 1}, 6) AS word", f"shiftleft(1L, cast({name} & 63 AS int)) AS mask")
    return bit.groupBy("word").agg(F.expr("bit_or(mask)").alias("mask"))


def unused(names: list[str], wanted: str) -> str:
    """A name that is none of these, in any case."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def with_hit(df: DataFrame, name: str, filter_: DataFrame, flag: str) -> DataFrame:
    """``df`` with a column ``flag``: false if the hash ``name`` is certainly not in the Bloom filter. The filter is broadcast; its size is bounded."""
    word, mask = (unused(df.columns, n) for n in ("__word", "__mask"))
    small = F.broadcast(filter_.select(F.col("word").alias(word), F.col("mask").alias(mask)))
    found = df.join(small, F.expr(f"shiftright(`{name}` & {BLOOM - 1}, 6) = `{word}`"), "left")
    return found.withColumn(flag, F.expr(f"coalesce(`{mask}` & shiftleft(1L, cast(`{name}` & 63 AS int)) <> 0, false)")).drop(word, mask)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable on executors that don't have it installed (once per context)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="lakeforge-"), f"{root.name}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def give_back() -> None:
    """Return this process's free memory to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None
    if trim is not None:
        trim(0)


def lean(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``fn``, after which the worker gives free memory back: Spark keeps workers between tasks, beside the next stage's heap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        give_back()

    return run


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with the package shipped and workers kept small; lowers the session's limits of rows and bytes in a batch if they are larger."""
    ship(df.sparkSession)
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(ARROW_ROWS)) <= TEXT_BATCH_ROWS:
        conf.set(ARROW_ROWS, TEXT_BATCH_ROWS)
    as_bytes = df.sparkSession.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if not 0 < as_bytes(conf.get(ARROW_BYTES)) <= BATCH_BYTES:
        conf.set(ARROW_BYTES, BATCH_BYTES)
    return df.mapInArrow(lean(fn), schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = TEXT_BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that what Python holds at once stays bounded."""
    for b in batches:
        for at in range(0, max(b.num_rows, 0), rows):
            yield b.slice(at, rows)


def text_bytes(col: F.Column) -> F.Column:
    return F.coalesce(col, F.lit("")).cast("binary")


def held_out(doc_id: F.Column, modulus: int, remainder: int) -> F.Column:
    """crc32(doc_id as text) mod ``modulus`` is ``remainder``; a null id counts as not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

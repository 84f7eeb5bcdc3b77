"""WARC archives with an index of their records, read by coalesced byte ranges.

A first pass reads ids, digests and lengths alone and finds which payloads occur again.
The second reads the texts; tasks write plain WARC/1.1 archives of bounded size where they
read, so payloads aren't shuffled: only texts that a Bloom filter takes for repeated
payloads are joined with the decision. A row of the index (archive, offset, length, URL,
digest) is a task's output for each record, committed by Spark, so it names archives of
tasks that ended well alone; a lost task's archive is written anew under another name.
A read starts from the index: it takes the selected rows by archive and offset, joins
neighbouring ranges, and reads each joined range once. Archives are written and read
through a file system client of the worker (local, HDFS, S3, GCS or Azure).

Of equal payloads of at least MIN_REVISIT bytes the one with the largest id is the
response and the others revisit it. Defined results: null html is an empty payload, a null
URL an empty one; line breaks in URLs are percent-encoded; rows repeating the largest id
are all responses; equal rows have a record each; a null id is written as an empty one and
read as null, and is smaller than any other (where all ids of a payload are null, all are
responses); payloads of any length are whole; other columns aren't read; an empty table
gives an empty index and no archive.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bloom, discard, fresh_path, map_batches, materialize, table, with_hit

MIN_REVISIT = 1000
#: Archives hold about this many bytes; ranges are joined over gaps of GAP and up to RANGE bytes; a task reads about SHARE bytes.
ARCHIVE_BYTES, GAP, RANGE, SHARE = 32 << 20, 64 << 10, 8 << 20, 16 << 20
END = b"\r\n\r\n"
INDEX = "archive string, offset long, length long, page_id long, url string, digest string, record_type string, refers_to long"


def records(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``page_id, url, digest, record_type, refers_to, record`` (a record's text but for the closing line breaks), and what was written meanwhile."""
    url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    rows = pages.select(F.col("page_id").cast("long"), url.alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "n": F.octet_length("html").cast("long")})
    again = rows.where(F.col("n") >= MIN_REVISIT).groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("c")).where("c > 1 AND last IS NOT NULL").select("digest", "last")
    again = materialize(again, "repeated")
    texts = with_hit(rows.withColumn("h", F.xxhash64("digest")), "h", bloom(again.select(F.xxhash64("digest").alias("h"))), "hit").drop("h")
    looked = texts.where("hit").join(again, "digest", "left").select("page_id", "url", "html", "digest", "n", "last")
    rows = looked.unionByName(texts.where("not hit").select("page_id", "url", "html", "digest", "n", F.lit(None).cast("long").alias("last")))
    revisit = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    kind, body = F.when(revisit, "revisit").otherwise("response"), F.when(revisit, "").otherwise(F.col("html"))
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: <urn:page:"), name, F.lit(">\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\nX-Payload-Length: "), F.col("n").cast("string"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"), F.col("last").cast("string"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body,
    )
    return rows.select("page_id", "url", "digest", kind.alias("record_type"), F.when(revisit, F.col("last")).alias("refers_to"), record.cast("binary").alias("record")), again


def write(pages: DataFrame, path: str) -> DataFrame:
    """Write archives and index under ``path``; returns the index."""
    spark = pages.sparkSession
    rows, again = records(pages)
    folder = f"{path.rstrip('/')}/archives"

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client, inner = fs.FileSystem.from_uri(folder)
        client.create_dir(inner, recursive=True)
        out, name, at = None, "", 0
        try:
            for b in batches:
                archives, offsets, lengths = [], [], []
                for record in b.column("record"):
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc", 0
                        out = client.open_output_stream(f"{inner}/{name}", compression=None)
                    out.write(record.as_buffer())
                    out.write(END)
                    archives.append(name)
                    offsets.append(at)
                    lengths.append(len(record.as_buffer()) + len(END))
                    at += lengths[-1]
                yield pa.RecordBatch.from_arrays([pa.array(archives, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), *b.columns[:-1]], names=["archive", "offset", "length", *b.schema.names[:-1]])
        finally:
            if out is not None:
                out.close()

    map_batches(rows, store, INDEX).write.parquet(f"{path}/index")
    discard(again)
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def _number(name: str) -> int | None:
    digits = name.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def joined(spans: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Ranges (start, end, spans in them) that cover the spans (offset, length; sorted), neighbours together."""
    at = 0
    while at < len(spans):
        start, end, stop = spans[at][0], sum(spans[at]), at + 1
        while stop < len(spans) and spans[stop][0] - end <= GAP and sum(spans[stop]) - start <= RANGE:
            end, stop = max(end, sum(spans[stop])), stop + 1
        yield start, end, spans[at:stop]
        at = stop


def _rows(raw: list[bytes]) -> pa.RecordBatch:
    out = []
    for r in raw:
        fields, payload = parse(r)
        response = fields["WARC-Type"] == "response"
        out.append((
            _number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], len(payload) if response else int(fields["X-Payload-Length"]),
            hashlib.sha1(payload).hexdigest() if response else fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"],
            None if response else _number(fields["WARC-Refers-To"]), payload if response else None,
        ))
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)


def read(spark: SparkSession, path: str, selected: DataFrame) -> DataFrame:
    """The records of the selected index rows: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload`` (null for revisits)."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    folder = f"{path.rstrip('/')}/archives"
    tasks = max(1, -(-(selected.agg(F.sum("length")).first()[0] or 0) // SHARE))

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client, inner = fs.FileSystem.from_uri(folder)
        for b in batches:
            archives, offsets, lengths = (b.column(i).to_pylist() for i in range(3))
            at = 0
            while at < len(archives):
                stop = at
                while stop < len(archives) and archives[stop] == archives[at]:
                    stop += 1
                with client.open_input_file(f"{inner}/{archives[at]}") as f:
                    for start, end, spans in joined(list(zip(offsets[at:stop], lengths[at:stop], strict=True))):
                        block = f.read_at(end - start, start)
                        yield _rows([block[o - start : o - start + n] for o, n in spans])
                at = stop

    # A task takes whole stretches of archives, so that neighbours are read together.
    rows = selected.select("archive", "offset", "length", F.expr(f"offset div {RANGE}").alias("stretch"))
    return map_batches(rows.repartition(int(tasks), "archive", "stretch").sortWithinPartitions("archive", "offset").drop("stretch"), ranged, schema)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back."""
    path = fresh_path(spark, "warc")
    index = write(table(spark, sf_dir, "pages"), path)
    return read(spark, path, index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network.

Every token has a fixed sparse index vector drawn from its hash; a word's vector is the sum
of the index vectors of its neighbours over the whole corpus, scaled to length one. A
document is the mean and the spread of its tokens' word vectors. The network is trained in
numpy; a temperature found on a part kept back calibrates it.

Every word has a vector of its own; words are known by 64-bit hashes. A task cuts its texts
into chunks and sends each chunk's words with their sums to the blocks of the vocabulary; a
block adds them up and sends every chunk the vectors of its own words; the chunk's documents,
kept as bags of words, are pooled from these. No place holds the vocabulary as a whole.

Word vectors take all texts; the network is fitted on at most TRAIN_ROWS labelled rows (by
a hash of the id). Defined results: null and empty texts pool to zeros and get a score;
repeated rows get equal scores; without labels of both classes every score is the share of
label 1 (0 with none); an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, map_batches, materialize, slices, table

#: Most labelled rows the network is fitted on.
TRAIN_ROWS = 20_000
DIM, NONZERO, REACH = 32, 4, 2
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 80, 64, 0.01, 1e-4
#: A chunk ends at so many distinct words or tokens, so that a task's memory stays bounded and sums fit in 32 bits.
CHUNK_WORDS, CHUNK_TOKENS = 800_000, 20_000_000
#: Blocks of the vocabulary, by the hash's upper bits; splits of the input that share a task, as chunks of more text repeat fewer words.
BLOCK_BITS, SPLITS = 11, 3
BAG_ROWS = 500
THRESHOLD = 0.3

_tokens = re.compile(r"\w+|[^\w\s]+").findall
_zstd = pa.Codec("zstd", 1)


def word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def index_vectors(hashes: np.ndarray) -> np.ndarray:
    """NONZERO entries of plus or minus one for each hash, from its lower bits."""
    out, at = np.zeros((len(hashes), DIM), np.int8), np.arange(len(hashes))
    for k in range(NONZERO):
        bits = (hashes >> np.uint64(6 * k)).astype(np.int64)
        out[at, bits & 31] += ((bits >> 5 & 1) * 2 - 1).astype(np.int8)
    return out


def _pack(*parts) -> bytes:
    raw = pickle.dumps(parts, protocol=5)
    return len(raw).to_bytes(8, "little") + _zstd.compress(raw, asbytes=True)


def _unpack(blob: bytes) -> tuple:
    return pickle.loads(_zstd.decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True))


def _planes(x: np.ndarray) -> np.ndarray:
    """The bytes of whole numbers, all lowest ones first, which compress better."""
    return np.ascontiguousarray(x.astype(np.uint32).view(np.uint8).reshape(-1, 4).T)


def _whole(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.int64)


def _narrow(v: np.ndarray) -> tuple:
    """Rows of sums in as few bytes as they need."""
    small = (np.abs(v) < 128).all(axis=1)
    return small, v[small].astype(np.int8), v[~small].astype(np.int64)


def _wide(small: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    v = np.empty((len(small), DIM), np.int64)
    v[small], v[~small] = low, high
    return v


class Chunk:
    """Texts as bags of words, and the words' sums of the index vectors around them."""

    def __init__(self):
        self.memo: dict[str, int] = {}
        self.hashes = np.zeros(0, np.uint64)
        self.index, self.total = np.zeros((0, DIM), np.int8), np.zeros((0, DIM), np.int32)
        self.bags: list[tuple[pa.RecordBatch, list[int], list[np.ndarray], list[np.ndarray]]] = []
        self.tokens = 0

    def _ids(self, text: str) -> np.ndarray:
        tokens, memo = _tokens(text), self.memo
        if new := sorted(set(tokens).difference(memo)):
            at, end = len(memo), len(memo) + len(new)
            memo.update(zip(new, range(at, end), strict=True))
            if end > len(self.hashes):
                more = max(end, 2 * len(self.hashes), 1 << 14) - len(self.hashes)
                self.hashes = np.concatenate([self.hashes, np.zeros(more, np.uint64)])
                self.index, self.total = (np.concatenate([x, np.zeros((more, DIM), x.dtype)]) for x in (self.index, self.total))
            self.hashes[at:end] = np.fromiter(map(word_hash, new), np.uint64, len(new))
            self.index[at:end] = index_vectors(self.hashes[at:end])
        return np.fromiter(map(memo.__getitem__, tokens), np.int64, len(tokens))

    def add(self, texts: list[str | None], keep: pa.RecordBatch) -> None:
        lengths, words, counts = [], [], []
        for text in texts:
            ids, n = self._ids(text or ""), 0
            for at in range(0, len(ids), 100_000):  # bounded steps; the reach crosses their ends
                lo, hi = max(0, at - REACH), min(len(ids), at + 100_000 + REACH)
                vec = self.index[ids[lo:hi]]
                around = np.zeros_like(vec)
                for k in range(1, REACH + 1):
                    around[k:] += vec[:-k]
                    around[:-k] += vec[k:]
                own = ids[at : at + 100_000]
                near = around[at - lo : at - lo + len(own)]
                order = np.argsort(own, kind="stable")
                own = own[order]
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                who = own[first]
                self.total[who] += np.add.reduceat(near[order], first, axis=0, dtype=np.int32)
                words.append(who)
                counts.append(np.diff(np.append(first, len(own))))
                n += len(who)
            lengths.append(n)
            self.tokens += len(ids)
        self.bags.append((keep, lengths, words, counts))

    def full(self) -> bool:
        return len(self.memo) > CHUNK_WORDS or self.tokens > CHUNK_TOKENS

    def rows(self) -> Iterator[tuple[int, bytes]]:
        """Sums by block (``p`` from 0), the words in the order of the blocks (-1), and bags (beyond the blocks)."""
        n = len(self.memo)
        order = np.argsort(self.hashes[:n])
        hashes = self.hashes[order]
        block = (hashes >> np.uint64(64 - BLOCK_BITS)).astype(np.int64)
        ends = np.searchsorted(block, np.arange((1 << BLOCK_BITS) + 1))
        for p in np.unique(block).tolist():
            part = slice(ends[p], ends[p + 1])
            yield p, _pack(hashes[part], *_narrow(self.total[order[part]]))
        yield -1, _pack(_planes(order))
        for k, (keep, lengths, words, counts) in enumerate(self.bags):
            ids = np.concatenate([np.zeros(0, np.int64), *(np.diff(w, prepend=0) for w in words)])
            # A bag of several steps starts anew at each step.
            steps = np.array([len(w) for w in words], np.int64)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, keep.schema) as out:
                out.write_batch(keep)
            yield (1 << BLOCK_BITS) + k, _pack(sink.getvalue().to_pybytes(), np.array(lengths, np.int64), steps, _planes(ids), _planes(np.concatenate([np.zeros(0, np.int64), *counts])))


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for b in batches:
        for i in range(b.num_rows):
            yield tuple(b.column(c)[i].as_py() for c in names)


def _batch(rows: list[tuple[str, int, bytes]]) -> pa.RecordBatch:
    c, p, blob = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()), pa.array(p, pa.int32()), pa.array(blob, pa.binary())], names=["c", "p", "blob"])


def _batches(rows: Iterator[tuple[str, int, bytes]], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[2])
        if size > most:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to the rows of their chunks."""

    def rows():
        chunk, k, part = Chunk(), 0, TaskContext.get().partitionId()
        for b in slices(batches, BAG_ROWS):
            chunk.add(b.column(0).to_pylist(), pa.RecordBatch.from_arrays(b.columns[1:], names=b.schema.names[1:]))
            if chunk.full():
                yield from ((f"{part}:{k}", *r) for r in chunk.rows())
                chunk, k = Chunk(), k + 1
        if chunk.bags:
            yield from ((f"{part}:{k}", *r) for r in chunk.rows())

    yield from _batches(rows())


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of ``p``: blocks become the whole sums of each chunk's words; others pass."""

    def rows():
        for p, found in groupby(_rows(batches, "c", "p", "blob"), key=lambda r: r[1]):
            if not 0 <= p < 1 << BLOCK_BITS:
                yield from found
                continue
            found = list(found)
            words, sums = np.zeros(0, np.uint64), np.zeros((0, DIM), np.int64)
            for at in range(0, len(found), 64):
                parts = [_unpack(r[2]) for r in found[at : at + 64]]
                known, place = np.unique(np.concatenate([words, *(x[0] for x in parts)]), return_inverse=True)
                more = np.zeros((len(known), DIM), np.int64)
                more[place[: len(words)]] = sums
                start = len(words)
                for x in parts:
                    more[place[start : start + len(x[0])]] += _wide(*x[1:])  # a chunk has a word once
                    start += len(x[0])
                words, sums = known, more
            for c, _, blob in found:
                yield c, p, _pack(*_narrow(sums[np.searchsorted(words, _unpack(blob)[0])]))

    yield from _batches(rows())


def _unit(v: np.ndarray) -> np.ndarray:
    return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of ``c`` and ``p``: a chunk's word vectors, then its bags, pooled."""
    for _, found in groupby(_rows(batches, "c", "p", "blob"), key=lambda r: r[0]):
        vectors, order, parts = None, None, []
        for _, p, blob in found:
            if p == -1:
                order = _whole(*_unpack(blob))
            elif p < 1 << BLOCK_BITS:
                parts.append(_unit(_wide(*_unpack(blob))))
            else:
                if vectors is None:
                    vectors = np.empty((len(order), DIM), np.float32)
                    vectors[order] = np.concatenate([np.zeros((0, DIM), np.float32), *parts])
                    parts = []
                kept, lengths, steps, ids, counts = _unpack(blob)
                keep = pa.ipc.open_stream(kept).read_next_batch()
                words, counts = np.cumsum(_whole(ids)), _whole(counts).astype(np.float64)
                starts = np.append(0, np.cumsum(steps))[:-1]
                if len(steps):
                    words -= np.repeat(np.append(0, words)[starts], steps)
                out = np.zeros((len(lengths), 2 * DIM), np.float64)
                full = lengths > 0
                if full.any():
                    first = np.append(0, np.cumsum(lengths))[:-1][full]
                    v = vectors[words]
                    n = np.add.reduceat(counts, first)[:, None]
                    mean = np.add.reduceat(v * counts[:, None], first, axis=0) / n
                    spread = np.add.reduceat(v.astype(np.float64) ** 2 * counts[:, None], first, axis=0) / n - mean**2
                    out[full] = np.hstack([mean, np.sqrt(np.maximum(spread, 0))])
                pooled = pa.FixedSizeListArray.from_arrays(pa.array(out.astype(np.float32).ravel()), 2 * DIM).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([*keep.columns, pooled], names=[*keep.schema.names, "pooled"])


def pool(df: DataFrame, text: Column, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``pooled``: mean and spread of the word vectors, which all texts of ``df`` make."""
    source = df.select(text.alias("__text"), *[F.col(f"`{c}`") for c in keep])
    source = source.coalesce(max(1, -(-source.rdd.getNumPartitions() // SPLITS)))
    rows = "c string, p int, blob binary"
    blocks = map_batches(source, _sums, rows).repartition("p").sortWithinPartitions("p")
    chunks = map_batches(blocks, _merge, rows).repartition("c").sortWithinPartitions("c", "p")
    return map_batches(chunks, _finish, T.StructType([*source.schema.fields[1:], T.StructField("pooled", T.ArrayType(T.FloatType()))]))


class Network:
    """Two layers trained by Adam, then a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 5):
        self.share = float(y.mean()) if len(y) else 0.0
        self.plain = not len(y) or self.share in (0.0, 1.0)
        if self.plain:
            return
        rng = np.random.default_rng(seed)
        self.mean, self.dev = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.mean) / self.dev
        order = rng.permutation(len(y))
        kept = max(1, len(y) // 5)
        back, used = order[:kept], order[kept:]
        params = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.array(np.log(self.share / (1 - self.share)))]
        m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(EPOCHS):
            for rows in np.array_split(rng.permutation(used), max(1, len(used) // BATCH)):
                h = np.tanh(x[rows] @ params[0] + params[1])
                d = (1 / (1 + np.exp(-(h @ params[2] + params[3]))) - y[rows]) / max(1, len(rows))
                dh = d[:, None] * params[2] * (1 - h**2)
                grads = [x[rows].T @ dh + DECAY * params[0], dh.sum(axis=0), h.T @ d + DECAY * params[2], d.sum()]
                step += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g**2
                    params[k] = params[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        self.params = params
        z = self._logits(x[back])
        choices = np.geomspace(0.25, 8, 60)
        loss = [np.mean(np.logaddexp(0, z / t) - y[back] * z / t) for t in choices]
        self.temperature = float(choices[int(np.argmin(loss))])

    def _logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.params[0] + self.params[1]) @ self.params[2] + self.params[3]

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.plain:
            return np.full(len(x), self.share)
        return 1 / (1 + np.exp(-np.clip(self._logits((x - self.mean) / self.dev) / self.temperature, -500, 500)))


def train(pooled: DataFrame) -> Network:
    """A network from rows ``k`` (order of choice), ``y`` and ``pooled``; TRAIN_ROWS of them at most."""
    rows = pooled.orderBy("k", "y").limit(TRAIN_ROWS).toPandas().sort_values(["k", "y"])
    x = np.array(rows["pooled"].tolist(), np.float64).reshape(len(rows), 2 * DIM)
    return Network(x, rows["y"].to_numpy(np.float64))


def predict(pooled: DataFrame, network: Network, keep: list[str]) -> DataFrame:
    shared = pooled.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column("pooled").to_pylist(), np.float64).reshape(b.num_rows, 2 * DIM)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(shared.value.predict(x), pa.float64())], names=[*keep, "score"])

    fields = [f for f in pooled.schema.fields if f.name in keep]
    return map_batches(pooled.select(*keep, "pooled"), run, T.StructType([*fields, T.StructField("score", T.DoubleType())]))


def op10_quality(spark, sf_dir: str) -> DataFrame:
    """Score and decision for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out(F.col("doc_id"), 5, 0).alias("held_out"))
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"), 5, 0)).where("quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").cast("int").alias("y"))
    pooled = materialize(pool(docs, F.col("text"), ["doc_id", "held_out"]), "pooled")
    # Only ids are joined at first: the vectors of the chosen rows alone are moved.
    chosen = pooled.select("doc_id").join(labels, "doc_id").withColumn("k", F.xxhash64(F.col("doc_id").cast("string"))).orderBy("k", "y").limit(TRAIN_ROWS).distinct()
    network = train(pooled.join(F.broadcast(chosen), "doc_id").select("k", "y", "pooled"))
    return predict(pooled, network, ["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

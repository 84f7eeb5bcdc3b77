"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams and itself, hashed into buckets with an
embedding each; a text is the mean over all its words' n-grams. Embeddings and softmax
are trained jointly. Misspellings never seen share most n-gram vectors with the word.
As the softmax is linear, a word's share of the logit is found once and remembered.

The model is fitted on at most TRAIN_ROWS labelled rows (chosen by a hash of the id);
scoring reads every whole text. Defined results: null, empty and wordless texts score
the prior's bias; repeated rows get equal scores, also very long ones, which are scored
whole; null ids are scored but never learned from; without labels of both classes every
score is the share of label 1 (0 with none); an empty table gives an empty table. Other
columns are kept; one named like the score is an error unless another name is given.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, give_back, held_out, map_batches, materialize, slices, table

#: Most labelled rows the model is fitted on, half of them at most of label 1.
TRAIN_ROWS = 6000
BUCKETS, DIM, EPOCHS, BATCH, RATE = 1 << 15, 16, 15, 64, 0.3
#: Logits are of mean vectors; scaling them lets a few words count in a long text. SCALE and RATE have the least
#: log loss by cross-validation inside the rows that aren't held out (tests/llm/choose_toxicity.py).
SCALE = 30.0
MEMO_WORDS = 100_000
THRESHOLD = 0.3

_words = re.compile(r"\w+").findall


def subwords(word: str) -> list[int]:
    """Buckets of a word's n-grams of 3 to 5 characters and of the word itself."""
    if len(word) > 64:  # each part of a very long run is a word
        return [b for at in range(0, len(word), 64) for b in subwords(word[at : at + 64])]
    w = f"<{word}>"
    grams = [w] + [w[i : i + n] for n in (3, 4, 5) for i in range(len(w) - n + 1) if n < len(w)]
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) & (BUCKETS - 1) for g in grams]


class Bags:
    """Texts as bags of buckets, in flat arrays: the buckets and counts of text i are from ``ends[i]`` to ``ends[i + 1]``."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        self.ends = np.cumsum([0, *(len(ids) for ids, _ in rows)])
        self.ids = np.concatenate([np.zeros(0, np.uint16), *(ids for ids, _ in rows)])
        self.shares = np.concatenate([np.zeros(0, np.float32), *(SCALE * n / max(n.sum(), 1) for _, n in rows)]).astype(np.float32)

    @classmethod
    def unpacked(cls, blobs: pa.ChunkedArray) -> Bags:
        """Bags of what tasks packed, put in place one by one, so that there is one copy of them."""
        out = cls([])
        out.ends = np.cumsum([0, *(len(zlib.decompress(x.as_buffer())) // 6 for x in blobs)])
        out.ids, out.shares = np.empty(out.ends[-1], np.uint16), np.empty(out.ends[-1], np.float32)
        for x, lo, hi in zip(blobs, out.ends[:-1], out.ends[1:], strict=True):
            raw = zlib.decompress(x.as_buffer())
            n = np.frombuffer(raw, np.float32, hi - lo, 2 * (hi - lo))
            out.ids[lo:hi], out.shares[lo:hi] = np.frombuffer(raw, np.uint16, hi - lo), SCALE * n / max(n.sum(), 1)
        return out


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text, in order, and how often each occurs."""
    c: Counter[int] = Counter()
    for w, n in Counter(_words(text.lower())).items():
        for g in subwords(w):
            c[g] += n
    ids = np.sort(np.fromiter(c.keys(), np.uint16, len(c)))
    return ids, np.array([c[i] for i in ids.tolist()], np.float32)


def fit(bags: Bags, y: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """Per-bucket logits and the bias, from embeddings and softmax trained together by Adagrad."""
    share = float(y.mean()) if len(y) else 0.0
    if not len(y) or share in (0.0, 1.0):
        return np.zeros(BUCKETS, np.float32), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    soft = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32)
    bias = np.log(np.array([1 - share, share], np.float32))
    ge, gs, gb = np.full((BUCKETS, 1), 1e-6, np.float32), np.full_like(soft, 1e-6), np.full_like(bias, 1e-6)
    place, lengths = np.zeros(BUCKETS, np.int64), np.diff(bags.ends)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            rows = order[at : at + BATCH]
            spans = [slice(bags.ends[i], bags.ends[i + 1]) for i in rows]
            ids = np.concatenate([bags.ids[s] for s in spans])
            seen = np.zeros(BUCKETS, bool)
            seen[ids] = True
            used = np.flatnonzero(seen)
            place[used] = np.arange(len(used))
            x = np.zeros((len(rows), len(used)), np.float32)  # a batch's rows and buckets: bounded
            x[np.repeat(np.arange(len(rows)), lengths[rows]), place[ids]] = np.concatenate([bags.shares[s] for s in spans])
            own = emb[used]
            h = x @ own
            z = h @ soft + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p /= len(rows)
            d_soft, d_bias, d_own = h.T @ p, p.sum(axis=0), x.T @ (p @ soft.T)
            gs += d_soft**2
            gb += d_bias**2
            ge[used] += (d_own**2).mean(axis=1, keepdims=True)
            soft -= rate * d_soft / np.sqrt(gs)
            bias -= 0.1 * rate * d_bias / np.sqrt(gb)
            emb[used] = own - rate * d_own / np.sqrt(ge[used])
    w = soft[:, 1] - soft[:, 0]
    return (SCALE * emb @ w).astype(np.float32), float(bias[1] - bias[0])


def learn(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """The model of ``doc_id, text`` and ``doc_id, y``, from at most TRAIN_ROWS ids that both have.

    The ids are chosen from ids alone and broadcast (their number is bounded), so no text is shuffled;
    bags are made where the texts are read. Of an id's several texts the one of the smallest hash counts.
    """
    known = materialize(labels.where("y IN (0, 1)").join(docs.select("doc_id"), "doc_id", "left_semi").withColumn("k", F.xxhash64(F.col("doc_id").cast("string"))), "labels")
    chosen = known.where("y = 1").orderBy("k", "doc_id").limit(TRAIN_ROWS // 2).unionByName(known.where("y = 0").orderBy("k", "doc_id").limit(TRAIN_ROWS // 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 100):
            packed = []
            for t in b.column(0):
                ids, counts = bag(t.as_py() or "")
                packed.append(zlib.compress(ids.tobytes() + counts.tobytes(), 1))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(packed, pa.binary())], names=["doc_id", "y", "k", "h", "bag"])

    texts = docs.join(F.broadcast(chosen), "doc_id").select("text", F.col("doc_id"), "y", "k", F.xxhash64("text").alias("h"))
    schema = T.StructType([f for f in texts.schema.fields if f.name != "text"] + [T.StructField("bag", T.BinaryType())])
    one = map_batches(texts, run, schema).groupBy("doc_id", "k", "y").agg(F.min(F.struct("h", "bag")).alias("x"))
    rows = one.orderBy("k", "doc_id").select("y", "x.bag").toArrow()
    y, bags = rows["y"].to_numpy().astype(np.int64), Bags.unpacked(rows["bag"])
    del rows
    give_back()
    weights, bias = fit(bags, y)
    del bags
    give_back()
    total = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    discard(known)
    if len(total) == 2:  # the sample is balanced more than the labels are
        bias += float(np.log(total[1] / total[0]) - np.log(max(y.sum(), 1) / max((1 - y).sum(), 1)))
    return weights, bias


def score(df: DataFrame, text: Column, model: tuple[np.ndarray, float], keep: list[str], name: str = "score") -> DataFrame:
    """The columns ``keep`` and the probability of label 1."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        memo: dict[str, tuple[float, int]] = {}
        for b in slices(batches):
            out = []
            for t in b.column(0):
                total, n = 0.0, 0
                for w in _words((t.as_py() or "").lower()):
                    known = memo.get(w)
                    if known is None:
                        if len(memo) >= MEMO_WORDS:
                            memo.clear()
                        grams = subwords(w)
                        known = memo[w] = (float(weights[grams].sum()), len(grams))
                    total += known[0]
                    n += known[1]
                z = bias + (total / n if n else 0.0)
                out.append(float(1 / (1 + np.exp(-np.clip(z, -500, 500)))))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(out, pa.float64())], names=[*keep, name])

    source = df.select(text.alias("__text"), *[F.col(f"`{c}`") for c in keep])
    return map_batches(source, run, T.StructType([*source.schema.fields[1:], T.StructField(name, T.DoubleType())]))


def trained(spark, docs: DataFrame, sf_dir: str) -> tuple[np.ndarray, float]:
    """The model of the rows that aren't held out. ``labels`` has an id a row at most; of repeated ids, the largest label counts."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"), 4, 2)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    return learn(docs.select("doc_id", "text"), labels)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    """Score and decision for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs.withColumn("held_out", held_out(F.col("doc_id"), 4, 2)), F.col("text"), trained(spark, docs, sf_dir), ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

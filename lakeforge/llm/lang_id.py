"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A
word (its leading space included) is scored by the forward algorithm, which sums
the probabilities of all its segmentations; a text is the product of its words.
The piece probabilities come from one expectation step over all labelled texts:
posterior piece counts under a base distribution that only knows vocabulary ranks.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
ties go to the language first in order; repeated rows get equal results; with
nothing to learn from, everything is ``und``; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .byte_bpe import read_ranks
from .common import held_out, map_batches, slices, table

#: Words remembered with their scores by a worker; what is forgotten is computed again.
MEMO_WORDS = 400_000
#: Words by language (times languages) of the expectation step at once, and their characters.
TRAIN_CELLS, TRAIN_CHARS = 200_000, 2_000_000
#: Bytes of words whose pieces stand in arrays at once; a word of over LONG bytes goes by itself, in windows of so many.
CHUNK, LONG = 1 << 17, 2048
#: Log of a probability of no segmentation at all, of which sums stay below NEVER.
NOTHING, NEVER = -1e300, -1e200
SMOOTHING = 0.05

_words = re.compile(r"[^\W\d_]+").findall


class Pieces:
    """The vocabulary's pieces, whatever their length, found by walking their common prefixes."""

    def __init__(self, tokens: list[bytes]):
        kept = [t for t in tokens if t]
        self.n, self.longest = len(kept), max(map(len, kept), default=0)
        # Prefixes by length, then by bytes: the number of a prefix is its place (0: the empty one), and its key, made of the
        # number of the prefix before it and its last byte, rises with that place.
        prefixes = sorted({t[:k] for t in kept for k in range(1, len(t) + 1)}, key=lambda p: (len(p), p))
        number = {p: i for i, p in enumerate(prefixes, 1)} | {b"": 0}
        self.keys = np.array([number[p[:-1]] << 8 | p[-1] for p in prefixes], np.int64)
        self.piece = np.full(len(prefixes) + 1, self.n, np.int32)
        for i, t in enumerate(kept):
            self.piece[number[t]] = i
        base = 1.0 / (np.arange(self.n) + 50.0)
        self.base = base / base.sum()

    def found(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All places of pieces in the words: starts, ends and pieces, then where each word starts and ends. A word of n bytes has n + 1 places."""
        lens = np.array([len(w) for w in words], np.int64)
        last = np.cumsum(lens + 1) - 1
        symbols = np.full(int((lens + 1).sum()), 256, np.int64)
        inside = np.ones(len(symbols), bool)
        inside[last] = False
        symbols[inside] = np.frombuffer(b"".join(words), np.uint8)
        at, prefix, size, out = np.arange(len(symbols)), np.zeros(len(symbols), np.int64), 0, []
        while len(at) and len(self.keys):
            symbol = symbols[at + size]
            goes = symbol < 256
            at, key = at[goes], prefix[goes] << 8 | symbol[goes]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            goes = self.keys[place] == key
            at, prefix, size = at[goes], place[goes] + 1, size + 1
            ids = self.piece[prefix]
            held = ids < self.n
            out.append((at[held], at[held] + size, ids[held]))
        starts, ends, ids = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*out, strict=True)) if out else np.zeros((3, 0), np.int64)
        return starts, ends, ids.astype(np.int64), last - lens, last

    def _steps(self, words: list[bytes]) -> tuple:
        """``found`` in the order of the ends' distance from the start of their word, then of ends, and the bounds of each such distance."""
        starts, ends, ids, first, last = self.found(words)
        lens = last - first
        far = ends - np.repeat(first, lens + 1)[ends]
        order = np.lexsort((ends, far))
        return starts[order], ends[order], ids[order], first, last, np.searchsorted(far[order], np.arange(1, int(lens.max(initial=0)) + 2))

    @staticmethod
    def _sums(steps: tuple, logs: np.ndarray) -> np.ndarray:
        """By place and column, the log of the summed probability of all segmentations up to there."""
        starts, ends, ids, first, last, bounds = steps
        sums = np.full((int(last[-1]) + 1, logs.shape[1]), NOTHING)
        sums[first] = 0
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if a == b:
                continue
            here, values = ends[a:b], sums[starts[a:b]] + logs[ids[a:b]]
            runs = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]]))
            most = np.maximum.reduceat(values, runs)
            values = np.exp(values - np.repeat(most, np.diff(runs, append=len(here)), axis=0))
            sums[here[runs]] = most + np.log(np.add.reduceat(values, runs))
        return sums

    @staticmethod
    def _chunks(words: list[bytes]) -> Iterator[list[int]]:
        """Numbers of words of at most LONG bytes, near each other in length and of about CHUNK bytes together; longer ones alone."""
        part, held = [], 0
        for i in sorted(range(len(words)), key=lambda i: len(words[i])):
            if part and held + len(words[i]) > CHUNK:
                yield part
                part, held = [], 0
            if len(words[i]) > LONG:
                yield [i]
                continue
            part.append(i)
            held += len(words[i])
        if part:
            yield part

    def forward(self, words: list[bytes], probs: np.ndarray) -> np.ndarray:
        """Log of the summed probability of all segmentations, by word and column of ``probs`` (n + 1 rows, the last zero)."""
        out = np.zeros((len(words), probs.shape[1]))
        logs = np.log(np.maximum(probs, 1e-300))
        for part in self._chunks(words):
            if len(words[part[0]]) > LONG:
                out[part[0]] = self._long(words[part[0]], probs)[0]
            else:
                steps = self._steps([words[i] for i in part])
                out[part] = self._sums(steps, logs)[steps[4]]
        return np.where(out < NEVER, np.log(1e-300), out)

    def _windows(self, word: bytes, last_first: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The places of pieces in one word by their starts, in windows."""
        at = range(0, len(word), CHUNK)
        for a in reversed(at) if last_first else at:
            starts, ends, ids, *_ = self.found([word[a : a + CHUNK + self.longest]])
            order = np.argsort(starts[starts < CHUNK], kind="stable")
            yield tuple(x[starts < CHUNK][order] + more for x, more in ((starts, a), (ends, a), (ids, 0)))

    def _long(self, word: bytes, probs: np.ndarray) -> np.ndarray:
        return np.array([[self._long_sums(word, probs[:, k])[-1] for k in range(probs.shape[1])]])

    def _long_sums(self, word: bytes, probs: np.ndarray) -> np.ndarray:
        """``_sums`` of one word and one column, number by number."""
        sums, ahead, scale, at = np.full(len(word) + 1, NOTHING), {0: 1.0}, 0.0, -1
        now = 0.0
        for starts, ends, ids in self._windows(word):
            for start, end, p in zip(starts.tolist(), ends.tolist(), probs[ids].tolist(), strict=True):
                if start != at:
                    at, now = start, ahead.pop(start, 0.0)
                    if 0 < now < 1e-100:
                        scale += math.log(now)
                        ahead, now = {k: v / now for k, v in ahead.items()}, 1.0
                    if now:
                        sums[at] = scale + math.log(now)
                if now:
                    ahead[end] = ahead.get(end, 0.0) + now * p
        if ahead.get(len(word)):
            sums[-1] = scale + math.log(ahead[len(word)])
        return sums

    def expected(self, words: list[bytes], weights: np.ndarray) -> np.ndarray:
        """Posterior piece counts of the words under the base distribution, summed with the weights [word, language].

        Going back from a word's end, a place passes its share on to the starts of the pieces that end there.
        """
        counts = np.zeros((self.n + 1, weights.shape[1]))
        logs = np.log(np.append(self.base, 1e-300))
        for part in self._chunks(words):
            if len(words[part[0]]) > LONG:
                word = words[part[0]]
                sums, share = self._long_sums(word, np.append(self.base, 0.0)), {len(word): 1.0}
                if sums[-1] < NEVER:
                    continue
                for starts, ends, ids in self._windows(word, last_first=True):
                    passed = np.exp(np.minimum(sums[starts] + logs[ids] - sums[ends], 0.0))
                    for x, (start, end, q) in enumerate(zip(starts[::-1].tolist(), ends[::-1].tolist(), passed[::-1].tolist(), strict=True), 1):
                        passed[-x] = q = q * share.get(end, 0.0)
                        share[start] = share.get(start, 0.0) + q
                    low = int(starts[0]) if len(starts) else 0
                    share = {k: v for k, v in share.items() if k <= low + self.longest}
                    for lang in np.flatnonzero(weights[part[0]]):
                        counts[:, lang] += np.bincount(ids, passed * weights[part[0], lang], self.n + 1)
                continue
            steps = self._steps([words[i] for i in part])
            starts, ends, ids, first, last, bounds = steps
            sums = self._sums(steps, logs[:, None])[:, 0]
            passed, share = np.exp(np.minimum(sums[starts] + logs[ids] - sums[ends], 0.0)), np.zeros(len(sums))
            share[last] = sums[last] > NEVER
            for a, b in zip(bounds[-2::-1].tolist(), bounds[:0:-1].tolist(), strict=True):
                passed[a:b] *= share[ends[a:b]]
                share[starts[a:b]] += passed[a:b]
            own = weights[part][np.repeat(np.arange(len(part)), last - first + 1)[ends]]
            for lang in range(weights.shape[1]):
                counts[:, lang] += np.bincount(ids, passed * own[:, lang], self.n + 1)
        return counts[:-1]


def _word_bytes(word: str) -> bytes:
    return (" " + word.lower()).encode("utf-8", "surrogatepass")


def learn(df: DataFrame, text: Column, lang: Column, vocabulary: str) -> tuple[list[str], np.ndarray, Pieces]:
    """Languages, log priors and piece probabilities from all rows whose language isn't null.

    What comes to the driver is one row a language and piece; the vocabulary bounds it.
    """
    spark = df.sparkSession
    pieces = Pieces(read_ranks(vocabulary))
    shared = spark.sparkContext.broadcast(pieces)
    source = df.select(text.alias("t"), lang.alias("l")).where("l is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Pieces = shared.value
        totals: dict[str, np.ndarray] = {}
        seen: dict[str, dict[str, int]] = {}
        held = [0, 0]

        def count() -> None:
            names = sorted(seen)
            rows = {w: i for i, w in enumerate(dict.fromkeys(w for c in seen.values() for w in c))}
            weights = np.zeros((len(rows), len(names)))
            for k, name in enumerate(names):
                weights[[rows[w] for w in seen[name]], k] = list(seen[name].values())
            found = own.expected(list(map(_word_bytes, rows)), weights)
            for k, name in enumerate(names):
                totals[name] = totals.get(name, 0) + found[:, k]
            seen.clear()
            held[:] = 0, 0

        for b in slices(batches, 500):
            for t, lg in zip(b.column(0), b.column(1), strict=True):
                c = seen.setdefault(lg.as_py(), {})
                for w in _words(t.as_py() or ""):
                    if w in c:
                        c[w] += 1
                    else:
                        c[w] = 1
                        held[0], held[1] = held[0] + 1, held[1] + len(w)
                if held[0] * len(seen) >= TRAIN_CELLS or held[1] >= TRAIN_CHARS:
                    count()
        if seen:
            count()
        for name, c in totals.items():
            at = np.flatnonzero(c > 0)
            at = at if len(at) else np.array([0])
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(c[at].astype(np.float32))], names=["l", "piece", "c"])

    counts = map_batches(source, run, "l string, piece int, c float").groupBy("l", "piece").agg(F.sum("c").alias("c")).toPandas()
    langs = sorted(counts["l"].unique())
    probs = np.zeros((pieces.n + 1, len(langs)))
    for k, name in enumerate(langs):
        own = counts[counts["l"] == name]
        c = np.zeros(pieces.n)
        c[own["piece"].to_numpy()] = own["c"].to_numpy()
        c += SMOOTHING * max(1.0, c.sum()) * pieces.base
        probs[:-1, k] = c / c.sum()
    return langs, probs, pieces


def identify(df: DataFrame, text: Column, model: tuple[list[str], np.ndarray, Pieces], keep: list[str]) -> DataFrame:
    """The columns ``keep``, ``lang_pred`` and ``score`` (the posterior of the predicted language)."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, probs, pieces = shared.value
        index: dict[str, int] = {}
        known = np.zeros((0, len(langs)))
        for b in slices(batches, 500):
            if len(index) > MEMO_WORDS:
                index, known = {}, np.zeros((0, len(langs)))
            ids, ends, new, letters = [], [], [], []
            for t in b.column(0):
                words = _words(t.as_py() or "")
                start = len(ids)
                for w in words:
                    i = index.get(w)
                    if i is None:
                        i = index[w] = len(index)
                        new.append(w)
                    ids.append(i)
                letters.append(any(w.isalpha() for w in words) or any(c.isalpha() for w in words for c in w))
                ends.append((start, len(ids)))
            if new and langs:
                known = np.concatenate([known, pieces.forward([_word_bytes(w) for w in new], probs)])
            names, scores, at = [], [], np.array(ids, np.int64)
            for (start, end), some in zip(ends, letters, strict=True):
                if not some or not langs:
                    names.append("und")
                    scores.append(0.0)
                    continue
                total = known[at[start:end]].sum(axis=0)
                best = int(total.argmax())
                names.append(langs[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*keep, "lang_pred", "score"])

    source = df.select(text.alias("__text"), *[F.col(f"`{c}`") for c in keep])
    return map_batches(source, run, T.StructType([*source.schema.fields[1:], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from the documents that aren't held out."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out(F.col("doc_id"), 4, 2).alias("held_out"))
    model = learn(docs.where("not held_out"), F.col("text"), F.col("lang"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return identify(docs, F.col("text"), model, ["doc_id", "held_out"])

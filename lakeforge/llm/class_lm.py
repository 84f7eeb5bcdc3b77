"""Language-model scores by Brown's class-based bigrams.

A word w after v has the probability P(class w | class v) * P(w | class w). Counts take
every training text; each distinct word is in one class, and the end of a text is a word of
a class that holds it alone (it also stands before the first word). With c(w) + 0.5 for a
word and Z of a class the sum of these over its words, P(w | class) = (c(w) + 0.5) / Z. An
unseen word has the same probability after any word, 0.5 / (all Z + 0.5); the rest is shared
out by transitions, smoothed to (n(v', w') + PRIOR * Z(w') / all Z) / (n(v') + PRIOR).
Without transitions this is the smoothed unigram model.

Classes come from exchange clustering. The CORE most frequent words are exchanged one by
one, each to the class that raises the likelihood of the class bigrams most, until a pass
moves none (PASSES at most); their bigram counts are a matrix of bounded size, so this is
the driver's work. All other words, however many, then take one exchange step each against
these classes, from the classes of their neighbours in all training texts.

Texts are read once: a task cuts its rows into chunks of CHUNK tokens, known by numbers of
the chunk's own words, and one row a chunk is written. Words leave a chunk as rows (hash,
count, neighbours), are summed by hash, and go back to their chunks with count and class, so
no place holds the vocabulary; a word has a row a chunk at most, so none is hot. What is
written then is a byte a token, from which transitions are counted and texts are scored.

Defined results: null and empty texts have the end as their only token; texts of any length
are taken whole (a chunk ends after a text); repeated rows are training texts as often as
they stand there and get equal scores; without training texts every word is unseen and all
scores are 0; ties go to the more frequent word (then the smaller hash) for the core and to
the smaller class in an exchange; a kept column with a result's name is an error, other
columns aren't read; an empty table gives an empty table. Words are known by 64-bit hashes.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, held_out, map_batches, materialize, slices, table

CLASSES, CORE, PASSES, PRIOR = 32, 2048, 12, 50.0
#: Classes beyond those of words: the end of a text, unseen words.
END, UNSEEN = CLASSES, CLASSES + 1
#: Neighbours of a word: classes to its right, then classes to its left.
SLOTS = 2 * (CLASSES + 1)
CHUNK = 2_000_000
#: The end of a text among the hashes of words.
END_HASH = np.int64(0)
RESULTS = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
#: Gains that are equal to so many digits are ties.
DIGITS = 6
#: Counts whose terms are looked up in place of computed.
TERMS = 64

_zstd = pa.Codec("zstd", 1)
_entry = np.dtype([("slot", "u1"), ("n", "<u4")])


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


# --- chunks


class Chunk:
    """Texts as numbers of the chunk's own words; 0 is the end of a text."""

    def __init__(self):
        self.memo: dict[bytes, int] = {}
        self.hashes: list[int] = [int(END_HASH)]
        self.texts: list[np.ndarray] = []
        self.train: list[bool] = []
        self.kept: list[pa.RecordBatch] = []
        self.tokens = 0

    def add(self, texts: list[str | None], train: list[bool], keep: pa.RecordBatch) -> None:
        memo = self.memo
        for text in texts:
            words = (text or "").encode("utf-8", "surrogatepass").lower().split()
            for w in set(words).difference(memo):
                memo[w] = len(self.hashes)
                self.hashes.append(xxhash.xxh3_64_intdigest(w) - (1 << 63))
            ids = np.zeros(len(words) + 1, np.uint32)
            ids[:-1] = np.fromiter(map(memo.__getitem__, words), np.uint32, len(words))
            self.texts.append(ids)
            self.tokens += len(ids)
        self.train += train
        self.kept.append(keep)

    def row(self, chunk: int) -> pa.RecordBatch:
        ids, train = np.concatenate(self.texts), np.array(self.train, bool)
        lengths = np.array([len(t) for t in self.texts], np.int64)
        counts = np.bincount(ids[np.repeat(train, lengths)], minlength=len(self.hashes))
        kept = pa.Table.from_batches(self.kept)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, kept.schema) as out:
            out.write_table(kept)
        raw = pickle.dumps((ids.view(np.uint8).reshape(-1, 4).T.copy(), lengths, train, sink.getvalue().to_pybytes()), 5)
        body = len(raw).to_bytes(8, "little") + _zstd.compress(raw, asbytes=True)
        values = [chunk], [len(self.hashes)], [np.array(self.hashes, np.int64).tobytes()], [counts.astype(np.int64).tobytes()], [body]
        kinds = pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=["chunk", "size", "hashes", "counts", "body"])


def opened(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """The tokens of a chunk, the lengths of its texts with their ends, which of them train, and the kept columns."""
    planes, lengths, train, kept = pickle.loads(_zstd.decompress(body[8:], int.from_bytes(body[:8], "little"), asbytes=True))
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel(), lengths, train, kept


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunk, at = Chunk(), TaskContext.get().partitionId() << 32
    for b in slices(batches, 200):
        chunk.add(b.column(0).to_pylist(), b.column(1).to_pylist(), pa.RecordBatch.from_arrays(b.columns[2:], names=b.schema.names[2:]))
        if chunk.tokens >= CHUNK:
            yield chunk.row(at)
            chunk, at = Chunk(), at + 1
    if chunk.texts:
        yield chunk.row(at)


def _longs(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.int64)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``h, n``: the words of training texts, once a chunk."""
    for b in batches:
        for i in range(b.num_rows):
            h, n = _longs(b.column(0)[i]), _longs(b.column(1)[i])
            yield pa.RecordBatch.from_arrays([pa.array(h[n > 0]), pa.array(n[n > 0])], names=["h", "n"])


# --- classes of the core


def _class_of(hashes: np.ndarray, core: np.ndarray, of_core: np.ndarray, other: int) -> np.ndarray:
    """A value for each hash: that of the core's word (``core`` is sorted), or ``other``."""
    at = np.minimum(np.searchsorted(core, hashes), max(len(core) - 1, 0))
    return np.where(core[at] == hashes, of_core[at], other) if len(core) else np.full(len(hashes), other)


def core_bigrams(state: DataFrame, core: np.ndarray) -> np.ndarray:
    """How often core word i is followed by core word j in training texts; a matrix of CORE x CORE at most."""
    m, shared = len(core), state.sparkSession.sparkContext.broadcast(core)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(m * m, np.int64)
        for b in batches:
            for i in range(b.num_rows):
                ids, lengths, train, _ = opened(b.column(1)[i].as_py())
                own = _class_of(_longs(b.column(0)[i]), shared.value, np.arange(m), -1)
                word, used = own[ids], np.repeat(train, lengths)
                before = np.concatenate([own[:1], word[:-1]])  # a text's last token is the end, which stands before the next
                used &= (word >= 0) & (before >= 0)
                total += np.bincount(before[used] * m + word[used], minlength=m * m)
        at = np.flatnonzero(total)
        for k in range(0, len(at), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[k : k + 100_000].astype(np.int32)), pa.array(total[at[k : k + 100_000]])], names=["pair", "n"])

    found = map_batches(state.select("hashes", "body"), run, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(m * m, np.int64)
    out[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(m, m)


def exchange(bigrams: np.ndarray, fixed: int, classes: int = CLASSES, passes: int = PASSES) -> np.ndarray:
    """Each word's class; words come by frequency, ``fixed`` has the last class to itself and stays there."""
    m, k = len(bigrams), classes + 1
    of = np.arange(m) % classes
    of[fixed] = classes
    member = np.zeros((m, k), np.int64)
    member[np.arange(m), of] = 1
    columns = np.ascontiguousarray(bigrams.T)
    right, left = bigrams @ member, columns @ member
    table_ = member.T @ right
    for _ in range(passes):
        moved = 0
        for w in range(m):
            if w == fixed:
                continue
            a, r, l, own = of[w], right[w].copy(), left[w].copy(), bigrams[w, w]
            r[a] -= own
            l[a] -= own
            rest = table_.copy()
            rest[a] -= r
            rest[:, a] -= l
            rest[a, a] -= own
            gain = gains(rest, r, l, own)[:classes]
            gain = np.round(gain - gain[a], DIGITS)
            b = int(gain.argmax())
            if gain[b] > 0:
                moved += 1
                of[w] = b
                right[:, a] -= columns[w]
                right[:, b] += columns[w]
                left[:, a] -= bigrams[w]
                left[:, b] += bigrams[w]
                table_ = rest
                table_[b] += r
                table_[:, b] += l
                table_[b, b] += own
        if not moved:
            break
    return of


def gains(rest: np.ndarray, r: np.ndarray, l: np.ndarray, own: int) -> np.ndarray:
    """What the sum of x log x over class bigrams less that over both margins gains when a word joins each class of ``rest``."""
    logs = xlogx(rest)
    rows, cols, diagonal = xlogx(rest + r) - logs, xlogx(rest + l[:, None]) - logs, np.arange(len(rest))
    both = xlogx(rest[diagonal, diagonal] + r + l + own) - logs[diagonal, diagonal]
    out = rows.sum(axis=1) - rows[diagonal, diagonal] + cols.sum(axis=0) - cols[diagonal, diagonal] + both
    # Wherever the word goes, it already stands behind its left neighbours and before its right ones.
    for margin, more in ((rest.sum(axis=1) + l, r.sum() + own), (rest.sum(axis=0) + r, l.sum() + own)):
        out -= xlogx(margin + more) - xlogx(margin)
    return out


class Joining:
    """One exchange step of words outside the core: entries (slot, count) of many words to their classes."""

    def __init__(self, class_bigrams: np.ndarray):
        # What stands where a word with right neighbours c, or left ones, would join class k.
        self.cells = np.concatenate([class_bigrams[:CLASSES].T, class_bigrams[:, :CLASSES]])
        self.margins = np.stack([class_bigrams.sum(axis=1)[:CLASSES], class_bigrams.sum(axis=0)[:CLASSES]])
        n = np.arange(TERMS)[:, None, None]
        self.cell_terms, self.margin_terms = (xlogx(x + n) - xlogx(x) for x in (self.cells, self.margins))

    @staticmethod
    def _look(terms: np.ndarray, cells: np.ndarray, slot: np.ndarray, n: np.ndarray) -> np.ndarray:
        out = terms[np.minimum(n, TERMS - 1), slot]
        if len(large := np.flatnonzero(n >= TERMS)):
            at = cells[slot[large]]
            out[large] = xlogx(at + n[large, None]) - xlogx(at)
        return out

    def classes(self, word: np.ndarray, slot: np.ndarray, n: np.ndarray, words: int) -> np.ndarray:
        """The class of each of ``words`` words; entries are sorted by word, then slot. Without entries it is class 0."""
        out = np.zeros(words, np.int64)
        if not len(word):
            return out
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        gain = np.add.reduceat(self._look(self.cell_terms, self.cells, slot, n), first, axis=0)
        group = np.cumsum(np.concatenate([[False], word[1:] != word[:-1]]))
        for side in (0, 1):
            sums = np.add.reduceat(np.where((slot > CLASSES) == side, n, 0), first)
            gain -= self._look(self.margin_terms, self.margins, np.full(len(first), side), sums)
            # In the margin of a class whose words stand on the word's other side, these count before it joins.
            near = np.flatnonzero(((slot > CLASSES) != side) & (slot % (CLASSES + 1) < CLASSES))
            to, more, at = group[near], n[near], slot[near] % (CLASSES + 1)
            before, own = self.margins[side][at], sums[to]
            gain[to, at] -= xlogx(before + more + own) - xlogx(before + more) - xlogx(before + own) + xlogx(before)
        out[word[first]] = np.round(gain, DIGITS).argmax(axis=1)
        return out


# --- all other words


def contexts(state: DataFrame, core: np.ndarray, of_core: np.ndarray) -> DataFrame:
    """``chunk, at, h, n, near``: every word of every chunk, its count in training texts, and outside the core its neighbours' classes."""
    shared = state.sparkSession.sparkContext.broadcast((core, of_core))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                hashes, counts = _longs(b.column("hashes")[i]), _longs(b.column("counts")[i])
                ids, lengths, train, _ = opened(b.column("body")[i].as_py())
                of = _class_of(hashes, *shared.value, -1)
                cls, used = of[ids], np.repeat(train, lengths)
                open_ = np.flatnonzero(used & (cls < 0))
                before = np.where(open_ > 0, cls[open_ - 1], END)
                after = cls[open_ + 1]  # an end follows every word
                word = ids[open_].astype(np.int64) * SLOTS
                keys, n = np.unique(np.concatenate([(word + after)[after >= 0], (word + CLASSES + 1 + before)[before >= 0]]), return_counts=True)
                near = np.empty(len(keys), _entry)
                near["slot"], near["n"] = keys % SLOTS, n
                ends = np.searchsorted(keys, np.arange(len(hashes) + 1) * SLOTS) * _entry.itemsize
                data = near.tobytes()
                for lo in range(0, len(hashes), 50_000):
                    hi = min(len(hashes), lo + 50_000)
                    offsets = (ends[lo : hi + 1] - ends[lo]).astype(np.int32)
                    entries = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[ends[lo] : ends[hi]])])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(hi - lo, b.column("chunk")[i].as_py())), pa.array(np.arange(lo, hi, dtype=np.int32)), pa.array(hashes[lo:hi]), pa.array(counts[lo:hi]), entries], names=["chunk", "at", "h", "n", "near"]
                    )

    return map_batches(state, run, "chunk bigint, at int, h bigint, n bigint, near binary")


def _groups(batches: Iterator[pa.RecordBatch], rows: int = 40_000) -> Iterator[pa.Table]:
    """Rows sorted by ``h`` in parts that end where a word ends."""
    held: list[pa.RecordBatch] = []
    size, least = 0, rows
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= least:
            t = pa.Table.from_batches(held).combine_chunks()
            h = t.column("h").to_numpy()
            cut = int(np.searchsorted(h, h[-1]))
            if cut:
                yield t.slice(0, cut)
                held, size = t.slice(cut).to_batches(), t.num_rows - cut
            least = max(rows, 2 * size)
    if size:
        yield pa.Table.from_batches(held)


def decided(words: DataFrame, core: np.ndarray, of_core: np.ndarray, class_bigrams: np.ndarray) -> DataFrame:
    """``chunk, at, n, cls``: the whole count and the class of each chunk's words; rows of chunk -1 count the distinct words of class ``at``."""
    shared = words.sparkSession.sparkContext.broadcast((core, of_core, class_bigrams))
    names = ["chunk", "at", "n", "cls"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core_, of_core_, bigrams = shared.value
        joining, distinct = Joining(bigrams), np.zeros(UNSEEN + 1, np.int64)
        for t in _groups(batches):
            h = t.column("h").to_numpy()
            fresh = np.concatenate([[True], h[1:] != h[:-1]])
            first, word = np.flatnonzero(fresh), np.cumsum(fresh) - 1
            total = np.add.reduceat(t.column("n").to_numpy(), first)
            near = t.column("near").combine_chunks()
            near = near.chunk(0) if isinstance(near, pa.ChunkedArray) else near
            offsets = np.frombuffer(near.buffers()[1], np.int32)[near.offset : near.offset + len(near) + 1]
            data = near.buffers()[2]
            entries = np.frombuffer(data, _entry, (offsets[-1] - offsets[0]) // _entry.itemsize, offsets[0]) if data is not None and offsets[-1] > offsets[0] else np.zeros(0, _entry)
            keys = np.repeat(word, np.diff(offsets) // _entry.itemsize) * SLOTS + entries["slot"]
            keys, place = np.unique(keys, return_inverse=True)
            sums = np.bincount(place, entries["n"], len(keys)).astype(np.int64)
            own = _class_of(h[first], core_, of_core_, -1)
            cls = np.where(own >= 0, own, joining.classes(keys // SLOTS, keys % SLOTS, sums, len(first)))
            cls[total == 0] = UNSEEN
            distinct += np.bincount(cls, minlength=UNSEEN + 1)
            yield pa.RecordBatch.from_arrays([t.column("chunk").combine_chunks(), t.column("at").combine_chunks(), pa.array(total[word]), pa.array(cls[word].astype(np.int32))], names=names)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(UNSEEN + 1, -1)), pa.array(np.arange(UNSEEN + 1, dtype=np.int32)), pa.array(distinct), pa.array(np.zeros(UNSEEN + 1, np.int32))], names=names)

    return map_batches(words.repartition("h").sortWithinPartitions("h"), run, "chunk bigint, at int, n bigint, cls int")


def coded(state: DataFrame, found: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """The kept columns with ``n_tokens, n_known, words`` (sum of log10 of count + 0.5), ``classes`` (a byte a token) and ``trains``."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        size = left.column("size")[0].as_py()
        ids, lengths, train, kept = opened(left.column("body")[0].as_py())
        count, cls = np.zeros(size, np.int64), np.zeros(size, np.uint8)
        at = right.column("at").to_numpy()
        count[at], cls[at] = right.column("n").to_numpy(), right.column("cls").to_numpy()
        first = np.cumsum(lengths) - lengths
        known, logs = np.add.reduceat((count > 0)[ids].astype(np.int64), first), np.add.reduceat(np.log10(count + 0.5)[ids], first)
        ends = pa.py_buffer(np.append(first, lengths.sum()).astype(np.int32).tobytes())
        classes = pa.Array.from_buffers(pa.binary(), len(lengths), [None, ends, pa.py_buffer(cls[ids].tobytes())])
        keep = pa.ipc.open_stream(kept).read_all()
        values = [*keep.columns, pa.array(lengths), pa.array(known), pa.array(logs), classes, pa.array(train)]
        return pa.Table.from_arrays(values, names=[*keep.schema.names, "n_tokens", "n_known", "words", "classes", "trains"])

    more = T.StructType().add("n_tokens", "long").add("n_known", "long").add("words", "double").add("classes", "binary").add("trains", "boolean")
    both = state.select("chunk", "size", "body").groupBy("chunk").cogroup(found.where("chunk >= 0").groupBy("chunk"))
    return both.applyInArrow(run, T.StructType([*fields, *more.fields]))


# --- transitions and scores


def _sequences(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of all tokens of a batch, the classes before them, and the lengths of the texts."""
    column = b.column("classes")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    cls = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].astype(np.int64)
    before = np.concatenate([[END], cls[:-1]])
    before[(offsets[:-1] - offsets[0])] = END
    return cls, before, np.diff(offsets)


def transitions(texts: DataFrame) -> np.ndarray:
    """How often class i is followed by class j in training texts."""
    k = UNSEEN + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * k, np.int64)
        for b in batches:
            if b.num_rows:
                cls, before, _ = _sequences(b)
                total += np.bincount(before * k + cls, minlength=k * k)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k, dtype=np.int32)), pa.array(total)], names=["pair", "n"])

    out = np.zeros(k * k, np.int64)
    for r in map_batches(texts.where("trains").select("classes"), run, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect():  # k * k rows
        out[r["pair"]] = r["n"]
    return out.reshape(k, k)


def token_logs(pairs: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """log10 of P(class j | class i) / Z(j), so that a token adds this and log10 of its count + 0.5."""
    z = pairs.sum(axis=0) + 0.5 * distinct
    z[UNSEEN] = 0
    all_, p = z.sum() + 0.5, np.zeros((UNSEEN + 1, UNSEEN + 1))
    if z.any():
        p = (1 - 0.5 / all_) * (pairs + PRIOR * z / z.sum()) / (pairs.sum(axis=1, keepdims=True) + PRIOR)
    p[:, UNSEEN], z[UNSEEN] = 0.5 / all_, 0.5
    return np.log10(np.maximum(p, 1e-300)) - np.log10(np.maximum(z, 0.5))


def scores(df: DataFrame, text: Column, held: Column, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with RESULTS, learnt from the rows where ``held`` is false."""
    if taken := {c.lower() for c in keep} & {*RESULTS, "words", "classes", "trains"}:
        raise ValueError(f"columns with names of results: {sorted(taken)}")
    spark = df.sparkSession
    source = df.select(text.alias("__text"), (~held).alias("__train"), *[F.col(f"`{c}`") for c in keep])
    fields = source.schema.fields[2:]
    state = materialize(map_batches(source, _chunks, "chunk bigint, size int, hashes binary, counts binary, body binary"), "chunks")
    vocabulary = materialize(map_batches(state.select("hashes", "counts"), _words, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")), "vocabulary")
    n, v = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = [r["h"] for r in vocabulary.where(F.col("h") != int(END_HASH)).orderBy(F.col("n").desc(), "h").limit(CORE - 1).collect()]
    discard(vocabulary)
    core = np.array([int(END_HASH), *frequent] if n else [], np.int64)
    order = np.argsort(core)
    ranked = np.empty(len(core), np.int64)
    ranked[order] = np.arange(len(core))  # where each word by frequency stands in the sorted core
    bigrams = core_bigrams(state, core[order])[np.ix_(ranked, ranked)] if n else np.zeros((0, 0), np.int64)
    of = exchange(bigrams, 0) if n else np.zeros(0, np.int64)
    member = np.zeros((len(core), END + 1), np.int64)
    member[np.arange(len(core)), of] = 1
    core, of_core = core[order], of[order]
    found = materialize(decided(contexts(state, core, of_core), core, of_core, member.T @ bigrams @ member), "classes")
    texts = materialize(coded(state, found, fields), "coded")
    distinct = np.zeros(UNSEEN + 1, np.int64)
    for r in found.where("chunk = -1").groupBy("at").agg(F.sum("n").alias("n")).collect():  # a row a class
        distinct[r["at"]] = r["n"]
    discard(state, found)
    logs, total = spark.sparkContext.broadcast(token_logs(transitions(texts), distinct)), float(np.log10(n + 0.5 * (v + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cls, before, lengths = _sequences(b)
                words, tokens = b.column("words").to_numpy(), b.column("n_tokens").to_numpy()
                score = np.add.reduceat(logs.value[before, cls], np.cumsum(lengths) - lengths) + words
                values = [pa.array(np.full(b.num_rows, n, np.int64)), pa.array(words - tokens * total), pa.array(score), pa.array(10.0 ** np.minimum(-score / tokens, 300))]
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in (*keep, "n_tokens", "n_known")], *values], names=[*keep, *RESULTS])

    out = T.StructType(fields).add("n_tokens", "long").add("n_known", "long").add("train_tokens", "long").add("base_score", "double").add("score", "double").add("perplexity", "double")
    return map_batches(texts.select(*[f"`{c}`" for c in keep], "n_tokens", "n_known", "words", "classes"), run, out)


def op11_class_lm(spark, sf_dir: str) -> DataFrame:
    """Scores of every document; a fifth of them is held out of all counts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out(F.col("doc_id"), 5, 1).alias("held_out"))
    return scores(docs, F.col("text"), F.col("held_out"), ["doc_id", "held_out"])

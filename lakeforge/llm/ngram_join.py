"""N-gram Jaccard join by vertical partitioning.

The global order of n-grams is that of their 64-bit hashes. Signatures: for each class of
sizes the order is cut into fragments, more of them than two linked sets of that class can
differ in, so that many non-empty fragments are the same in both; a fragment is known by
one 64-bit signature. (A set with so many empty fragments that this doesn't follow lists
its prefix besides; two linked sets without a common fragment are both of that kind.)

Steps: equal sets are one class. Signatures are sorted within a task, where a group of
equal ones keeps one leader, and meet in blocks of their range, so that a signature that a
third of all texts have comes to a block once a task. Texts with fewer shared signatures
than the threshold implies are left out. Each class is verified against the best leader of
its signatures (the text with most shared ones leads), which joins the groups of near
copies. What is left are signatures held by several components: their texts are joined by
prefixes in the order of frequency, with positions and sizes in the key, so that a common
passage makes no candidates; of every key's largest component no two texts are compared.
This last step is exact, so no link between components is lost and none inside one is
expanded. Its pairs are those at or near the threshold; their number isn't bounded.

Verification is by vertical partitioning: the order is cut into fragments of bounded size,
each pair's overlap is counted by fragment, and the counts are summed. Joins on keys that
may be hot are sort-merge joins of two plain exchanges, which adaptive execution splits.

Defined results: rows are the nodes, known by numbers given in the first pass, so repeated
and null ids do no harm: a component's id is the smallest non-null doc_id of its rows (null
if it has none). Without words (null, empty, white space) the set is empty and linked with
nothing; with fewer words than the n-gram has, the whole sequence is the one n-gram; texts
of any length are taken whole; ties go to the smaller number; other columns aren't read;
an empty table gives an empty table. Equal hashes of different n-grams (2**-64) are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bloom, discard, map_batches, materialize, slices, table, with_hit
from .components import components

MEMO_WORDS = 100_000
#: At most about so many n-grams of a set stand in one fragment of the verification.
FRAGMENT = 1024
#: Fragments for each n-gram that two linked sets may differ in; steps of the threshold that a class of sizes spans.
FRAGMENTS_FOR_EACH, SPAN = 1.3, 3
#: Signatures that a task sorts at once.
CHUNK = 1_000_000
#: The blocks of the signatures' range are as many as the input's partitions, within these powers of two.
LEAST_BITS, MOST_BITS = 9, 17
#: Sizes within a band differ by about this factor.
BAND = 1.02

MADE = "kind int, key long, doc_id long, h long, n long, digest binary, t0 int, t1 int, sig long, w int, block int, blob binary"
_zstd = pa.Codec("zstd", 1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str, memo: dict[bytes, int]) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if len(memo) > MEMO_WORDS:
        memo.clear()
    for w in set(words).difference(memo):
        memo[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def ngrams(text: str, n: int, memo: dict[bytes, int]) -> np.ndarray:
    """Hashes of all n-grams in text order; with fewer words, one of the whole sequence."""
    h = word_hashes(text, memo)
    if not len(h):
        return h
    if len(h) < n:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes())], np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k])
    return out


def ngram_set(text: str, n: int, memo: dict[bytes, int]) -> np.ndarray:
    return np.unique(ngrams(text, n, memo))


def set_digest(hashes: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None


def _cut(hashes: np.ndarray, k: int) -> np.ndarray:
    """The fragment of each hash when the order is cut into k."""
    return ((hashes >> np.uint64(11)).astype(np.float64) * (k / 2.0**53)).astype(np.int64)


@lru_cache(maxsize=100_000)
def level_of(n: int, percent: int) -> tuple[int, bool]:
    """The level whose sizes hold n (from step ** level on, step = (100 / percent) ** SPAN), and whether n may be the larger of a pair of the level below."""
    j = int(math.log(n) / math.log(100 / percent) / SPAN)
    while 100 ** ((j + 1) * SPAN) <= n * percent ** ((j + 1) * SPAN):
        j += 1
    while 100 ** (j * SPAN) > n * percent ** (j * SPAN):
        j -= 1
    return j, j > 0 and n * percent ** (j * SPAN + 1) < 100 ** (j * SPAN + 1)


@lru_cache(maxsize=1000)
def cuts_of(level: int, percent: int) -> int:
    """Fragments of a level, or 0 if linked sets of the level are equal."""
    most = -(-(100 ** ((level + 1) * SPAN)) // percent ** ((level + 1) * SPAN)) - 1  # the smaller set has as many or fewer
    d = most * (100 - percent) // percent  # most elements in one set and not in both
    return 0 if d == 0 else math.ceil(FRAGMENTS_FOR_EACH * d) + 3 + math.ceil(2 * (d + 1) * math.exp(-most * percent / 100 / (d + 1)))


def level_signatures(hashes: np.ndarray, percent: int) -> list[tuple[np.ndarray, int]]:
    """For the set's level and the one below: keys, and how many of them a linked but not equal set has too, at least, at one of the levels."""
    n, out = len(hashes), []
    j, below = level_of(n, percent)
    d = n * (100 - percent) // percent
    for level in (j, j - 1) if below else (j,):
        if not (k := cuts_of(level, percent)):
            out.append((np.zeros(0, np.uint64), 1))
            continue
        frag = _cut(hashes, k)
        first = np.flatnonzero(np.diff(frag, prepend=-1))
        sums = np.add.reduceat(mix(hashes), first)
        keys, least = mix(sums + mix(frag[first].astype(np.uint64) * np.uint64(2) + np.uint64(level << 33))), len(first) - d
        if least < 1:  # as many fragments as the sets may differ in
            keys, least = np.concatenate([keys, mix(hashes[: n - -(-n * percent // 100) + 1] + np.uint64((level << 33) + 1))]), 1
        out.append((np.unique(keys), least))
    return out


def signatures(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Keys such that two sets with a Jaccard similarity of ``percent`` or more, but not equal, share one at least."""
    return np.unique(np.concatenate([keys for keys, _ in level_signatures(hashes, percent)]))


def _pack(sigs: np.ndarray, who: np.ndarray, base: int) -> bytes:
    """Sorted signatures as differences, and offsets of rows; the bytes of one place stand together, which compresses better."""
    x = np.concatenate([np.array([base], np.uint64), np.diff(sigs, prepend=np.uint64(0)), who])
    raw = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(raw).to_bytes(8, "little") + _zstd.compress(raw, asbytes=True)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures, row numbers and marks (1: of the level below, 2: others of its task have the signature too)."""
    raw = _zstd.decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    x = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    n = (len(x) - 1) // 2
    return np.cumsum(x[1 : n + 1]), (x[n + 1 :] >> np.uint64(2)) + x[0], (x[n + 1 :] & np.uint64(3)).astype(np.int32)


def _made(rows: int, **columns) -> pa.RecordBatch:
    kinds = {"kind": pa.int32(), "key": pa.int64(), "doc_id": pa.int64(), "h": pa.int64(), "n": pa.int64(), "digest": pa.binary(), "t0": pa.int32(), "t1": pa.int32(), "sig": pa.int64(), "w": pa.int32(), "block": pa.int32(), "blob": pa.binary()}
    return pa.RecordBatch.from_arrays([columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], t) if c in columns else pa.nulls(rows, t) for c, t in kinds.items()], names=list(kinds))


def _chunk(sigs: list[np.ndarray], who: list[int], base: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Of equal signatures of a task one leader goes to a block; the others are known to be shared already. Empties both lists."""
    s, w = np.concatenate(sigs), np.repeat(np.array(who, np.uint64), [len(keys) for keys in sigs])
    sigs.clear(), who.clear()
    order = np.argsort(s, kind="stable")
    s, w = s[order], w[order]
    del order
    lead = np.concatenate([[True], s[1:] != s[:-1]])
    followed = np.concatenate([~lead[1:], [False]])
    rest = np.flatnonzero(~lead)
    for at in range(0, len(rest), 20_000):
        some = rest[at : at + 20_000]
        yield _made(len(some), kind=np.full(len(some), 2, np.int32), key=((w[some] >> np.uint64(2)) + np.uint64(base)).view(np.int64), sig=s[some].view(np.int64), w=(w[some] & np.uint64(1)).astype(np.int32))
    s, w = s[lead], w[lead] | (followed[lead].astype(np.uint64) << np.uint64(1))
    block = (s >> np.uint64(64 - bits)).astype(np.int32)
    ends = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(block))
    own = block[ends[:-1]]
    for at in range(0, len(own), 64):
        some = own[at : at + 64]
        blobs = [_pack(s[ends[i] : ends[i + 1]], w[ends[i] : ends[i + 1]], base) for i in range(at, at + len(some))]
        yield _made(len(some), kind=np.full(len(some), 1, np.int32), block=some, blob=blobs)


def _gather(n: int, percent: int, bits: int):
    """Texts to rows of three kinds: 0 a text with its set's size and digest, 1 a block's signatures, 2 a signature that an earlier text of the task has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        base = at = TaskContext.get().partitionId() << 33
        sigs, who, held, seen = [], [], 0, set()
        for b in slices(batches, 500):
            sizes, digests, t0, t1 = [], [], [], []
            for t in b.column(2):
                s = ngram_set(t.as_py() or "", n, memo)
                digest, least = set_digest(s), [0, 0]
                if digest is not None and digest not in seen:
                    seen.add(digest)
                    for w, (keys, need) in enumerate(level_signatures(s, percent)):
                        least[w] = need
                        sigs.append(keys)
                        who.append((at - base) * 4 + w)
                        held += len(keys)
                sizes.append(len(s))
                digests.append(digest)
                t0.append(least[0])
                t1.append(least[1])
                at += 1
            keys = np.arange(at - b.num_rows, at, dtype=np.int64)
            yield _made(b.num_rows, kind=np.zeros(b.num_rows, np.int32), key=keys, doc_id=b.column(0), h=b.column(1), n=sizes, digest=digests, t0=t0, t1=t1)
            if held >= CHUNK or len(seen) >= CHUNK // 10:
                if held:
                    yield from _chunk(sigs, who, base, bits)
                base, held, seen = at, 0, set()
        if held:
            yield from _chunk(sigs, who, base, bits)

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of blocks to the signatures that several texts have."""

    def rows():
        for b in batches:
            for block, blob in zip(b.column(0), b.column(1), strict=True):
                yield block.as_py(), blob.as_py()

    for _, found in groupby(rows(), key=lambda r: r[0]):
        parts = [_unpack(blob) for _, blob in found]
        s, key, mark = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.argsort(s, kind="stable")
        s, key, mark = s[order], key[order], mark[order]
        same = s[1:] == s[:-1]
        keep = np.concatenate([same, [False]]) | np.concatenate([[False], same]) | (mark >= 2)
        yield pa.RecordBatch.from_arrays([pa.array(s[keep].view(np.int64)), pa.array(key[keep].view(np.int64)), pa.array(mark[keep] & 1)], names=["sig", "key", "w"])


def cuts(n: int) -> int:
    """The fragments that a set of n is cut into for verification: a power of two."""
    return 1 << ((n - 1) // FRAGMENT).bit_length()


def _sets(n: int, percent: int):
    """``key, n, own, cuts, frag, hs`` for ``key, digest, text``: the set by fragments, also as cut for a larger partner if that differs (not ``own``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        for b in slices(batches, 200):
            rows: list[list] = [[], [], [], [], [], []]
            for key, digest, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                s = ngram_set(t.as_py() or "", n, memo)
                if set_digest(s) != digest:  # another text of the same hash
                    continue
                for k in sorted({cuts(len(s)), cuts(len(s) * 100 // percent)}):
                    frag = _cut(s, k)
                    first = np.flatnonzero(np.diff(frag, prepend=-1))
                    for f, part in zip(frag[first].tolist(), np.split(s, first[1:]), strict=True):
                        for column, v in zip(rows, (key, len(s), k == cuts(len(s)), k, f, part.view(np.int64)), strict=True):
                            column.append(v)
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], names=["key", "n", "own", "cuts", "frag", "hs"])

    return run


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``a, na, b, nb`` that link."""
    over = F.expr(f"(greatest(na, nb) - 1) div {FRAGMENT}")
    pairs = pairs.withColumn("cuts", F.when(over == 0, 1).otherwise(F.expr(f"shiftleft(1, length(bin((greatest(na, nb) - 1) div {FRAGMENT})))")))
    left = pairs.join(sets.select(F.col("key").alias("a"), "cuts", "frag", F.col("hs").alias("ha")), ["a", "cuts"])
    both = left.join(sets.select(F.col("key").alias("b"), "cuts", "frag", F.col("hs").alias("hb")), ["b", "cuts", "frag"])
    counted = both.select("a", "na", "b", "nb", F.size(F.array_intersect("ha", "hb")).cast("long").alias("part"))
    total = counted.groupBy("a", "na", "b", "nb").agg(F.sum("part").alias("overlap"))
    return total.where(100 * F.col("overlap") >= percent * (F.col("na") + F.col("nb") - F.col("overlap"))).select("a", "b")


def _open(members: DataFrame, found: DataFrame) -> DataFrame:
    """``key, n, comp`` of the texts that still may link with another component, by the signatures they share with one."""
    labelled = members.join(found, F.col("key") == F.col("node"), "left").select("sig", "key", "n", "w", "least", F.coalesce("component", "key").alias("comp"))
    several = labelled.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("sig")
    counted = labelled.join(several, "sig").groupBy("key", "n", "w", "least", "comp").count()
    return counted.where("count >= least").groupBy("key").agg(F.first("n").alias("n"), F.first("comp").alias("comp"))


def _rare_pairs(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, na, b, nb``: pairs of ``left`` (``key, n, comp``) of different components that can link, by prefixes in the order of frequency.

    A set's elements are ordered by how many sets of ``left`` have them. Where x, the smaller, and y
    link, their first common element e (at px, py; counted from 0) leaves room for the overlap o >= percent
    (nx + ny) / (100 + percent): o <= nx - px and o <= ny - py. Both give a range of partners' sizes for an
    element at a place; bands of both sizes are part of the key.
    """
    elements = sets.where("own").select("key", F.explode("hs").alias("e")).join(left, "key")
    often = elements.groupBy("e").agg(F.count("*").alias("c")).where("c > 1")
    ranked = elements.select("key", "n", "comp", "e").join(often, "e").groupBy("key", "n", "comp").agg(F.sort_array(F.collect_list(F.struct("c", "e"))).alias("es"))
    # Elements that no other set has come first in the order.
    placed = ranked.select("key", "n", "comp", (F.col("n") - F.size("es")).alias("alone"), F.posexplode("es").alias("i", "x")).select("key", "n", "comp", "x.e", (F.col("alone") + F.col("i")).alias("p"))
    band = lambda n: f"cast(floor(ln({n}) / ln({BAND}) + 1e-9) AS int)"
    # The largest partner of a place, and the smallest one that a larger set has.
    top = f"least(n * 100 div {percent}, ((100 + {percent}) * (n - p) - {percent} * n) div {percent})"
    low = f"(n * {percent} + 99) div 100"
    placed = materialize(placed.selectExpr("key", "n", "comp", "e", "p", f"{top} AS top", f"{low} AS low", f"{band('n')} AS own").where("top >= low"), "placed")
    small = placed.where("top >= n").selectExpr("key", "n", "comp", "e", "p", "own AS bx", f"explode(sequence(own, {band('top')})) AS by")
    large = placed.selectExpr("key", "n", "comp", "e", "p", f"explode(sequence({band('low')}, {band('least(n, top)')})) AS bx", "own AS by")
    on = ["e", "bx", "by"]
    both = small.select(*on, "comp").unionByName(large.select(*on, "comp"))
    main = both.groupBy(*on, "comp").count().groupBy(*on).agg(F.max(F.struct("count", "comp")).alias("x"), F.count("*").alias("comps")).where("comps > 1").select(*on, F.col("x.comp").alias("main"))
    small, large = (df.join(main, on).withColumn("other", F.col("comp") != F.col("main")) for df in (small, large))
    pairs = None
    for x, y in ((small.where("other"), large), (small.where("not other"), large.where("other"))):
        x, y = x.select(*on, *[F.col(c).alias(f"{c}x") for c in ("key", "n", "comp", "p")]), y.select(*on, *[F.col(c).alias(f"{c}y") for c in ("key", "n", "comp", "p")])
        found = x.join(y, on).where(f"compx <> compy AND (nx < ny OR nx = ny AND keyx < keyy) AND 100 * nx >= {percent} * ny AND (100 + {percent}) * least(nx - px, ny - py) >= {percent} * (nx + ny)")
        found = found.select(F.col("keyx").alias("a"), F.col("nx").alias("na"), F.col("keyy").alias("b"), F.col("ny").alias("nb"))
        pairs = found if pairs is None else pairs.unionByName(found)
    pairs = materialize(pairs.distinct(), "pairs")
    discard(placed)
    return pairs


def link_rows(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``key, doc_id, h, n_shingles, class_id, component`` for every row of ``doc_id, text``: numbers of the row, its class and component, and xxhash64(doc_id, text)."""
    source = docs.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text").alias("h"), "text")
    bits = min(MOST_BITS, max(LEAST_BITS, (source.rdd.getNumPartitions() - 1).bit_length()))
    made = materialize(map_batches(source, _gather(n, percent, bits), MADE), "ngrams")

    rows = made.where("kind = 0").select("key", "doc_id", "h", "n", "digest", "t0", "t1")
    groups = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("c")).where("c > 1").select("digest", "first")
    rows = materialize(rows.join(groups, "digest", "left").select("key", "doc_id", "h", F.col("n").alias("n_shingles"), F.coalesce("first", "key").alias("class_id"), "digest", "t0", "t1"), "rows")

    met = map_batches(made.where("kind = 1").select("block", "blob").repartition("block").sortWithinPartitions("block"), _meet, "sig long, key long, w int")
    shared = met.unionByName(made.where("kind = 2").select("sig", "key", "w"))
    copies = rows.where("class_id <> key").select("key", "class_id")
    shared = shared.join(copies, "key", "left").select("sig", F.coalesce("class_id", "key").alias("key"), "w").distinct()
    several = shared.groupBy("sig").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi").select("sig")
    shared = materialize(shared.join(several, "sig"), "shared")
    discard(made)

    # Signatures are of the first text of a class in a task, so its bounds are known there; they depend on the set alone.
    bounds = rows.where("t0 > 0").groupBy("class_id").agg(F.first("n_shingles").alias("n"), F.max("t0").alias("t0"), F.max("t1").alias("t1"))
    counted = shared.groupBy("key", "w").count().join(bounds, F.col("key") == F.col("class_id")).select("key", "n", "w", "count", F.when(F.col("w") == 0, F.col("t0")).otherwise(F.col("t1")).alias("least")).where("count >= least")
    members = materialize(shared.join(counted, ["key", "w"]), "members")
    discard(shared)

    wanted = members.select("key").distinct().join(rows.select("key", "h", "digest"), "key")
    wanted = materialize(wanted, "wanted")
    texts = with_hit(docs.select(F.xxhash64("doc_id", "text").alias("h"), "text"), "h", bloom(wanted.select("h")), "hit").where("hit").groupBy("h").agg(F.first("text").alias("text"))
    sets = materialize(map_batches(texts.join(wanted, "h").select("key", "digest", "text"), _sets(n, percent), "key long, n long, own boolean, cuts int, frag int, hs array<long>"), "sets")

    lead = members.groupBy("sig").agg(F.max(F.struct("count", -F.col("key"), "key", "n")).alias("x")).select("sig", F.col("x.key").alias("a"), F.col("x.n").alias("na"))
    star = members.join(lead, "sig").where("a <> key").select("a", "na", F.col("key").alias("b"), F.col("n").alias("nb")).where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    best = star.groupBy("a", "na", "b", "nb").count().groupBy("b", "nb").agg(F.max(F.struct("count", -F.col("a"), "a", "na")).alias("x")).select("x.a", "x.na", "b", "nb")
    best = materialize(best, "best")
    edges = materialize(verify(best, sets, percent), "links")
    first = components(edges)
    left = materialize(_open(members, first), "left")
    more = materialize(verify(pairs := _rare_pairs(left, sets, percent), sets, percent), "links")
    found = components(first.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    discard(members, wanted, sets, best, edges, left, pairs, more)
    return rows.join(found, F.col("class_id") == F.col("node"), "left").select("key", "doc_id", "h", "n_shingles", "class_id", F.coalesce("component", "class_id").alias("component"))


def near_duplicates(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id`` for every row of ``doc_id, text``: the number of its class, and the smallest doc_id of its component."""
    rows = link_rows(docs, n, percent)
    groups = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("c")).where("c > 1").drop("c")
    return rows.join(groups, "component", "left").select("doc_id", "n_shingles", "class_id", F.coalesce("component_id", "doc_id").alias("component_id"))


def op5_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Set size and component of every document, for 3-word shingles and a similarity of 0.9."""
    return near_duplicates(table(spark, sf_dir, "documents"), 3, 90).select("doc_id", "n_shingles", "component_id")

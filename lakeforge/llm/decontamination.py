"""Benchmark decontamination by SimHash over item-sized windows.

A window of a document has as many words as the item it is held against. Windows can
only reach the similarity where they share a shingle with the item's benchmark, so
windows are opened around such places alone (this loses nothing). Each window's SimHash
comes from prefix sums of its shingles' bit vectors. A multi-index over 8 blocks of 8
bits lists all items within RADIUS bits: with r bits different, some block differs in
r // 8 at most. Candidates are verified by the exact weighted (by count) Jaccard
similarity of shingles.

The benchmark is read by the driver and broadcast; more than MOST_ITEMS items raise an
error rather than being dropped. Defined results: null and empty texts match nothing;
items without words match nothing; items shorter than a shingle are one shingle; equal
items all match; repeated rows repeat results; empty tables give no matches.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, slices, table
from .ngram_join import mix, ngrams

WORDS, PERCENT = 5, 80
#: Bits by which fingerprints of linked windows may differ.
RADIUS = 23
#: Most items; the broadcast index is proportional to them.
MOST_ITEMS = 200_000
#: Windows looked up at a time, and the shingles that a run of them may span.
WINDOWS, STRETCH = 4096, 8192

_shifts = np.arange(64, dtype=np.uint64)
_near = np.array([[bin(a ^ b).count("1") for b in range(256)] for a in range(256)], np.uint8)


def signs(shingles: np.ndarray) -> np.ndarray:
    """Bit vectors of plus and minus one."""
    return ((mix(shingles)[:, None] >> _shifts) & np.uint64(1)).astype(np.int32) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(np.uint64) << _shifts).sum(axis=-1, dtype=np.uint64)


def blocks(prints: np.ndarray) -> np.ndarray:
    return prints.astype("<u8").view(np.uint8).reshape(-1, 8)


class Items:
    """The items of one length in words, with the multi-index of their fingerprints."""

    def __init__(self, ids: list[int], bags: list[np.ndarray], words: int):
        self.ids, self.words, self.size = ids, words, min(WORDS, words)
        self.bags = [Counter(b.tolist()) for b in bags]
        self.prints = fingerprints(np.array([signs(b).sum(axis=0) for b in bags]))
        self.keys = np.unique(np.concatenate(bags))
        parts = blocks(self.prints)
        order = [np.argsort(parts[:, k], kind="stable") for k in range(8)]
        self.postings = [(o, np.searchsorted(parts[o, k], np.arange(257))) for k, o in enumerate(order)]

    def within(self, print_: np.uint64) -> np.ndarray:
        """Items whose fingerprints differ in RADIUS bits at most."""
        found = []
        for k, byte in enumerate(blocks(np.array([print_]))[0]):
            order, start = self.postings[k]
            for value in np.flatnonzero(_near[byte] <= RADIUS // 8):
                if start[value] < start[value + 1]:
                    found.append(order[start[value] : start[value + 1]])
        if not found:
            return np.zeros(0, np.int64)
        some = np.unique(np.concatenate(found))
        return some[np.bitwise_count(self.prints[some] ^ print_) <= RADIUS]


class Benchmark:
    def __init__(self, items: list[tuple[int, str | None]]):
        memo: dict[bytes, int] = {}
        by_words: dict[int, tuple[list, list]] = {}
        for item, text in items:
            n = len((text or "").encode("utf-8", "surrogatepass").split())
            if n:
                own = by_words.setdefault(n, ([], []))
                own[0].append(item)
                own[1].append(ngrams(text, min(WORDS, n), memo))
        self.groups = [Items(ids, bags, n) for n, (ids, bags) in sorted(by_words.items())]
        self.keys = {size: np.unique(np.concatenate([g.keys for g in self.groups if g.size == size])) for size in {g.size for g in self.groups}}

    def matches(self, text: str, memo: dict[bytes, int]) -> list[tuple[int, int, int, float]]:
        """Item, first word, words and similarity of the best window for each item that is in the text."""
        best: dict[int, tuple[float, int, int]] = {}
        for size, keys in self.keys.items():
            h = ngrams(text, size, memo)
            if not len(h):
                continue
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            if not (hit := keys[at] == h).any():
                continue
            for g in self.groups:
                if g.size == size:
                    self._group(g, h, hit, best)
        return sorted((item, at, n, sim) for item, (sim, at, n) in best.items())

    def _group(self, g: Items, h: np.ndarray, hit: np.ndarray, best: dict) -> None:
        wide = min(g.words - g.size + 1, len(h))
        own = np.flatnonzero(hit)
        own = own[np.isin(h[own], g.keys)]
        if not len(own):
            return
        # A window needs a share of its shingles among the items' own.
        held = np.zeros(len(h) + 1, np.int64)
        held[own + 1] = 1
        held = np.cumsum(held)
        starts = np.arange(len(h) - wide + 1)
        need = -(-PERCENT * (wide + g.words - g.size + 1) // (100 + PERCENT))
        starts = starts[held[starts + wide] - held[starts] >= need]
        for at in range(0, len(starts), WINDOWS):
            part = starts[at : at + WINDOWS]
            # Runs of windows share one stretch of prefix sums; a stretch spans STRETCH shingles and a window at most.
            far = (np.diff(part) > wide) | (np.diff((part - part[0]) // STRETCH) > 0)
            for run in np.split(part, np.flatnonzero(far) + 1):
                lo, hi = int(run[0]), int(run[-1]) + wide
                sums = np.concatenate([np.zeros((1, 64), np.int64), np.cumsum(signs(h[lo:hi]), axis=0)])
                prints = fingerprints(sums[run - lo + wide] - sums[run - lo])
                for start, p in zip(run.tolist(), prints, strict=True):
                    if len(some := g.within(p)):
                        bag = Counter(h[start : start + wide].tolist())
                        for i in some.tolist():
                            low, high = (bag & g.bags[i]).total(), (bag | g.bags[i]).total()
                            if 100 * low >= PERCENT * high and (low / high, -start) > (best.get(g.ids[i], (0.0, 0))[0], -best.get(g.ids[i], (0.0, 0, 0))[1]):
                                best[g.ids[i]] = (low / high, start, g.words)


def find_items(df: DataFrame, text: str, benchmark: DataFrame, keep: list[str], name: str = "matches") -> DataFrame:
    """The columns ``keep`` and ``name``: item, first word, words and similarity, by item."""
    spark = df.sparkSession
    items = benchmark.select("item_id", "text").limit(MOST_ITEMS + 1).collect()
    if len(items) > MOST_ITEMS:
        raise ValueError(f"the benchmark has more than {MOST_ITEMS} items")
    shared = spark.sparkContext.broadcast(Benchmark([tuple(r) for r in items]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("words", pa.int64()), ("similarity", pa.float64())]))
        for b in slices(batches, 500):
            out = [[dict(zip(("item_id", "start", "words", "similarity"), m, strict=True)) for m in shared.value.matches(t.as_py() or "", memo)] for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(out, kind)], names=[*keep, name])

    source = df.select(F.col(f"`{text}`").alias("__text"), *[F.col(f"`{c}`") for c in keep])
    more = T._parse_datatype_string(f"`{name}` array<struct<item_id: long, start: long, words: long, similarity: double>>")
    return map_batches(source, run, T.StructType([*source.schema.fields[1:], *more.fields]))


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    """Each document's benchmark items."""
    found = find_items(table(spark, sf_dir, "documents"), "text", table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", (F.size("matches") > 0).alias("contaminated"), F.col("matches.item_id").alias("item_ids"))

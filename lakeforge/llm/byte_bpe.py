"""Byte-level BPE encoding and decoding with a two-tier vocabulary lookup.

Tier one is a minimal perfect hash over the vocabulary (hash and displace): a
pre-token that is a vocabulary entry becomes one id with one probe and one
comparison. Tier two, for misses, merges the pre-token's bytes with a heap of
candidate pairs over a doubly linked list, lowest rank first, leftmost first.

Defined results: a null or empty text has no ids and decodes to no bytes; text
that looks like a special token is ordinary text; repeated rows give repeated
results; an empty table gives an empty table. Other columns are kept as they are. A text
is encoded whole, whatever its length.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, slices

#: Pre-tokens that a worker remembers twice over (this generation and the last), and the longest of them.
MEMO_ENTRIES, MEMO_CHARS = 150_000, 64
#: The same where no other stage needs the memory of the workers.
WIDE_MEMO = 600_000
#: Texts whose ids stand in one array.
BATCH_ROWS = 200
#: Steps are taken modulo a prime over the number of slots, so that a step shared with it can't keep a bucket from free slots.
PRIME = (1 << 31) - 1

def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file by rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PerfectHash:
    """A minimal perfect hash: n keys on n slots, with one displacement a bucket."""

    def __init__(self, keys: list[bytes], displacements: np.ndarray | None = None, slot_key: np.ndarray | None = None):
        self.keys, self.n, self.buckets = keys, len(keys), max(1, len(keys) // 4)
        if displacements is None or slot_key is None:
            displacements, slot_key = self._build()
        self.arrays = (displacements, slot_key)
        self._d, self._slot = displacements.tolist(), slot_key.tolist()

    def _parts(self, key: bytes) -> tuple[int, int, int]:
        h = xxhash.xxh3_128_intdigest(key)
        return (h & 0xFFFFFFFF) % self.buckets, h >> 32 & 0xFFFFFFFF, (h >> 64 & 0xFFFFFFFF) | 1

    def _build(self) -> tuple[np.ndarray, np.ndarray]:
        grouped: dict[int, list[tuple[int, int, int]]] = {}
        for i, key in enumerate(self.keys):
            b, first, step = self._parts(key)
            grouped.setdefault(b, []).append((i, first, step))
        displacements, slot_key = np.zeros(self.buckets, np.int64), np.full(self.n, -1, np.int64)
        taken = bytearray(self.n)
        alone = []
        for b, members in sorted(grouped.items(), key=lambda x: -len(x[1])):
            if len(members) == 1:
                alone.append((b, members[0][0]))
                continue
            d = 0
            while True:
                slots = {(first + d * step) % PRIME % self.n for _, first, step in members}
                if len(slots) == len(members) and not any(taken[s] for s in slots):
                    break
                d += 1
            displacements[b] = d
            for i, first, step in members:
                slot = (first + d * step) % PRIME % self.n
                taken[slot], slot_key[slot] = 1, i
        free = iter([s for s in range(self.n) if not taken[s]])
        for b, i in alone:  # a bucket of one key names its slot
            slot = next(free)
            displacements[b], slot_key[slot] = -slot - 1, i
        return displacements, slot_key

    def find(self, key: bytes) -> int:
        """The key's number, or -1."""
        if not self.n:
            return -1
        b, first, step = self._parts(key)
        d = self._d[b]
        i = self._slot[-d - 1 if d < 0 else (first + d * step) % PRIME % self.n]
        return i if self.keys[i] == key else -1


def quick_split(pattern: str):
    """The same split by the standard ``re``, which is quicker, and a search for characters that it takes otherwise.

    Python's ``re`` has no letter and number properties; its nearest classes stand in for them. The two modules'
    classes are compared over the basic plane; a text with a character that falls in other ones, or beyond that plane, takes the slow way.
    """
    near = {r"\p{L}": r"[^\W\d_]", r"\p{N}": r"\d", r"[^\s\p{L}\p{N}]": r"(?:[^\s\w]|_)", r"\s": r"\s", r"\S": r"\S"}
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", near[r"[^\s\p{L}\p{N}]"]).replace(r"\p{L}", near[r"\p{L}"]).replace(r"\p{N}", near[r"\p{N}"])
    if re.search(r"\\[pPwWdDbBX]|\[", plain.replace(r"[^\W\d_]", "").replace(r"(?:[^\s\w]|_)", "").replace(r"\d", "")):
        return None, None  # a pattern of another kind
    every = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000)
    odd = sorted(map(ord, set().union(*(set(re.findall(b, every)) ^ set(regex.findall(a, every)) for a, b in near.items()))))
    runs = [g for g in np.split(np.array(odd), np.flatnonzero(np.diff(odd) > 1) + 1) if len(g)]
    inside = "".join(f"\\u{g[0]:04x}-\\u{g[-1]:04x}" for g in runs)
    return re.compile(plain).findall, re.compile(f"[{inside}\\ud800-\\udfff\\U00010000-\\U0010ffff]").search


class ByteBPE:
    """Encoder and decoder over the tokens of a rank file; ``pattern`` splits text into pre-tokens."""

    def __init__(self, tokens: list[bytes], pattern: str, arrays: tuple[np.ndarray, np.ndarray] | None = None):
        self.tokens, self.findall = tokens, regex.compile(pattern).findall
        self.quick, self.odd = quick_split(pattern)
        self.hash = PerfectHash(tokens, *(arrays or (None, None)))
        # Tier two asks for the ranks of many short pieces, most of them no tokens; a plain dict is quickest for these.
        self.ranks = {t: i for i, t in enumerate(tokens) if t}
        self.column = pa.array(tokens, pa.binary())
        self.entries = MEMO_ENTRIES
        # Ids stand as the bytes of 32-bit numbers, which take less room than tuples and are joined without a step for each id.
        self.memo: dict[str, bytes] = {}
        self.last: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The ids of a pre-token that is no vocabulary entry."""
        n, rank_of = len(piece), self.ranks.get
        after, before = list(range(1, n + 2)), list(range(-1, n))  # starts of the next and the previous part
        # A heap entry is rank, start and end in one whole number; it is stale if its part has grown or gone meanwhile.
        bits = (n + 1).bit_length()
        low = (1 << bits) - 1
        heap = [((rank << bits | i) << bits) | i + 2 for i in range(n - 1) if (rank := rank_of(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            entry = pop(heap)
            at, end = entry >> bits & low, entry & low
            if not 0 <= (mid := after[at]) < n or after[mid] != end:
                continue
            after[at], after[mid], before[end] = end, -1, at
            if end < n:
                far = after[end]
                if (rank := rank_of(piece[at:far])) is not None:
                    push(heap, ((rank << bits | at) << bits) | far)
            if (left := before[at]) >= 0 and (rank := rank_of(piece[left:end])) is not None:
                push(heap, ((rank << bits | left) << bits) | end)
        out, at = [], 0
        while at < n:
            out.append(self.ranks[piece[at : after[at]]])
            at = after[at]
        return out

    def encode_pretoken(self, pretoken: str) -> bytes:
        piece = pretoken.encode("utf-8", "surrogatepass")
        rank = self.hash.find(piece)
        return array("i", (rank,) if rank >= 0 else self.merge(piece)).tobytes()

    def encode(self, text: str) -> list[int]:
        return self.encode_array(text).tolist()

    def encode_array(self, text: str) -> np.ndarray:
        words = (self.findall if self.quick is None or self.odd(text) else self.quick)(text)
        if len(self.memo) >= self.entries:
            self.memo, self.last = {}, self.memo
        memo, last, long = self.memo, self.last, []
        for w in set(words).difference(memo):
            memo[w] = last.get(w) or self.encode_pretoken(w)
            if len(w) > MEMO_CHARS:
                long.append(w)
        ids = np.frombuffer(b"".join(map(memo.__getitem__, words)), np.int32)
        for w in long:
            del memo[w]
        return ids

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode_column(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The bytes of runs of ids, each ending before ``ends``, which starts with 0."""
        bytes_ = self.column.take(pa.array(ids))
        offsets = np.frombuffer(bytes_.buffers()[1], np.int32, len(ids) + 1) if len(ids) else np.zeros(1, np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets[ends].astype(np.int32)), bytes_.buffers()[2]])


_coder: dict[str, ByteBPE] = {}


def coder(shared) -> ByteBPE:
    """This worker's coder for a broadcast vocabulary."""
    key, pattern, tokens, arrays = shared.value
    if key not in _coder:
        _coder[key] = ByteBPE(tokens, pattern, arrays)
    return _coder[key]


@lru_cache(maxsize=4)
def _made(path: str, pattern: str) -> ByteBPE:
    return ByteBPE(read_ranks(path), pattern)


def share(spark, path: str, pattern: str):
    """Broadcast the vocabulary with its hash; its size is that of the rank file, not of the data."""
    made = _made(path, pattern)
    tokens = made.tokens
    key = xxhash.xxh3_128_hexdigest(b"\n".join([pattern.encode(), *tokens]))
    return spark.sparkContext.broadcast((key, pattern, tokens, made.hash.arrays))


def encode_decode(df: DataFrame, text: Column, path: str, pattern: str, keep: list[str], ids_col: str = "token_ids", decoded_col: str = "decoded", memo_entries: int = MEMO_ENTRIES) -> DataFrame:
    """The columns ``keep``, the ids of ``text`` (array of int) and the bytes decoded from these ids.

    The rank file is read on the driver and broadcast, so executors need no copy of it. A kept
    column with a result's name is an error. A worker remembers two times ``memo_entries`` pre-tokens; others are encoded again.
    """
    if taken := {c.lower() for c in keep} & {ids_col.lower(), decoded_col.lower()}:
        raise ValueError(f"columns with names of results: {sorted(taken)}")
    shared = share(df.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(shared)
        bpe.entries = memo_entries
        for b in slices(batches, BATCH_ROWS):
            found = [bpe.encode_array(value.as_py() or "") for value in b.column(0)]
            ends, flat = np.cumsum([0, *map(len, found)]), np.concatenate([np.zeros(0, np.int32), *found])
            ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], ids, bpe.decode_column(flat, ends)], names=[*keep, ids_col, decoded_col])

    source = df.select(text.alias("__text"), *[F.col(f"`{c}`") for c in keep])
    fields = [f for f in source.schema.fields[1:]] + [T.StructField(ids_col, T.ArrayType(T.IntegerType())), T.StructField(decoded_col, T.BinaryType())]
    return map_batches(source, run, T.StructType(fields))


def op6_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded bytes for every document."""
    import public_tokenizers

    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_digests(encode_decode(docs, F.col("text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ["doc_id"], memo_entries=WIDE_MEMO)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def with_digests(df: DataFrame) -> DataFrame:
    """Counts and SHA-256 digests of the ids and of the decoded bytes."""
    return df.withColumns({
        "n_tokens": F.size("token_ids").cast("long"),
        "ids_sha256": F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256),
        "decoded_sha256": F.sha2(F.col("decoded"), 256),
    })

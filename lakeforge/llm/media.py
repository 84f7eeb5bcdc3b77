"""Media columns: signature sniffing, type correction, carving, and 8-bit sample storage.

An Aho-Corasick automaton over magic bytes finds every place where a known format may
start; a validator for each format checks structure and lengths there. What holds at
offset 0 corrects the declared type; what holds further in is carved out.

Each end mark is looked up among all of its places, found once, and walks over chunks that
meet go on together, so a text full of magic bytes takes time in proportion to its length.
(Only a gzip stream or a WAV file that begins inside another one is read again.)

Defined results: null or empty bytes sniff as ``empty``; bytes no validator accepts as
``unknown``; of overlapping finds inside a file the first counts, of those at one place the
longest, then the first type by name, so parts carved out don't overlap; bytes of any length
are taken whole; repeated rows are rows like others; a kept column with a result's name is an
error, other columns aren't read. Equal bytes give equal values, and an empty table gives an
empty table.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, slices, table, text_bytes

# Magic bytes of each format, and where in the file they stand.
SIGNATURES = {
    "wav": (b"WAVEfmt ", 8),
    "png": (b"\x89PNG\r\n\x1a\n", 0),
    "gif": (b"GIF8", 0),
    "jpeg": (b"\xff\xd8\xff", 0),
    "pdf": (b"%PDF-", 0),
    "zip": (b"PK\x03\x04", 0),
    "gzip": (b"\x1f\x8b\x08", 0),
    "bmp": (b"BM", 0),
}
RATE, BLOCK = 8000, 64


def _automaton():
    a = ahocorasick.Automaton()
    for kind, (magic, place) in SIGNATURES.items():
        a.add_word(magic.decode("latin-1"), (kind, place, len(magic)))
    a.make_automaton()
    return a


def _wav(b: bytes, at: int, marks: Marks) -> int:
    if b[at : at + 4] != b"RIFF" or len(b) < at + 44:
        return 0
    size = struct.unpack_from("<I", b, at + 4)[0] + 8
    if size < 44 or at + size > len(b):
        return 0
    pos, seen = at + 12, set()
    while pos + 8 <= at + size:
        name, n = b[pos : pos + 4], struct.unpack_from("<I", b, pos + 4)[0]
        if pos + 8 + n > at + size or name == b"fmt " and n < 16:
            return 0
        seen.add(name)
        pos += 8 + n + n % 2
    return size if {b"fmt ", b"data"} <= seen else 0


class Marks:
    """Places of end marks in some bytes, and where walks over their chunks end; found once, used by all finds."""

    def __init__(self, b: bytes):
        self.b, self.places, self.ends = b, {}, {}

    def next(self, mark: bytes, at: int) -> int:
        """The first place of a mark at or after a place, or -1."""
        if mark not in self.places:
            found, at_ = [], self.b.find(mark)
            while at_ >= 0:
                found.append(at_)
                at_ = self.b.find(mark, at_ + 1)
            self.places[mark] = found
        found = self.places[mark]
        k = bisect_left(found, at)
        return found[k] if k < len(found) else -1

    def walk(self, kind: str, pos: int, step) -> int:
        """Where steps from a place come to an end (0: they don't): ``step`` gives the next place, or (end,). Walks that meet share their end."""
        seen, ends = [], self.ends.setdefault(kind, {})
        while pos not in ends:
            seen.append(pos)
            to = step(self.b, pos)
            if isinstance(to, tuple):
                ends[pos] = to[0]
            else:
                pos = to
        ends.update(dict.fromkeys(seen, ends[pos]))
        return ends[pos]


def _chunk(b: bytes, pos: int) -> tuple[int, bytes] | None:
    """The end and name of a PNG chunk whose check sum is right."""
    if pos + 12 > len(b):
        return None
    n, kind = struct.unpack_from(">I4s", b, pos)
    whole = pos + 12 + n <= len(b) and zlib.crc32(b[pos + 4 : pos + 8 + n]) == struct.unpack_from(">I", b, pos + 8 + n)[0]
    return (pos + 12 + n, kind) if whole else None


def _png_step(b: bytes, pos: int):
    found = _chunk(b, pos)
    if found is None or found[1] == b"IHDR":
        return (0,)
    return (found[0],) if found[1] == b"IEND" else found[0]


def _png(b: bytes, at: int, marks: Marks) -> int:
    head = _chunk(b, at + 8)
    end = marks.walk("png", head[0], _png_step) if head and head[1] == b"IHDR" else 0
    return end - at if end else 0


def _skip(b: bytes, p: int) -> int:
    while p < len(b) and b[p]:
        p += b[p] + 1
    return p + 1


def _gif_step(b: bytes, pos: int):
    if pos >= len(b):
        return (0,)
    if b[pos] == 0x3B:
        return (pos + 1,)
    if b[pos] == 0x21:
        return _skip(b, pos + 2)
    if b[pos] == 0x2C and pos + 10 <= len(b):
        own = b[pos + 9]
        return _skip(b, pos + 11 + (3 << (own & 7) + 1 if own & 128 else 0))
    return (0,)


def _gif(b: bytes, at: int, marks: Marks) -> int:
    if b[at : at + 6] not in (b"GIF87a", b"GIF89a") or len(b) < at + 14:
        return 0
    flags = b[at + 10]
    end = marks.walk("gif", at + 13 + (3 << (flags & 7) + 1 if flags & 128 else 0), _gif_step)
    return end - at if end else 0


def _jpeg(b: bytes, at: int, marks: Marks) -> int:
    def step(b: bytes, pos: int):
        if pos + 4 > len(b) or b[pos] != 0xFF:
            return (0,)
        if b[pos + 1] == 0xDA:
            return (marks.next(b"\xff\xd9", pos) + 2,) if marks.next(b"\xff\xd9", pos) >= 0 else (0,)
        n = struct.unpack_from(">H", b, pos + 2)[0]
        return (0,) if n < 2 or pos + 2 + n > len(b) else pos + 2 + n

    end = marks.walk("jpeg", at + 2, step)
    return end - at if end else 0


def _pdf(b: bytes, at: int, marks: Marks) -> int:
    end = marks.next(b"%%EOF", at)
    return end + 5 - at if end >= 0 and b[at + 5 : at + 6].isdigit() and 0 <= marks.next(b"obj", at) <= end - 3 else 0


def _zip(b: bytes, at: int, marks: Marks) -> int:
    end = marks.next(b"PK\x05\x06", at)
    if end < 0 or len(b) < end + 22:
        return 0
    size, start = struct.unpack_from("<II", b, end + 12)
    length = end + 22 + struct.unpack_from("<H", b, end + 20)[0] - at
    return length if at + start + size == end and at + length <= len(b) else 0


def _gzip(b: bytes, at: int, marks: Marks) -> int:
    d = zlib.decompressobj(31)
    try:
        pos = at
        while pos < len(b) and not d.eof:  # in bounded steps, so that a bomb isn't held
            part = b[pos : pos + 65536]
            pos += len(part)
            d.decompress(part, 1 << 20)
            while d.unconsumed_tail and not d.eof:
                d.decompress(d.unconsumed_tail, 1 << 20)
        return pos - len(d.unused_data) - at if d.eof else 0
    except zlib.error:
        return 0


def _bmp(b: bytes, at: int, marks: Marks) -> int:
    if len(b) < at + 54:
        return 0
    size, zero, start, head = struct.unpack_from("<IIII", b, at + 2)
    return size if zero == 0 and 54 <= start <= size <= len(b) - at and head in (40, 108, 124) else 0


VALIDATORS = {"wav": _wav, "png": _png, "gif": _gif, "jpeg": _jpeg, "pdf": _pdf, "zip": _zip, "gzip": _gzip, "bmp": _bmp}


def find_media(data: bytes, automaton) -> list[tuple[int, str, int]]:
    """Offset, type and length of what validators accept: what begins at 0, then what lies inside without overlap."""
    marks, out, first, free = Marks(data), [], [], 1
    places: dict[int, set[str]] = {}
    for last, (kind, place, width) in automaton.iter(data.decode("latin-1")):
        places.setdefault(last + 1 - width - place, set()).add(kind)
    for at in sorted(places):
        if at == 0 or at >= free:
            found = sorted((-n, kind) for kind in places[at] if (n := VALIDATORS[kind](data, at, marks)))
            if found and at == 0:
                first = [(0, found[0][1], -found[0][0])]
            elif found:
                out.append((at, found[0][1], -found[0][0]))
                free = at - found[0][0]
    return first + out


def _free(keep: list[str], names: tuple[str, ...]) -> None:
    if taken := {c.lower() for c in keep} & set(names):
        raise ValueError(f"columns with names of results: {sorted(taken)}")


def sniff(df: DataFrame, data: Column, declared: Column, keep: list[str]) -> DataFrame:
    """The columns ``keep``, ``media_type`` (what the bytes are), ``type_corrected`` and ``embedded`` (offset, type, length and bytes of all inside)."""

    _free(keep, ("media_type", "type_corrected", "embedded"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        kind = pa.list_(pa.struct([("offset", pa.int64()), ("type", pa.string()), ("length", pa.int64()), ("bytes", pa.binary())]))
        for b in slices(batches, 100):
            types, wrong, inside = [], [], []
            for raw, said in zip(b.column(0), b.column(1), strict=True):
                raw, said = raw.as_py() or b"", said.as_py()
                found = find_media(raw, automaton)
                types.append(next((k for at, k, _ in found if at == 0), "unknown") if raw else "empty")
                wrong.append(types[-1] != said)
                inside.append([{"offset": at, "type": k, "length": n, "bytes": raw[at : at + n]} for at, k, n in found if at])
            yield pa.RecordBatch.from_arrays([*b.columns[2:], pa.array(types), pa.array(wrong), pa.array(inside, kind)], names=[*keep, "media_type", "type_corrected", "embedded"])

    source = df.select(data.alias("__data"), declared.cast("string").alias("__said"), *[F.col(f"`{c}`") for c in keep])
    more = T._parse_datatype_string("media_type string, type_corrected boolean, embedded array<struct<offset: long, type: string, length: long, bytes: binary>>")
    return map_batches(source, run, T.StructType([*source.schema.fields[2:], *more.fields]))


def pack(payload: bytes) -> bytes:
    """Bytes as the 8-bit samples of a WAV file, after padding to whole blocks."""
    payload += bytes(-len(payload) % BLOCK or (0 if payload else BLOCK))
    return b"RIFF" + struct.pack("<I", 36 + len(payload)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data" + struct.pack("<I", len(payload)) + payload


def unpack(media: bytes) -> bytes:
    """The samples of a WAV file, found by its chunks."""
    pos = 12
    while media[pos : pos + 4] != b"data":
        pos += 8 + struct.unpack_from("<I", media, pos + 4)[0]
    return media[pos + 8 : pos + 8 + struct.unpack_from("<I", media, pos + 4)[0]]


def store(df: DataFrame, data: Column, keep: list[str]) -> DataFrame:
    """The columns ``keep``, ``n_bytes`` and ``media`` (a WAV file)."""
    _free(keep, ("n_bytes", "media"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 500):
            raw = [x.as_py() or b"" for x in b.column(0)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array([len(x) for x in raw], pa.int64()), pa.array([pack(x) for x in raw], pa.binary())], names=[*keep, "n_bytes", "media"])

    source = df.select(data.alias("__data"), *[F.col(f"`{c}`") for c in keep])
    return map_batches(source, run, T.StructType([*source.schema.fields[1:], T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())]))


def features(df: DataFrame, keep: list[str]) -> DataFrame:
    """Digests and the feature of the column ``media``, read back from its bytes, with what ``sniff`` found of it."""
    _free(keep, FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 100):
            out = []
            for m, kind, wrong, embedded in zip(*[b.column(i) for i in range(4)], strict=True):
                media = m.as_py()
                payload = unpack(media)
                # Offsets count from the payload's start.
                inside = ",".join(f"{x['type']}@{x['offset'] - len(media) + len(payload)}+{x['length']}:{hashlib.sha256(x['bytes']).hexdigest()}" for x in embedded.as_py()) or "-"
                mean = sum(payload) // len(payload)
                feature = f"{kind};corrected={int(wrong.as_py())};{RATE};1;8;mean={mean};peak={max(payload)};inside={inside}"
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-BLOCK:]), len(media), hashlib.sha256(media).hexdigest(), feature))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[4:], *[pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]], names=[*keep, *FEATURES])

    source = df.select("media", "media_type", "type_corrected", "embedded", *[F.col(f"`{c}`") for c in keep])
    more = T._parse_datatype_string("payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
    return map_batches(source, run, T.StructType([*source.schema.fields[4:], *more.fields]))


FEATURES = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op7_media(spark, sf_dir: str) -> DataFrame:
    """Every document stored as samples under the type of a text, sniffed, which corrects it and carves what lies inside, read back and digested."""
    stored = store(table(spark, sf_dir, "documents"), text_bytes(F.col("text")), ["doc_id"])
    keep = ["doc_id", "n_bytes"]
    return features(sniff(stored, F.col("media"), F.lit("text"), [*keep, "media"]), keep)

"""Media finds against a search at every offset, and on bytes full of magic bytes."""

import io
import random
import struct
import time
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from lakeforge.llm import media


def _chunk(kind, body):
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


PNG = b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", bytes(13)) + _chunk(b"IDAT", b"xyz") + _chunk(b"IEND", b"")
GIF = b"GIF89a" + bytes([1, 0, 1, 0, 0x80, 0, 0]) + bytes(6) + b"\x2c" + bytes(8) + b"\0\x02\x02\x4c\x01\0\x3b"
JPEG = b"\xff\xd8\xff\xe0" + struct.pack(">H", 6) + b"JFIF" + b"\xff\xda" + struct.pack(">H", 2) + b"scan\xff\xd9"
PDF = b"%PDF-1.4 1 0 obj <<>> endobj %%EOF"


def _zip():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.txt", "text")
    return out.getvalue()


WHOLE = [PNG, GIF, JPEG, PDF, _zip(), zlib.compress(b"a" * 50, wbits=31), media.pack(b"samples"), b"BM" + struct.pack("<IIII", 60, 0, 54, 40) + bytes(42)]


def _plain(b):
    found = []
    for at in range(len(b)):
        own = []
        for kind, (magic, place) in media.SIGNATURES.items():
            if b[at + place : at + place + len(magic)] == magic and (n := media.VALIDATORS[kind](b, at, media.Marks(b))):
                own.append((-n, kind))
        if own:
            found.append((at, min(own)[1], -min(own)[0]))
    out, free = [f for f in found if f[0] == 0], 1
    for at, kind, n in found:
        if at >= free:
            out.append((at, kind, n))
            free = at + n
    return out


def test_finds_as_a_search_everywhere():
    rng, automaton = random.Random(4), media._automaton()
    for _ in range(300):
        parts = [rng.choice([rng.choice(WHOLE), rng.choice(WHOLE)[: rng.randrange(1, 40)], bytes(rng.randrange(256) for _ in range(rng.randrange(9)))]) for _ in range(rng.randrange(7))]
        data = b"".join(parts)
        assert media.find_media(data, automaton) == _plain(data)
    assert [k for _, k, _ in media.find_media(b"-".join(WHOLE), automaton)] == ["png", "gif", "jpeg", "pdf", "zip", "gzip", "wav", "bmp"]


@pytest.mark.parametrize("piece", [b"%PDF-1", b"PK\x03\x04", b"\xff\xd8\xff\xe0\x00\x02", PNG[:-12], GIF[:-1], PDF, JPEG[:-2]])
def test_hostile_bytes_take_linear_time(piece):
    automaton, took = media._automaton(), []
    for n in (40_000, 80_000):
        data = piece * (n // 4 if len(piece) > 20 else n)
        start = time.process_time()
        found = media.find_media(data, automaton)
        took.append(time.process_time() - start)
        assert sum(x[2] for x in found if x[0]) <= len(data)
    assert took[1] < 3.5 * took[0] + 0.3 and took[1] < 20


def test_media_query_sniffs_and_carves(spark, tmp_path):
    inside = PDF.decode()
    texts = [(1, "x " + inside + " y"), (2, None), (3, "x " + inside + " y"), (4, "é" * 600_000), (None, inside)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in media.op7_media(spark, f"file://{tmp_path}").collect()}
    assert got[1].feature == got[3].feature and got[1].feature.endswith(f"inside=pdf@2+{len(PDF)}:" + __import__("hashlib").sha256(PDF).hexdigest())
    assert got[2].feature.startswith("wav;corrected=1;") and got[2].feature.endswith("inside=-") and (got[4].n_bytes, got[4].payload_bytes) == (1_200_000, 1_200_000)
    assert f"pdf@0+{len(PDF)}:" in got[None].feature
    df = spark.createDataFrame([(1, bytearray(b"x"))], "embedded long, b binary")
    with pytest.raises(ValueError, match="embedded"):
        media.sniff(df, F.col("b"), F.lit("x"), ["embedded"])

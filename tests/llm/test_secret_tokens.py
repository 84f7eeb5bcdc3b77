"""Signed tokens: the same spans as by a plain pattern, in linear time; names of results are refused."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from lakeforge.llm import byte_bpe, common, secrets_scan

PLAIN = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")


def test_tokens_as_by_a_plain_pattern():
    rng, scanner = random.Random(9), secrets_scan.Scanner()
    parts = ["eyJ", "eyJ", "abcdefgh", "abcdefghijk", ".", ".", ".eyJ", " ", "é", "-_", "e", "y"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(30_000)]
    found = [[(s, e) for s, e, kind in spans if kind == "jwt"] for spans in scanner.scan(texts)]
    assert found == [[m.span() for m in PLAIN.finditer(t)] for t in texts] and sum(map(len, found)) > 100


def test_tokens_take_linear_time():
    token = "eyJabcdefghi.eyJabcdefghi.abcdefghi"
    scanner, took = secrets_scan.Scanner(), []
    for n in (100_000, 200_000):
        for text in (f"{token} " + "eyJaaaaaaaa" * n, f"{token} " + "eyJaaaaaaaa." * n, f"{token} " + "eyJaaaaaaaa.eyJ." * n):
            start = time.process_time()
            assert any(kind == "jwt" for _, _, kind in scanner.scan([text])[0])
            took.append(time.process_time() - start)
    assert sum(took[3:]) < 3.5 * sum(took[:3]) + 0.5 and sum(took) < 60


def test_names_of_results(spark):
    df = spark.createDataFrame([(1, "x", 2)], "found int, text string, token_ids int")
    with pytest.raises(ValueError, match="found"):
        secrets_scan.scan(df, F.col("text"), ["found"])
    with pytest.raises(ValueError, match="token_ids"):
        byte_bpe.encode_decode(df, F.col("text"), "nowhere", "", ["token_ids"])
    rows = spark.createDataFrame([(1, 2, 3), (4, 5, 6)], "h long, __word long, __MASK long")
    hit = common.with_hit(rows, "h", common.bloom(rows.where("h = 1").select("h")), "hit")
    assert sorted(map(tuple, hit.collect())) == [(1, 2, 3, True), (4, 5, 6, False)] and hit.columns == ["h", "__word", "__MASK", "hit"]

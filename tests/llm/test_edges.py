"""Hot groups, odd rows and bounds of the corpus operators and the pipeline, with values."""

import random

import numpy as np
import pytest
import tiktoken

import corpus_pipeline
import public_tokenizers
from lakeforge.llm import byte_bpe, decontamination, ngram_join, warc
from lakeforge.llm.queries import queries

LAST = {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids"}


def test_hostile_strings_as_tiktoken():
    tokens = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    bpe, rng = byte_bpe.ByteBPE(tokens, public_tokenizers.PATTERN), random.Random(5)
    assert bpe.quick is not None and bpe.odd("²") and not bpe.odd("año 12_'s")
    odd = "aZ9 \n\t\x1c\x1f\x85\xa0　​\xe9\xb2Ⅷ中\xf1'stſ́٣_-.<|\U0001f642᠎﻿"
    for _ in range(20_000):
        text = "".join(rng.choice(odd) for _ in range(rng.randrange(25)))
        ids = bpe.encode(text)
        assert ids == enc.encode_ordinary(text) and bpe.decode(ids) == text.encode()
    long = "ab" * 100_000
    assert bpe.decode(bpe.encode(long)) == long.encode()


def test_common_passage_links_nothing(spark):
    rng = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [passage + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(14)) for _ in range(2000)]
    texts += [passage + " x y z", passage + " x y q"]  # nearly the passage alone: linked with each other
    got = ngram_join.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 3, 90).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i for i in range(2000)} | {2000: 2000, 2001: 2000}


def test_repeated_and_null_ids(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(5, a, "x"), (5, b, "x"), (None, a, "x"), (None, "lone words here", "x"), (3, b, "x"), (3, b, "x"), (9, None, "x"), (8, "", "x")]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, component string"), 3, 90)
    want = [(5, 38, 5), (5, 38, 3), (None, 38, 5), (None, 1, None), (3, 38, 3), (3, 38, 3), (9, 0, 9), (8, 0, 8)]
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == sorted(want, key=str)


def test_archive_odd_rows(spark, tmp_path):
    big = "é" * 600
    rows = [(1, "u", big, 0), (7, "v\n", big, 0), (7, "v\n", big, 0), (None, None, big, 0), (2, "w", None, 0), (2, "w", None, 0), (3, "x", "<|" * 2_000_000, 0)]
    path = f"file://{tmp_path}/w"
    index = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string, digest int"), path)
    got = sorted([(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read(spark, path, index).collect()], key=str)
    want = [(1, 1200, "revisit", 7), (7, 1200, "response", None), (7, 1200, "response", None), (None, 1200, "revisit", 7), (2, 0, "response", None), (2, 0, "response", None), (3, 4_000_000, "response", None)]
    assert got == sorted(want, key=str)


def test_similar_windows_are_found(spark):
    rng = random.Random(11)
    items, texts = [], []
    for i in range(100):
        words = [f"i{i}w{k}" for k in range(60)]
        items.append((i, " ".join(words)))
        words[rng.randrange(5, 55)] = "changed"  # one word is in five shingles: a similarity of 51 / 61
        texts.append((i, "before it " + " ".join(words) + " after it"))
    found = decontamination.find_items(spark.createDataFrame(texts, "doc_id long, text string"), "text", spark.createDataFrame(items, "item_id long, text string"), ["doc_id"]).collect()
    assert sum([m.item_id for m in r.matches] == [r.doc_id] for r in found) >= 95


def test_pipeline_on_odd_documents(spark, tmp_path):
    copy, leak = " ".join(f"c{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, copy, "m", 1.0), (2, copy + " end", "m", 1.0), (2, "other text under a repeated id", "m", 1.0), (None, None, "m", 1.0), (4, "", None, None), (5, "x " + leak, "m", 1.0), (6, "password = hunter22x", "m", 1.0), (7, "word " * 300_000, "m", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, matches string, __toxic double")
    for name, frame in {
        "documents": docs,
        "labels": spark.createDataFrame([(1, 0), (6, 0)], "doc_id long, toxic int"),
        "benchmark": spark.createDataFrame([(1, leak), (None, None)], "item_id long, text string"),
    }.items():
        frame.write.parquet(f"file://{tmp_path}/{name}.parquet")
    got = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()
    assert set(got[0].asDict()) == LAST
    tokens = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    texts = {(r.doc_id, b"".join(tokens[i] for i in r.token_ids).decode()) for r in got}
    assert texts == {(1, copy), (2, "other text under a repeated id"), (None, ""), (4, ""), (6, "[secret]"), (7, "word " * 300_000)}
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"file://{tmp_path}/{name}.parquet").where("false").write.parquet(f"file://{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}/none").count() == 0


@pytest.mark.parametrize("name,label,least", [("op4_toxicity", "toxic", (0.92, 0.75, 0.7)), ("op10_quality", "quality", (0.97, 0.9, 0.9))])
def test_held_out_recall(spark, name, label, least):
    d = "/root/testdata/sf0.1"
    got = queries()[name](spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").toPandas()
    y, p, hit = got[label].to_numpy(), got["score"].to_numpy(), got["predicted"].to_numpy() == 1
    rank = np.empty(len(p))
    rank[np.argsort(p, kind="stable")] = np.arange(1, len(p) + 1)
    area = (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    found = (area, hit[y == 1].mean(), y[hit].mean())
    print(name, found)
    assert all(a >= b for a, b in zip(found, least, strict=True)), found


def test_remembered_words_are_not_encoded_again():
    bpe = byte_bpe.ByteBPE(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    texts = [" ".join(f"qz{chr(97 + i % 26)}{chr(97 + j)}xv" for j in range(20)) for i in range(40)]
    first = [bpe.encode(t) for t in texts]
    calls, plain = [], bpe.encode_pretoken
    bpe.encode_pretoken = lambda w: calls.append(w) or plain(w)
    assert [bpe.encode(t) for t in texts] == first and not calls
    assert isinstance(bpe.memo[" qzabxv"], bytes) and byte_bpe.WIDE_MEMO > bpe.entries
    bpe.entries, bpe.memo, bpe.last = 30, {}, {}  # too few for all, with the same ids
    assert [bpe.encode(t) for t in texts] == first and len(calls) > 26 * 20 and len(bpe.memo) <= 30 + 20

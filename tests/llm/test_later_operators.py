"""Operators 11 to 13 against plain versions, on odd rows, hot groups and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakeforge.llm import centroids, class_lm, filter_audit
from lakeforge.llm.common import held_out

# --- class-based language model


def _objective(table):
    return sum(x * math.log(x) for row in table for x in row if x) - sum(x * math.log(x) for line in (*table, *zip(*table, strict=True)) if (x := sum(line)))


def _table(bigrams, of, k):
    table = [[0] * k for _ in range(k)]
    for (a, b), n in bigrams.items():
        table[of[a]][of[b]] += n
    return table


def _plain_exchange(bigrams, m, classes, passes):
    of = [i % classes for i in range(m)]
    of[0] = classes
    for _ in range(passes):
        moved = False
        for w in range(1, m):
            def at(c, w=w):
                return _objective(_table(bigrams, of[:w] + [c] + of[w + 1 :], classes + 1))

            now = at(of[w])
            more = [round(at(c) - now, class_lm.DIGITS) for c in range(classes)]
            if max(more) > 0:
                of[w], moved = more.index(max(more)), True
        if not moved:
            break
    return of


def _texts(n=60, seed=3):
    rng = random.Random(seed)
    words = [[f"{kind}{i}" for i in range(6)] for kind in "abc"]
    return [" ".join(rng.choice(words[k % 3]).title() for k in range(rng.randrange(12))) + f" r{i % 37}" for i in range(n)]


def _plain_scores(texts, trains, core_size):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda x: x[0].lower(), t or "")) + [None] for t in texts]
    used = [d for d, train in zip(docs, trains, strict=True) if train]
    count = Counter(w for d in used for w in d)
    code = {w: xxhash.xxh3_64_intdigest(w.encode()) - (1 << 63) for w in count if w is not None}
    core = [None, *sorted(code, key=lambda w: (-count[w], code[w]))[: core_size - 1]]
    rank = {w: i for i, w in enumerate(core)}
    pairs = Counter(p for d in used for p in zip([None, *d], d, strict=False))
    own = Counter({(rank[a], rank[b]): n for (a, b), n in pairs.items() if a in rank and b in rank})
    k = class_lm.CLASSES
    of = dict(zip(core, _plain_exchange(own, len(core), k, class_lm.PASSES), strict=True))
    base = _table(own, [of[w] for w in core], k + 1)
    for w in count:
        if w not in rank:
            def joined(c, w=w):
                table = [row[:] for row in base]
                for (a, b), n in pairs.items():
                    if a == w and b in rank:
                        table[c][of[b]] += n
                    if b == w and a in rank:
                        table[of[a]][c] += n
                return _objective(table)

            more = [round(joined(c) - joined(0), class_lm.DIGITS) for c in range(k)]
            of[w] = more.index(max(more))
    z, after, seen = Counter(), Counter(), Counter()
    for w, n in count.items():
        z[of[w]] += n + 0.5
    for (a, b), n in pairs.items():
        after[of[a], of[b]] += n
        seen[of[a]] += n
    whole, n_all, v = sum(z.values()), sum(count.values()), len(count)
    out = []
    for d in docs:
        score = 0.0
        for a, b in zip([None, *d], d, strict=False):
            if b not in count:
                score += math.log10(0.5 / (whole + 0.5))
                continue
            c, before = of[b], of.get(a, -1)
            p = (after[before, c] + class_lm.PRIOR * z[c] / whole) / (seen[before] + class_lm.PRIOR) * (1 - 0.5 / (whole + 0.5))
            score += math.log10(p * (count[b] + 0.5) / z[c])
        base_score = sum(math.log10((count[w] + 0.5) / (n_all + 0.5 * (v + 1))) for w in d)
        out.append((len(d), sum(w in count for w in d), n_all, round(base_score, 6), round(score, 6)))
    return out


@pytest.mark.parametrize("core", [8, 500])
def test_class_scores_as_plain(spark, monkeypatch, core):
    monkeypatch.setattr(class_lm, "CORE", core)
    monkeypatch.setattr(class_lm, "CHUNK", 150)  # several chunks a task
    texts = [*_texts(), None, "", "\t \n", "A0 unseen \x0b a1\x0cÉ É", "a0 " * 3000]
    ids = list(range(len(texts)))
    trains = [zlib.crc32(str(i).encode()) % 5 != 1 for i in ids]
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(3)
    got = class_lm.scores(df, F.col("text"), held_out(F.col("doc_id"), 5, 1), ["doc_id"]).collect()
    found = {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got}
    assert [found[i] for i in ids] == _plain_scores(texts, trains, core)


def test_exchange_as_plain():
    rng = np.random.default_rng(1)
    b = rng.integers(0, 9, (14, 14)) * (rng.random((14, 14)) < 0.5)
    pairs = Counter({(i, j): int(b[i, j]) for i in range(14) for j in range(14) if b[i, j]})
    assert class_lm.exchange(b, 0, 3, 6).tolist() == _plain_exchange(pairs, 14, 3, 6)


def test_class_scores_probabilities_sum_to_one():
    pairs = np.random.default_rng(2).integers(0, 50, (class_lm.UNSEEN + 1,) * 2)
    pairs[:, class_lm.UNSEEN] = pairs[class_lm.UNSEEN] = 0
    distinct = np.ones(class_lm.UNSEEN + 1, np.int64)
    logs = class_lm.token_logs(pairs, distinct)
    z = pairs.sum(axis=0) + 0.5 * distinct  # a word a class: its count and 0.5 is Z
    z[class_lm.UNSEEN] = 0.5
    assert np.allclose((10.0**logs * z).sum(axis=1), 1)


def test_class_scores_odd_tables(spark):
    schema = "doc_id long, text string, words string"
    none = spark.createDataFrame([], schema)
    assert class_lm.scores(none, F.col("text"), F.lit(False), ["doc_id"]).collect() == []
    rows = spark.createDataFrame([(None, "x y", "w"), (None, "x y", "w"), (1, None, "w")], schema)
    unseen = class_lm.scores(rows, F.col("text"), F.lit(True), ["doc_id"]).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in unseen) == [(1, 0, 0, 0, 0), (3, 0, 0, 0, 0), (3, 0, 0, 0, 0)]
    twice = class_lm.scores(rows, F.col("text"), F.lit(False), ["doc_id"]).where("doc_id IS NULL").collect()
    assert len(twice) == 2 and twice[0] == twice[1] and twice[0].train_tokens == 7
    with pytest.raises(ValueError, match="words"):
        class_lm.scores(rows, F.col("text"), F.lit(False), ["words"])


def test_class_model_is_better_than_single_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", held_out(F.col("doc_id"), 5, 1).alias("held_out"))
    s, b = class_lm.scores(docs, F.col("text"), F.col("held_out"), ["held_out"]).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert s > 0.98 * b > b  # logarithms: both are negative


# --- filter audit


def _plain_audit(docs, labels):
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    rows = []
    for i, text, lang in docs:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        copy = i is not None and any(j is not None and j < i and (u or "") == text for j, u, _ in docs)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": copy}
        rows.append((lang or "", {c for c, f in fails.items() if f}, i in good, i in toxic))
    out, sums = {}, Counter()
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for k, c in enumerate(order, 1):
                gone = [r for r in left if c in r[1]]
                left = [r for r in left if c not in r[1]]
                sums[part, c] += len(gone)
                out[part, order, k] = [len(left), len(gone), sum(c in r[1] for r in own) - len(gone), sum(r[1] == {c} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)]
    return {k: (*v, sums[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_as_plain(spark):
    long, copy = " ".join(f"w{i}" for i in range(60_000)), " ".join(f"c{i}" for i in range(210))
    docs = [(1, copy, "en"), (2, copy, "de"), (2, copy, "de"), (None, copy, "en"), (None, copy, None), (3, None, "en"), (4, "", ""), (5, "\x0b \t", None), (6, long, "en"), (7, long + " #", "de"), (8, "Ä A\x0bB " * 80, "xx"), (9, copy + " " + "é\U0001f642" * 9, "en")]
    docs += [(100 + i, "same words again and again", "hot") for i in range(300)]
    labels = [(1, 1, 0), (2, None, 1), (2, 1, None), (None, 1, 1), (6, 0, 0), (101, 1, 1), (101, 0, 0), (99, 1, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("part", F.lit("own"))
    rows = filter_audit.audit(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    got = {(r.part, r.filter_order, r.step): tuple(r)[4:] for r in rows if not r.whole}
    assert got == _plain_audit(docs, labels)
    together = {(r.filter_order, r.step): tuple(r)[4:] for r in rows if r.whole}
    assert together == {k[1:]: v for k, v in _plain_audit([(i, t, "") for i, t, _ in docs], labels).items()}


def test_audit_of_nothing(spark):
    assert filter_audit.audit(spark.createDataFrame([], "doc_id long, text string, lang string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


# --- centroids


def _plain_clusters(rows, k, rounds, size=3):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    now = [v for _, _, v in sorted(((i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "", v) for i, v in kept))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(now))

    for _ in range(rounds):
        own = [[] for _ in now]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        now = [[sum(x) // len(o) for x in zip(*o, strict=True)] if o else c for o, c in zip(own, now, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, c in found:
        inertia[c] += d
    return [(i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, now[c])).encode()).hexdigest()) for i, d, c in found]


@pytest.mark.parametrize("spread", [0.01, 1.0, 200_000.0])
def test_clusters_as_plain(spark, spread):
    rng = random.Random(7)
    rows = [(i, [rng.choice((-1, 1)) * rng.random() * spread for _ in range(3)]) for i in range(900)]
    rows += [(1000 + i, [0.5 * spread, 0.25, -0.125]) for i in range(500)]  # one vector, a third of all
    rows += [(None, [0.1, 0.2, 0.3]), (3, [0.3, 0.2, 0.1]), (3, [0.3, 0.2, 0.1]), (1, None), (2, [1.0]), (4, [0.0, None, 0.0]), (5, [0.0, math.nan, 0.0]), (6, [math.inf, 0.0, 0.0]), (7, [])]
    df = spark.createDataFrame([(v, "x", i) for i, v in rows], "embedding array<double>, cluster string, vec_id long").repartition(3)
    got = centroids.cluster(df, size=3, k=9, rounds=4).collect()
    assert sorted(map(tuple, got), key=str) == sorted(_plain_clusters(rows, 9, 4), key=str)


def test_clusters_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert centroids.cluster(spark.createDataFrame([], schema)).count() == 0
    few = centroids.cluster(spark.createDataFrame([(1, [0.5] * 64), (2, [-0.5] * 64)], schema)).collect()
    assert sorted((r.vec_id, r.distance, r.inertia) for r in few) == [(1, 0, 0), (2, 0, 0)] and {r.cluster for r in few} == {0, 1}
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64)], schema)).count()


def test_balls_are_taken_whole():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.integers(-20, 20, (4000, 8)) + 5000 * k for k in range(3)])
    tree = centroids.BallTree(points)
    near = np.array([[0] * 8, [5000] * 8, [10_000] * 8])
    taken = [(tree.spans[n][1] - tree.spans[n][0], owner is None) for n, _, owner in tree.walk(near)]
    assert sum(size for size, _ in taken) == 12_000 and all(whole for size, whole in taken if size > centroids.LEAF) and len(taken) < 200

"""Rules, ingestion, dimensional models, privacy, specs and extraction on small data."""

import json

import pytest
from pyspark.sql import functions as F

from lakeforge import dimensional, incremental, plans
from lakeforge.ingestion import Run, ingest
from lakeforge.operators import privacy, rules
from lakeforge.plans import products, specs
from lakeforge.store import ConcurrentCommit, TableStore


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, f"file://{tmp_path}/tables")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _documents(spark, *docs):
    return spark.createDataFrame([(f"r{i}", d if isinstance(d, str | None) else json.dumps(d)) for i, d in enumerate(docs)], "rule_id string, constraint string")


def test_problems_of_rules(spark):
    bad = {
        None: "no constraint", "[": "not JSON", "{}": "no type", '{"type": "not_null"}': "no kwargs", '{"type": "odd", "kwargs": {}}': "unknown type odd", '{"type": "not_null", "kwargs": {}}': "no column",
        '{"type": "unique", "kwargs": {"columns": "a"}}': "columns is no list", '{"type": "unique", "kwargs": {"columns": ["a", "z"]}}': "unknown column z", '{"type": "in_set", "kwargs": {"column": "a", "values": []}}': "values is no list",
        '{"type": "compare", "kwargs": {"left": "a", "op": "~", "right": "b"}}': "unknown operator ~", '{"type": "between", "kwargs": {"column": "a"}}': "no min or max", '{"type": "between", "kwargs": {"column": "a", "max": "x"}}': "max is no number",
    }
    checked = rules.check(_documents(spark, *bad, {"type": "not_null", "kwargs": {"column": "a"}, "meta": {"by": "me"}}), ["a", "b"])
    got = {r.rule_id: r.problem for r in checked.collect()}
    assert got == {f"r{i}": p for i, p in enumerate(bad.values())} | {f"r{len(bad)}": None}
    (rule,) = rules.compiled(checked)
    assert (rule.kind, rule.mostly) == ("not_null", 1.0)
    with pytest.raises(ValueError, match="unique"):
        rules.compiled(checked.unionByName(checked))
    with pytest.raises(ValueError, match="regular expression"):
        rules.compiled(rules.check(_documents(spark, {"type": "matches", "kwargs": {"column": "a", "pattern": "("}}), ["a"]))


def test_flags_and_nulls(spark):
    df = spark.createDataFrame([(1, "ab", 2), (1, None, 1), (None, "x", None), (None, "abc", 9)], "a int, s string, b int")
    found = rules.compiled(rules.check(_documents(
        spark, {"type": "not_null", "kwargs": {"column": "a"}}, {"type": "between", "kwargs": {"column": "b", "min": 1.5, "max": 8}}, {"type": "in_set", "kwargs": {"column": "a", "values": [1, 2]}},
        {"type": "matches", "kwargs": {"column": "s", "pattern": "^a"}}, {"type": "length_between", "kwargs": {"column": "s", "min": 2}}, {"type": "compare", "kwargs": {"left": "a", "op": "<", "right": "b"}},
        {"type": "unique", "kwargs": {"columns": ["a"]}},
    ), df.columns))
    got = {(r.a, r.s, r.b): tuple(r[f"dq_r{i}"] for i in range(7)) for r in rules.flags(df, found).collect()}
    assert got == {(1, "ab", 2): (1, 1, 1, 1, 1, 1, 0), (1, None, 1): (1, 0, 1, 1, 1, 0, 0), (None, "x", None): (0, 1, 1, 0, 0, 1, 0), (None, "abc", 9): (0, 0, 1, 1, 1, 1, 0)}
    assert {(r.rule_id, r.n_broken) for r in rules.results(df, found).collect()} == {("r0", 2), ("r1", 2), ("r2", 0), ("r3", 1), ("r4", 1), ("r5", 1), ("r6", 4)}
    assert rules.results(df, []).count() == 0


def test_ingestion_flow(spark, store):
    df = spark.createDataFrame([(1, 5), (2, 50), (3, 7), (3, 8), (4, 9)], "k int, v int")
    found = rules.compiled(rules.check(_documents(spark, {"type": "between", "kwargs": {"column": "v", "max": 10}}), df.columns))
    for _ in range(2):  # the same run again changes nothing
        m = ingest(store, "t", df, ["k"], "merge", Run("e1"), duplicates="quarantine_all", rules=found, most_broken=0.4)
        assert (m.sourceDataCount, m.duplicates, m.broken, m.success, m.inserts, m.error) == (5, 2, 1, True, 2, "")
    assert _rows(store.read("t")) == [(1, 5), (4, 9)]
    assert {(r.k, r.Quarantine_Type, *r.dq_broken) for r in store.read("t_quarantined").collect()} == {(2, "Expectation", "r0"), (3, "Duplicate")} and store.read("t_quarantined").count() == 3
    assert {(r.quarantine_type, r.total_rows, r.primary_key_list) for r in store.read("quarantine_log").collect()} == {("Duplicate", 2, "k"), ("Expectation", 1, "k")}
    shut = ingest(store, "u", df, ["k"], "merge", Run("e2"), rules=found, most_broken=0.1, quarantine="merge")
    assert (shut.success, shut.version, shut.broken) == (False, None, 1) and not store.exists("u") and store.read("u_quarantined").count() == 1
    with pytest.raises(Exception, match="several source rows"):
        ingest(store, "t", df, ["k"], "merge", Run("e3"))
    with pytest.raises(ValueError, match="quarantine"):
        ingest(store, "t", df, ["k"], "merge", Run("e3"), quarantine="away")
    empty = ingest(store, "n", df.where("false"), ["k"], "merge", Run("e4"), rules=found)
    assert empty.success and store.read("n").count() == 0


def test_identities(spark):
    df = spark.range(5000).select(F.when(F.col("id") != 9, F.col("id") * 37 % 5003).alias("k"), F.concat(F.lit("n"), F.lpad((F.col("id") % 4999).cast("string"), 5, "0")).alias("s"))
    for order in (["k"], ["s", "k"]):
        got = plans.with_identity(df, "n", order, 100).orderBy("n").collect()
        assert [r["n"] for r in got] == list(range(101, 5101))
        want = df.orderBy(*order).collect()
        assert [(r.k, r.s) for r in got] == [(r.k, r.s) for r in want]
    assert plans.with_identity(df.where("false"), "n", ["k"]).count() == 0


def test_star_and_dates(spark):
    fact = spark.createDataFrame([(1, " A ", "2024-02-29"), (2, "b", "2024-03-09"), (3, None, None)], "id int, c string, d string")
    dim = spark.createDataFrame([("a", 10), ("B", 20), (None, 30)], "code string, key int")
    look = dimensional.Lookup("dim", dim, {"code": "c"}, {"dim_key": "key"}, normalized=True)
    dates = dimensional.date_dimension(spark, "2024-02-28", "2024-03-01")
    got = dimensional.with_dates(dimensional.star(fact, [look]), dates, {"day": F.col("d")}, ["date_key", "quarter"])
    assert _rows(got.select("id", "dim_key", "day_date_key", "day_quarter")) == [(1, 10, 20240229, 1), (2, 20, -1, None), (3, -1, -1, None)]
    with pytest.raises(Exception, match="several rows"):
        dimensional.star(fact, [dimensional.Lookup("dim", dim.unionByName(dim), {"code": "c"}, {"dim_key": "key"}, normalized=True)]).collect()
    with pytest.raises(ValueError):
        dimensional.date_dimension(spark, "2024-01-02", "2024-01-01")
    assert dates.count() == 3


def test_models_and_cubes(spark):
    model = dimensional.Model()
    model.table("b", ["a"])(lambda own, a: a.where("id > 0"))
    model.table("a")(lambda own: own.range(3))
    assert model.groups() == [["a"], ["b"]] and model.build(spark)["b"].count() == 2
    model.table("a", ["b"])(lambda own, b: b)
    with pytest.raises(ValueError, match="each other"):
        model.groups()
    df = spark.createDataFrame([("x", None, 1), ("x", "p", 2), ("y", None, 4)], "a string, b string, v int")
    got = {(r.a, r.b, r.grouping_id): (r.total, r.chosen) for r in dimensional.cube(df, ["a", "b"], {"total": F.sum("v")}).collect()}
    assert got[("x", None, 0)] == (1, "a,b") and got[("x", None, 1)] == (3, "a") and got[(None, None, 2)] == (5, "b") and got[(None, None, 3)] == (7, "")
    with pytest.raises(ValueError):
        dimensional.cube(df, [], {"n": F.count("*")})


def test_privacy(spark):
    df = spark.createDataFrame([("ada@x.org", 5, "s"), (None, None, None), ("é", 7, "")], "mail string, n int, t string")
    keys = {"k1": b"0123456789abcdef", "k2": b"fedcba9876543210"}
    kept = privacy.protect(df, {"mail": privacy.Policy("mask"), "n": privacy.Policy("null"), "t": privacy.Policy("hash", key_id="k1")}, keys)
    assert kept.schema["n"].dataType == df.schema["n"].dataType
    assert [(r.mail, r.n) for r in kept.collect()] == [("*****.org", None), (None, None), ("*", None)] and kept.where("t IS NULL").count() == 1
    locked = privacy.protect(df, {c: privacy.Policy("encrypt", key_id="k1") for c in df.columns}, keys)
    assert _rows(privacy.reveal(locked, {"mail": "string", "n": "int", "t": "string"}, keys)) == _rows(df)
    assert _rows(privacy.reveal(locked, {"mail": "string"}, {"k1": keys["k2"]}).select("mail")) == [(None,)] * 3
    assert _rows(privacy.reveal(locked, {"mail": "string"}, {"k2": keys["k2"]}).select("mail")) == [(None,)] * 3
    moved = locked.withColumn("t", F.col("mail"))  # a cipher is bound to its column
    assert _rows(privacy.reveal(moved, {"t": "string"}, keys).select("t")) == [(None,)] * 3
    assert _rows(privacy.reveal(df, {"mail": "string"}, keys).select("mail")) == [(None,)] * 3
    config = {"global_configuration": [{"config_name": "data_privacy_mode", "enable": True}]}
    assert privacy.sensitive(df, ["n"], config, "k1", lambda k: keys[k]).where("n LIKE 'k1:%'").count() == 2
    assert privacy.sensitive(df, ["n"], {}, "k1", keys).where("n IS NOT NULL").count() == 0
    for bad in (lambda: privacy.Policy("hide"), lambda: privacy.Policy("hash"), lambda: privacy.protect(df, {"z": privacy.Policy("null")}), lambda: privacy.protect(df, {"t": privacy.Policy("hash", key_id="k")}, {"k": b"short"})):
        with pytest.raises(ValueError):
            bad()


def test_relations_and_rewriting(spark):
    sql = "WITH t AS (SELECT * FROM a.b.t WHERE x = 'a.b.c') /* a.b.d */ SELECT * FROM t JOIN a.`b`.c ON c.k = t.k WHERE EXISTS (SELECT 1 FROM A.b.t u) AND k > (SELECT max(k) FROM (SELECT * FROM a.z.c))"
    assert [r.parts for r in specs.relations(spark, sql)] == [("a", "b", "t"), ("a", "b", "c"), ("A", "b", "t"), ("a", "z", "c")]
    assert [(s["name"], s["schema"]) for s in specs.sources_of(spark, [{"name": "q", "sql": sql}])] == [("b_t", "b"), ("b_c", "b"), ("z_c", "z")]
    made = specs.spec_of(spark, {"table": "x"}, [{"name": "q", "sql": sql}])["query"][0]["sql"]
    assert made == "WITH t AS (SELECT * FROM b_t AS `t` WHERE x = 'a.b.c') /* a.b.d */ SELECT * FROM t JOIN b_c AS `c` ON c.k = t.k WHERE EXISTS (SELECT 1 FROM b_t u) AND k > (SELECT max(k) FROM (SELECT * FROM z_c AS `c`))"
    target = {"lakehouse": "l", "schema": "s", "table": "t", "load_strategy": "merge", "key_columns": ["k"]}
    assert specs.problems(spark, {"target": target, "query": [{"name": "q", "sql": "SELECT 1 AS k"}]}) == []
    found = specs.problems(spark, {"target": {**target, "key_columns": [], "table": ""}, "source": [{"name": "q", "lakehouse": "l", "schema": "s"}], "query": [{"name": "q", "sql": "SELEC 1"}, {"name": "r", "sql": "SELECT * FROM nowhere"}, {"name": "z"}]})
    assert [p.split(":")[0] for p in found] == ["target", "target", "source q", "query q", "query r", "query z", "name q stands for several sources or queries"]


def test_products(spark, store):
    def spec(**target):
        return {
            "target": {"lakehouse": "l", "schema": "s", "table": "d", "key_columns": ["k"], "identity": True, "unknown_record": True, "pii_columns": ["v"], **target},
            "source": [{"name": "x", "lakehouse": "l", "schema": "r", "table": "x", "incremental": True}], "query": [{"name": "q", "sql": "SELECT k, v, 1 AS spare FROM x", "drop": ["spare"]}],
        }

    store.load("l.r.x", "append", spark.createDataFrame([(5, "a"), (3, "b")], "k int, v string"), ["k"])
    made = products.run_product(spark, spec(load_strategy="merge"), store)
    assert made.safe_columns == ["k", "d_key"] and _rows(store.read("l.s.d")) == [(3, "b", 1), (5, "a", 2), (None, "unknown", -1)]
    store.load("l.r.x", "merge", spark.createDataFrame([(5, "A"), (4, "c")], "k int, v string"), ["k"])
    products.run_product(spark, spec(load_strategy="merge"), store)
    assert _rows(store.read("l.s.d")) == [(3, "b", 1), (4, "c", 3), (5, "A", 2), (None, "unknown", -1)]
    assert products.run_product(spark, spec(load_strategy="merge"), store).version is None
    with pytest.raises(ValueError, match="key_columns"):
        products.run_product(spark, spec(load_strategy="merge", key_columns=[]), store)


def test_split_predicates(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 != 1, F.col("id") * 7919 % 10_007).alias("k"), F.expr("timestamp_seconds(id * 977)").alias("t"), F.lit("o'x").alias("s"))
    for column, parts in (("k", 8), ("t", 5), ("s", 3)):
        found = incremental.split_predicates(df, column, parts)
        n = {r.part: r["count"] for r in incremental.extract_parts(df, found).groupBy("part").count().collect()}
        assert sum(n.values()) == 10_000 and sum(df.where(p).count() for p in found) == 10_000
        if column != "s":
            cut = [n[i] for i, p in enumerate(found) if "NULL" not in p and "= 7" not in p]
            assert max(cut) <= 2 * sum(cut) / len(cut) and len(found) <= parts
    assert incremental.split_predicates(df.where("false"), "k", 4) == ["`k` IS NOT NULL"]


def test_retries():
    tries = []

    def busy():
        tries.append(1)
        if len(tries) < 3:
            raise RuntimeError("HTTP 429 Too Many Requests")
        return "done"

    assert plans.run_groups([[busy], [lambda: 1]], retries=3) == [["done"], [1]]
    tries.clear()
    with pytest.raises(ZeroDivisionError):
        plans.run_groups([[lambda: tries.append(1) or 1 / 0]], retries=3)
    assert len(tries) == 1 and plans.is_transient(ConcurrentCommit("x"))
    with pytest.raises(ValueError):
        plans.run_groups([[]])


def test_blocks_carry_values(spark):
    from lakeforge.operators import temporal

    rows = [(None if i % 7 == 0 else i % 3, i // 5, i % 4 == 0, i) for i in range(400)] + [(1, None, True, 999), (9, 3, False, 1000)]
    df = spark.createDataFrame(rows, "k int, t int, good boolean, id int")
    for blocks in (2, 9):
        got = temporal.as_of_within(df, "k", "t", F.col("good"), "id", "last", blocks=blocks)
        assert _rows(got) == _rows(temporal.as_of_within(df, "k", "t", F.col("good"), "id", "last"))
        assert _rows(temporal.versions(df, "k", "t", "id", blocks)) == _rows(temporal.versions(df, "k", "t", "id"))


def test_hot_keys_are_spread(spark):
    from lakeforge.operators import temporal, windows

    df = spark.range(30_000).select(F.lit(1).alias("k"), F.col("id").alias("t"), (F.col("id") % 10 == 0).alias("good"), "id")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = temporal.as_of_within(df, "k", "t", F.col("good"), "id", "last", blocks=32)
        sizes = [r[1] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 20_000 and sum(sizes) == 30_000
        marked = windows.mark_duplicates(df, ["k"], "quarantine_all", salts=16)
        assert marked.where("is_quarantined = 1").count() == 30_000 and windows.mark_duplicates(df, ["id"], "quarantine_all", salts=4).where("is_quarantined = 1").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)

"""Tables, loads, transforms, extracts and streams on small data."""

import pytest

from lakeforge import functions as X
from lakeforge import incremental, plans, sources, streaming
from lakeforge.operators import governance, loads, quality
from lakeforge.store import ConcurrentCommit, TableStore


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, f"file://{tmp_path}/tables")


def test_store_versions(spark, store):
    assert not store.exists("t")
    assert store.commit("t", spark.range(3), "overwrite") == 0
    assert store.commit("t", spark.range(5), "append", batch_id="b") == 1
    assert store.commit("t", spark.range(9), "append", batch_id="b") == 1  # a replay
    assert store.restore("t", 0) == 2
    assert (store.read("t").count(), store.read("t", 1).count()) == (3, 5)
    assert [tuple(r) for r in store.history("t").orderBy("version").select("version", "operation", "rows").collect()] == [(0, "overwrite", 3), (1, "append", 5), (2, "restore", 3)]
    with pytest.raises(ConcurrentCommit):
        store._commit("t", {"version": 2})
    with pytest.raises(ValueError):
        store.read("t", 9)


def test_spec(spark, store):
    store.commit("raw", spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), "overwrite")
    spec = {"target": "out", "load": "overwrite_by_key", "keys": ["k"], "sources": [{"table": "raw"}], "queries": [{"name": "x", "sql": "SELECT k, upper(v) AS v FROM raw"}, {"name": "y", "sql": "SELECT * FROM x WHERE k > 1"}]}
    plans.run_spec(spark, spec, store)
    store.commit("raw", spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), "overwrite")
    plans.run_spec(spark, spec, store)
    assert sorted(map(tuple, store.read("out").collect())) == [(2, "C"), (3, "D")]
    assert plans.run_groups([[lambda: 1, lambda: 2], [lambda: 3]]) == [[1, 2], [3]]


def test_stream_load_is_replayable(spark, store, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").coalesce(1).write.parquet(f"file://{tmp_path}/in")
    for _ in range(2):
        stream = sources.read_stream(spark, "parquet", f"file://{tmp_path}/in", "k int, v string")
        streaming.start(stream, store, "s", "append_new", ["k"], f"file://{tmp_path}/cp").awaitTermination()
        spark.createDataFrame([(2, "x"), (3, "c")], "k int, v string").coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    assert sorted(map(tuple, store.read("s").collect())) == [(1, "a"), (2, "b"), (3, "c")]
    with pytest.raises(ValueError):
        streaming.trigger("sometimes")


def test_guarded_merge_nulls(spark):
    t = spark.createDataFrame([(1, "h1", "a"), (2, None, "b"), (None, "h", "c")], "k int, dl_rowhash string, v string")
    s = spark.createDataFrame([(1, "h2", "x"), (2, "h9", "y"), (None, "h8", "z"), (None, "h7", "w")], "k int, dl_rowhash string, v string")
    got = sorted((str(r.k), r.v, r.dl_action) for r in loads.merge_guarded(t, s, ["k"]).collect())
    assert got == [("1", "x", "U"), ("2", "b", "K"), ("None", "c", "K"), ("None", "w", "I"), ("None", "z", "I")]
    safe = loads.merge_guarded(t, s.where("v <> 'w'"), ["k"], null_safe=True)
    assert sorted((str(r.k), r.v, r.dl_action) for r in safe.collect()) == [("1", "x", "U"), ("2", "b", "K"), ("None", "z", "U")]


def test_scd2_replay_adds_nothing(spark):
    from pyspark.sql import functions as F

    t = spark.createDataFrame([(1, "a", None, None, 1)], "k int, v string, active_start timestamp, active_end timestamp, is_current int")
    s = spark.createDataFrame([(1, "b"), (2, None)], "k int, v string")
    once = loads.scd2(t, s, ["k"], ["v"], F.lit("2024-01-01").cast("timestamp"))
    assert sorted((r.k, str(r.v), r.is_current) for r in once.collect()) == [(1, "a", 0), (1, "b", 1), (2, "None", 1)]
    assert loads.scd2(once, s, ["k"], ["v"], F.lit("2025-01-01").cast("timestamp")).count() == 3


def test_extracts(spark):
    config = {"table": "t", "ingestType": "watermark", "sourceWatermarkIdentifier": "u", "filterExpression": "And Name = 'X'"}
    assert incremental.next_query(config) == "SELECT * FROM t WHERE u > CAST('1900-01-01T00:00:00Z' AS timestamp) AND (Name = 'X')"
    assert "'5'" in incremental.next_query(config, {"identifier": "u", "value": "5"})
    assert "1900" in incremental.next_query(config, {"identifier": "other", "value": "5"})
    state = incremental.advance(spark.range(4), "id")
    assert state == {"identifier": "id", "value": "3"}
    assert incremental.advance(spark.range(0), "id", state) == state


def test_sources_and_functions(spark, tmp_path):
    df = spark.createDataFrame([("a|b", "2024-01-02"), ("x", "02/01/2024"), (None, "bad")], "s string, t string")
    assert sources.write(df, f"file://{tmp_path}/c", "csv", header="true")
    assert not sources.write(df.limit(0), f"file://{tmp_path}/none", skip_empty=True)
    back = sources.read(spark, "csv", f"file://{tmp_path}/c", {"header": "true"}, columns=["upper(s) AS s"])
    assert sorted(str(r.s) for r in back.collect()) == ["A|B", "None", "X"]
    assert sources.read_whole(spark, f"file://{tmp_path}/c/*.csv").count() >= 1
    parsed = df.select(X.parse_timestamp(df.t, ["yyyy-MM-dd", "dd/MM/yyyy"]).cast("date").cast("string").alias("d"))
    assert [r.d for r in parsed.collect()] == ["2024-01-02", "2024-01-02", None]
    assert df.select(X.row_hash(["s", "t"])).distinct().count() == 3
    assert X.source_type("decimal(10,2)") == "decimal(10,2)" and X.source_type("nvarchar(max)") == "string"
    assert sources.cluster_columns(["a", "b", "c", "d"], "w") == (["w", "a", "b", "c"], ["d"])
    with pytest.raises(ValueError):
        sources.read(spark, "tape", "x")


def test_quality_and_roles(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1,), (5,), (None,)], "v int")
    good, bad = quality.split_by_rules(df, {"low": F.col("v") < 3})
    assert (good.count(), bad.count(), quality.unified(good, bad).count()) == (1, 2, 3)
    assert [quality.row_count_verdict(*a) for a in ((0, None), (5, 2), (5, 4))] == ["error", "warning", "ok"]
    old = spark.createDataFrame([("a", ["x"]), ("b", ["y"])], "table_name string, columns array<string>")
    new = spark.createDataFrame([("a", ["x", "z"]), ("c", ["y"])], "table_name string, columns array<string>")
    assert sorted(map(tuple, governance.role_changes(old, new).collect())) == [("a", "changed"), ("b", "removed"), ("c", "new")]

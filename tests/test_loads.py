"""Loads, stores and audit rows on small fixtures: nulls, replays, two writers, log positions."""

import pytest
from pyspark.sql import functions as F

from lakeforge import incremental
from lakeforge.operators import audit, loads, quality, temporal
from lakeforge.store import ConcurrentCommit, TableStore


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, f"file://{tmp_path}/tables")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("name", ["append_new", "overwrite_by_key", "merge"])
def test_replays_with_null_keys_add_nothing(spark, name):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(1, "b"), (None, "c")], "k int, v string")
    once = loads.load(name, t, s, ["k"])
    assert _rows(once) == _rows(loads.load(name, once, s, ["k"]))
    assert once.count() == 2


def test_scd2_null_keys_and_repeats(spark):
    t = spark.createDataFrame([], "k int, v string, active_start timestamp, active_end timestamp, is_current int")
    s = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    now = F.lit("2024-01-01").cast("timestamp")
    once = loads.scd2(t, s, ["k"], ["v"], now)
    assert once.count() == 2 and loads.scd2(once, s, ["k"], ["v"], now).count() == 2
    with pytest.raises(Exception, match="several source rows"):
        loads.scd2(t, s.unionByName(s), ["k"], ["v"], now).collect()


def test_merge_evolves_and_guards(spark):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, own string")
    s = spark.createDataFrame([(1, "a", 7), (3, "c", 8)], "k int, v string, more int")
    assert _rows(loads.load("merge", t, s, ["k"])) == [(1, "a", "x", 7), (2, "b", "y", None), (3, "c", None, 8)]
    assert _rows(loads.load("merge", t, s, ["k"], changed=["v"])) == [(1, "a", "x", None), (2, "b", "y", None), (3, "c", None, 8)]


def test_deletions_ignore_null_keys_on_both_sides(spark):
    t, s = spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([(1,), (None,)], "k int")
    assert _rows(loads.capture_deletions(t, s, ["k"])) == [(2,)]


def test_two_writers(spark, store):
    store.commit("t", spark.range(1), "overwrite")
    base = store.newest("t")
    store.commit("t", spark.range(2), "overwrite", base=base)
    with pytest.raises(ConcurrentCommit):
        store.commit("t", spark.range(3), "overwrite", base=base)
    assert store.read("t").count() == 2


def test_append_writes_new_rows_only(spark, store):
    store.load("t", "append", spark.range(3), ["id"])
    store.load("t", "append_new", spark.range(5), ["id"])
    first, second = store._entry("t", 0)["data"], store._entry("t", 1)["data"]
    assert second[:1] == first and len(second) == 2
    assert spark.read.parquet(f"{store.root}/t/data/{second[1]}").count() == 2
    assert (store.read("t").count(), store.read("t", 0).count()) == (5, 3)
    store.load("t", "overwrite", spark.range(1), ["id"], partition_by=None)
    assert store.vacuum("t", 1) == 2 and store.read("t").count() == 1


def test_log_positions(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x10"),), (bytearray(b"\x00\x02"),)], "lsn binary")
    state = incremental.advance(df, "lsn")
    assert state["value"] == "0x0010"
    config = {"table": "t", "ingestType": "cdc", "sourceWatermarkIdentifier": "lsn", "top": 5}
    assert incremental.next_query(config, state) == "SELECT TOP(5) * FROM t WHERE lsn > 0x0010"
    with pytest.raises(ValueError):
        incremental.next_query(config, {"identifier": "lsn", "value": "0x0 OR 1 = 1"})
    assert "0x0010" in incremental.net_change_query("c", ["k"], "lsn", "0x0010", 3) and incremental.needs_state({"sourceType": "database", "ingestType": "cdc", "dynamicQuery": True})


def test_as_of_ties(spark):
    left = spark.createDataFrame([(1, 5)], "k int, t int")
    right = spark.createDataFrame([(1, 3, "a"), (1, 3, "b")], "k int, rt int, v string")
    assert temporal.as_of(left, right, "k", "t", "rt", "v", "got").collect()[0]["got"] == "b"


def test_audit_and_gate(spark):
    log = spark.createDataFrame([(1, "done"), (None, "done")], "etl_id int, status string")
    expected = spark.createDataFrame([(1,), (2,), (2,), (None,)], "etl_id int")
    full = audit.pending_entries(expected, log, ["etl_id"])
    assert _rows(audit.entries(full, "pending").select("etl_id")) == [(2,)]
    seen = spark.createDataFrame([(2, "done"), (9, "done")], "etl_id int, status string")
    assert audit.entries(audit.merge_status(full, seen, ["etl_id"]), "pending").count() == 0
    events = spark.createDataFrame([(1, '{"status":"done","size":"4","zone":"raw"}'), (1, '{"status":"failed","size":"x","zone":"raw"}'), (1, "broken"), (1, None)], "id int, m string")
    (row,) = audit.fold_events(events, ["id"], "m").collect()
    assert (row.zone, row.bytes, row.n_events, row.status, row.started) == ("raw", 4, 2, "failed", None)
    df = spark.createDataFrame([(1,), (5,), (None,)], "v int")
    good, bad, ok = quality.gate(df, {"low": F.col("v") < 3}, 0.5)
    assert (good.count(), bad.count(), ok) == (1, 2, False)
    assert quality.quarantine_log(df.where("v > 9"), ["v"], "t", "k", "r").count() == 0

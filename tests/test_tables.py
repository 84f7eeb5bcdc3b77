"""Stored tables: touched files, two writers, types, replays, changes, layouts, crashes."""

import threading

import pytest
from pyspark.sql import functions as F

from lakeforge.operators import layout, loads
from lakeforge.store import ConcurrentCommit, Marks, TableStore, incremental


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, f"file://{tmp_path}/tables")


def _files(store, name, version=None):
    return {f"{p}/{f}" for p, own in store._entry(name, version)["files"].items() for f in own}


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_merge_rewrites_touched_files_only(spark, store):
    store.load("t", "overwrite", spark.range(8000).withColumn("v", F.lit("a")), ["id"], cluster_by=["id"])
    before = _files(store, "t")
    batch = spark.createDataFrame([(5, "b"), (9000, "c"), (None, "d")], "id long, v string")
    store.load("t", "merge", batch, ["id"])
    after, entry = _files(store, "t"), store._entry("t")
    assert len(before) >= 4 and len(before - after) == 1 and len(after - before) >= 1
    assert store.read("t").count() == entry["rows"] == 8002
    assert _rows(store.read("t").where("v <> 'a'")) == [(5, "b"), (9000, "c"), (None, "d")]
    written = store.history("t").where("version = 1").first()["metrics"]
    assert (written["inserted"], written["updated"], written["deleted"], written["files_removed"]) == (2, 1, 0, 1)
    whole = sum(x["bytes"] for own in store._entry("t", 0)["files"].values() for x in own.values())
    assert written["bytes"] < whole / 2
    store.load("t", "merge", batch, ["id"], changed=["v"])
    assert store.read("t").count() == 8002 and store.history("t").where("version = 2").first()["metrics"]["updated"] == 0


@pytest.mark.parametrize("strategy,options", [("overwrite_by_key", {}), ("update_matched", {}), ("merge", {"changed": ["v"]})])
def test_touched_files_as_whole_tables(spark, store, strategy, options):
    target = spark.range(100).select(F.when(F.col("id") != 7, F.col("id")).alias("k"), F.lit("a").alias("v"), (F.col("id") % 3).alias("w"))
    batch = spark.createDataFrame([(3, "x"), (250, "y"), (None, "z")], "k long, v string")
    store.load("t", "overwrite", target, ["k"], cluster_by=["k"])
    store.load("t", strategy, batch, ["k"], **options)
    assert _rows(store.read("t")) == _rows(loads.load(strategy, target, batch, ["k"], **options))


def test_new_columns_and_types(spark, store):
    store.load("t", "overwrite", spark.createDataFrame([(1, "001"), (2, "002")], "k int, p string"), ["k"], partition_by=["p"])
    assert dict(store.read("t").dtypes)["p"] == "string" and _rows(store.read("t")) == [(1, "001"), (2, "002")]
    store.load("t", "merge", spark.createDataFrame([(2, "003", 1.5)], "k int, p string, more double"), ["k"], partition_by=["p"])
    assert _rows(store.read("t")) == [(1, "001", None), (2, "003", 1.5)]
    store.load("t", "append", spark.createDataFrame([(9,)], "k long"), ["k"])
    assert _rows(store.read("t")) == [(1, "001", None), (2, "003", 1.5), (9, None, None)] and dict(store.read("t").dtypes)["k"] == "int"
    store.load("e", "overwrite", spark.createDataFrame([], "k int, p string"), ["k"], partition_by=["p"])
    assert store.read("e").count() == 0 and store.read("e").columns == ["k", "p"]
    store.load("e", "merge", spark.createDataFrame([(1, "007")], "k int, p string"), ["k"])
    assert _rows(store.read("e")) == [(1, "007")]


def test_two_writers_lose_nothing(spark, store):
    errors = []

    def write(who):
        try:
            for i in range(20):
                TableStore(spark, store.root).load("t", "append", spark.createDataFrame([(who * 100 + i,)], "k long").coalesce(1), ["k"], batch_id=f"w{who}#{i}")
        except Exception as e:
            errors.append(e)

    both = [threading.Thread(target=write, args=(w,)) for w in (1, 2)]
    for t in both:
        t.start()
    for t in both:
        t.join()
    assert not errors
    assert sorted(r[0] for r in store.read("t").collect()) == [w * 100 + i for w in (1, 2) for i in range(20)]
    assert store.versions("t") == list(range(40))


def test_loads_are_planned_again(spark, store, monkeypatch):
    store.load("t", "overwrite", spark.createDataFrame([(1, "a")], "k int, v string"), ["k"])
    plain, left = TableStore._load_touched, [1]

    def slow(self, name, base, *rest):
        if left:
            left.pop()
            TableStore(spark, store.root).load("t", "append", spark.createDataFrame([(2, "b")], "k int, v string"), ["k"])
        return plain(self, name, base, *rest)

    monkeypatch.setattr(TableStore, "_load_touched", slow)
    store.load("t", "merge", spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), ["k"])
    assert _rows(store.read("t")) == [(1, "x"), (2, "y")] and store.newest("t") == 2


def test_crash_before_publishing(spark, store, monkeypatch):
    store.load("t", "append", spark.range(3), ["id"])
    monkeypatch.setattr(store, "_commit", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        store.load("t", "append", spark.range(3, 6), ["id"])
    monkeypatch.undo()
    assert store.read("t").count() == 3 and store.vacuum("t", 1) == 1
    store.load("t", "append", spark.range(3, 6), ["id"])
    assert store.read("t").count() == 6
    assert not store._publish(store._log("t", 1), "{}") and store.read("t").count() == 6


def test_replays_after_vacuum_and_checkpoints(spark, store):
    for i in range(13):
        store.load("t", "append", spark.range(2 * i, 2 * i + 2), ["id"], batch_id=f"s#{i}")
    assert store.vacuum("t", 1) == 0
    for i in (0, 5, 12):
        store.load("t", "append", spark.range(2), ["id"], batch_id=f"s#{i}")
    assert store.read("t").count() == 26 and store.versions("t") == [12]
    store.load("t", "append", spark.range(26, 28), ["id"], batch_id="s#13")
    assert store.read("t").count() == 28 and store._entry("t")["rows"] == 28


def test_changes(spark, store):
    store.load("t", "overwrite", spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (4, "d")], "k int, v string"), ["k"])
    store.load("t", "merge", spark.createDataFrame([(2, "B"), (3, "c"), (None, "n")], "k int, v string"), ["k"])
    store.change_where("t", F.col("k") == 4, None)
    assert _rows(store.changes("t", 0)) == [(2, "B", "update"), (3, "c", "insert"), (4, "d", "delete")]
    store.compact("t")
    assert store.changes("t", 2).count() == 0
    assert _rows(store.changes("t", None, 0)) == [(1, "a", "insert"), (2, "b", "insert"), (4, "d", "insert"), (None, "n", "insert")]
    assert _rows(store.changes("t", 0, 1, keys=[])) == [(2, "B", "insert"), (2, "b", "delete"), (3, "c", "insert")]


def test_failed_runs_move_no_mark(spark, store):
    store.load("s", "append", spark.createDataFrame([(1, "a")], "k int, v string"), ["k"])

    def run(build):
        return incremental(store, "r", ["s"], lambda found: build(found["s"].drop("_change")), "out", "append", ["k"])

    with pytest.raises(ZeroDivisionError):
        run(lambda rows: 1 / 0)
    assert Marks(store, "r").read() == {}
    assert run(lambda rows: rows) == 0 and run(lambda rows: rows) is None
    store.load("s", "append", spark.createDataFrame([(2, "b")], "k int, v string"), ["k"])
    real, Marks.write = Marks.write, lambda *a: (_ for _ in ()).throw(OSError("gone"))
    try:
        with pytest.raises(OSError):
            run(lambda rows: rows)  # committed, but the mark isn't written
    finally:
        Marks.write = real
    run(lambda rows: rows)
    assert _rows(store.read("out")) == [(1, "a"), (2, "b")] and Marks(store, "r").read() == {"s": 1}


def test_ranges_read_fewer_files(spark, store):
    df = spark.range(20_000).select("id", (F.col("id") * 7919 % 20_000).alias("x"), F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("s"))
    for name, columns in (("one", ["id"]), ("two", ["id", "x"]), ("text", ["s"])):
        store.load(name, "overwrite", df, [], cluster_by=columns)
        ranges = {"s": ("k000100", "k000300")} if name == "text" else {c: (100, 1200) for c in columns}
        found = store.read(name, ranges=ranges)
        want = df.where(" AND ".join(f"{c} BETWEEN '{lo}' AND '{hi}'" if isinstance(lo, str) else f"{c} BETWEEN {lo} AND {hi}" for c, (lo, hi) in ranges.items()))
        assert _rows(found) == _rows(want) and found.count()
        assert len(found.inputFiles()) <= (2 if len(columns) > 1 else 1) < len(store.read(name).inputFiles())
    with pytest.raises(ValueError, match="over"):
        layout.clustered(df, ["a", "b", "c", "d", "e"])


def test_update_and_delete(spark, store):
    store.load("t", "overwrite", spark.range(100).withColumn("v", F.lit(0)), ["id"], cluster_by=["id"])
    before = _files(store, "t")
    store.change_where("t", F.col("id") == 3, {"v": F.lit(1)})
    assert len(before - _files(store, "t")) == 1 and _rows(store.read("t").where("v = 1")) == [(3, 1)]
    store.change_where("t", F.col("id") < 10, None)
    assert store.read("t").count() == 90 and store.history("t").where("version = 2").first()["metrics"]["deleted"] == 10
    assert store.change_where("t", F.col("id") < 10, None) == 2


def test_cdc_edges(spark):
    schema = "k int, h string, is_deleted int, is_current int, at timestamp"
    target = spark.createDataFrame([(1, "a", 0, 1, None), (2, "b", 1, 0, None), (None, "n", 0, 1, None)], schema)
    changes = spark.createDataFrame([(1, "a", "update"), (2, "b", "update"), (None, "m", "update"), (9, "z", "delete"), (8, "y", "insert")], "k int, h string, op string")
    now = F.lit("2024-01-01").cast("timestamp")
    once = loads.cdc_apply(target, changes, ["k"], hash_column="h", modified="at", now=now)
    assert sorted(((r.k, r.h, r.is_deleted, r.is_current, r["at"] is None) for r in once.collect()), key=str) == sorted([(1, "a", 0, 1, True), (2, "b", 0, 1, False), (None, "m", 0, 1, False), (8, "y", 0, 1, False)], key=str)
    assert _rows(loads.cdc_apply(once, changes, ["k"], hash_column="h", modified="at", now=F.lit("2030-01-01").cast("timestamp"))) == _rows(once)
    with pytest.raises(Exception, match="several source rows"):
        loads.cdc_apply(target, changes.unionByName(changes), ["k"], modified="at", now=now).collect()


def test_scd2_keeps_rows_without_a_mark(spark):
    t = spark.createDataFrame([(1, "a", None, None, None), (1, "b", None, None, 1), (2, "c", None, None, 0)], "k int, v string, active_start timestamp, active_end timestamp, is_current int")
    s = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    got = loads.scd2(t, s, ["k"], ["v"], F.lit("2024-01-01").cast("timestamp"))
    assert sorted(((r.k, r.v, r.is_current) for r in got.collect()), key=str) == sorted([(1, "a", None), (1, "b", 1), (2, "c", 0), (2, "c", 1)], key=str)


def test_append_new_refuses_repeated_keys(spark):
    t, s = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(2,), (2,)], "k int")
    with pytest.raises(Exception, match="several source rows"):
        loads.load("append_new", t, s, ["k"]).collect()


def test_soft_delete(spark):
    t = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    now, later = (F.lit(x).cast("timestamp") for x in ("2024-01-01", "2025-01-01"))
    once = loads.load("soft_delete", t, spark.createDataFrame([(1,), (1,), (None,)], "k int"), ["k"], now=now)
    twice = loads.load("soft_delete", once, spark.createDataFrame([(2,)], "k int"), ["k"], now=later)
    assert sorted(((r.k, r.is_deleted, r.deleted_at and r.deleted_at.year) for r in twice.collect()), key=str) == sorted([(1, 1, 2025), (2, 0, None), (None, 1, 2025)], key=str)


def test_base_versions(spark, store):
    store.load("t", "append", spark.range(1), ["id"])
    with pytest.raises(ConcurrentCommit):
        store.commit("t", spark.range(2), "overwrite", base=None)
    with pytest.raises(ValueError):
        store.load("t", "sideways", spark.range(1), ["id"])


def test_files_grow_in_number_not_in_size(spark, store, monkeypatch):
    df = spark.range(20_000).select("id", F.lit(1).alias("one"), (F.col("id") % 7).alias("x"), F.repeat(F.lit("y"), 92).alias("s"))
    monkeypatch.setattr(layout, "FILE_BYTES", 100_000, raising=False)
    for columns in (["id"], ["one"], ["one", "x"]):
        sizes = [r[0] for r in layout.clustered(df, columns).groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert sum(sizes) == 20_000 and len(sizes) >= 20 and max(sizes) < 3000
    store.load("t", "overwrite", df, [], cluster_by=["one", "x"])
    assert _rows(store.read("t", ranges={"x": (2, 3)})) == _rows(df.where("x BETWEEN 2 AND 3"))
    assert len(layout.clustered(df, ["one"], 3).groupBy(F.spark_partition_id()).count().collect()) == 3


def test_bounds_of_files_need_no_sort(spark, store):
    df = spark.sql("SELECT id, date_add(DATE'1996-01-01', CAST(id AS INT)) AS d, CAST(date_add(DATE'1996-01-01', CAST(id AS INT)) AS TIMESTAMP_NTZ) AS n, CAST(id AS STRING) AS s FROM range(100)")
    store.load("t", "overwrite", df, ["d", "n", "s", "id"])
    from lakeforge.store import per_file

    per = per_file(store.read("t"), ["d", "n", "s", "id"])
    assert "Sort" not in per._jdf.queryExecution().executedPlan().toString()
    held = [x["bounds"] for own in store._entry("t")["files"].values() for x in own.values()]
    assert min(b["d"][0] for b in held) == "1996-01-01" and max(b["n"][1] for b in held) == "1996-04-09 00:00:00" and max(b["s"][1] for b in held) == "99"
    far = df.unionByName(df.selectExpr("id", "make_date(12000, 1, 1) AS d", "n", "CAST(NULL AS STRING) AS s")).unionByName(df.selectExpr("id", "CAST(NULL AS DATE) AS d", "n", "s")).coalesce(1)
    store.load("far", "overwrite", far, ["d"])
    for low, high in (("1996-01-01", "1996-01-03"), ("1997-01-01", None), ("1996-01-02", "+12000-01-01")):
        where = f"d >= DATE'{low}'" + (f" AND d <= DATE'{high}'" if high else "")
        assert _rows(store.read("far", ranges={"d": (low, high)}).selectExpr("id", "string(d)", "s")) == _rows(far.where(where).selectExpr("id", "string(d)", "s"))
    store.load("far", "overwrite_by_key", df.where("id = 0").unionByName(df.selectExpr("id", "make_date(12000, 1, 1) AS d", "n", "s").where("id = 1")), ["d"])
    assert store.read("far").where("d = make_date(12000, 1, 1)").count() == 1

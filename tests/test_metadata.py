"""Catalogues, run messages, zone logs, streams whose fields change."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lakeforge import metadata
from lakeforge.operators import audit
from lakeforge.store import TableStore
from lakeforge.streaming import evolving


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, f"file://{tmp_path}/tables")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_documents_of_folders(spark, store, tmp_path):
    root = f"{tmp_path}/Files x"
    _put(root, "a/one.json", json.dumps({"datasetName": "one", "curatedProperties": {"targetLoadType": "merge"}}, indent=2))
    _put(root, "a/deep/Two.json", '{"datasetName": "two", "sourceSystemProperties": {"ingestType": "cdc"}, "more": 1}')
    _put(root, "a/WaterMark/three.json", '{"datasetName": "three"}')
    _put(root, "b/four.json", '{"datasetName": "four", ')
    _put(root, "top.json", '{"datasetName": "top"}')
    docs = metadata.read_documents(spark, f"file://{root}")
    assert _rows(docs.select("shortcut_name", "datasetName", F.col("_corrupt").isNotNull())) == [("a", "one", False), ("a", "two", False), ("b", None, True)]
    assert metadata.read_documents(spark, f"file://{root}", skip=[], deep=False).count() == 2
    for _ in range(2):
        metadata.load_datasets(store, f"file://{root}")
    assert _rows(store.read("catalog.datasets")) == [("a", "one", None, None, None, "merge"), ("a", "two", None, None, "cdc", None)]
    listed = metadata.stored_columns(store, ["catalog.datasets"]).orderBy("ordinal").collect()
    assert [r.column_name for r in listed][:2] == ["shortcut_name", "dataset_name"] and listed[0].n_rows == 2 and listed[0].n_bytes > 0


def test_configs(spark, tmp_path):
    columns = spark.createDataFrame([("t", "Id", "int", 1), ("t", "place", "geography", 2), ("t", "EnteredOn", "datetime", 3), ("t", "ssn", "char", 4), ("u", "ssn", "char", 1)], "dataset_name string, column_name string, column_data_type string, column_ordinal int")
    keys = spark.createDataFrame([("t", "Id, place")], "dataset_name string, primary_key_list string")
    pii = spark.createDataFrame([("t", "ssn", 0), ("t", "Id", 1), ("u", "ssn", 0)], "dataset_name string, column_name string, include_in_load int")
    made = metadata.dataset_configs(columns, keys, pii)
    (row,) = made.collect()
    source, target = row.config.sourceSystemProperties, row.config.curatedProperties
    assert source.includeSpecificColumns == ["ID", "CAST(place AS VARCHAR(255)) AS place", "ENTEREDON", "YEAR(ENTEREDON) AS enteredon_year", "MONTH(ENTEREDON) AS enteredon_month"]
    assert (source.sourceWatermarkIdentifier, source.isDynamicQuery, target.targetLoadType, target.primaryKeyList, target.partitionKeyList) == ("ENTEREDON", True, "merge", ["Id", "place"], ["enteredon_year", "enteredon_month"])
    metadata.write_configs(made, f"file://{tmp_path}/configs")
    back = metadata.read_documents(spark, f"file://{tmp_path}/configs", pattern="*.txt")
    assert _rows(metadata.datasets(back)) == [("of=t", "t", "database", None, "watermark", "merge")]


def test_tokens_and_envelopes():
    assert metadata.fill({"{a}": ["x {a} {b} {c}", 1, {"k": "{b}"}]}, {"a": "{b}", "b": None}) == {"{b}": ["x {b}  {c}", 1, {"k": ""}]}
    assert json.loads(metadata.envelope({"run_id": "r"}, {"n": 1}, "Raw", "Ingestion", "a", "b")) == {"run_id": "r", "metadata": {"n": 1}, "zone": "Raw", "stage": "Ingestion", "orchestration_tool": "spark", "zone_start_date_time": "a", "zone_end_date_time": "b"}


def _message(zone, end, **metadata):
    return (json.dumps({"run_id": "r", "etl_id": "1", "product_name": "p", "feed_name": "f", "zone": zone, "stage": "Transformation", "zone_end_date_time": end, "metadata": metadata}),)


def test_zone_log(spark, store):
    bodies = [
        _message("Raw", "2024-01-01 02:00:00", executionDetails=[{"status": "Succeeded", "start": "2024-01-01T01:30:00.5"}], dataWritten=5, rowsCopied=3, dataRead=7),
        _message("Raw", "2024-01-01 01:00:00", executionDetails=[{"status": "Succeeded", "start": "2024-01-01T00:30:00.000001"}], dataWritten=4, errors=[]),
        _message("Prepared", "2024-01-01 03:00:00", error_message="no", runOutput={"zone_start_date_time": "2024-01-01 02:30:00", "total_data_written": 9}), ("{", ), (None, ), ("{}", ),
    ]
    found = audit.messages(spark.createDataFrame(bodies, "body string"), "body")
    log = audit.ingestion_log(found).collect()
    assert len(log) == 3 and len(log[0]) == 18 and {(r.zone, r.status, r.data_read, r.data_written, r.files_written) for r in log} == {("Raw", "Success", 7, 5, 3), ("Raw", "Success", None, 4, None), ("Prepared", "Failed", -1, -1, None)}
    zones = audit.ZoneLog(store)
    runs = spark.createDataFrame([("r", 1, "p", "f")], "run_id string, etl_id bigint, product_name string, feed_name string")
    stages = [("Raw", "Ingestion"), ("Prepared", "Transformation"), ("Shared", "Publish")]
    zones.expect(runs, stages)
    assert zones.rows(1, open_only=True).count() == 3 and zones.rows(2).count() == 0
    zones.record(found)
    got = {r.zone: (r.zone_status, str(r.zone_start_date_time), str(r.zone_end_date_time), r.total_data_storage, r.total_error_count) for r in zones.rows().collect()}
    assert got["Raw"] == ("Success", "2024-01-01 00:30:00.000001", "2024-01-01 02:00:00", 9, 0) and got["Prepared"] == ("Fail", "2024-01-01 02:30:00", "2024-01-01 03:00:00", 0, 1) and got["Shared"][0] == "Pending"
    zones.expect(runs, stages)
    assert zones.rows(1, open_only=True).count() == 3 and zones.rows().count() == 3


def test_streams_whose_fields_change(spark, store, tmp_path):
    folder, checkpoint = f"{tmp_path}/in", f"file://{tmp_path}/cp"
    how = {"path": f"file://{folder}", "store": store, "table": "t", "strategy": "append", "keys": ["k"], "checkpoint": checkpoint, "schema": "k int, v string"}
    _put(folder, "1.json", '{"k": 1, "v": "a"}\n\n{"k": "x", "v": "b"}\nnot json\n')
    assert evolving.run_evolving(**how) == 0
    _put(folder, "2.json", '{"k": 2, "v": "c", "n": 1.5, "deep": {"a": [1, 2]}}\n{"k": 3, "v": null, "none": null}\n')
    assert evolving.run_evolving(**how) == 1  # the first start widens the schema and stops
    _put(folder, "3.json", '{"k": 4, "n": "much"}\n')
    assert evolving.run_evolving(**how) == 0 and evolving.run_evolving(**how) == 0
    got = {(r.k, r.v, r.n, None if r.deep is None else tuple(r.deep.a), r[evolving.RESCUED]) for r in store.read("t").collect()}
    assert got == {(1, "a", None, None, None), (None, "b", None, None, '{"k":"x"}'), (None, None, None, None, "not json"), (2, "c", 1.5, (1, 2), None), (3, None, None, None, None), (4, None, None, None, '{"n":"much"}')}
    assert store.read("t").count() == 6 and evolving.SchemaLog(store, checkpoint).read().names == ["k", "v", "deep", "n"]


def test_rescued_fields_and_strategies(spark, store, tmp_path):
    folder = f"{tmp_path}/in"
    _put(folder, "1.json", '{"k": 1, "v": "a", "z": true}\n')
    how = {"path": f"file://{folder}", "store": store, "keys": ["k"], "schema": "k int, v string"}
    evolving.start_evolving(table="r", strategy="merge", checkpoint=f"file://{tmp_path}/c1", mode="rescue", changed=["v"], **how).awaitTermination()
    assert _rows(store.read("r")) == [(1, "a", '{"z":"true"}')]
    evolving.start_evolving(table="n", strategy="append", checkpoint=f"file://{tmp_path}/c2", mode="none", chain=[lambda b: b.withColumn("w", F.lit(1))], **how).awaitTermination()
    assert _rows(store.read("n")) == [(1, "a", 1)]
    with pytest.raises(ValueError):
        evolving.start_evolving(table="n", strategy="append", checkpoint="c", mode="odd", **how)

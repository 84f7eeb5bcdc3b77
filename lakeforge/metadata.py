"""Catalogues of datasets: configuration documents read from folders, and made from column lists."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import decision_list
from .store import TableStore

#: What a catalogue keeps of a document; nested parts may be missing.
DOCUMENT = (
    "datasetName string, datasetTypeName string, databaseName string, sourceSystemProperties struct<ingestType: string, sourceWatermarkIdentifier: string, includeSpecificColumns: array<string>>, "
    "curatedProperties struct<targetLoadType: string, primaryKeyList: array<string>, partitionKeyList: array<string>>"
)
DATASETS = {
    "dataset_name": "datasetName", "dataset_type_name": "datasetTypeName", "database_name": "databaseName",
    "source_system_ingest_type": "sourceSystemProperties.ingestType", "target_load_type": "curatedProperties.targetLoadType",
}
KEYS = ["shortcut_name", "dataset_name"]


def segments(path: Column) -> Column:
    """The folder names of a path, in lower case."""
    parts = F.split(F.regexp_replace(F.url_decode(path), "^[a-zA-Z0-9+.-]+:/+", ""), "/")
    return F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), F.lower)


def without_folders(df: DataFrame, path: str, names: list[str]) -> DataFrame:
    """Rows of files that lie in no folder of these names, at any depth; case doesn't count."""
    return df.where(~F.arrays_overlap(segments(F.col(path)), F.array(*[F.lit(n.lower()) for n in names]))) if names else df


def read_documents(spark: SparkSession, root: str, schema: str | T.StructType = DOCUMENT, skip: list[str] = ("watermark",), deep: bool = True, pattern: str = "*.json") -> DataFrame:
    """The JSON documents below a folder with ``shortcut_name`` (the folder's child they are in), ``file_path`` and ``_corrupt``.

    A file holds one document on any number of lines. A document that can't be parsed is a row
    with its text in ``_corrupt``. Without ``deep`` only files right in a shortcut count.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.read.option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("columnNameOfCorruptRecord", "_corrupt")
    rows = reader.schema(T.StructType([*kind, T.StructField("_corrupt", T.StringType())])).json(root).withColumn("file_path", F.col("_metadata.file_path"))
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    top = top.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(top).toUri().getPath().rstrip("/")
    below = F.split(F.regexp_replace(F.url_decode(F.regexp_replace("file_path", "^[a-zA-Z0-9+.-]+:(//[^/]*)?", "")), f"^{re.escape(top)}/", ""), "/")
    rows = rows.withColumn("shortcut_name", F.get(below, 0)).where(F.size(below) > 1 if deep else F.size(below) == 2)
    return without_folders(rows, "file_path", list(skip))


def datasets(documents: DataFrame) -> DataFrame:
    """The catalogue's rows of parsed documents; those without a name are left to the corrupt ones."""
    return documents.where("datasetName IS NOT NULL").select("shortcut_name", *[F.col(v).alias(k) for k, v in DATASETS.items()])


def load_datasets(store: TableStore, root: str, table: str = "catalog.datasets", **options) -> int:
    """Merge the documents below a folder into the catalogue; a dataset is known by shortcut and name, and must stand in one file."""
    return store.load(table, "merge", datasets(read_documents(store.spark, root, **options)), KEYS)


def dataset_configs(columns: DataFrame, keys: DataFrame, excluded: DataFrame | None = None, defaults: dict | None = None) -> DataFrame:
    """``dataset_name, config``: a configuration for each dataset of a column list, as a struct.

    ``columns``: dataset_name, column_name, column_data_type, column_ordinal. ``keys``: dataset_name,
    primary_key_list (comma-separated). ``excluded``: dataset_name, column_name, include_in_load;
    columns with 0 are left out (of personal data), also as keys of increments. A dataset with
    UPDATEON or ENTEREDON is read by increments and partitioned by that column's year and month;
    one with keys is merged, others are overwritten. Ties of ordinals go by name; a dataset whose
    columns are all excluded has no configuration.
    """
    kept = columns
    if excluded is not None:
        out = excluded.where("include_in_load = 0").select("dataset_name", "column_name").distinct()
        kept = columns.join(out, ["dataset_name", "column_name"], "left_anti")
    upper, lower = F.upper("column_name"), F.lower("column_name")
    text = F.when(F.lower("column_data_type") == "geography", F.concat(F.lit("CAST("), lower, F.lit(" AS VARCHAR(255)) AS "), lower)).otherwise(upper)
    each = F.array_sort(F.collect_list(F.struct("column_ordinal", "column_name", text.alias("text"))))
    grouped = kept.groupBy("dataset_name").agg(each.alias("own"), F.bool_or(upper == "UPDATEON").alias("updated"), F.bool_or(upper == "ENTEREDON").alias("entered"))
    rows = grouped.join(keys.select("dataset_name", "primary_key_list"), "dataset_name", "left")
    by = F.when(F.col("updated"), "UPDATEON").when(F.col("entered"), "ENTEREDON")
    parts = F.transform(F.array(F.lit("year"), F.lit("month")), lambda p: F.concat(F.lower(by), F.lit("_"), p))
    selects = F.transform(F.array(F.lit("YEAR"), F.lit("MONTH")), lambda p: F.concat(p, F.lit("("), by, F.lit(") AS "), F.lower(by), F.lit("_"), F.lower(p)))
    none = F.array().cast("array<string>")
    primary = F.coalesce(F.filter(F.transform(F.split("primary_key_list", ","), lambda k: F.trim(k)), lambda k: k != ""), none)
    mark = decision_list([(F.col("updated") & F.col("entered"), "COALESCE(UPDATEON, ENTEREDON)"), (F.col("updated"), "UPDATEON"), (F.col("entered"), "ENTEREDON")], None)
    own = {"enable": True, "datasetTypeName": "database", **(defaults or {})}
    config = F.struct(
        F.col("dataset_name").alias("datasetName"), *[F.lit(v).alias(k) for k, v in own.items()],
        F.struct(
            F.concat(F.transform("own", lambda c: c["text"]), F.when(by.isNotNull(), selects).otherwise(none)).alias("includeSpecificColumns"),
            F.when(by.isNotNull(), "watermark").otherwise("full").alias("ingestType"), mark.cast("string").alias("sourceWatermarkIdentifier"), by.isNotNull().alias("isDynamicQuery"),
        ).alias("sourceSystemProperties"),
        F.struct(primary.alias("primaryKeyList"), F.when(F.size(primary) > 0, "merge").otherwise("overwrite").alias("targetLoadType"), F.when(by.isNotNull(), parts).alias("partitionKeyList")).alias("curatedProperties"),
    )
    return rows.select("dataset_name", config.alias("config"))


def write_configs(configs: DataFrame, root: str, name: str = "dataset_name") -> None:
    """Each configuration as a JSON file below ``<root>/<dataset>/``, written by tasks."""
    configs.select(F.col(name).alias("of"), F.to_json("config").alias("value")).repartition("of").write.partitionBy("of").mode("overwrite").text(root)


def fill(document: dict, values: dict) -> dict:
    """A JSON document with tokens ``{name}`` in its texts replaced, in one pass; missing values are empty, other tokens stay."""

    def each(x):
        if isinstance(x, str):
            return re.sub(r"\{(\w+)\}", lambda m: ("" if values[m[1]] is None else str(values[m[1]])) if m[1] in values else m[0], x)
        if isinstance(x, dict):
            return {each(k): each(v) for k, v in x.items()}
        return [each(v) for v in x] if isinstance(x, list) else x

    return each(document)


def stored_columns(store: TableStore, names: list[str]) -> DataFrame:
    """``table_name, column_name, ordinal, data_type, n_rows, n_bytes``: what a catalogue says of stored tables; made of their logs, no data is read."""
    rows = []
    for name in names:
        state = store._entry(name)
        size = sum(x["bytes"] for own in state["files"].values() for x in own.values())
        rows += [(name, f.name, i, f.dataType.simpleString(), state["rows"], size) for i, f in enumerate(T.StructType.fromJson(state["schema"]), 1)]
    return store.spark.createDataFrame(rows, "table_name string, column_name string, ordinal int, data_type string, n_rows long, n_bytes long")


def envelope(values: dict, metadata: dict, zone: str, stage: str, started: str, ended: str) -> str:
    """The message of a run that ended, as JSON; times are texts."""
    return json.dumps({**values, "metadata": metadata, "zone": zone, "stage": stage, "orchestration_tool": "spark", "zone_start_date_time": started, "zone_end_date_time": ended})

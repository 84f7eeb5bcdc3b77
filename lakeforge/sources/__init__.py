"""Config-driven readers and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.layout import cluster_columns  # noqa: F401

#: Option names of a dataset's config and Spark's names for them.
OPTIONS = {"inferColumnTypes": "inferSchema", "delimiter": "sep", "multiline": "multiLine"}
FORMATS = ("parquet", "csv", "json", "orc", "text")


def read(spark: SparkSession, kind: str, path: str | list[str], options: dict | None = None, schema: StructType | str | None = None, columns: list[str] | None = None) -> DataFrame:
    """A file set as a frame; ``columns`` may be expressions and reaches the scan."""
    if kind not in FORMATS:
        raise ValueError(f"unknown source format {kind!r}; one of {FORMATS}")
    reader = spark.read.format(kind).options(**{OPTIONS.get(k, k): v for k, v in (options or {}).items()})
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    return df.selectExpr(*columns) if columns else df


def read_whole(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path, content``: one row a file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def modified_since(df: DataFrame, since: Column) -> DataFrame:
    """Rows of files changed at or after a time; files before it aren't read."""
    return df.where(F.col("_metadata.file_modification_time") >= since)


def read_stream(spark: SparkSession, kind: str, path: str, schema: StructType | str, options: dict | None = None) -> DataFrame:
    return spark.readStream.format(kind).schema(schema).options(**{OPTIONS.get(k, k): v for k, v in (options or {}).items()}).load(path)


def read_query(spark: SparkSession, url: str, query: str, options: dict | None = None) -> DataFrame:
    """The rows of a query that the database runs; give partitionColumn and bounds in the options for parallel reads."""
    return spark.read.format("jdbc").options(url=url, query=query, **(options or {})).load()


def write(df: DataFrame, path: str, kind: str = "parquet", mode: str = "error", partition_by: list[str] | None = None, skip_empty: bool = False, **options: str) -> bool:
    """Write a frame; False where it was empty and skipped."""
    if skip_empty and df.isEmpty():
        return False
    writer = df.write.format(kind).mode(mode).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    return True


def deploy_views(spark: SparkSession, scripts: dict[str, str], fail_fast: bool = True) -> dict[str, str]:
    """Run CREATE VIEW scripts in the order of their names; the errors by name."""
    errors: dict[str, str] = {}
    for name in sorted(scripts):
        try:
            spark.sql(scripts[name])
        except Exception as e:
            if fail_fast:
                raise
            errors[name] = str(e).split("\n")[0]
    return errors


def external_table(spark: SparkSession, name: str, path: str, schema: StructType | str, kind: str = "parquet", partition_by: list[str] | None = None) -> None:
    """A catalogue's table over files that stay where they are; one that is there already isn't changed."""
    columns = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {kind}{parts} LOCATION '{path}'")


def html_table(df: DataFrame, most: int = 1000, none: str = "") -> str:
    """A report's rows as an HTML table; texts are escaped, more than ``most`` rows are an error."""
    text = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(none)) for c in df.columns]
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = [F.replace(t, F.lit(mark), F.lit(name)) for t in text]
    rows = df.select(F.concat(F.lit("<tr><td>"), F.concat_ws("</td><td>", *text), F.lit("</td></tr>")).alias("row")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report has {most} rows at most")
    head = "".join(f"<th>{c.replace('&', '&amp;').replace('<', '&lt;').replace('>', '&gt;')}</th>" for c in df.columns)
    return f"<table><tr>{head}</tr>{''.join(r[0] for r in rows)}</table>"

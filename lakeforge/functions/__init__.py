"""Column expressions shared by operators, plans and queries; all stay in the JVM."""

from __future__ import annotations

import re
import warnings

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def norm_key(c: Column) -> Column:
    """Key form of a string: lower case without outer blanks; null stays null."""
    return F.lower(F.trim(c))


def default_key(c: Column, missing: int = -1) -> Column:
    return F.coalesce(c, F.lit(missing))


def row_hash(columns: list[str]) -> Column:
    """SHA-256 over the columns in name order. Null, empty and shifted values all differ."""
    parts = [F.coalesce(F.concat(F.lit("v"), F.replace(F.col(f"`{c}`").cast("string"), F.lit("|"), F.lit("||"))), F.lit("n")) for c in sorted(columns)]
    return F.sha2(F.concat_ws("|:", *parts), 256)


def clean_name(name: str) -> str:
    """A bare lower-case token for a table or column name."""
    return re.sub(r"[^A-Za-z0-9_]", "", name).lower()


def unredacted(live: Column, archive: Column, mark: str = "redacted") -> Column:
    """The live value, or the archive's where it is missing or redacted; case and blanks around the mark don't count."""
    return F.when(norm_key(live) != mark, live).otherwise(archive)


def absent_fields(df: DataFrame, document: str, columns: list[str]) -> DataFrame:
    """``name, n``: fields of a map column that aren't among the columns (case doesn't count), and how many rows have a value there."""
    known = F.array(*[F.lit(c.lower()) for c in columns])
    names = F.map_keys(F.map_filter(document, lambda k, v: v.isNotNull() & ~F.array_contains(known, F.lower(k))))
    return df.select(F.explode(names).alias("name")).groupBy("name").agg(F.count("*").alias("n"))


def decision_list(rules: list[tuple[Column, object]], otherwise: object) -> Column:
    """The value of the first rule that holds."""
    out = None
    for condition, value in rules:
        out = F.when(condition, F.lit(value)) if out is None else out.when(condition, F.lit(value))
    return F.lit(otherwise) if out is None else out.otherwise(F.lit(otherwise))


def parse_timestamp(c: Column, formats: list[str]) -> Column:
    """The first format that fits; null where none does."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def with_timestamp(df: DataFrame, text: str, formats: list[str], name: str, seen: Observation | None = None) -> DataFrame:
    """Rows with a parsed time; ``seen`` counts in the same pass what didn't parse (``unparsed``) and names one such text (``example``)."""
    out = df.withColumn(name, parse_timestamp(F.col(f"`{text}`"), formats))
    bad = F.col(f"`{text}`").isNotNull() & F.col(f"`{name}`").isNull()
    return out if seen is None else out.observe(seen, F.count_if(bad).alias("unparsed"), F.max(F.when(bad, F.col(f"`{text}`"))).alias("example"))


def warn_unparsed(seen: Observation, what: str) -> int:
    """How many texts weren't times, after an action; a warning if any."""
    found = seen.get
    if found["unparsed"]:
        warnings.warn(f"{what}: {found['unparsed']} texts are no times and were left null, such as {found['example']!r}", stacklevel=2)
    return found["unparsed"]


def lsn_text(c: Column) -> Column:
    """A binary log position as 0x and lower-case hex digits."""
    return F.concat(F.lit("0x"), F.lower(F.hex(c)))



#: Source types that Spark names otherwise; those with a size are read by their stem.
_TYPES = {"varchar": "string", "nvarchar": "string", "char": "string", "text": "string", "datetime": "timestamp", "datetime2": "timestamp", "money": "decimal(19,4)", "smallmoney": "decimal(10,4)", "bit": "boolean", "geography": "string", "nchar": "string", "ntext": "string", "xml": "string", "uniqueidentifier": "string", "time": "string", "tinyint": "smallint", "smallint": "smallint", "real": "float", "smalldatetime": "timestamp", "datetimeoffset": "timestamp", "binary": "binary", "varbinary": "binary", "image": "binary", "timestamp": "binary", "rowversion": "binary", "int": "int", "bigint": "bigint", "float": "double", "date": "date"}


def source_type(name: str) -> str:
    """The Spark type of a database column type such as ``decimal(10,2)`` or ``nvarchar(max)``."""
    stem, _, size = name.strip().lower().partition("(")
    if stem in ("decimal", "numeric"):
        return f"decimal({size.rstrip(')') or '38,18'})"
    if stem not in _TYPES:
        raise ValueError(f"unknown source type {name!r}")
    return _TYPES[stem]


def strip_nbsp(c: Column) -> Column:
    """Without outer blanks, non-breaking spaces counting as blanks."""
    return F.trim(F.regexp_replace(c, "\u00a0", " "))


def reordered(names: list[str], first: list[str]) -> list[str]:
    """The columns with those of ``first`` that exist in front."""
    front = [c for c in first if c in names]
    return front + [c for c in names if c not in front]


def without_prefix(names: list[str], prefix: str) -> list[str]:
    return [c for c in names if not c.startswith(prefix)]

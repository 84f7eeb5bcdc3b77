"""High-water marks, extract predicates and the state between runs."""

from __future__ import annotations

import re
import uuid

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import BinaryType

from .functions import lsn_text
from .operators import layout

#: Marks of a first extract. Sources whose dates begin later than others' can take LATE_START.
START = {"watermark": "1900-01-01T00:00:00Z", "cdc": "0x0"}
LATE_START = "1983-01-01"


def predicate(text: str | None) -> str | None:
    """A filter without its leading WHERE or AND; literals keep their case."""
    found = re.sub(r"(?i)^\s*(where|and)\s+", "", text or "").strip()
    return found or None


#: Dialects of extracts: the source's own, and Spark's for the same extract over files.
DIALECTS = ("tsql", "spark")


def _position(mark: str, dialect: str) -> str:
    """A log position as a binary literal of the dialect."""
    digits = mark[2:]
    return mark if dialect == "tsql" else f"X'{'0' * (len(digits) % 2)}{digits}'"


def _limited(select: str, top: int | None, dialect: str) -> str:
    """A query (without its SELECT) that returns so many rows at most."""
    if dialect not in DIALECTS:
        raise ValueError(f"unknown dialect {dialect!r}; one of {DIALECTS}")
    if not top:
        return f"SELECT {select}"
    return f"SELECT TOP({int(top)}) {select}" if dialect == "tsql" else f"SELECT {select} LIMIT {int(top)}"


def next_query(config: dict, state: dict | None = None, dialect: str = "tsql") -> str:
    """The extract of one dataset. A stored mark counts only while its column is the same."""
    kind, column = config.get("ingestType", "full"), config.get("sourceWatermarkIdentifier")
    if kind not in ("full", *START):
        raise ValueError(f"unknown ingest type {kind!r}")
    parts = []
    if kind != "full":
        if not column:
            raise ValueError(f"ingest type {kind} needs sourceWatermarkIdentifier")
        same = state is not None and state.get("identifier") == column and state.get("value") is not None
        mark = state["value"] if same else config.get("initialWatermark", START[kind]) if kind == "watermark" else START[kind]
        if kind == "cdc" and not re.fullmatch(r"0x[0-9A-Fa-f]+", str(mark)):
            raise ValueError(f"not a log position: {mark!r}")
        quoted = str(mark).replace("'", "''")
        parts.append(f"{column} > " + (f"CAST('{quoted}' AS timestamp)" if kind == "watermark" else _position(mark, dialect)))
    if extra := predicate(config.get("filterExpression")):
        parts.append(f"({extra})")
    where = f" WHERE {' AND '.join(parts)}" if parts else ""
    return _limited(f"{', '.join(config.get('columns') or ['*'])} FROM {config['table']}{where}", config.get("top"), dialect)


def needs_state(config: dict) -> bool:
    """Only databases that are read by a mark, with a query made anew each time, keep a state."""
    return config.get("sourceType") == "database" and config.get("ingestType") in START and bool(config.get("dynamicQuery"))


def net_change_query(table: str, keys: list[str], position: str, since: str, top: int | None = None, dialect: str = "tsql") -> str:
    """The source's own query for the last change of each key after a log position, with delete and current flags."""
    if not re.fullmatch(r"0x[0-9A-Fa-f]+", since):
        raise ValueError(f"not a log position: {since!r}")
    last = "*, CASE WHEN operation = 'delete' THEN 1 ELSE 0 END AS is_deleted, CASE WHEN operation = 'delete' THEN 0 ELSE 1 END AS is_current FROM ranked WHERE rn = 1"
    ranked = f"SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(keys)} ORDER BY {position} DESC) AS rn FROM {table} WHERE {position} > {_position(since, dialect)}"
    return f"WITH ranked AS ({ranked}) {_limited(last, top, dialect)}"


def advance(df: DataFrame, column: str, state: dict | None = None) -> dict:
    """The state after a committed load; an empty batch keeps the old mark. A binary mark is kept as 0x and hex digits."""
    top = F.max(column)
    top = df.agg(lsn_text(top) if isinstance(df.schema[column].dataType, BinaryType) else top.cast("string")).first()[0]
    old = state if state and state.get("identifier") == column else {"identifier": column, "value": None}
    return old if top is None else {"identifier": column, "value": top}


def extract_offline(source: DataFrame, config: dict, state: dict | None = None) -> DataFrame:
    """The extract that ``next_query`` would ask the database for, over files of the same table."""
    own = source.sparkSession.newSession()
    source.createOrReplaceGlobalTempView(name := f"extract_{uuid.uuid4().hex}")
    return own.sql(next_query(config | {"table": f"global_temp.{name}"}, state, "spark"))


def net_changes_offline(source: DataFrame, keys: list[str], position: str, since: str, top: int | None = None) -> DataFrame:
    """The net changes that ``net_change_query`` would ask the database for, over files of the same change table."""
    source.createOrReplaceGlobalTempView(name := f"changes_{uuid.uuid4().hex}")
    return source.sparkSession.sql(net_change_query(f"global_temp.{name}", keys, position, since, top, "spark")).drop("rn")


# --- extraction in parts


def _literal(value, kind: T.DataType) -> str:
    """A value as SQL text that databases and Spark read alike."""
    if isinstance(kind, T.NumericType):
        return repr(value) if isinstance(value, float) else str(value)
    text = str(value).replace("'", "''")
    return f"TIMESTAMP '{text}'" if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else f"DATE '{text}'" if isinstance(kind, T.DateType) else f"'{text}'"


def split_predicates(df: DataFrame, column: str, parts: int) -> list[str]:
    """Predicates that hold for each row once, for reading in parts of about equal size.

    Values that alone fill a part get one of their own, so do nulls; what is left is cut at
    approximate quantiles. ``df`` is the source or a table with the same key (its statistics are all
    that is used). Numbers, dates and times are cut; other types by their frequent values alone.
    """
    if parts < 1:
        raise ValueError("at least one part is needed")
    kind, c = df.schema[column].dataType, f"`{column}`"
    rows = df.select(F.col(c).alias("v"))
    n, nulls = rows.agg(F.count("*"), F.count_if(F.col("v").isNull())).first()
    most = max(1, n // parts)
    hot = [r["v"] for r in rows.where("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("n")).where(F.col("n") > most).orderBy("v").select("v").collect()]  # fewer than parts
    listed = ", ".join(_literal(v, kind) for v in hot)
    out = ([f"{c} IS NULL"] if nulls else []) + [f"{c} = {_literal(v, kind)}" for v in hot]
    rest = rows.where(F.col("v").isNotNull() & ~F.col("v").isin(*hot)) if hot else rows.where("v IS NOT NULL")
    left = max(1, parts - len(out))
    edges: list = []
    if left > 1 and isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        number = layout.as_number(F.col("v"), kind)
        cuts = rest.agg(F.percentile_approx(number, [k / left for k in range(1, left)], 100 * left)).first()[0]
        # A cut is a value that is there, so that text and comparison are exact.
        firsts = rest.select("v", layout.rank(number, sorted(set(cuts or []))).alias("k")).groupBy("k").agg(F.min("v").alias("v")).where("k > 0").orderBy("k").collect()
        edges = [r["v"] for r in firsts]
    spans = [(None, edges[0])] + list(zip(edges, edges[1:] + [None], strict=True)) if edges else [(None, None)]
    for low, high in spans:
        found = ([f"{c} >= {_literal(low, kind)}"] if low is not None else []) + ([f"{c} < {_literal(high, kind)}"] if high is not None else [])
        found += [f"{c} NOT IN ({listed})"] if hot else [] if found else [f"{c} IS NOT NULL"]
        out.append(" AND ".join(found))
    return out


def extract_parts(df: DataFrame, predicates: list[str], number: str = "part") -> DataFrame:
    """The rows of an offline source with the number of their part; a row that no predicate holds for is an error."""
    held = reduce(lambda found, k: found.when(F.expr(predicates[k]), k), range(len(predicates)), F.when(F.lit(False), -1))
    return df.withColumn(number, held.otherwise(F.raise_error("a row is in no part").cast("int")))


def read_parts(spark: SparkSession, url: str, table: str, predicates: list[str], properties: dict[str, str]) -> DataFrame:
    """A database table read by one connection a predicate."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)

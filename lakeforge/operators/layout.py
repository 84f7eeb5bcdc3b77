"""Layouts of rows in files: ranges of one column, or of several by interleaved bits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns that a layout can serve, and the bits each of them gives to the key.
MOST, BITS = 4, 8
#: Bytes of rows in a file, about, as a task sorts them in memory.
FILE_BYTES = 64 << 20


def cluster_columns(keys: list[str], first: str | None = None, most: int = MOST) -> tuple[list[str], list[str]]:
    """The columns to cluster by, and those over the limit."""
    wanted = list(dict.fromkeys(([first] if first else []) + keys))
    return wanted[:most], wanted[most:]


def as_number(c: Column, kind: T.DataType) -> Column:
    """A number in the column's order; of a string its first six bytes."""
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def rank(x: Column, edges: list) -> Column:
    """How many of the sorted edges are at or below a number, found by halving; 0 for null."""
    if not edges:
        return F.lit(0)
    held, steps = F.array(*map(F.lit, edges)), F.array(*[F.lit(1 << k) for k in reversed(range(len(edges).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= len(edges)) & (x >= F.get(held, at + step - 1)), at + step).otherwise(at))


def width(df: DataFrame) -> Column:
    """About the bytes of a row: read from columns of changing length alone, taken from the type of the others."""
    total = F.lit(8 * len(df.columns))
    for f in df.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.col(f"`{f.name}`"))), F.lit(0))
    return total.cast("long")


def tie(df: DataFrame) -> Column:
    """A hash of the row, so that rows with one key can be dealt to several files. It depends on values alone, so a task done again deals alike."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))])


def interleaved(df: DataFrame, columns: list[str]) -> tuple[Column, int]:
    """A key whose ranges are narrow in each of the columns: their ranks among 256 quantiles, bit by bit in turn; nulls come first. Then the bytes of all rows."""
    numbers = {c: as_number(F.col(f"`{c}`"), df.schema[c].dataType) for c in columns}
    cuts = df.agg(*[F.percentile_approx(x, [k / (1 << BITS) for k in range(1, 1 << BITS)], 4096).alias(c) for c, x in numbers.items()], F.sum(width(df)).alias("__bytes")).first()
    key = F.lit(0).cast("long")
    for j, (c, x) in enumerate(numbers.items()):
        edges = sorted(set(cuts[c] or []))
        at = rank(x, edges)
        for b in range(BITS):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(at, b).bitwiseAND(1).cast("long"), b * len(columns) + j))
    return key, cuts["__bytes"] or 0


def clustered(df: DataFrame, columns: list[str], n_files: int | None = None) -> DataFrame:
    """Rows dealt out by ranges, so that a file has a narrow part of each column and, unless ``n_files`` says otherwise, about FILE_BYTES at most. Over MOST columns is an error."""
    chosen, over = cluster_columns(columns)
    if over:
        raise ValueError(f"a layout takes {MOST} columns at most; over: {over}")
    if len(chosen) == 1:
        key, size = F.col(f"`{chosen[0]}`"), 0 if n_files else df.agg(F.sum(width(df))).first()[0] or 0
    else:
        key, size = interleaved(df, chosen)
    # As many files as there are partitions of a shuffle, more where a file would grow with the rows.
    n = n_files or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    keyed = df.withColumns({"__z": key, "__tie": tie(df)})
    return keyed.repartitionByRange(n, "__z", "__tie").sortWithinPartitions("__z").drop("__z", "__tie")

"""Latest-per-key, de-duplication and dominant-category operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MODES = ("retain_one", "quarantine_all")


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order, which must be total for a fixed result."""
    ranked = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("__rn = 1").drop("__rn")


def mark_duplicates(df: DataFrame, keys: list[str], mode: str, order: list[Column] | None = None, name: str = "is_quarantined", salts: int = 1) -> DataFrame:
    """All rows with a 0/1 flag of those to quarantine; a key with a null is a key like any other.

    One shuffle brings a key's rows together. With ``salts`` over 1 and ``quarantine_all`` they stay
    apart: keys are summed first, and only repeated ones are joined back, to as many parts of their rows.
    """
    if mode not in MODES:
        raise ValueError(f"unknown duplicate mode {mode!r}; one of {MODES}")
    if salts > 1 and mode == "quarantine_all":
        many = df.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1").select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__of"))
        salted = df.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
        meets = F.col("__salt") == F.col("__of")
        for i, k in enumerate(keys):
            meets = meets & F.col(f"`{k}`").eqNullSafe(F.col(f"__k{i}"))
        return salted.join(many, meets, "left").select(*[F.col(f"`{c}`") for c in df.columns], F.col("__of").isNotNull().cast("int").alias(name))
    w = Window.partitionBy(*keys)
    n = F.count("*").over(w) if mode == "quarantine_all" else F.row_number().over(w.orderBy(*(order or [F.col(c) for c in df.columns])))
    return df.withColumn(name, (n > 1).cast("int"))


def split_duplicates(df: DataFrame, keys: list[str], mode: str, order: list[Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows to load and rows to quarantine. Where both are wanted of one plan, use ``mark_duplicates``."""
    marked = mark_duplicates(df, keys, mode, order, "__gone")
    return marked.where("__gone = 0").drop("__gone"), marked.where("__gone = 1").drop("__gone")


def previous(df: DataFrame, keys: list[str], order: list[str], column: str, name: str) -> DataFrame:
    """Rows with the value of the row before in their key: a self join on consecutive numbers as one window."""
    return df.withColumn(name, F.lag(column).over(Window.partitionBy(*keys).orderBy(*order)))


def dominant_category(df: DataFrame, entity: str, category: str, measure: Column, name: str = "measure") -> DataFrame:
    """The category with the largest sum for each entity; ties go to the smallest category."""
    summed = df.groupBy(entity, category).agg(F.sum(measure).alias(name))
    return latest_per_key(summed, [entity], [F.col(name).desc(), F.col(category).asc()])


def net_changes(df: DataFrame, keys: list[str], sequence: list[str], op: str) -> DataFrame:
    """The last change of each key with its delete flag (``op`` is insert, update or delete)."""
    last = latest_per_key(df, keys, [F.col(c).desc() for c in sequence])
    gone = F.col(op) == "delete"
    return last.withColumns({"is_deleted": gone.cast("int"), "is_current": (~gone).cast("int")})


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Rows numbered from 1 within each key, as a long."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))

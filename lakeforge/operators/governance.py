"""Secured views and role differences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def secured(df: DataFrame, columns: list[str] | None = None, predicate: str | None = None) -> DataFrame:
    """Only the permitted columns and rows; both reach the scan."""
    out = df.where(predicate) if predicate else df
    return out.select(*columns) if columns is not None else out


def safe_columns(catalog: DataFrame, closed: str = "CD3") -> DataFrame:
    """``table_name, columns``: the sorted columns below the closed level. An unknown level is closed."""
    return catalog.where(F.col("cd_level") != closed).groupBy("table_name").agg(F.array_sort(F.collect_set("column_name")).alias("columns"))


def role_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """``table_name, change`` (new, changed or removed) between two results of safe_columns."""
    both = old.select("table_name", F.col("columns").alias("o")).join(new.select("table_name", F.col("columns").alias("n")), "table_name", "full_outer")
    change = F.when(F.col("o").isNull(), "new").when(F.col("n").isNull(), "removed").when(F.col("o") != F.col("n"), "changed")
    return both.select("table_name", change.alias("change")).where("change is not null")


def permitted(df: DataFrame, path: str, rules: DataFrame, roles: list[str], allowed: str = "is_permitted") -> DataFrame:
    """Rows with whether one of the roles may read their path: of ``rules`` (role, prefix, allow) the longest prefix of whole segments counts, a denial before a permission.

    A path that no rule names is closed. A path is looked up by its own prefixes, so no pairs of
    paths and rules are made; a null path is closed. Slashes at the ends don't count.
    """
    own = rules.where(F.col("role").isin(*roles)).groupBy(F.trim(F.col("prefix"), F.lit("/")).alias("__prefix")).agg(F.bool_and("allow").alias("__allow"))
    parts = F.split(F.trim(F.col(path), F.lit("/")), "/")
    prefixes = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    paths = df.select(path).where(F.col(path).isNotNull()).distinct()
    found = paths.select(F.col(path).alias("__path"), F.explode(prefixes).alias("__prefix")).join(own, "__prefix")
    best = found.groupBy("__path").agg(F.max_by("__allow", F.length("__prefix")).alias("__best"))
    return df.join(best, F.col(path) == F.col("__path"), "left").select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("__best", F.lit(False)).alias(allowed))

"""Dimensional models: surrogate keys, unknown members, date dimensions in several roles, cubes, and builds in order of need."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import default_key

UNKNOWN = -1
#: Days that a date dimension may have (over 1,000 years); it is broadcast.
MOST_DAYS = 400_000


def date_dimension(spark: SparkSession, first: str, last: str) -> DataFrame:
    """A row a day: ``date_key`` (yyyymmdd), ``date`` and its parts."""
    days = spark.sql(f"SELECT datediff(DATE'{first}', DATE'{last}')").first()[0]
    if not 0 <= -days < MOST_DAYS:
        raise ValueError(f"a date dimension has 1 to {MOST_DAYS} days, not {1 - days}")
    day = spark.range(1 - days).select(F.date_add(F.lit(first).cast("date"), F.col("id").cast("int")).alias("date"))
    return day.select(
        (F.year("date") * 10000 + F.month("date") * 100 + F.dayofmonth("date")).alias("date_key"), "date", F.year("date").alias("year"), F.quarter("date").alias("quarter"),
        F.month("date").alias("month"), F.weekday("date").alias("weekday"), (F.date_format("date", "yyyyMM").cast("int")).alias("month_key"),
    )


def with_dates(fact: DataFrame, dates: DataFrame, roles: dict[str, Column], attributes: list[str] = ("date_key",)) -> DataFrame:
    """Keys and attributes of a date dimension in several roles: ``<role>_<attribute>``, -1 for keys of days it hasn't.

    The dimension is broadcast once and looked up by every role; it has MOST_DAYS rows at most.
    """
    small = F.broadcast(dates.select(F.col("date").alias("__day"), *attributes))
    for role, day in roles.items():
        looked = fact.withColumn("__of", day.cast("date")).join(small, F.col("__of") == F.col("__day"), "left")
        named = [(default_key(F.col(a), UNKNOWN) if a.endswith("_key") else F.col(a)).alias(f"{role}_{a}") for a in attributes]
        fact = looked.select(*[F.col(f"`{c}`") for c in fact.columns], *named)
    return fact


@dataclass
class Lookup:
    """A dimension that a fact finds by business keys: fact column (or expression) to dimension column, then what it takes from it."""

    name: str
    dimension: DataFrame
    on: dict[str, str | Column]
    takes: dict[str, str]
    normalized: bool = False


def star(fact: DataFrame, lookups: list[Lookup]) -> DataFrame:
    """The fact with keys of its dimensions, -1 where one is missing, in the order given. Rows of the fact neither go nor multiply.

    A dimension must have a business key once, which is checked as it is joined. Blanks around
    and the case of keys don't count where a lookup is ``normalized``. Nulls find nothing.
    """
    for x in lookups:
        form = (lambda c: F.upper(F.trim(c.cast("string")))) if x.normalized else (lambda c: c)
        names = [f"__k{i}" for i in range(len(x.on))]
        keys = [form(F.col(f"`{c}`")).alias(k) for k, c in zip(names, x.on, strict=True)]
        one = x.dimension.select(*keys, *[F.col(f"`{v}`").alias(f"__v{i}") for i, v in enumerate(x.takes.values())]).dropna(subset=names)
        checked = F.when(F.count("*") > 1, F.raise_error(F.lit(f"{x.name}: a business key stands in several rows"))).otherwise(F.first(F.struct(*[f"__v{i}" for i in range(len(x.takes))])))
        one = one.groupBy(*names).agg(checked.alias("__found"))
        own = [form(F.col(f"`{v}`") if isinstance(v, str) else v).alias(f"__f{i}") for i, v in enumerate(x.on.values())]
        side = fact.select(*[F.col(f"`{c}`") for c in fact.columns], *own)
        meets = reduce(lambda a, b: a & b, [F.col(f"__f{i}") == F.col(k) for i, k in enumerate(names)])
        fact = side.join(one, meets, "left").select(*[F.col(f"`{c}`") for c in fact.columns], *[default_key(F.col(f"__found.__v{i}"), UNKNOWN).alias(k) for i, k in enumerate(x.takes)])
    return fact


def cube(df: DataFrame, dimensions: list[str], measures: dict[str, Column], also: dict[str, Column] | None = None, most: int = 10) -> DataFrame:
    """Measures by every combination of the dimensions: what isn't chosen is null, ``chosen`` names what is.

    ``measures`` are sums or counts by name, made once for the finest grouping; the cube adds these
    up. ``also`` are measures made of them (ratios). Null values of a dimension are told from
    those not chosen by ``grouping_id``.
    """
    if not 0 < len(dimensions) <= most:
        raise ValueError(f"a cube has 1 to {most} dimensions, not {len(dimensions)}")
    fine = df.groupBy(*dimensions).agg(*[m.alias(k) for k, m in measures.items()])
    sums = fine.cube(*dimensions).agg(F.grouping_id().cast("long").alias("grouping_id"), *[F.sum(k).alias(k) for k in measures])
    n = len(dimensions)
    names = F.array_compact(F.array(*[F.when(F.shiftright("grouping_id", n - 1 - i).bitwiseAND(1) == 0, F.lit(d)) for i, d in enumerate(dimensions)]))
    return sums.withColumn("chosen", F.array_join(names, ",")).withColumns(also or {})


@dataclass
class Model:
    """Tables of a model, each built once from those it needs."""

    builds: dict[str, tuple[list[str], Callable[..., DataFrame]]] = field(default_factory=dict)

    def table(self, name: str, needs: list[str] = ()):
        """Register a function of the needed frames."""

        def add(build: Callable[..., DataFrame]):
            self.builds[name] = (list(needs), build)
            return build

        return add

    def groups(self) -> list[list[str]]:
        """Tables that may be built side by side, group after group."""
        if missing := {n for needs, _ in self.builds.values() for n in needs} - set(self.builds):
            raise ValueError(f"tables that nothing builds: {sorted(missing)}")
        done, out = set(), []
        while len(done) < len(self.builds):
            ready = [n for n, (needs, _) in self.builds.items() if n not in done and set(needs) <= done]
            if not ready:
                raise ValueError(f"tables that need each other: {sorted(set(self.builds) - done)}")
            out.append(ready)
            done |= set(ready)
        return out

    def build(self, spark: SparkSession, save: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> dict[str, DataFrame]:
        """All frames by name. ``save`` may store each and give back what later ones read."""
        found: dict[str, DataFrame] = {}
        for group in self.groups():
            for name in group:
                needs, build = self.builds[name]
                found[name] = save(name, build(spark, *[found[n] for n in needs]))
        return found

"""As-of and temporal-dimension joins.

A key's rows are ordered in one task unless ``blocks`` is over 1: then histories are cut at
quantiles of time, each block is ordered by itself, and what a block ends with is carried on
by a window over blocks, of which a key has no more than that. A key that holds a third of
all rows is spread over as many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import layout


def _blocks(df: DataFrame, time: str, blocks: int) -> Column:
    """The block of each row's time: equal times are in one block, later ones in the same or a later one."""
    number = layout.as_number(F.col(f"`{time}`"), df.schema[time].dataType)
    cuts = df.agg(F.percentile_approx(number, [k / blocks for k in range(1, blocks)], 10_000)).first()[0]
    return layout.rank(number, sorted(set(cuts or [])))


def carried(df: DataFrame, key: str, time: str, order: list[Column], value: Column, name: str, blocks: int = 1) -> DataFrame:
    """Rows with the last value that isn't null at or before them in their key, in the order of time and then ``order``."""
    if blocks == 1:
        w = Window.partitionBy(key).orderBy(time, *order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(name, F.last(value, ignorenulls=True).over(w))
    cut = df.withColumns({"__block": _blocks(df, time, blocks), "__value": value})
    w = Window.partitionBy(key, "__block").orderBy(time, *order).rowsBetween(Window.unboundedPreceding, 0)
    within = cut.withColumn("__in", F.last("__value", ignorenulls=True).over(w))
    place = F.struct(F.col(time).alias("t"), *[c.alias(f"o{i}") for i, c in enumerate(order)])
    ends = cut.groupBy(F.col(key).alias("__key"), F.col("__block").alias("__of")).agg(F.max_by("__value", F.when(F.col("__value").isNotNull(), place)).alias("__end"))
    before = Window.partitionBy("__key").orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("__before", F.last("__end", ignorenulls=True).over(before)).where("__before IS NOT NULL")
    both = within.join(ends, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__block") == F.col("__of")), "left")
    return both.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("__in", "__before").alias(name))


def as_of(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, value: str, name: str, blocks: int = 1) -> DataFrame:
    """Each left row with the value of the latest right row of its key at or before its time.

    Both sides are unioned and the last right value carried forward, so no pairs are made.
    Of right rows of equal time the largest value counts.
    """
    l = left.withColumns({"__t": F.col(left_time), "__side": F.lit(1), "__v": F.lit(None).cast(right.schema[value].dataType)})
    r = right.select(key, F.col(right_time).alias("__t"), F.lit(0).alias("__side"), F.col(value).alias("__v"))
    both = carried(l.unionByName(r, allowMissingColumns=True), key, "__t", [F.col("__side"), F.col("__v")], F.col("__v"), name, blocks)
    return both.where("__side = 1").select(*left.columns, name)


def as_of_within(df: DataFrame, key: str, time: str, right: Column, value: str, name: str, blocks: int = 1) -> DataFrame:
    """``as_of`` where both sides are rows of one frame, told apart by ``right``: one scan, one shuffle. All rows stay.

    A row's own time counts; of right rows of equal time the largest value counts.
    """
    found = F.when(right, F.col(value))
    return carried(df, key, time, [(~right).cast("int"), found], found, name, blocks)


def versions(df: DataFrame, key: str, time: str, tie: str, blocks: int = 1) -> DataFrame:
    """Half-open validity intervals ``[valid_from, valid_to)`` of a key's successive rows."""
    if blocks == 1:
        w = Window.partitionBy(key).orderBy(time, tie)
        out = df.withColumns({"valid_from": F.col(time), "valid_to": F.lead(time).over(w)})
    else:
        cut = df.withColumn("__block", _blocks(df, time, blocks))
        firsts = cut.groupBy(F.col(key).alias("__key"), F.col("__block").alias("__of")).agg(F.min(time).alias("__first"))
        firsts = firsts.withColumn("__next", F.lead("__first").over(Window.partitionBy("__key").orderBy("__of"))).where("__next IS NOT NULL")
        within = cut.withColumn("__to", F.lead(time).over(Window.partitionBy(key, "__block").orderBy(time, tie)))
        both = within.join(firsts, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__block") == F.col("__of")), "left")
        out = both.select(*[F.col(f"`{c}`") for c in df.columns], F.col(time).alias("valid_from"), F.coalesce("__to", "__next").alias("valid_to"))
    return out.withColumn("is_current", F.col("valid_to").isNull().cast("int"))


def version_at(facts: DataFrame, dim: DataFrame, key: str, time: str, value: str, latest_if_none: bool, blocks: int = 1) -> DataFrame:
    """Facts with the value of the version valid at their time, or else of the key's latest one.

    ``dim`` has half-open intervals that don't overlap, so the last start at or before a
    time is the version. Of equal starts the one with the later end counts.
    """
    start = dim.groupBy(key, "valid_from").agg(F.max_by(value, F.coalesce("valid_to", F.lit("9999-12-31").cast("timestamp"))).alias("__value"))
    out = as_of(facts, start, key, time, "valid_from", "__value", value, blocks)
    if not latest_if_none:
        return out
    last = dim.groupBy(key).agg(F.max_by(value, F.struct(F.coalesce("valid_to", F.lit("9999-12-31").cast("timestamp")), "valid_from")).alias("__last"))
    return out.join(last, key, "left").withColumn(value, F.coalesce(value, "__last")).drop("__last")

"""Load strategies as pure functions of target and source frames.

Strategies that change rows take ``action``, a column to add: what became of each row, by
the letters of ACTIONS. A store reads it in the pass that writes the rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: I inserted, U updated, D marked as deleted or ended, K kept.
ACTIONS = ("I", "U", "D", "K")


def _meets(keys: list[str], a: str, b: str):
    """Equal keys; a null meets a null, so a replayed batch finds its own rows again."""
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"{a}.`{k}`").eqNullSafe(F.col(f"{b}.`{k}`"))
    return on


def _without(df: DataFrame, keys_of: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the other frame doesn't have."""
    return df.alias("d").join(keys_of.select(*keys).alias("k"), _meets(keys, "d", "k"), "left_anti")


def _hashed_as(key: str, kind: T.DataType) -> list[Column]:
    """What a null-safe join hashes of a key, so that a window before it needs no exchange of its own."""
    zero = F.lit("").cast(kind) if isinstance(kind, T.StringType) else F.lit(0).cast(kind) if isinstance(kind, T.NumericType) else None
    return [F.col(f"`{key}`")] if zero is None else [F.coalesce(F.col(f"`{key}`"), zero), F.col(f"`{key}`").isNull()]


def single(source: DataFrame, keys: list[str], what: str) -> DataFrame:
    """The source, or an error if a key repeats; one pass over it."""
    window = Window.partitionBy(*[c for k in keys for c in _hashed_as(k, source.schema[k].dataType)])
    counted = source.withColumn("__n", F.count("*").over(window))
    return counted.where(F.when(F.col("__n") > 1, F.raise_error(f"{what}: several source rows for one key").cast("boolean")).otherwise(True)).drop("__n")


def _both(target: DataFrame, source: DataFrame, keys: list[str], how: str = "full_outer") -> tuple[DataFrame, Column, Column]:
    """Rows ``t`` and ``s`` of equal keys side by side, and whether each is there."""
    t, s = target.withColumn("__t", F.lit(True)).alias("t"), source.withColumn("__s", F.lit(True)).alias("s")
    return t.join(s, _meets(keys, "t", "s"), how), F.col("__t").isNotNull(), F.col("__s").isNotNull()


def _as(action: str | None, value: Column) -> list[Column]:
    return [value.alias(action)] if action else []


def overwrite(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    return source


def append(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    return target.unionByName(source, allowMissingColumns=True)


def append_new(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows of keys that the target doesn't have, null keys included, added. A key repeated in the source is an error."""
    return append(target, _new_rows(target, source, keys), keys)


def _new_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    return _without(single(source, keys, "append_new"), target, keys)


def overwrite_by_key(target: DataFrame, source: DataFrame, keys: list[str], action: str | None = None) -> DataFrame:
    """The target's rows of the source's keys, null keys included, replaced."""
    kept, new = _without(target, source, keys), source
    if action:
        kept, new = kept.withColumn(action, F.lit("K")), new.withColumn(action, F.lit("I"))
    return append(kept, new, keys)


def _columns(target: DataFrame, source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with the columns of either (the target's first); what one hasn't is null."""
    kinds = {f.name: f.dataType for f in [*source.schema, *target.schema]}
    names = target.columns + [c for c in source.columns if c not in target.columns]
    return tuple(df.select(*[(F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in names]) for df in (target, source))


def merge(target: DataFrame, source: DataFrame, keys: list[str], changed: list[str] | None = None, action: str | None = None) -> DataFrame:
    """Rows of the source's keys updated, new ones inserted, the rest kept; new columns are added.

    With ``changed`` a row is updated only if one of these columns differs (null-safe). A null key
    meets a null key. A key repeated in the source is an error. A target column that the source
    hasn't keeps its value.
    """
    own = set(source.columns)
    target, source = _columns(target, source)
    both, there, given = _both(target, single(source, keys, "merge"), keys)
    differs = F.lit(changed is None)
    for c in changed or ():
        differs = differs | ~F.col(f"t.`{c}`").eqNullSafe(F.col(f"s.`{c}`"))
    take = given & (~there | differs)
    what = F.when(~there, "I").when(take, "U").otherwise("K")
    return both.select(*[(F.when(take, F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")) if c in own else F.col(f"t.`{c}`")).alias(c) for c in target.columns], *_as(action, what))


def update_matched(target: DataFrame, source: DataFrame, keys: list[str], action: str | None = None) -> DataFrame:
    """The target's rows with the source's non-null values where keys meet (null meets null); nothing is inserted."""
    values = [c for c in source.columns if c not in keys]
    both, _, given = _both(target, single(source, keys, "update_matched"), keys, "left")
    return both.select(
        *[(F.coalesce(F.col(f"s.`{c}`"), F.col(f"t.`{c}`")) if c in values else F.col(f"t.`{c}`")).alias(c) for c in target.columns],
        *_as(action, F.when(given, "U").otherwise("K")),
    )


def update_where(target: DataFrame, condition: Column, values: dict, action: str | None = None) -> DataFrame:
    """UPDATE .. SET .. WHERE: new values where the condition holds (unknown: it doesn't)."""
    holds = F.coalesce(condition, F.lit(False))
    new = {c: F.when(holds, v).otherwise(F.col(c)) for c, v in values.items()}
    return target.withColumns(new | ({action: F.when(holds, "U").otherwise("K")} if action else {}))


def merge_guarded(target: DataFrame, source: DataFrame, keys: list[str], keep: list[str] = ("dl_createddateutc",), hash_column: str = "dl_rowhash", null_safe: bool = False, action: str = "dl_action") -> DataFrame:
    """Merge with ``dl_action``: I inserted, U updated as the hashes differ, K kept.

    A null key meets nothing unless ``null_safe``; a null hash is no difference;
    columns in ``keep`` stay as they were on an update. Columns of one side only are
    null in the other. A key repeated in the source is an error.
    """
    target, source = _columns(target, source)
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(f"`{k}`").isNotNull()
    # Only keys that can meet a target row must be single.
    matched, loose = (source, None) if null_safe else (source.where(whole), source.where(~whole))
    both, there, _ = _both(target, single(matched, keys, "merge"), keys)
    what = F.when(~there, "I").when(F.col(f"t.`{hash_column}`") != F.col(f"s.`{hash_column}`"), "U").otherwise("K")
    out = both.select(*[F.when(~there | ((what == "U") & F.lit(c not in keep)), F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c) for c in target.columns], what.alias(action))
    return out if loose is None else out.unionByName(loose.withColumn(action, F.lit("I")))


def cdc_apply(
    target: DataFrame, changes: DataFrame, keys: list[str], op: str = "op", hash_column: str | None = None, modified: str | None = None, now: Column | None = None,
    keep_unknown_deletes: bool = False, action: str | None = None,
) -> DataFrame:
    """Net changes (one a key) on a target with ``is_deleted, is_current``: a delete keeps the row's values and marks it.

    A null key meets a null key; a key repeated in the changes is an error; the delete of an
    unknown key adds nothing unless ``keep_unknown_deletes``. With ``hash_column`` a row is
    updated only if its hash differs or it was deleted; a delete of a deleted row changes
    nothing. ``modified`` gets ``now`` in rows that are inserted, updated or deleted.
    """
    marks = ["is_deleted", "is_current", *([modified] if modified else [])]
    values = [c for c in target.columns if c not in [*keys, *marks]]
    both, there, given = _both(target, single(changes.select(*keys, *values, op), keys, "cdc_apply"), keys)
    gone, was = F.col(f"s.`{op}`") == "delete", F.col("t.is_deleted").eqNullSafe(1)
    differs = F.lit(True) if hash_column is None else was | ~F.col(f"t.`{hash_column}`").eqNullSafe(F.col(f"s.`{hash_column}`"))
    what = F.when(~there, "I").when(~given, "K").when(gone & ~was, "D").when(~gone & differs, "U").otherwise("K")
    if not keep_unknown_deletes:
        both = both.where(there | ~gone)
    taken = what.isin("I", "U")
    picked = [F.when(taken, F.col(f"s.`{v}`")).otherwise(F.col(f"t.`{v}`")).alias(v) for v in values]
    flags = [F.when(given, f).otherwise(F.col(f"t.{n}")).alias(n) for n, f in (("is_deleted", gone.cast("int")), ("is_current", (~gone).cast("int")))]
    time = [F.when(what == "K", F.col(f"t.`{modified}`")).otherwise(now).alias(modified)] if modified else []
    return both.select(*[F.when(there, F.col(f"t.`{k}`")).otherwise(F.col(f"s.`{k}`")).alias(k) for k in keys], *picked, *flags, *time, *_as(action, what))


def scd2(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], now: Column, action: str | None = None) -> DataFrame:
    """History of versions: ``active_start, active_end, is_current`` beside the columns.

    Changed current rows end at ``now`` and get a new version, new keys get their
    first, equal rows and keys missing from the source stay, and so do rows that aren't
    current or don't say. A key repeated in the source is an error. A null key meets a
    null key, so a replayed batch adds no version.
    """
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"t.`{c}`").eqNullSafe(F.col(f"s.`{c}`"))
    marked = F.coalesce(F.col("is_current") == 1, F.lit(False))
    both, there, given = _both(target.where(marked), single(source.select(*keys, *columns), keys, "scd2"), keys)
    key = [F.when(there, F.col(f"t.`{k}`")).otherwise(F.col(f"s.`{k}`")).alias(k) for k in keys]
    fresh, ended = given & (~there | ~same), there & given & ~same

    def version(side: str, start: Column, end: Column, current: Column, what: Column) -> Column:
        return F.struct(*[F.col(f"{side}.`{c}`").alias(c) for c in columns], start.alias("active_start"), end.alias("active_end"), current.alias("is_current"), what.alias(action or "__what"))

    old = F.when(there, version("t", F.col("t.active_start"), F.when(ended, now).otherwise(F.col("t.active_end")), F.when(ended, 0).otherwise(1), F.when(ended, "U").otherwise("K")))
    new = F.when(fresh, version("s", now, F.lit(None).cast("timestamp"), F.lit(1), F.lit("I")))
    rows = both.select(*key, F.explode(F.array_compact(F.array(old, new))).alias("v")).select(*keys, "v.*")
    past = target.where(~marked).withColumn(action or "__what", F.lit("K")).select(rows.columns)
    return past.unionByName(rows).drop(*([] if action else ["__what"]))


def scd2_synced(target: DataFrame, source: DataFrame, keys: list[str], now: Column, action: str | None = None) -> DataFrame:
    """``scd2`` after both sides got the same columns: a plain target becomes a first version, new source columns are added."""
    marks = {"active_start": F.lit(None).cast("timestamp"), "active_end": F.lit(None).cast("timestamp"), "is_current": F.lit(1)}
    target = target.withColumns({c: v for c, v in marks.items() if c not in target.columns})
    plain = [c for c in target.columns if c not in marks]
    wide, source = _columns(target.select(*plain), source)
    added = [c for c in wide.columns if c not in plain]
    target = target.withColumns({c: F.lit(None).cast(wide.schema[c].dataType) for c in added})
    return scd2(target, source, keys, [c for c in wide.columns if c not in keys], now, action)


def capture_deletions(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the target that the source no longer has (a null meets a null)."""
    return _without(target, source, keys).select(*keys)


def soft_delete(target: DataFrame, source: DataFrame, keys: list[str], now: Column, action: str | None = None) -> DataFrame:
    """The target with rows that a full extract no longer has marked: ``is_deleted`` and, at the first time, ``deleted_at``.

    A row that the extract has again is unmarked. Keys may repeat in the extract.
    """
    base = target.withColumns({c: v for c, v in {"is_deleted": F.lit(0), "deleted_at": F.lit(None).cast("timestamp")}.items() if c not in target.columns})
    both, _, given = _both(base, source.select(*keys).distinct(), keys, "left")
    was = F.col("is_deleted") == 1
    what = F.when(~given & ~F.coalesce(was, F.lit(False)), "D").when(given & was, "U").otherwise("K")
    plain = [F.col(f"t.`{c}`") for c in base.columns if c not in ("is_deleted", "deleted_at")]
    return both.select(*plain, (~given).cast("int").alias("is_deleted"), F.when(~given, F.coalesce("deleted_at", now)).alias("deleted_at"), *_as(action, what))


#: Strategies by name; what stands after the keys are options of ``load``.
STRATEGIES: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f for f in (overwrite, append, append_new, overwrite_by_key, merge, merge_guarded, update_matched, cdc_apply, scd2, scd2_synced, soft_delete)
}
#: Strategies that only add rows; a store needn't rewrite the table for them.
ADDING = {"append": lambda target, source, keys: source, "append_new": _new_rows}
#: Strategies that change rows of the source's keys alone and take ``action``; a store rewrites only what holds such rows.
KEYED = ("overwrite_by_key", "merge", "merge_guarded", "update_matched", "cdc_apply", "scd2")


def load(name: str, target: DataFrame | None, source: DataFrame, keys: list[str], **options) -> DataFrame:
    """Apply a strategy by name (``X`` or ``X_load``); without a target it is a first load."""
    plain = name.lower().removesuffix("_load")
    if plain not in STRATEGIES:
        raise ValueError(f"unknown load strategy {name!r}")
    return source if target is None else STRATEGIES[plain](target, source, keys, **options)

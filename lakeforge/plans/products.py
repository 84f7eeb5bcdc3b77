"""Products: specs of the template form, checked, run over stored tables and committed, with surrogate keys, an unknown member and incremental sources."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import loads
from ..store import Marks, TableStore
from . import run_queries, specs, with_identity, with_unknown

#: What an unknown member has in columns of a type.
UNKNOWN = {T.StringType: "unknown", T.BooleanType: False}


def stored_name(part: dict) -> str:
    return ".".join(str(part[k]) for k in ("lakehouse", "schema", "table"))


@dataclass
class Product:
    """What a run did: the version it made (None: no source had changed) and the columns that hold no personal data."""

    table: str
    version: int | None
    safe_columns: list[str]


def _unknown_row(df: DataFrame, key: str) -> DataFrame:
    values = {f.name: UNKNOWN.get(type(f.dataType)) for f in df.schema}
    return with_unknown(df, values | {key: -1})


def _identified(old: DataFrame | None, rows: DataFrame, keys: list[str], name: str, versions: bool) -> DataFrame:
    """Rows with the ids of the table where it has their keys, and new ones above its largest elsewhere; with ``versions`` all are new."""
    if name in rows.columns:
        raise ValueError(f"a query has the identity column {name}")
    if old is None:
        return with_identity(rows, name, keys or rows.columns)
    start = old.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
    if versions:
        return with_identity(rows, name, keys, max(0, start))
    known = old.select(*keys, name).alias("o")
    both = rows.alias("n").join(known, loads._meets(keys, "n", "o"), "left").select("n.*", name)
    new = with_identity(both.where(F.col(name).isNull()).drop(name), name, keys, max(0, start))
    return both.where(F.col(name).isNotNull()).unionByName(new)


def run_product(spark: SparkSession, spec: dict, store: TableStore, now=None) -> Product:
    """Check a spec, run its queries over the store's tables (named lakehouse.schema.table) and load its target.

    ``source[].incremental`` gives queries the rows that changed since the spec's last good run;
    with nothing new in any source nothing is done. ``identity`` numbers rows in a column
    (``<table>_key`` by default): a key keeps its number, versions of ``type_two`` get their own.
    ``unknown_record`` adds a member with the number -1 at the first load.
    """
    if found := specs.problems(spark, spec):
        raise ValueError("; ".join(found))
    target, name = spec["target"], stored_name(spec["target"])
    keys, how = list(target.get("key_columns") or []), target["load_strategy"]
    sources = spec.get("source") or []
    versions = {stored_name(s): store.newest(stored_name(s)) for s in sources}
    if missing := [s for s, v in versions.items() if v is None]:
        raise ValueError(f"sources without a version: {missing}")
    marks = Marks(store, name)
    seen, fresh = marks.read(), [stored_name(s) for s in sources if s.get("incremental")]
    safe = [c for c in (store.read(name).columns if store.exists(name) else []) if c not in (target.get("pii_columns") or [])]
    if fresh and seen == versions:
        return Product(name, None, safe)

    def reader(table: str):
        if table in fresh:
            return lambda own: TableStore(own, store.root).changes(table, seen.get(table), versions[table]).where("_change <> 'delete'").drop("_change")
        return lambda own: TableStore(own, store.root).read(table, versions[table])

    rows = run_queries(spark, {s["name"]: reader(stored_name(s)) for s in sources}, [(q["name"], q["sql"]) for q in spec["query"]], spec["query"][-1].get("drop") or [])
    own = TableStore(rows.sparkSession, store.root)
    old = own.read(name) if own.exists(name) else None
    key = target.get("identity_column_name") or f"{target['table']}_key"
    options: dict = {}
    if how == "type_two":
        now = F.current_timestamp() if now is None else now
        columns = [c for c in rows.columns if c not in keys]
        if old is None:
            rows = rows.withColumns({"active_start": now, "active_end": F.lit(None).cast("timestamp"), "is_current": F.lit(1)})
        else:
            base = old.drop(key) if target.get("identity") else old
            made = loads.scd2(base, rows, keys, columns, now, "__action")
            if target.get("identity"):  # rows that stood there keep their numbers, new versions get theirs
                ids = old.select(*keys, "active_start", key).alias("o")
                stood = made.where("__action <> 'I'").drop("__action").alias("m")
                stood = stood.join(ids, loads._meets([*keys, "active_start"], "m", "o"), "left").select("m.*", key)
                made = stood.unionByName(_identified(old, made.where("__action = 'I'").drop("__action"), keys, key, True))
            else:
                made = made.drop("__action")
            rows = made.select(*old.columns)
        plain = "overwrite"
    else:
        plain = how
    if target.get("identity") and key not in rows.columns:
        rows = _identified(old, rows, keys, key, False)
    if target.get("unknown_record") and (old is None or how == "overwrite"):
        rows = _unknown_row(rows, key if key in rows.columns else keys[0])
    batch = f"{name}#{sum(versions.values())}" if fresh else None
    version = own.load(name, plain, rows, keys, batch, target.get("partition_by"), **options)
    marks.write(versions)
    return Product(name, version, [c for c in rows.columns if c not in (target.get("pii_columns") or [])])

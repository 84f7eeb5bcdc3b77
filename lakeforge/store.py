"""Versioned Parquet tables: immutable files in pieces, and a commit log.

``<table>/data/<piece>/`` holds the files that one commit wrote and ``<table>/log/<version>.json``
what it added and took away, with the table's schema, each new file's rows, bytes and column
bounds, and the counts of the load. Every CHECKPOINT versions the whole state is written
beside, so reading a table takes few small files of the log.

Loads that change rows by key find the files that hold such rows (by the bounds of the
batch's keys, then by a semi-join of keys and file names), and rewrite those alone. A log
entry is written aside and then published under its name if that is free, so a reader sees
whole entries only and of two writers one fails; rows that depend on no version are
published again at the next one, loads are planned again. All access goes through Hadoop's
file system, so any store that Spark opens will do; where its rename isn't atomic, as in some
object stores, a table needs one writer.
"""

from __future__ import annotations

import datetime
import json
import random
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators import layout, loads

CHECKPOINT = 10
#: Bounds of longer strings aren't kept.
BOUND_CHARS = 64
#: Types whose bounds are kept as texts.
CALENDAR = (T.DateType, T.TimestampNTZType)


class ConcurrentCommit(RuntimeError):
    """Another writer committed the version first."""


def bound_form(c: Column, kind: T.DataType) -> Column | None:
    """A column in a form whose order JSON keeps, or None for types without bounds."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c.cast("double"))
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return c.cast("string")
    return None


def bounds_of(df: DataFrame, columns: list[str]) -> list[Column]:
    """Aggregates ``<column>`` (least, largest, how many have none) for those columns that have bounds."""
    out = []
    for c in columns:
        kind = df.schema[c].dataType if c in df.columns else None
        value = F.col(f"`{c}`")
        form = bound_form(value, kind)
        if form is None:
            continue
        if isinstance(kind, CALENDAR):  # as texts they would be sorted to be aggregated, and beyond four digits of a year their order isn't that of time
            first, last = F.min(value), F.max(value)
            inside = F.coalesce((F.year(first) >= 0) & (F.year(last) <= 9999), F.lit(True))
            out.append(F.when(inside, F.struct(bound_form(first, kind).alias("low"), bound_form(last, kind).alias("high"), F.count_if(value.isNull()).alias("none"))).alias(c))
            continue
        out.append(F.struct(F.min(form).alias("low"), F.max(form).alias("high"), F.count_if(form.isNull()).alias("none")).alias(c))
    return out


def per_file(rows: DataFrame, bounded: list[str]) -> DataFrame:
    """Rows and bounds by file: ``__path, __rows``, the bounded columns, and a set that means nothing."""
    found = [F.count("*").alias("__rows"), *bounds_of(rows, bounded)]
    texts = any(c in rows.columns and isinstance(rows.schema[c].dataType, T.StringType) for c in bounded)
    # Least texts alone make Spark sort all rows by file; beside a set they are kept by hash, a buffer a file.
    return rows.groupBy(F.col("_metadata.file_path").alias("__path")).agg(*found, *([F.collect_set(F.lit(0)).alias("__set")] if texts else []))


def _plain(bound) -> list | None:
    """Bounds as JSON; None where they are of no use."""
    if bound is None or (isinstance(bound["high"], str) and max(len(bound["low"]), len(bound["high"])) > BOUND_CHARS):
        return None
    return [bound["low"], bound["high"], bound["none"]]


def may_hold(bounds: list | None, low, high, nulls: bool) -> bool:
    """Whether rows within the bounds can be between ``low`` and ``high`` (None: open; both None with ``nulls``: only nulls count)."""
    if bounds is None:
        return True
    least, most, none = bounds
    if nulls and none:
        return True
    return least is not None and not (low is None and high is None and nulls) and (high is None or least <= high) and (low is None or most >= low)


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- files

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _fs(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        fs = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _text(self, text: str) -> str:
        path = self._path(text)
        stream = self._fs(path).open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _publish(self, text: str, content: str) -> bool:
        """Write a file aside and give it its name; False if the name is taken."""
        path = self._path(text)
        aside = self._path(f"{path.getParent()}/.{uuid.uuid4().hex}.tmp")
        fs, jvm = self._fs(path), self.spark._jvm
        out = fs.create(aside, False)
        out.write(bytearray(content.encode()))
        out.close()
        try:
            if fs.getScheme() == "file":  # a local rename replaces; a link doesn't
                name, held = (jvm.java.io.File(p.toUri().getPath()).toPath() for p in (path, aside))
                jvm.java.nio.file.Files.createLink(name, held)
            else:
                none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self.spark._jsc.hadoopConfiguration()).rename(aside, path, none)
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            return False
        finally:
            fs.delete(aside, False)
        return True

    # --- the log

    def versions(self, name: str) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names(f"{self.root}/{name}/log") if n.removesuffix(".json").isdigit())

    def exists(self, name: str) -> bool:
        return bool(self.versions(name))

    def newest(self, name: str) -> int | None:
        known = self.versions(name)
        return known[-1] if known else None

    def history(self, name: str) -> DataFrame:
        """The commits: ``version, operation, rows, batch_id, at, metrics``."""
        kind = "version long, operation string, rows long, batch_id string, at timestamp, metrics map<string,long>"
        return self.spark.read.schema(kind).json(f"{self.root}/{name}/log/{'[0-9]' * 20}.json")

    def metrics(self, name: str, version: int) -> dict[str, int]:
        """What the commit of a version counted."""
        return json.loads(self._text(self._log(name, version)))["metrics"]

    def _log(self, name: str, version: int, kind: str = "json") -> str:
        return f"{self.root}/{name}/log/{version:020d}.{kind}"

    def _entry(self, name: str, version: int | None = None) -> dict:
        """The state of a version: its pieces (``data``), their ``files``, ``schema``, ``rows`` and ``batches``."""
        found = self._names(f"{self.root}/{name}/log")
        known = sorted(int(n.removesuffix(".json")) for n in found if n.removesuffix(".json").isdigit())
        version = known[-1] if version is None and known else version
        if version not in known:
            raise ValueError(f"table {name!r} has no version {version}")
        state, after = {"files": {}, "batches": {}}, -1
        for n in sorted(n for n in found if n.endswith(".checkpoint") and int(n.removesuffix(".checkpoint")) <= version)[-1:]:
            state = json.loads(self._text(f"{self.root}/{name}/log/{n}"))
            after = state["version"]
        for v in range(after + 1, version + 1):
            state = self._after(state, json.loads(self._text(self._log(name, v))))
        return state | {"data": list(state["files"])}

    @staticmethod
    def _after(state: dict, entry: dict) -> dict:
        files = {} if entry["replace"] else {p: dict(f) for p, f in state["files"].items()}
        for piece, gone in entry["remove"].items():
            files[piece] = {f: x for f, x in files[piece].items() if f not in gone}
        files |= entry["add"]
        batches = dict(state["batches"])
        if entry["batch_id"] is not None:
            source, _, number = entry["batch_id"].rpartition("#") if "#" in entry["batch_id"] else (entry["batch_id"], "", "0")
            batches[source] = [int(number), entry["version"]]
        return {k: entry[k] for k in ("version", "rows", "schema", "keys")} | {"files": {p: f for p, f in files.items() if f or p in entry["add"]}, "batches": batches}

    def _commit(self, name: str, entry: dict) -> int:
        if not self._publish(self._log(name, entry["version"]), json.dumps(entry)):
            raise ConcurrentCommit(f"{name} version {entry['version']}")
        if entry["version"] % CHECKPOINT == CHECKPOINT - 1:
            self._checkpoint(name, entry["version"])
        return entry["version"]

    def _checkpoint(self, name: str, version: int) -> None:
        self._publish(self._log(name, version, "checkpoint"), json.dumps(self._entry(name, version)))

    def _done(self, state: dict | None, batch_id: str | None) -> int | None:
        """The version that holds a batch, or a later one of its source. Batches of a source are numbered after ``#`` and come in order."""
        if state is None or batch_id is None:
            return None
        source, _, number = batch_id.rpartition("#") if "#" in batch_id else (batch_id, "", "0")
        last = state["batches"].get(source)
        return last[1] if last and int(number) <= last[0] else None

    # --- reading

    def _read(self, name: str, state: dict, files: dict[str, dict] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(state["schema"])
        paths = [f"{self.root}/{name}/data/{p}/{f}" for p, own in (state["files"] if files is None else files).items() for f in own]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, name: str, version: int | None = None, ranges: dict[str, tuple] | None = None) -> DataFrame:
        """A version's rows; with ``ranges`` (column: low, high; None is open) those within, from the files that can hold them."""
        state = self._entry(name, version)
        if not ranges:
            return self._read(name, state)
        schema = T.StructType.fromJson(state["schema"])
        names = list(ranges)
        limits = self._limits([v for c in names for v in ranges[c]], [schema[c].dataType for c in names for _ in (0, 1)])
        files = state["files"]
        for k, c in enumerate(names):
            files = {p: {f: x for f, x in own.items() if may_hold(x["bounds"].get(c), limits[2 * k], limits[2 * k + 1], False)} for p, own in files.items()}
        out = self._read(name, state, files)
        for c, (low, high) in ranges.items():
            kind = schema[c].dataType
            out = out if low is None else out.where(F.col(f"`{c}`") >= F.lit(low).cast(kind))
            out = out if high is None else out.where(F.col(f"`{c}`") <= F.lit(high).cast(kind))
        return out

    def _limits(self, values: list, kinds: list[T.DataType]) -> list:
        forms = [bound_form(F.lit(v).cast(k), k) for v, k in zip(values, kinds, strict=True)]
        found = self.spark.range(1).select(*[F.lit(None) if x is None else x for x in forms]).first()
        return [None if isinstance(k, CALENDAR) and v is not None and v[0] in "+-" else v for v, k in zip(found, kinds, strict=True)]

    # --- writing

    def _write(self, name: str, df: DataFrame, partition_by: list[str] | None, bounded: list[str]) -> tuple[str, dict]:
        """A new piece and what is known of its files. Partition columns stay in the files, so their types do; folders are named by copies."""
        piece = uuid.uuid4().hex
        folder = f"{self.root}/{name}/data/{piece}"
        copies = {f"in_{k}": F.col(f"`{c}`") for k, c in enumerate(partition_by or [])}
        (df.withColumns(copies).write.partitionBy(*copies) if copies else df.write).parquet(folder)
        base = self._fs(self._path(folder)).makeQualified(self._path(folder)).toUri().getPath()
        found, listed = {}, self._fs(self._path(folder)).listFiles(self._path(folder), True)
        while listed.hasNext():
            status = listed.next()
            if status.getPath().getName().startswith("part-"):
                found[status.getPath().toUri().getPath().removeprefix(base).lstrip("/")] = {"bytes": status.getLen(), "rows": 0, "bounds": {}}
        if found:
            rows = self.spark.read.schema(df.schema).parquet(*[f"{folder}/{f}" for f in found])
            # Reads the bounded columns of the new files alone; without any, their footers.
            per = per_file(rows, bounded)
            for r in per.collect():  # a row a file, as in the log
                own = found[self._path(r["__path"]).toUri().getPath().removeprefix(base).lstrip("/")]
                own |= {"rows": r["__rows"], "bounds": {c: b for c in per.columns[2:] if c != "__set" and (b := _plain(r[c])) is not None}}
        return piece, {f: x for f, x in found.items() if x["rows"]}

    def _drop(self, name: str, piece: str) -> None:
        path = self._path(f"{self.root}/{name}/data/{piece}")
        self._fs(path).delete(path, True)

    def commit(
        self, name: str, df: DataFrame, operation: str, batch_id: str | None = None, partition_by: list[str] | None = None, base: int | None = -1, adds: bool = False,
        keys: list[str] | None = None, cluster_by: list[str] | None = None, remove: dict | None = None, action: str | None = None, n_files: int | None = None,
    ) -> int:
        """Write rows and make them the newest version, alone or (``adds``) beside the files of the version before, less those of ``remove``.

        A batch id that is in the log already changes nothing. ``base`` is the version that the rows
        were made from (None: there was none); -1 takes the newest one, for rows that depend on none,
        and then a version that comes between is no failure. ``action`` is a column of letters (see
        ``loads.ACTIONS``) that is counted as the rows are written and isn't kept. Files get bounds of
        ``keys``, ``partition_by`` and ``cluster_by``.
        """
        last = self.newest(name)
        state = None if last is None else self._entry(name, last)
        if (done := self._done(state, batch_id)) is not None:
            return done
        if base != -1 and base != last:
            raise ConcurrentCommit(f"{name} is at version {last}, the rows were made from {base}")
        keys = list(keys or (state or {}).get("keys") or [])
        if adds and state is not None:
            df = self._as_table(df, T.StructType.fromJson(state["schema"]), action)
        if cluster_by:  # before rows are counted: finding ranges reads them once more
            df = layout.clustered(df, cluster_by, n_files)
        seen = Observation()
        counts = [F.count_if(F.col(action) == a).alias(a) for a in loads.ACTIONS] if action else [F.count("*").alias("I")]
        rows = df.observe(seen, *counts)
        piece, files = self._write(name, rows.drop(action) if action else rows, partition_by, list(dict.fromkeys([*keys, *(partition_by or []), *(cluster_by or [])])))
        of = seen.get
        metrics = {"inserted": of["I"], "updated": of.get("U", 0), "deleted": of.get("D", 0), "kept": of.get("K", 0), "bytes": sum(x["bytes"] for x in files.values()), "files": len(files), "files_removed": sum(map(len, (remove or {}).values()))}
        gone = sum(state["files"][p][f]["rows"] for p, own in (remove or {}).items() for f in own) if remove else 0
        if remove:  # rows of a rewritten file that didn't come back
            metrics["deleted"] += max(0, gone - sum(of.get(a, 0) for a in ("U", "D", "K")))
        schema = json.loads((df.drop(action) if action else df).schema.json())
        for wait in range(100):
            before = state["rows"] if adds and state is not None else 0
            entry = {
                "version": 0 if last is None else last + 1, "operation": operation, "at": datetime.datetime.now(datetime.timezone.utc).isoformat(), "batch_id": batch_id,
                "rows": before - gone + sum(x["rows"] for x in files.values()), "schema": self._nullable(schema), "keys": keys, "replace": not adds, "add": {piece: files}, "remove": remove or {}, "metrics": metrics,
            }
            try:
                return self._commit(name, entry)
            except ConcurrentCommit:
                last = self.newest(name)
                state = self._entry(name, last)
                if (done := self._done(state, batch_id)) is not None or base != -1:
                    self._drop(name, piece)
                    if done is None:
                        raise
                    return done
                if adds:  # what came between may have added columns
                    schema = json.loads(T.StructType([*T.StructType.fromJson(state["schema"]), *[f for f in T.StructType.fromJson(schema) if f.name not in T.StructType.fromJson(state["schema"]).names]]).json())
                time.sleep(random.random() * min(2.0, 0.02 * 2**wait))
        raise ConcurrentCommit(f"{name}: other writers came first 100 times")

    @staticmethod
    def _nullable(schema: dict) -> dict:
        return schema | {"fields": [f | {"nullable": True} for f in schema["fields"]]}

    @staticmethod
    def _as_table(df: DataFrame, schema: T.StructType, action: str | None) -> DataFrame:
        """Columns in the table's order and types, new ones after them."""
        new = [c for c in df.columns if c not in schema.names]
        return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema], *[F.col(f"`{c}`") for c in new])

    def load(self, name: str, strategy: str, source: DataFrame, keys: list[str], batch_id: str | None = None, partition_by: list[str] | None = None, cluster_by: list[str] | None = None, attempts: int = 5, **options) -> int:
        """Load rows by a strategy on the newest version, again if another load came between.

        Strategies that only add write their new rows; those that change rows by key rewrite the
        files that hold such rows. The others rewrite the table.
        """
        plain = strategy.lower().removesuffix("_load")
        if plain not in loads.STRATEGIES:
            raise ValueError(f"unknown load strategy {strategy!r}")
        how = {"batch_id": batch_id, "partition_by": partition_by, "cluster_by": cluster_by, "keys": keys}
        for left in range(attempts - 1, -1, -1):
            base = self.newest(name)
            try:
                if base is None:
                    return self.commit(name, source, strategy, base=None, **how)
                if (done := self._done(self._entry(name, base), batch_id)) is not None:
                    return done
                if plain in ("append", "overwrite"):
                    return self.commit(name, source, strategy, adds=plain == "append", **how)
                if plain == "append_new":
                    return self.commit(name, loads.ADDING[plain](self.read(name, base), source, keys), strategy, base=base, adds=True, **how)
                if plain in loads.KEYED:
                    return self._load_touched(name, base, plain, strategy, source, options, how)
                rows = loads.load(strategy, self.read(name, base), source, keys, **options)
                return self.commit(name, rows, strategy, base=base, **how)
            except ConcurrentCommit:
                if not left:
                    raise
                time.sleep(random.random() * 0.1)
        raise AssertionError

    def _load_touched(self, name: str, base: int, plain: str, strategy: str, source: DataFrame, options: dict, how: dict) -> int:
        state, keys = self._entry(name, base), how["keys"]
        # The batch is read several times and must be the same each time.
        aside = f"{self.root}/{name}/aside/{uuid.uuid4().hex}"
        source.write.parquet(aside)
        try:
            batch = self.spark.read.schema(source.schema).parquet(aside)
            known = T.StructType.fromJson(state["schema"])
            spans = {c: b for c, b in batch.agg(F.count("*").alias("__rows"), *bounds_of(batch, [k for k in keys if known[k].dataType == batch.schema[k].dataType])).first().asDict().items() if c != "__rows" and b is not None}
            near = {p: {f: x for f, x in own.items() if all(may_hold(x["bounds"].get(c), b["low"], b["high"], b["none"] > 0) for c, b in spans.items())} for p, own in state["files"].items()}
            old = self._read(name, state, near)
            hit = loads._meets(keys, "o", "b")
            held = old.select(*keys, F.col("_metadata.file_path").alias("__path")).alias("o").join(batch.select(*keys).alias("b"), hit, "left_semi") if any(near.values()) else None
            paths = {self._path(r["__path"]).toUri().getPath() for r in held.select("__path").distinct().collect()} if held is not None else set()
            root = self._path(f"{self.root}/{name}/data")
            root = self._fs(root).makeQualified(root).toUri().getPath()
            touched = {p: {f: x for f, x in own.items() if f"{root}/{p}/{f}" in paths} for p, own in near.items()}
            touched = {p: own for p, own in touched.items() if own}
            action = "dl_action" if plain == "merge_guarded" else "__action"
            rows = loads.STRATEGIES[plain](self._read(name, state, touched), batch, keys, **options, action=action)
            return self.commit(name, rows, strategy, base=base, adds=True, remove={p: list(own) for p, own in touched.items()}, action=action, **how)
        finally:
            self._fs(self._path(aside)).delete(self._path(aside), True)

    def change_where(self, name: str, condition: Column, values: dict[str, Column] | None, bounds: dict[str, tuple] | None = None) -> int:
        """UPDATE (``values``) or DELETE (None) of rows where the condition holds; files without such rows stay.

        ``bounds`` are ranges that the condition implies; files beyond them aren't read.
        """
        base = self.newest(name)
        state = self._entry(name, base)
        paths = {self._path(r[0]).toUri().getPath() for r in self.read(name, base, bounds).where(condition).select(F.col("_metadata.file_path")).distinct().collect()} if state["rows"] else set()
        root = self._path(f"{self.root}/{name}/data")
        root = self._fs(root).makeQualified(root).toUri().getPath()
        touched = {p: own for p, all_ in state["files"].items() if (own := {f: x for f, x in all_.items() if f"{root}/{p}/{f}" in paths})}
        if not touched:
            return base
        old = self._read(name, state, touched)
        holds = F.coalesce(condition, F.lit(False))
        rows = loads.update_where(old, condition, values, "__action") if values is not None else old.where(~holds).withColumn("__action", F.lit("K"))
        return self.commit(name, rows, "delete" if values is None else "update", base=base, adds=True, remove={p: list(own) for p, own in touched.items()}, action="__action")

    # --- between versions

    def changes(self, name: str, since: int | None, until: int | None = None, keys: list[str] | None = None) -> DataFrame:
        """Rows that differ between two versions with ``_change``: insert, update (new values) or delete (old values).

        Only files of one of the versions are read; ``since`` None takes every row as inserted. Rows
        are told apart by ``keys`` (the table's by default; nulls meet), which must be unique where
        files were rewritten. Without keys rows are inserted or deleted, as often as they stand there.
        """
        new = self._entry(name, until)
        old = self._entry(name, since) if since is not None else {"files": {}, "schema": new["schema"]}
        keys = list(keys if keys is not None else new["keys"])

        def only(a: dict, b: dict) -> dict:
            return {p: {f: x for f, x in own.items() if f not in b["files"].get(p, {})} for p, own in a["files"].items()}

        came, went = only(new, old), only(old, new)
        after = self._read(name, new, came)
        if not any(went.values()):
            return after.withColumn("_change", F.lit("insert"))
        before = self._as_table(self._read(name, old, went), after.schema, None).select(*after.columns)
        if not keys:
            return after.exceptAll(before).withColumn("_change", F.lit("insert")).unionByName(before.exceptAll(after).withColumn("_change", F.lit("delete")))
        both, was, is_ = loads._both(before, after, keys)
        same = F.lit(True)
        for c in after.columns:
            same = same & F.col(f"t.`{c}`").eqNullSafe(F.col(f"s.`{c}`"))
        change = F.when(~was, "insert").when(~is_, "delete").when(~same, "update")
        return both.select(*[F.when(is_, F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c) for c in after.columns], change.alias("_change")).where("_change IS NOT NULL")

    def compact(self, name: str, cluster_by: list[str] | None = None, n_files: int | None = None) -> int:
        """The same rows in new files, laid out by ``cluster_by``; no change for ``changes`` with keys."""
        base = self.newest(name)
        rows = self.read(name, base)
        return self.commit(name, rows if cluster_by else rows.coalesce(n_files or 1), "compact", base=base, cluster_by=cluster_by, n_files=n_files)

    def vacuum(self, name: str, keep: int) -> int:
        """Delete files that none of the last ``keep`` versions lists, and the older log entries; returns the number of pieces that went whole. Not while others write."""
        known = self.versions(name)
        kept: dict[str, set] = {}
        for v in known[-keep:]:
            for p, own in self._entry(name, v)["files"].items():
                kept.setdefault(p, set()).update(own)
        if known[:-keep]:
            self._checkpoint(name, known[-keep])  # carries the batch ids of the entries that go
        for v in known[:-keep]:
            for kind in ("json", "checkpoint"):
                self._fs(self._path(self.root)).delete(self._path(self._log(name, v, kind)), False)
        gone, folder = 0, f"{self.root}/{name}/data"
        for piece in self._names(folder):
            if piece not in kept:
                self._drop(name, piece)
                gone += 1
                continue
            base = self._fs(self._path(folder)).makeQualified(self._path(f"{folder}/{piece}")).toUri().getPath()
            listed = self._fs(self._path(folder)).listFiles(self._path(f"{folder}/{piece}"), True)
            while listed.hasNext():
                path = listed.next().getPath()
                if path.getName().startswith("part-") and path.toUri().getPath().removeprefix(base).lstrip("/") not in kept[piece]:
                    self._fs(path).delete(path, False)
        return gone

    def restore(self, name: str, version: int) -> int:
        """An older version's files as the newest version; no data is copied."""
        state = self._entry(name, version)
        return self._commit(name, {
            "version": self.versions(name)[-1] + 1, "operation": "restore", "at": datetime.datetime.now(datetime.timezone.utc).isoformat(), "batch_id": None, "rows": state["rows"],
            "schema": state["schema"], "keys": state["keys"], "replace": True, "add": state["files"], "remove": {}, "metrics": {},
        })


class Marks:
    """The last good versions of a reader's sources, as numbered files of which the newest counts; written whole or not at all."""

    def __init__(self, store: TableStore, reader: str):
        self.store, self.folder = store, f"{store.root}/_marks/{reader}"

    def _numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.store._names(self.folder) if n.removesuffix(".json").isdigit())

    def read(self) -> dict[str, int]:
        known = self._numbers()
        return json.loads(self.store._text(f"{self.folder}/{known[-1]:020d}.json")) if known else {}

    def write(self, versions: dict[str, int]) -> None:
        known = self._numbers()
        at = known[-1] + 1 if known else 0
        if not self.store._publish(f"{self.folder}/{at:020d}.json", json.dumps(versions)):
            raise ConcurrentCommit(f"{self.folder} mark {at}")
        for n in known[:-1]:
            path = self.store._path(f"{self.folder}/{n:020d}.json")
            self.store._fs(path).delete(path, False)


def incremental(store: TableStore, reader: str, sources: list[str], build: Callable[[dict[str, DataFrame]], DataFrame], target: str, strategy: str, keys: list[str], **options) -> int | None:
    """Load what changed in the sources since the reader's last good run; None if nothing did.

    ``build`` gets each source's changed rows (new values; deleted rows are in it too, told by
    ``_change``). Marks move after the commit, whose batch id is made of the source versions, so a
    run that failed between the two changes nothing when it is done again.
    """
    marks = Marks(store, reader)
    seen, now = marks.read(), {s: store.newest(s) for s in sources}
    if missing := [s for s, v in now.items() if v is None]:
        raise ValueError(f"sources without a version: {missing}")
    if seen == now:
        return None
    rows = build({s: store.changes(s, seen.get(s), now[s]) for s in sources})
    version = store.load(target, strategy, rows, keys, f"{reader}#{sum(now.values())}", **options)
    marks.write(now)
    return version

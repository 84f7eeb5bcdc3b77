"""Rule documents compiled into column predicates: typed JSON constraints, no SQL text.

A document is ``{"type": .., "kwargs": {..}, "meta": {..}}``; type and kwargs are required.
``check`` parses and validates documents as a frame; invalid ones keep a problem, they are
never dropped. ``compiled`` makes conditions of the valid ones. A null passes every rule but
``not_null``, as it has no value to judge; ``unique`` takes null for a value like any other.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types of rules with the arguments they need, and those that name columns.
NEEDS = {
    "not_null": ("column",), "between": ("column",), "in_set": ("column", "values"), "matches": ("column", "pattern"), "length_between": ("column",),
    "compare": ("left", "op", "right"), "unique": ("columns",),
}
NAMES = ("column", "left", "right")
OPERATORS = ("<", "<=", "=", ">=", ">", "<>")
NUMBERS = ("min", "max", "mostly")
#: Rules of one table that are compiled; a rule book is a small document, more is an error.
MOST = 10_000

CONSTRAINT = "struct<type: string, kwargs: map<string, string>, meta: map<string, string>>"


def check(documents: DataFrame, columns: list[str], constraint: str = "constraint") -> DataFrame:
    """The documents with ``type``, ``kwargs``, ``meta`` and ``problem`` (null if valid, the first one otherwise) for a table with these columns."""
    parsed = F.from_json(constraint, CONSTRAINT)
    out = documents.withColumns({"type": parsed["type"], "kwargs": parsed["kwargs"], "meta": parsed["meta"]})
    kwargs, known = F.col("kwargs"), F.array(*[F.lit(c) for c in columns])
    problems = [
        F.when(F.col(constraint).isNull(), "no constraint"),
        F.when(F.get_json_object(constraint, "$").isNull(), "not JSON"),
        F.when(F.col("type").isNull(), "no type"),
        F.when(kwargs.isNull(), "no kwargs"),
        F.when(~F.col("type").isin(*NEEDS), F.concat(F.lit("unknown type "), F.col("type"))),
    ]
    for kind, needed in NEEDS.items():
        for name in needed:
            problems.append(F.when((F.col("type") == kind) & kwargs[name].isNull(), F.lit(f"no {name}")))
    problems += [F.when(~F.array_contains(known, kwargs[n]), F.concat(F.lit("unknown column "), kwargs[n])) for n in NAMES]
    for name in ("columns", "values"):
        items = F.from_json(kwargs[name], "array<string>")
        problems.append(F.when(kwargs[name].isNotNull() & (items.isNull() | (F.size(items) < 1) | F.exists(items, lambda x: x.isNull())), F.lit(f"{name} is no list")))
        if name == "columns":
            problems.append(F.when(F.size(F.array_except(items, known)) > 0, F.concat(F.lit("unknown column "), F.array_join(F.array_except(items, known), ", "))))
    problems.append(F.when((F.col("type") == "compare") & ~kwargs["op"].isin(*OPERATORS), F.concat(F.lit("unknown operator "), kwargs["op"])))
    problems.append(F.when(F.col("type").isin("between", "length_between") & kwargs["min"].isNull() & kwargs["max"].isNull(), "no min or max"))
    problems += [F.when(kwargs[n].isNotNull() & kwargs[n].try_cast("double").isNull(), F.lit(f"{n} is no number")) for n in NUMBERS]
    return out.withColumn("problem", F.coalesce(*problems))


@dataclass
class Rule:
    rule_id: str
    kind: str
    kwargs: dict[str, str]

    @property
    def mostly(self) -> float:
        """The share of rows that must pass."""
        return float(self.kwargs.get("mostly", 1.0))

    @property
    def columns(self) -> list[str]:
        return json.loads(self.kwargs["columns"])

    def holds(self, schema: T.StructType) -> Column:
        """Whether a row passes; not for ``unique``, which needs the other rows."""
        k = self.kwargs
        c = F.col(f"`{k['column']}`") if "column" in k else None

        def within(value: Column, kind: T.DataType) -> Column:
            parts = [value >= F.lit(k["min"]).cast(kind)] if "min" in k else []
            return reduce(lambda a, b: a & b, parts + ([value <= F.lit(k["max"]).cast(kind)] if "max" in k else []))

        if self.kind == "not_null":
            return c.isNotNull()
        if self.kind == "between":
            kind = schema[k["column"]].dataType
            found = within(c, T.DoubleType() if isinstance(kind, T.IntegralType) else kind)
        elif self.kind == "in_set":
            found = c.isin(*[F.lit(x).cast(schema[k["column"]].dataType) for x in json.loads(k["values"])])
        elif self.kind == "matches":
            found = c.cast("string").rlike(k["pattern"])
        elif self.kind == "length_between":
            found = within(F.length(c.cast("string")), T.DoubleType())
        else:
            a, b = F.col(f"`{k['left']}`"), F.col(f"`{k['right']}`")
            found = {"<": a < b, "<=": a <= b, "=": a == b, ">=": a >= b, ">": a > b, "<>": a != b}[k["op"]]
        return F.coalesce(found, F.lit(True))


def compiled(checked: DataFrame, rule_id: str = "rule_id") -> list[Rule]:
    """The valid rules of ``check`` in the order of their ids; ids must be unique."""
    rows = checked.where("problem IS NULL").select(rule_id, "type", "kwargs").orderBy(rule_id).limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError(f"more than {MOST} rules for one table")
    ids = [r[rule_id] for r in rows]
    if repeated := {i for i in ids if ids.count(i) > 1} | ({None} & set(ids)):
        raise ValueError(f"rule ids must be unique and not null: {sorted(map(str, repeated))}")
    pattern = checked.sparkSession._jvm.java.util.regex.Pattern
    out = []
    for r in rows:
        if r["type"] == "matches":
            try:
                pattern.compile(r["kwargs"]["pattern"])
            except Exception as e:
                raise ValueError(f"rule {r[rule_id]}: {r['kwargs']['pattern']!r} is no regular expression") from e
        out.append(Rule(r[rule_id], r["type"], dict(r["kwargs"])))
    return out


def flags(df: DataFrame, rules: list[Rule], prefix: str = "dq_") -> DataFrame:
    """A 0/1 column for each rule. Rows of one scan, but for ``unique`` rules, whose repeated keys are found by a sum and joined back."""
    out = df.withColumns({f"{prefix}{r.rule_id}": r.holds(df.schema).cast("int") for r in rules if r.kind != "unique"})
    for r in rules:
        if r.kind == "unique":
            many = df.groupBy(*[F.col(f"`{c}`") for c in r.columns]).agg(F.count("*").alias("__n")).where("__n > 1").withColumn("__many", F.lit(True))
            meets = reduce(lambda a, b: a & b, [F.col(f"d.`{c}`").eqNullSafe(F.col(f"m.`{c}`")) for c in r.columns])
            out = out.alias("d").join(many.alias("m"), meets, "left").select("d.*", F.col("__many").isNull().cast("int").alias(f"{prefix}{r.rule_id}"))
    names = [f"{prefix}{r.rule_id}" for r in rules]
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"`{c}`") for c in names])


def results(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``rule_id, n_rows, n_broken, passed``: one row a rule, from one sum over the flags."""
    marked = flags(df, rules)
    sums = marked.agg(F.count("*").alias("n"), *[F.count_if(F.col(f"`dq_{r.rule_id}`") == 0).alias(r.rule_id) for r in rules])
    each = F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), F.col("n").alias("n_rows"), F.col(f"`{r.rule_id}`").alias("n_broken"), (F.col(f"`{r.rule_id}`") <= (1 - r.mostly) * F.col("n")).alias("passed")) for r in rules])
    return sums.select(F.inline(each)) if rules else df.sparkSession.createDataFrame([], "rule_id string, n_rows long, n_broken long, passed boolean")

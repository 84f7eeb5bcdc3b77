"""Transform specs checked and rewritten by Spark's own parser: sources found in the parsed plan, names changed by position."""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import ParseException
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Relation:
    """A table that a query reads: its name's parts, where the name stands in the text (end exclusive), and whether columns may be qualified with it."""

    parts: tuple[str, ...]
    start: int
    stop: int
    bare: bool


def _seq(s) -> list:
    return [s.apply(i) for i in range(s.size())]


def _kinds(x) -> set[str]:
    c, out = x.getClass(), set()
    while c is not None:
        out.add(c.getSimpleName())
        c = c.getSuperclass()
    return out


def _walk(spark: SparkSession, sql: str) -> tuple[list[Relation], set[str]]:
    """The tables of a query, and the names of its CTEs."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except (ParseException, Py4JJavaError) as e:
        raise ValueError(str(e).strip().split("\n")[0]) from e
    found: set[Relation] = set()
    ctes: set[str] = set()

    def expression(e, names: frozenset) -> None:
        if "PlanExpression" in _kinds(e):
            node(e.plan(), names, True)
        for x in _seq(e.children()):
            expression(x, names)

    def node(p, names: frozenset, bare: bool) -> None:
        kind = p.getClass().getSimpleName()
        if kind == "UnresolvedWith":
            for pair in _seq(p.cteRelations()):
                node(pair._2(), names, True)  # a CTE sees those before it
                names = names | {pair._1().lower()}
                ctes.add(pair._1().lower())
        if kind == "UnresolvedRelation":
            parts = tuple(_seq(p.multipartIdentifier()))
            if len(parts) > 1 or parts[0].lower() not in names:
                at = p.origin()
                text, first = at.sqlText().get(), at.startIndex().get()
                found.add(Relation(parts, first, first + len(_name_at(text, first, len(parts))), bare))
        for e in _seq(p.expressions()):
            expression(e, names)
        for c in _seq(p.children()):
            node(c, names, kind not in ("SubqueryAlias", "Sample", "GlobalLimit", "LocalLimit"))

    node(plan, frozenset(), True)
    return sorted(found, key=lambda r: r.start), ctes


def relations(spark: SparkSession, sql: str) -> list[Relation]:
    """The tables of a query in the order of the text, subqueries and CTEs included; names of CTEs in scope, literals and comments aren't tables."""
    return _walk(spark, sql)[0]


def _name_at(text: str, at: int, parts: int) -> str:
    """The name of so many parts that starts at a place, with its quotes and blanks around dots."""
    end = at
    for k in range(parts):
        while text[end].isspace() or (k and text[end] == "."):
            end += 1
        if text[end] == "`":
            end += 1
            while text[end] != "`" or text[end : end + 2] == "``":
                end += 2 if text[end : end + 2] == "``" else 1
            end += 1
        else:
            while end < len(text) and (text[end].isalnum() or text[end] == "_"):
                end += 1
    return text[at:end]


def rewritten(spark: SparkSession, sql: str, names: dict[tuple[str, ...], str]) -> str:
    """The query with tables of those names replaced where they are read; the rest of the text stays as it is.

    A table that columns may be qualified with keeps its last word as an alias.
    """
    for r in reversed(relations(spark, sql)):
        new = names.get(tuple(p.lower() for p in r.parts))
        if new is not None:
            alias = f" AS `{r.parts[-1]}`" if r.bare and new.lower() != r.parts[-1].lower() else ""
            sql = f"{sql[: r.start]}{new}{alias}{sql[r.stop :]}"
    return sql


def sources_of(spark: SparkSession, queries: list[dict]) -> list[dict]:
    """``name, lakehouse, schema, table`` for each three-part name that the queries read, once each.

    The name is the last word; where that is taken by another source, a query or a CTE, the schema and if need be the lakehouse come before it.
    """
    seen: dict[tuple, tuple] = {}
    taken = {str(q.get("name")).lower() for q in queries}
    for q in queries:
        read, ctes = _walk(spark, q["sql"])
        taken |= ctes | {r.parts[0].lower() for r in read if len(r.parts) == 1}
        for r in read:
            if len(r.parts) == 3:
                seen.setdefault(tuple(p.lower() for p in r.parts), r.parts)
    out = []
    for key, parts in seen.items():
        others = taken | {k[2] for k in seen if k != key}
        name = next((n for n in (parts[2], "_".join(parts[1:]), "_".join(parts)) if n.lower() not in others), None)
        if name is None:
            raise ValueError(f"no name is free for {'.'.join(parts)}")
        taken.add(name.lower())
        out.append({"name": name, "lakehouse": parts[0], "schema": parts[1], "table": parts[2]})
    return out


def spec_of(spark: SparkSession, target: dict, queries: list[dict]) -> dict:
    """A spec from queries over three-part names: its sources, and the queries over their short names."""
    sources = sources_of(spark, queries)
    names = {tuple(s[k].lower() for k in ("lakehouse", "schema", "table")): s["name"] for s in sources}
    return {"target": dict(target), "source": sources, "query": [q | {"sql": rewritten(spark, q["sql"], names).strip()} for q in queries]}


#: Load strategies of a spec that need key columns.
KEYED = ("merge", "type_two", "overwrite_by_key")
STRATEGIES = (*KEYED, "overwrite", "append")


def problems(spark: SparkSession, spec: dict) -> list[str]:
    """What is wrong with a spec, by the order of its parts; queries are parsed, nothing is run."""
    out, target = [], spec.get("target") or {}
    out += [f"target: no {k}" for k in ("lakehouse", "schema", "table", "load_strategy") if not target.get(k)]
    how = target.get("load_strategy")
    if how and how not in STRATEGIES:
        out.append(f"target: unknown load strategy {how}")
    if how in KEYED and not target.get("key_columns"):
        out.append(f"target: {how} needs key_columns")
    if target.get("quarantine_strategy", "merge") not in ("merge", "append"):
        out.append(f"target: unknown quarantine strategy {target['quarantine_strategy']}")
    names: list[str] = []
    for s in spec.get("source") or []:
        out += [f"source {s.get('name')}: no {k}" for k in ("name", "lakehouse", "schema", "table") if not s.get(k)]
        names.append(str(s.get("name")).lower())
    queries = spec.get("query") or []
    if not queries:
        out.append("query: at least one is needed")
    for q in queries:
        name = q.get("name")
        if not name or not q.get("sql"):
            out.append(f"query {name}: no {'sql' if name else 'name'}")
            continue
        try:
            read = relations(spark, q["sql"])
        except ValueError as e:
            out.append(f"query {name}: {e}")
            read = []
        out += [f"query {name}: reads {'.'.join(r.parts)}, which is no source or query before it" for r in read if len(r.parts) > 1 or r.parts[0].lower() not in names]
        names.append(name.lower())
    out += [f"name {n} stands for several sources or queries" for n in dict.fromkeys(names) if names.count(n) > 1]
    return out

"""Expectations, quarantine and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """A 0/1 column ``dq_<name>`` for each rule; unknown counts as broken."""
    return df.withColumns({f"dq_{k}": F.coalesce(v, F.lit(False)).cast("int") for k, v in rules.items()})


def split_by_rules(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and the others with the names of the broken ones."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(v, F.lit(False)), F.lit(k)) for k, v in rules.items()]))
    marked = df.withColumn("dq_broken", broken)
    return marked.where(F.size("dq_broken") == 0).drop("dq_broken"), marked.where(F.size("dq_broken") > 0)


def summary(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row: the rows and each rule's broken rows, from one pass."""
    return df.agg(F.count("*").alias("n_rows"), *[F.count_if(~F.coalesce(v, F.lit(False))).alias(f"broken_{k}") for k, v in rules.items()])


def unified(good: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Both kinds of rows with a flag; columns of one side only are null in the other."""
    return good.withColumn("is_quarantined", F.lit(0)).unionByName(quarantined.withColumn("is_quarantined", F.lit(1)), allowMissingColumns=True)


def row_count_verdict(rows: int, before: int | None, least: int = 1, growth: float = 2.0) -> str:
    """``error``, ``warning`` or ``ok`` for a table's row count."""
    if rows == 0 or rows < least:
        return "error"
    return "warning" if before and rows > growth * before else "ok"


def row_count_verdicts(counts: DataFrame, rows: str, before: str, least: int = 1, growth: float = 2.0) -> DataFrame:
    """``row_count_verdict`` as a column ``verdict`` of a frame of counts; a table that wasn't there before (null) can't have grown."""
    n, old = F.coalesce(F.col(rows), F.lit(0)), F.col(before)
    return counts.withColumn("verdict", F.when((n == 0) | (n < least), "error").when((old > 0) & (n > growth * old), "warning").otherwise("ok"))


def load_rules(rules: DataFrame) -> dict[str, Column]:
    """Rules of a rule table ``rule_id, expression, is_active`` as conditions; the expressions are SQL. A rule book is a small table."""
    return {r["rule_id"]: F.expr(r["expression"]) for r in rules.where("is_active = 1").orderBy("rule_id").collect()}


def gate(df: DataFrame, rules: dict[str, Column], most_broken: float) -> tuple[DataFrame, DataFrame, bool]:
    """Rows to load, rows to quarantine, and whether the load may go on: at most that share of rows is broken."""
    good, bad = split_by_rules(df, rules)
    n = df.agg(F.count("*").alias("n"), F.count_if(~_all(rules)).alias("bad")).first()
    return good, bad, n["bad"] <= most_broken * n["n"]


def _all(rules: dict[str, Column]) -> Column:
    holds = F.lit(True)
    for v in rules.values():
        holds = holds & F.coalesce(v, F.lit(False))
    return holds


def quarantine_rows(duplicates: DataFrame, table: str, kind: str, run: str, now: Column) -> DataFrame:
    """Rows for a quarantine table: the columns and what is needed to find out where they came from."""
    return duplicates.withColumns({"q_table": F.lit(table), "q_type": F.lit(kind), "q_run": F.lit(run), "q_time": now})


def quarantine_log(duplicates: DataFrame, keys: list[str], table: str, kind: str, run: str) -> DataFrame:
    """A log row: rows and keys in quarantine, the key columns joined by ``~``. Without duplicates there is none."""
    one = F.struct(*[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys])
    counted = duplicates.groupBy(one.alias("k")).agg(F.count("*").alias("n")).agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_keys")).where("n_keys > 0")
    return counted.select(F.lit(table).alias("q_table"), F.lit(kind).alias("q_type"), F.lit(run).alias("q_run"), "n_rows", "n_keys", F.lit("~".join(keys)).alias("key_columns"))

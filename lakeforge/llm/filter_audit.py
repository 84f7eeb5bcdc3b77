"""Filter interaction audit: what every order of a set of filters keeps, removes and hides.

Each row gets one failure flag a filter. Rows are summed by part and flags, and a CUBE over
flags and part makes the counts of all subsets: a grouping-set row whose flags are all
either rolled up or false counts the survivors of the flags that stand in it. A step of an
order is a pair of subsets (the filters before it, and these with its own), so it is two
lookups by part and subset; nothing is filtered again for an order.

Texts are read once: flags and a SHA-256 digest are written, no text is shuffled. Identical
texts are found through the smallest id of a digest (summed before the shuffle) and a join
by digest and id, which no group of copies makes hot. Rows without an id are set apart, so
no key is null.

Defined results: a null text is empty; a null part is the empty string; repeated rows count
as often as they stand there and aren't copies of each other, as neither id is smaller; a row
without an id is no copy, makes no other row one and has no labels; of several labels of an
id one suffices; texts of any length are taken whole; other columns aren't read; an empty
table gives no rows, not even for all parts together.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, table

#: White space between words, as a class of characters for regular expressions.
BLANK = r"\x20\x09-\x0D"
#: The filter that finds copies; the others look at the text alone.
COPIES = "E"
COUNTS = ("n", "good", "toxic")


def text_failures(text: Column) -> dict[str, Column]:
    """Filters by letter, true where a text fails: too few words, repetitive, capitals, symbols."""
    words = F.filter(F.split(text, f"[{BLANK}]+"), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 50 * F.size(words).cast("long"),
        "C": 100 * capitals.cast("long") > 3 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def _flagged(docs: DataFrame, labels: DataFrame, marked: DataFrame, names: list[str]) -> DataFrame:
    """``part``, a flag for each filter, and COUNTS: rows summed by part and flags."""
    own = [c for c in names if c != COPIES]
    rows = marked.where("doc_id IS NOT NULL").groupBy("doc_id", "digest", "part", *own).agg(F.count("*").alias("n"))
    of = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    first = marked.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    known = rows.join(of, "doc_id", "left").join(first, ["digest", "doc_id"], "left")
    known = known.select("part", *own, F.col("first").isNull().alias(COPIES), "n", *[(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in COUNTS[1:]])
    bare = marked.where("doc_id IS NULL").groupBy("part", *own).agg(F.count("*").alias("n")).select("part", *own, F.lit(False).alias(COPIES), "n", *[F.lit(0).cast("long").alias(c) for c in COUNTS[1:]])
    return known.unionByName(bare).groupBy("part", *names).agg(*[F.sum(c).alias(c) for c in COUNTS])


def survivors(flagged: DataFrame, names: list[str]) -> DataFrame:
    """``part`` (null: all parts together), ``subset`` (a bit for each filter) and COUNTS of the rows that fail none of the subset."""
    sums = flagged.cube(*names, "part").agg(*[F.sum(c).alias(c) for c in COUNTS], *[F.grouping(c).alias(f"rolled_{c}") for c in (*names, "part")])
    passes, subset = F.lit(True), F.lit(0)
    for k, c in enumerate(names):
        stands = F.col(f"rolled_{c}") == 0
        passes = passes & (~stands | ~F.col(c))
        subset = subset + F.when(stands, 1 << k).otherwise(0)
    found = sums.where(passes).select("part", (F.col("rolled_part") == 1).alias("whole"), subset.alias("subset"), *COUNTS)
    # A subset that nothing survives has no row of its own; the empty subset always has one.
    every = found.where("subset = 0").select("part", "whole", F.explode(F.sequence(F.lit(0), F.lit((1 << len(names)) - 1))).alias("subset"))
    same = (F.col("f.subset") == F.col("e.subset")) & F.col("f.part").eqNullSafe(F.col("e.part")) & (F.col("f.whole") == F.col("e.whole"))
    return every.alias("e").join(found.alias("f"), same, "left").select("e.part", "e.whole", "e.subset", *[F.coalesce(f"f.{c}", F.lit(0)).alias(c) for c in COUNTS])


def steps_of(names: list[str]) -> list[tuple[str, int, str, int, int]]:
    """``filter_order, step, filter, before, after`` for every step of every order: a bounded list (120 orders of five)."""
    out = []
    for order in permutations(names):
        before = 0
        for k, c in enumerate(order, 1):
            after = before | 1 << names.index(c)
            out.append(("".join(order), k, c, before, after))
            before = after
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a part, order and step (``part`` null and ``whole`` true: all parts together), with the counts of the step.

    ``docs`` has doc_id, text and lang, ``labels`` doc_id, quality and toxic.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    fails = text_failures(F.col("text"))
    names = sorted([*fails, COPIES])
    plain = docs.select("doc_id", text.alias("text"), F.coalesce("lang", F.lit("")).alias("part"))
    marked = materialize(plain.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *[v.alias(k) for k, v in fails.items()]), "failures")
    subsets = materialize(survivors(_flagged(docs, labels, marked, names), names), "survivors")  # 32 rows a part
    steps = F.broadcast(spark.createDataFrame(steps_of(names), "filter_order string, step int, filter string, before int, after int"))
    a, b = subsets.alias("a"), subsets.alias("b")
    before = a.join(steps, F.col("a.subset") == F.col("before"))
    pairs = before.join(b, (F.col("b.subset") == F.col("after")) & F.col("a.part").eqNullSafe(F.col("b.part")) & (F.col("a.whole") == F.col("b.whole")))
    lost = {"removed": "n", "good_lost": "good", "toxic_lost": "toxic"}
    rows = pairs.select("a.part", "a.whole", "filter_order", "step", "filter", F.col("b.n").alias("kept"), *[(F.col(f"a.{c}") - F.col(f"b.{c}")).alias(k) for k, c in lost.items()])
    # As first filter it removes all that fail it, as last one what fails it alone.
    own = Window.partitionBy("part", "whole", "filter")
    alone, last = (F.max(F.when(F.col("step") == k, F.col("removed"))).over(own) for k in (1, len(names)))
    rows = rows.select("part", "whole", "filter_order", "step", "kept", "removed", (alone - F.col("removed")).alias("redundant"), last.alias("unique_fails"), "good_lost", "toxic_lost", F.sum("removed").over(own).alias("shapley"))
    done = materialize(rows, "audit")
    discard(marked, subsets)
    return done


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    """The audit of every part of ``documents``; rows over all parts are left to ``audit``."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).where("NOT whole").drop("whole")


#: Every document under every order: its first failing filter removes it.
SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part,
    list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS words FROM documents),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, MAP {
    'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
    'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
    'D': regexp_matches(text, '[#$%&*|]'),
    'E': coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY sha256(text)), false)} AS fails
    FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT v.c || w.c || x.c || y.c || z.c AS filter_order FROM c v, c w, c x, c y, c z
    WHERE len(list_distinct([v.c, w.c, x.c, y.c, z.c])) = 5),
s AS (SELECT filter_order, unnest([1, 2, 3, 4, 5])::INT AS step FROM o),
r AS (SELECT f.*, filter_order, coalesce(nullif(list_position(list_transform(string_split(filter_order, ''), lambda k: fails[k]), true), 0), 6) AS gone FROM f, o),
t AS (SELECT part, filter_order, step, count(*) FILTER (gone > step) AS kept, count(*) FILTER (gone = step) AS removed,
    count(*) FILTER (gone < step AND fails[filter_order[step]]) AS redundant,
    count(*) FILTER (fails[filter_order[step]] AND len(list_filter(map_values(fails), lambda k: k)) = 1) AS unique_fails,
    count(*) FILTER (gone = step AND good) AS good_lost, count(*) FILTER (gone = step AND toxic) AS toxic_lost
    FROM r JOIN s USING (filter_order) GROUP BY ALL)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley FROM t"""

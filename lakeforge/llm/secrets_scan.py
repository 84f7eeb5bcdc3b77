"""Secret scans over a trigram inverted index.

From each rule's regex a Boolean query over trigrams is derived: the trigrams every
match must hold. Each batch of texts gets an inverted index (trigram to the set of
texts, as an integer's bits) for the trigrams the queries name; postings are
intersected and united by the query, and only the candidates are scanned. A rule with
no mandatory trigram scans every text.

Trigrams are compared in lower case, which can only add candidates. Defined results: a
null text is an empty one without spans; spans are code points, end exclusive; per rule
matches are leftmost and don't overlap, between rules they may; an empty table gives an
empty table.
"""

from __future__ import annotations

import re
import re._constants as sre
import re._parser as sre_parser
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, slices, table

#: Texts of one index.
INDEX_ROWS = 256


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0
    least: int = 0  # of the group's characters; shorter matches are dropped
    span: int = 0  # the group that is the span


# A private key runs to its END line, if no other block begins before it; without one, over headers and the lines of base64
# characters only that follow (the first of 16 or more). Line ends may be written out as in JSON.
_EOL = r"[ \t]*+(?:\r\n?|\n|(?:\\r)?\\n)[ \t]*+"
_LINE_ENDS = r"""(?=[ \t]*+(?:[\r\n\\"']|\Z))"""
_BODY = rf"(?:{_EOL}(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+(?:{_EOL})*+\s*+[A-Za-z0-9+/]{{16,}}+={{0,2}}+{_LINE_ENDS}(?:{_EOL}[A-Za-z0-9+/]++={{0,2}}+{_LINE_ENDS})*+"
_PRIVATE_KEY = rf"-----BEGIN ([A-Z ]{{0,20}}PRIVATE KEY)-----(?:(?:(?!-----BEGIN )(?s:.))*?-----END \1-----|(?:{_BODY})?)"

# Within a run of its characters a token can only begin at the first eyJ: one that fails there fails at each later one too.
_JWT = r"(?<![A-Za-z0-9_-])(?>[A-Za-z0-9_-]*?(?=eyJ))(eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)"

# The three base rules; then rules for well-known token formats.
RULES = (
    Rule("assign", r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
    Rule("private_key", _PRIVATE_KEY),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", _JWT, span=1),
)


def _all(parts: list):
    parts = [p for p in parts if p is not None]
    return None if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any(parts: list):
    return None if any(p is None for p in parts) else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _of(text: str):
    return _all(sorted({text[i : i + 3] for i in range(len(text) - 2)}))


#: An alternation or class is spelled out up to this many strings; beyond it nothing is required of it.
MOST_STRINGS = 16


def _strings(item) -> list[str] | None:
    """All strings one parsed item can match, or None if they are too many."""
    op, arg = item
    if op is sre.LITERAL:
        return [chr(arg).lower()]
    if op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= MOST_STRINGS:
        return sorted({chr(a).lower() for _, a in arg})
    if op is sre.SUBPATTERN:
        return _sequence_strings(arg[3])
    if op is sre.BRANCH:
        found = [_sequence_strings(x) for x in arg[1]]
        return None if None in found or len(flat := sorted({s for x in found for s in x})) > MOST_STRINGS else flat
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] is not sre.MAXREPEAT and arg[1] <= 4 and (one := _sequence_strings(arg[2])):
        out = {""} if arg[0] == 0 else set()
        now = [""]
        for n in range(1, arg[1] + 1):
            now = [a + b for a in now for b in one]
            if len(now) > MOST_STRINGS:
                return None
            if n >= arg[0]:
                out |= set(now)
        return sorted(out)
    return None


def _sequence_strings(items) -> list[str] | None:
    out = [""]
    for item in items:
        if (more := _strings(item)) is None or len(out) * len(more) > MOST_STRINGS:
            return None
        out = [a + b for a in out for b in more]
    return out


def trigram_query(pattern: str):
    """None (all texts are candidates), a trigram, or ("and" | "or", queries)."""

    def sequence(items):
        parts, run = [], [""]

        def close():
            nonlocal run
            parts.append(_any([_of(s) for s in run]))
            run = [""]

        for item in items:
            strings = _strings(item)
            if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
                run = [a + b for a in run for b in strings]
                continue
            close()
            if strings is not None:
                run = strings
                continue
            op, arg = item
            if op is sre.SUBPATTERN:
                parts.append(sequence(arg[3]))
            elif op is sre.BRANCH:
                parts.append(_any([sequence(x) for x in arg[1]]))
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] > 0:
                parts.append(sequence(arg[2]))
        close()
        return _all(parts)

    return sequence(sre_parser.parse(pattern))


def trigrams_of(query) -> set[str]:
    return set() if query is None else {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


def candidates(query, postings: dict[str, int], everything: int) -> int:
    """The set of texts, as bits, that satisfy a query."""
    if query is None:
        return everything
    if isinstance(query, str):
        return postings[query]
    sets = [candidates(q, postings, everything) for q in query[1]]
    out = sets[0]
    for s in sets[1:]:
        out = out & s if query[0] == "and" else out | s
    return out


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.wanted = sorted(set().union(*map(trigrams_of, self.queries)))
        self.regexes = [re.compile(r.pattern) for r in rules]
        # A hex run needs its least length in one piece; the others keep the plain form, whose failing matches use up text.
        self.regexes = [re.compile(f"{r.pattern[:-1]}{{{r.least},}}") if re.fullmatch(r"\[[^\]]+\]\+", r.pattern) else x for r, x in zip(rules, self.regexes, strict=True)]

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        """Start, end and kind of all spans of each text, by start and rule."""
        postings = dict.fromkeys(self.wanted, 0)
        for i, t in enumerate(texts):
            low = t.lower()
            for g in self.wanted:
                if g in low:
                    postings[g] |= 1 << i
        out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        for rule, query, rx in zip(self.rules, self.queries, self.regexes, strict=True):
            left = candidates(query, postings, (1 << len(texts)) - 1)
            while left:
                i = (left & -left).bit_length() - 1
                left &= left - 1
                out[i] += [(m.start(rule.span), m.end(rule.span), rule.kind) for m in rx.finditer(texts[i]) if len(m[rule.group]) >= rule.least]
        place = {r.kind: k for k, r in enumerate(self.rules)}
        return [sorted(x, key=lambda s: (s[0], place[s[2]], s[1])) for x in out]


def scan(df: DataFrame, text: Column, keep: list[str], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The columns ``keep`` and ``found``: start, end and kind of each span. A kept column ``found`` is an error."""
    if "found" in map(str.lower, keep):
        raise ValueError("columns with names of results: ['found']")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        for b in slices(batches, INDEX_ROWS):
            found = scanner.scan([t.as_py() or "" for t in b.column(0)])
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array([[{"start": s, "end": e, "kind": k} for s, e, k in x] for x in found], kind)], names=[*keep, "found"])

    source = df.select(text.alias("__text"), *[F.col(f"`{c}`") for c in keep])
    more = T._parse_datatype_string("found array<struct<start: long, end: long, kind: string>>")
    return map_batches(source, run, T.StructType([*source.schema.fields[1:], *more.fields]))


def redact(df: DataFrame, column: str, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """The same rows with every span in ``column`` (overlapping ones together) replaced; null stays null."""
    names = df.columns
    place = names.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for b in slices(batches, INDEX_ROWS):
            texts = [t.as_py() for t in b.column(place)]
            out = []
            for t, spans in zip(texts, scanner.scan([t or "" for t in texts]), strict=True):
                parts, at = [], 0
                for s, e, _ in spans:
                    if s >= at:
                        parts += [t[at:s], mark]
                    at = max(at, e)
                out.append("".join([*parts, t[at:]]) if spans else t)
            columns = b.columns
            columns[place] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(df, run, df.schema)


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op8_secrets(spark, sf_dir: str) -> DataFrame:
    """Counts and spans of every document."""
    kinds = [r.kind for r in RULES[:3]]
    found = scan(table(spark, sf_dir, "documents"), F.col("text"), ["doc_id"])

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind"].isin(kinds))
    return found.select("doc_id", *map(count, kinds), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))

"""SQL scripts of a folder: read whole, brought into Spark's dialect, deployed as views in the order of need."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import specs

#: What stands apart in a script: texts, quoted names, comments; none is looked into.
_APART = re.compile(r"N?'(?:[^']|'')*'|\[(?:[^\]]|\]\])+\]|\"(?:[^\"]|\"\")*\"|`[^`]*`|--[^\n]*|/\*.*?\*/", re.S)
#: Functions that Spark calls otherwise.
_CALLS = {"getdate": "current_timestamp", "sysdatetime": "current_timestamp", "isnull": "coalesce", "len": "length", "datalength": "octet_length", "newid": "uuid", "iif": "if", "charindex": "locate"}
_VIEW = re.compile(r"^\s*create\s+(?:or\s+(?:alter|replace)\s+)?view\s+(?:if\s+not\s+exists\s+)?((?:`[^`]+`|\w+)(?:\s*\.\s*(?:`[^`]+`|\w+))*)", re.I)


def read_scripts(spark: SparkSession, folder: str, pattern: str = "*.sql") -> DataFrame:
    """``path, name, content``: one row a script, at any depth; the name is the file's without its ending."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(folder, wholetext=True)
    path = F.col("_metadata.file_path")
    return files.select(path.alias("path"), F.regexp_extract(F.url_decode(path), r"([^/]+?)(\.[^./]*)?$", 1).alias("name"), F.col("value").alias("content"))


def read_maps(spark: SparkSession, path: str) -> DataFrame:
    """``path, content``: whole JSON documents as maps of their fields' texts; null where a file isn't one."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.from_json("value", "map<string,string>").alias("content"))


def _outside(text: str, change: Callable[[str], str], quoted: Callable[[str], str]) -> str:
    out, at = [], 0
    for m in _APART.finditer(text):
        out += [change(text[at : m.start()]), quoted(m[0])]
        at = m.end()
    return "".join([*out, change(text[at:])])


def _quoted(part: str) -> str:
    if part.startswith("["):
        return "`" + part[1:-1].replace("]]", "]").replace("`", "``") + "`"
    if part.startswith('"'):
        return "`" + part[1:-1].replace('""', '"').replace("`", "``") + "`"
    if part.startswith(("N'", "'")):  # a doubled quote is one quote; a backslash is itself
        return "'" + part[part.index("'") + 1 : -1].replace("\\", "\\\\").replace("''", "\\'") + "'"
    return part


def to_spark(text: str) -> str:
    """A statement of another dialect in Spark's: names in brackets, N-texts, table hints, functions, TOP of the outermost query."""

    def change(part: str) -> str:
        part = re.sub(r"\bwith\s*\(\s*nolock\s*\)", "", part, flags=re.I)
        part = re.sub(r"\bcreate\s+or\s+alter\s+view\b", "CREATE OR REPLACE VIEW", part, flags=re.I)
        return re.sub(r"\b(\w+)(\s*\()", lambda m: _CALLS.get(m[1].lower(), m[1]) + m[2], part)

    text = re.sub(r"^(\s*(--[^\n]*(\n|$)|/\*.*?\*/))+", "", text, flags=re.S)
    out = _outside(text, change, _quoted).strip().rstrip(";").rstrip()
    top = re.match(r"((?:\s*create\s.*?\bas\s+)?\s*select\s+(?:distinct\s+)?)top\s*\(?\s*(\d+)\s*\)?\s+(?!percent\b)", out, re.I | re.S)
    return f"{top[1]}{out[top.end():]} LIMIT {top[2]}" if top else out


def statements(text: str) -> list[str]:
    """The statements of a script, apart by GO on a line of its own or by a semicolon."""
    marked = _outside(text, lambda p: re.sub(r"(?im)^[ \t]*go[ \t]*$", "\0", p).replace(";", "\0"), lambda p: p)
    return [s.strip() for s in marked.split("\0") if re.sub(r"--[^\n]*|/\*.*?\*/", "", s, flags=re.S).strip()]


def view_name(sql: str) -> str | None:
    found = _VIEW.match(re.sub(r"^(\s*(--[^\n]*\n|/\*.*?\*/))+", "", sql, flags=re.S))
    return None if found is None else ".".join(p.strip().strip("`").lower() for p in found[1].split("."))


def deploy(spark: SparkSession, scripts: dict[str, str], fail_fast: bool = True) -> dict[str, str]:
    """Run CREATE VIEW scripts, those that others read first (else by name); the errors by script.

    A view that needs one that failed isn't tried. Views that read each other are an error.
    """
    made: dict[str, list[str]] = {}
    needs: dict[str, set[str]] = {}
    errors: dict[str, str] = {}
    owner: dict[str, str] = {}

    def failed(name: str, error: Exception | str) -> None:
        if fail_fast:
            raise error if isinstance(error, Exception) else ValueError(f"{name}: {error}")
        errors[name] = str(error).split("\n")[0]

    for name in sorted(scripts):
        try:
            made[name] = [to_spark(s) for s in statements(scripts[name])]
            needs[name] = {".".join(r.parts).lower() for s in made[name] for r in specs.relations(spark, s)}
            for s in made[name]:
                if view := view_name(s):
                    owner[view] = name
        except ValueError as e:
            failed(name, e)
    of = {n: {owner[v] for v in needs[n] if v in owner and owner[v] != n} for n in made if n not in errors}
    left = sorted(of)
    while left:
        ready = next((n for n in left if not of[n] & set(left)), None)
        if ready is None:
            for n in left:
                failed(n, "it needs views that need it")
            break
        left.remove(ready)
        if bad := sorted(of[ready] & set(errors)):
            failed(ready, f"it needs {', '.join(bad)}, which failed")
            continue
        try:
            for s in made[ready]:
                spark.sql(s)
        except Exception as e:
            failed(ready, e)
    return errors

"""Scripts of other dialects, workbooks, reports, external tables, permissions, warnings."""

import os
import warnings
import zipfile

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lakeforge import functions as X
from lakeforge import sources
from lakeforge.operators import governance
from lakeforge.sources import excel, scripts


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_dialect():
    got = scripts.to_spark("CREATE OR ALTER VIEW [v 1] AS SELECT TOP (5) [a]]b], N'it''s [x] GETDATE()', ISNULL(c, LEN(d)), GETDATE() -- LEN(x) [y]\nFROM t WITH (NOLOCK);")
    assert got == "CREATE OR REPLACE VIEW `v 1` AS SELECT `a]b`, 'it\\'s [x] GETDATE()', coalesce(c, length(d)), current_timestamp() -- LEN(x) [y]\nFROM t LIMIT 5"
    assert scripts.statements("select 'a;b'\nGO\n-- only this\ngo\nselect 2; ") == ["select 'a;b'", "select 2"]
    assert scripts.view_name("-- x\ncreate view `Db`.V as select 1") == "db.v" and scripts.view_name("select 1") is None


def test_views_in_the_order_of_need(spark, tmp_path):
    folder = f"{tmp_path}/views"
    _put(folder, "a last.sql", "CREATE OR ALTER VIEW zz_last AS SELECT [n] + 1 AS n FROM zz_mid WITH (NOLOCK)")
    _put(folder, "sub/b.sql", "-- middle\nCREATE VIEW zz_mid AS SELECT TOP 2 ISNULL(n, 0) AS n FROM zz_first ORDER BY n DESC\nGO\n")
    _put(folder, "c.sql", "CREATE OR REPLACE VIEW zz_first AS SELECT explode(array(1, 2, null)) AS n")
    _put(folder, "note.txt", "no script")
    found = {r.name: r.content for r in scripts.read_scripts(spark, f"file://{folder}").collect()}
    assert set(found) == {"a last", "b", "c"}
    try:
        assert scripts.deploy(spark, found) == {}
        assert _rows(spark.table("zz_last")) == [(2,), (3,)]
        bad = {"x": "CREATE OR REPLACE VIEW zz_x AS SELECT * FROM nowhere_at_all", "y": "CREATE OR REPLACE VIEW zz_y AS SELECT * FROM zz_x", "p": "CREATE VIEW zz_p AS SELECT * FROM zz_q", "q": "CREATE VIEW zz_q AS SELECT * FROM zz_p", "s": "CREATE VIEW ("}
        errors = scripts.deploy(spark, bad | {"c": found["c"]}, fail_fast=False)
        assert set(errors) == set(bad) and "x, which failed" in errors["y"] and "need it" in errors["p"]
        with pytest.raises(ValueError):
            scripts.deploy(spark, {"s": "CREATE VIEW ("})
    finally:
        for v in ("zz_last", "zz_mid", "zz_first"):
            spark.sql(f"DROP VIEW IF EXISTS {v}")


def _book(path, sheets):
    """A workbook with shared and inline texts, numbers and gaps."""
    shared, files = [], {}
    for k, (_, rows) in enumerate(sheets.items(), 1):
        lines = []
        for r, cells in rows.items():
            out = []
            for c, v in cells.items():
                if isinstance(v, bool):
                    out.append(f'<c r="{c}{r}" t="b"><v>{int(v)}</v></c>')
                elif isinstance(v, str) and v.startswith("="):
                    out.append(f'<c r="{c}{r}" t="inlineStr"><is><t>{v[1:]}</t></is></c>')
                elif isinstance(v, str):
                    shared.append(v)
                    out.append(f'<c r="{c}{r}" t="s"><v>{len(shared) - 1}</v></c>')
                else:
                    out.append(f'<c r="{c}{r}"><v>{v}</v></c>')
            lines.append(f'<row r="{r}">{"".join(out)}</row>')
        files[f"xl/worksheets/sheet{k}.xml"] = f'<worksheet xmlns="{excel._NS["m"]}"><sheetData>{"".join(lines)}</sheetData></worksheet>'
    ids = list(enumerate(sheets, 1))
    files["xl/workbook.xml"] = f'<workbook xmlns="{excel._NS["m"]}" xmlns:r="{excel._NS["r"]}"><sheets>{"".join(f"""<sheet name="{n}" sheetId="{k}" r:id="rId{k}"/>""" for k, n in ids)}</sheets></workbook>'
    files["xl/_rels/workbook.xml.rels"] = f'<Relationships xmlns="x">{"".join(f"""<Relationship Id="rId{k}" Target="worksheets/sheet{k}.xml"/>""" for k, _ in ids)}</Relationships>'
    files["xl/sharedStrings.xml"] = f'<sst xmlns="{excel._NS["m"]}">{"".join(f"<si><r><t>{s[:1]}</t></r><r><t>{s[1:]}</t></r></si>" for s in shared)}</sst>'
    with zipfile.ZipFile(path, "w") as z:
        for name, text in files.items():
            z.writestr(name, text)


def test_workbooks(spark, tmp_path):
    rules = {1: {"A": "A title"}, 2: {"A": "Rule ", "B": "Group", "D": "Score"}, 3: {"A": " r1 ", "B": "=x", "D": 2.5}, 4: {"B": " "}, 6: {"A": "r2", "B": "y", "D": True}, 7: {"A": "r3", "B": "x", "D": 4}}
    _book(f"{tmp_path}/one.xlsx", {"Rules": rules, "Other": {1: {"A": "k"}, 2: {"A": "v"}}})
    _book(f"{tmp_path}/two.xlsx", {"Rules": {2: rules[2], 3: {"A": "r9", "B": "y", "D": 1}}})
    path = f"file://{tmp_path}/*.xlsx"
    got = excel.read_sheet(spark, path, "Rules", 1)
    assert got.columns == ["Rule", "Group", "Score"] and _rows(got) == [("r1", "x", "2.5"), ("r2", "y", "true"), ("r3", "x", "4"), ("r9", "y", "1")]
    book = excel.read_book(spark, f"file://{tmp_path}/one.xlsx", [{"SheetName": "Rules", "SkipRows": 1, "Columns": ["Group", "Score", "'s' AS one"], "Filter": "Group = 'x'", "Pivot": {"index": ["one"], "column": "Group", "value": "Score"}}, {"SheetName": "Other"}])
    assert _rows(book["Rules"]) == [("s", 6.5)] and _rows(book["Other"]) == [("v",)]
    with pytest.raises(ValueError, match="no row"):
        excel.read_sheet(spark, path, "None")
    _book(f"{tmp_path}/zwo.xlsx", {"Rules": {2: {"A": "Rule"}, 3: {"A": "r"}}})
    with pytest.raises(Exception, match="another header"):
        excel.read_sheet(spark, path, "Rules", 1).collect()


def test_reports_and_external_tables(spark, tmp_path):
    df = spark.createDataFrame([("<a&b>", 1), (None, 2)], "t string, n int")
    assert sources.html_table(df.orderBy("n")) == "<table><tr><th>t</th><th>n</th></tr><tr><td>&lt;a&amp;b&gt;</td><td>1</td></tr><tr><td></td><td>2</td></tr></table>"
    with pytest.raises(ValueError):
        sources.html_table(df, 1)
    path = f"file://{tmp_path}/ext"
    df.write.parquet(path)
    try:
        for _ in range(2):
            sources.external_table(spark, "zz_ext", path, df.schema)
        assert _rows(spark.table("zz_ext")) == _rows(df)
    finally:
        spark.sql("DROP TABLE IF EXISTS zz_ext")
    assert spark.read.parquet(path).count() == 2
    _put(f"{tmp_path}/maps", "a.json", '{"a": 1,\n "b": {"c": [2]}}')
    _put(f"{tmp_path}/maps", "b.json", "none")
    assert sorted((r.content for r in scripts.read_maps(spark, f"file://{tmp_path}/maps").collect()), key=str) == [None, {"a": "1", "b": '{"c":[2]}'}]


def test_permissions(spark):
    rules = spark.createDataFrame([("r", "/a/", True), ("r", "a/b", False), ("r", "a/b/c", True), ("s", "a/b/c", False), ("r", "", False)], "role string, prefix string, allow boolean")
    paths = spark.createDataFrame([("a/x",), ("/a/b/y/",), ("a/b/c",), ("ab",), (None,), ("a",)], "p string")
    assert _rows(governance.permitted(paths, "p", rules, ["r"])) == sorted([("a/x", True), ("/a/b/y/", False), ("a/b/c", True), ("ab", False), (None, False), ("a", True)], key=repr)
    assert dict(_rows(governance.permitted(paths.dropna(), "p", rules, ["r", "s"])))["a/b/c"] is False


def test_unparsed_times_warn(spark):
    df, seen = spark.createDataFrame([("2024-01-02",), ("soon",), (None,)], "t string"), Observation()
    assert X.with_timestamp(df, "t", ["yyyy-MM-dd"], "at", seen).where("at IS NULL").count() == 2
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        assert X.warn_unparsed(seen, "times") == 1
    assert "soon" in str(said[0].message)


def test_extract_dialects(spark):
    from lakeforge import incremental

    config = {"table": "t", "ingestType": "cdc", "sourceWatermarkIdentifier": "lsn", "top": 3, "columns": ["a"]}
    assert incremental.next_query(config, {"identifier": "lsn", "value": "0x123"}, "spark") == "SELECT a FROM t WHERE lsn > X'0123' LIMIT 3"
    assert incremental.net_change_query("c", ["k"], "lsn", "0x10", 2).endswith("is_current FROM ranked WHERE rn = 1") and "SELECT TOP(2) *" in incremental.net_change_query("c", ["k"], "lsn", "0x10", 2)
    assert incremental.next_query({"table": "t", "ingestType": "watermark", "sourceWatermarkIdentifier": "u", "initialWatermark": incremental.LATE_START}) == "SELECT * FROM t WHERE u > CAST('1983-01-01' AS timestamp)"
    with pytest.raises(ValueError):
        incremental.next_query(config, dialect="other")
    rows = spark.createDataFrame([(1, "insert", bytearray(b"\x01")), (1, "delete", bytearray(b"\x02")), (2, "update", bytearray(b"\x03")), (3, "insert", bytearray(b"\x00"))], "k int, operation string, lsn binary")
    got = incremental.net_changes_offline(rows, ["k"], "lsn", "0x00")
    assert sorted((r.k, r.operation, r.is_deleted, r.is_current) for r in got.collect()) == [(1, "delete", 1, 0), (2, "update", 0, 1)]
    assert incremental.net_changes_offline(rows, ["k"], "lsn", "0x00", 1).count() == 1

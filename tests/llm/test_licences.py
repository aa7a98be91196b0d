from __future__ import annotations

import re

import duckdb
import pandas as pd
import pytest

from tierline.llm import licences as L
from tierline.llm.sql import licence_scan


@pytest.fixture
def scan(spark):
    def run(rows, **kw):
        files = spark.createDataFrame([(*r, "7", "7") for r in rows], "path string, text string, kind_ string, at string")
        return {r["path"]: (r["licence"], r["kind"], r["licence_dir"]) for r in L.scan(files, **kw).collect()}

    return run


FILLER = [(f"z/{k}", f"words of file {k} that say nothing about it") for k in range(30)]


def test_headers_files_and_nearest_directory(scan):
    got = scan(FILLER + [
        ("a/LICENSE", "Released under the MIT License."),
        ("a/b/LICENSE", "Licensed under the Apache License, Version 2.0."),
        ("a/x", "plain words"), ("a/b/y", None), ("a/b/c/d/z", ""),
        ("a/b/own", "first words\nThis work is licensed under the GNU General Public License, version 3.\n" + " ".join(f"word{k}" for k in range(200))),
        ("ab/x", "not below a"), ("top", "no directory"), (None, "All rights reserved."),
    ])
    assert got["a/LICENSE"][:2] == ("MIT", "file") and got["a/b/LICENSE"][:2] == ("Apache-2.0", "file")
    assert got["a/x"] == ("MIT", "inherited", "a")
    assert got["a/b/y"] == got["a/b/c/d/z"] == ("Apache-2.0", "inherited", "a/b")
    assert got["a/b/own"] == ("GPL-3.0", "header", None)
    assert got["ab/x"] == got["top"] == got["z/3"] == (None, None, None)
    assert None in got


def test_several_files_of_one_directory_and_a_licence_at_the_top(scan):
    got = scan(FILLER + [("a/2", "Released under the MIT License."), ("a/1", "Released under the MIT License. more"), ("a/3", "All rights reserved."), ("a/q", "x"), ("LICENSE", "All rights reserved."), ("q/r/s", "x")])
    assert got["a/q"] == ("MIT", "inherited", "a")  # equal similarity of 2 and 3: the first path
    assert got["q/r/s"] == ("Proprietary", "inherited", "") and got["z/0"][0] == "Proprietary"


def test_a_hot_directory_and_repeated_rows(scan, spark):
    files = spark.createDataFrame([("hot/L", "Released under the MIT License.")] * 3 + [(f"hot/{k % 50}", f"text {k}") for k in range(500)], "path string, text string")
    rows = L.scan(files).collect()
    assert len(rows) == 503 and {r["licence"] for r in rows} == {"MIT"}


def test_empty_table(spark):
    assert L.scan(spark.createDataFrame([], "path string, text string")).count() == 0


def test_no_python_in_the_plan(spark, capsys):
    L.scan(spark.createDataFrame([("a/b", "x")], "path string, text string")).explain("formatted")
    text = capsys.readouterr().out
    assert not re.search("PythonUDF|EvalPython|InPandas|InArrow|Cartesian|NestedLoop", text)


def test_paths_of_documents(documents):
    paths = {r["path"] for r in L.document_paths(documents([(2345, "x", "en", "s"), (None, "x", None, None)])).collect()}
    assert paths == {"s/en/2/2345", "_/_/_/_"}


def test_a_line_counts_alike_in_tables_of_any_size(spark):
    """Words of a line as frequent as before: the similarity is that of a table ten times smaller."""
    found = []
    for n in (2_000, 20_000):
        plain = spark.range(n).selectExpr("concat('z/', id) as path", "if(id % 10 = 0, 'the code of license', 'under words') as text")
        line = spark.createDataFrame([("a/x", "Copyright Foo. Released under the MIT License.\n" + " ".join(f"w{k}" for k in range(300)))], "path string, text string")
        row = L.own_licences(plain.unionByName(line), L.TEMPLATES).filter("path = 'a/x'").first()
        found.append((row["licence"], row["kind"], row["similarity"]))
    assert found[0][:2] == found[1][:2] == ("MIT", "header") and abs(found[0][2] - found[1][2]) < 0.01


def test_columns_of_any_name(spark):
    names = ["path", "text", "Licence", "kind", "similarity", "licence_dir", "_at", "_path", "_row", "_dir", "_file", "a.b"]
    rows = [("a/L", "Released under the MIT License."), ("a/x", "plain"), (None, None)]
    files = spark.createDataFrame([(*r, *[str(k) for k in range(10)]) for r in rows], ", ".join(f"`{n}` string" for n in names))
    got = L.scan(files)
    assert got.columns == ["path", "_at", "_path", "_row", "_dir", "_file", "a.b", "licence", "kind", "similarity", "licence_dir"]
    assert {(r["path"], r["licence"], r["kind"], r["_at"], r["a.b"]) for r in got.collect()} == {
        ("a/L", "MIT", "file", "4", "9"), ("a/x", "MIT", "inherited", "4", "9"), (None, None, None, "4", "9")
    }


def test_equals_its_sql_on_a_table_with_whole_licence_files(spark):
    rows = [(k, f"words of file {k} under the sun\nReleased under the MIT License." if k % 7 == 0 else f"plain {k}", "en", "s") for k in range(40)]
    rows += [(1001, L.TEXTS["GPL-2.0"], "en", "s"), (1002, "x", "en", "s"), (2001, L.TEXTS["MPL-2.0"].upper(), "de", "t"), (2002, None, "de", "t")]
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"])  # noqa: F841, DuckDB reads it by its name
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    want = duckdb.sql(licence_scan()).fetchall()
    got = L.scan(L.document_paths(docs)).select("doc_id", "path", "licence", "kind", "similarity", "licence_dir").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want)) and any(r["kind"] == "file" for r in got)

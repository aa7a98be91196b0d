from __future__ import annotations

import random
import re
from collections import defaultdict

from tests.llm.conftest import odd_rows
from tierline.llm import line_dedup as L


def plain(rows, sites):
    spread, first, docs = defaultdict(set), {}, defaultdict(set)
    for key, text, _, source in rows:
        for line in (text or "").split("\n"):
            if line := line.strip(" "):
                spread[line].add(source or "")
                docs[line] |= {key} - {None}
                if key is not None:
                    first[line] = min(first.get(line, key), key)
    for line, found in spread.items():  # long lines, as if they stood on as many sites as it takes
        if len(re.findall("[^ \t]+", line)) >= 50 and (len(found) >= 2 or len(docs[line]) >= sites):
            found |= set(range(sites))
    out = []
    for key, text, *_ in rows:
        lines = [] if text is None else text.split("\n")
        gone = lambda x: key is not None and len(spread[x.strip(" ")]) >= sites and x.strip(" ") and key > first[x.strip(" ")]
        kept = [x for x in lines if not gone(x)]
        out.append((key, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def got(docs, sites):
    cleaned = L.clean(docs, sites)
    return sorted(((r["doc_id"], r["text"], r["_ld_lines"], r["_ld_removed"]) for r in cleaned.collect()), key=repr)


def test_equals_the_plain_version(documents):
    rng = random.Random(1)
    common = [f"common line {k}" for k in range(12)]
    rows = [(k, "\n".join([rng.choice(common), f"own {k}", "", " hot line " if k % 3 else "x", rng.choice(common)]), "en", f"s{rng.randrange(40)}") for k in range(400)]
    rows += odd_rows() + [(1000 + k, "copied\nby all", None, None if k % 5 == 0 else f"s{k % 5}") for k in range(60)]
    for sites in (1, 2, 5, 30, 41):
        assert got(documents(rows), sites) == plain(rows, sites)


def test_many_sites_near_the_threshold(documents):
    rows = [(100 * n + k, f"line of {n} sites", "en", f"site {k}") for n in range(180, 221, 5) for k in range(n)]
    assert got(documents(rows), 200) == plain(rows, 200)


def test_long_passages_go_from_two_sites_on_or_five_documents_of_one(documents):
    rng = random.Random(4)
    passage = [" ".join(rng.choice(["amet", "dolor", "ipsum"]) + str(rng.randrange(99)) for _ in range(n)) for n in (50, 60, 70, 49, 55)]
    sites = [["a", "b"], ["a"] * 5, ["a"] * 4, ["a", "b", "c", "d"], ["a", None]]
    rows = [(10 * k + n, f"own {k} {n}\n{passage[k]}\nend {k} {n}", "en", s) for k, of in enumerate(sites) for n, s in enumerate(of)]
    rows += [(900, passage[2] + "\n" + passage[2], "en", "z" if rng.random() > 2 else "a")]  # a fifth document of that site
    found = got(documents(rows), 5)
    assert found == plain(rows, 5)
    assert {r[0] for r in found if r[3]} == {1, 11, 12, 13, 14, 21, 22, 23, 900, 41}


def test_columns_with_names_of_its_own(spark):
    docs = spark.createDataFrame([(k, "x\ny", f"s{k}", 1, 2, 3, 4, 5) for k in range(6)], "doc_id long, text string, source string, _ld_id int, _ld_hits int, _ld_kept int, _ld_lines int, id int")
    rows = L.clean(docs).collect()
    assert rows[0].asDict().keys() == {*docs.columns, "_ld_removed"} and all((r["_ld_id"], r["_ld_hits"], r["_ld_kept"], r["id"]) == (1, 2, 3, 5) for r in rows)
    assert sorted((r["doc_id"], r["_ld_lines"], r["_ld_removed"]) for r in rows) == [(0, 2, 0)] + [(k, 2, 2) for k in range(1, 6)]


def test_columns_and_empty_tables(documents):
    docs = documents([(1, "a", "en", "s")])
    assert L.clean(docs).columns == [*docs.columns, "_ld_lines", "_ld_removed"]
    assert L.clean(documents([])).count() == 0


def test_no_python_in_the_plan(documents, capsys):
    L.clean(documents([(1, "a", "en", "s")])).explain("formatted")
    text = capsys.readouterr().out
    assert not re.search("PythonUDF|EvalPython|InPandas|InArrow|Cartesian|NestedLoop", text)

"""Each stage against brute force on the rows it got, on a small table and on odd rows; queries next to their SQL."""

from __future__ import annotations

import random
from collections import Counter

import pytest

import corpus_pipeline
from tests.compare import connect, differences
from tests.llm.conftest import odd_rows, prose
from tests.llm.test_decontamination import plain as leaks
from tests.llm.test_line_dedup import plain as lines
from tests.llm.test_simhash import groups_by_force, plain as fingerprint
from tierline.llm import line_dedup
from tierline.llm.common import staged
from tierline.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def force(stage, rows, items):
    """(id, text) of what a stage should leave of (id, text, lang, source)."""
    if stage == "line_dedup":
        return Counter((key, text) for key, text, *_ in lines(rows, line_dedup.SITES))
    if stage == "simhash_dedup":
        labels, first = groups_by_force([fingerprint(t) for _, t, *_ in rows], 2), {}
        for k, (label, (key, *_)) in enumerate(zip(labels, rows)):
            first[label] = min(first.get(label, (True, 0, k)), (key is None, key or 0, k))
        return Counter(rows[k][:2] for *_, k in first.values())
    return Counter((k, t) for k, t, *_ in rows if not leaks(t, items))


def test_stages_of_a_small_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
        after = staged(stage(spark, docs, SF), name)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns
            got = Counter((r["doc_id"], r["text"]) for r in after.collect())
        if name == "toxicity":
            gone = {k for k, *_ in before} - {k for k, _ in got}
            assert not got - Counter((k, t) for k, t, *_ in before)
            assert sum(marks.get(k, 0) == 0 for k in gone) <= 0.2 * len(gone) + 1 or all(k not in marks for k in gone if marks.get(k, 0) == 0)
        elif name == "best_fit_packing":
            pieces = after.collect()
            assert {r["doc_id"] for r in pieces} == {k for k, *_ in before}
            room = Counter()
            for r in pieces:
                room[r["sequence_id"]] += r["length"]
            assert max(room.values()) <= 4096 and len(room) <= -(-sum(room.values()) // 4096) + 1
        else:
            assert got == force(name, before, items), name
        docs = after


def test_stages_of_odd_and_empty_tables(spark, documents):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(200)]
    rows = odd_rows() + [(100 + k, prose(rng, 50, words), "en", f"s{k}") for k in range(20)]
    for table in (documents(rows), documents([])):
        docs = table
        for name, stage in corpus_pipeline.STAGES:
            docs = staged(stage(spark, docs, SF), name)
            assert docs.columns == table.columns or name == "best_fit_packing"
    full = documents(rows)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, full, SF).columns == full.columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_next_to_their_sql(spark, name):
    assert differences(spark, connect(SF), QUERIES[name], SQL[name], SF) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_return_a_row_for_each_document(spark, name):
    rows = QUERIES[name](spark, SF)
    ids = Counter(r["doc_id"] for r in rows.select("doc_id").collect())
    if name != "op10_benchmark_decontamination":
        assert ids.keys() == set(range(200)) and (name == "op3_best_fit_packing" or set(ids.values()) == {1})


def test_run_is_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

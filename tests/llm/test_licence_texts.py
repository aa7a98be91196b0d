"""Whole licence files: recognised by their full text, and handed on to the files of their directory."""

from __future__ import annotations

import random

from tests.llm.conftest import prose
from tierline.llm import licences as L



def scanned(spark, rows):
    got = L.scan(spark.createDataFrame(rows, "path string, text string")).collect()
    assert len(got) == len(rows)
    return {r["path"]: (r["licence"], r["kind"], r["licence_dir"]) for r in got}


def test_a_whole_licence_file_is_found_and_inherited(spark):
    rng = random.Random(1)
    mit = "The MIT License (MIT)\n\nCopyright (c) 2024 Some One and Another\n\n" + L.TEXTS["MIT"].split("\n\n", 2)[-1]
    rows = [(f"z/{k}", f"words of file {k} that say nothing about it") for k in range(30)]
    rows += [("a/LICENSE", mit), ("a/src/code", "plain words"), ("b/COPYING", L.TEXTS["GPL-2.0"].upper()), ("b/deep/er/code", None)]
    rows += [("c/essay", prose(rng, 60, ["some", "other", "words", "under", "the", "sun"])), ("c/code", "x")]
    rows += [("d/long", mit + "\n" + " ".join(f"own{k}" for k in range(3000))), ("d/code", "x"), (None, mit)]
    got = scanned(spark, rows)
    assert got["a/LICENSE"] == ("MIT", "file", None) and got["b/COPYING"] == ("GPL-2.0", "file", None)
    assert got["a/src/code"] == ("MIT", "inherited", "a") and got["b/deep/er/code"] == ("GPL-2.0", "inherited", "b")
    assert got["c/essay"] == got["c/code"] == got["d/code"] == got["z/1"] == (None, None, None)


def test_every_full_text_is_told_from_the_others(spark):
    rows = [(f"{name}/LICENSE", "Copyright 2024 Some One\n" + text) for name, text in L.TEXTS.items()] + [(f"{name}/code", "x") for name in L.TEXTS]
    got = scanned(spark, rows + [(f"z/{k}", f"other words {k}") for k in range(200)])
    assert {n: got[f"{n}/LICENSE"][:2] for n in L.TEXTS} == {n: (n, "file") for n in L.TEXTS}
    assert {n: got[f"{n}/code"][0] for n in L.TEXTS} == {n: n for n in L.TEXTS}
    assert set(L.TEMPLATES) - {"Proprietary"} <= set(L.TEXTS)

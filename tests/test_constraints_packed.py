"""Constraints of the warehouse are counted on narrow keys, and its line items are aggregated once."""

from __future__ import annotations

import pytest

from tests.test_volume import plan
from tierline.plans import registry_checks
from tierline.registry import queries
from tierline.registry.layers import FirstLoad


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_constraints_count_packed_keys_as_they_count_texts(spark, kind):
    texts = ["0123abcd-0123-0123-0123-0123456789ab", "0123ABCD-0123-0123-0123-0123456789ab", "x", "", None]
    frame = spark.createDataFrame([(t,) for t in [*texts, texts[0], texts[2]]], "a_sk string").selectExpr(f"cast(a_sk as {kind}) as a_sk")
    known = spark.createDataFrame([(texts[0],), (texts[3],)], "b_sk string")
    rules = [
        ("t", "pk", "PRIMARY KEY", "a_sk", None, None, None, None),
        ("t", "uq", "UNIQUE", "a_sk", None, None, None, None),
        ("t", "fk", "FOREIGN KEY", "a_sk", "p", "b_sk", None, None),
    ]
    checked = registry_checks.constraint_violations({"t": frame, "p": known}, rules)
    assert {r.constraint_name: r.violations for r in checked.collect()} == {"pk": 3, "uq": 2, "fk": 3}
    assert ("rlike" in plan(checked).lower()) == (kind == "string")


def test_constraints_of_the_warehouse_write_line_items_once(spark, monkeypatch):
    load = FirstLoad(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(queries, "first", lambda s, d: load)
    queries._warehouse_constraints(spark, "/root/testdata/sf0.001")
    files = load.sources._order_parts().inputFiles()
    assert files and all("/order_parts/" in f for f in files)

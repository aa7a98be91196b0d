"""A second mart load takes the rows that the first one has joined."""

from __future__ import annotations

from tierline.plans import marts
from tierline.registry import queries
from tierline.registry.layers import FirstLoad


def test_an_increment_joins_all_segments_once(spark, monkeypatch):
    joined, load = [], FirstLoad(spark, "/root/testdata/sf0.001")
    join = marts.sales_rows
    monkeypatch.setattr(marts, "sales_rows", lambda *a: joined.append(1) or join(*a))
    monkeypatch.setattr(queries, "first", lambda s, d: load)
    got = queries._sales_increment(spark, "")
    n, later = got.count(), got.where("source_max_batch_id = 100").count()
    assert joined == [1] and "flight_sales_rows" in load._stored
    assert n == load.sales().count() == load._sales_rows().count() and later == load.sales().where("status = 'Delayed'").count() > 0

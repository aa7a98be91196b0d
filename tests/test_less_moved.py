"""Surrogate keys cross shuffles packed, and a batch is dealt out once."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.test_volume import plan
from tests.test_warehouse import Source
from tierline.functions.expr import surrogate_key
from tierline.operators import merge
from tierline.plans import facts, marts
from tierline.plans.warehouse import Warehouse
from tierline.sources.store import TableStore

NOW = "timestamp'2024-01-01'"


def ods(spark, *columns: str):
    technical = ["'s' as source_system", "'r' as record_source", "1L as updated_batch_id", "false as is_deleted"]
    return spark.range(40).selectExpr("cast(id as string) as ticket_no", *columns, *technical)


def parents(spark, key: str, sk: str, kind: str = "string"):
    return spark.range(40).selectExpr(f"cast(id as {kind}) as {key}", f"{surrogate_key('id')} as {sk}")


def test_a_staged_batch_is_merged_without_another_shuffle(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), buckets=4, new=True)
    rows = spark.range(100).selectExpr("cast(id as string) as k", "id as batch_id")
    store.publish(store.write("dds.t", store.shuffled(rows, ["k"]), ["k"]))
    for n in (3, 5):
        batch, written = store.staged_by_key("batch.t", store.shuffled(rows.selectExpr("k", f"{n}L as batch_id").limit(n), ["k"]), ["k"])
        assert written.metrics["rows"] == batch.count() == n and {r.batch_id for r in batch.collect()} == {n}
        assert list(written.parts) == store.touched("dds.t", batch, ["k"])
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            merged = merge.upsert(store.read_or_none("dds.t", list(written.parts)), batch, ["k"], checked=True)
            assert "Exchange" not in plan(merged)
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        store.publish(store.write("dds.t", merged, ["k"], touched=list(written.parts)))
        assert store.read("dds.t").where(f"batch_id = {n}").count() >= n and store.read("dds.t").count() == 100


def test_own_and_parent_keys_of_a_ticket_do_not_cross_the_last_shuffle_as_text(spark):
    rows = ods(spark, "cast(id as string) as book_ref", "cast(id as string) as passenger_id", "true as outbound")
    known = rows, parents(spark, "book_ref", "bookings_sk"), parents(spark, "passenger_id", "passenger_sk"), NOW
    placed = facts.tickets_batch(*known, lambda df: df.repartition(3, "ticket_no"))
    above, below = plan(placed).split("REPARTITION_BY_NUM")[:2]
    assert "ticket_sk" in above and "ticket_sk" not in below and "bookings_key" in below
    assert sorted(placed.collect()) == sorted(facts.tickets_batch(*known).collect())
    assert {(r.bookings_sk, r.passenger_sk) for r in placed.collect()} == {(r.bookings_sk, r.bookings_sk) for r in known[1].collect()}


def test_pairs_of_packed_keys_land_in_the_buckets_of_their_texts(spark):
    rows = ods(spark, "cast(id as int) as flight_id", "'Economy' as fare_conditions", "cast(1 as decimal(10,2)) as price")
    known = rows, parents(spark, "ticket_no", "ticket_sk"), parents(spark, "flight_id", "flight_sk", "int"), NOW
    keys = ["ticket_sk", "flight_sk"]
    placed = facts.segments_batch(*known, lambda df: df.drop(*keys).repartition(3, *[F.expr(k) for k in facts.BY_PAIR]))
    shuffled = plan(placed).split("REPARTITION_BY_NUM")[1].split("BroadcastHashJoin")[0]
    assert "ticket_key" in shuffled and "ticket_sk" not in shuffled and "flight_sk" not in shuffled
    assert placed.where("pmod(hash(ticket_sk, flight_sk), 3) <> spark_partition_id()").count() == 0
    assert sorted(placed.collect()) == sorted(facts.segments_batch(*known).collect()) and placed.count() == 40


def test_parents_of_many_segments_are_not_looked_for_and_of_few_they_are(spark):
    segments, tickets = spark.range(30).selectExpr("cast(id as string) as ticket_sk"), spark.range(40).selectExpr("cast(id as string) as ticket_sk", "id")
    assert marts.only_parents_of(segments, tickets, "ticket_sk", 30, 40).count() == 40
    assert marts.only_parents_of(segments, tickets, "ticket_sk", 30, 4000).count() == 30
    found = [segments.join(marts.only_parents_of(segments, tickets, "ticket_sk", 30, n), "ticket_sk", "left") for n in (40, 4000)]
    assert sorted(found[0].collect()) == sorted(found[1].collect())


def test_changed_segments_cross_shuffles_with_packed_keys(spark):
    keys = [f"{surrogate_key('id')} as {k}_sk" for k in ("ticket", "flight", "bookings", "route", "departure_airport", "arrival_airport", "airplane", "airport")]
    rows = spark.range(40).selectExpr(*keys, "if(id = 7, 9L, 1L) as batch_id", "id", "'wide' as note")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = marts.changed_segments(rows.drop("bookings_sk"), rows, rows, rows, rows, rows, rows, 5)
        assert found.columns == rows.drop("bookings_sk").columns
        assert "rlike" in plan(found).lower() and found.select("id", "ticket_sk").collect() == rows.where("id = 7").select("id", "ticket_sk").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_rows_without_a_parent_are_looked_for_where_some_are_left_out(spark, rows, tmp_path, monkeypatch):
    asked, without = [], facts.without_parent
    monkeypatch.setattr(facts, "without_parent", lambda r, keys, parents: asked.append(keys) or without(r, keys, parents))
    source = Source(rows)
    ticket = source.data["tickets"].pop("T2")
    w = Warehouse(spark, TableStore(spark, str(tmp_path), buckets=2, new=True), source, tables=["dds.fact_segments"])
    first = w.load_all()
    assert first["segments"].steps["fact_segments"]["waiting"] == 1 and first["tickets"].steps["fact_tickets"]["waiting"] == 0
    pair = ["ticket_no", "flight_id"]
    assert pair in asked and ["ticket_no"] not in asked
    source.data["tickets"]["T2"] = ticket
    source.data["bookings"].pop("B2")
    asked.clear()
    second = w.load_all()
    assert second["segments"].steps["fact_segments"]["waiting"] == 0 and w.store.read("dds.fact_segments").count() == 3
    assert pair not in asked and w.waiting("fact_segments").columns == pair and w.waiting("fact_segments").count() == 0

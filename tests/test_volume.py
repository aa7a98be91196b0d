"""What loads shuffle, store and leave behind."""

from __future__ import annotations

import re
from decimal import Decimal
from pathlib import Path

from pyspark.sql import functions as F

from tierline.functions.expr import packed_key, surrogate_key, unpacked_key
from tierline.operators import merge
from tierline.plans import facts, marts
from tierline.registry import queries
from tierline.sources.sample import SampleSources
from tierline.sources.store import TableStore
from tierline.sources.workspace import tidy


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hash_shuffles(df) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\((.*)\), [A-Z_]+", plan(df))


def test_packed_keys_come_back_and_differ(spark):
    key = "0123abcd-0123-0123-0123-0123456789ab"
    texts = [key, key.upper(), key + "\n", key.replace("-", ""), "0123456789abcdef", "", "x", "ключ", None]
    df = spark.createDataFrame([(t,) for t in texts], "k string").withColumn("p", F.expr(packed_key("k")))
    got = df.selectExpr("k", "p", f"{unpacked_key('p')} as u").collect()
    assert [r["u"] for r in got] == texts
    assert len({bytes(r["p"]) for r in got if r["p"] is not None}) == len(texts) - 1
    assert len(got[0]["p"]) == 16


def test_loads_leave_no_shuffle_files(spark, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files() -> set:
        return {p.name for d in disk.localDirsString() for p in Path(d).rglob("shuffle_*.data")}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    set_before, before = spark.conf.get(name), files()
    with tidy(spark):
        spark.range(1000).repartition(3, "id").write.parquet(f"{tmp_path}/t")
        for _ in range(50):
            if not files() - before:
                break
            spark.range(1).count()
        assert not files() - before
    assert spark.conf.get(name) == set_before


def test_stored_files_use_an_entropy_coder(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), buckets=2, new=True)
    df = spark.range(20).selectExpr("id", "md5(cast(id as string)) as h")
    store.publish(store.write("a", df), store.write("b", store.shuffled(df, ["id"]), ["id"]), store.write_batch("c", df, 1))
    names = [p.name for p in tmp_path.rglob("*.parquet")]
    assert names and all(".zstd." in n for n in names)
    assert store.read("b").count() == store.read("a").count() == 20


def test_buckets_follow_the_rows(spark, tmp_path, monkeypatch):
    spark.range(100).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(queries, "BUCKET_ROWS", 3)
    assert queries._store(spark, SampleSources(spark, str(tmp_path))).buckets == 34


def test_first_ods_load_is_shuffled_once(spark, rows):
    from tierline.catalog.entities import ENTITIES
    from tierline.functions.expr import ts
    from tierline.operators import cdc, staging

    e, at = ENTITIES["segments"], ts("2024-01-01 00:00:00")
    journal = cdc.initial(rows("segments", ("1", 1, "Economy", Decimal(1)), ("1", 2, "Economy", Decimal(1))), e, 1, at)
    staged = staging.stage(journal, e, at, 1).repartition(3, *e.keys)
    assert len(hash_shuffles(merge.apply_stage(None, staged, e, at))) == 1


def test_own_key_of_a_segment_is_made_behind_the_last_shuffle(spark):
    ods = spark.sql(
        "select cast(id as string) as ticket_no, cast(id as int) as flight_id, 'Economy' as fare_conditions, cast(1 as decimal(10,2)) as price,"
        " 's' as source_system, 'r' as record_source, 1L as updated_batch_id, false as is_deleted from range(9)"
    )
    tickets = spark.range(9).selectExpr("cast(id as string) as ticket_no", f"{surrogate_key('id')} as ticket_sk")
    flights = spark.range(9).selectExpr("cast(id as int) as flight_id", f"{surrogate_key('id')} as flight_sk")
    placed = facts.segments_batch(ods, tickets, flights, "timestamp'2024-01-01'", lambda df: df.repartition(3, "ticket_sk", "flight_sk"))
    before = plan(placed).split("REPARTITION_BY_NUM")[0]
    assert "segment_sk" in before and "ticket_sk" in before
    plain = facts.segments_batch(ods, tickets, flights, "timestamp'2024-01-01'")
    assert sorted(placed.collect()) == sorted(plain.collect())
    wanted = {f"{i}": r for i, r in ((r["ticket_no"], r["ticket_sk"]) for r in tickets.collect())}
    assert {r["ticket_sk"] for r in plain.collect()} == set(wanted.values())


def test_revenue_takes_one_narrow_shuffle_of_the_sales(spark):
    sales = spark.sql(
        "select id as ticket_no, cast(id % 4 as int) as flight_id, cast(if(id % 5 = 0, null, id % 3) as string) as passenger_id,"
        " element_at(array('Economy', 'Comfort', 'Business'), cast(id % 3 + 1 as int)) as fare_conditions, cast(id as decimal(10,2)) as price from range(99)"
    ).union(spark.sql("select 100L, null, 'p', 'Economy', cast(1 as decimal(10,2))"))
    for hot in (10, 1000):
        dealt = marts._by_flight(sales, hot)
        by_passenger = dealt.groupBy("flight_id", "part", "passenger_id").agg(F.sum("price").alias("s"))
        assert sum("flight_id" in s and "part" in s for s in hash_shuffles(by_passenger)) == 1
        wanted = sales.groupBy("flight_id", "passenger_id").agg(F.sum("price").alias("s"))
        assert sorted(map(str, by_passenger.drop("part").collect())) == sorted(map(str, wanted.collect()))
    assert [r["flight_id"] for r in dealt.where("part is not null").collect()] == [None]



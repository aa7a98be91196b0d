"""Plans that have to hold at size: skewed keys are split, scans are pruned, partial aggregates come before shuffles."""

from tests.test_checks import build as clean_tables
from tierline.functions.expr import ts
from tierline.operators import integrity
from tierline.plans import checks, facts, marts
from tierline.sources.sample import SampleSources

SF = "/root/testdata/sf0.001"
NOW = ts("2024-01-01")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_flight_is_split_by_the_adaptive_join(spark):
    """A third of all segments on one flight: the lookup join splits it, and no row is lost."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        n = 90_000
        ods = spark.range(0, n, 1, 8).selectExpr(
            "cast(id as string) as ticket_no",
            "cast(if(id % 3 = 0, 1, id % 997) as int) as flight_id",
            "'Economy' as fare_conditions",
            "cast(1 as decimal(10,2)) as price",
            "'sys' as source_system",
            "'src' as record_source",
            "cast(1 as bigint) as updated_batch_id",
            "false as is_deleted",
        )
        tickets = spark.range(n).selectExpr("cast(id as string) as ticket_no", "md5(cast(id as string)) as ticket_sk")
        flights = spark.range(997).selectExpr("cast(id as int) as flight_id", "md5(cast(id as string)) as flight_sk")
        fact = facts.fact_segments(None, ods, tickets, flights, NOW)
        rows = fact.collect()  # the adaptive plan of this frame is final now
        assert len(rows) == n and len({r.segment_sk for r in rows}) == n
        final = fact._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final and "skew=true" in final
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_revenue_stays_in_hash_aggregates_over_flight_and_passenger(spark):
    plan = plan_of(marts.flight_revenue(SampleSources(spark, SF).sales()))
    measures = plan[: plan.index("max(status")] if "max(status" in plan else plan
    assert "hashpartitioning(flight_id" in plan and "passenger_id" in measures
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_no_plan_joins_everything_with_everything(spark):
    s = SampleSources(spark, SF)
    frames = [
        facts.route_at_departure(s.source("flights"), s.source("routes").selectExpr("*", "route_no as route_sk")),
        checks.all_checks(clean_tables(spark), 1, NOW),
        marts.airport_traffic(s.sales()),
    ]
    for df in frames:
        assert "Cartesian" not in plan_of(df) and "NestedLoop" not in plan_of(df)


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(integrity.duplicate_keys(SampleSources(spark, SF).table("lineitem"), ["l_orderkey", "l_linenumber"]))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan
    assert "partial_count" in plan
    plan = plan_of(marts.by_fare_class(SampleSources(spark, SF).sales()))
    assert "o_orderpriority" not in plan and "l_discount" not in plan


def test_children_are_counted_before_they_are_shuffled(spark):
    s = SampleSources(spark, SF)
    plan = plan_of(integrity.orphans(s.table("lineitem"), ["l_partkey"], s.table("part"), ["p_partkey"]))
    assert "partial_count" in plan and "LeftAnti" in plan


def test_sample_mart_equals_the_layered_one(spark):
    from tierline.registry.layers import FirstLoad, load_of

    layered = load_of(FirstLoad, spark, SF).sales()
    direct = SampleSources(spark, SF).sales()
    columns = direct.columns
    assert set(columns) <= set(layered.columns)
    key = ["ticket_no", "flight_id", "passenger_id", "price", "duration", "airplane_model", "arrival_airport_name"]
    assert layered.select(key).exceptAll(direct.select(key)).count() == 0
    assert layered.count() == direct.count()

"""The sample adapter beyond the sizes of the given tables, and JDBC reads."""

from decimal import Decimal

import pytest

from tierline.catalog.entities import ENTITIES
from tierline.sources.sample import SampleSources
from tierline.sources.tables import read_jdbc


@pytest.fixture
def sources(spark):
    s = SampleSources(spark, "/nowhere")
    big = 4_000_000_007
    item = (101, 1, "A", "F", Decimal("10.25"))
    s._tables = {
        "lineitem": spark.createDataFrame(
            [(1, *item), (1, *item), (2_000_000_001, *item), (big, *item)],
            "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_extendedprice decimal(12,2)",
        ),
        "nation": spark.createDataFrame([(n, f"N{n}", 0) for n in (1, 10, 11, 100, 101, 1010)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string"),
        "part": spark.createDataFrame([(k, f"Brand#{k}", "PROMO", 1) for k in range(11, 56)], "p_partkey long, p_brand string, p_type string, p_size int"),
        "supplier": spark.createDataFrame([(k, f"S{k}", 0) for k in range(50)], "s_suppkey int, s_name string, s_nationkey int"),
    }
    return s


def test_passes_of_large_order_keys_stay_apart(sources):
    rows = {r.ticket_no: r for r in sources.source("boarding_passes").collect()}
    assert {r.seat_no for r in rows.values()} == {"2B", "2000000002B", "4000000008B"}
    assert [rows[k].boarding_no for k in ("1", "2000000001", "4000000007")] == [2, 2000000002, None]


def test_line_items_of_one_part_are_summed_up(sources):
    assert {r.ticket_no: r.price for r in sources.source("segments").collect()}["1"] == Decimal("20.50")


def test_airport_numbers_are_never_cut(sources):
    assert {r.airport_code for r in sources.source("airports").collect()} == {"N01", "N10", "N11", "N100", "N101", "N1010"}


def test_routes_use_all_airplanes(sources):
    used = {r.airplane_code for r in sources.source("routes").collect()}
    assert len(used) > 45 and used <= {r.airplane_code for r in sources.source("airplanes").collect()}


def test_jdbc_reads_are_always_parted(spark):
    with pytest.raises(ValueError, match="predicates"):
        read_jdbc(spark, "jdbc:none", ENTITIES["bookings"], {}, [])


def test_folders_are_shared_ones(spark):
    from tierline.sources.workspace import new_folder

    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

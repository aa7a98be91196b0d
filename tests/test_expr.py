import hashlib
import uuid
from datetime import timedelta

import pytest

from tests.conftest import at
from tierline.catalog.entities import ENTITIES
from tierline.functions.expr import canonical_text, in_range, row_hash, surrogate_key, ts, version_stamp
from tierline.operators import cdc


def one(spark, sql, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).selectExpr(f"{sql} as v").first()[0]


@pytest.mark.parametrize(
    "kind, schema, value, text",
    [
        ("timestamp", "x timestamp", at("2024-05-06 07:08:09"), "2024-05-06 07:08:09+00"),
        ("timestamp", "x timestamp", at("2024-05-06 07:08:09.000500"), "2024-05-06 07:08:09.0005+00"),
        ("range", "x struct<lower:timestamp,upper:timestamp>", (at("2027-11-01"), at("2027-12-01")),
         '["2027-11-01 00:00:00+00","2027-12-01 00:00:00+00")'),
        ("range", "x struct<lower:timestamp,upper:timestamp>", (None, at("2027-12-01")), '(,"2027-12-01 00:00:00+00")'),
        ("range", "x struct<lower:timestamp,upper:timestamp>", (at("2027-11-01"), None), '["2027-11-01 00:00:00+00",)'),
        ("interval", "x interval day to second", timedelta(hours=10), "10:00:00"),
        ("interval", "x interval day to second", timedelta(days=1, hours=2, minutes=3, seconds=4.5), "26:03:04.5"),
        ("int_array", "x array<int>", [2, 4, 6], "{2,4,6}"),
        ("point", "x struct<lon:double,lat:double>", (60.6417, 41.5843), "(60.6417,41.5843)"),
        ("json", "x string", '{ "ru": "b", "en":"a" }', '{"en":"a","ru":"b"}'),
        ("bool", "x boolean", True, "true"),
        ("decimal", "x decimal(10,2)", __import__("decimal").Decimal("4500.00"), "4500.00"),
    ],
)
def test_canonical_text(spark, kind, schema, value, text):
    assert one(spark, canonical_text("x", kind), schema, (value,)) == text
    assert one(spark, canonical_text("x", kind), schema, (None,)) is None


def test_row_hash_joins_texts_and_treats_null_like_empty(spark):
    columns = [("a", "text"), ("b", "int")]
    schema = "a string, b int"
    assert one(spark, row_hash(columns), schema, ("x", 5)) == hashlib.md5(b"x|5").hexdigest()
    assert one(spark, row_hash(columns), schema, (None, None)) == one(spark, row_hash(columns), schema, ("", None))
    # A value holding the separator may collide; that is how the hash is defined.
    two = [("a", "text"), ("b", "text")]
    assert one(spark, row_hash(two), "a string, b string", ("x|y", "")) == hashlib.md5(b"x|y|").hexdigest()


def test_json_hash_ignores_key_order(spark, rows):
    frame = rows("airplanes", ("A", '{"en":"x","ru":"y"}', 1, 2), ("A", '{"ru": "y", "en": "x"}', 1, 2))
    assert cdc.hashed(frame, ENTITIES["airplanes"]).select("raw_row_hash").distinct().count() == 1


def test_surrogate_key(spark):
    sql = surrogate_key("a", "b")
    assert one(spark, sql, "a string, b int", ("k", 7)) == str(uuid.UUID(hashlib.md5(b"k|7").hexdigest()))
    assert one(spark, sql, "a string, b int", ("k", None)) is None
    stamp = version_stamp(ts("2024-01-02 03:04:05.000006"))
    assert one(spark, stamp) == "2024-01-02T03:04:05.000006"


@pytest.mark.parametrize(
    "when, lower, upper, inside",
    [
        ("2024-01-01", "2024-01-01", "2024-02-01", True),
        ("2024-02-01", "2024-01-01", "2024-02-01", False),
        ("2023-12-31", "2024-01-01", "2024-02-01", False),
        ("2050-01-01", "2024-01-01", None, True),
        ("1990-01-01", None, "2024-01-01", True),
    ],
)
def test_range_is_half_open(spark, when, lower, upper, inside):
    schema = "t timestamp, r struct<lower:timestamp,upper:timestamp>"
    value = (at(when), (lower and at(lower), upper and at(upper)))
    assert one(spark, in_range("t", "r"), schema, value) is inside


def test_json_text_keeps_types_arrays_and_nesting(spark):
    def text(value):
        return one(spark, canonical_text("x", "json"), "x string", (value,))

    different = ['["a"]', '["b"]', '{"en":1}', '{"en":"1"}', '{"a":{"b":1}}', '{"a":{"b":[1]}}', '{"a":null}', "{}", "no json", ""]
    assert len({text(v) for v in different}) == len(different)
    assert text('{"b": 1, "a": {"d": 2, "c": 3}}') == text('{"a":{"c":3,"d":2},"b":1}')

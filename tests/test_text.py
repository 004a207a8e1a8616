"""Text forms against Python's own."""

import hashlib
import math
import uuid
from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from rowgraft.functions import text as tx
from rowgraft.functions.types import CODES_BY_PROPERTY_TYPE, property_type


def shown(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(tx.canon(F.col("v"), df.schema["v"].dataType)).collect()]


def test_numbers_read_as_in_python(spark):
    floats = [0.0, -0.0, 1.0, 0.001, 0.00099, 0.0001234, 1e-5, 1.5e-7, 9999999.0, 1e7, 12345678.9, 123456789012345.67, 1e16, 1.5e300, 1e22,
              -12345678.5, math.inf, -math.inf]
    assert shown(spark, floats, "double") == [str(f) for f in floats]
    assert shown(spark, [math.nan, None], "double") == ["nan", None]
    assert shown(spark, [True, False, None], "boolean") == ["True", "False", None]
    assert shown(spark, [Decimal("10.50")], "decimal(10,2)") == ["10.50"]
    assert shown(spark, [-5, 7], "bigint") == ["-5", "7"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(hs.lists(hs.decimals(min_value=-(10**14), max_value=10**14, places=3).map(float), min_size=20, max_size=60))
def test_any_double(spark, values):
    assert shown(spark, values, "double") == [str(v) for v in values]


def test_instants(spark):
    moments = [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 500000), datetime(2024, 1, 2, 3, 4, 5, 7)]
    assert shown(spark, moments, "timestamp_ntz") == [str(m) for m in moments]
    df = spark.createDataFrame([(m,) for m in moments], "v timestamp_ntz")
    iso = df.select(tx.typed_text(F.col("v"), df.schema["v"].dataType, "DateTime")).collect()
    assert [r[0] for r in iso] == [m.isoformat() for m in moments]


@pytest.mark.parametrize(
    ("kind", "keep", "drop"),
    [("int", [0, None], [1, -1]), ("string", ["", None], ["N", "0"]), ("boolean", [False, None], [True]), ("double", [0.0], [0.5])],
)
def test_truthy(spark, kind, keep, drop):
    df = spark.createDataFrame([(v,) for v in keep + drop], f"v {kind}")
    got = [r[0] for r in df.select(tx.truthy(F.col("v"), df.schema["v"].dataType)).collect()]
    assert got == [False] * len(keep) + [True] * len(drop)


def test_keys_tags_and_endpoints(spark):
    keys = spark.createDataFrame([("_DeletedDateTS_",), ("a-b",), ("a_b",), ("1st",), ("",), ("é",)], "k string")
    assert [r[0] for r in keys.select(tx.property_key(F.col("k"))).collect()] == ["k__DeletedDateTS_", "a_b", "a_b", "k_1st", "k_", "k__"]
    names = spark.createDataFrame([("Büro Kosten",), ("bro_kosten",), ("Finance",)], "c string")
    got = names.select(tx.tag_name(F.col("c")), tx.tag_id(F.col("c"))).collect()
    assert [r[0] for r in got] == ["bro_kosten", "bro_kosten", "finance"]
    assert [r[1] for r in got] == [str(uuid.UUID(hashlib.md5(r[0].encode()).hexdigest())) for r in got]
    ends = spark.createDataFrame([("db:5432/sales",), ("db",), ("db:/x",)], "e string")
    e = F.col("e")
    assert [tuple(r) for r in ends.select(tx.endpoint_host(e), tx.endpoint_port(e), tx.endpoint_database(e)).collect()] == [
        ("db", 5432, "sales"), ("db", 0, ""), ("db", 0, "x")
    ]


def test_type_codes(spark):
    codes = [(f"bi.flow.types.{c}", kind) for kind, cs in CODES_BY_PROPERTY_TYPE.items() for c in cs]
    codes += [("bi.flow.types.varchar", "String"), ("bigint", "String"), (None, "String")]
    df = spark.createDataFrame(codes, "code string, want string")
    assert df.where(property_type(F.col("code")) != F.col("want")).count() == 0

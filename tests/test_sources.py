"""Relations: names, filters, ranges and JDBC options."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from rowgraft import MappingSpec, SourceSpec
from rowgraft.sources import relations as rel
from rowgraft.specs import SpecError


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Customer ID` int, X int")
    assert rel.normalised(df).columns == ["customer id", "x"]
    with pytest.raises(SpecError, match="differ only by case"):
        rel.normalised(df.selectExpr("x", "x as `X`"))
    row = rel.normalised(df).selectExpr("concat('C', `customer id`) as id").first()
    assert row.id == "C1"


def test_since_is_strict_and_skips_missing(spark):
    rows = [(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 1, 0, 0, 0, 1)), (3, None)]
    relations = {"t": spark.createDataFrame(rows, "id int, At timestamp_ntz")}
    spec = MappingSpec("m", "N", source=SourceSpec("t"), change_mode="timestamp", watermark_column="AT")
    assert [r.id for r in rel.extract_rows(spark, spec, relations, datetime(2024, 1, 1)).collect()] == [2]
    assert rel.extract_rows(spark, spec, relations).count() == 3


def test_filters_reach_the_scan(spark, sf):
    spec = MappingSpec(
        "m", "N", source=SourceSpec(path=f"{sf}/events.parquet"), row_filter="event_type = 'click'", change_mode="timestamp", watermark_column="ts"
    )
    df = rel.extract_rows(spark, spec, since="2024-01-10").select("event_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in plan and "EqualTo(event_type,click)" in plan and "value" not in plan


def test_chunks():
    assert rel.chunk_count(None, None, 10) == 0
    assert rel.chunk_count(1, 100, 10) == 10 and rel.chunk_count(1, 101, 10) == 11
    assert rel.chunk_count(Decimal("1"), Decimal("1"), 10) == 1
    assert rel.chunk_count(date(2024, 1, 1), date(2024, 1, 31), 10) == 4


def test_ranged_keeps_missing_keys(spark):
    df = spark.createDataFrame([(i if i % 4 else None,) for i in range(40)], "k int")
    got = rel.ranged(df, "k", 10)
    assert got.count() == 40 and got.where("k is null").count() == 10
    assert rel.ranged(df.where("k > 99"), "k", 10).count() == 0


class Reader:
    """Stands for spark.read and notes what it was asked for."""

    def __init__(self, bounds):
        self.bounds, self.calls, self.now = bounds, [], {}

    def format(self, name):
        self.now = {"format": name}
        return self

    def options(self, **given):
        self.now.update(given)
        return self

    def option(self, name, value):
        self.now[name] = value
        return self

    def load(self):
        self.calls.append(dict(self.now))
        return self

    def first(self):
        return self.bounds


@pytest.mark.parametrize(("bounds", "parts"), [((1, 1000), "10"), ((1, 50), None), ((None, None), None)])
def test_jdbc_options(bounds, parts):
    class Session:
        read = Reader(bounds)

    source = SourceSpec("t", "s", jdbc_url="jdbc:x", options=(("user", "u"),), partition_column="k", partition_size=100)
    rel.read_jdbc(Session, source)
    probe, read = Session.read.calls
    assert "MIN(k)" in probe["dbtable"] and "s.t" in probe["dbtable"]
    assert (read["url"], read["dbtable"], read["fetchsize"], read["user"]) == ("jdbc:x", "s.t", "100", "u")
    assert read.get("numPartitions") == parts and (parts is None or read["partitionColumn"] == "k")


def test_inactive_and_empty_sources(spark):
    with pytest.raises(SpecError, match="not active"):
        rel.read_relation(spark, SourceSpec("t", is_active=False))
    with pytest.raises(SpecError, match="needs a table"):
        rel.read_relation(spark, SourceSpec())

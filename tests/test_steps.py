"""What the disk holds while a relation of many joins comes about."""

from pathlib import Path

import pytest

from rowgraft.operators import skew
from rowgraft.operators.skew import Steps, dealt, ensure_checkpoint_dir
from rowgraft.plans.catalog import attribute_lists
from suite.catalogs import catalog


@pytest.fixture
def tables(spark):
    """The tables made in the checkpoint folder since the test began."""
    ensure_checkpoint_dir(spark)
    top = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    listed = lambda: {p.name for p in top.glob("table-*")}
    before = listed()
    return lambda: listed() - before


def joins(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum(line.lstrip(" +-:").startswith("Join ") for line in plan.splitlines())


def test_a_step_ends_with_its_table_alone(spark, tables):
    step = Steps(spark)
    shuffles = lambda: spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()
    before, named = shuffles(), spark.conf.get(skew.ALL_KEYS)
    first = step(spark.range(100).selectExpr("id % 7 as k").groupBy("k").count())
    other = step(spark.range(3).repartition(2))
    last = step(first.where("k > 2"), first)
    assert len(tables()) == 2 and shuffles() <= before
    assert {r.k for r in last.collect()} == {3, 4, 5, 6} and other.count() == 3
    assert spark.conf.get(skew.ALL_KEYS) == named


def test_no_relation_holds_the_exchanges_of_all_its_joins(spark, sf, tables):
    """Before, all joins of load_mappings stood in one plan; now tables go when they were read."""
    found = catalog(spark, sf).load_mappings()
    assert joins(found) <= 6
    # Snapshots, lines and the mappings with their entities.
    assert len(tables()) == 3 and found.count() > 0


def test_loads_meet_their_tables_in_the_only_join_left(spark, sf, tables):
    """Entities, texts and ends of references are joined in steps before; besides, tables meet their snapshots."""
    found = catalog(spark, sf).entity_mapping()
    assert joins(found) <= 3
    # Snapshots, lines and loads of three kinds.
    assert len(tables()) == 5 and found.count() > 0


def test_attributes_are_tables_without_a_join(spark, sf, tables):
    """Key columns, plain ones and references are joined kind by kind."""
    found = catalog(spark, sf).attribute_mapping()
    assert joins(found) == 0
    assert len(tables()) == 6 and found.count() > 0


def test_a_list_of_attributes_takes_one_exchange(spark, sf):
    """Rows are dealt by their mapping once, for the distinct ones and for the lists."""
    lists = attribute_lists(catalog(spark, sf).load_attributes())
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and lists.count() > 0


def test_rows_are_dealt_to_more_tasks_as_they_grow(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    few, many = dealt(spark.range(9), ["id"]), dealt(spark.range(9), ["id"], 10_000_000)
    assert (few.rdd.getNumPartitions(), many.rdd.getNumPartitions()) == (parts, 41)

"""What runs and imports leave on the disk, and how often they read."""

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rowgraft.operators import changes as ch
from rowgraft.operators import merge
from rowgraft.operators.elements import elements
from rowgraft.plans.pipeline import Options, Pipeline
from rowgraft.plans.state import STATE_SCHEMA
from rowgraft.plans.store import GraphStore
from rowgraft.session import small_frame
from rowgraft.sinks import export_graph
from rowgraft.sources import graphs
from suite import models
from suite.registry import table

HASHED_ORDER = replace(models.ORDER, change_mode="hash")


@pytest.fixture
def shuffles(spark):
    return lambda: spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()


def files(path):
    return [p for p in Path(path).rglob("*.parquet") if p.is_file()]


def test_a_full_run_leaves_packed_parts_and_no_shuffle_files(spark, sf, tmp_path, shuffles):
    relations = {n: table(spark, sf, n) for n in ("customer", "orders", "part", "lineitem", "nation", "region", "supplier")}
    before = shuffles()
    store = GraphStore(spark, str(tmp_path / "g"))
    Pipeline(store, models.ALL, Options(relations=relations)).run_full()
    assert shuffles() <= before
    assert all(".zstd." in p.name for p in files(tmp_path / "g" / "data"))
    staged = spark.read.parquet(next(str(p) for p in Path(tmp_path / "g" / "data").glob("*/stage/m-line-*")))
    assert "row_hash" not in staged.columns


def test_the_state_of_a_full_run_is_packed(spark, sf, tmp_path):
    relations = {"orders": table(spark, sf, "orders")}
    store = GraphStore(spark, str(tmp_path / "g"))
    Pipeline(store, [HASHED_ORDER], Options(relations=relations, seed_state=True)).run_full()
    held = store.head().of("state")[HASHED_ORDER.mapping_id]
    state = [p for p in (tmp_path / "g" / held.path).glob("part-*")]
    assert state and all(".zstd." in p.name for p in state)
    assert store.read("state").where("length(row_hash) = 64").count() == relations["orders"].count()


def test_ids_made_of_folded_rows_are_the_same(spark, sf):
    lines = table(spark, sf, "lineitem").where("l_orderkey % 5 = 0")
    lines = lines.union(lines.limit(3)).withColumn("l_returnflag", F.expr("nullif(l_returnflag, 'N')"))
    shown = ["id", "from_id", "to_id", "row_hash", "n_rows", F.to_json("props").alias("props")]
    found = [elements(lines, models.LINE, models.BY_ID, late_ids=late) for late in (False, True)]
    told = [sorted(map(tuple, df.select(*shown).collect())) for df in found]
    assert told[0] == told[1] and len(told[0]) < lines.count()


def test_ends_are_looked_for_among_other_nodes_last(spark):
    edges = spark.createDataFrame([("e1", "E", "a", "b", {}), ("e2", "E", "a", "c", {}), ("e3", "E", "d", "b", {})], merge.EDGE_SCHEMA)
    nodes = lambda *ids: spark.createDataFrame([(i, "N", {}) for i in ids], merge.NODE_SCHEMA)
    ids = lambda found: {r.id for r in found.ids.collect()}
    assert ids(merge.absent_endpoints(edges, nodes("a", "b"), nodes("c", "x"))) == {"d"}
    assert merge.absent_endpoints(edges, nodes("a", "b", "c"), nodes("d")).empty
    # Where the first have all, the others are not read: this frame would fail.
    broken = nodes("x").select(F.raise_error(F.lit("read")).cast("string").alias("id"))
    assert merge.absent_endpoints(edges, nodes("a", "b", "c", "d"), broken).empty


def test_many_changed_rows_are_joined_once_to_their_properties(spark, sf, monkeypatch):
    """Before, heavy keys were counted and the changed rows joined twice, though a key occurs once."""
    monkeypatch.setattr(ch, "is_small", lambda df: False)
    rows = table(spark, sf, "orders")
    extract = elements(rows, HASHED_ORDER, models.BY_ID)
    found = ch.changes_with_late_props(extract, small_frame(spark, [], STATE_SCHEMA), HASHED_ORDER)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.lstrip(" +-:").startswith("Join ") for line in plan.splitlines()) == 1
    want = {r.id: r.props for r in extract.collect()}
    assert {r.id: r.props for r in found.collect()} == want and found.count() == rows.count()


@pytest.mark.parametrize("form", ["gml", "graphml"])
def test_packed_exports_are_parsed_once_and_leave_no_tables(spark, sf, tmp_path, monkeypatch, form, shuffles):
    monkeypatch.setattr(graphs, "is_small", lambda df: False)
    rows = table(spark, sf, "customer")
    nodes = elements(rows, models.CUSTOMER, models.BY_ID).select("id", "label", "props")
    edges = nodes.select(F.concat("id", F.lit("~")).alias("id"), F.lit("SELF").alias("label"), F.col("id").alias("from_id"), F.col("id").alias("to_id"), "props")
    export_graph(form, nodes, edges, str(tmp_path / "x"), compression="gzip")
    assert not [p for p in (tmp_path / "x").rglob("part-*") if p.suffix != ".gz"]
    before = set((tmp_path / "x").rglob("part-*")), shuffles()
    reader = {"gml": graphs.read_gml, "graphml": graphs.read_graphml}[form]
    read = reader(spark, str(tmp_path / "x"))
    plan = read[1]._jdf.queryExecution().optimizedPlan().toString().lower()
    assert f"{form[-3:] if form == 'graphml' else 'text'} " not in plan.replace("parquet", "")
    store = GraphStore(spark, str(tmp_path / "g"))
    held = shuffles()
    graphs.import_graph(store, *read, "run")
    assert shuffles() <= held and set((tmp_path / "x").rglob("part-*")) == before[0]
    assert not list((tmp_path / "g" / "data").glob("*/stage"))
    told = lambda df: sorted((r.id, sorted((k, v) for k, v in r.props.items() if v is not None)) for r in df.collect())
    assert told(store.nodes()) == told(nodes) and told(store.edges()) == told(edges)

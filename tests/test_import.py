"""Graphs read back from their exports."""

import pytest

from rowgraft.operators import merge
from rowgraft.plans.store import GraphStore
from rowgraft.sinks import export_graph, graphml
from rowgraft.sources import graphs

NODES = [
    ("a 1", "Person", {"name": 'Jürgen "J" & <co> 😀', "age": "30", "empty": "", "none": None}), ("b", "Person", {}), ("c", "City", {"name": " Rome \n line 2 &#65; ; end"}),
    ("d", "City", {"only": "x]"}),
]
EDGES = [("e1", "LIVES_IN", "a 1", "c", {"since": "2020"}), ("e1", "LIVES_IN", "b", "c", {}), ("e2", "KNOWS", "a 1", "b", {"how": "well & good"}), ("e3", "KNOWS", "a 1", "b", {})]
READ = {"graphml": graphs.read_graphml, "gml": graphs.read_gml}


def _told(df):
    return sorted((tuple(r[c] for c in df.columns if c != "props"), tuple(sorted((k, v) for k, v in r.props.items() if v is not None))) for r in df.collect())


@pytest.fixture
def graph(spark):
    return spark.createDataFrame(NODES, merge.NODE_SCHEMA), spark.createDataFrame(EDGES, merge.EDGE_SCHEMA)


@pytest.mark.parametrize("form", list(READ))
def test_export_and_import(spark, graph, tmp_path, form):
    export_graph(form, *graph, str(tmp_path / "g"))
    nodes, edges = READ[form](spark, str(tmp_path / "g"))
    assert _told(nodes.select("id", "label", "props")) == _told(graph[0])
    assert _told(edges.select("id", "label", "from_id", "to_id", "props")) == _told(graph[1])


def test_import_merges(spark, graph, tmp_path):
    store = GraphStore(spark, str(tmp_path / "store"))
    twice = graph[0].unionByName(spark.createDataFrame([("b", "Person", {"name": "Bea"}), ("b", "Person", {"name": "Abe", "age": "4"})], merge.NODE_SCHEMA))
    lost = spark.createDataFrame([("e9", "KNOWS", "b", "nobody", {})], merge.EDGE_SCHEMA)
    assert graphs.import_graph(store, twice, graph[1].unionByName(lost), "run-1") == 1
    held = {r.id: r.props for r in store.nodes().collect()}
    assert held["b"] == {"name": "Bea", "age": "4"} and len(held) == 4
    assert _told(store.edges().select("id", "label", "from_id", "to_id", "props")) == _told(graph[1])
    graphs.import_graph(store, spark.createDataFrame([("c", "City", {"zip": "1"})], merge.NODE_SCHEMA), graph[1].where("1 = 0"), "run-2")
    assert {r.id: r.props for r in store.nodes(["City"]).collect()}["c"] == {"name": NODES[2][2]["name"], "zip": "1"}


def test_graphml_with_many_names(spark, tmp_path):
    """More names than a driver would take; each element has its own."""
    nodes = spark.range(150_000).selectExpr("concat('n', id) as id", "'N' as label", "map(concat('p', id), cast(id as string)) as props")
    edges = spark.createDataFrame([], merge.EDGE_SCHEMA)
    keys = graphml.property_keys(nodes, edges)
    names = keys.names.selectExpr("count(*) as n", "count(distinct number) as d", "max(number) as m").first()
    assert (names.n, names.d, names.m) == (150_002, 150_002, 150_001)
    shown = graphml.node_records(nodes.where("id = 'n77'"), keys).first().text
    number = keys.names.where("scope = 'node' and name = 'p77'").first().number
    assert f'<data key="d{number}">77</data>' in shown

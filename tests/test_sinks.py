"""Exports of a small graph, read back with other tools."""

import csv
import glob
import hashlib
import io
import json
from xml.etree import ElementTree

import pytest

import __spark_entry__ as registered
from rowgraft.operators import merge
from rowgraft.session import small_frame
from rowgraft.sinks import export_graph, register, rows
from rowgraft.sources.graphs import existing_edges

NODES = [
    ("Customer_42", "Customer", {"name": "Jane Doe", "email__privacy_class": "PII"}),
    ("Link_1", "Order", {"amount": "100", "none": None, "a-b": "first", "a_b": "second"}),
]
EDGE = ("edge1", "REFERENCES", "Link_1", "Customer_42", {"since": "2024"})


@pytest.fixture
def graph(spark):
    return small_frame(spark, NODES, merge.NODE_SCHEMA), small_frame(spark, [EDGE], merge.EDGE_SCHEMA)


def joined(path):
    return "".join(open(f, newline="").read() for f in sorted(glob.glob(f"{path}/*/part-*")))


def test_gml(spark, graph, tmp_path):
    export_graph("gml", *graph, str(tmp_path / "g"))
    text = joined(tmp_path / "g")
    assert text.startswith("graph [\n  directed 1\n  node [\n    id 0\n") and text.endswith("  ]\n]\n")
    one = text[text.index('label "Customer_42"') :]
    assert one.startswith('label "Customer_42"\n    entity_label "Customer"\n    name "Jane Doe"\n    email__privacy_class "PII"\n  ]\n')
    assert 'amount "100"\n    a_b "second"\n  ]' in text and "none" not in text
    number = {line.split('"')[1]: i for i, line in enumerate(x for x in text.splitlines() if x.startswith("    label"))}
    ends = f"  edge [\n    source {number['Link_1']}\n    target {number['Customer_42']}\n"
    assert ends + '    entity_label "REFERENCES"\n    edge_id "edge1"\n    since "2024"\n  ]' in text


def test_gml_with_parallel_edges_and_odd_text(spark, graph, tmp_path):
    nodes, edges = graph
    odd = spark.createDataFrame([("e2", "REFERENCES", "Link_1", "Customer_42", {"t": 'é"&😀\n'})], merge.EDGE_SCHEMA)
    export_graph("gml", nodes, edges.unionByName(odd), str(tmp_path / "g"), id_key="own_id")
    text = joined(tmp_path / "g")
    assert text.startswith("graph [\n  directed 1\n  multigraph 1\n")
    assert '    key "e2"\n    entity_label "REFERENCES"\n    own_id "e2"\n    t "&#233;&#34;&#38;&#128512;&#10;"\n' in text


def test_gml_keeps_its_own_names(spark, tmp_path):
    nodes = small_frame(spark, [("a", "N", {"id": "x", "label": "y", "entity_label": "z", "key": "kept"})], merge.NODE_SCHEMA)
    edges = small_frame(spark, [("e", "E", "a", "a", {"source": "x", "edge_id": "y", "id": "kept"})], merge.EDGE_SCHEMA)
    export_graph("gml", nodes, edges, str(tmp_path / "g"))
    text = joined(tmp_path / "g")
    assert '    label "a"\n    entity_label "N"\n    key "kept"\n  ]' in text
    assert '    source 0\n    target 0\n    entity_label "E"\n    edge_id "e"\n    id "kept"\n  ]' in text


def test_graphml(spark, graph, tmp_path):
    nodes, edges = graph
    odd = spark.createDataFrame([('q"<1>', "A&B", {"name": "<x> & y"})], merge.NODE_SCHEMA)
    export_graph("graphml", nodes.unionByName(odd), edges, str(tmp_path / "g"))
    ns = "{http://graphml.graphdrawing.org/xmlns}"
    root = ElementTree.fromstring(joined(tmp_path / "g").encode())
    keys = {k.get("id"): (k.get("for"), k.get("attr.name")) for k in root.iter(ns + "key")}
    found = {n.get("id"): {keys[d.get("key")]: d.text for d in n} for n in root.iter(ns + "node")}
    assert found['q"<1>'] == {("node", "entity_label"): "A&B", ("node", "name"): "<x> & y"}
    assert found["Link_1"][("node", "amount")] == "100" and ("node", "none") not in found["Link_1"]
    (edge,) = root.iter(ns + "edge")
    assert (edge.get("source"), edge.get("target"), edge.get("id")) == ("Link_1", "Customer_42", "edge1")
    assert {keys[d.get("key")]: d.text for d in edge} == {("edge", "entity_label"): "REFERENCES", ("edge", "since"): "2024"}


def test_bulk_csv_reads_back(spark, tmp_path):
    odd = {"q": 'say "hi"', "c": "a,b", "n": None, "l": "x\r\ny", "p": "plain"}
    nodes = small_frame(spark, [("id,1", "L", odd)], merge.NODE_SCHEMA)
    edges = small_frame(spark, [EDGE], merge.EDGE_SCHEMA)
    export_graph("bulk_csv", nodes, edges, str(tmp_path / "g"))
    text = "".join(open(f, newline="").read() for kind in ("nodes", "edges") for f in glob.glob(f"{tmp_path}/g/{kind}/part-*"))
    (node, edge) = list(csv.reader(io.StringIO(text, newline="")))
    assert node == ["id,1", "L", 'q=say "hi"', "c=a,b", "", "l=x\r\ny", "p=plain"]
    assert edge == ["edge1", "Link_1", "Customer_42", "REFERENCES", "since=2024"]
    want = io.StringIO()
    csv.writer(want).writerows([node, edge])
    assert text == want.getvalue()


def test_json_rows(spark, graph, tmp_path):
    export_graph("json_rows", *graph, str(tmp_path / "g"), types={"amount": "Int", "a-b": "Int"})
    rows = {r.id: json.loads(r.properties) for r in spark.read.parquet(str(tmp_path / "g" / "nodes")).collect()}
    assert rows["Link_1"] == {"amount": 100, "none": None, "a-b": "first", "a_b": "second"}
    edge = spark.read.parquet(str(tmp_path / "g" / "edges")).first()
    assert edge.asDict() == {"id": "edge1", "from_id": "Link_1", "to_id": "Customer_42", "label": "REFERENCES", "properties": '{"since":"2024"}'}


def test_typed_csv(spark, graph, tmp_path):
    export_graph("typed_csv", *graph, str(tmp_path / "g"), types={"Order": {"amount": "Int", "a-b": "Double"}})
    assert joined(tmp_path / "g" / "nodes_header").splitlines() == ["~id,~label,email__privacy_class:String,name:String", "~id,~label,amount:Int,a-b:Double,a_b:String,none:String"]
    assert joined(tmp_path / "g" / "nodes").splitlines() == ["Customer_42,Customer,PII,Jane Doe", "Link_1,Order,100,,second,"]


def test_typed_csv_writes_every_label_in_one_pass(spark, graph, tmp_path):
    unread = rows.write_typed_csv(*graph, str(tmp_path / "g"), {"Order": {"amount": "Int", "a-b": "Double"}, "Nobody": {"x": "Int"}})
    assert unread == {"nodes/Customer": 0, "nodes/Order": 1, "edges/REFERENCES": 0}
    assert joined(tmp_path / "g" / "edges_header").splitlines() == ["~id,~from,~to,~label,since:String"]
    assert joined(tmp_path / "g" / "edges").splitlines() == ["edge1,Link_1,Customer_42,REFERENCES,2024"]


def test_batches_move_no_property_maps(spark):
    nodes = spark.range(25).selectExpr("concat('n', id) as id", "'N' as label", "map('v', cast(id as string)) as props").repartition(4)
    found = rows.keyed_batches(nodes, 10)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan and "BroadcastHashJoin" in plan
    assert sorted(r.batch for r in found.collect()) == [0] * 10 + [1] * 10 + [2] * 5


def test_batches_by_key_do_not_depend_on_the_files(spark):
    nodes = spark.range(25).selectExpr("concat('n', id) as id", "'N' as label", "map('v', cast(id as string)) as props")
    ids = sorted((f"n{i}" for i in range(25)), key=lambda i: (hashlib.md5(i.encode()).hexdigest()[:3], i))
    want = {i: at // 10 for at, i in enumerate(ids)}
    for dealt in (nodes.repartition(4), nodes.coalesce(1).orderBy("id")):
        assert {r.id: r.batch for r in rows.keyed_batches(dealt, 10, key="id").collect()} == want


def test_registered_batches_number_every_row(spark, sf):
    found = registered.queries()["keyed_batches"](spark, sf).collect()
    ids = sorted((r.id for r in found), key=lambda i: (hashlib.md5(i.encode()).hexdigest()[:3], i))
    assert {r.id: r.batch for r in found} == {i: at // 500 for at, i in enumerate(ids)}


def test_batches(spark, tmp_path):
    nodes = spark.range(25).selectExpr("concat('n', id) as id", "'N' as label", "map('v', cast(id as string)) as props")
    edges = nodes.selectExpr("'same' as id", "'E' as label", "id as from_id", "id as to_id", "props")
    export_graph("batches", nodes, edges, str(tmp_path / "g"), size=10, id_key="key")
    for kind in ("nodes", "edges"):
        sizes = [r["count"] for r in spark.read.json(str(tmp_path / "g" / kind)).groupBy("batch").count().orderBy("batch").collect()]
        assert sizes == [10, 10, 5]
    first = spark.read.json(str(tmp_path / "g" / "nodes")).where("id = 'n3'").first()
    assert first.props.asDict() == {"key": "n3", "v": "3"}


def test_registry(spark, graph, tmp_path):
    seen = []
    register("Mine", lambda nodes, edges, path, **options: seen.append((nodes.count(), edges.count(), path, options)))
    export_graph("mine", *graph, "somewhere", depth=2)
    assert seen == [(2, 1, "somewhere", {"depth": 2})]
    with pytest.raises(ValueError, match="unknown export"):
        export_graph("nope", *graph, "x")


def test_existing_edge_ids(spark):
    rows = [("a", "b", "L", "k", {"edge_id": "e", "p": "1"}), ("a", "b", "L", "k", {}), ("a", "b", "L", "", {"edge_id": ""})]
    df = spark.createDataFrame(rows, "from_id string, to_id string, label string, key string, props map<string,string>")
    assert sorted((r.id, str(r.props)) for r in existing_edges(df).collect()) == [("a->b", "{}"), ("e", "{'p': '1'}"), ("k", "{}")]

"""Merges, endpoint checks, skewed joins and numbering."""

import pytest
from pyspark.sql import functions as F

from rowgraft.operators import merge, skew
from rowgraft.operators.collapse import merge_ranked
from rowgraft.operators.numbering import numbered
from rowgraft.operators.tags import tagged_as


def nodes(spark, *rows):
    return spark.createDataFrame(list(rows), merge.NODE_SCHEMA)


def edges(spark, *rows):
    return spark.createDataFrame([(i, "L", f, t, p) for i, f, t, p in rows], merge.EDGE_SCHEMA)


def plain(df):
    return sorted((r.asDict() for r in df.collect()), key=str)


@pytest.mark.parametrize("small", [True, False, None])
def test_upsert_merges_or_replaces(spark, small):
    old = nodes(spark, ("a", "N", {"x": "1", "y": "2"}), ("b", "N", {"x": "3"}))
    new = nodes(spark, ("a", "M", {"x": None, "z": "9"}), ("c", "N", {"x": None}))
    merged = {r.id: (r.label, r.props) for r in merge.upsert_nodes(old, new, small=small).collect()}
    assert merged == {"a": ("M", {"x": "1", "y": "2", "z": "9"}), "b": ("N", {"x": "3"}), "c": ("N", {"x": None})}
    replaced = {r.id: r.props for r in merge.upsert_nodes(old, new, replace=True, small=small).collect()}
    assert replaced == {"a": {"x": None, "z": "9"}, "b": {"x": "3"}, "c": {"x": None}}


@pytest.mark.parametrize("small", [True, False])
def test_edges_are_keyed_by_id_and_ends(spark, small):
    old = edges(spark, ("e", "a", "b", {"p": "1"}), ("f", "a", "b", {}))
    new = edges(spark, ("e", "a", "c", {"p": "2"}), ("e", "a", "b", {"q": "3"}))
    assert {(r.id, r.to_id): r.props for r in merge.upsert_edges(old, new, small=small).collect()} == {
        ("e", "b"): {"p": "1", "q": "3"}, ("f", "b"): {}, ("e", "c"): {"p": "2"}
    }
    moved = merge.upsert_edges(old, edges(spark, ("e", "a", "c", {})), small=small, keys=merge.EDGE_ID_KEYS)
    assert sorted((r.id, r.to_id) for r in moved.collect()) == [("e", "c"), ("f", "b")]


@pytest.mark.parametrize("broadcast_rows", [100, 0])
def test_endpoints_and_deletes(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(merge, "BROADCAST_ROWS", broadcast_rows)
    monkeypatch.setattr(merge, "is_small", lambda df, *most: broadcast_rows > 0)
    held = nodes(spark, ("a", "N", {}), ("b", "N", {}))
    given = edges(spark, *[(f"hot{i}", "a", "b", {}) for i in range(50)], ("x", "a", "?", {}), ("y", "?", "b", {}), ("z", "?", "!", {}))
    checked = {r.id: r.missing for r in merge.dangling_edges(given, held).collect()}
    assert checked == {"x": "to", "y": "from", "z": "both"}
    assert merge.valid_edges(given, held).count() == 50
    kept_nodes, kept_edges = merge.delete_nodes(held, given, nodes(spark, ("b", "N", {})))
    assert [r.id for r in kept_nodes.collect()] == ["a"] and sorted(r.id for r in kept_edges.collect()) == ["x", "z"]
    assert merge.incident(given, nodes(spark, ("b", "N", {}))).count() == 51
    assert merge.valid_edges(given.where("id like 'hot%'"), held).count() == 50


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(3000).select(
        F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.col("id") % 40).cast("int").alias("k")
    )
    right = spark.range(0, 30, 2).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    want = left.join(right, ["k"], how)
    got = skew.salted_join(left, right, ["k"], how, ["row"], salts=8)
    assert plain(got.select(*want.columns)) == plain(want)
    heavy = [r.k for r in skew.heavy_keys(left, ["k"], 4).collect()]
    assert 0 in heavy and len(heavy) < 4


def test_heavy_key_is_spread(spark):
    left = spark.range(10000).select(F.col("id").alias("row"), F.lit("hot").alias("k"))
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    joined = skew.salted_join(left, right, ["k"], "inner", ["row"], salts=16)
    assert joined.count() == 10000
    salted = left.withColumn("s", F.pmod(F.xxhash64("row"), F.lit(16)))
    assert salted.groupBy("s").count().agg(F.max("count")).first()[0] < 900


def test_merge_ranked(spark):
    df = nodes(spark, ("a", "X", {"p": "1", "q": "1"})).withColumn("rank", F.lit(0)).unionByName(
        nodes(spark, ("a", "Y", {"p": "2", "q": None}), ("b", "Y", {})).withColumn("rank", F.lit(1))
    )
    got = {r.id: (r.label, r.props) for r in merge_ranked(df, ["id"], ["label"]).collect()}
    assert got == {"a": ("Y", {"p": "2", "q": "1"}), "b": ("Y", {})}


def test_numbers_are_dense_and_repeatable(spark):
    ids = spark.range(5000).select(F.concat(F.lit("n"), "id").alias("id"))
    first = {r.id: r.seq for r in numbered(ids, "id").collect()}
    again = {r.id: r.seq for r in numbered(ids.repartition(7), "id", digits=3).collect()}
    assert sorted(first.values()) == list(range(5000)) and first == again


def test_tags_of_one_big_mapping(spark):
    found = spark.range(500).select(F.lit("m").alias("mapping_id"), F.concat(F.lit("n"), "id").alias("id"))
    tags = spark.createDataFrame([("m", "t1"), ("m", "t2"), ("m", "t2"), ("x", "t3")], "mapping_id string, tag_id string")
    got = tagged_as(found, tags)
    assert got.count() == 1000 and got.where("id = 'n7__TAG__t2' and from_id = 'n7' and to_id = 't2'").count() == 1


def test_unclaimed_and_tenant(spark):
    gone = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    claims = spark.createDataFrame([("b",), ("c",)], "id string")
    assert [r.id for r in merge.unclaimed(gone, claims, ["id"]).collect()] == ["a"]
    held = nodes(spark, ("a", "N", {"pk": "old"}))
    fresh = merge.with_tenant(nodes(spark, ("a", "N", {"v": "1"}), ("b", "N", {})), "pk", "c:i", held)
    got = {r.id: r.props for r in merge.upsert_nodes(held, fresh).collect()}
    assert got == {"a": {"pk": "old", "v": "1"}, "b": {"pk": "c:i"}}

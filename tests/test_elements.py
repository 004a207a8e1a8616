"""Ids, fingerprints, properties and the folding of rows."""

import hashlib

import pytest

from rowgraft import AttrSpec, MappingSpec
from rowgraft.operators import identity, properties
from rowgraft.operators.changes import changes_by_fingerprint, changes_by_watermark
from rowgraft.operators.elements import elements
from rowgraft.plans import state as st
from rowgraft.specs import SpecError, id_families, index_specs


def attr(name, **more):
    return AttrSpec(name, name, **more)


def by_id(df):
    return {r.id: r for r in df.collect()}


def test_composite_ids(spark):
    df = spark.createDataFrame([(42, "DE"), (None, "DE"), (1, None)], "customer_id int, region string")
    got = df.select(identity.composite_id(df, "Customer", ["CUSTOMER_ID", "region"])).collect()
    assert [r[0] for r in got] == ["Customer_42_DE", "Customer__DE", "Customer_1_"]


def test_content_id_and_fingerprint_bytes(spark):
    rows = [("ab", "c"), ("a", "bc"), (None, ""), ("", None)]
    df = spark.createDataFrame(rows, "a string, b string")

    def raw(v):
        return b"\x00" if v is None else v.encode()

    ids = [r[0] for r in df.select(identity.content_id(df, "N", ["a", "b"])).collect()]
    assert ids == ["N_" + hashlib.sha256(b"N\x1f" + raw(a) + b"\x1f" + raw(b)).hexdigest() for a, b in rows]
    plain = [r[0] for r in df.select(identity.row_fingerprint(df, ["A", "b"], separated=False)).collect()]
    assert plain == [hashlib.sha256(raw(a) + raw(b)).hexdigest() for a, b in rows] and plain[0] == plain[1]
    apart = [r[0] for r in df.select(identity.row_fingerprint(df, ["a", "b"])).collect()]
    assert len(set(apart)) == 4


def test_transforms_see_only_their_value(spark):
    df = spark.createDataFrame([("7", "x"), ("oops", None)], "value string, other string")
    attributes = (
        AttrSpec("value", "number", transform="try_cast(value as int) + 1"),
        AttrSpec("other", "loud", transform="upper(value)"),
        AttrSpec("value", "same"),
        AttrSpec("value", "strict", transform="try_cast(value as int)", on_null="null"),
    )
    got = [r.props for r in properties.project_properties(df, attributes).collect()]
    assert got == [
        {"number": "8", "loud": "X", "same": "7", "strict": "7"},
        {"number": "oops", "loud": None, "same": "oops", "strict": None},
    ]
    assert properties.project_properties(df, attributes).columns == ["value", "other", "props"]


def test_later_attribute_takes_the_property(spark):
    df = spark.createDataFrame([(1, "a", "b")], "id int, x string, y string")
    spec = MappingSpec("m", "N", attributes=(attr("id", is_id=True), AttrSpec("x", "p"), AttrSpec("y", "p"), attr("none")))
    assert by_id(elements(df, spec, {}))["N_1"].props == {"id": "1", "p": "b", "none": None}


def test_duplicates_fold_in_declared_order(spark):
    rows = [(1, 3, "c", None), (1, 1, "a", "keep"), (1, 2, "b", None), (2, 1, None, None)]
    df = spark.createDataFrame(rows, "id int, ord int, p string, q string")
    spec = MappingSpec("m", "N", attributes=(attr("id", is_id=True), attr("p"), attr("q")), order_columns=("ord",))
    got = by_id(elements(df.repartition(3), spec, {}))
    assert got["N_1"].props == {"id": "1", "p": "c", "q": "keep"} and got["N_1"].n_rows == 3
    assert got["N_2"].props == {"id": "2", "p": None, "q": None}


@pytest.mark.parametrize("unique", [True, False])
def test_skipped_rows_are_counted(spark, unique):
    df = spark.createDataFrame([("a", "x"), (None, "x"), (None, "y"), ("b", None), ("c", "y")], "id string, target string")
    node = MappingSpec("n", "N", id_expr="target")
    spec = MappingSpec("e", "E", "edge", (attr("id"),), id_expr="id", from_mapping_id="n", to_mapping_id="n", unique_ids=unique)
    got = elements(df, spec, {"n": node})
    assert sorted((r.id, r.reason, r.n_rows) for r in got.collect() if r.id) == [("a", None, 1), ("c", None, 1)]
    assert sorted((r.reason, r.n_rows) for r in got.collect() if not r.id) == [("no_endpoint", 1), ("no_id", 2)]
    assert [r.from_id for r in got.collect() if not r.id] == [None, None]
    found = changes_by_fingerprint(got, st_frame(spark), spec).collect()
    assert sorted((r.op, r.n_rows) for r in found) == [("insert", 1), ("insert", 1), ("skip", 1), ("skip", 2)]


def st_frame(spark, rows=()):
    return spark.createDataFrame(list(rows), st.STATE_SCHEMA)


def test_fingerprint_columns_ignore_case(spark):
    spec = MappingSpec("m", "N", attributes=(AttrSpec("ID", "id", is_id=True), AttrSpec("Val", "v")), hash_columns=("VAL",), change_mode="hash")
    before = elements(spark.createDataFrame([(1, "a"), (2, "b")], "id int, val string"), spec, {})
    seen = st.seen_rows(changes_by_fingerprint(before, st_frame(spark), spec), "r0", "2024-01-01")
    after = elements(spark.createDataFrame([(1, "a"), (2, "B")], "id int, val string"), spec, {})
    got = by_id(changes_by_fingerprint(after, seen, spec))
    assert (got["N_1"].op, got["N_2"].op) == ("unchanged", "update")
    assert got["N_1"].props is None and got["N_2"].props == {"id": "2", "v": "B"} and got["N_1"].first_seen_run_id == "r0"


@pytest.mark.parametrize(("kind", "kept", "deleted"), [("string", ["", None], ["N"]), ("int", [0], [1]), ("boolean", [False], [True])])
def test_delete_flag(spark, kind, kept, deleted):
    rows = [(i, f) for i, f in enumerate(kept + deleted)]
    spec = MappingSpec("m", "N", attributes=(attr("id", is_id=True),), change_mode="timestamp", watermark_column="t", delete_flag="flag")
    got = changes_by_watermark(elements(spark.createDataFrame(rows, f"id int, flag {kind}"), spec, {}), spec)
    assert sorted((int(r.id[2:]), r.op) for r in got.collect()) == [(i, "update" if i < len(kept) else "delete") for i, _ in rows]


def test_spec_errors(spark):
    with pytest.raises(SpecError, match="identified"):
        elements(spark.range(1), MappingSpec("m", "N"), {})
    with pytest.raises(SpecError, match="watermark"):
        elements(spark.range(1), MappingSpec("m", "N", id_expr="id", change_mode="timestamp"), {})
    with pytest.raises(SpecError, match="not unique"):
        index_specs([MappingSpec("m", "A", id_expr="id")] * 2)
    with pytest.raises(SpecError, match="not loaded"):
        elements(spark.range(1), MappingSpec("e", "E", "edge", id_expr="id", from_mapping_id="x", to_mapping_id="x"), {})


def test_id_families():
    def named(name, **more):
        return MappingSpec(f"m-{name}", name, attributes=(AttrSpec("id", "id", is_id=True),), **more)

    def names(specs):
        return sorted(sorted(s.entity_name for s in f) for f in id_families(specs))

    assert names([named("A"), named("B"), named("AB")]) == [["A"], ["AB"], ["B"]]
    assert names([named("A"), named("A_1"), named("B")]) == [["A", "A_1"], ["B"]]
    assert names([named("A"), named("B", id_expr="id")]) == [["A", "B"]]

"""State as base and deltas: what is written, how it is read, and what is swept away."""

import glob
import os
import re
from dataclasses import replace

import pytest

from rowgraft import AttrSpec, MappingSpec, SourceSpec
from rowgraft.operators.changes import changes_by_fingerprint
from rowgraft.operators.elements import elements
from rowgraft.plans import store as st
from rowgraft.plans.pipeline import Options, Pipeline
from rowgraft.plans.store import STATE, GraphStore
from rowgraft.specs import id_families

THING = MappingSpec(
    "m", "Thing", attributes=(AttrSpec("id", "key", is_id=True), AttrSpec("v", "v")), source=SourceSpec("things"), change_mode="hash", unique_ids=True,
)


def run(store, df, spec=THING, full=False):
    pipeline = Pipeline(store, [spec], Options(relations={"things": df}, seed_state=True))
    return pipeline.run_full() if full else pipeline.run_incremental()


def things(spark, n, salt=0, changed=()):
    df = spark.range(n).selectExpr("id", f"concat('value {salt} of ', id) as v")
    return df.selectExpr("id", f"case when id in ({', '.join(map(str, changed))}) then 'changed' else v end as v") if changed else df


def written(path, version):
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/data/v{version:08d}-*/**/*.parquet", recursive=True))


def keys_of(store):
    return {r.id: (r.row_hash, r.first_seen_run_id, r.last_seen_run_id) for r in store.read(STATE, ["m"]).collect()}


@pytest.mark.parametrize("unique", [True, False])
def test_a_run_writes_as_much_as_it_changes(spark, tmp_path, unique):
    spec, path = replace(THING, unique_ids=unique), str(tmp_path / "g")
    store = GraphStore(spark, path)
    first = run(store, things(spark, 100_000), spec, full=True)
    whole = written(path, 1)
    second = run(store, things(spark, 100_000, changed=(5, 77)).where("id <> 9").unionByName(spark.createDataFrame([(200_000, "new"), (200_001, "new")], "id long, v string")), spec)
    assert second.counts["m"] == {"rows_upserted": 4, "rows_deleted": 1, "rows_skipped": 0}
    assert written(path, 2) < 0.02 * whole
    held = keys_of(store)
    assert len(held) == 100_001 and "Thing_9" not in held
    assert held["Thing_5"][1:] == (first.run_id, second.run_id) and held["Thing_200000"][1:] == (second.run_id, second.run_id) and held["Thing_1"][1:] == (first.run_id, second.run_id)
    assert store.head().parts[(STATE, "m")].delta_rows == 5
    third = run(store, things(spark, 100_000, changed=(5,)), spec)
    assert third.counts["m"] == {"rows_upserted": 2, "rows_deleted": 2, "rows_skipped": 0}
    assert {r.id: r.props for r in store.nodes().where("id in ('Thing_5', 'Thing_9', 'Thing_77', 'Thing_200000')").collect()} == {
        "Thing_5": {"key": "5", "v": "changed"}, "Thing_9": {"key": "9", "v": "value 0 of 9"}, "Thing_77": {"key": "77", "v": "value 0 of 77"},
    }


def test_deltas_are_folded_into_a_base(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "g"))
    run(store, things(spark, 300), full=True)
    deltas = []
    for salt in range(3):
        run(store, things(spark, 300, changed=range(salt * 12, salt * 12 + 12)))
        deltas.append(len(store.head().parts[(STATE, "m")].deltas))
    part = store.head().parts[(STATE, "m")]
    assert deltas == [1, 0, 1] and part.n_rows == 300
    fresh = GraphStore(spark, str(tmp_path / "h"))
    run(fresh, things(spark, 300, changed=range(24, 36)), full=True)
    assert {k: v[0] for k, v in keys_of(store).items()} == {k: v[0] for k, v in keys_of(fresh).items()}


def test_the_comparison_does_not_shuffle_the_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(st, "BUCKET_ROWS", 100)
    store = GraphStore(spark, str(tmp_path / "g"))
    run(store, things(spark, 3000), full=True)
    run(store, things(spark, 3000, changed=(5,)))
    assert store.head().parts[(STATE, "m")].buckets == 2 and store.head().parts[(STATE, "m")].deltas
    for unique in (True, False):
        spec = replace(THING, unique_ids=unique)
        extract = elements(things(spark, 3000, changed=(5, 6)), spec, {"m": spec})
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = changes_by_fingerprint(extract, store.read(STATE, ["m"]), spec)
        plan = found._jdf.queryExecution().executedPlan().toString()
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        state = plan[plan.index("FullOuter") :]
        state = state[state.index("Union") :]
        assert "Bucketed: true" in state and not re.search(r"Exchange[^\n]*ENSURE_REQUIREMENTS[^\n]*\n[^\n]*Union", plan)
        assert {r.op: r["count"] for r in found.groupBy("op").count().collect()} == {"unchanged": 2999, "update": 1}


def test_sweep(spark, tmp_path):
    path = str(tmp_path / "g")
    store = GraphStore(spark, path)
    run(store, things(spark, 50), full=True)
    for k in range(3):
        run(store, things(spark, 50, changed=(k,)))
    versions = store.versions(2)
    before = {v.number: (store.read("nodes", version=v).count(), store.read(STATE, version=v).count()) for v in versions}
    size = lambda: sum(os.path.getsize(f) for f in glob.glob(f"{path}/data/**/*.parquet", recursive=True))
    whole = size()
    assert store.sweep(2) and size() < whole and store.sweep(2) == []
    assert {v.number: (store.read("nodes", version=v).count(), store.read(STATE, version=v).count()) for v in versions} == before
    run(store, things(spark, 50, changed=(9,)))
    assert keys_of(store)["Thing_9"] and store.nodes().where("props['v'] = 'changed'").count() == 1


def test_promised_ids_keep_mappings_apart(spark, tmp_path):
    other = replace(THING, mapping_id="o", entity_name="Other", id_expr="concat('X-', id)", id_starts="X-", source=SourceSpec("others"))
    assert len(id_families([THING, other])) == 2 and len(id_families([THING, replace(other, id_starts=None)])) == 1
    store = GraphStore(spark, str(tmp_path / "g"))
    relations = {"things": things(spark, 20), "others": things(spark, 20, 1)}
    Pipeline(store, [THING, other], Options(relations=relations, seed_state=True)).run_full()
    before = store.head().of("nodes")
    Pipeline(store, [THING, other], Options(relations=relations | {"others": things(spark, 20, 1, (3,))})).run_incremental()
    after = store.head().of("nodes")
    assert after["Thing"] == before["Thing"] and after["Other"] != before["Other"]
    wrong = replace(other, id_starts="Y-")
    result = Pipeline(store, [THING, wrong], Options(relations=relations)).run_incremental()
    assert "does not begin with Y-" in result.errors["o"]

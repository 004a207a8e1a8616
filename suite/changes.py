"""Change detection and state."""

from dataclasses import replace

from pyspark.sql import functions as F

from rowgraft import MappingSpec, SourceSpec
from rowgraft.operators.changes import changes_by_fingerprint, changes_by_watermark
from rowgraft.operators.counters import mapping_counts, run_totals
from rowgraft.operators.elements import elements
from rowgraft.plans import state as st
from rowgraft.plans.audit import closed_runs
from rowgraft.sources.relations import extract_rows
from suite import models
from suite.nodes import ORDER_TEXTS
from suite.registry import derived, query, sha, table

ORDER = replace(models.ORDER, attributes=models.attrs("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", ids=("o_orderkey",)), change_mode="hash")

# An earlier state of a table: some keys missing, some values different, some keys gone since.
PRIOR_ORDERS = """
    select o_orderkey, o_custkey, case when o_orderkey % 7 = 0 then 'X' else o_orderstatus end as o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    from {orders} where o_orderkey % 10 <> 3
    union all select o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from {orders} where o_orderkey % 50 = 0
"""
PRIOR_CUSTOMERS = """
    select c_custkey, c_name, c_nationkey, case when c_custkey % 7 = 0 then c_acctbal + 1 else c_acctbal end as c_acctbal, c_mktsegment
    from {customer} where c_custkey % 10 <> 3
    union all select c_custkey + 10000000, c_name, c_nationkey, c_acctbal, c_mktsegment from {customer} where c_custkey % 50 = 0
"""
ORDER_IDS_PRIOR = """
    select 'Order_' || o_orderkey as id, o_orderkey % 7 = 0 as altered from orders where o_orderkey % 10 <> 3
    union all select 'Order_' || (o_orderkey + 10000000), false from orders where o_orderkey % 50 = 0
"""


def stored(extract, run_id="run-0"):
    """State rows as an earlier run would have left them."""
    seen = extract.where(F.col("id").isNotNull()).withColumns({"op": F.lit("insert"), "first_seen_run_id": F.lit(None).cast("string")})
    return st.seen_rows(seen, run_id, "2024-01-01 00:00:00")


def order_frames(spark, sf):
    prior = elements(derived(spark, sf, PRIOR_ORDERS, "orders"), ORDER, {})
    return elements(table(spark, sf, "orders"), ORDER, {}), stored(prior)


@query("cdc_hash", f"""
    with cur as (select 'Order_' || o_orderkey as id, {sha(*ORDER_TEXTS)} as h from orders),
    old as (select 'Order_' || o_orderkey as id, {sha(*ORDER_TEXTS)} as h from ({PRIOR_ORDERS.replace('{orders}', 'orders')}))
    select coalesce(cur.id, old.id) as id, cur.h as row_hash,
        case when cur.id is null then 'delete' when old.id is null then 'insert' when cur.h <> old.h then 'update' else 'unchanged' end as op
    from cur full outer join old on cur.id = old.id
""")
def cdc_hash(spark, sf):
    current, state = order_frames(spark, sf)
    return changes_by_fingerprint(current, state, ORDER).select("id", "row_hash", "op")


@query("cdc_full", """
    with cur as (select 'Customer_' || c_custkey as id, c_name from customer),
    old as (select 'Customer_' || c_custkey as id from customer where c_custkey % 10 <> 3
        union all select 'Customer_' || (c_custkey + 10000000) from customer where c_custkey % 50 = 0)
    select coalesce(cur.id, old.id) as id, cur.c_name as c_name, case when cur.id is null then 'delete' when old.id is null then 'insert' else 'update' end as op
    from cur full outer join old on cur.id = old.id
""")
def cdc_full(spark, sf):
    spec = models.CUSTOMER
    state = stored(elements(derived(spark, sf, PRIOR_CUSTOMERS, "customer"), spec, {}))
    found = changes_by_fingerprint(elements(table(spark, sf, "customer"), spec, {}), state, spec)
    return found.select("id", F.col("props")["c_name"].alias("c_name"), "op")


USER_EVENTS = MappingSpec(
    "m-user", "User", attributes=models.attrs("event_type", "value", ids=("user_id",)), source=SourceSpec("events"), change_mode="timestamp",
    watermark_column="ts", delete_flag="event_type = 'error' and value > 180", order_columns=("ts", "event_id"),
)


@query("cdc_timestamp", """
    with t as (select * from events where ts > timestamp '2024-01-20 00:00:00')
    select 'User_' || user_id as id, case when bool_or(event_type = 'error' and value > 180) then 'delete' else 'update' end as op, count(*) as n_rows,
        case when not bool_or(event_type = 'error' and value > 180) then last(event_type order by ts, event_id) end as event_type,
        case when not bool_or(event_type = 'error' and value > 180) then cast(last(value order by ts, event_id) as varchar) end as value
    from t group by user_id
""")
def cdc_timestamp(spark, sf):
    rows = extract_rows(spark, USER_EVENTS, {"events": table(spark, sf, "events")}, since="2024-01-20 00:00:00")
    found = changes_by_watermark(elements(rows, USER_EVENTS, {}), USER_EVENTS)
    return found.select("id", "op", "n_rows", F.col("props")["event_type"].alias("event_type"), F.col("props")["value"].alias("value"))


@query("cdc_edges", """
    with cur as (select distinct l_linenumber, l_orderkey, l_partkey from lineitem),
    old as (select distinct l_linenumber, l_orderkey, case when l_orderkey % 9 = 0 then l_partkey + 1 else l_partkey end as l_partkey from lineitem where l_partkey % 4 <> 0),
    pair as (select coalesce(c.l_linenumber, o.l_linenumber) as n, coalesce(c.l_orderkey, o.l_orderkey) as o, coalesce(c.l_partkey, o.l_partkey) as p,
        case when c.l_orderkey is null then 'delete' when o.l_orderkey is null then 'insert' else 'update' end as op
        from cur c full outer join old o on c.l_linenumber = o.l_linenumber and c.l_orderkey = o.l_orderkey and c.l_partkey = o.l_partkey)
    select 'OF_PART_' || n as id, 'Order_' || o as from_id, 'Part_' || p as to_id, op from pair
""")
def cdc_edges(spark, sf):
    spec = models.OF_PART
    source = "select l_linenumber, l_orderkey as o_orderkey, {p} as p_partkey, l_quantity, l_shipdate from {lineitem}"
    current = derived(spark, sf, source.replace("{p}", "l_partkey"), "lineitem")
    prior = derived(spark, sf, source.replace("{p}", "case when l_orderkey % 9 = 0 then l_partkey + 1 else l_partkey end") + " where l_partkey % 4 <> 0", "lineitem")
    state = stored(elements(prior, spec, models.BY_ID))
    return changes_by_fingerprint(elements(current, spec, models.BY_ID), state, spec).select("id", "from_id", "to_id", "op")


@query("state_hash_upsert", f"""
    with cur as (select 'Order_' || o_orderkey as id, {sha(*ORDER_TEXTS)} as h from orders),
    old as (select 'Order_' || o_orderkey as id, {sha(*ORDER_TEXTS)} as h from ({PRIOR_ORDERS.replace('{orders}', 'orders')}))
    select coalesce(cur.id, old.id) as id, coalesce(cur.h, old.h) as row_hash, case when old.id is null then 'run-1' else 'run-0' end as first_seen_run_id,
        case when cur.id is null then 'run-0' else 'run-1' end as last_seen_run_id
    from cur full outer join old on cur.id = old.id
""")
def state_hash_upsert(spark, sf):
    current, state = order_frames(spark, sf)
    seen = stored(current, "run-1")
    return st.upsert_hashes(state, seen, "run-1", "2024-02-01 00:00:00").select("id", "row_hash", "first_seen_run_id", "last_seen_run_id")


@query("state_hash_delete", f"select id from ({ORDER_IDS_PRIOR}) where id not in (select 'Order_' || (o_orderkey + 10000000) from orders)")
def state_hash_delete(spark, sf):
    current, state = order_frames(spark, sf)
    gone = state.join(current.select("id"), "id", "left_anti")
    return st.delete_hashes(state, gone).select("id")


@query("state_clear", "select 'm-customer' as mapping_id, 'Customer_' || c_custkey as id from customer")
def state_clear(spark, sf):
    both = stored(elements(table(spark, sf, "customer"), models.CUSTOMER, {})).unionByName(
        stored(elements(table(spark, sf, "supplier"), models.SUPPLIER, {}))
    )
    return st.clear_mappings(both, ["m-supplier"]).select("mapping_id", "id")


MARKS = """
    select concat('user-', user_id) as mapping_id, max(ts) as last_watermark, cast(null as timestamp_ntz) as pending_watermark, 'run-0' as last_run_id,
        cast('2024-02-01' as timestamp_ntz) as updated_at
    from {events} group by user_id
"""


@query("watermark_two_phase", """
    with m as (select user_id, max(ts) as last, count(*) as n from events group by user_id)
    select 'user-' || user_id as mapping_id,
        case when user_id % 3 = 1 then '2024-03-01 00:00:00' else strftime(last, '%Y-%m-%d %H:%M:%S') end as last_watermark,
        case when user_id % 3 = 2 then '2024-03-01 00:00:00' end as pending_watermark,
        case when user_id % 3 = 0 then 'run-0' else 'run-1' end as last_run_id
    from m
    union all select 'new-' || user_id, '2024-03-01 00:00:00', null, 'run-1' from m where user_id % 3 = 1
""")
def watermark_two_phase(spark, sf):
    marks = derived(spark, sf, MARKS, "events")
    users = marks.select(F.substring("mapping_id", 6, 20).cast("long").alias("u"))
    named = users.select(F.concat(F.lit("user-"), "u").alias("mapping_id"), "u")
    fresh = users.select(F.concat(F.lit("new-"), "u").alias("mapping_id"), "u").where("u % 3 = 1")
    pending = st.set_pending(marks, named.where("u % 3 <> 0").unionByName(fresh), "2024-03-01 00:00:00", "run-1")
    done = st.commit_marks(pending, named.where("u % 3 = 1").unionByName(fresh), "2024-03-01 01:00:00")
    shown = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("last_watermark", "pending_watermark")]
    return done.select("mapping_id", *shown, "last_run_id")


@query("change_counts", """
    with c as (select * from (select 'm-order' as mapping_id,
            case when o_orderkey % 10 = 3 or o_orderkey % 7 = 0 then 1 else 0 end as up, 0 as del from orders
        union all select 'm-order', 0, 1 from orders where o_orderkey % 50 = 0
        union all select 'm-customer', 1, 0 from customer
        union all select 'm-customer', 0, 1 from customer where c_custkey % 50 = 0))
    select mapping_id, cast(sum(up) as bigint) as rows_upserted, cast(sum(del) as bigint) as rows_deleted, cast(0 as bigint) as rows_skipped,
        cast(sum(up) as bigint) as elements_upserted
    from c group by mapping_id
""")
def change_counts(spark, sf):
    current, state = order_frames(spark, sf)
    orders = changes_by_fingerprint(current, state, ORDER).select("mapping_id", "op", "n_rows")
    spec = models.CUSTOMER
    prior = stored(elements(derived(spark, sf, PRIOR_CUSTOMERS, "customer"), spec, {}))
    buyers = changes_by_fingerprint(elements(table(spark, sf, "customer"), spec, {}), prior, spec).select("mapping_id", "op", "n_rows")
    return mapping_counts(orders.unionByName(buyers))


@query("run_audit", """
    with d as (select user_id as run, event_type, count(*) as n, count(*) filter (where value < 5) as low from events group by user_id, event_type)
    select 'run-' || run as run_id, cast(sum(case when event_type <> 'error' then n else 0 end) as bigint) as rows_upserted,
        cast(sum(case when event_type = 'error' then n else 0 end) as bigint) as rows_deleted, cast(sum(low) as bigint) as rows_skipped,
        case when bool_or(event_type = 'error') then 'PARTIAL' else 'SUCCESS' end as status
    from d group by run
""")
def run_audit(spark, sf):
    details = derived(spark, sf, """
        select concat('run-', user_id) as run_id, event_type as mapping_id, count_if(event_type <> 'error') as rows_upserted,
            count_if(event_type = 'error') as rows_deleted, count_if(value < 5) as rows_skipped,
            case when event_type = 'error' then 'failed' end as error_message
        from {events} group by user_id, event_type
    """, "events")
    return run_totals(details)


@query("run_log", """
    select 'run-' || o_orderkey as run_id, case when o_orderstatus = 'P' then 'RUNNING' when o_orderstatus = 'F' then 'FAILED' else 'SUCCESS' end as status,
        strftime(o_orderdate, '%Y-%m-%d') as started, case when o_orderstatus <> 'P' then strftime(o_orderdate + interval 1 day, '%Y-%m-%d') end as finished,
        case when o_orderstatus <> 'P' then o_custkey else 0 end as rows_upserted
    from orders
""")
def run_log(spark, sf):
    log = derived(spark, sf, """
        select concat('run-', o_orderkey) as run_id, 'full' as run_type, o_orderdate as started_at, cast(null as timestamp_ntz) as finished_at,
            'RUNNING' as status, cast(0 as long) as rows_upserted from {orders}
        union all
        select concat('run-', o_orderkey), null, null, o_orderdate + interval 1 day, case when o_orderstatus = 'F' then 'FAILED' else 'SUCCESS' end, o_custkey
        from {orders} where o_orderstatus <> 'P'
    """, "orders")
    day = "yyyy-MM-dd"
    return closed_runs(log).select(
        "run_id", "status", F.date_format("started_at", day).alias("started"), F.date_format("finished_at", day).alias("finished"), "rows_upserted"
    )



"""Reading relations."""

from pyspark.sql import functions as F

from rowgraft import MappingSpec, SourceSpec
from rowgraft.sources.graphs import existing_edges
from rowgraft.sources.relations import bounds, chunk_count, extract_rows, normalised, ranged, read_relation
from suite.registry import derived, query, table


@query("source_normalised", 'select p_partkey, p_name as "part name", p_brand as brand, p_size as "size" from part')
def source_normalised(spark, sf):
    raw = table(spark, sf, "part").select(
        F.col("p_partkey").alias("P_PARTKEY"), F.col("p_name").alias("Part Name"), F.col("p_brand").alias("BRAND"), F.col("p_size").alias("Size")
    )
    return normalised(raw)


@query("source_query_filtered", """
    select o_orderkey, c_name from orders join customer on c_custkey = o_custkey where o_totalprice > 100000 and c_mktsegment <> 'MACHINERY'
""")
def source_query_filtered(spark, sf):
    spec = MappingSpec(
        "m", "Order", row_filter="c_mktsegment <> 'MACHINERY'",
        source=SourceSpec(query="select o_orderkey, c_name, c_mktsegment from {orders} join {customer} on c_custkey = o_custkey where o_totalprice > 100000"),
    )
    relations = {n: table(spark, sf, n) for n in ("orders", "customer")}
    return extract_rows(spark, spec, relations).select("o_orderkey", "c_name")


@query("source_since", "select event_id, user_id from events where ts > timestamp '2024-01-20 12:00:00' and event_type <> 'error'")
def source_since(spark, sf):
    spec = MappingSpec(
        "m", "Event", row_filter="event_type <> 'error'", source=SourceSpec(path=f"{sf}/events.parquet"), change_mode="timestamp", watermark_column="TS"
    )
    return extract_rows(spark, spec, since="2024-01-20 12:00:00").select("event_id", "user_id")


@query("range_partition_bounds", """
    select 'orders' as relation, min(o_orderkey) as low, max(o_orderkey) as high, cast(ceil((max(o_orderkey) - min(o_orderkey) + 1) / 1000.0) as bigint) as chunks from orders
    union all select 'lineitem', min(l_orderkey), max(l_orderkey), cast(ceil((max(l_orderkey) - min(l_orderkey) + 1) / 1000.0) as bigint) from lineitem
    union all select 'nobody', null, null, 0
""")
def range_partition_bounds(spark, sf):
    frames = {
        "orders": (table(spark, sf, "orders"), "o_orderkey"),
        "lineitem": (table(spark, sf, "lineitem"), "l_orderkey"),
        "nobody": (table(spark, sf, "orders").where("o_orderkey < 0"), "o_orderkey"),
    }
    out = None
    for name, (df, key) in frames.items():
        probe = bounds(df, key)
        low, high = probe.first()
        row = probe.select(F.lit(name).alias("relation"), "low", "high", F.lit(chunk_count(low, high, 1000)).cast("long").alias("chunks"))
        out = row if out is None else out.unionByName(row)
    return out


@query("range_partitioned_rows", "select c_custkey, case when c_custkey % 10 <> 0 then c_nationkey end as part_key from customer")
def range_partitioned_rows(spark, sf):
    rows = derived(spark, sf, "select c_custkey, case when c_custkey % 10 <> 0 then c_nationkey end as part_key from {customer}", "customer")
    return ranged(rows, "part_key", 5)


@query("existing_edges", """
    select case when o_orderkey % 3 = 0 then 'E' || o_orderkey when o_orderkey % 3 = 1 then 'K' || o_orderkey
        else 'Order_' || o_orderkey || '->' || 'Customer_' || o_custkey end as id, 'Order_' || o_orderkey as from_id, 'Customer_' || o_custkey as to_id
    from orders
""")
def existing_edges_query(spark, sf):
    stored = derived(spark, sf, """
        select concat('Order_', o_orderkey) as from_id, concat('Customer_', o_custkey) as to_id, 'PLACED_BY' as label,
            case when o_orderkey % 3 <= 1 then concat('K', o_orderkey) end as key,
            map('edge_id', case when o_orderkey % 3 = 0 then concat('E', o_orderkey) end, 'status', o_orderstatus) as props
        from {orders}
    """, "orders")
    return existing_edges(stored).select("id", "from_id", "to_id")


@query("source_relation", "select s_suppkey, s_name from supplier where s_acctbal is not null")
def source_relation(spark, sf):
    found = read_relation(spark, SourceSpec("supplier", "main"), {"main.supplier": table(spark, sf, "supplier")})
    return found.where("s_acctbal is not null").select("s_suppkey", "s_name")

"""Edges, merges, deletes and tags."""

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgraft import MappingSpec, SourceSpec
from rowgraft.functions import text as tx
from rowgraft.operators import merge, tags
from rowgraft.operators.elements import elements
from rowgraft.sources.relations import read_relation
from suite import models
from suite.changes import PRIOR_CUSTOMERS
from suite.nodes import exploded
from suite.registry import derived, pairs, query, table, tag_name, text, uuid_of


def mapped(spark, sf, spec, rows=None):
    """Elements of a mapping over the given tables."""
    if rows is None:
        relations = {n: table(spark, sf, n) for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")}
        rows = read_relation(spark, spec.source, relations)
    return elements(rows, spec, models.BY_ID)


def node_frame(found):
    return found.where("id is not null").select("id", "label", "props")


def edge_frame(found):
    return found.where("id is not null").select("id", "label", "from_id", "to_id", "props")


@query("edge_endpoints", """
    select 'PLACED_BY_' || o_orderkey as id, 'Order_' || o_orderkey as from_id, 'Customer_' || o_custkey as to_id from orders
    union all select 'FROM_NATION_' || c_custkey, 'Customer_' || c_custkey, 'Nation_' || c_nationkey from customer
    union all select 'IN_REGION_' || n_nationkey, 'Nation_' || n_nationkey, 'Region_' || n_regionkey from nation
    union all select distinct 'OF_PART_' || l_linenumber, 'Order_' || l_orderkey, 'Part_' || l_partkey from lineitem
""")
def edge_endpoints(spark, sf):
    found = [mapped(spark, sf, s).select("id", "from_id", "to_id") for s in (models.PLACED_BY, models.FROM_NATION, models.IN_REGION, models.OF_PART)]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


@query("edge_null_endpoint", """
    select 'PLACED_BY_' || o_orderkey as id, 'Order_' || o_orderkey as from_id, 'Buyer-' || o_custkey as to_id, cast(null as varchar) as reason, cast(1 as bigint) as n_rows from orders where o_custkey % 10 <> 3
    union all select null, null, null, 'no_endpoint', count(*) from orders where o_custkey % 10 = 3 having count(*) > 0
""")
def edge_null_endpoint(spark, sf):
    """Order edges to buyers some of whom have no id: counted by reason, not made."""
    buyer = replace(models.CUSTOMER, id_expr="case when c_custkey % 10 <> 3 then concat('Buyer-', c_custkey) end", id_starts="Buyer-")
    specs = models.BY_ID | {buyer.mapping_id: buyer}
    rows = read_relation(spark, models.PLACED_BY.source, {"orders": table(spark, sf, "orders")})
    return elements(rows, models.PLACED_BY, specs).select("id", "from_id", "to_id", "reason", "n_rows")


def gapped(spark, sf):
    """Order edges and a node set that lacks some orders and some customers."""
    orders = node_frame(mapped(spark, sf, models.ORDER, table(spark, sf, "orders").where("o_orderkey % 11 <> 5")))
    buyers = node_frame(mapped(spark, sf, models.CUSTOMER, table(spark, sf, "customer").where("c_custkey % 10 <> 3")))
    return edge_frame(mapped(spark, sf, models.PLACED_BY)), orders.unionByName(buyers)


@query("edge_valid", "select 'PLACED_BY_' || o_orderkey as id, 'Customer_' || o_custkey as to_id from orders where o_orderkey % 11 <> 5 and o_custkey % 10 <> 3")
def edge_valid(spark, sf):
    return merge.valid_edges(*gapped(spark, sf)).select("id", "to_id")


@query("edge_dangling", """
    select 'PLACED_BY_' || o_orderkey as id, case when o_orderkey % 11 = 5 and o_custkey % 10 = 3 then 'both' when o_orderkey % 11 = 5 then 'from' else 'to' end as missing
    from orders where o_orderkey % 11 = 5 or o_custkey % 10 = 3
""")
def edge_dangling(spark, sf):
    return merge.dangling_edges(*gapped(spark, sf)).select("id", "missing")


@query("edge_parallel_pairs", """
    select 'Part_' || l_partkey as from_id, 'Supplier_' || l_suppkey as to_id, count(*) as n_edges from lineitem group by l_partkey, l_suppkey having count(*) > 1
""")
def edge_parallel_pairs(spark, sf):
    edges = table(spark, sf, "lineitem").select(
        F.concat(F.lit("Part_"), "l_partkey").alias("from_id"), F.concat(F.lit("Supplier_"), "l_suppkey").alias("to_id")
    )
    return merge.parallel_pairs(edges)


def prior_customers(spark, sf):
    spec = replace(models.CUSTOMER, attributes=models.CUSTOMER.attributes + models.attrs("c_nationkey"))
    return node_frame(mapped(spark, sf, spec, derived(spark, sf, PRIOR_CUSTOMERS, "customer")))


def new_customers(spark, sf):
    """Changed rows; a missing balance must not erase the known one."""
    rows = table(spark, sf, "customer").where("c_custkey % 2 = 0").withColumn("c_acctbal", F.expr("case when c_custkey % 4 = 0 then c_acctbal end"))
    return node_frame(mapped(spark, sf, models.CUSTOMER, rows))


OLD_SQL = PRIOR_CUSTOMERS.replace("{customer}", "customer")
NEW_SQL = "select c_custkey, c_name, case when c_custkey % 4 = 0 then c_acctbal end as c_acctbal, c_mktsegment from customer where c_custkey % 2 = 0"
BOTH_SQL = f"""(select coalesce(n.c_custkey, o.c_custkey) as k, coalesce(n.c_name, o.c_name) as name, n.c_custkey is not null as hit, o.c_nationkey as nation,
    n.c_acctbal as new_bal, o.c_acctbal as old_bal, coalesce(n.c_mktsegment, o.c_mktsegment) as segment
    from ({OLD_SQL}) o full outer join ({NEW_SQL}) n on n.c_custkey = o.c_custkey)"""


@query("upsert_merge", pairs(BOTH_SQL, "'Customer_' || k", c_custkey=text("k"), c_name="name", c_acctbal=text("coalesce(new_bal, old_bal)"),
                             c_mktsegment="segment", c_nationkey=text("nation")))
def upsert_merge(spark, sf):
    return exploded(merge.upsert_nodes(prior_customers(spark, sf), new_customers(spark, sf)))


@query("upsert_replace", pairs(BOTH_SQL, "'Customer_' || k", c_custkey=text("k"), c_name="name", c_acctbal=text("case when hit then new_bal else old_bal end"),
                               c_mktsegment="segment", c_nationkey=text("case when not hit then nation end")))
def upsert_replace(spark, sf):
    return exploded(merge.upsert_nodes(prior_customers(spark, sf), new_customers(spark, sf), replace=True, small=False))


@query("edge_upsert", """
    with n as (select l_linenumber, l_orderkey, l_partkey, last(l_quantity order by l_shipdate, l_quantity) as q from lineitem group by all),
    o as (select l_linenumber, l_orderkey, case when l_orderkey % 9 = 0 then l_partkey + 1 else l_partkey end as l_partkey, max(l_quantity) + 100 as q
        from lineitem where l_partkey % 4 <> 0 group by all)
    select 'OF_PART_' || coalesce(n.l_linenumber, o.l_linenumber) as id, 'Order_' || coalesce(n.l_orderkey, o.l_orderkey) as from_id,
        'Part_' || coalesce(n.l_partkey, o.l_partkey) as to_id, cast(coalesce(n.q, o.q) as varchar) as quantity
    from n full outer join o on n.l_linenumber = o.l_linenumber and n.l_orderkey = o.l_orderkey and n.l_partkey = o.l_partkey
""")
def edge_upsert(spark, sf):
    spec = replace(models.OF_PART, attributes=models.attrs("l_quantity", ids=("l_linenumber",)), order_columns=("l_shipdate", "l_quantity"))
    prior = derived(spark, sf, """
        select l_linenumber, l_orderkey as o_orderkey, case when l_orderkey % 9 = 0 then l_partkey + 1 else l_partkey end as p_partkey,
            l_quantity + 100 as l_quantity, date'2000-01-01' as l_shipdate from {lineitem} where l_partkey % 4 <> 0
    """, "lineitem")
    merged = merge.upsert_edges(edge_frame(mapped(spark, sf, spec, prior)), edge_frame(mapped(spark, sf, spec)))
    return merged.select("id", "from_id", "to_id", F.col("props")["l_quantity"].alias("quantity"))


@query("delete_detach", """
    select 'node' as kind, 'Customer_' || c_custkey as id from customer where c_acctbal >= 0
    union all select 'node', 'Order_' || o_orderkey from orders
    union all select 'edge', 'PLACED_BY_' || o_orderkey from orders join customer on c_custkey = o_custkey where c_acctbal >= 0
    union all select 'cascaded', 'PLACED_BY_' || o_orderkey from orders join customer on c_custkey = o_custkey where c_acctbal < 0
""")
def delete_detach(spark, sf):
    nodes = node_frame(mapped(spark, sf, models.CUSTOMER)).unionByName(node_frame(mapped(spark, sf, models.ORDER)))
    edges = edge_frame(mapped(spark, sf, models.PLACED_BY))
    gone = mapped(spark, sf, models.CUSTOMER, table(spark, sf, "customer").where("c_acctbal < 0")).select("id")
    kept_nodes, kept_edges = merge.delete_nodes(nodes, edges, gone)
    parts = [("node", kept_nodes), ("edge", kept_edges), ("cascaded", merge.incident(edges, gone))]
    shown = [df.select(F.lit(k).alias("kind"), "id") for k, df in parts]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


@query("edge_delete", """
    select distinct 'OF_PART_' || l_linenumber as id, 'Order_' || l_orderkey as from_id, 'Part_' || l_partkey as to_id from lineitem
    where (l_linenumber, l_orderkey, l_partkey) not in (select l_linenumber, l_orderkey, l_partkey from lineitem where l_returnflag = 'R')
""")
def edge_delete(spark, sf):
    edges = edge_frame(mapped(spark, sf, models.OF_PART))
    returned = derived(spark, sf, "select l_linenumber, l_orderkey as o_orderkey, l_partkey as p_partkey, l_quantity, l_shipdate from {lineitem} where l_returnflag = 'R'", "lineitem")
    gone = mapped(spark, sf, models.OF_PART, returned)
    return merge.delete_edges(edges, gone, ["id", "from_id", "to_id"]).select("id", "from_id", "to_id")


@query("delete_owned", "select 'Customer_' || c_custkey as id from customer where c_acctbal < 2000 and c_custkey not in (select user_id from events)")
def delete_owned(spark, sf):
    gone = mapped(spark, sf, models.CUSTOMER, table(spark, sf, "customer").where("c_acctbal < 2000"))
    users = MappingSpec("m-users", "Customer", attributes=models.attrs("event_type", ids=("user_id",)), source=SourceSpec("events"))
    return merge.unclaimed(gone, mapped(spark, sf, users), ["id"])


def concepts(spark, sf):
    """Concept assignments of customers and parts, some names equal once normalised."""
    return derived(spark, sf, """
        select concat('m-', c_custkey) as mapping_id, 'node' as entity_type, c_custkey as ord, concat('Büro ', c_mktsegment) as concept_name from {customer}
        union all select concat('m-', c_custkey), 'edge', c_custkey, concat('Edge ', c_mktsegment) from {customer}
        union all select concat('p-', p_partkey), 'node', p_partkey + 1000000, concat(case when p_size % 2 = 0 then 'bro ' else 'Büro ' end, p_type, ' ', p_brand) from {part}
    """, "customer", "part").select(
        "mapping_id", "entity_type", "ord", tx.tag_id(F.col("concept_name")).alias("tag_id"), tx.tag_name(F.col("concept_name")).alias("tag_name"),
        F.lit("business_domain").alias("tag_category"), F.left("concept_name", F.lit(100)).alias("display_name"),
    )


CONCEPT_SQL = """(select c_custkey as ord, 'Büro ' || c_mktsegment as c from customer
    union all select p_partkey + 1000000, (case when p_size % 2 = 0 then 'bro ' else 'Büro ' end) || p_type || ' ' || p_brand from part)"""


@query("concept_tags", f"""
    select {uuid_of(f"md5({tag_name('c')})")} as id, 'ConceptTag' as label, {tag_name('c')} as name, 'business_domain' as category, first(c order by ord, c) as display_name
    from {CONCEPT_SQL} group by {tag_name('c')}
""")
def concept_tags(spark, sf):
    found = tags.tag_nodes(tags.unique_tags(concepts(spark, sf), ["ord"]))
    return found.select("id", "label", *[F.col("props")[k].alias(k) for k in ("name", "category", "display_name")])


@query("tagged_as", """
    with n as (select 'Customer_' || c_custkey as id, 'm-customer' as m from customer union all select 'Part_' || p_partkey, 'm-part' from part),
    a as (select 'm-customer' as m, lower(c_mktsegment) as tag from customer union select 'm-part', lower(p_type) from part)
    select n.id || '__TAG__' || a.tag as id, 'TAGGED_AS' as label, n.id as from_id, a.tag as to_id from n join a on a.m = n.m
""")
def tagged_as(spark, sf):
    nodes = mapped(spark, sf, models.CUSTOMER).unionByName(mapped(spark, sf, models.PART))
    assigned = derived(spark, sf, "select 'm-customer' as mapping_id, lower(c_mktsegment) as tag_id from {customer} union all select 'm-part', lower(p_type) from {part}", "customer", "part")
    return tags.tagged_as(nodes, assigned).select("id", "label", "from_id", "to_id")


@query("tagged_as_mapping", """
    select 'Customer_' || c_custkey || '__TAG__' || t as id, 'Customer_' || c_custkey as from_id, t as to_id from customer, (values ('tag-buyer'), ('tag-party')) v(t)
""")
def tagged_as_mapping(spark, sf):
    return tags.tagged_as_spec(mapped(spark, sf, models.CUSTOMER), models.CUSTOMER.concept_tags).select("id", "from_id", "to_id")


@query("tenant_partition", """
    select 'Customer_' || c_custkey as id, case when c_custkey % 10 <> 3 then 'old:1' else 'client:inst' end as pk from customer
    union all select 'Customer_' || (c_custkey + 10000000), 'old:1' from customer where c_custkey % 50 = 0
""")
def tenant_partition(spark, sf):
    current = merge.with_tenant(prior_customers(spark, sf), "pk", "old:1")
    changed = merge.with_tenant(node_frame(mapped(spark, sf, models.CUSTOMER)), "pk", "client:inst", current)
    return merge.upsert_nodes(current, changed).select("id", F.col("props")["pk"].alias("pk"))


@query("graph_totals", """
    select 'Order' as label, count(*) as n from orders union all select 'Customer', count(*) from customer
    union all select 'Line', count(*) from (select distinct * from lineitem) union all select 'Part', count(*) from part
    union all select 'Region', count(*) from region union all select 'Nation', count(*) from nation union all select 'Supplier', count(*) from supplier
    union all select 'IN_REGION', count(*) from nation union all select 'FROM_NATION', count(*) from customer union all select 'PLACED_BY', count(*) from orders
    union all select 'OF_PART', count(*) from (select distinct l_linenumber, l_orderkey, l_partkey from lineitem)
""")
def graph_totals(spark, sf):
    return merge.totals(reduce(DataFrame.unionByName, [mapped(spark, sf, s).where("id is not null").select("label") for s in models.ALL]))

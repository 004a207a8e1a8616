"""Export formats over whole tables."""

from pyspark.sql import functions as F

from rowgraft.session import small_frame
from rowgraft.sinks import gml, graphml, rows
from suite import models
from suite.graphs import edge_frame, mapped, node_frame
from suite.registry import instant, query, table, workspace


def quoted_customers(spark, sf):
    """Customers with values that need quoting, escaping or are missing."""
    source = table(spark, sf, "customer").withColumns({
        "c_name": F.expr("case when c_custkey % 5 = 0 then concat(c_name, ', \"x\"') when c_custkey % 5 = 1 then concat('é<', c_name, '&') else c_name end"),
        "c_mktsegment": F.expr("case when c_custkey % 3 <> 0 then c_mktsegment end"),
    })
    return node_frame(mapped(spark, sf, models.CUSTOMER, source))


NAME = "(case when c_custkey % 5 = 0 then c_name || ', \"x\"' when c_custkey % 5 = 1 then 'é<' || c_name || '&' else c_name end)"
SEGMENT = "(case when c_custkey % 3 <> 0 then c_mktsegment end)"


@query("export_csv_rows", f"""
    select 'Customer_' || c_custkey as id, 'Customer_' || c_custkey || ',Customer,c_custkey=' || c_custkey || ','
        || case when c_custkey % 5 = 0 then '"c_name=' || replace({NAME}, '"', '""') || '"' else 'c_name=' || {NAME} end
        || ',c_acctbal=' || c_acctbal || ',' || coalesce('c_mktsegment=' || {SEGMENT}, '') as line
    from customer
    union all select 'PLACED_BY_' || o_orderkey, 'PLACED_BY_' || o_orderkey || ',Order_' || o_orderkey || ',Customer_' || o_custkey || ',PLACED_BY,o_orderkey=' || o_orderkey
        || ',o_orderdate=' || {instant('o_orderdate')}
    from orders
""")
def export_csv_rows(spark, sf):
    nodes = rows.csv_lines(quoted_customers(spark, sf), rows.NODE_ROW).select("id", "line")
    return nodes.unionByName(rows.csv_lines(edge_frame(mapped(spark, sf, models.PLACED_BY)), rows.EDGE_ROW).select("id", "line"))


@query("export_typed_columns", """
    select 'Customer_' || c_custkey as "~id", 'Customer' as "~label", c_custkey as "c_custkey:Long", c_acctbal as "c_acctbal:Double", cast(null as integer) as "c_name:Int",
        cast(null as varchar) as "~from", cast(null as varchar) as "~to", cast(null as bigint) as "o_orderkey:Long", cast(null as timestamp) as "o_orderdate:DateTime" from customer
    union all select 'PLACED_BY_' || o_orderkey, 'PLACED_BY', null, null, null, 'Order_' || o_orderkey, 'Customer_' || o_custkey, o_orderkey, o_orderdate from orders
""")
def export_typed_columns(spark, sf):
    nodes = rows.typed_columns(quoted_customers(spark, sf), rows.NODE_ROW, {"c_custkey": "Long", "c_acctbal": "Double", "c_name": "Int"})
    edges = rows.typed_columns(edge_frame(mapped(spark, sf, models.PLACED_BY)), rows.EDGE_ROW, {"o_orderkey": "Long", "o_orderdate": "DateTime"})
    return nodes.unionByName(edges, allowMissingColumns=True)


def both_json_rows(spark, sf, types=None):
    nodes = rows.json_rows(quoted_customers(spark, sf), rows.NODE_ROW, types)
    edges = rows.json_rows(edge_frame(mapped(spark, sf, models.PLACED_BY)), rows.EDGE_ROW, types)
    return nodes.unionByName(edges, allowMissingColumns=True)


def json_edges(key: str) -> str:
    shown = f"""'{{"o_orderkey":' || {key} || ',"o_orderdate":"' || {instant('o_orderdate')} || '"}}'"""
    return f"select 'PLACED_BY_' || o_orderkey, 'Order_' || o_orderkey, 'Customer_' || o_custkey, 'PLACED_BY', {shown} from orders"


@query("export_json_rows", f"""
    select 'Customer_' || c_custkey as id, cast(null as varchar) as from_id, cast(null as varchar) as to_id, 'Customer' as label, '{{"c_custkey":"' || c_custkey || '","c_name":"' || replace({NAME}, '"', '\\"') || '","c_acctbal":"' || c_acctbal || '","c_mktsegment":'
        || coalesce('"' || {SEGMENT} || '"', 'null') || '}}' as properties from customer
    union all {json_edges("'\"' || o_orderkey || '\"'")}
""")
def export_json_rows(spark, sf):
    return both_json_rows(spark, sf)


@query("export_json_typed", f"""
    select 'Customer_' || c_custkey as id, cast(null as varchar) as from_id, cast(null as varchar) as to_id, 'Customer' as label, '{{"c_custkey":' || c_custkey || ',"c_name":"' || replace({NAME}, '"', '\\"') || '","c_acctbal":' || c_acctbal || ',"c_mktsegment":'
        || coalesce('"' || {SEGMENT} || '"', 'null') || '}}' as properties from customer
    union all {json_edges('o_orderkey')}
""")
def export_json_typed(spark, sf):
    return both_json_rows(spark, sf, {"c_custkey": "Long", "c_acctbal": "Double", "c_name": "Int", "o_orderkey": "Long"})



@query("export_typed_all_labels", f"""
    select 'nodes' as kind, 'Customer' as label, 'Customer_' || c_custkey || ',Customer,' || c_custkey || ',' || c_acctbal || ',' || coalesce({SEGMENT}, '') || ','
        || case when c_custkey % 5 = 0 then '"' || replace({NAME}, '"', '""') || '"' else {NAME} end as line
    from customer
    union all select 'nodes', 'Order', 'Order_' || o_orderkey || ',Order,' || o_orderkey || ',' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') || ',,' || o_orderpriority || ',' || o_totalprice from orders
    union all select 'edges', 'PLACED_BY', 'PLACED_BY_' || o_orderkey || ',Order_' || o_orderkey || ',Customer_' || o_custkey || ',PLACED_BY,' || {instant('o_orderdate')} || ',' || o_orderkey from orders
    union all values ('nodes_header', 'Customer', '~id,~label,c_custkey:Long,c_acctbal:Double,c_mktsegment:String,c_name:String'),
        ('nodes_header', 'Order', '~id,~label,o_orderkey:Long,o_orderdate:DateTime,o_orderstatus:Int,o_orderpriority:String,o_totalprice:String'),
        ('edges_header', 'PLACED_BY', '~id,~from,~to,~label,o_orderdate:String,o_orderkey:String')
    union all select 'unread', 'Order', cast(count(*) as varchar) from orders
""")
def export_typed_all_labels(spark, sf):
    """Every label with its own columns in one pass, read back; no order status is a number."""
    folder = workspace(spark, "typed")
    nodes = quoted_customers(spark, sf).unionByName(node_frame(mapped(spark, sf, models.ORDER)))
    types = {"Customer": {"c_custkey": "Long", "c_acctbal": "Double"}, "Order": {"o_orderkey": "Long", "o_orderdate": "DateTime", "o_orderstatus": "Int"}}
    unread = rows.write_typed_csv(nodes, edge_frame(mapped(spark, sf, models.PLACED_BY)), folder, types)
    told = [("unread", k.split("/")[1], str(n)) for k, n in unread.items() if n]
    found = small_frame(spark, told, "kind string, label string, line string")
    for kind in ("nodes", "nodes_header", "edges", "edges_header"):
        lines = spark.read.schema("value string, label string").text(f"{folder}/{kind}")
        found = found.unionByName(lines.select(F.lit(kind).alias("kind"), "label", F.col("value").alias("line")))
    return found


@query("keyed_batches", f"""
    select 'Part_' || p_partkey as id, 'Part_' || p_partkey as own_id, p_name as name,
        cast(floor((row_number() over (order by substr(md5('Part_' || p_partkey), 1, 3), 'Part_' || p_partkey) - 1) / 500) as bigint) as batch
    from part
""")
def keyed_batches(spark, sf):
    found = rows.keyed_batches(node_frame(mapped(spark, sf, models.PART)), 500, "own_id", "id")
    return found.select("id", F.col("props")["own_id"].alias("own_id"), F.col("props")["p_name"].alias("name"), "batch")


def gml_escaped(sql: str) -> str:
    return f"replace(replace(replace({sql}, '&', '&#38;'), '\"', '&#34;'), 'é', '&#233;')"


NODE_SEQ = """(select id, row_number() over (order by substr(md5(id), 1, 3), id) - 1 as seq from
    (select 'Customer_' || c_custkey as id from customer union all select 'Order_' || o_orderkey from orders))"""


@query("export_gml", f"""
    with n as {NODE_SEQ}
    select 'node' as kind, n.id as id, '  node [' || chr(10) || '    id ' || seq || chr(10) || '    label "' || n.id || '"' || chr(10) || '    entity_label "Customer"' || chr(10)
        || '    c_custkey "' || c_custkey || '"' || chr(10) || '    c_name "' || {gml_escaped(NAME)} || '"' || chr(10) || '    c_acctbal "' || c_acctbal || '"'
        || coalesce(chr(10) || '    c_mktsegment "' || {SEGMENT} || '"', '') || chr(10) || '  ]' as text
    from customer join n on n.id = 'Customer_' || c_custkey
    union all select 'node', n.id, '  node [' || chr(10) || '    id ' || seq || chr(10) || '    label "' || n.id || '"' || chr(10) || '    entity_label "Order"' || chr(10)
        || '    o_orderkey "' || o_orderkey || '"' || chr(10) || '    o_orderstatus "' || o_orderstatus || '"' || chr(10) || '    o_totalprice "' || o_totalprice || '"' || chr(10)
        || '    o_orderdate "' || {instant('o_orderdate')} || '"' || chr(10) || '    o_orderpriority "' || o_orderpriority || '"' || chr(10) || '  ]'
    from orders join n on n.id = 'Order_' || o_orderkey
    union all select 'edge', 'PLACED_BY_' || o_orderkey, '  edge [' || chr(10) || '    source ' || a.seq || chr(10) || '    target ' || b.seq || chr(10)
        || '    key "PLACED_BY_' || o_orderkey || '"' || chr(10) || '    entity_label "PLACED_BY"' || chr(10) || '    edge_id "PLACED_BY_' || o_orderkey || '"' || chr(10)
        || '    o_orderkey "' || o_orderkey || '"' || chr(10) || '    o_orderdate "' || {instant('o_orderdate')} || '"' || chr(10) || '  ]'
    from orders join n a on a.id = 'Order_' || o_orderkey join n b on b.id = 'Customer_' || o_custkey
""")
def export_gml(spark, sf):
    buyers = quoted_customers(spark, sf)
    placed = gml.node_numbers(buyers.unionByName(node_frame(mapped(spark, sf, models.ORDER))))
    nodes = gml.node_records(placed).select(F.lit("node").alias("kind"), "id", "text")
    edges = gml.edge_records(edge_frame(mapped(spark, sf, models.PLACED_BY)), placed, True)
    return nodes.unionByName(edges.select(F.lit("edge").alias("kind"), "id", "text"))


def xml(sql: str) -> str:
    return f"replace(replace(replace({sql}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query("export_graphml", f"""
    select 'node' as kind, 'Customer_' || c_custkey as id, '    <node id="Customer_' || c_custkey || '">' || chr(10)
        || '      <data key="d7">Customer</data>' || chr(10) || '      <data key="d4">' || c_custkey || '</data>' || chr(10) || '      <data key="d6">' || {xml(NAME)} || '</data>' || chr(10)
        || '      <data key="d3">' || c_acctbal || '</data>' || coalesce(chr(10) || '      <data key="d5">' || {SEGMENT} || '</data>', '') || chr(10) || '    </node>' as text
    from customer
    union all select 'edge', 'PLACED_BY_' || o_orderkey, '    <edge source="Order_' || o_orderkey || '" target="Customer_' || o_custkey || '" id="PLACED_BY_' || o_orderkey || '">' || chr(10)
        || '      <data key="d0">PLACED_BY</data>' || chr(10) || '      <data key="d2">' || o_orderkey || '</data>' || chr(10) || '      <data key="d1">' || {instant('o_orderdate')} || '</data>'
        || chr(10) || '    </edge>'
    from orders
""")
def export_graphml(spark, sf):
    nodes, edges = quoted_customers(spark, sf), edge_frame(mapped(spark, sf, models.PLACED_BY))
    keys = graphml.property_keys(nodes, edges)
    shown = graphml.node_records(nodes, keys).select(F.lit("node").alias("kind"), "id", "text")
    return shown.unionByName(graphml.edge_records(edges, keys).select(F.lit("edge").alias("kind"), "id", "text"))



"""Ids and properties."""

from pyspark.sql import functions as F

from rowgraft import AttrSpec, MappingSpec, SourceSpec
from rowgraft.functions.text import typed_text
from rowgraft.functions.types import property_type
from rowgraft.operators import identity, properties
from rowgraft.operators.collapse import collapse_rows
from rowgraft.operators.elements import elements
from rowgraft.sources.relations import extract_rows
from suite import models
from suite.registry import derived, instant, pairs, query, sha, table, text

LINE_TEXTS = [
    text("l_orderkey"), text("l_partkey"), text("l_suppkey"), text("l_linenumber"), text("l_quantity"),
    text("l_extendedprice"), text("l_discount"), text("l_tax"), "l_returnflag", "l_linestatus", instant("l_shipdate"),
]
ORDER_TEXTS = [text("o_orderkey"), text("o_custkey"), "o_orderstatus", text("o_totalprice"), instant("o_orderdate"), "o_orderpriority"]


@query("node_composite_id", """
    select 'Customer' as label, 'Customer_' || c_custkey || '_' || c_nationkey as id from customer
    union all select 'Part', 'Part_' || p_partkey || '_' || coalesce(cast(case when p_size % 5 <> 0 then p_size end as varchar), '') from part
    union all select 'Order', 'Order_' || o_orderkey || '_' || o_totalprice from orders
""")
def node_composite_id(spark, sf):
    sized = derived(spark, sf, "select p_partkey, case when p_size % 5 <> 0 then p_size end as p_size from {part}", "part")
    frames = [
        (table(spark, sf, "customer"), "Customer", ["c_custkey", "c_nationkey"]),
        (sized, "Part", ["p_partkey", "p_size"]),
        (table(spark, sf, "orders"), "Order", ["o_orderkey", "o_totalprice"]),
    ]
    shown = [df.select(F.lit(n).alias("label"), identity.composite_id(df, n, c).alias("id")) for df, n, c in frames]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


@query("node_expr_id", """
    select 'Order#' || o_orderkey || ':' || lower(o_orderpriority) as id, cast(o_custkey as bigint) as o_custkey
    from orders where o_orderstatus <> 'P' and o_totalprice > 1000
""")
def node_expr_id(spark, sf):
    spec = MappingSpec(
        "m", "Order", source=SourceSpec(path=f"{sf}/orders.parquet"), row_filter="o_orderstatus <> 'P' and o_totalprice > 1000",
        id_expr="concat('Order#', o_orderkey, ':', lower(o_orderpriority))",
    )
    rows = extract_rows(spark, spec)
    return rows.select(identity.element_id(rows, spec).alias("id"), "o_custkey")


@query("node_hash_id", f"""
    select 'Line_' || {sha("'Line'", *LINE_TEXTS)} as id, cast(l_orderkey as bigint) as l_orderkey, cast(l_linenumber as bigint) as l_linenumber
    from lineitem
""")
def node_hash_id(spark, sf):
    rows = table(spark, sf, "lineitem")
    return rows.select(
        identity.element_id(rows, models.LINE).alias("id"), "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber")
    )


@query("node_skip_null_id", """
    select 'C' || c_custkey as id, cast(null as varchar) as reason, cast(1 as bigint) as n_rows from customer where c_acctbal >= 0
    union all select null, 'no_id', count(*) from customer where c_acctbal < 0 having count(*) > 0
""")
def node_skip_null_id(spark, sf):
    spec = MappingSpec("m", "Customer", attributes=models.CUSTOMER.attributes, id_expr="case when c_acctbal >= 0 then concat('C', c_custkey) end")
    return elements(table(spark, sf, "customer"), spec, {}).select("id", "reason", "n_rows")


@query("row_fingerprint", f"""
    select o_orderkey, {sha(*ORDER_TEXTS)} as row_hash, sha256(coalesce({text("o_custkey")}, chr(0)) || coalesce({text("o_totalprice")}, chr(0))) as plain_hash
    from orders
""")
def row_fingerprint(spark, sf):
    rows = table(spark, sf, "orders")
    return rows.select(
        "o_orderkey",
        identity.row_fingerprint(rows, rows.columns).alias("row_hash"),
        identity.row_fingerprint(rows, ["O_CUSTKEY", "o_totalprice"], separated=False).alias("plain_hash"),
    )


def exploded(df, props="props"):
    return df.select("id", F.explode(props).alias("key", "value")).where("value is not null")


@query("props_long", pairs("customer", "'Customer_' || c_custkey", c_custkey=text("c_custkey"), c_name="c_name", c_acctbal=text("c_acctbal"), c_mktsegment="c_mktsegment")
       + " union all " + pairs("supplier", "'Supplier_' || s_suppkey", s_suppkey=text("s_suppkey"), s_name="s_name", s_acctbal=text("s_acctbal")))
def props_long(spark, sf):
    frames = [elements(table(spark, sf, s.source.table), s, {}) for s in (models.CUSTOMER, models.SUPPLIER)]
    return exploded(frames[0].unionByName(frames[1]).withColumn("props", properties.without_nulls(F.col("props"))))


@query("props_transform_keep", pairs(
    "customer", "'Customer_' || c_custkey", c_custkey=text("c_custkey"), number="cast(cast(split_part(c_name, '#', 2) as integer) as varchar)",
    segment="c_mktsegment", strict="cast(null as varchar)", upper="upper(trim(c_mktsegment))",
    ratio="case when c_nationkey = 0 then '0' else cast(100.0::double / c_nationkey as varchar) end",
))
def props_transform_keep(spark, sf):
    attributes = (
        AttrSpec("c_custkey", "c_custkey", is_id=True),
        AttrSpec("c_name", "number", transform="try_cast(split_part(value, '#', 2) as int)"),
        AttrSpec("c_mktsegment", "segment", transform="try_cast(value as int)"),
        AttrSpec("c_mktsegment", "strict", transform="try_cast(value as int)", on_null="null"),
        AttrSpec("C_MKTSEGMENT", "upper", transform="upper(trim(value))"),
        AttrSpec("c_nationkey", "ratio", transform="try_divide(cast(100 as double), value)"),
    )
    spec = MappingSpec("m", "Customer", attributes=attributes, unique_ids=True)
    return exploded(elements(table(spark, sf, "customer"), spec, {}))


@query("props_classified", pairs(
    "customer", "'Customer_' || c_custkey", c_custkey=text("c_custkey"), name="c_name", name__privacy_class="'PII'",
    name__security_class="'CONFIDENTIAL'", balance=text("c_acctbal"), balance__security_class="'RESTRICTED'",
))
def props_classified(spark, sf):
    attributes = (
        AttrSpec("c_custkey", "c_custkey", is_id=True),
        AttrSpec("c_name", "name", privacy_class="PII", security_class="CONFIDENTIAL"),
        AttrSpec("c_acctbal", "balance", security_class="RESTRICTED"),
        AttrSpec("no_such_column", "absent"),
    )
    spec = MappingSpec("m", "Customer", attributes=attributes, unique_ids=True)
    return exploded(elements(table(spark, sf, "customer"), spec, {}))


@query("props_typed_text", """
    select event_id, cast(event_id as varchar) as id_text,
        strftime(ts, '%Y-%m-%dT%H:%M:%S') || case when date_part('microseconds', ts) % 1000000 = 0 then '' else strftime(ts, '.%f') end as ts_text,
        coalesce(cast(case when value >= 10 then value end as varchar), '') as value_text, case when user_id <> 0 then 'true' else 'false' end as flag_text
    from events
""")
def props_typed_text(spark, sf):
    rows = derived(spark, sf, "select *, case when value >= 10 then value end as big from {events}", "events")
    kinds = {"id_text": ("event_id", "Long"), "ts_text": ("ts", "DateTime"), "value_text": ("big", "Double"), "flag_text": ("user_id", "Bool")}
    return rows.select("event_id", *[typed_text(F.col(c), rows.schema[c].dataType, k).alias(n) for n, (c, k) in kinds.items()])


# All type codes of a catalog, with a code that no catalog knows at the end.
TYPE_CODES = (
    "array bigint binary bit blob boolean char clob datalink date decimal distinct double float integer json longvarbinary longvarchar "
    "null numeric object other real refcursor ref rowid smallint struct timestamp timestampwithtimezone time timewithtimezone tinyint varbinary varchar xml unheard"
).split()
CODE_LIST = "[" + ", ".join(f"'{c}'" for c in TYPE_CODES) + "]"


@query("type_map", f"""
    select p_partkey, {CODE_LIST}[p_partkey % {len(TYPE_CODES)} + 1] as code, case {CODE_LIST}[p_partkey % {len(TYPE_CODES)} + 1]
        when 'bigint' then 'Long' when 'bit' then 'Bool' when 'boolean' then 'Bool' when 'date' then 'Date' when 'decimal' then 'Double' when 'double' then 'Double'
        when 'float' then 'Float' when 'integer' then 'Int' when 'numeric' then 'Float' when 'real' then 'Double' when 'smallint' then 'Int' when 'timestamp' then 'DateTime'
        when 'timestampwithtimezone' then 'DateTime' when 'time' then 'DateTime' when 'timewithtimezone' then 'DateTime' when 'tinyint' then 'Int' else 'String' end as property_type
    from part
""")
def type_map(spark, sf):
    rows = table(spark, sf, "part")
    code = F.element_at(F.array(*[F.lit(c) for c in TYPE_CODES]), (F.col("p_partkey") % len(TYPE_CODES) + 1).cast("int"))
    return rows.select("p_partkey", code.alias("code"), property_type(F.concat(F.lit("bi.flow.types."), code)).alias("property_type"))


@query("props_sanitized_keys", """
    select * from (
        select event_id as id, regexp_replace(event_type || '-' || user_id % 7, '[^A-Za-z0-9_]', '_', 'g') as key, cast(event_id as varchar) as value from events
        union all select event_id, 'k__Deleted_TS_', event_type from events
        union all select event_id, 'k_1st', cast(user_id as varchar) from events
        union all select event_id, 'a_b', 'second' from events
        union all select event_id, 'k_', props from events
    )
""")
def props_sanitized_keys(spark, sf):
    rows = table(spark, sf, "events")
    props = F.create_map(
        F.concat_ws("-", "event_type", F.col("user_id") % 7), F.col("event_id").cast("string"),
        F.lit("_Deleted TS_"), F.col("event_type"), F.lit("1st"), F.col("user_id").cast("string"),
        F.lit("a-b"), F.lit("first"), F.lit("a_b"), F.lit("second"), F.lit(""), F.col("props"), F.lit("gone"), F.lit(None),
    )
    return rows.select(F.col("event_id").alias("id"), F.explode(properties.with_valid_keys(props)).alias("key", "value"))


@query("props_container", """
    select 'Vec_' || vec_id as id, array_to_string([cast(floor(cast(x as double) * 1e9) as bigint) for x in embedding], ',') as billionths, cast(label as varchar) as label_text
    from embeddings
""")
def props_container(spark, sf):
    spec = MappingSpec("m", "Vec", attributes=models.attrs("embedding", "label", ids=("vec_id",)), unique_ids=True)
    found = elements(table(spark, sf, "embeddings"), spec, {})
    values = F.from_json(F.col("props")["embedding"], "array<float>")
    shown = F.array_join(F.transform(values, lambda x: F.floor(x.cast("double") * F.lit(1e9)).cast("long").cast("string")), ",")
    return found.select("id", shown.alias("billionths"), F.col("props")["label"].alias("label_text"))


@query("props_text", """
    select 'Doc_' || d.doc_id as id, md5(d.text) as text_md5, cast(length(d.text) as bigint) as n, cast(l.quality as varchar) as quality
    from documents d left join labels l on l.doc_id = d.doc_id
    union all select 'Turn_' || conv_id || '_' || turn, md5(text), length(text), role from conversations
""")
def props_text(spark, sf):
    documents = derived(spark, sf, "select d.*, l.quality from {documents} d left join {labels} l on l.doc_id = d.doc_id", "documents", "labels")
    doc = MappingSpec("d", "Doc", attributes=models.attrs("text", "quality", ids=("doc_id",)), unique_ids=True)
    turn = MappingSpec("t", "Turn", attributes=models.attrs("text", "role", ids=("conv_id", "turn")), unique_ids=True)
    found = elements(documents, doc, {}).unionByName(elements(table(spark, sf, "conversations"), turn, {}))
    props = F.col("props")
    return found.select(
        "id", F.md5(props["text"]).alias("text_md5"), F.length(props["text"]).cast("long").alias("n"), F.coalesce(props["quality"], props["role"]).alias("quality")
    )


@query("dup_last_wins", f"""
    with t as (select *, case when l_returnflag <> 'N' then l_returnflag end as flag,
        {sha(text("l_orderkey"), text("l_linenumber"), text("l_quantity"), "case when l_returnflag <> 'N' then l_returnflag end")} as tie from lineitem)
    select 'Line_' || l_orderkey || '_' || l_linenumber as id, count(*) as n_rows, cast(last(l_quantity order by l_shipdate, tie) as varchar) as quantity,
        last(flag order by l_shipdate, tie) filter (where flag is not null) as flag
    from t group by l_orderkey, l_linenumber
""")
def dup_last_wins(spark, sf):
    rows = derived(spark, sf, "select *, case when l_returnflag <> 'N' then l_returnflag end as flag from {lineitem}", "lineitem")
    spec = MappingSpec("m", "Line", attributes=models.attrs("l_quantity", "flag", ids=("l_orderkey", "l_linenumber")), order_columns=("l_shipdate",))
    found = elements(rows, spec, {})
    return found.select("id", "n_rows", F.col("props")["l_quantity"].alias("quantity"), F.col("props")["flag"].alias("flag"))


@query("user_profile", """
    select user_id, count(*) as n_rows, last(event_type order by ts, event_id) as event_type,
        last(value order by ts, event_id) filter (where value > 20) as big_value
    from events group by user_id
""")
def user_profile(spark, sf):
    rows = table(spark, sf, "events").withColumn("big_value", F.when(F.col("value") > 20, F.col("value")))
    return collapse_rows(rows, ["user_id"], ["event_type", "big_value"], F.struct("ts", "event_id"), [])

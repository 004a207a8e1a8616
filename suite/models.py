"""Mappings of the given tables that several queries use."""

from rowgraft import AttrSpec, MappingSpec, SourceSpec, TagSpec


def attrs(*names: str, ids: tuple[str, ...] = ()) -> tuple[AttrSpec, ...]:
    return tuple(AttrSpec(n, n, is_id=n in ids) for n in (*ids, *[n for n in names if n not in ids]))


TAG_BUYER = TagSpec("tag-buyer", "buyer", display_name="Buyer")
TAG_PARTY = TagSpec("tag-party", "party")

REGION = MappingSpec("m-region", "Region", attributes=attrs("r_name", ids=("r_regionkey",)), source=SourceSpec("region"), unique_ids=True)
NATION = MappingSpec("m-nation", "Nation", attributes=attrs("n_name", ids=("n_nationkey",)), source=SourceSpec("nation"), unique_ids=True)
CUSTOMER = MappingSpec(
    "m-customer", "Customer", attributes=attrs("c_name", "c_acctbal", "c_mktsegment", ids=("c_custkey",)),
    source=SourceSpec("customer"), unique_ids=True, concept_tags=(TAG_BUYER, TAG_PARTY),
)
SUPPLIER = MappingSpec(
    "m-supplier", "Supplier", attributes=attrs("s_name", "s_acctbal", ids=("s_suppkey",)), source=SourceSpec("supplier"),
    unique_ids=True, concept_tags=(TAG_PARTY,),
)
PART = MappingSpec(
    "m-part", "Part", attributes=attrs("p_name", "p_brand", "p_type", "p_size", "p_retailprice", ids=("p_partkey",)),
    source=SourceSpec("part"), unique_ids=True,
)
ORDER = MappingSpec(
    "m-order", "Order", attributes=attrs("o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", ids=("o_orderkey",)),
    source=SourceSpec("orders"), unique_ids=True,
)
LINE = MappingSpec(
    "m-line", "Line", attributes=attrs(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ), source=SourceSpec("lineitem"),
)
IN_REGION = MappingSpec(
    "m-in-region", "IN_REGION", "edge", attrs(ids=("n_nationkey",)), SourceSpec(query="select *, n_regionkey as r_regionkey from {nation}"),
    from_mapping_id="m-nation", to_mapping_id="m-region", unique_ids=True, load_order=1000,
)
FROM_NATION = MappingSpec(
    "m-from-nation", "FROM_NATION", "edge", attrs(ids=("c_custkey",)), SourceSpec(query="select *, c_nationkey as n_nationkey from {customer}"),
    from_mapping_id="m-customer", to_mapping_id="m-nation", unique_ids=True, load_order=1000,
)
PLACED_BY = MappingSpec(
    "m-placed-by", "PLACED_BY", "edge", attrs("o_orderdate", ids=("o_orderkey",)), SourceSpec(query="select *, o_custkey as c_custkey from {orders}"),
    from_mapping_id="m-order", to_mapping_id="m-customer", unique_ids=True, load_order=1000,
)
OF_PART = MappingSpec(
    "m-of-part", "OF_PART", "edge", attrs("l_quantity", "l_shipdate", ids=("l_linenumber",)),
    SourceSpec(query="select *, l_orderkey as o_orderkey, l_partkey as p_partkey from {lineitem}"),
    from_mapping_id="m-order", to_mapping_id="m-part", order_columns=("l_shipdate",), load_order=1000,
)
ALL = [REGION, NATION, CUSTOMER, SUPPLIER, PART, ORDER, LINE, IN_REGION, FROM_NATION, PLACED_BY, OF_PART]
BY_ID = {m.mapping_id: m for m in ALL}

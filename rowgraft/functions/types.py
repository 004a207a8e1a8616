"""Declared source types and the graph property types they become."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Catalog type codes by property type; every other code is a String.
TYPE_CODE_PREFIX = "bi.flow.types."
CODES_BY_PROPERTY_TYPE = {
    "Long": ["bigint"],
    "Int": ["integer", "smallint", "tinyint"],
    "Bool": ["bit", "boolean"],
    "Date": ["date"],
    "DateTime": ["time", "timestamp", "timestampwithtimezone", "timewithtimezone"],
    "Double": ["decimal", "double", "real"],
    "Float": ["float", "numeric"],
}

# Property types as Spark types, for typed exports.
SPARK_TYPES = {
    "String": T.StringType(),
    "Byte": T.ByteType(),
    "Short": T.ShortType(),
    "Int": T.IntegerType(),
    "Long": T.LongType(),
    "Float": T.FloatType(),
    "Double": T.DoubleType(),
    "Bool": T.BooleanType(),
    "Date": T.DateType(),
    "DateTime": T.TimestampNTZType(),
}
UNQUOTED_IN_JSON = frozenset({"Byte", "Short", "Int", "Long", "Float", "Double", "Bool"})


def property_type(code: Column) -> Column:
    """The property type of a catalog type code."""
    short = F.when(
        F.startswith(code, F.lit(TYPE_CODE_PREFIX)), F.substr(code, F.lit(len(TYPE_CODE_PREFIX) + 1))
    )
    picked = F.lit(None).cast("string")
    for name, codes in CODES_BY_PROPERTY_TYPE.items():
        picked = F.when(short.isin(codes), F.lit(name)).otherwise(picked)
    return F.coalesce(picked, F.lit("String"))

"""Text forms of values.  Ids, fingerprints and properties are all built from these,
so one value must always have one text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Separators of the hashed byte strings.
FIELD_SEPARATOR = "\x1f"
NULL_MARK = "\x00"


def _unpadded(decimal_text: Column) -> Column:
    """'12.5000' -> '12.5', '12.0000' -> '12.0'."""
    cut = F.rtrim(decimal_text, F.lit("0"))
    return F.when(F.endswith(cut, F.lit(".")), F.concat(cut, F.lit("0"))).otherwise(cut)


def _floating_text(value: Column) -> Column:
    """Plain digits from 1e-4 up to 1e16, 'd.dde+xx' beyond; Spark itself switches at 1e-3 and 1e7."""
    text = value.cast("string")
    size = F.abs(value.cast("double"))
    exponent = F.regexp_replace(text, r"\.0E", "E")
    exponent = F.regexp_replace(exponent, r"E(\d)", "e+$1")
    exponent = F.regexp_replace(exponent, r"E-(\d)$", "e-0$1")
    exponent = F.regexp_replace(exponent, r"E-", "e-")
    return (
        F.when((size >= 1e-3) & (size < 1e7) | (size == 0), text)
        .when(F.isnan(value), F.lit("nan"))
        .when((size >= 1e7) & (size < 1e16), _unpadded(text.cast("decimal(38,10)").cast("string")))
        .when((size >= 1e-4) & (size < 1e-3), _unpadded(text.cast("decimal(38,30)").cast("string")))
        .when(size == float("inf"), F.when(value > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .otherwise(exponent)
    )


def _instant_text(value: Column) -> Column:
    """A fraction is shown with six digits or not at all."""
    text = value.cast("string")
    return F.when(F.contains(text, F.lit(".")), F.rpad(text, 26, "0")).otherwise(text)


def canon(value: Column, dtype: T.DataType) -> Column:
    """The one text of a value; NULL stays NULL."""
    if isinstance(dtype, T.StringType):
        return value
    if isinstance(dtype, T.BooleanType):
        return F.when(value, F.lit("True")).when(~value, F.lit("False"))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return _floating_text(value)
    if isinstance(dtype, T.TimestampType):
        # An instant is told in UTC, whatever the zone of the session.
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return _instant_text(F.timestamp_add("MICROSECOND", F.unix_micros(value), epoch))
    if isinstance(dtype, T.TimestampNTZType):
        return _instant_text(value)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(value)
    if isinstance(dtype, T.BinaryType):
        return F.hex(value)
    return value.cast("string")


def typed_text(value: Column, dtype: T.DataType, property_type: str) -> Column:
    """Cell text by declared property type: NULL is empty, Bool is true/false, dates are ISO."""
    plain = canon(value, dtype)
    if property_type == "Bool":
        shown = F.when(truthy(value, dtype), F.lit("true")).otherwise(F.lit("false"))
    elif property_type in ("Date", "DateTime") and isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        shown = F.replace(plain, F.lit(" "), F.lit("T"))
    else:
        shown = plain
    return F.when(value.isNull(), F.lit("")).otherwise(shown)


def truthy(value: Column, dtype: T.DataType) -> Column:
    """True for a non-zero number, a non-empty text or container, and true; never NULL."""
    if isinstance(dtype, T.BooleanType):
        test = value
    elif isinstance(dtype, T.NumericType):
        test = value != F.lit(0)
    elif isinstance(dtype, (T.StringType, T.BinaryType)):
        test = F.length(value) > 0
    elif isinstance(dtype, (T.ArrayType, T.MapType)):
        test = F.size(value) > 0
    else:
        test = value.isNotNull()
    return F.coalesce(test, F.lit(False))


def digest(texts: list[Column], separator: str = FIELD_SEPARATOR) -> Column:
    """SHA-256 over texts, a NULL text counting as one NUL byte."""
    return F.sha2(joined(texts, separator), 256)


def joined(texts: list[Column], separator: str = FIELD_SEPARATOR) -> Column:
    """What the digest of texts is taken of."""
    marked = [F.coalesce(t, F.lit(NULL_MARK)) for t in texts]
    return F.concat_ws(separator, *marked) if separator else F.concat(*marked)


def uuid_text(hex32: Column) -> Column:
    """32 hexadecimal digits in 8-4-4-4-12 form."""
    return F.regexp_replace(hex32, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def tag_name(concept: Column) -> Column:
    """Lower case, blanks to underscores, ASCII only."""
    return F.regexp_replace(F.replace(F.lower(concept), F.lit(" "), F.lit("_")), r"[^\x00-\x7F]", "")


def tag_id(concept: Column) -> Column:
    return uuid_text(F.md5(tag_name(concept)))


# What property_key leaves as it is.
VALID_KEY = r"^[A-Za-z][A-Za-z0-9_]*\z"


def property_key(key: Column) -> Column:
    """Letters, digits and underscores only, beginning with a letter."""
    clean = F.regexp_replace(key, "[^A-Za-z0-9_]", "_")
    return F.when(clean.rlike("^[A-Za-z]"), clean).otherwise(F.concat(F.lit("k_"), clean))


def endpoint_host(endpoint: Column) -> Column:
    return F.split_part(endpoint, F.lit(":"), F.lit(1))


def endpoint_port(endpoint: Column) -> Column:
    """The port of host:port/database, 0 when there is none."""
    after = F.split_part(endpoint, F.lit(":"), F.lit(2))
    return F.concat(F.lit("0"), F.split_part(after, F.lit("/"), F.lit(1))).cast("int")


def endpoint_database(endpoint: Column) -> Column:
    return F.split_part(F.split_part(endpoint, F.lit(":"), F.lit(2)), F.lit("/"), F.lit(2))


def is_uuid(text: Column) -> Column:
    return text.rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")


def sortable(value: Column, data_type: T.DataType) -> Column:
    """Sixteen hexadecimal digits that sort as the whole number, date or instant does."""
    if isinstance(data_type, T.DateType):
        value = F.unix_date(value)
    elif isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(value.cast("timestamp"))
    elif not isinstance(data_type, T.IntegralType):
        raise TypeError(f"{data_type.simpleString()} values give no order that can be kept")
    # The sign bit turned, so that negative numbers come first.
    return F.lpad(F.hex(value.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")

"""Table schemas: Arrow and Spark types, and casts on write."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.errors import UnsupportedType


def spark_type(t: pa.DataType) -> T.DataType:
    """Spark's type for an Arrow type; types that would lose or gain meaning are refused."""
    if pa.types.is_boolean(t):
        return T.BooleanType()
    for check, out in ((pa.types.is_int8, T.ByteType), (pa.types.is_int16, T.ShortType), (pa.types.is_int32, T.IntegerType), (pa.types.is_int64, T.LongType), (pa.types.is_uint8, T.ShortType), (pa.types.is_uint16, T.IntegerType), (pa.types.is_uint32, T.LongType), (pa.types.is_float32, T.FloatType), (pa.types.is_float64, T.DoubleType), (pa.types.is_date32, T.DateType)):
        if check(t):
            return out()
    if pa.types.is_uint64(t):
        return T.DecimalType(20, 0)
    if pa.types.is_float16(t):
        return T.FloatType()
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return T.StringType()
    if pa.types.is_binary(t) or pa.types.is_large_binary(t) or pa.types.is_fixed_size_binary(t):
        return T.BinaryType()
    if pa.types.is_timestamp(t):
        if t.unit == "ns":
            raise UnsupportedType("timestamps in nanoseconds must be cast to microseconds")
        return T.TimestampType() if t.tz else T.TimestampNTZType()
    if pa.types.is_decimal(t):
        if t.precision > 38:
            raise UnsupportedType(f"{t} has more than 38 digits")
        return T.DecimalType(t.precision, t.scale)
    if pa.types.is_list(t) or pa.types.is_large_list(t) or pa.types.is_fixed_size_list(t):
        return T.ArrayType(spark_type(t.value_type))
    if pa.types.is_struct(t):
        return T.StructType([T.StructField(f.name, spark_type(f.type), f.nullable) for f in t])
    if pa.types.is_map(t):
        return T.MapType(spark_type(t.key_type), spark_type(t.item_type))
    if pa.types.is_dictionary(t):
        return spark_type(t.value_type)
    raise UnsupportedType(f"{t} can't be stored; cast it first")


def to_struct(schema: pa.Schema | T.StructType) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    if not isinstance(schema, pa.Schema):
        raise TypeError(f"a schema must be a pyarrow.Schema or a StructType, not {type(schema).__name__}")
    return T.StructType([T.StructField(f.name, spark_type(f.type), True) for f in schema])


def storable(schema: T.StructType) -> T.StructType:
    """The schema with nullable fields; fails on types that Parquet tables can't hold."""
    for f in schema:
        if isinstance(f.dataType, T.NullType):
            raise UnsupportedType(f"column {f.name!r} has no type; give a schema")
    if len({f.name for f in schema}) < len(schema.fields):
        raise ValueError("column names must be unique")
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by exact name, in the schema's order, cast to its types; a missing column is an error."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are not in the data; it has {df.columns}")
    at = {c: i for i, c in enumerate(df.columns)}
    renamed = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return renamed.select(*[F.col(f"c{at[f.name]}").cast(f.dataType).alias(f.name) for f in schema])

"""Schemas of the tables passed between operators, and the check at their edge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

LOCATION = T.StructType([
    T.StructField("index", T.IntegerType()),
    T.StructField("file", T.StringType()),
])
COORD = T.StructType([
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
])
TRANSFORM = T.StructType([
    T.StructField("rot", T.DoubleType()),
    T.StructField("tilt", T.DoubleType()),
    T.StructField("psi", T.DoubleType()),
    T.StructField("shift_x", T.DoubleType()),
    T.StructField("shift_y", T.DoubleType()),
])
VECTOR = T.ArrayType(T.DoubleType())

PARTICLES = T.StructType([
    T.StructField("position", T.LongType()),
    T.StructField("particle_id", T.LongType()),
    T.StructField("location", LOCATION),
    T.StructField("coord", COORD),
    T.StructField("transform", TRANSFORM),
])
LATENTS = T.StructType([
    T.StructField("position", T.LongType()),
    T.StructField("z", VECTOR),
])
VOLUMES = T.StructType([
    T.StructField("vol_id", T.IntegerType()),
    T.StructField("file", T.StringType()),
    T.StructField("z", VECTOR),
])
CENTRES = T.StructType([
    T.StructField("centre_id", T.IntegerType()),
    T.StructField("z", VECTOR),
])
LINEAGE = T.StructType([
    T.StructField("child", T.LongType()),
    T.StructField("parent", T.LongType()),
    T.StructField("kind", T.StringType()),
])


def require_columns(df: DataFrame, schema: T.StructType, *, optional: tuple[str, ...] = ()) -> DataFrame:
    """Return ``df`` if it has every column of ``schema`` with its type."""
    have = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    for field in schema.fields:
        if field.name in optional and field.name not in have:
            continue
        want = field.dataType.simpleString()
        if have.get(field.name) != want:
            raise TypeError(f"column {field.name}: expected {want}, found {have.get(field.name)}")
    return df

"""Ordered text tables: vectors and index lists, one row per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latentspark.operators.position import with_position

LINE_KEYS = ["file", "block", "line"]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a file, or of all files of a folder in name order, with the keys
    ``(file, block, line)`` that give back their order.

    Files are read in parallel byte ranges. ``block`` is where a range starts, and
    ``line`` grows within a range.
    """
    return (
        spark.read.text(path)
        .select("value", F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"))
        .withColumn("line", F.monotonically_increasing_id())
    )


def _numbered(lines: DataFrame) -> DataFrame:
    return with_position(lines, LINE_KEYS[0], LINE_KEYS[1:]).drop(*LINE_KEYS)


def read_z_text(spark: SparkSession, path: str) -> DataFrame:
    """Whitespace matrix as ``(position, z)``; the width of a line is the width of its vector."""
    values = F.transform(F.split(F.trim("value"), r"\s+"), lambda x: x.cast("double"))
    lines = read_lines(spark, path).filter(
        (F.trim("value") != "") & ~F.startswith(F.ltrim("value"), F.lit("#")))
    return _numbered(lines).select("position", values.alias("z"))


def write_z_text(df: DataFrame, path: str) -> None:
    """Write ``(position, z)`` as a whitespace matrix in position order."""
    line = F.array_join(F.transform("z", lambda x: F.format_string("%.18e", x)), " ")
    df.select("position", line.alias("value")).orderBy("position").select("value").write.mode(
        "overwrite").text(path)


def read_index(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Index list as ``(position)``, from parquet or from text with whitespace-separated numbers."""
    if format == "parquet":
        return spark.read.parquet(path).select(F.col("position").cast("bigint").alias("position"))
    words = F.explode(F.split(F.trim("value"), r"\s+"))
    return spark.read.text(path).select(words.alias("w")).filter("w <> ''").select(
        F.col("w").cast("double").cast("bigint").alias("position"))

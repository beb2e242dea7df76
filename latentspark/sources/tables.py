"""Parquet tables: latents, volume sets, particle lists per state."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from latentspark.schemas import LATENTS, VOLUMES, require_columns
from latentspark.sources.log import TableLog

VOLUME_SET_COMMENT = "k-means volumes"


def read_latents(spark: SparkSession, path: str) -> DataFrame:
    """Latent matrix as ``(position, z)``."""
    table = spark.read.parquet(path).select(
        F.col("position").cast("bigint").alias("position"), F.col("z").cast("array<double>").alias("z"))
    return require_columns(table, LATENTS)


def write_by_position(df: DataFrame, path: str, buckets: int) -> None:
    """Store rows by position, so that stores with equally many buckets join without a shuffle.

    The rows are shuffled once, here. Every bucket is one file, sorted.
    """
    spark = df.sparkSession
    name = f"by_position_{uuid.uuid4().hex}"
    df.repartition(buckets, "position").write.format("parquet").mode("overwrite").bucketBy(buckets, "position").sortBy(
        "position").option("path", path).saveAsTable(name)
    # Only the files stay; a reader declares them again. Names with an underscore are no data.
    spark.sql(f"DROP TABLE {name}")
    spark.createDataFrame([(buckets, df.schema.json())], "buckets int, schema string").write.mode("overwrite").parquet(f"{path}/_layout")


def read_by_position(spark: SparkSession, path: str) -> DataFrame:
    """A store by position, with its buckets known to the planner."""
    layout = spark.read.parquet(f"{path}/_layout").first()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(json.loads(layout["schema"])).fields)
    name = f"by_position_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (position) SORTED BY (position) "
              f"INTO {layout['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)


VOLUME_SET = StructType(VOLUMES.fields + [StructField("apix", DoubleType()), StructField("comment", StringType())])


def write_volume_set(df: DataFrame, path: str, apix: float, comment: str = VOLUME_SET_COMMENT, *, key: str | None = None) -> None:
    """Replace the volume set at ``path`` by one commit; pixel size and comment go on every row.

    Readers see the old set or the new one. With a ``key`` the same write done again changes nothing.
    """
    require_columns(df, VOLUMES)
    rows = df.select("vol_id", "file", "z", F.lit(float(apix)).alias("apix"), F.lit(comment).alias("comment"))
    TableLog(df.sparkSession, path, VOLUME_SET).replace(rows, key or uuid.uuid4().hex)


def read_volume_set(spark: SparkSession, path: str) -> DataFrame:
    return TableLog(spark, path, VOLUME_SET).read()


def write_state_lists(particle_states: DataFrame, path: str) -> None:
    """One folder of particle positions per state.

    The rebalance hint gathers a state's rows in few files and lets adaptive
    execution split a state that is too big for one task.
    """
    particle_states.select("state", "position").hint("rebalance", "state").write.mode(
        "overwrite").partitionBy("state").parquet(path)


def read_state_list(spark: SparkSession, path: str, state: int) -> DataFrame:
    """Positions of one state; only that state's folder is read."""
    return spark.read.parquet(path).filter(F.col("state") == state).select("position")

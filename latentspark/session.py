"""Session settings, shared working storage and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

# Bytes a broadcast side may have at most; beyond it a shuffled join is used.
BROADCAST_BYTES = 64 << 20

_local_dirs: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def build_session(master: str | None = None, app: str = "latentspark", **conf) -> SparkSession:
    """A session with adaptive execution on and Arrow batches bounded in rows and bytes.

    The bounds are low because one image row may hold a
    few megabytes.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
        "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def working_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local master, where driver and executors share one disk, may do
    without that setting.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="latentspark-")
    return _local_dirs[app]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Iterative operators use this between rounds: a lost executor costs a re-read
    of the table, not a replay of all rounds before it.
    """
    spark = df.sparkSession
    path = f"{working_dir(spark)}/latentspark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.setdefault(spark.conf.get("spark.app.id", "local"), []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession) -> int:
    """Delete the tables that ``cut_lineage`` wrote in this session; frames made from them can be read no more.

    A long-lived session calls this between jobs, so that shared storage does not fill.
    """
    paths = _written.pop(spark.conf.get("spark.app.id", "local"), [])
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)


def has_rows(df: DataFrame) -> bool:
    return len(df.limit(1).collect()) > 0


def _bytes(column: Column, kind: DataType) -> Column:
    """About how many bytes a value takes."""
    if isinstance(kind, (StringType, BinaryType)):
        size = F.octet_length(column)
    elif isinstance(kind, ArrayType):
        nested = isinstance(kind.elementType, (StringType, BinaryType, ArrayType, MapType, StructType))
        size = F.aggregate(column, F.lit(0).cast("bigint"), lambda n, x: n + _bytes(x, kind.elementType)
                           ) if nested else F.size(column) * 8
    elif isinstance(kind, MapType):
        return _bytes(F.map_keys(column), ArrayType(kind.keyType)) + _bytes(
            F.map_values(column), ArrayType(kind.valueType))
    elif isinstance(kind, StructType):
        return sum((_bytes(column[f.name], f.dataType) for f in kind.fields), F.lit(8))
    else:
        return F.lit(8)
    return F.coalesce(size, F.lit(0)).cast("bigint") + 8


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when ``df`` was measured to be within ``max_bytes``.

    Rows are read until their number alone exceeds the limit. A larger side keeps its
    shuffled join, which adaptive execution may still split for skew.
    """
    row = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(8))
    found = df.select(row.alias("bytes")).limit(max_bytes // 8 + 1).agg(F.sum("bytes")).first()[0]
    return F.broadcast(df) if (found or 0) <= max_bytes else df

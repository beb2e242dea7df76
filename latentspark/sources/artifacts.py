"""Epoch artifacts of runs, found by file name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from latentspark.functions.scalars import base_name

# Epoch artifacts are z.<N>.pkl and weights.<N>.pkl, final ones have no number.
ARTIFACT_PATTERN = r"^(z|weights)(?:\.(\d+))?\.pkl$"
RUN_FOLDER_PATTERN = r"/(\d+)[^/]*/(?:extra/)?output/[^/]+$"
# End of fixed values.


def parse_artifact_paths(paths: DataFrame, run_id: Column | None = None) -> DataFrame:
    """Artifact rows ``(run_id, artifact, epoch, path)`` out of ``path``; other files
    are left out. Only the file name is matched, not the folders. The epoch of a
    final file is NULL."""
    name = base_name(F.col("path"))
    run = F.regexp_extract("path", RUN_FOLDER_PATTERN, 1).try_cast("bigint") if run_id is None else run_id
    return paths.filter(name.rlike(ARTIFACT_PATTERN)).select(
        run.alias("run_id"),
        F.regexp_extract(name, ARTIFACT_PATTERN, 1).alias("artifact"),
        F.regexp_extract(name, ARTIFACT_PATTERN, 2).try_cast("int").alias("epoch"),
        "path")


def list_artifacts(spark: SparkSession, path: str) -> DataFrame:
    """Artifacts below a folder of runs; file contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.pkl").load(path).select("path")
    )
    return parse_artifact_paths(files)

"""Latents of all epochs of all runs, one folder per run and epoch, and their choice by artifact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latentspark.operators.runs import last_epoch
from latentspark.schemas import VECTOR

KEYS = ["run_id", "epoch"]


def write_epoch_latents(latents: DataFrame, path: str) -> None:
    """Store ``run_id, epoch, position, z`` by run and epoch; the epoch of final latents is NULL.

    The rebalance hint gathers an epoch's rows in few files and lets adaptive execution split a large one.
    """
    latents.select(*KEYS, "position", "z").hint("rebalance", *KEYS).write.mode("append").partitionBy(*KEYS).parquet(path)


def read_epoch_latents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"position bigint, z {VECTOR.simpleString()}, run_id bigint, epoch int").parquet(path)


def choose_epochs(artifacts: DataFrame, which: str = "last", number: int | None = None) -> DataFrame:
    """``run_id, epoch`` of the latents to read: the ``last`` epoch with weights, the 1-based ``number`` for
    ``selection``, or NULL, the latents a run ended with, for ``final``. Only epochs with latents are chosen."""
    z = artifacts.filter(F.col("artifact") == "z")
    if which == "selection":
        chosen = z.filter(F.col("epoch") == number - 1)
    elif which == "final":
        chosen = z.filter(F.col("epoch").isNull())
    elif which == "last":
        last = last_epoch(artifacts.filter(F.col("artifact") == "weights")).select("run_id", F.col("last_epoch").alias("epoch"))
        chosen = z.join(last, KEYS, "left_semi")
    else:
        raise ValueError(f"unknown epoch choice: {which}")
    return chosen.select(*KEYS).distinct()


def epoch_latents(table: DataFrame, artifacts: DataFrame, which: str = "last", number: int | None = None) -> DataFrame:
    """Latents of every run's chosen epoch, as ``run_id, epoch, position, z``.

    The few chosen epochs are sent to all tasks and prune the folders before they are listed for reading: only the
    chosen epoch's files are opened. A selected or final epoch is pruned at planning.
    """
    chosen = choose_epochs(artifacts, which, number)
    rows = table.select(*KEYS, "position", "z")
    if which == "last":
        return rows.join(F.broadcast(chosen), KEYS, "left_semi")
    wanted = F.col("epoch").isNull() if which == "final" else F.col("epoch") == number - 1
    return rows.filter(wanted).join(F.broadcast(chosen.select("run_id")), "run_id", "left_semi")

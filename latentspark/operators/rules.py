"""Parameter and data checks. Every rule yields ``(run_id, level, rule, message)``
rows for what it finds wrong; no rows means valid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latentspark.operators.particles import missing_volumes as find_missing_volumes
from latentspark.operators.runs import last_epoch, resolve_runs, with_default


def _findings(df: DataFrame, condition: Column, level: str, rule: str, message) -> DataFrame:
    message = message if isinstance(message, Column) else F.lit(message)
    return df.filter(condition).select(
        F.col("run_id").cast("bigint").alias("run_id"), F.lit(level).alias("level"),
        F.lit(rule).alias("rule"), message.alias("message"))


def _target() -> Column:
    return F.when(F.col("do_scale"), F.col("scale_size")).otherwise(F.col("box"))


# Preprocessing: runs(run_id, box, do_scale, scale_size, has_alignment)

def upscaled_box(runs: DataFrame) -> DataFrame:
    return _findings(runs, F.col("do_scale") & (F.col("scale_size") > F.col("box")), "error",
                     "upscaled_box", "target box exceeds the input box")


def odd_box(runs: DataFrame) -> DataFrame:
    return _findings(runs, F.pmod(_target(), F.lit(2)) != 0, "error", "odd_box", "target box is odd")


def box_not_multiple_of_8(runs: DataFrame) -> DataFrame:
    return _findings(runs, F.pmod(_target(), F.lit(8)) != 0, "warning", "box_not_multiple_of_8",
                     "mixed precision needs a box that is a multiple of 8")


def unaligned_input(runs: DataFrame) -> DataFrame:
    """A warning when preprocessing, an error when training with given poses."""
    training = F.col("kind") == "train"
    found = runs.filter(~F.coalesce(F.col("has_alignment"), F.lit(False)))
    as_error = _findings(found, training, "error", "unaligned_input", "particles have no alignment")
    as_warning = _findings(found, F.col("kind") == "preprocess", "warning", "unaligned_input",
                           "without alignment the output only suits ab initio training")
    return as_error.unionByName(as_warning)


def non_positive_size(runs: DataFrame) -> DataFrame:
    z = _findings(runs, F.col("zdim") <= 0, "error", "non_positive_size", "latent dimension must be positive")
    box = _findings(runs, F.col("do_scale") & (F.col("scale_size") <= 0), "error", "non_positive_size",
                    "target box must be positive")
    return z.unionByName(box)


# Training: runs(run_id, kind, do_continue, continue_run, num_epochs, zdim, abinitio_type)

def broken_continuation(runs: DataFrame) -> DataFrame:
    previous = runs.select(
        F.col("run_id").alias("continue_run"), with_default("num_epochs").alias("_done"))
    continued = runs.filter("do_continue")
    unset = _findings(continued, F.col("continue_run").isNull(), "error", "broken_continuation",
                      "no run to continue is given")
    short = _findings(
        continued.join(previous, "continue_run"), with_default("num_epochs") <= F.col("_done"), "error",
        "broken_continuation",
        F.format_string("epochs must exceed the %d already done", F.col("_done")))
    return unset.unionByName(short)


def dimension_of_type(runs: DataFrame) -> DataFrame:
    fresh = runs.filter(~F.col("do_continue") & (F.col("kind") == "abinitio"))
    homo = _findings(fresh, (F.col("abinitio_type") == "homogeneous") & (with_default("zdim") > 1), "error",
                     "dimension_of_type", "homogeneous runs need latent dimension 1")
    het = _findings(fresh, (F.col("abinitio_type") == "heterogeneous") & (with_default("zdim") == 1), "error",
                    "dimension_of_type", "heterogeneous runs need latent dimension above 1")
    return homo.unionByName(het)


# Subset: stats(run_id, n_index, max_index), sets(run_id, size)

def index_too_long(stats: DataFrame, sets: DataFrame) -> DataFrame:
    return _findings(stats.join(sets, "run_id"), F.col("n_index") > F.col("size"), "error",
                     "index_too_long", "index list is longer than the set")


def index_out_of_range(stats: DataFrame, sets: DataFrame) -> DataFrame:
    return _findings(stats.join(sets, "run_id"), F.col("max_index") > F.col("size") - 1, "error",
                     "index_out_of_range", "index list points past the end of the set")


# Analysis: runs(run_id, epoch_choice, epoch_number, box, do_downsample, vol_box,
#                do_landscape, auto_mask, mask_box, ...)

def epoch_out_of_range(runs: DataFrame, artifacts: DataFrame) -> DataFrame:
    """The 1-based selected epoch must exist; a run without any weights has none to select."""
    selected = runs.filter(F.col("epoch_choice") == "selection").join(
        last_epoch(artifacts), "run_id", "left")
    bad = (F.col("last_epoch").isNull() | (F.col("epoch_number") < 1)
           | (F.col("epoch_number") - 1 > F.col("last_epoch")))
    text = F.when(F.col("last_epoch").isNull(), F.lit("run has no finished epoch")).otherwise(
        F.format_string("epoch must be within 1-%d", F.col("last_epoch") + 1))
    return _findings(selected, bad, "error", "epoch_out_of_range", text)


def upscaled_volume(runs: DataFrame) -> DataFrame:
    return _findings(runs, F.col("do_downsample") & (F.col("vol_box") > F.col("box")), "error",
                     "upscaled_volume", "volume box exceeds the particle box")


def mask_size_mismatch(runs: DataFrame) -> DataFrame:
    size = F.when(F.col("do_downsample"), F.col("vol_box")).otherwise(F.col("box"))
    return _findings(runs, F.col("do_landscape") & ~F.col("auto_mask") & (F.col("mask_box") != size),
                     "error", "mask_size_mismatch", "mask and volume boxes differ")


def mask_unset(runs: DataFrame) -> DataFrame:
    return _findings(runs, F.col("do_landscape") & ~F.col("auto_mask") & F.col("mask_box").isNull(),
                     "error", "mask_unset", "choose automatic masking or give a mask")


def homogeneous_analysis(runs: DataFrame) -> DataFrame:
    return _findings(
        resolve_runs(runs),
        (F.col("kind") == "abinitio") & (F.col("abinitio_type") == "homogeneous"), "error",
        "homogeneous_analysis", "homogeneous runs have no latent space to analyse")


def ignored_settings(runs: DataFrame) -> DataFrame:
    return _findings(
        resolve_runs(runs), ~F.coalesce(with_default("zdim") > 1, F.lit(False)), "warning",
        "ignored_settings",
        "one latent dimension: component, k-means, traversal and landscape settings are ignored")


def missing_volume_files(expected: DataFrame, found: DataFrame) -> DataFrame:
    return _findings(find_missing_volumes(expected, found), F.lit(True), "error",
                     "missing_volume_files", F.format_string("volume %d is missing", F.col("vol_id")))


def validate(*findings: DataFrame) -> DataFrame:
    """All findings of the given rules in one table."""
    return reduce(DataFrame.unionByName, findings)

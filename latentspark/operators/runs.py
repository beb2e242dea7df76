"""Runs, epochs and lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from latentspark.functions.scalars import clamp
from latentspark.schemas import LINEAGE
from latentspark.session import cut_lineage, has_rows
from latentspark.sources.log import TableLog

# Defaults of the run parameters, by kind of run.
DEFAULTS = {
    "train": {"zdim": 8, "num_epochs": 20},
    "abinitio": {"zdim": 8, "num_epochs": 30},
}
LANDSCAPE_MAX_COMPONENTS = 20
# End of fixed values.

# What a continued run takes over from the run it continues.
INHERITED = ("input_set", "zdim", "abinitio_type")


def resolve_runs(runs: DataFrame, *, transitive: bool = False) -> DataFrame:
    """Fill a continued run's inherited parameters from the run it continues.

    One hop by default; ``transitive`` follows the chain to its first run.
    ``resolved_run`` names the run the parameters came from.
    """
    columns = [c for c in INHERITED if c in runs.columns]
    pointer = F.when(F.col("do_continue"), F.col("continue_run"))
    roots = chain_roots(runs) if transitive else runs.select(
        "run_id", F.coalesce(pointer, F.col("run_id")).alias("resolved_run"))
    source = runs.select(
        F.col("run_id").alias("resolved_run"),
        F.lit(True).alias("_known"),
        *[F.col(c).alias(f"_{c}") for c in columns])
    joined = runs.join(roots, "run_id", "left").join(source, "resolved_run", "left")
    inherits = F.col("_known") & (F.col("resolved_run") != F.col("run_id"))
    filled = {c: F.when(inherits, F.col(f"_{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(filled).select(*runs.columns, "resolved_run")


def chain_roots(runs: DataFrame) -> DataFrame:
    """First run of every continuation chain, as ``(run_id, resolved_run)``.

    Every round doubles the distance a pointer spans, so a chain of length n
    takes about log2(n) joins. A chain that runs in a circle is an error.
    """
    pointers = runs.select(
        "run_id",
        F.coalesce(F.when(F.col("do_continue"), F.col("continue_run")), F.col("run_id"))
        .alias("resolved_run"))
    for _ in range(64):
        step = pointers.select(
            F.col("run_id").alias("resolved_run"), F.col("resolved_run").alias("_next"))
        moved = cut_lineage(
            pointers.join(step, "resolved_run", "left")
            .select("run_id", "resolved_run", F.coalesce("_next", "resolved_run").alias("_next")))
        pointers = moved.select("run_id", F.col("_next").alias("resolved_run"))
        if not has_rows(moved.filter(F.col("_next") != F.col("resolved_run"))):
            return pointers
    raise ValueError("continuation chain does not end")


def last_epoch(artifacts: DataFrame) -> DataFrame:
    """Highest epoch with a weights file per run; NULL for a run without one."""
    weights = F.when(F.col("artifact") == "weights", F.col("epoch"))
    return artifacts.groupBy("run_id").agg(F.max(weights).alias("last_epoch"))


def latest_artifact(artifacts: DataFrame) -> DataFrame:
    """The whole row of the highest weights epoch per run (last path on a repeat)."""
    weights = artifacts.filter((F.col("artifact") == "weights") & F.col("epoch").isNotNull())
    top = weights.groupBy(F.col("run_id").alias("_run")).agg(F.max("epoch").alias("_last"))
    last = weights.join(top, F.col("run_id").eqNullSafe(F.col("_run")) & (F.col("epoch") == F.col("_last")), "left_semi")
    # Only repeats of one epoch are gathered here; numbers and sets are aggregated by hash.
    return last.groupBy("run_id", "artifact", "epoch").agg(F.array_max(F.collect_set("path")).alias("path"))


def can_continue(artifacts: DataFrame) -> DataFrame:
    """Whether a run has any weights file to resume from."""
    return last_epoch(artifacts).select(
        "run_id", F.col("last_epoch").isNotNull().alias("can_continue"))


def select_epoch(artifacts: DataFrame, which: str = "last", number: int | None = None) -> DataFrame:
    """Artifact rows of the chosen epoch of every run.

    ``last`` takes each run's latest weights epoch. ``selection`` takes the
    1-based ``number``; that filter reaches the scan.
    """
    if which == "selection":
        return artifacts.filter(F.col("epoch") == number - 1)
    if which != "last":
        raise ValueError(f"unknown epoch choice: {which}")
    latest = last_epoch(artifacts).select("run_id", F.col("last_epoch").alias("epoch"))
    return artifacts.join(latest, ["run_id", "epoch"], "left_semi")


def volume_sampling(runs: DataFrame) -> DataFrame:
    """Pixel size of a run's output volumes."""
    scaled = F.col("box") / F.col("vol_box") * F.col("apix")
    return runs.withColumn(
        "vol_apix", F.when(F.col("do_downsample"), scaled).otherwise(F.col("apix")))


def has_multi_latent(runs: DataFrame) -> DataFrame:
    """Whether a run's latent space has more than one dimension, seen through a continued run."""
    return resolve_runs(runs).select(
        "run_id", F.coalesce(with_default("zdim") > 1, F.lit(False)).alias("multi_latent"))


def landscape_dim(volumes: DataFrame) -> DataFrame:
    """Components of the volume PCA: the number of volumes, 20 at most."""
    return volumes.agg(
        clamp(F.count("*"), LANDSCAPE_MAX_COMPONENTS).cast("int").alias("pc_dim"))


def with_default(name: str) -> Column:
    """A run's parameter, or the default of the run's kind where it is unset."""
    pairs = [F.lit(v) for kind, d in DEFAULTS.items() for v in (kind, d[name])]
    return F.coalesce(F.col(name), F.try_element_at(F.create_map(*pairs), F.col("kind")))


def effective_params(runs: DataFrame) -> DataFrame:
    """Run parameters with the defaults of the run's kind filled in."""
    return runs.withColumns({name: with_default(name) for name in ("zdim", "num_epochs")})


def run_summary(runs: DataFrame) -> DataFrame:
    """One line per training run; an ab initio run that continues another reports that run's type."""
    resolved = effective_params(resolve_runs(runs)).filter(F.col("kind").isin(*DEFAULTS))
    text = F.when(
        F.col("kind") == "abinitio",
        F.format_string("Ab initio training (%s), %d epochs", F.col("abinitio_type"), F.col("num_epochs")),
    ).otherwise(F.format_string("Training, %d epochs", F.col("num_epochs")))
    return resolved.select("run_id", text.alias("summary"))


def record_lineage(lineage: DataFrame, edges: DataFrame) -> DataFrame:
    """Append ``(child, parent, kind)`` edges; kind is ``source`` or ``transform``."""
    checked = F.when(F.col("kind").isin("source", "transform"), F.col("kind")).otherwise(
        F.raise_error(F.concat(F.lit("unknown lineage kind: "), F.col("kind"))))
    return lineage.unionByName(edges.select("child", "parent", checked.alias("kind")))


def lineage_log(spark: SparkSession, path: str) -> TableLog:
    """The stored lineage: edges ``child, parent, kind`` that jobs append."""
    return TableLog(spark, path, LINEAGE)


def store_lineage(log: TableLog, edges: DataFrame, key: str) -> bool:
    """Append checked edges; a job that runs again under its key adds nothing."""
    empty = log.spark.createDataFrame([], LINEAGE)
    return log.append(record_lineage(empty, edges), key)


def ancestors(lineage: DataFrame, of: DataFrame | None = None, *, every: bool = False) -> DataFrame:
    """All data sets a set derives from, with the shortest number of edges.

    ``of`` holds the ids asked about in ``child``. The closure of every set grows
    with sets times depth, so it is made only when ``every`` asks for it. Each round joins only the pairs found in the round before with the
    edges, and stops when a round finds nothing new, so circles end too.
    """
    if of is None and not every:
        raise ValueError("name the sets in of, or ask for every set")
    edges = lineage.select("child", "parent").distinct()
    reached = edges if of is None else edges.join(
        of.select("child").distinct(), "child", "left_semi")
    frontier = cut_lineage(reached.select(
        "child", F.col("parent").alias("ancestor"), F.lit(1).alias("depth")))
    found = frontier
    depth = 1
    step = edges.select(F.col("child").alias("ancestor"), F.col("parent").alias("_up"))
    while has_rows(frontier):
        depth += 1
        further = frontier.join(step, "ancestor").select(
            "child", F.col("_up").alias("ancestor"), F.lit(depth).alias("depth")).distinct()
        frontier = cut_lineage(further.join(found, ["child", "ancestor"], "left_anti"))
        found = found.unionByName(frontier)
    return found

"""The five jobs as compositions of operators: preprocess, train output, ab initio
output, subset, analyze. With ``origin`` a job appends what its output was made from to the stored lineage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from latentspark.functions import names
from latentspark.functions.scalars import numbered_name
from latentspark.operators import centres, components, particles, position, rules, runs, traversal
from latentspark.operators.images import downsample_images
from latentspark.operators.landscape import Landscape, landscape
from latentspark.operators.neighbours import neighbour_graph
from latentspark.session import cut_lineage, has_rows
from latentspark.sources import tables, text
from latentspark.sources.epochs import epoch_latents
from latentspark.sources.log import TableLog


@dataclass(frozen=True)
class Origin:
    """Where a job's output comes from: the lineage to append to, the output's set and the input's."""

    lineage: TableLog
    child: int
    parent: int

    def record(self, kind: str) -> None:
        spark = self.lineage.spark
        edge = spark.createDataFrame([(self.child, self.parent, kind)], "child bigint, parent bigint, kind string")
        runs.store_lineage(self.lineage, edge, f"{kind}:{self.child}:{self.parent}")


def preprocess(
    table: DataFrame, old_box: int, *, do_scale: bool = True, size: int = 128, chunk: int = 0,
    image: str | None = None, origin: Origin | None = None,
) -> DataFrame:
    """Rescaled particles with their new stack layout, in one narrow pass over rows
    that already have positions. ``image`` names an array column to downsample too."""
    new_box = size if do_scale else old_box
    out = position.stack_location(table, new_box, chunk)
    out = particles.rescale_coords(out, old_box, new_box)
    out = particles.rescale_shifts(out, old_box, new_box)
    if "apix" in out.columns:
        out = particles.rescale_sampling(out, old_box, new_box)
    if "box" in out.columns:
        out = particles.copy_with(out, box=F.lit(new_box))
    if origin:
        origin.record("transform")
    return out if image is None or new_box == old_box else downsample_images(out, new_box, image)


def train_output(
    table: DataFrame, latents: DataFrame, prog: str, *, weights: str, config: str, strict: bool = False,
    origin: Origin | None = None,
) -> DataFrame:
    """Particles with their latent vectors, tagged with the program and its files."""
    joined = particles.attach_latents(table, latents, strict=strict)
    if origin:
        origin.record("source")
    return particles.with_attrs(
        particles.tag_flex(joined, prog), {"weights": weights, "config": config})


def abinitio_volume(output_dir: str, apix: float, table: DataFrame) -> DataFrame:
    """The one volume of a homogeneous ab initio run, at the particles' pixel size."""
    return table.sparkSession.createDataFrame(
        [(0, f"{output_dir}/reconstruct.mrc", float(apix))], "vol_id int, file string, apix double")


def check_index(table: DataFrame, index: DataFrame) -> DataFrame:
    """Findings on an index list that is longer than the set, or points past its end."""
    one = F.lit(0).cast("bigint").alias("run_id")
    stats = particles.index_stats(index).select(one, "n_index", "max_index")
    size = table.agg(F.count("*").alias("size")).select(one, "size")
    return rules.validate(rules.index_too_long(stats, size), rules.index_out_of_range(stats, size))


def subset_particles(
    table: DataFrame, index: DataFrame, key: str | None = None, *, strict: bool = False, origin: Origin | None = None
) -> DataFrame:
    """Particles in the index list. ``strict`` refuses a list that does not fit the set."""
    if strict:
        _refuse(check_index(table, index))
    out = particles.subset(position.ensure_position(table, key), index)
    if origin:
        origin.record("transform")
    return out


def _refuse(findings: DataFrame) -> None:
    """Raise if there are errors; the rules name a handful of kinds at most per run."""
    errors = sorted({r["message"] for r in findings.filter(F.col("level") == "error").select("message").distinct().limit(100).collect()})
    if errors:
        raise ValueError("; ".join(errors))


@dataclass(frozen=True)
class Analysis:
    axes: components.Axes | None
    projected: DataFrame | None
    traversal: DataFrame
    centres: DataFrame
    centre_particles: DataFrame
    volumes: DataFrame
    graph_path: DataFrame | None = None
    landscape: Landscape | None = None


def analyze(
    latents: DataFrame, zdim: int, *, epoch: int = 0, pc: int = 2, k: int = 20, seed: int = 1,
    do_graph_traversal: bool = False, neighbours: int = 10, do_landscape: bool = False, **landscape_options
) -> Analysis:
    """Components, traversals, k-means centres and volume points of one epoch.

    With one latent dimension, only the ten points along it are made; graph
    traversal and landscape are skipped. The latent table is cached, to disk where
    memory is short, and left cached for the frames returned here.
    """
    latents = latents.select("position", "z").persist(StorageLevel.MEMORY_AND_DISK)
    folder = names.ANALYSIS_DIR % epoch
    if zdim <= 1:
        line = components.z_traversal(latents)
        points = line.select(F.col("step").alias("centre_id"), "z")
        file = numbered_name(f"{folder}/{names.VOLUME_FILE}", F.col("centre_id"))
        return Analysis(None, None, line, points, centres.centre_particles(latents, points),
                        _volumes(points, file))
    axes = components.pca(latents, pc)
    points = centres.kmeans(latents, k, seed)
    anchors = cut_lineage(centres.centre_particles(latents, points))
    file = numbered_name(f"{folder}/{names.KMEANS_VOLUME_FILE}", F.lit(k), F.col("centre_id"))
    path = None
    if do_graph_traversal:
        graph = cut_lineage(neighbour_graph(latents, neighbours))
        path = traversal.graph_traversal(graph, anchors.select("centre_id", "position"))
    states = landscape(latents, seed=seed, **landscape_options) if do_landscape else None
    return Analysis(axes, components.project(latents, axes), components.pc_traversal(latents, axes),
                    points, anchors, _volumes(points, file), path, states)


def _volumes(points: DataFrame, file) -> DataFrame:
    return points.select(F.col("centre_id").alias("vol_id"), file.alias("file"), "z")


@dataclass(frozen=True)
class Published:
    """What an analysis of a run left behind."""

    analysis: Analysis
    folder: str
    volumes: DataFrame
    warnings: DataFrame


def analyze_run(
    table: DataFrame, run_id: int, artifacts: DataFrame, latents: DataFrame, found: DataFrame, out: str, *,
    which: str | None = None, k: int = 20, set_id: int | None = None, lineage: TableLog | None = None, **options
) -> Published:
    """Check a run, analyse its latents of the chosen epoch, and publish the volume set.

    ``table`` has all runs, ``latents`` the stored latents of runs and epochs, ``found`` the volume files there are as
    ``run_id, vol_id``. The epoch is the run's own choice, or ``which``: ``last``, ``selection`` or ``final``. Errors
    of the rules and missing volumes raise before anything is written. The points are written as z text and read
    back, paired with the volumes, and replace the volume set in one commit, at the pixel size of the run's
    volumes. The lineage gets the set and the run's input; the same analysis done again adds nothing.
    """
    spark, mine = table.sparkSession, F.col("run_id") == run_id
    findings = rules.validate(
        rules.epoch_out_of_range(table, artifacts), rules.upscaled_volume(table), rules.mask_size_mismatch(table),
        rules.mask_unset(table), rules.homogeneous_analysis(table), rules.ignored_settings(table)).filter(mine)
    _refuse(findings)
    run = runs.volume_sampling(runs.effective_params(runs.resolve_runs(table))).filter(mine).first()
    if run is None:
        raise ValueError(f"there is no run {run_id}")
    which, own = which or run["epoch_choice"], artifacts.filter(mine)
    rows = cut_lineage(epoch_latents(latents, own, which, run["epoch_number"]).filter(mine))
    epoch = rows.agg(F.max("epoch")).first()[0]
    if epoch is None:  # final latents belong to the last epoch
        epoch = runs.last_epoch(own).first()["last_epoch"]
    found_here = analyze(rows.select("position", "z"), run["zdim"], epoch=epoch or 0, k=k, **options)
    volumes = cut_lineage(found_here.volumes)
    expected = volumes.agg(F.count("*").alias("n")).select(F.lit(run_id).cast("bigint").alias("run_id"), "n")
    missing = particles.missing_volumes(expected, found.filter(mine))
    _refuse(rules.missing_volume_files(expected, found.filter(mine)) if has_rows(missing) else findings.limit(0))
    folder = f"{out.rstrip('/')}/{names.ANALYSIS_DIR % (epoch or 0)}"
    text.write_z_text(volumes.select(F.col("vol_id").alias("position"), "z"), f"{folder}/z_values")
    z_rows = text.read_z_text(spark, f"{folder}/z_values").select(F.col("position").cast("int").alias("vol_id"), "z")
    paired = particles.pair_volumes(volumes.select("vol_id", "file"), z_rows)
    key = f"analysis:{run_id}:{epoch}:{which}:{set_id}"
    tables.write_volume_set(paired.select("vol_id", "file", "z"), f"{folder}/volumes", run["vol_apix"], key=key)
    if lineage is not None:
        Origin(lineage, set_id, run["input_set"]).record("source")
    return Published(found_here, folder, tables.read_volume_set(spark, f"{folder}/volumes"),
                     findings.filter(F.col("level") == "warning"))

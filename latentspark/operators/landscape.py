"""Conformational landscape: states of a sketch and the particles behind them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latentspark.operators import centres, hierarchy, voxels
from latentspark.operators.runs import LANDSCAPE_MAX_COMPONENTS
from latentspark.session import broadcast_if_small, cut_lineage


@dataclass(frozen=True)
class Landscape:
    sketch: DataFrame
    states: DataFrame
    particle_states: DataFrame
    particle_counts: DataFrame
    volume_counts: DataFrame


def sketch_features(volume_rows: DataFrame, *, threshold: float = 0.0, dilate: int = 5, box: int,
                    mask: DataFrame | None = None) -> DataFrame:
    """Component scores of the sketch volumes as vectors ``(centre_id, z)``, within a
    given mask or an automatic one."""
    if mask is None:
        mask = voxels.dilate_mask(voxels.threshold_mask(volume_rows, threshold), dilate, box)
    scores = voxels.volume_pca(volume_rows, cut_lineage(mask), LANDSCAPE_MAX_COMPONENTS)
    ordered = F.sort_array(F.collect_list(F.struct("component", "score")))
    return scores.groupBy(F.col("vol_id").alias("centre_id")).agg(ordered.alias("s")).select(
        "centre_id", F.col("s.score").alias("z"))


def landscape(
    latents: DataFrame,
    *,
    n: int = 500,
    m: int = 10,
    linkage: str = "ward",
    sketch: DataFrame | None = None,
    volume_rows: DataFrame | None = None,
    box: int | None = None,
    mask: DataFrame | None = None,
    threshold: float = 0.0,
    dilate: int = 5,
    seed: int = 1,
) -> Landscape:
    """Sketch the latent space, cluster the sketch into states, count particles and
    volumes per state.

    With voxel rows of the sketch volumes (``vol_id`` = ``centre_id``) the states
    come from masked volume components, else from the sketch points themselves.
    """
    sketch = centres.sketch(latents, n, seed) if sketch is None else sketch
    features = sketch.select("centre_id", "z") if volume_rows is None else sketch_features(
        volume_rows, threshold=threshold, dilate=dilate, box=box, mask=mask)
    states = hierarchy.agglomerate(features, linkage, m)
    assigned = centres.assign_nearest(latents, sketch)
    by_particle = centres.particle_states(assigned, states)
    return Landscape(sketch, states, by_particle, centres.state_particle_counts(by_particle),
                     centres.state_volume_counts(states))


def states_on_embedding(sketch_particles: DataFrame, states: DataFrame, embedding: DataFrame) -> DataFrame:
    """Sketch points with state and 2-D position, ``(centre_id, position, state, u, v)``."""
    marked = broadcast_if_small(sketch_particles.select("centre_id", "position").join(
        states.select("centre_id", "state"), "centre_id"))
    return embedding.select("position", "u", "v").join(marked, "position").select(
        "centre_id", "position", "state", "u", "v")


def state_labels(on_embedding: DataFrame) -> DataFrame:
    """Where to write each state's label: the mean of its points."""
    return on_embedding.groupBy("state").agg(F.avg("u").alias("u"), F.avg("v").alias("v"))

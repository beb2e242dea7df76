"""Principal components of the latent space and views along them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from latentspark.functions.vectors import dot, literal_vector
from latentspark.operators.centres import centre_particles, kmeans
from latentspark.operators.density import quantiles, quantiles_of
from latentspark.session import broadcast_if_small


@dataclass(frozen=True)
class Axes:
    """Mean and orthonormal axes (one per row); small, so kept on the driver."""

    mean: tuple[float, ...]
    axes: tuple[tuple[float, ...], ...]
    explained: tuple[float, ...] = ()

    def offset(self, component: int) -> float:
        return float(np.dot(self.mean, self.axes[component]))

    def to_df(self, spark) -> DataFrame:
        rows = [(i, d, v, self.explained[i] if self.explained else None)
                for i, axis in enumerate(self.axes) for d, v in enumerate(axis)]
        return spark.createDataFrame(rows, "component int, dim int, loading double, explained double")


def pca(latents: DataFrame, k: int = 2) -> Axes:
    """Top ``k`` principal axes by MLlib. The largest loading of an axis is positive."""
    vectors = latents.select(array_to_vector("z").alias("features"))
    mean = vectors.select(Summarizer.mean(F.col("features")).alias("m")).first()["m"].toArray()
    model = PCA(k=min(k, len(mean)), inputCol="features", outputCol="out").fit(vectors)
    axes = model.pc.toArray().T
    signs = np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])
    axes = axes * np.where(signs == 0, 1.0, signs)[:, None]
    return Axes(tuple(map(float, mean)), tuple(tuple(map(float, a)) for a in axes),
                tuple(map(float, model.explainedVariance.toArray())))


def project(latents: DataFrame, model: Axes) -> DataFrame:
    """Coordinates ``pc0, pc1, …`` of every particle on the model's axes."""
    columns = [
        (dot(F.col("z"), literal_vector(axis)) - F.lit(model.offset(i))).alias(f"pc{i}")
        for i, axis in enumerate(model.axes)
    ]
    return latents.select("position", *columns)


def equal_steps(low: float, high: float, n: int) -> list[float]:
    return [low + (high - low) * i / (n - 1) for i in range(n)] if n > 1 else [low]


def pc_traversal(
    latents: DataFrame, model: Axes, n: int = 10, *, qs: Sequence[float] = (0.01, 0.99)
) -> DataFrame:
    """``n`` equally spaced points along each axis between the 1st and 99th
    percentile of the projections, with the particle nearest to each, as
    ``(component, step, t, z, position, dist)``."""
    projected = project(latents, model)
    mean = np.array(model.mean)
    rows = []
    found = quantiles_of(projected, [f"pc{i}" for i in range(len(model.axes))], qs)
    for i, axis in enumerate(model.axes):
        for step, t in enumerate(equal_steps(*found[f"pc{i}"], n)):
            z = mean + t * np.array(axis)
            rows.append((len(rows), i, step, float(t), [float(v) for v in z]))
    return _with_nearest(latents, rows)


def z_traversal(latents: DataFrame, n: int = 10, *, qs: Sequence[float] = (0.01, 0.99)) -> DataFrame:
    """The same along the coordinate itself when the latent space has one dimension."""
    ends = quantiles(latents.select(F.get("z", F.lit(0)).alias("v")), "v", qs)
    rows = [(i, 0, i, float(t), [float(t)]) for i, t in enumerate(equal_steps(*ends, n))]
    return _with_nearest(latents, rows)


def _with_nearest(latents: DataFrame, rows: list[tuple]) -> DataFrame:
    points = latents.sparkSession.createDataFrame(
        rows, "centre_id int, component int, step int, t double, z array<double>")
    nearest = centre_particles(latents, points.select("centre_id", "z")).select(
        "centre_id", "position", "dist")
    return broadcast_if_small(points).join(nearest, "centre_id").select(
        "component", "step", "t", "z", "position", "dist")


def volume_points(latents: DataFrame, zdim: int, k: int, n: int = 10, seed: int = 1) -> DataFrame:
    """Points to make volumes of: k-means centres for several latent dimensions,
    else the equally spaced points of the single one, as ``(vol_id, z)``."""
    if zdim > 1:
        return kmeans(latents, k, seed).select(F.col("centre_id").alias("vol_id"), "z")
    return z_traversal(latents, n).select(F.col("step").alias("vol_id"), "z")


def embedding_with_pc(embedding: DataFrame, projected: DataFrame) -> DataFrame:
    """2-D point and component values of every particle."""
    return embedding.join(projected, "position")


def traversal_on_embedding(embedding: DataFrame, traversal: DataFrame) -> DataFrame:
    """Segments ``(component, step, u, v, next_u, next_v)`` that connect a
    traversal's nearest particles on the embedding; the last has no end."""
    order = Window.partitionBy("component").orderBy("step")
    marked = embedding.select("position", "u", "v").join(
        broadcast_if_small(traversal.select("component", "step", "position")), "position")
    return marked.select(
        "component", "step", "u", "v",
        F.lead("u").over(order).alias("next_u"), F.lead("v").over(order).alias("next_v"))

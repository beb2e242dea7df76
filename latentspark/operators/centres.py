"""Centres of the latent space: assignment, k-means, sketch, states."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from latentspark.functions.matrices import from_matrix, nearest_k, to_matrix
from latentspark.functions.search import Best, Sent, Tree, gathered
from latentspark.functions.vectors import literal_vector, squared_distance
from latentspark.schemas import CENTRES
from latentspark.session import broadcast_if_small, cut_lineage

# Bytes of centres that are sent to every task at a time.
MAX_CENTRE_BYTES = 64 * 1024 * 1024
# Expected rows of a coreset: at least this many, and this many for each centre.
CORESET_ROWS = 50_000
CORESET_ROWS_PER_CENTRE = 200


@dataclass(frozen=True)
class CentreTable:
    """Centres on the driver: a whole table, or one block of it, within ``MAX_CENTRE_BYTES``."""

    ids: np.ndarray
    z: np.ndarray

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(int(i), [float(v) for v in z]) for i, z in zip(self.ids, self.z)]
        return spark.createDataFrame(rows, CENTRES)


def store_centres(centres: DataFrame) -> tuple[DataFrame, int]:
    """The centres as a written table, and the number of blocks that fit ``MAX_CENTRE_BYTES``.

    Several blocks are planned at half that size, as ids are spread by hash.
    """
    stored = cut_lineage(centres.select("centre_id", "z"))
    size = 8 * (stored.agg(F.sum(F.size("z"))).first()[0] or 0)
    return stored, -(-size // MAX_CENTRE_BYTES) if size <= MAX_CENTRE_BYTES else -(-2 * size // MAX_CENTRE_BYTES)


def centre_blocks(centres: DataFrame) -> Iterator[CentreTable]:
    """The centres block by block; one block at a time is on the driver."""
    stored, blocks = store_centres(centres)
    for block in range(blocks):
        part = stored.where(F.pmod(F.xxhash64("centre_id"), F.lit(blocks)) == block)
        rows = part.orderBy("centre_id").collect()
        if rows:
            yield CentreTable(np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows]))


def assign_nearest(latents: DataFrame, centres: DataFrame) -> DataFrame:
    """Nearest centre of each particle as ``(position, centre_id, dist)``; ties go
    to the lowest centre id.

    Centres go to every task as trees of boxes, a larger table block by block, so a particle
    is compared with the centres near it only; the particles are not shuffled.
    """
    return _assigned(latents, centre_blocks(centres))


def _assigned(latents: DataFrame, tables: Iterator[CentreTable]) -> DataFrame:
    trees = Sent(latents.sparkSession, (Tree(table.z, table.ids) for table in tables))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered(batches):
            z, best = to_matrix(part["z"]), Best(part.num_rows, 1)
            for tree in trees:
                tree.search(z, best)
            rows, centre, dist = best.found()
            yield from pa.table({
                "position": part["position"].take(pa.array(rows)), "centre_id": pa.array(centre, pa.int32()),
                "dist": dist}).to_batches()

    return latents.select("position", "z").mapInArrow(
        assign, "position bigint, centre_id int, dist double")


def centre_particles(latents: DataFrame, centres: DataFrame) -> DataFrame:
    """Particle nearest to each centre as ``(centre_id, position, dist, z)``; ties go
    to the lowest position. Every task reports one row per centre at most; a large
    table is taken block by block."""
    partial = latents.sparkSession.createDataFrame(
        [], "centre_id int, position bigint, dist double, z array<double>")
    for table in centre_blocks(centres):
        partial = partial.union(_closest(latents, table))
    nearest = F.min_by(F.struct("position", "dist", "z"), F.struct("dist", "position"))
    return partial.groupBy("centre_id").agg(nearest.alias("n")).select(
        "centre_id", "n.position", "n.dist", "n.z")


def _closest(latents: DataFrame, table: CentreTable) -> DataFrame:
    """Of each partition the particle nearest to each centre."""
    ids, z = table.ids, table.z

    def best_of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, position = to_matrix(batch.column("z")), batch.column("position").to_numpy()
            for rows, row_position, dist in nearest_k(z, x, position, 1):
                for row, p, d in zip(rows.tolist(), row_position.tolist(), dist.tolist()):
                    if row not in best or (d, p) < best[row][:2]:
                        best[row] = (d, p, x[int(np.flatnonzero(position == p)[0])])
        if best:
            rows = sorted(best)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[rows], pa.int32()),
                 pa.array([best[r][1] for r in rows], pa.int64()),
                 pa.array([best[r][0] for r in rows], pa.float64()),
                 from_matrix(np.array([best[r][2] for r in rows]))],
                names=["centre_id", "position", "dist", "z"])

    return latents.select("position", "z").mapInArrow(
        best_of_partition, "centre_id int, position bigint, dist double, z array<double>")


def spaced_seeds(latents: DataFrame, k: int) -> DataFrame:
    """Seed centres at the positions ``floor(i * n / k)``, as ``(centre_id, z)``.

    With fewer than ``k`` rows every row is a seed.
    """
    n = latents.count()
    k = min(k, n)
    places = {i * n // k: i for i in range(k)}
    number = F.create_map(*[
        c for p, i in places.items() for c in (F.lit(p).cast("bigint"), F.lit(i))])
    return latents.filter(F.col("position").isin(*places)).select(
        number[F.col("position")].alias("centre_id"), "z")


def kmeans_lloyd(latents: DataFrame, seeds: DataFrame, rounds: int) -> DataFrame:
    """Centres after a fixed number of assign-and-average rounds.

    Each task adds up its own rows per centre, so one row per centre and task is
    shuffled whatever the cluster sizes. A centre without particles stays put. Centres
    that are too many for one block stay a table. Rows count by their ``weight`` if
    there is such a column.
    """
    spark = latents.sparkSession
    if "weight" not in latents.columns:
        latents = latents.withColumn("weight", F.lit(1.0))
    stored, blocks = store_centres(seeds)
    if blocks > 1:
        for _ in range(rounds):
            stored = cut_lineage(_lloyd_table(latents, stored))
        return stored
    table = next(centre_blocks(stored), None)
    if table is None:
        raise ValueError("no seeds")
    kept = latents.select("z", "weight").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for _ in range(rounds):
            table = _lloyd_round(kept, table)
    finally:
        kept.unpersist()
    return table.to_df(spark)


def _lloyd_table(latents: DataFrame, centres: DataFrame) -> DataFrame:
    """One round with the centres as a table; sums are added up before the shuffle."""
    near = _assigned(latents, centre_blocks(centres)).select("position", "centre_id").join(
        latents.select("position", "z", "weight"), "position")
    means = near.select("centre_id", "weight", F.posexplode("z").alias("i", "v")).groupBy("centre_id", "i").agg(
        (F.sum(F.col("weight") * F.col("v")) / F.sum("weight")).alias("mean"))
    moved = means.groupBy("centre_id").agg(F.sort_array(F.collect_list(F.struct("i", "mean"))).alias("m"))
    return centres.join(moved, "centre_id", "left").select("centre_id", F.coalesce("m.mean", "z").alias("z"))


def _lloyd_round(latents: DataFrame, table: CentreTable) -> CentreTable:
    z = table.z
    index = np.arange(len(z))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(z.shape), np.zeros(len(z))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, weight = to_matrix(batch.column("z")), batch.column("weight").to_numpy()
            for rows, centre, _ in nearest_k(x, z, index, 1):
                count += np.bincount(centre, weight[rows], len(z))
                for d in range(z.shape[1]):
                    total[:, d] += np.bincount(centre, weight[rows] * x[rows, d], len(z))
        used = np.flatnonzero(count)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array(count[used]), from_matrix(total[used])],
                names=["c", "n", "s"])

    partial = latents.mapInArrow(add_up, "c int, n double, s array<double>")
    means = partial.select("c", "n", F.posexplode("s").alias("i", "v")).groupBy("c", "i").agg(
        (F.sum("v") / F.sum("n")).alias("mean"))
    moved, found = z.copy(), means.toArrow()  # as many numbers as the centres have
    moved[found["c"].to_numpy(), found["i"].to_numpy()] = found["mean"].to_numpy()
    return CentreTable(table.ids, moved)


def kmeans(latents: DataFrame, k: int = 20, seed: int = 1, max_rounds: int = 20) -> DataFrame:
    """MLlib k-means (k-means|| start), ``max_rounds`` rounds at most; centres numbered in coordinate order.

    Rows count by their ``weight`` if there is such a column.
    """
    weight = ["weight"] if "weight" in latents.columns else []
    prepared = latents.select(array_to_vector("z").alias("features"), *weight)
    model = KMeans(k=k, seed=seed, maxIter=max_rounds, **({"weightCol": "weight"} if weight else {})).fit(prepared)
    centres = sorted(tuple(float(v) for v in c) for c in model.clusterCenters())
    return latents.sparkSession.createDataFrame(
        [(i, list(c)) for i, c in enumerate(centres)], CENTRES)


def coreset(latents: DataFrame, size: int, seed: int = 1) -> DataFrame:
    """A weighted sample ``(position, z, weight)`` of about ``size`` rows that stands for all rows in k-means.

    A row is kept with a probability that is half even and half by its squared distance from
    the mean, up to 1, and weighs the inverse, so weighted sums are unbiased for any
    centres. The draw is a hash of ``seed`` and ``position``: a task run again keeps the same
    rows. One pass finds mean and spread, one filters; nothing is shuffled. Positions must be
    unique and vectors finite. Without rows the sample is empty; equal vectors are drawn evenly;
    if ``size`` is twice the table's rows or more, every row stays and weighs 1.
    """
    latents = latents.select("position", "z")
    if latents.isEmpty():
        return latents.withColumn("weight", F.lit(1.0))
    found = latents.select(Summarizer.metrics("count", "mean", "variance").summary(
        array_to_vector("z")).alias("s")).first()["s"]
    n, spread = found["count"], float(found["variance"].toArray().sum()) * (found["count"] - 1)
    share = F.lit(0.5 / n) if spread == 0 else (
        F.lit(0.5 / n) + 0.5 * squared_distance(F.col("z"), literal_vector(found["mean"].toArray())) / spread)
    chance = F.least(F.lit(1.0), F.lit(float(size)) * share)
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("position").cast("string")))
    draw = F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(2 ** 48)
    return latents.withColumn("weight", 1.0 / chance).filter(draw * F.col("weight") < 1.0)


def sketch(latents: DataFrame, n: int = 500, seed: int = 1, size: int | None = None) -> DataFrame:
    """Representative points of the latent space: ``n`` k-means centres of a weighted coreset.

    The coreset has about ``size`` rows, by default ``CORESET_ROWS`` or, if more,
    ``CORESET_ROWS_PER_CENTRE`` for each centre; the rounds of k-means read only that.
    """
    size = size or max(CORESET_ROWS, CORESET_ROWS_PER_CENTRE * n)
    return kmeans(cut_lineage(coreset(latents, size, seed)), n, seed)


def particle_states(assigned: DataFrame, states: DataFrame) -> DataFrame:
    """State of each particle through the sketch point it is assigned to."""
    return assigned.join(
        broadcast_if_small(states.select("centre_id", "state")), "centre_id"
    ).select("position", "centre_id", "state")


def state_particle_counts(particle_state: DataFrame) -> DataFrame:
    return particle_state.groupBy("state").agg(F.count("*").alias("particles"))


def state_volume_counts(states: DataFrame) -> DataFrame:
    return states.groupBy("state").agg(F.count("*").alias("volumes"))

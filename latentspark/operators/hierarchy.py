"""Agglomerative clustering of a sketch of the latent space."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latentspark.operators.position import with_position
from latentspark.session import BROADCAST_BYTES, broadcast_if_small, cut_lineage, has_rows

# A sketch is a few hundred points by default: so many are clustered with their vectors at every task, and the state
# of a round at the driver. More points keep their state in tables.
LOCAL_POINTS = 20_000


def merge_tree(points: DataFrame, linkage: str = "average") -> DataFrame:
    """Merges ``(a, b, height)`` of the Euclidean cluster tree of ``(centre_id, z)``.

    A cluster is named by its lowest point id, and ``a < b`` is the name that
    stays. Under ``average`` and ``ward`` a merge never brings a cluster closer to
    a third one than both parts were, so all pairs that are each other's nearest
    can merge in the same round. Tasks search the nearest cluster of the clusters
    whose surroundings changed; the pair distances are never stored.
    """
    if points.count() > LOCAL_POINTS:
        return _merge_tables(points, linkage)
    rows, merges = _merge(points, linkage)
    ids = [r["centre_id"] for r in rows]
    return points.sparkSession.createDataFrame(
        [(ids[a], ids[b], h) for a, b, h in merges], "a int, b int, height double")


def agglomerate(points: DataFrame, linkage: str = "average", m: int = 10) -> DataFrame:
    """``m`` clusters of the sketch ``(centre_id, z)`` as ``(centre_id, state)``.

    The lowest merges are kept until ``m`` clusters are left; states are numbered
    by their lowest point id.
    """
    n = points.count()
    if n > LOCAL_POINTS:
        return _states(points, _merge_tables(points, linkage), n, m)
    rows, merges = _merge(points, linkage)
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for a, b, _ in sorted(merges, key=lambda t: (t[2], t[0], t[1]))[:max(0, len(rows) - m)]:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    roots = [find(i) for i in range(len(rows))]
    number = {r: s for s, r in enumerate(sorted(set(roots)))}
    return points.sparkSession.createDataFrame(
        [(r["centre_id"], number[c]) for r, c in zip(rows, roots)], "centre_id int, state int")


def _merge(points: DataFrame, linkage: str):
    if linkage not in ("average", "ward"):
        raise ValueError(f"unknown linkage: {linkage}")
    rows = points.select("centre_id", "z").orderBy("centre_id").collect()
    spark = points.sparkSession
    z = spark.sparkContext.broadcast(np.array([r["z"] for r in rows], dtype=float).reshape(len(rows), -1))
    label = np.arange(len(rows))
    stale = list(range(len(rows)))
    nearest: dict[int, tuple[int, float]] = {}
    merges: list[tuple[int, int, float]] = []
    while len(merges) < len(rows) - 1:
        for a, b, d in _nearest_clusters(spark, z, label, stale, linkage):
            nearest[a] = (b, d)
        pairs = [(a, b, d) for a, (b, d) in nearest.items() if a < b and nearest[b][0] == a]
        if not pairs:  # rounding can leave equal distances without a mutual pair
            d, a, b = min((d, min(a, b), max(a, b)) for a, (b, d) in nearest.items())
            pairs = [(a, b, d)]
        merges += pairs
        gone = {b: a for a, b, _ in pairs}
        label = np.array([gone.get(c, c) for c in label.tolist()])
        for b in gone:
            del nearest[b]
        kept = set(gone.values())
        stale = [a for a, (b, _) in nearest.items() if a in kept or b in gone or b in kept]
    z.unpersist()
    return rows, merges


def _nearest_clusters(spark, z, label: np.ndarray, clusters: list[int], linkage: str) -> list:
    """Nearest other cluster of each given cluster; one task handles a share of them."""
    wanted = np.array(clusters)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = z.value
        names, member_of, size = np.unique(label, return_inverse=True, return_counts=True)
        if linkage == "ward":
            centre = np.zeros((len(names), x.shape[1]))
            np.add.at(centre, member_of, x)
            centre /= size[:, None]
        for batch in batches:
            found = []
            for cluster in wanted[batch.column(0).to_numpy()].tolist():
                own = int(np.searchsorted(names, cluster))
                if linkage == "ward":
                    far = ((centre - centre[own]) ** 2).sum(axis=1)
                    far = np.sqrt(2.0 * far * size * size[own] / (size + size[own]))
                else:
                    total = np.zeros(len(names))
                    for point in x[member_of == own]:
                        apart = np.sqrt(((x - point) ** 2).sum(axis=1))
                        total += np.bincount(member_of, apart, len(names))
                    far = total / (size * size[own])
                far[own] = np.inf
                other = int(far.argmin())
                found.append((cluster, int(names[other]), float(far[other])))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.float64()))],
                    names=["a", "b", "d"])

    tasks = max(1, min(len(clusters), spark.sparkContext.defaultParallelism))
    numbers = spark.range(0, len(clusters), 1, tasks)
    return [(r["a"], r["b"], r["d"]) for r in
            numbers.mapInArrow(search, "a bigint, b bigint, d double").collect()]


def _merge_tables(points: DataFrame, linkage: str, block_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The same merges with all state in tables, for any number of points.

    ``state`` has each point with the name of its cluster, ``nearest`` each cluster's nearest other one, ``merges``
    grows by what a round merges. Points go to tasks in blocks of whole clusters.
    """
    if linkage not in ("average", "ward"):
        raise ValueError(f"unknown linkage: {linkage}")
    state = cut_lineage(points.select(F.col("centre_id").alias("id"), F.col("centre_id").alias("label"), F.col("z").cast("array<double>").alias("z")))
    merges = state.sparkSession.createDataFrame([], "a int, b int, height double")
    nearest, stale, parts = None, state.select("label"), []
    while state.select("label").distinct().limit(2).count() > 1:
        found = _nearest_table(state, stale, linkage, block_bytes)
        if nearest is not None:
            found = nearest.join(stale, nearest["a"] == stale["label"], "left_anti").unionByName(found)
        nearest = cut_lineage(found)
        back = nearest.select(F.col("a").alias("b"), F.col("b").alias("a"))
        pairs = cut_lineage(nearest.where("a < b").join(back, ["a", "b"], "left_semi").select("a", "b", "d"))
        if not has_rows(pairs):  # rounding can leave equal distances without a mutual pair
            pairs = cut_lineage(nearest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "d").orderBy("d", "a", "b").limit(1))
        parts.append(pairs.select("a", "b", F.col("d").alias("height")))
        gone = broadcast_if_small(pairs.select(F.col("a").alias("_kept"), F.col("b").alias("_gone")))
        state = cut_lineage(state.join(gone, F.col("label") == F.col("_gone"), "left").select(
            "id", F.coalesce("_kept", "label").alias("label"), "z"))
        touched = pairs.select("a").union(pairs.select("b")).select(F.col("a").alias("_touched")).distinct()
        nearest = cut_lineage(nearest.join(gone, F.col("a") == F.col("_gone"), "left_anti"))
        near = nearest.join(touched, F.col("b") == F.col("_touched"), "left_semi").select(F.col("a").alias("label"))
        stale = cut_lineage(near.union(pairs.select(F.col("a").alias("label"))).distinct())
    for part in parts:
        merges = merges.union(part)
    return cut_lineage(merges)


def _nearest_table(state: DataFrame, stale: DataFrame, linkage: str, block_bytes: int) -> DataFrame:
    """``a, b, d`` of the clusters in ``stale``; of equally near ones the lowest name."""
    spark = state.sparkSession
    width = len(state.select("z").first()["z"])
    clusters = state if linkage == "average" else state.groupBy("label").agg(
        F.count(F.lit(1)).alias("size"), *[F.avg(F.get("z", F.lit(i))).alias(f"c{i}") for i in range(width)]).select(
        "label", "size", F.array(*[f"c{i}" for i in range(width)]).alias("z"))
    if linkage == "average":
        clusters = clusters.select("label", F.lit(1).cast("bigint").alias("size"), "z")
    clusters = cut_lineage(clusters)
    blocks = max(1, -(-clusters.count() * (8 * width + 16) // block_bytes))
    own = clusters.join(stale, "label", "left_semi").repartition("label").sortWithinPartitions("label")
    best = None
    for block in range(blocks):
        given = clusters.where(F.pmod(F.xxhash64("label"), F.lit(blocks)) == block).toArrow().sort_by("label")
        held = spark.sparkContext.broadcast((
            given["label"].to_numpy(), given["size"].to_numpy(), np.array(given["z"].to_pylist(), float).reshape(-1, width)))
        found = own.mapInArrow(_search(held, linkage), "a int, b int, d double")
        best = found if best is None else best.union(found)
    return best.groupBy("a").agg(F.min(F.struct("d", "b")).alias("x")).select("a", F.col("x.b").alias("b"), F.col("x.d").alias("d"))


def _search(held, linkage: str):
    """Nearest cluster of a block for each cluster, whose rows come one after another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, sizes, z = held.value
        names, starts = np.unique(labels, return_index=True)
        total = np.add.reduceat(sizes, starts) if len(names) else sizes
        label, sums, count = None, None, 0

        def done() -> list[tuple[int, int, float]]:
            if label is None or not len(names):
                return []
            far = np.sqrt(2.0 * sums * total * count / (total + count)) if linkage == "ward" else sums / (total * count)
            far[names == label] = np.inf
            at = int(far.argmin())
            return [(label, int(names[at]), float(far[at]))] if np.isfinite(far[at]) else []

        for batch in batches:
            out = []
            for one, size, point in zip(*(batch.column(c).to_pylist() for c in ("label", "size", "z"))):
                if one != label:
                    out += done()
                    label, sums, count = one, np.zeros(len(names)), 0
                apart = ((z - np.array(point)) ** 2).sum(axis=1)
                sums += np.add.reduceat(apart if linkage == "ward" else np.sqrt(apart), starts) if len(names) else 0
                count += size
            if out:
                yield _found(out)
        if out := done():
            yield _found(out)
    return run


def _found(rows: list[tuple[int, int, float]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.float64()))], names=["a", "b", "d"])


def _states(points: DataFrame, merges: DataFrame, n: int, m: int) -> DataFrame:
    """Clusters after the lowest ``n - m`` merges, by pointer doubling over who took in whom."""
    ranked = with_position(merges, "height", ["a", "b"], position="rank").where(F.col("rank") < max(0, n - m))
    up = points.select(F.col("centre_id").cast("int").alias("id")).join(
        ranked.select(F.col("b").alias("id"), F.col("a").alias("up")), "id", "left").select("id", F.coalesce("up", "id").alias("up"))
    while True:
        up = cut_lineage(up)
        further = up.select(F.col("id").alias("up"), F.col("up").alias("next"))
        moved = up.join(further, "up").select("id", "up", "next")
        if not has_rows(moved.where("next <> up")):
            break
        up = moved.select("id", F.col("next").alias("up"))
    roots = with_position(up.select("up").distinct(), "up", position="state")
    return up.join(broadcast_if_small(roots), "up").select(F.col("id").alias("centre_id"), F.col("state").cast("int").alias("state"))

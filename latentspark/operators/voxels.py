"""Voxel rows ``(vol_id, z, y, x, v)``: handedness, thresholds, masks, volume PCA."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latentspark.functions.matrices import from_matrix, to_matrix
from latentspark.session import broadcast_if_small, cut_lineage

# Fixed value: a threshold below it means "choose automatically".
AUTO_THRESHOLD_BELOW = 0.001

VOXEL = ["z", "y", "x"]
SLAB_VOXELS = 1 << 14
# Numbers of the directions that the driver holds at most, one row per volume; beyond that one row per voxel if
# those are within the second limit. Numbers of whole volumes in one task call.
VOLUME_NUMBERS = 1 << 20
VOXEL_NUMBERS = 1 << 23
ROW_NUMBERS = 1 << 20


def volumes_to_voxels(df: DataFrame, box: int, column: str = "volume") -> DataFrame:
    """One row per voxel of row-major volume arrays."""
    i = F.col("_i")
    return df.select("vol_id", F.posexplode(column).alias("_i", "v")).select(
        "vol_id",
        F.floor(i / F.lit(box * box)).cast("int").alias("z"),
        F.pmod(F.floor(i / F.lit(box)), F.lit(box)).cast("int").alias("y"),
        F.pmod(i, F.lit(box)).cast("int").alias("x"),
        "v")


def flip_volumes(voxels: DataFrame, box: int) -> DataFrame:
    """Mirror along z."""
    return voxels.withColumn("z", (F.lit(box - 1) - F.col("z")).cast("int"))


def density_threshold(voxels: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Threshold per volume: the given one, or half the maximum when it is below 0.001."""
    value = F.max("v") / 2.0 if threshold < AUTO_THRESHOLD_BELOW else F.lit(float(threshold))
    return voxels.groupBy("vol_id").agg(value.alias("threshold"))


def threshold_mask(voxels: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Coordinates at or above the threshold in any volume."""
    if threshold >= AUTO_THRESHOLD_BELOW:
        dense = voxels.filter(F.col("v") >= threshold)
    else:
        limits = broadcast_if_small(density_threshold(voxels, threshold))
        dense = voxels.join(limits, "vol_id").filter(F.col("v") >= F.col("threshold"))
    return dense.select(*VOXEL).distinct()


def _nearest_squares(f: np.ndarray) -> np.ndarray:
    """``min over p of f[p] + (q - p)^2`` along the last axis, by the lower envelope of the parabolas.

    Every row is one line; ``inf`` is a place without a parabola. The work grows with the length of the lines only.
    """
    lines, n = f.shape
    at = np.zeros((lines, n), np.int64)          # places of the parabolas of the envelope so far
    start = np.full((lines, n + 1), np.inf)      # from where each is the lowest
    last = np.full(lines, -1)
    rows = np.arange(lines)
    for q in range(n):
        todo = rows[np.isfinite(f[:, q])]
        while len(todo):
            empty = last[todo] < 0
            p = at[todo, np.maximum(last[todo], 0)]
            with np.errstate(invalid="ignore", divide="ignore"):
                cross = np.where(empty, -np.inf, (f[todo, q] + q * q - f[todo, p] - p * p) / (2.0 * (q - p)))
            keeps = empty | (cross > start[todo, np.maximum(last[todo], 0)])
            done, under = todo[keeps], todo[~keeps]
            last[done] += 1
            at[done, last[done]] = q
            start[done, last[done]] = cross[keeps]
            start[done, last[done] + 1] = np.inf
            last[under] -= 1  # the one before lies above the new one everywhere
            todo = under
    out, k, some = np.full((lines, n), np.inf), np.zeros(lines, np.int64), rows[last >= 0]
    for q in range(n):
        while len(move := some[start[some, k[some] + 1] < q]):
            k[move] += 1
        p = at[some, k[some]]
        out[some, q] = (q - p) ** 2 + f[some, p]
    return out


def dilate_mask(mask: DataFrame, n: int, box: int) -> DataFrame:
    """Mask grown by a ball of radius ``n``.

    The squared distance to the nearest mask voxel is found axis by axis, as lower envelopes of parabolas: in a task
    per plane along x and y, then, after one shuffle of lines, along z. The work does not grow with the ball. A plane
    has ``box * box`` numbers.
    """
    if n <= 0:
        return mask.distinct()

    def plane(key, rows):
        near = np.full((box, box), np.inf)
        near[rows.column("y").to_numpy(), rows.column("x").to_numpy()] = 0.0
        near = _nearest_squares(_nearest_squares(near).T).T
        # Lines of a plane that are too far for any z are left out.
        kept = np.flatnonzero((near <= n * n).any(axis=1))
        return pa.table({"z": pa.array([key[0].as_py()] * len(kept), pa.int32()), "y": pa.array(kept, pa.int32()),
                         "near": pa.array(list(near[kept]), pa.list_(pa.float64()))})

    def column(key, rows):
        near = np.full((box, box), np.inf)
        if rows.num_rows:
            near[rows.column("z").to_numpy()] = np.array(rows.column("near").to_pylist())
        x, z = np.nonzero(_nearest_squares(near.T) <= n * n)
        return pa.table({"z": pa.array(z, pa.int32()), "y": pa.array([key[0].as_py()] * len(z), pa.int32()), "x": pa.array(x, pa.int32())})

    coordinates = mask.select(*[F.col(c).cast("int").alias(c) for c in VOXEL]).filter(
        F.expr(" AND ".join(f"{c} BETWEEN 0 AND {box - 1}" for c in VOXEL))).distinct()
    lines = coordinates.groupBy("z").applyInArrow(plane, "z int, y int, near array<double>")
    return lines.groupBy("y").applyInArrow(column, "z int, y int, x int")


def apply_mask(voxels: DataFrame, mask: DataFrame) -> DataFrame:
    """Voxels whose coordinates are in the mask."""
    kept = broadcast_if_small(mask.select(*VOXEL))
    return voxels.join(kept, VOXEL, "left_semi")


def volume_slabs(volumes: DataFrame, voxels: int = SLAB_VOXELS, column: str = "volume") -> DataFrame:
    """``vol_id, slab, values``: row-major volume arrays cut into runs of ``voxels`` values.

    A task holds one slab of all volumes, so ``voxels`` times their number should stay at a few million.
    """
    count = F.ceil(F.size(column) / F.lit(voxels)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(F.col(column), i * voxels + 1, F.lit(voxels)))
    return volumes.filter(F.size(column) > 0).select(
        F.col("vol_id").cast("int").alias("vol_id"), F.posexplode(cut).alias("slab", "values"))


def slab_threshold(volumes: DataFrame, threshold: float = 0.0, column: str = "volume") -> DataFrame:
    """``vol_id, threshold`` from volume arrays: no row per voxel."""
    value = F.array_max(F.filter(column, lambda v: v.isNotNull())) / 2.0 if threshold < AUTO_THRESHOLD_BELOW else F.lit(float(threshold))
    return volumes.select("vol_id", value.cast("double").alias("threshold"))


def slab_mask(volumes: DataFrame, threshold: float = 0.0, voxels: int = SLAB_VOXELS, column: str = "volume") -> DataFrame:
    """``slab, kept``: for every voxel of a slab whether any volume is at or above its threshold there."""
    limits = slab_threshold(volumes, threshold, column).select(F.col("vol_id").cast("int").alias("vol_id"), "threshold")
    marked = volumes.join(limits, "vol_id").withColumn(column, F.transform(column, lambda v: v >= F.col("threshold")))
    slabs = volume_slabs(marked, voxels, column)

    def union(key, rows):
        marks = [np.asarray(v.values.fill_null(False)) for v in rows.column("values")]
        kept = np.zeros(max(map(len, marks)), bool)
        for m in marks:
            kept[:len(m)] |= m
        return pa.table({"slab": pa.array([key[0].as_py()], pa.int32()), "kept": pa.array([kept], pa.list_(pa.bool_()))})

    return slabs.groupBy("slab").applyInArrow(union, "slab int, kept array<boolean>")


def mask_slabs(mask: DataFrame, box: int, voxels: int = SLAB_VOXELS) -> DataFrame:
    """Coordinates as ``slab, kept``, the form of ``slab_mask``; slabs without a voxel are missing."""
    place = (F.col("z") * box + F.col("y")).cast("bigint") * box + F.col("x")
    at = mask.select(F.floor(place / F.lit(voxels)).cast("int").alias("slab"), (place % voxels).cast("int").alias("at"))
    listed = at.distinct().groupBy("slab").agg(F.collect_list("at").alias("at"))
    size = F.least(F.lit(voxels), F.lit(box ** 3) - F.col("slab") * voxels).cast("int")

    def run(batches):
        for batch in batches:
            rows = []
            for at, size in zip(batch.column("at").to_pylist(), batch.column("size").to_pylist()):
                kept = np.zeros(size, bool)
                kept[at] = True
                rows.append(kept)
            yield pa.RecordBatch.from_pydict({"slab": batch.column("slab"), "kept": pa.array(rows, pa.list_(pa.bool_()))})

    return listed.select("slab", "at", size.alias("size")).mapInArrow(run, "slab int, kept array<boolean>")


def slab_coordinates(mask: DataFrame, box: int, voxels: int = SLAB_VOXELS) -> DataFrame:
    """Coordinates ``z, y, x`` of a slab mask."""
    rows = mask.select("slab", F.posexplode("kept").alias("at", "on")).filter("on")
    place = F.col("slab").cast("bigint") * voxels + F.col("at")
    return rows.select(F.floor(place / F.lit(box * box)).cast("int").alias("z"),
                       (F.floor(place / F.lit(box)) % box).cast("int").alias("y"), (place % box).cast("int").alias("x"))


def _stacked(rows: pa.Table, ids: np.ndarray) -> np.ndarray:
    """Volumes by voxels of one slab, less each voxel's mean; what is missing counts as 0."""
    parts = [np.nan_to_num(np.asarray(v.values.fill_null(0.0), float)) for v in rows.column("values")]
    out = np.zeros((len(ids), max(map(len, parts))))
    for at, values in zip(np.searchsorted(ids, rows.column("vol_id").to_numpy()), parts):
        out[at, :len(values)] = values
    return out - out.mean(axis=0)


def slab_pca(slabs: DataFrame, mask: DataFrame | None = None, dim: int = 20, *, extra: int = 44, rounds: int = 30,
             tolerance: float = 1e-11, seed: int = 1) -> DataFrame:
    """Scores of each volume on the top components, ``(vol_id, component, score, explained)``, from slabs.

    Randomised subspace iteration. A task holds a slab of all volumes; a round multiplies it with the ``dim + extra``
    directions at hand, which the driver keeps as one row of numbers per volume, and sums over slabs by volume. The
    first directions come from products with random numbers that every slab makes for itself. Rounds end when the
    sums of squares of the wanted components change by less than ``tolerance`` of the whole. Slabs are
    written once; no row is made per voxel. Components beyond the rank of the data have score 0.

    With more than ``VOLUME_NUMBERS`` of these numbers, of many volumes, the directions have a row per voxel instead
    and a task holds some whole volumes, as long as they are within ``VOXEL_NUMBERS``.
    """
    spark = slabs.sparkSession
    if mask is not None:
        kept = broadcast_if_small(mask)
        slabs = slabs.join(kept, "slab").select("vol_id", "slab", F.transform(F.filter(
            F.arrays_zip("values", "kept"), lambda x: x["kept"]), lambda x: x["values"]).alias("values")).filter(F.size("values") > 0)
    slabs = cut_lineage(slabs.select(F.col("vol_id").cast("int"), F.col("slab").cast("int"), F.col("values").cast("array<double>")))
    places = slabs.groupBy("slab").agg(F.max(F.size("values")).alias("n")).orderBy("slab").toArrow()
    volumes, voxels = slabs.select("vol_id").distinct().count(), int(places["n"].to_numpy().sum())
    width = min(volumes, dim + extra)
    if volumes * width > VOLUME_NUMBERS and voxels * min(width, voxels) <= VOXEL_NUMBERS:
        return _pca_by_voxels(slabs, places, volumes, dim, extra, rounds, tolerance, seed)
    ids = slabs.select("vol_id").distinct().orderBy("vol_id").toArrow()["vol_id"].to_numpy().astype(np.int64)
    if len(ids) < 2:
        return spark.createDataFrame([], "vol_id int, component int, score double, explained double")
    k = min(dim, len(ids))

    def products(directions):
        """Products of all slabs with the directions, one row per volume, and the whole sum of squares."""
        def one(key, rows):
            a = _stacked(rows, ids)
            if directions is None:
                found = a @ np.random.default_rng([seed, key[0].as_py()]).standard_normal((a.shape[1], width))
            else:
                found = a @ (a.T @ directions.value)
            return pa.table({"row": pa.array(range(len(ids) + 1), pa.int32()),
                             "v": pa.array([*found, np.full(width, (a * a).sum())], pa.list_(pa.float64()))})

        rows = slabs.groupBy("slab").applyInArrow(one, "row int, v array<double>")
        # Sums by place; a row has a few dozen numbers.
        whole = _sums(rows, width)
        return whole[:-1], float(whole[-1, 0])

    found, total = products(None)
    values, vectors, before = np.zeros(width), np.zeros((len(ids), width)), None
    for _ in range(rounds if total > 0 else 0):
        q = np.linalg.qr(found)[0]
        held = spark.sparkContext.broadcast(q)
        found, total = products(held)
        held.unpersist()
        small = q.T @ found
        values, turned = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values)
        values, vectors = np.maximum(values[order], 0.0), q @ turned[:, order]
        if before is not None and np.abs(values[:k] - before[:k]).max() <= tolerance * total:
            break
        before = values
    return _scores(spark, ids, values, vectors, total, k)


def _sums(rows: DataFrame, width: int) -> np.ndarray:
    """Sums of ``v`` by ``row``, in the order of the rows."""
    found = rows.groupBy("row").agg(*[F.sum(F.get("v", F.lit(i))).alias(f"v{i}") for i in range(width)]).orderBy("row").toArrow()
    return np.column_stack([c.to_numpy() for c in found.columns[1:]])


def _whole_volumes(slabs: DataFrame, places: pa.Table, volumes: int) -> DataFrame:
    """``vol_id, values``: each volume in one row, its slabs one after the other; what is missing is 0."""
    slab, size = places["slab"].to_numpy(), places["n"].to_numpy().astype(np.int64)
    first, voxels = np.cumsum(size) - size, int(size.sum())
    groups = max(1, -(-volumes * voxels // ROW_NUMBERS))

    def gather(rows: pa.Table) -> pa.Table:
        ids, row = np.unique(rows["vol_id"].to_numpy(), return_inverse=True)
        out, values = np.zeros((len(ids), voxels)), rows["values"].combine_chunks()
        lengths, flat = values.value_lengths().to_numpy(), np.nan_to_num(np.asarray(values.flatten().fill_null(0.0), float))
        start = np.repeat(row * voxels + first[np.searchsorted(slab, rows["slab"].to_numpy())] - np.cumsum(lengths) + lengths, lengths)
        out.ravel()[start + np.arange(len(flat))] = flat
        return pa.table({"vol_id": pa.array(ids, pa.int32()), "values": from_matrix(out)})

    group = F.pmod(F.xxhash64("vol_id"), F.lit(groups)).alias("g")
    return slabs.select(group, "vol_id", "slab", "values").groupBy("g").applyInArrow(gather, "vol_id int, values array<double>")


def _pca_by_voxels(slabs: DataFrame, places: pa.Table, volumes: int, dim: int, extra: int, rounds: int, tolerance: float, seed: int) -> DataFrame:
    """``slab_pca`` of many volumes: directions have a row per voxel, and sums of all tasks are added by voxel.

    Nothing at the driver grows with the volumes; the scores are a last pass over them.
    """
    spark, voxels = slabs.sparkSession, int(places["n"].to_numpy().sum())
    whole = cut_lineage(_whole_volumes(slabs, places, volumes))
    width, k = min(volumes, voxels, dim + extra), min(dim, volumes)
    schema = "row int, v array<double>"

    def add_up(batches):
        total = np.zeros(voxels)
        for batch in batches:
            if batch.num_rows:
                total += to_matrix(batch.column("values")).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(voxels), pa.int32()), from_matrix(total[:, None])], names=["row", "v"])

    mean = spark.sparkContext.broadcast(_sums(whole.mapInArrow(add_up, schema), 1)[:, 0] / volumes)

    def products(directions):
        """Products of all volumes' squares with the directions, one row per voxel, and the whole sum of squares."""
        def one(batches):
            out, squares = np.zeros((voxels + 1, width)), 0.0
            for batch in batches:
                if batch.num_rows:
                    a = to_matrix(batch.column("values")) - mean.value
                    out[:-1] += a.T @ (a @ directions.value)
                    squares += (a * a).sum()
            out[-1] = squares
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(voxels + 1), pa.int32()), from_matrix(out)], names=["row", "v"])

        sums = _sums(whole.mapInArrow(one, schema), width)
        return sums[:-1], float(sums[-1, 0])

    found = np.random.default_rng(seed).standard_normal((voxels, width))
    values, vectors, before = np.zeros(width), np.zeros((voxels, width)), None
    for _ in range(rounds):
        q = np.linalg.qr(found)[0]
        held = spark.sparkContext.broadcast(q)
        found, total = products(held)
        held.unpersist()
        small = q.T @ found
        values, turned = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values)
        values, vectors = np.maximum(values[order], 0.0), q @ turned[:, order]
        # Directions for all voxels need one round.
        if total <= 0 or width == voxels or before is not None and np.abs(values[:k] - before[:k]).max() <= tolerance * total:
            break
        before = values
    kept = min(k, width)
    axes = spark.sparkContext.broadcast(vectors[:, :kept])

    def largest(batches):
        """Of each component the score that is farthest from 0, of the lowest volume."""
        best, ids = np.zeros(kept), np.full(kept, np.iinfo(np.int32).max)
        for batch in batches:
            if batch.num_rows:
                a, own = (to_matrix(batch.column("values")) - mean.value) @ axes.value, batch.column("vol_id").to_numpy()
                order = np.argsort(own, kind="stable")
                a, own = a[order], own[order]
                at = np.abs(a).argmax(axis=0)
                now = a[at, np.arange(kept)]
                better = (np.abs(now) > np.abs(best)) | ((np.abs(now) == np.abs(best)) & (own[at] < ids))
                best[better], ids[better] = now[better], own[at][better]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(kept), pa.int32()), pa.array(best), pa.array(ids, pa.int32())], names=["component", "score", "vol_id"])

    tops = whole.mapInArrow(largest, "component int, score double, vol_id int").groupBy("component").agg(
        F.max_by("score", F.struct(F.abs("score"), -F.col("vol_id"))).alias("score")).orderBy("component").toArrow()
    signs = np.where(tops["score"].to_numpy() < 0, -1.0, 1.0)
    explained = np.zeros(k)
    explained[:kept] = values[:kept] / max(total, 1e-300)

    def score(batches):
        for batch in batches:
            if batch.num_rows:
                out = np.zeros((batch.num_rows, k))
                out[:, :kept] = (to_matrix(batch.column("values")) - mean.value) @ axes.value * signs
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(batch.column("vol_id").to_numpy(), k), pa.int32()), pa.array(np.tile(np.arange(k), len(out)), pa.int32()),
                    pa.array(out.ravel()), pa.array(np.tile(explained, len(out)))], names=["vol_id", "component", "score", "explained"])

    return whole.mapInArrow(score, "vol_id int, component int, score double, explained double")


def _scores(spark, ids, values: np.ndarray, vectors: np.ndarray, total: float, k: int) -> DataFrame:
    vectors, values = vectors[:, :k], values[:k]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    scores = vectors * np.where(signs == 0, 1.0, signs) * np.sqrt(values)
    return spark.createDataFrame(pa.table({
        "vol_id": pa.array(np.repeat(ids, k), pa.int32()), "component": pa.array(np.tile(np.arange(k), len(ids)), pa.int32()),
        "score": scores.ravel(), "explained": np.tile(values / max(total, 1e-300), len(ids))}))


def volume_pca(voxels: DataFrame, mask: DataFrame | None = None, dim: int = 20) -> DataFrame:
    """The same from voxel rows ``vol_id, z, y, x, v``: rows are gathered into slabs of a plane's line first.

    A voxel missing from a volume counts as 0. Who has volume arrays calls ``volume_slabs`` and ``slab_pca``.
    """
    if mask is not None:
        voxels = apply_mask(voxels, mask)
    box = (voxels.agg(F.max("x")).first()[0] or 0) + 1
    line = voxels.groupBy(F.col("vol_id").cast("int").alias("vol_id"), "z", "y").agg(
        F.collect_list(F.struct(F.col("x").cast("int").alias("x"), F.col("v").cast("double").alias("v"))).alias("m"))
    found = F.map_from_entries("m")
    values = F.transform(F.sequence(F.lit(0), F.lit(box - 1)), lambda x: F.coalesce(F.try_element_at(found, x.cast("int")), F.lit(0.0)))
    return slab_pca(line.select("vol_id", (F.col("z") * 32_768 + F.col("y")).cast("int").alias("slab"), values.alias("values")), None, dim)

"""Queries on image and volume arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import CENTRES_CTE, ctes, label_centres, view
from catalog.registry import query, r6, sql6
from latentspark.operators import images, voxels

IMAGES, VOLUMES = ctes("images"), ctes("volumes")
PIXELS_SQL = """pixels AS (
    SELECT position, CAST((i - 1) // 8 AS INT) AS py, CAST((i - 1) % 8 AS INT) AS px, v
    FROM (SELECT position, generate_subscripts(image, 1) AS i, unnest(image) AS v FROM images) d)"""
VOXELS_SQL = """voxels AS MATERIALIZED (
    SELECT vol_id, CAST((i - 1) // 16 AS INT) AS z, CAST((i - 1) // 4 % 4 AS INT) AS y,
           CAST((i - 1) % 4 AS INT) AS x, v
    FROM (SELECT vol_id, generate_subscripts(volume, 1) AS i, unnest(volume) AS v FROM volumes) d)"""
LIMITS_SQL = "limits AS (SELECT vol_id, max(v) / 2 AS threshold FROM voxels GROUP BY 1)"


def _voxels(spark, sf):
    return voxels.volumes_to_voxels(view(spark, sf, "volumes"), 4)


def _pixel_rows(df):
    return images.images_to_pixels(df).select("position", "py", "px", r6("v").alias("v"))


@query("images_to_pixels", f"{IMAGES}, {PIXELS_SQL} SELECT position, py, px, {sql6('v')} AS v FROM pixels")
def images_to_pixels(spark, sf):
    return _pixel_rows(view(spark, sf, "images"))


@query("downsample_images", f"""{IMAGES}, {PIXELS_SQL},
    n8 AS (SELECT unnest(range(8)) AS i), n4 AS (SELECT unnest(range(4)) AS o),
    k AS (SELECT unnest(range(-2, 2)) AS k),
    w AS MATERIALIZED (
        SELECT oy.o AS oy, ox.o AS ox, iy.i AS iy, ix.i AS ix, sum(cos(2 * pi() * (
            ky.k * (oy.o / 4e0 - iy.i / 8e0) + kx.k * (ox.o / 4e0 - ix.i / 8e0)))) / 64 AS w
        FROM n4 oy, n4 ox, n8 iy, n8 ix, k ky, k kx GROUP BY ALL)
    SELECT position, CAST(oy AS INT) AS py, CAST(ox AS INT) AS px, {sql6('sum(v * w)')} AS v
    FROM pixels JOIN w ON iy = py AND ix = px GROUP BY position, oy, ox""")
def downsample_images(spark, sf):
    return _pixel_rows(images.downsample_images(view(spark, sf, "images"), 4))


@query("downsample_volumes", f"""{VOLUMES}, {VOXELS_SQL},
    n4 AS (SELECT unnest(range(4)) AS i), n2 AS (SELECT unnest(range(2)) AS o),
    k AS (SELECT unnest(range(-1, 1)) AS k),
    w AS MATERIALIZED (
        SELECT oz.o AS oz, oy.o AS oy, ox.o AS ox, iz.i AS iz, iy.i AS iy, ix.i AS ix,
               sum(cos(2 * pi() * (kz.k * (oz.o / 2e0 - iz.i / 4e0) + ky.k * (oy.o / 2e0 - iy.i / 4e0)
                                   + kx.k * (ox.o / 2e0 - ix.i / 4e0)))) / 64 AS w
        FROM n2 oz, n2 oy, n2 ox, n4 iz, n4 iy, n4 ix, k kz, k ky, k kx GROUP BY ALL)
    SELECT vol_id, CAST(oz AS INT) AS z, CAST(oy AS INT) AS y, CAST(ox AS INT) AS x, {sql6('sum(v * w)')} AS v
    FROM voxels JOIN w ON iz = z AND iy = y AND ix = x GROUP BY vol_id, oz, oy, ox""")
def downsample_volumes(spark, sf):
    small = images.downsample_volumes(view(spark, sf, "volumes"), 2)
    return voxels.volumes_to_voxels(small, 2).select("vol_id", "z", "y", "x", r6("v").alias("v"))


@query("invert_images", f"{IMAGES}, {PIXELS_SQL} SELECT position, py, px, {sql6('-v')} AS v FROM pixels")
def invert_images(spark, sf):
    return _pixel_rows(images.invert(view(spark, sf, "images")))


@query("invert_volumes", f"{VOLUMES}, {VOXELS_SQL} SELECT vol_id, z, y, x, {sql6('-v')} AS v FROM voxels")
def invert_volumes(spark, sf):
    return images.invert(_voxels(spark, sf), "v").select("vol_id", "z", "y", "x", r6("v").alias("v"))


@query("window_images", f"""{IMAGES}, {PIXELS_SQL},
    r AS (SELECT *, sqrt((py - 4) / 4e0 * ((py - 4) / 4e0) + (px - 4) / 4e0 * ((px - 4) / 4e0)) AS r FROM pixels)
    SELECT position, py, px, {sql6('''v * CASE WHEN r <= 0.85 THEN 1 WHEN r >= 1 THEN 0
        ELSE (cos((r - 0.85) / 0.15 * pi()) + 1) / 2 END''')} AS v FROM r""")
def window_images(spark, sf):
    return _pixel_rows(images.window_images(view(spark, sf, "images")))


@query("flip_volumes", f"""{VOLUMES}, {VOXELS_SQL}
    SELECT vol_id, CAST(3 - z AS INT) AS z, y, x, {sql6('v')} AS v FROM voxels""")
def flip_volumes(spark, sf):
    return voxels.flip_volumes(_voxels(spark, sf), 4).select("vol_id", "z", "y", "x", r6("v").alias("v"))


@query("density_threshold", f"""{VOLUMES}, {VOXELS_SQL}, {LIMITS_SQL}
    SELECT vol_id, {sql6('threshold')} AS threshold FROM limits""")
def density_threshold(spark, sf):
    return voxels.density_threshold(_voxels(spark, sf), 0.0).select("vol_id", r6("threshold").alias("threshold"))


@query("density_threshold_given", f"{VOLUMES} SELECT vol_id, 0.001 :: DOUBLE AS threshold FROM volumes")
def density_threshold_given(spark, sf):
    return voxels.density_threshold(_voxels(spark, sf), 0.001)


@query("threshold_mask", f"""{VOLUMES}, {VOXELS_SQL}, {LIMITS_SQL}
    SELECT DISTINCT z, y, x FROM voxels JOIN limits USING (vol_id) WHERE v >= threshold""")
def threshold_mask(spark, sf):
    return voxels.threshold_mask(_voxels(spark, sf), 0.0)


@query("threshold_mask_given", f"""{VOLUMES}, {VOXELS_SQL}
    SELECT DISTINCT z, y, x FROM voxels WHERE v >= 0.45""")
def threshold_mask_given(spark, sf):
    return voxels.threshold_mask(_voxels(spark, sf), 0.45)


@query("dilate_mask", f"""{VOLUMES}, {VOXELS_SQL},
    mask AS (SELECT DISTINCT z, y, x FROM voxels WHERE v >= 0.45),
    s AS (SELECT unnest(range(-1, 2)) AS d)
    SELECT DISTINCT CAST(z + dz.d AS INT) AS z, CAST(y + dy.d AS INT) AS y, CAST(x + dx.d AS INT) AS x
    FROM mask, s dz, s dy, s dx
    WHERE dz.d * dz.d + dy.d * dy.d + dx.d * dx.d <= 1 AND z + dz.d BETWEEN 0 AND 3
      AND y + dy.d BETWEEN 0 AND 3 AND x + dx.d BETWEEN 0 AND 3""")
def dilate_mask(spark, sf):
    return voxels.dilate_mask(voxels.threshold_mask(_voxels(spark, sf), 0.45), 1, 4)


@query("apply_mask", f"""{VOLUMES}, {VOXELS_SQL}, mask AS (SELECT DISTINCT z, y, x FROM voxels WHERE v >= 0.45)
    SELECT vol_id, z, y, x, {sql6('v')} AS v FROM voxels SEMI JOIN mask USING (z, y, x)""")
def apply_mask(spark, sf):
    rows = _voxels(spark, sf)
    return voxels.apply_mask(rows, voxels.threshold_mask(rows, 0.45)).select(
        "vol_id", "z", "y", "x", r6("v").alias("v"))


@query("volume_pca")
def volume_pca(spark, sf):
    rows = _voxels(spark, sf)
    return voxels.volume_pca(rows, voxels.threshold_mask(rows, 0.3), 20)


@query("volume_pca_distances", f"""{ctes('latents')}, {CENTRES_CTE}
    SELECT a.centre_id AS first, b.centre_id AS second, {sql6('list_distance(a.z, b.z)')} AS dist
    FROM label_centres a JOIN label_centres b ON a.centre_id < b.centre_id""")
def volume_pca_distances(spark, sf):
    """With as many components as volumes, scores keep the distances between volumes."""
    mean = label_centres(spark, sf).select(F.col("centre_id").alias("vol_id"), F.col("z").alias("volume"))
    scores = voxels.volume_pca(voxels.volumes_to_voxels(mean, 4), None, 20)
    a = scores.select(F.col("vol_id").alias("first"), "component", F.col("score").alias("a"))
    b = scores.select(F.col("vol_id").alias("second"), "component", F.col("score").alias("b"))
    apart = F.sqrt(F.sum((F.col("a") - F.col("b")) * (F.col("a") - F.col("b"))))
    return a.join(b, "component").filter("first < second").groupBy("first", "second").agg(
        r6(apart).alias("dist"))


@query("volume_pca_norms", f"""{VOLUMES}, {VOXELS_SQL}, c AS (
        SELECT vol_id, v - avg(v) OVER (PARTITION BY z, y, x) AS v FROM voxels)
    SELECT vol_id, round(sum(v * v), 5) + 0.0 AS squares FROM c GROUP BY vol_id""")
def volume_pca_norms(spark, sf):
    """Over as many components as voxels, a volume's scores keep its squared distance from the mean."""
    slabs = voxels.volume_slabs(view(spark, sf, "volumes"), 16)
    return voxels.slab_pca(slabs, None, 64).groupBy("vol_id").agg(
        (F.round(F.sum(F.col("score") * F.col("score")), 5) + F.lit(0.0)).alias("squares"))


@query("slab_mask", f"""{VOLUMES}, {VOXELS_SQL}, {LIMITS_SQL}
    SELECT DISTINCT z, y, x FROM voxels JOIN limits USING (vol_id) WHERE v >= threshold""")
def slab_mask(spark, sf):
    """The automatic mask from volume arrays, without a row per voxel and volume."""
    return voxels.slab_coordinates(voxels.slab_mask(view(spark, sf, "volumes"), 0.0, 16), 4, 16)


@query("dilate_mask_far", f"""{VOLUMES}, {VOXELS_SQL}, mask AS (SELECT DISTINCT z, y, x FROM voxels WHERE v >= 0.49),
    all_places AS (SELECT DISTINCT z, y, x FROM voxels)
    SELECT DISTINCT p.z, p.y, p.x FROM all_places p JOIN mask m
      ON (p.z - m.z) * (p.z - m.z) + (p.y - m.y) * (p.y - m.y) + (p.x - m.x) * (p.x - m.x) <= 9""")
def dilate_mask_far(spark, sf):
    return voxels.dilate_mask(voxels.threshold_mask(_voxels(spark, sf), 0.49), 3, 4)

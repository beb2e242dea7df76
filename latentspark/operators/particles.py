"""Particle sets: geometry, poses, optical parameters, latents, subsets."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latentspark.session import BROADCAST_BYTES, broadcast_if_small, cut_lineage

# Positions of a bitmap row, and its bytes as broadcast.
BUCKET = 32_768
BITMAP_ROW_BYTES = 4_200


def _number(value: float | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def rescale_sampling(df: DataFrame, old_box, new_box, column: str = "apix") -> DataFrame:
    """Pixel size after a box change. Boxes are numbers, or columns for many sets at once."""
    return df.withColumn(column, F.col(column) * _number(old_box) / _number(new_box))


def rescale_coords(df: DataFrame, old_box, new_box) -> DataFrame:
    """Scale pick coordinates; rows without one, and a factor of 1, are left alone."""
    if not isinstance(old_box, Column) and not isinstance(new_box, Column) and old_box == new_box:
        return df
    factor = _number(new_box) / _number(old_box)
    coord = F.col("coord")
    scaled = coord.withField("x", coord["x"] * factor).withField("y", coord["y"] * factor)
    return df.withColumn("coord", F.when(coord.isNotNull(), scaled))


def rescale_shifts(df: DataFrame, old_box, new_box) -> DataFrame:
    """Scale the in-plane shifts of rows that have a transform."""
    if not isinstance(old_box, Column) and not isinstance(new_box, Column) and old_box == new_box:
        return df
    factor = _number(new_box) / _number(old_box)
    transform = F.col("transform")
    scaled = transform.withField("shift_x", transform["shift_x"] * factor).withField(
        "shift_y", transform["shift_y"] * factor)
    return df.withColumn("transform", F.when(transform.isNotNull(), scaled))


def target_box(df: DataFrame, do_scale, size, box: str = "box") -> DataFrame:
    """Box size after the job: the requested size if scaling is on, else the set's own."""
    do_scale = do_scale if isinstance(do_scale, Column) else F.lit(do_scale)
    size = size if isinstance(size, Column) else F.lit(size)
    return df.withColumn("target_box", F.when(do_scale, size).otherwise(F.col(box)))


def parse_poses(df: DataFrame) -> DataFrame:
    """Rotation matrix (row-major, ZYZ Euler angles in degrees) and translation per particle.

    Rows without a transform have no pose.
    """
    t = F.col("transform")
    a, b, g = F.radians(t["rot"]), F.radians(t["tilt"]), F.radians(t["psi"])
    matrix = F.array(
        F.cos(g) * F.cos(b) * F.cos(a) - F.sin(g) * F.sin(a),
        F.cos(g) * F.cos(b) * F.sin(a) + F.sin(g) * F.cos(a),
        -F.cos(g) * F.sin(b),
        -F.sin(g) * F.cos(b) * F.cos(a) - F.cos(g) * F.sin(a),
        -F.sin(g) * F.cos(b) * F.sin(a) + F.cos(g) * F.cos(a),
        F.sin(g) * F.sin(b),
        F.sin(b) * F.cos(a),
        F.sin(b) * F.sin(a),
        F.cos(b),
    )
    return df.select(
        "position",
        F.when(t.isNotNull(), matrix).alias("rotation"),
        F.when(t.isNotNull(), F.array(t["shift_x"], t["shift_y"])).alias("translation"),
    )


CTF_COLUMNS = (
    "box", "apix", "defocus_u", "defocus_v", "defocus_angle", "voltage", "spherical_aberration",
    "amplitude_contrast",
)


def parse_ctf(df: DataFrame) -> DataFrame:
    """Optical parameters per particle with the phase shift set to 0."""
    return df.select("position", *CTF_COLUMNS, F.lit(0.0).alias("phase_shift"))


def copy_with(df: DataFrame, **columns: Column) -> DataFrame:
    """Keep every column, replacing or adding the named ones."""
    return df.withColumns(columns) if columns else df


def tag_flex(df: DataFrame, prog: str) -> DataFrame:
    """Mark rows with the program that made their vectors."""
    return df.withColumn("prog", F.lit(prog))


def with_attrs(df: DataFrame, attrs: dict[str, str], column: str = "attrs") -> DataFrame:
    """Set attributes on every row's attribute map; a given key replaces an old one."""
    if not attrs:
        return df
    given = F.create_map(*[F.lit(item) for pair in attrs.items() for item in pair])
    if column not in df.columns:
        return df.withColumn(column, given)
    kept = F.map_filter(F.col(column), lambda k, _: ~k.isin(*attrs))
    return df.withColumn(column, F.coalesce(F.map_concat(kept, given), given))


def has_alignment(df: DataFrame) -> DataFrame:
    """Whether every particle has a transform (an empty set has none)."""
    return df.agg(
        F.coalesce(F.bool_and(F.col("transform").isNotNull()), F.lit(False)).alias("has_alignment"))


def update_items(df: DataFrame, fn: Callable[[Iterator], Iterator], schema) -> DataFrame:
    """Escape hatch for a per-item change no expression can make: pandas batches
    in, pandas batches out. Prefer column expressions; drop rows with ``filter``."""
    return df.mapInPandas(fn, schema)


def attach_latents(particles: DataFrame, latents: DataFrame, *, strict: bool = False) -> DataFrame:
    """Give each particle the vector at its own position.

    Both sides are ordered sets with dense positions, so the inner join ends
    with the shorter one. ``strict`` raises when the sizes differ.
    """
    if strict:
        sizes = particles.count(), latents.count()
        if sizes[0] != sizes[1]:
            raise ValueError(f"{sizes[0]} particles but {sizes[1]} latent vectors")
    return particles.join(latents.select("position", "z"), "position", "inner")


def position_bitmap(index: DataFrame) -> DataFrame:
    """``bucket, bits``: one bit per listed position, 32,768 of them a row.

    Repeats set the same bit; null and negative entries set none.
    """
    place = F.col("position").cast("bigint") + 1  # buckets and bits count from 1
    return index.filter(F.col("position") >= 0).groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))


def bitmap_stats(bitmap: DataFrame) -> DataFrame:
    """How many different positions a bitmap holds, and its last bucket, in one row."""
    return bitmap.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("positions"), F.max("bucket").alias("last_bucket"))


def _words(bits: Column) -> Column:
    """The 4,096 bytes as 512 numbers of 64 bits, the first byte highest."""
    return F.transform(F.sequence(F.lit(0), F.lit(511)), lambda i: F.conv(
        F.hex(F.substring(bits, i * 8 + 1, F.lit(8))), 16, -10).cast("bigint"))


def subset(particles: DataFrame, index: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Particles whose position is in the index list.

    The list becomes a bitmap, which is sent to all tasks; particles are never shuffled. A bitmap of more than
    ``max_bytes`` is taken in ranges of buckets, each with the particles of its positions, by a filter that
    reaches the scan.
    """
    bitmap = cut_lineage(position_bitmap(index))
    buckets = bitmap.count()
    if not buckets:
        return particles.filter(F.lit(False))
    passes = min(buckets, -(-buckets * BITMAP_ROW_BYTES // max_bytes))
    cuts = [int(c) for c in bitmap.approxQuantile("bucket", [i / passes for i in range(1, passes)], 0.001)] if passes > 1 else []
    position = F.col("position").cast("bigint")
    bit = F.bitmap_bit_position(position + 1)
    byte = F.call_function("div", bit, F.lit(8))
    word = F.get(F.col("_words"), F.call_function("div", byte, F.lit(8)).cast("int"))
    # Words have their first byte highest, and the bits of a byte from the lowest on.
    listed = F.call_function("shiftright", word, ((7 - byte % 8) * 8 + bit % 8).cast("int")).bitwiseAND(1) == 1
    parts = []
    for low, high in zip([None, *cuts], [*cuts, None]):
        within, rows = F.lit(True), particles
        if low is not None:
            within, rows = within & (F.col("bucket") > low), rows.filter(position >= low * BUCKET)
        if high is not None:
            within, rows = within & (F.col("bucket") <= high), rows.filter(position < high * BUCKET)
        words = F.broadcast(bitmap.filter(within).select(F.col("bucket").alias("_bucket"), _words(F.col("bits")).alias("_words")))
        parts.append(rows.join(words, F.bitmap_bucket_number(position + 1) == F.col("_bucket")).filter(listed).select(*particles.columns))
    return reduce(DataFrame.union, parts)


def subset_summary(particles: DataFrame, selected: DataFrame) -> DataFrame:
    """Input and selected sizes in one row."""
    sides = particles.select(F.lit(1).alias("i"), F.lit(0).alias("s")).unionAll(
        selected.select(F.lit(0).alias("i"), F.lit(1).alias("s")))
    return sides.agg(
        F.coalesce(F.sum("i"), F.lit(0)).cast("bigint").alias("input_particles"),
        F.coalesce(F.sum("s"), F.lit(0)).cast("bigint").alias("selected_particles"),
    )


def index_stats(index: DataFrame, by: str | None = None) -> DataFrame:
    """Raw length (repeats count) and largest entry of an index list."""
    grouped = index.groupBy(by) if by else index.groupBy()
    return grouped.agg(F.count("position").alias("n_index"), F.max("position").alias("max_index"))


def set_info(df: DataFrame, by: str | None = None) -> DataFrame:
    """Set facts: size, box size, pixel size."""
    grouped = df.groupBy(by) if by else df.groupBy()
    return grouped.agg(
        F.count("*").alias("size"), F.max("box").alias("box"), F.max("apix").alias("apix"))


def pair_volumes(volumes: DataFrame, z_rows: DataFrame) -> DataFrame:
    """Give each volume the vector with its ordinal; fails on a volume without one."""
    joined = volumes.join(broadcast_if_small(z_rows.select("vol_id", "z")), "vol_id", "left")
    missing = F.raise_error(F.format_string("volume %d has no z row", F.col("vol_id")))
    return joined.withColumn("z", F.when(F.col("z").isNull(), missing).otherwise(F.col("z")))


def missing_volumes(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Volume ordinals ``0 .. n-1`` a run should have but has no file for.

    ``expected`` is ``(run_id, n)``, ``found`` is ``(run_id, vol_id)``.
    """
    wanted = expected.filter(F.col("n") > 0).select(
        "run_id", F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)).alias("vol_id"))
    return wanted.join(found.select("run_id", "vol_id").distinct(), ["run_id", "vol_id"], "left_anti")

"""Queries on particle sets: positions, layout, geometry, joins, sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.fixtures import ctes, particles, table, view
from catalog.registry import query, r6, sql6
from latentspark.functions import names
from latentspark.operators import particles as sets
from latentspark.operators import position
from latentspark.plans import jobs
from latentspark.session import working_dir
from latentspark.sources import epochs, star, tables, text


def _new_path(spark) -> str:
    return f"{working_dir(spark)}/catalog-{uuid.uuid4().hex}"


# Positions and layout

@query("with_position", """
    SELECT event_id, user_id, row_number() OVER (ORDER BY user_id, event_id) - 1 AS position FROM events""")
def with_position(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id")
    return position.with_position(events, "user_id", ["event_id"])


@query("with_position_ranges", """
    SELECT o_orderkey, o_orderpriority,
           row_number() OVER (ORDER BY o_orderpriority, o_orderkey) - 1 AS position FROM orders""")
def with_position_ranges(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return position.with_position(orders, "o_orderpriority", ["o_orderkey"], rows_per_range=2_000)


_LOCATION = """SELECT position, CAST(position % 200 + 1 AS INT) AS idx,
    concat('particles.48.', position // 200, '.mrcs') AS file FROM particles"""


@query("stack_location", f"{ctes('particles')} {_LOCATION}")
def stack_location(spark, sf):
    out = position.stack_location(particles(spark, sf), 48, 200)
    return out.select("position", F.col("location.index").alias("idx"), F.col("location.file").alias("file"))


@query("stack_location_single", f"""{ctes('particles')}
    SELECT position, CAST(position + 1 AS INT) AS idx, 'particles.64.mrcs' AS file FROM particles""")
def stack_location_single(spark, sf):
    out = position.stack_location(particles(spark, sf), 64, 0)
    return out.select("position", F.col("location.index").alias("idx"), F.col("location.file").alias("file"))


@query("chunk_sizes", f"""{ctes('particles')}
    SELECT position // 300 AS chunk, count(*) AS images FROM particles GROUP BY 1""")
def chunk_sizes(spark, sf):
    return position.chunk_sizes(particles(spark, sf), 300)


_PART_FILES = "concat(p_brand, '/vol_', lpad(CAST(p_partkey AS VARCHAR(20)), 6, '0'), '.mrc')"


@query("with_volume_id", f"""
    SELECT CAST(row_number() OVER (ORDER BY {_PART_FILES}) - 1 AS INT) AS vol_id, {_PART_FILES} AS file
    FROM part""")
def with_volume_id(spark, sf):
    files = table(spark, sf, "part").select(F.expr(_PART_FILES).alias("file"))
    return position.with_volume_id(files).select("vol_id", "file")


@query("first_volumes", f"""{ctes('volumes')}
    SELECT vol_id, CAST(len(volume) AS INT) AS voxels FROM volumes WHERE vol_id < 10""")
def first_volumes(spark, sf):
    return position.first_volumes(view(spark, sf, "volumes"), 10).select(
        "vol_id", F.size("volume").alias("voxels"))


@query("concat_chunks", """
    SELECT o_orderkey AS position, o_orderkey AS id, 'orders' AS source FROM orders UNION ALL
    SELECT c_custkey + (SELECT count(*) FROM orders), c_custkey, 'customer' FROM customer UNION ALL
    SELECT p_partkey + (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer), p_partkey, 'part'
    FROM part""")
def concat_chunks(spark, sf):
    chunks = [
        table(spark, sf, name).select(
            F.col(key).alias("position"), F.col(key).alias("id"), F.lit(name).alias("source"))
        for name, key in (("orders", "o_orderkey"), ("customer", "c_custkey"), ("part", "p_partkey"))]
    return position.concat_chunks(chunks)


@query("zip_by_position", """
    SELECT event_id AS position, value, o_totalprice FROM events JOIN orders ON event_id = o_orderkey""")
def zip_by_position(spark, sf):
    left = table(spark, sf, "events").select(F.col("event_id").alias("position"), "value")
    right = table(spark, sf, "orders").select(F.col("o_orderkey").alias("position"), "o_totalprice")
    return position.zip_by_position(left, right)


# Geometry and projections

@query("rescale_sampling", f"""{ctes('runs')}
    SELECT run_id, apix * box / 64e0 AS apix FROM runs""")
def rescale_sampling(spark, sf):
    runs = view(spark, sf, "runs").select("run_id", "apix", "box")
    return sets.rescale_sampling(runs, F.col("box"), 64).select("run_id", "apix")


@query("rescale_coords", f"""{ctes('particles')}
    SELECT position, x * (48e0 / 256e0) AS x, y * (48e0 / 256e0) AS y FROM particles""")
def rescale_coords(spark, sf):
    out = sets.rescale_coords(particles(spark, sf), 256, 48)
    return out.select("position", "coord.x", "coord.y")


@query("rescale_shifts", f"""{ctes('particles')}
    SELECT position, rot, shift_x * (48e0 / 256e0) AS shift_x, shift_y * (48e0 / 256e0) AS shift_y
    FROM particles""")
def rescale_shifts(spark, sf):
    out = sets.rescale_shifts(particles(spark, sf), 256, 48)
    return out.select("position", "transform.rot", "transform.shift_x", "transform.shift_y")


@query("preprocess", f"""{ctes('particles')}
    SELECT position, CAST(position % 200 + 1 AS INT) AS idx,
           concat('particles.64.', position // 200, '.mrcs') AS file, 64 AS box,
           apix * 256e0 / 64e0 AS apix, x / 4e0 AS x, y / 4e0 AS y,
           shift_x / 4e0 AS shift_x, shift_y / 4e0 AS shift_y FROM particles""")
def preprocess(spark, sf):
    out = jobs.preprocess(particles(spark, sf), 256, size=64, chunk=200)
    return out.select(
        "position", F.col("location.index").alias("idx"), F.col("location.file").alias("file"), "box",
        "apix", "coord.x", "coord.y", "transform.shift_x", "transform.shift_y")


@query("target_box", f"""{ctes('runs')}
    SELECT run_id, CASE WHEN do_scale THEN scale_size ELSE box END AS target_box FROM runs""")
def target_box(spark, sf):
    return sets.target_box(view(spark, sf, "runs"), F.col("do_scale"), F.col("scale_size")).select(
        "run_id", "target_box")


def _pose_sql() -> str:
    a, b, g = (f"radians({c})" for c in ("rot", "tilt", "psi"))
    cells = [
        f"cos({g})*cos({b})*cos({a}) - sin({g})*sin({a})", f"cos({g})*cos({b})*sin({a}) + sin({g})*cos({a})",
        f"-cos({g})*sin({b})", f"-sin({g})*cos({b})*cos({a}) - cos({g})*sin({a})",
        f"-sin({g})*cos({b})*sin({a}) + cos({g})*cos({a})", f"sin({g})*sin({b})", f"sin({b})*cos({a})",
        f"sin({b})*sin({a})", f"cos({b})"]
    return ", ".join(f"{sql6(c)} AS r{i}" for i, c in enumerate(cells))


@query("parse_poses", f"""{ctes('particles')}
    SELECT position, {_pose_sql()}, {sql6('shift_x')} AS tx, {sql6('shift_y')} AS ty FROM particles""")
def parse_poses(spark, sf):
    out = sets.parse_poses(particles(spark, sf))
    return out.select(
        "position", *[r6(F.get("rotation", F.lit(i))).alias(f"r{i}") for i in range(9)],
        r6(F.get("translation", F.lit(0))).alias("tx"), r6(F.get("translation", F.lit(1))).alias("ty"))


@query("parse_ctf", f"""{ctes('particles')}
    SELECT position, box, apix, defocus_u, defocus_v, defocus_angle, voltage, spherical_aberration,
           amplitude_contrast, 0e0 AS phase_shift FROM particles""")
def parse_ctf(spark, sf):
    return sets.parse_ctf(particles(spark, sf))


@query("copy_with", f"""{ctes('particles')}
    SELECT position, particle_id, box, apix * 2 AS apix, 'copied' AS note FROM particles""")
def copy_with(spark, sf):
    base = particles(spark, sf).select("position", "particle_id", "box", "apix")
    return sets.copy_with(base, apix=F.col("apix") * 2, note=F.lit("copied"))


@query("tag_flex", f"""{ctes('latents')}
    SELECT position, 'trainer' AS prog, CAST(len(z) AS INT) AS zdim FROM latents""")
def tag_flex(spark, sf):
    return sets.tag_flex(view(spark, sf, "latents"), "trainer").select(
        "position", "prog", F.size("z").alias("zdim"))


@query("with_attrs", f"""{ctes('runs')}
    SELECT run_id, 'weights.pkl' AS weights, 'config.yaml' AS config, kind AS old FROM runs""")
def with_attrs(spark, sf):
    runs = view(spark, sf, "runs").withColumn(
        "attrs", F.create_map(F.lit("kind"), F.col("kind"), F.lit("weights"), F.lit("previous")))
    out = sets.with_attrs(runs, {"weights": names.WEIGHTS_FINAL_FILE, "config": "config.yaml"})
    return out.select("run_id", F.col("attrs.weights"), F.col("attrs.config"), F.col("attrs.kind").alias("old"))


@query("has_alignment", f"""{ctes('particles')}
    SELECT bool_and(rot IS NOT NULL) AS has_alignment FROM particles""")
def has_alignment(spark, sf):
    return sets.has_alignment(particles(spark, sf))


@query("drop_rows", f"""{ctes('particles')} SELECT position, x, y FROM particles WHERE x IS NOT NULL""")
def drop_rows(spark, sf):
    return particles(spark, sf).filter("coord IS NOT NULL").select("position", "coord.x", "coord.y")


def _halve_defocus(batches):
    for batch in batches:
        batch["defocus_u"] = batch["defocus_u"] / 2.0
        yield batch


@query("update_items", f"{ctes('particles')} SELECT position, defocus_u / 2e0 AS defocus_u FROM particles")
def update_items(spark, sf):
    base = particles(spark, sf).select("position", "defocus_u")
    return sets.update_items(base, _halve_defocus, base.schema)


# Joins and set facts

@query("attach_latents", f"""{ctes('particles', 'latents')}
    SELECT position, particle_id, 'trainer' AS prog, 'weights.pkl' AS weights,
           {sql6('list_sum(z)')} AS z_sum, CAST(len(z) AS INT) AS zdim
    FROM particles JOIN latents USING (position)""")
def attach_latents(spark, sf):
    out = jobs.train_output(particles(spark, sf), view(spark, sf, "latents"), "trainer",
                            weights="weights.pkl", config="config.yaml")
    total = F.aggregate("z", F.lit(0.0), lambda s, x: s + x)
    return out.select("position", "particle_id", "prog", F.col("attrs.weights"), r6(total).alias("z_sum"),
                      F.size("z").alias("zdim"))


@query("attach_particle_latents", f"""{ctes('particles', 'particle_latents')}
    SELECT position, particle_id, {sql6('z[1]')} AS z0, {sql6('z[2]')} AS z1, {sql6('z[3]')} AS z2
    FROM particles JOIN particle_latents USING (position)""")
def attach_particle_latents(spark, sf):
    out = sets.attach_latents(particles(spark, sf), view(spark, sf, "particle_latents"), strict=True)
    return out.select("position", "particle_id", *[r6(F.get("z", F.lit(i))).alias(f"z{i}") for i in range(3)])


@query("subset", f"""{ctes('particles', 'index_list')}
    SELECT position, particle_id FROM particles WHERE position IN (SELECT position FROM index_list)""")
def subset(spark, sf):
    out = jobs.subset_particles(particles(spark, sf), view(spark, sf, "index_list"))
    return out.select("position", "particle_id")


@query("subset_summary", f"""{ctes('particles', 'index_list')}
    SELECT count(*) AS input_particles,
           count(*) FILTER (WHERE position IN (SELECT position FROM index_list)) AS selected_particles
    FROM particles""")
def subset_summary(spark, sf):
    base = particles(spark, sf)
    return sets.subset_summary(base, sets.subset(base, view(spark, sf, "index_list")))


@query("index_stats", f"""{ctes('index_list')}
    SELECT count(position) AS n_index, max(position) AS max_index FROM index_list""")
def index_stats(spark, sf):
    return sets.index_stats(view(spark, sf, "index_list"))


@query("set_info", f"""{ctes('particles')}
    SELECT event_type, count(*) AS size, max(box) AS box, max(apix) AS apix FROM particles GROUP BY 1""")
def set_info(spark, sf):
    return sets.set_info(particles(spark, sf), "event_type")


@query("pair_volumes", f"""{ctes('volumes')}
    SELECT vol_id, format('vol_{{:03d}}.mrc', vol_id) AS file, {sql6('list_sum(volume)')} AS z_sum FROM volumes""")
def pair_volumes(spark, sf):
    volumes = view(spark, sf, "volumes")
    files = volumes.select("vol_id", F.format_string(names.VOLUME_FILE, "vol_id").alias("file"))
    out = sets.pair_volumes(files, volumes.select("vol_id", F.col("volume").alias("z")))
    return out.select("vol_id", "file", r6(F.aggregate("z", F.lit(0.0), lambda s, x: s + x)).alias("z_sum"))


MISSING_SQL = """SELECT run_id, vol_id FROM
    (SELECT run_id, CAST(unnest(range(n)) AS INT) AS vol_id FROM expected_volumes) e
    WHERE NOT EXISTS (SELECT 1 FROM found_volumes f WHERE f.run_id = e.run_id AND f.vol_id = e.vol_id)"""


@query("missing_volumes", f"{ctes('expected_volumes', 'found_volumes')} {MISSING_SQL}")
def missing_volumes(spark, sf):
    return sets.missing_volumes(view(spark, sf, "expected_volumes"), view(spark, sf, "found_volumes"))


# Sources and sinks: written to the shared folder and read back

@query("star_round_trip", f"""{ctes('particles')}
    SELECT position, CAST(position % 500 + 1 AS INT) AS idx,
           concat('particles.64.', position // 500, '.mrcs') AS file, x, y, rot, tilt, psi, shift_x, shift_y
    FROM particles""")
def star_round_trip(spark, sf):
    path = _new_path(spark)
    star.write_star(position.stack_location(particles(spark, sf), 64, 500), path, with_alignment=True)
    back = star.particles_from_star(star.read_star(spark, path))
    return back.select("position", F.col("location.index").alias("idx"), F.col("location.file").alias("file"),
                       "coord.x", "coord.y", "transform.*")


# Three optics groups, and particles without a pose.
_OPTICS = """optics AS (
    SELECT position, CAST(256 + 64 * (position % 3) AS INT) AS box, 1.25e0 + (position % 3) AS apix, defocus_u, defocus_v,
           defocus_angle, 300e0 - 100 * (position % 2) AS voltage, spherical_aberration, amplitude_contrast,
           shift_x, shift_y, rot IS NOT NULL AS aligned FROM particles)"""


def _with_optics(spark, sf):
    table = position.stack_location(particles(spark, sf), 64, 500)
    third = F.col("position") % 3
    return table.withColumns({
        "box": (256 + 64 * third).cast("int"), "apix": 1.25 + third, "voltage": 300.0 - 100 * (F.col("position") % 2)})


@query("star_optics_ctf", f"""{ctes('particles')}, {_OPTICS}
    SELECT position, box, apix, {sql6('defocus_u')} AS defocus_u, {sql6('defocus_v')} AS defocus_v, defocus_angle, voltage,
           spherical_aberration, amplitude_contrast, 0e0 AS phase_shift FROM optics""")
def star_optics_ctf(spark, sf):
    """CTF parameters through a document of two blocks, joined by optics group."""
    path = _new_path(spark)
    star.write_star(_with_optics(spark, sf), path, with_alignment=False, optics=True)
    back = sets.parse_ctf(star.particles_from_star(star.read_particles(spark, path)))
    return back.withColumns({c: r6(c) for c in ("defocus_u", "defocus_v")})


@query("star_optics_poses", f"""{ctes('particles')}, {_OPTICS}
    SELECT position, aligned, {sql6('shift_x')} AS tx, {sql6('shift_y')} AS ty FROM optics""")
def star_optics_poses(spark, sf):
    """Shifts written in Å come back in pixels of each particle's group."""
    path = _new_path(spark)
    star.write_star(_with_optics(spark, sf), path, with_alignment=True, optics=True)
    back = star.particles_from_star(star.read_particles(spark, path, range_bytes=1 << 18))
    return sets.parse_poses(back).select(
        "position", F.col("translation").isNotNull().alias("aligned"),
        r6(F.get("translation", F.lit(0))).alias("tx"), r6(F.get("translation", F.lit(1))).alias("ty"))


@query("star_optics_groups", f"""{ctes('particles')}, {_OPTICS}
    SELECT CAST(row_number() OVER (ORDER BY box, apix, voltage) AS DOUBLE) AS optics_group, box, apix, voltage, particles
    FROM (SELECT CAST(box AS DOUBLE) AS box, apix, voltage, count(*) AS particles FROM optics GROUP BY ALL) g""")
def star_optics_groups(spark, sf):
    """Rows of the optics block, and particles of each; the particle block is read for one column."""
    path = _new_path(spark)
    star.write_star(_with_optics(spark, sf), path, with_alignment=False, optics=True)
    groups = star.read_star(spark, path, block=star.OPTICS_BLOCK)
    counts = star.read_star(spark, path, columns=[star.GROUP_LABEL]).groupBy(star.GROUP_LABEL).agg(F.count("*").alias("particles"))
    return groups.join(counts, star.GROUP_LABEL).select(
        F.col(star.GROUP_LABEL).alias("optics_group"), *[
            F.col(star.OPTICS_LABELS[c]).alias(c) for c in ("box", "apix", "voltage")], "particles")


@query("read_latents", f"""{ctes('latents')}
    SELECT position, CAST(i - 1 AS INT) AS i, v
    FROM (SELECT position, generate_subscripts(z, 1) AS i, unnest(z) AS v FROM latents) d""")
def read_latents(spark, sf):
    path = _new_path(spark)
    view(spark, sf, "latents").select("position", "z").write.parquet(path)
    return tables.read_latents(spark, path).select("position", F.posexplode("z").alias("i", "v"))


@query("attach_stored_latents", f"""{ctes('particles', 'particle_latents')}
    SELECT position, particle_id, {sql6('z[1]')} AS z0, {sql6('z[3]')} AS z2 FROM particles JOIN particle_latents USING (position)""")
def attach_stored_latents(spark, sf):
    """Particles and latents that are stored by position join bucket by bucket."""
    left, right = _new_path(spark), _new_path(spark)
    tables.write_by_position(particles(spark, sf), left, 8)
    tables.write_by_position(view(spark, sf, "particle_latents"), right, 8)
    out = sets.attach_latents(tables.read_by_position(spark, left), tables.read_by_position(spark, right))
    return out.select("position", "particle_id", r6(F.get("z", F.lit(0))).alias("z0"), r6(F.get("z", F.lit(2))).alias("z2"))


def _epoch_rows(spark, sf, which, number=None):
    path = _new_path(spark)
    epochs.write_epoch_latents(view(spark, sf, "run_latents"), path)
    out = epochs.epoch_latents(epochs.read_epoch_latents(spark, path), view(spark, sf, "run_artifacts"), which, number)
    return out.select("run_id", "epoch", "position", r6(F.get("z", F.lit(0))).alias("z0"), F.size("z").alias("zdim"))


_EPOCHS = f"{ctes('run_artifacts', 'run_latents')}, z AS (SELECT DISTINCT run_id, epoch FROM run_artifacts WHERE artifact = 'z')"
_EPOCH_ROWS = f"SELECT l.run_id, l.epoch, l.position, {sql6('l.z[1]')} AS z0, CAST(2 AS INT) AS zdim FROM run_latents l JOIN z ON z.run_id = l.run_id"


@query("epoch_latents_last", f"""{_EPOCHS}, last AS (
        SELECT run_id, max(epoch) AS epoch FROM run_artifacts WHERE artifact = 'weights' GROUP BY run_id)
    {_EPOCH_ROWS} AND z.epoch = l.epoch JOIN last ON last.run_id = l.run_id AND last.epoch = l.epoch""")
def epoch_latents_last(spark, sf):
    return _epoch_rows(spark, sf, "last")


@query("epoch_latents_selection", f"{_EPOCHS} {_EPOCH_ROWS} AND z.epoch = l.epoch WHERE l.epoch = 6")
def epoch_latents_selection(spark, sf):
    return _epoch_rows(spark, sf, "selection", 7)


@query("epoch_latents_final", f"{_EPOCHS} {_EPOCH_ROWS} AND z.epoch IS NULL WHERE l.epoch IS NULL")
def epoch_latents_final(spark, sf):
    return _epoch_rows(spark, sf, "final")


@query("index_bitmap", f"""{ctes('index_list')}
    SELECT 1 + position // 32768 AS bucket, count(DISTINCT position) AS positions FROM index_list WHERE position >= 0 GROUP BY 1""")
def index_bitmap(spark, sf):
    """Different positions of an index list, one bit each."""
    bitmap = sets.position_bitmap(view(spark, sf, "index_list"))
    return bitmap.select("bucket", F.bitmap_count("bits").alias("positions"))


@query("subset_by_ranges", f"""{ctes('particles', 'index_list')}
    SELECT position, particle_id FROM particles WHERE position IN (SELECT position FROM index_list)""")
def subset_by_ranges(spark, sf):
    """A bitmap over the size limit, taken in ranges of its buckets."""
    return sets.subset(particles(spark, sf), view(spark, sf, "index_list"), max_bytes=sets.BITMAP_ROW_BYTES).select(
        "position", "particle_id")


@query("z_text_round_trip", f"""{ctes('particle_latents')}
    SELECT position, z[1] AS z0, z[2] AS z1, z[3] AS z2, CAST(len(z) AS INT) AS zdim FROM particle_latents""")
def z_text_round_trip(spark, sf):
    path = _new_path(spark)
    text.write_z_text(view(spark, sf, "particle_latents"), path)
    return text.read_z_text(spark, path).select(
        "position", *[F.get("z", F.lit(i)).alias(f"z{i}") for i in range(3)], F.size("z").alias("zdim"))


@query("z_text_one_column", f"""{ctes('latent1')}
    SELECT position, z[1] AS z0, CAST(len(z) AS INT) AS zdim FROM latent1""")
def z_text_one_column(spark, sf):
    path = _new_path(spark)
    text.write_z_text(view(spark, sf, "latent1"), path)
    return text.read_z_text(spark, path).select(
        "position", F.get("z", F.lit(0)).alias("z0"), F.size("z").alias("zdim"))


@query("read_index", f"""{ctes('index_list')}
    SELECT source, position, count(*) AS n
    FROM index_list, (VALUES ('parquet'), ('text')) s(source) GROUP BY ALL""")
def read_index(spark, sf):
    index = view(spark, sf, "index_list")
    parquet, lines = _new_path(spark), _new_path(spark)
    index.write.parquet(parquet)
    index.select(F.col("position").cast("string")).write.text(lines)
    both = text.read_index(spark, parquet).withColumn("source", F.lit("parquet")).unionByName(
        text.read_index(spark, lines, "text").withColumn("source", F.lit("text")))
    return both.groupBy("source", "position").agg(F.count("*").alias("n"))


@query("volume_set", f"""{ctes('volumes')}
    SELECT vol_id, format('kmeans20/vol_{{:03d}}.mrc', vol_id) AS file, {sql6('list_sum(volume)')} AS z_sum,
           3.54e0 AS apix, 'volumes of all points' AS comment FROM volumes""")
def volume_set(spark, sf):
    path = _new_path(spark)
    file = F.format_string(names.KMEANS_VOLUME_FILE, F.lit(20), F.col("vol_id"))
    volumes = view(spark, sf, "volumes").select("vol_id", file.alias("file"), F.col("volume").alias("z"))
    tables.write_volume_set(volumes, path, 3.54, "volumes of all points")
    back = tables.read_volume_set(spark, path)
    return back.select("vol_id", "file", r6(F.aggregate("z", F.lit(0.0), lambda s, x: s + x)).alias("z_sum"),
                       "apix", "comment")


@query("state_lists", "SELECT label AS state, vec_id AS position FROM embeddings")
def state_lists(spark, sf):
    path = _new_path(spark)
    states = table(spark, sf, "embeddings").select(
        F.col("label").alias("state"), F.col("vec_id").alias("position"))
    tables.write_state_lists(states, path)
    return spark.read.parquet(path).select("state", "position")

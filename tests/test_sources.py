"""Files in and out."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from latentspark.operators import particles, position, runs
from latentspark.plans import jobs
from latentspark import session
from latentspark.session import build_session, working_dir
from latentspark.sources import artifacts, epochs, log, star, tables, text

STAR = """
# version 30001

data_optics

loop_
_rlnOpticsGroup #1
_rlnImagePixelSize #2
1 1.5
2 1.7

# another block
data_particles

loop_
_rlnImageName #1
_rlnAngleRot #2
_rlnMicrographName #3
"""


def test_star_with_two_blocks(spark, tmp_path):
    lines = [f"{i + 1:06d}@stack.mrcs {i * 1.5} mic_{i}.mrc" for i in range(50)]
    (tmp_path / "p.star").write_text(STAR + "\n".join(lines) + "\n\n")
    out = star.read_star(spark, str(tmp_path / "p.star")).orderBy("position").collect()
    assert [r["position"] for r in out] == list(range(50))
    assert [r["_rlnAngleRot"] for r in out] == [i * 1.5 for i in range(50)]
    assert out[7]["_rlnMicrographName"] == "mic_7.mrc"
    optics = star.read_star(spark, str(tmp_path / "p.star"), block="data_optics")
    assert sorted(r["_rlnImagePixelSize"] for r in optics.collect()) == [1.5, 1.7]


@pytest.mark.parametrize("size", [1, 37, 500, 2000, 1 << 20])
def test_star_in_small_byte_ranges(spark, tmp_path, size):
    lines = [f"{i + 1:06d}@stack.mrcs {i} mic_{i}.mrc" for i in range(120 if size > 1 else 6)]
    (tmp_path / "p.star").write_text(STAR + "\n".join(lines[:50]) + "\n\n# note\n" + "\n".join(lines[50:]))
    out = star.read_star(spark, str(tmp_path / "p.star"), numeric=["_rlnAngleRot"], range_bytes=size)
    rows = out.orderBy("position").collect()
    assert [r["_rlnAngleRot"] for r in rows] == [float(i) for i in range(len(lines))]
    assert [r["position"] for r in rows] == list(range(len(lines)))
    optics = star.read_star(spark, str(tmp_path / "p.star"), block="data_optics", range_bytes=size)
    assert sorted(tuple(r) for r in optics.collect()) == [(0, 1.0, 1.5), (1, 2.0, 1.7)]


def test_star_as_a_source(spark, tmp_path):
    """The data source alone, with a schema that prunes; no shuffle orders the records."""
    lines = [f"{i + 1:06d}@stack.mrcs {i * 1.5} mic_{i}.mrc" for i in range(40)]
    (tmp_path / "p.star").write_text(STAR + "\n".join(lines) + "\n")
    spark.dataSource.register(star.StarSource)
    whole = spark.read.format("star").option("range_bytes", "100").load(str(tmp_path / "p.star"))
    assert whole.columns == ["position", "_rlnImageName", "_rlnAngleRot", "_rlnMicrographName"] and whole.count() == 40
    some = spark.read.format("star").schema("_rlnAngleRot double").load(str(tmp_path / "p.star"))
    assert [r[0] for r in some.collect()] == [i * 1.5 for i in range(40)]
    assert spark.read.format("star").option("block", "data_optics").load(str(tmp_path / "p.star")).count() == 2
    table = star.read_star(spark, str(tmp_path / "p.star"), columns=["_rlnAngleRot"])
    assert table.columns == ["position", "_rlnAngleRot"]
    assert "Exchange" not in table._jdf.queryExecution().executedPlan().toString()


def test_star_words_and_labels(spark, tmp_path):
    """Missing words, numbers that are none, labels with a dot, two layouts, blocks without records."""
    (tmp_path / "p.star").write_text(
        "data_a\nloop_\n_x.y #1\n_rlnAngleRot #2\n_n\n1.0 2 3\n 4 x\t5 6 \n7\n nan inf -1e3\ndata_empty\nloop_\n_q #1\n")
    rows = star.read_star(spark, str(tmp_path / "p.star"), block="data_a").orderBy("position").collect()
    assert [(r["_x.y"], r["_rlnAngleRot"]) for r in rows][:3] == [(1.0, 2.0), (4.0, None), (7.0, None)]
    assert [r["_n"] for r in rows] == ["3", "5", None, "-1e3"] and rows[3]["_rlnAngleRot"] == float("inf")
    empty = star.read_star(spark, str(tmp_path / "p.star"), block="data_empty")
    assert empty.columns == ["position", "_q"] and empty.count() == 0
    with pytest.raises(ValueError):
        star.read_star(spark, str(tmp_path / "p.star"), block="data_none")


OPTICS = """data_optics

loop_
_rlnOpticsGroup #1
_rlnImagePixelSize #2
_rlnImageSize #3
_rlnVoltage #4
_rlnSphericalAberration #5
_rlnAmplitudeContrast #6
1 1.5 64 300 2.7 0.1
2 2.0 128 200 2.7 0.07

data_particles

loop_
_rlnImageName #1
_rlnAngleRot #2
_rlnAngleTilt #3
_rlnAnglePsi #4
_rlnOriginXAngst #5
_rlnOriginYAngst #6
_rlnDefocusU #7
_rlnDefocusV #8
_rlnDefocusAngle #9
_rlnOpticsGroup #10
000001@a.mrcs 1 2 3 3.0 -1.5 10000 11000 45 1
000002@a.mrcs 4 5 6 3.0 -1.0 12000 13000 30 2
000003@a.mrcs 7 8 9 3.0 -1.0 14000 15000 15 9
"""


def test_optics_and_units(spark, tmp_path):
    """Shifts in Å count as an alignment, in pixels of the optics group."""
    (tmp_path / "p.star").write_text(OPTICS)
    table = star.particles_from_star(star.read_particles(spark, str(tmp_path / "p.star")))
    rows = table.orderBy("position").collect()
    assert [(r.transform.shift_x, r.transform.shift_y) for r in rows[:2]] == [(2.0, -1.0), (1.5, -0.5)]
    assert rows[2].transform is None  # its optics group is not listed
    assert particles.has_alignment(table.where("position < 2")).first()[0]
    ctf = particles.parse_ctf(table).orderBy("position").collect()
    assert tuple(ctf[1])[1:] == (128, 2.0, 12000.0, 13000.0, 30.0, 200.0, 2.7, 0.07, 0.0)
    assert ctf[2].apix is None and ctf[2].defocus_u == 14000.0
    # Columns of particles that have none of it, and pixel size by detector and magnification.
    (tmp_path / "old.star").write_text(
        "data_\nloop_\n_rlnImageName\n_rlnDetectorPixelSize\n_rlnMagnification\n_rlnVoltage\n1@b.mrcs 14 50000 300\n")
    old = star.particles_from_star(star.read_particles(spark, str(tmp_path / "old.star"))).first()
    assert (old.apix, old.voltage, old.box, old.transform) == (2.8, 300.0, None, None)


@pytest.mark.parametrize("aligned", [True, False])
def test_optics_round_trip(spark, tmp_path, aligned):
    df = spark.sql("""
        SELECT id AS position, named_struct('index', CAST(id + 1 AS INT), 'file', 's.mrcs') AS location,
               if(id % 5 = 0, NULL, named_struct('rot', id / 7D, 'tilt', 0D, 'psi', 1D, 'shift_x', id * 0.5D, 'shift_y', -2D)) AS transform,
               CAST(64 * (1 + id % 2) AS INT) AS box, if(id % 2 = 0, 1.5D, 2D) AS apix, id * 10D AS defocus_u, id * 11D AS defocus_v,
               id % 180 * 1D AS defocus_angle, 300D AS voltage, 2.7D AS spherical_aberration, if(id % 7 = 0, NULL, 0.1D) AS amplitude_contrast
        FROM range(0, 700, 1, 6)""")
    star.write_star(df, str(tmp_path / "out"), with_alignment=aligned, optics=True)
    back = star.particles_from_star(star.read_particles(spark, str(tmp_path / "out"), range_bytes=3000)).orderBy("position").collect()
    want = df.orderBy("position").collect()
    assert len(back) == 700
    for a, b in zip(back, want):
        assert a.location == b.location and a.transform == (b.transform if aligned else None)
        for c in particles.CTF_COLUMNS:
            assert a[c] == b[c] or (b[c] is None and a[c] != a[c])
    assert star.read_star(spark, str(tmp_path / "out"), block=star.OPTICS_BLOCK).count() == 4


@pytest.mark.parametrize("aligned", [True, False])
def test_star_round_trip(spark, tmp_path, aligned):
    df = spark.sql("""
        SELECT id AS position, if(id % 3 = 0, NULL, named_struct('x', id * 1D, 'y', id * 2D)) AS coord,
               named_struct('rot', id / 7D, 'tilt', 0D, 'psi', 1D, 'shift_x', -id / 3D, 'shift_y', 2D) AS transform
        FROM range(0, 1000, 1, 6)""")
    df = position.stack_location(df, 64, 100)
    star.write_star(df, str(tmp_path / "out"), with_alignment=aligned)
    first = sorted((tmp_path / "out").glob("part-*"))[0].read_text().split("\n")
    assert first[1] == "data_particles" and first[3] == "loop_"
    back = star.particles_from_star(star.read_star(spark, str(tmp_path / "out")))
    want = df.select("position", "location", "coord", "transform")
    if not aligned:
        want = want.withColumn("transform", F.lit(None).cast(want.schema["transform"].dataType))
    assert back.select(want.columns).orderBy("position").collect() == want.orderBy("position").collect()


def test_z_text(spark, tmp_path):
    (tmp_path / "one.txt").write_text("1.5\n-2e3\n\n0\n")
    out = text.read_z_text(spark, str(tmp_path / "one.txt")).orderBy("position").collect()
    assert [tuple(r) for r in out] == [(0, [1.5]), (1, [-2000.0]), (2, [0.0])]
    (tmp_path / "row.txt").write_text("  1 2   3 \n")
    assert tuple(text.read_z_text(spark, str(tmp_path / "row.txt")).first()) == (0, [1.0, 2.0, 3.0])
    rows = [(i, [i / 3.0, -i / 7.0]) for i in range(500)]
    df = spark.createDataFrame(rows, "position bigint, z array<double>").repartition(5)
    text.write_z_text(df, str(tmp_path / "many"))
    back = text.read_z_text(spark, str(tmp_path / "many")).orderBy("position").collect()
    assert [tuple(r) for r in back] == rows


def test_index_text(spark, tmp_path):
    (tmp_path / "i.txt").write_text("3 1 1\n7\n")
    assert sorted(r[0] for r in text.read_index(spark, str(tmp_path / "i.txt"), "text").collect()) == [1, 1, 3, 7]


def test_list_artifacts(spark, tmp_path):
    out = tmp_path / "000012_train.0" / "extra" / "output"
    out.mkdir(parents=True)
    for name in ("weights.9.pkl", "weights.10.pkl", "weights.pkl", "z.10.pkl", "poses.pkl", "weights.1.txt"):
        (out / name).write_bytes(b"x")
    rows = artifacts.list_artifacts(spark, str(tmp_path)).select("run_id", "artifact", "epoch").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [(12, "weights", 9), (12, "weights", 10), (12, "weights", None), (12, "z", 10)], key=str)


def test_volume_set_is_replaced(spark, tmp_path):
    path = str(tmp_path / "v")
    df = spark.createDataFrame([(0, "a", [1.0]), (1, "b", [2.0])], "vol_id int, file string, z array<double>")
    tables.write_volume_set(df, path, 1.0)
    tables.write_volume_set(df.filter("vol_id = 1"), path, 2.5, "note")
    assert [tuple(r) for r in tables.read_volume_set(spark, path).collect()] == [(1, "b", [2.0], 2.5, "note")]
    with pytest.raises(TypeError):
        tables.write_volume_set(df.drop("z"), path, 1.0)


def test_state_lists(spark, tmp_path):
    df = spark.range(300).select((F.col("id") % 3).cast("int").alias("state"), F.col("id").alias("position"))
    tables.write_state_lists(df, str(tmp_path / "s"))
    one = tables.read_state_list(spark, str(tmp_path / "s"), 2)
    assert sorted(r[0] for r in one.collect()) == list(range(2, 300, 3))
    assert "PartitionFilters: [isnotnull(state" in one._jdf.queryExecution().executedPlan().toString()


def test_working_dir_follows_the_cluster_setting(spark):
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.checkpoint.dir": "hdfs:///shared/", "spark.master": "yarn"})

    assert working_dir(Session) == "hdfs:///shared"
    Session.conf = Conf({"spark.master": "yarn"})
    with pytest.raises(RuntimeError):
        working_dir(Session)
    assert working_dir(spark)
    assert build_session().sparkContext.applicationId == spark.sparkContext.applicationId


@pytest.mark.parametrize("first", ["data_01/m1.mrc", "_m1.mrc"])
def test_star_records_that_look_like_headers(spark, tmp_path, first):
    (tmp_path / "p.star").write_text(
        "data_particles\n\nloop_\n_rlnMicrographName #1\n_rlnAngleRot\n" + "\n".join(f"{first} {i}" for i in range(6)) + "\n")
    out = star.read_star(spark, str(tmp_path / "p.star")).orderBy("position").collect()
    assert [(r["_rlnMicrographName"], r["_rlnAngleRot"]) for r in out] == [(first, float(i)) for i in range(6)]


def test_log_commits_once_and_whole(spark, tmp_path):
    """A key counts once, a taken number is passed over, a killed write changes nothing, a replacement hides what was."""
    table = log.TableLog(spark, str(tmp_path / "t"), StructType.fromDDL("a int, b string"))
    rows = lambda: sorted(map(tuple, table.read().collect()))
    df = lambda *a: spark.createDataFrame([(i, f"r{i}") for i in a], "a int, b string")
    assert rows() == [] and table.append(df(1, 2), "one") and not table.append(df(9), "one")
    df(5).write.parquet(str(tmp_path / "t/data/left-over"))  # written, never committed
    assert rows() == [(1, "r1"), (2, "r2")]
    assert not table._rename(str(tmp_path / "t/commits/000000000000.json"), str(tmp_path / "t/commits/000000000000.json"))
    assert table.append(df(3), "two") and rows() == [(1, "r1"), (2, "r2"), (3, "r3")]
    assert table.replace(df(4), "three") and rows() == [(4, "r4")] and table.append(df(5), "four")
    assert rows() == [(4, "r4"), (5, "r5")] and [c["key"] for c in table.commits()] == ["one", "two", "three", "four"]
    with pytest.raises(TypeError):
        table.append(df(1).drop("b"), "five")
    bad = df(7).withColumn("b", F.raise_error(F.lit("killed")).cast("string"))
    with pytest.raises(Exception):
        table.append(bad, "six")
    assert rows() == [(4, "r4"), (5, "r5")]


def test_jobs_tell_the_lineage(spark, tmp_path):
    lineage = runs.lineage_log(spark, str(tmp_path / "lineage"))
    particles_of = spark.range(6).select(F.col("id").alias("position"))
    index = spark.createDataFrame([(1,), (4,)], "position bigint")
    for _ in range(2):
        out = jobs.subset_particles(particles_of, index, strict=True, origin=jobs.Origin(lineage, 2, 1))
        assert out.count() == 2
        jobs.preprocess(particles_of, 64, size=64, origin=jobs.Origin(lineage, 1, 0))
    assert sorted(map(tuple, lineage.read().collect())) == [(1, 0, "transform"), (2, 1, "transform")]
    found = runs.ancestors(lineage.read(), spark.createDataFrame([(2,)], "child bigint")).collect()
    assert {(r.ancestor, r.depth) for r in found} == {(1, 1), (0, 2)}
    for bad, message in (([(6,)], "past the end"), ([(0,)] * 7, "longer")):
        with pytest.raises(ValueError, match=message):
            jobs.subset_particles(particles_of, spark.createDataFrame(bad, "position bigint"), strict=True)
    with pytest.raises(Exception):
        runs.store_lineage(lineage, spark.createDataFrame([(1, 2, "guess")], "child bigint, parent bigint, kind string"), "x")
    assert lineage.read().count() == 2


def test_analysis_refuses_and_publishes_nothing(spark, tmp_path):
    rows = [(i, [float(i), float(i % 3)]) for i in range(30)]
    z = spark.createDataFrame(rows, "position bigint, z array<double>").withColumns({"run_id": F.lit(1).cast("bigint"), "epoch": F.lit(4)})
    epochs.write_epoch_latents(z.unionByName(z.withColumn("epoch", F.lit(None).cast("int"))), str(tmp_path / "z"))
    artifacts_of = spark.createDataFrame([(1, "weights", 4), (1, "z", 4), (1, "z", None)], "run_id bigint, artifact string, epoch int")
    run = spark.sql("""SELECT 1L AS run_id, 'train' AS kind, CAST(NULL AS STRING) AS abinitio_type, FALSE AS do_continue, CAST(NULL AS BIGINT) AS continue_run,
        5L AS input_set, 2 AS zdim, 20 AS num_epochs, 64 AS box, 2D AS apix, FALSE AS do_downsample, 32 AS vol_box, FALSE AS do_landscape,
        TRUE AS auto_mask, CAST(NULL AS INT) AS mask_box, 'last' AS epoch_choice, 1 AS epoch_number""")
    found = spark.range(3).select(F.lit(1).cast("bigint").alias("run_id"), F.col("id").cast("int").alias("vol_id"))
    table, out = epochs.read_epoch_latents(spark, str(tmp_path / "z")), str(tmp_path / "out")
    with pytest.raises(ValueError, match="volume box exceeds"):
        jobs.analyze_run(run.withColumns({"do_downsample": F.lit(True), "vol_box": F.lit(128)}), 1, artifacts_of, table, found, out, k=3)
    with pytest.raises(ValueError, match="volume 3 is missing"):
        jobs.analyze_run(run, 1, artifacts_of, table, found, out, k=4)
    assert not (tmp_path / "out").exists()
    for which in ("last", "final"):
        done = jobs.analyze_run(run, 1, artifacts_of, table, found, f"{out}-{which}", which=which, k=3)
        assert done.folder.endswith("analyze.4") and done.volumes.count() == 3 and done.warnings.count() == 0
        assert {r.apix for r in done.volumes.collect()} == {2.0}


def test_working_tables_are_deleted_on_request(spark):
    session.drop_tables(spark)
    kept = session.cut_lineage(spark.range(3))
    path = session._written[spark.conf.get("spark.app.id")][-1]
    assert kept.count() == 3 and os.path.isdir(path)
    assert session.drop_tables(spark) == 1 and not os.path.exists(path) and session.drop_tables(spark) == 0

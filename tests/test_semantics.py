"""Small hand-written tables, one per rule of behaviour."""

import random

import pytest
from pyspark.sql import functions as F

from latentspark.functions import scalars
from latentspark.operators import particles as sets
from latentspark.operators import position, rules, runs, voxels
from latentspark.plans import jobs
from latentspark.sources import epochs, tables


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def set_of(spark, n, **extra):
    df = spark.range(n).select(F.col("id").alias("position"), (F.col("id") * 7 + 3).alias("particle_id"))
    return df.withColumns({k: F.lit(v) for k, v in extra.items()})


def latents_of(spark, n):
    return spark.range(n).select(
        F.col("id").alias("position"), F.array(F.col("id").cast("double")).alias("z"))


@pytest.mark.parametrize("n_particles, n_latents", [(5, 3), (3, 5), (4, 4), (0, 3)])
def test_shorter_side_ends_the_set(spark, n_particles, n_latents):
    out = sets.attach_latents(set_of(spark, n_particles), latents_of(spark, n_latents))
    assert [r["position"] for r in out.orderBy("position").collect()] == list(
        range(min(n_particles, n_latents)))


def test_strict_raises_on_different_sizes(spark):
    with pytest.raises(ValueError):
        sets.attach_latents(set_of(spark, 5), latents_of(spark, 3), strict=True)
    assert sets.attach_latents(set_of(spark, 3), latents_of(spark, 3), strict=True).count() == 3


def index(spark, values):
    return spark.createDataFrame([(v,) for v in values], "position bigint")


def test_subset_uses_positions_and_ignores_repeats_negatives_and_overruns(spark):
    out = sets.subset(set_of(spark, 6), index(spark, [4, 1, 1, 1, -1, 99]))
    assert [r["particle_id"] for r in out.orderBy("position").collect()] == [10, 31]


def test_empty_index_selects_nothing_and_is_valid(spark):
    empty = index(spark, [])
    assert sets.subset(set_of(spark, 3), empty).count() == 0
    assert tuple(sets.subset_summary(set_of(spark, 3), sets.subset(set_of(spark, 3), empty)).first()) == (3, 0)
    stats = sets.index_stats(empty).withColumn("run_id", F.lit(1))
    size = spark.createDataFrame([(1, 3)], "run_id int, size bigint")
    assert rules.index_too_long(stats, size).count() == 0
    assert rules.index_out_of_range(stats, size).count() == 0


def test_index_length_counts_repeats(spark):
    stats = sets.index_stats(index(spark, [0, 0, 0, 2])).withColumn("run_id", F.lit(1))
    size = spark.createDataFrame([(1, 3)], "run_id int, size bigint")
    assert rows(rules.index_too_long(stats, size).select("rule")) == [("index_too_long",)]
    assert rules.index_out_of_range(stats, size).count() == 0
    stats = sets.index_stats(index(spark, [3])).withColumn("run_id", F.lit(1))
    assert rules.index_out_of_range(stats, size).count() == 1


@pytest.mark.parametrize("n, chunk, expected", [
    (0, 4, []), (3, 4, [(0, 3)]), (8, 4, [(0, 4), (1, 4)]), (9, 4, [(0, 4), (1, 4), (2, 1)]), (5, 0, [(0, 5)])])
def test_chunk_sizes(spark, n, chunk, expected):
    assert rows(position.chunk_sizes(set_of(spark, n), chunk)) == expected


def test_stack_location(spark):
    out = position.stack_location(set_of(spark, 5), 48, 2).orderBy("position")
    assert [(r["location"]["index"], r["location"]["file"]) for r in out.collect()] == [
        (1, "particles.48.0.mrcs"), (2, "particles.48.0.mrcs"), (1, "particles.48.1.mrcs"),
        (2, "particles.48.1.mrcs"), (1, "particles.48.2.mrcs")]
    whole = position.stack_location(set_of(spark, 2), 48, 0).orderBy("position")
    assert [(r["location"]["index"], r["location"]["file"]) for r in whole.collect()] == [
        (1, "particles.48.mrcs"), (2, "particles.48.mrcs")]


def artifacts(spark, epochs, run=1):
    return spark.createDataFrame(
        [(run, "weights", e, f"out/weights.{e}.pkl") for e in epochs] + [(run, "z", 77, "out/z.77.pkl"),
                                                                         (run, "weights", None, "out/weights.pkl")],
        "run_id bigint, artifact string, epoch int, path string")


@pytest.mark.parametrize("epochs, expected", [(range(10), 9), (range(20), 19), ([], None)])
def test_last_epoch_is_the_numeric_maximum(spark, epochs, expected):
    table = artifacts(spark, epochs)
    assert rows(runs.last_epoch(table)) == [(1, expected)]
    assert rows(runs.can_continue(table)) == [(1, expected is not None)]
    assert runs.latest_artifact(table).count() == (expected is not None)


def analysis_run(spark, **values):
    base = dict(run_id=1, kind="train", do_continue=False, continue_run=None, num_epochs=20, zdim=8,
                abinitio_type=None, box=128, do_scale=True, scale_size=64, has_alignment=True,
                epoch_choice="last", epoch_number=None, do_downsample=False, vol_box=64,
                do_landscape=True, auto_mask=True, mask_box=None, input_set=5)
    base.update(values)
    return spark.createDataFrame([tuple(base.values())], ", ".join(
        f"{k} {t}" for k, t in zip(base, (
            "bigint", "string", "boolean", "bigint", "int", "int", "string", "int", "boolean", "int",
            "boolean", "string", "int", "boolean", "int", "boolean", "boolean", "int", "bigint"))))


@pytest.mark.parametrize("number, findings", [(0, 1), (1, 0), (20, 0), (21, 1)])
def test_selected_epoch(spark, number, findings):
    run = analysis_run(spark, epoch_choice="selection", epoch_number=number)
    assert rules.epoch_out_of_range(run, artifacts(spark, range(20))).count() == findings


def test_selected_epoch_without_any_is_an_error(spark):
    run = analysis_run(spark, epoch_choice="selection", epoch_number=1)
    assert rules.epoch_out_of_range(run, artifacts(spark, [])).count() == 1
    assert rules.epoch_out_of_range(analysis_run(spark), artifacts(spark, [])).count() == 0


def test_continue_without_a_run_is_one_error(spark):
    run = analysis_run(spark, do_continue=True)
    assert rules.broken_continuation(run).count() == 1


@pytest.mark.parametrize("epochs, findings", [(20, 1), (19, 1), (21, 0)])
def test_continued_epochs_must_grow(spark, epochs, findings):
    both = analysis_run(spark).unionByName(
        analysis_run(spark, run_id=2, do_continue=True, continue_run=1, num_epochs=epochs))
    assert rules.broken_continuation(both).count() == findings


def test_continued_runs_are_followed_one_hop_or_to_the_end(spark):
    chain = (analysis_run(spark, run_id=1, zdim=2)
             .unionByName(analysis_run(spark, run_id=2, do_continue=True, continue_run=1, zdim=None))
             .unionByName(analysis_run(spark, run_id=3, do_continue=True, continue_run=2, zdim=None)))
    assert rows(runs.resolve_runs(chain).select("run_id", "zdim")) == [(1, 2), (2, 2), (3, None)]
    assert rows(runs.resolve_runs(chain, transitive=True).select("run_id", "zdim")) == [(1, 2), (2, 2), (3, 2)]


def test_chain_in_a_circle_is_an_error(spark):
    circle = (analysis_run(spark, run_id=1, do_continue=True, continue_run=2)
              .unionByName(analysis_run(spark, run_id=2, do_continue=True, continue_run=3))
              .unionByName(analysis_run(spark, run_id=3, do_continue=True, continue_run=1)))
    with pytest.raises(ValueError):
        runs.chain_roots(circle)


@pytest.mark.parametrize("size, expected", [
    (64, []), (130, ["box_not_multiple_of_8", "upscaled_box"]), (63, ["box_not_multiple_of_8", "odd_box"]),
    (50, ["box_not_multiple_of_8"]), (128, [])])
def test_box_rules(spark, size, expected):
    run = analysis_run(spark, scale_size=size)
    found = rules.validate(rules.upscaled_box(run), rules.odd_box(run), rules.box_not_multiple_of_8(run))
    assert sorted(r["rule"] for r in found.collect()) == expected


@pytest.mark.parametrize("kind, level", [("train", "error"), ("preprocess", "warning")])
def test_alignment_rule(spark, kind, level):
    assert rules.unaligned_input(analysis_run(spark, kind=kind)).count() == 0
    found = rules.unaligned_input(analysis_run(spark, kind=kind, has_alignment=False))
    assert [r["level"] for r in found.collect()] == [level]


@pytest.mark.parametrize("auto, mask, size_errors, unset_errors", [
    (True, 99, 0, 0), (False, 99, 1, 0), (False, 128, 0, 0), (False, None, 0, 1), (True, None, 0, 0)])
def test_mask_rules(spark, auto, mask, size_errors, unset_errors):
    run = analysis_run(spark, auto_mask=auto, mask_box=mask)
    assert rules.mask_size_mismatch(run).count() == size_errors
    assert rules.mask_unset(run).count() == unset_errors


@pytest.mark.parametrize("kind, zdim, findings", [
    ("homogeneous", 1, 0), ("homogeneous", 2, 1), ("heterogeneous", 1, 1), ("heterogeneous", 2, 0)])
def test_dimension_of_type(spark, kind, zdim, findings):
    run = analysis_run(spark, kind="abinitio", abinitio_type=kind, zdim=zdim)
    assert rules.dimension_of_type(run).count() == findings
    assert rules.homogeneous_analysis(run).count() == (kind == "homogeneous")
    assert rules.ignored_settings(run).count() == (zdim == 1)


@pytest.mark.parametrize("threshold, expected", [(-1.0, 4.0), (0.0, 4.0), (0.0009, 4.0), (0.001, 0.001)])
def test_small_thresholds_mean_automatic(spark, threshold, expected):
    table = spark.createDataFrame([(0, 0, 0, 0, 8.0), (0, 0, 0, 1, 1.0)], "vol_id int, z int, y int, x int, v double")
    assert rows(voxels.density_threshold(table, threshold)) == [(0, expected)]


def geometry(spark):
    return spark.sql("""
        SELECT 0L AS position, named_struct('x', 8D, 'y', 4D) AS coord,
               named_struct('rot', 1D, 'tilt', 2D, 'psi', 3D, 'shift_x', 2D, 'shift_y', -4D) AS transform,
               2D AS apix
        UNION ALL SELECT 1L, NULL, NULL, 2D""")


def test_rescaling_keeps_missing_parts_missing(spark):
    out = jobs.preprocess(geometry(spark), 128, size=64).orderBy("position").collect()
    assert tuple(out[0]["coord"]) == (4.0, 2.0)
    assert tuple(out[0]["transform"]) == (1.0, 2.0, 3.0, 1.0, -2.0)
    assert out[0]["apix"] == 4.0
    assert out[1]["coord"] is None and out[1]["transform"] is None


def test_same_box_leaves_rows_alone(spark):
    out = jobs.preprocess(geometry(spark), 128, do_scale=False)
    assert rows(out.drop("location")) == rows(geometry(spark))


def test_has_alignment(spark):
    assert sets.has_alignment(geometry(spark)).first()[0] is False
    assert sets.has_alignment(geometry(spark).filter("position = 0")).first()[0] is True
    assert sets.has_alignment(geometry(spark).filter("false")).first()[0] is False


def test_volume_without_z_row_is_an_error(spark):
    volumes = spark.createDataFrame([(0, "a"), (1, "b")], "vol_id int, file string")
    z = spark.createDataFrame([(0, [1.0])], "vol_id int, z array<double>")
    with pytest.raises(Exception, match="volume 1 has no z row"):
        sets.pair_volumes(volumes, z).collect()


def test_unknown_lineage_kind_is_an_error(spark):
    empty = spark.createDataFrame([], "child bigint, parent bigint, kind string")
    edge = spark.createDataFrame([(2, 1, "guess")], "child bigint, parent bigint, kind string")
    with pytest.raises(Exception, match="unknown lineage kind"):
        runs.record_lineage(empty, edge).collect()


def test_ancestors_of_one_set_in_a_graph_with_a_circle(spark):
    edges = spark.createDataFrame(
        [(4, 3, "source"), (3, 2, "source"), (4, 2, "source"), (2, 4, "source"), (9, 8, "source")],
        "child bigint, parent bigint, kind string")
    with pytest.raises(ValueError):
        runs.ancestors(edges)
    out = runs.ancestors(edges, spark.createDataFrame([(4,)], "child bigint"))
    assert rows(out) == [(4, 2, 1), (4, 3, 1), (4, 4, 2)]


@pytest.mark.parametrize("path, base, folder, ext", [
    ("a/b/vol_001.mrc", "vol_001.mrc", "a/b", ".mrc"), ("x.tar.gz", "x.tar.gz", "", ".gz"),
    ("a/.hidden", ".hidden", "a", ""), ("a/b/", "", "a/b", ""), ("plain", "plain", "", "")])
def test_path_parts(spark, path, base, folder, ext):
    p = F.lit(path)
    got = spark.range(1).select(scalars.base_name(p), scalars.dir_name(p), scalars.extension(p)).first()
    assert tuple(got) == (base, folder, ext)


@pytest.mark.parametrize("path, epoch", [
    ("run.0/output/weights.7.pkl", 7), ("weights.19.pkl", 19), ("weights.pkl", None),
    ("output/xweights.7.pkl", None), ("weights.3.pkl/other", None)])
def test_epoch_of(spark, path, epoch):
    assert spark.range(1).select(scalars.epoch_of(F.lit(path))).first()[0] == epoch


def test_update_items_and_attributes(spark):
    def double(batches):
        for batch in batches:
            batch["particle_id"] *= 2
            yield batch

    base = set_of(spark, 2)
    assert rows(sets.update_items(base, double, base.schema)) == [(0, 6), (1, 20)]
    out = sets.with_attrs(sets.with_attrs(base, {"weights": "a", "config": "c"}), {"weights": "b"})
    assert out.first()["attrs"] == {"config": "c", "weights": "b"}
    assert sets.copy_with(base).columns == base.columns


def test_abinitio_volume_keeps_pixel_size(spark):
    assert tuple(jobs.abinitio_volume("out", 1.5, set_of(spark, 1)).first()) == (0, "out/reconstruct.mrc", 1.5)


RUN_FIELDS = ("run_id bigint, kind string, abinitio_type string, do_continue boolean, continue_run bigint, "
              "input_set bigint, zdim int, num_epochs int")


def test_unset_parameters_have_the_defaults_of_the_kind(spark):
    table = spark.createDataFrame([
        (1, "train", None, False, None, 5, None, None),
        (2, "abinitio", "homogeneous", False, None, 5, None, None),
        (3, "train", None, True, 1, None, None, 20),
        (4, "train", None, True, 1, None, None, 21)], RUN_FIELDS)
    assert {r["run_id"]: r["multi_latent"] for r in runs.has_multi_latent(table).collect()} == dict.fromkeys(range(1, 5), True)
    assert rules.ignored_settings(table).count() == 0
    assert [r["run_id"] for r in rules.dimension_of_type(table).collect()] == [2]
    assert [r["run_id"] for r in rules.broken_continuation(table).collect()] == [3]


def test_bitmap_subset_does_not_shuffle_particles(spark):
    particles = spark.range(0, 300_000, 1, 4).select(F.col("id").alias("position"), F.lit("image").alias("image"))
    rng = random.Random(1)
    wanted = {rng.randrange(400_000) for _ in range(5000)} | {0, 7, 8, 63, 64, 32_767, 32_768, 65_535, 65_536, 299_999}
    listed = spark.createDataFrame([(p,) for p in [*wanted, *list(wanted)[:100], -1, -32_768, None, 10**15]], "position bigint")
    for limit in (sets.BROADCAST_BYTES, 3 * sets.BITMAP_ROW_BYTES, 1):
        out = sets.subset(particles, listed, limit)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "SinglePartition" not in plan
        assert sorted(r.position for r in out.collect()) == sorted(p for p in wanted if p < 300_000)
        assert out.columns == ["position", "image"]
    stats = sets.bitmap_stats(sets.position_bitmap(listed)).first()
    assert stats.positions == len(wanted) + 1
    assert tuple(sets.bitmap_stats(sets.position_bitmap(listed.limit(0))).first()) == (0, None)


def test_stored_latents_join_without_exchange(spark, tmp_path):
    particles = spark.range(2000).select(F.col("id").alias("position"), F.lit("p").alias("file"))
    latents = spark.range(500, 3000).select(F.col("id").alias("position"), F.array(F.col("id") * 1.0).alias("z"))
    tables.write_by_position(particles, str(tmp_path / "p"), 4)
    tables.write_by_position(latents, str(tmp_path / "z"), 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = sets.attach_latents(tables.read_by_position(spark, str(tmp_path / "p")), tables.read_by_position(spark, str(tmp_path / "z")))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert sorted((r.position, r.z) for r in out.collect()) == [(i, [float(i)]) for i in range(500, 2000)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_only_the_latest_epoch_is_read(spark, tmp_path):
    latents = spark.sql("SELECT r AS run_id, e AS epoch, p AS position, array(e * 1D) AS z FROM (SELECT explode(sequence(1L, 2L)) AS r), "
                        "(SELECT explode(array(0, 1, 2, 9, 10, NULL)) AS e), (SELECT explode(sequence(0L, 4L)) AS p)")
    epochs.write_epoch_latents(latents, str(tmp_path / "z"))
    rows = [(1, "weights", 9), (1, "weights", 2), (1, "z", 9), (1, "z", 10), (1, "z", None), (2, "weights", 1), (2, "z", 1), (3, "weights", 0)]
    artifacts = spark.createDataFrame(rows, "run_id bigint, artifact string, epoch int")
    table = epochs.read_epoch_latents(spark, str(tmp_path / "z"))
    last = epochs.epoch_latents(table, artifacts)
    assert "dynamicpruningexpression" in last._jdf.queryExecution().executedPlan().toString()
    found = last.withColumn("file", F.input_file_name()).collect()
    assert sorted((r.run_id, r.epoch, r.position) for r in found) == [(r, e, p) for r, e in ((1, 9), (2, 1)) for p in range(5)]
    scan = [n for n in last._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in n or "Scan parquet" in n]
    assert any("dynamicpruning" in n for n in scan)
    chosen = epochs.epoch_latents(table, artifacts, "selection", 2).collect()
    assert {(r.run_id, r.epoch) for r in chosen} == {(2, 1)}
    final = epochs.epoch_latents(table, artifacts, "final")
    assert {(r.run_id, r.epoch) for r in final.collect()} == {(1, None)}
    assert "isnull(epoch" in final._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        epochs.epoch_latents(table, artifacts, "first")

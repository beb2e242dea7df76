"""Queries on runs, epochs, lineage, data checks and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import ARTIFACTS_CTE, artifacts, ctes, table, view
from catalog.registry import query
from catalog.sets import MISSING_SQL
from latentspark.functions import names
from latentspark.functions import scalars as fn
from latentspark.operators import particles as sets
from latentspark.operators import rules, runs
from latentspark.schemas import LINEAGE

RUNS = ctes("runs")
ARTS = f"{ctes('artifact_paths')}, {ARTIFACTS_CTE}"
RUNS_ARTS = f"{ctes('runs', 'artifact_paths')}, {ARTIFACTS_CTE}"
RESOLVED = """resolved AS (
    SELECT r.run_id, r.kind, r.do_continue, r.num_epochs, s.run_id IS NOT NULL AND s.run_id <> r.run_id AS inherits,
           coalesce(CASE WHEN r.do_continue THEN r.continue_run END, r.run_id) AS resolved_run,
           CASE WHEN inherits THEN s.zdim ELSE r.zdim END AS zdim,
           CASE WHEN inherits THEN s.input_set ELSE r.input_set END AS input_set,
           CASE WHEN inherits THEN s.abinitio_type ELSE r.abinitio_type END AS abinitio_type
    FROM runs r LEFT JOIN runs s
      ON s.run_id = coalesce(CASE WHEN r.do_continue THEN r.continue_run END, r.run_id))"""
LAST = """last AS (
    SELECT run_id, max(CASE WHEN artifact = 'weights' THEN epoch END) AS last_epoch
    FROM artifacts GROUP BY run_id)"""


# Runs and epochs

@query("resolve_runs", f"""{RUNS}, {RESOLVED}
    SELECT run_id, resolved_run, zdim, input_set, abinitio_type FROM resolved""")
def resolve_runs(spark, sf):
    return runs.resolve_runs(view(spark, sf, "runs")).select(
        "run_id", "resolved_run", "zdim", "input_set", "abinitio_type")


@query("resolve_runs_chain", f"""{RUNS}, walk AS (
        SELECT run_id, CASE WHEN do_continue THEN continue_run END AS up, run_id AS root FROM runs
        UNION ALL
        SELECT w.run_id, CASE WHEN r.do_continue THEN r.continue_run END, r.run_id
        FROM walk w JOIN runs r ON r.run_id = w.up)
    SELECT w.run_id, w.root AS resolved_run, r.zdim
    FROM walk w JOIN runs r ON r.run_id = w.root WHERE w.up IS NULL""")
def resolve_runs_chain(spark, sf):
    return runs.resolve_runs(view(spark, sf, "runs"), transitive=True).select("run_id", "resolved_run", "zdim")


@query("artifact_names", f"{ARTS} SELECT run_id, artifact, epoch, path FROM artifacts")
def artifact_names(spark, sf):
    return artifacts(spark, sf)


@query("last_epoch", f"{ARTS}, {LAST} SELECT * FROM last")
def last_epoch(spark, sf):
    return runs.last_epoch(artifacts(spark, sf))


@query("latest_artifact", f"""{ARTS}
    SELECT run_id, artifact, epoch, path FROM artifacts WHERE artifact = 'weights' AND epoch IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY epoch DESC, path DESC) = 1""")
def latest_artifact(spark, sf):
    return runs.latest_artifact(artifacts(spark, sf))


@query("can_continue", f"""{ARTS}, {LAST}
    SELECT run_id, last_epoch IS NOT NULL AS can_continue FROM last""")
def can_continue(spark, sf):
    return runs.can_continue(artifacts(spark, sf))


@query("select_epoch_last", f"""{ARTS}, {LAST}
    SELECT a.run_id, a.artifact, a.epoch, a.path FROM artifacts a JOIN last l
      ON l.run_id = a.run_id AND l.last_epoch = a.epoch""")
def select_epoch_last(spark, sf):
    return runs.select_epoch(artifacts(spark, sf)).select("run_id", "artifact", "epoch", "path")


@query("select_epoch_number", f"{ARTS} SELECT run_id, artifact, epoch, path FROM artifacts WHERE epoch = 11")
def select_epoch_number(spark, sf):
    return runs.select_epoch(artifacts(spark, sf), "selection", 12)


@query("volume_sampling", f"""{RUNS}
    SELECT run_id, CASE WHEN do_downsample THEN box / vol_box * apix ELSE apix END AS vol_apix FROM runs""")
def volume_sampling(spark, sf):
    return runs.volume_sampling(view(spark, sf, "runs")).select("run_id", "vol_apix")


@query("has_multi_latent", f"""{RUNS}, {RESOLVED}
    SELECT run_id, coalesce(coalesce(zdim, CASE WHEN kind IN ('train', 'abinitio') THEN 8 END) > 1, false) AS multi_latent FROM resolved""")
def has_multi_latent(spark, sf):
    return runs.has_multi_latent(view(spark, sf, "runs"))


@query("landscape_dim", f"{ctes('volumes')} SELECT CAST(least(count(*), 20) AS INT) AS pc_dim FROM volumes")
def landscape_dim(spark, sf):
    return runs.landscape_dim(view(spark, sf, "volumes"))


_DEFAULTED = """coalesce(zdim, CASE WHEN kind IN ('train', 'abinitio') THEN 8 END) AS zdim,
    coalesce(num_epochs, CASE kind WHEN 'train' THEN 20 WHEN 'abinitio' THEN 30 END) AS num_epochs"""


@query("effective_params", f"{RUNS} SELECT run_id, {_DEFAULTED} FROM runs")
def effective_params(spark, sf):
    return runs.effective_params(view(spark, sf, "runs")).select("run_id", "zdim", "num_epochs")


@query("run_summary", f"""{RUNS}, {RESOLVED}
    SELECT run_id, CASE kind
        WHEN 'abinitio' THEN concat('Ab initio training (', abinitio_type, '), ', coalesce(num_epochs, 30), ' epochs')
        ELSE concat('Training, ', coalesce(num_epochs, 20), ' epochs') END AS summary
    FROM resolved WHERE kind IN ('train', 'abinitio')""")
def run_summary(spark, sf):
    return runs.run_summary(view(spark, sf, "runs"))


@query("record_lineage", f"{ctes('lineage')} SELECT child, parent, kind FROM lineage")
def record_lineage(spark, sf):
    return runs.record_lineage(spark.createDataFrame([], LINEAGE), view(spark, sf, "lineage"))


@query("ancestors", f"""{ctes('lineage')}, up AS (
        SELECT child, parent AS ancestor, 1 AS depth FROM lineage
        UNION ALL SELECT u.child, l.parent, u.depth + 1 FROM up u JOIN lineage l ON l.child = u.ancestor)
    SELECT child, ancestor, min(depth) AS depth FROM up GROUP BY 1, 2""")
def ancestors(spark, sf):
    return runs.ancestors(view(spark, sf, "lineage"), every=True)


# Data checks: every query gives (run_id, level, rule), the messages are free text

def _rule(name: str, sql: str):
    return query(f"rule_{name}", sql)


def _plain(df):
    return df.select("run_id", "level", "rule")


_TARGET = "CASE WHEN do_scale THEN scale_size ELSE box END"


@_rule("upscaled_box", f"""{RUNS} SELECT run_id, 'error' AS level, 'upscaled_box' AS rule FROM runs
    WHERE do_scale AND scale_size > box""")
def rule_upscaled_box(spark, sf):
    return _plain(rules.upscaled_box(view(spark, sf, "runs")))


@_rule("odd_box", f"""{RUNS} SELECT run_id, 'error' AS level, 'odd_box' AS rule FROM runs
    WHERE {_TARGET} % 2 <> 0""")
def rule_odd_box(spark, sf):
    return _plain(rules.odd_box(view(spark, sf, "runs")))


@_rule("box_not_multiple_of_8", f"""{RUNS}
    SELECT run_id, 'warning' AS level, 'box_not_multiple_of_8' AS rule FROM runs WHERE {_TARGET} % 8 <> 0""")
def rule_multiple_of_8(spark, sf):
    return _plain(rules.box_not_multiple_of_8(view(spark, sf, "runs")))


@_rule("unaligned_input", f"""{RUNS}
    SELECT run_id, CASE kind WHEN 'train' THEN 'error' ELSE 'warning' END AS level,
           'unaligned_input' AS rule
    FROM runs WHERE NOT has_alignment AND kind IN ('train', 'preprocess')""")
def rule_unaligned(spark, sf):
    return _plain(rules.unaligned_input(view(spark, sf, "runs")))


@_rule("broken_continuation", f"""{RUNS}
    SELECT r.run_id, 'error' AS level, 'broken_continuation' AS rule FROM runs r LEFT JOIN runs p
      ON p.run_id = r.continue_run
    WHERE r.do_continue AND (r.continue_run IS NULL OR coalesce(r.num_epochs, CASE r.kind WHEN 'train' THEN 20 WHEN 'abinitio' THEN 30 END)
           <= coalesce(p.num_epochs, CASE p.kind WHEN 'train' THEN 20 WHEN 'abinitio' THEN 30 END))""")
def rule_continuation(spark, sf):
    return _plain(rules.broken_continuation(view(spark, sf, "runs")))


INDEX_CTES = f"""{ctes('found_volumes', 'expected_volumes')},
    stats AS (SELECT run_id, count(vol_id) AS n_index, max(vol_id) AS max_index FROM found_volumes GROUP BY 1),
    sets AS (SELECT run_id, CAST(n AS BIGINT) AS size FROM expected_volumes)"""


def _index_stats(spark, sf):
    index = view(spark, sf, "found_volumes").withColumnRenamed("vol_id", "position")
    sizes = view(spark, sf, "expected_volumes").select("run_id", F.col("n").cast("bigint").alias("size"))
    return sets.index_stats(index, "run_id"), sizes


@_rule("index_too_long", f"""{INDEX_CTES}
    SELECT run_id, 'error' AS level, 'index_too_long' AS rule FROM stats JOIN sets USING (run_id)
    WHERE n_index > size""")
def rule_index_too_long(spark, sf):
    return _plain(rules.index_too_long(*_index_stats(spark, sf)))


@_rule("index_out_of_range", f"""{INDEX_CTES}
    SELECT run_id, 'error' AS level, 'index_out_of_range' AS rule FROM stats JOIN sets USING (run_id)
    WHERE max_index > size - 1""")
def rule_index_out_of_range(spark, sf):
    return _plain(rules.index_out_of_range(*_index_stats(spark, sf)))


@_rule("epoch_out_of_range", f"""{RUNS_ARTS}, {LAST}
    SELECT run_id, 'error' AS level, 'epoch_out_of_range' AS rule FROM runs LEFT JOIN last USING (run_id)
    WHERE epoch_choice = 'selection'
      AND (last_epoch IS NULL OR epoch_number < 1 OR epoch_number - 1 > last_epoch)""")
def rule_epoch(spark, sf):
    return _plain(rules.epoch_out_of_range(view(spark, sf, "runs"), artifacts(spark, sf)))


@_rule("upscaled_volume", f"""{RUNS}
    SELECT run_id, 'error' AS level, 'upscaled_volume' AS rule FROM runs
    WHERE do_downsample AND vol_box > box""")
def rule_upscaled_volume(spark, sf):
    return _plain(rules.upscaled_volume(view(spark, sf, "runs")))


@_rule("mask_size_mismatch", f"""{RUNS}
    SELECT run_id, 'error' AS level, 'mask_size_mismatch' AS rule FROM runs
    WHERE do_landscape AND NOT auto_mask
      AND mask_box <> CASE WHEN do_downsample THEN vol_box ELSE box END""")
def rule_mask_size(spark, sf):
    return _plain(rules.mask_size_mismatch(view(spark, sf, "runs")))


@_rule("mask_unset", f"""{RUNS}
    SELECT run_id, 'error' AS level, 'mask_unset' AS rule FROM runs
    WHERE do_landscape AND NOT auto_mask AND mask_box IS NULL""")
def rule_mask_unset(spark, sf):
    return _plain(rules.mask_unset(view(spark, sf, "runs")))


@_rule("homogeneous_analysis", f"""{RUNS}, {RESOLVED}
    SELECT run_id, 'error' AS level, 'homogeneous_analysis' AS rule FROM resolved
    WHERE kind = 'abinitio' AND abinitio_type = 'homogeneous'""")
def rule_homogeneous(spark, sf):
    return _plain(rules.homogeneous_analysis(view(spark, sf, "runs")))


@_rule("dimension_of_type", f"""{RUNS}
    SELECT run_id, 'error' AS level, 'dimension_of_type' AS rule FROM runs
    WHERE NOT do_continue AND kind = 'abinitio'
      AND (abinitio_type = 'homogeneous' AND coalesce(zdim, CASE WHEN kind IN ('train', 'abinitio') THEN 8 END) > 1 OR abinitio_type = 'heterogeneous' AND coalesce(zdim, CASE WHEN kind IN ('train', 'abinitio') THEN 8 END) = 1)""")
def rule_dimension(spark, sf):
    return _plain(rules.dimension_of_type(view(spark, sf, "runs")))


@_rule("ignored_settings", f"""{RUNS}, {RESOLVED}
    SELECT run_id, 'warning' AS level, 'ignored_settings' AS rule FROM resolved
    WHERE NOT coalesce(coalesce(zdim, CASE WHEN kind IN ('train', 'abinitio') THEN 8 END) > 1, false)""")
def rule_ignored(spark, sf):
    return _plain(rules.ignored_settings(view(spark, sf, "runs")))


@_rule("missing_volume_files", f"""{ctes('expected_volumes', 'found_volumes')}
    SELECT run_id, 'error' AS level, 'missing_volume_files' AS rule FROM ({MISSING_SQL}) m""")
def rule_missing_volumes(spark, sf):
    return _plain(rules.missing_volume_files(
        view(spark, sf, "expected_volumes"), view(spark, sf, "found_volumes")))


@_rule("non_positive_size", f"""{RUNS}
    SELECT run_id, 'error' AS level, 'non_positive_size' AS rule FROM runs WHERE zdim <= 0 UNION ALL
    SELECT run_id, 'error', 'non_positive_size' FROM runs WHERE do_scale AND scale_size <= 0""")
def rule_non_positive(spark, sf):
    return _plain(rules.non_positive_size(view(spark, sf, "runs")))


@query("validate", f"""{RUNS}
    SELECT level, rule, count(*) AS findings FROM (
        SELECT 'error' AS level, 'upscaled_box' AS rule FROM runs WHERE do_scale AND scale_size > box UNION ALL
        SELECT 'error', 'odd_box' FROM runs WHERE {_TARGET} % 2 <> 0 UNION ALL
        SELECT 'warning', 'box_not_multiple_of_8' FROM runs WHERE {_TARGET} % 8 <> 0) f
    GROUP BY 1, 2""")
def validate(spark, sf):
    table_ = view(spark, sf, "runs")
    found = rules.validate(
        rules.upscaled_box(table_), rules.odd_box(table_), rules.box_not_multiple_of_8(table_))
    return found.groupBy("level", "rule").agg(F.count("*").alias("findings"))


# Scalar functions

@query("numbered_names", """
    SELECT p_partkey, format('vol_{:03d}.mrc', p_partkey) AS volume, concat('z.', p_size, '.pkl') AS latent,
           concat('kmeans', p_size, '/', format('vol_{:03d}.mrc', p_partkey)) AS centre_volume,
           concat('analyze.', p_size) AS folder FROM part""")
def numbered_names(spark, sf):
    key, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf, "part").select(
        "p_partkey", fn.numbered_name(names.VOLUME_FILE, key).alias("volume"),
        fn.numbered_name(names.LATENT_EPOCH_FILE, size).alias("latent"),
        fn.numbered_name(names.KMEANS_VOLUME_FILE, size, key).alias("centre_volume"),
        fn.numbered_name(names.ANALYSIS_DIR, size).alias("folder"))


@query("epoch_of_name", rf"""{ctes('artifact_paths')}
    SELECT path, TRY_CAST(regexp_extract(path, '/weights\.(\d+)\.pkl$', 1) AS INT) AS epoch
    FROM artifact_paths""")
def epoch_of_name(spark, sf):
    return view(spark, sf, "artifact_paths").select("path", fn.epoch_of(F.col("path")).alias("epoch"))


@query("path_parts", r"""
    SELECT page_id, regexp_replace(url, '^.*/', '') AS name, regexp_extract(url, '^(.*)/[^/]*$', 1) AS folder,
           regexp_extract(regexp_replace(url, '^.*/', ''), '^.+(\.[^.]*)$', 1) AS ext,
           CASE WHEN starts_with(url, 'http:/') THEN substr(url, 7) ELSE url END AS below
    FROM pages""")
def path_parts(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", fn.base_name(url).alias("name"), fn.dir_name(url).alias("folder"),
        fn.extension(url).alias("ext"), fn.relative_path(url, F.lit("http:")).alias("below"))


@query("enum_labels", f"""{RUNS}
    SELECT run_id, CASE linkage_code WHEN 0 THEN 'average' WHEN 1 THEN 'ward' END AS linkage,
           CASE epoch_code WHEN 0 THEN 'last' WHEN 1 THEN 'selection' END AS epoch FROM runs""")
def enum_labels(spark, sf):
    return view(spark, sf, "runs").select(
        "run_id", fn.enum_label(F.col("linkage_code"), names.LINKAGE_CHOICES).alias("linkage"),
        fn.enum_label(F.col("epoch_code"), names.EPOCH_CHOICES).alias("epoch"))


@query("quotient_remainder", """
    SELECT event_id, event_id // 200 AS q, event_id % 200 AS r, event_id % 2 = 0 AS even,
           event_id % 8 = 0 AS by_8 FROM events""")
def quotient_remainder(spark, sf):
    n = F.col("event_id")
    return table(spark, sf, "events").select(
        "event_id", fn.quotient(n, F.lit(200)).alias("q"), fn.remainder(n, F.lit(200)).alias("r"),
        fn.is_even(n).alias("even"), fn.is_multiple(n, 8).alias("by_8"))


@query("array_building", """
    SELECT p_partkey, array_to_string(list_concat(range(p_size), list_transform(range(p_size), lambda i: p_partkey)), ',') AS items
    FROM part""")
def array_building(spark, sf):
    filled = fn.constant_fill(F.col("p_partkey"), F.col("p_size"))
    both = fn.concat_arrays(F.array(fn.int_range(F.col("p_size")), filled))
    return table(spark, sf, "part").select("p_partkey", fn.vector_to_csv(both).alias("items"))


@query("vector_text", """
    SELECT s_suppkey, s_acctbal AS first, CAST(1 AS INT) AS width, s_nationkey + 0e0 AS second FROM supplier""")
def vector_text(spark, sf):
    pair = F.array(F.col("s_acctbal"), F.col("s_nationkey").cast("double"))
    back = fn.csv_to_vector(fn.vector_to_csv(pair))
    return table(spark, sf, "supplier").select(
        "s_suppkey", F.get(back, F.lit(0)).alias("first"),
        F.size(fn.as_vector(F.col("s_acctbal"))).alias("width"), F.get(back, F.lit(1)).alias("second"))


@query("clamp_and_flags", f"""{RUNS}
    SELECT run_id, least(num_vols, 20) AS dim, CASE WHEN do_downsample THEN vol_box END AS box,
           coalesce(linkage_code IN (0, 1), false) AS known FROM runs""")
def clamp_and_flags(spark, sf):
    return view(spark, sf, "runs").select(
        "run_id", fn.clamp(F.col("num_vols"), 20).alias("dim"),
        fn.optional_value(F.col("do_downsample"), F.col("vol_box")).alias("box"),
        fn.member_of(F.col("linkage_code"), [0, 1]).alias("known"))

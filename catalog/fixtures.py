"""Inputs of the registered queries, derived from the whole given tables.

Each view is one SQL text; ``VECTOR`` marks what the two dialects write differently.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

_SPARK = {"VECTOR": "ARRAY<DOUBLE>", "[[": "array(", "]]": ")", "FIRST_EIGHT": "slice(embedding, 1, 8)"}
_DUCK = {"VECTOR": "DOUBLE[]", "[[": "[", "]]": "]", "FIRST_EIGHT": "embedding[1:8]"}

VIEWS = {
    # Particles: ids are not consecutive; errors have no coordinate, clicks no transform.
    "particles": """
        SELECT event_id AS position, event_id * 7 + 3 AS particle_id, user_id AS micrograph_id,
               CASE WHEN event_type <> 'error' THEN CAST(event_id % 4096 AS DOUBLE) END AS x,
               CASE WHEN event_type <> 'error' THEN CAST((event_id * 13) % 4096 AS DOUBLE) END AS y,
               CASE WHEN event_type <> 'click' THEN CAST((event_id * 37) % 360 AS DOUBLE) END AS rot,
               CASE WHEN event_type <> 'click' THEN CAST((event_id * 11) % 181 AS DOUBLE) END AS tilt,
               CASE WHEN event_type <> 'click' THEN CAST((event_id * 53) % 360 AS DOUBLE) END AS psi,
               CASE WHEN event_type <> 'click' THEN value / 10e0 END AS shift_x,
               CASE WHEN event_type <> 'click' THEN -value / 10e0 END AS shift_y,
               256 AS box, 1.25e0 AS apix, value * 40e0 + 5000e0 AS defocus_u,
               value * 41e0 + 5000e0 AS defocus_v, CAST(event_id % 180 AS DOUBLE) AS defocus_angle,
               300e0 AS voltage, 2.7e0 AS spherical_aberration, 0.1e0 AS amplitude_contrast,
               event_type
        FROM events""",
    "index_list": "SELECT l_partkey AS position FROM lineitem",
    "latents": "SELECT vec_id AS position, label, CAST(embedding AS VECTOR) AS z FROM embeddings",
    "latents8": "SELECT vec_id AS position, CAST(FIRST_EIGHT AS VECTOR) AS z FROM embeddings",
    "particle_latents": """
        SELECT event_id AS position, [[value / 100e0, user_id / 50e0, hour(ts) / 8e0]] AS z
        FROM events""",
    "latent1": "SELECT event_id AS position, [[value]] AS z FROM events",
    "points2d": "SELECT event_id AS position, value AS u, CAST(user_id AS DOUBLE) AS v FROM events",
    "supplier_centres": """
        SELECT CAST(s_suppkey AS INT) AS centre_id,
               [[s_acctbal / 2000e0, s_nationkey / 8e0, s_suppkey / 30e0]] AS z
        FROM supplier""",
    "artifact_paths": """
        SELECT l_orderkey AS run_id,
               concat('/project/', lpad(CAST(l_orderkey AS VARCHAR(20)), 9, '0'), '_run/extra/output/',
                      CASE WHEN l_returnflag = 'R' THEN 'z' ELSE 'weights' END,
                      CASE WHEN l_quantity < 50 THEN concat('.', CAST(CAST(l_quantity AS INT) AS VARCHAR(20)))
                           ELSE '' END, '.pkl') AS path
        FROM lineitem""",
    # Artifacts and latents of four runs, twelve epochs and the end.
    "run_artifacts": """
        SELECT CAST(l_suppkey % 4 AS BIGINT) AS run_id,
               CASE WHEN l_returnflag = 'R' AND l_quantity < 45 THEN 'weights' ELSE 'z' END AS artifact,
               CASE WHEN l_quantity < 48 THEN CAST(l_quantity / 4 AS INT) END AS epoch
        FROM lineitem""",
    "run_latents": """
        SELECT CAST(o_custkey % 4 AS BIGINT) AS run_id, CASE WHEN o_orderkey % 13 < 12 THEN CAST(o_orderkey % 13 AS INT) END AS epoch,
               CAST(floor(o_orderkey / 13e0) AS BIGINT) AS position, [[o_totalprice / 1000e0, o_orderkey / 7e0]] AS z
        FROM orders""",
    "runs": """
        SELECT run_id, kind, abinitio_type, do_continue, continue_run,
               CASE WHEN NOT do_continue THEN o_custkey END AS input_set,
               CASE WHEN NOT do_continue AND run_id % 5 <> 4 THEN CAST(run_id % 4 AS INT) END AS zdim,
               CASE WHEN run_id % 7 <> 0 THEN CAST(run_id % 50 AS INT) END AS num_epochs,
               CAST(100 + o_custkey % 57 AS INT) AS box, 1e0 + (o_custkey % 10) / 10e0 AS apix,
               o_totalprice > 100000 AS do_scale, CAST(run_id % 160 AS INT) AS scale_size,
               o_custkey % 3 <> 0 AS has_alignment,
               CAST(run_id % 2 AS INT) AS epoch_code,
               CASE WHEN run_id % 2 = 1 THEN 'selection' ELSE 'last' END AS epoch_choice,
               CAST(run_id % 60 AS INT) AS epoch_number,
               o_totalprice > 250000 AS do_downsample, CAST(90 + run_id % 60 AS INT) AS vol_box,
               o_custkey % 4 <> 0 AS do_landscape, run_id % 3 = 0 AS auto_mask,
               CASE WHEN run_id % 5 <> 0 THEN CAST(100 + o_custkey % 57 + run_id % 2 AS INT) END AS mask_box,
               CAST(run_id % 3 AS INT) AS linkage_code, CAST(1 + run_id % 600 AS INT) AS num_vols
        FROM (SELECT o_orderkey AS run_id, o_custkey, o_totalprice,
                     CASE o_orderstatus WHEN 'F' THEN 'train' WHEN 'O' THEN 'abinitio'
                          ELSE 'preprocess' END AS kind,
                     CASE WHEN o_custkey % 2 = 0 THEN 'homogeneous' ELSE 'heterogeneous' END AS abinitio_type,
                     o_orderpriority IN ('1-URGENT', '2-HIGH') AS do_continue,
                     CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey > 0
                          THEN CAST(floor(o_orderkey / 10e0) AS BIGINT) END AS continue_run
              FROM orders) o""",
    "lineage": """
        SELECT c_custkey AS child, CAST(floor(c_custkey / 2e0) AS BIGINT) AS parent,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'transform' ELSE 'source' END AS kind
        FROM customer WHERE c_custkey > 0""",
    "expected_volumes": "SELECT o_orderkey AS run_id, CAST(o_custkey % 12 AS INT) AS n FROM orders",
    "found_volumes": "SELECT l_orderkey AS run_id, l_linenumber - 1 AS vol_id FROM lineitem",
    "images": "SELECT vec_id AS position, CAST(embedding AS VECTOR) AS image FROM embeddings",
    "volumes": """
        SELECT CAST(vec_id AS INT) AS vol_id, CAST(embedding AS VECTOR) AS volume FROM embeddings""",
}


def _render(text: str, dialect: dict[str, str]) -> str:
    for mark, value in dialect.items():
        text = text.replace(mark, value)
    return text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = _render(VIEWS[name], _SPARK)
    used = [t for t in TABLES if re.search(rf"\b{t}\b", text)]
    for t in used:
        text = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
    used = [t for t in used if f"{{{t}}}" in text]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in used})


def ctes(*names: str) -> str:
    """``WITH`` clause with the named views, and a blank ``WITH`` item is never left open."""
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({_render(VIEWS[n], _DUCK)})" for n in names)


def particles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The particle view in the library's nested schema."""
    flat = view(spark, sf_dir, "particles")
    coord = F.when(F.col("x").isNotNull(), F.struct("x", "y"))
    transform = F.when(
        F.col("rot").isNotNull(), F.struct("rot", "tilt", "psi", "shift_x", "shift_y"))
    return flat.select(
        "position", "particle_id", coord.alias("coord"), transform.alias("transform"),
        "box", "apix", "defocus_u", "defocus_v", "defocus_angle", "voltage", "spherical_aberration",
        "amplitude_contrast", "event_type")


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from latentspark.sources.artifacts import parse_artifact_paths

    return parse_artifact_paths(view(spark, sf_dir, "artifact_paths"))


ARTIFACTS_CTE = r"""artifacts AS (
    SELECT run_id, regexp_extract(path, '/(z|weights)[^/]*$', 1) AS artifact,
           TRY_CAST(regexp_extract(path, '\.(\d+)\.pkl$', 1) AS INT) AS epoch, path
    FROM artifact_paths)"""


def label_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean latent vector of every label."""
    dims = view(spark, sf_dir, "latents").select("label", F.posexplode("z").alias("i", "v"))
    means = dims.groupBy("label", "i").agg(F.avg("v").alias("m"))
    return means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "m"))).alias("s")).select(
        F.col("label").alias("centre_id"), F.col("s.m").alias("z"))


CENTRES_CTE = """label_centres AS (
    SELECT label AS centre_id, list(m ORDER BY i) AS z
    FROM (SELECT label, i, avg(v) AS m
          FROM (SELECT label, unnest(z) AS v, generate_subscripts(z, 1) AS i FROM latents) d
          GROUP BY label, i) s
    GROUP BY label)"""

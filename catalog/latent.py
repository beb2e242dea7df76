"""Queries on the latent space: centres, components, distributions, neighbours, paths."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.fixtures import CENTRES_CTE, ctes, label_centres, particles, table, view
from catalog.registry import query, r6, sql6
from latentspark.functions import vectors
from latentspark.operators import centres, components, density, hierarchy, neighbours, runs, traversal
from latentspark.operators import landscape as states_of
from latentspark.operators import particles as sets
from latentspark.operators import position as order
from latentspark.plans import jobs
from latentspark.session import cut_lineage, working_dir
from latentspark.sources import epochs

LATENTS = ctes("latents")
CENTRED = f"{LATENTS}, {CENTRES_CTE}"
NEAREST_SQL = """assigned AS (
    SELECT position, centre_id, dist FROM (
        SELECT l.position, c.centre_id, list_distance(l.z, c.z) AS dist,
               row_number() OVER (PARTITION BY l.position ORDER BY list_distance(l.z, c.z), c.centre_id) AS rn
        FROM latents l, label_centres c) a WHERE rn = 1)"""
STATES_SQL = "states AS (SELECT centre_id, CAST(centre_id % 4 AS INT) AS state FROM label_centres)"


def _states(centre_table):
    return centre_table.select("centre_id", F.pmod("centre_id", F.lit(4)).alias("state"))


# The flagship: latents by order, an index subset, nearest centre, counts

@query("cluster_counts_of_subset", f"""{ctes('particles', 'latents', 'index_list')}, {CENTRES_CTE},
    ranked AS (SELECT row_number() OVER (ORDER BY particle_id) - 1 AS position FROM particles),
    kept AS (SELECT position, z FROM ranked JOIN latents USING (position)
             WHERE position IN (SELECT position FROM index_list)),
    assigned AS (
        SELECT k.position, c.centre_id,
               row_number() OVER (PARTITION BY k.position ORDER BY list_distance(k.z, c.z), c.centre_id) AS rn
        FROM kept k, label_centres c)
    SELECT centre_id AS state, count(*) AS particles FROM assigned WHERE rn = 1 GROUP BY 1""")
def cluster_counts_of_subset(spark, sf):
    ordered = order.with_position(particles(spark, sf).select("particle_id"), "particle_id")
    with_z = sets.attach_latents(ordered, view(spark, sf, "latents"))
    kept = sets.subset(with_z, view(spark, sf, "index_list"))
    assigned = centres.assign_nearest(kept, label_centres(spark, sf))
    return centres.state_particle_counts(assigned.select(F.col("centre_id").alias("state")))


# Centres

@query("assign_nearest", f"""{CENTRED}, {NEAREST_SQL}
    SELECT position, centre_id, {sql6('dist')} AS dist FROM assigned""")
def assign_nearest(spark, sf):
    return centres.assign_nearest(view(spark, sf, "latents"), label_centres(spark, sf)).select(
        "position", "centre_id", r6("dist").alias("dist"))


@query("assign_nearest_particles", f"""{ctes('particle_latents', 'supplier_centres')}
    SELECT position, centre_id, {sql6('dist')} AS dist FROM (
        SELECT l.position, c.centre_id, list_distance(l.z, c.z) AS dist,
               row_number() OVER (PARTITION BY l.position ORDER BY list_distance(l.z, c.z), c.centre_id) AS rn
        FROM particle_latents l, supplier_centres c) a WHERE rn = 1""")
def assign_nearest_particles(spark, sf):
    out = centres.assign_nearest(view(spark, sf, "particle_latents"), view(spark, sf, "supplier_centres"))
    return out.select("position", "centre_id", r6("dist").alias("dist"))


@query("assign_nearest_blocks", f"""{ctes('particle_latents', 'supplier_centres')}
    SELECT position, centre_id, {sql6('dist')} AS dist FROM (
        SELECT l.position, c.centre_id, list_distance(l.z, c.z) AS dist,
               row_number() OVER (PARTITION BY l.position ORDER BY list_distance(l.z, c.z), c.centre_id) AS rn
        FROM particle_latents l, supplier_centres c) a WHERE rn = 1""")
def assign_nearest_blocks(spark, sf):
    points = view(spark, sf, "supplier_centres").select(F.col("centre_id").cast("bigint").alias("position"), "z")
    out = neighbours.blocked_nearest(view(spark, sf, "particle_latents"), points, 1)
    return out.select("position", F.col("neighbour").cast("int").alias("centre_id"), r6("dist").alias("dist"))


CENTRE_PARTICLES_SQL = """centre_particles AS (
    SELECT centre_id, position, dist FROM (
        SELECT c.centre_id, l.position, list_distance(l.z, c.z) AS dist,
               row_number() OVER (PARTITION BY c.centre_id ORDER BY list_distance(l.z, c.z), l.position) AS rn
        FROM latents l, label_centres c) a WHERE rn = 1)"""


@query("centre_particles", f"""{CENTRED}, {CENTRE_PARTICLES_SQL}
    SELECT centre_id, position, {sql6('dist')} AS dist FROM centre_particles""")
def centre_particles(spark, sf):
    return centres.centre_particles(view(spark, sf, "latents"), label_centres(spark, sf)).select(
        "centre_id", "position", r6("dist").alias("dist"))


def _lloyd_sql(source: str, k: int, rounds: int) -> str:
    parts = [f"""c0 AS (SELECT CAST(i AS INT) AS centre_id, z
        FROM (SELECT unnest(range({k})) AS i) s JOIN {source} l
          ON l.position = i * (SELECT count(*) FROM {source}) // {k})"""]
    for r in range(1, rounds + 1):
        parts.append(f"""a{r} AS (SELECT position, z, centre_id FROM (
            SELECT l.position, l.z, c.centre_id, row_number() OVER (
                PARTITION BY l.position ORDER BY list_distance(l.z, c.z), c.centre_id) AS rn
            FROM {source} l, c{r - 1} c) x WHERE rn = 1),
        m{r} AS (SELECT centre_id, list(m ORDER BY i) AS z FROM (
            SELECT centre_id, i, avg(v) AS m FROM (
                SELECT centre_id, unnest(z) AS v, generate_subscripts(z, 1) AS i FROM a{r}) d
            GROUP BY 1, 2) s GROUP BY 1),
        c{r} AS (SELECT c.centre_id, coalesce(m.z, c.z) AS z FROM c{r - 1} c LEFT JOIN m{r} m USING (centre_id))""")
    return f"""{ctes(source)}, {', '.join(parts)}
        SELECT centre_id, CAST(i - 1 AS INT) AS dim, {sql6('v')} AS v
        FROM (SELECT centre_id, generate_subscripts(z, 1) AS i, unnest(z) AS v FROM c{rounds}) d"""


def _lloyd(spark, sf, source, k, rounds):
    latents = view(spark, sf, source)
    out = centres.kmeans_lloyd(latents, centres.spaced_seeds(latents, k), rounds)
    return out.select("centre_id", F.posexplode("z").alias("dim", "v")).select(
        "centre_id", "dim", r6("v").alias("v"))


@query("kmeans_lloyd", _lloyd_sql("latents", 5, 3))
def kmeans_lloyd(spark, sf):
    return _lloyd(spark, sf, "latents", 5, 3)


@query("kmeans_lloyd_particles", _lloyd_sql("particle_latents", 8, 4))
def kmeans_lloyd_particles(spark, sf):
    return _lloyd(spark, sf, "particle_latents", 8, 4)


@query("kmeans")
def kmeans(spark, sf):
    latents = view(spark, sf, "latents")
    return centres.centre_particles(latents, centres.kmeans(latents, 20)).select("centre_id", "position", "dist")


@query("sketch")
def sketch(spark, sf):
    latents = view(spark, sf, "particle_latents")
    return centres.sketch(latents, 40).select("centre_id", F.size("z").alias("zdim"))


# A coreset of about 2,000 rows, seeds from all rows, and what three rounds on either cost.
CORESET_SQL = """facts AS (
        SELECT count(*) AS n, avg(z[1]) AS a, avg(z[2]) AS b, avg(z[3]) AS c,
               (var_samp(z[1]) + var_samp(z[2]) + var_samp(z[3])) * (count(*) - 1) AS spread FROM particle_latents),
    chances AS (SELECT position, z, least(1e0, 2000 * (0.5e0 / n + 0.5e0 * (
                    (z[1]-a)*(z[1]-a) + (z[2]-b)*(z[2]-b) + (z[3]-c)*(z[3]-c)) / spread)) AS chance
                FROM particle_latents, facts),
    coreset AS (SELECT position, z, 1 / chance AS weight FROM chances
                WHERE CAST(concat('0x', substr(md5(concat('1:', position)), 1, 12)) AS BIGINT) / 281474976710656e0 < chance)"""


def _weighted_lloyd_sql(k: int, rounds: int) -> str:
    parts = [f"""c0 AS (SELECT CAST(i AS INT) AS centre_id, z
        FROM (SELECT unnest(range({k})) AS i) s JOIN particle_latents l
          ON l.position = i * (SELECT count(*) FROM particle_latents) // {k})"""]
    for r in range(1, rounds + 1):
        parts.append(f"""a{r} AS (SELECT l.position, any_value(l.z) AS z, any_value(l.weight) AS weight,
                arg_min(c.centre_id, list_distance(l.z, c.z)) AS centre_id FROM coreset l, c{r - 1} c GROUP BY 1),
        m{r} AS (SELECT centre_id, [sum(weight * z[1]) / sum(weight), sum(weight * z[2]) / sum(weight),
                                    sum(weight * z[3]) / sum(weight)] AS z FROM a{r} GROUP BY 1),
        c{r} AS (SELECT c.centre_id, coalesce(m.z, c.z) AS z FROM c{r - 1} c LEFT JOIN m{r} m USING (centre_id))""")
    return ", ".join(parts)


def _coreset(spark, sf):
    return centres.coreset(view(spark, sf, "particle_latents"), 2_000)


@query("coreset", f"""{ctes('particle_latents')}, {CORESET_SQL}
    SELECT position, {sql6('weight')} AS weight FROM coreset""")
def coreset(spark, sf):
    return _coreset(spark, sf).select("position", r6("weight").alias("weight"))


@query("coreset_lloyd", f"""{ctes('particle_latents')}, {CORESET_SQL}, {_weighted_lloyd_sql(8, 3)}
    SELECT centre_id, CAST(i - 1 AS INT) AS dim, {sql6('v')} AS v
    FROM (SELECT centre_id, generate_subscripts(z, 1) AS i, unnest(z) AS v FROM c3) d""")
def coreset_lloyd(spark, sf):
    """Lloyd on the coreset, from seeds of the whole table."""
    seeds = centres.spaced_seeds(view(spark, sf, "particle_latents"), 8)
    out = centres.kmeans_lloyd(cut_lineage(_coreset(spark, sf)), seeds, 3)
    return out.select("centre_id", F.posexplode("z").alias("dim", "v")).select(
        "centre_id", "dim", r6("v").alias("v"))


@query("particle_states", f"""{CENTRED}, {NEAREST_SQL}, {STATES_SQL}
    SELECT position, centre_id, state FROM assigned JOIN states USING (centre_id)""")
def particle_states(spark, sf):
    points = label_centres(spark, sf)
    return centres.particle_states(
        centres.assign_nearest(view(spark, sf, "latents"), points), _states(points))


@query("state_particle_counts", f"""{CENTRED}, {NEAREST_SQL}, {STATES_SQL}
    SELECT state, count(*) AS particles FROM assigned JOIN states USING (centre_id) GROUP BY 1""")
def state_particle_counts(spark, sf):
    points = label_centres(spark, sf)
    return centres.state_particle_counts(centres.particle_states(
        centres.assign_nearest(view(spark, sf, "latents"), points), _states(points)))


@query("state_volume_counts", f"""{CENTRED}, {STATES_SQL}
    SELECT state, count(*) AS volumes FROM states GROUP BY 1""")
def state_volume_counts(spark, sf):
    return centres.state_volume_counts(_states(label_centres(spark, sf)))


@query("states_on_embedding", f"""{CENTRED}, {CENTRE_PARTICLES_SQL}, {STATES_SQL}
    SELECT centre_id, position, state, {sql6('z[1]')} AS u, {sql6('z[2]')} AS v
    FROM centre_particles JOIN states USING (centre_id) JOIN latents USING (position)""")
def states_on_embedding(spark, sf):
    return _marked_states(spark, sf).select(
        "centre_id", "position", "state", r6("u").alias("u"), r6("v").alias("v"))


def _embedding(spark, sf):
    return view(spark, sf, "latents").select(
        "position", F.get("z", F.lit(0)).alias("u"), F.get("z", F.lit(1)).alias("v"))


def _marked_states(spark, sf):
    points = label_centres(spark, sf)
    marked = centres.centre_particles(view(spark, sf, "latents"), points)
    return states_of.states_on_embedding(marked, _states(points), _embedding(spark, sf))


@query("state_labels", f"""{CENTRED}, {CENTRE_PARTICLES_SQL}, {STATES_SQL}
    SELECT state, {sql6('avg(z[1])')} AS u, {sql6('avg(z[2])')} AS v
    FROM centre_particles JOIN states USING (centre_id) JOIN latents USING (position) GROUP BY 1""")
def state_labels(spark, sf):
    return states_of.state_labels(_marked_states(spark, sf)).select(
        "state", r6("u").alias("u"), r6("v").alias("v"))


# Vector functions

@query("vector_functions", f"""{CENTRED}
    SELECT position, {sql6('list_distance(l.z, c.z)')} AS distance, {sql6('list_dot_product(l.z, c.z)')} AS dot,
           {sql6('list_sum(list_transform(l.z, lambda x: x * 2e0)) + list_sum(c.z)')} AS mixed,
           {sql6('list_sum(l.z) - list_sum(c.z)')} AS difference
    FROM latents l JOIN label_centres c ON c.centre_id = l.label""")
def vector_functions(spark, sf):
    points = label_centres(spark, sf).select("centre_id", F.col("z").alias("c"))
    joined = view(spark, sf, "latents").join(points, F.col("label") == F.col("centre_id"))

    def total(v):
        return F.aggregate(v, F.lit(0.0), lambda s, x: s + x)

    z, c = F.col("z"), F.col("c")
    return joined.select(
        "position", r6(vectors.distance(z, c)).alias("distance"), r6(vectors.dot(z, c)).alias("dot"),
        r6(total(vectors.add(vectors.scale(z, F.lit(2.0)), c))).alias("mixed"),
        r6(total(vectors.subtract(z, c))).alias("difference"))


# Components

def _symmetric_pca_sql(source: str) -> str:
    """Eigenvalues and vectors of a 3 by 3 covariance matrix in closed form."""
    def column(x: str, y: str) -> str:
        cells = {
            "m11": f"a*a+d*d+e*e - ({x}+{y})*a + {x}*{y}", "m12": f"a*d+d*b+e*f - ({x}+{y})*d",
            "m13": f"a*e+d*f+e*c - ({x}+{y})*e", "m22": f"d*d+b*b+f*f - ({x}+{y})*b + {x}*{y}",
            "m23": f"d*e+b*f+f*c - ({x}+{y})*f", "m33": f"e*e+f*f+c*c - ({x}+{y})*c + {x}*{y}"}
        return ", ".join(f"{v} AS {k}" for k, v in cells.items())

    def axis(number: int, value: str, x: str, y: str) -> str:
        return f"""SELECT {number} AS component, {value} / (a + b + c) AS explained, {column(x, y)} FROM eig"""

    return f"""{ctes(source)},
        cov AS (SELECT var_samp(z[1]) AS a, var_samp(z[2]) AS b, var_samp(z[3]) AS c,
                       covar_samp(z[1], z[2]) AS d, covar_samp(z[1], z[3]) AS e, covar_samp(z[2], z[3]) AS f
                FROM {source}),
        p0 AS (SELECT *, (a + b + c) / 3 AS q FROM cov),
        p1 AS (SELECT *, sqrt(((a-q)*(a-q) + (b-q)*(b-q) + (c-q)*(c-q) + 2*(d*d + e*e + f*f)) / 6) AS p FROM p0),
        p2 AS (SELECT *, acos(((a-q)*((b-q)*(c-q) - f*f) - d*(d*(c-q) - f*e) + e*(d*f - (b-q)*e))
                              / (2*p*p*p)) / 3 AS phi FROM p1),
        eig AS (SELECT *, q + 2*p*cos(phi) AS e1, q + 2*p*cos(phi + 2*pi()/3) AS e3,
                       3*q - (q + 2*p*cos(phi)) - (q + 2*p*cos(phi + 2*pi()/3)) AS e2 FROM p2),
        m AS ({axis(0, 'e1', 'e2', 'e3')} UNION ALL {axis(1, 'e2', 'e1', 'e3')}),
        cols AS (SELECT component, explained, unnest([[m11,m12,m13],[m12,m22,m23],[m13,m23,m33]]) AS v FROM m),
        best AS (SELECT component, explained, v FROM cols
                 QUALIFY row_number() OVER (PARTITION BY component ORDER BY list_dot_product(v, v) DESC) = 1),
        unit AS (SELECT component, explained,
                        list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM best),
        signed AS (SELECT component, explained, list_transform(v, lambda x: x *
                     CASE WHEN list_max(v) >= -list_min(v) THEN 1 ELSE -1 END) AS v FROM unit)
        SELECT CAST(component AS INT) AS component, CAST(i - 1 AS INT) AS dim, {sql6('l')} AS loading,
               {sql6('explained')} AS explained
        FROM (SELECT component, explained, generate_subscripts(v, 1) AS i, unnest(v) AS l FROM signed) s"""


@query("pca", _symmetric_pca_sql("particle_latents"))
def pca(spark, sf):
    axes = components.pca(view(spark, sf, "particle_latents"), 2).to_df(spark)
    return axes.select("component", "dim", r6("loading").alias("loading"), r6("explained").alias("explained"))


@query("pca_energy", f"""{LATENTS}, dims AS (
        SELECT position, generate_subscripts(z, 1) AS i, unnest(z) AS v FROM latents),
    means AS (SELECT i, avg(v) AS m FROM dims GROUP BY 1)
    SELECT position, {sql6('sum((v - m) * (v - m))')} AS energy FROM dims JOIN means USING (i) GROUP BY 1""")
def pca_energy(spark, sf):
    """All components together keep every particle's distance from the mean."""
    latents = view(spark, sf, "latents")
    projected = components.project(latents, components.pca(latents, 64))
    energy = sum((F.col(c) * F.col(c) for c in projected.columns if c != "position"), F.lit(0.0))
    return projected.select("position", r6(energy).alias("energy"))


# Two fixed orthonormal axes of a 64-dimensional space, for checks of what follows a PCA.
_FLAT = tuple(0.125 for _ in range(64))
_ZIGZAG = tuple(0.125 if i % 2 == 0 else -0.125 for i in range(64))
FIXED_AXES = components.Axes(tuple(0.0 for _ in range(64)), (_FLAT, _ZIGZAG))
_AXES_SQL = f"axes AS (SELECT * FROM (VALUES (0, {list(_FLAT)}), (1, {list(_ZIGZAG)})) t(component, axis))"
TRAVERSAL_SQL = f"""{_AXES_SQL},
    projected AS (SELECT position, component, list_dot_product(z, axis) AS t FROM latents, axes),
    ends AS (SELECT component, quantile_cont(t, 0.01) AS lo, quantile_cont(t, 0.99) AS hi
             FROM projected GROUP BY 1),
    steps AS (SELECT component, step, lo + (hi - lo) * step / 9 AS t
              FROM ends, (SELECT unnest(range(10)) AS step) s),
    points AS (SELECT s.component, step, t, list_transform(axis, lambda x: x * t) AS p
               FROM steps s JOIN axes a USING (component)),
    traversal AS (SELECT component, step, t, position, list_distance(z, p) AS dist FROM points, latents
                  QUALIFY row_number() OVER (
                      PARTITION BY component, step ORDER BY list_distance(z, p), position) = 1)"""


@query("project", f"""{LATENTS}
    SELECT position, {sql6(f'list_dot_product(z, {list(_FLAT)})')} AS pc0,
           {sql6(f'list_dot_product(z, {list(_ZIGZAG)})')} AS pc1 FROM latents""")
def project(spark, sf):
    out = components.project(view(spark, sf, "latents"), FIXED_AXES)
    return out.select("position", r6("pc0").alias("pc0"), r6("pc1").alias("pc1"))


@query("pc_traversal", f"""{LATENTS}, {TRAVERSAL_SQL}
    SELECT CAST(component AS INT) AS component, CAST(step AS INT) AS step, {sql6('t')} AS t, position,
           {sql6('dist')} AS dist FROM traversal""")
def pc_traversal(spark, sf):
    out = components.pc_traversal(view(spark, sf, "latents"), FIXED_AXES)
    return out.select("component", "step", r6("t").alias("t"), "position", r6("dist").alias("dist"))


@query("z_traversal", f"""{ctes('latent1')},
    ends AS (SELECT quantile_cont(z[1], 0.01) AS lo, quantile_cont(z[1], 0.99) AS hi FROM latent1),
    steps AS (SELECT step, lo + (hi - lo) * step / 9 AS t FROM ends, (SELECT unnest(range(10)) AS step) s)
    SELECT CAST(step AS INT) AS step, {sql6('t')} AS t, position, {sql6('abs(z[1] - t)')} AS dist
    FROM steps, latent1
    QUALIFY row_number() OVER (PARTITION BY step ORDER BY abs(z[1] - t), position) = 1""")
def z_traversal(spark, sf):
    out = components.z_traversal(view(spark, sf, "latent1"))
    return out.select("step", r6("t").alias("t"), "position", r6("dist").alias("dist"))


@query("volume_points", f"""{ctes('latent1')},
    ends AS (SELECT quantile_cont(z[1], 0.01) AS lo, quantile_cont(z[1], 0.99) AS hi FROM latent1)
    SELECT CAST(step AS INT) AS vol_id, {sql6('lo + (hi - lo) * step / 9')} AS z0
    FROM ends, (SELECT unnest(range(10)) AS step) s""")
def volume_points(spark, sf):
    out = components.volume_points(view(spark, sf, "latent1"), zdim=1, k=20)
    return out.select("vol_id", r6(F.get("z", F.lit(0))).alias("z0"))


@query("volume_points_multi")
def volume_points_multi(spark, sf):
    return components.volume_points(view(spark, sf, "latents"), zdim=64, k=20).select(
        "vol_id", F.size("z").alias("zdim"))


@query("embedding_with_pc", f"""{LATENTS}
    SELECT position, {sql6('z[1]')} AS u, {sql6('z[2]')} AS v,
           {sql6(f'list_dot_product(z, {list(_FLAT)})')} AS pc0 FROM latents""")
def embedding_with_pc(spark, sf):
    projected = components.project(view(spark, sf, "latents"), FIXED_AXES)
    out = components.embedding_with_pc(_embedding(spark, sf), projected)
    return out.select("position", r6("u").alias("u"), r6("v").alias("v"), r6("pc0").alias("pc0"))


@query("traversal_on_embedding", f"""{LATENTS}, {TRAVERSAL_SQL}
    SELECT CAST(component AS INT) AS component, CAST(step AS INT) AS step, {sql6('z[1]')} AS u,
           {sql6('z[2]')} AS v, {sql6('lead(z[1]) OVER w')} AS next_u, {sql6('lead(z[2]) OVER w')} AS next_v
    FROM traversal JOIN latents USING (position) WINDOW w AS (PARTITION BY component ORDER BY step)""")
def traversal_on_embedding(spark, sf):
    path = components.pc_traversal(view(spark, sf, "latents"), FIXED_AXES)
    out = components.traversal_on_embedding(_embedding(spark, sf), path)
    return out.select("component", "step", *[r6(c).alias(c) for c in ("u", "v", "next_u", "next_v")])


# Distributions

@query("latent_histogram", f"""{ctes('latent1')}, e AS (SELECT min(z[1]) AS lo, max(z[1]) AS hi FROM latent1),
    b AS (SELECT CAST(least(floor((z[1] - lo) / ((hi - lo) / 20)), 19) AS INT) AS bin, lo, (hi - lo) / 20 AS w
          FROM latent1, e)
    SELECT bin, {sql6('any_value(lo) + bin * any_value(w)')} AS low,
           {sql6('any_value(lo) + (bin + 1) * any_value(w)')} AS high, count(*) AS particles FROM b GROUP BY bin""")
def latent_histogram(spark, sf):
    out = density.latent_histogram(view(spark, sf, "latent1"), 20)
    return out.select("bin", r6("low").alias("low"), r6("high").alias("high"), "particles")


_QS = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)
_DISTRIBUTION = f"""{ctes('latent1')}
    SELECT q, {sql6('v')} AS z FROM (SELECT unnest({list(_QS)}) :: DOUBLE AS q,
        unnest((SELECT quantile_cont(z[1], {list(_QS)}) FROM latent1)) AS v) d"""


@query("latent_distribution", _DISTRIBUTION)
def latent_distribution(spark, sf):
    return density.latent_distribution(view(spark, sf, "latent1"), _QS).select("q", r6("z").alias("z"))


@query("latent_distribution_ranges", _DISTRIBUTION)
def latent_distribution_ranges(spark, sf):
    out = density.latent_distribution(view(spark, sf, "latent1"), _QS, sort_rows=2_000)
    return out.select("q", r6("z").alias("z"))


@query("latent_coordinates", f"{ctes('latent1')} SELECT position, z[1] AS z FROM latent1")
def latent_coordinates(spark, sf):
    return density.latent_coordinates(view(spark, sf, "latent1"))


@query("hexbin", f"""{ctes('points2d')},
    e AS (SELECT min(u) AS u0, (max(u) - min(u)) / 20 AS su, min(v) AS v0, (max(v) - min(v)) / 11 AS sv
          FROM points2d),
    s AS (SELECT (u - u0) / su AS x, (v - v0) / sv AS y, e.* FROM points2d, e),
    c AS (SELECT *, floor(x + 0.5) AS ix, floor(y + 0.5) AS iy, floor(x) + 0.5 AS jx, floor(y) + 0.5 AS jy FROM s),
    n AS (SELECT *, (x-ix)*(x-ix) + 3*((y-iy)*(y-iy)) <= (x-jx)*(x-jx) + 3*((y-jy)*(y-jy)) AS straight FROM c),
    h AS (SELECT u0 + (CASE WHEN straight THEN ix ELSE jx END) * su AS hu,
                 v0 + (CASE WHEN straight THEN iy ELSE jy END) * sv AS hv FROM n)
    SELECT {sql6('hu')} AS hex_u, {sql6('hv')} AS hex_v, count(*) AS points FROM h GROUP BY 1, 2""")
def hexbin(spark, sf):
    out = density.hexbin(view(spark, sf, "points2d"), 20)
    return out.select(r6("hex_u").alias("hex_u"), r6("hex_v").alias("hex_v"), "points")


# Neighbours and paths

KNN_SQL = """near AS (
    SELECT position, neighbour, dist FROM (
        SELECT a.position, b.position AS neighbour, list_distance(a.z, b.z) AS dist,
               row_number() OVER (PARTITION BY a.position ORDER BY list_distance(a.z, b.z), b.position) AS rn
        FROM latents a JOIN latents b ON a.position <> b.position) n WHERE rn <= 10)"""
GRAPH_SQL = f"""{KNN_SQL},
    graph AS MATERIALIZED (SELECT src, dst, min(w) AS w FROM (
        SELECT position AS src, neighbour AS dst, dist AS w FROM near UNION ALL
        SELECT neighbour, position, dist FROM near) e GROUP BY 1, 2)"""
LEGS_SQL = """legs AS (
    SELECT CAST(row_number() OVER (ORDER BY centre_id) - 1 AS INT) AS leg, position AS source,
           lead(position) OVER (ORDER BY centre_id) AS target
    FROM centre_particles QUALIFY target IS NOT NULL)"""
DIST_SQL = """reached(leg, node, dist) USING KEY (leg, node) AS (
    SELECT leg, source, 0e0 FROM legs
    UNION
    SELECT d.leg, g.dst, min(d.dist + g.w) FROM reached d JOIN graph g ON g.src = d.node
        LEFT JOIN recurring.reached r ON r.leg = d.leg AND r.node = g.dst
    WHERE r.dist IS NULL OR d.dist + g.w < r.dist GROUP BY d.leg, g.dst)"""
PATH_CTES = f"{CENTRED}, {CENTRE_PARTICLES_SQL}, {GRAPH_SQL}, {LEGS_SQL}, {DIST_SQL}"


@query("knn_join", f"""{LATENTS}, {KNN_SQL}
    SELECT position, neighbour, {sql6('dist')} AS dist FROM near""")
def knn_join(spark, sf):
    return neighbours.knn_join(view(spark, sf, "latents"), 10).select(
        "position", "neighbour", r6("dist").alias("dist"))


@query("knn_join_pivots", f"""{LATENTS}, {KNN_SQL}
    SELECT position, neighbour, {sql6('dist')} AS dist FROM near""")
def knn_join_pivots(spark, sf):
    return neighbours.knn_join(view(spark, sf, "latents"), 10, block_rows=60, one_cell_rows=50).select(
        "position", "neighbour", r6("dist").alias("dist"))


@query("knn_join_eight", f"""{ctes('latents8')}, {KNN_SQL.replace('latents', 'latents8')}
    SELECT position, neighbour, {sql6('dist')} AS dist FROM near""")
def knn_join_eight(spark, sf):
    return neighbours.knn_join(view(spark, sf, "latents8"), 10, block_rows=60, one_cell_rows=50).select(
        "position", "neighbour", r6("dist").alias("dist"))


@query("knn_join_particles")
def knn_join_particles(spark, sf):
    return neighbours.knn_join(view(spark, sf, "particle_latents"), 5)


def _graph(spark, sf):
    return cut_lineage(neighbours.neighbour_graph(view(spark, sf, "latents"), 10))


@query("neighbour_graph", f"{LATENTS}, {GRAPH_SQL} SELECT src, dst, {sql6('w')} AS w FROM graph")
def neighbour_graph(spark, sf):
    return neighbours.neighbour_graph(view(spark, sf, "latents"), 10).select("src", "dst", r6("w").alias("w"))


@query("neighbour_graph_cutoff", f"""{LATENTS}, {GRAPH_SQL}
    SELECT src, dst, {sql6('w')} AS w FROM graph WHERE w <= 1.2""")
def neighbour_graph_cutoff(spark, sf):
    return neighbours.neighbour_graph(view(spark, sf, "latents"), 10, 1.2).select(
        "src", "dst", r6("w").alias("w"))


def _anchors(spark, sf):
    return centres.centre_particles(view(spark, sf, "latents"), label_centres(spark, sf)).select(
        "centre_id", "position")


@query("shortest_distances", f"""{PATH_CTES}
    SELECT leg, node, {sql6('dist')} AS dist FROM reached""")
def shortest_distances(spark, sf):
    out = traversal.shortest_distances(_graph(spark, sf), traversal.anchor_legs(_anchors(spark, sf)))
    return out.select("leg", "node", r6("dist").alias("dist"))


PATH_SQL = """pred AS MATERIALIZED (
        SELECT d.leg, d.node, min(g.src) AS pred
        FROM reached d JOIN graph g ON g.dst = d.node JOIN reached p ON p.leg = d.leg AND p.node = g.src
        WHERE g.w > 0 AND p.dist + g.w = d.dist GROUP BY 1, 2),
    back AS (SELECT leg, target AS node, 0 AS n FROM legs UNION ALL
             SELECT b.leg, p.pred, b.n + 1 FROM back b JOIN pred p ON p.leg = b.leg AND p.node = b.node),
    path AS (SELECT b.leg, CAST(max(n) OVER (PARTITION BY b.leg) - n AS INT) AS step, b.node AS position, dist
             FROM back b JOIN reached r ON r.leg = b.leg AND r.node = b.node)"""


@query("graph_traversal", f"""{PATH_CTES}, {PATH_SQL}
    SELECT leg, step, position, {sql6('dist')} AS dist FROM path""")
def graph_traversal(spark, sf):
    out = traversal.graph_traversal(_graph(spark, sf), _anchors(spark, sf))
    return out.select("leg", "step", "position", r6("dist").alias("dist"))


@query("path_latents", f"""{LATENTS}, path AS (
        SELECT label AS leg, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS INT) AS step,
               vec_id AS position FROM embeddings)
    SELECT leg, step, position, {sql6('z[1]')} AS z0, {sql6('list_sum(z)')} AS z_sum
    FROM path JOIN latents USING (position)""")
def path_latents(spark, sf):
    from pyspark.sql import Window

    step = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    path = table(spark, sf, "embeddings").select(
        F.col("label").alias("leg"), step.alias("step"), F.col("vec_id").alias("position"))
    out = traversal.path_latents(path, view(spark, sf, "latents"))
    return out.select("leg", "step", "position", r6(F.get("z", F.lit(0))).alias("z0"),
                      r6(F.aggregate("z", F.lit(0.0), lambda s, x: s + x)).alias("z_sum"))


# Cluster trees, landscape, the whole analysis

def _lloyd_sketch(spark, sf, source, n, rounds=3):
    latents = view(spark, sf, source)
    return centres.kmeans_lloyd(latents, centres.spaced_seeds(latents, n), rounds)


@query("agglomerate_ward")
def agglomerate_ward(spark, sf):
    return hierarchy.agglomerate(_lloyd_sketch(spark, sf, "particle_latents", 40), "ward", 10)


@query("agglomerate_average")
def agglomerate_average(spark, sf):
    return hierarchy.agglomerate(_lloyd_sketch(spark, sf, "particle_latents", 40), "average", 10)


@query("merge_tree")
def merge_tree(spark, sf):
    return hierarchy.merge_tree(label_centres(spark, sf), "ward")


@query("landscape", f"""{ctes('particle_latents')}
    SELECT count(*) AS particles, CAST(6 AS BIGINT) AS states, CAST(40 AS BIGINT) AS volumes
    FROM particle_latents""")
def landscape(spark, sf):
    """States split the particles and the sketch volumes without rest or overlap."""
    found = states_of.landscape(
        view(spark, sf, "particle_latents"), m=6, sketch=_lloyd_sketch(spark, sf, "particle_latents", 40))
    counts = found.particle_counts.join(found.volume_counts, "state", "full_outer")
    return counts.agg(F.sum("particles").alias("particles"), F.count("*").alias("states"),
                      F.sum("volumes").alias("volumes"))


@query("landscape_from_volumes")
def landscape_from_volumes(spark, sf):
    latents = view(spark, sf, "latents")
    sketch = _lloyd_sketch(spark, sf, "latents", 30)
    i = F.col("i")
    rows = sketch.select(F.col("centre_id").alias("vol_id"), F.posexplode("z").alias("i", "v")).select(
        "vol_id", F.floor(i / 16).cast("int").alias("z"), (F.floor(i / 4) % 4).cast("int").alias("y"),
        (i % 4).cast("int").alias("x"), "v")
    found = states_of.landscape(latents, m=5, sketch=sketch, volume_rows=rows, box=4, dilate=1)
    return found.particle_counts


@query("analyze")
def analyze(spark, sf):
    found = jobs.analyze(view(spark, sf, "latents"), 64, epoch=19, k=10)
    return found.volumes.select("vol_id", "file", F.size("z").alias("zdim"))


_LAST_OF_2 = """e AS (SELECT max(epoch) AS epoch FROM run_artifacts WHERE artifact = 'weights' AND run_id = 2)"""


@query("analyze_run", f"""{ctes('run_artifacts')}, {_LAST_OF_2}
    SELECT vol_id, concat('analyze.', epoch, '/kmeans5/vol_00', vol_id, '.mrc') AS file, 3e0 AS apix, 'k-means volumes' AS comment,
           CAST(2 AS INT) AS zdim, TRUE AS paired, CAST(7 AS BIGINT) AS child, (SELECT max(o_custkey) FROM orders) AS parent, 'source' AS kind
    FROM e, (SELECT CAST(unnest(range(5)) AS INT) AS vol_id) v""")
def analyze_run(spark, sf):
    """Rules, the last epoch's latents, z text paired with volumes, a published set and a lineage that is told twice."""
    path = f"{working_dir(spark)}/catalog-{uuid.uuid4().hex}"
    epochs.write_epoch_latents(view(spark, sf, "run_latents"), f"{path}/z")
    table_of_runs = table(spark, sf, "orders").agg(F.max("o_custkey").alias("input_set")).selectExpr(
        "2L AS run_id", "'train' AS kind", "CAST(NULL AS STRING) AS abinitio_type", "FALSE AS do_continue", "CAST(NULL AS BIGINT) AS continue_run",
        "input_set", "2 AS zdim", "20 AS num_epochs", "128 AS box", "1.5D AS apix", "TRUE AS do_downsample", "64 AS vol_box",
        "FALSE AS do_landscape", "TRUE AS auto_mask", "CAST(NULL AS INT) AS mask_box", "'last' AS epoch_choice", "1 AS epoch_number")
    found = spark.range(5).select(F.lit(2).cast("bigint").alias("run_id"), F.col("id").cast("int").alias("vol_id"))
    log = runs.lineage_log(spark, f"{path}/lineage")
    for _ in range(2):
        done = jobs.analyze_run(table_of_runs, 2, view(spark, sf, "run_artifacts"), epochs.read_epoch_latents(spark, f"{path}/z"), found,
                                f"{path}/out", k=5, set_id=7, lineage=log)
    points = done.analysis.volumes.select(F.col("vol_id").alias("own"), F.col("z").alias("own_z"))
    rows = done.volumes.join(points, F.col("vol_id") == F.col("own")).select(
        "vol_id", "file", "apix", "comment", F.size("z").alias("zdim"), (F.col("z") == F.col("own_z")).alias("paired"))
    return rows.crossJoin(F.broadcast(log.read().limit(2)))

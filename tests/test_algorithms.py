"""Algorithms against plain numpy, with crowded keys and forced splitting."""

import heapq

import numpy as np
import pytest
from pyspark.sql import functions as F

from latentspark.operators import centres, components, density, hierarchy, images
from latentspark.operators import landscape as landscapes
from latentspark.operators import neighbours, position, traversal, voxels
from latentspark.plans import jobs

RNG = np.random.default_rng(5)


def rows(df):
    return sorted(map(tuple, df.collect()))


def table(spark, matrix):
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "position bigint, z array<double>")


def centre_table(spark, matrix):
    return table(spark, matrix).select(F.col("position").cast("int").alias("centre_id"), "z")


def crowded(n=300, d=3):
    """A third of all points are one and the same point."""
    x = RNG.normal(size=(n, d))
    x[RNG.permutation(n)[: n // 3]] = x[0]
    return x


def brute_knn(x, k):
    out = set()
    for i, row in enumerate(x):
        dist = np.sqrt(((x - row) ** 2).sum(axis=1))
        order = sorted((d, j) for j, d in enumerate(dist) if j != i)[:k]
        out |= {(i, j) for _, j in order}
    return out


@pytest.mark.parametrize("block_rows, one_cell_rows", [(20, 50), (1000, 50), (20, 4_000), (20_000, 4_000)])
@pytest.mark.parametrize("make", [lambda: RNG.normal(size=(260, 4)), crowded], ids=["distinct", "crowded"])
def test_knn_join_is_exact(spark, make, block_rows, one_cell_rows):
    x = make()
    out = neighbours.knn_join(table(spark, x), 4, block_rows=block_rows, one_cell_rows=one_cell_rows)
    rows = out.collect()
    assert {(r["position"], r["neighbour"]) for r in rows} == brute_knn(x, 4)
    assert len(rows) == 4 * len(x)
    for r in rows:
        assert r["dist"] == pytest.approx(np.linalg.norm(x[r["position"]] - x[r["neighbour"]]), abs=1e-12)


def test_knn_sends_vectors_once_per_tile(spark):
    x = RNG.normal(size=(2_000, 8))
    report = {}
    out = neighbours.knn_join(table(spark, x), 5, one_cell_rows=50, report=report).collect()
    assert {(r["position"], r["neighbour"]) for r in out} == brute_knn(x, 5)
    assert report["vectors"] == 2_000 and report["near"] <= 2_000 * neighbours.NEAR_TILES
    # Some 44 cells in at most 32 tiles: a point goes to fewer tiles than there are cells within reach.
    assert report["near"] + report["rest"] < 25 * 2_000


def small_tiles(monkeypatch, near=1, listed=32):
    """Tables of a few hundred rows go the way of large ones."""
    for name, value in (("MAX_POINT_BYTES", 4_096), ("TILE_BYTES", 2_048), ("NEAR_TILES", near), ("LISTED_TILES", listed)):
        monkeypatch.setattr(neighbours, name, value)


def test_knn_writes_little_for_small_blocks(spark, monkeypatch):
    """Neither lists of blocks nor copies of points grow with rows times blocks."""
    import os

    from latentspark.session import working_dir

    def size():
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(working_dir(spark)) for f in names)

    x, before, report = RNG.normal(size=(3_000, 8)), size(), {}
    small_tiles(monkeypatch)
    out = neighbours.knn_join(table(spark, x), 5, block_rows=10, one_cell_rows=50, report=report).collect()
    assert {(r["position"], r["neighbour"]) for r in out} == brute_knn(x, 5)
    assert report["near"] + report["rest"] <= 3_000
    assert size() - before < 10 * x.nbytes


def test_knn_sends_points_to_near_tiles_only(spark, monkeypatch):
    """In three dimensions, with copies: most points are done in their own tile."""
    x, report = np.vstack([RNG.random(size=(4_000, 3)), np.zeros((60, 3))]), {}
    x[4_030:] = x[:30]
    monkeypatch.setattr(neighbours, "MAX_POINT_BYTES", 4_096)
    monkeypatch.setattr(neighbours, "TILE_BYTES", 1 << 14)
    out = neighbours.knn_join(table(spark, x), 4, one_cell_rows=50, report=report).collect()
    assert {(r["position"], r["neighbour"]) for r in out} == brute_knn(x, 4) and len(out) == 4 * len(x)
    assert 0 < report["rest"] < 4_000


@pytest.mark.parametrize("near, listed", [(100, 32), (100, 2), (0, 2)], ids=["tiles", "everywhere", "chunks"])
@pytest.mark.parametrize("make", [lambda: RNG.normal(size=(400, 8)), crowded, lambda: np.round(RNG.normal(size=(400, 2)), 1)],
                         ids=["even", "crowded", "lattice"])
def test_knn_of_every_kind_is_exact(spark, monkeypatch, make, near, listed):
    x = make()
    small_tiles(monkeypatch, near, listed)
    out = neighbours.knn_join(table(spark, x), 4, one_cell_rows=50).collect()
    assert {(r["position"], r["neighbour"]) for r in out} == brute_knn(x, 4) and len(out) == 4 * len(x)


def test_knn_leaves_out_vectors_with_missing_components(spark):
    x = RNG.normal(size=(80, 2))
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)] + [(80, [None, 1.0]), (81, [float("nan"), 0.0])]
    df = spark.createDataFrame(rows, "position bigint, z array<double>")
    for size in (10, 4_000):
        out = neighbours.knn_join(df, 3, one_cell_rows=size).collect()
        assert {(r["position"], r["neighbour"]) for r in out} == brute_knn(x, 3)


def test_neighbours_are_searched_near_the_point(monkeypatch):
    """The pairs that are compared do not grow with the square of the rows."""
    from latentspark.functions.search import Best, Tree

    pairs, share = compared(monkeypatch), []
    for n in (2_000, 32_000):
        pairs.clear()
        x = RNG.random(size=(n, 3))
        Tree(x, np.arange(n)).search(x, Best(n, 6))
        share.append(sum(pairs) / n)
    assert share[1] < 2.5 * share[0]


def test_blocked_nearest_takes_the_best_of_all_blocks(spark, monkeypatch):
    x, y = RNG.normal(size=(150, 3)), RNG.normal(size=(200, 3))
    y[150:] = y[:50]
    dist = np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2))
    wanted = {(i, int(j)) for i, row in enumerate(dist) for j in np.lexsort((np.arange(200), row))[:3]}
    for size in (1 << 20, 1_000):
        monkeypatch.setattr(neighbours, "MAX_POINT_BYTES", size)
        out = neighbours.blocked_nearest(table(spark, x), table(spark, y), 3)
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        assert sorted((r["position"], r["neighbour"]) for r in out.collect()) == sorted(wanted)


def test_tiles_hold_whole_blocks_within_the_limit():
    pivots, sizes = RNG.normal(size=(90, 3)), RNG.integers(1, 40, 90)
    sizes[7] = 500
    tile = neighbours._tiles(pivots, sizes, 100)
    total = np.bincount(tile, sizes)
    assert (total[total > 100] == 500).all() and sorted(set(tile)) == list(range(len(total)))
    same = neighbours._tiles(np.zeros((6, 2)), np.full(6, 10), 20)
    assert np.bincount(same).max() <= 2


def test_knn_of_nothing(spark):
    assert neighbours.knn_join(table(spark, np.empty((0, 2))), 3).count() == 0


def test_knn_with_fewer_points_than_neighbours(spark):
    out = neighbours.knn_join(table(spark, np.arange(3.0)[:, None]), 5)
    assert out.count() == 6


def test_knn_plan_limits_copies_before_the_shuffle(spark):
    from pyspark.sql import Window

    copies = Window.partitionBy("z").orderBy("position")
    df = table(spark, crowded()).withColumn("copy", F.row_number().over(copies)).filter("copy <= 5")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_assign_nearest_takes_the_lowest_of_equal_centres(spark):
    points = centre_table(spark, [[1.0], [0.0], [0.0], [2.0]])
    out = centres.assign_nearest(table(spark, [[0.0], [0.5], [1.5], [9.0]]), points)
    assert sorted((r["position"], r["centre_id"]) for r in out.collect()) == [(0, 1), (1, 0), (2, 0), (3, 3)]


def compared(monkeypatch):
    """Counts the pairs of rows that trees compare, in this process."""
    from latentspark.functions import search

    pairs, plain = [], search.Tree._compare
    monkeypatch.setattr(search.Tree, "_compare", lambda self, x, right, slack, limit, own, rows, best: (
        pairs.append(len(x) * len(own)), plain(self, x, right, slack, limit, own, rows, best))[1])
    return pairs


@pytest.mark.parametrize("d, k, offset", [(1, 3, 0.0), (3, 1, 0.0), (3, 6, 1e5), (8, 4, 0.0), (24, 4, 0.0), (24, 3, 1e4)])
def test_tree_is_exact(d, k, offset):
    """Ties, copies, several trees, small differences far from the origin (single precision screens from 16 on)."""
    from latentspark.functions.search import Best, Tree

    y, x = RNG.normal(size=(900, d)) + offset, RNG.normal(size=(150, d)) + offset
    y[:200], y[200:250], x[:20] = y[0], np.round(y[200:250], 1), y[0]
    ids, best = RNG.permutation(900), Best(150, k)
    for part in (slice(0, 300), slice(300, 301), slice(301, 900)):
        Tree.unpacked(Tree(y[part], ids[part], 20).packed()).search(x, best)
    for i, row in enumerate(x):
        dist = np.sqrt(((y - row) ** 2).sum(axis=1))
        order = np.lexsort((ids, dist))[:k]
        assert best.ids[i].tolist() == ids[order].tolist() and best.dist[i].tolist() == dist[order].tolist()


def test_trees_of_single_precision_points_take_half_the_bytes():
    from latentspark.functions.search import Tree

    x = RNG.normal(size=(500, 12)).astype(np.float32).astype(float)
    for z, kind in ((x, np.float32), (x + 1e-9, float), (np.vstack([x, np.full(12, 1e300)]), float)):
        tree = Tree(z, np.arange(len(z)))
        assert tree.packed()[0].dtype == kind and np.array_equal(Tree.unpacked(tree.packed()).z, tree.z)


def test_tree_with_odd_rows():
    from latentspark.functions.search import Best, Tree

    y, best = np.array([[0.0], [np.inf], [5.0]]), Best(3, 2)
    Tree(y, np.arange(3)).search(np.array([[1.0], [np.nan], [np.inf]]), best)
    assert [v.tolist() for v in best.found()] == [[0, 0], [0, 2], [1.0, 4.0]]
    Tree(np.empty((0, 1)), np.arange(0)).search(np.zeros((3, 1)), best)
    Tree(np.array([[np.nan]]), np.arange(1)).search(np.zeros((3, 1)), best)
    assert len(best.found()[0]) == 2


def test_assign_nearest_compares_near_centres_only(monkeypatch):
    """The pairs that are compared do not grow with particles times centres."""
    from latentspark.functions.search import Best, Tree

    pairs, share = compared(monkeypatch), []
    for n in (2_000, 32_000):
        pairs.clear()
        Tree(RNG.normal(size=(n, 3)), np.arange(n)).search(RNG.normal(size=(n, 3)), Best(n, 1))
        share.append(sum(pairs) / n)
    assert share[1] < 2.5 * share[0] and share[1] < 32_000 / 8


def test_assign_nearest_of_many_centres_is_exact(spark):
    x, c = crowded(400), RNG.normal(size=(3_000, 3))
    c[7] = c[2_000]
    dist = np.sqrt(((x[:, None] - c[None]) ** 2).sum(axis=2))
    out = centres.assign_nearest(table(spark, x).repartition(3), centre_table(spark, c)).collect()
    assert {(r["position"], r["centre_id"], r["dist"]) for r in out} == {
        (i, int(row.argmin()), float(row.min())) for i, row in enumerate(dist)}
    assert len(out) == 400


def test_large_centre_tables_take_the_block_path(spark, monkeypatch):
    x, c = crowded(), RNG.normal(size=(40, 3))
    small = centres.assign_nearest(table(spark, x), centre_table(spark, c)).orderBy("position").collect()
    near = centres.centre_particles(table(spark, x), centre_table(spark, c)).orderBy("centre_id").collect()
    monkeypatch.setattr(centres, "MAX_CENTRE_BYTES", 16)
    assert centres.assign_nearest(table(spark, x), centre_table(spark, c)).orderBy("position").collect() == small
    blocks = centres.centre_particles(table(spark, x), centre_table(spark, c)).orderBy("centre_id").collect()
    assert [(r["centre_id"], r["position"], r["dist"]) for r in blocks] == [
        (r["centre_id"], r["position"], r["dist"]) for r in near]


def test_centre_particles_against_brute_force(spark):
    x, c = crowded(), RNG.normal(size=(7, 3))
    dist = np.sqrt(((c[:, None] - x[None]) ** 2).sum(axis=2))
    for r in centres.centre_particles(table(spark, x).repartition(5), centre_table(spark, c)).collect():
        assert r["position"] == int(dist[r["centre_id"]].argmin())
        assert r["z"] == pytest.approx(list(x[r["position"]]))


def test_lloyd_with_an_empty_cluster(spark):
    x = np.array([[0.0], [1.0], [10.0], [11.0]])
    seeds = centre_table(spark, [[0.0], [10.0], [1000.0]])
    out = centres.kmeans_lloyd(table(spark, x), seeds, 4)
    assert {r["centre_id"]: r["z"] for r in out.collect()} == {0: [0.5], 1: [10.5], 2: [1000.0]}


def test_lloyd_with_centres_in_blocks(spark, monkeypatch):
    x, c = crowded(), RNG.normal(size=(6, 3))
    small = centres.kmeans_lloyd(table(spark, x), centre_table(spark, c), 2).collect()
    monkeypatch.setattr(centres, "MAX_CENTRE_BYTES", 100)
    blocks = centres.kmeans_lloyd(table(spark, x), centre_table(spark, c), 2).collect()
    small, blocks = ({r["centre_id"]: r["z"] for r in rows} for rows in (small, blocks))
    assert sorted(small) == sorted(blocks)
    for i, z in small.items():
        assert blocks[i] == pytest.approx(z)


def test_assignment_in_blocks_does_not_shuffle_particles(spark, monkeypatch):
    monkeypatch.setattr(centres, "MAX_CENTRE_BYTES", 100)
    out = centres.assign_nearest(table(spark, crowded()), centre_table(spark, RNG.normal(size=(6, 3))))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_broadcast_hint_goes_by_bytes(spark):
    from latentspark.session import broadcast_if_small

    df = spark.range(10).selectExpr("id", "array_repeat(1.0D, 1000) AS z", "repeat('a', 10) AS s", "map(1, 'b') AS m")
    hinted = [("hint" in broadcast_if_small(df, n)._jdf.queryExecution().logical().toString().lower())
              for n in (1 << 20, 1 << 15)]
    assert hinted == [True, False]


def test_latest_artifact_is_hash_aggregated(spark):
    from latentspark.operators import runs

    rows = [(1, "weights", 2, "b"), (1, "weights", 2, "c"), (1, "weights", 1, "z"), (1, "z", 9, "x"), (2, "weights", 0, "a"),
            (3, "weights", None, "n")]
    out = runs.latest_artifact(spark.createDataFrame(rows, "run_id int, artifact string, epoch int, path string"))
    assert sorted(map(tuple, out.collect())) == [(1, "weights", 2, "c"), (2, "weights", 0, "a")]
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_spaced_seeds(spark):
    out = centres.spaced_seeds(table(spark, np.arange(10.0)[:, None]), 4)
    assert sorted((r["centre_id"], r["z"][0]) for r in out.collect()) == [(0, 0.0), (1, 2.0), (2, 5.0), (3, 7.0)]


def sequential_merges(x, linkage):
    clusters = {i: [i] for i in range(len(x))}
    heights = []
    while len(clusters) > 1:
        best = None
        for a in clusters:
            for b in clusters:
                if a < b:
                    p, q = x[clusters[a]], x[clusters[b]]
                    if linkage == "average":
                        d = np.sqrt(((p[:, None] - q[None]) ** 2).sum(axis=2)).mean()
                    else:
                        gap = ((p.mean(axis=0) - q.mean(axis=0)) ** 2).sum()
                        d = np.sqrt(2.0 * gap * len(p) * len(q) / (len(p) + len(q)))
                    if best is None or d < best[0]:
                        best = (d, a, b)
        d, a, b = best
        clusters[a] += clusters.pop(b)
        heights.append((a, b, d))
    return heights


@pytest.mark.parametrize("linkage", ["average", "ward"])
def test_merging_mutual_neighbours_equals_sequential_merging(spark, linkage):
    x = RNG.normal(size=(36, 4))
    got = sorted((r["height"], r["a"], r["b"]) for r in
                 hierarchy.merge_tree(centre_table(spark, x), linkage).collect())
    want = sorted((d, a, b) for a, b, d in sequential_merges(x, linkage))
    assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want]
    assert [h for h, _, _ in got] == pytest.approx([d for d, _, _ in want])


@pytest.mark.parametrize("linkage", ["average", "ward"])
def test_agglomerate_equal_distances(spark, linkage):
    grid = np.array([[i, j] for i in range(4) for j in range(4)], dtype=float)
    out = hierarchy.agglomerate(centre_table(spark, grid), linkage, 4).collect()
    assert len(out) == 16 and {r["state"] for r in out} == {0, 1, 2, 3}


def test_agglomerate_more_clusters_than_points(spark):
    out = hierarchy.agglomerate(centre_table(spark, [[0.0], [1.0]]), "ward", 10)
    assert sorted(map(tuple, out.collect())) == [(0, 0), (1, 1)]


def dijkstra(edges, source):
    graph = {}
    for a, b, w in edges:
        graph.setdefault(a, []).append((b, w))
    dist, heap = {source: 0.0}, [(0.0, source)]
    while heap:
        d, node = heapq.heappop(heap)
        if d > dist[node]:
            continue
        for other, w in graph.get(node, []):
            if d + w < dist.get(other, np.inf):
                dist[other] = d + w
                heapq.heappush(heap, (d + w, other))
    return dist


def test_shortest_paths_equal_dijkstra(spark):
    x = RNG.normal(size=(120, 2))
    graph = neighbours.neighbour_graph(table(spark, x), 4)
    edges = [tuple(r) for r in graph.collect()]
    anchors = spark.createDataFrame([(0, 5), (1, 60), (2, 60), (3, 17)], "centre_id int, position bigint")
    state = traversal.shortest_distances(graph, traversal.anchor_legs(anchors)).collect()
    for leg, source in ((0, 5), (2, 60)):
        want = dijkstra(edges, source)
        got = {r["node"]: r["dist"] for r in state if r["leg"] == leg}
        assert got == pytest.approx(want)
    weight = {(a, b): w for a, b, w in edges}
    path = traversal.graph_traversal(graph, anchors).orderBy("leg", "step").collect()
    for leg, source, target in ((0, 5, 60), (1, 60, 60), (2, 60, 17)):
        steps = [r["position"] for r in path if r["leg"] == leg]
        if target not in dijkstra(edges, source):
            assert steps == [None]
            continue
        assert steps[0] == source and steps[-1] == target
        assert sum(weight[s] for s in zip(steps, steps[1:])) == pytest.approx(dijkstra(edges, source)[target])


def test_crowded_nodes_are_split(spark, monkeypatch):
    monkeypatch.setattr(traversal, "HUB_EDGES", 7)
    spokes = [(0, i, float(i)) for i in range(1, 60)] + [(i, 100 + i, 0.5) for i in range(1, 60)]
    edges = spokes + [(b, a, w) for a, b, w in spokes]
    graph = spark.createDataFrame(edges, "src bigint, dst bigint, w double")
    anchors = spark.createDataFrame([(0, 101), (1, 140)], "centre_id int, position bigint")
    state = traversal.shortest_distances(graph, traversal.anchor_legs(anchors)).collect()
    assert {r["node"]: r["dist"] for r in state} == pytest.approx(dijkstra(edges, 101))
    path = traversal.graph_traversal(graph, anchors).orderBy("step").collect()
    assert [r["position"] for r in path] == [101, 1, 0, 40, 140]


def test_unreachable_leg_is_one_empty_row(spark):
    graph = spark.createDataFrame(
        [(0, 1, 1.0), (1, 0, 1.0), (2, 3, 0.0), (3, 2, 0.0)], "src bigint, dst bigint, w double")
    anchors = spark.createDataFrame([(0, 0), (1, 3), (2, 2)], "centre_id int, position bigint")
    out = traversal.graph_traversal(graph, anchors).orderBy("leg", "step").collect()
    assert [tuple(r) for r in out] == [(0, 0, None, None), (1, 0, 3, 0.0), (1, 1, 2, 0.0)]


def _cost(x, found):
    z = np.array([r["z"] for r in found.collect()])
    return float((((x[:, None, :] - z[None, :, :]) ** 2).sum(axis=2)).min(axis=1).sum())


def test_coreset_costs_about_as_much_as_all_rows(spark):
    x = np.vstack([RNG.normal(size=(4_000, 3)) + c for c in ([0, 0, 0], [6, 0, 0], [0, 9, 0])] + [RNG.normal(size=(40, 3)) + 40])
    latents = table(spark, x)
    sample = centres.coreset(latents, 1_000).cache()
    rows = sample.collect()
    assert 850 < len(rows) < 1_150
    assert sum(r["weight"] for r in rows) == pytest.approx(len(x), rel=0.1)
    assert sum(r["position"] >= 12_000 for r in rows) >= 30  # far rows are sure to be seen
    seeds = centres.spaced_seeds(latents, 8)
    full, small = (_cost(x, centres.kmeans_lloyd(t, seeds, 5)) for t in (latents, sample))
    assert small < 1.1 * full
    assert {r["position"] for r in centres.coreset(latents.repartition(7), 1_000).collect()} == {r["position"] for r in rows}


def test_coreset_of_odd_tables(spark):
    assert centres.coreset(table(spark, np.empty((0, 2))), 10).count() == 0
    assert [r["weight"] for r in centres.coreset(table(spark, np.ones((1, 2))), 10).collect()] == [1.0]
    same = centres.coreset(table(spark, np.ones((600, 2))), 100).collect()
    assert {round(r["weight"], 6) for r in same} == {12.0} and 20 < len(same) < 90
    x = RNG.normal(size=(50, 2))
    assert [r["weight"] for r in centres.coreset(table(spark, x), 100).collect()] == [1.0] * 50


def test_weighted_lloyd_equals_repeated_rows(spark, monkeypatch):
    x, w = RNG.normal(size=(60, 2)), RNG.integers(1, 5, 60)
    plain = table(spark, np.repeat(x, w, axis=0))
    weighted = spark.createDataFrame(
        [(i, v.tolist(), float(n)) for i, (v, n) in enumerate(zip(x, w))], "position bigint, z array<double>, weight double")
    seeds = centre_table(spark, x[:4])
    want = [r["z"] for r in centres.kmeans_lloyd(plain, seeds, 3).orderBy("centre_id").collect()]
    assert np.allclose([r["z"] for r in centres.kmeans_lloyd(weighted, seeds, 3).orderBy("centre_id").collect()], want)
    monkeypatch.setattr(centres, "MAX_CENTRE_BYTES", 32)
    assert np.allclose([r["z"] for r in centres.kmeans_lloyd(weighted, seeds, 3).orderBy("centre_id").collect()], want)


def test_pca_equals_dense_eigendecomposition(spark):
    x = RNG.normal(size=(200, 5)) @ np.diag([5, 3, 2, 1, 0.5]) + 7.0
    model = components.pca(table(spark, x), 3)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    for i in range(3):
        axis = vectors[:, -1 - i]
        axis = axis * np.sign(axis[np.abs(axis).argmax()])
        assert model.axes[i] == pytest.approx(axis, abs=1e-8)
        assert model.explained[i] == pytest.approx(values[-1 - i] / values.sum())
    projected = components.project(table(spark, x), model).orderBy("position").collect()
    want = (x - x.mean(axis=0)) @ np.array(model.axes).T
    assert np.array([[r[f"pc{i}"] for i in range(3)] for r in projected]) == pytest.approx(want, abs=1e-9)


def test_pc_traversal(spark):
    x = RNG.normal(size=(150, 3))
    model = components.pca(table(spark, x), 1)
    out = components.pc_traversal(table(spark, x), model).orderBy("step").collect()
    t = (x - x.mean(axis=0)) @ np.array(model.axes[0])
    assert [r["t"] for r in out] == pytest.approx(list(np.linspace(*np.percentile(t, [1, 99]), 10)))
    for r in out:
        assert r["position"] == int(((x - np.array(r["z"])) ** 2).sum(axis=1).argmin())


@pytest.mark.parametrize("values", [
    RNG.normal(size=500), np.r_[np.full(300, 2.5), RNG.normal(size=200)], np.full(90, 4.0), np.array([1.0])])
def test_quantiles_are_exact_in_ranges(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    qs = [0.0, 0.01, 0.3, 0.5, 0.77, 0.99, 1.0]
    want = list(np.quantile(values, qs))
    assert density.quantiles(df, "v", qs) == pytest.approx(want)
    assert density.quantiles(df, "v", qs, sort_rows=25) == pytest.approx(want)


def test_empty_distributions(spark):
    empty = spark.createDataFrame([], "position bigint, z array<double>")
    assert density.latent_histogram(empty).count() == 0
    assert density.latent_distribution(empty).count() == 0
    assert density.hexbin(spark.createDataFrame([], "u double, v double")).count() == 0


def test_histogram_and_hexbin_count_every_point(spark):
    x = RNG.normal(size=(400, 1))
    counts, _ = np.histogram(x, 13)
    got = {r["bin"]: r["particles"] for r in density.latent_histogram(table(spark, x), 13).collect()}
    assert [got.get(i, 0) for i in range(13)] == list(counts)
    points = spark.createDataFrame([(1.0, 2.0)] * 5, "u double, v double")
    assert [r["points"] for r in density.hexbin(points).collect()] == [5]


@pytest.mark.parametrize("box", [8, 6, 4])
def test_downsampling_equals_numpy(spark, box):
    stack = RNG.normal(size=(3, 8, 8))
    df = spark.createDataFrame(
        [(i, [float(v) for v in im.ravel()], "kept") for i, im in enumerate(stack)],
        "position bigint, image array<double>, note string")
    out = images.downsample_images(df, box).orderBy("position").collect()
    f = np.fft.fftshift(np.fft.fft2(stack), axes=(1, 2))
    lo = 4 - box // 2
    want = np.fft.ifft2(np.fft.ifftshift(f[:, lo:lo + box, lo:lo + box], axes=(1, 2))).real * (box / 8) ** 2
    assert np.array([r["image"] for r in out]) == pytest.approx(want.reshape(3, -1))
    assert {r["note"] for r in out} == {"kept"}
    assert np.mean(want) == pytest.approx(np.mean(stack))


def test_downsampling_volumes_keeps_the_mean(spark):
    volume = RNG.normal(size=(6, 6, 6))
    df = spark.createDataFrame([(0, [float(v) for v in volume.ravel()])], "vol_id int, volume array<double>")
    small = images.downsample_volumes(df, 4).first()["volume"]
    assert len(small) == 64 and np.mean(small) == pytest.approx(volume.mean())
    with pytest.raises(ValueError):
        images.downsample_volumes(df, 3)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_dilation_equals_brute_force(spark, n):
    box = 7
    mask = RNG.random((box, box, box)) < 0.05
    mask[2:5, 2:5, 2:5] = True
    mask[0, 0, :] = True
    on = {tuple(map(int, c)) for c in np.argwhere(mask)}
    df = spark.createDataFrame(sorted(on), "z int, y int, x int")
    got = {tuple(r) for r in voxels.dilate_mask(df, n, box).collect()}
    want = {(z, y, x) for z in range(box) for y in range(box) for x in range(box)
            if any((z - a) ** 2 + (y - b) ** 2 + (x - c) ** 2 <= n * n for a, b, c in on)}
    assert got == want


@pytest.mark.parametrize("n", [1, 5, 20])
def test_dilation_by_distances(spark, n):
    """The grown ball equals all places within reach, however far it reaches."""
    box = 24
    on = np.argwhere(RNG.random((box, box, box)) < 0.0004)
    df = spark.createDataFrame([tuple(map(int, c)) for c in on] + [(int(on[0][0]), int(on[0][1]), int(on[0][2]))], "z int, y int, x int")
    places = np.indices((box, box, box)).reshape(3, -1).T
    near = ((places[:, None] - on[None]) ** 2).sum(-1).min(1)
    got = [tuple(r) for r in voxels.dilate_mask(df, n, box).collect()]
    assert len(got) == len(set(got)) and set(got) == set(map(tuple, places[near <= n * n].tolist()))
    assert voxels.dilate_mask(df.limit(0), n, box).count() == 0


def test_lower_envelope():
    for _ in range(30):
        f = np.where(RNG.random((5, 17)) < 0.6, np.inf, RNG.integers(0, 200, (5, 17)).astype(float))
        q = np.arange(17)
        assert np.array_equal(voxels._nearest_squares(f), (f[:, None, :] + (q[:, None] - q) ** 2).min(-1))


def test_slab_pca(spark):
    """Slabs of uneven length, a mask, missing values; the leading components of a decaying spectrum."""
    scale = 0.7 ** np.arange(40)
    data = RNG.normal(size=(40, 40)) * scale @ np.linalg.qr(RNG.normal(size=(64, 40)))[0].T
    df = spark.createDataFrame([(v, [float(x) for x in row]) for v, row in enumerate(data)], "vol_id int, volume array<double>")
    kept = RNG.random(64) < 0.7
    rows = [(i // 16, i // 4 % 4, i % 4) for i in np.flatnonzero(kept).tolist()]
    mask = voxels.mask_slabs(spark.createDataFrame(rows, "z int, y int, x int"), 4, 27)
    assert {tuple(r) for r in voxels.slab_coordinates(mask, 4, 27).collect()} == set(rows)
    for chosen, part in ((None, data), (mask, data[:, kept])):
        u, s, _ = np.linalg.svd(part - part.mean(axis=0), full_matrices=False)
        out = voxels.slab_pca(voxels.volume_slabs(df, 27), chosen, 6)
        plan = voxels.volume_slabs(df, 27)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and out.count() == 240
        for r in out.collect():
            axis = u[:, r.component] * np.sign(u[np.abs(u[:, r.component]).argmax(), r.component])
            assert r.score == pytest.approx(axis[r.vol_id] * s[r.component], abs=1e-5)
            assert r.explained == pytest.approx(s[r.component] ** 2 / (s ** 2).sum(), abs=1e-9)
    assert voxels.slab_pca(voxels.volume_slabs(df.limit(1), 27)).count() == 0


def test_slab_mask_equals_voxel_mask(spark):
    df = spark.createDataFrame([(v, [float(x) for x in RNG.normal(size=27)]) for v in range(5)], "vol_id int, volume array<double>")
    for threshold in (0.0, 0.8):
        wanted = voxels.threshold_mask(voxels.volumes_to_voxels(df, 3), threshold)
        found = voxels.slab_coordinates(voxels.slab_mask(df, threshold, 10), 3, 10)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def test_volume_pca_with_missing_voxels(spark):
    data = RNG.normal(size=(6, 27))
    data[2, 5] = 0.0
    rows = [(v, i // 9, i // 3 % 3, i % 3, float(data[v, i])) for v in range(6) for i in range(27)
            if (v, i) != (2, 5)]
    df = spark.createDataFrame(rows, "vol_id int, z int, y int, x int, v double")
    out = voxels.volume_pca(df, None, 3).collect()
    u, s, _ = np.linalg.svd(data - data.mean(axis=0), full_matrices=False)
    for r in out:
        c = r["component"]
        axis = u[:, c] * np.sign(u[np.abs(u[:, c]).argmax(), c])
        assert r["score"] == pytest.approx(axis[r["vol_id"]] * s[c], abs=1e-8)


def test_volume_pca_of_more_volumes_than_voxels(spark):
    data = RNG.normal(size=(120, 8))
    rows = [(v, i // 4, i // 2 % 2, i % 2, float(data[v, i])) for v in range(120) for i in range(8)]
    df = spark.createDataFrame(rows, "vol_id int, z int, y int, x int, v double")
    u, s, _ = np.linalg.svd(data - data.mean(axis=0), full_matrices=False)
    for dim in (3, 20):
        out = voxels.volume_pca(df, None, dim).collect()
        assert len(out) == 120 * dim
        for r in out:
            c = r["component"]
            if c >= 8:
                assert r["score"] == pytest.approx(0.0, abs=1e-5) and r["explained"] == pytest.approx(0.0, abs=1e-9)
                continue
            axis = u[:, c] * np.sign(u[np.abs(u[:, c]).argmax(), c])
            assert r["score"] == pytest.approx(axis[r["vol_id"]] * s[c], abs=1e-6)
            assert r["explained"] == pytest.approx(s[c] ** 2 / (s ** 2).sum())
    flat = voxels.volume_pca(df.withColumn("v", F.lit(2.0)), None, 2).collect()
    assert {(r["score"], r["explained"]) for r in flat} == {(0.0, 0.0)}


@pytest.mark.parametrize("shape", [(120, 8, 5), (60, 30, 7)], ids=["more-volumes", "wide"])
def test_slab_pca_of_many_volumes(spark, monkeypatch, shape):
    """Directions by voxel give what directions by volume give; uneven slabs, missing slabs and values."""
    n, size, slab = shape
    data = RNG.normal(size=(n, size)) * 0.8 ** np.arange(size) + 3.0
    data[4, slab:2 * slab] = data[5, 1] = 0.0
    data[7, -1] = 0.0
    rows = [(v, i // slab, [float(x) for x in row[i:i + slab]]) for v, row in enumerate(data)
            for i in range(0, size, slab) if (v, i) != (4, slab)]
    rows = [(v, s, x[:-1] + [None] if (v, s) == (7, (size - 1) // slab) else x) for v, s, x in rows]
    rows = [(v, s, [x[0], float("nan"), *x[2:]] if (v, s) == (5, 0) else x) for v, s, x in rows]
    df = spark.createDataFrame(rows, "vol_id int, slab int, values array<double>")
    u, s, _ = np.linalg.svd(data - data.mean(axis=0), full_matrices=False)
    for dim in (3, 12):
        few = {(r["vol_id"], r["component"]): r for r in voxels.slab_pca(df, None, dim).collect()}
        with monkeypatch.context() as m:
            m.setattr(voxels, "VOLUME_NUMBERS", 1)
            m.setattr(voxels, "ROW_NUMBERS", 300)
            many = voxels.slab_pca(df, None, dim).collect()
        assert len(many) == len(few) == n * dim
        for r in many:
            c, other = r["component"], few[r["vol_id"], r["component"]]
            assert r["score"] == pytest.approx(other["score"], abs=1e-5) and r["explained"] == pytest.approx(other["explained"], abs=1e-9)
            if c < size:
                axis = u[:, c] * np.sign(u[np.abs(u[:, c]).argmax(), c])
                assert r["score"] == pytest.approx(axis[r["vol_id"]] * s[c], abs=1e-5)


def test_slab_pca_of_many_equal_volumes(spark, monkeypatch):
    monkeypatch.setattr(voxels, "VOLUME_NUMBERS", 1)
    df = spark.createDataFrame([(v, 0, [2.0, 2.0]) for v in range(9)], "vol_id int, slab int, values array<double>")
    assert {(r["score"], r["explained"]) for r in voxels.slab_pca(df, None, 2).collect()} == {(0.0, 0.0)}


def test_landscape_splits_all_particles(spark):
    x = np.vstack([RNG.normal(size=(60, 3)) + 10 * i for i in range(3)])
    found = landscapes.landscape(table(spark, x), n=12, m=3, seed=3)
    counts = sorted(r["particles"] for r in found.particle_counts.collect())
    assert counts == [60, 60, 60]
    assert sum(r["volumes"] for r in found.volume_counts.collect()) == 12


def test_analyze_with_all_parts(spark):
    x = RNG.normal(size=(90, 3))
    found = jobs.analyze(table(spark, x), 3, epoch=4, k=4, do_graph_traversal=True, do_landscape=True, n=8, m=2)
    assert found.volumes.filter("file like 'analyze.4/kmeans4/vol_00%.mrc'").count() == 4
    assert found.traversal.count() == 20
    assert found.graph_path.agg(F.max("leg")).first()[0] == 2
    assert found.landscape.particle_counts.agg(F.sum("particles")).first()[0] == 90


def test_analyze_with_one_dimension(spark):
    found = jobs.analyze(table(spark, RNG.normal(size=(50, 1))), 1, do_graph_traversal=True, do_landscape=True)
    assert found.volumes.filter("file like 'analyze.0/vol_00%.mrc'").count() == 10
    assert found.axes is None and found.graph_path is None and found.landscape is None


@pytest.mark.parametrize("rows_per_range", [10, 37, 1_000_000])
def test_positions_with_a_crowded_key(spark, rows_per_range):
    keys = [None if i % 11 == 0 else (5 if i % 3 else i % 17) for i in range(400)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key int, id int").repartition(7)
    got = [(r["key"], r["id"]) for r in
           position.with_position(df, "key", ["id"], rows_per_range=rows_per_range).orderBy("position").collect()]
    want = sorted(zip(keys, range(400)), key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    assert got == want
    places = position.with_position(df, "key", ["id"], rows_per_range=rows_per_range)
    assert [r["position"] for r in places.orderBy("position").collect()] == list(range(400))


def test_string_and_empty_positions(spark):
    df = spark.createDataFrame([(w,) for w in "delta alpha charlie bravo".split()], "w string")
    out = position.with_position(df, "w", rows_per_range=1).orderBy("position").collect()
    assert [r["w"] for r in out] == ["alpha", "bravo", "charlie", "delta"]
    assert position.with_position(df.filter("false"), "w").count() == 0


@pytest.mark.parametrize("odd", [[float("nan")] * 3, [float("inf"), float("-inf")] * 4, [1.7e308, -1.7e308], [5e-324, 1e-323, 0.0]])
def test_quantiles_of_odd_values_are_alike_at_every_size(spark, odd):
    df = spark.createDataFrame([(float(i % 50),) for i in range(200)] + [(v,) for v in odd], "v double")
    qs = [0.0, 0.25, 0.5, 0.75, 1.0]
    small, large = density.quantiles(df, "v", qs), density.quantiles(df, "v", qs, sort_rows=20)
    assert large == pytest.approx(small, nan_ok=True)


@pytest.mark.parametrize("linkage, block_bytes", [("average", 1 << 20), ("ward", 100)])
def test_cluster_tree_in_tables(spark, linkage, block_bytes, monkeypatch):
    """State in tables gives the merges and states that the state at the driver gives."""
    x = RNG.normal(size=(8, 2))
    points = spark.createDataFrame([(3 * i + 1, [float(v) for v in row]) for i, row in enumerate(x)], "centre_id int, z array<double>")
    local, states = hierarchy.merge_tree(points, linkage).collect(), rows(hierarchy.agglomerate(points, linkage, 4))
    monkeypatch.setattr(hierarchy, "LOCAL_POINTS", 3)
    monkeypatch.setattr(hierarchy._merge_tables, "__defaults__", (block_bytes,))
    found = hierarchy.merge_tree(points, linkage).collect()
    assert sorted((r.a, r.b) for r in found) == sorted((r.a, r.b) for r in local)
    assert np.allclose(sorted(r.height for r in found), sorted(r.height for r in local))
    assert rows(hierarchy.agglomerate(points, linkage, 4)) == states


@pytest.mark.parametrize("sort_rows", [10**6, 10])
def test_quantiles_of_several_columns(spark, sort_rows):
    a, b = RNG.normal(size=3000), np.round(RNG.normal(size=3000), 1)
    b[:5], b[5:9], b[9:12] = np.nan, np.inf, -np.inf
    df = spark.createDataFrame([(float(p), float(q), None if i % 3 else 1.0) for i, (p, q) in enumerate(zip(a, b))], "a double, b double, c double")
    qs = [0.0, 0.001, 0.01, 0.25, 0.5, 0.99, 1.0]
    found = density.quantiles_of(df, ["a", "b", "c"], qs, sort_rows=sort_rows, accuracy=100)
    for c in "abc":
        assert np.array_equal(found[c], density.quantiles(df, c, qs), equal_nan=True), c
    assert density.quantiles_of(df.limit(0), ["a"], qs, sort_rows=sort_rows) == {"a": []}

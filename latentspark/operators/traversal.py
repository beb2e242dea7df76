"""Shortest paths between anchor particles on the neighbour graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from latentspark.session import broadcast_if_small, cut_lineage, has_rows

# Edges of one node that stay together; a node with more is split.
HUB_EDGES = 100_000

# Legs up to which the driver holds one distance per leg to stop early; results do not depend on it.
PRUNED_LEGS = 200_000


def anchor_legs(anchors: DataFrame) -> DataFrame:
    """Successive anchor pairs ``(leg, source, target)`` in anchor order.

    ``anchors`` is ``(centre_id, position)``, one row per centre.
    """
    order = Window.orderBy("centre_id")
    return anchors.select(
        (F.row_number().over(order) - 1).cast("int").alias("leg"),
        F.col("position").alias("source"),
        F.lead("position").over(order).alias("target"),
    ).filter(F.col("target").isNotNull())


def shortest_distances(edges: DataFrame, legs: DataFrame, *, to_targets: bool = False) -> DataFrame:
    """Distance of every node reached in each leg: ``(leg, node, dist, pred)``.

    All legs advance together, one edge per round, and only nodes improved in the
    round before are followed. A round writes just its improvements. Among equal
    distances the path with fewer edges wins, then the lower predecessor.
    ``to_targets`` stops following nodes that are already as far as the leg's
    target. Edge weights must not be negative.
    """
    legs = cut_lineage(legs)
    pruned = to_targets and legs.limit(PRUNED_LEGS + 1).count() <= PRUNED_LEGS
    ends = legs.select("leg", F.col("target").alias("node"))
    edges, hubs = _split_hubs(edges)
    graph = edges.repartition("src", "share").persist(StorageLevel.MEMORY_AND_DISK)
    best = F.min(F.struct("dist", "fresh", "pred")).alias("s")  # what is known wins a tie
    start = legs.select(
        "leg", F.col("source").alias("node"), F.lit(0.0).alias("dist"), F.lit(None).cast("bigint").alias("pred"))
    frontier = cut_lineage(start)
    known = frontier
    goals: dict[int, float] = {}
    while True:
        if pruned:  # one number per leg
            hit = F.collect_list(F.when(F.col("at_end"), F.struct("leg", "dist"))).alias("hits")
            left, hits = frontier.join(
                F.broadcast(ends.withColumn("at_end", F.lit(True))), ["leg", "node"], "left"
            ).agg(F.count("*"), hit).first()
            goals.update(hits)
        else:
            left = has_rows(frontier)
        if not left:
            break
        if goals:
            reached = F.broadcast(edges.sparkSession.createDataFrame(
                list(goals.items()), "leg int, goal double"))
            frontier = frontier.join(reached, "leg", "left").filter(
                F.col("goal").isNull() | (F.col("dist") < F.col("goal"))).drop("goal")
        moved = _to_shares(frontier, hubs).join(graph, ["src", "share"]).select(
            "leg", F.col("dst").alias("node"), (F.col("dist") + F.col("w")).alias("dist"),
            F.col("src").alias("pred"))
        both = known.withColumn("fresh", F.lit(False)).unionByName(moved.withColumn("fresh", F.lit(True)))
        frontier = cut_lineage(
            both.groupBy("leg", "node").agg(best).filter("s.fresh")
            .select("leg", "node", "s.dist", "s.pred"))
        known = known.unionByName(frontier)
    graph.unpersist()
    latest = F.min(F.struct("dist", "pred")).alias("s")
    return known.groupBy("leg", "node").agg(latest).select("leg", "node", "s.dist", "s.pred")


def _split_hubs(edges: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Edges with a ``share`` that cuts the edges of a crowded node into equal parts,
    and the table of those nodes: one row per ``HUB_EDGES`` edges at most."""
    edges = edges.select("src", "dst", "w")
    degree = edges.groupBy("src").agg(F.count("*").alias("n")).filter(F.col("n") > HUB_EDGES)
    hubs = cut_lineage(degree.select("src", F.ceil(F.col("n") / HUB_EDGES).cast("int").alias("shares")))
    if not has_rows(hubs):
        return edges.withColumn("share", F.lit(0)), None
    hubs = broadcast_if_small(hubs)
    share = F.pmod(F.xxhash64("dst"), F.coalesce("shares", F.lit(1))).cast("int")
    return edges.join(hubs, "src", "left").select("src", "dst", "w", share.alias("share")), hubs


def _to_shares(frontier: DataFrame, hubs: DataFrame | None) -> DataFrame:
    """Frontier rows, once per share of their node's edges."""
    nodes = frontier.withColumnRenamed("node", "src")
    if hubs is None:
        return nodes.withColumn("share", F.lit(0))
    last = F.coalesce(F.col("shares"), F.lit(1)) - 1
    return nodes.join(hubs, "src", "left").withColumn(
        "share", F.explode(F.sequence(F.lit(0), last))).drop("shares")


def graph_traversal(edges: DataFrame, anchors: DataFrame) -> DataFrame:
    """Shortest path of every leg as ``(leg, step, position, dist)``; ``dist`` is the
    way from the leg's source. An unreachable leg is one row with NULL position."""
    legs = cut_lineage(anchor_legs(anchors))
    state = cut_lineage(shortest_distances(edges, legs, to_targets=True))
    links = state.select("leg", "node", "dist", "pred")
    ends = legs.select("leg", F.col("target").alias("node"))
    found = links.join(broadcast_if_small(ends), ["leg", "node"])
    cursor = cut_lineage(ends.join(found, ["leg", "node"], "left").withColumn("back", F.lit(0)))
    steps, back = cursor, 0
    # One row per leg walks back along the predecessors; the state is only scanned.
    while has_rows(cursor.filter(F.col("pred").isNotNull())):
        back += 1
        here = cursor.filter(F.col("pred").isNotNull()).select("leg", F.col("pred").alias("node"))
        cursor = cut_lineage(
            links.join(broadcast_if_small(here), ["leg", "node"]).withColumn("back", F.lit(back)))
        steps = steps.unionByName(cursor)
    order = Window.partitionBy("leg").orderBy(F.desc("back"))
    reached = F.col("dist").isNotNull()
    return steps.select(
        "leg",
        (F.row_number().over(order) - 1).cast("int").alias("step"),
        F.when(reached, F.col("node")).alias("position"),
        "dist",
    )


def path_latents(path: DataFrame, latents: DataFrame) -> DataFrame:
    """Latent vector at every path step, in ``(leg, step)`` order."""
    return broadcast_if_small(path).join(latents.select("position", "z"), "position").orderBy("leg", "step")

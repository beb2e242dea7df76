"""Distributions: exact quantiles, histogram, hexagonal bins."""

from __future__ import annotations

import math
import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Rows one task may sort, and bins of one counting pass.
SORT_ROWS = 250_000
_BINS = 4_096


def quantiles(
    df: DataFrame, column: str, qs: Sequence[float], *, sort_rows: int = SORT_ROWS
) -> list[float]:
    """Exact quantiles with linear interpolation; NULLs are left out, none for no rows.

    ``percentile`` keeps all distinct values of a group in one task, so it serves
    small inputs only. For a large one, equal-width bins are counted, and the bin
    that holds a wanted rank is looked at again until it is small enough to sort
    or holds one value only.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    infinite = F.abs("v") == float("inf")
    finite = ~F.isnan("v") & ~infinite
    low, high, below_all, n_finite, above_all, n = values.agg(
        F.min(F.when(finite, F.col("v"))), F.max(F.when(finite, F.col("v"))),
        F.count_if(infinite & (F.col("v") < 0)), F.count_if(finite),
        F.count_if(infinite & (F.col("v") > 0)), F.count("*")).first()
    if n == 0:
        return []
    if n <= sort_rows:
        wanted = F.array(*[F.lit(float(q)) for q in qs])
        return list(values.agg(F.percentile("v", wanted).alias("q")).first()["q"])
    places = [q * (n - 1) for q in qs]
    ranks = {r for p in places for r in (math.floor(p), math.ceil(p))}
    # In Spark's order: -Infinity, the finite values, Infinity, NaN.
    found = {r: -math.inf if r < below_all else math.inf if r < below_all + n_finite + above_all else math.nan for r in ranks}
    inner = {r - below_all for r in ranks if below_all <= r < below_all + n_finite}
    if inner:
        hits = _values_at(values.filter(finite), low, high, n_finite, inner, sort_rows)
        found.update({r + below_all: v for r, v in hits.items()})
    result = []
    for p in places:
        below, above = found[math.floor(p)], found[math.ceil(p)]
        at = p - math.floor(p)
        result.append(below if at == 0 or below == above else (1 - at) * below + at * above)
    return result


def _values_at(
    values: DataFrame, low: float, high: float, n: int, ranks: set[int], sort_rows: int
) -> dict[int, float]:
    """Values at the 0-based ``ranks`` among the ``n`` finite values from ``low`` to ``high``."""
    if low == high:
        return {rank: low for rank in ranks}
    inside = values.filter(F.col("v").between(low, high))
    if n <= sort_rows:
        running = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        counted = inside.groupBy("v").agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(running))
        hits = [(F.col("upto") - F.col("n") <= r) & (F.col("upto") > r) for r in ranks]
        rows = counted.filter(reduce(operator.or_, hits)).collect()
        return {r: row["v"] for r in ranks for row in rows if row["upto"] - row["n"] <= r < row["upto"]}
    # The range itself may be too large for a double, its share is not.
    width = high / _BINS - low / _BINS
    if width == 0:  # fewer than _BINS doubles lie between low and high
        place = F.col("v")
    elif math.isinf(high - low):
        place = F.floor(F.col("v") / F.lit(width) - F.lit(low / width))
    else:
        place = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)), F.lit(_BINS - 1))
    bins = inside.groupBy(place.alias("b")).agg(
        F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("low").collect()
    found, before = {}, 0
    for b in bins:
        here = {rank - before for rank in ranks if before <= rank < before + b["n"]}
        if here:
            inner = _values_at(values, b["low"], b["high"], b["n"], here, sort_rows)
            found.update({rank + before: v for rank, v in inner.items()})
        before += b["n"]
    return found


def quantiles_of(
    df: DataFrame, columns: Sequence[str], qs: Sequence[float], *, sort_rows: int = SORT_ROWS, accuracy: int = 10_000
) -> dict[str, list[float]]:
    """Exact quantiles of several columns in two passes, however many columns there are.

    The first pass keeps a mergeable rank summary of every column, which brackets each wanted rank within a stated
    number of ranks. The second counts what lies below each bracket and the values inside it; the value of the
    rank follows. Small inputs are sorted in one pass. NULL, NaN and infinities are treated as in ``quantiles``.
    """
    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    finite = {i: F.when(~F.isnan(f"c{i}") & (F.abs(f"c{i}") != float("inf")), F.col(f"c{i}")) for i in range(len(columns))}
    margin = 2.0 / accuracy
    asked = sorted({min(1.0, max(0.0, q + d)) for q in qs for d in (-margin, margin)} | {0.0, 1.0})
    first = values.agg(*[x for i in range(len(columns)) for x in (
        F.count(f"c{i}").alias(f"n{i}"), F.count_if(F.col(f"c{i}") == float("-inf")).alias(f"low{i}"), F.count(finite[i]).alias(f"finite{i}"),
        F.count_if(F.col(f"c{i}") == float("inf")).alias(f"high{i}"),
        F.percentile_approx(finite[i], F.array(*map(F.lit, asked)), F.lit(accuracy)).alias(f"at{i}"),
        F.min(finite[i]).alias(f"min{i}"), F.max(finite[i]).alias(f"max{i}"))]).first()
    if max(first[f"n{i}"] for i in range(len(columns))) <= sort_rows:
        wanted = F.array(*[F.lit(float(q)) for q in qs])
        row = values.agg(*[F.percentile(f"c{i}", wanted).alias(f"q{i}") for i in range(len(columns))]).first()
        return {c: list(row[f"q{i}"] or []) for i, c in enumerate(columns)}
    # Brackets (column, rank among the finite values, low, high).
    brackets, places = [], {}
    for i, c in enumerate(columns):
        n, below, inner = first[f"n{i}"], first[f"low{i}"], first[f"finite{i}"]
        places[c] = [q * (n - 1) for q in qs] if n else []
        for rank in sorted({r - below for p in places[c] for r in (math.floor(p), math.ceil(p)) if below <= r < below + inner}):
            share = rank / max(1, inner - 1)
            low = max((v for q, v in zip(asked, first[f"at{i}"]) if q <= share - margin / 2), default=first[f"min{i}"])
            high = min((v for q, v in zip(asked, first[f"at{i}"]) if q >= share + margin / 2), default=first[f"max{i}"])
            brackets.append((i, rank, low, high))
    found = _inside(values, brackets)
    if any((i, rank) not in found for i, rank, _, _ in brackets):  # a summary worse than it states
        return {c: quantiles(df, c, qs, sort_rows=sort_rows) for c in columns}
    result = {}
    for i, c in enumerate(columns):
        below, inner, above = first[f"low{i}"], first[f"finite{i}"], first[f"high{i}"]

        def at(r: int) -> float:
            return -math.inf if r < below else found[i, r - below] if r < below + inner else math.inf if r < below + inner + above else math.nan

        result[c] = []
        for p in places[c]:
            a, b, share = at(math.floor(p)), at(math.ceil(p)), p - math.floor(p)
            result[c].append(a if share == 0 or a == b else (1 - share) * a + share * b)
    return result


def _inside(values: DataFrame, brackets: Sequence[tuple[int, int, float, float]]) -> dict[tuple[int, int], float]:
    """Values at the ranks of ``(column, rank, low, high)``, from one pass over the rows."""
    if not brackets:
        return {}
    hits = [F.when(F.col(f"c{i}") < low, F.struct(F.lit(k).alias("k"), F.lit(None).cast("double").alias("v"))).when(
        F.col(f"c{i}").between(low, high), F.struct(F.lit(k).alias("k"), F.col(f"c{i}").alias("v")))
        for k, (i, _, low, high) in enumerate(brackets)]
    rows = values.select(F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())).alias("x")).groupBy("x.k", "x.v").agg(F.count("*").alias("n"))
    # What lies below a bracket is one row, with no value, which comes first.
    upto = Window.partitionBy("k").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    rank = F.element_at(F.array(*[F.lit(r).cast("bigint") for _, r, _, _ in brackets]), F.col("k") + 1)
    placed = rows.withColumn("upto", F.sum("n").over(upto)).where((F.col("upto") - F.col("n") <= rank) & (F.col("upto") > rank) & F.col("v").isNotNull())
    return {(brackets[r["k"]][0], brackets[r["k"]][1]): r["v"] for r in placed.select("k", "v").collect()}


def latent_distribution(
    latents: DataFrame, qs: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0), **options
) -> DataFrame:
    """Quantile summary of a one-dimensional latent coordinate as ``(q, z)``."""
    values = latents.select(F.get("z", F.lit(0)).alias("z"))
    rows = list(zip(map(float, qs), quantiles(values, "z", qs, **options)))
    return latents.sparkSession.createDataFrame(rows, "q double, z double")


def latent_coordinates(latents: DataFrame) -> DataFrame:
    """The one-dimensional latent coordinate of every particle."""
    return latents.select("position", F.get("z", F.lit(0)).alias("z"))


def latent_histogram(latents: DataFrame, bins: int = 50) -> DataFrame:
    """Counts in equal bins from the smallest to the largest value, as
    ``(bin, low, high, particles)``. The last bin includes its upper end; empty
    bins have no row, and equal values all fall in bin 0."""
    values = latents.select(F.get("z", F.lit(0)).alias("z"))
    low, high = values.agg(F.min("z"), F.max("z")).first()
    if low is None:
        return latents.sparkSession.createDataFrame(
            [], "bin int, low double, high double, particles bigint")
    width = (high - low) / bins
    place = F.lit(0) if width == 0 else F.least(
        F.floor((F.col("z") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return values.filter(F.col("z").isNotNull()).groupBy(place.alias("bin")).agg(
        F.count("*").alias("particles")).select(
            "bin", (F.lit(low) + F.col("bin") * width).alias("low"),
            (F.lit(low) + (F.col("bin") + 1) * width).alias("high"), "particles")


def hexbin(points: DataFrame, gridsize: int = 30) -> DataFrame:
    """Points per hexagonal cell as ``(hex_u, hex_v, points)`` with the cell centres.

    Two rectangular lattices, shifted by half a step, hold the cell centres; a
    point belongs to the nearer of its two candidates, the unshifted on a tie.
    """
    u, v = F.col("u").cast("double"), F.col("v").cast("double")
    u0, u1, v0, v1 = points.agg(F.min(u), F.max(u), F.min(v), F.max(v)).first()
    if u0 is None:
        return points.sparkSession.createDataFrame([], "hex_u double, hex_v double, points bigint")
    step_u = (u1 - u0) / gridsize or 1.0
    step_v = (v1 - v0) / max(1, int(gridsize / math.sqrt(3))) or 1.0
    x, y = (u - u0) / step_u, (v - v0) / step_v
    ix, iy = F.floor(x + 0.5), F.floor(y + 0.5)
    jx, jy = F.floor(x) + 0.5, F.floor(y) + 0.5

    def apart(cx: Column, cy: Column) -> Column:
        return (x - cx) * (x - cx) + 3.0 * (y - cy) * (y - cy)

    straight = apart(ix, iy) <= apart(jx, jy)
    cell = points.filter(u.isNotNull() & v.isNotNull()).select(
        F.when(straight, ix.cast("double")).otherwise(jx).alias("cx"),
        F.when(straight, iy.cast("double")).otherwise(jy).alias("cy"))
    return cell.groupBy("cx", "cy").agg(F.count("*").alias("points")).select(
        (F.lit(u0) + F.col("cx") * step_u).alias("hex_u"),
        (F.lit(v0) + F.col("cy") * step_v).alias("hex_v"), "points")

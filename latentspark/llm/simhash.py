"""SimHash near-duplicates by anchor-point covering.

Fingerprint: a bit is 1 if it is set in over half of the XXH64 values of the text's three-word shingles.

Anchors are the words of a covering code: two blocks of 23 bits are taken from the 64, and each block's
anchors are the words of the perfect binary Golay code, whose covering radius is 3; the other bits are
free. Every fingerprint has a home, its nearest anchor in both blocks, and is copied to every anchor
within the covering radius plus the threshold (in each block, and the excess over the radius is at most
the threshold in sum). Two fingerprints within the threshold therefore meet at the home of either, where
those that live there are compared with those copied there.

At an anchor with more than ``CROWD`` homes comparing all would be quadratic. The fingerprints that reach
such an anchor are linked exactly in another way: two words within 2 bits have a word within 1 bit of
both, so each is sent to the 65 words within 1 bit, and those that meet there are linked to the smallest.
At most 65 distinct fingerprints can meet at a word.

Null and empty texts have fingerprint 0, which is linked like any other. Null ids count as the largest; a
component of null ids has none. Repeated rows have equal results; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latentspark.llm.words import LOWER
from latentspark.session import cut_lineage

THRESHOLD = 2
SHINGLE = 3
CROWD = 32
_RADIUS = 3
_LENGTH = 23
# Generator polynomial of the perfect binary Golay code: x^11+x^10+x^6+x^5+x^4+x^2+1.
_POLYNOMIAL = 0b110001110101
_PART = 1 << 16


def _fingerprint(text: bytes, shingle: int, seed: int) -> int:
    words = text.translate(LOWER.tobytes()).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    starts, ends = starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(starts), _PART):
        part = list(zip(starts[i:i + _PART], ends[i:i + _PART]))
        h = np.fromiter((digest(joined[a:b], seed) for a, b in part), np.uint64, len(part))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits((2 * ones > len(starts)).astype(np.uint8), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprint(text: Column, shingle: int = SHINGLE, seed: int = 42) -> Column:
    """64-bit SimHash as a long; words are separated by ASCII white space, A-Z are lower-cased."""
    @F.arrow_udf("bigint")
    def run(batch: pa.Array) -> pa.Array:
        return pa.array([_fingerprint((t.as_buffer().to_pybytes() if t.is_valid else b""), shingle, seed) for t in batch],
                        pa.int64())
    return run(text)


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` of every document, written once."""
    return cut_lineage(documents.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col)).alias("fp")))


def _remainders(words: np.ndarray) -> np.ndarray:
    """Syndromes: remainders of 23-bit words by the generator polynomial."""
    out = words.copy()
    for bit in range(_LENGTH - 1, 10, -1):
        out = np.where(out >> bit & 1, out ^ (_POLYNOMIAL << (bit - 11)), out)
    return out


def _covers(excess: int) -> list[list[np.ndarray]]:
    """For each syndrome and e = 0..excess, the differences to code words at distance radius + e (e = 0: up to radius)."""
    found = [[[] for _ in range(excess + 1)] for _ in range(2048)]
    for weight in range(_RADIUS + excess + 1):
        masks = np.array([sum(1 << i for i in c) for c in combinations(range(_LENGTH), weight)], np.int64)
        for mask, s in zip(masks.tolist(), _remainders(masks).tolist()):
            found[s][max(0, weight - _RADIUS)].append(mask)
    return [[np.array(m, np.int64) for m in per] for per in found]


def _blocks_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.int64((1 << _LENGTH) - 1)
    return fp & mask, fp >> _LENGTH & mask


def _home(fp: Column) -> Column:
    @F.arrow_udf("bigint")
    def run(batch: pa.Array) -> pa.Array:
        leader = np.array([per[0][0] for per in _covers(0)], np.int64)
        low, high = _blocks_of(np.asarray(batch, np.int64))
        low, high = low ^ leader[_remainders(low)], high ^ leader[_remainders(high)]
        return pa.array(high << _LENGTH | low)
    return run(fp)


def _reach(fp: Column, threshold: int) -> Column:
    @F.arrow_udf("array<bigint>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        covers = _covers(threshold)
        for batch in batches:
            low, high = _blocks_of(np.asarray(batch, np.int64))
            s, t = _remainders(low), _remainders(high)
            out = []
            for a, b, p, q in zip(low.tolist(), high.tolist(), s.tolist(), t.tolist()):
                anchors = [((b ^ covers[q][f])[:, None] << _LENGTH | (a ^ covers[p][e])).ravel()
                           for e in range(threshold + 1) for f in range(threshold + 1 - e)]
                out.append(np.concatenate(anchors))
            yield pa.array(out, pa.list_(pa.int64()))
    return run(fp)


def links(fps: DataFrame, threshold: int = THRESHOLD, crowd: int = CROWD) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fp``) that join all within ``threshold`` (at most 2).

    Every pair within the threshold is linked, directly or, at crowded anchors, through a third
    fingerprint within the threshold of both.
    """
    if not 0 <= threshold <= 2:
        raise ValueError("the exact way for crowded anchors needs a threshold of at most 2")
    homes = cut_lineage(fps.select("fp", _home(F.col("fp")).alias("anchor")))
    counts = homes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    settled = homes.join(counts.where(F.col("n") <= crowd), "anchor").select("anchor", F.col("fp").alias("home"))
    crowded = counts.where(F.col("n") > crowd).select("anchor", F.lit(None).cast("bigint").alias("home"))
    reach = fps.select("fp", F.explode(_reach(F.col("fp"), threshold)).alias("anchor"))
    met = cut_lineage(reach.join(settled.union(crowded).hint("shuffle_hash"), "anchor").where(
        F.col("home").isNull() | ((F.col("fp") != F.col("home")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("home"))) <= threshold))
    ).select("fp", "home"))
    direct = met.where(F.col("home").isNotNull()).select(F.col("fp").alias("a"), F.col("home").alias("b"))
    near = [0] + [1 << i if i < 63 else -(1 << 63) for i in range(64)]
    # Within 1 bit of a word there are at most 65 distinct fingerprints, so the sets are bounded.
    meeting = (met.where(F.col("home").isNull()).select("fp").distinct()
               .select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(m)) for m in near])).alias("word"))
               .groupBy("word").agg(F.sort_array(F.collect_set("fp")).alias("fps")).where(F.size("fps") > 1))
    stars = meeting.select(F.get("fps", F.lit(0)).alias("b"), F.explode("fps").alias("a")).where("a <> b").select("a", "b")
    if threshold < 2:
        stars = stars.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= threshold)
    return direct.union(stars).distinct()


def roots(edges: DataFrame) -> DataFrame:
    """``fp, root``: the smallest fingerprint that is reachable over ``edges`` (``a, b``).

    Every round takes the smallest root among neighbours and then jumps to that root's root.
    """
    both = cut_lineage(edges.union(edges.select("b", "a")).distinct())
    state = cut_lineage(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("fp"), F.least("a", "b").alias("root")))
    while True:
        offered = both.join(state.select(F.col("fp").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("offer"))
        hooked = state.join(offered, F.col("fp") == F.col("a")).select("fp", "root", F.least("root", "offer").alias("next"))
        # The root that a neighbour offered may itself have found a smaller one.
        jump = state.select(F.col("fp").alias("next"), F.col("root").alias("further"))
        moved = cut_lineage(hooked.join(jump, "next").select("fp", "root", F.least("next", "further").alias("next")))
        changed = moved.where("next <> root").limit(1).count()
        state = moved.select("fp", F.col("next").alias("root"))
        if not changed:
            return state


def components(prints: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id, fp, component_id`` from ``doc_id, fp``; the id is the smallest doc_id reachable."""
    kinds = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    linked = roots(links(kinds.select("fp"), threshold))
    rooted = kinds.join(linked, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = cut_lineage(rooted)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")

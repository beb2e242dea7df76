"""Quality classifier: hashed word n-grams, follow-the-regularised-leader, sparse dot products.

Words are runs of letters and digits, or of other signs. Features of a text are its lower-cased
words, its word pairs, a mark for a word that repeats the one before and a mark for words in
capitals, hashed into ``2 ** bits`` buckets; a feature's value is its share of the text's words.

Null and empty texts have no features: their score is that of the bias. Repeated rows score alike.
With an empty table, or labels of one class only, the bias alone is learned. Other columns pass
through; only the output column's name is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latentspark.llm.common import labelled_sample
from latentspark.llm.words import CLASSES, blocks, hash_spans, mix, owners, spans, text_bytes

BITS = 20
SAMPLE_ROWS = 6000
SAMPLE_BYTES = 32_768
_SCORED = 1 << 20        # bytes of text scored together, which take about 40 bytes each
_REPEAT, _CAPITALS, _PAIR = np.uint64(1), np.uint64(2), np.uint64(0xD6E8FEB86659FD93)
_UPPER = np.zeros(256, np.uint8)
_UPPER[ord("A"):ord("Z") + 1] = 1


class Model(NamedTuple):
    weights: np.ndarray
    bias: float
    bits: int


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index and bucket of every feature occurrence, and the number of words of each text."""
    starts, ends = spans(data, offsets, CLASSES)
    own = owners(offsets, starts)
    h = hash_spans(data, starts, ends)
    upper = np.concatenate(([0], np.cumsum(_UPPER[data], dtype=np.int64)))
    capitals = (upper[ends] - upper[starts] == ends - starts) & (ends - starts > 1)
    follows = own[1:] == own[:-1]
    pair = mix(h[:-1] * _PAIR + h[1:])
    pair[h[1:] == h[:-1]] = mix(np.array([_REPEAT]))[0]
    shift = np.uint64(64 - bits)
    where = np.concatenate((own, own[1:][follows], own[capitals]))
    keys = np.concatenate((h, pair[follows], np.full(capitals.sum(), mix(np.array([_CAPITALS]))[0], np.uint64)))
    return where, (keys >> shift).astype(np.int64), np.bincount(own, minlength=len(offsets) - 1)


def _sparse(text: Column, bits: int) -> Column:
    """Distinct buckets and shares of each text, for training."""
    kind = "struct<buckets:array<int>,shares:array<float>>"

    @F.arrow_udf(kind)
    def run(batch: pa.Array) -> pa.Array:
        data, offsets = text_bytes(batch)
        buckets, shares = [], []
        for i in range(len(batch)):
            part = data[offsets[i]:offsets[i + 1]]
            _, keys, words = features(part, np.array([0, len(part)]), bits)
            found, counts = np.unique(keys, return_counts=True)
            buckets.append(found.astype(np.int32))
            shares.append((counts / max(1, words[0])).astype(np.float32))
        return pa.StructArray.from_arrays(
            [pa.array(buckets, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))], ["buckets", "shares"])
    return run(text)


def follow_leader(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int, passes: int = 5, alpha: float = 2.0,
                  beta: float = 1.0, l1: float = 0.005, l2: float = 0.01) -> Model:
    """FTRL-proximal over the examples, per-coordinate rates; the bias has no L1."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bias_z = bias_n = bias = 0.0

    def solve(z, n):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    positive = sum(y for *_, y in rows)
    # Both classes weigh alike, so that the rarer one is learned too.
    weigh = {1: len(rows) / (2 * max(1, positive)), 0: len(rows) / (2 * max(1, len(rows) - positive))}
    order = np.random.default_rng(7)
    for _ in range(passes):
        for i in order.permutation(len(rows)):
            at, x, y = rows[i]
            at, x = np.asarray(at, np.int64), np.asarray(x, np.float64)
            w = solve(z[at], n[at])
            p = 1 / (1 + np.exp(-np.clip(w @ x + bias, -35, 35)))
            error = (p - y) * weigh[y]
            g = error * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
            bias_z += error - (np.sqrt(bias_n + error * error) - np.sqrt(bias_n)) / alpha * bias
            bias_n += error * error
            bias = -bias_z / ((beta + np.sqrt(bias_n)) / alpha + l2)
    weights, seen = np.zeros(1 << bits, np.float32), np.flatnonzero(n)
    weights[seen] = solve(z[seen], n[seen])
    return Model(weights, float(bias), bits)


def train(documents: DataFrame, labels: DataFrame, train_rows: Column, label: str = "quality", bits: int = BITS,
          rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on at most ``rows`` labelled documents of at most ``max_bytes`` (the documented bound).

    The sample does not come to the driver: a task fits, and the weights other than zero come back.
    """
    sample = labelled_sample(documents, labels, label, train_rows, rows, max_bytes)
    found = sample.select("y", "at", _sparse(F.col("text"), bits).alias("f")).select("y", "at", "f.buckets", "f.shares")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = sorted((row for batch in batches for row in zip(
            batch["at"].to_pylist(), batch["buckets"], batch["shares"], batch["y"].to_pylist())), key=lambda row: row[0])
        model = follow_leader([(b.values.to_numpy(), s.values.to_numpy(), y) for _, b, s, y in examples], bits)
        kept = np.flatnonzero(model.weights)
        yield pa.RecordBatch.from_pydict({"buckets": [kept.astype(np.int32)], "weights": [model.weights[kept]], "bias": [model.bias]},
                                         pa.schema([("buckets", pa.list_(pa.int32())), ("weights", pa.list_(pa.float32())), ("bias", pa.float64())]))

    fitted = found.repartition(1).mapInArrow(fit, "buckets array<int>, weights array<float>, bias double").toArrow()
    weights, bias = np.zeros(1 << bits, np.float32), 0.0
    if fitted.num_rows:
        weights[fitted["buckets"][0].values.to_numpy()] = fitted["weights"][0].values.to_numpy()
        bias = fitted["bias"][0].as_py()
    return Model(weights, bias, bits)


def score(text: Column, model_of) -> Column:
    """Probability of label 1; ``model_of`` broadcasts ``(weights, bias, bits)``."""
    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, bias, bits = model_of.value
        for batch in batches:
            data, offsets = text_bytes(batch)
            out = np.zeros(len(batch))
            for i, j in blocks(offsets, _SCORED):
                part = data[offsets[i]:offsets[j]]
                where, keys, words = features(part, offsets[i:j + 1] - offsets[i], bits)
                dot = np.bincount(where, weights[keys], minlength=j - i) / np.maximum(words, 1)
                out[i:j] = 1 / (1 + np.exp(-np.clip(dot + bias, -35, 35)))
            yield pa.array(out)
    return run(text)

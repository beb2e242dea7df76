"""Toxicity: logistic regression whose score may not change when identity terms are swapped.

A text is the set of its lower-cased words. Sentences end at a full stop, an exclamation or question mark or a
line end. Training adds to the log loss of the labelled texts, for every sentence of theirs that names a group and
every other term of that kind, the squared difference between the sentence's score and its score with the term
replaced; so a mention alone does not raise a score. Words are chosen by an L1 screen, which identity terms do
not pass through: they are always in the model, where the penalty acts on them.

Null and empty texts get the score of the bias; repeated rows score alike; an empty table or
labels of one class give a model without words. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latentspark.llm.common import labelled_sample
from latentspark.llm.words import CLASSES, blocks, hash_spans, owners, spans, text_bytes

SAMPLE_ROWS = 8000
SAMPLE_BYTES = 32_768
SWAP_PENALTY = 10.0
# Terms of one group stand for each other in the counterfactuals.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("she", "he"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrant", "native", "refugee", "foreigner"), ("disabled", "deaf", "blind", "autistic"),
    ("old", "young", "elderly", "teenage"),
)
_WORDS = np.where(CLASSES == 1, 1, 0).astype(np.uint8)


class Model(NamedTuple):
    keys: np.ndarray     # sorted word hashes
    weights: np.ndarray
    bias: float


def word_hash(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    return hash_spans(data, np.array([0]), np.array([len(data)]))[0]


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = spans(data, offsets, _WORDS)
    return owners(offsets, starts), hash_spans(data, starts, ends)


_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n")] = True


def sentences_of(data: np.ndarray, offsets: np.ndarray, groups=IDENTITY_TERMS) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """Of every text its distinct words, and those of each sentence that holds an identity term, in order."""
    terms = np.array([word_hash(w) for g in groups for w in g], np.uint64)
    starts, ends = spans(data, offsets, _WORDS)
    own, h = owners(offsets, starts), hash_spans(data, starts, ends)
    sentence = np.searchsorted(np.flatnonzero(_ENDS[data]), starts)
    cuts, named, out = np.searchsorted(own, np.arange(len(offsets))), np.isin(h, terms), []
    for a, b in zip(cuts[:-1], cuts[1:]):
        chosen = np.unique(sentence[a:b][named[a:b]])
        low, high = (np.searchsorted(sentence[a:b], chosen, side) for side in ("left", "right"))
        out.append((np.unique(h[a:b]), [np.unique(h[a + i:a + j]) for i, j in zip(low, high)]))
    return out


def _word_sets(text: Column) -> Column:
    @F.arrow_udf("struct<words:array<bigint>,named:array<array<bigint>>>")
    def run(batch: pa.Array) -> pa.Array:
        found = sentences_of(*text_bytes(batch))
        return pa.StructArray.from_arrays([
            pa.array([w.view(np.int64) for w, _ in found], pa.list_(pa.int64())),
            pa.array([[n.view(np.int64) for n in named] for _, named in found], pa.list_(pa.list_(pa.int64())))], ["words", "named"])
    return run(text)


def counterfactuals(sets: list[np.ndarray], groups=IDENTITY_TERMS) -> list[tuple[int, np.uint64, np.uint64]]:
    """(sentence, term, replacement) for every identity term in a sentence and every other of its group that is not."""
    kinds = [[word_hash(w) for w in g] for g in groups]
    out = []
    for i, words in enumerate(sets):
        for kind in kinds:
            named = np.isin(kind, words)
            out += [(i, a, b) for a, on in zip(kind, named) if on for b, there in zip(kind, named) if not there]
    return out


def _columns(sets: list[np.ndarray], keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of every word of ``keep`` in the sets."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate([np.zeros(0, np.uint64), *sets])
    col = np.minimum(np.searchsorted(keep, flat), len(keep) - 1)
    known = keep[col] == flat
    return row[known], col[known]


class _Swaps(NamedTuple):
    """Sentences as rows and columns, and for each swap its sentence, the term and the replacement."""

    row: np.ndarray
    col: np.ndarray
    of: np.ndarray
    a: np.ndarray
    b: np.ndarray
    sentences: int

    def gradient(self, w: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
        """Of the mean of ``(score - swapped score)^2``."""
        base = (np.bincount(self.row, w[self.col], self.sentences) + bias)[self.of]
        p, q = (1 / (1 + np.exp(-np.clip(x, -35, 35))) for x in (base, base - w[self.a] + w[self.b]))
        change, slope_p, slope_q = 2 * (p - q) / len(self.of), p * (1 - p), q * (1 - q)
        # Words that both sentences hold move both scores.
        both = np.bincount(self.of, change * (slope_p - slope_q), self.sentences)
        g = np.bincount(self.col, both[self.row], len(w))
        # The term is in the first only, the replacement in the second only.
        g += np.bincount(self.a, change * slope_q, len(w)) - np.bincount(self.b, change * slope_q, len(w))
        return g, float(both.sum())


def fit(sets: list[np.ndarray], y: np.ndarray, sentences: list[np.ndarray], swap_penalty: float = SWAP_PENALTY, groups=IDENTITY_TERMS,
        min_texts: int = 3, rounds: int = 120, noise: float = 4.5) -> Model:
    """Proximal AdaGrad on log loss + counterfactual penalty + L1 at ``noise`` standard errors a word."""
    if not len(sets):
        return Model(np.zeros(0, np.uint64), np.zeros(0), 0.0)
    rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    bias = float(np.log(rate / (1 - rate)))
    keys, texts = np.unique(np.concatenate(sets), return_counts=True)
    pairs = counterfactuals(sentences, groups)
    named = np.unique(np.array([h for _, a, b in pairs for h in (a, b)], np.uint64))
    keep = np.union1d(keys[texts >= min_texts], named)
    if not len(keep) or y.min() == y.max():
        return Model(np.zeros(0, np.uint64), np.zeros(0), bias)
    free = np.isin(keep, named)
    count = np.bincount(_columns(sets, keep)[1], minlength=len(keep))
    l1 = np.where(free, 0.0, noise * np.sqrt(np.maximum(count, 1) * rate * (1 - rate)) / len(sets))
    w, bias = _descend(sets, y, sentences, pairs, keep, l1, bias, swap_penalty, rounds)
    # L1 chose the words but shrank their weights: fit those words again without it.
    keep = keep[(w != 0) | free]
    w, bias = _descend(sets, y, sentences, pairs, keep, np.zeros(len(keep)), bias, swap_penalty, 2 * rounds)
    return Model(keep, w, float(bias))


def _descend(sets, y, sentences, pairs, keep, l1, bias, swap_penalty, rounds):
    """Weights and bias after ``rounds`` of proximal AdaGrad."""
    if not len(keep):
        return np.zeros(0), bias
    (row, col), (srow, scol) = _columns(sets, keep), _columns(sentences, keep)
    of, a, b = (np.array([p[i] for p in pairs], kind) for i, kind in enumerate((np.int64, np.uint64, np.uint64)))
    swaps = _Swaps(srow, scol, of, np.searchsorted(keep, a), np.searchsorted(keep, b), len(sentences))
    w, seen, bias_seen, n = np.zeros(len(l1)), np.full(len(l1), 1e-12), 1e-12, len(y)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[col], n) + bias, -35, 35)))
        error = (p - y) / n
        g, slope = np.bincount(col, error[row], len(w)) + 1e-5 * w, error.sum()
        if len(of) and swap_penalty:
            more, also = swaps.gradient(w, bias)
            g, slope = g + swap_penalty * more, slope + swap_penalty * also
        seen += g * g
        step = 0.3 / np.sqrt(seen)
        w = w - step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        bias_seen += slope ** 2
        bias -= 0.3 / np.sqrt(bias_seen) * slope if bias_seen > 1e-10 else 0.0
    return w, bias


def train(documents: DataFrame, labels: DataFrame, train_rows: Column, label: str = "toxic", rows: int = SAMPLE_ROWS,
          max_bytes: int = SAMPLE_BYTES, **settings) -> Model:
    """Fit on at most ``rows`` labelled documents of at most ``max_bytes`` (the documented bound)."""
    sample = labelled_sample(documents, labels, label, train_rows, rows, max_bytes)
    found = sample.select("y", "at", _word_sets(F.col("text")).alias("f")).select("y", "at", "f.words", "f.named").toArrow().sort_by("at")
    sets = [np.asarray(w.values, np.int64).view(np.uint64) for w in found["words"]]
    sentences = [np.array(n, np.int64).view(np.uint64) for named in found["named"].to_pylist() for n in named]
    return fit(sets, np.asarray(found["y"], float), sentences, **settings)


def score(text: Column, model_of) -> Column:
    """Probability that the text is toxic; ``model_of`` broadcasts ``(keys, weights, bias)``."""
    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        keys, weights, bias = model_of.value
        for batch in batches:
            data, offsets = text_bytes(batch)
            total = np.full(len(batch), bias)
            for i, j in blocks(offsets):
                own, h = words_of(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    hit = keys[at] == h
                    pair = np.unique(own[hit] * len(keys) + at[hit])
                    total[i:j] += np.bincount(pair // len(keys), weights[pair % len(keys)], j - i)
            yield pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))
    return run(text)

"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Words are runs of letters and digits, ASCII lower-cased. A document leaks an item of m words if some run of
its words is within ``floor(edits * m)`` word edits (insert, delete, replace) of the item.

From every word of a document a window of m words starts, for every item length m. A leak implies that at
least ``m`` less the allowed edits of the window's words occur in items of that length, so other windows
are skipped without loss. The rest are embedded by random walks: at step j the walk writes the current
word and moves on or stays, by a random bit of (j, word); edit distance becomes Hamming distance. Walks are
sampled at a few steps at a time; windows that agree with an item in all steps of one sample are candidates, whose edit
distance to the text around is then computed in full. How many walks and samples an item gets depends on its
length: ``lsh_plan`` simulates deletions, insertions and replacements at the largest allowed distance and
takes the cheapest choice that finds ``TARGET`` of each.

What the samples miss is found by pieces: an item is also cut into one piece more than its allowed edits, so a leak
holds one of the pieces unchanged, and every place of a piece gives a candidate. So no leak within the
allowed distance is missed. Items are taken in blocks of about ``BLOCK_BYTES``, each block against all documents; rows
of one item id are in one block, so the result does not depend on its size. No document is cut.

Null and empty texts leak nothing; items without words are leaked by nothing. Null ids are values. Repeated
rows give repeated results. Empty tables give none. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latentspark.llm.words import CLASSES, blocks, hash_spans, owners, spans, text_bytes

EDITS = 0.2
TARGET = 0.9             # share of leaks at the largest distance that the samples alone find
BLOCK_BYTES = 8 << 20    # of item texts that are searched together
_ROWS = 4096
_WINDOWS = 16_384        # embedded together
_HITS = 512
_STEP = np.uint64(0x9E3779B97F4A7C15)
_TEXT = 1 << 21          # bytes of text searched together
_WORDS = np.where(CLASSES == 1, 1, 0).astype(np.uint8)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = spans(data, offsets, _WORDS)
    return owners(offsets, starts), hash_spans(data, starts, ends)


def embed(words: np.ndarray, bits: np.ndarray, steps: int) -> np.ndarray:
    """CGK walk of every row of word numbers.

    ``bits`` has 64 steps' random bits of every word in each row; the last word marks the end, where a walk
    stays.
    """
    n, m = words.shape
    padded = np.concatenate((words, np.full((n, 1), bits.shape[1] - 1, words.dtype)), axis=1).ravel()
    out = np.empty((steps, n), words.dtype)
    place = np.arange(n) * (m + 1)
    for j in range(steps):
        padded.take(place, out=out[j])
        place += (bits[j >> 6].take(out[j]) >> np.uint64(j & 63) & np.uint64(1)).view(np.int64)
    return out


def best_match(item: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest word edit distance of ``item`` to any run of each row of ``text`` (-1 matches nothing).

    Gives the distance and the run's start and end, of equal ones the first to end.
    """
    n, width = text.shape
    text = np.ascontiguousarray(text.T)
    # Distance and start travel together: the smaller distance wins, then the later start.
    scale = width + 2
    cost = np.repeat((width + 1 - np.arange(width + 1))[:, None], n, axis=1)
    ramp = (np.arange(width + 1) * scale)[:, None]
    for word in item.tolist():
        across = np.empty_like(cost)
        across[0] = cost[0] + scale
        np.minimum(cost[1:] + scale, cost[:-1] + np.where(text == word, 0, scale), out=across[1:])
        # Words of the text that match nothing: the running minimum, one step dearer at each place.
        cost = np.minimum.accumulate(across - ramp, axis=0) + ramp
    end = (cost // scale).argmin(0)
    best = cost[end, np.arange(n)]
    return best // scale, width + 1 - best % scale, end


def _class_of(m: int) -> int:
    """Lengths share a plan up to the next of 8, 12, 16, 24, 32, 48, …"""
    top = 8
    while top < m:
        top = top * 3 // 2 if top & (top - 1) == 0 else top * 4 // 3
    return top


def simulated_agreement(m: int, edits: float, walks: int, trials: int = 40, seed: int = 5) -> dict[str, np.ndarray]:
    """Share of equal steps of an item's and its leak's walks, by kind of edit: a row per trial, a column per walk."""
    rng, count = np.random.default_rng([seed, m]), int(edits * m + 1e-9)
    unknown, end = m, m + 1
    item = np.tile(np.arange(m), (trials, 1))
    out = {}
    for kind in ("delete", "insert", "replace"):
        window = np.full((trials, m), unknown)
        for t in range(trials):
            at = np.sort(rng.choice(m, count, replace=False))
            if kind == "delete":
                kept = np.delete(np.arange(m), at)
            elif kind == "insert":
                kept = np.insert(np.arange(m), at, unknown)[:m]
            else:
                kept = np.arange(m)
                kept[at] = unknown
            window[t, :len(kept)] = kept
        share = np.empty((trials, walks))
        for w in range(walks):
            bits = rng.integers(0, 1 << 64, ((2 * m >> 6) + 1, end + 1), np.uint64)
            bits[:, end] = 0
            share[:, w] = (embed(item, bits, 2 * m) == embed(window, bits, 2 * m)).mean(0)
        out[kind] = share
    return out


def lsh_plan(lengths, edits: float = EDITS, target: float = TARGET) -> dict[int, tuple[int, int, int]]:
    """``walks, samples, bits`` by class of length: the cheapest whose simulated recall is ``target`` for every kind of edit."""
    plan = {}
    for top in sorted({_class_of(m) for m in lengths}):
        shares = simulated_agreement(top, edits, 8).values()
        best = None
        for walks in (2, 3, 4, 6, 8):
            for bits in (3, 2):
                for samples in (14, 28, 42, 56, 84, 112, 168):
                    missed = [((1 - share[:, :walks] ** bits) ** samples).prod(axis=1).mean() for share in shares]
                    # Two steps of a sample tell less than three, so they give more candidates to verify.
                    cost = walks * (2 * top + samples * bits) * (1 if bits == 3 else 2)
                    found = (max(missed) > 1 - target, max(missed) if max(missed) > 1 - target else cost)
                    if best is None or found < best[0]:
                        best = found, (walks, samples, bits)
        plan[top] = best[1]
    return plan


class Index:
    """Searchable items: word numbers, lengths, embeddings' samples."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]], edits: float, plan: dict[int, tuple[int, int, int]],
                 pieces: bool = True, seed: int = 11):
        items = [(i, h) for i, h in items if len(h)]
        self.edits = edits
        self.vocabulary = np.unique(np.concatenate([h for _, h in items])) if items else np.zeros(0, np.uint64)
        self.unknown = len(self.vocabulary)
        end = self.unknown + 1
        rng = np.random.default_rng(seed)
        self.salt = rng.integers(0, 1 << 64, (3, end + 1), np.uint64)
        self.value = np.random.default_rng(seed + 1).integers(0, 1 << 64, end + 1, np.uint64)
        self.bits: list[np.ndarray] = []
        for w in range(max((walks for walks, _, _ in plan.values()), default=0) if items else 0):
            longest = max((len(h) for _, h in items if plan[_class_of(len(h))][0] > w), default=1)
            self.bits.append(rng.integers(0, 1 << 64, ((2 * longest >> 6) + 1, end + 1), np.uint64))
            self.bits[-1][:, end] = 0
        self.classes = {}
        for m in sorted({len(h) for _, h in items}):
            walks, samples, bits = plan[_class_of(m)]
            own = [(i, np.searchsorted(self.vocabulary, h)) for i, h in items if len(h) == m]
            matrix = np.array([h for _, h in own])
            held = np.zeros(end + 1, bool)  # words of any item of the length
            held[matrix] = True
            columns = [rng.integers(0, 2 * m, (samples, bits)) for _ in range(walks)]
            keys = []
            for b, c in zip(self.bits, columns):
                key = self._keys(embed(matrix, b, 2 * m), c).ravel()
                order = np.argsort(key, kind="stable")
                keys.append((key[order], order % len(own)))
            self.classes[m] = ([i for i, _ in own], matrix, held, columns, keys)
        self.pieces = self._pieces() if pieces else {}
        self.marks = np.zeros(end + 1, bool)

    def _pieces(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By length: sorted hashes of the items' pieces, and each one's item length, item and place.

        An item is cut into one piece more than it may have edits, so a leak holds one piece unchanged; each
        is cut to the length of the shortest.
        """
        found: dict[int, list] = {}
        for m, (_, matrix, *_) in self.classes.items():
            count = self._allowed(m) + 1
            for place in (m * np.arange(count) // count).tolist():
                h = self._runs(matrix[:, place:place + m // count].ravel(), m // count)[::m // count]
                found.setdefault(m // count, []).append((h, np.stack(
                    (np.full(len(h), m), np.arange(len(h)), np.full(len(h), place)), axis=1)))
        out = {}
        for length, parts in found.items():
            h, where = np.concatenate([h for h, _ in parts]), np.concatenate([w for _, w in parts])
            order = np.argsort(h, kind="stable")
            out[length] = h[order], where[order]
        return out

    def _allowed(self, m: int) -> int:
        return int(self.edits * m + 1e-9)

    def _runs(self, number: np.ndarray, length: int) -> np.ndarray:
        """Hash of every run of ``length`` word numbers."""
        out = np.zeros(max(0, len(number) - length + 1), np.uint64)
        values = self.value[number]
        for k in range(length):
            out = out * _STEP + values[k:k + len(out)]
        return out

    def _held(self, number: np.ndarray, total: np.ndarray) -> dict[int, np.ndarray]:
        """By item length: rows (item, window start) where the text holds a piece of the item unchanged."""
        found: dict[int, list] = {}
        for length, (wanted, where) in self.pieces.items():
            at = np.flatnonzero(total[length:] - total[:-length] == length)
            got = self._runs(number, length)[at]
            low, high = np.searchsorted(wanted, got), np.searchsorted(wanted, got, side="right")
            hit = np.flatnonzero(high > low)
            # In parts, so that a piece that many items share does not make all its pairs at once.
            for i in range(0, len(hit), _HITS):
                part = hit[i:i + _HITS]
                count = (high - low)[part]
                rank = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low[part], count)
                m, item, place = where[rank].T
                start = np.repeat(at[part], count) - place
                allowed = (self.edits * m + 1e-9).astype(np.int64)
                likely = (start >= 0) & (start + m < len(total))
                likely[likely] = total[(start + m)[likely]] - total[start[likely]] >= (m - allowed)[likely]
                for one in np.unique(m[likely]).tolist():
                    mine = likely & (m == one)
                    found.setdefault(one, []).append(np.unique(np.stack((item[mine], start[mine]), axis=1), axis=0))
        return {m: np.concatenate(parts) for m, parts in found.items()}

    def _keys(self, embedded: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Hash of the words at each sample's steps, and of the sample's number: a row per sample."""
        key = np.repeat((np.arange(1, len(columns) + 1, dtype=np.uint64) * _STEP)[:, None], embedded.shape[1], axis=1)
        for k in range(columns.shape[1]):
            for row, step in zip(key, columns[:, k]):
                row += self.salt[k].take(embedded[step])
        return key

    def search(self, h: np.ndarray, cuts: np.ndarray) -> list[tuple[int, int, int, int, int | None, int]]:
        """(text, first word, last word + 1, distance, item id, item length) of every leak.

        ``h`` holds the word hashes of texts one after another, ``cuts`` where each text starts and the end.
        """
        if not len(h) or not self.classes:
            return []
        at = np.minimum(np.searchsorted(self.vocabulary, h), self.unknown - 1)
        # Between texts stand as many end marks as the longest item has words, so that no window joins two.
        gap = max(self.classes)
        owner = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        number = np.full(len(h) + gap * len(cuts), self.unknown + 1, np.int32)
        number[np.arange(len(h)) + gap * (owner + 1)] = np.where(self.vocabulary[at] == h, at, self.unknown)
        begins = cuts + gap * np.arange(1, len(cuts) + 1)
        total = np.concatenate(([0], np.cumsum(number < self.unknown, dtype=np.int32)))
        found, held = [], self._held(number, total)
        for m, (ids, matrix, held_words, columns, keys) in self.classes.items():
            allowed = self._allowed(m)
            starts = np.flatnonzero(total[m:] - total[:-m] >= m - allowed)
            windows = np.lib.stride_tricks.sliding_window_view(number, m)
            pairs = [held[m]] if m in held else []
            for i in range(0, len(starts), _WINDOWS):
                s = starts[i:i + _WINDOWS]
                window = windows[s]
                likely = held_words[window].sum(1) >= m - allowed
                s, window = s[likely], window[likely]
                if len(s):
                    pairs.append(self._candidates(s, window, m, columns, keys))
            if pairs:
                found += self._verified(np.unique(np.concatenate(pairs), axis=0), number, begins, ids, matrix, m, allowed)
        return found

    def _candidates(self, s, window, m, columns, keys) -> np.ndarray:
        """Rows (item, window start) that agree in a sample of some walk."""
        pairs = [np.zeros((0, 2), np.int64)]
        for bits, chosen, (wanted, item) in zip(self.bits, columns, keys):
            got = self._keys(embed(window, bits, int(chosen.max()) + 1), chosen).ravel()
            low = np.searchsorted(wanted, got)
            hit = np.flatnonzero(wanted[np.minimum(low, len(wanted) - 1)] == got)
            if len(hit):
                count = np.searchsorted(wanted, got[hit], side="right") - low[hit]
                rank = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low[hit], count)
                pairs.append(np.stack((item[rank], s[np.repeat(hit, count) % len(s)]), axis=1))
        return np.unique(np.concatenate(pairs), axis=0)

    def _verified(self, pairs, number, begins, ids, matrix, m, allowed):
        """Leaks among the candidates, after those that share too few words with the item."""
        found = []
        for item in np.unique(pairs[:, 0]):
            s = pairs[pairs[:, 0] == item, 1]
            self.marks[matrix[item]] = True
            own = np.concatenate([part[self.marks[number[part[:, None] + np.arange(m)]].sum(1) >= m - allowed]
                                  for part in (s[i:i + _ROWS] for i in range(0, len(s), _ROWS))])
            self.marks[matrix[item]] = False
            # Windows near each other are verified as one stretch of text.
            begin = []
            for one in own.tolist():
                if not begin or one > begin[-1] + 2 * allowed:
                    begin.append(one)
            own = np.array(begin, np.int64)
            for i in range(0, len(own), _ROWS):
                part = own[i:i + _ROWS]
                text = number[np.clip(part[:, None] - allowed + np.arange(m + 4 * allowed), 0, len(number) - 1)]
                distance, first, last = best_match(matrix[item], text)
                ok = distance <= allowed
                a, b = (part - allowed + first)[ok], (part - allowed + last)[ok]
                owner = np.searchsorted(begins, a, side="right") - 1
                found += [(t, x, y, d, ids[item], m) for t, x, y, d in zip(
                    owner.tolist(), (a - begins[owner]).tolist(), (b - begins[owner]).tolist(), distance[ok].tolist())]
        return found


def _search_texts(text, index_items, edits, plan):
    kind = "array<struct<item_id:bigint,distance:int,first_word:bigint,end_word:bigint,item_words:int>>"
    made = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("first_word", pa.int64()),
                               ("end_word", pa.int64()), ("item_words", pa.int32())]))

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = Index([(i, np.frombuffer(h, np.uint64)) for i, h in index_items.value], edits, plan)
        for batch in batches:
            data, offsets = text_bytes(batch)
            out: list[dict] = [{} for _ in range(len(batch))]
            for i, j in blocks(offsets, _TEXT):
                own, h = words_of(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                cuts = np.searchsorted(own, np.arange(j - i + 1))
                for text_no, a, b, distance, item, words in index.search(h, cuts):
                    leak = (distance, a, b, words)
                    best = out[i + text_no].get(item)
                    out[i + text_no][item] = leak if best is None else min(best, leak)
            yield pa.array([[{"item_id": item, "distance": d, "first_word": a, "end_word": b, "item_words": w}
                             for item, (d, a, b, w) in found.items()] for found in out], made)
    return run(text)


def _hashed(text: Column) -> Column:
    """The word hashes of every text, one after another."""
    @F.arrow_udf("binary")
    def run(batch: pa.Array) -> pa.Array:
        data, offsets = text_bytes(batch)
        own, h = words_of(data, offsets)
        cuts = np.searchsorted(own, np.arange(len(batch) + 1))
        return pa.array([h[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())
    return run(text)


def _searches(benchmark: DataFrame, text, edits: float) -> Iterator:
    """A column of the leaks in ``text`` for every block of items."""
    spark = benchmark.sparkSession
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // BLOCK_BYTES))
    for part in range(parts):
        block = items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).select("item_id", _hashed(F.col("text")).alias("h")).toArrow()
        hashes = block["h"].to_pylist()
        held = spark.sparkContext.broadcast(list(zip(block["item_id"].to_pylist(), hashes)))
        yield _search_texts(text, held, edits, lsh_plan({len(h) // 8 for h in hashes if h}, edits))


def find_leaks(documents: DataFrame, benchmark: DataFrame, edits: float = EDITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, distance, first_word, end_word, item_words``: the best match of each leaked item."""
    texts = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    result = None
    for leaks in _searches(benchmark, F.col("text"), edits):
        found = texts.select("doc_id", F.explode(leaks).alias("leak"))
        found = found.select("doc_id", "leak.*")
        result = found if result is None else result.union(found)
    return result


def without_leaks(documents: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose own text leaks no item."""
    for leaks in _searches(benchmark, F.col(text_col), EDITS):
        documents = documents.where(F.size(leaks) == 0)
    return documents

"""Byte-level BPE by a segment tree over byte positions.

A text is cut by the tokenizer's pattern; each match ("piece") is merged on its own. The leaves of a
piece's tree are its byte positions, each with the rank of the pair that starts there; inner nodes
keep the smallest ``(rank, position)`` below, so the root names the leftmost pair of the lowest rank.
A merge changes three leaves (the pair, the swallowed neighbour and the one before) and the
``log2(length)`` nodes above each. Pieces of similar length are merged together, one numpy step for
all of them.

Null and empty texts have no ids. Repeated rows encode alike. Texts of any length are encoded whole,
a run of pieces at a time. A piece is what the pattern does not cut: one unbroken run of letters of a megabyte
takes a task some minutes (about 0.2 ms a byte) and 60 bytes of memory a byte.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

_NONE = np.int64(1) << np.int64(62)
_CELLS = 1 << 16          # leaves that are merged together at most, so that they stay in cache
_CACHE = 250_000          # pieces a task remembers
_LONG = 1 << 20           # characters beyond which the pieces of a text are taken in runs


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


class Encoder:
    """Ids of texts; remembers the pieces it has met, up to a bound."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.pairs.tolist()], np.int64)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.known: dict[str, bytes] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, or _NONE; a merged pair's id is its rank."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (right >= 0), self.merged[at], _NONE)

    def _merge(self, pieces: list[bytes], width: int) -> list[bytes]:
        """All merges of pieces of at most ``width`` bytes; ``width`` is a power of two."""
        n, shift = len(pieces), np.int64(width.bit_length())
        mask = (np.int64(1) << shift) - 1
        lengths = np.array([len(p) for p in pieces])
        ids = np.full((n, width + 1), -1, np.int64)
        inside = np.arange(width) < lengths[:, None]
        ids[:, :width][inside] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.tile(np.arange(1, width + 2), (n, 1))
        after[:, width] = width
        before = np.tile(np.arange(-1, width), (n, 1))
        tree = np.full((n, 2 * width), _NONE, np.int64)
        start = np.arange(width)
        rank = np.where(inside, self._rank(ids[:, :width], ids[:, 1:]), _NONE)
        tree[:, width:] = np.where(rank < _NONE, rank << shift | start, _NONE)
        level = width >> 1
        while level:
            tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
            level >>= 1
        live = np.flatnonzero(tree[:, 1] < _NONE)
        while len(live):
            top = tree[live, 1]
            at = top & mask
            gone = after[live, at]
            follow = after[live, gone]
            ids[live, at] = top >> shift
            ids[live, gone] = -1
            after[live, at] = follow
            before[live, follow] = at
            prior = before[live, at]
            here = self._rank(ids[live, at], ids[live, follow])
            there = np.where(prior >= 0, self._rank(ids[live, prior], ids[live, at]), _NONE)
            tree[live, width + at] = np.where(here < _NONE, here << shift | at, _NONE)
            tree[live, width + gone] = _NONE
            first = prior >= 0
            tree[live[first], width + prior[first]] = np.where(
                there < _NONE, there << shift | prior, _NONE)[first]
            rows = np.concatenate((live, live, live[first]))
            nodes = np.concatenate((width + at, width + gone, width + prior[first])) >> 1
            while nodes[0]:
                tree[rows, nodes] = np.minimum(tree[rows, 2 * nodes], tree[rows, 2 * nodes + 1])
                nodes >>= 1
            live = live[tree[live, 1] < _NONE]
        left = ids[:, :width]
        kept = left >= 0
        flat = left[kept].astype("<u4").tobytes()
        ends = np.cumsum(kept.sum(1)) * 4
        return [flat[a:b] for a, b in zip(np.concatenate(([0], ends[:-1])), ends)]

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces that are not remembered yet."""
        todo: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            data = piece.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(data)
            if whole is not None:
                self.known[piece] = whole.to_bytes(4, "little")
            else:
                todo.setdefault(max(2, 1 << (len(data) - 1).bit_length()), []).append((piece, data))
        for width, some in todo.items():
            size = max(1, _CELLS // width)
            for i in range(0, len(some), size):
                part = some[i:i + size]
                self.known.update(zip((p for p, _ in part), self._merge([d for _, d in part], width)))

    def _encode_pieces(self, pieces: list[str]) -> bytes:
        missing = set(pieces) - self.known.keys()
        if missing:
            self.learn(missing)
        return b"".join(map(self.known.__getitem__, pieces))

    def _bound(self) -> None:
        if len(self.known) > _CACHE:
            self.known.clear()

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, i = [], 0
        while i < len(texts):
            self._bound()
            if len(texts[i] or "") > _LONG:
                found, parts = self.pattern.finditer(texts[i]), []
                while run := [m.group() for m in islice(found, 100_000)]:
                    self._bound()
                    parts.append(self._encode_pieces(run))
                out.append(b"".join(parts))
                i += 1
                continue
            cut, j, size = [], i, 0
            while j < len(texts) and size < _LONG and len(texts[j] or "") <= _LONG:
                cut.append(self.pattern.findall(texts[j] or ""))
                size += len(texts[j] or "")
                j += 1
            missing = set().union(*cut) - self.known.keys()
            if missing:
                self.learn(missing)
            out += [b"".join(map(self.known.__getitem__, pieces)) for pieces in cut]
            i = j
        return out


def encode(text: Column, ranks_of, pattern: str) -> Column:
    """Ids of the text, little-endian unsigned 32-bit; ``ranks_of`` is a broadcast ``{bytes: rank}``."""
    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(ranks_of.value, pattern)
        for batch in batches:
            yield pa.concat_arrays([
                pa.array(encoder.encode_all(batch.slice(i, 256).to_pylist()), pa.binary())
                for i in range(0, len(batch), 256)] or [pa.array([], pa.binary())])
    return run(text)


def _decoder(ranks: dict[bytes, int]):
    vocabulary = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        vocabulary[rank] = token
    return lambda ids: b"".join(map(vocabulary.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def decode(ids: Column, ranks_of) -> Column:
    """Bytes that the ids stand for; null ids give no bytes."""
    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoded = _decoder(ranks_of.value)
        for batch in batches:
            yield pa.array([decoded(x) for x in batch.to_pylist()], pa.binary())
    return run(ids)


def digests(text: Column, ranks_of, pattern: str) -> Column:
    """``struct<n_tokens, ids_sha256, decoded_sha256>`` of each text, encoded and decoded in one call.

    The ids themselves stay in the task, a few texts at a time.
    """
    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, decoded = Encoder(ranks_of.value, pattern), _decoder(ranks_of.value)
        for batch in batches:
            tokens, of_ids, of_bytes = [], [], []
            for i in range(0, len(batch), 64):
                for ids in encoder.encode_all(batch.slice(i, 64).to_pylist()):
                    tokens.append(len(ids) // 4)
                    of_ids.append(hashlib.sha256(ids).hexdigest())
                    of_bytes.append(hashlib.sha256(decoded(ids)).hexdigest())
            yield pa.StructArray.from_arrays(
                [pa.array(tokens, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["n_tokens", "ids_sha256", "decoded_sha256"])
    return run(text)

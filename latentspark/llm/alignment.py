"""Alignment of two tokenizers' ids: where tokens of both end, and how often linked ids meet in a corpus.

``A`` is a byte-level BPE of the tokenizers library, ``B`` a sentencepiece model, which puts a space before the
text; A gets that space too. A token's place is known from the lengths of its bytes, so the ends of tokens are
running sums. Of every document the ends of A and of B are kept in two dictionaries (end to index); the common
keys, sorted, cut both id lists into groups. In a group tokens are linked where their byte ranges overlap.

Links are counted over the corpus by documents that hold them. Documents are taken in slices of about
``SLICE_BYTES``; a slice keeps its distinct links once and each document's as numbers of those, packed. Counts
go from and to slices, so that a row is exchanged per slice and distinct link, not per token, and a link that
every document holds has one row per slice.

Names of special tokens in a text are plain text. Null and empty texts have no tokens, nor has a text whose
tokens' bytes, of A or B, differ from a space and the text (a tokenizer that normalises); their numbers are 0
and they link nothing. Repeated rows are documents of their own. An empty table gives no rows. Texts of any
length are encoded whole, a long one as a slice of its own. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latentspark.llm.byte_level import ByteLevel, Pieces
from latentspark.llm.words import text_bytes
from latentspark.session import cut_lineage

SLICE_BYTES = 2 << 20
_SLICE_ROWS = 1 << 15
_PART = 256
_B_BITS = 21             # of a link's number are for B's id
_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


class Tokenizers(NamedTuple):
    """What tasks need to load both tokenizers: the JSON of A and the serialized model of B."""

    a: str
    b: bytes


class Groups(NamedTuple):
    """Tokens of a run of texts, text after text; group k holds A's ids ``cut_a[k]:cut_a[k + 1]``, likewise B's."""

    a: np.ndarray          # ids
    b: np.ndarray
    end_a: np.ndarray      # bytes up to the end of each token
    end_b: np.ndarray
    of_a: np.ndarray       # where each text's ids begin, and the end
    of_b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray
    of_group: np.ndarray   # where each text's groups begin, and the end

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of A's and B's tokens that overlap, and where each text's links begin, and the end."""
        in_a = np.diff(self.cut_a)
        group = np.repeat(np.arange(len(in_a)), in_a)
        low, high = self.cut_b[:-1][group], self.cut_b[1:][group] - 1
        # A token alone in its group meets all of the other side's; else ends within the slice tell.
        several = np.flatnonzero((in_a[group] > 1) & (high > low))
        high[several] = np.searchsorted(self.end_b, self.end_a[several])
        inner = several[several > self.cut_a[:-1][group[several]]]
        low[inner] = high[inner - 1]
        count = high - low + 1
        before = np.concatenate(([0], np.cumsum(count)))
        total = int(before[-1])
        return (np.repeat(np.arange(len(count)), count),
                np.arange(total) + np.repeat(low - before[:-1], count), before[self.of_a])


class Aligner:
    def __init__(self, tokenizers: Tokenizers):
        import sentencepiece

        self.a = ByteLevel(tokenizers.a)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=tokenizers.b)
        self.bytes_a = self.a.pieces
        self.bytes_b = Pieces([
            bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))])
        # Decimal ids with what follows them in a written group.
        sizes = len(self.bytes_a.length), len(self.bytes_b.length)
        self.written = [b"%d%s" % (i, end) for size, ends in zip(sizes, ((b",", b"|"), (b",", b";")))
                        for end in ends for i in range(size)]

    def _encoded(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Ids of both tokenizers, as unsigned 32-bit integers."""
        a, b = [], []
        for i in range(0, len(texts), _PART):
            part = texts[i:i + _PART]
            a += self.a.ids([" " + t for t in part])
            b += [array("I", x).tobytes() for x in self.b.encode(part, num_threads=1)]
        return a, b

    def align(self, texts: list[str | None]) -> Groups:
        """Groups of every text; those without tokens have none."""
        given = [t for t in texts if t]
        data, offsets = text_bytes(pa.array([" " + t for t in given], pa.large_string()))
        a, b = self._encoded(given)
        same = _gives(a, self.bytes_a, data, offsets) & _gives(b, self.bytes_b, data, offsets)
        kept = iter(zip(a, b, same.tolist()))
        found = [next(kept) if t else (b"", b"", False) for t in texts]
        a, of_a = _flat([x if ok else b"" for x, _, ok in found])
        b, of_b = _flat([x if ok else b"" for _, x, ok in found])
        end_a, end_b = np.cumsum(self.bytes_a.length[a]), np.cumsum(self.bytes_b.length[b])
        cut_a, cut_b, groups, list_a, list_b = [], [], [0], end_a.tolist(), end_b.tolist()
        for i, j, k, m in zip(of_a.tolist(), of_a[1:].tolist(), of_b.tolist(), of_b[1:].tolist()):
            index_a, index_b = dict(zip(list_a[i:j], range(i, j))), dict(zip(list_b[k:m], range(k, m)))
            # The ends of B come in order, so the keys that are in both dictionaries do as well.
            common = list(filter(index_a.__contains__, index_b))
            cut_a += map(index_a.__getitem__, common)
            cut_b += map(index_b.__getitem__, common)
            groups.append(len(cut_a))
        cuts = (np.concatenate(([0], np.array(c, np.int64) + 1)) for c in (cut_a, cut_b))
        return Groups(a, b, end_a, end_b, of_a, of_b, *cuts, np.array(groups))

    def digests(self, g: Groups) -> list[str]:
        """SHA-256 of every text's groups, written ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
        size_a, size_b = len(self.bytes_a.length), len(self.bytes_b.length)
        last_a, last_b = np.zeros(len(g.a), np.int64), np.zeros(len(g.b), np.int64)
        last_a[g.cut_a[1:] - 1], last_b[g.cut_b[1:] - 1] = size_a, size_b
        order = np.empty(len(g.a) + len(g.b), np.int64)
        order[np.arange(len(g.a)) + np.repeat(g.cut_b[:-1], np.diff(g.cut_a))] = g.a + last_a
        order[np.arange(len(g.b)) + np.repeat(g.cut_a[1:], np.diff(g.cut_b))] = 2 * size_a + g.b + last_b
        order, begins, written = order.tolist(), (g.of_a + g.of_b).tolist(), self.written.__getitem__
        return [hashlib.sha256(b"".join(map(written, order[i:j]))[:-1]).hexdigest() if j > i else ""
                for i, j in zip(begins, begins[1:])]


def _flat(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    begins = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)))
    return np.frombuffer(b"".join(ids), np.uint32).astype(np.int64), begins


def _gives(ids: list[bytes], pieces: Pieces, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts the bytes of their tokens give back."""
    flat, begins = _flat(ids)
    joined, ends = pieces.joined(flat)
    cuts = np.concatenate(([0], ends))[begins]
    same = np.diff(cuts) == np.diff(offsets)
    if same.all():
        differs = np.concatenate(([0], np.cumsum(joined != data)))
        return differs[cuts[1:]] == differs[cuts[:-1]]
    for k in np.flatnonzero(same).tolist():
        same[k] = np.array_equal(joined[cuts[k]:cuts[k + 1]], data[offsets[k]:offsets[k + 1]])
    return same


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``SLICE_BYTES`` of text, one text at least."""
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0), np.int64))
    i = 0
    while i < batch.num_rows:
        j = int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + SLICE_BYTES, side="right"))
        j = min(max(j, i + 1), i + _SLICE_ROWS, batch.num_rows)
        yield batch.slice(i, j - i)
        i = j


def _lists(begins: np.ndarray, values: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(values, kind))


def groups(documents: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """``doc_id, a, b, cut_a, cut_b``: both id lists of every document, and where their groups begin, with the end."""
    held = documents.sparkSession.sparkContext.broadcast(tuple(tokenizers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(Tokenizers(*held.value))
        for batch in batches:
            for part in _parts(batch):
                g = aligner.align(part.column("text").to_pylist())
                n = np.arange(part.num_rows)
                # A text's cuts begin with 0, so there is one more of them than groups.
                place = np.arange(len(g.cut_a) - 1) + np.repeat(n + 1, np.diff(g.of_group))
                cuts = []
                for cut, of in ((g.cut_a, g.of_a), (g.cut_b, g.of_b)):
                    own = np.zeros(len(cut) - 1 + len(n), np.int64)
                    own[place] = cut[1:] - np.repeat(of[:-1], np.diff(g.of_group))
                    cuts.append(_lists(g.of_group + np.append(n, len(n)), own, pa.int32()))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), _lists(g.of_a, g.a, pa.int32()), _lists(g.of_b, g.b, pa.int32()), *cuts],
                    ["doc_id", "a", "b", "cut_a", "cut_b"])
    return documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, a array<int>, b array<int>, cut_a array<int>, cut_b array<int>")


def _packed(of_text: np.ndarray, index: np.ndarray, times: np.ndarray) -> bytes:
    """Links of a slice's texts: how many each has, steps between their sorted numbers, how often each occurs."""
    first = of_text[:-1][np.diff(of_text) > 0]
    step = np.diff(index, prepend=0)
    step[first] = index[first]
    parts = np.concatenate((np.diff(of_text), step, times)).astype("<u4")
    # Equal bytes of the numbers stand together, which packs well.
    return zstandard.ZstdCompressor(level=1).compress(parts.view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(content: bytes, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each text's links begin, and the end; numbers; how often each occurs."""
    parts = np.frombuffer(zstandard.ZstdDecompressor().decompress(content), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
    of_text = np.concatenate(([0], np.cumsum(parts[:texts], dtype=np.int64)))
    n = int(of_text[-1])
    sums = np.concatenate(([0], np.cumsum(parts[texts:texts + n], dtype=np.int64)))
    # A running sum over all texts, less what it had where the text began.
    return of_text, sums[1:] - np.repeat(sums[of_text[:-1]], np.diff(of_text)), parts[texts + n:].astype(np.int64)


_SLICE = ("slice bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
          "n_links array<bigint>, groups_sha256 array<string>, links array<bigint>, holders array<bigint>, packed binary")


def slices(documents: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """A row per slice: its documents' numbers and digests, its distinct links (A's id * 2^21 + B's id) with the number of
    its documents that hold each, and every document's links, packed."""
    held = documents.sparkSession.sparkContext.broadcast(tuple(tokenizers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = Aligner(Tokenizers(*held.value)), TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in _parts(batch):
                g = aligner.align(part.column("text").to_pylist())
                at_a, at_b, of_link = g.links()
                text = np.repeat(np.arange(part.num_rows), np.diff(of_link))
                key, times = np.unique(text << 2 * _B_BITS | g.a[at_a] << _B_BITS | g.b[at_b], return_counts=True)
                link = key & (1 << 2 * _B_BITS) - 1
                links, holders = np.unique(link, return_counts=True)
                of_text = np.searchsorted(key >> 2 * _B_BITS, np.arange(part.num_rows + 1))
                counts = (np.diff(x) for x in (g.of_a, g.of_b, g.of_group, of_link))
                one = [0, part.num_rows]
                yield pa.RecordBatch.from_arrays([
                    pa.array([number], pa.int64()), _lists(one, part.column("doc_id"), pa.int64()),
                    *(_lists(one, n, pa.int64()) for n in counts), _lists(one, aligner.digests(g), pa.string()),
                    _lists([0, len(links)], links, pa.int64()), _lists([0, len(links)], holders, pa.int64()),
                    pa.array([_packed(of_text, np.searchsorted(links, link), times)], pa.binary())],
                    [c.split()[0] for c in _SLICE.split(", ")])
                number += 1
    return documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, _SLICE)


def link_counts(found: DataFrame) -> DataFrame:
    """``link, n, best``: documents that hold each link, and whether no link of the same id of A is held by more."""
    counts = found.select(F.explode(F.arrays_zip("links", "holders")).alias("x")).groupBy(
        F.col("x.links").alias("link")).agg(F.sum("x.holders").alias("n"))
    counts = cut_lineage(counts)
    own = F.shiftright("link", _B_BITS)
    most = counts.groupBy(own.alias("a")).agg(F.max("n").alias("most"))
    return counts.join(most, own == F.col("a")).select("link", "n", (F.col("n") == F.col("most")).alias("best"))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents again, with the sums over their links."""
    for batch in batches:
        for row in range(batch.num_rows):
            one = {c: batch.column(c)[row] for c in batch.schema.names}
            docs = one["doc_id"].values
            of_text, index, times = _unpacked(one["packed"].as_py(), len(docs))
            counts = np.zeros((2, len(one["place"].values) if one["place"].is_valid else 0), np.int64)
            if counts.shape[1]:
                place = np.asarray(one["place"].values)
                counts[0, place], counts[1, place] = one["n"].values, np.asarray(one["best"].values)
            sums = np.concatenate((np.zeros((2, 1), np.int64), np.cumsum(counts[:, index] * times, axis=1)), axis=1)[:, of_text]
            count_sum, n_best = np.diff(sums, axis=1)
            yield pa.RecordBatch.from_arrays([
                docs, *(one[c].values for c in _NUMBERS), pa.array(n_best), pa.array(count_sum), one["groups_sha256"].values],
                ["doc_id", *_NUMBERS, "n_best", "count_sum", "groups_sha256"])


def link_statistics(documents: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document.

    ``n_best`` counts links that are held as often as any of the same id of A, ``count_sum`` adds up how many
    documents hold each of the document's links.
    """
    found = cut_lineage(slices(documents, tokenizers))
    # At most one row per slice and link, so no link and no slice has more than its share.
    asked = found.select("slice", F.posexplode("links").alias("place", "link"))
    told = asked.join(link_counts(found), "link").groupBy("slice").agg(
        F.collect_list(F.struct("place", "n", "best")).alias("x")).select("slice", "x.place", "x.n", "x.best")
    rows = found.drop("links", "holders").join(told, "slice", "left").drop("slice")
    return rows.mapInArrow(_summed, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in (*_NUMBERS, "n_best", "count_sum"))
                           + ", groups_sha256 string")

r"""Source divergence audit by chunk factorization.

A chunk is what ASCII white space separates. Chunks are counted per document; documents are taken in blocks of
about ``BLOCK_BYTES``, and a block keeps, packed, the distinct chunks of each language, the documents that hold
them (numbers within the block) and how often. Blocks ask for their chunks: a row per block and distinct chunk is
exchanged, so that equal chunks meet in order and each is cut into terms once, for all documents. The terms go back
to the blocks that asked, which unite the documents of all chunks with a term, so that a document that holds a
term in several chunks counts once, and add up occurrences by source.

No row is exchanged per word or per document, and a chunk that stands in every document has one row per block:
no key holds more than its share. Terms whose chunks together have fewer than the least number of documents are
not told to the blocks; they cannot be kept.

Terms are runs of ASCII letters and characters beyond ASCII; only A-Z are lower-cased. A language keeps the
terms that stand in at least ``min_docs`` of its documents; every row is a document. With a group's count and
the sum N of its counts over the V kept terms, ``p = 1 + floor(10^9 (count + 5) / (N + 5 V))``, all in whole
numbers (exact up to 9 * 10^15 occurrences a language).

Two sources of a language are compared over all kept terms: terms that neither holds differ by the same amount
each, so only terms that one of them holds are visited. Sources are numbered and taken in runs of ``WIDTH``;
for two runs a task adds up one table of ``WIDTH * WIDTH`` sums, and no pair is ever a row before that.

Null text, language and source count as empty. A group without terms has count 0 of each term. A language
without kept terms has pairs of value 0 and no term rows. Ties are ranked by the item's UTF-8 bytes. Repeated
rows are documents of their own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from latentspark.llm.words import LOWER, spans, text_bytes
from latentspark.session import broadcast_if_small, cut_lineage

MIN_DOCS = 30
TOP = 50
WIDTH = 128
BLOCK_BYTES = 16 << 20
_BLOCK_ROWS = 1 << 15
_PART = 1 << 15
_SALTS = 16
_LETTERS = np.zeros(256, np.uint8)
for _first, _last in ((0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _LETTERS[_first:_last] = 1

_BLOCKS = "block bigint, langs array<string>, rows_of_lang array<int>, chunks binary, holders binary, own binary"
_ASKED = "block bigint, place int, lang string, chunk string, holders bigint"
_TOLD = "block bigint, place int, lang string, term string, times bigint, holders bigint"
_COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2^32; equal bytes of them stand together, which packs well."""
    return zstandard.ZstdCompressor(level=1).compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(content: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(content), np.uint8).reshape(4, -1)
    return planes.T.copy().view("<u4").ravel().astype(np.int64)


def _block(number: int, lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.RecordBatch:
    """One row of some documents: their chunks in order of language and text, and who holds each how often."""
    lang, source = lang.dictionary_encode(), source.dictionary_encode()
    lang_of = np.asarray(lang.indices, np.int64)
    words = pc.ascii_split_whitespace(text)
    doc = np.asarray(pc.list_parent_indices(words), np.int64)
    chunk = pc.list_flatten(words).dictionary_encode()
    kinds = len(chunk.dictionary)
    order = np.asarray(pc.sort_indices(chunk.dictionary), np.int64)
    rank = np.empty(kinds, np.int64)
    rank[order] = np.arange(kinds)
    chunk_of = rank[np.asarray(chunk.indices, np.int64)]
    if kinds and chunk.dictionary[int(order[0])].as_py() == "":  # splitting leaves an empty chunk at the ends of a text
        chunk_of, doc = chunk_of[chunk_of > 0], doc[chunk_of > 0]
    key, counts = np.unique((lang_of[doc] * kinds + chunk_of) * _BLOCK_ROWS + doc, return_counts=True)
    row, doc = key // _BLOCK_ROWS, key % _BLOCK_ROWS
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    first = row[starts]
    holders = np.diff(np.append(starts, len(row)))
    step = np.diff(doc, prepend=0)
    step[starts] = doc[starts]
    texts = chunk.dictionary.take(pa.array(order[first % kinds])).to_pylist() if len(first) else []
    of_lang = np.bincount(first // kinds, minlength=len(lang.dictionary)) if len(first) else np.zeros(len(lang.dictionary), int)
    held = _packed(holders)
    own = pa.RecordBatch.from_pydict({
        "langs": [lang.dictionary.to_pylist()], "sources": [source.dictionary.to_pylist()], "lang_of": [_packed(lang_of)],
        "source_of": [_packed(np.asarray(source.indices))], "holders": [held], "links": [_packed(np.concatenate((step, counts)))]})
    values = (number, lang.dictionary.to_pylist(), of_lang, zstandard.ZstdCompressor(level=3).compress("\n".join(texts).encode()),
              held, _written(own))
    kinds = (pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), *[pa.binary()] * 3)
    return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(values, kinds)], _names(_BLOCKS))


def _written(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        sizes = np.cumsum(np.asarray(pc.binary_length(batch.column("text")), np.int64))
        i = 0
        while i < batch.num_rows:
            j = int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + BLOCK_BYTES, side="right"))
            j = min(max(j, i + 1), i + _BLOCK_ROWS, batch.num_rows)
            yield _block(number, *(batch.column(c).slice(i, j - i) for c in ("lang", "source", "text")))
            number, i = number + 1, j


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every chunk of a block."""
    for batch in batches:
        for block, langs, sizes, chunks, holders in zip(*(batch.column(c).to_pylist() for c in (
                "block", "langs", "rows_of_lang", "chunks", "holders"))):
            texts, holders = zstandard.ZstdDecompressor().decompress(chunks).decode().split("\n"), _unpacked(holders)
            lang = np.repeat(np.arange(len(langs)), sizes)
            for i in range(0, len(holders), _PART):
                part = slice(i, i + _PART)
                n = len(holders[part])
                yield pa.RecordBatch.from_arrays([
                    pa.array([block] * n, pa.int64()), pa.array(np.arange(i, i + n), pa.int32()),
                    pa.array(langs, pa.string()).take(pa.array(lang[part])), pa.array(texts[part], pa.string()),
                    pa.array(holders[part])], _names(_ASKED))


def _terms(chunks: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Which chunk, term, how often, for every term of every chunk."""
    data, offsets = text_bytes(chunks)
    first, last = spans(data, offsets, _LETTERS)
    size = last - first
    ends = np.cumsum(size)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)
    terms = pa.LargeStringArray.from_buffers(
        len(ends), pa.py_buffer(np.concatenate(([0], ends)).astype(np.int64)), pa.py_buffer(LOWER[data[at]]))
    terms = terms.dictionary_encode()
    kinds = max(1, len(terms.dictionary))
    own = np.searchsorted(offsets, first, side="right") - 1
    key, times = np.unique(own * kinds + np.asarray(terms.indices, np.int64), return_counts=True)
    return key // kinds, terms.dictionary.cast(pa.string()).take(pa.array(key % kinds)), times


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms of the chunks, which come in order, so that equal ones are cut once."""
    for batch in batches:
        chunk = batch.column("chunk").dictionary_encode()
        own, terms, times = _terms(chunk.dictionary)
        low, high = (np.searchsorted(own, np.asarray(chunk.indices), side) for side in ("left", "right"))
        count = high - low
        row = np.repeat(np.arange(batch.num_rows), count)
        at = np.arange(len(row)) + np.repeat(low - np.cumsum(count) + count, count)
        if len(row):
            block, place, lang, holders = (batch.column(c).take(pa.array(row)) for c in ("block", "place", "lang", "holders"))
            yield pa.RecordBatch.from_arrays([
                block, place, lang, terms.take(pa.array(at)), pa.array(times[at], pa.int64()), holders], _names(_TOLD))


def _summed(block: dict, place: np.ndarray, term: pa.Array, times: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every term by language and source, for one block and the terms of its chunks."""
    langs, sources = (pa.array(block[c], pa.string()) for c in ("langs", "sources"))
    lang_of, source_of = _unpacked(block["lang_of"]), _unpacked(block["source_of"])
    term = term.dictionary_encode()
    holders, (step, n) = _unpacked(block["holders"]), _unpacked(block["links"]).reshape(2, -1)
    ends, sums = np.cumsum(holders), np.concatenate(([0], np.cumsum(step)))
    # A running sum over all chunks, less what it had where the chunk began.
    docs = sums[1:] - np.repeat(sums[ends - holders], holders)
    low, count = (ends - holders)[place], holders[place]
    at = np.arange(count.sum()) + np.repeat(low - np.cumsum(count) + count, count)
    key = np.repeat(np.asarray(term.indices, np.int64), count) * len(lang_of) + docs[at]
    # One row per term and document, however many of its chunks hold the term.
    key, n = _totals(key, n[at] * np.repeat(times, count))
    groups = len(langs) * len(sources)
    group = (lang_of * len(sources) + source_of)[key % len(lang_of)]
    key = key // len(lang_of) * groups + group
    (key, n), (_, held) = _totals(key, n), _totals(key, np.ones_like(n))
    group = key % groups
    found = pa.RecordBatch.from_arrays([
        langs.take(pa.array(group // len(sources))), sources.take(pa.array(group % len(sources))),
        term.dictionary.take(pa.array(key // groups)), pa.array(n), pa.array(held)], _names(_COUNTS))
    yield from (found.slice(i, _PART) for i in range(0, found.num_rows, _PART))


def _totals(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``n`` for each key, in order of keys."""
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    return key[starts], np.add.reduceat(n, starts)


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks come in turn: the block's own row, then the terms of its chunks in order of place."""
    block, told = None, []

    def result() -> Iterator[pa.RecordBatch]:
        if told:
            place, term, times = zip(*told)
            yield from _summed(block, np.concatenate(place), pa.concat_arrays(term), np.concatenate(times))

    for batch in batches:
        heads = np.flatnonzero(np.asarray(batch.column("place")) < 0).tolist()
        for i, j in zip([0, *heads], [*heads, batch.num_rows]):
            if i in heads:
                yield from result()
                block, told = pa.ipc.open_stream(batch.column("own")[i].as_buffer()).read_all().to_pylist()[0], []
                i += 1
            if j > i:
                part = batch.slice(i, j - i)
                told.append((np.asarray(part.column("place"), np.int64), part.column("term"), np.asarray(part.column("times"), np.int64)))
    yield from result()


def _documents(documents: DataFrame) -> DataFrame:
    return documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def kept_terms(documents: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """``lang, term, docs`` of the kept terms, and ``lang, source, term, n`` of those that a group holds."""
    blocks = cut_lineage(_documents(documents).mapInArrow(_blocks, _BLOCKS))
    asked = blocks.select("block", "langs", "rows_of_lang", "chunks", "holders").mapInArrow(_asked, _ASKED)
    terms = cut_lineage(asked.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_cut, _TOLD))
    likely = cut_lineage(terms.groupBy("lang", "term").agg(F.sum("holders").alias("most")).where(
        F.col("most") >= min_docs).select("lang", "term"))
    told = terms.join(broadcast_if_small(likely), ["lang", "term"], "left_semi").select("block", "place", "term", "times")
    # A block's own row comes first, then what it is told.
    rows = blocks.select("block", F.lit(-1).alias("place"), "own").unionByName(told, allowMissingColumns=True)
    found = rows.repartition("block").sortWithinPartitions("block", "place").select("place", "term", "times", "own").mapInArrow(
        _united, _COUNTS)
    found = cut_lineage(found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    kept = cut_lineage(found.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs))
    return kept, cut_lineage(found.select("lang", "source", "term", "n").join(
        broadcast_if_small(kept.select("lang", "term")), ["lang", "term"], "left_semi"))


def _p(count: Column, total: Column) -> Column:
    """``1 + floor(10^9 count / total)`` for ``count <= total``, three digits at a time; null without a total."""
    total = F.nullif(total, F.lit(0))
    value, rest = F.lit(0).cast("bigint"), count.cast("bigint")
    for _ in range(3):
        value = value * 1000 + F.call_function("div", rest * 1000, total)
        rest = (rest * 1000) % total
    return value + 1


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of differences for two runs of sources; a row without a term begins them, with the sources' least p."""
    key = least = sums = None
    seen, names = 0, ("lang", "lo", "hi")

    def result() -> Iterator[pa.RecordBatch]:
        if key is not None:
            a, b = np.indices(sums.shape)
            use = (a < b) if key[1] == key[2] else np.ones(sums.shape, bool)
            n = int(use.sum())
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([key[0]] * n, pa.string()), "a": pa.array(key[1] * WIDTH + a[use], pa.int64()),
                "b": pa.array(key[2] * WIDTH + b[use], pa.int64()), "value": pa.array(sums[use], pa.int64()),
                "seen": pa.array([seen] * n, pa.int64())})

    for batch in batches:
        heads = np.flatnonzero(np.asarray(batch.column("term").is_null())).tolist()
        cuts = sorted({0, *heads, batch.num_rows})
        for i, j in zip(cuts, cuts[1:]):
            part = batch.slice(i, j - i)
            if i in heads:
                yield from result()
                key = tuple(part.column(c)[0].as_py() for c in names)
                at, p = (np.array(part.column(c)[0].as_py(), np.int64) for c in ("at", "p"))
                least = np.zeros(int(at.max()) + 1, np.int64)
                least[at] = p
                left = len(least) if key[1] == key[2] else WIDTH
                sums, seen = np.zeros((left, len(least) if key[1] == key[2] else len(least) - WIDTH), np.int64), 0
                part = part.slice(1)
            for k in range(0, part.num_rows, 2048):
                rows = part.slice(k, 2048)
                p = np.tile(least, (rows.num_rows, 1))
                where = rows.column("at")
                p[np.asarray(pc.list_parent_indices(where)), np.asarray(pc.list_flatten(where))] = np.asarray(pc.list_flatten(rows.column("p")))
                other = p if key[1] == key[2] else p[:, WIDTH:]
                for a in range(left):
                    sums[a] += np.abs(p[:, a:a + 1] - other).sum(0)
                seen += rows.num_rows
    yield from result()


def _pairs(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of every two sources of a language.

    ``groups`` has ``lang, source, no, least, terms``; ``counts`` has ``lang, source, term, p``.
    """
    run = F.call_function("div", F.col("no"), F.lit(WIDTH))
    runs = groups.groupBy("lang").agg((F.max(run) + 1).alias("runs"))
    numbered = groups.select("lang", "source", run.alias("run"), (F.col("no") % WIDTH).cast("int").alias("at"), "least")

    def facing(df: DataFrame) -> DataFrame:
        """Rows of one run, sent to the tables with every run."""
        other = df.join(runs, "lang").select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("runs") - 1)).alias("other"))
        second = F.when(F.col("run") > F.col("other"), F.lit(WIDTH)).otherwise(F.lit(0))
        return other.select("lang", F.least("run", "other").alias("lo"), F.greatest("run", "other").alias("hi"), *(
            ["term"] if "term" in df.columns else []), F.transform("at", lambda x: x + second).alias("at"), "p")

    def gathered(df: DataFrame, *by: str, p: str) -> DataFrame:
        both = df.groupBy("lang", "run", *by).agg(F.collect_list(F.struct("at", p)).alias("x"))
        both = facing(both.select("lang", "run", *by, F.col("x.at").alias("at"), F.col(f"x.{p}").alias("p")))
        return both.groupBy("lang", "lo", "hi", *by).agg(
            F.flatten(F.collect_list("at")).alias("at"), F.flatten(F.collect_list("p")).alias("p"))

    terms = gathered(counts.join(numbered, ["lang", "source"]).select("lang", "run", "at", "term", "p"), "term", p="p")
    heads = gathered(numbered, p="least").select("*", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    rows = terms.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(_SALTS)).cast("int")).unionByName(
        heads.withColumn("term", F.lit(None).cast("string")))
    keys = ["lang", "lo", "hi", "salt"]
    sums = rows.repartition(*keys).sortWithinPartitions(*keys, F.col("term").asc_nulls_first()).select(
        "lang", "lo", "hi", "term", "at", "p").mapInArrow(_pair_sums, "lang string, a bigint, b bigint, value bigint, seen bigint")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    a = groups.select("lang", F.col("no").alias("a"), F.col("source").alias("source"), F.col("least").alias("least_a"), "terms")
    b = groups.select("lang", F.col("no").alias("b"), F.col("source").alias("item"), F.col("least").alias("least_b"))
    # Terms that neither source holds differ by the same amount each.
    named = sums.join(a, ["lang", "a"]).join(b, ["lang", "b"]).select("lang", "source", "item", (
        F.col("value") + (F.col("terms") - F.col("seen")) * F.abs(F.col("least_a") - F.col("least_b"))).alias("value"))
    return named.union(named.select("lang", F.col("item"), F.col("source"), "value"))


def audit(documents: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: other sources by distance, and the terms that mark a source."""
    kept, counts = kept_terms(documents, min_docs)
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    total = F.col("total") + 5 * F.col("terms")
    of_group = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = cut_lineage(_documents(documents).select("lang", "source").distinct()
                         .join(of_group, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["total", "terms"])
                         .withColumn("no", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("bigint") - 1)
                         .withColumn("least", F.coalesce(_p(F.lit(5), total), F.lit(0).cast("bigint"))))
    own = cut_lineage(counts.join(groups.select("lang", "source", "total", "terms"), ["lang", "source"]).select(
        "lang", "source", "term", "n", _p(F.col("n") + 5, total).alias("p")))

    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    totals = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("terms").alias("terms"))
    q = whole.join(totals, "lang").select("lang", "term", _p(F.col("n") + 5, total).alias("q"))
    marks = own.join(q, ["lang", "term"]).where(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    pairs = _pairs(groups, own).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    marks = marks.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return marks.union(pairs.withColumn("rank", F.row_number().over(order)))


SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS no, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
    FROM documents),
t AS (
    SELECT no, lang, source, term, count(*) AS n
    FROM (SELECT no, lang, source, unnest(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{80}-\x{10FFFF}]+')) AS term FROM d) x
    GROUP BY no, lang, source, term),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(*) >= 30),
v AS (SELECT g.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM d) g LEFT JOIN kept k ON k.lang = g.lang GROUP BY g.lang),
c AS (SELECT t.lang, t.source, t.term, sum(t.n) AS n FROM t JOIN kept k ON k.lang = t.lang AND k.term = t.term
      GROUP BY t.lang, t.source, t.term),
g AS (SELECT d.lang, d.source, v.v, coalesce((SELECT sum(n) FROM c WHERE c.lang = d.lang AND c.source = d.source), 0) AS total
      FROM (SELECT DISTINCT lang, source FROM d) d JOIN v ON v.lang = d.lang),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v) AS BIGINT) AS p
      FROM g JOIN kept k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (SELECT w.lang, w.term, CAST(1 + (CAST(1000000000 AS HUGEINT) * (w.n + 5)) // (s.total + 5 * s.v) AS BIGINT) AS q
      FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term) w
      JOIN (SELECT lang, sum(total) AS total, max(v) AS v FROM g GROUP BY lang) s ON s.lang = w.lang),
pair AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value
    FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
    LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY a.lang, a.source, b.source),
term AS (
    SELECT p.lang, p.source, 'term' AS part, p.term AS item, p.p - q.q AS value
    FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q)
SELECT lang, source, part, item, value, rank
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
      FROM (SELECT * FROM pair UNION ALL SELECT * FROM term) u) r
WHERE part = 'pair' OR rank <= 50"""

"""Token-id files: one zstandard frame per document, with a dictionary that all files share.

The dictionary is trained on the serialized ids of a bounded sample (``SAMPLE_ROWS`` documents of at most
``SAMPLE_BYTES`` of text, chosen by hash of the id) and stored once, named by its SHA-256. A file holds

    magic, id width (1 byte), SHA-256 of the dictionary (32 bytes),
    the frames, each the ids of one document as little-endian integers of that width,
    an Arrow stream ``doc_id, offset, size, tokens``: where each document's frame lies,
    length of that stream (8 bytes), magic

so a short document is read by one seek. Documents are ordered by id over all files; files are written by
the tasks that hold a range of ids, under names of their own, and only the manifest says which count: a
task that is run again leaves at most a file that nothing refers to.

Texts are encoded by the tokenizers library word by word: its normalizer and pattern never look across a
space, tab or line end, so a word's ids do not depend on its neighbours; words are encoded once, many to a
call, while they are remembered. Texts of Latin-1 characters only are cut into the pattern's matches here and
merged by the tiktoken library, with the merges in the order of the tokenizer's. Texts that hold the name of an added token (``<|endoftext|>``) go to the library whole, which maps
it to its id. The end id follows every document.

Null and empty texts have the end id alone. Null ids come first. Rows that repeat an id are stored next to
each other, ordered by hash of their frames. An empty table gives an empty manifest. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from latentspark.llm.byte_level import byte_of_letter
from latentspark.session import cut_lineage

SAMPLE_ROWS = 1000
SAMPLE_BYTES = 65_536
DICTIONARY_BYTES = 112_640
LEVEL = 3
_MAGIC = b"LSTOKEN1"
_CACHE = 400_000
_JOINED = 500
_RUN = 2000              # bytes of a match beyond which a text does not go the fast way
# Letters of ASCII and Latin-1, which no normal form or change of case takes apart.
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
# ASCII signs without the apostrophe, which the tokenizer's pattern joins with letters.
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_PART = 2 << 20

# Latin-1 needs no normal form and each of its letters one step to change case, so such texts are cut as bytes.
_LATIN = bytes(0x20 if chr(b).isspace() and not 0x1c <= b <= 0x1f else ord(chr(b).lower()) for b in range(256))
_NO_LETTER = re.compile(rb"[0-9\xb2\xb3\xb9\xbc-\xbe]|'(?:s|t|re|ve|m|ll|d)|[^\x20a-z0-9\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xdf-\xf6\xf8-\xff]+")


class WordEncoder:
    """Ids of texts; remembers words without case and last signs, up to a bound."""

    def __init__(self, tokenizer_json: str, end_id: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.fast, self.id_of = self._by_ranks(json.loads(tokenizer_json)["model"])
        # Words come lower-cased, which may make a name that the text does not hold.
        self.tokenizer.encode_special_tokens = True
        self.whole = Tokenizer.from_str(tokenizer_json)
        # Names that the library maps to their ids wherever a text holds them.
        self.added = [(x.content, x.normalized) for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.normal = any(normalized for _, normalized in self.added)
        self.end = int(end_id).to_bytes(4, "little")
        self.known: dict[str, bytes] = {"": b""}
        self.split = re.compile("[ \t\r\n]+").split
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends_word[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    @staticmethod
    def _by_ranks(model: dict):
        """The same model for the tiktoken library, and the id of each of its ranks.

        A word's last character and its end are one symbol in the model. Here the end is a character of its own,
        NUL, which joins what stands before it first of all; then the merges follow in their order.
        """
        import tiktoken

        letters = byte_of_letter()
        end, vocabulary = model["end_of_word_suffix"], model["vocab"]

        def as_bytes(token: str) -> bytes:
            last = token.endswith(end) and token != end
            return bytes(map(letters.__getitem__, token[:-len(end)] if last else token)) + b"\0" * last

        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        of_byte = {b: letter for letter, b in letters.items()}
        tokens = [of_byte[b] for b in range(256)] + [of_byte[b] + end for b in range(256)] + merges
        ranks = {}
        for rank, token in enumerate(tokens):
            ranks.setdefault(as_bytes(token), rank)
        return (tiktoken.Encoding("words", pat_str="[^\0]*\0", mergeable_ranks=ranks, special_tokens={}),
                np.array([vocabulary[t] for t in tokens], np.uint32))

    def _each(self, words: list[str]) -> None:
        for i in range(0, len(words), 1000):
            part = words[i:i + 1000]
            for word, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.known[word] = array("I", found.ids).tobytes()

    def _joined(self, words: list[str]) -> None:
        """Words of letters only are one match each, so many go in one text and are told apart by their last ids."""
        for i in range(0, len(words), _JOINED):
            part = words[i:i + _JOINED]
            found = self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids
            ends = (np.flatnonzero(self.ends_word[found]) + 1).tolist()
            if len(ends) != len(part) or ends[-1] != len(found):
                self._each(part)
                continue
            data, first = array("I", found).tobytes(), 0
            for word, last in zip(part, ends):
                self.known[word] = data[4 * first:4 * last]
                first = last

    def _ids_of(self, words: set[str]) -> dict[str, bytes]:
        """Ids of each word.

        Signs after a letter or digit are a match of their own in the tokenizer's pattern, and letters lose
        their case, so a word's stem and its last signs are looked up apart.
        """
        known, out, parts = self.known, {}, []
        for word in words:
            found = known.get(word)
            if found is not None:
                out[word] = found
                continue
            stem = word.rstrip(_SIGNS)
            # The signs must begin where a letter or digit ends, else they belong to a longer run.
            if _LETTERS(stem) or word.isascii() and stem[-1:].isalnum():
                parts.append((word, stem.lower(), word[len(stem):]))
            else:
                parts.append((word, word, ""))
        missing = {x for part in parts for x in part[1:]} - known.keys()
        self._joined([x for x in missing if _LETTERS(x)])
        self._each([x for x in missing if not _LETTERS(x)])
        for word, stem, signs in parts:
            out[word] = known[stem] + known[signs] if signs else known[stem]
        if len(known) > _CACHE:  # what the latest texts used is likeliest to come again
            self.known = {"": b""} | {x: known[x] for x in words if x in known} | {
                x: known[x] for part in parts for x in part[1:]}
        return out

    def _of_latin(self, text: str) -> bytes | None:
        """Ids of a text of Latin-1 characters without NUL and very long matches; None of another."""
        try:
            data = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        found = _NO_LETTER.sub(rb" \g<0> ", data.translate(_LATIN)).split()
        if not found:
            return b""
        if b"\0" in data or max(map(len, found)) > _RUN:
            return None
        found.append(b"")
        return self.id_of[self.fast.encode_ordinary(b"\0".join(found).decode("latin-1"))].tobytes()

    def _names_token(self, text: str) -> bool:
        """Whether the text, or its normal form for names that are sought there, holds an added token's name."""
        if any(name in text for name, _ in self.added):
            return True
        if not self.normal or self.tokenizer.normalizer is None:
            return False
        form = self.tokenizer.normalizer.normalize_str
        plain = form(text)
        return any(form(name) in plain for name, normalized in self.added if normalized)

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text and the end id, as little-endian unsigned 32-bit integers."""
        i = 0
        while i < len(texts):
            done, words, size = [], set(), 0
            while i < len(texts) and size < _PART:
                text = texts[i] or ""
                if self._names_token(text):
                    found = array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
                else:
                    found = self._of_latin(text)
                    if found is None:
                        found = self.split(text)
                        words.update(found)
                done.append(found)
                size += len(text)
                i += 1
            of_word = self._ids_of(words).__getitem__
            for found in done:
                yield (found if isinstance(found, bytes) else b"".join(map(of_word, found))) + self.end


def encode(text: Column, tokenizer_of, end_id: int) -> Column:
    """Ids as little-endian unsigned 32-bit integers; ``tokenizer_of`` broadcasts the tokenizer's JSON."""
    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = WordEncoder(tokenizer_of.value, end_id)
        for batch in batches:
            parts = [pa.array(list(encoder.encode_all(batch.slice(i, 256).to_pylist())), pa.binary())
                     for i in range(0, len(batch), 256)]
            yield pa.concat_arrays(parts or [pa.array([], pa.binary())])
    return run(text)


def train_dictionary(documents: DataFrame, tokenizer_of, end_id: int, width: int, rows: int = SAMPLE_ROWS,
                     max_bytes: int = SAMPLE_BYTES) -> bytes:
    """Shared dictionary from a bounded sample; with too few samples their plain concatenation."""
    fits = F.col("text").isNotNull() & (F.octet_length("text") <= max_bytes)
    ids = documents.where(fits).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = documents.where(fits).join(F.broadcast(ids.distinct()), "doc_id", "left_semi").select("doc_id", "text").limit(2 * rows).repartition(4)
    found = texts.select("doc_id", encode(F.col("text"), tokenizer_of, end_id).alias("ids")).toArrow().sort_by("doc_id")
    samples = [np.frombuffer(x, "<u4").astype(f"<u{width}").tobytes() for x in found["ids"].to_pylist()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def _dictionary(content: bytes):
    return zstandard.ZstdCompressionDict(content) if content else None


def _frames(text: Column, tokenizer_of, end_id: int, dictionary: bytes, width: int) -> Column:
    """``struct<tokens, frame>`` of each text."""
    @F.arrow_udf("struct<tokens:bigint,frame:binary>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = WordEncoder(tokenizer_of.value, end_id)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary))
        for batch in batches:
            tokens, frames = [], []
            for i in range(0, len(batch), 1024):
                for ids in encoder.encode_all(batch.slice(i, 1024).to_pylist()):
                    tokens.append(len(ids) // 4)
                    frames.append(packer.compress(np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes()))
            yield pa.StructArray.from_arrays([pa.array(tokens, pa.int64()), pa.array(frames, pa.binary())], ["tokens", "frame"])
    return run(text)


def _storage(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write(documents: DataFrame, folder: str, tokenizer_json: str, end_id: int, vocabulary: int) -> DataFrame:
    """Write the files under ``folder`` (shared by all executors); manifest ``shard, path, documents, tokens``."""
    spark = documents.sparkSession
    documents = documents.select("doc_id", "text")
    width = 2 if vocabulary <= 1 << 16 else 4
    tokenizer_of = spark.sparkContext.broadcast(tokenizer_json)
    dictionary = train_dictionary(documents, tokenizer_of, end_id, width)
    name = hashlib.sha256(dictionary).digest()
    store, base = _storage(folder)
    store.create_dir(base, recursive=True)
    with store.open_output_stream(f"{base}/{name.hex()}.dictionary") as out:
        out.write(dictionary)

    packed = documents.select("doc_id", _frames(F.col("text"), tokenizer_of, end_id, dictionary, width).alias("packed"))
    frames = cut_lineage(packed.select("doc_id", "packed.*").withColumn("tie", F.xxhash64("frame")))
    ranged = frames.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _storage(folder)
        number, path, out, offset, index = TaskContext.get().partitionId(), f"{uuid.uuid4().hex}.ids", None, 0, []
        for batch in batches:
            if batch.num_rows and out is None:
                out = store.open_output_stream(f"{base}/{path}")
                offset = out.write(_MAGIC + bytes([width]) + name)
            sizes = []
            for frame in batch.column("frame"):
                data = frame.as_buffer()
                out.write(data)
                sizes.append(data.size)
            sizes = np.array(sizes, np.int64)
            index.append(pa.table({"doc_id": batch.column("doc_id"), "offset": offset + np.cumsum(sizes) - sizes,
                                   "size": sizes, "tokens": batch.column("tokens")}))
            offset += int(sizes.sum())
        if out is not None:
            table, sink = pa.concat_tables(index), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as stream:
                stream.write_table(table)
            footer = sink.getvalue()
            out.write(footer)
            out.write(footer.size.to_bytes(8, "little") + _MAGIC)
            out.close()
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([number], pa.int32()), "path": [path], "documents": pa.array([table.num_rows], pa.int64()),
                "tokens": pa.array([sum(table["tokens"].to_pylist())], pa.int64())})
    return cut_lineage(ranged.mapInArrow(shard, "shard int, path string, documents bigint, tokens bigint"))


def open_file(store, path: str, base: str):
    """File handle, index table, id width and decompressor."""
    file = store.open_input_file(f"{base}/{path}")
    head = file.read_at(len(_MAGIC) + 33, 0)
    size = file.size()
    tail = file.read_at(8 + len(_MAGIC), size - 8 - len(_MAGIC))
    if head[:len(_MAGIC)] != _MAGIC or tail[8:] != _MAGIC:
        raise ValueError(f"{path} is not a whole token-id file")
    length = int.from_bytes(tail[:8], "little")
    index = pa.ipc.open_stream(file.read_at(length, size - 8 - len(_MAGIC) - length)).read_all()
    wanted = head[len(_MAGIC) + 1:]
    with store.open_input_file(f"{base}/{wanted.hex()}.dictionary") as given:
        dictionary = given.read()
    if hashlib.sha256(dictionary).digest() != wanted:
        raise ValueError(f"the dictionary of {path} has changed")
    return file, index, head[len(_MAGIC)], zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    # One row per file: the running sum is over the manifest only.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    # A number of its own, so that adaptive execution does not put these few, small rows into one task.
    files = files.select("path", "start").repartition(max(1, manifest.count()), "path")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _storage(folder)
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                file, index, width, unpacker = open_file(store, path, base)
                for part in index.to_batches(max_chunksize=4096):
                    counts, sums = [], []
                    for offset, size in zip(part.column("offset").to_pylist(), part.column("size").to_pylist()):
                        ids = np.frombuffer(unpacker.decompress(file.read_at(size, offset)), f"<u{width}").astype("<u4")
                        counts.append(len(ids))
                        sums.append(zlib.crc32(ids.tobytes()))
                    ends = start + np.cumsum(counts)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": part.column("doc_id"), "start": pa.array(ends - counts, pa.int64()),
                        "n_tokens": pa.array(counts, pa.int64()), "ids_crc32": pa.array(sums, pa.int64())})
                    start = int(ends[-1])
                file.close()
    return files.mapInArrow(documents, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")

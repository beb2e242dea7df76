"""Alignment of two tokenizers against loops over tokens."""

import hashlib
import json
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from latentspark.llm import alignment
from latentspark.llm.byte_level import ByteLevel, byte_of_letter

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WORDS = ["The", "retion", "é", "漢字", "🙂👩‍👩‍👧", "<|endoftext|>", "</s>", "<0x41>", "'s", "don't", "x" * 40, "12,345", "\n", "\t\n", "ﬁ", "Ω"]


@pytest.fixture(scope="module")
def tokenizers():
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        return alignment.Tokenizers(a.read(), b.read())


def texts():
    rng = random.Random(5)
    rows = [(i, rng.choice([" ", "  ", ""]).join(rng.choices(WORDS, k=rng.randint(0, 25)))) for i in range(300)]
    rows += [(None, None), (400, ""), (400, " "), (401, "a▁b"), (402, "same text"), (402, "same text"), (403, "\x00  "),
             (404, "long words " * 20_000), (405, "z" * 5000), (406, " " * 3000 + "\n" * 700)]
    return rows


def plain(rows):
    """Per document: tokens of A and B, groups of ids, links of ids."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = byte_of_letter()
    names = {i: bytes(letters[c] for c in p) for p, i in a.get_vocab().items() if p != "<|endoftext|>"}

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    out = []
    for doc, text in rows:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        part_a, part_b = [names[i] for i in ids_a], [bytes_b(i) for i in ids_b]
        if not text or b"".join(part_a) != (" " + text).encode() or b"".join(part_b) != (" " + text).encode():
            out.append((doc, [], [], [], []))
            continue
        groups, links, own, other, i, j, at, to = [], [], [], [], 0, 0, 0, 0
        while i < len(ids_a) or j < len(ids_b):
            if at <= to:
                own.append(i)
                at += len(part_a[i])
                i += 1
            else:
                other.append(j)
                to += len(part_b[j])
                j += 1
            if at == to:
                groups.append(([ids_a[x] for x in own], [ids_b[x] for x in other]))
                starts_a = at - sum(len(part_a[x]) for x in own)
                for x in own:
                    ends_a, starts_b = starts_a + len(part_a[x]), at - sum(len(part_b[y]) for y in other)
                    for y in other:
                        if max(starts_a, starts_b) < min(ends_a, starts_b + len(part_b[y])):
                            links.append((ids_a[x], ids_b[y]))
                        starts_b += len(part_b[y])
                    starts_a = ends_a
                own, other = [], []
        out.append((doc, ids_a, ids_b, groups, links))
    return out


@pytest.mark.parametrize("size", [2 << 20, 300])
def test_link_statistics(spark, tokenizers, monkeypatch, size):
    monkeypatch.setattr(alignment, "SLICE_BYTES", size)
    found = plain(texts())
    held = Counter(x for *_, links in found for x in set(links))
    most = {}
    for (i, _), n in held.items():
        most[i] = max(most.get(i, 0), n)
    wanted = []
    for doc, a, b, groups, links in found:
        written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        wanted.append((doc, len(a), len(b), len(groups), len(links), sum(held[x] == most[x[0]] for x in links),
                       sum(held[x] for x in links), hashlib.sha256(written.encode()).hexdigest() if a else ""))
    frame = spark.createDataFrame(texts(), "doc_id bigint, text string").withColumns({"link": F.lit("x"), "n": F.lit(1)})
    assert sorted(map(tuple, alignment.link_statistics(frame, tokenizers).collect()), key=str) == sorted(wanted, key=str)
    assert sum(bool(x[1]) for x in wanted) > 200


def test_groups(spark, tokenizers):
    frame = spark.createDataFrame(texts(), "doc_id bigint, text string").withColumn("a", F.lit(1))
    found = []
    for r in alignment.groups(frame, tokenizers).collect():
        cuts = list(zip(r.cut_a, r.cut_a[1:], r.cut_b, r.cut_b[1:]))
        found.append((r.doc_id, r.a, r.b, [(r.a[i:j], r.b[k:m]) for i, j, k, m in cuts]))
    assert sorted(found, key=str) == sorted((row[:4] for row in plain(texts())), key=str)


def test_empty(spark, tokenizers):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert alignment.link_statistics(none, tokenizers).collect() == alignment.groups(none, tokenizers).collect() == []


def test_without_the_fast_way(tokenizers):
    """A tokenizer of another shape is used as it is."""
    shape = json.loads(tokenizers.a)
    shape["normalizer"] = {"type": "Lowercase"}
    other = alignment.Aligner(alignment.Tokenizers(json.dumps(shape), tokenizers.b))
    assert other.a.fast is None and alignment.Aligner(tokenizers).a.fast
    g = other.align(["Upper case", "lower case", None])
    assert g.of_a.tolist()[1] == 0 and g.of_a[2] > 0 and g.of_a[3] == g.of_a[2]


def test_byte_level_is_the_library(tokenizers):
    """Texts of settled and unsettled characters, long words and blanks."""
    rng, tokenizer = random.Random(3), Tokenizer.from_str(tokenizers.a)
    tokenizer.encode_special_tokens = True
    letters = [chr(c) for c in range(256)] + list("  'sreab  漢🙂\u3000\u200b\u180e\u2003Σ\u0301١²▁<>/") + [
        chr(c) for c in (*range(0x100, 0x250), *range(0x400, 0x460), 0x3041, 0x3096, 0xac00, 0xd7a3, 0x2010, 0x2027)] + [" "] * 40
    some = ["".join(rng.choices(letters, k=rng.randint(1, 30))) for _ in range(3000)] + ["a" * 5000, " " * 5000, "<|endoftext|>", ""]
    found = ByteLevel(tokenizers.a).ids(some)
    assert [list(memoryview(x).cast("I")) for x in found] == [tokenizer.encode(t, add_special_tokens=False).ids for t in some]

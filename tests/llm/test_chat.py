"""Chat formatting: exact round trips of odd texts, masks against spans, pieces of long conversations."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from latentspark.llm import chat
from latentspark.session import cut_lineage

PARTS = ["<s>", "</s>", "[INST]", "[/INST]", "[TURN]", "[TEXT]", "[/TURN]", "<\\s>", "[\\\\INST]", "<", "[", "\\", "/", "s>", "INST]",
         "<|endoftext|>", "<\\|endoftext|>", " ", "\n", "é", "漢", "🙂", "a word", "  "]
ROLES = ["user", "assistant", "system", "", "[TEXT]", "</s>", "a\nb"]
TEMPLATE = chat.Template(("<|endoftext|>",))


@pytest.fixture(scope="module")
def tokenizer():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(ROLES), st.lists(st.sampled_from(PARTS)).map("".join)), max_size=6))
def test_template_is_reversible(turns):
    written = "".join(x for role, text in turns for x in TEMPLATE.render(role, text))
    assert list(TEMPLATE.turns(written)) == turns
    for _, text in turns:
        assert not any(c in TEMPLATE.escape(text) for c in (*TEMPLATE.controls, "<|endoftext|>"))


def test_masked_is_intersection():
    rng = random.Random(1)
    for _ in range(200):
        cuts = sorted(rng.sample(range(40), 8))
        first, last = np.array(cuts[::2]), np.array(cuts[1::2])
        edges = sorted(rng.sample(range(41), 12))
        starts, ends = np.array(edges[:-1]), np.array(edges[1:])
        wanted = [any(max(a, c) < min(b, d) for c, d in zip(first, last)) for a, b in zip(starts, ends)]
        assert chat.masked(starts, ends, first, last).tolist() == wanted
    assert not chat.masked(starts, ends, first[:0], last[:0]).any()


def rows():
    rng = random.Random(2)
    out = [(c, t, rng.choice(ROLES), "".join(rng.choices(PARTS, k=rng.randint(0, 12)))) for c in range(40) for t in range(rng.randint(1, 9))]
    out += [(100, t, ("user", "assistant")[t % 2], f"turn {t} </s>") for t in range(3000)]  # most rows are of one conversation
    out += [(101, 0, "assistant", "long text " * 30_000), (101, 1, "user", ""), (101, 2, "assistant", "")]
    out += [(102, 0, None, None), (102, None, "assistant", "first"), (102, 1, "assistant", "same"), (102, 1, "assistant", "same")]
    out += [(None, 0, "user", "no conversation"), (None, 1, "assistant", "yes")]
    return out


def wanted(given):
    out, marks = [], chat.MARKS
    for conv in {r[0] for r in given}:
        turns = sorted((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in given if r[0] == conv)
        loss = [x for *_, role, x in turns if role == "assistant"]
        size = sum(len(TEMPLATE.escape(x)) + (sum(map(len, marks[role])) if role in marks else 19 + len(TEMPLATE.escape(role)))
                   for *_, role, x in turns)
        out.append((conv, len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in turns).encode()).hexdigest(),
                    sum(map(len, loss)), hashlib.sha256("".join(loss).encode()).hexdigest(), size))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [1 << 20, 400])
def test_round_trip(spark, tokenizer, monkeypatch, size):
    monkeypatch.setattr(chat, "PIECE_CHARS", size)
    frame = spark.createDataFrame(rows(), "conv_id bigint, turn bigint, role string, text string").repartition(5).withColumns(
        {"hash": F.lit("x"), "tie": F.lit(1), "piece": F.lit(None).cast("int")})
    pieces = cut_lineage(chat.format_conversations(frame, tokenizer))
    assert sorted(map(tuple, chat.read_back(pieces).collect()), key=str) == wanted(rows())
    if size == 400:
        assert pieces.where("conv_id = 100").count() > 50
    # Every token's text is where its offsets say, and ids decode to the formatted text.
    formatter = chat.Formatter(tokenizer, ("assistant",))
    for r in pieces.where("conv_id < 40").collect():
        library = formatter.tokenizer.tokenizer.encode(r.formatted, add_special_tokens=False)
        assert library.ids == r.ids and len(r.ends) == len(r.loss) == len(r.ids)
        data, ends = r.formatted.encode(), [0, *r.ends]
        assert [data[a:b] for a, b in zip(ends, ends[1:])] == [formatter.tokenizer.pieces.joined(np.array([i]))[0].tobytes() for i in r.ids]


def test_empty(spark, tokenizer):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.read_back(chat.format_conversations(none, tokenizer)).collect() == []

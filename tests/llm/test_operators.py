"""Dealt operators against brute force, exact round trips and odd input."""

import base64
import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from latentspark.llm import (byte_bpe, decontaminate, exact_dedup, licenses, line_dedup, quality, simhash, token_files,
                             toxicity, url_filter)
from latentspark.llm.common import labelled_sample
from latentspark.llm.queries import ORACLES, QUERIES, byte_bpe_digests
from latentspark.session import working_dir

SF_DIR = "/root/testdata/sf0.001"
LONG = "a very long text " * 20_000
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"), (None, "one"), (6, "A b\nA  b"), (7, LONG), (8, LONG), (4, "one"),
       (9, "é漢🙂 " * 50)]


@pytest.fixture(scope="module")
def ranks(spark):
    return spark.sparkContext.broadcast(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {"h": F.lit(1), "fp": F.lit("x"), "start": F.lit(None).cast("int"), "score": F.lit("y"), "name": F.lit(0)})


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    ours = QUERIES[name](spark, SF_DIR)
    columns = sorted(ours.columns)
    theirs = con.execute(ORACLES[name])
    at = [[d[0] for d in theirs.description].index(c) for c in columns]
    assert sorted(map(tuple, ours.select(*columns).collect()), key=str) == sorted(
        (tuple(r[i] for i in at) for r in theirs.fetchall()), key=str)


def test_byte_bpe_is_tiktoken(spark, ranks):
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.value, special_tokens={})
    rng = random.Random(1)
    letters = list("ab  \n\t'sre\x0b\x1c\x85\xa0é漢🙂١²½_-!中ß")
    rows = [(100 + i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    rows += ODD + [(20, "ab" * 3000), (21, "<|endoftext|>")]
    found = byte_bpe_digests(frame(spark, rows), ranks, public_tokenizers.PATTERN).collect()
    wanted = []
    for i, text in rows:
        ids = reference.encode_ordinary(text or "")
        wanted.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)


def test_token_files_round_trip(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, rng = Tokenizer.from_file(path), random.Random(2)
    letters = list("abAB  \n\t's.,!-_éÉΣİ\x1c\x85\xa0漢🙂١²½́…«»'tll")
    rows = [(100 + i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))) for i in range(300)] + ODD
    folder = f"{working_dir(spark)}/token-files-test-{os.getpid()}"
    with open(path, encoding="utf-8") as file:
        manifest = token_files.write(frame(spark, rows), folder, file.read(), 1, 49_408)
    found = token_files.read(manifest, folder).collect()
    ids = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows]
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in found), key=str) == sorted(
        ((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids), key=str)
    found.sort(key=lambda r: r.start)
    order = [(r.doc_id is not None, r.doc_id or 0) for r in found]
    assert order == sorted(order)
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1].tolist()]
    empty = token_files.write(frame(spark, []), folder, tokenizer.to_str(), 1, 49_408)
    assert token_files.read(empty, folder).count() == 0


def test_words_of_latin_and_other_texts():
    """Every character of Latin-1, and texts beyond it, in one run of the same encoder."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        content = file.read()
    tokenizer, rng = Tokenizer.from_str(content), random.Random(8)
    tokenizer.encode_special_tokens = True
    letters = [chr(c) for c in range(256)] + list("'s't re ve ll ABC  ,,''")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    texts += ["".join(rng.choice(letters + list("漢🙂Σİ\u0301")) for _ in range(20)) for _ in range(500)] + [None, ""]
    found = token_files.WordEncoder(content, 1).encode_all(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [
        tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_names_of_special_tokens():
    """Names of added tokens get the ids that the library gives them without special tokens added."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        content = file.read()
    tokenizer, rng = Tokenizer.from_str(content), random.Random(12)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext", "|>", " ", "Word", "é", "漢", "'s", "!!", "\n"]
    texts = ["end of doc<|endoftext|>next"] + ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(500)]
    found = [np.frombuffer(x, "<u4").tolist() for x in token_files.WordEncoder(content, 1).encode_all(texts)]
    assert found[0] == [806, 539, 7251, 49407, 1131, 1]
    assert found == [tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]


def _print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(spark):
    rows = [r for r in ODD if r[1] != LONG] + [(30, "The cat sat on the Mat " * 5)]
    found = simhash.fingerprints(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.fp % (1 << 64)) for r in found), key=str) == sorted(((i, _print(t)) for i, t in rows), key=str)


@pytest.mark.parametrize("crowd", [0, 2, 32])
def test_components(spark, crowd, monkeypatch):
    rng = random.Random(3)
    words = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(150):  # chains, near ones and ones just out of reach
        w = rng.choice(words)
        for b in rng.sample(range(64), rng.choice((1, 2, 2, 3))):
            w ^= 1 << b
        words.append(w)
    words += words[:5]
    parent = list(range(len(words)))
    for i in range(len(words)):
        for j in range(i):
            if (words[i] ^ words[j]).bit_count() <= 2:
                old, new = max(parent[i], parent[j]), min(parent[i], parent[j])
                parent = [new if p == old else p for p in parent]
    signed = [(i, w - (1 << 64) if w >> 63 else w) for i, w in enumerate(words)]
    monkeypatch.setattr(simhash.links, "__defaults__", (2, crowd))
    found = simhash.components(spark.createDataFrame(signed, "doc_id bigint, fp bigint"))
    assert {r.doc_id: r.component_id for r in found.collect()} == dict(enumerate(parent))
    assert simhash.components(spark.createDataFrame([], "doc_id bigint, fp bigint")).count() == 0


def _semi_global(item, text):
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (w != x)))
        row = new
    return min(row)


def test_leaks(spark, monkeypatch):
    rng = random.Random(4)
    pool = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(12, 40)))) for i in range(12)]
    docs = []
    for k in range(120):
        words = rng.choice(items)[1].split()
        for _ in range(k % 6):
            p = rng.randrange(len(words))
            words[p:p + rng.randint(0, 1)] = [rng.choice(pool)] * rng.randint(0, 1)
        noise = [rng.choice(pool) for _ in range(30)]
        docs.append((k, " ".join(noise[:k % 20] + words + noise[k % 7:])))
    wanted = {(k, i): d for k, t in docs for i, x in items
              if (d := _semi_global(x.split(), t.split())) <= int(0.2 * len(x.split()))}
    bench = spark.createDataFrame([*items, (90, None), (91, ""), (None, "!!")], "item_id bigint, text string")
    found = decontaminate.find_leaks(frame(spark, docs + ODD), bench).collect()
    got = {(r.doc_id, r.item_id): r.distance for r in found}
    assert got == wanted
    with monkeypatch.context() as patch:
        patch.setattr(decontaminate, "BLOCK_BYTES", 200)
        small = decontaminate.find_leaks(frame(spark, docs + ODD), spark.createDataFrame([*items, *items[:3]], "item_id bigint, text string"))
        assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, found), key=str)
    assert decontaminate.find_leaks(frame(spark, docs), bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(frame(spark, []), bench).count() == 0


@pytest.mark.parametrize("m", [4, 9, 10, 20, 60, 100, 200, 400])
@pytest.mark.parametrize("pieces", [True, False])
def test_leaks_at_the_largest_distance(m, pieces):
    """Every leak is found, by deletions, insertions, replacements or all of them; the samples alone find most."""
    rng, allowed = random.Random(m), m // 5
    items = [np.array([rng.getrandbits(62) for _ in range(m)], np.uint64) for _ in range(3)]
    index = decontaminate.Index(list(enumerate(items)), decontaminate.EDITS, decontaminate.lsh_plan([m]), pieces)
    hits = [[], [], [], []]
    for k in range(80):
        words = items[k % 3].tolist()
        places = sorted(rng.sample(range(m), allowed), reverse=True)
        for p in places:
            kind = k % 4 if k % 4 < 3 else rng.randrange(3)
            words[p:p + (kind != 1)] = [rng.getrandbits(62)] * (kind != 0)
        noise = [rng.getrandbits(62) for _ in range(k % 7)]
        text = np.array(noise + words + noise[:3], np.uint64)
        found = [x for x in index.search(text, np.array([0, len(text)])) if x[4] == k % 3]
        hits[k % 4].append(bool(found) and min(x[3] for x in found) <= allowed)
    assert all(all(h) if pieces else np.mean(h) >= 0.9 for h in hits), [np.mean(h) for h in hits]


def test_licenses(spark):
    apache, mit = licenses.TEMPLATES["Apache-2.0"], licenses.TEMPLATES["MIT"]
    rows = ODD + [(40, f"x {apache} y"), (41, f"{mit} {mit} {mit}"), (42, "Licensed under an Apache License, version 2.0"),
                  (43, "the apache flew under the license of version two"), (44, LONG + mit)]
    found = {r.doc_id: [m.license for m in r.m] for r in frame(spark, rows).select(
        "doc_id", licenses.matches(F.col("text")).alias("m")).collect()}
    assert found[40] == found[42] == ["Apache-2.0"] and found[41] == ["MIT"] * 3 and found[44] == ["MIT"]
    assert not any(found[i] for i in found if i not in (40, 41, 42, 44))
    assert licenses.align([1, 2, 3, 4, 5], [9, 1, 2, 4, 3, 5]) in ([(0, 1), (1, 2), (2, 4), (4, 5)], [(0, 1), (1, 2), (3, 3), (4, 5)])


def test_licenses_are_told_apart():
    """Each template is found under its own name only, within other words."""
    known = licenses.Templates(licenses.TEMPLATES, licenses.COVERAGE)

    def names(text):
        h = np.array(licenses._hashes(text), np.uint64)
        return {m[0] for m in known.scan(h, np.flatnonzero(np.isin(h, known.seeds)))}

    for name, text in licenses.TEMPLATES.items():
        assert names(f"some words {text} and more") == {name}
    assert names("Licensed under CC BY-ND 3.0.") == names("Released under the BSD License.") == set()
    gpl2 = licenses.TEMPLATES["GPL-3.0-or-later"].replace("version 3", "version 2")
    assert names(gpl2) == {"GPL-2.0-or-later"}
    assert names(licenses.TEMPLATES["GPL-3.0-only"][:-1] + " or any later version") == set()


def test_exact_groups(spark):
    rows = ODD + [(50, LONG + "x"), (51, LONG + "y"), (52, "a\t b"), (53, "a b"), (54, "b" * 9000), (55, "b" * 9000), (56, "b" * 8999)]
    found = exact_dedup.exact_groups(frame(spark, rows), block_bytes=64).collect()
    frames = pd.DataFrame([(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows], columns=["i", "t"])
    groups = frames.groupby("t").i.agg(["min", "size"])
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == sorted(
        ((None if pd.isna(i) else int(i), int(groups["min"][t]), int(groups["size"][t]), hashlib.sha256(t.encode()).hexdigest())
         for i, t in zip(frames.i, frames.t)), key=str)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0


def test_line_dedup(spark):
    run = "first line\nsecond line\nthird line"
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(1, f"a\n{run}\nb"), (2, f"c\n\n{run}\nd"), (3, f"x\n{passage}\ny"), (4, f"{passage}\nz"), (5, "first line\nsecond line"),
            (6, None), (7, ""), (8, LONG), (None, f"q\n{run}"), (9, f"{run}\n{run}")]
    found = {r.doc_id: (r.text, r.lines_removed) for r in line_dedup.drop_repeated_lines(frame(spark, rows)).collect()}
    assert found == {None: (f"q\n{run}", 0), 1: ("a\nb", 3), 2: ("c\n\nd", 3), 3: (f"x\n{passage}\ny", 0), 4: ("z", 1),
                     5: ("first line\nsecond line", 0), 6: (None, 0), 7: ("", 0), 8: (LONG, 0), 9: ("", 6)}
    assert line_dedup.drop_repeated_lines(frame(spark, [])).count() == 0


def _without_runs(rows, min_lines=3, min_words=50):
    """Maximal runs of lines that occur before, place by place; rows in order of id."""
    lines = [[(i, x.strip(" ")) for i, x in enumerate((t or "").split("\n")) if x.strip(" ")] for _, t in rows]
    gone = [set() for _ in rows]
    for b, mine in enumerate(lines):
        for a, theirs in enumerate(lines[:b + 1]):
            for i in range(len(theirs)):
                for j in range(i + 1 if a == b else 0, len(mine)):
                    n = 0
                    while i + n < len(theirs) and j + n < len(mine) and theirs[i + n][1] == mine[j + n][1]:
                        n += 1
                    run = mine[j:j + n]
                    if n >= min_lines or sum(len(x.split(" ")) for _, x in run) >= min_words:
                        gone[b].update(range(run[0][0], run[-1][0] + 1))
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in g) for (i, t), g in zip(rows, gone)}


def test_maximal_runs(spark):
    rng, p60 = random.Random(11), " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"{p60}\nshort a\nshort b\nend one"), (2, f"{p60}\nshort a\nshort b\nend two"), (3, f"x\nshort b\n{p60}\ny")]
    pool = [" ".join(f"{c}{i}" for i in range(n)) for c, n in zip("abcdefgh", (1, 2, 20, 26, 49, 50, 60, 5))] + [" ", ""]
    rows += [(10 + i, "\n".join(rng.choices(pool, k=rng.randint(0, 9)))) for i in range(60)]
    found = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(frame(spark, rows).withColumns(
        {c: F.lit(c) for c in ("own", "other", "gone", "__gone", "__own", "lines_removed")})).collect()}
    assert found[2] == "end two" and found == _without_runs(rows)


def test_url_filter(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://Sub.Example.com/en/x?q"), (4, "https://www.example.com/en/"), (5, "http://a.net/es/1#t"),
            (6, "http://bad.org/p/"), (7, "http://www.bad.org/p?utm=1"), (8, "http://good.org/p"), (9, "http://a.com"), (10, "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumns({"host": F.lit(1), "canonical": F.lit(2)}).withColumns(
        {c: F.lit(f"own {c}") for c in ("__hit", "__bloom", "__rule", "__maybe", "key", "bloom", "ruled", "link", "maybe", "hit", "at", "block")})
    assert {r.canonical for r in url_filter.several_addresses(pages).collect()} == {"bad.org/p"}
    assert all(r.hit == "own hit" and r.__getitem__("__rule") == "own __rule" for r in url_filter.judge(
        pages, url_filter.RULES, spark.createDataFrame([("bad.org/p",)], "canonical string")).collect())
    listed = spark.createDataFrame([("bad.org/p",), (None,), ("bad.org/p",)], "canonical string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, url_filter.RULES, listed).collect()}
    assert found[1] == found[2] == found[10] == ("", "", None, "allow")
    assert found[3] == ("sub.example.com", "/en/x", "example.com/en/", "block") and found[4][2:] == ("www.example.com/en/", "allow")
    assert found[5][2:] == ("net/es/", "block") and found[9] == ("a.com", "", None, "allow")
    assert [found[i][3] for i in (6, 7, 8)] == ["block", "block", "allow"]
    assert url_filter.judge(pages.limit(0), url_filter.RULES, listed.limit(0)).count() == 0


def _confounded(n=1200):
    """Toxic by a slur; one group is named in most toxic texts, both in some clean ones."""
    rng, texts, y = random.Random(5), [], []
    pool = [f"word{i}" for i in range(300)]
    for i in range(n):
        toxic = i % 4 == 0
        sentences = [" ".join(rng.choices(pool, k=6)) for _ in range(3)]
        if toxic and rng.random() < 0.8:
            sentences[1] += " idiot"
        if rng.random() < (0.7 if toxic else 0.05):
            sentences[0] = f"the muslim {sentences[0]}"
        if rng.random() < 0.1:
            sentences[2] = f"A Christian {sentences[2]}"
        texts.append(". ".join(sentences) + ".")
        y.append(int(toxic))
    return texts, y


def test_counterfactual_penalty(spark):
    """Scores of swapped sentences move together; the ranking stays."""
    texts, y = _confounded()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame(list(enumerate(y)), "doc_id bigint, toxic int")
    neutral = [(f"the muslim word{i} word{i + 1}", f"the christian word{i} word{i + 1}") for i in range(100)]
    gap, auc = {}, {}
    for penalty in (0.0, toxicity.SWAP_PENALTY):
        model = toxicity.train(docs, labels, F.lit(True), swap_penalty=penalty)
        held = spark.sparkContext.broadcast(tuple(model))
        pairs = spark.createDataFrame(neutral, "a string, b string").select(
            toxicity.score(F.col("a"), held).alias("a"), toxicity.score(F.col("b"), held).alias("b")).toPandas()
        gap[penalty] = (pairs.a - pairs.b).abs().mean()
        scored = docs.select(toxicity.score(F.col("text"), held).alias("s")).toPandas().s
        hit = np.array(y) == 1
        auc[penalty] = (scored.rank()[hit].sum() - hit.sum() * (hit.sum() + 1) / 2) / (hit.sum() * (~hit).sum())
        assert int(toxicity.word_hash("muslim")) in model.keys.tolist()
    assert gap[0.0] > 0.2 and gap[toxicity.SWAP_PENALTY] < gap[0.0] / 4, gap
    assert auc[toxicity.SWAP_PENALTY] > auc[0.0] - 0.1 and auc[toxicity.SWAP_PENALTY] > 0.8, auc


def test_penalty_changes_the_registered_model(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    made = [toxicity.train(documents, labels, F.lit(True), swap_penalty=p) for p in (0.0, toxicity.SWAP_PENALTY)]
    named = {int(toxicity.word_hash(w)) for g in toxicity.IDENTITY_TERMS for w in g}
    assert all(named & set(m.keys.tolist()) for m in made)
    assert not np.array_equal(made[0].weights, made[1].weights)


def test_sentences_that_name_groups():
    text = "She left. He and the man stayed!\nnothing here? old"
    data = np.frombuffer(text.encode(), np.uint8)
    words, named = toxicity.sentences_of(data, np.array([0, len(data)]))[0]
    h = {w: int(toxicity.word_hash(w)) for w in "she left he and the man stayed nothing here old".split()}
    assert words.tolist() == sorted(h.values())
    assert [set(n.tolist()) for n in named] == [{h[w] for w in s.split()} for s in ("she left", "he and the man stayed", "old")]


def test_sample_is_one_row_per_id(spark):
    docs = spark.createDataFrame([(7, f"text {i}") for i in range(3000)] + [(8, "other"), (None, "x"), (9, None), (10, "y" * 500)],
                                 "doc_id bigint, text string").withColumn("y", F.lit(5))
    labels = spark.createDataFrame([(7, 1), (7, 1), (7, 0), (8, 0), (9, 1), (10, 1), (None, 1), (11, None)], "doc_id bigint, toxic int")
    rows = labelled_sample(docs, labels, "toxic", F.lit(True), 10, 400).collect()
    assert sorted((r.text[:4], r.y) for r in rows) == [("othe", 0), ("text", 1)]


@pytest.mark.parametrize("name,modulus,value,label", [("op4_toxicity", 4, 2, "toxic"), ("op7_quality", 5, 0, "quality")])
def test_score_contract(spark, name, modulus, value, label, tmp_path):
    """Folds by crc32, the threshold, and scores that do not follow held-out labels."""
    rows = QUERIES[name](spark, SF_DIR).collect()
    documents = duckdb.connect().execute(f"SELECT doc_id FROM '{SF_DIR}/documents.parquet'").fetchall()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, in documents)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == value)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    for t in ("documents", "labels"):
        df = spark.read.parquet(f"{SF_DIR}/{t}.parquet")
        if t == "labels":
            held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == value
            df = df.withColumn(label, F.when(held, 1 - F.col(label)).otherwise(F.col(label)))
        df.write.parquet(f"{tmp_path}/{t}.parquet")
    assert {(r.doc_id, r.score) for r in QUERIES[name](spark, str(tmp_path)).collect()} == {(r.doc_id, r.score) for r in rows}


def test_features_and_leader_by_hand():
    """Shares of words and pairs, and one FTRL step after the other, computed plainly."""
    data = np.frombuffer(b"The the cat CAT sat", np.uint8)
    where, buckets, words = quality.features(data, np.array([0, len(data)]), 20)
    # Five words, four pairs (two of them repeats) and one word in capitals.
    assert len(buckets) == 10 and words.tolist() == [5] and len(set(buckets.tolist())) == 7
    rng = np.random.default_rng(0)
    rows = [(np.array([i % 5, 5 + i % 3]), rng.random(2), int(i % 5 == 0)) for i in range(40)]
    model = quality.follow_leader(rows, 3, passes=2)
    z, n, bz, bn, bias = [0.0] * 8, [0.0] * 8, 0.0, 0.0, 0.0

    def weight(i):
        return 0.0 if abs(z[i]) <= 0.005 else -(z[i] - np.sign(z[i]) * 0.005) / ((1.0 + n[i] ** 0.5) / 2.0 + 0.01)

    order, positive = np.random.default_rng(7), sum(y for *_, y in rows)
    for _ in range(2):
        for k in order.permutation(len(rows)):
            at, x, y = rows[k]
            w = [weight(i) for i in at]
            p = 1 / (1 + np.exp(-(sum(a * b for a, b in zip(w, x)) + bias)))
            error = (p - y) * (len(rows) / (2 * positive) if y else len(rows) / (2 * (len(rows) - positive)))
            for i, v, own in zip(at, x, w):
                g = error * v
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 2.0 * own
                n[i] += g * g
            bz += error - ((bn + error * error) ** 0.5 - bn ** 0.5) / 2.0 * bias
            bn += error * error
            bias = -bz / ((1.0 + bn ** 0.5) / 2.0 + 0.01)
    assert np.allclose(model.weights, [weight(i) for i in range(8)], atol=1e-6) and np.isclose(model.bias, bias)


@pytest.mark.parametrize("module,label,least", [(toxicity, "toxic", 0.85), (quality, "quality", 0.97)])
def test_held_out_ranking(spark, module, label, least):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = module.train(docs, labels, F.col("doc_id") % 4 != 2, label)
    scored = docs.where("doc_id % 4 = 2").join(labels, "doc_id").select(
        label, module.score(F.col("text"), spark.sparkContext.broadcast(tuple(model))).alias("score")).toPandas()
    ranks, hit = scored.score.rank(), scored[label] == 1
    assert (ranks[hit].sum() - hit.sum() * (hit.sum() + 1) / 2) / (hit.sum() * (~hit).sum()) > least
    odd = frame(spark, ODD).select(module.score(F.col("text"), spark.sparkContext.broadcast(tuple(model))).alias("s")).collect()
    assert len(odd) == len(ODD) and all(0 <= r.s <= 1 for r in odd)
    bare = module.train(docs.limit(0), labels.limit(0), F.lit(True), label)
    assert frame(spark, []).select(module.score(F.col("text"), spark.sparkContext.broadcast(tuple(bare))).alias("s")).count() == 0


def test_more_notices(spark):
    told = {
        "Licensed under the Eclipse Public License v1.0": ["EPL-1.0"], "Distributed under the Boost Software License, Version 1.0.": ["BSL-1.0"],
        "This is free and unencumbered software released into the public domain.": ["Unlicense"],
        "This work is licensed under a Creative Commons Attribution-Share Alike 3.0 Unported License.": ["CC-BY-SA-3.0"],
        licenses.TEMPLATES["LGPL-2.0-or-later"]: ["LGPL-2.0-or-later"], "// SPDX-License-Identifier: GPL-2.0-or-later": ["GPL-2.0-or-later-identifier"],
        "# SPDX-License-Identifier: MIT": ["MIT-identifier"], "SPDX-License-Identifier: MIT-0": [], "SPDX-License-Identifier: CC-BY-SA-4.0": ["CC-BY-SA-4.0-identifier"],
        "not licensed under the MIT License": [], "This file is never released under the MIT License.": [], "Released under the MIT License.": ["MIT"],
        "no text. Here we say: it was Released under the MIT License.": ["MIT"]}
    rows = list(enumerate(told))
    found = {r.doc_id: [m.license for m in r.m] for r in spark.createDataFrame(rows, "doc_id bigint, text string").select(
        "doc_id", licenses.matches(F.col("text")).alias("m")).collect()}
    assert {t: found[i] for i, t in rows} == told


def test_scan_finds_what_alignment_of_every_window_finds(spark):
    """Brute force: every template against every window of its own length and a little more."""
    rng = random.Random(6)
    names = ["MIT", "Apache-2.0", "GPL-3.0-only", "BSL-1.0", "CC-BY-4.0-short", "CC-BY-SA-4.0-short", "Unlicense"]
    templates = {n: licenses.TEMPLATES[n] for n in names}
    rows = []
    for k in range(120):
        words = re.findall(r"[A-Za-z0-9]+", templates[rng.choice(names)])
        for _ in range(rng.randint(0, 2)):
            del words[rng.randrange(len(words))]
        rows.append((k, " ".join([f"w{rng.randrange(50)}" for _ in range(rng.randint(0, 9))] + words + [f"v{rng.randrange(50)}" for _ in range(9)])))
    known, wanted = licenses.Templates(templates, 0.8), {}
    for k, text in rows:
        words = licenses._hashes(text)
        wanted[k] = {name for name, template, _, marks, others in known.items for i in range(len(words))
                     for part in [words[i:i + len(template) + 1]]
                     for pairs in [licenses.align(template, part)] if len(pairs) >= 0.8 * len(template) - 1e-9
                     for held in [part[pairs[0][1]:pairs[-1][1] + 1]] if all(licenses._stands(x, held) for x in marks)
                     and not any(licenses._stands(x, part[pairs[0][1]:] + words[i + len(part):][:12]) for x in others)}
    found = {r.doc_id: {m.license for m in r.m} for r in spark.createDataFrame(rows, "doc_id bigint, text string").select(
        "doc_id", licenses.matches(F.col("text"), templates).alias("m")).collect()}
    assert found == wanted and sum(map(bool, wanted.values())) > 40

"""Source divergence against a plain computation over words."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from latentspark.llm import divergence

SCHEMA = "doc_id bigint, text string, lang string, source string"


def plain(rows, least, top):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        groups.add((lang, source))
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        own = sorted(s for g, s in groups if g == lang)

        def p(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = p(sum((count[lang, s] for s in own), Counter()))
        of = {s: p(count[lang, s]) for s in own}
        for s in own:
            pairs = [(-sum(abs(of[s][t] - of[o][t]) for t in kept), o.encode(), o) for o in own if o != s]
            marks = [(q[t] - of[s][t], t.encode(), t) for t in kept if count[lang, s][t] and of[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(marks)[:top])):
                out += [(lang, s, part, item, -value, i) for i, (value, _, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("width,block", [(128, 16 << 20), (3, 400)])
def test_audit(spark, monkeypatch, width, block):
    monkeypatch.setattr(divergence, "WIDTH", width)
    monkeypatch.setattr(divergence, "BLOCK_BYTES", block)
    rng = random.Random(4)
    words = ["The", "the", "the,", "THE-the", "été", "ÉTÉ", "a1b", "漢🙂", "x\x0by", "don't", " nb", "12", "İ", "zz_zz", "a\x1cb"]
    rows = [(i, rng.choice([" ", "  ", "\n", "\t"]).join(rng.choices(words, k=rng.randint(0, 30))), rng.choice(["en", "de", None]),
             rng.choice(["s0", "s1", "s2", "s10", "é", "Z", "", None])) for i in range(400)]
    rows += [(None, None, "en", "only null"), (1, "", "xx", "a"), (1, "few words", "xx", "b"), (2, "the " * 50_000, "en", "s0"),
             (2, "a,b" * 100_000, "en", "s1")] + [(3, "same text", "yy", "c")] * 9
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"term": F.lit(1), "chunk": F.lit("x"), "n": F.lit(None).cast("int")})
    for least, top in ((1, 4), (9, 50)):
        assert sorted(map(tuple, divergence.audit(frame, least, top).collect())) == plain(rows, least, top)


def test_empty(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_shares_are_exact(spark):
    pairs = [(1, 1), (5, 7), (10**15, 9 * 10**15), (8_999_999_999_999_999, 9 * 10**15), (123_456_789_012_345, 987_654_321_098_765)]
    frame = spark.createDataFrame([*pairs, (5, 0)], "a bigint, b bigint")
    found = [r.p for r in frame.select(divergence._p(F.col("a"), F.col("b")).alias("p")).collect()]
    assert found == [1 + 10**9 * a // b for a, b in pairs] + [None]

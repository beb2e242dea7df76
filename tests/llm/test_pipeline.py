"""The pipeline's stages on planted documents, each against what it may change."""

import random

import corpus_pipeline
import numpy as np
from latentspark.llm import quality, simhash, words
from latentspark.llm.common import table
from pyspark.sql import functions as F


def test_stages(spark, tmp_path):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    prose = lambda n: " ".join(word() for _ in range(n))
    item, passage = prose(30), prose(60)
    texts = {i: prose(80) for i in range(60)}
    texts |= {i: " ".join(w + "***" for w in prose(60).split()) for i in range(60, 100)}
    texts[1] = texts[0]
    texts[2] += f"\n{passage}"
    texts[3] += f"\n{passage}"
    texts[4] += f" {item} end"
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 60), 0) for i in texts], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(7, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = set(range(60)) - {1, 4}
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in result if r.n_tokens} == kept
    # The copy lost its only line to the first one and stays as an empty document.
    assert {r.doc_id for r in result if not r.n_tokens} == {1}
    deduped = {r.doc_id: r.text for r in corpus_pipeline.without_repeated_lines(spark, docs, str(tmp_path)).collect()}
    assert passage in deduped[2] and passage not in deduped[3]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_one_of_each_group(spark, tmp_path):
    """Copies whose fingerprints are linked by 2 bits or fewer are one group, whatever the columns are called."""
    rng, rows = random.Random(9), []
    for i in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(60, 300))]
        for k in range(3):
            rows.append((3 * i + k, " ".join(words)))
            words = words + ["more"] * rng.randint(0, 2)
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "The same"), (1004, "the  same"), (1005, "x " * 50_000), (1006, "x " * 49_000)]
    prints = {i: simhash._fingerprint((t or "").encode(), 3, 42) % (1 << 64) for i, t in rows}
    group = {i: i for i in prints}
    for i in prints:
        for j in prints:
            if j < i and (prints[i] ^ prints[j]).bit_count() <= 2:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = {k: new if v == old else v for k, v in group.items()}
    wanted = {i for i, g in group.items() if i == g}
    assert 70 < len(wanted) < 180
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {"row": F.col("doc_id") * 2, "fp": F.lit("x"), "group": F.lit(None).cast("int"), "component_id": F.lit(1)})
    kept = corpus_pipeline.one_of_each_group(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert {(r.doc_id, r.row, r.fp) for r in kept.collect()} == {(i, 2 * i, "x") for i in wanted}


def test_odd_rows_through_all_stages(spark, tmp_path):
    rows = [(1, None), (1, None), (2, ""), (None, "same text here"), (None, "same text here"), (3, "long text " * 60_000), (4, "a\n\n\nb"),
            (5, "some clean words of a usual kind"), (6, "***")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").select(
        "doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"),
        F.lit(1).alias("score"), F.lit(2).alias("own"), F.lit(3).alias("h"), F.lit(4).alias("gone"), F.lit(5).alias("lines_removed"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(5, 1, 0), (6, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(None, None), (1, ""), (2, "no one holds these five words")], "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and {r.gone for r in out.collect()} == {4}
    found = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert 5 in found and 3 in found


def test_repeated_and_null_ids(spark, tmp_path):
    """One row of each group stays, whatever its id; only rows that leak go."""
    rng = random.Random(10)
    a, b, c, d, item = (" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(5))
    docs = spark.createDataFrame(
        [(7, a), (7, a), (3, a), (7, b), (7, b), (None, c), (None, c), (None, d), (3, f"{b} {c}")], "doc_id bigint, text string")
    kept = corpus_pipeline.one_of_each_group(spark, docs, str(tmp_path)).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(3, a), (7, b), (None, c), (None, d), (3, f"{b} {c}")], key=str)
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(7, f"{a} {item}"), (7, b), (7, b), (None, item), (None, c), (8, None), (9, "")]
    clean = corpus_pipeline.without_benchmark(
        spark, spark.createDataFrame(rows, "doc_id bigint, text string"), str(tmp_path)).collect()
    assert sorted(map(tuple, clean), key=str) == sorted([(7, b), (7, b), (None, c), (8, None), (9, "")], key=str)


def test_driver_holds_neither_sample_nor_item_texts(spark, tmp_path, monkeypatch):
    """The classifier is fitted and items are hashed in tasks; the weights are those of a fit over the sample, in its order."""
    rng = random.Random(11)
    texts = {i: " ".join(f"{'good' if i % 2 else 'bad'}{int(rng.random() ** 3 * 4000)}" for _ in range(1500)) for i in range(120)}
    docs = spark.createDataFrame([*texts.items()], "doc_id bigint, text string")
    spark.createDataFrame([(i, i % 2, 0) for i in texts], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, texts[1][:300]), (2, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    labels, rows = table(spark, str(tmp_path), "labels"), []
    order = quality.labelled_sample(docs, labels, "quality", F.lit(True), 6000, 32_768).orderBy("at").collect()
    for r in order:
        data = np.frombuffer(r.text.encode(), np.uint8)
        _, keys, count = quality.features(data, np.array([0, len(data)]), quality.BITS)
        found, counts = np.unique(keys, return_counts=True)
        rows.append((found, (counts / count[0]).astype(np.float32).astype(float), r.y))
    wanted, frame, taken = quality.follow_leader(rows, quality.BITS), type(docs), []
    monkeypatch.setattr(frame, "toArrow", lambda self, to=frame.toArrow: taken.append(to(self)) or taken[-1])
    monkeypatch.setattr(words, "_tables", {})
    model = quality.train(docs, labels, F.lit(True))
    assert len(order) == 120 and np.count_nonzero(wanted.weights)
    assert (model.weights == wanted.weights).all() and model.bias == wanted.bias
    # A number and a bucket for each weight other than zero, and not for each text's features.
    assert sum(t.nbytes for t in taken) < 100 + 8 * np.count_nonzero(wanted.weights) < sum(8 * len(at) for at, *_ in rows) / 4
    assert {r.doc_id for r in corpus_pipeline.without_benchmark(spark, docs, str(tmp_path)).collect()} == {*texts} - {1}
    assert not words._tables and all("text" not in t.column_names for t in taken)
    empty = quality.train(docs, labels, F.lit(False))
    assert not empty.weights.any() and empty.bias == 0

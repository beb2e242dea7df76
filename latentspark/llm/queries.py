"""The ``opN_<name>`` queries and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latentspark.llm import (alignment, byte_bpe, chat, decontaminate, divergence, exact_dedup, licenses, line_dedup, quality,
                             simhash, token_files, toxicity, url_filter)
from latentspark.llm.common import fold_is, table
from latentspark.session import working_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
THRESHOLD = 0.3


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _judged(documents: DataFrame, scored, modulus: int, value: int) -> DataFrame:
    return documents.select(
        "doc_id", fold_is(F.col("doc_id"), modulus, value).alias("held_out"), scored.alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


@query
def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document; named is the one of best coverage, then most words."""
    found = table(spark, sf_dir, "documents").select("doc_id", licenses.matches(F.col("text")).alias("matches"))
    best = F.get(F.sort_array(F.transform("matches", lambda m: F.struct(
        (-m["coverage"]).alias("c"), (m["first_word"] - m["end_word"]).alias("length"), m["first_word"].alias("at"), m["license"].alias("license")))), F.lit(0))
    return found.select("doc_id", best["license"].alias("license"), (-best["c"]).alias("coverage"),
                        F.size("matches").alias("n_matches"), "matches")


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded; null counts as empty."""
    import public_tokenizers

    ranks = spark.sparkContext.broadcast(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    return byte_bpe_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def byte_bpe_digests(documents: DataFrame, ranks, pattern: str) -> DataFrame:
    return documents.select("doc_id", byte_bpe.digests(F.col("text"), ranks, pattern).alias("found")).select("doc_id", "found.*")


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text; rows with crc32(doc_id) mod 4 = 2 are held out."""
    documents = table(spark, sf_dir, "documents")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"), ~fold_is(F.col("doc_id"), 4, 2))
    return _judged(documents, toxicity.score(F.col("text"), spark.sparkContext.broadcast(tuple(model))), 4, 2)


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written to files and read back from them."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    folder = f"{working_dir(spark)}/token-files-{uuid.uuid4().hex}"
    manifest = token_files.write(table(spark, sf_dir, "documents"), folder, tokenizer, 1, 49_408)
    return token_files.read(manifest, folder)


@query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents leak."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text; rows with crc32(doc_id) mod 5 = 0 are held out."""
    documents = table(spark, sf_dir, "documents")
    model = quality.train(documents, table(spark, sf_dir, "labels"), ~fold_is(F.col("doc_id"), 5, 0))
    return _judged(documents, quality.score(F.col("text"), spark.sparkContext.broadcast(tuple(model))), 5, 0)


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every document after repeated runs of lines went."""
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "lines_removed", F.sha2("text", 256).alias("text_sha256"))


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.components(simhash.fingerprints(table(spark, sf_dir, "documents")))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL; listed are canonical URLs that pages give under several addresses."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, url_filter.RULES, url_filter.several_addresses(pages)).select(
        "page_id", "host", "path", "rule", "verdict")


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of a language, and the terms that mark a source."""
    return divergence.audit(table(spark, sf_dir, "documents"))


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' ids in every document."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(
            public_tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        tokenizers = alignment.Tokenizers(a.read(), b.read())
    return alignment.link_statistics(table(spark, sf_dir, "documents"), tokenizers)


@query
def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, read back from text, tokens and mask."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    saying = "</s>[INST] ok [/INST]"
    odd = spark.createDataFrame([(-7, 0, "user", saying), (-7, 1, "assistant", saying)], "conv_id bigint, turn bigint, role string, text string")
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_conversations(given.union(odd), tokenizer))


ORACLES |= {"op11_source_divergence": divergence.SQL, "op13_chat_format": chat.SQL, "op3_line_dedup": line_dedup.SQL, "op8_exact_dedup": exact_dedup.SQL, "op10_url_filter": url_filter.SQL}

"""A training corpus from raw documents: filter, dedup, decontaminate, tokenize.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept; its result is
written as Parquet and read again for the next one. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latentspark.llm import byte_bpe, decontaminate, line_dedup, quality, simhash
from latentspark.llm.common import fold_is, fresh, table
from latentspark.llm.queries import THRESHOLD, byte_bpe_digests
from latentspark.session import cut_lineage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, taught on the training fold of ``labels``, does not reject.

    Null and empty texts are judged by the bias alone; rows of any id, repeated ones too, are judged by their text.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~fold_is(F.col("doc_id"), 5, 0))
    return docs.where(quality.score(F.col("text"), spark.sparkContext.broadcast(tuple(model))) >= THRESHOLD)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of runs of lines; ``n_chars`` follows the text.

    Null and empty texts stay as they are, a document that loses all lines stays, empty. Null ids come first, so
    their lines stay; rows that repeat id and text lose the same lines.
    """
    removed, = fresh(docs, "removed")
    # The operator sets a column of its own name, which a document may have as well.
    own = fresh(docs, "held") if "lines_removed" in docs.columns else []
    given = docs.withColumnRenamed("lines_removed", own[0]) if own else docs
    kept = line_dedup.drop_repeated_lines(given).withColumnRenamed("lines_removed", removed)
    kept = kept.withColumnRenamed(own[0], "lines_removed") if own else kept
    return kept.withColumn("n_chars", F.when(
        F.col(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHash fingerprints are linked, the one with the smallest id.

    Three-word shingles and 2 bits, as ``op9_simhash``. Of rows that share that id one stays, the first by hash of
    the text, then place. Null ids come last. Empty and null texts are one group; rows of any length count whole.
    """
    row, fp, group = fresh(docs, "row", "fp", "group")
    rows = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()).withColumn(fp, simhash.fingerprint(F.col("text"))))
    prints = rows.select(F.col(row).alias("doc_id"), F.col(fp).alias("fp"))
    linked = simhash.components(prints).select(F.col("doc_id").alias(row), F.col("component_id").alias(group))
    at = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), row)
    first = rows.join(linked, row).groupBy(group).agg(F.min(at).alias("first")).select(F.col(f"first.{row}").alias(row))
    return rows.join(first, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``; each row is judged by its own text."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every document's byte-level BPE ids."""
    import public_tokenizers

    ranks = spark.sparkContext.broadcast(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    return byte_bpe_digests(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_repeated_lines),
    ("SimHash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", token_ids),
]

# The classifier, near-duplicates and edit distances are not expressible: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Exact duplicates by deterministic block naming, with DataFrame operations only.

A text (white space runs made one space, null as empty) is cut into blocks of ``block_bytes``. The
distinct blocks are sorted and numbered; then each pair of adjacent numbers is a new item that is
sorted and numbered in turn, until a document has one number left. Equal blocks, and only those,
share a number, so equal numbers at the same level mean equal texts. A row is known by its id and the 64-bit hash
of its text: only two different texts of one id with equal hashes would be taken for each other.

A block whose 64-bit hash occurs once in the table occurs once itself, so its document equals no
other and needs no number; only the other documents' blocks are sorted.

Null ``doc_id`` counts as a value above which no group is kept unless all its ids are null. Rows that
repeat id and text each count in ``group_size`` and share their group's result. Empty texts form one
group. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latentspark.llm.common import same
from latentspark.session import cut_lineage

BLOCK_BYTES = 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _blocks(binary: Column, block_bytes: int, of) -> Column:
    last = F.greatest(F.ceil(F.octet_length(binary) / block_bytes), F.lit(1)).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: of(F.substr(binary, i * block_bytes + 1, F.lit(block_bytes))))


def numbered(items: DataFrame) -> DataFrame:
    """Distinct rows with a ``name``: partition and place in its sorted order; written so that names stay fixed.

    The partitions that ``distinct`` leaves are sorted as they are: a range partitioning would send samples of
    whole blocks to the driver.
    """
    kinds = items.distinct()
    return cut_lineage(kinds.sortWithinPartitions(*kinds.columns).withColumn("name", F.monotonically_increasing_id()))


def exact_groups(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    whole = documents.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("text"))
    whole = whole.select("doc_id", "text", F.xxhash64("text").alias("h"))
    base = cut_lineage(whole.select(
        "doc_id", "h", F.sha2("text", 256).alias("text_sha256"),
        _blocks(F.col("text").cast("binary"), block_bytes, F.xxhash64).alias("hashes")))
    rows = base.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("copies"), F.max(F.size("hashes")).alias("blocks"))

    hashed = base.select("doc_id", "h", F.posexplode("hashes").alias("idx", "block")).distinct()
    alone = (hashed.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id"), F.min("h").alias("h"))
             .where("n = 1").select("doc_id", "h").distinct())
    live = cut_lineage(rows.join(alone, same(rows, alone, "doc_id", "h"), "left_anti"))

    texts = whole.join(live.hint("shuffle_hash"), same(whole, live, "doc_id", "h"), "left_semi")
    blocks = cut_lineage(texts.select("doc_id", "h", F.posexplode(
        _blocks(F.col("text").cast("binary"), block_bytes, lambda b: b)).alias("idx", "block")))
    current = blocks.join(numbered(blocks.select("block")), "block").select("doc_id", "h", "idx", "name").distinct()
    current = current.join(live, same(current, live, "doc_id", "h")).select(
        current.doc_id, current.h, "copies", "blocks", "idx", "name")
    most = live.agg(F.max("blocks")).first()[0] or 1
    finished = []
    for level in range(math.ceil(math.log2(most)) + 1):
        current = cut_lineage(current)
        finished.append(current.where("blocks = 1").select("doc_id", "h", "copies", F.lit(level).alias("level"), "name"))
        pairs = current.where("blocks > 1").groupBy(
            "doc_id", "h", "copies", "blocks", F.expr("idx div 2").alias("idx")).agg(
            F.max(F.when(F.col("idx") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("idx") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
        if 1 << level >= most:
            break
        pairs = cut_lineage(pairs)
        current = pairs.join(numbered(pairs.select("a", "b")), ["a", "b"]).select(
            "doc_id", "h", "copies", F.ceil(F.col("blocks") / 2).cast("int").alias("blocks"), "idx", "name")
    identity = finished[0]
    for more in finished[1:]:
        identity = identity.union(more)
    groups = identity.groupBy("level", "name").agg(
        F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    found = identity.join(groups, ["level", "name"]).select("doc_id", "h", "keep_id", "group_size")
    unique = rows.join(alone, same(rows, alone, "doc_id", "h"), "left_semi").select(
        "doc_id", "h", F.col("doc_id").alias("keep_id"), F.col("copies").alias("group_size"))
    found = found.union(unique)
    return base.join(found, same(base, found, "doc_id", "h")).select(
        base.doc_id, "keep_id", "group_size", base.doc_id.eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)"""

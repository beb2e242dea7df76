"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_is(doc_id: Column, modulus: int, value: int) -> Column:
    """Whether crc32 of the id as text leaves ``value``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == value, F.lit(False))


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of the named columns of two frames."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, train: Column, rows: int, max_bytes: int) -> DataFrame:
    """At most ``rows`` labelled documents of at most ``max_bytes`` each as ``text, y, at``, chosen by hash of the id.

    So the sample has ``rows * max_bytes`` bytes at most. Longer texts are left out of it (scoring has no such
    bound). Of documents that share an id one is taken, the first by hash of the text. Several labels of one id
    count by their mean. Null ids, texts and labels teach nothing.
    """
    wanted = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & train)
              .groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    texts = documents.select("doc_id", "text").where(F.col("text").isNotNull() & (F.octet_length("text") <= max_bytes))
    # The right side has at most `rows` rows of two numbers.
    found = texts.join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "y").agg(
        F.min(F.struct(F.xxhash64("text").alias("at"), "text")).alias("x"))
    return found.select("x.text", "y", F.xxhash64("doc_id", "x.at").alias("at"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores as keep it apart from the columns of ``df``, whatever their case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out

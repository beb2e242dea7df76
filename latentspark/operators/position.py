"""Row order as data: dense positions, chunk layout, ordered concatenation."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latentspark.functions import names
from latentspark.functions.scalars import numbered_name, quotient
from latentspark.session import cut_lineage

# Rows sorted by one task, and number of ranges at most.
ROWS_PER_RANGE = 250_000
MAX_RANGES = 16_384
_ROW_BITS = 33  # monotonically_increasing_id counts rows in its low 33 bits


def with_position(
    df: DataFrame,
    key: str,
    ties: Sequence[str] = (),
    *,
    position: str = "position",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add the dense 0-based rank of ``(key, *ties)``; the ties must make the
    order total. NULL keys come first.

    A set that one task can sort gets a plain window. A larger one is range
    partitioned by key and ties together, so that one frequent key is spread too,
    and sorted inside the ranges; a row's rank is its place in its range plus the
    rows of the ranges before. The ranges come from a sample, so the ranked table
    is written once before the rows of each range are counted.
    """
    keys = [key, *ties]
    ranges = min(MAX_RANGES, math.ceil(df.count() / rows_per_range))
    if ranges <= 1:
        rank = F.row_number().over(Window.orderBy(*keys))
        return df.withColumn(position, rank.cast("bigint") - 1)
    ranked = cut_lineage(
        df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
        .withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", _ROW_BITS)
    counts = sorted(ranked.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    starts, before = [], 0
    for p, n in counts:
        starts.append((p, before))
        before += n
    shift = F.broadcast(df.sparkSession.createDataFrame(starts, "_part bigint, _start bigint"))
    place = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + F.col("_start")
    return (
        ranked.withColumn("_part", part).join(shift, "_part")
        .withColumn(position, place).drop("_part", "_id", "_start")
    )


def ensure_position(df: DataFrame, key: str | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """``df`` itself if it has positions, else ranked by ``key``."""
    if "position" in df.columns:
        return df
    if key is None:
        raise ValueError("no position column: name the key that orders the rows")
    return with_position(df, key, ties)


def stack_location(df: DataFrame, box: int | Column, chunk: int) -> DataFrame:
    """Set ``location`` to the 1-based index and file of each row's image.

    Chunk 0 keeps one stack; otherwise file ``n`` holds the positions
    ``n * chunk .. (n + 1) * chunk - 1``.
    """
    box = F.lit(box) if isinstance(box, int) else box
    position = F.col("position")
    if chunk == 0:
        index, file = position + 1, numbered_name(names.STACK_FILE, box)
    else:
        index = F.pmod(position, F.lit(chunk)) + 1
        file = numbered_name(names.STACK_CHUNK_FILE, box, quotient(position, F.lit(chunk)))
    return df.withColumn("location", F.struct(index.cast("int").alias("index"), file.alias("file")))


def chunk_sizes(df: DataFrame, chunk: int) -> DataFrame:
    """Images per chunk; an empty remainder has no row."""
    number = F.lit(0).cast("bigint") if chunk == 0 else quotient(F.col("position"), F.lit(chunk))
    return df.groupBy(number.alias("chunk")).agg(F.count("*").alias("images"))


def with_volume_id(df: DataFrame, file: str = "file") -> DataFrame:
    """Volume ordinal in file-name order."""
    return with_position(df, file, position="vol_id").withColumn("vol_id", F.col("vol_id").cast("int"))


def first_volumes(df: DataFrame, n: int) -> DataFrame:
    """Volumes ``0 .. n-1`` in order."""
    return df.filter((F.col("vol_id") >= 0) & (F.col("vol_id") < n)).orderBy("vol_id")


def concat_chunks(chunks: Sequence[DataFrame]) -> DataFrame:
    """One ordered set from chunks that each number their rows from 0."""
    sizes = [chunk.count() for chunk in chunks]
    shifted = [
        chunk.withColumn("position", F.col("position") + F.lit(sum(sizes[:i])).cast("bigint"))
        for i, chunk in enumerate(chunks)
    ]
    return reduce(DataFrame.unionByName, shifted)


def zip_by_position(items: DataFrame, side: DataFrame) -> DataFrame:
    """Walk two ordered sets in step: rows with equal position, ending with the shorter one."""
    return items.join(side, "position", "inner")

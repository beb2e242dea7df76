r"""Repeated runs of lines, found by winnowing over line hashes, with DataFrame operations only.

Lines are what ``\n`` separates; their ends are trimmed of spaces and blank lines are passed over. A run of lines
counts if it has ``min_lines`` lines or ``min_words`` words. A window is a run that counts and has at most
``min_lines`` lines. Each window selects its smallest line hash (the last of equal ones) as its fingerprint, so
any two equal windows are sure to share one. Documents are joined on fingerprints that occur at several places;
around those the match is extended both ways, as far as windows reach, and windows are compared by SHA-256 (128
bits of it) over their lines. Of equal windows the first, by document id, then text hash, then line, stays; the lines of every
later one are deleted, with the blank lines between them.

A run of more lines that counts is the union of its windows, and each of them is repeated where the run is. So
what is deleted are the maximal repeated runs that count, found without a row for any pair of places.

Null text stays null, empty text empty; a text whose lines all repeat becomes empty. Null ids come
first. Rows that repeat id and text count as one document and share its result. An empty table gives an
empty result. Other columns pass through, whatever their names; only ``lines_removed`` is set anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latentspark.llm.common import fresh
from latentspark.session import cut_lineage

MIN_LINES = 3
MIN_WORDS = 50


def _lines(text: Column) -> Column:
    """Non-blank lines: place, hash, words, digest."""
    parts = F.transform(F.split(text, "\n", -1), lambda line, i: F.struct(i.alias("i"), F.trim(line).alias("line")))
    return F.transform(F.filter(parts, lambda x: x["line"] != ""), lambda x: F.struct(
        x["i"].alias("i"), F.xxhash64(x["line"]).alias("h"),
        (F.length(x["line"]) - F.length(F.replace(x["line"], F.lit(" "))) + 1).alias("words"),
        F.unhex(F.sha2(x["line"], 256)).alias("digest")))


def _windows(lines: Column, min_lines: int, min_words: int) -> Column:
    """For every line the windows that start there: lines ``s..e`` and the fingerprint's line ``p``."""
    def at(i: Column, k: int, field: str) -> Column:
        return F.get(lines, i + k)[field]

    def starting(i: Column) -> Column:
        words, place, least, found = at(i, 0, "words"), F.lit(0), at(i, 0, "h"), []
        for k in range(min_lines):
            if k:
                words = words + at(i, k, "words")
                place = F.when(at(i, k, "h") <= least, F.lit(k)).otherwise(place)
                least = F.least(least, at(i, k, "h"))
            counts = words.isNotNull() if k == min_lines - 1 else words >= min_words
            found.append(F.when(counts, F.struct(i.alias("s"), (i + k).alias("e"), (i + place).alias("p"))))
        return F.filter(F.array(*found), lambda w: w.isNotNull())

    count = F.size(lines)
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), starting)).otherwise(
        F.array().cast("array<array<struct<s:int,e:int,p:int>>>"))


def _fingerprints(docs: DataFrame, min_lines: int, min_words: int) -> DataFrame:
    """A row per selected line: ``doc_id, h, fp`` and the windows that selected it, by name."""
    lines = docs.select("doc_id", "h", _lines(F.col("text")).alias("lines"))
    found = lines.select("doc_id", "h", "lines", _windows(F.col("lines"), min_lines, min_words).alias("windows"))

    def selected(p: Column) -> Column:
        # Windows that hold line p start at most min_lines - 1 lines before it.
        first = F.greatest(p - min_lines + 1, F.lit(0))
        near = F.filter(F.flatten(F.slice(F.col("windows"), first + 1, p - first + 1)), lambda w: w["p"] == p)
        return F.struct(F.get(F.col("lines"), p)["h"].alias("fp"), F.transform(near, lambda w: F.struct(
            F.get(F.col("lines"), w["s"])["i"].alias("s"), F.get(F.col("lines"), w["e"])["i"].alias("e"),
            F.substring(F.unhex(F.sha2(F.aggregate(
                F.slice(F.col("lines"), w["s"] + 1, w["e"] - w["s"] + 1), F.lit("").cast("binary"),
                lambda joined, x: F.concat(joined, x["digest"])), 256)), 1, 16).alias("name"))).alias("windows"))

    places = F.array_distinct(F.transform(F.flatten("windows"), lambda w: w["p"]))
    return found.select("doc_id", "h", F.explode(F.transform(places, selected)).alias("x")).select("doc_id", "h", "x.fp", "x.windows")


def repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, h, gone``: sorted places of the lines to delete; ``docs`` has ``doc_id, h, text``."""
    prints = cut_lineage(_fingerprints(docs, min_lines, min_words))
    shared = prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp")
    windows = prints.join(shared, "fp", "left_semi").select("doc_id", "h", F.explode("windows").alias("w")).select("doc_id", "h", "w.*")
    first = windows.groupBy("name").agg(
        F.min(F.struct("doc_id", "h", "s")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = windows.join(first, "name").where(~F.struct("doc_id", "h", "s").eqNullSafe(F.col("first")))
    return later.select("doc_id", "h", F.explode(F.sequence("s", "e")).alias("i")).groupBy("doc_id", "h").agg(
        F.sort_array(F.collect_set("i")).alias("gone"))


def drop_repeated_lines(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``documents`` with the repeated lines taken out of ``text_col``, and ``lines_removed``."""
    passed = [c for c in documents.columns if c != "lines_removed"]
    documents = documents.select(*[F.col(f"`{c}`") for c in passed])
    own, other, h, gone = fresh(documents, "own", "other", "h", "gone")
    slim = documents.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = repeated_lines(slim.withColumn("h", F.xxhash64("text")), min_lines, min_words).select(
        F.col("doc_id").alias(other), F.col("h").alias(h), F.col("gone").alias(gone))
    joined = documents.withColumn(own, F.xxhash64(f"`{text_col}`")).join(
        found, F.col(f"`{id_col}`").eqNullSafe(F.col(other)) & (F.col(own) == F.col(h)), "left")
    lines, deleted = F.split(F.col(f"`{text_col}`"), "\n", -1), F.col(gone)
    count = F.size(deleted)
    # What lies between two deleted lines, before the first and after the last.
    kept = F.transform(F.sequence(F.lit(0), count), lambda k: F.slice(
        lines, F.when(k == 0, 0).otherwise(F.get(deleted, k - 1) + 1) + 1,
        F.when(k == count, F.size(lines)).otherwise(F.get(deleted, k))
        - F.when(k == 0, 0).otherwise(F.get(deleted, k - 1) + 1)))
    text = F.when(deleted.isNull(), F.col(f"`{text_col}`")).otherwise(F.array_join(F.flatten(kept), "\n"))
    columns = [text.alias(text_col) if c == text_col else F.col(f"`{c}`") for c in passed]
    return joined.select(*columns, F.coalesce(count, F.lit(0)).alias("lines_removed"))


# Maximal runs: places of equal lines in step with each other, the later ones of which go.
SQL = r"""
WITH l AS (
    SELECT doc_id, i - 1 AS i, trim(line) AS line, length(trim(line)) - length(replace(trim(line), ' ', '')) + 1 AS words,
           row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) x
    WHERE trim(line) <> ''),
pair AS (
    SELECT a.doc_id AS first_id, b.doc_id, b.k - a.k AS step, b.k, b.words
    FROM l a JOIN l b ON a.line = b.line AND (a.doc_id < b.doc_id OR (a.doc_id = b.doc_id AND a.k < b.k))),
island AS (
    SELECT *, k - row_number() OVER (PARTITION BY first_id, doc_id, step ORDER BY k) AS island FROM pair),
run AS (
    SELECT doc_id, min(k) AS s, max(k) AS e FROM island GROUP BY first_id, doc_id, step, island
    HAVING count(*) >= 3 OR sum(words) >= 50),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS i
    FROM (SELECT DISTINCT r.doc_id, s.i AS s, e.i AS e FROM run r
          JOIN l s ON s.doc_id = r.doc_id AND s.k = r.s JOIN l e ON e.doc_id = r.doc_id AND e.k = r.e) x),
kept AS (
    SELECT x.doc_id, string_agg(x.line, chr(10) ORDER BY x.i) AS text
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents) x
    ANTI JOIN gone ON gone.doc_id = x.doc_id AND gone.i = x.i
    GROUP BY x.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS lines_removed,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(k.text, '')) END AS text_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, CAST(count(*) AS INT) AS n FROM gone GROUP BY doc_id) n ON n.doc_id = d.doc_id"""

"""URL filter: rules by host and path, then a list of canonical URLs, with DataFrame operations only.

A rule ``(action, host, path)`` fits its host and all subdomains, where the URL's path starts with the
rule's; the longest fitting rule decides (of equally long ones a block, then the first by name).
Without a fitting rule a URL is blocked if its canonical form is listed: a split-block Bloom filter
(256-bit blocks, one bit in each of eight words) passes possible hits on to an exact hash join.

Null URLs, and those without ``://``, have empty host and path and no rule; they are allowed unless
the empty canonical form is listed. Repeated rows are judged alike, an empty table or list is valid.
Other columns pass through, whatever their names; only the output names are taken.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latentspark.llm.common import fresh

BITS_PER_KEY = 12
BROADCAST_BYTES = 32 << 20
_BLOCK_BYTES = 96        # of one filter row, generously


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.``, path without a trailing slash; scheme, query and fragment do not count."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, "/+$", ""))


def fitting_rule(host: Column, path: Column, rules) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, or null."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1] + r[2]))
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(h + p).alias("rule"), F.lit(action).alias("verdict"))) for action, h, p in ordered]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def _bits(key: Column, blocks: int) -> list[Column]:
    """Block number and the eight one-bit words of a key."""
    second = F.xxhash64(key, F.lit(1))
    # Five bits of the second hash pick the bit of each 32-bit word.
    return [F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block")] + [
        F.call_function("shiftleft", F.lit(1), F.shiftright(second, 5 * i).bitwiseAND(31).cast("int")).alias(f"w{i}")
        for i in range(8)]


def bloom_filter(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    words = listed.select(*_bits(F.col(key), blocks))
    return words.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)])


def several_addresses(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """``canonical`` URLs that pages give in more than one way: by another scheme, query, fragment or ``www.``.

    The list that the query uses: the same page under several addresses. It takes other rows to tell, so a URL
    alone does not say whether it is listed. URLs without a host are not listed.
    """
    url = F.col(f"`{url_col}`")
    named = pages.select(canonical(host_of(url), path_of(url)).alias("canonical"), url.alias("url")).where("canonical <> ''")
    return named.groupBy("canonical").agg(F.min("url").alias("first"), F.max("url").alias("last")).where("first <> last").select("canonical")


def judge(pages: DataFrame, rules, listed: DataFrame, url_col: str = "url") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``; ``listed`` has one column, ``canonical``."""
    listed = listed.select("canonical").where(F.col("canonical").isNotNull()).distinct()
    count = listed.count()
    blocks = max(1, -(-count * BITS_PER_KEY // 256))
    host, path = host_of(F.col(f"`{url_col}`")), path_of(F.col(f"`{url_col}`"))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    key, bloom, ruled, url, maybe, hit, at = fresh(pages.select(*[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path")),
                                                   "key", "bloom", "ruled", "link", "maybe", "hit", "at")
    seen = pages.select(*[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"))
    seen = seen.withColumn(ruled, fitting_rule(F.col("host"), F.col("path"), rules)).withColumn(
        url, canonical(F.col("host"), F.col("path")))
    keyed = seen.withColumn(key, F.struct(*_bits(F.col(url), blocks)))
    words = bloom_filter(listed, "canonical", blocks).select(F.col("block").alias(at), F.struct(*[f"w{i}" for i in range(8)]).alias(bloom))
    if blocks * _BLOCK_BYTES <= BROADCAST_BYTES:
        words = F.broadcast(words)
    tested = keyed.join(words, F.col(f"{key}.block") == F.col(at), "left")
    possible = F.lit(True)
    for i in range(8):
        possible = possible & (F.col(f"{bloom}.w{i}").bitwiseAND(F.col(f"{key}.w{i}")) != 0)
    # A rule decides before the list, so only URLs without one need the join.
    tested = tested.withColumn(maybe, F.coalesce(possible, F.lit(False)) & F.col(ruled).isNull())
    hits = listed.select(F.col("canonical").alias(hit))
    found = tested.where(F.col(maybe)).join(hits, F.col(url) == F.col(hit), "left")
    rest = tested.where(~F.col(maybe)).withColumn(hit, F.lit(None).cast("string"))
    verdict = F.coalesce(F.col(f"{ruled}.verdict"), F.when(F.col(hit).isNotNull(), "block").otherwise("allow"))
    columns = [*[F.col(f"`{c}`") for c in kept], "host", "path", F.col(f"{ruled}.rule").alias("rule"), verdict.alias("verdict")]
    return found.select(*columns).union(rest.select(*columns))


RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))

SQL = rf"""
WITH p AS (
    SELECT page_id, url,
           translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                     '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
           regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
c AS (SELECT *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') AS canonical,
      CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
           WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
           WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
           WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
           WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM p),
listed AS (SELECT canonical FROM c WHERE canonical <> '' GROUP BY canonical HAVING count(DISTINCT url) > 1)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict FROM c"""

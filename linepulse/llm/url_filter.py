"""URL filters: listed URLs by a blocked Bloom filter and an exact join, and rules by host and path.

The filter is a table of blocks of 256 bits, each four longs; a URL sets eight bits of one block.
Pages look up their block, which is a join on a small table, and only what the filter lets pass
goes on to the exact join with the list, which removes what passed by chance. The filter is
broadcast up to a checked size. DataFrame functions only.

A rule fits its host and all subdomains, if the path starts with the rule's; the longest wins, and
of equal ones the first by code point. Where no rule fits, listed URLs are blocked and others
allowed. A null URL, or one without ``://``, has an empty host and path, fits no rule, and isn't
listed. Repeated rows are judged each; other columns of the pages don't come along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.scratch import stage

#: Verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
URLS_A_BLOCK = 16
BROADCAST_BYTES = 64 << 20
_BLOCK_BYTES = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = ("w0", "w1", "w2", "w3")


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One spelling of a URL: no scheme, ``www.``, usual port, slash at the end, fragment or tracking."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)\z", ""), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+\z", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(r"^(utm_[^=]*|ref)(=|\z)"))
    rest = F.array_join(F.array_sort(kept), "&")
    return F.when(host != "", F.concat(host, path, F.when(rest != "", F.concat(F.lit("?"), rest)).otherwise("")))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """The rule that fits best as ``(rule, verdict)``; null where none does."""
    best = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, of, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == of) | F.endswith(host, F.lit("." + of))) & F.startswith(path, F.lit(start))
        best = F.coalesce(best, F.when(fits, F.struct(F.lit(of + start).alias("rule"), F.lit(verdict).alias("verdict"))))
    return best


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column, word: int) -> Column:
    """Two bits of a word, from a second hash."""
    h = F.xxhash64(key, F.lit("bits"))
    one = [F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in (2 * word, 2 * word + 1)]
    return F.call_function("shiftleft", F.lit(1).cast("long"), one[0]).bitwiseOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), one[1])
    )


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """``(block, w0, w1, w2, w3)`` of ``keys(key)``; blocks without a key have no row."""
    key = F.col("key")
    bits = keys.select(_block(key, blocks).alias("block"), *[_bits(key, i).alias(w) for i, w in enumerate(_WORDS)])
    return bits.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in _WORDS])


def listed(pages: DataFrame, urls: DataFrame) -> DataFrame:
    """``pages(key, …)`` with ``listed``: whether ``key`` is in ``urls(key)``."""
    known = stage(urls.where("key IS NOT NULL").distinct(), "listed")
    blocks = max(1, -(-known.count() // URLS_A_BLOCK))
    table = bloom(known, blocks)
    if blocks * _BLOCK_BYTES <= BROADCAST_BYTES:
        table = F.broadcast(table)
    key = F.col("key")
    passed = F.lit(True)
    for i, w in enumerate(_WORDS):
        passed = passed & (F.col(w).bitwiseAND(_bits(key, i)) == _bits(key, i))
    seen = pages.withColumn("block", _block(key, blocks)).join(table, "block", "left")
    seen = seen.withColumn("maybe", F.coalesce(passed, F.lit(False))).drop("block", *_WORDS)
    # Two branches, so that what the filter holds back is never dealt out by a key.
    hits = seen.where("maybe").join(known.withColumn("listed", F.lit(True)), "key", "left")
    hits = hits.withColumn("listed", F.coalesce("listed", F.lit(False)))
    rest = seen.where("NOT maybe").withColumn("listed", F.lit(False))
    return hits.unionByName(rest).drop("maybe")


def judge(pages: DataFrame, urls: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict, listed)`` of ``pages(page_id, url)`` against ``urls(url)``."""
    url = F.col("url")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("key"))
    found = listed(rows, urls.select(canonical(url).alias("key")))
    found = found.withColumn("of", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("of.verdict"), F.when(F.col("listed"), F.lit("block")).otherwise("allow"))
    return found.select("page_id", "host", "path", F.col("of.rule").alias("rule"), verdict.alias("verdict"), "listed")

"""The registered queries of the operators, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.llm import (
    alignment,
    ann,
    decontaminate,
    mixing,
    periodic,
    pieces,
    quality,
    simhash,
    substring,
    token_counts,
    token_files,
    toxicity,
    url_filter,
)
from linepulse.llm.common import WORD, remainder, table
from linepulse.scratch import fresh_path

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
VERSIONS = {"words-1": None, "byte_bpe_50k-1": TOKENIZER}
#: Names of sites whose URLs make the list of the URL filter.
LISTED_SITES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def _predicted(score: F.Column, threshold: float) -> F.Column:
    return (score >= threshold).cast("int")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents inserted; then those labelled low quality deleted, and toxic ones revised to no tokens.

    Every batch is delivered twice. Documents of both labels are deleted.
    """
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    paths = {v: file and public_tokenizers.path(file) for v, file in VERSIONS.items()}
    rows = token_counts.counts(docs, paths)
    marks = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    low = rows.join(marks.where("quality = 0"), "doc_id", "left_semi")
    toxic = rows.join(marks.where("toxic = 1 AND NOT quality <=> 0"), "doc_id", "left_semi")
    rollup = token_counts.Rollup(spark, fresh_path(spark, "token-counts"))
    batches = {
        "load": token_counts.inserted(rows),
        "low-quality": token_counts.deleted(low),
        "redacted": token_counts.revised(toxic, toxic.withColumn("tokens", F.lit(0))),
    }
    for name in (*batches, *batches):
        rollup.commit(name, batches[name])
    return rollup.totals()


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeats(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), toxicity.FOLDS) == toxicity.HELD_OUT, F.lit(False))
    found = toxicity.scored(docs, table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", held_out.alias("held_out"), "score",
        _predicted(F.col("score"), toxicity.THRESHOLD).alias("predicted"), F.size("spans").alias("n_offending"),
    )


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), quality.FOLDS) == quality.HELD_OUT, F.lit(False))
    found = quality.scored(docs, table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out.alias("held_out"), "score", _predicted(F.col("score"), quality.THRESHOLD).alias("predicted"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: the URLs of all pages of the listed sites."""
    pages = table(spark, sf_dir, "pages")
    sites = "|".join(LISTED_SITES)
    urls = pages.select("url").where(url_filter.host_of(F.col("url")).rlike(rf"(^|\.)({sites})(\.|\z)"))
    return url_filter.judge(pages, urls)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES)
    return alignment.align(table(spark, sf_dir, "documents"), a, b, digest=True).withColumnRenamed("groups", "groups_sha256")


def _with_periods(docs: DataFrame) -> DataFrame:
    """The texts of ``documents`` with periods set into those whose id's crc32 is a multiple of 10.

    From word a = g % n on, the first p = 1 + floor((n - a) / (3 + g % 8)) words repeat; g is a tenth of the
    crc32, n the number of words. Words of those texts are joined by one blank.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), 0)).alias("words"))
    g, n = F.floor(F.col("h") / 10), F.size("words")
    placed = words.withColumn("a", F.when(n > 0, g % n).cast("int")).withColumn(
        "p", (F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + g % 8))).cast("int")
    )
    rest = n - F.col("a")
    often = F.ceil(rest / F.col("p")).cast("int")
    period = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), often))
    changed = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(period, F.lit(1), rest))
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.runs(_with_periods(table(spark, sf_dir, "documents")))
    size = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    best = found.withColumn("best", size)
    length, start, period = F.col("best")["length"], -F.col("best")["col2"], -F.col("best")["col3"]
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(F.lit(1000) * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_simhash, op3_mixing, op4_substring_dedup, op5_token_files,
        op6_decontamination, op7_toxicity, op8_neighbours, op9_quality, op10_url_filter,
        op11_alignment, op12_periodic_runs, op13_pieces,
    )
}

ORACLES: dict[str, str] = {
    "op3_mixing": r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(concat_ws(' ', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))) AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM docs GROUP BY source
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST) AS n FROM sources
), shared AS (
  SELECT *, (SELECT sum(source_size) FROM ordered)
            - 3 * coalesce((SELECT sum(b.source_size) FROM ordered b WHERE b.n < a.n), 0) AS rest_size,
         (SELECT sum(b.weight) FROM ordered b WHERE b.n >= a.n) AS rest_weight
  FROM ordered a
), capped AS (
  SELECT *, rest_size::DOUBLE / rest_weight::DOUBLE AS share,
         3 * source_size < (rest_size::DOUBLE / rest_weight::DOUBLE) * weight AS is_capped
  FROM shared
), targets AS (
  SELECT source, source_size,
         CASE WHEN is_capped THEN 3 * source_size::DOUBLE
              ELSE coalesce((SELECT share FROM capped WHERE NOT is_capped ORDER BY n LIMIT 1) * weight, 0.0) END AS target
  FROM capped
), rows AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target / greatest(t.source_size, 1))::BIGINT AS passes,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (passes * size + greatest(0, least(size, floor(target)::BIGINT - passes * source_size - before)))::BIGINT AS taken
FROM rows
""",
    "op10_url_filter": r"""
WITH parts AS (
  SELECT page_id, url,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*\?([^#]*)', 1) AS query
  FROM pages
), keyed AS (
  SELECT *, array_to_string(list_sort(list_filter(string_split(query, '&'),
              lambda x: x != '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref)(=|$)'))), '&') AS kept
  FROM parts
), spelled AS (
  SELECT *, CASE WHEN host != '' THEN
      regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\.', '') || regexp_replace(path, '/+$', '')
      || CASE WHEN kept != '' THEN '?' || kept ELSE '' END END AS key
  FROM keyed
), listed AS (
  SELECT DISTINCT key FROM spelled
  WHERE regexp_matches(host, '(^|\.)(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)(\.|$)')
), rules(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fitting AS (
  SELECT s.page_id, s.url, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.host || r.path) DESC, r.host || r.path) AS n
  FROM spelled s JOIN rules r
    ON (s.host = r.host OR suffix(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
)
SELECT s.page_id, s.host, s.path, f.rule,
       coalesce(f.verdict, CASE WHEN s.key IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(s.key IN (SELECT key FROM listed), false) AS listed
FROM spelled s LEFT JOIN (SELECT * FROM fitting WHERE n = 1) f ON s.page_id IS NOT DISTINCT FROM f.page_id
""",
}

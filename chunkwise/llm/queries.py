"""The operators bound to the driver tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bidi_lm, bloom_dedup, cotrain, decision_list, group_join, lsh_forest, merkle, mixing,
               piece_codec, runs, token_orc, toxicity, url_cascade)
from .common import WORD, table

#: The rules of op4: (host, path, verdict).
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"),
             ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"),
                                   table(spark, sf_dir, "labels"))


@_query
def op2_bidirectional_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bidi_lm.pseudo_likelihood(table(spark, sf_dir, "documents"))


@_query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


ORACLE["op3_mix_sources"] = r"""
WITH sizes AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
per_source AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank
  FROM sizes GROUP BY source),
weighted AS (
  SELECT *, [5, 2, 1][((rank - 1) % 3 + 1)::INT]::DOUBLE AS weight, 2 * source_size AS cap,
         1.5 * sum(source_size) OVER () AS total
  FROM per_source),
dealt AS (
  SELECT *, cap * sum(weight) OVER (ORDER BY cap / weight, rank
                                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            <= weight * (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            AS capped
  FROM weighted),
targets AS (
  SELECT source, source_size,
         CASE WHEN capped THEN cap
              ELSE least(cap, weight * ((total - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0))
                                        / sum(CASE WHEN NOT capped THEN weight END) OVER ())) END AS target
  FROM dealt),
ordered AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         sum(s.size) OVER (PARTITION BY s.source
                           ORDER BY md5('mix-1:' || coalesce(s.doc_id::VARCHAR, '')), s.doc_id, s.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS before
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (CASE WHEN source_size > 0 THEN
          floor(floor(target) / source_size) * size
          + greatest(0, least(size, floor(target) - floor(floor(target) / source_size) * source_size - before))
        ELSE 0 END)::BIGINT AS taken
FROM ordered
"""


@_query
def op4_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    cascade = url_cascade.Cascade.build(*url_cascade.repeated_addresses(pages))
    return url_cascade.judge_urls(pages, URL_RULES, cascade)


ORACLE["op4_url_cascade"] = r"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
judged AS (
  SELECT *, count(*) OVER (PARTITION BY host || path) AS n,
         CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1')
                THEN 'example.org/en/1'
              WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/')
                THEN 'example.org/es/'
              WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
              WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
              WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM split)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN host <> '' AND n > 1 THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""


@_query
def op5_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


@_query
def op6_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_orc.tokenize_to_orc(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op7_cotrain_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op8_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digests(piece_codec.encode_decode(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")))


@_query
def op9_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_join.near_components(table(spark, sf_dir, "documents"))


@_query
def op10_bloom_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_dedup.exact_groups(table(spark, sf_dir, "documents"))


# lower() changes letters beyond A-Z, so the text is normalised with translate()
ORACLE["op10_bloom_dedup"] = """
WITH keyed AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents),
grouped AS (
  SELECT *, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC) AS place
  FROM keyed)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM grouped
"""


def plant_repeats(docs: DataFrame) -> DataFrame:
    """op11's documents: with h the CRC-32 of doc_id's digits and g = h / 10, the words of
    those with h % 10 = 0 repeat their first p from word a = g % n on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", F.floor(h / 10).cast("long").alias("g"), F.when(
        h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("w"))
    rows = rows.withColumn("n", F.coalesce(F.size("w"), F.lit(0)))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rest = F.col("n") - F.col("a")
    rows = rows.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    tail = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")),
                                    F.ceil(rest / F.col("p")).cast("int")))
    planted = F.slice(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), F.lit(1), F.col("n"))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(planted, " "))
                       .otherwise(F.col("text")).alias("text"))


@_query
def op11_catch_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(plant_repeats(table(spark, sf_dir, "documents")))
    r = F.col("runs")
    # the greatest length / period by cross products, then start, then period
    best = F.get(F.expr("""array_sort(runs, (x, y) -> case
        when x.length * y.period > y.length * x.period then -1
        when x.length * y.period < y.length * x.period then 1
        when x.start <> y.start then if(x.start < y.start, -1, 1)
        else if(x.period < y.period, -1, if(x.period > y.period, 1, 0)) end)"""), 0)
    lines = F.transform(r, lambda x: F.concat(F.concat_ws(",", x["start"].cast("string"), x["length"].cast("string"),
                                                          x["period"].cast("string")), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size(r).cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@_query
def op12_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision_list.judge_quality(table(spark, sf_dir, "documents"),
                                       table(spark, sf_dir, "labels"))


@_query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    leaf = lambda n_chars: merkle.leaf_digest(                                  # noqa: E731
        *[n_chars if f == "n_chars" else F.col(f) for f in fields])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, leaf(F.col("n_chars") + 1))
    leaves = docs.select("doc_id", "lang", leaf(F.col("n_chars")).alias("leaf"),
                         tampered.alias("tampered"))
    found = merkle.manifest(leaves, carry=("tampered",))
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    return found.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))

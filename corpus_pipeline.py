"""Corpus pipeline: documents in, encoded training documents out.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and
read back as the next stage's ``docs``.  All but the last return the columns of documents.

Every stage reads a null text as an empty one, leaves columns that it doesn't read as they
are, whatever their names, and gives an empty result for an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chunkwise.llm import bloom_dedup, cotrain, group_join, mixing, piece_codec
from chunkwise.llm.common import ship, stored, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier scores below 0.5 go.  Rows are judged by text,
    source, lang and n_chars (null is a value of its own), so equal rows go together."""
    return cotrain.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, the one with the largest doc_id (a null id
    is the smallest).  Null, empty texts are one group; blank ones differ as written."""
    ship(spark)
    return bloom_dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, the one with the smallest doc_id: copies
    share 0.8 or more of their shingles of five words.  Rows without id come last, then the
    smaller digest of the text stays; texts without words all stay."""
    ship(spark)
    return group_join.drop_near_copies(docs, width=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target weights; documents taken twice appear twice.  A null source is
    a source of its own; texts without words give no words and so are not taken."""
    ship(spark)
    return mixing.take_mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of the mix; an empty text
    has no tokens."""
    ship(spark)
    return piece_codec.digests(piece_codec.encode_decode(
        docs, public_tokenizers.path("piece_bpe_32k.model")))


STAGES = [("quality_filter", quality_filter), ("exact_dedup", exact_dedup),
          ("near_dedup", near_dedup), ("source_mix", source_mix), ("encode_pieces", encode_pieces)]

#: No SQL: learned scores and tokenizers are not expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""From raw documents to token ids: five stages, each over all that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents`` (and any others that came in). ``run`` writes each stage's result as Parquet to
the shared checkpoint folder and reads it back as the next one's documents.

Cases: a NULL or empty text gets the share of good labels as its score, is one empty line, links with
nothing, and has no words and no tokens. Very long texts go through every stage whole. Rows that share
a doc_id count as one document for line dedup and mixing; of those that also share a text the join
keeps the smallest by their other columns. An empty table passes through every stage. Other columns
are handed on by all stages but the last; names beginning with __ belong to the stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import byte_bpe, line_dedup, mixing, ngram_join, quality
from strata.llm.common import stored, table

PIECES = 200_000                                            # remembered by a worker: the other stages share its memory
KEEP_FROM = 0.7                                             # quality score of documents that stay


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is KEEP_FROM or more; the model never sees held-out labels."""
    labels = quality.learnable(table(spark, sf_dir, "labels").select("doc_id", "quality"))
    model = quality.fit_quality(docs.select("doc_id", "text"), labels)
    return quality.score_quality(docs, model).filter(F.col("__quality") >= KEEP_FROM).drop("__quality")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the repeated lines that another document keeps; ``n_chars`` follows the text."""
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        changed = F.col("__n_dropped") > 0
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    return ngram_join.keep_one(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it, at most three times."""
    return mixing.apply_mix(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the token ids, with hashes of the ids and of the decoded bytes."""
    out = byte_bpe.encode_texts(docs.select("doc_id", "lang", "source", "text"), byte_bpe.default_ranks(),
                                public_tokenizers.PATTERN, keep=False, remember=PIECES)
    return out.select("doc_id", "lang", "source", F.col("__n_tokens").alias("n_tokens"), F.col("__ids").alias("ids"),
                      F.col("__ids_sha256").alias("ids_sha256"), F.col("__decoded_sha256").alias("decoded_sha256"))


STAGES = [("quality classifier", quality_stage), ("line dedup", line_stage), ("n-gram Jaccard join", jaccard_stage),
          ("mixing sources", mix_stage), ("byte-level BPE", bpe_stage)]

#: SQL can't express the trained classifier and the join; tests compare ``run`` with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

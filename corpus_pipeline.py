"""The corpus pipeline: quality, near copies, repeated passages, mixture, packing.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's docs. All stages but the last return the columns of docs.

What holds for every stage: docs has doc_id and text, the mixture also uses source; any other columns, whatever their names,
go along untouched. Texts of any length are taken whole. An empty table gives an empty one. Rows that are alike are rows
like others unless a stage says otherwise; ties are settled by id, then by hashes of texts, so that reruns agree.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gablewise.llm import jaccard, mixing, packing, quality, spans
from gablewise.llm.common import save

#: Near copies are a wider class than the links of the operator's own query.
NEAR = jaccard.Settings(k=5, percent=80)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good. A null or empty text is scored by the bias alone; null ids count as any."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links connect: of five words a shingle, 80 of 100.

    The one with the smallest doc_id stays. Documents without words and rows without a doc_id stay; of rows that share the
    kept doc_id one does, that of the text with the least hash.
    """
    return jaccard.one_of_each(docs, NEAR)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the sentences that stood in an earlier document, n_chars following them.

    Rows of which nothing is left go; rows without text stay. Null doc_ids come after all others.
    """
    return spans.dedup_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights, documents as often as the mix takes them.

    A null source is one like others, the last in order. A document without words holds nothing to take and does not go on.
    """
    return mixing.mix_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences. A null text is an empty one: its piece holds the end mark alone."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express the classifier or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Training-corpus pipeline: quality, line dedup, near-duplicate join, decontamination, byte-level BPE.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``:

1. quality: documents whose score is under 0.7 go (empty texts are scored like others);
2. line_dedup: later copies of repeated line runs are cut out of the texts; a document left without any
   line goes;
3. jaccard_join: of every class of near copies the document with the smallest doc_id stays;
4. decontamination: documents that overlap a benchmark item go;
5. byte_bpe: one row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

A stage works on its input; besides, the first learns from ``documents`` and ``labels``, and the fourth reads
``benchmark``. Empty input gives empty output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from webfeed.llm import bpe, decontaminate, jaccard_join, line_dedup
from webfeed.llm import quality as quality_classifier
from webfeed.llm.tables import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"))


def line_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokenizers

    return bpe.encode_digests(docs, tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)


STAGES = [("quality", quality), ("line_dedup", line_runs), ("jaccard_join", near_copies),
          ("decontamination", decontamination), ("byte_bpe", byte_bpe)]

#: A trained classifier and a tokenizer are not SQL; the tests compare the other stages with brute force, and the
#: classifier's scores with those of its model computed in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each but the last is written to the checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

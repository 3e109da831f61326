"""The corpus pipeline: five stages over documents, each an operator of sparksift.llm on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparksift.llm import bpe, decontaminate, jaccard_join, quality, toxicity
from sparksift.llm.common import staged, table

TOKENIZER = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: failed lines are taken out, documents that fail or lose too much go, null and empty texts with them. Repeated rows go or stay alike."""
    return quality.clean_documents(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: learns from the labelled documents of this stage's input, and drops what it scores as toxic.

    Null and empty texts have the score of no features; without labels of both kinds all rows get the label there is, or stay."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one document of each class of near copies stays, the one of the least id; of repeated rows one, of rows without words all."""
    return jaccard_join.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: words inside windows of benchmark items are taken out of the texts. Rows all stay, null texts as they are."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), "spans")


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: each text's number of tokens, and digests of its ids and decoded text; a null text counts as empty."""
    import public_tokenizers

    return bpe.digests(bpe.encode_decode(docs, public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: The trained classifier and the BPE encoder have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again. Empty tables give an empty result."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{name}")
    return docs

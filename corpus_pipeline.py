"""Five steps from raw documents to token files, each by one operator of ``cordon.llm``.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns what it keeps,
which is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cordon.llm.decontaminate import clean_rows
from cordon.llm.hostrules import kept_rows
from cordon.llm.jaccard import one_per_group
from cordon.llm.mixing import mixed_rows
from cordon.llm.scratch import importable, written
from cordon.llm.tokens import read_documents, write_tokens
from cordon.session import scratch_path

END_ID = 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or whose host fails, go."""
    return kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays."""
    return one_per_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, edited or not, go."""
    return clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and from them where each document starts."""
    import public_tokenizers

    path = scratch_path(spark, "pipeline-tokens")
    write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return read_documents(spark, path)


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", decontaminate),
          ("mixing sources", mix), ("token ids", tokens)]

#: the steps are not SQL (tokenizer, alignment); tests compare them with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage-{i + 1}")
    return docs

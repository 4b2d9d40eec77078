"""From documents to token files: the stages of a training corpus, in order."""

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontamination, mixing, ngram_join, token_files, toxicity
from millrace.llm.common import documents, stage
from millrace.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labelled ones among ``docs``.

    A null or blank text is judged by the intercept; null ids and repeated rows are judged like others.
    """
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked ones stays.

    Sets of five-word shingles, similarity 0.8 or more. Rows with a null id stay; of rows with one id and text
    one stays; texts without words are copies of nothing.
    """
    return ngram_join.one_of_each(docs, words=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go; null and empty texts hold none."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice; those without words not at all."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and what they hold of each document: an empty one its end id, null ids first."""
    return token_files.encode(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("benchmark_leaks", drop_leaks),
    ("source_mix", mix_sources),
    ("token_files", write_tokens),
]

#: SQL can express neither the classifier nor the edit distance nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written before the next begins."""
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

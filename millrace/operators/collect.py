"""Collectors: a seeded sample of a source, projected to the raw record of its domain.

The domain and source names written into the records are fixed values.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranking import seeded_sample


def _sampled(df: DataFrame, limit: int | None, seed: int) -> DataFrame:
    return df if limit is None else seeded_sample(df, limit, seed)


def collect_legal(
    df: DataFrame, limit: int | None = 2000, seed: int = 42, max_chars: int | None = 4000
) -> DataFrame:
    """Text cut to ``max_chars``, and its summary; None for either bound takes everything."""
    text = F.col("text") if max_chars is None else F.substring("text", 1, max_chars)
    return _sampled(df, limit, seed).select(
        "row_id",
        F.lit("legal").alias("domain"),
        F.lit("billsum").alias("source"),
        text.alias("text"),
        "summary",
    )


def collect_medical(df: DataFrame, limit: int | None = 2000, seed: int = 42) -> DataFrame:
    return _sampled(df, limit, seed).select(
        "row_id",
        F.lit("medical").alias("domain"),
        F.lit("medical_flashcards").alias("source"),
        F.col("input").alias("question"),
        F.col("output").alias("answer"),
    )


def collect_support(df: DataFrame, limit: int | None = 2000, seed: int = 42) -> DataFrame:
    return _sampled(df, limit, seed).select(
        "row_id",
        F.lit("support").alias("domain"),
        F.lit("bitext").alias("source"),
        F.col("instruction").alias("ticket"),
        F.col("response").alias("resolution"),
    )


def union_domains(*frames: DataFrame) -> DataFrame:
    """Stack the domains; a column that a domain lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def one_id_space(domains: list[tuple[DataFrame, DataFrame | None]]) -> list[DataFrame]:
    """Shift the ids of each domain behind those of the domains before it, in order and without a clash.

    Each domain comes with a table of one column that holds its ids, cheap to read, whose least and
    greatest give the shift; the last one may have none, if its ids begin at 0. No row is moved or
    numbered. Ids that leave the range of bigint fail the job.
    """
    shifted, start = [], F.lit(0).cast("bigint")
    for frame, ids in domains:
        low = F.lit(0) if ids is None else ids.select(F.coalesce(F.min(ids.columns[0]), F.lit(0))).scalar()
        shifted.append(frame.withColumn("row_id", F.col("row_id") - low + start))
        if ids is not None:
            every = F.max(ids.columns[0]) - F.min(ids.columns[0]) + 1
            start = start + ids.select(F.coalesce(every, F.lit(0))).scalar()
    return shifted

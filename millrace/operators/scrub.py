"""Masking personal data in whole records."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import pii
from millrace.operators.records import content_columns


def scrub_records(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Mask every content string; other columns pass through. One narrow projection."""
    masked = set(content_columns(df, row_id))
    return df.select(
        *[pii.scrub(F.col(c)).alias(c) if c in masked else F.col(c) for c in df.columns]
    )


def mask_counts(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Per label, how many masks scrubbing sets over all content columns."""
    names = content_columns(df, row_id)
    pairs = df.select(
        F.explode(
            F.array(
                *[F.struct(F.col(c).alias("raw"), pii.scrub(F.col(c)).alias("clean")) for c in names]
            )
        ).alias("cell")
    )
    counts = [
        F.sum(pii.label_count(F.col("cell.clean"), x) - pii.label_count(F.col("cell.raw"), x)).alias(x)
        for x in pii.LABELS
    ]
    totals = pairs.where(F.col("cell.clean") != F.col("cell.raw")).agg(*counts)
    return totals.unpivot([], list(pii.LABELS), "label", "masked").withColumn(
        "masked", F.coalesce("masked", F.lit(0).cast("long"))
    )

"""Exact de-duplication on normalized content."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.seeded import required
from millrace.functions.text import squeeze_space
from millrace.operators.records import content_columns
from millrace.session import stage


def dedup_key(df: DataFrame, row_id: str = "row_id") -> Column:
    """MD5 of all content values in column-name order, lower-cased, white space squeezed.

    Null means that the record lacks the key, so it adds nothing.
    """
    values = [F.col(c).cast("string") for c in content_columns(df, row_id, strings_only=False)]
    return F.md5(squeeze_space(F.lower(F.concat_ws(" ", *values))))


def deduplicate(df: DataFrame, row_id: str = "row_id", staged: bool = False) -> DataFrame:
    """Keep the first record, by row id, of each key.

    Only (key, id) is aggregated, with partial aggregation, so a key that a third of the rows
    share costs one row per task; the text moves once, by its unique id. ``staged`` first
    writes the input with its keys, so that costly upstream work runs once, not per side.
    A null id fails the job.
    """
    rows = df.withColumn("dedup_key", dedup_key(df, row_id))
    if staged:
        rows = stage(rows, "dedup")
    first = rows.groupBy("dedup_key").agg(F.min(required(row_id)).alias(row_id)).select(row_id)
    return rows.drop("dedup_key").join(first, row_id, "left_semi")


def dedup_counts(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Rows before and after, in one row."""
    keys = df.select(dedup_key(df, row_id).alias("dedup_key"))
    per_key = keys.groupBy("dedup_key").agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    )

"""Dropping empty, too short, too long or mostly non-text records."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import is_blank, letter_count
from millrace.operators.records import content_columns


def _columns(df: DataFrame, row_id: str) -> list[Column]:
    return [F.col(c) for c in content_columns(df, row_id)]


def no_empty_value(df: DataFrame, row_id: str = "row_id") -> Column:
    """At least one content string, and none of them blank."""
    columns = _columns(df, row_id)
    if not columns:
        return F.lit(False)
    return F.coalesce(*columns).isNotNull() & reduce(
        lambda a, b: a & b, [F.coalesce(~is_blank(c), F.lit(True)) for c in columns]
    )


def total_length(df: DataFrame, row_id: str = "row_id") -> Column:
    """Characters over all content strings."""
    return reduce(
        lambda a, b: a + b, [F.coalesce(F.length(c), F.lit(0)) for c in _columns(df, row_id)], F.lit(0)
    )


def letter_ratio(df: DataFrame, row_id: str = "row_id") -> Column:
    """Share of letters in the values joined by spaces, the joining spaces included."""
    joined = F.concat_ws(" ", *_columns(df, row_id))
    return letter_count(joined).cast("double") / F.greatest(F.length(joined), F.lit(1))


def drop_reason(
    df: DataFrame,
    row_id: str = "row_id",
    min_chars: int = 30,
    max_chars: int = 8000,
    min_letters: float = 0.5,
) -> Column:
    """Why a record fails, cheapest test first; null if it is good."""
    return (
        F.when(~no_empty_value(df, row_id), "empty")
        .when(~total_length(df, row_id).between(min_chars, max_chars), "length")
        .when(letter_ratio(df, row_id) < min_letters, "letters")
    )


def keep_good(df: DataFrame, row_id: str = "row_id", min_chars: int = 30, max_chars: int = 8000) -> DataFrame:
    return df.where(drop_reason(df, row_id, min_chars, max_chars).isNull())


def quality_counts(df: DataFrame, row_id: str = "row_id", min_chars: int = 30, max_chars: int = 8000) -> DataFrame:
    """Rows per outcome; the kept rows are "kept"."""
    reason = F.coalesce(drop_reason(df, row_id, min_chars, max_chars), F.lit("kept"))
    return df.groupBy(reason.alias("outcome")).agg(F.count(F.lit(1)).alias("n_rows"))

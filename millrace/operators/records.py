"""Which columns of a record carry its content."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Columns that describe the record. Scrubbing, dedup keys and quality checks
# leave them out.
META_COLUMNS = ("domain", "source")


def content_columns(df: DataFrame, row_id: str = "row_id", strings_only: bool = True) -> list[str]:
    """The record's own columns, sorted by name."""
    skipped = {*META_COLUMNS, row_id}
    return sorted(
        field.name
        for field in df.schema.fields
        if field.name not in skipped
        and (not strings_only or isinstance(field.dataType, T.StringType))
    )

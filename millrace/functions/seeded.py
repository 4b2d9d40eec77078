"""Seeded, partition-independent randomness: order rows by a hash of seed and row id."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_hash(*parts) -> Column:
    """MD5 hex of the parts joined with a colon; the usual parts are seed and row id."""
    columns = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in columns]))


def required(name: str) -> Column:
    """The column, failing the job where it is null: ids decide which rows are kept."""
    message = F.lit(f"{name} is null; number the rows first")
    return F.when(F.col(name).isNull(), F.raise_error(message)).otherwise(F.col(name))


def leading_number(hash_hex: Column, digits: int) -> Column:
    """The first hex digits of a hash as a bigint."""
    return F.conv(F.substring(hash_hex, 1, digits), 16, 10).cast("long")

"""Exact ranks and rank cuts in a seeded order, without sorting a whole group in one task.

The sort key starts with an MD5 hex string, so its first digits split any group, however
large, into even buckets. Counting the buckets (partial aggregation, at most 4096 rows per
group) tells which bucket holds a wanted rank. A wanted bucket of more than ``BUCKET_ROWS`` rows is
counted by its next digits, and so on; only buckets under that bound are sorted.

Group columns must not be null.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.seeded import leading_number, required, seeded_hash
from millrace.operators.numbering import with_row_numbers
from millrace.session import broadcast_if_small, broadcast_staged, stage

KEY = "shuffle_key"
BUCKET = "shuffle_bucket"

# Hex digits of a bucket, and the most rows of one that are sorted.
DIGITS = 3
BUCKET_ROWS = 100_000
# As many digits as a bigint holds; rows that agree in 60 bits of a hash are not split any further.
MOST_DIGITS = 15


def keyed(df: DataFrame, seed: int, row_id: str = "row_id") -> DataFrame:
    """Add the seeded sort key, unique per row, and its bucket. A null id fails the job."""
    row = required(row_id)
    return df.withColumn(KEY, F.concat_ws(":", seeded_hash(seed, row), row.cast("string"))).withColumn(
        BUCKET, leading_number(F.col(KEY), DIGITS)
    )


def bucket_offsets(rows: DataFrame, by: list[str]) -> DataFrame:
    """Per group and bucket: rows before the bucket, rows in it, and rows in the group."""
    counts = rows.groupBy(*by, BUCKET).agg(F.count(F.lit(1)).alias("in_bucket"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *by,
        BUCKET,
        F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0)).alias("before"),
        "in_bucket",
        F.sum("in_bucket").over(group).alias("group_rows"),
    )


def group_profiles(rows: DataFrame, by: list[str]) -> DataFrame:
    """One row per group: its size and its bucket steps in order (at most one per bucket)."""
    return (
        bucket_offsets(rows, by)
        .groupBy(*by)
        .agg(
            F.max("group_rows").alias("group_rows"),
            F.sort_array(F.collect_list(F.struct("before", BUCKET, "in_bucket"))).alias("steps"),
        )
    )


def _refined(rows: DataFrame, spots: DataFrame, by: list[str], digits: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the wanted buckets, and the spots, by buckets of more digits."""
    finer, bucket = "finer_bucket", [*by, BUCKET]
    inside = stage(
        rows.join(broadcast_if_small(spots.select(*bucket).distinct()), bucket, "left_semi").withColumn(
            finer, leading_number(F.col(KEY), digits)
        ),
        "bucket",
    )
    earlier = Window.partitionBy(*bucket).orderBy(finer).rowsBetween(Window.unboundedPreceding, -1)
    counts = inside.groupBy(*bucket, finer).agg(F.count(F.lit(1)).alias("n"))
    steps = counts.withColumn("skipped", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    hit = (F.col("skipped") < F.col("place")) & (F.col("place") <= F.col("skipped") + F.col("n"))
    moved = spots.join(steps, bucket).where(hit).withColumns(
        {"place": F.col("place") - F.col("skipped"), "in_bucket": F.col("n"), BUCKET: F.col(finer)}
    )
    return inside.withColumn(BUCKET, F.col(finer)).drop(finer), stage(moved.drop("n", "skipped", finer), "spots")


def sortable_buckets(
    rows: DataFrame, wanted: DataFrame, by: list[str], payload: list[str]
) -> tuple[DataFrame, DataFrame]:
    """The rows of the buckets that hold wanted ranks, none over ``BUCKET_ROWS`` rows, and the ``place`` of each
    wanted rank in its bucket.
    """
    step = F.element_at(F.filter("steps", lambda s: s["before"] < F.col("rank")), -1)
    spots = stage(
        wanted.withColumn("step", step)
        .withColumns({BUCKET: F.col("step")[BUCKET], "in_bucket": F.col("step")["in_bucket"]})
        .withColumn("place", F.col("rank") - F.col("step")["before"])
        .drop("steps", "step"),
        "spots",
    )
    rows, digits = rows.select(*dict.fromkeys([*by, BUCKET, KEY, *payload])), DIGITS
    while digits < MOST_DIGITS and (spots.agg(F.max("in_bucket")).first()[0] or 0) > BUCKET_ROWS:
        digits = min(digits + DIGITS, MOST_DIGITS)
        rows, spots = _refined(rows, spots, by, digits)
    spots = broadcast_staged(spots.drop("in_bucket"))
    return rows.join(spots.select(*by, BUCKET), [*by, BUCKET], "left_semi"), spots


def rows_at_ranks(rows: DataFrame, wanted: DataFrame, by: list[str], payload: list[str]) -> DataFrame:
    """Find the rows that stand at wanted ranks (1 = first) of their group.

    ``wanted`` carries the group columns, ``rank``, the group's ``steps`` and whatever else
    should come back beside the sort key and the ``payload`` columns of the row found.
    """
    candidates, spots = sortable_buckets(rows, wanted, by, payload)
    place = F.row_number().over(Window.partitionBy(*by, BUCKET).orderBy(KEY)).cast("long")
    return candidates.withColumn("place", place).join(spots, [*by, BUCKET, "place"]).drop("place", BUCKET)


def with_rank(df: DataFrame, seed: int, by: list[str] | None = None, row_id: str = "row_id") -> DataFrame:
    """Add ``rank``, the 1-based place in the seeded order, for groups of any size.

    Ids and keys alone are put in order, in ranges of equal size whatever the groups; the wide rows
    meet their rank by id.
    """
    by = by or []
    narrow = keyed(df.select(*by, row_id), seed, row_id).drop(BUCKET)
    numbered = with_row_numbers(narrow, [*by, KEY], "number").drop(KEY)
    first = F.min("number").alias("first")
    if by:
        numbered = numbered.join(numbered.groupBy(*by).agg(first), by)
    else:
        numbered = numbered.withColumn("first", F.lit(0))
    rank = (F.col("number") - F.col("first") + 1).alias("rank")
    return df.join(numbered.select(row_id, rank), row_id)


def seeded_sample(df: DataFrame, limit: int, seed: int = 42, row_id: str = "row_id") -> DataFrame:
    """The first ``limit`` rows of the seeded order.

    The key at that rank becomes a scalar bound, so wide rows are only filtered, never sorted.
    """
    rows = keyed(df, seed, row_id)
    wanted = group_profiles(rows, []).withColumn("rank", F.least(F.lit(limit), "group_rows"))
    bound = rows_at_ranks(rows, wanted.where("rank > 0"), [], []).select(F.max(KEY))
    return rows.where(F.col(KEY) <= bound.scalar()).drop(KEY, BUCKET)


def first_rows(df: DataFrame, limit: int, order_by: str = "row_id") -> DataFrame:
    """The first ``limit`` rows by a unique column; only that column goes through the top-n."""
    bound = df.select(order_by).orderBy(order_by).limit(limit).select(F.max(order_by))
    return df.where(F.col(order_by) <= bound.scalar())

"""JSON Lines sources and sinks."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.session import broadcast_if_small, stage
from millrace.sources.publishing import replacing
from millrace.sources.schemas import USAGE

CORRUPT = "_corrupt_record"

# Block starts that may be broadcast, counted and measured first: a row for each task of the scan.
BLOCKS = 2_000_000
BLOCK_BYTES = 512_000_000
MIN_SPLITS = "spark.sql.files.minPartitionNum"


def read_jsonl(
    spark: SparkSession,
    paths: str | list[str],
    schema: str | StructType,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Scan JSON Lines files, folders or globs under a declared schema.

    A malformed line fails the job; ``keep_corrupt`` instead puts it in ``_corrupt_record``.
    A path that matches nothing is an error.
    """
    if not keep_corrupt:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)
    wide = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return (
        spark.read.schema(StructType([*wide.fields]).add(CORRUPT, "string"))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(paths)
    )


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of text files, folders or globs as ``value``; blank ones are left out."""
    return spark.read.text(paths).where(F.col("value").rlike(r"\S"))


def _pin_splits(spark: SparkSession) -> None:
    """Keep the cut of files into tasks the same for later scans, whatever executors come and go."""
    if spark.conf.get(MIN_SPLITS, None) is None:
        spark.conf.set(MIN_SPLITS, str(spark.sparkContext.defaultParallelism))


def number_rows(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Give a fresh file scan consecutive ids, from 0, in path and then line order.

    A first scan counts the rows of every file block, now; it writes no column of the rows. The
    blocks are put in order, and their first numbers are broadcast by task, 24 bytes each. The rows
    are then numbered in the scan that the caller's job makes, by their block's first number and their
    place in it; no row moves or is written for it. If files were cut otherwise in that scan than in the
    first, the job fails; the cut is pinned for the session, so that this takes a change of settings.
    """
    spark = df.sparkSession
    _pin_splits(spark)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    block = [F.col(f"_metadata.{c}") for c in ("file_path", "file_block_start", "file_block_length")]
    mark = F.xxhash64(*block).alias("mark")
    at = [c.alias(n) for c, n in zip(block, ("file_path", "file_block_start"), strict=False)]
    # Both scans read a column: a scan of none would also count lines that hold no record.
    spot = [F.spark_partition_id().alias("task"), (place + F.hash(df.columns[0]).bitwiseAND(0)).alias("place"), mark]
    scan = df.select(*at, *spot)
    blocks = scan.groupBy("task", "file_path", "file_block_start", "mark").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("place").alias("first")
    )
    earlier = Window.orderBy("file_path", "file_block_start").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n_rows").over(earlier), F.lit(0))
    starts = stage(blocks, "blocks").select("task", "mark", (start - F.col("first")).alias("shift"))
    by_task = broadcast_if_small(
        starts.groupBy("task").agg(F.collect_list(F.struct("mark", "shift")).alias("blocks")), BLOCKS, BLOCK_BYTES
    )
    kept = [F.col(f"`{c}`") for c in df.columns if c != row_id]
    rows = df.select(*kept, *spot).join(by_task, "task", "left")
    shift = F.get(F.filter("blocks", lambda b: b["mark"] == F.col("mark")), F.lit(0))["shift"]
    lost = F.raise_error(F.lit("files are cut otherwise than when they were counted; number the rows again"))
    number = F.coalesce(shift + F.col("place"), lost.cast("long"))
    return rows.select(number.alias(row_id), *kept)


def concat_files(
    spark: SparkSession, paths: list[str], schema: str | StructType
) -> DataFrame:
    """Several training files, synthetic rows included, as one set."""
    return reduce(DataFrame.unionByName, [read_jsonl(spark, p, schema) for p in paths])


def write_jsonl(df: DataFrame, path: str) -> None:
    """Write a folder of JSON Lines parts; null columns are left out of the line.

    Like the other sinks here it replaces old output at the end and as a whole.
    """
    with replacing(df.sparkSession, path) as new:
        df.write.json(new)


def write_lines(df: DataFrame, path: str) -> None:
    """Write a folder of text parts; ``df`` has one string column."""
    with replacing(df.sparkSession, path) as new:
        df.write.text(new)


def split_ordered(df: DataFrame, order_by: str) -> DataFrame:
    """Rows in the order in which the split sink writes them, without the key that gives it."""
    return df.repartitionByRange("split", order_by).sortWithinPartitions("split", order_by).drop(order_by)


def write_splits(df: DataFrame, path: str, order_by: str | None = None) -> None:
    """One sub-folder per split, so that a reader of one split opens only that one."""
    rows = df if order_by is None else split_ordered(df, order_by)
    with replacing(df.sparkSession, path) as new:
        rows.write.partitionBy("split").json(new)


def read_split(
    spark: SparkSession, path: str, split: str, schema: str | StructType
) -> DataFrame:
    wide = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = StructType([*wide.fields]).add("split", "string")
    return spark.read.schema(full).json(path).where(F.col("split") == split).drop("split")


def append_usage(interactions: DataFrame, path: str) -> None:
    """Append usage records; the time defaults to now and feedback to null.

    Null keys are written out, as every record has all six.
    """
    now = F.unix_micros(F.current_timestamp()) / 1e6
    given = interactions.columns
    record = interactions.select(
        (F.coalesce("timestamp", now) if "timestamp" in given else now).alias("timestamp"),
        "domain",
        "query",
        "response",
        F.col("latency_ms").cast("int").alias("latency_ms"),
        (F.col("feedback") if "feedback" in given else F.lit(None)).cast("string").alias("feedback"),
    )
    record.write.mode("append").option("ignoreNullFields", False).json(path)


def read_usage(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, USAGE)


def write_report(lines: DataFrame, path: str) -> None:
    """Write report lines as one text file. There are a few lines per domain, not per row."""
    ordered = lines.orderBy("part", "first_row", "line_no").select(F.col("line").alias("value"))
    write_lines(ordered.coalesce(1), path)

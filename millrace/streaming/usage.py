"""The usage log as a stream: traffic, latency and unseen words per window and domain.

Every number kept is a sum, so each micro-batch adds the totals of its own records and nothing is held
between batches: no state grows with open windows, and a late record counts like any other. Totals lie
in a store, a folder that belongs to one log:

- ``checkpoint``: which files of the log have been read;
- ``batches/batch=N``: totals of micro-batch N per (window, domain), replaced if the batch is run again;
- ``merged/upto=N``: all totals up to batch N, written every ``MERGE_EVERY`` batches. Readers take the
  newest one and the batches after it, so a batch that is run again is not counted twice.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.text import words
from millrace.session import broadcast_if_small
from millrace.sources.publishing import delete, numbered_folders, replacing
from millrace.sources.schemas import USAGE

MERGE_EVERY = 64
KEYS = ("window_start", "domain")
SUMS = ("n_rows", "latency_sum", "n_latency", "n_words", "unseen_words")
TOTALS = (
    "window_start timestamp, domain string, n_rows bigint, latency_sum bigint, n_latency bigint, "
    "n_words bigint, unseen_words bigint, last_at timestamp"
)


def usage_stream(spark: SparkSession, path: str) -> DataFrame:
    """New JSON Lines parts of the log folder as they arrive; a malformed line fails the stream."""
    return spark.readStream.schema(USAGE).option("mode", "FAILFAST").json(path)


def known_words(vocabulary: DataFrame) -> DataFrame:
    """The vocabulary ready to be joined: broadcast if its rows and bytes, counted, are few enough."""
    return broadcast_if_small(vocabulary.select("word", F.lit(True).alias("known")))


def window_totals(usage: DataFrame, known: DataFrame, window: str = "1 day") -> DataFrame:
    """Sums per window and domain; records without a time do not count.

    Records are read once. Each gives a row for itself, without a word, and one for each of its words; equal
    words of a window and domain are counted before they meet the vocabulary, so a word of any
    frequency is one row there, and no key is hotter than there are windows and domains.
    """
    at = F.timestamp_seconds("timestamp")
    found = F.coalesce(words(F.col("query")), F.array().cast("array<string>"))
    timed = usage.where(F.col("timestamp").isNotNull()).select(
        F.window(at, window)["start"].alias("window_start"), "domain", F.col("latency_ms").cast("bigint").alias("ms"),
        at.alias("at"), F.explode(F.concat(F.array(F.lit(None).cast("string")), found)).alias("word"),
    )
    record = F.col("word").isNull()
    uses = timed.groupBy(*KEYS, "word").agg(
        F.count(F.lit(1)).alias("uses"),
        F.sum(F.when(record, F.col("ms"))).alias("ms"),
        F.count(F.when(record, F.col("ms"))).alias("n_ms"),
        F.max("at").alias("at"),
    )
    unseen = F.col("word").isNotNull() & F.col("known").isNull()

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("uses"))), F.lit(0))

    return uses.join(known, "word", "left").groupBy(*KEYS).agg(
        total(F.col("word").isNull()).alias("n_rows"),
        F.sum("ms").alias("latency_sum"),
        F.sum("n_ms").alias("n_latency"),
        total(F.col("word").isNotNull()).alias("n_words"),
        total(unseen).alias("unseen_words"),
        F.max("at").alias("last_at"),
    )


def _summed(totals: DataFrame) -> DataFrame:
    return totals.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS], F.max("last_at").alias("last_at"))


def _shaped(totals: DataFrame) -> DataFrame:
    return totals.select(
        *KEYS,
        "n_rows",
        F.try_divide("latency_sum", "n_latency").alias("mean_latency_ms"),
        "n_words",
        "unseen_words",
        (F.col("unseen_words") / F.greatest("n_words", F.lit(1))).alias("oov_rate"),
    )


def windowed_usage(usage: DataFrame, vocabulary: DataFrame, window: str = "1 day") -> DataFrame:
    """Per window and domain of a batch: rows, mean latency, words, unseen words and their rate."""
    return _shaped(window_totals(usage, known_words(vocabulary), window))


def follow(
    stream: DataFrame, store: str, vocabulary: DataFrame, window: str = "1 day", once: bool = False
) -> StreamingQuery:
    """Add what the stream has not yet given to the store, and go on, or ``once`` stop there.

    Called again with the same store it resumes: only new files are read. Words count as unseen by the
    vocabulary handed in when their batch is run.
    """
    spark = stream.sparkSession
    known = known_words(vocabulary)

    def add(batch: DataFrame, number: int) -> None:
        with replacing(spark, f"{store}/batches/batch={number}") as new:
            window_totals(batch, known, window).write.parquet(new)
        if (number + 1) % MERGE_EVERY == 0:
            _merge(spark, store, number)

    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", f"{store}/checkpoint")
    return (writer.trigger(availableNow=True) if once else writer).start()


def _parts(spark: SparkSession, store: str, upto: int | None = None) -> list[str]:
    """Folders that together hold the totals, each batch once."""
    merged = max((n for n in numbered_folders(spark, f"{store}/merged", "upto") if upto is None or n < upto), default=-1)
    batches = [n for n in numbered_folders(spark, f"{store}/batches", "batch") if n > merged and (upto is None or n <= upto)]
    head = [f"{store}/merged/upto={merged}"] if merged >= 0 else []
    return head + [f"{store}/batches/batch={n}" for n in sorted(batches)]


def _merge(spark: SparkSession, store: str, number: int) -> None:
    """Write all totals up to a batch as one table. What the one before replaced goes now, so that
    readers that listed the store before this merge still find their files.
    """
    before = max((n for n in numbered_folders(spark, f"{store}/merged", "upto") if n < number), default=-1)
    totals = spark.read.schema(TOTALS).parquet(*_parts(spark, store, number))
    with replacing(spark, f"{store}/merged/upto={number}") as new:
        _summed(totals).write.parquet(new)
    for kind, name in (("merged", "upto"), ("batches", "batch")):
        for n in numbered_folders(spark, f"{store}/{kind}", name):
            if n < before or (n == before and kind == "batches"):
                delete(spark, f"{store}/{kind}/{name}={n}")


def read_windows(spark: SparkSession, store: str, closed_before: str | None = None) -> DataFrame:
    """All windows so far, open ones included.

    ``closed_before``, an interval such as "25 hours" (a window's length and the lateness allowed), gives only
    windows that began so long before the latest record.
    """
    parts = _parts(spark, store)
    totals = spark.read.schema(TOTALS).parquet(*parts) if parts else spark.createDataFrame([], TOTALS)
    if closed_before is not None:
        latest = totals.select(F.max("last_at")).scalar()
        totals = totals.where(F.col("window_start") <= latest - F.expr(f"INTERVAL {closed_before}"))
    return _shaped(_summed(totals))

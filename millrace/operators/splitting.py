"""Seeded train, val and test splits, stratified by domain."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.seeded import seeded_hash
from millrace.functions.text import named_domain
from millrace.operators.ranking import KEY, BUCKET, group_profiles, keyed, rows_at_ranks
from millrace.session import broadcast_if_small


def stratified_split(
    df: DataFrame,
    train_frac: float = 0.8,
    val_frac: float = 0.1,
    seed: int = 42,
    row_id: str = "row_id",
) -> DataFrame:
    """Add ``split``: per domain floor(n*train) train rows, floor(n*val) val rows, the rest test.

    A row's side follows from comparing its sort key with the keys at the two cut ranks of
    its domain. Finding them reads only domain and id; the rows themselves are not shuffled.
    """
    rows = keyed(df.withColumn("stratum", named_domain(F.col("domain"))), seed, row_id)
    by = ["stratum"]
    n_train = F.floor(F.col("group_rows") * F.lit(float(train_frac)))
    n_val = F.floor(F.col("group_rows") * F.lit(float(val_frac)))
    wanted = group_profiles(rows, by).select(
        *by,
        "steps",
        F.explode(
            F.array(
                F.struct(F.lit("train").alias("side"), n_train.alias("rank")),
                F.struct(F.lit("val").alias("side"), (n_train + n_val).alias("rank")),
            )
        ).alias("cut"),
    )
    wanted = wanted.select(*by, "steps", "cut.side", "cut.rank").where("rank > 0")
    found = rows_at_ranks(rows, wanted, by, [])
    cuts = found.groupBy(*by).agg(
        F.max(F.when(F.col("side") == "train", F.col(KEY))).alias("train_end"),
        F.max(F.when(F.col("side") == "val", F.col(KEY))).alias("val_end"),
    )
    side = (
        F.when(F.col(KEY) <= F.col("train_end"), "train")
        .when(F.col(KEY) <= F.col("val_end"), "val")
        .otherwise("test")
    )
    return (
        rows.join(broadcast_if_small(cuts), by, "left")
        .withColumn("split", side)
        .drop("train_end", "val_end", KEY, BUCKET, *by)
    )


def with_split_order(df: DataFrame, seed: int = 42, row_id: str = "row_id") -> DataFrame:
    """Add the key that orders the rows of a split at random, domains mixed."""
    return df.withColumn("order_key", seeded_hash(seed, F.col("split"), F.col(row_id)))


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(named_domain(F.col("domain")).alias("domain"), "split").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def split_overlap(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Ids found in more than one place; empty for a sound split."""
    return df.groupBy(row_id).agg(F.count(F.lit(1)).alias("times")).where("times > 1")

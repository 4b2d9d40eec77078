"""Shared-folder scratch space and size-checked broadcasts."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64_000_000

# Runtime settings that suit the jobs. Adaptive execution may then hash instead of sort where
# every partition of a join's narrow side has turned out small, as in the dedup semi-join:
# the wide rows are not sorted.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


def tune(spark: SparkSession) -> None:
    """Apply the settings to a session; the caller decides, no job does it by itself."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the cluster's shared ``spark.checkpoint.dir``."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{shared.rstrip('/')}/millrace-{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write the rows once as Parquet in the shared folder and read them back.

    Cuts the lineage for data that several later passes read; a lost executor costs only a
    re-read, and each pass reads only the columns it needs.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_staged(held: DataFrame, max_rows: int | None = None, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a table that has been written, if its rows and bytes, counted in one small job, allow it."""
    bound = BROADCAST_ROWS if max_rows is None else max_rows
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    seen = held.limit(bound + 1).agg(F.count(F.lit(1)), size).first()
    return F.broadcast(held) if seen[0] <= bound and (seen[1] or 0) <= max_bytes else held


def broadcast_if_small(df: DataFrame, max_rows: int | None = None, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a computed dimension only after its rows and bytes have been counted.

    The table is written to the shared folder first, so it is computed once and nothing stays
    cached. Above either bound it is returned as it is and the join shuffles.
    """
    return broadcast_staged(stage(df, "small"), max_rows, max_bytes)

"""A reproducible shuffle into shards: a keyed permutation of the global row numbers.

Rows are numbered densely in the order of their ids. A Feistel network with a seed permutes the
numbers below the next even power of two; a number that falls outside the table walks on through
the network until it comes back inside, so the table's own numbers are permuted one to one. The
permuted number p gives shard ``p % shards`` and slot ``p // shards``: shard sizes differ by one
at most, and both directions are arithmetic. ``Permutation.place`` and ``Permutation.row`` answer
for single rows without a table.

Null ids come first in the order; a null text has size 1 and the checksum of no bytes. Rows with
one id are ordered by size and checksum of the text; rows equal in those are told apart by where
they were read, which no result column shows. An empty table gives no rows. Extra columns are left out.
"""

from hashlib import sha256

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import partitions, stage
from millrace.operators.numbering import with_row_numbers

SHARDS, SEED, ROUNDS = 16, 42, 6

# The multipliers of a 32-bit mixing step.
FIRST, SECOND, LOW32 = 2654435769, 2246822519, 0xFFFFFFFF


class Permutation:
    """A permutation of 0 .. n-1 that is fixed by n and the seed."""

    def __init__(self, n: int, seed: int = SEED, rounds: int = ROUNDS):
        self.n = n
        self.half = max(1, (max(n - 1, 0).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.keys = [int.from_bytes(sha256(f"{seed}:{i}".encode()).digest()[:4], "little") for i in range(rounds)]

    def _mixed(self, x: np.ndarray, key: int) -> np.ndarray:
        x = ((x ^ np.uint64(key)) * np.uint64(FIRST)) & np.uint64(LOW32)
        x ^= x >> np.uint64(15)
        x = (x * np.uint64(SECOND)) & np.uint64(LOW32)
        return (x ^ (x >> np.uint64(13))) & np.uint64(self.mask)

    def _through(self, x: np.ndarray, keys: list[int], swap: bool) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64(self.mask)
        left, right = x >> half, x & mask
        if swap:
            left, right = right, left
        for key in keys:
            left, right = right, left ^ self._mixed(right, key)
        if swap:
            left, right = right, left
        return (left << half) | right

    def _walk(self, x: np.ndarray, keys: list[int], swap: bool) -> np.ndarray:
        """Each step permutes the whole domain, so a walk from inside always comes back inside."""
        out = self._through(x.astype(np.uint64), keys, swap)
        while len(outside := np.flatnonzero(out >= self.n)):
            out[outside] = self._through(out[outside], keys, swap)
        return out

    def forward(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(np.asarray(numbers), self.keys, False)

    def backward(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(np.asarray(numbers), self.keys[::-1], True)

    def place(self, number: int, shards: int = SHARDS) -> tuple[int, int]:
        """Shard and slot of a row number."""
        slot, shard = divmod(int(self.forward(np.array([number]))[0]), shards)
        return shard, slot

    def row(self, shard: int, slot: int, shards: int = SHARDS) -> int:
        """The row number that stands in a slot of a shard."""
        at = slot * shards + shard
        if not (0 <= shard < shards and 0 <= at < self.n):
            raise IndexError((shard, slot))
        return int(self.backward(np.array([at]))[0])


def permuted(number: Column, n: int, seed: int = SEED) -> Column:
    """The permuted row number; whole Arrow batches go through the network at once."""
    shuffle = Permutation(n, seed)

    @F.pandas_udf("long")
    def run(numbers):
        import pandas as pd

        return pd.Series(shuffle.forward(numbers.to_numpy()).astype(np.int64))

    return run(number)


def placed(rows: DataFrame, order: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Adds ``shard`` and ``slot`` to rows whose order is given by columns."""
    numbered = with_row_numbers(rows, order, "__number")
    at = numbered.withColumn("__at", permuted(F.col("__number"), numbered.count(), seed))
    return at.withColumns(
        {"shard": (F.col("__at") % shards).cast("int"), "slot": F.floor(F.col("__at") / shards).cast("long")}
    ).drop("__number", "__at")


def _sized(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    text = F.col(f"`{text_col}`")
    return [
        F.col(f"`{id_col}`").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    ]


def assign(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``: the law is ``rows``.

    The texts are read once, for size and checksum; only those narrow rows move.
    """
    narrow = docs.select(*_sized(docs, id_col, text_col), F.monotonically_increasing_id().alias("__uid"))
    rows = placed(stage(narrow, "sizes"), ["doc_id", "size", "text_crc32", "__uid"], shards, seed)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(
    docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Whole documents as Parquet, one folder per shard, slots in order inside each.

    A shard of any size is cut into ranges of slots, so it is written by several tasks.
    """
    keys = ["__id", "__size", "__crc", "__uid"]
    marks = [*_sized(docs, id_col, text_col), F.monotonically_increasing_id()]
    marked = docs.drop("shard", "slot").withColumns(dict(zip(keys, marks, strict=True)))
    rows = placed(marked, keys, shards, seed).drop(*keys)
    (
        rows.repartitionByRange(partitions(docs.sparkSession), "shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.mode("overwrite").partitionBy("shard").parquet(path)
    )

"""Helpers that several operators share: staging, row order and word hashes.

The array helpers run inside tasks on one text at a time, so their memory follows the longest
text. They see UTF-8 bytes; a null text is an empty one.
"""

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_dir, stage

__all__ = ["code_points", "documents", "mix64", "scratch_dir", "shingles", "stage", "word_hashes"]

# White space between words, as bytes.
SPACES = b" \t\n\x0b\x0c\r"

_ODD = np.uint64(0x9E3779B97F4A7C15)
_IS_SPACE = np.isin(np.arange(256), list(SPACES))
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256))
_VALUE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)[_LOWER]
_POWERS = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly, one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; the longest asked for so far is kept."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash for each word, A-Z read as a-z, in the order of the text."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = ~_IS_SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_VALUE[raw] * powers(len(raw), int(_ODD)), out=total[1:])
    inverse = pow(int(_ODD), -1, 1 << 64)
    return mix64((total[end] - total[start]) * powers(len(raw), inverse)[start])


def shingles(data: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of n words; of the whole sequence if it is shorter."""
    return shingles_of(word_hashes(data), n)[0]


def shingles_of(words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The same from hashes of words, and for each run the first word it begins at."""
    if not len(words):
        return words, np.empty(0, dtype=np.int64)
    width = min(n, len(words))
    runs = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        runs = runs * _ODD + words[i : len(words) - width + 1 + i]
    return np.unique(mix64(runs), return_index=True)


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def narrow(df: DataFrame, *columns: str) -> DataFrame:
    """The columns an operator works on under its own names c0, c1, ..; extra ones are left out."""
    return df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])


def rows_batch(rows: list[tuple], ddl: str):
    """Arrow batch of Python rows; ``ddl`` as given to Spark, e.g. ``"id long, text string"``."""
    import pyarrow as pa

    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [f.split() for f in ddl.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    arrays = [pa.array(c, type=kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def columns_of(batch) -> list[list]:
    """Python values of an Arrow batch, column by column."""
    return [c.to_pylist() for c in batch.columns]

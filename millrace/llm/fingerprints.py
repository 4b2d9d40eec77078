"""Document fingerprints: threshold-scaled sketches.

A text is cut into overlapping runs of ``SHINGLE`` characters (lower-cased, white space folded to
single blanks). Every run is hashed to 48 bits and every hash under a fixed fraction of that
range is kept, so sketches of very unequal texts can be merged and compared: both hold the same
sample of the shared runs. Short texts would keep too few that way; a text with fewer than
``FLOOR`` hashes under the bound raises its own bound until it has that many, or all. Two
sketches are compared under the lower of their bounds.

Written form: number of kept hashes, bound and kept hashes in rising order, as hexadecimal,
``<bound>:<hash><hash>..``. Bound and hashes have 13 and 12 digits.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import code_points, columns_of, mix64, partitions, rows_batch, stage

SHINGLE = 12
FRACTION = 1 / 16
FLOOR = 128
SPACE = 1 << 48

Sketch = tuple[int, np.ndarray]


def sketch(text: str, fraction: float = FRACTION, floor: int = FLOOR) -> Sketch:
    """(bound, kept hashes); a text without characters other than white space keeps none."""
    clean = " ".join(text.lower().split())
    if not clean:
        return SPACE, np.empty(0, dtype=np.uint64)
    points = code_points(clean).astype(np.uint64)
    width = min(SHINGLE, len(points))
    runs = np.full(len(points) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        runs = runs * np.uint64(0x9E3779B97F4A7C15) + points[i : len(points) - width + 1 + i]
    hashes = mix64(runs) >> np.uint64(16)
    bound = int(SPACE * fraction)
    kept = np.unique(hashes[hashes < bound])
    if len(kept) < floor:
        every = np.unique(hashes)
        bound = SPACE if len(every) <= floor else int(every[floor])
        kept = every[:floor]
    return bound, kept


def written(s: Sketch) -> str:
    return f"{s[0]:013x}:" + s[1].astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex()


def parsed(fingerprint: str) -> Sketch:
    bound, _, digits = fingerprint.partition(":")
    raw = np.frombuffer(bytes.fromhex(digits), dtype=np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), dtype=np.uint8)
    wide[:, 2:] = raw
    return int(bound, 16), wide.view(">u8").ravel().astype(np.uint64)


def merged(a: Sketch, b: Sketch) -> Sketch:
    """The sketch of two texts taken together."""
    bound = min(a[0], b[0])
    every = np.union1d(a[1], b[1])
    return bound, every[every < bound]


def overlap(a: Sketch, b: Sketch) -> tuple[int, int, int]:
    """Kept hashes of a, of b and of both, under the lower bound."""
    bound = min(a[0], b[0])
    left, right = a[1][a[1] < bound], b[1][b[1] < bound]
    return len(left), len(right), len(np.intersect1d(left, right, assume_unique=True))


def likeness(a: Sketch, b: Sketch) -> float:
    """Estimated shared part of all runs, 0 to 1; two sketches without hashes are alike."""
    left, right, both = overlap(a, b)
    if not left and not right:
        return 1.0 if len(a[1]) == len(b[1]) else 0.0
    return both / (left + right - both)


def containment(a: Sketch, b: Sketch) -> float | None:
    """Estimated part of the runs of a that b has too; nothing is wholly contained.

    None where a has runs but none of their hashes lies under the common bound: the sketches do not
    tell. Under the bound of long texts, 1/16, that is so for 56 of 100 texts of 20 characters (9
    runs) and for fewer than 1 of 100 from 83 characters (72 runs) on.
    """
    left, _, both = overlap(a, b)
    if left:
        return both / left
    return None if len(a[1]) else 1.0


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One fingerprint per row: ``(id, fingerprint)``, in place, without a shuffle.

    Null and empty texts get the empty sketch; repeated rows give repeated results.
    """

    def run(batches):
        for b in batches:
            rows = [(i, written(sketch(t or ""))) for i, t in zip(*columns_of(b), strict=True)]
            yield rows_batch(rows, "id long, fingerprint string")

    rows = df.select(F.col(id_col).cast("long").alias("c0"), F.col(text_col).alias("c1"))
    return rows.mapInArrow(run, "id long, fingerprint string").withColumnRenamed("id", id_col)


def merged_fingerprints(df: DataFrame, by: str, fingerprint_col: str = "fingerprint") -> DataFrame:
    """One fingerprint per group. The lowest bound counts; hashes meet as distinct rows."""
    hashes = F.expr("filter(regexp_extract_all(digits, '.{12}', 0), h -> h < substring(bound, 2))")
    parts = df.select(
        F.col(by).alias("g"),
        F.substring(fingerprint_col, 1, 13).alias("own"),
        F.substring(fingerprint_col, 15, 2_000_000_000).alias("digits"),
    )
    bounds = parts.groupBy("g").agg(F.min("own").alias("bound"))
    whole = F.col("bound").startswith("1")
    every = F.expr("regexp_extract_all(digits, '.{12}', 0)")
    kept = (
        parts.join(bounds, parts.g.eqNullSafe(bounds.g)).drop(bounds.g)
        .select("g", "bound", F.explode_outer(F.when(whole, every).otherwise(hashes)).alias("h"))
        .distinct()
    )
    joined = F.array_join(F.sort_array(F.collect_set("h")), "")
    return kept.groupBy("g", "bound").agg(joined.alias("h")).select(
        F.col("g").alias(by), F.concat("bound", F.lit(":"), "h").alias("fingerprint")
    )


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, "
    "contained_edited double, contained_next double"
)


def _compared(doc_id, text: str, own: Sketch, following: str, next_sketch: Sketch) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    changed = sketch(edited)
    return (
        doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        written(own), written(changed), likeness(own, changed), likeness(own, next_sketch),
        containment(own, changed), containment(own, next_sketch),
    )


def compare_with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited form and the likeness to the next document.

    Rows are put in order of id, then text; null ids come first, a null text counts as empty and
    repeated rows are documents of their own. The last row is followed by the first. A single
    row is its own next document. An empty table gives no rows. ``contained_*`` is null where the
    sketches do not tell, see ``containment``.

    The rows are dealt by ranges of the id, once. The first text of a range is also sent to the range
    before it, where it follows the last one.
    """
    spark = df.sparkSession
    rows = df.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    n = 4 * partitions(spark)
    shares = [i / n for i in range(1, n)]
    cuts = np.unique(rows.agg(F.percentile_approx("id", shares, 20 * n)).first()[0] or []).astype(np.int64)

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        # a null id is in the first range
        found = np.searchsorted(cuts, ids.fillna(0).astype("int64").to_numpy(), side="left")
        return pd.Series(np.where(ids.isna(), 0, found).astype(np.int32))

    placed = rows.withColumn("bucket", bucket_of("id")).withColumn("guest", F.lit(0))
    place = F.struct(F.col("id").isNotNull(), "id", F.xxhash64("text"), "text")
    firsts = stage(
        placed.groupBy("bucket").agg(F.min(place).alias("first")).select("bucket", F.col("first.id").alias("id"), F.col("first.text").alias("text")),
        "range-firsts",
    )
    present = sorted(r["bucket"] for r in firsts.select("bucket").collect())
    if not present:
        return spark.createDataFrame([], RESULT)
    before = spark.createDataFrame([(b, present[i - 1]) for i, b in enumerate(present)], "bucket int, before int")
    guests = firsts.join(before, "bucket").select("id", "text", F.col("before").alias("bucket"), F.lit(1).alias("guest"))
    dealt = placed.unionByName(guests).repartition(partitions(spark), "bucket")
    ordered = dealt.sortWithinPartitions("bucket", "guest", "id", F.xxhash64("text"), "text")

    def run(batches):
        last = None
        for b in batches:
            out = []
            for bucket, guest, doc_id, text in zip(*columns_of(b), strict=True):
                own = sketch(text)
                if last is not None and last[0] == bucket:
                    out.append(_compared(*last[1:], text, own))
                last = None if guest else (bucket, doc_id, text, own)
            yield rows_batch(out, RESULT)

    return ordered.select("bucket", "guest", "id", "text").mapInArrow(run, RESULT)

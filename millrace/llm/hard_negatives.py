"""Hard negatives by a secondary sort: rows that score close to, but below, a true match.

An anchor's score with a row is the integer inner product of their scaled vectors. Each scored
pair becomes one packed key, (anchor, descending score, positive before negative, id), and
``repartitionAndSortWithinPartitions`` brings an anchor's keys together in that order. An iterator
reads the stream once: a positive opens a window of scores, a negative is emitted into every open
window that it fits and that is not full. It holds the open windows of one anchor, never its rows.

Anchors are scored in slabs of bounded bytes, which are broadcast; every task runs all its rows
past the slab in tiles. Before anything is shuffled a task keeps only what can be in the result: of
positives the best ``positives`` of each anchor, of negatives the best ``negatives`` of each window,
which the first sort has fixed. Any row that a task leaves out has that many better ones in
the task, so the result is that of all pairs.

Rows with a null label, a null vector, or a null or non-finite component take no part. Rows with a
null id are no anchors and come last among equal scores. Repeated rows are rows of their own: the copy
of an anchor is an anchor too, and a positive of the other. Missing components of shorter vectors
count as zero. Components and scores beyond 64 bits are held at their bound. An empty table gives no rows.
"""

import struct
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import partitions, scratch_dir, stage
from millrace.operators.numbering import with_row_numbers

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
SLAB_BYTES = 32_000_000
TILE = 512
HELD = 1_000_000
TOP = (1 << 63) - 1
_EXACT = 1 << 49
_COLUMNS = 1 << 14

KEY = ">QQQBBQ"
_FIELDS = np.dtype([("anchor", ">u8"), ("uid", ">u8"), ("score", ">u8"), ("kind", "u1"), ("no_id", "u1"), ("id", ">u8")])
_BIAS = np.uint64(1 << 63)
_HEAD = 16
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _biased(values: np.ndarray) -> np.ndarray:
    return values.astype(np.int64).view(np.uint64) ^ _BIAS


def pack(anchor, uid, score, kind: int, no_id, ids):
    """Arrow column of packed keys, whose byte order is the order of the stream."""
    import pyarrow as pa

    keys = np.empty(len(score), dtype=_FIELDS)
    keys["anchor"], keys["uid"] = _biased(anchor), uid
    keys["score"] = ~_biased(score)
    keys["kind"], keys["no_id"], keys["id"] = kind, no_id, _biased(ids)
    ends = np.arange(len(keys) + 1, dtype=np.int32) * _FIELDS.itemsize
    return pa.BinaryArray.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(ends), pa.py_buffer(keys.tobytes())])


def unpack(key: bytes) -> tuple:
    """``(anchor, uid, score, kind, id)``."""
    anchor, uid, score, kind, no_id, own = struct.unpack(KEY, key)
    return anchor - (1 << 63), uid, TOP - score, kind, None if no_id else own - (1 << 63)


def window(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Least and greatest score of a negative for a positive's score; empty below zero."""
    return -((-low * score) // 100), (high * score) // 100


def _matrix(column, width: int | None = None) -> np.ndarray:
    """Vectors of an Arrow list column as rows; shorter ones are filled up with zeros."""
    lengths = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), dtype=np.int64)
    most = int(lengths.max(initial=0))
    if (lengths == most).all():
        out = flat.reshape(len(lengths), most)
    else:
        out = np.zeros((len(lengths), most), dtype=np.int64)
        out[np.arange(most) < lengths[:, None]] = flat
    if width is None or width <= most:
        return out
    return np.pad(out, ((0, 0), (0, width - most)))


class Slab:
    """Anchors of one slab, and per anchor the windows (least, greatest) of its positives."""

    def __init__(self, table):
        table = table.combine_chunks()
        self.uid, self.ids, self.labels = (table[c].to_numpy() for c in ("uid", "id", "label"))
        self.vectors = _matrix(table["parts"].chunk(0)) if len(self.uid) else np.empty((0, 0), np.int64)
        self.windows = None

    def open(self, positives: list[bytes]) -> "Slab":
        """Note the windows of the positives that the first sort found; unused ones are empty."""
        place = {u: i for i, u in enumerate(self.uid.tolist())}
        found = {}
        for key in positives:
            _, uid, score, _, _ = unpack(key)
            found.setdefault(place[uid], set()).add(window(score))
        most = max(map(len, found.values()), default=0)
        self.windows = np.empty((most, len(self.uid), 2), dtype=np.int64)
        self.windows[:] = (1, 0)
        for i, bounds in found.items():
            self.windows[: len(bounds), i] = sorted(bounds)
        return self


def _scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles where these hold them, else in Python integers."""
    width = max(anchors.shape[1], rows.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (anchors, rows))
    peaks = [max(-int(x.min(initial=0)), int(x.max(initial=0))) for x in (a, b)]
    if width * peaks[0] * peaks[1] < _EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    exact = a.astype(object) @ b.T.astype(object) if width else np.zeros((len(a), len(b)), dtype=object)
    return np.clip(exact, -TOP, TOP).astype(np.int64)


def _best(scores: np.ndarray, fits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each line the k best fitting columns: higher scores first, then smaller columns."""
    count = scores.shape[1]
    if np.abs(scores).max(initial=0) < _EXACT:
        ranked = np.where(fits, scores * _COLUMNS + (_COLUMNS - 1 - np.arange(count)), -TOP)
        if count > k:
            ranked = np.partition(ranked, count - k, axis=1)[:, count - k :]
        line, at = np.nonzero(ranked > -TOP)
        return line, _COLUMNS - 1 - (ranked[line, at] & (_COLUMNS - 1))
    lines, columns = [], []
    for i in range(len(scores)):
        inside = np.flatnonzero(fits[i])
        chosen = inside[np.argsort(-scores[i, inside], kind="stable")[:k]]
        lines += [i] * len(chosen)
        columns += chosen.tolist()
    return np.array(lines, dtype=np.int64), np.array(columns, dtype=np.int64)


class Kept:
    """What a task keeps of its pairs: k of each anchor and window, pruned whenever it holds many."""

    def __init__(self, k: int):
        self.k, self.n, self.parts = k, 0, []

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.n += len(columns[0])
        if self.n > HELD:
            self.prune()

    def prune(self) -> tuple:
        """Columns: anchor's place, window, score, missing id, id, row."""
        if not self.parts:
            return (np.empty(0, dtype=np.int64),) * 6
        anchor, slot, score, no_id, ids, row = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.lexsort((ids, no_id, -score, slot, anchor))
        group = np.stack([anchor[order], slot[order]])
        first = np.flatnonzero(np.r_[True, (group[:, 1:] != group[:, :-1]).any(axis=0)])
        rank = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
        order = order[rank < self.k]
        columns = tuple(c[order] for c in (anchor, slot, score, no_id, ids, row))
        self.parts, self.n = [columns], len(order)
        return columns


def _candidates(slab, kind: int, k: int):
    """Task body: rows run past the slab in tiles; packed keys of what may be in the result."""

    def run(batches):
        import pyarrow as pa

        own, kept = slab.value, Kept(k)
        for whole in batches:
            for start in range(0, whole.num_rows, _COLUMNS):
                _score_batch(own, whole.slice(start, _COLUMNS), kind, k, kept)
        place, _, score, no_id, ids, row = kept.prune()
        # A row in several windows of one anchor is one key.
        place, _, score, no_id, ids = np.unique(np.stack([place, row, score, no_id, ids]), axis=1)
        if len(place):
            yield pa.RecordBatch.from_arrays([pack(own.ids[place], own.uid[place], score, kind, no_id, ids)], names=["key"])

    return run


def _score_batch(slab: Slab, batch, kind: int, k: int, kept: Kept) -> None:
    ids = batch.column("id")
    no_id = np.asarray(ids.is_null())
    ids = np.asarray(ids.fill_null(0))
    order = np.lexsort((ids, no_id))
    ids, no_id = ids[order], no_id[order].astype(np.int64)
    labels, uid = (np.asarray(batch.column(c))[order] for c in ("label", "uid"))
    vectors = _matrix(batch.column("parts"))[order]
    for start in range(0, len(slab.uid), TILE):
        tile = slice(start, start + TILE)
        scores = _scores(slab.vectors[tile], vectors)
        same = slab.labels[tile, None] == labels
        if kind:
            fits = [~same & (scores >= w[tile, :1]) & (scores <= w[tile, 1:]) for w in slab.windows]
        else:
            _, i, j = np.intersect1d(slab.uid[tile], uid, return_indices=True)
            same[i, j] = False
            fits = [same]
        for slot, fit in enumerate(fits):
            line, column = _best(scores, fit, k)
            kept.add(line + start, np.full(len(line), slot), scores[line, column], no_id[column], ids[column], uid[column])


def secondary_sort(keys: DataFrame, read):
    """Packed keys, each anchor's in one partition and in order, through an iterator ``read``."""
    parts = partitions(keys.sparkSession)
    pairs = keys.rdd.map(lambda row: (bytes(row[0]), None))
    return pairs.repartitionAndSortWithinPartitions(parts, lambda key: zlib.crc32(key[:_HEAD])).mapPartitions(read)


def first_positives(limit: int):
    """Iterator: the first keys of each anchor."""

    def read(stream):
        anchor, seen = None, 0
        for key, _ in stream:
            if key[:_HEAD] != anchor:
                anchor, seen = key[:_HEAD], 0
            if seen < limit:
                seen += 1
                yield (key,)

    return read


def windows_of(positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH):
    """Iterator: positives open windows, negatives are emitted into those they fit."""

    def read(stream):
        anchor, opened = None, []
        for key, _ in stream:
            if key[:_HEAD] != anchor:
                anchor, opened = key[:_HEAD], []
            anchor_id, _, score, kind, own = unpack(key)
            if kind == 0:
                if len(opened) < positives:
                    opened.append([*window(score, low, high), own, score, 0])
                continue
            for w in opened:
                if w[0] <= score <= w[1] and w[4] < negatives:
                    w[4] += 1
                    yield (anchor_id, w[2], w[4], own, w[3], score)

    return read


def prepared(df: DataFrame, id_col: str, vec_col: str, label: Column, scale: int) -> DataFrame:
    """``(id, label, uid, parts)`` of the rows that take part, written once.

    Every row meets a fiftieth of all rows, so rows are spread over the tasks whatever the files.
    """
    vector = F.col(f"`{vec_col}`")
    sound = label.isNotNull() & vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    rows = df.where(sound).select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("parts"),
    )
    return stage(
        rows.repartition(partitions(df.sparkSession)).withColumn("uid", F.monotonically_increasing_id()), "vectors"
    )


def mine(
    df: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE,
    label: Column | None = None, id_col: str = "vec_id", vec_col: str = "embedding", slab_bytes: int = SLAB_BYTES,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the rows whose id ``every`` divides; ``label`` is the column of that name unless given.
    """
    spark = df.sparkSession
    rows = prepared(df, id_col, vec_col, F.col("label") if label is None else label, scale)
    numbered = with_row_numbers(rows.where(F.col("id") % every == 0), ["uid"], "number")
    n_anchors, width = numbered.agg(F.count("*"), F.max(F.size("parts"))).first()
    in_slab = max(1, slab_bytes // (8 * ((width or 0) + 4)))
    written = []
    for start in range(0, n_anchors, in_slab):
        anchors = Slab(numbered.where(F.col("number").between(start, start + in_slab - 1)).drop("number").toArrow())
        slab = spark.sparkContext.broadcast(anchors)
        keys = rows.mapInArrow(_candidates(slab, 0, positives), "key binary")
        found = stage(spark.createDataFrame(secondary_sort(keys, first_positives(positives)), "key binary"), "positives")
        # At most ``positives`` keys for each anchor of the slab.
        opened = spark.sparkContext.broadcast(anchors.open([bytes(r[0]) for r in found.collect()]))
        keys = found.unionByName(rows.mapInArrow(_candidates(opened, 1, negatives), "key binary"))
        result = spark.createDataFrame(secondary_sort(keys, windows_of(positives, negatives)), RESULT)
        written.append(scratch_dir(spark, "hard-negatives"))
        result.write.parquet(written[-1])
        slab.unpersist()
        opened.unpersist()
    return spark.read.schema(RESULT).parquet(*written) if written else spark.createDataFrame([], RESULT)

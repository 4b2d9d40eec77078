"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

Features are the distinct n-grams of 3 to 5 characters within blank-framed, lower-cased words,
hashed into ``2**BITS`` places. On the labelled rows every place gets the log of the ratio of
its smoothed document counts in either class. Places whose ratio is within ``MIN_Z`` standard errors of
the classes' own ratio tell nothing and are left out. Logistic regression with a squared
penalty is then fitted on features of the size of their ratio.

Fitting uses at most ``MAX_ROWS`` labelled rows of each class, those with the smallest MD5 of
their id; the intercept is corrected for the share of the classes among all labelled rows. Places are counted
in tasks, and only those that tell the classes apart reach the driver, whatever the length of the texts.
Scoring covers every row, in place.
"""

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import code_points, columns_of, mix64, rows_batch, stage

BITS = 20
SIZES = (3, 4, 5)
MAX_ROWS = 2000
MIN_Z = 3.5
STEPS, RATE, PENALTY = 200, 0.5, 1e-3
_ODD = np.uint64(0x9E3779B97F4A7C15)
PLACES = "label_id long, toxic int, places binary"
COUNTS = "place int, yes long, no long"


def features(text: str | None) -> np.ndarray:
    """Places of all n-grams, with repeats. Blank texts have none."""
    words = (text or "").lower().split()
    if not words:
        return np.empty(0, dtype=np.int32)
    points = code_points(" " + " ".join(words) + " ").astype(np.uint64)
    blank = points == 32
    found = []
    for n in SIZES:
        m = len(points) - n + 1
        if m <= 0:
            continue
        runs, crosses = np.full(m, n, dtype=np.uint64), np.zeros(m, dtype=bool)
        for i in range(n):
            runs = runs * _ODD + points[i : m + i]
            if 0 < i < n - 1:
                crosses |= blank[i : m + i]
        found.append(mix64(runs[~crosses]) >> np.uint64(64 - BITS))
    return np.concatenate(found).astype(np.int32) if found else np.empty(0, dtype=np.int32)


def fold(doc_id) -> int:
    """The number of the held-out fold is 0, of five."""
    return zlib.crc32(str(doc_id).encode()) % 5


def _ordered(column):
    return F.md5(F.coalesce(F.col(column).cast("string"), F.lit("")))


class Model:
    """Weight of each place and intercept; ``weights`` is ``2**BITS`` floats, whatever the input."""

    def __init__(self, weights: np.ndarray, intercept: float, known: bool = True):
        self.weights, self.intercept, self.known = weights, intercept, known

    def score(self, text: str | None) -> float:
        places = features(text)
        hit = np.unique(places[self.weights[places] != 0])
        margin = self.intercept + float(self.weights[hit].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))


def fit_rows(rows: list[np.ndarray], toxic: np.ndarray, prior: float) -> Model:
    """Fit on lists of distinct places; ``prior`` is the share of toxic rows overall."""
    places, own = 1 << BITS, np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    index = np.concatenate(rows)
    yes, no = toxic.sum(), len(toxic) - toxic.sum()
    a = np.bincount(index[toxic[own]], minlength=places)
    b = np.bincount(index[~toxic[own]], minlength=places)
    ratio = np.log((a + 1) / (yes + 2)) - np.log((b + 1) / (no + 2))
    keep = np.abs(ratio) >= MIN_Z * np.sqrt(1 / (a + 1) + 1 / (b + 1))
    numbers = np.cumsum(keep) - 1
    inside = keep[index]
    column, row = numbers[index[inside]], own[inside]
    value = ratio[keep][column]
    y, w, bias = toxic.astype(float), np.zeros(int(keep.sum())), 0.0
    # Adagrad keeps the steps stable whatever the scale of the ratios.
    seen, seen_bias = np.full(len(w), 1e-8), 1e-8
    for _ in range(STEPS):
        margin = np.bincount(row, weights=w[column] * value, minlength=len(y)) + bias
        error = (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y) / len(y)
        slope = np.bincount(column, weights=error[row] * value, minlength=len(w)) + PENALTY * w
        seen, seen_bias = seen + slope**2, seen_bias + error.sum() ** 2
        w = w - RATE * slope / np.sqrt(seen) if len(w) else w
        bias -= RATE * error.sum() / np.sqrt(seen_bias)
    weights = np.zeros(places, dtype=np.float32)
    weights[keep] = w * ratio[keep]
    return Model(weights, bias + np.log(prior / (1 - prior)) - np.log(yes / no))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS
) -> Model:
    """Learn ``labels.toxic`` (0 or 1; other values and null are no labels) from the texts.

    Rows with ``crc32(id) % 5 == 0`` are never learned from. A label without a text, or the other
    way round, is left out. If a class has no row, every score is that of the other class.
    """
    given = (
        labels.select(F.col(id_col).cast("long").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("toxic in (0, 1) and label_id is not null")
        .where(F.crc32(F.col("label_id").cast("string").cast("binary")) % 5 != 0)
        .distinct()
    )
    share = {r["toxic"]: r["n"] for r in given.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not share.get(0) or not share.get(1):
        return Model(np.zeros(1 << BITS, np.float32), 30.0 if share.get(1) else -30.0, False)
    first = [given.where(F.col("toxic") == c).orderBy(_ordered("label_id"), "label_id").limit(max_rows) for c in (0, 1)]
    # At most 2 * max_rows pairs of numbers, so this side may be broadcast.
    chosen = F.broadcast(first[0].unionByName(first[1]))
    texts = docs.select(F.col(id_col).cast("long").alias("label_id"), F.col(text_col).alias("text"))

    def places(batches):
        for b in batches:
            rows = [(i, c, np.unique(features(t)).tobytes()) for i, t, c in zip(*columns_of(b), strict=True)]
            yield rows_batch(rows, PLACES)

    rows = stage(texts.join(chosen, "label_id").mapInArrow(places, PLACES), "toxic-places")
    held = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(held) < 2:
        return Model(np.zeros(1 << BITS, np.float32), 30.0 if held.get(1) else -30.0, False)
    telling = _telling(rows, held)

    def narrowed(batches):
        for b in batches:
            ids, toxic, found = columns_of(b)
            kept = [np.intersect1d(np.frombuffer(p, np.int32), telling, assume_unique=True).tobytes() for p in found]
            yield rows_batch(list(zip(ids, toxic, kept, strict=True)), PLACES)

    few = rows.mapInArrow(narrowed, PLACES).collect()
    few.sort(key=lambda r: (r["label_id"], r["toxic"], bytes(r["places"])))
    toxic = np.array([r["toxic"] == 1 for r in few], dtype=bool)
    return fit_rows([np.frombuffer(r["places"], np.int32) for r in few], toxic, share[1] / (share[0] + share[1]))


def _telling(rows: DataFrame, held: dict[int, int]) -> np.ndarray:
    """The places that tell the classes apart, in order; at most ``2**BITS`` numbers reach the driver.

    Every task counts its rows by place and class, Spark adds the counts up and leaves out the rest.
    """

    def counted(batches):
        counts = np.zeros((2, 1 << BITS), dtype=np.int64)
        for b in batches:
            _, toxic, found = columns_of(b)
            for c, p in zip(toxic, found, strict=True):
                counts[c][np.frombuffer(p, np.int32)] += 1
        some = np.flatnonzero(counts.sum(axis=0))
        yield rows_batch(list(zip(some.tolist(), counts[1][some].tolist(), counts[0][some].tolist(), strict=True)), COUNTS)

    sums = rows.mapInArrow(counted, COUNTS).groupBy("place").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    a, b = F.col("yes") + 1, F.col("no") + 1
    ratio = F.log(a / (held[1] + 2)) - F.log(b / (held[0] + 2))
    # The fit draws the line itself; a little below it nothing is lost to rounding.
    near = F.abs(ratio) >= (MIN_Z - 1e-6) * F.sqrt(1 / a + 1 / b)
    return np.array(sorted(r["place"] for r in sums.where(near).select("place").collect()), dtype=np.int32)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row, null ids and empty texts too.

    A text without features gets the intercept alone. A null id counts as the text ''.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            rows = [(i, out, held.value.score(t)) for i, out, t in zip(*columns_of(b), strict=True)]
            yield rows_batch(rows, "doc_id long, held_out boolean, score double")

    key = F.col(id_col).cast("long")
    rows = docs.select(
        key.alias("doc_id"),
        (F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that the classifier does not reject, with their own columns, in place.

    Rows are judged one by one by their text: null ids, repeated rows and further columns make no
    difference, a null or blank text is judged by the intercept alone. An empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            kept = [held.value.score(t) < 0.5 for t in b.column(place).to_pylist()]
            yield b.filter(pa.array(kept, type=pa.bool_()))

    place = docs.columns.index(text_col)
    return docs.mapInArrow(run, docs.schema)

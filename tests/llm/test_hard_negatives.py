"""Hard negatives against all pairs in plain Python: ties, repeats, odd vectors, small slabs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import hard_negatives as hard
from millrace.llm.queries import op12_hard_negatives

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"
TOP = 2**63 - 1


def brute(rows, every=50):
    def whole(x):
        return max(-(2**63), min(TOP, math.floor(256 * x)))

    live = []
    for own, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        live.append((own, [whole(x) for x in vector], label))
    out = []
    for i, (anchor, a, label) in enumerate(live):
        if anchor is None or anchor % every:
            continue
        scored = []
        for j, (own, b, other) in enumerate(live):
            if i != j:
                score = max(-TOP, min(TOP, sum(x * y for x, y in zip(a, b, strict=False))))
                scored.append((-score, own is None, own or 0, own, other == label))
        scored.sort(key=lambda s: s[:3])
        for minus, _, _, positive, _ in [s for s in scored if s[4]][:5]:
            fits = [s for s in scored if not s[4] and 50 * -minus <= 100 * -s[0] <= 95 * -minus]
            out += [(anchor, positive, rank, s[3], -minus, -s[0]) for rank, s in enumerate(fits[:3], 1)]
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: [(v is None, v or 0) for v in r])


def mined(spark, rows, **named):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("id", "uid", "parts", "key", "number", "anchor_id"):
        frame = frame.withColumn(name, F.lit("x"))
    return ordered(hard.mine(frame, **named).collect())


def vectors(n, labels=4, dims=6, seed=3):
    rng = random.Random(seed)
    grid = [x / 4 for x in range(-4, 9)]
    return [(i, [rng.choice(grid) for _ in range(dims)], rng.randrange(labels)) for i in range(n)]


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    moved = [(i, v, (x + 1) % 10 if i % 7 == 0 else x) for i, v, x in rows]
    got = ordered(op12_hard_negatives(spark, SF).collect())
    assert got == ordered(brute(moved)) and len(got) > 20


def test_ties_and_repeats(spark):
    rows = vectors(220)
    rows += [rows[0], rows[0], rows[50], rows[7], *rows[20:40]]
    rows += [(500 + i, rows[3][1], 9) for i in range(30)]
    assert mined(spark, rows) == ordered(brute(rows))


def test_odd_rows(spark):
    rows = vectors(120)
    rows += [(None, rows[1][1], 1), (None, rows[2][1], 2), (None, rows[1][1], 1)]
    rows += [(150, None, 1), (200, [1.0, None], 1), (250, [float("nan")] * 6, 1), (300, [float("inf")] * 6, 1), (350, [1.0] * 6, None)]
    rows += [(400, [], 1), (-50, [0.5, 0.25], 2), (-100, [0.0] * 6, 3), (450, [1.0] * 9, 2), (451, [-1.0] * 6, 2)]
    assert mined(spark, rows) == ordered(brute(rows))


def test_scores_at_zero(spark):
    rows = [(0, [1.0, 0.0], 1), (9, [0.0, 1.0], 1), (3, [0.0, 2.0], 2), (4, [0.0, 3.0], 2), (5, [1.0, 0.0], 2), (6, [-1.0, 0.0], 2)]
    assert mined(spark, rows) == [(0, 9, 1, 3, 0, 0), (0, 9, 2, 4, 0, 0)]


@pytest.mark.parametrize("size", [1e6, 1e15, 1e30])
def test_large_components(spark, size):
    rows = [(i, [x * size for x in v], label) for i, v, label in vectors(110, dims=3)]
    frame = [(i, [float(__import__("numpy").float32(x)) for x in v], label) for i, v, label in rows]
    assert mined(spark, rows) == ordered(brute(frame))


def test_slabs_give_one_result(spark):
    rows = vectors(400, labels=3)
    assert mined(spark, rows, every=10, slab_bytes=1000) == ordered(brute(rows, 10))


def test_hot_label_and_hot_vector(spark):
    rows = [(i, v, 0 if i % 3 else label) for i, v, label in vectors(400)]
    rows += [(1000 + i, rows[9][1], i % 2) for i in range(300)]
    assert mined(spark, rows) == ordered(brute(rows))


def test_a_task_prunes_what_it_holds(spark, monkeypatch):
    monkeypatch.setattr(hard, "HELD", 50)
    kept = hard.Kept(2)
    import numpy as np

    rng = np.random.default_rng(1)
    columns = [rng.integers(0, m, 2000) for m in (5, 3, 40, 2, 500)] + [np.arange(2000)]
    for i in range(0, 2000, 10):
        kept.add(*[c[i : i + 10] for c in columns])
    best = {}
    for row in zip(*columns, strict=True):
        best.setdefault(row[:2], []).append((-row[2], row[3], row[4]))
    got = kept.prune()
    assert len(got[0]) <= 30
    have = {}
    for row in zip(*got, strict=True):
        have.setdefault(row[:2], []).append((-row[2], row[3], row[4]))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v)[:2] for k, v in best.items()}


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1)], [(50, [1.0], 1)], [(50, [1.0], 1), (51, [1.0], 1)]])
def test_nothing_to_mine(spark, rows):
    assert mined(spark, rows) == []


def test_keys_sort_as_the_stream():
    import numpy as np

    n = 300
    rng = np.random.default_rng(2)
    anchor, score = rng.integers(-3, 3, n), rng.integers(-4, 4, n) * 10**17
    ids, no_id = rng.integers(-5, 5, n), rng.integers(0, 2, n)
    keys = hard.pack(anchor, np.zeros(n, np.int64), score, 1, no_id, ids).to_pylist()
    there = sorted(range(n), key=lambda i: (anchor[i], -score[i], no_id[i], ids[i]))
    assert sorted(keys) == [keys[i] for i in there]
    assert [hard.unpack(k)[0] for k in keys] == anchor.tolist()
    assert [hard.unpack(k)[2] for k in keys] == score.tolist()

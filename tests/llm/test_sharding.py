"""Shards: the permutation against plain Python, the laws, both directions, odd rows."""

import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import sharding
from millrace.llm.queries import op13_sharding
from millrace.llm.sharding import Permutation

SF = "/root/testdata/sf0.001"


def plain(number, shuffle):
    """The network on Python integers, one number at a time."""
    while True:
        left, right = number >> shuffle.half, number & shuffle.mask
        for key in shuffle.keys:
            x = ((right ^ key) * sharding.FIRST) % 2**32
            x ^= x >> 15
            x = (x * sharding.SECOND) % 2**32
            left, right = right, left ^ ((x ^ (x >> 13)) & shuffle.mask)
        number = (left << shuffle.half) | right
        if number < shuffle.n:
            return number


def brute(docs, shards=16, seed=42):
    """(id, size, crc, shard, slot) of (id, text) rows."""
    rows = []
    for doc_id, text in docs:
        data = (text or "").encode()
        rows.append((doc_id is not None, doc_id or 0, 0 if text is None else len(data), zlib.crc32(data), doc_id))
    shuffle = Permutation(len(rows), seed)
    out = []
    for i, (_, _, size, crc, doc_id) in enumerate(sorted(rows)):
        at = plain(i, shuffle)
        out.append((doc_id, size + 1, crc, "rows", at % shards, at // shards, None))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: [(v is not None, v or 0) for v in r if not isinstance(v, str)])


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 64, 65, 1000, 4097])
def test_permutation(n):
    shuffle = Permutation(n, 7)
    numbers = np.arange(n)
    there = shuffle.forward(numbers)
    assert sorted(there.tolist()) == list(range(n))
    assert (shuffle.backward(there) == numbers).all()
    assert there.tolist() == [plain(i, shuffle) for i in range(n)]


def test_permutation_of_a_large_table():
    n = 10**13
    shuffle = Permutation(n, 1)
    numbers = np.random.default_rng(1).integers(0, n, 5000)
    there = shuffle.forward(numbers)
    assert (there < n).all() and (shuffle.backward(there) == numbers).all()
    spread = np.bincount((there % 16).astype(int), minlength=16)
    assert spread.min() > 230 and spread.max() < 400


def test_place_and_row_are_inverse():
    shuffle = Permutation(100, 3)
    places = {shuffle.place(i, 7): i for i in range(100)}
    assert len(places) == 100
    assert all(shuffle.row(shard, slot, 7) == i for (shard, slot), i in places.items())
    with pytest.raises(IndexError):
        shuffle.row(6, 14, 7)


def test_seeds_differ():
    a, b = (Permutation(1000, s).forward(np.arange(1000)) for s in (1, 2))
    assert (a == b).sum() < 20


def test_query(spark, sf_docs):
    got = op13_sharding(spark, SF).collect()
    assert ordered(got) == ordered(brute([(i, r["text"]) for i, r in sf_docs.items()]))
    assert set(op13_sharding(spark, SF).collect()) == set(got)
    counts = Counter(r["shard"] for r in got)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))


def test_odd_rows(make_docs):
    docs = [(i, f"text {i}") for i in range(40)]
    docs += [(None, "a"), (None, None), (None, "a"), (3, "text 3"), (3, None), (4, ""), (-5, "ü" * 1000), (2**60, "x" * 200_000)]
    assert ordered(sharding.assign(make_docs(*docs)).collect()) == ordered(brute(docs))


def test_one_id_for_all_rows(make_docs, spark):
    docs = [(None, f"t{i % 50}") for i in range(300)]
    frame = make_docs(*docs)
    assert ordered(sharding.assign(frame, shards=7, seed=1).collect()) == ordered(brute(docs, 7, 1))


@pytest.mark.parametrize("docs", [[], [(1, "one")]])
def test_small_tables(make_docs, docs):
    assert ordered(sharding.assign(make_docs(*docs)).collect()) == ordered(brute(docs))


def test_written_shards(spark, make_docs, tmp_path):
    docs = [(i % 90 if i % 10 else None, f"text {i}") for i in range(200)]
    frame = make_docs(*docs).withColumnsRenamed({"h": "shard", "part": "slot"})
    sharding.write_shards(frame, str(tmp_path / "out"), shards=5)
    back = spark.read.parquet(str(tmp_path / "out"))
    got = [(r["doc_id"], r["shard"], r["slot"]) for r in back.collect()]
    assert sorted(got, key=str) == sorted([(r[0], r[4], r[5]) for r in brute(docs, 5)], key=str)
    assert {"text", "lang", "source", "uid"} <= set(back.columns)
    assert sorted(r["text"] for r in back.collect()) == sorted(t for _, t in docs)

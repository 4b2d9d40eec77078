import random
import re

import numpy as np
import pytest

from millrace.llm import ngram_join
from millrace.llm.components import components
from millrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def gram_set(text, n):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(texts, n=3, percent=90):
    """{id: (n_shingles, component)} for {id: text}"""
    sets, parent = {i: gram_set(t, n) for i, t in texts.items()}, {i: i for i in texts}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    ids = sorted(texts)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_copies(words, n=60, length=120):
    """Copies of three texts with zero to a few changed words: similarities around the bounds."""
    rng, out = random.Random(1), {}
    for i in range(n):
        w = words(length + 40 * (i % 3), i % 3).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            w[rng.randrange(len(w))] = f"new{i}{rng.random()}"
        out[i * 7 + 3] = " ".join(w)
    return out


def result(df, **named):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(df, **named).collect()}


def test_query(spark, sf_docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op4_ngram_join"](spark, SF).collect()}
    assert got == brute({i: r["text"] for i, r in sf_docs.items()})


@pytest.mark.parametrize("rows, grams, cells", [(2048, 2_000_000, 4_000_000), (7, 900, 5_000)])
def test_near_copies(make_docs, words, monkeypatch, rows, grams, cells):
    """Also with blocks so small that groups are cut into parts and columns into steps."""
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", rows)
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", grams)
    monkeypatch.setattr(ngram_join, "CELLS", cells)
    texts = near_copies(words)
    assert len({c for _, c in brute(texts).values()}) > 6
    assert result(make_docs(*texts.items())) == brute(texts)
    assert result(make_docs(*texts.items()), words=5, percent=80) == brute(texts, 5, 80)


def test_odd_rows(make_docs, words):
    long = words(30_000, 2)
    texts = {
        5: None, 6: "", 7: " \t\n", 8: "one", 9: "ONE", 10: "one two", 11: "two one", 12: "one two three", 13: "é one",
        14: long, 15: long + " end", 16: "a a a a a a a", 17: "A a a", 18: None, 19: "one\x0btwo", 20: "one two",
    }
    assert result(make_docs(*texts.items())) == brute(texts)
    rows = ngram_join.join(make_docs((None, "one two"), (3, "one two"), (3, "one two"), (None, None))).collect()
    key = lambda r: (r[0] or -1, r[1])
    assert sorted((tuple(r) for r in rows), key=key) == [(None, 0, None), (None, 1, None), (3, 1, 3), (3, 1, 3)]
    assert ngram_join.join(make_docs((3, "a")).limit(0)).collect() == []


def test_rows_with_one_id_are_one_document(make_docs):
    rows = ngram_join.join(make_docs((1, "a b c"), (2, "a b c"), (2, "d e f"), (3, "d e f"))).collect()
    assert {r["component_id"] for r in rows} == {1}


def test_one_of_each(make_docs, words):
    texts = near_copies(words)
    docs = make_docs(*texts.items(), (None, "kept"))
    got = ngram_join.one_of_each(docs)
    assert got.columns == docs.columns
    ids = [r["doc_id"] for r in got.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for _, c in brute(texts).values()}) and None in ids


def test_one_of_each_keeps_one_row_of_an_id_and_text(make_docs):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(1, a), (1, a), (1, a, "later"), (1, b), (2, b), (2, b), (3, "own words"), (None, a), (None, a), (4, None), (4, None)]
    got = ngram_join.one_of_each(make_docs(*rows))
    assert got.columns == make_docs(*rows).columns
    left = sorted(((r["doc_id"], r["text"], r["source"]) for r in got.collect()), key=str)
    assert left == sorted([(1, a, "later"), (1, b, "s"), (3, "own words", "s"), (None, a, "s"), (None, a, "s"), (4, None, "s")], key=str)


def test_product_against_sets():
    rng = random.Random(4)
    base = [rng.sample(range(300), 60) for _ in range(3)]
    sets = [np.unique(np.array(rng.sample(base[i % 3], 55 + i % 5) + [1000 + i], dtype=np.uint64)) for i in range(40)]
    every = np.arange(40)
    both = lambda i, j: len(np.intersect1d(sets[i], sets[j]))
    want = {(i, j) for i in range(40) for j in range(i) if 100 * both(i, j) >= 85 * (len(sets[i]) + len(sets[j]) - both(i, j))}
    assert want and {(j, i) for i, j in ngram_join.product_links(sets, every, every, 85)} == want
    halves = ngram_join.product_links(sets, every[:20], every[20:], 85)
    assert {(j, i) for i, j in halves} == {p for p in want if p[0] >= 20 > p[1]}


def test_components_of_a_chain_and_a_star(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (9, 8), (8, 9)]
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(101, 161)} | {i: 500 for i in range(501, 560)} | {9: 8}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []

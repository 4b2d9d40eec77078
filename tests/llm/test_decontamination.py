import random

from millrace.llm import decontamination as dc
from millrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def least_distance(pattern, text):
    """Least edit distance of the pattern to any part of the text, by the full table."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        before, row = row, [0]
        for i, p in enumerate(pattern, 1):
            row.append(min(before[i] + 1, row[-1] + 1, before[i - 1] + (p != c)))
        best = min(best, row[-1])
    return best


def distance(a, b):
    row = list(range(len(a) + 1))
    for n, c in enumerate(b, 1):
        before, row = row, [n]
        for i, p in enumerate(a, 1):
            row.append(min(before[i] + 1, row[-1] + 1, before[i - 1] + (p != c)))
    return row[-1]


def brute(docs, items):
    out = set()
    for i, t in docs:
        for k, item in items:
            item, text = dc.folded(item or ""), dc.folded(t or "")
            if item and text and (d := least_distance(item, text)) <= len(item) // dc.CHARS_PER_ERROR:
                out.add((i, k, d))
    return out


def spoiled(text, edits, rng):
    for _ in range(edits):
        i = rng.randrange(len(text))
        text = rng.choice([text[:i] + text[i + 1 :], text[:i] + "q" + text[i:], text[:i] + "z" + text[i + 1 :]])
    return text


def items_of(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def test_query(spark, sf_docs):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = QUERIES["op6_decontamination"](spark, SF).collect()
    exact = {(i, k) for i, r in sf_docs.items() for k, t in items if dc.folded(t) in dc.folded(r["text"])}
    assert exact and exact <= {(r["doc_id"], r["item_id"]) for r in rows}
    short = [(i, r["text"]) for i, r in sf_docs.items() if len(r["text"]) < 1500][:15]
    got = {(r["doc_id"], r["item_id"], r["distance"]) for r in rows if r["doc_id"] in dict(short)}
    assert got == brute(short, items)


def test_passages_with_edits(spark, make_docs, words):
    rng = random.Random(1)
    items = [(k, words(8 + 3 * k, 100 + k)) for k in range(6)]
    docs = []
    for i in range(60):
        _, item = items[i % 6]
        budget = len(item) // dc.CHARS_PER_ERROR
        passage = spoiled(item, rng.randint(0, 2 * budget), rng)
        docs.append((i, f"{words(10, i)}  {passage.upper()}\n\n{words(10, i + 70)}"))
    rows = dc.find(make_docs(*docs), items_of(spark, *items)).collect()
    got = {(r["doc_id"], r["item_id"], r["distance"]) for r in rows}
    assert got == brute(docs, items) and 10 < len(got) < 60
    texts = dict(docs)
    for r in rows:
        part = dc.folded(texts[r["doc_id"]][r["start"] : r["end"]])
        assert distance(dc.folded(dict(items)[r["item_id"]]), part) == r["distance"]
    small = dc.find(make_docs(*docs), items_of(spark, *items), block_chars=50).collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, rows))


def test_odd_rows(spark, make_docs, words):
    long = words(30_000, 1)
    docs = make_docs((1, None), (2, ""), (None, "has the cat in it"), (4, "concatenate"), (5, long), (5, long), (6, "İ The  Cat é"))
    items = items_of(spark, (1, "the cat"), (2, None), (3, ""), (None, "cat"), (7, " ".join(long.split()[-30:])), (1, "the cat"))
    got = sorted((r["doc_id"] or 0, r["item_id"] or 0, r["start"], r["end"]) for r in dc.find(docs, items).collect())
    last = len(" ".join(long.split()[-30:]))
    assert got == [(0, 0, 8, 11), (0, 1, 4, 11), (5, 7, len(long) - last, len(long)), (5, 7, len(long) - last, len(long)), (6, 0, 7, 10), (6, 1, 2, 10)]
    assert dc.find(docs.limit(0), items).collect() == [] and dc.find(docs, items.limit(0)).collect() == []


def test_without_leaks(spark, make_docs):
    docs = make_docs((1, None), (2, "the cat sat"), (3, "a dog"), (None, "x"))
    got = dc.without_leaks(docs, items_of(spark, (1, "the cat"), (2, "bird")))
    assert got.columns == docs.columns and {r["doc_id"] for r in got.collect()} == {1, 3, None}
    assert dc.without_leaks(docs, items_of(spark)).count() == 4


def test_myers_against_the_table():
    rng = random.Random(9)
    for _ in range(300):
        pattern = "".join(rng.choices("abc", k=rng.randint(1, 90)))
        text = "".join(rng.choices("abc", k=rng.randint(0, 120)))
        d, start, end = dc.nearest(pattern, text)
        assert d == least_distance(pattern, text) == distance(pattern, text[start:end])

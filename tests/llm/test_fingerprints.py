import hashlib

import numpy as np

from millrace.llm import fingerprints as fp
from millrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def runs(text):
    clean = " ".join(text.lower().split())
    n = min(fp.SHINGLE, len(clean))
    return {clean[i : i + n] for i in range(len(clean) - n + 1)} if clean else set()


def true_likeness(a, b):
    a, b = runs(a), runs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(text, following):
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def check(rows, texts):
    """texts in order; rows by the same order"""
    assert len(rows) == len(texts)
    for i, (row, text) in enumerate(zip(rows, texts, strict=True)):
        following = texts[(i + 1) % len(texts)]
        changed = edited(text, following)
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert row["fingerprint"] == fp.written(fp.sketch(text))
        assert row["edited_fingerprint"] == fp.written(fp.sketch(changed))
        assert abs(row["near_edited"] - true_likeness(text, changed)) < 0.2
        assert abs(row["near_next"] - true_likeness(text, following)) < 0.2


def test_query(spark, sf_docs):
    rows = sorted(QUERIES["op1_fingerprints"](spark, SF).collect(), key=lambda r: r["doc_id"])
    check(rows, [sf_docs[r["doc_id"]]["text"] for r in rows])
    assert {r["doc_id"] for r in rows} == set(sf_docs)


def test_odd_rows(make_docs):
    long = "ab c" * 30_000
    docs = make_docs((5, None), (7, ""), (9, "x"), (11, " \n "), (12, long), (None, "first of all"), (20, "same é"), (21, "same é"))
    rows = {r["doc_id"]: r for r in fp.compare_with_next(docs).collect()}
    order = [None, 5, 7, 9, 11, 12, 20, 21]
    texts = ["first of all", "", "", "x", " \n ", long, "same é", "same é"]
    check([rows[k] for k in order], texts)
    assert rows[20]["near_next"] == 1.0 and rows[20]["fingerprint"] == rows[21]["fingerprint"]


def test_single_repeated_and_empty_tables(spark, make_docs):
    one = fp.compare_with_next(make_docs((3, "abc def"))).collect()
    assert one[0]["near_next"] == 1.0
    assert [r["doc_id"] for r in fp.compare_with_next(make_docs((3, "abc"), (3, "abc"))).collect()] == [3, 3]
    assert fp.compare_with_next(make_docs((3, "abc")).limit(0)).collect() == []


def test_written_form_merging_and_containment(words):
    big, small = words(20_000, 1), " ".join(words(20_000, 1).split()[:2000])
    a, b = fp.sketch(big), fp.sketch(small)
    for s in (a, b, fp.sketch("")):
        back = fp.parsed(fp.written(s))
        assert back[0] == s[0] and np.array_equal(back[1], s[1])
    assert fp.containment(b, a) > 0.97 and abs(fp.containment(a, b) - 0.1) < 0.03
    both = fp.merged(fp.sketch(words(20_000, 2)), a)
    assert fp.containment(a, both) == 1.0


def test_merged_by_group(spark, make_docs, words):
    texts = [words(9000, 3), words(50, 4), words(2000, 5), ""]
    single = fp.fingerprints(make_docs(*enumerate(texts))).collect()
    df = spark.createDataFrame([(1 if r["doc_id"] < 3 else None, r["fingerprint"]) for r in single], "g int, fingerprint string")
    got = {r["g"]: r["fingerprint"] for r in fp.merged_fingerprints(df, "g").collect()}
    want = fp.merged(fp.merged(fp.sketch(texts[0]), fp.sketch(texts[1])), fp.sketch(texts[2]))
    assert got == {1: fp.written(want), None: fp.written(fp.sketch(""))}


def test_containment_is_undecided_without_hashes_under_the_common_bound(words):
    text = words(20_000, 1)
    long, seen = fp.sketch(text), set()
    for start in range(0, 4000, 20):
        short = fp.sketch(text[start : start + 20])
        got = fp.containment(short, long)
        assert got == (1.0 if fp.overlap(short, long)[0] else None)
        seen.add(got)
    assert seen == {1.0, None} and fp.containment(fp.sketch(""), long) == 1.0
    row = fp._compared(1, text[:20], fp.sketch(text[:20]), text, long)
    assert row[-1] == fp.containment(fp.sketch(text[:20]), long)

import hashlib
import re
from collections import Counter

from millrace.llm import mixing
from millrace.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def brute(rows, weights=(5, 2, 1), share=1.5, most=2):
    """rows: (id, text, source) to {position: (size, source_size, target, taken)}"""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    key = [f"{'' if i is None else i}:{t or ''}" for i, t, _ in rows]
    h = [int(hashlib.md5(k.encode()).hexdigest()[:15], 16) for k in key]
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for n, r in zip(size, rows, strict=True) if r[2] == s) for s in sources}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    left, open_sources, target = share * sum(size), set(sources), {}
    while True:
        level = left / sum(weight[s] for s in open_sources) if open_sources else 0
        full = {s for s in open_sources if level * weight[s] > most * total[s]}
        if not full:
            break
        target |= {s: float(most * total[s]) for s in full}
        left, open_sources = left - sum(most * total[s] for s in full), open_sources - full
    target |= {s: level * weight[s] for s in open_sources}
    out = {}
    for s in sources:
        own = [i for i, r in enumerate(rows) if r[2] == s]
        copies = int(target[s] // total[s]) if total[s] else 0
        budget, through = target[s] - copies * total[s], 0
        for i in sorted(own, key=h.__getitem__):
            through += size[i]
            extra = through - size[i] / 2 <= budget
            out[i] = (size[i], total[s], target[s], size[i] * (copies + extra))
    return out


def check(got, rows):
    want = brute(rows)
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    got = sorted(((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in got), key=key)
    assert got == sorted(((rows[i][0], w[0], w[1], round(w[2], 6), w[3]) for i, w in want.items()), key=key)


def test_query(spark, sf_docs):
    got = QUERIES["op3_mixing"](spark, SF).collect()
    check(got, [(r["doc_id"], r["text"], r["source"]) for r in sf_docs.values()])


def test_query_matches_sql(spark):
    import duckdb

    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(db.execute(ORACLES["op3_mixing"]).fetchall())
    assert sorted(tuple(r) for r in QUERIES["op3_mixing"](spark, SF).collect()) == want


def test_odd_rows(make_docs, words):
    rows = [(i, words(i % 37, i), None if i % 5 == 0 else f"s{i % 4}") for i in range(200)]
    rows += [(300, None, "only nulls"), (301, "", "only nulls"), (302, " \n\t ", "s1"), (303, words(30_000, 3), "s2")]
    rows += [(7, words(7, 7), "s3"), (7, words(7, 7), "s3"), (None, "a b", "s1"), (None, None, None)]
    check(mixing.mix(make_docs(*rows)).collect(), rows)
    assert mixing.mix(make_docs((1, "a")).limit(0)).collect() == []
    assert [r["taken"] for r in mixing.mix(make_docs((1, None))).collect()] == [0]


def test_taken_words_are_near_the_target_and_nested(make_docs, words):
    docs = make_docs(*[(i, words(20, i), f"s{i % 3}") for i in range(600)])
    less, more = (mixing.mix(docs, share=s).collect() for s in (0.6, 0.9))
    for got in (less, more):
        for source in {r["target"] for r in got}:
            own = [r for r in got if r["target"] == source]
            assert abs(sum(r["taken"] for r in own) - source) <= 10
    taken = {r["doc_id"]: r["taken"] for r in more}
    assert all(r["taken"] <= taken[r["doc_id"]] for r in less if r["target"] <= 4000)


def test_mixed_documents(make_docs, words):
    docs = make_docs(*[(i, words(5, i), f"s{i % 4}") for i in range(100)])
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    times = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(docs).collect()}
    rows = [r["doc_id"] for r in got.collect()]
    assert {i: rows.count(i) for i in times} == times


def test_mixed_documents_with_null_and_repeated_ids(make_docs, words):
    rows = [(i, words(5, i), f"s{i % 4}") for i in range(60)] + [(None, words(6, 900 + i), f"s{i % 3}") for i in range(8)]
    rows += [(7, words(5, 7), "s3")] * 3 + [(8, words(5, 800 + i), None) for i in range(3)] + [(9, " \n", "s1"), (None, None, None)]
    docs = make_docs(*rows)
    times = Counter()
    for i, (size, *_, taken) in brute(rows).items():
        times[rows[i]] += taken // size if size else 0
    got = Counter((r["doc_id"], r["text"], r["source"]) for r in mixing.mixed_documents(docs).collect())
    assert got == +times and any(i is None for i, *_ in got) and 4 <= got[7, words(5, 7), "s3"] <= 8


def test_null_ids_and_copies_come_near_the_target(make_docs, words):
    """A source of null ids, one of equal rows, one of a repeated id: none falls as a whole."""
    rows = [(None, words(100, i), "a") for i in range(100)] + [(5, words(100, 5), "b")] * 100
    rows += [(9, words(100, 500 + i), "c") for i in range(100)]
    docs = make_docs(*rows)
    got = mixing.mix(docs, share=1.25).collect()
    check_rows = brute(rows, share=1.25)
    for target in {w[2] for w in check_rows.values()}:
        assert abs(sum(r["taken"] for r in got if r["target"] == target) - target) <= 50
    mixed = Counter(r["source"] for r in mixing.mixed_documents(docs, share=1.25).collect())
    want = Counter()
    for i, (size, *_, taken) in check_rows.items():
        want[rows[i][2]] += taken // size
    assert mixed == want

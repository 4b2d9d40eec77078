import zlib

import numpy as np

from millrace.llm import toxicity
from millrace.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def test_query_on_the_held_out_fold(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in QUERIES["op7_toxicity"](spark, sf).collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows.values():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(rows[i]["score"], t) for i, t in labels.items() if rows[i]["held_out"]]
    yes, no = ([s for s, t in held if t == c] for c in (1, 0))
    area = np.mean([np.mean([(a > b) + (a == b) / 2 for b in no]) for a in yes])
    right = np.mean([(s >= 0.5) == t for s, t in held])
    print(f"held out: {len(yes)} toxic, {len(no)} clean, area {area:.4f}, accuracy {right:.4f}")
    assert area > 0.97 and right > 0.97


def toy(make_docs, spark, words):
    texts = [(i, words(30, i) + (" you rotten gloop" if i % 3 == 0 else " you kind person")) for i in range(300)]
    odd = [(900, None), (901, ""), (902, "x"), (903, "rotten gloop " * 30_000), (None, "rotten gloop"), (903, "rotten gloop")]
    labels = [(i, 1, int(i % 3 == 0)) for i in range(300)] + [(5, None, None), (None, 1, 1), (7777, 1, 1), (6, 0, 9)]
    return make_docs(*texts, *odd), spark.createDataFrame(labels, LABELS)


def test_odd_rows(spark, make_docs, words):
    docs, labels = toy(make_docs, spark, words)
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(rows) == 306
    for r in rows:
        i = r["doc_id"]
        if i is not None and i < 300:
            assert r["predicted"] == (i % 3 == 0)
        elif i in (900, 901, 902):
            assert r["predicted"] == 0
        else:
            assert r["predicted"] == 1
    got = toxicity.without_toxic(docs, labels)
    assert got.columns == docs.columns and got.count() == 203
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, labels)).collect() == []


def test_labels_of_the_held_out_fold_do_not_matter(spark, make_docs, words):
    docs, labels = toy(make_docs, spark, words)
    turned = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(cast(doc_id AS string)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = (toxicity.fit(docs, x) for x in (labels, turned))
    assert np.array_equal(a.weights, b.weights) and a.intercept == b.intercept
    again = toxicity.fit(docs.repartition(7), labels.repartition(2))
    assert np.array_equal(a.weights, again.weights)


def test_bounded_sample_and_single_classes(spark, make_docs, words):
    docs, labels = toy(make_docs, spark, words)
    rows = toxicity.score(docs, toxicity.fit(docs, labels, max_rows=40)).collect()
    assert np.mean([r["predicted"] == (r["doc_id"] % 3 == 0) for r in rows if r["doc_id"] and r["doc_id"] < 300]) > 0.95
    for c in (0, 1):
        model = toxicity.fit(docs, labels.where(f"toxic = {c}"))
        assert {r["predicted"] for r in toxicity.score(docs, model).collect()} == {c}
    assert toxicity.fit(docs, labels.limit(0)).score("x") < 0.5


def test_features_keep_to_words():
    assert set(toxicity.features("ab cd")) == set(toxicity.features("cd \n AB"))
    assert len(toxicity.features("ab")) == 3 and not len(toxicity.features(" "))

import re

from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import decontamination, mixing, toxicity
from millrace.llm.common import stage

SF = "/root/testdata/sf0.001"


def five_grams(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        before = [r["doc_id"] for r in docs.collect()]
        texts = {r["doc_id"]: r["text"] for r in docs.collect()}
        given, docs = docs, step(spark, docs, SF).cache()
        after = [r["doc_id"] for r in docs.collect()]
        seen[name] = (before, after)
        assert set(after) <= set(before)
        if name == "token_files":
            assert sorted(after) == sorted(before)
            break
        assert docs.columns == columns
        if name == "toxicity":
            labels = spark.read.parquet(f"{SF}/labels.parquet")
            scores = toxicity.score(given, toxicity.fit(given, labels)).collect()
            assert set(after) == {r["doc_id"] for r in scores if not r["predicted"]}
        if name == "near_copies":
            sets, kept = {i: five_grams(texts[i]) for i in before}, []
            linked = lambda a, b: len(a & b) > 0 and 100 * len(a & b) >= 80 * len(a | b)
            group = {i: i for i in before}
            for i in sorted(before):
                for j in sorted(before):
                    if j < i and linked(sets[i], sets[j]) and group[i] != group[j]:
                        a, b = sorted((group[i], group[j]))
                        group = {k: a if g == b else g for k, g in group.items()}
            kept = {i for i, g in group.items() if i == g}
            assert set(after) == kept and len(kept) < len(before)
        if name == "benchmark_leaks":
            items = spark.read.parquet(f"{SF}/benchmark.parquet")
            leaks = {r["doc_id"] for r in decontamination.find(given, items).collect()}
            assert leaks and set(after) == set(before) - leaks
        if name == "source_mix":
            times = {r["doc_id"]: r["taken"] // r["size"] if r["size"] else 0 for r in mixing.mix(given).collect()}
            assert {i: after.count(i) for i in times} == times
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in whole) == sorted(seen["token_files"][1])
    assert corpus_pipeline.ORACLE_SQL is None


CLASHING = ("key", "node", "h", "uid", "c0", "toxic", "label_id", "leader", "__mix", "place")


def odd(spark, rows):
    """Documents with null ids and texts, repeats, clashing names and a map column."""
    base = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in CLASHING:
        base = base.withColumn(name, F.lit("x"))
    return base.withColumn("meta", F.create_map(F.lit("a"), F.col("lang"))).repartition(3)


def test_stages_on_odd_rows(spark, words):
    rows = [(i, words(40, i), "en", f"s{i % 3}", 5) for i in range(60)]
    rows += [(None, words(40, 200), "en", "s1", None), (None, None, None, None, None), (None, words(40, 200), "en", "s1", None)]
    rows += [(100, None, None, "s1", 1), (101, "", "en", None, 0), (102, " \n", "en", "s2", 2), (103, "one", "fr", "s2", 3)]
    rows += [rows[5]] * 3 + [(5, rows[5][1], "de", "s9", 7), (6, words(40, 300), "en", "s0", 5), (200, rows[7][1], "en", "s0", 5)]
    docs = odd(spark, rows)
    columns, seen = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF)
        if name == "token_files":
            break
        assert docs.columns == columns
        docs = stage(docs, f"odd-{name}")
        seen[name] = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert len(seen["toxicity"]) > 60 and (None, None) in seen["toxicity"]
    near = seen["near_copies"]
    assert near.count((5, rows[5][1])) == 1 and (200, rows[7][1]) not in near and (7, rows[7][1]) in near
    assert near.count((None, rows[60][1])) == 2 and (100, None) in near and (6, words(40, 300)) in near
    assert len(seen["benchmark_leaks"]) == len(near)
    mixed = seen["source_mix"]
    assert {i for i, _ in mixed} and all((t or "").strip() for _, t in mixed)
    files = docs.collect()
    assert sorted(str(r["doc_id"]) for r in files) == sorted(str(i) for i, _ in mixed)
    assert all(r["n_tokens"] > 1 for r in files)


def test_stages_on_an_empty_table(spark):
    docs = odd(spark, [])
    for name, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF)
        assert docs.collect() == [], name

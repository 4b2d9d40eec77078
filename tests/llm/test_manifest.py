"""The manifest against a tree built in plain Python, row by row; repeated ids, blocks, odd rows."""

import zlib
from collections import defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from millrace.llm import manifest
from millrace.llm.queries import op11_manifest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def root_and_paths(nodes):
    """Root of a list of digests, and for each the (before, after) of every level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            first = place - place % 2
            paths[i].append(("".join(nodes[first:place]), "".join(nodes[place + 1 : first + 2])))
            at[i] = place // 2
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def fold(value, path):
    for before, after in path:
        value = h(before, value, after)
    return value


def brute(rows):
    """Rows of (doc_id, text, lang, source, n_chars)."""
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        own = leaf(doc_id, source, lang, n_chars, text)
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        bad = leaf(doc_id, source, lang, None if n_chars is None else n_chars + 1, text) if hit else own
        groups[(lang is not None, (lang or "").encode())].append((doc_id is not None, doc_id or 0, own, bad, doc_id))
    order = sorted(groups)
    trees = [root_and_paths([r[2] for r in sorted(groups[g], key=lambda r: r[:3])]) for g in order]
    out = []
    root, over = root_and_paths([t[0] for t in trees]) if trees else (None, [])
    for g, (sub, paths), upper in zip(order, trees, over, strict=True):
        for (_, _, own, bad, doc_id), path in zip(sorted(groups[g], key=lambda r: r[:3]), paths, strict=True):
            path = path + upper
            got = fold(bad, path)
            out.append((doc_id, own, sub, root, h(*[a + b for a, b in path]), got, got == root))
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def audited(spark, rows):
    frame = spark.createDataFrame(rows, DOCS).repartition(3)
    for name in ("grp", "id", "leaf", "word", "bits", "slot", "size", "n", "start", "path", "digest"):
        frame = frame.withColumn(name, F.lit("x"))
    return ordered(manifest.audit(frame).collect())


def doc(i, lang="en", text=None, n=5):
    return (i, text or f"text {i}", lang, "s", n)


def test_query(spark, sf_docs):
    rows = [(i, r["text"], r["lang"], r["source"], r["n_chars"]) for i, r in sf_docs.items()]
    got = op11_manifest(spark, SF).collect()
    assert ordered(got) == ordered(brute(rows))
    hit = {i for i in sf_docs if zlib.crc32(str(i).encode()) % 7 == 0}
    assert {r["doc_id"] for r in got if not r["verified"]} == hit and hit


def test_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(manifest, "LEVELS", 2)
    rows = [doc(i * 3, "en") for i in range(77)] + [doc(i * 3 + 1, "de") for i in range(5)] + [doc(2, "fr")]
    rows += [doc(1000 + i, f"l{i}") for i in range(21)]
    assert audited(spark, rows) == ordered(brute(rows))


def test_edges_of_blocks(spark):
    rows = [doc(i, f"l{n}") for n in (1, 2, 3, 255, 256, 257, 513) for i in range(n)]
    assert audited(spark, rows) == ordered(brute(rows))


def test_scattered_ids(spark):
    ids = [-(2**63), -(2**62), -1, 0, 1, 63, 64, 65535, 65536, 2**31, 2**32, 2**48 + 5, 2**62, 2**63 - 1]
    rows = [doc(i, "en" if i % 3 else "fr") for i in ids]
    assert audited(spark, rows) == ordered(brute(rows))


def test_repeated_and_null_ids(spark):
    rows = [doc(i, None if i % 4 else "en") for i in range(30)]
    rows += [doc(None, "en", f"t{i}") for i in range(40)] + [doc(None, None, "one")] * 9
    rows += [doc(7, "en", f"u{i % 5}") for i in range(20)] + [doc(7)] * 3 + [doc(70, "en")] * 2
    assert audited(spark, rows) == ordered(brute(rows))


def test_many_copies(spark, monkeypatch):
    monkeypatch.setattr(manifest, "COPIES", 8)
    rows = [doc(5)] * 70 + [doc(6)] + [doc(None)] * 33
    assert audited(spark, rows) == ordered(brute(rows))


def test_odd_values(spark):
    rows = [
        (0, None, None, None, None), (None, None, None, None, None), (1, "", "", "", 0), (2, "ü\n\0", "é", "-", -1),
        (3, "x" * 300_000, "en", "1:a", 9), (4, "a", "EN", "s", None), (14, "a", "z", None, 10**15), (21, "a", "\U0001f600", "s", 1),
    ]
    assert audited(spark, rows) == ordered(brute(rows))


def test_small_tables(spark):
    assert audited(spark, []) == []
    assert audited(spark, [doc(4)]) == ordered(brute([doc(4)]))


def test_ranks_are_places(spark):
    """The directory alone: slots of scattered ids are the places of a sort."""
    import random

    rng = random.Random(4)
    ids = sorted({rng.randrange(-(2**40), 2**40) >> rng.randrange(40) for _ in range(3000)})
    rows = spark.createDataFrame([("v", i, "x", None) for i in rng.sample(ids, len(ids))], "grp string, id long, leaf string, tampered string")
    got = {r["id"]: r["slot"] for r in manifest.coordinates(rows).collect()}
    assert got == {i: n for n, i in enumerate(ids)}

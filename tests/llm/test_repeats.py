import hashlib
import random

import numpy as np
import pytest

from millrace.llm import repeats
from millrace.llm.queries import QUERIES
from millrace.llm.run_index import RunIndex

SF = "/root/testdata/sf0.001"


def brute(texts, length=100):
    """(n_bytes, n_removed, n_spans, sha256) for texts in order."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            s = data[i : i + length]
            if s in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(s)
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def result(df, **named):
    rows = repeats.remove(df, **named).collect()
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}, rows


def test_query(spark, sf_docs):
    rows = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op2_repeats"](spark, SF).collect()}
    order = sorted(sf_docs)
    assert [rows[i] for i in order] == brute([sf_docs[i]["text"] for i in order])


@pytest.mark.parametrize("hot", [20_000, 0])
def test_repetitive_texts(make_docs, words, monkeypatch, hot):
    """Passages with changed surroundings, periodic texts, single characters, all at short lengths too."""
    monkeypatch.setattr(repeats, "HOT", hot)
    rng, passage = random.Random(3), words(60, 9)
    texts = [words(rng.randint(0, 40), i) + passage[rng.randint(0, 80) :] + words(rng.randint(0, 40), i + 50) for i in range(25)]
    texts += ["a" * 5000, "ab" * 400 + "c" + "ab" * 300, "abc" * 60, "x" * 99, "x" * 100, "x" * 101, "é" * 300, words(30, 1) * 5]
    got, _ = result(make_docs(*enumerate(texts)))
    assert [got[i] for i in range(len(texts))] == brute(texts)
    got, _ = result(make_docs(*enumerate(texts)), length=20)
    assert [got[i] for i in range(len(texts))] == brute(texts, 20)


def test_odd_rows(make_docs, words):
    t = words(80, 1)
    got, rows = result(make_docs((2, None), (1, ""), (3, t), (9, t + "!")))
    assert [got[i] for i in (1, 2, 3, 9)] == brute(["", None, t, t + "!"])
    rows = repeats.remove(make_docs((3, t), (3, t), (None, t), (None, None)), with_text=True).collect()
    assert sorted((r["doc_id"] is None, r["n_removed"]) for r in rows) == [(False, len(t)), (False, len(t)), (True, 0), (True, 0)]
    assert sorted(bytes(r["kept"]) for r in rows) == [b"", b"", b"", t.encode()]
    assert repeats.remove(make_docs((3, t)).limit(0)).collect() == []


def test_index_against_brute_force():
    rng = random.Random(8)
    for length in (3, 5, 8, 30):
        pieces = [bytes(rng.choices(b"ab", k=rng.randint(1, 60))) for _ in range(30)] + [b"a" * 90]
        keys = np.array(rng.sample(range(1000), len(pieces)))
        starts = np.array([rng.randint(0, 9) for _ in pieces])
        first = {}
        for piece, key, start in zip(pieces, keys, starts, strict=True):
            for i in range(len(piece) - length + 1):
                s = piece[i : i + length]
                first[s] = min(first.get(s, (key, start + i)), (key, start + i))
        want = {
            (n, i)
            for n, (piece, key, start) in enumerate(zip(pieces, keys, starts, strict=True))
            for i in range(len(piece) - length + 1)
            if first[piece[i : i + length]] != (key, start + i)
        }
        index = RunIndex(pieces, keys, starts, length)
        assert set(zip(*(x.tolist() for x in index.repeats()), strict=True)) == want


def test_matching_statistics():
    """Of every place: the match with the suffix before it in order, its length and where it is."""
    rng = random.Random(4)
    for length in (4, 9, 100):
        pieces = [bytes(rng.choices(b"ab\x00\xff", k=rng.randint(1, 70))) for _ in range(12)] + [b"ab" * 60, b"ab" * 80]
        index = RunIndex(pieces, np.arange(len(pieces)), np.zeros(len(pieces), np.int64), length)
        marked = [[*(x + len(pieces) for x in p), i] for i, p in enumerate(pieces)]
        whole = [s for p in marked for s in p]
        order = sorted(range(len(whole)), key=lambda i: whole[i:])
        at = {(n, i): int(index.begins[n]) + i for n, p in enumerate(pieces) for i in range(len(p))}
        seen = 0
        for piece, offset, row, match, place in index.stream():
            for n, i, r, m, q in zip(piece, offset, row, match, place, strict=True):
                here = at[n, i]
                assert order[r] == here
                common = 0
                there = order[r - 1]
                while common < length and whole[here + common] == whole[there + common]:
                    common += 1
                assert m == common and (m == 0 or q == there)
                seen += 1
        assert seen == sum(map(len, pieces))


def test_run_ends_and_rows():
    """The transform is compressed, and following it from the end marks spells the pieces."""
    pieces = [b"banana bandana " * 40, b"banana bandana " * 40]
    index = RunIndex(pieces, np.array([0, 1]), np.array([0, 0]), 10)
    assert len(index.run_start) < 100
    rows, spelled = np.arange(2), []
    while True:
        run = np.searchsorted(index.run_start, rows, side="right") - 1
        symbol = index.run_symbol[run]
        rows, ended = index.step(rows)
        if ended.any():
            break
        spelled.append(symbol - 2)
    assert [bytes(int(s[i]) for s in reversed(spelled)) for i in range(2)] == pieces


def test_pieces_are_cut_to_what_can_match(words):
    """The index sees only bytes near enough to the anchor, and the result is the same as without the cut."""
    length, rng = 100, random.Random(5)
    passage = words(40, 9)
    texts = [words(rng.randint(0, 20), i) + passage[rng.randint(0, 60) :] + words(rng.randint(0, 20), i + 50) for i in range(30)]
    texts += ["ab" * 300, "a" * 400, words(60, 3)[:70] + passage[100:130] + words(30, 4)]
    rows = []
    for key, text in enumerate(texts):
        s = repeats.Segments(text.encode(), length)
        for anchor, start, n in zip(s.anchor.view(np.int64).tolist(), s.start.tolist(), s.count.tolist(), strict=True):
            rows.append((anchor, key, start, text.encode()[start : start + n - 1 + length]))
    rows.sort(key=lambda r: r[:3])

    def found(pieces):
        index = RunIndex([p[3] for p in pieces], *(np.array([p[i] for p in pieces]) for i in (1, 2)), length)
        return {(pieces[i][1], pieces[i][2] + at) for i, at in zip(*(x.tolist() for x in index.repeats()), strict=True)}

    cut = repeats.may_match(rows, length)
    assert found(cut) == found(rows) and found(rows)
    assert sum(len(r[3]) for r in cut) < sum(len(r[3]) for r in rows) * 7 // 10

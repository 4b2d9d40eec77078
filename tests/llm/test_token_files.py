import random
import zlib

import numpy as np
import pytest

from millrace.llm import token_files as tf
from millrace.llm.common import scratch_dir
from millrace.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  two  blanks ", "line\n next\n\n x", "tab\t x", "don't 's 12 345 !? é ñ ß 中文 🙂", "\x1c a\x1d b", "\xa0 b \u2003 c", "a" * 3000, "  \n", "x \n y", "<|endoftext|> a"]


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return lambda text: t.encode(text, add_special_tokens=False).ids


def brute(texts, plain):
    """(start, n_tokens, crc) for texts in order"""
    out, start = [], 0
    for text in texts:
        ids = [*plain(text or ""), 0]
        out.append((start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_query(spark, sf_docs, plain):
    rows = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op8_token_files"](spark, SF).collect()}
    order = sorted(sf_docs)
    assert [rows[i] for i in order] == brute([sf_docs[i]["text"] for i in order], plain)


@pytest.mark.parametrize("shard_tokens", [1, 50, 1 << 20])
def test_odd_rows(make_docs, words, plain, shard_tokens):
    texts = [*ODD, None, words(30_000, 1)]
    rows = tf.encode(make_docs(*enumerate(texts)), tokenizer_path(), shard_tokens=shard_tokens).collect()
    assert [tuple(r)[1:] for r in sorted(rows)] == brute(texts, plain)


def test_null_and_repeated_ids(make_docs, plain):
    docs = make_docs((5, "b"), (None, "first"), (5, "b"), (9, "c"))
    rows = sorted(tf.encode(docs, tokenizer_path()).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 5, 5, 9]
    assert [tuple(r)[1:] for r in rows] == brute(["first", "b", "b", "c"], plain)
    assert tf.encode(docs.limit(0), tokenizer_path()).collect() == []


def test_pieces_do_not_change_ids(plain, words):
    coder, rng = tf.Encoder(tokenizer_path()), random.Random(3)
    alphabet = ["a", "Bc", "é", " ", " ", "\n", "\t", "'", "'s", "1", "!", "中", "\u2003", "\x1c", "\x85", "🙂"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(500)]
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(ids, coder.width).tolist() == plain(text)


def test_elias_fano():
    rng = random.Random(2)
    for values in ([], [0], [0, 0, 0], [10**12], [*range(1000)], sorted(rng.choices(range(10**6), k=777)), [5] * 200 + [10**9]):
        coded = tf.EliasFano.encode(np.array(values))
        back = tf.EliasFano(coded.n, coded.low_bits, coded.low, coded.high, coded.samples)
        assert back.all().tolist() == values == [back.select(i) for i in range(len(values))]
    ends = tf.EliasFano.encode(np.cumsum(np.full(10_000, 500)))
    assert 8 * (len(ends.low) + len(ends.high)) < 10_000 * (2.5 + np.log2(500))
    with pytest.raises(IndexError):
        ends.select(10_000)


def test_files_hold_the_ids(spark, make_docs, plain):
    path = scratch_dir(spark, "test-tokens")
    tf.write_files(make_docs((1, "one two"), (2, "three")), path, tokenizer_path())
    shards = spark.read.parquet(path).orderBy("part", "seq").collect()
    ids = np.concatenate([np.frombuffer(s["ids"], "<u2") for s in shards])
    assert ids.tolist() == [*plain("one two"), 0, *plain("three"), 0]

import json

import pytest
from pyspark.errors import AnalysisException

from millrace.operators import drift
from millrace.sources import jsonl, schemas
from millrace.streaming import usage

DOC = "name string, n bigint"


def write_lines(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in records), encoding="utf-8")


def test_rows_are_numbered_in_path_and_line_order(spark, tmp_path):
    expected = []
    for name, size in (("b", 700), ("a", 1500), ("c", 1)):
        records = [{"name": f"{name}é{i}", "n": i} for i in range(size)]
        write_lines(tmp_path / "raw" / f"{name}.jsonl", records)
    for name, size in (("a", 1500), ("b", 700), ("c", 1)):
        expected += [f"{name}é{i}" for i in range(size)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = jsonl.number_rows(jsonl.read_jsonl(spark, str(tmp_path / "raw" / "*.jsonl"), DOC))
        found = {r.row_id: r.name for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == dict(enumerate(expected))


def test_missing_path_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        jsonl.read_jsonl(spark, str(tmp_path / "none" / "*.jsonl"), DOC)


def test_malformed_line_fails_or_is_kept(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text('{"name": "a", "n": 1}\n{"name": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        jsonl.read_jsonl(spark, str(tmp_path / "bad.jsonl"), DOC).collect()
    kept = jsonl.read_jsonl(spark, str(tmp_path / "bad.jsonl"), DOC, keep_corrupt=True).collect()
    assert [(r.name, r._corrupt_record) for r in kept] == [("a", None), (None, '{"name": ')]


def test_null_means_absent_in_written_lines_and_unicode_stays(spark, tmp_path):
    out = tmp_path / "new" / "folder"
    df = spark.createDataFrame([("é", None)], DOC)
    for _ in range(2):
        jsonl.write_jsonl(df, str(out))
    written = "".join(p.read_text(encoding="utf-8") for p in out.glob("part-*"))
    assert written == '{"name":"é"}\n'


def test_usage_append_keeps_all_six_keys(spark, tmp_path):
    out = str(tmp_path / "usage")
    one = spark.createDataFrame([("support", "q", "r", 12)], "domain string, query string, response string, latency_ms int")
    for _ in range(2):
        jsonl.append_usage(one, out)
    rows = jsonl.read_usage(spark, out).collect()
    assert len(rows) == 2 and all(r.timestamp > 1.7e9 and r.latency_ms == 12 for r in rows)
    parts = [p for p in (tmp_path / "usage").glob("part-*") if p.stat().st_size]
    assert set(json.loads(parts[0].read_text().splitlines()[0])) == {
        "timestamp", "domain", "query", "response", "latency_ms", "feedback",
    }


def test_concat_and_splits(spark, tmp_path):
    a, b = tmp_path / "a.jsonl", tmp_path / "b.jsonl"
    write_lines(a, [{"name": "x", "n": 1}])
    write_lines(b, [{"name": "y", "n": 2}, {"name": "z"}])
    both = jsonl.concat_files(spark, [str(a), str(b)], DOC)
    assert sorted((r.name, r.n) for r in both.collect()) == [("x", 1), ("y", 2), ("z", None)]
    split = spark.createDataFrame(
        [("train", "k2", "p"), ("train", "k1", "q"), ("test", "k0", "r")], "split string, order_key string, name string"
    )
    out = tmp_path / "splits"
    jsonl.write_splits(split, str(out), order_by="order_key")
    assert {p.name for p in out.iterdir() if p.is_dir()} == {"split=train", "split=test"}
    train = jsonl.read_split(spark, str(out), "train", "name string")
    assert sorted(r.name for r in train.collect()) == ["p", "q"] and train.columns == ["name"]
    text = "".join(p.read_text() for p in sorted((out / "split=train").glob("part-*")))
    assert text.index('"q"') < text.index('"p"')


DAY = 86400
LOG = [
    (0.0, "support", "known word", 10),
    (10.5, "support", "new new known", 30),
    (20.0, "legal", "", 5),
    (DAY + 1.0, "support", "known", 7),
    (4.0 * DAY, "support", "late new", 1),
]


def log_rows(spark):
    return spark.createDataFrame(
        [(t, d, q, "r", ms, None) for t, d, q, ms in LOG], schemas.USAGE
    )


def as_rows(df):
    return sorted(
        (str(r.window_start), str(r.domain), r.n_rows, r.mean_latency_ms, r.n_words, r.unseen_words, r.oov_rate)
        for r in df.collect()
    )


@pytest.fixture
def vocab(spark):
    train = spark.createDataFrame([("Known word",), (None,)], "input string")
    return drift.vocabulary(train)


def run_once(spark, log, store, vocab):
    """Rows that a call has read, and the windows after it."""
    query = usage.follow(usage.usage_stream(spark, log), store, vocab, once=True)
    query.awaitTermination()
    return sum(p.numInputRows for p in query.recentProgress), as_rows(usage.read_windows(spark, store))


def test_stream_equals_batch(spark, tmp_path, vocab):
    log = log_rows(spark)
    jsonl.append_usage(log, str(tmp_path / "log"))
    batch = as_rows(usage.windowed_usage(log, vocab))
    assert run_once(spark, str(tmp_path / "log"), str(tmp_path / "store"), vocab) == (len(LOG), batch)
    assert batch[1] == ("1970-01-01 00:00:00", "support", 2, 20.0, 5, 2, 0.4)
    assert batch[0] == ("1970-01-01 00:00:00", "legal", 1, 5.0, 0, 0, 0.0)


def test_vocabulary_that_is_not_broadcast(spark, vocab, monkeypatch):
    log = log_rows(spark)
    expected = as_rows(usage.windowed_usage(log, vocab))
    monkeypatch.setattr("millrace.session.BROADCAST_ROWS", 0)
    assert as_rows(usage.windowed_usage(log, vocab)) == expected


def test_a_second_call_reads_new_lines_only(spark, tmp_path, vocab, monkeypatch):
    """Resumed from the store, merged on the way; late records count in their old window."""
    monkeypatch.setattr(usage, "MERGE_EVERY", 3)
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    every = []
    for call in range(8):
        new = [(float(DAY * (call % 3) + call), "support" if call % 2 else None, f"known {call} word", "r", call, None) for _ in range(call + 1)]
        every += new
        jsonl.append_usage(spark.createDataFrame(new, schemas.USAGE).coalesce(1), log)
        read, windows = run_once(spark, log, store, vocab)
        assert read == call + 1
        assert windows == as_rows(usage.windowed_usage(spark.createDataFrame(every, schemas.USAGE), vocab))
    assert run_once(spark, log, store, vocab) == (0, windows)
    kept = sorted(p.name for p in (tmp_path / "store").glob("*/*=*"))
    assert kept == ["batch=3", "batch=4", "batch=5", "batch=6", "batch=7", "upto=2", "upto=5"]
    closed = as_rows(usage.read_windows(spark, store, closed_before="25 hours"))
    assert closed == [w for w in windows if w[0].startswith("1970-01-01")]


def test_a_batch_that_is_run_again_counts_once(spark, tmp_path, vocab, monkeypatch):
    """A stop after the totals were written, before the checkpoint knew it; and one before that."""
    import shutil

    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    jsonl.append_usage(log_rows(spark), log)
    expected = run_once(spark, log, store, vocab)[1]
    shutil.rmtree(tmp_path / "store" / "checkpoint" / "commits")
    assert run_once(spark, log, store, vocab)[1] == expected

    def broken(*_):
        raise RuntimeError("stopped")

    jsonl.append_usage(log_rows(spark), log)
    with monkeypatch.context() as m:
        m.setattr(usage, "window_totals", broken)
        with pytest.raises(Exception):
            run_once(spark, log, store, vocab)
    assert as_rows(usage.read_windows(spark, store)) == expected
    read, twice = run_once(spark, log, store, vocab)
    assert read == len(LOG) and [r[2] for r in twice] == [2 * r[2] for r in expected]


def test_an_empty_store_and_an_empty_log(spark, tmp_path, vocab):
    assert as_rows(usage.read_windows(spark, str(tmp_path / "none"))) == []
    assert as_rows(usage.windowed_usage(log_rows(spark).limit(0), vocab)) == []


def test_support_pairs_over_gaps_match_sql(spark, tmp_path):
    import duckdb
    from millrace.catalog import sql
    from millrace.sources import bindings

    turns = {1: [0, 1, 4, 7, 8, 9], 2: [3, 1020, 1030, 5000, 5001], 3: [2], 4: [0, 1, 2, 3]}
    rows = [(c, t, "assistant" if i % 2 else "user", f"{c} {t}") for c, ts in turns.items() for i, t in enumerate(ts)]
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").coalesce(1).write.parquet(path)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    want = sorted(db.execute(f"WITH {sql.SUPPORT} SELECT row_id, conv_id, turn, instruction, response FROM support").fetchall())
    got = bindings.support_source(spark, str(tmp_path)).select("row_id", "conv_id", "turn", "instruction", "response")
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) == 7


def test_ids_of_long_conversations_and_large_numbers_match_sql(spark, tmp_path):
    """2,501 turns in a conversation, ids over 10**12 in every table: order kept, no id twice."""
    import duckdb
    from millrace.catalog import sql
    from millrace.sources import bindings

    big = 3 * 10**12
    turns = [(c, t) for c in (big, big + 1, big + 9) for t in range(0, 2501, 1 if c != big + 1 else 700)]
    rows = [(c, t, "assistant" if i % 2 else "user", f"{c} {t}") for i, (c, t) in enumerate(turns)]
    at = {n: str(tmp_path / f"{n}.parquet") for n in ("conversations", "documents", "benchmark")}
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(at["conversations"])
    docs = [(big + 5 * i, f"title {i}\nbody", "en", "s") for i in range(20)] + [(-7, "first", "en", "s")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(at["documents"])
    spark.createDataFrame([(big * 2, "Ask. Answer"), (4, "What. That")], "item_id long, text string").write.parquet(at["benchmark"])
    db = duckdb.connect()
    for name, path in at.items():
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/*.parquet'")
    columns = "row_id, domain, text, summary, question, answer, ticket, resolution"
    want = db.execute(f"WITH {sql.MIXED} SELECT {columns} FROM mixed ORDER BY row_id").fetchall()
    got = [tuple(r) for r in bindings.mixed_raw(spark, str(tmp_path)).select(*columns.split(", ")).orderBy("row_id").collect()]
    assert got == want and len({r[0] for r in got}) == len(got) > 2500
    assert [r[1] for r in got] == sorted(r[1] for r in got)


def test_one_hot_conversation_in_pieces(spark):
    import random

    from millrace.operators import conversations

    rng = random.Random(2)
    turns = [(7, t, rng.choice(["user", "assistant", "system"]), f"t{t}") for t in sorted(rng.sample(range(-40, 4000), 900))]
    turns += [(8, t, "user" if t % 2 == 0 else "assistant", f"u{t}") for t in range(-3, 12)] + [(9, 5, "user", "alone")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.instruction, r.response, r.row_id) for r in conversations.answered(df, piece=16).collect()}
    pairs = [(a, b) for a, b in zip(turns, turns[1:], strict=False) if a[0] == b[0] and (a[2], b[2]) == ("user", "assistant")]
    low = min(t[1] for t in turns)
    step = max(t[1] for t in turns) - low + 1
    assert got == {(a[0], a[1]): (a[3], b[3], (a[0] - 7) * step + a[1] - low) for a, b in pairs}


def test_numbered_records_hold_whole_texts(spark, tmp_path):
    from millrace.catalog import collecting

    text = "Title\n" + "long text " * 900
    spark.createDataFrame([(1, text, "en", "s"), (2, "short", "en", "s")], "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(5, "Ask. Answer")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a")], "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    rows = collecting.numbered_records(spark, str(tmp_path)).orderBy("row_id").collect()
    assert [(r.source_id, r.text or r.question or r.ticket) for r in rows] == [(1, text), (2, "short"), (5, "Ask."), (0, "q")]
    assert [r.summary or r.answer or r.resolution for r in rows][2:] == [" Answer", "a"]

import json

import pytest
from pyspark.sql import functions as F

from millrace.functions.text import squeeze_space, trim_space
from millrace.operators import variant_records
from millrace.plans import files
from millrace.sources import jsonl, schemas
from millrace.sources.jsonl import append_usage

TOPICS = "parcel refund login invoice delivery password contract warranty".split()


def write_lines(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r) + "\n" for r in records))


def test_raw_files_to_splits_report_and_drift(spark, tmp_path):
    ticket = "My {t} number {i} is late, write to me at user{i}@example.com please"
    support = [
        {"domain": "support", "source": "bitext", "ticket": ticket.format(t=t, i=word), "resolution": f"We fixed the {t} {word}."}
        for t in TOPICS
        for word in "alpha beta gamma delta epsilon".split()
    ]
    legal = [{"domain": "legal", "source": "billsum", "text": f"Section {w} of the act. " * 3, "summary": f"Act {w}."} for w in TOPICS]
    write_lines(tmp_path / "raw" / "support.jsonl", support + support[:7])
    write_lines(tmp_path / "raw" / "legal.jsonl", [*legal, {"domain": "legal", "text": "x", "summary": "y"}])
    at = {n: str(tmp_path / n) for n in ("scrubbed", "deduped", "filtered", "formatted", "splits")}

    masked = {"EMAIL": 47, "SSN": 0, "CREDIT_CARD": 0, "PHONE": 0, "IP_ADDRESS": 0}
    assert files.scrub_files(spark, str(tmp_path / "raw" / "*.jsonl"), at["scrubbed"]) == {"rows": 56, "masked": masked}
    assert files.dedup_files(spark, at["scrubbed"], at["deduped"]) == {"rows_in": 56, "rows_out": 49}
    dropped = {"empty": 0, "length": 1, "letters": 0}
    assert files.filter_files(spark, at["deduped"], at["filtered"]) == {"rows_in": 49, "rows_out": 48, "dropped": dropped}
    assert files.format_files(spark, at["filtered"], at["formatted"]) == {"rows_in": 48, "rows_out": 48}
    assert files.split_files(spark, at["formatted"], at["splits"]) == {"train": 38, "val": 4, "test": 6}

    def count(name, schema=schemas.RAW_MIXED):
        return jsonl.read_jsonl(spark, at[name], schema).count()

    assert (count("scrubbed"), count("deduped"), count("filtered")) == (56, 49, 48)
    formatted = jsonl.read_jsonl(spark, at["formatted"], schemas.EXAMPLE).collect()
    assert len(formatted) == 48
    # legal.jsonl comes first, so its rows carry the first numbers
    assert {r.row_id for r in formatted if r.domain == "legal"} == set(range(8))
    assert all("[EMAIL]" in r.input for r in formatted if r.domain == "support")
    sizes = [jsonl.read_split(spark, at["splits"], s, schemas.EXAMPLE).count() for s in ("train", "val", "test")]
    assert sizes == [32 + 6, 4 + 0, 4 + 2]

    write_lines(
        tmp_path / "results.jsonl",
        [{"row_id": i, "domain": "legal", "prompt_text": "p", "reference": "a b", "base_output": "a", "finetuned_output": "a b"} for i in range(4)],
    )
    write_lines(tmp_path / "judged.jsonl", [{"row_id": 0, "base_reply": '{"score": 2}', "finetuned_reply": "broken"}])
    compared = files.report_files(spark, str(tmp_path / "results.jsonl"), str(tmp_path / "report"), str(tmp_path / "judged.jsonl"))
    assert {(r.domain, r.n) for r in compared.collect()} == {("legal", 4), ("ALL", 4)}
    text = "".join(p.read_text() for p in (tmp_path / "report").glob("part-*"))
    assert "## ALL (n=4)" in text and "| exact_match | 0.000 | 1.000 | +1.000 |" in text
    assert "| llm_judge (1-5) | 2.00 | nan | +nan |" in text

    live = spark.createDataFrame(
        [("support", "completely unknown vocabulary", "r", 5)] * 40,
        "domain string, query string, response string, latency_ms int",
    )
    append_usage(live, str(tmp_path / "usage"))
    verdict = files.drift_files(spark, at["splits"], str(tmp_path / "usage")).first()
    assert verdict.status == "drift" and verdict.train_rows == 38 and verdict.oov_rate == 1.0


def test_records_of_any_shape_pass_through(spark, tmp_path):
    """Keys that no domain declares are kept, count for the dedup key, and numbers stay numbers."""
    lines = [{"domain": "other", "q": f"question number {w} with enough letters", "n": i} for i, w in enumerate(TOPICS)]
    write_lines(tmp_path / "in.jsonl", [*lines, {"domain": "third", "q": lines[2]["q"], "n": 2}, {"domain": "other", "q": "x"}])
    at = {n: str(tmp_path / n) for n in ("scrubbed", "deduped", "filtered")}
    files.scrub_files(spark, str(tmp_path / "in.jsonl"), at["scrubbed"])
    files.dedup_files(spark, at["scrubbed"], at["deduped"])
    files.filter_files(spark, at["deduped"], at["filtered"])
    counts = [files.records(spark, at[n]).count() for n in ("scrubbed", "deduped", "filtered")]
    assert counts == [10, 9, 8]
    kept = {(r.row_id, r.domain, r.q, r.n) for r in spark.read.json(at["filtered"]).collect()}
    assert kept == {(i, r["domain"], r["q"], r["n"]) for i, r in enumerate(lines)}


def test_jobs_number_records_without_ids(spark, tmp_path):
    rows = [{"domain": "d", "instruction": "i", "input": f"text {i}", "output": "o"} for i in range(100)]
    write_lines(tmp_path / "in.jsonl", rows)
    files.dedup_files(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "deduped"))
    assert files.records(spark, str(tmp_path / "deduped")).count() == 100
    files.split_files(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "splits"))
    sizes = [jsonl.read_split(spark, str(tmp_path / "splits"), s, schemas.EXAMPLE).count() for s in ("train", "val", "test")]
    assert sizes == [80, 10, 10]


def test_values_that_are_no_strings_are_not_formatted(spark, tmp_path):
    write_lines(tmp_path / "a.jsonl", [{"domain": "support", "ticket": 5, "resolution": "done"}])
    files.format_files(spark, str(tmp_path / "a.jsonl"), str(tmp_path / "out"))
    assert spark.read.schema(schemas.EXAMPLE).json(str(tmp_path / "out")).count() == 0


def test_split_keeps_domains_that_are_no_strings(spark, tmp_path):
    write_lines(tmp_path / "in.jsonl", [{"row_id": i, "domain": i % 2 + 1, "input": "x"} for i in range(40)])
    files.split_files(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "splits"))
    for name, n in (("train", 16), ("val", 2), ("test", 2)):
        rows = jsonl.read_split(spark, str(tmp_path / "splits"), name, "row_id long, domain long").collect()
        assert sorted(r.domain for r in rows) == [1] * n + [2] * n and all(r.domain == r.row_id % 2 + 1 for r in rows)


def read_back(path):
    return [json.loads(line) for p in sorted(path.rglob("part-*")) if not p.name.endswith(".crc") for line in p.read_text().splitlines()]


MIXED = [
    {"domain": "support", "ticket": 5, "resolution": "We have put this right for you today."},
    {"domain": "support", "ticket": "Please call 555-123-4567 about the parcel", "resolution": "We did, and it has come."},
    {"domain": "support", "ticket": "5", "resolution": "We have put this right for you today."},
    {"domain": "legal", "text": "An act of some kind, é and so on, long enough", "summary": None, "n": 1.25, "tags": ["a@b.co", 1]},
    {"domain": 5, "q": "a question that is long enough to be kept", "ok": True, "big": 12345678901234567890123},
    {"domain": "5", "q": "another question that is long enough to be kept", "o": {"mail": "a@b.co"}},
    {"domain": None, "q": "a third question that is long enough to be kept"},
    {"q": "a fourth question that is long enough to be kept"},
    {"domain": "support", "ticket": "Where is it? I have waited for so long.", "resolution": " "},
    {"domain": "support", "ticket": 1, "resolution": 2},
    {},
]


def test_every_value_keeps_its_type(spark, tmp_path):
    """As plain Python does it: strings are worked on, all else passes as it is."""
    write_lines(tmp_path / "raw" / "a.jsonl", MIXED)
    folder = str(tmp_path / "work")
    counts = files.scrub_files(spark, str(tmp_path / "raw" / "*.jsonl"), folder)
    assert counts["rows"] == 11 and counts["masked"]["PHONE"] == 1 and counts["masked"]["EMAIL"] == 0
    wanted = [{"row_id": i, **r} for i, r in enumerate(MIXED)]
    wanted[1]["ticket"] = "Please call [PHONE] about the parcel"
    order = lambda rows: sorted(rows, key=lambda r: r["row_id"])
    assert order(read_back(tmp_path / "work")) == wanted
    # 5 and "5" read alike, as in the reference key; the first one stays
    assert files.dedup_files(spark, folder, folder) == {"rows_in": 11, "rows_out": 10}
    wanted.pop(2)
    assert order(read_back(tmp_path / "work")) == wanted
    counts = files.filter_files(spark, folder, folder)
    assert counts == {"rows_in": 10, "rows_out": 7, "dropped": {"empty": 3, "length": 0, "letters": 0}}
    assert order(read_back(tmp_path / "work")) == wanted[:7]
    assert files.format_files(spark, folder, str(tmp_path / "formatted")) == {"rows_in": 7, "rows_out": 1}
    (only,) = read_back(tmp_path / "formatted")
    assert (only["row_id"], only["input"]) == (1, wanted[1]["ticket"])
    sizes = files.split_files(spark, folder, str(tmp_path / "splits"), 0.5, 0.0)
    assert order(read_back(tmp_path / "splits")) == wanted[:7]
    # strata: support with two rows, legal, 5, "5", null and the missing one with one row each
    assert sizes == {"train": 1, "val": 0, "test": 6}


def test_lines_that_are_no_objects_fail(spark, tmp_path):
    for i, line in enumerate(['{"a": 1', "5", "[1]", '{"a": 1} {"b": 2}', '{"a": 1}, {"b": 2}', "null"]):
        (tmp_path / f"{i}.jsonl").write_text('{"q": "good"}\n' + line + "\n")
        with pytest.raises(Exception):
            files.scrub_files(spark, str(tmp_path / f"{i}.jsonl"), str(tmp_path / f"out{i}"))
        assert not (tmp_path / f"out{i}").exists()


def test_row_ids_are_for_all_records_or_none(spark, tmp_path):
    write_lines(tmp_path / "some.jsonl", [{"row_id": 4, "q": "x"}, {"q": "y", "text": 'the key "row_id" by name'}])
    with pytest.raises(ValueError):
        files.records(spark, str(tmp_path / "some.jsonl"))
    write_lines(tmp_path / "text.jsonl", [{"row_id": "4"}])
    with pytest.raises(Exception):
        files.records(spark, str(tmp_path / "text.jsonl")).collect()
    write_lines(tmp_path / "all.jsonl", [{"row_id": 4, "q": "x"}, {"row_id": 2, "q": "y"}])
    assert sorted(r.row_id for r in files.records(spark, str(tmp_path / "all.jsonl")).collect()) == [2, 4]


def test_a_failed_job_leaves_the_old_output(spark, tmp_path):
    write_lines(tmp_path / "in.jsonl", [{"q": "one"}, {"q": "two"}])
    out = tmp_path / "out"
    files.scrub_files(spark, str(tmp_path / "in.jsonl"), str(out))
    before = read_back(out)
    (tmp_path / "in.jsonl").write_text('{"q": "three"}\nbroken\n')
    with pytest.raises(Exception):
        files.scrub_files(spark, str(tmp_path / "in.jsonl"), str(out))
    assert read_back(out) == before and len(before) == 2
    assert sorted(p.name for p in tmp_path.iterdir()) == ["in.jsonl", "out"]
    write_lines(tmp_path / "in.jsonl", [{"q": "four"}])
    files.scrub_files(spark, str(tmp_path / "in.jsonl"), str(out))
    assert [r["q"] for r in read_back(out)] == ["four"]


def test_jobs_on_empty_files(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text("\n  \n")
    at = lambda n: str(tmp_path / n)
    assert files.scrub_files(spark, at("in.jsonl"), at("a"))["rows"] == 0
    assert files.dedup_files(spark, at("a"), at("b")) == {"rows_in": 0, "rows_out": 0}
    assert files.filter_files(spark, at("b"), at("c"))["rows_out"] == 0
    assert files.format_files(spark, at("c"), at("d")) == {"rows_in": 0, "rows_out": 0}
    assert files.split_files(spark, at("c"), at("e")) == {"train": 0, "val": 0, "test": 0}


def test_prompts_replies_and_train_rows(spark, tmp_path):
    rows = [{"row_id": i, "domain": "d", "instruction": "i", "input": f"text {i}", "output": "o"} for i in range(50)]
    write_lines(tmp_path / "in.jsonl", rows)
    files.split_files(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "splits"))
    assert files.augment_files(spark, str(tmp_path / "splits"), str(tmp_path / "prompts"), calls=7) == {"prompts": 7}
    train = {r["input"] for r in read_back(tmp_path / "splits" / "split=train")}
    for line in read_back(tmp_path / "prompts"):
        shown = json.loads(line["prompt"].split("\n\n")[1])
        assert len(shown) == 3 and {e["input"] for e in shown} <= train
    good = {"instruction": "i", "input": "a", "output": "b", "extra": 1}
    replies = [json.dumps([good, {"instruction": 1, "input": "a", "output": "b"}]), "none", f"so [{json.dumps(good)}, ]"]
    write_lines(tmp_path / "replies.jsonl", [{"row_id": i, "domain": "d", "reply": r} for i, r in enumerate(replies)])
    counts = files.synthetic_files(spark, str(tmp_path / "replies.jsonl"), str(tmp_path / "synthetic"))
    assert counts == {"replies": 3, "rows": 1}
    assert read_back(tmp_path / "synthetic") == [{"domain": "d", "instruction": "i", "input": "a", "output": "b"}]


def test_pairs_votes_and_perplexity(spark, tmp_path):
    n = 40
    write_lines(tmp_path / "test.jsonl", [{"domain": "d", "instruction": "i", "input": f"q{i}", "output": f"r{i}"} for i in range(n)])
    for side in ("base", "tuned"):
        write_lines(tmp_path / f"{side}.jsonl", [{"output": f"{side} {i}"} for i in range(n)])
    at = lambda name: str(tmp_path / name)
    assert files.pair_files(spark, at("test.jsonl"), at("base.jsonl"), at("tuned.jsonl"), at("results")) == {"rows": n}
    results = sorted(read_back(tmp_path / "results"), key=lambda r: r["row_id"])
    assert [(r["reference"], r["base_output"], r["finetuned_output"]) for r in results] == [(f"r{i}", f"base {i}", f"tuned {i}") for i in range(n)]
    assert results[3]["prompt_text"] == "i\n\nq3"
    write_lines(tmp_path / "short.jsonl", [{"output": "x"}] * (n - 1))
    with pytest.raises(Exception):
        files.pair_files(spark, at("test.jsonl"), at("base.jsonl"), at("short.jsonl"), at("never"))
    assert files.side_files(spark, at("results"), at("sides")) == {"rows": n}
    sides = {r["row_id"]: r for r in read_back(tmp_path / "sides")}
    choose = lambda i: ("A" if sides[i]["response_a"].startswith("tuned") else "B") if i % 4 else ("Tie", "")[i % 8 // 4]
    write_lines(tmp_path / "votes.jsonl", [{"row_id": i, "choice": choose(i)} for i in range(n)])
    tally = files.vote_files(spark, at("votes.jsonl"), at("results"), at("winners"))
    assert {r.winner: r.votes for r in tally.collect()} == {"finetuned": 30, "tie": 5}
    assert len(read_back(tmp_path / "winners")) == 35
    write_lines(tmp_path / "loss.jsonl", [{"n": 3, "base_loss": 2.0, "finetuned_loss": 1.0}, {"n": 0, "base_loss": 9.0, "finetuned_loss": 9.0}])
    files.perplexity_files(spark, at("loss.jsonl"), at("perplexity"))
    assert read_back(tmp_path / "perplexity") == [{"base_perplexity": 7.389, "finetuned_perplexity": 2.718}]


def test_numbering_fails_when_files_are_cut_anew(spark, tmp_path):
    write_lines(tmp_path / "in" / "a.jsonl", [{"q": f"text {i}"} for i in range(3000)])
    rows = jsonl.number_rows(jsonl.read_lines(spark, str(tmp_path / "in")))
    assert sorted((r.row_id, json.loads(r.value)["q"]) for r in rows.collect()) == [(i, f"text {i}") for i in range(3000)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        cut = jsonl.number_rows(jsonl.read_lines(spark, str(tmp_path / "in")))
        assert cut.rdd.getNumPartitions() > 4
        assert sorted((r.row_id, json.loads(r.value)["q"]) for r in cut.collect()) == [(i, f"text {i}") for i in range(3000)]
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        with pytest.raises(Exception, match="number the rows again"):
            cut.select("row_id", "value").where("row_id >= 0").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_record_without_id_among_named_ones_fails(spark, tmp_path):
    nested = {"q": "y", "about": {"row_id": 5}}
    write_lines(tmp_path / "none.jsonl", [nested, nested])
    assert sorted(r.row_id for r in files.records(spark, str(tmp_path / "none.jsonl")).collect()) == [0, 1]
    for i, rows in enumerate(([{"row_id": 4, "q": "x"}, nested], [nested, {"row_id": 4, "q": "x"}])):
        write_lines(tmp_path / f"{i}.jsonl", rows)
        with pytest.raises(Exception):
            files.records(spark, str(tmp_path / f"{i}.jsonl")).collect()


def test_records_with_ids_are_parsed_once(spark, tmp_path, monkeypatch):
    """Looking for ids must not read every record as JSON: that was a pass of its own in each job."""
    write_lines(tmp_path / "all.jsonl", [{"row_id": i, "q": f"text {i}"} for i in range(30)])
    seen = spark.sparkContext.accumulator(0)
    parse = variant_records.parse_lines

    def counting(lines):
        noted = F.udf(lambda v: seen.add(1) or v, "string").asNondeterministic()
        return parse(lines.withColumn("value", noted("value")))

    monkeypatch.setattr(files.variant_records, "parse_lines", counting)
    assert files.records(spark, str(tmp_path / "all.jsonl")).where("row_id >= 0").count() == 30
    assert seen.value <= 31


def test_scrub_counts_only_new_masks(spark, tmp_path):
    rows = [{"a": "[EMAIL] and a@b.cd", "b": "[EMAIL]", "c": 5}, {"a": "10.0.0.1 [IP_ADDRESS]", "b": None}, {"a": "plain"}]
    write_lines(tmp_path / "in.jsonl", rows)
    counts = files.scrub_files(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "out"))
    assert counts == {"rows": 3, "masked": {"EMAIL": 1, "SSN": 0, "CREDIT_CARD": 0, "PHONE": 0, "IP_ADDRESS": 1}}


def test_space_is_squeezed_and_trimmed(evaluate):
    texts = ["a b", " a  b ", "a\tb", "a \tb\n", " a   b\u0085", "\x1c", "", "a\n \nb c  d", "\n"]
    squeezed = ["a b", "a b", "a b", "a b", "a b", "", "", "a b c d", ""]
    assert evaluate(squeeze_space, *texts) == squeezed
    assert evaluate(trim_space, *texts) == ["a b", "a  b", "a\tb", "a \tb", "a   b", "", "", "a\n \nb c  d", ""]

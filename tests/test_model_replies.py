import json
import math
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.functions import prose_json
from millrace.operators import augmenting, chat_requests, evaluating, perplexity, voting
from millrace.sources import schemas

# From the first opening to the last closing bracket: a list, or nothing.
LISTS = {
    "[1]": [1],
    "[1, 2]": [1, 2],
    "[]": [],
    "[[1], {}]": [[1], {}],
    '["a\\n"]': ["a\n"],
    '[{"a": 1}, 7]': [{"a": 1}, 7],
    "[1.5e3]": [1500.0],
    "[null]": [None],
    "text [true] text": [True],
    "two\nlines [3,\n4]": [3, 4],
    "[1] then [2]": None,
    "[1, ]": None,
    "[nul]": None,
    "[1]\n and more ]": None,
    '["unterminated]': None,
    "] [": None,
    "[": None,
    "]": None,
    "no": None,
    "": None,
}


def test_lists_in_prose(evaluate):
    found = evaluate(lambda t: F.to_json(prose_json.strict_json(prose_json.bracketed(t))), *LISTS)
    for (text, expected), value in zip(LISTS.items(), found, strict=True):
        assert (None if value is None else json.loads(value)) == expected, text


def test_synthetic_rows_keep_only_whole_string_items(spark):
    good = {"instruction": "i", "input": "", "output": "o", "extra": 1}
    replies = spark.createDataFrame(
        [
            (1, "legal", "Sure:\n" + json.dumps([good, 7, None, "x", {**good, "output": 3}, {"input": "a"}])),
            (2, "legal", json.dumps([good])[:-3]),
            (3, "medical", "nothing here"),
            (4, "medical", json.dumps([{**good, "domain": "other"}], indent=2) + "\nBye"),
        ],
        "row_id bigint, domain string, reply string",
    )
    rows = augmenting.synthetic_rows(replies).collect()
    assert sorted((r.row_id, r.item_no, r.domain, r.instruction, r.input, r.output) for r in rows) == [
        (1, 0, "legal", "i", "", "o"),
        (4, 0, "medical", "i", "", "o"),
    ]


VERDICTS = [
    ('{"score": 4, "reason": "fine"}', 4.0, "fine"),
    ('Well: {"score": 3.5}', 3.5, None),
    ('{"score": "4", "reason": "text"}', None, "text"),
    ('{"score": true, "reason": "flag"}', 1.0, "flag"),
    ('{"score": null, "reason": "none"}', None, "none"),
    ("no braces", None, "parse_error"),
    ('{"score": 4} and {"score": 5}', None, "parse_error"),
    ('{"score": 12}', 12.0, None),
]


def test_judge_verdicts_and_mean(spark):
    df = spark.createDataFrame([(i, v[0]) for i, v in enumerate(VERDICTS)], "row_id int, reply string")
    verdicts = evaluating.judge_verdicts(df)
    found = {r.row_id: (r.score, r.reason) for r in verdicts.collect()}
    assert found == {i: v[1:] for i, v in enumerate(VERDICTS)}
    assert evaluating.mean_judge_score(verdicts).first()[0] == pytest.approx((4 + 3.5 + 1 + 12) / 4)
    assert math.isnan(evaluating.mean_judge_score(verdicts.where("false")).first()[0])


def test_request_validation_defaults_and_bounds(spark):
    rows = [
        (1, None, "hi", None, None),
        (2, "legal", "", 5, 0.5),
        (3, "legal", None, 5, 0.5),
        (4, "legal", "x", 0, 0.5),
        (5, "legal", "x", 4096, 2.0),
        (6, "legal", "x", 4097, 0.5),
        (7, "legal", "x", 1, 2.1),
        (8, "cooking", "x", 1, 0.0),
    ]
    checked = chat_requests.validate_requests(spark.createDataFrame(rows, schemas.CHAT_REQUEST))
    found = {r.row_id: r for r in checked.collect()}
    assert (found[1].domain, found[1].max_tokens, found[1].temperature) == ("support", 512, 0.2)
    assert {i: r.error for i, r in found.items()} == {
        1: None, 2: "message", 3: "message", 4: "max_tokens", 5: None, 6: "max_tokens", 7: "temperature", 8: None,
    }
    prompts = {r.row_id: r for r in chat_requests.with_prompts(checked).collect()}
    assert prompts[5].prompt == "Summarize the following legal text.\n\nx" and prompts[5].prompt_error is None
    assert prompts[8].prompt is None and "cooking" in prompts[8].prompt_error
    payload = chat_requests.request_payload(F.col("prompt"), F.col("max_tokens"), F.col("temperature"))
    body = json.loads(chat_requests.with_prompts(checked).where("row_id = 5").select(payload).first()[0])
    assert body["messages"] == [{"role": "user", "content": prompts[5].prompt}]
    assert (body["model"], body["max_tokens"], body["temperature"]) == ("domain-llm", 4096, 2.0)


REPLIES = [
    ('{"choices": [{"message": {"content": "  hi \\n"}}]}', "hi"),
    ('{"choices": [{"message": {"content": null}}, {}]}', ""),
    ('{"choices": [{"message": {}}]}', None),
    ('{"choices": []}', None),
    ('{"choices": {"message": 1}}', None),
    ('{"choices": [{"message": {"content": 5}}]}', None),
    ("[1]", None),
    ("gateway error", None),
]


def test_reply_answers_and_usage(spark):
    df = spark.createDataFrame(
        [(i, "support", "q", 100.0, 100.75, r[0]) for i, r in enumerate(REPLIES)],
        "row_id int, domain string, message string, started double, ended double, reply string",
    )
    answered = chat_requests.with_answers(df)
    found = {r.row_id: (r.answer, r.status) for r in answered.collect()}
    assert found == {i: (r[1], "error" if r[1] is None else "ok") for i, r in enumerate(REPLIES)}
    usage = chat_requests.usage_rows(answered).collect()
    assert sorted((u.response, u.latency_ms, u.timestamp, u.feedback) for u in usage) == [
        ("", 750, 100.75, None),
        ("hi", 750, 100.75, None),
    ]


def test_votes(spark):
    results = spark.createDataFrame(
        [(i, "p", f"base{i}", f"tuned{i}") for i in range(40)],
        "row_id bigint, prompt_text string, base_output string, finetuned_output string",
    )
    sides = voting.assign_sides(results)
    shown = {r.row_id: r for r in sides.collect()}
    assert {r.finetuned_first for r in shown.values()} == {True, False}
    for i, r in shown.items():
        pair = (f"tuned{i}", f"base{i}")
        assert (r.response_a, r.response_b) == (pair if r.finetuned_first else pair[::-1])
    choices = ["A", "B", "Tie", None, ""]
    votes = spark.createDataFrame([(i, choices[i % 5]) for i in range(40)], schemas.VOTE)
    resolved = voting.resolve_votes(votes, sides)
    won = {r.row_id: r.winner for r in resolved.collect()}
    assert set(won) == {i for i in range(40) if i % 5 < 3}
    for i, winner in won.items():
        if i % 5 == 2:
            assert winner == "tie"
        else:
            assert winner == ("finetuned" if (i % 5 == 0) == shown[i].finetuned_first else "base")
    tally = {r.winner: (r.votes, r.share) for r in voting.tally(resolved).collect()}
    assert tally["tie"] == (8, pytest.approx(8 / 24)) and sum(v for v, _ in tally.values()) == 24


def test_perplexity_of_a_loss_table(spark):
    df = spark.createDataFrame(
        [(3, 1.0, 0.5), (1, 2.0, 1.5), (0, 9.0, 9.0), (-1, 9.0, 9.0)],
        "n int, base_loss double, finetuned_loss double",
    )
    row = perplexity.perplexity_pair(df).first()
    assert (row.base_perplexity, row.finetuned_perplexity) == (round(math.exp(5 / 4), 3), round(math.exp(3 / 4), 3))
    assert perplexity.perplexity_pair(df.where("false")).first().base_perplexity == 1.0


@pytest.mark.parametrize("max_length", [None, 4])
def test_bigram_losses_against_brute_force(spark, max_length):
    rows = [
        ("the cat sat on the mat", True, True, False),
        ("the dog sat", True, False, False),
        ("", True, True, False),
        ("the cat ran far away from it all", False, False, True),
        ("...", False, False, True),
    ]
    df = spark.createDataFrame(rows, "text string, in_base boolean, in_finetuned boolean, held_out boolean")
    found = perplexity.bigram_losses(df, 0.5, max_length).first()

    def steps(text):
        tokens = re.findall(r"\w+", text.lower())
        tokens = tokens if max_length is None else tokens[: max_length - 1]
        return list(zip(["<s>", *tokens], tokens))

    size = len({w for t, base, _, _ in rows if base for _, w in steps(t)})
    for side, flag in (("base_loss", 1), ("finetuned_loss", 2)):
        counts = [s for r in rows if r[flag] for s in steps(r[0])]
        held = [s for r in rows if r[3] for s in steps(r[0])]
        loss = -sum(
            math.log((counts.count(s) + 0.5) / (sum(c[0] == s[0] for c in counts) + 0.5 * size)) for s in held
        )
        assert found[side] == pytest.approx(loss / len(held))
        assert found.n == len(held)


def test_bigram_losses_write_only_counts_that_are_used(spark, monkeypatch):
    written, stage = [], perplexity.stage
    monkeypatch.setattr(perplexity, "stage", lambda df, name: written.append(stage(df, name)) or written[-1])
    letters = "abcdefgh"
    rows = [(f"{v} {w}", True, None, False) for v in letters for w in letters]
    rows += [("a b", False, False, True), ("never counted", False, None, None)]
    rows += [(t, True, True, True) for t in (None, "", " .")]
    df = spark.createDataFrame(rows, "text string, in_base boolean, in_finetuned boolean, held_out boolean")
    found = perplexity.bigram_losses(df).first()
    # Of 72 bigrams, two are held out; the words, one of them with START, are contexts and vocabulary.
    assert written[0].count() == 2 + len(letters) + 1
    base = math.log((64 + 4) / (8 + 0.5)) + math.log((8 + 4) / (1 + 0.5))
    assert (found.n, found.base_loss) == (2, pytest.approx(base / 2))
    assert found.finetuned_loss == pytest.approx(math.log(4 / 0.5))


def test_bigram_counts_of_a_task_do_not_depend_on_chunks(monkeypatch):
    texts = ["the cat sat on the mat", "", "the cat", None, "é ß 北京 the the the", "mat"] * 7
    kinds = [1, 3, 4, 1, 5, 7, 2] * 6
    arrow = pa.RecordBatch.from_pydict({"kind": pa.array(kinds, pa.int32()), "words": pa.array(texts)})
    expected = Counter()
    for text, kind in zip(texts, kinds, strict=True):
        tokens = (text or "").split()
        flags = [kind >> i & 1 for i in range(3)]
        for v, w in zip(["<s>", *tokens], tokens):
            for key, counts in ((f"{v} {w}", [*flags, 0]), (v, [*flags, 0]), (w, [0, 0, 0, flags[0]])):
                expected.update({(key, i): n for i, n in enumerate(counts) if n})
    for chunk, split, size in ((1, 1, 1), (5, 2, 6), (1000, 4, 42), (1000, 128, 42)):
        monkeypatch.setattr(perplexity, "CHUNK_WORDS", chunk)
        monkeypatch.setattr(perplexity, "SPLIT_ROWS", split)
        found = Counter()
        for batch in perplexity._counted(arrow.slice(i, size) for i in range(0, len(texts), size)):
            for key, *counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                found.update({(key, i): n for i, n in enumerate(counts) if n})
        assert found == expected

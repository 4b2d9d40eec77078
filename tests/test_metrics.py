import random
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest

from millrace.functions import metrics
from millrace.functions.lcs import lcs_length, lcs_lengths
from millrace.functions.stem import stem_word
from millrace.functions.text import words
from millrace.operators import evaluating


def exact(p, r):
    return metrics.exact_match(words(p), words(r))


def f1(p, r):
    return metrics.token_f1(words(p), words(r))


def rouge(p, r, stem=True):
    return metrics.rouge_l(metrics.ascii_tokens(p), metrics.ascii_tokens(r), stem)


def test_exact_match(evaluate):
    pairs = [("Red wool, twice!", "red wool twice"), ("a b", "a c"), ("", "..."), ("é", "É")]
    assert evaluate(exact, *pairs) == [1.0, 0.0, 1.0, 1.0]


def test_token_f1(evaluate):
    pairs = [("spin red wool", "spin red flax"), ("", ""), ("a", ""), ("a a b", "a b b b"), ("x", "y")]
    found = evaluate(f1, *pairs)
    assert found == pytest.approx([2 / 3, 0.0, 0.0, 4 / 7, 0.0])


def test_token_f1_against_counters(evaluate):
    rng = random.Random(3)
    pairs = [
        tuple(" ".join(rng.choices("a b c dd e_e".split(), k=rng.randrange(1, 30))) for _ in "pr")
        for _ in range(100)
    ]

    def brute(p, r):
        p, r = p.split(), r.split()
        shared = sum((Counter(p) & Counter(r)).values())
        return 2 * shared / (len(p) + len(r)) if shared else 0.0

    assert evaluate(f1, *pairs) == pytest.approx([brute(*pair) for pair in pairs])


def test_rouge(evaluate):
    pairs = [
        ("warp and weft", "warp and weft"),
        ("", ""),
        ("weaving mills", "weave mill"),
        ("miller ground the barley", "miller grounds the barley"),
        ("the barley ground miller", "miller ground the barley"),
        ("é", "é"),
    ]
    assert evaluate(rouge, *pairs) == pytest.approx([1.0, 0.0, 1.0, 1.0, 0.5, 0.0])
    plain = evaluate(lambda p, r: rouge(p, r, stem=False), *pairs)
    assert plain == pytest.approx([1.0, 0.0, 0.0, 0.75, 0.5, 0.0])


def test_lcs_against_dynamic_programming():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcde") for _ in range(rng.randrange(40))] for _ in "ab")
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert lcs_length(a, b) == best[-1][-1]


@pytest.mark.parametrize(
    "word, stem",
    # examples printed with the published algorithm, as a full run of all steps leaves them
    [
        ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("caress", "caress"),
        ("cats", "cat"), ("feed", "feed"), ("agreed", "agre"), ("plastered", "plaster"),
        ("motoring", "motor"), ("sing", "sing"), ("hopping", "hop"), ("falling", "fall"),
        ("filing", "file"), ("happy", "happi"), ("relational", "relat"),
        ("conditional", "condit"), ("digitizer", "digit"), ("vietnamization", "vietnam"),
        ("hopefulness", "hope"), ("formaliti", "formal"), ("sensibiliti", "sensibl"),
        ("triplicate", "triplic"), ("electrical", "electr"), ("goodness", "good"),
        ("revival", "reviv"), ("adjustment", "adjust"), ("adoption", "adopt"),
        ("effective", "effect"), ("probate", "probat"), ("cease", "ceas"),
        ("controll", "control"), ("roll", "roll"), ("generalizations", "gener"),
        ("oscillators", "oscil"), ("dying", "die"), ("skies", "sky"), ("cat", "cat"),
    ],
)
def test_stems(word, stem):
    assert stem_word(word) == stem


RESULT = "row_id bigint, domain string, prompt_text string, reference string, base_output string, finetuned_output string"


def results(spark):
    return spark.createDataFrame(
        [
            (0, "b", "p", "a b c d", "a b", "a b c d"),
            (1, "a", "p", "x y", "", "x y"),
            (2, None, "p", "m n", "m n", "m"),
            (3, "", "p", "m n", "m", "m n"),
            (4, "ALL", "p", "q r", "q r", "z"),
        ],
        RESULT,
    )


def test_report_groups_and_total(spark):
    rows = evaluating.compare_by_domain(results(spark)).collect()
    n = {(r.domain, r.is_total): r.n for r in rows}
    assert n == {("b", False): 1, ("a", False): 1, ("unknown", False): 2, ("ALL", False): 1, ("ALL", True): 5}
    exact_rows = {(r.domain, r.is_total): r for r in rows if r.metric == "exact_match"}
    assert exact_rows["ALL", True].base == pytest.approx(0.4)
    assert exact_rows["ALL", True].finetuned == pytest.approx(0.6)
    assert exact_rows["unknown", False].delta == pytest.approx(0.0)


def test_report_of_nothing_is_a_total_of_zeros(spark):
    rows = evaluating.compare_by_domain(results(spark).where("false")).collect()
    assert [(r.domain, r.is_total, r.n, r.base, r.finetuned, r.delta) for r in rows] == [
        ("ALL", True, 0, 0.0, 0.0, 0.0)
    ] * 3


def test_report_text(spark, tmp_path):
    from millrace.sources.jsonl import write_report

    replies = spark.createDataFrame(
        [(i, '{"score": %d}' % s, '{"score": %d}' % (s + 1)) for i, s in enumerate([2, 4, 1])],
        "row_id bigint, base_reply string, finetuned_reply string",
    )
    judged = evaluating.judge_row(replies, judge_limit=2)
    lines = evaluating.report_lines(evaluating.compare_by_domain(results(spark)), judged)
    write_report(lines, str(tmp_path / "report"))
    (part,) = (tmp_path / "report").glob("part-*")
    text = part.read_text().rstrip("\n").split("\n")
    assert text[:9] == [
        "# Fine-tuned vs Base Model", "", "",
        "## b (n=1)", "",
        "| Metric | Base | Fine-tuned | Delta |", "|---|---|---|---|",
        "| rougeL | 0.667 | 1.000 | +0.333 |", "| token_f1 | 0.667 | 1.000 | +0.333 |",
    ]
    heads = [line for line in text if line.startswith("## ")]
    assert heads == ["## b (n=1)", "## a (n=1)", "## unknown (n=2)", "## ALL (n=1)", "## ALL (n=5)"]
    assert text[-1] == "| llm_judge (1-5) | 3.00 | 4.00 | +1.00 |"


def test_mean_scores(spark):
    df = spark.createDataFrame([("a b c", "a b c"), ("a", "b")], "prediction string, reference string")
    row = evaluating.mean_scores(df).first()
    assert set(row.asDict()) == {"rougeL", "token_f1", "exact_match"}
    assert row.asDict() == pytest.approx({"rougeL": 0.5, "token_f1": 0.5, "exact_match": 0.5})
    assert evaluating.mean_scores(df.where("false")).first().token_f1 == 0.0


def test_pairing(spark):
    base = spark.createDataFrame([(2, "b2"), (1, "b1")], "row_id bigint, output string")
    tuned = spark.createDataFrame([(1, "f1"), (2, "f2")], "row_id bigint, output string")
    refs = spark.createDataFrame([(1, "r1"), (2, "r2")], "row_id bigint, reference string")
    rows = {r.row_id: (r.reference, r.base_output, r.finetuned_output) for r in evaluating.pair_predictions(refs, base, tuned).collect()}
    assert rows == {1: ("r1", "b1", "f1"), 2: ("r2", "b2", "f2")}


def test_text_with_twenty_thousand_words(evaluate):
    rng = random.Random(5)
    long_text = " ".join(rng.choices([f"w{i}" for i in range(500)], k=20000))
    assert evaluate(rouge, (long_text, long_text)) == 1.0
    assert evaluate(f1, (long_text, long_text)) == 1.0


def test_lcs_memory_does_not_follow_the_batch():
    rows = [[f"word{i}" for i in range(200)]] * 4000
    batch = pa.array(rows, pa.list_(pa.string()))
    tracemalloc.start()
    found = lcs_lengths(batch, batch, stemmed=True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.to_pylist() == [200] * 4000 and peak < 30_000_000

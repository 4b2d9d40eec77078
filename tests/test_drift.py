import math
import re

import pytest

from millrace.functions.stats import ks_p_value
from millrace.operators import drift


def train_and_live(spark, train, live):
    return (
        spark.createDataFrame(train, "domain string, input string"),
        spark.createDataFrame(live, "domain string, query string"),
    )


def tokens(text):
    return re.findall(r"\w+", (text or "").lower())


def brute(train, live):
    a, b = [len(tokens(t)) for t in train], [len(tokens(t)) for t in live]
    ks = max(abs(sum(x <= c for x in a) / len(a) - sum(x <= c for x in b) / len(b)) for c in {*a, *b})
    vocab = {w for t in train for w in tokens(t)}
    used = [w for t in live for w in tokens(t)]
    root = math.sqrt(len(a) * len(b) / (len(a) + len(b)))
    scaled = ks * (root + 0.12 + 0.11 / root)
    p = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * scaled * scaled) for k in range(1, 101))
    p = 1.0 if scaled < 0.2 else min(1.0, max(0.0, p))
    return ks, p, sum(w not in vocab for w in used) / max(len(used), 1)


def test_drift_statistics_against_brute_force(spark):
    train = [("a", "w " * (i % 7) + "Élan x_1") for i in range(60)] + [("b", None)] * 5
    live = [("a", "w " * (i % 11) + "élan new") for i in range(40)]
    row = drift.drift_verdict(*train_and_live(spark, train, live)).first()
    ks, p, oov = brute([t for _, t in train], [t for _, t in live])
    assert (row.ks, row.p_value, row.oov_rate) == pytest.approx((ks, p, oov))
    assert (row.train_rows, row.live_rows) == (65, 40)


def status(spark, live, **thresholds):
    train = [("a", "one two three")] * 100
    return drift.drift_verdict(*train_and_live(spark, train, live), **thresholds).first()


def test_too_few_live_rows(spark):
    assert status(spark, [("a", "one two three")] * 29).status == "insufficient"
    assert status(spark, [("a", "one two three")] * 30).status == "ok"


def test_thresholds_are_strict(spark):
    live = [("a", "one two new")] * 60
    row = status(spark, live)
    assert row.oov_rate == pytest.approx(1 / 3) and row.status == "drift"
    assert status(spark, live, oov_threshold=row.oov_rate).status == "ok"
    shifted = [("a", "one")] * 60
    p = status(spark, shifted).p_value
    assert status(spark, shifted).status == "drift"
    assert status(spark, shifted, p_threshold=p).status == "ok"


def test_no_live_words(spark):
    row = status(spark, [("a", "...")] * 40)
    assert row.oov_rate == 0.0 and row.live_words == 0 and row.status == "drift"


def test_drift_per_domain(spark):
    train = [("a", "one two")] * 50 + [("b", "six")] * 50 + [("c", "only train")] * 5
    live = [("a", "one two")] * 40 + [("b", "seven eight nine")] * 40 + [("d", "only live")] * 40
    rows = {r.domain: r for r in drift.drift_by_domain(*train_and_live(spark, train, live)).collect()}
    assert {d: r.status for d, r in rows.items()} == {"a": "ok", "b": "drift", "d": "drift"}
    assert rows["d"].train_rows == 0 and rows["d"].ks is None and rows["d"].oov_rate == 1.0


def test_p_value_limits(spark):
    df = spark.createDataFrame([(0.0, 50, 50), (1.0, 5000, 5000), (0.2, 50, 50)], "d double, n bigint, m bigint")
    values = [r[0] for r in df.select(ks_p_value(df.d, df.n, df.m)).collect()]
    assert values[0] == 1.0 and values[1] == 0.0 and values[2] == pytest.approx(0.2407920)


def exact_p(n, m, gap):
    """Chance of a largest gap of at least ``gap``, by counting the paths that stay under it."""
    from fractions import Fraction

    bound = round(gap * n * m)
    row = [0] * (m + 1)
    for i in range(n + 1):
        for j in range(m + 1):
            inside = abs(i * m - j * n) < bound
            before = (row[j] if i else 0) + (row[j - 1] if j else 0)
            row[j] = (before if i or j else 1) if inside else 0
    return float(1 - Fraction(row[m], math.comb(n + m, n)))


def test_p_value_of_few_live_rows(spark):
    cases = [(0.30, 1000, 30), (0.32, 200, 30), (0.25, 1000, 30), (0.35, 60, 40)]
    df = spark.createDataFrame(cases, "d double, n long, m long")
    values = [r[0] for r in df.select(ks_p_value(df.d, df.n, df.m)).collect()]
    for value, (d, n, m) in zip(values, cases, strict=True):
        # a sample reaches d at multiples of 1 / (n m) only
        exact = exact_p(n, m, math.ceil(d * n * m - 1e-6) / (n * m))
        assert value == pytest.approx(exact, rel=0.15) and (value < 0.01) == (exact < 0.01)

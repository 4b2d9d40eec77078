import hashlib

from millrace.operators import dedup, quality
from millrace.plans.prepare import prepare

QA = "row_id bigint, domain string, source string, q string, r string"


def ids(df):
    return sorted(r.row_id for r in df.select("row_id").collect())


def test_dedup_ignores_case_space_and_domain_and_keeps_the_first(spark):
    df = spark.createDataFrame(
        [
            (3, "a", "s", "two rivers meet", None),
            (1, "a", "s", "Two  Rivers meet", None),
            (2, "b", "t", " TWO\x1cRivers\u00a0 MEET ", None),
            (4, "a", "s", "two rivers", "meet"),
            (5, "a", "s", "other", None),
        ],
        QA,
    )
    assert ids(dedup.deduplicate(df)) == [1, 5]
    assert ids(dedup.deduplicate(df, staged=True)) == [1, 5]
    counts = dedup.dedup_counts(df).first()
    assert (counts.rows_before, counts.rows_after) == (5, 2)
    key = df.where("row_id = 4").select(dedup.dedup_key(df)).first()[0]
    assert key == hashlib.md5(b"two rivers meet").hexdigest()


def test_dedup_of_one_huge_group_of_copies(spark):
    df = spark.range(30000).selectExpr(
        "id as row_id", "'a' as domain", "case when id % 3 = 0 then 'same' else concat('t', id) end as q"
    )
    kept = ids(dedup.deduplicate(df))
    assert len(kept) == 20001 and kept[0] == 0


def outcome(spark, *values):
    df = spark.createDataFrame([(1, "a", "s", *values)], QA)
    return df.select(quality.drop_reason(df)).first()[0]


def test_quality_edges(spark):
    assert outcome(spark, "hi", None) == "length"
    assert outcome(spark, "Warp threads run the length of the loom, weft threads cross them.", None) is None
    assert outcome(spark, "x" * 29, None) == "length"
    assert outcome(spark, "x" * 30, None) is None
    assert outcome(spark, "x" * 8000, None) is None
    assert outcome(spark, "x" * 8001, None) == "length"
    assert outcome(spark, "x" * 40, "  \t") == "empty"
    assert outcome(spark, None, None) == "empty"
    # 15 letters of 30 pass; the joining space counts, so 15 of 31 do not
    assert outcome(spark, "x" * 15 + "1" * 15, None) is None
    assert outcome(spark, "x" * 15, "1" * 15) == "letters"


def test_quality_without_content_columns(spark):
    df = spark.createDataFrame([(1, "a", 7)], "row_id bigint, domain string, n int")
    assert quality.keep_good(df).count() == 0


def test_quality_counts(spark):
    df = spark.createDataFrame([(1, "a", "s", "hi", None), (2, "a", "s", "x" * 50, None)], QA)
    counts = {r.outcome: r.n_rows for r in quality.quality_counts(df).collect()}
    assert counts == {"length": 1, "kept": 1}


def test_scrubbing_comes_before_dedup(spark):
    rows = [
        (i, "support", "bitext", f"Please write to user{i}@example.com about my late order", "We are on it.")
        for i in range(3)
    ]
    raw = spark.createDataFrame(
        rows, "row_id bigint, domain string, source string, ticket string, resolution string"
    )
    for staged in (True, False):
        out = prepare(raw, staged=staged).collect()
        assert [(r.row_id, r.split) for r in out] == [(0, "test")]
        assert out[0].input == "Please write to [EMAIL] about my late order"

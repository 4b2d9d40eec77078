import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import augmenting, collating, ranking, splitting


def key(row_id, seed=42):
    return hashlib.md5(f"{seed}:{row_id}".encode()).hexdigest()


def expected_split(rows, train=0.8, val=0.1, seed=42):
    groups, out = {}, {}
    for row_id, domain in rows:
        groups.setdefault("unknown" if domain is None else domain, []).append(row_id)
    for members in groups.values():
        members.sort(key=lambda r: key(r, seed))
        n_train, n_val = int(len(members) * train), int(len(members) * val)
        for i, r in enumerate(members):
            out[r] = "train" if i < n_train else "val" if i < n_train + n_val else "test"
    return out


def split_of(df, **kw):
    return {r.row_id: r.split for r in splitting.stratified_split(df, **kw).collect()}


# One domain holds most rows, one a single row, and null and empty ones are two.
ROWS = (
    [(i, "hot") for i in range(9000)]
    + [(9000 + i, "mid") for i in range(137)]
    + [(9500, "lone")]
    + [(9600 + i, None if i % 2 else "") for i in range(25)]
)


@pytest.mark.parametrize("partitions", ["1", "200"])
def test_split_matches_brute_force_whatever_the_partitions(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame(ROWS, "row_id bigint, domain string").repartition(7)
        found = split_of(df)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == expected_split(ROWS)
    assert found[9500] == "test"


@pytest.mark.parametrize("train, val", [(0.0, 0.5), (0.5, 0.0), (1.0, 0.0), (0.29, 0.57)])
def test_split_fractions(spark, train, val):
    rows = [(i, "legal") for i in range(100)]
    df = spark.createDataFrame(rows, "row_id bigint, domain string")
    assert split_of(df, train_frac=train, val_frac=val, seed=1) == expected_split(rows, train, val, 1)


def test_split_sizes_and_no_overlap(spark):
    df = spark.createDataFrame([(i, "legal") for i in range(100)], "row_id bigint, domain string")
    split = splitting.stratified_split(df, 0.8, 0.1, seed=1)
    counts = {r.split: r.n_rows for r in splitting.split_counts(split).collect()}
    assert counts == {"train": 80, "val": 10, "test": 10}
    assert splitting.split_overlap(split).count() == 0
    assert splitting.split_overlap(split.union(split.limit(3))).count() == 3


def test_split_plan_does_not_shuffle_the_rows(spark):
    df = spark.range(5000).selectExpr("id as row_id", "if(id % 2 = 0, 'a', 'b') as domain", "repeat('x', 50) as text")
    plan = splitting.stratified_split(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan.split("InMemoryRelation")[0]


def test_join_takes_over_when_the_cuts_are_too_many_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr("millrace.session.BROADCAST_ROWS", 0)
    df = spark.createDataFrame(ROWS, "row_id bigint, domain string")
    assert split_of(df) == expected_split(ROWS)


@pytest.mark.parametrize("limit", [0, 1, 17, 500, 9999])
def test_seeded_sample(spark, limit):
    df = spark.range(500).withColumnRenamed("id", "row_id")
    found = {r.row_id for r in ranking.seeded_sample(df, limit, seed=7).collect()}
    assert found == set(sorted(range(500), key=lambda r: key(r, 7))[:limit])


def test_first_rows(spark):
    df = spark.range(100).select((F.col("id") * 3).alias("row_id")).repartition(5)
    assert sorted(r.row_id for r in ranking.first_rows(df, 4).collect()) == [0, 3, 6, 9]
    assert ranking.first_rows(df, 1000).count() == 100


def test_ranks(spark):
    rows = [(i, "a" if i % 3 else "b") for i in range(300)]
    df = spark.createDataFrame(rows, "row_id bigint, domain string")
    ranks = {(r.domain, r.row_id): r["rank"] for r in ranking.with_rank(df, 42, ["domain"]).collect()}
    for domain in "ab":
        ordered = sorted((i for i, d in rows if d == domain), key=key)
        assert [ranks[domain, i] for i in ordered] == list(range(1, len(ordered) + 1))


def test_collate_pads_truncates_and_masks(spark):
    rows = [(i, [i + 1] * (i % 5 + 1)) for i in range(11)] + [(11, list(range(1, 9)))]
    df = spark.createDataFrame(rows, "row_id bigint, ids array<int>")
    out = collating.collate(df, batch_size=4, max_length=6).collect()
    data, order = dict(rows), sorted((r[0] for r in rows), key=key)
    assert Counter(r.batch for r in out) == {0: 4, 1: 4, 2: 4}
    for r in out:
        batch = [data[i][:6] for i in order[r.batch * 4 : r.batch * 4 + 4]]
        own, width = data[r.row_id][:6], max(map(len, batch))
        pad = width - len(own)
        assert own in batch
        assert r.input_ids == own + [0] * pad
        assert r.attention_mask == [1] * len(own) + [0] * pad
        assert r.labels == own + [-100] * pad


def test_few_shot_samples_stay_in_one_domain_without_repeats(spark):
    rows = [(i, "big", "do", f"in{i}", f"out{i}") for i in range(400)] + [
        (900 + i, "tiny", "do", f"in{i}", f"out{i}") for i in range(2)
    ]
    train = spark.createDataFrame(
        rows, "row_id bigint, domain string, instruction string, input string, output string"
    )
    samples = augmenting.few_shot_samples(train, calls=40, shots=3).collect()
    calls = {}
    for r in samples:
        calls.setdefault(r.call, []).append(r)
    assert set(calls) == set(range(40))
    for members in calls.values():
        domain = {m.domain for m in members}
        assert len(domain) == 1
        assert len({m.row_id for m in members}) == len(members) == (2 if domain == {"tiny"} else 3)
    again = augmenting.few_shot_samples(train.repartition(5), calls=40, shots=3).collect()
    assert sorted(samples) == sorted(again)
    prompts = augmenting.synthesis_prompts(augmenting.few_shot_samples(train, calls=4)).collect()
    assert len(prompts) == 4 and all("further records" in p.prompt for p in prompts)


def test_null_ids_fail(spark):
    from millrace.operators import dedup, splitting

    rows = spark.createDataFrame([(None, "d", "a"), (1, "d", "b")], "row_id long, domain string, q string")
    for job in (splitting.stratified_split, dedup.deduplicate):
        with pytest.raises(Exception, match="row_id is null"):
            job(rows).collect()


def test_missing_and_empty_domains_are_two_strata(spark):
    from millrace.operators import splitting

    rows = spark.createDataFrame([(i, None if i < 10 else "") for i in range(20)], "row_id long, domain string")
    got = {(r.domain, r.split): r.n_rows for r in splitting.split_counts(splitting.stratified_split(rows)).collect()}
    assert got == {(d, s): n for d in ("unknown", "") for s, n in (("train", 8), ("val", 1), ("test", 1))}


def test_nothing_stays_cached(spark):
    from millrace.operators import splitting

    rows = spark.range(50).selectExpr("id AS row_id", "'d' AS domain")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    splitting.stratified_split(rows).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_large_buckets_are_counted_by_further_digits(spark, monkeypatch):
    """16 buckets at first and 16 rows at most to sort: three rounds, and the same rows as with one."""
    from pyspark.sql import functions as F

    rows = [(i, "a" if i % 5 else "b") for i in range(3000)]
    df = spark.createDataFrame(rows, "row_id bigint, domain string")

    def found():
        keyed = ranking.keyed(df, 42)
        profiles = ranking.group_profiles(keyed, ["domain"])
        ranks = F.explode(F.array(*[F.lit(r) for r in (1, 2, 17, 300, 599, 600)])).alias("rank")
        wanted = profiles.select("domain", "steps", ranks)
        got = ranking.rows_at_ranks(keyed, wanted, ["domain"], ["row_id"])
        return {(r["domain"], r["rank"]): r["row_id"] for r in got.collect()}, keyed, wanted

    expected = found()[0]
    for domain in "ab":
        order = sorted((i for i, d in rows if d == domain), key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), str(i)))
        assert {r: expected[domain, r] for r in (1, 2, 17, 300, 599, 600)} == {r: order[r - 1] for r in (1, 2, 17, 300, 599, 600)}
    sample = sorted(r.row_id for r in ranking.seeded_sample(df.drop("domain"), 700).collect())
    monkeypatch.setattr(ranking, "DIGITS", 1)
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 16)
    got, keyed, wanted = found()
    assert got == expected
    candidates, _ = ranking.sortable_buckets(keyed, wanted, ["domain"], ["row_id"])
    largest = candidates.groupBy("domain", ranking.BUCKET).count().agg(F.max("count")).first()[0]
    assert 0 < largest <= 16
    assert sorted(r.row_id for r in ranking.seeded_sample(df.drop("domain"), 700).collect()) == sample

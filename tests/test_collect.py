import hashlib

from millrace.operators import collect


def first(n, limit, seed):
    return set(sorted(range(n), key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())[:limit])


def test_collectors_sample_project_and_stack(spark):
    legal = spark.createDataFrame([(i, "x" * 5000, f"s{i}") for i in range(50)], "row_id bigint, text string, summary string")
    medical = spark.createDataFrame([(i, f"q{i}", f"a{i}") for i in range(5)], "row_id bigint, input string, output string")
    support = spark.createDataFrame([(i, f"t{i}", f"r{i}") for i in range(20)], "row_id bigint, instruction string, response string")
    frames = (
        collect.collect_legal(legal, limit=7, seed=3),
        collect.collect_medical(medical),
        collect.collect_support(support, limit=20),
    )
    rows = collect.union_domains(*frames).collect()
    by_domain = {d: [r for r in rows if r.domain == d] for d in ("legal", "medical", "support")}
    assert {r.row_id for r in by_domain["legal"]} == first(50, 7, 3)
    assert all(len(r.text) == 4000 and r.source == "billsum" and r.ticket is None for r in by_domain["legal"])
    assert {(r.question, r.answer, r.source) for r in by_domain["medical"]} == {
        (f"q{i}", f"a{i}", "medical_flashcards") for i in range(5)
    }
    assert {(r.ticket, r.resolution, r.source) for r in by_domain["support"]} == {
        (f"t{i}", f"r{i}", "bitext") for i in range(20)
    }


def test_plans_do_not_sort_wide_rows_for_a_sample(spark):
    legal = spark.range(1000).selectExpr("id as row_id", "repeat('x', 100) as text", "'s' as summary")
    plan = collect.collect_legal(legal, limit=10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan

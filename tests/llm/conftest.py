import random

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table of (id, text) or (id, text, source), with columns of clashing names."""

    def make(*rows, extra=True):
        data = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None) for r in rows]
        df = spark.createDataFrame(data, DOCS)
        if extra:
            for name in ("key", "node", "spans", "size", "h", "id", "part", "uid", "c0", "entities", "toxic"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df.repartition(3)

    return make


@pytest.fixture(scope="session")
def sf_docs(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    return {r["doc_id"]: r for r in df.collect()}


@pytest.fixture
def words():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(3000)]
    return lambda n, seed: " ".join(random.Random(seed).choices(vocabulary, k=n))

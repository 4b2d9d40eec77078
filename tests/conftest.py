import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Apply a column function to single values: evaluate(f, "text") or evaluate(f, ("a", "b"))."""
    from pyspark.sql import functions as F

    def run(function, *rows):
        tuples = [r if isinstance(r, tuple) else (r,) for r in rows]
        names = [f"c{i}" for i in range(len(tuples[0]))]
        data = [(i, *t) for i, t in enumerate(tuples)]
        schema = ", ".join(["i int", *[f"{n} string" for n in names]])
        df = spark.createDataFrame(data, schema)
        out = df.select("i", function(*[F.col(n) for n in names]).alias("value"))
        values = [r["value"] for r in sorted(out.collect(), key=lambda r: r["i"])]
        return values[0] if len(values) == 1 else values

    return run

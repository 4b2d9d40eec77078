"""Drift of live queries against the training inputs: text length and unseen words."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.stats import ks_p_value
from millrace.functions.text import words
from millrace.session import stage

# Rows needed for a verdict, and the strict thresholds.
MIN_LIVE_ROWS = 30
P_THRESHOLD = 0.01
OOV_THRESHOLD = 0.25


def _sides(train: DataFrame, live: DataFrame, by: list[str]) -> DataFrame:
    """Word lists of both text sets; a missing training input is an empty text."""
    texts = train.select(
        *by, F.lit(0).alias("is_live"), F.coalesce("input", F.lit("")).alias("text")
    ).unionByName(live.select(*by, F.lit(1).alias("is_live"), F.col("query").alias("text")))
    return texts.select(*by, "is_live", words(F.col("text")).alias("words"))


def _per_side(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Count both sides per key, in one aggregation with map-side combining."""
    return rows.groupBy(*keys).agg(
        F.count_if(F.col("is_live") == 0).alias("in_train"),
        F.count_if(F.col("is_live") == 1).alias("in_live"),
    )


def length_histogram(train: DataFrame, live: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Texts per word count on each side."""
    by = by or []
    rows = _sides(train, live, by).withColumn("n_words", F.size("words"))
    return _per_side(rows, [*by, "n_words"])


def word_uses(train: DataFrame, live: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Occurrences of each word on each side; a word is one row however common it is."""
    by = by or []
    rows = _sides(train, live, by).select(*by, "is_live", F.explode("words").alias("word"))
    return _per_side(rows, [*by, "word"])


def text_profile(train: DataFrame, live: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Both counts from one pass over the texts: ``word`` is null in the rows about lengths."""
    by = by or []
    length = F.struct(F.lit(None).cast("string").alias("word"), F.size("words").alias("n_words"))
    each = F.transform(
        "words", lambda w: F.struct(w.alias("word"), F.lit(None).cast("int").alias("n_words"))
    )
    rows = _sides(train, live, by).select(*by, "is_live", F.inline(F.concat(F.array(length), each)))
    return _per_side(rows, [*by, "word", "n_words"])


def ks_of_histogram(histogram: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Two-sample KS statistic and p-value; running sums go over lengths, never over rows."""
    by = by or []
    whole = Window.partitionBy(*by)
    upto = whole.orderBy("n_words").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n, m = F.sum("in_train").over(whole), F.sum("in_live").over(whole)
    train_share = F.sum("in_train").over(upto) / F.nullif(n, F.lit(0))
    live_share = F.sum("in_live").over(upto) / F.nullif(m, F.lit(0))
    gaps = histogram.select(
        *by,
        n.alias("train_total"),
        m.alias("live_total"),
        F.abs(train_share - live_share).alias("gap"),
    )
    stats = gaps.groupBy(*by).agg(
        F.max("train_total").alias("train_rows"),
        F.max("live_total").alias("live_rows"),
        F.max("gap").alias("ks"),
    )
    return stats.withColumn(
        "p_value", ks_p_value(F.col("ks"), F.col("train_rows"), F.col("live_rows"))
    )


def ks_lengths(train: DataFrame, live: DataFrame, by: list[str] | None = None) -> DataFrame:
    return ks_of_histogram(length_histogram(train, live, by), by)


def vocabulary(train: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Distinct words of the training inputs; repeats within a text go before the shuffle."""
    by = by or []
    found = F.explode(F.array_distinct(words(F.coalesce("input", F.lit("")))))
    return train.select(*by, found.alias("word")).distinct()


def oov_of_uses(uses: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Share of live word occurrences that training never saw."""
    unseen = F.when(F.col("in_train") == 0, F.col("in_live"))
    return (
        uses.groupBy(*(by or []))
        .agg(
            F.coalesce(F.sum("in_live"), F.lit(0)).alias("live_words"),
            F.coalesce(F.sum(unseen), F.lit(0)).alias("unseen_words"),
        )
        .withColumn("oov_rate", F.col("unseen_words") / F.greatest("live_words", F.lit(1)))
    )


def oov_rate(train: DataFrame, live: DataFrame, by: list[str] | None = None) -> DataFrame:
    return oov_of_uses(word_uses(train, live, by), by)


def drift_verdict(
    train: DataFrame,
    live: DataFrame,
    by: list[str] | None = None,
    p_threshold: float = P_THRESHOLD,
    oov_threshold: float = OOV_THRESHOLD,
) -> DataFrame:
    """One row, or one per group with live rows: the statistics and the status.

    "insufficient" below 30 live rows, else "drift" or "ok". The texts are read once: their
    profile is written, and both statistics come from it. The two small results are stacked
    and folded together rather than joined.
    """
    by = by or []
    numbers = ["train_rows", "live_rows", "ks", "p_value", "live_words", "unseen_words", "oov_rate"]
    profile = stage(text_profile(train, live, by), "profile")
    stacked = ks_of_histogram(profile.where("word is null"), by).unionByName(
        oov_of_uses(profile.where("word is not null"), by), allowMissingColumns=True
    )
    folded = stacked.groupBy(*by).agg(*[F.max(c).alias(c) for c in numbers])
    filled = folded.fillna(0, ["live_words", "unseen_words"]).fillna(0.0, ["oov_rate"])
    shifted = (F.col("p_value") < p_threshold) | (F.col("oov_rate") > oov_threshold)
    status = (
        F.when(F.col("live_rows") < MIN_LIVE_ROWS, "insufficient")
        .when(shifted, "drift")
        .otherwise("ok")
    )
    return filled.where("live_rows > 0" if by else "true").withColumn("status", status)


def drift_by_domain(train: DataFrame, live: DataFrame, **thresholds) -> DataFrame:
    return drift_verdict(train, live, by=["domain"], **thresholds)

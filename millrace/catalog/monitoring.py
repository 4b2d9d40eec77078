"""Drift in batch, and the usage log as a stream."""

from pyspark.sql import functions as F

from millrace.catalog import sql
from millrace.operators import drift
from millrace.session import scratch_dir, stage
from millrace.sources import bindings
from millrace.streaming import usage

NUMBERS = ("ks", "p_value", "oov_rate")


def _both(spark, sf_dir):
    return bindings.drift_train(spark, sf_dir), bindings.drift_live(spark, sf_dir)


def _rounded(df):
    return df.select(*[F.round(c, 9).alias(c) if c in NUMBERS else c for c in df.columns])


def _shown(windows):
    return windows.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"),
        "domain",
        "n_rows",
        F.round("mean_latency_ms", 6).alias("mean_latency_ms"),
        "n_words",
        "unseen_words",
        F.round("oov_rate", 9).alias("oov_rate"),
    )


def _vocabulary(spark, sf_dir):
    return stage(drift.vocabulary(bindings.drift_train(spark, sf_dir)), "vocabulary")


def usage_windows_batch(spark, sf_dir):
    log = bindings.usage_events(bindings.table(spark, sf_dir, "events"))
    return _shown(usage.windowed_usage(log, _vocabulary(spark, sf_dir)))


def usage_windows_stream(spark, sf_dir):
    """The events table read as a stream of usage records, all windows."""
    schema = bindings.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    store = scratch_dir(spark, "usage-store")
    usage.follow(bindings.usage_events(events), store, _vocabulary(spark, sf_dir), once=True).awaitTermination()
    return _shown(usage.read_windows(spark, store))


QUERIES = {
    "length_histogram": lambda s, d: drift.length_histogram(*_both(s, d)),
    "length_ks": lambda s, d: _rounded(drift.ks_lengths(*_both(s, d))),
    "length_ks_by_domain": lambda s, d: _rounded(drift.ks_lengths(*_both(s, d), by=["domain"])),
    "train_vocabulary": lambda s, d: drift.vocabulary(bindings.drift_train(s, d)),
    "word_uses": lambda s, d: drift.word_uses(*_both(s, d)),
    "oov_rate": lambda s, d: _rounded(drift.oov_rate(*_both(s, d))),
    "drift_verdict": lambda s, d: _rounded(drift.drift_verdict(*_both(s, d))),
    "drift_by_domain": lambda s, d: _rounded(drift.drift_by_domain(*_both(s, d))),
    "usage_windows_batch": usage_windows_batch,
    "usage_windows_stream": usage_windows_stream,
}

_SIDES = f"""{sql.SUPPORT},
sides AS (
  SELECT lang AS domain, 0 AS is_live, {sql.words('text')} AS w FROM documents
  UNION ALL
  SELECT ['en', 'fr', 'de', 'es'][conv_id % 4 + 1], 1, {sql.words('instruction')} FROM support)"""


def _drift(keys: str) -> str:
    """CTEs for KS and unseen words, overall (``keys`` a constant) or per domain."""
    return f"""{_SIDES},
keyed AS (SELECT {keys} AS k, is_live, w FROM sides),
totals AS (
  SELECT k, count(*) FILTER (is_live = 0) AS n, count(*) FILTER (is_live = 1) AS m FROM keyed GROUP BY k),
hist AS (
  SELECT k, len(w) AS x, count(*) FILTER (is_live = 0) AS a, count(*) FILTER (is_live = 1) AS b
  FROM keyed GROUP BY ALL),
running AS (
  SELECT k, sum(a) OVER upto AS ca, sum(b) OVER upto AS cb FROM hist
  WINDOW upto AS (PARTITION BY k ORDER BY x)),
ks AS (
  SELECT k, n::BIGINT AS train_rows, m::BIGINT AS live_rows, max(abs(ca / n - cb / m)) AS ks
  FROM running JOIN totals USING (k) GROUP BY ALL),
ks_p AS (
  SELECT *, CASE WHEN l < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, 2 * list_sum(list_transform(range(1, 101),
      lambda j: (CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * j * j * l * l))))) END AS p_value
  FROM (SELECT *, ks * (s + 0.12 + 0.11 / s) AS l
    FROM (SELECT *, sqrt(train_rows::DOUBLE * live_rows / (train_rows + live_rows)) AS s FROM ks))),
oov AS (
  SELECT k, count(*) AS live_words, count(*) FILTER (known IS NULL) AS unseen_words
  FROM (SELECT k, unnest(w) AS word FROM keyed WHERE is_live = 1)
  LEFT JOIN (SELECT DISTINCT k, unnest(w) AS word, true AS known FROM keyed WHERE is_live = 0) USING (k, word)
  GROUP BY k),
verdict AS (
  SELECT *, unseen_words / greatest(live_words, 1) AS oov_rate FROM ks_p JOIN oov USING (k))"""


_VERDICT = """train_rows, live_rows, round(ks, 9) AS ks, round(p_value, 9) AS p_value, live_words,
  unseen_words, round(oov_rate, 9) AS oov_rate,
  CASE WHEN live_rows < 30 THEN 'insufficient' WHEN p_value < 0.01 OR oov_rate > 0.25 THEN 'drift'
    ELSE 'ok' END AS status FROM verdict"""

_WINDOWS = f"""WITH known AS (SELECT DISTINCT unnest({sql.words('text')}) AS word, true AS known FROM documents),
log AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, event_type AS domain, round(value * 10) AS ms,
  {sql.words('props')} AS w FROM events),
traffic AS (SELECT day, domain, count(*) AS n_rows, round(avg(ms), 6) AS mean_latency_ms FROM log GROUP BY ALL),
uses AS (
  SELECT day, domain, count(*) AS n_words, count(*) FILTER (known IS NULL) AS unseen_words
  FROM (SELECT day, domain, unnest(w) AS word FROM log) LEFT JOIN known USING (word) GROUP BY ALL)
SELECT day, domain, n_rows, mean_latency_ms, n_words, unseen_words,
  round(unseen_words / greatest(n_words, 1), 9) AS oov_rate
FROM traffic JOIN uses USING (day, domain)"""

ORACLES = {
    "length_histogram": f"""WITH {_SIDES}
SELECT len(w)::INT AS n_words, count(*) FILTER (is_live = 0) AS in_train,
  count(*) FILTER (is_live = 1) AS in_live FROM sides GROUP BY 1""",
    "word_uses": f"""WITH {_SIDES}
SELECT word, count(*) FILTER (is_live = 0) AS in_train, count(*) FILTER (is_live = 1) AS in_live
FROM (SELECT is_live, unnest(w) AS word FROM sides) GROUP BY word""",
    "length_ks": f"""WITH {_drift("'all'")}
SELECT train_rows, live_rows, round(ks, 9) AS ks, round(p_value, 9) AS p_value FROM ks_p""",
    "length_ks_by_domain": f"""WITH {_drift("domain")}
SELECT k AS domain, train_rows, live_rows, round(ks, 9) AS ks, round(p_value, 9) AS p_value FROM ks_p""",
    "train_vocabulary": f"SELECT DISTINCT unnest({sql.words('text')}) AS word FROM documents",
    "oov_rate": f"""WITH {_drift("'all'")}
SELECT live_words, unseen_words, round(oov_rate, 9) AS oov_rate FROM verdict""",
    "drift_verdict": f"""WITH {_drift("'all'")} SELECT {_VERDICT}""",
    "drift_by_domain": f"""WITH {_drift("domain")} SELECT k AS domain, {_VERDICT}""",
    "usage_windows_batch": _WINDOWS,
    "usage_windows_stream": _WINDOWS,
}

"""Masking, exact dedup, quality."""

from pyspark.sql import functions as F

from millrace.catalog import sql
from millrace.functions import pii
from millrace.operators import dedup, quality, scrub
from millrace.sources import bindings


def _texts(spark, sf_dir):
    """All document and page texts, which hold the personal data."""
    return bindings.document_texts(spark, sf_dir).withColumn("kind", F.lit("document")).unionByName(
        bindings.page_texts(spark, sf_dir).withColumn("kind", F.lit("page"))
    )


def _mask(mask):
    return lambda s, d: _texts(s, d).select("kind", "row_id", mask(F.col("text")).alias("masked"))


def luhn_numbers(spark, sf_dir):
    number = F.concat("l_orderkey", "l_linenumber", F.lit("-"), "l_partkey", F.lit(" "), "l_suppkey")
    return bindings.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", number.alias("number"), pii.luhn_valid(number).alias("valid")
    )


def scrubbed_records(spark, sf_dir):
    return scrub.scrub_records(bindings.mixed_raw(spark, sf_dir))


def deduplicated(spark, sf_dir):
    return dedup.deduplicate(bindings.document_texts(spark, sf_dir))


def deduplicated_mixed(spark, sf_dir):
    unique = dedup.deduplicate(scrubbed_records(spark, sf_dir), staged=True)
    return unique.select("row_id", "domain")


def _with(column, name):
    def query(spark, sf_dir):
        raw = bindings.mixed_raw(spark, sf_dir)
        return raw.select("row_id", column(raw).alias(name))

    return query


QUERIES = {
    "masked_email": _mask(pii.mask_email),
    "masked_ssn": _mask(pii.mask_ssn),
    "masked_card": _mask(pii.mask_card),
    "masked_phone": _mask(pii.mask_phone),
    "masked_ip": _mask(pii.mask_ip),
    "luhn_numbers": luhn_numbers,
    "scrubbed_text": _mask(pii.scrub),
    "scrubbed_records": scrubbed_records,
    "mask_counts": lambda s, d: scrub.mask_counts(bindings.mixed_raw(s, d)),
    "dedup_keys": _with(dedup.dedup_key, "dedup_key"),
    "deduplicated": deduplicated,
    "deduplicated_mixed": deduplicated_mixed,
    "dedup_counts": lambda s, d: dedup.dedup_counts(bindings.document_texts(s, d)),
    "no_empty_value": _with(quality.no_empty_value, "no_empty_value"),
    "length_band": _with(lambda df: quality.total_length(df).between(30, 8000), "in_band"),
    "letter_ratio": _with(lambda df: F.round(quality.letter_ratio(df), 9), "letter_ratio"),
    "quality_kept": lambda s, d: quality.keep_good(bindings.mixed_raw(s, d)).select("row_id", "domain"),
    "quality_counts": lambda s, d: quality.quality_counts(bindings.mixed_raw(s, d)),
}

_TEXTS = """texts AS (
  SELECT 'document' AS kind, doc_id AS row_id, text AS t FROM documents
  UNION ALL SELECT 'page', page_id, html FROM pages)"""


def _mask_sql(label: str) -> str:
    masked = sql.MASKS[label]("t")
    return f"""WITH {_TEXTS},
marked AS (SELECT kind, row_id, {sql.marked('t')} AS t FROM texts)
SELECT kind, row_id, {sql.unmarked(f'({masked})')} AS masked FROM marked"""


_COUNTS = " UNION ALL ".join(
    f"""SELECT '{label}' AS label, coalesce(sum(
  (length(s.t) - length(replace(s.t, '[{label}]', ''))) // {len(label) + 2}
  - (length(c.t) - length(replace(c.t, '[{label}]', ''))) // {len(label) + 2}), 0)::BIGINT AS masked
FROM scrubbed s JOIN cells c USING (row_id, col)"""
    for label in sql.MASKS
)
_NUMBER = "concat(l_orderkey, l_linenumber, '-', l_partkey, ' ', l_suppkey)"

ORACLES = {
    "masked_email": _mask_sql("EMAIL"),
    "masked_ssn": _mask_sql("SSN"),
    "masked_card": _mask_sql("CREDIT_CARD"),
    "masked_phone": _mask_sql("PHONE"),
    "masked_ip": _mask_sql("IP_ADDRESS"),
    "luhn_numbers": f"""SELECT l_orderkey, l_linenumber, number, {sql.luhn('number')} AS valid
FROM (SELECT l_orderkey, l_linenumber, {_NUMBER} AS number FROM lineitem)""",
    "scrubbed_text": f"""WITH {_TEXTS},
{sql.scrub_steps('texts', 'kind, row_id')}
SELECT kind, row_id, t AS masked FROM scrubbed""",
    "scrubbed_records": f"WITH {sql.MIXED_SCRUBBED} SELECT * FROM clean",
    "mask_counts": f"WITH {sql.MIXED_SCRUBBED} {_COUNTS}",
    "dedup_keys": f"WITH {sql.MIXED} SELECT row_id, {sql.content_key()} AS dedup_key FROM mixed",
    "deduplicated": f"""SELECT row_id, text FROM (
  SELECT doc_id AS row_id, text, row_number() OVER (
    PARTITION BY {sql.content_key(('text',))} ORDER BY doc_id) AS copy FROM documents)
WHERE copy = 1""",
    "deduplicated_mixed": f"""WITH {sql.MIXED_SCRUBBED}
SELECT row_id, domain FROM clean
QUALIFY row_number() OVER (PARTITION BY {sql.content_key()} ORDER BY row_id) = 1""",
    "dedup_counts": f"""SELECT count(*) AS rows_before,
  count(DISTINCT {sql.content_key(('text',))}) AS rows_after FROM documents""",
    "no_empty_value": f"""WITH {sql.MIXED}
SELECT row_id, {' AND '.join(f'coalesce(NOT ({sql.blank(c)}), true)' for c in sql.CONTENT)}
  AS no_empty_value FROM mixed""",
    "length_band": f"""WITH {sql.MIXED}
SELECT row_id, {' + '.join(f'coalesce(length({c}), 0)' for c in sql.CONTENT)} BETWEEN 30 AND 8000
  AS in_band FROM mixed""",
    "letter_ratio": f"""WITH {sql.MIXED}
SELECT row_id, round({sql.letter_ratio()}, 9) AS letter_ratio FROM mixed""",
    "quality_kept": f"""WITH {sql.MIXED}
SELECT row_id, domain FROM mixed WHERE {sql.quality_reason()} IS NULL""",
    "quality_counts": f"""WITH {sql.MIXED}
SELECT coalesce({sql.quality_reason()}, 'kept') AS outcome, count(*) AS n_rows
FROM mixed GROUP BY 1""",
}

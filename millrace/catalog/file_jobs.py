"""The file jobs over records whose keys hold values of several types."""

from functools import reduce
from string import ascii_lowercase

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog import sql
from millrace.functions.pii import LABELS
from millrace.operators import variant_records
from millrace.plans import files
from millrace.session import scratch_dir
from millrace.sources import bindings, jsonl, schemas

DIGITS = "0123456789" * 2 + "012345"
PRINTED = ("answer", "chars", "note", "question", "resolution", "summary", "text", "ticket")


def _lines(mixed: DataFrame) -> DataFrame:
    """Records of the mixed table as JSON: numbers and flags among texts, and keys with a null.

    Some tickets are a number and some answers a flag, some legal records have the number 5 as
    domain, all of them a count of characters, and some support records a note that is null. Half of the
    replies to a number are digits in place of small letters.
    """
    number = (F.col("domain") == "support") & (F.length("ticket") % 5 == 0)
    flag = (F.col("domain") == "medical") & (F.length("question") % 6 == 0)
    odd = (F.col("domain") == "legal") & (F.length("summary") % 9 == 0)
    none = F.length("resolution") % 7 == 0
    digits = F.when(number & (F.length("resolution") % 2 == 0), F.translate("resolution", ascii_lowercase, DIGITS))
    texts = F.to_json(
        F.struct(
            F.when(~odd, F.col("domain")).alias("domain"), "source", "text", "summary", "question", F.coalesce(digits, "resolution").alias("resolution"),
            F.when(~flag, F.col("answer")).alias("answer"), F.when(~number, F.col("ticket")).alias("ticket"),
        )
    )
    more = [
        F.when(number, F.concat(F.lit(',"ticket":'), F.length("ticket").cast("string"))),
        F.when(flag, F.lit(',"answer":true')),
        F.when(odd, F.lit(',"domain":5')),
        F.when(none, F.lit(',"note":null')),
        F.concat(F.lit(',"chars":'), F.length("text").cast("string")),
    ]
    line = F.concat(F.expr("left(t, length(t) - 1)"), *[F.coalesce(m, F.lit("")) for m in more], F.lit("}"))
    return mixed.withColumn("t", texts).select("row_id", "domain", line.alias("value"))


def _value(held, key: str):
    value = F.try_element_at(held, F.lit(key))
    kind = F.schema_of_variant(value)
    return F.when(kind == "STRING", F.try_variant_get(value, "$", "string")).otherwise(F.to_json(value)), kind


def file_jobs(spark, sf_dir):
    """What the files of the last two jobs hold, and the counts that all jobs return."""
    root = scratch_dir(spark, "jobs")
    mixed = bindings.mixed_raw(spark, sf_dir)
    for name in ("legal", "medical", "support"):
        ordered = mixed.where(F.col("domain") == name).repartitionByRange("row_id").sortWithinPartitions("row_id")
        jsonl.write_lines(_lines(ordered).select("value"), f"{root}/raw/{name}.jsonl")
    at = {n: f"{root}/{n}" for n in ("cleaned", "formatted", "splits")}
    scrubbed = files.scrub_files(spark, f"{root}/raw/*.jsonl", at["cleaned"])
    unique = files.dedup_files(spark, at["cleaned"], at["cleaned"])
    good = files.filter_files(spark, at["cleaned"], at["cleaned"])
    formed = files.format_files(spark, at["cleaned"], at["formatted"])
    split = files.split_files(spark, at["cleaned"], at["splits"])

    def rows(df, step, split, held):
        domain, domain_kind = _value(held, "domain") if held is not None else (F.col("domain"), F.lit("STRING"))
        ticket_kind = _value(held, "ticket")[1] if held is not None else F.lit(None).cast("string")
        texts = [_value(held, c)[0] for c in PRINTED] if held is not None else ["instruction", "input", "output"]
        return df.select(
            F.lit(step).alias("step"), "row_id", split.alias("split"), domain.alias("domain"), domain_kind.alias("domain_kind"),
            ticket_kind.alias("ticket_kind"), F.md5(F.concat_ws("|", *texts)).alias("digest"),
        )

    none = F.lit(None).cast("string")
    parts = [rows(spark.read.schema(schemas.EXAMPLE).json(at["formatted"]), "formatted", none, None)]
    for name in files.SPLITS:
        some = files.records(spark, f"{at['splits']}/split={name}") if split[name] else None
        if some is not None:
            held = some.withColumn("held", variant_records.entries(F.col("record")))
            parts.append(rows(held, "split", F.lit(name), F.col("held")))
    counts = {
        "scrubbed": scrubbed["rows"], **{f"masked {k}": v for k, v in scrubbed["masked"].items()},
        "dedup in": unique["rows_in"], "dedup out": unique["rows_out"], "good": good["rows_out"],
        **{f"dropped {k}": v for k, v in good["dropped"].items()},
        "format in": formed["rows_in"], "format out": formed["rows_out"], **split,
    }
    seen = spark.createDataFrame(list(counts.items()), "domain string, row_id bigint").select(
        F.lit("count").alias("step"), "row_id", none.alias("split"), "domain", none.alias("domain_kind"),
        none.alias("ticket_kind"), none.alias("digest"),
    )
    return reduce(DataFrame.unionByName, [*parts, seen])


QUERIES = {"file_jobs": file_jobs}

_KEY = "concat_ws(' ', printed_answer, chars::VARCHAR, note, question, resolution, summary, text, printed_ticket)"
_MASKED = " UNION ALL ".join(
    f"""SELECT 'masked {label}', coalesce(sum(
  (length(s.t) - length(replace(s.t, '[{label}]', ''))) // {len(label) + 2}
  - (length(c.t) - length(replace(c.t, '[{label}]', ''))) // {len(label) + 2}), 0)
FROM scrubbed s JOIN cells c USING (row_id, col)"""
    for label in LABELS
)
_CELLS = " UNION ALL ".join(f"SELECT row_id, '{c}' AS col, {c} AS t FROM typed WHERE {c} IS NOT NULL" for c in sql.CONTENT)

ORACLES = {
    "file_jobs": f"""WITH {sql.MIXED},
typed AS (
  SELECT row_number() OVER (ORDER BY row_id) - 1 AS row_id, text, summary, question,
    CASE WHEN length(ticket) % 5 = 0 AND length(resolution) % 2 = 0
      THEN translate(resolution, '{ascii_lowercase}', '{DIGITS}') ELSE resolution END AS resolution,
    CASE WHEN domain = 'legal' AND length(summary) % 9 = 0 THEN '5' ELSE domain END AS domain,
    CASE WHEN domain = 'legal' AND length(summary) % 9 = 0 THEN 'BIGINT' ELSE 'STRING' END AS domain_kind,
    CASE WHEN length(question) % 6 = 0 THEN NULL ELSE answer END AS answer,
    CASE WHEN length(question) % 6 = 0 THEN 'true' END AS flag,
    CASE WHEN length(ticket) % 5 = 0 THEN NULL ELSE ticket END AS ticket,
    CASE WHEN length(ticket) % 5 = 0 THEN length(ticket)::VARCHAR END AS number,
    CASE WHEN length(resolution) % 7 = 0 THEN 'none' END AS note, length(text) AS chars
  FROM mixed),
cells AS ({_CELLS}),
{sql.scrub_steps('cells', 'row_id, col')},
clean AS (
  SELECT row_id, {", ".join(f"max(t) FILTER (WHERE col = '{c}') AS {c}" for c in sql.CONTENT)}
  FROM scrubbed GROUP BY row_id),
whole AS (
  SELECT t.row_id, t.domain, t.domain_kind, t.note, t.chars, {", ".join(f"c.{c}" for c in sql.CONTENT)},
    coalesce(t.flag, c.answer) AS printed_answer, coalesce(t.number, c.ticket) AS printed_ticket,
    CASE WHEN t.number IS NOT NULL THEN 'BIGINT' WHEN c.ticket IS NOT NULL THEN 'STRING' END AS ticket_kind
  FROM typed t LEFT JOIN clean c USING (row_id)),
firsts AS (
  SELECT * FROM whole
  QUALIFY row_number() OVER (PARTITION BY md5({sql.squeezed(f'lower({_KEY})')}) ORDER BY row_id) = 1),
judged AS (SELECT *, {sql.quality_reason()} AS reason FROM firsts),
kept AS (SELECT * FROM judged WHERE reason IS NULL),
{sql.FORMATTED},
strata AS (SELECT row_id, CASE domain_kind WHEN 'STRING' THEN 'text:' ELSE 'json:' END || domain AS domain FROM kept),
{sql.split_steps('strata')},
parts AS (
  SELECT 'formatted' AS step, row_id, NULL AS split, domain, 'STRING' AS domain_kind, NULL AS ticket_kind,
    md5(concat_ws('|', instruction, input, output)) AS digest FROM formatted
  UNION ALL
  SELECT 'split', row_id, s.split, k.domain, domain_kind, ticket_kind, md5(concat_ws('|', printed_answer,
    chars::VARCHAR, CASE WHEN note IS NOT NULL THEN 'null' END, question, resolution, summary, text, printed_ticket))
  FROM kept k JOIN split_rows s USING (row_id)),
counts(domain, n) AS (
  SELECT 'scrubbed', count(*) FROM typed UNION ALL {_MASKED}
  UNION ALL SELECT 'dedup in', count(*) FROM whole UNION ALL SELECT 'dedup out', count(*) FROM firsts
  UNION ALL SELECT 'good', count(*) FROM kept
  UNION ALL SELECT 'dropped ' || r, count(reason) FROM (VALUES ('empty'), ('length'), ('letters')) v(r)
    LEFT JOIN judged ON reason = r GROUP BY r
  UNION ALL SELECT 'format in', count(*) FROM kept UNION ALL SELECT 'format out', count(*) FROM formatted
  UNION ALL SELECT s, count(split) FROM (VALUES ('train'), ('val'), ('test')) v(s)
    LEFT JOIN split_rows ON split = s GROUP BY s)
SELECT * FROM parts
UNION ALL SELECT 'count', n::BIGINT, NULL, domain, NULL, NULL, NULL FROM counts""",
}

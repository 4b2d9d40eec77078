"""Sources, sinks and collectors."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog import sql
from millrace.catalog.shaping import REPLIES
from millrace.operators import augmenting, collect, evaluating, splitting
from millrace.operators.ranking import seeded_sample
from millrace.session import scratch_dir
from millrace.sources import bindings, jsonl, schemas

DOCUMENT = "row_id bigint, text string, lang string, source string"
SYNTHETIC = "domain string, instruction string, input string, output string"


def jsonl_scan(spark, sf_dir):
    path = scratch_dir(spark, "scan")
    jsonl.write_jsonl(bindings.documents(spark, sf_dir), path)
    return jsonl.read_jsonl(spark, path, DOCUMENT)


def numbered_records(spark, sf_dir):
    """One folder per domain, each written in id order; whole records come back with ids from file order."""
    root = scratch_dir(spark, "raw")
    sources = {
        "legal": collect.collect_legal(bindings.legal_source(spark, sf_dir), None, max_chars=None),
        "medical": collect.collect_medical(bindings.medical_source(spark, sf_dir), None),
        "support": collect.collect_support(bindings.support_source(spark, sf_dir), None),
    }
    for name, df in sources.items():
        ordered = df.repartitionByRange("row_id").sortWithinPartitions("row_id")
        jsonl.write_jsonl(ordered.withColumnRenamed("row_id", "source_id"), f"{root}/{name}.jsonl")
    schema = schemas.RAW_MIXED.replace("row_id", "source_id")
    return jsonl.number_rows(jsonl.read_jsonl(spark, f"{root}/*.jsonl", schema))


def jsonl_glob_numbered(spark, sf_dir):
    digest = F.md5(F.concat_ws("|", *sql.CONTENT)).alias("digest")
    return numbered_records(spark, sf_dir).select("row_id", "source_id", "domain", digest)


def jsonl_round_trip(spark, sf_dir):
    path = scratch_dir(spark, "trip")
    jsonl.write_jsonl(bindings.mixed_raw(spark, sf_dir), path)
    return jsonl.read_jsonl(spark, path, schemas.RAW_MIXED)


def usage_log_append(spark, sf_dir):
    path = scratch_dir(spark, "usage")
    for _ in range(2):
        jsonl.append_usage(bindings.usage(spark, sf_dir), path)
    return jsonl.read_usage(spark, path)


def train_files_concat(spark, sf_dir):
    root = scratch_dir(spark, "train")
    synthetic = augmenting.synthetic_rows(bindings.list_replies(spark, sf_dir))
    jsonl.write_jsonl(bindings.examples(spark, sf_dir).drop("row_id"), f"{root}/train")
    jsonl.write_jsonl(synthetic.drop("row_id", "item_no"), f"{root}/synthetic")
    return jsonl.concat_files(spark, [f"{root}/train", f"{root}/synthetic"], SYNTHETIC)


def split_sink(spark, sf_dir):
    path = scratch_dir(spark, "splits")
    split = splitting.stratified_split(bindings.language_strata(spark, sf_dir))
    jsonl.write_splits(splitting.with_split_order(split), path, order_by="order_key")
    schema = "row_id bigint, domain string, text string"
    parts = [
        jsonl.read_split(spark, path, name, schema).withColumn("split", F.lit(name))
        for name in ("train", "val", "test")
    ]
    return reduce(DataFrame.unionByName, parts)


def report_sink(spark, sf_dir):
    path = scratch_dir(spark, "report")
    compared = evaluating.compare_by_domain(bindings.results(spark, sf_dir))
    jsonl.write_report(evaluating.report_lines(compared), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def sampled_documents(spark, sf_dir):
    return seeded_sample(bindings.document_texts(spark, sf_dir), limit=300)


QUERIES = {
    "jsonl_scan": jsonl_scan,
    "jsonl_glob_numbered": jsonl_glob_numbered,
    "jsonl_round_trip": jsonl_round_trip,
    "usage_log_append": usage_log_append,
    "train_files_concat": train_files_concat,
    "split_sink": split_sink,
    "report_sink": report_sink,
    "sampled_documents": sampled_documents,
    "collected_legal": lambda s, d: collect.collect_legal(bindings.legal_source(s, d), None),
    "collected_medical": lambda s, d: collect.collect_medical(bindings.medical_source(s, d), None),
    "collected_support": lambda s, d: collect.collect_support(bindings.support_source(s, d), None),
    "united_domains": bindings.mixed_raw,
}

_USAGE = """SELECT (1704067200 + conv_id * 600 + turn * 30)::DOUBLE AS "timestamp", 'support' AS domain,
  instruction AS query, response, (3 * length(response))::INT AS latency_ms, NULL::VARCHAR AS feedback
FROM support"""

ORACLES = {
    "jsonl_scan": "SELECT doc_id AS row_id, text, lang, source FROM documents",
    "jsonl_glob_numbered": f"""WITH {sql.MIXED}
SELECT row_number() OVER (ORDER BY row_id) - 1 AS row_id,
  row_id - CASE domain WHEN 'legal' THEN -low_legal WHEN 'medical' THEN n_legal - low_medical
    ELSE n_legal + n_medical END AS source_id, domain, md5(concat_ws('|', {', '.join(sql.CONTENT)})) AS digest FROM mixed, spans""",
    "jsonl_round_trip": f"WITH {sql.MIXED} SELECT * FROM mixed",
    "usage_log_append": f"WITH {sql.SUPPORT} {_USAGE} UNION ALL {_USAGE}",
    "split_sink": f"""WITH {sql.STRATA_SPLIT}
SELECT row_id, domain, text, split FROM split_rows""",
    "sampled_documents": f"""SELECT doc_id AS row_id, text FROM documents
ORDER BY {sql.shuffle_key(42, 'doc_id')} LIMIT 300""",
    "collected_legal": f"""WITH {sql.LEGAL}
SELECT row_id, 'legal' AS domain, 'billsum' AS source, substring(text, 1, 4000) AS text, summary FROM legal""",
    "collected_medical": f"""WITH {sql.MEDICAL}
SELECT row_id, 'medical' AS domain, 'medical_flashcards' AS source, question, answer FROM medical""",
    "collected_support": f"""WITH {sql.SUPPORT}
SELECT row_id, 'support' AS domain, 'bitext' AS source, instruction AS ticket,
  response AS resolution FROM support""",
    "united_domains": f"WITH {sql.MIXED} SELECT * FROM mixed",
}
ORACLES["train_files_concat"] = f"""WITH {REPLIES}
SELECT 'support' AS domain, {sql.lit(sql.SUPPORT_INSTRUCTION)} AS instruction, instruction AS input,
  response AS output FROM support
UNION ALL SELECT domain, instruction, input, output FROM synthetic"""

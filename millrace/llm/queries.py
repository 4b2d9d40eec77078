"""The queries of this package over the test tables, and SQL where it can express them."""

from pyspark.sql import functions as F

from millrace.llm import (
    decontamination,
    fingerprints,
    hard_negatives,
    manifest,
    mixing,
    ngram_join,
    repeats,
    sanitising,
    secrets,
    sharding,
    sql,
    token_files,
    toxicity,
    url_filter,
)
from millrace.llm.common import documents


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(token_files.TOKENIZER)


def op1_fingerprints(spark, sf_dir):
    return fingerprints.compare_with_next(documents(spark, sf_dir))


def op2_repeats(spark, sf_dir):
    return repeats.remove(documents(spark, sf_dir))


def op3_mixing(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir))


def op4_ngram_join(spark, sf_dir):
    return ngram_join.join(documents(spark, sf_dir))


def op5_secrets(spark, sf_dir):
    return secrets.scan(documents(spark, sf_dir))


def op6_decontamination(spark, sf_dir):
    return decontamination.find(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model)


def op8_token_files(spark, sf_dir):
    return token_files.encode(documents(spark, sf_dir), tokenizer_path())


def op9_url_filter(spark, sf_dir):
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_sanitising(spark, sf_dir):
    return sanitising.find(documents(spark, sf_dir))


def op11_manifest(spark, sf_dir):
    return manifest.audit(documents(spark, sf_dir))


def op12_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label=moved)


def op13_sharding(spark, sf_dir):
    return sharding.assign(documents(spark, sf_dir))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_repeats": op2_repeats,
    "op3_mixing": op3_mixing,
    "op4_ngram_join": op4_ngram_join,
    "op5_secrets": op5_secrets,
    "op6_decontamination": op6_decontamination,
    "op7_toxicity": op7_toxicity,
    "op8_token_files": op8_token_files,
    "op9_url_filter": op9_url_filter,
    "op10_sanitising": op10_sanitising,
    "op11_manifest": op11_manifest,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_sharding": op13_sharding,
}

ORACLES = {
    "op3_mixing": r"""WITH s AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents),
g AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS weight FROM g),
l AS (SELECT *, 2 * source_size AS cap, row_number() OVER r AS spot,
    (sum(source_size) OVER ()::DOUBLE * 1.5 - coalesce(sum(2 * source_size) OVER p, 0)::DOUBLE)
    / (sum(weight) OVER () - coalesce(sum(weight) OVER p, 0))::DOUBLE AS level
  FROM w WINDOW r AS (ORDER BY 2 * source_size / weight, encode(source) NULLS LAST),
    p AS (ORDER BY 2 * source_size / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size,
    least(cap::DOUBLE, coalesce((SELECT arg_min(level, spot) FROM l WHERE cap >= level * weight) * weight, cap)) AS target FROM l),
c AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS copies FROM t),
x AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h ROWS UNBOUNDED PRECEDING) - size / 2 AS reach FROM s)
SELECT x.doc_id, x.size, c.source_size, c.target,
  x.size * (c.copies + CASE WHEN x.reach <= c.target - c.copies * c.source_size THEN 1 ELSE 0 END) AS taken
FROM x JOIN c ON x.source IS NOT DISTINCT FROM c.source""",
    "op9_url_filter": r"""WITH u AS (SELECT page_id, url,
    CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, url, coalesce(translate(regexp_extract(rest, '^[^/?#]*'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*'), '') AS path FROM u),
k AS (SELECT host || path AS key,
    bool_or(coalesce(regexp_matches(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '(^|&)utm_[a-z]+='), false)) AS listed
  FROM p GROUP BY 1),
j AS (SELECT p.*, k.listed, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
  FROM p JOIN k ON k.key = host || path)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN listed THEN 'block' ELSE 'allow' END AS verdict FROM j""",
    **sql.ORACLES,
}

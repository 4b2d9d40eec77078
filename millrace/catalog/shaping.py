"""Formatting, splitting, collating, augmentation."""

from pyspark.sql import functions as F

from millrace.catalog import sql
from millrace.functions import chat
from millrace.operators import augmenting, collating, formatting, splitting
from millrace.plans.prepare import prepare
from millrace.sources import bindings


def prepared_counts(spark, sf_dir):
    """The flagship job: raw records to split examples, counted per domain and split."""
    return splitting.split_counts(prepare(bindings.mixed_raw(spark, sf_dir)))


def domain_specs(spark, sf_dir):
    """Languages stand for domains; those beyond the three known ones drop out."""
    lang = F.col("domain")
    domain = F.when(lang == "en", "legal").when(lang == "fr", "medical").when(lang == "de", "support")
    rows = bindings.language_strata(spark, sf_dir).withColumn("domain", domain.otherwise("cooking"))
    return formatting.with_spec(rows).select("row_id", "domain", "instruction")


def formatted_examples(spark, sf_dir):
    return formatting.format_records(bindings.mixed_raw(spark, sf_dir))


def user_messages(spark, sf_dir):
    """Formatted examples, the input of one domain left out."""
    rows = formatted_examples(spark, sf_dir).withColumn(
        "input", F.when(F.col("domain") != "medical", F.col("input"))
    )
    return formatting.with_user_message(rows).select("row_id", "user_message")


def message_lists(spark, sf_dir):
    rows = formatted_examples(spark, sf_dir)
    full = formatting.with_messages(rows).withColumnRenamed("messages", "with_answer")
    both = formatting.with_messages(full, include_answer=False)
    return both.select(
        "row_id",
        F.to_json("with_answer").alias("with_answer"),
        F.to_json("messages").alias("without_answer"),
    )


def _chat_texts(job, column):
    def query(spark, sf_dir):
        rows = formatted_examples(spark, sf_dir)
        sides = [
            job(rows, template).select("row_id", F.lit(template).alias("template"), column)
            for template in chat.TEMPLATES
        ]
        return sides[0].unionByName(sides[1])

    return query


def stratified_split(spark, sf_dir):
    split = splitting.stratified_split(bindings.language_strata(spark, sf_dir))
    return split.select("row_id", "domain", "split")


def split_order(spark, sf_dir):
    return splitting.with_split_order(stratified_split(spark, sf_dir)).select("row_id", "split", "order_key")


def collated_batches(spark, sf_dir):
    """Batches of all document texts, token arrays shown as text."""
    rows = bindings.document_texts(spark, sf_dir).select("row_id", collating.word_ids(F.col("text")).alias("ids"))
    batches = collating.collate(rows)
    shown = [F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("input_ids", "attention_mask", "labels")]
    return batches.select("batch", "row_id", *shown)


def _train(spark, sf_dir):
    split = splitting.stratified_split(bindings.language_strata(spark, sf_dir))
    return split.where("split = 'train'").select(
        "row_id",
        "domain",
        F.lit("Continue.").alias("instruction"),
        F.substring_index("text", "\n", 1).alias("input"),
        F.col("text").alias("output"),
    )


def few_shot_samples(spark, sf_dir):
    return augmenting.few_shot_samples(_train(spark, sf_dir)).select("call", "domain", "rank", "row_id")


def synthesis_prompts(spark, sf_dir):
    return augmenting.synthesis_prompts(augmenting.few_shot_samples(_train(spark, sf_dir)))


def reply_items(spark, sf_dir):
    items = augmenting.reply_items(bindings.list_replies(spark, sf_dir))
    return items.select("row_id", "item_no", F.try_variant_get("item", "$.input", "string").alias("input"))


def synthetic_rows(spark, sf_dir):
    return augmenting.synthetic_rows(bindings.list_replies(spark, sf_dir))


QUERIES = {
    "prepared_counts": prepared_counts,
    "prepared_examples": lambda s, d: prepare(bindings.mixed_raw(s, d)),
    "domain_specs": domain_specs,
    "formatted_examples": formatted_examples,
    "user_messages": user_messages,
    "message_lists": message_lists,
    "training_texts": _chat_texts(formatting.training_texts, "text"),
    "generation_prompts": _chat_texts(formatting.generation_prompts, "prompt"),
    "stratified_split": stratified_split,
    "split_order": split_order,
    "split_counts": lambda s, d: splitting.split_counts(stratified_split(s, d)),
    "split_overlap": lambda s, d: splitting.split_overlap(stratified_split(s, d)),
    "collated_batches": collated_batches,
    "few_shot_samples": few_shot_samples,
    "synthesis_prompts": synthesis_prompts,
    "reply_items": reply_items,
    "synthetic_rows": synthetic_rows,
}

_PREPARED = f"""{sql.MIXED_SCRUBBED},
unique_rows AS (
  SELECT * FROM clean
  QUALIFY row_number() OVER (PARTITION BY {sql.content_key()} ORDER BY row_id) = 1),
kept AS (SELECT * FROM unique_rows WHERE {sql.quality_reason()} IS NULL),
{sql.FORMATTED},
{sql.split_steps('formatted')}"""

_FORMATTED = f"{sql.MIXED},\nkept AS (SELECT * FROM mixed),\n{sql.FORMATTED}"
_USER = "instruction || chr(10) || chr(10) || input"
_NL2 = "chr(10) || chr(10)"


def _llama(role: str, content: str) -> str:
    return (
        f"'<|start_header_id|>{role}<|end_header_id|>' || {_NL2} || {sql.strip(content)} || '<|eot_id|>'"
    )


_SHOT_DRAWS = """draws AS (
  SELECT call, domain, n,
    1 + {d0} % n AS a, 1 + {d1} % (n - 1) AS b0, 1 + {d2} % (n - 2) AS c0
  FROM calls JOIN sizes USING (domain_no)),
second AS (SELECT *, b0 + (b0 >= a)::BIGINT AS b FROM draws),
third AS (SELECT *, c0 + (c0 >= least(a, b))::BIGINT AS c1 FROM second),
picks AS (
  SELECT call, domain, unnest([a, b, c1 + (c1 >= greatest(a, b))::BIGINT]) AS rank FROM third)""".format(
    **{f"d{j}": sql.leading_number(f"md5('42:' || call || ':{j}')", 12) for j in range(3)}
)

_SHOTS = f"""{sql.STRATA_SPLIT},
pool AS (
  SELECT row_id, domain, 'Continue.' AS instruction, split_part(text, chr(10), 1) AS input, text AS output,
    row_number() OVER (PARTITION BY domain ORDER BY {sql.shuffle_key(42, 'row_id')}) AS rank
  FROM split_rows WHERE split = 'train'),
sizes AS (
  SELECT domain, count(*) AS n, row_number() OVER (ORDER BY domain) - 1 AS domain_no
  FROM pool GROUP BY domain),
calls AS (
  SELECT range AS call, {sql.leading_number("md5('42:call:' || range)", 12)}
    % (SELECT count(*) FROM sizes) AS domain_no
  FROM range(20)),
{_SHOT_DRAWS},
shots AS (SELECT call, domain, rank, row_id, instruction, input, output FROM picks JOIN pool USING (domain, rank))"""

_REPLY = sql.spoilt(
    "(conv_id * 8 + turn)",
    "'Here you are: [' || item || '] Done.'",
    [
        "'No list at all.'",
        "'[' || item || ', ]'",
        "'[7, \"x\", null, ' || item || ']'",
        "'[{\"instruction\": 1, \"input\": \"a\", \"output\": \"b\"}, ' || item || ']'",
        "'[' || item || '] and [1]'",
    ],
)
REPLIES = f"""{sql.SUPPORT},
replies AS (
  SELECT row_id, 'd' || conv_id % 3 AS domain, regexp_extract({_REPLY}, '(?s)\\[.*\\]') AS body
  FROM (SELECT *, to_json(struct_pack(instruction := 'Reply.', input := instruction, output := response)) AS item
        FROM support)),
items AS (
  SELECT row_id, domain, unnest(range(len(list)))::INT AS item_no, unnest(list) AS item
  FROM (SELECT row_id, domain, json_extract(body::JSON, '$[*]') AS list
        FROM (SELECT * FROM replies WHERE json_valid(body) AND NOT regexp_matches(body, ',\\s*\\]$')))),
synthetic AS (
  SELECT row_id, item_no, domain, item->>'$.instruction' AS instruction, item->>'$.input' AS input,
    item->>'$.output' AS output
  FROM items
  WHERE json_type(item, '$.instruction') = 'VARCHAR' AND json_type(item, '$.input') = 'VARCHAR'
    AND json_type(item, '$.output') = 'VARCHAR')"""

_LENGTHS = f"""lengths AS (
  SELECT doc_id AS row_id,
    list_transform({sql.words('text')}, lambda w: {sql.leading_number('md5(w)', 7)} % 32767 + 1)[:2048] AS ids
  FROM documents),
batched AS (
  SELECT *, (row_number() OVER (ORDER BY {sql.shuffle_key(42, 'row_id')}) - 1) // 4 AS batch FROM lengths),
padded AS (
  SELECT *, len(ids) AS n, max(len(ids)) OVER (PARTITION BY batch) - len(ids) AS pad FROM batched)"""


def _filled(head: str, filler: int) -> str:
    return f"array_to_string(list_concat({head}, list_transform(range(pad), lambda i: {filler}::BIGINT)), ',')"


_LANG_SPECS = ", ".join(
    f"('{lang}', '{domain}', {sql.lit(sql.INSTRUCTIONS[domain])})"
    for lang, domain in (("en", "legal"), ("fr", "medical"), ("de", "support"))
)

ORACLES = {
    "prepared_counts": f"""WITH {_PREPARED}
SELECT domain, split, count(*) AS n_rows FROM split_rows GROUP BY ALL""",
    "prepared_examples": f"WITH {_PREPARED} SELECT * FROM split_rows",
    "domain_specs": f"""SELECT doc_id AS row_id, domain, instruction
FROM documents JOIN (VALUES {_LANG_SPECS}) AS specs(lang, domain, instruction) USING (lang)""",
    "formatted_examples": f"WITH {_FORMATTED} SELECT * FROM formatted",
    "user_messages": f"""WITH {_FORMATTED}
SELECT row_id, CASE WHEN domain = 'medical' THEN instruction ELSE {_USER} END AS user_message
FROM formatted""",
    "message_lists": f"""WITH {_FORMATTED}
SELECT row_id,
  to_json([{{role: 'user', content: {_USER}}}, {{role: 'assistant', content: output}}])::VARCHAR AS with_answer,
  to_json([{{role: 'user', content: {_USER}}}])::VARCHAR AS without_answer
FROM formatted""",
    "training_texts": f"""WITH {_FORMATTED}
SELECT row_id, 'mistral' AS template,
  '[INST] ' || {_USER} || '[/INST] ' || output || '</s>' AS text FROM formatted
UNION ALL
SELECT row_id, 'llama3', {_llama('user', _USER)} || {_llama('assistant', 'output')} FROM formatted""",
    "generation_prompts": f"""WITH {_FORMATTED}
SELECT row_id, 'mistral' AS template, '<s>[INST] ' || {_USER} || '[/INST]' AS prompt FROM formatted
UNION ALL
SELECT row_id, 'llama3', '<|begin_of_text|>' || {_llama('user', _USER)} ||
  '<|start_header_id|>assistant<|end_header_id|>' || {_NL2} FROM formatted""",
    "stratified_split": f"WITH {sql.STRATA_SPLIT} SELECT row_id, domain, split FROM split_rows",
    "split_order": f"""WITH {sql.STRATA_SPLIT}
SELECT row_id, split, md5('42:' || split || ':' || row_id) AS order_key FROM split_rows""",
    "split_counts": f"""WITH {sql.STRATA_SPLIT}
SELECT domain, split, count(*) AS n_rows FROM split_rows GROUP BY ALL""",
    "split_overlap": f"""WITH {sql.STRATA_SPLIT}
SELECT row_id, count(*) AS times FROM split_rows GROUP BY row_id HAVING count(*) > 1""",
    "collated_batches": f"""WITH {_LENGTHS}
SELECT batch, row_id, {_filled('ids', 0)} AS input_ids,
  {_filled('list_transform(ids, lambda i: 1::BIGINT)', 0)} AS attention_mask, {_filled('ids', -100)} AS labels
FROM padded""",
    "few_shot_samples": f"WITH {_SHOTS} SELECT call, domain, rank, row_id FROM shots",
    "synthesis_prompts": f"""WITH {_SHOTS}
SELECT call, domain, 'These records come from the "' || domain || '" domain:' || {_NL2} ||
  to_json(list(struct_pack(instruction, input, output) ORDER BY rank))::VARCHAR || {_NL2} ||
  'Write 5 further records for the same task, varied and realistic, no copies, no real personal data. '
  || 'Answer with a JSON list of objects holding instruction, input and output, and nothing else.' AS prompt
FROM shots GROUP BY call, domain""",
    "reply_items": f"""WITH {REPLIES}
SELECT row_id, item_no, item->>'$.input' AS input FROM items""",
    "synthetic_rows": f"WITH {REPLIES} SELECT * FROM synthetic",
}

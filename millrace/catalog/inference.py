"""Chat requests and replies."""

from pyspark.sql import functions as F

from millrace.catalog import sql
from millrace.operators import chat_requests
from millrace.operators.formatting import DOMAIN_SPECS
from millrace.sources import bindings


def checked_requests(spark, sf_dir):
    checked = chat_requests.validate_requests(bindings.chat_requests(spark, sf_dir))
    return checked.withColumn("temperature", F.round("temperature", 9))


def request_prompts(spark, sf_dir):
    prompted = chat_requests.with_prompts(checked_requests(spark, sf_dir))
    return prompted.select("row_id", "domain", "prompt", "prompt_error")


def request_payloads(spark, sf_dir):
    sound = chat_requests.with_prompts(checked_requests(spark, sf_dir)).where("valid and prompt is not null")
    payload = chat_requests.request_payload(F.col("prompt"), F.col("max_tokens"), F.col("temperature"))
    return sound.select("row_id", payload.alias("payload"))


def reply_answers(spark, sf_dir):
    answered = chat_requests.with_answers(bindings.chat_replies(spark, sf_dir))
    return answered.select("row_id", "answer", "status")


def usage_rows(spark, sf_dir):
    return chat_requests.usage_rows(chat_requests.with_answers(bindings.chat_replies(spark, sf_dir)))


QUERIES = {
    "checked_requests": checked_requests,
    "request_prompts": request_prompts,
    "request_payloads": request_payloads,
    "reply_answers": reply_answers,
    "usage_rows": usage_rows,
}

_REQUESTS = """requests AS (
  SELECT *, CASE WHEN length(message) < 1 THEN 'message'
    WHEN NOT max_tokens BETWEEN 1 AND 4096 THEN 'max_tokens'
    WHEN NOT temperature BETWEEN 0 AND 2 THEN 'temperature' END AS error
  FROM (SELECT event_id AS row_id,
          CASE event_type WHEN 'view' THEN 'legal' WHEN 'click' THEN 'medical'
            WHEN 'error' THEN 'cooking' ELSE 'support' END AS domain,
          CASE WHEN event_id % 11 = 0 THEN '' ELSE props END AS message,
          (event_id % 5000)::INT AS max_tokens, value / 10 AS temperature
        FROM events))"""

_PROMPTS = f"""{_REQUESTS},
specs(domain, instruction) AS (
  VALUES {', '.join(f'({sql.lit(spec[0])}, {sql.lit(spec[1])})' for spec in DOMAIN_SPECS)}),
prompts AS (
  SELECT requests.*, instruction || chr(10) || chr(10) || message AS prompt,
    CASE WHEN instruction IS NULL
      THEN 'unknown domain ' || domain || '; known: legal, medical, support' END AS prompt_error
  FROM requests LEFT JOIN specs USING (domain))"""

_ANSWERS = f"""{sql.SUPPORT},
replies AS (
  SELECT row_id, conv_id, turn, instruction, response, {sql.spoilt(
    "(conv_id * 8 + turn)",
    "'{\"choices\": [{\"message\": ' || to_json(struct_pack(content := ' ' || response || ' ' || chr(10))) || '}]}'",
    [
        "'{\"choices\": [{\"message\": {\"content\": null}}]}'",
        "'{\"choices\": []}'",
        "'{\"choices\": [{\"message\": {\"content\": 5}}]}'",
        "'Bad gateway'",
    ],
)} AS reply FROM support),
bodies AS (SELECT *, CASE WHEN json_valid(reply) THEN reply::JSON END AS body FROM replies),
answers AS (
  SELECT *, CASE json_type(body, '$.choices[0].message.content')
    WHEN 'NULL' THEN '' WHEN 'VARCHAR' THEN {sql.strip("(body->>'$.choices[0].message.content')")} END AS answer
  FROM bodies)"""

ORACLES = {
    "checked_requests": f"""WITH {_REQUESTS}
SELECT row_id, domain, message, max_tokens, round(temperature, 9) AS temperature, error,
  error IS NULL AS valid FROM requests""",
    "request_prompts": f"WITH {_PROMPTS} SELECT row_id, domain, prompt, prompt_error FROM prompts",
    "request_payloads": f"""WITH {_PROMPTS}
SELECT row_id, to_json(struct_pack(model := 'domain-llm',
    messages := [struct_pack(role := 'user', content := prompt)],
    max_tokens := max_tokens, temperature := round(temperature, 9)))::VARCHAR AS payload
FROM prompts WHERE error IS NULL AND prompt IS NOT NULL""",
    "reply_answers": f"""WITH {_ANSWERS}
SELECT row_id, answer, CASE WHEN answer IS NULL THEN 'error' ELSE 'ok' END AS status FROM answers""",
    "usage_rows": f"""WITH {_ANSWERS}
SELECT started + length(response) / 16 AS "timestamp", 'support' AS domain, instruction AS query,
  answer AS response, trunc((started + length(response) / 16 - started) * 1000)::INT AS latency_ms,
  NULL::VARCHAR AS feedback
FROM (SELECT *, (1704067200 + conv_id * 600 + turn * 30)::DOUBLE AS started FROM answers)
WHERE answer IS NOT NULL""",
}

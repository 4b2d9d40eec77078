"""Metrics, reports, judge, perplexity, votes."""

from pyspark.sql import functions as F

from millrace.catalog import sql
from millrace.catalog.stem_sql import stem_steps
from millrace.functions.text import words
from millrace.operators import evaluating, perplexity, splitting, voting
from millrace.operators.ranking import first_rows
from millrace.sources import bindings

def word_tokens(spark, sf_dir):
    return bindings.document_texts(spark, sf_dir).select(
        "row_id", F.array_join(words(F.col("text")), " ").alias("words")
    )


def _per_side(metric, name, stem=True):
    """One metric of both model outputs, rounded."""

    def query(spark, sf_dir):
        outputs = {f"{s}_": f"{s}_output" for s in evaluating.SIDES}
        scored = evaluating.with_metrics(bindings.results(spark, sf_dir), outputs, stem=stem)
        return scored.select(
            "row_id", *[F.round(f"{s}_{metric}", 9).alias(f"{s}_{name}") for s in evaluating.SIDES]
        )

    return query


def mean_scores(spark, sf_dir):
    means = evaluating.mean_scores(bindings.results(spark, sf_dir), "finetuned_output")
    return means.select(*[F.round(m, 9).alias(m) for m in evaluating.METRICS])


def paired_predictions(spark, sf_dir):
    rows = bindings.results(spark, sf_dir)
    pairs = evaluating.pair_predictions(
        rows.select("row_id", "domain", "reference"),
        rows.select("row_id", F.col("base_output").alias("output")),
        rows.select("row_id", F.col("finetuned_output").alias("output")),
    )
    return pairs


def first_results(spark, sf_dir):
    return first_rows(bindings.results(spark, sf_dir), 200).select("row_id", "domain", "reference")


def report_by_domain(spark, sf_dir):
    compared = evaluating.compare_by_domain(bindings.results(spark, sf_dir))
    numbers = [F.round(c, 9).alias(c) for c in ("base", "finetuned", "delta")]
    return compared.select("domain", "is_total", "n", "metric", *numbers)


def report_lines(spark, sf_dir):
    compared = evaluating.compare_by_domain(bindings.results(spark, sf_dir))
    judged = evaluating.judge_row(bindings.judge_replies(spark, sf_dir))
    return evaluating.report_lines(compared, judged)


def judge_prompts(spark, sf_dir):
    return evaluating.judge_prompts(bindings.results(spark, sf_dir), "finetuned_output")


def _verdicts(spark, sf_dir):
    replies = bindings.judge_replies(spark, sf_dir)
    sides = [
        replies.select("row_id", F.lit(s).alias("side"), F.col(f"{s}_reply").alias("reply")) for s in evaluating.SIDES
    ]
    return evaluating.judge_verdicts(sides[0].unionByName(sides[1]))


def judge_verdicts(spark, sf_dir):
    return _verdicts(spark, sf_dir).select("row_id", "side", "score", "reason")


def mean_judge_score(spark, sf_dir):
    verdicts = _verdicts(spark, sf_dir)
    means = [
        evaluating.mean_judge_score(verdicts.where(F.col("side") == s)).select(
            F.lit(s).alias("side"), F.round("mean_score", 9).alias("mean_score")
        )
        for s in evaluating.SIDES
    ]
    return means[0].unionByName(means[1])


def report_judge_row(spark, sf_dir):
    row = evaluating.judge_row(bindings.judge_replies(spark, sf_dir))
    numbers = [F.round(c, 9).alias(c) for c in ("base", "finetuned", "delta")]
    return row.select("domain", "metric", *numbers)


def loss_perplexity(spark, sf_dir):
    return perplexity.perplexity_pair(bindings.losses(spark, sf_dir))


def bigram_perplexity(spark, sf_dir):
    """Base: all training text. Tuned: the French part. Scored on all test text, whole texts."""
    split = splitting.stratified_split(bindings.language_strata(spark, sf_dir))
    trained = F.col("split") == "train"
    texts = split.select(
        "text",
        trained.alias("in_base"),
        (trained & (F.col("domain") == "fr")).alias("in_finetuned"),
        (F.col("split") == "test").alias("held_out"),
    )
    return perplexity.perplexity_pair(perplexity.bigram_losses(texts, max_length=None))


def blind_sides(spark, sf_dir):
    return voting.assign_sides(bindings.results(spark, sf_dir))


def vote_winners(spark, sf_dir):
    return voting.resolve_votes(bindings.votes(spark, sf_dir), blind_sides(spark, sf_dir))


def vote_tally(spark, sf_dir):
    counted = voting.tally(vote_winners(spark, sf_dir))
    return counted.withColumn("share", F.round("share", 9))


QUERIES = {
    "word_tokens": word_tokens,
    "exact_match": _per_side("exact_match", "exact_match"),
    "token_f1": _per_side("token_f1", "token_f1"),
    "rouge_l_plain": _per_side("rougeL", "rouge_l", stem=False),
    "rouge_l_stemmed": _per_side("rougeL", "rouge_l"),
    "mean_scores": mean_scores,
    "paired_predictions": paired_predictions,
    "first_results": first_results,
    "report_by_domain": report_by_domain,
    "report_lines": report_lines,
    "judge_prompts": judge_prompts,
    "judge_verdicts": judge_verdicts,
    "mean_judge_score": mean_judge_score,
    "report_judge_row": report_judge_row,
    "loss_perplexity": loss_perplexity,
    "bigram_perplexity": bigram_perplexity,
    "blind_sides": blind_sides,
    "vote_winners": vote_winners,
    "vote_tally": vote_tally,
}

# The two outputs in long form, with the word lists.
_LONG = f"""{sql.RESULTS},
long AS (
  SELECT row_id, domain, side, reference, pred, {sql.words('pred')} AS p, {sql.words('reference')} AS r
  FROM (SELECT row_id, domain, reference, 'base' AS side, base_output AS pred FROM results
        UNION ALL SELECT row_id, domain, reference, 'finetuned', finetuned_output FROM results))"""

_F1 = """word_uses AS (
  SELECT row_id, side, word, count(*) FILTER (is_pred) AS in_p, count(*) FILTER (NOT is_pred) AS in_r
  FROM (SELECT row_id, side, true AS is_pred, unnest(p) AS word FROM long
        UNION ALL SELECT row_id, side, false, unnest(r) FROM long)
  GROUP BY ALL),
f1 AS (
  SELECT row_id, side, coalesce(2 * (o / len(p)) * (o / len(r)) / (o / len(p) + o / len(r)), 0.0) AS f1
  FROM (SELECT row_id, side, p, r, nullif(coalesce(sum(least(in_p, in_r)), 0), 0)::DOUBLE AS o
        FROM long LEFT JOIN word_uses USING (row_id, side) GROUP BY row_id, side, p, r))"""


def _lcs(tokens: str) -> str:
    """Longest common subsequence as the longest increasing run over matching positions.

    ``tokens`` is a relation (row_id, side, is_pred, i, word).
    """
    return f"""matches AS (
  SELECT a.row_id, a.side, list(b.i ORDER BY a.i, b.i DESC) AS places
  FROM {tokens} a JOIN {tokens} b
    ON a.row_id = b.row_id AND a.side = b.side AND a.word = b.word AND a.is_pred AND NOT b.is_pred
  GROUP BY ALL),
lcs AS (
  SELECT row_id, side, len(list_reduce(
    list_prepend([]::BIGINT[], list_transform(places, lambda x: [x])),
    lambda tails, x: list_concat(list_filter(tails, lambda t: t < x[1]), x,
                                 (list_filter(tails, lambda t: t >= x[1]))[2:]))) AS o
  FROM matches),
rouge AS (
  SELECT row_id, side,
    coalesce(2 * (o / n_p) * (o / n_r) / (o / n_p + o / n_r), 0.0) AS rouge
  FROM (SELECT row_id, side, count(*) FILTER (is_pred) AS n_p, count(*) FILTER (NOT is_pred) AS n_r
        FROM {tokens} GROUP BY ALL)
  LEFT JOIN lcs USING (row_id, side))"""


_ASCII = f"""ascii_words AS (
  SELECT row_id, side, is_pred, unnest(w) AS word, generate_subscripts(w, 1) AS i
  FROM (SELECT row_id, side, true AS is_pred, {sql.ascii_tokens('pred')} AS w FROM long
        UNION ALL SELECT row_id, side, false, {sql.ascii_tokens('reference')} FROM long))"""


_STEMMED = f"""{_LONG},
{_ASCII},
{stem_steps('ascii_words')},
stemmed_words AS (
  SELECT row_id, side, is_pred, i, coalesce(stem, word) AS word FROM ascii_words LEFT JOIN stems USING (word)),
{_lcs('stemmed_words')}"""

_SCORES = f"""{_STEMMED},
{_F1},
scores AS (
  SELECT row_id, domain, side, rouge, f1, (p = r)::INT::DOUBLE AS em
  FROM long JOIN rouge USING (row_id, side) JOIN f1 USING (row_id, side)),
means AS (
  SELECT coalesce(nullif(domain, ''), 'unknown') AS domain, false AS is_total, row_id, side, rouge, f1, em FROM scores
  UNION ALL SELECT 'ALL', true, row_id, side, rouge, f1, em FROM scores),
compared AS (
  SELECT domain, is_total, metric_no, metric, count(*) AS n, min(row_id) AS first_row,
    avg(base) AS base, avg(finetuned) AS finetuned
  FROM (
    SELECT domain, is_total, row_id, unnest([0, 1, 2]) AS metric_no,
      unnest(['rougeL', 'token_f1', 'exact_match']) AS metric,
      unnest([max(rouge) FILTER (side = 'base'), max(f1) FILTER (side = 'base'), max(em) FILTER (side = 'base')]) AS base,
      unnest([max(rouge) FILTER (side = 'finetuned'), max(f1) FILTER (side = 'finetuned'),
              max(em) FILTER (side = 'finetuned')]) AS finetuned
    FROM means GROUP BY domain, is_total, row_id)
  GROUP BY domain, is_total, metric_no, metric)"""


def _two_columns(relation: str, value: str, name: str) -> str:
    return f"""SELECT row_id, round(max({value}) FILTER (side = 'base'), 9) AS base_{name},
  round(max({value}) FILTER (side = 'finetuned'), 9) AS finetuned_{name} FROM {relation} GROUP BY row_id"""


_JUDGE_BAD = [
    "'No verdict.'",
    "'{\"score\": \"4\", \"reason\": \"text score\"}'",
    "'{\"score\": null, \"reason\": \"no score\"}'",
    "'{\"score\": true, \"reason\": \"flag\"}'",
    "'{\"score\": 3.5, \"reason\": \"half\"} {'",
    "'{\"score\": 3.5, \"reason\": \"half\"} }'",
    "'{\"score\": 3.5, \"reason\": \"half\"}'",
]


def _judge_reply(row: str, score: str) -> str:
    sound = (
        f"'Verdict: {{\"score\": ' || ({score}) || ', \"reason\": ' || "
        "to_json(struct_pack(r := instruction)) || '} end.'"
    )
    return sql.spoilt(row, sound, _JUDGE_BAD)


_VERDICTS = f"""{sql.SUPPORT},
judge_replies AS (
  SELECT row_id, 'base' AS side, {_judge_reply('(conv_id * 8 + turn)', '(conv_id * 8 + turn) % 5 + 1')} AS reply
  FROM support
  UNION ALL
  SELECT row_id, 'finetuned',
    {_judge_reply('(conv_id * 8 + turn + 1)', '(conv_id * 8 + turn + 2) % 5 + 1')} FROM support),
bodies AS (SELECT row_id, side, regexp_extract(reply, '(?s)\\{{.*\\}}') AS body FROM judge_replies),
checked AS (SELECT row_id, side, CASE WHEN body <> '' AND json_valid(body) THEN body::JSON END AS body FROM bodies),
verdicts AS (
  SELECT row_id, side,
    CASE WHEN json_type(body, '$.score') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN (body->>'$.score')::DOUBLE
         WHEN json_type(body, '$.score') = 'BOOLEAN' THEN (body->>'$.score')::BOOLEAN::INT::DOUBLE END AS score,
    CASE WHEN body IS NULL THEN 'parse_error'
         WHEN json_type(body, '$.reason') = 'VARCHAR' THEN body->>'$.reason' END AS reason
  FROM checked)"""

REPORT_LINES = """SELECT false AS part, -1 AS first_row, 0 AS line_no, '# Fine-tuned vs Base Model' || chr(10) AS line
UNION ALL
SELECT is_total, CASE WHEN NOT is_total THEN first_row END, unnest([0, 1, 2, 3]), unnest(['', printf('## %s (n=%d)', domain, n), '',
  '| Metric | Base | Fine-tuned | Delta |' || chr(10) || '|---|---|---|---|'])
FROM compared WHERE metric_no = 0
UNION ALL
SELECT is_total, CASE WHEN NOT is_total THEN first_row END, metric_no + 4,
  printf('| %s | %.3f | %.3f | %+.3f |', metric, base, finetuned, finetuned - base) FROM compared"""

_JUDGE_MEANS = """judged AS (
  SELECT round(avg(score) FILTER (side = 'base'), 9) AS base,
    round(avg(score) FILTER (side = 'finetuned'), 9) AS finetuned,
    round(avg(score) FILTER (side = 'finetuned') - avg(score) FILTER (side = 'base'), 9) AS delta
  FROM verdicts WHERE row_id IN (SELECT row_id FROM support ORDER BY row_id LIMIT 50))"""

_COIN = "substring(md5('0:' || row_id), 1, 1) < '8'"
_WINNERS = f"""{sql.SUPPORT},
winners AS (
  SELECT row_id, CASE WHEN pick = 2 THEN 'tie' WHEN (pick = 0) = ({_COIN}) THEN 'finetuned' ELSE 'base' END AS winner
  FROM (SELECT row_id, (conv_id + turn) % 4 AS pick FROM support) WHERE pick < 3)"""

_BIGRAMS = f"""{sql.STRATA_SPLIT},
lists AS (
  SELECT domain, split, list_concat(['<s>'], w) AS v, w
  FROM (SELECT domain, split, {sql.words('text')} AS w FROM split_rows)),
steps AS (SELECT domain, split, unnest(v[:len(w)]) AS v, unnest(w) AS w FROM lists),
counted AS (
  SELECT v, w, count(*) FILTER (split = 'train') AS b,
    count(*) FILTER (split = 'train' AND domain = 'fr') AS f, count(*) FILTER (split = 'test') AS h
  FROM steps GROUP BY v, w),
contexts AS (SELECT v, sum(b) AS vb, sum(f) AS vf FROM counted GROUP BY v),
vocab AS (SELECT count(DISTINCT w) AS size FROM counted WHERE b > 0),
scored AS (
  SELECT h, -ln((b + 0.5::DOUBLE) / (vb + 0.5::DOUBLE * size)) AS lb,
    -ln((f + 0.5::DOUBLE) / (vf + 0.5::DOUBLE * size)) AS lf
  FROM counted JOIN contexts USING (v), vocab WHERE h > 0)"""

ORACLES = {
    "word_tokens": f"""SELECT doc_id AS row_id, array_to_string({sql.words('text')}, ' ') AS words
FROM documents""",
    "exact_match": f"WITH {_LONG} {_two_columns('long', '(p = r)::INT::DOUBLE', 'exact_match')}",
    "token_f1": f"WITH {_LONG},\n{_F1} {_two_columns('f1', 'f1', 'token_f1')}",
    "rouge_l_plain": f"WITH {_LONG},\n{_ASCII},\n{_lcs('ascii_words')} {_two_columns('rouge', 'rouge', 'rouge_l')}",
    "rouge_l_stemmed": f"WITH {_STEMMED} {_two_columns('rouge', 'rouge', 'rouge_l')}",
    "mean_scores": f"""WITH {_SCORES}
SELECT round(avg(rouge), 9) AS "rougeL", round(avg(f1), 9) AS token_f1, round(avg(em), 9) AS exact_match
FROM scores WHERE side = 'finetuned'""",
    "report_by_domain": f"""WITH {_SCORES}
SELECT domain, is_total, n, metric, round(base, 9) AS base, round(finetuned, 9) AS finetuned,
  round(finetuned - base, 9) AS delta FROM compared""",
    "report_lines": f"""WITH {_SCORES},
{_VERDICTS.removeprefix(sql.SUPPORT + ",")},
{_JUDGE_MEANS}
{REPORT_LINES}
UNION ALL
SELECT true, NULL, 7, printf('| {evaluating.JUDGE_LABEL} | %.2f | %.2f | %+.2f |', base, finetuned, delta) FROM judged""",
    "report_sink": f"""WITH {_SCORES}
SELECT unnest(string_split(line, chr(10))) AS line FROM ({REPORT_LINES})""",
    "paired_predictions": f"""WITH {sql.RESULTS}
SELECT row_id, domain, reference, base_output, finetuned_output FROM results""",
    "first_results": f"""WITH {sql.RESULTS}
SELECT row_id, domain, reference FROM results ORDER BY row_id LIMIT 200""",
    "judge_prompts": f"""WITH {sql.RESULTS}
SELECT row_id, 'Grade the response from 1 (unusable) to 5 (excellent) for agreement with the '
  || 'reference, completeness, terms of the field and tone.' || chr(10) || chr(10) || 'Task:' || chr(10)
  || prompt_text || chr(10) || chr(10) || 'Reference:' || chr(10) || reference
  || chr(10) || chr(10) || 'Response:' || chr(10) || finetuned_output
  || chr(10) || chr(10) || 'Answer only with JSON: {{"score": 1 to 5, "reason": "one sentence"}}' AS prompt
FROM results""",
    "judge_verdicts": f"WITH {_VERDICTS} SELECT row_id, side, score, reason FROM verdicts",
    "mean_judge_score": f"""WITH {_VERDICTS}
SELECT side, round(avg(score), 9) AS mean_score FROM verdicts GROUP BY side""",
    "report_judge_row": f"""WITH {_VERDICTS},
{_JUDGE_MEANS}
SELECT 'ALL' AS domain, '{evaluating.JUDGE_LABEL}' AS metric, base, finetuned, delta FROM judged""",
    "loss_perplexity": f"""WITH {sql.SUPPORT},
losses AS (
  SELECT len(string_split(response, ' ')) - 1 AS n, 2 + (conv_id % 7) / 7 AS lb, 1 + (turn % 5) / 5 AS lf
  FROM support)
SELECT round(exp(sum(lb * n) / greatest(sum(n), 1)), 3) AS base_perplexity,
  round(exp(sum(lf * n) / greatest(sum(n), 1)), 3) AS finetuned_perplexity
FROM losses WHERE n >= 1""",
    "bigram_perplexity": f"""WITH {_BIGRAMS}
SELECT round(exp(sum(lb * h) / sum(h)), 3) AS base_perplexity,
  round(exp(sum(lf * h) / sum(h)), 3) AS finetuned_perplexity FROM scored""",
    "blind_sides": f"""WITH {sql.RESULTS}
SELECT row_id, prompt_text, {_COIN} AS finetuned_first,
  CASE WHEN {_COIN} THEN finetuned_output ELSE base_output END AS response_a,
  CASE WHEN {_COIN} THEN base_output ELSE finetuned_output END AS response_b FROM results""",
    "vote_winners": f"WITH {_WINNERS} SELECT row_id, winner FROM winners",
    "vote_tally": f"""WITH {_WINNERS}
SELECT winner, count(*) AS votes, round(count(*) / (SELECT count(*) FROM winners), 9) AS share
FROM winners GROUP BY winner""",
}

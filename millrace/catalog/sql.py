"""DuckDB fragments shared by the oracles: text classes, masking, the input shapes.

RE2 has no lookaround and ASCII ``\\b`` and ``\\s``. Masking therefore wraps every non-ASCII
letter or number in MARK, ASCII letters that no test text contains, so that ``\\b`` sees a word
character on both sides of it; MARK goes away at the end.
"""

from string import ascii_lowercase, ascii_uppercase

from millrace.operators.formatting import DOMAIN_SPECS

# Character classes and the masking patterns, in RE2's terms.
WORD = r"\pL\pN_"
SPACE = r"\s\x0b\x1c-\x1f\x85\pZ"
MARK = "QZQ"

EMAIL = rf"\b[{WORD}.+-]+@[{WORD}-]+\.[{WORD}.-]+\b"
SSN = r"\b\d{3}-\d{2}-\d{4}\b"
CARD = r"\b\d(?:[ -]?\d){12,15}\b"
PHONE = (
    rf"(^|[^{WORD}])(?:\+?\d{{1,3}}[{SPACE}.-]?)?(?:\(\d{{3}}\)|\d{{3}})"
    rf"[{SPACE}.-]?\d{{3}}[{SPACE}.-]?\d{{4}}\b"
)
IP = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(text: str, pattern: str, to: str) -> str:
    return f"regexp_replace({text}, {lit(pattern)}, {lit(to)}, 'g')"


def words(text: str) -> str:
    return f"regexp_extract_all(lower({text}), {lit(f'[{WORD}]+')})"


def ascii_tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[a-z0-9]+')"


def strip(text: str) -> str:
    return sub(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def blank(text: str) -> str:
    return f"NOT regexp_matches({text}, {lit(f'[^{SPACE}]')})"


def marked(text: str) -> str:
    return sub(text, r"([^\P{L}\x00-\x7F]|[^\P{N}\x00-\x7F])", rf"{MARK}\1{MARK}")


def unmarked(text: str) -> str:
    return f"replace({text}, '{MARK}', '')"


def luhn(number: str) -> str:
    digits = f"reverse({sub(number, '[^0-9]', '')})"
    digit = f"substring({digits}, i + 1, 1)::INT"
    doubled = f"CASE WHEN {digit} > 4 THEN {digit} * 2 - 9 ELSE {digit} * 2 END"
    worth = f"CASE WHEN i % 2 = 1 THEN {doubled} ELSE {digit} END"
    return f"(list_sum(list_transform(range(length({digits})), lambda i: {worth})) % 10 = 0)"


def card_masked(text: str) -> str:
    """Same idea as the Spark side: gaps and matches put back alternately."""
    card = lit(CARD)
    hits = (
        f"list_transform(regexp_extract_all({text}, {card}), "
        f"lambda h: CASE WHEN {luhn('h')} THEN '[CREDIT_CARD]' ELSE h END)"
    )
    gaps = f"string_split_regex({text}, {card})"
    return (
        f"CASE WHEN regexp_matches({text}, {card}) THEN array_to_string(list_transform("
        f"range(1, len({gaps}) + 1), lambda n: {gaps}[n] || coalesce(({hits})[n], '')), '') "
        f"ELSE {text} END"
    )


MASKS = {
    "EMAIL": lambda t: sub(t, EMAIL, "[EMAIL]"),
    "SSN": lambda t: sub(t, SSN, "[SSN]"),
    "CREDIT_CARD": card_masked,
    "PHONE": lambda t: sub(t, PHONE, r"\1[PHONE]"),
    "IP_ADDRESS": lambda t: sub(t, IP, "[IP_ADDRESS]"),
}


def scrub_steps(source: str, keys: str) -> str:
    """CTEs from ``source (keys, t)`` to ``scrubbed (keys, t)``."""
    steps = [f"masked_0 AS (SELECT {keys}, {marked('t')} AS t FROM {source})"]
    for i, mask in enumerate(MASKS.values()):
        steps.append(f"masked_{i + 1} AS (SELECT {keys}, {mask('t')} AS t FROM masked_{i})")
    steps.append(f"scrubbed AS (SELECT {keys}, {unmarked('t')} AS t FROM masked_{len(MASKS)})")
    return ",\n".join(steps)


def shuffle_key(seed: int, row_id: str) -> str:
    return f"md5('{seed}:' || {row_id})"


def leading_number(hash_hex: str, digits: int) -> str:
    return f"('0x' || substring({hash_hex}, 1, {digits}))::BIGINT"


# Input shapes ---------------------------------------------------------------------------

SUPPORT = """support AS (
  SELECT (u.conv_id - n.first) * n.step + u.turn - n.low AS row_id, u.conv_id, u.turn,
         u.text AS instruction, a.text AS response
  FROM (SELECT *, lead(turn) OVER w AS next_turn FROM conversations
        WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.next_turn,
  (SELECT min(conv_id) AS first, min(turn) AS low, max(turn) - min(turn) + 1 AS step FROM conversations) n
  WHERE u.role = 'user' AND a.role = 'assistant')"""

LEGAL = """legal AS (
  SELECT doc_id AS row_id, text, split_part(text, chr(10), 1) AS summary
  FROM documents)"""

MEDICAL = """medical AS (
  SELECT item_id AS row_id,
         CASE WHEN strpos(text, '.') > 0 THEN substring(text, 1, strpos(text, '.')) ELSE text END AS question,
         CASE WHEN strpos(text, '.') > 0 THEN substring(text, strpos(text, '.') + 1) ELSE '' END AS answer
  FROM benchmark)"""

MIXED = f"""{LEGAL},
{MEDICAL},
{SUPPORT},
spans AS (
  SELECT (SELECT min(doc_id) FROM documents) AS low_legal, (SELECT min(item_id) FROM benchmark) AS low_medical,
    (SELECT max(doc_id) - min(doc_id) + 1 FROM documents) AS n_legal,
    (SELECT max(item_id) - min(item_id) + 1 FROM benchmark) AS n_medical),
mixed AS (
  SELECT row_id - low_legal AS row_id, 'legal' AS domain, 'billsum' AS source, text, summary,
         NULL::VARCHAR AS question, NULL::VARCHAR AS answer,
         NULL::VARCHAR AS ticket, NULL::VARCHAR AS resolution
  FROM legal, spans
  UNION ALL
  SELECT row_id - low_medical + n_legal, 'medical', 'medical_flashcards', NULL, NULL,
         question, answer, NULL, NULL
  FROM medical, spans
  UNION ALL
  SELECT row_id + n_legal + n_medical, 'support', 'bitext', NULL, NULL, NULL, NULL,
         instruction, response
  FROM support, spans)"""

CONTENT = ("answer", "question", "resolution", "summary", "text", "ticket")

MIXED_CELLS = "cells AS (" + "\nUNION ALL ".join(
    f"SELECT row_id, domain, source, '{c}' AS col, {c} AS t FROM mixed WHERE {c} IS NOT NULL"
    for c in CONTENT
) + ")"

MIXED_SCRUBBED = f"""{MIXED},
{MIXED_CELLS},
{scrub_steps('cells', 'row_id, domain, source, col')},
clean AS (
  SELECT row_id, domain, source, {", ".join(f"max(t) FILTER (WHERE col = '{c}') AS {c}" for c in CONTENT)}
  FROM scrubbed GROUP BY row_id, domain, source)"""


def squeezed(text: str) -> str:
    return f"trim({sub(text, f'[{SPACE}]+', ' ')}, ' ')"


def content_key(columns: tuple[str, ...] = CONTENT) -> str:
    joined = f"concat_ws(' ', {', '.join(columns)})"
    return f"md5({squeezed(f'lower({joined})')})"


def quality_reason(columns: tuple[str, ...] = CONTENT) -> str:
    """Same three tests: empty, length, letters; NULL for a good record."""
    some_blank = " OR ".join(f"coalesce({blank(c)}, false)" for c in columns)
    none = " AND ".join(f"{c} IS NULL" for c in columns)
    total = " + ".join(f"coalesce(length({c}), 0)" for c in columns)
    return (
        f"CASE WHEN ({none}) OR {some_blank} THEN 'empty' "
        f"WHEN NOT ({total} BETWEEN 30 AND 8000) THEN 'length' "
        f"WHEN {letter_ratio(columns)} < 0.5 THEN 'letters' END"
    )


def letter_ratio(columns: tuple[str, ...] = CONTENT) -> str:
    joined = f"concat_ws(' ', {', '.join(columns)})"
    letters = f"length({sub(joined, r'[^\pL]', '')})"
    return f"({letters}::DOUBLE / greatest(length({joined}), 1))"


INSTRUCTIONS = {spec[0]: spec[1] for spec in DOMAIN_SPECS}
_SPECS = ", ".join(f"({lit(domain)}, {lit(text)})" for domain, text in INSTRUCTIONS.items())

FORMATTED = f"""specs(domain, instruction) AS (VALUES {_SPECS}),
formatted AS (
  SELECT row_id, domain, instruction,
         {strip('coalesce(text, question, ticket)')} AS input,
         {strip('coalesce(summary, answer, resolution)')} AS output
  FROM kept JOIN specs USING (domain)
  WHERE regexp_matches(coalesce(text, question, ticket), {lit(f'[^{SPACE}]')})
    AND regexp_matches(coalesce(summary, answer, resolution), {lit(f'[^{SPACE}]')}))"""

SUPPORT_INSTRUCTION = INSTRUCTIONS["support"]

EXAMPLES = f"""{SUPPORT},
examples AS (
  SELECT row_id, 'support' AS domain, {lit(SUPPORT_INSTRUCTION)} AS instruction,
         instruction AS input, response AS output
  FROM support)"""

RESULTS = f"""{SUPPORT},
results AS (
  SELECT row_id, conv_id, turn,
         CASE WHEN conv_id % 7 <> 0 THEN 'd' || conv_id % 3 END AS domain,
         {lit(SUPPORT_INSTRUCTION)} || chr(10) || chr(10) || instruction AS prompt_text,
         response AS reference,
         substring(response, 1, length(response) // 2) AS base_output,
         CASE WHEN conv_id % 10 = 0 THEN translate(response, '{ascii_lowercase}', '{ascii_uppercase}')
              ELSE substring(response, 1, length(response) * 3 // 4) END AS finetuned_output
  FROM support)"""


def split_steps(source: str) -> str:
    """CTEs that rank ``source (row_id, domain, ...)`` in its seeded order and cut it."""
    return f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY domain ORDER BY {shuffle_key(42, 'row_id')}) AS place,
         count(*) OVER (PARTITION BY domain) AS n_domain
  FROM {source}),
split_rows AS (
  SELECT * EXCLUDE (place, n_domain),
         CASE WHEN place <= floor(n_domain * 0.8::DOUBLE) THEN 'train'
              WHEN place <= floor(n_domain * 0.8::DOUBLE) + floor(n_domain * 0.1::DOUBLE) THEN 'val'
              ELSE 'test' END AS split
  FROM ranked)"""


STRATA = "strata AS (SELECT doc_id AS row_id, lang AS domain, text FROM documents)"
STRATA_SPLIT = f"{STRATA},\n{split_steps('strata')}"


def spoilt(row: str, sound: str, bad: list[str]) -> str:
    cases = " ".join(f"WHEN {row} % 5 = 0 AND ({row} // 5) % {len(bad)} = {i} THEN {b}" for i, b in enumerate(bad))
    return f"CASE {cases} ELSE {sound} END"

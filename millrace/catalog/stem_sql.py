"""Porter's suffix stripping as DuckDB SQL: one CTE per step over the distinct words.

``s`` is the word so far and ``h`` its shape, c for a consonant and v for a vowel.
"""

from millrace.functions.stem import IRREGULAR, STEP_2, STEP_3, STEP_4

_SHAPE = (
    "list_reduce(list_prepend('', string_split(s, '')), lambda acc, ch: acc || CASE "
    "WHEN ch IN ('a', 'e', 'i', 'o', 'u') OR (ch = 'y' AND right(acc, 1) = 'c') THEN 'v' ELSE 'c' END)"
)


def _measure(shape: str) -> str:
    return f"((length({shape}) - length(replace({shape}, 'vc', ''))) // 2)"


def _cut(what: str, chars: int) -> str:
    return f"left({what}, length({what}) - {chars})"


def _cvc(word: str, shape: str) -> str:
    return f"(({shape} LIKE '%cvc' AND right({word}, 1) NOT IN ('w', 'x', 'y')) OR {shape} = 'vc')"


def _rules(rules: dict[str, str], least: int, extra: str = "") -> str:
    cases = " ".join(
        f"WHEN s LIKE '%{old}' THEN CASE WHEN {_measure(_cut('h', len(old)))} > {least} "
        f"THEN {_cut('s', len(old))} || '{new}' ELSE s END"
        for old, new in sorted(rules.items(), key=lambda r: -len(r[0]))
    )
    return f"CASE {extra} {cases} ELSE s END"


def _mended(chars: int) -> str:
    word, shape = _cut("s", chars), _cut("h", chars)
    last = f"right({word}, 1)"
    return (
        f"CASE WHEN regexp_matches({word}, '(at|bl|iz)$') THEN {word} || 'e' "
        f"WHEN length({word}) > 1 AND {last} = left(right({word}, 2), 1) AND right({shape}, 1) = 'c' "
        f"THEN CASE WHEN {last} IN ('l', 's', 'z') THEN {word} ELSE {_cut('s', chars + 1)} END "
        f"WHEN {_measure(shape)} = 1 AND {_cvc(word, shape)} THEN {word} || 'e' ELSE {word} END"
    )


_ION = (
    f"WHEN s LIKE '%ion' THEN CASE WHEN {_measure(_cut('h', 3))} > 1 "
    f"AND left(right(s, 4), 1) IN ('s', 't') THEN {_cut('s', 3)} ELSE s END"
)
_ALLI = (
    f"WHEN s LIKE '%alli' THEN CASE WHEN {_measure(_cut('h', 4))} > 0 THEN {_cut('s', 2)} ELSE s END "
    f"WHEN s LIKE '%logi' THEN CASE WHEN {_measure(_cut('h', 3))} > 0 THEN {_cut('s', 1)} ELSE s END"
)

_STEPS = (
    f"""CASE WHEN s LIKE '%ies' AND length(s) = 4 THEN {_cut('s', 1)}
  WHEN s LIKE '%sses' OR s LIKE '%ies' THEN {_cut('s', 2)}
  WHEN s LIKE '%s' AND s NOT LIKE '%ss' THEN {_cut('s', 1)} ELSE s END""",
    f"""CASE WHEN s LIKE '%ied' THEN CASE WHEN length(s) = 4 THEN {_cut('s', 1)} ELSE {_cut('s', 2)} END
  WHEN s LIKE '%eed' THEN CASE WHEN {_measure(_cut('h', 3))} > 0 THEN {_cut('s', 1)} ELSE s END
  WHEN s LIKE '%ed' AND contains({_cut('h', 2)}, 'v') THEN {_mended(2)}
  WHEN s LIKE '%ing' AND contains({_cut('h', 3)}, 'v') THEN {_mended(3)} ELSE s END""",
    f"""CASE WHEN s LIKE '%y' AND length(s) > 2 AND left(right(h, 2), 1) = 'c'
  THEN {_cut('s', 1)} || 'i' ELSE s END""",
    _rules(STEP_2, 0, _ALLI),
    _rules(STEP_3, 0),
    _rules({s: "" for s in STEP_4 if s != "ion"}, 1, _ION),
    f"""CASE WHEN s LIKE '%e' AND ({_measure(_cut('h', 1))} > 1
    OR ({_measure(_cut('h', 1))} = 1 AND NOT {_cvc(_cut('s', 1), _cut('h', 1))}))
  THEN {_cut('s', 1)} ELSE s END""",
    f"CASE WHEN s LIKE '%ll' AND {_measure(_cut('h', 1))} > 1 THEN {_cut('s', 1)} ELSE s END",
)


def stem_steps(tokens: str) -> str:
    """CTEs from ``tokens (word, ...)`` to ``stems (word, stem)``."""
    ctes = [
        f"stem_0 AS (SELECT word, word AS s, {_SHAPE.replace('(s,', '(word,')} AS h "
        f"FROM (SELECT DISTINCT word FROM {tokens} WHERE length(word) > 3))"
    ]
    for i, step in enumerate(_STEPS):
        ctes.append(
            f"stem_{i + 1} AS (SELECT word, s, {_SHAPE} AS h FROM (SELECT word, {step} AS s FROM stem_{i}))"
        )
    fixed = " ".join(f"WHEN '{w}' THEN '{s}'" for w, s in IRREGULAR.items())
    ctes.append(
        f"stems AS (SELECT word, CASE word {fixed} ELSE s END AS stem FROM stem_{len(_STEPS)})"
    )
    return ",\n".join(ctes)

"""Secret scans: parts of credentials, linked within a scope.

Strong findings stand for themselves: assignments of long values to telling names, access
identifiers and long hexadecimal strings. Weak ones (a user name, an endpoint, a bare token of mixed
characters) are common in clean text. They are intervals of their own kind, and an interval
join within a scope links them: a weak one is reported only if a part of another role shares its
paragraph or, where it stays single there, its section, so that identifier, secret and endpoint
complete each other; at least one of the two linked parts must be a secret. Distance is no condition;
of several partners in the scope the nearest one is the link. Every pattern and the join take a time in
proportion to the text, but for a logarithm.
"""

import bisect
import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import columns_of, rows_batch

# Patterns and least lengths of the strong kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
STRONG = ("assign", "access", "hex")

USER = re.compile(r"""\b(?:user|username|login|client_?id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}""", re.I | re.A)
# A host with a port begins where its run of characters begins, and runs are not given back.
ENDPOINT = re.compile(
    r"\b[a-z]{2,10}://[A-Za-z0-9.-]++|(?<![A-Za-z0-9_.-])[a-z0-9-]++(?:\.[a-z0-9-]++)++:[0-9]{2,5}\b", re.A
)
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_-])")
PARAGRAPH = re.compile(r"\n[ \t]*\n")
SECTION = re.compile(r"\n(?:[ \t]*+\n){2,}+|\n(?=#|\[[^\]\n]{1,80}\][ \t]*\n|-{3}|={3})")
ROLE = {"assign": "secret", "hex": "secret", "token": "secret", "access": "identifier", "user": "identifier", "endpoint": "endpoint"}
WEAK = ("user", "endpoint", "token")
ORDER = {k: i for i, k in enumerate((*STRONG, *WEAK))}

Span = tuple[int, int, str]


def strong_spans(text: str) -> list[Span]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def _mixed(token: str) -> bool:
    """Digits, small and capital letters all occur, as they do in keys and seldom in words."""
    return any(c.isdigit() for c in token) and token.lower() != token and token.upper() != token


def weak_spans(text: str, strong: list[Span]) -> list[Span]:
    """Candidates that lie outside the strong spans."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), "user") for m in USER.finditer(text)]
        found += [(m.start(), m.end(), "endpoint") for m in ENDPOINT.finditer(text)]
    found += [(m.start(), m.end(), "token") for m in TOKEN.finditer(text) if _mixed(m[0])]
    starts, reach = _sweep(strong)

    def covered(start: int, end: int) -> bool:
        before = bisect.bisect_left(starts, end)
        return before > 0 and reach[before - 1][0] > start

    return [w for w in found if not covered(w[0], w[1])]


def _sweep(spans: list[Span]) -> tuple[list[int], list[tuple[int, Span]]]:
    """Starts in order, and for each the end that reaches farthest so far, with its span."""
    starts, reach, far = [], [], (-1, None)
    for span in sorted(spans, key=lambda s: s[:2]):
        far = max(far, (span[1], span), key=lambda f: f[0])
        starts.append(span[0])
        reach.append(far)
    return starts, reach


def scope_ends(text: str) -> tuple[list[int], list[int]]:
    """Where paragraphs and where sections begin; a section's beginning ends a paragraph too."""
    sections = [m.end() for m in SECTION.finditer(text)]
    return sorted({*sections, *(m.end() for m in PARAGRAPH.finditer(text))}), sections


def links(text: str, strong: list[Span], weak: list[Span]) -> list[tuple[Span, Span, int]]:
    """``(weak span, nearest partner, characters between)`` for the weak spans that a partner confirms."""
    out, single = [], list(weak)
    for cuts in scope_ends(text) if weak else ():
        if not single:
            break
        parts = {}
        for span in strong + weak:
            parts.setdefault((bisect.bisect_right(cuts, span[0]), ROLE[span[2]]), []).append(span)
        swept = {k: (sorted(v, key=lambda s: s[:2]), *_sweep(v)) for k, v in parts.items()}
        left = []
        for span in single:
            scope = bisect.bisect_right(cuts, span[0])
            wanted = ("identifier", "endpoint") if ROLE[span[2]] == "secret" else ("secret",)
            near = []
            for role in wanted:
                if (scope, role) not in swept:
                    continue
                ordered, starts, reach = swept[scope, role]
                at = bisect.bisect_left(starts, span[0])
                near += [(max(ordered[at][0] - span[1], 0), ordered[at])] if at < len(ordered) else []
                near += [(max(span[0] - reach[at - 1][0], 0), reach[at - 1][1])] if at else []
            if near:
                distance, partner = min(near, key=lambda n: (n[0], n[1]))
                out.append((span, partner, distance))
            else:
                left.append(span)
        single = left
    return out


def linked(text: str, strong: list[Span], weak: list[Span]) -> list[Span]:
    """The weak spans that a partner confirms."""
    return [w for w, _, _ in links(text, strong, weak)]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], ORDER[x[2]], x[1])))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked)``, one row per input row.

    Offsets count code points, ends exclusive. A null text is empty and has no spans. Kinds are found
    independently, so spans of different kinds may overlap; equal starts are in the order assign,
    access, hex, then the weak kinds. Repeated rows give repeated results, whatever the id.
    """

    result = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long"

    def found(doc_id, text):
        strong = strong_spans(text)
        more = linked(text, strong, weak_spans(text, strong))
        counts = [sum(s[2] == k for s in strong) for k in STRONG]
        digest = hashlib.sha256(joined(strong).encode()).hexdigest()
        return (doc_id, *counts, digest, joined(strong + more), len(more))

    def run(batches):
        for b in batches:
            yield rows_batch([found(i, t or "") for i, t in zip(*columns_of(b), strict=True)], result)

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, result)


def redacted(text: str, spans: str, mark: str = "[SECRET]") -> str:
    """The text with every reported span, overlaps merged, replaced by the mark."""
    out, at = [], 0
    for start, end in sorted((int(s), int(e)) for _, s, e in (x.split(":") for x in spans.split(",") if x)):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join(out) + text[at:]

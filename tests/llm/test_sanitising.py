import bisect
import hashlib
import math
import re
import time
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from millrace.llm import sanitising
from millrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def base(text):
    # Without an @ there is no address; the pattern would take the square of the length to find that out.
    kinds = [(k, *v) for k, v in BASE.items() if k != "email" or "@" in text]
    return [(k, m.start(), m.end(), m[0]) for k, p, ok in kinds for m in re.finditer(p, text) if ok(m[0])]


def brute(docs, window=10, prior=1.0, min_share=0.5, min_bits=4.0):
    """Rows (id, n_.., digest, spans, n_terms, n_found) for (id, text), document by document."""
    found = [base(t or "") for _, t in docs]
    words = [[(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"\w+", t or "")] for _, t in docs]
    n_term = Counter(t for every in words for t in {w for *_, w in every})
    free = []
    for every, f, (_, text) in zip(words, found, docs, strict=True):
        covered = bytearray(len(text or ""))
        for _, s, e, _ in f:
            covered[s:e] = b"\1" * (e - s)
        free.append([w for w in every if not any(covered[w[0] : w[1]])])
    near, n_entity = set(), Counter()
    for i, spans in enumerate(found):
        n_entity.update({m.lower() for *_, m in spans})
        starts = [w[0] for w in free[i]]
        for _, s, _, m in spans:
            at = bisect.bisect_left(starts, s)
            near |= {(i, m.lower(), t) for *_, t in free[i][max(at - window, 0) : at + window]}
    both = Counter((e, t) for _, e, t in near)
    telling = defaultdict(set)
    for (e, t), n in both.items():
        base_rate = n_entity[e] / len(docs)
        share = (n + prior * base_rate) / (n_term[t] + prior)
        if share >= min_share and math.log2(share / base_rate) >= min_bits:
            telling[e].add(t)
    out = []
    for i, (doc_id, _) in enumerate(docs):
        terms = set().union(*[telling[m.lower()] for *_, m in found[i]])
        extra = [f"term:{s}:{e}" for s, e, t in free[i] if t in terms]
        written = [f"{k}:{s}:{e}" for k, s, e, _ in found[i]]
        counts = [sum(f[0] == k for f in found[i]) for k in BASE]
        digest = hashlib.sha256(",".join(written).encode()).hexdigest()
        out.append((doc_id, *counts, digest, ",".join(written + extra), len(extra), len(written) + len(extra)))
    return out


def test_query(spark, sf_docs):
    rows = sorted(tuple(r) for r in QUERIES["op10_sanitising"](spark, SF).collect())
    assert rows == sorted(brute([(i, r["text"]) for i, r in sf_docs.items()]))


CASES = [
    "", None, "é a.b@c.de, x@y and x@y.z.w_q@r.s a@b.com@c.org", "@a.b a@.b a@b. -%+@a-.b", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.4 9.9.9",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 1", "card 4111 1111 1111 11112345", "+49 (30) 123-4567 +1 2 +12345678901234567 +1  . 2345678+44 20 7946 0958",
    "💡 +49 30 1234567 and a@b.co 💡 10.0.0.1", "1 2 3 4 5 " * 400, "a@b.cc " * 3000, "a" * 60_000, "7" * 60_000, "a@b" + ".c" * 20_000, "+1" * 5000, "1.1." * 20_000,
]


def test_odd_rows(make_docs):
    docs = [*enumerate(CASES), (None, CASES[2]), (2, CASES[2])]
    got = sanitising.find(make_docs(*docs)).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted((tuple(r) for r in got), key=key) == sorted(brute(docs), key=key)
    assert sanitising.find(make_docs(*docs).limit(0)).collect() == []


def terms_of(rows, docs):
    texts = dict(docs)
    return {
        r["doc_id"]: {texts[r["doc_id"]][int(x.split(":")[1]) : int(x.split(":")[2])] for x in r["spans"].split(",") if x.startswith("term:")}
        for r in rows
    }


def test_terms_that_give_entities_away(make_docs, words):
    docs = [(i, words(30, i)) for i in range(200)]
    docs += [(300 + i, f"{words(20, 900 + i)} jane@x.org lives in Quimbleton near the Harbour {words(5, i)}") for i in range(4)]
    docs += [(400 + i, f"{words(20, 800 + i)} harbour") for i in range(5)]
    docs += [(500, f"{words(30, 700)} bo@y.org of flat 7b {words(30, 701)} account 99120 {words(20, 702)} Faraway")]
    got = sanitising.find(make_docs(*docs))
    rows = got.collect()
    assert sorted(tuple(r) for r in rows) == sorted(brute(docs))
    found = terms_of(rows, docs)
    for doc_id, terms in found.items():
        assert ("Quimbleton" in terms) == (300 <= doc_id < 304) and not terms & {"harbour", "Harbour", "Faraway", "99120"}
    assert {"flat", "7b"} <= found[500]
    # more than one sighting asked for: one document is not enough, four of four are
    strict = terms_of(sanitising.find(make_docs(*docs), min_share=0.6).collect(), docs)
    assert not strict[500] and {"Quimbleton"} <= strict[301] <= {"Quimbleton", "lives", "in", "near", "the"}


def test_one_sighting_weighs_less_than_five(make_docs, words):
    docs = [(i, words(30, i)) for i in range(300)]
    docs += [(1000 + i, f"ann@x.org knows Five {'Once' if i == 0 else ''}") for i in range(5)]
    for share, wanted in ((0.3, {"Once", "Five", "knows"}), (0.6, {"Five", "knows"}), (0.9, set())):
        rows = sanitising.find(make_docs(*docs), min_share=share)
        assert terms_of(rows.collect(), docs)[1000] == wanted, share


def test_sanitised_texts(make_docs, words):
    docs = [(i, words(30, i)) for i in range(100)]
    docs += [(200, "Ünal è Zork 4711 zilch a@b.cc then +49 30 1234567; 10.0.0.1, 4111 1111 1111 1111"), (201, None), (202, ""), (None, "x@y.zz")]
    docs += [(203, "é" * 3000 + " Far " + "w " * 2000 + "q@r.ss" + " é" * 1500), (204, "+4111 1111 1111 1111 a")]
    got = {r["doc_id"]: r["text"] for r in sanitising.sanitise(make_docs(*docs)).collect()}
    assert len(got) == len(docs) and [got[i] for i in range(100)] == [t for _, t in docs[:100]]
    assert got[200] == "[NAME] [WORD] [NAME] [NUMBER] [WORD] [EMAIL] [WORD] [PHONE]; [IP], [CARD]"
    assert got[201] == got[202] == "" and got[None] == "[EMAIL]"
    assert got[203].count("[EMAIL]") == 1 and "q@r" not in got[203] and got[203].startswith("é" * 3000 + " Far ")
    assert "4111" not in got[204]
    find = {r["doc_id"]: r["spans"] for r in sanitising.find(make_docs(*docs)).collect()}
    for doc_id, text in docs:
        want, at = [], 0
        cuts = sorted((int(a), int(b)) for _, a, b in (x.split(":") for x in find[doc_id].split(",") if x))
        for a, b in cuts:
            if a >= at:
                want += [(text[at:a]), "*"]
            at = max(at, b)
        assert re.sub(r"\[[A-Z]+\]", "*", got[doc_id]) == "".join(want) + (text or "")[at:]


def test_precision_on_planted_links(make_docs):
    """Names that always stand by a mail address are told from words that do so by chance."""
    import random

    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=60))) for i in range(600)]
    for person in range(20):
        for copy in range(4):
            text = rng.choices(vocabulary, k=60)
            text.insert(rng.randrange(8, 50), f"Surname{person} p{person}@mail.org")
            docs.append((1000 + person * 10 + copy, " ".join(text)))
    rows = sanitising.find(make_docs(*docs)).collect()
    reported = [(doc_id, t) for doc_id, terms in terms_of(rows, docs).items() for t in terms]
    right = [(d, t) for d, t in reported if t == f"Surname{(d - 1000) // 10}"]
    assert len(right) == 80 and len(right) / len(reported) >= 0.95


def test_long_text_in_linear_time(make_docs):
    """Three megabytes of addresses and words that no other document has."""
    n = 75_000
    text = " ".join(f"name{i} user{i}@mail{i}.org about{i} item" for i in range(n))
    docs = [(i, "plain words") for i in range(50)] + [(100, text)]
    start = time.perf_counter()
    (row,) = sanitising.find(make_docs(*docs)).where("doc_id = 100").collect()
    assert row["n_email"] == n and row["n_terms"] == 3 * n and len(text) > 3_000_000
    assert time.perf_counter() - start < 60

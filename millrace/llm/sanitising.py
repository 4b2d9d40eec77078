"""PII: information-theoretic sanitisation, in DataFrame functions only.

Patterns find the protected entities: mail addresses, IP addresses, card and phone numbers. Masking
them is not enough where other words give them away. Corpus co-occurrence tells which: a term and an
entity co-occur in a document where the term stands within ``WINDOW`` free words of the entity. From the
numbers of documents with the term, with the entity and with both nearby comes

    p(e | t) = (n_both + PRIOR * p(e)) / (n_term + PRIOR),    p(e) = n_entity / n_documents

shrunk towards p(e) as if ``PRIOR`` further documents had the term: one sighting of one gives 0.5, five of
five 0.83, one of two 0.33. A term discloses an entity if p(e | t) reaches ``MIN_SHARE`` and the information
log2(p(e | t) / p(e)) reaches ``MIN_BITS``. At the default of 0.5 a word that no other document has counts
beside an entity that is named once; any higher threshold asks for more than one sighting. All places of
such a term are reported in the documents that name the entity.

Every step is linear in the text: words are rows, not lists that are searched; each entity meets at
most ``2 * WINDOW`` of them. ``sanitise`` puts a general class in place of each span.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stage
from millrace.session import broadcast_if_small

WINDOW = 10
PRIOR = 1.0
MIN_SHARE = 0.5
MIN_BITS = 4.0
TERM = r"[\p{L}\p{M}\p{N}_]++"
BLOCK = 128

# Patterns of the base kinds. They are written so that a text is scanned in linear time:
# a match may begin only where a run of its first characters begins or the last match ended, and
# runs are not given back.
KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
FOUR_OCTETS = rf"^{OCTET}(?:\.{OCTET}){{3}}$"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(FOUR_OCTETS)
    if kind == "card":
        n = F.length(_digits(match))
        return n.between(16, 19) & F.call_function("luhn_check", _digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def spans(text: Column, pattern: str, matches: Column) -> Column:
    """Array of (start, end, match) in code points. Gaps and matches alternate in a text, so places are
    sums of their lengths: of all blocks before, summed up once, and of the steps inside the own block.
    """
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.length(g) + F.length(m))

    # Values that are used often are held in arrays of one element, so that they are computed once.
    def held(column: Column, more) -> Column:
        return F.transform(column, more)

    def blocks(f: Column) -> Column:
        count = F.floor(F.size(f["s"]) / BLOCK).cast("int")
        sums = F.transform(F.sequence(F.lit(0), count), lambda b: _sum(F.slice(f["s"], b * BLOCK + 1, BLOCK)))
        return F.struct(f["s"].alias("s"), sums.alias("b"))

    def reaches(f: Column) -> Column:
        before = F.transform(f["b"], lambda _, i: _sum(F.slice(f["b"], F.lit(1), i)))
        return F.struct(f["s"].alias("s"), before.alias("p"))

    def located(f: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            end = F.get(f["p"], block) + _sum(F.slice(f["s"], block * BLOCK + 1, i + 1 - block * BLOCK))
            return F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("match"))

        return F.transform(matches, one)

    summed = held(held(F.array(F.struct(steps.alias("s"))), blocks), reaches)
    return F.when(F.size(matches) > 0, F.flatten(held(summed, located)))


EMPTY = "array<struct<start:int,end:int,match:string>>"


def found(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(uid, doc_id, email, ip, card, phone, text)``: spans of each kind, an array each."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    patterns = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True))
    needs = {"email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+"))}
    none = F.array().cast("array<string>")
    matched = rows.select(
        "*", *[F.when(needs.get(k, F.lit(True)), _all(F.col("text"), p)).otherwise(none).alias(f"m_{k}") for k, p in patterns.items()]
    )
    empty = F.array().cast(EMPTY)

    def valid_spans(kind: str, pattern: str) -> Column:
        every = F.coalesce(spans(F.col("text"), pattern, F.col(f"m_{kind}")).cast(EMPTY), empty)
        return F.filter(every, lambda x: _valid(kind, x["match"])).alias(kind)

    return matched.select("uid", "doc_id", "text", *[valid_spans(k, p) for k, p in patterns.items()])


def _written(kind: str, column: Column) -> Column:
    return F.transform(column, lambda x: F.concat(F.lit(f"{kind}:"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string")))


def _terms(text: Column) -> Column:
    return F.array_distinct(_all(F.lower(text), TERM))


def _words(rows: DataFrame) -> DataFrame:
    """``(uid, start, end, term)``: every word of the texts, its places summed up along the text."""
    matches = _all(F.col("text"), TERM)
    pairs = F.arrays_zip(F.slice(F.split("text", TERM, -1), 1, F.size(matches)).alias("gap"), matches.alias("match"))
    each = rows.select("uid", F.posexplode(pairs).alias("pos", "pair")).select("uid", "pos", "pair.gap", "pair.match")
    along = Window.partitionBy("uid").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.length("gap") + F.length("match")).over(along).cast("int")
    return each.select("uid", (end - F.length("match")).alias("start"), end.alias("end"), F.lower("match").alias("term"))


def _base_spans(rows: DataFrame) -> DataFrame:
    """``(uid, start, end, entity)``: every base span as a row."""
    every = F.explode(F.concat(*KINDS)).alias("s")
    return rows.select("uid", every).select("uid", "s.start", "s.end", F.lower("s.match").alias("entity"))


def _free_words(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Words outside base spans with their number in the text, ``(uid, nth, start, end, term)``, and entities
    with the number of free words before them, ``(uid, nth, entity)``.

    Words and spans pass in order of their start. A word is covered if a span that began before, or
    where it begins, reaches into it, or if the next one to come is a span that begins inside it.
    """
    events = _words(rows).withColumn("entity", F.lit(None).cast("string")).unionByName(
        _base_spans(rows).withColumn("term", F.lit(None).cast("string"))
    )
    along = Window.partitionBy("uid").orderBy("start", F.col("term").isNotNull(), "end", "entity")
    sofar = along.rowsBetween(Window.unboundedPreceding, 0)
    reach = F.coalesce(F.max(F.when(F.col("entity").isNotNull(), F.col("end"))).over(sofar), F.lit(0))
    entered = F.coalesce(F.lead("entity").over(along).isNotNull() & (F.lead("start").over(along) < F.col("end")), F.lit(False))
    marked = events.withColumn("free", F.col("term").isNotNull() & (reach <= F.col("start")) & ~entered)
    counted = stage(marked.withColumn("nth", F.sum(F.col("free").cast("int")).over(sofar)), "pii-words")
    free = counted.where("free").select("uid", (F.col("nth") - 1).alias("nth"), "start", "end", "term")
    return free, counted.where("entity is not null").select("uid", "nth", "entity")


def _telling(free: DataFrame, entities: DataFrame, docs: DataFrame, text_col: str, min_share: float, min_bits: float) -> DataFrame:
    """``(uid, term)``: for documents with entities, the terms that give one of them away."""
    around = F.explode(F.sequence(F.col("nth") - WINDOW, F.col("nth") + (WINDOW - 1))).alias("nth")
    near = entities.select("uid", "entity", around).distinct().join(free.select("uid", "nth", "term"), ["uid", "nth"])
    pairs = stage(near.select("uid", "entity", "term").distinct(), "pii-pairs")
    named = entities.select("uid", "entity").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    words = docs.select(F.explode(_terms(F.col(text_col))).alias("term"))
    wanted = broadcast_if_small(pairs.select("term").distinct())
    counts = words.groupBy("term").agg(F.count("*").alias("n_term")).join(wanted, "term")
    both = pairs.groupBy("entity", "term").agg(F.count("*").alias("n_both")).join(counts, "term").join(named, "entity")
    base = F.col("n_entity") / F.lit(float(max(docs.count(), 1)))
    share = (F.col("n_both") + PRIOR * base) / (F.col("n_term") + PRIOR)
    telling = both.where((share >= min_share) & (F.log2(share / base) >= min_bits)).select("entity", "term")
    return entities.select("uid", "entity").distinct().join(telling, "entity").select("uid", "term").distinct()


def located(
    df: DataFrame, id_col: str, text_col: str, min_share: float, min_bits: float, all_texts: bool = False
) -> DataFrame:
    """``(uid, doc_id, email, ip, card, phone, text, term)``: spans of every kind, an array of each.

    ``text`` is there only where there are spans, or with ``all_texts``; ``term`` holds (start, end) in order.
    """
    base = found(df, id_col, text_col)
    some = F.size(F.concat(*KINDS)) > 0
    kept = F.col("text") if all_texts else F.when(some, F.col("text"))
    rows = stage(base.select("uid", "doc_id", *KINDS, kept.alias("text")), "pii-base")
    free, entities = _free_words(rows.where(some))
    telling = _telling(free, entities, df, text_col, min_share, min_bits)
    hits = free.join(telling, ["uid", "term"]).groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("term"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return rows.join(hits, "uid", "left").withColumn("term", F.coalesce("term", none))


def find(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_share: float = MIN_SHARE, min_bits: float = MIN_BITS,
) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms, n_found)``, one row per input row.

    Offsets count code points, ends exclusive; spans are in the order of the kinds, then of the
    start, terms last. A null text is empty and has no spans; its digest is that of ''. Repeated
    rows count as documents of their own. Terms are runs of letters, marks, digits and underscores. Terms inside a base span are not reported again.
    """
    rows = located(df, id_col, text_col, min_share, min_bits)
    written = F.concat(*[_written(k, F.col(k)) for k in KINDS])
    every = F.concat(written, _written("term", F.col("term")))
    return rows.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(written, ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(every, ",").alias("spans"),
        F.size("term").cast("long").alias("n_terms"),
        F.size(every).cast("long").alias("n_found"),
    )


def _class(word: Column) -> Column:
    """The general class of a term: a number, a name (an initial capital), or a word."""
    return F.when(word.rlike(r"^\p{N}+$"), "NUMBER").when(word.rlike(r"^\p{Lu}"), "NAME").otherwise("WORD")


def sanitise(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_share: float = MIN_SHARE, min_bits: float = MIN_BITS
) -> DataFrame:
    """``(doc_id, text)`` with the class of each span in its place: ``[EMAIL]``, ``[IP]``, ``[CARD]``, ``[PHONE]``, and
    ``[NUMBER]``, ``[NAME]`` or ``[WORD]`` for a term.

    Spans that overlap are one, under the class of the first. A null text becomes empty.
    """
    rows = located(df, id_col, text_col, min_share, min_bits, all_texts=True)

    def numbered(kind: int) -> Column:
        return F.transform(
            (*KINDS, "term")[kind],
            lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(kind).alias("kind")),
        )

    kinds = [numbered(i) for i in range(len(KINDS) + 1)]
    spans_of = rows.select("uid", F.explode(F.concat(*kinds)).alias("s")).select("uid", "s.*")
    along = Window.partitionBy("uid").orderBy("start", "end", "kind")
    reach = F.coalesce(F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heads = spans_of.withColumn("new", (F.col("start") >= reach).cast("int"))
    runs = heads.withColumn("run", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0))).groupBy("uid", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", "end", "kind")).alias("kind")
    )
    cuts = runs.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("cuts"))
    done = rows.select("uid", "doc_id", "text").join(cuts, "uid", "left")
    return done.select("doc_id", F.when(F.col("cuts").isNull(), F.col("text")).otherwise(_replaced(F.col("text"), F.col("cuts"))).alias("text"))


PAGE = 1024


def _replaced(text: Column, cuts: Column) -> Column:
    """The text with disjoint cuts, in order, replaced by their class. It is read page by page, as finding a place
    in a long string costs its length.
    """

    def between(pages: Column, start: Column, end: Column) -> Column:
        first, last = (F.floor(x / PAGE).cast("int") for x in (start, end))
        head = F.substring(F.get(pages, first), start % PAGE + 1, F.when(first == last, end - start).otherwise(PAGE))
        middle = F.array_join(F.slice(pages, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        tail = F.when(last > first, F.coalesce(F.substring(F.get(pages, last), F.lit(1), end % PAGE), F.lit("")))
        return F.concat(F.coalesce(head, F.lit("")), middle, F.coalesce(tail, F.lit("")))

    labels = F.array(*[F.lit(k.upper()) for k in KINDS])

    def build(f: Column) -> Column:
        pages, n = f["pages"], F.length(text)

        def piece(cut: Column, i: Column) -> Column:
            since = F.when(i == 0, F.lit(0)).otherwise(F.get(f["cuts"], i - 1)["end"])
            label = F.coalesce(F.get(labels, cut["kind"]), _class(between(pages, cut["start"], cut["end"])))
            return F.concat(between(pages, since, cut["start"]), F.lit("["), label, F.lit("]"))

        last = F.element_at(f["cuts"], -1)["end"]
        return F.concat(F.array_join(F.transform(f["cuts"], piece), ""), between(pages, last, n))

    pages = _all(text, f"(?s).{{1,{PAGE}}}")
    return F.element_at(F.transform(F.array(F.struct(pages.alias("pages"), cuts.alias("cuts"))), build), 1)

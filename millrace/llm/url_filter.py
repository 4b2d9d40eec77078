"""URL filters: a cascade of Bloom filters with exact answers, in DataFrame functions only.

Level 1 encodes the listed keys. Of all other keys of the corpus, those that pass by mistake
are encoded in level 2; the listed keys that pass level 2 by mistake are encoded in level 3; and so on
until a level makes no mistake. For every key of the corpus the number of levels it passes
is then odd if and only if it is listed, so rows are judged in place, without a join.

The filters are bit sets in arrays of 64-bit words. They grow with the list, not with the
rows, and each is checked against ``MAX_WORDS`` before it is used as a constant of the query. A
list beyond that is answered by an ordinary left join on the key.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stage

BITS_PER_KEY, HASHES = 10, 7
MAX_WORDS = 2_000_000  # 16 MB a level
MAX_LEVELS = 40

# Rules of the query as (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for a url without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    empty = F.lit("")
    return F.coalesce(F.translate(host, CAPITALS, SMALL), empty), F.coalesce(path, empty)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as host and path, its verdict) of the longest rule that fits, null if none does.

    Of equal lengths the first in the list wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        inside = (host == rule_host) | host.endswith("." + rule_host)
        fits = inside & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _positions(key: Column, level: int, words: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level * 64 + j)), F.lit(words * 64)) for j in range(HASHES)]


def _words(n_keys: int) -> int:
    return n_keys * BITS_PER_KEY // 64 + 1


def bit_set(keys: DataFrame, level: int, words: int) -> DataFrame:
    """One row with the filter: an array of ``words`` longs. Bits meet as partial sums per word."""
    spots = keys.select(F.explode(F.array(*_positions(F.col("key"), level, words))).alias("p"))
    set_words = spots.groupBy(F.floor(F.col("p") / 64).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))).alias("bits")
    )
    dense = keys.sparkSession.range(words).withColumnRenamed("id", "w").join(set_words, "w", "left")
    pairs = F.sort_array(F.collect_list(F.struct("w", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return dense.agg(F.transform(pairs, lambda x: x["bits"]).alias("filter"))


def passes(key: Column, level: int, words: int, filter_row: DataFrame) -> Column:
    filter_words = filter_row.scalar()
    tests = [
        F.getbit(F.element_at(filter_words, (F.floor(p / 64) + 1).cast("int")), (p % 64).cast("int")) == 1
        for p in _positions(key, level, words)
    ]
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def cascade(universe: DataFrame) -> list[tuple[int, DataFrame]] | None:
    """(words, staged filter) of each level for ``(key, listed)`` with distinct keys.

    None if a level would be too large. An empty list has no levels.
    """
    keys = stage(universe, "url-keys")
    inside, outside = keys.where("listed").select("key"), keys.where("not listed").select("key")
    levels = []
    while len(levels) < MAX_LEVELS and (n := inside.count()):
        words = _words(n)
        if words > MAX_WORDS:
            return None
        level = len(levels) + 1
        levels.append((words, stage(bit_set(inside, level, words), "url-level")))
        wrong = outside.where(passes(F.col("key"), level, *levels[-1]))
        inside, outside = stage(wrong, "url-wrong"), inside
    return levels if len(levels) < MAX_LEVELS else None


def listed(rows: DataFrame, universe: DataFrame, key: str) -> DataFrame:
    """The rows with a column ``__listed``; every key of the rows must be in the universe."""
    levels = cascade(universe)
    if levels is None:
        flags = universe.where("listed").select(F.col("key").alias("__key")).distinct().withColumn("__in", F.lit(True))
        joined = rows.join(flags, rows[key] == F.col("__key"), "left").drop("__key")
        return joined.withColumn("__listed", F.coalesce("__in", F.lit(False))).drop("__in")
    answer = F.lit(len(levels) % 2 == 1)
    for level in range(len(levels), 0, -1):
        # the first level that a key fails decides; it is listed if that level is even
        answer = F.when(~passes(F.col(key), level, *levels[level - 1]), F.lit(level % 2 == 0)).otherwise(answer)
    return rows.withColumn("__listed", answer)


def tracked(url: Column) -> Column:
    """Whether the query part names a campaign parameter."""
    return F.coalesce(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1).rlike(r"(^|&)utm_[a-z]+="), F.lit(False))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, is_listed=tracked) -> DataFrame:
    """``(page_id, host, path, rule, verdict)``, one row per input row.

    Where no rule fits, the cascade judges the key host and path: the list holds the keys that
    ``is_listed`` marks on at least one row (by default: keys that were linked to with
    campaign parameters), and listed keys are blocked. Null urls and those without ``://``
    have an empty host and path and are judged like any other key.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"))
    rows = rows.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("key", F.concat("host", "path"))
    universe = rows.groupBy("key").agg(F.bool_or(is_listed(F.col("url"))).alias("listed"))
    found = listed(rows, universe, "key")
    return found.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("__listed"), "block").otherwise("allow")).alias("verdict"),
    )

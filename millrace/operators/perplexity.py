"""Perplexity, from a loss table or from bigram models counted over the training text."""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import words
from millrace.session import stage

# Marks the start of a text, as a tokenizer's first token does. Words never contain "<".
START = "<s>"

FLAGS = ("in_base", "in_finetuned", "held_out")
# A text's kind is a number with one bit per flag.
KINDS = 1 << len(FLAGS)
COUNTS = "key string, in_base long, in_finetuned long, held_out long, seen long"

# A task splits so many texts and counts so many words at a time, fewer if their bytes reach the
# third bound, and hands the counts over in batches of so many rows.
SPLIT_ROWS = 128
CHUNK_WORDS = 2_000_000
CHUNK_BYTES = 64_000_000
BATCH_ROWS = 50_000


def perplexity(loss: Column, n: Column) -> Column:
    """Aggregate: exp of the token-weighted mean loss; texts with n < 1 do not count."""
    counted = n >= 1
    weighted = F.sum(F.when(counted, loss * n).otherwise(0.0))
    tokens = F.sum(F.when(counted, n).otherwise(0))
    return F.exp(
        F.coalesce(weighted, F.lit(0.0)) / F.greatest(F.coalesce(tokens, F.lit(0)), F.lit(1))
    )


def perplexity_pair(losses: DataFrame) -> DataFrame:
    """Base and tuned perplexity of one loss table (n, base_loss, finetuned_loss)."""
    return losses.agg(
        F.round(perplexity(F.col("base_loss"), F.col("n")), 3).alias("base_perplexity"),
        F.round(perplexity(F.col("finetuned_loss"), F.col("n")), 3).alias("finetuned_perplexity"),
    )


def _counts(texts: list[pa.ListArray], kinds: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Counts of the bigrams, of their contexts and of the words of some texts, none of them empty.

    A bigram's key is "previous word", a context's or word's is the word alone. Distinct words get
    numbers, so a bigram and its kind are one integer; equal ones are counted by sorting.
    """
    start = pa.array([START], texts[0].type.value_type)
    coded = pa.concat_arrays([start, *[t.flatten() for t in texts]]).dictionary_encode()
    names, codes = coded.dictionary, coded.indices.to_numpy()
    lengths = np.concatenate([pc.list_value_length(t).to_numpy() for t in texts])
    texts.clear()
    kind, word, previous = np.repeat(np.concatenate(kinds), lengths), codes[1:], codes[:-1].copy()
    previous[np.cumsum(lengths) - lengths] = 0
    # bits[k, i]: whether kind k has flag i.
    bits = np.arange(KINDS)[:, None] >> np.arange(len(FLAGS)) & 1

    def by_name(codes: np.ndarray) -> np.ndarray:
        found = np.bincount(codes.astype(np.int64) * KINDS + kind, minlength=len(names) * KINDS)
        return found.reshape(len(names), KINDS) @ bits

    columns = [names, *by_name(previous).T, by_name(word)[:, 0]]
    yield from pa.table(columns, ["key", *FLAGS, "seen"]).to_batches(BATCH_ROWS)
    keys = previous.astype(np.int64)
    for factor, addend in ((len(names), word), (KINDS, kind)):
        keys *= factor
        keys += addend
    keys.sort()
    runs = np.flatnonzero(np.diff(keys, prepend=-1))
    times, keys = np.diff(runs, append=len(keys)), keys[runs]
    firsts = np.flatnonzero(np.diff(keys // KINDS, prepend=-1))
    counted = [np.add.reduceat(times * bits[keys % KINDS, i], firsts) for i in range(len(FLAGS))]
    pairs = keys[firsts] // KINDS
    for at in range(0, len(pairs), BATCH_ROWS):
        part = slice(at, at + BATCH_ROWS)
        left, right = (names.take(pa.array(side)) for side in np.divmod(pairs[part], len(names)))
        columns = [pc.binary_join_element_wise(left, right, " "), *[c[part] for c in counted]]
        columns.append(np.zeros(len(left), np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", *FLAGS, "seen"])


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of one task's texts, some millions of words at a time."""
    texts, kinds, n_words, n_bytes = [], [], 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, SPLIT_ROWS):
            rows = batch.slice(at, SPLIT_ROWS)
            rows = rows.filter(pc.not_equal(rows.column("words"), ""))
            if not rows.num_rows:
                continue
            texts.append(pc.split_pattern(rows.column("words"), " "))
            kinds.append(rows.column("kind").to_numpy())
            n_words, n_bytes = n_words + len(texts[-1].values), n_bytes + texts[-1].nbytes
            if n_words >= CHUNK_WORDS or n_bytes >= CHUNK_BYTES:
                yield from _counts(texts, kinds)
                texts, kinds, n_words, n_bytes = [], [], 0, 0
    if texts:
        yield from _counts(texts, kinds)


def bigram_losses(
    texts: DataFrame, add_k: float = 0.5, max_length: int | None = 2048
) -> DataFrame:
    """Loss of held-out text under two add-k bigram models, in one pass over the corpus.

    The START mark counts towards ``max_length``, as a tokenizer's first token does.

    ``texts`` has ``text`` and the flags ``in_base``, ``in_finetuned``, ``held_out``; texts without
    any flag count nowhere. Each task counts its equal bigrams, contexts and words before they are
    shuffled, so no common word makes a hot key. The loss splits into a bigram term and a context
    term without join: -log((c(v,w)+k) / (c(v)+kV)) = log(c(v)+kV) - log(c(v,w)+k). Only counts that
    enter a term or the vocabulary are written, once.
    """
    flags = [F.coalesce(F.col(f).cast("boolean"), F.lit(False)).cast("int") for f in FLAGS]
    kind = sum((f * (1 << i) for i, f in enumerate(flags)), F.lit(0))
    tokens = words(F.col("text"))
    if max_length is not None:
        tokens = F.slice(tokens, 1, max_length - 1)
    rows = texts.select(kind.alias("kind"), F.array_join(tokens, " ").alias("words")).where("kind > 0")
    # Dealt by key first: equal keys of one task are added up already, so they are hashed only where they meet.
    dealt = rows.mapInArrow(_counted, COUNTS).repartition("key")
    totals = dealt.groupBy("key").agg(*[F.sum(c).alias(c) for c in (*FLAGS, "seen")])
    counts = stage(
        totals.where("held_out > 0 or seen > 0").select(F.col("key").contains(" ").alias("bigram"), *FLAGS, "seen"),
        "bigrams",
    )
    smoothing = F.lit(add_k) * counts.where("seen > 0").select(F.count(F.lit(1))).scalar()
    sign = F.when(F.col("bigram"), -1.0).otherwise(1.0)
    offset = F.when(F.col("bigram"), F.lit(add_k)).otherwise(smoothing)
    total = counts.where("held_out > 0").agg(
        *[
            F.sum(sign * F.col("held_out") * F.log(F.col(f"in_{m}") + offset)).alias(f"{m}_sum")
            for m in ("base", "finetuned")
        ],
        F.coalesce(F.sum(F.when(F.col("bigram"), F.col("held_out"))), F.lit(0)).alias("n"),
    )
    tokens = F.greatest("n", F.lit(1))
    return total.select(
        "n",
        F.coalesce(F.col("base_sum") / tokens, F.lit(0.0)).alias("base_loss"),
        F.coalesce(F.col("finetuned_sum") / tokens, F.lit(0.0)).alias("finetuned_loss"),
    )

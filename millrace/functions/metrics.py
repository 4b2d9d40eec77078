"""Per-row metrics over word lists: exact match, token F1, ROUGE-L.

Word lists are built once per text, as columns, and shared by the metrics.
"""

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.lcs import lcs_lengths


def exact_match(pred_words: Column, ref_words: Column) -> Column:
    """1.0 where the word lists are equal; two empty lists are equal."""
    return (pred_words == ref_words).cast("double")


def overlap_size(pred: Column, ref: Column) -> Column:
    """Size of the multiset intersection of two token arrays, in one pass over the row.

    Tokens of both sides are sorted together, predictions first within a token. The fold
    keeps the number of still unmatched predictions of the current token.
    """

    def tagged(tokens: Column, side: int) -> Column:
        return F.transform(tokens, lambda t: F.struct(t.alias("token"), F.lit(side).alias("side")))

    def step(acc: Column, item: Column) -> Column:
        same = acc["token"].eqNullSafe(item["token"])
        open_ = F.when(same, acc["open"]).otherwise(0)
        return F.struct(
            item["token"].alias("token"),
            F.when(item["side"] == 0, open_ + 1).otherwise(F.greatest(open_ - 1, F.lit(0))).alias("open"),
            (acc["matched"] + F.when((item["side"] == 1) & (open_ > 0), 1).otherwise(0)).alias("matched"),
        )

    start = F.struct(
        F.lit(None).cast("string").alias("token"), F.lit(0).alias("open"), F.lit(0).alias("matched")
    )
    merged = F.sort_array(F.concat(tagged(pred, 0), tagged(ref, 1)))
    return F.aggregate(merged, start, step, lambda acc: acc["matched"])


def f_measure(overlap: Column, n_pred: Column, n_ref: Column) -> Column:
    """Harmonic mean of overlap/n_pred and overlap/n_ref, 0 where nothing overlaps.

    It equals 2 * overlap / (n_pred + n_ref), which names the overlap only once.
    """
    return 2.0 * overlap / F.greatest(n_pred + n_ref, F.lit(1))


def token_f1(pred_words: Column, ref_words: Column) -> Column:
    return f_measure(overlap_size(pred_words, ref_words), F.size(pred_words), F.size(ref_words))


def ascii_tokens(text: Column) -> Column:
    """ROUGE tokens: lower-cased runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


@F.arrow_udf(T.IntegerType())
def _lcs_plain(left: pa.Array, right: pa.Array) -> pa.Array:
    return lcs_lengths(left, right, stemmed=False)


@F.arrow_udf(T.IntegerType())
def _lcs_stemmed(left: pa.Array, right: pa.Array) -> pa.Array:
    return lcs_lengths(left, right, stemmed=True)


def rouge_l(pred_tokens: Column, ref_tokens: Column, stem: bool = True) -> Column:
    """ROUGE-L F-measure. Tokens and counts are native, only the LCS length is an Arrow UDF."""
    common = (_lcs_stemmed if stem else _lcs_plain)(pred_tokens, ref_tokens)
    return f_measure(common, F.size(pred_tokens), F.size(ref_tokens))

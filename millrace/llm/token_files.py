"""Token files: ids of all documents in one row of numbers, with Elias-Fano document ends.

A file holds shards. A shard has the ids of consecutive documents, two bytes each where the
vocabulary allows it, the document ids, and the ends of its documents as an Elias-Fano
sequence: each end is cut into ``low_bits`` low bits, packed, and a high part, written in
unary into a bit vector with a sampled select structure. n ends up to u take about
``n * (2 + log2(u / n))`` bits. ``select`` finds any end without decoding the others.
"""

import re
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import partitions, rows_batch, scratch_dir, stage

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
SHARD_TOKENS = 1 << 20
CACHE = 1_000_000
SELECT_EVERY = 64
NO_ID = -(1 << 63)

# White space as bytes, controls that some classes count as such included, and the lead bytes of
# characters beyond ASCII among which there is white space.
_BLANK = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
_MAY_BLANK = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
SLICE_BYTES = 8_000_000
_ENCODERS = {}


class EliasFano:
    """A rising sequence of numbers from 0 to ``top``, repeats allowed."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples
        self._high = np.frombuffer(high, dtype=np.uint8)
        self._low = np.frombuffer(low, dtype=np.uint8)
        self._at = np.frombuffer(samples, dtype="<u4")

    @classmethod
    def encode(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, dtype=np.int64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, int(top // max(n, 1)).bit_length() - 1)
        low = ((values[:, None] >> np.arange(low_bits)) & 1).astype(np.uint8)
        at = (values >> low_bits) + np.arange(n)
        bits = np.zeros(int(at[-1]) + 1 if n else 0, dtype=np.uint8)
        bits[at] = 1
        return cls(
            n, low_bits, np.packbits(low.ravel(), bitorder="little").tobytes(),
            np.packbits(bits, bitorder="little").tobytes(), at[::SELECT_EVERY].astype("<u4").tobytes(),
        )

    def select(self, i: int) -> int:
        """The i-th number, from 0: start at the sample before it and pass at most 63 ones."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self._at[i // SELECT_EVERY]), i % SELECT_EVERY
        byte = at // 8
        ones = (int(self._high[byte]) >> (at % 8)) << (at % 8)
        while left >= (count := ones.bit_count()):
            left, byte = left - count, byte + 1
            ones = int(self._high[byte])
        for _ in range(left):
            ones &= ones - 1
        high = byte * 8 + (ones & -ones).bit_length() - 1 - i
        low = 0
        for k in range(self.low_bits):
            bit = i * self.low_bits + k
            low |= ((int(self._low[bit // 8]) >> (bit % 8)) & 1) << k
        return (high << self.low_bits) | low

    def all(self) -> np.ndarray:
        at = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[: self.n]
        low = np.unpackbits(self._low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        shifted = low.astype(np.int64) << np.arange(self.low_bits)
        return ((at - np.arange(self.n)) << self.low_bits) | shifted.sum(axis=1)


def _byte_letters() -> dict[int, str]:
    """The letters in which byte-level vocabularies write bytes: visible ones as they are, the
    others numbered from 256 on.
    """
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Ids of a text, found piece by piece.

    A text is cut in front of each blank or line feed between two characters that are no white
    space: the pre-tokenizer parts them there too, so no id changes. Arrow numbers the pieces
    of many texts; each distinct one is encoded once and then looked up. The table is
    dropped when it holds ``CACHE`` pieces, so its memory is bounded. A piece that is a word of
    Latin letters, with or without marks after it, is known to be one to three units of the
    pre-tokenizer; its units go straight to the tokenizer's model.
    """

    WORD = re.compile(r"(\n?)( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\[-`{-~]*)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.width = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known = {}
        plain = self.tokenizer.normalizer is None and isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel)
        plain = plain and not self.tokenizer.pre_tokenizer.add_prefix_space and isinstance(self.tokenizer.model, models.BPE)
        self.model = self.tokenizer.model if plain else None
        self.letters = _byte_letters()
        self.units = {}

    @staticmethod
    def pieces(texts):
        """Arrow array of the pieces of all texts, and where each text's pieces begin in it.

        ``texts`` is an Arrow array of strings without nulls.
        """
        import pyarrow as pa

        texts = texts.cast(pa.large_string())
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.empty(0, np.uint8)
        at = at - at[0]
        cut = np.flatnonzero((raw == 32) | (raw == 10))
        inside = (cut > 0) & (cut < len(raw) - 1)
        cut = cut[inside]
        before, after = raw[cut - 1], raw[cut + 1]
        wide = _MAY_BLANK[after] | (before >= 128) & (_MAY_BLANK[raw[cut - 2]] | _MAY_BLANK[raw[np.maximum(cut - 3, 0)]])
        cut = cut[~(_BLANK[before] | _BLANK[after] | wide)]
        full = at[:-1][at[1:] > at[:-1]]
        edge = np.zeros(len(raw) + 1, dtype=bool)
        edge[cut] = True
        # Neither the first nor the last character of a text lies between two others.
        edge[at[1:][at[1:] > 0] - 1] = False
        edge[full] = True
        starts = np.flatnonzero(edge[: len(raw)])
        ends = np.append(starts, len(raw)).astype(np.int64)
        array = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw)))
        return array, np.searchsorted(starts, at)

    def _unit(self, unit: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(unit.encode().decode("latin-1").translate(self.letters))]
        return array(self.width.char, ids).tobytes()

    def _marks(self, marks: str) -> bytes:
        """Ids of a line feed or of marks after a word; there are few different ones."""
        if len(self.units) > CACHE:
            self.units = {}
        if marks not in self.units:
            self.units[marks] = self._unit(marks)
        return self.units[marks]

    def _learn(self, new: list[str]) -> None:
        rest = new
        if self.model is not None:
            rest = []
            for piece in new:
                found = self.WORD.fullmatch(piece)
                if not found:
                    rest.append(piece)
                    continue
                feed, word, marks = found.groups()
                ids = self._unit(word)
                if feed:
                    ids = self._marks(feed) + ids
                self.known[piece] = ids + self._marks(marks) if marks else ids
        for start in range(0, len(rest), 10_000):
            some = rest[start : start + 10_000]
            for piece, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                self.known[piece] = array(self.width.char, e.ids).tobytes()

    def encode(self, texts) -> list[bytes]:
        """Ids of each text of an Arrow array or a list, as bytes of ``width``."""
        import pyarrow as pa

        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts
        pieces, first = self.pieces(texts)
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) > CACHE:
            self.known = {}
        self._learn([p for p in distinct if p not in self.known])
        ids = pa.array(map(self.known.__getitem__, distinct), pa.large_binary(), size=len(distinct)).take(coded.indices)
        _, offsets, data = ids.buffers()
        ends = np.frombuffer(offsets, np.int64)[ids.offset : ids.offset + len(ids) + 1][first].tolist() if len(ids) else [0] * len(first)
        whole = memoryview(data) if data else memoryview(b"")
        return [bytes(whole[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def slices(texts, limit: int = SLICE_BYTES):
    """Bounds of consecutive runs of texts of about ``limit`` bytes; a long text is one by itself."""
    import pyarrow.compute as pc

    reach = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // limit
    cuts = [0, *(np.flatnonzero(np.diff(reach)) + 1).tolist(), len(texts)]
    return [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]


def encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


SHARD = (
    "part int, seq int, n_docs long, n_tokens long, width int, low_bits int, "
    "low binary, high binary, samples binary, doc_ids binary, ids binary"
)
DOCUMENT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_files(
    df: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encode all texts, in order of id, then text, and write them as shards.

    Null texts are empty and have the end id only; null ids come first. Repeated rows are
    documents of their own. ``tokenizer`` is the path of a tokenizer file on every executor.
    A document is never cut: a shard is closed once it has ``shard_tokens`` ids.
    """
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = (
        texts.repartitionByRange(partitions(df.sparkSession), "id", F.xxhash64("text"))
        .sortWithinPartitions("id", F.xxhash64("text"), "text")
        .withColumn("part", F.spark_partition_id())
    )

    def run(batches):
        coder = encoder(tokenizer)
        end = np.array([end_id], dtype=coder.width).tobytes()
        seq, ids, docs, lengths, total, part = 0, [], [], [], 0, 0

        def shard():
            ends = EliasFano.encode(np.cumsum(lengths))
            row = (
                part, seq, len(docs), total, coder.width.itemsize, ends.low_bits, ends.low, ends.high,
                ends.samples, np.array(docs, dtype="<i8").tobytes(), b"".join(ids),
            )
            return rows_batch([row], SHARD)

        for b in batches:
            keys, every, parts = b.column(0).to_pylist(), b.column(1), b.column(2)
            part = parts[0].as_py() if len(parts) else part
            for start, stop in slices(every):
                for i, own in enumerate(coder.encode(every.slice(start, stop - start)), start):
                    ids += (own, end)
                    docs.append(NO_ID if keys[i] is None else keys[i])
                    lengths.append(len(own) // coder.width.itemsize + 1)
                    total += lengths[-1]
                    if total >= shard_tokens:
                        yield shard()
                        seq, ids, docs, lengths, total = seq + 1, [], [], [], 0
        if docs:
            yield shard()

    ordered.mapInArrow(run, SHARD).write.option("compression", "zstd").parquet(path)


def read_files(spark, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the shards alone.

    Only the sizes of the shards are summed up across tasks: within a part, then over parts.
    """
    shards = spark.read.schema(SHARD).parquet(path)
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    parts = (
        shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(over), zero).alias("before"))
    )
    starts = stage(
        shards.select("part", "seq", "n_tokens").join(parts, "part").select(
            "part", "seq",
            (F.col("before") + F.coalesce(F.sum("n_tokens").over(within), zero)).alias("base"),
        ),
        "shard-starts",
    )

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                ends = EliasFano(r["n_docs"], r["low_bits"], r["low"], r["high"], r["samples"]).all()
                begins = np.concatenate(([0], ends[:-1]))
                ids = np.frombuffer(r["ids"], dtype=f"<u{r['width']}").astype("<u4")
                docs = np.frombuffer(r["doc_ids"], dtype="<i8").tolist()
                rows = [
                    (None if d == NO_ID else d, r["base"] + s, e - s, zlib.crc32(ids[s:e]))
                    for d, s, e in zip(docs, begins.tolist(), ends.tolist(), strict=True)
                ]
                yield rows_batch(rows, DOCUMENT)

    joined = shards.join(F.broadcast(starts) if starts.count() <= 1_000_000 else starts, ["part", "seq"])
    return joined.mapInArrow(run, DOCUMENT)


def encode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", **named) -> DataFrame:
    """Write the token files to the shared folder and read them back. An empty table gives no rows."""
    path = scratch_dir(df.sparkSession, "tokens")
    write_files(df, path, tokenizer, id_col, text_col, **named)
    return read_files(df.sparkSession, path)

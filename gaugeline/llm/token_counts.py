"""Token counts of whole texts by a two-tier look-up on the map side.

Tier one is a broadcast table of the token counts of the most frequent words of all texts, packed into
bytes. Tier two is a bounded cache in each Python worker, filled by the library with the words that tier one
lacks. Texts stay where they are read; a pass before them shuffles words with their frequencies. Both tiers only save
time: the counts are the library's own for the whole text. The tables are exact, so neither size changes a result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeline.llm.common import saved, slices
from gaugeline.llm.wordcache import LONGEST, Generations, cut_at_spaces, portions

#: Words that the broadcast table holds at most.
FREQUENT = 1 << 16
#: Bytes of words and their frequencies that a task holds before it hands them on.
COUNTED = 32 << 20

SPACE = "▁"  # what the model writes for a space


class PieceCounter:
    """Counts tokens under a SentencePiece BPE model whose pieces hold spaces only in front."""

    _models: dict[int, PieceCounter] = {}

    def __init__(self, model: bytes, frequent: dict[str, int]):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        self.apart = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.known = TwoTier(frequent)

    @classmethod
    def of(cls, model: bytes, packed: tuple[bytes, bytes]) -> PieceCounter:
        """The worker's own counter, kept from task to task."""
        key = hash((model, packed))
        if key not in cls._models:
            cls._models = {key: cls(model, unpack(packed))}
        return cls._models[key]

    def _words(self, words: list[str]) -> list[int]:
        return list(map(len, self.model.encode(words, num_threads=1)))

    def whole(self, text: str) -> int:
        return len(self.model.encode(text, num_threads=1))

    def counts(self, texts: list[str | None]) -> list[int]:
        if not self.apart:
            return [self.whole(t) if t else 0 for t in texts]
        out: list[int] = []
        for some in portions(texts):
            lists = cut_at_spaces(pa.array([t or "" for t in some], pa.large_string()), False)
            pieces = lists.flatten().dictionary_encode()
            each = np.array(self.known.values(pieces.dictionary.to_pylist(), self._words), "i8")
            upto = np.append(0, np.cumsum(each[pieces.indices.to_numpy()]))
            out += np.diff(upto[lists.offsets.to_numpy()]).tolist()
        return out


class TwoTier:
    """The frequent words; what they lack is found in the worker's cache, and what that lacks is encoded."""

    def __init__(self, frequent: dict[str, int]):
        self.frequent, self.cache = frequent, Generations()

    def values(self, words: list[str], make: Callable[[list[str]], list[int]]) -> list[int]:
        out = list(map(self.frequent.get, words))
        misses = [i for i, n in enumerate(out) if n is None]
        for i, n in zip(misses, self.cache.values([words[i] for i in misses], make), strict=True):
            out[i] = n
        return out


def pack(table: dict[str, int]) -> tuple[bytes, bytes]:
    """Words one after another, and their lengths and counts as 16-bit numbers."""
    return "".join(table).encode(), np.array([list(map(len, table)), list(table.values())], "<u2").tobytes()


def unpack(packed: tuple[bytes, bytes]) -> dict[str, int]:
    words, (lengths, counts) = packed[0].decode(), np.frombuffer(packed[1], "<u2").reshape(2, -1).astype("i8")
    ends = np.cumsum(lengths)
    return {words[a:b]: n for a, b, n in zip((ends - lengths).tolist(), ends.tolist(), counts.tolist(), strict=True)}


def word_counts(batches: Iterator[pa.RecordBatch], held: int = COUNTED) -> Iterator[pa.RecordBatch]:
    """(word, n) over all texts of the first column; a word is given again each time that more than ``held`` bytes were held.

    Words are the pieces that ``PieceCounter`` looks up, but for empty ones and those that no cache keeps, over ``LONGEST`` characters.
    """
    def combined(parts: list[pa.Table]) -> pa.Table:
        summed = pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("n", "sum")])
        return summed.select(["word", "n_sum"]).rename_columns(["word", "n"])

    parts, size = [], 0
    for batch in slices(batches):
        for some in portions(batch.column(0).to_pylist()):
            pieces = cut_at_spaces(pa.array([t or "" for t in some], pa.large_string()), False).flatten().value_counts()
            part = pa.table({"word": pieces.field(0).cast(pa.string()), "n": pieces.field(1)})
            length = pc.utf8_length(part["word"])
            parts.append(part.filter(pc.and_(pc.greater(length, 0), pc.less_equal(length, LONGEST))))
            size += parts[-1].nbytes
            if size > held:
                parts = [combined(parts)]
                size = parts[0].nbytes
                if size > held // 2:
                    yield from parts[0].to_batches(1 << 16)
                    parts, size = [], 0
    if parts:
        yield from combined(parts).to_batches(1 << 16)


def frequent_words(docs: DataFrame, model: bytes, text: str = "text",
                   sample_rows: int | None = None, size: int = FREQUENT) -> tuple[bytes, bytes]:
    """Token counts of the ``size`` most frequent words of all rows, packed; of equally frequent ones the first in order.

    Every task counts its own rows, and its words are shuffled with their frequencies; no text is. A caller may ask for
    the first ``sample_rows`` rows of every task in place of all.
    """
    counter = PieceCounter(model, {})
    if not counter.apart:
        return pack({})
    rows = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    if sample_rows is not None:
        at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        rows = rows.withColumn("at", at).where(F.col("at") < sample_rows).select("t")
    counted = rows.mapInArrow(lambda batches: word_counts(batches), "word string, n long")
    counted = saved(counted.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    # A sort by Spark with this limit would send that many words of every task to the driver.
    left, least = size, 0
    for n, many in sorted(map(tuple, counted.groupBy("n").count().collect()), reverse=True):
        if many > left:
            least = n
            break
        left -= many
    rank = F.row_number().over(Window.partitionBy("n").orderBy("word"))
    last = counted.where(F.col("n") == least).withColumn("rank", rank).where(F.col("rank") <= left)
    words = [r.word for r in counted.where(F.col("n") > least).select("word").union(last.select("word")).collect()]
    return pack(dict(zip(words, counter._words(words), strict=True)))


def token_counts(docs: DataFrame, model_path: str, text: str = "text", n_tokens: str = "n_tokens",
                 sample_rows: int | None = None, frequent: int = FREQUENT) -> DataFrame:
    """``docs`` with the number of tokens of each whole text, without special tokens.

    Null and empty texts have 0 tokens. Rows, their order within a partition and all other columns
    stay as they are; a column already named ``n_tokens`` is replaced. No text is shuffled; the words of all texts are, with
    their frequencies, for the broadcast table (``frequent_words``).
    """
    spark = docs.sparkSession
    with open(model_path, "rb") as f:
        model = f.read()
    shared = spark.sparkContext.broadcast((model, frequent_words(docs, model, text, sample_rows, frequent)))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = PieceCounter.of(*shared.value)
        for batch in batches:
            yield pd.Series(counter.counts(batch.tolist()), dtype="int64")

    return docs.withColumn(n_tokens, count(F.coalesce(F.col(text).cast("string"), F.lit(""))))

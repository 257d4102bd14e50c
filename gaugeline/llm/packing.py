"""Packing tokenized documents into windows by best-fit decreasing.

A document longer than a window is first cut into full windows. What is left of it, and every
shorter document, is packed by falling length into the open window with the least room that still
holds it, which a segment tree over the remaining capacities finds. Documents are packed in groups of
about ``GROUP_TOKENS`` tokens, where they were read: no shuffle, bounded memory, and the few windows
left open at the end of a group of thousands are all the padding that grouping costs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import slices
from gaugeline.llm.token_records import encoder_of

WINDOW = 2048
GROUP_TOKENS = 8 << 20
PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
          "padding long, ids binary")


class OpenWindows:
    """Open windows by remaining capacity: a segment tree that counts them, leaves 0 to ``window``."""

    def __init__(self, window: int):
        self.base = 1 << window.bit_length()
        self.count = [0] * (2 * self.base)
        self.at: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, capacity: int, which: int) -> None:
        self.at[capacity].append(which)
        self._add(capacity, 1)

    def _add(self, capacity: int, n: int) -> None:
        node = self.base + capacity
        while node:
            self.count[node] += n
            node >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take out the window with the least capacity that is at least ``need``: (capacity, window)."""
        count, node = self.count, self.base + need
        if not count[node]:
            # Up to the first right sibling that has a window, then down along its left edge.
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.base:
                node <<= 1
                if not count[node]:
                    node += 1
        capacity = node - self.base
        self._add(capacity, -1)
        return capacity, self.at[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, int]:
    """Window number and offset of each length (1 to ``window``), and the number of windows.

    Equal lengths are placed in the order given, so that the result is always the same.
    """
    where, offset = np.zeros(len(lengths), "i8"), np.zeros(len(lengths), "i8")
    windows, used = OpenWindows(window), 0
    sizes = lengths.tolist()
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = sizes[i]
        found = windows.tightest(need)
        if found is None:
            found = window, used
            used += 1
        capacity, which = found
        where[i], offset[i] = which, window - capacity
        if capacity > need:
            windows.put(capacity - need, which)
    return where, offset, used


def padding_of(filled: np.ndarray, window: int) -> np.ndarray:
    """A window that is filled to a power of two is left as long as that; others are padded to ``window``."""
    return np.where(filled & (filled - 1) == 0, 0, window - filled)


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, window: int = WINDOW, key: str = "doc_id",
                   text: str = "text", spaces: bool = False, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece: its document, place in it and in its sequence, and its ids (unsigned 32-bit).

    A document is its text's tokens and ``end_id``; null and empty texts are ``end_id`` alone. Pieces of
    a sequence follow each other without gaps from offset 0, ``padding`` is what its sequence is padded with.
    Rows with null or repeated keys are packed like any others. ``sequence_id`` has the task's number in its
    high bits. An empty table gives no pieces.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value, spaces)
        end, width = np.array([end_id], encoder.dtype).tobytes(), encoder.dtype.itemsize
        keys, ids, tokens = [], [], 0
        sequence = TaskContext.get().partitionId() << 36
        for batch in slices(batches, 2048):
            keys += batch.column(0).to_pylist()
            some = [x + end for x in encoder.encode(batch.column(1).to_pylist())]
            ids += some
            tokens += sum(map(len, some)) // width
            if tokens >= group_tokens:
                used = yield from packed(keys, ids, encoder.dtype, window, sequence)
                keys, ids, tokens, sequence = [], [], 0, sequence + used
        if ids:
            yield from packed(keys, ids, encoder.dtype, window, sequence)

    return docs.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(pack, PIECES)


def packed(keys: list, ids: list[bytes], dtype: np.dtype, window: int, sequence: int):
    """Pieces of one group as batches; returns the number of sequences used."""
    n = np.array(list(map(len, ids)), "i8") // dtype.itemsize
    pieces = -(-n // window)
    doc = np.repeat(np.arange(len(n)), pieces)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
    length = np.minimum(window, n[doc] - start)
    where, offset, used = best_fit_decreasing(length, window)
    padding = padding_of(np.bincount(where, length, used).astype("i8"), window)[where]
    for begin in range(0, len(doc), 2048):
        some = slice(begin, begin + 2048)
        values = [
            np.frombuffer(ids[d], dtype, m, s * dtype.itemsize).astype("<u4").tobytes()
            for d, s, m in zip(doc[some].tolist(), start[some].tolist(), length[some].tolist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays([
            pa.array([keys[d] for d in doc[some].tolist()], pa.int64()), pa.array(start[some]), pa.array(length[some]),
            pa.array(n[doc[some]]), pa.array(where[some] + sequence), pa.array(offset[some]), pa.array(padding[some]),
            pa.array(values, pa.binary()),
        ], names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "padding", "ids"])
    return used

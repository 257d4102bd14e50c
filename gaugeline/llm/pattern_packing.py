"""Packing by length patterns whose numbers non-negative least squares fit to the histogram of lengths.

Only documents longer than a window are cut. Lengths are counted in ``UNITS`` steps of a window, and all patterns are listed: the ways in
which few pieces of such steps fill a window. Non-negative least squares finds how often each pattern has to be used for the
patterns to need what the histogram has; the numbers are rounded. A pattern takes its pieces from the steps it names, and the last of them
is the longest piece that still fits, so that rounding to steps leaves little room. What is left over, mostly
short pieces, is packed by falling length into the room of open windows, the tightest first.

Tasks pack groups of about ``GROUP_TOKENS`` tokens where they were read. The few windows of each group that are left with room are
opened again, pooled over all groups and packed once more, so that small groups lose nothing either.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import saved, slices
from gaugeline.llm.packing import OpenWindows
from gaugeline.llm.token_records import encoder_of

WINDOW = 4096
#: Steps of a window in which lengths are counted, and pieces of a pattern at most.
UNITS, PARTS = 64, 3
GROUP_TOKENS = 8 << 20
#: A group's windows with more room than this share of a window are opened again: the emptiest, up to so many and so large a share of them.
ROOM, REOPENED, SHARE = 1 / 512, 8, 1 / 8
PIECES = "doc_id long, piece int, start long, length long, doc_tokens long, sequence_id long, offset long, room long, pooled boolean, ids binary"


@functools.cache
def patterns_of(units: int = UNITS, most: int = PARTS) -> tuple[tuple[int, ...], ...]:
    """All falling sequences of at most ``most`` whole numbers above 0 that add up to ``units``, those of large parts first."""
    def fill(left: int, largest: int, parts: int) -> Iterator[tuple[int, ...]]:
        if not left:
            yield ()
        elif parts:
            for first in range(min(left, largest), -(-left // parts) - 1, -1):
                for rest in fill(left - first, first, parts - 1):
                    yield (first, *rest)

    return tuple(fill(units, units, most))


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The x >= 0 with the least |ax - b|, by an active set: columns enter by their gradient, and leave where they would get negative."""
    x, used = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    slack = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(3 * a.shape[1]):
        gain = np.where(used, -np.inf, a.T @ (b - a @ x))
        best = int(gain.argmax())
        if gain[best] <= slack:
            break
        used[best] = True
        while True:
            at = np.flatnonzero(used)
            wanted = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if not len(at) or wanted.min() > 0:
                x[:] = 0
                x[at] = wanted
                break
            down = wanted <= 0
            now = x[at]
            step = np.min(now[down] / np.maximum(now[down] - wanted[down], 1e-300))
            x[at] = now + step * (wanted - now)
            out = at[x[at] <= 1e-12 * max(1.0, x.max())]
            if not len(out):
                out = at[down][np.argmin(x[at][down])][None]
            used[out], x[out] = False, 0
    return x


def fitted_counts(lengths: np.ndarray, window: int, units: int = UNITS, most: int = PARTS) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how often to use each. Long pieces weigh more in the fit: short ones find room anywhere."""
    listed = patterns_of(units, most)
    histogram = np.bincount(np.clip(steps_of(lengths, window, units), 1, units), minlength=units + 1)[1:].astype("f8")
    weights = np.arange(1, units + 1) / units
    columns = np.zeros((units, len(listed)))
    for j, pattern in enumerate(listed):
        for part in pattern:
            columns[part - 1, j] += 1
    counts = np.floor(nnls(columns * weights[:, None], histogram * weights) + 0.5).astype(int)
    return [(p, n) for p, n in zip(listed, counts.tolist(), strict=True) if n]


def steps_of(lengths: np.ndarray, window: int, units: int) -> np.ndarray:
    return (2 * lengths * units + window) // (2 * window)


class Pieces:
    """Pieces not yet placed, by length: the longest up to a limit is found in a tree of counts."""

    def __init__(self, lengths: np.ndarray, window: int):
        self.window, self.left, self.tree = window, len(lengths), OpenWindows(window)
        # Those put in last come out first: equal lengths leave in the order given.
        for i in range(len(lengths) - 1, -1, -1):
            self.put(int(lengths[i]), i)
        self.left = len(lengths)

    def put(self, length: int, piece: int) -> None:
        self.tree.put(self.window - length, piece)
        self.left += 1

    def longest(self, most: int) -> tuple[int, int] | None:
        """Take out (length, piece) of the longest piece of at most ``most``."""
        found = self.tree.tightest(self.window - most) if most > 0 else None
        if found is None:
            return None
        self.left -= 1
        return self.window - found[0], found[1]


def pack_by_patterns(lengths: np.ndarray, window: int = WINDOW, units: int = UNITS, most: int = PARTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window number and offset of each length (1 to ``window``), and the room left in each window. The same for the same lengths."""
    where, offset = np.zeros(len(lengths), "i8"), np.zeros(len(lengths), "i8")
    rooms: list[int] = []
    pieces, opened = Pieces(lengths, window), OpenWindows(window)

    def close(taken: list[tuple[int, int]]) -> None:
        at = 0
        for length, piece in taken:
            where[piece], offset[piece] = len(rooms), at
            at += length
        if at < window:
            opened.put(window - at, len(rooms))
        rooms.append(window - at)

    for pattern, times in fitted_counts(lengths, window, units, most):
        for _ in range(times):
            taken: list[tuple[int, int]] = []
            room = window
            for i, part in enumerate(pattern):
                last = i == len(pattern) - 1
                # The pieces of a step, but for the last place whatever fills the room.
                highest = room if last else min(room, ((2 * part + 1) * window - 1) // (2 * units))
                found = pieces.longest(highest)
                if found is None:
                    break
                taken.append(found)
                room -= found[0]
                if found[0] * 2 * units < (2 * part - 1 - 2 * last) * window:
                    break
            else:
                close(taken)
                continue
            # The step has no piece left: this pattern is used up.
            for length, piece in reversed(taken):
                pieces.put(length, piece)
            break
    while pieces.left:
        length, piece = pieces.longest(window)
        found = opened.tightest(length)
        if found is None:
            close([(length, piece)])
            continue
        room, number = found
        where[piece], offset[piece] = number, window - room
        rooms[number] = room - length
        if room > length:
            opened.put(room - length, number)
    return where, offset, np.array(rooms, "i8")


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, window: int = WINDOW, key: str = "doc_id", text: str = "text",
                   spaces: bool = False, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece: its document, place in it and in its sequence, the room its sequence is left with, and its ids (unsigned 32-bit).

    A document is its text's tokens and ``end_id``; null and empty texts are ``end_id`` alone. Only a document of more than
    ``window`` tokens is cut, into pieces of ``window``; the last may be shorter. Rows with null or repeated keys are packed
    like any others; an empty table gives no pieces; other columns are left behind. Pieces are written once and
    read again, and those of windows opened again are packed with those of other groups.
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
                sequence += yield from packed_group(keys, ids, encoder.dtype, window, sequence)
                keys, ids, tokens = [], [], 0
        if ids:
            yield from packed_group(keys, ids, encoder.dtype, window, sequence)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = [b for b in batches if b.num_rows]
        if not some:
            return
        held = pa.Table.from_batches(some)
        where, offset, rooms = pack_by_patterns(held["length"].to_numpy(), window)
        for name, values in (("sequence_id", -1 - (where + (TaskContext.get().partitionId() << 36))), ("offset", offset), ("room", rooms[where])):
            held = held.set_column(held.schema.get_field_index(name), name, pa.array(values))
        yield from held.to_batches(max_chunksize=2048)

    first = saved(docs.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(pack, PIECES), "packed-pieces")
    pooled = first.where("pooled")
    tokens = pooled.agg(F.coalesce(F.sum("length"), F.lit(0))).head()[0]
    rest = pooled.repartition(max(1, -(-tokens // group_tokens))).sortWithinPartitions("doc_id", "piece", "length")
    return first.where("not pooled").unionByName(rest.mapInArrow(again, PIECES)).drop("pooled")


def reopened(rooms: np.ndarray, window: int) -> np.ndarray:
    """Which windows are packed again with those of other groups."""
    order = np.argsort(-rooms, kind="stable")[: max(REOPENED, int(len(rooms) * SHARE))]
    out = np.zeros(len(rooms), bool)
    out[order[rooms[order] > window * ROOM]] = True
    return out


def packed_group(keys: list, ids: list[bytes], dtype: np.dtype, window: int, sequence: int):
    """Pieces of one group as batches; returns the number of sequences used."""
    n = np.array(list(map(len, ids)), "i8") // dtype.itemsize
    count = -(-n // window)
    doc = np.repeat(np.arange(len(n)), count)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = piece * window
    length = np.minimum(window, n[doc] - start)
    where, offset, rooms = pack_by_patterns(length, window)
    pooled = reopened(rooms, window)[where]
    for begin in range(0, len(doc), 2048):
        some = slice(begin, begin + 2048)
        values = [
            np.frombuffer(ids[d], dtype, m, s * dtype.itemsize).astype("<u4").tobytes()
            for d, s, m in zip(doc[some].tolist(), start[some].tolist(), length[some].tolist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays([
            pa.array([keys[d] for d in doc[some].tolist()], pa.int64()), pa.array(piece[some].astype("i4")), pa.array(start[some]),
            pa.array(length[some]), pa.array(n[doc[some]]), pa.array(where[some] + sequence), pa.array(offset[some]),
            pa.array(rooms[where[some]]), pa.array(pooled[some]), pa.array(values, pa.binary()),
        ], names=["doc_id", "piece", "start", "length", "doc_tokens", "sequence_id", "offset", "room", "pooled", "ids"])
    return len(rooms)

"""Runs of periodically repeated words, found with an enhanced suffix array.

A run is a stretch of words with smallest period q that no neighbouring word extends, at least ``times`` periods and
``least`` words long. The words of a slice of documents are sorted into one suffix array by prefix doubling, with common
prefixes of neighbours beside it; documents never share words, so that nothing reaches across them. For every interval of suffixes that
share exactly d words, the suffixes of all its children but the largest ask through the inverse array whether the suffix d words
on, or d words back, lies in the interval as well, but in another child: then a square of period d stands there whose last word
is the last of its run. Squares are rotated to the left while words agree, and those of one run are merged. There is no tree:
intervals are bounds in arrays, and all that is done is array operations on a slice. Choosing smaller children keeps the number of
questions at n log n.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import slices
from gaugeline.llm.wordcache import portions

#: A run's least length in periods and in words.
TIMES, LEAST = 4, 6
#: Characters of the texts searched at once; a longer text is searched alone.
AT_ONCE = 2 << 20
RUNS = "key long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def suffix_array(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, and for l = 0, 1, ... the rank of every position by its first 2**l symbols.

    A suffix stops at its position's end; an end comes before any symbol.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    at = np.arange(n)
    key = symbols[order]
    rank, levels, width = np.zeros(n, "i8"), [], 1
    while True:
        head = np.append(True, key[1:] != key[:-1])
        first = at[np.flatnonzero(head)]
        rank[order[at]] = np.repeat(first, np.diff(np.append(np.flatnonzero(head), len(at))))
        levels.append(rank.astype("i4"))
        # Suffixes that share their rank with a neighbour are sorted further.
        alone = head & np.append(head[1:], True)
        at = at[~alone]
        if not len(at):
            return order, levels
        where = order[at]
        on = where + width
        inside = on < ends[where]
        second = np.zeros(len(at), "i8")
        second[inside] = rank[on[inside]] + 1
        key = rank[where] * (n + 1) + second
        again = np.argsort(key, kind="stable")
        order[at], key = where[again], key[again]
        width *= 2


def common_prefixes(order: np.ndarray, levels: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
    """The number of symbols that every suffix shares with the one before it in order; -1 at the first."""
    lcp = np.zeros(len(order), "i8")
    lcp[:1] = -1
    at = np.flatnonzero(np.append(False, levels[0][order[1:]] == levels[0][order[:-1]]))
    a, b, total = order[at - 1], order[at], np.zeros(len(at), "i8")
    end = ends[a]
    for level in reversed(range(len(levels))):
        # Both are suffixes of one document; the one that is further on ends first.
        inside = np.maximum(a, b) < end
        same = np.zeros(len(at), bool)
        same[inside] = levels[level][a[inside]] == levels[level][b[inside]]
        step = same.astype("i8") << level
        a, b, total = a + step, b + step, total + step
    lcp[at] = total
    return lcp


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """For every place with a value of 1 or more, the last one before it with a smaller value. The first value is smaller."""
    before = np.arange(-1, len(values) - 1)
    open_ = np.flatnonzero(values >= 1)
    while len(open_):
        open_ = open_[values[before[open_]] >= values[open_]]
        # All between a place and its candidate are at least as large, so its candidate's candidate is the next one.
        before[open_] = before[before[open_]]
    return before


def squares(order: np.ndarray, lcp: np.ndarray, begins: np.ndarray, ends: np.ndarray, times: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of squares whose repetition ends with them: the next word, if any, is another.

    Periods of which ``times`` do not go into the document are passed over.
    """
    n = len(order)
    none = np.zeros(0, "i8")
    place = np.empty(n, "i8")
    place[order] = np.arange(n)
    # One interval for each k that parts two of its children: [left, right) holds the suffixes that share lcp[k] symbols.
    left = nearest_smaller(lcp)
    right = n - nearest_smaller(np.append(-1, lcp[:0:-1]))[::-1]
    right = np.append(n, right)[:n]
    k = np.flatnonzero((lcp >= 1) & (lcp * times <= (ends - begins)[order]))
    if not len(k):
        return none, none
    k = k[np.lexsort((k, right[k], left[k]))]
    new = np.append(True, (left[k][1:] != left[k][:-1]) | (right[k][1:] != right[k][:-1]))
    last = np.append(new[1:], True)
    # Children: one before each k, and one after the interval's last.
    owner = np.cumsum(new) - 1
    child_of = np.append(owner, np.arange(owner[-1] + 1))
    child_from = np.append(np.where(new, left[k], np.append(0, k[:-1])), k[last])
    child_to = np.append(k, right[k][last])
    by_owner = np.lexsort((child_from - child_to, child_of))
    largest = by_owner[np.append(True, child_of[by_owner][1:] != child_of[by_owner][:-1])]
    small = np.ones(len(child_of), bool)
    small[largest] = False
    child_of, child_from, child_to = child_of[small], child_from[small], child_to[small]
    sizes = child_to - child_from
    asked = np.arange(sizes.sum()) + np.repeat(child_from - (np.cumsum(sizes) - sizes), sizes)
    child = np.repeat(np.arange(len(sizes)), sizes)
    heads = k[new]
    depth, lower, upper = (x[heads][child_of[child]] for x in (lcp, left, right))
    here = order[asked]
    found = []
    for step in (depth, -depth):
        there = here + step
        inside = (there >= begins[here]) & (there < ends[here])
        other = place[np.where(inside, there, 0)]
        hit = inside & (other >= lower) & (other < upper) & ~((other >= child_from[child]) & (other < child_to[child]))
        found.append(np.stack([np.minimum(here, there)[hit], depth[hit]]))
    start, period = np.unique(np.concatenate(found, axis=1), axis=1)
    return start, period


def runs_of(symbols: np.ndarray, begins: np.ndarray, ends: np.ndarray, times: int = TIMES, least: int = LEAST) -> np.ndarray:
    """Runs (start, length, period) in order of start and period; ``begins`` and ``ends`` are those of each place's document.

    Symbols of different documents have to differ, and a document's places to follow one another.
    """
    if not len(symbols):
        return np.zeros((0, 3), "i8")
    order, levels = suffix_array(symbols, ends)
    start, period = squares(order, common_prefixes(order, levels, ends), begins, ends, times)
    # How far a square has to be rotated to the left for its run to be long enough; few get past the first words.
    need = np.maximum(times * period, least) - 2 * period
    for step in range(1, 9):
        ok = need < step
        at = start - step
        inside = at >= begins[start]
        ok[inside] |= symbols[at[inside]] == symbols[at[inside] + period[inside]]
        start, period, need = start[ok], period[ok], need[ok]
    runs: dict[int, list[tuple[int, int]]] = {}
    for s, q, far in sorted(zip(start.tolist(), period.tolist(), need.tolist(), strict=True), key=lambda x: x[1]):
        same_end = runs.setdefault(s + 2 * q, [])
        # A square of several periods of a run that ends with it: of the same run.
        if any(q % p == 0 and first <= s for first, p in same_end):
            continue
        back = agreement(symbols, s, q, int(begins[s]))
        if back >= far:
            same_end.append((s - back, q))
    found = [(first, end - first, q) for end, some in runs.items() for first, q in some]
    return np.array(sorted(found, key=lambda x: (x[0], x[2])), "i8").reshape(-1, 3)


def agreement(symbols: np.ndarray, at: int, period: int, begin: int) -> int:
    """How many words before ``at`` are those a period later, one after another."""
    back, chunk = 0, 32
    while (here := at - back) > begin:
        size = min(chunk, here - begin)
        differ = np.flatnonzero(symbols[here - size : here] != symbols[here - size + period : here + period])
        if len(differ):
            return back + size - 1 - int(differ[-1])
        back, chunk = back + size, chunk * 2
    return back


def search(texts: list[str | None], times: int = TIMES, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Of each text the number of words, the number of runs and the collapsed text; and all runs, by text."""
    lists = pc.ascii_split_whitespace(pa.array([t or "" for t in texts], pa.string()))
    words, offsets = lists.flatten(), lists.offsets.to_numpy()
    some = pc.not_equal(pc.binary_length(words), 0)
    kept = np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False)))
    words, offsets = words.filter(some), kept[offsets]
    n = np.diff(offsets)
    codes = words.dictionary_encode()
    doc = np.repeat(np.arange(len(texts)), n)
    symbols = doc * (len(codes.dictionary) + 1) + codes.indices.to_numpy()
    begins, ends = offsets[:-1][doc], offsets[1:][doc]
    runs = runs_of(symbols, begins, ends, times, least)
    owner = doc[runs[:, 0]]
    change = np.zeros(len(words) + 1, "i8")
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    stay = np.cumsum(change)[:-1] == 0
    upto = np.append(0, np.cumsum(stay))[offsets]
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(upto, pa.int32()), words.filter(pa.array(stay))), " ")
    runs[:, 0] -= offsets[:-1][owner]
    return n, np.bincount(owner, minlength=len(texts)), runs, collapsed


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", times: int = TIMES, least: int = LEAST) -> DataFrame:
    """One row per document: key, n_words, its runs in order of start and period, and its text without repetitions.

    ``collapsed`` has the words, joined by one space, that no run contains after the run's first period. Texts are
    searched whole; null and empty texts have no words, no runs and an empty collapsed text. Rows with null or repeated keys are searched like
    any others, an empty table gives no rows, and other columns are left behind. No shuffle: a task holds the arrays
    of some texts at a time, about 200 bytes a word.
    """
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            keys, begin = batch.column(0), 0
            for texts in portions(batch.column(1).to_pylist(), AT_ONCE):
                n, n_runs, runs, collapsed = search(texts, times, least)
                spans = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in runs.T], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays([
                    keys.slice(begin, len(texts)), pa.array(n),
                    pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_runs)), pa.int32()), spans),
                    collapsed,
                ], names=["key", "n_words", "runs", "collapsed"])
                begin += len(texts)

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("t")).mapInArrow(find, RUNS)

"""Toxicity of deobfuscated text.

Channel. A writer who hides a word swaps letters for look-alikes, puts marks or spaces between them, or repeats them. Spans
that look like that (letters mixed with digits or signs, four or more single letters in a row, a letter three times
running) become lattices: each sign may stand for any of its letters, for nothing, or, where a letter repeats, for more of
the same, and spaces and separators also for the end of a word; each choice has a cost. Viterbi search over the last two letters finds the reading that is likeliest
under a letter trigram model, which is counted over all documents, and all ways to break it into words that are nearly as likely count. All other words stand as they are.

Score. A noisy-or over the entries of a lexicon, looked up among the text's own and restored words: each entry that is there makes
the text toxic with the share of toxic documents among those that have it. The lexicon comes from a bounded sample of labelled
documents, from which copies are removed before anything is counted: all whole words that are surely in toxic documents mostly,
then, greedily, beginnings of words for toxic documents that have no such word.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.llm.common import saved, slices
from gaugeline.llm.labelled import id_remainder, training_rows

TRAIN_ROWS = 8_000
LEAST_DOCS = 5  # toxic documents that a lexicon entry must be in, copies counted once
SURE = 0.7  # least lower bound (95 %) of the share of toxic documents among those with an entry
SHINGLE, SIMILAR = 5, 0.8  # documents that share so much of their runs of so many words count as copies
SKETCH = 128  # least hashes of a document's runs that are compared
BEGINNINGS = range(5, 9)  # letters of word beginnings that a lexicon may have
MARKS = " !¡(|+@$€£"  # at a span's ends they may be letters or marks: it is read with and without them
CACHED = 64  # characters of a span whose words are remembered

# Letters that each sign may stand for.
LOOK_ALIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "tl", "8": "b", "9": "gq",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
LETTERS = "abcdefghijklmnopqrstuvwxyz"
BETWEEN = " .-_*#~,'/\\"
SWAP, DROP, JOIN, MASK, REPEAT, DOUBLE, BREAK = 1.0, 9.0, 0.3, 3.0, 0.3, 1.5, 1.0  # costs
MARGIN = 6.0  # how much more than the least a way to break a span into words may cost
WINDOW = 48  # letters of a word that is in a less likely reading only
JOINED = "\x1f"  # stands in a reading for a separator that does not end a word

EDGE = 0  # symbols of the letter model: 0 the word's edge, 1-26 letters, 27 any other letter
SYMBOLS = 28
_SYMBOL = np.zeros(256, "u1")
_SYMBOL[ord("a") : ord("z") + 1] = np.arange(1, 27)
_SYMBOL[ord("A") : ord("Z") + 1] = np.arange(1, 27)
_SYMBOL[128:] = 27
_OF_LETTER = {x: (i + 1,) for i, x in enumerate(LETTERS)}

_SIGNS = re.escape("".join(LOOK_ALIKE))
_L = r"[^\W\d_]"  # a letter of any language
# Runs are possessive and begin where nothing of theirs is before them, so that time is linear in the text.
_MIXED = re.compile(
    rf"(?<!{_L})(?<![{_SIGNS}])[{_SIGNS}]*+{_L}++(?:[{_SIGNS}*#._~'\-]++{_L}++)++[{_SIGNS}]*+"
    rf"|(?<!\S)[{_SIGNS}]++{_L}{{2,}}+"
    rf"|(?<!{_L}){_L}++[0-9@$|+!]*[0-9@$|+]")
_SIGN = re.compile(rf"[0-9@$|+!(€£¡*#_~\-.'](?=[^\W_]|[@$])|{_L}[0-9@$|+]")
_SPACED = re.compile(rf"(?<![^\W_])(?:(?:{_L}|[{_SIGNS}])[ .\-_*~/]{{1,2}}){{3,}}(?:{_L}|[{_SIGNS}])(?![^\W_])")
_TRIPLES = [c * 3 for c in LETTERS]
_TRIPLE = re.compile(rf"({_L})\1\1")
_TRIPLED = re.compile(rf"(?<!{_L}){_L}*?({_L})\1\1{_L}*+")
_WORD = re.compile(r"[^\W\d_]+")


def count_letters(text: str) -> np.ndarray:
    """How often each three symbols follow each other in the text, as a flat array."""
    s = _SYMBOL[np.frombuffer(("  " + text + "  ").encode(), "u1")].astype("i4")
    return np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)


class LetterModel:
    """Costs (negative logarithms) of a letter after two others."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype("f8")
        two = c.sum(axis=0)
        two = (two + 0.5) / (two + 0.5).sum(axis=1, keepdims=True)
        self.costs = -np.log((c + 20 * two[None]) / (c.sum(axis=2, keepdims=True) + 20))
        self.cost = self.costs.tolist()
        self.cache: dict[str, str] = {}

    def restore(self, span: str) -> tuple[str, ...]:
        """The words behind a span that the likeliest reading has, or readings that are nearly as likely."""
        words = self.cache.get(span)
        if words is None:
            words = tuple(sorted(self._words(self._viterbi(span))))
            if len(span) <= CACHED:
                if len(self.cache) > 100_000:
                    self.cache.clear()
                self.cache[span] = words
        return words

    def _add(self, p: int, q: int, x: str) -> tuple[float, int, int]:
        """Cost of a letter after the symbols p and q, and the last two symbols then."""
        cost = 0.0
        for n in symbols(x):
            cost, p, q = cost + self.cost[p][q][n], q, n
        return cost, p, q

    def _viterbi(self, span: str) -> str:
        """The likeliest reading: its letters, with a space or JOINED where the span has a space or separator."""
        # A reading is a chain of (what came before, letter).
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(EDGE, EDGE): (0.0, None)}
        signs = [(sign, at, n) for sign, run in groupby(span) for n in [len(list(run))] for at in range(n)]
        for sign, at, run in signs:
            between = sign in BETWEEN or sign.isspace()
            options = []
            if sign.isalpha():
                options.append((sign, 0.0))
            elif sign in LOOK_ALIKE:
                options += [(x, SWAP) for x in LOOK_ALIKE[sign]]
                options.append(("", DROP))
            elif between:
                options.append(("", JOIN if sign in BETWEEN and sign != " " else 0.0))
                if sign in "*#":
                    options += [(x, MASK) for x in LETTERS]
            else:
                options.append(("", DROP))
            again = run > 2 and at > 0 and not between  # only three in a row or more count as repetition
            step: dict[tuple[int, int], tuple[float, tuple | None]] = {}

            def offer(key: tuple[int, int], cost: float, chain: tuple | None) -> None:
                if key not in step or cost < step[key][0]:
                    step[key] = (cost, chain)

            if sign in "*#" and len(best) > 30:  # any letter after many pairs of letters: all at once
                before = np.full((SYMBOLS, SYMBOLS), np.inf)
                for (p, q), (cost, _) in best.items():
                    before[p, q] = cost
                after = before[:, :, None] + self.costs[:, :, 1:27]
                least, came = after.min(axis=0) + MASK, after.argmin(axis=0)
                for q, n in zip(*map(np.ndarray.tolist, np.nonzero(np.isfinite(least))), strict=True):
                    offer((q, n + 1), float(least[q, n]), (best[int(came[q, n]), q][1], LETTERS[n]))
                options = [("", JOIN)]
            for (p, q), (cost, chain) in best.items():
                for x, price in options:
                    if x:
                        more, *key = self._add(p, q, x)
                        if again and chain and chain[1] == x:  # more of the same letter
                            offer((p, q), cost + REPEAT, chain)
                        offer(tuple(key), cost + price + more + (DOUBLE if again else 0), (chain, x))
                    else:
                        offer((p, q), cost + price, (chain, JOINED) if between else chain)
                        if between and q != EDGE:  # or a word ends here
                            offer((q, EDGE), cost + BREAK + self.cost[p][q][EDGE], (chain, " "))
            best = step
        chain = min(((cost + self.cost[p][q][EDGE], i, chain) for i, ((p, q), (cost, chain)) in enumerate(best.items())))[2]
        letters = []
        while chain:
            chain, x = chain
            letters.append(x)
        return "".join(reversed(letters))

    def _words(self, reading: str) -> set[str]:
        """Words of the likeliest way to break a reading at spaces or separators, and of ways that cost up to MARGIN more.

        Of the latter only words of up to WINDOW letters, so that time and memory are linear in the reading.
        """
        parts = [x for x in re.split(f"[ {JOINED}]", reading) if x]
        at = [0, *accumulate(map(len, parts))]
        ends = [(0.0, EDGE)]  # least cost up to each place between parts, and the symbol before it
        begun: list[tuple[int, float, int, int]] = []  # first part, cost, last two symbols of words that go on
        edges: list[list[tuple[int, float]]] = []  # for each part, words that may end with it: first part, cost of the word
        for n, part in enumerate(parts):
            begun.append((n, ends[-1][0], ends[-1][1], EDGE))
            on, least = [], {}
            for first, cost, p, q in begun:
                for x in part:
                    more, p, q = self._add(p, q, x)
                    cost += more
                on.append((first, cost, p, q))
                least[p, q] = min((cost, first), least.get((p, q), (math.inf, 0)))
            # From equal symbols words go on alike, so what is too costly here stays so.
            begun = [w for w in on if (best := least[w[2:]])[1] == w[0]
                     or w[1] <= best[0] + MARGIN and at[n + 1] - at[w[0]] <= WINDOW]
            edges.append([(first, cost + self.cost[p][q][EDGE] + BREAK - ends[first][0]) for first, cost, p, q in begun])
            ends.append((min(ends[first][0] + cost for first, cost in edges[-1]), symbols(part[-1])[-1]))
        rest = [math.inf] * len(parts) + [0.0]
        words = set()
        for last in range(len(parts) - 1, -1, -1):
            for first, cost in edges[last]:
                rest[first] = min(rest[first], cost + rest[last + 1])
                if ends[first][0] + cost + rest[last + 1] <= ends[-1][0] + MARGIN and at[last + 1] - at[first] <= WINDOW:
                    words.add("".join(parts[first : last + 1]))
        last = len(parts)
        while last:
            first = min(edges[last - 1], key=lambda e: ends[e[0]][0] + e[1])[0]
            words.add("".join(parts[first:last]))
            last = first
        return words


def symbols(letter: str) -> tuple[int, ...]:
    """The letter's symbols in the letter model: one for each of its bytes."""
    return tuple(map(int, _SYMBOL[np.frombuffer(letter.encode(), "u1")])) if letter not in _OF_LETTER else _OF_LETTER[letter]


def spans(low: str) -> Iterator[str]:
    """Spans of a lower-case text that may hide a word."""
    if _SIGN.search(low):
        yield from (m.group() for m in _MIXED.finditer(low))
    if any(t in low for t in _TRIPLES) or not low.isascii() and _TRIPLE.search(low):
        yield from (m.group() for m in _TRIPLED.finditer(low))
    yield from (m.group() for m in _SPACED.finditer(low))


def restored_words(low: str, model: LetterModel) -> set[str]:
    """Words restored from the spans of a lower-case text that hide one."""
    return {w for s in set(spans(low)) for h in {s.strip(), s.strip(MARKS)} if h for w in model.restore(h)}


def features(text: str | None, model: LetterModel) -> set[str]:
    """Entries that a lexicon may have: whole words (idiot$) and beginnings of longer words (idiot~)."""
    low = (text or "").lower()
    words = set(_WORD.findall(low)) | restored_words(low, model)
    return {w + "$" for w in words} | {w[:k] + "~" for w in words for k in BEGINNINGS if len(w) > k}


@dataclass
class Model:
    letters: LetterModel
    weights: dict[str, float]
    base: float

    def __post_init__(self):
        letter = r"[^\W\d_]"
        # Each factor is the chance that the text is not toxic in spite of the entry.
        self.entries = [
            (e[:-1], re.compile(rf"(?<!{letter}){re.escape(e[:-1])}" + (letter if e[-1] == "~" else rf"(?!{letter})")), 1 - w)
            for e, w in self.weights.items()]

    def score(self, text: str | None) -> float:
        low = (text or "").lower()
        hidden = restored_words(low, self.letters)
        if hidden:
            low += " " + " ".join(sorted(hidden))
        clean = 1 - self.base
        for stem, pattern, factor in self.entries:
            if stem in low and pattern.search(low):
                clean *= factor
        return 1 - clean


def letter_model(docs: DataFrame, text: str = "text") -> LetterModel:
    """Trigram counts over all documents: at most 21,952 sums, combined in each task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, "i8")
        for batch in slices(batches, 256):
            total += count_letters("  ".join(t for t in batch.column(0).to_pylist() if t))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["t", "n"])

    rows = docs.select(F.col(text).cast("string")).mapInArrow(count, "t long, n long")
    counts = np.zeros(SYMBOLS**3, "i8")
    for r in rows.groupBy("t").agg(F.sum("n").alias("n")).collect():
        counts[r.t] = r.n
    return LetterModel(counts)


def train(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = TRAIN_ROWS, label: str = "toxic",
          key: str = "doc_id", text: str = "text") -> Model:
    """Letter model of all documents, lexicon and weights of at most ``rows`` labelled ones that meet ``learn`` (on k)."""
    letters = letter_model(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(letters)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            texts = batch.column(1).to_pylist()
            words = [sorted(features(t, shared.value)) for t in texts]
            hashes = [xxhash.xxh64_intdigest(t.encode()) for t in texts]
            sketches = [sketch(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(hashes, pa.uint64()).view(pa.int64()), pa.array(words, pa.list_(pa.string())),
                 pa.array(sketches, pa.list_(pa.int64()))],
                names=["y", "h", "words", "sketch"])

    # Copies go before anything is counted: equal texts first, then those that are similar to one that stays.
    distinct = saved(
        training_rows(docs, labels, label, learn, rows, key, text)
        .mapInArrow(read, "y int, h long, words array<string>, sketch array<long>").dropDuplicates(["y", "h"]), "toxic-sample")
    kept = one_of_copies([(r.y, r.h, r.sketch) for r in distinct.select("y", "h", "sketch").orderBy("y", "h").collect()])
    if {y for y, _ in kept} != {0, 1}:
        return Model(letters, {}, 0.0 if not any(y for y, _ in kept) else 1.0)
    firsts = docs.sparkSession.createDataFrame(kept, "y int, h long")
    sample = distinct.join(F.broadcast(firsts), ["y", "h"], "left_semi").select("y", "h", "words")
    counts = (
        sample.select("y", F.explode("words").alias("w")).groupBy("w")
        .agg(F.sum("y").cast("long").alias("toxic"), F.count("*").alias("n")).where(F.col("toxic") >= LEAST_DOCS))
    share = {r.w: (r.toxic, r.n) for r in counts.collect() if lower_bound(r.toxic, r.n) >= SURE}
    sure = docs.sparkSession.sparkContext.broadcast(set(share))

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [[w for w in words if w in sure.value] for words in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.list_(pa.string()))], names=["y", "held"])

    found = [(r.y, r.held) for r in sample.select("y", "words").mapInArrow(hold, "y int, held array<string>").collect()]
    chosen = choose(found, set(share))
    rest = [y for y, held in found if chosen.isdisjoint(held)]
    return Model(letters, {w: (share[w][0] + 0.1) / (share[w][1] + 1) for w in sorted(chosen)},
                 (sum(rest) + 0.1) / (len(rest) + 1) if rest else 0.1)


def sketch(text: str) -> list[int]:
    """The least hashes of the text's runs of words (all words if there are fewer), ascending, without repeats."""
    words = text.encode().lower().split()
    runs = {b" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}
    h = np.sort(np.fromiter(map(xxhash.xxh64_intdigest, runs), "u8", len(runs)).view("i8"))
    return np.unique(h)[:SKETCH].tolist()


def one_of_copies(found: list[tuple[int, int, list[int]]]) -> list[tuple[int, int]]:
    """(label, text hash) of the rows (label, text hash, sketch) that are similar to no earlier one that stays, labels apart.

    Similarity is that of the runs of words: exact for texts of up to SKETCH runs, else estimated from the least hashes
    of both texts together.
    """
    kept: list[tuple[int, int]] = []
    sketches: list[np.ndarray] = []
    index: dict[tuple[int, int], list[int]] = {}
    for y, h, least in found:
        own = np.array(least, "i8")
        # Of a similar text, this share of the least hashes is among its own; only such texts are compared.
        shared = Counter(i for v in least for i in index.get((y, v), ()))
        if any(n + 1e-9 >= SIMILAR * len(least) and similarity(own, sketches[i]) >= SIMILAR for i, n in shared.items()):
            continue
        for v in least:
            index.setdefault((y, v), []).append(len(sketches))
        sketches.append(own)
        kept.append((y, h))
    return kept


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Shared part of two texts' runs of words, by their sketches."""
    both = np.union1d(a, b)
    if max(len(a), len(b)) == SKETCH:
        both = both[:SKETCH]
    return len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), both, assume_unique=True)) / len(both)


def lower_bound(toxic: int, n: int) -> float:
    """Least share of toxic documents that is likely (95 %) with ``toxic`` of ``n``."""
    rate, z = toxic / n, 1.96
    return (rate + z * z / (2 * n) - z * math.sqrt(rate * (1 - rate) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def choose(found: list[tuple[int, list[str]]], sure: set[str]) -> set[str]:
    """The entries chosen among sure ones, by the documents (label, sure entries): all whole words, then beginnings one by one."""
    chosen = {w for w in sure if w[-1] == "$"}
    left = [held for y, held in found if y == 1 and chosen.isdisjoint(held)]
    while True:
        gain = Counter(w for held in left for w in held)
        best = min(gain, key=lambda w: (-gain[w], w), default=None)
        if best is None or gain[best] < LEAST_DOCS:
            return chosen
        chosen.add(best)
        left = [held for held in left if best not in held]


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Score of each whole text, 0 to 1; null texts are scored as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for texts in batches:
            yield pd.Series([model.score(t) for t in texts], dtype="float64")

    return F.pandas_udf(scores, T.DoubleType())(F.coalesce(F.col(text).cast("string"), F.lit("")))


def toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """One row per document: key, held_out, score, predicted. Labels of held-out keys are never learned from.

    Empty and null texts get the score of a text without lexicon words. Without labels of both classes the score is
    constant, near 0 without any. Rows that share a key are scored each; other columns are not looked at; an empty
    table gives no rows.
    """
    model = train(docs, labels, id_remainder(F.col("k"), modulus) != held, key=key, text=text)
    scored = docs.select(F.col(key), (id_remainder(F.col(key), modulus) == held).alias("held_out"), score(docs, model, text).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_civil(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0, key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """The documents, all columns, whose score is under 0.5."""
    model = train(docs, labels, id_remainder(F.col("k"), modulus) != held, key=key, text=text)
    return docs.where(score(docs, model, text) < 0.5)

"""How far sources differ from each other and from their language, by in-mapper stripes.

Every task folds whole documents into a table of stripes: (language, term) to the number of documents with the term and its
count in every source. The table is spilled when it holds ``STRIPES`` stripes, as one row per stripe and source, and the spilled
stripes are merged by key. A merged stripe of a term that enough documents have goes once through a second fold, which adds its
share to the divergence of every pair of its sources; a term gives its own divergence from each source directly.

Counts become shares of a thousand million, rounded down: p = 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V)), with V kept
terms in the language and N the sum of the counts of all of them. Arithmetic is on whole numbers and exact for counts up to 10**15.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import saved, slices
from gaugeline.llm.wordcache import portions

SCALE, SMOOTH, LEAST_DOCS = 1_000_000_000, 5, 30
#: Stripes that a task holds before it spills them, and characters of the texts folded at once.
STRIPES, AT_ONCE = 400_000, 8 << 20
#: Sources compared in one matrix; a language with more is cut into pairs of blocks of so many.
BLOCK = 512
#: Matrices that a task holds before it spills them.
MATRICES = 32

SPILLED = "lang string, term string, source string, docs long, count long"
PAIRS = "lang string, source string, other string, value long"

# Bytes: ASCII letters become small ones, all other ASCII parts terms, and bytes of other characters stay.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms_of(texts: pa.StringArray) -> pa.ListArray:
    """The terms of every text: stretches of letters and of characters beyond ASCII, A to Z as a to z."""
    texts = pa.concat_arrays([texts])  # from offset 0
    valid, offsets, data = texts.buffers()
    plain = pa.StringArray.from_buffers(
        len(texts), offsets, pa.py_buffer((data.to_pybytes() if data else b"").translate(_TERMS)), valid, texts.null_count, texts.offset)
    lists = pc.ascii_split_whitespace(plain)
    some = pc.not_equal(pc.binary_length(lists.flatten()), 0)
    kept = np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False)))
    return pa.ListArray.from_arrays(pa.array(kept[lists.offsets.to_numpy()], pa.int32()), lists.flatten().filter(some))


class Stripes:
    """(language, term) to [documents, {source: count}]."""

    def __init__(self):
        self.held: dict[tuple[str, str], list] = {}

    def fold(self, langs: list[str], sources: list[str], texts: list[str]) -> None:
        lists = terms_of(pa.array(texts, pa.string()))
        terms = lists.flatten().dictionary_encode()
        doc = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
        size = max(1, len(terms.dictionary))
        # Once for every document and term, then once for every group and term.
        pair, times = np.unique(doc * size + terms.indices.to_numpy(), return_counts=True)
        groups = {g: i for i, g in enumerate(dict.fromkeys(zip(langs, sources, strict=True)))}
        group_of = np.array([groups[g] for g in zip(langs, sources, strict=True)], "i8")
        key, which = np.unique(group_of[pair // size] * size + pair % size, return_inverse=True)
        docs = np.bincount(which, minlength=len(key)).tolist()
        counts = np.bincount(which, times, len(key)).astype("i8").tolist()
        words, names, held = terms.dictionary.to_pylist(), list(groups), self.held
        for g, t, d, n in zip((key // size).tolist(), (key % size).tolist(), docs, counts, strict=True):
            lang, source = names[g]
            stripe = held.get((lang, words[t]))
            if stripe is None:
                held[lang, words[t]] = [d, {source: n}]
            else:
                stripe[0] += d
                stripe[1][source] = stripe[1].get(source, 0) + n

    def spill(self) -> Iterator[pa.RecordBatch]:
        """One row per stripe and source; a stripe's documents go with its first source."""
        rows = [(*key, source, docs if i == 0 else 0, n) for key, (docs, counts) in self.held.items() for i, (source, n) in enumerate(counts.items())]
        self.held = {}
        for begin in range(0, len(rows), 1 << 16):
            columns = zip(*rows[begin : begin + (1 << 16)], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.string()] * 3 + [pa.int64()] * 2, strict=True)],
                names=["lang", "term", "source", "docs", "count"])


def kept_stripes(docs: DataFrame, least_docs: int = LEAST_DOCS, lang: str = "lang", source: str = "source", text: str = "text",
                 stripes: int = STRIPES) -> DataFrame:
    """(lang, term, counts: array of (source, count)) of the terms that at least ``least_docs`` documents of the language have.

    A task combines its own documents before anything is shuffled, so a frequent term reaches the task that merges it
    once per source and spill. A stripe has one entry per source of its language.
    """
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Stripes()
        for batch in slices(batches, 4096):
            langs, sources, texts = (c.to_pylist() for c in batch.columns)
            begin = 0
            for some in portions(texts, AT_ONCE):
                end = begin + len(some)
                held.fold(langs[begin:end], sources[begin:end], some)
                begin = end
                if len(held.held) >= stripes:
                    yield from held.spill()
        yield from held.spill()

    rows = docs.select(*(_text(docs[c]).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    # One shuffle: both groupings find the rows of a term together.
    merged = (
        rows.mapInArrow(fold, SPILLED).repartition("lang", "term")
        .groupBy("lang", "term", "source").agg(F.sum("docs").alias("docs"), F.sum("count").alias("count"))
        .groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "count")).alias("counts"))
    )
    return merged.where(F.col("docs") >= least_docs).drop("docs")


def _text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def share(count: str, n: str, v: str) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (n + SMOOTH * v)), exactly."""
    return F.expr(f"1 + cast({count} + {SMOOTH} as decimal(19, 0)) * {SCALE} div cast({n} + {SMOOTH} * {v} as decimal(19, 0))")


def shares(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The same of arrays; SCALE is multiplied in by thousands, so that no product leaves 64 bits."""
    left, out = counts + SMOOTH, np.zeros(np.broadcast_shapes(counts.shape, whole.shape), "i8")
    digit = left // whole
    left = left - digit * whole
    out += digit
    for _ in range(3):
        left = left * 1000
        digit = left // whole
        left = left - digit * whole
        out = out * 1000 + digit
    return out + 1


class Divergences:
    """(language, block, block) to the sums of |p - q| over the stripes met, for every source of one block and of the other."""

    def __init__(self, block: int = BLOCK):
        self.block, self.sums = block, {}
        self.langs: dict[str, tuple[list[str], dict[str, int], np.ndarray]] = {}

    def fold(self, batch: pa.RecordBatch) -> None:
        """Rows: lang, first, second (blocks), sources and n of the language, v, counts (null: nothing is added)."""
        langs, first, second = (batch.column(i).to_pylist() for i in range(3))
        rows: dict[tuple, list[int]] = {}
        for i, key in enumerate(zip(langs, first, second, strict=True)):
            rows.setdefault(key, []).append(i)
            if key[0] not in self.langs:
                names = batch.column(3)[i].as_py()
                whole = np.array(batch.column(4)[i].as_py(), "i8") + SMOOTH * batch.column(5)[i].as_py()
                self.langs[key[0]] = names, {s: j for j, s in enumerate(names)}, whole
        for key, some in rows.items():
            names, _, _ = self.langs[key[0]]
            a, b = (range(k * self.block, min(len(names), (k + 1) * self.block)) for k in key[1:])
            sums = self.sums.setdefault(key, np.zeros((len(a), len(b)), "i8"))
            step = max(1, (1 << 20) // len(names))
            for begin in range(0, len(some), step):
                self._add(sums, key[0], a, b, batch.column(6).take(pa.array(some[begin : begin + step])).drop_null())

    def _add(self, sums: np.ndarray, lang: str, a: range, b: range, stripes: pa.Array) -> None:
        if not len(stripes):
            return
        names, number, whole = self.langs[lang]
        entries, offsets = stripes.flatten(), stripes.offsets.to_numpy()
        of = entries.field(0).dictionary_encode()
        at = np.array([number[s] for s in of.dictionary.to_pylist()], "i8")[of.indices.to_numpy()]
        counts = np.zeros((len(stripes), len(names)), "i8")
        counts[np.repeat(np.arange(len(stripes)), np.diff(offsets)), at] = entries.field(1).to_numpy()
        p = shares(counts, whole[None, :])
        other = p[:, b.start : b.stop]
        for i, j in enumerate(a):
            sums[i] += np.abs(other - p[:, j : j + 1]).sum(0)

    def spill(self) -> Iterator[pa.RecordBatch]:
        """Each pair of sources in both orders."""
        for (lang, first, second), sums in self.sums.items():
            names = self.langs[lang][0]
            a, b = names[first * self.block :][: len(sums)], names[second * self.block :][: sums.shape[1]]
            for i, source in enumerate(a):
                for one, two in ([(source, b)] if first == second else [(source, b), (b, source)]):
                    keep = np.array([x != source for x in b])
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * int(keep.sum()), pa.string()),
                        *(pa.array([x] * int(keep.sum()) if isinstance(x, str) else [y for y in x if y != source], pa.string()) for x in (one, two)),
                        pa.array(sums[i][keep]),
                    ], names=["lang", "source", "other", "value"])
        self.sums, self.langs = {}, {}


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = 50, lang: str = "lang", source: str = "source",
                      text: str = "text", stripes: int = STRIPES, block: int = BLOCK, matrices: int = MATRICES) -> DataFrame:
    """lang, source, part, item, value, rank: how each source differs from the others of its language, and by which terms.

    Part ``pair``: item is another source, value the sum over all kept terms of the two shares' difference; all of them, which
    is the square of the number of sources of a language, as asked. Part ``term``: item is a kept
    term whose share in the source is above its share in the language, value the excess; the ``top_terms`` largest. Ranks go by value
    from the largest, ties by item. Null languages, sources and texts count as empty; repeated rows count as
    documents of their own; documents without terms still make their source occur; with no kept terms all pairs have value 0. An empty
    table gives no rows. Other columns, whatever their names, are left behind.
    """
    kept = saved(kept_stripes(docs, least_docs, lang, source, text, stripes), "stripes")
    found = docs.select(_text(docs[lang]).alias("lang"), _text(docs[source]).alias("source")).distinct()
    totals = kept.select("lang", F.inline("counts")).groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = saved(found.join(totals, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n")), "groups")
    # One row per language: its sources in order, their totals, and the number of kept terms.
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"))
    each = groups.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("g"), F.sum("n").alias("whole"))
    langs = saved(each.join(sizes, "lang", "left").select(
        "lang", F.col("g.source").alias("sources"), F.col("g.n").alias("n"), "whole", F.coalesce("v", F.lit(0)).alias("v")), "languages")
    return ranked(pair_values(kept, langs, block, matrices), "pair", "other", None).unionByName(
        ranked(term_values(kept, groups, langs), "term", "term", top_terms))


def pair_values(kept: DataFrame, langs: DataFrame, block: int = BLOCK, matrices: int = MATRICES) -> DataFrame:
    """(lang, source, other, value); each task adds up the stripes it has, and only sums are shuffled."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Divergences(block)
        for batch in slices(batches, 4096):
            held.fold(batch)
            if len(held.sums) >= matrices:
                yield from held.spill()
        yield from held.spill()

    # A language's own row, without counts, gives all its pairs even where no term is kept.
    stripes = kept.select("lang", "counts").unionByName(langs.select("lang", F.lit(None).cast(kept.schema["counts"].dataType).alias("counts")))
    last = F.floor((F.size("sources") - 1) / block).cast("int")
    blocks = (
        stripes.join(langs, "lang").withColumn("first", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("second", F.explode(F.sequence(F.col("first"), last)))
    )
    rows = blocks.select("lang", "first", "second", "sources", "n", "v", "counts")
    return rows.mapInArrow(fold, PAIRS).groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))


def term_values(kept: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, source, term, value) of terms that a source has more of than its language."""
    each = kept.select("lang", "term", F.expr("aggregate(counts, 0L, (s, c) -> s + c.count)").alias("total"), F.inline("counts"))
    both = each.join(groups, ["lang", "source"]).join(langs.select("lang", "whole", "v"), "lang")
    value = share("count", "n", "v") - share("total", "whole", "v")
    return both.select("lang", "source", "term", value.alias("value")).where("value > 0")


def ranked(values: DataFrame, part: str, item: str, most: int | None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), item)
    rows = values.withColumn("rank", F.row_number().over(order))
    rows = rows if most is None else rows.where(F.col("rank") <= most)
    return rows.select("lang", "source", F.lit(part).alias("part"), F.col(item).alias("item"), "value", "rank")

"""Exact BM25 top-k search by block-max pruning over sharded inverted indexes.

Documents are dealt by a hash into shards of about ``SHARD`` documents; each shard's inverted index is one file in the shared
folder: its terms in order and their postings. Documents of the same words are one document of several keys in it; documents with
the same frequent words and of similar length stand together. Document frequencies, document count and mean length are summed
over all shards, so that scores are those of one index. Queries are stored in blocks too.

A task takes one block of queries through a group of shards, in the manner of MaxScore with block maxima. The postings of a
query's rarer words are added up for every document. The frequent words of a shard, which have most of the postings, are a matrix
of weights, with the largest weight in each block of documents beside it; a product of matrices gives what they can add at most
in every block to the scores of every query. Only documents that reach the k-th best score so far with that are scored with all
words; that score is carried on from shard to shard. A document whose bound equals it is scored, so ties are complete. Sums of
single precision only choose documents, with room for rounding; the scores are sums in double precision in order of terms, equal
in all shards for equal texts. The results of the groups are merged by score, then key.

Words are lower-cased (A-Z) and cut at ASCII white space; terms are their 64-bit XXH64 hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeline.llm.common import filesystem, publish, saved, slices
from gaugeline.session import work_folder

K1, B = 1.2, 0.75
TOP = 10
SHARD = 8_192  # documents
BLOCK = 32  # documents of a shard whose largest weights are kept
HEAD = 512  # most frequent terms of a shard, whose weights are a matrix
SPARSE = 64  # a term in less than one document of so many has no place there
ALIKE = 8  # most frequent terms, by which the documents of a shard are put in order
QUERIES = 4096  # queries of a block at most, but for chance
PAIRS = 1 << 20  # terms of all queries of a block at most, but for chance
LEAST = 256  # queries of a block below which it is not made smaller for the sake of more tasks
TOGETHER = 64  # queries of a block whose sums are held at once
GROUP = 64  # shards that one task goes through
ERROR = 1e-4  # more than the relative error of sums of HEAD positive products in single precision
NO_KEY = np.iinfo("i8").max  # stands for a null key; last in ties


def terms(text: str | None) -> np.ndarray:
    """The hashes of the words of a text, repeats included."""
    words = (text or "").encode().lower().split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), "u8", len(words)).view("i8")


def build(keys: np.ndarray, texts: list[str | None]) -> dict[str, np.ndarray]:
    """The inverted index of one shard; documents of the same words are one, with all their keys in order."""
    words, own = [], {}
    for i in np.argsort(keys, kind="stable").tolist():
        found = np.sort(terms(texts[i]))
        at = own.setdefault(found.tobytes(), len(words))
        if at == len(words):
            words.append((found, []))
        words[at][1].append(keys[i])
    length = np.array([len(w) for w, _ in words], "i8")
    doc = np.repeat(np.arange(len(words), dtype="i4"), length)
    term = np.concatenate([w for w, _ in words]) if words else np.zeros(0, "i8")
    place = np.argsort(term, kind="stable")
    term, doc = term[place], doc[place]
    fresh = np.append(True, (term[1:] != term[:-1]) | (doc[1:] != doc[:-1]))[: len(term)]
    starts = np.flatnonzero(fresh)
    tf = np.diff(np.append(starts, len(term)))
    term, doc = term[starts], doc[starts]
    names, first = np.unique(term, return_index=True)
    first = np.append(first, len(term))
    many = np.diff(first)
    # Terms by frequency: the first are the matrix, and what belongs to them lies together.
    often = np.argsort(-many, kind="stable")
    place_of = np.empty(len(names), "i4")
    place_of[often] = np.arange(len(names))
    has = np.zeros((ALIKE, len(words)), bool)
    for i, t in enumerate(often[:ALIKE].tolist()):
        has[i, doc[first[t] : first[t + 1]]] = True
    order = np.lexsort((length, *has[::-1]))
    rank = np.empty(len(words), np.min_scalar_type(len(words)))
    rank[order] = np.arange(len(words))
    keys = [words[i][1] for i in order.tolist()]
    doc, tf = rank[doc], tf.astype(np.min_scalar_type(tf.max(initial=0)))
    # The same postings by document, its terms in order.
    place = np.argsort(doc, kind="stable")
    held = np.repeat(place_of, many)[place]
    return {
        "keys": np.concatenate(keys) if keys else np.zeros(0, "i8"), "copies": np.array(list(map(len, keys)), "i8"), "length": length[order],
        "terms": names, "first": first, "doc": doc, "tf": tf, "often": place_of, "held": held, "times": tf[place]}


def put(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    store, top = filesystem(folder)
    store.create_dir(top, recursive=True)
    own = f"{top}/attempt-{uuid.uuid4().hex}"
    with store.open_output_stream(own) as f:
        np.savez(f, **arrays)
    publish(store, own, f"{top}/{name}")


def get(folder: str, name: str) -> dict[str, np.ndarray]:
    store, top = filesystem(folder)
    with store.open_input_file(f"{top}/{name}") as f, np.load(f) as data:
        return {k: data[k] for k in data.files}


class Queries:
    """A block of queries: the terms of each with their gains, in order."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.keys, self.q = np.unique(arrays["q"], return_inverse=True)
        self.terms, self.number = np.unique(arrays["term"], return_inverse=True)
        self.gain = arrays["gain"]


class Shard:
    """A shard's index with the weights of its frequent terms as a matrix, and their block maxima."""

    def __init__(self, arrays: dict[str, np.ndarray], mean: float):
        self.keys, self.terms, self.first, self.held, self.times = (arrays[k] for k in ("keys", "terms", "first", "held", "times"))
        self.own = np.append(0, np.cumsum(arrays["copies"]))
        self.doc, self.often = arrays["doc"], arrays["often"]
        self.norm = K1 * (1 - B + B * arrays["length"] / mean)
        tf = arrays["tf"].astype("f4")
        self.weight = tf * np.float32(K1 + 1) / (tf + self.norm.astype("f4").take(self.doc))
        self.blocks = -(-len(self.norm) // BLOCK)
        many = np.bincount(self.doc, minlength=self.blocks * BLOCK)
        self.doc_first = np.append(0, np.cumsum(many))
        head = np.flatnonzero((self.often < HEAD) & (np.diff(self.first) * SPARSE >= len(self.norm)))
        posting, which = spread(self.first[head], self.first[head + 1])
        self.heavy = np.zeros((self.blocks * BLOCK, len(head)), "f4")
        self.heavy[self.doc[posting], self.often[head][which]] = self.weight[posting]
        self.most = self.heavy.reshape(self.blocks, BLOCK, len(head)).max(1)
        self.gains, self.asked = np.zeros(len(self.terms)), np.zeros(len(self.terms), bool)

    def search(self, asked: Queries, k: int, best: list[list[tuple[float, int]]]) -> None:
        """Bring ``best``, the best k of each query ((-score, key), sorted), up to this shard's documents."""
        if not len(self.terms):
            return
        at = np.minimum(np.searchsorted(self.terms, asked.terms), len(self.terms) - 1)
        at = np.where(self.terms[at] == asked.terms, at, -1)[asked.number]
        known = np.flatnonzero(at >= 0)
        at, gain, q = at[known], asked.gain[known], asked.q[known]
        begins = np.searchsorted(q, np.arange(len(best) + 1)).tolist()
        slot = self.often[at]
        heavy = slot < self.heavy.shape[1]
        gains = np.zeros((len(best), self.heavy.shape[1]), "f4")
        gains[q[heavy], slot[heavy]] = gain[heavy]
        bounds = (gains @ self.most.T).astype("f8")
        first, last, by = self.first[at[~heavy]], self.first[at[~heavy] + 1], gain[~heavy].astype("f4")
        rare = np.searchsorted(q[~heavy], np.arange(len(best) + 1)).tolist()
        docs = np.arange(self.blocks * BLOCK)
        # Queries of the same best block together, as they open much the same blocks.
        order = np.argsort(bounds.argmax(1), kind="stable").tolist()
        for begin in range(0, len(best), TOGETHER):
            wide, sums, opened = [], [], np.zeros(self.blocks, bool)
            for i in order[begin : begin + TOGETHER]:
                own = slice(rare[i], rare[i + 1])
                size = last[own] - first[own]
                posting = ranges(first[own], size)
                weight = self.weight.take(posting)
                weight *= np.repeat(by[own], size)
                row = np.bincount(self.doc.take(posting), weight, len(docs))
                least = -best[i][-1][0] if len(best[i]) == k else 0.0
                reach = row.reshape(self.blocks, BLOCK) + bounds[i][:, None] >= least * (1 - ERROR)
                open_ = np.flatnonzero(reach)
                if len(open_) * 16 > len(docs):
                    wide.append(i)
                    sums.append(row)
                    opened |= reach.any(1)
                elif len(open_):
                    about = row[open_] + self.heavy[open_] @ gains[i]
                    own = slice(begins[i], begins[i + 1])
                    best[i] = self.score(open_, about, slot[own], gain[own], k, least, best[i])
            if wide:
                # All blocks that one of these queries opens, for all of them at once.
                some = docs.reshape(self.blocks, BLOCK)[opened].ravel()
                heads = gains[wide] @ self.heavy.reshape(self.blocks, BLOCK, -1)[opened].reshape(len(some), -1).T
                for i, row, head in zip(wide, sums, heads, strict=True):
                    least = -best[i][-1][0] if len(best[i]) == k else 0.0
                    own = slice(begins[i], begins[i + 1])
                    best[i] = self.score(some, row[some] + head, slot[own], gain[own], k, least, best[i])

    def score(
        self, docs: np.ndarray, about: np.ndarray, slot: np.ndarray, gain: np.ndarray, k: int, least: float, best: list[tuple[float, int]],
    ) -> list[tuple[float, int]]:
        """The best k of ``best`` and these documents, whose scores are ``about`` but for rounding; exact scores under ``least`` do not count."""
        keep = np.flatnonzero(about >= least * (1 - ERROR) if least else about > 0)
        if len(keep) > k:
            keep = keep[about[keep] >= np.partition(about[keep], -k)[-k] * (1 - ERROR)]
        docs = docs[keep]
        if not len(docs):
            return best
        begin, end = self.doc_first[docs], self.doc_first[docs + 1]
        own = [slice(a, b) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        # Few terms of a document are the query's, and flags stay in the processor's cache.
        self.asked[slot] = True
        held = np.concatenate([self.held[x] for x in own])
        found = np.flatnonzero(self.asked.take(held))
        self.asked[slot] = False
        self.gains[slot] = gain
        member = np.repeat(np.arange(len(docs)), end - begin)[found]
        part = weights(np.concatenate([self.times[x] for x in own])[found], self.norm[docs[member]]) * self.gains[held[found]]
        # Added up one after another in order of terms.
        scores = np.bincount(member, part, len(docs))
        hits = np.flatnonzero((scores > 0) & (scores >= least))
        if not len(hits):
            return best
        if len(hits) > k:
            hits = hits[scores[hits] >= np.partition(scores[hits], -k)[-k]]
        member, which = spread(self.own[docs[hits]], np.minimum(self.own[docs[hits] + 1], self.own[docs[hits]] + k))
        scores, keys = scores[hits][which], self.keys[member]
        first = np.lexsort((keys, -scores))[:k]
        return sorted(best + list(zip((-scores[first]).tolist(), keys[first].tolist(), strict=True)))[:k]


def weights(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    tf = tf.astype("f8")
    return tf * (K1 + 1) / (tf + norm)


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges from ``begin`` on, one after another."""
    numbers = np.repeat(begin - np.cumsum(size) + size, size)
    numbers += np.arange(len(numbers))
    return numbers


def spread(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges begin..end, one after another, and the range each is of."""
    return ranges(begin, end - begin), np.repeat(np.arange(len(begin)), end - begin)


def parts(queries: int, pairs: int, shards: int, cores: int) -> tuple[int, int]:
    """Blocks of queries and groups of shards: each block reads each shard, so blocks are large once there are tasks for every core."""
    groups = -(-shards // GROUP)
    return max(1, -(-queries // QUERIES), -(-pairs // PAIRS), min(-(-2 * cores // groups), queries // LEAST)), groups


def search(docs: DataFrame, queries: DataFrame, k: int = TOP, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(query_id, rank, doc_id, score): for each query the k documents of highest BM25 score over 0.

    ``queries`` has the same key and text columns; a query's words count as often as they occur in it. Ties go by key, null
    keys last; equal scores of equal keys (repeated rows) take a rank each. Null texts have no words and neither find nor
    are found; queries with null keys are left out, those that share a key are searched as one with all their words. Empty tables give no rows.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "bm25")
    n = docs.count()
    shards = max(1, -(-n // SHARD))

    def index(keys: tuple, group: pa.Table) -> pa.Table:
        ids = np.array([NO_KEY if x is None else x for x in group.column("k").to_pylist()], "i8")
        arrays = build(ids, group.column("t").to_pylist())
        number = keys[0].as_py()
        put(folder, f"shard-{number}", arrays)
        return pa.table({"shard": pa.array([number], pa.int32()), "docs": [len(ids)], "words": [int(arrays["length"] @ arrays["copies"])]})

    dealt = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("k", "t", F.monotonically_increasing_id()), F.lit(shards)).cast("int"))
    made = saved(dealt.groupBy("shard").applyInArrow(index, "shard int, docs long, words long"), "bm25-shards")
    facts = made.agg(F.sum("docs"), F.sum("words")).head()
    total, mean = facts[0] or 0, (facts[1] or 0) / max(1, facts[0] or 0) or 1.0

    def query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            for q, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                names, times = np.unique(terms(t), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(names), q, "i8")), pa.array(names), pa.array(times)], names=["q", "term", "times"])

    asked = queries.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t")).where("k is not null")
    asked = saved(
        asked.mapInArrow(query_terms, "q long, term long, times long").groupBy("q", "term").agg(F.sum("times").alias("times")), "bm25-queries")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                arrays = get(folder, f"shard-{number}")
                found = np.add.reduceat(arrays["copies"][arrays["doc"]], arrays["first"][:-1]) if len(arrays["terms"]) else np.zeros(0, "i8")
                yield pa.RecordBatch.from_arrays([pa.array(arrays["terms"]), pa.array(found)], names=["term", "df"])

    numbers = made.select("shard").repartition(max(1, min(shards, 1000)), "shard")
    wanted = asked.select("term").distinct()
    df = numbers.mapInArrow(frequencies, "term long, df long").join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    # A query's number within its block, by key.
    n_asked, pairs = asked.agg(F.count_distinct("q"), F.count("q")).head()
    blocks, groups = parts(n_asked, pairs, shards, spark.sparkContext.defaultParallelism)
    # Spark cannot know how many rows the files give, and would broadcast them.
    weighed = asked.join(df.hint("merge"), "term").withColumn("block", F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int"))

    def store(keys: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("q", "ascending"), ("term", "ascending")])
        q, term, times, found = (group.column(c).to_numpy() for c in ("q", "term", "times", "df"))
        idf = np.log(1 + (total - found + 0.5) / (found + 0.5))
        put(folder, f"queries-{keys[0].as_py()}", {"q": q, "term": term, "gain": idf * times})
        return pa.table({"block": pa.array([keys[0].as_py()], pa.int32())})

    stored = saved(weighed.groupBy("block").applyInArrow(store, "block int"), "bm25-blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.to_pylist():
                block = Queries(get(folder, f"queries-{task['block']}"))
                best: list[list] = [[] for _ in block.keys]
                for number in task["shards"]:
                    Shard(get(folder, f"shard-{number}"), mean).search(block, k, best)
                rows = [(int(q), key if key != NO_KEY else None, -s) for q, own in zip(block.keys, best, strict=True) for s, key in own]
                yield pa.RecordBatch.from_arrays([
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.float64())], names=["query_id", "doc_id", "score"])

    # One row per pair of a query block and a group of shards: the queries are searched in blocks.
    lists = made.groupBy((F.col("shard") % groups).alias("g")).agg(F.sort_array(F.collect_list("shard")).alias("shards"))
    tasks = stored.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).join(lists, "g").select("block", "shards")
    found = tasks.repartition(max(1, min(blocks * groups, 20_000)), "block", "shards").mapInArrow(run, "query_id long, doc_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")

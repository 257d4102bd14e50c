"""Mixing, SimHash, vector links, WARC packages and BM25 against plain Python on small tables."""

import base64
import hashlib
import io
import math
import random
import zipfile
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gaugeline.llm import bm25, embedding_links, mixing, simhash, warc_zip
from gaugeline.llm.components import connected_components
from gaugeline.session import work_folder


def closure(n, links):
    least = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    return least


# --- mixing ---------------------------------------------------------------------------


def targets_by_rounds(sizes, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] >= 3 * sizes[s]}
        for s in above:
            target[s] = 3 * sizes[s]
        left -= sum(3 * sizes[s] for s in above)
        open_ -= above
        if not above:
            return target | share
    return target


def test_mixing_odd_documents(odd):
    rows = mixing.mix(odd).collect()
    sources = {r.doc_id: r.source for r in odd.collect()}
    assert len(rows) == 10
    sizes = defaultdict(int)
    for r in rows:
        sizes[sources[r.doc_id]] += r.size
    want = targets_by_rounds(sizes)
    for r in rows:
        assert r.source_size == sizes[sources[r.doc_id]]
        assert r.target == pytest.approx(want[sources[r.doc_id]])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3


def test_mixed_documents_are_the_counted_ones(odd, documents):
    for docs in (odd, documents):
        counts = mixing.mix(docs).agg(F.sum("copies")).head()[0]
        mixed = mixing.mixed_documents(docs)
        assert mixed.count() == counts and mixed.columns == docs.columns


def test_mixing_ends_near_targets(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(1 + id % 7 as int))").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 11)).alias("source"))
    rows = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) <= 4 for r in rows)


def test_mixing_nothing(nothing):
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0


# --- SimHash --------------------------------------------------------------------------


def fingerprint_by_bits(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(documents, odd):
    for docs in (documents, odd):
        for r in docs.select("text", simhash.fingerprint(F.col("text")).alias("fp")).collect():
            assert r.fp % 2**64 == fingerprint_by_bits(r.text)


def scattered(n, seed=5):
    """Random fingerprints, with chains and dense groups around some of them."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(n)}
    for center in list(out)[: n // 10]:
        for _ in range(rng.choice([1, 3, 60])):
            x = center
            for _ in range(rng.randint(1, 5)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
            center = rng.choice([center, x])
    return np.array(sorted(out), "u8")


@pytest.mark.parametrize(("leaf", "most"), [(1000, 50_000), (40, 25)])
def test_trees_lose_no_link(spark, leaf, most):
    prints = scattered(800)
    links = [(i, j) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints[:i]) <= 4)]
    want = closure(len(prints), links)
    df = spark.createDataFrame([(int(x),) for x in prints.view("i8")], "fp long")
    place = {int(x): i for i, x in enumerate(prints.view("i8"))}
    found = {place[r.v]: r.root for r in simhash.linked_fingerprints(df, leaf=leaf, most=most).collect()}
    groups = defaultdict(set)
    for i in range(len(prints)):
        groups[found.get(i, ("alone", i))].add(i)
    expected = defaultdict(set)
    for i, w in enumerate(want):
        expected[w].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_forest_is_a_forest():
    prints = scattered(300, 9)
    a, b = simhash.forest(prints)
    links = [(i, j) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints[:i]) <= 4)]
    assert len(a) == len(prints) - len(set(closure(len(prints), links)))
    assert len(b) == len(a)


def test_near_duplicates_of_odd_documents(odd, nothing):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == 10
    by_key = {r.doc_id: r for r in rows}
    assert by_key[6].component_id == 5 and by_key[5].component_id == 5
    assert by_key[7].component_id == by_key[8].component_id == 7 and by_key[7].fp == 0
    assert by_key[None].component_id is None
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


def test_one_of_each_group_stays(odd):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 5, 7, 20, 40, 60, 80]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 400)] + [(rng.randrange(500, 700), rng.randrange(500, 700)) for _ in range(90)]
    rng.shuffle(links)
    found = {r.v: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = closure(700, links)
    assert found == {v: want[v] for a, b in links if a != b for v in (a, b)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- vectors --------------------------------------------------------------------------


@pytest.mark.parametrize(("leaf", "most", "dims"), [(4096, 16_384, 64), (60, 16_384, 64), (50, 40, 24), (50, 16_384, 3)])
def test_vector_links(spark, leaf, most, dims):
    rng = np.random.default_rng(dims)
    base = rng.normal(size=(260, dims)).astype("f4")
    near = np.concatenate([base[:20] + rng.normal(scale=s, size=(20, dims)).astype("f4") for s in (0.05, 0.2, 0.3, 0.33)])
    group = (base[30] + rng.normal(scale=0.15, size=(80, dims))).astype("f4")
    x = np.concatenate([base, near, group, base[:5], base[5:8] * 3])
    rows = [(i, v.tolist(), i) for i, v in enumerate(x)]
    odd = [None, [], [0.0] * dims, [float("nan")] + [1.0] * (dims - 1), [float("inf")] + [1.0] * (dims - 1), [None] + [1.0] * (dims - 1)]
    rows += [(1000 + i, v, 0) for i, v in enumerate(odd)] + [(None, x[0].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    found = {r.vec_id: r for r in embedding_links.linked_vectors(df, leaf=leaf, most=most).collect()}
    u = x.astype("f8")
    u /= np.linalg.norm(u, axis=1)[:, None]
    linked = u @ u.T >= 0.95
    np.fill_diagonal(linked, False)
    want = closure(len(x), list(zip(*np.nonzero(linked), strict=True)))
    for i in range(len(x)):
        extra = int(i == 0 or linked[i, 0])  # the row without a key is a copy of the first
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (linked[i].sum() + extra, want[i], want[i] == i)
    for i in range(len(odd)):
        assert (found[1000 + i].n_links, found[1000 + i].component_id, found[1000 + i].kept) == (0, 1000 + i, True)
    assert found[None].component_id == want[0] and not found[None].kept
    assert embedding_links.linked_vectors(df.where("false")).count() == 0


# --- WARC -----------------------------------------------------------------------------


def test_packages_round_trip(spark):
    rows = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, None), (4, "http://a/\n4", ""), (5, "u", "ü" * 70_000),
            (2, "http://a/2", "same"), (None, "u", "same"), (None, "u", "lonely"), (9, "u", "HTTP\r\n\r\nlike")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("k", F.lit(1)).withColumn("n", F.lit(2)).repartition(2)
    folder = work_folder(spark, "warc")
    packages = warc_zip.write_packages(pages, folder)
    found = warc_zip.read_packages(packages, folder).collect()
    assert Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in found) == Counter(
        (k, kind, to, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode())
        for (k, _, h), (kind, to) in zip(rows, [
            ("revisit", 2), ("response", None), ("revisit", 4), ("response", None), ("response", None), ("response", None),
            ("revisit", 2), ("response", None), ("response", None)], strict=True))
    assert all((r.payload is None) == (r.record_type == "revisit") for r in found)
    with zipfile.ZipFile(packages.head().path) as z:  # the standard library agrees
        assert z.testzip() is None and set(z.namelist()) == {warc_zip.ARCHIVE, warc_zip.INDEX}
    empty = work_folder(spark, "warc")
    assert warc_zip.read_packages(warc_zip.write_packages(pages.where("false"), empty), empty).count() == 0


def test_zip64_directory_is_read():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for i in range(66_000):  # more members than the short form can count
            z.writestr(zipfile.ZipInfo(f"m{i}"), b"x" * (i % 3))
        z.comment = b"a comment after the end record"
    data = out.getvalue()
    found = warc_zip.members(lambda n, at: data[at : at + n], len(data))
    assert len(found) == 66_000
    at, n = found["m65999"]
    assert data[at : at + n] == b"x" * (65_999 % 3)
    extra = b"\x01\x00\x18\x00" + (7).to_bytes(8, "little") + (8).to_bytes(8, "little") + (9).to_bytes(8, "little")
    assert warc_zip.wide(extra, 0xFFFFFFFF, 0xFFFFFFFF, 0xFFFFFFFF) == (8, 9)


def test_one_page_is_fetched_alone(spark, documents):
    pages = documents.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html")).coalesce(1)
    path = warc_zip.write_packages(pages, work_folder(spark, "warc")).head().path
    data, ranges = open(path, "rb").read(), []

    def read_at(n, at):
        ranges.append(n)
        return data[at : at + n]

    key = pages.orderBy(F.length("html").desc()).head().page_id
    [[row]] = warc_zip.records(read_at, len(data), {key})
    assert row["page_id"] == key and sum(ranges) < len(data)


# --- BM25 -----------------------------------------------------------------------------


def brute(docs, asked, k):
    words = [(key, Counter((t or "").encode().lower().split())) for key, t in docs]
    mean = sum(sum(c.values()) for _, c in words) / len(words)
    df = Counter(w for _, c in words for w in c)
    out = {}
    for q, t in asked:
        query, hits = Counter((t or "").encode().lower().split()), []
        for key, c in words:
            dl = sum(c.values())
            s = sum(n * math.log(1 + (len(words) - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * dl / mean))
                    for w, n in query.items() if w in c)
            if s > 0:
                hits.append((-round(s, 6), math.inf if key is None else key))
        out[q] = sorted(hits)[:k]
    return out


def test_bm25_is_exact(documents, monkeypatch):
    monkeypatch.setattr(bm25, "SHARD", 40)
    monkeypatch.setattr(bm25, "GROUP", 2)
    rows = bm25.search(documents, documents.where("doc_id % 20 = 0")).collect()
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    want = brute(docs, [d for d in docs if d[0] % 20 == 0], 10)
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["rank"]):
        found[r.query_id].append((-round(r.score, 6), r.doc_id))
    assert {q: [s for s, _ in h] for q, h in found.items()} == {q: [s for s, _ in h] for q, h in want.items() if h}
    assert {q: h for q, h in found.items()} == {q: h for q, h in want.items() if h}


def test_bm25_in_several_blocks_and_groups(documents, monkeypatch):
    asked = documents.where("doc_id % 20 = 0")
    want = {tuple(r) for r in bm25.search(documents, asked).collect()}
    monkeypatch.setattr(bm25, "SHARD", 40)
    monkeypatch.setattr(bm25, "GROUP", 2)
    monkeypatch.setattr(bm25, "LEAST", 3)
    assert bm25.parts(10, 1_000, 5, 8) == (3, 3)
    assert {tuple(r) for r in bm25.search(documents, asked).collect()} == want


def test_bm25_reads_shards_in_few_blocks():
    """Every block of queries reads every shard: of many queries blocks are large, of few there are some for every core."""
    assert bm25.parts(154_000, 49_000_000, 376, 6) == (47, 6)
    assert bm25.parts(12_821, 4_116_000, 32, 6) == (12, 1)
    assert bm25.parts(0, 0, 1, 8) == bm25.parts(300, 9_000, 1, 8) == (1, 1)
    assert bm25.parts(5_000, 50_000_000, 1, 1) == (48, 1)


def test_bm25_of_odd_documents(odd, nothing):
    rows = bm25.search(odd, odd.where("doc_id % 20 = 0 or doc_id = 5"), k=3).collect()
    own = {r.query_id: (r.doc_id, r.score) for r in rows if r["rank"] == 1}
    assert own[40][0] == 40 and own[60][0] == 60 and own[5][0] == 5 and own[20][0] == 20
    assert [(r.doc_id, r["rank"]) for r in sorted(rows, key=lambda r: r["rank"]) if r.query_id == 5] == [(5, 1), (5, 2), (6, 3)]
    assert bm25.search(nothing, nothing).count() == 0
    assert bm25.search(odd, nothing).count() == 0


def test_bm25_of_long_queries_opens_few_postings(monkeypatch):
    """Whole documents as queries, with copies and edited copies: few of their postings are read, and the best are those of brute force."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    chances = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, chances, k=rng.randint(100, 300)))) for i in range(600)]
    for i in range(0, 600, 20):
        own = docs[i][1].split()
        docs += [(1000 + 20 * i + j, " ".join(own[:-1] if j % 2 else own)) for j in range(14)]
    docs += [(9000, None), (9001, ""), (bm25.NO_KEY, docs[0][1])]
    asked = docs[:600:20]
    arrays = bm25.build(np.array([k for k, _ in docs]), [t for _, t in docs])
    assert arrays["copies"].sum() == len(docs) and arrays["copies"].max() == 9
    frequency = dict(zip(arrays["terms"].tolist(), np.add.reduceat(arrays["copies"][arrays["doc"]], arrays["first"][:-1]).tolist(), strict=True))
    block = {"q": [], "term": [], "gain": []}
    for key, text in asked:
        for t, times in zip(*np.unique(bm25.terms(text), return_counts=True), strict=True):
            df = frequency[int(t)]
            block["q"].append(key), block["term"].append(t), block["gain"].append(times * math.log(1 + (len(docs) - df + 0.5) / (df + 0.5)))
    queries = bm25.Queries({k: np.array(v) for k, v in block.items()})
    shard = bm25.Shard(arrays, arrays["length"] @ arrays["copies"] / len(docs))
    best = [[] for _ in queries.keys]
    shard.search(queries, 10, best)
    want = brute(docs, asked, 10)
    assert {q: [(round(s, 6), k) for s, k in b] for q, b in zip(queries.keys.tolist(), best, strict=True)} == want
    # With the best known, as after other shards, the postings of frequent terms are left alone.
    scored = []
    monkeypatch.setattr(bm25.Shard, "score", lambda self, some, about, *a, f=bm25.Shard.score: scored.append(len(some)) or f(self, some, about, *a))
    known = [list(b) for b in best]
    shard.search(queries, 10, [list(b) for b in best])
    assert known == best and sum(scored) < len(asked) * len(docs) / 8


def test_bm25_without_frequent_terms_or_words():
    """A shard whose terms are all rare has no matrix, and one without words finds nothing."""
    texts = [f"a{i} b{i // 2}" for i in range(400)]
    arrays = bm25.build(np.arange(400), texts)
    q = np.unique(bm25.terms(texts[7]))
    queries = bm25.Queries({"q": np.zeros(2, "i8"), "term": q, "gain": np.ones(2)})
    best = [[]]
    shard = bm25.Shard(arrays, 2.0)
    shard.search(queries, 10, best)
    assert shard.heavy.shape[1] == 0 and [k for _, k in best[0]] == [7, 6]
    best = [[]]
    bm25.Shard(bm25.build(np.array([1, 2]), [None, " "]), 1.0).search(queries, 10, best)
    assert best == [[]]

"""Periodic runs against a search of all periods at all places, and the query's digests worked out word by word."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeline.llm import periodic_runs
from gaugeline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def runs_by_search(words, times=4, least=6):
    found = []
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            end = i
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end - i + q >= max(least, times * q) and end > i and not any(
                    q % p == 0 and s <= i and end + q <= s + n for s, n, p in found):
                found.append((i, end - i + q, q))
            i = max(end, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


WORDS = st.lists(st.sampled_from("abc"), max_size=12).flatmap(
    lambda w: st.tuples(st.lists(st.sampled_from("ab"), max_size=6), st.just(w), st.integers(1, 9), st.lists(st.sampled_from("abcd"), max_size=9)))


@settings(max_examples=400, deadline=None)
@given(docs=st.lists(WORDS, max_size=4), times=st.sampled_from([2, 3, 4]))
def test_runs_are_those_of_a_search(docs, times):
    docs = [a + w * n + z for a, w, n, z in docs]
    n, n_runs, runs, kept = periodic_runs.search([" ".join(d) for d in docs], times, 6)
    want = [runs_by_search(d, times) for d in docs]
    assert n.tolist() == list(map(len, docs)) and n_runs.tolist() == list(map(len, want))
    assert [tuple(r) for r in runs.tolist()] == [r for d in want for r in d]
    assert kept.to_pylist() == [collapsed(d, r) for d, r in zip(docs, want, strict=True)]


def test_suffixes_are_sorted():
    rng = np.random.default_rng(0)
    for _ in range(50):
        sizes = rng.integers(0, 12, 3)
        words = np.concatenate([10 * i + rng.integers(0, 2, n) for i, n in enumerate(sizes)])
        upto = np.append(0, np.cumsum(sizes))
        ends = np.repeat(upto[1:], sizes)
        if not len(words):
            continue
        order, levels = periodic_runs.suffix_array(words, ends)
        texts = [tuple(words[i : ends[i]]) for i in range(len(words))]
        assert [texts[i] for i in order] == sorted(texts)
        lcp = periodic_runs.common_prefixes(order, levels, ends)
        for k in range(1, len(order)):
            a, b = texts[order[k - 1]], texts[order[k]]
            assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("words", [["a"] * 60_000, ["a", "b"] * 30_000, [str(i % 977) for i in range(60_000)]])
def test_long_repetitions_are_one_run(words):
    _, _, runs, kept = periodic_runs.search([" ".join(words)])
    q = len(set(words))
    assert runs.tolist() == [[0, len(words), q]] and kept.to_pylist() == [" ".join(words[:q])]


def test_odd_documents(odd, nothing):
    rows = periodic_runs.periodic_runs(odd).collect()
    texts = sorted((r.text or "" for r in odd.collect()))
    assert len(rows) == 10 and sorted(r.n_words for r in rows) == sorted(len(re.findall("[^\\x20\\x09-\\x0D]+", t)) for t in texts)
    by_key = {r.key: r for r in rows}
    assert [tuple(r) for r in by_key[60].runs] == [(0, 6000, 1)] and by_key[60].collapsed == "word \u2581last"
    assert by_key[7].collapsed == by_key[8].collapsed == "" and by_key[7].runs == []
    assert by_key[20].collapsed == "spaced out text \xa0 end" and by_key[None].n_words == 6
    assert sum(r.key == 5 for r in rows) == 2
    assert periodic_runs.periodic_runs(nothing).count() == 0


def test_query_against_a_search(spark):
    """Every column of the query, worked out from the tables in plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    some = random.Random(3).sample(docs, 60) + [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 10 == 0]
    for d in some:
        words = re.findall("[^\\x20\\x09-\\x0D]+", d.text or "")
        h, n = zlib.crc32(str(d.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 3000:
            continue
        runs = runs_by_search(words)
        r = got[d.doc_id]
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert sum(r.n_runs > 0 for r in got.values()) > 5

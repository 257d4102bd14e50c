"""Pattern packing: the fit's optimality, whole pieces, and few sequences."""

import zlib
from collections import defaultdict
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gaugeline.llm import pattern_packing as pp
from gaugeline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize(("units", "most"), [(1, 1), (7, 3), (12, 4), (64, 2)])
def test_patterns_are_all_there_are(units, most):
    want = {tuple(sorted(c, reverse=True)) for m in range(1, most + 1) for c in combinations_with_replacement(range(1, units + 1), m) if sum(c) == units}
    got = pp.patterns_of(units, most)
    assert len(got) == len(set(got)) and set(got) == want


@settings(max_examples=150, deadline=None)
@given(seed=st.integers(0, 10**6), rows=st.integers(1, 8), columns=st.integers(1, 20), whole=st.booleans())
def test_least_squares_meet_their_conditions(seed, rows, columns, whole):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 3, (rows, columns)).astype("f8") if whole else rng.normal(size=(rows, columns))
    b = rng.normal(size=rows) * 10
    x = pp.nnls(a, b)
    gradient = a.T @ (a @ x - b)
    assert (x >= 0).all() and gradient.min() > -1e-6 and np.abs(gradient[x > 1e-9]).max(initial=0) < 1e-6


def test_least_squares_of_nothing_and_of_copies():
    assert pp.nnls(np.ones((3, 4)), np.zeros(3)).tolist() == [0] * 4
    a = np.ones((2, 3))
    assert np.isclose((a @ pp.nnls(a, np.array([2.0, 2.0]))), 2).all()
    assert (pp.nnls(np.array([[1.0], [0.0]]), np.array([-1.0, 5.0])) == 0).all()


def check(lengths, where, offset, rooms, window):
    filled = defaultdict(list)
    for n, w, o in zip(lengths.tolist(), where.tolist(), offset.tolist(), strict=True):
        filled[w].append((o, n))
    assert sorted(filled) == list(range(len(rooms)))
    for w, some in filled.items():
        at = 0
        for o, n in sorted(some):
            assert o == at
            at += n
        assert at + rooms[w] == window and rooms[w] >= 0


@settings(max_examples=200, deadline=None)
@given(lengths=st.lists(st.integers(1, 64), max_size=90), units=st.sampled_from([1, 4, 16, 64]))
def test_any_lengths_are_packed(lengths, units):
    lengths = np.array(lengths, "i8")
    check(lengths, *pp.pack_by_patterns(lengths, 64, units), 64)


def by_first_fit(lengths, window):
    rooms = []
    for n in sorted(lengths, reverse=True):
        i = next((i for i, r in enumerate(rooms) if r >= n), None)
        if i is None:
            rooms.append(window - n)
        else:
            rooms[i] -= n
    return len(rooms)


@pytest.mark.parametrize("name", ["uniform", "large", "same", "short", "halves", "triples"])
def test_sequences_are_few(name):
    rng = np.random.default_rng(0)
    lengths = {
        "uniform": rng.integers(1, 4097, 1500), "large": rng.integers(1500, 4097, 900), "same": np.full(900, 1300),
        "short": rng.integers(1, 200, 8000), "halves": np.concatenate([x := rng.integers(1, 4096, 500), 4096 - x]),
        "triples": np.concatenate([y := rng.integers(1, 1300, 400), z := rng.integers(1, 1300, 400), 4096 - y - z])}[name]
    where, offset, rooms = pp.pack_by_patterns(lengths)
    check(lengths, where, offset, rooms, 4096)
    assert len(rooms) <= 1.005 * by_first_fit(lengths.tolist(), 4096) + 1
    if name == "short":
        assert len(rooms) == -(-lengths.sum() // 4096)


def held(rows, docs, window, end=1):
    """The rows are the whole documents' ids, each once, in pieces of the window; returns sequences and their least number."""
    encoder = Tokenizer.from_file(WORD)
    want = defaultdict(list)
    for key, text in docs:
        ids = [*encoder.encode(text or "", add_special_tokens=False).ids, end]
        for i in range(0, len(ids), window):
            want[key].append((i // window, i, zlib.crc32(np.array(ids[i : i + window], "<u4").tobytes()), len(ids[i : i + window])))
    got = defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["piece"], r["start"], r["ids_crc32"], r["length"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for some in sequences.values():
        at = 0
        for o, n in sorted(some):
            assert o == at
            at += n
        assert at <= window
    return len(sequences), -(-sum(r["length"] for r in rows) // window)


@pytest.mark.parametrize(("group", "parts"), [(1, 1), (3000, 3), (1 << 20, 5)])
def test_packing_keeps_every_id_once(odd, group, parts):
    from pyspark.sql import functions as F

    rows = pp.pack_documents(odd.repartition(parts), WORD, 1, 512, group_tokens=group).withColumn("ids_crc32", F.crc32("ids")).collect()
    n, least = held(rows, [(r.doc_id, r.text) for r in odd.collect()], 512)
    # 12,000 tokens: no group leaves more than the windows it may open again.
    assert group == 1 or n <= least + 2
    filled = defaultdict(int)
    for r in rows:
        filled[r.sequence_id] += r.length
    assert all(r.room == 512 - filled[r.sequence_id] for r in rows)


def test_packing_nothing(nothing):
    assert pp.pack_documents(nothing, WORD, 1).count() == 0


def test_query_has_every_id_once(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = QUERIES["op11_pattern_packing"](spark, SF).collect()
    n, least = held(rows, docs, 4096)
    assert n <= least + 1
    many = QUERIES["op11_pattern_packing"](spark, SF)
    assert many.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

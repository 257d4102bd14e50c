"""Token counts, records and packing against the tokenizers' own results on whole texts."""

import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gaugeline.llm import packing, token_counts, token_records
from gaugeline.llm.packing import OpenWindows, best_fit_decreasing, padding_of
from gaugeline.llm.token_records import frame, masked, unframe
from gaugeline.llm.wordcache import AFTER, LONGEST, MARKS, WordEncoder
from gaugeline.session import work_folder

BYTE, WORD, PIECE = map(public_tokenizers.path, ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
TEXTS = st.text(st.one_of(st.sampled_from(" \n\t .,'<|>aAéß1x#"), st.characters(codec="utf-8")), max_size=60)


def ids_of(path, text, end):
    return [*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, end]


@pytest.fixture(scope="module")
def encoders():
    return {spaces: WordEncoder(open(path, encoding="utf-8").read(), spaces) for path, spaces in ((BYTE, True), (WORD, False))}


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(TEXTS, max_size=4))
def test_cached_words_give_the_ids_of_the_whole_text(encoders, texts):
    for encoder in encoders.values():
        assert encoder.encode(texts) == [encoder.whole(t) if t else b"" for t in texts]


def test_punctuation_after_any_character_gives_the_ids_of_the_whole_text(encoders):
    """Every assigned character before every mark; of the large uniform blocks, every character before one mark."""
    words = []
    for c in map(chr, range(0x21, 0x110000)):
        kind = unicodedata.category(c)
        if kind in ("Cn", "Cs", "Co"):
            continue
        uniform = 0x3400 <= ord(c) < 0xD7B0 or ord(c) >= 0x17000
        words += [f"b{c}{m}" for m in (AFTER[ord(c) % len(AFTER)] if uniform else AFTER)]
    words += ["TAKS\u0130.", "\u0958.", "\u0130!?", "a\u0130.b\u0130."]
    for encoder in encoders.values():
        for begin in range(0, len(words), 20_000):
            some = words[begin : begin + 20_000]
            want = [np.array(e.ids, encoder.dtype).tobytes() for e in encoder.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            got = encoder.encode(some)
            assert [w for w, a, b in zip(some, got, want, strict=True) if a != b] == []


def test_texts_are_cut_at_lone_spaces_only(encoders):
    long = "ab " * 70 + "x" * 500
    texts = ["a  b c", "a \n b c d", " a b ", "a\u3000 b c", "a b\t c d", "", None, " ", "  ", "".join(MARKS), "a\x01 b c", long,
             "a <|endoftext|> b", "a <|endoftext|>b  c", "word\nnext one", "a b  " * 50]
    for encoder in encoders.values():
        assert encoder.encode(texts) == [encoder.whole(t) if t else b"" for t in texts]
        assert encoder.encode(["".join(MARKS) + " a", "b c"]) == [encoder.whole("".join(MARKS) + " a"), encoder.whole("b c")]


@settings(max_examples=200, deadline=None)
@given(text=TEXTS)
def test_cached_counts_are_those_of_the_whole_text(text):
    counter = test_cached_counts_are_those_of_the_whole_text.__dict__.setdefault(
        "counter", token_counts.PieceCounter(open(PIECE, "rb").read(), {"a": 1}))
    assert counter.counts([text, None]) == [counter.whole(text) if text else 0, 0]


def test_token_counts(odd, nothing):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    rows = token_counts.token_counts(odd, PIECE).select("text", "n_tokens").collect()
    assert len(rows) == 10
    assert all(r.n_tokens == (len(model.encode(r.text)) if r.text else 0) for r in rows)
    assert token_counts.token_counts(nothing, PIECE).count() == 0
    few = token_counts.token_counts(odd, PIECE, sample_rows=1, frequent=1).agg(F.sum("n_tokens")).head()[0]
    assert few == sum(r.n_tokens for r in rows)


def test_frequent_words_are_those_of_all_rows(spark):
    """Far more rows and words than a sample held, in few tasks; rare words, odd white space and NULs count too."""
    rng = np.random.default_rng(5)
    texts = [f"once{i}" for i in range(300)]
    texts += [" ".join(f"w{n}" for n in rng.zipf(1.3, 40) if n < 9000) for _ in range(2000)]
    texts += ["late\0word  twice", "late\0word\t twice", "long" * 20, "", None, *["often"] * 500]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(2)
    want = Counter(w for t in texts if t for w in t.split(" ") if w and len(w) <= LONGEST and "  " not in t and "\t" not in t)
    pieces = ["late\0word  twice", "late\0word\t twice"]
    want.update(pieces)
    model = open(PIECE, "rb").read()
    counter = token_counts.PieceCounter(model, {})
    for size in (50, 2500, 1 << 16):
        best = sorted(want, key=lambda w: (-want[w], w.encode()))[:size]
        assert len(best) == min(size, len(want)) and len(want) > 2500
        assert token_counts.unpack(token_counts.frequent_words(docs, model, size=size)) == {w: counter.whole(w) for w in best}


@pytest.mark.parametrize("held", [0, 3_000, 1 << 30])
def test_words_are_counted_in_bounded_memory(held):
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.randint(0, 30))) or None for _ in range(1500)]
    batches = [pa.record_batch({"t": pa.array(texts[a : a + 700], pa.string())}) for a in range(0, 1500, 700)]
    given = Counter()
    for batch in token_counts.word_counts(iter(batches), held):
        for word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            given[word] += n
    assert given == Counter(w for t in texts if t for w in t.split(" "))
    assert list(token_counts.word_counts(iter([]), held)) == []


def test_packed_words_come_back():
    table = {"a": 1, "b\0c": 40_000, "日本": 2, "\U0001f600": 3}
    assert token_counts.unpack(token_counts.pack(table)) == table and token_counts.unpack(token_counts.pack({})) == {}


@pytest.mark.parametrize("seed", [None, 3])
def test_records_round_trip(spark, odd, seed):
    folder = work_folder(spark, "records")
    manifest = token_records.write_records(odd, folder, BYTE, end_id=0)
    rows = sorted(token_records.read_records(manifest, folder, seed).collect(), key=lambda r: r.before)
    keys = [r.doc_id for r in rows]
    assert keys == [None, 5, 5, 6, 7, 8, 20, 40, 60, 80]
    texts = {r.doc_id: r.text for r in odd.collect()}
    at = 0
    for r in rows:
        want = ids_of(BYTE, texts[r.doc_id], 0)
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want) and r.before == at
        at += len(want)


def test_records_of_nothing(spark, nothing):
    folder = work_folder(spark, "records")
    assert token_records.read_records(token_records.write_records(nothing, folder, BYTE, 0), folder).count() == 0


def test_damaged_records_are_refused():
    good = frame(7, np.array([1, 2, 3], "<u2").tobytes(), 2)
    assert unframe(good)[0] == 7 and unframe(good)[1].tolist() == [1, 2, 3]
    assert unframe(frame(None, b"", 2))[0] is None
    for i in range(len(good)):
        broken = bytearray(good)
        broken[i] ^= 1
        with pytest.raises((ValueError, Exception)):
            unframe(bytes(broken))
    assert masked(b"") == 0xA282EAD8


@settings(max_examples=100, deadline=None)
@given(lengths=st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_takes_the_tightest_window(lengths):
    where, offset, used = best_fit_decreasing(np.array(lengths, "i8"), 64)
    room: list[int] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [r for r in room if r >= lengths[i]]
        assert 64 - offset[i] == (min(fits) if fits else 64)
        if fits:
            room.remove(min(fits))
        room.append(64 - offset[i] - lengths[i])
    assert used == len(room) and all(0 <= w < used for w in where)


def test_open_windows_may_be_empty():
    windows = OpenWindows(8)
    assert windows.tightest(1) is None
    windows.put(8, 1)
    assert windows.tightest(8) == (8, 1) and windows.tightest(1) is None


def test_padding_stops_at_powers_of_two():
    assert padding_of(np.array([1, 3, 64, 100, 128]), 128).tolist() == [0, 125, 0, 28, 0]


@pytest.mark.parametrize("group", [1, 1 << 20])
def test_packing_keeps_every_id_once(odd, group):
    rows = packing.pack_documents(odd.coalesce(1), WORD, 1, group_tokens=group).collect()
    texts = {r.doc_id: r.text for r in odd.collect()}
    for key, text in texts.items():
        own = sorted((r for r in rows if r.doc_id == key), key=lambda r: r.start)
        ids = ids_of(WORD, text, 1)
        copies = 2 if key == 5 else 1
        assert sorted(i for r in own for i in np.frombuffer(r.ids, "<u4")) == sorted(ids * copies)
        assert all(np.frombuffer(r.ids, "<u4").tolist() == ids[r.start : r.start + r.length] for r in own)
        assert all(r.doc_tokens == len(ids) for r in own)
    for sequence in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == sequence), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048


def test_packing_nothing(nothing):
    assert packing.pack_documents(nothing, WORD, 1).count() == 0


def test_crc_of_ids_is_sparks(odd):
    row = packing.pack_documents(odd.where("doc_id = 40"), WORD, 1).select("ids", F.crc32("ids").alias("c")).head()
    assert row.c == zlib.crc32(bytes(row.ids))

"""Quality and toxicity: held-out accuracy, odd input, and what each step gives."""

import sys
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.mark.parametrize(("run", "label", "least"), [(quality.quality, "quality", 0.97), (toxicity.toxicity, "toxic", 0.93)])
def test_held_out_accuracy(tables, run, label, least):
    docs, labels = tables
    rows = run(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = [r["predicted"] == r[label] for r in rows]
    assert len(right) > 50 and sum(right) / len(right) >= least
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    if label == "toxic":
        assert not any(r.predicted and not r.toxic for r in rows)


@pytest.mark.parametrize("run", [quality.quality, toxicity.toxicity])
def test_odd_documents_are_scored(odd, nothing, tables, spark, run):
    _, labels = tables
    rows = run(odd, labels).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    assert run(nothing, labels).count() == 0
    one_class = spark.createDataFrame([(5, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    bad = spark.createDataFrame([(5, None, 7), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for known in (labels.where("false"), one_class, bad):
        kept = [r.predicted for r in run(odd, known).collect()]
        assert set(kept) == {1 if run is quality.quality else 0}


def test_stages_keep_columns(odd, tables):
    _, labels = tables
    assert quality.keep_good(odd, labels.where("false")).columns == odd.columns
    assert toxicity.keep_civil(odd, labels.where("false")).count() == 10


def test_passages_cover_the_whole_text():
    assert len(quality.passages("w " * 640)) == 10 and len(quality.passages("w " * 641)) == 11
    assert len(quality.passages(None)) == len(quality.passages(" \n")) == 1
    clean, junk = "Plain words in a row. " * 40, "junk### more$$$ of%%% it&&& " * 20
    a, b = quality.passages(clean + junk)[:, : quality.SHAPES], quality.passages(clean)[:, : quality.SHAPES]
    assert np.abs(a[0] - b[0]).sum() < 1e-6 and np.abs(a[-1] - b[-1]).sum() > 0.5


def test_long_words_are_read_to_their_end():
    a, b = quality.passages("a" * 17_000), quality.passages("a" * 5_000 + "!a" * 6_000)
    assert len(a) == -(-17_000 // 64 // 64) and np.abs(a[0] - b[0]).max() < 1e-6 and np.abs(a[-1] - b[-1]).max() > 0.5
    runs = [quality.SHAPE_OF[quality.words_of(w.translate(quality.CLASSES))[0]] for w in (b"a1" * 9, b"a1" * 8 + b"a!")]
    assert runs[0] != runs[1]


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(2)
    bags = [rng.normal(size=(n, quality.FEATURES)) for n in (1, 3, 5, 2)]
    x, begins, y = np.concatenate(bags), np.array([0, 1, 4, 9]), np.array([1.0, 0, 1, 0])
    shapes = {"W": (quality.FEATURES, quality.HIDDEN), "b": (quality.HIDDEN,), "V": (quality.HIDDEN, quality.GATES),
              "U": (quality.HIDDEN, quality.GATES), "a": (quality.GATES,), "u": (quality.HIDDEN,), "c": (1,)}
    model = quality.Model({k: rng.normal(0, 0.3, s) for k, s in shapes.items()})

    def loss():
        p = model.forward(x, begins)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, grad in model.gradients(x, begins, y).items():
        w = model.weights[name]
        for at in [tuple(rng.integers(0, n) for n in w.shape) for _ in range(12)]:
            w[at] += 1e-5
            up = loss()
            w[at] -= 2e-5
            down = loss()
            w[at] += 1e-5
            assert abs((up - down) / 2e-5 - grad[at]) < 1e-6, name


def test_sample_is_bounded_by_rows_and_passages(spark, tables):
    docs = spark.createDataFrame([(1, f"text {i} " * 70, 1) for i in range(50)] + [(2, "x! " * 100_000, 0), (3, "bad## " * 9, 0)],
                                 "doc_id long, text string, quality int")
    seen = []
    fit = quality.fit
    quality.fit = lambda bags, y: seen.append(bags) or fit(bags, y, steps=2)
    try:
        quality.train(docs, docs, F.lit(True), rows=20, passages_held=30)
    finally:
        quality.fit = fit
    assert len(seen[0]) <= 20 and 20 < sum(map(len, seen[0])) <= 30 or len(seen[0]) == 20


def test_attention_finds_the_bad_passage():
    rng = np.random.default_rng(0)
    bags, y = [], []
    for i in range(300):
        bag = rng.normal(0, 0.1, (rng.integers(2, 9), quality.FEATURES)).astype("f4")
        if i % 2:
            bag[rng.integers(len(bag)), 3] += 2
        bags.append(bag)
        y.append(1 - i % 2)
    model = quality.fit(bags[:200], np.array(y[:200], "f8"))
    assert ((model.scores(bags[200:]) >= 0.5) == np.array(y[200:], bool)).mean() > 0.95
    bag = bags[201]
    assert model.forward(bag, np.array([0]))["alpha"].argmax() == bag[:, 3].argmax()


HIDDEN = {
    "1d10t": "idiot", "s t u p i d": "stupid", "s.t.u.p.i.d": "stupid", "stuuuupid": "stupid", "$tup1d": "stupid", "l0$er": "loser",
    "m0r0n": "moron", "tr@sh": "trash", "path3t1c": "pathetic", "w0rthl3ss": "worthless", "cl0wn": "clown", "idi*ot": "idiot",
    "m-o-r-o-n": "moron", "t r 4 s h": "trash", "stup!d": "stupid"}


def test_hidden_words_are_restored(tables):
    model = toxicity.letter_model(tables[0])
    for hidden, word in HIDDEN.items():
        assert word in toxicity.restored_words(f"you are {hidden} of the", model), hidden
    assert toxicity.restored_words("the of and in a to it is by", model) == set()


PHRASES = {
    "such a s t u p i d": "a stupid", "y o u i d i o t": "you idiot", "you.idi0t": "you idiot", "y.o.u a.r.e s.t.u.p.i.d": "are stupid",
    "such a m-o-r-o-n": "a moron", "i a m n o t s t u p i d": "not stupid", "t h e i d i o t": "the idiot", "a l o s e r": "a loser",
    "such.a.m0r0n": "such moron", "idi0t-m0r0n": "idiot moron"}


def test_hidden_words_are_parted(tables):
    model = toxicity.train(*tables, F.lit(True))
    for hidden, words in PHRASES.items():
        assert set(words.split()) <= toxicity.restored_words(hidden, model.letters), hidden
    for hidden in ("such a s t u p i d", "y o u i d i o t", "you.idi0t"):
        assert model.score(hidden) >= 0.5, hidden
    assert toxicity.restored_words("x" * 3 + " well-known", model.letters) >= {"well", "known"}


def test_spans_of_any_length_and_language_are_read(tables):
    model = toxicity.letter_model(tables[0])
    for hidden, word in {
            "s t u p i d " * 8: "stupid", "stu" + "u" * 45 + "pid": "stupid", "i.d.i.o.t." * 6 + "x": "idiot", "(10wn": "clown",
            "m0r0n!!!!": "moron", "motherfuck3r": "motherfucker", "caf-é": "café", "d-é-b-i-l-e": "débile", "d é b i l e": "débile",
            "débi1e": "débile", "d3bílé": "debílé", "débiiiile": "débile", "id-----iot": "idiot", "ééé é": "é"}.items():
        assert word in toxicity.restored_words(hidden, model), hidden
    assert toxicity.restored_words("f****r", model) and toxicity.restored_words("motherfuck3", model)


@pytest.mark.parametrize("text", ["1" * 200_000 + "a", "a1" * 20_000, "a " * 10_000, "1 " * 5_000, "a*" * 100 + "*" * 300 + "b", "x" * 200_000, "-." * 100_000])
def test_long_spans_take_linear_time(text):
    model = toxicity.LetterModel(toxicity.count_letters("plain words of some text"))
    begun = time.monotonic()
    toxicity.restored_words(text, model)
    assert time.monotonic() - begun < 20


def test_hidden_toxic_words_are_scored(tables):
    docs, labels = tables
    model = toxicity.train(docs, labels, F.lit(True))
    for hidden in HIDDEN:
        assert model.score(f"Is and that {hidden} to the of. This") >= 0.5, hidden
    for clean in ("", None, "The and is of. It to.", "Call 555-0100 or mail a1@b2.example, 3 of 4 (50%)", "a b c d e f g"):
        assert model.score(clean) < 0.5


def test_copies_do_not_crowd_words_out(spark):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 8)) for _ in range(2_600)]
    toxic = [" ".join(words[:2_400]) + f" {words[2_400 + i]}" for i in range(40)] + [
        " ".join(rng.choice(words[2_450:], 12)) + " grobian" for _ in range(30)]
    clean = [" ".join(rng.choice(words, 40)) for _ in range(60)]
    rows = [(i, t, int(i < len(toxic))) for i, t in enumerate(toxic + clean)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(docs, docs, F.lit(True))
    assert "grobian$" in model.weights and model.score("one two grobian three") >= 0.5
    assert words[0] + "$" not in model.weights


def test_only_similar_texts_are_copies():
    long = [f"w{i}" for i in range(400)]
    near, passage = long[:200] + ["x"] + long[201:], long[:100] + [f"v{i}" for i in range(300)]
    texts = [long, near, passage, long[:20], long[:20] + ["y"], long[:10] + ["z"]]
    found = [(1, i, toxicity.sketch(" ".join(t))) for i, t in enumerate(texts)]
    assert toxicity.one_of_copies(found) == [(1, 0), (1, 2), (1, 3), (1, 5)]
    assert toxicity.one_of_copies([(0, 9, found[0][2]), *found])[:2] == [(0, 9), (1, 0)]


def test_letter_counts_are_whole():
    text = "aab é a"
    s = [0, 0, 1, 1, 2, 0, 27, 27, 0, 1, 0, 0]
    want = Counter(zip(s, s[1:], s[2:], strict=False))
    got = toxicity.count_letters(text).reshape(28, 28, 28)
    assert {tuple(map(int, i)): int(got[tuple(i)]) for i in np.argwhere(got)} == want


def test_pipeline_stages(spark):
    sys.path.insert(0, str(Path(__file__).parents[2]))
    import corpus_pipeline
    from gaugeline.llm import simhash

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scores = {r.doc_id: r.predicted for r in quality.quality(docs, labels).collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf).persist()
        ids, before = Counter(r.doc_id for r in out.collect()), Counter(r.doc_id for r in docs.collect())
        assert out.columns == docs.columns and set(ids) <= set(before)
        if name == "quality":
            assert set(ids) == {k for k, p in scores.items() if p}
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity.toxicity(docs, labels).collect() if r.predicted}
            assert set(ids) == set(before) - bad
        if name == "simhash":
            assert set(ids) == {r.component_id for r in simhash.near_duplicates(docs).collect()} and max(ids.values()) == 1
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf).groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("d")).collect()
    assert all(r.n == r.d * ids[r.doc_id] for r in pieces) and len(pieces) == len(ids)

"""Source divergences against plain counting, with tiny stripes and blocks, and odd documents."""

import re
from collections import Counter
from fractions import Fraction
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.llm import source_divergence as sd

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("lang", "source", "text")] + [
    T.StructField(n, T.LongType()) for n in ("doc_id", "term", "docs", "count", "n", "v", "value")])


def by_counting(rows, least_docs, top):
    """All result rows from (lang, source, text), by fractions."""
    rows = [tuple(x or "" for x in r) for r in rows]
    out = []
    for lang in {r[0] for r in rows}:
        docs = [(s, re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))) for la, s, t in rows if la == lang]
        df = Counter(t for _, terms in docs for t in set(terms))
        kept = {t for t, n in df.items() if n >= least_docs}
        counts = {s: Counter() for s, _ in docs}
        for s, terms in docs:
            counts[s].update(t for t in terms if t in kept)
        whole = sum(counts.values(), Counter())

        def p(c, t, kept=kept):
            return 1 + floor(Fraction(10**9 * (c[t] + 5), sum(c.values()) + 5 * len(kept)))

        for s, c in counts.items():
            pairs = [(o, sum(abs(p(c, t) - p(d, t)) for t in kept)) for o, d in counts.items() if o != s]
            terms = [(t, p(c, t) - p(whole, t)) for t in kept if c[t] and p(c, t) > p(whole, t)]
            for part, values, most in (("pair", pairs, None), ("term", terms, top)):
                values.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(values[:most])]
    return sorted(out)


def made(seed, n):
    rng = np.random.default_rng(seed)
    words = ["The", "the", "a", "été", "ÉTÉ", "x1y", "don't", "_b", "日本 語", "ab\x7fcd", "\xa0", "Zoë", "İ"]
    return [(str(rng.choice(["en", "fr"])), f"s{rng.integers(5)}", " ".join(rng.choice(words, rng.integers(0, 9)))) for _ in range(n)] + [
        (None, None, None), (None, "x", "the the"), ("en", None, "the"), ("de", "lone", "wort"), ("de", "other", ""), ("en", "empty", "123"),
        ("en", "hot", "the " * 5000)]


@pytest.mark.parametrize(("block", "stripes", "matrices"), [(512, 400_000, 32), (2, 3, 1)])
def test_divergences_are_those_of_counting(spark, block, stripes, matrices):
    rows = made(block, 60)
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6, 7) for r in rows + rows[:7]], SCHEMA).repartition(5)
    got = sorted(map(tuple, sd.source_divergence(df, least_docs=3, top_terms=4, stripes=stripes, block=block, matrices=matrices).collect()))
    assert got == by_counting(rows + rows[:7], 3, 4)
    assert any(r[0] == "de" and r[4] == 0 for r in got)  # no kept terms: pairs all the same


def test_nothing_and_no_terms(spark, nothing, odd):
    empty = spark.createDataFrame([], SCHEMA)
    assert sd.source_divergence(empty).count() == 0
    few = spark.createDataFrame([("a", "s", None, *[0] * 7), ("a", "t", "one two", *[0] * 7)], SCHEMA)
    assert sorted(map(tuple, sd.source_divergence(few).collect())) == [("a", "s", "pair", "t", 0, 1), ("a", "t", "pair", "s", 0, 1)]
    rows = odd.withColumn("lang", F.lit("x"))
    assert sorted(map(tuple, sd.source_divergence(rows, least_docs=2).collect())) == by_counting(rows.select("lang", "source", "text").collect(), 2, 50)


def test_shares_are_exact_beyond_64_bits(spark):
    rng = np.random.default_rng(5)
    counts = np.append(rng.integers(0, 10**15, 300), [0, 1, 10**15])
    whole = counts + rng.integers(1, 10**15, len(counts))
    want = [1 + 10**9 * (c + 5) // (w + 5 * 7) for c, w in zip(counts.tolist(), whole.tolist(), strict=True)]
    assert sd.shares(counts, whole + 35).tolist() == want
    df = spark.createDataFrame([(int(i), int(c), int(w), 7) for i, (c, w) in enumerate(zip(counts, whole, strict=True))], "i long, c long, n long, v long")
    assert [r.p for r in df.orderBy("i").select(sd.share("c", "n", "v").alias("p")).collect()] == want

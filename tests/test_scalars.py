import datetime as dt
import math
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugeline.functions import identity, scalars


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r[1] for r in sorted(df.select("i", fn(F.col("x")).alias("y")).collect())]


def test_parse_value(spark):
    texts = ["1.5", " 2 ", "abc", "", "1d", "2f", "1_0", ".5", "5.", "+3", "0x1.8p3", "0x10",
             "+nan", " 7 ", None]
    want = [1.5, 2.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.5, 5.0, 3.0, 12.0, 0.0, 0.0, 7.0, 0.0]
    assert apply(spark, texts, scalars.parse_value) == want
    nan, inf, minus, large = apply(spark, ["NaN", "inf", "-Infinity", "1e400"], scalars.parse_value)
    assert math.isnan(nan) and inf == large == math.inf and minus == -math.inf


def test_parse_rfc3339(spark):
    at = dt.datetime(2026, 1, 1)
    cases = {
        "2026-01-01T00:00:00Z": at,
        "2026-01-01T00:00:00.123456789Z": at.replace(microsecond=123456),
        "2026-01-01T05:30:00+05:30": at,
        "2026-01-01T5:00:00,5Z": at.replace(hour=5, microsecond=500000),
        "2026-01-01T00:00:00-20:30": at.replace(hour=20, minute=30),
        "2026-01-01T00:00:00+25:00": None,
        "2026-01-01": None,
        "2026-01-01 00:00:00": None,
        "2026-01-01T00:00:00": None,
        "2026-02-30T00:00:00Z": None,
        "2026-01-01T24:00:00Z": None,
        "not": None,
    }
    got = apply(spark, list(cases), lambda c: scalars.parse_rfc3339(c).cast("timestamp_ntz"))
    assert got == list(cases.values())


def test_format_rfc3339nano(spark):
    times = ["2026-01-01 10:20:00", "2026-01-01 00:00:00.5", "2026-01-01 00:00:00.000001", None]
    want = ["2026-01-01T10:20:00Z", "2026-01-01T00:00:00.5Z", "2026-01-01T00:00:00.000001Z", ""]
    assert apply(spark, times, lambda c: scalars.format_rfc3339nano(c.cast("timestamp"))) == want


def test_format_float(spark):
    values = [42949672960.0, 0.0, -5.0, 1e-7, -2.5e-9, 1e21, 1e40, 123456789.125, 0.001,
              1.7976931348623157e308, float("inf"), float("-inf"), float("nan"), -0.0]
    texts = apply(spark, values, scalars.format_float, "double")
    assert texts[:5] == ["42949672960", "0", "-5", "0.0000001", "-0.0000000025"]
    assert texts[5:9] == ["1" + "0" * 21, "1" + "0" * 40, "123456789.125", "0.001"]
    assert texts[9] == "17976931348623157" + "0" * 292
    assert texts[10:] == ["+Inf", "-Inf", "NaN", "-0"]


def test_format_float_reads_back(spark):
    values = [(-1) ** i * (i + 0.1) * 10.0 ** (i * 7 % 600 - 300) for i in range(1, 300)]
    assert [float(t) for t in apply(spark, values, scalars.format_float, "double")] == values


def test_format_float_is_shortest(spark):
    """100,000 doubles of random bits and the ends of the range, against Python's shortest digits."""
    patterns = np.random.default_rng(11).integers(0, 2**64, 100_000, "u8")
    tiny = np.random.default_rng(12).integers(0, 2**52, 5_000, "u8") >> np.random.default_rng(13).integers(0, 52, 5_000, "u8")
    powers = np.array([2.0**e for e in range(-1074, 1024)] + [float(f"{d}e{e}") for d in (1, 2, 9) for e in range(-320, 308)])
    edges = np.array([2.0**-44, 2e23, 1e23, 8.41e21, 5e-324, 9.999999999999999e22, 9007199254740993.0, -2.2250738585072011e-308])
    values = np.concatenate([patterns.view("f8"), tiny.view("f8"), powers, -powers, edges])
    values = values[np.isfinite(values)]
    df = spark.createDataFrame(pd.DataFrame({"i": range(len(values)), "v": values}))
    got = df.select("i", scalars.format_float(F.col("v")).alias("t")).toPandas().sort_values("i")["t"].tolist()

    def plain(v):
        text = format(Decimal(repr(v)), "f")
        return text.removesuffix(".0") if "." in text else text

    wrong = [(v, t, plain(v)) for v, t in zip(values.tolist(), got, strict=True) if t != plain(v)]
    assert wrong == []


def test_fnv1a(spark):
    texts = ["", "a", "foobar", "GPU-5fd4f087-86f3-7a43-b711-4771313afc50", "é✓"]
    assert apply(spark, texts, identity.fnv1a32) == [0x811C9DC5, 0xE40C292C, 0xBF9CF968, 0x567BEE22, 0xE111CB24]
    assert apply(spark, texts, identity.fnv1a_partition) == [197, 44, 104, 34, 36]


def test_fnv1a_brute_force(spark):
    texts = [chr(32 + i) * (i % 7) + f"id-{i}" + ("ü" if i % 3 else "") for i in range(90)]

    def plain(text):
        h = 2166136261
        for b in text.encode():
            h = (h ^ b) * 16777619 % 2**32
        return h % 10

    assert apply(spark, texts, lambda c: identity.fnv1a_partition(c, 10)) == [plain(t) for t in texts]


def test_canonical_uuid(spark):
    u = "550e8400-e29b-41d4-a716-446655440001"
    texts = [u, u.upper(), f"urn:uuid:{u}", f"{{{u}}}", u.replace("-", ""), "", "u1", u[:-1] + "g", None]
    assert apply(spark, texts, identity.canonical_uuid) == [u] * 5 + [None] * 4


def test_parse_range(spark):
    texts = ["85-169", "0--1", "x-1", "7", "1-2-3", " 1-2", None]
    got = apply(spark, texts, lambda c: scalars.parse_range(c, 9, 10))
    assert [tuple(r) for r in got] == [(85, 169), (0, -1)] + [(9, 10)] * 5


def test_null_if_empty_and_default_value(spark):
    df = spark.createDataFrame(
        [("", "", "", "", None)], "uuid string, gpu_id string, metric_name string, pod string, value double"
    )
    row = scalars.default_value(scalars.null_if_empty(df)).first()
    assert (row.uuid, row.pod, row.gpu_id, row.metric_name, row.value) == (None, None, "", "", 0.0)


def test_trim_fields(spark):
    df = spark.createDataFrame([("　a b\t", None)], "pod string, device string")
    assert tuple(scalars.trim_fields(df).first()) == ("a b", "")


def test_msg_uuid(spark):
    df = spark.range(50)
    keyed = identity.assign_msg_uuid(df, ["id"])
    assert keyed.exceptAll(identity.assign_msg_uuid(df, ["id"])).isEmpty()
    assert keyed.select("msg_uuid").distinct().count() == 50
    fresh = [r.msg_uuid for r in identity.assign_msg_uuid(df).collect()]
    assert len(set(fresh)) == 50
    two = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert identity.assign_msg_uuid(two, ["x", "y"]).select("msg_uuid").distinct().count() == 2


@pytest.mark.parametrize("at", [None, "2026-01-01 00:00:00"])
def test_stamp(spark, at):
    df = spark.range(3).withColumn("timestamp", F.lit(None).cast("timestamp"))
    stamped = scalars.stamp_processed_at(df, F.lit(at).cast("timestamp") if at else None)
    times = {r.timestamp for r in stamped.collect()}
    assert len(times) == 1 and None not in times

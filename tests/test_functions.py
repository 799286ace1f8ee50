"""Scalar expressions against Python's own string and time semantics."""

from __future__ import annotations

import io
from datetime import datetime, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from geoscribe.functions import text as gt
from geoscribe.functions.time import local_hour_from_epoch_ms

PROBES = ["", " ", "a", "a b", "a  b", " a", "a ", "  ", "é ü 😀", "x\ty", "tab\t", "ends\n", " nbsp ",
          "mixed \t\n\r\x0b\x0c\x1c  ", "Σίσυφος ΟΔΟΣ", "a\nb\r\nc\rd", "line\n\n", "\n"]


def _eval(spark, exprs, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [tuple(r) for r in df.select(*[e("s") for e in exprs]).collect()]


def test_split_rstrip_lower_match_python(spark):
    exprs = [lambda c: gt.words(c), lambda c: gt.rstrip(c), lambda c: gt.lower_words(c),
             lambda c: gt.split_literal(c, "\t"), lambda c: gt.lines(c)]
    rows = _eval(spark, exprs, PROBES)
    for v, (w, rs, lw, tabs, lines) in zip(PROBES, rows):
        assert w == v.split(" ")
        assert rs == v.rstrip()
        assert lw == [t.lower() for t in v.split(" ")]
        assert tabs == v.split("\t")
        assert lines == [ln.rstrip("\n") for ln in io.StringIO(v, newline=None).readlines()]


def test_query_word_list(spark):
    df = spark.createDataFrame([("The cat THE  dog the \t ",)], "s string")
    assert df.select(gt.query_word_list("s")).first()[0] == ["the", "cat", "", "dog"]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab \t Éé")), max_size=8), min_size=1, max_size=5))
def test_words_and_rstrip_property(spark, values):
    rows = _eval(spark, [lambda c: gt.words(c), lambda c: gt.rstrip(c)], values)
    assert [(v.split(" "), v.rstrip()) for v in values] == [(list(a), b) for a, b in rows]


@pytest.mark.parametrize("ms,off", [(1443600000000, 0), (1443600000000, -39600), (1443571140000, 50400),
                                    (0, -3600), (1443600123456, 19800), (-5000, 0)])
def test_local_hour(spark, ms, off):
    df = spark.createDataFrame([(ms, off)], "ms long, off int")
    got = df.select(local_hour_from_epoch_ms("ms", "off")).first()[0]
    assert got == datetime.fromtimestamp(ms / 1000 + off, tz=timezone.utc).hour


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(allow_nan=True, allow_infinity=True).filter(lambda v: not 1e16 <= abs(v) < 1e20),
                min_size=1, max_size=60))
def test_python_float_text_matches_repr(spark, values):
    from geoscribe.functions.text import python_float_text

    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(python_float_text("v")).collect()]
    assert got == [repr(v) for v in values]


def test_python_float_text_examples(spark):
    from geoscribe.functions.text import python_float_text

    vals = [3.197180310001877e-10, 87.20140983681473, -54.87555556, 1e-05, 0.0001, 12345678.0, 1e16, -0.0, 5e-324]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    assert [r[0] for r in df.select(python_float_text("v")).collect()] == [repr(v) for v in vals]


def test_float_text_stays_out_of_generated_code(spark):
    df = spark.createDataFrame([(0.1, 1e-7)], "a double, b double")
    text = df.select(gt.python_float_text("a").alias("a"), gt.python_float_text("b").alias("b"))
    code = text._jdf.queryExecution().debug().codegenToSeq().mkString(" ")
    assert len(code) < 60_000
    assert tuple(text.first()) == ("0.1", "1e-07")


def test_float_text_over_all_magnitudes(spark):
    """Python's own text, over random bit patterns, integral doubles of 1e16..1e19 and short decimals."""
    import math
    import random
    import struct

    import pandas as pd

    rng = random.Random(9)
    bits = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(8_000)]
    xs = [v for v in bits if math.isfinite(v) and not 1e19 < abs(v) < 1e30]
    xs += [rng.choice([-1, 1]) * float(rng.randrange(10 ** 16, 10 ** 19)) for _ in range(8_000)]
    xs += [float(10 ** k + d) for k in range(15, 19) for d in (-1, 0, 1, 5, 50, 64, 100)] + [2.0 ** k for k in range(-60, 64)]
    xs += [rng.uniform(-180, 180) for _ in range(2_000)] + [round(rng.uniform(-180, 180), rng.randrange(8)) for _ in range(2_000)]
    xs += [5e-324, 1.5e-323, 2e-44, 9.999999999999999e22, 1e16, 9999999999999998.0, 0.0001, 0.00001, 0.0, -0.0, 1e22, 123456.0]
    df = spark.createDataFrame(pd.DataFrame({"x": xs}))
    got = df.select("x", gt.python_float_text("x").alias("t")).collect()
    wrong = [(r.x, r.t) for r in got if r.t != repr(r.x)]
    assert wrong == []
    odd = spark.sql("select * from values (double('nan')), (double('inf')), (double('-inf')), (null) as t(x)")
    assert [r.t for r in odd.select(gt.python_float_text("x").alias("t")).collect()] == ["nan", "inf", "-inf", None]

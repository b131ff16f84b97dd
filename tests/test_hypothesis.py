"""Property tests: column expressions against NumPy / Python on random batches.
Each example is a whole batch of cases in one DataFrame (one Spark job)."""

from __future__ import annotations

import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from imagelake.functions import tensors as D
from imagelake.operators.enrich import percent_2
from imagelake.operators.validate import decode_outcome

SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))

shapes = st.tuples(st.integers(1, 6), st.integers(1, 6), st.sampled_from([1, 3, 4]))
pictures = shapes.flatmap(lambda s: st.tuples(st.just(s), st.lists(
    st.integers(0, 255), min_size=s[0] * s[1] * s[2], max_size=s[0] * s[1] * s[2])))


def _df(spark, pics):
    rows = [(i, h, w, c, [float(v) for v in px]) for i, ((h, w, c), px) in enumerate(pics)]
    return spark.createDataFrame(rows, "id int, height int, width int, n_channels int, pixels array<double>")


@SETTINGS
@given(st.lists(pictures, min_size=1, max_size=25), st.integers(1, 7), st.integers(1, 7))
def test_picture_expressions_match_numpy(spark, pics, oh, ow):
    df = _df(spark, pics)
    out = df.select("id", D.flip_h("pixels", "height", "width", "n_channels").alias("flip"),
                    D.resize_nearest("pixels", "height", "width", "n_channels", oh, ow).alias("small"),
                    D.to_rgb("pixels", "height", "width", "n_channels").alias("rgb")).collect()
    for r in out:
        (h, w, c), px = pics[r.id]
        img = np.array(px, dtype=float).reshape(h, w, c)
        assert np.array_equal(np.array(r.flip).reshape(h, w, c), img[:, ::-1])
        ys, xs = (np.arange(oh) * h) // oh, (np.arange(ow) * w) // ow
        assert np.array_equal(np.array(r.small).reshape(oh, ow, c), img[ys][:, xs])
        want = np.repeat(img, 3, axis=2) if c == 1 else img[:, :, 2::-1]
        assert np.array_equal(np.array(r.rgb).reshape(h, w, 3), want)


names = st.text(alphabet="abcdefghijklmnopqrstuvwxyz ", min_size=1, max_size=12).filter(lambda s: s != "error")
confs = st.floats(min_value=0.0, max_value=1.0, allow_nan=False)


@SETTINGS
@given(st.lists(st.one_of(st.tuples(names, confs), st.tuples(st.just("error"), st.text(max_size=20))),
                min_size=1, max_size=40))
def test_decode_outcome_round_trips(spark, cases):
    texts = [f"{a}|{b!r}" if a != "error" else f"error|{b}" for a, b in cases]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, outcome string")
    for r in decode_outcome(df).collect():
        a, b = cases[r.id]
        if a == "error":
            assert r.fruit is None and r.confidence is None and r.error == b
        else:
            assert r.fruit == a and r.confidence == b and r.error is None


@SETTINGS
@given(st.lists(confs, min_size=1, max_size=40))
def test_percent_matches_python_away_from_ties(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, c double")
    for r in df.select("id", percent_2("c").alias("p")).collect():
        v = values[r.id]
        frac = (v * 10000) % 1
        if abs(frac - 0.5) < 1e-6:
            continue  # exact ties round half up here, half to even in Python
        assert r.p == f"{v:.2%}"


@SETTINGS
@given(st.lists(st.lists(st.floats(-1, 1, allow_nan=False, width=32), min_size=2, max_size=16),
                min_size=1, max_size=20))
def test_variance_and_minmax_match_numpy(spark, vecs):
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "id int, v array<double>")
    for r in df.select("id", D.var_pop("v").alias("var"), D.minmax("v").alias("mm")).collect():
        a = np.array(vecs[r.id], dtype=float)
        assert math.isclose(r.var, float(np.var(a)), rel_tol=1e-9, abs_tol=1e-15)
        if a.max() > a.min():
            assert np.allclose(r.mm, (a - a.min()) / (a.max() - a.min()), atol=1e-12)
        else:
            assert r.mm is None

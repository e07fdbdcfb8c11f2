"""Whitening against plain rational arithmetic."""

from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentscope.llm import whitening

DDL = "vec_id long, embedding array<float>, label int, x string, component int, n string, `a.b` int"


def table(spark, vectors):
    rows = [(i, v, 3, "x", 7, "n", 1) for i, v in vectors]
    return spark.createDataFrame(rows, DDL).repartition(3)


def plain(vectors):
    """n, sums, exact covariance and the whole-number rows."""
    good = [(i, v) for i, v in vectors if v is not None and all(c is not None and isfinite(c) for c in v)]
    width = max((len(v) for _, v in good), default=0)
    rows = [(i, tuple(floor(64 * c) + 1_000_000 for c in v) + (1_000_000,) * (width - len(v))) for i, v in good]
    once = list(dict.fromkeys(x for _, x in rows))
    n, sums = len(once), [sum(x[k] for x in once) for k in range(width)]
    mean = [Fraction(s, n) for s in sums]
    cov = [[sum((x[a] - mean[a]) * (x[b] - mean[b]) for x in once) / n for b in range(width)] for a in range(width)]
    return n, sums, cov, rows


@pytest.fixture(scope="module")
def vectors():
    random = np.random.default_rng(3)
    mixing = random.normal(size=(20, 20))
    out = [(i, [float(np.float32(c)) for c in random.normal(size=20) @ mixing]) for i in range(150)]
    out += [(200 + i, out[5][1]) for i in range(40)] + [(5, out[6][1]), (None, out[7][1])]
    out += [(300, None), (301, [None] * 20), (302, [float("nan")] + [0.0] * 19), (303, [float("inf")] + [0.0] * 19)]
    return [*out, (304, [0.5] * 4), (305, [0.5] * 4 + [0.0] * 16)]


def test_covariance_is_exact(spark, vectors):
    n, sums, cov, _ = plain(vectors)
    found, _ = whitening.fit(whitening.whole_vectors(table(spark, vectors)))
    assert (found.n, found.sums) == (n, sums)
    assert found.covariance.tolist() == [[float(c) for c in row] for row in cov]


def test_rows(spark, vectors):
    n, sums, cov, rows = plain(vectors)
    found = whitening.whiten(table(spark, vectors)).collect()
    assert sorted((r.vec_id or -1, r.component) for r in found) == sorted(
        (i or -1, k) for i, _ in rows for k in range(1, 17)
    )
    v = np.array([[float(c) for c in row] for row in cov])
    values, turned = np.linalg.eigh(v)
    values, turned = values[::-1][:16], turned[:, ::-1][:, :16]
    wanted, off = {}, {}
    for i, x in rows:
        centred = np.array([float(Fraction(a) - Fraction(s, n)) for a, s in zip(x, sums, strict=True)])
        wanted.setdefault(i, []).append(centred @ turned / np.sqrt(values))
        off.setdefault(i, set()).add(sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)))
    once = {i for i in wanted if len(wanted[i]) == 1}
    sign = {}
    for r in found:
        assert r.n == n and r.deviation in off[r.vec_id] and 0 <= r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(v), rel=1e-9)
        if r.vec_id in once:
            w = wanted[r.vec_id][0][r.component - 1]
            if abs(w) > 1e-6:
                assert sign.setdefault(r.component, np.sign(w * r.whitened)) == np.sign(w * r.whitened)
            assert abs(r.whitened) == pytest.approx(abs(w), abs=1e-8)


def test_few_dimensions_and_no_variance(spark):
    line = [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)]
    found = whitening.whiten(table(spark, line)).collect()
    assert {r.component for r in found} == {1, 2, 3} and len(found) == 27
    assert {r.whitened for r in found if r.component > 1} == {0.0}
    assert all(r.identity_error < 1e-9 for r in found)
    one = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(1, 0, 0.0, 0.0, 0.0)}


def test_large_entries(spark):
    big = [(i, [float(2**40 + i * i), float(-(2**41) * (i % 2)), 3.0]) for i in range(7)]
    n, sums, cov, rows = plain(big)
    frame = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    found, _ = whitening.fit(whitening.whole_vectors(frame))
    assert found.covariance.tolist() == [[float(c) for c in row] for row in cov]
    exact = {i: sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)) for i, x in rows}
    for r in whitening.whiten(frame).collect():
        assert r.deviation == (exact[r.vec_id] if exact[r.vec_id] < 2**63 else None)


def test_nothing(spark, vectors):
    nothing = table(spark, vectors).where(F.col("vec_id") == 300)
    assert whitening.whiten(nothing).collect() == [] == whitening.whiten(nothing.limit(0)).collect()
    assert whitening.whiten(nothing).schema.simpleString().startswith("struct<vec_id:bigint,component:int")

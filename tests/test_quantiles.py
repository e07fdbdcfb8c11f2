"""Exact quantiles, direct and narrowed, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentscope.operators import quantiles

SPEC = {"q25": ("v", 0.25), "q50": ("v", 0.5), "q75": ("v", 0.75), "w0": ("w", 0.0), "w99": ("w", 0.99)}


def skewed(spark):
    """One group holds more than a third of the rows; values repeat, spread and lie far out."""
    rng = np.random.default_rng(7)
    rows = []
    for group, n in {"hot": 3000, "b": 700, "c": 41, "one": 1, "same": 500}.items():
        v = np.round(rng.lognormal(3, 1.5, n), 2)
        if group == "hot":
            v[:5] = 1e300
            v[5:900] = 17.25
        if group == "same":
            v[:] = 4.0
        rows += [(group, float(x), int(y)) for x, y in zip(v, rng.integers(-50, 50, n))]
    rows += [("c", None, None), (None, 1.0, 1)]
    return spark.createDataFrame(rows, "g string, v double, w int"), rows


def expected(rows):
    found = {}
    for group in {r[0] for r in rows} - {None}:
        kept = {
            "v": [r[1] for r in rows if r[0] == group and r[1] is not None],
            "w": [r[2] for r in rows if r[0] == group and r[2] is not None],
        }
        found[group] = [np.percentile(kept[c], p * 100) for c, p in SPEC.values()]
    return found


def compare(got, rows):
    got = {r.g: [r[name] for name in SPEC] for r in got.collect()}
    wanted = expected(rows)
    assert set(got) == set(wanted)
    for group, values in wanted.items():
        np.testing.assert_allclose(got[group], values, rtol=1e-12)


def test_direct(spark):
    df, rows = skewed(spark)
    compare(quantiles.aggregate(df, ["g"], SPEC), rows)


@pytest.mark.parametrize("limit, accuracy", [(50, 200), (2000, 100)])
def test_narrowed(spark, limit, accuracy):
    df, rows = skewed(spark)
    compare(quantiles.narrowed(df.dropna(subset=["g"]), ["g"], SPEC, limit, accuracy), rows)


def test_cutting_brackets(spark):
    """A bracket with more values than allowed is cut until it fits."""
    df = spark.range(20000).select((F.col("id") * F.col("id") / 7).alias("v"))
    got = quantiles.narrowed(df, [], {"a": ("v", 0.5), "b": ("v", 0.123)}, 8, 20).first()
    values = np.arange(20000.0) ** 2 / 7
    np.testing.assert_allclose([got.a, got.b], np.percentile(values, [50, 12.3]), rtol=1e-12)


def test_cluster_before_a_gap(spark):
    """The two ranks around the median lie far apart, at the end of a dense run."""
    df = spark.range(600).select(
        F.when(F.col("id") < 300, 1 + F.col("id") * 1e-9).otherwise(1e9 + F.col("id")).alias("v")
    )
    got = quantiles.narrowed(df, [], {"m": ("v", 0.5)}, 2, 10).first().m
    values = [1 + i * 1e-9 if i < 300 else 1e9 + i for i in range(600)]
    np.testing.assert_allclose(got, np.median(values), rtol=1e-12)


def test_aggregate_chooses_by_size(spark):
    df, rows = skewed(spark)
    others = [F.count(F.lit(1)).alias("n")]
    got = quantiles.aggregate(df, ["g"], SPEC, others, max_values=1000)
    compare(got, rows)
    assert {r.g: r.n for r in got.collect()}["hot"] == 3000
    whole = quantiles.aggregate(df, [], {"m": ("w", 0.5)}, others, max_values=1000).first()
    assert whole.n == len(rows)


def test_of_counts(spark):
    df = spark.createDataFrame([(1, 3), (5, 1), (9, 4)], "v int, n int")
    got = df.agg(quantiles.of_counts("v", "n", 0.5).alias("m")).first().m
    assert got == np.median([1, 1, 1, 5, 9, 9, 9, 9])


def test_group_without_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "g string, v double")
    for limit in (0, 100):
        got = quantiles.aggregate(df, ["g"], {"m": ("v", 0.5)}, max_values=limit)
        assert {r.g: r.m for r in got.collect()} == {"a": 2.0, "b": None}


@pytest.mark.parametrize("odd", [float("inf"), float("-inf"), float("nan")])
def test_odd_values_end_and_agree(spark, odd):
    df = spark.range(1000).select(
        F.lit("g").alias("g"), F.when(F.col("id") == 7, F.lit(odd)).otherwise(F.col("id").cast("double")).alias("v")
    )
    spec = {"q0": ("v", 0.0), "q30": ("v", 0.3), "q100": ("v", 1.0)}
    one = quantiles.aggregate(df, ["g"], spec).first()
    two = quantiles.aggregate(df, ["g"], spec, max_values=1).first()
    assert [str(one[k]) for k in spec] == [str(two[k]) for k in spec]

"""Hard negatives against brute force."""

from collections import defaultdict
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentscope.llm import hard_negatives
from rentscope.llm.hard_negatives import Part, walk

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def expected(rows, every=3, positives=5, negatives=5):
    """rows: (vec_id, embedding, label), in any order; row places decide what ids leave open."""
    width = max((len(v) for _, v, _ in rows if v), default=0)
    kept = []
    for i, v, label in rows:
        if v is None or label is None or not all(c is not None and isfinite(c) for c in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        kept.append((i, [floor(256 * c) for c in v] + [0] * (width - len(v)), label))
    out = []
    order = lambda x: (-x[1], x[0] is None, x[0] or 0)
    for at, (i, v, label) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = [(j, sum(a * b for a, b in zip(v, w, strict=True)), m) for k, (j, w, m) in enumerate(kept) if k != at]
        for p, ps, _ in sorted((x for x in scored if x[2] == label), key=order)[:positives]:
            far = [x for x in scored if x[2] != label and 80 * ps <= 100 * x[1] <= 100 * ps]
            for rank, (j, ns, _) in enumerate(sorted(far, key=order)[:negatives], 1):
                out.append((i, p, rank, j, ps, ns))
    return sorted(out, key=repr)


def mined(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    for name in ("row", "part", "v", "score", "cluster", "anchor", "rank", "a.b", "held"):
        frame = frame.withColumn(name, F.lit("x"))
    found = hard_negatives.mine(frame, F.col("vec_id") % 3 == 0, hard_negatives.shifted_label(), **options)
    assert found.columns == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    random = np.random.default_rng(11)
    out = [(i, random.normal(size=6).round(2).tolist(), i % 4) for i in range(150)]
    out += [(500 + i, out[9][1], 1 if i < 40 else 2) for i in range(60)]  # one vector often, under two labels
    out += [(700 + i, [0.0] * 6, i % 2) for i in range(9)]
    out += [(801, None, 1), (802, [None] * 6, 1), (803, [float("nan")] * 6, 1), (804, [float("inf")] + [0.0] * 5, 2)]
    out += [(804, [1.0] * 6, None), (None, [0.5] * 6, 2), (807, [0.7, 0.7], 3), (810, [], 3)]
    return out


def test_against_brute_force(spark, rows):
    wanted = expected(rows)
    assert len(wanted) > 100
    assert mined(spark, rows) == wanted
    assert mined(spark, rows, part_rows=40) == wanted


def test_other_numbers_and_wide_scores(spark, rows):
    assert mined(spark, rows, positives=2, negatives=9) == expected(rows, positives=2, negatives=9)
    wide = [(i, None if v is None else [None if c is None else c * 3e5 for c in v], label) for i, v, label in rows]
    assert mined(spark, wide) == expected(wide)


def test_nothing(spark, rows):
    assert mined(spark, rows[:0]) == [] == mined(spark, [(3, [1.0], None), (4, None, 2)])
    assert mined(spark, [(3, [1.0], 1)]) == []


def part_of(vectors, labels):
    n = len(vectors)
    lengths = np.linalg.norm(vectors, axis=1)
    return Part(np.arange(n), np.arange(n), np.zeros(n, bool), labels, vectors.astype(float), lengths, None)


def test_bound_holds_and_ends_the_walk():
    """No score is above its bound; where directions differ, most of the list is never scored."""
    random = np.random.default_rng(5)
    heads = random.normal(size=(40, 16))
    vectors = np.floor(200 * (heads[random.integers(0, 40, 20_000)] + 0.05 * random.normal(size=(20_000, 16))))
    part = part_of(vectors, random.integers(0, 3, len(vectors)).astype(np.int32))
    members = np.floor(200 * (heads[3] + 0.05 * random.normal(size=(30, 16)))).astype(np.int64)
    unit = members / np.linalg.norm(members, axis=1, keepdims=True)
    order, bound = hard_negatives.shared_list(part, unit)
    assert (unit @ part.vectors[order].T <= bound + 1e-6).all() and (np.diff(bound) <= 0).all()
    labels, rows = np.zeros(30, np.int32), np.arange(-30, 0)
    low, high = np.full((30, 1), -(2.0**63)), np.full((30, 1), 2.0**63)
    owner, place, score, made = walk(part, members, rows, labels, low, high, True, 5)
    assert made < 0.2 * 30 * len(vectors)
    got = defaultdict(list)
    for o, p, s in zip(owner, place, score, strict=True):
        got[o].append((-s, p))
    for k, member in enumerate(members):
        scores = vectors @ member
        best = sorted((-s, p) for p, s in enumerate(scores) if part.labels[p] == 0)[:5]
        assert sorted(got[k]) == best

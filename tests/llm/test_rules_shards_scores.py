import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import prose
from conftest_llm import unordered
from pyspark.sql import functions as F
from rentscope.llm import quality_classifier, quality_rules, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rule_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_rule_counts(docs, rows):
    found = quality_rules.assess(docs)
    wanted = []
    for doc_id, text, _ in rows:
        counts = rule_counts(text)
        wanted.append((doc_id, *counts, counts[0] < 20 or 100 * counts[4] > 30 * counts[0]))
    assert unordered(found.drop("kept").collect()) == unordered(wanted)


def test_bad_hosts_lose_good_documents(spark):
    good, bad = prose(1, 60), "few words"
    rows = [(i, good if i % 50 else bad, "fine") for i in range(300)]
    rows += [(1000 + i, bad if i % 20 else good + str(i), "poor") for i in range(200)]
    rows += [(2000, bad, "new"), (2001, good, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in quality_rules.assess(frame).collect()}
    assert all(found[i].kept == (i % 50 != 0) for i in range(300))
    assert not any(found[1000 + i].kept for i in range(200))
    assert not found[1020].base_failed and not found[2000].kept and found[2001].kept
    left = quality_rules.keep_good(frame)
    assert left.columns == frame.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(d for d, r in found.items() if r.kept)


def test_documents_without_a_host_share_none(spark):
    """Most rows without a host fail a rule; the others stay, and no host's rate hears of them."""
    good, bad = prose(1, 60), "few words"
    rows = [(i, good + str(i) if i % 4 == 0 else bad, ["", None][i % 3 % 2]) for i in range(400)]
    rows += [(1000 + i, good if i % 10 else bad, "fine") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string")
    found = quality_rules.assess(frame.withColumnRenamed("a.b", "source")).collect()
    assert all(r.kept != r.base_failed for r in found) and sum(r.kept for r in found) == 154
    left = quality_rules.keep_good(frame, "a.b")
    assert left.columns == frame.columns and left.count() == 154


def test_prior_fits_moments():
    a, b = quality_rules.beta_prior(2, 200, 100, 90 * 90 / 100 + 10 * 10 / 100)
    assert a == pytest.approx(b) and 1 <= a + b < 10
    assert quality_rules.beta_prior(3, 300, 30, 3.0) == pytest.approx((30, 270))
    assert sum(quality_rules.beta_prior(0, 0, 0, 0.0)) == 1


def test_rules_keep_columns_and_empty(docs, no_docs):
    assert quality_rules.keep_good(docs).columns == docs.columns
    assert quality_rules.assess(no_docs).count() == 0
    assert quality_rules.keep_good(no_docs).count() == 0


def test_shards(docs, rows):
    found = sharding.shard(docs, [1.0] * 16).collect()
    wanted = unordered((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert unordered((r.doc_id, r.size, r.text_crc32) for r in found) == wanted
    by_shard = {}
    for r in found:
        assert 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16) and r.law == "key"
        by_shard.setdefault(r.shard, []).append(r)
    for members in by_shard.values():
        members.sort(key=lambda r: r.slot)
        assert [r.slot for r in members] == list(range(len(members)))
        keys = [r.doc_id for r in members]
        assert keys == sorted(keys, key=lambda k: (k is not None, k))


def test_weighted_shards_and_growth(spark):
    keys = spark.range(40_000).withColumnRenamed("id", "doc_id")
    weights = [1.0, 2.0, 1.0, 4.0]
    now, grown = sharding.shard_of_both(F.col("doc_id"), weights, 2.0)
    found = keys.select(now.alias("a"), grown.alias("b")).groupBy("a", "b").count().collect()
    shares = Counter()
    for r in found:
        assert r.b in (r.a, 4)
        shares[r.a] += r["count"]
    assert all(abs(shares[i] / 40_000 - w / 8) < 0.01 for i, w in enumerate(weights))
    assert abs(sum(r["count"] for r in found if r.b == 4) / 40_000 - 0.2) < 0.01


def test_records_in_shards(spark, docs, rows, tmp_path):
    placed = sharding.records(docs, [1.0] * 5)
    narrow = sharding.shard(docs, [1.0] * 5)
    told = ["shard", "slot", "size", "text_crc32"]
    assert unordered(placed.select("record.doc_id", *told).collect()) == unordered(narrow.select("doc_id", *told).collect())
    kept = docs.drop("shard")
    sharding.write_shards(sharding.records(kept, [1.0] * 5), str(tmp_path / "shards"))
    read = spark.read.parquet(str(tmp_path / "shards"))
    assert unordered(read.select(*(F.col(f"`{c}`") for c in kept.columns)).collect()) == unordered(kept.collect())
    assert read.select("shard", "slot").distinct().count() == len(rows)


def test_hot_key_is_numbered_whole(spark):
    frame = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    found = sharding.shard(frame, [1.0] * 4).groupBy("shard").agg(F.countDistinct("slot").alias("d"), F.count("*").alias("n"), F.max("slot").alias("m")).collect()
    assert all(r.d == r.n == r.m + 1 for r in found) and sum(r.n for r in found) == 3000


def test_shards_empty(no_docs):
    assert sharding.shard(no_docs, [1.0] * 16).count() == 0


def labelled(spark, n=1500):
    rows = []
    for i in range(n):
        text = prose(i, 40 + i % 90)
        bad = i % 4 == 0
        rows.append((i, re.sub(r"(?<=\w) ", "### ", text) if bad else text, 0 if bad else 1))
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(4)
    return frame.select("doc_id", "text"), frame.select("doc_id", "quality", F.lit(0).alias("toxic"))


def test_held_out_accuracy(spark):
    docs, labels = labelled(spark)
    found = quality_classifier.classify(docs, labels).collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(1500) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.predicted == (r.doc_id % 4 != 0) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)


def test_held_out_labels_are_not_used(spark):
    docs, labels = labelled(spark, 400)
    turned = labels.withColumn(
        "quality", F.when(quality_classifier.fold_of(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    one, two = (unordered(quality_classifier.classify(docs, x).collect()) for x in (labels, turned))
    assert [r[:2] for r in one] == [r[:2] for r in two]
    assert np.allclose([r[2] for r in one], [r[2] for r in two])


def test_odd_texts_and_no_labels(spark, docs, rows, no_docs):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    found = quality_classifier.classify(docs, none).collect()
    assert len(found) == len(rows) and {r.score for r in found} == {0.5}
    some = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(2, 1), (2, None)], "doc_id long, quality int")
    found = quality_classifier.classify(docs, some).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert quality_classifier.classify(no_docs, some).count() == 0


def test_isotonic_rises():
    rng = np.random.default_rng(1)
    count = rng.integers(0, 5, 50).astype(float)
    positive = np.minimum(count, rng.integers(0, 5, 50))
    at, share = quality_classifier.isotonic(count, count * np.arange(50), positive)
    assert (np.diff(share) > 0).all() and (np.diff(at) > 0).all()
    assert quality_classifier.isotonic(np.zeros(3), np.zeros(3), np.zeros(3)) is None


def plain_isotonic(x, y):
    """The rising values nearest to y in order of x, by the minimum over ends of maximum over begins of means."""
    order = np.argsort(x, kind="stable")
    y = y[order]
    fitted = np.array(
        [min(max(y[a : b + 1].mean() for a in range(i + 1)) for b in range(i, len(y))) for i in range(len(y))]
    )
    return x[order], fitted


def test_classifier_against_plain_numpy(spark):
    """Moments, normal equations, ridge, calibration and scores of one small table, step by step."""
    q = quality_classifier
    docs, labels = labelled(spark, 400)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect() if r.doc_id is not None}
    given = {}
    for r in labels.where("doc_id is not null and quality is not null").collect():
        given[r.doc_id] = max(given.get(r.doc_id, 0), r.quality)
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i in texts}
    stats = {i: np.array(q.statistics(t or ""), np.float32).astype(float) for i, t in texts.items()}
    train = [i for i in texts if i in given and fold[i] not in (0, 1)]
    rest = [i for i in texts if i in given and fold[i] == 1]
    x = np.array([stats[i] for i in train])
    mean, scale = x.mean(0), np.sqrt(np.maximum(x.var(0), 1e-8))
    random = np.random.default_rng(20240501)
    frequencies = random.normal(size=(x.shape[1], 384)) / 4.0
    phases = random.uniform(0, 2 * np.pi, 384)

    def features(ids):
        z = np.clip((np.array([stats[i] for i in ids]) - mean) / scale, -6, 6)
        return np.hstack([np.sqrt(2 / 384) * np.cos(z @ frequencies + phases), np.ones((len(ids), 1))])

    z, y = features(train), np.array([given[i] for i in train], float)
    penalty = np.diag([1e-3 * len(train) / 384] * 384 + [0.0]) + 1e-9 * len(train) * np.eye(385)
    weights = np.linalg.solve(z.T @ z + penalty, z.T @ y)
    model = q.fit(q.measured(docs), labels)
    assert model.mean == pytest.approx(mean, rel=1e-9) and model.scale == pytest.approx(scale, rel=1e-6)
    every = sorted(texts)
    assert model.raw(np.array([stats[i] for i in every])) == pytest.approx(features(every) @ weights, abs=1e-6)

    raw = np.clip(features(rest) @ weights, -1, 2)
    bins = np.minimum(((raw + 1) / 3 * q.BINS).astype(int), q.BINS - 1)
    assert len(rest) > 20
    counts = np.stack([np.bincount(bins, w, q.BINS) for w in (np.ones(len(rest)), raw, [given[i] for i in rest])])
    knots, shares = q.isotonic(*counts)
    # Rows of one bin count together, so the plain curve is fitted to rows that have their bin's mean.
    told = np.array([given[i] for i in rest], float)
    by_bin = np.array([told[bins == b].mean() for b in bins])
    _, curve = plain_isotonic(bins.astype(float), by_bin)
    assert sorted(set(shares.round(9))) == sorted(set(curve.round(9)))
    assert model.knots[0] == pytest.approx(knots, abs=1e-6) and model.knots[1] == pytest.approx(shares)

    value = np.clip(features(every) @ weights, -1, 2)
    wanted = 0.999 * np.interp(value, knots, shares) + 0.001 * (value + 1) / 3
    found = {r.doc_id: r.score for r in q.score(q.measured(docs), model).collect()}
    assert [found[i] for i in every] == pytest.approx(wanted, abs=1e-5)

"""Metrics, price bands, quotes, clusters."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentscope import schemas
from rentscope.operators import metrics, quotes, segments, value_counts
from rentscope.sinks import versions, warehouse

# Stored segments and the bands published for ten ping.
GOLDEN = [
    ("中山區", "住宅大樓(11層含以上有電梯)", 46, 1947.83, 1479.85, 2233.9300000000003, 24500.0,
     14798, 19478, 22339, 0.95),
    ("中山區", "公寓(無電梯)", 17, 1451.19, 1256.81, 1863.75, 23000.0, 12568, 14512, 18638, 0.85),
]


def golden(spark):
    rows = [(*r[:7], None) for r in GOLDEN]
    return spark.createDataFrame(rows, schemas.METRICS)


def test_recommendations_match_stored_bands(spark):
    got = metrics.find_recommendations(metrics.recommendations(golden(spark))).collect()
    assert [
        (r.building_type, r.recommended_rent_low, r.recommended_rent_mid, r.recommended_rent_high,
         r.confidence_score)
        for r in got
    ] == [(r[1], *r[7:]) for r in GOLDEN]
    one = metrics.find_recommendations(metrics.recommendations(golden(spark)), "中山區", "公寓(無電梯)")
    assert one.count() == 1


def test_quotes(spark):
    requests = spark.createDataFrame(
        [(1, "中山區", "公寓(無電梯)", 10.0), (2, "中山區", "x", 10.0), (3, "中山區", "公寓(無電梯)", 0.0),
         (4, "x", "x", None)],
        "request_id int, district string, building_type string, area_ping double",
    )
    answers = quotes.quote(requests, golden(spark))
    got = {r.request_id: r for r in answers.collect()}
    assert [got[i].status for i in (1, 2, 3, 4)] == ["ok", "not_found", "invalid_area", "invalid_area"]
    ok = got[1]
    assert (ok.recommended_rent_low, ok.rent_per_ping_high, ok.confidence_score) == (12568, 1863.75, 0.85)
    assert ok.pricing_guidance.aggressive.monthly_rent_ntd == 18638
    assert ok.annual_rent_estimate.mid_ntd == 14512 * 12
    assert got[2].recommended_rent_low is None and got[2].pricing_guidance is None
    rows = quotes.breakdown(answers).orderBy("place").collect()
    assert [(r.strategy, r.annual_rent) for r in rows] == [
        ("Conservative (P25)", 150816), ("Market median", 174144), ("Aggressive (P75)", 223656),
    ]


def test_metrics_and_tables(spark):
    rows = [("a", "x", 10.0, 1000 * i, 100.0 * i) for i in range(1, 6)] + [("b", "y", 1.0, 5, 5.0)]
    rows += [(None, "y", 1.0, 5, 5.0)]
    df = spark.createDataFrame(
        rows, "district string, building_type string, area_ping double, rent_ntd int, rent_per_ping double"
    )
    found = metrics.district_metrics(df)
    a, b = found.orderBy("district").collect()
    assert (a.sample_size, a.p25_rent_per_ping, a.median_rent_ntd) == (5, 200.0, 3000.0)
    assert found.count() == 2
    table = {r.district: (r.x, r.y) for r in metrics.rent_table(found, ["x", "y"]).collect()}
    assert table == {"a": (300.0, None), "b": (None, 5.0)}
    clusters = spark.range(4)
    figures = metrics.dashboard_figures(found, metrics.recommendations(found), clusters).first()
    assert figures.asDict() == {
        "districts": 2, "median_sample_size": 3, "mean_confidence": 0.35, "segments": 4,
    }
    assert [r.district for r in metrics.options(found, "district").collect()] == ["a", "b"]
    assert metrics.list_metrics(found).first().updated_at[10] == "T"


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], schemas.TRANSACTIONS)
    assert metrics.district_metrics(empty).isEmpty()
    assert metrics.recommendations(metrics.district_metrics(empty)).isEmpty()
    summary = metrics.transactions_summary(empty).first()
    assert (summary.total_transactions, summary.districts) == (0, [])
    assert segments.segment(empty) == (None, None)


def lloyd(points, centres, rounds=10):
    for _ in range(rounds):
        near = ((points[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        moved = np.array(
            [points[near == i].mean(0) if (near == i).any() else c for i, c in enumerate(centres)]
        )
        done = np.allclose(centres, moved, atol=1e-4)
        centres = moved
        if done:
            break
    return centres, ((points[:, None] - centres[None]) ** 2).sum(-1).argmin(1)


@pytest.mark.parametrize("drawn", [True, False])
def test_segments_against_numpy(spark, drawn):
    rng = np.random.default_rng(3)
    raw = np.concatenate([rng.normal((10, 1800), (3, 200), (120, 2)), rng.normal((40, 900), 9, (40, 2))])
    scaled = (raw - raw.mean(0)) / raw.std(0, ddof=1)
    picks = np.random.default_rng(42).choice(len(raw), 4, replace=False)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(raw)]
    df = spark.createDataFrame(rows, "n int, area_ping double, rent_per_ping double")
    how = {"row_number": "n"} if drawn else {"init": scaled[picks].tolist()}
    clusters, assigned = segments.segment(df, **how)
    centres, near = lloyd(scaled, scaled[picks])
    got = clusters.orderBy("cluster_id").collect()
    wanted = centres * raw.std(0, ddof=1) + raw.mean(0)
    np.testing.assert_allclose([[r[2], r[3]] for r in got], wanted, rtol=1e-9)
    assert [r.sample_size for r in got] == np.bincount(near, minlength=4).tolist()
    assert [r.cluster_id for r in assigned.orderBy("n").collect()] == near.tolist()


def test_empty_cluster_stays_and_ties_go_low(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 0.0)], "x double, y double")
    start = [[0.0, 0.0], [2.0, 0.0], [50.0, 50.0]]
    assert segments.moved(df, start, ["x", "y"]) == [[0.5, 0.0], [2.0, 0.0], [50.0, 50.0]]
    with pytest.raises(ValueError, match="at least 4"):
        segments.kmeans(df, ["x", "y"], 4)
    same = spark.createDataFrame([(5.0, 7.0)] * 3, "area_ping double, rent_per_ping double")
    assert segments.scaling(same)["std"] == [1.0, 1.0]


def test_starting_points_differ_among_copies(spark):
    rows = [(1.0, 1.0)] * 900 + [(2.0, 2.0)] * 400 + [(3.0, 1.0)] * 300 + [(4.0, 4.0), (5.0, 5.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    for seed in range(5):
        points = segments.starting_points(df, ["x", "y"], 4, seed=seed)
        assert len({tuple(p) for p in points}) == 4
    assert len(segments.starting_points(df.filter("x < 3"), ["x", "y"], 4)) == 4


def test_labels(spark):
    rents = [1772.1, 3764.3, 1071.9, 1658.3]
    df = spark.createDataFrame(
        [(i, r) for i, r in enumerate(rents)], "cluster_id int, centroid_rent_per_ping double"
    )
    got = [r.segment_label for r in segments.label(df).orderBy("cluster_id").collect()]
    assert got == ["premium", "luxury", "budget", "value"]
    many = spark.range(6).select(
        F.col("id").cast("int").alias("cluster_id"), F.lit(1.0).alias("centroid_rent_per_ping")
    )
    got = [r.segment_label for r in segments.label(many).orderBy("cluster_id").collect()]
    assert got == ["budget", "value", "premium", "luxury", "luxury", "luxury"]


def test_segments_resume_at_the_last_round(spark, tmp_path, monkeypatch):
    """A run that ends in its third round goes on there, over the points it stored, to the same clusters."""
    random = np.random.default_rng(9)
    rows = [(f"k{i}", float(a), float(b)) for i, (a, b) in enumerate(random.normal(size=(400, 2)) * 3 + 20)]
    df = spark.createDataFrame(rows, "row_key string, area_ping double, rent_per_ping double")
    wanted, _ = segments.segment(df, order=F.md5("row_key"))
    moved, calls = segments.moved, []

    def counted(*given):
        calls.append(len(calls))
        if len(calls) == 3:
            raise ConnectionError("the driver is gone")
        return moved(*given)

    monkeypatch.setattr(segments, "moved", counted)
    progress = str(tmp_path / "progress")
    with pytest.raises(ConnectionError):
        segments.segment(df, order=F.md5("row_key"), progress=progress)
    stored = versions.read(spark, f"{progress}/rounds").select("round").distinct().collect()
    assert [r.round for r in stored] == [2]
    # The table is gone by now; the points are there.
    found, _ = segments.segment(df.limit(0), order=F.md5("row_key"), progress=progress)
    drop = ("updated_at",)
    assert sorted(found.drop(*drop).collect()) == sorted(wanted.drop(*drop).collect())
    assert versions.newest(spark, f"{progress}/points") == 1
    again = len(calls)
    segments.segment(df, order=F.md5("row_key"), progress=progress)
    assert len(calls) == again


def test_metrics_after_appends_equal_the_full_run(spark, tmp_path):
    """Counts are refreshed from new loads alone; a replacement starts anew; a repeated refresh adds nothing."""
    table, state = str(tmp_path / "table"), str(tmp_path / "counts")
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("d"), (F.col("id") % 7).cast("string"))).alias("district"),
        F.concat(F.lit("t"), (F.col("id") % 2).cast("string")).alias("building_type"),
        (F.col("id") % 11 + 1.0).alias("area_ping"),
        (F.col("id") * 7919 % 4001 + 5000).alias("rent_ntd"),
        (F.col("id") * 104729 % 997 / 3.0).alias("rent_per_ping"),
        F.lit("2026-04-27").cast("date").alias("transaction_date"),
    )

    def same(part):
        names = ["district", "building_type", "sample_size", *value_counts.WANTED]
        found = value_counts.metrics(value_counts.refresh(spark, table, state)).select(*names)
        wanted = metrics.district_metrics(part).select(*names)
        got, want = (sorted(f.collect()) for f in (found, wanted))
        assert [r[:3] for r in got] == [r[:3] for r in want]
        for a, b in zip(got, want):
            assert list(a[3:]) == pytest.approx(list(b[3:]))

    warehouse.save_transactions(rows.where("rent_ntd < 7000"), table)
    same(rows.where("rent_ntd < 7000"))
    for low, high in ((7000, 8000), (8000, 9999)):
        before = versions.newest(spark, table)
        warehouse.save_transactions(rows.where(f"rent_ntd >= {low} and rent_ntd < {high}"), table, replace=False)
        new = versions.added(spark, table, before, before + 1)
        assert new.count() == rows.where(f"rent_ntd >= {low} and rent_ntd < {high}").count()
        same(rows.where(f"rent_ntd < {high}"))
        same(rows.where(f"rent_ntd < {high}"))
    newest = versions.newest(spark, state)
    value_counts.refresh(spark, table, state)
    assert versions.newest(spark, state) == newest == 3
    # Two loads since the last refresh, and a replacement.
    warehouse.save_transactions(rows.limit(100), table)
    warehouse.save_transactions(rows.limit(10), table, replace=False)
    assert versions.added(spark, table, 3, 5) is None
    assert value_counts.refresh(spark, table, state).agg(F.sum("n")).first()[0] == 220


def test_values_without_numbers_keep_their_segment(spark):
    rows = spark.createDataFrame(
        [("a", "x", None, 5), ("a", "x", None, 7), ("b", "x", 1.0, None), (None, "x", 1.0, 1), ("c", "y", float("inf"), 2)],
        "district string, building_type string, rent_per_ping double, rent_ntd long",
    )
    found = {r.district: r for r in value_counts.metrics(value_counts.tally(rows)).collect()}
    assert set(found) == {"a", "b", "c"} and found["a"].sample_size == 0
    assert found["a"].median_rent_per_ping is None and found["a"].median_rent_ntd == 6.0
    assert found["b"].median_rent_ntd is None and found["c"].p75_rent_per_ping == float("inf")
    assert value_counts.metrics(value_counts.tally(rows.limit(0))).count() == 0

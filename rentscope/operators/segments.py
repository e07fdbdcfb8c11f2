"""Market segments: K-Means over floor area and unit rent.

The loop keeps only k centroids on the driver. Each round is one aggregate whose
tasks send k partial sums, so neither skew nor table size reaches the shuffle, and
the centroids enter the next plan as literals, so the plan does not grow.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rentscope import vocab
from rentscope.session import materialise
from rentscope.sinks import versions

FEATURES = ["area_ping", "rent_per_ping"]
SEED = 42
DRAW = 64
ROUND = "round int, still boolean, cluster int, centroid array<double>"


def scaling(points: DataFrame, features: Sequence[str] = FEATURES) -> dict:
    """Row count, and mean and sample deviation of each feature (deviation 0 counts as 1)."""
    row = points.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"mean_{c}") for c in features],
        *[F.stddev_samp(c).alias(f"std_{c}") for c in features],
    ).first()
    return {
        "n": row["n"],
        "mean": [row[f"mean_{c}"] for c in features],
        "std": [row[f"std_{c}"] or 1.0 for c in features],
    }


def scaled(points: DataFrame, scale: dict, features: Sequence[str] = FEATURES) -> DataFrame:
    return points.withColumns(
        {
            f"z{i}": (F.col(c).cast("double") - F.lit(scale["mean"][i])) / F.lit(scale["std"][i])
            for i, c in enumerate(features)
        }
    )


def assign(
    df: DataFrame, centroids: Sequence[Sequence[float]], columns: Sequence[str]
) -> DataFrame:
    """Add ``cluster_id``, the nearest centroid of each row, the lowest one on a tie."""
    gaps = [
        " + ".join(f"(`{c}` - ({x!r}D)) * (`{c}` - ({x!r}D))" for c, x in zip(columns, centroid))
        for centroid in ([float(x) for x in c] for c in centroids)
    ]
    names = [f"_gap{i}" for i in range(len(gaps))]
    least = f"least({', '.join(names)})" if len(names) > 1 else names[0]
    cases = " ".join(f"when {name} then {i}" for i, name in enumerate(names))
    return df.selectExpr("*", *[f"{gap} as {name}" for gap, name in zip(gaps, names)]).selectExpr(
        *[f"`{c}`" for c in df.columns], f"case {least} {cases} end as cluster_id"
    )


def moved(
    df: DataFrame, centroids: Sequence[Sequence[float]], columns: Sequence[str]
) -> list[list[float]]:
    """Mean of the rows nearest to each centroid; one without rows stays where it is."""
    means = (
        assign(df.select(*columns), centroids, columns)
        .groupBy("cluster_id")
        .agg(*[F.avg(c).alias(c) for c in columns])
        .collect()
    )
    updated = [list(c) for c in centroids]
    for row in means:
        updated[row["cluster_id"]] = [row[c] for c in columns]
    return updated


def starting_points(
    points: DataFrame, columns: Sequence[str], k: int, order: Column | None = None,
    row_number: str | None = None, n: int | None = None, seed: int = SEED,
) -> list[list[float]]:
    """k rows to start from.

    With ``row_number`` (a dense column from 0, in arrival order) they are the rows a
    seeded draw without replacement picks; else the first k different points by
    ``order``, by default a seeded hash of the row. Copies of a row share a hash, so
    equal points are passed over as long as there are others.
    """
    if row_number:
        drawn = [int(i) for i in np.random.default_rng(seed).choice(n, k, replace=False)]
        rows = points.filter(F.col(row_number).isin(drawn)).select(row_number, *columns).collect()
        found = {row[row_number]: [row[c] for c in columns] for row in rows}
        return [found[i] for i in drawn]
    if order is None:
        order = F.xxhash64(F.lit(seed), *[F.col(c) for c in points.columns])
    ordered = points.select(order.alias("_order"), *columns)
    chosen: list[list[float]] = []
    left = ordered
    while len(chosen) < k:
        rows = left.orderBy("_order", *columns).limit(DRAW * k).collect()
        if not rows:
            rows = ordered.orderBy("_order", *columns).limit(k).collect()
            return [[row[c] for c in columns] for row in rows]
        for row in rows:
            point = [row[c] for c in columns]
            if point not in chosen and len(chosen) < k:
                chosen.append(point)
        for point in chosen:
            same = [F.col(c) == F.lit(x) for c, x in zip(columns, point)]
            left = left.filter(~reduce(lambda x, y: x & y, same))
    return chosen


def rounds(
    df: DataFrame,
    columns: Sequence[str],
    centroids: Sequence[Sequence[float]],
    max_iter: int = 10,
    progress: str | None = None,
) -> list[list[float]]:
    """Centroids after at most ``max_iter`` rounds; stops once no centroid moves.

    With ``progress`` (a folder that all executors reach) each round's centroids are stored there, and a run
    that finds some goes on behind the last round.
    """
    centroids, done, still = [list(map(float, c)) for c in centroids], 0, False
    if progress:
        centroids, done, still = _last_round(df.sparkSession, progress) or (centroids, 0, False)
    while done < max_iter and not still:
        updated = moved(df, centroids, columns)
        still = bool(np.allclose(centroids, updated, atol=1e-4))
        centroids, done = updated, done + 1
        if progress:
            rows = [(done, still, i, c) for i, c in enumerate(centroids)]
            told = df.sparkSession.createDataFrame(rows, ROUND).coalesce(1)
            versions.write(told, f"{progress}/rounds", key=str(done))
    return centroids


def _last_round(spark: SparkSession, progress: str) -> tuple[list[list[float]], int, bool] | None:
    """Centroids, number and end of the last stored round."""
    try:
        rows = versions.read(spark, f"{progress}/rounds").orderBy("cluster").collect()
    except versions.NoSuchTable:
        return None
    return [list(r.centroid) for r in rows], rows[0].round, rows[0].still


def kmeans(
    df: DataFrame,
    columns: Sequence[str],
    k: int = 4,
    max_iter: int = 10,
    init: Sequence[Sequence[float]] | None = None,
    **start,
) -> list[list[float]]:
    """Centroids of the rows of ``df``, started from ``init`` or ``starting_points``."""
    first = init or starting_points(df, columns, k, **start)
    if len(first) < k:
        raise ValueError(f"need at least {k} points, got {len(first)}")
    return rounds(materialise(df.select(*columns), "kmeans-points"), columns, first, max_iter)


def label(clusters: DataFrame, labels: Sequence[str] = vocab.SEGMENT_LABELS) -> DataFrame:
    """Name clusters by rising unit rent; all beyond the last name share it."""
    place = F.row_number().over(W.orderBy("centroid_rent_per_ping", "cluster_id"))
    names = F.array(*[F.lit(x) for x in labels])
    return clusters.withColumn(
        "segment_label", F.element_at(names, F.least(place, F.lit(len(labels))))
    )


def segment(
    transactions: DataFrame,
    k: int = 4,
    max_iter: int = 10,
    init: Sequence[Sequence[float]] | None = None,
    order: Column | None = None,
    row_number: str | None = None,
    seed: int = SEED,
    progress: str | None = None,
) -> tuple[DataFrame | None, DataFrame | None]:
    """Clusters in raw units with label and size, and the transactions with their cluster.

    ``init`` holds scaled starting points. Both are None with fewer than k rows. The
    transactions are read once: the two features and what orders the rows are stored for
    the statistics, the starting points, all rounds and the sizes, so a lost executor costs the part of a
    round it was at. With ``progress``, a folder of this run alone, a lost driver costs no more: the run that is
    started again takes the stored points and goes on behind the last round.
    """
    points = transactions.dropna(subset=FEATURES)
    if order is None:
        order = F.xxhash64(F.lit(seed), *[F.col(c) for c in points.columns])
    named = [row_number] if row_number else []
    kept = points.select(*FEATURES, *named, order.alias("_order"))
    spark = transactions.sparkSession
    if progress:
        versions.write(kept, f"{progress}/points", key="points")
        kept = versions.read(spark, f"{progress}/points", 1)
    else:
        kept = materialise(kept, "segment-points")
    columns = [f"z{i}" for i in range(len(FEATURES))]
    scale = scaling(kept)
    if scale["n"] < k:
        return None, None
    if init is None and not (progress and _last_round(spark, progress)):
        raw = starting_points(kept, FEATURES, k, F.col("_order"), row_number, scale["n"], seed)
        init = [[(x - m) / s for x, m, s in zip(p, scale["mean"], scale["std"])] for p in raw]
    ready = scaled(kept, scale).select(*columns)
    centroids = rounds(ready, columns, init or [], max_iter, progress)
    sizes = assign(ready, centroids, columns).groupBy("cluster_id").count().collect()
    size = {row["cluster_id"]: row["count"] for row in sizes}
    rows = [
        (i, *[z * s + m for z, s, m in zip(c, scale["std"], scale["mean"])], size.get(i, 0))
        for i, c in enumerate(centroids)
    ]
    clusters = transactions.sparkSession.createDataFrame(
        rows,
        "cluster_id int, centroid_area_ping double, centroid_rent_per_ping double, "
        "sample_size bigint",
    )
    assigned = assign(scaled(points, scale), centroids, columns).drop(*columns)
    return (
        label(clusters).select(
            "cluster_id", "segment_label", "centroid_area_ping", "centroid_rent_per_ping",
            "sample_size", F.current_timestamp().alias("updated_at"),
        ),
        assigned,
    )

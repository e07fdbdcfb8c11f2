"""Exact interpolated quantiles per group, whatever the size of the largest group.

Spark's ``percentile`` keeps every distinct value of a group in one task's memory.
That is the quickest way for groups of known size, and it is used as long as the
groups one task may hold at a time stay under ``max_values`` values in all columns
together. Beyond that the answer is narrowed down:

1. one scan sketches, per group and quantile, a bracket of values around the wanted
   rank;
2. two scans count the rows below each bracket and the rows per value inside it, both
   pre-aggregated before the shuffle;
3. the counts prove that the bracket holds the wanted rank (a miss widens it);
4. a bracket with too many distinct values is cut into bins until it has few enough,
   and the wanted ranks are read from what is left.

No step brings a group's rows together, so one key may hold any share of the table.
The input is run once: its keys and values are stored, and every scan reads that copy.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rentscope.session import materialise

MAX_VALUES = 2_000_000
#: Spark's aggregate holds so many groups with value maps before it sorts instead.
GROUPS_AT_ONCE = 128
SKETCH_ACCURACY = 10_000
BINS = 1024

Quantiles = Mapping[str, tuple[str, float]]


def rows_at_once(groups: DataFrame) -> int:
    """Rows of the largest groups that may meet in one task."""
    largest = groups.orderBy(F.desc("_rows")).limit(GROUPS_AT_ONCE)
    return largest.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]


def aggregate(
    df: DataFrame,
    keys: Sequence[str],
    quantiles: Quantiles,
    others: Sequence[Column] = (),
    max_values: int = MAX_VALUES,
    reads: Sequence[str] = (),
) -> DataFrame:
    """Group by ``keys`` with exact quantiles and further aggregates.

    ``quantiles`` maps an output column to (input column, probability). Rows with a
    null key are left out; null values are skipped. ``others`` may read the keys, the
    value columns and the columns named in ``reads``.
    """
    values = list(dict.fromkeys(column for column, _ in quantiles.values()))
    rows = df.dropna(subset=list(keys)) if keys else df
    rows = materialise(rows.select(*dict.fromkeys([*keys, *values, *reads])), "quantile-rows")
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *others)
    groups = materialise(groups, "quantile-groups")
    if rows_at_once(groups) * len(values) <= max_values:
        return _direct(rows, keys, quantiles, others)

    found = narrowed(rows, keys, quantiles, max_values)
    if not keys and not others:
        return found
    counted = groups.drop("_rows")
    if keys:
        return counted.join(found, list(keys), "left")
    one = F.lit(1).alias("_one")
    return counted.select("*", one).join(found.select("*", one), "_one", "left").drop("_one")


def _direct(rows, keys, quantiles, others) -> DataFrame:
    """One value map per column, whatever number of its quantiles is asked for."""
    wanted: dict[str, list[float]] = {}
    for column, p in quantiles.values():
        wanted.setdefault(column, []).append(p)
    maps = [
        F.percentile(F.col(column).cast("double"), F.array(*map(F.lit, ps))).alias(f"_{column}")
        for column, ps in wanted.items()
    ]
    kept = [c for c in rows.groupBy(*keys).agg(*others).columns] if others else list(keys)
    points = [
        F.get(f"_{column}", F.lit(wanted[column].index(p))).alias(name)
        for name, (column, p) in quantiles.items()
    ]
    return rows.groupBy(*keys).agg(*others, *maps).select(*kept, *points)


def of_counts(value: str, count: str, p: float, condition: Column | None = None) -> Column:
    """Exact quantile aggregate over rows that are already (value, count) pairs."""
    wanted = F.col(value) if condition is None else F.when(condition, F.col(value))
    return F.percentile(wanted.cast("double"), F.lit(p), F.col(count))


def narrowed(
    df: DataFrame,
    keys: Sequence[str],
    quantiles: Quantiles,
    max_values: int = MAX_VALUES,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    names = list(quantiles)
    columns = sorted({column for column, _ in quantiles.values()})
    rows = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])

    margin = 2.5 / accuracy
    while True:
        brackets = _brackets(rows, keys, quantiles, margin, accuracy)
        counts = materialise(_counts(rows, keys, quantiles, brackets), "quantile-counts")
        if not _misses(counts):
            break
        margin *= 16

    # The two ranks a quantile lies between are looked for apart, so that a cut always
    # leaves a single bin.
    ranks = [
        F.struct(F.lit(i).alias("_end"), place.cast("bigint").alias("_at"))
        for i, place in enumerate((F.floor("_rank"), F.ceil("_rank")))
    ]
    counts = counts.select("*", F.inline(F.array(*ranks)))
    by = [*keys, "_spec", "_end"]
    while _most_values(counts, by) > max(max_values, 1):
        counts = materialise(_cut(counts, by), "quantile-counts")

    running = W.partitionBy(*by).orderBy(F.col("_value").asc_nulls_first()).rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    reached = counts.withColumn("_upto", F.sum("_count").over(running)).filter(
        F.col("_value").isNotNull() & (F.col("_upto") > F.col("_at"))
    )
    part = F.max("_rank") - F.floor(F.max("_rank"))
    ends = [F.min(F.when(F.col("_end") == end, F.col("_value"))) for end in (0, 1)]
    # A rank that is whole takes its value as it is; 0 * infinity would be NaN.
    between = F.when(part == 0, ends[0]).otherwise(ends[0] * (1 - part) + ends[1] * part)
    point = reached.groupBy(*keys, "_spec").agg(between.alias("_q"))
    return point.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_spec") == i, F.col("_q"))).alias(n) for i, n in enumerate(names)]
    )


def _brackets(rows, keys, quantiles, margin, accuracy) -> DataFrame:
    """Per group and quantile i: ``_rank{i}``, and a value range ``_from{i}``, ``_to{i}``."""
    edges: dict[str, list[float]] = {}
    ranges = []
    for i, (column, p) in enumerate(quantiles.values()):
        low, high = p - margin, p + margin
        known = edges.setdefault(column, [])
        sketched = [F.get(f"_e_{column}", F.lit(len(known) + side)) for side in (0, 1)]
        known += [max(low, 0.0), min(high, 1.0)]
        ranges += [
            ((F.col(f"_n_{column}") - 1) * F.lit(p)).alias(f"_rank{i}"),
            (F.col(f"_min_{column}") if low <= 0 else sketched[0]).alias(f"_from{i}"),
            (F.col(f"_max_{column}") if high >= 1 else sketched[1]).alias(f"_to{i}"),
        ]
    spans = [
        c
        for name in edges
        for c in (
            F.count(name).alias(f"_n_{name}"),
            F.min(name).alias(f"_min_{name}"),
            F.max(name).alias(f"_max_{name}"),
        )
    ]
    sketches = [
        F.percentile_approx(c, F.array(*map(F.lit, ps)), F.lit(accuracy)).alias(f"_e_{c}")
        for c, ps in edges.items()
    ]
    groups = rows.groupBy(*keys).agg(*spans, *sketches)
    return materialise(groups.select(*keys, *ranges), "quantile-brackets")


def _counts(rows, keys, quantiles, brackets) -> DataFrame:
    """Rows per value inside each bracket; a null value stands for all rows below it.

    The rows below are counted by plain sums; only the few rows inside some bracket are
    taken apart.
    """
    if keys:
        joined = rows.join(brackets, list(keys))
    else:
        one = F.lit(1).alias("_one")
        joined = rows.select("*", one).join(brackets.select("*", one), "_one").drop("_one")

    def cell(i, value, count):
        return F.struct(
            F.lit(i).alias("_spec"), F.col(f"_rank{i}").alias("_rank"), value.alias("_value"),
            count.alias("_count"),
        )

    below, under, within, cells = [], [], [], []
    for i, (column, _) in enumerate(quantiles.values()):
        value = F.col(column)
        below += [
            F.sum(F.when(value < F.col(f"_from{i}"), 1).otherwise(0)).alias(f"_below{i}"),
            F.max(f"_rank{i}").alias(f"_rank{i}"),
        ]
        under.append(cell(i, F.lit(None).cast("double"), F.col(f"_below{i}")))
        inside = value.between(F.col(f"_from{i}"), F.col(f"_to{i}"))
        within.append(F.coalesce(inside, F.lit(False)))
        cells.append(F.when(inside, cell(i, value, F.lit(1).cast("bigint"))))

    lower = joined.groupBy(*keys).agg(*below)
    lower = lower.select(*keys, F.explode(F.array(*under)).alias("_c")).filter("_c._count > 0")
    found = joined.filter(reduce(lambda x, y: x | y, within))
    found = found.select(*keys, F.explode(F.array_compact(F.array(*cells))).alias("_c"))
    by_value = (
        found.select(*keys, "_c.*")
        .groupBy(*keys, "_spec", "_rank", "_value")
        .agg(F.sum("_count").alias("_count"))
    )
    return by_value.unionByName(lower.select(*keys, "_c.*"))


def _misses(counts: DataFrame) -> bool:
    """Whether some bracket does not reach from the lower to the upper wanted rank."""
    by = [c for c in counts.columns if c not in ("_value", "_count")]
    checked = counts.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(F.col("_value").isNull(), F.col("_count"))), F.lit(0)).alias("below"),
        F.sum("_count").alias("upto"),
    )
    bad = (F.col("below") > F.floor("_rank")) | (F.col("upto") <= F.ceil("_rank"))
    return not checked.filter(bad).isEmpty()


def _most_values(counts: DataFrame, by: Sequence[str]) -> int:
    sizes = counts.groupBy(*by).agg(F.count("_value").alias("n"))
    return sizes.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]


def _cut(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Keep the one bin of each bracket that holds its rank, and a count of what is below.

    The least and the greatest value fall into different bins, so every cut drops some.
    """
    infinite = float("inf")
    finite = F.when(F.abs("_value") < infinite, F.col("_value"))
    spans = counts.groupBy(*by).agg(F.min(finite).alias("_from"), F.max(finite).alias("_to"))
    spans = materialise(spans, "quantile-spans")
    # Halves keep the width of the widest span finite. Infinite values and NaN have bins of their own.
    place = (F.col("_value") / 2 - F.col("_from") / 2) / F.nullif(
        F.col("_to") / 2 - F.col("_from") / 2, F.lit(0.0)
    )
    bin_ = (
        F.when(F.col("_value").isNull(), -1)
        .when(F.col("_value") == -infinite, 0)
        .when(F.isnan("_value"), BINS + 2)
        .when(F.col("_value") == infinite, BINS + 1)
        .otherwise(1 + F.least(F.floor(F.coalesce(place, F.lit(0.0)) * BINS), F.lit(BINS - 1)))
    )
    binned = counts.join(spans, list(by)).withColumn("_bin", bin_).drop("_from", "_to")
    totals = binned.groupBy(*by, "_bin").agg(F.sum("_count").alias("_in"), F.max("_at").alias("_r"))
    running = W.partitionBy(*by).orderBy("_bin").rowsBetween(W.unboundedPreceding, W.currentRow)
    totals = totals.withColumn("_upto", F.sum("_in").over(running))
    start = F.col("_upto") - F.col("_in")
    # -1: below the rank, 0: holds it, 1: above.
    side = F.when(F.col("_upto") <= F.col("_r"), -1).when(start > F.col("_r"), 1).otherwise(0)
    sides = materialise(totals.select(*by, "_bin", side.alias("_side")), "quantile-bins")
    kept = binned.join(sides, [*by, "_bin"]).filter("_side <= 0")
    value = F.when(F.col("_side") == 0, F.col("_value"))
    return (
        kept.withColumn("_value", value)
        .groupBy(*by, "_rank", "_at", "_value")
        .agg(F.sum("_count").alias("_count"))
    )

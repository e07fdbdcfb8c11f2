"""Newest copy per key, newest rows per group, counted tags and their top lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rentscope.session import materialise

SALTS = 64


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` values of each key.

    An aggregate, not a window: every task reduces its copies to one before the
    shuffle, so a key with any share of the rows stays cheap.
    """
    others = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*others), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*df.columns)


def newest_per_group(
    df: DataFrame, group: str, order: Sequence[Column], n: int, salt: Sequence[str], salts: int = SALTS
) -> DataFrame:
    """The first n rows of each group by ``order``.

    Rows are first limited to n per group and salt (a hash of the ``salt`` columns),
    so the last step sees at most ``n * salts`` rows of a group.
    """
    part = F.pmod(F.xxhash64(*salt), F.lit(salts))
    salted = df.withColumn("_salt", part)
    first = F.row_number().over(W.partitionBy(group, "_salt").orderBy(*order))
    kept = salted.withColumn("_n", first).filter(F.col("_n") <= n).drop("_n", "_salt")
    last = F.row_number().over(W.partitionBy(group).orderBy(*order))
    return kept.withColumn("_n", last).filter(F.col("_n") <= n).drop("_n")


def tally(df: DataFrame, kinds: Mapping[str, Column], order: str | None = None) -> DataFrame:
    """Count the texts of several array columns in one pass: (kind, key, count, first).

    ``first`` tells where a key occurred first, by the whole-number column ``order``
    and the place in its row; it settles ties as arrival order would.
    """
    cells = [
        F.transform(values.cast("array<string>"), _cell(kind)) for kind, values in kinds.items()
    ]
    # The generator takes the expression itself: over a named column the optimizer would
    # add a size check that computes every cell once more.
    kept = [F.col(order).cast("bigint").alias("_order")] if order else []
    rows = df.select(*kept, F.posexplode(F.concat(*cells)).alias("_place", "_cell"))
    first = (
        F.min(F.struct("_order", "_place"))
        if order
        else F.lit(None).cast("bigint")
    )
    return (
        rows.groupBy(F.col("_cell.kind").alias("kind"), F.col("_cell.key").alias("key"))
        .agg(F.count(F.lit(1)).alias("count"), first.alias("first"))
        .filter(F.col("key").isNotNull())
    )


def _cell(kind: str):
    return lambda key: F.struct(F.lit(kind).alias("kind"), key.alias("key"))


def flag(name: str, condition: Column) -> Column:
    """One-name array where the condition holds, else an empty one; for ``tally``."""
    return F.when(condition, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))


def ranked(counts: DataFrame, unranked: Sequence[str] = ()) -> DataFrame:
    """Rank the keys of each kind: most frequent first, then first seen, then by name.

    Kinds in ``unranked`` hold plain values; each of their keys is a group of its own.
    """
    own = F.when(F.col("kind").isin(list(unranked)), F.col("key")) if unranked else F.lit(None)
    by = W.partitionBy("kind", own.cast("string")).orderBy(
        F.desc("count"), F.col("first").asc_nulls_last(), "key"
    )
    return counts.withColumn("rank", F.row_number().over(by))


def leaders(counts: DataFrame, k: int) -> DataFrame:
    """The k top keys of each kind, ranked.

    The limit stands on the rank itself, so every task drops what is beyond it before the shuffle.
    """
    return ranked(counts).filter(F.col("rank") <= k)


def numbered(counts: DataFrame) -> DataFrame:
    """rank, key and count of the keys of one kind, in rank's order, by ranges: no task holds all keys."""
    order = [F.desc("count"), F.col("first").asc_nulls_last(), F.col("key")]
    dealt = materialise(counts.repartitionByRange(*order), "ranked-ranges")
    dealt = dealt.withColumn("_file", F.col("_metadata.file_name"))
    # One row a range; names follow the ranges.
    sizes = dealt.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)
    based = sizes.select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    place = F.row_number().over(W.partitionBy("_file").orderBy(*order))
    placed = dealt.withColumn("_place", place).join(materialise(based, "ranked-bases"), "_file")
    return placed.select((F.col("_base") + F.col("_place")).alias("rank"), "key", "count")


def top(kind: str, k: int | None = None) -> Column:
    """Aggregate over ``ranked``: the k top keys of a kind as (key, count) pairs."""
    wanted = F.col("kind") == kind
    if k is not None:
        wanted = wanted & (F.col("rank") <= k)
    found = F.array_sort(F.collect_list(F.when(wanted, F.struct("rank", "key", "count"))))
    return F.transform(found, lambda c: F.struct(c["key"].alias("key"), c["count"].alias("count")))


def counted(kind: str, key: str | None = None) -> Column:
    """Aggregate over a tally: occurrences of a kind, or of one of its keys."""
    wanted = F.col("kind") == kind
    if key is not None:
        wanted = wanted & (F.col("key") == key)
    return F.coalesce(F.sum(F.when(wanted, F.col("count"))), F.lit(0))


def top_keys(counts: DataFrame, k: int) -> DataFrame:
    """The k top keys of each kind as rows."""
    return leaders(counts, k).select("kind", "rank", "key", "count")

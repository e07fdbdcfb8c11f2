"""Hard negatives from lists that a cluster of anchors shares.

1. Rows become whole-number vectors and are stored; those that are anchors are stored again, in order of
   the nearest of a few directions, which are fitted to a bounded sample of the anchors.
2. Candidates are dealt into parts of at most ``PART_ROWS`` rows. A task holds one part and reads the
   stored anchors a file at a time, cluster by cluster.
3. For a cluster, the task sorts its candidates once by an upper bound of the score with any member:
   |x| cos(max(0, angle(x, centre) - widest angle of a member)). Every member walks that list until its own
   length times the bound of the next candidate is below what it still needs: from there on the
   list holds nothing for it, which is certified, not assumed.
4. What the parts give for an anchor, at most a few rows each, is ranked again over all parts.

The walk runs twice: for the positives (the first rows of the anchor's label), and for the negatives, which
must score between a share of a positive's score and that score. Scores are whole-number inner products.

Anchors that repeat one vector make one cluster; clusters of any size are cut at the end of a file, so no task
holds more than ``FILE_ROWS`` of them.

Defined cases: a null label, a null vector, or one with null or non-finite entries, takes no part; a shorter
vector counts as if it went on with zeros; a row with a null vec_id is no anchor and comes after all others
in ties; rows are told apart by their place, so rows of one vec_id are each other's candidates; an anchor
without another row of its label, or without a negative in range, gives no rows; an empty table gives no rows.
Scores are exact up to 2**63. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentscope.llm.common import batch_of
from rentscope.llm.store import locate, open_there
from rentscope.session import materialise, scratch_path

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: A negative's score is at least LOW / 100 and at most HIGH / 100 of the positive's.
LOW, HIGH = 80, 100
PART_ROWS, FILE_ROWS = 100_000, 8_192
#: A part is made no smaller than this while there are fewer of them than ``LEAST_PARTS``.
SMALL_PART, LEAST_PARTS = 2_000, 64
CLUSTERS, SAMPLE, FIT_ROUNDS = 64, 8_192, 8
STEP = 1_024  # candidates in one step of a walk
MEMBERS = 256  # anchors that walk a list at a time
SEED = 97
WIDE = 2.0**26  # the product of two vectors of this length is exact in doubles

FOUND_DDL = "anchor long, other long, other_id long, score long"
FOUND = pa.schema([(name, pa.int64()) for name in ("anchor", "other", "other_id", "score")])
CLUSTER_DDL = "row long, vec_id long, label int, v array<long>, cluster int"
CLUSTER = pa.schema(
    [
        ("row", pa.int64()),
        ("vec_id", pa.int64()),
        ("label", pa.int32()),
        ("v", pa.list_(pa.int64())),
        ("cluster", pa.int32()),
    ]
)


# ---- rows and anchors


def whole_rows(table: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """row, vec_id, label and whole-number vector of every row that takes part, stored."""
    finite = F.forall("entries", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = (
        table.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            label.cast("int").alias("label"),
            F.col("embedding").cast("array<double>").alias("entries"),
        )
        .where(F.col("label").isNotNull() & F.col("entries").isNotNull() & F.coalesce(finite, F.lit(False)))
        .select(
            "vec_id", "label", F.transform("entries", lambda c: F.floor(c * scale).cast("long")).alias("v")
        )
    )
    return materialise(rows.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")


def shifted_label() -> Column:
    """The label, moved on by one where vec_id is divisible by 7."""
    label, moved = F.col("label").cast("int"), F.col("vec_id").cast("long") % 7 == 0
    return F.when(moved, (label + 1) % 10).otherwise(label)


def _wide(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists as a matrix; short rows go on with zeros."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _directions(vectors: np.ndarray) -> np.ndarray:
    """Rows at length one; zeros stay zeros."""
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(length > 0, length, 1)


def centres_of(sample: np.ndarray, clusters: int = CLUSTERS) -> np.ndarray:
    """So many directions, at most, by spherical k-means of a sample."""
    x = _directions(np.unique(sample, axis=0).astype(float))
    if not len(x):
        return np.zeros((1, max(1, sample.shape[1])))
    random = np.random.default_rng(SEED)
    centres = x[random.choice(len(x), min(clusters, len(x)), replace=False)]
    for _ in range(FIT_ROUNDS):
        nearest = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        filled = np.linalg.norm(sums, axis=1) > 0
        centres[filled] = _directions(sums[filled])
    return centres


def clustered(anchors: DataFrame, width: int) -> str:
    """The anchors in files of whole runs of clusters; the folder they are in."""
    drawn = anchors.select("v").where(
        F.pmod(F.xxhash64("row", F.lit(SEED)), F.lit(max(1, anchors.count() // SAMPLE))) == 0
    )
    # Bounded: about SAMPLE vectors, SAMPLE + their spread at most.
    sample = drawn.limit(2 * SAMPLE).toArrow().column(0).combine_chunks()
    centres = centres_of(_wide(sample, width))

    def assign(batches):
        for batch in batches:
            near = (_directions(_wide(batch.column("v"), width).astype(float)) @ centres.T).argmax(1)
            columns = [batch.column(name) for name in ("row", "vec_id", "label", "v")]
            yield batch_of(CLUSTER, [*columns, near.astype(np.int32)])

    folder = scratch_path(anchors.sparkSession, "negatives-anchors")
    near = anchors.select("row", "vec_id", "label", "v").mapInArrow(assign, CLUSTER_DDL)
    ordered = near.repartitionByRange("cluster", F.xxhash64("row")).sortWithinPartitions("cluster", "row")
    # The files are read in tasks, row group by row group; maxRecordsPerFile bounds each.
    ordered.write.option("maxRecordsPerFile", FILE_ROWS).parquet(folder)
    return folder


def anchor_files(folder: str):
    """The stored anchors, a file at a time: row, label, cluster, matrix of vectors."""
    system, path = locate(folder)
    names = sorted(
        f.base_name for f in system.get_file_info(fs.FileSelector(path)) if f.base_name.endswith(".parquet")
    )
    for name in names:
        with open_there(f"{folder}/{name}") as file:
            yield pq.read_table(file).combine_chunks()


# ---- the walk


@dataclass
class Part:
    """A task's candidates, in order of vec_id (null last) and row, so that a place decides ties."""

    rows: np.ndarray
    ids: np.ndarray
    null: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray  # whole numbers, as doubles
    lengths: np.ndarray
    whole: np.ndarray | None  # as integers, where products may be too wide for doubles

    @classmethod
    def of(cls, table: pa.Table, width: int) -> Part:
        vectors = _wide(table.column("v").combine_chunks(), width)
        rows = table.column("row").to_numpy()
        null = table.column("vec_id").is_null().to_numpy()
        ids = table.column("vec_id").fill_null(0).to_numpy()
        order = np.lexsort((rows, ids, null))
        vectors = vectors[order]
        lengths = np.linalg.norm(vectors, axis=1)
        return cls(
            rows[order],
            ids[order],
            null[order],
            table.column("label").to_numpy()[order],
            vectors.astype(float),
            lengths,
            vectors if lengths.max(initial=0) > WIDE else None,
        )


def shared_list(part: Part, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The candidates in falling order of their bound, and the bounds, for members' directions.

    A member's score with a candidate is at most the member's length times the bound.
    """
    centre = _directions(members.sum(0, keepdims=True))[0]
    widest = np.arccos(np.clip(members @ centre, -1, 1)).max()
    angle = np.arccos(np.clip(part.vectors @ centre / np.where(part.lengths > 0, part.lengths, 1), -1, 1))
    # A little is added for what rounding may have taken.
    bound = part.lengths * (np.cos(np.maximum(0, angle - widest)) + 1e-7)
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


def first_of(owner: np.ndarray, score: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Which entries are among the first k of their owner, by falling score and then place."""
    order = np.lexsort((place, -score, owner))
    owner = owner[order]
    begins = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1]) if len(owner) else np.zeros(0, int)
    rank = np.arange(len(owner)) - np.repeat(begins, np.diff(np.append(begins, len(owner))))
    return order[rank < k]


def walk(part: Part, vectors: np.ndarray, rows, labels, low, high, same: bool, k: int):
    """The first k candidates of every slot of every member: (slot, place, score) arrays.

    low and high (members by slots) bound the scores of a slot; same tells whether candidates have
    the member's label or another one. Also returns how many scores were made.
    """
    exact = vectors.astype(float)
    lengths, slots = np.linalg.norm(exact, axis=1), low.shape[1]
    order, bound = shared_list(part, _directions(exact))
    # Doubles are exact below 2**53; wider numbers are multiplied as integers.
    small = part.whole is None and lengths.max(initial=0) <= WIDE
    if small:
        left, right = exact, part.vectors
    else:
        left, right = vectors, part.vectors.astype(np.int64) if part.whole is None else part.whole
    need = low.astype(float)
    owner, place, score = (np.zeros(0, np.int64) for _ in range(3))
    made = 0
    for start in range(0, len(order), STEP):
        # The list ends for a member where not even its least demanding slot can get anything.
        going = np.flatnonzero(lengths * bound[start] + 1 >= need.min(1))
        if not len(going):
            break
        seen = order[start : start + STEP]
        scores = left[going] @ right[seen].T
        made += scores.size
        fits = (labels[going, None] == part.labels[None, seen]) == same
        if same:
            fits &= rows[going, None] != part.rows[None, seen]
        scores = np.where(fits, scores, np.nan) if small else scores
        for slot in range(slots):
            wanted = (scores >= need[going, slot, None]) & (scores <= high[going, slot, None])
            if not small:
                wanted &= fits
            who, where = np.nonzero(wanted)
            if not len(who):
                continue
            owner = np.append(owner, going[who] * slots + slot)
            place = np.append(place, seen[where])
            score = np.append(score, scores[who, where].astype(np.int64))
        kept = first_of(owner, score, place, k)
        owner, place, score = owner[kept], place[kept], score[kept]
        count = np.bincount(owner, minlength=len(vectors) * slots)
        least = np.full(len(vectors) * slots, np.iinfo(np.int64).max)
        np.minimum.at(least, owner, score)
        need = np.where(count >= k, least, low.ravel()).reshape(need.shape).astype(float)
    return owner, place, score, made


def _walked(candidates: DataFrame, folder: str, width: int, bounds, same: bool, k: int) -> DataFrame:
    """What the parts hold for every anchor; bounds(table) gives low and high of a table of anchors."""

    def run(batches):
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        part = Part.of(pa.Table.from_batches(held), width)
        held.clear()
        for table in anchor_files(folder):
            clusters = table.column("cluster").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(clusters)) + 1, [len(clusters)]])
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                for at in range(begin, end, MEMBERS):
                    some = table.slice(at, min(MEMBERS, end - at))
                    vectors = _wide(some.column("v").combine_chunks(), width)
                    rows, labels = some.column("row").to_numpy(), some.column("label").to_numpy()
                    low, high = bounds(some)
                    owner, place, score, _ = walk(part, vectors, rows, labels, low, high, same, k)
                    # A candidate may serve several slots of an anchor: it is told once.
                    anchor = rows[owner // low.shape[1]]
                    told = np.unique(np.stack([anchor, place, score]), axis=1)
                    anchor, place, score = told
                    ids = pa.array(part.ids[place], mask=part.null[place])
                    yield batch_of(FOUND, [anchor, part.rows[place], ids, score])

    return candidates.mapInArrow(run, FOUND_DDL)


def _ranked(by: list[str]) -> Column:
    order = [F.col("score").desc(), F.col("other_id").asc_nulls_last(), F.col("other")]
    return F.row_number().over(Window.partitionBy(*by).orderBy(*order)).alias("rank")


def mine(
    table: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    scale: int = SCALE,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """One row for each anchor, each of its first positives, and each of that one's first negatives."""
    rows = whole_rows(table, F.col("label") if label is None else label, scale)
    spark = table.sparkSession
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    width = max(1, size.width or 0)
    anchors = materialise(rows.where(F.coalesce(is_anchor, F.lit(False))), "negatives-asked")
    parts = max(1, -(-size.n // part_rows), min(LEAST_PARTS, size.n // SMALL_PART))
    # Dealt by the number of the row: equal vectors and labels are in all parts alike.
    dealt = rows.repartition(parts, "row")
    folder = clustered(anchors, width)

    lowest, highest = -(2.0**63), 2.0**63

    def any_score(some):
        return np.full((some.num_rows, 1), lowest), np.full((some.num_rows, 1), highest)

    near = _walked(dealt, folder, width, any_score, True, positives)
    first = near.select("*", _ranked(["anchor"])).where(F.col("rank") <= positives)
    first = materialise(first.select("anchor", "other_id", "other", "score"), "negatives-positives")

    # The scores each anchor's negatives are held against go with the anchor: a few numbers a row.
    held = first.groupBy("anchor").agg(F.sort_array(F.collect_set("score"), asc=False).alias("held"))
    asked = spark.read.parquet(folder).join(held, F.col("row") == F.col("anchor")).drop("anchor")
    second = scratch_path(spark, "negatives-held")
    asked.repartitionByRange("cluster", F.xxhash64("row")).sortWithinPartitions("cluster", "row").write.option(
        "maxRecordsPerFile", FILE_ROWS
    ).parquet(second)

    def in_range(some):
        low, high = (np.full((some.num_rows, positives), edge) for edge in (np.inf, -np.inf))
        for k, scores in enumerate(some.column("held").to_pylist()):
            low[k, : len(scores)] = [-(-LOW * s // 100) for s in scores]
            high[k, : len(scores)] = [HIGH * s // 100 for s in scores]
        return low, high

    far = materialise(_walked(dealt, second, width, in_range, False, negatives), "negatives-found")
    pairs = first.select("anchor", F.col("other").alias("positive"), F.col("other_id").alias("positive_id"),
                         F.col("score").alias("positive_score")).join(far, "anchor")
    fitting = pairs.where(
        (LOW * F.col("positive_score") <= 100 * F.col("score")) & (100 * F.col("score") <= HIGH * F.col("positive_score"))
    )
    ranked = fitting.select("*", _ranked(["anchor", "positive"])).where(F.col("rank") <= negatives)
    names = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return ranked.join(names, "anchor").select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("other_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )

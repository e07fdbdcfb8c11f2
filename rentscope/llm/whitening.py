"""Whitening of embeddings from polarised covariances.

1. Every entry c becomes the whole number x = floor(64 c) + 1000000. The fit list is each different vector
   once; it is stored, with copies gone before they are shuffled.
2. One pass sums the fit list; a whole number near each mean is taken off, so entries stay small.
3. One pass adds up squares of the centred entries of every dimension, and of the sum of every two
   dimensions, exactly, in whole numbers. cov(a, b) = (var(a + b) - var(a) - var(b)) / 2 gives all other
   covariances; what the whole-number centre left over is put right exactly. The matrix is divided
   once, at the end, and goes to ``eigh``.
4. Every row is projected on the components; a pass over the fit list measures the covariance of the
   whitened values.

What reaches the driver is sums of fixed size: one for each dimension and pair of dimensions.

Defined cases: a null vector, or one with null or non-finite entries, takes no part; a shorter vector counts as
if it went on with zeros up to the longest one; a null identifier stays null; repeated rows are returned each, and
are once in the fit list; a component without variance (of fewer vectors than dimensions, or of one) has
whitened 0 and is left out of identity_error; an empty table gives no rows. Entries may be as large as
2**50 / 64; a deviation that no long holds is null. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentscope.llm.common import batch_of
from rentscope.session import materialise

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
SUMS_DDL = "name int, total string"
SUMS = pa.schema([("name", pa.int32()), ("total", pa.string())])
WHITE_DDL = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)
WHITE = pa.schema(
    [
        ("vec_id", pa.int64()),
        ("component", pa.int32()),
        ("n", pa.int64()),
        ("deviation", pa.int64()),
        ("whitened", pa.float64()),
        ("explained", pa.float64()),
        ("identity_error", pa.float64()),
    ]
)
#: Rows of a block of pair sums: a block of 64 dimensions has 2016 of them for each row.
BLOCK = 512


def whole_vectors(table: DataFrame) -> DataFrame:
    """vec_id and the whole-number vector of every row that takes part."""
    entries = F.col("embedding").cast("array<double>")
    finite = F.forall("entries", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = F.transform("entries", lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    return (
        table.select(F.col("vec_id").cast("long").alias("vec_id"), entries.alias("entries"))
        .where(F.col("entries").isNotNull() & F.coalesce(finite, F.lit(False)))
        .select("vec_id", whole.alias("x"))
    )


def _wide(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists as a matrix; rows that end early go on with the value of a zero."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.full((len(lengths), width), SHIFT, np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _exact_sums(values: np.ndarray) -> list[int]:
    """Column sums without overflow."""
    most = max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0))))
    if most * max(1, len(values)) >= 1 << 63:
        values = values.astype(object)
    return [int(v) for v in values.sum(0)]


def _added(rows: DataFrame, part) -> dict[int, int]:
    """Whole-number sums by name over all batches; part(batch) gives the list of one batch's."""

    def run(batches):
        totals: list[int] | None = None
        for batch in batches:
            if batch.num_rows:
                found = part(batch)
                totals = found if totals is None else [a + b for a, b in zip(totals, found, strict=True)]
        if totals is not None:
            yield batch_of(SUMS, [range(len(totals)), list(map(str, totals))])

    parts = rows.mapInArrow(run, SUMS_DDL)
    # Decimals hold 38 digits: squares of the allowed entries, of a million million rows.
    added = parts.groupBy("name").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    return {row.name: int(row.total) for row in added.collect()}


@dataclass
class Whitening:
    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray  # of the components, falling
    vectors: np.ndarray  # one component a column
    explained: np.ndarray
    identity_error: float = 0.0

    @property
    def live(self) -> np.ndarray:
        """Which components have variance."""
        return self.values > 1e-12 * max(1e-300, float(np.trace(self.covariance)))

    def projector(self):
        """A function from whole-number vectors to whitened values.

        The means are taken off in two steps, a whole number exactly and then the small rest.
        """
        near = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([float(Fraction(s, self.n) - s // self.n) for s in self.sums])
        over = np.where(self.live, 1 / np.sqrt(np.where(self.live, self.values, 1)), 0)
        turned = self.vectors * over

        return lambda x: ((x - near).astype(float) - rest) @ turned

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n x - S)^2 of each row, exact."""
        near = np.array([s // self.n for s in self.sums], np.int64)
        rest = [s % self.n for s in self.sums]
        y = x - near
        most = (int(np.abs(y).max(initial=0)) + 1) * self.n
        if most * most * max(1, len(near)) < 1 << 63:
            off = self.n * y - np.array(rest, np.int64)
            return (off * off).sum(1).tolist()
        off = self.n * y.astype(object) - np.array(rest, object)
        return [int(v) if v < 1 << 63 else None for v in (off * off).sum(1)]


def polarised(near: np.ndarray):
    """A function from a batch to its sums: entries, squares, and squares of the sums of two dimensions."""
    width = len(near)
    left, right = np.triu_indices(width, 1)

    def part(batch) -> list[int]:
        y = _wide(batch.column(0), width) - near
        totals = None
        for low in range(0, len(y), BLOCK):
            rows = y[low : low + BLOCK]
            if int(np.abs(rows).max(initial=0)) >= 1 << 30:
                rows = rows.astype(object)
            pairs = rows[:, left] + rows[:, right]
            found = _exact_sums(np.concatenate([rows, rows * rows, pairs * pairs], axis=1))
            totals = found if totals is None else [a + b for a, b in zip(totals, found, strict=True)]
        return totals

    return part


def covariance_of(n: int, width: int, sums: dict[int, int]) -> tuple[np.ndarray, list[int]]:
    """The covariance (divisor n) from the polarised sums of centred entries, and the sums of the entries."""
    first = [sums[k] for k in range(width)]

    def variance(squares: int, total: int) -> int:
        return n * squares - total * total  # times n^2

    own = [variance(sums[width + k], first[k]) for k in range(width)]
    out = np.zeros((width, width))
    for k in range(width):
        out[k, k] = own[k] / (n * n)
    for at, (a, b) in enumerate(zip(*np.triu_indices(width, 1), strict=True)):
        both = variance(sums[2 * width + at], first[a] + first[b])
        out[a, b] = out[b, a] = (both - own[a] - own[b]) / (2 * n * n)
    return out, first


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[Whitening, DataFrame] | None:
    """The whitening of the different vectors among rows of x, and the stored fit list; None without any row."""
    once = materialise(vectors.select("x").groupBy("x").agg(F.lit(1).alias("one")).select("x"), "white-once")
    length = F.size("x")
    size = once.agg(F.count("*").alias("n"), F.min(length).alias("least"), F.max(length).alias("width")).first()
    n, width = size.n, size.width or 0
    if n and size.least < width:
        filled = F.concat("x", F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(width) - length))
        once = materialise(once.groupBy(filled.alias("x")).agg(F.lit(1).alias("one")).select("x"), "white-filled")
        n = once.count()
    if not n or not width:
        return None

    totals = _added(once, lambda batch: _exact_sums(_wide(batch.column(0), width)))
    near = np.array([totals[k] // n for k in range(width)], np.int64)
    covariance, _ = covariance_of(n, width, _added(once, polarised(near)))
    values, turned = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    trace = float(np.trace(covariance))
    values = np.maximum(values[order], 0)
    found = Whitening(
        n,
        [totals[k] for k in range(width)],
        covariance,
        values,
        turned[:, order],
        values / trace if trace > 0 else np.zeros(len(order)),
    )
    found.identity_error = identity_error(once, found)
    return found, once


def identity_error(once: DataFrame, found: Whitening) -> float:
    """The largest absolute entry of the whitened covariance over the fit list, less the identity."""
    width, live = len(found.sums), found.live
    size = int(live.sum())
    if not size:
        return 0.0

    def run(batches):
        project, total = found.projector(), np.zeros((size + 1, size))
        for batch in batches:
            if batch.num_rows:
                white = project(_wide(batch.column(0), width))[:, live]
                total += np.concatenate([white.T @ white, white.sum(0)[None]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    parts = once.mapInArrow(run, "sums binary").rdd.map(lambda row: np.frombuffer(row.sums))
    total = parts.treeReduce(lambda a, b: a + b, depth=3).reshape(size + 1, size) / found.n
    return float(np.abs(total[:-1] - np.outer(total[-1], total[-1]) - np.eye(size)).max())


def whiten(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each row of the table that takes part and each component."""
    vectors = whole_vectors(table)
    fitted = fit(vectors, components)
    if fitted is None:
        return table.sparkSession.createDataFrame([], WHITE_DDL)
    found, _ = fitted
    width, number = len(found.sums), len(found.values)

    def run(batches):
        project = found.projector()
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                part = batch.slice(low, BLOCK)
                x = _wide(part.column(1), width)
                owner = np.repeat(np.arange(len(x)), number)
                columns = [
                    part.column(0).take(pa.array(owner)),
                    np.tile(np.arange(1, number + 1, dtype=np.int32), len(x)),
                    np.full(len(owner), found.n),
                    pa.array(found.deviations(x), pa.int64()).take(pa.array(owner)),
                    project(x).ravel(),
                    np.tile(found.explained, len(x)),
                    np.full(len(owner), found.identity_error),
                ]
                yield batch_of(WHITE, columns)

    return vectors.mapInArrow(run, WHITE_DDL)

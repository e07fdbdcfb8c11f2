"""Quality scores from random Fourier features of document statistics.

1. Statistics of the whole text are measured once per document and stored.
2. They are standardised by the labelled training rows and mapped to ``FEATURES`` cosines with fixed
   random frequencies, whose inner products approximate a Gaussian kernel.
3. Each partition sums its part of the normal equations; the sums (a matrix of fixed size) are
   added pairwise on the executors, and ridge regression is solved on the driver.
4. Scores of labelled rows that the fit did not see are counted in fixed bins, and isotonic
   regression of those counts turns a score into a share of label 1.

All labelled training rows are used. Held-out rows, a fifth by the CRC-32 of doc_id, are in none
of these steps; labels, language, source and doc_id are no inputs of a score.

Defined cases: a null text is empty and is scored like any text; a null doc_id is scored, has no
label and is not held out; a doc_id with several labels counts with the largest; null labels
are ignored; without any label every score is 0.5; an empty table gives no rows. Other columns are not
read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentscope.llm.common import batch_of, keyed_texts
from rentscope.session import materialise

FEATURES, WIDTH, RIDGE = 384, 4.0, 1e-3
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
BINS = 1_000
THRESHOLD = 0.3
CLIP = 6.0
TIE = 1e-3
MARKS = b"#$%&*|!"
STATISTICS = 22 + len(MARKS)
STATS_DDL = "doc_id long, stats array<float>"
STATS = pa.schema([("doc_id", pa.int64()), ("stats", pa.list_(pa.float32()))])
SCORE_DDL = "doc_id long, score double"
SCORE = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

_UPPER, _LOWER, _DIGIT = (np.arange(a, b + 1) for a, b in (b"AZ", b"az", b"09"))
_PUNCTUATION = np.frombuffer(b".,;:!?-'\"()", np.uint8)


# ---- statistics of a text


def statistics(text: str) -> list[float]:
    """Shares, means and log counts; all finite for any text."""
    data = text.encode()
    words, lines = data.split(), [x for x in data.split(b"\n") if x.strip()]
    n, m, k = max(1, len(data)), max(1, len(words)), max(1, len(lines))
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = count[count > 0] / n
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    seen: dict[bytes, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    letters = max(1, int(count[_UPPER].sum() + count[_LOWER].sum() + count[128:].sum()))
    pairs = len(set(zip(words, words[1:], strict=False)))
    capital = sum(map(bytes.isupper, words))
    titled = sum(map(bytes.istitle, words))
    plain = sum(map(bytes.isalpha, words))
    return [
        math.log1p(len(data)),
        math.log1p(len(words)),
        math.log1p(len(lines)),
        float(lengths.mean()),
        float(lengths.std()),
        math.log1p(float(lengths.max())),
        float((lengths <= 3).mean()),
        float((lengths >= 12).mean()),
        float(count[_UPPER].sum() / letters),
        float(count[_DIGIT].sum() / n),
        float(count[128:].sum() / n),
        float(count[_PUNCTUATION].sum() / n),
        float(-(share * np.log2(share)).sum()) if len(data) else 0.0,
        len(seen) / m,
        max(seen.values(), default=0) / m,
        pairs / max(1, len(words) - 1),
        len(set(lines)) / k,
        math.log1p(len(words) / k),
        capital / m,
        titled / m,
        plain / m,
        float(count[10] / n),
        *(float(count[mark] / m) for mark in MARKS),
    ]


def measured(docs: DataFrame) -> DataFrame:
    """The statistics of every document."""

    def run(batches):
        for batch in batches:
            stats = [statistics(text.as_py()) for text in batch.column(1)]
            yield batch_of(STATS, [batch.column(0).to_pylist(), stats])

    return materialise(keyed_texts(docs).mapInArrow(run, STATS_DDL), "quality-stats")


def fold_of(doc_id: Column) -> Column:
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % FOLDS


# ---- the model


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None = None
    knots: tuple[np.ndarray, np.ndarray] | None = None

    def cosines(self, stats: np.ndarray) -> np.ndarray:
        """The random features of rows of statistics, and a constant."""
        random = np.random.default_rng(20240501)
        frequencies = random.normal(size=(len(self.mean), FEATURES)) / WIDTH
        phases = random.uniform(0, 2 * np.pi, FEATURES)
        x = np.clip((stats - self.mean) / self.scale, -CLIP, CLIP)
        cosines = math.sqrt(2 / FEATURES) * np.cos(x @ frequencies + phases)
        return np.concatenate([cosines, np.ones((len(x), 1))], axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.cosines(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), 0.5)
        raw = np.clip(self.raw(stats), -1, 2)
        calibrated = np.interp(raw, *self.knots) if self.knots else np.clip(raw, 0, 1)
        # Calibration is flat in places; the raw score still orders what it makes equal.
        return (1 - TIE) * calibrated + TIE * (raw + 1) / 3


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("stats").flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.float64)


def _summed(rows: DataFrame, shape: tuple[int, ...], part) -> np.ndarray:
    """The sum over all batches of part(batch), an array of fixed shape, added pairwise on the
    executors."""

    def run(batches):
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += part(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    sums = rows.mapInArrow(run, "sums binary").rdd.map(lambda row: np.frombuffer(row.sums))
    return sums.treeReduce(lambda a, b: a + b, depth=3).reshape(shape)


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """The model of the labelled rows (doc_id, quality) outside the held-out fold."""
    given = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("quality").cast("double")).alias("quality"))
        .withColumn("fold", fold_of(F.col("doc_id")))
        .where(F.col("fold") != HELD_OUT)
    )
    rows = materialise(stats.join(given, "doc_id").select("stats", "quality", "fold"), "quality-labelled")
    train, rest = rows.where(F.col("fold") != CALIBRATION), rows.where(F.col("fold") == CALIBRATION)
    width = STATISTICS

    def moments(batch):
        x = _matrix(batch)
        return np.stack([np.full(width, len(x)), x.sum(0), (x * x).sum(0)])

    number, total, squares = _summed(train, (3, width), moments)
    n = max(1.0, number[0])
    mean = total / n
    model = Model(mean, np.sqrt(np.maximum(squares / n - mean * mean, 1e-8)))
    if not number[0]:
        return model

    def equations(batch):
        z = model.cosines(_matrix(batch))
        return np.column_stack([z.T @ z, z.T @ batch.column("quality").to_numpy()])

    size = FEATURES + 1
    sums = _summed(train, (size, size + 1), equations)
    penalty = RIDGE * n * np.eye(size) / FEATURES
    penalty[-1, -1] = 0
    model.weights = np.linalg.solve(sums[:, :-1] + penalty + 1e-9 * n * np.eye(size), sums[:, -1])

    def counted(batch):
        raw = np.clip(model.raw(_matrix(batch)), -1, 2)
        bins = np.minimum(((raw + 1) / 3 * BINS).astype(int), BINS - 1)
        y = batch.column("quality").to_numpy()
        return np.stack([np.bincount(bins, w, BINS) for w in (np.ones(len(raw)), raw, y)])

    model.knots = isotonic(*_summed(rest, (3, BINS), counted))
    return model


def isotonic(count: np.ndarray, raw: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Knots (score, share) of the rising step function nearest to the binned labels: each
    pool of bins at its mean score. None without any row."""
    pools: list[list[float]] = []
    for c, r, p in zip(count, raw, positive, strict=True):
        if not c:
            continue
        pools.append([c, r, p])
        while len(pools) > 1 and pools[-2][2] * pools[-1][0] >= pools[-1][2] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    if not pools:
        return None
    c, r, p = np.array(pools).T
    return r / c, p / c


def score(stats: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of statistics."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch_of(SCORE, [batch.column("doc_id").to_pylist(), model.score(_matrix(batch))])

    scored = stats.mapInArrow(run, SCORE_DDL)
    return scored.select(
        "doc_id",
        F.coalesce(fold_of(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document scored by a model of the labelled ones."""
    stats = measured(docs)
    return score(stats, fit(stats, labels))

"""Language of a text by a convolutional network over its bytes.

1. A bounded sample of the labelled rows that may be learnt from is drawn by a hash of the text, so
   copies count once: about ``SAMPLE_DOCS`` texts, shared evenly by the languages, at least one of each. A
   few windows of ``WINDOW`` bytes and a few short snippets of each are what the network learns from.
2. The network has an embedding of bytes, filters of several widths, the largest value of each filter
   in the window, and a softmax. It is trained in numpy with Adam, from a fixed seed.
3. Every text is cut into windows that overlap by the widest filter less a byte, so each run of bytes is
   seen whole by some window. All windows are scored, a bounded number at a time, and a text's
   score of a language is the mean over its windows, weighted by their bytes.

Held-out rows, a quarter by the CRC-32 of doc_id, are not learnt from; lang, source and doc_id are no
inputs of a prediction.

Defined cases: a null text, or one without any letter, is ``und`` with score 0, and so is every text where
nothing can be learnt from (no table, no labels); a null doc_id is scored, is not held out and is not
learnt from; a text with several labels is learnt with each of them; an empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentscope.llm.common import batch_of
from rentscope.session import materialise

WINDOW = 256
WIDTHS = (2, 3, 4)  # the widest is four bytes: a predictor looks up two pairs
FILTERS = 8  # of each width
EMBEDDING = 8
SAMPLE_DOCS = 2_000
FULL_WINDOWS, SNIPPETS = 3, 2
SHORTEST, LONGEST = 4, 64  # bytes of a snippet
EPOCHS, BATCH, RATE, SEED = 4, 64, 6e-3, 20240607
AT_ONCE = 48
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
SAMPLE_DDL = "lang string, place long, windows binary, texts int"
SAMPLE = pa.schema(
    [("lang", pa.string()), ("place", pa.int64()), ("windows", pa.binary()), ("texts", pa.int32())]
)
FOUND_DDL = "doc_id long, held_out boolean, lang_pred string, score double"
FOUND = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())]
)


# ---- windows


def windows_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The windows of a text (padded with zeros) and how many bytes of it each one holds."""
    overlap = max(WIDTHS) - 1
    step = WINDOW - overlap
    count = max(1, -(-(len(data) - overlap) // step))
    padded = np.zeros((count - 1) * step + WINDOW, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    views = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::step]
    return views, np.minimum(WINDOW, len(data) - step * np.arange(count))


def drawn(data: bytes, seed: int) -> np.ndarray:
    """Windows and snippets of a text to learn from, from places that the seed picks."""
    random = np.random.default_rng(seed & 0xFFFFFFFF)
    sizes = [WINDOW] * min(FULL_WINDOWS, -(-len(data) // WINDOW))
    sizes += random.integers(SHORTEST, LONGEST, SNIPPETS).tolist()
    out = np.zeros((len(sizes), WINDOW), np.uint8)
    for row, size in zip(out, sizes, strict=True):
        start = int(random.integers(0, max(1, len(data) - size + 1)))
        part = np.frombuffer(data[start : start + size], np.uint8)
        row[: len(part)] = part
    return out


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


# ---- the network


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # 256, EMBEDDING
    filters: np.ndarray  # max(WIDTHS) * EMBEDDING, all filters; zeros beyond a filter's width
    filter_bias: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    PARAMETERS = ("embedding", "filters", "filter_bias", "weights", "bias")

    @classmethod
    def new(cls, languages: list[str], random: np.random.Generator) -> Network:
        number, wide = FILTERS * len(WIDTHS), max(WIDTHS)
        filters = random.normal(size=(wide * EMBEDDING, number)) * np.sqrt(2 / (wide * EMBEDDING))
        return cls(
            languages,
            random.normal(size=(256, EMBEDDING)).astype(np.float32),
            (filters * cls.reach()).astype(np.float32),
            np.zeros(number, np.float32),
            (random.normal(size=(number, len(languages))) / np.sqrt(number)).astype(np.float32),
            np.zeros(len(languages), np.float32),
        )

    @staticmethod
    def reach() -> np.ndarray:
        """Which weights a filter of each width has."""
        places = np.repeat(np.arange(max(WIDTHS)), EMBEDDING)[:, None]
        return (places < np.repeat(WIDTHS, FILTERS)[None, :]).astype(np.float32)

    def responses(self, windows: np.ndarray) -> np.ndarray:
        """Every filter at every place of every window."""
        wide = max(WIDTHS)
        vectors = self.embedding[windows]
        places = windows.shape[1] - wide + 1
        runs = np.concatenate([vectors[:, k : k + places] for k in range(wide)], axis=2)
        return (runs.reshape(-1, wide * EMBEDDING) @ self.filters).reshape(len(windows), places, -1)

    def chances(self, pooled: np.ndarray) -> np.ndarray:
        """Softmax of the largest responses."""
        logits = np.maximum(pooled + self.filter_bias, 0) @ self.weights + self.bias
        grown = np.exp(logits - logits.max(1, keepdims=True))
        return grown / grown.sum(1, keepdims=True)

    def predictor(self):
        """A function from windows to chances.

        Responses are sums over the bytes under a filter, so a trained network needs one table for
        the first two bytes and one for the next two: two look-ups for each place of a window.
        """
        rows = self.filters.reshape(max(WIDTHS), EMBEDDING, -1)
        one = [self.embedding @ row for row in rows]
        first, second = ((a[:, None] + b[None, :]).reshape(1 << 16, -1) for a, b in (one[:2], one[2:]))

        def predict(windows: np.ndarray) -> np.ndarray:
            pairs = (windows[:, :-1].astype(np.intp) << 8) | windows[:, 1:]
            found = np.take(first, pairs[:, :-2], axis=0)
            found += np.take(second, pairs[:, 2:], axis=0)
            return self.chances(found.max(1))

        return predict

    def slopes(self, windows: np.ndarray, wanted: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """The mean loss of a batch and its gradient in each parameter.

        Only the place where a filter is largest passes its gradient on.
        """
        wide, n = max(WIDTHS), len(windows)
        found = self.responses(windows)
        best = found.argmax(1)
        pooled = np.take_along_axis(found, best[:, None], 1)[:, 0]
        active = np.maximum(pooled + self.filter_bias, 0)
        chances = self.chances(pooled)
        loss = float(-np.log(np.maximum(chances[np.arange(n), wanted], 1e-12)).mean())
        error = chances.copy()
        error[np.arange(n), wanted] -= 1
        error /= n
        back = (error @ self.weights.T) * (active > 0)
        # The bytes under each filter at its best place: windows, filters, width.
        seen = windows[np.arange(n)[:, None, None], best[:, :, None] + np.arange(wide)]
        filters = np.einsum("nf,nfwe->wef", back, self.embedding[seen], optimize=True)
        spread = back[:, :, None, None] * self.filters.reshape(wide, EMBEDDING, -1).transpose(2, 0, 1)
        flat, spread = seen.ravel(), spread.reshape(-1, EMBEDDING)
        embedding = np.stack([np.bincount(flat, spread[:, e], 256) for e in range(EMBEDDING)], axis=1)
        return loss, {
            "embedding": embedding,
            "filters": filters.reshape(wide * EMBEDDING, -1) * self.reach(),
            "filter_bias": back.sum(0),
            "weights": active.T @ error,
            "bias": error.sum(0),
        }


def train(windows: np.ndarray, wanted: np.ndarray, languages: list[str]) -> Network:
    """A network fitted to windows and the numbers of their languages."""
    random = np.random.default_rng(SEED)
    network = Network.new(languages, random)
    mean = {p: np.zeros_like(getattr(network, p)) for p in Network.PARAMETERS}
    square = {p: np.zeros_like(getattr(network, p)) for p in Network.PARAMETERS}
    # Small samples are gone through more often.
    rounds = max(EPOCHS, min(60, 1_000 * BATCH // max(1, len(windows))))
    step, steps = 0, rounds * -(-len(windows) // BATCH)
    for _ in range(rounds):
        order = random.permutation(len(windows))
        for low in range(0, len(order), BATCH):
            chosen = order[low : low + BATCH]
            step += 1
            rate = RATE * (1 - 0.95 * step / steps)
            for name, slope in network.slopes(windows[chosen], wanted[chosen])[1].items():
                mean[name] += 0.1 * (slope - mean[name])
                square[name] += 0.001 * (slope * slope - square[name])
                size = np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8
                value = getattr(network, name)
                value -= (rate * mean[name] / (1 - 0.9**step) / size).astype(np.float32)
    return network


# ---- the table


def fold_of(doc_id: Column) -> Column:
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % FOLDS


def sample(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """lang, place in the draw and windows of the texts to learn from."""
    known = docs.select(
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
        fold_of(F.col("doc_id").cast("long")).alias("fold"),
    ).where(f"fold != {HELD_OUT} and lang is not null and text is not null and text != ''")
    hashed = known.select("lang", "text", F.xxhash64("text").alias("place"))
    # How many texts each language has decides its rate; a language more or less costs a row here.
    sizes = hashed.groupBy("lang").agg(F.approx_count_distinct("place", 0.02).alias("texts"))
    sizes = materialise(sizes, "language-sizes")
    share = max(1, sample_docs // max(1, sizes.count()))
    drawn_at = F.pmod(F.xxhash64("place", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # Twice the share passes, so that the share is full; what is over is cut after copies are gone.
    passed = hashed.join(sizes, "lang").where(drawn_at * F.col("texts") < 2 * share)
    once = passed.groupBy("lang", "place").agg(F.first("text").alias("text"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy(drawn_at, "place"))
    kept = once.withColumn("number", number).where(F.col("number") <= share)

    def cut(batches):
        for batch in batches:
            langs, places, texts = (batch.column(k).to_pylist() for k in range(3))
            rows = [
                (lang, place, drawn(text.encode(), place).tobytes(), 1)
                for lang, place, text in zip(langs, places, texts, strict=True)
                if has_letter(text)
            ]
            if rows:
                yield batch_of(SAMPLE, list(zip(*rows, strict=True)))

    return kept.select("lang", "place", "text").mapInArrow(cut, SAMPLE_DDL)


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Network | None:
    """The network of the labelled rows outside the held-out fold; None if there are none."""
    # Bounded: share texts of a language, FULL_WINDOWS + SNIPPETS windows of a text.
    rows = sorted(sample(docs, sample_docs).collect(), key=lambda r: (r.lang, r.place))
    if not rows:
        return None
    languages = sorted({r.lang for r in rows})
    number = {lang: k for k, lang in enumerate(languages)}
    cut = [np.frombuffer(r.windows, np.uint8).reshape(-1, WINDOW) for r in rows]
    wanted = np.repeat([number[r.lang] for r in rows], [len(w) for w in cut])
    return train(np.concatenate(cut), wanted, languages)


def judge(network: Network, texts: list[str], predict=None) -> tuple[np.ndarray, np.ndarray]:
    """The number of the likeliest language of each text and its mean chance over all windows."""
    totals = np.zeros((len(texts), len(network.languages)))
    weight = np.zeros(len(texts))
    held: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    sizes: list[np.ndarray] = []

    predict = network.predictor() if predict is None else predict

    def flush():
        all_windows, owners, bytes_of = (np.concatenate(x) for x in (held, owner, sizes))
        for low in range(0, len(all_windows), AT_ONCE):
            part = slice(low, low + AT_ONCE)
            np.add.at(totals, owners[part], predict(all_windows[part]) * bytes_of[part, None])
        np.add.at(weight, owners, bytes_of)
        for kept in (held, owner, sizes):
            kept.clear()

    waiting = 0
    for k, text in enumerate(texts):
        cut, bytes_of = windows_of(text.encode())
        held.append(cut)
        owner.append(np.full(len(cut), k))
        sizes.append(bytes_of.astype(float))
        waiting += len(cut)
        if waiting >= 4 * AT_ONCE:
            flush()
            waiting = 0
    if held:
        flush()
    means = totals / np.maximum(weight, 1)[:, None]
    best = means.argmax(1)
    return best, np.clip(means[np.arange(len(texts)), best], 0, 1)


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every text."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(fold_of(F.col("doc_id").cast("long")) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )

    def run(batches):
        look_up = network.predictor() if network is not None else None
        for batch in batches:
            texts = batch.column(2).to_pylist()
            langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if network is not None:
                with_letters = [k for k, text in enumerate(texts) if has_letter(text)]
                best, chances = judge(network, [texts[k] for k in with_letters], look_up)
                for k, lang, chance in zip(with_letters, best.tolist(), chances.tolist(), strict=True):
                    langs[k], scores[k] = network.languages[lang], chance
            yield batch_of(FOUND, [batch.column(0).to_pylist(), batch.column(1).to_pylist(), langs, scores])

    return rows.mapInArrow(run, FOUND_DDL)


def identify(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """The language of every text, by a network of the labelled ones."""
    return predict(docs, fit(docs, sample_docs))

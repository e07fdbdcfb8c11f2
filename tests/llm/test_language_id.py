"""The byte network: held-out accuracy, plain convolution, gradients, defined cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentscope.llm import language_id
from rentscope.llm.language_id import Network, WINDOW

SOUNDS = {"aa": ["ba", "lu", "mi", "no"], "bb": ["öß", "tsch", "ung", "kr"], "cc": ["日本", "かな", "です", "語"]}


def text_of(lang: str, words: int, seed: int) -> str:
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choices(SOUNDS[lang], k=rng.randint(1, 4))) for _ in range(words))


def fold(doc_id) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 4


@pytest.fixture(scope="module")
def labelled():
    rows, doc_id = [], 0
    for lang in SOUNDS:
        for k in range(60):
            rows.append((doc_id, text_of(lang, 3 + 7 * k % 90, k), lang))
            doc_id += 1
    rows += [(doc_id + k, rows[0][1], "aa") for k in range(40)]  # copies
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 34 !?", "cc"), (1003, "\x00 \n", "aa")]
    rows += [(1004, text_of("bb", 60_000, 1), None), (None, text_of("aa", 9, 5), "aa"), (1005, text_of("cc", 2, 3), None)]
    # Learnt only in the held-out fold: this value is not known.
    rows += [(d, text_of("aa", 30, d), "hidden") for d in range(2000, 2040) if fold(d) == 2]
    return rows


@pytest.fixture(scope="module")
def found(spark, labelled):
    frame = spark.createDataFrame(labelled, "doc_id long, text string, lang string").repartition(3)
    for name in ("fold", "place", "texts", "held_out", "windows", "number", "score", "a.b", "_doc"):
        frame = frame.withColumn(name, F.lit("x"))
    return language_id.identify(frame).collect()


def test_all_rows_and_defined_cases(labelled, found):
    assert sorted(r.doc_id or -1 for r in found) == sorted(d or -1 for d, _, _ in labelled)
    assert all(r.held_out == (fold(r.doc_id) == 2) and 0 <= r.score <= 1 for r in found)
    assert {r.lang_pred for r in found} == {"aa", "bb", "cc", "und"}
    unknown = {r.doc_id for r in found if r.lang_pred == "und"}
    assert unknown == {1000, 1001, 1002, 1003} and {r.score for r in found if r.lang_pred == "und"} == {0.0}


def test_accuracy(labelled, found):
    wanted = {d: lang for d, text, lang in labelled if lang in SOUNDS and text and any(map(str.isalpha, text))}
    judged = [r for r in found if r.held_out and r.doc_id in wanted]
    assert len(judged) > 30
    assert sum(r.lang_pred == wanted[r.doc_id] for r in judged) / len(judged) > 0.95
    assert next(r for r in found if r.doc_id == 1004).lang_pred == "bb"


def test_nothing_of_the_held_out_fold_is_learnt(spark, labelled, found):
    """Other labels and a shuffled source of held-out rows change no prediction."""
    rows = [(d, t, "bb" if fold(d) == 2 else lang) for d, t, lang in reversed(labelled)]
    again = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    key = lambda r: (r.doc_id or -1, r.lang_pred)
    assert sorted(map(key, again)) == sorted(map(key, found))


def test_nothing_to_learn(spark):
    frame = spark.createDataFrame([(1, "some text", None), (2, None, "aa")], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in language_id.identify(frame).collect()} == {("und", 0.0)}
    assert language_id.identify(frame.limit(0)).collect() == []


def test_windows_cover_every_run_of_bytes():
    for size in (0, 1, 3, 255, 256, 257, 509, 510, 5000):
        data = bytes(random.Random(size).choices(range(1, 256), k=size))
        windows, sizes = language_id.windows_of(data)
        held = b"\n".join(bytes(w[:s]) for w, s in zip(windows, sizes, strict=True))
        assert all(data[k : k + 4] in held for k in range(max(1, size - 3)))
        assert windows.shape[1] == WINDOW and (sizes >= 0).all()


def plain_chances(network: Network, window: np.ndarray) -> np.ndarray:
    """Filter by filter and place by place."""
    best = []
    widths = [w for w in language_id.WIDTHS for _ in range(language_id.FILTERS)]
    for f, width in enumerate(widths):
        rows = network.filters[:, f].reshape(-1, language_id.EMBEDDING)[:width]
        best.append(
            max(
                sum(float(rows[k] @ network.embedding[window[p + k]]) for k in range(width))
                for p in range(WINDOW - max(language_id.WIDTHS) + 1)
            )
        )
    logits = np.maximum(np.array(best) + network.filter_bias, 0) @ network.weights + network.bias
    return np.exp(logits) / np.exp(logits).sum()


def test_network_against_plain_loops():
    rng = np.random.default_rng(1)
    network = Network.new(["a", "b", "c"], rng)
    network.filter_bias += rng.normal(size=network.filter_bias.shape).astype(np.float32)
    windows = rng.integers(0, 256, (3, WINDOW)).astype(np.uint8)
    predicted = network.predictor()(windows)
    for k in range(3):
        assert predicted[k] == pytest.approx(plain_chances(network, windows[k]), rel=1e-4)
    assert predicted == pytest.approx(network.chances(network.responses(windows).max(1)), rel=1e-4)


def test_gradient_against_differences():
    rng = np.random.default_rng(2)
    network = Network.new(["a", "b"], rng)
    for name in Network.PARAMETERS:
        setattr(network, name, getattr(network, name).astype(float))
    windows, wanted = rng.integers(97, 105, (4, WINDOW)).astype(np.uint8), np.array([0, 1, 1, 0])
    _, slopes = network.slopes(windows, wanted)
    for name in Network.PARAMETERS:
        value = getattr(network, name)
        strongest = np.unravel_index(np.abs(slopes[name]).argmax(), value.shape)
        before = value[strongest]
        losses = []
        for step in (1e-6, -1e-6):
            value[strongest] = before + step
            losses.append(network.slopes(windows, wanted)[0])
        value[strongest] = before
        assert (losses[0] - losses[1]) / 2e-6 == pytest.approx(slopes[name][strongest], rel=1e-3), name


def test_sample_is_bounded_and_counts_copies_once(spark, labelled):
    frame = spark.createDataFrame(labelled, "doc_id long, text string, lang string")
    rows = language_id.sample(frame, sample_docs=30).collect()
    assert {r.lang for r in rows} == {"aa", "bb", "cc"}
    assert len(rows) <= 30 and len({(r.lang, r.place) for r in rows}) == len(rows)

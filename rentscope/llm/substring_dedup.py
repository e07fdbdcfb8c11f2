"""Repeated passages by seed and extend.

A window is ``WINDOW`` consecutive words of one text. Winnowing takes from every window its
anchor: the run of ``SEED`` words with the least hash, the last of equal ones. Equal windows
have the same anchor at the same place, so texts that share a window meet in a join on anchors:

1. seed: anchors are counted, and only those that occur at least twice go on;
2. extend: the windows around one occurrence of an anchor form its extent, as far to both
   sides as that anchor reaches. Occurrences with equal extents are one class with a count. If
   an anchor has several classes, one member of each hands out its windows, and those are matched.
   So a passage in m texts costs rows in proportion to m, where comparing its occurrences pair by
   pair would cost the square;
3. the matched windows of a text that follow each other are its maximal repeats, and every
   word in them is removed.

All joins are on anchors or texts after partial counts, so a passage of a third of all texts is
spread over tasks.

Words, extents and windows are compared by 64-bit hashes; two windows count as equal if the
hashes of both anchor and window agree, 128 bits.

Defined cases: a null text has no words; texts shorter than a window lose nothing; rows are
told apart by their doc_id and a hash of the text, and rows that repeat both are copies of each other; an
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentscope.llm.common import WordHashes, batch_of, draws, keyed_texts, mix, named, signed
from rentscope.llm.subwords import slices
from rentscope.session import materialise

WINDOW, SEED = 35, 8
# Windows of an extent at most, so that they are bits of a positive 64-bit mask.
MASK_BITS = 62
_FACTOR = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACE = draws(21, 64)
SEEDS = pa.schema(
    [("doc_id", pa.int64()), ("text_key", pa.int64()), ("anchor", pa.int64()), ("extent", pa.int64()), ("windows", pa.int32())]
)
SEEDS_DDL = "doc_id long, text_key long, anchor long, extent long, windows int"
WINDOWS = pa.schema([("anchor", pa.int64()), ("extent", pa.int64()), ("i", pa.int32()), ("content", pa.int64())])
WINDOWS_DDL = "anchor long, extent long, i int, content long"
CLEAN_DDL = "doc_id long, n_words long, n_removed long, kept_text string"
CLEAN = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())]
)
DIGEST_DDL = "doc_id long, n_words long, n_removed long, kept_sha256 string"


# ---- one text


class Extents:
    """The anchors of a text's windows and the extents they reach over."""

    def __init__(self, hashes: np.ndarray, window: int, seed: int):
        self.window, count = window, len(hashes) - window + 1
        if count < 1:
            self.anchors = self.starts = self.counts = self.contents = self.extents = np.zeros(0, np.int64)
            return
        grams = len(hashes) - seed + 1
        gram = np.zeros(grams, np.uint64)
        for j in range(seed):
            gram += mix(hashes[j : j + grams] ^ _PLACE[j])
        gram = mix(gram)
        chosen = _last_least(gram, window - seed + 1)
        begins = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
        if window - seed + 1 > MASK_BITS:
            # Longer extents are split; equal windows still meet, by anchor and content.
            ends = np.append(begins[1:], count)
            begins = np.concatenate([np.arange(a, b, MASK_BITS) for a, b in zip(begins, ends, strict=True)])
        self.starts = begins
        self.counts = np.diff(np.concatenate([begins, [count]]))
        self.anchors = signed(gram[chosen[begins]])
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(hashes), _FACTOR)]), dtype=np.uint64)
        back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(hashes), _INVERSE)]), dtype=np.uint64)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes) * power[:-1], dtype=np.uint64)])
        at = np.arange(count)
        self.contents = signed(mix((sums[at + window] - sums[at]) * back[at]))
        ends = begins + self.counts - 1 + window
        reach = (sums[ends] - sums[begins]) * back[begins]
        shape = self.counts.astype(np.uint64) * _PLACE[62] + (chosen[begins] - begins).astype(np.uint64) * _PLACE[63]
        self.extents = signed(mix(reach ^ mix(shape)))

    def covered(self, words: int, flags: np.ndarray) -> np.ndarray:
        """Which words lie in a window whose flag is set."""
        edges = np.zeros(words + 1, np.int64)
        places = np.flatnonzero(flags)
        np.add.at(edges, places, 1)
        np.add.at(edges, places + self.window, -1)
        return np.cumsum(edges[:-1]) > 0


def _last_least(values: np.ndarray, width: int) -> np.ndarray:
    """For every run of so many values, where its least one is; of equal ones the last."""
    where, reach = np.arange(len(values)), 1

    def later(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(values[a] < values[b], a, b)

    while 2 * reach <= width:
        where, reach = later(where[:-reach], where[reach:]), 2 * reach
    rest = width - reach
    return later(where[: len(where) - rest], where[rest:]) if rest else where


# ---- the table


def _texts(docs: DataFrame) -> DataFrame:
    return keyed_texts(docs).select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def _seeds(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """One row per extent of every text."""

    def run(batches):
        known = WordHashes()
        for batch in batches:
            numbers, keys, counts, parts = batch.column(0), batch.column(1), [], []
            for text in batch.column(2):
                found = Extents(known.of(text.as_py().encode().split()), window, seed)
                counts.append(len(found.anchors))
                parts.append((found.anchors, found.extents, found.counts))
            rows = np.repeat(np.arange(len(counts)), counts)
            if not len(rows):
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    numbers.take(pa.array(rows)),
                    keys.take(pa.array(rows)),
                    pa.array(np.concatenate([p[0] for p in parts]).astype(np.int64)),
                    pa.array(np.concatenate([p[1] for p in parts]).astype(np.int64)),
                    pa.array(np.concatenate([p[2] for p in parts]).astype(np.int32)),
                ],
                schema=SEEDS,
            )

    return _texts(docs).mapInArrow(run, SEEDS_DDL)


def _handed_out(texts: DataFrame, wanted: DataFrame, window: int, seed: int) -> DataFrame:
    """The windows of the wanted extents (doc_id, text_key, extent), one row each."""

    def run(batches):
        known = WordHashes()
        for batch in batches:
            columns = [[], [], [], []]
            for text, extents in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found, left = Extents(known.of(text.as_py().encode().split()), window, seed), set(extents)
                for anchor, extent, start, count in zip(
                    found.anchors.tolist(), found.extents.tolist(), found.starts.tolist(), found.counts.tolist(), strict=True
                ):
                    if extent in left:  # an extent that occurs twice is handed out once
                        left.remove(extent)
                        columns[0].append(np.full(count, anchor))
                        columns[1].append(np.full(count, extent))
                        columns[2].append(np.arange(count, dtype=np.int32))
                        columns[3].append(found.contents[start : start + count])
            if columns[0]:
                yield batch_of(WINDOWS, [np.concatenate(c) for c in columns])

    lists = wanted.groupBy("doc_id", "text_key").agg(F.collect_list("extent").alias("extents"))
    return _with_lists(texts, lists, "inner").select("text", "extents").mapInArrow(run, WINDOWS_DDL)


def _with_lists(texts: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """The texts (with doc_id, text_key and text) and their lists."""
    lists = lists.withColumnsRenamed({"doc_id": "_doc", "text_key": "_key"})
    same = texts["doc_id"].eqNullSafe(lists["_doc"]) & (texts["text_key"] == lists["_key"])
    return texts.join(lists, same, how).drop("_doc", "_key")


def repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """The extents with windows that occur elsewhere: doc_id, text_key, extent, mask.

    Bit i of the mask stands for window i of the extent. A text is listed once even if its
    row repeats.
    """
    # Read twice, once to count anchors and once to join the counts back: texts are hashed once for both.
    seeds = materialise(_seeds(docs, window, seed), "repeat-all-seeds")
    often = seeds.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor")
    # Counts are stored before they are joined back, so that a hot anchor can be split.
    found = materialise(seeds.join(materialise(often, "repeat-anchors"), "anchor"), "repeat-seeds")
    classes = materialise(
        found.groupBy("anchor", "extent").agg(
            F.count(F.lit(1)).alias("c"),
            F.max("windows").alias("windows"),
            F.min(F.struct("doc_id", "text_key")).alias("one"),
        ),
        "repeat-classes",
    )
    several = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("anchor")
    unsure = materialise(classes.join(materialise(several, "repeat-several"), "anchor"), "repeat-unsure")
    out = materialise(
        _handed_out(_texts(docs), unsure.select("one.doc_id", "one.text_key", "extent"), window, seed),
        "repeat-windows",
    )
    # A class hands out a content once, or again if its row repeats: so look for two classes.
    shared = (
        out.groupBy("anchor", "content")
        .agg(F.min("extent").alias("lo"), F.max("extent").alias("hi"))
        .where("lo < hi")
        .select("anchor", "content")
    )
    shared = materialise(shared, "repeat-shared")
    partly = (
        out.join(shared, ["anchor", "content"])
        .groupBy("anchor", "extent")
        .agg(F.bit_or(F.expr("shiftleft(1L, i)")).alias("mask"))
    )
    wholly = classes.where("c > 1").select(
        "anchor", "extent", F.expr("shiftleft(1L, windows) - 1").alias("mask")
    )
    masks = materialise(
        wholly.unionByName(partly).groupBy("anchor", "extent").agg(F.bit_or("mask").alias("mask")), "repeat-masks"
    )
    places = found.select("doc_id", "text_key", "anchor", "extent").distinct()
    return materialise(places.join(masks, ["anchor", "extent"]).drop("anchor"), "repeat-places")


def _cleaned(docs: DataFrame, build, ddl, window: int, seed: int) -> DataFrame:
    """build(rows as Arrow, words per row, removed per row) for slices of the whole table.

    ``removed`` flags a row's words, or is None if nothing is removed. The rows have the other
    columns of the table and whether the text is null under ``_row``, besides doc_id and text (null: empty).
    """
    lists = repeats(docs, window, seed).groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("extent", "mask")).alias("found")
    )

    def removed_of(words: list[bytes], found: list, known: WordHashes) -> np.ndarray:
        masks = {x["extent"]: x["mask"] for x in found}
        extents = Extents(known.of(words), window, seed)
        flags = np.zeros(len(words) - window + 1, bool)
        for extent, start, count in zip(
            extents.extents.tolist(), extents.starts.tolist(), extents.counts.tolist(), strict=True
        ):
            if mask := masks.get(extent):
                flags[start : start + count] = [mask >> i & 1 for i in range(count)]
        return extents.covered(len(words), flags)

    def run(batches):
        known = WordHashes()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for low, high in slices(texts):
                part = batch.slice(low, high - low)
                words = [t.encode().split() for t in texts[low:high]]
                removed = [
                    removed_of(w, found, known) if found else None
                    for w, found in zip(words, part.column("found").to_pylist(), strict=True)
                ]
                yield build(part, words, removed)

    # The text goes beside the row, not in it as well.
    rest = [named(c) for c in docs.columns if c != "text"]
    whole = F.struct(*rest, F.col("text").isNull().alias("_null")).alias("_row")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *([whole] if ddl is None else []),
    ).withColumn("text_key", F.xxhash64("text"))
    return _with_lists(texts, lists, "left").drop("text_key").mapInArrow(run, ddl or docs.schema)


def _kept(words: list[bytes], removed: np.ndarray | None) -> bytes:
    if removed is None:
        return b" ".join(words)
    return b" ".join([w for w, gone in zip(words, removed.tolist(), strict=True) if not gone])


def _counts(part: pa.RecordBatch, words: list, removed: list) -> list:
    return [
        part.column("doc_id").to_pylist(),
        [len(w) for w in words],
        [0 if r is None else int(r.sum()) for r in removed],
    ]


def clean(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by a space (kept_text)."""

    def build(part, words, removed):
        texts = [_kept(w, r).decode() for w, r in zip(words, removed, strict=True)]
        return batch_of(CLEAN, [*_counts(part, words, removed), texts])

    return _cleaned(docs, build, CLEAN_DDL, window, seed)


def digests(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """As clean(), with the kept text's SHA-256 in its place."""
    schema = CLEAN.set(3, pa.field("kept_sha256", pa.string()))

    def build(part, words, removed):
        sums = [hashlib.sha256(_kept(w, r)).hexdigest() for w, r in zip(words, removed, strict=True)]
        return batch_of(schema, [*_counts(part, words, removed), sums])

    return _cleaned(docs, build, DIGEST_DDL, window, seed)


def strip(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Every row with all its columns; the text of a row that loses words becomes its kept words
    joined by a space, and n_chars (if there is one) their length. Other rows stay as they are."""

    at = docs.columns.index("text")

    def build(part, words, removed):
        row = part.column("_row")
        *columns, null = (row.field(i) for i in range(row.type.num_fields))
        names = [row.type.field(i).name for i in range(row.type.num_fields - 1)]
        texts = [None if n else t for n, t in zip(null.to_pylist(), part.column("text").to_pylist(), strict=True)]
        size = names.index("n_chars") if "n_chars" in names else None
        lengths = None if size is None else columns[size].to_pylist()
        for i, (w, r) in enumerate(zip(words, removed, strict=True)):
            if r is not None and r.any():
                texts[i] = _kept(w, r).decode()
                if lengths is not None:
                    lengths[i] = len(texts[i])
        if lengths is not None:
            columns[size] = pa.array(lengths, columns[size].type)
        columns.insert(at, pa.array(texts, pa.string()))
        names.insert(at, "text")
        return pa.RecordBatch.from_arrays(columns, names=names)

    return _cleaned(docs, build, None, window, seed)

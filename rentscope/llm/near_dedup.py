"""Near duplicates by fast similarity sketching, banding and exact verification.

A text's set holds its distinct shingles of ``SHINGLE`` words (``mark`` takes the four words
that the contract of op4_near_dedup names). Sketching throws the set into
``COORDINATES`` bins in rounds: round i hashes every element to a bin and a value, and a bin
that is still empty keeps the least value thrown into it. After as many rounds as there are
bins, round COORDINATES + j throws everything into bin j, so every coordinate is filled. Small sets
need several rounds, large ones one or two, and the share of equal coordinates is concentrated
around the similarity.

Bands of ``BAND_ROWS`` coordinates give bucket keys. 40 bands of 5 miss a pair of similarity 0.8
with a probability of 1.3e-7. Then:

1. rows with equal sets become one class, so copies cost one row each from here on;
2. every class of a bucket is compared with one head of it (a star, not all pairs);
3. where the links found leave several components in a bucket, the pairs across its components
   are compared as well, so no link that could join two components is missed. A bound from
   rare shingles rules most of them out before pairs are made;
4. a link counts if the whole sets of words, taken from the texts, have
   100 * intersection >= 80 * union.

Buckets are counted with partial sums and joined, so a bucket with a third of all rows is spread
over tasks. Nothing is collected.

Defined cases: a text with fewer words than a shingle has its whole sequence as one; without
words, or null, the set is empty, linked with nothing, and the row is a component of its own;
a null doc_id ranks behind all others; rows that repeat a doc_id are separate rows of their
classes; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentscope.llm.common import WordHashes, batch_of, draws, fresh, keyed_texts, mix, signed
from rentscope.llm.components import components
from rentscope.session import materialise

SHINGLE = 5
#: The contract of op4_near_dedup names four words.
MARK_SHINGLE = 4
PERCENT = 80
BANDS, BAND_ROWS = 40, 5
RARE = 8
COORDINATES = BANDS * BAND_ROWS
SKETCH_DDL = "doc_id long, text_key long, n_shingles long, same binary, bands array<long>"
SKETCH = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_key", pa.int64()),
        ("n_shingles", pa.int64()),
        ("same", pa.binary()),
        ("bands", pa.list_(pa.int64())),
    ]
)
LINK_DDL = "a long, b long, linked boolean"
LINK = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])

_POSITION = draws(11, 16)
_ROUND = draws(12, 2 * COORDINATES)
_BAND = draws(13, COORDINATES).reshape(BANDS, BAND_ROWS)


# ---- one text


def normal_words(text: str) -> list[bytes]:
    """Words of the text in lower case; only A-Z change, and only ASCII white space splits."""
    return text.encode().lower().split()


def shingle_set(words: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    """The distinct shingles themselves."""
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size)), strict=False))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, sorted."""
    if not len(hashes):
        return hashes
    width = min(size, len(hashes))
    count = len(hashes) - width + 1
    total = np.full(count, np.uint64(width), np.uint64)
    for i in range(width):
        total += mix(hashes[i : i + count] * _POSITION[i] + _POSITION[i])
    return np.unique(mix(total))


def sketch(elements: np.ndarray) -> np.ndarray:
    """One value per coordinate of a set that is not empty."""
    bins = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    empty = np.ones(COORDINATES, bool)
    done, at_once = 0, max(1, 2 * COORDINATES // len(elements))
    while empty.any() and done < COORDINATES:
        rounds = np.arange(done, min(done + at_once, COORDINATES))
        values = mix(elements[None, :] ^ _ROUND[rounds][:, None]).ravel()
        places = ((values >> np.uint64(32)) % np.uint64(COORDINATES)).astype(np.int64)
        values = mix(values)
        if len(rounds) > 1:
            # Values lie round by round: a bin's first one tells the round that fills it.
            hit, first = np.unique(places, return_index=True)
            filled_in = np.full(COORDINATES, -1)
            filled_in[hit] = first // len(elements)
            own = filled_in[places] == np.repeat(np.arange(len(rounds)), len(elements))
            places, values = places[own], values[own]
        new = empty[places]
        np.minimum.at(bins, places[new], values[new])
        empty[places] = False
        done += len(rounds)
    for j in np.flatnonzero(empty):
        bins[j] = mix(mix(elements ^ _ROUND[COORDINATES + j])).min()
    return bins


def band_keys(bins: np.ndarray) -> np.ndarray:
    return mix((mix(bins.reshape(BANDS, BAND_ROWS)) * _BAND).sum(axis=1, dtype=np.uint64) + _BAND[:, 0])


# ---- the table


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """One narrow row per document: set size, digest of the set, band keys."""

    def run(batches):
        known = WordHashes()
        for batch in batches:
            numbers, keys = batch.column(0), batch.column(2)
            counts, same, bands = [], [], []
            for text in batch.column(1).to_pylist():
                elements = shingle_hashes(known.of(normal_words(text)), size)
                counts.append(len(elements))
                if len(elements):
                    same.append(hashlib.blake2b(elements.tobytes(), digest_size=16).digest())
                    bands.append(signed(band_keys(sketch(elements))))
                else:
                    same.append(None)
                    bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [numbers, keys, *(pa.array(c, t) for c, t in zip([counts, same, bands], SKETCH.types[2:], strict=True))],
                schema=SKETCH,
            )

    rows = keyed_texts(docs).withColumn("text_key", F.xxhash64("text"))
    return materialise(rows.mapInArrow(run, SKETCH_DDL), "near-sketches")


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b, linked) for pairs of classes, from the sets of shingles of their whole texts."""

    def run(batches):
        last, set_a = None, set()
        for batch in batches:
            linked = []
            a_ids, b_ids = batch.column(0), batch.column(1)
            texts_a, texts_b = batch.column(2), batch.column(3)
            for i, a in enumerate(a_ids.to_pylist()):
                if a != last:
                    last, set_a = a, shingle_set(normal_words(texts_a[i].as_py()), size)
                set_b = shingle_set(normal_words(texts_b[i].as_py()), size)
                shared = len(set_a & set_b)
                linked.append(100 * shared >= percent * (len(set_a) + len(set_b) - shared))
            yield pa.RecordBatch.from_arrays([a_ids, b_ids, pa.array(linked, pa.bool_())], schema=LINK)

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    # Pairs grow with the table, so they are joined alike at every size: none is broadcast.
    rows = pairs.hint("merge").join(one, "a").hint("merge").join(two, "b").select("a", "b", "text_a", "text_b")
    return materialise(rows.mapInArrow(run, LINK_DDL), "near-links")


def _fits(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose set sizes alone do not rule a link out."""
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    return pairs.where(small * 100 >= large * percent).select("a", "b").distinct()


def mark(docs: DataFrame, size: int = MARK_SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return _marked(docs, size, percent).drop("text_key", "first")


def _marked(docs: DataFrame, size: int, percent: int) -> DataFrame:
    found = sketches(docs, size)
    # A class is known by its least (doc_id, text_key); node numbers it for the joins to come.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_key"))
    classes = (
        found.where("same is not null")
        .groupBy("same")
        .agg(first.alias("first"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
        .select("same", "first.doc_id", "first.text_key", "n", "bands")
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = materialise(classes, "near-classes")
    labels = _labels(docs, classes, size, percent)
    least = (
        classes.join(labels, "node", "left")
        .select("same", "doc_id", "text_key", F.coalesce("label", "node").alias("label"))
    )
    smallest = least.groupBy("label").agg(first.alias("top"))
    smallest = smallest.select("label", F.col("top.doc_id").alias("component_id"), F.col("top.text_key").alias("first_key"))
    of_class = materialise(
        least.join(smallest, "label").select("same", "component_id", "first_key"), "near-components"
    )
    return (
        found.select("doc_id", "text_key", "n_shingles", "same")
        .join(of_class.withColumn("_known", F.lit(True)), "same", "left")
        .withColumn("component_id", F.when(F.col("_known"), F.col("component_id")).otherwise(F.col("doc_id")))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .withColumn("first", F.col("kept") & (F.col("_known").isNull() | (F.col("text_key") == F.col("first_key"))))
        .select("doc_id", "text_key", "n_shingles", "component_id", "kept", "first")
    )


def _labels(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, label) of the classes that are linked with others."""
    members = _buckets(classes)
    star = members.where("node <> head").select(
        F.col("head").alias("a"), F.col("head_n").alias("n_a"), F.col("node").alias("b"), F.col("n").alias("n_b")
    )
    star = materialise(_fits(star, percent), "near-star")
    texts = _texts(docs, classes, members)
    links = verified(star, texts, size, percent)
    labels = components(links.where("linked"))
    across = _across(members, labels, texts, size, percent)
    pairs = across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    done = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = verified(materialise(pairs.join(done, ["a", "b"], "left_anti"), "near-across"), texts, size, percent)
    more = more.where("linked")
    if more.isEmpty():
        return labels
    return components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more.select("a", "b")))


def _buckets(classes: DataFrame) -> DataFrame:
    """(key, node, n, head, head_n): the classes of every bucket of two or more, and its head.

    The head is the class whose own buckets are the fullest: among copies with edits of their
    own that is the text they come from, which most of them are linked with.
    """
    keys = classes.select("node", "n", F.explode("bands").alias("key"))
    counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    # Counts are stored before they are joined back, so that a hot bucket can be split.
    members = materialise(keys.join(materialise(counts, "near-counts"), "key"), "near-members")
    weights = materialise(members.groupBy("node").agg(F.sum("c").alias("w")), "near-weights")
    heads = members.join(weights, "node").groupBy("key").agg(F.max(F.struct("w", -F.col("node"), "n")).alias("top"))
    heads = heads.select("key", (-F.col("top.col2")).alias("head"), F.col("top.n").alias("head_n"))
    heads = materialise(heads, "near-heads")
    return materialise(members.drop("c").join(heads, "key"), "near-buckets")


def _possible(shared: Column, total: Column, percent: int) -> Column:
    """Whether so many shared shingles of two sets of this total size make a link."""
    return shared * 100 >= (total - shared) * percent


def _across(members: DataFrame, labels: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share a bucket and may still be linked.

    A shingle is rare if at most ``RARE`` classes of these buckets have it. A pair that shares no rare
    shingle shares at most what either class has besides its rare ones; this bound drops most
    classes of a large bucket one by one, before pairs are made. Pairs that do share rare
    shingles are found by joining those, each of which meets few classes, and their number
    goes into the bound. So no link is dropped.
    """
    placed = members.join(labels, "node", "left").select("key", "node", "n", F.coalesce("label", "node").alias("label"))

    def still_mixed(rows: DataFrame, name: str) -> DataFrame:
        spans = rows.groupBy("key").agg(
            F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("n").alias("least_n")
        )
        spans = materialise(spans.where("lo < hi").select("key", "least_n"), name)
        return rows.join(spans, "key")

    mixed = materialise(still_mixed(placed, "near-mixed-keys"), "near-mixed")
    nodes = materialise(mixed.select("node", "n", "label").distinct(), "near-nodes")
    rare = _rare_shingles(texts.join(nodes.select("node"), "node", "left_semi"), size)
    own = rare.groupBy("node").agg(F.count(F.lit(1)).alias("rare"))
    nodes = materialise(
        nodes.join(own, "node", "left").withColumn("most", F.col("n") - F.coalesce("rare", F.lit(0))).drop("rare"),
        "near-bounds",
    )

    def sides(rows: DataFrame, key: str, *more: str) -> DataFrame:
        """Pairs of rows with one key and different labels, the lower label first."""
        columns = ("node", "n", "label", "most", *more)
        a, b = (rows.select(key, *(F.col(c).alias(f"{c}_{x}") for c in columns)) for x in "ab")
        return a.join(b, key).where("label_a < label_b")

    total, most = F.col("n_a") + F.col("n_b"), F.least("most_a", "most_b")
    bounded = mixed.join(nodes.select("node", "most"), "node").where(
        _possible(F.col("most"), F.col("n") + F.greatest("most", "least_n"), percent)
    )
    bounded = materialise(bounded.drop("least_n"), "near-bounded")
    rest = materialise(still_mixed(bounded, "near-rest-keys"), "near-rest")
    # A pair may share many buckets; it is made in the first of them only.
    shared = rest.groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    rest = materialise(rest.join(shared, "node"), "near-rest-buckets")
    once = F.col("key") == F.array_min(F.array_intersect("keys_a", "keys_b"))
    without = sides(rest, "key", "keys").where(_possible(most, total, percent)).where(once).select("node_a", "node_b")
    by_rare = sides(rare.where("c > 1").join(nodes, "node"), "shingle")
    by_rare = by_rare.groupBy("node_a", "node_b", "n_a", "n_b", "most_a", "most_b").agg(F.count(F.lit(1)).alias("k"))
    sharing = by_rare.where(_possible(F.least(most + F.col("k"), "n_a", "n_b"), total, percent))
    return without.unionByName(sharing.select("node_a", "node_b")).toDF("a", "b")


def _rare_shingles(texts: DataFrame, size: int) -> DataFrame:
    """(shingle, node, c) of the shingles that c <= RARE of these texts have."""

    def run(batches):
        known = WordHashes()
        schema = pa.schema([("node", pa.int64()), ("shingle", pa.int64())])
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                found = [shingle_hashes(known.of(normal_words(t.as_py())), size) for t in part.column(1)]
                nodes = np.repeat(part.column(0).to_numpy(), [len(x) for x in found])
                yield batch_of(schema, [nodes, signed(np.concatenate(found))])

    rows = texts.select("node", "text").mapInArrow(run, "node long, shingle long")
    counts = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") <= RARE)
    counts = materialise(counts, "near-shingle-counts")
    return materialise(rows.join(counts, "shingle"), "near-rare")


def _texts(docs: DataFrame, classes: DataFrame, members: DataFrame) -> DataFrame:
    """The text of one row of every class that shares a bucket."""
    wanted = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "doc_id", "text_key")
    wanted = materialise(wanted, "near-wanted")
    rows = keyed_texts(docs).withColumn("text_key", F.xxhash64("text"))
    same_row = rows["doc_id"].eqNullSafe(wanted["doc_id"]) & (rows["text_key"] == wanted["text_key"])
    # The list grows with the table, so the join is the same at every size: none is broadcast.
    found = materialise(rows.join(wanted.hint("merge"), same_row).select("node", "text"), "near-texts")
    # Rows that repeat whole are found more than once; any of them has the text.
    if found.count() == wanted.count():
        return found
    return materialise(found.dropDuplicates(["node"]), "near-texts")


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The first row of every component by (doc_id, text_key), nulls last, with all its columns.

    Rows that repeat both are not told apart and stay together; the exact stage leaves one of them.
    """
    dropped = _marked(docs, size, percent).where("not first").select("doc_id", "text_key").distinct()
    doc, mark_ = fresh("_doc", docs), fresh("_key", docs)
    dropped = materialise(dropped, "near-dropped").select(
        F.col("doc_id").alias(doc), F.col("text_key").alias(mark_)
    )
    key = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(doc)) & (key == F.col(mark_))
    return docs.join(dropped.hint("merge"), same, "left_anti")

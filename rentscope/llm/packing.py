"""Best-fit packing with certified bin counts.

Documents become pieces of at most ``CAPACITY`` ids; only longer ones are cut, and only the first
piece of a cut one may be shorter. A full piece is a sequence of its own. The others are dealt
into groups of about ``GROUP_ITEMS`` and packed there by best fit, longest first.

Dual feasible functions give each group a lower bound for its bins. A group that meets its
bound is certified: no packing of it is better. Groups with a gap give the documents of their
bins that are not full into a common exchange, and the others those of their emptiest bin, which is dealt
and packed again. Rounds go on until one saves no sequence, and that one is not used.

Defined cases: a null text is empty and has the end id alone; rows are told apart by their
place, so null and repeated doc_ids are separate documents; an empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentscope.llm.common import batch_of, keyed_texts
from rentscope.llm.subwords import slices, unit_encoder
from rentscope.session import materialise

CAPACITY = 1024
GROUP_ITEMS = 25_000
PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
    ]
)
PLACED_DDL = "row long, length long, round long, group long, bin long, offset long, offered boolean"


def cut(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the pieces of documents with so many ids: document, number, start and length."""
    number = -(-counts // capacity)
    doc = np.repeat(np.arange(len(counts)), number)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    # Only the first piece may be shorter.
    end = counts[doc] - (number[doc] - 1 - piece) * capacity
    start = np.maximum(0, end - capacity)
    return doc, piece, start, end - start


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """One row per piece; ids (unsigned 32-bit, little-endian) only if they are wanted."""

    def encode(batches):
        encoder = unit_encoder(tokenizer)
        for batch in batches:
            numbers, texts = batch.column(0), batch.column(1).to_pylist()
            for low, high in slices(texts):
                ids, counts = encoder.flat(texts[low:high], end_id)
                doc, piece, start, length = cut(counts, capacity)
                # Pieces follow each other as their ids do.
                data, ends = memoryview(ids.tobytes()), (4 * np.cumsum(length)).tolist()
                parts = [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                yield batch_of(
                    PIECES,
                    [
                        numbers.slice(low, high - low).take(pa.array(doc)),
                        piece.astype(np.int32),
                        start,
                        length,
                        list(map(zlib.crc32, parts)),
                        [bytes(x) for x in parts] if with_ids else pa.nulls(len(parts), pa.binary()),
                    ],
                )

    return keyed_texts(docs).mapInArrow(encode, PIECES_DDL)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every item, and each bin's fill; longest first, fullest bin that fits."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fills: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin has room r
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen = capacity, len(fills)
            fills.append(0)
        bins[item], offsets[item] = chosen, fills[chosen]
        fills[chosen] += length
        if room > length:
            by_room[room - length].append(chosen)
            rooms |= 1 << (room - length)
    return bins, offsets, np.array(fills, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int, steps: int = 64) -> int:
    """No packing has fewer bins: the largest bound of two families of dual feasible functions.

    The first counts items over capacity - t as full and those under t as nothing; the second
    rounds lengths to multiples of capacity / k unless they are exact ones of 1 / (k + 1).
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    number, total = np.cumsum(count), np.cumsum(count * size)
    t = np.arange(0, capacity // 2 + 1)
    large = number[-1] - number[capacity - t]
    below = np.where(t > 0, total[np.maximum(t - 1, 0)], 0)
    best = int(np.max(large - (-(total[capacity - t] - below) // capacity)))
    for k in range(1, steps + 1):
        exact = (size * (k + 1)) % capacity == 0
        # In units of capacity / (k (k + 1)), so that all is whole.
        units = np.where(exact, size * (k + 1) // capacity * k, size * (k + 1) // capacity * (k + 1))
        best = max(best, -int(-(units * count).sum() // (k * (k + 1))))
    return best


def _round(items: DataFrame, number: int, capacity: int, group_items: int) -> DataFrame:
    """The items (row, length) dealt into groups of bounded size and packed.

    Offered to another round are the bins of groups with a gap that are not full, and of every
    other group the emptiest bin.
    """
    groups = max(1, -(-items.count() // group_items))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "row"], ascending=[False, True], ignore_index=True)
        lengths = frame["length"].to_numpy()
        bins, offsets, fills = best_fit(lengths, capacity)
        gap = len(fills) - lower_bound(lengths, capacity)
        offered = fills < capacity if gap else (np.arange(len(fills)) == fills.argmin()) & (fills < capacity)
        return frame.assign(round=number, bin=bins, offset=offsets, offered=offered[bins])[
            ["row", "length", "round", "group", "bin", "offset", "offered"]
        ]

    group = F.pmod(F.xxhash64("row", F.lit(number)), F.lit(groups)).alias("group")
    packed = items.select("row", "length", group).groupBy("group").applyInPandas(pack, PLACED_DDL)
    return materialise(packed, f"pack-round-{number}")


def place(items: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS) -> DataFrame:
    """row, sequence_id and offset of every item (row, length) with length < capacity.

    Every round but the last saves a sequence at least, so the rounds come to an end.
    """
    done, current, number = [], _round(items, 0, capacity, group_items), 0
    while True:
        offered = current.where("offered")
        before = offered.where("offset = 0").count()
        if before < 2:
            break
        number += 1
        again = _round(offered.select("row", "length"), number, capacity, group_items)
        if again.where("offset = 0").count() >= before:
            break
        done.append(current.where("not offered"))
        current = again
    placed = reduce(DataFrame.unionByName, [*done, current])
    sequence = F.shiftleft(F.col("round"), 48) + F.shiftleft(F.col("group"), 20) + F.col("bin")
    return placed.select("row", sequence.alias("sequence_id"), "offset")


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = CAPACITY,
    group_items: int = GROUP_ITEMS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    cut_up = pieces(docs, tokenizer, end_id, capacity, with_ids)
    if not with_ids:
        cut_up = cut_up.drop("ids")
    cut_up = materialise(cut_up.withColumn("row", F.monotonically_increasing_id()), "pack-pieces")
    full = F.col("length") == capacity
    alone = cut_up.where(full).select(
        "*", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    placed = place(cut_up.where(~full).select("row", "length"), capacity, group_items)
    return alone.unionByName(cut_up.where(~full).join(placed, "row")).drop("row")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id and the ids of its pieces, one after the other."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda ids, part: F.concat(ids, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("length"))

"""Byte-level BPE over overlapping chunks, and back to bytes.

A text of one chunk is encoded where it is read. A longer one is cut into chunks of
``CHUNK`` characters that reach ``OVERLAP`` further, and:

1. every chunk is split by the pattern on its own, in parallel;
2. neighbours are stitched at the first border that both see in their overlap. The pattern looks
   at nothing before a match, so from a common border on both agree, and as the first chunk
   is right, so are all that are stitched to it;
3. each chunk is encoded from its border to the next one's, in parallel;
4. the pieces of a text follow each other in order into its digests.

If two neighbours share no border (a run of one kind of character longer than the overlap),
the rest of that text is joined and split in one piece, which is exact at any length.
Decoding joins the bytes of the ids.

Defined cases: a null text is empty and has no ids; rows are told apart by their place, so
null and repeated doc_ids are separate rows; an empty table gives no rows. Other columns are
not read.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentscope.llm.common import batch_of, keyed_texts
from rentscope.session import materialise

CHUNK, OVERLAP = 32_768, 1_024
# Borders this near to a cut may look different without what follows.
EDGE = 8
LATELY = 300_000
RESULT_DDL = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
RESULT = [
    ("doc_id", pa.int64()),
    ("n_tokens", pa.int64()),
    ("ids_sha256", pa.string()),
    ("decoded_sha256", pa.string()),
]
CUT = pa.schema(
    [("doc_id", pa.int64()), ("row", pa.int64()), ("seq", pa.int32()), ("last", pa.bool_()), ("chunk", pa.string())]
)
CUT_DDL = "doc_id long, row long, seq int, last boolean, chunk string"
BORDERS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("row", pa.int64()),
        ("seq", pa.int32()),
        ("last", pa.bool_()),
        ("chunk", pa.string()),
        ("head", pa.list_(pa.int64())),
        ("tail", pa.list_(pa.int64())),
    ]
)
BORDERS_DDL = "doc_id long, row long, seq int, last boolean, chunk string, head array<long>, tail array<long>"
PIECE = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("run", pa.int64()), ("ids", pa.binary())])
PIECE_DDL = "doc_id long, row long, run long, ids binary"


class RankEncoder(dict):
    """Ids of what the pattern matched, as little-endian unsigned 32-bit integers; those of
    short matches seen lately are kept."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {rank: token for token, rank in ranks.items()}

    def __missing__(self, match: str) -> bytes:
        ids = np.array(self.encoding.encode_ordinary(match), "<u4").tobytes()
        if len(match) <= 48:
            if len(self) >= LATELY:
                self.clear()
            self[match] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pattern.findall(text)))

    def encode_between(self, text: str, start: int, end: int) -> bytes:
        """Ids of the matches that begin in [start, end), split with all of the text in view."""
        parts = []
        for match in self.pattern.finditer(text, start):
            if match.start() >= end:
                break
            parts.append(self[match.group()])
        return b"".join(parts)

    def borders(self, text: str) -> list[int]:
        return [match.start() for match in self.pattern.finditer(text)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def rank_encoder(path: str, pattern: str) -> RankEncoder:
    """One encoder per worker process and vocabulary."""
    return RankEncoder(path, pattern)


def _rows(batches):
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _batches(schema: pa.Schema, rows, limit: int = 4 << 20):
    """Rows as Arrow batches of bounded size; the last column of a row is its long one."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + sum(len(x) for x in row if isinstance(x, (str, bytes)))
        if size >= limit:
            yield batch_of(schema, list(zip(*held, strict=True)))
            held, size = [], 0
    if held:
        yield batch_of(schema, list(zip(*held, strict=True)))


def encode_pieces(
    docs: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """The ids of every document: doc_id, row (told apart by place), run (order of its pieces), ids, alone.

    A text of one chunk is one piece, alone; a longer one has a piece for each run of chunks.
    """
    rows = keyed_texts(docs).withColumn("row", F.monotonically_increasing_id())
    short = F.length("text") <= chunk + overlap

    def whole(batches):
        encoder = rank_encoder(ranks, pattern)
        yield from _batches(PIECE, ((doc_id, row, 0, encoder.encode(text)) for doc_id, text, row in _rows(batches)))

    def cut(batches):
        def produced():
            for doc_id, text, row in _rows(batches):
                for seq, at in enumerate(range(0, len(text) - overlap, chunk)):
                    part = text[at : at + chunk + overlap]
                    yield doc_id, row, seq, at + len(part) == len(text), part

        yield from _batches(CUT, produced())

    alone = rows.where(short).mapInArrow(whole, PIECE_DDL).withColumn("alone", F.lit(True))
    chunks = materialise(rows.where(~short).mapInArrow(cut, CUT_DDL), "bpe-cut")
    pieces = _stitched(chunks, ranks, pattern, chunk, overlap)
    return alone.unionByName(pieces.withColumn("alone", F.lit(False)))


def decode_pieces(pieces: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, row, run, data (bytes) and alone of pieces with ids. A piece may end within a character."""
    schema = pa.schema([*PIECE][:3] + [pa.field("data", pa.binary()), pa.field("alone", pa.bool_())])

    def run(batches):
        encoder = rank_encoder(ranks, pattern)
        rows = ((*row[:3], encoder.decode(row[3]), row[4]) for row in _rows(batches))
        yield from _batches(schema, rows)

    columns = ["doc_id", "row", "run", "ids", "alone"]
    return pieces.select(*columns).mapInArrow(run, "doc_id long, row long, run long, data binary, alone boolean")


def texts(decoded: DataFrame) -> DataFrame:
    """doc_id and text of decoded pieces. A text is one value, so the pieces of one meet in one task."""
    joined = F.aggregate(
        F.array_sort(F.collect_list(F.struct("run", "data"))),
        F.lit(b"").cast("binary"),
        lambda all_, piece: F.concat(all_, piece["data"]),
    )
    long = decoded.where("not alone").groupBy("row").agg(F.first("doc_id").alias("doc_id"), joined.alias("data"))
    both = decoded.where("alone").select("doc_id", "data").unionByName(long.select("doc_id", "data"))
    return both.select("doc_id", F.col("data").cast("string").alias("text"))


def digests(pieces: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, and digests of its ids and of the decoded bytes."""

    def single(batches):
        encoder = rank_encoder(ranks, pattern)
        rows = (
            (doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(encoder.decode(ids)).hexdigest())
            for doc_id, ids in _rows(batches)
        )
        yield from _batches(pa.schema(RESULT), rows)

    alone = pieces.where("alone").select("doc_id", "ids").mapInArrow(single, RESULT_DDL)
    return alone.unionByName(_assembled(pieces.where("not alone"), ranks, pattern))


def encode(
    docs: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """The digests of every document's ids and of what they decode to."""
    return digests(encode_pieces(docs, ranks, pattern, chunk, overlap), ranks, pattern)


def _stitched(chunks: DataFrame, ranks: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """The ids of the pieces of every cut text: doc_id, row, run (their order), ids."""

    def split(batches):
        encoder = rank_encoder(ranks, pattern)

        def produced():
            for doc_id, row, seq, last, text in _rows(batches):
                at = seq * chunk
                sure = len(text) if last else len(text) - EDGE
                borders = [b for b in encoder.borders(text) if b < sure]
                head = [at + b for b in borders if b < overlap]
                yield doc_id, row, seq, last, text, head, [at + b for b in borders if b >= chunk]

        yield from _batches(BORDERS, produced())

    # Chunks of one text lie together; dealing them out lets a long text use all cores.
    dealt = chunks.repartition("row", "seq").mapInArrow(split, BORDERS_DDL)
    borders = materialise(dealt, "bpe-borders")
    order = Window.partitionBy("row").orderBy("seq")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    links = (
        borders.select("row", "seq", "head", "tail")
        .withColumn("sync", F.array_min(F.array_intersect(F.lag("tail").over(order), F.col("head"))))
        .withColumn("sync", F.when(F.col("seq") == 0, F.lit(0).cast("long")).otherwise(F.col("sync")))
        # From the first neighbours without a common border on, a text is one run.
        .withColumn("broken", F.max(F.col("sync").isNull().cast("int")).over(so_far))
        .withColumn("run", F.sum(1 - F.col("broken")).over(so_far).cast("long"))
        .withColumn("sync", F.when(F.col("broken") == 0, F.col("sync")))
        .withColumn("next", F.lead("sync").over(order))
        .select("row", "seq", "run", "sync", "next")
    )
    placed = borders.select("doc_id", "row", "seq", "chunk").join(links, ["row", "seq"])

    def encode_runs(batches):
        encoder = rank_encoder(ranks, pattern)

        def produced():
            rows = _rows(batches)  # doc_id, row, run, seq, sync, next, chunk
            for (row, run), members in groupby(rows, key=lambda r: r[1:3]):
                parts, at, end = [], 0, None
                for doc_id, _, _, seq, sync, following, text in members:
                    if not parts:
                        number, start, at = doc_id, sync, seq * chunk
                    else:
                        text = text[overlap:]
                    parts.append(text)
                    end = following
                whole = "".join(parts)
                end = len(whole) if end is None else end - at
                yield number, row, run, encoder.encode_between(whole, start - at, end)

        yield from _batches(PIECE, produced())

    columns = ["doc_id", "row", "run", "seq", "sync", "next", "chunk"]
    runs = placed.select(*columns).repartition("row", "run").sortWithinPartitions("row", "run", "seq")
    return materialise(runs.mapInArrow(encode_runs, PIECE_DDL), "bpe-pieces")


def _assembled(pieces: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """The digests of every cut text, fed piece by piece; no text is held whole."""
    result = pa.schema(RESULT)

    def assemble(batches):
        encoder = rank_encoder(ranks, pattern)

        def produced():
            for _, members in groupby(_rows(batches), key=lambda r: r[1]):
                count, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
                for doc_id, _, _, ids in members:
                    count += len(ids) // 4
                    of_ids.update(ids)
                    of_bytes.update(encoder.decode(ids))
                yield doc_id, count, of_ids.hexdigest(), of_bytes.hexdigest()

        yield from _batches(result, produced())

    ordered = pieces.repartition("row").sortWithinPartitions("row", "run")
    return ordered.select("doc_id", "row", "run", "ids").mapInArrow(assemble, RESULT_DDL)

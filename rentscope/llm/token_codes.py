"""Token ids in files of directly addressable codes.

A file holds the ids of whole documents in ascending order of doc_id. An id is cut into chunks
of ``CHUNK_BITS`` bits, lowest first. Level k holds chunk k of the ids that have one, a bitmap
with a set bit where the id goes on in level k + 1, and a rank directory: the number of set
bits before every block of ``RANK_BLOCK`` bits. Any id is found by one look-up and one rank per
level; nothing has to be decoded in blocks.

Layout, little-endian: ``DAC1``; ids, documents, levels as unsigned 64-bit integers; per
document its doc_id, a flag for a null doc_id, and its first id's place in the file; then per
level the number of chunks, the chunks, the bitmap and the directory.

Defined cases: a null text is empty and has the end id alone; a null doc_id comes first; rows
of one doc_id follow each other in order of a hash of the text; an empty table gives no file.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rentscope.llm.common import batch_of, keyed_texts
from rentscope.llm.store import attempt_name, new_folder, open_new, open_there
from rentscope.llm.subwords import slices, unit_encoder
from rentscope.session import materialise

MAGIC = b"DAC1"
CHUNK_BITS = 8
RANK_BLOCK = 512
FILE_IDS = 4_000_000
SLICE = 4_000_000  # characters that are encoded at a time
#: Places of all ids are joined to files by ranges of this length.
RANGE = 4_000_000
FILES_DDL = "part int, seq int, path string, ids long, docs long"
FILES = pa.schema(
    [("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("ids", pa.int64()), ("docs", pa.int64())]
)
READ_DDL = "place long, id long"
READ = pa.schema([("place", pa.int64()), ("id", pa.int64())])
CODED_DDL = "doc_id long, start long, n_tokens long, ids_crc32 long"
CODED = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


# ---- one file


def levels_of(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level: the chunks, and which of them go on."""
    levels, rest = [], ids.astype(np.uint64)
    while True:
        chunks = (rest & np.uint64((1 << CHUNK_BITS) - 1)).astype(np.uint8)
        rest = rest >> np.uint64(CHUNK_BITS)
        more = rest > 0
        levels.append((chunks, more))
        if not more.any():
            return levels
        rest = rest[more]


def pack(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of a file."""
    levels = levels_of(ids)
    starts = np.concatenate([[0], np.cumsum(counts)]).astype("<u8")
    parts = [
        MAGIC,
        np.array([len(ids), len(doc_ids), len(levels)], "<u8").tobytes(),
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        starts.tobytes(),
    ]
    for chunks, more in levels:
        blocks = -(-len(more) // RANK_BLOCK)
        padded = np.zeros(blocks * RANK_BLOCK, np.uint8)
        padded[: len(more)] = more
        before = np.concatenate([[0], np.cumsum(padded.reshape(blocks, RANK_BLOCK).sum(1, dtype=np.int64))])
        parts += [
            np.array([len(chunks)], "<u8").tobytes(),
            chunks.tobytes(),
            np.packbits(padded, bitorder="little").tobytes(),
            before[:blocks].astype("<u4").tobytes(),
        ]
    return b"".join(parts)


class TokenFile:
    """A file's documents and random access to its ids.

    The source is bytes or an open file; of a file, only what is asked for is read.
    """

    def __init__(self, source):
        self._source = pa.BufferReader(source) if isinstance(source, bytes) else source
        if self._source.read_at(4, 0) != MAGIC:
            raise ValueError("not a file of token codes")
        self.ids, self.docs, levels = (int(x) for x in self._read("<u8", 3, 4))
        self._at = 28
        # Of each level: the number of chunks, and where chunks, bitmap and directory begin.
        self.levels: list[tuple[int, int, int, int]] = []
        at = self._at + 9 * self.docs + 8 * (self.docs + 1)
        for _ in range(levels):
            count = int(self._read("<u8", 1, at)[0])
            blocks = -(-count // RANK_BLOCK)
            chunks, bitmap = at + 8, at + 8 + count
            directory = bitmap + blocks * RANK_BLOCK // 8
            self.levels.append((count, chunks, bitmap, directory))
            at = directory + 4 * blocks

    def _read(self, kind, count: int, at: int) -> np.ndarray:
        kind = np.dtype(kind)
        return np.frombuffer(self._source.read_at(count * kind.itemsize, at), kind, count)

    @property
    def doc_ids(self) -> list[int | None]:
        numbers = self._read("<i8", self.docs, self._at)
        nulls = self._read(np.uint8, self.docs, self._at + 8 * self.docs)
        return [None if null else d for d, null in zip(numbers.tolist(), nulls.tolist(), strict=True)]

    @property
    def starts(self) -> np.ndarray:
        return self._read("<u8", self.docs + 1, self._at + 9 * self.docs).astype(np.int64)

    def __getitem__(self, place: int) -> int:
        """The id at a place of the file, from one chunk and one rank per level."""
        if not 0 <= place < self.ids:
            raise IndexError(place)
        value = shift = 0
        for _, chunks, bitmap, directory in self.levels:
            value |= int(self._read(np.uint8, 1, chunks + place)[0]) << shift
            shift += CHUNK_BITS
            block, inside = divmod(place, RANK_BLOCK)
            head = self._read(np.uint8, inside // 8 + 1, bitmap + block * RANK_BLOCK // 8)
            bits = np.unpackbits(head, bitorder="little")
            if not bits[inside]:
                break
            place = int(self._read("<u4", 1, directory + 4 * block)[0]) + int(bits[:inside].sum())
        return value

    def at(self, places: np.ndarray) -> np.ndarray:
        """The ids at many places, each from one chunk and one rank per level."""
        values, going = np.zeros(len(places), "<u4"), np.arange(len(places))
        for level, (count, chunks, bitmap, directory) in enumerate(self.levels):
            if not len(going):
                break
            values[going] |= self._read(np.uint8, count, chunks)[places].astype("<u4") << np.uint32(level * CHUNK_BITS)
            blocks = -(-count // RANK_BLOCK)
            words = self._read("<u8", blocks * RANK_BLOCK // 64, bitmap)
            bit = (words[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1)
            going, places = going[bit == 1], places[bit == 1]
            # The rank of a place: the directory's count, whole words of its block, bits of its own word.
            block, per_block = places // RANK_BLOCK, RANK_BLOCK // 64
            inside = words.reshape(-1, per_block)[block]
            earlier = np.arange(per_block) < ((places >> 6) % per_block)[:, None]
            below = words[places >> 6] & ((np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1))
            rank = (np.bitwise_count(inside) * earlier).sum(1, dtype=np.int64) + np.bitwise_count(below)
            places = self._read("<u4", blocks, directory)[block].astype(np.int64) + rank
        return values

    def all_ids(self) -> np.ndarray:
        values = None
        for count, chunks, bitmap, _ in reversed(self.levels):
            level = self._read(np.uint8, count, chunks).astype("<u4")
            if values is not None and len(values):
                bits = self._read(np.uint8, -(-count // RANK_BLOCK) * RANK_BLOCK // 8, bitmap)
                more = np.unpackbits(bits, bitorder="little")[:count].astype(bool)
                level[more] |= values << np.uint32(CHUNK_BITS)
            values = level
        return values


# ---- the table


def write_codes(docs: DataFrame, tokenizer: str, end_id: int, folder: str) -> DataFrame:
    """Encode every text, write the files and return the list of them in order.

    Texts are dealt by ranges of doc_id, so that each task writes a run of the order and no
    task needs to know the others.
    """
    def write(batches):
        from pyspark import TaskContext

        encoder, part, seq = unit_encoder(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        encoded: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def flush():
            path = attempt_name(folder, ".dac")
            ids = np.concatenate(encoded)
            with open_new(path) as out:
                out.write(pack(doc_ids, np.concatenate(counts), ids))
            return batch_of(FILES, [[part], [seq], [path], [len(ids)], [len(doc_ids)]])

        for batch in batches:
            numbers, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for low, high in slices(texts, SLICE):
                ids, sizes = encoder.flat(texts[low:high], end_id)
                doc_ids += numbers[low:high]
                encoded.append(ids)
                counts.append(sizes)
                if sum(map(len, encoded)) >= FILE_IDS:
                    yield flush()
                    doc_ids, encoded, counts, seq = [], [], [], seq + 1
        if doc_ids:
            yield flush()

    rows = keyed_texts(docs)
    order = ["doc_id", F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(dealt.mapInArrow(write, FILES_DDL), "token-files")


def placed(files: DataFrame) -> DataFrame:
    """path, ids, docs and base, the place of a file's first id among all ids, of every file.

    Counts of the parts are added up first, then those of the files of each part: no task orders all files.
    """
    parts = files.groupBy("part").agg(F.sum("ids").alias("part_ids"))
    before_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("part_ids").over(before_part), F.lit(0)).alias("part_base"))
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    inside = files.withColumn("inside", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    return inside.join(parts, "part").select(
        "path", "ids", "docs", (F.col("part_base") + F.col("inside")).alias("base")
    )


def read_codes(files: DataFrame) -> DataFrame:
    """One row per document of the listed files: its place among all ids, length and checksum.

    Every file's first and last id of each document are also read by rank, and must be the same.
    """
    based = materialise(placed(files).select("path", "base"), "token-bases")

    def read(batches):
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with open_there(path) as file:
                    held = TokenFile(file.read())
                ids, starts = held.all_ids(), held.starts
                kept = np.flatnonzero(np.diff(starts) > 0)
                for edge in (starts[:-1][kept], starts[1:][kept] - 1):
                    if (held.at(edge) != ids[edge]).any():
                        raise ValueError(f"ranks and levels differ in {path}")
                data = memoryview(ids.tobytes())
                ends = (4 * starts).tolist()
                sums = [zlib.crc32(data[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield batch_of(CODED, [held.doc_ids, base + starts[:-1], np.diff(starts), sums])

    return based.repartition(max(1, based.count())).mapInArrow(read, CODED_DDL)


def tokens_at(files: DataFrame, wanted: DataFrame, place: str = "place") -> DataFrame:
    """The asked places (a column of longs, counted over all files) with the id there, read by rank.

    A place that no file has, or null, gives id null. Of a file, only its list of levels and what the
    asked places need is read.
    """
    first, last = F.col("base"), F.col("base") + F.col("ids") - 1
    ranges = F.sequence(F.floor(first / RANGE), F.floor(last / RANGE))
    spread = placed(files).select("path", "base", "ids", F.explode(ranges).alias("range"))
    asked = wanted.select(F.col(place).cast("long").alias("place")).distinct()
    near = asked.withColumn("range", F.floor(F.col("place") / RANGE)).join(spread, "range")
    inside = near.where("place >= base and place < base + ids").select("path", "place", "base")

    def read(batches):
        for batch in batches:
            paths = batch.column(0).to_pylist()
            places = batch.column(1).to_numpy()
            bases = batch.column(2).to_numpy()
            cuts = [0, *(k for k in range(1, len(paths)) if paths[k] != paths[k - 1]), len(paths)]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                if low == high:
                    continue
                with open_there(paths[low]) as file:
                    held = TokenFile(file)
                    some = places[low:high] - bases[low:high]
                    # A few ids are fetched by seek; many are read with their levels.
                    ids = held.at(some) if len(some) > 1_000 else [held[int(k)] for k in some]
                yield batch_of(READ, [places[low:high], ids])

    sorted_by_file = inside.repartition("path", F.pmod(F.col("place"), F.lit(16))).sortWithinPartitions("path", "place")
    found = sorted_by_file.mapInArrow(read, READ_DDL)
    return asked.join(found, "place", "left")


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write the ids of every document, read the files back, and return what they hold."""
    return read_codes(write_codes(docs, tokenizer, end_id, new_folder(spark, "token-codes")))

"""Token ids as directly addressable codes: any id can be read without decoding those before it.

An id is cut into chunks, the lowest first. Level 0 holds the first chunk of every id; a bitmap beside each level says
which ids go on, and those have their next chunk in the level above. Where an id's next chunk lies is the number of set
bits before it, which a directory (one sum per 512 bits) and a few words of the bitmap give at once.

A corpus is a Parquet table of segments in ascending doc_id order. A segment holds whole documents, their lengths, and
one buffer per level for chunks, bitmap and directory; a small manifest holds the number of ids of each part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from stayline.llm.tables import map_batches, read, work_path
from stayline.llm.tokens import default_tokenizer, encoder, gathered

END_ID = 2
#: Bits of an id per level; the last level takes what is left of 32.
LEVEL_BITS = (8, 8, 16)
#: Set bits are summed up to every so many bits.
RANK_BITS = 512
#: A segment is closed once it holds so many ids.
SEGMENT_IDS = 1 << 18
#: Code points that are looked up at once; a word that repeats among them is looked up once.
AT_ONCE = 8_000_000

SEGMENTS = (
    "part int, segment int, local_start bigint, n_ids bigint, doc_ids array<bigint>, lengths array<int>, "
    "chunks array<binary>, bitmaps array<binary>, ranks array<binary>"
)
_KINDS = {8: np.dtype("u1"), 16: np.dtype("<u2"), 32: np.dtype("<u4")}
_ONES = np.array([bin(byte).count("1") for byte in range(256)], dtype=np.int64)


@dataclass
class Codes:
    """Levels of a sequence of ids; buffers are used as they lie in memory."""

    n_ids: int
    chunks: list[bytes]
    bitmaps: list[bytes]
    ranks: list[bytes]

    @classmethod
    def of(cls, ids: np.ndarray) -> Codes:
        chunks, bitmaps, ranks = [], [], []
        rest = ids.astype(np.uint32)
        for level, bits in enumerate(LEVEL_BITS):
            chunks.append((rest & np.uint32((1 << bits) - 1)).astype(_KINDS[bits]).tobytes())
            if level == len(LEVEL_BITS) - 1:
                break
            rest = rest >> np.uint32(bits)
            goes_on = rest > 0
            bitmap = np.packbits(goes_on, bitorder="little")
            padded = np.pad(_ONES[bitmap], (0, -len(bitmap) % (RANK_BITS // 8)))
            blocks = padded.reshape(-1, RANK_BITS // 8).sum(axis=1)
            bitmaps.append(bitmap.tobytes())
            ranks.append(np.concatenate(([0], np.cumsum(blocks))).astype("<u4").tobytes())
            rest = rest[goes_on]
        return cls(len(ids), chunks, bitmaps, ranks)

    def _rank(self, level: int, at: int) -> int:
        """Set bits before place `at` of a level's bitmap."""
        block = at // RANK_BITS
        before = int(np.frombuffer(self.ranks[level], dtype="<u4")[block])
        bitmap = np.frombuffer(self.bitmaps[level], dtype=np.uint8)
        first, last = block * RANK_BITS // 8, at // 8
        before += int(_ONES[bitmap[first:last]].sum())
        return before + (int(_ONES[bitmap[last] & ((1 << at % 8) - 1)]) if at % 8 else 0)

    def get(self, at: int) -> int:
        """The id at one place."""
        value = shift = 0
        for level, bits in enumerate(LEVEL_BITS):
            value |= int(np.frombuffer(self.chunks[level], dtype=_KINDS[bits])[at]) << shift
            shift += bits
            if level == len(LEVEL_BITS) - 1 or not self.bitmaps[level][at // 8] >> at % 8 & 1:
                return value
            at = self._rank(level, at)
        return value

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Ids from `start` to `stop`; reads nothing outside, but for one rank per level."""
        out = np.frombuffer(self.chunks[0], dtype=_KINDS[LEVEL_BITS[0]])[start:stop].astype(np.uint32)
        where, shift = None, 0
        for level, bits in enumerate(LEVEL_BITS[:-1]):
            bytes_here = np.frombuffer(self.bitmaps[level], dtype=np.uint8)[start // 8 : -(-stop // 8)]
            going = np.flatnonzero(np.unpackbits(bytes_here, bitorder="little")[start % 8 : start % 8 + stop - start])
            if not len(going):
                break
            where, shift = going if where is None else where[going], shift + bits
            start = self._rank(level, start)
            stop = start + len(going)
            own = np.frombuffer(self.chunks[level + 1], dtype=_KINDS[LEVEL_BITS[level + 1]])[start:stop]
            out[where] |= own.astype(np.uint32) << np.uint32(shift)
        return out


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Encode the whole texts of `docs` and write segments and manifest below `path`.

    Documents lie in ascending doc_id order, null ids first, equal ids as they lie in the input. A null text is the end id alone. Ranges of ids are sorted apart from each other, each task writes its own
    segments, and a repeated id that holds many rows is split over tasks.
    """
    name = tokenizer or default_tokenizer()
    target = to_arrow_schema(StructType.fromDDL(SEGMENTS))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment, start = TaskContext.get().partitionId(), 0, 0
        doc_ids, lengths, ids, size = [], [], [], 0
        end = np.array([end_id], np.uint32)

        def close() -> pa.RecordBatch:
            codes = Codes.of(np.concatenate(ids))
            row = {
                "part": part, "segment": segment, "local_start": start, "n_ids": size, "doc_ids": doc_ids,
                "lengths": lengths, "chunks": codes.chunks, "bitmaps": codes.bitmaps, "ranks": codes.ranks,
            }
            return pa.RecordBatch.from_pylist([row], schema=target)

        for names, texts in gathered(batches, AT_ONCE):
            for doc_id, own in zip(names, encoder(name).encode(texts, AT_ONCE), strict=True):
                doc_ids.append(doc_id)
                lengths.append(len(own) + 1)
                ids += own, end
                size += lengths[-1]
                if size >= SEGMENT_IDS:
                    yield close()
                    segment, start = segment + 1, start + size
                    doc_ids, lengths, ids, size = [], [], [], 0
        if ids:
            yield close()

    order = [F.col("doc_id").asc_nulls_first(), F.col("_row")]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    ordered = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    encoded = ordered.select("doc_id", "text").mapInArrow(encode, SEGMENTS)
    # chunks of ids hardly compress any further; segments are read whole
    encoded.write.option("compression", "zstd").parquet(f"{path}/segments")
    segments = docs.sparkSession.read.parquet(f"{path}/segments")
    sizes = segments.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    # one row per part, so a running sum over them in one place is small whatever the corpus
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = sizes.withColumn("part_start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    manifest.write.parquet(f"{path}/manifest")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, each read from its own place in the files."""
    segments = spark.read.parquet(f"{path}/segments")
    manifest = spark.read.parquet(f"{path}/manifest").select("part", "part_start")

    def documents(batch: pa.RecordBatch) -> dict | None:
        rows = []
        for number in range(batch.num_rows):  # one segment at a time, as they are large
            row = batch.slice(number, 1).to_pylist()[0]
            codes = Codes(row["n_ids"], row["chunks"], row["bitmaps"], row["ranks"])
            at = 0
            for doc_id, length in zip(row["doc_ids"], row["lengths"], strict=True):
                code = zlib.crc32(codes.slice(at, at + length).astype("<u4", copy=False))
                rows.append((row["part"], doc_id, row["local_start"] + at, length, code))
                at += length
        names = ("part", "doc_id", "local_start", "n_tokens", "ids_crc32")
        return dict(zip(names, zip(*rows, strict=True), strict=True)) if rows else None

    schema = "part int, doc_id bigint, local_start bigint, n_tokens bigint, ids_crc32 bigint"
    found = map_batches(segments, documents, schema)
    return found.join(manifest, "part").select(
        "doc_id", (F.col("part_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_ids(spark: SparkSession, path: str, start: int, stop: int) -> np.ndarray:
    """Ids of a stretch of the corpus, from the segments that hold it."""
    manifest = spark.read.parquet(f"{path}/manifest")
    segments = spark.read.parquet(f"{path}/segments").join(manifest.select("part", "part_start"), "part")
    placed = segments.withColumn("start", F.col("part_start") + F.col("local_start"))
    inside = placed.where((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start)).orderBy("start")
    found = []
    for row in inside.toLocalIterator():
        codes = Codes(row["n_ids"], *[[bytes(b) for b in row[name]] for name in ("chunks", "bitmaps", "ranks")])
        found.append(codes.slice(max(0, start - row["start"]), min(row["n_ids"], stop - row["start"])))
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint32)


def op4_direct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as directly addressable codes, and read back."""
    path = work_path(spark, "direct-codes")
    write(read(spark, sf_dir, "documents"), path)
    return read_documents(spark, path)

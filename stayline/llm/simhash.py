"""SimHash near-duplicates: fingerprints, links between fingerprints that differ in few bits, and their components.

The join embeds a fingerprint as the bit counts of its 32 two-bit segments. Two fingerprints differ in at least as many
bits as their count vectors differ by in Manhattan distance, so links lie within distance 3. Of a distance of 3 one half
of the segments holds 1 at most. Each half is a grid whose cells are its count vectors: a fingerprint looks into its own
cell and the cells one step above it in one segment (a neighbour one step below finds it from there), and every meeting is
verified by the exact number of differing bits. Work per fingerprint is 34 probes, whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from stayline.llm.graph import components
from stayline.llm.tables import as_bytes, read, stored, unused

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
_SEGMENTS = 16  # per half
_PAIRS = 0x55555555
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """Majority of the bits of all shingle hashes, as a signed 64-bit number; zero where there is no word."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate(([0], ends[:-width])).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)]
    columns = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(columns[:, byte], minlength=256) @ _BITS for byte in range(8)])
    majority = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(majority.view("<i8")[0])


@F.pandas_udf(LongType())
def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([fingerprint(text) for text in batch], dtype="int64")


def fingerprint_of(column: str = "text") -> Column:
    return _fingerprints(as_bytes(column))


def links(prints: DataFrame, name: str = "print") -> DataFrame:
    """(u, v) for pairs of different fingerprints that differ in at most three bits. `prints` holds distinct values.

    A pair near in both halves appears twice.
    """
    value = F.col(name)
    parts = [F.shiftrightunsigned(value, 32 * half).bitwiseAND(F.lit(0xFFFFFFFF)) for half in (0, 1)]
    halves = F.array(
        *[
            F.struct(
                F.lit(half).cast("long").alias("half"),
                # every two bits less the upper one leave the number of bits set in each segment
                (part - F.shiftrightunsigned(part, 1).bitwiseAND(F.lit(_PAIRS))).alias("cell"),
            )
            for half, part in enumerate(parts)
        ]
    )
    own = prints.select(value.alias("u"), F.explode(halves).alias("at")).select("u", "at.half", "at.cell")
    side = F.shiftleft(F.col("half"), 40)
    steps = F.array(F.lit(0).cast("long"), *[F.lit(1 << 2 * s).cast("long") for s in range(_SEGMENTS)])
    # a segment that counts two has no step above it
    room = F.col("cell").bitwiseAND(F.shiftleft(F.col("step"), 1)) == 0
    probes = own.select("u", "half", "cell", F.explode(steps).alias("step")).where(room)
    probes = probes.select("u", (side + F.col("cell") + F.col("step")).alias("key"), (F.col("step") == 0).alias("same"))
    cells = own.select(F.col("u").alias("v"), (side + F.col("cell")).alias("key"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS
    once = (F.col("same") & (F.col("u") < F.col("v"))) | ~F.col("same")
    # both sides come out of explode, whose rows Spark does not count when it sizes a table for a broadcast
    return probes.join(cells.hint("merge"), "key").where(near & once).select("u", "v")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Add `fingerprint` (hex), `component_id` and `first` to the rows of `docs` (doc_id, text); returns only doc_id and
    these.

    Links join fingerprints at three or fewer differing bits; a component is what links reach. Null and empty texts have
    fingerprint zero and link like any other. Equal texts meet as one fingerprint, so copies are never paired.
    component_id is the smallest doc_id of the component (null only where all are null). Repeated rows each get a row.
    """
    prints = stored(docs.select("doc_id", fingerprint_of().alias("print")), "prints")
    return grouped(prints).select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def grouped(prints: DataFrame) -> DataFrame:
    """Rows of `prints` (doc_id, print) with their component_id."""
    known = stored(prints.groupBy("print").agg(F.min("doc_id").alias("lowest")), "distinct-prints")
    reach = stored(components(links(known)), "reach").select(F.col("node").alias("print"), "root")
    placed = known.join(reach, "print", "left").withColumn("root", F.coalesce("root", "print"))
    lowest = placed.groupBy("root").agg(F.min("lowest").alias("component_id"))
    classes = placed.join(lowest, "root").select("print", "component_id")
    return prints.join(stored(classes, "classes"), "print")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """Keep one document of each component: the one with the smallest doc_id (nulls last), then the smallest text hash;
    rows equal in both are copies, of which any one stays. All columns are kept as they are."""
    value, group, best = unused(docs, "_print"), unused(docs, "_group"), unused(docs, "_best")
    marked = stored(docs.withColumn(value, fingerprint_of()), "marked")
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.xxhash64("text").alias("c"))
    known = stored(marked.groupBy(value).agg(F.min(order).alias(best)), "distinct-prints")
    reach = stored(components(links(known, value)), "reach").select(F.col("node").alias(value), F.col("root").alias(group))
    placed = known.join(reach, value, "left").withColumn(group, F.coalesce(group, value))
    # the smallest order decides a component; the fingerprint that holds it is the only one whose rows can stay
    winners = stored(placed.groupBy(group).agg(F.min(F.struct(best, value)).alias("w")).select(f"w.{best}", f"w.{value}"), "winners")
    kept = marked.join(winners, value).where(order.eqNullSafe(F.col(best)))
    return kept.dropDuplicates([value]).select(*docs.columns)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document, whole texts."""
    return near_duplicates(read(spark, sf_dir, "documents"))

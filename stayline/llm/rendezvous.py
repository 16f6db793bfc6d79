"""Sharding by rendezvous hashing: every record goes to the shard whose weighted hash of its key is largest.

Adding a shard leaves the hashes of the others as they are, so records move only into it. All of it is DataFrame
functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayline.llm.tables import read, stored, unused

SHARDS = 40
#: Bytes that a record takes beside its text.
RECORD_BYTES = 16
# monotonically_increasing_id keeps the partition above this bit and the row inside it below
_ROW_BITS = 33
_DIGITS = 13  # hexadecimal digits of a digest that a double holds exactly


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard with the largest score -weight / ln(u), u being the hash of key and shard in (0, 1).

    Weights are positive; shards keep their numbers when others are added. A null key hashes like the text `null`.
    """
    text = F.coalesce(key.cast("string"), F.lit("null"))
    scores = []
    for shard, weight in enumerate(weights):
        digest = F.substring(F.md5(F.concat(text, F.lit(f":{shard}")).cast("binary")), 1, _DIGITS)
        u = (F.conv(digest, 16, 10).cast("double") + 0.5) / float(16**_DIGITS)
        scores.append(F.struct((-F.lit(float(weight)) / F.log(u)).alias("score"), F.lit(-shard).alias("shard")))
    return (-F.greatest(*scores)["shard"]).cast("int") if len(scores) > 1 else F.lit(0)


def with_slots(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Add `slot`, the place of each row in its group, gapless from 0, in `order`; equal rows are interchangeable. `rows`
    has no column of that name and no null in `group`; its other columns may have any names.

    Rows are sorted in ranges, not by group, so a group that holds a third of all rows spreads over a third of the
    ranges. A range adds what the ranges before it hold of the group: one small row per range and group.
    """
    row, pos, range_, count, first, before = (unused(rows, f"_{name}") for name in ("row", "pos", "range", "n", "first", "before"))
    keyed = rows.withColumn(row, F.monotonically_increasing_id())  # splits runs of equal rows
    columns = [F.col(group), *[F.col(name) for name in order], F.col(row)]
    placed = stored(
        keyed.repartitionByRange(*columns).sortWithinPartitions(*columns).drop(row)
        .withColumn(pos, F.monotonically_increasing_id()),
        "slots",
    ).withColumn(range_, F.shiftright(pos, _ROW_BITS))
    sizes = placed.groupBy(group, range_).agg(F.count("*").alias(count), F.min(pos).alias(first))
    earlier = Window.partitionBy(group).orderBy(range_).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, range_, first, F.coalesce(F.sum(count).over(earlier), F.lit(0)).alias(before))
    joined = placed.join(starts, [group, range_])
    return joined.withColumn("slot", F.col(before) + F.col(pos) - F.col(first)).select(*rows.columns, "slot")


def shard_documents(docs: DataFrame, shards: int = SHARDS, weights: Sequence[float] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and grown_shard (the shard if there were one more, of weight 1).

    The key is the doc_id: repeated documents share a shard and each get a slot, null ids share one. A null text has the
    size and checksum of an empty one.
    """
    weights = list(weights or [1.0] * shards)
    content = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(content) + RECORD_BYTES).cast("bigint").alias("size"),
        F.crc32(content).alias("text_crc32"),
        rendezvous(F.col("doc_id"), weights).alias("shard"),
        rendezvous(F.col("doc_id"), [*weights, 1.0]).alias("grown_shard"),
    )
    return with_slots(rows, "shard", ["doc_id", "text_crc32", "size"])


def op5_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 equal shards under the law `key`."""
    placed = shard_documents(read(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


#: The checksum by its table of 256 steps, which the rule of the polynomial gives.
ORACLE = """
WITH entries AS (
  SELECT list_reduce(list_prepend(i, range(8)), 
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v, i
  FROM range(256) r(i)),
tables AS (SELECT list(v ORDER BY i) AS steps FROM entries),
content AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
sums AS (
  SELECT doc_id, octet_length(encode(text))::BIGINT + 16 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || b)::BIGINT for b in regexp_extract_all(hex(encode(text)), '..')]),
      lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM content, tables),
scores AS (
  SELECT doc_id, list_transform(range(41), lambda s: -1.0 / ln(((
    '0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || s), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)) AS score
  FROM documents),
placed AS (
  SELECT doc_id, (list_position(score[1:40], list_max(score[1:40])) - 1)::INT AS shard, 
    (list_position(score, list_max(score)) - 1)::INT AS grown_shard
  FROM scores)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, grown_shard
FROM sums JOIN placed USING (doc_id)
"""

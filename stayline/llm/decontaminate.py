"""Benchmark decontamination: a prefix-filtered join of document shingles with item windows.

A window is 13 consecutive words of an item (all words of a shorter one). A document contains a window only if it
contains every word of it, so one word is a sufficient prefix: its rarest one, by counts over all documents. Documents
look up their words among these prefix words, and a meeting passes a length and position bound (the window must fit
around the word where it stands) before the words are compared one by one.

The items are the stated query set. They are taken in blocks of a fixed number of windows; a block's index is bounded, is
sent to all tasks, and meets all documents. A larger benchmark takes more blocks, never a larger one.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.tables import as_bytes, map_batches, read, stored

WINDOW_WORDS = 13
#: Contaminated: a twentieth of the document's words or more are hit.
HIT_SHARE = 20
#: Items sent to the tasks at once, by bytes of their text.
BLOCK_BYTES = 16 << 20

# lower-cases A-Z and turns everything but 0-9, a-z and bytes above ASCII into blanks
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def windows_of(words: list[bytes], width: int = WINDOW_WORDS) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    return [tuple(words[at : at + width]) for at in range(max(1, len(words) - width + 1))]


class WindowIndex:
    """Windows of items under their rarest word."""

    def __init__(self, items: list[tuple[int, bytes]], counts: dict[bytes, int], width: int = WINDOW_WORDS):
        self.owners: dict[tuple[bytes, ...], set] = defaultdict(set)
        for item_id, text in items:
            for window in windows_of(words_of(text), width):
                self.owners[window].add(item_id)
        self.prefixes: dict[bytes, dict[tuple[int, int], set]] = defaultdict(dict)
        for window in self.owners:
            # rarest first; ties by the word itself, then by its first place
            at = min(range(len(window)), key=lambda i: (counts.get(window[i], 0), window[i], i))
            self.prefixes[window[at]].setdefault((at, len(window)), set()).add(window)

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans of words inside occurrences of windows, and the items whose windows occur."""
        prefixes, spans, items = self.prefixes, [], set()
        for place in [i for i, word in enumerate(words) if word in prefixes]:
            for (before, length), wanted in prefixes[words[place]].items():
                start = place - before
                if start < 0 or start + length > len(words):
                    continue
                window = tuple(words[start : start + length])
                if window in wanted:
                    spans.append((start, start + length))
                    items |= self.owners[window]
        return spans, items


def merged(spans) -> list[tuple[int, int]]:
    """Spans joined where they touch or overlap, in order."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[list[tuple[str, bytes]], bool]]:
    """Items in blocks of at most `block_bytes` of text (one item at least), one block at a time, and whether more
    follow. An empty benchmark is one empty block."""
    block, size = [], 0
    rows = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("string"), as_bytes()).distinct()
    for item_id, text in rows.toLocalIterator():
        if block and size + len(text) > block_bytes:
            yield block, True
            block, size = [], 0
        block.append((item_id, bytes(text)))
        size += len(text)
    yield block, False


def item_word_counts(docs: DataFrame, items: list[tuple[str, bytes]]) -> dict[bytes, int]:
    """How often each word of the items stands in all documents; as many numbers as the block has words."""
    vocabulary = frozenset(word for _, text in items for word in words_of(text))
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batch: pa.RecordBatch) -> dict:
        wanted, found = sent.value, Counter()
        for text in batch.column(0).to_pylist():
            found.update(filter(wanted.__contains__, words_of(text)))
        return {"word": list(found), "n": list(found.values())}

    counted = map_batches(docs.select(as_bytes()), count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(row["word"]): row["n"] for row in counted.toLocalIterator()}


def occurrences(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of `docs`: its columns, n_words, spans (runs of hit words, by their places), items (sorted, as strings).

    Null and empty texts have no words; items without an id are left out, those without words have no window; an empty
    benchmark hits nothing. Repeated documents get a row each; repeated items count once. `docs` must not have columns
    n_words, spans or items.
    """
    sent = docs.sparkSession.sparkContext.broadcast
    frame = docs.select(
        "*",
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast("array<struct<start: int, stop: int>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for block, more in item_blocks(benchmark, block_bytes):
        frame = _meet(frame, sent(WindowIndex(block, item_word_counts(docs, block), width)))
        if more:
            frame = stored(frame, "spans")
    return frame


def _meet(frame: DataFrame, index) -> DataFrame:
    """Add what the items of one block hit to the columns of `frame`."""
    text_at, spans_at, items_at = (frame.columns.index(name) for name in ("text", "spans", "items"))

    def find(batch: pa.RecordBatch) -> dict:
        n_words, spans, items = [], [], []
        texts = batch.column(text_at).cast(pa.binary()).to_pylist()
        for text, old_spans, old_items in zip(
            texts, batch.column(spans_at).to_pylist(), batch.column(items_at).to_pylist(), strict=True
        ):
            words = words_of(text or b"")
            found, owners = index.value.find(words)
            n_words.append(len(words))
            all_spans = merged(found + [(span["start"], span["stop"]) for span in old_spans])
            spans.append([{"start": a, "stop": b} for a, b in all_spans])
            items.append(sorted(owners.union(old_items)))
        columns = {field.name: batch.column(at) for at, field in enumerate(batch.schema)}
        return columns | {"n_words": n_words, "spans": spans, "items": items}

    return map_batches(frame, find, frame.schema)


def hit_words() -> Column:
    return F.aggregate("spans", F.lit(0), lambda n, span: n + span["stop"] - span["start"]).cast("bigint")


def is_contaminated() -> Column:
    return (hit_words() > 0) & (HIT_SHARE * hit_words() >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that are not contaminated, with their columns as they are."""
    names = [f"c{at}" for at in range(len(docs.columns))]
    plain = docs.toDF(*["text" if column == "text" else name for column, name in zip(docs.columns, names, strict=True)])
    kept = occurrences(plain, benchmark).where(~is_contaminated())
    return kept.drop("n_words", "spans", "items").toDF(*docs.columns)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the benchmark's items hit in every document."""
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = occurrences(docs, read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        hit_words().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


#: Every place of every window, compared word by word.
ORACLE = """
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
starts AS (
  SELECT item_id, words, least(13, len(words)) AS n, unnest(range(1, greatest(1, len(words) - 12) + 1)) AS pos
  FROM items WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item_id, n, words[pos] AS first_word, array_to_string(words[pos:pos + n - 1], ' ') AS window_text FROM starts),
places AS (SELECT r, words, unnest(range(1, len(words) + 1)) AS place, unnest(words) AS word FROM docs),
hits AS (
  SELECT p.r, p.place, w.n, w.item_id FROM places p JOIN windows w ON p.word = w.first_word
  WHERE p.place + w.n - 1 <= len(p.words) AND array_to_string(p.words[p.place:p.place + w.n - 1], ' ') = w.window_text),
covered AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(place, place + n)) AS place FROM hits) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY r)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit,
  coalesce(f.n_items, 0)::BIGINT AS n_items, sha256(coalesce(f.ids, '')) AS items_sha256,
  coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.words) AS contaminated
FROM docs d LEFT JOIN covered c USING (r) LEFT JOIN found f USING (r)
"""

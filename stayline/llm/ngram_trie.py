"""Language model scores from an Elias-Fano n-gram trie.

Words become numbers, sorted by their hash. The model holds how often words stand in training texts, and which words
follow which. Probabilities of a word after another are smoothed by Dirichlet's rule towards the word's own, and quantised
to a byte. The trie has a level of contexts and a level of their successors: contexts, pointers to the successors of each,
and the successors themselves (made monotone by adding the end of the context before) are Elias-Fano sequences, queried by
a successor search inside the context's range.

The corpus is never in one place. Tasks cut documents into blocks of bounded size and number the words of a block. The
words go to shards by hash, which count them over all blocks and answer each block. Then the different pairs of each block,
with their counts, go to shards by context; frequent contexts are spread over several, as the counts tell. A shard sums the
counts, builds its own part of the trie, and returns a score per different pair of each block, which the block sums per
document. So a pair costs a shard one entry per block, however often it stands there.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from stayline.llm.tables import BATCH_ROWS, as_bytes, blocks, read, release, stored

#: Text of a block, and its documents, at most (one document at least).
BLOCK_BYTES = 8 << 20
BLOCK_DOCS = 4_000
#: Entries of a shard, about.
SHARD_ENTRIES = 1_000_000
#: A context is spread over one more shard for every so many of its occurrences.
SPREAD = 500_000
#: Weight of a word's own probability beside what follows its context.
MU = 100.0
#: Levels of the quantiser.
CODES = 256
#: The end of a text; no word holds a line end, so no word has this hash by itself.
END_HASH = xxhash.xxh64_intdigest(b"\n")
#: Context of a text's first word. Words are numbered from 1.
START = 0


# ---------------------------------------------------------------- packing of arrays


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as compressed bytes, plane by plane, so that high bytes that are zero cost nothing."""
    parts = []
    for values in arrays:
        kind, size = values.dtype.str.encode().ljust(4), values.dtype.itemsize
        planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, size).T
        parts.append(struct.pack("<4sQ", kind, len(values)) + planes.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(body: bytes) -> list[np.ndarray]:
    raw, at, arrays = zstandard.ZstdDecompressor().decompress(body), 0, []
    while at < len(raw):
        kind, count = struct.unpack_from("<4sQ", raw, at)
        dtype = np.dtype(kind.decode().strip())
        at += 12
        planes = np.frombuffer(raw, np.uint8, count * dtype.itemsize, at).reshape(dtype.itemsize, count)
        arrays.append(np.ascontiguousarray(planes.T).view(dtype).reshape(-1))
        at += count * dtype.itemsize
    return arrays


# ---------------------------------------------------------------- Elias-Fano


@dataclass
class EliasFano:
    """A sequence of numbers that never falls: low bits side by side, high bits as a bitmap with a one per element and a
    zero per step."""

    count: int
    low_bits: int
    low: bytes
    high: bytes
    _ends: np.ndarray | None = field(default=None, repr=False)
    _ones: np.ndarray | None = field(default=None, repr=False)

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        count = len(values)
        top = int(values[-1]) if count else 0
        low_bits = max(0, (top // max(1, count)).bit_length() - 1)
        low = values & np.uint64((1 << low_bits) - 1)
        bits = np.empty((count, low_bits), dtype=np.uint8)
        for bit in range(low_bits):
            bits[:, bit] = (low >> np.uint64(bit)) & np.uint64(1)
        high = (values >> np.uint64(low_bits)).astype(np.int64)
        bitmap = np.zeros(count + (top >> low_bits) + 1, dtype=np.uint8)
        bitmap[high + np.arange(count)] = 1
        packed = np.packbits(bits.reshape(-1), bitorder="little").tobytes() + b"\0" * 8
        return cls(count, low_bits, packed, struct.pack("<Q", len(bitmap)) + np.packbits(bitmap, bitorder="little").tobytes())

    def _directory(self) -> None:
        size = struct.unpack_from("<Q", self.high)[0]
        bitmap = np.unpackbits(np.frombuffer(self.high, np.uint8, offset=8), bitorder="little")[:size]
        zeros = np.flatnonzero(bitmap == 0)
        # elements whose high part is at most h
        self._ends = zeros - np.arange(len(zeros))
        self._ones = np.flatnonzero(bitmap)

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), dtype=np.uint64)
        words = np.ndarray((len(self.low) - 7,), dtype="<u8", buffer=self.low, strides=(1,))
        bit = at.astype(np.int64) * self.low_bits
        return (words[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)

    def get(self, at: np.ndarray) -> np.ndarray:
        if self._ones is None:
            self._directory()
        high = (self._ones[at] - at).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self._low(at)

    def successor(self, wanted: np.ndarray) -> np.ndarray:
        """Place of the first element that is not below each wanted number."""
        if self._ends is None:
            self._directory()
        if not self.count:
            return np.zeros(len(wanted), dtype=np.int64)
        wanted = wanted.astype(np.uint64)
        high = (wanted >> np.uint64(self.low_bits)).astype(np.int64)
        inside = high < len(self._ends)
        step = np.where(inside, high, len(self._ends) - 1)
        last = self._ends[step]
        first = np.where(step > 0, self._ends[step - 1], 0)
        first = np.where(inside, first, self.count)
        last = np.where(inside, last, self.count)
        target = wanted & np.uint64((1 << self.low_bits) - 1)
        while (open_ := first < last).any():
            middle = (first + last) >> 1
            below = open_ & (self._low(np.minimum(middle, self.count - 1)) < target)
            first = np.where(below, middle + 1, first)
            last = np.where(open_ & ~below, middle, last)
        return first


# ---------------------------------------------------------------- trie


@dataclass
class Trie:
    """Contexts, pointers, successors and quantised logarithms of probabilities; all of it plain bytes."""

    contexts: EliasFano
    pointers: EliasFano
    successors: EliasFano
    backoff_codes: bytes
    codes: bytes
    book: np.ndarray
    backoff_book: np.ndarray

    @classmethod
    def of(cls, context: np.ndarray, word: np.ndarray, log_p: np.ndarray, log_backoff: np.ndarray) -> Trie:
        """From pairs sorted by context, then word; `log_backoff` is the same for all pairs of a context."""
        heads = np.flatnonzero(np.diff(context, prepend=np.uint64(0xFFFFFFFFFFFFFFFF)) != 0) if len(context) else np.zeros(0, np.int64)
        pointers = np.append(heads, len(context))
        shift = cls._shifts(word, pointers)
        codes, book = quantise(log_p)
        backoff_codes, backoff_book = quantise(log_backoff[heads])
        return cls(
            EliasFano.of(context[heads]), EliasFano.of(pointers), EliasFano.of(word + np.repeat(shift, np.diff(pointers))),
            backoff_codes.tobytes(), codes.tobytes(), book, backoff_book,
        )

    @staticmethod
    def _shifts(word: np.ndarray, pointers: np.ndarray) -> np.ndarray:
        """What is added to the words of each context: the sum of the largest words of those before."""
        last = word[pointers[1:] - 1] if len(pointers) > 1 else np.zeros(0, np.uint64)
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(last + np.uint64(1))[:-1])) if len(last) else last

    def score(self, context: np.ndarray, word: np.ndarray, log_own: np.ndarray) -> np.ndarray:
        """Logarithm of each word's probability after its context."""
        out = log_own.astype(np.float64)
        if not self.contexts.count or not len(context):
            return out
        at = self.contexts.successor(context)
        near = np.minimum(at, self.contexts.count - 1)
        known = (at < self.contexts.count) & (self.contexts.get(near) == context)
        if not known.any():
            return out
        near = near[known]
        begin, end = self.pointers.get(near).astype(np.int64), self.pointers.get(near + 1).astype(np.int64)
        # the shift of a context is one above the element before its range
        shift = np.where(begin > 0, self.successors.get(np.maximum(begin - 1, 0)) + np.uint64(1), np.uint64(0))
        wanted = word[known] + shift
        place = np.maximum(self.successors.successor(wanted), begin)
        within = np.minimum(place, self.successors.count - 1)
        seen = (place < end) & (self.successors.get(within) == wanted)
        backed = self.backoff_book[np.frombuffer(self.backoff_codes, np.uint8)[near]] + out[known]
        out[known] = np.where(seen, self.book[np.frombuffer(self.codes, np.uint8)[within]], backed)
        return out

    def to_bytes(self) -> bytes:
        parts = [self.backoff_codes, self.codes, self.book.tobytes(), self.backoff_book.tobytes()]
        for level in (self.contexts, self.pointers, self.successors):
            parts += [struct.pack("<QQ", level.count, level.low_bits), level.low, level.high]
        return b"".join(struct.pack("<Q", len(part)) + part for part in parts)

    @classmethod
    def from_bytes(cls, body: bytes) -> Trie:
        parts, at = [], 0
        while at < len(body):
            (size,) = struct.unpack_from("<Q", body, at)
            parts.append(body[at + 8 : at + 8 + size])
            at += 8 + size
        levels = [EliasFano(*struct.unpack("<QQ", parts[i]), parts[i + 1], parts[i + 2]) for i in (4, 7, 10)]
        return cls(*levels, parts[0], parts[1], np.frombuffer(parts[2]), np.frombuffer(parts[3]))


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A byte per value and the mean of each code; codes are equal steps from the smallest value to the largest, so no
    value is off by more than a step."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1)
    low, high = values.min(), values.max()
    codes = np.minimum((values - low) * (CODES / max(high - low, 1e-9)), CODES - 1).astype(np.uint8)
    sums, counts = np.bincount(codes, values, CODES), np.bincount(codes, minlength=CODES)
    return codes, sums / np.maximum(1, counts)


# ---------------------------------------------------------------- blocks of documents

_BLOCKS = (
    "block bigint, doc_ids array<bigint>, n_docs int, n_tokens bigint, n_words bigint, held binary, lengths binary, "
    "words binary, counts binary, tokens binary"
)


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Rows that nothing is learned from; a null id counts as empty text and is learned from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def number_words(docs: DataFrame) -> DataFrame:
    """Blocks of documents: the hashes of a block's words in order, how often each stands in its training texts, and the
    texts as places in that list, each with the end behind it."""
    target = to_arrow_schema(StructType.fromDDL(_BLOCKS))

    def block_of(number: int, doc_ids: list, held: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        ids: dict[bytes, int] = {b"\n": 0}
        known = ids.setdefault
        stream = np.array([known(word, len(ids)) for words in texts for word in (*words, b"\n")], dtype=np.int64)
        hashes = np.array([END_HASH if word == b"\n" else xxhash.xxh64_intdigest(word) for word in ids], dtype=np.uint64)
        words, place = np.unique(hashes, return_inverse=True)
        stream = place[stream]
        lengths = np.array([len(words_) + 1 for words_ in texts], dtype=np.uint32)
        train = np.repeat(~np.array(held, dtype=bool), lengths)
        counts = np.bincount(stream[train], minlength=len(words)).astype(np.uint32)
        row = {
            "block": number, "doc_ids": doc_ids, "n_docs": len(texts), "n_tokens": len(stream), "n_words": len(words),
            "held": pack(np.array(held, dtype=np.uint8)), "lengths": pack(lengths), "words": words.astype("<u8").tobytes(),
            "counts": pack(counts), "tokens": pack(stream.astype(np.uint32)),
        }
        return pa.RecordBatch.from_pylist([row], schema=target)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = TaskContext.get().partitionId() << 32, 0
        doc_ids, held, texts = [], [], []
        for batch in batches:
            for doc_id, out, text in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if texts and (size + len(text) > BLOCK_BYTES or len(texts) == BLOCK_DOCS):
                    yield block_of(number, doc_ids, held, texts)
                    number, size = number + 1, 0
                    doc_ids, held, texts = [], [], []
                doc_ids.append(doc_id)
                held.append(out)
                texts.append(text.lower().split())
                size += len(text)
        if texts:
            yield block_of(number, doc_ids, held, texts)

    rows = docs.select(F.col("doc_id").cast("bigint"), is_held_out().alias("held"), as_bytes().alias("text"))
    return rows.mapInArrow(cut, _BLOCKS)


# ---------------------------------------------------------------- counts of words


def count_words(numbered: DataFrame, shards: int) -> DataFrame:
    """(shard, block, counts, ranks, n_train, n_distinct, n_words): for the words of a block in a shard, in order, their
    counts over all blocks and their ranks in the shard; and the shard's totals, the same on all its rows."""
    kind = "shard int, block bigint, words binary, counts binary"
    target = to_arrow_schema(StructType.fromDDL(kind))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in range(batch.num_rows):
                row = batch.slice(number, 1).to_pylist()[0]
                words, (counts,) = np.frombuffer(row["words"], "<u8"), unpack(row["counts"])
                shard = _shard_of_hash(words, shards)
                found, starts = np.unique(shard, return_index=True)
                stops = np.append(starts[1:], len(words))
                rows = [
                    {"shard": s, "block": row["block"], "words": words[a:b].tobytes(), "counts": pack(counts[a:b])}
                    for s, a, b in zip(found.tolist(), starts.tolist(), stops.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=target)

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        words = [np.frombuffer(body, "<u8") for body in frame["words"]]
        counts = [unpack(body)[0] for body in frame["counts"]]
        known, rank = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(rank, np.concatenate(counts), len(known)).astype(np.uint64)
        stops = np.cumsum([len(own) for own in words])
        spans = list(zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True))
        return pd.DataFrame(
            {
                "shard": frame["shard"], "block": frame["block"],
                "counts": [pack(total[rank[a:b]]) for a, b in spans],
                "ranks": [pack(rank[a:b].astype(np.uint64)) for a, b in spans],
                "n_train": int(total.sum()), "n_distinct": int((total > 0).sum()), "n_words": len(known),
            }
        )

    dealt = numbered.select("block", "words", "counts").mapInArrow(deal, kind)
    return dealt.groupBy("shard").applyInPandas(
        merge, "shard int, block bigint, counts binary, ranks binary, n_train bigint, n_distinct bigint, n_words bigint"
    )


def _shard_of_hash(words: np.ndarray, shards: int) -> np.ndarray:
    """Equal ranges of hashes, in order."""
    return ((words >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(27))


# ---------------------------------------------------------------- pairs

_PAIRS = "kind string, shard int, block bigint, doc_ids array<bigint>, body binary"


@dataclass
class Totals:
    """Of the training texts: tokens, different tokens, documents; and how many words come before each shard's."""

    tokens: int
    distinct: int
    documents: int
    before: np.ndarray

    def log_own(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1.0) / (self.tokens + self.distinct + 1.0))


def pair_places(tokens: np.ndarray, lengths: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs of a block, in order, as before * (n_words + 1) + word, where before is 0 or one above the place
    of the word before; and the place of each token's pair among them."""
    before = np.empty(len(tokens), dtype=np.int64)
    before[1:] = tokens[:-1].astype(np.int64) + 1
    before[_starts(lengths)] = START
    return np.unique(before * np.int64(n_words + 1) + tokens, return_inverse=True)


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)


def deal_pairs(numbered: DataFrame, counted: DataFrame, totals: Totals, shards: int) -> DataFrame:
    """Rows (kind, shard, block, doc_ids, body): the different pairs of a block for each shard, with how often each stands in
    the block's training texts, and the documents of the block."""
    target = to_arrow_schema(StructType.fromDDL(_PAIRS))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in range(batch.num_rows):
                yield from of_block(batch.slice(number, 1).to_pylist()[0])

    def of_block(row: dict) -> Iterator[pa.RecordBatch]:
        answers = sorted(row["answers"], key=lambda answer: answer["shard"])
        counts = np.concatenate([unpack(answer["counts"])[0] for answer in answers])
        # sorted hashes have sorted numbers, as shards are ranges of hashes
        ids = np.concatenate([unpack(a["ranks"])[0] + np.uint64(totals.before[a["shard"]] + 1) for a in answers])
        (tokens,), (lengths,), (held,) = unpack(row["tokens"]), unpack(row["lengths"]), unpack(row["held"])
        own = totals.log_own(counts.astype(np.float64))
        starts = _starts(lengths)
        base = np.add.reduceat(own[tokens], starts)
        known = np.add.reduceat((counts > 0)[tokens].astype(np.int64), starts)
        size = np.int64(len(ids) + 1)
        pairs, place = pair_places(tokens, lengths, len(ids))
        train = np.repeat(held == 0, lengths)
        times = np.bincount(place[train], minlength=len(pairs)).astype(np.uint32)
        before, tokens = pairs // size, pairs % size
        all_ids = np.concatenate((np.zeros(1, np.uint64), ids))
        all_counts = np.concatenate((np.array([totals.documents], np.uint64), counts))
        context, word = all_ids[before], ids[tokens]
        spread = np.uint64(1) + all_counts[before] // np.uint64(SPREAD)
        shard = ((_mixed(context + np.uint64(1)) >> np.uint64(8)) + _mixed(word) % spread) % np.uint64(shards)
        documents = pack(held, lengths, known, base, shard.astype(np.uint32))
        yield emit("documents", int(row["block"] % shards), row["block"], row["doc_ids"], documents)

        by_shard = np.argsort(shard, kind="stable")
        found, heads = np.unique(shard[by_shard], return_index=True)
        for s, a, b in zip(found.tolist(), heads.tolist(), [*heads[1:].tolist(), len(shard)], strict=True):
            at = by_shard[a:b]
            first = np.flatnonzero(np.diff(context[at], prepend=np.uint64(0xFFFFFFFFFFFFFFFF)) != 0)
            runs = np.diff(np.append(first, len(at))).astype(np.uint32)
            body = pack(
                context[at][first], runs, all_counts[before[at][first]], word[at], counts[tokens[at]].astype(np.uint32),
                times[at],
            )
            yield emit("pairs", s, row["block"], [], body)

    def emit(kind: str, shard: int, block: int, doc_ids: list, body: bytes) -> pa.RecordBatch:
        row = {"kind": kind, "shard": shard, "block": block, "doc_ids": doc_ids, "body": body}
        return pa.RecordBatch.from_pylist([row], schema=target)

    answers = counted.groupBy("block").agg(F.collect_list(F.struct("shard", "counts", "ranks")).alias("answers"))
    return numbered.select("block", "doc_ids", "tokens", "lengths", "held").join(answers, "block").mapInArrow(pairs, _PAIRS)


def build(
    context: np.ndarray, word: np.ndarray, of_context: np.ndarray, log_own: np.ndarray, often: np.ndarray | None = None
) -> Trie:
    """Trie of training pairs, of which each entry counts `often` times, or once; `of_context` is how often the context
    occurs at all."""
    key = context << np.uint64(32) | word
    pairs, first, place = np.unique(key, return_index=True, return_inverse=True)
    times = np.bincount(place, often, len(pairs))
    total = of_context[first].astype(np.float64)
    smoothed = (times + MU * 10.0 ** log_own[first]) / (total + MU)
    return Trie.of(pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF), np.log10(smoothed), np.log10(MU / (total + MU)))


def score_shard(frame: pd.DataFrame, totals: Totals) -> pd.DataFrame:
    """Build the shard's part of the trie and answer its pairs with a score for each pair of each block; rows about
    documents pass through, and the trie itself is a row."""
    passed = frame[frame["kind"] == "documents"]
    asked = frame[frame["kind"] == "pairs"]
    out = [passed]
    if len(asked):
        sets = []
        for body in asked["body"]:
            contexts, runs, of_context, word, counts, times = unpack(body)
            sets.append((np.repeat(contexts, runs), word, np.repeat(of_context, runs), totals.log_own(counts.astype(np.float64)), times))
        joined = [np.concatenate([own[k] for own in sets]) for k in range(5)]
        train = joined[4] > 0
        trie = build(*[values[train] for values in joined])
        trie = Trie.from_bytes(written := trie.to_bytes())
        scores, at, bodies = trie.score(joined[0], joined[1], joined[3]), 0, []
        for own in sets:
            size = len(own[1])
            # few values, as they are quantised
            values, which = np.unique(scores[at : at + size], return_inverse=True)
            bodies.append(pack(values, which.astype(np.uint32)))
            at += size
        out.append(asked.assign(kind="scores", body=bodies))
        out.append(asked.iloc[:1].assign(kind="trie", block=-1, body=[written]))
    return pd.concat(out)[["kind", "shard", "block", "doc_ids", "body"]]


_SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
)


def score(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scores, trie): a row per document, and the parts of the trie by shard.

    Null and empty texts are the end alone. Every row of `docs` is scored, repeated ones each; learned is from rows whose
    doc_id is not held out. An empty table gives empty tables; without training rows every word has the same probability.
    """
    spark = docs.sparkSession
    numbered = stored(number_words(docs), "word-numbers")
    sizes = numbered.agg(F.sum("n_words"), F.sum("n_tokens")).head()
    word_shards = blocks(sizes[0] or 0, SHARD_ENTRIES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")  # rows hold whole blocks from here on
    counted = stored(count_words(numbered, word_shards), "word-counts")
    release(spark)
    by_shard = counted.groupBy("shard").agg(*[F.first(name).alias(name) for name in ("n_train", "n_distinct", "n_words")])
    # a row per shard, which holds a million words or so
    parts = by_shard.toPandas()
    words = np.zeros(word_shards, dtype=np.int64)
    words[parts["shard"]] = parts["n_words"]
    before = np.concatenate(([0], np.cumsum(words)[:-1]))
    if words.sum() >= 1 << 32:
        raise ValueError("more than 2**32 different words")
    documents = docs.where(~is_held_out()).count()
    totals = Totals(int(parts["n_train"].sum()), int(parts["n_distinct"].sum()), documents, before)
    shards = blocks(sizes[1] or 0, SHARD_ENTRIES)
    dealt = deal_pairs(numbered, counted, totals, shards)
    answered = stored(
        dealt.groupBy("shard").applyInPandas(lambda frame: score_shard(frame, totals), _PAIRS), "answers"
    )
    del dealt
    release(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def finish(frame: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        documents = frame[frame["kind"] == "documents"].iloc[0]
        held, lengths, known, base, shard = unpack(documents["body"])
        # pairs of a shard are in the block's order
        place = np.argsort(shard, kind="stable")
        starts = np.searchsorted(shard[place], np.arange(shards + 1))
        log_p = np.empty(len(shard))
        for row in frame[frame["kind"] == "scores"].itertuples():
            values, which = unpack(row.body)
            log_p[place[starts[row.shard] : starts[row.shard + 1]]] = values[which]
        (tokens,) = unpack(own["tokens"].iloc[0])
        _, pair = pair_places(tokens, lengths, int(own["n_words"].iloc[0]))
        return pd.DataFrame(
            {
                "doc_id": pd.array(list(documents["doc_ids"]), dtype="Int64"), "held_out": held > 0,
                "n_tokens": lengths.astype(np.int64), "n_known": known, "train_tokens": totals.tokens, "base_score": base,
                "score": np.add.reduceat(log_p[pair], _starts(lengths)),
            }
        )

    per_block = answered.where("kind <> 'trie'").groupBy("block")
    trie = answered.where("kind = 'trie'").select("shard", F.col("body").alias("levels"))
    texts = numbered.select("block", "n_words", "tokens").groupBy("block")
    return per_block.cogroup(texts).applyInPandas(finish, _SCORES), trie


def op9_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under a model of their training part."""
    return score(read(spark, sf_dir, "documents"))[0]

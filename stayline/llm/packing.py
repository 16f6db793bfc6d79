"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands.

A gene is a whole bin. Crossover injects well-filled bins of one parent into another, removes the bins that now hold a
document twice, and puts the displaced documents back by best fit. Pieces are dealt to blocks of bounded size, and every
block is settled by several islands, each a task with a population of its own. After an epoch the best individual of each
island migrates to the next island of its block, where it takes part in crossover, and in the end the best individual of the
block stays. Bins that are filled as good as fully are then final; the pieces of all others are dealt to new blocks, so poorly
filled remainders of different blocks meet.

Every island goes through at least one generation of an epoch, and stops early once it is at the least possible number of
bins. Where lengths are many and small against the capacity, as those of documents usually are, best fit alone is there
already; the search gains where few lengths fit together.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayline.llm.tables import blocks, map_batches, read, sized_broadcast, stored
from stayline.llm.tokens import default_tokenizer, encoder

CAPACITY = 2048
END_ID = 0
BLOCK_PIECES = 8_000
#: Populations per block, and of them: individuals, generations of an epoch, epochs between migrations.
ISLANDS = 2
POPULATION = 3
GENERATIONS = 4
EPOCHS = 2
#: Times that what is left over is dealt anew.
ROUNDS = 3
#: Waste, as a share of the capacity, up to which a bin is final before the last round.
FULL_WASTE = 0.002

#: Sequence ids of full pieces start here; those of islands are below.
_ALONE = 1 << 62
_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut(n_tokens: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: whole if it fits, else full pieces behind a first one that may be
    shorter."""
    if n_tokens <= capacity:
        return [(0, n_tokens)]
    first = n_tokens % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n_tokens, capacity)]


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of each document's ids (text, then the end id). A null text has the end id alone."""
    path = tokenizer or default_tokenizer()

    def tokenized(batch: pa.RecordBatch) -> dict:
        doc_ids = batch.column(0).to_pylist()
        texts = [text or "" for text in batch.column(1).to_pylist()]
        rows = []
        for doc_id, ids in zip(doc_ids, encoder(path).encode(texts), strict=True):
            ids = np.append(ids, np.uint32(end_id)).astype("<u4")
            for number, (start, length) in enumerate(cut(len(ids), capacity)):
                code = zlib.crc32(ids[start : start + length].tobytes())
                rows.append((doc_id, number, start, length, code))
        return dict(zip(("doc_id", "piece", "start", "length", "ids_crc32"), zip(*rows, strict=True), strict=True)) if rows else None

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), tokenized, _PIECES)


class _Bins:
    """Open bins by free room: best fit finds the fullest bin that still takes a piece."""

    def __init__(self, capacity: int, members: list[list[int]] | None = None, sizes: list[int] | None = None):
        self.capacity = capacity
        self.members = members or []
        self.rooms: list[int] = []
        self.by_room: dict[int, list[int]] = {}
        for at, own in enumerate(self.members):
            room = capacity - sum(sizes[i] for i in own)
            if room:
                self._offer(room, at)

    def _offer(self, room: int, at: int) -> None:
        if not (stack := self.by_room.setdefault(room, [])):
            bisect.insort(self.rooms, room)
        stack.append(at)

    def put(self, piece: int, size: int) -> None:
        where = bisect.bisect_left(self.rooms, size)
        if where == len(self.rooms):
            at, room = len(self.members), self.capacity
            self.members.append([])
        else:
            room = self.rooms[where]
            stack = self.by_room[room]
            at = stack.pop()
            if not stack:
                del self.rooms[where]
        self.members[at].append(piece)
        if room > size:
            self._offer(room - size, at)


def _best_fit(order, sizes: list[int], capacity: int, members: list[list[int]] | None = None) -> list[list[int]]:
    bins = _Bins(capacity, members, sizes)
    for piece in order:
        bins.put(piece, sizes[piece])
    return bins.members


def _fitness(members: list[list[int]], sizes: list[int], capacity: int) -> tuple[int, float]:
    """Few bins first; among equals, bins that are full beside bins that are nearly empty."""
    return len(members), -sum((sum(sizes[i] for i in own) / capacity) ** 2 for own in members)


def crossover(receiver: list[list[int]], donor: list[list[int]], sizes: list[int], capacity: int, rng) -> list[list[int]]:
    """Inject some of the donor's fullest bins whole, drop the receiver's bins that share a piece with them, and put the
    displaced pieces back by best fit, largest first."""
    ranked = sorted(range(len(donor)), key=lambda b: -sum(sizes[i] for i in donor[b]))
    well = ranked[: max(1, len(ranked) // 2)]
    injected = [donor[b] for b in rng.choice(well, size=max(1, len(well) // 4), replace=False).tolist()]
    inside = {i for own in injected for i in own}
    kept, displaced = [], []
    for own in receiver:
        if inside.isdisjoint(own):
            kept.append(list(own))
        else:
            displaced.extend(i for i in own if i not in inside)
    # some bins that survived are opened too, the emptiest and any others: their pieces may fill the rest
    loose = set(sorted(range(len(kept)), key=lambda b: sum(sizes[i] for i in kept[b]))[: -(-len(kept) // 20)])
    loose |= set(rng.integers(0, len(kept), len(kept) // 20).tolist()) if kept else set()
    for b in sorted(loose, reverse=True):
        displaced.extend(kept.pop(b))
    displaced.sort(key=lambda i: sizes[i])
    _exchange(kept, displaced, sizes, capacity)
    return _best_fit(displaced[::-1], sizes, capacity, kept + [list(own) for own in injected])


def _exchange(bins: list[list[int]], displaced: list[int], sizes: list[int], capacity: int) -> None:
    """Let larger displaced pieces take the place of smaller ones where a bin has room for the difference, as close to full
    as it goes; `displaced` stays in ascending order."""
    lengths = [sizes[i] for i in displaced]
    for own in bins:
        room = capacity - sum(sizes[i] for i in own)
        for at, piece in enumerate(own):
            if not room or not displaced:
                break
            where = bisect.bisect_right(lengths, sizes[piece] + room) - 1
            if where >= 0 and lengths[where] > sizes[piece]:
                room -= lengths[where] - sizes[piece]
                own[at] = displaced.pop(where)
                del lengths[where]
                back = bisect.bisect_left(lengths, sizes[piece])
                lengths.insert(back, sizes[piece])
                displaced.insert(back, piece)


def evolve(
    sizes: list[int], capacity: int = CAPACITY, population: int = POPULATION, generations: int = GENERATIONS, seed: int | list[int] = 0,
    settlers: list[list[list[int]]] = (),
) -> list[list[int]]:
    """Bins (lists of positions in `sizes`) of the best individual after the generations. `settlers` are individuals that
    join the first population; the rest of it comes from best fit, in falling order and in orders close to it. One
    generation is always made; the search ends before the others at the least possible number of bins."""
    if not sizes:
        return []
    rng = np.random.default_rng(seed)
    least = -(-sum(sizes) // capacity)
    people = [[list(own) for own in one] for one in settlers]
    if not people:
        people.append(_best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i]), sizes, capacity))
    while len(people) < population:
        # a shuffled order among pieces of similar size: other bins, of like quality
        jitter = np.asarray(sizes) * rng.uniform(0.8, 1.0, len(sizes))
        people.append(_best_fit(np.argsort(-jitter, kind="stable").tolist(), sizes, capacity))
    scored = sorted(((_fitness(p, sizes, capacity), p) for p in people), key=lambda x: x[0])
    for _ in range(generations):
        for _ in range(max(1, population // 2)):
            a, b = rng.choice(len(scored), 2, replace=False).tolist() if len(scored) > 1 else (0, 0)
            for donor, receiver in ((a, b), (b, a)):
                child = crossover(scored[receiver][1], scored[donor][1], sizes, capacity, rng)
                scored.append((_fitness(child, sizes, capacity), child))
                if scored[0][0][0] <= least:
                    break
        # individuals of equal fitness are as good as the same one
        scored = list(dict(sorted(scored, key=lambda x: x[0], reverse=True)).items())[::-1][:population]
        if scored[0][0][0] <= least:
            break
    return scored[0][1]


_STATE = "block bigint, island int, uid bigint, length bigint, own int, guest int"


def pack(found: DataFrame, capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32), a stored table.

    Every piece gets one place; places of a sequence are gapless from 0. Full pieces are sequences by themselves. Null
    ids, repeated documents and an empty table are allowed. Which documents share a sequence depends on how the stored
    table is split; a recomputed task sees the same split.
    """
    numbered = found.withColumn("uid", F.monotonically_increasing_id())
    full = F.col("length") == capacity
    alone = numbered.where(full).select("uid", (F.lit(_ALONE) + F.col("uid")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    # lengths and places travel; what else is known of a piece waits for its place
    left, done = numbered.where(~full).select("uid", "length"), [alone]
    for round_ in range(ROUNDS):
        total = left.count()
        if not total:
            break
        waste = capacity if round_ == ROUNDS - 1 else int(FULL_WASTE * capacity)
        placed = _settled(left, round_, blocks(total, block_pieces), capacity, waste)
        done.append(placed.where("sequence_id IS NOT NULL").select("uid", "sequence_id", "offset"))
        left = placed.where("sequence_id IS NULL").select("uid", "length")
    places = done[0]
    for more in done[1:]:
        places = places.unionByName(more)
    # numbers in order take so few bytes in a file that Spark would broadcast tables of many rows, here and below
    return numbered.join(places.hint("merge"), "uid").drop("uid")


def _settled(pieces_left: DataFrame, round_: int, n_blocks: int, capacity: int, waste: int) -> DataFrame:
    """uid, length, sequence_id and offset of all pieces; null where the bin is not full enough to stay."""
    def island(frame: pd.DataFrame, epoch: int) -> pd.DataFrame:
        frame = frame.sort_values("uid").reset_index(drop=True)
        sizes = frame["length"].tolist()
        seed = [round_, epoch, int(frame["block"].iloc[0]), int(frame["island"].iloc[0])]
        settlers = [_bins_of(frame[name].tolist()) for name in ("own", "guest") if frame[name].notna().all()]
        numbers = np.zeros(len(sizes), np.int32)
        for number, own in enumerate(evolve(sizes, capacity, seed=seed, settlers=settlers)):
            numbers[own] = number
        return frame.assign(own=numbers, guest=frame["guest"].astype("Int32"))

    # by place in the stored table, not by value: one document repeated many times must not fill a block
    block = F.pmod(F.xxhash64("uid", F.lit(round_)), F.lit(n_blocks)).alias("block")
    none = F.lit(None).cast("int")
    every = F.explode(F.array(*[F.lit(number) for number in range(ISLANDS)])).alias("island")
    state = pieces_left.select(block, every, "uid", "length", none.alias("own"), none.alias("guest"))
    def settle(epoch: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
        return lambda frame: island(frame, epoch)

    for epoch in range(EPOCHS):
        grown = state.groupBy("block", "island").applyInPandas(settle(epoch), _STATE)
        grown = stored(grown, f"packing-{round_}-{epoch}")
        # the elite of each island settles on the next one, too
        following = F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island")
        guests = grown.select("block", following, "uid", F.col("own").alias("guest"))
        state = grown.drop("guest").join(guests.hint("merge"), ["block", "island", "uid"])
    bins = grown.groupBy("block", "island", "own").agg(F.sum("length").alias("filled"))
    # fewest bins first, then bins that are full beside bins that are nearly empty
    judged = bins.groupBy("block", "island").agg(F.count("*").alias("n"), (-F.sum(F.col("filled") * F.col("filled"))).alias("spread"))
    best = judged.groupBy("block").agg(F.min(F.struct("n", "spread", "island")).alias("b")).select("block", F.col("b.island").alias("island"))
    chosen = grown.join(sized_broadcast(best, n_blocks), ["block", "island"]).join(bins.hint("merge"), ["block", "island", "own"])
    # round and block above, the bin below: unique without asking the other blocks
    number = F.lit(round_ << 56) + F.shiftleft("block", 24) + F.col("own")
    inside = Window.partitionBy("block", "own").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("length").over(inside), F.lit(0))
    final = F.col("filled") >= capacity - waste
    return stored(
        chosen.select("uid", "length", F.when(final, number).alias("sequence_id"), F.when(final, before).alias("offset")),
        f"packing-{round_}",
    )


def _bins_of(numbers: list[int]) -> list[list[int]]:
    bins: dict[int, list[int]] = {}
    for at, number in enumerate(numbers):
        bins.setdefault(number, []).append(at)
    return list(bins.values())


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their places, tokenised once."""
    return pack(stored(pieces(docs, tokenizer, capacity), "pieces"), capacity)


def op6_pack_genetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return pack_documents(read(spark, sf_dir, "documents"))

import random
import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from stayline.llm import packing
from stayline.llm.packing import crossover, cut, evolve
from stayline.llm.tokens import Encoder, default_tokenizer
from tests.llm.conftest import ODD


def whole(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    return [found.ids for found in tokenizer.encode_batch([text or "" for text in texts], add_special_tokens=False)]


ENCODER = Encoder(default_tokenizer())


@given(st.lists(st.text(alphabet=" \n\t\r \x1cabcAB1.'é🙂", max_size=20), max_size=8))
@settings(max_examples=150, deadline=None)
def test_remembered_words_give_the_ids_of_whole_texts(texts):
    assert [found.tolist() for found in ENCODER.encode(texts)] == whole(texts)


def test_encoder_drops_rare_words_and_starts_afresh(monkeypatch):
    texts = ["one two three", "four five <|endoftext|> six", "it's seven.\nEight 9", "one two\nten eleven twelve"]
    for limit in (3, 14):
        monkeypatch.setattr("stayline.llm.tokens.CACHE_UNITS", limit)
        own = Encoder(default_tokenizer())
        for text in texts * 3:
            assert own.encode([text])[0].tolist() == whole([text])[0]


def test_cut():
    assert cut(5, 4) == [(0, 1), (1, 4)] and cut(8, 4) == [(0, 4), (4, 4)] and cut(4, 4) == [(0, 4)] and cut(1, 4) == [(0, 1)]


@given(st.lists(st.integers(1, 100), max_size=60), st.integers(0, 5))
@settings(max_examples=60, deadline=None)
def test_evolved_bins_hold_every_piece_once(sizes, seed):
    bins = evolve(sizes, capacity=100, seed=seed)
    assert sorted(i for own in bins for i in own) == list(range(len(sizes)))
    assert all(0 < sum(sizes[i] for i in own) <= 100 for own in bins)


def test_crossover_keeps_pieces_and_injects_full_bins():
    pick = random.Random(5)
    sizes = [pick.randrange(1, 60) for _ in range(200)]
    people = [evolve(sizes, 100, generations=0, seed=s) for s in (1, 2)]
    child = crossover(people[0], people[1], sizes, 100, np.random.default_rng(3))
    assert sorted(i for own in child for i in own) == list(range(200))
    assert {tuple(own) for own in people[1]} & {tuple(own[: len(own)]) for own in child}


def test_the_search_beats_plain_best_fit():
    pick = random.Random(8)
    # triplets that fill bins exactly; best fit decreasing wastes bins on them
    sizes = []
    for _ in range(60):
        a, b = pick.randrange(38, 50), pick.randrange(26, 36)
        sizes += [a, b, 100 - a - b]
    plain = packing._best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i]), sizes, 100)
    assert 60 <= len(evolve(sizes, 100, population=8, generations=60, seed=1)) < len(plain)


def test_elites_of_islands_are_taken_in():
    pick = random.Random(9)
    sizes = [pick.randrange(26, 50) for _ in range(90)]
    good = evolve(sizes, 100, population=8, generations=60, seed=3)
    start = evolve(sizes, 100, population=1, generations=0, seed=1)
    assert len(good) < len(start)
    # a migrant is as good as what it brings, from the first generation on
    assert len(evolve(sizes, 100, population=2, generations=1, seed=4, settlers=[start, good])) <= len(good)


def test_islands_search_in_the_job(spark, docs):
    pick = random.Random(2)
    rows = []
    for n in range(60):
        a, b = pick.randrange(38, 50), pick.randrange(26, 36)
        rows += [(3 * n + k, 0, 0, length, 0) for k, length in enumerate((a, b, 100 - a - b))]
    pick.shuffle(rows)
    kind = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    found = packing.pack(packing.stored(spark.createDataFrame(rows, kind), "pieces"), 100)
    plain = packing._best_fit(sorted(range(180), key=lambda i: -rows[i][3]), [r[3] for r in rows], 100)
    filled = defaultdict(int)
    for row in found.collect():
        filled[row.sequence_id] += row.length
    assert max(filled.values()) <= 100 and 60 <= len(filled) < len(plain)


def check(texts, packed, capacity):
    ids = {n: np.array([*found, 0], dtype="<u4") for n, found in enumerate(whole(texts))}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in packed:
        by_doc[row.doc_id].append(row)
        by_sequence[row.sequence_id].append(row)
    assert set(by_doc) == set(ids)
    for n, own in ids.items():
        rows = sorted(by_doc[n], key=lambda r: r.piece)
        assert [(r.start, r.length) for r in rows] == cut(len(own), capacity)
        assert [r.ids_crc32 for r in rows] == [zlib.crc32(own[r.start : r.start + r.length].tobytes()) for r in rows]
    for rows in by_sequence.values():
        at = 0
        for row in sorted(rows, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at <= capacity
    return len(by_sequence)


def test_documents_are_packed_whole(docs):
    pick = random.Random(3)
    texts = [*ODD, *["w " * pick.randrange(1, 90) for _ in range(120)], "an <|endoftext|> inside"]
    packed = packing.pack_documents(docs(*texts), capacity=64)
    total = sum(len(found) + 1 for found in whole(texts))
    assert check(texts, packed.collect(), 64) <= 1.15 * total / 64


def test_small_blocks_and_repeated_documents(spark, docs):
    frame = docs(*[(7, "same text here")] * 40, (None, "no id"), (None, None))
    found = packing.pack(packing.stored(packing.pieces(frame, capacity=16), "pieces"), 16, block_pieces=5).collect()
    assert len(found) == 42 and len({(r.sequence_id, r.offset) for r in found}) == 42
    assert packing.pack_documents(frame.where("false")).count() == 0

import math
import random
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from stayline.llm import ngram_trie
from stayline.llm.ngram_trie import EliasFano, Trie, build, pack, quantise, score, unpack
from tests.llm.conftest import ODD


@given(st.lists(st.integers(0, 5000), max_size=300), st.lists(st.integers(0, 6000), max_size=50))
@settings(max_examples=100, deadline=None)
def test_elias_fano(values, wanted):
    values = sorted(values)
    level = EliasFano.of(np.array(values, dtype=np.uint64))
    assert level.get(np.arange(len(values))).tolist() == values
    got = level.successor(np.array(wanted, dtype=np.uint64)).tolist()
    assert got == np.searchsorted(values, wanted).tolist()


@given(st.lists(st.tuples(st.integers(0, 20), st.integers(1, 40)), max_size=200), st.integers(0, 3))
@settings(max_examples=60, deadline=None)
def test_trie_knows_what_it_was_built_from(pairs, seed):
    context = np.array([c for c, _ in pairs], dtype=np.uint64)
    word = np.array([w for _, w in pairs], dtype=np.uint64)
    counts, seen = Counter(c for c, _ in pairs), Counter(pairs)
    own = {w: math.log10((w + 1) / 1000) for w in range(50)}
    of_context = np.array([counts[c] for c, _ in pairs], dtype=np.uint64)
    trie = build(context, word, of_context, np.array([own[w] for _, w in pairs]))
    trie = Trie.from_bytes(trie.to_bytes())
    asked = [(c, w) for c in range(22) for w in range(1, 45)]
    got = trie.score(*[np.array(x, dtype=np.uint64) for x in zip(*asked)], np.array([own[w] for _, w in asked]))
    for (c, w), value in zip(asked, got):
        exact = own[w]
        if counts[c]:
            exact = math.log10((seen[c, w] + ngram_trie.MU * 10 ** own[w]) / (counts[c] + ngram_trie.MU))
        assert abs(value - exact) < 0.02


def test_packing_of_arrays():
    arrays = [np.arange(5, dtype=np.uint64) << np.uint64(33), np.zeros(0, np.uint8), np.array([1.5, -2.0]), np.array([7], np.uint16)]
    for before, after in zip(arrays, unpack(pack(*arrays)), strict=True):
        assert before.dtype == after.dtype and before.tolist() == after.tolist()


def test_codes_are_a_step_apart_at_most():
    values = np.random.default_rng(1).normal(-5, 2, 5000)
    codes, book = quantise(values)
    assert abs(book[codes] - values).max() <= (values.max() - values.min()) / 256


def plain(rows):
    tokens = {n: [w for w in (text or "").encode().lower().split()] + [b"\n"] for n, text in rows}
    held = {n: zlib.crc32(str(n).encode()) % 7 == 2 for n, _ in rows}
    train = [tokens[n] for n in tokens if not held[n]]
    counts = Counter(w for words in train for w in words)
    pairs = Counter((a, b) for words in train for a, b in zip([None, *words], words))
    total, distinct = sum(counts.values()), len(counts)

    def own(w):
        return (counts[w] + 1) / (total + distinct + 1)

    out = {}
    for n, words in tokens.items():
        base = sum(math.log10(own(w)) for w in words)
        value = 0.0
        for a, b in zip([None, *words], words):
            times = len(train) if a is None else counts[a]
            value += math.log10((pairs[a, b] + ngram_trie.MU * own(b)) / (times + ngram_trie.MU))
        out[n] = (held[n], len(words), sum(counts[w] > 0 for w in words), total, base, value)
    return out


def test_scores_agree_with_counting(docs, monkeypatch):
    pick = random.Random(7)
    words = [f"w{int(pick.paretovariate(0.7))}" for _ in range(400)]
    rows = list(enumerate([*[" ".join(pick.choice(words) for _ in range(pick.randrange(1, 80))) for _ in range(150)], *ODD]))
    wanted = plain(rows)
    # many blocks and shards, and contexts that are spread over several
    for name, value in (("BLOCK_DOCS", 9), ("SHARD_ENTRIES", 9_000), ("SPREAD", 300)):
        monkeypatch.setattr(ngram_trie, name, value)
    scores, trie = score(docs(*rows))
    got = {r.doc_id: tuple(r)[1:] for r in scores.collect()}
    assert set(got) == set(wanted)
    for n, row in wanted.items():
        assert got[n][:4] == row[:4]
        assert abs(got[n][4] - row[4]) <= 1e-9 * abs(row[4]) + 1e-9
        assert abs(got[n][5] - row[5]) <= 0.03 * row[1]
    assert trie.count() > 3


def test_nothing_to_learn_from(docs):
    held = next(n for n in range(100) if zlib.crc32(str(n).encode()) % 7 == 2)
    rows = score(docs((held, "a b"), (held, "a b")))[0].collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows] == [(True, 3, 0, 0, 0.0)] * 2
    assert score(docs("a").where("false"))[0].count() == 0
    null = score(docs((None, "a a"), (None, None)))[0].collect()
    assert len(null) == 2 and {r.train_tokens for r in null} == {4}


def test_a_pair_is_one_entry_of_a_block(docs, monkeypatch):
    rows = [(n, "same run of words " * 200 + f"own{n}") for n in range(30)]
    monkeypatch.setattr(ngram_trie, "BLOCK_DOCS", 5)
    frame = docs(*rows).repartition(1)
    numbered = ngram_trie.number_words(frame)
    counted = ngram_trie.count_words(numbered, 1).cache()
    part = counted.first()
    totals = ngram_trie.Totals(part.n_train, part.n_distinct, 30, np.zeros(1, dtype=np.int64))
    dealt = [r for r in ngram_trie.deal_pairs(numbered, counted, totals, 3).collect() if r.kind == "pairs"]
    entries = Counter()
    trained = Counter()
    for row in dealt:
        contexts, runs, _, words, _, times = unpack(row.body)
        for pair, often in zip(zip(np.repeat(contexts, runs).tolist(), words.tolist()), times.tolist()):
            entries[row.block, *pair] += 1
            trained[pair] += often
    assert set(entries.values()) == {1}
    # four pairs run through all texts, the last of them once less often in each
    train = [n for n, _ in rows if zlib.crc32(str(n).encode()) % 7 != 2]
    assert sorted(trained.values())[-4:] == [199 * len(train)] + [200 * len(train)] * 3
    wanted = plain(rows)
    for row in score(frame)[0].collect():
        assert abs(row.score - wanted[row.doc_id][5]) <= 0.03 * wanted[row.doc_id][1]

import itertools
import random

import xxhash

from stayline.llm import simhash
from stayline.llm.graph import components
from tests.llm.conftest import ODD


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lowered.encode().split()]
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints_are_majorities():
    texts = ["One two THREE four\tfive", "one two", "One", "ä Ö ü é", "a b c d e f g a b c"]
    for text in texts:
        assert simhash.fingerprint(text.encode()) & (1 << 64) - 1 == plain_fingerprint(text)
    assert simhash.fingerprint(b"") == 0


def test_links_are_all_pairs_within_three_bits(spark):
    pick = random.Random(4)
    base = [pick.getrandbits(64) for _ in range(40)]
    prints = set(base)
    for value in base:
        for _ in range(6):
            prints.add(value ^ sum(1 << b for b in pick.sample(range(64), pick.randrange(1, 6))))
    prints |= {0, 1, (1 << 64) - 1, (1 << 64) - 2, 0x5555555555555555, 0xAAAAAAAAAAAAAAAA}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {tuple(sorted(row)) for row in simhash.links(spark.createDataFrame([(p,) for p in signed], "print bigint")).collect()}
    assert got == {
        tuple(sorted(pair)) for pair in itertools.combinations(signed, 2)
        if ((pair[0] ^ pair[1]) & (1 << 64) - 1).bit_count() <= 3
    }


def test_components_reach_along_chains(spark):
    pick = random.Random(1)
    pairs = [(n, n + 1) for n in range(100, 180)] + [(500, n) for n in range(510, 560)] + [(7, 7), (1000, 900), (900, 1000)]
    pick.shuffle(pairs)
    frame = spark.createDataFrame([*pairs, (None, 3)], "u bigint, v bigint")
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    assert {r.node: r.root for r in components(frame).collect()} == roots(nodes, [p for p in pairs if p[0] != p[1]])
    assert components(frame.where("false")).count() == 0


def near_copies():
    pick = random.Random(9)
    words = [f"w{n}" for n in range(400)]
    rows = []
    for group in range(12):
        text = [pick.choice(words) for _ in range(pick.randrange(5, 300))]
        for _ in range(pick.randrange(1, 6)):
            own = list(text)
            if pick.random() < 0.6:
                own[pick.randrange(len(own))] = "changed"
            rows.append(" ".join(own))
    return [*rows, *ODD, rows[0], None]


def test_near_duplicates_agree_with_comparing_all(docs):
    texts = near_copies()
    prints = {n: plain_fingerprint(text) for n, text in enumerate(texts)}
    pairs = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 3]
    wanted = roots(prints, pairs)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs(*texts)).collect()}
    assert got == {n: (f"{prints[n]:016x}", wanted[n]) for n in prints}


def test_one_document_of_each_group_stays(docs):
    texts = near_copies()
    frame = docs(*texts).withColumnRenamed("lang", "_print")  # a column that clashes with an own one
    kept = simhash.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    groups = {r.component_id for r in simhash.near_duplicates(docs(*texts)).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(groups)
    repeated = docs((None, "a b c"), (None, "a b c"), (3, "a b c"), (3, "a b c"), (5, "x y z q r s"), (5, "x y z q r s"))
    assert sorted(r.doc_id for r in simhash.drop_near_duplicates(repeated).collect()) == [3, 5]
    assert simhash.drop_near_duplicates(repeated.where("false")).count() == 0

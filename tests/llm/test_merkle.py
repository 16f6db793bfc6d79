import hashlib
import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from stayline.llm import merkle as m
from tests.llm.conftest import ODD


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][at : at + 8])) for at in range(0, len(out[-1]), 8)])
    return out


def siblings(tree, at):
    """(before, behind) of a leaf and its ancestors below the root."""
    out = []
    for nodes in tree[:-1]:
        first = at // 8 * 8
        out.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + 8])))
        at //= 8
    return out


def plain(rows):
    """Rows of `verified` from whole trees; rows are (doc_id, text, lang)."""
    def leaf(doc_id, text, lang):
        return h("".join(map(field, (doc_id, "s", lang, None if text is None else len(text), text))))

    def lower(text):
        return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)

    made = []
    for doc_id, text, lang in rows:
        changed = None
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            n_chars = None if text is None else len(text)
            changed = h("".join(map(field, (doc_id, "s", lang, n_chars, lower(text)))))
        made.append((doc_id, lang, leaf(doc_id, text, lang), changed))
    groups = {}
    for row in sorted(made, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(row[1], []).append(row)
    langs = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {lang: levels([r[2] for r in groups[lang]]) for lang in langs}
    top = levels([trees[lang][-1][0] for lang in langs])
    out = []
    for place, lang in enumerate(langs):
        for at, (doc_id, _, own, changed) in enumerate(groups[lang]):
            path = siblings(trees[lang], at) + siblings(top, place)
            value = changed or own
            for before, behind in path:
                value = h(before + value + behind)
            proof = h("".join(a + b for a, b in path))
            out.append((doc_id, own, trees[lang][-1][0], top[-1][0], proof, value, value == top[-1][0]))
    return sorted(out, key=repr)


def check(frame, rows):
    got = sorted((tuple(r) for r in m.verified(frame).collect()), key=repr)
    assert got == plain(rows)
    return got


def test_agrees_with_whole_trees(docs):
    # more leaves than one task builds at once, several languages, null languages and ids, repeated rows
    big = [(n, f"Text {n}", "en") for n in range(4_200)]
    langs = itertools.cycle([None, "de", "é", "Z", "a,b", ""])
    odd = [(10_000 + n, text, next(langs)) for n, text in enumerate(ODD)]
    more = [(None, "No id", "de"), (None, "No id", "de"), (None, None, None), (3, "TWICE", "en"), (3, "TWICE", "en"), (3, "other", "en")]
    got = check(docs(*(rows := big + odd + more)), rows)
    assert 0 < sum(not row[-1] for row in got) < len(got) // 2


def test_small_tables(docs):
    check(docs((5, "Alone", "en")), [(5, "Alone", "en")])
    check(docs(*(rows := [(n, "T", "en") for n in range(9)])), rows)
    check(docs(*(rows := [(n, "T", f"l{n}") for n in range(9)])), rows)
    assert m.verified(docs((1, "a", "b")).where("false")).collect() == []


def test_partial_proofs_need_few_nodes_and_lead_to_the_root(docs):
    rows = docs(*[(n, f"Text {n}", "en" if n % 7 else "fr") for n in range(700)])
    known = m.manifest(rows.select("doc_id", "lang", m.leaf_hash().alias("leaf"), F.lit(None).cast("string").alias("claim")))
    asked = known.leaves.where("doc_id IN (3, 4, 7, 699)").select("tree", "pos", "size", "doc_id", "leaf", "claim")
    got = m.prove(known, asked, "claim").collect()
    root = known.trees.head()["root"]
    assert sorted(r.doc_id for r in got) == [3, 4, 7, 699] and all(r.folded_root == root for r in got)
    wanted = {r.doc_id: r for r in m.verified(rows).collect()}
    assert all(r.proof_sha256 == wanted[r.doc_id].proof_sha256 for r in got)


def test_missing_coordinates_are_the_least():
    everything = {level: gaps.tolist() for level, gaps in m.missing(np.arange(70), 70)}
    assert everything == {0: [], 1: [], 2: []}
    two = {level: gaps.tolist() for level, gaps in m.missing(np.array([0, 1, 69]), 70)}
    assert two == {0: [2, 3, 4, 5, 6, 7, 64, 65, 66, 67, 68], 1: [1, 2, 3, 4, 5, 6, 7], 2: []}
    assert list(m.missing(np.array([0]), 1)) == []


def test_other_columns_do_not_matter(docs):
    frame = docs((1, "Ab", "en"), (2, "Cd", "en"))
    extra = frame.withColumn("tree", F.lit(1)).withColumn("pos", F.lit("x")).withColumn("leaf", F.lit(None))
    assert sorted(map(tuple, m.verified(extra).collect())) == sorted(map(tuple, m.verified(frame).collect()))

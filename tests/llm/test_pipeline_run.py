"""The whole pipeline on planted documents, row by row beside plain Python."""

import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np

import corpus_pipeline
from stayline.llm.packing import CAPACITY, cut
from tests.llm.test_line_dedup import plain as plain_lines
from tests.llm.test_packing import whole
from tests.llm.test_simhash import plain_fingerprint, roots

SYLLABLES = {
    "aa": ["ka", "to", "mi", "ne", "su", "ri", "po", "wa"],
    "bb": ["schu", "ber", "ung", "zei", "kraf", "dorf", "milch", "strum"],
    "cc": ["éla", "oui", "ré", "çon", "eau", "ille", "ère", "ouv"],
}


def words(lang, pick, count):
    return ["".join(pick.choice(SYLLABLES[lang]) for _ in range(3)) for _ in range(count)]


def broken(own, width):
    return "\n".join(" ".join(own[at : at + width]) for at in range(0, len(own), width))


def planted():
    pick = random.Random(12)
    langs = [["aa", "bb", "cc"][n % 3] for n in range(60)]
    plain = [words(lang, pick, 75) for lang in langs]
    rows = [(n, broken(own, 25), lang) for n, (own, lang) in enumerate(zip(plain, langs, strict=True))]
    items = [(n, " ".join(words("aa", pick, 15))) for n in range(3)]
    line = lambda n, at: rows[n][1].split("\n")[at]
    changed = line(4, 1).split(" ")
    changed[7] = "another"
    far = list(plain[8])
    far[10], far[50] = "other", "words"
    more = [
        "\n".join([line(3, 0), " ".join(words("aa", pick, 25))]),  # a line stands earlier
        "\n".join([" ".join(words("bb", pick, 25)), " ".join(changed)]),  # a similar line does
        rows[5][1],  # all lines do
        broken(plain[6], 38),  # the same words in other lines
        broken(plain[7][:-1] + ["anders"], 38),  # nearly
        broken(far, 19),  # less so
        broken(words("aa", pick, 60), 20) + "\n" + items[0][1].upper(),  # a fifth of it from the benchmark
        broken(words("aa", pick, 400), 40) + "\n" + items[1][1],  # less than a twentieth
        broken(words("cc", pick, 3_000), 30),  # longer than a sequence
        "12 34 ...", None, "",
    ]
    every = rows + [(100 + n, text, "aa") for n, text in enumerate(more)]
    pick.shuffle(every)
    return every, items


def plain_run(rows, items):
    """doc_id and text of what reaches the last stage; every letter tells its language here."""
    docs = {doc_id: text for doc_id, text, _ in rows if text and any(c.isalpha() for c in text)}
    kept = {}
    for doc_id, (n_lines, removed) in plain_lines(list(docs.items())).items():
        lines = [line for at, line in enumerate(docs[doc_id].split("\n")) if at not in removed]
        if len(removed) < n_lines:
            kept[doc_id] = "\n".join(lines)
    prints = {doc_id: plain_fingerprint(text) for doc_id, text in kept.items()}
    pairs = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 3]
    kept = {doc_id: text for doc_id, text in kept.items() if roots(prints, pairs)[doc_id] == doc_id}
    split = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda c: c[0].lower(), text))
    windows = {tuple(w[at : at + 13]) for w in (split(text) for _, text in items) for at in range(len(w) - 12)}
    out = {}
    for doc_id, text in kept.items():
        own = split(text)
        hit = {at + k for at in range(len(own) - 12) if tuple(own[at : at + 13]) in windows for k in range(13)}
        if not hit or 20 * len(hit) < len(own):
            out[doc_id] = text
    return out


def test_run_agrees_with_plain_python(spark, tmp_path):
    rows, items = planted()
    full = [(doc_id, text, lang, "s", None if text is None else len(text)) for doc_id, text, lang in rows]
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(full, kind).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    wanted = plain_run(rows, items)
    # each plant has its effect, and nothing else goes
    assert set(range(60)) <= set(wanted) and {100, 101, 105, 107, 108} <= set(wanted)
    assert not {102, 103, 106, 109, 110, 111} & set(wanted)
    pieces = set()
    for (doc_id, text), ids in zip(wanted.items(), whole(list(wanted.values())), strict=True):
        ids = np.array([*ids, 0], dtype="<u4")
        for number, (start, length) in enumerate(cut(len(ids))):
            pieces.add((doc_id, number, start, length, zlib.crc32(ids[start : start + length].tobytes())))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(pieces)
    sequences = defaultdict(list)
    for row in got:
        sequences[row.sequence_id].append((row.offset, row.length))
    for places in sequences.values():
        ends = list(itertools.accumulate(length for _, length in sorted(places)))
        assert [offset for offset, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= CAPACITY
    assert len(sequences) == -(-sum(length for *_, length, _ in pieces) // CAPACITY)

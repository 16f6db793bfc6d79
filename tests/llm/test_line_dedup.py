import itertools
import random
import re
from pathlib import Path

from pyspark.sql import functions as F

from stayline.llm import line_dedup
from stayline.llm.line_dedup import drop_repeated_lines, line_links, mark_lines
from stayline.sources.store import shared_root
from tests.llm.conftest import ODD

BITS = 10


def plain(rows):
    """Removed lines by comparing every two lines; rows are (doc_id, text) with different doc_ids."""
    first = {}
    for doc_id, text in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
        for number, line in enumerate(text.split("\n")):
            if re.search(r"[^ \x09-\x0D]", line):
                first.setdefault(line, (doc_id, number))
    sets = {line: {w for w in re.split(r"[ \x09-\x0D]+", line.lower()) if w} for line in first}
    lines, gone = sorted(first, key=first.get), set()
    for n, later in enumerate(lines):
        for earlier in lines[:n]:
            shared = len(sets[later] & sets[earlier])
            if 5 * shared >= 4 * len(sets[later] | sets[earlier]):
                gone.add(later)
    out = {}
    for doc_id, text in rows:
        spoken = [(n, line) for n, line in enumerate((text or "").split("\n")) if re.search(r"[^ \x09-\x0D]", line)]
        removed = [n for n, line in spoken if line in gone or first[line] != (doc_id, n)]
        out[doc_id] = (len(spoken), removed)
    return out


def marked(frame, **more):
    return {r.doc_id: (r.n_lines, list(r.removed_lines)) for r in mark_lines(frame, BITS, **more).collect()}


def test_agrees_with_comparing_all_lines(docs):
    pick = random.Random(6)
    words = [f"w{n}" for n in range(30)] + ["the"] * 5
    lines = [" ".join(pick.choice(words) for _ in range(pick.randrange(1, 14))) for _ in range(60)]
    for line in list(lines):
        own = line.split()
        own[pick.randrange(len(own))] = pick.choice(words)
        lines.append(" ".join(own))
        lines.append(line.upper())
    texts = ["\n".join(pick.choice(lines) for _ in range(pick.randrange(1, 8))) for _ in range(60)]
    rows = list(enumerate([*texts, *ODD, texts[0]]))
    assert marked(docs(*rows)) == plain(rows)


def test_thresholds_are_exact(docs):
    # 4 of 5 words shared is a match, 3 of 4 is none
    rows = [(0, "a b c d"), (1, "a b c d e"), (2, "k l m"), (3, "k l m n"), (4, "D c B a"), (5, "a  b c d")]
    got = marked(docs(*rows))
    assert {n: row[1] for n, row in got.items()} == {0: [], 1: [0], 2: [], 3: [], 4: [0], 5: [0]}
    assert got == plain(rows)


def test_chains_and_many_variants(docs):
    # every line matches the one before it, and only neighbours match: all but the first go
    chain = [" ".join(f"w{n}" for n in range(at, at + 10)) for at in range(40)]
    pick = random.Random(3)
    base = [f"v{n}" for n in range(40)]
    variants = []
    for _ in range(80):
        own = list(base)
        for _ in range(pick.randrange(1, 9)):
            own[pick.randrange(40)] = f"x{pick.randrange(500)}"
        variants.append(" ".join(own))
    rows = list(enumerate(chain + variants))
    assert marked(docs(*rows)) == plain(rows)


def test_repeated_rows_lose_the_same_lines(docs):
    frame = docs((5, "one line\nmore"), (5, "one line\nmore"), (None, "one line"), (6, "own text"), (6, "one line"))
    rows = sorted((r.doc_id or 0, r.n_lines, list(r.removed_lines)) for r in mark_lines(frame, BITS).collect())
    assert rows == [(0, 1, []), (5, 2, [0]), (5, 2, [0]), (6, 1, []), (6, 1, [0])]


def test_documents_keep_their_columns(docs):
    frame = docs((0, "first\n\nsecond"), (1, "first"), (2, "third\nFIRST\nend"), (3, None), (4, " \n "), (5, "a\na\nb"))
    frame = frame.withColumnRenamed("lang", "n_lines").withColumnRenamed("source", "_m_n_lines")
    frame = frame.withColumns({"_kept": F.lit(1), "_links": F.lit(2), "_first_kept": F.lit(3), "_code": F.lit(4)})
    kept = drop_repeated_lines(frame)
    assert kept.columns == frame.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in kept.collect()}
    assert got == {
        0: ("first\n\nsecond", 13), 2: ("third\nend", 9), 3: (None, None), 4: (" \n ", 3), 5: ("a\nb", 3)
    }
    assert drop_repeated_lines(frame.where("false")).count() == 0


def test_main_path_runs_no_python(docs):
    plan = mark_lines(docs("a b", "a c"), BITS)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_tables_of_finished_steps_are_dropped(spark, docs):
    home = Path(shared_root(spark)) / "stayline" / spark.sparkContext.applicationId
    before = set(home.glob("*")) if home.exists() else set()
    lines, links = line_links(docs("a b c d", "a b c d e", "other"), BITS)
    left = sorted(path.name.rsplit("-", 1)[0] for path in set(home.glob("*")) - before)
    assert left == ["line-links", "lines"]
    assert (lines.count(), links.count()) == (3, 1)


def plain_links(rows):
    """Links of the lines that stand first in each document, by comparing every two different lines."""
    first = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if re.search(r"[^ \x09-\x0D]", line):
                first.setdefault(line, doc_id)
    sets = {line: {w for w in re.split(r"[ \x09-\x0D]+", line.lower()) if w} for line in first}
    counts = dict.fromkeys((doc_id for doc_id, _ in rows), 0)
    for a, b in itertools.combinations(first, 2):
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            counts[first[a]] += 1
            counts[first[b]] += 1
    return counts


def test_every_link_is_counted(docs):
    pick = random.Random(11)
    base = [f"v{n}" for n in range(40)]
    # variants of one line, all linked to the first and many to each other
    variants = [" ".join(w if pick.random() > 0.06 else f"x{pick.randrange(9)}" for w in base) for _ in range(50)]
    mixed = ["a b c d", "a b c d e", "D c B a", "k l m", "k l m n", "a b c d\nA B C D\nown text", "", None, "a b c d"]
    rows = list(enumerate([base[0], " ".join(base), *variants, *mixed]))
    wanted = plain_links(rows)
    assert sum(wanted.values()) > 1000
    assert {r.doc_id: r.n_links for r in mark_lines(docs(*rows), BITS).collect()} == wanted
    assert marked(docs(*rows)) == plain(rows)


def variants_of(base, lines, edits, pick, spare=400):
    """Lines that differ from the base by 0 to `edits` words put in its words' places."""
    made = []
    for _ in range(lines):
        own = list(base)
        for _ in range(pick.randrange(edits + 1)):
            own[pick.randrange(len(own))] = f"x{pick.randrange(spare)}"
        made.append(" ".join(own))
    return made


def test_variants_of_a_line_are_counted_and_not_listed(docs, monkeypatch):
    written = {}
    store = line_dedup.stored

    def counting(df, name, path=None):
        table = store(df, name, path)
        written[name] = table.count()
        return table

    monkeypatch.setattr(line_dedup, "stored", counting)
    pick = random.Random(5)
    lines = variants_of([f"v{n}" for n in range(60)], 150, 4, pick)
    lines += variants_of([f"u{n}" for n in range(30)], 60, 2, pick, spare=20) + [f"{n} of nine words that are the same" for n in range(60)]
    lines += [" ".join(w.upper() if n >> at & 1 else w for at, w in enumerate("k l m n o".split())) for n in range(32)]
    pick.shuffle(lines)
    rows = list(enumerate(lines))
    wanted = plain_links(rows)
    assert sum(wanted.values()) > 10_000
    assert {r.doc_id: r.n_links for r in mark_lines(docs(*rows), BITS).collect()} == wanted
    assert marked(docs(*rows)) == plain(rows)
    assert written["line-links"] < 5 * len(lines)


def test_members_that_share_differences_are_told_apart(docs):
    pick = random.Random(8)
    # few places and few words, so that members share differences and links hang on how many
    base = [f"v{n}" for n in range(20)]
    lines = [" ".join(base)]
    for _ in range(150):
        own = list(base)
        for at in pick.sample(range(6), pick.randrange(1, 4)):
            own[at] = f"x{at}{pick.randrange(2)}"
        lines.append(" ".join(own[: 20 - pick.randrange(2)]))
    rows = list(enumerate(lines))
    wanted = plain_links(rows)
    assert {r.doc_id: r.n_links for r in mark_lines(docs(*rows), BITS).collect()} == wanted
    assert marked(docs(*rows)) == plain(rows)


def _written(monkeypatch):
    """Rows of each table that is stored, by name."""
    written, store = {}, line_dedup.stored

    def counting(df, name, path=None):
        table = store(df, name, path)
        written[name] = table.count()
        return table

    monkeypatch.setattr(line_dedup, "stored", counting)
    return written


def test_members_with_many_shared_differences_are_not_listed(docs, monkeypatch):
    written = _written(monkeypatch)
    pick = random.Random(4)
    base = [f"v{n}" for n in range(100)]
    lines = [" ".join(base)]
    for changes in [*[pick.randrange(1, 4) for _ in range(30)], *[pick.randrange(12, 15) for _ in range(30)]]:
        own = list(base)
        for at in pick.sample(range(24), changes):
            own[at] = f"x{at}{pick.randrange(3)}"
        lines.append(" ".join(own))
    rows = list(enumerate(lines))
    wanted = plain_links(rows)
    assert sum(wanted.values()) > 1_000
    assert {r.doc_id: r.n_links for r in mark_lines(docs(*rows), BITS).collect()} == wanted
    assert written["line-links"] < len(lines)


def test_long_lines_that_share_few_words_are_no_candidates(docs, monkeypatch):
    written = _written(monkeypatch)
    pick = random.Random(9)
    # ten words in common, some of them in the prefix, and 140 of their own
    lines = [" ".join([*[f"s{n}" for n in range(10)], *[f"w{at}x{n}" for n in range(140)]]) for at in range(30)]
    lines.append(lines[0] + " more")
    pick.shuffle(lines)
    lines, links = line_links(docs(*enumerate(lines)), 2)
    assert links.count() == 1
    assert written["candidates"] < 10

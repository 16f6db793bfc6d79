import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from stayline.llm import minhash as m
from tests.llm.conftest import ODD


def plain(text, width=m.SHINGLE_WORDS):
    """Fingerprint by definition: minima of bins, and a walk over all bins for each empty one."""
    words = [zlib.crc32(w.encode()) for w in re.split(r"[ \t\n\x0B\f\r]+", text.lower()) if w]
    if not words:
        return ""
    factors = m._factors(width)
    runs = [words[at : at + width] for at in range(max(1, len(words) - width + 1))]
    least = {}
    for run in runs:
        h = sum(x * f for x, f in zip(run, factors, strict=False)) % m.PRIME
        least[h >> m.VALUE_BITS] = min(h, least.get(h >> m.VALUE_BITS, h))
    digits = []
    for own in range(m.BINS):
        walk = sorted(range(m.BINS), key=lambda other: hashlib.md5(f"{own}:{other}".encode()).hexdigest())
        chosen = own if own in least else next(other for other in walk if other in least)
        digits.append(f"{least[chosen] & 15:x}")
    return "".join(digits)


def expected(rows):
    """Rows of `neighbours` by sorting everything; rows are (doc_id, text) with different ids."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for (doc_id, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out[doc_id] = (len(text), sha, plain(text), plain(edited), plain(after))
    return out


def found(frame, **more):
    return [(r[0], tuple(r)[1:]) for r in m.neighbours(frame, **more).collect()]


def test_agrees_with_the_definition_on_odd_texts_in_many_slices(docs):
    pick = random.Random(5)
    texts = [*ODD, *(" ".join(f"Wort{pick.randrange(90)}" for _ in range(n)) for n in (1, 4, 5, 6, 30, 300)), "Ä ö ß"]
    ids = pick.sample(range(-(10**12), 10**12), len(texts) - 1) + [None]
    rows = list(zip(ids, texts, strict=True))
    for slice_rows in (3, 2_000):
        assert dict(found(docs(*rows), slice_rows=slice_rows)) == expected(rows)


def test_one_document_follows_itself_and_none_gives_none(docs):
    rows = [(7, "one two three four five six")]
    assert dict(found(docs(*rows))) == expected(rows)
    assert found(docs(*rows).where("false")) == []


def test_a_repeated_id_spreads_over_slices(docs):
    # rows of one id follow each other in some order, each once; the next id comes after the last of them
    rows = [(5, f"copy {n} a b c d e") for n in range(40)] + [(9, "first of all x y z"), (1, "last of all u v w")]
    frame = docs(*rows)
    slices = m.in_slices(frame, 4)
    assert slices.where("doc_id = 5").select("slice").distinct().count() > 4
    got = found(frame, slice_rows=4)
    assert len(got) == 42
    followers = [row[4] for _, row in got]
    assert sorted(followers) == sorted(plain(text) for _, text in rows)
    assert dict(got)[1][4] == plain(rows[40][1])
    equal = found(docs(*[(5, "same text here of six words")] * 30), slice_rows=4)
    assert len(set(equal)) == 1 and len(equal) == 30


def test_columns_of_other_names_are_not_touched(docs):
    frame = docs((1, "a b c d e f g")).withColumnRenamed("lang", "_sums").withColumnRenamed("source", "_bins")
    got = m.with_fingerprint(frame, "text", "print")
    assert got.columns == [*frame.columns, "print"]
    assert got.head()["print"] == plain("a b c d e f g")
    assert m.with_fingerprint(docs((1, None)), "text", "print").head()["print"] is None


def test_likeness_estimates_similarity(docs, spark):
    pick = random.Random(8)
    errors = []
    pairs = []
    for share in (0.0, 0.3, 0.6, 0.8, 0.95, 1.0):
        for _ in range(6):
            a = [f"w{pick.randrange(10**6)}" for _ in range(800)]
            cut = int(len(a) * share)
            b = a[:cut] + [f"v{pick.randrange(10**6)}" for _ in range(800 - cut)]
            runs = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (a, b)]
            pairs.append((" ".join(a), " ".join(b), len(runs[0] & runs[1]) / len(runs[0] | runs[1])))
    frame = spark.createDataFrame(pairs, "a string, b string, jaccard double")
    frame = m.with_fingerprint(m.with_fingerprint(frame, "a", "x"), "b", "y")
    for row in frame.select("jaccard", m.likeness(F.col("x"), F.col("y")).alias("like")).collect():
        errors.append(row.like - row.jaccard)
        assert 0 <= row.like <= 1 and abs(errors[-1]) < 0.12
        assert row.like == 1 or row.jaccard < 1
    assert abs(sum(errors) / len(errors)) < 0.015
    odd = spark.createDataFrame([("", ""), ("", "0" * 256), ("0" * 256, "")], "x string, y string")
    assert [r[0] for r in odd.select(m.likeness(F.col("x"), F.col("y"))).collect()] == [1.0, 0.0, 0.0]


def test_main_path_runs_no_python(docs):
    plan = m.neighbours(docs("a b", "c d"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)

import itertools
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from stayline.llm import line_crf
from stayline.llm.line_crf import Field, default_field, judge, measure, repeated_words, viterbi
from tests.llm.conftest import ODD


@given(st.lists(st.floats(-4, 4), max_size=9), st.floats(0, 2))
@settings(max_examples=100, deadline=None)
def test_viterbi_finds_the_best_sequence(scores, stay):
    def value(path):
        return sum(s for s, on in zip(scores, path) if on) + stay * sum(a == b for a, b in zip(path, path[1:]))

    best = max((value(path) for path in itertools.product([True, False], repeat=len(scores))), default=0)
    got = viterbi(scores, stay)
    assert len(got) == len(scores) and abs(value(got) - best) < 1e-9


@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40))
@settings(max_examples=150, deadline=None)
def test_words_in_repeated_windows(words):
    counts, hit = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7)), set()
    for i in range(len(words) - 7):
        if counts[tuple(words[i : i + 8])] > 1:
            hit |= set(range(i, i + 8))
    assert repeated_words(words) == len(hit)


def test_marginals_are_those_of_all_sequences():
    scores, stay = np.array([[0.3, -1.0, 2.0, 0.0]]), 0.7
    mask = np.array([[1.0, 1.0, 1.0, 0.0]])
    weights = {}
    for path in itertools.product([0, 1], repeat=3):
        total = sum(s for s, on in zip(scores[0], path) if on) + stay * sum(a == b for a, b in zip(path, path[1:]))
        weights[path] = np.exp(total)
    whole = sum(weights.values())
    marginal, equal = line_crf._marginals(scores, stay, mask)
    for at in range(3):
        assert abs(marginal[0, at] - sum(w for p, w in weights.items() if p[at]) / whole) < 1e-9
    for at in range(2):
        assert abs(equal[0, at] - sum(w for p, w in weights.items() if p[at] == p[at + 1]) / whole) < 1e-9


def test_base_figures(spark, docs):
    text = "One two, #three\nOne two, #three\n\n é 5%\none"
    n_words, chars, symbols, lines, repeat, failed, kept, *_ = measure(text.encode(), default_field())
    assert (n_words, chars, symbols, lines, repeat, failed, kept) == (9, 32, 3, 1, 0, True, False)
    rows = judge(docs(*ODD), default_field()).select("doc_id", "quality.*").collect()
    assert len(rows) == len(ODD)
    for row in rows:
        words = (ODD[row.doc_id] or "").encode().split()
        assert row.n_words == len(words) and row.word_chars == sum(len(w.decode()) for w in words)
        assert row.base_failed == (len(words) < 20 or 100 * row.n_repeat_words > 30 * len(words))
        assert not (row.base_failed and row.kept)


def good(pick):
    return "\n".join(
        "The " + " ".join(pick.choice(["house", "river", "green", "walks", "over", "slowly", "it"]) for _ in range(9)) + "."
        for _ in range(6)
    )


def bad(pick):
    return "\n".join(" ".join(pick.choice(["BUY!!", "$$$", "now***", "%%%a", "|"]) for _ in range(9)) for _ in range(6))


def test_fitted_field_tells_prose_from_junk(spark, docs):
    pick = random.Random(4)
    texts = [good(pick) if n % 3 else bad(pick) for n in range(90)]
    labels = spark.createDataFrame([(n, 1 if n % 3 else 0) for n in range(60)] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    field = line_crf.fit(docs(*texts), labels)
    verdicts = {r.doc_id: r.kept for r in judge(docs(*texts), field).select("doc_id", "quality.kept").collect()}
    assert [verdicts[n] for n in range(60, 90)] == [bool(n % 3) for n in range(60, 90)]
    mixed = good(pick) + "\n" + bad(pick)
    marked = measure(mixed.encode(), field)[-1]
    assert set(range(6, 12)) >= set(marked) and len(marked) >= 5


def test_repeated_ids_count_once_in_the_fit(spark, docs):
    pick = random.Random(6)
    rows = [(n, good(pick) if n % 3 else bad(pick)) for n in range(40)]
    labels = spark.createDataFrame([(n, 1 if n % 3 else 0) for n in range(40)], "doc_id bigint, quality int")
    once, often = (line_crf.fit(docs(*own), labels) for own in (rows, rows + rows[1:2] * 500))
    assert np.allclose(once.weights, often.weights)
    frame = docs(*rows).withColumnRenamed("lang", "quality").withColumnRenamed("source", "rows")
    assert judge(frame, once).columns == frame.columns


def test_without_labels_the_prior_decides(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    field = line_crf.fit(docs("a"), none)
    assert isinstance(field, Field) and np.array_equal(field.weights, default_field().weights)
    assert judge(docs("a").where("false"), field).count() == 0

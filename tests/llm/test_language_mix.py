import random

import numpy as np

from stayline.llm import language_mix
from stayline.llm.language_mix import fit, identify, is_held_out, keep_identified, mixtures
from tests.llm.conftest import ODD

SYLLABLES = {"aa": ["ka", "to", "mi"], "bb": ["schu", "ber", "ung"], "cc": ["éla", "oui", "ré"]}


def text(lang, pick, size=40):
    return " ".join("".join(pick.choice(SYLLABLES[lang]) for _ in range(3)) for _ in range(size))


def corpus(pick, count=120):
    return [(n, text(lang, pick), lang) for n, lang in ((n, "aa bb cc".split()[n % 3]) for n in range(count))]


def test_held_out_languages_are_found(docs):
    frame = docs(*corpus(random.Random(1)))
    model = fit(frame.where(~is_held_out()))
    assert model.langs == ["aa", "bb", "cc"]
    rows = identify(frame, model).select("doc_id", "lang", "language", is_held_out().alias("held")).collect()
    held = [r for r in rows if r.held]
    assert len(held) > 10 and all(r.language.lang == r.lang and r.language.score > 0.95 for r in held)


def test_proportions_of_a_mixture(docs):
    pick = random.Random(2)
    model = fit(docs(*corpus(pick)))
    mixed = text("aa", pick, 150) + ". " + text("bb", pick, 50)
    shares = mixtures([mixed, text("cc", pick), ""], model)
    # words of the second language are longer, as bytes are counted
    sizes = [len(t) for t in (text("aa", pick, 150), text("bb", pick, 50))]
    assert abs(shares[0][0] - sizes[0] / sum(sizes)) < 0.08 and shares[0][2] == 0
    assert shares[1][2] > 0.99 and shares[2] is None
    assert abs(shares[0].sum() - 1) < 1e-5


def test_odd_texts_and_empty_models(docs):
    frame = docs(*ODD)
    model = fit(docs(*corpus(random.Random(3))))
    rows = {r.doc_id: r.language for r in identify(frame, model).collect()}
    assert len(rows) == len(ODD)
    for n, value in enumerate(ODD):
        unknown = value is None or not any(c.isalpha() for c in value)
        assert (rows[n].lang == "und") == unknown and 0 <= rows[n].score <= 1
    nothing = fit(frame)
    assert nothing.langs == [] and {r.language.lang for r in identify(frame, nothing).collect()} == {"und"}
    assert identify(frame.where("false"), model).count() == 0


def test_rejected_documents_go(docs):
    pick = random.Random(5)
    frame = docs(*corpus(pick), (900, "12 34 ..."), (901, None), (902, text("bb", pick))).withColumnRenamed("source", "_language")
    kept = keep_identified(frame)
    assert kept.columns == frame.columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids == set(range(120)) | {902}


def test_trigrams_are_letters_only():
    assert len(language_mix.trigrams("12 . ,")) == 0
    assert np.array_equal(language_mix.trigrams("AB"), language_mix.trigrams(" ab,"))


def test_a_text_may_hold_all_languages():
    letters = "abcdefg"
    counts = np.full((language_mix.BUCKETS, len(letters)), language_mix.SMOOTHING)
    for at, letter in enumerate(letters):
        np.add.at(counts, (language_mix.trigrams((letter * 4 + " ") * 500), at), 1)
    probability = counts / counts.sum(axis=0)
    top = probability.max(axis=1)
    model = language_mix.Model(list(letters), (probability / top[:, None]).astype(np.float32), np.log(top))
    own, few = language_mix.mixtures([" ".join(letter * 4 for letter in letters * 60), "aaaa bbbb " * 200], model)
    assert abs(own - 1 / len(letters)).max() < 0.01
    assert (few > 0.01).tolist() == [True, True] + [False] * 5

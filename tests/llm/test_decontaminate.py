import random

from stayline.llm import decontaminate
from stayline.llm.decontaminate import WindowIndex, drop_contaminated, merged, occurrences, words_of
from tests.llm.conftest import ODD


def plain(text, items, width=13):
    words, hit, found = words_of((text or "").encode()), set(), set()
    for item_id, item in items:
        own = words_of((item or "").encode())
        windows = [own[i : i + width] for i in range(max(1, len(own) - width + 1))] if own else []
        for window in windows:
            for at in range(len(words) - len(window) + 1):
                if words[at : at + len(window)] == window:
                    hit |= set(range(at, at + len(window)))
                    found.add(str(item_id))
    return len(words), len(hit), sorted(found)


def corpus():
    pick = random.Random(2)
    vocabulary = ["the", "of", "a", *[f"word{n}" for n in range(60)]]

    def text(size):
        return " ".join(pick.choice(vocabulary) for _ in range(size))

    items = [(n, text(pick.choice([1, 2, 5, 13, 14, 30]))) for n in range(25)] + [(90, None), (91, ""), (92, "!!"), (3, text(20))]
    items.append((93, "same same same same same same same same same same same same same same"))
    texts = [text(200) for _ in range(30)]
    for n in range(25):
        own = (items[n][1] or "").split()
        texts.append(text(20) + ", " + " ".join(own[: pick.randrange(1, len(own) + 1)]).upper() + ". " + text(30))
        texts.append(text(5) + "-" + (items[n][1] or "") + "-" + (items[n][1] or ""))
    return [*texts, "same " * 20, *ODD], items


def found_in(frame):
    rows = frame.select("doc_id", "n_words", decontaminate.hit_words().alias("n"), "items").collect()
    return {r.doc_id: (r.n_words, r.n, list(r["items"])) for r in rows}


def test_agrees_with_comparing_every_place(spark, docs):
    texts, items = corpus()
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    wanted = {n: plain(text, items) for n, text in enumerate(texts)}
    assert found_in(occurrences(docs(*texts), benchmark)) == wanted
    # in blocks of a few items, with the same result
    assert found_in(occurrences(docs(*texts), benchmark, block_bytes=300)) == wanted


def test_rarest_word_leads(spark):
    index = WindowIndex([("1", b"the the rare of a the")], {b"the": 50, b"of": 20, b"a": 30, b"rare": 1})
    assert set(index.prefixes) == {b"rare"}
    assert index.find(words_of(b"x the the rare of a the y")) == ([(1, 7)], {"1"})
    assert index.find(words_of(b"rare of a the")) == ([], set())


def test_nothing_to_compare_with(spark, docs):
    benchmark = spark.createDataFrame([(None, "a b c")], "item_id bigint, text string")
    frame = docs("a b c", None)
    for empty in (benchmark, benchmark.where("false")):
        assert found_in(occurrences(frame, empty)) == {0: (3, 0, []), 1: (0, 0, [])}
    assert occurrences(frame.where("false"), benchmark).count() == 0


def test_clean_documents_stay_as_they_are(spark, docs):
    item = " ".join(f"q{n}" for n in range(20))
    benchmark = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    far = " ".join(["clean"] * 700)
    frame = docs(item, "clean words only", far + " " + item, None, (9, item), (9, "other"))
    frame = frame.withColumnRenamed("lang", "spans").withColumnRenamed("source", "n_words")
    kept = drop_contaminated(frame, benchmark)
    assert kept.columns == frame.columns
    # 20 of 720 words are less than a twentieth
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text != None) == [  # noqa: E711
        (1, "clean words only"), (2, far + " " + item), (9, "other")
    ]
    assert kept.where("text IS NULL").count() == 1


def test_spans_join():
    assert merged([(5, 8), (1, 3), (3, 4), (6, 7)]) == [(1, 4), (5, 8)]

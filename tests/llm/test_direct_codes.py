import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from stayline.llm import direct_codes
from stayline.llm.direct_codes import Codes
from stayline.llm.tokens import Encoder, default_tokenizer, gathered
from stayline.sources.store import work_path
from tests.llm.conftest import ODD
from tests.llm.test_packing import whole


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500), st.data())
@settings(max_examples=60, deadline=None)
def test_every_id_and_every_slice(ids, data):
    codes = Codes.of(np.array(ids, dtype=np.uint32))
    assert codes.slice(0, len(ids)).tolist() == ids
    for _ in range(5):
        a = data.draw(st.integers(0, len(ids)))
        b = data.draw(st.integers(a, len(ids)))
        assert codes.slice(a, b).tolist() == ids[a:b]
        if a < len(ids):
            assert codes.get(a) == ids[a]


def test_long_sequences_use_the_directory():
    ids = np.random.default_rng(1).integers(0, 50_000, 20_000).astype(np.uint32)
    codes = Codes.of(ids)
    assert [codes.get(at) for at in range(0, 20_000, 371)] == ids[::371].tolist()


def test_corpus_round_trip(spark, docs, monkeypatch):
    monkeypatch.setattr(direct_codes, "SEGMENT_IDS", 50)
    rows = [(100 - n, text) for n, text in enumerate([*ODD, *[f"text number {n} of some" for n in range(60)]])]
    path = work_path(spark, "codes")
    direct_codes.write(docs(*rows), path)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in direct_codes.read_documents(spark, path).collect()}
    at, stream = 0, []
    for (doc_id, _), found in zip(sorted(rows), whole([text for _, text in sorted(rows)])):
        ids = np.array([*found, 2], dtype="<u4")
        assert got[doc_id] == (at, len(ids), zlib.crc32(ids.tobytes()))
        stream += ids.tolist()
        at += len(ids)
    assert direct_codes.read_ids(spark, path, 37, 900).tolist() == stream[37:900]
    assert direct_codes.read_ids(spark, path, at, at + 5).tolist() == []


def test_repeated_null_and_no_documents(spark, docs):
    path, empty = work_path(spark, "codes"), work_path(spark, "codes")
    frame = docs((3, "b"), (3, "b"), (None, "first"), (None, None), (1, "a"))
    direct_codes.write(frame, path)
    rows = sorted(direct_codes.read_documents(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, None, 1, 3, 3]
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]
    direct_codes.write(frame.where("false"), empty)
    assert direct_codes.read_documents(spark, empty).count() == 0


def test_levels_that_no_id_reaches_are_not_read():
    codes = Codes.of(np.array([3, 700, 255, 0, 65535], dtype=np.uint32))
    codes.chunks[2] = None
    assert codes.slice(0, 5).tolist() == [3, 700, 255, 0, 65535]
    codes.chunks[1] = codes.ranks = None
    assert codes.slice(2, 4).tolist() == [255, 0]


def test_batches_are_encoded_together():
    batches = [pa.record_batch({"doc_id": [n], "text": [text]}) for n, text in enumerate(["12345", None, "1234567", "é", ""])]
    assert list(gathered(iter(batches), 10)) == [([0, 1, 2], ["12345", "", "1234567"]), ([3, 4], ["é", ""])]
    assert list(gathered(iter([]), 10)) == []


def test_white_space_inside_words_beside_empty_ones():
    for texts in (["a\tb"], ["\nx\ty"], ["a\u2003b ", "c", "\n"], ["p\x1cq\n\tr", " ", "s"]):
        got = Encoder(default_tokenizer()).encode(texts)
        assert [ids.tolist() for ids in got] == [list(ids) for ids in whole(texts)]

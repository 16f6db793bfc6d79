"""Token ids of a public byte-level BPE vocabulary, read from its file; nothing is trained or copied here."""

from __future__ import annotations

import functools
import itertools
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units whose ids a worker remembers before it drops those that it has met in one call only; some 250 MB.
CACHE_UNITS = 1_200_000
#: Units per call of the tokenizer.
_RUN = 500
#: Code points that are looked up at once, so that words which repeat among them are looked up once.
_CHUNK = 4_000_000


@functools.cache
def _two_blanks() -> str:
    """Pattern of two white space characters of any kind side by side."""
    every = "".join(map(chr, range(sys.maxunicode + 1)))
    blanks = "".join(f"\\x{{{ord(sign):x}}}" for sign in re.findall(r"\s", every))
    return f"[{blanks}][{blanks}]"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Numbers(dict):
    """Numbers units as they are first asked for, and lists those that are new."""

    def __init__(self, units: list[str] = ()):
        super().__init__(zip(units, range(len(units)), strict=True))
        self.fresh: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        self.fresh.append(unit)
        return number


def _spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of all elements of runs, one run after another."""
    stops = np.cumsum(sizes)
    return np.repeat(begins - stops + sizes, sizes) + np.arange(stops[-1] if len(stops) else 0)


def _grown(values: np.ndarray, size: int) -> np.ndarray:
    return values if size <= len(values) else np.concatenate((values, np.zeros(max(size, len(values)), values.dtype)))


class Encoder:
    """Ids by the `tokenizers` library, with the ids of single words remembered.

    A byte-level vocabulary splits text into pieces before it merges bytes. A single blank between visible characters
    belongs to the piece behind it, a single line end is a piece by itself, and no piece reaches across either. So the ids
    of a text without neighbouring white space are those of its words in a row, each with the blank before it, and words
    repeat where texts do not. New words go to the tokenizer many at a time, as lines of one text. Other texts go there
    whole, and so do those that hold the name of an added token, which the library cuts out before all else.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._added = [token.content for token in self._tokenizer.get_added_tokens_decoder().values()]
        (self._line_end,) = self._whole(["\n"])[0]
        # a unit is a word behind a blank; a word at the start of a line is kept with a blank in front of its name
        self._numbers = _Numbers()
        self._begins, self._sizes = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self._again = np.zeros(1 << 14, bool)
        self._values, self._filled = np.zeros(1 << 16, np.uint32), 0

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, dtype=np.uint32) for one in found]

    def _forget(self) -> None:
        """Go on with the units met more than once, or with none where that are too many."""
        kept = np.flatnonzero(self._again[: len(self._numbers)])
        kept = kept if 2 * len(kept) <= CACHE_UNITS else kept[:0]
        units, sizes = list(self._numbers), self._sizes[kept]
        values = self._values[_spread(self._begins[kept], sizes)]
        self._numbers = _Numbers([units[number] for number in kept.tolist()])
        self._begins[: len(kept)], self._sizes[: len(kept)] = np.cumsum(sizes) - sizes, sizes
        self._again[:] = False
        self._values[: len(values)], self._filled = values, len(values)

    def _add(self, numbers: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> None:
        self._values = _grown(self._values, self._filled + len(values))
        self._values[self._filled : self._filled + len(values)] = values
        self._begins[numbers], self._sizes[numbers] = self._filled + np.cumsum(sizes) - sizes, sizes
        self._filled += len(values)

    def _learn(self) -> None:
        """Ask the tokenizer for the units that were numbered since it was asked last."""
        fresh = [unit[1:] if unit[:1] == " " else " " + unit for unit in self._numbers.fresh]
        if not fresh:
            return
        self._numbers.fresh = []
        total = len(self._numbers)
        first = total - len(fresh)
        self._begins, self._sizes, self._again = (_grown(one, total) for one in (self._begins, self._sizes, self._again))
        # a word has no blank or line end inside; other white space at its ends might run on into the line end
        odd = []
        for at in range(0, len(fresh), _RUN):
            run, units = np.arange(at, min(at + _RUN, len(fresh))), fresh[at : at + _RUN]
            lines = "\n".join(units)
            if "\n".join(lines.split()) != lines.replace("\n ", "\n").removeprefix(" "):  # an empty word or other white space
                plain = np.array([bool(word := text.removeprefix(" ")) and word == word.strip() for text in units])
                odd += run[~plain].tolist()
                run = run[plain]
                lines = "\n".join([fresh[i] for i in run.tolist()])
            if not len(run):
                continue
            (ids,) = self._whole([lines])
            ends = ids == self._line_end
            cuts = np.concatenate(([-1], np.flatnonzero(ends), [len(ids)]))
            self._add(first + run, np.diff(cuts) - 1, ids[~ends])
        if odd:
            found = self._whole([fresh[at] for at in odd])
            self._add(first + np.array(odd), np.array([len(ids) for ids in found]), np.concatenate(found))

    def encode(self, texts: list[str], size: int = _CHUNK) -> list[np.ndarray]:
        """Ids of each text, as the library gives them without special tokens at its ends; some `size` code points at once."""
        return [ids for chunk in _chunks(texts, size) for ids in self._encode(chunk)]

    def _numbered(self, words: pa.Array, mark: str) -> np.ndarray:
        """Numbers of the units of some words, each different word asked for once."""
        coded = words.dictionary_encode()
        units = coded.dictionary.to_pylist()
        if mark:
            units = [mark + word for word in units]
        found = np.fromiter(map(self._numbers.__getitem__, units), np.int64, len(units))
        return found[coded.indices.to_numpy()]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self._numbers) > CACHE_UNITS:
            self._forget()
        known, end = len(self._numbers), self._numbers[" \n"]
        column = pa.array(texts, pa.string())
        odd = pc.match_substring_regex(column, _two_blanks())
        for name in self._added:
            odd = pc.or_(odd, pc.match_substring(column, name))
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        lines = pc.split_pattern(pc.if_else(odd, "", column), "\n")
        words = pc.split_pattern(lines.flatten(), " ")
        starts = words.offsets.to_numpy()[:-1] - words.offsets[0].as_py()
        flat_words = words.flatten()
        # a line's first word has no blank before it; behind each line but a text's last one there is a line end
        first = np.zeros(len(flat_words), bool)
        first[starts] = True
        line_counts = pc.list_value_length(lines).to_numpy()
        ends_before = np.arange(len(starts)) - np.repeat(np.arange(len(texts)), line_counts)
        sizes_of_lines = np.diff(np.append(starts, len(flat_words)))
        places = np.arange(len(flat_words)) + np.repeat(ends_before, sizes_of_lines)
        flat = np.full(len(flat_words) + len(starts) - len(texts), end, np.int64)
        flat[places[first]] = self._numbered(flat_words.filter(pa.array(first)), " ")
        flat[places[~first]] = self._numbered(flat_words.filter(pa.array(~first)), "")
        self._learn()
        self._again[flat[flat < known]] = True
        sizes = self._sizes[flat]
        ids = self._values[_spread(self._begins[flat], sizes)]
        # units of a text: its words and the line ends between them
        last_lines = np.cumsum(line_counts)
        units = np.append(starts, len(flat_words))[last_lines] + last_lines - np.arange(1, len(texts) + 1)
        borders = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], units))]
        out = [ids[a:b] for a, b in itertools.pairwise(borders.tolist())]
        for at, own in zip(whole.tolist(), self._whole([texts[at] for at in whole]) if len(whole) else (), strict=True):
            out[at] = own
        return out


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list[str]]]:
    """Names and texts (null: empty) of as many (name, text) batches at once as hold some `size` code points."""
    names, texts, held = [], [], 0
    for batch in batches:
        own = [text or "" for text in batch.column(1).to_pylist()]
        names += batch.column(0).to_pylist()
        texts += own
        held += sum(map(len, own))
        if held >= size:
            yield names, texts
            names, texts, held = [], [], 0
    if texts:
        yield names, texts


def _chunks(texts: list[str], size: int) -> Iterator[list[str]]:
    run, held = [], 0
    for text in texts:
        run.append(text)
        held += len(text)
        if held > size:
            yield run
            run, held = [], 0
    if run:
        yield run


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    return Encoder(path)

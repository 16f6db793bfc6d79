"""Quality by line: a linear-chain conditional random field marks each line as content or boilerplate, and the share of
words in content lines decides whether the document stays.

Lines get a few numbers each (length, letters, signs, repetition). The field's weights come from documents with a quality
label: their lines carry the document's label, and the chain and the many documents even out that not every line of a bad
document is bad. Decoding is Viterbi over the whole document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    LongType,
    StructField,
    StructType,
)

from stayline.llm.tables import as_bytes, read

WINDOW_WORDS = 8
MIN_WORDS = 20
#: More than this percentage of words in repeated windows fails a document.
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
MIN_CONTENT = 0.5

#: Labelled documents the field is fitted on at most, and lines of each that are looked at.
SAMPLE_DOCS = 2_000
SAMPLE_LINES = 60
FIT_ROUNDS = 120
_RATE = 0.15
_PULL = 0.02

FEATURES = (
    "bias", "words", "letters", "digits", "symbols", "signs", "capitals", "sentence_end", "variety", "repeated",
    "word_length", "short", "repeated_word",
)
#: Weights for content that the fit starts from and is pulled to; all there is where no document is labelled.
PRIOR = dict(
    bias=0.5, words=0.2, letters=1.0, digits=-0.5, symbols=-4.0, signs=-1.0, capitals=-2.0, sentence_end=0.5, variety=0.5,
    repeated=-1.5, word_length=0.0, short=-0.2, repeated_word=-2.0,
)
#: Score of staying in the same kind of line.
STAY = 0.6

_DIGITS = b"0123456789"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_CONTINUATION = bytes(range(128, 192))
_END = (b".", b"!", b"?", b":", b'"', "…".encode(), "。".encode())


@dataclass
class Field:
    """Weights of the features for content (boilerplate has none) and the score of keeping the state."""

    weights: np.ndarray
    stay: float


def default_field() -> Field:
    return Field(np.array([PRIOR[name] for name in FEATURES]), STAY)


def features(line: bytes, words: list[bytes], seen_before: bool) -> list[float]:
    size = sum(map(len, words))
    letters = size - len(b"".join(words).translate(None, _LETTERS))
    joined = line
    digits = len(joined) - len(joined.translate(None, _DIGITS))
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    capitals = len(joined) - len(joined.translate(None, _UPPER))
    last = words[-1]
    count = len(words)
    same = sum(map(bytes.__eq__, words, words[1:]))
    return [
        1.0,
        math.log1p(count) / 3,
        letters / size,
        digits / size,
        symbols / size * 3,
        (size - letters - digits) / size,
        capitals / max(1, letters),
        1.0 if last.endswith(_END) else 0.0,
        len(set(words)) / count,
        1.0 if seen_before else 0.0,
        min(size / count, 20) / 10,
        1.0 if count < 5 else 0.0,
        same / count * 3,
    ]


def repeated_words(words: list[bytes], width: int = WINDOW_WORDS) -> int:
    """Number of words inside windows of `width` words that occur twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.array([ids.setdefault(word, len(ids)) for word in words], dtype=np.uint64)
    # equal windows have equal codes, so no equal code means no repeated window
    mixed = (codes + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    window = np.zeros(n, dtype=np.uint64)
    for at in range(width):
        window = window * np.uint64(0x94D049BB133111EB) + mixed[at : at + n]
    ordered = np.sort(window)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    # exact: windows by the rank of their halves, from single words up
    ranks, length = codes.astype(np.int64), 1
    while length < width:
        step = min(length, width - length)
        ranks = ranks[:-step] * (int(ranks.max()) + 1) + ranks[step:]
        length += step
        _, ranks, counts = np.unique(ranks, return_inverse=True, return_counts=True)
    twice = counts[ranks] > 1
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def viterbi(scores: list[float], stay: float) -> list[bool]:
    """Best sequence of states for scores of content against boilerplate; ties go to content."""
    content, other, back = 0.0, 0.0, []
    for at, score in enumerate(scores):
        if at:
            from_content, from_other = content + stay >= other, other + stay > content
            back.append((from_content, from_other))
            content, other = max(content + stay, other), max(other + stay, content)
        content += score
    state, path = content >= other, []
    for from_content, from_other in reversed(back):
        path.append(state)
        state = from_content if state else not from_other
    path.append(state)
    return path[::-1] if scores else []


def measure(text: bytes, field: Field) -> tuple:
    """All figures of a document, and the numbers of its boilerplate lines."""
    words = text.split()
    glued = b"".join(words)
    word_chars = len(glued.translate(None, _CONTINUATION))
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    n_repeat = repeated_words(words)
    base_failed = len(words) < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * len(words)
    seen, duplicates, numbers, counts, rows = set(), 0, [], [], []
    for number, line in enumerate(text.split(b"\n")):
        own = line.split()
        if own:
            known = line in seen
            duplicates += known
            seen.add(line)
            numbers.append(number)
            counts.append(len(own))
            rows.append(features(line, own, known))
    states = viterbi((np.array(rows) @ field.weights).tolist(), field.stay) if rows else []
    content = sum(count for count, state in zip(counts, states, strict=True) if state)
    share = content / len(words) if words else 0.0
    marked = [number for number, state in zip(numbers, states, strict=True) if not state]
    kept = not base_failed and share >= MIN_CONTENT
    return len(words), word_chars, n_symbols, duplicates, n_repeat, base_failed, kept, share, marked


def training_rows(text: bytes) -> list[list[float]]:
    seen, rows = set(), []
    for line in text.split(b"\n"):
        if own := line.split():
            rows.append(features(line, own, line in seen))
            seen.add(line)
            if len(rows) == SAMPLE_LINES:
                break
    return rows


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> Field:
    """Fit on at most `sample` labelled documents, those with the smallest hash of their id, so the choice does not depend
    on the order of rows. Of rows that repeat an id, the text with the smallest hash counts, and of labels the smaller one.
    Without any label the prior weights are returned."""
    chosen = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    @F.pandas_udf(ArrayType(ArrayType(DoubleType())))
    def of_lines(texts: pd.Series) -> pd.Series:
        return pd.Series([training_rows(text) for text in texts])

    # `sample` rows at most, so it may be broadcast; as many come back, and each holds a bounded number of lines
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id", "quality").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    found = texts.select("doc_id", "quality", of_lines(as_bytes()).alias("rows"))
    sequences = [(row["quality"], row["rows"]) for row in sorted(found.collect(), key=lambda row: row["doc_id"]) if row["rows"]]
    return _fit(sequences)


def _fit(sequences: list[tuple[int, list[list[float]]]]) -> Field:
    """Gradient ascent on the conditional likelihood of the labels, all documents at once."""
    start = default_field()
    if len({quality for quality, _ in sequences}) < 2:
        return start
    length = max(len(rows) for _, rows in sequences)
    x = np.zeros((len(sequences), length, len(FEATURES)))
    mask = np.zeros((len(sequences), length))
    for at, (_, rows) in enumerate(sequences):
        x[at, : len(rows)] = rows
        mask[at, : len(rows)] = 1
    y = np.array([1.0 if quality else 0.0 for quality, _ in sequences])
    # both kinds of documents weigh the same, as bad ones are rare
    weight = np.where(y > 0, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, (1 - y).sum()))
    theta = np.append(start.weights, start.stay)
    prior = theta.copy()
    speed, size = np.zeros_like(theta), np.zeros_like(theta)
    pairs = mask[:, 1:] * mask[:, :-1]
    for step in range(1, FIT_ROUNDS + 1):
        marginal, together = _marginals(x @ theta[:-1], theta[-1], mask)
        by_line = (y[:, None] - marginal) * mask / np.maximum(1, mask.sum(axis=1))[:, None]
        slope = np.append(
            np.einsum("d,dl,dlf->f", weight, by_line, x),
            (weight * ((1 - together) * pairs).sum(axis=1) / np.maximum(1, pairs.sum(axis=1))).sum(),
        )
        slope -= _PULL * (theta - prior)
        speed = 0.9 * speed + 0.1 * slope
        size = 0.99 * size + 0.01 * slope**2
        theta = theta + _RATE * (speed / (1 - 0.9**step)) / (np.sqrt(size / (1 - 0.99**step)) + 1e-8)
    # a chain that never changes state would judge a document by one sum
    return Field(theta[:-1], float(min(theta[-1], 2.0)))


def _marginals(scores: np.ndarray, stay: float, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of content for each line, and of equal states for each pair of neighbours (forward-backward)."""
    docs, length = scores.shape
    scores = scores * mask
    forward, backward = np.zeros((docs, length, 2)), np.zeros((docs, length, 2))
    emit = np.stack([np.zeros_like(scores), scores], axis=2)
    move = np.array([[stay, 0.0], [0.0, stay]])
    forward[:, 0] = emit[:, 0]
    for at in range(1, length):
        step = move * mask[:, at, None, None]
        forward[:, at] = np.logaddexp.reduce(forward[:, at - 1, :, None] + step, axis=1) + emit[:, at]
    for at in range(length - 2, -1, -1):
        step = move * mask[:, at + 1, None, None]
        backward[:, at] = np.logaddexp.reduce(step + (emit[:, at + 1] + backward[:, at + 1])[:, None, :], axis=2)
    whole = np.logaddexp.reduce(forward[:, -1], axis=1)[:, None]
    marginal = np.exp(forward[:, :, 1] + backward[:, :, 1] - whole)
    equal = np.zeros((docs, max(0, length - 1)))
    for state in (0, 1):
        equal += np.exp(
            forward[:, :-1, state] + stay + emit[:, 1:, state] + backward[:, 1:, state] - whole
        )
    return marginal, equal


_FIGURES = StructType(
    [StructField(name, LongType()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [StructField(name, BooleanType()) for name in ("base_failed", "kept")]
    + [StructField("content_share", DoubleType()), StructField("boilerplate_lines", ArrayType(LongType()))]
)


def judge(docs: DataFrame, field: Field, name: str = "quality") -> DataFrame:
    """Add the struct `name`: figures of the whole text, whether it fails the base rules, whether it is kept, the share
    of words in content lines and the numbers of boilerplate lines.

    Null and empty texts have no words and fail. Lines without a word are neither content nor boilerplate. Repeated rows
    each get their figures. A column that is already called `name` is replaced, all others stay as they are.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf(_FIGURES)
    def figures(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [part.name for part in _FIGURES]
        for texts in batches:
            yield pd.DataFrame([measure(text, sent.value) for text in texts], columns=names)

    return docs.withColumn(name, figures(as_bytes()))


def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and the field's verdict for every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    field = fit(docs, read(spark, sf_dir, "labels"))
    return judge(docs, field).select("doc_id", "quality.*")

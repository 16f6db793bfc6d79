"""Language identification by mixture inference.

Every language is a distribution over letter trigrams (of UTF-8 bytes, hashed into a fixed number of buckets). A document
is a mixture of languages: expectation maximisation estimates the proportions from its trigrams' likelihoods, then sets of
its leading languages are compared by likelihood less a penalty per language, and the largest share of the best set is
the answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from stayline.llm.tables import read, unused

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
#: Added to every count of a trigram bucket.
SMOOTHING = 0.5
EM_ROUNDS = 6
SET_ROUNDS = 3
#: Overlapping trigrams see every letter three times.
OVERLAP = 3.0
UNKNOWN = "und"
#: The pipeline rejects documents whose leading language holds less than this.
MIN_SHARE = 0.5
_CHUNK_BYTES = 200_000

# letters stay, everything else becomes a blank; bytes above ASCII are parts of letters
_TABLE = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

MIXTURE = StructType(
    [
        StructField("lang", StringType()),
        StructField("score", DoubleType()),
        StructField(
            "mixture", ArrayType(StructType([StructField("lang", StringType()), StructField("share", DoubleType())]))
        ),
    ]
)


def trigrams(text: str) -> np.ndarray:
    """Bucket of every trigram whose middle is part of a letter."""
    codes = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace").translate(_TABLE), dtype=np.uint8)
    wide = codes.astype(np.uint32)
    grams = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    hashed = (grams * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)
    return hashed[codes[1:-1] != 32].astype(np.int64)


@dataclass
class Model:
    langs: list[str]
    #: probability of each bucket in each language, over the largest one of the bucket
    ratio: np.ndarray
    #: logarithm of that largest one
    top: np.ndarray


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose language nobody learns from; a null id counts as empty text and is learned from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(docs: DataFrame) -> Model:
    """Trigram counts of all rows with a language and a text. The model is languages times buckets, whatever the data."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = totals.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                own += np.bincount(trigrams(text), minlength=BUCKETS)
        for lang, own in totals.items():
            at = np.flatnonzero(own)
            columns = [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(own[at])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])

    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    counted = labelled.mapInArrow(count, "lang string, bucket bigint, n bigint")
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(rows["lang"].unique())
    counts = np.full((BUCKETS, max(1, len(langs))), SMOOTHING)
    if langs:
        counts[rows["bucket"].to_numpy(), pd.Categorical(rows["lang"], categories=langs).codes] += rows["n"].to_numpy()
    probability = counts / counts.sum(axis=0)
    top = probability.max(axis=1)
    return Model(langs, (probability / top[:, None]).astype(np.float32), np.log(top))


def _shares(weight, ratio, start, docs_at, total, share, rounds):
    """Rounds of expectation maximisation for several documents at once; `share` holds zero for languages left out."""
    for _ in range(rounds):
        joint = ratio * share[docs_at]
        joint *= (weight / np.maximum(joint.sum(axis=1), 1e-30))[:, None]
        share = np.add.reduceat(joint, start, axis=0) / total[:, None]
    return share


def _likelihood(weight, ratio, start, docs_at, share):
    seen = np.log(np.maximum((ratio * share[docs_at]).sum(axis=1), 1e-30))
    return np.add.reduceat(weight * seen, start)


def mixtures(texts: list[str], model: Model) -> list[np.ndarray | None]:
    """Proportions of the languages in each text; None where a text has no letter or the model no language."""
    if not model.langs:
        return [None] * len(texts)
    out: list[np.ndarray | None] = [None] * len(texts)
    grams = [trigrams(text) for text in texts]
    held = [at for at, own in enumerate(grams) if len(own)]
    if not held:
        return out
    owner = np.repeat(np.arange(len(held)), [len(grams[at]) for at in held])
    keys, weight = np.unique(owner << BUCKET_BITS | np.concatenate([grams[at] for at in held]), return_counts=True)
    docs_at, ratio = keys >> BUCKET_BITS, model.ratio[keys & (BUCKETS - 1)]
    start = np.searchsorted(docs_at, np.arange(len(held)))
    weight = weight.astype(np.float32)
    total = np.add.reduceat(weight, start)
    count = len(model.langs)
    share = np.full((len(held), count), 1 / count, dtype=np.float32)
    share = _shares(weight, ratio, start, docs_at, total, share, EM_ROUNDS)
    rank = np.argsort(np.argsort(-share, axis=1, kind="stable"), axis=1, kind="stable")
    best, best_value = None, None
    for size in range(1, count + 1):
        tried = np.where(rank < size, np.maximum(share, 1e-6), 0).astype(np.float32)
        tried /= tried.sum(axis=1, keepdims=True)
        if size > 1:
            tried = _shares(weight, ratio, start, docs_at, total, tried, SET_ROUNDS)
        value = _likelihood(weight, ratio, start, docs_at, tried) / OVERLAP - 0.5 * (size - 1) * np.log(total + 1)
        if best is None:
            best, best_value = tried, value
        else:
            better = value > best_value
            best, best_value = np.where(better[:, None], tried, best), np.where(better, value, best_value)
    for at, own in zip(held, best, strict=True):
        out[at] = own
    return out


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    """Texts in runs of bounded size, in order."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size > _CHUNK_BYTES:
            yield run
            run, size = [], 0
    if run:
        yield run


def identify(docs: DataFrame, model: Model, name: str = "language") -> DataFrame:
    """Add the struct `name`: lang, score (its share, 0 to 1) and mixture (languages of the chosen set, largest first).

    Only the text is looked at. Null texts and texts without a letter get `und`, score 0 and no mixture. Ties go to the
    language that sorts first. Repeated rows each get a result. A column that is already called `name` is replaced, all
    others stay as they are.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(MIXTURE)
    def infer(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = sent.value
        for texts in batches:
            rows = []
            for run in _chunks([text or "" for text in texts]):
                for shares in mixtures(run, known):
                    if shares is None:
                        rows.append((UNKNOWN, 0.0, []))
                        continue
                    order = np.argsort(-shares, kind="stable")
                    found = [{"lang": known.langs[i], "share": float(shares[i])} for i in order if shares[i] > 0]
                    rows.append((found[0]["lang"], min(1.0, found[0]["share"]), found))
            yield pd.DataFrame(rows, columns=["lang", "score", "mixture"])

    letters = F.when(F.col("text").rlike(r"\p{L}"), F.col("text"))
    return docs.withColumn(name, infer(letters))


def keep_identified(docs: DataFrame) -> DataFrame:
    """Documents in a known language that holds at least half of them, with their columns as they are.

    Learns from the rows of `docs` that carry a language and are not held out.
    """
    name = unused(docs, "_language")
    found = identify(docs, fit(docs.where(~is_held_out())), name)
    return found.where((F.col(f"{name}.lang") != UNKNOWN) & (F.col(f"{name}.score") >= MIN_SHARE)).drop(name)


def op7_language_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document's whole text."""
    docs = read(spark, sf_dir, "documents")
    model = fit(docs.where(~is_held_out()))
    found = identify(docs.select("doc_id", "text"), model).select("doc_id", "language")
    return found.select(
        "doc_id",
        is_held_out().alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.col("language.mixture").alias("mixture"),
    )

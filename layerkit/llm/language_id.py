"""Language identification by error-correcting output codes.

Each language gets a codeword of bits. One logistic classifier per bit, over
hashed byte n-grams of a text, predicts on which side of that bit the text's
language lies. Decoding adds up, over bits, the loss of each prediction against
each codeword, weighted by how well the bit's classifier does on its own
examples; the language with the least loss wins. If the runner-up is close, the
text is flagged as ambiguous.

Few languages get the exhaustive code, in which each split of the languages is
a bit; many get a code of ``BITS_PER_LANGUAGE_BIT`` random splits for each bit
that naming a language takes.

Classifiers are fitted on a bounded sample: about ``FIT_PER_LANGUAGE`` labelled
texts of each language, ``FIT_ROWS`` in all, as vectors of fixed size.
Whole texts are read, for fitting and for predicting. Nothing but the text is
an input of a prediction, and the model is a matrix of fixed size per language.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so
is every text if there is nothing to learn from. With one language every other
text gets it. A null doc_id is never learned from and not held out. Rows may
repeat. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm.common import mapped, table
from layerkit.sources.scratch import settle

UNDETERMINED = "und"
SLOTS = 4096
FIT_PER_LANGUAGE = 400
FIT_ROWS = 4_000
BITS_PER_LANGUAGE_BIT = 10
EXHAUSTIVE = 6
STEPS = 300
PENALTY = 1e-4
AMBIGUOUS = 0.6
_CHUNK = 1 << 20


def vector(text: str) -> np.ndarray:
    """Counts of hashed byte 1- to 3-grams in lower case, square-rooted, of unit length.

    Long texts are counted piece by piece, so memory stays bounded.
    """
    data = np.frombuffer(text.lower().encode(), np.uint8)
    counts = np.zeros(SLOTS)
    for first in range(0, len(data), _CHUNK):
        part = data[first : first + _CHUNK + 2].astype(np.uint32)
        own = min(_CHUNK, len(data) - first)
        counts += np.bincount(part[:own] * np.uint32(2654435761) >> np.uint32(20), minlength=SLOTS)
        pairs = part[:-1] * np.uint32(257) + part[1:]
        counts += np.bincount(pairs[:own] * np.uint32(2246822519) >> np.uint32(20), minlength=SLOTS)
        triples = pairs[:-1] * np.uint32(263) + part[2:]
        counts += np.bincount(triples[:own] * np.uint32(3266489917) >> np.uint32(20), minlength=SLOTS)
    root = np.sqrt(counts)
    return root / max(1.0, float(np.sqrt(counts.sum())))


def codewords(languages: int) -> np.ndarray:
    """One row of +1 and -1 per language; no column is constant, and none repeats another."""
    if languages < 2:
        return np.ones((languages, 1))
    if languages <= EXHAUSTIVE:
        splits = range(1, 1 << (languages - 1))
        return np.array([[1 if split >> k & 1 else -1 for split in splits] for k in range(languages)], float)
    draw = np.random.default_rng(7)
    wanted = BITS_PER_LANGUAGE_BIT * math.ceil(math.log2(languages))
    columns: dict[bytes, np.ndarray] = {}
    while len(columns) < wanted:
        column = draw.choice([-1.0, 1.0], languages)
        if abs(column.sum()) < languages:
            columns.setdefault((column * column[0]).tobytes(), column)
    return np.stack(list(columns.values()), axis=1)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # slots x bits
    bias: np.ndarray
    trust: np.ndarray  # weight of each bit in decoding

    def losses(self, vectors: np.ndarray) -> np.ndarray:
        """Weighted logistic loss of each language's codeword."""
        margins = vectors @ self.weights + self.bias
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None, :, :])
        return (loss * self.trust).sum(axis=2)

    def predict(self, vectors: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, scores from 0 to 1 and whether the runner-up is close."""
        shares = -self.losses(vectors)
        shares = np.exp(shares - shares.max(axis=1, keepdims=True))
        shares /= shares.sum(axis=1, keepdims=True)
        best = shares.argmax(axis=1)
        score = shares[np.arange(len(best)), best]
        return [self.languages[b] for b in best], score, score < AMBIGUOUS


def fit(vectors: np.ndarray, names: list[str]) -> Model | None:
    """One logistic regression per bit, all by the same accelerated gradient steps."""
    languages = tuple(sorted(set(names)))
    if not languages:
        return None
    code = codewords(len(languages))
    of = np.array([languages.index(n) for n in names])
    signs = code[of]
    # Every language counts the same, however many examples it has.
    share = (1 / np.bincount(of))[of][:, None] / len(languages)
    weights, bias = np.zeros((SLOTS, code.shape[1])), np.zeros(code.shape[1])
    ahead, ahead_bias = weights, bias
    rate = 4.0  # unit vectors: the loss curves by a quarter at most, twice that with the bias
    for step in range(STEPS if len(languages) > 1 else 0):
        pull = signs * share / (1 + np.exp(np.clip(signs * (vectors @ ahead + ahead_bias), -30, 30)))
        moved = ahead + rate * (vectors.T @ pull - PENALTY * ahead)
        moved_bias = ahead_bias + rate / 2 * pull.sum(axis=0)
        push = step / (step + 3)
        ahead, ahead_bias = moved + push * (moved - weights), moved_bias + push * (moved_bias - bias)
        weights, bias = moved, moved_bias
    right = ((signs * (vectors @ weights + bias) > 0) * share).sum(axis=0)
    trust = np.maximum(right - 0.5, 0.0) + 1e-6
    return Model(languages, code, weights, bias, trust * code.shape[1] / trust.sum())


def has_letter() -> Column:
    """Whether the text has a character of the Unicode category L."""
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def held_out() -> Column:
    """The fold that is never learned from: a checksum of the doc_id's text."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [vector(t.as_py()).astype(np.float32).tobytes() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(found, pa.binary())], names=["lang", "vector"])


def train(docs: DataFrame, per_language: int = FIT_PER_LANGUAGE, fit_rows: int = FIT_ROWS) -> Model | None:
    """Model from the labelled rows outside the held-out fold.

    What reaches the driver is about ``per_language`` vectors of 16 KB for each
    label in use, or ``fit_rows`` shared out evenly if there are many labels.
    Rows are drawn by id and text; those that repeat both count once. Rates come
    from the rows that may be learned from, so no label or text of the held-out
    fold has a say.
    """
    usable = docs.select("doc_id", "lang", "text").where(F.col("doc_id").isNotNull() & ~held_out() & F.col("lang").isNotNull() & has_letter())
    counted, languages = settle(usable.groupBy(F.col("lang").alias("__lang")).agg(F.count_distinct(F.xxhash64("doc_id", "text")).alias("__n")))
    if not languages:
        return None
    share = min(float(per_language), fit_rows / languages) / F.col("__n")
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit("language")), F.lit(1_000_000)) / 1_000_000
    picked = usable.join(counted, F.col("lang") == F.col("__lang")).where(draw < share).select("doc_id", "lang", "text").distinct()
    sample = mapped(picked.select("lang", "text"), _vectors, "lang string, vector binary")
    rows = sorted((r["lang"], bytes(r["vector"])) for r in sample.collect())
    vectors = np.frombuffer(b"".join(v for _, v in rows), np.float32).reshape(len(rows), SLOTS).astype(float)
    return fit(vectors, [name for name, _ in rows])


_DDL = "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"


def _predictor(model: Model | None):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, close = [], [], []
            for first in range(0, batch.num_rows, 256):
                texts = [t.as_py() for t in batch.column("text").slice(first, 256)]
                letters = batch.column("letters").slice(first, 256).to_pylist()
                known = [i for i, has in enumerate(letters) if has and model is not None]
                found, score, doubt = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
                if known:
                    best, shares, unsure = model.predict(np.stack([vector(texts[i]) for i in known]))
                    score[known], doubt[known] = shares, unsure
                    for i, name in zip(known, best):
                        found[i] = name
                names += found
                scores += score.tolist()
                close += doubt.tolist()
            same = [batch.column("doc_id"), batch.column("held_out")]
            made = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(close, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*same, *made], names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    return predict


def identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """The predicted language of each row; the model is all that is sent along."""
    return mapped(docs.select("doc_id", held_out().alias("held_out"), has_letter().alias("letters"), "text"), _predictor(model), _DDL)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, by a model that never saw the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return identified(docs, train(docs.select("doc_id", "text", "lang")))

"""Quality classifier: ordinal regression with cumulative links on graded ratings.

One score per text, a weighted sum of hashed text features, is cut by ordered
thresholds: the chance of a grade above ``k`` is the logistic of the score less
threshold ``k``. All grades share the weights. The model gives the expected
grade and the tail probability of the best grade, by which texts are selected.

Ratings are 0 for low quality, 1 for good but toxic, 2 for good. Features are
the presence of hashed words, which are runs of letters in lower case, and a few
shares (capitals, digits, marks, symbols, bars, different words) in steps of an
eighth. All that tell grades apart more than chance would, at a level of
``SIGNIFICANCE`` over everything that was tried, get a weight; their number is
not fixed. Grades weigh by their frequency, so a clean text is rarely taken for a
toxic one.

The model is fitted on a bounded sample of about ``FIT_ROWS`` labelled rows, in
which copies count once; at most ``SLOTS`` features of each reach the driver.
Every row and whole text is scored.

Defined cases: a null text has no features and gets the model's base chance; a
document without words is never kept. Without ratings, nothing is kept and the
grades are null. Null labels and labels without a document are left out, and
each repeated label counts. Rows may repeat. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm.common import mapped, table
from layerkit.llm.samples import independent, labelled_sample
from layerkit.llm.shingles import text_chunks, words

SLOTS = 1 << 18
FIT_ROWS = 6_000
GRADES = 3
STEPS = 250
PENALTY = 3e-5
SIGNIFICANCE = 0.01
KEEP = 0.5
STEPS_OF_SHARE = 8
_NO_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])


def _class(characters: str) -> np.ndarray:
    return np.array([b < 128 and chr(b) in characters for b in range(256)])


# What is counted, against letters or words.
_COUNTED = (
    (_class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "letters"),
    (_class("0123456789"), "letters"),
    (_class("!?"), "words"),
    (_class("#*$%&<>"), "words"),
    (_class("|"), "words"),
)
_SHARE_SLOTS = (len(_COUNTED) + 1) * (STEPS_OF_SHARE + 1)


def text_features(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted slots that each text sets; the first slots are for shares."""
    for _, data, offsets in text_chunks(texts):
        hashes, begin = words(data, offsets, _NO_LETTER)
        slots = (hashes % np.uint64(SLOTS - _SHARE_SLOTS)).astype(np.int32) + _SHARE_SLOTS

        def per_text(flags: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0], np.cumsum(flags[data])])[offsets])

        totals = {"letters": per_text(~_NO_LETTER), "words": np.diff(begin)}
        shares = [per_text(flags) / np.maximum(totals[of], 1) for flags, of in _COUNTED]
        for row in range(len(offsets) - 1):
            own = np.unique(slots[begin[row] : begin[row + 1]])
            if not len(own):
                yield own
                continue
            values = [*(share[row] for share in shares), len(own) / totals["words"][row]]
            steps = [i * (STEPS_OF_SHARE + 1) + min(STEPS_OF_SHARE, int(np.ceil(STEPS_OF_SHARE * v))) for i, v in enumerate(values)]
            yield np.concatenate([np.array(steps, np.int32), own])


@dataclass(frozen=True)
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """Chances of a grade of 1 or more, 2 or more, and so on."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds, -30, 30)))


def _surprise(seen: np.ndarray, texts: np.ndarray, share: float) -> np.ndarray:
    """Logarithm by which chance alone would make ``seen`` of ``texts`` unlikely, by Chernoff's bound."""
    rate = seen / np.maximum(texts, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(r > 0, r * np.log(r / s), 0.0) for r, s in ((rate, share), (1 - rate, 1 - share))]
    return texts * (parts[0] + parts[1])


def _telling(columns: np.ndarray, of_column: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """All features that tell grades apart at some cut, at ``SIGNIFICANCE`` over features and cuts."""
    texts = np.bincount(columns, minlength=SLOTS)
    cuts = range(1, grades.max(initial=0) + 1)
    least = np.log(max(1, len(cuts)) * max(1, np.count_nonzero(texts)) / SIGNIFICANCE)
    tells = np.zeros(SLOTS, bool)
    for cut in cuts:
        share = float((grades < cut).mean())
        if 0 < share < 1:
            tells |= _surprise(np.bincount(columns[of_column < cut], minlength=SLOTS), texts, share) > least
    return np.flatnonzero(tells)


def fit(rows: list[np.ndarray], grades: np.ndarray, count: int = GRADES) -> Ordinal:
    """Full-batch Adam on the cumulative-link likelihood; thresholds stay in order.

    Thresholds are a first one and positive steps, so no order can be lost.
    """
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    columns = np.concatenate(rows) if len(rows) else np.zeros(0, np.int32)
    chosen = _telling(columns, grades[owner], grades)
    held = np.isin(columns, chosen)
    owner, columns = owner[held], columns[held]
    share = np.full(len(rows), 1 / max(1, len(rows)))
    weights, start, steps = np.zeros(SLOTS), -1.0, np.zeros(count - 2)
    flat = np.concatenate([weights, [start], steps])
    mean, spread = np.zeros_like(flat), np.zeros_like(flat)
    for step in range(1, STEPS + 1):
        weights, start, steps = flat[:SLOTS], flat[SLOTS], flat[SLOTS + 1 :]
        cuts = start + np.concatenate([[0.0], np.cumsum(np.exp(steps))])
        score = np.bincount(owner, weights[columns], minlength=len(rows))
        above = 1 / (1 + np.exp(-np.clip(score[:, None] - cuts, -30, 30)))
        edge = np.concatenate([np.ones((len(rows), 1)), above, np.zeros((len(rows), 1))], axis=1)
        chance = np.maximum(edge[np.arange(len(rows)), grades] - edge[np.arange(len(rows)), grades + 1], 1e-9)
        slope = above * (1 - above)
        slope = np.concatenate([np.zeros((len(rows), 1)), slope, np.zeros((len(rows), 1))], axis=1)
        low, high = slope[np.arange(len(rows)), grades], slope[np.arange(len(rows)), grades + 1]
        pull = share * (low - high) / chance
        by_weight = np.bincount(columns, pull[owner], minlength=SLOTS) - PENALTY * weights
        by_cut = np.zeros(count + 1)
        np.add.at(by_cut, grades, -share * low / chance)
        np.add.at(by_cut, grades + 1, share * high / chance)
        by_cut = by_cut[1:count]
        later = np.cumsum(by_cut[::-1])[::-1]
        gradient = np.concatenate([by_weight, [later[0]], later[1:] * np.exp(steps)])
        mean = 0.9 * mean + 0.1 * gradient
        spread = 0.99 * spread + 0.01 * gradient**2
        flat = flat + 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
    weights, start, steps = flat[:SLOTS], flat[SLOTS], flat[SLOTS + 1 :]
    return Ordinal(weights, start + np.concatenate([[0.0], np.cumsum(np.exp(steps))]))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [f.tobytes() for f in text_features(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.array(found, pa.binary())], names=["grade", "slots"])


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Ordinal | None:
    """Model from about ``fit_rows`` rated documents."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    rated = labels.where("doc_id is not null and quality is not null and toxic is not null")
    rated = rated.select(F.col("doc_id").alias("__id"), grade.cast("int").alias("grade"))
    rated = rated.groupBy("__id").agg(F.min("grade").alias("grade"))
    joined = independent(labelled_sample(docs, rated, fit_rows, "grade"), "grade")
    rows = sorted((r["grade"], bytes(r["slots"])) for r in mapped(joined, _featured, "grade int, slots binary").collect())
    if not rows:
        return None
    return fit([np.frombuffer(s, np.int32) for _, s in rows], np.array([g for g, _ in rows]))


_DDL = "doc_id long, expected_grade double, tail_prob double, kept boolean"


def _grader(model: Ordinal | None):
    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(text_features(batch.column("text")))
            if model is None:
                expected = tail = [None] * len(found)
                kept = [False] * len(found)
            else:
                score = np.array([model.weights[f].sum() for f in found])
                tails = model.tails(score)
                expected, tail = tails.sum(axis=1).tolist(), tails[:, -1].tolist()
                kept = [bool(len(f)) and p >= KEEP for f, p in zip(found, tail)]
            arrays = [pa.array(expected, pa.float64()), pa.array(tail, pa.float64()), pa.array(kept, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", "expected_grade", "tail_prob", "kept"])

    return grade


def graded(docs: DataFrame, model: Ordinal | None) -> DataFrame:
    """Expected grade, tail probability and whether each row is kept."""
    return mapped(docs.select("doc_id", "text"), _grader(model), _DDL)


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades of all documents, by a model fitted on the rated ones."""
    docs = table(spark, sf_dir, "documents")
    return graded(docs, train(docs, table(spark, sf_dir, "labels")))

"""Bounded samples of labelled documents for fitting."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerkit.llm.common import mapped
from layerkit.llm.shingles import mix, shingle_sets
from layerkit.sources.scratch import settle

_ORDERS = mix(np.arange(1, 5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SKETCH = tuple(f"__sketch{k}" for k in range(len(_ORDERS)))
_STEPS = 1_000_000


def drawn(share: float, *by: Column | str) -> Column:
    """Whether a row belongs to a share of about this size; always the same rows."""
    return F.pmod(F.xxhash64(*by), F.lit(_STEPS)) < _STEPS * min(1.0, share)


def labelled_sample(docs: DataFrame, marks: DataFrame, fit_rows: int, salt: str) -> DataFrame:
    """The text of about ``fit_rows`` marked documents, with the columns of ``marks``.

    ``marks`` has one row an ``__id``. Marks are drawn by id first, so that few
    are joined, and the rows that carry them by id and text, so that an id of
    many rows is drawn like any other. Rows that repeat both count once.
    """
    total = marks.count()
    picked, some = settle(marks.where(drawn(fit_rows / max(total, 1), "__id", F.lit(salt))))
    picked = F.broadcast(picked) if some <= 4 * fit_rows else picked
    joined = docs.select("doc_id", "text").join(picked, F.col("doc_id") == F.col("__id"))
    held = joined.agg(F.count_distinct(F.xxhash64("doc_id", "text"))).first()[0]
    chosen = joined.where(drawn(fit_rows / max(held, 1), "doc_id", "text")).distinct()
    return settle(chosen.select(*[c for c in marks.columns if c != "__id"], "text"))[0]


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least shingle of each text by each of several orders."""
    for batch in batches:
        least = np.zeros((batch.num_rows, len(_ORDERS)), np.int64)
        for row, found in shingle_sets(batch.column("text"), 5):
            if len(found):
                least[row] = [mix(found ^ salt).min().view(np.int64) for salt in _ORDERS]
        arrays = [*batch.columns, *(pa.array(least[:, k]) for k in range(len(_ORDERS)))]
        yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *_SKETCH])


def independent(sample: DataFrame, label: str) -> DataFrame:
    """One document of each text and, but for rare misses, of each group of near copies, as ``(label, text)``.

    Copies share their labels, so words of a group that is labelled by mistake
    would seem to tell. ``sample`` is bounded, and so is any group in it.
    """
    schema = f"{label} int, text string, " + ", ".join(f"{s} long" for s in _SKETCH)
    made, _ = settle(mapped(sample.select(label, "text"), _sketched, schema))
    for sketch in _SKETCH:
        first = F.row_number().over(Window.partitionBy(sketch).orderBy(F.xxhash64("text"), label))
        made = made.withColumn("__first", first).where("__first = 1").drop("__first")
    return settle(made.select(label, "text"))[0]

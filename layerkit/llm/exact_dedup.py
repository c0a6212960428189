"""Exact dedup with static binary-fuse filters over immutable snapshots.

A snapshot's distinct digests are dealt into buckets, and each bucket gets one
binary-fuse filter (Graf and Lemire, 2022), about nine bits a digest, written
once and never changed. Incoming rows are first grouped among themselves. One
digest of each group is then screened by its bucket's filter. What the filter
refuses is new for certain. What it lets pass joins the exact buckets of the
snapshot. Digests that occur more than once are read again and their texts are
compared byte by byte.

Copies are counted before any join, so a text with any number of copies moves
as one row of each task. Filters are never broadcast: they meet their bucket.

Defined cases: a null text counts as empty, and empty texts are copies of each
other. Of repeated rows with the same doc_id and text exactly one stays. A null
doc_id is smaller than any other. Other columns of the table are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm.common import key_bitmap, mapped, numbered, table, without_rows
from layerkit.llm.shingles import mix
from layerkit.operators.rowid import in_place
from layerkit.sources.readers import read_layer
from layerkit.sources.scratch import settle
from layerkit.sources.writers import write_layer

BUCKET_DIGESTS = 50_000
_SEED_STEP = np.uint64(0x9E3779B97F4A7C15)


def _normal(batch: pa.RecordBatch) -> list[bytes]:
    """Texts as UTF-8 with A-Z, and nothing else, in lower case."""
    return [t.lower() for t in batch.column("text").cast(pa.large_string()).fill_null("").cast(pa.large_binary()).to_pylist()]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [hashlib.sha256(t).digest() for t in _normal(batch)]
        marks = [int.from_bytes(d[:8], "little", signed=True) for d in found]
        same = [batch.column(c) for c in ("file", "at", "doc_id")]
        yield pa.RecordBatch.from_arrays(
            [*same, pa.array(found, pa.binary()), pa.array(marks, pa.int64())], names=["file", "at", "doc_id", "digest", "mark"]
        )


def _copies(bits: bytes):
    """Digest and bytes of each row whose digest perhaps repeats."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = []
            for text in _normal(batch):
                digest = hashlib.sha256(text).digest()
                at = int.from_bytes(digest[:8], "little") % (8 * len(bits))
                if bits[at >> 3] >> (at & 7) & 1:
                    pairs.append((digest, text))
            columns = zip(*pairs) if pairs else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()) for c in columns], names=["digest", "bytes"])

    return read


class FuseFilter:
    """Membership of 64-bit keys: never a false no, a false yes once in 256."""

    def __init__(self, seed: int, segment: int, segments: int, prints: np.ndarray) -> None:
        self.seed, self.segment, self.segments, self.prints = seed, segment, segments, prints

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mix(keys + np.uint64(self.seed) * _SEED_STEP)
        reach = np.uint64(self.segment * self.segments)
        first = ((h >> np.uint64(32)) * reach) >> np.uint64(32)
        mask = np.uint64(self.segment - 1)
        # A key's three places lie in neighbouring segments.
        second = first + np.uint64(self.segment) ^ (h >> np.uint64(18)) & mask
        third = first + np.uint64(2 * self.segment) ^ h & mask
        return np.stack([first, second, third], axis=1).astype(np.int64), (h ^ (h >> np.uint64(32))).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        """Filter of distinct keys; a seed that cannot be solved is replaced by the next."""
        count = max(2, len(keys))
        segment = 1 << min(18, max(2, int(math.log(count) / math.log(3.33) + 2.25)))
        room = count * max(1.125, 0.875 + 0.25 * math.log(1_000_000) / math.log(count))
        segments = max(1, math.ceil(room / segment) - 2)
        seed = 0
        while True:
            made = cls(seed, segment, segments, np.zeros(segment * (segments + 2), np.uint8))
            if made._solve(keys):
                return made
            seed += 1

    def _solve(self, keys: np.ndarray) -> bool:
        places, prints = self._places(keys)
        held = np.bincount(places.ravel(), minlength=len(self.prints))
        sums = np.zeros(len(self.prints), np.int64)
        np.add.at(sums, places.ravel(), np.repeat(np.arange(len(keys)), 3))
        rounds, left = [], len(keys)
        alone = np.flatnonzero(held == 1)
        while len(alone):
            owner, first = np.unique(sums[alone], return_index=True)
            rounds.append((owner, alone[first]))
            left -= len(owner)
            touched = places[owner].ravel()
            np.subtract.at(held, touched, 1)
            np.subtract.at(sums, touched, np.repeat(owner, 3))
            alone = np.unique(touched[held[touched] == 1])
        for owner, place in reversed(rounds):
            others = self.prints[places[owner]]
            self.prints[place] = prints[owner] ^ others[:, 0] ^ others[:, 1] ^ others[:, 2]
        return left == 0

    def __contains__(self, key: int) -> bool:
        return bool(self.holds(np.array([key], np.uint64))[0])

    def holds(self, keys: np.ndarray) -> np.ndarray:
        places, prints = self._places(keys)
        found = self.prints[places]
        return (found[:, 0] ^ found[:, 1] ^ found[:, 2]) == prints


_FILTER = "bucket int, seed long, segment int, segments int, prints binary"


def _build(group: pd.DataFrame) -> pd.DataFrame:
    made = FuseFilter.build(np.unique(group["mark"].to_numpy().view(np.uint64)))
    row = (group["bucket"].iloc[0], made.seed, made.segment, made.segments, made.prints.tobytes())
    return pd.DataFrame([row], columns=["bucket", "seed", "segment", "segments", "prints"])


def _screen(incoming: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    known = np.zeros(len(incoming), bool)
    for row in filters.itertuples():
        held = FuseFilter(row.seed, row.segment, row.segments, np.frombuffer(row.prints, np.uint8))
        known |= held.holds(incoming["mark"].to_numpy().view(np.uint64))
    return incoming[["digest"]].assign(hit=known)


def fuse_filters(snapshot: DataFrame, buckets: int) -> DataFrame:
    """One filter per bucket of a snapshot's ``(digest, mark)``, written for good."""
    bucket = F.pmod(F.shiftright("mark", 40), F.lit(buckets)).cast("int")
    return settle(snapshot.select(bucket.alias("bucket"), "mark").groupBy("bucket").applyInPandas(_build, _FILTER))[0]


def screened(incoming: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """``(digest, hit)`` for distinct incoming digests; no hit means certainly new."""
    bucket = F.pmod(F.shiftright("mark", 40), F.lit(buckets)).cast("int")
    placed = incoming.select("digest", "mark", bucket.alias("bucket"))
    return placed.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(_screen, "digest binary, hit boolean")


def _newest() -> Column:
    return F.max(F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "file", "at"))


@dataclass(frozen=True)
class Snapshot:
    """Digests of a table with their filters, written once under a path and opened by any later job.

    Batches are screened against what is stored: no filter is built again, and
    only digests that a filter lets pass meet the stored ones.
    """

    digests: DataFrame  # digest, mark, keep_id: one row each
    filters: DataFrame
    buckets: int

    @staticmethod
    def build(docs: DataFrame, path: str, bucket_digests: int = BUCKET_DIGESTS) -> Snapshot:
        spark = docs.sparkSession
        read = mapped(numbered(in_place(docs), "doc_id", "text"), _digests, "file long, at long, doc_id long, digest binary, mark long")
        held = read.groupBy("digest", "mark").agg(_newest().alias("keep")).select("digest", "mark", F.col("keep.doc_id").alias("keep_id"))
        rows = write_layer(held, f"{path}/digests")
        buckets = max(8, rows // bucket_digests)
        digests = read_layer(spark, f"{path}/digests")
        write_layer(fuse_filters(digests, buckets).withColumn("buckets", F.lit(buckets)), f"{path}/filters")
        return Snapshot.open(spark, path)

    @staticmethod
    def open(spark: SparkSession, path: str) -> Snapshot:
        filters = read_layer(spark, f"{path}/filters")
        return Snapshot(read_layer(spark, f"{path}/digests"), filters.drop("buckets"), filters.agg(F.max("buckets")).first()[0] or 8)

    def incoming(self, docs: DataFrame) -> DataFrame:
        """``(file, at, doc_id, digest, known, keep_id)`` of each row of a batch.

        ``known`` says that the snapshot holds the text; ``keep_id`` is the row
        that stays, the snapshot's or else the batch's own with the largest doc_id.
        """
        read = mapped(numbered(in_place(docs), "doc_id", "text"), _digests, "file long, at long, doc_id long, digest binary, mark long")
        rows, _ = settle(read)
        groups = rows.groupBy("digest", "mark").agg(_newest().alias("keep"))
        passed = screened(groups, self.filters, self.buckets).where("hit").select("digest")
        held = self.digests.join(passed, "digest", "left_semi").select("digest", F.lit(True).alias("known"), F.col("keep_id").alias("held_id"))
        kept = F.when(F.col("known"), F.col("held_id")).otherwise(F.col("keep.doc_id")).alias("keep_id")
        known = F.coalesce("known", F.lit(False)).alias("known")
        settled, _ = settle(groups.join(held, "digest", "left").select("digest", known, kept))
        return rows.join(settled, "digest").select("file", "at", "doc_id", "digest", "known", "keep_id")


def copy_groups(docs: DataFrame, in_snapshot: Column | None = None) -> DataFrame:
    """One row ``(file, at, doc_id, digest, keep_id, group_size, kept)`` per row of ``docs``.

    ``in_snapshot``, over doc_id, says which rows the snapshot already holds;
    by default the lower half of the range of doc_ids. The rest is the incoming
    batch. A digest with two texts, which SHA-256 is not known to have, is
    reported as an error and never merged.
    """
    rows = numbered(docs, "doc_id", "text")
    known, total = settle(mapped(rows, _digests, "file long, at long, doc_id long, digest binary, mark long"))
    if in_snapshot is None:
        low, high = known.agg(F.min("doc_id"), F.max("doc_id")).first()
        in_snapshot = F.col("doc_id") <= F.lit(None if low is None else (low + high) // 2)
    in_snapshot = F.coalesce(in_snapshot, F.lit(False))
    order = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "file", "at")
    grouped = known.groupBy(in_snapshot.alias("old"), "digest", "mark").agg(F.count(F.lit(1)).alias("n"), F.max(order).alias("keep"))
    grouped, _ = settle(grouped)
    old, new = grouped.where("old"), grouped.where("not old")

    buckets = max(8, total // BUCKET_DIGESTS)
    filters = fuse_filters(old, buckets)
    new = new.join(screened(new, filters, buckets), "digest")
    positive = new.where("hit").select("digest", F.col("n").alias("more"), F.col("keep").alias("other"))
    # Digests are distinct on both sides, so this join has no heavy key.
    exact = old.join(positive, "digest", "full").select(
        "digest",
        (F.coalesce("n", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("group_size"),
        F.greatest("keep", "other").alias("keep"),
    )
    fresh = new.where("not hit").select("digest", F.col("n").alias("group_size"), "keep")
    groups, _ = settle(exact.unionByName(fresh))

    marks, repeated = settle(groups.where("group_size > 1").join(grouped.select("digest", "mark").distinct(), "digest").select("mark"))
    texts = mapped(rows.select("text"), _copies(key_bitmap(marks, "mark", repeated)), "digest binary, bytes binary").distinct()
    mixed = texts.groupBy("digest").count().where("count > 1").limit(1).collect()
    if mixed:
        raise RuntimeError("two different texts share a digest")

    kept = (F.col("keep.file") == F.col("file")) & (F.col("keep.at") == F.col("at"))
    return known.join(groups, "digest").select(
        "file", "at", "doc_id", "digest", F.col("keep.doc_id").alias("keep_id"), "group_size", kept.alias("kept")
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copies of every document, and which of them stays."""
    found = copy_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs``, from any plan, with one row of each text."""
    docs = in_place(docs)
    return without_rows(docs, copy_groups(docs).where("not kept").select("file", "at"))


# A-Z alone is lower-cased: translate, because lower() also changes other letters.
OP3_SQL = """
WITH texts AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY t)
"""

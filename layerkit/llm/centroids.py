"""Centroid clustering over dictionaries of subvectors.

A vector of integers is cut into blocks of ``WIDTH`` dimensions. Few different
subvectors occur in a block, so each block gets a dictionary of them and a
vector becomes one code a block, without loss. In each round the exact squared
distance of every dictionary entry to every centroid is computed once; a vector
then adds up one looked-up number a block, and its cluster is the least sum. The
sums behind new centroids come from counts of codes by cluster.

A dictionary holds at most ``ENTRIES`` subvectors of a block, the most frequent
ones: their number is what reaches the driver and the tasks. Where a block has
more, a vector keeps its subvector itself under an escape code and its distance
is computed directly, so every distance is exact at any size.

Codes are written once. A round reads them, and only one row of sums a cluster
and dimension leaves a task, so no vector is shuffled and a vector that a third
of all rows repeat plays no part.

Defined cases: vectors that are null, have another length than ``dims`` or hold
a null, NaN or infinite component take no part. A vec_id may be null or repeat;
each row counts and is returned, and rows that tie for a starting centroid go
by their components. With fewer vectors than ``clusters`` there are as many
clusters as vectors; an empty table gives no rows. A scaled component of 2**26
or more in size is an error, since sums could wrap. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm.common import mapped, table
from layerkit.sources.scratch import settle

DIMS = 64
WIDTH = 2
ENTRIES = 4096
CLUSTERS = 16
ROUNDS = 3
SCALE = 64
_LIMIT = 1 << 26
_ESCAPE = 0xFFFF


def usable(vector: Column, dims: int | None = None) -> Column:
    """Not null, without null or non-finite components, and of ``dims`` components if given."""
    infinite = (F.lit(float("inf")), F.lit(float("-inf")))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & ~x.cast("double").isin(*infinite))
    fits = sound if dims is None else (F.size(vector) == dims) & sound
    return F.coalesce(fits, F.lit(False))


def integers(batch: pa.RecordBatch, dims: int, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of the batch's vectors, one row each."""
    flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(flat * scale)
    if len(scaled) and np.abs(scaled).max() >= _LIMIT:
        raise ValueError(f"a scaled component is {_LIMIT} or more in size")
    return scaled.astype(np.int64).reshape(batch.num_rows, dims)


def _keys(vectors: np.ndarray, width: int) -> np.ndarray:
    """Each block's subvector as one integer, blocks in columns."""
    shifted = (vectors + _LIMIT).reshape(len(vectors), -1, width)
    keys = np.zeros(shifted.shape[:2], np.int64)
    for place in range(width):
        keys = keys << 27 | shifted[:, :, place]
    return keys


def _parts(keys: np.ndarray, width: int) -> np.ndarray:
    """The subvectors behind keys, components in the last axis."""
    return np.stack([(keys >> (27 * (width - 1 - place)) & ((1 << 27) - 1)) - _LIMIT for place in range(width)], axis=-1)


@dataclass(frozen=True)
class Dictionary:
    """Sorted keys of each block."""

    keys: tuple[np.ndarray, ...]
    width: int

    def parts(self, block: int) -> np.ndarray:
        return _parts(self.keys[block], self.width)

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the keys of escaped places in row order."""
        keys = _keys(vectors, self.width)
        codes = np.full(keys.shape, _ESCAPE, np.uint16)
        for block, known in enumerate(self.keys):
            if len(known):
                at = np.minimum(np.searchsorted(known, keys[:, block]), len(known) - 1)
                codes[:, block] = np.where(known[at] == keys[:, block], at, _ESCAPE)
        return codes, keys[codes == _ESCAPE]

    def distances(self, centroids: np.ndarray) -> list[np.ndarray]:
        """Exact squared distance of each entry to each centroid, by block."""
        cut = centroids.reshape(len(centroids), -1, self.width)
        return [((self.parts(b)[:, None, :] - cut[None, :, b, :]) ** 2).sum(axis=2) for b in range(len(self.keys))]


def _counted(dims: int, scale: int, width: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _keys(integers(batch, dims, scale), width)
            for block in range(keys.shape[1] if len(keys) else 0):
                found, n = np.unique(keys[:, block], return_counts=True)
                blocks = np.full(len(found), block, np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(blocks), pa.array(found), pa.array(n.astype(np.int64))], names=["block", "key", "n"])

    return count


def dictionary(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE, width: int = WIDTH, entries: int = ENTRIES) -> Dictionary:
    """Up to ``entries`` subvectors of each block, by frequency in steps of a power of two."""
    counted = mapped(vectors.select("embedding"), _counted(dims, scale, width), "block int, key long, n long")
    found, _ = settle(counted.groupBy("block", "key").agg(F.sum("n").alias("n")))
    level = F.floor(F.log2(F.col("n"))).cast("int")
    steps: dict[int, list[tuple[int, int]]] = {}
    for row in found.groupBy("block", level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect():
        steps.setdefault(row["block"], []).append((row["level"], row["n"]))
    least = []
    for block in range(dims // width):
        held, lowest = 0, 64
        for at, n in sorted(steps.get(block, []), reverse=True):
            held += n
            if held > entries:
                break
            lowest = at
        least.append(lowest)
    kept = found.where(level >= F.element_at(F.array(*[F.lit(x) for x in least]), F.col("block") + 1)).select("block", "key").toArrow()
    blocks, keys = kept["block"].to_numpy(), kept["key"].to_numpy()
    return Dictionary(tuple(np.sort(keys[blocks == b]) for b in range(dims // width)), width)


def _encoder(known: Dictionary, dims: int, scale: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, rest = known.encode(integers(batch, dims, scale))
            ends = np.cumsum((codes == _ESCAPE).sum(axis=1))
            escaped = [rest[a:b].tobytes() for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)]
            made = [pa.array([row.tobytes() for row in codes], pa.binary()), pa.array(escaped, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), *made], names=["vec_id", "codes", "rest"])

    return encode


def _read(batch: pa.RecordBatch, known: Dictionary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, and rows, blocks and subvectors of what is escaped."""
    codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint16).reshape(batch.num_rows, len(known.keys))
    rows, blocks = np.nonzero(codes == _ESCAPE)
    keys = np.frombuffer(b"".join(batch.column("rest").to_pylist()), np.int64)
    return codes, rows, blocks, _parts(keys, known.width)


def _nearest(read: tuple, tables: list[np.ndarray], centroids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and distance of each row; of equally near centroids the first."""
    codes, rows, blocks, parts = read
    total = np.zeros((len(codes), len(centroids)), np.int64)
    for block, lookup in enumerate(tables):
        if len(lookup):
            # Escaped places read entry 0 here and are taken out again.
            own = codes[:, block]
            held = own != _ESCAPE
            total += lookup[own] if held.all() else lookup[np.where(held, own, 0)] * held[:, None]
    if len(rows):
        cut = centroids.reshape(len(centroids), -1, width)
        np.add.at(total, rows, ((parts[:, None, :] - cut[:, blocks, :].transpose(1, 0, 2)) ** 2).sum(axis=2))
    best = total.argmin(axis=1)
    return best, total[np.arange(len(best)), best]


def _summer(known: Dictionary, centroids: np.ndarray, tables: list[np.ndarray]):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clusters, width = len(centroids), known.width
        counts = [np.zeros((clusters, len(keys)), np.int64) for keys in known.keys]
        sums = np.zeros((clusters, centroids.shape[1] // width, width), np.int64)
        members = np.zeros(clusters, np.int64)
        for batch in batches:
            read = _read(batch, known)
            best, _ = _nearest(read, tables, centroids, width)
            members += np.bincount(best, minlength=clusters)
            codes, rows, blocks, parts = read
            for block, held in enumerate(counts):
                own = codes[:, block]
                inside = own != _ESCAPE
                held += np.bincount(best[inside] * held.shape[1] + own[inside], minlength=held.size).reshape(held.shape)
            np.add.at(sums, (best[rows], blocks), parts)
        for block, held in enumerate(counts):
            sums[:, block, :] += held @ known.parts(block)
        flat = np.concatenate([members[:, None], sums.reshape(clusters, -1)], axis=1)
        cluster, place = np.divmod(np.arange(flat.size), flat.shape[1])
        arrays = [pa.array(cluster.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(flat.ravel())]
        yield pa.RecordBatch.from_arrays(arrays, names=["cluster", "place", "total"])

    return add


def _assigner(known: Dictionary, centroids: np.ndarray, tables: list[np.ndarray]):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, distance = _nearest(_read(batch, known), tables, centroids, known.width)
            made = [pa.array(best.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), *made], names=["vec_id", "cluster", "distance"])

    return assign


def first_centroids(vectors: DataFrame, clusters: int, scale: int) -> np.ndarray:
    """The vectors with the smallest hashes of their ids, in that order; at most ``clusters`` rows reach the driver."""
    digest = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    first = vectors.select(digest.alias("digest"), whole.alias("v")).orderBy(F.col("digest").asc_nulls_last(), "v").limit(clusters)
    return np.array([r["v"] for r in first.collect()], np.int64)


def clustered(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE,
    width: int = WIDTH, entries: int = ENTRIES,
) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, cluster, distance)`` of each usable vector after ``rounds`` rounds, and the centroids.

    ``vectors`` has ``vec_id`` and ``embedding``; ``width`` divides ``dims`` and is 1 or 2.
    """
    if entries >= _ESCAPE or width not in (1, 2):
        raise ValueError("codes have 16 bits and keys 64")
    kept = vectors.select("vec_id", "embedding").where(usable(F.col("embedding"), dims))
    centroids = first_centroids(kept, clusters, scale)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    known = dictionary(kept, dims, scale, width, entries)
    coded, _ = settle(mapped(kept, _encoder(known, dims, scale), "vec_id long, codes binary, rest binary"))
    for _ in range(rounds):
        summed = mapped(coded.select("codes", "rest"), _summer(known, centroids, known.distances(centroids)), "cluster int, place int, total long")
        totals = np.zeros((len(centroids), dims + 1), np.int64)
        for row in summed.groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect():
            totals[row["cluster"], row["place"]] = row["total"]
        members = totals[:, :1]
        centroids = np.where(members > 0, totals[:, 1:] // np.maximum(members, 1), centroids)
    found = mapped(coded, _assigner(known, centroids, known.distances(centroids)), "vec_id long, cluster int, distance long")
    return found, centroids


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all embeddings, with their inertia and a digest of each centroid."""
    found, centroids = clustered(table(spark, sf_dir, "embeddings"))
    found, _ = settle(found)
    by_cluster = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    inertia = F.array(*[F.lit(by_cluster.get(c, 0)) for c in range(len(digests))]).cast("array<long>")
    return found.select(
        "vec_id",
        "cluster",
        "distance",
        F.get(inertia, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(by_cluster.values())).cast("long").alias("inertia"),
        F.get(F.array(*[F.lit(d) for d in digests]).cast("array<string>"), F.col("cluster")).alias("centroid_sha256"),
    )


def _round_sql(number: int) -> str:
    """Assignment to the centroids of one round, and the centroids of the next."""
    return f"""near{number} AS (
    SELECT r, any_value(vec_id) AS vec_id, any_value(kept.v) AS v, min((
        list_sum(list_transform(list_zip(kept.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, c.cluster)) AS best
    FROM kept, centre{number} AS c GROUP BY r
), mean{number} AS (
    SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY place) AS v FROM (
        SELECT best[2] AS cluster, place, sum(v[place])::BIGINT AS s, count(*) AS n FROM near{number}, range(1, {DIMS + 1}) AS p(place) GROUP BY 1, 2)
    GROUP BY cluster
), centre{number + 1} AS (
    SELECT c.cluster, coalesce(m.v, c.v) AS v FROM centre{number} AS c LEFT JOIN mean{number} AS m USING (cluster)
)"""


OP12_SQL = f"""
WITH kept AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS}
), centre0 AS (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS cluster, v FROM kept QUALIFY cluster < {CLUSTERS}
), {", ".join(_round_sql(n) for n in range(ROUNDS + 1))}
SELECT vec_id, best[2]::INTEGER AS cluster, best[1] AS distance, (sum(best[1]) OVER (PARTITION BY best[2]))::BIGINT AS cluster_inertia,
       (sum(best[1]) OVER ())::BIGINT AS inertia, sha256(array_to_string(centre{ROUNDS}.v, ',')) AS centroid_sha256
FROM near{ROUNDS} JOIN centre{ROUNDS} ON best[2] = centre{ROUNDS}.cluster
"""

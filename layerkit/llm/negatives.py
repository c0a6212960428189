"""Hard negatives for contrastive training, by a multiway tree of split points.

Every node of the tree has up to ``WAYS`` split points; a row goes to the
nearest one, which parts space by hyperplanes. For each split point the node
stores the range of its distances to the rows below each sibling, over all rows
of the table. A query is a window of scores. With the range of lengths below a
subtree a window becomes an annulus of distances around the query; the triangle
inequality turns that into a range of distances from each split point, and a
subtree whose stored range misses it is left out. What remains is searched
exactly, so results are exact whatever the tree looks like: recall is 1.

Two searches: the best rows of an anchor's own label are its positives, and
their scores set the windows in which its negatives are looked for. Before
each, the sample behind the tree gives a lower bound for the last place, which
narrows the windows.

The tree is fitted on up to ``SAMPLE_ROWS`` rows with the smallest hashes. All
rows are indexed. Leaves are gathered into groups of at most ``GROUP_ROWS`` rows;
a larger leaf, say of a vector that a third of all rows repeat, is cut by row
position. A task holds one group and streams the anchors that need it, so its
memory is bounded. An anchor travels once for each group it needs. With more
than ``GROUPS`` times ``GROUP_ROWS`` rows the number of groups grows with the
table, and work with the product of anchors and rows, as for any exact search
that the ranges do not narrow.

Scores are integer inner products of components scaled by ``SCALE`` and floored.

Defined cases: rows with a null label or vector, or a null, NaN or infinite
component take no part. A shorter vector reads as if filled up with zeros. A null
vec_id is no anchor and comes last among ties. Repeated rows count one by one;
of rows that equal the anchor one is itself. An anchor without positives, or a
positive without rows in its window, gives no rows. Windows of a negative score
are empty. A vector whose scaled squared length reaches 2**50 is an error, since
scores would not be exact. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerkit.llm.centroids import SCALE as COARSE, usable
from layerkit.llm.common import mapped, numbered, table
from layerkit.sources.scratch import settle

SCALE = 4 * COARSE
SAMPLE_ROWS = 4096
WAYS = 16
LEVELS = 2
LEAST_ROWS = 4 * WAYS
GROUPS = 32
GROUP_ROWS = 1 << 18
POSITIVES = 5
NEGATIVES = 5
LOW_PERCENT = 80
HIGH_PERCENT = 100
ANCHORS_AT_ONCE = 32
_NONE = np.int64(-(2**62))


@dataclass(frozen=True)
class Node:
    """Split points and what each leads to: another node, or a leaf's number."""

    points: np.ndarray
    below: tuple[Node | int, ...]
    number: int

    def leaves(self) -> list[int]:
        return [leaf for child in self.below for leaf in (child.leaves() if isinstance(child, Node) else [child])]

    def nodes(self) -> list[Node]:
        return [self, *(n for child in self.below if isinstance(child, Node) for n in child.nodes())]


def squares(rows: np.ndarray) -> np.ndarray:
    return (rows * rows).sum(axis=1)


def squared_distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact, since rows hold integers and lengths are bounded."""
    return np.maximum(squares(rows)[:, None] + squares(points)[None, :] - 2 * (rows @ points.T), 0)


def split_points(rows: np.ndarray, ways: int) -> np.ndarray:
    """Points far apart: each next one is the candidate farthest from those chosen."""
    candidates = rows[np.linspace(0, len(rows) - 1, min(len(rows), 3 * ways)).astype(int)]
    chosen = [0]
    apart = squared_distances(candidates, candidates[:1])[:, 0]
    while len(chosen) < ways and apart.max() > 0:
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, squared_distances(candidates, candidates[chosen[-1:]])[:, 0])
    return candidates[chosen]


def grow(rows: np.ndarray, ways: int = WAYS, levels: int = LEVELS, least: int = LEAST_ROWS) -> Node:
    """Tree over a sample; nodes and leaves are numbered from 0."""
    numbers = {"node": 0, "leaf": 0}

    def make(part: np.ndarray, level: int) -> Node | int:
        if level == levels or (level and len(part) < least):
            numbers["leaf"] += 1
            return numbers["leaf"] - 1
        number = numbers["node"]
        numbers["node"] += 1
        points = split_points(part, ways)
        nearest = squared_distances(part, points).argmin(axis=1)
        return Node(points, tuple(make(part[nearest == k], level + 1) for k in range(len(points))), number)

    root = make(rows, 0)
    assert isinstance(root, Node)
    return root


def descend(root: Node, rows: np.ndarray) -> Iterator[tuple[Node, np.ndarray, np.ndarray, np.ndarray]]:
    """``(node, rows that reach it, their squared distances to its points, which is nearest)``."""
    waiting = [(root, np.arange(len(rows)))]
    while waiting:
        node, held = waiting.pop()
        if not len(held):
            continue
        apart = squared_distances(rows[held], node.points)
        nearest = apart.argmin(axis=1)
        yield node, held, apart, nearest
        waiting += [(child, held[nearest == k]) for k, child in enumerate(node.below) if isinstance(child, Node)]


def leaf_of(root: Node, rows: np.ndarray) -> np.ndarray:
    found = np.zeros(len(rows), np.int32)
    for node, held, _, nearest in descend(root, rows):
        for k, child in enumerate(node.below):
            if not isinstance(child, Node):
                found[held[nearest == k]] = child
    return found


@dataclass(frozen=True)
class Ranges:
    """Over all rows below child ``j`` of a node: distances to its points ``i``, and lengths, squared."""

    low: dict[int, np.ndarray]
    high: dict[int, np.ndarray]
    shortest: dict[int, np.ndarray]
    longest: dict[int, np.ndarray]


def survivors(root: Node, ranges: Ranges, query: np.ndarray, least: float, most: float) -> list[int]:
    """Leaves that may hold a row whose inner product with the query lies in ``[least, most]``."""
    own = float(query @ query)
    found: list[int] = []
    waiting: list[Node] = [root]
    while waiting:
        node = waiting.pop()
        to_points = np.sqrt(squared_distances(query[None, :], node.points)[0])
        # |q - x|^2 = |q|^2 + |x|^2 - 2 qx, with a margin for rounding.
        outer = own + ranges.longest[node.number] - 2 * least
        inner = np.sqrt(np.maximum(own + ranges.shortest[node.number] - 2 * most, 0)) * (1 - 1e-9)
        some = (outer >= 0) & (ranges.longest[node.number] >= 0)
        outer = np.sqrt(np.maximum(outer, 0)) * (1 + 1e-9) + 1e-6
        low, high = np.sqrt(ranges.low[node.number]), np.sqrt(ranges.high[node.number])
        far = low > to_points[:, None] + outer[None, :] + 1e-6
        near = high < np.maximum(to_points[:, None] - outer[None, :], inner[None, :] - to_points[:, None]) - 1e-6
        some &= ~(far | near).any(axis=0)
        for k, child in enumerate(node.below):
            if some[k]:
                if isinstance(child, Node):
                    waiting.append(child)
                else:
                    found.append(child)
    return found


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(len(column), dims).astype(np.float64)


def _scaler(dims: int, scale: int):
    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            whole = np.zeros((batch.num_rows, dims))
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            row = np.repeat(np.arange(batch.num_rows), lengths)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            whole[row, place] = np.floor(flat * scale)
            if len(whole) and squares(whole).max() >= 2.0**50:
                raise ValueError("a scaled vector is too long for exact scores")
            made = pa.array([v.tobytes() for v in whole.astype(np.int32)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), made], names=["vec_id", "label", "vector"])

    return scaled


def _placer(root: Node, dims: int):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = pa.array(leaf_of(root, _vectors(batch.column("vector"), dims)))
            names = [*batch.schema.names, "leaf"]
            yield pa.RecordBatch.from_arrays([*batch.columns, leaf], names=names)

    return place


def _ranger(root: Node, dims: int):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, int], tuple[int, int]] = {}

        def widen(key: tuple[int, int, int], values: np.ndarray) -> None:
            low, high = held.get(key, (2**62, -1))
            held[key] = min(low, int(values.min())), max(high, int(values.max()))

        for batch in batches:
            rows = _vectors(batch.column("vector"), dims)
            lengths = squares(rows)
            for node, reached, apart, nearest in descend(root, rows):
                for j in np.unique(nearest):
                    inside = nearest == j
                    widen((node.number, -1, int(j)), lengths[reached[inside]])
                    for i in range(len(node.points)):
                        widen((node.number, i, int(j)), apart[inside, i])
        columns = list(zip(*[(*key, *value) for key, value in held.items()])) or [()] * 5
        kinds = [pa.int32()] * 3 + [pa.int64()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["node", "i", "j", "low", "high"])

    return measure


def measured(rows: DataFrame, root: Node, dims: int) -> Ranges:
    """Ranges over all rows: a few numbers for each pair of siblings, whatever the table."""
    parts = mapped(rows.select("vector"), _ranger(root, dims), "node int, i int, j int, low long, high long")
    nodes = {n.number: len(n.points) for n in root.nodes()}
    made = Ranges(
        {n: np.full((k, k), 2.0**62) for n, k in nodes.items()}, {n: np.zeros((k, k)) for n, k in nodes.items()},
        {n: np.zeros(k) for n, k in nodes.items()}, {n: np.full(k, -1.0) for n, k in nodes.items()},
    )
    for r in parts.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        if r["i"] < 0:
            made.shortest[r["node"]][r["j"]], made.longest[r["node"]][r["j"]] = r["low"], r["high"]
        else:
            made.low[r["node"]][r["i"], r["j"]], made.high[r["node"]][r["i"], r["j"]] = r["low"], r["high"]
    return made


@dataclass(frozen=True)
class Grouping:
    """First group of each leaf and how many it has; only a leaf cut in several has groups of its own."""

    first: tuple[int, ...]
    cuts: tuple[int, ...]

    @staticmethod
    def of(counts: dict[int, int], leaves: int, groups: int = GROUPS, group_rows: int = GROUP_ROWS) -> Grouping:
        size = max(1, min(group_rows, -(-sum(counts.values()) // groups)))
        first, cuts, number, held = [], [], 0, 0
        for leaf in range(leaves):
            n = counts.get(leaf, 0)
            if n > size:
                number += held > 0
                first.append(number)
                cuts.append(-(-n // size))
                number, held = number + cuts[-1], 0
                continue
            if held + n > size:
                number, held = number + 1, 0
            first.append(number)
            cuts.append(1)
            held += n
        return Grouping(tuple(first), tuple(cuts))

    def needed(self, leaves: list[int]) -> dict[int, list[int]]:
        """Groups to visit, each with the leaves to look at there."""
        found: dict[int, list[int]] = {}
        for leaf in leaves:
            for group in range(self.first[leaf], self.first[leaf] + self.cuts[leaf]):
                found.setdefault(group, []).append(leaf)
        return found


# Rows and anchors of a group share a schema, so that they can be dealt and sorted together.
_ROUTED = "grp int, anchor long, id long, label long, leaf int, vector binary, leaves binary, extra binary"
_FOUND = "anchor long, anchor_id long, place int, positive_id long, positive_score long, id long, score long"


def _routed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) or [()] * len(kinds)
    names = [f.split()[0] for f in _ROUTED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _wanted(batch: pa.RecordBatch) -> Iterator[tuple[int, list[tuple[int | None, int]]]]:
    """Row numbers of anchors, with their positives if they have been found."""
    given = "best" in batch.schema.names
    for row, anchor in enumerate(batch.column("vec_id").to_pylist()):
        if not given:
            yield row, []
            continue
        best = [(b["id"], -b["order"]) for b in batch.column("best")[row].as_py()]
        own = float(squares(_vectors(batch.column("vector")[row : row + 1], -1))[0])
        if (anchor, own) in best:
            best.remove((anchor, int(own)))
        yield row, best[:POSITIVES]


def window(score: int) -> tuple[int, int]:
    """Least and largest score of a negative next to a positive of this score; empty where the first is larger."""
    return -(-LOW_PERCENT * score // 100), HIGH_PERCENT * score // 100


def _bound(scores: np.ndarray, places: int) -> int:
    """The score of the last place among those found so far."""
    return int(np.partition(scores, len(scores) - places)[len(scores) - places]) if len(scores) >= places else int(_NONE)


def _router(root: Node, ranges: Ranges, grouping: Grouping, sample: np.ndarray, labels: np.ndarray, dims: int):
    """For each anchor the groups it must visit, the leaves there, and its windows.

    ``extra`` holds, for each window, positive id, whether that is null,
    positive score, least and largest score.
    """

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _vectors(batch.column("vector"), dims)
            own_labels = batch.column("label").to_pylist()
            ids, raw, numbers = batch.column("vec_id").to_pylist(), batch.column("vector").to_pylist(), batch.column("anchor").to_pylist()
            made: list[tuple] = []
            searching_positives = "best" not in batch.schema.names
            for row, positives in _wanted(batch):
                scores = (sample @ vectors[row]).astype(np.int64)
                same = labels == own_labels[row]
                if searching_positives:
                    windows = [(0, 1, 0, _bound(scores[same], POSITIVES + 1), 2**62)]
                else:
                    windows = []
                    for positive, score in positives:
                        low, high = window(score)
                        inside = scores[~same & (scores >= low) & (scores <= high)]
                        if low <= high:
                            windows.append((positive or 0, int(positive is None), score, max(low, _bound(inside, NEGATIVES)), high))
                if not windows:
                    continue
                extra = np.array(windows, np.int64).tobytes()
                least, most = float(min(w[3] for w in windows)), float(max(w[4] for w in windows))
                for group, leaves in grouping.needed(survivors(root, ranges, vectors[row], least, most)).items():
                    made.append((group, numbers[row], ids[row], own_labels[row], -1, raw[row], np.array(leaves, np.int32).tobytes(), extra))
                if len(made) > 1000:
                    yield _routed(made)
                    made = []
            if made:
                yield _routed(made)

    return route


class _Group:
    """Rows of one group, sorted by id with null last, and the search among them."""

    def __init__(self, batches: list[pa.RecordBatch], dims: int) -> None:
        held = pa.Table.from_batches(batches)
        null = held["id"].is_null().to_numpy()
        ids = held["id"].fill_null(0).to_numpy()
        by_id = np.lexsort((ids, null))
        self.ids, self.null = ids[by_id], null[by_id]
        self.labels = held["label"].to_numpy()[by_id]
        self.leaves = held["leaf"].to_numpy()[by_id]
        vectors = np.frombuffer(b"".join(held["vector"].to_pylist()), np.int32).reshape(len(ids), dims)[by_id]
        self.longest = float(squares(vectors.astype(np.float64)).max(initial=0))
        self.vectors = vectors.astype(np.float32 if self.longest < 2**24 else np.float64)

    def search(self, batch: pa.RecordBatch, dims: int, same: bool, places: int) -> list[tuple]:
        """The best rows of each window, of the anchor's own label or of others."""
        queries = np.frombuffer(b"".join(batch.column("vector").to_pylist()), np.int32).reshape(batch.num_rows, dims).astype(np.float64)
        exact = self.longest * float(squares(queries).max(initial=0)) < 2.0**48
        kind = np.float32 if exact and self.vectors.dtype == np.float32 else np.float64
        wanted = [np.frombuffer(b, np.int32) for b in batch.column("leaves").to_pylist()]
        inside = np.isin(self.leaves, np.unique(np.concatenate(wanted)))
        rows = np.flatnonzero(inside)
        vectors = self.vectors if inside.all() else self.vectors[rows]
        scores = queries.astype(kind) @ vectors.astype(kind, copy=False).T
        found = []
        for row, (number, anchor, label) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("anchor", "id", "label")))):
            fits = (self.labels[rows] == label) == same
            for place, (positive, is_null, score, low, high) in enumerate(np.frombuffer(batch.column("extra")[row].as_py(), np.int64).reshape(-1, 5).tolist()):
                held = np.flatnonzero(fits & (scores[row] >= low) & (scores[row] <= high))
                if len(held) > places:
                    values = scores[row][held]
                    last = np.partition(values, len(values) - places)[len(values) - places]
                    above = held[values > last]
                    # Rows are in order of id, so the first of those that tie are the ones to keep.
                    held = np.concatenate([above, held[values == last][: places - len(above)]])
                found += [
                    (number, anchor, place, None if is_null else positive, score, None if self.null[rows[h]] else int(self.ids[rows[h]]), int(scores[row, h]))
                    for h in held
                ]
        return found


def _searcher(dims: int, same: bool, places: int):
    """Rows of a group come first, then the anchors that visit it."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = [f.split()[0] for f in _FOUND.split(", ")]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, held = None, [], None
        for batch in batches:
            groups, is_row = batch.column("grp").to_numpy(), batch.column("anchor").is_null().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((groups[1:] != groups[:-1]) | (is_row[1:] != is_row[:-1])) + 1
            for start, end in zip([0, *edges], [*edges, batch.num_rows]):
                part = batch.slice(int(start), int(end - start))
                if groups[start] != group:
                    group, rows, held = groups[start], [], None
                if is_row[start]:
                    rows.append(part)
                    continue
                if not rows and held is None:
                    continue  # a group without rows
                if held is None:
                    held, rows = _Group(rows, dims), []
                for first in range(0, part.num_rows, ANCHORS_AT_ONCE):
                    found = held.search(part.slice(first, ANCHORS_AT_ONCE), dims, same, places)
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

    return search


def _searched(rows: DataFrame, routed: DataFrame, groups: int, dims: int, same: bool, places: int) -> DataFrame:
    """The best places of each window over all groups."""
    dealt = rows.unionByName(routed).repartition(groups, "grp").sortWithinPartitions("grp", F.col("anchor").asc_nulls_first())
    found, _ = settle(mapped(dealt, _searcher(dims, same, places), _FOUND))
    best = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= places)


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(embeddings: DataFrame, scale: int = SCALE, every: int = 100) -> DataFrame:
    """Negatives of each anchor and positive; anchors are rows whose vec_id ``every`` divides.

    ``embeddings`` has ``vec_id``, ``label`` and ``embedding``.
    """
    spark = embeddings.sparkSession
    used = embeddings.select("vec_id", F.col("label").cast("long").alias("label"), "embedding")
    used = used.where(F.col("label").isNotNull() & usable(F.col("embedding")))
    dims = used.agg(F.max(F.size("embedding"))).first()[0]
    if dims is None:
        return spark.createDataFrame([], _RESULT)
    dims = max(dims, 1)
    made, _ = settle(mapped(used, _scaler(dims, scale), "vec_id long, label long, vector binary"))
    drawn = made.orderBy(F.xxhash64("vector", "vec_id")).limit(SAMPLE_ROWS).select("vector", "label").collect()
    sample = np.stack([np.frombuffer(r["vector"], np.int32) for r in drawn]).astype(np.float64)
    labels = np.array([r["label"] for r in drawn])
    root = grow(np.unique(sample, axis=0))
    placed, _ = settle(mapped(made, _placer(root, dims), "vec_id long, label long, vector binary, leaf int"))
    ranges = measured(placed, root, dims)
    counts = {r["leaf"]: r["n"] for r in placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    grouping = Grouping.of(counts, len(root.leaves()))
    groups = max(f + c for f, c in zip(grouping.first, grouping.cuts))

    first, cuts = (F.array(*[F.lit(x) for x in xs])[F.col("leaf")] for xs in (grouping.first, grouping.cuts))
    cut = F.pmod(F.xxhash64("file", "at"), cuts).cast("int")
    absent = [F.lit(None).cast(kind).alias(name) for name, kind in (("leaves", "binary"), ("extra", "binary"))]
    rows = numbered(placed, "vec_id", "label", "vector", "leaf").select(
        (first + cut).alias("grp"), F.lit(None).cast("long").alias("anchor"), F.col("vec_id").alias("id"), "label", "leaf", "vector", *absent
    )
    asked = made.where(F.col("vec_id") % every == 0).withColumn("anchor", F.monotonically_increasing_id())
    anchors, _ = settle(asked)
    route = _router(root, ranges, grouping, sample, labels, dims)
    own = _searched(rows, mapped(anchors, route, _ROUTED), groups, dims, True, POSITIVES + 1)
    # Scores in ascending order of their negative; null ids are last among ties.
    order = F.struct((-F.col("score")).alias("order"), F.col("id").isNull().alias("null"), "id")
    best = own.groupBy(F.col("anchor").alias("__anchor")).agg(F.sort_array(F.collect_list(order)).alias("best"))
    ready, _ = settle(anchors.join(best, F.col("anchor") == F.col("__anchor")).select("anchor", "vec_id", "label", "vector", "best"))
    other = _searched(rows, mapped(ready, route, _ROUTED), groups, dims, False, NEGATIVES)
    return other.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives over all embeddings, with every seventh label moved on by one."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved))


OP11_SQL = f"""
WITH used AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
    FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
    SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id, b.r, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM used AS a, used AS b WHERE a.vec_id % 100 = 0 AND a.r <> b.r
), positives AS (
    SELECT anchor, anchor_id, vec_id AS positive_id, r AS positive, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT p.anchor_id, positive_id, (row_number() OVER (PARTITION BY p.anchor, positive ORDER BY score DESC, vec_id))::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives AS p JOIN scored AS s ON p.anchor = s.anchor AND NOT same
    AND {LOW_PERCENT} * positive_score <= 100 * score AND 100 * score <= {HIGH_PERCENT} * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor, positive ORDER BY score DESC, vec_id) <= {NEGATIVES}
"""

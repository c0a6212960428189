"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersections.

Two texts link when their sets of word shingles are similar enough. Nothing is
approximate: each step only leaves out pairs that cannot link.

1. Equal sets become one class, so copies of a text cost one member.
2. Similar sets have similar sizes and differ in at most ``d`` shingles, a bound
   that the size band gives. A band cuts the space of hashes into ``d + m``
   parts, so linked sets agree on ``m`` whole parts at least. A digest of each
   part is a key; sets that share no key cannot link. Sets that straddle the
   edge of two bands meet under a scheme made for that edge. Shingles that a
   sample finds common stay out of the parts, so a passage that many texts share
   does not make them meet; they count in sizes and similarities as all others.
   Keys are counted alone first, packed into four bytes and the number of the
   part that counts them. Only of shared keys is it asked whose they are, by
   reading the texts once more: no table holds all keys.
3. Keys that two classes share tie them into candidate groups. Only classes in
   such a group are read again, each once. A group is cut into tiles of bounded
   size: by size band, then by salt, and blocks of neighbouring bands meet in
   pairs, so a group of any size spreads over many tasks. Where chance ties many
   different texts into one group, its members would travel to ever more tiles;
   they then meet by shared key, each key that the same members share but once.
   Of both ways a group takes the one that moves less.
4. In a tile, hashed bitmaps bound the overlap from above: a bit that only one
   set has proves a shingle that the other lacks. What passes is intersected
   exactly on sorted arrays. Sets already tied together are not compared again,
   and a tile returns at most one link per member.
5. Links become components.

Defined cases: a null or empty text, or one without words, has no shingles, its
own class and links with nothing. With fewer words than the width the whole
sequence is one shingle. Rows may repeat, a null doc_id is never a component's
name unless no member has another, and other columns of the table are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm.common import components, key_bitmap, mapped, numbered, small_batches, table, without_rows
from layerkit.llm.shingles import mix, shingle_sets
from layerkit.operators.rowid import in_place
from layerkit.session import relieve
from layerkit.sources.scratch import settle

# A tile's members weigh their shingles, 128 at least: 4,096 members or 4 MB of hashes.
TILE_WEIGHT = 1 << 19
MEMBER_WEIGHT = 128
BATCH_KEYS = 1 << 18
# Keys are counted in parts of about a million, 64 parts at least: with four bytes more a key counts
# as shared by chance once in some thousands, and is then found to have one owner.
PART_KEYS = 1 << 20
KEYS_A_TEXT = 256
LEAST_PARTS, MOST_PARTS = 1 << 6, 1 << 16
# What the second bit of a shared key drops of it.
_SECOND = 10
# A passage in about one text of 3,000 or more counts as common.
SAMPLE_TEXTS = 10_000
COMMON_TEXTS = 3
# At most 4 MB reach the driver and the tasks.
COMMON_SHINGLES = 1 << 19
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Similarity:
    """Sets link when ``intersection / union >= numerator / denominator``."""

    width: int = 5
    numerator: int = 8
    denominator: int = 10

    @property
    def ratio(self) -> float:
        return self.numerator / self.denominator

    def links(self, common: int, left: int, right: int) -> bool:
        return self.denominator * common >= self.numerator * (left + right - common)

    def differ(self, total: int) -> int:
        """Most shingles that only one of two linked sets holds, given both sizes' sum."""
        return total * (self.denominator - self.numerator) // (self.denominator + self.numerator)


@lru_cache(maxsize=4096)
def _parts(differ: int, smallest: int) -> tuple[int, int]:
    """Parts of a scheme, and how many of them linked sets share at least.

    Empty parts say nothing, so they give no key unless a set has as many as
    the shared ones. The margin makes that rare in the smallest sets.
    """
    shared = 2
    for _ in range(8):
        parts = differ + shared
        empty = parts * math.exp(-smallest / parts)
        shared = 1 + math.ceil(empty + 4 * math.sqrt(empty))
    return differ + shared, shared


@lru_cache(maxsize=65536)
def schemes(size: int, rule: Similarity) -> tuple[tuple[int, int, int], ...]:
    """``(scheme, parts, shared)`` under which a set of this size gets keys.

    Bands grow by half, or faster for low similarities, so linked sets are in
    one band or in two neighbours.
    """
    growth = max(1.5, 1.2 / rule.ratio)
    band, low, high = 0, 1, 2
    while high <= size:
        band, low, high = band + 1, high, int(high * growth) + 1
    found = []
    most = high - 1
    if differ := rule.differ(2 * most):
        found.append((2 * band, *_parts(differ, low)))
    for name, edge in ((2 * band - 1, low), (2 * band + 1, high)):
        below = edge - 1  # the largest size under the edge
        above = below * rule.denominator // rule.numerator
        least = -(-edge * rule.numerator // rule.denominator)
        if band + (edge == high) and least <= size <= above and (differ := rule.differ(below + above)):
            found.append((name, *_parts(differ, least)))
    return tuple(found)


@lru_cache(maxsize=4096)
def _bounds(parts: int) -> np.ndarray:
    return np.array([(i << 64) // parts for i in range(1, parts)], dtype=np.uint64)


def _part_keys(found: np.ndarray, parts: int, tag: int) -> tuple[np.ndarray, np.ndarray]:
    """A digest of each part of a sorted set, and which parts hold anything."""
    sums = np.zeros(len(found) + 1, np.uint64)
    np.cumsum(mix(found * _STEP), out=sums[1:])
    edges = np.empty(parts + 1, np.int64)
    edges[0], edges[-1] = 0, len(found)
    edges[1:-1] = np.searchsorted(found, _bounds(parts))
    place = np.arange(parts, dtype=np.uint64) + np.uint64(tag << 40)
    return mix(sums[edges[1:]] - sums[edges[:-1]] + mix(place * _STEP)), edges[1:] > edges[:-1]


def set_keys(found: np.ndarray, rule: Similarity, common: np.ndarray = np.zeros(0, np.uint64)) -> np.ndarray:
    """Keys of a sorted set: a digest of each part, under each scheme of its size.

    ``common`` lists shingles, sorted, that parts leave out. Linked sets still
    differ in ``d`` of the others at most, so they agree on as many parts, and
    texts that share but a passage no longer meet. A set that this leaves with
    too many empty parts also gets the keys of its whole parts, and so does
    whatever links with it and meets it in empty parts alone.
    """
    rare = found
    if len(common) and len(found):
        at = np.searchsorted(common, found)
        at[at == len(common)] = 0
        rare = found[common[at] != found]
    keys = []
    for scheme, parts, shared in schemes(len(found), rule):
        digest, filled = _part_keys(rare, parts, 2 * scheme)
        keys.append(digest[filled])
        if parts - np.count_nonzero(filled) >= shared:
            digest, filled = _part_keys(found, parts, 2 * scheme + 1)
            keys.append(digest if parts - np.count_nonzero(filled) >= shared else digest[filled])
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def _digest(found: np.ndarray) -> int:
    return int(mix(mix(found ^ _STEP).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(found)))[0].astype(np.int64))


def _listed(width: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, found in shingle_sets(batch.column("text"), width):
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["shingle"])

    return read


def common_shingles(rows: DataFrame, width: int) -> np.ndarray:
    """Shingles that several of about ``SAMPLE_TEXTS`` texts hold, sorted.

    They only steer which keys are made: any list gives the same links. Long texts
    may hold any number, so the ``COMMON_SHINGLES`` most frequent are taken.
    """
    total = rows.count()
    draw = F.pmod(F.xxhash64("file", "at"), F.lit(1_000_000)) < 1_000_000 * min(1.0, SAMPLE_TEXTS / max(1, total))
    counted = mapped(rows.where(draw).select("text"), _listed(width), "shingle long").groupBy("shingle").count()
    held = counted.where(F.col("count") >= COMMON_TEXTS).orderBy(F.desc("count"), "shingle").limit(COMMON_SHINGLES)
    found = held.select("shingle").toArrow().column(0).to_numpy()
    return np.sort(found.view(np.uint64))


def _signer(width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids = [], []
            for _, found in shingle_sets(batch.column("text"), width):
                sizes.append(len(found))
                ids.append(_digest(found))
            same = [batch.column(c) for c in ("file", "at", "doc_id")]
            yield pa.RecordBatch.from_arrays(
                [*same, pa.array(sizes, pa.int64()), pa.array(ids, pa.int64())], names=["file", "at", "doc_id", "size", "id"]
            )

    return sign


def _hits(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.int64(8 * len(bits) - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def count_parts(classes: int) -> int:
    """In how many parts the keys of so many texts are counted: a power of two."""
    return min(MOST_PARTS, max(LEAST_PARTS, 1 << (classes * KEYS_A_TEXT // PART_KEYS).bit_length()))


def packed_keys(keys: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    """Keys by part, four bytes each; more than two of a kind say no more than two."""
    shift = np.uint64(parts.bit_length() - 1)
    rest = (keys >> shift) & np.uint64(0xFFFFFFFF)
    placed = np.sort(((keys & np.uint64(parts - 1)) << np.uint64(32)) | rest)
    keep = np.ones(len(placed), bool)
    keep[2:] = placed[2:] != placed[:-2]
    placed = placed[keep]
    edges = np.searchsorted(placed, np.arange(parts + 1, dtype=np.uint64) << np.uint64(32))
    low = placed.astype(np.uint32)
    for part in np.flatnonzero(edges[1:] > edges[:-1]):
        yield int(part), low[edges[part] : edges[part + 1]].tobytes()


def repeated_keys(part: int, packed: list[bytes], parts: int) -> np.ndarray:
    """Keys of a part that come twice or more, cut to the bits that were packed."""
    rest = np.sort(np.concatenate([np.frombuffer(p, np.uint32) for p in packed]))
    found = np.unique(rest[1:][rest[1:] == rest[:-1]]).astype(np.int64)
    return found << np.int64(parts.bit_length() - 1) | np.int64(part)


def _repeated(parts: int):
    def find(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"key": repeated_keys(int(rows["part"].iloc[0]), list(rows["keys"]), parts)})

    return find


def _made_keys(batches: Iterator[pa.RecordBatch], marks: bytes, rule: Similarity, common: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``(id, keys)`` of the rows that perhaps stand for a class."""
    rows = np.frombuffer(marks, np.uint8)
    for batch in batches:
        batch = batch.filter(pa.array(_hits(rows, batch.column("mark").to_numpy())))
        for _, found in shingle_sets(batch.column("text"), rule.width):
            yield _digest(found), set_keys(found, rule, common)


def _packer(marks: bytes, rule: Similarity, common: np.ndarray, parts: int):
    """Rows ``(part, keys)`` with the keys of all classes."""
    def batch_of(keys: list[np.ndarray]) -> pa.RecordBatch:
        rows = list(packed_keys(np.concatenate(keys), parts))
        return pa.RecordBatch.from_arrays(
            [pa.array([part for part, _ in rows], pa.int32()), pa.array([packed for _, packed in rows], pa.binary())], names=["part", "keys"]
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, waiting = [], 0
        for _, made in _made_keys(batches, marks, rule, common):
            keys.append(made)
            waiting += len(made)
            if waiting >= PART_KEYS:
                yield batch_of(keys)
                keys, waiting = [], 0
        if waiting:
            yield batch_of(keys)

    return read


def _owners(marks: bytes, rule: Similarity, common: np.ndarray, shared: bytes, parts: int):
    """Rows ``(id, key)`` of the keys that are perhaps shared."""
    def batch_of(ids: list[np.ndarray], keys: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(keys))], names=["id", "key"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(shared, np.uint8)
        packed = np.int64((parts << 32) - 1)
        ids, keys, waiting = [], [], 0
        for name, made in _made_keys(batches, marks, rule, common):
            made = made.view(np.int64)
            cut = made & packed
            made = made[_hits(held, cut) & _hits(held, cut >> np.int64(_SECOND))]
            keys.append(made)
            ids.append(np.full(len(made), name, np.int64))
            waiting += len(made)
            if waiting >= BATCH_KEYS:
                yield batch_of(ids, keys)
                ids, keys, waiting = [], [], 0
        if waiting:
            yield batch_of(ids, keys)

    return read


def _sets(bits: bytes, width: int):
    """Sets of the rows that are perhaps wanted, as sorted 64-bit integers."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(bits, np.uint8)
        for batch in batches:
            batch = batch.filter(pa.array(_hits(held, batch.column("mark").to_numpy())))
            sets = [found.tobytes() for _, found in shingle_sets(batch.column("text"), width)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("at"), pa.array(sets, pa.binary())], names=["file", "at", "hashes"]
            )

    return read


def _common(left: np.ndarray, right: np.ndarray) -> int:
    if len(left) > len(right):
        left, right = right, left
    at = np.searchsorted(right, left)
    at[at == len(right)] = 0
    return int(np.count_nonzero(right[at] == left))


def tile_links(ids: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], rule: Similarity) -> list[tuple[int, int]]:
    """Links that tie a tile's members together, one fewer than members at most.

    Side 2 marks members of a block that meet each other; sides 0 and 1 mark two
    blocks whose members meet across only.
    """
    order = sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i]))
    ids, sides, sets = ids[order], sides[order], [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets])
    # By the mean, so a long set among many short ones does not widen all rows.
    width = 1 << min(20, max(10, int(8 * sizes.mean() - 1).bit_length()))
    bits = np.zeros((len(ids), width // 64), np.uint64)
    for row, found in enumerate(sets):
        flags = np.zeros(width, np.uint8)
        flags[found & np.uint64(width - 1)] = 1
        bits[row] = np.packbits(flags).view(np.uint64)
    label, links = np.arange(len(ids)), []
    step = max(1, (1 << 18) // (width // 64))
    for row in range(len(ids) - 1):
        last = int(np.searchsorted(sizes, sizes[row] * rule.denominator // rule.numerator, "right"))
        for first in range(row + 1, last, step):
            others = np.arange(first, min(last, first + step))
            meets = (sides[others] == 2) if sides[row] == 2 else (sides[others] != sides[row])
            others = others[meets & (label[others] != label[row])]
            if not len(others):
                continue
            mine = np.bitwise_count(bits[row] & ~bits[others]).sum(axis=1, dtype=np.int64)
            theirs = np.bitwise_count(~bits[row] & bits[others]).sum(axis=1, dtype=np.int64)
            bound = np.minimum(sizes[row] - mine, sizes[others] - theirs)
            total = sizes[row] + sizes[others]
            for other in others[(rule.numerator + rule.denominator) * bound >= rule.numerator * total]:
                if label[other] != label[row] and rule.links(_common(sets[row], sets[other]), sizes[row], sizes[other]):
                    links.append((int(ids[row]), int(ids[other])))
                    label[label == label[other]] = label[row]
    return links


def _linker(rule: Similarity):
    def link(tile: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(h, np.uint64) for h in tile["hashes"]]
        found = tile_links(tile["id"].to_numpy(), tile["side"].to_numpy(), sets, rule)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return link


def _weight() -> Column:
    return F.greatest("size", F.lit(MEMBER_WEIGHT))


def _by_key(wanted: DataFrame, members: DataFrame, rule: Similarity) -> DataFrame | None:
    """``(id, key)`` of members whose groups move less if they meet by key; None if no group does.

    Every pair that can link shares a key, so no link is lost. Keys with the
    same members are one, told by the 64-bit hashes of these.
    """
    heavy = wanted.groupBy("root").agg(F.sum(_weight()).alias("whole")).where(F.col("whole") > TILE_WEIGHT)
    heavy, some = settle(heavy.select("root"))
    if not some:
        return None
    inside, _ = settle(wanted.join(heavy, "root", "left_semi").select("id", "size", "root"))
    keyed, _ = settle(members.join(inside, "id").select("id", "key", "root", _weight().alias("weight")).distinct())
    keys = keyed.groupBy("root", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high"),
        F.bit_xor(F.xxhash64("id")).alias("who"), F.sum("weight").alias("weight"),
    )
    keys, _ = settle(keys.where("n > 1").groupBy("root", "n", "low", "high", "who").agg(F.min("key").alias("key"), F.first("weight").alias("weight")))
    # Weight times the tiles it travels to; a heavy key is cut into salts itself, about two for each tile it fills.
    salts = F.when(F.col("weight") <= TILE_WEIGHT, 1).otherwise(F.ceil(F.col("weight") * 2 / TILE_WEIGHT))
    keyed_cost = keys.groupBy("root").agg(F.sum(F.col("weight") * salts).alias("keyed"))
    tiles = _tiles(inside, rule).join(inside.select("id", "size"), "id")
    tiled_cost = tiles.groupBy("root").agg(F.sum(_weight()).alias("tiled"))
    chosen, some = settle(tiled_cost.join(keyed_cost, "root").where("keyed < tiled").select("root"))
    if not some:
        return None
    return keyed.join(keys.join(chosen, "root", "left_semi").select("root", "key"), ["root", "key"], "left_semi").select("id", "key", "root")


def _tiles(members: DataFrame, rule: Similarity) -> DataFrame:
    """``(id, ..., root, tile, side)``: the tiles in which each member of a group meets others.

    ``members`` has one row ``(id, size, root)`` per class and group, with any further columns.
    """
    kept = [c for c in members.columns if c != "size"]
    weight = _weight()
    # A little wider than the similarity, so rounding cannot part neighbours.
    band = F.floor(F.log("size") / math.log(1 / (rule.ratio - 0.01))).cast("int")
    members = members.withColumn("band", band)
    bands = members.groupBy("root", "band").agg(F.sum(weight).alias("weight"))
    bands = bands.withColumn("salts", F.ceil(F.col("weight") * 2 / TILE_WEIGHT).cast("int"))
    whole = bands.groupBy("root").agg(F.sum("weight").alias("whole"))
    near = [
        bands.select("root", (F.col("band") - by).alias("band"), F.col("salts").alias(name))
        for name, by in (("above", 1), ("below", -1))
    ]
    shape = bands.join(whole, "root").join(near[0], ["root", "band"], "left").join(near[1], ["root", "band"], "left")
    placed = members.join(shape, ["root", "band"]).withColumn("salt", F.pmod("id", F.col("salts")).cast("int"))

    def meet(count: Column, low: Column, place) -> Column:
        every = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(every, lambda other: F.struct(low.alias("band"), *place(other)))

    salt = F.col("salt")
    own = meet(
        F.col("salts"),
        F.col("band"),
        lambda other: (
            F.lit(0).alias("across"),
            F.least(salt, other).alias("first"),
            F.greatest(salt, other).alias("second"),
            F.when(salt == other, 2).when(salt < other, 0).otherwise(1).alias("side"),
        ),
    )
    up = meet(
        F.coalesce("above", F.lit(0)),
        F.col("band"),
        lambda other: (F.lit(1).alias("across"), salt.alias("first"), other.alias("second"), F.lit(0).alias("side")),
    )
    down = meet(
        F.coalesce("below", F.lit(0)),
        F.col("band") - 1,
        lambda other: (F.lit(1).alias("across"), other.alias("first"), salt.alias("second"), F.lit(1).alias("side")),
    )
    zero = F.lit(0)
    single = F.array(F.struct(zero.alias("band"), zero.alias("across"), zero.alias("first"), zero.alias("second"), F.lit(2).alias("side")))
    tiles = F.when(F.col("whole") <= TILE_WEIGHT, single).otherwise(F.concat(own, up, down))
    return placed.select(*kept, F.inline(tiles))


def similar_classes(docs: DataFrame, rule: Similarity) -> DataFrame:
    """One row ``(file, at, doc_id, n_shingles, class_id, root, component_id)`` per row of ``docs``.

    ``class_id`` names equal sets and ``root`` the classes that links tie
    together. ``component_id`` is the smallest doc_id among them.
    """
    with small_batches(docs.sparkSession):
        return _similar_classes(in_place(docs), rule)


def _similar_classes(docs: DataFrame, rule: Similarity) -> DataFrame:
    rows = numbered(docs, "doc_id", "text")
    signed, _ = settle(mapped(rows, _signer(rule.width), "file long, at long, doc_id long, size long, id long"))
    counted = signed.where("size > 0").groupBy("id", "size").agg(
        F.min("doc_id").alias("least"), F.min(F.struct("file", "at")).alias("row")
    )
    classes, number = settle(counted)

    # A copy that passes the bitmap makes its class meet itself, which ties nothing.
    mark = F.xxhash64("file", "at").alias("mark")
    marks = key_bitmap(classes.select(F.xxhash64("row.file", "row.at").alias("mark")), "mark", number)
    common = common_shingles(rows, rule.width)
    texts = rows.select("file", "at", mark, "text")
    parts = count_parts(number)
    packed = mapped(texts.select("mark", "text"), _packer(marks, rule, common, parts), "part int, keys binary")
    shared, some = settle(packed.groupBy("part").applyInPandas(_repeated(parts), "key long"))
    relieve(docs.sparkSession, always=True)
    both = shared.select(F.explode(F.array("key", F.shiftright("key", _SECOND))).alias("key"))
    owners = _owners(marks, rule, common, key_bitmap(both, "key", some), parts)
    members, _ = settle(mapped(texts.select("mark", "text"), owners, "id long, key long"))
    ends = members.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high")
    near = members.join(ends, "key").select(F.col("id").alias("a"), F.col("low").alias("b"))
    groups = components(near).select(F.col("node").alias("id"), "root")

    wanted, some = settle(classes.join(groups, "id").select("id", "size", "root", "row.file", "row.at"))
    grouped = wanted
    if (keyed := _by_key(wanted, members, rule)) is not None:
        chosen = keyed.select("root").distinct()
        by_key = keyed.select("id", "key").join(wanted.drop("root"), "id").withColumnRenamed("key", "root")
        grouped = wanted.join(chosen, "root", "left_anti").unionByName(by_key)
    placed, _ = settle(_tiles(grouped, rule))
    relieve(docs.sparkSession, always=True)
    bits = key_bitmap(wanted.select(mark), "mark", some)
    read = mapped(texts, _sets(bits, rule.width), "file long, at long, hashes binary")
    links = read.join(placed, ["file", "at"]).drop("file", "at")
    links = links.groupBy("root", "band", "across", "first", "second").applyInPandas(_linker(rule), "a long, b long")
    tied = components(links).select(F.col("node").alias("id"), "root")
    relieve(docs.sparkSession, always=True)

    named = classes.select("id", "least").join(tied, "id", "left").withColumn("root", F.coalesce("root", "id"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(names, "root").select("id", "root", "component_id")
    alone = F.when(F.col("size") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        signed.join(named, "id", "left")
        .select("file", "at", "doc_id", F.col("size").alias("n_shingles"), F.col("id").alias("class_id"), "root", alone.alias("component_id"))
    )


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents that share nine tenths of their three-word shingles."""
    rule = Similarity(width=3, numerator=90, denominator=100)
    return similar_classes(table(spark, sf_dir, "documents"), rule).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, rule: Similarity = Similarity()) -> DataFrame:
    """``docs``, from any plan, with the first row, by doc_id and then position, of each component.

    Texts without words are nobody's copies, and all stay.
    """
    docs = in_place(docs)
    found = similar_classes(docs, rule)
    found, _ = settle(found)
    real = found.where("n_shingles > 0")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "file", "at")
    first = real.groupBy("root").agg(F.min(order).alias("first"))
    later = real.join(first, "root").where((F.col("first.file") != F.col("file")) | (F.col("first.at") != F.col("at")))
    return without_rows(docs, later.select("file", "at"))

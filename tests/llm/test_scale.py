"""Plans at sizes that small tables do not reach: full bitmaps, reused filters, the curve's order."""

from itertools import product

import brute
import numpy as np
import pytest

from layerkit.llm import common, exact_dedup, jaccard, sharding

DOCS = "doc_id long, text string"


def near_copies(count, seed=5):
    draw = np.random.default_rng(seed)
    base, rows = [f"w{i}" for i in range(200)], []
    for doc_id in range(count):
        words = list(base) if doc_id % 3 else [f"v{doc_id % 40}x{i}" for i in range(150)]
        for at in draw.integers(0, len(words), doc_id % 4):
            words[at] = f"n{doc_id}"
        rows.append((doc_id, " ".join(words)))
    return rows


def test_bits_grow_with_the_keys():
    assert common.bitmap_bits(0) == common.bitmap_bits(100) == common.LEAST_BITS
    for keys in (10_000, 1_000_000, 33_000_000):
        assert 8 <= common.bitmap_bits(keys) / keys < 17
    assert common.bitmap_bits(10**11) == common.MOST_BITS


def test_bitmaps_hold_every_key(spark):
    keys = spark.range(50_000).select(common.F.xxhash64("id").alias("k"))
    bits = common.key_bitmap(keys, "k", 50_000)
    held = np.array([r["k"] for r in keys.collect()])
    assert jaccard._hits(np.frombuffer(bits, np.uint8), held).all()
    others = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 100_000)
    assert jaccard._hits(np.frombuffer(bits, np.uint8), others).mean() < 0.13


@pytest.mark.parametrize("most", [1 << 15, 1 << 28])
def test_a_full_bitmap_gives_the_same_links(spark, folder, monkeypatch, most):
    """With far fewer bits than keys nearly everything passes, and is then joined exactly."""
    monkeypatch.setattr(common, "MOST_BITS", most)
    monkeypatch.setattr(common, "KEY_BITS", 8 if most > 1 << 15 else 1)
    rows = near_copies(150)
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/docs")
    docs = spark.read.parquet(f"{folder}/docs")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_classes(docs, jaccard.Similarity(3, 90, 100)).collect()}
    assert found == brute.components(rows, 3, 90, 100)


def test_any_number_of_common_shingles_gives_the_same_links(spark, folder, monkeypatch):
    rows = near_copies(120, 6)
    spark.createDataFrame(rows, DOCS).repartition(2).write.parquet(f"{folder}/docs")
    docs = spark.read.parquet(f"{folder}/docs")
    for most in (0, 7, 1 << 19):
        monkeypatch.setattr(jaccard, "COMMON_SHINGLES", most)
        found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_classes(docs, jaccard.Similarity()).collect()}
        assert found == brute.components(rows, 5, 8, 10)


def test_later_batches_are_screened_by_the_stored_filters(spark, folder, monkeypatch):
    """A snapshot is written once; batch after batch meets its filters and buckets, and none is built again."""
    texts = [(i, f"Text {i % 70}") for i in range(200)]
    spark.createDataFrame(texts, DOCS).repartition(2).write.parquet(f"{folder}/old")
    snapshot = exact_dedup.Snapshot.build(spark.read.parquet(f"{folder}/old"), f"{folder}/snapshot")
    monkeypatch.setattr(exact_dedup.FuseFilter, "build", classmethod(lambda *_: 1 / 0))
    for number, batch in enumerate(([(1000, "text 3"), (1001, "new one"), (1002, "NEW ONE"), (1003, None)], [(2000, "TEXT 69"), (2001, "new one"), (2002, "")])):
        spark.createDataFrame(batch, DOCS).write.parquet(f"{folder}/new{number}")
        opened = exact_dedup.Snapshot.open(spark, f"{folder}/snapshot")
        found = {r["doc_id"]: (r["known"], r["keep_id"]) for r in opened.incoming(spark.read.parquet(f"{folder}/new{number}")).collect()}
        old = {brute.lower(t): d for d, t in texts}
        own = {}
        for d, t in batch:
            own[brute.lower(t)] = max(d, own.get(brute.lower(t), d))
        assert found == {d: (brute.lower(t) in old, old.get(brute.lower(t), own[brute.lower(t)])) for d, t in batch}
    assert snapshot.buckets == opened.buckets


def test_the_curve_visits_each_cell_once_and_moves_by_one(spark):
    bits, dims = 3, 3
    cells = spark.createDataFrame(list(product(range(1 << bits), repeat=dims)), ", ".join(f"c{i} int" for i in range(dims)))
    index = sharding.hilbert_index([common.F.col(f"c{i}") for i in range(dims)], bits)
    rows = sorted((r["i"], tuple(r[f"c{k}"] for k in range(dims))) for r in cells.withColumn("i", index).collect())
    assert [i for i, _ in rows] == list(range(1 << (bits * dims)))
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for (_, p), (_, q) in zip(rows, rows[1:]))


def test_boxes_bound_their_shards_and_prune(spark):
    """A shard's box is that of its rows, and a query on two dimensions leaves most shards out."""
    rows = spark.range(20_000).select("id", (common.F.xxhash64("id") % 32).alias("a"), (common.F.xxhash64("id", common.F.lit(1)) % 32).alias("b"))
    cells = {"x": common.F.abs("a").cast("int"), "y": common.F.abs("b").cast("int")}
    placed, _ = common.settle(sharding.sharded(rows, cells, ["id"], 32))
    boxes = {r["shard"]: r for r in sharding.shard_boxes(placed, ["x", "y"]).collect()}
    held = {}
    for r in placed.collect():
        held.setdefault(r["shard"], []).append((r["x"], r["y"]))
    assert sorted(boxes) == list(range(32))
    for shard, points in held.items():
        xs, ys = zip(*points)
        box = boxes[shard]
        assert (box["low_x"], box["high_x"], box["low_y"], box["high_y"], box["rows"]) == (min(xs), max(xs), min(ys), max(ys), len(points))
    wanted = [s for s, b in boxes.items() if b["low_x"] <= 5 <= b["high_x"] and b["low_y"] <= 20 <= b["high_y"]]
    assert any((5, 20) in points for points in held.values()) and len(wanted) <= 4


def test_packed_keys_find_all_that_come_twice():
    draw = np.random.default_rng(3)
    once = draw.integers(0, 2**63, 6_000).astype(np.uint64)
    keys = np.concatenate([once, once[:500], once[:100], once[:100]])
    draw.shuffle(keys)
    parts = jaccard.count_parts(10)
    held = {}
    for batch in np.array_split(keys, 3):
        for part, packed in jaccard.packed_keys(batch, parts):
            assert len(packed) % 4 == 0
            held.setdefault(part, []).append(packed)
    found = np.concatenate([jaccard.repeated_keys(part, packed, parts) for part, packed in held.items()])
    assert set(found.tolist()) == {int(k) & ((parts << 32) - 1) for k in once[:500]}
    assert [jaccard.count_parts(n) for n in (0, 10**6, 10**12)] == [64, 256, 1 << 16]


def test_one_key_in_many_rows_is_packed_twice():
    packed = dict(jaccard.packed_keys(np.full(10_000, 77, np.uint64), 64))
    assert {part: len(keys) for part, keys in packed.items()} == {77 % 64: 8}


def test_texts_that_chance_ties_travel_by_key(spark, folder, monkeypatch):
    """A chain of texts, each four fifths of the next, is one group, in which only planted copies link.

    Cut by salts alone every member would go to a tile for each salt, more with every text.
    """
    count = 400
    rows = [(i, " ".join(f"w{k}" for k in range(8 * i, 8 * i + 80))) for i in range(count)]
    rows += [(count + i, rows[i][1] + " end") for i in range(0, count, 40)]
    monkeypatch.setattr(jaccard, "TILE_WEIGHT", 2_560)
    placed, tiles = [], jaccard._tiles
    monkeypatch.setattr(jaccard, "_tiles", lambda *given: placed.append(tiles(*given)) or placed[-1])
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/docs")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_classes(spark.read.parquet(f"{folder}/docs"), jaccard.Similarity(3, 90, 100)).collect()}
    assert found == brute.components(rows, 3, 90, 100)
    assert placed[-1].count() < 0.7 * count * (2 * 128 * count / 2_560)

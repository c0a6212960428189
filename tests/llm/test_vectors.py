"""Hard negatives and clusters against brute force."""

from collections import Counter
from math import floor, isfinite

import numpy as np
import pytest

from layerkit.llm import centroids, negatives

KIND = "vec_id long, embedding array<double>, label int"


def plain_negatives(rows, every=100):
    """All pairs, as the contract puts it; shorter vectors end in zeros."""
    used = [(d, c, [floor(256 * x) for x in v]) for d, v, c in rows if c is not None and v is not None and all(x is not None and isfinite(x) for x in v)]
    found = []
    for at, (anchor, label, v) in enumerate(used):
        if anchor is None or anchor % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), d is None, d, c) for k, (d, c, w) in enumerate(used) if k != at]
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        for positive in [s for s in scored if s[3] == label][:5]:
            low, high = 80 * -positive[0], 100 * -positive[0]
            fits = [s for s in scored if s[3] != label and low <= 100 * -s[0] <= high][:5]
            found += [(anchor, positive[2], rank, s[2], -positive[0], -s[0]) for rank, s in enumerate(fits, 1)]
    return Counter(found)


def vectors(count, seed, dims=16, spread=0.4):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, dims))
    made = centres[draw.integers(0, 6, count)] + spread * draw.normal(size=(count, dims))
    return [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(made, draw.integers(0, 4, count)))]


@pytest.mark.parametrize("settings", [{}, {"GROUPS": 3, "GROUP_ROWS": 20}, {"SAMPLE_ROWS": 40, "WAYS": 3, "ANCHORS_AT_ONCE": 2}])
def test_negatives_equal_those_of_all_pairs(spark, monkeypatch, settings):
    """Also with a hot vector, repeated rows, null ids and labels, and vectors of other lengths."""
    for name, value in settings.items():
        monkeypatch.setattr(negatives, name, value)
    rows = vectors(300, 1)
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(150)]
    rows += [rows[100], rows[100], (None, rows[7][1], 1), (None, rows[7][1], 2), (2000, rows[8][1], None), (2100, None, 1), (2200, [1.0, 2.0], 1)]
    rows += [(2300, [float("nan")] * 16, 1), (2400, [None] * 16, 1), (2500, [], 1), (2600, [float("inf")] * 16, 0)]
    table = spark.createDataFrame(rows, KIND).repartition(3)
    found = negatives.hard_negatives(table, every=50)
    expected = plain_negatives(rows, 50)
    assert sum(expected.values()) > 100
    assert Counter(map(tuple, found.collect())) == expected


def test_ranges_leave_out_what_no_window_reaches():
    """Separate clouds: most leaves fall away, and none that holds a row in the window."""
    draw = np.random.default_rng(4)
    centres = draw.integers(-4000, 4000, size=(12, 8))
    rows = (centres[draw.integers(0, 12, 2000)] + draw.integers(-60, 60, size=(2000, 8))).astype(float)
    root = negatives.grow(rows[:500], ways=8)
    leaves = negatives.leaf_of(root, rows)
    low, high, short, long = ({} for _ in range(4))
    for node in root.nodes():
        k = len(node.points)
        low[node.number], high[node.number] = np.full((k, k), 2.0**62), np.zeros((k, k))
        short[node.number], long[node.number] = np.zeros(k), np.full(k, -1.0)
    for node, held, apart, nearest in negatives.descend(root, rows):
        for j in set(nearest.tolist()):
            inside = nearest == j
            low[node.number][:, j], high[node.number][:, j] = apart[inside].min(axis=0), apart[inside].max(axis=0)
            lengths = negatives.squares(rows[held[inside]])
            short[node.number][j], long[node.number][j] = lengths.min(), lengths.max()
    ranges, visited = negatives.Ranges(low, high, short, long), []
    for query in rows[:100]:
        scores = rows @ query
        most = float(np.sort(scores)[-5])
        found = negatives.survivors(root, ranges, query, 0.98 * most, most)
        inside = (scores >= 0.98 * most) & (scores <= most)
        assert set(leaves[inside]) <= set(found)
        visited.append(len(found) / len(root.leaves()))
    assert np.mean(visited) < 0.5


def plain_clusters(rows, clusters=16, rounds=3):
    import hashlib

    kept = [(d, [floor(64 * x) for x in v]) for d, v, _ in rows if v is not None and len(v) == 64 and all(x is not None and isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in first[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for k, members in groups.items():
            centres[k] = [sum(column) // len(members) for column in zip(*members)]
    return Counter((d, nearest(v)[1], nearest(v)[0]) for d, v in kept)


@pytest.mark.parametrize("entries, width", [(4096, 2), (0, 2), (25, 2), (10, 1)])
def test_clusters_equal_those_of_plain_rounds(spark, entries, width):
    """Whatever the dictionaries hold, also with repeated rows, ids that are null, and few vectors."""
    rows = vectors(120, 2, dims=64) + [(5, [0.5] * 64, 1)] * 40 + [(None, [0.25] * 64, 1), (9, [1.0] * 63, 1), (10, None, 1), (11, [None] * 64, 1)]
    for part in (rows, rows[:5], rows[-2:]):
        found, _ = centroids.clustered(spark.createDataFrame(part, KIND).repartition(3), entries=entries, width=width)
        assert Counter(map(tuple, found.collect())) == plain_clusters(part)


def test_components_too_large_to_add_up_are_an_error(spark):
    with pytest.raises(Exception, match="or more in size"):
        centroids.clustered(spark.createDataFrame([(1, [1e9] * 64, 1)], KIND))[0].collect()

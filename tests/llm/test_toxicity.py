"""The conditional random field against sums over all taggings, and on held-out texts."""

from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from layerkit.llm import toxicity


def plain_tokens(text):
    found, start = [], None
    for at, c in enumerate(text + " "):
        letter = ord(c) > 127 or c.isalpha()
        if letter and start is None:
            start = at
        if not letter and start is not None:
            found.append((start, at))
            start = None
    return found


def run_of(texts):
    data = "".join(texts).encode()
    ends = np.cumsum([0, *(len(t.encode()) for t in texts)])
    return np.frombuffer(data, np.uint8), ends


def test_tokens_sentences_and_texts():
    texts = ["One two. Three!", "", "four,five\nÜber acht", "x " * 150, "..."]
    data, offsets = run_of(texts)
    found = toxicity.tokens(data, offsets)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    for k, text in enumerate(texts):
        own = slice(found.begin[k], found.begin[k + 1])
        spans = [(int(points[a] - points[offsets[k]]), int(points[b] - points[offsets[k]])) for a, b in zip(found.starts[own], found.stops[own])]
        assert spans == plain_tokens(text)
    opens = [found.opens[found.begin[k] : found.begin[k + 1]].tolist() for k in range(len(texts))]
    assert opens[0] == [True, False, True] and opens[2] == [True, False, True, False]
    assert np.flatnonzero(opens[3]).tolist() == [0, 64, 128]
    alike = toxicity.tokens(*run_of(["IDIOT idiot"]))
    assert alike.hashes[0] == alike.hashes[1] and alike.capitals.tolist() == [2, 0]


def test_sums_equal_those_over_all_taggings():
    draw = np.random.default_rng(1)
    lengths = [4, 1, 3, 5]
    opens = np.zeros(sum(lengths), bool)
    opens[np.cumsum([0, *lengths[:-1]])] = True
    plan = toxicity.Plan.of(opens)
    scores = draw.normal(size=(len(opens), 3)) * 3
    field = toxicity.Field(np.zeros(1, np.uint64), np.zeros((1, 3)), np.zeros(3), draw.normal(size=3), draw.normal(size=(3, 3)))
    chances, pairs, total = field.sums(scores[plan.order], plan)
    calm = field.calm(scores[plan.order], plan)
    place = {token: at for at, token in enumerate(plan.order)}
    for number, (first, length) in enumerate(zip(np.flatnonzero(opens), lengths)):
        weights = {}
        for tags in product(range(3), repeat=length):
            value = field.opening[tags[0]] + sum(scores[first + i, t] for i, t in enumerate(tags))
            weights[tags] = value + sum(field.following[a, b] for a, b in zip(tags, tags[1:]))
        at = int(np.flatnonzero(plan.sentences == number)[0])
        logsum = np.logaddexp.reduce(list(weights.values()))
        assert np.isclose(total[at], logsum) and np.isclose(calm[at], weights[(0,) * length])
        for i in range(length):
            for tag in range(3):
                share = sum(np.exp(v - logsum) for t, v in weights.items() if t[i] == tag)
                assert np.isclose(chances[place[first + i], tag], share)
                if i:
                    both = sum(np.exp(v - logsum) for t, v in weights.items() if t[i - 1] == 1 and t[i] == tag)
                    assert np.isclose(pairs[place[first + i], 1, tag], both)


WORDS = ["amber", "brook", "cedar", "delta", "ember", "field", "grove", "heath", "inlet", "joint"]


def corpus(count, seed=3):
    """One in four texts is toxic by a word, or by a pair of words that are harmless apart."""
    draw, rows = np.random.default_rng(seed), []
    for doc_id in range(count):
        words = [WORDS[k] + str(draw.integers(0, 30)) * 0 for k in draw.integers(0, len(WORDS), 30)]
        words = [w + "abcdefghij"[draw.integers(0, 10)] for w in words]
        toxic = doc_id % 4 == 0
        if toxic:
            words[int(draw.integers(1, 29))] = "vile" if doc_id % 8 else "rotten"
        if doc_id % 4 == 1:
            words[3] = "rotte"
        rows.append((doc_id, " ".join(words) + ".", int(toxic)))
    return rows


@pytest.fixture(scope="module")
def scored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("toxic"))
    rows = corpus(1500)
    spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(d, c) for d, _, c in rows], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows, folder, {r["doc_id"]: r for r in toxicity.op13_toxicity(spark, folder).collect()}


def test_held_out_texts_are_judged_and_spans_point_at_the_words(scored):
    rows, _, found = scored
    held = [(text, toxic, found[d]) for d, text, toxic in rows if found[d]["held_out"]]
    assert len(held) > 200
    assert all(r["predicted"] == toxic == int(r["score"] >= 0.5) for _, toxic, r in held)
    for text, toxic, r in held:
        spans = [text[int(a) : int(b)] for a, b in (s.split(":") for s in r["spans"].split(",") if s)]
        assert spans == ([w for w in text.rstrip(".").split() if w in ("vile", "rotten")] if toxic else [])


def test_held_out_labels_are_not_learned_from(spark, scored):
    rows, folder, found = scored
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    turned = [(d, 1 - c if found[d]["held_out"] else c) for d, _, c in rows]
    model = toxicity.train(docs, spark.createDataFrame(turned, "doc_id long, toxic int"))
    again = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, model).collect()}
    assert all(abs(again[d] - r["score"]) < 1e-9 for d, r in found.items())


def test_copies_of_a_mislabelled_text_do_not_teach_its_words(spark, folder):
    rows = corpus(800, 5)
    copy = "quartz " * 3 + " ".join(f"{w}q" for w in WORDS * 3) + "."
    rows += [(10_000 + i, copy, 1) for i in range(60)]
    rows += [(20_000, "a quartz here and " + rows[1][1], 0)]
    spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string").write.parquet(f"{folder}/documents")
    docs = spark.read.parquet(f"{folder}/documents")
    labels = spark.createDataFrame([(d, c) for d, _, c in rows], "doc_id long, toxic int")
    found = {r["doc_id"]: r for r in toxicity.scored(docs, toxicity.train(docs, labels)).collect()}
    assert found[20_000]["predicted"] == 0 and found[20_000]["spans"] == ""


def test_without_labels_and_without_words(spark, folder):
    spark.createDataFrame([(1, "a vile text"), (2, None), (3, ""), (None, "!!")], "doc_id long, text string").write.parquet(f"{folder}/documents")
    docs = spark.read.parquet(f"{folder}/documents")
    for labels in ([], [(None, 1), (1, None), (77, 1)], [(1, 1)], [(1, 0), (1, 1), (2, 0), (3, 0)]):
        model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        rows = toxicity.scored(docs, model).collect()
        assert len(rows) == 4 and all(0 <= r["score"] <= 1 for r in rows)
        assert len({r["score"] for r in rows if r["doc_id"] != 1}) == 1


def test_long_texts_are_read_whole():
    assert toxicity.tokens(*run_of(["ab " * 400_000 + "end"])).hashes.shape == (400_001,)
    assert pa.array(["x"]).type == pa.string()

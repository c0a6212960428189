"""The whole pipeline against plain Python: which documents, which texts, which ids."""

import hashlib
import unicodedata
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import brute
import numpy as np
import pytest

import corpus_pipeline
from layerkit.llm import mixing, quality_rules

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are absent")


def features(text):
    text = text or ""
    words, chars, symbols, twice, repeats = brute.statistics(text)
    lines = sum(1 for line in text.split("\n") if brute.WORD.search(line))
    upper, marks = sum(unicodedata.category(c) == "Lu" for c in text), sum(c in "!?" for c in text)

    def ratio(a, b):
        return a / b if b else 0.0

    return words, repeats, {
        "words": float(words), "word_length": ratio(chars, words), "symbols_per_word": ratio(symbols, words), "marks_per_word": ratio(marks, words),
        "upper_share": ratio(upper, chars), "dup_line_share": ratio(twice, lines), "repeat_share": ratio(repeats, words), "words_per_line": ratio(words, lines),
    }


def good(text, rules):
    words, repeats, values = features(text)
    rejected = any(all((values[t.feature] > t.cut) == t.above for t in rule) for rule in rules)
    return words >= 20 and 100 * repeats <= 30 * words and not rejected


def targets(sizes):
    """Shares by weight, held at three times a source's size, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    found, rest, free = {}, float(sum(sizes.values())), set(order)
    while free:
        level = rest / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            return found | {s: level * weight[s] for s in free}
        for s in over:
            found[s] = 3.0 * sizes[s]
            rest -= found[s]
        free -= over
    return found


def taken(docs):
    """``(doc_id, text)`` as often as the mix takes them, the last one of a source in part."""
    sizes, by_source = Counter(), defaultdict(list)
    for doc_id, text, source in docs:
        n = len(brute.WORD.findall(text or ""))
        sizes[source] += n
        by_source[source].append((hashlib.md5(str(doc_id).encode()).hexdigest(), doc_id, n, text))
    goal, found = targets(sizes), []
    for source, rows in by_source.items():
        left = int(goal[source] + 0.5)
        for _ in range(mixing.CAP):
            for _, doc_id, n, text in sorted(rows):
                words = max(0, min(n, left))
                left -= words
                if words == n and n:
                    found.append((doc_id, text))
                elif words:
                    found.append((doc_id, text[: list(brute.WORD.finditer(text))[words - 1].end()]))
    return found


def test_every_id_of_every_document_is_there_once(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rules = quality_rules.learn_rules(quality_rules.labelled_examples(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")))
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect() if good(r["text"], rules)]
    last = {}
    for doc_id, text, source in sorted(rows):
        last[brute.lower(text)] = (doc_id, text, source)
    left = {r[0]: r for r in last.values()}
    first = {c for _, c in brute.components([(d, t) for d, t, _ in left.values()], 5, 8, 10).values()}
    expected = taken([left[d] for d in first])

    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    ids = {text: np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4") for _, text in expected}
    wanted = Counter((d, t) for d, t in expected)
    # Texts of one document differ in length, so pieces tell by it which text they are of.
    by_length = {(d, len(ids[t])): (t, n) for (d, t), n in wanted.items()}
    assert len(by_length) == len(wanted)

    covered, sequences = defaultdict(Counter), defaultdict(list)
    for p in corpus_pipeline.run(spark, str(FOLDER)).collect():
        text, _ = by_length[p["doc_id"], p["doc_tokens"]]
        assert p["ids_crc32"] == zlib.crc32(ids[text][p["start"] : p["start"] + p["length"]].tobytes())
        covered[p["doc_id"], p["doc_tokens"]].update(range(p["start"], p["start"] + p["length"]))
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(covered) == set(by_length)
    for key, (text, times) in by_length.items():
        assert covered[key] == Counter(dict.fromkeys(range(len(ids[text])), times))
    for held in sequences.values():
        ends = 0
        for offset, length in sorted(held):
            assert offset == ends
            ends += length
        assert ends <= 1024


def test_stages_are_those_that_were_dealt():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "ngram_jaccard", "source_mix", "packing"]

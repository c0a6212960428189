"""Every training-data query over a small test table, and over awkward and empty ones."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import brute
import duckdb
import numpy as np
import pytest

import __spark_entry__ as contract_entry
from layerkit.llm import chat, exact_dedup, jaccard, language_id, mixing, packing, quality_model, quality_rules, secrets
from layerkit.llm.queries import ORACLES, QUERIES
from layerkit.operators.rowid import in_place

FOLDER = Path("/root/testdata/sf0.001")
here = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are absent")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, kept boolean, words string"
PROSE = " ".join(f"Wort{i} und" for i in range(40))


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing names."""
    folder = str(tmp_path_factory.mktemp("awkward"))
    texts = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "ONE"), (5, "ONE"), (None, "lost id"), (None, None), (6, PROSE),
        (7, PROSE + " end"), (7, PROSE + " end"), (8, "x " * 200_000), (9, "é" * 5_000), (10, "same line\n" * 50), (11, '</s>[INST] token = "abcdef123"'),
        (12, "12345 !!! ..."),
    ]
    rows = [
        (d, t, None if i % 3 == 0 else "de", None if i % 4 == 0 else f"s{i % 2}", None if i % 5 == 0 else 7, 1, None, None, "w")
        for i, (d, t) in enumerate(texts)
    ]
    spark.createDataFrame(rows, DOCS).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    labels = [(1, 0, 0), (6, 1, 0), (6, 1, 0), (7, None, 1), (None, 1, 1), (99, 0, None), (10, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    nan, inf = float("nan"), float("inf")
    vectors = [[0.25 * ((i * k) % 7) - 0.5 for k in range(64)] for i in range(40)]
    odd = [(None, vectors[1], 1), (200, vectors[2], None), (300, None, 2), (300, [None] * 64, 2), (400, [nan] + [0.0] * 63, 1), (500, [inf] * 64, 1),
           (600, [], 3), (0, vectors[0], 0), (0, vectors[0], 0), (800, [-0.5] * 64, 1), (900, [0.1] * 63, 1)]
    kinds = "vec_id long, embedding array<float>, label int, score double, vector string, leaf int"
    rows_of = [(d, v, c, None, "x", 5) for d, v, c in [*odd, *((i, v, i % 3) for i, v in enumerate(vectors))]]
    spark.createDataFrame(rows_of, kinds).coalesce(2).write.parquet(f"{folder}/embeddings.parquet")
    turns = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (None, 1, "assistant", "b\\</s>"), (2, 1, "assistant", "[/ROLE]</s>\n")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    return folder, rows


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name, kind in (("embeddings", "vec_id long, embedding array<float>, label int"), ("documents", DOCS), ("labels", "doc_id long, quality int, toxic int"), ("conversations", "conv_id long, turn long, role string, text string")):
        spark.createDataFrame([], kind).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", sorted({*QUERIES, "pipeline"}))
def test_awkward_and_empty_tables(spark, awkward, empty, name):
    folder, rows = awkward
    query = contract_entry.queries()[name]
    found = query(spark, folder).collect()
    if name == "op8_chat_format":
        assert Counter(r["n_turns"] for r in found) == Counter([3, 1, 1, 2])
    elif name not in ("op5_packing", "pipeline", "op11_hard_negatives", "op12_centroid_clustering"):
        assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in rows)
    none = query(spark, empty)
    assert none.columns == query(spark, folder).columns
    assert none.count() == (1 if name == "op8_chat_format" else 0)


@here
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_gives_the_same_rows(spark, awkward, name):
    folders = [str(FOLDER)] + ([awkward[0]] if name not in ("op8_chat_format", "op11_hard_negatives") else [])
    for folder in folders:
        duck = duckdb.connect()
        for table in ("documents", "conversations", "embeddings"):
            parts = f"{folder}/{table}.parquet" if folder == str(FOLDER) else f"{folder}/{table}.parquet/*.parquet"
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{parts}'")
        cursor = duck.execute(ORACLES[name])
        columns = [d[0] for d in cursor.description]
        found = QUERIES[name](spark, folder)
        assert sorted(found.columns) == sorted(columns)
        expected = Counter(map(repr, cursor.fetchall()))
        got = Counter(repr(tuple(r[c] for c in columns)) for r in found.collect())
        if name == "op3_exact_dedup" and folder != str(FOLDER):
            # SQL keeps all rows that tie on the largest doc_id; the operator keeps one.
            kept = columns.index("kept")
            got = Counter(repr(tuple(v for i, v in enumerate(eval(r)) if i != kept)) for r in got.elements())
            expected = Counter(repr(tuple(v for i, v in enumerate(eval(r)) if i != kept)) for r in expected.elements())
        assert got == expected


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@here
def test_mix_meets_its_targets(spark):
    rows = QUERIES["op1_mixing"](spark, str(FOLDER)).collect()
    source = {r["doc_id"]: r["source"] for r in documents(spark).collect()}
    taken, targets = Counter(), {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
        targets[source[r["doc_id"]]] = r["target"]
    assert all(abs(taken[s] - t) <= 1 for s, t in targets.items())
    assert abs(sum(targets.values()) - sum(r["size"] for r in rows)) < 1
    assert [r["position"] for r in rows if r["position"] is not None] == sorted(r["position"] for r in rows if r["position"] is not None)


def test_capped_targets_are_shared_out_again(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 50), ("c", 0)], "source string, size long")
    targets = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    # Weights 5, 2, 1, 5: a stops at 30, c at 0, and the rest goes 2 to 1 until null stops at 150.
    assert targets == {"a": 30.0, "c": 0.0, None: 150.0, "b": 880.0}


def test_schedule_times_undo_its_integral(spark):
    for schedule in mixing.SCHEDULES:
        shares = spark.range(11).select((mixing.F.col("id") / 10).alias("share"))
        for share, at in shares.select("share", mixing.time_of(mixing.F.col("share"), schedule)).collect():
            spent = 0.0
            for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
                end = min(max(at, t0), t1)
                spent += (end - t0) * (w0 + w0 + (w1 - w0) * (end - t0) / (t1 - t0)) / 2
            assert abs(spent / mixing.integral(schedule) - share) < 1e-9


@here
def test_mixed_documents_have_their_words(spark):
    docs = documents(spark)
    words = Counter()
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in mixing.mixed(docs).collect():
        assert whole[r["doc_id"]].startswith(r["text"])
        words[r["doc_id"]] += len(brute.WORD.findall(r["text"]))
    assert words == Counter({r["doc_id"]: r["taken"] for r in QUERIES["op1_mixing"](spark, str(FOLDER)).collect() if r["taken"]})


@here
def test_shards_are_even_and_follow_the_text(spark):
    texts = {r["doc_id"]: r["text"] for r in documents(spark).collect()}
    rows = QUERIES["op2_sharding"](spark, str(FOLDER)).collect()
    slots = defaultdict(list)
    for r in rows:
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 8
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    order = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in order] == sorted(r["curve"] for r in rows)


@here
def test_scan_finds_what_the_patterns_find(spark):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = {r["doc_id"]: r for r in QUERIES["op4_secret_scan"](spark, str(FOLDER)).collect()}
    for r in documents(spark).collect():
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(r["text"]) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", r["text"]) if m.end() - m.start() >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", r["text"]) if m.end() - m.start() >= 24]
        text = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert found[r["doc_id"]]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_lexer_follows_names():
    text = 'alpha = "Zx81kkQ2mmPP09"\nbeta = alpha\ndb.password = beta\ncolour: "Zx81kkQ2mmPP00"\n'
    assert [text[s.start : s.end] for s in secrets.lexed_spans(text)] == ["Zx81kkQ2mmPP09"]
    assert secrets.lexed_spans('password = "has a space"') == []
    # Names, gaps and literals have no bound.
    for text in ("a" * 500 + '_password = "Zx81kkQ2"', "--password" + " " * 90 + "= 'Zx81kkQ2'", 'secret: "' + "Zx81kkQ2" * 2_000 + '"'):
        assert [text[s.start - 1] + text[s.end] for s in secrets.lexed_spans(text)] in (['""'], ["''"])


LITERAL = "Zx81kkQ2mmPP09"


@pytest.mark.parametrize("text", [
    f"DB_PWD={LITERAL}", f"export DB_PWD={LITERAL} # note", f"db_pwd: {LITERAL}\nport: 1", f"[main]\naws_access_key = {LITERAL}\n", f"{{auth: {LITERAL}, b: 1}}",
    f'dbPwd: string = "{LITERAL}"', f'client_credential: str = "{LITERAL}"', f"pwd: str | None = '{LITERAL}'", f'pwd: Option<&str> = "{LITERAL}";', f'const PWD: &\'static str = "{LITERAL}";',
    f'a = db_pwd = "{LITERAL}"', f'db_pwd = a = b = "{LITERAL}"', f'db_pwd=b="{LITERAL}"', f'x = "{LITERAL}"\ny = pwd = x\n', f"x = {LITERAL}\npwd = x",
    f"host=https://h.example/?q=1&auth={LITERAL}&next=2", f'key: "{LITERAL}"', f"signing_key = {LITERAL}",
])
def test_lexer_reads_configuration_types_and_chains(text):
    assert [text[s.start : s.end] for s in secrets.lexed_spans(text)] == [LITERAL]


def test_lexer_reads_whole_unquoted_values():
    for literal in ("wJalrXUtnFEMI/K7MDENG+bPxRfiCY", "8f3kZx81kkQ2", "Zx81=kkQ2:mm==", "Zx81!kk@Q2#m&P", "12345678"):
        assert [s.start for s in secrets.lexed_spans(f"db_pwd = {literal}\n")] == [9]
        assert [s.end for s in secrets.lexed_spans(f"db_pwd = {literal}\n")] == [9 + len(literal)]
    for text in ("pwd = get_password()", "pwd = environ['X1234567']", "pwd=$DB_PASSWORD", "pwd == other_value", "std::pwd::string_value", 'key = "aaaaaaaaaaaaaa"'):
        assert secrets.lexed_spans(text) == []
    # Values in one run are not read again for each name.
    assert secrets.lexed_spans("a:b=" * 100_000) == []


@here
def test_packing_holds_every_id_once(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in QUERIES["op5_packing"](spark, str(FOLDER)).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for r in documents(spark).collect():
        ids, at = np.array([*tokenizer.encode(r["text"], add_special_tokens=False).ids, 0], "<u4"), 0
        for p in sorted(pieces[r["doc_id"]], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    padding = 0
    for held in sequences.values():
        length = 0
        for p in sorted(held, key=lambda p: p["offset"]):
            assert p["offset"] == length
            length += p["length"]
        assert length <= 1024
        padding += 0 if length & (length - 1) == 0 else 1024 - length
    assert padding <= 1024


def test_packer_routes_and_fills():
    packer = packing.Packer((4, 8))
    for row, length in enumerate([5, 3, 3, 9, 2]):
        packer.add(row, length)
    windows = [(t, [(p.row, p.start, p.length) for p in w]) for t, w in packer.pack()]
    used = sorted((r, s + i) for _, w in windows for r, s, n in w for i in range(n))
    assert used == sorted((r, i) for r, n in enumerate([5, 3, 3, 9, 2]) for i in range(n))
    assert windows[0] == (1, [(0, 0, 5), (1, 0, 3)])


@here
def test_language_of_held_out_texts(spark):
    lang = {r["doc_id"]: r["lang"] for r in documents(spark).collect()}
    rows = QUERIES["op6_language_id"](spark, str(FOLDER)).collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_only_rows_to_learn_from_set_the_rates(spark, monkeypatch):
    """Neither held-out labels nor rows without letters change which rows are drawn."""
    held = [d for d in range(4_000) if zlib.crc32(str(d).encode()) % 4 == 2]
    learned = [d for d in range(4_000) if zlib.crc32(str(d).encode()) % 4 != 2]
    drawn = []
    monkeypatch.setattr(language_id, "fit", lambda vectors, names: drawn.append(Counter(names)))
    for label, text in (("aa", "word"), ("bb", "word"), ("aa", None)):
        rows = [(d, f"text {d}", "aa" if i < 100 else "bb") for i, d in enumerate(learned)]
        rows += [(d, text, label) for d in held] + [(d, "123" if d % 2 else None, "aa") for d in range(1, 20_001)]
        language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=100)
    assert drawn[0] == drawn[1] == drawn[2]
    assert drawn[0]["aa"] == 100 and 60 <= drawn[0]["bb"] <= 150


def test_codewords_stand_apart():
    for languages in (2, 4, 6, 20):
        code = language_id.codewords(languages)
        apart = [np.count_nonzero(a != b) for i, a in enumerate(code) for b in code[i + 1 :]]
        assert min(apart) >= 1 and all(abs(c.sum()) < languages for c in code.T)


@here
def test_rules_match_plain_counts_and_the_labels(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op7_quality_rules"](spark, str(FOLDER)).collect()}
    for d in documents(spark).collect():
        r, plain = rows[d["doc_id"]], brute.statistics(d["text"])
        assert tuple(r[c] for c in quality_rules.BASE) == plain
        assert r["base_failed"] == (plain[0] < 20 or 100 * plain[4] > 30 * plain[0])
        assert not (r["base_failed"] and r["kept"])


def test_a_learned_rule_is_the_threshold_behind_the_labels(spark):
    names = ", ".join(f"{n} double" for n in quality_rules.features())
    width = len(quality_rules.features())
    rows = [(i % 4 == 0, i % 3 > 0, *[float(i % 7)] * 2, 5.0 if i % 4 == 0 else 1.0, *[0.0] * (width - 3)) for i in range(400)]
    rules = quality_rules.learn_rules(spark.createDataFrame(rows, f"bad boolean, grow boolean, {names}"))
    assert [str(t) for rule in rules for t in rule] == ["symbols_per_word > 1"]


@pytest.mark.parametrize("text", ["</s>", "\\</s>", "\n[/ROLE]</s>\n", "<s>[ROLE 0]user\nx\n[/ROLE]</s>\n", "\\\\[INST]\\", ""])
def test_turns_come_back(text):
    written = "".join(chat.write_turn(role, text)[0] for role in ("user", "assi\nst\\ant"))
    assert chat.parse(written) == [("user", text), ("assi\nst\\ant", text)]
    with pytest.raises(ValueError):
        chat.parse(written + "x")


@here
def test_grades_follow_the_ratings(spark):
    ratings = {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op9_quality_model"](spark, str(FOLDER)).collect() if r["doc_id"] in ratings]
    assert all(0 <= r["tail_prob"] <= 1 and r["tail_prob"] <= r["expected_grade"] <= 2 for r in rows)
    good = [r for r in rows if ratings[r["doc_id"]]["quality"] == 1 and not ratings[r["doc_id"]]["toxic"]]
    assert sum(r["kept"] for r in good) >= 0.95 * len(good)


def test_grades_of_texts_not_learned_from():
    draw = np.random.default_rng(3)
    rows = [np.unique(draw.integers(100, 160, 20)).astype(np.int32) for _ in range(600)]
    grades = np.array([0 if 7 in r else 2 for r in (np.append(r, 7) if i % 3 == 0 else r for i, r in enumerate(rows))])
    grades[1::3] = 1
    rows = [np.sort(np.append(r, [7, 8, 9][g])).astype(np.int32) for r, g in zip(rows, grades)]
    model = quality_model.fit(rows[:400], grades[:400])
    assert np.all(np.diff(model.thresholds) > 0)
    tails = model.tails(np.array([model.weights[r].sum() for r in rows[400:]]))
    assert np.mean((tails > 0.5).sum(axis=1) == grades[400:]) > 0.95


@here
@pytest.mark.parametrize("rule", [jaccard.Similarity(3, 90, 100), jaccard.Similarity()])
def test_components_equal_those_of_all_pairs(spark, rule):
    docs = documents(spark)
    plain = brute.components([(r["doc_id"], r["text"]) for r in docs.collect()], rule.width, rule.numerator, rule.denominator)
    found = jaccard.similar_classes(docs, rule).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == plain


def near_copies(spark, folder, count):
    draw = np.random.default_rng(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for doc_id in range(count):
        words = list(base) if doc_id % 5 else [f"v{doc_id}x{i}" for i in range(150)]
        for at in draw.integers(0, len(words), doc_id % 4):
            words[at] = f"n{doc_id}"
        rows.append((doc_id, " ".join(words)))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(folder)
    return rows


def test_large_groups_are_cut_into_tiles(spark, folder, monkeypatch):
    """A group of near copies over many tiles gives the components of all pairs."""
    rows = near_copies(spark, f"{folder}/docs", 120)
    monkeypatch.setattr(jaccard, "TILE_WEIGHT", 4_000)
    found = jaccard.similar_classes(spark.read.parquet(f"{folder}/docs"), jaccard.Similarity(3, 90, 100)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute.components(rows, 3, 90, 100)


@pytest.mark.parametrize("rule", [jaccard.Similarity(3, 90, 100), jaccard.Similarity(), jaccard.Similarity(2, 3, 5)])
def test_similar_sets_share_a_key(rule):
    draw = np.random.default_rng(11)
    tried = 0
    for _ in range(600):
        size = int(draw.integers(1, 400))
        found = np.unique(draw.integers(0, 2**63, size, dtype=np.uint64))
        fewer = found[draw.random(len(found)) > draw.random() * 0.2]
        other = np.unique(np.concatenate([fewer, draw.integers(0, 2**63, int(draw.integers(0, 1 + size // 8)), dtype=np.uint64)]))
        common = len(np.intersect1d(found, other))
        if len(other) and not np.array_equal(found, other) and rule.links(common, len(found), len(other)):
            tried += 1
            assert set(jaccard.set_keys(found, rule)) & set(jaccard.set_keys(other, rule))
            for share in (0.3, 0.8, 1.0):
                common = found[draw.random(len(found)) < share]
                assert set(jaccard.set_keys(found, rule, common)) & set(jaccard.set_keys(other, rule, common))
    assert tried > 50


@here
def test_one_document_of_each_group_stays(spark):
    docs = documents(spark)
    plain = brute.components([(r["doc_id"], r["text"]) for r in docs.collect()], 5, 8, 10)
    assert sorted(r["doc_id"] for r in jaccard.one_of_each(docs).collect()) == sorted({c for _, c in plain.values()})


def test_fuse_filter_never_misses():
    draw = np.random.default_rng(2)
    for count in (0, 1, 2, 3, 10, 1_000, 50_000):
        keys = np.unique(draw.integers(0, 2**63, count, dtype=np.uint64))
        made = exact_dedup.FuseFilter.build(keys)
        assert made.holds(keys).all() if count else True
        strangers = draw.integers(2**63, 2**64 - 1, 20_000, dtype=np.uint64)
        assert made.holds(strangers).mean() < 0.02
        assert len(made.prints) < 1.3 * count + 200


@here
def test_copies_do_not_depend_on_the_snapshot(spark):
    docs = documents(spark)
    expected = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.copy_groups(docs).collect()}
    for in_snapshot in (exact_dedup.F.lit(False), exact_dedup.F.lit(True), exact_dedup.F.col("doc_id") % 3 == 0):
        found = exact_dedup.copy_groups(docs, in_snapshot).collect()
        assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in found} == expected


def test_repeated_rows_keep_one(spark, awkward):
    rows = QUERIES["op3_exact_dedup"](spark, awkward[0]).collect()
    kept = Counter(r["text_sha256"] for r in rows if r["kept"])
    assert set(kept.values()) == {1} and set(kept) == {r["text_sha256"] for r in rows}


def test_stages_take_any_plan(spark, folder):
    """In memory or of a join that repeats rows: what a plain scan of the same rows gives."""
    rows = [(d, f"{PROSE} end{d % 5}" if d % 2 else f"other words {d % 4} here", "en", f"s{d % 3}", 7) for d in range(12)]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    made.repartition(2).write.parquet(f"{folder}/docs")
    scan = spark.read.parquet(f"{folder}/docs")
    spark.createDataFrame([(r[0],) for r in rows for _ in range(2)], "doc_id long").write.parquet(f"{folder}/pairs")
    joined = scan.join(spark.read.parquet(f"{folder}/pairs"), "doc_id")
    for stage in (exact_dedup.without_copies, jaccard.one_of_each, mixing.mixed):
        expected = Counter(map(tuple, stage(scan).collect()))
        assert expected and Counter(map(tuple, stage(made).collect())) == expected
    once = Counter(map(tuple, exact_dedup.without_copies(scan).collect()))
    assert Counter(map(tuple, exact_dedup.without_copies(joined).collect())) == once
    for docs in (scan, scan.where("doc_id > 3").select("text"), scan.alias("d")):
        assert in_place(docs) is docs
    for docs in (made, joined, scan.union(scan), scan.distinct(), scan.where("rand() < 2")):
        assert in_place(docs) is not docs


@here
def test_pipeline_equals_its_stages_by_hand(spark):
    """Brute force over what the learned rules keep, then targets and tokens of what is left."""
    docs = documents(spark)
    rules = quality_rules.learn_rules(quality_rules.labelled_examples(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")))
    kept = {r["doc_id"] for r in quality_rules.judged(docs, rules).where("kept").select("doc_id").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] in kept}
    last = {}
    for doc_id in sorted(texts):
        last[brute.lower(texts[doc_id])] = doc_id
    left = [(d, texts[d]) for d in last.values()]
    groups = {c for _, c in brute.components(left, 5, 8, 10).values()}
    words = sum(len(brute.WORD.findall(texts[d])) for d in groups)

    pieces = contract_entry.queries()["pipeline"](spark, str(FOLDER)).collect()
    assert {p["doc_id"] for p in pieces} <= groups
    encode = packing.encoder("byte_bpe_50k.json")
    tokens, spread = sum(p["length"] for p in pieces), Counter()
    for p in pieces:
        spread[p["sequence_id"]] += p["length"]
    assert max(spread.values()) <= 1024
    per_word = sum(len(encode(texts[d])) for d in groups) / words
    assert abs(tokens / (words * per_word) - 1) < 0.1

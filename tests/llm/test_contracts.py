"""Cases in which operators once left their contract, and learned verdicts against plain versions."""

import math
import unicodedata
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

from layerkit.llm import language_id, mixing, packing, quality_model, quality_rules, secrets
from layerkit.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def stored(spark, folder, rows, name="documents"):
    spark.createDataFrame(rows, DOCS).repartition(2).write.parquet(f"{folder}/{name}.parquet")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def test_a_source_without_words_takes_nothing(spark, folder):
    rows = [(i, "one two three", "en", "a", 1) for i in range(10)] + [(20, "", "en", "b", 1), (21, None, "en", "b", 1), (22, " \n", "en", "b", 1)]
    docs = stored(spark, folder, rows)
    found = {r["doc_id"]: r for r in QUERIES["op1_mixing"](spark, folder).collect()}
    assert [(found[d]["target"], found[d]["taken"], found[d]["source_size"]) for d in (20, 21, 22)] == [(0.0, 0, 0)] * 3
    assert sum(r["taken"] for r in found.values()) == 30
    assert {r["doc_id"] for r in mixing.mixed(docs).collect()} == set(range(10))


def test_a_table_without_words_takes_nothing(spark, folder):
    docs = stored(spark, folder, [(1, "", "en", "a", 0), (2, None, "en", None, 0)])
    assert [(r["target"], r["taken"]) for r in QUERIES["op1_mixing"](spark, folder).collect()] == [(0.0, 0)] * 2
    assert mixing.mixed(docs).count() == 0


def test_an_id_of_many_rows_spreads_over_blocks(spark, folder, monkeypatch):
    """Running sums are those of one pass over each source in the order of ids, also of null ones."""
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 50)
    rows = [(None if i % 3 == 0 else i, "w " * (1 + i % 4), "en", f"s{i % 2}", 1) for i in range(600)]
    docs = stored(spark, folder, rows)
    sizes = mixing.numbered(docs, "doc_id", "source", "text").select("file", "at", "doc_id", "source", mixing.word_count(mixing.F.col("text")).alias("size"))
    placed = mixing._placed(mixing.settle(sizes)[0], ("file", "at")).collect()
    for source in ("s0", "s1"):
        own = sorted((r["start"], r["size"]) for r in placed if r["source"] == source)
        assert [a + n for a, n in own[:-1]] == [a for a, _ in own[1:]] and own[0][0] == 0


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "<|endoftext", " <|endoftext|>\n", "it's 12 €ü"])
def test_ids_are_those_of_the_plain_tokenizer(text):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
    assert packing.encoder("byte_bpe_50k.json")(text).tolist() == plain


def test_windows_of_a_step_group_hold_as_many_tokens(spark, folder):
    """Every full step group has as many windows of its size as make up its tokens."""
    stored(spark, folder, [(i, f"word{i} and more " * (i % 90), "en", "a", 1) for i in range(600)])
    groups = defaultdict(set)
    for r in packing.packed(spark.read.parquet(f"{folder}/documents.parquet"), step_tokens=4096).collect():
        groups[r["step_group"], r["tier"]].add(r["sequence_id"])
    full = [len(held) * tier for (_, tier), held in groups.items()]
    assert max(full) == 4096 and sum(n == 4096 for n in full) >= len(full) - 8
    assert len({group for group, _ in groups}) == len(groups)


@pytest.mark.parametrize("text", ["² ½ ①", "123 !!", "", None, "Ⅷ", "٣"])
def test_texts_without_letters_are_undetermined(spark, folder, text):
    rows = [(i, "ein Wort" if i % 2 else "some text", "de" if i % 2 else "en", "a", 1) for i in range(40)] + [(99, text, "en", "a", 1)]
    stored(spark, folder, rows)
    found = {r["doc_id"]: r for r in QUERIES["op6_language_id"](spark, folder).collect()}
    assert not any(unicodedata.category(c)[0] == "L" for c in text or "")
    assert (found[99]["lang_pred"], found[99]["score"]) == ("und", 0.0)


def plain_vector(text):
    data, counts = text.lower().encode(), Counter()
    for i in range(len(data)):
        counts[(data[i] * 2654435761 % 2**32) >> 20] += 1
        if i + 1 < len(data):
            pair = (data[i] * 257 + data[i + 1]) % 2**32
            counts[(pair * 2246822519 % 2**32) >> 20] += 1
            if i + 2 < len(data):
                counts[((pair * 263 + data[i + 2]) % 2**32 * 3266489917 % 2**32) >> 20] += 1
    return counts, max(1.0, math.sqrt(sum(counts.values())))


def test_languages_are_decoded_as_by_hand(spark, folder):
    """Losses of codewords, number by number, for each text; Arrow batches change nothing."""
    words = {"de": "und der die das ist nicht", "en": "the and of with that", "fr": "le la des avec est", "es": "el los con para una"}
    draw = np.random.default_rng(6)
    rows = [(i, " ".join(draw.choice(words[lang].split(), 12)), lang, "a", 1) for i, lang in enumerate(list(words) * 60)]
    docs = stored(spark, folder, rows)
    model = language_id.train(docs.select("doc_id", "text", "lang"))
    for r, text in zip(language_id.identified(docs, model).orderBy("doc_id").collect()[:60], (r[1] for r in rows)):
        counts, norm = plain_vector(text)
        losses = []
        for word in model.code:
            loss = 0.0
            for bit, sign in enumerate(word):
                margin = model.bias[bit] + sum(math.sqrt(n) / norm * model.weights[slot, bit] for slot, n in counts.items())
                loss += model.trust[bit] * math.log1p(math.exp(-sign * margin))
            losses.append(loss)
        best = min(range(len(losses)), key=losses.__getitem__)
        share = 1 / sum(math.exp(losses[best] - x) for x in losses)
        assert r["lang_pred"] == model.languages[best] and abs(r["score"] - share) < 1e-6


def test_many_labels_share_the_rows_to_fit(spark, folder, monkeypatch):
    rows = [(i, f"text {i}", f"l{i % 50}", "a", 1) for i in range(2000)] + [(7, "same", "l0", "a", 1)] * 500
    docs = stored(spark, folder, rows)
    sizes = []
    monkeypatch.setattr(language_id, "fit", lambda vectors, names: sizes.append(Counter(names)))
    language_id.train(docs, fit_rows=200)
    assert 120 < sum(sizes[0].values()) < 300 and max(sizes[0].values()) < 20


def test_verdicts_follow_the_rules_by_plain_counts(spark):
    """Every text judged again in plain Python from its own counts and the list's thresholds."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rules = [
        (quality_rules.Test("symbols_per_word", True, 0.05),), (quality_rules.Test("word_length", True, 6.5), quality_rules.Test("words", False, 200.0)),
    ]
    found = {r["doc_id"]: r for r in quality_rules.judged(docs, rules).select("doc_id", "rule", "kept").collect()}
    for d in docs.collect():
        n, chars, symbols, _, repeats = brute.statistics(d["text"])
        values = {"symbols_per_word": symbols / n if n else 0.0, "word_length": chars / n if n else 0.0, "words": float(n)}
        met = [all((values[t.feature] > t.cut) == t.above for t in rule) for rule in rules]
        first = met.index(True) if any(met) else None
        assert found[d["doc_id"]]["rule"] == first
        assert found[d["doc_id"]]["kept"] == (first is None and n >= 20 and 100 * repeats <= 30 * n)


def test_more_rules_than_a_few_are_learned(spark):
    """Kinds of bad rows that each need a rule are all found, and a vague start ends nothing."""
    names = list(quality_rules.features())
    draw = np.random.default_rng(8)
    rows = []
    for i in range(4000):
        values, kind = draw.random(len(names)), i % 20
        bad = kind < 10
        if bad:
            values[kind % 5] = 2.0 + kind if kind < 5 else -2.0 - kind
        rows.append((bad, i % 3 > 0, *values.tolist()))
    table = spark.createDataFrame(rows, "bad boolean, grow boolean, " + ", ".join(f"{n} double" for n in names))
    rules = quality_rules.learn_rules(table)
    met = [any(all((dict(zip(names, r[2:]))[t.feature] > t.cut) == t.above for t in rule) for rule in rules) for r in rows]
    # Cuts are quantiles, so the edge of a kind may stay out.
    assert len(rules) > 8 and sum(m for m, r in zip(met, rows) if r[0]) >= 0.9 * sum(r[0] for r in rows)
    assert sum(m for m, r in zip(met, rows) if not r[0]) <= (1 - quality_rules.LEAST_PRECISION) * sum(met)


def test_more_words_than_a_few_hundred_tell_grades():
    """Each of 400 words marks a tenth of the low texts that hold it; all get a weight."""
    draw = np.random.default_rng(9)
    low = [np.unique(np.append(draw.integers(1000, 1400, 20), draw.integers(5000, 5400, 5))).astype(np.int32) for _ in range(3000)]
    good = [np.unique(draw.integers(5000, 5400, 25)).astype(np.int32) for _ in range(3000)]
    grades = np.repeat([0, 2], 3000)
    rows = low + good
    columns, owner = np.concatenate(rows), np.repeat(np.arange(6000), [len(r) for r in rows])
    chosen = set(quality_model._telling(columns, grades[owner], grades).tolist())
    assert set(range(1000, 1400)) <= chosen


def test_grades_are_those_of_the_sum_of_weights(spark, folder):
    """Words and shares of each text, added up in plain Python."""
    texts = ["Good words here!", "BAD | BAD | #", "", None, "a b c", "Zahl 12 und 34 ???"]
    docs = stored(spark, folder, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    draw = np.random.default_rng(10)
    model = quality_model.Ordinal(draw.normal(size=quality_model.SLOTS), np.array([-1.0, 0.5]))
    found = {r["doc_id"]: r for r in quality_model.graded(docs, model).collect()}
    for doc_id, text in enumerate(texts):
        words = "".join(c if ord(c) > 127 or c.isalpha() else " " for c in text or "").split()
        slots = next(iter(quality_model.text_features(quality_model.pa.array([text], quality_model.pa.string()))))
        assert len(slots) == (len({w.lower() for w in words}) + 6 if words else 0)
        letters = max(1, sum(len(w) for w in words))
        if words:
            capitals = sum("A" <= c <= "Z" for c in text) / letters
            assert slots[0] == min(8, math.ceil(8 * capitals))
        score = sum(model.weights[s] for s in slots)
        tails = [1 / (1 + math.exp(-(score - t))) for t in model.thresholds]
        assert abs(found[doc_id]["expected_grade"] - sum(tails)) < 1e-9 and abs(found[doc_id]["tail_prob"] - tails[-1]) < 1e-9
        assert found[doc_id]["kept"] == (bool(words) and tails[-1] >= quality_model.KEEP)


LITERAL = "Zx81kkQ2mmPP09"


@pytest.mark.parametrize("text, spans", [
    (f'config["db_pwd"] = "{LITERAL}"', [LITERAL]), (f"environ['DB_PWD'] = '{LITERAL}'", [LITERAL]), (f'a["x"]["db_pwd"] = "{LITERAL}"', [LITERAL]),
    (f'db_pwd = """{LITERAL}"""', [LITERAL]), (f"db_pwd = '''{LITERAL}'''", [LITERAL]), (f'db_pwd = b"{LITERAL}"', [LITERAL]), (f'db_pwd = f"{LITERAL}"', [LITERAL]),
    (f"db_pwd = rb'{LITERAL}'", [LITERAL]), (f"const dbPwd = `{LITERAL}`;", [LITERAL]), (f'a, db_pwd = "x", "{LITERAL}"', [LITERAL]),
    (f'db_pwd, a = "{LITERAL}", "Ab12Cd34Ef56"', [LITERAL]), (f"db_pwd: |\n  {LITERAL}\nport: 1\n", [LITERAL]), (f"auth:\n  db_pwd: >-\n    {LITERAL}\n  x: 1", [LITERAL]),
    (f"db_pwd: |\n  {LITERAL}\n  Ab12Cd34Ef56\nport: 9", [LITERAL, "Ab12Cd34Ef56"]), (f"<pwd>{LITERAL}</pwd>", [LITERAL]), (f'<pwd id="1">{LITERAL}</pwd>', [LITERAL]),
    (f'x = getenv("DB_PWD", "{LITERAL}")', [LITERAL]), (f'os.environ.get("DB_PWD", "{LITERAL}")', [LITERAL]), (f'db_pwd = getenv("X", "{LITERAL}")', [LITERAL]),
    ('db_pwd = "Zx81kk" + "Q2mmPP09"', ["Zx81kk", "Q2mmPP09"]), ('db_pwd = "Zx81kk" "Q2mmPP09"', ["Zx81kk", "Q2mmPP09"]),
    ('a = "Zx81kk"\nb = "Q2mmPP09"\ndb_pwd = a + b\n', ["Zx81kk", "Q2mmPP09"]), ('a = "Zx81kk"\ndb_pwd = a + "Q2mmPP09"', ["Zx81kk", "Q2mmPP09"]),
    ('db_pwd = "Zx81kk" . $b', ["Zx81kk"]), ('db_pwd = ("Zx81kk" \\\n "Q2mmPP09")', []),
    ("The pwd: everything12", []), ("auth: something else", []), ("my credential: Everything12 is lost", []), ("see the pwd: there1234 we go", []),
    (f"  db_pwd: {LITERAL}  # note", [LITERAL]), (f"- db_pwd: {LITERAL}", [LITERAL]), (f'{{"db_pwd": "{LITERAL}"}}', [LITERAL]), (f"the pwd: '{LITERAL}'", [LITERAL]),
    (f'<a>{LITERAL}</a>', []), (f'colour, shape = "x", "{LITERAL}"', []), (f'get("colour", "{LITERAL}")', []),
])
def test_lexer_reads_more_forms(text, spans):
    assert [text[s.start : s.end] for s in secrets.lexed_spans(text)] == spans


@pytest.mark.parametrize("text", ['"""' * 50_000, "a, " * 60_000 + "= ", '("a", ' * 60_000, "<a>" * 60_000, "a: |\n" * 50_000, '"a" + ' * 50_000, "x = a + " * 40_000, "word: " * 60_000, 'f("a", "b", ' * 40_000, "a." * 100_000 + "b: c "])
def test_lexer_takes_linear_time(text):
    import time

    start = time.perf_counter()
    secrets.lexed_spans(text)
    assert time.perf_counter() - start < 5

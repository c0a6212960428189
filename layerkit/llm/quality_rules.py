"""Quality rules: a decision list learned from labelled statistics.

Sequential covering: while rejected examples are left, a rule grows by the
threshold test that gains most (FOIL's gain), is pruned on rows held back from
growing, and joins the list if it is precise there. What it covers is set
aside. A rule that is not precise is set aside itself, and the next one starts
with another feature or its other side, until no start is left: the number of
rules and of their tests is not fixed. Rules are conjunctions of tests on readable statistics, and the list
becomes one ordered Spark conditional expression.

Every count over examples is a grouped aggregate over a narrow written table:
the driver sees one row of sums per step, never an example. Only DataFrame
functions are used. Statistics come from array expressions inside a row, so
applying a list moves no text.

Fitting takes about ``FIT_ROWS`` labelled rows, chosen by a hash of doc_id; the
rule list is applied to every row and whole text.

Defined cases: a null text has no words, fails the base rule and is rejected.
Without labels, or without rejected ones, the list is empty and the base rule
alone decides. Labels without a document, null labels and repeated labels (each
counts) are fine. Statistics of texts without words are 0. Rows may repeat and
extra columns stay out of the way.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm.common import SPACE, table
from layerkit.sources.scratch import settle

FIT_ROWS = 20_000
LEAST_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
# What counts as a symbol.
SYMBOLS = r"[#*$%&|<>]"
CUTS = 12
LEAST_PRECISION = 0.9
LEAST_COVER = 4


def _with(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def split_words(text: Column) -> Column:
    """Words of a text; a null text has none."""
    spaces = " \t\n\x0b\x0c\r"
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(spaces))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def _run(words: Column, at: Column, length: int) -> Column:
    """64-bit hash of the words from ``at`` on."""
    return F.xxhash64(*[F.get(words, at + step) for step in range(length)])


def repeated_words(words: Column) -> Column:
    """Words that stand in a window of eight which the text holds twice or more.

    Windows are told apart by 64-bit hashes. A window found twice makes five
    runs of four words repeat, so texts with fewer repeated runs hold none and
    are done after one look.
    """
    half = WINDOW // 2

    def twins(placed: Column) -> Column:
        """Where windows begin whose hash a neighbour in sorted order shares."""
        equal = F.filter(
            placed, lambda p, k: F.get(placed, k - 1)["h"].eqNullSafe(p["h"]) | F.get(placed, k + 1)["h"].eqNullSafe(p["h"])
        )
        return F.sort_array(F.transform(equal, lambda p: p["i"]))

    def covered(starts: Column) -> Column:
        after = F.slice(starts, F.lit(2), F.size(starts))
        steps = F.zip_with(starts, after, lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, n: total + n)

    def exact(words: Column) -> Column:
        windows = F.slice(words, F.lit(1), F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))
        placed = F.transform(windows, lambda _, i: F.struct(_run(words, i, WINDOW).alias("h"), i.alias("i")))
        return _with(_with(F.sort_array(placed), twins), covered)

    runs = F.transform(words, lambda _, i: _run(words, i, half))
    suspect = _with(runs, lambda r: F.size(r) - F.size(F.array_distinct(r)) > half)
    return F.when(suspect, exact(words)).otherwise(F.lit(0).cast("long"))


def base_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts that rules are made of, all ``long``.

    Columns that no one uses are never computed.
    """
    text = F.coalesce("text", F.lit(""))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).alias("n"), F.length(F.array_join(words, "")).alias("chars"), repeated_words(words).alias("repeats")
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).alias("n"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("twice"))

    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    with_parts = docs.withColumns({"__words": _with(split_words(F.col("text")), of_words), "__lines": _with(lines, of_lines)})
    counts = {
        "n_words": F.col("__words.n"),
        "word_chars": F.col("__words.chars"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
        "n_dup_lines": F.col("__lines.twice"),
        "n_repeat_words": F.col("__words.repeats"),
        "n_lines": F.col("__lines.n"),
        "n_upper": F.regexp_count(text, F.lit(r"\p{Lu}")),
        "n_marks": F.regexp_count(text, F.lit(r"[!?]")),
    }
    return with_parts.withColumns({name: count.cast("long") for name, count in counts.items()}).drop("__words", "__lines")


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def _ratio(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0))


def features() -> dict[str, Column]:
    """Readable statistics that tests compare with thresholds."""
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": _ratio("word_chars", "n_words"),
        "symbols_per_word": _ratio("n_symbols", "n_words"),
        "marks_per_word": _ratio("n_marks", "n_words"),
        "upper_share": _ratio("n_upper", "word_chars"),
        "dup_line_share": _ratio("n_dup_lines", "n_lines"),
        "repeat_share": _ratio("n_repeat_words", "n_words"),
        "words_per_line": _ratio("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.cut if self.above else value <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Test, ...]


def _all(rule: Sequence[Test]) -> Column:
    met = F.lit(True)
    for test in rule:
        met = met & test.column()
    return met


def verdict(rules: Sequence[Rule]) -> Column:
    """The ordered conditional: the number of the first rule that a row meets, else null."""
    found = F.lit(None).cast("int")
    for number in reversed(range(len(rules))):
        found = F.when(_all(rules[number]), F.lit(number)).otherwise(found)
    return found


def _table(examples: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
    """Rejected and kept examples by feature and bin, at most a few hundred rows."""
    long = examples.select("bad", F.posexplode("bins").alias("feature", "bin"))
    counted = long.groupBy("feature", "bin").agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"))
    return {(r["feature"], r["bin"]): (r["bad"], r["good"]) for r in counted.collect()}


def _gain(before: tuple[int, int], after: tuple[int, int]) -> float:
    """FOIL's gain: examples won, times the information that each is worth."""
    if not after[0] or not before[0]:
        return 0.0
    return after[0] * (math.log2(after[0] / sum(after)) - math.log2(before[0] / sum(before)))


def _covered(counts: dict[tuple[int, int], tuple[int, int]], place: int, above: bool, cut: int) -> tuple[int, int]:
    """What a test covers: the bins over its cut, or up to it."""
    met = [n for (feature, b), n in counts.items() if feature == place and (b > cut) == above]
    return sum(n[0] for n in met), sum(n[1] for n in met)


def learn_rules(examples: DataFrame) -> list[Rule]:
    """Rules that reject, from rows of features with a boolean ``bad`` and a ``grow`` flag.

    ``grow`` parts rows for growing from rows for pruning and judging. Cuts are
    quantiles of either class; of tests that gain the same the one that rejects
    least wins.
    """
    names = list(features())
    shares = [0.01, 0.03] + [i / CUTS for i in range(1, CUTS)] + [0.97, 0.99]
    # Exact quantiles would sort everything; cuts only choose which tests are tried.
    quantiles = [examples.where(c).approxQuantile(names, shares, 0.001) for c in (F.col("bad"), ~F.col("bad"))]
    cuts = [sorted({cut for found in quantiles for cut in (found[place] or [])}) for place in range(len(names))]
    if not any(cuts):
        return []
    # A bin is the number of cuts below a value: value > cuts[k] exactly where bin > k.
    def bin_of(name: str, found: Sequence[float]) -> Column:
        below = F.filter(F.array(*[F.lit(c) for c in found]).cast("array<double>"), lambda cut: cut < F.col(name))
        return F.size(below)

    bins = [bin_of(name, found) for name, found in zip(names, cuts)]
    binned, _ = settle(examples.select("bad", "grow", F.array(*bins).alias("bins")))
    tests = [(place, above, k) for place, found in enumerate(cuts) for k in range(len(found)) for above in (True, False)]

    def met(rule: Sequence[tuple[int, bool, int]]) -> Column:
        all_met = F.lit(True)
        for place, above, k in rule:
            value = F.get("bins", place)
            all_met = all_met & ((value > k) if above else (value <= k))
        return all_met

    rules: list[list[tuple[int, bool, int]]] = []
    left = binned
    spent: set[tuple[int, bool]] = set()
    while True:
        rule: list[tuple[int, bool, int]] = []
        before = None
        while True:
            counts = _table(left.where("grow").where(met(rule)))
            before = before or (sum(n[0] for (f, _), n in counts.items() if f == 0), sum(n[1] for (f, _), n in counts.items() if f == 0))
            if before[0] < LEAST_COVER or not before[1]:
                break
            covers = {test: _covered(counts, *test) for test in tests if rule or test[:2] not in spent}
            best = max(covers, key=lambda t: (_gain(before, covers[t]), -sum(covers[t]), t[2] if t[1] else -t[2]), default=None)
            if best is None or _gain(before, covers[best]) <= 0:
                break
            rule.append(best)
            before = covers[best]
        # Prune: the shortest beginning that judges best on rows it did not grow from.
        starts = [rule[:n] for n in range(1, len(rule) + 1)]
        if not starts:
            break
        sums = [f(met(s) & c) for s in starts for f, c in ((F.count_if, F.col("bad")), (F.count_if, ~F.col("bad")))]
        row = left.where("not grow").agg(*[c.alias(f"c{i}") for i, c in enumerate(sums)]).first()
        judged_by = list(zip(row[::2], row[1::2]))
        worth = [(bad - good) / (bad + good) if bad + good else -1.0 for bad, good in judged_by]
        best = max(range(len(starts)), key=lambda i: (worth[i], -i))
        bad, good = judged_by[best]
        if bad < LEAST_COVER or bad < LEAST_PRECISION * (bad + good):
            # Set this start aside and try one by another feature or from its other side.
            spent.add(rule[0][:2])
            continue
        rules.append(starts[best])
        left = left.where(~met(starts[best]))
        spent.clear()
    return [tuple(Test(names[place], above, cuts[place][k]) for place, above, k in rule) for rule in rules]


def labelled_examples(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Features of about ``fit_rows`` labelled documents that pass the base rule."""
    marks = labels.where("doc_id is not null and quality is not null").select(F.col("doc_id").alias("__id"), (F.col("quality") == 0).alias("bad"))
    total = marks.count()
    draw = F.pmod(F.xxhash64("__id", F.lit("fit")), F.lit(1_000_000))
    marks, drawn = settle(marks.where(draw < 1_000_000 * min(1.0, fit_rows / max(total, 1))))
    # Two narrow columns of at most a few times fit_rows rows; more would be joined by shuffle.
    marks = F.broadcast(marks) if drawn <= 4 * fit_rows else marks
    known = base_statistics(docs.select("doc_id", "text").join(marks, F.col("doc_id") == F.col("__id")))
    grow = F.pmod(F.xxhash64("doc_id", F.lit("grow")), F.lit(3)) > 0
    known = known.where(~base_failed()).select("bad", grow.alias("grow"), *[c.alias(n) for n, c in features().items()])
    return settle(known)[0]


def judged(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``docs`` with base counts, ``base_failed``, the ``rule`` that rejects it, if any, and ``kept``."""
    counted = base_statistics(docs)
    named = counted.withColumns({**features(), "base_failed": base_failed()})
    named = named.withColumn("rule", verdict(rules))
    return named.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict for every document, by rules learned from the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = learn_rules(labelled_examples(docs, table(spark, sf_dir, "labels")))
    return judged(docs, rules).select("doc_id", *BASE, "base_failed", "kept", "rule")


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that the base rule or a learned rule rejects."""
    rules = learn_rules(labelled_examples(docs, labels))
    whole = docs.select(F.struct(*docs.columns).alias("__row"), "text")
    return judged(whole, rules).where("kept").select("__row.*")

"""Toxic spans by a linear-chain conditional random field.

Tokens are runs of letters, sequences are sentences (up to ``LONGEST`` tokens).
The field tags each token as outside, first or later in a toxic span. Features
are the token, its neighbours, its ending and its capitals, by hash; those seen
fewer than ``LEAST`` times in fitting weigh nothing. Tags that follow one another
have weights too.

Labels come for documents, so tokens are labelled first: a word, or a pair of
words, is telling if documents that hold it are toxic far more often than chance
allows, over all words that were tried, and most of them are. Telling words of
toxic documents are tagged, all else is outside, also telling words of clean
documents. The field learns how far each word is to be trusted and where.

Forward and backward sums give each token its chance of a tag, and each
sentence its chance of having no toxic token. A document's hazard adds up the
logarithms of the latter and is reported; its surest token gives the score by a
logistic curve fitted on documents. Runs of tokens that are more likely in a span
than not are the offending offsets.

Fitting takes about ``FIT_ROWS`` labelled documents and at most ``FIT_SENTENCES``
sentences with telling words and as many without, which weigh what they stand
for. Documents and sentences are drawn by hashes of themselves, and copies count
once. Every row and whole text is scored.

Defined cases: a null text is an empty one; both score like a document without
any telling word. Without labelled documents to learn from all scores are 0. If a
document has several labels the largest counts; null labels and labels without a
document are left out. A null doc_id is never learned from and not held out. Rows
may repeat, extra columns are ignored. Offsets count code points.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm.common import mapped, table
from layerkit.llm.samples import drawn, independent, labelled_sample
from layerkit.llm.shingles import _BACK, _BASE, _BYTE, _LOWER, _power, mix, text_chunks
from layerkit.sources.scratch import settle

SLOTS = 1 << 18
FIT_ROWS = 8_000
FIT_SENTENCES = 15_000
LONGEST = 64
TAGS = 3
OUTSIDE, FIRST, LATER = range(TAGS)
STEPS = 80
PENALTY = 1.0
SIGNIFICANCE = 0.01
LEAST = 3
TOXIC = 0.5
ENDING = 3
_SALTS = mix(np.arange(1, 7, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_NO_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
_ENDS = np.array([chr(b) in ".!?\n" for b in range(256)])
_UPPER = np.array([65 <= b <= 90 for b in range(256)])


@dataclass(frozen=True)
class Tokens:
    """Tokens of a run of texts; ``begin`` has the first token of each text, and of what follows."""

    starts: np.ndarray
    stops: np.ndarray
    hashes: np.ndarray
    endings: np.ndarray
    capitals: np.ndarray
    opens: np.ndarray  # whether a token opens a sentence
    begin: np.ndarray


def tokens(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    """Runs of letters, compared without case, cut where a text ends."""
    inside = ~_NO_LETTER[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[data]] * _power("up", _BASE, len(data)), out=sums[1:])
    back = _power("down", _BACK, len(data))
    whole = mix((sums[stops] - sums[starts]) * back[starts] + (stops - starts).astype(np.uint64))
    tail = np.maximum(starts, stops - ENDING)
    ending = mix((sums[stops] - sums[tail]) * back[tail] + np.uint64(99))
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    big = upper[stops] - upper[starts]
    capitals = np.where(big == 0, 0, np.where(big == stops - starts, 2, np.where(_UPPER[data[starts]], 1, 3))) if len(starts) else big
    begin = np.searchsorted(starts, offsets)
    ended = np.concatenate([[0], np.cumsum(_ENDS[data])])[starts]
    opens = np.ones(len(starts), bool)
    opens[1:] = ended[1:] != ended[:-1]
    opens[begin[begin < len(starts)]] = True
    # A longer sentence is cut every LONGEST tokens.
    since = np.arange(len(starts))
    if len(since):
        since = since - np.maximum.accumulate(np.where(opens, since, 0))
        opens |= since % LONGEST == 0
    return Tokens(starts, stops, whole, ending, capitals, opens, begin)


def features_of(found: Tokens) -> np.ndarray:
    """Hashed features of each token: itself, its neighbours in the sentence, its ending, its capitals."""
    n = len(found.hashes)
    before, after = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    if n:
        before[1:] = np.where(found.opens[1:], np.uint64(0), found.hashes[:-1])
        after[:-1] = np.where(found.opens[1:], np.uint64(0), found.hashes[1:])
    parts = (found.hashes, before, after, found.endings, found.capitals.astype(np.uint64))
    return np.stack([mix(part ^ salt) for part, salt in zip(parts, _SALTS)], axis=1)


@dataclass(frozen=True)
class Plan:
    """Sentences, longest first, laid out place by place: all first tokens, all second ones, and so on."""

    order: np.ndarray  # token numbers in that layout
    active: np.ndarray  # sentences that have a token at each place
    sentences: np.ndarray  # numbers of the sentences, longest first

    @staticmethod
    def of(opens: np.ndarray) -> Plan:
        first = np.flatnonzero(opens)
        lengths = np.diff(np.append(first, len(opens)))
        by_length = np.argsort(-lengths, kind="stable")
        active = np.array([np.count_nonzero(lengths > place) for place in range(int(lengths.max(initial=0)))], int)
        order = np.concatenate([first[by_length[:n]] + place for place, n in enumerate(active)]) if len(active) else np.zeros(0, int)
        return Plan(order, active, by_length)


@dataclass(frozen=True)
class Field:
    """Weights of features by tag, of any token, of a sentence's first tag and of tags that follow.

    A feature has its weights in the slot of its low bits, where ``keys`` holds
    all its bits: one that was not learned weighs nothing.
    """

    keys: np.ndarray
    weights: np.ndarray
    any_token: np.ndarray
    opening: np.ndarray
    following: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        total = np.tile(self.any_token, (len(features), 1))
        for column in range(features.shape[1]):
            slot = features[:, column] & np.uint64(len(self.keys) - 1)
            known = np.flatnonzero(self.keys[slot] == features[:, column])
            total[known] += self.weights[slot[known]]
        return total

    def sums(self, scores: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chances of each token's tags, of each pair of tags by token, and each sentence's log sum.

        Everything is in the layout of the plan. Forward sums are scaled at each place.
        """
        top = scores.max(axis=1, keepdims=True) if len(scores) else scores
        own, step = np.exp(scores - top), np.exp(self.following)
        forward, scale = np.empty_like(own), np.empty(len(own))
        ends = np.concatenate([[0], np.cumsum(plan.active)]).astype(int)
        total = np.zeros(plan.active[0] if len(plan.active) else 0)
        for place, n in enumerate(plan.active):
            here = slice(ends[place], ends[place] + n)
            came = forward[ends[place - 1] : ends[place - 1] + n] @ step if place else np.exp(self.opening)[None, :]
            made = own[here] * came
            scale[here] = made.sum(axis=1)
            forward[here] = made / scale[here, None]
            total[:n] += np.log(scale[here]) + top[here, 0]
        backward = np.ones_like(own)
        pairs = np.zeros((len(own), TAGS, TAGS))
        for place in range(len(plan.active) - 1, 0, -1):
            n = plan.active[place]
            here, earlier = slice(ends[place], ends[place] + n), slice(ends[place - 1], ends[place - 1] + n)
            ahead = own[here] * backward[here] / scale[here, None]
            pairs[here] = forward[earlier][:, :, None] * step[None] * ahead[:, None, :]
            backward[earlier] = ahead @ step.T
        return forward * backward, pairs, total

    def calm(self, scores: np.ndarray, plan: Plan) -> np.ndarray:
        """Log weight of each sentence, in the plan's order, with no token in a span."""
        if not len(plan.active):
            return np.zeros(0)
        total = np.full(plan.active[0], self.opening[OUTSIDE])
        at = 0
        for place, n in enumerate(plan.active):
            total[:n] += scores[at : at + n, OUTSIDE] + (self.following[OUTSIDE, OUTSIDE] if place else 0.0)
            at += n
        return total


def least_of(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], at: np.ndarray) -> np.ndarray:
    """Minimum of a convex function by limited-memory quasi-Newton steps, halved until the loss falls enough."""
    value, slope = loss(at)
    kept: deque[tuple[np.ndarray, np.ndarray]] = deque(maxlen=8)
    for _ in range(STEPS):
        direction, parts = -slope, []
        for moved, bent in reversed(kept):
            part = (moved @ direction) / (moved @ bent)
            direction = direction - part * bent
            parts.append(part)
        if kept:
            moved, bent = kept[-1]
            direction = direction * (moved @ bent) / (bent @ bent)
        for (moved, bent), part in zip(kept, reversed(parts)):
            direction = direction + (part - (bent @ direction) / (moved @ bent)) * moved
        length = 1.0 if kept else 1 / max(float(np.abs(slope).sum()), 1.0)
        for _ in range(30):
            tried, its_slope = loss(at + length * direction)
            if tried <= value + 1e-4 * length * (slope @ direction):
                break
            length /= 2
        else:
            return at
        moved, bent = length * direction, its_slope - slope
        if moved @ bent > 0:
            kept.append((moved, bent))
        done = value - tried < 1e-9 * max(abs(value), 1e-9)
        at, value, slope = at + moved, tried, its_slope
        if done:
            break
    return at


def fit_field(features: np.ndarray, opens: np.ndarray, tags: np.ndarray, weight: np.ndarray) -> Field:
    """The most likely field under a normal prior; ``weight`` is what a token's sentence stands for."""
    plan = Plan.of(opens)
    features, tags, weight = features[plan.order], tags[plan.order], weight[plan.order]
    seen, place, times = np.unique(features, return_inverse=True, return_counts=True)
    # Rare features weigh nothing, so the field also learns about tokens it does not know.
    learned = times >= LEAST
    known = seen[learned]
    place = np.where(learned, np.cumsum(learned) - 1, len(known))[place.reshape(features.shape)]
    share = (weight / max(weight.sum(), 1.0))[:, None]
    gold = np.eye(TAGS)[tags]
    n = len(known) * TAGS
    ends = np.concatenate([[0], np.cumsum(plan.active)]).astype(int)
    came = np.zeros((len(tags), TAGS, TAGS))
    for at, active in list(enumerate(plan.active))[1:]:
        here, earlier = slice(ends[at], ends[at] + active), slice(ends[at - 1], ends[at - 1] + active)
        came[here] = gold[earlier][:, :, None] * gold[here][:, None, :]
    first = slice(0, plan.active[0] if len(plan.active) else 0)

    def parts(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        weights, any_token, opening, following = np.split(flat, [n, n + TAGS, n + 2 * TAGS])
        return weights.reshape(-1, TAGS), any_token, opening, following.reshape(TAGS, TAGS)

    def loss(flat: np.ndarray) -> tuple[float, np.ndarray]:
        weights, any_token, opening, following = parts(flat)
        padded = np.concatenate([weights, np.zeros((1, TAGS))])
        scores = any_token + sum(padded[place[:, column]] for column in range(place.shape[1]))
        chances, pairs, total = Field(seen, padded, any_token, opening, following).sums(scores, plan)
        off = (chances - gold) * share
        by_weight = np.stack([
            sum(np.bincount(place[:, column], off[:, tag], minlength=len(known) + 1) for column in range(place.shape[1])) for tag in range(TAGS)
        ], axis=1)[:-1]
        by_pair = ((pairs - came) * share[:, :, None]).sum(axis=0)
        gradient = np.concatenate([by_weight.ravel(), off.sum(axis=0), off[first].sum(axis=0), by_pair.ravel()]) + ridge * flat
        fits = (scores * gold * share).sum() + (opening * gold[first] * share[first]).sum() + (following * (came * share[:, :, None]).sum(axis=0)).sum()
        return float((total * share[first, 0]).sum() - fits + ridge / 2 * (flat @ flat)), gradient

    ridge = PENALTY / max(weight.sum(), 1.0)
    flat = least_of(loss, np.zeros(n + TAGS + TAGS + TAGS * TAGS))
    weights, any_token, opening, following = parts(flat)
    keys, table = np.zeros(SLOTS, np.uint64), np.zeros((SLOTS, TAGS), np.float32)
    # Of features that share a slot the one that tells tags apart most comes last and stays.
    order = np.argsort(np.ptp(weights, axis=1), kind="stable")
    slot = (known & np.uint64(SLOTS - 1))[order]
    keys[slot], table[slot] = known[order], weights[order]
    return Field(keys, table, any_token, opening, following)


@dataclass(frozen=True)
class Model:
    field: Field
    curve: np.ndarray  # constant, and slope over the surest token

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_inputs(evidence) @ self.curve, -30, 30)))


def _inputs(evidence: np.ndarray) -> np.ndarray:
    """A constant, and the odds of the surest token by their logarithm.

    Hazards add up over a long text without any sure token, so they say less of a document.
    """
    surest = np.clip(evidence[:, 1], 1e-6, 1 - 1e-6)
    return np.stack([np.ones(len(evidence)), np.log(surest / (1 - surest))], axis=1)


def fit_curve(evidence: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    inputs, curve = _inputs(evidence), np.zeros(2)
    ridge = np.diag([1e-6, 1e-3]) * max(len(toxic), 1)
    for _ in range(30):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ curve, -30, 30)))
        slope = inputs.T @ (toxic - chance) - ridge @ curve
        bend = (inputs * (chance * (1 - chance))[:, None]).T @ inputs + ridge
        curve = curve + np.clip(np.linalg.solve(bend, slope), -5, 5)
    return curve


def _read(field: Field, found: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """``(hazard, surest chance)`` of each text, and each token's chance of standing in a span."""
    texts = len(found.begin) - 1
    if not len(found.starts):
        return np.zeros((texts, 2)), np.zeros(0)
    plan = Plan.of(found.opens)
    scores = field.scores(features_of(found)[plan.order]).astype(np.float64)
    chances, _, total = field.sums(scores, plan)
    toxic = np.empty(len(plan.order))
    toxic[plan.order] = np.clip(1 - chances[:, OUTSIDE], 0, 1)
    hazard = np.empty(len(total))
    hazard[plan.sentences] = np.maximum(total - field.calm(scores, plan), 0)
    text_of = np.searchsorted(found.begin, np.flatnonzero(found.opens), "right") - 1
    evidence = np.zeros((texts, 2))
    evidence[:, 0] = np.bincount(text_of, hazard, minlength=texts)
    np.maximum.at(evidence[:, 1], np.searchsorted(found.begin, np.arange(len(toxic)), "right") - 1, toxic)
    return evidence, toxic


def _spans(data: np.ndarray, offsets: np.ndarray, found: Tokens, toxic: np.ndarray) -> list[str]:
    """Offending runs of tokens of each text as ``start:end`` in code points."""
    spans = [""] * (len(offsets) - 1)
    hit = np.flatnonzero(toxic >= TOXIC)
    if not len(hit):
        return spans
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    text_of = np.searchsorted(found.begin, hit, "right") - 1
    parts: dict[int, list[list[int]]] = {}
    for place, (token, text) in enumerate(zip(hit.tolist(), text_of.tolist())):
        own = parts.setdefault(text, [])
        start, stop = (int(points[at] - points[offsets[text]]) for at in (found.starts[token], found.stops[token]))
        if own and place and hit[place - 1] == token - 1 and not found.opens[token]:
            own[-1][1] = stop
        else:
            own.append([start, stop])
    for text, own in parts.items():
        spans[text] = ",".join(f"{a}:{b}" for a, b in own)
    return spans


def held_out() -> Column:
    """The fold that is never learned from: a checksum of the doc_id's text."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words and pairs of neighbours of each document."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy()
        for row, data, offsets in text_chunks(batch.column("text")):
            found = tokens(data, offsets)
            pairs = mix(found.hashes[:-1] + (found.hashes[1:] << np.uint64(1)))
            for text in range(len(offsets) - 1):
                low, high = found.begin[text], found.begin[text + 1]
                for kind, hashes in ((1, found.hashes[low:high]), (2, pairs[low : max(low, high - 1)][~found.opens[low + 1 : high]])):
                    own = np.unique(hashes)
                    arrays = [own.view(np.int64), np.full(len(own), kind, np.int32), np.full(len(own), toxic[row + text], np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["word", "kind", "toxic"])


def telling_words(sample: DataFrame, documents: int, toxic: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of telling words, and of telling pairs neither of whose words tells.

    A word tells if it stands in toxic documents more often than chance allows, at
    ``SIGNIFICANCE`` over all words tried, and if most of its documents are toxic.
    """
    counted = mapped(sample.select("toxic", "text"), _words, "word long, kind int, toxic int").groupBy("kind", "word")
    counted, tried = settle(counted.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("bad")))
    if not tried or not toxic or toxic == documents:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    # Chernoff's bound on the chance of so many toxic documents among those that hold the word.
    least, share = math.log(tried / SIGNIFICANCE), toxic / documents
    rate = F.col("bad") / F.col("n")
    clean = F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - share))).otherwise(0.0)
    surprise = F.when(rate > share, F.col("n") * (rate * F.log(rate / share) + clean)).otherwise(0.0)
    found = counted.where((surprise > least) & (rate > TOXIC)).select("kind", "word").collect()
    words, pairs = (np.array(sorted(r["word"] for r in found if r["kind"] == kind), np.int64).view(np.uint64) for kind in (1, 2))
    return words, pairs


def _tags(found: Tokens, words: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Tags of telling tokens; runs within a sentence are one span."""
    tells = np.isin(found.hashes, words)
    if len(pairs) and len(found.hashes) > 1:
        joined = mix(found.hashes[:-1] + (found.hashes[1:] << np.uint64(1)))
        both = np.isin(joined, pairs) & ~found.opens[1:] & ~tells[:-1] & ~tells[1:]
        tells[:-1] |= both
        tells[1:] |= both
    tags = np.where(tells, FIRST, OUTSIDE)
    if len(tags):
        tags[1:][tells[1:] & tells[:-1] & ~found.opens[1:]] = LATER
    return tags


def _sentences(words: np.ndarray, pairs: np.ndarray):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_numpy()
            for row, data, offsets in text_chunks(batch.column("text")):
                found = tokens(data, offsets)
                features, telling = features_of(found), _tags(found, words, pairs)
                text_of = np.searchsorted(found.begin, np.arange(len(telling)), "right") - 1
                tags = np.where(toxic[row + text_of] == 1, telling, OUTSIDE)
                edges = np.append(np.flatnonzero(found.opens), len(tags))
                rows = []
                for number, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                    rows.append((bool((telling[a:b] != OUTSIDE).any()), row * 1_000_003 + number, features[a:b].tobytes(), tags[a:b].astype(np.int8).tobytes()))
                if rows:
                    kinds = [pa.bool_(), pa.int64(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["tells", "number", "features", "tags"])

    return cut


def _weighers(field: Field):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_read(field, tokens(data, offsets))[0] for _, data, offsets in text_chunks(batch.column("text"))]
            evidence = np.concatenate(parts) if parts else np.zeros((0, 2))
            arrays = [batch.column("toxic"), pa.array(evidence[:, 0]), pa.array(evidence[:, 1])]
            yield pa.RecordBatch.from_arrays(arrays, names=["toxic", "hazard", "surest"])

    return weigh


def sampled(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """About ``fit_rows`` labelled documents outside the held-out fold without copies, as ``(toxic, text)``."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    marks = marks.groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").cast("int").alias("toxic"))
    return independent(labelled_sample(docs, marks, fit_rows, "toxic"), "toxic")


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, fit_sentences: int = FIT_SENTENCES) -> Model | None:
    """Field and curve from a bounded sample; None if no labelled document may be learned from."""
    sample = sampled(docs, labels, fit_rows)
    documents, toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not documents:
        return None
    words, pairs = telling_words(sample, documents, toxic)
    cut, _ = settle(mapped(sample, _sentences(words, pairs), "tells boolean, number long, features binary, tags binary"))
    counts = {r["tells"]: r["n"] for r in cut.groupBy("tells").agg(F.count(F.lit(1)).alias("n")).collect()}
    rate = {tells: min(1.0, fit_sentences / n) for tells, n in counts.items()}
    picked = cut.where(F.when(F.col("tells"), drawn(rate.get(True, 1.0), "features", "number")).otherwise(drawn(rate.get(False, 1.0), "features", "number")))
    rows = sorted((bytes(r["features"]), bytes(r["tags"]), r["tells"]) for r in picked.select("features", "tags", "tells").collect())
    width = len(_SALTS) - 1
    features = np.frombuffer(b"".join(r[0] for r in rows), np.uint64).reshape(-1, width)
    tags = np.frombuffer(b"".join(r[1] for r in rows), np.int8).astype(int)
    lengths = np.array([len(r[1]) for r in rows], int)
    opens = np.zeros(len(tags), bool)
    opens[np.cumsum(lengths) - lengths] = True
    field = fit_field(features, opens, tags, np.repeat([1 / rate[r[2]] for r in rows], lengths))
    seen = mapped(sample, _weighers(field), "toxic int, hazard double, surest double").toArrow()
    evidence = np.stack([seen["hazard"].to_numpy(), seen["surest"].to_numpy()], axis=1)
    order = np.lexsort(evidence.T)
    return Model(field, fit_curve(evidence[order], seen["toxic"].to_numpy()[order].astype(float)))


_DDL = "doc_id long, held_out boolean, score double, predicted int, hazard double, spans string"


def _scorer(model: Model | None):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            evidence, spans = np.zeros((batch.num_rows, 2)), [""] * batch.num_rows
            if model is not None:
                for first, data, offsets in text_chunks(batch.column("text")):
                    found = tokens(data, offsets)
                    last = first + len(offsets) - 1
                    evidence[first:last], toxic = _read(model.field, found)
                    spans[first:last] = _spans(data, offsets, found, toxic)
            scores = model.score(evidence) if model is not None else np.zeros(batch.num_rows)
            made = [pa.array(scores), pa.array((scores >= TOXIC).astype(np.int32)), pa.array(evidence[:, 0]), pa.array(spans, pa.string())]
            names = ["doc_id", "held_out", "score", "predicted", "hazard", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *made], names=names)

    return score


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """Score, verdict and offending offsets of each row; the model is all that is sent along."""
    return mapped(docs.select("doc_id", held_out().alias("held_out"), "text"), _scorer(model), _DDL)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, by a model that never saw the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scored(docs, train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")))

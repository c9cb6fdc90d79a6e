"""Toxic passages by maximum-scoring segments of token log-odds.

Tokens are lower-cased runs of letters and digits. A token's features are itself and its first 4, 5 and 6
letters, so that inflected words share what is known of their stem. Each feature weighs the log-odds of toxic against
other training documents that hold it, with an informative Dirichlet prior (PRIOR documents, toxic and other as all
are). Its significance is the signed root of the log-likelihood ratio of its counts, which stays finite where one kind has none.
Features with less than LEAST_Z are neutral; a token takes its most
significant feature's weight, and a token without one costs the drift. A linear scan then finds all disjoint maximal
segments of a text. A segment's score is judged by extreme-value statistics: the chance that a text of this length
without toxic passages holds a segment as good is 1 - exp(-K n exp(-lambda S)); lambda solves E[exp(lambda s)] = 1 over the
scores of other training text. Segments with a chance below `significance` are the toxic passages.

A document's evidence is its segments' joint surplus over that extreme-value distribution; a logistic curve through
the evidence of all training documents, kept as a histogram of bounded size, turns it into a score from 0 to 1.

The lexicon is sent to every task and holds at most LEXICON features, the most significant. What is significant beyond them stays a
table that is joined to the texts by their features; a bitmap keeps features out that it cannot have. Counts cover all training text.

Defined cases: null and empty texts have no tokens and no segment; labels that are null, or whose document is absent,
teach nothing; ids that repeat in labels count once, with the highest label; with labels of one kind only every score is
that kind's; without labels it is 0; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import bounded, fold, stage, texts

LEXICON = 200_000
LEAST_Z = 4.0
PRIOR = 1.0
SIGNIFICANCE = 0.01
HELD = 300_000
BIN = 0.25
TOP_BIN = 400
BITS = 1 << 27

TOKEN = re.compile(r"[^\W_]+")


def tokens_of(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def features_of(token: str) -> tuple[str, ...]:
    """The token, and its beginnings marked by a hyphen that no token has."""
    return (token, *(token[:k] + "-" for k in (4, 5, 6) if len(token) > k))


class Weights(dict):
    """Weight by token (None: neutral), worked out on first sight. Emptied when full, so it is bounded."""

    def __init__(self, lexicon: dict[str, tuple[float, float]], below: dict[str, tuple[float, float]] | None = None):
        super().__init__()
        self.lexicon, self.below = lexicon, below or {}

    def __missing__(self, token: str) -> float | None:
        if len(self) >= HELD:
            self.clear()
        known = [at[f] for at in (self.lexicon, self.below) for f in features_of(token) if f in at]
        value = self[token] = max(known, key=lambda x: abs(x[1]))[0] if known else None
        return value


def marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text and toxic of the labelled rows outside the held-out fold.

    Up to a bound the labels (a long and an int each) are sent to the texts; more are joined by a shuffle.
    """
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    return texts(docs).join(bounded(marks, "toxicity-labels"), "doc_id").where(fold("doc_id", 5) != 0).select("doc_id", "text", "toxic")


def count_tokens(rows: DataFrame) -> DataFrame:
    """token (a feature), n_toxic, n_other: how many documents hold it. Each task adds up before the shuffle and sends what it holds when it holds HELD tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            keys = list(held[1].keys() | held[0].keys())
            columns = [pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in (held[1], held[0]))]
            for c in held:
                c.clear()
            return pa.RecordBatch.from_arrays(columns, ["token", "n_toxic", "n_other"])

        for batch in batches:
            for text, toxic in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                held[toxic == 1].update({f for t in set(tokens_of(text)) for f in features_of(t)})
                if len(held[0]) + len(held[1]) >= HELD:
                    yield out()
        yield out()

    parts = rows.mapInArrow(count, "token string, n_toxic long, n_other long")
    return parts.groupBy("token").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_other").alias("n_other"))


@dataclass
class Model:
    """Weight and significance of features, the cost of other tokens, the extreme-value parameters, the calibration."""

    lexicon: dict[str, tuple[float, float]]
    drift: float
    lam: float = 1.0
    k: float = 0.1
    slope: float = 1.0
    middle: float = 0.0
    constant: float | None = None

    def chance(self, score: float, length: int) -> float:
        """That a text of `length` tokens without a toxic passage holds a segment of this score or more."""
        return 1.0 - exp(-self.k * length * exp(-min(self.lam * score, 700.0)))

    def surplus(self, score: float, length: int) -> float:
        """How far a score lies above the middle of that distribution, in its own unit."""
        return self.lam * score - log(self.k * max(length, 1))

    def evidence(self, found: list[tuple[float, int, int]], length: int) -> float:
        return sum(max(0.0, self.surplus(s, length)) for s, _, _ in found)

    def score(self, evidence: float) -> float:
        if self.constant is not None:
            return self.constant
        return 1.0 / (1.0 + exp(-max(-50.0, min(50.0, self.slope * (evidence - self.middle)))))


def segments(tokens: list[str], weights: Weights, drift: float) -> list[tuple[float, int, int]]:
    """All maximal segments as (score, first, last + 1), disjoint, in text order; time is linear in the tokens.

    A stack holds candidates with the running sums before and after them; a new positive token joins every earlier
    candidate whose sum before is lower and whose sum after is not higher.
    """
    hits = [(i, s) for i, t in enumerate(tokens) if (s := weights[t]) is not None]
    stack: list[tuple[float, float, int, int, int]] = []  # sums before and after, first, last, nearest candidate below
    total, seen = 0.0, 0
    for i, s in hits:
        total += drift * (i - seen)
        seen = i + 1
        before, total = total, total + s
        if s <= 0:
            continue
        after, first, j = total, i, len(stack) - 1
        while True:
            while j >= 0 and stack[j][0] >= before:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= after:
                break
            before, _, first, _, link = stack[j]
            del stack[j:]
            j = link
        stack.append((before, after, first, i + 1, j))
    return [(after - before, first, last) for before, after, first, last, _ in stack]


def significant(counts: DataFrame, least_z: float = LEAST_Z) -> DataFrame:
    """token, odds, z of the significant features, and the share of other text that each makes up; the totals come as one row."""
    total = counts.agg(
        F.coalesce(F.sum("n_toxic"), F.lit(0)).alias("t"), F.coalesce(F.sum("n_other"), F.lit(0)).alias("o")
    ).first()
    t, o = float(total.t), float(total.o)
    whole = max(t + o, 1.0)
    toxic, other = F.col("n_toxic"), F.col("n_other")
    a, b = toxic + PRIOR * t / whole, other + PRIOR * o / whole

    def part(n: Column, expected: Column) -> Column:
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

    held, rest = toxic + other, F.lit(whole) - (toxic + other)
    ratio = part(toxic, held * t / whole) + part(other, held * o / whole) + part(t - toxic, rest * t / whole) + part(o - other, rest * o / whole)
    return (
        counts.where(F.lit(bool(t and o)))
        .withColumn("odds", F.log(a / (t + PRIOR - a)) - F.log(b / (o + PRIOR - b)))
        .withColumn("z", F.signum("odds") * F.sqrt(2 * F.greatest(ratio, F.lit(0.0))))
        .where(F.abs("z") >= least_z)
        .select("token", "odds", "z", (b / (o + PRIOR)).alias("share"))
    )


def lexicon(found: DataFrame, size: int) -> tuple[dict[str, tuple[float, float]], dict[str, float], DataFrame | None]:
    """(log-odds, z) and share of the `size` most significant features, and the table of the others, if there are any."""
    rows = found.orderBy(F.desc(F.abs("z")), "token").limit(size + 1).collect()
    others = None
    if len(rows) > size:
        last = rows.pop()
        others = found.where((F.abs("z") < abs(last.z)) | ((F.abs("z") == abs(last.z)) & (F.col("token") >= last.token)))
    return {r.token: (r.odds, r.z) for r in rows}, {r.token: r.share for r in rows}, others


def bit_of(token: str) -> int:
    return xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass")) % BITS


def bitmap(others: DataFrame) -> np.ndarray:
    """A bit for the hash of every feature, of a fixed size."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.fromiter(map(bit_of, batch.column(0).to_pylist()), np.int64, batch.num_rows))
            yield pa.RecordBatch.from_arrays([pa.array(at // 32768), pa.array(at % 32768)], ["part", "bit"])

    bits = np.zeros(BITS // 8, np.uint8)
    parts = others.select("token").mapInArrow(mark, "part long, bit long").groupBy("part").agg(F.collect_set("bit").alias("bits"))
    for r in parts.toLocalIterator():
        at = r.part * 32768 + np.array(r.bits, np.int64)
        np.bitwise_or.at(bits, at // 8, (1 << (at % 8)).astype(np.uint8))
    return bits


def with_others(rows: DataFrame, others: DataFrame | None) -> DataFrame:
    """The rows, and beside them `known`: the features of the text that the table beyond the lexicon holds (null: none)."""
    kind = "array<struct<token:string,odds:double,z:double>>"
    if others is None:
        return rows.withColumn("known", F.lit(None).cast(kind))
    sent = rows.sparkSession.sparkContext.broadcast(bitmap(others))  # BITS / 8 bytes
    rows = rows.withColumn("th", F.xxhash64("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        has: dict[str, bool] = {}
        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, h, text in zip(ids, hashes, batch.column(2).to_pylist(), strict=True):
                held = []
                for f in {f for t in set(tokens_of(text)) for f in features_of(t)}:
                    if f not in has:
                        if len(has) >= HELD:
                            has.clear()
                        at = bit_of(f)
                        has[f] = bool(bits[at // 8] >> (at % 8) & 1)
                    if has[f]:
                        held.append(f)
                n = len(held)
                yield pa.RecordBatch.from_arrays([pa.array([i] * n, pa.int64()), pa.array([h] * n, pa.int64()), pa.array(held, pa.string())], ["did", "hash", "token"])

    held = rows.select("doc_id", "th", "text").mapInArrow(features, "did long, hash long, token string").distinct()
    known = held.join(others, "token").groupBy("did", "hash").agg(F.collect_list(F.struct("token", "odds", "z")).alias("known"))
    return rows.join(known, F.col("doc_id").eqNullSafe(F.col("did")) & (F.col("th") == F.col("hash")), "left").drop("th", "did", "hash")


def weights_of(weights: Weights, known: list[dict] | None) -> Weights:
    """The weights for one text: those of the lexicon, or with what is known beyond it."""
    return Weights({x["token"]: (x["odds"], x["z"]) for x in known}, weights.lexicon) if known else weights


def karlin(scores: dict[str, tuple[float, float]], shares: dict[str, float], drift: float, others: DataFrame | None = None) -> tuple[float, float]:
    """lambda from E[exp(lambda s)] = 1 by bisection, and a K that bounds the chance: the share of rising tokens.

    Features beyond the lexicon come as sums of their shares by weight, in steps of 0.0001, so there are no more than some 400,000.
    """
    more = [] if others is None else others.groupBy(F.round("odds", 4).alias("odds")).agg(F.sum("share").alias("share")).collect()
    s = np.array([*(scores[t][0] for t in scores), *(r.odds for r in more), drift])
    p = np.array([*(shares[t] for t in scores), *(r.share for r in more), 0.0])
    p[-1] = max(0.0, 1.0 - p.sum())
    p = np.maximum(p, 1e-12)
    p /= p.sum()
    if s.max() <= 0:
        return 1.0, 1.0
    low, high = 0.0, 1.0
    mean = lambda lam: float((p * np.exp(np.minimum(lam * s, 300.0))).sum())
    while mean(high) < 1.0 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if mean(mid) < 1.0 else (low, mid)
    return max(low, 1e-3), float(np.clip(p[s > 0].sum(), 1e-9, 1.0))


def calibrate(rows: DataFrame, model: Model, others: DataFrame | None = None) -> Model:
    """A logistic curve through the evidence of all training documents, from a histogram of at most TOP_BIN bins."""
    sent = rows.sparkSession.sparkContext.broadcast(model)  # at most LEXICON features

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        weights = Weights(model.lexicon)
        for batch in batches:
            lists = [tokens_of(t) for t in batch.column(1).to_pylist()]
            more = batch.column(3).to_pylist()
            at = [model.evidence(segments(x, weights_of(weights, k), model.drift), len(x)) for x, k in zip(lists, more, strict=True)]
            bins = pa.array([min(TOP_BIN, int(e / BIN)) for e in at], pa.int32())
            yield pa.RecordBatch.from_arrays([bins, batch.column(2)], ["bin", "toxic"])

    at = with_others(rows, others).mapInArrow(weigh, "bin int, toxic int")
    bins = at.groupBy("bin").agg(F.count_if(F.col("toxic") == 1).alias("p"), F.count_if(F.col("toxic") != 1).alias("n")).collect()
    if not bins:
        model.constant = 0.0
        return model
    x = np.array([r.bin * BIN for r in bins])
    p, n = np.array([r.p for r in bins], float), np.array([r.n for r in bins], float)
    if not p.sum() or not n.sum():
        model.constant = 1.0 if p.sum() else 0.0
        return model
    def loss(slope: float, shift: float) -> float:
        z = slope * x + shift
        return float(((p + n) * np.logaddexp(0.0, z) - p * z).sum() + 0.005 * slope * slope)

    slope, shift = 0.5, -1.0
    for _ in range(200):
        q = 1 / (1 + np.exp(-np.clip(slope * x + shift, -50, 50)))
        g = (p - (p + n) * q).copy()
        h = (p + n) * q * (1 - q)
        grad = np.array([(g * x).sum() - 0.01 * slope, g.sum()])
        hess = np.array([[(h * x * x).sum() + 0.01, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        step = np.array([np.clip(step[0], -1, 1), np.clip(step[1], -2, 2)])
        # Kinds that evidence parts well make full steps overshoot.
        while np.abs(step).max() >= 1e-9 and loss(slope + step[0], shift + step[1]) > loss(slope, shift):
            step /= 2
        slope, shift = slope + step[0], shift + step[1]
        if np.abs(step).max() < 1e-9:
            break
    model.slope = float(max(slope, 1e-3))
    model.middle = float(-shift / model.slope)
    return model


def train(docs: DataFrame, labels: DataFrame) -> tuple[Model, DataFrame | None]:
    """The model, and the table of significant features beyond its lexicon, if there are any."""
    rows = marked(docs, labels)
    found = stage(significant(stage(count_tokens(rows), "toxicity-counts")), "toxicity-features")
    scores, shares, others = lexicon(found, LEXICON)
    drift = -0.5
    model = Model(scores, drift)
    model.lam, model.k = karlin(scores, shares, drift, others)
    return calibrate(rows, model, others), others


def passages(docs: DataFrame, model: Model, others: DataFrame | None = None, significance: float = SIGNIFICANCE) -> DataFrame:
    """doc_id, score, and the significant passages (first and last token, segment score, chance) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most LEXICON features

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        weights = Weights(model.lexicon)
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()), ("chance", pa.float64())]))
        for batch in batches:
            scored, found = [], []
            for text, known in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                tokens = tokens_of(text)
                parts = segments(tokens, weights_of(weights, known), model.drift)
                scored.append(model.score(model.evidence(parts, len(tokens))))
                tried = ((s, a, b, model.chance(s, len(tokens))) for s, a, b in parts)
                found.append([{"first": a, "last": b, "score": s, "chance": c} for s, a, b, c in tried if c < significance])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scored, pa.float64()), pa.array(found, kind)], ["doc_id", "score", "passages"])

    return with_others(texts(docs), others).mapInArrow(
        scan, "doc_id long, score double, passages array<struct<first:int,last:int,score:double,chance:double>>"
    )


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return passages(docs, *train(docs, labels))

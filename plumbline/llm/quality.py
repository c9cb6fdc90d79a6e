"""Quality rules: text statistics, and a decision list learned from labelled ones.

The statistics are computed for every whole text. A decision list is an ordered list of conjunctions of thresholds, each
of which rejects. It is learned by sequential covering: a conjunction is grown on two thirds of the labelled documents by
information gain, cut back on the other third, kept if it is right often enough there, and the documents it covers are
set aside before the next one. The list becomes one ordered Spark conditional over the statistics.

Learning uses at most LABELLED labelled documents, one per bucket of ids; counting and judging use all rows.

Defined cases: null and empty text have no words, so the base rule fails them; labels that are null, or whose document
is absent, teach nothing; ids that repeat in labels count once, with the lowest label; without labels, or without a rule that
is right often enough, the verdict is the base rule's; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import gram_hashes, stage, texts, words_of

LABELLED = 20_000
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_ended", "n_distinct")


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """How many words lie in a window of `window` words that the text holds twice or more."""
    grams = gram_hashes(hashes, window)
    if len(grams) < 2:
        return 0
    order = np.sort(grams)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    starts = np.isin(grams, twice)
    edge = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[str] = set()
    count = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            if line in seen:
                count += 1
            seen.add(line)
    return count


def counts_of(text: str) -> tuple[int, ...]:
    words = words_of(text)
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.bincount(data, minlength=256) if len(data) else np.zeros(256, np.int64)
    return (
        len(words),
        int(len(text) - kinds[9:14].sum() - kinds[32]),
        int(sum(kinds[ord(c)] for c in SYMBOLS)),
        repeated_lines(text),
        repeated_words(hashes),
        text.count("\n") + 1,
        int(kinds[65:91].sum()),
        int(kinds[48:58].sum()),
        int(sum(kinds[ord(c)] for c in ".!?")),
        len(set(words)),
    )


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and COUNTS of every row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [counts_of(text) for text in batch.column(1).to_pylist()]
            columns = zip(*rows, strict=True) if rows else [[] for _ in COUNTS]
            arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *COUNTS])

    return texts(docs).mapInArrow(count, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def features() -> dict[str, Column]:
    """What conditions compare: shares of words, characters or lines, and the length."""
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbols": F.col("n_symbols") / words,
        "same_lines": F.col("n_dup_lines") / lines,
        "repeats": F.col("n_repeat_words") / words,
        "upper": F.col("n_upper") / chars,
        "digits": F.col("n_digits") / chars,
        "ends": F.col("n_ended") / words,
        "distinct": F.col("n_distinct") / words,
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.at_least else x[self.feature] < self.threshold

    def column(self) -> Column:
        value = features()[self.feature]
        return value >= F.lit(self.threshold) if self.at_least else value < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), bool)
    for condition in rule:
        out &= condition.holds(x)
    return out


def _best_condition(x: dict[str, np.ndarray], bad: np.ndarray, inside: np.ndarray) -> tuple[float, Condition | None]:
    """The condition that gains most information about `bad` among the rows that are `inside`."""
    p0, n0 = int(bad[inside].sum()), int((~bad[inside]).sum())
    if not p0 or not n0:
        return 0.0, None
    before, best, found = log2(p0 / (p0 + n0)), 0.0, None
    for name, values in x.items():
        v, b = values[inside], bad[inside]
        order = np.argsort(v, kind="stable")
        v, b = v[order], b[order]
        cuts = np.flatnonzero(v[1:] > v[:-1]) + 1
        if not len(cuts):
            continue
        below = np.cumsum(b)[cuts - 1]
        for at_least, p, total in ((False, below, cuts), (True, p0 - below, len(v) - cuts)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / total) - before), -1.0)
            k = int(gain.argmax())
            if gain[k] > best + 1e-9:
                best = float(gain[k])
                found = Condition(name, at_least, float((v[cuts[k] - 1] + v[cuts[k]]) / 2))
    return best, found


def learn(
    x: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.9, least_covered: int = 5, seed: int = 3
) -> list[Rule]:
    """Rules that find bad rows, in order, each right for at least `precision` of what it covers in the pruning part."""
    rules: list[Rule] = []
    if not len(bad):
        return rules
    grow = np.random.default_rng(seed).random(len(bad)) < 2 / 3
    left = np.ones(len(bad), bool)
    while (bad & left & grow).any():
        rule: Rule = ()
        inside = left & grow
        while bad[inside].any() and not bad[inside].all():
            _, condition = _best_condition(x, bad, inside)
            if condition is None:
                break
            rule += (condition,)
            inside &= condition.holds(x)
        if not rule:
            break

        def worth(part: Rule) -> float:
            hit = covers(part, x) & left & ~grow
            p, n = int((bad & hit).sum()), int((~bad & hit).sum())
            return (p - n) / (p + n) if p + n >= least_covered else -1.0

        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda part: (worth(part), -len(part)))
        hit = covers(rule, x) & left
        pruning = hit & ~grow
        if pruning.sum() < least_covered or bad[pruning].mean() < precision:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def labelled_sample(stats: DataFrame, labels: DataFrame, bound: int = LABELLED) -> list:
    """At most `bound` labelled rows of statistics, one per bucket of ids, by a partial aggregate."""
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    rows = marks.withColumn("h", F.xxhash64("doc_id", F.lit("quality")))
    chosen = rows.groupBy(F.pmod("h", F.lit(bound)).alias("bucket")).agg(F.min(F.struct("h", "doc_id", "quality")).alias("r"))
    chosen = chosen.select("r.doc_id", "r.quality")
    picked = stats.join(F.broadcast(chosen), "doc_id")
    values = [column.alias(name) for name, column in features().items()]
    return picked.groupBy("doc_id", "quality").agg(*[F.min(c).alias(c) for c in COUNTS]).select("doc_id", "quality", *values).orderBy("doc_id").collect()


def train(stats: DataFrame, labels: DataFrame, bound: int = LABELLED) -> list[Rule]:
    rows = labelled_sample(stats, labels, bound)
    names = list(features())
    x = {n: np.array([r[n] for r in rows], float) for n in names}
    return learn(x, np.array([r.quality == 0 for r in rows], bool))


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one ordered conditional: false at the first rule that holds, else true."""
    out = F.when(base_failed(), F.lit(False))
    for rule in rules:
        hit = rule[0].column()
        for condition in rule[1:]:
            hit &= condition.column()
        out = out.when(hit, F.lit(False))
    return out.otherwise(F.lit(True))


def judge(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> DataFrame:
    """The statistics of every row, base_failed and kept."""
    stats = stage(statistics(docs), "quality-statistics")  # a few numbers per row; the texts are read once
    rules = train(stats, labels, bound)
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", verdict(rules))

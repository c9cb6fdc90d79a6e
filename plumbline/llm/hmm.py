"""A hidden Markov language model, and the smoothed unigram score beside it.

Tokens are lower-cased words and one end per text. Each of the FREQUENT most frequent training tokens is a symbol of its
own; other words share symbols by their last three bytes. A state emits a symbol, and a shared symbol a word, in
proportion to the word's training count, with 0.1 for each known word and for all unknown ones together. The latter does not depend
on the state, so a text's likelihood is that of its symbols, from the scaled forward recursion, times those shares.

Training: counts of all training tokens; then every text is written once as its symbols, which all later steps read. At
first each training text is of one state, chosen by the frequent word that occurs most often in it, so texts that share a
language or a subject begin together. Each of ROUNDS rounds of Baum-Welch takes expected counts from every training text, in
Spark tasks, and adds them up across partitions; the model itself is of bounded size.

Scoring joins the words outside the frequent ones with the count table, one row per document and word, so the count
table is never held by a task.

Defined cases: null and empty texts have one token, the end; rows that repeat are scored each; a null id counts as the
empty text for the fold; without training documents c, N and V are 0 and all tokens are unknown; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import fold, lower_words_of, stage, texts, vector_rows, vector_sum

FREQUENT = 1 << 16
SHARED = 2048
STATES = 8
ROUNDS = 3
HELD = 300_000
GROUP_TOKENS = 200_000
ADD = 0.1
BACKGROUND = 0.1
END = b""


class Symbols(dict):
    """Symbol by word; shared symbols follow the frequent ones. Emptied down to the frequent words when full."""

    def __init__(self, frequent: list[bytes]):
        super().__init__((w, i) for i, w in enumerate(frequent))
        self.n, self.frequent = len(frequent), frequent

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.n + HELD:
            self.clear()
            self.update((w, i) for i, w in enumerate(self.frequent))
        value = self[word] = self.n + crc32(word[-3:]) % SHARED
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


@dataclass
class Model:
    """Tokens, counts and the parameters of the chain. `log_share` is the log10 of a shared symbol's denominator."""

    frequent: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int
    log_share: np.ndarray
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # symbols x states

    @property
    def base_denominator(self) -> float:
        return float(np.log10(self.total + ADD * (self.distinct + 1)))


def sequences(parts: list[np.ndarray]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of sequences of similar length, longest first: indices, all symbols, where each begins, lengths."""
    order = sorted(range(len(parts)), key=lambda i: -len(parts[i]))
    k = 0
    while k < len(order):
        take, held = [], 0
        while k < len(order) and (not take or held + len(parts[order[k]]) <= GROUP_TOKENS):
            take.append(order[k])
            held += len(parts[order[k]])
            k += 1
        sizes = np.array([len(parts[i]) for i in take])
        yield take, np.concatenate([parts[i] for i in take]), np.concatenate([[0], np.cumsum(sizes)])[:-1], sizes


def by_step(first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all sequences in the order of their steps, and where each step begins in it."""
    active = np.searchsorted(-sizes, -np.arange(int(sizes[0])), side="left")  # sequences longer than t
    begins = np.concatenate([[0], np.cumsum(active)])
    row = np.arange(begins[-1]) - np.repeat(begins[:-1], active)
    return first[row] + np.repeat(np.arange(len(active)), active), begins


def forward(model: Model, flat: np.ndarray, first: np.ndarray, sizes: np.ndarray, keep: bool = False):
    """log10 likelihood of each sequence; with `keep` also the order by step, the emissions in it, scaled forward values and scales."""
    order, begins = by_step(first, sizes)
    emitted = model.emit[flat[order]]
    out = np.zeros(len(sizes))
    alpha = np.broadcast_to(model.start, (len(sizes), len(model.start)))
    kept = np.empty_like(emitted) if keep else None
    scales = np.empty(len(flat)) if keep else None
    for t in range(len(begins) - 1):
        low, high = begins[t], begins[t + 1]
        m = high - low
        now = (alpha[:m] if t == 0 else alpha[:m] @ model.move) * emitted[low:high]
        scale = now.sum(axis=1)
        now /= scale[:, None]
        out[:m] += np.log10(scale)
        if keep:
            kept[low:high] = now
            scales[low:high] = scale
        alpha = now
    return (out, order, begins, emitted, kept, scales) if keep else (out,)


def expected(model: Model, flat: np.ndarray, first: np.ndarray, sizes: np.ndarray, totals: tuple) -> float:
    """Add the expected starts, moves and emissions of a group of sequences to `totals`; returns its log10 likelihood."""
    start, move, emit = totals
    found, order, begins, emitted, kept, scales = forward(model, flat, first, sizes, keep=True)
    emitted /= scales[:, None]
    beta = np.ones((len(sizes), len(model.start)))
    for t in range(len(begins) - 2, -1, -1):
        low, high = begins[t], begins[t + 1]
        if t + 2 < len(begins):
            later = begins[t + 2] - high
            ahead = beta[:later] * emitted[high : high + later]
            move += (kept[low : low + later].T @ ahead) * model.move
            beta[:later] = ahead @ model.move.T
        # kept from the next step on holds the posterior of the state at each token
        if t + 2 < len(begins):
            kept[high : high + later] = posterior
        posterior = kept[low:high] * beta[: high - low]
    kept[: begins[1]] = posterior
    start += posterior.sum(axis=0)
    by_symbol = np.argsort(flat[order], kind="stable")
    symbols = flat[order][by_symbol]
    edges = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
    emit[symbols[edges]] += np.add.reduceat(kept[by_symbol], edges, axis=0)
    return float(found.sum())


def reestimated(model: Model, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> Model:
    """The model that the expected counts give. BACKGROUND of each state's emissions is the unigram's, so that a state
    emits every symbol, also those seen in other states only."""
    k = len(model.start)
    unigram = emit.sum(axis=1) + ADD
    own = emit + 1e-6
    return Model(
        model.frequent,
        model.counts,
        model.total,
        model.distinct,
        model.log_share,
        (start + 0.1) / (start.sum() + 0.1 * k),
        (move + 0.1) / (move.sum(axis=1, keepdims=True) + 0.1 * k),
        (1 - BACKGROUND) * own / own.sum(axis=0) + BACKGROUND * (unigram / unigram.sum())[:, None],
    )


def training(rows: DataFrame) -> DataFrame:
    return rows.where(fold("doc_id", 10) != 0)


def count_words(rows: DataFrame) -> DataFrame:
    """word, c over the training part. Tasks add up before the shuffle and send what they hold at HELD words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(held.keys()), pa.binary()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "c"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update(lower_words_of(text))
                held[END] += 1
                if len(held) >= HELD:
                    yield out()
        yield out()

    parts = training(rows).select("text").mapInArrow(count, "word binary, c long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"))


def shared_column(word: Column, n: int) -> Column:
    """The shared symbol of a word, as `Symbols` gives it, without the offset of the frequent ones."""
    return F.pmod(F.crc32(F.substring(word, -3, 3)), F.lit(n)).cast("int")


def most_frequent(counts: DataFrame, n: int) -> list:
    """The n most frequent words with their counts, equal ones by word. A histogram of the counts' logarithms gives the
    least count that can matter, so tasks send few rows beyond those wanted."""
    level = F.floor(F.log2("c") * 16)
    held, least = 0, 0
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r.level):
        held, least = held + r["count"], r.level
        if held >= n:
            break
    return counts.where(level >= least).orderBy(F.desc("c"), "word").limit(n).collect()


def first_model(counts: DataFrame, states: int) -> Model:
    """The symbols with their counts, and a chain whose states are all the same."""
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = most_frequent(counts, FREQUENT)
    frequent = [bytes(r.word) for r in top]
    tail = (
        counts.join(F.broadcast(counts.sparkSession.createDataFrame([(bytearray(w),) for w in frequent], "word binary")), "word", "left_anti")
        if frequent
        else counts
    )
    shares = tail.groupBy(shared_column(F.col("word"), SHARED).alias("s")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    log_share = np.full(SHARED, np.log10(ADD))
    mass = np.zeros(SHARED)
    for r in shares:
        log_share[r.s] = np.log10(r.n + ADD * (r.v + 1))
        mass[r.s] = r.n
    own = np.array([r.c for r in top], float)
    unigram = np.concatenate([own, mass]) + ADD
    emit = np.repeat((unigram / unigram.sum())[:, None], states, axis=1)
    flat = np.full(states, 1 / states)
    return Model(frequent, own, int(total.n), int(total.v), log_share, flat, np.full((states, states), 1 / states), emit)


def symbol_rows(rows: DataFrame, model: Model) -> DataFrame:
    """Per row (word null): its symbols, n_tokens, what the frequent tokens give and the shares of the shared ones. Per row
    and other word: tf."""
    sent = rows.sparkSession.sparkContext.broadcast((model.frequent, model.counts, model.log_share))  # bounded by FREQUENT and SHARED
    names = ["rid", "doc_id", "word", "tf", "n_tokens", "n_frequent", "base", "shares", "symbols"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts, log_share = sent.value
        symbols, n = Symbols(frequent), len(frequent)
        frequent_log = np.log10(counts + ADD)
        for batch in batches:
            rids, ids = batch.column(0), batch.column(1)
            size = batch.num_rows
            shares, base, known, lengths = np.zeros(size), np.zeros(size), np.zeros(size, np.int64), np.zeros(size, np.int64)
            parts: list[bytes] = []
            owner: list[int] = []
            words: list[bytes] = []
            tfs: list[int] = []
            for i in range(size):  # of a text's words only its symbols and the rare ones are kept
                tokens = [*lower_words_of(batch.column(2)[i].as_py()), END]
                part = symbols.of(tokens)
                own = part < n
                lengths[i], known[i] = len(part), own.sum()
                base[i] = frequent_log[part[own]].sum()
                shares[i] = log_share[part[~own] - n].sum()
                rare = Counter(tokens[j] for j in np.flatnonzero(~own))
                owner += [i] * len(rare)
                words += rare.keys()
                tfs += rare.values()
                parts.append(part.tobytes())
            none = lambda kind: pa.nulls(size, kind)
            yield pa.RecordBatch.from_arrays(
                [rids, ids, none(pa.binary()), none(pa.int64()), *map(pa.array, (lengths, known, base, shares)), pa.array(parts, pa.binary())], names
            )
            empty = lambda kind: pa.nulls(len(words), kind)
            yield pa.RecordBatch.from_arrays(
                [
                    rids.take(pa.array(owner, pa.int64())),
                    empty(pa.int64()),
                    pa.array(words, pa.binary()),
                    pa.array(tfs, pa.int64()),
                    *(empty(k) for k in (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())),
                ],
                names,
            )

    return rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text").mapInArrow(
        read, "rid long, doc_id long, word binary, tf long, n_tokens long, n_frequent long, base double, shares double, symbols binary"
    )


def first_state(part: np.ndarray, n_frequent: int, states: int) -> int:
    """The state that a text is of at first: by its most repeated frequent word, the more frequent of equals; 0 without one."""
    own = part[:-1][part[:-1] < n_frequent]
    return int(np.argmax(np.bincount(own))) % states if len(own) else 0


def full_round(model: Model, read: DataFrame, first: bool = False) -> Model:
    """One round of Baum-Welch over every training text; the `first` takes each text as of its first state."""
    sent = read.sparkSession.sparkContext.broadcast(model)
    k, v = len(model.start), len(model.emit)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        totals = np.zeros(k), np.zeros((k, k)), np.zeros((v, k))
        seen = False
        for batch in batches:
            parts = [np.frombuffer(x.as_buffer(), np.int32) for x in batch.column(0)]
            seen |= bool(parts)
            if first:
                for part in parts:
                    state = first_state(part, len(model.frequent), k)
                    totals[0][state] += 1
                    np.add.at(totals[2][:, state], part, 1)
                continue
            for _, flat, begins, sizes in sequences(parts):
                expected(model, flat, begins, sizes, totals)
        if seen:
            yield vector_rows(np.concatenate([t.reshape(-1) for t in totals]))

    parts = training(read).select("symbols").mapInArrow(gather, "slice int, data binary")
    found = vector_sum(parts, k + k * k + v * k)
    if not found.any():
        return model
    move = np.eye(k) * 100.0 if first else found[k : k + k * k].reshape(k, k)
    return reestimated(model, found[:k], move, found[k + k * k :].reshape(v, k))


def train(model: Model, read: DataFrame, rounds: int = ROUNDS) -> Model:
    for k in range(rounds + 1):
        model = full_round(model, read, first=k == 0)
    return model


def chain_rows(read: DataFrame, model: Model) -> DataFrame:
    """Per row the log10 likelihood of the chain beside what is known of it."""
    sent = read.sparkSession.sparkContext.broadcast(model)  # bounded by FREQUENT, SHARED and STATES
    names = ["rid", "doc_id", "n_tokens", "n_frequent", "base", "chain"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chain = -batch.column(5).to_numpy()
            for take, flat, first, lengths in sequences([np.frombuffer(x.as_buffer(), np.int32) for x in batch.column(6)]):
                chain[take] += forward(sent.value, flat, first, lengths)[0]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(chain)], names)

    return read.select(*names[:5], "shares", "symbols").mapInArrow(
        score, "rid long, doc_id long, n_tokens long, n_frequent long, base double, chain double"
    )


def score_texts(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    rows = texts(docs)
    counts = stage(count_words(rows), "word-counts")
    model = first_model(counts, states)
    parts = stage(symbol_rows(rows, model), "hmm-symbols")  # the row ids are fixed here
    read = parts.where("word IS NULL")
    model = train(model, read, rounds)
    rare = parts.where("word IS NOT NULL").select("rid", "word", "tf").join(counts, "word", "left")
    rare = rare.groupBy("rid").agg(
        F.sum(F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(ADD))).alias("rare_log"),
        F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("rare_known"),
    )
    out = chain_rows(read, model).join(rare, "rid", "left")
    rest = F.coalesce("rare_log", F.lit(0.0))
    return out.select(
        "doc_id",
        (fold("doc_id", 10) == 0).alias("held_out"),
        "n_tokens",
        (F.col("n_frequent") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + rest - F.col("n_tokens") * F.lit(model.base_denominator)).alias("base_score"),
        (F.col("chain") + rest).alias("score"),
    )

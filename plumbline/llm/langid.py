"""Language identification by a convolutional network over bytes.

A text is lower-cased, encoded, and cut into windows of WINDOW bytes. Filters of several widths slide over the one-hot
bytes of a window, the largest response of each filter goes to a softmax layer. The network is trained in numpy on the
driver, on a bounded sample: at most `docs_per_lang` documents of each language and WINDOWS_PER_DOC windows of each.
Every window of every text is scored in Spark tasks; a document takes the mean probability of its windows.

Defined cases: null text, empty text and text without a letter give `und` with score 0; rows that repeat are scored
each; documents without lang are not learned from; with no document to learn from every text gives `und`; an empty
table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import LOWEST_ID, bounded, fold, texts, without_keys

UNDETERMINED = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
WINDOWS_PER_DOC = 4
CHUNK_WINDOWS = 2048


class ByteConvNet:
    """Filters over one-hot bytes are tables: `tables[w][j, b]` is what byte b at offset j adds to each filter."""

    def __init__(self, labels: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(labels))).astype(np.float32)
        self.out_bias = np.zeros(len(labels), np.float32)

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """The largest response of each filter in each row of x (rows of bytes), by lookups of byte pairs."""
        pairs = np.ascontiguousarray((x[:, :-1].astype(np.int32) * 256 + x[:, 1:]).T)
        single = np.ascontiguousarray(x.T)
        n, size = x.shape
        t2, t3, t4 = self.tables
        both = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
        two, three, four, four_end = both(t2[0], t2[1]), both(t3[0], t3[1]), both(t4[0], t4[1]), both(t4[2], t4[3])
        best = [np.full((n, FILTERS), -np.inf, np.float32) for _ in WIDTHS]
        a, b = np.empty((n, FILTERS), np.float32), np.empty((n, FILTERS), np.float32)
        for t in range(size - 1):
            np.take(two, pairs[t], axis=0, out=a, mode="clip")
            np.maximum(best[0], a, out=best[0])
            if t + 2 < size:
                np.take(three, pairs[t], axis=0, out=a, mode="clip")
                np.take(t3[2], single[t + 2], axis=0, out=b, mode="clip")
                np.add(a, b, out=a)
                np.maximum(best[1], a, out=best[1])
            if t + 3 < size:
                np.take(four, pairs[t], axis=0, out=a, mode="clip")
                np.take(four_end, pairs[t + 2], axis=0, out=b, mode="clip")
                np.add(a, b, out=a)
                np.maximum(best[2], a, out=best[2])
        return np.concatenate([np.maximum(p + c, 0) for p, c in zip(best, self.bias, strict=True)], axis=1)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        logits = self.pooled(x) @ self.out + self.out_bias
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 7):
        """Adam on the cross entropy, classes weighted alike. Gradients pass only where a filter was largest."""
        rng = np.random.default_rng(seed)
        weight = (len(y) / np.maximum(np.bincount(y, minlength=len(self.labels)), 1) / len(self.labels))[y]
        params = [*self.tables, *self.bias, self.out, self.out_bias]
        first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for rows in np.array_split(order, max(1, len(order) // batch)):
                xb, yb, nb = x[rows], y[rows], len(rows)
                peaks, where = [], []
                for table, bias in zip(self.tables, self.bias, strict=True):
                    width, size = len(table), xb.shape[1] - len(table) + 1
                    conv = sum(table[j][xb[:, j : j + size]] for j in range(width))
                    at = conv.argmax(axis=1)
                    where.append(at)
                    peaks.append(np.take_along_axis(conv, at[:, None, :], axis=1)[:, 0] + bias)
                z = np.concatenate(peaks, axis=1)
                h = np.maximum(z, 0)
                logits = h @ self.out + self.out_bias
                p = np.exp(logits - logits.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(nb), yb] -= 1
                p *= (weight[rows] / nb)[:, None]
                dz = (p @ self.out.T) * (z > 0)
                grads: list[np.ndarray] = []
                columns = np.arange(FILTERS)
                for k, table in enumerate(self.tables):
                    g, part = np.zeros_like(table), dz[:, k * FILTERS : (k + 1) * FILTERS]
                    for j in range(len(table)):
                        np.add.at(g[j], (np.take_along_axis(xb, where[k] + j, axis=1), columns[None, :]), part)
                    grads.append(g)
                grads += [dz[:, k * FILTERS : (k + 1) * FILTERS].sum(axis=0) for k in range(len(WIDTHS))]
                grads += [h.T @ p, p.sum(axis=0)]
                step += 1
                for q, g, m, v in zip(params, grads, first, second, strict=True):
                    m *= 0.9
                    m += 0.1 * g
                    v *= 0.999
                    v += 0.001 * g * g
                    q -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self


def encoded(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def windows_of(data: bytes) -> np.ndarray:
    """All windows of the text; the last one is filled up with zero bytes."""
    rows = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(rows * WINDOW, b"\0"), np.uint8).reshape(rows, WINDOW)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def training_sample(docs: DataFrame, docs_per_lang: int) -> list[tuple[str, str]]:
    """(lang, part of a text) of at most `docs_per_lang` training documents of each language, spread over all of them.

    One document per language and bucket of ids: the smallest hash, found by a partial aggregate. From each come
    WINDOWS_PER_DOC stretches at places drawn from the id's hash.
    """
    rows = texts(docs, F.col("lang").cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (fold("doc_id", 3) != 1)
    )
    rows = rows.withColumn("h", F.xxhash64("doc_id", F.lit("sample")))
    chosen = rows.groupBy("lang", F.pmod("h", F.lit(docs_per_lang)).alias("bucket")).agg(F.min("h").alias("h"))
    at = lambda k: F.pmod(F.xxhash64("h", F.lit(k)), F.greatest(F.length("text") - WINDOW, F.lit(1)))
    parts = F.array(*[F.substr("text", (at(k) + 1).cast("int"), F.lit(WINDOW)) for k in range(WINDOWS_PER_DOC)])
    found = rows.join(F.broadcast(chosen.select("lang", "h")), ["lang", "h"]).select("lang", "h", parts.alias("parts"))
    taken = found.groupBy("lang", "h").agg(F.min("parts").alias("parts"))  # an id that repeats counts once
    return sorted((r.lang, p) for r in taken.collect() for p in r.parts)


def train(docs: DataFrame, docs_per_lang: int = 512) -> ByteConvNet | None:
    sample = training_sample(docs, docs_per_lang)
    if not sample:
        return None
    labels = sorted({lang for lang, _ in sample})
    x = np.stack([windows_of(encoded(part))[0] for _, part in sample])
    y = np.array([labels.index(lang) for lang, _ in sample])
    return ByteConvNet(labels).fit(x, y)


def predict(docs: DataFrame, model: ByteConvNet | None, *also: str) -> DataFrame:
    """doc_id, lang_pred, score of every row of docs, and columns of longs that are to go along.

    The network is a few hundred kilobytes and travels with the task.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(1).to_pylist()
            total = np.zeros((len(found), len(model.labels) if model else 1))
            count = np.zeros(len(found))
            rows: list[np.ndarray] = []
            owner: list[np.ndarray] = []
            held = 0

            def flush():
                nonlocal held
                if rows:
                    x, of = np.concatenate(rows), np.concatenate(owner)
                    for k in range(0, len(x), CHUNK_WINDOWS):
                        np.add.at(total, of[k : k + CHUNK_WINDOWS], model.probabilities(x[k : k + CHUNK_WINDOWS]))
                    np.add.at(count, of, 1)
                    rows.clear()
                    owner.clear()
                held = 0

            for i, text in enumerate(found):
                if model and has_letter(text):
                    rows.append(windows_of(encoded(text)))
                    owner.append(np.full(len(rows[-1]), i))
                    held += len(rows[-1])
                    if held >= 4 * CHUNK_WINDOWS:
                        flush()
            flush()
            mean = total / np.maximum(count, 1)[:, None]
            best = mean.argmax(axis=1)
            known = count > 0
            labels = [model.labels[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(labels, pa.string()),
                    pa.array(np.clip(mean.max(axis=1), 0, 1) * known),
                    *(batch.column(2 + k) for k in range(len(also))),
                ],
                ["doc_id", "lang_pred", "score", *also],
            )

    return texts(docs, *also).mapInArrow(score, ", ".join(["doc_id long, lang_pred string, score double", *(f"{c} long" for c in also)]))


def identify(docs: DataFrame, docs_per_lang: int = 512) -> DataFrame:
    """Train on the training part of docs and predict the language of every row."""
    return predict(docs, train(docs, docs_per_lang))


def with_language(docs: DataFrame, docs_per_lang: int = 512, least_score: float = 0.5) -> DataFrame:
    """The rows of docs whose language is determined with at least `least_score`; all columns are kept."""
    model = train(docs, docs_per_lang)
    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("th"))
    poor = (F.col("lang_pred") == UNDETERMINED) | (F.col("score") < least_score)
    gone = predict(rows, model, "th").where(poor).select(F.coalesce("doc_id", F.lit(LOWEST_ID)).alias("did"), "th").distinct()
    return without_keys(docs, bounded(gone, "poor-language"), by_text=True)

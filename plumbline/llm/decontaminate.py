"""Benchmark decontamination: every training passage queries a BM25 index of the test items.

The index has a posting list per term, with the impact (BM25 weight) of the term on each item; items lie in blocks of
BLOCK, and each term has the largest impact per block. A passage is PASSAGE words, a new one every STRIDE words. As in
block-max WAND, a block of items is opened for a passage only if the sum of its terms' block maxima reaches the lowest
threshold in the block; terms that occur in most blocks enter through one bound for all blocks. In opened blocks the exact score of each
item is computed, and all items above their threshold are retrieved; there is no top-k. An item is found in a document
if, around the passage, the whole item overlaps with the text: at least `overlap` of its word triples (single words, where there
are fewer than three) occur there. Items have no separate answers; the shares of the question (all but the last
sentence) and of the answer (the last sentence) are reported beside it and decide nothing.

An item's threshold is `ratio` of its score for itself, or for the part of it that fits into STRIDE words. The index is held by every
task, so items are taken in shards of at most SHARD_ITEMS items and SHARD_BYTES of text; each shard is one pass.

Defined cases: null and empty texts of documents match nothing; null and empty items, and those without a word, match nothing;
items that repeat an id match separately and are reported once; rows that repeat a doc_id are searched each and reported
once per item; a null doc_id is reported as null; with either table empty there are no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from plumbline.llm.common import LOWEST_ID, bounded, texts, without_keys

K1, B = 1.2, 0.75
PASSAGE, STRIDE = 64, 32
BLOCK = 4
RATIO = 0.5
OVERLAP = 0.5
SHARD_ITEMS = 4096
SHARD_BYTES = 32_000_000
CHUNK_WORDS = 400_000

_TO_SPACE = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-cased words; every ASCII character but letters and digits parts them."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """All sentences but the last, and the last one; an item of one sentence is both."""
    parts = [w for w in (words_of(p) for p in re.split(r"[.?!\n]+", text)) if w]
    if not parts:
        return [], []
    question = [w for part in parts[:-1] for w in part]
    return question or parts[-1], parts[-1]


def pieces_of(words: list[bytes]) -> set:
    return set(zip(words, words[1:], words[2:], strict=False)) if len(words) >= 3 else set(words)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all entries of the lists that begin at `starts` and have `sizes` entries."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order and the sum of the weights of each."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[edges], np.add.reduceat(weights, edges)


def distinct(keys: np.ndarray) -> np.ndarray:
    """The distinct keys in order; sorting is quicker here than hashing."""
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


class Lists:
    """For every term a list of (place, weight), end to end."""

    def __init__(self, lists: list[list[tuple[int, float]]]):
        self.sizes = np.array([len(x) for x in lists], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.places = np.array([p for x in lists for p, _ in x], np.int64)
        self.weights = np.array([w for x in lists for _, w in x], float)

    def of(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which of the given terms, place, weight) of all entries of the terms' lists."""
        sizes = self.sizes[terms]
        at = spread(self.starts[terms], sizes)
        return np.repeat(np.arange(len(terms)), sizes), self.places[at], self.weights[at]


class Index:
    """Terms, impacts, block maxima and thresholds of a shard of items; statistics are those of all items.

    Items are sorted by threshold before they are cut into blocks, so that a block's least threshold is close to all.
    """

    def __init__(self, items: list[tuple[object, str]], df: dict[bytes, int], n_items: int, mean_length: float, ratio: float):
        found = []
        for key, text in items:
            words = words_of(text)
            if not words:
                continue
            norm = K1 * (1 - B + B * len(words) / mean_length)
            impacts = {
                t: float(np.log(1 + (n_items - df[t] + 0.5) / (df[t] + 0.5)) * tf * (K1 + 1) / (tf + norm))
                for t, tf in Counter(words).items()
            }
            found.append((ratio * sum(impacts.values()) * min(1.0, STRIDE / len(words)), str(key), key, text, words, impacts))
        found.sort(key=lambda x: (x[0], x[1], x[3]))
        self.thresholds = np.array([x[0] for x in found])
        self.keys = [x[2] for x in found]
        self.parts = [tuple((pieces_of(p), p) for p in (x[4], *question_and_answer(x[3]))) for x in found]
        self.lengths = [len(x[4]) for x in found]
        self.n_blocks = -(-len(found) // BLOCK)
        self.block_least = np.array([self.thresholds[b * BLOCK] for b in range(self.n_blocks)])
        self.terms: dict[bytes, int] = {}
        postings: list[list[tuple[int, float]]] = []
        for i, x in enumerate(found):
            for term, impact in x[5].items():
                t = self.terms.setdefault(term, len(self.terms))
                if t == len(postings):
                    postings.append([])
                postings[t].append((i, impact))
        maxima: list[dict[int, float]] = []
        for posting in postings:
            best: dict[int, float] = {}
            for i, impact in posting:
                best[i // BLOCK] = max(best.get(i // BLOCK, 0.0), impact)
            maxima.append(best)
        # Terms in at least half of the blocks (and four or more) count through one bound for all blocks.
        common = [len(m) >= max(4, self.n_blocks / 2) for m in maxima]
        self.common = np.array([max(m.values()) if c else 0.0 for m, c in zip(maxima, common, strict=True)])
        self.blocks = Lists([[] if c else sorted(m.items()) for m, c in zip(maxima, common, strict=True)])
        self.items = Lists(postings)

    def opened(self, passage: np.ndarray, terms: np.ndarray, n_passages: int) -> np.ndarray:
        """passage * n_blocks + block, in order, where the bound reaches the block's least threshold.

        (passage, term) are the distinct terms of each passage.
        """
        shared = np.bincount(passage, weights=self.common[terms], minlength=n_passages)
        which, block, weight = self.blocks.of(terms)
        keys, bound = summed(passage[which] * self.n_blocks + block, weight)
        keys = keys[bound + shared[keys // self.n_blocks] >= self.block_least[keys % self.n_blocks] - 1e-9]
        # Passages whose common terms alone reach a threshold open every such block.
        heavy = np.flatnonzero(shared >= self.block_least[0] - 1e-9)
        if len(heavy):
            pairs = (heavy[:, None] * self.n_blocks + np.arange(self.n_blocks))[shared[heavy][:, None] >= self.block_least - 1e-9]
            keys = distinct(np.concatenate([keys, pairs]))
        return keys

    def retrieved(self, passage: np.ndarray, terms: np.ndarray, n_passages: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, item, score) of all items in opened blocks that reach their threshold; scores are exact."""
        keys = self.opened(passage, terms, n_passages)
        wanted = np.zeros(n_passages, bool)
        wanted[keys // self.n_blocks] = True
        own = np.flatnonzero(wanted[passage])
        # A bitmap of the opened blocks, over the passages that have any.
        row = np.cumsum(wanted) - 1
        bitmap = np.zeros((int(wanted.sum()), self.n_blocks), bool)
        bitmap[row[keys // self.n_blocks], keys % self.n_blocks] = True
        which, item, weight = self.items.of(terms[own])
        at = passage[own][which]
        inside = np.flatnonzero(bitmap[row[at], item // BLOCK])
        n = len(self.keys)
        pairs, scores = summed(at[inside] * n + item[inside], weight[inside])
        good = scores >= self.thresholds[pairs % n] - 1e-9
        return pairs[good] // n, pairs[good] % n, scores[good]

    def overlaps(self, item: int, words: list[bytes]) -> tuple[float, float, float]:
        """The shares of the item's, of its question's and of its answer's pieces that the words hold."""
        triples, single = pieces_of(words), set(words)
        shares = []
        for pieces, part in self.parts[item]:
            held = triples if len(part) >= 3 and len(words) >= 3 else single
            shares.append(len(pieces & held) / len(pieces) if len(part) >= 3 or not pieces else len(pieces & single) / len(pieces))
        return shares[0], shares[1], shares[2]

    def search(self, batch: list[str], overlap: float) -> list[tuple[int, int, float, float, float, float, int]]:
        """(text, item, score, share, question share, answer share, first word) of every item found in each text."""
        found = []
        first = 0
        while first < len(batch):
            words, total, stop = [], 0, first
            while stop < len(batch) and (not words or total + len(batch[stop]) // 4 <= CHUNK_WORDS):
                words.append(words_of(batch[stop]))
                total += len(words[-1])
                stop += 1
            found += [(first + k, *rest) for k, *rest in self._search_words(words, overlap)]
            first = stop
        return found

    def _search_words(self, texts_words: list[list[bytes]], overlap: float):
        get, n_terms = self.terms.get, len(self.terms)
        cells, total, parts = [], 0, []
        for words in texts_words:
            ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
            at = np.flatnonzero(ids >= 0)
            # The distinct terms of each stretch of STRIDE words.
            parts.append((total + at // STRIDE) * n_terms + ids[at])
            cells.append(total)
            total += max(1, -(-len(words) // STRIDE))
        found = distinct(np.concatenate(parts))
        if not len(found):
            return
        starts = np.array([*cells, total])
        opens = np.zeros(total + 1, bool)
        opens[starts] = True
        # A passage is a stretch and its successor; a text's last stretch is one of its own. Passages have their first's number.
        later = found[~opens[found // n_terms]] - n_terms
        found = distinct(np.concatenate([found, later]))
        cell, item, score = self.retrieved(found // n_terms, found % n_terms, total)
        of = np.searchsorted(starts, cell, side="right") - 1
        best: dict[tuple[int, int], tuple[float, float, float, float, int]] = {}
        for c, i, value, k in zip(cell.tolist(), item.tolist(), score.tolist(), of.tolist(), strict=True):
            if value <= best.get((k, i), (-1.0,))[0]:
                continue
            words, at = texts_words[k], (c - cells[k]) * STRIDE
            around = words[max(0, at - self.lengths[i]) : at + PASSAGE + self.lengths[i]]
            whole, question, answer = self.overlaps(i, around)
            if whole >= overlap:
                best[k, i] = (value, whole, question, answer, at)
        for (k, i), rest in sorted(best.items()):
            yield k, i, *rest


def indexes(items: DataFrame, ratio: float) -> Iterator[Index]:
    """The index of each shard. Counts are taken in Spark over all items; a shard is collected within its bounds."""
    rows = items.select(F.col("item_id").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.length(F.trim("text")) > 0)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [words_of(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(x) for x in lists], pa.int64()), pa.array([sorted(set(x)) for x in lists], pa.list_(pa.binary()))],
                ["n", "terms"],
            )

    words = rows.select("text").mapInArrow(counted, "n long, terms array<binary>").where("n > 0")
    size = words.agg(F.count("*").alias("items"), F.avg("n").alias("mean")).first()
    if not size.items:
        return
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    shards = max(-(-size.items * 2 // SHARD_ITEMS) if size.items > SHARD_ITEMS else 1, -(-n_bytes * 2 // SHARD_BYTES) if n_bytes > SHARD_BYTES else 1)
    df = words.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    for shard in range(shards):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard)
        terms = part.select("text").mapInArrow(counted, "n long, terms array<binary>").select(F.explode("terms").alias("term")).distinct()
        counts = {bytes(r.term): r.df for r in df.join(terms, "term").collect()}
        found = sorted(((r.item_id, r.text) for r in part.collect()), key=lambda x: (str(x[0]), x[1]))
        if found:
            yield Index(found, counts, size.items, size.mean, ratio)


def matches(docs: DataFrame, items: DataFrame, ratio: float = RATIO, overlap: float = OVERLAP) -> DataFrame:
    """doc_id, item_id, score, overlap, question_overlap, answer_overlap, first_word of every item found in every document."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    schema = f"doc_id long, item_id {kind}, score double, overlap double, question_overlap double, answer_overlap double, first_word long"
    sent_schema = to_arrow_schema(StructType.fromDDL(schema))
    parts = []
    for index in indexes(items, ratio):
        sent = spark.sparkContext.broadcast(index)  # bounded by SHARD_ITEMS and SHARD_BYTES

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, index = batch.column(0).to_pylist(), sent.value
                found = index.search(batch.column(1).to_pylist(), overlap)
                yield pa.RecordBatch.from_pylist(
                    [
                        {"doc_id": ids[k], "item_id": index.keys[i], "score": s, "overlap": w, "question_overlap": q, "answer_overlap": a, "first_word": at}
                        for k, i, s, w, q, a, at in found
                    ],
                    schema=sent_schema,
                )

        parts.append(texts(docs).mapInArrow(search, schema))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    best = F.max(F.struct("score", "overlap", "question_overlap", "answer_overlap", "first_word")).alias("best")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def without_benchmark(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs in which no item was found; all columns are kept."""
    hit = matches(docs, items).select(F.coalesce("doc_id", F.lit(LOWEST_ID)).alias("did")).distinct()
    return without_keys(docs, bounded(hit, "contaminated"))

"""Removal of passages of 50 words or more that an earlier document (one with a smaller id) holds too.

A window is WINDOW consecutive words. Every window is represented by the least hash of its 8-word phrases, so equal
windows have the same representative, and about one phrase in twenty represents any window.

1. Phrases that represent windows of two documents or more are recurring. Windows represented by one are hashed;
   those found in two documents are confirmed recurring, with the least id that holds them.
2. In that document, neighbouring confirmed windows with the same representative make a passage.
3. The passages are dealt to the buckets of documents that hold their phrase. Each bucket compiles its phrases into an
   Aho-Corasick automaton and streams its documents through it. At every occurrence the document is compared with the phrase's
   passages, word by word to both sides; words in a stretch of WINDOW equal words or more go, if the passage's document has a
   smaller id.

Hashes only choose what is compared; a word goes only where the words themselves are equal. Documents lie in a
bucketed table in the shared folder, so their texts are shuffled once. The number of buckets follows the size of the
text.

Defined cases: words are `[^\\x20\\x09-\\x0D]+`, unchanged; null and empty texts have none; a text of fewer than WINDOW words
keeps all; rows that repeat an id are one document as to order, so neither removes words of the other; a null id counts as
the smallest; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import (
    LOWEST_ID,
    WordHashes,
    fresh_name,
    gram_hashes,
    mix,
    signed,
    stage,
    texts,
    words_of,
)
from plumbline.session import scratch_dir

WINDOW = 50
PHRASE = 8
BUCKET_CHARS = 8_000_000

_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours, by doubling."""
    if len(values) < width:
        return values[:0]
    reach, out = 1, values
    while 2 * reach <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every `width` consecutive words, from prefix sums modulo 2^64."""
    n = len(hashes)
    if n < width:
        return np.empty(0, np.uint64)
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]))
    back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _INVERSE)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * power[:n])])
    return mix((sums[width:] - sums[:-width]) * back[: n - width + 1])


def representatives(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all phrases, and the representative of every window."""
    grams = gram_hashes(hashes, PHRASE)
    return grams, sliding_least(grams, window - PHRASE + 1)


def phrase_rows(rows: DataFrame, window: int) -> DataFrame:
    """did, bucket, phrase: the distinct representatives of each document."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [np.unique(representatives(hashes.of(words_of(t)), window)[1]) for t in batch.column(2).to_pylist()]
            owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
            phrases = signed(np.concatenate(found)) if found else np.empty(0, np.int64)
            take = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(phrases, pa.int64())], ["did", "bucket", "phrase"]
            )

    return rows.select("did", "bucket", "text").mapInArrow(find, "did long, bucket int, phrase long")


def bucketed(rows: DataFrame, marks: DataFrame, buckets: int) -> DataFrame:
    """All rows with the recurring phrases of their bucket's documents, as a table with one file per bucket."""

    def attach(left: pa.Table, right: pa.Table) -> pa.Table:
        own: dict[int, list[int]] = {}
        for did, phrase in zip(right.column("did").to_pylist(), right.column("phrase").to_pylist(), strict=True):
            own.setdefault(did, []).append(phrase)
        phrases = pa.array([own.get(d, []) for d in left.column("did").to_pylist()], pa.list_(pa.int64()))
        return left.select(["did", "bucket", "text"]).append_column("phrases", phrases)

    out = rows.groupBy("bucket").cogroup(marks.groupBy("bucket")).applyInArrow(
        attach, "did long, bucket int, text string, phrases array<long>"
    )
    name = fresh_name("repeats")
    out.write.option("path", scratch_dir(rows.sparkSession, "repeat-texts")).option("compression", "zstd").bucketBy(
        buckets, "bucket"
    ).saveAsTable(name)
    return rows.sparkSession.table(name)


def window_rows(table: DataFrame, window: int) -> DataFrame:
    """hash, low, high: windows whose representative recurs, once per task and hash, with the least and largest id."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found, ids = [], []
            dids = batch.column(0).to_pylist()
            for did, text, phrases in zip(dids, batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if phrases:
                    own = hashes.of(words_of(text))
                    recurring = np.isin(representatives(own, window)[1], np.array(phrases, np.int64).view(np.uint64))
                    found.append(np.unique(window_hashes(own, window)[recurring]))
                    ids.append(np.full(len(found[-1]), did, np.int64))
            if not found:
                continue
            all_hashes, all_ids = np.concatenate(found), np.concatenate(ids)
            order = np.lexsort((all_ids, all_hashes))
            all_hashes, all_ids = all_hashes[order], all_ids[order]
            heads = np.flatnonzero(np.concatenate([[True], all_hashes[1:] != all_hashes[:-1]]))
            lasts = np.concatenate([heads[1:] - 1, [len(all_hashes) - 1]])
            columns = (signed(all_hashes[heads]), all_ids[heads], all_ids[lasts])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["hash", "low", "high"])

    return table.select("did", "text", "phrases").where(F.size("phrases") > 0).mapInArrow(find, "hash long, low long, high long")


def passage_rows(table: DataFrame, confirmed: DataFrame, window: int) -> DataFrame:
    """phrase, did, words, place: the passages of the documents that hold confirmed windows first, and where the phrase is."""

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        own: dict[int, list[int]] = {}
        for did, h in zip(right.column("did").to_pylist(), right.column("hash").to_pylist(), strict=True):
            own.setdefault(did, []).append(h)
        hashes, out = WordHashes(), set()
        for did, text in zip(left.column("did").to_pylist(), left.column("text").to_pylist(), strict=True):
            if did not in own:
                continue
            words = words_of(text)
            known = hashes.of(words)
            grams, best = representatives(known, window)
            hit = np.flatnonzero(np.isin(window_hashes(known, window), np.array(own[did], np.int64).view(np.uint64)))
            if not len(hit):
                continue
            new = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (best[hit[1:]] != best[hit[:-1]])])
            heads = hit[new].tolist()
            lasts = np.concatenate([hit[:-1][new[1:]], hit[-1:]]).tolist()
            for first, last in zip(heads, lasts, strict=True):
                # The phrase must lie in all windows of the run; cut the run where it does not.
                while first <= last:
                    places = np.flatnonzero(grams[first : first + window - PHRASE + 1] == best[first])
                    place = first + int(places[-1])
                    end = min(last, place)
                    passage = b" ".join(words[first : end + window])
                    out.add((int(signed(best[first : first + 1])[0]), did, passage, place - first))
                    first = end + 1
        columns = list(zip(*sorted(out), strict=True)) if out else [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["phrase", "did", "words", "place"])

    return table.select("did", "bucket", "text").groupBy("bucket").cogroup(confirmed.groupBy("bucket")).applyInArrow(
        cut, "phrase long, did long, words binary, place int"
    )


def equal_stretch(words: list[bytes], at: int, passage: list[bytes], place: int) -> tuple[int, int]:
    """The longest stretch of equal words around words[at] and passage[place], as places in words."""
    first, last = at, at
    while first > 0 and place - (at - first) > 0 and words[first - 1] == passage[place - (at - first) - 1]:
        first -= 1
    while last < len(words) and place + (last - at) < len(passage) and words[last] == passage[place + (last - at)]:
        last += 1
    return first, last


def covered(words: list[bytes], did: int, automaton, window: int) -> np.ndarray:
    """Which words lie in a window that a passage of a smaller id holds too."""
    edge = np.zeros(len(words) + 1, np.int32)
    if automaton is None or len(words) < window:
        return edge[:-1] > 0
    joined = b" " + b" ".join(words) + b" "
    begins = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words)))
    begins = np.concatenate([[0], begins])  # of the blank before each word
    until: dict[int, int] = {}
    for end, (length, shapes) in automaton.iter(joined.decode("latin-1")):
        at = int(np.searchsorted(begins, end + 1 - length))
        for (lead, size), cores in shapes.items():
            low = at - lead
            if low < 0 or low + size > len(words):
                continue
            for source, place, passage in cores.get(tuple(words[low : low + size]), ()):
                if source >= did:
                    break  # sorted by id
                shift = at - place
                if until.get((id(passage), shift), -1) >= at:
                    continue
                if shift >= 0 and words[shift : shift + len(passage)] == passage:
                    first, last = shift, shift + len(passage)
                else:
                    first, last = equal_stretch(words, at, passage, place)
                until[id(passage), shift] = last
                if last - first >= window:
                    edge[first] += 1
                    edge[last] -= 1
    return np.cumsum(edge[:-1]) > 0


def compiled(passages: pa.Table, window: int):
    """The automaton of a bucket's phrases. Each has its passages as (id, place of the phrase, words), by their core.

    The core is what all windows of a passage share. A stretch of equal words of a window or more holds it, so a look-up by
    the words around an occurrence finds the passages that can match, however many have the phrase. Cores are grouped by
    shape: how many words stand before the phrase, and how many there are.
    """
    found: dict[bytes, dict[tuple[int, int], dict[tuple[bytes, ...], list[tuple[int, int, list[bytes]]]]]] = {}
    for did, text, place in zip(*(passages.column(c).to_pylist() for c in ("did", "words", "place")), strict=True):
        words = text.split(b" ")
        first = len(words) - window
        shapes = found.setdefault(b" ".join(words[place : place + PHRASE]), {})
        cores = shapes.setdefault((place - first, window - first), {})
        cores.setdefault(tuple(words[first:window]), []).append((did, place, words))
    if not found:
        return None
    automaton = ahocorasick.Automaton()
    for phrase, shapes in found.items():
        key = (b" " + phrase + b" ").decode("latin-1")
        for cores in shapes.values():
            for held in cores.values():
                held.sort(key=lambda x: x[:2])
        automaton.add_word(key, (len(key), shapes))
    automaton.make_automaton()
    return automaton


def kept_rows(table: DataFrame, passages: DataFrame, window: int) -> DataFrame:
    def strip(left: pa.Table, right: pa.Table) -> pa.Table:
        automaton = compiled(right, window)
        counts, removed, kept = [], [], []
        columns = (left.column(c).to_pylist() for c in ("did", "text", "phrases"))
        for did, text, phrases in zip(*columns, strict=True):
            words = words_of(text)
            gone = covered(words, did, automaton if phrases else None, window)
            counts.append(len(words))
            removed.append(int(gone.sum()))
            left_words = [w for w, g in zip(words, gone, strict=True) if not g] if removed[-1] else words
            kept.append(b" ".join(left_words).decode("utf-8", "surrogatepass"))
        return pa.table(
            [left.column("did"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            ["did", "n_words", "n_removed", "kept"],
        )

    return table.groupBy("bucket").cogroup(passages.groupBy("bucket")).applyInArrow(
        strip, "did long, n_words long, n_removed long, kept string"
    )


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by one space) of every row."""
    spark = docs.sparkSession
    source = texts(docs).select(F.coalesce("doc_id", F.lit(LOWEST_ID)).alias("did"), "text")
    size = source.agg(F.coalesce(F.sum(F.length("text").cast("decimal(38,0)")), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size) // BUCKET_CHARS + 1)
    bucket = F.pmod(F.xxhash64("did"), F.lit(buckets)).cast("int")
    rows = source.withColumn("bucket", bucket)
    marks = stage(phrase_rows(rows, window), "repeat-phrases")
    recurring = marks.groupBy("phrase").agg(F.min("did").alias("a"), F.max("did").alias("b")).where("a <> b").select("phrase")
    marks = stage(marks.join(recurring, "phrase").select("did", "bucket", "phrase"), "repeat-marks")
    table = bucketed(rows, marks, buckets)
    confirmed = (
        window_rows(table, window)
        .groupBy("hash")
        .agg(F.min("low").alias("did"), F.max("high").alias("last"))
        .where("did <> last")
        .select("hash", "did")
    )
    passages = stage(passage_rows(table, confirmed.withColumn("bucket", bucket), window), "repeat-passages")
    dealt = passages.join(marks.select("phrase", F.col("bucket").alias("to")).distinct(), "phrase")
    dealt = dealt.select(F.col("to").alias("bucket"), "did", "words", "place")
    out = kept_rows(table, dealt, window)
    return out.select(F.when(F.col("did") != LOWEST_ID, F.col("did")).alias("doc_id"), "n_words", "n_removed", "kept")

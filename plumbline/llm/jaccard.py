"""N-gram Jaccard join with a token-group matrix.

A document is the set of its distinct 5-word shingles (64-bit hashes). Two sets link when
100 * |intersection| >= percent * |union|. Links are found exactly, in these steps:

1. A fixed table of counts (2^21 buckets of hashes) orders tokens from rare to frequent. It only orders; no token is
   left out. In that order two linked sets share a token among their first n - ceil(percent * n / 100) + 1.
2. Equal sets are one class. Classes that share one of eight minima of their hashes are compared with the most central
   class that has it (the one whose tokens are most frequent on average): copies find their original in linear work.
   The connected classes are the groups of similar documents; large ones are cut into chunks of about GROUP classes.
3. The token-group matrix has a row for each token of the first part of a set and each group, with the least and
   largest set and the most that can still be shared from that token on. A class queries the groups of other components;
   a group is a candidate if a token's bounds on size and place allow a link.
4. A group's token union is stored as COUNTERS counts of hash buckets, the largest of its members. The sum of the
   lesser counts bounds the overlap with the query; only a group whose bound allows a link is opened, and each of its
   members compared exactly. Links inside a component need no second look: they cannot change the result.

Defined cases: words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased; fewer than five words are one shingle; null, empty and
blank texts have the empty set, which links with nothing; rows that repeat an id or a text are rows of their own; a null
id counts as the smallest and is reported as null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import (
    LOWEST_ID,
    WordHashes,
    bounded,
    gram_hashes,
    lower_words_of,
    mark,
    mix,
    signed,
    stage,
    texts,
    tidy,
    vector_rows,
    vector_sum,
    whole_hash,
    without_keys,
)
from plumbline.llm.components import components

WORDS = 5
PERCENT = 75
GROUP = 64
BUCKET_BITS = 21
MINIMA = 8
COUNTERS = 512


def shingles(text: str, hashes: WordHashes, words: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    found = hashes.of(lower_words_of(text))
    if not len(found):
        return np.empty(0, np.uint64)
    if len(found) < words:
        return np.array([whole_hash(found)], np.uint64)
    return np.unique(gram_hashes(found, words))


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def token_levels(rows: DataFrame) -> np.ndarray:
    """How frequent each bucket of hashes is: twice the binary logarithm of its count over all rows, as bytes."""
    size = 1 << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, hashes = np.zeros(size, np.int32), WordHashes()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                np.add.at(total, bucket_of(shingles(text, hashes)), 1)
        if total.any():
            yield vector_rows(total)

    def level(counts: np.ndarray) -> np.ndarray:
        return np.floor(2 * np.log2(counts + 1)).astype(np.uint8)

    return vector_sum(rows.select("text").mapInArrow(count, "slice int, data binary"), size, level, np.uint8)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def least_overlap(a: Column, b: Column, percent: int) -> Column:
    """The least intersection with which sets of these sizes link."""
    return F.ceil(percent * (a + b) / F.lit(100 + percent))


def set_index(rows: DataFrame, percent: int, words: int) -> DataFrame:
    """Per row: did, th, n, cid (the class of equal sets), central, minima and the rare first part of the set.

    The first part is given once per class and task; later copies in the task leave it out.
    """
    sent = rows.sparkSession.sparkContext.broadcast(token_levels(rows))

    def lists(parts: list[np.ndarray]) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
        flat = signed(np.concatenate(parts)) if parts else np.empty(0, np.int64)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, hashes, seen = sent.value, WordHashes(), set()
        none = np.empty(0, np.uint64)
        for batch in batches:
            sizes, classes, centrals, minima, firsts = [], [], [], [], []
            for text in batch.column(2).to_pylist():
                h = shingles(text, hashes, words)
                n = len(h)
                sizes.append(n)
                cid = mix(np.array([h.sum(dtype=np.uint64)]) * np.uint64(31) + np.uint64(n))[0]
                classes.append(cid)
                if not n or cid in seen:
                    centrals.append(0.0)
                    minima.append(none)
                    firsts.append(none)
                    continue
                seen.add(cid)
                level = levels[bucket_of(h)]
                centrals.append(float(level.mean()))
                bins = h & np.uint64(MINIMA - 1)
                # h is sorted: the first of a bin is its least. The bin is part of the value.
                minima.append(h[np.unique(bins, return_index=True)[1]])
                ordered = (level.astype(np.uint64) << np.uint64(56)) | (h >> np.uint64(8))
                firsts.append(np.sort(ordered)[: prefix_length(n, percent)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(signed(np.array(classes, np.uint64)), pa.int64()),
                    pa.array(centrals, pa.float64()),
                    lists(minima),
                    lists(firsts),
                ],
                ["did", "th", "n", "cid", "central", "minima", "first"],
            )

    return rows.select("did", "th", "text").mapInArrow(
        index, "did long, th long, n long, cid long, central double, minima array<long>, first array<long>"
    )


def with_text(nodes: DataFrame, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """nodes (with cid) and the text of each class's representative, once for every row that repeats it.

    Up to a bound the nodes (three longs each) are sent to the texts; more are joined by a shuffle.
    """
    wanted = bounded(nodes.join(classes.select("cid", "did", "th"), "cid"), "wanted-texts")
    return wanted.join(rows.select("did", "th", "text"), ["did", "th"]).drop("did", "th")


class _Sets:
    """The sets of the texts seen last."""

    def __init__(self, words: int, size: int = 256):
        self.hashes, self.words, self.size = WordHashes(), words, size
        self.held: OrderedDict[int, np.ndarray] = OrderedDict()

    def of(self, key: int, text: str) -> np.ndarray:
        if key in self.held:
            self.held.move_to_end(key)
        else:
            self.held[key] = shingles(text, self.hashes, self.words)
            if len(self.held) > self.size:
                self.held.popitem(last=False)
        return self.held[key]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def verified_pairs(pairs: DataFrame, classes: DataFrame, rows: DataFrame, percent: int, words: int) -> DataFrame:
    """The pairs (a, b) of classes that link, compared on their whole texts."""
    ends = pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid"))).distinct()
    known = stage(with_text(ends, classes, rows), "pair-texts")
    joined = pairs.join(known.select(F.col("cid").alias("a"), F.col("text").alias("text_a")), "a").join(
        known.select(F.col("cid").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(words)
        for batch in batches:
            a, b, ta, tb = (batch.column(k).to_pylist() for k in range(4))
            good = [linked(sets.of(p, x), sets.of(q, y), percent) for p, q, x, y in zip(a, b, ta, tb, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return joined.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a long, b long").distinct()


def seed_pairs(classes: DataFrame, percent: int) -> DataFrame:
    """(a, b): each class and the most central class that shares one of its minima, if their sizes allow a link."""
    keyed = classes.select("cid", "n", "central", F.explode("minima").alias("key"))
    hubs = (
        keyed.groupBy("key")
        .agg(F.max(F.struct("central", "cid", "n")).alias("hub"), F.count("*").alias("c"))
        .where("c > 1")
        .select("key", F.col("hub.cid").alias("b"), F.col("hub.n").alias("m"))
    )
    fits = (100 * F.least("n", "m") >= percent * F.greatest("n", "m")) & (F.col("cid") != F.col("b"))
    return keyed.join(hubs, "key").where(fits).select(F.col("cid").alias("a"), "b").distinct()


def group_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """(cid, comp, chunk): classes and the groups of other components that they may link with, by the matrix."""
    left = F.col("n") - F.col("pos")
    matrix = postings.groupBy("token", F.col("comp").alias("g_comp"), F.col("chunk").alias("g_chunk")).agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max(left).alias("g_left")
    )
    smallest = F.greatest("low", F.ceil(percent * F.col("n") / 100))
    possible = (
        (F.col("comp") > F.col("g_comp"))
        & (100 * F.col("high") >= percent * F.col("n"))
        & (100 * F.col("n") >= percent * F.col("low"))
        & (F.least(left, F.col("g_left")) >= least_overlap(F.col("n"), smallest, percent))
    )
    found = postings.join(matrix, "token").where(possible)
    return found.select("cid", F.col("g_comp").alias("comp"), F.col("g_chunk").alias("chunk")).distinct()


def bucket_counts(tokens: np.ndarray) -> np.ndarray:
    """How many tokens fall into each of COUNTERS buckets, at most 255."""
    return np.minimum(np.bincount((tokens % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS), 255).astype(np.uint8)


def overlap_bound(a: np.ndarray, b: np.ndarray, n: int) -> int:
    """At least the intersection of sets with these counts, of which one has n tokens."""
    least = np.minimum(a, b)
    return n if least.max() == 255 else int(least.sum(dtype=np.int64))


def within_bounds(candidates: DataFrame, of_group: DataFrame, known: DataFrame, percent: int, words: int) -> DataFrame:
    """The candidates (cid, comp, chunk) whose group's token union allows a link with the query."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(t, hashes, words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([bucket_counts(s).tobytes() for s in sets], pa.binary()),
                ],
                ["cid", "n", "counts"],
            )

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, low = (batch.column(k).to_pylist() for k in (3, 5))
            good = []
            for size, counts, least, union in zip(n, batch.column(4).to_pylist(), low, batch.column(6).to_pylist(), strict=True):
                most = np.max([np.frombuffer(u, np.uint8) for u in union], axis=0)
                smallest = max(least, -(-percent * size // 100))
                shared = overlap_bound(np.frombuffer(counts, np.uint8), most, size)
                good.append((100 + percent) * shared >= percent * (size + smallest))
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(3)], ["cid", "comp", "chunk"]).filter(pa.array(good, pa.bool_()))

    counted = stage(known.select("cid", "text").mapInArrow(count, "cid long, n long, counts binary"), "bucket-counts")
    # A chunk has about GROUP classes, so a union is gathered from that many counts.
    unions = of_group.join(counted, "cid").groupBy("comp", "chunk").agg(F.min("n").alias("low"), F.collect_list("counts").alias("union"))
    asked = candidates.join(counted, "cid").join(unions, ["comp", "chunk"])
    return asked.select("cid", "comp", "chunk", "n", "counts", "low", "union").mapInArrow(bound, "cid long, comp long, chunk int").distinct()


def opened_links(
    candidates: DataFrame, members: DataFrame, classes: DataFrame, rows: DataFrame, percent: int, words: int
) -> DataFrame:
    """(a, b): links of the querying classes with members of their candidate groups, compared on whole texts."""
    groups = candidates.select("comp", "chunk").distinct()
    of_group = members.join(groups, ["comp", "chunk"]).select("cid", "comp", "chunk")
    ends = of_group.select("cid").union(candidates.select("cid")).distinct()
    known = stage(with_text(ends, classes, rows), "group-texts")
    candidates = stage(within_bounds(candidates, of_group, known, percent, words), "opened-groups")
    of_group = of_group.join(candidates.select("comp", "chunk").distinct(), ["comp", "chunk"], "left_semi")
    packed = (
        of_group.join(known, "cid")
        .groupBy("comp", "chunk")
        .agg(F.collect_list(F.struct(F.col("cid").alias("b"), F.col("text").alias("t"))).alias("members"))
    )
    asked = candidates.join(known, "cid").join(packed, ["comp", "chunk"]).select("cid", "text", "members")

    def open_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(words, 512)
        for batch in batches:
            for k in range(batch.num_rows):
                cid, text, group = (batch.column(c)[k].as_py() for c in range(3))
                query = sets.of(cid, text)
                own = [(m["b"], sets.of(m["b"], m["t"])) for m in group]
                union = np.unique(np.concatenate([s for _, s in own]))
                bound = len(np.intersect1d(query, union, assume_unique=True))
                if 100 * bound < percent * len(query):
                    continue
                found = [b for b, s in own if linked(query, s, percent)]
                yield pa.RecordBatch.from_arrays([pa.array([cid] * len(found), pa.int64()), pa.array(found, pa.int64())], ["a", "b"])

    return asked.mapInArrow(open_groups, "a long, b long").distinct()


def similar_documents(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, group: int = GROUP) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) and n_links of every row.

    n_links counts the verified links of the row's class that were needed to connect its component.
    """
    begun = mark()
    rows = texts(docs).select(
        F.coalesce("doc_id", F.lit(LOWEST_ID)).alias("did"), F.xxhash64("text").alias("th"), "text"
    )
    index = stage(set_index(rows, percent, words), "shingle-index")
    filled = index.where("n > 0")
    classes = stage(
        filled.groupBy("cid").agg(
            F.min(F.struct("did", "th")).alias("rep"),
            F.max("n").alias("n"),
            F.max("central").alias("central"),
            F.max("minima").alias("minima"),
        ).select("cid", "rep.did", "rep.th", "n", "central", "minima"),
        "shingle-classes",
    )
    since = mark()
    seeds = stage(verified_pairs(stage(seed_pairs(classes, percent), "seed-pairs"), classes, rows, percent, words), "seed-links")
    tidy(docs.sparkSession, since)
    found = stage(components(seeds), "seed-components")
    sizes = found.groupBy("component").agg(F.count("*").alias("size"))
    chunk = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / group)).cast("int")
    chunks = stage(
        found.join(sizes, "component").select(F.col("node").alias("cid"), F.col("component").alias("comp"), chunk.alias("chunk")),
        "groups",
    )
    grouped = filled.select("cid", "n", "first").where(F.size("first") > 0).join(chunks, "cid", "left")
    grouped = grouped.select(
        "cid", "n", F.coalesce("comp", "cid").alias("comp"), F.coalesce("chunk", F.lit(0)).alias("chunk"), F.posexplode("first").alias("pos", "token")
    )
    same = Window.partitionBy("token")
    shared = grouped.withColumns({"c0": F.min("comp").over(same), "c1": F.max("comp").over(same)}).where("c0 <> c1").drop("c0", "c1")
    since = mark()
    postings = stage(shared, "matrix-postings")
    candidates = stage(group_pairs(postings, percent), "group-candidates")
    alone = candidates.select("comp", "chunk").distinct().join(chunks.select("comp").distinct(), "comp", "left_anti")
    members = chunks.union(alone.select(F.col("comp").alias("cid"), "comp", "chunk"))
    extra = stage(opened_links(candidates, members, classes, rows, percent, words), "group-links")
    tidy(docs.sparkSession, since)
    links = seeds.union(extra)
    joined = components(seeds.union(extra)) if extra.limit(1).count() else found
    degree = links.select(F.col("a").alias("cid")).union(links.select(F.col("b").alias("cid"))).groupBy("cid").agg(F.count("*").alias("n_links"))
    labelled = classes.select("cid", "did").join(joined.select(F.col("node").alias("cid"), "component"), "cid", "left")
    labelled = labelled.select("cid", "did", F.coalesce("component", "cid").alias("component"))
    least = labelled.groupBy("component").agg(F.min("did").alias("least"))
    per_class = labelled.join(least, "component").join(degree, "cid", "left").select("cid", "least", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = index.select("did", "th", "n", F.when(F.col("n") > 0, F.col("cid")).alias("cid")).join(per_class, "cid", "left")
    real = lambda c: F.when(c != LOWEST_ID, c)
    out = out.select(
        real(F.col("did")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        real(F.coalesce("least", "did")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "did",
        "th",
    )
    out = stage(out, "similar-documents")  # a few longs per row
    tidy(docs.sparkSession, begun)
    return out


def one_of_each_group(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of docs with the smallest id of their component; all columns are kept."""
    found = similar_documents(docs, percent)
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("did", "th").distinct()
    return without_keys(docs, bounded(gone, "similar"), by_text=True)

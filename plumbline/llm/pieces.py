"""SentencePiece encoding and decoding with distinct sampled segmentations.

A text is a chain of lattices, one per stretch that no piece crosses (white-space runs with the word behind them). Edges are the
vocabulary's pieces; an edge weighs the logarithm of a Zipf share of the piece's rank. Backward sums over the lattice give
each edge its probability, and a segmentation of the text is a path with the product of its edges.

`samples` distinct segmentations are drawn without replacement by perturbed A-star search. Each set of paths has a
Gumbel-perturbed maximum of its log-probability; the frontier is ordered by it. The best set is taken, its best path is
drawn edge by edge, and the rest of the set is split at every edge of the path ("the same up to here, another edge
here"), each part with a Gumbel value truncated at the value of the set it came from. The paths come in the order of
their perturbed log-probability, which makes them a sample without replacement; a path's inclusion score is
1 - exp(-exp(log_prob - t)), t being the value of the best set that is left (1 if none is left).

Random numbers are hashes of the row key, the sample, the stretch and the step, so a row's samples depend on its key
(doc_id and text) and the seed alone, not on partitions or batches.

Decoding joins the pieces' bytes. Characters without a piece are spelled in byte pieces, also a literal U+2581, so
decoding gives back every text exactly, lone surrogates included.

Defined cases: null and empty texts have one piece sequence, that of the leading space; a text with fewer than `samples`
segmentations has as many rows as it has segmentations; rows that repeat get the same samples; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import LOWEST_ID, mix, texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
SEED = 17
CHUNK_BYTES = 1_000_000
SPACE = b"\xfe"  # stands for the piece mark; no UTF-8 text has this byte
STOP = 0xFD  # parts the stretches of a chunk; neither texts nor pieces have it
STRETCH = re.compile(rb"\xfe+[^\xfe\n]*|\n|[^\xfe\n]+")


class Vocabulary:
    """Pieces as bytes, their log weights, and a trie whose inner nodes are rows of 256 followers."""

    def __init__(self, pieces: list[str], is_byte: list[bool], is_special: list[bool]):
        self.bytes: list[bytes] = []
        self.byte_id = np.full(256, -1, np.int32)
        words: list[tuple[bytes, int]] = []
        for i, piece in enumerate(pieces):
            if is_byte[i]:
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.bytes.append(bytes([value]))
            elif is_special[i]:
                self.bytes.append(b"")
            else:
                found = piece.encode("utf-8").replace("▁".encode(), SPACE)
                if SPACE in found.lstrip(SPACE) or b"\n" in found:
                    raise ValueError("a piece crosses the stretches of a text")
                self.bytes.append(found)
                words.append((found, i))
        if (self.byte_id < 0).any() or not words:
            raise ValueError("the vocabulary needs all byte pieces")
        first = min(i for _, i in words)
        self.log_weight = -np.log(np.maximum(np.arange(len(pieces)) - first, 0) + 2.7)
        self.log_weight[self.byte_id] = -np.log(len(pieces) + 2.7)
        self.log_weight -= np.log(np.exp(self.log_weight).sum())
        children: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]
        for found, i in words:
            node = 0
            for b in found:
                nxt = children[node].get(b)
                if nxt is None:
                    nxt = children[node][b] = len(children)
                    children.append({})
                    ends.append(-1)
                node = nxt
            ends[node] = i
        # Inner nodes get the low numbers and a row each; leaves have no row.
        inner = [k for k, c in enumerate(children) if c]
        rank = {k: r for r, k in enumerate([*inner, *(k for k, c in enumerate(children) if not c)])}
        self.n_inner = len(inner)
        self.next = np.zeros((self.n_inner, 256), np.int32)  # 0 is the root: nothing leads there
        self.end = np.full(len(children), -1, np.int32)
        for k, c in enumerate(children):
            self.end[rank[k]] = ends[k]
            for b, nxt in c.items():
                self.next[rank[k], b] = rank[nxt]

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        return cls(*piece_table(path))

    def decode(self, ids) -> str:
        data = b"".join(map(self.bytes.__getitem__, ids))
        return data[1:].replace(SPACE, b" ").decode("utf-8", "surrogatepass")


def piece_table(path: str) -> tuple[list[str], list[bool], list[bool]]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = range(model.get_piece_size())
    return (
        [model.id_to_piece(i) for i in n],
        [bool(model.is_byte(i)) for i in n],
        [bool(model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in n],
    )


def stretches(text: str) -> list[bytes]:
    return STRETCH.findall(SPACE + text.encode("utf-8", "surrogatepass").replace(b" ", SPACE))


class Lattice:
    """The lattices of distinct stretches laid end to end. The edges of a node lie together, long pieces first.

    `edge_id`, `edge_to` and `edge_log` are an edge's piece, the node it leads to and its conditional log-probability;
    `upto` is the probability of the node's edges up to this one.
    """

    def __init__(self, vocabulary: Vocabulary, distinct: list[bytes]):
        sizes = np.fromiter(map(len, distinct), np.int64, len(distinct))
        x = np.frombuffer(bytes([STOP]).join(distinct) + bytes([STOP]), np.uint8)
        self.first = (np.cumsum(sizes + 1) - sizes - 1).astype(np.int32)  # a chunk has far fewer bytes than 2^31
        sizes = sizes.astype(np.int32)
        self.stop = self.first + sizes
        n = len(x)
        inside = np.ones(n, bool)
        inside[self.stop] = False
        at = np.flatnonzero(inside).astype(np.int32)
        state = np.zeros(len(at), np.int32)
        begins, ends, ids = [], [], []
        length = 0
        whole = np.zeros(n, bool)  # nodes where a character of its own piece begins
        width = np.ones(n, np.int8)
        width[x >= 0xC0] = 2
        width[x >= 0xE0] = 3
        width[(x >= 0xF0) & (x < 0xF8)] = 4
        width[x == SPACE[0]] = 1
        where = at
        while len(where):
            state = vocabulary.next[state, x[where + length]]
            length += 1
            alive = state > 0
            where, state = where[alive], state[alive]
            found = vocabulary.end[state]
            hit = found >= 0
            begins.append(where[hit])
            ends.append(where[hit] + length)
            ids.append(found[hit])
            single = where[hit][width[where[hit]] == length]
            whole[single] = True
            inner = state < vocabulary.n_inner
            where, state = where[inner], state[inner]
        # A character without a piece is spelled byte by byte.
        lead = at[(x[at] & 0xC0) != 0x80]
        bare = lead[~whole[lead]]
        spelled = [bare]
        for k in range(1, 4):
            more = bare[width[bare] > k] + k
            spelled.append(more[(more < n)])
        spelled = np.unique(np.concatenate(spelled))
        spelled = spelled[inside[spelled] & ((x[spelled] & 0xC0) == 0x80) | np.isin(spelled, bare)]
        begins.append(spelled)
        ends.append(spelled + 1)
        ids.append(vocabulary.byte_id[x[spelled]])
        begin, end, piece = np.concatenate(begins), np.concatenate(ends).astype(np.int32), np.concatenate(ids)
        del begins, ends, ids
        # Backward sums, from the last node of every stretch to the first, all stretches at once: edges are
        # sorted by how far their node is from the end of its stretch, then by node.
        total = np.full(n, -np.inf)
        total[self.stop] = 0.0
        to_go = np.repeat(self.stop, sizes + 1)[begin] - begin
        # Longer pieces, which are likelier as a rule, come first.
        order = np.argsort((to_go.astype(np.int64) * n + begin) * 64 + (63 - np.minimum(end - begin, 63)))
        begin, end, piece, to_go = begin[order], end[order], piece[order], to_go[order]
        weight = vocabulary.log_weight[piece]
        cuts = np.searchsorted(to_go, np.arange(1, (int(sizes.max()) if len(sizes) else 0) + 2))
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            if low == high:
                continue
            value = weight[low:high] + total[end[low:high]]
            source = begin[low:high]
            edge = np.flatnonzero(np.concatenate([[True], source[1:] != source[:-1]]))
            top = np.maximum.reduceat(value, edge)
            top_safe = np.where(np.isfinite(top), top, 0.0)
            spread = np.repeat(top_safe, np.diff(np.concatenate([edge, [high - low]])))
            with np.errstate(divide="ignore"):
                total[source[edge]] = top_safe + np.log(np.add.reduceat(np.exp(value - spread), edge))
        with np.errstate(invalid="ignore"):
            log = np.minimum(weight + total[end] - total[begin], 0.0)
        good = np.isfinite(log)
        if not good.all():
            begin, end, piece, log = begin[good], end[good], piece[good], log[good]
        self.edge_from, self.edge_to, self.edge_id, self.edge_log = begin, end, piece, log
        share = np.exp(log)
        heads = np.flatnonzero(np.concatenate([[True], begin[1:] != begin[:-1]])) if len(share) else np.empty(0, np.int64)
        lasts = np.concatenate([heads[1:], [len(share)]]) if len(share) else heads
        # Added up node by node, so that rounding does not depend on what else is in the chunk.
        self.upto = share.copy()
        more = heads[lasts - heads > 1] + 1
        ends_of = lasts[lasts - heads > 1]
        while len(more):
            self.upto[more] += self.upto[more - 1]
            more, ends_of = more[more + 1 < ends_of] + 1, ends_of[more + 1 < ends_of]
        self.upto[lasts - 1] = 2.0  # rounding must leave no gap
        # The edges of a node lie from edge_begin to edge_end.
        self.edge_begin, self.edge_end = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.edge_begin[begin[heads]] = heads
        self.edge_end[begin[heads]] = lasts

    def draw(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge for each node, in proportion to probability."""
        at = self.edge_begin[node]
        beyond = np.flatnonzero(u >= self.upto[at])
        while len(beyond):
            at[beyond] += 1
            beyond = beyond[u[beyond] >= self.upto[at[beyond]]]
        return at


def uniform(key: np.ndarray, *counters) -> np.ndarray:
    """Numbers strictly between 0 and 1 that depend on the keys and counters alone."""
    out = key
    for c in counters:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + np.asarray(c, np.uint64) + np.uint64(1))
    return ((out >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def truncated(location: np.ndarray, u: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Gumbel values around `location`, given that they are below `limit`."""
    gumbel = location - np.log(-np.log(u))
    low = np.minimum(gumbel, limit)
    return low - np.log1p(np.exp(-np.abs(gumbel - limit)))


class Sampler:
    """Distinct sampled segmentations of the texts of a chunk."""

    def __init__(self, vocabulary: Vocabulary, chunk: list[str], keys: np.ndarray, samples: int):
        lists = [stretches(t) for t in chunk]
        coded = pa.array([s for parts in lists for s in parts], pa.large_binary()).dictionary_encode()
        self.vocabulary, self.keys, self.samples = vocabulary, keys, samples
        self.lattice = Lattice(vocabulary, coded.dictionary.to_pylist())
        self.kind = coded.indices.to_numpy()
        sizes = np.array([len(p) for p in lists], np.int64)
        self.text_first = np.concatenate([[0], np.cumsum(sizes)])  # of its stretches
        self.owner = np.repeat(np.arange(len(chunk)), sizes)
        self.place = np.arange(len(self.kind)) - np.repeat(self.text_first[:-1], sizes)

    def draw_all(self, sample: int) -> tuple[np.ndarray, np.ndarray]:
        """A path for every stretch: all edges in order, and where each stretch's edges begin."""
        lattice = self.lattice
        node, stop = lattice.first[self.kind], lattice.stop[self.kind]
        key = mix(self.keys[self.owner] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(sample + 1))
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + self.place.astype(np.uint64))
        active = np.arange(len(node))
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        count = np.zeros(len(node), np.int64)
        while len(active):
            edge = lattice.draw(node[active], uniform(key[active], len(steps)))
            steps.append((active, edge))
            count[active] += 1
            node[active] = lattice.edge_to[edge]
            active = active[node[active] < stop[active]]
        begin = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(begin[-1], np.int64)
        for k, (who, edge) in enumerate(steps):
            out[begin[who] + k] = edge
        return out, begin

    def branch(self, text: int, sample: int, prefix: list[int], node: int, stop: int, excluded: list[int]) -> list[int] | None:
        """The edges of one stretch: those of the prefix, then another than the excluded ones, then drawn freely."""
        lattice = self.lattice
        out, step = list(prefix), 0
        key = self.keys[text : text + 1]
        while node < stop:
            low, high = lattice.edge_begin[node], lattice.edge_end[node]
            share = np.exp(lattice.edge_log[low:high])
            if step == 0:
                share[[e - low for e in excluded]] = 0.0
            upto = np.cumsum(share)
            if upto[-1] <= 0:
                return None
            u = float(uniform(key, 1_000_003 + sample, step)[0]) * upto[-1]
            k = min(int(np.searchsorted(upto, u, side="right")), len(share) - 1)
            while share[k] == 0.0:
                k -= 1
            out.append(int(low + k))
            node = int(lattice.edge_to[low + k])
            step += 1
        return out

    def run(self) -> Iterator[tuple[int, int, np.ndarray, float, float, float]]:
        """(text, sample, pieces, log probability, perturbed value, inclusion), text by text within a sample."""
        lattice, n = self.lattice, len(self.keys)
        edges, begin = self.draw_all(0)
        gumbel = -np.log(-np.log(uniform(self.keys, 0, 0)))
        frontier: list[list[tuple[float, int, int, int, tuple[int, ...]]]] = [[] for _ in range(n)]
        paths: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # edges, begins of stretches, log up to each edge
        value, alive = gumbel, np.ones(n, bool)
        since = np.zeros(n, np.int64)  # the first edge of a path at which its set may be split
        barred: list[tuple[int, ...]] = [()] * n
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        serial = 0
        for sample in range(self.samples):
            logs = lattice.edge_log[edges]
            text_begin = begin[self.text_first]
            counts = np.diff(text_begin)
            upto, total = np.empty(len(logs)), np.zeros(n)
            for i, (low, high) in enumerate(zip(text_begin[:-1], text_begin[1:], strict=True)):
                run = np.cumsum(logs[low:high])  # text by text: rounding must not depend on the chunk
                upto[low] = 0.0
                upto[low + 1 : high] = run[:-1]
                total[i] = run[-1]
            found.append((edges, text_begin, np.where(alive, total, np.nan), value.copy()))
            paths.append((edges, begin, upto))
            # Split what is left of each text's set at every edge of its path.
            owner = np.repeat(np.arange(n), counts)
            index = np.arange(len(edges)) - np.repeat(text_begin[:-1], counts)
            taken = np.exp(logs)
            for i in np.flatnonzero(alive):
                if barred[i]:
                    at = text_begin[i] + since[i]
                    taken[at] += np.exp(lattice.edge_log[list(barred[i])]).sum()
            left = np.maximum(1.0 - taken, 0.0)
            left[left < 1e-12] = 0.0
            with np.errstate(divide="ignore"):
                location = upto + np.log(left)
            location[index < since[owner]] = -np.inf
            possible = np.flatnonzero(np.isfinite(location) & alive[owner])
            u = uniform(self.keys[owner[possible]], 2_000_003 + sample, index[possible])
            noisy = truncated(location[possible], u, value[owner[possible]])
            keep = self.samples - sample
            heads = np.searchsorted(owner[possible], np.arange(n + 1))
            for i in range(n):
                low, high = heads[i], heads[i + 1]
                if low == high:
                    continue
                part = noisy[low:high]
                best = np.argpartition(-part, keep - 1)[:keep] if len(part) > keep else range(len(part))
                for b in best:
                    at = int(index[possible[low + b]])
                    edge = int(edges[possible[low + b]])
                    bars = (*barred[i], edge) if at == since[i] else (edge,)
                    serial += 1
                    heapq.heappush(frontier[i], (-float(part[b]), serial, sample, at, bars))
            if sample + 1 == self.samples:
                break
            edges, begin, value, since, barred, alive = self._next(sample + 1, frontier, paths)
        rest = np.array([-f[0][0] if f else -np.inf for f in frontier])
        for sample, (edges, text_begin, total, value) in enumerate(found):
            for i in range(n):
                if np.isfinite(total[i]):
                    log = float(total[i])
                    score = 1.0 if not np.isfinite(rest[i]) else float(-np.expm1(-np.exp(min(log - rest[i], 50.0))))
                    ids = lattice.edge_id[edges[text_begin[i] : text_begin[i + 1]]]
                    yield i, sample + 1, ids, log, float(value[i]), score

    def _next(self, sample: int, frontier, paths):
        """Take each text's best set and draw its path: the old one up to the split, another edge, then a new draw."""
        n, lattice = len(self.keys), self.lattice
        fresh, fresh_begin = self.draw_all(sample)
        pool = [p[0] for p in paths] + [fresh]
        base = np.concatenate([[0], np.cumsum([len(p) for p in pool])])
        start = base[len(paths)] + fresh_begin[:-1]
        size = np.diff(fresh_begin)
        custom: list[int] = []
        value, since = np.full(n, -np.inf), np.zeros(n, np.int64)
        barred: list[tuple[int, ...]] = [()] * n
        alive = np.zeros(n, bool)
        for i in range(n):
            while frontier[i]:
                negative, _, of, at, bars = heapq.heappop(frontier[i])
                edges, begin, _ = paths[of]
                low, high = self.text_first[i], self.text_first[i + 1]
                place = begin[low] + at
                stretch = int(np.searchsorted(begin[low : high + 1], place, side="right")) - 1 + low
                prefix = edges[begin[stretch] : place].tolist()
                node = int(lattice.edge_from[edges[place]])
                drawn = self.branch(i, sample, prefix, node, int(lattice.stop[self.kind[stretch]]), list(bars))
                if drawn is None:
                    continue
                start[low:stretch] = base[of] + begin[low:stretch]
                size[low:stretch] = begin[low + 1 : stretch + 1] - begin[low:stretch]
                start[stretch] = base[-1] + len(custom)
                size[stretch] = len(drawn)
                custom += drawn
                value[i], since[i], barred[i], alive[i] = -negative, at, bars, True
                break
        everything = np.concatenate([*pool, np.array(custom, np.int64)])
        begin = np.concatenate([[0], np.cumsum(size)])
        edges = everything[np.arange(begin[-1]) + np.repeat(start - begin[:-1], size)]
        return edges, begin, value, since, barred, alive


def chunks(lists: list[str]) -> Iterator[tuple[int, int]]:
    low, held = 0, 0
    for i, text in enumerate(lists):
        if i > low and held + 4 * len(text) > 4 * CHUNK_BYTES:
            yield low, i
            low, held = i, 0
        held += 4 * len(text)
    if low < len(lists):
        yield low, len(lists)


def row_keys(ids: list, hashes: list[int], seed: int) -> np.ndarray:
    own = np.array([LOWEST_ID if i is None else i for i in ids], np.int64).view(np.uint64)
    return mix(mix(own + np.uint64(seed)) ^ np.array(hashes, np.int64).view(np.uint64))


def encode_samples(
    docs: DataFrame, path: str = MODEL, samples: int = SAMPLES, seed: int = SEED, keep_ids: bool = True
) -> DataFrame:
    """A row per document and sample: doc_id, sample (from 1), n_pieces, log_prob, perturbed, inclusion, ids, ids_sha256
    (of the ids as little-endian 32-bit numbers) and round_trip (decoding gives the text). Without `keep_ids` ids is null.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(piece_table(path))  # the vocabulary's pieces, a fixed size
    names = ["doc_id", "sample", "n_pieces", "log_prob", "perturbed", "inclusion", "ids", "ids_sha256", "round_trip"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = None
        for batch in batches:
            vocabulary = vocabulary or Vocabulary(*sent.value)
            ids, found, hashes = (batch.column(k).to_pylist() for k in range(3))
            for low, high in chunks(found):
                part = found[low:high]
                sampler = Sampler(vocabulary, part, row_keys(ids[low:high], hashes[low:high], seed), samples)
                rows: list[tuple] = []
                pieces: list[np.ndarray] = []
                for i, sample, got, log, value, score in sampler.run():
                    back = vocabulary.decode(got.tolist()) == part[i]
                    digest = hashlib.sha256(got.astype("<i4").tobytes()).hexdigest()
                    rows.append((ids[low + i], sample, len(got), log, value, score, digest, back))
                    if keep_ids:
                        pieces.append(got)
                if not rows:
                    continue
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                out = [pa.array(c, k) for c, k in zip(columns[:6], kinds, strict=True)]
                if keep_ids:
                    ends = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(pieces), pa.int32())))
                else:
                    out.append(pa.nulls(len(rows), pa.list_(pa.int32())))
                out += [pa.array(columns[6], pa.string()), pa.array(columns[7], pa.bool_())]
                yield pa.RecordBatch.from_arrays(out, names)

    return texts(docs).withColumn("h", F.xxhash64("text")).mapInArrow(
        encode,
        "doc_id long, sample int, n_pieces long, log_prob double, perturbed double, inclusion double, ids array<int>, "
        "ids_sha256 string, round_trip boolean",
    )


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, sample and text of rows with ids; null ids give null."""
    sent = encoded.sparkSession.sparkContext.broadcast(piece_table(path))

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = None
        for batch in batches:
            vocabulary = vocabulary or Vocabulary(*sent.value)
            found = [None if ids is None else vocabulary.decode(ids) for ids in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], ["doc_id", "sample", "text"])

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("sample").cast("int").alias("sample"), "ids")
    return rows.mapInArrow(back, "doc_id long, sample int, text string")

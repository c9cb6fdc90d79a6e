"""Codes of vectors by product quantisation: every part of a vector is replaced by the number of its nearest codebook entry.

A component x becomes the integer floor(4096 * x), and all that follows is exact. The parts of all vectors are sorted along a
Hilbert curve and cut into flat blocks; a block holds its different parts with their numbers, the least and largest value of
every component (its box) and the sums. In a round each block compares entries by the least and the largest distance that
anything in its box can have from them: entries whose least distance is above the smallest largest one are nobody's nearest.
If a single entry is left, the block's sums go to it and its parts are not looked at; else small kernels on whole numbers
compare its parts with the shortlist. The last assignment does the same with blocks of the batch that a task is reading, so
codes need not be brought together from eight places.

Equal parts are one row with a number, in a batch before they are sorted and in a block afterwards; rows are dealt by range of
the place on the curve and, for one place, by a hash of the part, so a vector that many rows hold is not one task's.

Defined cases: rows whose vector is null or holds null or non-finite entries, or whose vector has not the table's length
(the commonest; of equally common ones the longest), are left out; a length that does not divide gives the first parts one
component more; codebooks start with the smallest ids (null after all others, equal ids by their vectors), and with fewer
vectors than entries have fewer entries; ties go to the lower entry; an entry that no part is nearest to stays; labels that
are null belong together; integers are kept within 2^62, and an error beyond 64 bits is null; an empty table gives no rows;
other columns are not read.

The driver holds the codebooks: parts * entries entries.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import bounded, mark, mix, signed, stage, tidy
from plumbline.llm.vectors import combined, distinct, floors, matrix, states, usable

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
BLOCK = 256
CURVE_BITS = 63


def hilbert(points: np.ndarray, low: int, high: int) -> np.ndarray:
    """Places on a Hilbert curve through a grid over [low, high]; what lies outside counts as on the edge."""
    m, dims = points.shape
    if not dims or not m:
        return np.zeros(m, np.int64)
    dims = min(dims, CURVE_BITS)
    bits = min(8, CURVE_BITS // dims)
    span = max(high - low, 1)
    scaled = (np.clip(points[:, :dims], low, high) - low) / span * (2**bits - 1)
    axes = np.clip(np.rint(scaled), 0, 2**bits - 1).astype(np.int64).T.copy()
    # From coordinates to the transposed place on the curve: exchange and reflect from the highest bit down, then Gray code.
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for k in range(dims):
            reflect = (axes[k] >> bit) & 1 == 1
            exchange = np.where(reflect, 0, (axes[0] ^ axes[k]) & below)
            axes[0] ^= np.where(reflect, below, exchange)
            axes[k] ^= exchange
    for k in range(1, dims):
        axes[k] ^= axes[k - 1]
    turn = np.zeros(m, np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((axes[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    axes ^= turn
    place = np.zeros(m, np.int64)
    for bit in range(bits - 1, -1, -1):
        for k in range(dims):
            place = place << 1 | (axes[k] >> bit) & 1
    return place


def tie_hash(points: np.ndarray) -> np.ndarray:
    out = np.zeros(len(points), np.uint64)
    with np.errstate(over="ignore"):
        for column in points.T:
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.int64).view(np.uint64))
    return signed(out)


def largest_of(*arrays: np.ndarray) -> int:
    return max((max(abs(int(a.max())), abs(int(a.min()))) for a in arrays if a.size), default=0)


def whole(bound: int, *arrays: np.ndarray) -> tuple[np.ndarray, ...]:
    """The arrays as 64-bit integers where numbers up to `bound` fit, else as Python's."""
    return tuple(a.astype(np.int64 if bound < 2**63 else object) for a in arrays)


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all points from all entries, exact."""
    reach = largest_of(points) + largest_of(entries)
    bound = points.shape[1] * reach * reach
    if bound < 2**53:  # every number on the way is whole and fits a double
        p, e = points.astype(np.float64), entries.astype(np.float64)
        return ((p * p).sum(1)[:, None] - 2 * (p @ e.T) + (e * e).sum(1)).astype(np.int64)
    p, e = whole(bound, points, entries)
    return ((p[:, None, :] - e[None]) ** 2).sum(2)


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """[block, entry]: whether something in the block's box may have the entry as its nearest. Ties count."""
    reach = largest_of(low, high) + largest_of(entries)
    lo, hi, e = whole(max(low.shape[1], 1) * reach * reach, low, high, entries)
    under, over = lo[:, None, :] - e[None], e[None] - hi[:, None, :]
    least = (np.maximum(np.maximum(under, over), 0) ** 2).sum(2)
    most = (np.maximum(np.abs(e[None] - lo[:, None, :]), np.abs(e[None] - hi[:, None, :])) ** 2).sum(2)
    return least <= most.min(1)[:, None]


def weighted_sums(points: np.ndarray, weights: np.ndarray) -> np.ndarray:
    p, w = whole(largest_of(points) * int(weights.sum()), points, weights)
    return (p * w[:, None]).sum(0)


class Shape:
    """Where the parts of a vector lie, the range of the curve's grid, and the width of an integer in a block."""

    def __init__(self, size: int, parts: int, low: int, high: int, kind: type):
        sizes = [size // parts + (k < size % parts) for k in range(parts)]
        self.size, self.parts, self.low, self.high, self.kind = size, parts, low, high, kind
        self.edges = np.cumsum([0, *sizes]).tolist()

    def width(self, part: int) -> int:
        return self.edges[part + 1] - self.edges[part]

    def part(self, x: np.ndarray, part: int) -> np.ndarray:
        return x[:, self.edges[part] : self.edges[part + 1]]

    def unpacked(self, data: bytes, part: int, rows: int) -> np.ndarray:
        return np.frombuffer(data, self.kind).reshape(rows, self.width(part)).astype(np.int64)


def shape_of(rows: DataFrame, size: int, parts: int) -> Shape:
    """The shape for vectors as `usable` gives them. The grid spans what nearly all vectors reach; it decides order alone."""
    least, most = F.array_min("vector"), F.array_max("vector")
    found = rows.agg(
        F.min(least), F.max(most), F.percentile_approx(least, 0.05), F.percentile_approx(most, 0.95)
    ).first()
    if found[0] is None:
        return Shape(size, parts, 0, 1, np.int64)
    lowest, highest, low, high = floors(np.array(list(found), np.float64), SCALE).tolist()
    kind = next(k for k in (np.int16, np.int32, np.int64) if np.iinfo(k).min <= lowest and highest <= np.iinfo(k).max)
    return Shape(size, parts, low, high, kind)


def sorted_parts(rows: DataFrame, shape: Shape) -> DataFrame:
    """part, place, tie, number, data: the different parts of each batch, dealt and sorted by their place on the curve."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = floors(matrix(batch.column(0), shape.size), SCALE)
            for part in range(shape.parts):
                points, number = distinct(shape.part(x, part))
                packed = points.astype(shape.kind)
                columns = [
                    pa.array(np.full(len(points), part, np.int32)),
                    pa.array(hilbert(points, shape.low, shape.high)),
                    pa.array(tie_hash(points)),
                    pa.array(number.astype(np.int64)),
                    pa.array([p.tobytes() for p in packed], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["part", "place", "tie", "number", "data"])

    parts = rows.select("vector").mapInArrow(cut, "part int, place long, tie long, number long, data binary")
    return parts.repartitionByRange("part", "place", "tie").sortWithinPartitions("part", "place", "tie")


def blocks(rows: DataFrame, shape: Shape) -> DataFrame:
    """A row per block: part, rows, low, high, sums, numbers and data."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for batch in batches:
            of_part, number = batch.column(0).to_numpy(), batch.column(3).to_numpy()
            data = batch.column(4)
            for part in np.unique(of_part).tolist():
                at = np.flatnonzero(of_part == part)
                packed = b"".join(data.slice(int(at[0]), len(at)).to_pylist())
                points = shape.unpacked(packed, part, len(at))
                first = np.flatnonzero(np.r_[True, (points[1:] != points[:-1]).any(1)])
                points, numbers = points[first], np.add.reduceat(number[at], first)
                for a in range(0, len(points), BLOCK):
                    p, n = points[a : a + BLOCK], numbers[a : a + BLOCK]
                    sums = pickle.dumps(weighted_sums(p, n).tolist())
                    box = (p.min(0).tobytes(), p.max(0).tobytes())
                    out.append((part, len(p), *box, sums, n.tobytes(), p.astype(shape.kind).tobytes()))
            yield _rows_of(out)
            out = []

    return sorted_parts(rows, shape).mapInArrow(build, BLOCK_SCHEMA)


BLOCK_SCHEMA = "part int, rows int, low binary, high binary, sums binary, numbers binary, data binary"
_KINDS = [pa.int32(), pa.int32(), *[pa.binary()] * 5]


def _rows_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_KINDS)
    names = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], names)


# A codebook is a matrix of whole numbers, one row an entry.
Books = list[np.ndarray]


def plus(held: bytes | None, state: bytes) -> bytes:
    if held is None:
        return state
    a, b = pickle.loads(held), pickle.loads(state)
    for key, (count, sums) in b.items():
        own = a.get(key, (0, [0] * len(sums)))
        a[key] = (own[0] + count, [x + y for x, y in zip(own[1], sums, strict=True)])
    return pickle.dumps(a)


def round_sums(table: DataFrame, shape: Shape, books: Books) -> dict:
    """(part, entry) -> number and sums of the parts that have the entry as their nearest."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], tuple[int, list[int]]] = {}

        def give(part: int, entry: int, count: int, sums: list[int]) -> None:
            own = total.get((part, entry), (0, [0] * len(sums)))
            total[part, entry] = (own[0] + count, [x + y for x, y in zip(own[1], sums, strict=True)])

        for batch in batches:
            of_part = batch.column(0).to_numpy()
            for part in np.unique(of_part).tolist():
                at, width = np.flatnonzero(of_part == part), shape.width(part)
                box = [
                    np.frombuffer(b"".join(batch.column(c).take(pa.array(at)).to_pylist()), np.int64).reshape(len(at), width)
                    for c in (2, 3)
                ]
                short = shortlists(*box, books[part])
                for i, row in enumerate(at.tolist()):
                    left = np.flatnonzero(short[i])
                    numbers = np.frombuffer(batch.column(5)[row].as_py(), np.int64)
                    if len(left) == 1:
                        give(part, int(left[0]), int(numbers.sum()), pickle.loads(batch.column(4)[row].as_py()))
                        continue
                    points = shape.unpacked(batch.column(6)[row].as_py(), part, len(numbers))
                    nearest = distances(points, books[part][left]).argmin(1)
                    for k in np.unique(nearest).tolist():
                        own = nearest == k
                        sums = weighted_sums(points[own], numbers[own])
                        give(part, int(left[k]), int(numbers[own].sum()), sums.tolist())
        yield states([(0, pickle.dumps(total))] if total else [])

    parts = table.mapInArrow(assign, "part int, state binary").withColumn("part", F.spark_partition_id())
    state = combined(parts, plus)
    return {} if state is None else pickle.loads(state)


def first_books(rows: DataFrame, shape: Shape, entries: int) -> Books:
    start = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").collect()
    x = floors(np.array([r.vector for r in start], np.float64).reshape(len(start), shape.size), SCALE)
    return [shape.part(x, part) for part in range(shape.parts)]


def train(rows: DataFrame, shape: Shape, entries: int = ENTRIES, rounds: int = ROUNDS) -> Books:
    """Codebooks for vectors as `usable` gives them."""
    books = first_books(rows, shape, entries)
    if not len(books[0]):
        return books
    since = mark()
    table = stage(blocks(rows, shape), "vector-blocks")
    for _ in range(rounds):
        new = [b.copy() for b in books]
        for (part, entry), (count, sums) in round_sums(table, shape, books).items():
            new[part][entry] = [s // count for s in sums]
        books = new
    tidy(rows.sparkSession, since, keep=0)
    return books


def digest(books: Books) -> str:
    numbers = [str(v) for book in books for entry in book.tolist() for v in entry]
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def nearest_in_blocks(points: np.ndarray, book: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every point and its squared distance, over blocks along the curve."""
    order = np.argsort(hilbert(points, shape.low, shape.high), kind="stable")
    starts = np.arange(0, len(points), BLOCK)
    ordered = points[order]
    if points.shape[1]:
        short = shortlists(np.minimum.reduceat(ordered, starts), np.maximum.reduceat(ordered, starts), book)
    else:
        short = np.ones((len(starts), len(book)), bool)
    entry, error = np.zeros(len(points), np.int64), np.zeros(len(points), object)
    for k, a in enumerate(starts.tolist()):
        left = np.flatnonzero(short[k])
        found = distances(ordered[a : a + BLOCK], book[left])
        best, own = found.argmin(1), order[a : a + BLOCK]
        entry[own] = left[best]
        error[own] = found[np.arange(len(best)), best]
    return entry, error


def encode(rows: DataFrame, shape: Shape, books: Books) -> DataFrame:
    """vec_id, label, code (two hexadecimal digits a part) and error (squared distances over all parts) of every row."""
    schema = T.StructType(
        [
            *[T.StructField(c, rows.schema[c].dataType) for c in ("vec_id", "label")],
            T.StructField("code", T.StringType()),
            T.StructField("error", T.LongType()),
        ]
    )

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = floors(matrix(batch.column(2), shape.size), SCALE)
            found, error = np.zeros((m, shape.parts), np.uint8), np.zeros(m, object)
            for part in range(shape.parts):
                found[:, part], own = nearest_in_blocks(shape.part(x, part), books[part], shape)
                error = error + own
            errors = [e if e < 2**63 else None for e in map(int, error)]
            text = pa.array([c.tobytes().hex() for c in found], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), text, pa.array(errors, pa.int64())], [f.name for f in schema]
            )

    return rows.select("vec_id", "label", "vector").mapInArrow(codes, schema)


def decode(coded: DataFrame, books: Books) -> DataFrame:
    """The rows with `approximation`: the middle of the cell of each component of the entries that `code` names."""
    entries = [[[float(v + 0.5) / SCALE for v in entry] for entry in book.tolist()] for book in books]

    def of_part(part: int):
        number = F.conv(F.substring("code", 2 * part + 1, 2), 16, 10).cast("int")
        return F.element_at(F.lit(entries[part]) if entries[part] else F.array(), number + 1)

    return coded.withColumn("approximation", F.concat(*[of_part(part) for part in range(len(books))]))


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """vec_id, label, code, error, label_error (errors of all rows with the label) and codebooks_sha256 of every usable row.

    At most 256 entries, so that two digits name one.
    """
    if not 1 <= entries <= 256:
        raise ValueError("1 to 256 entries")
    if "label" not in vectors.columns:
        vectors = vectors.withColumn("label", F.lit(None).cast("int"))
    rows, size = usable(vectors.select("vec_id", "label", "embedding"))
    shape = shape_of(rows, size, parts)
    books = train(rows, shape, entries, rounds)
    since = mark()
    coded = stage(encode(rows, shape, books), "vector-codes")
    labels = coded.groupBy("label").agg(F.try_sum("error").alias("label_error"))
    labels = bounded(labels.withColumnRenamed("label", "of_label"), "vector-labels")
    tidy(vectors.sparkSession, since, keep=2)
    return (
        coded.join(labels, coded["label"].eqNullSafe(labels["of_label"]))
        .drop("of_label")
        .withColumn("codebooks_sha256", F.lit(digest(books)))
    )

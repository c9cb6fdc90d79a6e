"""Words, hashes, folds and staging shared by the operators of this subpackage."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import scratch_dir

LOWEST_ID = -(2**63)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = " \t\n\x0b\x0c\r"


def texts(docs: DataFrame, *extra: str) -> DataFrame:
    """doc_id and text (null becomes empty) and nothing else, so no other column of the input can clash."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *extra,
    )


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(parts))


class _Staged(threading.local):
    """The copies that a thread has staged, so queries that run at once don't remove each other's."""

    def __init__(self):
        self.paths: list[str] = []


_staged = _Staged()


def stage(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write to the shared folder and read back: the lineage ends there and a lost executor costs nothing.

    `by` names a column whose values get folders of their own.
    """
    path = scratch_dir(df.sparkSession, label)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    _staged.paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark() -> int:
    """A point in the sequence of staged copies, for `tidy`."""
    return len(_staged.paths)


def tidy(spark: SparkSession, since: int, keep: int = 1) -> None:
    """Remove the copies staged since a point, but for the last `keep`. Nothing still to be computed may read them."""
    jvm = spark.sparkContext._jvm
    last = len(_staged.paths) - keep
    for name in _staged.paths[since:last]:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    del _staged.paths[since:last]


# Rows of a few longs that are sent to every task at most; more are joined by a shuffle.
BROADCAST_ROWS = 2_000_000


def bounded(small: DataFrame, label: str) -> DataFrame:
    """A written table of keys, marked for broadcast if it has at most BROADCAST_ROWS rows."""
    small = stage(small, label)
    return F.broadcast(small) if small.count() <= BROADCAST_ROWS else small


def without_keys(docs: DataFrame, gone: DataFrame, by_text: bool = False) -> DataFrame:
    """The rows of docs whose id is not in `gone` (did: null ids as LOWEST_ID); `by_text`: id and text hash (did, th)."""
    key = F.coalesce(docs["doc_id"].cast("long"), F.lit(LOWEST_ID)) == gone["did"]
    if by_text:
        key &= F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == gone["th"]
    return docs.join(gone, key, "left_anti")


def fresh_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


def words_of(text: str) -> list[bytes]:
    """Maximal runs of `[^\\x20\\x09-\\x0D]` as UTF-8 bytes; bytes.split() cuts at exactly these six characters."""
    return text.encode("utf-8", "surrogatepass").split()


def lower_words_of(text: str) -> list[bytes]:
    """The same with A-Z lower-cased; bytes.lower() leaves all other letters alone."""
    return text.encode("utf-8", "surrogatepass").lower().split()


class WordHashes(dict):
    """64-bit hashes of words, remembered. The memory is emptied when full, so it is bounded."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """One 64-bit hash for every `n` consecutive words; order matters. Empty if there are fewer words."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:size].copy()
    for k in range(1, n):
        out *= _ODD
        out ^= out >> np.uint64(29)
        out += hashes[k : k + size]
    return mix(out)


def whole_hash(hashes: np.ndarray) -> np.uint64:
    """One hash for a sequence that is too short for a shingle; its length is part of it."""
    out = np.uint64(len(hashes))
    with np.errstate(over="ignore"):
        for h in hashes:
            out = mix(np.array([out * _ODD + h], np.uint64))[0]
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


SLICES = 32
SALTS = 8


def vector_rows(vector: np.ndarray) -> pa.RecordBatch:
    """A vector as SLICES rows (slice, data as single precision), to be added up by `vector_sum`."""
    parts = [p.tobytes() for p in np.array_split(vector.astype(np.float32), SLICES)]
    return pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], ["slice", "data"])


def vector_sum(parts: DataFrame, size: int, finish=None, kind=np.float64) -> np.ndarray:
    """The sum of all vectors of `size` numbers in `parts`, in doubles. Tasks add them up as they stream by, in two
    rounds, so that none of them reads a slice of every input task; the driver gets one vector. `finish` turns the
    sums into numbers of `kind` before they are sent."""

    def adding(kind, finish=None):
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for k, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    found = np.frombuffer(part.as_buffer(), kind)
                    if k not in total:
                        total[k] = np.zeros(len(found))
                    total[k] += found
            sums = [finish(t) if finish else t for t in total.values()]
            rows = [pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in sums], pa.binary())]
            yield pa.RecordBatch.from_arrays(rows, ["slice", "data"])

        return add

    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    parts = parts.repartition("slice", salt).mapInArrow(adding(np.float32), "slice int, data binary")
    parts = parts.repartition("slice").mapInArrow(adding(np.float64, finish), "slice int, data binary")
    out = np.array_split(np.zeros(size, kind), SLICES)
    for r in parts.collect():
        out[r.slice] = np.frombuffer(r.data, kind)
    return np.concatenate(out)

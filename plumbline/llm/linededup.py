"""Lines that several documents share, found with levelled sorted runs of line hashes. DataFrame operations only.

A run is a table of line hashes in sorted order: how many documents of a batch hold the line, and the largest of their ids.
Batches of documents come one after the other. A batch counts its own lines and is merge-anti-joined with the runs: lines
that no run knows become a run of level 0, so that each line is in exactly one run, that of the batch that brought it. Lines
that a run knows become an increment. When a level holds FAN_IN runs they are compacted into one of the next level, which is
a merge of different keys and no count. A line is shared if its run or its increments say so; lines that no later batch
brought again are never brought together with anything. Documents are dealt to batches by a hash of their id, so the counts
of batches add up. Runs can be written and loaded, and take in further batches later.

A line's key is the line without `[\\x20\\x09-\\x0D]` at both ends and with A-Z lower-cased. Keys are compared by 128 bits
of two differently seeded 64-bit hashes.

Defined cases: null or empty text is one empty line; documents are told apart by doc_id, so rows that repeat an id are
one document, and a null id counts as the smallest; keys shorter than `least_length` code points are never dropped; an
empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import LOWEST_ID, SPACES, UPPER, mark, stage, tidy

LEAST_LENGTH = 20
LEAST_DOCS = 3
BATCHES = 4
FAN_IN = 2
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, UPPER.lower())


def numbered(docs: DataFrame) -> DataFrame:
    """The rows as a struct `row`, with doc_id, text, did (null counts as the smallest id) and th (a hash of the text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")
    )
    return own.select("row", "doc_id", "text", F.coalesce("doc_id", F.lit(LOWEST_ID)).alias("did"), F.xxhash64("text").alias("th"))


def line_hashes(docs: DataFrame, least_length: int) -> DataFrame:
    """A row for each line with a key of `least_length` or more: h1, h2, did, th and the line's place in its text."""
    lines = numbered(docs).select("did", "th", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    # Most lines need no second look: bytes bound code points from above.
    keyed = lines.where(F.length("line") >= least_length).withColumn("key", line_key(F.col("line")))
    return keyed.where(F.length("key") >= least_length).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), "did", "th", "pos"
    )


COUNTS = "h1 long, h2 long, n_docs long, last_did long"


def counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy(KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("last_did").alias("last_did"))


class Runs:
    """The levelled runs and the increments. Each is a Parquet folder in the shared folder: h1, h2, n_docs, last_did."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.levels: dict[int, list[DataFrame]] = {}
        self.increments: list[DataFrame] = []

    def _together(self, runs: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, runs) if runs else self.spark.createDataFrame([], COUNTS)

    def known(self) -> DataFrame:
        """Every line that a run holds, once."""
        return self._together([run for level in sorted(self.levels) for run in self.levels[level]])

    def add(self, lines: DataFrame) -> None:
        """Take in a batch of lines (h1, h2, did): the fresh ones as a run, the known ones as an increment."""
        own = lines.groupBy(KEY).agg(F.countDistinct("did").alias("n_docs"), F.max("did").alias("last_did"))
        if self.levels:
            own, known = stage(own, "line-batch"), self.known().select(KEY)
            self.increments.append(stage(own.join(known, KEY, "left_semi"), "line-increment"))
            own = own.join(known, KEY, "left_anti")
        self.levels.setdefault(0, []).append(stage(own.sortWithinPartitions(KEY), "line-run-0"))
        self._compact()

    def _compact(self) -> None:
        level = 0
        while len(self.levels.get(level, [])) >= FAN_IN:
            runs = self._together(self.levels.pop(level)).repartition(*KEY).sortWithinPartitions(KEY)
            self.levels.setdefault(level + 1, []).append(stage(runs, f"line-run-{level + 1}"))
            level += 1

    def shared(self, least_docs: int) -> DataFrame:
        """h1, h2, n_docs, last_did of the lines that `least_docs` documents or more hold."""
        enough = F.col("n_docs") >= least_docs
        if not self.increments:
            return self.known().where(enough)
        # Lines without an increment are decided by their run; only the others are counted together.
        again = stage(counted(self._together(self.increments)), "line-increments")
        known = self.known()
        alone = known.where(enough).join(again.select(KEY), KEY, "left_anti")
        both = counted(known.join(again.select(KEY), KEY, "left_semi").unionByName(again)).where(enough)
        return alone.unionByName(both)

    def write(self, folder: str) -> None:
        """Every run and increment, by level (-1: increments), into one folder."""
        parts = [(level, run) for level, runs in self.levels.items() for run in runs] + [(-1, i) for i in self.increments]
        marked = [part.withColumn("level", F.lit(level)).withColumn("run", F.lit(k)) for k, (level, part) in enumerate(parts)]
        if marked:
            self._together(marked).write.partitionBy("level", "run").parquet(folder)

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Runs:
        """What `write` has written."""
        own = cls(spark)
        table = spark.read.schema(COUNTS + ", level int, run int").parquet(folder)
        for level, run in sorted(tuple(r) for r in table.select("level", "run").distinct().collect()):
            part = table.where((F.col("level") == level) & (F.col("run") == run)).drop("level", "run")
            own.increments.append(part) if level < 0 else own.levels.setdefault(level, []).append(part)
        return own


def batch_of(did: str, batches: int):
    return F.pmod(F.xxhash64(did), F.lit(batches)).cast("int")


def staged_lines(docs: DataFrame, least_length: int, batches: int) -> DataFrame:
    """The rows of `line_hashes`, written by batch, so that a batch reads its own files alone."""
    lines = line_hashes(docs, least_length).withColumn("batch", batch_of("did", batches))
    return stage(lines, "lines", by="batch")


def runs_of(spark: SparkSession, lines: DataFrame, batches: int) -> Runs:
    runs = Runs(spark)
    for batch in range(batches):
        runs.add(lines.where(F.col("batch") == batch))
    return runs


def cut(docs: DataFrame, least_length: int, least_docs: int, batches: int) -> DataFrame:
    """The rows of `numbered` with the number of lines, the places of the lines that go, and the text that is left."""
    since = mark()
    lines = staged_lines(docs, least_length, batches)
    shared = runs_of(docs.sparkSession, lines, batches).shared(least_docs).select(*KEY, "last_did")
    # A sorted set: rows that repeat a document and its text would otherwise list a place twice.
    dropped = (
        lines.join(shared, KEY)
        .where(F.col("did") != F.col("last_did"))
        .groupBy("did", "th")
        .agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    )
    dropped = stage(dropped, "dropped-lines")
    tidy(docs.sparkSession, since)
    # Sorted and merged at every size: whether the places are few enough to send around depends on the lines, not on a bound.
    rows = numbered(docs).join(dropped.hint("merge"), ["did", "th"], "left").withColumn("all_lines", F.split("text", "\n", -1))
    edges = F.concat(F.array(F.lit(-1)), F.col("gone"), F.array(F.size("all_lines")))
    # The lines between two that go, stretch by stretch, so that the work is linear in the lines.
    between = F.transform(
        F.sequence(F.lit(0), F.size("edges") - 2),
        lambda i: F.slice("all_lines", F.get("edges", i) + 2, F.get("edges", i + 1) - F.get("edges", i) - 1),
    )
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(between), "\n"))
    return rows.withColumn("edges", F.when(F.col("gone").isNotNull(), edges)).withColumn("kept", kept)


def dedup_lines(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_docs: int = LEAST_DOCS, batches: int = BATCHES
) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept (the text that is left) of every row.

    A key held by `least_docs` or more documents stays only in the document with the largest id.
    """
    return cut(docs.select("doc_id", "text"), least_length, least_docs, batches).select(
        "doc_id",
        F.size("all_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        "kept",
    )


def without_shared_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """All rows and columns of docs, with `text` cut to the lines that stay; n_chars follows where docs has it."""
    rows = cut(docs, LEAST_LENGTH, LEAST_DOCS, batches)
    new = {"text": F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.col("kept"))}
    if "n_chars" in docs.columns:
        length = F.length("kept").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("gone").isNull(), F.col("row.n_chars")).otherwise(length)
    return rows.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])

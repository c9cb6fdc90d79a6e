"""Documents with equal texts, found by progressive refinement. DataFrame operations only.

Texts are equal when they are identical after A-Z have been lower-cased. Rows are grouped by the length of the text, those
whose length is shared by the hash of its first characters, and those whose length and prefix are shared by the SHA-256 of
the whole text. One scan takes lengths and prefix hashes; one more reads whole texts, and only rows that the first two steps
left over are hashed in full. Texts are never shuffled: groups of a step are handed on as a bitmap of a fixed number of
cells. A cell hit by chance lets a row through to the next step and changes no result.

Defined cases: null counts as the empty text, and all empty texts are one group; a null doc_id counts as smaller than every
id; of rows that repeat the largest id of a group and its text, exactly one stays; an empty table gives no rows; other
columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import UPPER, bounded, mark, stage, tidy

PREFIX = 128
# Cells of a bitmap: 2^20 words of 64 bits are what a task gets at most.
CELLS = 2**26
DIGEST = ["h1", "h2"]


def lowered(text: Column) -> Column:
    """A-Z lower-cased and nothing else. For texts of ASCII alone that is what `lower` does, at a tenth of the cost."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def shared(rows: DataFrame, *key: str) -> DataFrame:
    """A bitmap of the keys that two rows or more have: word, bits."""
    twice = rows.groupBy(*key).count().where(F.col("count") > 1)
    cells = twice.select(F.pmod(F.xxhash64(*key), F.lit(CELLS)).alias("cell"))
    bit = F.expr("shiftleft(1L, cast(cell & 63 as int))")
    return cells.groupBy(F.expr("cell >> 6").alias("word")).agg(F.bit_or(bit).alias("bits"))


def probed(rows: DataFrame, bitmap: DataFrame, *key: str) -> DataFrame:
    """The rows with `hit`: whether the cell of their key is set."""
    cell = F.pmod(F.xxhash64(*key), F.lit(CELLS))
    at = rows.withColumn("cell", cell).withColumn("word", F.expr("cell >> 6"))
    found = at.join(F.broadcast(bitmap), "word", "left")
    hit = F.coalesce(F.getbit("bits", F.expr("cast(cell & 63 as int)")) == 1, F.lit(False))
    return found.withColumn("hit", hit).drop("cell", "word", "bits")


def signed_rows(docs: DataFrame, *extra: Column) -> DataFrame:
    """doc_id, text, length in bytes and the hash of the lower-cased prefix of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *extra)
    prefix = F.xxhash64(lowered(F.substring("text", 1, PREFIX)))
    return own.withColumn("length", F.octet_length("text")).withColumn("prefix", prefix)


def refined(docs: DataFrame, *extra: Column) -> DataFrame:
    """The rows of `signed_rows` with `hit`: whether another row may share length and prefix."""
    signatures = stage(signed_rows(docs).select("length", "prefix"), "copies-signatures")
    of_shared_length = probed(signatures, shared(signatures, "length"), "length").where("hit")
    return probed(signed_rows(docs, *extra), shared(of_shared_length, "length", "prefix"), "length", "prefix")


def with_digest(rows: DataFrame, every: bool) -> DataFrame:
    """Adds the SHA-256 of the lower-cased text to rows that are hit (`every`: to all rows), and a key made from it."""
    digest = F.sha2(lowered(F.col("text")).cast("binary"), 256)
    digest = digest if every else F.when(F.col("hit"), digest)
    keyed = rows.withColumn("text_sha256", digest)
    return keyed.withColumn("h1", F.xxhash64("text_sha256")).withColumn("h2", F.xxhash64(F.lit("second"), "text_sha256"))


def mark_copies(docs: DataFrame, every_digest: bool = False) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row; of equal texts the one with the largest id is kept.

    text_sha256 is null for texts that were told apart before they were read in full, unless `every_digest` asks for all.
    """
    since = mark()
    rows = with_digest(refined(docs), every_digest).withColumn("row", F.monotonically_increasing_id())
    # Written once, so that numbers of rows and digests stay what they are.
    rows = stage(rows.select("doc_id", "row", "hit", "text_sha256", *DIGEST), "copies-digests")
    top = F.max(F.struct("doc_id", "row")).alias("top")
    groups = rows.where("hit").groupBy(*DIGEST).agg(top, F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    groups = bounded(groups, "copies-groups")
    tidy(docs.sparkSession, since, keep=2)

    def verdict(frame: DataFrame, keep: Column, size: Column, kept: Column) -> DataFrame:
        return frame.select("doc_id", keep.alias("keep_id"), size.alias("group_size"), kept.alias("kept"), "text_sha256")

    alone = F.col("size").isNull()
    found = rows.where("hit").join(groups, DIGEST, "left")
    found = verdict(
        found,
        F.when(alone, F.col("doc_id")).otherwise(F.col("top.doc_id")),
        F.coalesce("size", F.lit(1).cast("long")),
        alone | (F.col("row") == F.col("top.row")),
    )
    return verdict(rows.where(~F.col("hit")), F.col("doc_id"), F.lit(1).cast("long"), F.lit(True)).union(found)


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows and columns of docs without copies: of equal texts the row with the largest doc_id stays."""
    rows = with_digest(refined(docs, F.struct("*").alias("whole")), every=False)
    alone = rows.where(~F.col("hit")).select("whole")
    first = rows.where("hit").groupBy(*DIGEST).agg(F.max_by("whole", F.struct("doc_id")).alias("whole"))
    every = alone.union(first.select("whole"))
    return every.select(*[F.col("whole").getField(c).alias(c) for c in docs.columns])

"""The registered queries of this subpackage, each next to its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (
    decontaminate,
    exactdedup,
    extract,
    hmm,
    jaccard,
    langid,
    linededup,
    pieces,
    quality,
    repeats,
    toxicity,
    vectorcodes,
    whitening,
)
from plumbline.llm.common import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


LINE_DEDUP = r"""
WITH lines AS (
  SELECT coalesce(doc_id, -9223372036854775808) AS did, doc_id, i, list[i] AS line,
         translate(trim(list[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, list, unnest(range(1, len(list) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS list FROM documents))
), shared AS (
  SELECT key, max(did) AS last FROM lines WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT did) >= 3
), marked AS (
  SELECT l.*, s.key IS NOT NULL AND l.did <> s.last AS gone FROM lines l LEFT JOIN shared s ON l.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query(LINE_DEDUP)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


@query()
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select("doc_id", *base, "base_failed", "kept")


_WORDS = r"list_filter(string_split_regex({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD_JOIN = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), k AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM k JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)
), reach AS (
  SELECT DISTINCT x AS node, x AS root FROM links
  UNION
  SELECT links.y, reach.root FROM reach JOIN links ON links.x = reach.node
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(root, doc_id) AS component_id
FROM documents LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT node AS doc_id, min(root) AS root FROM reach GROUP BY node) USING (doc_id)
"""


@query(JACCARD_JOIN)
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query()
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encode_samples(table(spark, sf_dir, "documents"), keep_ids=False)
    return found.drop("ids")


@query()
def op6_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_texts(table(spark, sf_dir, "documents"))


@query()
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


SUBSTRING_DEDUP = f"""
WITH w AS (
  SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)
), firsts AS (
  SELECT h, min(doc_id) AS least FROM windows GROUP BY h
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN firsts USING (h) WHERE least < doc_id
), words AS (
  SELECT doc_id, p, ws[p] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM w)
), kept AS (
  SELECT doc_id, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY words.p) FILTER (gone.p IS NULL) AS kept
  FROM words LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


@query(SUBSTRING_DEDUP)
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, sf_dir, "documents"))
    kept = F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256")
    return found.select("doc_id", "n_words", "n_removed", kept)


EXACT_DEDUP = f"""
WITH t AS (
  SELECT doc_id, {_LOWER} AS norm FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM t
"""


@query(EXACT_DEDUP)
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.mark_copies(table(spark, sf_dir, "documents"), every_digest=True)


@query()
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


_ROUND = """
, a{r} AS MATERIALIZED (
  SELECT r, p, sub, arg_min(k, struct_pack(d := d, k := k)) AS k, min(d) AS d
  FROM (SELECT s.r, s.p, s.sub, c.k,
               CAST(list_sum(list_transform(range(1, len(s.sub) + 1), lambda i: (s.sub[i] - c.e[i]) * (s.sub[i] - c.e[i]))) AS BIGINT) AS d
        FROM s JOIN c{r} c ON s.p = c.p)
  GROUP BY r, p, sub
), m{r} AS MATERIALIZED (
  SELECT p, k, list(CAST((t - ((t % n) + n) % n) // n AS BIGINT) ORDER BY i) AS e
  FROM (SELECT p, k, i, sum(sub[i]) AS t, count(*) AS n FROM a{r}, range(1, {width} + 1) AS x(i) GROUP BY p, k, i)
  GROUP BY p, k
), c{next} AS MATERIALIZED (
  SELECT c.p, c.k, coalesce(m.e, c.e) AS e FROM c{r} c LEFT JOIN m{r} m ON c.p = m.p AND c.k = m.k
)"""

# For vectors of 64 components, as the table has them.
VECTOR_CODES = (
    """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS MATERIALIZED (
  SELECT r, p, v[8 * p + 1:8 * p + 8] AS sub FROM v, range(0, 8) AS x(p)
), c0 AS MATERIALIZED (
  SELECT p, r - 1 AS k, sub AS e FROM s WHERE r <= 16
)"""
    + "".join(_ROUND.format(r=r, next=r + 1, width=8) for r in range(7))
    + """
, coded AS (
  SELECT r, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a6 GROUP BY r
), book AS (
  SELECT sha256(string_agg(CAST(e[i] AS VARCHAR), ',' ORDER BY p, k, i)) AS h FROM c6, range(1, 9) AS x(i)
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, book.h AS codebooks_sha256
FROM v JOIN coded USING (r), book
"""
)


@query(VECTOR_CODES)
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.compress(table(spark, sf_dir, "embeddings")).drop("label")

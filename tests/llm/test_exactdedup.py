"""Progressive refinement against a plain grouping of whole texts."""

import hashlib
import random
import threading
from collections import defaultdict

import pytest

from plumbline.llm import exactdedup

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "text string, doc_id long, length int, `row` string, hit double, whole int, top array<int>"
rng = random.Random(3)


def table():
    long = " ".join(rng.choice(["one", "two", "Three", "äpfel"]) for _ in range(5000))
    texts = [
        None, "", "", None, " ", "a", "A", "b", "Ä", "ä", "É", "é", "ß", "SS", "\x00", "\n", "İ", "i̇", "K", "k", "K",
        long, long.upper().replace("Ä", "ä"), long + "x", "y" + long[1:], long[:-1] + "Z", long[:-1] + "z",
        "x" * 200, "x" * 199 + "y", "x" * 200, "X" * 128 + "q" * 72,
    ]
    texts += ["a hot text that very many rows repeat"] * 300 + ["A HOT text that very many rows repeat"] * 50
    rows = [(t, i) for i, t in enumerate(texts)]
    rows += [("a", 5), ("a", None), ("only nulls", None), ("ONLY nulls", None), ("top twice", 9000), ("Top twice", 9000), ("top twice", 8999)]
    rng.shuffle(rows)
    return [(t, i, 1, "r", 0.5, 7, [1]) for t, i in rows]


ROWS = table()


def brute(rows):
    groups = defaultdict(list)
    for text, doc_id, *_ in rows:
        groups[(text or "").translate(UPPER)].append(doc_id)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i), reverse=True)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), k == 0, digest) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("parts", [1, 7])
def test_marks_are_those_of_a_plain_grouping(spark, parts):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(parts)
    assert found(exactdedup.mark_copies(docs, every_digest=True)) == brute(ROWS)


def test_cells_hit_by_chance_and_large_groups_change_nothing(spark, monkeypatch):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    monkeypatch.setattr(exactdedup, "CELLS", 64)
    monkeypatch.setattr("plumbline.llm.common.BROADCAST_ROWS", 0)
    assert found(exactdedup.mark_copies(docs, every_digest=True)) == brute(ROWS)


def test_only_texts_of_shared_length_and_prefix_are_read_in_full(spark):
    rows = [("same length 1", 1), ("some length 2", 2), ("p" * 128 + "tail", 3), ("P" * 128 + "tails", 4), ("p" * 128 + "taiL", 5), ("p" * 128 + "fail", 6)]
    got = {r.doc_id: r for r in exactdedup.mark_copies(spark.createDataFrame(rows, "text string, doc_id int")).collect()}
    assert {i for i, r in got.items() if r.text_sha256} == {3, 5, 6}
    assert (got[3].keep_id, got[5].keep_id, got[6].keep_id, got[3].group_size, got[6].group_size) == (5, 5, 6, 2, 1)


def test_rows_that_stay_keep_their_columns(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = exactdedup.without_copies(docs)
    assert got.schema.simpleString() == docs.schema.simpleString()
    stay = sorted((str(i), (t or "").translate(UPPER)) for t, i, *_ in (tuple(r) for r in got.collect()))
    digests = {hashlib.sha256((t or "").translate(UPPER).encode()).hexdigest(): (t or "").translate(UPPER) for t, *_ in ROWS}
    assert stay == sorted((str(i), digests[d]) for i, _, _, kept, d in brute(ROWS) if kept)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exactdedup.mark_copies(docs).count() == 0 and exactdedup.without_copies(docs).count() == 0


def test_native_plan_without_shuffled_texts(spark):
    plan = exactdedup.mark_copies(spark.createDataFrame(ROWS, SCHEMA), every_digest=True)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "text#" not in plan


def test_queries_at_once_keep_their_copies(spark):
    docs, out = spark.createDataFrame(ROWS, SCHEMA), {}

    def run(k):
        out[k] = found(exactdedup.mark_copies(docs, every_digest=True))

    threads = [threading.Thread(target=run, args=(k,)) for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert out[0] == out[1] == brute(ROWS)

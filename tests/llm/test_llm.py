"""The operators of plumbline.llm against plain computations on small tables with awkward rows."""

import binascii
import hashlib
import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import (
    components,
    decontaminate,
    extract,
    hmm,
    jaccard,
    langid,
    linededup,
    pieces,
    quality,
    queries,
    repeats,
    toxicity,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, did long, hash long, words string"
rng = random.Random(5)


def prose(n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


ENGLISH = ["the", "of", "and", "house", "water", "walking", "thing", "with", "which", "there", "other", "should"] + [f"word{i}ing" for i in range(60)]
GERMAN = ["der", "die", "und", "nicht", "über", "straße", "schön", "gehen", "haus", "wasser", "auch"] + [f"wört{i}ung" for i in range(60)]
PASSAGE = prose(70, ENGLISH)
ITEM = "Which river crosses the old town and turns north behind the mill? The answer is the quiet Alder."


def documents():
    base = prose(120, ENGLISH)
    words = base.split()
    rows = []
    for i in range(40):
        rows.append((100 + i, prose(rng.randint(5, 90), ENGLISH if i % 2 else GERMAN), "en" if i % 2 else "de"))
    rows += [(200 + i, base, "en") for i in range(4)]
    for i in range(6):
        changed = list(words)
        changed[i * 15] = f"changed{i}"
        rows.append((210 + i, " ".join(changed), "en"))
    rows += [(230 + i, prose(20 + i, ENGLISH) + "\n" + PASSAGE + "\n" + prose(30, ENGLISH), "en") for i in range(5)]
    rows += [(250, prose(80, ENGLISH) + " " + ITEM + " " + prose(50, ENGLISH), "en"), (251, ITEM.upper().replace(" ", "\n"), "en")]
    rows += [
        (300, None, None),
        (301, "", "en"),
        (302, " \t\r\n\x0b\x0c ", "en"),
        (303, "one", "en"),
        (304, "One two THREE four", "en"),
        (305, "one two three four", "en"),
        (306, "12345 67890 !!! ###", "de"),
        (307, "\n\n\n", None),
        (308, prose(9000, ENGLISH), "en"),
        (309, "x" * 30000, "en"),
        (310, "日本語 ▁   ÀÉ é \U0001f600 \x00 tail", "xx"),
        (None, base, None),
        (None, None, "en"),
        (311, "repeat me please " * 40, "en"),
        (311, "repeat me please " * 40, "en"),
        (312, "same id other text one two three", "en"),
        (312, "same id and another text four five six", "de"),
    ]
    return [(i, t, lang, f"src{(i or 0) % 3}", len(t) if t else None, 0.5, 7, 8, "w") for i, t, lang in rows]


ROWS = documents()
IDS = [r[0] for r in ROWS]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text, lower=True):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def by_row(frame, *columns):
    """Rows as sorted tuples; null ids first."""
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=lambda t: tuple((x is not None, x) for x in t))


def fold(i, n):
    return binascii.crc32(b"" if i is None else str(i).encode()) % n


# ---- shared parts


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(100, k) for k in range(101, 160)] + [(5, 5), (200, 201), (201, 200), (200, 201)]
    got = dict(tuple(r) for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 10 for i in range(10, 41)}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 1: Jaccard join


def brute_components(rows, percent=75):
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    low = {}
    key = [-(2**63) if i is None else i for i, _ in rows]
    for k in range(len(rows)):
        low[root(k)] = min(low.get(root(k), 2**63), key[k])
    out = [(i, len(s), low[root(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))]
    return sorted(((i, n, None if c == -(2**63) else c) for i, n, c in out), key=lambda t: tuple((x is not None, x) for x in t))


def test_jaccard_join_is_exact(docs, empty):
    got = by_row(jaccard.similar_documents(docs), "doc_id", "n_shingles", "component_id")
    assert got == brute_components([(r[0], r[1]) for r in ROWS])
    assert jaccard.similar_documents(empty).count() == 0


def test_jaccard_join_of_families_at_the_threshold(spark):
    """Copies around one original that link with it only, and chains, at and just below the threshold."""
    rows = [(0, " ".join(f"b{i}" for i in range(60)))]
    for k in range(1, 25):
        w = rows[0][1].split()
        w[rng.randrange(60)] = f"x{k}"
        if k % 3 == 0:
            w[rng.randrange(60)] = f"y{k}"
        rows.append((k, " ".join(w)))
    w = [f"c{i}" for i in range(40)]
    for k in range(25, 45):
        rows.append((k, " ".join(w)))
        w = [*w[2:], f"c{k}a", f"c{k}b"]
    rows += [(50, "a b c d e f g h i j k"), (51, "a b c d e f g h i j"), (52, "a b c d e f g h"), (53, "z a b c d e f g h")]
    got = by_row(jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), group=4), "doc_id", "n_shingles", "component_id")
    assert got == brute_components(rows)


def test_matrix_finds_links_that_the_hubs_miss(spark, monkeypatch):
    """Without step 2 all links come from the matrix."""
    monkeypatch.setattr(jaccard, "seed_pairs", lambda classes, percent: classes.select(F.col("cid").alias("a"), F.col("cid").alias("b")).limit(0))
    rows = [(i, t) for i, t, *_ in ROWS if i is not None and i < 260]
    got = by_row(jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_shingles", "component_id")
    assert got == brute_components(rows)


def test_one_of_each_group_keeps_columns(docs, empty):
    kept = jaccard.one_of_each_group(docs)
    assert kept.columns == docs.columns
    component = {(i, n): c for i, n, c in brute_components([(r[0], r[1]) for r in ROWS])}
    assert {r.doc_id for r in kept.collect()} == {i for (i, _), c in component.items() if i == c}
    assert jaccard.one_of_each_group(empty).count() == 0


# ---- 2: pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load()


def test_samples_follow_the_distribution_without_replacement(vocabulary):
    n, text = 6000, "the cat"
    sampler = pieces.Sampler(vocabulary, [text] * n, pieces.row_keys(list(range(n)), [1] * n, 3), 2)
    logs, drawn = {}, defaultdict(list)
    for i, _, ids, log, value, score in sampler.run():
        assert vocabulary.decode(ids.tolist()) == text and 0 < score <= 1
        logs[tuple(ids)] = log
        drawn[i].append((value, tuple(ids)))
    p = {k: math.exp(v) for k, v in logs.items()}
    for both in drawn.values():
        assert len({k for _, k in both}) == 2 and both[0][0] > both[1][0]
    for place in (0, 1):
        counts = Counter(both[place][1] for both in drawn.values())
        for b in sorted(p, key=p.get)[-3:]:
            want = p[b] if place == 0 else sum(p[a] * p[b] / (1 - p[a]) for a in p if a != b)
            assert abs(counts[b] / n - want) < 4 * math.sqrt(want / n) + 1e-3


def test_lattice_sums_match_all_segmentations(vocabulary):
    text = b"\xfeabana"
    lattice = pieces.Lattice(vocabulary, [text])

    def total(at):
        if at == len(text):
            return 1.0
        out = 0.0
        for i, piece in enumerate(vocabulary.bytes):
            if piece and i not in set(vocabulary.byte_id.tolist()) and text.startswith(piece, at):
                out += math.exp(vocabulary.log_weight[i]) * total(at + len(piece))
        return out

    whole = total(0)
    first = [e for e in range(len(lattice.edge_from)) if lattice.edge_from[e] == 0]
    for e in first:
        want = math.exp(vocabulary.log_weight[lattice.edge_id[e]]) * total(int(lattice.edge_to[e])) / whole
        assert abs(math.exp(lattice.edge_log[e]) - want) < 1e-9


def test_encoding_is_exact_and_keyed_by_row(docs, empty):
    rows = pieces.encode_samples(docs, samples=3).cache()
    found = rows.collect()
    assert all(r.round_trip for r in found)
    per = Counter(r.doc_id for r in found)
    assert set(per) == set(IDS) and per[100] == 3 and 0 < per[301] <= 3
    assert len({r.ids_sha256 for r in found if r.doc_id == 100}) == 3
    assert len({r.ids_sha256 for r in found if r.doc_id == 311}) == 3  # two equal rows, the same samples
    back = {(r.doc_id, r.text) for r in pieces.decode(rows).collect()}
    assert back == {(r[0], r[1] or "") for r in ROWS}
    again = pieces.encode_samples(docs.repartition(1), samples=3, keep_ids=False)
    keys = ("doc_id", "sample", "n_pieces", "ids_sha256")
    assert by_row(rows, *keys) == by_row(again, *keys)
    assert pieces.encode_samples(empty).count() == 0


# ---- 3: lines


def brute_lines(rows):
    strip = " \t\n\x0b\x0c\r"
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(strip).translate(upper)
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                held[key(line)].add(-(2**63) if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        own = -(2**63) if i is None else i
        kept = [x for x in lines if not (len(held.get(key(x), ())) >= 3 and max(held[key(x)]) != own)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))


LINES = [
    (1, "Shared line that is long enough\nown line one\nshort"),
    (2, "  shared LINE that is long enough\t\nshort\n"),
    (3, "shared line that is long enough\x0b\nshared line that is long enough\nÄ line of exactly 20c"),
    (4, "only twice, but long enough\nshort"),
    (5, "only twice, but long enough\n\n"),
    (6, None),
    (7, ""),
    (None, "shared line that is long enough"),
    (8, "ä line of exactly 20c\n" * 3),
    (8, "ä line of exactly 20c\n" * 3),
    (9, "ä line of exactly 20c"),
    (10, "ä line of exactly 20c\nÄ LINE of exactly 20c"),
    (11, "\n".join(f"a long run of lines, number {k % 50}" for k in range(3000))),
    (12, "\n".join(f"a long run of lines, number {k % 50}" for k in range(60))),
    (13, "a long run of lines, number 7"),
]


@pytest.mark.parametrize("batches", [1, 3])
def test_line_dedup(spark, batches):
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in LINES], "doc_id long, text string, pos int, h1 long")
    got = by_row(linededup.dedup_lines(frame, batches=batches), "doc_id", "n_lines", "n_dropped", "kept")
    assert got == brute_lines(LINES)


def test_batches_added_to_stored_runs(spark, tmp_path):
    """A batch that comes later meets the runs that were written, and the verdicts are those of all lines at once."""
    frame = spark.createDataFrame(LINES, "doc_id long, text string")
    lines = linededup.line_hashes(frame, 20)
    parts = [lines.where(F.pmod(F.xxhash64("did"), F.lit(5)) == k) for k in range(5)]
    once = linededup.Runs(spark)
    once.add(lines)
    want = sorted(tuple(r) for r in once.shared(3).collect())
    assert want and not once.increments
    for k, part in enumerate(parts):
        runs = linededup.Runs.load(spark, str(tmp_path / str(k - 1))) if k else linededup.Runs(spark)
        runs.add(part)
        runs.write(str(tmp_path / str(k)))
    loaded = linededup.Runs.load(spark, str(tmp_path / "4"))
    assert sorted(tuple(r) for r in loaded.shared(3).collect()) == want
    held = loaded.known().groupBy("h1", "h2").count().where("count > 1")
    assert held.count() == 0 and loaded.known().count() == once.known().count()
    assert max(len(r) for r in loaded.levels.values()) < linededup.FAN_IN and loaded.increments


def test_line_dedup_stage(docs, empty, spark):
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in LINES], "doc_id long, text string, lang string, source string, n_chars long")
    out = linededup.without_shared_lines(frame)
    assert out.columns == frame.columns
    want = {(i, t) for (i, _, n, k), t in ((x, x[3]) for x in brute_lines(LINES)) if n}
    assert want <= {(r.doc_id, r.text) for r in out.collect()} and out.count() == len(LINES)
    assert linededup.dedup_lines(empty).count() == 0
    plan = linededup.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


# ---- 4: decontamination

ITEMS = [(1, ITEM), (2, "An item that no document holds, about seven green lanterns. Lanterns."), (3, None), (4, ""), (5, "?!"), (6, "one two three four"), (6, "one two three four")]


def test_decontamination_finds_items_only_where_they_are(spark, docs, empty):
    items = spark.createDataFrame([(*x, "extra") for x in ITEMS], "item_id long, text string, doc_id string")
    found = decontaminate.matches(docs, items)
    assert by_row(found, "doc_id", "item_id") == [(250, 1), (251, 1), (304, 6), (305, 6), (312, 6)]  # half of the triples are enough
    kept = decontaminate.without_benchmark(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 6  # 312 is there twice
    assert decontaminate.matches(empty, items).count() == 0
    assert decontaminate.matches(docs, items.limit(0)).count() == 0


def test_decontamination_needs_no_answer(spark):
    """Near copies of an item whose last sentence is short, changed or left out."""
    question = prose(30, ENGLISH)
    items = spark.createDataFrame([(1, f"{question}. Quite short it ends.")], "item_id long, text string")
    texts = [f"{question}. Quite short it ends.", f"{question}. Quite changed it ends.", question, " ".join(question.split()[:12]), prose(40, ENGLISH)]
    frame = spark.createDataFrame([(i, f"Before it. {t} After it.") for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r for r in decontaminate.matches(frame, items).collect()}
    assert sorted(found) == [0, 1, 2]
    assert found[0].overlap == found[0].question_overlap == found[0].answer_overlap == 1
    assert found[2].overlap > 0.8 and found[2].question_overlap == 1 and found[2].answer_overlap == 0
    assert [r.doc_id for r in decontaminate.without_benchmark(frame, items).orderBy("doc_id").collect()] == [3, 4]


def test_decontamination_does_not_depend_on_shards(spark, docs, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = by_row(decontaminate.matches(docs, items), "doc_id", "item_id", "score")
    monkeypatch.setattr(decontaminate, "SHARD_ITEMS", 2)
    split = by_row(decontaminate.matches(docs, items), "doc_id", "item_id", "score")
    assert [x[:2] for x in whole] == [x[:2] for x in split]
    assert np.allclose([x[2] for x in whole], [x[2] for x in split])


def test_blocks_retrieve_what_scoring_all_items_does():
    items = [(i, prose(rng.randint(8, 60), ENGLISH)) for i in range(40)]
    df = Counter(w for _, t in items for w in set(decontaminate.words_of(t)))
    index = decontaminate.Index(items, df, len(items), 30.0, 0.3)
    passages = [sorted({index.terms[w] for w in decontaminate.words_of(prose(40, ENGLISH)) if w in index.terms}) for _ in range(200)]
    at = np.repeat(np.arange(len(passages)), [len(p) for p in passages])
    cell, item, score = index.retrieved(at, np.concatenate([np.array(p, np.int64) for p in passages]), len(passages))
    got = {(c, i): s for c, i, s in zip(cell.tolist(), item.tolist(), score.tolist(), strict=True)}
    want = {}
    for c, terms in enumerate(passages):
        scores = defaultdict(float)
        for t in terms:
            _, places, weights = index.items.of(np.array([t]))
            for i, w in zip(places.tolist(), weights.tolist(), strict=True):
                scores[i] += w
        want.update({(c, i): s for i, s in scores.items() if s >= index.thresholds[i]})
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got) and got


# ---- 5: toxicity


def test_segments_are_the_maximal_ones():
    """Against the definition: cut at the best segment, then left and right of it."""

    def best(values, low, high):
        top, out = 0.0, None
        for a in range(low, high):
            total = 0.0
            for b in range(a, high):
                total += values[b]
                if total > top + 1e-12:
                    top, out = total, (a, b + 1)
        return out

    def all_of(values, low, high):
        found = best(values, low, high)
        return [] if found is None else [*all_of(values, low, found[0]), found, *all_of(values, found[1], high)]

    for _ in range(200):
        tokens = [rng.choice("abcdexyz") for _ in range(rng.randint(0, 30))]
        table = {"a": 2.0173, "b": 1.2591, "c": -1.5317, "d": 0.3133}  # no two sums are equal
        weights = toxicity.Weights({k: (v, 9.0) for k, v in table.items()})
        values = [table.get(t, -0.5537) for t in tokens]
        got = toxicity.segments(tokens, weights, -0.5537)
        assert [(a, b) for _, a, b in got] == all_of(values, 0, len(values))
        assert all(abs(s - sum(values[a:b])) < 1e-9 for s, a, b in got)


def toxic_table():
    rows, marks = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = prose(60, ENGLISH).split()
        if bad:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["vermin", "filthy", "scoundrel"]))
        rows.append((i, " ".join(text)))
        marks.append((i, int(bad)))
    return rows, marks


def test_toxicity_learns_from_its_part_only(spark):
    rows, marks = toxic_table()
    frame = spark.createDataFrame([*rows, (900, None), (901, ""), (None, "vermin"), (902, "vermin filthy scoundrel " * 2000)], "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (None, 1), (5, None), (9999, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(frame, labels).collect()}
    truth = dict(marks)
    held = [i for i in truth if fold(i, 5) == 0]
    assert sum((got[i].score >= 0.5) == bool(truth[i]) for i in held) >= 0.97 * len(held)
    assert got[900].score < 0.5 and got[901].score < 0.5 and got[902].score > 0.5 and not got[900].passages
    assert all(0 <= r.score <= 1 for r in got.values())
    toxic = next(i for i in held if truth[i])
    tokens = toxicity.tokens_of(dict(rows)[toxic])
    assert any(tokens[k] in ("vermin", "filthy", "scoundrel") for p in got[toxic].passages for k in range(p.first, p.last))
    # Labels of held-out documents teach nothing.
    other = labels.withColumn("toxic", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.score_toxicity(frame, other).collect()}
    assert all(abs(again[i] - got[i].score) < 1e-12 for i in again)


def test_toxicity_without_labels_and_with_one_kind(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_toxicity(docs, none).collect()} == {0.0}
    ones = spark.createDataFrame([(i, 1) for i in IDS if i is not None], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_toxicity(docs, ones).collect()} == {1.0}
    assert toxicity.score_toxicity(empty, none).count() == 0


def test_words_of_toxic_documents_alone_are_significant(spark):
    """From a handful of documents on, in small tables and in large ones."""
    for t, o in ((20_000, 150_000), (20_000_000, 150_000_000)):
        rows = [("insult", 6, 0), ("slur", 18, 0), ("once", 1, 0), ("even", t // 1000, o // 1000), ("harmless", 0, 200), ("rest", 0, 0)]
        rows[-1] = ("rest", t - sum(r[1] for r in rows), o - sum(r[2] for r in rows))
        found = {r.token: r for r in toxicity.significant(spark.createDataFrame(rows, "token string, n_toxic long, n_other long")).collect()}
        assert {"insult", "slur", "harmless"} <= set(found) and not {"once", "even"} & set(found)
        assert found["slur"].odds > found["insult"].odds > 0 > found["harmless"].odds


def test_features_beyond_the_lexicon_are_joined(spark, monkeypatch):
    rows, marks = toxic_table()
    frame = spark.createDataFrame([*rows, (None, "vermin"), (700, "another filthy text"), (700, "a text of no harm")], "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    whole = sorted((r.doc_id or -1, r.score, str(r.passages)) for r in toxicity.score_toxicity(frame, labels).collect())
    monkeypatch.setattr(toxicity, "LEXICON", 1)
    split = sorted((r.doc_id or -1, r.score, str(r.passages)) for r in toxicity.score_toxicity(frame, labels).collect())
    assert [x[0] for x in whole] == [x[0] for x in split]
    assert np.allclose([x[1] for x in whole], [x[1] for x in split], atol=0.02)


# ---- 6: hidden Markov model


def test_forward_sums_over_all_paths():
    generator = np.random.default_rng(1)
    k, v = 3, 5
    part = lambda *shape: (lambda x: x / x.sum(axis=-1, keepdims=True))(generator.random(shape))
    model = hmm.Model([], np.zeros(0), 0, 0, np.zeros(0), part(k), part(k, k), part(k, v).T)
    parts = [np.array([0, 3, 1, 4]), np.array([2]), np.array([1, 1, 0, 2, 3, 4])]
    totals = np.zeros(k), np.zeros((k, k)), np.zeros((v, k))
    for take, flat, first, sizes in hmm.sequences(parts):
        got = hmm.forward(model, flat, first, sizes)[0]
        hmm.expected(model, flat, first, sizes, totals)
    import itertools

    want, counted = [], np.zeros((v, k))
    for part_ in parts:
        probabilities = {}
        for path in itertools.product(range(k), repeat=len(part_)):
            p = model.start[path[0]] * model.emit[part_[0], path[0]]
            for a, b, s in zip(path, path[1:], part_[1:], strict=False):
                p *= model.move[a, b] * model.emit[s, b]
            probabilities[path] = p
        whole = sum(probabilities.values())
        want.append(math.log10(whole))
        for path, p in probabilities.items():
            for s, z in zip(part_, path, strict=True):
                counted[s, z] += p / whole
    assert np.allclose(got[np.argsort(take)], want)
    assert np.allclose(totals[2], counted) and np.isclose(totals[0].sum(), 3) and np.isclose(totals[1].sum(), 8)


def test_rounds_raise_the_likelihood():
    generator = np.random.default_rng(2)
    parts = [generator.integers(0, 4, 30) + 4 * (i % 2) for i in range(40)]
    k, v = 2, 8
    emit = generator.random((v, k)) + 0.5
    model = hmm.Model([], np.zeros(0), 0, 0, np.zeros(0), np.full(k, 0.5), np.array([[0.9, 0.1], [0.1, 0.9]]), emit / emit.sum(axis=0))
    seen = []
    for _ in range(60):
        totals = np.zeros(k), np.zeros((k, k)), np.zeros((v, k))
        seen.append(sum(hmm.expected(model, f, b, s, totals) for _, f, b, s in hmm.sequences(parts)))
        model = hmm.reestimated(model, *totals)
    assert seen[-1] > seen[0] + 50


@pytest.mark.parametrize("frequent", [1 << 16, 20])
def test_base_scores(docs, empty, monkeypatch, frequent):
    monkeypatch.setattr(hmm, "FREQUENT", frequent)
    got = by_row(hmm.score_texts(docs, rounds=1), "doc_id", "n_tokens", "n_known", "train_tokens", "held_out", "base_score")
    counts = Counter()
    for i, t, *_ in ROWS:
        if fold(i, 10):
            counts.update([*words(t), b""])
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t, *_ in ROWS:
        tokens = [*words(t), b""]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        want.append((i, len(tokens), sum(counts[w] > 0 for w in tokens), n, fold(i, 10) == 0, base))
    want.sort(key=lambda t: tuple((x is not None, x) for x in t))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want])
    scores = hmm.score_texts(docs, rounds=1).agg(F.max("score"), F.count("score")).first()
    assert scores[0] < 0 and scores[1] == len(ROWS)
    assert hmm.score_texts(empty).count() == 0


# ---- 7: pages

PAGE = (
    '<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var x="</p>";</script></head><body>'
    "<header>Top</header><nav><ul><li><a href='/a'>A</a></li><li>B</li></ul></nav><div class='ad banner'>Buy</div>"
    "<article><h1>Head &eacute;</h1><p><b>First   line<br>goes\n on</b><p>Second &lt;b&gt; &#8364;&nbsp;5</p><form><input value='x'>Mail</form>"
    "<aside>Aside</aside><!-- <p>no</p> --><div class=\"comments-list\"><p>Me too</p></div><section><p>Last one</p></section></article>"
    "<div id='cookieNotice'>Cookies</div><footer>&copy; 2020</footer></body></html>"
)


def test_article_text(spark):
    body = "<html><body><div class='menu'>M</div><p>{0}</p><div>Follow us on every network that you can think of today</div></body>"
    rows = [
        (1, "http://a.example/1", PAGE),
        (2, "http://a.example/2", None),
        (3, "http://a.example/3", ""),
        (4, "http://b.example/4", body.format("Unique text of the first page in this host")),
        (5, "http://b.example/5", body.format("Quite another text stands on the second page here")),
        (6, None, "<p>cut off in the mid<b"),
        (7, "not a url", "just words < and > more &amp; more"),
        (8, "http://c.example/8", "<article><p>" + "long " * 30000 + "</p></article>"),
        (9, "http://a.example/9", PAGE),
        (9, "http://a.example/9", PAGE),
        (None, "http://a.example/9", "<main><p>Main text</p></main><p>Else</p>"),
    ]
    frame = spark.createDataFrame([(*r, "x", 3) for r in rows], "page_id long, url string, html string, text string, shard int")
    got = defaultdict(list)
    for r in extract.extract(frame).collect():
        got[r.page_id].append(r.text)
    main = "Head é First line goes on Second <b> € 5 Last one"
    assert got[1] == [main] and got[9] == [main, main]  # copies of an article stay whole
    assert got[2] == got[3] == [""]
    assert got[4] == ["Unique text of the first page in this host"] and got[5] == ["Quite another text stands on the second page here"]
    assert got[6] == ["cut off in the mid"] and got[7] == ["just words < and > more & more"]
    assert len(got[8][0]) == 5 * 30000 - 1 and got[None] == ["Main text"]
    assert extract.extract(frame.limit(0)).count() == 0


def test_substrings_repeated_across_shards_only(spark):
    """Each shard holds one page, so nothing repeats inside of one."""
    line = "Follow us on every network that you can think of today"
    rows = [(i, "http://a.example/x", f"<p>{prose(12, ENGLISH)}</p><div>{line}</div>") for i in range(12)]
    got = extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), shard=1)
    assert all(line not in r.text and r.text for r in got.collect())


def test_repeated_substrings_decide_on_every_page(spark):
    """Boilerplate inside of articles goes, and unique text outside of them stays."""
    line = "Read all our offers of this week in the shop around the corner"
    inside, outside = ([f"{name}{i} " + prose(30, ENGLISH) + f" end{i}" for i in range(6)] for name in ("inside", "outside"))
    rows = [(i, "http://a.example/x", f"<article><p>{inside[i]}</p><p>{line}</p></article><div>{outside[i]}</div><div>{line}</div>") for i in range(6)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for shard in (256, 1):
        got = {r.page_id: r.text for r in extract.extract(frame, shard=shard).collect()}
        assert all(got[i] == f"{inside[i]} {outside[i]}" for i in range(6))


def test_runs_around_boilerplate_and_copies_stay(spark):
    line = "Read all our offers of this week in the shop around the corner"
    bare = prose(40, ENGLISH)
    around = [f"around{i} " + prose(30, ENGLISH) + f" end{i}" for i in range(6)]
    rows = [(i, "http://b.example/x", f"<p>{around[i]} {line} after{i}</p>") for i in range(6)]
    rows += [(20 + i, "http://c.example/x", f"<p>{bare}</p>") for i in range(2)]
    rows += [(30 + i, "http://d.example/x", f"<p>{bare} changed{i} {bare}</p>") for i in range(3)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for shard in (256, 1):
        got = {r.page_id: r.text for r in extract.extract(frame, shard=shard).collect()}
        assert all(got[i] == f"{around[i]} after{i}" for i in range(6))
        assert got[20] == got[21] == bare and all(got[30 + i] == f"{bare} changed{i} {bare}" for i in range(3))


def test_marks_of_wrappers_and_inline_elements():
    def text(source):
        return " ".join(t for _, _, t in extract.read_page(source).kept_blocks())

    for name in ("site no-sidebar", "content-with-sidebar", "sidebar-left-layout", "page has-ads"):
        assert text(f'<div class="{name}"><article><p>All of it</p></article></div>') == "All of it"
        assert text(f'<div class="{name}"><p>All of it</p></div>') == "All of it"
    assert text("<form><main><p>All of it</p></main><p>Mail</p></form><aside><article>Teaser</article></aside>") == "All of it Mail"
    inline = '<p>One <span class="advert">Buy now</span> two <span hidden>secret <b>x</b></span> three <a class="share">Share</a><p>four'
    assert text(inline) == "One two three four"
    assert text("<article><p>Own text of it</p><article class='comment'>Reply</article></article>") == "Own text of it"


def test_shared_substrings():
    rng = np.random.default_rng(4)
    for depth in (2, 4):
        pages = [rng.integers(0, 3, n).astype(np.uint64) for n in (0, 1, 5, 30, 30, 2)]
        want = defaultdict(set)
        for k, p in enumerate(pages):
            for i in range(len(p) - depth + 1):
                want[tuple(p[i : i + depth])].add(k)
        got = {tuple(pages[k][i : i + depth]): n for k, i, n in zip(*extract.shared_substrings(pages, depth), strict=True)}
        assert got == {key: len(held) for key, held in want.items()}


def test_token_hashes():
    tokens = "a b ab ba aab é e a éa ab x".split(" ")
    hashes = extract.token_hashes(" ".join(tokens).encode())
    assert len(set(hashes.tolist())) == len(set(tokens)) and hashes[0] == hashes[7] and hashes[2] == hashes[9]


def test_suffix_ranks():
    tokens = np.array([3, 1, 2, 3, 1, 2, 9, 3, 1])
    order, rank = extract.suffix_ranks(tokens, 4)
    keys = [tuple(tokens[i : i + 4]) for i in range(len(tokens))]
    assert [keys[i] for i in order] == sorted(keys)
    assert all((rank[a] == rank[b]) == (keys[a] == keys[b]) for a in range(len(keys)) for b in range(len(keys)))


# ---- 8: repeated passages


def brute_repeats(rows, window):
    first = {}
    for i, t in rows:
        w, own = words(t, False), -(2**63) if i is None else i
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, own), own)
    out = []
    for i, t in rows:
        w, own = words(t, False), -(2**63) if i is None else i
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < own:
                gone[k : k + window] = [True] * window
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))


@pytest.mark.parametrize("window", [50, 12])
def test_repeated_passages(docs, empty, window):
    got = by_row(repeats.without_repeats(docs, window), "doc_id", "n_words", "n_removed", "kept")
    assert got == brute_repeats([(r[0], r[1]) for r in ROWS], window)
    if window == 50:
        assert repeats.without_repeats(empty).count() == 0


def test_repeated_passages_of_few_words(spark):
    """A vocabulary of three words repeats phrases everywhere, also within a document."""
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 150))) + (" a b" * 30 if i % 3 == 0 else "")) for i in range(25)]
    got = by_row(repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 12), "doc_id", "n_words", "n_removed", "kept")
    assert got == brute_repeats(rows, 12)


# ---- 9: quality rules


def brute_counts(text):
    text = text or ""
    w = words(text, False)
    windows = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    inside = {k + j for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for j in range(5)}
    seen, same = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            same += line in seen
            seen.add(line)
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), same, len(inside)


def test_quality_counts_and_verdicts(spark, docs, empty):
    labels = spark.createDataFrame([(i, 1) for i in IDS if i] + [(None, 0), (7, None)], "doc_id long, quality int")
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality.judge(docs, labels)
    got = by_row(judged, "doc_id", *columns, "base_failed", "kept")
    want = []
    for i, t, *_ in ROWS:
        counts = brute_counts(t)
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        want.append((i, *counts, failed, not failed))
    assert got == sorted(want, key=lambda t: tuple((x is not None, x) for x in t))
    assert quality.judge(empty, labels).count() == 0 and quality.judge(docs, labels.limit(0)).count() == len(ROWS)


def test_quality_list_learns_conjunctions(spark):
    generator = np.random.default_rng(11)
    x = {"a": generator.random(900), "b": generator.random(900)}
    bad = (x["a"] > 0.7) & (x["b"] < 0.4)
    rules = quality.learn(x, bad)
    hit = np.zeros(900, bool)
    for rule in rules:
        hit |= quality.covers(rule, x)
    assert (hit == bad).mean() > 0.97
    rows, marks = [], []
    for i in range(300):
        junk = i % 5 == 0
        text = prose(60, ENGLISH)
        rows.append((i, text.replace(" ", " ### ") if junk else text))
        marks.append((i, 0 if junk else 1))
    found = quality.judge(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int"))
    assert all(r.kept == (r.doc_id % 5 != 0) for r in found.collect())
    assert quality.learn(x, np.zeros(900, bool)) == [] and quality.learn({"a": np.empty(0)}, np.empty(0, bool)) == []


# ---- 10: language


def test_language(docs, empty):
    got = langid.identify(docs).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(map(str, IDS))
    found = defaultdict(set)
    for r in got:
        found[r.doc_id].add(r.lang_pred)
    for i in (300, 301, 302, 306, 307):
        assert found[i] == {"und"}
    truth = {r[0]: r[2] for r in ROWS if r[0] and r[0] < 260}
    assert sum(found[i] == {truth[i]} for i in truth) >= 0.95 * len(truth)
    assert all(0 <= r.score <= 1 for r in got)
    assert langid.identify(empty).count() == 0
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    kept = langid.with_language(docs)
    assert kept.columns == docs.columns and not {300, 301, 302, 306, 307} & {r.doc_id for r in kept.collect()}


def test_gradient_of_the_network():
    net = langid.ByteConvNet(["a", "b"], seed=1)
    x = np.random.default_rng(0).integers(97, 123, (64, langid.WINDOW)).astype(np.uint8)
    y = (x == 101).sum(axis=1).argsort().argsort() % 2
    x[y == 1, 50:53] = [113, 120, 113]
    before = net.probabilities(x)[np.arange(64), y].mean()
    net.fit(x, y, epochs=80, batch=16)
    assert net.probabilities(x)[np.arange(64), y].mean() > max(0.9, before)


# ---- the queries and the pipeline

TABLES = ("documents", "pages", "benchmark", "labels", "embeddings")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    frame = queries.QUERIES[name](spark, sf_dir)
    answer = db.execute(queries.ORACLES[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == sorted(frame.columns)
    order = sorted(names)
    rows = [dict(zip(names, r, strict=True)) for r in answer.fetchall()]
    assert by_row(frame, *order) == sorted((tuple(r[c] for c in order) for r in rows), key=lambda t: tuple((x is not None, x) for x in t))


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark, tmp_path, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for name, frame in (("some", docs), ("none", empty)):
        frame.select(columns).write.parquet(str(tmp_path / name / "documents.parquet"))
        items.write.parquet(str(tmp_path / name / "benchmark.parquet"))
        current = spark.read.parquet(str(tmp_path / name / "documents.parquet"))
        for _, apply in corpus_pipeline.STAGES[:-1]:
            current = apply(spark, current, str(tmp_path / name))
            assert current.columns == columns
    out = corpus_pipeline.run(spark, str(tmp_path / "some")).collect()
    ids = {r.doc_id for r in out}
    assert all(r.round_trip for r in out) and {100, 110} <= ids
    assert not ids & {250, 251, 300, 301, 302, 306, 307, *range(210, 216)} and 203 in ids
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    assert 4 <= len(corpus_pipeline.STAGES) <= 5

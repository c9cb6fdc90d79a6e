"""Whitening and vector codes against plain numpy and plain Python."""

import hashlib
import math

import numpy as np
import pytest

from plumbline.llm import vectorcodes, vectors, whitening

rng = np.random.default_rng(11)
SCHEMA = "label int, vec_id long, embedding array<float>, vector string, size int, component int, code string, part int"


def table(size=12, n=260):
    spread = rng.standard_normal((size, size)) * np.linspace(0.5, 0.02, size)
    x = rng.standard_normal((n, size)) @ spread + 0.3
    rows = [(i, i % 4, row) for i, row in enumerate(x.astype(np.float32).tolist())]
    rows += [(1000 + i, 1, rows[7][2]) for i in range(120)]
    rows += [(5, None, rows[9][2]), (5, None, rows[3][2]), (None, None, rows[4][2]), (None, 2, rows[4][2])]
    bad = list(rows[0][2])
    rows += [(2000, 0, None), (2001, 0, [None, *bad[1:]]), (2002, 0, [math.nan, *bad[1:]]), (2003, 0, [*bad[1:], math.inf]), (2004, 0, [*bad[1:], -math.inf])]
    rows += [(-1, 0, bad[:-1]), (-2, 0, [*bad, 0.5]), (-3, 0, [])]
    order = rng.permutation(len(rows))
    return [rows[k] for k in order]


ROWS = table()


def frame(spark, rows, parts=5):
    full = [(label, i, v, "v", 1, 2, "c", 3) for i, label, v in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def kept(rows, size=12):
    return [(i, label, v) for i, label, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]


def ints(v, scale, shift=0):
    return [math.floor(float(x) * scale) + shift for x in v]


# ---- whitening


def test_roots_and_vectors_are_those_of_the_updated_matrix():
    for k in (1, 2, 7, 40):
        d = np.sort(rng.random((3, k)) * 100, axis=1)
        z = rng.standard_normal((3, k)) * 10.0 ** rng.integers(-6, 3, (3, k))
        weight = np.array([0.3, 5.0, 1e4])
        roots, gap = whitening.secular_roots(d, weight[:, None] * z * z)
        turn = whitening.turned(d, z, gap)
        for a in range(3):
            matrix = np.diag(d[a]) + weight[a] * np.outer(z[a], z[a])
            assert np.allclose(roots[a], np.linalg.eigvalsh(matrix), rtol=0, atol=1e-11 * abs(roots[a]).max())
            assert np.abs(turn[a].T @ turn[a] - np.eye(k)).max() < 1e-12
            assert np.abs(turn[a] @ np.diag(roots[a]) @ turn[a].T - matrix).max() < 1e-10 * abs(roots[a]).max()


@pytest.mark.parametrize("lanes", [1, 3, 8])
def test_spectra_of_awkward_vectors(lanes):
    """Repeated vectors, a constant one, directions that are missing, and eigenvalues that are equal."""
    flat = np.zeros((60, 9))
    flat[:, :4] = rng.integers(-5, 6, (60, 4))
    cross = np.vstack([np.eye(9), -np.eye(9)] * 3)
    for x in (flat, cross, np.ones((20, 9)), rng.integers(-900, 900, (50, 9)).astype(float), np.repeat(flat[:3], 10, 0)):
        spectra = [whitening.Spectrum(9, 9) for _ in range(lanes)]
        whitening.add_all(spectra, x, np.arange(1, len(x) + 1))
        own = whitening.merged(spectra)
        times = np.arange(1, len(x) + 1)
        mean = (x * times[:, None]).sum(0) / times.sum()
        scatter = ((x - mean) * times[:, None]).T @ (x - mean)
        assert own.n == times.sum() and np.allclose(own.mean, mean)
        got = own.basis @ np.diag(own.values) @ own.basis.T
        assert np.abs(got - scatter).max() <= 1e-10 * max(1.0, np.abs(scatter).max())
        assert np.abs(own.basis.T @ own.basis - np.eye(own.basis.shape[1])).max(initial=0) < 1e-11


def brute_whitening(rows, size=12):
    x = np.array([ints(v, 1024, 100_000) for _, _, v in rows], dtype=object)
    n, sums = len(x), x.sum(0)
    centred = np.array([[float(n * a - s) / n for a, s in zip(row, sums, strict=True)] for row in x])
    values, found = np.linalg.eigh(centred.T @ centred / n)
    values, found = values[::-1], found[:, ::-1]
    deviation = [sum(int(n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return n, deviation, centred @ found / np.sqrt(values), values / values.sum()


@pytest.mark.parametrize("rank", [None, 10])
def test_whitening_is_that_of_numpy(spark, rank):
    rows = kept(ROWS)
    n, deviation, white, explained = brute_whitening(rows)
    got = whitening.whiten(frame(spark, ROWS), rank=rank).collect()
    assert len(got) == 8 * len(rows) and {r.n for r in got} == {n}
    error = {r.identity_error for r in got}
    assert len(error) == 1 and error.pop() < 1e-6
    want = sorted((i is not None, i or 0, c + 1, d, round(abs(w[c]), 5)) for (i, _, _), d, w in zip(rows, deviation, white, strict=True) for c in range(8))
    assert sorted((r.vec_id is not None, r.vec_id or 0, r.component, r.deviation, round(abs(r.whitened), 5)) for r in got) == want
    for r in got:
        assert abs(r.explained - explained[r.component - 1]) <= 1e-6 * explained[r.component - 1]
    # One sign for all rows.
    at = {(r.vec_id, r.component): r.whitened for r in got if r.vec_id is not None and r.vec_id != 5}
    for c in range(8):
        pairs = [(at[i, c + 1], w[c]) for (i, _, _), w in zip(rows, white, strict=True) if (i, c + 1) in at]
        sign = np.sign(sum(a * b for a, b in pairs))
        assert max(abs(a * sign - b) for a, b in pairs) < 1e-6


def test_directions_without_variance_and_few_rows(spark):
    line = frame(spark, [(i, 0, [0.1 * i, 0.2 * i, 1.0]) for i in range(30)])
    got = {(r.vec_id, r.component): r for r in whitening.whiten(line).collect()}
    assert len(got) == 90 and all((got[i, c].whitened is None) == (c == 3) for i in range(30) for c in (1, 2, 3))
    assert got[3, 3].explained == 0 and got[3, 1].identity_error < 1e-6
    one = whitening.whiten(frame(spark, [(1, 0, [0.5, 0.25])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, 0.0, 0.0), (2, 1, 0, None, 0.0, 0.0)]
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, 0, None), (2, 0, [])])).count() == 0


def test_deviations_beyond_64_bits(spark):
    rows = [(1, 0, [1e30, 0.0]), (2, 0, [-1e30, 1.0]), (3, 0, [3.0, 2.0])]
    got = {r.vec_id: r for r in whitening.whiten(frame(spark, rows)).collect() if r.component == 1}
    assert got[1].deviation is None and got[2].deviation is None and len(got) == 3
    near = [(1, 0, [1e6, 0.0]), (2, 0, [2e6, 1.0])]
    got = {r.vec_id: r.deviation for r in whitening.whiten(frame(spark, near)).collect()}
    assert got == {1: 1_024_000_000**2 + 1024**2, 2: 1_024_000_000**2 + 1024**2}


# ---- codes


def test_curve_visits_neighbours():
    for dims, bits in ((2, 8), (3, 8)):
        side = np.array(np.meshgrid(*[np.arange(8)] * dims)).reshape(dims, -1).T * 32 + 16
        order = np.argsort(vectorcodes.hilbert(side, 0, 255))
        steps = np.abs(np.diff(side[order], axis=0)).sum(1)
        assert len(np.unique(vectorcodes.hilbert(side, 0, 255))) == len(side) and (steps == 32).all()


def test_shortlists_keep_every_nearest_entry():
    for _ in range(50):
        points, entries = rng.integers(-20, 20, (30, 4)), rng.integers(-20, 20, (9, 4))
        short = vectorcodes.shortlists(points.min(0)[None], points.max(0)[None], entries)[0]
        all_d = ((points[:, None] - entries[None]) ** 2).sum(2)
        assert short[(all_d == all_d.min(1)[:, None]).any(0)].all()
    far = np.array([[2**61, -(2**61)]])
    assert vectorcodes.distances(far, np.array([[0, 0]]))[0, 0] == 2 * 2**122
    assert vectorcodes.distances(np.array([[2**29, 3]]), np.array([[-(2**29), 0]]))[0, 0] == 2**60 + 9


def brute_codes(rows, parts=8, entries=16, rounds=6):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    x = [ints(v, 4096) for _, _, v in rows]
    size = len(x[0])
    cuts = np.cumsum([0, *[size // parts + (k < size % parts) for k in range(parts)]]).tolist()
    cut = lambda v: [v[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    cut_rows = [cut(v) for v in x]
    books = [[cut_rows[k][p] for k in range(min(entries, len(x)))] for p in range(parts)]

    def nearest(p, sub):
        return min((sum((a - b) ** 2 for a, b in zip(sub, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = [[list(e) for e in b] for b in books]
        for p in range(parts):
            own = {}
            for row in cut_rows:
                own.setdefault(nearest(p, row[p])[1], []).append(row[p])
            for k, members in own.items():
                new[p][k] = [sum(c) // len(members) for c in zip(*members, strict=True)]
        books = new
    text = ",".join(str(v) for b in books for e in b for v in e)
    out, by_label = [], {}
    for (i, label, _), row in zip(rows, cut_rows, strict=True):
        found = [nearest(p, row[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), error))
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((i, label, c, e, by_label[label], sha) for i, label, c, e in out), key=str)


def coded(df, **how):
    got = vectorcodes.compress(df, **how)
    assert got.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("block, parts", [(256, 8), (4, 5)])
def test_codes_are_those_of_plain_rounds(spark, monkeypatch, block, parts):
    monkeypatch.setattr(vectorcodes, "BLOCK", block)
    assert coded(frame(spark, ROWS), parts=parts) == brute_codes(kept(ROWS), parts=parts)


def test_codes_of_large_numbers_ties_and_few_rows(spark, monkeypatch):
    far = [(i, 0, [1e6 * (-1) ** i, float(i), 0.0, 0.0, 0.0, 0.0, 1e5, 1.0 * (i % 3)]) for i in range(40)]
    assert coded(frame(spark, far)) == brute_codes(kept(far, 8))
    few = [(i, None, [float(i % 2)] * 8) for i in range(5)]
    assert coded(frame(spark, few)) == brute_codes(kept(few, 8))
    monkeypatch.setattr("plumbline.llm.common.BROADCAST_ROWS", 0)
    ties = [(i, i % 2, [float((i * 7) % 5 - 2)] * 8) for i in range(60)]
    assert coded(frame(spark, ties)) == brute_codes(kept(ties, 8))


def test_codes_of_nothing(spark):
    assert coded(frame(spark, [])) == [] and coded(frame(spark, [(1, 0, None)])) == []
    got = coded(frame(spark, [(1, 0, []), (2, None, [])]))
    assert [(r[0], r[2], r[3]) for r in got] == [(1, "00" * 8, 0), (2, "00" * 8, 0)]


def test_decoding_is_as_far_away_as_the_error_says(spark):
    rows, size = vectors.usable(frame(spark, ROWS).select("vec_id", "label", "embedding"))
    shape = vectorcodes.shape_of(rows, size, 4)
    books = vectorcodes.train(rows, shape, entries=32, rounds=3)
    near = vectorcodes.decode(vectorcodes.encode(rows, shape, books), books)
    originals = {}
    for i, _, v in kept(ROWS):
        originals.setdefault(i, []).append(ints(v, 4096))
    for r in near.collect():
        whole = [math.floor(4096 * a) for a in r.approximation]
        assert r.error in [sum((a - b) ** 2 for a, b in zip(whole, v, strict=True)) for v in originals[r.vec_id]]

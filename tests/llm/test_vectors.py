"""Hard negatives and whitening on small tables, against plain numpy."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from subscore.llm import hard_negatives
from subscore.llm.hard_negatives import Directions, directions_of, mine_hard_negatives, packed, products, unpacked
from subscore.llm.whitening import Spectrum, negative_pivots, whiten

VECTORS = "vec_id long, embedding array<double>, label int"


def vectors(spark, rows, extra=""):
    return spark.createDataFrame(rows, VECTORS + extra).repartition(3)


def fine(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


# --- hard negatives -----------------------------------------------------------


def negatives_by_hand(rows, scale=256, k=5, least=80, most=100):
    rows = [(i, l, [math.floor(scale * x) for x in v]) for i, v, l, *_ in rows if None not in (i, l) and fine(v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    asked = {}
    for i, l, v in sorted(rows):
        if i % 100 == 0:
            asked.setdefault(i, (l, v))
    found = []
    for anchor, (label, own) in asked.items():
        scored = sorted((-dot(own, v), i, l) for i, l, v in rows if i != anchor)
        for score, positive in [(-s, i) for s, i, l in scored if l == label][:k]:
            hard = [(i, -s) for s, i, l in scored if l != label and least * score <= -100 * s <= most * score]
            found += [(anchor, positive, at + 1, i, score, s) for at, (i, s) in enumerate(hard[:k])]
    return found


def mined(spark, rows, extra="", **options):
    found = mine_hard_negatives(vectors(spark, rows, extra), F.col("vec_id") % 100 == 0, **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("size", [None, 7])
def test_hard_negatives(spark, monkeypatch, size):
    if size:
        monkeypatch.setattr(hard_negatives, "ROWS", size)
        monkeypatch.setattr(hard_negatives, "ANCHORS", 2)
        monkeypatch.setattr(hard_negatives, "INDEX", 5)
        monkeypatch.setattr(hard_negatives, "UNIT", 2)
    rng = random.Random(1)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = []
    for n in range(160):
        centre = rng.choice(centres)
        # A third of all rows have one label; steps of 1/64 make many ties.
        rows.append((n * 10, [round((c + rng.gauss(0, 0.3)) * 64) / 64 for c in centre], rng.choice([0, 0, 1, 2])))
    rows += [rows[3]] * 4 + [rows[10], (100, rows[10][1], 1)]
    rows += [(None, [1.0] * 6, 1), (1, None, 1), (2, [1.0] * 6, None), (3, [1.0, None] * 3, 1)]
    rows += [(4, [float("nan")] * 6, 1), (5, [float("inf")] * 6, 0), (300, [], 0), (7, [2.0, 1.0], 1), (8, [0.0] * 6, 2)]
    clashing = [(*row, n, "x") for n, row in enumerate(rows)]
    found = mined(spark, clashing, ", id int, anchor string")
    assert found == sorted(negatives_by_hand(rows)) and len(found) > 100


def test_hard_negatives_of_nothing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []  # no anchor
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 2)]) == []  # no positive
    assert mined(spark, [(0, [], 1), (1, [], 1), (2, [], 2)]) == [(0, 1, 1, 2, 0, 0)]


def test_bounds_hold_and_exclude():
    random = np.random.default_rng(2)
    rows = np.floor(256 * random.standard_normal((300, 8)) * random.uniform(0, 3, (300, 1))).astype(np.int64)
    rows[:5] = rows[5:10]
    rows[10] = 0
    index = directions_of(rows[:40], 6)
    angles, norms = index.angles(rows)
    low, high = Directions.limits(angles, norms, angles, angles, norms, norms)
    exact = rows @ rows.T
    assert (low <= exact).all() and (exact <= high).all()
    assert (high < 0).mean() > 0.02  # many signs are known without a product
    blocks = np.arange(0, 300, 30)
    least, most = (f.reduceat(angles, blocks) for f in (np.minimum, np.maximum))
    low, high = Directions.limits(
        angles, norms, least, most, np.minimum.reduceat(norms, blocks), np.maximum.reduceat(norms, blocks)
    )
    assert (low <= np.minimum.reduceat(exact, blocks, 1)).all() and (high >= np.maximum.reduceat(exact, blocks, 1)).all()


def test_far_rows_get_no_score(spark, monkeypatch):
    """Two far apart bundles of directions: rows of the other bundle are never multiplied."""
    random = np.random.default_rng(4)
    near = np.concatenate([np.eye(1, 12) + random.normal(0, 0.01, (60, 12)), -np.eye(1, 12) + random.normal(0, 0.01, (400, 12))])
    seen = []
    monkeypatch.setattr(hard_negatives, "products", lambda a, b: seen.append(len(b)) or products(a, b))
    index = directions_of(np.floor(near * 256)[::20], 4)
    rows = np.floor(near * 256).astype(np.int64)
    angles, norms = index.angles(rows)
    ask = {"ids": rows[:1, 0] * 0, "labels": np.zeros(1, np.int64), "norms": norms[:1], "angles": angles[:1]}
    head = {k: v.tobytes() for k, v in ask.items()} | {"vectors": packed(rows[:1])}
    head["windows"] = np.array([[0], [0], [1], [1 << 60]]).tobytes()
    held = hard_negatives._Held(head, 12, 5)
    body = {"ids": np.arange(1, 461), "labels": np.zeros(460, np.int64), "norms": norms, "angles": angles}
    held.compare({k: v.tobytes() for k, v in body.items()} | {"vectors": packed(rows)}, True)
    assert seen == [60]


def test_products_of_large_numbers():
    random = np.random.default_rng(3)
    for size in (1 << 10, 1 << 28, 1 << 40):
        rows = random.integers(-size, size, (5, 4))
        assert (unpacked(packed(rows), 4) == rows).all()
        want = rows.astype(object) @ rows.astype(object).T
        limits = np.iinfo(np.int64)
        assert (products(rows, rows) == np.clip(want, limits.min, limits.max)).all()


# --- whitening ----------------------------------------------------------------


@pytest.mark.parametrize("size", [1, 2, 5, 30])
def test_inertia(size):
    random = np.random.default_rng(size)
    for _ in range(20):
        a = random.standard_normal((size, size)) * random.integers(0, 2, (size, size))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        shift = float(random.normal())
        assert negative_pivots(a - shift * np.eye(size)) == (values < shift).sum()


def test_spectrum_of_close_and_equal_eigenvalues():
    random = np.random.default_rng(5)
    turn = np.linalg.qr(random.standard_normal((12, 12)))[0]
    values = np.array([9, 9, 7, 7 - 1e-6, 7 - 2e-6, 3, 2, 2, 2, 1, 0, 0.0])
    a = turn @ np.diag(values) @ turn.T
    spectrum = Spectrum((a + a.T) / 2)
    found, basis = spectrum.leading(10)
    assert np.abs(found - values[:10]).max() < 1e-13
    assert np.abs(basis.T @ basis - np.eye(10)).max() < 1e-8
    assert np.abs(a @ basis - basis * found).max() < 1e-13
    assert spectrum.certified(3.0, 6, 6) and not spectrum.certified(3.0, 5, 5)


def whitened_by_hand(rows, components):
    usable = [(i, v) for i, v, *_ in rows if fine(v)]
    dims = max((len(v) for _, v in usable), default=0)
    x = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in [*v, *[0.0] * (dims - len(v))])) for i, v in usable]
    fit = np.array(sorted({v for _, v in x}), np.int64)
    n, total = len(fit), fit.sum(0)
    centred = (fit * n - total) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), range(vectors.shape[1])])
    rows = [(i, np.array(v) * n - total) for i, v in x]
    return n, values, [(i, int((off**2).sum()), off / n @ vectors / np.sqrt(values)) for i, off in rows]


def test_whitening(spark):
    random = np.random.default_rng(6)
    base = random.standard_normal((120, 9)) * np.linspace(3, 0.3, 9) + 1000
    rows = [(n, v.tolist(), 0) for n, v in enumerate(base)]
    rows += [rows[0]] * 60 + [(None, rows[1][1], 1), (500, [7.0, 1e3], 0), (501, [], 0)]
    rows += [(502, None, 0), (503, [None, 1.0], 0), (504, [float("nan")] * 9, 0), (505, [float("-inf")] * 9, 0)]
    found = whiten(vectors(spark, [(*r, 5) for r in rows], ", x int"), 4).collect()
    n, values, want = whitened_by_hand(rows, 4)
    assert len(found) == 4 * len(want) and {r.n for r in found} == {n} == {122}
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9
    key = lambda r: (r[0] is None, r[0] or 0)
    for component in range(4):
        got = sorted([(r.vec_id, r.deviation, r.whitened) for r in found if r.component == component + 1], key=key)
        for (i, deviation, value), (j, exact, whole) in zip(got, sorted(want, key=key)):
            assert (i, deviation) == (j, exact) and abs(value - whole[component]) < 1e-9
    trace = 1 / {r.component: r.explained for r in found}[1] * values[0]
    assert all(abs(r.explained - values[r.component - 1] / trace) < 1e-9 for r in found)


def test_whitening_without_variance(spark):
    assert whiten(vectors(spark, [])).collect() == []
    assert whiten(vectors(spark, [(1, [], 0), (2, None, 0)])).collect() == []
    same = whiten(vectors(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same] == [(1, 0, None, 0, None)] * 4
    line = whiten(vectors(spark, [(1, [0.0, 0.0], 0), (2, [1.0, 1.0], 0), (3, [2.0, 2.0], 0)])).collect()
    assert {(r.vec_id, r.component): r.whitened is None for r in line} == {(i, c): c == 2 for i in (1, 2, 3) for c in (1, 2)}
    assert all(abs(r.explained - (r.component == 1)) < 1e-12 and r.identity_error < 1e-12 for r in line)
    far = whiten(vectors(spark, [(1, [1e300], 0), (2, [-1e300], 0), (3, [0.0], 0)])).collect()
    assert [r.deviation for r in far if r.vec_id != 3] == [None, None] and all(r.n == 3 for r in far)

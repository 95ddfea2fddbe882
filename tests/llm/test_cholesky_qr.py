"""Whitening against exact integer sums and numpy's eigenvectors of the whole covariance."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import cholesky_qr


def plain(rows, components=8):
    """Everything at once, in plain numbers."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    sizes = Counter(len(v) for _, v in good)
    d = max(sizes, key=lambda s: (sizes[s], s), default=0)
    good = [(i, [math.floor(1024.0 * c) + 100_000 for c in v]) for i, v in good if len(v) == d]
    n = len(good)
    sums = [sum(x[j] for _, x in good) for j in range(d)]
    centred = np.array([[float((n * x[j] - sums[j]) / n) for j in range(d)] for _, x in good]).reshape(n, d)
    values, vectors = np.linalg.eigh(centred.T @ centred / max(n, 1)) if d else (np.zeros(0), np.zeros((0, 0)))
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for (i, x), row in zip(good, centred, strict=True):
        deviation = sum((n * x[j] - sums[j]) ** 2 for j in range(d))
        for c in range(min(components, d)):
            some = values[c] > values[0] * 1e-20
            out.setdefault((i, c + 1), []).append((
                n, deviation, row @ vectors[:, c] / math.sqrt(values[c]) if some else None,
                values[c] / values.sum() if values.sum() else None,
            ))
    return out


def table(spark, rows):
    extra = {"v": F.lit("x"), "n": F.lit(1), "component": F.lit(2), "label": F.lit(None).cast("int")}
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns(extra).repartition(3)


def check(found, wanted, tolerance=1e-7):
    groups = {}
    for r in found:
        groups.setdefault((r.vec_id, r.component), []).append(r)
    assert {k: len(v) for k, v in groups.items()} == {k: len(v) for k, v in wanted.items()}
    signs = {}
    for key, rows in groups.items():
        left = sorted(rows, key=lambda r: (r.deviation, abs(r.whitened or 0)))
        right = sorted(wanted[key], key=lambda w: (w[1], abs(w[2] or 0)))
        for r, (n, deviation, score, share) in zip(left, right, strict=True):
            assert (r.n, r.deviation) == (n, deviation)
            assert (r.whitened is None) == (score is None)
            if share is not None:
                assert r.explained == pytest.approx(share, rel=1e-9, abs=1e-15)
            if score is not None:
                assert abs(r.whitened) == pytest.approx(abs(score), abs=tolerance)
                if abs(score) > 1e-3:
                    signs.setdefault(key[1], set()).add(r.whitened * score > 0)
                assert r.identity_error < 1e-9
    assert all(len(s) == 1 for s in signs.values())


def random_rows(n, d, seed):
    r = np.random.default_rng(seed)
    spread = np.diag(np.geomspace(1, 0.01, d))
    return [(int(i), list(map(float, row))) for i, row in enumerate((r.normal(size=(n, d)) @ spread).astype(np.float32))]


SETS = {
    "plain": random_rows(300, 16, 1),
    "narrow": random_rows(40, 3, 2),
    "awkward": [
        *random_rows(120, 12, 3), (5, None), (None, [float(i) for i in range(12)]), (None, [1.0] * 12), (7, [float("nan")] * 12),
        (8, [float("inf"), *[0.0] * 11]), (9, [None, *[0.0] * 11]), (10, [1.0]), (11, []), (12, [0.5] * 12), (12, [0.5] * 12),
    ],
    "nothing": [(1, None), (2, [None])],
    "empty": [],
}


@pytest.mark.parametrize("name", SETS)
def test_whitening_equals_plain(spark, name):
    found = cholesky_qr.whitened(table(spark, SETS[name])).collect()
    check(found, plain(SETS[name]))


def test_dependent_and_constant_dimensions(spark):
    rows = [(i, [round(c * 1024) / 1024 for c in v]) for i, v in random_rows(200, 2, 4)]
    rows = [(i, [v[0], v[1], v[0] + v[1], 0.25, v[0]]) for i, v in rows]
    found = cholesky_qr.whitened(table(spark, rows)).collect()
    check(found, plain(rows))
    assert {r.component for r in found if r.whitened is None} == {3, 4, 5}


def test_few_vectors_and_large_numbers(spark):
    few = random_rows(3, 6, 5)
    found = cholesky_qr.whitened(table(spark, few)).collect()
    assert {r.component for r in found if r.whitened is not None} == {1, 2}
    one = cholesky_qr.whitened(table(spark, few[:1])).collect()
    assert len(one) == 6 and {(r.deviation, r.whitened, r.explained) for r in one} == {(0, None, None)}
    large = [(i, [2.0**40 * r, float(i)]) for i, r in enumerate((1, -1, 3, 2))]
    wanted = plain(large)
    found = cholesky_qr.whitened(table(spark, large)).collect()
    assert {r.deviation for r in found} == {None} and min(w[0][1] for w in wanted.values()) > 1 << 63
    assert all(abs(r.whitened) == pytest.approx(abs(wanted[r.vec_id, 1][0][2])) for r in found if r.component == 1)


def test_matrices_are_added_level_by_level(spark, monkeypatch):
    monkeypatch.setattr(cholesky_qr, "FAN", 2)
    rows = cholesky_qr.valid_vectors(table(spark, SETS["plain"]).repartition(7))
    total = cholesky_qr.summed(rows, lambda x: x.astype(float).sum(axis=0))
    exact = [sum(math.floor(1024.0 * v[j]) + 100_000 for _, v in SETS["plain"]) for j in range(16)]
    assert total.tolist() == exact


def test_badly_conditioned_rows(spark):
    r = random.Random(6)
    base = [[r.choice([-1.0, 1.0]) * 2.0**k for k in (40, 20, 0, -8)] for _ in range(64)]
    rows = [(i, v) for i, v in enumerate(base)]
    found = cholesky_qr.whitened(table(spark, rows)).collect()
    assert max(r.identity_error for r in found) < 1e-4
    assert {r.component for r in found if r.whitened is not None} >= {1, 2}


def test_query_equals_plain(spark):
    from tidegauge.llm.queries import QUERIES

    where = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{where}/embeddings.parquet").collect()]
    check(QUERIES["op11_cholesky_whitening"](spark, where).collect(), plain(rows))

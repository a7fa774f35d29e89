"""Whitening against a plain eigendecomposition in extended precision, and its edge cases."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from listingflow.llm import whitening
from listingflow.llm.common import table

SF = "/root/testdata/sf0.001"


def brute(rows, most=8):
    """{(id, component): (n, deviation, whitened up to the component's sign, explained)}."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in good]
    n = len(x)
    sums = [sum(c) for c in zip(*x)]
    y = [[n * a - s for a, s in zip(r, sums)] for r in x]
    a = np.array(y, np.longdouble) / n
    e, v = np.linalg.eigh((a.T @ a / n).astype(np.float64))
    order = np.argsort(-e)[:most]
    trace = e.sum()
    out = []
    for (i, _), dev, row in zip(good, y, a):
        for k, c in enumerate(order, 1):
            if e[c] > 1e-12 * e.max():
                out.append((i, k, n, sum(d * d for d in dev), float(row @ v[:, c]) / math.sqrt(e[c]), e[c] / trace))
    return out


def compare(got, want):
    signs = {}
    got = {(r.vec_id, r.component): r for r in got}
    assert got.keys() == {w[:2] for w in want}
    for i, k, n, dev, z, share in want:
        r = got[i, k]
        assert (r.n, r.deviation) == (n, dev)
        assert r.explained == pytest.approx(share, rel=1e-8)
        assert r.identity_error < 1e-9
        if abs(z) > 1e-3:
            assert signs.setdefault(k, z * r.whitened > 0) == (z * r.whitened > 0)
        assert abs(r.whitened) == pytest.approx(abs(z), abs=1e-6)


def test_given_table_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    compare(whitening.query(spark, SF).collect(), brute(rows))


def test_awkward_rows(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, s) for s in (3, 2, 1.5, 1, 0.5, 0.25)]) for i in range(40)]
    bad = [(100, None), (101, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (102, [float("nan")] * 6), (103, [float("inf")] + [0.0] * 5), (104, []), (105, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows + bad], "vec_id long, embedding array<double>, x string, id int, n int").repartition(3)
    compare(whitening.whiten(df).collect(), brute(rows))
    twice = whitening.whiten(df.union(df.filter("vec_id = 3"))).collect()
    assert sum(r.vec_id == 3 for r in twice) == 12 and {r.n for r in twice} == {41}
    nulls = df.withColumn("vec_id", df.vec_id.cast("string")).replace({"3": None}, subset=["vec_id"])
    assert whitening.whiten(nulls).filter("vec_id is null").count() == 6


def test_directions_without_variance_give_no_component(spark):
    rng = random.Random(6)
    rows = []
    for i in range(30):
        a, b = rng.randrange(-200, 200), rng.randrange(-2, 3)
        rows.append((i, [a / 1024, b / 1024, 7.0, (a + b) / 1024, 2 * a / 1024]))  # rank 2
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in got} == {1, 2}
    compare(got, brute(rows))
    few = whitening.whiten(spark.createDataFrame(rows[:2], "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in few} == {1} and {round(abs(r.whitened), 9) for r in few} == {1.0}
    for none in (rows[:1], [(1, [2.0, 3.0]), (2, [2.0, 3.0])], [(1, None)], []):
        assert whitening.whiten(spark.createDataFrame(none, "vec_id long, embedding array<double>")).collect() == []


def test_ill_conditioned_rows_are_orthogonalised(spark):
    rng = np.random.default_rng(8)
    scale = np.array([1e6, 1e4, 1e2, 1, 1e-1, 1e-2])
    turn = np.linalg.qr(rng.normal(size=(6, 6)))[0]
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 6)) * scale @ turn)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 1800 and got[0].identity_error < 1e-9
    assert {r.component: r.explained for r in got}[6] < 1e-15


def test_deviation_is_exact_and_bounded():
    model = whitening.Whitener(3, np.array([3 << 40, 0]))
    x = np.array([[(1 << 40) + 7, 5], [1 << 60, 0]])
    assert model.deviations(x[:1]) == [9 * 49 + 225]
    assert model.deviations(x)[0] == 9 * 49 + 225 and model.deviations(x)[1] is None

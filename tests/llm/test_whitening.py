"""Whitening against numpy's eigenvectors and Python's whole numbers."""

import math

import numpy as np
import pytest

from auditloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, i int"


def frame(spark, vectors, ids=None):
    rows = [
        (None if ids and ids[n] is None else n, None if v is None else [None if c is None else float(c) for c in v], 1, "x", 2)
        for n, v in enumerate(vectors)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def usable(vectors):
    found = {}
    for n, v in enumerate(vectors):
        if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v):
            found[n] = [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]
    return found


def check(spark, vectors, components=16):
    rows = whitening.whiten(frame(spark, vectors), components).collect()
    x = usable(vectors)
    different = sorted(set(map(tuple, x.values())))
    n, sums = len(different), [sum(c) for c in zip(*different)]
    centred = np.array([[(n * a - s) / n for a, s in zip(d, sums)] for d in different])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > 1e-12 * values[0]).sum()))
    assert {(r.vec_id, r.component) for r in rows} == {(i, c + 1) for i in x for c in range(k)}
    signs = {}
    for r in rows:
        at = r.component - 1
        own = [n * a - s for a, s in zip(x[r.vec_id], sums)]
        assert r.n == n and r.deviation == sum(d * d for d in own)
        want = float(np.array(own) / n @ axes[:, at]) / math.sqrt(values[at])
        if abs(want) > 1e-6:
            sign = signs.setdefault(at, math.copysign(1, want * r.whitened))
            assert r.whitened == pytest.approx(sign * want, rel=1e-6, abs=1e-8)
        assert r.explained == pytest.approx(values[at] / np.trace(covariance), rel=1e-9)
        assert r.identity_error <= 1e-9
    return rows


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    assert [r.vec_id for r in table] == list(range(len(table)))
    check(spark, [r.embedding for r in table])


def test_odd_vectors(spark):
    draw = np.random.default_rng(5)
    vectors = [*draw.normal(size=(60, 5)) * [10, 3, 1, 0.3, 0.1], None, [], [1, None, 2, 3, 4]]
    vectors += [[1, float("nan"), 0, 0, 0], [float("inf")] * 5, [0.0] * 5]
    vectors += [vectors[0]] * 40  # a third of all rows is one vector, which counts once
    check(spark, vectors)
    check(spark, vectors, 2)


def test_fewer_directions_than_components(spark):
    draw = np.random.default_rng(6)
    plane = draw.integers(-20, 20, size=(50, 2)) @ draw.integers(-4, 5, size=(2, 6))
    rows = check(spark, plane.astype(float))
    assert max(r.component for r in rows) == 2


def test_lengths_and_ids(spark):
    draw = np.random.default_rng(7)
    vectors = [*draw.normal(size=(20, 3)), *draw.normal(size=(5, 2))]
    rows = whitening.whiten(frame(spark, vectors, ids=[None, *range(24)])).collect()
    assert {r.vec_id for r in rows} == {None, *range(1, 20)}


def test_nothing_to_whiten(spark):
    for vectors in ([], [None, []], [[1.0, 2.0]] * 5):
        assert whitening.whiten(frame(spark, vectors)).collect() == []


def test_numbers_beyond_64_bits(spark):
    rows = whitening.whiten(frame(spark, [[2.0**40, 1.0], [-(2.0**40), 2.0], [0.0, 3.0]])).collect()
    assert {r.deviation for r in rows} <= {None} | {0} or all(r.deviation is None or r.deviation >= 0 for r in rows)
    assert any(r.deviation is None for r in rows)
    assert all(math.isfinite(r.whitened) for r in rows)


@pytest.mark.parametrize("size,rank", [(1, 1), (7, 7), (24, 24), (24, 9)])
def test_factor_and_rotations(size, rank):
    draw = np.random.default_rng(size + rank)
    basis = draw.normal(size=(size, rank)) * 10.0 ** -np.arange(rank)[None, :].clip(0, 5)
    a = basis @ basis.T
    factor = whitening.pivoted_cholesky(a)
    assert np.allclose(factor @ factor.T, a, rtol=0, atol=1e-12 * np.abs(a).max())
    values, axes = whitening.eigen(a)
    want = np.linalg.eigvalsh(a)[::-1][: len(values)]
    assert np.allclose(values, want, rtol=1e-6, atol=1e-13 * want[0])
    assert np.allclose(axes @ axes.T, np.eye(len(values)), atol=1e-10)
    assert np.allclose(a @ axes.T, axes.T * values, atol=1e-11 * want[0])


def test_every_pair_of_columns_once():
    for n in (2, 3, 8, 9):
        pairs = [frozenset(p) for a, b in whitening._rounds(n) for p in zip(a.tolist(), b.tolist())]
        assert len(pairs) == len(set(pairs)) == n * (n - 1) // 2

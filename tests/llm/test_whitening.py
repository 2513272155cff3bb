"""Bit-sliced scatter and whitening against plain integer and floating arithmetic."""

from __future__ import annotations

import numpy as np
import pytest

from conftest import SF01
from eventspark.llm import queries
from eventspark.llm.whitening import and_counts, from_limbs, limbs, planes, products, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string"


def plain(rows):
    """Expected result of op11 by vector id, from dense arithmetic."""
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    out = {}
    for size in {len(v) for _, v in rows}:
        own = [(i, v) for i, v in rows if len(v) == size]
        x = np.stack([np.floor(v * 1024).astype(np.int64) + 100_000 for _, v in own])
        n = len(x)
        d = n * x - x.sum(axis=0)
        apart = d / n
        cov = apart.T @ apart / n
        e, w = np.linalg.eigh(cov)
        for (i, _), row, dev in zip(own, apart, (d * d).sum(axis=1), strict=True):
            out.setdefault(i, []).extend(
                (k + 1, n, int(dev), row @ w[:, -1 - k] / np.sqrt(e[-1 - k]), e[-1 - k] / np.trace(cov))
                for k in range(min(8, size)) if e[-1 - k] > 1e-9 * e[-1])
    return out


def check(got, want):
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], []).append(r)
        assert 0 <= r["identity_error"] < 1e-6
    assert by_id.keys() == want.keys()
    for i, rows in by_id.items():
        a, b = sorted(rows, key=lambda r: (r["component"], r["n"])), sorted(want[i])
        assert [(r["component"], r["n"], r["deviation"]) for r in a] == [t[:3] for t in b]
        assert all(abs(abs(r["whitened"]) - abs(t[3])) < 1e-6 and abs(r["explained"] - t[4]) < 1e-9 for r, t in zip(a, b, strict=True))


def test_all_embeddings_match_plain(spark):
    rows = spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = queries.op11_whitening(spark, SF01).collect()
    check(got, plain(rows))
    signs = {}
    for r in got:  # one sign per component for all rows
        signs.setdefault(r["component"], []).append(r["whitened"])
    cov = np.cov(np.array([signs[k] for k in sorted(signs)]), bias=True)
    assert np.abs(cov - np.eye(len(cov))).max() < 1e-6


def test_edges(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(70)] + [(100 + i, rng.normal(size=2).tolist()) for i in range(9)]
    rows += [(3, rows[3][1]), (None, rows[5][1]), (200, None), (201, []), (202, [1.0, None, 2.0, 0.0]),
             (203, [1.0, float("nan"), 2.0, 0.0]), (204, [float("inf"), 0.0, 0.0, 0.0]), (205, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(i, v, 1, "c", "n") for i, v in rows], SCHEMA).repartition(5)
    got = whiten(df).collect()
    check([r for r in got if r["vec_id"] != 3], {k: v for k, v in plain(rows).items() if k not in (3, 205)})
    assert sum(r["vec_id"] == 3 for r in got) == 8  # repeated rows stay two; a single vector of its length has no component
    assert whiten(df.limit(0)).count() == 0
    same = spark.createDataFrame([(i, [0.5, 0.25], 1, "c", "n") for i in range(6)], SCHEMA)
    assert whiten(same).count() == 0


def test_huge_entries_stay_exact(spark):
    rows = [(0, [1e30, 1.0]), (1, [-1e30, 2.0]), (2, [5.0, 3.0]), (3, [0.0, -4.0])]
    got = whiten(spark.createDataFrame([(i, v, 1, "c", "n") for i, v in rows], SCHEMA)).collect()
    assert {r["vec_id"] for r in got} == {0, 1, 2, 3} and all(r["deviation"] is None for r in got if r["vec_id"] < 2)
    assert all(r["identity_error"] < 1e-4 for r in got)


@pytest.mark.parametrize("spread", [1, 2, 1000, 1 << 40])
def test_scatter_is_exact(spread):
    rng = np.random.default_rng(spread)
    y = rng.integers(0, spread, (333, 5))
    y[:, 2] = 0  # a constant dimension has no plane
    bits = np.array([int(m).bit_length() for m in y.max(axis=0)])
    counts = np.zeros((bits.sum(), bits.sum()), np.int64)
    for at in range(0, len(y), 100):
        and_counts(planes(y[at:at + 100], bits), counts)
    want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j], strict=True)) for j in range(i, 5)] for i in range(5)]
    assert products(counts, bits) == want
    flat = [v for row in want for v in row] + [-5, -(1 << 140)]
    cols = [c.to_pylist() for c in limbs(flat)]
    assert [from_limbs({f"l{i}": c[k] for i, c in enumerate(cols)}) for k in range(len(flat))] == flat

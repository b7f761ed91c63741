"""Op 10 against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from corpusmill.llm.op10_lattice_neardup import cell_codes, decode_e8, minimal_vectors, near_duplicates, plan, unit


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 8)) * 2
    p = decode_e8(x)
    assert ((p * 2) % 1 == 0).all() and (p.sum(axis=1) % 2 == 0).all()
    steps = minimal_vectors()
    assert len(steps) == 240 and np.allclose((steps**2).sum(axis=1), 2)
    own = ((x - p) ** 2).sum(axis=1)
    assert (own[:, None] <= ((x[:, None] - p[:, None] - steps[None]) ** 2).sum(axis=2) + 1e-12).all()


def pairs_at(rng, n: int, cosine: float, dim: int = 64) -> tuple[np.ndarray, np.ndarray]:
    u = unit(rng.normal(size=(n, dim)))
    w = rng.normal(size=(n, dim))
    w = unit(w - (w * u).sum(axis=1, keepdims=True) * u)
    return u, cosine * u + np.sqrt(1 - cosine**2) * w


@pytest.mark.parametrize("dim", [8, 32, 64, 384, 768])
@pytest.mark.parametrize("n", [1000, 10**5, 10**7])
def test_recall_of_cells(dim, n):
    """At cosine 0.9 exactly, with the cells and tables that so many vectors get."""
    tables, stretch = plan(n)
    u, v = pairs_at(np.random.default_rng(1), 1500, 0.9, dim)
    a, b = cell_codes(u, tables, 3, stretch), cell_codes(v, tables, 3, stretch)
    met = ((a[:, :, :1] == b) | (b[:, :, :1] == a)).any(axis=(1, 2))
    assert met.mean() > 0.93


def compared(n: int, dim: int) -> float:
    """Pairs that random vectors make: visits of each cell times its members, over all tables."""
    tables, stretch = plan(n)
    v = unit(np.random.default_rng(n).normal(size=(n, dim)))
    codes = cell_codes(v, tables, 3, stretch)
    total = 0
    for t in range(tables):
        cells, members = np.unique(codes[:, t, 0], return_counts=True)
        at = np.minimum(np.searchsorted(cells, codes[:, t]), len(cells) - 1)
        total += int(members[at][cells[at] == codes[:, t]].sum()) - n
    return total


@pytest.mark.parametrize("dim", [64, 384])
def test_comparisons_grow_more_slowly_than_n_to_1_5(dim):
    counts = [compared(n, dim) for n in (4000, 16000, 64000)]
    for a, b in zip(counts[:-1], counts[1:], strict=True):
        assert b / a < 4**1.5
    assert counts[-1] < 64000**1.5


def test_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    u, v = pairs_at(rng, 150, 0.93)
    hub = unit(rng.normal(size=(1, 64)))
    crowd = unit(hub + 0.02 * rng.normal(size=(200, 64)))
    rows = [x.tolist() for x in np.concatenate([u, v, crowd])] + [hub[0].tolist()] * 120 + [(3 * hub[0]).tolist()]
    odd = [None, [0.0] * 64, [float("nan")] * 64, [float("inf")] * 64, [None] * 64, [1.0] * 3, []]
    ids = rng.permutation(len(rows) + len(odd))
    df = spark.createDataFrame([(int(i), x, 1) for i, x in zip(ids, rows + odd, strict=True)] + [(None, rows[0], 1)], "vec_id long, embedding array<double>, n_links int")
    out = {r["vec_id"]: r for r in near_duplicates(df).collect()}
    assert out.pop(None)[1:] == (0, None, False)
    x = unit(np.array(rows))
    link = x @ x.T >= 0.9
    np.fill_diagonal(link, False)
    got = np.array([out[int(i)]["n_links"] for i in ids[: len(rows)]])
    assert (got <= link.sum(axis=1)).all() and got.sum() >= 0.97 * link.sum()
    assert (got[300:] == link[300:].sum(axis=1)).all()
    for i in ids[len(rows) :]:
        assert out[int(i)][1:] == (0, int(i), True)
    crowd_ids = {out[int(i)]["component_id"] for i in ids[300 : len(rows)]}
    assert crowd_ids == {int(ids[300 : len(rows)].min())}
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out.values())


def test_vectors_of_any_size_and_length(spark):
    rows = [[1e200, 1e200], [1e200, 1e200], [1e-200, 0.0], [1e-200, 0.0], [5e-324, 0.0], [3.0], [2.0], [-1.0], [1.0, 0.0, 0.0], [1.0, 0.1, 0.0], [1.0] * 20, [1.0] * 20, [1e308] * 9, [1e-308] * 9]
    out = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_duplicates(spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")).collect()}
    want = {0: (1, 0), 1: (1, 0), 2: (2, 2), 3: (2, 2), 4: (2, 2), 5: (1, 5), 6: (1, 5), 7: (0, 7), 8: (1, 8), 9: (1, 8), 10: (1, 10), 11: (1, 10), 12: (1, 12), 13: (1, 12)}
    assert out == want


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0

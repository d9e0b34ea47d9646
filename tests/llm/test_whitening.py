import numpy as np
import pytest

from isochron.llm.whitening import covariance, square_sums, whitened

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, n int, component string")


def plain(vectors, components=8):
    """Whole numbers as Python's, and numpy's covariance."""
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for v in vectors], object)
    n = len(x)
    centred = x * n - x.sum(axis=0)
    v = np.array((centred.T @ centred), object)
    v = np.array([[c / n**3 for c in row] for row in v], float)
    e, axes = np.linalg.eigh(v)
    order = np.argsort(-e)[:components]
    w = (centred.astype(float) / n) @ axes[:, order] / np.sqrt(e[order])
    return [int(s) for s in (centred * centred).sum(axis=1)], w, e[order] / e.sum()


def test_equals_plain(spark):
    rng = np.random.default_rng(1)
    good = (rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12))).astype(np.float32).tolist()
    good += good[:5]  # repeated rows
    rows = [(None if i == 4 else 7 * i, v) for i, v in enumerate(good)]
    bad = [(1, None), (2, [1.0] * 11 + [None]), (3, [float("nan")] * 12), (4, [float("inf")] * 12), (5, []), (6, [1.0] * 5)]
    got = whitened(frame(spark, rows + bad).repartition(4))
    assert got.columns == COLUMNS
    got = got.toPandas()
    deviation, w, explained = plain([v for _, v in rows])
    assert len(got) == 8 * len(rows) and set(got.n) == {len(rows)}
    assert got.identity_error.max() < 1e-9 and got.identity_error.nunique() == 1
    own = got[got.vec_id.notna()].drop_duplicates(["vec_id", "component"]).set_index(["vec_id", "component"])
    for k in range(8):
        listed = np.array([own.whitened[i, k + 1] for i, _ in rows if i is not None])
        wanted = np.array([w[p, k] for p, (i, _) in enumerate(rows) if i is not None])
        sign = np.sign((listed * wanted).sum())
        assert np.abs(sign * listed - wanted).max() < 1e-9
        assert abs(own.explained[rows[0][0], k + 1] - explained[k]) < 1e-12
    assert [own.deviation[i, 1] for i, _ in rows if i is not None] == [s for s, (i, _) in zip(deviation, rows) if i is not None]


@pytest.mark.parametrize("scale", [1, 1 << 20, 1 << 45])
def test_sums_are_exact(scale):
    rng = np.random.default_rng(2)
    x = rng.integers(-1000, 1000, (200, 5)) * scale + 100_000
    n, total = 1000, [int(s) + 12_345 * scale for s in x.astype(object).sum(axis=0)]
    y = x.astype(object) * n - np.array(total, object)
    wanted = [int((((y[:, i] + y[:, j]) if j > i else y[:, i]) ** 2).sum()) for i in range(5) for j in range(i, 5)]
    assert square_sums(x, n, total) == wanted


def test_covariance_without_rounding():
    """A shift that swallows the digits of plain doubles."""
    x = np.array([[10**15 + 1, 10**15], [10**15 - 1, 10**15 + 2], [10**15, 10**15 + 1]])
    total = [int(s) for s in x.sum(axis=0)]
    assert np.allclose(covariance(square_sums(x, 3, total), 2, 3), [[2 / 3, -2 / 3], [-2 / 3, 2 / 3]], rtol=1e-15)


def test_without_variance(spark):
    got = whitened(frame(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).collect()
    assert {(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {
        (1, 2, 0, None, 0.0, None), (2, 2, 0, None, 0.0, None),
    }
    got = whitened(frame(spark, [(1, [0.5, 0.5]), (2, [1.5, 0.5])])).collect()  # one dimension varies
    assert sorted((r.component, r.explained, r.whitened is None) for r in got) == [(1, 1.0, False)] * 2 + [(2, 0.0, True)] * 2
    assert {r.identity_error for r in got} == {0.0}


def test_huge_entries(spark):
    got = whitened(frame(spark, [(1, [3e38, 0.0]), (2, [-3e38, 0.25])])).collect()
    assert {r.deviation for r in got} == {None} and len(got) == 4
    assert [abs(r.whitened) for r in got if r.component == 1] == pytest.approx([1.0, 1.0])


def test_empty(spark):
    assert whitened(frame(spark, [])).collect() == []
    assert whitened(frame(spark, [(1, None), (2, [])])).columns == COLUMNS
    assert whitened(frame(spark, [(1, None), (2, [])])).collect() == []

import numpy as np
import pytest

from tallyrock.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, x string, i int"


@pytest.fixture(scope="module")
def vectors(spark):
    def of(rows):
        return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, "x", 2) for i, v in rows], SCHEMA)

    return of


def brute(rows):
    """The same by numpy's solver, with whole numbers as Python has them."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(256 * np.array([v for _, v in kept], np.float32).astype(float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    deviation = ((n * x.astype(object) - sums.astype(object)) ** 2).sum(axis=1)
    return kept, n, deviation, np.abs((x - sums / n) @ axes / np.sqrt(values)), values / np.trace(centred.T @ centred / n)


def check(found, rows):
    kept, n, deviation, whitened, explained = brute(rows)
    k = min(4, len(kept[0][1]))
    by_id = {(r["vec_id"], r["component"]): r for r in found}
    assert len(found) == len(kept) * k == len(by_id)
    for at, (i, _) in enumerate(kept):
        for c in range(k):
            r = by_id[i, c + 1]
            assert (r["n"], r["deviation"]) == (n, deviation[at])
            assert abs(abs(r["whitened"]) - whitened[at, c]) < 1e-8
            assert abs(r["explained"] / explained[c] - 1) < 1e-10 and r["identity_error"] < 1e-9


def test_the_query_equals_the_dense_solver(spark, small):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    found = W.op13_jacobi_davidson(spark, small).collect()
    check(found, rows)
    signs = {}
    for r in found:  # one sign for all rows of a component
        signs.setdefault(r["component"], []).append(r["whitened"])
    assert all(abs(np.mean(v)) < 1 for v in signs.values())


def test_odd_and_repeated_rows(vectors):
    draw = np.random.default_rng(3)
    rows = [(i, draw.standard_normal(3) * [9, 3, 1]) for i in range(40)]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, None), (103, [1, None, 2]), (104, [1, float("nan"), 2]), (105, [float("inf"), 1, 2])]
    check(W.whiten(vectors(rows)).collect(), rows)
    more = rows + [(106, []), (107, [1.0]), (None, rows[1][1])]
    found = W.whiten(vectors(more)).collect()
    assert len(found) == 43 * 3 and {r["vec_id"] for r in found} == {*range(40), 100, 101, None}
    assert len({r["whitened"] for r in found if r["vec_id"] in (0, 100, 101) and r["component"] == 1}) == 1


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])]])
def test_nothing_that_varies_gives_no_rows(vectors, rows):
    found = W.whiten(vectors(rows))
    assert found.count() == 0 and ", ".join(f"{n} {t.replace('bigint', 'long')}" for n, t in found.dtypes) == W.SCHEMA


def test_there_are_no_more_components_than_dimensions_that_vary(vectors):
    rows = [(i, [i, 2 * i, 5, (i * i) % 7]) for i in range(30)]
    found = W.whiten(vectors(rows)).collect()
    assert {r["component"] for r in found} == {1, 2} and len(found) == 60
    assert abs(sum(r["explained"] for r in found if r["vec_id"] == 0) - 1) < 1e-12


def test_deviations_are_exact_or_null(vectors):
    rows = [(0, [2.0**40, 1.0]), (1, [3.0, 2.0]), (2, [-(2.0**60), 4.0])]
    found = {r["vec_id"]: r["deviation"] for r in W.whiten(vectors(rows)).collect()}
    assert set(found.values()) == {None}
    x = np.array([[2**29, 3], [5, -7]], np.int64)
    exact = [sum((3 * int(v) - s) ** 2 for v, s in zip(row, (11, 2))) for row in x]
    assert W.exact_deviations(x, 3, [11, 2]) == exact
    assert W.exact_deviations(x * 2, 3, [11, 2])[0] is None  # (3 * 2 ** 30) ** 2 is no long


@pytest.mark.parametrize("spectrum", [
    np.arange(40, 0, -1.0), np.full(40, 3.0), np.r_[5, 5, 5, 5, 5, np.ones(35)], 10.0 ** -np.arange(40), 1 + np.arange(40, 0, -1) * 1e-6,
    np.r_[2.0, 1.0, np.zeros(38)],
])
def test_the_solver_on_any_spectrum(spectrum):
    q, _ = np.linalg.qr(np.random.default_rng(1).standard_normal((40, 40)))
    matrix = (q * spectrum) @ q.T
    values, vectors = W.jacobi_davidson(lambda v: matrix @ v, 40, 4)
    k = min(4, int((spectrum > 0).sum()))
    assert np.allclose(values[:k], np.sort(spectrum)[::-1][:k], rtol=1e-12, atol=1e-13)
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * spectrum.max()
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12


def test_the_subspace_is_cut_back():
    q, _ = np.linalg.qr(np.random.default_rng(2).standard_normal((300, 300)))
    spectrum = 1 + np.linspace(1, 0, 300) ** 2
    matrix = (q * spectrum) @ q.T
    widths = []

    def times(v):
        widths.append(v.shape[1])
        return matrix @ v

    values, _ = W.jacobi_davidson(times, 300, 4, most=12)
    assert np.allclose(values, spectrum[:4], rtol=1e-12) and max(widths) <= 6

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from sorterlog.llm import whitening
from tests.llm.test_operators import EXTRA

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, components=16):
    """The model and whitened values by exact integers and a dense eigensolver."""
    dims = collections.Counter(len(v) for _, v in rows).most_common(1)[0][0]
    rows = [(i, v) for i, v in rows if len(v) == dims]
    whole = {i: tuple(int(np.floor(np.float64(np.float32(c)) * 64)) + 1_000_000 for c in v) for i, v in rows}
    fit = np.array(sorted(set(whole.values())), object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = ((fit * n - sums) / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = {}
    for i, x in whole.items():
        d = np.array(x, object) * n - sums
        out[i] = (n, int((d * d).sum()), (d / n).astype(float) @ vectors / np.sqrt(values), values / (centred**2).sum() * n)
    return out


def vectors(n=300, dims=40, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims)) * 2
    rows = [(i, (centres[i % 6] + rng.normal(size=dims) * np.linspace(1, 0.2, dims)).astype(np.float32).tolist()) for i in range(n)]
    return rows + [(1000 + i, rows[3][1]) for i in range(50)]


def test_equals_a_dense_eigensolver(spark):
    rows = vectors()
    df = spark.createDataFrame([*rows, (5000, None), (5001, [None] * 40), (5002, [float("nan")] * 40), (5003, [float("inf")] + [0.0] * 39), (5004, [1.0]), (5005, []), (None, rows[0][1]), (5006, [0.0] * 40)], SCHEMA)
    for name in EXTRA:
        df = df.withColumn(name, F.lit("x"))
    want = plain([*rows, (None, rows[0][1]), (5006, [0.0] * 40)])
    got = collections.defaultdict(dict)
    for r in whitening.transform(df, whitening.fit(df)).collect():
        got[r["vec_id"]][r["component"]] = r
    assert got.keys() == want.keys()
    signs = None
    for i, (n, deviation, values, share) in want.items():
        assert sorted(got[i]) == list(range(1, 17))
        assert {(r["n"], r["deviation"]) for r in got[i].values()} == {(n, deviation)}
        found = np.array([got[i][c]["whitened"] for c in range(1, 17)])
        if signs is None:
            signs = np.sign(found * values)
        assert np.allclose(found * signs, values, atol=1e-8, rtol=1e-8)
        assert np.allclose([got[i][c]["explained"] for c in range(1, 17)], share, rtol=1e-9)
        assert {r["identity_error"] for r in got[i].values()} == {got[i][1]["identity_error"]} and got[i][1]["identity_error"] < 1e-9


@pytest.mark.parametrize("gap", [0.5, 0.05])
def test_filter_certifies_pairs_of_slowly_falling_spectra(gap):
    rng, dims = np.random.default_rng(5), 300
    basis = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
    spectrum = np.concatenate((np.linspace(10, 1 + gap, 16), np.linspace(1, 0.1, dims - 16)))
    v, passes = (basis * spectrum) @ basis.T, []
    values, found = whitening.eigenpairs(lambda q: passes.append(1) or v @ q, dims, 16)
    assert np.allclose(values, spectrum[:16], rtol=1e-12)
    assert np.abs(np.abs((basis[:, :16] * found).sum(axis=0)) - 1).max() < 1e-12
    assert np.linalg.norm(v @ found - found * values, axis=0).max() < 1e-11
    assert len(passes) < 400


def test_few_or_equal_vectors(spark):
    few = spark.createDataFrame([(i, [float(i), 0.0, 1.0]) for i in range(5)] * 2, SCHEMA)
    got = whitening.transform(few, whitening.fit(few)).collect()
    assert len(got) == 10 and {(r["component"], r["n"]) for r in got} == {(1, 5)}
    for rows in ([], [(1, None)], [(1, [2.0, 3.0])] * 3):
        df = spark.createDataFrame(rows, SCHEMA)
        assert whitening.transform(df, whitening.fit(df)).count() == 0


def test_sums_beyond_64_bits_stay_exact(spark):
    df = spark.createDataFrame([(i, [7e15 * (i + 1), float(i)]) for i in range(5)] + [(9, [1e17, 0.0])], "vec_id long, embedding array<double>")
    model = whitening.fit(df)
    assert (model.n, model.sums) == (5, (64 * 7 * 15 * 10**15 + 5_000_000, 64 * 10 + 5_000_000))
    assert {r["vec_id"]: r["deviation"] for r in whitening.transform(df, model).collect()} == {0: None, 1: None, 2: 0, 3: None, 4: None}


def test_result_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame(vectors(120), SCHEMA)
    one, many = (whitening.fit(d) for d in (df.coalesce(1), df.repartition(40)))
    assert one.sums == many.sums and np.allclose(one.vectors, many.vectors, atol=1e-9)

"""Queries on planted tables that go beyond the given ones."""

import re

import numpy as np

from spotloom.operators import estimators as est
from spotloom.plans import estimates, spots, tables


def test_cells_of_all_tile_columns_are_counted(spark, tmp_path):
    places = [(1, 10.0, 10.0), (1, 10.0, 14399.0), (1, 10.0, 14400.0), (1, 2000.0, 133389.0), (2, 10.0, 14500.0), (2, 20.0, 14600.0)]
    spark.createDataFrame(places, "roi int, y double, x double").write.parquet(str(tmp_path / "cells.parquet"))
    got = {(r["roi"], r["ty"], r["tx"]): r["n"] for r in tables.cells_per_tile(spark, str(tmp_path)).collect()}
    assert got == {(1, 0, 0): 1, (1, 0, 7): 1, (1, 0, 8): 1, (1, 1, 74): 1, (2, 0, 8): 2}


def test_every_roi_has_a_column_or_counts_as_other(spark, tmp_path):
    rows = [(i, roi, 0, 0, "a") for i, roi in enumerate([1, 1, 10, 11, 12, 12, None])]
    spark.createDataFrame(rows, "spot_id bigint, roi int, tx int, ty int, gene string").write.parquet(str(tmp_path / "gene_spots.parquet"))
    (r,) = spots.count_pivot(spark, str(tmp_path)).collect()
    assert (r["roi_1"], r["roi_2"], r["roi_10"], r["roi_other"]) == (2, 0, 1, 3)


def test_exact_median_equals_sorting(spark):
    for n, spread in ((0, 1), (1, 1), (2, 10), (30_001, 10**9), (30_000, 7), (30_000, 2), (20_000, 10**9)):
        v = np.random.default_rng(n + spread).integers(0, spread, n).astype(float)
        df = spark.createDataFrame([(float(x), "x") for x in v] + [(None, "x"), (float("nan"), "y")], "m double, v string")
        assert est.exact_median(df, "m", few=500) == (np.median(v) if n else None)


def test_many_pursuits_equal_single_ones():
    rng = np.random.default_rng(12)
    genes = rng.random((20, 28)) * (rng.random((20, 28)) < 0.4)
    genes /= np.linalg.norm(genes, axis=1, keepdims=True)
    genes[7] = genes[3]  # two genes alike: singular equations
    background = est.background_vectors(7, 4)
    y = rng.random((60, 20)) * (rng.random((60, 20)) < 0.15) @ genes + 0.02 * rng.random((60, 28))
    y[5] = 0
    for options in ({}, {"alpha": 0.0, "tol": 0.05}, {"refit": False, "tol": 0.1}, {"most": 5, "shift": 0.3}):
        want = np.array([est.pursue(v, genes, background, **options)[0] for v in y])
        assert np.allclose(est.pursue_many(y, genes, background, **options), want, atol=1e-6)
    assert est.pursue_many(y[:0], genes, background).shape == (0, 20)


def test_the_mixture_is_fitted_on_all_cells(spark, tmp_path):
    rng = np.random.default_rng(4)
    kind = rng.choice(3, 9000, p=[0.3, 0.5, 0.2])
    area = np.exp(rng.normal(np.array([4.0, 5.5, 6.5])[kind], 0.45)).astype(int)
    width = 10 + rng.integers(0, 10, 9000) + 6 * kind
    rows = [(1, i, int(a), 0, 0, 20, int(b)) for i, (a, b) in enumerate(zip(area, width, strict=True))]
    spark.createDataFrame(rows, "roi int, label int, area bigint, ymin int, xmin int, ymax int, xmax int").repartition(5).write.parquet(str(tmp_path / "cells.parquet"))
    x = np.c_[np.log(area + 1.0), width / 20]
    w, mu, cov, _ = est.gaussian_mixture(x, np.quantile(x, [0.1, 0.5, 0.9], axis=0))
    want = np.bincount(est.log_likelihoods(x, w, mu, cov)[1].argmax(1), minlength=3)
    got = {r["component"]: r["n"] for r in estimates.gmm_cells(spark, str(tmp_path)).collect()}
    assert got == dict(enumerate(want.tolist()))


def test_all_genes_are_in_natural_order(spark, small):
    got = [r["gene"] for r in tables.natural_order(spark, small).collect()]
    assert len(got) == 104 and len(set(got)) == 104

    def key(gene):
        number = re.search(r"\d+", gene)
        return int(number[0]) if number else -1, gene

    assert got == sorted(got, key=key)


def test_dense_pixels_stay_in_the_cdf(spark, tmp_path):
    spots = [(1, 50.0, 50.0)] * 30 + [(1, 150.0 + 100 * k, 50.0) for k in range(3)] + [(2, 50.0, 50.0)]
    rows = [(i, "a", roi, x, y) for i, (roi, x, y) in enumerate(spots)]
    spark.createDataFrame(rows, "spot_id bigint, gene string, roi int, x double, y double").write.parquet(str(tmp_path / "gene_spots.parquet"))
    got = {(r["roi"], r["v"]): r["difference"] for r in tables.cdf_difference(spark, str(tmp_path)).collect()}
    cdf = {1: lambda v: (3 * (v >= 1) + (v >= 30)) / 4, 2: lambda v: (v >= 1) / 1}
    every = lambda v: (4 * (v >= 1) + (v >= 30)) / 5
    assert got == {(roi, v): round(cdf[roi](v) - every(v), 5) for roi in (1, 2) for v in range(31)}

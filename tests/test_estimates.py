"""Queries without SQL against plain computations on the same tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotloom.operators import estimators as est
from spotloom.plans import estimates
from spotloom.sources.tables import barcode_spots, codebook, table


@pytest.fixture(scope="module")
def traces(spark, small):
    rows = barcode_spots(spark, small).where("spot_id is not null and trace is not null").select("spot_id", "trace", "sequence").collect()
    return {r["spot_id"]: (np.array(r["trace"], float), r["sequence"]) for r in rows}


def _centroids(traces, rounds):
    cube = np.zeros((rounds, 4, 4))
    for r in range(rounds):
        for b in range(4):
            t = [x[r] for x, s in traces.values() if s is not None and s[r] == b and np.isfinite(x[r]).all() and x[r].any()]
            if t:
                cube[r, b] = np.mean(t, 0)
    return cube


def test_omp_decode(spark, small, traces):
    cube = _centroids(traces, 7)
    book = codebook(spark, small).where("gene is not null and length(seq) = 7").orderBy("ord").collect()
    genes = est.gene_templates(cube, [b["seq"] for b in book])
    found = {}
    for x, s in traces.values():
        y = x[:7].ravel()
        if s is not None and np.isfinite(y).all() and np.abs(y).mean() > 0:
            c = est.pursue(y, genes, est.background_vectors(7, 4), tol=0.35, most=6)[0]
            for g in np.flatnonzero(c):
                found.setdefault(book[g]["gene"], []).append(c[g])
    got = {r["gene"]: (r["n"], r["mean_coefficient"]) for r in estimates.omp_decode(spark, small).collect()}
    assert {g: n for g, (n, _) in got.items()} == {g: len(v) for g, v in found.items()}
    assert all(abs(got[g][1] - np.mean(v)) < 1e-4 for g, v in found.items())


def test_embedding_pca(spark, small):
    x = np.array([r[0] for r in table(spark, small, "embeddings").select("embedding").collect()], float)
    want = np.linalg.svd(x - x.mean(0), compute_uv=False)[:5] ** 2 / len(x)
    got = [r["variance"] for r in estimates.embedding_pca(spark, small).orderBy("component").collect()]
    assert np.allclose(got, want, atol=1e-6)


def test_scaled_kmeans(spark, small, traces):
    x = np.array([t[0] for t, _ in traces.values() if np.isfinite(t).all() and t[0].any()])
    c = np.eye(4)
    for _ in range(100):
        to = (x @ c.T).argmax(1)
        new = np.array([np.linalg.svd(x[to == k], full_matrices=False)[2][0] for k in range(4)])
        new *= np.sign(new.mean(1, keepdims=True))
        done, c = np.allclose(new, c, atol=1e-9), new
        if done:
            break
    got = estimates.scaled_kmeans(spark, small).orderBy("base").collect()
    assert [r["n"] for r in got] == np.bincount(to, minlength=4).tolist()
    assert np.allclose([[r[f"c{k}"] for k in range(4)] for r in got], c, atol=2e-4)


def test_ransac_plane(spark, small):
    """Fitted values lie on one plane per roi, and the plane explains most of the trusted shifts."""
    raw = {(r["roi"], r["tx"], r["ty"]): r["right_y"] for r in table(spark, small, "tile_shifts").where("right_y is not null and not isnan(right_y)").collect()}
    by = {}
    for r in estimates.ransac_plane(spark, small).collect():
        by.setdefault(r["roi"], []).append((r["tx"], r["ty"], r["fitted"], raw.pop((r["roi"], r["tx"], r["ty"]))))
    assert not raw
    for rows in by.values():
        t = np.array(rows, float)
        a = np.c_[t[:, :2], np.ones(len(t))]
        near = np.abs(t[:, 3] - np.median(t[:, 3])) < 100
        if near.sum() < 8:
            assert np.allclose(t[:, 2], np.median(t[:, 3]), atol=1e-4)
        else:
            assert np.abs(a @ np.linalg.lstsq(a, t[:, 2], rcond=None)[0] - t[:, 2]).max() < 1e-3
            assert (np.abs(t[near, 2] - t[near, 3]) < 3).mean() >= 0.5


def test_log_linear_fit_of_planted_levels(spark):
    df = spark.createDataFrame([(c, r, float(np.exp(1.0 + c - 0.1 * r))) for c in range(4) for r in range(9)] + [(0, 1, 0.0), (1, 2, None)], "c int, round int, v double")
    assert np.allclose(est.log_linear_factors(df, "c", "round", "v", 4), [-0.1, 1, 2, 3, 4])


def test_mixture_query_covers_all_cells(spark, small):
    n = table(spark, small, "cells").where("xmax <> xmin and ymax <> ymin").count()
    assert estimates.gmm_cells(spark, small).agg(F.sum("n")).collect()[0][0] == n

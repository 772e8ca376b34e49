"""Estimators: regressions, robust planes, spherical k-means, mixtures, sparse pursuit decoding.

What is a sum over rows is aggregated by Spark and only matrices of fixed size reach the driver; what is sequential
within one small group (tiles of a roi, one pixel's pursuit) runs in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moments(df: DataFrame, xs: list[Column], y: Column) -> tuple[np.ndarray, np.ndarray]:
    """X'X and X'y over all rows, in one aggregation; rows with a null are left out."""
    named = df.select(*(x.cast("double").alias(f"x{i}") for i, x in enumerate(xs)), y.cast("double").alias("y")).dropna()
    n = len(xs)
    cells = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"a{i}_{j}") for i in range(n) for j in range(i, n)] + [F.sum(F.col(f"x{i}") * F.col("y")).alias(f"b{i}") for i in range(n)]
    (r,) = named.agg(*cells).collect()
    a, b = np.zeros((n, n)), np.array([r[f"b{i}"] or 0.0 for i in range(n)])
    for i in range(n):
        for j in range(i, n):
            a[i, j] = a[j, i] = r[f"a{i}_{j}"] or 0.0
    return a, b


def least_squares(df: DataFrame, xs: list[Column], y: Column) -> np.ndarray:
    """Coefficients of y on xs (no intercept unless one of them is a constant); the shortest solution if they are collinear."""
    return np.linalg.lstsq(*moments(df, xs, y), rcond=None)[0]


def log_linear_factors(df: DataFrame, channel: str, round_: str, value: str, channels: int) -> np.ndarray:
    """Slope over rounds and one level per channel of ln(value): smooth normalisation factors."""
    xs = [F.col(round_)] + [F.when(F.col(channel) == c, 1.0).otherwise(0.0) for c in range(channels)]
    return least_squares(df.where(F.col(value) > 0), xs, F.ln(value))


def unmixing(df: DataFrame, keys: list[str], signal: Column, background: Column) -> DataFrame:
    """keys, slope, intercept of signal on background; a negative slope becomes 0 and the intercept the mean signal."""
    g = df.select(*keys, signal.alias("_s"), background.alias("_b")).dropna(subset=["_s", "_b"]).groupBy(*keys)
    r = g.agg(F.regr_slope("_s", "_b").alias("_k"), F.regr_intercept("_s", "_b").alias("_i"), F.avg("_s").alias("_m"))
    return r.select(*keys, F.greatest("_k", F.lit(0.0)).alias("slope"), F.when(F.col("_k") < 0, F.col("_m")).otherwise(F.col("_i")).alias("intercept"))


def unmixed(signal: Column, background: Column, slope: Column, intercept: Column, factor: float = 1.0, offset: float = 10.0) -> Column:
    """Signal without its background part, not below 0."""
    return F.greatest(F.lit(0.0), signal - slope * background * factor - intercept * factor + offset)


def order_statistic(rows: DataFrame, k: int, few: int = 50_000, sketch: int = 4096) -> float:
    """The k-th smallest (from 0) of the column v, which holds neither null nor NaN: a quantile sketch narrows the open range that holds
    it to a few hundredths per pass, until at most `few` values lie in it; only these reach the driver."""
    lo, hi, steps = float("-inf"), float("inf"), 128
    v = F.col("v")
    while True:
        inside = (v > lo) & (v < hi)
        q = F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(F.when(inside, v), F.lit(sketch)), F.array(*(F.lit(i / steps) for i in range(steps + 1))))
        (r,) = rows.agg(F.count_if(v <= lo).alias("below"), F.count_if(inside).alias("held"), F.when(F.count_if(inside) > 0, q).alias("q")).collect()
        if not r["below"] <= k < r["below"] + r["held"]:
            return lo if k < r["below"] else hi
        if r["held"] <= few:
            return float(np.sort([x["v"] for x in rows.where(inside).collect()])[k - r["below"]])
        at = (k - r["below"]) / r["held"] * steps
        a, z = r["q"][max(0, int(at) - 2)], r["q"][min(steps, int(at) + 3)]
        (c,) = rows.agg(*(F.count_if(t).alias(n) for n, t in (("lt_a", v < a), ("le_a", v <= a), ("lt_z", v < z), ("le_z", v <= z)))).collect()
        if c["lt_a"] <= k < c["le_a"]:
            return a
        if c["lt_z"] <= k < c["le_z"]:
            return z
        lo, hi = (lo, a) if k < c["lt_a"] else (z, hi) if k >= c["le_z"] else (a, z)  # either way an end is left out, so this ends


def exact_median(df: DataFrame, value: str, few: int = 50_000) -> float | None:
    """The median of a column over all rows (mean of the middle two), without gathering its values in one task. Null and NaN are no
    values; a column without values gives None."""
    v = F.col(value).cast("double")
    rows = df.select(v.alias("v")).where(v.isNotNull() & ~F.isnan(v))
    n = rows.count()
    if not n:
        return None
    low = order_statistic(rows, (n - 1) // 2, few)
    if n % 2:
        return low
    (r,) = rows.agg(F.count_if(F.col("v") <= low).alias("upto"), F.min(F.when(F.col("v") > low, F.col("v"))).alias("next")).collect()
    return (low + (low if r["upto"] > n // 2 else r["next"])) / 2


def filtered_pixels(df: DataFrame, signal: str, background: str, top: float = 4090.0, ratio: float = 20.0) -> DataFrame:
    """Pixels fit for unmixing: unsaturated and positive, then background above its median, then signal above the
    median of what is left and below `ratio` times the background. The two medians follow one another."""
    s, b = F.col(signal), F.col(background)
    d = df.where((s > 0) & (s < top) & (b > 0) & (b < top))
    d = d.where(b > F.lit(exact_median(d, background)))
    d = d.where(s > F.lit(exact_median(d, signal)))
    return d.where(s < ratio * b)


def plane_by_consensus(y: np.ndarray, x: np.ndarray, v: np.ndarray, seed: int = 0, tries: int = 200, within: float = 3.0) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (y, x, 1) and inliers of a plane through v, fitted to the largest consensus of random triples."""
    a = np.c_[y, x, np.ones(len(v))]
    rng, best = np.random.default_rng(seed), np.zeros(len(v), bool)
    for _ in range(tries if len(v) > 3 else 0):
        pick = rng.choice(len(v), 3, replace=False)
        c = np.linalg.lstsq(a[pick], v[pick], rcond=None)[0]
        good = np.abs(a @ c - v) < within
        if good.sum() > best.sum():
            best = good
    if best.sum() <= 3:
        return np.full(3, np.nan), best
    return np.linalg.lstsq(a[best], v[best], rcond=None)[0], best


def fitted_shifts(shifts: DataFrame, keys: list[str], value: str, most: float, least_tiles: int = 8) -> DataFrame:
    """keys, tx, ty, raw, fitted: a shift as a plane over the tiles of each group, fitted by consensus.

    Values farther than `most` from the group's median take no part; groups of fewer tiles than least_tiles get their
    median. A group is the tiles of one roi, channel and round, which is small whatever the number of spots.
    """
    head = ", ".join(f"`{k}` {shifts.schema[k].dataType.simpleString()}" for k in keys)

    def fit(g: pd.DataFrame) -> pd.DataFrame:
        v = g["v"].to_numpy(float)
        known = np.isfinite(v)
        mid = np.median(v[known]) if known.any() else np.nan
        near = known & (np.abs(v - mid) < most)
        if near.sum() < least_tiles:
            fitted = np.full(len(v), mid)
        else:
            t = g[["ty", "tx"]].to_numpy(float)
            c, _ = plane_by_consensus(t[near, 0], t[near, 1], v[near])
            fitted = np.c_[t, np.ones(len(v))] @ c
        return g[[*keys, "tx", "ty"]].assign(raw=v, fitted=fitted)

    return shifts.select(*keys, "tx", "ty", F.col(value).alias("v")).groupBy(*keys).applyInPandas(fit, f"{head}, tx int, ty int, raw double, fitted double")


def spherical_kmeans(df: DataFrame, vector: str, start: np.ndarray, least_score: float = 0.0, least_members: int = 10, rounds: int = 100) -> tuple[np.ndarray, list[int]]:
    """Unit centroids by direction: rows go to the centroid of largest cosine (to none below least_score), a centroid becomes the
    leading eigenvector of its members' second moments with positive mean, or 0 with fewer than least_members of them.

    Per round one aggregation of k matrices of d x d; stops when the counts and moments stay the same.
    """
    d, c = start.shape[1], start / np.linalg.norm(start, axis=1, keepdims=True)
    v = [F.col(vector)[i].cast("double") for i in range(d)]
    counts: list[int] = []
    for _ in range(rounds):
        size = F.sqrt(sum((x * x for x in v), F.lit(0.0)))
        scores = F.array(*(F.try_divide(sum((v[i] * float(row[i]) for i in range(d)), F.lit(0.0)), size) for row in c))
        a = df.select(*(x.alias(f"v{i}") for i, x in enumerate(v)), scores.alias("s"))
        a = a.where(F.array_max("s") >= least_score).withColumn("k", F.array_position("s", F.array_max("s")) - 1)
        cells = [F.sum(F.col(f"v{i}") * F.col(f"v{j}")).alias(f"m{i}_{j}") for i in range(d) for j in range(i, d)]
        new, n = np.zeros_like(c), [0] * len(c)
        for r in a.groupBy("k").agg(F.count(F.lit(1)).alias("n"), *cells).collect():
            n[r["k"]] = r["n"]
            if r["n"] >= least_members:
                m = np.zeros((d, d))
                for i in range(d):
                    for j in range(i, d):
                        m[i, j] = m[j, i] = r[f"m{i}_{j}"]
                e = np.linalg.eigh(m / r["n"])[1][:, -1]
                new[r["k"]] = e * (np.sign(e.mean()) or 1.0)
        if n == counts and np.allclose(new, c, atol=1e-9):
            break
        counts, c = n, new
    return c, counts


def log_likelihoods(x: np.ndarray, w: np.ndarray, mu: np.ndarray, cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihood of each row under a mixture, and the responsibilities of its components."""
    logp = np.empty((len(x), len(w)))
    for i in range(len(w)):
        low = np.linalg.cholesky(cov[i])
        z = np.linalg.solve(low, (x - mu[i]).T)
        logp[:, i] = np.log(w[i] + 1e-300) - (z * z).sum(0) / 2 - np.log(np.diag(low)).sum() - x.shape[1] / 2 * np.log(2 * np.pi)
    top = logp.max(1, keepdims=True)
    like = top[:, 0] + np.log(np.exp(logp - top).sum(1))
    return like, np.exp(logp - like[:, None])


def gaussian_mixture(x: np.ndarray, means: np.ndarray, rounds: int = 200, tol: float = 1e-6) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """EM from given means: weights, means, covariances and responsibilities (full covariances, ridge 1e-6)."""
    k, d = means.shape
    w, mu = np.full(k, 1 / k), means.astype(float).copy()
    cov = np.stack([np.cov(x.T).reshape(d, d) + 1e-6 * np.eye(d)] * k)
    last, resp = -np.inf, np.zeros((len(x), k))
    for _ in range(rounds):
        like, resp = log_likelihoods(x, w, mu, cov)
        n = resp.sum(0) + 1e-12
        w, mu = n / n.sum(), resp.T @ x / n[:, None]
        for i in range(k):
            z = x - mu[i]
            cov[i] = (resp[:, i, None] * z).T @ z / n[i] + 1e-6 * np.eye(d)
        if like.mean() - last < tol:
            break
        last = like.mean()
    return w, mu, cov, resp


def mixture_of_rows(df: DataFrame, vector: str, means: np.ndarray, rounds: int = 200, tol: float = 1e-6) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """gaussian_mixture over all rows of a vector column, without the responsibilities. Per round each task sums weighted moments
    around the means of the round before, and the entries are added by Spark."""
    k, d = means.shape
    n, _, whole = second_moments(df, vector, d)
    w, mu = np.full(k, 1 / k), means.astype(float).copy()
    cov = np.stack([whole * n / max(n - 1, 1) + 1e-6 * np.eye(d)] * k)
    last = -np.inf

    def sums(w: np.ndarray, mu: np.ndarray, cov: np.ndarray):
        def of(x: np.ndarray) -> np.ndarray:
            like, resp = log_likelihoods(x, w, mu, cov)
            z = x[:, None] - mu
            return np.r_[len(x), like.sum(), resp.sum(0), np.einsum("nk,nki->ki", resp, z).ravel(), np.einsum("nk,nki,nkj->kij", resp, z, z).ravel()]

        return of

    for _ in range(rounds):
        every = _summed(df, vector, d, sums(w, mu, cov), 2 + k * (1 + d + d * d))
        like, n = every[1] / max(every[0], 1), every[2 : 2 + k] + 1e-12
        step = every[2 + k : 2 + k + k * d].reshape(k, d) / n[:, None]
        square = every[2 + k + k * d :].reshape(k, d, d) / n[:, None, None]
        w, mu = n / n.sum(), mu + step
        cov = square - step[:, :, None] * step[:, None] + 1e-6 * np.eye(d)
        if like - last < tol:
            break
        last = like
    return w, mu, cov


def gene_templates(centroids: np.ndarray, codes: list[str]) -> np.ndarray:
    """Unit vectors: the centroid (rounds x 4 bases x channels) of each letter of a code, one after another."""
    rows = [np.concatenate([centroids[r, "GTAC".index(b)] for r, b in enumerate(code)]) for code in codes]
    t = np.array(rows).reshape(len(codes), -1)
    return t / np.linalg.norm(t, axis=1, keepdims=True)


def background_vectors(rounds: int, channels: int) -> np.ndarray:
    """One unit vector per channel: equal in all rounds."""
    return np.tile(np.eye(channels), (1, rounds)) / np.sqrt(rounds)


def pursue(y: np.ndarray, genes: np.ndarray, background: np.ndarray, *, tol: float = 0.2, alpha: float = 200.0, beta2: float = 1.0, shift: float = 0.0, most: int = 12, refit: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coefficients of genes and background and the residual of one pixel, by weighted orthogonal matching pursuit.

    The scaled pixel y / (|y| + shift) first loses its background. Then the gene of largest weighted product with
    the residual joins until that product falls below tol or `most` components (background included) are chosen. Weights fall with
    the variance that the chosen components explain: 1 / (beta2 + alpha sum x^2 c^2), scaled to mean 1.
    """
    size = np.linalg.norm(y)
    if not size:
        return np.zeros(len(genes)), np.zeros(len(background)), np.zeros_like(y)
    y = y / (size + shift)
    every = np.vstack([background, genes])
    b = len(background)
    chosen = list(range(b))
    coef = np.linalg.lstsq(background.T, y, rcond=None)[0] if b else np.zeros(0)
    base = np.zeros_like(y) if refit else coef @ background
    fixed, picked = coef.copy(), coef
    rest = y - coef @ background
    while len(chosen) < most and len(chosen) < len(every):
        w2 = 1 / (beta2 + alpha * (every[chosen] ** 2 * picked[:, None] ** 2).sum(0))
        w2 /= w2.mean()
        score = np.abs(every @ (rest * w2))
        score[chosen] = -1
        best = int(score.argmax())
        if score[best] < tol:
            break
        chosen.append(best)
        w = np.sqrt(w2)
        use = chosen if refit else chosen[b:]
        fit = np.linalg.lstsq((every[use] * w).T, (y - base) * w, rcond=None)[0]
        picked = fit if refit else np.r_[fixed, fit]
        rest = y - base - fit @ every[use]
    out = np.zeros(len(every))
    out[chosen] = picked
    return out[b:], out[:b], rest


def pursue_many(y: np.ndarray, genes: np.ndarray, background: np.ndarray, *, tol: float = 0.2, alpha: float = 200.0, beta2: float = 1.0, shift: float = 0.0, most: int = 12, refit: bool = True) -> np.ndarray:
    """Gene coefficients of `pursue` for many pixels at once (pixels x genes): all pixels that still go on have chosen the same number of
    components, so each step is one stack of normal equations. Where these are singular, the pixel is solved by itself."""
    size = np.linalg.norm(y, axis=1)
    out = np.zeros((len(y), len(genes)))
    on = np.flatnonzero(size)
    y = y[on] / (size[on, None] + shift)
    every, b = np.vstack([background, genes]), len(background)
    coef = y @ np.linalg.pinv(background) if b else np.zeros((len(on), 0))
    base = np.zeros_like(y) if refit else coef @ background
    chosen, picked, rest = np.tile(np.arange(b), (len(on), 1)), coef, y - coef @ background
    while len(on) and chosen.shape[1] < min(most, len(every)):
        w2 = 1 / (beta2 + alpha * np.einsum("nkd,nk->nd", every[chosen] ** 2, picked**2))
        w2 /= w2.mean(1, keepdims=True)
        score = np.abs((rest * w2) @ every.T)
        np.put_along_axis(score, chosen, -1, 1)
        best = score.argmax(1)
        go = score[np.arange(len(on)), best] >= tol
        at = np.flatnonzero(~go)
        if len(at) and chosen.shape[1] > b:
            out[on[at, None], chosen[at, b:] - b] = picked[at, b:]
        on, y, base, coef, w2 = on[go], y[go], base[go], coef[go], w2[go]
        chosen = np.c_[chosen[go], best[go]]
        use = every[chosen if refit else chosen[:, b:]]
        weighted = use * w2[:, None]
        left, right = weighted @ use.transpose(0, 2, 1), np.einsum("nkd,nd->nk", weighted, y - base)
        fit = np.empty_like(right)
        firm = np.linalg.cond(left) < 1e10 if len(on) else np.zeros(0, bool)
        fit[firm] = np.linalg.solve(left[firm], right[firm][..., None])[..., 0]
        for i in np.flatnonzero(~firm):
            w = np.sqrt(w2[i])
            fit[i] = np.linalg.lstsq((use[i] * w).T, (y[i] - base[i]) * w, rcond=None)[0]
        picked = fit if refit else np.c_[coef, fit]
        rest = y - base - np.einsum("nk,nkd->nd", fit, use)
    if len(on) and chosen.shape[1] > b:
        out[on[:, None], chosen[:, b:] - b] = picked[:, b:]
    return out


def decode_pixels(df: DataFrame, keys: list[str], vector: str, names: list[str], genes: np.ndarray, background: np.ndarray | None, least_intensity: float = 0.0, at_once: int = 2048, many: Callable[..., np.ndarray] = pursue_many, **options) -> DataFrame:
    """keys, gene, coefficient for the non-zero coefficients of each pixel; dim pixels (mean |v| not above
    least_intensity), and null, short or NaN vectors give no row. The dictionary has the size of the codebook and goes with the tasks;
    `many` decodes at_once pixels together."""
    head = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    n, dims, titles = len(keys), genes.shape[1], np.array(names, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, at_once):
                b = whole.slice(first, at_once)
                v = b.column(n)
                right = np.flatnonzero(np.asarray(pc.fill_null(pc.list_value_length(v), -1)) == dims)
                y = np.asarray(v.take(pa.array(right)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), float).reshape(-1, dims)
                good = np.isfinite(y).all(1) & (np.abs(y).mean(1) > least_intensity) if len(y) else np.zeros(0, bool)
                c = many(y[good], genes, background, **options)
                row, gene = np.nonzero(c)
                at = pa.array(right[good][row])
                yield pa.RecordBatch.from_arrays([*(b.column(i).take(at) for i in range(n)), pa.array(titles[gene].tolist(), pa.string()), pa.array(c[row, gene])], names=[*keys, "gene", "coefficient"])

    return df.select(*keys, vector).mapInArrow(run, f"{head}, gene string, coefficient double")


def _summed(df: DataFrame, vector: str, dims: int, sums: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """What sums gives for the rows of a vector column, added over all batches: each task adds its own, and the entries are added by
    Spark. Vectors that are null, of another length or not finite are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = np.zeros(size)
        for b in batches:
            x = np.array([v for v in b.column(0).to_pylist() if v is not None and len(v) == dims and None not in v], float).reshape(-1, dims)
            every += sums(x[np.isfinite(x).all(1)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(every)], names=["cell", "v"])

    cells = df.select(vector).mapInArrow(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v"))
    every = np.zeros(size)
    for r in cells.collect():
        every[r["cell"]] = r["v"]
    return every


def second_moments(df: DataFrame, vector: str, dims: int) -> tuple[int, np.ndarray, np.ndarray]:
    """n, mean and covariance of a vector column, over its whole and finite vectors."""
    every = _summed(df, vector, dims, lambda x: np.r_[len(x), x.sum(0), (x.T @ x).ravel()], 1 + dims + dims * dims)
    n = int(every[0])
    mean = every[1 : dims + 1] / max(n, 1)
    return n, mean, every[dims + 1 :].reshape(dims, dims) / max(n, 1) - np.outer(mean, mean)


def principal_components(df: DataFrame, vector: str, dims: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k leading directions and their variances."""
    values, vectors = np.linalg.eigh(second_moments(df, vector, dims)[2])
    lead = vectors[:, ::-1][:, :k].T
    return lead * np.where(lead.sum(1, keepdims=True) < 0, -1, 1), values[::-1][:k]

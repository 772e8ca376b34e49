"""Registration, correction and decoding of whole acquisitions, composed of plane kernels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotloom.operators import kernels
from spotloom.operators.estimators import gaussian_mixture

TILE = ["roi", "tx", "ty"]


def adjacent_shifts(planes: DataFrame, strip: int, most: int, overlap: float = 0.3) -> DataFrame:
    """roi, tx, ty, side, shift_y, shift_x, corr: for each tile with a right or lower neighbour the shift that moves the neighbour onto it,
    from the masked correlation of the strips of `strip` pixels in which both overlap. planes: roi, tx, ty, h, w, v."""
    full = lambda a: np.ones(a.shape, bool)
    out = None
    for side, step, cut in (("right", "tx", lambda a, b: (a[:, -strip:], b[:, :strip])), ("down", "ty", lambda a, b: (a[-strip:], b[:strip]))):

        def shift(a: np.ndarray, b: np.ndarray, cut=cut) -> dict[str, float]:
            a, b = cut(a, b)
            return kernels.masked_shift(a, b, full(a), full(b), most, overlap)

        pairs = kernels.pair_planes(planes, planes.withColumn(step, F.col(step) - 1), TILE, shift, ["shift_y", "shift_x", "corr"]).withColumn("side", F.lit(side))
        out = pairs if out is None else out.unionByName(pairs)
    return out.select(*TILE, "side", "shift_y", "shift_x", "corr")


def round_shifts(stack: np.ndarray, reference: int = 0, most: float | None = None, median: bool = False) -> np.ndarray:
    """(y, x) that moves each round of a channel (rounds x h x w) onto the reference round; optionally after a 3 x 3 median."""
    if median:
        pad = np.pad(stack, ((0, 0), (1, 1), (1, 1)), mode="edge")
        stack = np.median(np.lib.stride_tricks.sliding_window_view(pad, (3, 3), (1, 2)), (3, 4))
    s = [kernels.phase_shift(stack[reference], r, most) for r in stack]
    return np.array([(x["shift_y"], x["shift_x"]) for x in s])


def moved(im: np.ndarray, shift: np.ndarray, outside: float = 0.0) -> np.ndarray:
    """The plane moved by whole pixels; what comes in from beyond the border is `outside`."""
    y, x = (int(v) for v in np.rint(shift))
    return kernels.warp(im, np.array([[1, 0, -x], [0, 1, -y], [0, 0, 1.0]]), 0, outside)


def register_rounds_and_channels(stack: np.ndarray, ref_channel: int = 0, ref_round: int = 0, most: float | None = None, align: str = "shift", block: int = 32, least_corr: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Shifts (channels x rounds x 2) of the rounds inside each channel, and matrices (channels x 3 x 3, output to input) of the channels.

    First the rounds of each channel are moved onto its reference round; then the standard deviation over the aligned rounds of each channel
    is registered to that of the reference channel: by a shift, by an angle and a shift ("similar"), or by the affine map that fits
    the shifts of blocks ("affine"; NaN where it is implausible). stack: rounds x channels x h x w.
    """
    rounds, channels, h, w = stack.shape
    within = np.stack([round_shifts(stack[:, c], ref_round, most) for c in range(channels)])
    std = [np.std([moved(stack[r, c], within[c, r]) for r in range(rounds)], axis=0) for c in range(channels)]
    maps = np.tile(np.eye(3), (channels, 1, 1))
    for c in range(channels):
        if c == ref_channel:
            continue
        if align == "affine":
            # shifts move the channel onto the reference; the map leads from a place in the reference to the channel's
            blocks = [(y, x, -dy, -dx, corr) for y, x, dy, dx, corr in kernels.block_shifts(std[ref_channel], std[c], block)]
            maps[c] = kernels.affine_from_blocks(blocks, least_corr)
        elif align == "similar":
            s = kernels.angle_and_shift(std[ref_channel], std[c])
            maps[c] = kernels.rotation(s["angle"], 0, 0, h, w) @ np.array([[1, 0, -s["shift_x"]], [0, 1, -s["shift_y"]], [0, 0, 1.0]])
        else:
            s = kernels.phase_shift(std[ref_channel], std[c], most)
            maps[c] = np.array([[1, 0, -s["shift_x"]], [0, 1, -s["shift_y"]], [0, 0, 1.0]])
    return within, maps


def stacks_of(planes: DataFrame) -> DataFrame:
    """roi, tx, ty, rounds, channels, h, w, v: the planes (round, c) of a tile as one row; a tile has a fixed number of them."""
    g = planes.groupBy(*TILE).agg(F.array_sort(F.collect_list(F.struct("round", "c", "v"))).alias("p"), F.countDistinct("round").alias("rounds"), F.countDistinct("c").alias("channels"), F.first("h").alias("h"), F.first("w").alias("w"))
    return g.select(*TILE, F.col("rounds").cast("int").alias("rounds"), F.col("channels").cast("int").alias("channels"), "h", "w", F.flatten("p.v").alias("v"))


def map_stacks(stacks: DataFrame, kernel: Callable[[np.ndarray], list[tuple]], columns: str) -> DataFrame:
    """roi, tx, ty and the rows that kernel(rounds x channels x h x w) gives for each tile. Incomplete tiles are an error."""
    names = [c.split()[0] for c in columns.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                shape = [b.column(k)[i].as_py() for k in range(3, 7)]
                rows = kernel(np.asarray(b.column(7)[i].values, float).reshape(shape))
                yield pa.RecordBatch.from_pylist([{**{k: b.column(j)[i].as_py() for j, k in enumerate(TILE)}, **dict(zip(names, r, strict=True))} for r in rows], schema=out)

    kinds = {"int": pa.int32(), "double": pa.float64()}
    out = pa.schema([(k, pa.int32()) for k in TILE] + [(c.split()[0], kinds[c.split()[1]]) for c in columns.split(",")])
    return stacks.select(*TILE, "rounds", "channels", "h", "w", "v").mapInArrow(run, f"roi int, tx int, ty int, {columns}")


def registered_tile(planes: DataFrame, transforms: DataFrame, flat: DataFrame | None, black: DataFrame | None, factors: DataFrame | None, radii: tuple[int, int] | None = (2, 4), order: int = 1) -> DataFrame:
    """Planes (roi, tx, ty, round, c, h, w, v) ready for decoding, with `bad`, the pixels that some round or channel of the tile does not cover.

    Steps, in this order: illumination ((v - black of the channel) / flat of the pixel; planes that are all zero stay so), warp by the
    transform of the tile, round and channel (matrix; without one the plane stays), pixels outside are bad and 0, band-pass filter
    with these radii, division by the factor of the channel and round (1 without one).
    """
    p = planes
    if flat is not None:
        f = flat.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("y", "x", "v"))).alias("f")).select("c", F.col("f.v").alias("flat"))
        p = p.join(f, "c", "left").join(black, "c", "left") if black is not None else p.join(f, "c", "left").withColumn("black", F.lit(0.0))
        lit = F.zip_with("v", "flat", lambda v, x: F.try_divide(v - F.coalesce("black", F.lit(0.0)), x))
        p = p.withColumn("v", F.when(F.exists("v", lambda v: v != 0) & F.col("flat").isNotNull(), lit).otherwise(F.col("v"))).drop("flat", "black")
    p = p.join(transforms.select(*TILE, "round", "c", F.flatten("matrix").alias("matrix")), [*TILE, "round", "c"], "left")
    p = p.join(factors, ["c", "round"], "left") if factors is not None else p.withColumn("factor", F.lit(1.0))
    keys = [*TILE, "round", "c"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                h, w, m, factor = (b.column(k)[i].as_py() for k in (5, 6, 8, 9))
                im = np.asarray(b.column(7)[i].values, float).reshape(h, w)
                if m is not None:
                    im = kernels.warp(im, np.array(m).reshape(3, 3), order)
                gone = np.isnan(im)
                im = np.where(gone, 0, im)
                if radii:
                    im = kernels.band_pass(im, *radii)
                im = im / (factor or 1.0)
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(i, 1) for k in range(7)), pa.array([im.ravel()], pa.list_(pa.float64())), pa.array([gone.ravel()], pa.list_(pa.bool_()))], names=[*keys, "h", "w", "v", "gone"])

    done = p.select(*keys, "h", "w", "v", "matrix", "factor").mapInArrow(run, "roi int, tx int, ty int, round int, c int, h int, w int, v array<double>, gone array<boolean>")
    bad = done.groupBy(*TILE).agg(F.collect_list("gone").alias("g")).select(*TILE, F.aggregate("g", F.transform(F.get("g", F.lit(0)), lambda _: F.lit(False)), lambda a, b: F.zip_with(a, b, lambda x, y: x | y)).alias("bad"))
    return done.drop("gone").join(bad, TILE)


def fit_flat_field(planes: DataFrame, h: int, w: int, keep: float = 0.25, rounds: int = 12) -> np.ndarray:
    """The shading S (h x w, largest value 1) under which images are b_n S plus what stands out from it, fitted to all planes (h, w, v).

    Robust: each round weighs pixels by the inverse of their residual, sums weighted ratios over all images (one aggregation per
    pixel), and smooths S by the lowest `keep` of its cosine frequencies. Planes of another shape, not finite or all zero take no part.
    """
    flat = np.ones((h, w))
    basis = [np.cos(np.pi * (np.arange(n)[:, None] + 0.5) * np.arange(max(1, int(n * keep)))[None] / n) for n in (h, w)]
    proj = [b @ np.linalg.pinv(b) for b in basis]
    for _ in range(rounds):

        def sums(batches: Iterator[pa.RecordBatch], flat=flat) -> Iterator[pa.RecordBatch]:
            top, weight = np.zeros(h * w), np.zeros(h * w)
            for b in batches:
                for v in b.column(0):
                    im = np.asarray(v.values, float)
                    if len(im) != h * w or not np.isfinite(im).all() or not im.any():
                        continue
                    s = flat.ravel()
                    level = np.median(im / s)
                    if level <= 0:
                        continue
                    ratio = im / level
                    wt = 1 / (np.abs(ratio - s) + 0.02)
                    top += wt * ratio
                    weight += wt
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(h * w, dtype=np.int32)), pa.array(top), pa.array(weight)], names=["k", "top", "weight"])

        cells = planes.select("v").mapInArrow(sums, "k int, top double, weight double").groupBy("k").agg(F.sum("top").alias("top"), F.sum("weight").alias("weight")).where("weight > 0").collect()
        if not cells:
            return flat
        new = np.ones(h * w)
        for r in cells:
            new[r["k"]] = r["top"] / r["weight"]
        new = np.maximum(proj[0] @ new.reshape(h, w) @ proj[1].T, 1e-6)
        new /= new.max()
        if np.abs(new - flat).max() < 1e-5:
            return new
        flat = new
    return flat


def mixture_bases(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bases (0 to 3, the channel in which the mean of a trace's component is largest) of the traces of one round (n x 4), and the component
    means: a mixture of four Gaussians that starts where one channel is bright. Two components can stand for one base."""
    level = np.percentile(x, 90, axis=0)
    _, mu, _, resp = gaussian_mixture(x, np.eye(4) * level + (1 - np.eye(4)) * np.percentile(x, 10, axis=0))
    return mu.argmax(1)[resp.argmax(1)], mu


def plain_pursuit(y: np.ndarray, x: np.ndarray, background: np.ndarray | None = None, most: int | None = None, tol: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of the rows of x, and the residual: components join by their product with y itself, largest first, all are refitted, and
    the first that lowers the norm of the residual by no more than tol |y| is left out again. Background rows are fitted from the start."""
    b = 0 if background is None else len(background)
    every = x if background is None else np.vstack([background, x])
    fit = lambda chosen: np.linalg.lstsq(every[chosen].T, y, rcond=None)[0] if chosen else np.zeros(0)
    chosen, out = list(range(b)), np.zeros(len(x))
    coef = fit(chosen)
    rest = y - coef @ every[chosen] if chosen else y
    size = np.linalg.norm(y)
    for k in np.argsort(-np.abs(x @ y), kind="stable")[: len(x) if most is None else most]:
        new = fit([*chosen, b + int(k)])
        left = y - new @ every[[*chosen, b + int(k)]]
        if np.linalg.norm(rest) - np.linalg.norm(left) <= tol * size:
            break
        chosen, coef, rest = [*chosen, b + int(k)], new, left
    out[[c - b for c in chosen[b:]]] = coef[b:]
    return out, rest


def plain_pursuit_many(y: np.ndarray, x: np.ndarray, background: np.ndarray | None = None, most: int | None = None, tol: float = 0.05) -> np.ndarray:
    """Coefficients of `plain_pursuit` for many pixels at once (pixels x rows of x): a stack of normal equations per component."""
    b = 0 if background is None else len(background)
    every = x if background is None else np.vstack([background, x])
    order = np.argsort(-np.abs(y @ x.T), axis=1, kind="stable")[:, : len(x) if most is None else most] + b
    out, size = np.zeros((len(y), len(x))), np.linalg.norm(y, axis=1)
    on, rest = np.arange(len(y)), np.linalg.norm(y - (y @ np.linalg.pinv(background) @ background if b else 0), axis=1)
    for k in range(order.shape[1]):
        chosen = np.c_[np.tile(np.arange(b), (len(on), 1)), order[on, : k + 1]]
        use = every[chosen]
        coef = np.einsum("nij,nj->ni", np.linalg.pinv(use @ use.transpose(0, 2, 1)), np.einsum("nkd,nd->nk", use, y[on])) if len(on) else np.zeros((0, b + k + 1))
        left = np.linalg.norm(y[on] - np.einsum("nk,nkd->nd", coef, use), axis=1)
        go = rest[on] - left > tol * size[on]
        on, coef, chosen = on[go], coef[go], chosen[go]
        if not len(on):
            break
        rest[on] = left[go]
        out[on] = 0
        out[on[:, None], chosen[:, b:] - b] = coef[:, b:]
    return out


def nearest_vectors(df: DataFrame, id: str, vector: str, queries: DataFrame, k: int, block: int = 20_000) -> DataFrame:
    """query, id, similarity, place: for each row of the stated query set (id, vector) the k rows of df of largest cosine, itself left out.
    Ties go to the smaller id. Null, all-zero and misshapen vectors are no neighbours and have none.

    Queries are taken block by block to the tasks; a task keeps k rows per query and batch, and these meet in a window that is limited
    before its shuffle.
    """
    asked = [(r[0], r[1]) for r in queries.select(id, vector).where(F.col(vector).isNotNull() & F.col(id).isNotNull()).collect()]
    dims = max(1, *(len(v) for _, v in asked)) if asked else 1
    asked = sorted((i, v) for i, v in asked if len(v) == dims and any(v) and all(x is not None and np.isfinite(x) for x in v))
    kind = df.schema[id].dataType.simpleString()
    out = None
    for first in range(0, max(1, len(asked)), block):
        part = asked[first : first + block]
        names = np.array([i for i, _ in part])
        q = np.array([v for _, v in part], float).reshape(-1, dims)
        q = q / np.linalg.norm(q, axis=1, keepdims=True)

        def run(batches: Iterator[pa.RecordBatch], names=names, q=q) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = [(i, v) for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if i is not None and v is not None and len(v) == dims and None not in v]
                ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float).reshape(-1, dims)
                size = np.linalg.norm(x, axis=1)
                good = np.isfinite(size) & (size > 0)
                if not good.any() or not len(q):
                    continue
                ids, x = ids[good], x[good] / size[good, None]
                for a in range(0, len(q), 1024):
                    s = np.round(q[a : a + 1024] @ x.T, 9)
                    s[names[a : a + 1024, None] == ids[None]] = -np.inf
                    order = np.lexsort((np.broadcast_to(ids, s.shape), -s), axis=1)[:, :k]
                    best = np.take_along_axis(s, order, 1)
                    some = np.isfinite(best)
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(names[a : a + 1024], order.shape[1])[some.ravel()]), pa.array(ids[order][some]), pa.array(best[some])], names=["query", "id", "similarity"])

        met = df.select(id, vector).mapInArrow(run, f"query {kind}, id {kind}, similarity double")
        out = met if out is None else out.unionByName(met)
    first = Window.partitionBy("query").orderBy(F.desc("similarity"), "id")
    return out.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k)


def rois_of(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """keys, ypix, xpix, npix: the pixels of each region as coordinate lists, in order of rows and columns."""
    g = pixels.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct("y", "x"))).alias("p"))
    return g.select(*keys, F.col("p.y").alias("ypix"), F.col("p.x").alias("xpix"), F.size("p").alias("npix"))


def mask_of(rois: DataFrame, keys: list[str]) -> DataFrame:
    """keys, y, x: the pixels of coordinate lists."""
    return rois.select(*keys, F.explode(F.arrays_zip("ypix", "xpix")).alias("p")).select(*keys, F.col("p.ypix").alias("y"), F.col("p.xpix").alias("x"))


def box_means_by_item(points: DataFrame, pixels: DataFrame, keys: list[str], item: str, reach: int) -> DataFrame:
    """keys, y, x, item, mean: the mean of each item's image over the box of side 2 reach + 1 around the points; items that have nothing
    there give no row (their mean is 0)."""
    steps = F.explode(F.sequence(F.lit(-reach), F.lit(reach)))
    at = points.select(*keys, F.col("y").alias("y0"), F.col("x").alias("x0")).distinct().withColumn("dy", steps).withColumn("dx", steps)
    at = at.select(*keys, "y0", "x0", (F.col("y0") + F.col("dy")).alias("y"), (F.col("x0") + F.col("dx")).alias("x"))
    met = at.join(pixels.select(*keys, "y", "x", item, "v"), [*keys, "y", "x"])
    return met.groupBy(*keys, "y0", "x0", item).agg((F.sum("v") / (2 * reach + 1) ** 2).alias("mean")).withColumnsRenamed({"y0": "y", "x0": "x"})

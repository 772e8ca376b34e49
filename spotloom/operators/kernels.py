"""Kernels on whole planes: one row per plane, run in grouped or mapped Python tasks.

A plane is (h int, w int, v array<double>), row by row. The functions take and give NumPy arrays and are tested against
plain loops; `map_planes` and `pair_planes` run them over a table. Each task holds one plane at a time, so memory follows
the size of a tile and not the number of tiles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def planes_from_pixels(pixels: DataFrame, keys: list[str], h: int, w: int) -> DataFrame:
    """keys, h, w, v: pixels (keys, y, x, v) of a tile as one row; absent ones are 0. A plane has at most h x w pixels."""
    inside = pixels.where((F.col("y") >= 0) & (F.col("y") < h) & (F.col("x") >= 0) & (F.col("x") < w))
    g = inside.groupBy(*keys, (F.col("y") * w + F.col("x")).cast("int").alias("_k")).agg(F.sum("v").cast("double").alias("_v"))
    g = g.groupBy(*keys).agg(F.collect_list(F.struct("_k", "_v")).alias("_p")).select(*keys, F.col("_p._k").alias("_k"), F.col("_p._v").alias("_v"))
    head = ", ".join(f"`{k}` {pixels.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = len(keys)
            for i in range(0, b.num_rows, 64):  # dense planes, some at a time
                part = b.slice(i, 64)
                size = part.num_rows
                k, v = part.column(n), part.column(n + 1)
                dense = np.zeros((size, h * w))
                dense[np.repeat(np.arange(size), np.asarray(k.value_lengths())), np.asarray(k.flatten())] = np.asarray(v.flatten())
                planes = pa.FixedSizeListArray.from_arrays(pa.array(dense.ravel()), h * w).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in range(n)), pa.array([h] * size, pa.int32()), pa.array([w] * size, pa.int32()), planes], names=[*keys, "h", "w", "v"])

    return g.mapInArrow(run, f"{head}, h int, w int, v array<double>")


def pixels_from_planes(planes: DataFrame, keys: list[str]) -> DataFrame:
    p = planes.select(*keys, "w", F.posexplode("v").alias("k", "v"))
    return p.select(*keys, F.floor(F.col("k") / F.col("w")).cast("int").alias("y"), (F.col("k") % F.col("w")).alias("x"), "v")


def map_planes(planes: DataFrame, keys: list[str], kernel: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """The table with kernel(plane) for each plane; its result is a plane too."""
    head = ", ".join(f"`{k}` {planes.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                n = len(keys)
                h, w = b.column(n)[i].as_py(), b.column(n + 1)[i].as_py()
                out = np.asarray(kernel(np.asarray(b.column(n + 2)[i].values, float).reshape(h, w)), float)
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(i, 1) for k in range(n)), pa.array([out.shape[0]], pa.int32()), pa.array([out.shape[1]], pa.int32()), pa.array([out.ravel()], pa.list_(pa.float64()))], names=[*keys, "h", "w", "v"])

    return planes.select(*keys, "h", "w", "v").mapInArrow(run, f"{head}, h int, w int, v array<double>")


def pair_planes(a: DataFrame, b: DataFrame, keys: list[str], kernel: Callable[[np.ndarray, np.ndarray], dict[str, float]], columns: list[str]) -> DataFrame:
    """keys and kernel(plane of a, plane of b) as double columns."""
    head = ", ".join(f"`{k}` {a.schema[k].dataType.simpleString()}" for k in keys)
    j = a.select(*keys, "h", "w", "v").join(b.select(*keys, F.col("h").alias("h2"), F.col("w").alias("w2"), F.col("v").alias("v2")), keys)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [kernel(np.asarray(r.v, float).reshape(r.h, r.w), np.asarray(r.v2, float).reshape(r.h2, r.w2)) for r in f.itertuples()]
            yield pd.concat([f[keys].reset_index(drop=True), pd.DataFrame(rows, columns=columns, dtype=float)], axis=1)

    return j.mapInPandas(run, ", ".join([head, *(f"{c} double" for c in columns)]))


def convolve(im: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Correlation with a kernel of odd sides, the border repeated."""
    ry, rx = kernel.shape[0] // 2, kernel.shape[1] // 2
    p = np.pad(im, ((ry, ry), (rx, rx)), mode="edge")
    return np.einsum("yxab,ab->yx", np.lib.stride_tricks.sliding_window_view(p, kernel.shape), kernel)


def hann_disk(radius: int) -> np.ndarray:
    """A round Hann window of a radius, summing to 1."""
    y, x = np.mgrid[-radius : radius + 1, -radius : radius + 1]
    r = np.hypot(y, x)
    k = np.where(r <= radius + 0.5, 0.5 + 0.5 * np.cos(np.pi * r / (radius + 0.5)), 0)
    return k / k.sum()


def band_pass(im: np.ndarray, inner: int = 2, outer: int = 4) -> np.ndarray:
    """A narrow minus a wide smoothing: spots of about `inner` pixels stay."""
    wide, narrow = hann_disk(outer), hann_disk(inner)
    return convolve(im, np.pad(narrow, outer - inner) - wide)


def local_focus(im: np.ndarray, size: int) -> np.ndarray:
    """Local mean of the squared deviation from the local mean."""
    k = np.full((size, size), 1 / size**2)
    return convolve((im - convolve(im, k)) ** 2, k)


def focus_stack(planes: np.ndarray, size: int = 5) -> np.ndarray:
    """One plane from many (z first): pixels weighted by how sharp they are at each depth."""
    f = np.stack([local_focus(p, size) for p in planes])
    w = f / np.maximum(f.sum(0), 1e-12)
    return np.where(f.sum(0) > 0, (w * planes).sum(0), planes.mean(0))


def components(mask: np.ndarray) -> np.ndarray:
    """Labels 1, 2, ... of 4-connected regions, in order of their first pixel; union-find over runs of rows."""
    h, w = mask.shape
    parent: list[int] = []

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    last: list[tuple[int, int, int]] = []
    runs: list[tuple[int, int, int, int]] = []
    for y in range(h):
        edge = np.flatnonzero(np.diff(np.r_[0, mask[y].astype(np.int8), 0]))
        now = []
        for a, z in zip(edge[::2], edge[1::2], strict=True):
            i = len(parent)
            parent.append(i)
            for b, e, j in last:
                if b < z and e > a:
                    p, q = find(i), find(j)
                    parent[max(p, q)] = min(p, q)
            now.append((int(a), int(z), i))
            runs.append((y, int(a), int(z), i))
        last = now
    out, names = np.zeros((h, w), np.int32), {}
    for y, a, z, i in runs:
        out[y, a:z] = names.setdefault(find(i), len(names) + 1)
    return out


def grow(labels: np.ndarray, within: np.ndarray) -> np.ndarray:
    """Labels grown into a mask, one pixel a turn, the smallest neighbouring label first."""
    out = labels.copy()
    while True:
        p = np.pad(out, 1)
        near = np.stack([p[:-2, 1:-1], p[2:, 1:-1], p[1:-1, :-2], p[1:-1, 2:]])
        best = np.where(near > 0, near, np.iinfo(out.dtype).max).min(0)
        new = (out == 0) & within & (best < np.iinfo(out.dtype).max)
        if not new.any():
            return out
        out[new] = best[new]


def distance_inside(mask: np.ndarray) -> np.ndarray:
    """City-block distance to the nearest pixel outside the mask (the outside of the plane counts as outside)."""
    d, left, n = np.zeros(mask.shape, int), mask.copy(), 0
    while left.any():
        n += 1
        d[left] = n
        p = np.pad(left, 1)
        left = left & p[:-2, 1:-1] & p[2:, 1:-1] & p[1:-1, :-2] & p[1:-1, 2:]
    return d


def seeded_regions(im: np.ndarray, threshold: float, core: float) -> np.ndarray:
    """Regions above threshold, divided around the cores that lie deeper than `core` inside."""
    mask = im > threshold
    return grow(components(distance_inside(mask) > core), mask)


def centre_surround_regions(im: np.ndarray, inner: int, outer: int, threshold: float, least: int = 1) -> np.ndarray:
    """Regions where a smoothed plane exceeds 1.5 times its surround by a threshold; small ones are dropped."""
    labels = components(convolve(im, hann_disk(inner)) - 1.5 * convolve(im, hann_disk(outer)) > threshold)
    n = np.bincount(labels.ravel())
    small = np.flatnonzero(n < least)
    return np.where(np.isin(labels, small), 0, labels)


def phase_shift(reference: np.ndarray, target: np.ndarray, most: float | None = None, whiten: bool = True) -> dict[str, float]:
    """Shift (y, x) that moves target onto reference, from the peak of the correlation, and the peak's height.
    Whitened, only phases count: sharp peaks, but weak where planes are smooth."""
    h, w = reference.shape
    a, b = reference - reference.mean(), target - target.mean()
    f = np.fft.fft2(a) * np.conj(np.fft.fft2(b))
    scale = np.abs(f) if whiten else np.linalg.norm(a) * np.linalg.norm(b)
    c = np.fft.ifft2(f / np.maximum(scale, 1e-12)).real
    y, x = np.fft.fftfreq(h, 1 / h)[:, None], np.fft.fftfreq(w, 1 / w)[None, :]
    if most is not None:
        c = np.where((np.abs(y) <= most) & (np.abs(x) <= most), c, -np.inf)
    i, j = np.unravel_index(c.argmax(), c.shape)
    return {"shift_y": float(y[i, 0]), "shift_x": float(x[0, j]), "corr": float(c[i, j])}


def masked_shift(reference: np.ndarray, target: np.ndarray, ref_mask: np.ndarray, target_mask: np.ndarray, most: int, overlap: float = 0.3) -> dict[str, float]:
    """Shift of largest correlation over the pixels both masks hold there, which are at least a share of the largest such number."""
    best, pairs = {"shift_y": 0.0, "shift_x": 0.0, "corr": -np.inf}, []
    h, w = reference.shape
    for dy in range(-most, most + 1):
        for dx in range(-most, most + 1):
            r, t = np.s_[max(0, dy) : h + min(0, dy), max(0, dx) : w + min(0, dx)], np.s_[max(0, -dy) : h + min(0, -dy), max(0, -dx) : w + min(0, -dx)]
            both = ref_mask[r] & target_mask[t]
            pairs.append((int(both.sum()), dy, dx, r, t, both))
    least = overlap * max(p[0] for p in pairs)
    for n, dy, dx, r, t, both in pairs:
        if n >= max(2, least):
            a, b = reference[r][both], target[t][both]
            a, b = a - a.mean(), b - b.mean()
            d = np.sqrt((a * a).sum() * (b * b).sum())
            if d > 0 and (c := float((a * b).sum() / d)) > best["corr"]:
                best = {"shift_y": float(dy), "shift_x": float(dx), "corr": c}
    return best


def warp(im: np.ndarray, matrix: np.ndarray, order: int = 1, outside: float = np.nan) -> np.ndarray:
    """Plane seen through a 3 x 3 map from output (x, y, 1) to input: nearest (order 0) or bilinear (order 1)."""
    h, w = im.shape
    y, x = np.mgrid[:h, :w].astype(float)
    u, v, _ = np.tensordot(matrix, np.stack([x, y, np.ones_like(x)]), 1)
    if order == 0:
        i, j = np.rint(v).astype(int), np.rint(u).astype(int)
        ok = (i >= 0) & (i < h) & (j >= 0) & (j < w)
        return np.where(ok, im[i.clip(0, h - 1), j.clip(0, w - 1)], outside)
    i, j = np.floor(v).astype(int), np.floor(u).astype(int)
    ok = (v >= 0) & (v <= h - 1) & (u >= 0) & (u <= w - 1)
    a, b = v - i, u - j
    at = lambda p, q: im[p.clip(0, h - 1), q.clip(0, w - 1)]
    return np.where(ok, (1 - a) * (1 - b) * at(i, j) + (1 - a) * b * at(i, j + 1) + a * (1 - b) * at(i + 1, j) + a * b * at(i + 1, j + 1), outside)


def rotation(angle: float, shift_y: float, shift_x: float, h: int, w: int, scale: float = 1.0) -> np.ndarray:
    """Map (3 x 3, x before y) that turns by degrees and scales about the centre, then shifts."""
    c, s = scale * np.cos(np.radians(angle)), scale * np.sin(np.radians(angle))
    cx, cy = (w - 1) / 2, (h - 1) / 2
    return np.array([[c, -s, cx - c * cx + s * cy + shift_x], [s, c, cy - s * cx - c * cy + shift_y], [0, 0, 1.0]])


def angle_and_shift(reference: np.ndarray, target: np.ndarray, reach: float = 5.0, steps: int = 11, rounds: int = 3) -> dict[str, float]:
    """Angle and shift of target against reference: a grid of angles, narrowed around the best one each round."""
    h, w = reference.shape
    middle, best = 0.0, {"angle": 0.0, "shift_y": 0.0, "shift_x": 0.0, "corr": -np.inf}
    for _ in range(rounds):
        for a in middle + np.linspace(-reach, reach, steps):
            s = phase_shift(reference, warp(target, rotation(a, 0, 0, h, w), outside=target.mean()), whiten=False)
            if s["corr"] > best["corr"]:
                best = {"angle": float(a), **s}
        middle, reach = best["angle"], reach / 5
    return best


def block_shifts(reference: np.ndarray, target: np.ndarray, size: int) -> list[tuple[float, float, float, float, float]]:
    """(centre y, centre x, shift y, shift x, corr) of each block of a plane: the input of an affine fit."""
    h, w = reference.shape
    out = []
    for y in range(0, h - size + 1, size):
        for x in range(0, w - size + 1, size):
            s = phase_shift(reference[y : y + size, x : x + size], target[y : y + size, x : x + size])
            out.append((y + (size - 1) / 2, x + (size - 1) / 2, s["shift_y"], s["shift_x"], s["corr"]))
    return out


def affine_from_blocks(blocks: list[tuple[float, float, float, float, float]], least_corr: float = 0.0) -> np.ndarray:
    """3 x 3 map of least squares; NaN where it is implausible (scale off by 0.1, shear above 0.3) or blocks are too few."""
    b = np.array([x for x in blocks if x[4] >= least_corr])
    if len(b) < 3:
        return np.full((3, 3), np.nan)
    a = np.c_[b[:, 1], b[:, 0], np.ones(len(b))]
    mx, my = (np.linalg.lstsq(a, b[:, k] + b[:, s], rcond=None)[0] for k, s in ((1, 3), (0, 2)))
    if abs(mx[0] - 1) > 0.1 or abs(my[1] - 1) > 0.1 or abs(mx[1]) > 0.3 or abs(my[0]) > 0.3:
        return np.full((3, 3), np.nan)
    return np.array([mx, my, [0, 0, 1.0]])


def pyramid(im: np.ndarray, levels: int) -> list[np.ndarray]:
    """The plane and successive halvings by means of 2 x 2 pixels; odd last rows and columns are cut."""
    out = [im]
    for _ in range(levels):
        h, w = out[-1].shape[0] // 2 * 2, out[-1].shape[1] // 2 * 2
        out.append(out[-1][:h, :w].reshape(h // 2, 2, w // 2, 2).mean((1, 3)))
    return out


def merge_stack(labels: np.ndarray, least: int = 1) -> np.ndarray:
    """One label plane from a stack (z first): of each label that lies on more than one plane its middle plane among those above
    30 % of its largest; where two overlap by little, or half each, both lose the shared pixels, and a label that lies mostly
    inside another wins it. Labels below `least` pixels are dropped; the rest are numbered 1, 2, ..."""
    masks = []
    for k in np.unique(labels[labels > 0]):
        n = (labels == k).sum((1, 2))
        if (n > 0).sum() > 1:
            z = np.flatnonzero(n > 0.3 * n.max())
            m = labels[z[len(z) // 2]] == k
            if m.sum() >= least:
                masks.append(m)
    for i in range(len(masks)):
        for j in range(i + 1, len(masks)):
            both = masks[i] & masks[j]
            n = both.sum()
            if not n:
                continue
            in_i, in_j = n / masks[i].sum(), n / masks[j].sum()
            iou = n / (masks[i] | masks[j]).sum()
            if iou < 0.01 or (iou < 0.6 and max(in_i, in_j) < 0.7):
                masks[i], masks[j] = masks[i] & ~both, masks[j] & ~both
            elif in_i >= in_j:
                masks[j] = masks[j] & ~both
            else:
                masks[i] = masks[i] & ~both
    out = np.zeros(labels.shape[1:], np.int32)
    for k, m in enumerate((m for m in masks if m.sum() >= least), 1):
        out[m] = k
    return out


def drop_duplicate_labels(a: np.ndarray, b: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray, set[int]]:
    """Two label planes of one overlap, pairs in ascending order: b's label goes where either shares more than `most` of its
    pixels, else both lose the shared ones. Returns both planes and the labels of b that went."""
    a, b, gone = a.copy(), b.copy(), set()
    while True:
        shared = (a > 0) & (b > 0)
        if not shared.any():
            return a, b, gone
        i, j = min(zip(a[shared].tolist(), b[shared].tolist(), strict=True))
        both = (a == i) & (b == j)
        if both.sum() / (a == i).sum() > most or both.sum() / (b == j).sum() > most:
            b[b == j] = 0
            gone.add(j)
        else:
            a[both], b[both] = 0, 0

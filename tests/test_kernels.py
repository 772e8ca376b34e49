import numpy as np
import pytest
from pyspark.sql import functions as F

from spotloom.operators import estimators as est
from spotloom.operators import kernels as k
from spotloom.operators import raster


@pytest.fixture
def im():
    return np.random.default_rng(2).random((20, 17))


def test_convolve_equals_loops(im):
    kernel = np.random.default_rng(3).random((5, 3))
    p = np.pad(im, ((2, 2), (1, 1)), mode="edge")
    want = [[(p[y : y + 5, x : x + 3] * kernel).sum() for x in range(17)] for y in range(20)]
    assert np.allclose(k.convolve(im, kernel), want)
    assert abs(k.band_pass(np.ones((9, 9)))).max() < 1e-12


def test_components_equal_flood_fill(im):
    mask = im > 0.5
    got, want, n = k.components(mask), np.zeros(mask.shape, int), 0
    for y, x in zip(*np.nonzero(mask), strict=True):
        if not want[y, x]:
            n, stack = n + 1, [(y, x)]
            while stack:
                a, b = stack.pop()
                if 0 <= a < 20 and 0 <= b < 17 and mask[a, b] and not want[a, b]:
                    want[a, b] = n
                    stack += [(a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)]
    assert (got == want).all()


def test_seeded_regions_split_touching_disks():
    y, x = np.mgrid[:30, :50]
    im = ((y - 15) ** 2 + (x - 15) ** 2 < 100).astype(float) + ((y - 15) ** 2 + (x - 33) ** 2 < 100)
    assert k.components(im > 0.5).max() == 1 and k.seeded_regions(im, 0.5, 6).max() == 2


def test_shifts_are_recovered(im):
    moved = np.roll(im, (3, -4), (0, 1))
    s = k.phase_shift(im, moved)
    assert (s["shift_y"], s["shift_x"]) == (-3, 4) and s["corr"] > 0.99
    big = np.random.default_rng(7).random((40, 40))
    a, b = big[5:35, 5:35], big[3:33, 8:38]
    full = np.ones((30, 30), bool)
    s = k.masked_shift(a, b, full, full, 6)
    assert (s["shift_y"], s["shift_x"]) == (-2, 3) and s["corr"] > 0.999


def test_angle_is_recovered():
    im = k.convolve(np.random.default_rng(1).random((64, 64)), k.hann_disk(3))
    turned = k.warp(im, k.rotation(2.0, 0, 0, 64, 64), outside=im.mean())
    assert abs(k.angle_and_shift(im, turned)["angle"] + 2.0) < 0.3


def test_warp(im):
    shift = np.array([[1, 0, 2], [0, 1, -1], [0, 0, 1.0]])
    for order in (0, 1):
        out = k.warp(im, shift, order)
        assert np.allclose(out[1:, :15], im[:19, 2:]) and np.isnan(out[0]).all()
    half = k.warp(im, np.array([[1, 0, 0.5], [0, 1, 0], [0, 0, 1.0]]))
    assert np.allclose(half[:, :16], (im[:, :16] + im[:, 1:]) / 2)


def test_affine_from_blocks():
    blocks = [(y, x, 0.01 * y + 2, 0.02 * x - 1, 0.9) for y in (5, 15, 25) for x in (5, 15, 25)]
    assert np.allclose(k.affine_from_blocks(blocks), [[1.02, 0, -1], [0, 1.01, 2], [0, 0, 1]])
    assert np.isnan(k.affine_from_blocks(blocks[:2])).all()


def test_duplicate_labels():
    a, b = np.zeros((4, 6), int), np.zeros((4, 6), int)
    a[:, :3], b[:, 2:4], b[0, 0] = 1, 5, 6
    x, y, gone = k.drop_duplicate_labels(a, b, 0.3)
    assert gone == {5, 6} and (y == 0).all() and (x == a).all()
    x, y, gone = k.drop_duplicate_labels(a, np.where(b == 5, 5, 0), 0.6)
    assert not gone and (x[:, 2] == 0).all() and (y[:, 2] == 0).all()


def test_merge_stack_drops_single_planes_and_shared_pixels():
    s = np.zeros((3, 8, 8), int)
    s[:, 1:4, 1:4] = 3
    s[0, 6, 6] = 9
    s[:2, 3:7, 3:7] = 4
    out = k.merge_stack(s)
    assert out.max() == 2 and out[6, 6] != 9


def test_planes_round_trip(spark):
    px = spark.createDataFrame([(1, 0, 0, 2.0), (1, 2, 3, 5.0), (2, 1, 1, 1.0), (1, 9, 9, 7.0)], "t int, y int, x int, v double")
    p = k.planes_from_pixels(px, ["t"], 3, 4)
    twice = k.map_planes(p, ["t"], lambda im: im * 2)
    got = sorted((r["t"], r["y"], r["x"], r["v"]) for r in k.pixels_from_planes(twice, ["t"]).where("v > 0").collect())
    assert got == [(1, 0, 0, 4.0), (1, 2, 3, 10.0), (2, 1, 1, 2.0)]


def test_focus_stack_takes_the_sharp_plane():
    r = np.random.default_rng(4)
    sharp, flat = r.random((16, 16)) * 10, np.full((16, 16), 5.0)
    assert np.allclose(k.focus_stack(np.stack([flat, sharp])), sharp)


def test_stencil_equals_loops(spark):
    rng = np.random.default_rng(5)
    im = np.where(rng.random((12, 9)) < 0.5, rng.integers(1, 9, (12, 9)), 0).astype(float)
    px = spark.createDataFrame([(int(y), int(x), float(im[y, x])) for y, x in zip(*np.nonzero(im), strict=True)], "y int, x int, v double")
    weights = raster.gaussian(1.2, 2)
    got = {(r["y"], r["x"]): r["s"] for r in raster.stencil(px, [], weights, F.sum("value")).collect()}
    for y in range(12):
        for x in range(9):
            want = sum(w * im[y + dy, x + dx] for dy, dx, w in weights if 0 <= y + dy < 12 and 0 <= x + dx < 9)
            assert abs(got.get((y, x), 0) - want) < 1e-9
    peaks = {(r["y"], r["x"]) for r in raster.local_maxima(px, [], 1.0).collect()}
    p = np.pad(im, ((1, 2), (1, 2)))
    assert peaks == {(y, x) for y in range(12) for x in range(9) if im[y, x] > 1 and im[y, x] + 1e-6 > p[y : y + 4, x : x + 4].max()}


def test_plane_by_consensus_ignores_outliers():
    y, x = (a.ravel().astype(float) for a in np.mgrid[:6, :7])
    v = 2 * y - x + 5
    v[:8] += 60
    c, good = est.plane_by_consensus(y, x, v)
    assert np.allclose(c, [2, -1, 5]) and good.sum() == 34
    assert np.isnan(est.plane_by_consensus(y[:3], x[:3], v[:3])[0]).all()


def test_pursuit_finds_the_genes_of_a_mixture():
    rng = np.random.default_rng(6)
    cube = np.tile(np.eye(4) + 0.1, (7, 1, 1))
    codes: list[str] = []  # well apart, as greedy choice is only right for those
    while len(codes) < 12:
        c = "".join(rng.choice(list("GTAC"), 7))
        if all(sum(a != b for a, b in zip(c, d, strict=True)) >= 5 for d in codes):
            codes.append(c)
    genes, background = est.gene_templates(cube, codes), est.background_vectors(7, 4)
    c, b, _ = est.pursue(3 * genes[4] + 2 * genes[9] + background[0], genes, background, tol=0.2, alpha=0.0)
    assert set(np.argsort(-c)[:2]) == {4, 9} and c[4] > c[9] > 0
    zero = est.pursue(np.zeros(28), genes, background)
    assert not zero[0].any() and len(zero[1]) == 4


def test_spherical_kmeans_and_mixture(spark):
    rng = np.random.default_rng(8)
    centres = np.eye(3)
    x = np.vstack([c * rng.uniform(1, 5, (50, 1)) + rng.normal(0, 0.05, (50, 3)) for c in centres])
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>")
    c, n = est.spherical_kmeans(df, "v", centres + 0.2)
    assert n == [50, 50, 50] and (np.abs(c - centres) < 0.05).all()
    two = np.vstack([rng.normal(0, 1, (200, 2)), rng.normal(8, 1, (100, 2))])
    w, mu, _, resp = est.gaussian_mixture(two, np.array([[1.0, 1.0], [6.0, 6.0]]))
    assert abs(w[0] - 2 / 3) < 0.02 and np.allclose(mu, [[0, 0], [8, 8]], atol=0.4) and (resp.argmax(1)[:200] == 0).all()


def test_regressions(spark):
    df = spark.createDataFrame([(float(i), 3.0 * i - 2, "a") for i in range(20)] + [(float(i), -2.0 * i, "b") for i in range(20)] + [(None, 1.0, "a")], "b double, s double, k string")
    got = {r["k"]: (round(r["slope"], 6), round(r["intercept"], 6)) for r in est.unmixing(df, ["k"], F.col("s"), F.col("b")).collect()}
    assert got == {"a": (3.0, -2.0), "b": (0.0, -19.0)}
    assert np.allclose(est.least_squares(df.where("k = 'a'"), [F.col("b"), F.lit(1.0)], F.col("s")), [3, -2])
    n, mean, cov = est.second_moments(df.where("b is not null").select(F.array("b", "s").alias("v")), "v", 2)
    x = np.array([(float(i), 3.0 * i - 2) for i in range(20)] + [(float(i), -2.0 * i) for i in range(20)])
    assert n == 40 and np.allclose(mean, x.mean(0)) and np.allclose(cov, np.cov(x.T, bias=True))

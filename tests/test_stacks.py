"""Image files, registration, correction and decoding of whole tiles."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotloom.operators import kernels as k
from spotloom.operators import stacks
from spotloom.operators.ordering import leaf_order, ward_merges
from spotloom.plans import stacks as queries_stacks
from spotloom.sources import stacks as scans
from spotloom.sources.tiff import tiff_planes


def _planes(spark, rows):
    return spark.createDataFrame([(*key, im.shape[0], im.shape[1], im.ravel().tolist()) for key, im in rows], "name string, page int, h int, w int, v array<double>")


def test_rounds_are_stacked_and_a_missing_one_is_an_error(spark, tmp_path):
    rng = np.random.default_rng(1)
    ims = {(r, t, c): rng.integers(0, 999, (5, 6)).astype(float) for r in (1, 2) for t in (0, 1) for c in (0, 1)}
    rows = [((f"g_{r}_1/g_{r}_1_MMStack_3-Pos00{t}_010_max.tif", c), im) for (r, t, c), im in ims.items()]
    assert scans.write_files(scans.tiff_files(_planes(spark, rows)), f"file://{tmp_path}") == 4
    got = {(r["round"], r["tx"], r["c"]): r["v"] for r in scans.scan_rounds(spark, str(tmp_path), "g", [1, 2]).collect()}
    assert got == {key: im.ravel().tolist() for key, im in ims.items()}
    assert scans.scan_rounds(spark, str(tmp_path), "g", [2]).count() == 4
    os.remove(tmp_path / "g_2_1/g_2_1_MMStack_3-Pos001_010_max.tif")
    with pytest.raises(FileNotFoundError, match="1 tiles lack one"):
        scans.scan_rounds(spark, str(tmp_path), "g", [1, 2])
    with pytest.raises(FileNotFoundError):
        scans.scan_rounds(spark, str(tmp_path), "h", [1])
    assert tiff_planes(spark, str(tmp_path / "g_1_1"), "*.none").count() == 0
    with pytest.raises(ValueError):
        scans.local_root("s3://bucket/x")


def test_masks_of_the_acquisition_come_first(spark, tmp_path):
    own, other = np.arange(6).reshape(2, 3), np.full((2, 3), 9)
    p = spark.createDataFrame([(f"{d}masks_genes_1_2_{y}_corrected.npy", 2, 3, a.ravel().tolist()) for d, y, a in (("", 3, other), ("genes/", 3, own), ("", 4, other))], "name string, h int, w int, v array<bigint>")
    scans.write_files(scans.array_files(p), str(tmp_path))
    got = {(r["roi"], r["tx"], r["ty"]): r["v"] for r in scans.scan_masks(spark, str(tmp_path), "genes").collect()}
    assert got == {(1, 2, 3): own.ravel().tolist(), (1, 2, 4): other.ravel().tolist()}
    with pytest.raises(FileNotFoundError):
        scans.scan_masks(spark, str(tmp_path), "hyb")


def test_transforms_by_version_and_place(spark, tmp_path):
    names = ["reg/a/tforms_a_1_2_3.json", "reg/a/tforms_best_a_1_2_3.json", "reg/tforms_best_a_1_2_3.json", "reg/tforms_best_a_1_2_4.json", "reg/a/ref_tile_tforms_a.json", "reg/a/tforms_corrected_a_1_2_3.json"]
    rows = [(n, f'{{"matrix": [[1, 0, {i}], [0, 1, 0]]}}'.encode()) for i, n in enumerate(names)]
    scans.write_files(spark.createDataFrame(rows, "name string, data binary"), str(tmp_path))
    read = lambda v: {(r["roi"], r["tx"], r["ty"], r["old_place"]): r["matrix"][0][2] for r in scans.scan_transforms(spark, str(tmp_path), "a", v).collect()}
    assert read("best") == {(1, 2, 3, False): 1, (1, 2, 4, True): 3}
    assert read("single_tile") == {(1, 2, 3, False): 0} and read("ransac") == read("corrected") == {(1, 2, 3, False): 5}
    assert read("reference") == {(None, None, None, False): 4}
    with pytest.raises(ValueError):
        scans.scan_transforms(spark, str(tmp_path), "a", "newest")


def test_correction_image_falls_back(spark, tmp_path):
    def put(name, v):
        scans.write_files(scans.tiff_files(_planes(spark, [((f"averages/{name}_max_average.tif", 0), np.full((2, 2), float(v)))])), str(tmp_path))

    value = lambda *a, **o: scans.correction_image(spark, str(tmp_path), *a, **o).agg(F.max("v")).collect()[0][0]
    with pytest.raises(FileNotFoundError):
        value("genes_round_3_1")
    put("genes_round_3_1", 1)
    assert value("genes_round_3_1") == 1
    put("genes_round", 2)
    put("other", 3)
    assert value("genes_round_3_1") == 2 and value("genes_round_3_1", named="other") == 3


def test_files_in_order_of_change(spark, tmp_path):
    for i, n in enumerate("cab"):
        (tmp_path / f"{n}.pos").write_text("x")
        os.utime(tmp_path / f"{n}.pos", (1_000_000 + i, 1_000_000 + i))
    assert [r["path"].rsplit("/", 1)[1] for r in scans.files_by_change(spark, str(tmp_path), "*.pos").collect()] == ["c.pos", "a.pos", "b.pos"]


def test_annotations_and_probes(spark, tmp_path):
    (tmp_path / "c.csv").write_text("label,y,x\n1,2.5,3\n1,2.5,3\n2,,4\n,1,1\n")
    (tmp_path / "p.csv").write_text("probe,target,channel,fluorophore\n a , Vip,2, red\na,Vip,2,red\n")
    assert [tuple(r) for r in scans.annotated_cells(spark, str(tmp_path / "c.csv")).collect()] == [(1, 2.5, 3.0)]
    assert [tuple(r) for r in scans.probes(spark, str(tmp_path / "p.csv")).collect()] == [("a", "Vip", 2, "red")]


def test_flat_field_is_recovered(spark):
    rng = np.random.default_rng(2)
    y, x = np.mgrid[:24, :32]
    shade = 1 - 0.5 * ((y - 10) ** 2 / 600 + (x - 18) ** 2 / 900)
    shade /= shade.max()
    ims = []
    for _ in range(40):
        im = rng.uniform(50, 500) * shade * (1 + 0.02 * rng.normal(size=shade.shape))
        at = rng.random(shade.shape) < 0.03
        ims.append(np.where(at, im * 6, im))  # spots
    ims += [np.zeros((24, 32)), np.full((24, 32), np.nan)]
    df = spark.createDataFrame([(im.ravel().tolist(),) for im in ims] + [([1.0, 2.0],)], "v array<double>").repartition(4)
    assert np.abs(stacks.fit_flat_field(df, 24, 32) - shade).max() < 0.03
    assert (stacks.fit_flat_field(df.limit(0), 4, 4) == 1).all()


def _scene(rng, h=64, w=64):
    im = np.zeros((h, w))
    im[rng.integers(8, h - 8, 60), rng.integers(8, w - 8, 60)] = rng.uniform(5, 20, 60)
    return im


@pytest.mark.parametrize("align", ["shift", "similar", "affine"])
def test_rounds_then_channels_are_registered(align):
    rng = np.random.default_rng(3)
    base = k.convolve(rng.random((96, 96)), k.hann_disk(2)) * 10
    off, between = [(0, 0), (2, -3), (-1, 4)], [(0, 0), (3, 2)]
    stack = np.stack([[stacks.moved(base * (1 + r), np.array(off[r]) + between[c]) for c in range(2)] for r in range(3)])
    within, maps = stacks.register_rounds_and_channels(stack, most=8, align=align, block=32)
    for c in range(2):
        assert [tuple(-s) for s in within[c]] == [tuple(map(float, o)) for o in off]
    # a place in the reference channel leads to its place in the other one
    there = maps[1] @ np.array([48.0, 40.0, 1.0])
    assert np.allclose(there[:2], [48 + between[1][1], 40 + between[1][0]], atol=0.6)
    assert np.allclose(maps[0], np.eye(3))


def test_registered_tile_corrects_moves_and_marks(spark):
    rng = np.random.default_rng(4)
    ims = {(r, c): rng.uniform(10, 90, (12, 14)) for r in range(2) for c in range(2)}
    ims[1, 1][:] = 0
    planes = spark.createDataFrame([(1, 0, 0, r, c, 12, 14, im.ravel().tolist()) for (r, c), im in ims.items()], "roi int, tx int, ty int, round int, c int, h int, w int, v array<double>")
    shift = {(0, 0): (0, 0), (0, 1): (1, 2), (1, 0): (0, -1), (1, 1): (0, 0)}
    tf = spark.createDataFrame([(1, 0, 0, r, c, [[1.0, 0.0, float(x)], [0.0, 1.0, float(y)], [0.0, 0.0, 1.0]]) for (r, c), (y, x) in shift.items() if (r, c) != (0, 0)], "roi int, tx int, ty int, round int, c int, matrix array<array<double>>")
    flat = 0.5 + np.arange(12 * 14).reshape(12, 14) / 400
    f = spark.createDataFrame([(c, y, x, float(flat[y, x])) for c in range(2) for y in range(12) for x in range(14)], "c int, y int, x int, v double")
    black, factors = spark.createDataFrame([(0, 2.0), (1, 3.0)], "c int, black double"), spark.createDataFrame([(0, 0, 4.0), (1, 0, 5.0)], "c int, round int, factor double")
    for radii in (None, (1, 2)):
        got = {(r["round"], r["c"]): (np.array(r["v"]).reshape(12, 14), np.array(r["bad"]).reshape(12, 14)) for r in stacks.registered_tile(planes, tf, f, black, factors, radii).collect()}
        bad = np.zeros((12, 14), bool)
        want = {}
        for (r, c), im in ims.items():
            im = (im - 2.0 - c) / flat if im.any() else im
            y, x = shift[r, c]
            moved = np.full((12, 14), np.nan)
            for a in range(12):
                for b in range(14):
                    if 0 <= a + y < 12 and 0 <= b + x < 14:
                        moved[a, b] = im[a + y, b + x]
            bad |= np.isnan(moved)
            moved = np.nan_to_num(moved)
            moved = k.band_pass(moved, *radii) if radii else moved
            want[r, c] = moved / {(0, 0): 4.0, (0, 1): 5.0}.get((r, c), 1.0)
        for key, w in want.items():
            assert np.allclose(got[key][0], w) and (got[key][1] == bad).all()


def test_mixture_calls_bases():
    rng = np.random.default_rng(5)
    true = rng.integers(0, 4, 800)
    x = (np.eye(4)[true] + 0.15) * rng.uniform(60, 100, (800, 1)) + rng.normal(0, 3, (800, 4))
    called, mu = stacks.mixture_bases(x)
    assert (called == true).mean() > 0.98 and sorted(mu.argmax(1)) == [0, 1, 2, 3]


def test_plain_pursuits_agree_and_follow_the_product_with_the_pixel():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(15, 28))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    background = np.tile(np.eye(4), (1, 7)) / np.sqrt(7)
    y = rng.normal(size=(50, 15)) * (rng.random((50, 15)) < 0.2) @ x + 0.05 * rng.normal(size=(50, 28))
    y[3] = 0
    for b in (None, background):
        for most, tol in ((None, 0.05), (3, 0.02), (1, 0.05)):
            want = np.array([stacks.plain_pursuit(v, x, b, most, tol)[0] for v in y])
            assert np.allclose(stacks.plain_pursuit_many(y, x, b, most, tol), want, atol=1e-8)
    coef, rest = stacks.plain_pursuit(2 * x[4], x, tol=0.05)
    assert np.flatnonzero(coef).tolist() == [4] and abs(coef[4] - 2) < 1e-9 and np.linalg.norm(rest) < 1e-9


def test_nearest_vectors_equal_all_pairs(spark):
    rng = np.random.default_rng(7)
    v = {i: rng.normal(size=6).tolist() for i in range(120)}
    v[7] = v[8] = v[9]
    rows = list(v.items()) + [(500, None), (501, [0.0] * 6), (502, [1.0]), (503, [float("nan")] * 6), (None, v[1])]
    df = spark.createDataFrame(rows, "query bigint, place array<double>").repartition(5)
    got = {}
    for r in stacks.nearest_vectors(df, "query", "place", df.where("query % 10 = 0"), 4, block=5).collect():
        got[r["query"], r["place"]] = r["id"]
    unit = {i: np.array(x) / np.linalg.norm(x) for i, x in v.items()}
    want = {}
    for q in range(0, 120, 10):
        best = sorted((-round(float(unit[q] @ unit[i]), 9), i) for i in v if i != q)[:4]
        want |= {(q, p + 1): i for p, (_, i) in enumerate(best)}
    assert got == want
    assert stacks.nearest_vectors(df, "query", "place", df.limit(0), 4).count() == 0


def test_regions_as_lists_of_pixels(spark):
    px = spark.createDataFrame([(1, 2, 5), (1, 2, 4), (1, 3, 4), (2, 0, 0), (1, 2, 5)], "label int, y int, x int")
    rois = stacks.rois_of(px, ["label"])
    assert {r["label"]: (r["ypix"], r["xpix"], r["npix"]) for r in rois.collect()} == {1: ([2, 2, 3], [4, 5, 4], 3), 2: ([0], [0], 1)}
    assert sorted(tuple(r) for r in stacks.mask_of(rois, ["label"]).collect()) == [(1, 2, 4), (1, 2, 5), (1, 3, 4), (2, 0, 0)]


def test_flat_field_query_sees_a_shading(spark, tmp_path):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(400):
        tx, ty = divmod(i % 40, 8)
        x, y = (int(v) for v in rng.integers(0, 2000, 2))
        rows.append((i, 1, tx, ty, 1800 * tx + x, 1800 * ty + y, [[float(rng.uniform(50, 90))] * 4] * 2))
    spark.createDataFrame(rows, "spot_id bigint, roi int, tx int, ty int, x int, y int, trace array<array<double>>").withColumns({"bases": F.lit("G"), "corrected_bases": F.lit("G")}).write.parquet(f"{tmp_path}/barcode_spots.parquet")
    got = queries_stacks.flat_field_fit(spark, str(tmp_path)).collect()
    assert len(got) == 4 * 16 and all(r["shading"] > 0.95 for r in got)  # an even field, though spots lie in it


def test_leaf_order_is_the_best_of_the_tree():
    rng = np.random.default_rng(9)

    def turns(node, n, merges):
        if node < n:
            return [[node]]
        a, b = (turns(c, n, merges) for c in merges[node - n])
        return [s for p in a for q in b for s in (p + q, q + p)]

    for n in (2, 3, 6, 8):
        x = rng.random((n, 3))
        length = lambda o, x=x: sum(np.linalg.norm(x[a] - x[b]) for a, b in zip(o, o[1:], strict=False))
        got = leaf_order(x)
        assert sorted(got) == list(range(n)) and abs(length(got) - min(map(length, turns(2 * n - 2, n, ward_merges(x))))) < 1e-9
    assert leaf_order(np.zeros((1, 2))) == [0] and leaf_order(np.zeros((0, 2))) == [] and sorted(leaf_order(np.zeros((5, 2)))) == list(range(5))
    tree = ward_merges(np.array([[0.0], [0.1], [5.0], [5.1], [20.0]]))
    assert {frozenset(m) for m in tree[:2]} == {frozenset((0, 1)), frozenset((2, 3))}


def test_gene_leaf_order_holds_every_gene_once(spark, small):
    rows = queries_stacks.gene_leaf_order(spark, small).collect()
    assert sorted(r["place"] for r in rows) == list(range(104)) and len({r["gene"] for r in rows}) == 104


def test_coordinate_images(spark, tmp_path):
    put = lambda name, v: scans.write_files(scans.tiff_files(_planes(spark, [((name, c), np.full((2, 3), v + c)) for c in range(3)]), "float32"), str(tmp_path))
    put("roi_4/coordinates.tif", 1.5)
    rows = scans.scan_coordinates(spark, str(tmp_path), r"roi_(\d+)/", 2).collect()
    assert len(rows) == 24 and {(r["roi"], r["ara_x"], r["ara_z"]) for r in rows} == {(4, 1.5, 3.5)} and {(r["y"], r["x"]) for r in rows} == {(y, x) for y in range(4) for x in range(6)}
    put("roi_5/coordinates.tif", 0.0)
    with pytest.raises(Exception, match="all zero"):
        scans.scan_coordinates(spark, str(tmp_path), r"roi_(\d+)/").collect()
    put("more/roi_4/coordinates.tif", 1.0)
    with pytest.raises(ValueError):
        scans.scan_coordinates(spark, str(tmp_path), r"roi_(\d+)/")


def test_command_line(spark, small, tmp_path, capsys):
    from spotloom.__main__ import main

    assert main(["list", "--part", "leaf"]) == 0 and capsys.readouterr().out == "gene_leaf_order\n"
    assert main(["run", "topk_genes", small, str(tmp_path / "o")]) == 0 and capsys.readouterr().out == "20 rows\n"
    assert main(["explain", "topk_genes", small]) == 0 and "Physical Plan" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["run", "nothing", small, "x"])

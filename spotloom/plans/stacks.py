"""Queries on image files and whole tiles: what they read is written from the tables first, through the sinks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotloom.functions.arrays import has_nan
from spotloom.operators import kernels, projections, raster, stacks
from spotloom.operators.ordering import leaf_order
from spotloom.operators.spatial import located
from spotloom.plans import rasters
from spotloom.plans.problems import SQL_GENE
from spotloom.session import Scratch
from spotloom.sources import files
from spotloom.sources import stacks as scans
from spotloom.sources.tables import barcode_spots, gene_spots, once_per_spot, table
from spotloom.sources.tiff import tiff_planes

#: Pixels of a roi from one tile to the next, per pixel of a plane, and the side of a plane.
TILE_STEP, STEP, SIDE = 1800, 50, 40
TILE = stacks.TILE
#: The finer planes of registration: 25 pixels each, 72 from one tile to the next, 80 wide; least pixels a strip's middle must have.
FINE, FINE_STEP, FINE_SIDE, SURE = 25, 72, 80, 6
LABEL_SIDE = 90
#: Side of a roi's coordinate image, and pixels of the roi per pixel of it.
ATLAS, ATLAS_STEP = 40, 500.0


def _tile_pixels(spark: SparkSession, folder: str, rounds: list[int]) -> DataFrame:
    """roi, tx, ty, round, c, y, x, v: summed whole intensities of the located spots with whole traces, in pixels of their tile."""
    t = once_per_spot(located(barcode_spots(spark, folder)).where("trace is not null"), *TILE, "x", "y", "trace").where(~F.exists("trace", has_nan))
    t = t.where("roi is not null and tx is not null and ty is not null")
    at = lambda c, k: F.floor((F.col(c) - TILE_STEP * F.col(k)) / STEP).cast("int").alias(c)
    t = t.select(*TILE, at("y", "ty"), at("x", "tx"), F.posexplode("trace").alias("round", "t")).where(F.col("round").isin(rounds))
    t = t.where(F.col("y").between(0, SIDE - 1) & F.col("x").between(0, SIDE - 1)).select(*TILE, "round", "y", "x", F.posexplode("t").alias("c", "v"))
    return t.groupBy(*TILE, "round", "c", "y", "x").agg(F.sum(F.greatest(F.col("v").cast("bigint"), F.lit(0))).cast("double").alias("v"))


def _tile_planes(spark: SparkSession, folder: str, rounds: list[int]) -> DataFrame:
    return kernels.planes_from_pixels(_tile_pixels(spark, folder, rounds), [*TILE, "round", "c"], SIDE, SIDE)


def _name(prefix: str, round_: Column) -> Column:
    return F.format_string(f"{prefix}_%d_1/{prefix}_%d_1_MMStack_%d-Pos%03d_%03d_max.tif", round_, round_, *TILE)


def _total(v: str = "v") -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def tiff_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The first round as files of one page per channel, scanned again: sum and largest value of each page."""
    scratch = Scratch(spark, "tiff")
    p = _tile_planes(spark, folder, [0]).select(_name("scan", F.lit(1)).alias("name"), F.col("c").alias("page"), "h", "w", "v")
    scans.write_files(scans.tiff_files(p, "int32"), scratch.at)
    return tiff_planes(spark, scratch.at).select(*TILE, "page", _total().alias("total"), F.array_max("v").alias("top"))


def _written_rounds(spark: SparkSession, folder: str, rounds: list[int], scratch: Scratch) -> DataFrame:
    p = _tile_planes(spark, folder, rounds).select(_name("barcode_round", F.col("round") + 1).alias("name"), F.col("c").alias("page"), "h", "w", "v")
    scans.write_files(scans.tiff_files(p, "int32"), scratch.at)
    return scans.scan_rounds(spark, scratch.at, "barcode_round", [r + 1 for r in rounds])


def round_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Three rounds of an acquisition as one stack."""
    return _written_rounds(spark, folder, [0, 1, 2], Scratch(spark, "rounds")).select(*TILE, "round", "c", _total().alias("total"))


def projection_difference(spark: SparkSession, folder: str) -> DataFrame:
    """Largest less median value over the rounds, per pixel and channel, summed per tile."""
    d = _tile_pixels(spark, folder, list(range(16))).groupBy(*TILE, "c", "y", "x").agg((F.max("v") - F.median("v")).alias("v"))
    return d.groupBy(*TILE, "c").agg(F.round(F.sum("v"), 3).alias("total"), F.max("v").alias("top"))


def _label_pixels(spark: SparkSession, folder: str) -> DataFrame:
    p = rasters._labels(spark, folder)
    cut = {"tx": F.floor(F.col("x") / LABEL_SIDE).cast("int"), "ty": F.floor(F.col("y") / LABEL_SIDE).cast("int"), "x": F.pmod("x", F.lit(LABEL_SIDE)), "y": F.pmod("y", F.lit(LABEL_SIDE))}
    return p.select("roi", *(c.alias(k) for k, c in cut.items()), "label")


def mask_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Label images of the tiles written and scanned: pixels of each label."""
    scratch = Scratch(spark, "masks")
    p = kernels.planes_from_pixels(_label_pixels(spark, folder).withColumnRenamed("label", "v"), TILE, LABEL_SIDE, LABEL_SIDE)
    scans.write_files(scans.array_files(p.withColumn("name", F.format_string("cells/masks_cells_%d_%d_%d_corrected.npy", *TILE))), scratch.at)
    m = scans.scan_masks(spark, scratch.at, "cells").select("roi", F.explode("v").alias("label")).where("label <> 0")
    return m.groupBy("roi", "label").agg(F.count(F.lit(1)).alias("n"))


def transform_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The best transforms, from their place or from the old one."""
    scratch = Scratch(spark, "tforms")
    s = table(spark, folder, "tile_shifts")
    row = lambda *v: F.array(*(F.lit(x).cast("double") if not isinstance(x, Column) else x for x in v))
    for place, side in (("reg/hyb/", "right"), ("reg/", "down")):
        y, x = F.col(f"{side}_y"), F.col(f"{side}_x")
        known = s.where(y.isNotNull() & x.isNotNull() & ~F.isnan(y) & ~F.isnan(x))
        matrix = F.to_json(F.struct(F.array(row(1, 0, x), row(0, 1, y), row(0, 0, 1)).alias("matrix")))
        scans.write_files(known.select(F.format_string(f"{place}tforms_best_hyb_%d_%d_%d.json", *TILE).alias("name"), matrix.cast("binary").alias("data")), scratch.at)
    t = scans.scan_transforms(spark, scratch.at, "hyb", "best")
    return t.select(*TILE, "old_place", F.col("matrix")[0][2].alias("shift_x"), F.col("matrix")[1][2].alias("shift_y"))


def _flat(spark: SparkSession) -> DataFrame:
    """c, y, x, v: a shading whose values whole pages of 32-bit numbers hold exactly."""
    return spark.range(4 * SIDE * SIDE).select((F.col("id") % 4).cast("int").alias("c"), F.floor(F.col("id") / 4 / SIDE).cast("int").alias("y"), (F.floor(F.col("id") / 4) % SIDE).cast("int").alias("x")).withColumn("v", (64 + (F.col("y") + 2 * F.col("x") + F.col("c")) % 64) / 128.0)


def _written_flat(spark: SparkSession, scratch: Scratch) -> DataFrame:
    pages = kernels.planes_from_pixels(_flat(spark), ["c"], SIDE, SIDE).select(F.lit("averages/barcode_round_max_average.tif").alias("name"), F.col("c").alias("page"), "h", "w", "v")
    scans.write_files(scans.tiff_files(pages, "float32"), scratch.at)
    return scans.correction_image(spark, scratch.at, "barcode_round_1_1")


def _black(spark: SparkSession) -> DataFrame:
    return spark.range(4).select(F.col("id").cast("int").alias("c"), F.col("id").cast("double").alias("black"))


def illumination_corrected(spark: SparkSession, folder: str) -> DataFrame:
    """Pixels less the black level (here the number of the channel), divided by the average image of all rounds."""
    flat = _written_flat(spark, Scratch(spark, "flat"))
    p = raster.flat_field(_tile_pixels(spark, folder, [0]).where("v > 0"), flat, _black(spark).withColumnRenamed("black", "v"), ["c", "y", "x"])
    return p.groupBy(*TILE, "c").agg(F.round(F.sum("v"), 4).alias("total"), F.count(F.lit(1)).alias("n"))


def registered_tiles(spark: SparkSession, folder: str) -> DataFrame:
    """Tiles loaded and registered: two rounds from files, corrected, moved by a transform for each tile, round and channel, and normalised."""
    scratch = Scratch(spark, "loaded")
    planes = scratch.save(_written_rounds(spark, folder, [0, 1], scratch).withColumn("round", F.col("round") - 1))
    row = lambda *v: F.array(*(F.lit(x).cast("double") if not isinstance(x, Column) else x.cast("double") for x in v))
    dx, dy = F.col("round") * 2 - F.col("c") % 2, (F.col("tx") + F.col("ty")) % 3 - 1
    transforms = planes.select(*TILE, "round", "c", F.array(row(1, 0, dx), row(0, 1, dy), row(0, 0, 1)).alias("matrix"))
    factors = _black(spark).select("c", F.explode(F.array(F.lit(0), F.lit(1))).alias("round"), (F.col("c") + 1.0).alias("factor"))
    done = stacks.registered_tile(planes, transforms, _written_flat(spark, scratch), _black(spark), factors, None, 0)
    return done.select(*TILE, "round", "c", F.round(_total(), 4).alias("total"), F.size(F.filter("bad", lambda b: b)).alias("n_bad"))


def _fine_pixels(spark: SparkSession, folder: str) -> DataFrame:
    """roi, gy, gx, v: gene spots per pixel of the roi."""
    s = once_per_spot(located(gene_spots(spark, folder)), "roi", "x", "y").where("roi is not null and x >= 0 and y >= 0")
    return s.groupBy("roi", F.floor(F.col("y") / FINE).cast("int").alias("gy"), F.floor(F.col("x") / FINE).cast("int").alias("gx")).agg(F.count(F.lit(1)).cast("double").alias("v"))


def _fine_tiles(spark: SparkSession, folder: str) -> DataFrame:
    """roi, tx, ty, y, x, v: each pixel in all tiles that see it, at its place in the tile."""
    over = lambda c: F.explode(F.sequence(F.greatest(F.lit(0), (F.floor((F.col(c) - FINE_SIDE) / FINE_STEP) + 1).cast("int")), F.floor(F.col(c) / FINE_STEP).cast("int")))
    p = _fine_pixels(spark, folder).withColumn("ty", over("gy")).withColumn("tx", over("gx"))
    return p.select(*TILE, (F.col("gy") - FINE_STEP * F.col("ty")).alias("y"), (F.col("gx") - FINE_STEP * F.col("tx")).alias("x"), "v")


def adjacent_shifts(spark: SparkSession, folder: str) -> DataFrame:
    """Neighbouring tiles registered by what both saw where they overlap. Each tile is displaced by an error of its own, which cuts off what
    leaves it; pairs count where the overlap's middle holds enough pixels."""
    tiles = Scratch(spark, "adjacent").save(_fine_tiles(spark, folder))
    ex, ey = (2 * F.col("tx") + F.col("ty")) % 3 - 1, (F.col("tx") + 2 * F.col("ty") + F.col("roi")) % 3 - 1
    planes = kernels.planes_from_pixels(tiles.withColumns({"y": F.col("y") + ey, "x": F.col("x") + ex}), TILE, FINE_SIDE, FINE_SIDE)
    found = stacks.adjacent_shifts(planes, FINE_SIDE - FINE_STEP, 2)
    across = lambda side, a, b: tiles.where(F.col(a).between(FINE_STEP + 2, FINE_SIDE - 3) & F.col(b).between(3, FINE_SIDE - 4)).groupBy(*TILE).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SURE).select(*TILE, F.lit(side).alias("side"))
    sure = across("right", "x", "y").unionByName(across("down", "y", "x"))
    return found.join(sure, [*TILE, "side"]).select(*TILE, "side", F.col("shift_y").cast("int").alias("shift_y"), F.col("shift_x").cast("int").alias("shift_x"))


def channel_round_shifts(spark: SparkSession, folder: str) -> DataFrame:
    """Rounds registered inside each channel, then channels: stacks of three rounds and two channels, each moved and dimmed differently."""
    tiles = Scratch(spark, "stack").save(_fine_tiles(spark, folder))
    parts = tiles.withColumn("round", F.explode(F.array(*map(F.lit, range(3))))).withColumn("c", F.explode(F.array(F.lit(0), F.lit(1))))
    dy, dx = F.col("round") * (F.col("tx") % 3 - 1) + F.col("c"), F.col("round") * (F.col("ty") % 3 - 1) - 2 * F.col("c")
    parts = parts.withColumns({"y": F.col("y") + dy, "x": F.col("x") + dx, "v": F.col("v") * (1 + F.col("round") + F.col("c"))})
    inside = tiles.where(F.col("y").between(6, FINE_SIDE - 7) & F.col("x").between(6, FINE_SIDE - 7)).groupBy(*TILE).agg(F.count(F.lit(1)).alias("n"))
    edge = tiles.groupBy(*TILE).agg(F.count(F.lit(1)).alias("every"))
    sure = inside.join(edge, TILE).where((F.col("n") >= 4 * SURE) & (F.col("n") >= 0.5 * F.col("every"))).select(*TILE)
    planes = kernels.planes_from_pixels(parts.join(sure, TILE, "left_semi"), [*TILE, "round", "c"], FINE_SIDE, FINE_SIDE)

    def kernel(stack):
        within, maps = stacks.register_rounds_and_channels(stack, most=8)
        return [(c, r, int(within[c, r, 0]), int(within[c, r, 1]), int(round(maps[c][1, 2])), int(round(maps[c][0, 2]))) for c in range(len(maps)) for r in range(len(stack))]

    return stacks.map_stacks(stacks.stacks_of(planes), kernel, "c int, round int, shift_y int, shift_x int, map_y int, map_x int")


def merged_masks(spark: SparkSession, folder: str) -> DataFrame:
    """Three label planes of a tile merged into one: labels on one plane only go, as do those of a single pixel; the rest are numbered."""
    z = F.when(F.col("label") % 3 == 0, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1), F.lit(2)))
    p = _label_pixels(spark, folder).withColumn("round", F.explode(z)).withColumn("c", F.lit(0)).withColumnRenamed("label", "v")
    planes = kernels.planes_from_pixels(p, [*TILE, "round", "c"], LABEL_SIDE, LABEL_SIDE)

    def kernel(stack):
        out = kernels.merge_stack(stack[:, 0].astype(int), 2)
        return [(int(out.max()), int((out > 0).sum()), int(out.sum()))] if out.any() else []

    return stacks.map_stacks(stacks.stacks_of(planes), kernel, "n_labels int, n_pixels int, checksum int")


def roi_masks(spark: SparkSession, folder: str) -> DataFrame:
    """Labels as lists of pixels and back: their number of pixels, and of those left when rows before the label's last one are kept."""
    rois = stacks.rois_of(rasters._labels(spark, folder), ["roi", "label"])
    back = stacks.mask_of(rois, ["roi", "label"]).groupBy("roi", "label").agg(F.count(F.lit(1)).alias("n"), F.max("y").alias("y_last"), F.sum("x").alias("x_sum"))
    return rois.select("roi", "label", "npix").join(back, ["roi", "label"]).select("roi", "label", F.col("npix").cast("bigint").alias("npix"), "n", "y_last", "x_sum")


def gene_boxes(spark: SparkSession, folder: str) -> DataFrame:
    """Box means of every gene's density at the peaks of the density of all genes."""
    s = once_per_spot(located(gene_spots(spark, folder)).where("gene is not null"), "roi", "x", "y", "gene")
    d = s.groupBy("roi", "gene", F.floor(F.col("y") / rasters.STEP).cast("int").alias("y"), F.floor(F.col("x") / rasters.STEP).cast("int").alias("x")).agg(F.count(F.lit(1)).cast("double").alias("v"))
    peaks = raster.local_maxima(rasters._density(spark, folder), ["roi"], rasters.PEAK)
    m = stacks.box_means_by_item(peaks, d, ["roi"], "gene", 1)
    return m.select("roi", "y", "x", "gene", F.round("mean", 6).alias("mean"))


def sampled_spots(spark: SparkSession, folder: str) -> DataFrame:
    """A repeatable sample of a tenth of the spots (the sample is the feature here): how many of each roi."""
    return projections.every_kth(once_per_spot(gene_spots(spark, folder), "roi"), "spot_id", 10).groupBy("roi").agg(F.count(F.lit(1)).alias("n"))


def nearest_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """For each embedding whose id 100 divides (the stated query set) its five nearest of all: the graph of nearest neighbours."""
    e = table(spark, folder, "embeddings")
    n = stacks.nearest_vectors(e, "vec_id", "embedding", e.where("vec_id % 100 = 0"), 5)
    return n.select("query", "id", "place", F.round("similarity", 5).alias("similarity"))


def gene_leaf_order(spark: SparkSession, folder: str) -> DataFrame:
    """Genes in the leaf order of their counts by roi (as logarithms): the matrix has the size of the codebook times the rois."""
    s = once_per_spot(gene_spots(spark, folder).where("gene is not null and roi is not null"), "gene", "roi").groupBy("gene", "roi").agg(F.count(F.lit(1)).alias("n"))
    rows = s.collect()
    genes, rois = sorted({r["gene"] for r in rows}), sorted({r["roi"] for r in rows})
    x = np.zeros((len(genes), len(rois)))
    for r in rows:
        x[genes.index(r["gene"]), rois.index(r["roi"])] = np.log1p(r["n"])
    return spark.createDataFrame([(genes[i], p) for p, i in enumerate(leaf_order(x))], "gene string, place int")


def z_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Profile of a tile along its planes (here the rounds), written and scanned: standard deviation and 99.9th percentile of all pixels."""
    p = _tile_planes(spark, folder, list(range(16)))
    n = SIDE * SIDE
    top, at = F.array_sort("v"), 0.999 * (n - 1)
    value = F.get(top, F.lit(int(at))) + (F.get(top, F.lit(int(at) + 1)) - F.get(top, F.lit(int(at)))) * (at - int(at))
    mean, square = _total() / n, F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x) / n
    profile = p.select(*TILE, "c", F.col("round").alias("z"), F.round(F.sqrt(square - mean * mean), 4).alias("sd"), F.round(value, 4).alias("p999"))
    return Scratch(spark, "zprofile").save(profile)


def flat_field_fit(spark: SparkSession, folder: str) -> DataFrame:
    """The shading of each channel fitted to all tiles of the first round, as means of blocks of 10 x 10 pixels."""
    scratch = Scratch(spark, "shading")
    p = scratch.save(_tile_planes(spark, folder, [0]).select("c", F.transform("v", lambda v: v + 100.0).alias("v")))
    rows = []
    for c in range(4):
        s = stacks.fit_flat_field(p.where(F.col("c") == c), SIDE, SIDE)
        blocks = s.reshape(SIDE // 10, 10, SIDE // 10, 10).mean((1, 3))
        rows += [(c, i, j, round(float(v), 3)) for (i, j), v in np.ndenumerate(blocks)]
    return spark.createDataFrame(rows, "c int, by int, bx int, shading double")


def atlas_coordinates(spark: SparkSession, folder: str) -> DataFrame:
    """Spots at their place in the coordinate image of their roi, read from a file; spots beyond the image have none."""
    scratch = Scratch(spark, "atlas")
    side = F.explode(F.sequence(F.lit(0), F.lit(ATLAS - 1)))
    page = F.posexplode(F.array(F.col("x") / 16 + 1, F.col("y") / 16 + 1, F.col("roi") / 1.0)).alias("page", "v")
    px = table(spark, folder, "cells").select("roi").distinct().withColumn("y", side).withColumn("x", side).select("roi", "y", "x", page)
    pages = kernels.planes_from_pixels(px, ["roi", "page"], ATLAS, ATLAS).withColumn("name", F.format_string("roi_%d/coordinates.tif", "roi"))
    scans.write_files(scans.tiff_files(pages, "float32"), scratch.at)
    image = scans.scan_coordinates(spark, scratch.at, "roi_(\\d+)/")
    s = once_per_spot(located(gene_spots(spark, folder)), "roi", "x", "y").withColumns({"py": F.rint(F.col("y") / ATLAS_STEP).cast("int"), "px": F.rint(F.col("x") / ATLAS_STEP).cast("int")})
    j = s.join(image.withColumnsRenamed({"y": "py", "x": "px"}), ["roi", "py", "px"], "left")
    return j.groupBy("roi").agg(F.count(F.lit(1)).alias("n"), F.count("ara_x").alias("n_inside"), F.round(F.avg("ara_x"), 5).alias("ara_x"), F.round(F.avg("ara_y"), 5).alias("ara_y"), F.max("ara_z").alias("ara_z"))


def tile_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Spots written by tile and read again."""
    at = f"{Scratch(spark, 'sink').at}/spots"
    files.write_tiles(once_per_spot(gene_spots(spark, folder), *TILE, "gene").where("roi is not null and tx is not null and ty is not null"), at)
    return spark.read.parquet(at).groupBy(*TILE).agg(F.count(F.lit(1)).alias("n"), F.count("gene").alias("n_genes"))


def metadata_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Acquisition metadata of each roi as JSON files, read again."""
    at = Scratch(spark, "meta").at
    rois = table(spark, folder, "tile_shifts").select("roi").distinct()
    text = F.format_string('{"Summary": {"z-step_um": %s}, "FrameKey-0-0-0": {"PixelSizeUm": %s}}', F.col("roi") / 4, F.col("roi") * 0.125)
    scans.write_files(rois.select(F.format_string("%d_metadata.txt", "roi").alias("name"), text.cast("binary").alias("data")), at)
    m = files.acquisition_metadata(spark, f"{at}/*_metadata.txt")
    return m.select(F.regexp_extract("path", r"/(\d+)_metadata", 1).cast("int").alias("roi"), "pixel_size_um", "z_step_um")


def stage_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Stage positions of each roi's grid as JSON lists, read again."""
    at = Scratch(spark, "stage").at
    device = lambda name, *v: F.struct(F.lit(name).alias("Device"), F.array(*v).alias("Position_um"))
    at_x, at_y = F.col("tx") * 1800.0, F.col("ty") * 1800.0
    place = F.struct(F.concat_ws("_", "tx", "ty").alias("Label"), F.col("ty").alias("GridRow"), F.col("tx").alias("GridCol"), F.array(device("XYStage", at_x, at_y), device("ZDrive", F.col("roi") * 1.0)).alias("DevicePositions"))
    lists = table(spark, folder, "tile_shifts").groupBy("roi").agg(F.array_sort(F.collect_list(F.struct("tx", "ty", place.alias("p")))).alias("s"))  # a list holds the tiles of one roi
    scans.write_files(lists.select(F.format_string("roi%d.pos", "roi").alias("name"), F.to_json(F.struct(F.col("s.p").alias("StagePositions"))).cast("binary").alias("data")), at)
    p = files.stage_positions(spark, f"{at}/*.pos")
    return p.select(F.regexp_extract("path", r"roi(\d+)\.pos", 1).cast("int").alias("roi"), F.col("col").alias("tx"), F.col("row").alias("ty"), "x", "y", "z", "place")


def annotation_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Cell centres as files with a header, as they are set by hand, read again: cells near the origin of their roi's first tile."""
    at = f"{Scratch(spark, 'annotations').at}/centres"
    table(spark, folder, "cells").select((F.col("roi") * 10_000_000 + F.col("label")).cast("int").alias("label"), "y", "x").write.csv(at, header=True)
    return files_cells(spark, at)


def files_cells(spark: SparkSession, at: str) -> DataFrame:
    return scans.annotated_cells(spark, at).groupBy(F.floor(F.col("label") / 10_000_000).cast("int").alias("roi")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("y"), 3).alias("y_sum"))


def probe_channels(spark: SparkSession, folder: str) -> DataFrame:
    """Hybridisation spots by the fluorophore of the probe of their channel."""
    at = f"{Scratch(spark, 'probes').at}/probes"
    rows = [(f"p{c} ", f"gene{c}", c, f" dye{c % 3}") for c in range(1, 5)]
    spark.createDataFrame(rows, "probe string, target string, channel int, fluorophore string").coalesce(1).write.csv(at, header=True)
    h = once_per_spot(table(spark, folder, "hyb_spots"), "cluster")
    return h.join(scans.probes(spark, at), F.col("cluster") + 1 == F.col("channel"), "left").groupBy("fluorophore").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (
    tiff_scan, round_scan, projection_difference, mask_scan, transform_scan, illumination_corrected, registered_tiles, adjacent_shifts, channel_round_shifts, merged_masks,
    roi_masks, gene_boxes, sampled_spots, nearest_embeddings, tile_sink, metadata_scan, stage_scan, annotation_scan, probe_channels,
    gene_leaf_order, z_profile, flat_field_fit, atlas_coordinates,
)}

_TP = f"""t0 as (select spot_id, any_value(roi) as roi, any_value(tx) as tx, any_value(ty) as ty, any_value(x) as x, any_value(y) as y, any_value(trace) as trace from barcode_spots
    where spot_id is not null and trace is not null and x is not null and y is not null and not (x = -1 and y = -1) and roi is not null and tx is not null and ty is not null group by spot_id),
  t1 as (select spot_id, roi, tx, ty, floor((y - {TILE_STEP} * ty) / {STEP})::int as y, floor((x - {TILE_STEP} * tx) / {STEP})::int as x, unnest(range(len(trace)))::int as round, trace from t0),
  t2 as (select * exclude trace, unnest(range(4))::int as c, trace[round + 1] as r from t1), t3 as (select * exclude r, r[c + 1] as v from t2),
  whole as (select spot_id from t3 group by spot_id having not bool_or(isnan(v) or v is null)),
  tp as (select roi, tx, ty, round, c, y, x, sum(greatest(trunc(v), 0))::double as v from t3 semi join whole using (spot_id) where y between 0 and {SIDE - 1} and x between 0 and {SIDE - 1} group by all)"""
_FLAT = "((64 + ({y} + 2 * {x} + {c}) % 64) / 128.0)"
_FINE = f"""l as (select distinct spot_id, roi, x, y from gene_spots where spot_id is not null and roi is not null and x >= 0 and y >= 0),
  f as (select roi, y // {FINE} as gy, x // {FINE} as gx, count(*)::double as v from l group by all),
  f1 as (select *, unnest(range(greatest(0, floor((gy - {FINE_SIDE}) / {FINE_STEP}) + 1)::int, gy // {FINE_STEP} + 1))::int as ty from f),
  f2 as (select *, unnest(range(greatest(0, floor((gx - {FINE_SIDE}) / {FINE_STEP}) + 1)::int, gx // {FINE_STEP} + 1))::int as tx from f1),
  ft as (select roi, tx, ty, gy - {FINE_STEP} * ty as y, gx - {FINE_STEP} * tx as x, v from f2)"""
_LABELS = f"{rasters._L}, lt as (select roi, floor(x / {LABEL_SIDE})::int as tx, floor(y / {LABEL_SIDE})::int as ty, y, x, label from lab)"


def _sql_middle(side: str, a: str, b: str) -> str:
    ea, eb = ("(2 * {tx} + {ty}) % 3 - 1", "({tx} + 2 * {ty} + roi) % 3 - 1")
    step = {"tx": "(n.tx + 1)", "ty": "n.ty"} if side == "right" else {"tx": "n.tx", "ty": "(n.ty + 1)"}
    own = {"tx": "tx", "ty": "ty"}
    return f"""select n.roi, n.tx, n.ty, '{side}' as side, (({eb.format(**own)}) - ({eb.format(**step)}))::int as shift_y, (({ea.format(**own)}) - ({ea.format(**step)}))::int as shift_x
      from (select roi, tx, ty from ft where {a} between {FINE_STEP + 2} and {FINE_SIDE - 3} and {b} between 3 and {FINE_SIDE - 4} group by all having count(*) >= {SURE}) n
      semi join ft g on g.roi = n.roi and g.tx = {step['tx']} and g.ty = {step['ty']}"""


ORACLES = {
    "tiff_scan": f"with {_TP} select roi, tx, ty, c as page, sum(v) as total, max(v) as top from tp where round = 0 group by all",
    "round_scan": f"with {_TP} select roi, tx, ty, round + 1 as round, c, sum(v) as total from tp where round < 3 group by all",
    "projection_difference": f"with {_TP}, d as (select roi, tx, ty, c, y, x, max(v) - median(v) as v from tp group by all) select roi, tx, ty, c, round(sum(v), 3) as total, max(v) as top from d group by all",
    "mask_scan": f"with {rasters._L} select roi, label, count(*) as n from lab where label <> 0 group by all",
    "transform_scan": """with k as (select *, right_y is not null and right_x is not null and not isnan(right_y) and not isnan(right_x) as r, down_y is not null and down_x is not null and not isnan(down_y) and not isnan(down_x) as d from tile_shifts)
      select roi, tx, ty, not r as old_place, case when r then right_x else down_x end as shift_x, case when r then right_y else down_y end as shift_y from k where r or d""",
    "illumination_corrected": f"with {_TP} select roi, tx, ty, c, round(sum((v - c) / {_FLAT.format(y='y', x='x', c='c')}), 4) as total, count(*) as n from tp where round = 0 and v > 0 group by all",
    "registered_tiles": f"""with {_TP}, k as (select roi, tx, ty, round, c, max(v) > 0 as lit, round * 2 - c % 2 as dx, (tx + ty) % 3 - 1 as dy from tp where round < 2 group by all),
      g as (select k.*, yy.v as y, xx.v as x from k, (select unnest(range({SIDE}))::int as v) yy, (select unnest(range({SIDE}))::int as v) xx),
      i as (select *, y + dy between 0 and {SIDE - 1} and x + dx between 0 and {SIDE - 1} as ok from g),
      b as (select roi, tx, ty, count(*)::int as n_bad from (select roi, tx, ty, y, x from i group by all having not bool_and(ok)) group by all),
      j as (select i.*, coalesce(tp.v, 0) as v from i left join tp on tp.roi = i.roi and tp.tx = i.tx and tp.ty = i.ty and tp.round = i.round and tp.c = i.c and tp.y = i.y + i.dy and tp.x = i.x + i.dx)
      select j.roi, j.tx, j.ty, j.round, j.c, round(sum(case when ok and lit then (v - j.c) / {_FLAT.format(y='(y + dy)', x='(x + dx)', c='j.c')} / (j.c + 1) else 0 end), 4) as total, coalesce(any_value(n_bad), 0) as n_bad
      from j left join b using (roi, tx, ty) group by all""",
    "adjacent_shifts": f"with {_FINE} {_sql_middle('right', 'x', 'y')} union all {_sql_middle('down', 'y', 'x')}",
    "channel_round_shifts": f"""with {_FINE}, s as (select roi, tx, ty from ft group by all having count(*) filter (where y between 6 and {FINE_SIDE - 7} and x between 6 and {FINE_SIDE - 7}) >= greatest({4 * SURE}, 0.5 * count(*)))
      select roi, tx, ty, c, round, (-round * (tx % 3 - 1))::int as shift_y, (-round * (ty % 3 - 1))::int as shift_x, c as map_y, -2 * c as map_x from s, (values (0), (1), (2)) r(round), (values (0), (1)) k(c)""",
    "merged_masks": f"""with {_LABELS}, n as (select roi, tx, ty, label, count(*) as n from lt where label % 3 <> 0 group by all having count(*) >= 2), r as (select *, row_number() over (partition by roi, tx, ty order by label) as k from n)
      select roi, tx, ty, count(*)::int as n_labels, sum(n)::int as n_pixels, sum(n * k)::int as checksum from r group by all""",
    "roi_masks": f"with {rasters._L} select roi, label, count(*) as npix, count(*) as n, max(y) as y_last, sum(x)::bigint as x_sum from lab group by all",
    "gene_boxes": f"""with {rasters._PEAKS}, s as (select distinct spot_id, roi, x, y, {SQL_GENE} as gene from gene_spots where spot_id is not null and x is not null and y is not null and not (x = -1 and y = -1)),
      gd as (select roi, gene, floor(y / {rasters.STEP})::int as y, floor(x / {rasters.STEP})::int as x, count(*)::double as v from s where gene is not null group by all)
      select pk.roi, pk.y, pk.x, gene, round(sum(gd.v) / 9, 6) as mean from pk join gd on gd.roi = pk.roi and abs(gd.y - pk.y) <= 1 and abs(gd.x - pk.x) <= 1 group by all""",
    "sampled_spots": "with s as (select distinct spot_id, roi from gene_spots where spot_id is not null) select roi, count(*) as n from s where ('0x' || substr(md5(spot_id::varchar), 1, 8))::bigint % 10 = 0 group by roi",
    "nearest_embeddings": """with e as (select vec_id, embedding::double[] as v from embeddings), p as (select a.vec_id as query, b.vec_id as id, list_cosine_similarity(a.v, b.v) as s from e a, e b where a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
      r as (select *, row_number() over (partition by query order by round(s, 9) desc, id) as place from p) select query, id, place::int as place, round(s, 5) as similarity from r where place <= 5""",
    "z_profile": f"""with {_TP}, a as (select roi, tx, ty, c, round as z, sqrt(sum(v * v) / {SIDE * SIDE} - (sum(v) / {SIDE * SIDE}) ** 2) as sd from tp group by all),
      o as (select roi, tx, ty, c, round as z, v, row_number() over (partition by roi, tx, ty, c, round order by v desc) as k from tp),
      p as (select roi, tx, ty, c, z, coalesce(max(v) filter (where k = 2), 0) as b, coalesce(max(v) filter (where k = 3), 0) as a from o group by all)
      select roi, tx, ty, c, z, round(sd, 4) as sd, round(p.a + (p.b - p.a) * {0.999 * (SIDE * SIDE - 1) - int(0.999 * (SIDE * SIDE - 1))!r}::double, 4) as p999 from a join p using (roi, tx, ty, c, z)""",
    "atlas_coordinates": f"""with {rasters._LOC}, s as (select roi, round_even(y / {ATLAS_STEP}, 0)::int as py, round_even(x / {ATLAS_STEP}, 0)::int as px from l), k as (select distinct roi from cells),
      j as (select s.roi, px, py, k.roi is not null and px between 0 and {ATLAS - 1} and py between 0 and {ATLAS - 1} as ok from s left join k on s.roi = k.roi)
      select roi, count(*) as n, count(*) filter (where ok) as n_inside, round(avg(case when ok then px / 16 + 1 end), 5) as ara_x, round(avg(case when ok then py / 16 + 1 end), 5) as ara_y, max(case when ok then roi::double end) as ara_z from j group by roi""",
    "tile_sink": f"with s as (select distinct spot_id, roi, tx, ty, {SQL_GENE} as gene from gene_spots where spot_id is not null and roi is not null and tx is not null and ty is not null) select roi, tx, ty, count(*) as n, count(gene) as n_genes from s group by all",
    "metadata_scan": "select distinct roi, roi * 0.125::double as pixel_size_um, roi / 4 as z_step_um from tile_shifts",
    "stage_scan": "select roi, tx, ty, tx * 1800.0::double as x, ty * 1800.0::double as y, roi::double as z, (row_number() over (partition by roi order by tx, ty) - 1)::int as place from tile_shifts",
    "annotation_scan": "select roi, count(*) as n, round(sum(y), 3) as y_sum from cells where y is not null and x is not null group by roi",
    "probe_channels": "with h as (select distinct spot_id, cluster from hyb_spots where spot_id is not null) select case when cluster between 0 and 3 then 'dye' || ((cluster + 1) % 3) end as fluorophore, count(*) as n from h group by 1",
}

"""Image files of an acquisition by tile: written from tasks, and scans of rounds, masks, transforms and correction images."""

from __future__ import annotations

import io
import re
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotloom.sources.tiff import tiff_planes, write_pages

#: How the files of each version of a tile's transforms begin.
VERSIONS = {"reference": "ref_tile_tforms_", "single_tile": "tforms_", "ransac": "tforms_corrected_", "corrected": "tforms_corrected_", "best": "tforms_best_"}
_TILE = re.compile(r"_MMStack_(\d+)-Pos(\d+)_(\d+)")


def local_root(folder: str) -> Path:
    """A shared folder as a path; other file systems cannot be written from plain tasks."""
    if "://" in folder and not folder.startswith("file://"):
        raise ValueError(f"image files need a mounted folder: {folder}")
    return Path(folder.removeprefix("file://"))


def write_files(files: DataFrame, folder: str) -> int:
    """Write rows (name, data binary) below a shared folder, from the tasks that hold them, and count them. A file gets its name when it is
    whole, so a task that runs again, or two at once, leave no broken one."""
    root = str(local_root(folder))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                path = Path(root, name)
                path.parent.mkdir(parents=True, exist_ok=True)
                part = path.with_name(f".{uuid.uuid4().hex}")
                part.write_bytes(data)
                part.replace(path)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    return files.select("name", "data").mapInArrow(run, "n bigint").agg(F.sum("n")).collect()[0][0] or 0


def tiff_files(planes: DataFrame, kind: str = "uint16") -> DataFrame:
    """name, data: planes (name, page, h, w, v) as files of their pages in order. A file's pages meet in one task."""

    def pack(g: pd.DataFrame) -> pd.DataFrame:
        pages = [np.asarray(r.v, float).reshape(r.h, r.w) for r in g.sort_values("page").itertuples()]
        return pd.DataFrame({"name": [g["name"].iloc[0]], "data": [write_pages(pages, kind)]})

    return planes.select("name", "page", "h", "w", "v").groupBy("name").applyInPandas(pack, "name string, data binary")


def array_files(planes: DataFrame, kind: str = "int32") -> DataFrame:
    """name, data: planes (name, h, w, v) as array files."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.itertuples():
                np.save(held := io.BytesIO(), np.asarray(r.v).reshape(r.h, r.w).astype(kind), allow_pickle=False)
                out.append(held.getvalue())
            yield pd.DataFrame({"name": f["name"], "data": out})

    return planes.select("name", "h", "w", "v").mapInPandas(run, "name string, data binary")


def scan_rounds(spark: SparkSession, folder: str, prefix: str, rounds: list[int], suffix: str = "max") -> DataFrame:
    """roi, tx, ty, round, c, h, w, v of the named rounds, in folders <prefix>_<round>_1. A tile that lacks one of them is an error,
    which the names of the files show before any is read."""
    root = local_root(folder)
    have: dict[tuple[int, ...], set[int]] = {}
    for r in rounds:
        for p in root.glob(f"{prefix}_{r}_1/*_{suffix}.tif"):
            if m := _TILE.search(p.name):
                have.setdefault(tuple(map(int, m.groups())), set()).add(r)
    short = sorted(t for t, s in have.items() if s != set(rounds))
    if short or not have:
        raise FileNotFoundError(f"rounds {rounds} of {prefix}: {len(short)} tiles lack one, such as {short[:3]}" if short else f"no tiles of {prefix} in {root}")
    planes = tiff_planes(spark, str(root), f"{prefix}_*_1/*_{suffix}.tif").withColumn("round", F.regexp_extract("path", rf"{re.escape(prefix)}_(\d+)_1/", 1).cast("int"))
    return planes.where(F.col("round").isin(rounds)).select("roi", "tx", "ty", "round", F.col("page").alias("c"), "h", "w", "v")


def scan_masks(spark: SparkSession, folder: str, prefix: str, suffix: str = "corrected") -> DataFrame:
    """roi, tx, ty, h, w, v of label images masks_<prefix>_<roi>_<tx>_<ty>_<suffix>.npy, those in a subfolder of the acquisition
    first. No such file is an error."""
    root = local_root(folder)
    if next(root.rglob(f"masks_{prefix}_*_{suffix}.npy"), None) is None:
        raise FileNotFoundError(f"no masks of {prefix} in {root}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"masks_{prefix}_*_{suffix}.npy").load(f"file://{root}")
    name = F.regexp_extract("path", r"_(-?\d+_-?\d+_-?\d+)_[^_/]*$", 1)
    tile = [F.get(F.split(name, "_"), F.lit(i)).cast("int").alias(k) for i, k in enumerate(("roi", "tx", "ty"))]
    own = F.col("path").contains(f"/{prefix}/").cast("int")
    best = files.select(*tile, own.alias("own"), "path", "content").groupBy("roi", "tx", "ty").agg(F.max_by("content", F.struct("own", "path")).alias("content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                a = np.load(io.BytesIO(b.column(3)[i].as_py()), allow_pickle=False)
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(i, 1) for k in range(3)), pa.array([a.shape[0]], pa.int32()), pa.array([a.shape[1]], pa.int32()), pa.array([a.ravel().astype(np.int32)], pa.list_(pa.int32()))], names=["roi", "tx", "ty", "h", "w", "v"])

    return best.mapInArrow(run, "roi int, tx int, ty int, h int, w int, v array<int>")


def scan_transforms(spark: SparkSession, folder: str, prefix: str, version: str = "best") -> DataFrame:
    """roi, tx, ty, matrix, old_place: a version (reference, single_tile, ransac = corrected, best) of the transforms of an acquisition,
    from reg/<prefix>/, or from reg/ for tiles that are only there. The reference has no tile: its keys are null."""
    if version not in VERSIONS:
        raise ValueError(f"unknown version of transforms: {version}")
    stem = f"{VERSIONS[version]}{prefix}"
    t = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"{stem}*.json").text(f"file://{local_root(folder)}/reg", wholetext=True)
    t = t.select(F.col("_metadata.file_path").alias("path"), F.from_json("value", "matrix array<array<double>>")["matrix"].alias("matrix"))
    name = F.regexp_extract("path", rf"/{re.escape(stem)}_?((?:-?\d+_-?\d+_-?\d+)?)\.json$", 1)
    tile = [F.get(F.split(name, "_"), F.lit(i)).try_cast("int").alias(k) for i, k in enumerate(("roi", "tx", "ty"))]
    t = t.where(F.col("path").rlike(rf"/{re.escape(stem)}(_-?\d+_-?\d+_-?\d+)?\.json$")).select(*tile, (~F.col("path").contains(f"/reg/{prefix}/")).alias("old_place"), "matrix")
    return t.groupBy("roi", "tx", "ty").agg(F.min_by("matrix", "old_place").alias("matrix"), F.min("old_place").alias("old_place"))


def correction_image(spark: SparkSession, folder: str, prefix: str, projection: str = "max", named: str | None = None) -> DataFrame:
    """c, y, x, v of the average image that corrects an acquisition: the one that is named, else that of all its rounds, else its own."""
    root = local_root(folder) / "averages"
    choices = [named] if named else [*([f"{prefix.split('_round')[0]}_round"] if "_round" in prefix else []), prefix]
    for c in choices:
        if (path := root / f"{c}_{projection}_average.tif").exists():
            p = tiff_planes(spark, str(root), path.name).select(F.col("page").alias("c"), "w", F.posexplode("v").alias("k", "v"))
            return p.select("c", F.floor(F.col("k") / F.col("w")).cast("int").alias("y"), (F.col("k") % F.col("w")).alias("x"), "v")
    raise FileNotFoundError(f"no average image of {choices} in {root}")


def scan_coordinates(spark: SparkSession, folder: str, group: str, upscale: int = 1) -> DataFrame:
    """roi, y, x, ara_x, ara_y, ara_z of the coordinate images *coordinates.tif (three pages), whose roi a pattern finds in the path. Two files
    of one roi, and an image that is all zero, are errors. upscale: each pixel stands for that many in both directions."""
    root = local_root(folder)
    names = [m.group(1) for p in root.rglob("*coordinates.tif") if (m := re.search(group, str(p)))]
    if not names or len(names) != len(set(names)):
        raise ValueError(f"{root}: each roi needs exactly one coordinate image")
    t = tiff_planes(spark, str(root), "**/*coordinates.tif").withColumn("roi", F.regexp_extract("path", group, 1).cast("int"))
    t = t.withColumn("v", F.when(F.exists("v", lambda v: v != 0), F.col("v")).otherwise(F.raise_error(F.concat(F.lit("a coordinate image is all zero: "), "path")).cast("array<double>")))
    g = t.groupBy("roi").agg(F.first("w").alias("w"), *(F.max(F.when(F.col("page") == k, F.col("v"))).alias(n) for k, n in enumerate(("ara_x", "ara_y", "ara_z"))))
    p = g.select("roi", "w", F.posexplode(F.arrays_zip("ara_x", "ara_y", "ara_z")).alias("k", "p"))
    p = p.select("roi", F.floor(F.col("k") / F.col("w")).cast("int").alias("y"), (F.col("k") % F.col("w")).alias("x"), "p.*")
    if upscale == 1:
        return p
    steps = F.explode(F.sequence(F.lit(0), F.lit(upscale - 1)))
    p = p.withColumn("dy", steps).withColumn("dx", steps)
    return p.withColumns({"y": F.col("y") * upscale + F.col("dy"), "x": F.col("x") * upscale + F.col("dx")}).drop("dy", "dx")


def files_by_change(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, changed: files in the order in which they were last changed, then by name; contents are not read."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(f"file://{local_root(folder)}")
    return f.select("path", F.col("modificationTime").alias("changed")).orderBy("changed", "path")


def annotated_cells(spark: SparkSession, path: str) -> DataFrame:
    """label, y, x of cell centres set by hand, from files with a header; rows without a place go, a label counts once."""
    t = spark.read.csv(path, header=True, schema="label int, y double, x double").where("label is not null and y is not null and x is not null")
    return t.groupBy("label").agg(F.min(F.struct("y", "x")).alias("p")).select("label", "p.y", "p.x")


def probes(spark: SparkSession, path: str) -> DataFrame:
    """probe, target, channel (from 1), fluorophore, from files with a header; names are compared trimmed."""
    t = spark.read.csv(path, header=True, schema="probe string, target string, channel int, fluorophore string", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return t.where("probe is not null").dropDuplicates(["probe"])

"""Small sources: codebooks, sections, options, acquisition metadata, stage positions; and tile-wise sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotloom.functions.text_keys import gene_key, sequence_key, trimmed


def codebook_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless gii, seq, gene, with the order of the rows in each file; byte order marks and blank genes handled."""
    t = spark.read.csv(path, schema="gii string, seq string, gene string")
    t = t.select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"))
    return t.select("file", "row", trimmed(F.col("gii")).alias("gii"), sequence_key(F.col("seq")).alias("seq"), gene_key(F.col("gene")).alias("gene"))


def sections_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema="absolute_section int, chamber int, chamber_position int, section_thickness_um double")


def options(defaults: dict, user: dict, metadata: dict | None = None) -> dict:
    """Options after one level of flattening: keys of sections are hoisted, user values win over defaults,
    and camera_order and the round counts come from the metadata."""

    def flat(d: dict) -> dict:
        out = {}
        for k, v in d.items():
            out.update(v if isinstance(v, dict) else {k: v})
        return out

    merged = flat(defaults) | flat(user)
    m = metadata or {}
    return merged | {k: v for k, v in m.items() if k == "camera_order" or k.endswith("_rounds")}


def acquisition_metadata(spark: SparkSession, path: str) -> DataFrame:
    """path, pixel_size_um, z_step_um and the whole JSON of *_metadata.txt files."""
    t = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    get = lambda k: F.get_json_object("value", f"$['{k}']").cast("double")
    frame = F.regexp_extract("value", r'"PixelSizeUm"\s*:\s*([0-9.eE+-]+)', 1)
    return t.select("path", F.coalesce(get("PixelSizeUm"), frame.try_cast("double")).alias("pixel_size_um"), F.coalesce(get("z-step_um"), F.get_json_object("value", "$.Summary['z-step_um']").cast("double")).alias("z_step_um"), "value")


def stage_positions(spark: SparkSession, path: str, xy_stage: str = "XYStage", z_stage: str = "ZDrive") -> DataFrame:
    """tile order from JSON position lists: path, label, row, col, x, y, z, place. A repeated tile in a list is an error."""
    schema = "array<struct<Label:string,GridRow:int,GridCol:int,DevicePositions:array<struct<Device:string,Position_um:array<double>>>>>"
    t = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.from_json(F.get_json_object("value", "$.StagePositions"), schema)).alias("place", "p"))
    at = lambda stage, i: F.get(F.filter("p.DevicePositions", lambda d: d["Device"] == stage), F.lit(0))["Position_um"][i]
    out = t.select("path", F.col("p.Label").alias("label"), F.col("p.GridRow").alias("row"), F.col("p.GridCol").alias("col"), at(xy_stage, 0).alias("x"), at(xy_stage, 1).alias("y"), at(z_stage, 0).alias("z"), "place")
    if out.groupBy("path", "row", "col").count().where("count > 1").limit(1).count():
        raise ValueError("a tile has more than one position")
    return out


def write_tiles(df: DataFrame, path: str, keys: tuple[str, ...] = ("roi", "tx", "ty")) -> None:
    """Tables by tile. Only the partitions that df holds are replaced, so a repeated run is harmless."""
    df.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def missing_only(expected: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What is still to do when a run resumes."""
    return expected.join(done.select(*keys).distinct(), keys, "left_anti")

"""Table scans. One folder holds one parquet table per name, a file or a folder of files each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotloom.functions.text_keys import gene_key, sequence_key, trimmed


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def once_per_spot(df: DataFrame, *cols) -> DataFrame:
    """The chosen columns, one row per spot_id. Redelivered spots repeat their values, so one hash
    aggregate over the columns does it; spot_id spreads the shuffle evenly whatever the other keys hold.
    Rows without a spot_id are no spots and go."""
    return df.where(F.col("spot_id").isNotNull()).select("spot_id", *cols).distinct()


def gene_spots(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "gene_spots").withColumn("gene", gene_key(F.col("gene")))


def barcode_spots(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "barcode_spots")
    return t.withColumns({c: sequence_key(F.col(c)) for c in ("bases", "corrected_bases")})


def codebook(spark: SparkSession, folder: str) -> DataFrame:
    """Without byte order marks; genes as compared."""
    t = table(spark, folder, "codebook")
    return t.withColumns({"gii": trimmed(F.col("gii")), "seq": sequence_key(F.col("seq")), "gene": gene_key(F.col("gene"))})

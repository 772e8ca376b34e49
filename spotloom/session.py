"""Sessions and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("spotloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPOTLOOM_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or where that is unset one of our own (tests only)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"file://{tempfile.gettempdir()}/spotloom-{os.getpid()}"


class Scratch:
    """Intermediate tables written to the shared folder, which cut lineage and outlive lost executors.

    A table is dropped once its successor exists; what a lazy result still reads goes when the interpreter ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.at = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
        self.count, self.paths = 0, set()
        atexit.register(self.drop)

    def save(self, df: DataFrame) -> DataFrame:
        path = f"{self.at}/{self.count}"
        self.count += 1
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path  # noqa: SLF001
        self.paths.add(path)
        return out

    def keep(self, *tables: DataFrame) -> None:
        """Delete all saved tables but these: for the end of an operator, whose result reads nothing else."""
        for path in self.paths - {t._scratch_path for t in tables}:  # noqa: SLF001
            self._delete(path)
        self.paths = {t._scratch_path for t in tables}  # noqa: SLF001

    def drop(self, df: DataFrame | None = None) -> None:
        """Delete one saved table, or all that is left."""
        path = self.at if df is None else getattr(df, "_scratch_path", None)
        if path is not None:
            self.paths.discard(path)
            self._delete(path)

    def _delete(self, path: str) -> None:
        try:
            jvm, jsc = self.spark._jvm, self.spark.sparkContext._jsc  # noqa: SLF001
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the session may be gone already
            pass

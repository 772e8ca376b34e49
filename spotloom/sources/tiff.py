"""Multi-page TIFF tiles: decoding, writing, and a Spark data source (format "tiff_planes").

Covers what microscope stacks use: grey pages of 8, 16 or 32 bits, unsigned, signed or float, in strips, plain or
deflated, either byte order. Anything else is an error that names the file.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Fixed values of the TIFF format: tags, sizes of the field types, codes of no and deflate compression.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, OFFSETS, SAMPLES, ROWS, COUNTS, SAMPLE_FORMAT = 256, 257, 258, 259, 262, 273, 277, 278, 279, 339
TYPE_SIZES = {1: "B", 2: "s", 3: "H", 4: "I", 16: "Q"}
PLAIN, DEFLATE, OLD_DEFLATE = 1, 8, 32946


def read_pages(data: bytes, name: str = "") -> Iterator[np.ndarray]:
    """The pages of a file, one at a time."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack(f"{order}H", data[2:4])[0] != 42:
        raise ValueError(f"{name} is not a TIFF file")
    (at,) = struct.unpack(f"{order}I", data[4:8])
    while at:
        (n,) = struct.unpack_from(f"{order}H", data, at)
        tags: dict[int, tuple] = {}
        for i in range(n):
            tag, kind, count = struct.unpack_from(f"{order}HHI", data, at + 2 + 12 * i)
            if kind in TYPE_SIZES and kind != 2:
                form = f"{order}{count}{TYPE_SIZES[kind]}"
                place = at + 2 + 12 * i + 8
                if struct.calcsize(form) > 4:
                    (place,) = struct.unpack_from(f"{order}I", data, place)
                tags[tag] = struct.unpack_from(form, data, place)
        if tags.get(SAMPLES, (1,))[0] != 1 or OFFSETS not in tags:
            raise ValueError(f"{name}: only grey pages in strips can be read")
        kind = f"{order}{ {1: 'u', 2: 'i', 3: 'f'}[tags.get(SAMPLE_FORMAT, (1,))[0]] }{tags.get(BITS, (8,))[0] // 8}"
        parts = [data[o : o + c] for o, c in zip(tags[OFFSETS], tags[COUNTS], strict=True)]
        packed = tags.get(COMPRESSION, (PLAIN,))[0]
        if packed in (DEFLATE, OLD_DEFLATE):
            parts = [zlib.decompress(p) for p in parts]
        elif packed != PLAIN:
            raise ValueError(f"{name}: compression {packed} is not known")
        yield np.frombuffer(b"".join(parts), kind).reshape(tags[HEIGHT][0], tags[WIDTH][0])
        (at,) = struct.unpack_from(f"{order}I", data, at + 2 + 12 * n)


def write_pages(pages: list[np.ndarray], kind: str = "uint16", clip: bool = True, deflate: bool = True) -> bytes:
    """A little-endian file of grey pages. Values below 0 become 0 if clip is set; fractions are cut off."""
    out = bytearray(b"II*\0" + struct.pack("<I", 0))
    link = 4
    for p in pages:
        p = np.maximum(p, 0) if clip else p
        a = np.ascontiguousarray(p.astype(kind).astype(np.dtype(kind).newbyteorder("<")))
        body = zlib.compress(a.tobytes()) if deflate else a.tobytes()
        at = len(out)
        out += body + b"\0" * (len(body) % 2)
        form = {"u": 1, "i": 2, "f": 3}[a.dtype.kind]
        fields = [(WIDTH, 4, a.shape[1]), (HEIGHT, 4, a.shape[0]), (BITS, 3, a.dtype.itemsize * 8), (COMPRESSION, 3, DEFLATE if deflate else PLAIN), (PHOTOMETRIC, 3, 1), (OFFSETS, 4, at), (SAMPLES, 3, 1), (ROWS, 4, a.shape[0]), (COUNTS, 4, len(body)), (SAMPLE_FORMAT, 3, form)]
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(fields))
        for tag, t, v in fields:
            out += struct.pack("<HHI", tag, t, 1) + (struct.pack("<HH", v, 0) if t == 3 else struct.pack("<I", v))
        link = len(out)
        out += struct.pack("<I", 0)
    return bytes(out)


SCHEMA = "path string, roi int, tx int, ty int, page int, h int, w int, v array<double>"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
NAMES = re.compile(r"_MMStack_(\d+)-Pos(\d+)_(\d+)")


#: Bytes of files that one task reads, if there are enough of them, and the number of tasks that is aimed at otherwise.
TASK_BYTES, TASKS = 64 << 20, 64


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.glob = options["path"].removeprefix("file://"), options.get("glob", "**/*.tif")

    def partitions(self) -> list[InputPartition]:
        """Neighbouring files together, up to TASK_BYTES a task: one task a file would cost more than reading small files does."""
        found = [(str(p), p.stat().st_size) for p in sorted(Path(self.root).glob(self.glob))]
        most = min(TASK_BYTES, sum(n for _, n in found) / TASKS)
        parts, held = [[]], 0
        for path, n in found:
            if parts[-1] and held + n > most:
                parts, held = [*parts, []], 0
            parts[-1].append(path)
            held += n
        return [_Files(p) for p in parts]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        for path in partition.paths:
            m = NAMES.search(path)
            tile = tuple(map(int, m.groups())) if m else (None, None, None)
            for i, p in enumerate(read_pages(Path(path).read_bytes(), path)):
                numbers = (pa.array([n], pa.int32()) for n in (*tile, i, *p.shape))
                yield pa.RecordBatch.from_arrays([pa.array([path]), *numbers, pa.array([p.astype(float).ravel()], pa.list_(pa.float64()))], names=COLUMNS)


class TiffPlanes(DataSource):
    """spark.read.format("tiff_planes").load(folder): one row per page; roi, tx, ty come from the name."""

    @classmethod
    def name(cls) -> str:
        return "tiff_planes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def tiff_planes(spark: SparkSession, folder: str, glob: str = "**/*.tif") -> DataFrame:
    spark.dataSource.register(TiffPlanes)
    return spark.read.format("tiff_planes").option("glob", glob).load(folder)

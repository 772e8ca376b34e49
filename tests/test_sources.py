import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotloom.operators import calling, counting, tiles
from spotloom.sources import files, tiff
from spotloom.streaming import live


@pytest.mark.parametrize("kind", ["uint8", "uint16", "int32", "float32"])
@pytest.mark.parametrize("deflate", [True, False])
def test_tiff_round_trip(kind, deflate):
    pages = [(np.random.default_rng(i).random((5 + i, 7)) * 200).astype(kind) for i in range(3)]
    back = list(tiff.read_pages(tiff.write_pages(pages, kind, deflate=deflate)))
    assert len(back) == 3 and all((a == b).all() for a, b in zip(pages, back, strict=True))


def test_tiff_cuts_fractions_and_negatives():
    (page,) = tiff.read_pages(tiff.write_pages([np.array([[-3.0, 2.9]])]))
    assert page.tolist() == [[0, 2]]
    with pytest.raises(ValueError):
        list(tiff.read_pages(b"no image"))


def test_tiff_source(spark, tmp_path):
    (tmp_path / "g_MMStack_2-Pos001_003.tif").write_bytes(tiff.write_pages([np.arange(6).reshape(2, 3), np.ones((2, 3))]))
    rows = tiff.tiff_planes(spark, str(tmp_path)).orderBy("page").collect()
    assert [(r["roi"], r["tx"], r["ty"], r["page"], r["h"], r["w"]) for r in rows] == [(2, 1, 3, 0, 2, 3), (2, 1, 3, 1, 2, 3)]
    assert rows[0]["v"] == [0, 1, 2, 3, 4, 5]


def test_codebook_options_metadata(spark, tmp_path):
    (tmp_path / "c.csv").write_text("﻿g1,GTAC,Abc \ng2,gtaa,\n", encoding="utf-8")
    rows = files.codebook_csv(spark, str(tmp_path / "c.csv")).orderBy("row").collect()
    assert [(r["gii"], r["seq"], r["gene"]) for r in rows] == [("g1", "GTAC", "abc"), ("g2", "GTAA", None)]
    assert files.options({"a": {"x": 1, "y": 2}, "z": 3}, {"b": {"y": 5}}, {"camera_order": [1], "genes_rounds": 7, "other": 1}) == {"x": 1, "y": 5, "z": 3, "camera_order": [1], "genes_rounds": 7}
    (tmp_path / "m_metadata.txt").write_text(json.dumps({"Summary": {"z-step_um": 2.0}, "FrameKey-0-0-0": {"PixelSizeUm": 0.23}}))
    (r,) = files.acquisition_metadata(spark, str(tmp_path / "m_metadata.txt")).collect()
    assert (r["pixel_size_um"], r["z_step_um"]) == (0.23, 2.0)


def test_stage_positions(spark, tmp_path):
    def place(row, col):
        return {"Label": f"1-Pos{col}_{row}", "GridRow": row, "GridCol": col, "DevicePositions": [{"Device": "XYStage", "Position_um": [col * 10.0, row * 5.0]}, {"Device": "ZDrive", "Position_um": [1.5]}]}

    (tmp_path / "a.pos").write_text(json.dumps({"StagePositions": [place(0, 0), place(0, 1)]}))
    rows = files.stage_positions(spark, str(tmp_path / "a.pos")).orderBy("place").collect()
    assert [(r["col"], r["x"], r["y"], r["z"]) for r in rows] == [(0, 0.0, 0.0, 1.5), (1, 10.0, 0.0, 1.5)]
    (tmp_path / "b.pos").write_text(json.dumps({"StagePositions": [place(0, 0), place(0, 0)]}))
    with pytest.raises(ValueError):
        files.stage_positions(spark, str(tmp_path / "b.pos"))


def test_tile_sink_replaces_only_its_tiles(spark, tmp_path):
    out = str(tmp_path / "t")
    files.write_tiles(spark.createDataFrame([(1, 0, 0, 5), (1, 0, 1, 6)], "roi int, tx int, ty int, v int"), out)
    files.write_tiles(spark.createDataFrame([(1, 0, 1, 9)], "roi int, tx int, ty int, v int"), out)
    assert sorted(r["v"] for r in spark.read.parquet(out).collect()) == [5, 9]
    todo = files.missing_only(spark.range(3).select(F.lit(1).alias("roi"), F.lit(0).alias("tx"), F.col("id").cast("int").alias("ty")), spark.read.parquet(out), ["roi", "tx", "ty"])
    assert [r["ty"] for r in todo.collect()] == [2]


def test_stream_resumes_without_repeats(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "id int, t timestamp"
    spark.createDataFrame([(1,), (2,)], "id int").withColumn("t", F.current_timestamp()).write.parquet(src)
    live.process_available(live.arriving(spark, src, schema), out, state)
    spark.createDataFrame([(3,)], "id int").withColumn("t", F.current_timestamp()).write.mode("append").parquet(src)
    live.process_available(live.arriving(spark, src, schema), out, state)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]
    left = live.missing_positions(spark.range(5).selectExpr("cast(id as int) as id"), spark.read.parquet(out), ["id"])
    assert sorted(r["id"] for r in left.collect()) == [0, 4]


def test_windowed_stream_counts(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.sql("select id, timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,id*10) as t, 'a' as k from range(12)").write.parquet(src)
    stream = live.windowed_counts(live.arriving(spark, src, "id long, t timestamp, k string"), "t", "1 hour", ["k"])
    q = stream.writeStream.format("memory").queryName("w1").outputMode("complete").option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r["start"].hour, r["n"]) for r in spark.table("w1").collect()) == [(0, 6), (1, 6)]


def test_nearest_codeword_equals_all_pairs(spark):
    rng = np.random.default_rng(3)
    word = lambda n: "".join(rng.choice(list("GTACN"), n))
    book = [(f"g{i}", word(7), f"gene{i % 20}", i) for i in range(40)] + [("x", "gtxx", None, 40)]
    seqs = [word(7) for _ in range(60)] + [book[3][1], None, "ACG", "gtxy", ""]
    cb = spark.createDataFrame(book, "gii string, seq string, gene string, ord int")
    got = {r["seq"]: (r["code"], r["distance"]) for r in calling.nearest_codeword(spark.createDataFrame([(s,) for s in seqs], "seq string"), cb).collect()}
    want = {}
    for s in {s for s in seqs if s}:
        c = [(sum(a != b for a, b in zip(s, w, strict=True)), o, w) for _, w, _, o in book if len(w) == len(s)]
        if c:
            d, _, w = min(c)
            want[s] = (w, d)
    assert got == want


def test_ordinals_and_home_tiles(spark):
    ids = counting.ordinal_ids(spark.createDataFrame([(w,) for w in ["b", "a", "c", "a", None]], "k string"), "k")
    assert sorted(tuple(r) for r in ids.collect()) == [("a", 0), ("b", 1), ("c", 2)]
    shifts = spark.createDataFrame([(1, 0, 0, 0.0, 100.0), (1, 1, 0, None, None), (2, 0, 0, None, None)], "roi int, tx int, ty int, right_y double, right_x double").withColumns({"down_y": F.lit(None).cast("double"), "down_x": F.lit(None).cast("double")})
    o = tiles.tile_origins(shifts, 120.0)
    spots = spark.createDataFrame([(1, 1, 0, 0, 105.0, 5.0), (2, 1, 0, 0, 115.0, 5.0), (3, 1, 0, 0, 110.0, 5.0), (4, 1, 1, 0, 115.0, 5.0), (5, 2, 0, 0, 999.0, 0.0)], "spot_id int, roi int, tx int, ty int, x double, y double")
    assert sorted(r["spot_id"] for r in tiles.home_tile_only(spots, o).collect()) == [1, 4, 5]

"""Tile grids: neighbours, shifts, origins, transforms, duplicates between overlapping tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The neighbours that each pair of tiles is found by once.
FORWARD = ((0, 1), (1, 0), (1, 1))


def grid_from_names(files: DataFrame, name: str, pattern: str = r"_MMStack_(\d+)-Pos(\d+)_(\d+)") -> DataFrame:
    """roi, nx, ny from file names that hold roi, tile x and tile y; names without them are skipped."""
    part = lambda i: F.regexp_extract(name, pattern, i)
    t = files.where(part(1) != "").select(part(1).cast("int").alias("roi"), part(2).cast("int").alias("tx"), part(3).cast("int").alias("ty"))
    return t.groupBy("roi").agg((F.max("tx") + 1).alias("nx"), (F.max("ty") + 1).alias("ny"))


def expected_tiles(dims: DataFrame) -> DataFrame:
    """roi, tx, ty of full grids of nx times ny tiles."""
    t = dims.withColumn("tx", F.explode(F.sequence(F.lit(0), F.col("nx") - 1)))
    return t.withColumn("ty", F.explode(F.sequence(F.lit(0), F.col("ny") - 1))).select("roi", "tx", "ty")


def neighbours(tiles: DataFrame, offsets=FORWARD) -> DataFrame:
    """roi, tx, ty, tx2, ty2: pairs of existing tiles at the offsets (dx, dy)."""
    steps = F.array(*(F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in offsets))
    a = tiles.select("roi", "tx", "ty").withColumn("o", F.explode(steps)).withColumns({"tx2": F.col("tx") + F.col("o.dx"), "ty2": F.col("ty") + F.col("o.dy")}).drop("o")
    return a.join(tiles.select("roi", F.col("tx").alias("tx2"), F.col("ty").alias("ty2")), ["roi", "tx2", "ty2"]).select("roi", "tx", "ty", "tx2", "ty2")


def _number(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def clean_shifts(shifts: DataFrame, least_corr: float, most_off: float) -> DataFrame:
    """tile_shifts with right_* and down_* cleaned along their line (rows of tiles for right, columns for down).

    A shift of low or no correlation, or farther than most_off from its line's median in y or x, gets the median of the
    line's trusted shifts, or that of the roi for a line without any. Where there is no neighbour (null) it stays null.
    """
    out = shifts
    for side, line in (("right", "ty"), ("down", "tx")):
        there = F.col(f"{side}_y").isNotNull() & F.col(f"{side}_x").isNotNull()
        y, x, corr = _number(F.col(f"{side}_y")), _number(F.col(f"{side}_x")), _number(F.col(f"corr_{side}"))
        sure = (corr >= least_corr) & y.isNotNull() & x.isNotNull()
        out = out.withColumns({"_y": F.when(sure, y), "_x": F.when(sure, x), "_there": there})
        w, all_of_roi = Window.partitionBy("roi", line), Window.partitionBy("roi")
        out = out.withColumns({"_my": F.coalesce(F.median("_y").over(w), F.median("_y").over(all_of_roi)), "_mx": F.coalesce(F.median("_x").over(w), F.median("_x").over(all_of_roi))})
        good = (F.abs(F.col("_y") - F.col("_my")) <= most_off) & (F.abs(F.col("_x") - F.col("_mx")) <= most_off)
        out = out.withColumns({f"{side}_y": F.when(F.col("_there"), F.when(good, F.col("_y")).otherwise(F.col("_my"))), f"{side}_x": F.when(F.col("_there"), F.when(good, F.col("_x")).otherwise(F.col("_mx")))})
    return out.drop("_y", "_x", "_there", "_my", "_mx")


def tile_origins(shifts: DataFrame, size: float, x_back: bool = False, y_back: bool = False) -> DataFrame:
    """roi, tx, ty, origin_y, origin_x, centre_y, centre_x: shifts to the right summed along the row, shifts down along
    the column, both over the tiles before; then moved so that the least of a roi is 0. *_back: tiles run the other way."""
    row = Window.partitionBy("roi", "ty").orderBy("tx").rowsBetween(Window.unboundedPreceding, -1)
    col = Window.partitionBy("roi", "tx").orderBy("ty").rowsBetween(Window.unboundedPreceding, -1)
    sx, sy = -1.0 if x_back else 1.0, -1.0 if y_back else 1.0

    def along(c: str) -> Column:
        return sx * F.coalesce(F.sum(f"right_{c}").over(row), F.lit(0.0)) + sy * F.coalesce(F.sum(f"down_{c}").over(col), F.lit(0.0))

    o = shifts.select("roi", "tx", "ty", along("y").alias("y0"), along("x").alias("x0"))
    least = Window.partitionBy("roi")
    o = o.withColumns({"origin_y": F.col("y0") - F.min("y0").over(least), "origin_x": F.col("x0") - F.min("x0").over(least)})
    return o.select("roi", "tx", "ty", "origin_y", "origin_x", (F.col("origin_y") + size / 2).alias("centre_y"), (F.col("origin_x") + size / 2).alias("centre_x"))


def corners(origins: DataFrame, size: float) -> DataFrame:
    """roi, tx, ty, corner (0 to 3: top left, top right, bottom right, bottom left), y, x."""
    steps = F.array(*(F.struct(F.lit(i).alias("corner"), F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for i, (dy, dx) in enumerate(((0.0, 0.0), (0.0, size), (size, size), (size, 0.0)))))
    c = origins.withColumn("o", F.explode(steps))
    return c.select("roi", "tx", "ty", "o.corner", (F.col("origin_y") + F.col("o.dy")).alias("y"), (F.col("origin_x") + F.col("o.dx")).alias("x"))


def tile_overlaps(origins: DataFrame, size: float) -> DataFrame:
    """roi, tx, ty, tx2, ty2 and the rectangle that neighbouring tiles share; touching edges count, disjoint ones do not."""
    n = neighbours(origins, ((0, 1), (1, 0), (1, 1), (1, -1)))
    a = origins.select("roi", "tx", "ty", F.col("origin_y").alias("ya"), F.col("origin_x").alias("xa"))
    b = origins.select("roi", F.col("tx").alias("tx2"), F.col("ty").alias("ty2"), F.col("origin_y").alias("yb"), F.col("origin_x").alias("xb"))
    j = n.join(a, ["roi", "tx", "ty"]).join(b, ["roi", "tx2", "ty2"])
    j = j.withColumns({"y0": F.greatest("ya", "yb"), "x0": F.greatest("xa", "xb"), "y1": F.least("ya", "yb") + size, "x1": F.least("xa", "xb") + size})
    return j.where("y0 <= y1 and x0 <= x1").select("roi", "tx", "ty", "tx2", "ty2", "y0", "x0", "y1", "x1")


def home_tile_only(spots: DataFrame, origins: DataFrame, reach: int = 2) -> DataFrame:
    """Spots whose own tile's centre is strictly nearer than any other: one copy of what overlapping tiles both saw.

    On a grid only tiles up to `reach` steps away can be nearer, so a spot meets (2 reach + 1)^2 centres and never all. That holds while
    spots lie inside their tile and tiles overlap by less than half of their side: then no tile further away reaches the spot.
    Spots halfway between two tiles are dropped on both sides; in a roi of one tile all stay. Spots of a tile without an origin have
    no home and go.
    """
    c = origins.select("roi", "tx", "ty", "centre_y", "centre_x")
    around = [(dx, dy) for dx in range(-reach, reach + 1) for dy in range(-reach, reach + 1) if (dx, dy) != (0, 0)]
    near = neighbours(origins, around).join(c.select("roi", F.col("tx").alias("tx2"), F.col("ty").alias("ty2"), F.col("centre_y").alias("cy"), F.col("centre_x").alias("cx")), ["roi", "tx2", "ty2"])
    near = near.groupBy("roi", "tx", "ty").agg(F.collect_list(F.struct("cy", "cx")).alias("others"))
    tile = c.join(near, ["roi", "tx", "ty"], "left")
    d2 = lambda y, x: (F.col("y") - y) * (F.col("y") - y) + (F.col("x") - x) * (F.col("x") - x)
    j = spots.join(tile, ["roi", "tx", "ty"]).withColumn("home", d2(F.col("centre_y"), F.col("centre_x")))
    j = j.withColumn("other", F.array_min(F.transform("others", lambda o: d2(o["cy"], o["cx"]))))
    return j.where(F.col("other").isNull() | (F.col("home") < F.col("other"))).select(*spots.columns)


def apply_affine(spots: DataFrame, transforms: DataFrame, keys: list[str]) -> DataFrame:
    """spots with x and y mapped by their tile's m00 m01 m02 / m10 m11 m12, the old ones kept as x_raw and y_raw.
    Spots of tiles without a transform pass as they are."""
    j = spots.withColumnsRenamed({"x": "x_raw", "y": "y_raw"}).join(transforms, keys, "left")
    x = F.col("m00") * F.col("x_raw") + F.col("m01") * F.col("y_raw") + F.col("m02")
    y = F.col("m10") * F.col("x_raw") + F.col("m11") * F.col("y_raw") + F.col("m12")
    j = j.withColumns({"x": F.coalesce(x, F.col("x_raw").cast("double")), "y": F.coalesce(y, F.col("y_raw").cast("double"))})
    return j.drop("m00", "m01", "m02", "m10", "m11", "m12")


def best_shift(raw: DataFrame, fitted: DataFrame, keys: list[str], columns: list[str], most_off: float) -> DataFrame:
    """Element by element the raw value, or the fitted one where raw is missing, NaN or farther off than most_off."""
    j = raw.select(*keys, *columns).join(fitted.select(*keys, *(F.col(c).alias(f"f_{c}") for c in columns)), keys)
    pick = lambda c: F.when(~F.isnan(c) & (F.abs(F.col(c) - F.col(f"f_{c}")) <= most_off), F.col(c)).otherwise(F.col(f"f_{c}"))
    return j.select(*keys, *(pick(c).alias(c) for c in columns))


def label_offsets(labels: DataFrame) -> DataFrame:
    """roi, tx, ty, offset: by how much a tile's labels move so that none repeats in its roi: the running sum of the
    largest labels of the tiles before, in (tx, ty) order."""
    t = labels.groupBy("roi", "tx", "ty").agg(F.max("label").alias("m"))
    w = Window.partitionBy("roi").orderBy("tx", "ty").rowsBetween(Window.unboundedPreceding, -1)
    return t.select("roi", "tx", "ty", F.coalesce(F.sum("m").over(w), F.lit(0)).alias("offset"))


def section_positions(sections: DataFrame, group: str, order: list[str], thickness: str) -> DataFrame:
    """sections with position, the running sum of thickness, and gap, the step of the first order column."""
    w = Window.partitionBy(group).orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return sections.withColumns({"position": F.sum(thickness).over(run), "gap": F.col(order[0]) - F.lag(order[0]).over(w)})

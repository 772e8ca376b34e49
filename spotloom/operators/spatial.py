"""Points near points, and the boxes, polygons or circles that hold them, over a hashed grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Grid cells are this many radii wide: with w radii a point is sent to (1 + 2/w)^2 cells on average.
CELL_RADII = 4
#: Mean radius of the earth in metres (fixed value).
EARTH_M = 6_371_008.8


def located(df: DataFrame) -> DataFrame:
    """Rows with a place: neither coordinate null or NaN, not both -1."""
    x, y = F.col("x"), F.col("y")
    return df.where(x.isNotNull() & y.isNotNull() & ~F.isnan(x.cast("double")) & ~F.isnan(y.cast("double")) & ~((x == -1) & (y == -1)))


def _cells(lo: Column, hi: Column, width: float) -> Column:
    return F.sequence(F.floor(lo / width), F.floor(hi / width))


def near_pairs(points: DataFrame, radius: float, group: str = "roi", id: str = "spot_id") -> DataFrame:
    """Pairs of points of one group at a distance of at most radius: (group, id_a, id_b, distance), id_a < id_b.

    points: group, id, x, y with one row per id. Each point stays in its own grid cell and is also sent to those
    later cells its circle reaches, so each pair meets in exactly one cell and no pair is made twice. The group is only
    part of the cell's key: a group with most points is spread like any other. Null groups pair with nothing.
    Points at one place are all paired, as the result demands. No points give no pairs.
    """
    w = float(radius * CELL_RADII)
    p = points.select(F.col(group).alias("g"), F.col(id).alias("i"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    p = p.where(F.col("g").isNotNull() & F.col("i").isNotNull())
    own = p.withColumns({"cx": F.floor(F.col("x") / w), "cy": F.floor(F.col("y") / w)})
    reach = (
        own.withColumn("ex", F.explode(_cells(F.col("x") - radius, F.col("x") + radius, w)))
        .withColumn("ey", F.explode(_cells(F.col("y") - radius, F.col("y") + radius, w)))
        .where((F.col("ex") > F.col("cx")) | ((F.col("ex") == F.col("cx")) & (F.col("ey") >= F.col("cy"))))
        .select("g", F.col("ex").alias("cx"), F.col("ey").alias("cy"), F.col("i").alias("j"), F.col("x").alias("x2"), F.col("y").alias("y2"),
                ((F.col("ex") == F.col("cx")) & (F.col("ey") == F.col("cy"))).alias("same"))
    )
    d2 = (F.col("x") - F.col("x2")) * (F.col("x") - F.col("x2")) + (F.col("y") - F.col("y2")) * (F.col("y") - F.col("y2"))
    return (
        own.join(reach, ["g", "cx", "cy"])
        .where((d2 <= radius * radius) & F.when(F.col("same"), F.col("i") < F.col("j")).otherwise(F.col("i") != F.col("j")))
        .select(F.col("g").alias(group), F.least("i", "j").alias(f"{id}_a"), F.greatest("i", "j").alias(f"{id}_b"), F.sqrt(d2).alias("distance"))
    )


def points_in_boxes(points: DataFrame, boxes: DataFrame, group: str = "roi", id: str = "spot_id", box: str = "label", cell: float = 64.0) -> DataFrame:
    """(group, id, box) for each point inside a half-open box ymin <= y < ymax, xmin <= x < xmax of its group.

    A box goes to every grid cell it touches, a point to its own, so each match is made once. Boxes may overlap;
    a box with an edge that is null, or that is empty, holds nothing. Large boxes only cost area / cell^2 rows.
    """
    return _in_boxes(points, boxes, group, id, box, cell).select(group, id, box)


def _in_boxes(points: DataFrame, boxes: DataFrame, group: str, id: str, box: str, cell: float, *more: str) -> DataFrame:
    """Matches of points_in_boxes with x and y of the point and more columns of the box."""
    p = points.select(F.col(group), F.col(id), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    p = p.withColumns({"cx": F.floor(F.col("x") / cell), "cy": F.floor(F.col("y") / cell)})
    b = boxes.where((F.col("xmin") < F.col("xmax")) & (F.col("ymin") < F.col("ymax"))).select(group, box, "ymin", "xmin", "ymax", "xmax", *more)
    b = b.withColumn("cx", F.explode(_cells(F.col("xmin"), F.col("xmax") - F.lit(1e-9), cell)))
    b = b.withColumn("cy", F.explode(_cells(F.col("ymin"), F.col("ymax") - F.lit(1e-9), cell)))
    inside = (F.col("y") >= F.col("ymin")) & (F.col("y") < F.col("ymax")) & (F.col("x") >= F.col("xmin")) & (F.col("x") < F.col("xmax"))
    return p.join(b, [group, "cx", "cy"]).where(inside)


def crossing_count(x: Column, y: Column, ring: Column) -> Column:
    """How many edges of a ring (array of struct<x,y>, closed implicitly) a ray to the right of (x, y) crosses."""
    n = F.size(ring)

    def edge(i: Column) -> Column:
        a, b = F.element_at(ring, (i + 1).cast("int")), F.element_at(ring, (F.pmod(i + 1, n) + 1).cast("int"))
        spans = (a["y"] > y) != (b["y"] > y)
        at = (b["x"] - a["x"]) * F.try_divide(y - a["y"], b["y"] - a["y"]) + a["x"]
        return F.when(spans & (x < at), 1).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, i: s + edge(i))


def points_in_polygons(points: DataFrame, polygons: DataFrame, group: str = "roi", id: str = "spot_id", polygon: str = "polygon_id", cell: float = 64.0) -> DataFrame:
    """(group, id, polygon) for points inside rings: the boxes of the rings over the grid first, then the crossing rule.

    polygons: group, polygon, ring array<struct<x:double,y:double>>. Rings of fewer than 3 corners or null hold nothing. A ring goes
    to each grid cell its box touches, so a point is decided where it meets the cell and a polygon with most points is no hot key.
    """
    r = polygons.where(F.size("ring") >= 3).select(group, polygon, "ring")
    lim = r.select(
        group, polygon, "ring",
        F.array_min(F.transform("ring", lambda p: p["y"])).alias("ymin"), F.array_min(F.transform("ring", lambda p: p["x"])).alias("xmin"),
        (F.array_max(F.transform("ring", lambda p: p["y"])) + 1e-9).alias("ymax"), (F.array_max(F.transform("ring", lambda p: p["x"])) + 1e-9).alias("xmax"),
    )
    hits = _in_boxes(points, lim, group, id, polygon, cell, "ring")
    return hits.where(crossing_count(F.col("x"), F.col("y"), F.col("ring")) % 2 == 1).select(group, id, polygon)


def great_circle_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance in metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    return F.lit(2 * EARTH_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def near_on_earth(points: DataFrame, radius_m: float, id: str = "id") -> DataFrame:
    """Pairs (id_a, id_b, metres) of points (id, lat, lon in degrees) at most radius_m apart on the sphere.

    Cells are bands of latitude; within a band, cells of longitude as wide as the radius needs at the band's
    edge nearest a pole. Longitudes meet across the date line. A cap that holds a pole is one cell per band.
    """
    step = max(2 * radius_m / EARTH_M * 57.29577951308232, 1e-9)
    half = step / 2
    p = points.select(F.col(id).alias("i"), "lat", "lon").where(F.col("i").isNotNull() & F.col("lat").between(-90, 90) & F.col("lon").isNotNull())
    p = p.withColumn("lon", F.pmod(F.col("lon") + 180.0, F.lit(360.0)))

    def bands(df: DataFrame) -> DataFrame:
        edge = F.least(F.lit(90.0), F.greatest(F.abs(F.col("band") * step), F.abs((F.col("band") + 1) * step)) + half)
        cells = F.greatest(F.lit(1), F.floor(F.lit(360.0 / step) * F.cos(F.radians(edge)))).cast("long")
        return df.withColumn("cells", cells)

    own = bands(p.withColumn("band", F.floor(F.col("lat") / step)))
    own = own.withColumn("c", F.floor(F.col("lon") * F.col("cells") / 360.0))
    far = bands(p.withColumn("band", F.explode(_cells(F.col("lat") - half, F.col("lat") + half, step))))
    c = F.floor(F.col("lon") * F.col("cells") / 360.0)
    far = far.withColumn("c", F.explode(F.array_distinct(F.transform(F.sequence(c - 1, c + 1), lambda v: F.pmod(v, F.col("cells"))))))
    far = far.select("band", "c", F.col("i").alias("j"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    d = great_circle_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    return own.join(far, ["band", "c"]).where((F.col("i") < F.col("j")) & (d <= radius_m)).select(F.col("i").alias(f"{id}_a"), F.col("j").alias(f"{id}_b"), d.alias("metres"))

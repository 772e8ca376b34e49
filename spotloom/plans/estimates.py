"""Queries of the estimators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotloom.functions.arrays import has_nan
from spotloom.operators import estimators as est
from spotloom.operators.calling import base_centroids, centroid_cube
from spotloom.operators.stacks import plain_pursuit_many
from spotloom.plans.rasters import _T
from spotloom.plans.spots import _BOOK, _TRACES
from spotloom.session import Scratch
from spotloom.sources.tables import barcode_spots, codebook, once_per_spot, table

CODE_ROUNDS = 7


def unmix_regression(spark: SparkSession, folder: str) -> DataFrame:
    li = table(spark, folder, "lineitem")
    u = est.unmixing(li, ["l_returnflag", "l_linestatus"], F.col("l_extendedprice"), F.col("l_quantity"))
    return u.select("l_returnflag", "l_linestatus", F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"))


def unmixed_pixels(spark: SparkSession, folder: str) -> DataFrame:
    """Predicates of bright, unsaturated pixels, then subtraction of the background."""
    li = table(spark, folder, "lineitem").select("l_returnflag", (F.col("l_extendedprice") / 25).alias("s"), F.col("l_quantity").alias("b"))
    p = est.filtered_pixels(li, "s", "b", top=4090.0, ratio=120.0)
    clean = est.unmixed(F.col("s"), F.col("b"), F.lit(20.0), F.lit(5.0))
    return p.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(clean), 2).alias("total"))


def log_linear_fit(spark: SparkSession, folder: str) -> DataFrame:
    """ln(mean intensity of a channel and round) on the round and one level per channel."""
    t = once_per_spot(barcode_spots(spark, folder).where("trace is not null"), "trace").where(~F.exists("trace", has_nan))
    long = t.select(F.posexplode("trace").alias("round", "t")).select("round", F.posexplode("t").alias("c", "v")).groupBy("c", "round").agg(F.avg("v").alias("v"))
    k = est.log_linear_factors(long, "c", "round", "v", 4)
    return spark.createDataFrame([(n, round(float(v), 5)) for n, v in zip(("slope", "c0", "c1", "c2", "c3"), k, strict=True)], "term string, value double")


def ransac_plane(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "tile_shifts").where("right_y is not null and not isnan(right_y)")
    return est.fitted_shifts(s, ["roi"], "right_y", 100.0).select("roi", "tx", "ty", F.round("fitted", 4).alias("fitted"))


def least_squares_map(spark: SparkSession, folder: str) -> DataFrame:
    """Linear map from a spot's place in its tile grid to its pixel: three coefficients per coordinate."""
    s = once_per_spot(barcode_spots(spark, folder).where("x >= 0 and y >= 0"), "tx", "ty", "x", "y")
    xs = [F.col("tx"), F.col("ty"), F.lit(1.0)]
    rows = [(c, *(round(float(v), 4) for v in est.least_squares(s, xs, F.col(c)))) for c in ("x", "y")]
    return spark.createDataFrame(rows, "coordinate string, k_tx double, k_ty double, k_1 double")


def scaled_kmeans(spark: SparkSession, folder: str) -> DataFrame:
    """Directions of the four bases in the first round, from one-hot starts."""
    t = once_per_spot(barcode_spots(spark, folder).where("trace is not null"), "trace").where(~F.exists("trace", has_nan))
    first = Scratch(spark, "kmeans").save(t.select(F.col("trace")[0].alias("v")).where(F.exists("v", lambda v: v != 0)))
    c, n = est.spherical_kmeans(first, "v", np.eye(4))
    return spark.createDataFrame([(i, n[i], *(round(float(v), 4) for v in row)) for i, row in enumerate(c)], "base int, n bigint, c0 double, c1 double, c2 double, c3 double")


def gmm_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Cells in three size and shape classes, by a mixture that starts at quantiles; both are taken over all cells."""
    c = table(spark, folder, "cells").select("roi", "label", F.ln(F.col("area") + 1.0).alias("a"), ((F.col("xmax") - F.col("xmin")) / (F.col("ymax") - F.col("ymin"))).alias("e")).dropna()
    shapes = Scratch(spark, "mixture").save(c.select("a", "e", F.array("a", "e").alias("v")))
    (q,) = shapes.agg(*(F.percentile(x, F.array(*map(F.lit, (0.1, 0.5, 0.9)))).alias(x) for x in ("a", "e"))).collect()
    w, mu, cov = est.mixture_of_rows(shapes, "v", np.array([q["a"], q["e"]]).T)

    def log_density(i: int):
        inv, det = np.linalg.inv(cov[i]), np.linalg.det(cov[i])
        a, e = F.col("a") - float(mu[i, 0]), F.col("e") - float(mu[i, 1])
        return F.lit(float(np.log(w[i]) - np.log(det) / 2)) - (a * a * float(inv[0, 0]) + 2 * a * e * float(inv[0, 1]) + e * e * float(inv[1, 1])) / 2

    s = F.array(*(log_density(i) for i in range(3)))
    return c.select("roi", "label", (F.array_position(s, F.array_max(s)) - 1).cast("int").alias("component")).groupBy("component").agg(F.count(F.lit(1)).alias("n"))


def omp_decode(spark: SparkSession, folder: str) -> DataFrame:
    """Genes in the first seven rounds of each barcode trace by sparse pursuit over the codebook's templates."""
    t = Scratch(spark, "omp").save(once_per_spot(barcode_spots(spark, folder).where("trace is not null and sequence is not null"), "trace", "sequence"))
    cube = np.nan_to_num(centroid_cube(base_centroids(t), CODE_ROUNDS))
    book = codebook(spark, folder).where(f"gene is not null and length(seq) = {CODE_ROUNDS}").orderBy("ord").collect()
    genes = est.gene_templates(cube, [b["seq"] for b in book])
    flat = t.select("spot_id", F.flatten(F.slice("trace", 1, CODE_ROUNDS)).alias("v"))
    d = est.decode_pixels(flat, ["spot_id"], "v", [b["gene"] for b in book], genes, est.background_vectors(CODE_ROUNDS, 4), tol=0.35, most=6)
    return d.groupBy("gene").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("coefficient"), 4).alias("mean_coefficient"))


def plain_omp(spark: SparkSession, folder: str) -> DataFrame:
    """The gene of each barcode trace's first seven rounds that plain pursuit takes first, where it explains more than a twentieth."""
    t = Scratch(spark, "plain").save(once_per_spot(barcode_spots(spark, folder).where("trace is not null and sequence is not null"), "trace", "sequence"))
    cube = np.nan_to_num(centroid_cube(base_centroids(t), CODE_ROUNDS))
    book = codebook(spark, folder).where(f"gene is not null and length(seq) = {CODE_ROUNDS}").orderBy("ord").collect()
    genes = est.gene_templates(cube, [b["seq"] for b in book])
    flat = t.select("spot_id", F.flatten(F.slice("trace", 1, CODE_ROUNDS)).alias("v"))
    d = est.decode_pixels(flat, ["spot_id"], "v", [b["gene"] for b in book], genes, None, many=plain_pursuit_many, most=1)
    return d.groupBy("gene").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("coefficient"), 4).alias("mean_coefficient"))


def embedding_pca(spark: SparkSession, folder: str) -> DataFrame:
    _, v = est.principal_components(table(spark, folder, "embeddings"), "embedding", 64, 5)
    return spark.createDataFrame([(i, round(float(x), 6)) for i, x in enumerate(v)], "component int, variance double")


QUERIES = {f.__name__: f for f in (unmix_regression, unmixed_pixels, log_linear_fit, ransac_plane, least_squares_map, scaled_kmeans, gmm_cells, omp_decode, plain_omp, embedding_pca)}

ORACLES = {
    "log_linear_fit": f"""with {_T}, a as (select c, round, avg(v) as v from t group by all), l as (select c, round, ln(v) as y from a where v > 0),
      m as (select c, avg(round) as r, avg(y) as y from l group by c), k as (select sum((l.round - m.r) * (l.y - m.y)) / sum((l.round - m.r) * (l.round - m.r)) as k from l join m using (c))
      select 'slope' as term, round(k, 5) as value from k union all select 'c' || c, round(y - k * r, 5) from m, k""",
    "plain_omp": f"""with {_TRACES}, {_BOOK}, first as (select * from t where round < {CODE_ROUNDS}), good as (select spot_id, sqrt(sum(a*a+b*b+c*c+d*d)) as size from first group by spot_id having count(*) = {CODE_ROUNDS} and not bool_or(isnan(a) or isnan(b) or isnan(c) or isnan(d))),
      dots as (select spot_id, f.round, m.base, a*c0+b*c1+c*c2+d*c3 as dot from first f semi join good using (spot_id) join m on f.round = m.round),
      codes as (select ord, gene, unnest(range({CODE_ROUNDS}))::int as round, seq from book where gene is not null and length(seq) = {CODE_ROUNDS}), bases as (select ord, gene, round, strpos('GTAC', seq[round + 1]) - 1 as base from codes),
      norms as (select ord, any_value(gene) as gene, sqrt(sum(c0*c0+c1*c1+c2*c2+c3*c3)) as l from bases left join m using (round, base) group by ord),
      scores as (select spot_id, ord, sum(dot) as s from dots join bases using (round, base) group by all), p as (select spot_id, ord, gene, s / l as s, row_number() over (partition by spot_id order by round(abs(s / l), 9) desc, ord) as place from scores join norms using (ord)),
      q as (select gene, s from p join good using (spot_id) where place = 1 and size > 0 and size - sqrt(greatest(size * size - s * s, 0)) > 0.05 * size)
      select gene, count(*) as n, round(avg(s), 4) as mean_coefficient from q group by gene""",
    "unmix_regression": """select l_returnflag, l_linestatus, round(greatest(regr_slope(l_extendedprice, l_quantity), 0), 4) as slope,
      round(case when regr_slope(l_extendedprice, l_quantity) < 0 then avg(l_extendedprice) else regr_intercept(l_extendedprice, l_quantity) end, 3) as intercept from lineitem group by 1, 2""",
    "unmixed_pixels": """with p as (select l_returnflag, l_extendedprice / 25 as s, l_quantity as b from lineitem), a as (select * from p where s > 0 and s < 4090 and b > 0 and b < 4090),
      c as (select * from a where b > (select median(b) from a)), d as (select * from c where s > (select median(s) from c) and s < 120 * b)
      select l_returnflag, count(*) as n, round(sum(greatest(0, s - 20 * b - 5 + 10)), 2) as total from d group by l_returnflag""",
    "least_squares_map": """with s as (select distinct spot_id, tx, ty, x, y from barcode_spots where spot_id is not null and x >= 0 and y >= 0),
      m as (select sum(tx * tx)::double as a, sum(tx * ty)::double as b, sum(tx)::double as c, sum(ty * ty)::double as d, sum(ty)::double as e, count(*)::double as f, sum(tx * x)::double as px, sum(ty * x)::double as qx, sum(x)::double as rx, sum(tx * y)::double as py, sum(ty * y)::double as qy, sum(y)::double as ry from s),
      v as (select *, a * (d * f - e * e) - b * (b * f - e * c) + c * (b * e - d * c) as det from m),
      u as (select 'x' as coordinate, *, px as p, qx as q, rx as r from v union all select 'y', *, py, qy, ry from v)
      select coordinate, round((p * (d * f - e * e) - b * (q * f - e * r) + c * (q * e - d * r)) / det, 4) as k_tx, round((a * (q * f - e * r) - p * (b * f - e * c) + c * (b * r - q * c)) / det, 4) as k_ty,
        round((a * (d * r - q * e) - b * (b * r - q * c) + p * (b * e - d * c)) / det, 4) as k_1 from u""",
}

"""Queries on spots: base calling, codebook, counts per cell and tile, score filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotloom.functions.arrays import hamming, indices, letters
from spotloom.functions.text_keys import gene_key, valid_score
from spotloom.operators import calling, counting
from spotloom.operators.spatial import located, points_in_boxes
from spotloom.plans.problems import SQL_GENE, sql_score, sql_sequence
from spotloom.session import Scratch
from spotloom.sources.tables import barcode_spots, codebook, gene_spots, once_per_spot, table

TILE = ["roi", "tx", "ty"]
GENE_SCORE, HYB_SCORE, CODE_LENGTH, MIN_COUNTS = 0.1, 0.8, 7, 10
ROUNDS = 16


def _traces(spark: SparkSession, folder: str) -> DataFrame:
    return once_per_spot(barcode_spots(spark, folder).where("trace is not null and sequence is not null"), "trace", "sequence")


def base_centroids(spark: SparkSession, folder: str) -> DataFrame:
    c = calling.base_centroids(_traces(spark, folder))
    return c.select("round", "base", *(F.round(f"c{k}", 4).alias(f"c{k}") for k in range(4)))


def basecall_sequence(spark: SparkSession, folder: str) -> DataFrame:
    t = Scratch(spark, "basecall").save(_traces(spark, folder))
    called = calling.call_bases(t, calling.centroid_cube(calling.base_centroids(t), ROUNDS), ["spot_id"])
    return called.where("called is not null").select("spot_id", F.col("called_bases").alias("bases"), F.round("called_mean_score", 5).alias("mean_score"))


def barcode_dot_score(spark: SparkSession, folder: str) -> DataFrame:
    t = Scratch(spark, "dot").save(_traces(spark, folder))
    s = calling.dot_product_scores(t, calling.centroid_cube(calling.base_centroids(t), ROUNDS), ["spot_id"])
    return s.where("score is not null").select("spot_id", F.round("score", 5).alias("score"))


def trace_normalised(spark: SparkSession, folder: str) -> DataFrame:
    n = calling.normalised_traces(_traces(spark, folder), "spot_id").where("trace is not null")
    return n.select("spot_id", F.round(F.aggregate(F.flatten("trace"), F.lit(0.0), lambda s, v: s + v), 4).alias("total"))


def sequence_letters(spark: SparkSession, folder: str) -> DataFrame:
    s = once_per_spot(barcode_spots(spark, folder).where("sequence is not null"), "sequence")
    t = letters(F.col("sequence"))
    return s.select("spot_id", t.alias("bases"), F.array_join(indices(t).cast("array<string>"), "").alias("digits"))


def _reads(spark: SparkSession, folder: str) -> DataFrame:
    return barcode_spots(spark, folder).select(F.substring("bases", 1, CODE_LENGTH).alias("seq"))


def nearest_codeword(spark: SparkSession, folder: str) -> DataFrame:
    return calling.nearest_codeword(_reads(spark, folder), codebook(spark, folder)).select("seq", "code", "gene", "distance")


def exact_codeword(spark: SparkSession, folder: str) -> DataFrame:
    n = calling.nearest_codeword(_reads(spark, folder), codebook(spark, folder))
    return n.where("distance = 0 and gene is not null").groupBy("gene").agg(F.count(F.lit(1)).alias("n"))


def codebook_hamming(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs of codewords by distance; the codebook is a fixed table."""
    c = codebook(spark, folder).select("ord", "seq")
    b = F.broadcast(c.select(F.col("ord").alias("o2"), F.col("seq").alias("s2")))
    return c.join(b, F.col("ord") < F.col("o2")).groupBy(hamming(F.col("seq"), F.col("s2")).alias("distance")).agg(F.count(F.lit(1)).alias("n"))


def gene_first_sequence(spark: SparkSession, folder: str) -> DataFrame:
    return codebook(spark, folder).where("gene is not null").groupBy("gene").agg(F.min_by("seq", "ord").alias("seq"))


def _gene_in_cells(spark: SparkSession, folder: str) -> DataFrame:
    g = once_per_spot(located(gene_spots(spark, folder)), "roi", "x", "y", "gene", valid_score(F.col("spot_score")).alias("score"))
    in_cell = points_in_boxes(g, table(spark, folder, "cells"))
    return in_cell.join(g.select("spot_id", "gene", "score"), "spot_id")


def count_spots_long(spark: SparkSession, folder: str) -> DataFrame:
    return counting.count_spots(_gene_in_cells(spark, folder), ["roi", "label"], "gene")


def segment_spots_filtered(spark: SparkSession, folder: str) -> DataFrame:
    spots = _gene_in_cells(spark, folder).where(F.col("score") > GENE_SCORE)
    return counting.count_spots(spots, ["roi", "label"], "gene").groupBy("roi", "label").agg(F.sum("n").alias("n_spots"), F.count(F.lit(1)).alias("n_genes"))


def _tile_genes(spark: SparkSession, folder: str) -> DataFrame:
    return counting.count_spots(once_per_spot(gene_spots(spark, folder), *TILE, "gene"), TILE, "gene")


def _hyb_genes(spark: SparkSession, folder: str) -> DataFrame:
    h = table(spark, folder, "hyb_spots").where((F.col("score") > HYB_SCORE) & ~F.isnan("score"))
    return counting.count_spots(once_per_spot(h, *TILE, gene_key(F.col("gene")).alias("gene")), TILE, "gene")


def fuse_genes_hyb(spark: SparkSession, folder: str) -> DataFrame:
    fused = counting.fuse_counts(_tile_genes(spark, folder), _hyb_genes(spark, folder), TILE, "gene")
    return fused.groupBy("gene").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_tiles"))


def count_pivot(spark: SparkSession, folder: str) -> DataFrame:
    """Spots per tile with one column for each of ten rois and one for all others."""
    spots = once_per_spot(gene_spots(spark, folder), *TILE)
    c = counting.count_spots(spots, ["tx", "ty"], "roi")
    return counting.pivot_counts(c, ["tx", "ty"], "roi", list(range(1, 11)), "roi_other").withColumnsRenamed({str(r): f"roi_{r}" for r in range(1, 11)})


def _tile_barcodes(spark: SparkSession, folder: str) -> DataFrame:
    return counting.count_spots(once_per_spot(barcode_spots(spark, folder), *TILE, "corrected_bases"), TILE, "corrected_bases")


def multiplicity(spark: SparkSession, folder: str) -> DataFrame:
    m = counting.multiplicity(_tile_barcodes(spark, folder), TILE, "corrected_bases")
    return m.select(*TILE, "total", "main", "n_main", F.round("share", 6).alias("share"))


def main_barcode_edit_profile(spark: SparkSession, folder: str) -> DataFrame:
    c = Scratch(spark, "profile").save(_tile_barcodes(spark, folder))
    p = counting.edit_profile(c, counting.multiplicity(c, TILE, "corrected_bases"), TILE, "corrected_bases")
    return p.groupBy("roi", "distance").agg(F.sum("n").alias("n"))


def tile_qc(spark: SparkSession, folder: str) -> DataFrame:
    """Normalised expression per gene over the tiles, the 20 most expressed."""
    v = counting.log_normalised(_tile_genes(spark, folder), TILE, 10.0, MIN_COUNTS)
    top = v.groupBy("gene").agg(F.count(F.lit(1)).alias("n_tiles"), F.round(F.avg("value"), 5).alias("mean_value"))
    return top.orderBy(F.desc("n_tiles"), "gene").limit(20)


def topk_genes(spark: SparkSession, folder: str) -> DataFrame:
    g = once_per_spot(gene_spots(spark, folder).where("gene is not null"), "gene")
    return g.groupBy("gene").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "gene").limit(20)


def ordinal_genes(spark: SparkSession, folder: str) -> DataFrame:
    return counting.ordinal_ids(gene_spots(spark, folder), "gene")


def score_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """Fixed bins of 0.05 from 0 to 1; the last bin is closed."""
    s = once_per_spot(gene_spots(spark, folder), "roi", valid_score(F.col("spot_score")).alias("score")).where("score is not null")
    return s.groupBy("roi", F.least(F.floor(F.col("score") * 20), F.lit(19)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def density_2d(spark: SparkSession, folder: str) -> DataFrame:
    s = once_per_spot(located(gene_spots(spark, folder)), "roi", "x", "y")
    return s.groupBy("roi", F.floor(F.col("y") / 500).cast("int").alias("by"), F.floor(F.col("x") / 500).cast("int").alias("bx")).agg(F.count(F.lit(1)).alias("n"))


def string_filters(spark: SparkSession, folder: str) -> DataFrame:
    g = once_per_spot(gene_spots(spark, folder).where(F.col("gene").startswith("s") & ~F.col("gene").contains("1") & F.col("gene").isNotNull()), "gene")
    return g.withColumn("number", F.regexp_replace("gene", r"\D", "")).withColumn("stem", F.regexp_extract("gene", r"^([a-z]+)", 1)).groupBy("stem", "number").agg(F.count(F.lit(1)).alias("n"))


def spots_near_tile_edge(spark: SparkSession, folder: str) -> DataFrame:
    """Half-open box filter, per roi."""
    s = once_per_spot(located(gene_spots(spark, folder)).where((F.col("x") >= 1000) & (F.col("x") < 5000) & (F.col("y") >= 2000) & (F.col("y") < 4000)), "roi", "x", "y")
    return s.groupBy("roi").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("x_min"), F.max("y").alias("y_max"))


QUERIES = {f.__name__: f for f in (
    base_centroids, basecall_sequence, barcode_dot_score, trace_normalised, sequence_letters, nearest_codeword, exact_codeword, codebook_hamming,
    gene_first_sequence, count_spots_long, segment_spots_filtered, fuse_genes_hyb, count_pivot, multiplicity, main_barcode_edit_profile, tile_qc,
    topk_genes, ordinal_genes, score_histogram, density_2d, string_filters, spots_near_tile_edge,
)}

_B = sql_sequence("bases")
_C = sql_sequence("corrected_bases")
_TRACES = """t0 as (select spot_id, any_value(trace) as trace, any_value(sequence) as sequence from barcode_spots where spot_id is not null and trace is not null and sequence is not null group by spot_id),
  t1 as (select spot_id, trace, sequence, unnest(range(len(trace)))::int as r from t0),
  t2 as (select spot_id, r as round, trace[r + 1] as t, sequence[r + 1] as base from t1),
  t as (select *, t[1] as a, t[2] as b, t[3] as c, t[4] as d, not (isnan(t[1]) or isnan(t[2]) or isnan(t[3]) or isnan(t[4])) and (t[1] <> 0 or t[2] <> 0 or t[3] <> 0 or t[4] <> 0) as ok from t2),
  m as (select round, base, avg(a) as c0, avg(b) as c1, avg(c) as c2, avg(d) as c3 from t where ok and base between 0 and 3 group by round, base)"""
_BOOK = f"book as (select trim(gii, chr(65279)) as gii, {sql_sequence('seq')} as seq, {SQL_GENE} as gene, ord from codebook)"
_READS = f"s as (select distinct substr({_B}, 1, {CODE_LENGTH}) as seq from barcode_spots where {_B} is not null)"
_NEAREST = f"""{_BOOK}, {_READS}, n as (select s.seq, arg_min(struct_pack(code := b.seq, gene := b.gene), hamming(s.seq, b.seq) * 1000000 + ord) as x, min(hamming(s.seq, b.seq)) as distance
  from s join book b on length(s.seq) = length(b.seq) group by s.seq)"""
_GENES = f"g as (select distinct spot_id, roi, tx, ty, x, y, {SQL_GENE} as gene, {sql_score('spot_score')} as score from gene_spots where spot_id is not null)"
_LOCATED = "l as (select * from g where x is not null and y is not null and not (x = -1 and y = -1))"
_IN_CELLS = f"{_GENES}, {_LOCATED}, k as (select l.*, label from l join cells c on l.roi = c.roi and l.y >= ymin and l.y < ymax and l.x >= xmin and l.x < xmax)"
_BARCODES = f"b as (select roi, tx, ty, {_C} as item, count(distinct spot_id) as n from barcode_spots where spot_id is not null and {_C} is not null and roi is not null and tx is not null and ty is not null group by all)"
_MAIN = "mx as (select roi, tx, ty, sum(n)::bigint as total, max(n) as n_main from b group by all), mn as (select mx.*, min(item) as main from mx join b using (roi, tx, ty) where n = n_main group by all)"
_TILE_GENES = "tg as (select roi, tx, ty, gene, count(*) as n from g where gene is not null and roi is not null and tx is not null and ty is not null group by all)"

ORACLES = {
    "base_centroids": f"with {_TRACES} select round, base, round(c0, 4) as c0, round(c1, 4) as c1, round(c2, 4) as c2, round(c3, 4) as c3 from m",
    "basecall_sequence": f"""with {_TRACES}, q as (select spot_id, t.round, m.base, (a*c0+b*c1+c*c2+d*c3) / (sqrt(a*a+b*b+c*c+d*d) * sqrt(c0*c0+c1*c1+c2*c2+c3*c3)) as cs from t join m on t.round = m.round where ok),
      w as (select spot_id, round, arg_max(base, cs) as base, max(cs) as cs from q group by all),
      e as (select t.spot_id, t.round, coalesce(w.base, 4) as base, coalesce(w.cs, 0) as cs from t left join w on t.spot_id = w.spot_id and t.round = w.round)
      select spot_id, string_agg(substr('GTACN', (base + 1)::int, 1), '' order by round) as bases, round(sum(cs) / count(*), 5) as mean_score from e group by spot_id""",
    "barcode_dot_score": f"""with {_TRACES}, good as (select spot_id from t group by spot_id having not bool_or(isnan(a) or isnan(b) or isnan(c) or isnan(d))),
      u as (select t.*, a - avg(a) over p as a2, b - avg(b) over p as b2, c - avg(c) over p as x2, d - avg(d) over p as d2 from t semi join good using (spot_id) where base between 0 and 3 window p as (partition by spot_id)),
      j as (select u.*, c0, c1, c2, c3 from u join m using (round, base))
      select spot_id, round(sum(a2*c0+b2*c1+x2*c2+d2*c3) / (sqrt(sum(a2*a2+b2*b2+x2*x2+d2*d2)) * sqrt(sum(c0*c0+c1*c1+c2*c2+c3*c3))), 5) as score from j group by spot_id having sum(a2*a2+b2*b2+x2*x2+d2*d2) > 0""",
    "trace_normalised": f"""with {_TRACES}, good as (select spot_id from t group by spot_id having not bool_or(isnan(a) or isnan(b) or isnan(c) or isnan(d))),
      u as (select * from t semi join good using (spot_id)), v as (select round, avg(a) as c0, avg(b) as c1, avg(c) as c2, avg(d) as c3 from u group by round),
      bright as (select spot_id from u group by spot_id having not bool_or(a = 0 and b = 0 and c = 0 and d = 0))
      select spot_id, round(sum(a/c0+b/c1+c/c2+d/c3), 4) as total from u join v using (round) semi join bright using (spot_id) group by spot_id""",
    "sequence_letters": """with s as (select spot_id, any_value(sequence) as sequence from barcode_spots where spot_id is not null and sequence is not null group by spot_id)
      select spot_id, list_aggregate(list_transform(sequence, lambda i: substr('GTACN', i + 1, 1)), 'string_agg', '') as bases, list_aggregate(list_transform(sequence, lambda i: i::varchar), 'string_agg', '') as digits from s""",
    "nearest_codeword": f"with {_NEAREST} select seq, x.code as code, x.gene as gene, distance::int as distance from n",
    "exact_codeword": f"with {_NEAREST} select x.gene as gene, count(*) as n from n where distance = 0 and x.gene is not null group by 1",
    "codebook_hamming": f"with {_BOOK} select hamming(a.seq, b.seq)::int as distance, count(*) as n from book a join book b on a.ord < b.ord group by 1",
    "gene_first_sequence": f"with {_BOOK} select gene, arg_min(seq, ord) as seq from book where gene is not null group by gene",
    "count_spots_long": f"with {_IN_CELLS} select roi, label, gene, count(*) as n from k where gene is not null group by all",
    "segment_spots_filtered": f"with {_IN_CELLS} select roi, label, count(*) as n_spots, count(distinct gene) as n_genes from k where gene is not null and score > {GENE_SCORE} group by roi, label",
    "fuse_genes_hyb": f"""with {_GENES}, {_TILE_GENES}, h as (select roi, tx, ty, {SQL_GENE} as gene, count(distinct spot_id) as n from hyb_spots where score > {HYB_SCORE} and not isnan(score) and {SQL_GENE} is not null and spot_id is not null group by all),
      f as (select * from tg anti join h using (gene) union all select * from h) select gene, sum(n)::bigint as n, count(*) as n_tiles from f group by gene""",
    "count_pivot": f"with {_GENES} select tx, ty, " + ", ".join(f"count(*) filter (where roi = {r}) as roi_{r}" for r in range(1, 11)) + ", count(*) filter (where roi not between 1 and 10) as roi_other from g where tx is not null and ty is not null and roi is not null group by tx, ty",
    "multiplicity": f"with {_BARCODES}, {_MAIN} select roi, tx, ty, total, main, n_main, round(n_main / total, 6) as share from mn",
    "main_barcode_edit_profile": f"with {_BARCODES}, {_MAIN} select roi, levenshtein(item, main)::int as distance, sum(n)::bigint as n from b join mn using (roi, tx, ty) group by 1, 2",
    "tile_qc": f"""with {_GENES}, {_TILE_GENES}, w as (select *, sum(n) over (partition by roi, tx, ty) as total from tg) select gene, count(*) as n_tiles, round(avg(ln(1 + n * 10.0 / total)), 5) as mean_value
      from w where total >= {MIN_COUNTS} group by gene order by n_tiles desc, gene limit 20""",
    "topk_genes": f"with {_GENES} select gene, count(*) as n from g where gene is not null group by gene order by n desc, gene limit 20",
    "ordinal_genes": f"with {_GENES} select distinct gene, dense_rank() over (order by gene) - 1 as ordinal from g where gene is not null",
    "score_histogram": f"with {_GENES} select roi, least(floor(score * 20), 19)::int as bin, count(*) as n from g where score is not null group by all",
    "density_2d": f"with {_GENES}, {_LOCATED} select roi, floor(y / 500)::int as by, floor(x / 500)::int as bx, count(*) as n from l group by all",
    "string_filters": f"with {_GENES} select regexp_extract(gene, '^([a-z]+)', 1) as stem, regexp_replace(gene, '\\D', '', 'g') as number, count(*) as n from g where starts_with(gene, 's') and not contains(gene, '1') group by all",
    "spots_near_tile_edge": f"with {_GENES}, {_LOCATED} select roi, count(*) as n, min(x) as x_min, max(y) as y_max from l where x >= 1000 and x < 5000 and y >= 2000 and y < 4000 group by roi",
}

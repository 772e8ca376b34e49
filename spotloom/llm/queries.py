"""Queries of the llm problems, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spotloom.functions.text_keys import valid_score
from spotloom.llm import clusters, components, heavy, leaks, packing, postings, quantiles, subjects
from spotloom.plans.problems import SQL_GENE, sql_score, sql_sequence
from spotloom.session import Scratch
from spotloom.sources.tables import barcode_spots, gene_spots, once_per_spot, table

# Problem 1

FIELDS = {"gene_spots.spot_score": (gene_spots, "spot_score"), "barcode_spots.dot_product_score": (barcode_spots, "dot_product_score")}
#: Least scores in a group, and (percentile, value below which it is reported).
LEAST_SCORES, LOW = 20, ((50, 0.45), (90, 0.70))


def _day_scores(spark: SparkSession, folder: str, field: str) -> DataFrame:
    """field, roi, call_day, score."""
    read, score = FIELDS[field]
    rows = read(spark, folder).withColumn("score", valid_score(F.col(score))).where("score is not null and roi is not null and called_at is not null")
    return once_per_spot(rows, "roi", F.to_date("called_at").alias("call_day"), "score").withColumn("field", F.lit(field))


def _day_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """field, roi, call_day, n, sketch."""
    out = None
    for field in FIELDS:
        s = quantiles.sketches(_day_scores(spark, folder, field), ["field", "roi", "call_day"], "score").withColumn("call_day", F.col("call_day").cast("string"))
        out = s if out is None else out.unionByName(s)
    return out


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Groups whose percentile lies below its limit. Where the limit lies within the bounds of a sketched percentile, the group's scores below
    the limit are counted."""
    q = quantiles.percentiles(_day_sketches(spark, folder).where(F.col("n") >= LEAST_SCORES), [p for p, _ in LOW])
    limit = F.lit(LOW[-1][1])
    for p, v in LOW[:-1]:
        limit = F.when(F.col("pct") == p, v).otherwise(limit)
    q = Scratch(spark, "p1").save(q.withColumn("limit", limit))
    open_ = (F.col("n") > quantiles.K) & (F.col("low") < F.col("limit")) & (F.col("high") >= F.col("limit"))
    found = q.where(~open_ & (F.col("value") < F.col("limit"))).select("field", "roi", "call_day", "pct")
    unsure = q.where(open_).select("field", "roi", "call_day", "pct", "limit", "n")
    for r in unsure.select("field").distinct().collect():
        rows = _day_scores(spark, folder, r["field"]).withColumn("call_day", F.col("call_day").cast("string"))
        below = rows.join(unsure, ["field", "roi", "call_day"]).groupBy("field", "roi", "call_day", "pct", "n").agg(F.count_if(F.col("score") < F.col("limit")).alias("below"))
        found = found.unionByName(below.where(F.col("below") >= F.ceil(F.col("pct") * F.col("n") / 100)).select("field", "roi", "call_day", "pct"))
    return found


def p1_roi_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Results of single days combined into results for each roi."""
    merged = quantiles.merge(_day_sketches(spark, folder), ["field", "roi"])
    return quantiles.percentiles(merged, [10, 25, 50, 75, 90, 99])


# Problem 3

FREQUENT = 0.005


def _sequences(spark: SparkSession, folder: str, scratch: Scratch) -> DataFrame:
    rows = once_per_spot(barcode_spots(spark, folder).where("corrected_bases is not null"), "corrected_bases")
    return scratch.save(rows.select("corrected_bases"))


def p3_frequent(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "p3")
    rows = _sequences(spark, folder, scratch)
    return heavy.frequent(rows, "corrected_bases", FREQUENT, scratch.save(heavy.sketch(rows, "corrected_bases")))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return p3_frequent(spark, folder).select("corrected_bases")


def p3_counts(spark: SparkSession, folder: str) -> DataFrame:
    return p3_frequent(spark, folder).select("corrected_bases", "n")


# Problem 4

RARE_TILES = 3
COMMON = {"gene": 0.85, "corrected_bases": 0.20}


def _tile_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    """field, item, n_occurrences (spots), n_records (tiles), total (tiles with spots in the table): a layout for each day of called_at, and
    the union of the days."""
    out = None
    for field, read in (("gene", gene_spots), ("corrected_bases", barcode_spots)):
        spots = once_per_spot(read(spark, folder), F.col(field).alias("item"), F.to_date("called_at").alias("day"), *postings.tile_bucket())
        tiles = spots.where("bucket is not null").select("bucket", "pos").distinct().agg(F.count(F.lit(1)).alias("total"))
        days = postings.layout(spots.withColumn("field", F.lit(field)), ["field", "day", "item"])
        f = postings.frequencies(postings.union(days, ["field", "item"]), ["field", "item"])
        f = f.withColumn("total", tiles.scalar())
        out = f if out is None else out.unionByName(f)
    return out


def _marked(spark: SparkSession, folder: str) -> DataFrame:
    share = F.when(F.col("field") == "gene", COMMON["gene"]).otherwise(COMMON["corrected_bases"])
    return postings.mark(_tile_frequencies(spark, folder), F.col("total"), RARE_TILES, share)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return _marked(spark, folder).where("mark is not null").select("field", "item", "mark")


def p4_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    return _marked(spark, folder).select("field", "item", F.col("n_occurrences").alias("n_spots"), F.col("n_records").alias("n_tiles"), "mark")


# Problem 5

CYCLES, CHANNELS, COSINE, LEAST_MEMBERS, TYPICAL = 12, 4, 0.91, 5, 3


def _clusters(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "p5")
    found = clusters.clusters(table(spark, folder, "hyb_spots"), "spot_id", "trace", CYCLES, CHANNELS, COSINE, LEAST_MEMBERS, scratch)
    return clusters.leads(found, scratch)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return _clusters(spark, folder).where("id <> lead").select(F.col("lead").alias("lead_id"), F.col("id").alias("spot_id"))


def p5_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Each cluster's size and its most typical spots: those nearest to the common mean."""
    c = _clusters(spark, folder)
    first = Window.partitionBy("lead").orderBy(F.desc(F.round("cosine", 9)), "id")  # limited to the first few of each cluster before the shuffle
    top = c.withColumn("place", F.row_number().over(first)).where(F.col("place") <= TYPICAL)
    return top.select(F.col("lead").alias("lead_id"), F.col("n").alias("size"), "place", F.col("id").alias("typical_id"), F.round("cosine", 4).alias("cosine"))


# Problem 7


def _links(spark: SparkSession, folder: str) -> DataFrame:
    """bases and corrected_bases of one row, where both are items of more than the letter N."""
    t = barcode_spots(spark, folder).select("bases", "corrected_bases")
    return t.where("bases <> corrected_bases and translate(bases, 'N', '') <> '' and translate(corrected_bases, 'N', '') <> ''")


def p7_groups(spark: SparkSession, folder: str) -> DataFrame:
    return components.groups(_links(spark, folder), "bases", "corrected_bases", Scratch(spark, "p7"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    g = p7_groups(spark, folder).where("member <> first")
    return g.select(F.col("first").alias("group_bases"), F.col("member").alias("member_bases"))


def p7_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """How many groups there are of each size."""
    firsts = p7_groups(spark, folder).where("member = first")
    return firsts.groupBy("size").agg(F.count(F.lit(1)).alias("n_groups"))


# Problem 8


def p8_containers(spark: SparkSession, folder: str) -> DataFrame:
    sizes = packing.token_counts(table(spark, folder, "documents").select("doc_id", "text"), "text")
    return packing.pack(sizes, "doc_id", "n_tokens", Scratch(spark, "p8"))


# Problem 9


def _leaks(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"), scratch=Scratch(spark, "p9"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return _leaks(spark, folder).select("doc_id", "item_id")


def p9_leaked_items(spark: SparkSession, folder: str) -> DataFrame:
    """Each item that leaked: into how many documents, and the longest stretch."""
    return _leaks(spark, folder).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_documents"), F.max("n_words").alias("n_words"))


# Problem 10


def _subjects(spark: SparkSession, folder: str) -> DataFrame:
    t = {n: table(spark, folder, n) for n in ("documents", "subject_areas", "subject_labels")}
    return subjects.subjects(t["documents"], t["subject_areas"], t["subject_labels"], Scratch(spark, "p10"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return _subjects(spark, folder).select("doc_id", "subject_code")


def p10_composition(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus by subject: documents that treat it, and the sum of their shares."""
    return _subjects(spark, folder).groupBy("subject_code").agg(F.count(F.lit(1)).alias("n_documents"), F.round(F.sum("share"), 3).alias("weight"))


QUERIES = {
    "p1_found": p1_found,
    "p1_roi_percentiles": p1_roi_percentiles,
    "p3_found": p3_found,
    "p3_counts": p3_counts,
    "p4_found": p4_found,
    "p4_frequencies": p4_frequencies,
    "p5_found": p5_found,
    "p5_clusters": p5_clusters,
    "p7_found": p7_found,
    "p7_sizes": p7_sizes,
    "p8_containers": p8_containers,
    "p9_found": p9_found,
    "p9_leaked_items": p9_leaked_items,
    "p10_found": p10_found,
    "p10_composition": p10_composition,
}


def _sql_scores(field: str) -> str:
    t, c = field.split(".")
    return f"select '{field}' as field, roi, strftime(d, '%Y-%m-%d') as call_day, s from (select distinct spot_id, roi, called_at::date as d, {sql_score(c)} as s from {t} where spot_id is not null and roi is not null and called_at is not null)"


_SQL_P1 = " union all ".join(map(_sql_scores, FIELDS))
_SQL_SEQ = f"select distinct spot_id, {sql_sequence('corrected_bases')} as corrected_bases from barcode_spots where spot_id is not null"


def _sql_tiles(field: str) -> str:
    t, item = ("gene_spots", SQL_GENE) if field == "gene" else ("barcode_spots", sql_sequence(field))
    s = f"select distinct spot_id, roi, tx, ty, {item} as item from {t} where spot_id is not null"
    return f"""select '{field}' as field, item, count(*) as n_spots, count(distinct (roi, tx, ty)) filter (where roi is not null and tx is not null and ty is not null) as n_tiles,
      case when n_tiles < {RARE_TILES} then 'rare' when n_tiles > {COMMON[field]} * (select count(distinct (roi, tx, ty)) from ({s}) where roi is not null and tx is not null and ty is not null) then 'common' end as mark
      from ({s}) where item is not null group by item"""


_SQL_P4 = " union all ".join(map(_sql_tiles, COMMON))
_SQL_P7 = f"""r as (select distinct {sql_sequence('bases')} as a, {sql_sequence('corrected_bases')} as b from barcode_spots),
  e as (select a, b from r where a <> b and replace(a, 'N', '') <> '' and replace(b, 'N', '') <> ''),
  s as (select a, b from e union select b, a from e),
  reach as (select a as m, a as x from s union select reach.m, s.b from reach join s on s.a = reach.x),
  g as (select m, min(x) as first, count(*) as size from reach group by m)"""

#: The channel bits of a pattern's letters, least share of a bright channel, least similarity and cosine.
_CYCLE = "list_sum([case when m[c] >= 0.5 * list_max(m) and list_max(m) > 0 then 2 ** (c - 1) else 0 end for c in range(1, 5)])::int"
_EQUAL = "list_sum([case when a.p[i] = b.p[i] and a.p[i] > 0 then 1 else 0 end for i in range(1, 13)])"
_BRIGHT = "list_sum([case when {t}.p[i] > 0 then 1 else 0 end for i in range(1, 13)])"
#: Every pair of patterns that share a third (patterns of similarity 0.8 differ in two cycles at most) is compared; groups are closures of
#: links; those with a member off the mean, which the operator would split, give no rows here.
_SQL_P5 = f"""t as (select spot_id, min([[case when isnan(x) then 0 else x end for x in r] for r in trace]) as t from hyb_spots where spot_id is not null and trace is not null group by spot_id),
  n0 as (select spot_id, t, flatten(t) as f from t), n1 as (select spot_id, t, f, sqrt(list_sum([x * x for x in f])) as size from n0),
  v as (select spot_id, [x / size for x in f] as unit, [{_CYCLE} for m in t] as p from n1 where size > 0),
  k as (select p, row_number() over (order by p) as k from (select distinct p from v)),
  parts as (select k, p, i, p[i * 4 + 1 : i * 4 + 4] as part from k, range(3) r(i)),
  pairs as (select distinct a.k as a, b.k as b from parts a join parts b on a.i = b.i and a.part = b.part and a.k < b.k where {_EQUAL} >= 0.8 * ({_BRIGHT.format(t='a')} + {_BRIGHT.format(t='b')} - {_EQUAL}) - 1e-9),
  s as (select a, b from pairs union select b, a from pairs),
  reach as (select k as m, k as x from k union select reach.m, s.b from reach join s on s.a = reach.x),
  g as (select m as k, min(x) as root from reach group by m),
  w as (select spot_id, unit, root from v join k using (p) join g using (k)),
  e as (select spot_id, root, unnest(unit) as x, unnest(range(48)) as d from w),
  mean as (select root, d, avg(x) as y from e group by root, d), norm as (select root, sqrt(sum(y * y)) as l from mean group by root),
  c as (select spot_id, root, sum(x * y) / any_value(l) as cosine from e join mean using (root, d) join norm using (root) group by spot_id, root),
  q as (select *, min(spot_id) over (partition by root) as lead_id, count(*) over (partition by root) as size, min(cosine) over (partition by root) as least from c)"""

ORACLES = {
    "p5_found": f"with recursive {_SQL_P5} select lead_id, spot_id from q where size >= {LEAST_MEMBERS} and least >= {COSINE} and spot_id <> lead_id",
    "p5_clusters": f"""with recursive {_SQL_P5}, o as (select *, row_number() over (partition by root order by round(cosine, 9) desc, spot_id) as place from q where size >= {LEAST_MEMBERS} and least >= {COSINE})
      select lead_id, size, place::int as place, spot_id as typical_id, round(cosine, 4) as cosine from o where place <= {TYPICAL}""",
    "p1_found": " union all ".join(
        f"select field, roi, call_day, {p} as pct from ({_SQL_P1}) where s is not null group by field, roi, call_day having count(*) >= {LEAST_SCORES} and quantile_disc(s, {p / 100}) < {v}" for p, v in LOW
    ),
    "p3_found": f"with s as ({_SQL_SEQ}) select corrected_bases from s where corrected_bases is not null group by 1 having count(*) >= {FREQUENT} * (select count(corrected_bases) from s)",
    "p3_counts": f"with s as ({_SQL_SEQ}) select corrected_bases, count(*) as n from s where corrected_bases is not null group by 1 having count(*) >= {FREQUENT} * (select count(corrected_bases) from s)",
    "p4_found": f"select field, item, mark from ({_SQL_P4}) where mark is not null",
    "p4_frequencies": _SQL_P4,
    "p7_found": f"with recursive {_SQL_P7} select first as group_bases, m as member_bases from g where m <> first",
    "p7_sizes": f"with recursive {_SQL_P7} select size, count(*) as n_groups from g where m = first group by size",
}

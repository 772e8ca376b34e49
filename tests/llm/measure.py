"""python tests/llm/measure.py [FOLDER...]: quality of problems 8 and 10 on whole tables.

For problem 10: rows of p10_found for hand-labelled documents against their labels (a few of which are wrong) where these labels took no part
in the fit: two runs, each with the labels of one half of the documents, measured on the other half.
"""

import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parents[2]))

from spotloom.llm import packing, queries, subjects  # noqa: E402
from spotloom.session import Scratch, get_spark  # noqa: E402
from spotloom.sources.tables import table  # noqa: E402


def main(folders: list[str]) -> None:
    spark = get_spark(8)
    spark.sparkContext.setLogLevel("ERROR")
    for folder in folders or ["/root/testdata/sf0.01", "/root/testdata/sf0.1"]:
        held = queries.p8_containers(spark, folder).where("container_id is not null").agg(F.sum("n_units").alias("n"), F.countDistinct("container_id").alias("c")).collect()[0]
        print(folder, f"p8: {held['n'] / (packing.CAPACITY * max(1, held['c'])):.4f} of {held['c']} containers filled", flush=True)
        docs, areas, labels = (table(spark, folder, n) for n in ("documents", "subject_areas", "subject_labels"))
        labels = labels.join(areas.select("subject_code"), "subject_code").select("doc_id", "subject_code").distinct()
        half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
        found = right = true = 0
        for k in (0, 1):
            got = subjects.subjects(docs, areas, labels.where(half == k), Scratch(spark, "measure")).where(half != k).select("doc_id", "subject_code")
            rest = labels.where(half != k)
            got = got.join(rest.select("doc_id").distinct(), "doc_id", "left_semi")
            found, right, true = found + got.count(), right + got.join(rest, ["doc_id", "subject_code"]).count(), true + rest.count()
        print(folder, f"p10, held-out hand labels: {true} labels, precision {right / max(1, found):.3f}, recall {right / max(1, true):.3f}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])

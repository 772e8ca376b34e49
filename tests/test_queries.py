"""Every query of the core against its SQL on the smallest tables; those without SQL have tests of their own."""

import importlib
from pathlib import Path

import pytest

import __spark_entry__ as entry
import verify

CORE = sorted(q for m in entry._CORE for q in importlib.import_module(m).QUERIES)
WITHOUT_SQL = {q: "test_estimates.py" for q in ("ransac_plane", "scaled_kmeans", "omp_decode", "embedding_pca", "gmm_cells")} | {"flat_field_fit": "test_stacks.py", "gene_leaf_order": "test_stacks.py"}


@pytest.mark.parametrize("name", [q for q in CORE if q not in WITHOUT_SQL])
def test_query(spark, duck, small, name):
    said = verify.compare(spark, duck, small, name)
    assert said.startswith("ok"), said


def test_queries_without_sql_have_tests():
    assert set(CORE) - set(entry.oracle_sql()) == set(WITHOUT_SQL)
    for name, file in WITHOUT_SQL.items():
        assert f"{file[5:-3]}.{name}(" in (Path(__file__).parent / file).read_text(), name


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "gene"


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())

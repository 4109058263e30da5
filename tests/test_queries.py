import duckdb
import numpy as np
import pytest

from talewright.operators import summary
from talewright.plans import views
from talewright.plans.queries import QUERIES, SQL

from .oracle import assert_same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    assert_same(spark, QUERIES[name], SQL[name], SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_flagship(spark):
    rows = summary.per_domain(views.records(spark, SF)).collect()
    assert rows and all(0 <= r["mean_wer"] <= 2 for r in rows)


def test_mono_rounds_as_sql(spark, tmp_path):
    """Halves of the twelfth digit after scaling, short and missing vectors, negative zeros, values that are no numbers."""
    nan, inf = float("nan"), float("inf")
    odd = [[0.40020206570625305, 0.97602862119674683], [-0.19171848893165588, -0.42840373516082764], [0.5], [], None, [-0.0, -0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1e30, 1.0], [1.0, 2.0, 3.0], [2.0**-12, 0.0]]
    rng = np.random.default_rng(3)
    vectors = odd + [[float(x) for x in v] for v in (rng.standard_normal((20_000, 16)) * 8).astype(np.float32)]
    spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    found = QUERIES["au1_to_mono"](spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert sorted((r["vec_id"], repr(r["mono"])) for r in found) == sorted((i, repr(m)) for i, m in con.sql(SQL["au1_to_mono"]).fetchall())


def test_pages_are_files_of_their_own(spark, tmp_path):
    """Repeated, negative and null ids, null and non-ASCII texts, the bound; files are put in place by tasks, not by a folder for each."""
    rows = [(5, "a"), (5, "bb"), (-7, None), (None, "é" * 3), (8, "x" * 2999), (9, "x" * 3000), (1234567, "two\nlines\n")]
    spark.createDataFrame(rows, "page_id long, html string").repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    found = QUERIES["src10_size_bound"](spark, str(tmp_path))
    folders = {f.rsplit("/", 2)[-2] for f in found.inputFiles()}
    assert len(folders) < len(rows) and not any("=" in f for f in folders)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, con.sql(SQL["src10_size_bound"]).fetchall()))

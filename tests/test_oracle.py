"""Registered queries against their DuckDB oracles on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "scripts"))

import __spark_entry__ as entry  # noqa: E402
from pricewise.plans import catalog  # noqa: E402
from check_oracle import TABLES, digest, tolerant_equal  # noqa: E402

SF = "/root/testdata/sf0.001"
MODEL = {"train_boosted_trees", "training_loss", "boost_confusion_matrix", "forecast_one_day", "evaluate_one_day"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = Path(SF) / f"{t}.parquet"
        if p.exists():
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle_or_is_model():
    q, s = catalog.plans(), catalog.oracle()  # without the corpus operators
    assert set(q) - set(s) == MODEL
    assert set(s) <= set(q)


@pytest.mark.parametrize("name", sorted(catalog.oracle()))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    if digest(sdf.columns, srows)[0] != digest(dcols, drows)[0]:
        assert tolerant_equal(sdf.columns, srows, dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "md" in df.columns and "inv_qty" in df.columns

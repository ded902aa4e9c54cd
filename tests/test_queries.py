"""Registered queries against their SQL on the smallest tables. FULL_CHECK=1 runs
all of them; tools/check.py does the same for any folder."""

import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_module  # noqa: E402
from tools.check import normal  # noqa: E402

FOLDER = Path("/root/testdata/sf0.001")
QUICK = [
    "gate_report", "score_attached_gold", "validate_labels", "trusted_export", "review_load_fraction",
    "synth_generate", "train_set", "extract_full", "retrain_cycle",
]
NAMES = list(entry_module.queries()) if os.environ.get("FULL_CHECK") else QUICK
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for p in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = entry_module.queries()[name](spark, str(FOLDER))
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        assert got[1]
        return
    result = con.execute(sql)
    assert got == normal([d[0] for d in result.description], result.fetchall())


def test_every_sql_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["model_name", "version", "pct_correct", "pct_fields", "n", "avg_seconds"]
    assert df.count() == 3

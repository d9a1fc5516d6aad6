"""Every registered query of the core against its SQL, on the driver's small tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from talkgrain import queries, rule_queries, run_queries, turn_queries  # noqa: F401 (their queries are registered with the others)

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def db():
    with duckdb.connect() as con:
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        yield con


def _plain(rows):
    return sorted(tuple(repr(round(v, 9)) if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.skipif(not os.path.exists(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, db, name):
    found = queries.QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    wanted = db.sql(queries.ORACLES[name])
    assert sorted(wanted.columns) == columns
    assert _plain(found.select(*columns).collect()) == _plain(wanted.select(*[f'"{c}"' for c in columns]).fetchall())


def test_entry_without_the_optional_part():
    """The driver's module imports, and has the core's queries, where the training-data operators are gone."""
    import subprocess
    import sys

    code = "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert not [k for k in e.queries() if k.startswith('op')] and len(e.queries()) > 30 and set(e.oracle_sql()) <= set(e.queries())"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, capture_output=True)

"""Queries beside their SQL on the smallest tables, and the promises of the entry point."""

import duckdb
import pytest

import __spark_entry__ as entry
from mergewell.plans import oracles, queries

LIGHT = (
    "normalize_records", "name_frequency", "script_profile", "match_histogram", "document_frequency", "candidate_union", "stage0_features", "context_features", "set_features",
    "string_features", "stage2_context", "stage2_siblings", "expected_f", "threshold_grid", "country_report", "validate", "candidate_lists",
)


def plain(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    value = lambda x: round(x, 8) + 0.0 if isinstance(x, float) else x
    return sorted((tuple(value(r[k]) for k in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", LIGHT)
def test_query(spark, sf_dir, name):
    got = queries.queries()[name](spark, sf_dir)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    want = con.execute(oracles.sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert plain([tuple(r) for r in got.collect()], got.columns) == plain(want.fetchall(), names)


def test_every_sql_has_a_query():
    assert set(oracles.sql()) <= set(queries.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())

import os

import pytest

import __spark_entry__ as entry
from contestlab import registry
from check_oracle import TABLES, table_of

SF_DIR = "/root/testdata/sf0.001"
CHECKED = ["match_features", "match_features_literal", "player_windows", "lineup_features", "player_record",
           "fixtures_from_pages", "append_distinct", "split_exact", "median_in_group", "standing"]


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.QUERIES) == set(registry.ORACLES)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the generated tables")
@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    df = entry.queries()[name](spark, SF_DIR)
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert table_of(df.columns, [tuple(r) for r in df.collect()]) == table_of(columns, cur.fetchall())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the generated tables")
def test_entry(spark):
    assert entry.entry(spark).count() > 0

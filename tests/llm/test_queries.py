import duckdb
import pytest

import __spark_entry__ as entry
from paysight.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator_and_the_pipeline():
    assert sorted(QUERIES) == sorted([*(q for n in range(1, 14) for q in QUERIES if q.startswith(f"op{n}_")), "pipeline"])
    assert len(QUERIES) == 14 and QUERIES.items() <= entry.queries().items()


def test_oracle_texts_are_sql():
    assert set(ORACLE) <= set(QUERIES) and all(isinstance(t, str) for t in entry.oracle_sql().values())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    expected = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(tuple, df.select(*cols).collect()), key=repr) == sorted(expected, key=repr)

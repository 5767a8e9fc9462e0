import duckdb
import pytest

from zonekeep.plans import queries as engine

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(engine.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = engine.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(str(r[c]) for c in columns) for r in df.collect())
    if name not in engine.ORACLES:
        assert got
        return
    out = duck.execute(engine.ORACLES[name])
    names = [d[0] for d in out.description]
    want = sorted(tuple(str(dict(zip(names, r, strict=True))[c]) for c in columns) for r in out.fetchall())
    assert sorted(names) == columns
    assert got == want


def test_entry(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark)
    assert rows.columns == ["domain", "unicode_domain", "first_seen_at", "last_seen_at", "source_count", "sources"]
    assert rows.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

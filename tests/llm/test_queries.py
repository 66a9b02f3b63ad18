import duckdb

from riskgrid.llm import queries

DATA = "/root/testdata/sf0.001"


def test_queries_with_sql_equal_it(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{DATA}/documents.parquet'")
    for name, sql in queries.ORACLES.items():
        df = queries.QUERIES[name](spark, DATA)
        result = con.execute(sql)
        assert [c[0] for c in result.description] == df.columns
        assert sorted(map(tuple, df.collect())) == sorted(result.fetchall())


def test_one_query_of_each_operator():
    numbers = sorted(int(name.split("_")[0][2:]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))

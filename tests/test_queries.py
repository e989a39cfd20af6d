"""Every query that has SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from lattica.operators import pattern
from lattica.plans.catalogue import QUERIES, SQL
from lattica.plans.projection import graph

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as from '{SF}/{t}.parquet'")
    return con


def cells(rows):
    return sorted(tuple(str(int(v) if isinstance(v, float) and v.is_integer() else v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(columns).collect()]
    if name in SQL:
        rel = duck.sql(SQL[name])
        assert sorted(rel.columns) == columns
        assert cells(got) == cells(rel.select(*[f'"{c}"' for c in columns]).fetchall())


def test_suppliers_apart_on_odd_tables(spark, duck, tmp_path):
    """Suppliers that no table knows, without or with two nations, repeated lines, nulls; as the SQL has them."""
    lines = [(p, s) for p in range(12) for s in range(40) if (7 * p + s * s) % 5 < 2] * 2 + [(0, 900), (0, 901), (3, 901), (None, 1), (4, None), (77, 5)]
    suppliers = [(s, f"s{s}", s % 4, 1.0) for s in range(30)] + [(30, "s30", None, 1.0), (31, "s31", None, 1.0), (5, "s5", 3, 2.0), (5, "s5", 3, 2.0)]
    frames = {
        "lineitem": spark.createDataFrame(lines, "l_partkey long, l_suppkey long"),
        "supplier": spark.createDataFrame(suppliers, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "customer": spark.createDataFrame([(1, "c", 2, 1.0, "x")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        **{t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("nation", "part", "region")},
    }
    con = duckdb.connect()
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
        con.sql(f"create view {name} as from '{tmp_path}/{name}.parquet/*.parquet'")
    want = cells(con.sql(SQL["not_exists_pattern"]).fetchall())
    got = QUERIES["not_exists_pattern"](spark, str(tmp_path))
    assert any("901" in r for r in want) and cells(got.select("id", "other").collect()) == want


def test_pairs_apart_in_any_number_of_blocks(spark):
    g = graph(spark, SF, ("Nation",), ("SUPPLIED_BY", "IN_NATION"))
    pairs = lambda **how: cells(pattern.pairs_apart(g, "Supplier", ("SUPPLIED_BY", "in"), ("IN_NATION", "out"), "s", "o", **how).select("s.id", "o.id").collect())
    want = pairs()
    assert want and pairs(blocks=1) == want and pairs(blocks=7, small=0) == want

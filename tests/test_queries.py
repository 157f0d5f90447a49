"""Every registered query of the record pipeline against its SQL, at the smallest size."""

import os

import pytest
from pyspark.sql import functions as F

from papyrine import queries

duckdb = pytest.importorskip("duckdb")
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple("" if r[i] is None else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    found = queries.QUERIES[name](spark, DATA)
    wanted = con.execute(queries.ORACLE[name])
    names = [d[0] for d in wanted.description]
    assert sorted(found.columns) == sorted(names)
    assert plain(found.collect(), found.columns) == plain(wanted.fetchall(), names)


def test_html_title_of_odd_pages(spark, tmp_path):
    heads = [
        "<h1>a&amp;&amp b&amp</h1>", "<h1>a&lt", "<h1>&amp;lt;&quot;&gt;&#39;&nbsp;&eacute;</h1>", "<h1 id='x'>a</h1><h1>b</h1>", "<H1>a</H1>", "<h1>a<b>b</b></h1>", "<h1></h1><h1>a</h1>", "<h1> \u00a0\u3000a  b\u2003 </h1>",
        "<h1>\ta \n</h1>", "<h1>a \r\n", "<!-- <h1>a</h1> --><h1>b</h1>", "<h1>a\nb", "<h1>", "<p>a</p>", "", None,
    ]
    spark.createDataFrame(list(enumerate(heads)), "page_id long, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    wanted = sorted(con.execute(queries.ORACLE["html_title"]).fetchall())
    assert sorted(tuple(r) for r in queries.html_title(spark, str(tmp_path)).collect()) == wanted
    assert wanted[0][1] == "a&&amp b&amp" and wanted[-1][1] is None


@pytest.mark.parametrize("name", ["html_mapper", "xml_mapper"])
def test_parsing_is_spread(spark, tmp_path, name):
    """However a table lies: one row group is one task of a scan."""
    spark.read.parquet(f"{DATA}/part.parquet").crossJoin(spark.range(5)).withColumn("p_partkey", F.col("p_partkey") * 5 + F.col("id")).drop("id").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    found = queries.QUERIES[name](spark, str(tmp_path))
    n = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert len(n) >= 4 and max(n) <= sum(n) / 4
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    wanted = con.execute(queries.ORACLE[name])
    names = [d[0] for d in wanted.description]
    assert plain(found.collect(), found.columns) == plain(wanted.fetchall(), names)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(queries.QUERIES) <= set(e.queries())

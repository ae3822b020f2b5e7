"""The registered queries that SQL can express, against DuckDB over whole tables."""

from __future__ import annotations

import duckdb
import pytest

from sheafwork.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    same, note = compare(spark, connect(SF_DIR), name, QUERIES[name], ORACLE_SQL[name], SF_DIR)
    assert same, note


def test_linked_hosts_match_sql(spark, tmp_path):
    """Scores over edges, at the production threshold; the test tables have no link between hosts."""
    link, pages = '<a href="http://{}/x">x</a>', []
    for k in range(3):
        pages.append((f"http://bad{k}.net/", None))
    pages.append(("http://one.com/", link.format("bad0.net")))
    pages.append(("http://many.com/", "".join(link.format(f"bad{k}.net") for k in range(3))))
    pages.append(("http://mixed.com/", link.format("bad1.net") + link.format("one.com") + link.format("many.com")))
    pages.append(("http://a.org/fr/1", link.format("bad2.net") + link.format("mixed.com")))
    table = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    table.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = {r[0]: r for r in con.execute(ORACLE_SQL["op4_host_graph"]).fetchall()}
    got = {r.page_id: tuple(r) for r in QUERIES["op4_host_graph"](spark, str(tmp_path)).collect()}
    assert got == want
    assert got[3][4] == "allow" and got[4][4] == "block"

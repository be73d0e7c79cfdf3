"""Registered queries of this package against their SQL."""

import duckdb
import pytest

from turnmill.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", ["op1_jaccard_join", "op2_chat_format", "op5_decontamination", "op8_url_filter"])
def test_query_matches_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for table in ("benchmark", "conversations", "documents", "pages"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result, expected = QUERIES[name](spark, sf_dir), duck.sql(ORACLE_SQL[name])
    columns = sorted(result.columns)
    assert columns == sorted(expected.columns)
    rows = [tuple(row) for row in result.select(*columns).collect()]
    assert sorted(rows, key=str) == sorted(expected.select(*columns).fetchall(), key=str)


def test_url_sql_on_edge_rows(spark, tmp_path):
    urls = [
        None, "", "no scheme", "http://", "http://Spam-Site.NET/a/?b=2&a=1&utm_x=3#f", "http://www.spam-site.net/a?a=1&b=2",
        "https://m.spam-site.net/a//?a=1&b=2&ref=z", "http://example.org/es/", "http://x.example.org/en/10", "http://org/",
        "http://a.COM/de/x", "http://a.com/fr/x?y", "http://a.com/de", "http://example.org?x://y/", "a\nb://h.org/p\nq",
        "http://pills.org/x", "http://other.net/a?a=1&b=2", "://spam/", "http://spam/?&&", "http://spam",
    ]
    rows = spark.createDataFrame(list(enumerate([*urls, *urls])), "page_id long, url string")
    rows.write.parquet(f"{tmp_path}/pages.parquet")
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    result, expected = QUERIES["op8_url_filter"](spark, str(tmp_path)), duck.sql(ORACLE_SQL["op8_url_filter"])
    found = [tuple(row) for row in result.collect()]
    assert result.columns == expected.columns
    assert sorted(found, key=lambda row: row[0]) == sorted(expected.fetchall(), key=lambda row: row[0])
    assert {row[4] for row in found} == {"allow", "block"}

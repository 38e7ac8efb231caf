from solospan.sources import jdbc, sinks


def test_jdbc_options_and_ddl():
    o = jdbc.jdbc_options("jdbc:derby:memory:x", "input", user="u", fetchsize=500)
    assert o["url"] == "jdbc:derby:memory:x" and o["dbtable"] == "input" and o["user"] == "u"
    assert o["fetchsize"] == "500"
    assert "`set_id` int NOT NULL" in jdbc.DDL and "`begin` bigint NOT NULL" in jdbc.DDL


def test_listing_and_documents_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, 16909060, 16909061), (1, 1, 2)], "set_id bigint, begin bigint, end bigint")
    out = str(tmp_path / "listing")
    sinks.write_listing(sinks.numbered_listing(df, strategy="window"), out)
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert lines == ["1\t0.0.0.1, 0.0.0.2", "2\t1.2.3.4, 1.2.3.5"]
    assert sinks.write_documents(df, "  ") is False
    view = sinks.register_readable_view(df, "soutput")
    assert spark.sql("select count(*) c from soutput where sbegin = '1.2.3.4'").first().c == 1


def test_write_ranges_keeps_the_table_schema(spark, tmp_path):
    import pytest

    df = spark.createDataFrame([(3, 1, 2), (4, 5, 9)], "set_id bigint, begin int, end int")
    out = str(tmp_path / "t")
    sinks.write_ranges(df, path=out)
    back = spark.read.parquet(out)
    assert dict(back.dtypes) == {"set_id": "int", "begin": "bigint", "end": "bigint"}
    assert back.count() == 2
    with pytest.raises(Exception, match="NOT NULL"):
        sinks.write_ranges(spark.createDataFrame([(1, None, 2)], "set_id int, begin bigint, end bigint"), path=out)


def test_write_ranges_hashed_layout(spark, tmp_path):
    df = spark.createDataFrame([(s, s, s + 1) for s in range(100)], "set_id bigint, begin bigint, end bigint")
    out = str(tmp_path / "h")
    sinks.write_ranges(df, path=out, layout="hashed", hash_partitions=4)
    back = spark.read.parquet(out)
    assert back.count() == 100
    assert back.select("set_hash").distinct().count() <= 4

import pytest
from pyspark.sql import functions as F

from solospan.functions.ipv4 import ip4_text, parse_ip4
from solospan.operators.exclusive import exclusive_ranges
from solospan.sources import text
from solospan.sources.sinks import readable_ranges

LINES = [
    ("1.2.3.4,1.2.3.5,,", 16909060, 16909061, None),
    ("1.2.3.4.,1.2.3.5", 16909060, 16909061, None),
    ("+1.2.3.4,1.2.3.5", 16909060, 16909061, None),
    ("\t1.2.3.4 , 1.2.3.5", 16909060, 16909061, None),
    ("-0.2.3.4,1.2.3.4", 131844, 16909060, None),
    ("1.2.3.4,1.2.3.5\r", 16909060, 16909061, None),
    ("1.2.3.4,1.2.3.5,x", None, None, "malformed"),
    (",1.2.3.4,1.2.3.5", None, None, "malformed"),
    ("", None, None, "malformed"),
    (",", None, None, "malformed"),
    ("01.2.3.4,1.2.3.256", None, None, "malformed"),
    ("1. 2.3.4,1.2.3.5", None, None, "malformed"),
    ("1.2.3,1.2.3.4", None, None, "malformed"),
    ("1..3.4,1.2.3.4", None, None, "malformed"),
    ("-1.2.3.4,1.2.3.4", None, None, "malformed"),
    ("99999999999999999999.1.1.1,1.2.3.4", None, None, "malformed"),
    ("1.2.3.4 .,1.2.3.5", None, None, "malformed"),
    ("9.0.0.0,1.0.0.0", 150994944, 16777216, "reversed"),
]

SAMPLE = [
    "197.203.0.0, 197.206.9.255",
    "197.204.0.0,197.204.0.24",
    "201.233.7.160, 201.233.7.168",
    "201.233.7.164, 201.233.7.168",
    "201.233.7.167, 201.233.7.167",
    "203.133.0.0, 203.133.255.255",
]


def test_parser_lines(spark):
    df = spark.createDataFrame([(i, l) for i, (l, *_rest) in enumerate(LINES)], "i int, line string")
    got = {r.i: (r.begin, r.end, r.reason) for r in text.parse_range_lines(df).collect()}
    for i, (line, b, e, reason) in enumerate(LINES):
        if reason == "malformed":
            assert got[i][2] == "malformed", line
        else:
            assert got[i] == (b, e, reason), line


def test_single_expression_parser_agrees(spark):
    df = spark.createDataFrame([(a,) for a in ["1.2.3.4", " 255.255.255.255.", "256.1.1.1", "0.0.0.0", "a.b.c.d", None]], "t string")
    got = [r.v for r in df.select(parse_ip4("t").alias("v")).collect()]
    assert got == [16909060, 4294967295, None, 0, None, None]


def test_ip4_text_round_trip_and_range(spark):
    df = spark.createDataFrame([(0,), (16909060,), (4294967295,), (4294967296,), (-1,)], "x bigint")
    got = [r.t for r in df.select(ip4_text("x").alias("t")).collect()]
    assert got == ["0.0.0.0", "1.2.3.4", "255.255.255.255", None, None]


def test_sample_file_end_to_end(spark, tmp_path):
    p = tmp_path / "input.txt"
    p.write_text("\n".join(SAMPLE + ["garbage line", "9.0.0.0, 1.0.0.0"]) + "\n")
    ranges, rejects = text.read_range_text(spark, str(p), set_id=1)
    out = readable_ranges(exclusive_ranges(ranges)).orderBy("sbegin").collect()
    assert [(r.sbegin, r.send) for r in out] == [
        ("197.203.0.0", "197.203.255.255"),
        ("197.204.0.25", "197.206.9.255"),
        ("201.233.7.160", "201.233.7.163"),
        ("203.133.0.0", "203.133.255.255"),
    ]
    assert sorted((r.line, r.reason) for r in rejects.collect()) == [
        ("9.0.0.0, 1.0.0.0", "reversed"),
        ("garbage line", "malformed"),
    ]


def test_pairs_source_strict_and_drop(spark):
    pairs = [(a.split(",")[0], a.split(",")[1]) for a in SAMPLE]
    df = text.ranges_from_pairs(spark, pairs)
    assert df.count() == 6
    with pytest.raises(Exception, match="Wrong input range"):
        text.ranges_from_pairs(spark, pairs + [("1.2.3", "1.2.3.4")]).collect()
    assert text.ranges_from_pairs(spark, pairs + [("1.2.3", "1.2.3.4")], on_error="drop").count() == 6


def test_empty_source(spark):
    e = text.empty_ranges(spark)
    assert e.count() == 0
    assert exclusive_ranges(e, strategy="window").count() == 0
    assert exclusive_ranges(e).count() == 0


def test_strict_text_source_fails_on_reversed(spark, tmp_path):
    p = tmp_path / "r.txt"
    p.write_text("1.2.3.4, 1.2.3.9\n9.0.0.0, 1.0.0.0\nnot a range\n")
    ranges, rejects = text.read_range_text(spark, str(p))
    assert ranges.count() == 1 and rejects.count() == 2
    strict, _ = text.read_range_text(spark, str(p), strict=True)
    with pytest.raises(Exception, match="Reversed range"):
        strict.collect()
    ok = tmp_path / "ok.txt"
    ok.write_text("1.2.3.4, 1.2.3.9\ngarbage\n")
    assert text.read_range_text(spark, str(ok), strict=True)[0].count() == 1


def test_bucket_arithmetic(spark):
    from solospan.functions.buckets import bucket_of, junctions

    df = spark.createDataFrame([(-17,), (-16,), (-1,), (0,), (15,), (16,)], "x bigint")
    got = [r.b for r in df.select(bucket_of("x", 16).alias("b")).collect()]
    assert got == [-2, -1, -1, 0, 0, 1]
    left, right = junctions(F.lit(3), 16)
    r = spark.range(1).select(left.alias("l"), right.alias("r")).first()
    assert (r.l, r.r) == (47, 48)


@pytest.mark.parametrize("on_error", ["drop", "raise"])
def test_pairs_source_parses_each_address_once(spark, on_error):
    pairs = spark.range(4).select(
        ip4_text(F.col("id") * 3).alias("begin_text"), F.when(F.col("id") >= 0, ip4_text(F.col("id") * 5)).otherwise("x").alias("end_text")
    )
    df = text.ranges_from_pair_columns(pairs, on_error=on_error)
    assert sorted(map(tuple, df.collect())) == [(0, 0), (3, 5), (6, 10), (9, 15)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 2 and plan.count("regexp_replace") == 4, plan


def test_pairs_source_drops_or_refuses_whatever_is_read(spark):
    rows = [("1.2.3.4", "1.2.3.9"), ("9.0.0.0", "1.0.0.0"), ("9.0.0.0", "1.0.0.0"), ("x", "1.2.3.4"), ("1.2.3.4", None), (None, None)]
    df = spark.createDataFrame(rows, "b string, e string")
    kept = text.ranges_from_pair_columns(df, "b", "e", on_error="drop")
    assert sorted(map(tuple, kept.collect())) == [(16909060, 16909065), (150994944, 16777216), (150994944, 16777216)]
    assert kept.count() == 3 and kept.where("begin > end").count() == 2
    refused = text.ranges_from_pair_columns(df, "b", "e")
    for read in (refused, refused.select("begin"), refused.where("begin < 0")):
        with pytest.raises(Exception, match="USER_RAISED_EXCEPTION"):
            read.count()

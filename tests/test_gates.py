"""Modes that refuse bad input fail whatever is read of the result."""

import pytest
from pyspark.sql import functions as F

from solospan.functions.checks import refuse
from solospan.operators import exclusive
from solospan.sources import derived, sinks, text

READS = {
    "count": lambda df: df.count(),
    "one column": lambda df: df.select(df.columns[-1]).collect(),
    "group": lambda df: df.groupBy(df.columns[0]).count().collect(),
}
SET_READS = {**READS, "filter": lambda df: df.where("set_id = 0").collect()}
SCHEMA = "set_id bigint, seq bigint, begin bigint, end bigint"


@pytest.mark.parametrize("read", SET_READS)
def test_presorted_gate(spark, read):
    df = spark.createDataFrame([(0, 1, 1, 2), (1, 2, 9, 9), (1, 3, 5, 6)], SCHEMA)
    with pytest.raises(Exception, match="Order violation"):
        SET_READS[read](exclusive.exclusive_ranges_presorted(df, "seq"))


@pytest.mark.parametrize("read", READS)
def test_bad_pairs(spark, read):
    with pytest.raises(Exception, match="Wrong input range"):
        READS[read](text.ranges_from_pairs(spark, [("1.2.3.4", "1.2.3.5"), ("x", "1.2.3.4")]))


@pytest.mark.parametrize("read", READS)
def test_reversed_listing(spark, read):
    df = spark.createDataFrame([(0, 1, 1, 2), (0, 2, 9, 5)], SCHEMA)
    with pytest.raises(Exception, match="Reversed range"):
        READS[read](sinks.numbered_listing(df, on_reversed="raise"))


def test_refuse_keeps_good_rows(spark):
    df = spark.range(5)
    assert refuse(df, F.col("id") < 0, F.lit("no")).count() == 5
    assert refuse(df, F.lit(None).cast("boolean"), F.lit("no")).count() == 5


@pytest.mark.parametrize("line", ["1.2.3.4,1.2.3.5\u0085", "1.2.3.4\u2028,1.2.3.5", "1.2.3.4,1.2.3.5\u2029", "1.2.3.4,1.2.3.5,,\r"])
def test_odd_line_ends_are_malformed(spark, line):
    row = text.parse_range_lines(spark.createDataFrame([(line,)], "line string")).first()
    assert (row.begin, row.end, row.reason) == (None, None, "malformed")


def test_spread_has_no_overflow(spark):
    keys = [0, 1, 7, 3758096383, 3758096384, 10**12 + 7, 10**18 + 11, 9 * 10**18]
    got = [r.x for r in spark.createDataFrame([(k,) for k in keys], "k bigint").select(derived.spread(F.col("k")).alias("x")).collect()]
    assert got == [k * 2654435761 % 3758096384 for k in keys]

"""Registered queries over the driver tables and their DuckDB oracle SQL.

Every query reads the parquet tables of ``sf_dir`` whole (inputs derived as in
FIXTURES.md section 3).  The oracle SQL states the same result independently:
exclusive ranges and coverage by counting, per elementary segment, the ranges
that contain it (no running sum).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from solospan.functions.buckets import IP4_BUCKET_WIDTH, bucket_of, idiv
from solospan.functions.ipv4 import ip4_text, ip4_text_sql
from solospan.functions.sql import register_sql_functions
from solospan.operators import audit, cutting, events, exclusive, sets, stabbing
from solospan.schema import RANGES_SCHEMA
from solospan.session import ensure_checkpoint_dir
from solospan.sources import derived, generate, sinks, text
from solospan.sources.committed import CommittedTable
from solospan.streaming.incremental import RangeStore
from solospan.streaming.publish import publish

# Widths used by the registered queries: 2**16 cuts the IPv4 inputs often
# enough to matter, 4 cuts the small grid domain (values 0..64).
CUT_WIDTH = 65536
GRID_WIDTH = 4
# Per-task row target that forces the bucketed plan on the small test tables.
SMALL_TARGET = 1000
WEEK = 7 * 86400

Query = Callable[[SparkSession, str], DataFrame]


def _lines(spark, sf):
    return text.parse_range_lines(derived.range_lines(spark, sf))


def _lines_kept(spark, sf):
    """Parsed lines with the reversed ones kept (malformed left out)."""
    return text.parsed_ranges(_lines(spark, sf), keep=("event_id", "set_id"))


def _grid_exclusive(spark, sf, **kw):
    return exclusive.exclusive_ranges(derived.grid_ranges(spark, sf), **kw)


def _glue(spark, sf):
    grid = derived.grid_ranges(spark, sf)
    pieces = cutting.cut_at_buckets(grid, GRID_WIDTH)
    res = exclusive.exclusive_ranges(pieces.drop("bucket"))
    return cutting.glue_ranges(res, cutting.glue_points(grid, GRID_WIDTH), GRID_WIDTH)


def _synthetic20(spark, sf):
    """Generated IPv4 ranges (long, heavily overlapping) in 20 numbered sets,
    one range per order."""
    o = derived.table(spark, sf, "orders")
    return generate.synthetic_ranges(o.withColumn("_set", o["o_custkey"] % 20 + 1), "o_orderkey", "_set")


def _ip16(spark, sf):
    return derived.ip_ranges(spark, sf, sets=16)


def _scratch(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _incremental(spark, sf):
    """Every event span taken in, in two batches; the second touches cells of the first."""
    spans = derived.event_spans(spark, sf)
    store = RangeStore(spark, _scratch(spark, "ranges"), width=WEEK)
    for i in (0, 1):
        store.apply(spans.where(F.col("event_id") % 2 == i), i)
    out = store.exclusive_ranges().checkpoint()
    store.drop()
    return out


def _sorted_files(spark, sf):
    """The event spans written as sorted files, and these swept one by one."""
    table = CommittedTable(spark, _scratch(spark, "sorted"), "")
    exclusive.write_sorted_ranges(derived.event_spans(spark, sf), table.path)
    out = exclusive.exclusive_ranges_of_sorted(spark, table.path)  # stored: the files are read
    table.drop()
    return out


def _range_table(spark, sf):
    """The IPv4 ranges written as a range table and read again."""
    table = CommittedTable(spark, _scratch(spark, "table"), "")
    sinks.write_ranges(_ip16(spark, sf), path=table.path, layout="hashed", hash_partitions=8)
    out = spark.read.schema(RANGES_SCHEMA).parquet(table.path).select(*RANGES_SCHEMA.names).checkpoint()
    table.drop()
    return out


def _runs(spark, sf):
    spans = derived.event_spans(spark, sf)
    return events.consecutive_runs(spans.withColumn("quarter", idiv(F.col("end") - F.col("begin"), 21600)), "event_id", "quarter")


def _numbered_sets(spark, sf):
    """Text lines of many sources, numbered behind the sets of another table, solved in one plan."""
    lines = derived.range_lines(spark, sf).withColumn("source", F.concat(F.lit("in/"), (F.col("event_id") % 53).cast("string"), F.lit(".txt")))
    numbered = sets.number_sets(lines, first=sets.next_set_id(derived.grid_ranges(spark, sf)))
    return exclusive.exclusive_ranges(text.good_ranges(text.parse_range_lines(numbered), keep=("set_id",)))


def _digests(spark, sf):
    grid = derived.grid_ranges(spark, sf)
    cell = {"set_id": F.col("set_id"), "bucket": bucket_of("begin", 16)}
    return sets.digest_summary(_grid_exclusive(spark, sf, strategy="window"), cutting.exclusive_by_cutting(grid, GRID_WIDTH), cell)


def _observed(spark, sf):
    """The numbers that the observation has after the result was read once."""
    result, seen = audit.observed_exclusive_ranges(derived.grid_ranges(spark, sf))
    result.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([seen.get], "n_ranges bigint, n_ends bigint, n_points bigint, min_level bigint, final_level bigint, n_exclusive bigint")


def _sql_functions(spark, sf):
    register_sql_functions(spark, "solospan_")
    return spark.sql(
        """select set_id, solospan_ip4_text(begin) as sbegin, solospan_ip4_value(solospan_ip4_text(end)) as end,
                  solospan_bucket_of(begin) as bucket, solospan_left_of_edge(solospan_bucket_of(end, 65536), 65536) as left_point,
                  solospan_right_of_edge(solospan_bucket_of(end, 65536), 65536) as right_point
           from {ranges}""",
        ranges=_ip16(spark, sf),
    )


def _pairs(spark, sf):
    """Well-formed pairs of texts."""
    ranges = _ip16(spark, sf)
    pairs = ranges.select(ip4_text("begin").alias("begin_text"), F.when(F.col("begin") % 7 > 0, ip4_text("end")).otherwise("no address").alias("end_text"))
    return text.ranges_from_pair_columns(pairs, on_error="drop")


def _published(spark, sf):
    return publish(derived.ip_ranges(spark, sf, sets=None).select("begin", "end"), 3).withColumn("set_id", F.col("set_id").cast("bigint"))


QUERIES: dict[str, Query] = {
    # A1/B1/C1/C2: text source and rejects
    "parse_ranges": lambda s, sf: text.good_ranges(_lines(s, sf), keep=("event_id", "set_id")),
    "parse_rejects": lambda s, sf: text.rejected_lines(_lines(s, sf), keep=("event_id", "set_id")),
    # B2/B3, A7, A8: readable forms
    "readable_ranges": lambda s, sf: sinks.readable_ranges(_ip16(s, sf)),
    "range_documents": lambda s, sf: sinks.range_documents(_ip16(s, sf)),
    "numbered_listing": lambda s, sf: sinks.numbered_listing(_ip16(s, sf)),
    "numbered_listing_bucketed": lambda s, sf: sinks.numbered_listing(
        derived.ip_ranges(s, sf, sets=None), strategy="bucketed", target_rows=SMALL_TARGET
    ),
    "numbered_listing_skewed": lambda s, sf: sinks.numbered_listing(
        derived.skewed_ranges(s, sf), strategy="bucketed", target_rows=SMALL_TARGET
    ),
    # A3: generator (hash mode over order keys)
    "synthetic_ranges": lambda s, sf: generate.synthetic_ranges(
        derived.table(s, sf, "orders"), "o_orderkey", "o_custkey"
    ),
    # B4/B5, C7, D5, D6
    "bucket_of": lambda s, sf: _ip16(s, sf).select(
        "set_id",
        "begin",
        "end",
        bucket_of("begin", IP4_BUCKET_WIDTH).alias("bucket_begin"),
        bucket_of("end", IP4_BUCKET_WIDTH).alias("bucket_end"),
    ),
    "cut_at_buckets": lambda s, sf: cutting.cut_at_buckets(_ip16(s, sf), CUT_WIDTH),
    "glue_points": lambda s, sf: cutting.glue_points(_ip16(s, sf), CUT_WIDTH),
    "edge_ranges": lambda s, sf: cutting.edge_ranges(
        cutting.cut_at_buckets(_ip16(s, sf), CUT_WIDTH).drop("bucket"), CUT_WIDTH
    ),
    "bucket_layout": lambda s, sf: cutting.bucket_layout(_ip16(s, sf), IP4_BUCKET_WIDTH),
    "zorder_layout": lambda s, sf: cutting.zorder_layout(_ip16(s, sf)),
    # D1, F1-F3, F5, D2, G6
    "endpoint_events": lambda s, sf: events.endpoint_events(derived.grid_ranges(s, sf)),
    "endpoint_totals": lambda s, sf: events.endpoint_totals(derived.grid_ranges(s, sf)),
    "end_counts": lambda s, sf: events.end_counts(derived.grid_ranges(s, sf)),
    "ends_by_begin": lambda s, sf: events.ends_by_begin(derived.grid_ranges(s, sf)),
    "begin_counts": lambda s, sf: events.begin_counts(derived.grid_ranges(s, sf)),
    "coverage_depth": lambda s, sf: events.coverage_depth(derived.grid_ranges(s, sf)),
    "coverage_depth_bucketed": lambda s, sf: events.coverage_depth(
        derived.ip_ranges(s, sf, sets=None), strategy="bucketed", target_rows=SMALL_TARGET
    ),
    "coverage_depth_skewed": lambda s, sf: events.coverage_depth(
        derived.skewed_ranges(s, sf), strategy="bucketed", target_rows=SMALL_TARGET * 4
    ),
    "invalid_ranges": lambda s, sf: events.invalid_ranges(_lines_kept(s, sf)),
    "open_ranges": lambda s, sf: events.open_ranges(derived.grid_ranges(s, sf)),
    # D3, D4, D8
    "exclusive_ranges": lambda s, sf: _grid_exclusive(s, sf),
    "exclusive_ranges_window": lambda s, sf: _grid_exclusive(s, sf, strategy="window"),
    "exclusive_ranges_ip": lambda s, sf: exclusive.exclusive_ranges(_ip16(s, sf)),
    "exclusive_ranges_events": lambda s, sf: exclusive.exclusive_ranges(
        derived.event_spans(s, sf).drop("event_id")
    ),
    "exclusive_ranges_bucketed": lambda s, sf: exclusive.exclusive_ranges_bucketed(
        derived.ip_ranges(s, sf, sets=None), target_rows=SMALL_TARGET
    ),
    "exclusive_ranges_skewed": lambda s, sf: exclusive.exclusive_ranges(
        derived.skewed_ranges(s, sf), target_rows=SMALL_TARGET * 4
    ),
    "exclusive_ranges_synthetic": lambda s, sf: exclusive.exclusive_ranges(_synthetic20(s, sf)),
    "exclusive_ranges_sorted_files": _sorted_files,
    "exclusive_ranges_presorted": lambda s, sf: exclusive.exclusive_ranges_presorted(
        derived.event_spans(s, sf), seq="event_id"
    ),
    # D7, D9
    "glue_ranges": _glue,
    "merge_touching": lambda s, sf: cutting.merge_touching(_grid_exclusive(s, sf)),
    # C3-C5
    "order_violations": lambda s, sf: audit.order_violations(derived.event_spans(s, sf), "event_id", "end"),
    "interval_order_violations": lambda s, sf: audit.interval_order_violations(_lines_kept(s, sf), "event_id"),
    "balance_audit": lambda s, sf: audit.balance_audit(_lines_kept(s, sf).drop("event_id")),
    # H3, F4, I2
    "cross_check": lambda s, sf: sets.cross_check_summary(
        _grid_exclusive(s, sf, strategy="window"),
        exclusive.exclusive_ranges_by_level(derived.grid_ranges(s, sf), strategy="bucketed", target_rows=SMALL_TARGET // 10),
    ),
    "cross_check_digest": _digests,
    "next_set_id": lambda s, sf: sets.next_set_id(derived.grid_ranges(s, sf)),
    # A2, A10, B6, E2, F2, G6, I1, J; C5 as rows pass
    "range_pairs": _pairs,
    "range_table": _range_table,
    "with_set_id": lambda s, sf: sets.with_set_id(derived.grid_ranges(s, sf).drop("set_id"), 7),
    "numbered_sets": _numbered_sets,
    "consecutive_runs": _runs,
    "open_range_rows": lambda s, sf: stabbing.open_range_rows(derived.grid_ranges(s, sf), width=GRID_WIDTH),
    "exclusive_ranges_incremental": _incremental,
    "published_ranges": _published,
    "observed_audit": _observed,
    "sql_functions": _sql_functions,
    "replicate_rows": lambda s, sf: sets.replicate_rows(derived.grid_ranges(s, sf), 3),
}


# ---------------------------------------------------------------- oracle SQL

GRID = """select o_custkey as set_id, (o_orderkey * 7919) % 61 as begin,
       (o_orderkey * 7919) % 61 + (o_orderkey % 5) as "end" from orders"""

IP16 = """select l_suppkey % 16 as set_id,
       (l_orderkey * 2654435761 + l_linenumber * 40503) % 3758096384 as begin,
       (l_orderkey * 2654435761 + l_linenumber * 40503) % 3758096384
         + cast(floor(l_extendedprice) as bigint) % 131072 as "end" from lineitem"""

IP1 = IP16.replace("l_suppkey % 16", "cast(0 as bigint)", 1)

SKEWED = """select case when l_orderkey % 3 = 0 then 0 else l_suppkey % 16 + 1 end as set_id,
       case when l_orderkey % 3 = 0 and l_linenumber = 1 then 167772160
            else (l_orderkey * 2654435761 + l_linenumber * 40503) % 3758096384 end as begin,
       case when l_orderkey % 3 = 0 and l_linenumber = 1 then 167772160
            else (l_orderkey * 2654435761 + l_linenumber * 40503) % 3758096384 end
         + cast(floor(l_extendedprice) as bigint) % 131072 as "end" from lineitem"""

SYNTH20 = """select o_custkey % 20 + 1 as set_id,
        (1 + (o_orderkey * 7 + 12345) % 223) * 16777216 + ((o_orderkey * 13 + 12345) % 255) * 65536
          + ((o_orderkey * 17 + 12345) % 255) * 256 + ((o_orderkey * 19 + 12345) % 255) as begin,
        cast(floor(sqrt(cast((o_orderkey * 2654435761 + 12345) % 10000000000000000 as double))) as bigint) as len
      from orders"""
SYNTH20 = f"""select set_id, begin, least(begin + len, 4294967295) as "end" from ({SYNTH20})"""

EVENTS = """select event_id, user_id as set_id, epoch_us(ts) // 1000000 as begin,
       epoch_us(ts) // 1000000 + cast(floor(value * 600) as bigint) as "end" from events"""

LINES = f"""p as (select event_id, user_id % 10 as set_id, (event_id * 2654435761) % 3758096384 as b from events),
q as (select event_id, set_id, b, b + (event_id * 7919) % 1000003 as e,
             case when event_id % 97 = 0 then 1 when event_id % 101 = 0 then 2
                  when event_id % 103 = 0 then 3 else 4 end as rule from p),
lines as (select event_id, set_id, b, e, rule,
       case rule when 1 then {ip4_text_sql('b')} || ', 300.1.2.3'
                 when 2 then 'garbage'
                 when 3 then {ip4_text_sql('e')} || ',' || {ip4_text_sql('b')}
                 else {ip4_text_sql('b')} || case when event_id % 2 = 0 then ', ' else ',' end || {ip4_text_sql('e')}
       end as line from q),
kept as (select event_id, set_id, case when rule = 3 then e else b end as begin,
                case when rule = 3 then b else e end as "end" from lines where rule in (3, 4))"""


def _with(src: str, body: str) -> str:
    return f"with r as ({src}) {body}"


def _segments(r: str = "r") -> str:
    """Elementary segments [x, nx-1] between consecutive coordinates, with the
    number of ranges containing them counted directly."""
    return f"""pts as (select set_id, begin as x from {r} union select set_id, "end" + 1 as x from {r}),
seg as (select set_id, x, lead(x) over (partition by set_id order by x) as nx from pts),
cov as (select s.set_id, s.x, s.nx,
               (select count(*) from {r} where {r}.set_id = s.set_id and {r}.begin <= s.x and {r}."end" >= s.x) as depth
        from seg s)"""


def _exclusive_sql(src: str) -> str:
    return f"""with r as ({src}), {_segments()}
select set_id, x as begin, nx - 1 as "end" from cov where nx is not null and depth = 1"""


def _dotted(c: str) -> str:
    return ip4_text_sql(c)


W16 = CUT_WIDTH
W28 = IP4_BUCKET_WIDTH

ORACLE: dict[str, str] = {
    "parse_ranges": f"with {LINES} select event_id, set_id, begin, \"end\" from kept where begin <= \"end\"",
    "parse_rejects": f"""with {LINES}
select event_id, set_id, line, case when rule in (1, 2) then 'malformed' else 'reversed' end as reason
from lines where rule in (1, 2) or (rule = 3 and e > b)""",
    "readable_ranges": _with(IP16, f'select set_id, {_dotted("begin")} as sbegin, {_dotted(chr(34) + "end" + chr(34))} as send from r'),
    "range_documents": _with(IP16, f'select set_id, {_dotted("begin")} as begin, {_dotted(chr(34) + "end" + chr(34))} as "end" from r'),
    "numbered_listing": _with(
        IP16,
        f"""select set_id, n, cast(n as varchar) || chr(9) || {_dotted('begin')} || ', ' || {_dotted('"end"')} as line
from (select *, cast(row_number() over (partition by set_id order by begin, "end") as bigint) as n from r)""",
    ),
    "numbered_listing_bucketed": _with(
        IP1,
        f"""select set_id, n, cast(n as varchar) || chr(9) || {_dotted('begin')} || ', ' || {_dotted('"end"')} as line
from (select *, cast(row_number() over (partition by set_id order by begin, "end") as bigint) as n from r)""",
    ),
    "numbered_listing_skewed": _with(
        SKEWED,
        f"""select set_id, n, cast(n as varchar) || chr(9) || {_dotted('begin')} || ', ' || {_dotted('"end"')} as line
from (select *, cast(row_number() over (partition by set_id order by begin, "end") as bigint) as n from r)""",
    ),
    "synthetic_ranges": """with k as (select o_custkey as set_id, o_orderkey as id from orders),
g as (select set_id,
        (1 + (id * 7 + 12345) % 223) * 16777216 + ((id * 13 + 12345) % 255) * 65536
          + ((id * 17 + 12345) % 255) * 256 + ((id * 19 + 12345) % 255) as begin,
        cast(floor(sqrt(cast((id * 2654435761 + 12345) % 10000000000000000 as double))) as bigint) as len
      from k)
select set_id, begin, least(begin + len, 4294967295) as "end" from g""",
    "bucket_of": _with(
        IP16, f'select set_id, begin, "end", begin // {W28} as bucket_begin, "end" // {W28} as bucket_end from r'
    ),
    "cut_at_buckets": _with(
        IP16,
        f"""select set_id, bucket, greatest(begin, bucket * {W16}) as begin, least("end", bucket * {W16} + {W16 - 1}) as "end"
from (select *, unnest(range(begin // {W16}, "end" // {W16} + 1)) as bucket from r)""",
    ),
    "glue_points": _with(
        IP16,
        f"""select distinct set_id, bucket, bucket * {W16} - 1 as left_point, bucket * {W16} as right_point
from (select set_id, unnest(range(begin // {W16} + 1, "end" // {W16} + 1)) as bucket from r)""",
    ),
    "edge_ranges": _with(
        IP16,
        f"""select set_id, begin, "end", begin % {W16} = 0 as starts_on_edge, "end" % {W16} = {W16 - 1} as ends_on_edge
from (select set_id, greatest(begin, bucket * {W16}) as begin, least("end", bucket * {W16} + {W16 - 1}) as "end"
      from (select *, unnest(range(begin // {W16}, "end" // {W16} + 1)) as bucket from r))
where begin % {W16} = 0 or "end" % {W16} = {W16 - 1}""",
    ),
    "bucket_layout": _with(IP16, f'select set_id, begin, "end", begin // {W28} as bucket from r'),
    "zorder_layout": _with(
        IP16,
        """, b as (select min(begin) as low, (max("end") - min(begin) + 1 + 65535) // 65536 as step from r),
c as (select set_id, begin, "end", (begin - low) // step as x, ("end" - low) // step as y from r, b)
select set_id, begin, "end",
       cast(list_sum(list_transform(range(16), lambda i: ((x >> i) & 1) * (1 << (2 * i + 1)) + ((y >> i) & 1) * (1 << (2 * i)))) as bigint) as zkey
from c""",
    ),
    "endpoint_events": _with(
        GRID,
        """select set_id, begin as point, cast(1 as bigint) as starts, cast(0 as bigint) as ends from r
union all select set_id, "end" as point, cast(0 as bigint) as starts, cast(-1 as bigint) as ends from r""",
    ),
    "endpoint_totals": _with(
        GRID,
        """select set_id, point, cast(sum(starts) as bigint) as starts, cast(sum(ends) as bigint) as ends from (
  select set_id, begin as point, 1 as starts, 0 as ends from r
  union all select set_id, "end" as point, 0 as starts, -1 as ends from r) group by set_id, point""",
    ),
    "end_counts": _with(GRID, 'select set_id, "end" as point, count(*) as n_ends from r group by set_id, "end"'),
    "ends_by_begin": _with(GRID, 'select set_id, begin, "end", count(*) as n from r group by set_id, begin, "end"'),
    "begin_counts": _with(
        GRID,
        'select set_id, begin, count(*) as n_ranges, min("end") as min_end, max("end") as max_end from r group by set_id, begin',
    ),
    "coverage_depth": f"""with r as ({GRID}), {_segments()}
select set_id, x as point, depth, nx as next_point from cov""",
    "coverage_depth_bucketed": f"""with r as ({IP1}), {_segments()}
select set_id, x as point, depth, nx as next_point from cov""",
    "coverage_depth_skewed": f"""with r as ({SKEWED}), {_segments()}
select set_id, x as point, depth, nx as next_point from cov""",
    "invalid_ranges": f"""with {LINES} select event_id, set_id, begin, "end", 'reversed' as reason from kept where begin > "end" """,
    "open_ranges": _with(
        GRID,
        """, bp as (select set_id, begin as point, count(*) as n_starting from r group by set_id, begin)
select bp.set_id, bp.point, bp.n_starting,
       (select count(*) from r where r.set_id = bp.set_id and r.begin <= bp.point and r."end" >= bp.point) as n_open
from bp""",
    ),
    "exclusive_ranges": _exclusive_sql(GRID),
    "exclusive_ranges_window": _exclusive_sql(GRID),
    "exclusive_ranges_ip": _exclusive_sql(IP16),
    "exclusive_ranges_events": _exclusive_sql(EVENTS),
    "exclusive_ranges_bucketed": _exclusive_sql(IP1),
    "exclusive_ranges_presorted": _exclusive_sql(EVENTS),
    "exclusive_ranges_sorted_files": _exclusive_sql(EVENTS),
    "exclusive_ranges_synthetic": _exclusive_sql(SYNTH20),
    "exclusive_ranges_skewed": _exclusive_sql(SKEWED),
    "glue_ranges": _exclusive_sql(GRID),
    "merge_touching": f"""with r as ({GRID}), {_segments()},
ex as (select set_id, x as begin, nx - 1 as "end" from cov where nx is not null and depth = 1),
f as (select *, case when lag("end") over (partition by set_id order by begin) = begin - 1 then 0 else 1 end as brk from ex),
g as (select *, sum(brk) over (partition by set_id order by begin rows between unbounded preceding and current row) as isl from f)
select set_id, min(begin) as begin, max("end") as "end" from g group by set_id, isl""",
    "order_violations": _with(
        EVENTS,
        """select set_id, event_id, "end", next_event_id, next_end from (
  select set_id, event_id, "end",
         lead(event_id) over (partition by set_id order by event_id) as next_event_id,
         lead("end") over (partition by set_id order by event_id) as next_end from r)
where "end" > next_end""",
    ),
    "interval_order_violations": f"""with {LINES}
select set_id, event_id, begin, "end", 'reversed' as kind from kept where begin > "end"
union all
select set_id, event_id, begin, "end", 'unordered' as kind from (
  select *, lead(begin) over (partition by set_id order by event_id) as nb from kept) where begin > nb""",
    "balance_audit": f"""with {LINES},
pt as (select set_id, x, cast(sum(s) as bigint) as starts, cast(sum(en) as bigint) as ends from (
  select set_id, begin as x, 1 as s, 0 as en from kept
  union all select set_id, "end" + 1 as x, 0 as s, -1 as en from kept) group by set_id, x),
lv as (select *, sum(starts + ends) over (partition by set_id order by x rows between unbounded preceding and current row) as level from pt)
select set_id, cast(sum(starts) as bigint) as n_ranges, cast(-sum(ends) as bigint) as n_ends, count(*) as n_points,
       cast(min(level) as bigint) as min_level, cast(sum(starts + ends) as bigint) as final_level,
       min(level) >= 0 and sum(starts + ends) = 0 as balanced
from lv group by set_id""",
    "cross_check": f"""with ex as ({_exclusive_sql(GRID)})
select set_id, count(*) as rows_left, count(*) as rows_right, cast(0 as bigint) as only_left, cast(0 as bigint) as only_right
from ex group by set_id""",
    "cross_check_digest": f"""with ex as ({_exclusive_sql(GRID)})
select set_id, count(*) as rows_left, count(*) as rows_right, cast(0 as bigint) as cells_differing
from ex group by set_id""",
    "range_pairs": _with(IP16, 'select begin, "end" from r where begin % 7 > 0'),
    "range_table": _with(IP16, 'select cast(set_id as integer) as set_id, begin, "end" from r'),
    "with_set_id": _with(GRID, 'select cast(7 as integer) as set_id, begin, "end" from r'),
    "numbered_sets": f"""with {LINES}, good as (select 'in/' || (event_id % 53) || '.txt' as source, begin, "end" from kept where begin <= "end"),
low as (select max(o_custkey) + 1 as n from orders),
number as (select source, dense_rank() over (order by source) - 1 + (select n from low) as set_id
           from (select distinct 'in/' || (event_id % 53) || '.txt' as source from events)),
r as (select number.set_id, begin, "end" from good join number using (source)), {_segments()}
select set_id, x as begin, nx - 1 as "end" from cov where nx is not null and depth = 1""",
    "consecutive_runs": f"""with r as (select *, ("end" - begin) // 21600 as quarter from ({EVENTS})),
f as (select *, case when quarter = lag(quarter) over w then 0 else 1 end as fresh from r window w as (partition by set_id order by event_id)),
g as (select *, cast(sum(fresh) over (partition by set_id order by event_id rows between unbounded preceding and current row) as bigint) as run from f)
select set_id, run, any_value(quarter) as quarter, count(*) as length, min(event_id) as first_event_id, max(event_id) as last_event_id
from g group by set_id, run""",
    "open_range_rows": _with(
        GRID,
        """, p as (select distinct set_id, begin as point from r)
select p.set_id, p.point, r.begin, r."end", count(*) as n
from p join r on r.set_id = p.set_id and r.begin <= p.point and r."end" >= p.point group by p.set_id, p.point, r.begin, r."end" """,
    ),
    "exclusive_ranges_incremental": _exclusive_sql(EVENTS),
    "published_ranges": _exclusive_sql(IP1.replace("cast(0 as bigint)", "cast(3 as bigint)", 1)),
    "observed_audit": f"""with r as ({GRID}), {_segments()}
select (select count(*) from r) as n_ranges, (select count(*) from r) as n_ends, count(*) as n_points,
       min(depth) as min_level, cast(0 as bigint) as final_level, count(*) filter (depth = 1) as n_exclusive from cov""",
    "sql_functions": _with(
        IP16,
        f"""select set_id, {_dotted('begin')} as sbegin, "end", begin // {W28} as bucket,
       "end" // {W16} * {W16} - 1 as left_point, "end" // {W16} * {W16} as right_point from r""",
    ),
    "next_set_id": _with(GRID, "select coalesce(max(set_id) + 1, 1) as next_set_id from r"),
    "replicate_rows": _with(GRID, 'select set_id, begin, "end", unnest(range(1, 4)) as copy from r'),
}

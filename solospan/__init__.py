"""solospan: closed integer ranges (IPv4 first) on Spark DataFrames.

Every public operator takes and returns a DataFrame; the only actions are
in writers, ``publish``, range stores, and the scans of groups beyond one task,
which plan themselves and are stored when they are built.
"""

from solospan.functions.ipv4 import ip4_text, parse_ip4, with_ip4
from solospan.functions.buckets import bucket_of, junctions
from solospan.functions.sql import register_sql_functions
from solospan.operators.events import (
    begin_counts,
    consecutive_runs,
    coverage_depth,
    end_counts,
    endpoint_events,
    endpoint_totals,
    ends_by_begin,
    open_ranges,
)
from solospan.operators.exclusive import (
    exclusive_ranges,
    exclusive_ranges_bucketed,
    exclusive_ranges_by_level,
    exclusive_ranges_of_sorted,
    exclusive_ranges_presorted,
    write_sorted_ranges,
)
from solospan.operators.stabbing import open_range_rows, ranges_containing
from solospan.operators.cutting import (
    bucket_layout,
    cut_at_buckets,
    edge_ranges,
    glue_points,
    glue_ranges,
    merge_touching,
    zorder_layout,
)
from solospan.operators.audit import (
    balance_audit,
    interval_order_violations,
    observed_exclusive_ranges,
    order_violations,
)
from solospan.operators.sets import (
    cross_check,
    cross_check_digest,
    cross_check_summary,
    next_set_id,
    number_sets,
    replicate_rows,
    with_set_id,
)
from solospan.sources.text import (
    empty_ranges,
    good_ranges,
    parse_range_lines,
    parsed_ranges,
    ranges_from_pairs,
    read_range_text,
    rejected_lines,
)
from solospan.sources.generate import synthetic_ranges
from solospan.sources.jdbc import append_ranges_jdbc, jdbc_options, read_ranges_jdbc
from solospan.sources.sinks import (
    numbered_listing,
    range_documents,
    readable_ranges,
    register_readable_view,
    write_documents,
    write_listing,
    write_ranges,
)
from solospan.sources.committed import CommittedTable
from solospan.streaming.incremental import RangeStore, foreach_batch_updater
from solospan.streaming.publish import foreach_batch_publisher, publish, publish_files, range_line_stream

__all__ = [name for name in dir() if not name.startswith("_")]

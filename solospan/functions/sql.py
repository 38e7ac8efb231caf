"""The column functions as SQL functions (S2.J1, J2, B1-B5).

``register_sql_functions`` defines them in the session; their bodies are plain
SQL, which Catalyst inlines, so a query that calls them has no function call
left and no Python.  They agree with :mod:`solospan.functions.ipv4` and
:mod:`solospan.functions.buckets`, whose patterns they use.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from solospan.functions.buckets import IP4_BUCKET_WIDTH
from solospan.functions.ipv4 import _ADDRESS_PATTERN, _EDGE_BLANKS, IP4_MAX


def _text(value: str) -> str:
    """A raw SQL string literal."""
    return 'r"' + value + '"'


def _octet(i: int) -> str:
    return f"cast(try_element_at(split(t, {_text(chr(92) + '.')}, -1), {i}) as bigint)"


#: name -> (parameters, type, body)
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "ip4_value": (
        "address string",
        "bigint",
        f"""(select case when t rlike {_text(_ADDRESS_PATTERN)}
             then {_octet(1)} * 16777216 + {_octet(2)} * 65536 + {_octet(3)} * 256 + {_octet(4)} end
        from (select regexp_replace(regexp_replace(address, {_text(_EDGE_BLANKS)}, ''), {_text(chr(92) + '.+' + chr(92) + 'z')}, '') as t))""",
    ),
    "ip4_text": (
        "value bigint",
        "string",
        f"""case when value between 0 and {IP4_MAX} then concat_ws('.', cast(shiftright(value, 24) as string),
        cast(shiftright(value, 16) & 255 as string), cast(shiftright(value, 8) & 255 as string), cast(value & 255 as string)) end""",
    ),
    "bucket_of": (f"value bigint, width bigint default {IP4_BUCKET_WIDTH}", "bigint", "(value - pmod(value, width)) div width"),
    "left_of_edge": (f"bucket bigint, width bigint default {IP4_BUCKET_WIDTH}", "bigint", "bucket * width - 1"),
    "right_of_edge": (f"bucket bigint, width bigint default {IP4_BUCKET_WIDTH}", "bigint", "bucket * width"),
}


def register_sql_functions(spark: SparkSession, prefix: str = "", temporary: bool = True) -> list[str]:
    """Define the functions, with ``prefix`` before their names; returns the names."""
    for name, (parameters, kind, body) in FUNCTIONS.items():
        scope = "temporary " if temporary else ""
        spark.sql(f"create or replace {scope}function {prefix}{name}({parameters}) returns {kind} return {body}")
    return [prefix + name for name in FUNCTIONS]

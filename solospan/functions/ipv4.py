"""IPv4 codec as native column expressions (no Python UDF).

``parse_ip4``  dotted quad text -> unsigned value as BIGINT, NULL when malformed.
``ip4_text``   BIGINT -> dotted quad text, NULL outside 0 .. 2**32-1.

Acceptance rules of the text form (fixed values of the format):
  * characters U+0000 .. U+0020 are stripped from both ends of the address;
  * trailing dots are ignored ("1.2.3.4." is 1.2.3.4);
  * exactly four octets separated by '.';
  * an octet is an optional '+' or '-' sign and ASCII digits, value 0 .. 255
    ("01" is 1, "-0" is 0, "+7" is 7).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IP4_MAX = 4294967295  # 2**32 - 1
# An octet: optional '+', any leading zeros, then 0..255; or '-' and zeros.
_OCTET = r"(?:\+?0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])|-0+)"
_ADDRESS_PATTERN = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}\z"
_EDGE_BLANKS = r"^[\x00-\x20]+|[\x00-\x20]+\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_blanks(c) -> Column:
    """Remove every character <= U+0020 from both ends (not only spaces)."""
    return F.regexp_replace(_col(c), _EDGE_BLANKS, "")


def parse_ip4(c) -> Column:
    """Dotted quad -> BIGINT; NULL if the text is not an address.

    A single expression: fine for a few values; on large inputs prefer
    ``with_ip4`` which computes the intermediate columns once each.
    """
    text = F.regexp_replace(strip_blanks(c), r"\.+\z", "")
    return _ip4_value(text, F.split(text, r"\.", -1))


def _ip4_value(text: Column, parts: Column) -> Column:
    # The pattern validates all four octets (0..255 with the accepted sign and
    # leading-zero forms), so the casts below never see a bad number.
    value = None
    for i, weight in ((1, 16777216), (2, 65536), (3, 256), (4, 1)):
        o = F.try_element_at(parts, F.lit(i)).cast("bigint") * weight
        value = o if value is None else value + o
    return F.when(text.rlike(_ADDRESS_PATTERN), value)


def with_ip4(df, columns: dict[str, str]):
    """Add parsed addresses: ``columns`` maps output name -> text column.

    Staged as separate projections (stripped text, then its parts, then the
    value) so no intermediate is repeated inside one generated method; the
    whole parse stays in whole-stage codegen without higher-order functions.
    """
    keep = df.columns
    staged = df.select("*", *[F.regexp_replace(strip_blanks(src), r"\.+\z", "").alias(f"_t_{out}") for out, src in columns.items()])
    staged = staged.select("*", *[F.split(F.col(f"_t_{out}"), r"\.", -1).alias(f"_p_{out}") for out in columns])
    return staged.select(
        *[F.col(c) for c in keep],
        *[_ip4_value(F.col(f"_t_{out}"), F.col(f"_p_{out}")).alias(out) for out in columns],
    )


def ip4_text(c) -> Column:
    """BIGINT -> dotted quad; NULL when outside the IPv4 range."""
    x = _col(c).cast("bigint")
    text = F.concat_ws(
        ".",
        F.shiftright(x, 24).cast("string"),
        F.shiftright(x, 16).bitwiseAND(255).cast("string"),
        F.shiftright(x, 8).bitwiseAND(255).cast("string"),
        x.bitwiseAND(255).cast("string"),
    )
    return F.when(x.between(0, IP4_MAX), text)


def ip4_text_sql(expr: str) -> str:
    """The same formatter as DuckDB/ANSI SQL text (used by oracles)."""
    return (
        f"case when ({expr}) between 0 and {IP4_MAX} then "
        f"cast(({expr}) // 16777216 as varchar) || '.' || "
        f"cast((({expr}) // 65536) % 256 as varchar) || '.' || "
        f"cast((({expr}) // 256) % 256 as varchar) || '.' || "
        f"cast(({expr}) % 256 as varchar) end"
    )

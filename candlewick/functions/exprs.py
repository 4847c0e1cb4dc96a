"""Scalar expressions for candle data.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so
that it stays inside whole-stage codegen.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted text grammars of the safe casts.
# A number: optional sign, digits with optional fraction (or a bare fraction),
# optional exponent, surrounding blanks allowed. Rejects '1d', 'NaN', 'inf'.
NUMERIC_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# An ISO-8601 date-time with optional fraction and optional UTC offset.
TIMESTAMP_PATTERN = r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_symbol(c) -> Column:
    """Canonical symbol: keep ASCII letters and digits, upper-case. Null stays null.

    ' BTCUSDT ', 'btc/usdt' and 'btcusdt' all become 'BTCUSDT'.
    """
    return F.upper(F.regexp_replace(_c(c), r"[^A-Za-z0-9]", ""))


def is_numeric_text(c) -> Column:
    """True when the text is a plain decimal number (null for null input)."""
    return _c(c).rlike(NUMERIC_PATTERN)


def safe_double(c) -> Column:
    """Text -> double; anything outside the number grammar becomes null.

    Mirrors a coercing numeric parse: '', 'unknown', '1d', 'NaN' -> null.
    """
    col = _c(c)
    return F.when(is_numeric_text(col), F.trim(col).try_cast("double"))


def is_timestamp_text(c) -> Column:
    return _c(c).rlike(TIMESTAMP_PATTERN)


EPOCH_NTZ = "1970-01-01 00:00:00"


def _epoch() -> Column:
    return F.lit(EPOCH_NTZ).cast("timestamp_ntz")


def ntz_epoch_micros(c) -> Column:
    """UTC wall-clock ``timestamp_ntz`` -> microseconds since the epoch.

    Built from calendar fields (days since epoch, hour, minute, seconds with
    fraction), which are read from the wall clock without any zone.
    ``timestamp_diff`` would route through the session zone and shift
    wall-clock times that fall in a daylight-saving gap there.
    """
    ts = _c(c)
    return (
        F.unix_date(F.to_date(ts)).cast("bigint") * F.lit(86_400_000_000)
        + (F.hour(ts).cast("bigint") * 3600 + F.minute(ts).cast("bigint") * 60) * F.lit(1_000_000)
        + (F.date_part(F.lit("SECOND"), ts) * F.lit(1_000_000)).cast("bigint")
    )


def ntz_from_epoch_micros(c) -> Column:
    return F.timestamp_add("MICROSECOND", _c(c), _epoch())


def safe_timestamp(c) -> Column:
    """ISO text -> UTC wall-clock ``timestamp_ntz``; other text -> null.

    Text with an offset ('Z', '+02:00') is converted to UTC through its epoch
    instant; text without one is taken as UTC wall-clock. Neither path
    depends on the session time zone.
    """
    col = _c(c)
    has_offset = col.rlike(r"(Z|[+-]\d\d:\d\d)$")
    instant = ntz_from_epoch_micros(F.unix_micros(col.try_cast("timestamp")))
    return F.when(
        is_timestamp_text(col), F.when(has_offset, instant).otherwise(col.try_cast("timestamp_ntz"))
    )


def epoch_ms_to_timestamp(c) -> Column:
    """Epoch milliseconds -> UTC wall-clock ``timestamp_ntz`` (zone independent)."""
    return F.timestamp_add("MILLISECOND", _c(c), _epoch())


def percent_change(change, base) -> Column:
    """``change / base * 100``; a zero base gives null instead of +-inf."""
    return F.try_divide(_c(change), _c(base)) * F.lit(100.0)


def candle_direction(open_, close) -> Column:
    """'up' / 'down' / 'flat'; null when open or close is null."""
    o, c = _c(open_), _c(close)
    return F.when(c > o, "up").when(c < o, "down").when(c == o, "flat")


def null_safe(rule: Column) -> Column:
    """A rule that is null (a comparison with a missing value) counts as false."""
    return F.coalesce(rule, F.lit(False))


def row_hash(seed, tag: str, uid) -> Column:
    """Seeded md5 hex digest of a row identity; identical in Spark and DuckDB."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(tag), _c(uid)))


def hash_int(seed, tag: str, uid) -> Column:
    """First 32 bits of ``row_hash`` as a non-negative bigint."""
    return F.conv(F.substring(row_hash(seed, tag, uid), 1, 8), 16, 10).cast("bigint")


def hash_choice(seed, tag: str, uid, options: Sequence) -> Column:
    """Seeded pick of one element of ``options`` (literals or Columns) per row."""
    opts = [o if isinstance(o, Column) else F.lit(o) for o in options]
    idx = F.pmod(hash_int(seed, tag, uid), F.lit(len(opts))).cast("int")
    return F.element_at(F.array(*opts), idx + 1)


def constant_array(values: Sequence, kind: str) -> Column:
    """A list as one literal array (folded once, not a node per element)."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def bisect_count(table: Column, size: int, value: Column) -> Column:
    """How many of the ``size`` ascending elements of ``table`` are at or below
    ``value``, by bisection (log2(size) comparisons a row)."""
    steps = [1 << i for i in reversed(range(size.bit_length()))]
    if not steps:
        return F.lit(0)

    def further(at: Column, step: Column) -> Column:
        return F.when(F.coalesce(F.get(table, at + step - 1) <= value, F.lit(False)), at + step).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), further)


def file_position(df: DataFrame) -> Column:
    """Place of a row in the files that ``df`` scans, as a fixed-width number:
    the file (by name), the block in it and the row. Use it in a projection
    right above the scan; where no files are read it is the row's place in its
    partition order."""
    files = sorted(df.inputFiles(), key=str.encode)
    wide = "decimal(38,0)"
    row = F.monotonically_increasing_id()
    if not files:
        return row.cast(wide)
    file = bisect_count(constant_array(files, "string"), len(files), F.input_file_name())
    block = F.greatest(F.input_file_block_start(), F.lit(0).cast("bigint"))
    in_block = row.bitwiseAND(F.lit((1 << 33) - 1))
    # 10 digits for the row, 15 for the block (a petabyte), the rest for the file
    return (file.cast("decimal(12,0)") * F.lit(Decimal(10**25)) + block.cast("decimal(15,0)") * F.lit(Decimal(10**10)) + in_block.cast("decimal(10,0)")).cast(wide)

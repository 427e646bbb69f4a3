"""Column expressions for cleaning source values.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Timestamps are TIMESTAMP_NTZ holding UTC wall time; they do not depend on the
session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Defaults and sentinels the catalogue uses.
UNKNOWN = "unknown"
NO_DESCRIPTION = "No description"
DEFAULT_VERSION = "0.0.0"
ASSEMBLY_VERSION = " "
EMPTY = ""



def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def or_default(col: Column | str, default) -> Column:
    """``COALESCE(x, default)``."""
    return F.coalesce(_c(col), F.lit(default))


def null_if_zero(col: Column | str) -> Column:
    """``NULLIF(x, 0)``."""
    return F.nullif(_c(col), F.lit(0))


def null_if_empty(col: Column | str) -> Column:
    """``NULLIF(x, '')``."""
    return F.nullif(_c(col), F.lit(EMPTY))


def version_or_default(col: Column | str) -> Column:
    """``COALESCE(NULLIF(v, ''), '0.0.0')``."""
    return F.coalesce(null_if_empty(col), F.lit(DEFAULT_VERSION))


def text_or_empty(col: Column | str) -> Column:
    """X11: NULL text becomes ''."""
    return F.coalesce(_c(col), F.lit(EMPTY))


# Fixed value: whole seconds that a timestamp (64-bit microseconds) can hold on either side of 1970.
MAX_EPOCH_SECONDS = 9_223_372_036_000 - 86_400


def epoch_in_range(col: Column | str) -> Column:
    """Whether a timestamp can hold these epoch seconds (NULL: yes)."""
    return F.coalesce(_c(col).between(-MAX_EPOCH_SECONDS, MAX_EPOCH_SECONDS), F.lit(True))


def epoch_to_ts(col: Column | str) -> Column:
    """Epoch seconds to UTC timestamp; NULL stays NULL, 0 is 1970-01-01.

    Any number of seconds a timestamp can hold is converted; others give NULL
    and are listed by ``epoch_in_range``, they never fail the job.
    """
    seconds = F.when(epoch_in_range(col), _c(col).cast("long"))
    return _epoch() + F.make_dt_interval(
        days=F.floor(seconds / F.lit(86400)).cast("int"), secs=F.pmod(seconds, F.lit(86400)).cast("decimal(18,6)")
    )


def epoch_to_ts_zero_null(col: Column | str) -> Column:
    """As X7, but 0 also gives NULL."""
    return epoch_to_ts(null_if_zero(col))


def run_ts_literal(run_ts: dt.datetime | str) -> Column:
    """The load time, fixed for the whole run so that results repeat."""
    text = run_ts.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(run_ts, dt.datetime) else run_ts
    return F.lit(text).cast("timestamp_ntz")


def epoch_or_load_time(
    col: Column | str, run_ts: dt.datetime | str, zero_is_null: bool = True
) -> Column:
    """X5 (``zero_is_null=True``) or X6 (``False``).

    X5: 0 or NULL -> load time.  X6: only NULL -> load time, 0 -> 1970 (R10).
    """
    ts = epoch_to_ts_zero_null(col) if zero_is_null else epoch_to_ts(col)
    return F.coalesce(ts, run_ts_literal(run_ts))


def present(col: Column | str) -> Column:
    """present and not empty (a Python truth test on a string)."""
    c = _c(col)
    return c.isNotNull() & (c != F.lit(EMPTY))


def time_missing(col: Column | str) -> Column:
    """``time = 0 OR time IS NULL``."""
    c = _c(col)
    return (c == F.lit(0)) | c.isNull()

"""Time functions (P-09, P-13, P-15).

Every operator takes ``run_ts`` as an argument instead of calling
``current_timestamp()`` itself, so results are reproducible and testable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two layouts the reference accepts, and its output formats.
TIMESTAMP_LAYOUTS = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss")
TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
CLOCK_FORMAT = "HH:mm"
FILE_STAMP_FORMAT = "yyyyMMdd"


def on_day(ts: Column, day: str | Column) -> Column:
    """P-09: ``ts`` falls on calendar ``day`` -- the half-open range
    ``[day, day + 1 day)``.  Unlike a substring test on the timestamp text the
    casts sit on the literals, so the bounds reach the Parquet scan."""
    d = (F.lit(day) if isinstance(day, str) else day).cast("date")
    return (ts >= d) & (ts < F.date_add(d, 1))


def format_ts(ts: Column, fmt: str = TEXT_FORMAT) -> Column:
    """P-13: timestamp as text (``yyyy-MM-dd HH:mm:ss`` by default)."""
    return F.date_format(ts, fmt)


def parse_mixed(text: Column, layouts: Sequence[str] = TIMESTAMP_LAYOUTS) -> Column:
    """P-15: first layout that parses wins; unparsable text gives null (no error under ANSI)."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in layouts])

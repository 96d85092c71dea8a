"""Scalar column helpers.  Every helper returns a built-in Spark ``Column``
so it stays inside whole-stage code generation; none calls Python per row.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def path_part(path: str | Column, pos: int = -3, sep: str = "/") -> Column:
    """Part ``pos`` of a split path (1-based, negative counts from the end).

    ``try_element_at`` returns NULL for a path with too few parts, where
    ``element_at`` fails under ANSI mode.  The segment of a landing file
    ``.../<segment>/add/<file>.csv`` is part -3.
    """
    return F.try_element_at(F.split(_c(path), sep), F.lit(pos))


# Seconds whose microseconds still fit 64 bits, the only real bound of a
# Spark timestamp (about 292,000 years either way).
_MAX_EPOCH = (2**63 - 1) // 1_000_000


def epoch_to_date(text: str | Column) -> Column:
    """Epoch seconds given as text to a DATE; bad, empty or NULL text gives
    NULL, and so does a number that overflows a timestamp (instead of an
    error that would fail the whole job).  Milliseconds taken for seconds
    give a far date, as the plain expression does.  Uses the session time
    zone (pinned to UTC by ``config``)."""
    secs = _c(text).try_cast("bigint")
    ok = secs.between(F.lit(-_MAX_EPOCH), F.lit(_MAX_EPOCH))
    return F.when(ok, F.to_date(F.timestamp_seconds(secs)))


def keep_old_if_null(new: str | Column, old: str | Column) -> Column:
    """The new value unless it is NULL; a NULL never erases the old one."""
    return F.coalesce(_c(new), _c(old))


def changed_non_null(cols: list[str], s: str = "s", t: str = "t") -> Column:
    """True when any source column is set and differs from the target
    (a NULL target counts as different).  Same truth table as
    ``s.c IS NOT NULL AND (t.c IS NULL OR t.c != s.c)`` ORed over columns,
    but never NULL itself."""
    terms = [
        F.col(f"{s}.{c}").isNotNull() & ~F.col(f"{s}.{c}").eqNullSafe(F.col(f"{t}.{c}"))
        for c in cols
    ]
    return reduce(or_, terms) if terms else F.lit(False)


def any_null(cols: list[str]) -> Column:
    """True when one of ``cols`` is NULL."""
    return reduce(or_, [F.col(c).isNull() for c in cols])


def null_count(c: str) -> Column:
    """Number of NULLs of a column inside an aggregate."""
    return F.sum(F.col(c).isNull().cast("bigint"))


def export_file_name(segment: str | Column, date: str | Column) -> Column:
    """``<segment><yyyy-MM-dd>.csv``, the reference export name."""
    return F.concat(_c(segment), _c(date), F.lit(".csv"))


def batch_stamp(ts: str | Column | None = None) -> Column:
    """Run id text ``yyyyMMdd_HHmmss`` of a timestamp (default: now)."""
    return F.date_format(_c(ts) if ts is not None else F.current_timestamp(), "yyyyMMdd_HHmmss")


def sorted_distinct(arr: str | Column) -> Column:
    """Sorted set of an array (``sorted(set(...))``)."""
    return F.array_sort(F.array_distinct(_c(arr)))

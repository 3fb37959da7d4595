"""Scalar Column builders: integer division, text-to-number, ordered buckets."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else (x if isinstance(x, Column) else F.lit(x))


def int_div(a, b) -> Column:
    """Integer division truncating toward zero (SQL ``a div b``)."""
    return F.call_function("div", _c(a), _c(b))


def minutes_since(ts, start) -> Column:
    """Whole minutes from ``start`` to ``ts``, truncated toward zero."""
    return int_div(_c(ts) - _c(start), 60)


def leading_number(col) -> Column:
    """Text used as a number: its leading numeric prefix, else 0.

    Spark rejects ``'a' - 'b'`` and ANSI ``cast('abc' as int)`` raises, so the
    prefix is extracted explicitly and ``try_cast`` keeps bad input at 0.
    """
    num = F.regexp_extract(_c(col), r"^\s*([+-]?[0-9]+(\.[0-9]+)?)", 1)
    return F.coalesce(num.try_cast("double"), F.lit(0.0))


def ordered_buckets(col, rules: Iterable[tuple], default) -> Column:
    """First matching rule wins.  ``rules`` = [(predicate(Column) -> Column, label), ...];
    ``label`` is a literal or a Column.  ``default`` likewise."""
    c = _c(col)
    out = None
    for pred, label in rules:
        lab = label if isinstance(label, Column) else F.lit(label)
        out = F.when(pred(c), lab) if out is None else out.when(pred(c), lab)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if out is None else out.otherwise(d)


def epoch_year(ts) -> Column:
    return F.date_format(F.timestamp_seconds(_c(ts)), "yyyy")


def epoch_month(ts) -> Column:
    return F.date_format(F.timestamp_seconds(_c(ts)), "MM")

"""Row conditions: value filters, kept rows, gates, ratios."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = {"include", "exclude", "keep_null"}


def value_filter(column: str | Column, spec) -> Column:
    """A filter on values. A list includes only its values (empty: any that is not null); a mapping may ``include``,
    ``exclude`` and say ``keep_null``. Nulls go when something is included and stay otherwise, unless it says so."""
    col = F.col(column) if isinstance(column, str) else column
    if isinstance(spec, Mapping):
        if unknown := set(spec) - PARTS:
            raise ValueError(f"unknown parts of a value filter: {sorted(unknown)}")
        include, exclude, keep_null = spec.get("include"), spec.get("exclude") or [], spec.get("keep_null")
    elif isinstance(spec, (str, bytes)) or not isinstance(spec, Iterable):
        raise ValueError("a value filter is a list or a mapping")
    else:
        include, exclude, keep_null = list(spec), [], False
    if keep_null is None:
        keep_null = not include
    kept = col.isNotNull()
    if include:
        kept &= col.isin(list(include))
    if exclude:
        kept &= ~col.isin(list(exclude))
    return F.coalesce(kept, F.lit(False)) | (F.lit(bool(keep_null)) & col.isNull())


def filtered(df: DataFrame, filters: Mapping) -> DataFrame:
    """``df`` under several value filters by column."""
    return reduce(lambda d, item: d.where(value_filter(*item)), filters.items(), df)


def expressions(df: DataFrame, conditions: Iterable[str]) -> DataFrame:
    """``df`` under SQL conditions one after another; blank ones are skipped, null counts as not met."""
    return reduce(lambda d, c: d.where(F.expr(c)), [c for c in conditions if c and c.strip()], df)


def kept(conditions: Iterable[str]) -> Column:
    """Whether a row meets all conditions; null counts as not met."""
    return reduce(lambda a, c: a & F.coalesce(F.expr(c), F.lit(False)), [c for c in conditions if c and c.strip()], F.lit(True))


def gated(value: Column, gate: bool) -> Column:
    """The value, or null on blocked days if the metric is gated."""
    return F.when(~F.col("is_blocked"), value) if gate else value


def ratio(a: Column, b: Column) -> Column:
    """a / b; null where b is 0 or null."""
    return F.try_divide(a, b)


def at_least_zero(value: Column) -> Column:
    """The greater of 0 and the value; a null value is 0, as both engines skip nulls."""
    return F.greatest(F.lit(0.0), value)


def valued(units: Column, price: Column) -> Column:
    """Units at a price, to the cent per row, before any sum."""
    return F.round(units * price, 2)

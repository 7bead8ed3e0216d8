"""Ranges of rows in the order of any columns, cut at sampled quantiles.

Cuts are values of a bounded sample, so ranges hold about equally many rows however values are
spread.  Rows are compared with cuts as structs, which order like ``ORDER BY`` does: column by
column, nulls first, NaN last.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide import types as V
from rowtide.errors import ConfigError

# Sampled rows for each range: its share is then within a few tenths of an even one.
SAMPLED = 40
# Ranges that a deep page is looked for in, and rows that are simply sorted.
PAGE_RANGES = 128
SORTED_ROWS = 20_000


Cut = tuple[V.Constant, ...]


def _values(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The columns as they come to the driver: instants as numbers, which no time zone shifts."""
    instant = {c for c in order if isinstance(V.column_type(df, c), T.TimestampType)}
    return df.select(*[F.unix_micros(V.col(c)).alias(c) if c in instant else V.col(c) for c in order])


def _constants(df: DataFrame, order: Sequence[str], row: Row) -> Cut:
    types = [V.column_type(df, c) for c in order]
    return tuple(V.Constant(V.instant(v) if isinstance(t, T.TimestampType) and v is not None else v, t) for v, t in zip(row, types, strict=True))


def cuts(df: DataFrame, order: Sequence[str], ranges: int, rows: int | None = None) -> list[Cut]:
    """At most ``ranges - 1`` different rows of ``order`` columns that cut ``df`` into even ranges, in order.

    A cut is the first row of its range.  Only sampled rows come to the driver.
    """
    if ranges < 2:
        return []
    named = df.select(*[V.col(c) for c in order])
    rows = named.count() if rows is None else rows
    if not rows:
        return []
    wanted = SAMPLED * ranges
    sample = named if rows <= wanted else named.sample(min(1.0, 1.2 * wanted / rows), seed=17)
    # Spark sorts, so that cuts stand in its own order.
    got = _values(sample.orderBy(*[V.col(c) for c in order]).limit(2 * wanted), order).collect()
    at = [got[i * len(got) // ranges] for i in range(1, ranges)] if got else []
    return [_constants(df, order, c) for n, c in enumerate(at) if c != got[0] and (n == 0 or c != at[n - 1])]


def _row(df: DataFrame, order: Sequence[str]) -> Column:
    return F.struct(*[V.col(c) for c in order])


def _cut(order: Sequence[str], cut: Cut) -> Column:
    """A cut as a struct of the columns' own types."""
    return F.struct(*[v.column().alias(c) for c, v in zip(order, cut, strict=True)])


def range_number(df: DataFrame, order: Sequence[str], at: Sequence[Cut]) -> Column:
    """How many cuts a row has reached: found by halving, so a row is compared a few times only."""
    row = _row(df, order)

    def halve(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(row < _cut(order, at[middle]), halve(low, middle)).otherwise(halve(middle + 1, high))

    return halve(0, len(at))


def slices(df: DataFrame, column: str, count: int) -> list[DataFrame]:
    """``df`` in at most ``count`` parts of about equal size, by ranges of one column.

    Each part is one range condition, which reaches the scan.  Parts are disjoint and
    hold every row; nulls go with the first.  A value that repeats stays in one part.
    """
    if count < 1:
        raise ConfigError("at least one slice is needed")
    if V.column_type(df, column) is None:
        raise ConfigError(f"no column {column!r} to slice by")
    at = [r[0].column() for r in cuts(df.where(V.col(column).isNotNull()), [column], count)]
    if not at:
        return [df]
    c = V.col(column)
    first = df.where((c < at[0]) | c.isNull())
    middle = [df.where((c >= low) & (c < high)) for low, high in zip(at, at[1:], strict=False)]
    return [first, *middle, df.where(c >= at[-1])]


def window(df: DataFrame, order: Sequence[str], offset: int, limit: int) -> DataFrame:
    """Rows ``offset .. offset + limit`` in the ``order`` of all columns, not sorted among each other.

    Rows are counted by ranges; ranges inside the page are taken whole, those with its
    ends are looked into again, until few rows are left to sort.
    """
    rows = df.count()
    limit = min(limit, rows - offset)
    if limit <= 0:
        return df.limit(0)
    if rows <= SORTED_ROWS:
        return df.orderBy(*[V.col(c) for c in order]).offset(offset).limit(limit)
    at = cuts(df, order, PAGE_RANGES, rows)
    if not at:
        # No sampled row differs from the first one: mostly copies of it, with others around.
        first = _constants(df, order, _values(df, order).first())
        same = _row(df, order) == _cut(order, first)
        below, above = _row(df, order) < _cut(order, first), _row(df, order) > _cut(order, first)
        return _pieces([(df.where(below), False), (df.where(same), True), (df.where(above), False)], order, offset, limit)
    part = range_number(df, order, at)
    # One row for each range.
    counts = {r["part"]: r["count"] for r in df.groupBy(part.alias("part")).count().collect()}
    seen, whole, pieces = 0, [], []
    for p in sorted(counts):
        n = counts[p]
        start, end = max(offset - seen, 0), min(offset + limit - seen, n)
        seen += n
        if start == 0 and end == n:
            whole.append(p)
        elif start < end:
            pieces.append(window(_between(df, order, at, p, p), order, start, end - start))
    if whole:
        pieces.append(_between(df, order, at, whole[0], whole[-1]))
    return reduce(DataFrame.unionAll, pieces)


def _between(df: DataFrame, order: Sequence[str], at: Sequence[Cut], low: int, high: int) -> DataFrame:
    """The rows of ranges ``low`` to ``high``; bounds of the leading column go along, for the scan."""
    row, lead = _row(df, order), V.col(order[0])
    if low > 0:
        df = df.where(row >= _cut(order, at[low - 1]))
        if at[low - 1][0].value is not None:
            df = df.where(lead >= at[low - 1][0].column())
    if high < len(at):
        df = df.where(row < _cut(order, at[high]))
        if at[high][0].value is not None:
            df = df.where((lead <= at[high][0].column()) | lead.isNull())
    return df


def _pieces(parts: Sequence[tuple[DataFrame, bool]], order: Sequence[str], offset: int, limit: int) -> DataFrame:
    """A window over parts that follow each other; of copies any will do."""
    seen, out = 0, []
    for df, copies in parts:
        n = df.count()
        start, end = max(offset - seen, 0), min(offset + limit - seen, n)
        seen += n
        if start < end:
            out.append(df.limit(end - start) if copies else window(df, order, start, end - start))
    return reduce(DataFrame.unionAll, out)

"""Selection without a sort: the n-th row of a table in the order of some columns.

Each order column is read as a list of numbers ("digits") that compare as its values do: whether it is set (nulls
come first), then the number, the date as days, the timestamp as microseconds, or a string's bytes six at a time and its
length. Rows that can still hold the n-th one are counted in ``HEAD_BINS`` equal bins between the least and the
greatest digit; the bin that holds the n-th row is the new range, and so on. A digit that all remaining rows share
gives way to the next. Once at most ``rows`` rows remain, they are sorted. A pass reads the order columns alone and
sends a few counts to the driver; a digit takes at most about six passes, whatever the distribution."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .split import HEAD_BINS

STRING_BYTES = 6


def _digits(c: str, kind: T.DataType, longest: Callable[[str], int]) -> Iterator[Column]:
    v = F.col(c)
    yield v.isNotNull().cast("long")
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        yield v.cast("long")
    elif isinstance(kind, T.DateType):
        yield F.unix_date(v).cast("long")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        yield F.unix_micros(v.cast("timestamp"))
    elif isinstance(kind, (T.FloatType, T.DoubleType)):  # -inf, finite, inf, NaN
        d, inf = v.cast("double"), F.lit(float("inf"))
        odd = F.when(F.isnan(d), 3).when(d == inf, 2).when(d == -inf, 0).otherwise(1)
        yield odd.cast("long")
        yield F.when(odd == 1, d).otherwise(F.lit(0.0))
    elif isinstance(kind, T.StringType):
        hexed, width = F.hex(v.cast("binary")), 2 * STRING_BYTES
        for at in range(0, longest(c), STRING_BYTES):
            yield F.conv(F.rpad(F.substring(hexed, 1 + 2 * at, width), width, "0"), 16, 10).cast("long")
        yield F.octet_length(v).cast("long")
    else:
        raise TypeError(f"no order by selection on {c}: {kind.simpleString()}")


def _bin(digit: Column, low, high) -> Column:
    """Number of the bin, from 0, that a digit between ``low`` and ``high`` falls in; grows with the digit."""
    if isinstance(low, int) and high - low < 1 << 62:
        span = max(1, -(-(high - low + 1) // HEAD_BINS))
        return F.floor((digit - F.lit(low)) / F.lit(span)).cast("int")
    low, high = float(low), float(high)
    if high - low < float("inf"):
        place = (digit.cast("double") - F.lit(low)) / F.lit(high - low)
    else:
        place = (digit.cast("double") / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
    return F.least(F.lit(HEAD_BINS - 1), F.greatest(F.lit(0), F.floor(place * HEAD_BINS))).cast("int")


def nth_row(df: DataFrame, n: int, order: Sequence[str], rows: int) -> Row | None:
    """The order columns of the n-th row (from 1), or None where the table has at most n rows."""
    order = list(order)
    left, need = df.select(*order), n  # candidates, and how many of them come up to the n-th row
    longest = lambda c: left.agg(F.max(F.octet_length(c))).first()[0] or 0
    whole = True
    for field in left.schema.fields:
        for digit in _digits(field.name, field.dataType, longest):
            while True:
                low, high, count = left.agg(F.min(digit), F.max(digit), F.count(F.lit(1))).first()
                if whole and need >= count:
                    return None
                if count <= rows:
                    return _nth_of_few(left, need, order)
                if low == high or low is None:
                    break
                at = _bin(digit, low, high)
                for b, size in sorted(left.groupBy(at.alias("b")).count().collect()):  # at most HEAD_BINS + 1 rows
                    if size >= need:
                        left, whole = left.where(at == b), False
                        break
                    need -= size
    raise _ambiguous(order)


def _nth_of_few(left: DataFrame, need: int, order: list[str]) -> Row:
    first = left.orderBy(*order).limit(need + 1).collect()
    if len(first) > need and first[need] == first[need - 1]:
        raise _ambiguous(order)
    return first[need - 1]


def _ambiguous(order: list[str]) -> ValueError:
    return ValueError(f"order {order} does not tell the rows at the cut apart; add a row key")


def up_to(df: DataFrame, order: Sequence[str], last: Row) -> Column:
    """Whether a row comes no later than ``last``."""
    kinds = df.select(*order).schema
    at = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(last, kinds.fields, strict=True)])
    return F.struct(*order) <= at

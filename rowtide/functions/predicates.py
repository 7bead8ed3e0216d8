"""Filter conditions: three words, ``<column> <op> <value>``, as one native Column.

The class of both sides is known when the plan is built, so every usual form
becomes a plain comparison that reaches the scan.  Rules that differ from SQL:

* ``ne`` holds when either side is null;
* ``gt``, ``gte``, ``lt`` and ``lte`` compare two numbers as numbers and everything
  else as text, where null, plain numbers and booleans count as the empty text - so
  ``null gte 3`` holds;
* two floating numbers are equal when they differ by less than the machine epsilon.

A returned condition may be null where it stands for false; ``where`` drops such
rows anyway, and :func:`negated` takes care of it.
"""

from __future__ import annotations

import math
import re
import sys
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide import types as V
from rowtide.errors import ExpressionError
from rowtide.functions.text import compare_text

EPSILON = sys.float_info.epsilon

_INT = re.compile(r"[+-]?[0-9]+")
_FLOAT = re.compile(r"[+-]?(inf|infinity|nan|([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?)", re.IGNORECASE)

# The only canonical date text that fits into one word of a condition.
_DAY = re.compile(r"\d{4}-\d{2}-\d{2}")

ORDERINGS = ("gt", "gte", "lt", "lte")


@dataclass(frozen=True)
class Operand:
    """One side of a comparison: a column, or a literal with its Python value."""

    column: Column
    dtype: T.DataType
    literal: object = None
    is_literal: bool = False

    @property
    def kind(self) -> str:
        return V.value_class(self.dtype)


def _literal(value: object, dtype: T.DataType) -> Operand:
    return Operand(F.lit(value).cast(dtype), dtype, value, True)


def parse_operand(token: str, df: DataFrame) -> Operand:
    """The right-hand word: ``$column``, null, true/false, a number, or text."""
    if token.startswith("$"):
        return column_operand(token[1:], df)
    if token in ("null", "NULL"):
        return _literal(None, T.NullType())
    if token in ("true", "TRUE", "false", "FALSE"):
        return _literal(token.lower() == "true", T.BooleanType())
    if _INT.fullmatch(token) and -(2**63) <= int(token) < 2**63:
        return _literal(int(token), T.LongType())
    if _FLOAT.fullmatch(token):
        return _literal(float(token), T.DoubleType())
    return _literal(token.strip("'"), T.StringType())


def column_operand(name: str, df: DataFrame) -> Operand:
    """A column of the frame; one that does not exist counts as null."""
    dtype = V.column_type(df, name)
    if dtype is None:
        return Operand(F.lit(None), T.NullType())
    return Operand(V.col(name), dtype)


def condition(expr: str, df: DataFrame) -> Column:
    """Compile ``expr`` against the columns of ``df``."""
    words = expr.split()
    if len(words) != 3:
        raise ExpressionError(f"invalid condition {expr.strip()!r}: expected '<column> <op> <value>'")
    name, op, token = words
    left, right = column_operand(name, df), parse_operand(token, df)
    if op in ("is", "not"):
        return _null_test(op, left, right, expr)
    if op == "eq":
        return _equal(left, right)
    if op == "ne":
        return _not_equal(left, right)
    if op in ORDERINGS:
        return _ordered(op, left, right)
    raise ExpressionError(f"unsupported operator {op!r} in {expr.strip()!r}")


def negated(cond: Column) -> Column:
    """True where ``cond`` is false or stands for false."""
    return ~F.coalesce(cond, F.lit(False))


def _null_test(op: str, left: Operand, right: Operand, expr: str) -> Column:
    if right.kind == V.NULL:
        return left.column.isNull() if op == "is" else left.column.isNotNull()
    if right.is_literal:
        raise ExpressionError(f"'{op}' in {expr.strip()!r} needs null on its right side")
    # A column on the right is fine only where it is null.
    test = left.column.isNull() if op == "is" else left.column.isNotNull()
    refuse = F.raise_error(F.lit(f"'{op}' in {expr.strip()!r} needs null on its right side"))
    return F.when(right.column.isNull(), test).otherwise(refuse.cast("boolean"))


def _compare(op: str, a: Column, b: Column) -> Column:
    return {"gt": a > b, "gte": a >= b, "lt": a < b, "lte": a <= b}[op]


def _either_null(left: Operand, right: Operand) -> Column | None:
    """Null test of the sides that can be null, None when both are literals."""
    tests = [o.column.isNull() for o in (left, right) if not o.is_literal]
    if not tests:
        return None
    return tests[0] if len(tests) == 1 else tests[0] | tests[1]


def _same_number(left: Operand, right: Operand) -> Column:
    a, b = left.column, right.column
    if not (V.is_floating(left.dtype) or V.is_floating(right.dtype)):
        return a == b
    near = F.abs(a.cast("double") - b.cast("double")) < F.lit(EPSILON)
    if right.is_literal and V.is_floating(left.dtype):
        # Bounds that every near value satisfies; unlike abs() they reach the scan.
        v = float(right.literal)
        return (a >= F.lit(v - 2 * EPSILON)) & (a <= F.lit(v + 2 * EPSILON)) & near
    return near


def _equal(left: Operand, right: Operand) -> Column:
    kinds = {left.kind, right.kind}
    if V.NULL in kinds:
        return F.lit(False)
    if kinds == {V.NUMBER}:
        return _same_number(left, right)
    if kinds == {V.DATE, V.TEXT} or (kinds == {V.DATE} and left.dtype != right.dtype):
        return _date_compare("eq", left, right)
    if len(kinds) == 1:
        return left.column == right.column
    return F.lit(False)


def _not_equal(left: Operand, right: Operand) -> Column:
    kinds = {left.kind, right.kind}
    if V.NULL in kinds or (len(kinds) > 1 and kinds != {V.DATE, V.TEXT}):
        return F.lit(True)
    floating = V.is_floating(left.dtype) or V.is_floating(right.dtype)
    if len(kinds) > 1 or left.dtype != right.dtype and kinds == {V.DATE} or floating:
        return negated(_equal(left, right))
    differs = left.column != right.column
    missing = _either_null(left, right)
    return differs if missing is None else missing | differs


def _ordered(op: str, left: Operand, right: Operand) -> Column:
    kinds = {left.kind, right.kind}
    if kinds == {V.NUMBER}:
        return _ordered_numbers(op, left, right)
    if left.kind == right.kind == V.TEXT or (kinds <= {V.DATE, V.TEXT} and V.DATE in kinds):
        return _ordered_texts(op, left, right)
    a, b = compare_text(left.column, left.dtype), compare_text(right.column, right.dtype)
    if _counts_as_empty(left) and _counts_as_empty(right):
        return F.lit(op in ("gte", "lte"))
    if _counts_as_empty(right) and not left.is_literal:
        return _against_empty(op, left)
    return _compare(op, a, b)


def _counts_as_empty(o: Operand) -> bool:
    return o.kind in (V.NULL, V.BOOL, V.BYTES) or (
        o.kind == V.NUMBER and not isinstance(o.dtype, T.DecimalType)
    )


def _against_empty(op: str, left: Operand) -> Column:
    """``left`` as text against the empty text, without building the text."""
    if op == "gte":
        return F.lit(True)
    if op == "lt":
        return F.lit(False)
    blank = left.column.isNull()
    if left.kind == V.TEXT:
        return left.column > F.lit("") if op == "gt" else blank | (left.column == F.lit(""))
    return left.column.isNotNull() if op == "gt" else blank


def _whole_bound(op: str, left: Operand, right: Operand) -> Column | None:
    """A whole column against a fraction, as a whole bound: unlike the fraction it reaches the scan."""
    if not (isinstance(left.dtype, T.IntegralType) and right.is_literal and V.is_floating(right.dtype)):
        return None
    value = float(right.literal)
    if left.is_literal or not abs(value) < 2**53:
        return None
    bound = math.floor(value) if op in ("gt", "lte") else math.ceil(value)
    least, most = {"tinyint": (-(2**7), 2**7 - 1), "smallint": (-(2**15), 2**15 - 1), "int": (-(2**31), 2**31 - 1)}.get(left.dtype.simpleString(), (-(2**63), 2**63 - 1))
    if not least <= bound <= most:
        return None
    return _compare(op, left.column, F.lit(bound).cast(left.dtype))


def _ordered_numbers(op: str, left: Operand, right: Operand) -> Column:
    native = _whole_bound(op, left, right)
    if native is None:
        native = _compare(op, left.column, right.column)
    missing = _either_null(left, right)
    decimals = [o for o in (left, right) if isinstance(o.dtype, T.DecimalType) and not o.is_literal]
    both_columns = not left.is_literal and not right.is_literal
    if both_columns and decimals:
        # Beside a null, a decimal counts as its (non-empty) text.
        text = _compare(
            op, compare_text(left.column, left.dtype), compare_text(right.column, right.dtype)
        )
        return F.when(missing, text).otherwise(native)
    if op in ("gt", "lt") or missing is None:
        return native
    return missing | native


def _ordered_texts(op: str, left: Operand, right: Operand) -> Column:
    if V.DATE in (left.kind, right.kind):
        if left.dtype != right.dtype:
            return _date_compare(op, left, right)
        # Equal types: the native order is the order of the texts.
        native = _compare(op, left.column, right.column)
        a_null, b_null = left.column.isNull(), right.column.isNull()
        rest = {"gt": b_null & ~a_null, "gte": b_null, "lt": a_null & ~b_null, "lte": a_null}[op]
        return rest | native
    if right.is_literal:
        text = str(right.literal)
        if text == "":
            return _against_empty(op, left)
        native = _compare(op, left.column, right.column)
        return native if op in ("gt", "gte") else left.column.isNull() | native
    a, b = compare_text(left.column, left.dtype), compare_text(right.column, right.dtype)
    return _compare(op, a, b)


def _date_compare(op: str, left: Operand, right: Operand) -> Column:
    """Dates against text or another date type, by their canonical text."""
    if left.kind == V.DATE and right.is_literal:
        moment = V.parse_moment(str(right.literal))
        # Canonical literals compare natively, so that the scan sees them.
        if moment is not None and _DAY.fullmatch(str(right.literal)):
            bound = F.lit(str(right.literal)).cast(left.dtype)
            if op == "eq":
                return left.column == bound
            native = _compare(op, left.column, bound)
            return native if op in ("gt", "gte") else left.column.isNull() | native
    a, b = compare_text(left.column, left.dtype), compare_text(right.column, right.dtype)
    if op == "eq":
        return left.column.isNotNull() & right.column.isNotNull() & (a == b)
    return _compare(op, a, b)

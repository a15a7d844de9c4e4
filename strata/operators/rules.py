"""Declarative row rules compiled to a single array-of-codes column.

A rule is a code plus a boolean Column. The compiled column holds, in rule
order, the codes whose predicate is true; a predicate that evaluates to null
emits nothing (SQL ``CASE WHEN`` semantics). Because order is kept, two code
arrays can be compared by value.

Every family below is a small constructor; domain packs are lists of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.periods import col_, is_period, period_in_future, period_too_old


@dataclass(frozen=True)
class Rule:
    code: str
    predicate: Column
    family: str = ""


def compile_codes(rules: Sequence[Rule]) -> Column:
    """The codes ``c1, c2, ...`` whose predicates hold, in rule order.

    Arrays of one code or none, flattened: ``array_compact`` has no generated code, and
    with it every predicate below would be interpreted, row by row.
    """
    none = F.array().cast("array<string>")
    if not rules:
        return none
    return F.flatten(F.array(*[F.when(r.predicate, F.array(F.lit(r.code))).otherwise(none) for r in rules]))


def codes_text(codes: str | Column, sep: str = ", ") -> Column:
    return F.array_join(col_(codes), sep)


def rejection_message(codes: str | Column) -> Column:
    """``Validation failed: code_a, code_b``."""
    return F.concat(F.lit("Validation failed: "), codes_text(codes))


def _any(cols: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols)


def _dec(x: float | int | str | Decimal) -> Column:
    """Exact decimal literal (never a binary float)."""
    d = Decimal(str(x))
    digits = max(-d.as_tuple().exponent, 0)
    precision = max(len(d.as_tuple().digits), digits + 1)
    return F.lit(d).cast(f"decimal({min(precision + 1, 38)},{digits})")


# --- families (V01-V20) -------------------------------------------------------


def missing(code: str, c: str | Column) -> Rule:
    """Value is null."""
    return Rule(code, col_(c).isNull(), "missing")


def unknown_reference(code: str, found_key: str | Column) -> Rule:
    """The left-joined dimension key is null (a null FK is also unknown)."""
    return Rule(code, col_(found_key).isNull(), "unknown_reference")


def bad_format(code: str, c: str | Column, pattern: str) -> Rule:
    """Non-null and not matching ``pattern`` (use ``\\z`` to anchor the end)."""
    x = col_(c)
    return Rule(code, x.isNotNull() & ~x.rlike(pattern), "format")


def invalid_period(code: str, c: str | Column) -> Rule:
    x = col_(c)
    return Rule(code, x.isNotNull() & ~is_period(x), "format")


def period_older_than(code: str, c: str | Column, oldest: str) -> Rule:
    """Well-formed period whose first day is before ``oldest``."""
    return Rule(code, period_too_old(c, oldest), "too_old")


def period_after(code: str, c: str | Column, as_of: str) -> Rule:
    """Well-formed period starting after ``as_of + 1 month``."""
    return Rule(code, period_in_future(c, as_of), "in_future")


def not_in(code: str, c: str | Column, values: Sequence[str]) -> Rule:
    """Non-null and not one of ``values``."""
    x = col_(c)
    return Rule(code, x.isNotNull() & ~x.isin(list(values)), "enum")


def not_licensed(code: str, found_key: str | Column, value: str | Column, allowed: str | Column) -> Rule:
    """Dimension row found, value non-null, value not in the dimension's array."""
    v = col_(value)
    return Rule(code, col_(found_key).isNotNull() & v.isNotNull() & ~F.array_contains(col_(allowed), v), "licence")


def conditional_not_in(code: str, cond: str | Column, cond_value: str, c: str | Column, values: Sequence[str]) -> Rule:
    """When ``cond == cond_value``, ``c`` must be one of ``values`` (null ``c`` yields no code)."""
    return Rule(code, (col_(cond) == F.lit(cond_value)) & ~col_(c).isin(list(values)), "conditional_enum")


def negative(code: str, c: str | Column) -> Rule:
    """V09."""
    return Rule(code, col_(c) < 0, "negative")


def out_of_range(code: str, c: str | Column, lo: float | int | str, hi: float | int | str) -> Rule:
    """``c < lo OR c > hi``."""
    x = col_(c)
    return Rule(code, (x < _dec(lo)) | (x > _dec(hi)), "range")


def exceeds_ratio(code: str, a: str | Column, b: str | Column, factor: float | str) -> Rule:
    """Both present and ``a > b * factor`` with an exact decimal factor."""
    x, y = col_(a), col_(b)
    return Rule(code, x.isNotNull() & y.isNotNull() & (x > y * _dec(factor)), "ratio")


def required_when(code: str, cond: Column, c: str | Column) -> Rule:
    """Under ``cond`` the column must be present."""
    return Rule(code, cond & col_(c).isNull(), "conditional_required")


def forbidden_nonzero_when(code: str, cond: Column, cols: Sequence[str | Column]) -> Rule:
    """Under ``cond`` any of ``cols`` is non-zero (null counts as zero)."""
    return Rule(code, cond & _any(F.coalesce(col_(c), F.lit(0)) != 0 for c in cols), "conditional_forbidden")


def forbidden_present_when(code: str, cond: Column, cols: Sequence[str | Column]) -> Rule:
    """Under ``cond`` any of ``cols`` is non-null."""
    return Rule(code, cond & _any(col_(c).isNotNull() for c in cols), "conditional_forbidden_present")


def required_nonzero_when(code: str, cond: Column, cols: Sequence[str | Column]) -> Rule:
    """Under ``cond`` any of ``cols`` is zero or null."""
    return Rule(code, cond & _any(F.coalesce(col_(c), F.lit(0)) == 0 for c in cols), "conditional_required_nonzero")


def present_unless(code: str, cond: Column, c: str | Column) -> Rule:
    """V16 (forbidden side): value present although ``cond`` does not hold."""
    return Rule(code, ~cond & col_(c).isNotNull(), "required_iff")


def sum_mismatch(code: str, total: str | Column, parts_sum: str | Column, tolerance_pct: float | str = "1.0") -> Rule:
    """``total > 0 and abs(total - sum) > total * tol / 100`` in decimal."""
    t, s = col_(total), col_(parts_sum)
    return Rule(code, (t > 0) & (F.abs(t - s) > t * _dec(tolerance_pct) / F.lit(100)), "sum_tolerance")


def zero_total_with_parts(code: str, total: str | Column, parts_sum: str | Column) -> Rule:
    """V18."""
    return Rule(code, (col_(total) == 0) & (col_(parts_sum) > 0), "zero_total")


def ratio_above(code: str, num: str | Column, den: str | Column, limit: float | str) -> Rule:
    """``den > 0 and num / den > limit`` (division only where guarded)."""
    n, d = col_(num), col_(den)
    return Rule(code, (d > 0) & (n > d * _dec(limit)), "ratio_limit")


def not_equal(code: str, c: str | Column, value: str) -> Rule:
    """``c <> value`` (null yields no code)."""
    return Rule(code, col_(c) != F.lit(value), "single_value")


def coalesced_sum(cols: Sequence[str | Column]) -> Column:
    """Sum of ``coalesce(c, 0)`` over columns."""
    return reduce(lambda a, b: a + b, [F.coalesce(col_(c), F.lit(0)) for c in cols])

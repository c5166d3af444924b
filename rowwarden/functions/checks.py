"""Violation predicates and first-match classifications as columns.

A predicate that comes out null counts as "not violated".
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

EMAIL_PREFIX = "[^@]+@[^@]+\\.[^@]+"

COMPARISONS = {
    "=": operator.eq,
    "==": operator.eq,
    "<>": operator.ne,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(operator.or_, conditions, F.lit(False)) if conditions else F.lit(False)


def missing(fields: Sequence[Column], null_handling: str = "default") -> Column:
    if null_handling == "skip":
        return F.lit(False)
    return any_of([f.isNull() for f in fields])


def outside(value: Column, low=None, high=None, null_handling: str = "default") -> Column:
    tests = []
    if low is not None:
        tests.append(_as_bound(value, low) < F.lit(low))
    if high is not None:
        tests.append(_as_bound(value, high) > F.lit(high))
    if null_handling == "fail":
        tests.append(value.isNull())
    return any_of(tests)


def _as_bound(value: Column, bound) -> Column:
    """The value in the bound's kind; a text that is no number there is null instead of an error."""
    if isinstance(bound, bool) or not isinstance(bound, (int, float)):
        return value
    return value.try_cast("double") if isinstance(bound, float) else value.try_cast("decimal(38,6)")


def anchored(pattern: str, match: str) -> str:
    """The pattern for finding anywhere, matching from the start, or matching the whole text."""
    if match == "find":
        return pattern
    if match == "prefix":
        return f"\\A(?:{pattern})"
    if match == "full":
        return f"\\A(?:{pattern})\\z"
    raise ValueError(f"match must be find, prefix or full, not {match!r}")


def not_like(value: Column, pattern: str, match: str = "find", null_handling: str = "default") -> Column:
    test = ~value.rlike(anchored(pattern, match))
    if null_handling == "skip":
        return value.isNotNull() & test
    if null_handling == "fail":
        return value.isNull() | test
    return test


def stale(moment: Column, max_age_seconds: int, as_of: Column) -> Column:
    return moment < as_of - F.make_dt_interval(secs=F.lit(int(max_age_seconds)))


def disagrees(left: Column, op: str, right: Column) -> Column:
    if op not in COMPARISONS:
        raise ValueError(f"comparison {op!r} is not one of {sorted(COMPARISONS)}")
    return ~COMPARISONS[op](left, right)


def not_listed(value: Column, allowed: Sequence) -> Column:
    return ~value.isin(list(allowed)) if allowed else F.lit(False)


def listed(value: Column, banned: Sequence) -> Column:
    return value.isin(list(banned)) if banned else F.lit(False)


def first_match(branches: Sequence[tuple[Column, object]], default) -> Column:
    """Ordered branches, the first true one wins."""
    chain = F
    for condition, outcome in branches:
        chain = chain.when(condition, outcome if isinstance(outcome, Column) else F.lit(outcome))
    default = default if isinstance(default, Column) else F.lit(default)
    return default if chain is F else chain.otherwise(default)


# Status vocabularies: fixed values.

def pass_fail(key: Column, value: Column, moment: Column) -> Column:
    return first_match(
        [(key.isNull(), "FAIL_ID_NULL"), (value < 0, "FAIL_NEG_VALUE"), (moment.isNull(), "FAIL_TS_NULL")],
        "PASS",
    )


def change_status(key: Column, amount: Column, moment: Column, as_of: Column, max_age_days: int = 7) -> Column:
    return first_match(
        [
            (key.isNull(), "FAIL_ID_NULL"),
            (amount.isNull(), "FAIL_AMOUNT_NULL"),
            (amount < 0, "FAIL_NEG_AMOUNT"),
            (stale(moment, max_age_days * 86400, as_of), "WARN_OLD_EVENT"),
        ],
        "PASS",
    )


def missing_or_negative(key: Column, value: Column) -> Column:
    return first_match(
        [(key.isNull(), "MISSING_ID"), (value.isNull(), "MISSING_VALUE"), (value < 0, "NEGATIVE_VALUE")],
        "VALID",
    )


def amount_status(key: Column, amount: Column, expected: Column, status: Column, expected_status: Column) -> Column:
    return first_match(
        [
            (key.isNull(), "FAIL_PK_NULL"),
            (amount != expected, "FAIL_AMOUNT_MISMATCH"),
            (status != expected_status, "FAIL_STATUS_MISMATCH"),
        ],
        "PASS",
    )


def hash_pair(source: Column, cloud: Column) -> tuple[Column, Column, Column]:
    """`(dq_status, dq_reason, dq_error_total)` of two digests."""
    gone = source.isNull() | cloud.isNull()
    status = F.when(gone | (source != cloud), "INVALID").otherwise("VALID")
    reason = first_match(
        [
            (source.isNull(), "SOURCE_HASH_MISSING"),
            (cloud.isNull(), "CLOUD_HASH_MISSING"),
            (source != cloud, "HASH_MISMATCH"),
        ],
        "OK",
    )
    score = first_match([(gone, 2), (source != cloud, 1)], 0)
    return status, reason, score


def hash_match(source: Column, cloud: Column) -> Column:
    return F.coalesce(source == cloud, F.lit(False))


def null_check(value: Column) -> Column:
    return F.when(value.isNull(), "FAIL").otherwise("PASS")


def bounds_check(value: Column, low=0, high=100) -> Column:
    return F.when(outside(value, low, high), "FAIL").otherwise("PASS")

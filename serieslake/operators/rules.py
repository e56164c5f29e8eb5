"""Row rules that warn, drop or fail, with counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WARN, DROP, FAIL = "warn", "drop", "fail"
BROKEN = "_broken_rules"


class RuleViolation(Exception):
    """A fail rule or a dataset check did not hold; nothing was published."""


@dataclass(frozen=True)
class Rule:
    """A named SQL condition on the rows of a dataset.  A NULL outcome counts as broken."""

    name: str
    condition: str
    action: str = DROP

    def __post_init__(self) -> None:
        if self.action not in (WARN, DROP, FAIL):
            raise ValueError(f"unknown action {self.action!r}")

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


def _dropping(rules: Sequence[Rule]) -> list[Rule]:
    return [rule for rule in rules if rule.action == DROP]


def passes(rules: Sequence[Rule]) -> Column:
    """True for rows that every drop rule lets through."""
    return reduce(Column.__and__, [rule.holds() for rule in _dropping(rules)], F.lit(True))


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that pass the drop rules; an ordinary filter, so it reaches the scan."""
    for rule in _dropping(rules):
        df = df.filter(rule.holds())
    return df


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break any rule, with the names of the rules they break."""
    broken = F.filter(
        F.array(*[F.when(~rule.holds(), F.lit(rule.name)) for rule in rules]), lambda name: name.isNotNull()
    )
    return df.withColumn(BROKEN, broken).filter(F.size(BROKEN) > 0)


def rule_aggregates(rules: Sequence[Rule]) -> list[Column]:
    """Counts for one pass: rows seen, rows kept, and rows that break each rule."""
    return [
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(passes(rules)).alias("rows_kept"),
        *[F.count_if(~rule.holds()).alias(f"broken_{i}") for i, rule in enumerate(rules)],
    ]


def count_rows(rules: Sequence[Rule], counts: Mapping[str, int]) -> list[tuple[str, str, int, int]]:
    """(rule, action, rows seen, rows broken) from the outcome of ``rule_aggregates``."""
    return [(r.name, r.action, counts["rows_in"], counts[f"broken_{i}"]) for i, r in enumerate(rules)]


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with its counts, in a single pass over ``df``."""
    wide = df.agg(*rule_aggregates(rules))
    rows = [
        F.struct(
            F.lit(rule.name).alias("rule"), F.lit(rule.action).alias("action"), F.col("rows_in"),
            F.col(f"broken_{i}").alias("rows_broken"),
        )
        for i, rule in enumerate(rules)
    ]
    return wide.select(F.inline(F.array(*rows)))


def require(rules: Sequence[Rule], counts: Mapping[str, int], min_rows: int = 0) -> None:
    """Raise if a fail rule was broken, or if fewer rows than ``min_rows`` are left.

    The row count matters because an empty dataset breaks no row rule.
    """
    for i, rule in enumerate(rules):
        if rule.action == FAIL and counts[f"broken_{i}"] > 0:
            raise RuleViolation(f"{rule.name}: {counts[f'broken_{i}']} of {counts['rows_in']} rows")
    if counts["rows_kept"] < min_rows:
        raise RuleViolation(f"{counts['rows_kept']} rows kept, at least {min_rows} needed")

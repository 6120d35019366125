"""Declarative rule sets compiled to a single CASE expression.

A rule is a name plus a *failure* condition. A rule set evaluates its rules in order and
yields the first failing rule's name (NULL when all pass). The optimizer sees one CASE
column, so validity, DLQ reason and status share one projection inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil import config

ColumnFn = Callable[[], Column]


@dataclass(frozen=True)
class Rule:
    name: str
    fails: ColumnFn  # built lazily so that rule sets can be module constants


@dataclass(frozen=True)
class RuleSet:
    name: str
    rules: tuple[Rule, ...]

    def first_failure(self) -> Column:
        """Name of the first failing rule, NULL if the row passes every rule.

        A failure condition that evaluates to NULL counts as passing, as in SQL CASE.
        """
        expr = None
        for rule in self.rules:
            cond = F.coalesce(rule.fails(), F.lit(False))
            expr = F.when(cond, F.lit(rule.name)) if expr is None else expr.when(cond, F.lit(rule.name))
        return expr if expr is not None else F.lit(None).cast("string")

    def status(self, valid: str = "valid", invalid: str = "invalid") -> Column:
        return F.when(self.first_failure().isNull(), F.lit(valid)).otherwise(F.lit(invalid))

    def __add__(self, other: "RuleSet") -> "RuleSet":
        return RuleSet(f"{self.name}+{other.name}", self.rules + other.rules)


def outside(col: str, low, high) -> Column:
    """True when ``col`` is outside the inclusive range [low, high]."""
    c = F.col(col)
    cond = None
    if low is not None:
        cond = c < F.lit(low)
    if high is not None:
        upper = c > F.lit(high)
        cond = upper if cond is None else (cond | upper)
    return cond if cond is not None else F.lit(False)


def null_rules(columns: Sequence[str]) -> tuple[Rule, ...]:
    return tuple(Rule(f"missing_{c}", lambda c=c: F.col(c).isNull()) for c in columns)


def range_rules(bounds: dict, reason: str | None = None) -> tuple[Rule, ...]:
    return tuple(Rule(reason or f"{c}_out_of_range", lambda c=c, b=b: outside(c, *b))
                 for c, b in bounds.items())


def operational_rules(time_col: str = "timestamp", time_is_text: bool = True,
                      bounds: dict | None = None) -> RuleSet:
    """Stream validity (V1): eight null checks, the event time, then the five ranges.

    An event time that is present but unparseable is ``invalid_timestamp`` (it would
    otherwise become a NULL event time or, under ANSI mode, fail the whole query).
    """
    fields = ("patient_id", "event_id", time_col, "heart_rate", "spo2", "systolic_bp",
              "diastolic_bp", "temperature")
    rules = list(null_rules(fields))
    if time_is_text:
        from vigil.functions.parse import parse_event_time
        rules.append(Rule("invalid_timestamp", lambda: parse_event_time(F.col(time_col)).isNull()))
    rules.extend(range_rules(bounds or config.OPERATIONAL_BOUNDS))
    return RuleSet("operational", tuple(rules))


def bp_consistency_rule(systolic: str = "systolic_bp", diastolic: str = "diastolic_bp") -> Rule:
    """V3: systolic must be strictly greater than diastolic (equal values fail)."""
    return Rule("bp_inconsistent", lambda: F.col(systolic) <= F.col(diastolic))


def device_limit_rules(bounds: dict | None = None, reason: str = "range_error") -> RuleSet:
    """V2: device limits in the order HR, SpO2, blood pressure (both + consistency), T."""
    b = bounds or config.DEVICE_BOUNDS
    bp = b["blood_pressure"]
    rules = (
        Rule(reason, lambda: outside("heart_rate", *b["heart_rate"])),
        Rule(reason, lambda: outside("spo2", *b["spo2"])),
        Rule(reason, lambda: outside("systolic_bp", *bp) | outside("diastolic_bp", *bp)
             | (F.col("systolic_bp") <= F.col("diastolic_bp"))),
        Rule(reason, lambda: outside("temperature", *b["temperature"])),
    )
    return RuleSet("device_limits", rules)


def abnormal_flag(bounds: dict | None = None) -> Column:
    """1 when any measure is strictly outside its abnormality band, else 0."""
    cond = None
    for c, (low, high) in (bounds or config.ABNORMAL_BOUNDS).items():
        part = outside(c, low, high)
        cond = part if cond is None else (cond | part)
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(1)).otherwise(F.lit(0))


def risk_tier(count: Column) -> Column:
    """0 -> normal, 1 -> watch, 2+ -> elevated; NULL -> normal."""
    normal, watch, elevated = config.RISK_LEVELS
    return (F.when(count >= 2, F.lit(elevated))
            .when(count == 1, F.lit(watch))
            .otherwise(F.lit(normal)))


def tier_rank(flag: Column) -> Column:
    normal, watch, elevated = config.RISK_LEVELS
    return F.when(flag == elevated, 2).when(flag == watch, 1).otherwise(0)


def combine_risk(trend_flag: Column, lab_flag: Column) -> Column:
    """Any elevated, or watch + watch -> elevated; one watch -> watch; else normal.

    Equivalent to ``least(2, rank(trend) + rank(lab))`` mapped back to a tier.
    """
    return risk_tier(F.least(F.lit(2), tier_rank(trend_flag) + tier_rank(lab_flag)))

"""Ordered validation rules, all evaluated in one projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A reason and the condition under which a row fails; an unknown condition fails."""

    reason: str
    fails: Column


def failed_reasons(rules: Sequence[Rule]) -> Column:
    """The reasons of every failed rule, in rule order."""
    reasons = F.array(*[
        F.when(F.coalesce(rule.fails, F.lit(True)), F.lit(rule.reason)) for rule in rules
    ])
    # Reasons are distinct, so taking nulls away this way keeps all of them, and
    # unlike a lambda it stays inside whole-stage code generation.
    return F.array_except(reasons, F.array(F.lit(None).cast("string")))

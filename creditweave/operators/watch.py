"""Row rules counted by the job that writes the rows, without a scan of their own."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


class RuleViolation(ValueError):
    """More rows break a rule than are allowed; ``counts`` has all of them."""

    def __init__(self, counts: Mapping[str, int], broken: Mapping[str, int]):
        super().__init__("rows break rules: " + ", ".join(f"{name} {n}" for name, n in broken.items()))
        self.counts = dict(counts)


def violation_counts(rules: Mapping[str, Column]) -> list[Column]:
    """For ``DataFrame.observe``: how many rows meet each condition."""
    return [F.count_if(F.coalesce(broken, F.lit(False))).alias(name) for name, broken in rules.items()]


def check_limits(counts: Mapping[str, int], limits: Mapping[str, int]) -> None:
    """Raises if a rule is broken more often than its limit, which is 0 where none is given."""
    broken = {name: n for name, n in counts.items() if n > limits.get(name, 0)}
    if broken:
        raise RuleViolation(counts, broken)

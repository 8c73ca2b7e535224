"""Row rules of applications and calls."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditweave.functions.scoring import APPROVED, MANUAL_REVIEW, REJECTED, decision_allowed

# The call status that carries a client response, and the response otherwise.
ANSWERED = "answered"
UNKNOWN_RESPONSE = "unknown"

RULE_NAMES = (
    "approved_amount_is_requested",
    "rejected_amount_is_zero",
    "manual_amount_in_range",
    "manual_is_flagged",
    "decision_fits_score",
)


def _broken(applies: Column, holds: Column) -> Column:
    """A rule is broken where it applies and is not known to hold (an unknown value breaks it)."""
    return F.coalesce(applies, F.lit(False)) & ~F.coalesce(holds, F.lit(False))


def decision_rules() -> dict[str, Column]:
    """Rule name to the condition that breaks it, over clean applications."""
    decision = F.col("decision_status")
    approved, requested = F.col("approved_amount"), F.col("requested_amount")
    return {
        "approved_amount_is_requested": _broken(decision == APPROVED, approved == requested),
        "rejected_amount_is_zero": _broken(decision == REJECTED, approved == 0),
        "manual_amount_in_range": _broken(
            decision == MANUAL_REVIEW, (approved >= 0) & (approved <= requested)
        ),
        "manual_is_flagged": _broken(decision == MANUAL_REVIEW, F.col("employee_review_flag")),
        "decision_fits_score": _broken(F.lit(True), decision_allowed(F.col("credit_score"), decision)),
    }


def decision_violations(clean: DataFrame) -> DataFrame:
    """Applications that break a rule, with the array ``violated_rules``."""
    rules = decision_rules()
    named = [F.when(broken, name) for name, broken in rules.items()]
    return clean.filter(reduce(or_, rules.values())).withColumn(
        "violated_rules", F.array_compact(F.array(*named))
    )


def count_violations(clean: DataFrame) -> DataFrame:
    """Number of violations of each rule: all rules in one scan, then one row per rule."""
    rules = decision_rules()
    totals = clean.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    return totals.unpivot([], list(rules), "rule", "violations")


def apply_response_rule(calls: DataFrame) -> DataFrame:
    """A call that was not answered has no client response."""
    answered = F.col("call_status") == ANSWERED
    return calls.withColumn(
        "client_response", F.when(answered, F.col("client_response")).otherwise(UNKNOWN_RESPONSE)
    )

"""Deterministic scoring rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score bounds, risk bands and decisions.
LOW_RISK_FROM = 700
MEDIUM_RISK_FROM = 560
LOW, MEDIUM, HIGH = "low", "medium", "high"
APPROVED, REJECTED, MANUAL_REVIEW = "approved", "rejected", "manual_review"


def risk_band(score: Column) -> Column:
    """Risk band of a score; NULL for an unknown score."""
    return (
        F.when(score >= LOW_RISK_FROM, LOW)
        .when(score >= MEDIUM_RISK_FROM, MEDIUM)
        .when(score.isNotNull(), HIGH)
    )


def decision_allowed(score: Column, decision: Column) -> Column:
    """Whether a decision may follow from a score; NULL if either is unknown."""
    band = risk_band(score)
    return (
        F.when(band == LOW, decision.isin(APPROVED, MANUAL_REVIEW))
        .when(band == MEDIUM, decision.isin(APPROVED, REJECTED, MANUAL_REVIEW))
        .when(band == HIGH, decision.isin(REJECTED, MANUAL_REVIEW))
    )

"""Ranking model as Column expressions.

A fitted ranker is a set of logistic-regression coefficients plus the median
imputation values learned on the training rows.  Scoring it as a Column keeps
inference inside whole-stage codegen instead of a Python UDF.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: feature order expected by the ranker.
FEATURES = ("distance_km", "accept_rate_7d", "avg_response_ms")


@dataclass(frozen=True)
class Ranker:
    """Logistic ranker: ``p = 1 / (1 + exp(-(intercept + Σ w_i x_i)))``."""

    intercept: float
    weights: dict[str, float]
    impute: dict[str, float] = field(default_factory=dict)
    features: tuple[str, ...] = FEATURES

    def feature(self, name: str, col: Column | None = None) -> Column:
        c = F.col(name) if col is None else col
        if name in self.impute:  # NaN is missing, as null is
            c = F.coalesce(F.when(~F.isnan(c), c), F.lit(float(self.impute[name])))
        return c

    def logit(self, cols: dict[str, Column] | None = None) -> Column:
        cols = cols or {}
        expr = F.lit(float(self.intercept))
        for name in self.features:
            expr = expr + F.lit(float(self.weights[name])) * self.feature(name, cols.get(name))
        return expr

    def static_logit(self, skip: str = "distance_km") -> Column:
        """Part of the logit that depends on the driver row only."""
        expr = F.lit(0.0)
        for name in self.features:
            if name != skip:
                expr = expr + F.lit(float(self.weights[name])) * self.feature(name)
        return expr

    def to_row(self) -> dict:
        return {"intercept": self.intercept,
                **{f"w_{k}": v for k, v in self.weights.items()},
                **{f"impute_{k}": v for k, v in self.impute.items()}}


def sigmoid(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def score(ranker: Ranker, cols: dict[str, Column] | None = None) -> Column:
    """Probability of class 1 (a good match)."""
    return sigmoid(ranker.logit(cols))


def predict_label(score_col: Column, threshold: float = 0.5) -> Column:
    return (score_col > F.lit(threshold)).cast("int")


# Coefficients used by the oracle fixtures (not a trained model).
FIXTURE_RANKER = Ranker(
    intercept=1.0,
    weights={"distance_km": -0.8, "accept_rate_7d": 0.5, "avg_response_ms": -0.0001},
    impute={"accept_rate_7d": 0.74, "avg_response_ms": 850.0},
)

"""Churn classifier: scaled features, balanced classes, L2 logistic regression by Newton steps.

With a handful of features a Newton step is one aggregate: the gradient and the Hessian are sums over the rows (twenty
numbers for four features), and only those come to the driver. The number of steps is fixed, and enough to reach the optimum to the last
digits, so the fit depends neither on the order of the rows nor on a tolerance.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = ("frequency", "monetary", "avg_order_value", "tenure_days")
#: Newton steps of a fit; the error squares with each of them once it is small.
STEPS = 12


def balanced_weight(df: DataFrame, label: str) -> tuple[Column, int]:
    """``n / (classes * rows of the class)`` as a literal per class, and n, which they add up to."""
    rows = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(rows.values())
    weights = F.create_map(*[F.lit(x) for c, k in rows.items() for x in (c, n / (len(rows) * k))])
    return weights[F.col(label)], n


@dataclass(frozen=True)
class ChurnModel:
    """Coefficients per scaled feature; ``means`` and ``deviations`` (sample) are those of the training rows."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]
    intercept: float
    weights: tuple[float, ...]
    n_train: int

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``churn_probability`` and ``churn_pred`` to every row."""
        z = _score([F.lit(self.intercept)] + [F.lit(b) for b in self.weights], _scaled(self.features, self.means, self.deviations))
        p = 1 / (1 + F.exp(-z))
        return df.select(*df.columns, p.alias("churn_probability"), (z > 0).cast("int").alias("churn_pred"))

    def coefficients(self) -> dict[str, float]:
        """Per feature scaled by its population standard deviation, lowest first."""
        back = math.sqrt((self.n_train - 1) / self.n_train)
        return dict(sorted(((f, b * back) for f, b in zip(self.features, self.weights)), key=lambda p: p[1]))

    def coefficient_table(self, df: DataFrame) -> DataFrame:
        return df.sparkSession.createDataFrame(list(self.coefficients().items()), "feature string, coefficient double")


def _filled(c: str) -> Column:
    return F.coalesce(F.col(c).cast("double"), F.lit(0.0))


def _scaled(features, means, deviations) -> list[Column]:
    """One, then every feature less its mean over its deviation; a constant feature is zero."""
    return [F.lit(1.0)] + [(_filled(c) - F.lit(m)) / F.lit(d) if d else F.lit(0.0) for c, m, d in zip(features, means, deviations)]


def _score(weights: list[Column], x: list[Column]) -> Column:
    return sum((b * v for b, v in zip(weights[1:], x[1:])), weights[0])


def churn_model(
    train: DataFrame, features: tuple[str, ...] = FEATURES, label: str = "churned", l2: float = 1.0, steps: int = STEPS
) -> ChurnModel:
    """Fit on ``train`` only; missing features count as zero.

    The objective is the weighted loss sum plus ``l2 / 2`` times the squared
    coefficients of features scaled by the population deviation; here features are scaled by the
    sample deviation, hence the factor ``(n - 1) / n`` in the penalty. ``train`` should be stored: each step reads it once.
    """
    weight, n = balanced_weight(train, label)
    sums = train.agg(*[f(_filled(c)) for c in features for f in (F.avg, F.stddev_samp)]).first()
    means, deviations = tuple(sums[0::2]), tuple(x if x and not math.isnan(x) else 0.0 for x in sums[1::2])
    x = _scaled(features, means, deviations)
    width = len(x)
    penalty = np.diag([0.0] + [l2 * (n - 1) / n] * len(features))
    pairs = [(i, j) for i in range(width) for j in range(i + 1)]
    beta = np.zeros(width)
    rows = train.select(F.col(label).cast("double").alias("_y"), weight.alias("_w"), *[v.alias(f"_x{i}") for i, v in enumerate(x)])
    own = [F.col(f"_x{i}") for i in range(width)]
    for _ in range(steps):
        p = 1 / (1 + F.exp(-_score([F.lit(float(b)) for b in beta], own)))
        here = rows.withColumns({"_slope": F.col("_w") * (p - F.col("_y")), "_bend": F.col("_w") * p * (1 - p)})
        got = here.agg(*[F.sum(F.col("_slope") * v) for v in own], *[F.sum(F.col("_bend") * own[i] * own[j]) for i, j in pairs]).first()
        gradient = np.array(got[:width]) + penalty @ beta
        hessian = penalty.copy()
        for (i, j), v in zip(pairs, got[width:]):
            hessian[i, j] += v
            if i != j:
                hessian[j, i] += v
        beta = beta - np.linalg.solve(hessian, gradient)
    return ChurnModel(tuple(features), means, deviations, float(beta[0]), tuple(map(float, beta[1:])), n)

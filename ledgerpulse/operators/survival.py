"""Kaplan-Meier and Cox proportional hazards.

Durations are whole days. Rows are aggregated to one per distinct day first, so
the ordered windows run over the days of history, not over accounts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..sources.workspace import materialize

# Tied deaths of one day are summed in stretches of this many per task row.
_STRETCH = 4096


def kaplan_meier(
    df: DataFrame, duration: str = "observed_days", event: str = "churned", alpha: float = 0.05
) -> DataFrame:
    """Survival curve with a confidence band on the log(-log) scale."""
    per_day = df.groupBy(F.col(duration).alias("duration")).agg(
        F.count(F.lit(1)).alias("exits"), F.sum(F.col(event).cast("bigint")).alias("deaths")
    )
    later = Window.orderBy(F.desc("duration"))
    upto = Window.orderBy("duration")
    d, n = F.col("deaths"), F.col("at_risk")
    left = F.when(d < n, 1 - ratio(d, n))
    out = (
        per_day.withColumn("at_risk", F.sum("exits").over(later))
        .withColumn("_log", F.sum(F.ln(left)).over(upto))
        .withColumn("_var", F.sum(F.when(d < n, ratio(d, n.cast("double") * (n - d)))).over(upto))
        # Everyone left dies: that is the last day, and survival ends at zero.
        .withColumn("survival", F.when(d < n, F.exp(F.coalesce("_log", F.lit(0.0)))).otherwise(F.lit(0.0)))
    )
    z = NormalDist().inv_cdf(1 - alpha / 2)
    inside = (F.col("survival") > 0) & (F.col("survival") < 1)
    spread = z * F.sqrt("_var") / F.abs(F.col("_log"))
    flat = F.col("survival")
    return out.select(
        "duration", "at_risk", "deaths", (F.col("exits") - d).alias("censored"), "survival",
        F.when(inside, F.pow("survival", F.exp(spread))).otherwise(flat).alias("lower"),
        F.when(inside, F.pow("survival", F.exp(-spread))).otherwise(flat).alias("upper"),
    ).orderBy("duration")


def median_survival(km: DataFrame) -> DataFrame:
    """First day with survival at or below one half; NULL if it stays above.

    The tolerance keeps an exact half from being missed by the last bit of exp/ln.
    """
    return km.filter(F.col("survival") <= 0.5 + 1e-12).agg(F.min("duration").alias("median_days"))


def cox_covariates(features: DataFrame) -> DataFrame:
    """Frequency and the fourth root of money (at least 0.01), with duration and event."""
    return features.select(
        "observed_days", "churned", F.col("frequency").cast("double").alias("frequency"),
        F.pow(F.greatest(F.col("monetary"), F.lit(0.01)), 0.25).alias("monetary_root4"),
    )


@dataclass(frozen=True)
class CoxModel:
    coefficients: dict[str, float]
    log_likelihood: float
    iterations: int

    def hazard_ratios(self, df: DataFrame) -> DataFrame:
        rows = [(c, b, math.exp(b)) for c, b in self.coefficients.items()]
        return df.sparkSession.createDataFrame(rows, "covariate string, coefficient double, hazard_ratio double")


def _per_day(scaled: DataFrame, xs: Sequence[str], beta: np.ndarray) -> DataFrame:
    """Sums over the rows of each day: e^eta times 1, x and xx', for all and for deaths."""
    eta = sum((F.lit(float(b)) * F.col(x) for b, x in zip(beta, xs)), F.lit(0.0))
    died, w = F.col("_event") == 1, F.col("_w")
    sums = {"s": w, **{f"s_{j}": w * F.col(x) for j, x in enumerate(xs)}}
    for j, a in enumerate(xs):
        for k in range(j, len(xs)):
            sums[f"s_{j}_{k}"] = w * F.col(a) * F.col(xs[k])
    deaths = {f"d{name[1:]}": F.when(died, e).otherwise(0.0) for name, e in sums.items()}
    return scaled.withColumn("_w", F.exp(eta)).groupBy("_day").agg(
        F.count_if(died).alias("deaths"),
        *[F.sum(e).alias(name) for name, e in {**sums, **deaths}.items()],
    )


def _efron(per_day: DataFrame, p: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Log of the risk sets, its gradient and Hessian in beta, with Efron's rule for ties.

    The l-th of d tied deaths sees the risk set less l/d of the dying. The ties
    are unfolded in two steps with an exchange in between, so that a day with
    very many deaths is spread over tasks.
    """
    at_risk = Window.orderBy(F.desc("_day"))
    pairs = [(j, k) for j in range(p) for k in range(j, p)]
    names = ["", *[f"_{j}" for j in range(p)], *[f"_{j}_{k}" for j, k in pairs]]
    risk = per_day.withColumns({f"r{m}": F.sum(f"s{m}").over(at_risk) for m in names}).filter("deaths > 0")
    stretches = risk.withColumn(
        "_start", F.explode_outer(F.sequence(F.lit(0).cast("bigint"), F.col("deaths") - 1, F.lit(_STRETCH).cast("bigint")))
    ).repartition("_day", "_start")
    ties = stretches.withColumn(
        "_l", F.explode_outer(F.sequence("_start", F.least(F.col("_start") + _STRETCH, F.col("deaths")) - 1))
    )

    def left(m: str) -> Column:
        return F.col(f"r{m}") - F.col("_l") / F.col("deaths") * F.col(f"d{m}")

    phi = left("")
    out = ties.agg(
        F.sum(F.ln(phi)).alias("log"),
        *[F.sum(left(f"_{j}") / phi).alias(f"g_{j}") for j in range(p)],
        *[
            F.sum(left(f"_{j}_{k}") / phi - left(f"_{j}") * left(f"_{k}") / (phi * phi)).alias(f"h_{j}_{k}")
            for j, k in pairs
        ],
    ).first()
    gradient = np.array([out[f"g_{j}"] for j in range(p)])
    hessian = np.zeros((p, p))
    for j, k in pairs:
        hessian[j, k] = hessian[k, j] = out[f"h_{j}_{k}"]
    return out["log"], gradient, hessian


def cox_fit(
    df: DataFrame,
    duration: str,
    event: str,
    covariates: Sequence[str],
    l2: float = 0.1,
    tol: float = 1e-9,
    max_iter: int = 50,
) -> CoxModel:
    """Newton's method; one aggregate over the rows per step.

    Covariates are scaled to mean 0 and sample deviation 1, and the penalty is
    ``n * l2 / 2`` times the squared scaled coefficients. Only p + p(p+1)/2 sums
    come to the driver.
    """
    xs = [f"_x{j}" for j in range(len(covariates))]
    moments = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(F.col(c).cast("double")).alias(f"{m}{x}") for c, x in zip(covariates, xs)
          for m, f in (("mean", F.avg), ("dev", F.stddev_samp))],
    ).first()
    n = moments["n"]
    dev = np.array([moments[f"dev{x}"] or 1.0 for x in xs])
    scaled = materialize(
        df.select(
            F.col(duration).alias("_day"), F.col(event).cast("int").alias("_event"),
            *[((F.col(c).cast("double") - F.lit(moments[f"mean{x}"])) / F.lit(float(s))).alias(x)
              for c, x, s in zip(covariates, xs, dev)],
        ),
        "cox",
    )
    p = len(xs)
    # The covariates of the deaths enter linearly, so their sum is needed once.
    died = scaled.filter("_event = 1").agg(*[F.sum(x) for x in xs]).first()
    if any(v is None for v in died):
        raise ValueError("no event was observed")
    linear = np.array(list(died))

    def evaluate(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        log, g, h = _efron(_per_day(scaled, xs, beta), p)
        ll = float(beta @ linear) - log - n * l2 / 2 * float(beta @ beta)
        return ll, linear - g - n * l2 * beta, h + n * l2 * np.eye(p)

    beta = np.zeros(p)
    value, gradient, hessian = evaluate(beta)
    for step in range(1, max_iter + 1):
        move = np.linalg.solve(hessian, gradient)
        if np.abs(move).max() < tol:
            break
        new = evaluate(beta + move)
        while new[0] < value - 1e-9 * abs(value) and np.abs(move).max() >= tol:
            move = move / 2
            new = evaluate(beta + move)
        beta = beta + move
        value, gradient, hessian = new
    return CoxModel(dict(zip(covariates, (beta / dev).tolist())), value, step)

"""What a retention campaign would bring in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio, round_half_up
from .accounts import AT_RISK_BELOW, at_risk

# Save rate and cost per contact of the default scenario (fixed values).
DEFAULT_SCENARIO = {"save_rate": 0.25, "unit_cost": 15.0}


def scenario_grid(save_rates: list[float], unit_costs: list[float]) -> list[dict[str, float]]:
    return [{"save_rate": r, "unit_cost": c} for r in save_rates for c in unit_costs]


def retention_whatif(
    scores: DataFrame, scenarios: list[dict[str, float]] | None = None, threshold: float = AT_RISK_BELOW
) -> DataFrame:
    """Accounts saved, revenue kept, cost and net per scenario.

    The accounts are aggregated to one row and that row is unfolded into the
    scenarios, so their number adds nothing to the work over accounts.
    """
    totals = at_risk(scores, threshold).agg(
        F.count(F.lit(1)).alias("at_risk_accounts"),
        round_half_up(F.coalesce(F.sum("monetary"), F.lit(0.0)), 2).alias("at_risk_value"),
    )
    options = F.array(*[
        F.struct(F.lit(float(s["save_rate"])).alias("save_rate"), F.lit(float(s["unit_cost"])).alias("unit_cost"))
        for s in (scenarios or [DEFAULT_SCENARIO])
    ])
    saved = round_half_up(F.col("at_risk_accounts") * F.col("save_rate"), 0)
    mean_value = F.coalesce(ratio("at_risk_value", "at_risk_accounts"), F.lit(0.0))
    return (
        totals.select("*", F.inline(options))
        .withColumns({
            "avg_value": mean_value,
            "accounts_saved": saved.cast("bigint"),
            "revenue_retained": saved * mean_value,
            "total_cost": F.col("at_risk_accounts") * F.col("unit_cost"),
        })
        .withColumn("net_impact", round_half_up(F.col("revenue_retained") - F.col("total_cost"), 2))
        .withColumn("avg_value", round_half_up("avg_value", 2))
        .withColumn("revenue_retained", round_half_up("revenue_retained", 2))
    )

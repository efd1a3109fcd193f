"""What-if simulation (X16): every zone under a grid of investment scenarios, the best zones of each.

The grid is a few lists of assumptions; its size is checked and it enters the
plan as one literal array, so the zones are scanned once and never joined.  The
best zones of a scenario are a rank with a limit: each task keeps its own best
before anything moves.
"""

from __future__ import annotations

from dataclasses import astuple, dataclass, fields
from itertools import product

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Scenarios that fit in a plan.
MOST_SCENARIOS = 1_000


@dataclass(frozen=True)
class Scenario:
    """Own budget, occupancy and nightly price against today's, running costs as a share of revenue, and the wanted net yield."""

    budget_eur: float
    occupancy_factor: float
    price_factor: float
    running_rate: float
    target_yield: float = 0.04


def grid(budgets, occupancies, prices, running_rates, target_yield: float = 0.04) -> list[Scenario]:
    """All combinations of the lists."""
    found = [Scenario(*map(float, values), float(target_yield)) for values in product(budgets, occupancies, prices, running_rates)]
    if not 0 < len(found) <= MOST_SCENARIOS:
        raise ValueError(f"{len(found)} scenarios; from 1 to {MOST_SCENARIOS} are possible")
    return found


def simulate(zones: DataFrame, scenarios: list[Scenario]) -> DataFrame:
    """One row per zone and scenario.

    ``zones`` has zone_id, entry_cost_eur, adr and occupancy_rate.  Yearly
    revenue is 365 nights at the scenario's occupancy (1 at most) and price;
    what the budget does not cover is a shortfall.  Zones with an unknown cost,
    price or occupancy have unknown results.
    """
    if not 0 < len(scenarios) <= MOST_SCENARIOS:
        raise ValueError(f"{len(scenarios)} scenarios; from 1 to {MOST_SCENARIOS} are possible")
    names = [f.name for f in fields(Scenario)]
    literal = F.array(*[F.struct(F.lit(i).alias("scenario"), *[F.lit(v).alias(n) for n, v in zip(names, astuple(s), strict=True)])
                        for i, s in enumerate(scenarios)])
    each = zones.select("zone_id", "entry_cost_eur", "adr", "occupancy_rate", F.inline(literal))
    occupancy = F.when(F.col("occupancy_rate").isNotNull(), F.least(F.lit(1.0), F.col("occupancy_rate") * F.col("occupancy_factor")))
    each = each.withColumn("revenue_eur", F.lit(365.0) * occupancy * (F.col("adr") * F.col("price_factor")))
    each = each.withColumn("cash_flow_eur", F.col("revenue_eur") * (F.lit(1.0) - F.col("running_rate")))
    cost, cash = F.col("entry_cost_eur"), F.col("cash_flow_eur")
    return each.select(
        "scenario", *names, "zone_id", cost, "revenue_eur", cash,
        F.when(cost > 0, cash / cost).alias("net_yield"), F.when(cash > 0, cost / cash).alias("payback_years"),
        F.greatest(F.lit(0.0), cost - F.col("budget_eur")).alias("shortfall_eur"))


def scenario_ranking(zones: DataFrame, scenarios: list[Scenario], k: int = 10) -> DataFrame:
    """The ``k`` best zones of every scenario: those the budget covers, by net yield (equal ones by zone), and whether they reach the target.

    A scenario in which no zone with a known yield is affordable has no row.
    """
    possible = simulate(zones, scenarios).where("net_yield is not null and shortfall_eur = 0").drop("shortfall_eur")
    order = Window.partitionBy("scenario").orderBy(F.col("net_yield").desc(), "zone_id")
    ranked = possible.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.withColumn("on_target", F.col("net_yield") >= F.col("target_yield")).drop("target_yield")

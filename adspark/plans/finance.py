"""Cost and rate columns. Every division by zero gives NULL unless a default is named."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from adspark.functions.columns import as_col, safe_ratio

CPM, FLAT = "CPM", "Flat Rate"


def effective_cpm(rate_type="rate_type", rate="rate", budget="booked_budget",
                  booked="booked_impressions") -> Column:
    """The rate per 1000 impressions; for a flat fee, the fee per 1000 impressions booked."""
    kind = as_col(rate_type)
    return (F.when(kind == CPM, as_col(rate))
            .when(kind == FLAT, F.try_divide(as_col(budget), as_col(booked).cast("double") / 1000)))


def spend(impressions="impressions", flat_rate: str = "prorated", rate_type="rate_type", rate="rate",
          budget="booked_budget", booked="booked_impressions") -> Column:
    """Budget delivered. A flat fee counts by impressions delivered, or in full."""
    shown = as_col(impressions).cast("double") / 1000
    cost = shown * effective_cpm(rate_type, rate, budget, booked)
    if flat_rate == "full":
        return F.when(as_col(rate_type) == FLAT, as_col(budget)).otherwise(cost)
    return cost


def ctr(clicks="clicks", impressions="impressions", percent: bool = True) -> Column:
    """Clicks per impression: in percent, or as a fraction that is 0 when nothing was shown."""
    if percent:
        return safe_ratio(clicks, impressions) * 100
    return safe_ratio(clicks, impressions, default=0)


def cost_per(cost: Column | str, n: Column | str, default: float | None = None) -> Column:
    return safe_ratio(cost, n, default)


def booked_budget(is_added_value="is_added_value", added="added_value_amount", net="net_cost") -> Column:
    return F.when(as_col(is_added_value).cast("int") == 1, as_col(added)).otherwise(as_col(net))

"""Changes between two periods and their display."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKS = ("WOS", "wos_revenue", "wos_cost", "WOS_DC", "WOS_TOTAL")
#: Metrics that change in percentage points, with the factor that makes them percent.
POINTS = {"in_stock_rate": 100.0, "weighted_instock_rate": 100.0, "dc_in_stock_rate": 100.0, "lost_sales_pct": 1.0}
MONEY = ("total_sales_revenue", "mean_stock_retail", "mean_stock_cost", "AUR", "AUC")


def _floored(metric: Column, value: Column) -> Column:
    return F.when(metric.isin(*WEEKS), F.floor(value).cast("double")).otherwise(value)


def change_pct(metric: Column, prior: Column, current: Column) -> Column:
    """Relative change in percent; weeks of supply are floored first. Null for metrics that change in points, where a
    value is null, or where the prior value is 0."""
    p, c = _floored(metric, prior), _floored(metric, current)
    return F.when(~metric.isin(*POINTS), F.try_divide(c - p, F.abs(p)) * 100)


def change_pp(metric: Column, prior: Column, current: Column) -> Column:
    """Change in percentage points; null for metrics that change relatively."""
    factor = F.lit(None).cast("double")
    for name, by in POINTS.items():
        factor = F.when(metric == name, F.lit(by)).otherwise(factor)
    return (current - prior) * factor


def display(metric: str, value: float | None) -> str:
    """How the report shows a value; a dash for none."""
    if value is None or math.isnan(value):
        return "—"
    if metric in POINTS:
        return f"{value * POINTS[metric]:.1f}%"
    if metric in WEEKS:
        return f"{math.floor(value)}"
    sign, size = ("-" if value < 0 else ""), abs(value)
    money = "$" if metric in MONEY else ""
    if size >= 1e6:
        return f"{sign}{money}{size / 1e6:.1f}M" if money else f"{sign}{size / 1e6:.2f}M"
    if size >= 1e3:
        return f"{sign}{money}{size / 1e3:.1f}K"
    return f"{sign}{money}{size:.2f}" if metric in ("AUR", "AUC", "inventory_turnover_rate") else f"{sign}{money}{size:.0f}"


def display_change(metric: str, pct: float | None, pp: float | None) -> str:
    value, unit = (pp, " pp") if metric in POINTS else (pct, "%")
    return "—" if value is None or math.isnan(value) else f"{value:+.1f}{unit}"

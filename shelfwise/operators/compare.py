"""Comparisons between periods, like for like, and of scopes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.changes import change_pct, change_pp
from .calendar import complete_periods, period_bridge
from .metrics import Facts, Rules, kpi_table, unpivoted
from .slices import Slices

SLICE = ["root", "dimension", "dimension_value"]


def links(table: DataFrame, metrics: Iterable[str], period_type: str, kind: str, latest_only: bool = False) -> DataFrame:
    """Each period of a kind with the one before it that the slice has (they need not be adjacent), per metric;
    ``latest_only`` keeps a slice's last link. Slices of a null value are left out."""
    rows = table.where((F.col("period_type") == period_type) & F.col("dimension_value").isNotNull() & F.col("root").isNotNull() & F.col("dimension").isNotNull())
    rows = unpivoted(rows, metrics)
    w = Window.partitionBy(*SLICE, "metric_key").orderBy("period")
    rows = rows.select(F.lit(kind).alias("comparison_type"), *SLICE, "metric_key", F.lag("period").over(w).alias("prior_period"), F.col("period").alias("current_period"), F.lag("value").over(w).alias("prior_value"), F.col("value").alias("current_value"), F.lead("period").over(w).alias("_next"))
    rows = rows.where(F.col("prior_period").isNotNull() & (F.col("_next").isNull() if latest_only else F.lit(True))).drop("_next")
    metric, prior, current = F.col("metric_key"), F.col("prior_value"), F.col("current_value")
    return rows.withColumns({"change_pct": change_pct(metric, prior, current), "change_pp": change_pp(metric, prior, current)})


def yoy(table: DataFrame, metrics: Iterable[str]) -> DataFrame:
    """The last two years of each slice."""
    return links(table, metrics, "annual", "yoy", latest_only=True)


def ytd(table: DataFrame, metrics: Iterable[str]) -> DataFrame:
    """Every pair of neighbouring years to date."""
    return links(table, metrics, "ytd", "ytd")


def rebuilt(saved: DataFrame, metrics: Sequence[str], kind: str) -> DataFrame:
    """The comparison of a like-for-like kind from saved rows, which may be those of many runs. A row says of which link
    it is (``link_prior_year``, ``link_current_year``) and of which ``year``; each link has values of its own universe,
    so a year may be there once per link. A link without either side is left out; ``number`` (of the half or quarter) is
    kept where rows have it."""
    own = [c for c in ("number",) if c in saved.columns]
    rows = saved.where((F.col("comparison_type") == kind) & F.col("dimension_value").isNotNull())
    keys = ["comparison_type", *own, *SLICE, "metric_key"]
    rows = rows.select("comparison_type", *own, *SLICE, "period", "year", "link_prior_year", "link_current_year", F.explode(F.array(*[F.struct(F.lit(m).alias("metric_key"), F.col(m).cast("double").alias("value")) for m in metrics])).alias("m")).select("*", "m.*").drop("m")
    side = lambda year: F.max(F.when(F.col("year") == F.col(year), F.struct("period", "value")))
    both = rows.groupBy(*keys, "link_prior_year", "link_current_year").agg(side("link_prior_year").alias("p"), side("link_current_year").alias("c")).where("p is not null and c is not null")
    out = both.select(*keys, F.col("p.period").alias("prior_period"), F.col("c.period").alias("current_period"), F.col("p.value").alias("prior_value"), F.col("c.value").alias("current_value"))
    metric, prior, current = F.col("metric_key"), F.col("prior_value"), F.col("current_value")
    return out.withColumns({"change_pct": change_pct(metric, prior, current), "change_pp": change_pp(metric, prior, current)})


def scope_diff(one: DataFrame, other: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Annual values of two scopes side by side, for the years that both have."""
    def rows(table: DataFrame, name: str) -> DataFrame:
        whole = table.where("period_type = 'annual' and root = 'overall' and dimension = 'overall'")
        return unpivoted(whole, metrics).select(F.col("period").alias("year"), F.col("metric_key").alias("metric"), F.col("value").alias(name))

    both = rows(one, "scope").join(rows(other, "score"), ["year", "metric"])
    return both.withColumns({"abs_diff": F.col("score") - F.col("scope"), "pct_diff": F.try_divide(F.col("score") - F.col("scope"), F.abs("scope")) * 100})


def present(rows: DataFrame, unblocked: bool = True) -> DataFrame:
    """Rows that show that a pair was there: of sales, of stock in a warehouse, and of unblocked days if asked; what the
    rows do not tell is taken for given."""
    rules = {"has_sales_row": "has_sales_row", "has_inventory_row": "has_inventory_row"} | ({"is_blocked": "not is_blocked", "dc_unblocked_days": "dc_unblocked_days > 0"} if unblocked else {})
    return reduce(lambda d, rule: d.where(rule[1]) if rule[0] in rows.columns else d, rules.items(), rows)


def qualifying_years(rows: DataFrame, weeks: DataFrame, start: str, end: str, kind: str = "annual", number: int | None = None, unblocked: bool = True) -> list[int]:
    """Years in which pairs were present, for halves and quarters in the part of that number; all kinds but year-to-date
    need the year, or its part, whole in the window by the unclipped calendar. At most as many as the calendar has."""
    shown = present(rows, unblocked)
    if number is not None:
        shown = shown.join(F.broadcast(weeks.where(F.col(kind) == number).select("year", "week")), ["year", "week"], "left_semi")
    years = shown.select("year").distinct()
    if kind != "ytd":
        whole = complete_periods(weeks, start, end).where((F.col("period_type") == kind) & F.col("is_complete") & (F.col("number") == (number or 0)))
        years = years.join(F.broadcast(whole.select("year")), "year", "left_semi")
    return sorted(r["year"] for r in years.collect())


def universe(rows: DataFrame, years: Sequence[int], key: Sequence[str] = ("product_id", "store_id"), unblocked: bool = True) -> DataFrame:
    """Keys that are present (``present``) in every one of the years."""
    chosen = present(rows, unblocked).where(F.col("year").isin(list(years)))
    return chosen.groupBy(*key).agg(F.count_distinct("year").alias("n")).where(F.col("n") == len(set(years))).select(*key)


def restricted(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of these pairs; of their products if the rows know no store."""
    key = [c for c in pairs.columns if c in rows.columns]
    return rows.join(pairs.select(*key).distinct(), key, "left_semi")


#: Kinds of like-for-like comparisons and the periods that they compare.
KINDS = {"yoy": "annual", "ytd": "ytd", "quarter": "quarter", "half": "half"}


def like_for_like(facts: Facts, slices: Slices, weeks: DataFrame, start: str, end: str, kind: str, rules: Rules, unblocked: bool = True) -> DataFrame:
    """The metrics of what was there in every qualifying year, each year's rows once for each link of neighbouring years that
    it is a side of: ``comparison_type``, ``number`` (of the quarter or half, else 0), ``link_prior_year``,
    ``link_current_year``, ``comparable_pair_count``, the slice, ``period``, ``year`` and the metrics, as ``rebuilt`` takes them.

    Every number of a kind has years and universes of its own, all in one plan: years whose period lies whole in the window
    (years to date: those that have one) and has daily rows; pairs that are present in each of them; and for the warehouse
    frames pairs of theirs. Frames without stores keep the products of the pairs. A number with one year has no link."""
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind}")
    number = F.col(kind) if kind in ("quarter", "half") else F.lit(0)
    bridge = period_bridge(weeks, start, end, (KINDS[kind],), whole_only=True).join(weeks.select("year", "week", number.alias("number")), ["year", "week"])
    placed = F.broadcast(bridge.select("year", "week", "number"))  # as many rows as the calendar has weeks
    frames = {name: df.join(placed, ["year", "week"]) for name in ("daily", "instock", "dc_daily", "dc_instock", "lost") if (df := getattr(facts, name)) is not None}

    def every_year(rows: DataFrame, key: Sequence[str]) -> DataFrame:
        """Keys, by number, of all the number's years."""
        shown = present(rows, unblocked).select("number", *key, "year").distinct().join(years, ["number", "year"], "left_semi")
        return shown.groupBy("number", *key).agg(F.count("*").alias("n")).join(counts, ["number", "n"], "left_semi").select("number", *key)

    years = F.broadcast(present(frames["daily"], unblocked).select("number", "year").distinct())
    counts = F.broadcast(years.groupBy("number").agg(F.count("*").alias("n")))
    pairs = every_year(frames["daily"], ["product_id", "store_id"])
    of_warehouse = {name: every_year(frames[name], ["product_id", "warehouse_id"]) for name in ("dc_daily", "dc_instock") if name in frames}
    kept = {}
    for name, rows in frames.items():
        keys = of_warehouse.get(name, pairs)
        key = [c for c in keys.columns if c in rows.columns]
        kept[name] = rows.join(keys.select(*key).distinct(), key, "left_semi").join(years, ["number", "year"], "left_semi").drop("number")
    table = kpi_table(replace(facts, **kept), slices, bridge.drop("number"), rules)

    order = Window.partitionBy("number").orderBy("year")
    ends = years.withColumns({"prior": F.lag("year").over(order), "current": F.col("year")}).where("prior is not null")
    sides = ends.select("number", F.col("prior").alias("link_prior_year"), F.col("current").alias("link_current_year"), F.explode(F.array("prior", "current")).alias("year"))
    tagged = table.join(F.broadcast(bridge.select("period", "year", "number").distinct()), "period").join(F.broadcast(sides), ["number", "year"])
    size = F.broadcast(pairs.groupBy("number").agg(F.count("*").alias("comparable_pair_count")))
    return tagged.join(size, "number").select(F.lit(kind).alias("comparison_type"), "number", "link_prior_year", "link_current_year", "comparable_pair_count", *SLICE, "period", "year", *rules.metrics)

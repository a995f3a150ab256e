"""The facts that metrics are made of: daily rows, in-stock days, lost sales, warehouse days."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.conditions import filtered, valued
from .assortment import flag_blocked
from .calendar import last_saturday, within

KEY = ["product_id", "store_id", "date"]


def gross_basis(daily: DataFrame, sales: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """Daily rows whose sales are those of the transactions: a day without a daily row gets one, without stock and
    marked ``gross_only``; a daily row without a transaction has sold nothing."""
    chosen = sales.where(F.col("sales_type").isin(list(types))) if types else sales
    gross = chosen.groupBy(*KEY).agg(F.sum("sales_revenue").alias("gross_revenue"), F.sum("sales_quantity").alias("gross_quantity"))
    days = daily.groupBy(*KEY).agg(F.sum("inventory").alias("inventory")).withColumn("is_daily", F.lit(True))
    both = days.join(gross, KEY, "full_outer")
    return both.select(*KEY, F.coalesce("gross_revenue", F.lit(0.0)).alias("sales_revenue"), F.coalesce("gross_quantity", F.lit(0.0)).alias("sales_quantity"), F.coalesce("inventory", F.lit(0.0)).alias("inventory"), F.col("is_daily").isNull().alias("gross_only"))


def with_transit(daily: DataFrame, transit: DataFrame, key: Sequence[str], row_flag: str, removed: DataFrame | None = None) -> DataFrame:
    """Rows of stock, one for each key, joined with goods in transit on the same day; a day with transit only has a row
    without stock, whose ``row_flag`` is false. Several rows of a key are summed first, so that its transit counts once; a
    flag of theirs holds if it holds for all. Days whose daily row an input filter took out (``removed``: the keys) have no transit
    unless another daily row of theirs is left."""
    moving = transit.where("quantity > 0").groupBy(*key).agg(F.sum("quantity").alias("git_quantity"))
    measures = [c for c in daily.columns if c not in key]
    if removed is not None:
        kept = daily.where("not gross_only") if "gross_only" in daily.columns else daily
        moving = moving.join(removed.select(*key).join(kept.select(*key), list(key), "left_anti"), list(key), "left_anti")
    types = dict(daily.dtypes)
    summed = daily.groupBy(*key).agg(*[(F.bool_and(c) if types[c] == "boolean" else F.sum(c)).alias(c) for c in measures], F.lit(True).alias(row_flag))
    both = summed.join(moving, list(key), "full_outer")
    fill = [F.coalesce(c, F.lit(False if types[c] == "boolean" else 0.0)).alias(c) for c in measures]
    return both.select(*key, *fill, F.coalesce("git_quantity", F.lit(0.0)).alias("git_quantity"), F.coalesce(row_flag, F.lit(False)).alias(row_flag))


def _moving(transit: DataFrame, kind: int, location: str, shift: int) -> DataFrame:
    day = F.date_add("date", shift) if shift else F.col("date")
    return transit.where(F.col("destination_type") == kind).select("product_id", F.col("destination_id").alias(location), day.alias("date"), "quantity")


def store_transit(transit: DataFrame, shift: int = 0) -> DataFrame:
    """Goods on their way to stores; a snapshot tells of the day that comes ``shift`` days after its date."""
    return _moving(transit, 0, "store_id", shift)


def warehouse_transit(transit: DataFrame, shift: int = 0) -> DataFrame:
    return _moving(transit, 1, "warehouse_id", shift)


def scoped_daily(days: DataFrame, products: DataFrame, calendar: DataFrame, weeks: DataFrame) -> DataFrame:
    """Daily rows with the product's attributes, the values of stock and cost rounded per row, and the fiscal week.

    Rows of unknown products or dates drop out. ``calendar`` may have parts of weeks (``calendar.day_parts``). Flags that the rows lack are those of net sales without blocks."""
    for name, default in (("gross_only", False), ("is_blocked", False), ("has_daily_row", True)):
        if name not in days.columns:
            days = days.withColumn(name, F.lit(default))
    if "git_quantity" not in days.columns:
        days = days.withColumn("git_quantity", F.lit(0.0))
    days = days.withColumn("has_sales_row", F.col("has_daily_row") | F.col("gross_only"))
    days = days.withColumn("has_daily_row", F.col("has_daily_row") & ~F.col("gross_only")).withColumn("has_stock_row", ~(F.col("gross_only") & (F.col("git_quantity") == 0)))
    if "part" in calendar.columns:
        at = calendar.select("date", "year", "week", "part", "week_days")
    else:
        at = calendar.select("date", "year", "week").join(weeks.select("year", "week", "week_start_date", "week_days"), ["year", "week"])
    dated = days.join(F.broadcast(at), "date").join(products, "product_id")
    price, cost = F.col("price_without_tax"), F.col("cogs")
    both = F.col("inventory") + F.col("git_quantity")
    return dated.withColumns({
        "sales_cost": valued(F.col("sales_quantity"), cost), "inventory_retail": valued(F.col("inventory"), price), "inventory_cost": valued(F.col("inventory"), cost),
        "inventory_git": both, "inventory_retail_git": valued(both, price), "inventory_cost_git": valued(both, cost),
    })


def collapsed(scoped: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Measures summed over stores; what else a row says, named in ``keys``, is kept apart."""
    measures = ["sales_revenue", "sales_quantity", "sales_cost", "inventory", "inventory_retail", "inventory_cost", "inventory_git", "inventory_retail_git", "inventory_cost_git"]
    return scoped.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def _week_spans(dates: DataFrame) -> DataFrame:
    """The weeks (or parts) that rows of ``date`` fall in: a number by their last day, first and last day, and all days."""
    grain = [c for c in ("year", "week", "part") if c in dates.columns]
    spans = dates.groupBy(*grain).agg(F.min("date").alias("week_from"), F.max("date").alias("week_to"), F.collect_list("date").alias("dates"), F.count("*").alias("days"))
    return spans.withColumn("n", F.row_number().over(Window.orderBy("week_to", *grain)))  # as many rows as the calendar has weeks


def _week_lookups(spans: DataFrame, start: str, end: str) -> DataFrame:
    """One row, or one for whole weeks and one for parts: all ``weeks`` in order (grain and days), and ``at`` for each day of the
    window the number of the first week that ends on or after it, how many of that week's days are left (``rest``) and
    whether the day itself is one of them (``counts``). Both are as long as the calendar."""
    grain = [c for c in ("year", "week", "part") if c in spans.columns]
    chain = [c for c in grain if c == "part"]  # a day may lie in a whole week and in its part
    ordered = spans.groupBy(*chain).agg(F.sort_array(F.collect_list(F.struct("week_to", *grain, "days", "dates"))).alias("spans")).where(F.size("spans") > 0)

    def place(day: Column) -> Column:
        k = F.least(F.size(F.filter("spans", lambda s: s["week_to"] < day)) + 1, F.size("spans"))
        dates = F.col("spans")[k - 1]["dates"]
        return F.struct(k.alias("k"), F.size(F.filter(dates, lambda d: d >= day)).alias("rest"), F.array_contains(dates, day).cast("int").alias("counts"))

    every = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    weeks = F.transform("spans", lambda s: F.struct(*[s[c].alias(c) for c in (*grain, "days")]))
    return ordered.select(*chain, weeks.alias("weeks"), F.transform(every, place).alias("at"))


def _week_counts(lines: DataFrame, spans: DataFrame, key: Sequence[str], start: str, end: str, only: DataFrame | None = None) -> DataFrame:
    """Every week of a key from the day that it opens on: its ``days`` from then on, and how many of them its lines count as
    ``stocked`` and as ``closed``. ``lines``: key, opens_on (from ``start`` to ``end``) and spans of days (first_day, last_day,
    stocked, closed); only lines of one day are stocked, and one without counts tells that the key opens. ``only`` names the
    weeks that are wanted, of a product or of a key.

    What lines say of a week is summed first. The weeks in between, most of all, are made last, of each week that lines are about
    up to the next one, with a product's keys in one partition: they are not shuffled here or by sums over a product's places,
    and nothing is looked up for them but the week's name and days."""
    grain = [c for c in ("year", "week", "part") if c in spans.columns]
    chain, lookups = [c for c in grain if c == "part"], _week_lookups(spans, start, end)
    at = lambda day: F.col("at")[F.datediff(day, F.lit(start).cast("date"))]
    inside = lines.withColumns({"first_day": F.greatest("first_day", "opens_on"), "last_day": F.least("last_day", F.lit(end).cast("date"))}).where("first_day <= last_day")
    placed = inside.crossJoin(F.broadcast(lookups.select(*chain, "at"))).select(*key, *chain, "stocked", "closed", at("first_day").alias("a"), at("last_day").alias("b"))
    met = placed.select(*key, *chain, "stocked", "closed", F.col("a.k").alias("first_k"), F.col("a.rest").alias("rest"), F.col("b.k").alias("last_k"), (F.col("b.rest") - F.col("b.counts")).alias("left"), F.explode(F.sequence("a.k", "b.k")).alias("k"))
    part = F.when(F.col("k") == F.col("first_k"), F.col("rest")).otherwise(0) - F.when(F.col("k") == F.col("last_k"), F.col("left")).otherwise(0)
    full, zero = (F.col("k") > F.col("first_k")).cast("int"), F.lit(0).cast("long")
    sums = met.groupBy(*key, *chain, "k").agg(
        F.sum(F.when(F.col("closed").isNull(), F.col("rest"))).alias("rest"), F.coalesce(F.sum(F.col("stocked") * part), zero).alias("stocked"),
        F.coalesce(F.sum(F.col("closed") * part), zero).alias("part_closed"), F.coalesce(F.sum(F.col("closed") * full), zero).alias("weeks_closed"),
    )
    told = ["rest", "stocked", "part_closed", "weeks_closed"]
    if only is None:
        after, size = Window.partitionBy("product_id", *chain).orderBy(*[c for c in key if c != "product_id"], "k"), F.size("weeks")
        same = reduce(lambda x, y: x & y, [F.lead(c).over(after).eqNullSafe(F.col(c)) for c in key if c != "product_id"])
        held = sums.withColumn("next_k", F.when(same, F.lead("k").over(after)))
        all_weeks = F.broadcast(lookups.select(*chain, "weeks"))
        spread = (held.join(all_weeks, chain) if chain else held.crossJoin(all_weeks)).withColumn("last_k", F.coalesce(F.col("next_k") - 1, size))
        grid = spread.select(*key, *told, "k", "weeks", F.explode(F.sequence("k", "last_k")).alias("n"))
        week, said = F.col("weeks")[F.col("n") - 1], lambda c, other: F.when(F.col("n") == F.col("k"), F.col(c)).otherwise(other)
    else:
        held = sums.groupBy(*key, *chain).agg(F.min("k").alias("first_k"), F.map_from_entries(F.collect_list(F.struct("k", F.struct(*told)))).alias("changes"))
        named = lookups.select(F.posexplode("weeks").alias("n", "w")).select((F.col("n") + 1).alias("n"), F.col("w"), *[F.col("w")[c].alias(c) for c in grain])
        of = [c for c in key if c in only.columns]
        wanted = only.select(*of, *[c for c in grain if c in only.columns]).distinct()
        wanted = wanted.join(F.broadcast(named), [c for c in grain if c in wanted.columns]).select(*of, *chain, "n", "w")
        grid = held.join(wanted, [*of, *chain]).where("n >= first_k").drop(*chain)
        week, said = F.col("w"), lambda c, other: F.coalesce(F.col("changes")[F.col("n")][c], other)
    days = week["days"]
    closed = said("weeks_closed", zero) * days + said("part_closed", zero)
    return grid.select(*key, *[week[c].alias(c) for c in grain], F.coalesce(said("rest", F.lit(None).cast("long")), days).alias("days"), said("stocked", zero).alias("stocked"), closed.alias("closed"))


def _product_weeks(lines: DataFrame, spans: DataFrame, start: str, end: str) -> DataFrame:
    """The sums over a product's keys of what ``_week_counts`` has by key, for keys that open from ``start`` to ``end``. A key is
    counted in the week that it opens in and holds in all later ones, so there is no row for each key and week."""
    grain = [c for c in ("year", "week", "part") if c in spans.columns]
    chain = [c for c in grain if c == "part"]  # a day may lie in a whole week and in its part, so parts are counted by themselves
    every = spans.sparkSession.sql(f"select explode(sequence(date '{start}', date '{end}')) as day")
    rest = F.size(F.filter("dates", lambda d: d >= F.col("day"))).cast("long")
    days = every.join(F.broadcast(spans), F.col("week_to") >= F.col("day")).groupBy("day", *chain).agg(F.min(F.struct("n", rest.alias("rest"), F.array_contains("dates", F.col("day")).alias("counts"))).alias("at")).select("day", "at.*")
    lines = lines.withColumn("from", F.greatest("first_day", "opens_on")).where(F.col("from") <= F.col("last_day"))
    placed = lines.select("product_id", "stocked", "closed", F.explode(F.sequence("from", "last_day")).alias("day")).join(F.broadcast(days), "day")  # as many days as the calendar has
    opens, zero = F.col("closed").isNull(), F.lit(0).cast("long")
    values = {"opened": F.when(opens, 1), "rest": F.when(opens, F.col("rest"))} | {c: F.col(c) for c in ("stocked", "closed")}
    known = placed.where(opens | F.col("counts")).groupBy("product_id", "n").agg(*[F.coalesce(F.sum(v), zero).alias(c) for c, v in values.items()])
    held = known.groupBy("product_id").agg(F.min("n").alias("first_n"), F.map_from_entries(F.collect_list(F.struct("n", F.struct(*values)))).alias("changes"))
    grid = held.join(F.broadcast(spans.drop("dates")), F.col("n") >= F.col("first_n")).withColumn("change", F.col("changes")[F.col("n")])
    of = lambda c: F.coalesce(F.col("change")[c], zero)
    before = F.coalesce(F.sum(of("opened")).over(Window.partitionBy("product_id", *chain).orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), zero)
    return grid.select("product_id", *grain, (of("rest") + before * F.col("days")).alias("days"), of("stocked").alias("stocked"), of("closed").alias("closed"))


def _line(first: str, last: str, stocked: Column, closed: Column) -> Column:
    return F.struct(F.col(first).alias("first_day"), F.col(last).alias("last_day"), stocked.cast("int").alias("stocked"), closed.cast("int").alias("closed"))


def _opened_lines(opened: DataFrame, key: Sequence[str]) -> DataFrame:
    """Lines that keys hold as an array, and the line that tells of the day that a key opens on."""
    opening = _line("opens_on", "opens_on", F.lit(None), F.lit(None))
    return opened.select(*key, "opens_on", F.inline(F.concat(F.coalesce("lines", F.array()), F.array(opening))))


def _closed_lines(intervals: DataFrame, key: Sequence[str]) -> DataFrame:
    """The blocked intervals of each key as lines."""
    named = intervals.withColumnRenamed("location_id", key[1])
    return named.groupBy(*key).agg(F.collect_list(_line("first_day", "last_day", F.lit(0), F.lit(1))).alias("closures"))


def _swept(pairs: DataFrame, events: DataFrame, closures: DataFrame | None, pair: Sequence[str]) -> DataFrame:
    """Rows of pairs (``is_pair``), of their days and of their closures (``closes_on``, ``until``), each pair's in one order: with the pair's
    scope start, its first daily row that is not closed (``first_row``), whether a day is closed, and the day up to which earlier
    closures of the pair reach (``closed_before``). Closures that depend on the scope say so (``in_scope``). No input is joined to another by pair."""
    known = F.col(pair[0]).isNotNull() & F.col(pair[1]).isNotNull()
    inputs = [
        pairs.select(*pair, F.lit(None).cast("date").alias("day"), "scope_start", F.lit(True).alias("is_pair")),
        events.where(known).select(*pair, F.col("date").alias("day"), "stocked", "unusable", "is_row"),
    ]
    if closures is not None:
        inputs.insert(0, closures.where(known).select(*pair, F.col("closes_on").alias("day"), "until", "in_scope"))
    rows = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), inputs)
    by = Window.partitionBy(*pair).orderBy("day")  # the pair's own row has no day and comes first
    rows = rows.withColumns({"scope_start": F.min("scope_start").over(by), "of_pair": F.max("is_pair").over(by)}).where("of_pair")
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if closures is None:
        rows = rows.withColumns({"until": F.lit(None).cast("date"), "closed_before": F.lit(None).cast("date"), "is_closed": F.lit(False)})
    else:
        rows = rows.withColumn("until", F.when(~F.col("in_scope") | (F.col("day") >= F.col("scope_start")), F.col("until")))
        reached = {"closed_before": F.max("until").over(by.rowsBetween(Window.unboundedPreceding, -1)), "closed_to": F.max("until").over(by)}
        rows = rows.withColumns(reached).withColumn("is_closed", F.coalesce(F.col("closed_to") >= F.col("day"), F.lit(False)))
    return rows.withColumn("first_row", F.min(F.when(F.col("is_row") & ~F.col("is_closed"), F.col("day"))).over(whole))


def instock_daily(pairs: DataFrame, daily: DataFrame, weeks: DataFrame, start: str, end: str, count_start: str = "first", intervals: DataFrame | None = None, transit: DataFrame | None = None, sales_count: bool = True, usable_only: bool = False, require_daily_data: bool = True, only: DataFrame | None = None, by_store: bool = True, blocks: DataFrame | None = None) -> DataFrame:
    """In-stock and available days per pair and week, or without ``by_store`` their sums per product and week.

    Days count from the pair's first daily row (``first``), its scope start where it has one (``scope``) or the earlier
    of both (``earliest``), to the end of the window. Blocked days, and unusable ones if asked, leave both counts. A day
    is in stock with stock, with sales (``sales_count``) or with transit; a day without a row is out of stock. ``pairs``: one row each of
    product_id, store_id, scope_start. ``only`` (product_id, store_id, year, week) names the weeks that are wanted. Blocked days are
    those of ``intervals`` (``assortment.block_intervals``), or of ``blocks`` of product_id and location_id as they are, of which
    those count that start on or after the pair's scope start, without the intervals being made first.

    Days of blocks are dropped before the pair's first row is taken. A pair's days and blocks are gone through in one order
    (``_swept``), and its weeks are made of the lines that this gives (``_week_counts``). ``weeks`` may have parts of weeks (``calendar.parted``).
    """
    if not by_store and only is not None:
        raise ValueError("weeks that are wanted are named for pairs")
    pair, grain = ["product_id", "store_id"], [c for c in ("year", "week", "part") if c in weeks.columns]
    window_start, window_end = F.lit(start).cast("date"), F.lit(end).cast("date")
    dates = within(weeks, start, end).select(*grain, F.explode(F.sequence(F.greatest("week_start_date", window_start), F.least("week_end_date", window_end))).alias("date"))
    has_stock = F.coalesce(F.col("inventory") > 0, F.lit(False)) | (F.coalesce(F.col("sales_quantity") > 0, F.lit(False)) if sales_count else F.lit(False))
    unusable = F.coalesce(F.col("usable") != 1, F.lit(True)) if usable_only else F.lit(False)
    by_day = lambda rows: rows.groupBy(*pair, "date").agg(*[F.max(c).alias(c) for c in ("stocked", "unusable", "is_row")])
    events = by_day(daily.select(*pair, "date", has_stock.alias("stocked"), unusable.alias("unusable"), F.lit(True).alias("is_row")))
    if transit is not None:
        moving = by_day(transit.where("quantity > 0").select(*pair, "date", F.lit(True).alias("stocked"), F.lit(False).alias("unusable"), F.lit(False).alias("is_row")))
        events = by_day(moving.unionByName(events))
    closures = None
    for rows, names, in_scope in ((intervals, ("first_day", "last_day"), False), (blocks, ("start_date", "end_date"), True)):
        if rows is not None:
            found = rows.select("product_id", F.col("location_id").alias("store_id"), F.col(names[0]).alias("closes_on"), F.least(F.coalesce(names[1], window_end), window_end).alias("until"), F.lit(in_scope).alias("in_scope"))
            found = found.where((F.col("until") >= F.greatest("closes_on", window_start)) & F.col("closes_on").isNotNull())
            closures = found if closures is None else closures.unionByName(found)
    swept = _swept(pairs, events, closures, pair)
    if require_daily_data:
        swept = swept.where("first_row is not null")
    rule = {"first": F.col("first_row"), "scope": F.coalesce("scope_start", "first_row"), "earliest": F.least("scope_start", "first_row")}[count_start]
    is_pair, counted = F.coalesce("is_pair", F.lit(False)), F.coalesce(F.col("stocked") | F.col("unusable"), F.lit(False)) & ~F.col("is_closed")
    begins = F.when(is_pair, F.col("opens_on")).when(F.col("until").isNotNull(), F.greatest("day", F.date_add("closed_before", 1))).when(counted, F.col("day"))
    lines = swept.withColumn("opens_on", F.greatest(rule, window_start)).where(F.col("opens_on") <= window_end).select(
        *pair, "opens_on", begins.alias("first_day"), F.coalesce("until", begins).alias("last_day"),
        F.when(~is_pair, F.coalesce(F.col("stocked") & ~F.col("unusable"), F.lit(False)).cast("int")).alias("stocked"), F.when(~is_pair, (F.col("until").isNotNull() | F.col("unusable")).cast("int")).alias("closed"),
    ).where("first_day is not null")
    rows = _week_counts(lines, _week_spans(dates), pair, start, end, only) if by_store else _product_weeks(lines, _week_spans(dates), start, end)
    return rows.select(*(pair if by_store else pair[:1]), *grain, F.col("stocked").alias("stocked_pairs"), (F.col("days") - F.col("closed")).alias("available_days")).where("available_days > 0")


def instock_pairs(pairs: DataFrame, main_only: bool = False, excluded: DataFrame | None = None) -> DataFrame:
    """The pairs whose in-stock days count: with ``main_only`` those where the product itself is in scope and not only a
    member of its family (``main_eligible``), and without products of ``excluded`` (``assortment.unsuperseded_sizes``)."""
    kept = pairs.where("main_eligible") if main_only else pairs
    return kept if excluded is None else kept.join(excluded.select("product_id"), "product_id", "left_anti")


def up_to_date(daily: DataFrame, pairs: DataFrame, end: str) -> DataFrame:
    """``pairs``, as long as their daily rows reach the end of the report; else the job that reads them fails, as days after
    the last row would count as out of stock. The check is part of the plan: one row that says the last day."""
    last = daily.join(pairs.select("product_id", "store_id"), ["product_id", "store_id"], "left_semi").agg(F.max("date").alias("last"))
    message = F.concat(F.lit("daily rows end on "), F.coalesce(F.col("last").cast("string"), F.lit("no day")), F.lit(f", before the report does on {end}"))
    reaches = F.when(F.col("last") >= F.lit(end).cast("date"), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return pairs.join(F.broadcast(last.where(reaches).select(F.lit(True).alias("_up_to_date")))).drop("_up_to_date")


def first_of(sources: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The first source's rows, and of each further one those whose keys none before it has."""
    found = sources[0]
    for more in sources[1:]:
        found = found.unionByName(more.join(found.select(*keys).distinct(), list(keys), "left_anti"))
    return found


def instock_weekly(sources: Sequence[DataFrame], calendar: DataFrame, start: str, end: str, full: DataFrame | None = None) -> DataFrame:
    """In-stock days of weekly sources, which fill each other's missing key-weeks; weeks that are blocked on every day
    (``full``: product_id, location_id, year, week) drop out, as do those without available days."""
    at = F.broadcast(calendar.select(F.col("date").alias("week_start_date"), "year", "week"))
    keys = ["product_id", "store_id", "week_start_date"]
    window = F.col("week_start_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    summed = [s.where(window).groupBy(*keys).agg(F.sum("in_stock").alias("stocked_pairs"), F.sum("total_days").alias("available_days")) for s in sources]
    rows = first_of(summed, keys).join(at, "week_start_date").where("available_days > 0")
    if full is not None:
        rows = rows.join(full.withColumnRenamed("location_id", "store_id"), ["product_id", "store_id", "year", "week"], "left_anti")
    return rows.select("product_id", "store_id", "year", "week", "stocked_pairs", "available_days")


def instock_of_lost(lost: DataFrame, calendar: DataFrame, weeks: DataFrame, start: str, end: str, full: DataFrame | None = None) -> DataFrame:
    """In-stock days of the lost-sales rows themselves; where they do not say of how many days, those of the week count.
    Without a ``store_id`` the rows are of products, and so must be ``full``."""
    place = [c for c in ("store_id",) if c in lost.columns]
    at = calendar.groupBy("year", "week").agg(F.min("date").alias("week_start_date")).join(weeks.select("year", "week", "week_days"), ["year", "week"])
    window = F.col("week_start_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    summed = lost.where(window).groupBy("product_id", *place, "week_start_date").agg(F.sum("in_stock").alias("stocked_pairs"), F.sum("total_days").alias("total_days"))
    rows = summed.join(F.broadcast(at), "week_start_date").withColumn("available_days", F.coalesce("total_days", F.col("week_days").cast("double"))).where("available_days > 0")
    if full is not None:
        keys = ["product_id", *place, "year", "week"]
        rows = rows.join(full.withColumnRenamed("location_id", "store_id").select(*keys), keys, "left_anti")
    return rows.select("product_id", *place, "year", "week", "stocked_pairs", "available_days")


def ensemble(fast: DataFrame, slow: DataFrame, clusters: DataFrame, fast_clusters: Sequence[str]) -> DataFrame:
    """Of two lost-sales models, all fields of the fast one for products of fast clusters and of the slow one for all
    others, also those without a cluster. A key that the chosen model lacks drops out."""
    keys = ["product_id", "store_id", "week_start_date"]
    fields = ["lost_sales", "in_stock", "total_days"]
    named = lambda d, p: d.select(*keys, *[F.col(f).alias(f"{p}_{f}") for f in fields])
    one = clusters.groupBy("product_id").agg(F.min("attribute_value").alias("cluster"))
    both = named(fast, "fast").join(named(slow, "slow"), keys, "full_outer").join(one, "product_id", "left")
    is_fast = F.coalesce(F.col("cluster").isin(list(fast_clusters)), F.lit(False))
    return both.select(*keys, *[F.when(is_fast, F.col(f"fast_{f}")).otherwise(F.col(f"slow_{f}")).alias(f) for f in fields]).where("total_days is not null")


def lost_base(lost: DataFrame, daily: DataFrame, calendar: DataFrame, start: str, end: str, by_store: bool = True, sales_filter: Mapping | None = None, latest_day: bool = False) -> DataFrame:
    """Lost sales per product (and store) and week with the week's sales, and the floor of both: what could have been
    sold. Weeks that do not start on a fiscal week drop out. Without stores, sales are summed over them. ``sales_filter``
    (value filters by column) narrows the sales only, for lost sales of fewer places than the daily rows have. A report
    that ends on any day (``latest_day``) takes weeks up to its last Saturday. Daily rows that say so count on sales days
    only."""
    if latest_day:
        lost = lost.where(F.date_add("week_start_date", 6) <= F.lit(last_saturday(dt.date.fromisoformat(end))))
    if "has_sales_row" in daily.columns:
        daily = daily.where("has_sales_row")
    daily = filtered(daily, sales_filter or {})
    keys = ["product_id", *(["store_id"] if by_store else []), "year", "week"]
    at = calendar.select("date", "year", "week")
    starts = F.broadcast(at.groupBy("year", "week").agg(F.min("date").alias("week_start_date")))
    window = F.col("week_start_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    rows = lost.where(window).join(starts, "week_start_date").groupBy(*keys).agg(F.sum(F.col("lost_sales").cast("double")).alias("lost_sales"))
    sales = daily.join(F.broadcast(at), "date").groupBy(*keys).agg(F.sum("sales_quantity").alias("sales_quantity"))
    both = rows.join(sales, keys, "left").withColumn("sales_quantity", F.coalesce("sales_quantity", F.lit(0.0)))
    return both.withColumn("could_sell", F.floor(F.col("sales_quantity") + F.col("lost_sales")).cast("double"))


def _dates(calendar: DataFrame) -> DataFrame:
    return calendar.select("date", *[c for c in ("year", "week", "part") if c in calendar.columns])


def dc_daily(stock: DataFrame, calendar: DataFrame, start: str, end: str, pairs: DataFrame | None = None, product_weeks: DataFrame | None = None, intervals: DataFrame | None = None, transit: DataFrame | None = None) -> DataFrame:
    """Warehouse days of the window with transit and whether they are blocked. ``product_weeks``: the products and weeks of
    the stores' scope, which leads; ``pairs``: product_id and location_id of the warehouses' own scope."""
    keys = ["product_id", "warehouse_id"]
    window = F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    if transit is not None:
        days = with_transit(stock.where(window), transit.where(window), [*keys, "date"], "has_inventory_row")
    else:
        days = stock.where(window).withColumns({"git_quantity": F.lit(0.0), "has_inventory_row": F.lit(True)})
    days = _scoped_warehouse(days.join(F.broadcast(_dates(calendar)), "date"), pairs, product_weeks)
    return _blocked_warehouse(days, intervals)


def _scoped_warehouse(days: DataFrame, pairs: DataFrame | None, product_weeks: DataFrame | None) -> DataFrame:
    if product_weeks is not None:
        days = days.join(product_weeks.select("product_id", "year", "week").distinct(), ["product_id", "year", "week"], "left_semi")
    if pairs is not None:
        days = days.join(pairs.select("product_id", F.col("location_id").alias("warehouse_id")).distinct(), ["product_id", "warehouse_id"], "left_semi")
    return days


def _blocked_warehouse(days: DataFrame, intervals: DataFrame | None) -> DataFrame:
    if intervals is None:
        return days.withColumn("is_blocked", F.lit(False))
    return flag_blocked(days, intervals, "warehouse_id")


def dc_instock(stock: DataFrame, calendar: DataFrame, start: str, end: str, transit: DataFrame | None = None, threshold: float = 0.0, pairs: DataFrame | None = None, product_weeks: DataFrame | None = None, intervals: DataFrame | None = None, drop_blocked: bool = True, by_warehouse: bool = True) -> DataFrame:
    """Warehouse days per product, warehouse and week, or without ``by_warehouse`` their sums per product and week, on a grid from the first row to the end of the window in which a
    day without a row has no stock. Scope as in ``dc_daily``. Blocked days leave both counts if ``drop_blocked``;
    ``dc_unblocked_days`` leaves them out in any case. Weeks without days drop out."""
    keys = ["product_id", "warehouse_id"]
    window = F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    days = stock.where(window).groupBy(*keys, "date").agg(F.sum("inventory").alias("inventory"), F.lit(True).alias("is_row"))
    stocked = F.coalesce("inventory", F.lit(0.0)) > threshold
    if transit is not None:
        moving = transit.where(window).where("quantity > 0").groupBy(*keys, "date").agg(F.sum("quantity").alias("moving"))
        days, stocked = days.join(moving, [*keys, "date"], "full_outer"), stocked | (F.coalesce("moving", F.lit(0.0)) > 0)
    days = _blocked_warehouse(_scoped_warehouse(days, pairs, None), intervals if drop_blocked else None)
    empty = F.lit(int(0.0 > threshold))  # whether a day without a row counts as stocked
    change = F.when(~F.col("is_blocked") & F.col("product_id").isNotNull() & F.col("warehouse_id").isNotNull(), stocked.cast("int") - empty)
    line = F.when(change != 0, _line("date", "date", change, F.lit(0)))
    opened = days.groupBy(*keys).agg(F.min(F.when(F.col("is_row"), F.col("date"))).alias("opens_on"), F.collect_list(line).alias("lines")).where("opens_on is not null")
    if intervals is not None:
        opened = opened.join(_closed_lines(intervals, keys), keys, "left").withColumn("lines", F.concat(*[F.coalesce(c, F.array()) for c in ("lines", "closures")])).drop("closures")
    only = None if product_weeks is None else product_weeks.select("product_id", "year", "week")
    if not by_warehouse and only is not None:
        raise ValueError("product weeks are joined to warehouses")
    spans = _week_spans(_dates(calendar).where(window))
    lines = _opened_lines(opened, keys)
    rows = _week_counts(lines, spans, keys, start, end, only) if by_warehouse else _product_weeks(lines, spans, start, end)
    free = F.col("days") - F.col("closed")
    available = free if drop_blocked else F.col("days")
    counts = [(F.col("stocked") + empty * available).alias("dc_stocked_days"), available.alias("dc_available_days"), F.when(free != 0, free).alias("dc_unblocked_days")]
    return rows.select(*(keys if by_warehouse else keys[:1]), *[c for c in ("year", "week", "part") if c in rows.columns], *counts).where("dc_available_days > 0")

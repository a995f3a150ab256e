"""Which products are in scope where and when, and when they are blocked."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.conditions import value_filter
from .calendar import within


def family_rollup(rows: DataFrame, family: DataFrame) -> DataFrame:
    """Products that are not the main one of their family count as its parent; one level only."""
    parents = family.where(~F.coalesce("is_main", F.lit(False))).groupBy("product_id").agg(F.min("parent_id").alias("parent_id"))
    return rows.join(parents, "product_id", "left").withColumn("product_id", F.coalesce("parent_id", "product_id")).drop("parent_id")


def scope_rows(scope: DataFrame, solutions: Sequence[int], run_date: str) -> DataFrame:
    """Rows of these solutions and of this run that had not ended by then; an error if there are none."""
    run = F.lit(run_date).cast("date")
    rows = scope.where(F.col("solution_id").isin(list(solutions)) & (F.col("run_date") == run) & (F.col("end_date").isNull() | (F.col("end_date") >= run)))
    if rows.isEmpty():
        raise ValueError(f"no scope rows of solutions {list(solutions)} run on {run_date}")
    return rows


def scope_pairs(rows: DataFrame, family: DataFrame | None = None, products: DataFrame | None = None) -> DataFrame:
    """Product and location with the earliest start, and whether any row is of the product itself and not of a member
    of its family. ``products`` keeps only active ones."""
    named = rows.withColumn("own", F.col("product_id"))
    if family is not None:
        named = family_rollup(named, family)
    pairs = named.groupBy("product_id", "location_id").agg(F.min("start_date").alias("scope_start"), F.max(F.col("own") == F.col("product_id")).alias("main_eligible"))
    if products is not None:
        pairs = pairs.join(products.where("is_active").select("product_id"), "product_id", "left_semi")
    return pairs


def weekly_scope(dated: DataFrame, calendar: DataFrame, weeks: DataFrame, start: str, end: str, backfill: bool = True) -> DataFrame:
    """Pair and week of scope rows that carry a ``date``, or their own ``year`` and ``week`` where the calendar is civil
    (such keys count in the weeks of the window only). With ``backfill``, pairs that the source has in its earliest week
    hold in the weeks of the window before it too."""
    if "date" in dated.columns:
        placed = dated.join(F.broadcast(calendar.select("date", "year", "week")), "date")
    else:
        placed = dated.join(F.broadcast(within(weeks, start, end).select("year", "week")), ["year", "week"], "left_semi")
    keys = placed.select("product_id", "location_id", "year", "week").distinct()
    if not backfill:
        return keys
    order = within(weeks, start, end).select("year", "week", "week_start_date")
    placed = keys.join(F.broadcast(order), ["year", "week"])
    first = placed.agg(F.min("week_start_date").alias("first_week"))
    early = placed.join(F.broadcast(first), F.col("week_start_date") == F.col("first_week")).select("product_id", "location_id").distinct()
    before = order.join(F.broadcast(first), F.col("week_start_date") < F.col("first_week")).select("year", "week")
    return keys.unionByName(early.join(F.broadcast(before)).select("product_id", "location_id", "year", "week"))


def daily_scope(pairs: DataFrame, weeks: DataFrame, start: str, end: str) -> DataFrame:
    """Every week of the window for every pair (or product, if ``pairs`` has no location); an error if there is none."""
    keys = [c for c in ("product_id", "location_id") if c in pairs.columns]
    inside = within(weeks, start, end).select("year", "week")
    if pairs.isEmpty() or inside.isEmpty():
        raise ValueError(f"no scope between {start} and {end}")
    every = inside.agg(F.collect_list(F.struct("year", "week")).alias("weeks"))  # one row, as long as the calendar
    return pairs.select(*keys).distinct().join(F.broadcast(every)).select(*keys, F.inline("weeks"))


def score_scope(daily: DataFrame, calendar: DataFrame, quantile: float = 0.2, few_weeks: int = 2) -> DataFrame:
    """Pair-weeks whose sales and last stock both reach the pair's own quantile, and all of pairs with few weeks."""
    days = daily.join(F.broadcast(calendar.select("date", "year", "week")), "date")
    week = days.groupBy("product_id", "store_id", "year", "week").agg(F.coalesce(F.sum("sales_quantity"), F.lit(0.0)).alias("units"), F.coalesce(F.max_by(F.coalesce("inventory", F.lit(0.0)), "date"), F.lit(0.0)).alias("stock"))
    pair = week.groupBy("product_id", "store_id").agg(F.percentile_approx("units", quantile, 10000).alias("low_units"), F.percentile_approx("stock", quantile, 10000).alias("low_stock"), F.count("*").alias("weeks"))
    return week.join(pair, ["product_id", "store_id"]).where(((F.col("units") >= F.col("low_units")) & (F.col("stock") >= F.col("low_stock"))) | (F.col("weeks") <= few_weeks)).select("product_id", "store_id", "year", "week")


def hybrid_scope(scope: DataFrame, score: DataFrame) -> DataFrame:
    """The scope table's keys, and the score's for weeks in which the scope table has none at all."""
    covered = F.broadcast(scope.select("year", "week").distinct())
    own = scope.select("product_id", "store_id", "year", "week", F.lit("scope").alias("scope_origin"))
    return own.unionByName(score.join(covered, ["year", "week"], "left_anti").withColumn("scope_origin", F.lit("score")))


def scope_summary(scope: DataFrame) -> DataFrame:
    """Keys, pairs and weeks by origin, and of all."""
    counts = [F.count("*").alias("keys"), F.count_distinct("product_id", "store_id").alias("pairs"), F.count_distinct("year", "week").alias("weeks")]
    return scope.groupBy("scope_origin").agg(*counts).unionByName(scope.agg(*counts).withColumn("scope_origin", F.lit("TOTAL")))


def block_intervals(pairs: DataFrame, blocks: DataFrame, start: str, end: str, after_scope_start: bool = True) -> DataFrame:
    """Disjoint intervals of the window in which a pair is blocked; an open end is the window's end, and blocks that
    overlap or touch are one interval. ``blocks`` has product_id and / or location_id. With ``after_scope_start`` only
    blocks count that start on or after the pair's start.

    Swept over days: a block adds one on its first day and takes one off the day after its last. Changes are summed by
    pair and day before they are ordered; an interval lies between a rise from zero and the next return to it.
    """
    pair = ["product_id", "location_id"]
    rule = F.col("start_date") >= F.col("scope_start") if after_scope_start else F.lit(True)
    found = pairs.join(blocks.drop("solution_id"), [k for k in pair if k in blocks.columns]).where(rule)
    window_start, after_window = F.lit(start).cast("date"), F.date_add(F.lit(end).cast("date"), 1)
    found = found.withColumn("on", F.greatest("start_date", window_start)).withColumn("off", F.least(F.coalesce(F.date_add("end_date", 1), after_window), after_window)).where("on < off")
    changes = found.select(*pair, F.inline(F.array(F.struct(F.col("on").alias("day"), F.lit(1).alias("change")), F.struct(F.col("off").alias("day"), F.lit(-1).alias("change")))))
    sweep = Window.partitionBy(*pair).orderBy("day")
    level = changes.groupBy(*pair, "day").agg(F.sum("change").alias("change")).where("change != 0").withColumn("level", F.sum("change").over(sweep))
    bounds = level.where("level = 0 or level = change").withColumn("next_day", F.lead("day").over(sweep))
    return bounds.where("level > 0").select(*pair, F.col("day").alias("first_day"), F.date_sub("next_day", 1).alias("last_day"))


def _runs(spans: Column) -> Column:
    """Of spans in order (start_date, all different, and last_day): the day on which the run that begins with each of them ends,
    and the latest start of an earlier span that reaches it (``after``), so that a run of the spans from some day on begins where
    that day lies behind ``after`` and not behind the start."""

    def run(span: Column, k: Column) -> Column:
        later, earlier = F.slice(spans, k + 2, F.size(spans)), F.slice(spans, F.lit(1), k)
        last = F.aggregate(later, span["last_day"], lambda day, s: F.when(s["start_date"] <= F.date_add(day, 1), F.greatest(day, s["last_day"])).otherwise(day))
        reaching = F.filter(earlier, lambda s: F.date_add(s["last_day"], 1) >= span["start_date"])
        return F.struct(span["start_date"].alias("start_date"), last.alias("last_day"), F.array_max(F.transform(reaching, lambda s: s["start_date"])).alias("after"))

    return F.when(F.size(spans) > 0, F.transform(spans, run))


def _runs_of(blocks: DataFrame, key: Sequence[str], start: str, end: str, name: str) -> DataFrame:
    """One row for each key with its blocks' ``_runs``: of blocks that start on one day the longest counts, so there are as many
    as the calendar has days at most."""
    window_start, window_end = F.lit(start).cast("date"), F.lit(end).cast("date")
    last = F.least(F.coalesce("end_date", window_end), window_end)
    inside = blocks.select(*key, "start_date", last.alias("last_day")).where((F.col("last_day") >= F.greatest("start_date", window_start)) & F.col("start_date").isNotNull())
    days = inside.groupBy(*key, "start_date").agg(F.max("last_day").alias("last_day"))
    return days.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("start_date", "last_day"))).alias("spans")).select(*key, _runs(F.col("spans")).alias(name))


def _disjoint(spans: Column) -> Column:
    """Spans in order (start_date, last_day), with those that overlap or touch made one; at least one span."""

    def next_span(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.array(F.struct(last["start_date"].alias("start_date"), F.greatest(last["last_day"], s["last_day"]).alias("last_day")))
        return F.when(s["start_date"] <= F.date_add(last["last_day"], 1), F.concat(F.slice(done, F.lit(1), F.size(done) - 1), longer)).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.slice(spans, F.lit(2), F.size(spans)), F.slice(spans, F.lit(1), F.lit(1)), next_span)


def block_intervals_of(pairs: DataFrame, kinds: Sequence[DataFrame], start: str, end: str, after_scope_start: bool = True) -> DataFrame:
    """``block_intervals`` of all kinds together, of which each has its own keys.

    Blocks are merged by the key of their kind before pairs see them: where a run of blocks ends does not depend on the pair's
    start, and where it begins is told by ``_runs``. So pairs that only blocks of their product concern are joined with the
    intervals that they have in the end, and nothing is summed or sorted by pair; what others have of several kinds is merged
    once more, in the pair's row."""
    pair = ["product_id", "location_id"]
    if not after_scope_start:
        kinds = [k.withColumn("start_date", F.greatest("start_date", F.lit(start).cast("date"))) for k in kinds]
    by: dict[tuple, DataFrame] = {}
    for k in kinds:
        key = tuple(c for c in pair if c in k.columns)
        rows = k.select(*key, "start_date", "end_date")
        by[key] = by[key].unionByName(rows) if key in by else rows
    runs = {key: _runs_of(rows, key, start, end, "_".join(("runs_of", *key))) for key, rows in by.items()}
    wide = ("product_id",) if ("product_id",) in runs else None
    found, clamp = pairs, F.greatest("start_date", F.lit(start).cast("date")).alias("first_day")
    for key in runs:
        if key != wide:
            found = found.join(runs[key], list(key), "left")
    begins = lambda r: F.coalesce(r["after"] < F.col("scope_start"), F.lit(True)) & (r["start_date"] >= F.col("scope_start")) if after_scope_start else r["after"].isNull()
    spans = lambda of: F.transform(of, lambda r: F.struct(r["start_date"].alias("start_date"), r["last_day"].alias("last_day")))
    taken = lambda keys: F.concat(*[F.coalesce(spans(F.filter("_".join(("runs_of", *k)), begins)), F.array()) for k in keys], F.array())
    found = found.select(*pairs.columns, taken([k for k in runs if k != wide]).alias("spans"))
    out = []
    if wide:
        name = "runs_of_product_id"
        alone = found.where(F.size("spans") == 0).drop("spans").join(runs[wide].select("product_id", F.explode(name).alias("r")).select("product_id", "r.*"), "product_id")
        rule = F.coalesce(F.col("after") < F.col("scope_start"), F.lit(True)) & (F.col("start_date") >= F.col("scope_start")) if after_scope_start else F.col("after").isNull()
        out.append(alone.where(rule).select(*pair, clamp, "last_day"))
        found = found.where(F.size("spans") > 0).join(runs[wide], "product_id", "left").select(*pair, F.concat("spans", taken([wide])).alias("spans"))
    merged = found.where(F.size("spans") > 0).select(*pair, F.sort_array("spans").alias("spans"))
    out.append(merged.select(*pair, F.inline(_disjoint(F.col("spans")))).select(*pair, clamp, "last_day"))
    return reduce(DataFrame.unionByName, out)


def flag_blocked(days: DataFrame, intervals: DataFrame, location: str = "store_id") -> DataFrame:
    """``days`` with ``is_blocked``; the intervals are disjoint, so no row is multiplied."""
    spans = intervals.select("product_id", F.col("location_id").alias(location), "first_day", "last_day")
    on = [days["product_id"] == spans["product_id"], days[location] == spans[location], days["date"].between(spans["first_day"], spans["last_day"])]
    return days.join(spans, on, "left").select(*[days[c] for c in days.columns], F.col("first_day").isNotNull().alias("is_blocked"))


def blocked_days(intervals: DataFrame, weeks: DataFrame, start: str, end: str) -> DataFrame:
    """Pair-weeks with the number of their days in the window and how many of these are blocked."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    inside = within(weeks, start, end).select("year", "week", F.greatest("week_start_date", first).alias("from_day"), F.least("week_end_date", last).alias("to_day"))
    met = intervals.join(F.broadcast(inside), (F.col("first_day") <= F.col("to_day")) & (F.col("last_day") >= F.col("from_day")))
    days = F.greatest(F.lit(0), F.datediff(F.least("last_day", "to_day"), F.greatest("first_day", "from_day")) + 1)
    return met.groupBy("product_id", "location_id", "year", "week").agg(F.sum(days).alias("blocked_days"), (F.datediff(F.max("to_day"), F.max("from_day")) + 1).alias("window_days"))


def fully_blocked_weeks(intervals: DataFrame, weeks: DataFrame, start: str, end: str) -> DataFrame:
    return blocked_days(intervals, weeks, start, end).where("blocked_days >= window_days").select("product_id", "location_id", "year", "week")


def fully_blocked_pairs(keys: DataFrame, intervals: DataFrame, weeks: DataFrame, start: str, end: str) -> DataFrame:
    """Pairs of which every week in scope is fully blocked. ``keys``: product_id, location_id, year, week."""
    full = fully_blocked_weeks(intervals, weeks, start, end).withColumn("full", F.lit(True))
    return keys.join(full, ["product_id", "location_id", "year", "week"], "left").groupBy("product_id", "location_id").agg(F.min(F.coalesce("full", F.lit(False))).alias("all_full")).where("all_full").drop("all_full")


def unsuperseded_sizes(products: DataFrame, family: DataFrame) -> DataFrame:
    """Products whose group has a member of a family but which are in no family row themselves."""
    known = family.select("product_id").union(family.select("parent_id")).where("product_id is not null").distinct()
    groups = products.join(known, "product_id", "left_semi").select("option_code").where("option_code is not null").distinct()
    return products.join(groups, "option_code", "left_semi").join(known, "product_id", "left_anti").select("product_id")


def scope_debug(stages: dict[str, DataFrame], products: DataFrame, column: str) -> DataFrame:
    """Distinct pairs per stage and value of a product column, stages as columns; a missing count is 0."""
    parts = [df.select("product_id", "store_id").distinct().withColumn("stage", F.lit(name)) for name, df in stages.items()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    valued = rows.join(products.select("product_id", column), "product_id", "left").withColumn("dimension_value", F.coalesce(F.col(column), F.lit("NULL")))
    return valued.groupBy("dimension_value").pivot("stage", list(stages)).count().na.fill(0)


def scope_audit(stages: Mapping[str, DataFrame], products: DataFrame, dimensions: Sequence[str], filters: Mapping[str, object] | None = None) -> DataFrame:
    """Distinct products, stores and pairs of each stage (``<stage>_product_count`` and so on): of the whole (dimension
    ``overall``, value ``ALL``) and by each value of product columns, under a column's value filter if there is one; a null
    value is ``NULL``, and so is that of an unknown product. A stage without a value's pairs has 0.

    Pairs of all stages are one union with a bit for each stage; each pair is expanded once to its dimensions, summed by
    product and by store, and these sums once more."""
    names = list(stages)
    pairs = reduce(DataFrame.unionByName, [df.select("product_id", "store_id", F.lit(1 << k).cast("long").alias("in_stages")) for k, df in enumerate(stages.values())])
    pairs = pairs.groupBy("product_id", "store_id").agg(F.bit_or("in_stages").alias("in_stages"))
    rows = pairs.join(products.select("product_id", *dimensions), "product_id", "left")
    label = lambda d, v: F.struct(F.lit(d).alias("dimension"), v.alias("dimension_value"))
    of = [label("overall", F.lit("ALL"))] + [F.when(value_filter(d, filters[d]) if filters and d in filters else F.lit(True), label(d, F.coalesce(F.col(d).cast("string"), F.lit("NULL")))) for d in dimensions]
    rows = rows.select("product_id", "store_id", "in_stages", F.explode(F.array_compact(F.array(*of))).alias("slice")).select("slice.*", "product_id", "store_id", "in_stages")
    key, stage = ["dimension", "dimension_value"], lambda k: F.getbit("in_stages", F.lit(k)).cast("long")
    by = lambda column, counts: rows.groupBy(*key, column).agg(F.bit_or("in_stages").alias("in_stages"), *counts).drop(column)
    products_, stores = by("product_id", [F.sum(stage(k)).alias(f"{n}_pair_count") for k, n in enumerate(names)]), by("store_id", [])
    products_ = products_.select(*key, *[stage(k).alias(f"{n}_product_count") for k, n in enumerate(names)], *[f"{n}_pair_count" for n in names])
    stores = stores.select(*key, *[stage(k).alias(f"{n}_store_count") for k, n in enumerate(names)])
    both = products_.unionByName(stores, allowMissingColumns=True)
    columns = [f"{n}_{what}_count" for n in names for what in ("product", "store", "pair")]
    return both.groupBy(*key).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])

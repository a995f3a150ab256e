"""Steps whose work has to stay in proportion to what they read: what is shuffled, and results at the rules' edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import assortment, calendar, facts, metrics, slices
from shelfwise.plans import fixtures
from shelfwise.plans.queries import QUERIES

from .conftest import SF

day = dt.date.fromisoformat


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def weeks_of(spark, first, days):
    cal = spark.sql(f"select date_add(date '{first}', cast(id as int)) date, 2024 year, cast(id div 7 as int) + 1 week, 'Q1' quarter, 'M01' month from range({days})")
    return cal, calendar.fiscal_weeks(cal)


def test_weeks_of_pairs_are_made_after_the_last_shuffle(spark):
    _, weeks = weeks_of(spark, "2024-01-07", 28)
    pairs = spark.createDataFrame([(1, 1, day("2024-01-01"))], "product_id long, store_id long, scope_start date")
    daily = spark.createDataFrame([(1, 1, day("2024-01-09"), 1.0, 0.0)], "product_id long, store_id long, date date, inventory double, sales_quantity double")
    found = facts.instock_daily(pairs, daily, weeks, "2024-01-07", "2024-02-03")
    text = plan(found)
    assert "BroadcastNestedLoopJoin" in text.split("Exchange hashpartitioning")[0]
    assert "Exchange hashpartitioning" not in plan(found.groupBy("product_id", "year", "week").count()).split("BroadcastNestedLoopJoin")[0]
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1, 2024, 1, 1, 5), (1, 1, 2024, 2, 0, 7), (1, 1, 2024, 3, 0, 7), (1, 1, 2024, 4, 0, 7)]


def test_only_the_weeks_that_are_wanted_are_made(spark):
    _, weeks = weeks_of(spark, "2024-01-07", 28)
    pairs = spark.createDataFrame([(1, 1, day("2024-01-01")), (2, 1, day("2024-01-01"))], "product_id long, store_id long, scope_start date")
    daily = spark.createDataFrame([(p, 1, day("2024-01-15"), 1.0, 0.0) for p in (1, 2)], "product_id long, store_id long, date date, inventory double, sales_quantity double")
    wanted = spark.createDataFrame([(1, 1, 2024, 1), (1, 1, 2024, 2), (1, 1, 2024, 2), (1, 1, 2024, 4)], "product_id long, store_id long, year int, week int")
    found = facts.instock_daily(pairs, daily, weeks, "2024-01-07", "2024-02-03", only=wanted)
    assert "BroadcastNestedLoopJoin BuildRight, Inner" not in plan(found)  # of all weeks
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1, 2024, 2, 1, 6), (1, 1, 2024, 4, 0, 7)]


def test_weeks_of_warehouses_are_made_after_the_last_shuffle(spark):
    cal, _ = weeks_of(spark, "2024-01-07", 21)
    stock = spark.createDataFrame([(1, 1, day("2024-01-09"), 1.0), (1, 1, day("2024-01-10"), 0.0)], "product_id long, warehouse_id long, date date, inventory double")
    transit = spark.createDataFrame([(1, 1, day("2024-01-08"), 1.0), (1, 1, day("2024-01-16"), 1.0)], "product_id long, warehouse_id long, date date, quantity double")
    closed = spark.createDataFrame([(1, 1, day("2024-01-16"), day("2024-01-17"))], "product_id long, location_id long, first_day date, last_day date")
    found = lambda **more: facts.dc_instock(stock, cal, "2024-01-07", "2024-01-20", **more)
    assert "BroadcastNestedLoopJoin" in plan(found()).split("Exchange hashpartitioning")[0]
    told = lambda df: sorted(tuple(r)[3:] for r in df.collect())
    assert told(found()) == [(1, 1, 5, 5), (2, 0, 7, 7)]
    assert told(found(transit=transit, threshold=-1.0)) == [(1, 5, 5, 5), (2, 7, 7, 7)]
    assert told(found(transit=transit, intervals=closed)) == [(1, 1, 5, 5), (2, 0, 5, 5)]
    assert told(found(transit=transit, intervals=closed, drop_blocked=False)) == [(1, 1, 5, 5), (2, 1, 7, 5)]


def test_kinds_of_blocks_are_merged_before_pairs_see_them(spark):
    on = lambda k: None if k is None else dt.date(2024, 1, 1) + dt.timedelta(k)
    pairs = [(p, s, on((p * 7 + s * 5) % 30 - 5 if p % 9 else None)) for p in range(20) for s in range(3)]
    spread = lambda n, *keys: [(*[k * 7 % m for m in keys], on(k * 11 % 43 - 6), on(k * 11 % 43 - 7 + k % 6) if k % 17 else None) for k in range(n)]
    named = {("product_id", "location_id"): spread(50, 20, 3), ("product_id",): spread(130, 20), ("location_id",): spread(4, 3)}
    kinds = [spark.createDataFrame(rows, ", ".join(f"{k} long" for k in key) + ", start_date date, end_date date") for key, rows in named.items()]
    frame = spark.createDataFrame(pairs, "product_id long, location_id long, scope_start date")
    for after in (True, False):
        want = []
        for p, s, begun in pairs:
            own = {"product_id": p, "location_id": s}
            rows = [r[-2:] for key, found in named.items() for r in found if all(own[k] == v for k, v in zip(key, r, strict=False)) and (not after or begun is not None and r[-2] >= begun)]
            days = {k for k in range(2, 31) if any(a <= on(k) and (b is None or on(k) <= b) for a, b in rows)}
            starts, ends = sorted(k for k in days if k - 1 not in days), sorted(k for k in days if k + 1 not in days)
            want += [(p, s, on(a), on(b)) for a, b in zip(starts, ends, strict=True)]
        found = assortment.block_intervals_of(frame, kinds, "2024-01-03", "2024-01-31", after)
        assert "Window" not in plan(found)  # nothing is sorted by pair and day
        assert sorted(tuple(r) for r in found.collect()) == sorted(want) and want


def test_rows_are_summed_before_they_are_copied_for_slices(spark):
    products = spark.createDataFrame([(1, "A"), (2, None)], "product_id long, brand string")
    by = slices.Slices(products, {"overall": {}, "stocked": {"inventory": {"exclude": [0.0]}}}, (None, "brand"))
    data = [(p, s, 2024, 1, 0, day("2024-01-08"), float(s % 2), 1.0) for p in (1, 2) for s in range(4)]
    rows = spark.createDataFrame(data, "product_id long, store_id long, year int, week int, part int, date date, inventory double, units double")
    framed, first = metrics._framed(rows, by, metrics.Rules(), set())
    found = metrics._by_product(framed, first, by, {"units": F.sum("units")})
    below = plan(found).split("Generate explode")[1]
    assert "HashAggregate" in below  # was not there: rows were copied for every slice first
    assert sorted((r["root"], str(r["dimension_value"]), r["product_id"], r["units"]) for r in found.collect()) == sorted(
        (root, value, p, n) for root, n in (("overall", 4.0), ("stocked", 2.0)) for p, brand in ((1, "A"), (2, "None")) for value in ("overall", brand)
    )


def test_products_are_dealt_once_over_tasks_that_grow_with_the_lines(spark, monkeypatch):
    names = ("daily_data", "scope", "lost_sales", "blocks", "inventory_warehouse")
    whole = {n: fixtures.load(spark, SF, n).count() for n in names}
    monkeypatch.setattr(fixtures, "LINES", 500)
    fixtures.tasks.cache_clear()
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    for n in names:
        rows = fixtures.load(spark, SF, n)
        assert rows.rdd.getNumPartitions() == -(-lines // 500)  # was what the session sets, however many lines
        held = rows.select("product_id", F.spark_partition_id().alias("at")).groupBy("product_id").agg(F.count_distinct("at").alias("n")).agg(F.max("n")).first()
        assert held[0] == 1 and rows.count() == whole[n]
    for n in ("scope_weekly", "score_scope", "scope_native_weeks"):
        assert "hashpartitioning(product_id" not in plan(QUERIES[n](spark, SF))  # pairs were shuffled by pair and week again
    fixtures.tasks.cache_clear()


def test_daily_rows_are_summed_to_pairs_before_they_meet_the_scope(spark):
    text = plan(QUERIES["scope_semi"](spark, SF))
    assert "Join" in text.split("partial_sum(sales_quantity")[0]  # was below the sum


def test_weeks_of_products_are_the_sums_of_their_pairs(spark):
    on = lambda k: dt.date(2024, 1, 1) + dt.timedelta(k)
    cal, weeks = weeks_of(spark, "2024-01-07", 28)
    parts = calendar.day_parts(cal, "2024-01-31")
    pairs = [(p, s, on((p * 7 + s * 5) % 30 - 5)) for p in range(6) for s in range(4)]
    daily = [(p, s, on(k), float((p + k) % 2), float(k % 3 == 0), (p + s + k) % 5 and 1) for p, s, _ in pairs for k in range((p * 5 + s * 3) % 33, 40, 1 + (p + s) % 4) if (p, s) != (5, 3)]
    moving = [(p, s, on((p * 3 + s * 11) % 40), 1.0) for p, s, _ in pairs]
    closed = [(p, s, on(2 + p + s), on(2 + p + 4 * s)) for p, s, _ in pairs if (p + s) % 2] + [(1, 1, on(0), on(60))]
    pairs, daily = spark.createDataFrame(pairs, "product_id long, store_id long, scope_start date"), spark.createDataFrame(daily, "product_id long, store_id long, date date, inventory double, sales_quantity double, usable int")
    moving, closed = spark.createDataFrame(moving, "product_id long, store_id long, date date, quantity double"), spark.createDataFrame(closed, "product_id long, location_id long, first_day date, last_day date")
    told = lambda df, *c: sorted(tuple(r) for r in df.groupBy("product_id", "year", "week", *(["part"] if "part" in df.columns else [])).agg(*[F.sum(x) for x in c]).collect())
    for grain in (weeks, calendar.parted(weeks, parts)):
        for more in ({}, {"intervals": closed}, {"intervals": closed, "transit": moving, "usable_only": True, "count_start": "scope", "require_daily_data": False}):
            made = [facts.instock_daily(pairs, daily, grain, "2024-01-07", "2024-01-31", by_store=by, **more) for by in (True, False)]
            assert "store_id" not in made[1].columns
            assert told(made[0], "stocked_pairs", "available_days") == sorted(tuple(r) for r in made[1].collect()) != []
    stock, moving = daily.select("product_id", F.col("store_id").alias("warehouse_id"), "date", "inventory"), moving.withColumnRenamed("store_id", "warehouse_id")
    for source in (cal, parts):
        for more in ({}, {"intervals": closed, "transit": moving, "threshold": -1.0, "drop_blocked": False}):
            made = [facts.dc_instock(stock, source, "2024-01-07", "2024-01-31", by_warehouse=by, **more) for by in (True, False)]
            columns = ("dc_stocked_days", "dc_available_days", "dc_unblocked_days")
            assert told(made[0], *columns) == told(made[1], *columns) != []


def test_lines_are_shuffled_once_for_all_measures(spark):
    days = fixtures.days_of_lines(spark, SF)
    for n in fixtures.OF_DAYS:
        one, other = fixtures.load(spark, SF, n), fixtures.load(spark, SF, n, days)
        assert one.dtypes == other.dtypes and one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()
        assert "Exchange" not in plan(other)
    text = plan(QUERIES["latest_day_measures"](spark, SF))
    assert "lineitem.parquet" not in text  # was shuffled for each source and use


@pytest.mark.parametrize("count_start", ["earliest", "first", "scope"])
def test_blocks_are_merged_as_a_pairs_days_are_gone_through(spark, count_start):
    on = lambda k: None if k is None else dt.date(2024, 1, 1) + dt.timedelta(k)
    _, weeks = weeks_of(spark, "2024-01-07", 28)
    start, end = 6, 30  # Sunday of week 1, Wednesday of week 4
    pairs = {(p, s): None if (p, s) == (3, 1) else (p * 7 + s * 5) % 30 - 5 for p in range(8) for s in range(3)}
    daily = {(p, s, k): ((p + k) % 2, k % 3 == 0, None if k % 13 == 0 else int((p + s + k) % 5 > 0)) for p in range(9) for s in range(3) for k in range((p * 5 + s * 3) % 33, 40, 1 + (p + s) % 4) if (p, s) not in ((5, 2), (6, 0))}
    moving = {(p, s, (p * 3 + s * 11) % 40) for p, s in pairs}
    blocks = [(p, s, (p * 5 + s * 7 + n * 9) % 40 - 4, None if (p + n) % 7 == 0 else (p * 5 + s * 7 + n * 9) % 40 - 5 + (p + n * 3) % 8) for p in range(9) for s in range(3) for n in range((p + s) % 4)]
    blocks += [(1, 1, 10, 12), (1, 1, 10, 15), (1, 1, 16, 16), (2, 2, 9, 20), (2, 2, 11, 13), (4, 0, -5, 60), (7, 1, None, 20)]
    frames = {
        "pairs": spark.createDataFrame([(*k, on(v)) for k, v in pairs.items()], "product_id long, store_id long, scope_start date"),
        "daily": spark.createDataFrame([(*k[:2], on(k[2]), float(a), float(b), u) for k, (a, b, u) in daily.items()], "product_id long, store_id long, date date, inventory double, sales_quantity double, usable int"),
        "blocks": spark.createDataFrame([(p, s, on(a), on(b)) for p, s, a, b in blocks], "product_id long, location_id long, start_date date, end_date date"),
        "transit": spark.createDataFrame([(p, s, on(k), 1.0) for p, s, k in moving], "product_id long, store_id long, date date, quantity double"),
    }
    merged = assortment.block_intervals(frames["pairs"].withColumnRenamed("store_id", "location_id"), frames["blocks"], str(on(start)), str(on(end)))
    for usable_only, transit, need in ((False, False, True), (True, True, True), (True, True, False)):
        want = []
        for (p, s), scope in pairs.items():
            closed = {k for q, t, a, b in blocks if (q, t) == (p, s) and a is not None and scope is not None and a >= scope for k in range(a, (end if b is None else b) + 1)} & set(range(start, end + 1))
            days = {k: v for (q, t, k), v in daily.items() if (q, t) == (p, s) and k not in closed}
            first = min(days, default=None)
            if first is None and need:
                continue
            known = [d for d in (scope, first) if d is not None]
            rule = {"first": first, "scope": first if scope is None else scope, "earliest": min(known, default=None)}[count_start]
            begins = max(start, start if rule is None else rule)
            for w in range(4):
                counted = [k for k in range(start + 7 * w, min(start + 7 * w + 6, end) + 1) if k >= begins and k not in closed and not (usable_only and k in days and days[k][2] != 1)]
                if counted:
                    want.append((p, s, 2024, w + 1, sum(1 for k in counted if k in days and (days[k][0] > 0 or days[k][1] > 0) or transit and (p, s, k) in moving), len(counted)))
        more = {"usable_only": usable_only, "require_daily_data": need, "transit": frames["transit"] if transit else None}
        for closures in ({"blocks": frames["blocks"]}, {"intervals": merged}):
            found = facts.instock_daily(frames["pairs"], frames["daily"], weeks, str(on(start)), str(on(end)), count_start, **more, **closures)
            assert sorted(tuple(r) for r in found.collect()) == sorted(want) and want


def test_no_input_is_joined_or_shuffled_by_pair(spark):
    text = plan(QUERIES["instock_daily_earliest"](spark, SF))
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 3 and all("REPARTITION_BY_NUM" in line for line in shuffles)  # daily rows, scope, blocks as they are dealt; were seven, and six joins
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" not in text


def test_transit_and_daily_rows_meet_where_they_are_dealt(spark):
    text = plan(QUERIES["instock_usable_transit"](spark, SF))
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 4 and all("REPARTITION_BY_NUM" in line for line in shuffles)  # were eight, and six joins
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" not in text


def test_a_first_row_within_a_block_does_not_open_a_pair(spark):
    _, weeks = weeks_of(spark, "2024-01-07", 28)
    pairs = spark.createDataFrame([(1, 1, day("2024-01-01")), (2, 1, day("2024-01-01"))], "product_id long, store_id long, scope_start date")
    daily = spark.createDataFrame([(p, 1, day(d), 1.0, 0.0) for p, d in ((1, "2024-01-09"), (1, "2024-01-23"), (2, "2024-01-09"))], "product_id long, store_id long, date date, inventory double, sales_quantity double")
    blocks = spark.createDataFrame([(p, 1, day(a), b and day(b)) for p, a, b in ((1, "2024-01-08", "2024-01-10"), (1, "2024-01-09", "2024-01-12"), (1, "2024-01-29", None), (2, "2023-12-31", "2024-01-20"))], "product_id long, location_id long, start_date date, end_date date")
    found = facts.instock_daily(pairs, daily, weeks, "2024-01-07", "2024-02-03", "first", blocks=blocks)
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1, 2024, 3, 1, 5), (1, 1, 2024, 4, 0, 1), (2, 1, 2024, 1, 1, 5), (2, 1, 2024, 2, 0, 7), (2, 1, 2024, 3, 0, 7), (2, 1, 2024, 4, 0, 7)]
    assert "changes" not in plan(found)  # weeks were looked up in a map, one by one


def test_a_pair_without_scope_start_opens_with_its_first_row_and_is_never_blocked(spark):
    _, weeks = weeks_of(spark, "2024-01-07", 21)
    pairs = spark.createDataFrame([(1, 1, None), (2, 1, day("2024-01-16"))], "product_id long, store_id long, scope_start date")
    daily = spark.createDataFrame([(p, 1, day("2024-01-10"), 1.0, 0.0) for p in (1, 2, 3)], "product_id long, store_id long, date date, inventory double, sales_quantity double")
    blocks = spark.createDataFrame([(p, 1, day(a), day(b)) for p in (1, 2, 3) for a, b in (("2024-01-10", "2024-01-11"), ("2024-01-18", "2024-01-19"))], "product_id long, location_id long, start_date date, end_date date")
    found = facts.instock_daily(pairs, daily, weeks, "2024-01-07", "2024-01-27", "scope", blocks=blocks)
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1, 2024, 1, 1, 4), (1, 1, 2024, 2, 0, 7), (1, 1, 2024, 3, 0, 7), (2, 1, 2024, 2, 0, 3), (2, 1, 2024, 3, 0, 7)]
    assert "Join" not in plan(found).replace("BroadcastNestedLoopJoin BuildRight, Cross", "")  # pairs, days and blocks were joined by pair

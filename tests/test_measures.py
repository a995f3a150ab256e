"""Measures, slices, parts of weeks, in-stock days and scope audits on hand-made frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import assortment, calendar, compare, facts, metrics, slices
from shelfwise.plans import fixtures
from shelfwise.plans.queries import Inputs
from shelfwise.sources import readers

from .conftest import SF

day = dt.date.fromisoformat
FIRST = day("2024-01-07")  # a Sunday


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def cal(spark):
    """Two years of eight weeks, two quarters of four weeks each."""
    days = [(FIRST + dt.timedelta(days=k), 2024 + k // 56, 1 + k % 56 // 7, f"Q{1 + k % 56 // 28}", f"M{1 + k % 56 // 28}") for k in range(112)]
    return spark.createDataFrame(days, "date date, year int, week int, quarter string, month string")


def daily(spark, data, cal, products, weeks=None):
    days = spark.createDataFrame([(p, s, FIRST + dt.timedelta(days=k), float(r), float(q), float(i)) for p, s, k, r, q, i in data], "product_id long, store_id long, date date, sales_revenue double, sales_quantity double, inventory double")
    return facts.scoped_daily(days, products, cal, weeks or calendar.fiscal_weeks(cal))


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([(1, "A", 1.0, 2.0), (2, None, 1.0, 2.0)], "product_id long, brand string, cogs double, price_without_tax double")


def test_transit_counts_once_for_several_rows_of_a_day(spark):
    stock = spark.createDataFrame([(1, 1, FIRST, 3.0, True), (1, 1, FIRST, 4.0, False)], "product_id long, store_id long, date date, inventory double, gross_only boolean")
    moving = spark.createDataFrame([(1, 1, FIRST, 10.0)], "product_id long, store_id long, date date, quantity double")
    out = facts.with_transit(stock, moving, ["product_id", "store_id", "date"], "has_daily_row")
    assert rows(out, "inventory", "git_quantity", "gross_only", "has_daily_row") == [(7.0, 10.0, False, True)]


def test_in_stock_days_start_after_blocks(spark, cal):
    """The first row lies in a block of four days; the next one is the first that counts."""
    pairs = spark.createDataFrame([(1, 1, None)], "product_id long, store_id long, scope_start date")
    data = spark.createDataFrame([(1, 1, FIRST + dt.timedelta(days=k), 1.0, 0.0) for k in (1, 4)], "product_id long, store_id long, date date, inventory double, sales_quantity double")
    closed = spark.createDataFrame([(1, 1, FIRST, FIRST + dt.timedelta(days=3)), (1, 1, FIRST + dt.timedelta(days=6), FIRST + dt.timedelta(days=8))], "product_id long, location_id long, first_day date, last_day date")
    found = facts.instock_daily(pairs, data, calendar.fiscal_weeks(cal), "2024-01-07", "2024-01-20", "first", closed)
    assert rows(found, "week", "stocked_pairs", "available_days") == [(1, 1, 2), (2, 0, 5)]


def test_stale_daily_rows_fail_the_job(spark):
    pairs = spark.createDataFrame([(1, 1)], "product_id long, store_id long")
    data = spark.createDataFrame([(1, 1, day("2024-01-09")), (2, 1, day("2024-02-09"))], "product_id long, store_id long, date date")
    assert facts.up_to_date(data, pairs, "2024-01-09").count() == 1
    for end, of in (("2024-01-10", data), ("2024-01-10", data.limit(0))):
        with pytest.raises(Exception, match="before the report does"):
            facts.up_to_date(of, pairs, end).collect()


def test_population_groups():
    groups = {m: g for g, names in metrics.GROUPS.items() for m in names}
    assert set(groups) == set(metrics.METRICS)
    assert groups["WOS"] != groups["WOS_DC"] and groups["total_mean_stock"] == groups["dc_mean_stock"] and groups["inventory_turnover_rate"] != groups["mean_stock"]
    both = metrics.Rules(populations={"AUR": {"brand": ["A"]}, "AUC": {"category": ["x"], "brand": ["A"]}})
    assert metrics.conditions(both, "sales") == {"brand": ["A"], "category": ["x"]} and metrics.conditions(both, "wos") == {}


def test_a_population_is_of_its_group_only(spark, cal, products):
    frame = daily(spark, [(1, 1, 0, 1, 1, 5), (2, 1, 0, 1, 2, 7), (1, 1, 1, 1, 1, 5)], cal, products)
    periods = calendar.period_bridge(calendar.fiscal_weeks(cal), "2024-01-07", "2024-03-02", ("annual",))
    rules = metrics.Rules(("total_sales_quantity", "mean_stock", "inventory_turnover_rate"), populations={"mean_stock_cost": {"brand": ["A"]}})
    assert rows(metrics.kpi_table(metrics.Facts(frame), slices.Slices(products), periods, rules), "total_sales_quantity", "mean_stock", "inventory_turnover_rate") == [(4.0, 5.0, 4 / 8.5)]


def test_slices_of_unknown_products_and_places(spark, cal, products):
    stores = spark.createDataFrame([(1, "north")], "store_id long, district string")
    frame = daily(spark, [(1, 1, 0, 1, 1, 5), (1, 9, 0, 1, 3, 0), (2, 1, 0, 1, 2, 7)], cal, products)
    lost = spark.createDataFrame([(1, 2024, 1, 1.0, 4.0), (77, 2024, 1, 3.0, 4.0)], "product_id long, year int, week int, lost_sales double, could_sell double")
    by = slices.Slices(products, {"overall": {}, "in stock": {"inventory": {"exclude": [0.0]}}}, (None, "district", "brand"), {"brand": ["A"]}, stores=stores)
    periods = calendar.period_bridge(calendar.fiscal_weeks(cal), "2024-01-07", "2024-03-02", ("annual",))
    out = metrics.kpi_table(metrics.Facts(frame, lost=lost), by, periods, metrics.Rules(("total_sales_quantity", "distinct_store_count", "lost_sales_pct")))
    assert rows(out, "root", "dimension", "dimension_value", "total_sales_quantity", "distinct_store_count", "lost_sales_pct") == [
        ("in stock", "brand", "A", 1.0, 1, 25.0), ("in stock", "district", "north", 3.0, 1, None), ("in stock", "overall", "overall", 3.0, 1, 50.0),
        ("overall", "brand", "A", 4.0, 2, 25.0), ("overall", "district", "north", 3.0, 1, None), ("overall", "district", None, 3.0, 1, None), ("overall", "overall", "overall", 6.0, 2, 50.0),
    ]
    with pytest.raises(ValueError):
        slices.Slices(products, cuts=("cogs",))


def test_parts_of_the_week_that_the_end_lies_in(spark, cal):
    end = "2024-03-12"  # Tuesday of the second week of 2024's successor: day 10
    parts = calendar.day_parts(cal, end)
    assert rows(parts.where("part = 1").groupBy("year", "week", "week_days").count(), "year", "week", "week_days", "count") == [(2024, 2, 3, 3), (2025, 2, 3, 3)]
    assert parts.where("part = 0").count() == 112
    bridge = calendar.day_bridge(cal, calendar.fiscal_weeks(cal), "2024-01-07", end, ("annual", "week", "ytd"))
    assert rows(bridge.where("period_type = 'ytd'"), "year", "week", "part", "family") == [
        (2024, 1, 0, "daily"), (2024, 1, 0, "lost"), (2024, 2, 1, "daily"), (2025, 1, 0, "daily"), (2025, 1, 0, "lost"), (2025, 2, 1, "daily"),
    ]
    assert rows(bridge.where("period_type = 'annual'").select("period").distinct(), "period") == [("2024",)]
    assert bridge.where("period_type = 'week' and year = 2025").count() == 1
    whole = calendar.day_bridge(cal, calendar.fiscal_weeks(cal), "2024-01-07", "2024-03-16", ("ytd",))  # a Saturday splits nothing
    assert calendar.day_parts(cal, "2024-03-16").where("part = 1").count() == 0 and whole.where("part = 1").count() == 0
    assert rows(whole.where("family = 'lost' and year = 2025"), "week") == [(1,), (2,)]


def test_measures_of_a_part(spark, cal, products):
    """Weeks of supply of days 1 to 10 weigh the second week by 3 of 7 days, and its stock is that of those days."""
    weeks, end = calendar.fiscal_weeks(cal), "2024-03-12"
    data = [(1, 1, 0, 1, 2, 10), (1, 1, 8, 1, 1, 4), (1, 1, 12, 1, 5, 100)]
    frame = daily(spark, data, calendar.day_parts(cal, end), products, weeks)
    out = metrics.kpi_table(metrics.Facts(frame), slices.Slices(products), calendar.day_bridge(cal, weeks, "2024-01-07", end, ("annual", "ytd")), metrics.Rules(("total_sales_quantity", "mean_stock", "WOS", "distinct_pair_count")))
    assert rows(out, "period", "total_sales_quantity", "mean_stock", "WOS", "distinct_pair_count") == [("2024", 8.0, 38.0, (10 + 52) / 8, 1), ("YTD-2024", 3.0, 7.0, (10 + 4 * 3 / 7) / 3, 1)]


def test_like_for_like_tags_a_middle_year_twice(spark, products):
    days = [(FIRST + dt.timedelta(days=k), 2024 + k // 14, 1 + k % 14 // 7, "Q1", "M1") for k in range(56)]
    cal = spark.createDataFrame(days, "date date, year int, week int, quarter string, month string")
    data = [(1, 1, 14 * y + 1, 1, 1 + y, 5) for y in range(3)] + [(2, 1, 1, 1, 50, 5), (1, 2, 15, 1, 50, 5)]
    weeks = calendar.fiscal_weeks(cal)
    lost = spark.createDataFrame([(p, y, 1, 1.0, 4.0) for p in (1, 2) for y in (2024, 2025, 2026)], "product_id long, year int, week int, lost_sales double, could_sell double")
    out = compare.like_for_like(metrics.Facts(daily(spark, data, cal, products), lost=lost), slices.Slices(products), weeks, "2024-01-07", "2024-02-17", "yoy", metrics.Rules(("total_sales_quantity", "lost_sales_pct")))
    assert rows(out, "link_prior_year", "link_current_year", "year", "total_sales_quantity", "lost_sales_pct", "comparable_pair_count") == [
        (2024, 2025, 2024, 1.0, 25.0, 1), (2024, 2025, 2025, 2.0, 25.0, 1), (2025, 2026, 2025, 2.0, 25.0, 1), (2025, 2026, 2026, 3.0, 25.0, 1),
    ]
    assert rows(compare.rebuilt(out, ["total_sales_quantity"], "yoy"), "prior_period", "current_period", "change_pct") == [("2024", "2025", 100.0), ("2025", "2026", 50.0)]
    with pytest.raises(ValueError):
        compare.like_for_like(metrics.Facts(daily(spark, data, cal, products)), slices.Slices(products), weeks, "2024-01-07", "2024-02-17", "week", metrics.Rules())


def test_month_labels_by_most_days(spark):
    days = [(day("2024-01-29") + dt.timedelta(days=k), 2024, 1 + k // 7, "Q1", "M7", None) for k in range(6)] + [(day("2024-05-01"), 2024, 9, "Q2", "M8", "Mai"), (day("2024-05-02"), 2024, 9, "Q2", "M8", None)]
    cal = spark.createDataFrame(days, "date date, year int, week int, quarter string, month string, name string")
    assert rows(calendar.month_labels(cal, "name"), "month", "label") == [(7, "2024-Jan"), (8, "2024-Mai")]  # three days each: the earlier month
    assert rows(calendar.month_labels(cal), "month", "label") == [(7, "2024-Jan"), (8, "2024-May")]


def test_scope_audit_counts(spark):
    products = spark.createDataFrame([(1, "A"), (2, None)], "product_id long, brand string")
    one = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 1), (1, 1)], "product_id long, store_id long")
    out = assortment.scope_audit({"scope": one, "left": one.where("product_id = 1")}, products, ["brand"])
    names = [f"{s}_{n}_count" for s in ("scope", "left") for n in ("product", "store", "pair")]
    assert rows(out, "dimension", "dimension_value", *names) == [("brand", "A", 1, 2, 2, 1, 2, 2), ("brand", "NULL", 2, 1, 2, 0, 0, 0), ("overall", "ALL", 3, 2, 4, 1, 2, 2)]


def test_coverage_of_labels_without_rows(spark):
    df = spark.createDataFrame([(day("2024-01-09"), 1), (None, 1)], "date date, v int")
    out = readers.coverage_table({"s": (df, {"all": ("date", []), "none": ("date", ["v > 1", ""])})})
    assert rows(out, "source", "label", "first_day", "n_rows") == [("s", "all", day("2024-01-09"), 2), ("s", "none", None, 0)]


def test_inputs_hold_all_rows_of_their_tables(spark):
    x, count = Inputs(spark, SF), lambda t: spark.read.parquet(f"{SF}/{t}.parquet").count()
    line, n = spark.read.parquet(f"{SF}/lineitem.parquet"), fixtures.moduli(SF)
    assert x.transactional_sales.count() == count("lineitem") and x.blocks.count() == count("orders")
    assert x.daily_data.agg(F.sum("sales_quantity")).first()[0] == line.agg(F.sum("l_quantity")).first()[0]
    folded = line.select((F.col("l_partkey") % n["M"]).alias("p"), (F.col("l_suppkey") % n["S"]).alias("s"))
    assert x.scope.count() == folded.distinct().count()
    assert x.dc_scope.count() == spark.read.parquet(f"{SF}/orders.parquet").select(F.col("o_custkey") % n["M"], F.col("o_custkey") % n["W"]).distinct().count()

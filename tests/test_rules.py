"""Single rules on hand-made frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.changes import display, display_change
from shelfwise.functions.conditions import at_least_zero, ratio, value_filter
from shelfwise.operators import assortment, calendar, compare, facts, metrics
from shelfwise.sources import readers, snapshots

day = dt.date.fromisoformat


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize(
    ("blocks", "islands"),
    [
        ([("2024-01-01", "2024-01-05"), ("2024-01-06", "2024-01-09")], [("2024-01-01", "2024-01-09")]),
        ([("2024-01-01", "2024-01-05"), ("2024-01-07", "2024-01-09")], [("2024-01-01", "2024-01-05"), ("2024-01-07", "2024-01-09")]),
        ([("2024-01-01", "2024-01-09"), ("2024-01-03", "2024-01-04")], [("2024-01-01", "2024-01-09")]),
        ([("2024-01-20", None)], [("2024-01-20", "2024-01-31")]),
        ([("2023-12-01", "2024-01-02")], []),
        ([("2024-02-01", "2024-02-02")], []),
    ],
)
def test_blocks_merge_when_they_touch(spark, blocks, islands):
    pairs = spark.createDataFrame([(1, 1, day("2024-01-01"))], "product_id long, location_id long, scope_start date")
    df = spark.createDataFrame([(1, 1, day(a), b and day(b)) for a, b in blocks], "product_id long, location_id long, start_date date, end_date date")
    found = assortment.block_intervals(pairs, df, "2024-01-01", "2024-01-31")
    assert rows(found, "first_day", "last_day") == [(day(a), day(b)) for a, b in islands]


@pytest.mark.parametrize(("spec", "kept"), [(["A"], ["A"]), ([], ["A", "B"]), ({"exclude": ["A"]}, ["B", None]), ({"include": ["A"], "keep_null": True}, ["A", None]), ({"exclude": ["A"], "keep_null": False}, ["B"]), ({}, ["A", "B", None])])
def test_value_filter_and_nulls(spark, spec, kept):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "v string")
    assert {r["v"] for r in df.where(value_filter("v", spec)).collect()} == set(kept)


def test_value_filter_rejects_unknown_parts():
    with pytest.raises(ValueError):
        value_filter("v", {"only": ["A"]})


def test_ratio_of_nothing_and_floor_at_zero(spark):
    r = spark.range(1).select(ratio(F.lit(1.0), F.lit(0.0)).alias("a"), at_least_zero(F.lit(None).cast("double")).alias("b")).first()
    assert r["a"] is None and r["b"] == 0.0


def test_flags_of_gross_and_transit_days(spark):
    days = spark.createDataFrame(
        [(1, 1, day("2024-01-01"), 1.0, 1.0, 5.0, False, 0.0, True), (1, 1, day("2024-01-02"), 1.0, 1.0, 0.0, True, 0.0, True), (1, 1, day("2024-01-03"), 0.0, 0.0, 0.0, False, 4.0, False), (1, 1, day("2024-01-04"), 1.0, 1.0, 0.0, True, 3.0, True)],
        "product_id long, store_id long, date date, sales_revenue double, sales_quantity double, inventory double, gross_only boolean, git_quantity double, has_daily_row boolean",
    )
    products = spark.createDataFrame([(1, 2.0, 3.0)], "product_id long, cogs double, price_without_tax double")
    cal = spark.createDataFrame([(day(f"2024-01-0{k}"), 2024, 1, "Q1", "M1") for k in range(1, 8)], "date date, year int, week int, quarter string, month string")
    out = facts.scoped_daily(days, products, cal, calendar.fiscal_weeks(cal))
    assert rows(out, "date", "has_daily_row", "has_sales_row", "has_stock_row") == [
        (day("2024-01-01"), True, True, True), (day("2024-01-02"), False, True, False), (day("2024-01-03"), False, False, True), (day("2024-01-04"), False, True, True),
    ]


def test_floor_before_the_sum(spark):
    cal = spark.createDataFrame([(day("2024-01-07") + dt.timedelta(days=k), 2024, 1 + k // 7) for k in range(14)], "date date, year int, week int")
    lost = spark.createDataFrame([(1, 1, day("2024-01-07"), 0.5), (1, 1, day("2024-01-14"), 0.5)], "product_id long, store_id long, week_start_date date, lost_sales double")
    sales = spark.createDataFrame([(1, 1, day("2024-01-08"), 1.0), (1, 1, day("2024-01-15"), 1.0)], "product_id long, store_id long, date date, sales_quantity double")
    assert facts.lost_base(lost, sales, cal, "2024-01-07", "2024-01-20").agg(F.sum("could_sell")).first()[0] == 2.0


def test_calendar_needs_every_date(spark):
    cal = spark.createDataFrame([(day("2024-01-01"),), (day("2024-01-03"),)], "date date")
    with pytest.raises(ValueError):
        calendar.checked(cal, "2024-01-01", "2024-01-03")


def test_report_window():
    assert calendar.report_window(day("2001-07-18"), day("1998-02-04")) == (day("1998-02-01"), day("2001-07-14"))
    assert calendar.report_window(day("2001-07-18"), day("1998-02-04"), latest_day=True)[1] == day("2001-07-18")


def test_rules_reject_unknown_metrics():
    with pytest.raises(ValueError):
        metrics.Rules(("nonsense",))


def test_conflicting_populations(spark):
    rules = metrics.Rules(populations={"AUR": {"a": [1]}, "AUC": {"a": [2]}})
    with pytest.raises(ValueError):
        metrics.population(spark.range(1), rules, "sales", spark.range(1))


def test_rename_or_fail(spark):
    assert readers.renamed(spark.range(1), {"id": "product_id"}).columns == ["product_id"]
    with pytest.raises(ValueError):
        readers.renamed(spark.range(1), {"nope": "product_id"})


def test_csv_and_window(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,v\n2024-01-01,1\n2024-01-02,2\n2024-01-03,3\n")
    df = readers.read(spark, f"file://{tmp_path}/a.csv", "csv", "date string, v int")
    assert rows(readers.window(df, "date", "2024-01-02", "2024-01-03"), "v") == [(2,), (3,)]


def test_snapshots(spark, tmp_path):
    keys = snapshots.KEYS["scope_diff"]
    frame = lambda *r: spark.createDataFrame(list(r), "year string, metric string, value double")
    root = f"file://{tmp_path}"
    assert snapshots.save(frame(("2023", "a", 1.0)), root, "t", "2024-01-01", keys, "initial")
    with pytest.raises(ValueError):
        snapshots.save(frame(("2023", "a", 1.0)), root, "t", "2024-01-02", keys, "initial")
    assert not snapshots.save(frame(("2023", "a", 1.0)).limit(0), root, "t", "2024-01-02", keys)
    new = frame(("2023", "a", 9.0), ("2024", "a", 2.0))
    assert rows(snapshots.plan(snapshots.latest(spark, root, "t", "2024-02-01"), new, keys), "action", "n") == [("append", 1), ("skip", 1)]
    snapshots.save(new, root, "t", "2024-01-08", keys)
    assert rows(snapshots.latest(spark, root, "t", "2024-02-01"), "year", "value") == [("2023", 1.0), ("2024", 2.0)]
    snapshots.save(new, root, "t", "2024-01-08", keys, overwrite=True)
    assert rows(snapshots.latest(spark, root, "t", "2024-02-01"), "year", "value") == [("2023", 9.0), ("2024", 2.0)]
    assert rows(snapshots.latest(spark, root, "t", "2024-01-05"), "value", "_run_as_of") == [(1.0, "2024-01-01")]


def test_display():
    assert display("WOS", 23.9) == "23" and display("total_sales_revenue", 3.4e7) == "$34.0M" and display("in_stock_rate", 0.5) == "50.0%" and display("AUR", None) == "—"
    assert display_change("WOS", 0.0, None) == "+0.0%" and display_change("in_stock_rate", None, 2.5) == "+2.5 pp"


def test_streamed_days(spark, tmp_path):
    from shelfwise.streaming import ingest

    schema = "product_id long, store_id long, sold_at timestamp, sales_revenue double, sales_quantity double"
    at = dt.datetime.fromisoformat
    spark.createDataFrame([(1, 1, at("2024-01-01T10:00:00"), 2.0, 1.0), (1, 1, at("2024-01-01T11:00:00"), 3.0, 1.0), (1, 1, at("2024-02-01T00:00:00"), 1.0, 1.0)], schema).write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        ingest.append(ingest.daily_sales(ingest.transactions(spark, f"{tmp_path}/in", schema)), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/out").where("date < '2024-01-15'"), "sales_revenue", "sales_quantity") == [(5.0, 2.0)]


def test_preview_and_planning_levels(spark):
    days = spark.sql("select id, date_add(date '2024-01-01', cast(id as int)) date from range(40)")
    n, shown = readers.preview(days, "date", "2024-01-05", "2024-01-20", rows=3)
    assert n == 16 and shown.count() == 3 and shown.where("date < '2024-01-05' or date > '2024-01-20'").isEmpty()
    levels = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 3)], "planning_level_id string, product_id long")
    given = spark.createDataFrame([("a", 5.0), ("c", 1.0), (None, 2.0)], "planning_level_id string, lost_sales double")
    rows = readers.by_product(given, levels)
    assert sorted((r.product_id, r.lost_sales) for r in rows.collect()) == [(1, 5.0), (2, 5.0)]
    assert readers.by_product(rows, levels) is rows


def test_complete_month(spark):
    weeks = lambda n: calendar.fiscal_weeks(spark.createDataFrame([(day("2024-01-07") + dt.timedelta(days=k), 2024, 1 + k // 7, "Q1", f"M{1 + k // 28}") for k in range(n)], "date date, year int, week int, quarter string, month string"))
    assert calendar.complete_month_end("2024-01-07", "2024-02-10", weeks(84)) == day("2024-02-03")
    assert calendar.complete_month_end("2024-01-07", "2024-02-03", weeks(84)) == day("2024-02-03")
    assert calendar.complete_month_end("2024-01-01", "2024-02-10") == day("2024-01-31") == calendar.complete_month_end("2024-01-01", "2024-01-31")
    for start, end, n in (("2024-01-07", "2024-02-10", 35), ("2024-01-07", "2024-01-20", 84), ("2024-01-14", "2024-02-10", 84)):  # calendar too short, no month ends, month began before
        with pytest.raises(ValueError):
            calendar.complete_month_end(start, end, weeks(n))
    for start, end in (("2024-02-05", "2024-02-20"), ("2024-01-05", "2024-02-20")):
        with pytest.raises(ValueError):
            calendar.complete_month_end(start, end)


def test_last_saturday():
    assert [calendar.last_saturday(day(f"2024-01-{d}")) for d in ("13", "14", "19", "20")] == [day("2024-01-13")] * 3 + [day("2024-01-20")]


def test_daily_scope_needs_keys(spark):
    cal = spark.createDataFrame([(day("2024-01-07"), 2024, 1, "Q1", "M1")], "date date, year int, week int, quarter string, month string")
    pairs = spark.createDataFrame([(1, 2)], "product_id long, location_id long")
    assert rows(assortment.daily_scope(pairs.select("product_id"), calendar.fiscal_weeks(cal), "2024-01-07", "2024-01-13"), "product_id", "week") == [(1, 1)]
    with pytest.raises(ValueError):
        assortment.daily_scope(pairs, calendar.fiscal_weeks(cal), "2025-01-07", "2025-01-13")


def test_comparisons_are_saved_anew_after_a_merge(spark, tmp_path):
    root = f"file://{tmp_path}"
    frame = lambda *r: spark.createDataFrame([("annual", p, "overall", "overall", "overall", v) for p, v in r], "period_type string, period string, root string, dimension string, dimension_value string, AUR double")
    for date, new in (("2024-01-01", frame(("2022", 1.0), ("2023", 2.0))), ("2024-01-08", frame(("2023", 9.0), ("2024", 3.0)))):
        snapshots.save_recomputed(new, root, "kpi_long", date, snapshots.KEYS["kpi_long"], {"comparison_yoy": lambda t: compare.links(t, ["AUR"], "annual", "yoy")})
    assert rows(snapshots.latest(spark, root, "comparison_yoy", "2024-02-01"), "prior_period", "current_period", "change_pct") == [("2022", "2023", 100.0), ("2023", "2024", 50.0)]


def test_years_need_present_and_complete_parts(spark):
    weeks = spark.createDataFrame([(y, w, day(f"{y}-01-0{w}"), day(f"{y}-01-0{w}"), w, 1, w) for y in (2021, 2022, 2023) for w in (1, 2)], "year int, week int, week_start_date date, week_end_date date, quarter int, half int, month int")
    found = spark.createDataFrame([(1, 1, 2021, 1, True, False), (1, 1, 2022, 1, True, True), (1, 1, 2022, 2, True, False), (1, 1, 2023, 1, True, False)], "product_id long, store_id long, year int, week int, has_sales_row boolean, is_blocked boolean")
    window = (weeks, "2021-01-01", "2023-01-01")
    assert compare.qualifying_years(found, *window, "ytd") == [2021, 2022, 2023]
    assert compare.qualifying_years(found, *window) == [2021, 2022]
    assert compare.qualifying_years(found, *window, "quarter", 1) == [2021, 2023]
    assert compare.qualifying_years(found, *window, "quarter", 1, unblocked=False) == [2021, 2022, 2023]

"""Registered queries of the retail engine, over the test tables' projections, and the same results as DuckDB SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.changes import change_pct, change_pp
from ..functions.conditions import expressions, filtered, value_filter
from ..operators import assortment, calendar, compare, facts, metrics, slices
from ..sources import readers, snapshots
from .fixtures import END, START, ctes, days_of_lines, load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
RUN = "2001-07-15"
LATEST = "2001-07-18"
ROOTS = {"overall": {}, "promo": {"category": ["PROMO"]}}


class Inputs:
    """The retail inputs of one folder and the frames that most queries share."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.days = spark, sf_dir, None

    def __getattr__(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name, self.days)

    def staged(self) -> Inputs:
        """The same inputs, with lines brought to days once, in a table that all of them are read from."""
        found = Inputs(self.spark, self.sf_dir)
        found.days = days_of_lines(self.spark, self.sf_dir)
        return found

    def weeks(self) -> DataFrame:
        return calendar.fiscal_weeks(self.fiscal_cal)

    def usable(self) -> DataFrame:
        return readers.window(expressions(self.daily_data, ["usable = 1"]), "date", START, END).drop("usable")

    def pairs(self) -> DataFrame:
        return assortment.scope_pairs(assortment.scope_rows(self.scope, [21], RUN))

    def intervals(self) -> DataFrame:
        return assortment.block_intervals(self.pairs(), self.blocks, START, END)

    def scoped(self, days: DataFrame | None = None) -> DataFrame:
        return facts.scoped_daily(self.usable() if days is None else days, self.products, self.fiscal_cal, self.weeks())

    def periods(self, kinds=("annual",)) -> DataFrame:
        return calendar.period_bridge(self.weeks(), START, END, kinds)

    def slices(self, roots=None, cuts=(None,), **more) -> slices.Slices:
        return slices.Slices(self.products, roots or {"overall": {}}, cuts, **more)

    def kpis(self, names, kinds=("annual",), roots=None, cuts=(None,), frames=None, **rules) -> DataFrame:
        frames = frames or metrics.Facts(self.scoped())
        return metrics.kpi_table(frames, self.slices(roots, cuts), self.periods(kinds), metrics.Rules(tuple(names), **rules))


def shaped(df: DataFrame) -> DataFrame:
    """Doubles to six decimals and whole numbers as longs, as the SQL gives them."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        out.append((F.round(c.cast("double"), 6) if kind in ("double", "float") or kind.startswith("decimal") else c.cast("long") if kind in ("int", "bigint", "smallint", "tinyint") else c).alias(name))
    return df.select(*out)


def query(*sources: str, sql: str, doubles: str = "", own: str = ""):
    """Registers a query under its function's name, with SQL behind these inputs and table expressions of its ``own``;
    ``doubles`` names the result's columns that both sides give to six decimals."""

    def add(f: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: shaped(f(Inputs(spark, sf_dir)))
        body = sql.strip()
        tables = [ctes(*sources)] if sources else []
        tables += [SHARED[k].strip() for k in SHARED if needed(k, body + own)]
        tables += [own] if own else []
        if doubles:
            rounded = ", ".join(f'round(cast("{c}" as double), 6) as "{c}"' for c in doubles.split())
            body = f"select * replace ({rounded}) from ({body})"
        text = ("with " + ",\n".join(tables) + "\n" if tables else "") + body
        SQL[f.__name__] = text.replace("{START}", f"date '{START}'").replace("{END}", f"date '{END}'")
        return f

    return add


#: Shared table expressions of the SQL, in order of need.
SHARED = {
    "wk": """wk as (select year, week, min(date) week_start_date, max(date) week_end_date, count(*) week_days,
  min(cast(substr(quarter, 2) as int)) as "quarter", min(cast(substr(month, 2) as int)) as "month",
  case when min(cast(substr(quarter, 2) as int)) <= 2 then 1 else 2 end half from fiscal_cal group by 1, 2)""",
    "win": "win as (select * from wk where week_end_date >= {START} and week_start_date <= {END})",
    "cp": """cp as (select *, first_day >= {START} and last_day <= {END} is_complete from (
  select 'annual' period_type, year, 0 number, min(week_start_date) first_day, max(week_end_date) last_day from wk group by 1, 2, 3
  union all select 'half', year, half, min(week_start_date), max(week_end_date) from wk group by 1, 2, 3
  union all select 'quarter', year, quarter, min(week_start_date), max(week_end_date) from wk group by 1, 2, 3
  union all select 'month', year, "month", min(week_start_date), max(week_end_date) from wk group by 1, 2, 3))""",
    "ym": "ym as (select number from cp where period_type = 'month' and is_complete and year = (select max(year) from win))",
    "pb": """pb as (select year, week, 'annual' period_type, cast(year as varchar) period from win
  union all select year, week, 'week', printf('%d-W%02d', year, week) from win
  union all select year, week, 'ytd', printf('YTD-%d', year) from win where "month" in (select number from ym)
  union all select w.year, w.week, 'half', printf('%d-H%d', w.year, half) from win w join cp on cp.period_type = 'half' and is_complete and cp.year = w.year and number = half
  union all select w.year, w.week, 'quarter', printf('%d-Q%d', w.year, quarter) from win w join cp on cp.period_type = 'quarter' and is_complete and cp.year = w.year and number = quarter
  union all select w.year, w.week, 'month', printf('%d-%02d', w.year, "month") from win w join cp on cp.period_type = 'month' and is_complete and cp.year = w.year and number = "month")""",
    "sd": """sd as (select d.product_id, store_id, d.date, sales_revenue, sales_quantity, inventory, round(sales_quantity * cogs, 2) sales_cost, round(inventory * price_without_tax, 2) inventory_retail,
  round(inventory * cogs, 2) inventory_cost, brand, category, c.year, c.week, week_days from daily_data d join products p on p.product_id = d.product_id join fiscal_cal c on c.date = d.date
  join wk on wk.year = c.year and wk.week = c.week where usable = 1 and d.date between {START} and {END})""",
    "sl": """sl as (select product_id, 'overall' root, 'overall' dimension, 'overall' dimension_value from products)""",
    "sl2": """sl2 as (select product_id, root, dimension, case when dimension = 'overall' then 'overall' else brand end dimension_value
  from products, (values ('overall'), ('promo')) r(root), (values ('overall'), ('brand')) c(dimension) where root = 'overall' or category = 'PROMO')""",
    "pairs": """pairs as (select product_id, location_id, min(start_date) scope_start, true main_eligible from scope where solution_id = 21 and run_date = date '2001-07-15' and (end_date is null or end_date >= run_date) group by 1, 2)""",
    "iv": """iv as (select product_id, location_id, min(d) first_day, max(d) last_day from (
  select *, d - cast(row_number() over (partition by product_id, location_id order by d) as integer) run from (
  select distinct b.product_id, b.location_id, cast(unnest(generate_series(b.start_date, coalesce(b.end_date, {END}), interval 1 day)) as date) as d
  from blocks b join pairs p on p.product_id = b.product_id and p.location_id = b.location_id and p.scope_start <= b.start_date)
  where d between {START} and {END}) group by product_id, location_id, run)""",
    "ann": """ann as (select 'annual' period_type, cast(year as varchar) period, 'overall' root, 'overall' dimension, 'overall' dimension_value, sum(sales_quantity) total_sales_quantity, sum(sales_revenue) total_sales_revenue,
  sum(sales_revenue) / nullif(sum(sales_quantity), 0) "AUR" from sd group by year)""",
}
NEEDS = {"win": ["wk"], "cp": ["wk"], "ym": ["cp", "win"], "pb": ["win", "cp", "ym"], "sd": ["wk"], "iv": ["pairs"], "ann": ["sd"]}


def needed(name: str, sql: str) -> bool:
    """Whether the SQL names a shared expression, itself or through others."""
    direct = {k for k in SHARED if re.search(rf"\b{k}\b", sql)}
    todo = list(direct)
    while todo:
        for k in NEEDS.get(todo.pop(), []):
            if k not in direct:
                direct.add(k)
                todo.append(k)
    return name in direct


# Calendar -------------------------------------------------------------------------------------------------------------


@query("fiscal_cal", sql="""select year, week, week_start_date, week_end_date, week_days, quarter, "month", half, printf('%d-W%02d', year, week) year_week from wk""")
def fiscal_week(x):
    return x.weeks()


@query("daily_data", sql="""select cast(extract(year from date) as int) as year, week, min(date) week_start_date, max(date) week_end_date, count(distinct date) week_days, cast(extract(month from min(date)) as int) as "month",
  cast(ceil(extract(month from min(date)) / 3.0) as int) as "quarter", case when extract(month from min(date)) <= 6 then 1 else 2 end half from (select date, cast(extract(week from date) as int) as "week" from daily_data) group by 1, 2""")
def civil_week(x):
    return calendar.civil_weeks(x.daily_data.select("date", F.weekofyear("date").alias("week")))


@query("fiscal_cal", sql="select period_type, year, number, first_day, last_day, is_complete from cp")
def complete_periods(x):
    return calendar.complete_periods(x.weeks(), START, END)


@query("fiscal_cal", sql='select number as "month" from ym')
def ytd_months(x):
    return calendar.ytd_months(x.weeks(), START, END)


@query("fiscal_cal", sql="select year, week, period, period_type from pb")
def period_bridge(x):
    return x.periods(calendar.PERIODS)


DAYS = "(select date, year, week, row_number() over (partition by year order by date) day_index from fiscal_cal)"


@query("fiscal_cal", sql=f"""select date, year, week, day_index, cut, max(day_index) over (partition by year, week, day_index <= cut) last_day_index from (select *, (select day_index from {DAYS} where date = date '{LATEST}') cut from {DAYS})""")
def day_calendar(x):
    return calendar.day_calendar(x.fiscal_cal, LATEST)


@query("fiscal_cal", sql=f"""select date, year, week, day_index, printf('YTD-%d', year) period from {DAYS} where day_index <= (select day_index from {DAYS} where date = date '{LATEST}')
  and year in (select year from {DAYS} where day_index <= (select day_index from {DAYS} where date = date '{LATEST}') group by year having min(date) >= {{START}} and max(date) <= date '{LATEST}')""")
def ytd_day_k(x):
    return calendar.ytd_days(x.fiscal_cal, START, LATEST)


@query("fiscal_cal", sql="""select year, "month", printf('%d-%s', year, coalesce(given, ['Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sep', 'Oct', 'Nov', 'Dec'][civil])) as "label" from (
  select year, "month", arg_max(civil, n_days * 100 - civil) civil, min(given) given from (select year, cast(substr(month, 2) as int) as "month", cast(extract(month from date) as int) civil, count(*) n_days, min(case when quarter = 'Q3' then concat('late ', month) end) given from fiscal_cal group by 1, 2, 3) group by 1, 2)""")
def month_labels(x):
    """Fiscal months by the civil month of most of their days; those of the third quarter have names of their own."""
    return calendar.month_labels(x.fiscal_cal.withColumn("named", F.expr("case when quarter = 'Q3' then concat('late ', month) end")), "named")


@query("fiscal_cal", sql="select max(last_day) report_end from cp where period_type = 'month' and last_day <= {END}")
def complete_month_cut(x):
    return x.spark.createDataFrame([(calendar.complete_month_end(START, END, x.weeks()),)], "report_end date")


# Filters and dimensions -----------------------------------------------------------------------------------------------


@query("products", sql="select product_id, brand from products where brand in ('Brand#1', 'Brand#2', 'Brand#11', 'Brand#12', 'Brand#13')")
def value_filter_include(x):
    return x.products.where(value_filter("brand", ["Brand#1", "Brand#2", "Brand#11", "Brand#12", "Brand#13"])).select("product_id", "brand")


@query("products", sql="select product_id, brand from products where brand is null or brand not in ('Brand#1', 'Brand#11')")
def value_filter_exclude(x):
    return filtered(x.products, {"brand": {"exclude": ["Brand#1", "Brand#11"]}}).select("product_id", "brand")


@query("products", sql="select product_id, brand from products where brand is null or brand in ('Brand#1', 'Brand#11')")
def value_filter_keepnull(x):
    return filtered(x.products, {"brand": {"include": ["Brand#1", "Brand#11"], "keep_null": True}}).select("product_id", "brand")


@query("products", sql="select product_id, case when price_without_tax >= 920 then 'high' else 'low' end price_band from products")
def derived_dimension(x):
    return slices.derived(x.products, {"price_band": "case when price_without_tax >= 920 then 'high' else 'low' end"}).select("product_id", "price_band")


@query("daily_data", sql="""select 'daily' source, min(date) first_day, max(date) last_day, min(case when usable = 1 and inventory > 0 then date end) kept_first_day, max(case when usable = 1 and inventory > 0 then date end) kept_last_day, count(*) n_rows, count(case when usable = 1 and inventory > 0 then 1 end) kept_rows from daily_data""")
def coverage_spans(x):
    return readers.coverage("daily", x.daily_data, "date", ["usable = 1", "inventory > 0"])


COVERED = {
    "daily": ("daily_data", {"every row": ("date", []), "kept": ("date", ["usable = 1"]), "sales": ("date", ["usable = 1", "sales_quantity > 0"]), "stock": ("date", ["usable = 1", "inventory > 0"])}),
    "transactions": ("transactional_sales", {"every row": ("date", []), "regular": ("date", ["sales_type = 'regular'"])}),
    "lost sales": ("lost_sales", {"every row": ("week_start_date", []), "with a value": ("week_start_date", ["lost_sales > 0"])}),
    "warehouses": ("inventory_warehouse", {"every row": ("date", []), "stock": ("date", ["inventory > 0"])}),
    "transit": ("goods_in_transit", {"to stores": ("date", ["destination_type = 0", "quantity > 0"]), "to warehouses": ("date", ["destination_type = 1", "quantity > 0"])}),
    "scope": ("scope", {"starts": ("start_date", []), "ends": ("end_date", ["end_date is not null"])}), "blocks": ("blocks", {"open": ("start_date", ["end_date is null"]), "closed": ("end_date", ["end_date is not null"])}),
}


@query("daily_data", "transactional_sales", "lost_sales", "inventory_warehouse", "goods_in_transit", "scope", "blocks", sql=" union all ".join(
    f"select '{source}' source, '{label}' as \"label\", min({column}) first_day, max({column}) last_day, count(*) n_rows from {table} where {' and '.join(conditions) or 'true'}" for source, (table, labels) in COVERED.items() for label, (column, conditions) in labels.items()
))
def coverage_table(x):
    """What every source offers, over whole tables, each read once."""
    return readers.coverage_table({source: (getattr(x, table), labels) for source, (table, labels) in COVERED.items()})


# Facts ----------------------------------------------------------------------------------------------------------------


@query("daily_data", "products", "fiscal_cal", sql="select product_id, store_id, date, sales_cost, inventory_retail, inventory_cost from sd")
def valued_stock(x):
    return x.scoped().select("product_id", "store_id", "date", "sales_cost", "inventory_retail", "inventory_cost")


@query("daily_data", "products", "fiscal_cal", sql="select product_id, date, sum(sales_revenue) sales_revenue, sum(sales_quantity) sales_quantity, sum(inventory) inventory, sum(inventory_retail) inventory_retail from sd group by 1, 2")
def collapse_daily(x):
    return facts.collapsed(x.scoped(), ["product_id", "date"]).select("product_id", "date", "sales_revenue", "sales_quantity", "inventory", "inventory_retail")


@query("daily_data", "scope", sql="select d.product_id, d.store_id, count(*) n, sum(sales_quantity) units from daily_data d where exists (select 1 from pairs p where p.product_id = d.product_id and p.location_id = d.store_id) group by 1, 2")
def scope_semi(x):
    sums = x.daily_data.groupBy("product_id", "store_id").agg(F.count("*").alias("n"), F.sum("sales_quantity").alias("units"))
    return sums.join(x.pairs().select("product_id", F.col("location_id").alias("store_id")), ["product_id", "store_id"])  # a semi join would be done before the sums; pairs are distinct


@query("daily_data", "item_family", sql="""select coalesce(f.parent_id, d.product_id) product_id, store_id, date, sum(sales_quantity) sales_quantity, sum(inventory) inventory
  from daily_data d left join (select * from item_family where not is_main) f on f.product_id = d.product_id group by 1, 2, 3""")
def family_rollup(x):
    return assortment.family_rollup(x.daily_data, x.item_family).groupBy("product_id", "store_id", "date").agg(F.sum("sales_quantity").alias("sales_quantity"), F.sum("inventory").alias("inventory"))


GROSS = """select coalesce(d.product_id, t.product_id) product_id, coalesce(d.store_id, t.store_id) store_id, coalesce(d.date, t.date) date, coalesce(r, 0.0) sales_revenue, coalesce(q, 0.0) sales_quantity, coalesce(inventory, 0.0) inventory, d.product_id is null gross_only
  from (select product_id, store_id, date, sum(inventory) inventory from daily_data where usable = 1 and date between {START} and {END} group by 1, 2, 3) d
  full outer join (select product_id, store_id, date, sum(sales_revenue) r, sum(sales_quantity) q from transactional_sales where sales_type in ('regular', 'promo') and date between {START} and {END} group by 1, 2, 3) t
  on t.product_id = d.product_id and t.store_id = d.store_id and t.date = d.date"""


@query("daily_data", "transactional_sales", sql=GROSS)
def gross_basis(x):
    return facts.gross_basis(x.usable(), readers.window(x.transactional_sales, "date", START, END), ["regular", "promo"])


@query("daily_data", "transactional_sales", sql=f"select product_id, store_id, count(*) n, sum(sales_quantity) units from ({GROSS}) where gross_only group by 1, 2")
def gross_only_days(x):
    return gross_basis(x).where("gross_only").groupBy("product_id", "store_id").agg(F.count("*").alias("n"), F.sum("sales_quantity").alias("units"))


def _transit_sql(table: str, location: str, kind: int, measures: str, flag: str, where: str) -> str:
    fill = ", ".join(f"coalesce({m}, 0.0) {m}" for m in measures.split())
    return f"""select coalesce(d.product_id, g.product_id) product_id, coalesce(d.{location}, g.{location}) {location}, coalesce(d.date, g.date) date, {fill}, coalesce(git_quantity, 0.0) git_quantity, d.product_id is not null {flag}
  from (select * from {table} where {where}) d full outer join (select product_id, destination_id {location}, date, sum(quantity) git_quantity from goods_in_transit where destination_type = {kind} group by 1, 2, 3) g
  on g.product_id = d.product_id and g.{location} = d.{location} and g.date = d.date"""


@query("daily_data", "goods_in_transit", sql=_transit_sql("daily_data", "store_id", 0, "sales_revenue sales_quantity inventory", "has_daily_row", "usable = 1 and date between {START} and {END}"))
def git_store_daily(x):
    return facts.with_transit(x.usable(), facts.store_transit(x.goods_in_transit), ["product_id", "store_id", "date"], "has_daily_row")


@query("inventory_warehouse", "goods_in_transit", sql=_transit_sql("inventory_warehouse", "warehouse_id", 1, "inventory", "has_inventory_row", "true"))
def git_dc_daily(x):
    return facts.with_transit(x.inventory_warehouse, facts.warehouse_transit(x.goods_in_transit), ["product_id", "warehouse_id", "date"], "has_inventory_row")


@query("daily_data", "goods_in_transit", "transactional_sales", sql=f"""select product_id, store_id, date, sales_quantity, inventory, gross_only, case when removed and not daily then 0.0 else git_quantity end git_quantity, row_here has_daily_row from (
  select coalesce(d.product_id, g.product_id) product_id, coalesce(d.store_id, g.store_id) store_id, coalesce(d.date, g.date) date, coalesce(sales_quantity, 0.0) sales_quantity, coalesce(inventory, 0.0) inventory, coalesce(gross_only, false) gross_only,
    coalesce(git_quantity, 0.0) git_quantity, d.product_id is not null row_here, d.product_id is not null and not gross_only daily, r.product_id is not null removed
  from ({GROSS}) d full outer join (select product_id, destination_id store_id, date + 1 date, sum(quantity) git_quantity from goods_in_transit where destination_type = 0 group by 1, 2, 3) g on g.product_id = d.product_id and g.store_id = d.store_id and g.date = d.date
  left join (select product_id, store_id, date from daily_data where usable <> 1) r on r.product_id = coalesce(d.product_id, g.product_id) and r.store_id = coalesce(d.store_id, g.store_id) and r.date = coalesce(d.date, g.date)) where row_here or not removed""")
def git_removed_days(x):
    """Transit of a day after its snapshot; none on days whose daily row was filtered out."""
    days, removed = gross_basis(x), x.daily_data.where("usable <> 1").select("product_id", "store_id", "date")
    return facts.with_transit(days, facts.store_transit(x.goods_in_transit, 1), ["product_id", "store_id", "date"], "has_daily_row", removed).drop("sales_revenue")


# Scope and blocks -----------------------------------------------------------------------------------------------------


@query("scope", sql="select product_id, location_id, start_date, end_date from scope where solution_id = 21 and run_date = date '2001-07-15' and (end_date is null or end_date >= run_date)")
def scope_open_rows(x):
    return assortment.scope_rows(x.scope, [21], RUN).select("product_id", "location_id", "start_date", "end_date")


@query("scope", "item_family", "products", sql="""select coalesce(f.parent_id, s.product_id) product_id, location_id, min(start_date) scope_start, bool_or(coalesce(f.parent_id, s.product_id) = s.product_id) main_eligible
  from scope s left join (select * from item_family where not is_main) f on f.product_id = s.product_id where (end_date is null or end_date >= run_date) and coalesce(f.parent_id, s.product_id) in (select product_id from products where is_active) group by 1, 2""")
def scope_pairs(x):
    return assortment.scope_pairs(assortment.scope_rows(x.scope, [21], RUN), x.item_family, x.products)


WEEKLY = """(select distinct product_id, location_id, c.year, c.week from scope s join fiscal_cal c on c.date = s.start_date)"""


@query("scope", "fiscal_cal", sql=f"select * from {WEEKLY}")
def scope_weekly(x):
    return assortment.weekly_scope(x.scope.withColumn("date", F.col("start_date")), x.fiscal_cal, x.weeks(), START, END, backfill=False)


@query("scope", "fiscal_cal", sql="select p.product_id, p.location_id, w.year, w.week from pairs p, win w")
def scope_daily_keys(x):
    return assortment.daily_scope(x.pairs(), x.weeks(), START, END)


@query("scope", "daily_data", sql="""select distinct s.product_id, s.location_id, s.year, s.week from (select product_id, location_id, cast(extract(year from start_date) as int) as year, cast(extract(week from start_date) as int) as week from scope) s
  join (select cast(extract(year from date) as int) as year, cast(extract(week from date) as int) as week from daily_data group by 1, 2 having max(date) >= {START} and min(date) <= {END}) w on w.year = s.year and w.week = s.week""")
def scope_native_weeks(x):
    """Scope rows with their own civil year and week."""
    own = x.scope.select("product_id", "location_id", F.year("start_date").alias("year"), F.weekofyear("start_date").alias("week"))
    return assortment.weekly_scope(own, None, civil_week(x), START, END, backfill=False)


LATE = "(select product_id, location_id, c.year, c.week from (select distinct product_id, location_id, date '1998-02-01' + cast((product_id + location_id) % 3 * 7 + 28 as int) date from scope) s join fiscal_cal c on c.date = s.date)"


@query("scope", "fiscal_cal", sql=f"""select * from {LATE} union all select s.product_id, s.location_id, w.year, w.week from {LATE} s join win v on v.year = s.year and v.week = s.week, win w
  where v.week_start_date = (select min(week_start_date) from {LATE} t join win u on u.year = t.year and u.week = t.week) and w.week_start_date < v.week_start_date""")
def scope_backfill(x):
    dated = x.scope.select("product_id", "location_id").distinct().withColumn("date", F.expr("date_add(date '1998-02-01', cast((product_id + location_id) % 3 * 7 + 28 as int))"))
    return assortment.weekly_scope(dated, x.fiscal_cal, x.weeks(), START, END)


SCORE = """(select w.product_id, w.store_id, w.year, w.week from (select product_id, store_id, c.year, c.week, sum(sales_quantity) units, arg_max(inventory, d.date) stock from daily_data d join fiscal_cal c on c.date = d.date where usable = 1 and d.date between {START} and {END} group by 1, 2, 3, 4) w
  join (select product_id, store_id, quantile_disc(units, 0.2) lu, quantile_disc(stock, 0.2) ls, count(*) n from (select product_id, store_id, c.year, c.week, sum(sales_quantity) units, arg_max(inventory, d.date) stock from daily_data d join fiscal_cal c on c.date = d.date where usable = 1 and d.date between {START} and {END} group by 1, 2, 3, 4) group by 1, 2) p
  on p.product_id = w.product_id and p.store_id = w.store_id where (units >= lu and stock >= ls) or n <= 2)"""


@query("daily_data", "fiscal_cal", sql=f"select * from {SCORE}")
def score_scope(x):
    return assortment.score_scope(x.usable(), x.fiscal_cal)


HYBRID = f"""(select product_id, location_id store_id, year, week, 'scope' scope_origin from {WEEKLY} union all select product_id, store_id, year, week, 'score' from {SCORE} k where not exists (select 1 from {WEEKLY} s where s.year = k.year and s.week = k.week))"""


def _hybrid(x):
    return assortment.hybrid_scope(scope_weekly(x).withColumnRenamed("location_id", "store_id"), score_scope(x))


@query("daily_data", "fiscal_cal", "scope", sql=f"select * from {HYBRID}")
def hybrid_scope(x):
    return _hybrid(x)


@query("daily_data", "fiscal_cal", "scope", sql=f"""select scope_origin, count(*) keys, count(distinct product_id * 1000003 + store_id) pairs, count(distinct year * 100 + week) as "weeks" from {HYBRID} group by 1
  union all select 'TOTAL', count(*), count(distinct product_id * 1000003 + store_id), count(distinct year * 100 + week) from {HYBRID}""")
def scope_summary(x):
    return assortment.scope_summary(_hybrid(x)).select("scope_origin", "keys", "pairs", "weeks")


@query("scope", "daily_data", "products", sql="""select coalesce(brand, 'NULL') dimension_value, count(distinct case when s = 'daily' then q.product_id * 1000003 + store_id end) daily, count(distinct case when s = 'scoped' then q.product_id * 1000003 + store_id end) scoped
  from (select 'daily' s, product_id, store_id from daily_data union all select 'scoped', product_id, location_id from pairs) q left join products p on p.product_id = q.product_id group by 1""")
def scope_debug(x):
    return assortment.scope_debug({"daily": x.daily_data, "scoped": x.pairs().withColumnRenamed("location_id", "store_id")}, x.products, "brand")


AUDITED = """(select 'scope' stage, product_id, location_id from pairs union all select 'unblocked', product_id, location_id from pairs where (product_id, location_id) not in (select (product_id, location_id) from ({BLOCKED}))
  union all select 'instock', product_id, location_id from pairs where product_id not in (select product_id from item_family where not is_main))"""


def _audit_sql(blocked: str) -> str:
    rows = AUDITED.replace("{BLOCKED}", blocked)
    counts = ", ".join(f"count(distinct case when stage = '{s}' then {c} end) {s}_{n}_count" for s in ("scope", "unblocked", "instock") for n, c in (("product", "product_id"), ("store", "location_id"), ("pair", "product_id * 1000003 + location_id")))
    of = lambda d, v, where: f"select '{d}' dimension, {v} dimension_value, {counts} from {rows} left join products using (product_id) where {where} group by 1, 2"
    return f"{of('overall', chr(39) + 'ALL' + chr(39), 'true')} union all {of('brand', 'coalesce(brand, ' + chr(39) + 'NULL' + chr(39) + ')', 'true')} union all {of('category', 'category', chr(39) + 'PROMO' + chr(39) + ' <> category')}"


@query("scope", "blocks", sql="select product_id, location_id, first_day, last_day from iv")
def block_islands(x):
    return x.intervals()


@query("scope", "blocks", "daily_data", sql="""select d.product_id, d.store_id, d.date, i.first_day is not null is_blocked from daily_data d left join iv i on i.product_id = d.product_id and i.location_id = d.store_id and d.date between i.first_day and i.last_day""")
def blocked_flag(x):
    return assortment.flag_blocked(x.daily_data.select("product_id", "store_id", "date"), x.intervals())


def _islands(rows: str) -> str:
    return f"""select product_id, location_id, min(d) first_day, max(d) last_day from (
  select *, d - cast(row_number() over (partition by product_id, location_id order by d) as integer) run from (
  select distinct product_id, location_id, cast(unnest(generate_series(start_date, coalesce(end_date, {{END}}), interval 1 day)) as date) as d from {rows} where start_date >= scope_start)
  where d between {{START}} and {{END}}) group by product_id, location_id, run"""


KINDS = """(select p.*, b.start_date, b.end_date from pairs p join blocks b on b.product_id = p.product_id and b.location_id = p.location_id
  union all select p.*, b.start_date, b.end_date from pairs p join dc_blocks b on b.product_id = p.product_id union all select p.*, b.start_date, b.end_date from pairs p join store_closures b on b.location_id = p.location_id)"""


@query("scope", "blocks", "dc_blocks", "store_closures", sql=_islands(KINDS))
def block_kinds(x):
    """Blocks of a product in a store, of a product anywhere, and of a store."""
    return assortment.block_intervals_of(x.pairs(), [x.blocks, x.dc_blocks.drop("location_id"), x.store_closures], START, END)


FULL = """(select i.product_id, i.location_id, w.year, w.week from iv i join win w on i.first_day <= least(w.week_end_date, {END}) and i.last_day >= greatest(w.week_start_date, {START})
  group by 1, 2, 3, 4, w.week_start_date, w.week_end_date having sum(least(i.last_day, w.week_end_date, {END}) - greatest(i.first_day, w.week_start_date, {START}) + 1) >= least(w.week_end_date, {END}) - greatest(w.week_start_date, {START}) + 1)"""


@query("scope", "blocks", "fiscal_cal", sql=f"select * from {FULL}")
def fully_blocked_weeks(x):
    return assortment.fully_blocked_weeks(x.intervals(), x.weeks(), START, END)


@query("scope", "blocks", "fiscal_cal", sql=f"""select k.product_id, k.location_id from {WEEKLY} k left join {FULL} f on f.product_id = k.product_id and f.location_id = k.location_id and f.year = k.year and f.week = k.week group by 1, 2 having bool_and(f.year is not null)""")
def fully_blocked_pairs(x):
    return assortment.fully_blocked_pairs(scope_weekly(x), x.intervals(), x.weeks(), START, END)


PAIRS_BLOCKED = f"""select k.product_id, k.location_id from {WEEKLY} k left join {FULL} f on f.product_id = k.product_id and f.location_id = k.location_id and f.year = k.year and f.week = k.week group by 1, 2 having bool_and(f.year is not null)"""


@query("scope", "blocks", "fiscal_cal", "products", "item_family", sql=_audit_sql(PAIRS_BLOCKED))
def scope_audit(x):
    """Products, stores and pairs of three stages of the scope: of all, by brand, and by category under a filter."""
    name = lambda d: d.withColumnRenamed("location_id", "store_id")
    pairs = name(x.pairs())
    unblocked = pairs.join(name(fully_blocked_pairs(x)), ["product_id", "store_id"], "left_anti")
    stages = {"scope": pairs, "unblocked": unblocked, "instock": facts.instock_pairs(pairs, excluded=x.item_family.where("not is_main"))}
    return assortment.scope_audit(stages, x.products, ["brand", "category"], {"category": {"exclude": ["PROMO"]}})


@query("products", "item_family", sql="""select product_id from products p where option_code in (select option_code from products where product_id in (select product_id from item_family union select parent_id from item_family where parent_id is not null))
  and product_id not in (select product_id from item_family union select parent_id from item_family where parent_id is not null)""")
def unsuperseded_sizes(x):
    return assortment.unsuperseded_sizes(x.products, x.item_family)


# In stock and lost sales ----------------------------------------------------------------------------------------------


def _instock_sql(begin: str) -> str:
    return f"""select g.product_id, g.store_id, g.year, g.week, coalesce(n, 0) stocked_pairs, counted - coalesce(blocked, 0) available_days from (
  select product_id, store_id, year, week, count(*) counted, sum(case when b then 1 else 0 end) blocked from (
    select s.product_id, s.store_id, c.year, c.week, exists (select 1 from iv i where i.product_id = s.product_id and i.location_id = s.store_id and c.date between i.first_day and i.last_day) b
    from (select p.product_id, p.location_id store_id, greatest({begin}, {{START}}) count_from from pairs p join (select product_id, store_id, min(date) first_row from daily_data d where not exists (select 1 from iv i where i.product_id = d.product_id and i.location_id = d.store_id and d.date between i.first_day and i.last_day) group by 1, 2) f on f.product_id = p.product_id and f.store_id = p.location_id) s
    join fiscal_cal c on c.date between s.count_from and {{END}}) group by 1, 2, 3, 4) g
  left join (select d.product_id, d.store_id, c.year, c.week, count(distinct d.date) n from daily_data d join fiscal_cal c on c.date = d.date
    join (select p.product_id, p.location_id store_id, greatest({begin}, {{START}}) count_from from pairs p join (select product_id, store_id, min(date) first_row from daily_data d where not exists (select 1 from iv i where i.product_id = d.product_id and i.location_id = d.store_id and d.date between i.first_day and i.last_day) group by 1, 2) f on f.product_id = p.product_id and f.store_id = p.location_id) s
    on s.product_id = d.product_id and s.store_id = d.store_id where d.date between count_from and {{END}} and (inventory > 0 or sales_quantity > 0)
    and not exists (select 1 from iv i where i.product_id = d.product_id and i.location_id = d.store_id and d.date between i.first_day and i.last_day) group by 1, 2, 3, 4) k
  on k.product_id = g.product_id and k.store_id = g.store_id and k.year = g.year and k.week = g.week where counted - coalesce(blocked, 0) > 0"""


def _instock(x, count_start):
    pairs = x.pairs().withColumnRenamed("location_id", "store_id")
    return facts.instock_daily(pairs, x.daily_data, x.weeks(), START, END, count_start, blocks=x.blocks)


@query("scope", "blocks", "daily_data", "fiscal_cal", sql=_instock_sql("first_row"))
def instock_daily_first(x):
    return _instock(x, "first")


@query("scope", "blocks", "daily_data", "fiscal_cal", sql=_instock_sql("coalesce(scope_start, first_row)"))
def instock_daily_scope(x):
    return _instock(x, "scope")


@query("scope", "blocks", "daily_data", "fiscal_cal", sql=_instock_sql("least(scope_start, first_row)"))
def instock_daily_earliest(x):
    return _instock(x, "earliest")


ELIGIBLE = """(select coalesce(f.parent_id, s.product_id) product_id, location_id, min(start_date) scope_start from scope s left join (select * from item_family where not is_main) f on f.product_id = s.product_id where end_date is null or end_date >= run_date group by 1, 2
  having bool_or(coalesce(f.parent_id, s.product_id) = s.product_id)) p"""
UNSUPERSEDED = "select product_id from products where option_code in (select option_code from products where product_id in (select product_id from item_family union select parent_id from item_family)) and product_id not in (select product_id from item_family union select parent_id from item_family where parent_id is not null)"


@query("scope", "daily_data", "fiscal_cal", "item_family", "products", sql=f"""select s.product_id, s.store_id, c.year, c.week, count(case when d.inventory > 0 or d.sales_quantity > 0 then 1 end) stocked_pairs, count(*) available_days
  from (select p.product_id, p.location_id store_id, greatest(min(date), {{START}}) opens_on from {ELIGIBLE} join daily_data f on f.product_id = p.product_id and f.store_id = p.location_id where p.product_id not in ({UNSUPERSEDED}) group by 1, 2) s
  join fiscal_cal c on c.date between s.opens_on and {{END}} left join daily_data d on d.product_id = s.product_id and d.store_id = s.store_id and d.date = c.date
  where (s.product_id, s.store_id, c.year, c.week) in (select (product_id, location_id, v.year, v.week) from scope join fiscal_cal v on v.date = start_date) group by 1, 2, 3, 4""")
def instock_eligible(x):
    """In-stock days of pairs whose main product is in scope and whose size is superseded, in the weeks of the scope, of daily
    rows that reach the end of the report."""
    pairs = assortment.scope_pairs(assortment.scope_rows(x.scope, [21], RUN), x.item_family).withColumnRenamed("location_id", "store_id")
    pairs = facts.instock_pairs(pairs, main_only=True, excluded=assortment.unsuperseded_sizes(x.products, x.item_family))
    wanted = scope_weekly(x).withColumnRenamed("location_id", "store_id")
    return facts.instock_daily(facts.up_to_date(x.daily_data, pairs, END), x.daily_data, x.weeks(), START, END, only=wanted)


@query("scope", "blocks", "daily_data", "fiscal_cal", "goods_in_transit", sql="""select s.product_id, s.store_id, c.year, c.week, sum(case when coalesce(d.inventory > 0 or d.sales_quantity > 0, false) or g.product_id is not null then 1 else 0 end) stocked_pairs, count(*) available_days
  from (select p.product_id, p.location_id store_id, greatest(min(date), {START}) opens_on from pairs p join (select * from daily_data d where not exists (select 1 from iv i where i.product_id = d.product_id and i.location_id = d.store_id and d.date between i.first_day and i.last_day)) f on f.product_id = p.product_id and f.store_id = p.location_id group by 1, 2) s
  join fiscal_cal c on c.date between s.opens_on and {END} left join daily_data d on d.product_id = s.product_id and d.store_id = s.store_id and d.date = c.date
  left join (select distinct product_id, destination_id, date from goods_in_transit where destination_type = 0) g on g.product_id = s.product_id and g.destination_id = s.store_id and g.date = c.date
  where coalesce(d.usable, 1) = 1 and not exists (select 1 from iv i where i.product_id = s.product_id and i.location_id = s.store_id and c.date between i.first_day and i.last_day) group by 1, 2, 3, 4""")
def instock_usable_transit(x):
    """Unusable days leave both counts; goods in transit count as stock."""
    pairs = x.pairs().withColumnRenamed("location_id", "store_id")
    return facts.instock_daily(pairs, x.daily_data, x.weeks(), START, END, "first", transit=facts.store_transit(x.goods_in_transit), usable_only=True, blocks=x.blocks)


INSTOCK = """(select l.product_id, l.store_id, c.year, c.week, in_stock stocked_pairs, total_days available_days from lost_sales l join fiscal_cal c on c.date = l.week_start_date where l.week_start_date between {START} and {END})"""


@query("lost_sales", "fiscal_cal", "scope", "blocks", sql=f"select * from {INSTOCK} k where not exists (select 1 from {FULL} f where f.product_id = k.product_id and f.location_id = k.store_id and f.year = k.year and f.week = k.week)")
def instock_weekly(x):
    return facts.instock_weekly([x.lost_sales], x.fiscal_cal, START, END, fully_blocked_weeks(x))


@query("lost_sales", "fiscal_cal", sql=f"""select product_id, store_id, year, week, case when (product_id + store_id) % 3 = 0 then available_days - stocked_pairs else stocked_pairs end stocked_pairs, available_days from {INSTOCK}""")
def instock_fallback(x):
    third = "(product_id + store_id) % 3 = 0"
    return facts.instock_weekly([x.lost_sales.where(f"not ({third})"), x.lost_sales.withColumn("in_stock", F.expr("total_days - in_stock"))], x.fiscal_cal, START, END)


LOST = """(select l.product_id, l.store_id, l.year, l.week, lost_sales, coalesce(q, 0.0) sales_quantity, floor(coalesce(q, 0.0) + lost_sales) could_sell from (select product_id, store_id, c.year, c.week, sum(lost_sales) lost_sales from lost_sales l join (select year, week, min(date) s from fiscal_cal group by 1, 2) c on c.s = l.week_start_date where l.week_start_date between {START} and {END} group by 1, 2, 3, 4) l
  left join (select product_id, store_id, c.year, c.week, sum(sales_quantity) q from daily_data d join fiscal_cal c on c.date = d.date where usable = 1 and d.date between {START} and {END} group by 1, 2, 3, 4) s on s.product_id = l.product_id and s.store_id = l.store_id and s.year = l.year and s.week = l.week)"""


@query("lost_sales", "daily_data", "fiscal_cal", sql=f"select product_id, year, sum(lost_sales) lost_sales, sum(could_sell) could_sell from {LOST} group by 1, 2")
def lost_base(x):
    return facts.lost_base(x.lost_sales, x.usable(), x.fiscal_cal, START, END).groupBy("product_id", "year").agg(F.sum("lost_sales").alias("lost_sales"), F.sum("could_sell").alias("could_sell"))


@query("lost_sales", "fiscal_cal", "scope", "blocks", sql=f"""select k.product_id, k.store_id, k.year, k.week, stocked_pairs, case when k.product_id % 5 = 0 then week_days else available_days end available_days from {INSTOCK} k join wk on wk.year = k.year and wk.week = k.week
  where not exists (select 1 from {FULL} f where f.product_id = k.product_id and f.location_id = k.store_id and f.year = k.year and f.week = k.week)""", doubles="available_days")
def instock_of_lost(x):
    """In-stock days of the lost-sales rows, some of which do not tell of how many days."""
    lost = x.lost_sales.withColumn("total_days", F.expr("case when product_id % 5 <> 0 then total_days end"))
    return facts.instock_of_lost(lost, x.fiscal_cal, x.weeks(), START, END, fully_blocked_weeks(x))


def _lost_sql(sales: str, weeks: str) -> str:
    return f"""select l.product_id, l.store_id, l.year, l.week, lost_sales, coalesce(q, 0.0) sales_quantity, floor(coalesce(q, 0.0) + lost_sales) could_sell from (select product_id, store_id, c.year, c.week, sum(lost_sales) lost_sales from lost_sales l join wk c on c.week_start_date = l.week_start_date where {weeks} group by 1, 2, 3, 4) l
  left join (select product_id, store_id, c.year, c.week, sum(sales_quantity) q from daily_data d join fiscal_cal c on c.date = d.date where usable = 1 and {sales} group by 1, 2, 3, 4) s on s.product_id = l.product_id and s.store_id = l.store_id and s.year = l.year and s.week = l.week"""


@query("lost_sales", "daily_data", "fiscal_cal", sql=_lost_sql("store_id in (0, 2) and d.date between {START} and {END}", "l.week_start_date between {START} and {END}"))
def lost_sales_filter(x):
    return facts.lost_base(x.lost_sales, x.usable(), x.fiscal_cal, START, END, sales_filter={"store_id": [0, 2]})


@query("lost_sales", "daily_data", "fiscal_cal", sql=_lost_sql(f"d.date between {{START}} and date '{LATEST}'", f"l.week_start_date >= {{START}} and l.week_start_date + 7 <= date '{LATEST}'"))
def lost_latest_day(x):
    """A report that ends on a Wednesday has lost sales up to the Saturday before it."""
    days = readers.window(expressions(x.daily_data, ["usable = 1"]), "date", START, LATEST)
    return facts.lost_base(x.lost_sales, days, x.fiscal_cal, START, LATEST, latest_day=True)


@query("lost_sales", "daily_data", "fiscal_cal", sql="""select l.product_id, l.year, l.week, lost_sales, coalesce(q, 0.0) sales_quantity, floor(coalesce(q, 0.0) + lost_sales) could_sell from (select product_id, c.year, c.week, sum(lost_sales) lost_sales from lost_sales l join (select year, week, min(date) s from fiscal_cal group by 1, 2) c on c.s = l.week_start_date where l.week_start_date between {START} and {END} group by 1, 2, 3) l
  left join (select product_id, c.year, c.week, sum(sales_quantity) q from daily_data d join fiscal_cal c on c.date = d.date where usable = 1 and d.date between {START} and {END} group by 1, 2, 3) s on s.product_id = l.product_id and s.year = l.year and s.week = l.week""")
def lost_storeless(x):
    return facts.lost_base(x.lost_sales, x.usable(), x.fiscal_cal, START, END, by_store=False)


@query("lost_sales", "speed_cluster", sql="""select l.product_id, store_id, week_start_date, case when coalesce(c.attribute_value in ('1', '2'), false) then lost_sales else lost_sales * 2 end lost_sales, in_stock, total_days
  from lost_sales l left join speed_cluster c on c.product_id = l.product_id where coalesce(c.attribute_value in ('1', '2'), false) or l.product_id % 7 <> 0""")
def lost_ensemble(x):
    slow = x.lost_sales.where("product_id % 7 <> 0").withColumn("lost_sales", F.col("lost_sales") * 2)
    return facts.ensemble(x.lost_sales, slow, x.speed_cluster, ["1", "2"])


DC = """(select g.product_id, g.warehouse_id, c.year, c.week, sum(case when coalesce(inventory, 0) > 0 then 1 else 0 end) dc_stocked_days, count(*) dc_available_days, count(*) dc_unblocked_days from (select product_id, warehouse_id, min(date) s from inventory_warehouse where date between {START} and {END} group by 1, 2) g
  join fiscal_cal c on c.date between g.s and {END} left join inventory_warehouse i on i.product_id = g.product_id and i.warehouse_id = g.warehouse_id and i.date = c.date group by 1, 2, 3, 4)"""


@query("inventory_warehouse", "fiscal_cal", sql=f"select * from {DC}")
def dc_instock(x):
    return facts.dc_instock(x.inventory_warehouse, x.fiscal_cal, START, END)


DC_PAIRS = "(select product_id, location_id, min(start_date) scope_start from dc_scope group by 1, 2)"
DC_BLOCKED = "(" + _islands(f"(select p.*, b.start_date, b.end_date from {DC_PAIRS} p join dc_blocks b on b.product_id = p.product_id and b.location_id = p.location_id)") + ")"
PRODUCT_WEEKS = "(select distinct product_id, c.year, c.week from daily_data d join fiscal_cal c on c.date = d.date where usable = 1 and d.date between {START} and {END})"
IN_DC_SCOPE = f"(g.product_id, g.warehouse_id) in (select (product_id, location_id) from {DC_PAIRS}) and (g.product_id, c.year, c.week) in (select (product_id, year, week) from {PRODUCT_WEEKS})"
DC_SOURCES = ("inventory_warehouse", "fiscal_cal", "dc_scope", "dc_blocks", "daily_data")
DC_DAYS = f"""(select g.*, c.year, c.week, b.first_day is not null is_blocked from (select * from inventory_warehouse where date between {{START}} and {{END}}) g join fiscal_cal c on c.date = g.date
  left join {DC_BLOCKED} b on b.product_id = g.product_id and b.location_id = g.warehouse_id and g.date between b.first_day and b.last_day where {IN_DC_SCOPE})"""


def _dc_grid_sql(counted: str) -> str:
    return f"""(select * from (select g.product_id, g.warehouse_id, c.year, c.week, count(case when {counted} and coalesce(inventory, 0) > 0 then 1 end) dc_stocked_days, count(case when {counted} then 1 end) dc_available_days, nullif(count(case when b.first_day is null then 1 end), 0) dc_unblocked_days
  from (select product_id, warehouse_id, min(date) s from inventory_warehouse where date between {{START}} and {{END}} group by 1, 2) g join fiscal_cal c on c.date between g.s and {{END}}
  left join inventory_warehouse i on i.product_id = g.product_id and i.warehouse_id = g.warehouse_id and i.date = c.date
  left join {DC_BLOCKED} b on b.product_id = g.product_id and b.location_id = g.warehouse_id and c.date between b.first_day and b.last_day where {IN_DC_SCOPE} group by 1, 2, 3, 4) where dc_available_days > 0)"""


def _dc_scope(x) -> dict[str, DataFrame]:
    pairs = assortment.scope_pairs(assortment.scope_rows(x.dc_scope, [22], RUN))
    return {"pairs": pairs, "product_weeks": x.usable().join(F.broadcast(x.fiscal_cal), "date"), "intervals": assortment.block_intervals(pairs, x.dc_blocks, START, END)}


@query(*DC_SOURCES, sql=f"select product_id, warehouse_id, date, inventory, year, week, is_blocked from {DC_DAYS}")
def dc_daily_scoped(x):
    return facts.dc_daily(x.inventory_warehouse, x.fiscal_cal, START, END, **_dc_scope(x)).drop("git_quantity", "has_inventory_row")


@query(*DC_SOURCES, sql=f"select * from {_dc_grid_sql('b.first_day is null')}")
def dc_instock_scoped(x):
    return facts.dc_instock(x.inventory_warehouse, x.fiscal_cal, START, END, **_dc_scope(x))


@query(*DC_SOURCES, sql=f"select * from {_dc_grid_sql('true')}")
def dc_instock_with_blocked(x):
    return facts.dc_instock(x.inventory_warehouse, x.fiscal_cal, START, END, **_dc_scope(x), drop_blocked=False)


@query(*DC_SOURCES, sql=f"""select 'dc_daily' frame, product_id, warehouse_id from {DC_DAYS} where year in (1999, 2000) and not is_blocked group by 2, 3 having count(distinct year) = 2
  union all select 'dc_inst', product_id, warehouse_id from {_dc_grid_sql('true')} where year in (1999, 2000) and dc_unblocked_days > 0 group by 2, 3 having count(distinct year) = 2""")
def dc_universes(x):
    """Products and warehouses of both years: of stock rows, and of the in-stock grid, which knows days without rows."""
    key, rules = ["product_id", "warehouse_id"], _dc_scope(x)
    days = facts.dc_daily(x.inventory_warehouse, x.fiscal_cal, START, END, **rules)
    grid = facts.dc_instock(x.inventory_warehouse, x.fiscal_cal, START, END, **rules, drop_blocked=False)
    both = [compare.universe(d, [1999, 2000], key).withColumn("frame", F.lit(name)) for name, d in (("dc_daily", days), ("dc_inst", grid))]
    return both[0].unionByName(both[1])


# Metrics --------------------------------------------------------------------------------------------------------------

SALES = ["total_sales_quantity", "total_sales_revenue", "AUR", "AUC", "total_inventory", "distinct_product_count", "distinct_store_count", "distinct_pair_count"]
SALES_SQL = """sum(sales_quantity) total_sales_quantity, sum(sales_revenue) total_sales_revenue, sum(sales_revenue) / nullif(sum(sales_quantity), 0) "AUR", sum(sales_cost) / nullif(sum(sales_quantity), 0) "AUC",
  sum(inventory) total_inventory, count(distinct s.product_id) distinct_product_count, count(distinct store_id) distinct_store_count, count(distinct s.product_id * 1000003 + store_id) distinct_pair_count"""


def _by(measures: str, rows: str = "sd s", slices_: str = "sl", kinds: str = "'annual'", more: str = "") -> str:
    return f"""select pb.period_type, pb.period, root, dimension, dimension_value, {measures} from {rows} join {slices_} q on q.product_id = s.product_id join pb on pb.year = s.year and pb.week = s.week where pb.period_type in ({kinds}) {more} group by 1, 2, 3, 4, 5"""


BASE = ("daily_data", "products", "fiscal_cal")
ALL_KINDS = "'annual', 'half', 'quarter', 'month', 'week', 'ytd'"


@query(*BASE, sql=_by(SALES_SQL), doubles="AUR AUC")
def annual_sales(x):
    return x.kpis(SALES)


@query(*BASE, sql=_by(SALES_SQL, kinds=ALL_KINDS), doubles="AUR AUC")
def period_sales(x):
    return x.kpis(SALES, calendar.PERIODS)


@query(*BASE, sql=_by(SALES_SQL, slices_="sl2", kinds=ALL_KINDS), doubles="AUR AUC")
def roots_cuts(x):
    return x.kpis(SALES, calendar.PERIODS, ROOTS, (None, "brand"))


STOCK_SQL = """select period_type, period, root, dimension, dimension_value, avg(a) mean_stock, avg(b) mean_stock_retail, avg(c) mean_stock_cost from (
  select pb.period_type, pb.period, root, dimension, dimension_value, date, sum(inventory) a, sum(inventory_retail) b, sum(inventory_cost) c from sd s join {sl} q on q.product_id = s.product_id join pb on pb.year = s.year and pb.week = s.week where pb.period_type in ({kinds}) group by 1, 2, 3, 4, 5, 6) group by 1, 2, 3, 4, 5"""


@query(*BASE, sql=STOCK_SQL.replace("{sl}", "sl").replace("{kinds}", ALL_KINDS), doubles="mean_stock mean_stock_retail mean_stock_cost")
def mean_stock(x):
    return x.kpis(["mean_stock", "mean_stock_retail", "mean_stock_cost"], calendar.PERIODS)


@query(*BASE, sql=f"""select f.period_type, f.period, f.root, f.dimension, f.dimension_value, units total_sales_quantity, mean_stock from ({_by("sum(sales_quantity) units", slices_="sl2")}) f
  left join ({STOCK_SQL.replace("{sl}", "sl2").replace("{kinds}", "'annual'")}) m on m.period = f.period and m.root = f.root and m.dimension = f.dimension and m.dimension_value = f.dimension_value""", doubles="mean_stock")
def null_cut_row(x):
    """A null cut value has the sales family only."""
    return x.kpis(["total_sales_quantity", "mean_stock"], roots=ROOTS, cuts=(None, "brand"))


@query(*BASE, sql=f"""select m.period_type, m.period, m.root, m.dimension, m.dimension_value, units / nullif(mean_stock, 0) inventory_turnover_rate from ({STOCK_SQL.replace("{sl}", "sl").replace("{kinds}", "'annual', 'quarter'")}) m
  join ({_by("sum(sales_quantity) units", kinds="'annual', 'quarter'")}) u on u.period = m.period and u.period_type = m.period_type""", doubles="inventory_turnover_rate")
def inventory_turnover(x):
    return x.kpis(["inventory_turnover_rate"], ("annual", "quarter"))


WOS_SQL = """select pb.period_type, pb.period, 'overall' root, 'overall' dimension, 'overall' dimension_value, sum(case when q > 0 then a * week_days / 7.0 end) / nullif(sum(q), 0) "WOS",
  sum(case when r > 0 then b * week_days / 7.0 end) / nullif(sum(r), 0) wos_revenue, sum(case when k > 0 then c * week_days / 7.0 end) / nullif(sum(k), 0) wos_cost {more} from (
  select product_id, year, week, max(week_days) week_days, sum(q) q, sum(r) r, sum(k) k, avg(a) a, avg(b) b, avg(c) c from (
  select product_id, year, week, date, max(week_days) week_days, sum(sales_quantity) q, sum(sales_revenue) r, sum(sales_cost) k, sum(inventory) a, sum(inventory_retail) b, sum(inventory_cost) c from sd group by 1, 2, 3, 4) group by 1, 2, 3) s
  {join} join pb on pb.year = s.year and pb.week = s.week join products p on p.product_id = s.product_id where pb.period_type in ('annual', 'ytd') group by 1, 2"""


@query(*BASE, sql=WOS_SQL.replace("{more}", "").replace("{join}", ""), doubles="WOS wos_revenue wos_cost")
def wos(x):
    return x.kpis(["WOS", "wos_revenue", "wos_cost"], ("annual", "ytd"))


def _dc_daily(x):
    days = readers.window(x.inventory_warehouse, "date", START, END).join(F.broadcast(x.fiscal_cal.select("date", "year", "week")), "date")
    return days.withColumns({"git_quantity": F.lit(0.0), "has_inventory_row": F.lit(True), "is_blocked": F.lit(False)})


DC_WEEK = "left join (select product_id, year, week, avg(i) d from (select product_id, c.year, c.week, w.date, sum(inventory) i from inventory_warehouse w join fiscal_cal c on c.date = w.date where w.date between {START} and {END} group by 1, 2, 3, 4) group by 1, 2, 3) d on d.product_id = s.product_id and d.year = s.year and d.week = s.week"


@query(*BASE, "inventory_warehouse", sql=WOS_SQL.replace("{join}", DC_WEEK).replace("{more}", """, sum(case when q > 0 then coalesce(d, 0) * week_days / 7.0 end) / nullif(sum(q), 0) "WOS_DC", sum(case when q > 0 then (a + coalesce(d, 0)) * week_days / 7.0 end) / nullif(sum(q), 0) "WOS_TOTAL" """), doubles="WOS wos_revenue wos_cost WOS_DC WOS_TOTAL")
def wos_dc_total(x):
    return x.kpis(["WOS", "wos_revenue", "wos_cost", "WOS_DC", "WOS_TOTAL"], ("annual", "ytd"), frames=metrics.Facts(x.scoped(), dc_daily=_dc_daily(x)))


@query(*BASE, "inventory_warehouse", sql="""select t.period_type, t.period, t.root, t.dimension, t.dimension_value, dc_mean_stock, total_mean_stock from (
  select 'annual' period_type, cast(s.year as varchar) period, 'overall' root, 'overall' dimension, 'overall' dimension_value, avg(a + coalesce(i, 0)) total_mean_stock from (select year, date, sum(inventory) a from sd group by 1, 2) s
  left join (select date, sum(inventory) i from inventory_warehouse where product_id in (select product_id from products) group by 1) w on w.date = s.date group by s.year) t
  join (select cast(c.year as varchar) period, avg(i) dc_mean_stock from (select date, sum(inventory) i from inventory_warehouse where date between {START} and {END} and product_id in (select product_id from products) group by 1) w join fiscal_cal c on c.date = w.date group by 1) d on d.period = t.period""", doubles="dc_mean_stock total_mean_stock")
def mean_stock_total(x):
    return x.kpis(["dc_mean_stock", "total_mean_stock"], frames=metrics.Facts(x.scoped(), dc_daily=_dc_daily(x)))


@query(*BASE, "scope", "blocks", sql="""select 'annual' period_type, cast(year as varchar) period, 'overall' root, 'overall' dimension, 'overall' dimension_value, sum(case when not b then sales_quantity end) total_sales_quantity, sum(sales_revenue) total_sales_revenue
  from (select s.*, i.first_day is not null b from sd s left join iv i on i.product_id = s.product_id and i.location_id = s.store_id and s.date between i.first_day and i.last_day) group by year""")
def gated_sales(x):
    days = assortment.flag_blocked(x.usable(), x.intervals())
    return x.kpis(["total_sales_quantity", "total_sales_revenue"], frames=metrics.Facts(x.scoped(days)), gated=frozenset({"total_sales_quantity"}))


@query(*BASE, sql=_by("""sum(sales_quantity) total_sales_quantity""", more="and s.category = 'PROMO'"))
def population_filter(x):
    return x.kpis(["total_sales_quantity"], populations={"total_sales_revenue": {"category": ["PROMO"]}})


@query(*BASE, "goods_in_transit", sql="""select 'annual' period_type, cast(year as varchar) period, 'overall' root, 'overall' dimension, 'overall' dimension_value, avg(a) mean_stock from (
  select c.year, date, sum(i + g) a from (select coalesce(d.product_id, t.product_id) product_id, coalesce(d.date, t.date) date, coalesce(inventory, 0) i, coalesce(g, 0) g from (select * from daily_data where usable = 1 and date between {START} and {END}) d
  full outer join (select product_id, destination_id, date, sum(quantity) g from goods_in_transit where destination_type = 0 and date between {START} and {END} group by 1, 2, 3) t on t.product_id = d.product_id and t.destination_id = d.store_id and t.date = d.date) s
  join fiscal_cal c using (date) where product_id in (select product_id from products) group by 1, 2) where year in (select year from sd) group by year""", doubles="mean_stock")
def mean_stock_transit(x):
    moving = readers.window(facts.store_transit(x.goods_in_transit), "date", START, END)
    days = facts.with_transit(x.usable(), moving, ["product_id", "store_id", "date"], "has_daily_row")
    return x.kpis(["mean_stock"], frames=metrics.Facts(x.scoped(days)), transit=frozenset({"mean_stock"}))


RATE = "(select year, week, sum(stocked_pairs) a, sum(available_days) b from k where product_id in (select product_id from products) group by 1, 2)"


RATES = ["in_stock_rate", "weighted_instock_rate", "dc_in_stock_rate", "lost_sales_pct"]


def _rate_frames(x):
    return metrics.Facts(x.scoped(), facts.instock_weekly([x.lost_sales], x.fiscal_cal, START, END), None, dc_instock(x), facts.lost_base(x.lost_sales, x.usable(), x.fiscal_cal, START, END))


RATES_SQL = f"""select r.period_type, r.period, r.root, r.dimension, r.dimension_value, in_stock_rate, weighted_instock_rate, dc_in_stock_rate, lost_sales_pct from (
  select 'annual' period_type, cast(r.year as varchar) period, 'overall' root, 'overall' dimension, 'overall' dimension_value, greatest(0, sum(a) / sum(b)) in_stock_rate, sum(a / b * u) / sum(u) weighted_instock_rate
  from {RATE.replace("from k", f"from {INSTOCK}")} r left join (select year, week, sum(sales_quantity) u from sd group by 1, 2) u on u.year = r.year and u.week = r.week group by r.year) r
  join (select cast(year as varchar) period, sum(dc_stocked_days) * 1.0 / sum(dc_available_days) dc_in_stock_rate from {DC} group by 1) d on d.period = r.period
  join (select cast(year as varchar) period, 100 * sum(lost_sales) / nullif(sum(could_sell), 0) lost_sales_pct from {LOST} group by 1) l on l.period = r.period where r.period in (select cast(year as varchar) from sd)"""


@query(*BASE, "lost_sales", "inventory_warehouse", sql=RATES_SQL, doubles="in_stock_rate weighted_instock_rate dc_in_stock_rate lost_sales_pct")
def rates(x):
    return x.kpis(RATES, frames=_rate_frames(x))


@query("lost_sales", "products", sql="""select v.product_id, sum(p.lost) lost_sales, count(*) level_weeks from (select floor(product_id / 4.0) level, week_start_date, sum(lost_sales) lost from lost_sales group by 1, 2) p
  join (select product_id, option_code from products where option_code % 5 <> 4) v on v.option_code = p.level group by 1""", doubles="lost_sales")
def planning_levels(x):
    """Lost sales given by planning level and week, as rows of the level's products; a fifth of the levels is unknown."""
    levels = x.products.where("option_code % 5 <> 4").select(F.col("option_code").alias("planning_level_id"), "product_id")
    given = x.lost_sales.groupBy(F.floor(F.col("product_id") / 4).alias("planning_level_id"), "week_start_date").agg(F.sum("lost_sales").alias("lost_sales"))
    return readers.by_product(given, levels).groupBy("product_id").agg(F.sum("lost_sales").alias("lost_sales"), F.count("*").alias("level_weeks"))


# Reports that end on any day, slices by place or measure, products that the master lacks -----------------------------

LD = f"date '{LATEST}'"
#: Periods of a report that ends on any day, by date, and by week for lost sales.
LATEST_DAYS = f"""ld_days as (select date, year, week, row_number() over (partition by year order by date) day_index from fiscal_cal),
ld_k as (select day_index k, year y from ld_days where date = {LD}),
ld as (select d.date, d.year, d.week, 'annual' period_type, cast(d.year as varchar) period from ld_days d join (select year from wk group by 1 having min(week_start_date) >= {{START}} and max(week_end_date) <= {LD}) y on y.year = d.year
  union all select date, year, week, 'ytd', printf('YTD-%d', year) from ld_days where day_index <= (select k from ld_k) and year in (select year from ld_days where day_index <= (select k from ld_k) group by 1 having min(date) >= {{START}} and max(date) <= {LD}))"""
LATEST_WEEKS = "(select distinct period_type, period, year, week from ld where period_type = 'annual' or week <= (select week from fiscal_cal where date = date '2001-07-14' and year = (select y from ld_k)))"


def _measure_parts(days: str, weeks: str, end: str, sold: str = "", stored: str = "", counted: str = "", gridded: str = "") -> str:
    """Table expressions of all measures: ``days`` makes ``ld``, the periods of each date; ``weeks``, those of lost sales; further
    conditions on rows of sales, warehouse stock, in-stock days and warehouse days."""
    return f"""{days},
ls as (select d.product_id, store_id, d.date, sales_revenue r, sales_quantity q, inventory i, round(sales_quantity * cogs, 2) k, round(inventory * price_without_tax, 2) ir, round(inventory * cogs, 2) ic, l.* exclude (date)
  from daily_data d join products p on p.product_id = d.product_id join ld l on l.date = d.date where usable = 1 and d.date between {{START}} and {end} {sold}),
ldc as (select w.product_id, l.*, sum(inventory) i from inventory_warehouse w join ld l on l.date = w.date where w.date between {{START}} and {end} {stored} group by all),
lpd as (select period_type, period, product_id, year, week, date, sum(q) q, sum(r) r, sum(k) k, sum(i) i, sum(ir) ir, sum(ic) ic from ls group by all),
lpw as (select p.*, d.i di, wd from (select period_type, period, product_id, year, week, sum(q) q, sum(r) r, sum(k) k, avg(i) i, avg(ir) ir, avg(ic) ic from lpd group by all) p
  join (select period_type, period, year, week, count(*) wd from ld group by all) w using (period_type, period, year, week)
  left join (select period_type, period, product_id, year, week, avg(i) i from ldc group by all) d using (period_type, period, product_id, year, week)),
lday as (select s.*, w.i di from (select period_type, period, date, sum(i) i, sum(ir) ir, sum(ic) ic from ls group by all) s left join (select period_type, period, date, sum(i) i from ldc group by all) w using (period_type, period, date)),
liv as (select product_id, location_id, min(d) first_day, max(d) last_day from (select *, d - cast(row_number() over (partition by product_id, location_id order by d) as integer) run from (
  select distinct b.product_id, b.location_id, cast(unnest(generate_series(b.start_date, coalesce(b.end_date, {end}), interval 1 day)) as date) as d from blocks b join pairs p on p.product_id = b.product_id and p.location_id = b.location_id and p.scope_start <= b.start_date)
  where d between {{START}} and {end}) group by product_id, location_id, run),
lfree as (select d.* from daily_data d left join liv i on i.product_id = d.product_id and i.location_id = d.store_id and d.date between i.first_day and i.last_day where i.first_day is null),
lin as (select l.period_type, l.period, l.year, l.week, count(*) b, count(case when d.inventory > 0 or d.sales_quantity > 0 then 1 end) a
  from (select p.product_id, p.location_id store_id, greatest(min(date), {{START}}) o from pairs p join lfree f on f.product_id = p.product_id and f.store_id = p.location_id group by all) g join ld l on l.date between g.o and {end}
  left join daily_data d on d.product_id = g.product_id and d.store_id = g.store_id and d.date = l.date left join liv i on i.product_id = g.product_id and i.location_id = g.store_id and l.date between i.first_day and i.last_day where i.first_day is null {counted} group by all),
ldi as (select l.period_type, l.period, count(*) b, count(case when w.inventory > 0 then 1 end) a from (select product_id, warehouse_id, min(date) s from inventory_warehouse where date between {{START}} and {end} group by all) g
  join ld l on l.date between g.s and {end} left join inventory_warehouse w on w.product_id = g.product_id and w.warehouse_id = g.warehouse_id and w.date = l.date where true {gridded} group by all),
lweek as {weeks}"""


def _measures_sql(lost: str) -> str:
    """All measures of the whole, from ``_measure_parts`` and the SQL of lost sales by pair and week."""
    return f"""select period_type, period, 'overall' root, 'overall' dimension, 'overall' dimension_value, * exclude (period_type, period) from (select period_type, period, sum(q) total_sales_quantity, sum(r) total_sales_revenue, sum(r) / nullif(sum(q), 0) "AUR", sum(k) / nullif(sum(q), 0) "AUC", sum(i) total_inventory,
    count(distinct product_id) distinct_product_count, count(distinct store_id) distinct_store_count, count(distinct product_id * 1000003 + store_id) distinct_pair_count from ls group by all)
  left join (select period_type, period, avg(i) mean_stock, avg(ir) mean_stock_retail, avg(ic) mean_stock_cost, avg(i + coalesce(di, 0)) total_mean_stock from lday group by all) using (period_type, period)
  left join (select period_type, period, avg(i) dc_mean_stock from (select period_type, period, date, sum(i) i from ldc group by all) group by all) using (period_type, period)
  left join (select period_type, period, sum(case when q > 0 then i * wd / 7.0 end) / nullif(sum(q), 0) "WOS", sum(case when r > 0 then ir * wd / 7.0 end) / nullif(sum(r), 0) wos_revenue, sum(case when k > 0 then ic * wd / 7.0 end) / nullif(sum(k), 0) wos_cost,
    sum(case when q > 0 then coalesce(di, 0) * wd / 7.0 end) / nullif(sum(q), 0) "WOS_DC", sum(case when q > 0 then (i + coalesce(di, 0)) * wd / 7.0 end) / nullif(sum(q), 0) "WOS_TOTAL" from lpw group by all) using (period_type, period)
  left join (select period_type, period, units / nullif(stock, 0) inventory_turnover_rate from (select period_type, period, sum(q) units from ls group by all) join (select period_type, period, avg(i) stock from lday group by all) using (period_type, period)) using (period_type, period)
  left join (select period_type, period, sum(a) * 1.0 / sum(b) in_stock_rate, sum(a * 1.0 / b * u) / nullif(sum(u), 0) weighted_instock_rate from lin left join (select period_type, period, year, week, sum(q) u from ls group by all) using (period_type, period, year, week) group by all) using (period_type, period)
  left join (select period_type, period, a * 1.0 / b dc_in_stock_rate from ldi) using (period_type, period)
  left join (select period_type, period, 100 * sum(lost_sales) / nullif(sum(could_sell), 0) lost_sales_pct from ({lost}) join lweek using (year, week) group by all) using (period_type, period)"""


MEASURE_SOURCES = ("daily_data", "products", "fiscal_cal", "scope", "blocks", "inventory_warehouse", "lost_sales")
MEASURE_DOUBLES = "AUR AUC mean_stock mean_stock_retail mean_stock_cost dc_mean_stock total_mean_stock WOS wos_revenue wos_cost WOS_DC WOS_TOTAL inventory_turnover_rate in_stock_rate weighted_instock_rate dc_in_stock_rate lost_sales_pct"
LATEST_LOST = _lost_sql(f"d.date between {{START}} and {LD}", f"l.week_start_date >= {{START}} and l.week_start_date + 7 <= {LD}")


@query(*MEASURE_SOURCES, own=_measure_parts(LATEST_DAYS, LATEST_WEEKS, LD), sql=_measures_sql(LATEST_LOST), doubles=MEASURE_DOUBLES)
def latest_day_measures(x):
    """All measures of complete years and of years to date by days, for a report that ends on a Wednesday."""
    x = x.staged()
    weeks, parts = x.weeks(), calendar.day_parts(x.fiscal_cal, LATEST)
    days = readers.window(expressions(x.daily_data, ["usable = 1"]), "date", START, LATEST).drop("usable")
    pairs = x.pairs()
    frames = metrics.Facts(
        facts.scoped_daily(days, x.products, parts, weeks), facts.instock_daily(pairs.withColumnRenamed("location_id", "store_id"), x.daily_data, calendar.parted(weeks, parts), START, LATEST, "first", by_store=False, blocks=x.blocks),
        facts.dc_daily(x.inventory_warehouse, parts, START, LATEST), facts.dc_instock(x.inventory_warehouse, parts, START, LATEST, by_warehouse=False), facts.lost_base(x.lost_sales, days, x.fiscal_cal, START, LATEST, latest_day=True),
    )
    return metrics.kpi_table(frames, x.slices(), calendar.day_bridge(x.fiscal_cal, weeks, START, LATEST, ("annual", "ytd")))


PLACE_ROOTS = {"overall": {}, "near": {"district": ["district 0", "district 1"]}, "stocked": {"inventory": {"exclude": [0.0]}}}


def _placed(rows: str, stocked: str = "true") -> str:
    """SQL of rows with product_id and store_id, labelled with the slices by district and brand."""
    return f"""(select t.*, root, dimension, case dimension when 'overall' then 'overall' when 'district' then district else p.brand end dimension_value from {rows} t left join stores using (store_id) left join products p on p.product_id = t.product_id,
    (values ('overall'), ('near'), ('stocked')) a(root), (values ('overall'), ('district'), ('brand')) b(dimension) where root = 'overall' or root = 'near' and district in ('district 0', 'district 1') or root = 'stocked' and {stocked})"""


SLICED = "year, root, dimension, dimension_value"
PLACED_SALES = _placed("(select * exclude (brand) from sd)", "t.inventory <> 0")


@query(*BASE, "stores", "lost_sales", sql=f"""select 'annual' period_type, cast(s.year as varchar) period, s.root, s.dimension, s.dimension_value, s.* exclude ({SLICED}), mean_stock, "WOS", in_stock_rate, lost_sales_pct
  from (select {SLICED}, sum(sales_quantity) total_sales_quantity, sum(sales_revenue) / nullif(sum(sales_quantity), 0) "AUR", count(distinct product_id) distinct_product_count, count(distinct store_id) distinct_store_count, count(distinct product_id * 1000003 + store_id) distinct_pair_count from {PLACED_SALES} group by all) s
  left join (select {SLICED}, avg(i) mean_stock from (select {SLICED}, date, sum(inventory) i from {PLACED_SALES} group by all) group by all) using ({SLICED})
  left join (select {SLICED}, sum(case when q > 0 then i * wd / 7.0 end) / nullif(sum(q), 0) "WOS" from (select {SLICED}, product_id, week, max(wd) wd, sum(q) q, avg(i) i from (select {SLICED}, product_id, week, date, max(week_days) wd, sum(sales_quantity) q, sum(inventory) i from {PLACED_SALES} group by all) group by all) group by all) using ({SLICED})
  left join (select {SLICED}, sum(stocked_pairs) / sum(available_days) in_stock_rate from {_placed(INSTOCK)} group by all) using ({SLICED})
  left join (select {SLICED}, 100 * sum(lost_sales) / nullif(sum(could_sell), 0) lost_sales_pct from {_placed(LOST)} group by all) using ({SLICED})""", doubles="AUR mean_stock WOS in_stock_rate lost_sales_pct")  # fmt: skip
def store_slices(x):
    """Roots and cuts by an attribute of stores, and a root by a measure of the rows."""
    frames = metrics.Facts(x.scoped(), facts.instock_weekly([x.lost_sales], x.fiscal_cal, START, END), lost=facts.lost_base(x.lost_sales, x.usable(), x.fiscal_cal, START, END))
    by = x.slices(PLACE_ROOTS, (None, "district", "brand"), stores=x.stores)
    names = ("total_sales_quantity", "AUR", "distinct_product_count", "distinct_store_count", "distinct_pair_count", "mean_stock", "WOS", "in_stock_rate", "lost_sales_pct")
    return metrics.kpi_table(frames, by, x.periods(), metrics.Rules(names))


def _known(rows: str) -> str:
    """SQL of rows labelled with the slices of a master that lacks products: those are in what takes nulls."""
    return f"""(select t.*, root, dimension, case dimension when 'overall' then 'overall' else p.brand end dimension_value from {rows} t left join (select * from products where option_code % 7 <> 3) p on p.product_id = t.product_id,
    (values ('overall'), ('promo')) a(root), (values ('overall'), ('brand')) b(dimension) where root = 'overall' or p.category = 'PROMO')"""


KNOWN_SALES = _known("(select * exclude (brand, category) from sd where product_id in (select product_id from products where option_code % 7 <> 3))")


@query(*BASE, "inventory_warehouse", "lost_sales", sql=f"""select 'annual' period_type, cast(s.year as varchar) period, s.root, s.dimension, s.dimension_value, s.* exclude ({SLICED}), in_stock_rate, weighted_instock_rate, dc_in_stock_rate, dc_mean_stock, total_mean_stock, lost_sales_pct
  from (select {SLICED}, sum(sales_quantity) total_sales_quantity from {KNOWN_SALES} group by all) s
  left join (select {SLICED}, sum(a) / sum(b) in_stock_rate, sum(a / b * u) / nullif(sum(u), 0) weighted_instock_rate from (select {SLICED}, week, sum(stocked_pairs) a, sum(available_days) b from {_known(INSTOCK)} group by all) left join (select {SLICED}, week, sum(sales_quantity) u from {KNOWN_SALES} group by all) using ({SLICED}, week) group by all) using ({SLICED})
  left join (select {SLICED}, sum(dc_stocked_days) * 1.0 / sum(dc_available_days) dc_in_stock_rate from {_known(DC)} group by all) using ({SLICED})
  left join (select {SLICED}, avg(i) dc_mean_stock from (select {SLICED}, date, sum(inventory) i from {_known("(select w.*, c.year from inventory_warehouse w join fiscal_cal c on c.date = w.date where w.date between {START} and {END})")} group by all) group by all) using ({SLICED})
  left join (select {SLICED}, avg(a + coalesce(i, 0)) total_mean_stock from (select {SLICED}, date, sum(inventory) a from {KNOWN_SALES} group by all) left join (select {SLICED}, date, sum(inventory) i from {_known("(select w.*, c.year from inventory_warehouse w join fiscal_cal c on c.date = w.date where w.date between {START} and {END})")} group by all) using ({SLICED}, date) group by all) using ({SLICED})
  left join (select {SLICED}, 100 * sum(lost_sales) / nullif(sum(could_sell), 0) lost_sales_pct from {_known(LOST)} group by all) using ({SLICED})""", doubles="in_stock_rate weighted_instock_rate dc_in_stock_rate dc_mean_stock total_mean_stock lost_sales_pct")  # fmt: skip
def unknown_products(x):
    """A master that lacks some products: their sales drop out, their in-stock days, warehouse stock and lost sales stay in
    the whole."""
    x = x.staged()
    master = x.products.where("option_code % 7 <> 3")
    frames = metrics.Facts(
        facts.scoped_daily(x.usable(), master, x.fiscal_cal, x.weeks()), facts.instock_weekly([x.lost_sales], x.fiscal_cal, START, END), facts.dc_daily(x.inventory_warehouse, x.fiscal_cal, START, END),
        facts.dc_instock(x.inventory_warehouse, x.fiscal_cal, START, END, by_warehouse=False), facts.lost_base(x.lost_sales, x.usable(), x.fiscal_cal, START, END),
    )
    names = ("total_sales_quantity", "in_stock_rate", "weighted_instock_rate", "dc_in_stock_rate", "dc_mean_stock", "total_mean_stock", "lost_sales_pct")
    return metrics.kpi_table(frames, slices.Slices(master, ROOTS, (None, "brand")), x.periods(), metrics.Rules(names))


# Comparisons ----------------------------------------------------------------------------------------------------------

COMPARED = ["total_sales_quantity", "total_sales_revenue", "AUR"]


def _links_sql(table: str, kind: str, latest: bool) -> str:
    return f"""select '{kind}' comparison_type, 'overall' root, 'overall' dimension, 'overall' dimension_value, metric_key, prior_period, current_period, prior_value, current_value, (current_value - prior_value) / nullif(abs(prior_value), 0) * 100 change_pct, cast(null as double) change_pp from (
  select metric_key, lag(period) over w prior_period, period current_period, lag(value) over w prior_value, value current_value, lead(period) over w n from (
  select period, 'total_sales_quantity' metric_key, total_sales_quantity value from {table} union all select period, 'total_sales_revenue', total_sales_revenue from {table} union all select period, 'AUR', "AUR" from {table}) window w as (partition by metric_key order by period)) where prior_period is not null {"and n is null" if latest else ""}"""


YTD_TABLE = f"({_by('sum(sales_quantity) total_sales_quantity, sum(sales_revenue) total_sales_revenue, sum(sales_revenue) / nullif(sum(sales_quantity), 0) AS ' + chr(34) + 'AUR' + chr(34), kinds=chr(39) + 'ytd' + chr(39))})"


@query(*BASE, sql=_links_sql("ann", "yoy", True), doubles="prior_value current_value change_pct")
def yoy(x):
    return compare.yoy(x.kpis(COMPARED), COMPARED)


@query(*BASE, sql=_links_sql(YTD_TABLE, "ytd", False), doubles="prior_value current_value change_pct")
def ytd_links(x):
    return compare.ytd(x.kpis(COMPARED, ("ytd",)), COMPARED)


#: Annual weeks of supply and rates in long form.
CHANGING = (
    f"""(select period, 'WOS' metric_key, "WOS" as value from ({WOS_SQL.replace("{more}", "").replace("{join}", "")}) where period_type = 'annual'"""
    + "".join(f" union all select period, '{name}', {name} from ({RATES_SQL})" for name in RATES)
    + ")"
)


@query(*BASE, "lost_sales", "inventory_warehouse", sql=f"""select 'yoy' comparison_type, 'overall' root, 'overall' dimension, 'overall' dimension_value, metric_key, prior_period, current_period, prior_value, current_value,
  case when metric_key = 'WOS' then (floor(current_value) - floor(prior_value)) / nullif(abs(floor(prior_value)), 0) * 100 end change_pct,
  case metric_key when 'WOS' then null when 'lost_sales_pct' then current_value - prior_value else (current_value - prior_value) * 100 end change_pp from (
  select metric_key, lag(period) over w prior_period, period current_period, lag(value) over w prior_value, value current_value, lead(period) over w n from {CHANGING} window w as (partition by metric_key order by period)) where prior_period is not null and n is null""", doubles="prior_value current_value change_pct change_pp")
def yoy_rates(x):
    """Weeks of supply change in percent of whole weeks, rates in points."""
    names = ["WOS", *RATES]
    return compare.yoy(x.kpis(names, frames=_rate_frames(x)), names)


@query(*BASE, sql="""select year, metric, scope, score, score - scope abs_diff, (score - scope) / nullif(abs(scope), 0) * 100 pct_diff from (
  select cast(year as varchar) as year, 'total_sales_quantity' metric, sum(sales_quantity) scope, sum(case when store_id < 3 then sales_quantity end) score from sd group by 1
  union all select cast(year as varchar), 'total_sales_revenue', sum(sales_revenue), sum(case when store_id < 3 then sales_revenue end) from sd group by 1)""", doubles="pct_diff")
def scope_diff(x):
    names = COMPARED[:2]
    return compare.scope_diff(x.kpis(names), x.kpis(names, frames=metrics.Facts(x.scoped().where("store_id < 3"))), names)


@query(sql="""select * from (values ('WOS', 23.9, 23.1, 0.0, null), ('WOS', 0.9, 2.0, null, null), ('AUR', 4.0, 5.0, 25.0, null), ('in_stock_rate', 0.5, 0.75, null, 25.0), ('lost_sales_pct', 2.0, 3.5, null, 1.5), ('AUC', null, 1.0, null, null)) t(metric, prior_value, current_value, change_pct, change_pp)""", doubles="prior_value current_value change_pct change_pp")
def change_values(x):
    rows = [("WOS", 23.9, 23.1), ("WOS", 0.9, 2.0), ("AUR", 4.0, 5.0), ("in_stock_rate", 0.5, 0.75), ("lost_sales_pct", 2.0, 3.5), ("AUC", None, 1.0)]
    df = x.spark.createDataFrame(rows, "metric string, prior_value double, current_value double")
    args = F.col("metric"), F.col("prior_value"), F.col("current_value")
    return df.withColumns({"change_pct": change_pct(*args), "change_pp": change_pp(*args)})


UNIVERSE = "(select product_id, store_id from sd where year in (1998, 1999, 2000) group by 1, 2 having count(distinct year) = 3)"


@query(*BASE, sql=f"select * from {UNIVERSE}")
def comparable_universe(x):
    return compare.universe(x.scoped(), [1998, 1999, 2000])


def _comparable(name: str, kind: str, years: list[int], number: int | None = None):
    """Like for like: the pairs that every year has, their metrics per year, and the links of neighbouring years."""
    label = {"ytd": "printf('YTD-%d', s.year)", "yoy": "cast(s.year as varchar)", "quarter": f"printf('%d-Q%d', s.year, {number})", "half": f"printf('%d-H%d', s.year, {number})"}[kind]
    period_type = {"yoy": "annual"}.get(kind, kind)
    listed = ", ".join(map(str, years))
    inside = f"and pb.period = {label}"
    universe = f"(select s.product_id, s.store_id from sd s join pb on pb.year = s.year and pb.week = s.week where pb.period_type = '{period_type}' {inside} and s.year in ({listed}) group by 1, 2 having count(distinct s.year) = {len(years)})"
    rows = f"(select s.* from sd s join {universe} u on u.product_id = s.product_id and u.store_id = s.store_id where s.year in ({listed})) s"
    table = "(" + _by('sum(sales_quantity) total_sales_quantity, sum(sales_revenue) total_sales_revenue, sum(sales_revenue) / nullif(sum(sales_quantity), 0) "AUR"', rows=rows, kinds=f"'{period_type}'", more=inside) + ")"

    def run(x):
        years = compare.qualifying_years(x.scoped(), x.weeks(), START, END, period_type, number)
        periods = x.periods((period_type,)).where(F.col("year").isin(years))
        if number:
            periods = periods.where(F.col("period").endswith(f"-{'Q' if kind == 'quarter' else 'H'}{number}"))
        scoped = x.scoped().join(F.broadcast(periods.select("year", "week").distinct()), ["year", "week"], "left_semi")
        pairs = compare.universe(scoped, years)
        table = metrics.kpi_table(metrics.Facts(compare.restricted(scoped, pairs)), x.slices(), periods, metrics.Rules(tuple(COMPARED)))
        return compare.links(table, COMPARED, period_type, kind)

    run.__name__ = name
    query(*BASE, sql=_links_sql(table, kind, False), doubles="prior_value current_value change_pct")(run)


_comparable("comparable_ytd", "ytd", [1998, 1999, 2000, 2001])
_comparable("comparable_yoy", "yoy", [1998, 1999, 2000])
_comparable("comparable_quarter", "quarter", [1998, 1999, 2000, 2001], 1)
_comparable("comparable_half", "half", [1998, 1999, 2000], 2)


LIKE_QUARTERS = """ld as (select c.date, c.year, c.week, 'quarter' period_type, printf('%d-Q%d', c.year, wk.quarter) period, wk.quarter number from fiscal_cal c join wk using (year, week) join cp on cp.period_type = 'quarter' and is_complete and cp.year = c.year and cp.number = wk.quarter),
ly as (select number, year from sd join ld using (date, year, week) group by all),
ln as (select number, count(*) n from ly group by 1),
lpairs as (select number, product_id, store_id from (select number, product_id, store_id, count(distinct year) y from sd join ld l using (date, year, week) group by all) join ln using (number) where y = n),
lstored as (select number, product_id, warehouse_id from (select number, product_id, warehouse_id, count(distinct year) y from inventory_warehouse join ld l using (date) join ly using (number, year) where date between {START} and {END} group by all) join ln using (number) where y = n),
lgrid as (select number, product_id, warehouse_id from (select number, product_id, warehouse_id, count(distinct year) y from (select product_id, warehouse_id, min(date) s from inventory_warehouse where date between {START} and {END} group by all) g join ld l on l.date between g.s and {END} join ly using (number, year) group by all) join ln using (number) where y = n)"""
LIKE_PARTS = _measure_parts(
    LIKE_QUARTERS, "(select distinct period_type, period, year, week, number from ld)", "{{END}}", "and (l.number, d.product_id, d.store_id) in (select (number, product_id, store_id) from lpairs)",
    "and (l.number, w.product_id, w.warehouse_id) in (select (number, product_id, warehouse_id) from lstored)", "and (l.number, g.product_id, g.store_id) in (select (number, product_id, store_id) from lpairs)",
    "and (l.number, g.product_id, g.warehouse_id) in (select (number, product_id, warehouse_id) from lgrid)",
).replace("{{", "{").replace("}}", "}")
LIKE_LOST = f"select * from {LOST} z join lweek using (year, week) where (number, product_id, store_id) in (select (number, product_id, store_id) from lpairs)"


@query(*MEASURE_SOURCES, own=LIKE_PARTS, sql=f"""select 'quarter' comparison_type, k.number, k.prior link_prior_year, k.current link_current_year, c.comparable_pair_count, root, dimension, dimension_value, period, y.year, m.* exclude (period_type, period, root, dimension, dimension_value)
  from ({_measures_sql(LIKE_LOST).replace("join lweek using (year, week) group by all", "group by all")}) m join (select distinct period, year, number from ld) y using (period)
  join (select number, year "current", lag(year) over (partition by number order by year) prior from ly) k on k.number = y.number and k.prior is not null and y.year in (k.prior, k.current)
  join (select number, count(*) comparable_pair_count from lpairs group by 1) c on c.number = k.number""", doubles=MEASURE_DOUBLES)  # fmt: skip
def comparable_quarters(x):
    """All measures, like for like, of every quarter number: each year's rows once per link."""
    pairs = x.pairs().withColumnRenamed("location_id", "store_id")
    twice = x.scoped().groupBy("product_id", "store_id").agg(F.count_distinct("year").alias("years")).where("years > 1")
    pairs = pairs.join(twice, ["product_id", "store_id"], "left_semi")  # a link has two years, so no other pair is in one
    frames = metrics.Facts(
        x.scoped(), facts.instock_daily(pairs, x.daily_data, x.weeks(), START, END, "first", blocks=x.blocks), facts.dc_daily(x.inventory_warehouse, x.fiscal_cal, START, END),
        dc_instock(x), facts.lost_base(x.lost_sales, x.usable(), x.fiscal_cal, START, END),
    )
    return compare.like_for_like(frames, x.slices(), x.weeks(), START, END, "quarter", metrics.Rules())


@query(*BASE, sql=_by("sum(sales_quantity) total_sales_quantity", kinds="'week', 'annual'", more="and (pb.period_type = 'annual' and pb.year >= 2000 or pb.period_type = 'week' and pb.year * 100 + pb.week >= (select max(year * 100 + week) - 3 from win))"))
def trim_recent(x):
    return slices.trim_recent(x.kpis(["total_sales_quantity"], ("annual", "week")), {"annual": 2, "week": 4})


@query(*BASE, sql=_by("sum(sales_quantity) total_sales_quantity", kinds="'week', 'annual'", more="and pb.period <> '2001-W23' and (pb.period_type = 'annual' and pb.year >= 2000 or pb.period_type = 'week' and pb.year * 100 + pb.week >= (select max(year * 100 + week) - 3 from win))"))
def trim_calendar_weeks(x):
    """A week without rows takes one of the four places."""
    table = x.kpis(["total_sales_quantity"], ("annual", "week")).where("period <> '2001-W23'")
    return slices.trim_recent(table, {"annual": 2, "week": 4}, calendar.within(x.weeks(), START, END))


SAVED = "(select period, case when period = '1999' then -total_sales_quantity else total_sales_quantity end total_sales_quantity, total_sales_revenue, \"AUR\" from ann)"


@query(*BASE, sql=_links_sql(SAVED, "yoy", False), doubles="prior_value current_value change_pct")
def recomputed_after_merge(x):
    """Comparisons of the merged history, in which saved rows stay and reach back beyond the new ones."""
    new = x.kpis(COMPARED)
    saved = new.where("period < '2000'").withColumn("total_sales_quantity", F.expr("if(period = '1999', -total_sales_quantity, total_sales_quantity)"))
    return compare.links(snapshots.merged(saved, new.where("period > '1998'"), snapshots.KEYS["kpi_long"]), COMPARED, "annual", "yoy")


def _link_rows_sql(prior: int) -> str:
    pairs = f"(select product_id, store_id from sd where year in ({prior}, {prior + 1}) group by 1, 2 having count(distinct year) = 2)"
    rows = f"(select cast(s.year as varchar) period, sum(sales_quantity) total_sales_quantity, sum(sales_revenue) total_sales_revenue, sum(sales_revenue) / nullif(sum(sales_quantity), 0) \"AUR\" from sd s join {pairs} u on u.product_id = s.product_id and u.store_id = s.store_id where s.year in ({prior}, {prior + 1}) group by 1)"
    return _links_sql(rows, "yoy", False)


@query(*BASE, sql=f"{_link_rows_sql(1998)} union all {_link_rows_sql(1999)}", doubles="prior_value current_value change_pct")
def rebuilt_comparison(x):
    """Like-for-like comparisons from saved rows of two links, each with its own pairs."""
    scoped, parts = x.scoped(), []
    for prior in (1998, 1999):
        years = [prior, prior + 1]
        rows = compare.restricted(scoped.where(F.col("year").isin(years)), compare.universe(scoped, years))
        table = metrics.kpi_table(metrics.Facts(rows), x.slices(), x.periods().where(F.col("year").isin(years)), metrics.Rules(tuple(COMPARED)))
        parts.append(table.withColumns({"comparison_type": F.lit("yoy"), "link_prior_year": F.lit(prior), "link_current_year": F.lit(prior + 1), "year": F.col("period").cast("int")}))
    return compare.rebuilt(parts[0].unionByName(parts[1]), COMPARED, "yoy")


@query(*BASE, sql=f"""select period_type, period, root, dimension, dimension_value, case when period = '2000' or period like 'YTD%' then total_sales_quantity else -1 end total_sales_quantity from ({_by("sum(sales_quantity) total_sales_quantity", kinds="'annual', 'ytd'")}) where period <> '2001'""")
def merge_incremental(x):
    new = x.kpis(["total_sales_quantity"], ("annual", "ytd"))
    saved = new.where("period in ('1998', '1999') or period_type = 'ytd'").withColumn("total_sales_quantity", F.lit(-1.0))
    return snapshots.merged(saved, new.where("period <> '2001'"), snapshots.KEYS["kpi_long"], always="period_type = 'ytd'")

"""The retail inputs as projections of the star-schema test tables, as SQL for Spark and for DuckDB.

Every row of the tables goes in; report windows are the queries' own. Parts are folded to ``{M}`` products, a tenth of them
and 40 at least, suppliers to ``{S}`` stores, a twentieth and 5 at least, and to ``{W}`` warehouses, a fiftieth and 2 at
least, so that products and stores grow with the tables and have days enough at every scale. The calendar has the days from
the first to the last order.

Lines and orders are dealt by product, before they are grouped, over as many tasks as their number asks for: what a task holds
does not grow with the tables, and no later sum or join of these inputs by a key that has the product shuffles their rows again.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = {
    "daily_data": """select cast(l_partkey % {M} as bigint) product_id, cast(l_suppkey % {S} as bigint) store_id, cast(l_shipdate as date) date,
  cast(sum(cast(floor(l_extendedprice) as bigint)) as double) sales_revenue, cast(sum(l_quantity) as double) sales_quantity,
  cast(sum((l_partkey*7 + l_suppkey*13 + l_linenumber*3) % 41 - 5) as double) inventory,
  case when sum(l_partkey + l_linenumber) % 11 = 0 then 0 else 1 end usable
from lineitem group by 1, 2, 3""",
    "products": """select p_partkey % {M} product_id, case when p_partkey % {M} % 10 = 9 then null else min_by(p_brand, p_partkey) end brand, min_by(p_type, p_partkey) category,
  cast(max(p_size) as double) cogs, max(floor(p_retailprice))*1.0e0 price_without_tax,
  p_partkey % {M} % 13 <> 0 is_active, cast(floor(p_partkey % {M} / 4.0) as bigint) option_code from part group by p_partkey % {M}""",
    "item_family": """select p_partkey % {M} product_id, case when p_partkey % {M} % 10 = 7 then p_partkey % {M} - 1 end parent_id, p_partkey % {M} % 10 = 6 is_main
from part group by p_partkey % {M} having p_partkey % {M} % 10 in (6,7)""",
    "transactional_sales": """select cast(l_partkey % {M} as bigint) product_id, cast(l_suppkey % {S} as bigint) store_id, cast(l_shipdate as date) date,
  case l_returnflag when 'R' then 'return' when 'A' then 'regular' else 'promo' end sales_type,
  cast(floor(l_extendedprice) as double) sales_revenue, cast(l_quantity as double) sales_quantity from lineitem""",
    "scope": """select cast(l_partkey % {M} as bigint) product_id, cast(l_suppkey % {S} as bigint) location_id, 21 solution_id,
  {ADD}(date '1998-02-01', cast((l_partkey % {M} * 37 + l_suppkey % {S} * 11) % 400 as int)) start_date,
  case when (l_partkey % {M} + l_suppkey % {S}) % 29 = 0 then date '2000-06-30' end end_date, date '2001-07-15' run_date
from lineitem group by l_partkey % {M}, l_suppkey % {S}""",
    "blocks": """select 21 solution_id, cast(o_custkey % {M} as bigint) product_id, cast(o_orderkey % {S} as bigint) location_id, cast(o_orderdate as date) start_date,
  case when o_orderkey % 97 <> 0 then {ADD}(cast(o_orderdate as date), cast(o_custkey % 30 as int)) end end_date
from orders""",
    "inventory_warehouse": """select cast(o_custkey % {M} as bigint) product_id, cast(o_custkey % {W} as bigint) warehouse_id, cast(o_orderdate as date) date,
  cast(sum((o_orderkey*3) % 53) as double) inventory from orders group by 1, 2, 3""",
    "dc_scope": """select cast(o_custkey % {M} as bigint) product_id, cast(o_custkey % {W} as bigint) location_id, 22 solution_id,
  {ADD}(date '1998-02-01', cast(o_custkey % {M} * 13 % 300 as int)) start_date, cast(null as date) end_date, date '2001-07-15' run_date
from orders group by o_custkey % {M}, o_custkey % {W}""",
    "dc_blocks": """select 22 solution_id, cast(o_custkey % {M} as bigint) product_id, cast(o_custkey % {W} as bigint) location_id, cast(o_orderdate as date) start_date,
  {ADD}(cast(o_orderdate as date), cast(o_orderkey % 3 as int)) end_date from orders""",
    "store_closures": """select cast(r_regionkey as bigint) location_id, {ADD}(date '1999-03-01', cast(r_regionkey * 40 as int)) start_date, {ADD}(date '1999-03-11', cast(r_regionkey * 40 as int)) end_date from region""",
    "goods_in_transit": """select cast(l_partkey % {M} as bigint) product_id, cast(case when l_linenumber % 2 = 0 then l_suppkey % {S} else l_suppkey % {W} end as bigint) destination_id,
  cast(l_linenumber % 2 as bigint) destination_type, cast(l_shipdate as date) date, cast(l_quantity as double) quantity from lineitem where l_linestatus = 'O' and l_returnflag = 'N'""",
    "lost_sales": """select cast(l_partkey % {M} as bigint) product_id, cast(l_suppkey % {S} as bigint) store_id, {WK} week_start_date,
  cast(sum(l_linenumber) % 9 as double) / 2.0e0 lost_sales, cast(sum(l_linenumber) % 8 as double) in_stock, cast(7 as double) total_days
from lineitem group by 1, 2, 3""",
    "speed_cluster": """select p_partkey % {M} product_id, 'sales_speed' attribute_name, case when p_partkey % {M} % 8 <> 0 then cast(p_partkey % {M} % 5 + 1 as varchar(4)) end attribute_value from part group by p_partkey % {M}""",
    "fiscal_cal": """select date, cast(1998 + floor(n/364.0) as int) as year, cast(floor((n - 364 * floor(n/364.0))/7.0) as int) + 1 as week,
  concat('Q', cast(cast(floor((n - 364 * floor(n/364.0))/91.0) as int) + 1 as {STR})) as quarter,
  concat('M', cast(cast(floor((n - 364 * floor(n/364.0))/91.0) as int)*3 + case when n - 91 * floor(n/91.0) < 28 then 1 when n - 91 * floor(n/91.0) < 63 then 2 else 3 end as {STR})) as month
from (select date, {DAYS} as n from {EACH} t) t""",
    "stores": """select cast(s_suppkey % {S} as bigint) store_id, case when s_suppkey % {S} % 5 < 4 then concat('district ', cast(min(s_nationkey) % 3 as {STR})) end district from supplier group by 1, s_suppkey % {S}""",
}
SPARK = {
    "WK": "date_sub(cast(l_shipdate as date), dayofweek(l_shipdate)-1)", "STR": "string", "DAYS": "datediff(date, date '1998-02-01')",
    "EACH": "(select explode(sequence(cast(min(o_orderdate) as date), cast(max(o_orderdate) as date))) date from orders)",
}
DUCKDB = {
    "M": "(select greatest(40, count(*) // 10) from part)", "S": "(select greatest(5, count(*) // 20) from supplier)", "W": "(select greatest(2, count(*) // 50) from supplier)",
    "WK": "cast(cast(l_shipdate as date) - cast(dayofweek(l_shipdate) as integer) as date)", "STR": "varchar", "DAYS": "(date - date '1998-02-01')",
    "EACH": "(select cast(unnest(generate_series(cast(min(o_orderdate) as date), cast(max(o_orderdate) as date), interval 1 day)) as date) date from orders)",
}
START, END = "1998-02-01", "2001-07-14"
#: What inputs by product, store and day, or coarser keys, sum of a line, and these sums.
LINE = """select _product product_id, cast(l_suppkey % {S} as bigint) store_id, cast(l_shipdate as date) date, cast(floor(l_extendedprice) as bigint) revenue, l_quantity quantity,
  (l_partkey*7 + l_suppkey*13 + l_linenumber*3) % 41 - 5 stock, l_partkey + l_linenumber mark, l_linenumber numbers from {lines}"""
SUMMED = ("revenue", "quantity", "stock", "mark", "numbers")
#: The inputs of ``TABLES`` that can be made of these days.
OF_DAYS = {
    "daily_data": """select product_id, store_id, date, cast(revenue as double) sales_revenue, cast(quantity as double) sales_quantity, cast(stock as double) inventory, case when mark % 11 = 0 then 0 else 1 end usable from {days}""",
    "scope": """select product_id, store_id location_id, 21 solution_id, date_add(date '1998-02-01', cast((product_id * 37 + store_id * 11) % 400 as int)) start_date,
  case when (product_id + store_id) % 29 = 0 then date '2000-06-30' end end_date, date '2001-07-15' run_date from {days} group by product_id, store_id""",
    "lost_sales": """select product_id, store_id, date_sub(date, dayofweek(date)-1) week_start_date, cast(sum(numbers) % 9 as double) / 2.0e0 lost_sales, cast(sum(numbers) % 8 as double) in_stock,
  cast(7 as double) total_days from {days} group by 1, 2, 3""",
}
#: How inputs with products name them, by source; other inputs have few rows.
PRODUCTS = {"lineitem": "cast(l_partkey % {M} as bigint)", "orders": "cast(o_custkey % {M} as bigint)"}
#: Lines for each task that holds products.
LINES = 400_000


def filled(sql: str, duckdb: bool) -> str:
    for key, value in (DUCKDB if duckdb else SPARK).items():
        sql = sql.replace("{" + key + "}", value)
    if duckdb:
        while "{ADD}(" in sql:  # a call of date and days is a sum there
            at = sql.index("{ADD}(")
            depth, cut, k = 0, 0, at + 6
            while True:
                c = sql[k]
                depth += (c == "(") - (c == ")")
                if c == "," and depth == 0 and not cut:
                    cut = k
                if depth < 0:
                    break
                k += 1
            sql = f"{sql[:at]}cast({sql[at + 6 : cut]} + {sql[cut + 1 : k]} as date){sql[k + 1 :]}"
        return sql
    return sql.replace("{ADD}", "date_add")


@lru_cache(maxsize=64)
def moduli(sf_dir: str) -> dict[str, int]:
    """What keys are folded by, from the row counts of the files."""
    spark = SparkSession.active()
    parts, suppliers = (spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("part", "supplier"))
    return {"M": max(40, parts // 10), "S": max(5, suppliers // 20), "W": max(2, suppliers // 50)}


@lru_cache(maxsize=64)
def tasks(sf_dir: str) -> int:
    """Over how many tasks products are dealt: one number for all inputs, so that they can be joined where they are."""
    spark = SparkSession.active()
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    return max(spark.sparkContext.defaultParallelism, -(-lines // LINES))


def named(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """A table's rows with ``_product``."""
    return spark.read.parquet(f"{sf_dir}/{source}.parquet").withColumn("_product", F.expr(PRODUCTS[source].replace("{M}", str(moduli(sf_dir)["M"]))))


def days_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines summed by product, store and day, as a table of the warehouse with a bucket for each task, for queries that read
    lines more than once: lines are shuffled once, and the table's rows not by any key that has the product."""
    lines = spark.sql(LINE.replace("{S}", str(moduli(sf_dir)["S"])), lines=named(spark, sf_dir, "lineitem")).repartition(tasks(sf_dir), "product_id")
    rows = lines.groupBy("product_id", "store_id", "date").agg(*[F.sum(c).alias(c) for c in SUMMED])
    name = f"days_of_lines_{uuid.uuid4().hex}"
    rows.write.bucketBy(tasks(sf_dir), "product_id").sortBy("product_id", "store_id").saveAsTable(name)
    return spark.table(name)


def load(spark: SparkSession, sf_dir: str, name: str, days: DataFrame | None = None) -> DataFrame:
    """One of the retail inputs, from the star-schema tables in a folder, or from ``days_of_lines`` where that has it."""
    if days is not None and name in OF_DAYS:
        return spark.sql(OF_DAYS[name], days=days)
    sql = filled(TABLES[name], duckdb=False)
    source = next(t for t in ("lineitem", "orders", "part", "region", "supplier") if f"from {t}" in sql)
    rows, product = spark.read.parquet(f"{sf_dir}/{source}.parquet"), PRODUCTS.get(source)
    if product and product in sql:
        rows = named(spark, sf_dir, source).repartition(tasks(sf_dir), "_product")
        sql = sql.replace(product, "_product").replace(product[5:-11], "_product")
    for key, value in moduli(sf_dir).items():
        sql = sql.replace("{" + key + "}", str(value))
    return spark.sql(sql.replace(f"from {source}", "from {source}"), source=rows)


def ctes(*names: str) -> str:
    """The inputs as common table expressions of DuckDB, without the word WITH."""
    return ",\n".join(f"{name} as ({filled(TABLES[name], duckdb=True)})" for name in names)
